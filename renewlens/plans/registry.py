"""Named queries over the test tables: one per implemented operator.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame whose
column names equal the DuckDB oracle's (``renewlens.oracle_sql``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from renewlens import params as P
from renewlens.plans import features as C
from renewlens.sources.store import stage
from renewlens.sources.testdata import TestdataSources

FP = P.FeatureParams()

BASE_OUT = [k for k in C.BASE_KEYS if k not in ("slot_ids", "product_ids")] + ["rate_price", "sales_price"]


def _src(spark: SparkSession, sf_dir: str) -> TestdataSources:
    return TestdataSources(spark, sf_dir)


def q_package_base(spark, sf_dir):
    return C.package_base(_src(spark, sf_dir), FP).select(*BASE_OUT)


def q_package_base_recent(spark, sf_dir):
    return C.package_base(_src(spark, sf_dir), FP.backup()).select(*BASE_OUT)


def q_lead_base(spark, sf_dir):
    return C.lead_base(_src(spark, sf_dir), FP)


def q_slots_per_package(spark, sf_dir):
    return C.slots_per_package(_src(spark, sf_dir))


def q_prior_packages(spark, sf_dir):
    s = _src(spark, sf_dir)
    return C.prior_packages(C.package_base(s, FP), s, FP)


def q_lead_features(spark, sf_dir):
    s = _src(spark, sf_dir)
    return C.lead_features(C.package_base(s, FP), C.lead_base(s, FP), FP)


def q_city_month_renewal(spark, sf_dir):
    return C.city_month_renewal(_src(spark, sf_dir), FP)


def q_city_daily_activity(spark, sf_dir):
    return C.city_daily_activity(C.lead_base(_src(spark, sf_dir), FP))


def q_city_median_activity(spark, sf_dir):
    s = _src(spark, sf_dir)
    return C.city_median_activity(C.package_base(s, FP), C.city_daily_activity(C.lead_base(s, FP)), FP)


def q_ticket_counts(spark, sf_dir):
    s = _src(spark, sf_dir)
    return C.ticket_counts(C.package_base(s, FP), s, FP)


def q_owner_experience(spark, sf_dir):
    s = _src(spark, sf_dir)
    return C.owner_experience(C.package_base(s, FP), s, FP)


def q_competitor_listings(spark, sf_dir):
    s = _src(spark, sf_dir)
    return C.competitor_listings(C.package_base(s, FP), s, FP)


def q_feature_table(spark, sf_dir):
    return C.feature_table(_src(spark, sf_dir), FP)


def _scored(spark, sf_dir):
    from renewlens.plans import scoring as S

    ft = C.feature_table(_src(spark, sf_dir), FP)
    return S.score_linear(S.scoring_set(ft), S.synthetic_model())


def q_scoring_set(spark, sf_dir):
    from renewlens.plans import scoring as S

    return S.scoring_set(C.feature_table(_src(spark, sf_dir), FP))


def q_score_logistic(spark, sf_dir):
    from renewlens.plans import scoring as S

    return S.score_table(_scored(spark, sf_dir))


def q_adjustment_candidates(spark, sf_dir):
    from renewlens.plans import recommend as R, scoring as S

    return R.adjustment_candidates(_scored(spark, sf_dir), S.synthetic_model())


def q_first_beneficial_step(spark, sf_dir):
    from renewlens.plans import recommend as R, scoring as S

    return R.first_beneficial_steps(_scored(spark, sf_dir), S.synthetic_model())


def q_recommendations(spark, sf_dir):
    from renewlens.plans import recommend as R, scoring as S

    return R.recommend(_scored(spark, sf_dir), S.synthetic_model()).drop("applied_features", "applied_adjustments")


def q_recommendation_summary(spark, sf_dir):
    from renewlens.plans import recommend as R, scoring as S

    return R.recommendation_summary(R.recommend(_scored(spark, sf_dir), S.synthetic_model()))


def q_recommendation_adjustments(spark, sf_dir):
    from renewlens.plans import recommend as R, scoring as S

    return R.recommendation_adjustments(R.recommend(_scored(spark, sf_dir), S.synthetic_model()))


LEAD_SUBSETS = {
    "leads_in_window": ["total_leads_25pctduration", "tot_listings_25pctduration"],
    "listing_price_in_window": ["tot_listing_price_25pctduration"],
    "listings_by_property_type": C.PTYPE_LISTING_COLS,
    "listings_by_bedroom": C.BHK_LISTING_COLS,
    "leads_by_property_type": C.PTYPE_LEAD_COLS,
    "leads_by_bedroom": C.BHK_LEAD_COLS,
    "leads_by_channel": C.CHANNEL_COLS,
}


def _lead_subset(cols):
    def q(spark, sf_dir):
        s = _src(spark, sf_dir)
        return C.lead_features(C.package_base(s, FP), C.lead_base(s, FP), FP, cols)

    return q


def q_package_recency_rank(spark, sf_dir):
    s = _src(spark, sf_dir)
    return C.package_recency_rank(C.package_base(s, FP), s)


def q_listing_buckets(spark, sf_dir):
    return C.listing_details(_src(spark, sf_dir))


def q_listing_price_median_impute(spark, sf_dir):
    return C.seller_median_price(C.leads_with_listings(_src(spark, sf_dir), FP))


def q_seller_property_mode(spark, sf_dir):
    return C.seller_property_mode(C.leads_with_listings(_src(spark, sf_dir), FP))


def q_lead_channel_bucket(spark, sf_dir):
    from pyspark.sql import functions as F

    lb = C.lead_base(_src(spark, sf_dir), FP)
    return lb.groupBy("lead_generator", "lead_generator_new").agg(F.count(F.lit(1)).alias("n_leads"))


def q_packages_per_cutoff(spark, sf_dir):
    from renewlens.plans import monitor as M

    return M.packages_per_cutoff(C.package_base(_src(spark, sf_dir), FP.backup()))


def q_feature_counts(spark, sf_dir):
    from renewlens.plans import monitor as M

    return M.feature_counts(C.feature_table(_src(spark, sf_dir), FP))


def q_cutoff_range(spark, sf_dir):
    from renewlens.plans import monitor as M

    return M.cutoff_range(C.feature_table(_src(spark, sf_dir), FP))


def q_builder_grain(spark, sf_dir):
    """Q3, Q-12: rows and repeated keys of every builder, observed while the
    feature table is written."""
    from pyspark.sql import Observation

    grain = Observation("builder_grain")
    stage(C.feature_table(_src(spark, sf_dir), FP, grain=grain), "features_latest")
    return C.grain_report(spark, grain)


def q_top_packages(spark, sf_dir):
    from renewlens.plans import monitor as M

    return M.top_packages(C.feature_table(_src(spark, sf_dir), FP))


def _fresh_root(spark, name):
    import uuid

    from renewlens.session import ensure_checkpoint_dir

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def q_feature_repository(spark, sf_dir):
    """C13: the dated repository written twice for the run date (rerun-safe),
    read back as rows per run date."""
    from renewlens.plans import monitor as M
    from renewlens.sources.store import write_dated

    path = _fresh_root(spark, "features_repository")
    ft = stage(C.feature_table(_src(spark, sf_dir), FP), "features_latest")
    write_dated(ft, path, "feature_creation_date")
    write_dated(ft, path, "feature_creation_date")
    return M.runs_overview(spark.read.parquet(path))


def q_feature_table_incremental(spark, sf_dir):
    """C5, C7, S2: the run of the day from the state of the day before, which
    reads one day of leads; equal to the full rebuild."""
    import datetime as dt

    from renewlens.plans.incremental import LeadState

    src, day = _src(spark, sf_dir), FP.as_of
    state = LeadState(spark, _fresh_root(spark, "lead_state"), FP)
    state.update(src, day - dt.timedelta(days=1))
    state.update(src, day)
    return state.feature_table(src, day)


def q_feature_repository_swapped(spark, sf_dir):
    """K5: the run date swapped in twice by commit markers, the day before
    cleared by an empty run; rows per run date."""
    import datetime as dt

    from renewlens.plans import monitor as M
    from renewlens.sources.store import DatedStore

    repo, day = DatedStore(spark, _fresh_root(spark, "features_swapped")), "feature_creation_date"
    ft = stage(C.feature_table(_src(spark, sf_dir), FP), "features_latest")
    before = FP.as_of - dt.timedelta(days=1)
    repo.write(ft.withColumn(day, F.lit(before)), before)
    repo.write(ft, FP.as_of)
    repo.write(ft, FP.as_of)
    repo.write(ft.limit(0), before)
    repo.vacuum()
    return M.runs_overview(repo.read())


def q_prior_packages_recent(spark, sf_dir):
    s, p = _src(spark, sf_dir), FP.backup()
    return C.prior_packages(C.package_base(s, p), s, p)


def q_lead_base_recent(spark, sf_dir):
    return C.lead_base(_src(spark, sf_dir), FP.backup())


def q_package_slots_products(spark, sf_dir):
    """C1's slot_ids and product_ids, per package."""
    base = C.package_base(_src(spark, sf_dir), FP)
    return base.select("seller_uuid", "opportunity_id", "slot_ids", "product_ids").dropDuplicates().select(
        "seller_uuid", "opportunity_id", F.array_join("slot_ids", ";").alias("slot_ids"), F.array_join("product_ids", ";").alias("product_ids"))


def q_score_monitor(spark, sf_dir):
    """Q7 over the prediction history written by a full daily run."""
    from renewlens.plans import monitor as M

    paths = M.daily_run(spark, _src(spark, sf_dir), _fresh_root(spark, "daily"), FP)
    return M.score_monitor(spark.read.parquet(paths["prediction_history"]))


def q_training_set(spark, sf_dir):
    from renewlens.plans import scoring as S

    return S.training_set(_src(spark, sf_dir), FP)


def q_model_evaluation(spark, sf_dir):
    """The linear model's scores of the training set, judged per split."""
    from renewlens.plans import scoring as S

    rows = stage(S.training_set(_src(spark, sf_dir), FP), "training_set")
    return S.evaluate(rows, S.score_linear(rows, S.synthetic_model()))


def q_score_gbt(spark, sf_dir):
    """M2 with a Spark ML model: gradient-boosted trees fitted on ended packages
    as of their own cut-off, then applied to the scoring set in one transform.
    Rows-only check: tree fitting has no SQL equivalent."""
    from renewlens.plans import scoring as S

    src = _src(spark, sf_dir)
    inputs = C.staged_inputs(src, FP)
    ss = stage(S.scoring_set(C.feature_table(src, FP, **inputs)), "scoring_set")
    model = S.fit_gbt(stage(S.training_set(src, FP, **inputs), "training_set"))
    return S.score_table(S.score_with_pipeline(ss, model))


def q_recommendations_gbt(spark, sf_dir):
    """M5-M10 with a Spark ML model: the generic (model-agnostic) search,
    GBT probabilities, the direction of a step from the model itself. Rows-only."""
    from renewlens.plans import recommend as R, recommend_generic as G, scoring as S

    src = _src(spark, sf_dir)
    inputs = C.staged_inputs(src, FP)
    ss = stage(S.scoring_set(C.feature_table(src, FP, **inputs)), "scoring_set")
    model = S.fit_gbt(stage(S.training_set(src, FP, **inputs), "training_set"))
    scorer = G.pipeline_scorer(model)
    scored = G.with_effects(stage(S.score_with_pipeline(ss, model), "scored_gbt"), scorer)
    return R.recommendation_summary(G.recommend_with_model(scored, scorer, G.effect))


def q_recommendation_any_model(spark, sf_dir):
    """M8 by the search for any model, given the linear one: the same rows as
    ``recommendation_summary``."""
    from renewlens.plans import recommend as R, recommend_generic as G, scoring as S

    model = S.synthetic_model()
    return R.recommendation_summary(G.recommend_with_model(_scored(spark, sf_dir), G.linear_scorer(model), model.attribution))


def q_recommendation_values(spark, sf_dir):
    from renewlens.plans import recommend as R, scoring as S

    return R.recommendation_values(R.recommend(_scored(spark, sf_dir), S.synthetic_model()))


def q_repository_empty_rerun(spark, sf_dir):
    """K3 + K5: two run dates are stored, then the later one runs again with no
    row, which clears it and nothing else."""
    import datetime as dt

    from renewlens.plans import monitor as M
    from renewlens.sources.store import write_dated

    path, day = _fresh_root(spark, "features_rerun"), "feature_creation_date"
    ft = stage(C.feature_table(_src(spark, sf_dir), FP), "features_latest")
    write_dated(ft, path, day, FP.as_of)
    write_dated(ft.withColumn(day, F.lit(FP.as_of - dt.timedelta(days=1))), path, day)
    write_dated(ft.limit(0), path, day, FP.as_of)
    return M.runs_overview(spark.read.parquet(path))


def q_prediction_history(spark, sf_dir):
    """K7 + Q8: predictions appended twice, the second time with a new column,
    and read with the schemas merged."""
    from renewlens.plans import monitor as M, recommend as R, scoring as S
    from renewlens.sources.store import append_history, read_history

    path = _fresh_root(spark, "prediction_history")
    rec = stage(M.prediction_columns(R.recommend(_scored(spark, sf_dir), S.synthetic_model()), FP.as_of), "predictions")
    append_history(rec, path)
    append_history(rec.withColumn("model_name", F.lit("linear")), path)
    digits = S.PROB_DIGITS
    return read_history(spark, path).select(
        "model_run_date", "opportunity_id", *[F.round(c, digits).alias(c) for c in ("initial_prob", "final_prob", "probability_lift")],
        "already_above_threshold", F.size("original_values").cast("long").alias("n_original"),
        F.size("new_values").cast("long").alias("n_new"), F.size("adjustments").cast("long").alias("n_adjustments"), "model_name",
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "package_base": q_package_base,
        "package_base_recent": q_package_base_recent,
        "lead_base": q_lead_base,
        "slots_per_package": q_slots_per_package,
        "prior_packages": q_prior_packages,
        "lead_features": q_lead_features,
        "city_month_renewal": q_city_month_renewal,
        "city_daily_activity": q_city_daily_activity,
        "city_median_activity": q_city_median_activity,
        "ticket_counts": q_ticket_counts,
        "owner_experience": q_owner_experience,
        "competitor_listings": q_competitor_listings,
        "feature_table": q_feature_table,
        "feature_table_incremental": q_feature_table_incremental,
        "feature_repository_swapped": q_feature_repository_swapped,
        "prior_packages_recent": q_prior_packages_recent,
        "lead_base_recent": q_lead_base_recent,
        "package_slots_products": q_package_slots_products,
        "scoring_set": q_scoring_set,
        "score_logistic": q_score_logistic,
        "training_set": q_training_set,
        "model_evaluation": q_model_evaluation,
        "score_gbt": q_score_gbt,
        "adjustment_candidates": q_adjustment_candidates,
        "first_beneficial_step": q_first_beneficial_step,
        "recommendations": q_recommendations,
        "recommendation_summary": q_recommendation_summary,
        "recommendation_adjustments": q_recommendation_adjustments,
        "recommendations_gbt": q_recommendations_gbt,
        "recommendation_any_model": q_recommendation_any_model,
        "recommendation_values": q_recommendation_values,
        "repository_empty_rerun": q_repository_empty_rerun,
        "prediction_history": q_prediction_history,
        "package_recency_rank": q_package_recency_rank,
        **{name: _lead_subset(cols) for name, cols in LEAD_SUBSETS.items()},
        "listing_buckets": q_listing_buckets,
        "listing_price_median_impute": q_listing_price_median_impute,
        "seller_property_mode": q_seller_property_mode,
        "lead_channel_bucket": q_lead_channel_bucket,
        "packages_per_cutoff": q_packages_per_cutoff,
        "feature_counts": q_feature_counts,
        "builder_grain": q_builder_grain,
        "cutoff_range": q_cutoff_range,
        "top_packages": q_top_packages,
        "feature_repository": q_feature_repository,
        "score_monitor": q_score_monitor,
    }
