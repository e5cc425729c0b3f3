"""Monitoring queries (Q2-Q8), the daily run and its sinks (C13, K5-K7).

The daily run keeps the notebook's order: feature table -> dated feature
repository -> scoring -> recommendation -> latest predictions (overwrite)
and prediction history (per run date). Every write goes through
``renewlens.sources.store``; rerunning a day replaces that day only.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from renewlens import params as P
from renewlens.operators.aggs import distinct_count
from renewlens.sources import store


def packages_per_cutoff(base: DataFrame) -> DataFrame:
    """Q2: distinct packages per quarter cut-off date."""
    return distinct_count(base, ["onefourth_cutoff_date"], "opportunity_id", "cnt")


def feature_counts(features: DataFrame) -> DataFrame:
    """Q3: rows, sellers and packages of the feature table (grain check)."""
    return features.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("seller_uuid").alias("sellers"),
        F.countDistinct("opportunity_id").alias("distinct_opportunities"),
    )


def cutoff_range(features: DataFrame) -> DataFrame:
    """Q4: first and last quarter cut-off date."""
    return features.agg(
        F.min("onefourth_cutoff_date").alias("min_cutoff_date"),
        F.max("onefourth_cutoff_date").alias("max_cutoff_date"),
    )


def runs_overview(repository: DataFrame, date_col: str = "feature_creation_date") -> DataFrame:
    """Q5 / Q6: distinct packages per stored run date."""
    return distinct_count(repository, [date_col], "opportunity_id", "cnt")


def score_monitor(history: DataFrame, cut: float = 0.25) -> DataFrame:
    """Q7: per run date, distinct packages and how many score at least ``cut``."""
    per_pkg = history.select("model_run_date", "opportunity_id", "initial_prob")
    counts = distinct_count(per_pkg, ["model_run_date"], "opportunity_id", "cnt_opportunities")
    high = per_pkg.groupBy("model_run_date").agg(
        F.sum(F.when(F.col("initial_prob") >= cut, 1).otherwise(0)).cast("long").alias("percent_renewals")
    )
    return counts.join(high, "model_run_date")


def top_packages(features: DataFrame, n: int = 20) -> DataFrame:
    """O5 (a top-k report is the feature here): packages with the most
    first-quarter leads; a unique tie-break keeps the result deterministic.
    ``orderBy().limit()`` plans as a distributed top-k (TakeOrderedAndProject)."""
    return (
        features.select("opportunity_id", "seller_uuid", "city", "total_leads_25pctduration")
        .orderBy(F.col("total_leads_25pctduration").desc(), F.col("opportunity_id").asc())
        .limit(n)
    )


def prediction_columns(rec: DataFrame, run_date: dt.date) -> DataFrame:
    """Q8: the stored prediction columns with their run date."""
    return rec.select(
        F.lit(run_date).alias("model_run_date"),
        "opportunity_id", "initial_prob", "final_prob", "probability_lift", "already_above_threshold",
        "original_values", "new_values", "adjustments",
    )


def daily_run(spark: SparkSession, src, root: str, p: P.FeatureParams = P.FeatureParams(), model=None,
              search: P.SearchParams = P.SearchParams(), append_history: bool = False) -> dict[str, str]:
    """Build, store, score and recommend for one run date under ``root``.

    Returns the table paths. ``append_history=True`` gives the notebook's
    plain append (duplicates on rerun); the default replaces the run date. The
    grain of every builder, observed while the features are written, is stored
    beside them.
    """
    from renewlens.plans import features as C
    from renewlens.plans import recommend as R
    from renewlens.plans import scoring as S

    root = root.rstrip("/")
    paths = {
        "features_repository": f"{root}/features_repository",
        "grain_report": f"{root}/grain_report",
        "prediction_latest": f"{root}/prediction_reco_latest",
        "prediction_history": f"{root}/prediction_reco_historical",
    }
    grain = Observation("grain")
    ft = C.feature_table(src, p, grain=grain)
    repository = store.DatedStore(spark, paths["features_repository"])
    repository.write(ft, p.as_of)
    report = C.grain_report(spark, grain).withColumn("feature_creation_date", F.lit(p.as_of))
    store.write_dated(report, paths["grain_report"], "feature_creation_date", p.as_of)
    latest = repository.read().filter(F.col("feature_creation_date") == F.lit(p.as_of))
    model = S.synthetic_model() if model is None else model
    scored = S.score_linear(S.scoring_set(latest), model)
    rec = R.recommend(scored, model, search).drop("applied_features", "applied_adjustments")
    rec.write.mode("overwrite").parquet(paths["prediction_latest"])
    hist = prediction_columns(spark.read.parquet(paths["prediction_latest"]), p.as_of)
    if append_history:
        store.append_history(hist, paths["prediction_history"])
    else:
        store.write_dated(hist, paths["prediction_history"], "model_run_date", p.as_of)
    return paths
