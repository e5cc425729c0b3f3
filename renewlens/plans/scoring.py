"""Scoring set (Q1) and batch model scoring (M1, M2).

The notebooks score rows one at a time with a pickled gradient-boosting
classifier that is not shipped. Two scorers are offered:

* ``LinearModel``: a logistic model given as a coefficient table. Scores are
  plain column expressions (JVM-side, no UDF), and its exact attribution is
  the linear SHAP value ``w * (x - center)`` (the explainer's background
  mean is ``center``). The default coefficients (``synthetic_model``) are
  synthetic, chosen only to exercise the search on the test tables.
* ``score_with_pipeline``: any fitted Spark ML pipeline that emits a
  ``probability`` vector (e.g. one of ``fit_gbt``), applied with ``transform``
  in one pass.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from renewlens import params as P
from renewlens.plans import features as C

# model input: 57 numeric features in the notebook's order
MODEL_FEATURES: tuple[str, ...] = ("is_broker", "renewal_due_month", "package_duration") + tuple(
    C.FEATURE_VALUE_COLS
)


def scoring_set(features_latest: DataFrame, run_date=None) -> DataFrame:
    """Q1: the feature table plus the model inputs derived from it.

    ``is_broker`` compares the profile type case-sensitively (as in the
    notebook, while the base filter is case-folded); the ``_model`` columns
    add one to the prior counts and their ratio uses the new aliases.
    """
    run = F.col("feature_creation_date") if run_date is None else F.lit(run_date)
    cols = [c for c in C.FEATURE_TABLE_COLS if c != "feature_creation_date"]
    return features_latest.select(
        run.alias("model_run_date"),
        *cols,
        F.when(F.col("profile_type") == "Broker", 1).otherwise(0).alias("is_broker"),
        (F.col("seller_tot_packages_previous") + 1).alias("seller_tot_packages_previous_model"),
        (F.col("seller_tot_renewal_previous") + 1).alias("seller_tot_renewal_previous_model"),
    ).withColumn(
        "seller_previous_renewal_pct_model",
        F.try_divide(F.col("seller_tot_renewal_previous_model"), F.col("seller_tot_packages_previous_model")),
    )


@dataclass(frozen=True)
class LinearModel:
    """``p = 1 / (1 + exp(-(intercept + sum_i w_i * (x_i - c_i))))``."""

    intercept: float
    # (feature, weight, center) in model input order
    terms: tuple[tuple[str, float, float], ...]

    def weight(self, feature: str) -> float:
        return {f: w for f, w, _ in self.terms}[feature]

    def center(self, feature: str) -> float:
        return {f: c for f, _, c in self.terms}[feature]

    def logit(self) -> Column:
        """Left fold ``((b + t1) + t2) + ...`` as one ``aggregate`` node: the
        same summation order as a chain of ``+``, without a 57-deep tree of
        commutative nodes for the optimizer to canonicalise repeatedly."""
        terms = F.array(
            *[F.lit(float(w)) * (F.col(f).cast("double") - F.lit(float(c))) for f, w, c in self.terms]
        )
        return F.aggregate(terms, F.lit(float(self.intercept)), lambda acc, t: acc + t)

    def attribution(self, feature: str) -> Column:
        """Linear SHAP value of ``feature`` for the current row."""
        return F.lit(float(self.weight(feature))) * (F.col(feature).cast("double") - F.lit(float(self.center(feature))))


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def synthetic_model() -> LinearModel:
    """Synthetic coefficients (not a trained model): a rule per feature
    group so that initial probabilities straddle the 0.5 threshold on the
    test tables and every search branch is reached."""
    terms = []
    for f in MODEL_FEATURES:
        if f == "is_broker":
            w, c = 0.3, 0.0
        elif f == "package_duration":
            w, c = 0.002, 270.0
        elif f in ("renewal_due_month", "total_opportunities_citylevel_monthly", "tot_renewed_opportunities_citylevel_monthly"):
            w, c = 0.0, 0.0
        elif f.endswith("_pct") or "pct_" in f:
            w, c = (-0.05, 5.0) if f == "package_discount_pct" else (0.015, 35.0)
        elif f.endswith("_city_median"):
            w, c = (0.002, 30.0) if "_per_" in f else (0.01, 0.0)
        elif f in ("rate_price", "sales_price", "ratio_sales_price_slots"):
            w, c = 1e-6, 1.5e5
        elif f == "tot_listing_price_25pctduration":
            w, c = 2e-6, 0.0
        elif f.startswith("seller_tot_"):
            w, c = 0.03, 5.0
        elif f == "count_slots_pkg":
            w, c = 0.1, 2.0
        elif f.startswith("churn_shadow"):
            w, c = -0.1, 0.0
        elif f.startswith(("cnt_listing_other", "lead_delivery_ticket")):
            w, c = -0.03, 0.0
        elif f.startswith("cnt_1year"):
            w, c = 0.01, 10.0
        elif f.startswith("ratio_"):
            w, c = 0.1, 0.0
        elif f.startswith("other_channel"):
            w, c = 0.02, 0.5
        elif f.endswith("_25pctduration"):
            w, c = 0.004, 0.01
        else:
            w, c = 0.0, 0.0
        terms.append((f, w, c))
    return LinearModel(intercept=-0.45, terms=tuple(terms))


PROB_DIGITS = 9  # probabilities are reported rounded (exp() differs in the last ulp across engines)


def score_linear(scoring: DataFrame, model: LinearModel) -> DataFrame:
    """M2 with a linear model: one projection, no shuffle."""
    feats = [F.col(f).cast("double").alias(f) for f in MODEL_FEATURES]
    x = scoring.select("opportunity_id", *feats)
    return x.withColumn("__z", model.logit()).withColumn("initial_prob", sigmoid(F.col("__z")))


def score_table(scored: DataFrame) -> DataFrame:
    """Registered view of M2: one rounded probability per package."""
    return scored.select("opportunity_id", F.round("initial_prob", PROB_DIGITS).alias("initial_prob"))


def renewal_labels(src) -> DataFrame:
    """Label per package: 1 when its renewal window is the renewed label."""
    return src.renewal_report.select(
        "opportunity_id",
        F.when(F.col("renewal_window").isin(P.RENEWED_LABEL), 1.0).otherwise(0.0).alias("label"),
    )


def training_set(src, p: P.FeatureParams = P.FeatureParams(), **inputs: DataFrame) -> DataFrame:
    """Model inputs of ended packages as of their own quarter cut-off, with
    ``label`` and ``split`` (M2's data; the notebooks ship a fitted model only).

    Every feature window ends at the cut-off, and the outcomes of other packages
    (prior packages, city-month rate, owner history) count only where they ended
    by then, so no row holds its own label or a later one. Split by time: a
    package is ``test`` if cut off in the last ``holdout_days``, ``train`` if it
    ended before them, and ``gap`` otherwise (its label came after the first
    test cut-off). Packages without a renewal report row, and add-ons, are not in.
    ``inputs``: ``features.staged_inputs`` of the run date, if at hand.
    """
    p = p.training()
    border = F.date_sub(F.lit(p.as_of), p.holdout_days)
    split = F.when(F.col("onefourth_cutoff_date") >= border, "test").when(F.col("package_end_date") < border, "train").otherwise("gap")
    rows = scoring_set(C.feature_table(src, p, **inputs)).join(renewal_labels(src), "opportunity_id")
    return rows.withColumn("split", split)


def fit_gbt(training: DataFrame, max_iter: int = 10, max_depth: int = 3, seed: int = 42):
    """Fit a Spark ML pipeline (assembler + gradient-boosted trees) on the 57
    model inputs of the ``train`` rows of a ``training_set``, and on nothing
    else. Training is distributed by Spark ML; nothing is collected."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    feats = [F.col(f).cast("double").alias(f) for f in MODEL_FEATURES]
    train = training.filter(F.col("split") == "train").select("opportunity_id", *feats, "label")
    pipe = Pipeline(
        stages=[
            VectorAssembler(inputCols=list(MODEL_FEATURES), outputCol="features", handleInvalid="keep"),
            GBTClassifier(labelCol="label", featuresCol="features", maxIter=max_iter, maxDepth=max_depth, seed=seed),
        ]
    )
    return pipe.fit(train)


def evaluate(training: DataFrame, scored: DataFrame) -> DataFrame:
    """Per split: rows, renewal rate, mean probability, Brier score, log loss
    (probabilities held off 0 and 1 by 1e-15) and accuracy at 0.5, from a
    ``training_set`` and its scores (opportunity_id, initial_prob)."""
    y, q = F.col("label"), F.col("initial_prob")
    held = F.greatest(F.lit(1e-15), F.least(F.lit(1 - 1e-15), q))
    return training.select("opportunity_id", "split", "label").join(scored.select("opportunity_id", "initial_prob"), "opportunity_id").groupBy("split").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg(y), 9).alias("renewal_rate"),
        F.round(F.avg(q), 9).alias("mean_prob"),
        F.round(F.avg((q - y) * (q - y)), 9).alias("brier"),
        F.round(F.avg(-(y * F.log(held) + (1 - y) * F.log(1 - held))), 9).alias("log_loss"),
        F.round(F.avg(((q >= 0.5) == (y == 1)).cast("double")), 9).alias("accuracy"),
    )


def score_with_pipeline(scoring: DataFrame, pipeline_model) -> DataFrame:
    """M2 with a fitted ``PipelineModel`` whose first stage assembles the inputs."""
    from pyspark.ml.functions import vector_to_array

    feats = [F.col(f).cast("double").alias(f) for f in MODEL_FEATURES]
    out = pipeline_model.transform(scoring.select("opportunity_id", *feats))
    return out.select("opportunity_id", *MODEL_FEATURES, vector_to_array("probability")[1].alias("initial_prob"))
