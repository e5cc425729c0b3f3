"""Training set of ended packages as of their own cut-off."""

from __future__ import annotations

from pyspark.sql import functions as F

from renewlens import params as P
from renewlens.plans import scoring as S
from renewlens.sources.testdata import TestdataSources

SF = "/root/testdata/sf0.001"
FP = P.FeatureParams()


class Flipped:
    """Sources in which every outcome known only from the first test cut-off on
    is turned over."""

    def __init__(self, src, border):
        self._src, self._border = src, border

    def __getattr__(self, name):
        return getattr(self._src, name)

    @property
    def renewal_report(self):
        ends = self._src.packages.select("opportunity_id", F.to_date("max_end_datetime").alias("__end"))
        late = F.col("__end") >= self._border
        other = F.when(F.col("renewal_window").eqNullSafe(P.RENEWED_LABEL), "none").otherwise(P.RENEWED_LABEL)
        kept = F.lower("renewal_window").eqNullSafe(P.ADD_ON_LABEL) | F.col("renewal_window").isNull()
        return self._src.renewal_report.join(ends, "opportunity_id").withColumn(
            "renewal_window", F.when(late & ~kept, other).otherwise(F.col("renewal_window"))).drop("__end")


def test_no_later_outcome_reaches_a_feature(spark):
    src, border = TestdataSources(spark, SF), F.date_sub(F.lit(FP.as_of), FP.holdout_days)
    plain = S.training_set(src, FP).filter(F.col("onefourth_cutoff_date") <= border).collect()
    turned = S.training_set(Flipped(src, border), FP).filter(F.col("onefourth_cutoff_date") <= border).collect()
    label = {r.opportunity_id: (r.label, r.split) for r in plain}
    assert len(plain) > 20 and {s for _, s in label.values()} >= {"train", "gap"}

    def features(rows):
        return sorted(tuple(v for c, v in r.asDict().items() if c != "label") for r in rows)

    assert features(plain) == features(turned)
    assert all(r.label == label[r.opportunity_id][0] for r in turned if r.split == "train")
    assert any(r.label != label[r.opportunity_id][0] for r in turned if r.split == "gap")


def test_fit_reads_train_rows_only(spark):
    rows = [(i, "train" if i < 40 else "test", float(i % 2 if i < 40 else (i + 1) % 2)) for i in range(80)]
    df = spark.createDataFrame(rows, "opportunity_id long, split string, label double").select(
        "*", *[(F.col("opportunity_id") % 2 if f == "package_duration" else F.lit(0)).cast("double").alias(f) for f in S.MODEL_FEATURES])
    model = S.fit_gbt(df, max_iter=2, max_depth=1)
    got = {r.split: r for r in S.evaluate(df, S.score_with_pipeline(df, model)).collect()}
    assert got["train"].accuracy == 1.0 and got["test"].accuracy == 0.0 and got["train"].n == got["test"].n == 40
    assert got["train"].brier < 0.25 < got["test"].brier and got["train"].log_loss < got["test"].log_loss
