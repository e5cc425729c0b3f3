"""The pipeline's stages on the fixture corpus and a registered run."""

from __future__ import annotations

import os

import pytest

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path, corpus):
    import corpus_pipeline as cp
    from renewlens.llm.fuzzy_lines import dedup_lines
    from renewlens.llm.omh import near_duplicate_classes

    assert [n for n, _ in cp.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "decontaminate", "packing"]
    item = " ".join(corpus[2][1].split()[10:40])
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(i, t, "xx", "s", len(t or "")) for i, t in corpus], "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(cp.STAGES)
    lines = stages["line_dedup"](spark, docs, str(tmp_path))
    assert lines.columns == docs.columns
    want = {r.doc_id for r in dedup_lines(docs).collect() if not r.n_removed or (r.text or "").split()}
    assert {r.doc_id for r in lines.collect()} == want and lines.where("n_chars != length(text)").count() == 0
    near = stages["near_dedup"](spark, docs, str(tmp_path))
    assert {r.doc_id for r in near.collect()} == {r.class_id for r in near_duplicate_classes(docs).collect()}
    clean = stages["decontaminate"](spark, docs, str(tmp_path))
    assert {r.doc_id for r in clean.collect()} == {i for i, t in corpus if item not in (t or "")}
    pieces = stages["packing"](spark, docs, str(tmp_path))
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {i for i, _ in corpus}


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_run_and_registered_queries(spark):
    import __spark_entry__ as e

    q = e.queries()
    assert {f"op{n}" for n in range(1, 11)} <= {k.split("_")[0] for k in q}
    assert q["pipeline"](spark, SF).count() > 0
    for name in (k for k in q if k.startswith(("op1_", "op2_", "op5_", "op7_", "op8_"))):
        assert q[name](spark, SF).count() == (50 if name.startswith(("op1_", "op7_")) else 200)
