"""The pipeline's stages against brute force on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

pipeline = pytest.importorskip("corpus_pipeline")
from tessella.llm.shared import cut  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert [n for n, _ in pipeline.STAGES] == ["quality_rules", "near_duplicates", "benchmark_decontamination", "secret_scan", "best_fit_packing"]
    stage = dict(pipeline.STAGES)
    kept = cut(stage["quality_rules"](spark, docs, SF), "t")
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.collect())
    assert set(ids) <= {i for i, t in texts.items() if not brute.quality_base(t)[5]}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert all(i in ids for i in texts if labels.get(i) == 1 and not brute.quality_base(texts[i])[5])

    single = cut(stage["near_duplicates"](spark, kept, SF), "t")
    least = brute.linked({i: brute.fingerprint(texts[i]) for i in ids})
    ids = [i for i in ids if least[i] == i]
    assert sorted(r.doc_id for r in single.collect()) == ids

    clean = cut(stage["benchmark_decontamination"](spark, single, SF), "t")
    ids = [i for i, w in zip(ids, brute.contaminated([texts[i] for i in ids], items), strict=True) if not w[4]]
    assert sorted(r.doc_id for r in clean.collect()) == ids

    masked = cut(stage["secret_scan"](spark, clean, SF), "t")
    assert masked.columns == docs.columns and masked.count() == len(ids)
    for r in masked.collect():
        assert brute.secret_base(r.text)[:3] == (0, 0, 0)
        assert r.text == texts[r.doc_id] or r.n_chars == len(r.text)

    packed = stage["best_fit_packing"](spark, masked, SF)
    assert {r.doc_id for r in packed.collect()} == set(ids)
    assert pipeline.run(spark, SF).count() == packed.count()


def tables(spark, tmp_path, rows):
    """A folder of tables with these documents, extra columns among them, and no labels or items."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, row string, key string, masked string, quality string"
    spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(None, None, None)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(None, "an item without an id"), (1, None), (2, "")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def test_empty_tables_pass_through(spark, tmp_path):
    assert pipeline.run(spark, tables(spark, tmp_path, [])).count() == 0


def test_nulls_and_clashing_names_pass_through(spark, tmp_path):
    words = lambda seed: " ".join(f"w{seed}x{i}" for i in range(60))
    rows = [
        (1, words(1), "en", None, 300),
        (None, words(2), None, "s", None),
        (None, words(2), None, "s", None),
        (3, None, "en", "s", 0),
        (4, "", None, None, None),
        (5, words(3) + " password=hunter2hunter2hunter2 " + words(4), "en", "s", 999),
        (6, words(5), None, None, None),
        (6, words(6), None, None, None),
    ]
    sf = tables(spark, tmp_path, rows)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in pipeline.STAGES[:-1]:
        done = cut(stage(spark, docs, sf), "t")
        assert done.columns == docs.columns, name
        assert done.where("row <> 'a' or key <> 'b' or masked <> 'c' or quality <> 'd'").count() == 0
        docs = done
    left = {r.doc_id: r for r in docs.collect()}
    assert docs.count() == 5 and set(left) == {1, None, 5, 6}
    assert "hunter2" not in left[5].text and "[SECRET]" in left[5].text and left[5].n_chars == len(left[5].text) and left[1].n_chars == 300
    assert {r.doc_id for r in pipeline.run(spark, sf).collect()} == {1, None, 5, 6}
