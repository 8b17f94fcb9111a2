"""Five stages over ``documents``: rules, near-duplicates, benchmarks, secrets, packing.

``STAGES`` lists ``(name, function)``; each function takes ``(spark, docs, sf_dir)`` and returns a
DataFrame, which ``run`` writes as Parquet to the shared folder and reads again as the next
stage's ``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import decontaminate, packing, quality, secrets, simhash
from tessella.llm.shared import cut


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the calibrated cutoffs reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = cut(quality.features(docs), "quality")
    return quality.apply_cutoffs(judged, quality.cutoffs_of(judged, labels)).where("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.one_of_each(docs)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word of a benchmark window."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret in their texts replaced by a mask."""
    scanned = cut(secrets.scan(docs), "scanned")
    spans = secrets.all_spans(*secrets.discovery_bin(scanned))
    text = F.col("row.text")
    masked = scanned.select("row", F.when(text.isNotNull(), secrets.redacted(text, spans)).alias("masked"))
    length = F.when(text.eqNullSafe(F.col("masked")), F.col("row.n_chars")).otherwise(F.length("masked")).cast("long")
    new = {"text": F.col("masked"), "n_chars": length}
    return masked.select(*(new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences of 1024 tokens."""
    return packing.pack(cut(packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json")), "pieces"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmarks),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

#: Tokenizing and XXH64 fingerprints have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return cut(STAGES[-1][1](spark, docs, sf_dir), STAGES[-1][0])
