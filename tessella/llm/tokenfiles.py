"""Token ids in ORC files: ascending document order, stripes to read in parallel, Bloom filters.

A row is ``doc_id, part, start_in_part, n_tokens, ids``: ``part`` is the file's number in the
order of document ids, ``start_in_part`` the ids before the document in that file, ``ids`` the
token ids with the end id last, which ORC keeps as run-length encoded integers.  Row indexes and a
Bloom filter on ``doc_id`` let a reader skip stripes and row groups by metadata alone, and stripes
are independent splits for readers.

Rows with equal doc_id lie together, in any order, and each keeps its ids; a null doc_id sorts
first; null text is empty, so it has the end id only; other columns are not written.  An empty
table gives files without rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessella.functions.workers import arrow_map
from tessella.llm import fasttokens
from tessella.llm.shared import cut

SCHEMA = "part int, start_in_part long, n_tokens long, ids array<int>"
#: Text characters that one batch of ids may come from, besides a single larger document.
BATCH_CHARS = 4_000_000
#: Parts table that is broadcast: a row for each file.
MOST_PARTS = 100_000


def _parts(texts: list[str], most: int = BATCH_CHARS) -> Iterator[tuple[int, int]]:
    low, size = 0, 0
    for i, text in enumerate(texts):
        if i > low and size + len(text) > most:
            yield low, i
            low, size = i, 0
        size += len(text)
    if low < len(texts):
        yield low, len(texts)


def write(docs: DataFrame, where: str, path: str, end_id: int = 2, stripe_bytes: int = 16 << 20, row_index: int = 1000) -> None:
    """Encode ``docs`` with the tokenizer file ``path`` and write the ORC files to folder ``where``."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, part, at = fasttokens.load(path), TaskContext.get().partitionId(), 0
        last = end_id.to_bytes(4, "little")
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for low, high in _parts(texts):
                ids = [tokenizer.ids(x) + last for x in texts[low:high]]
                ends = [0]
                for x in ids:
                    ends.append(ends[-1] + len(x) // 4)
                values = pa.Array.from_buffers(pa.int32(), ends[-1], [None, pa.py_buffer(b"".join(ids))])
                n = len(ids)
                starts = [at + x for x in ends[:-1]]
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
                columns = [batch.column("doc_id").slice(low, n), pa.array([part] * n, pa.int32()), pa.array(starts, pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64()), lists]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "start_in_part", "n_tokens", "ids"])
                at += ends[-1]

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # Rows of a null or repeated id are dealt to several files too.
    ordered = rows.repartitionByRange("doc_id", F.monotonically_increasing_id()).sortWithinPartitions("doc_id")
    options = {"orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "orc.create.index": "true", "orc.row.index.stride": str(row_index), "orc.stripe.size": str(stripe_bytes), "compression": "zstd"}
    arrow_map(ordered, encoded, f"doc_id {kind}, {SCHEMA}").write.options(**options).orc(where)


def read(spark: SparkSession, where: str, doc_ids: list | None = None) -> DataFrame:
    """The rows of the files; with ``doc_ids``, stripes without them are skipped by metadata."""
    rows = spark.read.orc(where)
    return rows if doc_ids is None else rows.where(F.col("doc_id").isin(doc_ids))


def stripes(spark: SparkSession, where: str) -> list[dict]:
    """Of each stripe: file, offset, bytes and rows, from the files' footers; inspection only."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(where)
    found = []
    for status in path.getFileSystem(conf).listStatus(path):
        if status.getPath().getName().endswith(".orc"):
            reader = jvm.org.apache.orc.OrcFile.createReader(status.getPath(), jvm.org.apache.orc.OrcFile.readerOptions(conf))
            found += [{"file": status.getPath().getName(), "offset": s.getOffset(), "bytes": s.getLength(), "rows": s.getNumberOfRows(), "index_bytes": s.getIndexLength()} for s in reader.getStripes()]
            reader.close()
    return found


def positions(rows: DataFrame) -> DataFrame:
    """Of :func:`read`'s rows: ``doc_id, start, n_tokens, ids_crc32`` over the whole set of files.

    ``start`` counts the ids of all documents before; the crc32 is that of the ids as read, each
    as a little-endian unsigned 32-bit integer.
    """
    kind = rows.schema["doc_id"].dataType.simpleString()

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            values = memoryview(lists.values.buffers()[1] or b"").cast("B")
            base = lists.values.offset
            ends = [(base + x) * 4 for x in lists.offsets.to_pylist()]
            crcs = [zlib.crc32(values[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
            sizes = [(b - a) // 4 for a, b in zip(ends, ends[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), batch.column("start_in_part"), pa.array(sizes, pa.int64()), pa.array(crcs, pa.int64())], ["doc_id", "part", "start_in_part", "n_tokens", "ids_crc32"])

    # A row per file, so one task orders them.
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = totals.select(F.col("part").alias("__part"), before.alias("base"))
    bases = cut(bases, "file-starts")
    bases = F.broadcast(bases) if bases.count() <= MOST_PARTS else bases
    found = arrow_map(rows.select("doc_id", "part", "start_in_part", "ids"), summed, f"doc_id {kind}, part int, start_in_part long, n_tokens long, ids_crc32 long")
    return found.join(bases, F.col("part") == F.col("__part")).select("doc_id", (F.col("base") + F.col("start_in_part")).alias("start"), "n_tokens", "ids_crc32")
