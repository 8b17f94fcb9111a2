"""Merkle fixity audit of WARC replicas.

Records are serialised as WARC/1.0 responses and laid end to end in files.  Leaves are the
SHA-256 digests of records; above them, the records that begin in the same range of ``RANGE``
bytes form a node, ``FANOUT`` neighbouring ranges the next, and so on to one root for a file and
one root for the replica.  A node's hash covers its children's positions and hashes in order.
Each level is one aggregation of the written one below.

The audit compares the roots and then goes down: at each level only children of nodes that
differ are read from either replica, so sound branches are never joined.  A record that is lost or
changes its length shifts all behind it, so the records below differing ranges are aligned by
content first: those with the same digest in the same file are sound wherever they lie.  What is
left is corrupt where both have a record of the id, else missing or extra.

Defined cases: null url or html is written as empty; records with a null id are ordered by content
and aligned by content alone; equal rows are separate records, ordered by content; other columns
are not read; an empty replica has no root, so all records of the other are missing or extra.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessella.functions.workers import arrow_map
from tessella.llm.shared import cut

RANGE, FANOUT = 1 << 16, 64
#: Levels of ranges in a file: a node of the highest spans RANGE * FANOUT**(LEVELS - 1) bytes, 16 GB.
LEVELS = 4
#: Groups of files between the files' roots and the replica's.
FILE_GROUPS = 4096

#: Levels from the records (0) over the ranges (1..LEVELS) to the files' roots and the replica's.
Tree = list[DataFrame]


def record(url: Column, html: Column) -> Column:
    """A WARC/1.0 response record as text; the length counts bytes."""
    body = F.coalesce(html, F.lit(""))
    head = F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")), F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(head, body, F.lit("\r\n\r\n"))


def laid_out(records: DataFrame) -> DataFrame:
    """``file, id, offset, length, digest`` from ``file, id, record``: records in order of id.

    Files are bounded (WARC files hold about a gigabyte), so one task orders a file; only lengths
    and digests are ordered, never the records.
    """
    narrow = records.select("file", "id", F.octet_length("record").cast("long").alias("length"), F.sha2("record", 256).alias("digest"))
    order = Window.partitionBy("file").orderBy("id", "digest")
    return narrow.withColumn("offset", F.coalesce(F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))


def _up(node: str, by: int) -> Column:
    return F.floor(F.col(node) / F.lit(by)).cast("long")


def _joined() -> Column:
    """One hash of the children's places and hashes in order; a node has some hundred children at most."""
    children = F.array_sort(F.collect_list(F.struct("node", "hash")))
    return F.sha2(F.array_join(F.transform(children, lambda x: F.concat_ws(":", x["node"].cast("string"), x["hash"])), ","), 256).alias("hash")


def tree(leaves: DataFrame) -> Tree:
    """The written levels; each has ``file, node, parent, hash``, the records also ``id, length, digest``.

    Records have their offset as node.  Their hash covers the length, so a leaf covers where its
    record ends.  The replica's root has one row, or none if there are no records.
    """
    hashed = F.sha2(F.concat_ws(":", F.col("length").cast("string"), "digest"), 256)
    levels = [cut(leaves.select("file", F.col("offset").alias("node"), _up("offset", RANGE).alias("parent"), hashed.alias("hash"), F.col("id").cast("string").alias("id"), "length", "digest"), "records")]
    for k in range(1, LEVELS + 1):
        parent = _up("parent", FANOUT) if k < LEVELS else F.lit(0).cast("long")
        ranges = levels[-1].groupBy("file", "parent").agg(_joined())
        levels.append(cut(ranges.select("file", F.col("parent").alias("node"), parent.alias("parent"), "hash"), f"ranges-{k}"))
    here = F.lit(0).cast("long")
    files = levels[-1].groupBy("file").agg(_joined()).select("file", here.alias("node"), here.alias("parent"), "hash")
    levels.append(cut(files, "files"))
    digest = lambda: F.sha2(F.array_join(F.array_sort(F.collect_list("hash")), ","), 256).alias("hash")
    named = levels[-1].select(F.pmod(F.xxhash64("file"), F.lit(FILE_GROUPS)).alias("group"), F.sha2(F.concat_ws(":", "file", "hash"), 256).alias("hash"))
    top = named.groupBy("group").agg(digest()).agg(F.count("*").alias("n"), digest()).where("n > 0")
    levels.append(cut(top.select(F.lit(None).cast("string").alias("file"), here.alias("node"), here.alias("parent"), "hash"), "root"))
    return levels


def _differing(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """``file, node`` of the nodes of one level that are not alike in both."""
    a = ours.select("file", "node", F.col("hash").alias("mine"))
    b = theirs.select(F.col("file").alias("_file"), F.col("node").alias("_node"), F.col("hash").alias("other"))
    both = a.join(b, F.col("file").eqNullSafe(F.col("_file")) & (F.col("node") == F.col("_node")), "full_outer")
    return both.where(~F.col("mine").eqNullSafe(F.col("other"))).select(F.when(F.col("mine").isNotNull(), F.col("file")).otherwise(F.col("_file")).alias("file"), F.coalesce("node", "_node").alias("node"))


def _under(level: DataFrame, bad: DataFrame) -> DataFrame:
    named = bad.select(F.col("file").alias("_file"), F.col("node").alias("_parent"))
    return level.join(named, F.col("file").eqNullSafe(F.col("_file")) & (F.col("parent") == F.col("_parent")), "left_semi")


def _unmatched(ours: DataFrame, theirs: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pair the k-th rows of equal ``on``: the pairs, and what is left of either."""
    order = Window.partitionBy(*on).orderBy("node")
    a, b = (x.withColumn("_k", F.row_number().over(order)) for x in (ours, theirs))
    b = b.select(*(F.col(c).alias(f"their_{c}") for c in b.columns))
    same = F.col("_k") == F.col("their__k")
    for c in on:  # a null id is no id
        same &= F.col(c).eqNullSafe(F.col(f"their_{c}")) if c == "file" else F.col(c) == F.col(f"their_{c}")
    met = cut(a.join(b, same, "full_outer"), "aligned")
    mine, other = F.col("_k").isNotNull(), F.col("their__k").isNotNull()
    return met.where(mine & other), met.where(~other).select(*ours.columns), met.where(~mine).select(*(F.col(f"their_{c}").alias(c) for c in ours.columns))


def audit(ours: Tree, theirs: Tree) -> DataFrame:
    """Records that differ: ``file, offset, our_id, their_id, status``, offsets in the replica that has them (ours first).

    ``status`` is corrupt (both have the id, with other content), missing (only ours has it) or extra.
    """
    root = [x[-1].select("hash").first() for x in (ours, theirs)]
    bad = _differing(ours[-2], theirs[-2]) if root[0] != root[1] else ours[-2].where("false").select("file", "node")
    for level in range(LEVELS, 0, -1):
        bad = cut(bad, f"differing-{level + 1}")
        bad = _differing(*(_under(x[level], bad) for x in (ours, theirs)))
    bad = cut(bad, "differing-1")
    mine, other = (_under(x[0], bad).select("file", "node", "id", "length", "digest") for x in (ours, theirs))
    _, mine, other = _unmatched(mine, other, ["file", "digest", "length"])
    changed, mine, other = _unmatched(mine, other, ["file", "id"])
    none = F.lit(None).cast("string")
    corrupt = changed.select("file", F.col("node").alias("offset"), F.col("id").alias("our_id"), F.col("their_id"), F.lit("corrupt").alias("status"))
    missing = mine.select("file", "node", "id", none, F.lit("missing"))
    extra = other.select("file", "node", none, "id", F.lit("extra"))
    return corrupt.union(missing).union(extra)


def _records(stream: io.BufferedIOBase) -> Iterator[tuple[bytes, bytes]]:
    """Id and bytes of the records of an open WARC file, one at a time."""
    while line := stream.readline():
        head, length, name = [line], None, None
        while line.strip():
            key, _, value = line.partition(b":")
            if key.strip().lower() == b"content-length" and value.strip().isdigit():
                length = int(value)
            if key.strip().lower() == b"warc-record-id":
                name = value.strip()
            line = stream.readline()
            head.append(line)
            if not line:
                return
        if length is None:
            return
        yield name, b"".join(head) + stream.read(length + 4)


#: Bytes of records in one batch, besides a single larger record.
BATCH_BYTES = 32 << 20


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC files (plain or gzip): ``file, number, id, record``.

    ``id`` is the record's WARC-Record-ID, or else its number.  A file is one task's work; the file
    is held once (Spark's binary files have less than 2 GB), its records in batches.  A record
    whose header has no length ends the file.
    """

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, name in enumerate(batch.column("path").to_pylist()):
                content = pa.py_buffer(batch.column("content")[i].as_buffer())
                plain = io.BufferedReader(pa.BufferReader(content))
                stream = gzip.GzipFile(fileobj=plain) if plain.peek(2)[:2] == b"\x1f\x8b" else plain
                rows, size = [], 0
                for number, (own, data) in enumerate(_records(stream)):
                    rows.append((number, (own or b"%d" % number).decode(errors="replace"), data))
                    size += len(data)
                    if size > BATCH_BYTES:
                        yield made(name, rows)
                        rows, size = [], 0
                yield made(name, rows)

    def made(name: str, rows: list[tuple]) -> pa.RecordBatch:
        numbers, ids, data = zip(*rows, strict=True) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array([name] * len(rows), pa.string()), pa.array(numbers, pa.int64()), pa.array(ids, pa.string()), pa.array(data, pa.binary())], ["file", "number", "id", "record"])

    return arrow_map(spark.read.format("binaryFile").load(path).select("path", "content"), parsed, "file string, number long, id string, record binary")
