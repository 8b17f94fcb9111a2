"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint has 64 bits, each set if it is set in over half the XXH64 hashes of the text's
3-word shingles.  Two fingerprints link if at most two bits differ.  Only distinct fingerprints
are compared:

1. Cut in two halves of 32 bits: of two linked fingerprints, one half differs by one bit at most.
   Each half is indexed as it is and with each single bit deleted (33 keys a half), so linked
   fingerprints are equal in a key.
2. Keys are sorted over the cluster by (key, fingerprint); equal keys lie next to each other, and
   members of one key are compared (by deleted bit, those with it against those without).
3. A key with more than ``MOST_MEMBERS`` members, or one at a partition's edge, isn't compared:
   its fingerprints go to an exact way instead, whose cost is linear.  Each of them emits itself
   and its 64 one-bit variants; any two that are within two bits of each other emit a common
   word, and those that emit the same word (65 at most) are within two bits of each other.

Components of the links come from :mod:`tessella.llm.graph`.  Documents then meet the table of
fingerprints, those of hot fingerprints by a broadcast of these few.

Null or wordless text has fingerprint zero, linked like any other; rows with equal doc_id are one
node each by fingerprint; a null doc_id takes part in links but never names a component (null if
no other does); other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.workers import arrow_map
from tessella.llm.graph import components
from tessella.llm.shared import cut, join_hot, wrapped

SHINGLE, SEED = 3, 42
MOST_MEMBERS = 64
#: Most rows to drop that are broadcast: some 100 MB.
MOST_BROADCAST = 1_000_000
HASHES_AT_ONCE = 65_536


def fingerprint(text: str | None) -> int:
    """The 64-bit fingerprint of a text, unsigned."""
    words = (text or "").encode().lower().split()  # of bytes: A-Z and the six blanks only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    k = min(SHINGLE, len(words))
    stops = ends[k - 1 :].tolist()
    starts = [0, *(ends[: len(stops) - 1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for low in range(0, len(stops), HASHES_AT_ONCE):
        part = [digest(joined[a:b], SEED) for a, b in zip(starts[low : low + HASHES_AT_ONCE], stops[low : low + HASHES_AT_ONCE], strict=True)]
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    over = counts * 2 > len(stops)
    return int(np.packbits(over, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fp`` (the fingerprint's bits as a signed long), one row per document."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(x.as_py()) for x in batch.column("text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps)], ["doc_id", "fp"])

    return arrow_map(docs.select("doc_id", "text"), made, f"doc_id {kind}, fp long")


def _keys() -> Column:
    """Array of ``key``: segment, deleted bit (32: none) and the half without that bit."""
    low = F.lit(0xFFFFFFFF)
    halves = (F.col("fp").bitwiseAND(low), F.shiftrightunsigned("fp", 32))
    parts = []
    for segment, half in enumerate(halves):
        for bit in range(33):
            mark = (segment * 33 + bit) << 32
            parts.append(half.bitwiseAND(F.lit(0xFFFFFFFF ^ (1 << bit) if bit < 32 else 0xFFFFFFFF)).bitwiseOR(F.lit(mark)))
    return F.array(*parts)


def _compare(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Links among the members of each key; ``v`` is null for members that go the exact way.

    Rows come sorted by key.  At most ``most`` members are held; the first and the last
    key of the partition may continue in another one, so their members go the exact way.
    """
    key, members, first, many = None, [], True, False
    us: list[int] = []
    vs: list[int | None] = []

    def close(edge: bool) -> None:
        nonlocal many
        if members and (many or edge):
            us.extend(members)
            vs.extend([None] * len(members))
        elif len(members) > 1:
            x = np.array(members, np.int64).view(np.uint64)
            different = np.bitwise_count(x[:, None] ^ x[None, :])
            bit = (key >> 32) % 33
            ok = np.triu(different <= 2, 1)
            if bit < 32:
                at = np.uint64(bit + 32 * ((key >> 32) // 33))
                has = (x >> at) & np.uint64(1)
                ok &= has[:, None] != has[None, :]
            for i, j in zip(*np.nonzero(ok), strict=True):
                us.append(members[i])
                vs.append(members[j])

    def flushed() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], ["u", "v"])
        us.clear()
        vs.clear()
        return batch

    for batch in batches:
        for k, fp in zip(batch.column("key").to_pylist(), batch.column("fp").to_pylist(), strict=True):
            if k != key:
                close(first)
                first = first and key is None
                key, many = k, False
                members.clear()
            if len(members) == most:  # pass them on and hold the rest only
                many = True
                us.extend(members)
                vs.extend([None] * len(members))
                members.clear()
            members.append(fp)
        if len(us) > 50_000:
            yield flushed()
    close(True)
    yield flushed()


def links(distinct: DataFrame) -> DataFrame:
    """Links ``u, v`` among the distinct fingerprints ``fp``, enough for the exact components."""
    keyed, most = distinct.select("fp", F.explode(_keys()).alias("key")), MOST_MEMBERS
    tried = cut(arrow_map(keyed.repartitionByRange("key", "fp").sortWithinPartitions("key", "fp"), lambda batches: _compare(batches, most), "u long, v long"), "links")
    rest = tried.where("v is null").select("u").distinct()
    variants = F.array(F.col("u"), *(F.col("u").bitwiseXOR(F.lit(1 << b if b < 63 else -(1 << 63))) for b in range(64)))
    # 65 members of a word at most.
    words = rest.select("u", F.explode(variants).alias("word")).groupBy("word").agg(F.collect_set("u").alias("all")).where(F.size("all") > 1)
    star = words.select(F.explode("all").alias("u"), F.array_min("all").alias("v")).where("u <> v")
    return tried.where("v is not null").union(star)


def _classes(found: DataFrame) -> DataFrame:
    """One row per fingerprint: ``fp, n`` (its documents), ``least`` (their least id) and ``root``, its component's fingerprint."""
    classes = cut(found.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "classes")
    roots = cut(components(links(classes.select("fp"))), "roots")
    return classes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "n", "least", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, fp, component_id`` for every document."""
    found = cut(fingerprints(docs), "fingerprints")
    classes = cut(_classes(found), "rooted")
    named = classes.join(classes.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "n", "component_id")
    return join_hot(found, named, "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` without near-duplicates: of each component one row stays, by least id, then by hash of its text.

    A null id comes after all others.  Rows with equal id and text can't be told apart, so any one
    of them stays.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("key"))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(x.as_py()) for x in batch.column("text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), pa.array(fps)], ["doc_id", "key", "fp"])

    found = cut(arrow_map(keyed, made, f"doc_id {kind}, key long, fp long"), "fingerprints")
    # Rows of one fingerprint first meet in partial aggregates, so a hot one is no task's work.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")).alias("first")
    by_fp = found.groupBy("fp").agg(first)
    roots = _classes(found).select("fp", "root")
    keep = by_fp.join(roots, "fp").groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.doc_id").alias("_id"), F.col("first.key").alias("_key"))
    counted = found.groupBy("doc_id", "key").count()
    stays = F.col("_key").isNotNull()
    judged = cut(counted.join(keep, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")), "left").where(~stays | (F.col("count") > 1)).select("doc_id", "key", stays.alias("stays")), "judged")
    goes = F.broadcast(judged) if judged.count() <= MOST_BROADCAST else judged
    again = judged.where("stays")
    rows = wrapped(docs, id=F.col("doc_id"), key=F.xxhash64("text"))
    met = lambda other: rows["id"].eqNullSafe(other["doc_id"]) & (rows["key"] == other["key"])
    single = rows.join(goes, met(goes), "left_anti").select("row.*")
    several = rows.join(again, met(again), "left_semi").groupBy("id", "key").agg(F.first("row").alias("row")).select("row.*")
    return single.unionAll(several)
