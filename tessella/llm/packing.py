"""Best-fit packing with large-item matching, planned on the histogram of lengths.

Lengths are whole numbers up to the capacity, so how many pieces have each length says all that a
packing needs: the plan is made on that histogram (``capacity`` counts, whatever the corpus) and
yields patterns with multiplicities, and pieces take their slots by rank within their length.

1. Pieces above a third of the capacity fit at most two in a sequence: from the longest down, each
   is matched with the longest other large piece that still fits.
2. Smaller pieces, longest first, go where the least gap is left that holds them (best fit); a
   sequence that still has the least fitting gap takes the next one too.

Documents are cut into pieces of ``capacity`` ids, of which the first takes the remainder.  Ranks
come from counts per file part and length, so no length gathers in one task.

Null text is empty, so it has the end id only; repeated rows and null ids are packed like any
others; other columns are not looked at; an empty table packs into nothing.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.functions.workers import arrow_map
from tessella.llm import fasttokens
from tessella.llm.shared import cut


def split(n: int, capacity: int) -> list[int]:
    """Lengths of the pieces of ``n`` ids: the first takes the remainder."""
    first = n % capacity or capacity
    return [n] if n <= capacity else [first] + [capacity] * ((n - first) // capacity)


def pieces(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, part, local_rank``.

    ``local_rank`` counts the pieces of the same length before it in its part.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, part = fasttokens.load(path), TaskContext.get().partitionId()
        last, seen = end_id.to_bytes(4, "little"), [0] * (capacity + 1)
        for batch in batches:
            rows: list[tuple] = []
            index: list[int] = []
            for i, text in enumerate(batch.column("text")):
                ids = memoryview(tokenizer.ids(text.as_py()) + last)
                start = 0
                for k, length in enumerate(split(len(ids) // 4, capacity)):
                    rows.append((k, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), seen[length]))
                    index.append(i)
                    seen[length] += 1
                    start += length
            columns = list(zip(*rows, strict=True)) or [()] * 5
            out = [batch.column("doc_id").take(pa.array(index, pa.int32())), pa.array(columns[0], pa.int32()), *(pa.array(c, pa.int64()) for c in columns[1:4]), pa.array([part] * len(rows), pa.int32()), pa.array(columns[4], pa.int64())]
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "piece", "start", "length", "ids_crc32", "part", "local_rank"])

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return arrow_map(rows, made, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, part int, local_rank long")


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns as ``(sequences, [(length, times), ...])`` that hold ``counts`` pieces of each length."""
    left = {n: c for n, c in counts.items() if c > 0}
    groups: dict[int, list[list]] = {}  # gap -> [sequences, runs]

    def put(gap: int, sequences: int, runs: list[tuple[int, int]]) -> None:
        groups.setdefault(gap, []).append([sequences, runs])

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        a = large[-1]
        at = bisect.bisect_right(large, capacity - a) - 1
        if at < 0:
            put(capacity - a, left[a], [(a, 1)])
            left[a] = 0
        else:
            b = large[at]
            if b == a and left[a] == 1:
                at -= 1
                if at < 0:
                    put(capacity - a, 1, [(a, 1)])
                    left[a] = 0
                    large.pop()
                    continue
                b = large[at]
            n = left[a] // 2 if b == a else min(left[a], left[b])
            put(capacity - a - b, n, [(a, 2)] if b == a else [(a, 1), (b, 1)])
            left[a] -= n
            left[b] -= n
        large = [n for n in large if left[n] > 0]

    gaps = sorted(groups)
    for length in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        n = left[length]
        while n > 0:
            at = bisect.bisect_left(gaps, length)
            if at == len(gaps):
                each = capacity // length
                full, rest = divmod(n, each)
                new = [(full, each), (1 if rest else 0, rest)]
                n = 0
                base: list[tuple[int, int]] = []
                gap = capacity
            else:
                gap = gaps[at]
                sequences, base = groups[gap].pop()
                if not groups[gap]:
                    del groups[gap]
                    gaps.pop(at)
                each = gap // length
                full = min(sequences, n // each)
                rest = 0 if full == sequences else n - full * each
                n -= full * each + rest
                new = [(full, each), (1 if rest else 0, rest), (sequences - full - (1 if rest else 0), 0)]
            for sequences, times in new:
                if sequences:
                    room = gap - times * length
                    if room not in groups:
                        bisect.insort(gaps, room)
                    put(room, sequences, base + ([(length, times)] if times else []))
    return [(sequences, runs) for found in groups.values() for sequences, runs in found]


def slots(patterns: list[tuple[int, list[tuple[int, int]]]]) -> list[tuple[int, int, int, int, int, int]]:
    """Rows ``(length, low, high, times, base, offset)``: pieces of ``length`` with ranks in
    ``[low, high)`` fill the patterns' sequences from ``base`` on, ``times`` to each, from ``offset``."""
    rows, taken, base = [], {}, 0
    for sequences, runs in patterns:
        offset = 0
        for length, times in runs:
            low = taken.get(length, 0)
            taken[length] = low + sequences * times
            rows.append((length, low, taken[length], times, base, offset))
            offset += length * times
        base += sequences
    return rows


def pack(found: DataFrame, capacity: int = 1024) -> DataFrame:
    """``found`` (written rows of :func:`pieces`) with ``sequence_id`` and ``offset``."""
    spark = found.sparkSession
    by_part = cut(found.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    counts = {r[0]: r[1] for r in by_part.groupBy("length").agg(F.sum("n")).collect()}  # capacity rows at most
    rows = slots(plan(counts, capacity))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = found.join(by_part.select("part", "length", before.alias("before")), ["part", "length"]).withColumn("rank", F.col("before") + F.col("local_rank"))
    # The slots are bounded by the capacity, not by the corpus.
    table = spark.createDataFrame(rows, "slot_length long, low long, high long, times long, base long, offset_base long")
    fits = (F.col("length") == F.col("slot_length")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    nth = F.col("rank") - F.col("low")
    return ranked.join(F.broadcast(table), fits).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.floor(nth / F.col("times"))).cast("long").alias("sequence_id"), (F.col("offset_base") + nth % F.col("times") * F.col("length")).cast("long").alias("offset"))
