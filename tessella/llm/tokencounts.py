"""Token counts by overlap resynchronisation.

Texts up to ``CHUNK`` characters are encoded whole.  A longer one is cut into chunks that overlap;
each is encoded with offsets on its own, and neighbours are spliced at a place where both begin a
piece.  Such a place is stable: the pre-tokenizer only looks ahead, so equal text from a common
boundary on gives equal pieces, and the left chunk is right up to there as long as the place lies
``GUARD`` characters before the chunk's end (which also holds any string of a special token).  If
the overlap has no common boundary, the left chunk is encoded again with twice the overlap, up to
the end of the text, so the count is that of the whole text in any case, in bounded memory.

Null text is empty; repeated rows are counted each for itself; a null doc_id stays null; other
columns are not looked at.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.functions.workers import arrow_map
from tessella.llm import fasttokens

CHUNK, OVERLAP, GUARD = 16_384, 512, 64


def count(tokenizer: fasttokens.PieceTokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> tuple[int, int]:
    """Tokens of ``text``, and how often an overlap had to be widened."""
    if len(text) <= chunk + overlap:
        return len(tokenizer.ids(text)) // 4, 0
    total, widened = 0, 0
    at, begun, end = 0, 0, chunk + overlap  # the left chunk is text[at:end]; its tokens count from begun on
    left = tokenizer.pieces(text[:end])
    while end < len(text):
        reach, splice = overlap, None
        while True:
            start = end - reach
            stop = min(len(text), end + chunk)
            right = tokenizer.pieces(text[start:stop])
            splice = _splice(text, (at, left[0]), (start, right[0]), end)
            if splice is not None:
                break
            widened += 1
            reach *= 2
            end = min(len(text), end + reach)
            left = tokenizer.pieces(text[at:end])
            if end == len(text):
                break
        if splice is None:
            break
        total += _between(at, *left, begun, splice)
        at, begun, end, left = start, splice, stop, right
    return total + _between(at, *left, begun, len(text) + 1), widened


def _between(at: int, starts: list[int], counts: list[int], low: int, high: int) -> int:
    return sum(n for s, n in zip(starts, counts, strict=True) if low <= at + s < high)


def _splice(text: str, left: tuple[int, list[int]], right: tuple[int, list[int]], end: int) -> int | None:
    """The first place of the overlap where both chunks, given as origin and starts, begin a piece."""
    edges = {left[0] + s for s in left[1]}
    for s in right[1]:
        place = right[0] + s
        if s >= GUARD and place <= end - GUARD and place in edges and not unicodedata.category(text[place]).startswith("M"):
            return place
    return None


def token_counts(docs: DataFrame, path: str, limit: int = 2048, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_tokens, over_limit, n_widened``."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = fasttokens.load(path)
        for batch in batches:
            found = [count(tokenizer, x.as_py(), chunk, overlap) for x in batch.column("text")]
            n = pa.array([x[0] for x in found], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), n, pa.array([x[1] for x in found], pa.int64())], ["doc_id", "n_bytes", "n_tokens", "n_widened"])

    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    done = arrow_map(rows, counted, f"doc_id {kind}, n_bytes long, n_tokens long, n_widened long")
    return done.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "n_widened")
