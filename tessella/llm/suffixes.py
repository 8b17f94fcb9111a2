"""Repeated passages across documents, by sparse suffix arrays.

Words are runs of characters other than the six ASCII blanks.  Of all suffixes of a text only
those are retained that begin at a minimiser: the word place whose ``GRAM``-word hash is least in
a window of ``SPREAD`` neighbouring ones.  Equal passages choose equal places, so a passage of
``MIN_WORDS`` words, shared by two texts, has a retained suffix in its first ``SPREAD`` words in
both, and at least ``KEY_WORDS`` words of the passage follow there.

1. Retained suffixes are sorted over the cluster by a hash of their first ``KEY_WORDS`` words; those
   whose hash only one text has go.  Equal texts count as one text (by 64-bit hash) and are
   handled once.
2. The others get their contexts, ``MIN_WORDS`` words to the right and up to ``SPREAD`` to the left,
   which overlaps with the next retained suffix; so the union of matches of ``MIN_WORDS`` or more
   words covers a passage of any length.  They are sorted over the cluster by (hash, right, left
   read backwards), so that no frequent passage meets in one task.  Equal contexts lie side by side
   and become one node; where several texts have it, all its places match to both limits.
3. Nodes of a key that lies in one partition are settled there: neighbours are compared, and the
   match is extended right and left.  A neighbour on the right may differ on the left from a third
   one that would match longer, so nodes are sorted a second time by their left, which bounds the
   match on that side; where both bounds leave room, windows of ``MIN_WORDS`` words are compared.
4. Keys that go across a partition's edge meet again by key, nodes instead of suffixes, and are
   settled in the same way.  Keys of more than ``MOST_HELD`` nodes never meet: the MD5 of all windows
   of ``MIN_WORDS`` words in their nodes is compared over the cluster, which is exact as well.

A text that is itself held by several documents is a passage as a whole if it has MIN_WORDS words.

Defined cases: null or short texts have no passages; rows with equal doc_id count as one document,
so repeats among them are none, and a null doc_id is one document as well; other columns are not
looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.functions.workers import arrow_map
from tessella.llm.shared import blank_words, cut, join_hot

MIN_WORDS, GRAM, SPREAD = 50, 8, 30
KEY_WORDS = MIN_WORDS - SPREAD
#: Most texts whose ids are broadcast to leave out documents without a repeated suffix.
MOST_TEXTS = 1_000_000
#: Most nodes of a key that are held at once, and most that are compared pair by pair.
MOST_HELD, MOST_PAIRED = 8192, 16
#: Text bytes that are hashed at once.
CHUNK = 1 << 20
#: Order of contexts.
ORDER = ["key", "ahead", "behind", "text_id"]
_ODD = 0x9E3779B97F4A7C15
_BASE = 0xD6E8FEB86659FD93
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def _powers(base: int) -> np.ndarray:
    """``base`` to the power of 0 .. CHUNK, in 64 bits."""
    factors = np.full(CHUNK + 1, base, np.uint64)
    factors[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(factors, dtype=np.uint64)


_tables: list[np.ndarray] = []


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every word of the texts ``data[bounds[i]:bounds[i + 1]]``, in order.

    A word's hash is the polynomial of its bytes, from differences of running sums, so a chunk of
    many texts takes a few passes.  A word that goes on in the next chunk is carried over.
    """
    if not _tables:
        _tables.extend([_powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))])
    powers, inverse = _tables
    hashes, texts = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    carried, length = 0, 0
    low, end = int(bounds[0]), int(bounds[-1])
    edges = np.zeros(end - low + 1, bool)
    edges[bounds - low] = True  # texts begin and end here
    with np.errstate(over="ignore"):
        for at in range(low, end, CHUNK):
            part = data[at : min(end, at + CHUNK)]
            n = len(part)
            inside = ~_BLANK[part]
            first = inside.copy()
            first[1:] &= ~inside[:-1] | edges[at - low + 1 : at - low + n]
            last = inside.copy()
            last[:-1] &= first[1:] | ~inside[1:]
            starts, stops = np.flatnonzero(first), np.flatnonzero(last)
            if not len(starts):
                continue
            sums = np.cumsum((part.astype(np.uint64) + np.uint64(1)) * powers[:n])
            before = np.where(starts > 0, sums[starts - 1], np.uint64(0))
            found = (sums[stops] - before) * inverse[starts]
            number = np.searchsorted(bounds, at + starts, side="right") - 1
            if length and starts[0] == 0:
                found[0] = np.uint64((carried + pow(_BASE, length, 1 << 64) * int(found[0])) % (1 << 64))
            size = int(stops[-1] - starts[-1] + 1) + (length if len(starts) == 1 and starts[0] == 0 else 0)
            goes_on = stops[-1] == n - 1 and at + n < end and not edges[at + n - low] and not _BLANK[data[at + n]]
            carried, length = (int(found[-1]), size) if goes_on else (0, 0)
            hashes.append(found[:-1] if goes_on else found)
            texts.append(number[:-1] if goes_on else number)
    return np.concatenate(hashes), np.concatenate(texts)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _grams(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` word hashes: the sum of each, mixed, times a power of an odd number."""
    mixed = _mixed(hashes)
    total = np.zeros(len(hashes) - length + 1, np.uint64)
    factor = 1
    for j in range(length):
        total += mixed[j : j + len(total)] * np.uint64(factor)
        factor = factor * _ODD % (1 << 64)
    return _mixed(total)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the least value in every window of ``width``, the first of equals, by windows that double."""
    at, size = np.arange(len(values)), 1
    while size < width:
        step = min(size, width - size)
        left, right = at[:-step], at[step:]
        at = np.where(values[right] < values[left], right, left)
        size += step
    return at


def retained(hashes: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of words in order, those at which retained suffixes begin, and the hashes of the KEY_WORDS words there."""
    if len(hashes) < MIN_WORDS:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    with np.errstate(over="ignore"):
        places = _least(_grams(hashes, GRAM), SPREAD)
        keys = _grams(hashes, KEY_WORDS)
    # Windows lie in one text, which has MIN_WORDS words.
    n = len(places)
    whole = texts[:n] == texts[SPREAD + GRAM - 2 :][:n]
    long = np.bincount(texts, minlength=int(texts[-1]) + 1) >= MIN_WORDS
    places = np.unique(places[whole & long[texts[:n]]])
    places = places[places < len(keys)]
    places = places[texts[places] == texts[places + KEY_WORDS - 1]]
    return places, keys[places].view(np.int64)


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``key, text_id, place`` of the retained suffixes, for some texts at a time, straight from Arrow's buffers."""
    for batch in batches:
        column = batch.column("text")
        bounds = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
        ids = batch.column("text_id").to_numpy()
        low = 0
        while low < len(column):
            high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + CHUNK, side="right")) - 1)
            hashes, texts = word_hashes(data, bounds[low : high + 1])
            places, keys = retained(hashes, texts)
            at = texts[places]
            begins = np.searchsorted(texts, np.arange(high - low))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(ids[low:high][at]), pa.array((places - begins[at]).astype(np.int32))], ["key", "text_id", "place"])
            low = high


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by ``key, text_id, place``, those of keys that several texts have.

    The partition's first and last key may go on in another one, so their rows stay in any case.
    Held are the rows of one key while it has a single text, each place once.
    """
    held = np.empty((0, 3), np.int64)
    open_key, first = None, True

    def made(rows: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(rows[:, 0]), pa.array(rows[:, 1]), pa.array(rows[:, 2].astype(np.int32))], ["key", "text_id", "place"])

    for batch in batches:
        rows = np.stack([batch.column(n).to_numpy().astype(np.int64) for n in ("key", "text_id", "place")], axis=1)
        if not len(rows):
            continue
        if open_key is not None:
            same = int(np.searchsorted(rows[:, 0], open_key, side="right"))
            if same:
                yield made(rows[:same])
            rows = rows[same:]
            if not len(rows):
                continue
            open_key = None
        rows = np.concatenate([held, rows])
        starts = np.concatenate([[0], np.flatnonzero(np.diff(rows[:, 0])) + 1])
        ends = np.append(starts[1:], len(rows))
        several = rows[starts, 1] != rows[ends - 1, 1]
        several[0] |= first
        first = first and len(starts) == 1
        done = np.repeat(several[:-1], (ends - starts)[:-1])
        closed = rows[: starts[-1]][done]
        held = rows[starts[-1] :]
        if len(closed):
            yield made(closed)
        if several[-1]:
            yield made(held)
            open_key, held, first = int(held[0, 0]), held[:0], False
        else:
            held = np.unique(held, axis=0)
    if len(held):
        yield made(held)


def _written(words: list[bytes]) -> bytes:
    """Words with a blank behind each, so that bytes sort texts with equal first words side by side."""
    return b"".join(w + b" " for w in words)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the kept suffixes of each text: the words to the right, those to the left read backwards, and the places.

    Places of a text with equal contexts are one row, as far as some thousand contexts are held.
    """
    types = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.list_(pa.int32())]
    held: dict[tuple, list[int]] = {}

    def made() -> pa.RecordBatch:
        columns = list(zip(*((k, a, b, t, p) for (k, a, b, t), p in held.items()), strict=True)) or [()] * len(types)
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [*ORDER, "places"])

    for batch in batches:
        lists, ids = batch.column("kept"), batch.column("text_id").to_pylist()
        ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        places, keys = (lists.flatten().field(n).to_numpy() for n in ("place", "key"))
        for i, text_id in enumerate(ids):
            words = batch.column("text")[i].as_py().encode().split()
            for p, key in zip(places[ends[i] : ends[i + 1]].tolist(), keys[ends[i] : ends[i + 1]].tolist(), strict=True):
                if min(p, SPREAD) + min(len(words) - p, MIN_WORDS) >= MIN_WORDS:  # else no passage is long enough here
                    context = key, _written(words[p : p + MIN_WORDS]), _written(words[max(0, p - SPREAD) : p][::-1]), text_id
                    held.setdefault(context, []).append(p)
                if len(held) >= 4000:
                    yield made()
    yield made()


def _common(a: list[bytes], b: list[bytes]) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


class _Node:
    """A context: the text that has it (None: several) and where; words matched to the left and right; the longest run on the right."""

    __slots__ = ("after", "ahead", "before", "behind", "places", "raw", "reach", "text")

    def __init__(self, ahead: bytes, behind: bytes, text: int | None, places: list[int]):
        self.raw, self.text, self.places = (ahead, behind), text, places
        self.ahead, self.behind = ahead.split(), behind.split()
        self.before = self.after = self.reach = 0


def _pair(a: _Node, b: _Node) -> None:
    """Take the match of two nodes into both."""
    right, left = _common(a.ahead, b.ahead), _common(a.behind, b.behind)
    for x in (a, b):
        x.reach = max(x.reach, right)
        if right + left >= MIN_WORDS:
            x.before, x.after = max(x.before, left), max(x.after, right)


def _in_turn(nodes: list[_Node]) -> Iterator[tuple[_Node, _Node]]:
    """Each node, in an order, with the nearest one of another text before it, and with the nearest behind it."""
    for line in (nodes, nodes[::-1]):
        other: _Node | None = None
        for last, x in zip([None, *line], line, strict=False):
            if last is not None and (last.text is None or last.text != x.text):
                other = last
            if other is not None:
                yield x, other


def _settle(nodes: list[_Node], most_paired: int) -> None:
    """Find how far each node of one whole key matches another text; nodes come sorted by what is ahead."""
    if len(nodes) <= most_paired:
        for i, a in enumerate(nodes):
            for b in nodes[:i]:
                if a.text is None or a.text != b.text:
                    _pair(a, b)
        return
    for x, other in _in_turn(nodes):
        _pair(x, other)
    left = dict.fromkeys(map(id, nodes), 0)
    for x, other in _in_turn(sorted(nodes, key=lambda x: x.behind)):
        left[id(x)] = max(left[id(x)], _common(x.behind, other.behind))
    # A window with n words to the left can only be shared if others share n there and the rest ahead.
    unsure: dict[int, list[_Node]] = {}
    for x in nodes:
        for n in range(max(0, MIN_WORDS - x.reach), min(left[id(x)], SPREAD) + 1):
            if x.text is not None and (n > x.before or MIN_WORDS - n > x.after):
                unsure.setdefault(n, []).append(x)
    for n, wanted in unsure.items():
        seen: dict[bytes, int | None] = {}
        window = lambda x, n=n: _written(x.behind[:n]) + b" " + _written(x.ahead[: MIN_WORDS - n])
        for x in nodes:
            if len(x.behind) >= n and len(x.ahead) >= MIN_WORDS - n:
                own = window(x)
                seen[own] = x.text if seen.get(own, x.text) == x.text else None  # None: several texts
        for x in wanted:
            if seen[window(x)] is None:
                x.before, x.after = max(x.before, n), max(x.after, MIN_WORDS - n)


COMPARED = "text_id long, start int, end int, key long, ahead binary, behind binary, places array<int>"


def _settled(whole: bool, most_held: int, most_paired: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Settle keys of rows ``key, ahead, behind, text_id, places`` in :data:`ORDER`.

    Two kinds of rows come out: spans ``text_id, start, end`` of matches, and, unless all keys are
    ``whole``, the nodes of keys that may go on in another partition or have over ``most_held`` nodes.
    """
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        nodes: list[_Node] = []
        key, first, big = None, True, False

        def spans(text: int | None, places: list[int], before: int, after: int) -> None:
            out.extend((text, p - before, p + after, None, None, None, None) for p in places)

        def leave() -> None:
            out.extend((x.text, None, None, key, *x.raw, x.places) for x in nodes)

        def close(edge: bool) -> None:
            if (edge and not whole) or big:
                leave()
            else:
                _settle(nodes, most_paired)
                for x in nodes:
                    if x.text is not None and x.before + x.after:
                        spans(x.text, x.places, x.before, x.after)
            nodes.clear()

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * len(types)
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [c.split(" ")[0] for c in COMPARED.split(", ")])
            out.clear()
            return batch

        for batch in batches:
            for k, ahead, behind, text, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k != key:
                    if key is not None:
                        close(first)
                        first = False
                    key, big = k, False
                last = nodes[-1] if nodes else None
                if last is None or last.raw != (ahead, behind):
                    if len(nodes) >= most_held:
                        leave()
                        nodes.clear()
                        big = True
                    nodes.append(_Node(ahead, behind, text, places))
                elif text is not None and text == last.text:
                    last.places.extend(places)
                else:  # a context of several texts matches as far as it goes
                    for t, p in ((last.text, last.places), (text, places)):
                        spans(t, p, len(last.behind), len(last.ahead))
                    last.text, last.places = None, []
            if len(out) > 20_000:
                yield flushed()
        if key is not None:
            close(True)
        yield flushed()

    return run


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, bytes, int, list[int]]]:
    """Text (None: several), MD5, words to the left and places of each window of MIN_WORDS words that holds a node's first word."""
    for batch in batches:
        for ahead, behind, text, places in zip(*(batch.column(n).to_pylist() for n in ("ahead", "behind", "text_id", "places")), strict=True):
            left = behind.split()[::-1]
            words = left + ahead.split()
            for i in range(min(len(left), len(words) - MIN_WORDS) + 1):
                yield text, hashlib.md5(b" ".join(words[i : i + MIN_WORDS])).digest(), len(left) - i, places


def _window_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``window, a, b, n``: least and greatest text of each window and its places, for some 100,000 windows at a time."""
    seen: dict[bytes, tuple[int, int, int]] = {}
    every = (-(1 << 63), (1 << 63) - 1)

    def made() -> pa.RecordBatch:
        columns = [pa.array(seen, pa.binary()), *(pa.array([v[k] for v in seen.values()], pa.int64()) for k in range(3))]
        seen.clear()
        return pa.RecordBatch.from_arrays(columns, ["window", "a", "b", "n"])

    for text, window, _, places in _windows(batches):
        low, high = every if text is None else (text, text)
        least, most, n = seen.get(window, (low, high, 0))
        seen[window] = (min(least, low), max(most, high), n + len(places))
        if len(seen) >= 100_000:
            yield made()
    yield made()


def _window_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``window, text_id, start`` of every window of a node that one text has."""
    rows: list[tuple] = []

    def made() -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * 3
        rows.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.int32()), strict=True)], ["window", "text_id", "start"])

    for text, window, left, places in _windows(batches):
        if text is not None:
            rows.extend((window, text, p - left) for p in places)
        if len(rows) >= 20_000:
            yield made()
    yield made()


def passages(docs: DataFrame) -> DataFrame:
    """``doc_id, start, end, n_words`` of the repeated passages of every document, in words.

    Passages of a document that touch or overlap are one row.
    """
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_id"), F.coalesce("text", F.lit("")).alias("text"))
    words = F.when(F.length("text") >= 2 * MIN_WORDS - 1, F.size(blank_words(F.col("text")))).otherwise(0)
    members = cut(rows.select("doc_id", "text_id", words.alias("n")).groupBy("doc_id", "text_id").agg(F.first("n").alias("n")), "members")
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    texts = members.where(F.col("n") >= MIN_WORDS).groupBy("text_id").agg(F.min("doc_id").alias("rep"), F.min("n").alias("n"), (F.min(name) != F.max(name)).alias("shared"), F.count("*").alias("copies"))
    texts = cut(texts, "texts")

    anchors = cut(arrow_map(rows.select("text_id", "text"), _anchors, "key long, text_id long, place int"), "anchors")
    by_key = ["key", "text_id", "place"]
    repeated = arrow_map(anchors.repartitionByRange(*by_key).sortWithinPartitions(*by_key), _repeated, "key long, text_id long, place int")
    kept = cut(repeated.groupBy("text_id").agg(F.collect_set(F.struct("place", "key")).alias("kept")), "kept")
    one = kept.join(texts, "text_id").select(F.col("text_id").alias("__id"), "rep", "kept")
    wanted = kept.select(F.col("text_id").alias("__wanted"))
    some = rows.join(F.broadcast(wanted), F.col("text_id") == F.col("__wanted"), "left_semi") if kept.count() <= MOST_TEXTS else rows
    with_text = some.join(one, (F.col("text_id") == F.col("__id")) & F.col("doc_id").eqNullSafe(F.col("rep"))).select("text", "text_id", "kept")
    contexts = cut(arrow_map(with_text, _contexts, "key long, ahead binary, behind binary, text_id long, places array<int>"), "contexts", "zstd")

    within = arrow_map(contexts.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER), _settled(False, MOST_HELD, MOST_PAIRED), COMPARED)
    within = cut(within, "compared", "zstd")
    nodes = within.where("key is not null").select(*ORDER, "places")
    large = cut(nodes.groupBy("key").count().where(F.col("count") > MOST_HELD).select("key"), "large-keys")
    few = F.broadcast(large) if large.count() <= MOST_TEXTS else large
    rest = nodes.join(few, "key", "left_anti").repartition("key").sortWithinPartitions(*ORDER)
    across = cut(arrow_map(rest, _settled(True, MOST_HELD, MOST_PAIRED), COMPARED), "across")
    around = nodes.join(few, "key", "left_semi")
    twice = arrow_map(around, _window_texts, "window binary, a long, b long, n long").groupBy("window").agg(F.min("a").alias("a"), F.max("b").alias("b"), F.sum("n").alias("n")).where("a <> b").select("window", "n")
    tried = arrow_map(around, _window_places, "window binary, text_id long, start int")
    exact = join_hot(cut(tried, "tried"), cut(twice, "shared"), "window").select("text_id", "start", (F.col("start") + MIN_WORDS).cast("int").alias("end"))
    whole = texts.where("shared").select("text_id", F.lit(0).alias("start"), F.col("n").alias("end"))
    spans = within.where("start is not null").union(across.where("start is not null")).select("text_id", "start", "end").union(exact).union(whole)

    # Spans that touch or overlap are one: a span begins a new one where it starts beyond all before.
    order = Window.partitionBy("text_id").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = spans.distinct().withColumn("new", F.when(F.col("start") <= reach, 0).otherwise(1))
    of_text = marked.withColumn("run", F.sum("new").over(order)).groupBy("text_id", "run").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("run")
    # One row a text, so that those of a text with many documents meet a broadcast.
    packed = of_text.groupBy("text_id").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    counted = cut(packed.join(texts.select("text_id", F.col("copies").alias("n")), "text_id"), "passages")
    done = join_hot(members.select("doc_id", "text_id"), counted, "text_id").select("doc_id", F.explode("spans").alias("s"))
    return done.select("doc_id", "s.start", "s.end", (F.col("s.end") - F.col("s.start")).alias("n_words"))
