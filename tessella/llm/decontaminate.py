"""Benchmark decontamination by a prefix-filtered join of word shingles [native].

An item's windows are its runs of ``WINDOW`` words (or the whole item, if shorter); a document is
contaminated where a window occurs word for word.  A window can only occur where each of its
shingles (``SHINGLE`` words) occurs, so one necessary shingle per window suffices to find it:

1. one pass over the documents keeps the places of item shingles, and the words around them, by a
   broadcast join of their hashes; nothing else of a text is written;
2. occurrences in these places order shingles by rarity; a window with a shingle that no document
   holds cannot occur and goes, and each other keeps its rarest shingle, the prefix, with its
   offset in the window;
3. places are joined with the prefixes by shingle hash; the window must lie inside the document
   (length and positional bounds), and its words must be equal to those there.

Hashes only choose candidates; equality is decided on words.  The broadcast holds ``MOST_BROADCAST``
shingles; the items' shingles are dealt to as many blocks as that takes, with a pass for each.

Defined cases: null or wordless texts have no words, windows or hits; items with a null item_id
are dropped; equal rows (doc_id and text) have equal results and are returned once each; a null
doc_id stays null; other columns of ``docs`` and ``items`` are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.llm.shared import ascii_lower, cut, let, wrapped

#: Between words, once A-Z are lower case.
NO_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
WINDOW, SHINGLE = 10, 5
#: Most shingles, prefix rows or contaminated documents that are broadcast: some 100 MB.
MOST_BROADCAST = 1_000_000


def item_words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NO_WORD), "")


def _shingles(hashes: Column, length: int) -> Column:
    """Hashes of all runs of ``length`` word hashes, in order."""
    starts = F.slice(hashes, 1, F.greatest(F.lit(0), F.size(hashes) - (length - 1)))
    return F.transform(starts, lambda x, i: F.xxhash64(F.lit(length), x, *(F.get(hashes, i + j) for j in range(1, length))))


def _word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows of the items: ``words, items`` (sorted item ids as strings)."""
    w = items.where(F.col("item_id").isNotNull()).select(F.col("item_id").cast("string").alias("item"), item_words(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - (window - 1)))
    each = w.select("item", F.explode(F.transform(starts, lambda s: F.slice("w", s, window))).alias("words"))
    return each.groupBy("words").agg(F.sort_array(F.collect_set("item")).alias("items"))


def _window_shingles(found: DataFrame) -> DataFrame:
    """One row per window and shingle: ``words, items, length, offset, h``."""
    by_length = lambda h: F.when(F.size(h) >= SHINGLE, _shingles(h, SHINGLE)).otherwise(F.coalesce(*(F.when(F.size(h) == n, _shingles(h, n)) for n in range(1, SHINGLE))))
    return found.select("words", "items", F.least(F.lit(SHINGLE), F.size("words")).alias("length"), F.posexplode(let(_word_hashes(F.col("words")), by_length)).alias("offset", "h"))


#: Stands for a document's own row among its shingles.
OWN = -1


def _placed(docs: DataFrame, wanted: DataFrame, lengths: list[int]) -> DataFrame:
    """Places of the shingles ``wanted`` (column ``h``), and one row of each document with ``p`` null if OWN is among them."""

    def tagged(hashes: Column) -> Column:
        of = lambda n: F.transform(_shingles(hashes, n), lambda h, p: F.struct(h.alias("h"), p.alias("p")))
        own = F.array(F.struct(F.lit(OWN).cast("long").alias("h"), F.lit(None).cast("int").alias("p")))
        return F.concat(own, *(of(n) for n in lengths))

    both = lambda w: F.struct(w.alias("words"), let(_word_hashes(w), tagged).alias("s"))
    one = docs.select("doc_id", F.xxhash64("text").alias("key"), let(item_words(F.col("text")), both).alias("d"))
    each = one.select("doc_id", "key", F.col("d.words").alias("words"), F.explode("d.s").alias("s")).select("doc_id", "key", "words", "s.h", "s.p")
    met = each.join(F.broadcast(wanted), "h")
    # Words are cut from the text only where a shingle was met: enough for any window it is part of.
    low = F.greatest(F.lit(0), F.col("p") - (WINDOW - 1))
    near = F.when(F.col("p").isNotNull(), F.slice("words", low + 1, 2 * WINDOW))
    return met.select("doc_id", "key", F.when(F.col("p").isNull(), F.size("words")).alias("n_words"), "h", "p", low.alias("from"), near.alias("near"))


def places(docs: DataFrame, shingles: DataFrame) -> DataFrame:
    """Written rows ``doc_id, key, n_words, h, p, from, near``: each document's own (``p`` null), and its item shingles."""
    keys = cut(shingles.select("h").distinct(), "shingles")
    blocks = -(-keys.count() // MOST_BROADCAST) or 1
    lengths = sorted(r[0] for r in shingles.select("length").distinct().collect())  # SHINGLE rows at most
    own = docs.sparkSession.range(1).select(F.lit(OWN).cast("long").alias("h"))
    found = None
    for block in range(blocks):
        wanted = keys if blocks == 1 else keys.where(F.pmod("h", F.lit(blocks)) == block)
        wanted = wanted.where(F.col("h") != OWN).union(own) if block == 0 else wanted.where(F.col("h") != OWN)
        part = _placed(docs, wanted, lengths)
        found = part if found is None else found.union(part)
    return cut(found, "places")


def prefixes(held: DataFrame, shingles: DataFrame) -> DataFrame:
    """The windows that may occur by their rarest shingle: ``h, windows`` of ``(offset, words, items)``."""
    counted = held.where("p is not null").groupBy("h").agg(F.count("*").alias("holders"))
    ranked = shingles.join(counted, "h", "left")
    chosen = ranked.groupBy("words", "items").agg(F.count("holders").alias("held"), F.count("*").alias("all"), F.min_by(F.struct("h", "offset"), F.struct("holders", "h", "offset")).alias("prefix"))
    whole = chosen.where("held = all").select(F.col("prefix.h").alias("h"), F.struct(F.col("prefix.offset").alias("offset"), "words", "items").alias("w"))
    return cut(whole.groupBy("h").agg(F.collect_list("w").alias("windows")), "prefixes")


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, key, n_words, hits, items``.

    ``key`` is the text's hash, ``hits`` are the distinct ``(start, length)`` of occurring windows
    in words, sorted; ``items`` the sorted ids, as strings, of the items they belong to.
    """
    shingles = cut(_window_shingles(windows(items)), "windows")
    held = places(docs, shingles)
    wanted = prefixes(held, shingles)
    wanted = F.broadcast(wanted) if wanted.count() <= MOST_BROADCAST else wanted
    tried = held.where("p is not null").drop("n_words").join(wanted, "h")
    sizes = held.where("p is null").select("doc_id", "key", F.col("n_words").cast("long").alias("n_words"))
    start = lambda w: F.col("p") - w["offset"]
    # A window that ends beyond the text finds too few words there, so the words decide that bound too.
    equal = lambda w: (start(w) >= 0) & (F.slice("near", F.greatest(F.lit(1), start(w) - F.col("from") + 1), F.size(w["words"])) == w["words"])
    found = F.transform(F.filter("windows", equal), lambda w: F.struct(start(w).alias("start"), F.size(w["words"]).alias("length"), w["items"].alias("items")))
    per = tried.select("doc_id", "key", found.alias("found")).where(F.size("found") > 0).groupBy("doc_id", "key").agg(F.flatten(F.collect_set("found")).alias("found"))
    spans = F.array_sort(F.array_distinct(F.transform("found", lambda x: F.struct(x["start"].alias("start"), x["length"].alias("length")))))
    named = F.array_sort(F.array_distinct(F.flatten(F.transform("found", lambda x: x["items"]))))
    hits = per.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), spans.alias("hits"), named.alias("items"))
    done = sizes.join(hits, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")), "left")
    none = lambda kind: F.expr(f"cast(array() as array<{kind}>)")
    return done.select("doc_id", "key", "n_words", F.coalesce("hits", none("struct<start:int,length:int>")).alias("hits"), F.coalesce("items", none("string")).alias("items"))


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a hit."""
    hit = cut(contamination(docs, items).where(F.size("hits") > 0).select("doc_id", "key").distinct(), "contaminated")
    hit = F.broadcast(hit) if hit.count() <= MOST_BROADCAST else hit
    rows = wrapped(docs, id=F.col("doc_id"), hash=F.xxhash64("text"))
    return rows.join(hit, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("key")), "left_anti").select("row.*")


def hit_words(hits: Column) -> Column:
    """Words inside any of the sorted ``(start, length)`` spans."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def add(a: Column, h: Column) -> Column:
        end = h["start"] + h["length"]
        return F.struct(F.greatest(a["end"], end).alias("end"), (a["n"] + F.greatest(F.lit(0), end - F.greatest(a["end"], h["start"]))).alias("n"))

    return F.aggregate(hits, start, add, lambda a: a["n"])
