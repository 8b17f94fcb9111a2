"""Quality rules whose cutoffs are chosen under a bound on false rejections [native].

Every document gets integer features (per mille shares, so results do not depend on rounding).
A *policy level* ``j`` in ``1..LEVELS`` sets one cutoff per rule, from lenient (1) to strict; a
document's ``reject_level`` is the first level at which any rule rejects it.  The grid of cutoffs
is fixed beforehand, so labelled rows serve wholly as the holdout.

For each stratum and level, the good holdout documents that the level rejects are a binomial
count ``k`` of ``n``.  A level is certified if ``P(Binomial(n, alpha) <= k)``, the exact p-value
of "the false rejection risk exceeds alpha", is at most ``delta`` divided by the number of strata
(Bonferroni); within a stratum, levels are tested from lenient to strict and testing stops at the
first failure (fixed sequence), which needs no further correction.  With probability ``1 - delta``
no stratum then loses more than ``alpha`` of its good documents.  Among certified levels the one
with the most rejected bad documents, less ``GOOD_COST`` times the rejected good ones, is used; a
stratum without a certified level rejects by the base rules alone.

The risk ``ALPHA`` is 3 per cent, which some 200 good labelled documents of a stratum can certify
if none is rejected; 1 per cent takes 436 with four strata.

Defined cases: null text has no words (so the base rules reject it); a null stratum counts as the
empty string; rows with a null doc_id are judged but never match a label; repeated rows are judged
each for itself; a document with several labels counts as good only if all say so; without labels
only the base rules reject; other columns, whatever their names, are untouched.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm.shared import BLANK_RUN, BLANKS, blank_words, cut, let, wrapped

#: Widest stratum table that is broadcast, in rows; beyond it the join is shuffled.
MOST_BROADCAST = 10_000
LEVELS = 40
ALPHA, DELTA, GOOD_COST = 0.03, 0.05, 10

#: Rule: feature in per mille, cutoff at the first level, step down to the next.
RULES = {
    "symbol_share": (400, 9),
    "upper_share": (900, 20),
    "shout_share": (400, 9),
    "dup_line_share": (950, 15),
}


def _count(text: Column, chars: str) -> Column:
    """How many characters of ``text`` are in the class ``chars`` of a regular expression."""
    return F.length(F.regexp_replace(text, f"[^{chars}]+", "")).cast("long")


def _repeat_words(words: Column) -> Column:
    """Words inside 8-word windows that occur twice or more; windows compare by 64-bit hash."""

    def spans(places: Column) -> Column:
        start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
        return F.aggregate(places, start, lambda a, p: F.struct((p + 8).alias("end"), (a["n"] + F.least(F.lit(8), p + 8 - a["end"])).alias("n")), lambda a: a["n"])

    def of(hashes: Column) -> Column:
        tagged = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
        same = lambda s, i: (F.get(s, i - 1)["h"] == F.get(s, i)["h"]) | (F.get(s, i + 1)["h"] == F.get(s, i)["h"])
        places = let(tagged, lambda s: F.transform(F.filter(s, lambda _, i: F.coalesce(same(s, i), F.lit(False))), lambda x: x["p"]))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(spans(F.sort_array(places)))

    def joined(step: int) -> Callable[[Column], Column]:
        return lambda h: F.transform(F.slice(h, 1, F.size(h) - step), lambda x, i: F.xxhash64(x, F.get(h, i + step)))

    # Windows of one, two, four and then eight words.
    singles = F.transform(words, lambda w: F.xxhash64(w))
    eights = let(let(let(singles, joined(1)), joined(2)), joined(4))
    return F.when(F.size(words) < 9, F.lit(0)).otherwise(let(eights, of))


def features(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    """``row, quality``: the columns of ``docs`` as a struct, and one of counts, reject level and stratum."""
    text = F.coalesce(F.col("text"), F.lit(""))
    share = lambda part, whole: F.when(whole > 0, F.floor(part * 1000 / whole)).otherwise(0).cast("long")
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")

    def counted(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.regexp_replace(text, BLANK_RUN, "")).cast("long").alias("word_chars"),
            _count(text, "#*$%&|<>").alias("n_symbols"),
            let(lines, lambda x: F.struct(F.size(x).cast("long").alias("all"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))).alias("lines"),
            _repeat_words(words).cast("long").alias("n_repeat_words"),
            _count(text, "A-Z").alias("n_upper"),
            _count(text, "!?").alias("n_shout"),
        )

    def judged(q: Column) -> Column:
        return F.struct(
            *(q[n].alias(n) for n in ("n_words", "word_chars", "n_symbols")),
            q["lines"]["dup"].alias("n_dup_lines"),
            q["n_repeat_words"],
            ((q["n_words"] < 20) | (100 * q["n_repeat_words"] > 30 * q["n_words"])).alias("base_failed"),
            share(q["n_symbols"], q["word_chars"]).alias("symbol_share"),
            share(q["n_upper"], q["word_chars"]).alias("upper_share"),
            share(q["n_shout"], q["word_chars"]).alias("shout_share"),
            share(q["lines"]["dup"], q["lines"]["all"]).alias("dup_line_share"),
        )

    def levelled(q: Column) -> Column:
        first = [F.when(q[r] > top - step * (LEVELS - 1), F.greatest(F.lit(1), F.floor((top - q[r]) / step).cast("int") + 2)).otherwise(LEVELS + 1) for r, (top, step) in RULES.items()]
        return F.struct(*(q[n].alias(n) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")), F.least(*first).cast("int").alias("reject_level"), F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"))

    return wrapped(docs, quality=let(let(let(blank_words(F.col("text")), counted), judged), levelled))


def _ln_factorial(x: Column) -> Column:
    """ln x!, by Stirling's series from 16 on (error below 1e-10) and by sums of logarithms below."""
    x = x.cast("double")
    series = x * F.log(x) - x + F.log(2 * F.pi() * x) / 2 + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * x * x * x * x * x)
    small = F.aggregate(F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.lit(16), x.cast("int")))), F.lit(0.0), lambda a, i: a + F.log(i.cast("double")))
    return F.when(x < 16, small).otherwise(series)


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(Binomial(n, p) <= k), for use where k is below n * p; 1 where it isn't.

    Terms more than ten roots of n below k add nothing that a double holds and are left out.
    """
    k, n = k.cast("long"), n.cast("long")

    def term(i: Column) -> Column:
        return F.exp(_ln_factorial(n) - _ln_factorial(i) - _ln_factorial(n - i) + i * F.log(F.lit(p)) + (n - i) * F.log(F.lit(1 - p)))

    low = F.greatest(F.lit(0).cast("long"), k - 10 * F.ceil(F.sqrt(n)).cast("long") - 100)
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.aggregate(F.sequence(low, k), F.lit(0.0), lambda a, i: a + term(i)))


def calibrate(judged: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """One row per stratum: ``stratum, level, n_good, k_good, n_bad, p_value`` (level 0: none certified).

    ``judged`` has the structs ``row`` (with doc_id) and ``quality``; ``labels`` has doc_id and quality (1 is good).
    """
    marks = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("good"))
    seen = judged.where(~F.col("quality.base_failed")).select("row.doc_id", "quality.stratum", "quality.reject_level").join(marks, "doc_id")
    counts = seen.groupBy("stratum", "reject_level").agg(F.sum(F.when(F.col("good") == 1, 1).otherwise(0)).alias("g"), F.sum(F.when(F.col("good") == 1, 0).otherwise(1)).alias("b"))
    # A row per stratum holds LEVELS + 1 counts at most, so the groups below are bounded.
    per = counts.groupBy("stratum").agg(F.sum("g").alias("n_good"), F.sum("b").alias("n_bad"), F.collect_list(F.struct("reject_level", "g", "b")).alias("rows"))
    upto = lambda name, j: F.aggregate(F.filter("rows", lambda r: r["reject_level"] <= j), F.lit(0).cast("long"), lambda a, r: a + r[name])
    tried = (
        per.join(F.broadcast(per.agg(F.count("*").alias("strata"))))  # one row
        .withColumn("level", F.explode(F.sequence(F.lit(1), F.lit(LEVELS))))
        .select("stratum", "strata", "n_good", "n_bad", "level", upto("g", F.col("level")).alias("k_good"), upto("b", F.col("level")).alias("k_bad"))
        .withColumn("p_value", F.when(F.col("n_good") > 0, binomial_cdf(F.col("k_good"), F.col("n_good"), alpha)).otherwise(1.0))
    )
    in_order = Window.partitionBy("stratum").orderBy("level")
    held = tried.withColumn("failed", F.max((F.col("p_value") > F.lit(delta) / F.col("strata")).cast("int")).over(in_order)).where("failed = 0")
    best = held.groupBy("stratum").agg(F.min_by(F.struct("level", "k_good", "k_bad", "p_value"), F.struct((F.col("k_good") * GOOD_COST - F.col("k_bad")).alias("loss"), F.col("level"))).alias("best"))
    return per.join(best, "stratum", "left").select("stratum", F.coalesce("best.level", F.lit(0)).alias("level"), "n_good", F.coalesce("best.k_good", F.lit(0)).alias("k_good"), "n_bad", F.coalesce("best.k_bad", F.lit(0)).alias("k_bad"), "best.p_value")


def apply_cutoffs(judged: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """``judged`` with ``cutoff`` and ``kept``: not failed by the base rules, nor rejected at its stratum's level."""
    few = cutoffs.select(F.col("stratum").alias("at"), F.col("level").alias("cutoff"))
    few = F.broadcast(few) if few.count() <= MOST_BROADCAST else few
    joined = judged.join(few, F.col("quality.stratum") == F.col("at"), "left").select("row", "quality", F.coalesce("cutoff", F.lit(0)).alias("cutoff"))
    return joined.withColumn("kept", ~F.col("quality.base_failed") & (F.col("quality.reject_level") > F.col("cutoff")))


def cutoffs_of(judged: DataFrame, labels: DataFrame) -> DataFrame:
    """:func:`calibrate` with its small result written, so that it is computed once."""
    return cut(calibrate(judged, labels), "quality-cutoffs")
