"""Helpers that the operators share: column idioms, and joins and counts that bear hot keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.sources.folders import _made, cut, new_folder, release, shared_dir

__all__ = ["_made", "ascii_lower", "blank_words", "cut", "earlier_in_group", "join_hot", "let", "new_folder", "prefix_sums", "release", "shared_dir", "wrapped"]

#: White space of the word contracts: the blank and \t \n \x0b \f \r.
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = "[\\x20\\x09-\\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it any number of times in ``body``, lambdas included."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, UPPER.lower())


def blank_words(text: Column) -> Column:
    """Array of the runs of characters other than :data:`BLANKS`; null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANK_RUN), "")


def prefix_sums(lengths: Column, block: int = 64) -> Column:
    """Array of the sums of all earlier items, for an array of longs.

    Two levels keep it near linear: sums of whole blocks are carried forward once, and each
    item adds up its own block only.
    """

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0).cast("long"), lambda a, x: a + x)

    def carried(sums: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("t"), F.expr("cast(array() as array<bigint>)").alias("a"))
        return F.aggregate(sums, start, lambda acc, x: F.struct((acc["t"] + x).alias("t"), F.concat(acc["a"], F.array(acc["t"])).alias("a")), lambda acc: acc["a"])

    def spread(items: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(items), F.lit(block))
        sums = F.transform(starts, lambda s: total(F.slice(items, s, block)))
        return let(carried(sums), lambda before: F.transform(items, lambda _, i: F.get(before, (i / block).cast("int")) + total(F.slice(items, i - i % block + 1, i % block))))

    return let(lengths, lambda items: F.when(F.size(items) > 0, spread(items)).otherwise(F.expr("cast(array() as array<bigint>)")))


def wrapped(df: DataFrame, **more: Column) -> DataFrame:
    """``df``'s columns as one struct ``row``, and further columns beside it.

    Whatever names ``df`` has, none clashes with an operator's own; ``select("row.*")`` restores them.
    """
    quoted = ("`" + c.replace("`", "``") + "`" for c in df.columns)
    return df.select(F.struct(*(df[c] for c in quoted)).alias("row"), *(v.alias(k) for k, v in more.items()))


#: A key with more than this share of the rows is hot; so there are few hot keys.
HOT_SHARE = 1000


def join_hot(rows: DataFrame, counted: DataFrame, key: str) -> DataFrame:
    """Inner join of ``rows`` with ``counted`` on ``key``, which ``counted`` has once, with its rows ``n``.

    Rows of hot keys (over a thousandth of all, so under a thousand keys) meet a broadcast table
    where they are; the others are shuffled.
    """
    total = F.broadcast(counted.agg(F.sum("n").alias("total")))
    marked = counted.join(total).withColumn("hot", F.col("n") * HOT_SHARE > F.col("total")).drop("total")
    hot = F.broadcast(marked.where("hot").drop("hot", "n"))
    rest = marked.where("not hot").drop("hot", "n")
    keys = F.broadcast(marked.where("hot").select(key))
    return rows.join(hot, key).unionByName(rows.join(keys, key, "left_anti").join(rest, key))


def earlier_in_group(rows: DataFrame, keys: list[str], at: str, order: list[str], value: Column, name: str, step: int = 256) -> DataFrame:
    """``rows`` with the sum of ``value`` over the earlier rows of the group ``keys``, in ``order``.

    ``order`` begins with the whole number ``at``.  A group is split by ``at`` into blocks of
    ``step``, whose sums are carried on in a second, much smaller window; so no group of many
    rows is one task's work.  ``rows`` is read twice.
    """
    block = F.floor(F.col(at) / step)
    tagged = rows.withColumn("_block", block)
    blocks = tagged.groupBy(*keys, "_block").agg(F.sum(value).alias("_sum"))
    within = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select(*(F.col(k).alias(f"_{k}") for k in keys), F.col("_block").alias("_b"), F.coalesce(F.sum("_sum").over(within), F.lit(0)).alias("_before"))
    same = F.col("_block").eqNullSafe(F.col("_b"))
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    inside = Window.partitionBy(*keys, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = tagged.join(carried, same, "left")
    return own.withColumn(name, F.col("_before") + F.coalesce(F.sum(value).over(inside), F.lit(0))).drop("_block", "_b", "_before", *(f"_{k}" for k in keys))
