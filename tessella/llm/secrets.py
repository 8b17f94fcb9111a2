"""Secret scan: patterns plus a randomness test battery under false-discovery control [native].

Three pattern kinds (assign, access, hex) give the base spans.  Besides, every run of 20 or more
characters of base64's alphabets is a candidate.  Its encoding is inferred as the smallest
alphabet that holds all its characters (hex 16, base32 32, base36 36, base62 62, base64 64), and
three tests ask whether it is *nearly* random in that encoding; each takes clear structure as its
null hypothesis, so that a small p-value speaks for a random string and needs length to arise:

* chi-squared uniformity: the null is a distribution as uneven as the corpus's ordinary runs of the
  same alphabet size (noncentrality ``n`` times the median unevenness of its runs, and the spread
  of the more uneven half), but at least as half the alphabet left unused (noncentrality ``n``),
  approximated by a normal of the noncentral chi-squared's moments;
* runs above and below the middle of the alphabet: the null is a shift of ``EFFECT * sqrt(n)``;
* lag-one serial correlation: the null is a correlation of ``EFFECT`` in either direction.

The candidate's p-value is the largest of the three (intersection-union).  Over all candidates of
the corpus, Benjamini-Hochberg at rate ``FDR`` with weights in proportion to length decides which
become spans of kind ``random``; p-values are counted in ``64`` bins a decade, judged by each
bin's upper edge, so only a bounded histogram is gathered.

Offsets are code points, the end exclusive.  Null text is empty; repeated rows are scanned each
for itself; a null doc_id stays null; other columns, whatever their names, are untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm.shared import let, prefix_sums, wrapped

#: Kind, pattern, group measured, its least length.  Fixed values.
PATTERNS = (
    ("assign", "(?i:(password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
    ("access", "AKIA[A-Z0-9]+", 0, 18),
    ("hex", "[0-9a-f]{16,}", 0, 16),
)
KINDS = ("assign", "access", "hex", "random")
CANDIDATE = "[A-Za-z0-9+/_-]{20,}"

#: Encoding, pattern of the whole candidate, alphabet in order.
ENCODINGS = (
    ("hex", "[0-9a-f]+", "0123456789abcdef"),
    ("HEX", "[0-9A-F]+", "0123456789ABCDEF"),
    ("base32", "[A-Z2-7]+", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", "[0-9a-z]+", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("BASE36", "[0-9A-Z]+", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base62", "[0-9A-Za-z]+", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
    ("base64", "", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
)
EFFECT, FDR = 0.8, 0.05
BINS = 1024
#: Fewest runs of an alphabet size that a null is fitted to.
LEAST_RUNS = 20

#: Alphabet size, unevenness and spread of the nulls that are fitted.
Nulls = tuple[tuple[int, float, float], ...]

SPANS = "array<struct<start:bigint,kind:int,end:bigint>>"
CANDIDATES = "array<struct<start:bigint,end:bigint,n:int,k:int,chi:double,p:double>>"


def _matches(text: Column, pattern: str, group: int, made) -> Column:
    """Array of ``made(start, match, group's text)`` for the leftmost non-overlapping matches."""

    def placed(x: Column) -> Column:
        lengths = F.transform(x["m"], lambda m, i: (F.length(F.get(x["g"], i)) + F.length(m)).cast("long"))
        return let(prefix_sums(lengths), lambda before: F.transform(x["m"], lambda m, i: made(F.get(before, i) + F.length(F.get(x["g"], i)), m, F.get(x["v"], i))))

    found = F.struct(F.split(text, pattern, -1).alias("g"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("v"))
    return let(found, placed)


def base_spans(text: Column) -> Column:
    """Sorted array of ``(start, kind, end)`` of the three pattern kinds; kind indexes :data:`KINDS`."""
    parts = []
    for kind, (_, pattern, group, least) in enumerate(PATTERNS):

        def made(start: Column, match: Column, value: Column, kind: int = kind, least: int = least) -> Column:
            span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), (start + F.length(match)).cast("long").alias("end"))
            return F.when(F.length(value) >= least, span)

        spans = F.filter(_matches(text, pattern, group, made), lambda s: s.isNotNull())
        parts.append(F.when(text.rlike(pattern), spans).otherwise(F.array()).cast(SPANS))
    return F.sort_array(F.concat(*parts))


def normal_cdf(z: Column) -> Column:
    """P(N(0,1) <= z) by a rational Chebyshev fit of erfc, relative error below 1.2e-7."""
    fit = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277)

    def tail(x: Column) -> Column:
        t = 1 / (1 + 0.5 * x)
        power = F.lit(0.0)
        for c in reversed(fit):
            power = power * t + F.lit(c)
        return t * F.exp(power - x * x) / 2

    return let(F.abs(z) / F.lit(2.0**0.5), lambda x: F.when(z < 0, tail(x)).otherwise(1 - tail(x)))


def _measures(token: Column) -> Column:
    """Alphabet size, chi-squared and the larger p-value of the other two tests for one candidate."""

    def tests(x: Column) -> Column:
        n, k = x["n"], x["k"]
        mean = x["a"]["s"] / n
        chi = k / n * x["squares"] - n
        high, low = x["a"]["high"], n - x["a"]["high"]
        product = 2 * high * low
        spread = product * (product - n) / (n * n * (n - 1))
        runs = F.when(spread > 0, F.abs((x["a"]["runs"] - product / n - 1) / F.sqrt(F.when(spread > 0, spread))))
        centred = x["a"]["q"] - n * mean * mean
        cross = x["a"]["cross"] - mean * (2 * x["a"]["s"] - x["a"]["first"] - x["a"]["prev"]) + (n - 1) * mean * mean
        serial = F.when(centred > 0, F.abs(cross / F.when(centred > 0, centred)))
        p_runs = F.coalesce(normal_cdf(runs - EFFECT * F.sqrt(n)), F.lit(1.0))
        p_serial = F.coalesce(normal_cdf((serial - EFFECT) * F.sqrt(n)), F.lit(1.0))
        return F.struct(k.cast("int").alias("k"), chi.alias("chi"), F.greatest(p_runs, p_serial).alias("p"))

    def measured(x: Column) -> Column:
        half = x["k"] / 2
        zero = F.lit(0.0)
        start = F.struct(F.lit(-1.0).alias("prev"), zero.alias("first"), zero.alias("runs"), zero.alias("high"), zero.alias("s"), zero.alias("q"), zero.alias("cross"))

        def step(a: Column, v: Column) -> Column:
            new = a["prev"] < 0
            return F.struct(
                v.alias("prev"),
                F.when(new, v).otherwise(a["first"]).alias("first"),
                (a["runs"] + F.when(new | ((a["prev"] >= half) != (v >= half)), 1.0).otherwise(0.0)).alias("runs"),
                (a["high"] + F.when(v >= half, 1.0).otherwise(0.0)).alias("high"),
                (a["s"] + v).alias("s"),
                (a["q"] + v * v).alias("q"),
                (a["cross"] + F.when(new, 0.0).otherwise(a["prev"] * v)).alias("cross"),
            )

        # The sum of squared counts: each symbol adds twice its earlier count, plus one.
        counted = F.struct(F.lit(-1.0).alias("v"), zero.alias("run"), zero.alias("squares"))

        def count(a: Column, v: Column) -> Column:
            run = F.when(a["v"] == v, a["run"] + 1).otherwise(F.lit(0.0))
            return F.struct(v.alias("v"), run.alias("run"), (a["squares"] + 2 * run + 1).alias("squares"))

        n = F.size(x["i"]).cast("double")
        return F.struct(n.alias("n"), x["k"].alias("k"), F.aggregate(x["i"], start, step).alias("a"), F.aggregate(F.sort_array(x["i"]), counted, count, lambda a: a["squares"]).alias("squares"))

    plain = F.translate(token, "-_", "+/")
    alphabet = F.coalesce(*(F.when(token.rlike(f"^{p}$"), F.lit(a)) for _, p, a in ENCODINGS[:-1]), F.lit(ENCODINGS[-1][2]))
    coded = let(alphabet, lambda a: F.struct(F.length(a).cast("double").alias("k"), F.transform(F.split(plain, ""), lambda c: (F.position(c, a) - 1).cast("double")).alias("i")))
    return let(let(coded, measured), tests)


def candidates(text: Column) -> Column:
    """Array of ``(start, end, n, k, chi, p)`` of the runs that the test battery has measured."""

    def made(start: Column, match: Column, _: Column) -> Column:
        n = F.length(match)
        return let(_measures(match), lambda x: F.struct(start.alias("start"), (start + n).cast("long").alias("end"), n.alias("n"), x["k"].alias("k"), x["chi"].alias("chi"), x["p"].alias("p")))

    return F.when(text.rlike(CANDIDATE), _matches(text, CANDIDATE, 0, made)).otherwise(F.array()).cast(CANDIDATES)


def scan(docs: DataFrame) -> DataFrame:
    """``row, base, tested``: the columns of ``docs`` as a struct, base spans and measured candidates."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return wrapped(docs, base=base_spans(text), tested=candidates(text))


def _bin(p: Column, n: Column, mean_length: float) -> Column:
    adjusted = F.least(F.lit(1.0), p * mean_length / n)
    return F.when(adjusted <= 0, BINS).otherwise(F.least(F.lit(BINS), F.floor(-64 * F.log10(adjusted)))).cast("int")


def _z(n: Column, k: Column, chi: Column, uneven: Column) -> Column:
    """Chi-squared standardised by the null of an alphabet whose unevenness is ``uneven``."""
    return (chi - (k - 1 + n * uneven)) / F.sqrt(2 * (k - 1 + 2 * n * uneven))


def fitted_nulls(tested: DataFrame) -> Nulls:
    """Alphabet size, unevenness and spread of the runs ``n, k, chi``, by alphabet size."""
    uneven = (F.col("chi") - F.col("k") + 1) / (F.col("n") - 1)
    middle = tested.groupBy("k").agg(F.percentile_approx(uneven, 0.5, 10_000).alias("uneven"), F.count("*").alias("runs"))
    # A row for each alphabet size.
    found = {r.k: r.uneven for r in middle.collect() if r.runs >= LEAST_RUNS and r.uneven > 1}
    if not found:
        return ()
    z = _z(F.col("n"), F.col("k"), F.col("chi"), _of_size(F.col("k"), found, 1.0))
    spread = tested.withColumn("z", z).where("z > 0").groupBy("k").agg(F.percentile_approx("z", 0.5, 10_000).alias("z"))
    wide = {r.k: max(1.0, r.z / 0.6745) for r in spread.collect()}
    return tuple((k, u, wide.get(k, 1.0)) for k, u in sorted(found.items()))


def _of_size(k: Column, values: dict[int, float], other: float) -> Column:
    return F.coalesce(*(F.when(k == size, F.lit(v)) for size, v in values.items()), F.lit(other))


def p_value(c: Column, nulls: Nulls) -> Column:
    """The largest p-value of the three tests for a measured candidate."""
    z = _z(c["n"], c["k"], c["chi"], _of_size(c["k"], {k: u for k, u, _ in nulls}, 1.0))
    return F.greatest(normal_cdf(z / _of_size(c["k"], {k: s for k, _, s in nulls}, 1.0)), c["p"])


def discovery_bin(scanned: DataFrame, fdr: float = FDR) -> tuple[float, int] | tuple[float, int, Nulls]:
    """Mean candidate length, the least bin whose candidates are discoveries (BINS + 1: none), and the nulls."""
    tested = scanned.select(F.explode("tested").alias("c"))
    mean_length = tested.agg(F.avg("c.n")).first()[0]
    if mean_length is None:
        return 1.0, BINS + 1
    nulls = fitted_nulls(tested.select("c.n", "c.k", "c.chi"))
    judged = tested.select("c.n", p_value(F.col("c"), nulls).alias("p"))
    counts = judged.groupBy(_bin(F.col("p"), F.col("n"), mean_length).alias("bin")).count()
    # BINS + 1 rows at most.
    tail = counts.select("bin", F.sum("count").over(Window.orderBy(F.desc("bin"))).alias("found"), F.sum("count").over(Window.partitionBy()).alias("m"))
    least = tail.where(F.pow(F.lit(10.0), -F.col("bin") / 64) * F.col("m") <= fdr * F.col("found")).agg(F.min("bin")).first()[0]
    return mean_length, BINS + 1 if least is None else least, nulls


def all_spans(mean_length: float, least_bin: int, nulls: Nulls = ()) -> Column:
    """Sorted array of base spans and discoveries, for a frame that :func:`scan` has made."""
    found = F.filter("tested", lambda c: _bin(p_value(c, nulls), c["n"], mean_length) >= least_bin)
    random = F.transform(found, lambda c: F.struct(c["start"].alias("start"), F.lit(3).alias("kind"), c["end"].alias("end")))
    return F.sort_array(F.concat("base", random.cast(SPANS)))


def written(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined in their order."""
    name = lambda k: F.element_at(F.array(*(F.lit(x) for x in KINDS)), k + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """``text`` with the union of the sorted ``spans`` replaced by ``mask``.

    Everything is one pass over the spans: a span that begins inside an earlier one only extends
    it, so the text between is cut where each span begins beyond all before.
    """
    return let(spans, lambda s: F.when(F.size(s) == 0, text).otherwise(_masked(text, s, mask)))


def _masked(text: Column, spans: Column, mask: str) -> Column:
    block = 64
    size = 4096  # characters of a chunk; substrings are cut from chunks, as each walks to its place

    def reach(ends: Column) -> Column:
        """The greatest end of all earlier spans, for each span; blocks keep it near linear."""
        greatest = lambda part: F.coalesce(F.array_max(part), F.lit(0).cast("long"))
        highs = F.transform(F.sequence(F.lit(1), F.size(ends), F.lit(block)), lambda s: F.array_max(F.slice(ends, s, block)))
        return let(highs, lambda high: F.transform(ends, lambda _, i: F.greatest(greatest(F.slice(high, 1, (i / block).cast("int"))), greatest(F.slice(ends, i - i % block + 1, i % block)))))

    def cut(chunks: Column, low: Column, high: Column) -> Column:
        a, b = F.floor(low / size).cast("int"), F.floor(high / size).cast("int")
        first, last = F.get(chunks, a), F.coalesce(F.get(chunks, b), F.lit(""))
        inside = F.substring(first, (low % size + 1).cast("int"), (high - low).cast("int"))
        across = F.concat(F.substring(first, (low % size + 1).cast("int"), F.lit(size)), F.array_join(F.slice(chunks, a + 2, F.greatest(b - a - 1, F.lit(0))), ""), F.substring(last, F.lit(1), (high % size).cast("int")))
        return F.when(low >= high, F.lit("")).when(a == b, inside).otherwise(across)

    def pieces(x: Column) -> Column:
        chunks, earlier = x["chunks"], x["earlier"]
        new = lambda s, i: (i == 0) | (s["start"] > F.get(earlier, i))
        parts = F.transform(spans, lambda s, i: F.when(new(s, i), F.concat(cut(chunks, F.get(earlier, i), s["start"]), F.lit(mask))).otherwise(""))
        last = F.greatest(F.get(earlier, F.size(earlier) - 1), F.element_at(spans, -1)["end"])
        return F.concat(F.array_join(parts, ""), cut(chunks, last, F.length(text).cast("long")))

    ends = let(F.transform(spans, lambda s: s["end"]), reach)
    return let(F.struct(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0)).alias("chunks"), ends.alias("earlier")), pieces)
