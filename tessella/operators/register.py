"""Registration of a sheet in a page by its ink: profiles, shifts, probes, votes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tessella.functions.workers import ship
from tessella.sources.folders import cut

#: Reduction of the coarse search, offsets tried, size and places of probes, least ink, least match.
COARSE, FINE, PROBE, MIN_INK, MIN_MATCH = 8, 16, 1200, 2000, 0.70
PROBES = ((0.30, 0.35), (0.70, 0.35), (0.30, 0.70), (0.70, 0.70), (0.50, 0.50))
POINTS_PER_INCH = 72.0


def profile(ink: DataFrame, keys: list[str], axis: str) -> DataFrame:
    """Ink pixels per line: ``keys, axis, total``."""
    return ink.where("ink").groupBy(*keys, axis).agg(F.count("*").alias("total"))


def cosine(ab: Column, aa: Column, bb: Column) -> Column:
    """Match of two patterns from their sums of products; 0 if either is empty."""
    norm = F.sqrt(aa * bb)
    return F.when(norm > 0, ab / F.when(norm > 0, norm)).otherwise(0.0)


def best_shift(page: DataFrame, sheet: DataFrame, keys: list[str]) -> DataFrame:
    """Per group the shift ``s`` at which the sheet's profile matches the page's best, the first of equals.

    ``page`` and ``sheet`` have ``keys, i, total``, every index of each; the sheet's lines are
    joined with the page's lines at each shift by equality of the index.  The joins are told to
    merge: Spark takes exploded rows to be as few as before, and would broadcast them.
    """
    size = sheet.groupBy(*keys).agg((F.max("i") + 1).alias("short")).join(page.groupBy(*keys).agg((F.max("i") + 1).alias("long")), keys)
    shifts = size.withColumn("s", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("long") - F.col("short"), F.lit(0)).cast("long")))).select(*keys, "s")
    moved = sheet.join(shifts.hint("merge"), keys).select(*keys, "s", (F.col("i") + F.col("s")).alias("i"), F.col("total").cast("double").alias("a"))
    met = moved.join(page.select(*keys, "i", F.col("total").cast("double").alias("b")).hint("merge"), [*keys, "i"])
    scored = met.groupBy(*keys, "s").agg(cosine(F.sum(F.col("a") * F.col("b")), F.sum(F.col("a") * F.col("a")), F.sum(F.col("b") * F.col("b"))).alias("score"))
    rounded = scored.withColumn("score", F.round("score", 9))
    return rounded.groupBy(*keys).agg(F.max_by(F.struct("s", "score"), F.struct(F.col("score"), -F.col("s"))).alias("b")).select(*keys, "b.s", "b.score")


def _correlated(sheet: np.ndarray, page: np.ndarray, fine: int) -> tuple[int, int, float]:
    """Best offset of a probe's ink in the page's, which is wider by ``fine`` all round, and its cosine.

    All offsets at once: ink in common is a correlation by Fourier transforms, whole numbers again
    once rounded, and the page's ink under the probe comes from sums over its corners.
    """
    height, width = sheet.shape
    n = 2 * fine + 1
    common = np.fft.irfft2(np.fft.rfft2(page, page.shape) * np.conj(np.fft.rfft2(sheet, page.shape)), page.shape)[:n, :n]
    sums = np.zeros((page.shape[0] + 1, page.shape[1] + 1))
    sums[1:, 1:] = page.cumsum(axis=0).cumsum(axis=1)
    under = sums[height : height + n, width : width + n] - sums[:n, width : width + n] - sums[height : height + n, :n] + sums[:n, :n]
    norm = np.sqrt(under * sheet.sum())
    score = np.where(norm > 0, np.rint(common) / np.where(norm > 0, norm, 1), 0.0)
    dy, dx = np.unravel_index(np.argmax(np.round(score, 9)), score.shape)
    return int(dx) - fine, int(dy) - fine, float(score[dy, dx])


def probe_offsets(ink: DataFrame, probe: int = PROBE, fine: int = FINE, min_ink: int = MIN_INK) -> DataFrame:
    """``sheet, probe, dx, dy, score`` of the probes with enough ink.

    ``ink`` lists ink pixels: sheet, probe, page (whose ink it is), x and y from the probe's corner,
    or for the page from ``fine`` pixels up and left of it.  A probe is one task's work, ``probe``
    pixels square, which also counts its ink.
    """
    kind = ink.schema["sheet"].dataType.simpleString()

    none = pa.table({"sheet": pa.array([], to_arrow_type(ink.schema["sheet"].dataType)), "probe": pa.array([], pa.int32()), "dx": pa.array([], pa.int32()), "dy": pa.array([], pa.int32()), "score": pa.array([], pa.float64())})

    def one(table: pa.Table) -> pa.Table:
        x, y, page = (table.column(c).to_numpy() for c in ("x", "y", "page"))
        if np.count_nonzero(~page) < max(min_ink, 1):
            return none
        images = [np.zeros((n, n)) for n in (probe, probe + 2 * fine)]
        for image, mine in zip(images, (~page, page), strict=True):
            image[y[mine], x[mine]] = 1
        dx, dy, score = _correlated(*images, fine)
        return pa.table([table.column("sheet").slice(0, 1), table.column("probe").slice(0, 1), pa.array([dx], pa.int32()), pa.array([dy], pa.int32()), pa.array([score])], names=["sheet", "probe", "dx", "dy", "score"])

    ship(ink.sparkSession)
    rows = ink.select("sheet", F.col("probe").cast("int").alias("probe"), F.col("page").cast("boolean").alias("page"), F.col("x").cast("int").alias("x"), F.col("y").cast("int").alias("y"))
    return rows.groupBy("sheet", "probe").applyInArrow(one, f"sheet {kind}, probe int, dx int, dy int, score double")


def coarse_origin(page_ink: DataFrame, sheet_ink: DataFrame, sizes: DataFrame, coarse: int = COARSE) -> DataFrame:
    """``sheet, ox, oy`` in full pixels, from ink ``sheet, x, y`` of page and sheet reduced by ``coarse``.

    Rows and columns are matched by themselves.  ``sizes`` has sheet, page_width, page_height, width
    and height in full pixels; a page of the sheet's size needs no search, and no sheet leaves its page.
    """

    def axis(along: str, page_size: str, size: str) -> DataFrame:
        def lines(ink: DataFrame, extent: str) -> DataFrame:
            every = sizes.select("sheet", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(1), F.floor(F.col(extent) / coarse)) - 1)).alias("i"))
            counted = ink.groupBy("sheet", F.col(along).cast("long").alias("i")).agg(F.count("*").alias("total"))
            return every.join(counted.hint("merge"), ["sheet", "i"], "left").select("sheet", "i", F.coalesce("total", F.lit(0)).alias("total"))

        best = best_shift(lines(page_ink, page_size), lines(sheet_ink, size), ["sheet"]).select("sheet", F.col("s").alias("_s"))
        held = F.least(F.greatest(F.coalesce("_s", F.lit(0)) * coarse, F.lit(0)), F.col(page_size) - F.col(size))
        return sizes.join(best, "sheet", "left").select("sheet", F.greatest(held, F.lit(0)).cast("long").alias(f"o{along}"))

    return axis("x", "page_width", "width").join(axis("y", "page_height", "height"), "sheet")


def probes(sizes: DataFrame, origins: DataFrame, probe: int = PROBE, fine: int = FINE) -> DataFrame:
    """``sheet, probe, px, py, bx, by``: each probe's corner in its sheet, and that of the page's box around it.

    Probes whose box leaves the page are left out.
    """
    places = F.array(*(F.struct(F.lit(k).alias("probe"), F.lit(x).alias("fx"), F.lit(y).alias("fy")) for k, (x, y) in enumerate(PROBES)))
    corner = lambda size, share: F.least(F.greatest(F.floor(F.col(size) * F.col(f"p.{share}")) - probe // 2, F.lit(0)), F.col(size) - probe).cast("long")
    at = sizes.join(origins, "sheet").withColumn("p", F.explode(places)).select("*", corner("width", "fx").alias("px"), corner("height", "fy").alias("py"))
    boxed = at.withColumn("bx", F.col("ox") + F.col("px") - fine).withColumn("by", F.col("oy") + F.col("py") - fine)
    wide = probe + 2 * fine
    inside = (F.col("bx") >= 0) & (F.col("by") >= 0) & (F.col("bx") + wide <= F.col("page_width")) & (F.col("by") + wide <= F.col("page_height"))
    return boxed.where(inside & (F.col("width") >= probe) & (F.col("height") >= probe)).select("sheet", F.col("p.probe").alias("probe"), "px", "py", "bx", "by")


def registered(page_ink: DataFrame, sheet_ink: DataFrame, page_small: DataFrame, sheet_small: DataFrame, sizes: DataFrame, coarse: int = COARSE, probe: int = PROBE, fine: int = FINE, min_ink: int = MIN_INK) -> DataFrame:
    """``sheet, x, y, width, height, match, spread, doubtful``: each sheet's window in its page.

    Ink is listed as ``sheet, x, y`` at full size and reduced by ``coarse``.  Without a probe that
    says anything the coarse place stays, with match 0.  Origins are read several times, so they are
    cut; ink is never the side of a join that is gathered.
    """
    origins = cut(coarse_origin(page_small, sheet_small, sizes, coarse), "origins")
    boxes = probes(sizes, origins, probe, fine).hint("shuffle_hash")
    near = lambda ink, x, y, size, page: ink.join(boxes, "sheet").where((F.col("x") >= F.col(x)) & (F.col("x") < F.col(x) + size) & (F.col("y") >= F.col(y)) & (F.col("y") < F.col(y) + size)).select("sheet", "probe", F.lit(page).alias("page"), (F.col("x") - F.col(x)).alias("x"), (F.col("y") - F.col(y)).alias("y"))
    ink = near(sheet_ink, "px", "py", probe, False).union(near(page_ink, "bx", "by", probe + 2 * fine, True))
    voted = vote(probe_offsets(ink, probe, fine, min_ink), ["sheet"])
    done = sizes.join(origins, "sheet").join(voted, "sheet", "left")
    moved = lambda o, d: (F.col(o) + F.coalesce(d, F.lit(0))).cast("long")
    return done.select("sheet", moved("ox", "dx").alias("x"), moved("oy", "dy").alias("y"), "width", "height", F.coalesce("match", F.lit(0.0)).alias("match"), F.coalesce("spread", F.lit(0)).alias("spread"), F.coalesce("doubtful", F.lit(True)).alias("doubtful"))


def page_scale(width: Column, height: Column, points_wide: Column, points_high: Column) -> Column:
    """Pixels a point of the least page that holds the sheet, the page's size and its dpi."""
    scale = F.greatest(width / points_wide, height / points_high)
    return F.struct(scale.alias("scale"), F.rint(points_wide * scale).cast("long").alias("page_width"), F.rint(points_high * scale).cast("long").alias("page_height"), (scale * POINTS_PER_INCH).alias("dpi"))


def vote(probes: DataFrame, keys: list[str]) -> DataFrame:
    """Per group the median offset of its probes, their spread, the median score, and doubts.

    Probes with little ink have been left out; ``doubtful`` tells a spread over 2 or a low score.
    """
    middle = probes.groupBy(*keys).agg(F.median("dx").cast("int").alias("mx"), F.median("dy").cast("int").alias("my"), F.median("score").alias("match"), *(f(c).alias(f"_{f.__name__}_{c}") for c in ("dx", "dy") for f in (F.min, F.max)))
    off = lambda d, m: (F.col(f"_max_{d}") - F.col(m), F.col(m) - F.col(f"_min_{d}"))
    spread = middle.withColumn("spread", F.greatest(*off("dx", "mx"), *off("dy", "my")).cast("int"))
    return spread.select(*keys, F.col("mx").alias("dx"), F.col("my").alias("dy"), "spread", "match", ((F.col("spread") > 2) | (F.col("match") < MIN_MATCH)).alias("doubtful"))


def plausible_dpi(dpi: Column) -> Column:
    return dpi.between(100, 1200)


def expected_size(window: Column, scale: Column) -> Column:
    """Size of a render of ``window`` (x, y, width, height) at ``scale``."""
    return F.struct((window[2] * scale).cast("long").alias("width"), (window[3] * scale).cast("long").alias("height"))
