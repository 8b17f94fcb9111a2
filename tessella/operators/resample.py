"""Healing, upsampling and warping: moving pixels."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessella.functions.workers import arrow_map, ship

#: The bicubic kernel's parameter, the block and overlap of model upsampling.
CUBIC_A, BLOCK, OVERLAP = -0.75, 256, 16
#: Names of resamplings and the kernels they use.
KERNELS = {"cubic": "bicubic", "bicubic": "bicubic", "cubicspline": "bicubic", "bilinear": "bilinear", "linear": "bilinear", "near": "nearest", "nearest": "nearest"}


def kernel_of(name: str) -> str:
    if name not in KERNELS:
        raise ValueError(f"no kernel {name}; there are {', '.join(sorted(KERNELS))}")
    return KERNELS[name]


def kernels(spark: SparkSession) -> DataFrame:
    """``name, kernel``: what resamplings may be called, and the kernel that each uses."""
    return spark.createDataFrame(list(KERNELS.items()), "name string, kernel string")


def heal(pixels: DataFrame, frames: DataFrame, colours: tuple[str, ...] = ("r", "g", "b")) -> DataFrame:
    """Paint each sheet's frame with the nearest clean pixel.

    Inside ``outer`` a pixel takes the value at its place clamped to ``clean`` (x0, y0, x1, y1, the
    end exclusive), which equals repainting columns first and rows after.  Pixels of a sheet
    without a frame stay.
    """
    framed = pixels.join(frames.select("sheet", "outer", "clean"), "sheet", "left")
    o, c = F.col("outer"), F.col("clean")
    within = (F.col("col") >= o[0]) & (F.col("col") < o[2]) & (F.col("row") >= o[1]) & (F.col("row") < o[3])
    held = lambda v, low, high: F.when(within, F.least(F.greatest(v, low), high - 1)).otherwise(v)
    wanted = framed.select("sheet", "col", "row", held(F.col("col"), c[0], c[2]).alias("__c"), held(F.col("row"), c[1], c[3]).alias("__r"))
    source = pixels.select(F.col("sheet").alias("__s"), F.col("col").alias("__sc"), F.col("row").alias("__sr"), *colours)
    met = wanted.join(source, (F.col("sheet") == F.col("__s")) & (F.coalesce("__c", "col") == F.col("__sc")) & (F.coalesce("__r", "row") == F.col("__sr")))
    return met.select("sheet", "col", "row", *colours)


def heal_bands(bands: Callable[[], Iterator[np.ndarray]], size: tuple[int, int], outer: list[int], clean: list[int]) -> Iterator[np.ndarray]:
    """The same for an image that comes in bands of rows, from the top down, as often as it is asked for.

    A first pass takes the outermost clean rows; the second looks columns up at their clamped place
    and puts these rows over those of the frame.  One band is held.
    """
    (x0, y0, x1, y1), (a0, b0, a1, b1) = outer, clean
    if not (0 <= x0 < a0 < a1 < x1 <= size[0] and 0 <= y0 < b0 < b1 < y1 <= size[1]):
        raise ValueError(f"no plausible frame for {size[0]} by {size[1]} pixels: {outer}, {clean}")
    cols = np.clip(np.arange(x0, x1), a0, a1 - 1)
    edges, at = {}, 0
    for band in bands():
        edges |= {r: band[r - at, cols].copy() for r in (b0, b1 - 1) if at <= r < at + len(band)}
        at += len(band)
    at = 0
    for band in bands():
        rows = np.arange(at, at + len(band))
        done = band.copy()
        framed = (rows >= y0) & (rows < y1)
        done[framed, x0:x1] = band[np.ix_(framed, cols)]
        done[framed & (rows < b0), x0:x1] = edges[b0]
        done[framed & (rows >= b1), x0:x1] = edges[b1 - 1]
        at += len(band)
        yield done


def upsample_nearest(pixels: DataFrame, keys: list[str], values: list[str], factor: int = 2) -> DataFrame:
    """Each pixel as ``factor`` by ``factor`` pixels."""
    steps = F.sequence(F.lit(0), F.lit(factor - 1))
    down = pixels.withColumn("__dy", F.explode(steps))
    across = down.withColumn("__dx", F.explode(steps))
    return across.select(*keys, (F.col("px") * factor + F.col("__dx")).cast("int").alias("px"), (F.col("py") * factor + F.col("__dy")).cast("int").alias("py"), *values)


def ringing(upsampled: DataFrame, source: DataFrame, keys: list[str], factor: int = 2) -> DataFrame:
    """Per group: share of pixels (per cent) over their source pixel's 3 by 3 envelope by more than 1, the worst, the mean step to the next pixel."""
    steps = F.sequence(F.lit(-1), F.lit(1))
    around = source.withColumn("__dy", F.explode(steps)).withColumn("__dx", F.explode(steps)).select(*keys, (F.col("px") + F.col("__dx")).alias("sx"), (F.col("py") + F.col("__dy")).alias("sy"), "c")
    envelope = around.groupBy(*keys, "sx", "sy").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.count("*").alias("n")).where("n = 9")
    at = upsampled.withColumn("sx", F.floor(F.col("px") / factor).cast("int")).withColumn("sy", F.floor(F.col("py") / factor).cast("int"))
    over = at.join(envelope, [*keys, "sx", "sy"]).withColumn("o", F.greatest(F.col("c") - F.col("high"), F.lit(0)) + F.greatest(F.col("low") - F.col("c"), F.lit(0)))
    measured = over.groupBy(*keys).agg((F.avg((F.col("o") > 1).cast("int")) * 100).alias("ringing"), F.max("o").alias("worst"))
    here = upsampled.select(*keys, "px", "py", "c")
    right = here.select(*keys, (F.col("px") - 1).alias("px"), "py", F.col("c").alias("c2"))
    below = here.select(*keys, "px", (F.col("py") - 1).alias("py"), F.col("c").alias("c2"))
    step = lambda other: here.join(other, [*keys, "px", "py"]).groupBy(*keys).agg(F.avg(F.abs(F.col("c2") - F.col("c"))).alias("g"))
    sharp = step(right).withColumnRenamed("g", "gx").join(step(below).withColumnRenamed("g", "gy"), keys)
    return measured.join(sharp, keys).select(*keys, "ringing", "worst", ((F.col("gx") + F.col("gy")) / 2).alias("sharpness"))


def footprint_scale(grid: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Per group the larger of the median steps of ``value`` to the right and down, over px and py."""
    step = lambda line, along: F.abs(F.lead(value).over(Window.partitionBy(*keys, line).orderBy(along)) - F.col(value))
    steps = grid.select(*keys, step("py", "px").alias("__dx"), step("px", "py").alias("__dy"))
    return steps.groupBy(*keys).agg(F.greatest(F.median("__dx"), F.median("__dy")).alias("scale"))


def prefilter(image: np.ndarray, scale: float) -> np.ndarray:
    """Separable Gaussian over (height, width, bands) for a reduction by ``scale``; none up to 1."""
    if scale <= 1:
        return image
    sigma = 0.5 * np.sqrt(scale * scale - 1)
    reach = max(1, int(np.ceil(3 * sigma)))
    weights = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weights /= weights.sum()
    for axis in (0, 1):
        pad = [(0, 0)] * image.ndim
        pad[axis] = (reach, reach)
        padded = np.pad(image, pad, mode="edge")
        n = image.shape[axis]
        image = sum(w * np.take(padded, np.arange(k, k + n), axis=axis) for k, w in enumerate(weights))
    return image


def _weights(t: np.ndarray, kernel: str) -> tuple[np.ndarray, int]:
    """Weights of the neighbours of a fraction ``t`` in [0, 1), and the first neighbour's place."""
    if kernel == "nearest":
        return np.stack([(t < 0.5).astype(float), (t >= 0.5).astype(float)]), 0
    if kernel == "bilinear":
        return np.stack([1 - t, t]), 0
    a = CUBIC_A
    near = lambda d: ((a + 2) * d - (a + 3)) * d * d + 1
    far = lambda d: ((a * d - 5 * a) * d + 8 * a) * d - 4 * a
    return np.stack([far(t + 1), near(t), near(1 - t), far(2 - t)]), -1


def sample(image: np.ndarray, cols: np.ndarray, rows: np.ndarray, kernel: str = "bicubic") -> np.ndarray:
    """``image`` (height, width, bands) at coordinates in which pixel j's centre is j + 0.5.

    Beyond the image there is zero; results are not below zero.
    """
    height, width = image.shape[:2]
    x, y = cols - 0.5, rows - 0.5
    x0, y0 = np.floor(x).astype(int), np.floor(y).astype(int)
    wx, shift_x = _weights(x - x0, kernel)
    wy, shift_y = _weights(y - y0, kernel)
    out = np.zeros((*cols.shape, image.shape[2]))
    for j, v in enumerate(wy):
        for i, w in enumerate(wx):
            c, r = x0 + shift_x + i, y0 + shift_y + j
            inside = (c >= 0) & (c < width) & (r >= 0) & (r < height)
            out += np.where(inside, v * w, 0.0)[..., None] * image[np.clip(r, 0, height - 1), np.clip(c, 0, width - 1)]
    return np.maximum(out, 0)


def warp(rgba: np.ndarray, cols: np.ndarray, rows: np.ndarray, kernel: str = "bicubic") -> np.ndarray:
    """Premultiplied colour (0..255) and alpha (0..1) of a block, from 8-bit RGBA and its source coordinates.

    The local scale is the larger of the median steps; a power of two is taken off by boxes first.
    """
    image = rgba.astype(float)
    image = np.concatenate([image[..., :3] * image[..., 3:] / 255, image[..., 3:] / 255], axis=2)
    steps = [np.median(np.hypot(np.diff(cols, axis=k), np.diff(rows, axis=k))) if cols.shape[k] > 1 else 1.0 for k in (0, 1)]
    scale = float(max(steps))
    factor = 1 if scale < 2 else 2 ** int(np.floor(np.log2(scale)))
    if factor > 1:
        height, width = (-(-n // factor) * factor for n in image.shape[:2])
        padded = np.zeros((height, width, 4))
        padded[: image.shape[0], : image.shape[1]] = image
        image = padded.reshape(height // factor, factor, width // factor, factor, 4).mean(axis=(1, 3))
    return sample(prefilter(image, scale / factor), cols / factor, rows / factor, kernel)


def upsample_blocks(image: np.ndarray, model: Callable[[np.ndarray], np.ndarray], block: int = BLOCK, overlap: int = OVERLAP) -> np.ndarray:
    """``model`` (doubles height and width) over blocks read with context, which is cropped again."""
    height, width = image.shape[:2]
    out = np.zeros((2 * height, 2 * width, image.shape[2]), image.dtype)
    for y in range(0, height, block):
        for x in range(0, width, block):
            y1, x1 = min(height, y + block), min(width, x + block)
            top, left = max(0, y - overlap), max(0, x - overlap)
            doubled = model(image[top : min(height, y1 + overlap), left : min(width, x1 + overlap)])
            out[2 * y : 2 * y1, 2 * x : 2 * x1] = doubled[2 * (y - top) : 2 * (y1 - top), 2 * (x - left) : 2 * (x1 - left)]
    return out


def upsample(blocks: DataFrame, sizes: DataFrame, model: str | Callable[[np.ndarray], np.ndarray], block: int = BLOCK, overlap: int = OVERLAP) -> DataFrame:
    """Raster blocks ``ord, bx, by, rgba`` doubled: blocks of twice the side, under the same numbers.

    A block is read with ``overlap`` pixels around it.  Each block sends its neighbours the strip that
    they need and no more; a group is nine pieces at most.  ``sizes`` has ord, width and height, so that
    a model never sees beyond the sheet.
    """
    run = model_of(model) if isinstance(model, str) else model
    b, o = block, overlap

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for order, bx, by, rgba, width, height in zip(*(batch.column(c).to_pylist() for c in ("ord", "bx", "by", "rgba", "width", "height")), strict=True):
                image = np.frombuffer(rgba, np.uint8).reshape(b, b, 4)[: height - by * b, : width - bx * b]
                rows = []
                for dy, part in ((-1, image[:o]), (0, image), (1, image[-o:] if image.shape[0] == b else image[:0])):
                    for dx, piece in ((-1, part[:, :o]), (0, part), (1, part[:, -o:] if image.shape[1] == b else part[:, :0])):
                        tx, ty = bx + dx, by + dy
                        if piece.size and 0 <= tx * b < width and 0 <= ty * b < height:
                            rows.append((order, tx, ty, -dx, -dy, piece.shape[0], piece.tobytes()))
                types = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["ord", "bx", "by", "sx", "sy", "rows", "rgba"])

    def doubled(table: pa.Table) -> pa.Table:
        parts = {(x, y): np.frombuffer(v, np.uint8).reshape(n, -1, 4) for x, y, n, v in zip(*(table.column(c).to_pylist() for c in ("sx", "sy", "rows", "rgba")), strict=True)}
        lines = [np.concatenate([parts[x, y] for x in (-1, 0, 1) if (x, y) in parts], axis=1) for y in (-1, 0, 1) if (0, y) in parts]
        whole = np.concatenate(lines, axis=0)
        height, width = parts[0, 0].shape[:2]
        top, left = (parts[0, -1].shape[0] if (0, -1) in parts else 0), (parts[-1, 0].shape[1] if (-1, 0) in parts else 0)
        out = np.zeros((2 * b, 2 * b, 4), np.uint8)
        out[: 2 * height, : 2 * width] = run(whole)[2 * top : 2 * (top + height), 2 * left : 2 * (left + width)]
        first = [table.column(c).slice(0, 1) for c in ("ord", "bx", "by")]
        return pa.table([*first, pa.array([out.tobytes()], pa.binary())], names=["ord", "bx", "by", "rgba"])

    sent = arrow_map(blocks.join(sizes, "ord").where((F.col("bx") * b < F.col("width")) & (F.col("by") * b < F.col("height"))).select("ord", "bx", "by", "rgba", "width", "height"), pieces, "ord long, bx int, by int, sx int, sy int, rows int, rgba binary")
    return sent.groupBy("ord", "bx", "by").applyInArrow(doubled, "ord long, bx int, by int, rgba binary")


def model_of(kernel: str) -> Callable[[np.ndarray], np.ndarray]:
    """A model that doubles by one of the kernels."""
    name = kernel_of(kernel)

    def doubled(image: np.ndarray) -> np.ndarray:
        height, width = image.shape[:2]
        cols, rows = np.meshgrid((np.arange(2 * width) + 0.5) / 2, (np.arange(2 * height) + 0.5) / 2)
        padded = np.pad(image.astype(float), ((2, 2), (2, 2), (0, 0)), mode="edge")
        return np.rint(np.clip(sample(padded, cols + 2, rows + 2, name), 0, 255)).astype(image.dtype)

    return doubled


def scale_matrix(size: int, side: int, kernel: str) -> np.ndarray:
    """Weights (side by size) of a line's pixels when ``size`` of them are warped to ``side`` on an even grid.

    Boxes, Gaussian and kernel are all linear along a line, so what they do to unit lines is the matrix.
    """
    units = np.eye(size)[:, None, :].repeat(4, axis=1)[..., None].repeat(3, axis=3)  # lines as images four rows high
    step = size / side
    factor = 1 if step < 2 else 2 ** int(np.floor(np.log2(step)))
    at = (np.arange(side) + 0.5) * step
    out = np.zeros((side, size))
    for k, image in enumerate(units):
        padded = np.zeros((4, -(-size // factor) * factor, 3))
        padded[:, :size] = image
        small = padded.reshape(4, -1, factor, 3).mean(axis=2)
        smooth = prefilter(small, step / factor)
        x = at / factor - 0.5
        x0 = np.floor(x).astype(int)
        weights, shift = _weights(x - x0, kernel)
        for j, w in enumerate(weights):
            c = x0 + shift + j
            inside = (c >= 0) & (c < smooth.shape[1])
            out[:, k] += np.where(inside, w * smooth[1, np.clip(c, 0, smooth.shape[1] - 1), 0], 0.0)
    return out


def warp_chips(chips: DataFrame, size: int, scale: float, kernel: str = "bicubic") -> DataFrame:
    """Each group ``chip`` of ``size`` by ``size`` gray pixels (px, py, c, a) resampled to ``scale`` times its side.

    The grid is even, so a chip is a product with one matrix from either side; chips are packed, and
    an Arrow batch of them is one product.  A missing pixel is transparent.
    """
    side = int(round(size * scale))
    weights = scale_matrix(size, side, kernel_of(kernel))
    cell = F.struct((F.col("py") * size + F.col("px")).cast("int").alias("at"), F.col("c").cast("int").alias("c"), F.col("a").cast("int").alias("a"))
    packed = chips.groupBy("chip").agg(F.collect_list(cell).alias("cells"))  # size * size at most

    def warped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("cells")
            cells = lists.flatten()
            at, c, a = (cells.field(k).to_numpy().astype(float) for k in range(3))
            chip = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            planes = np.zeros((len(lists), 2, size * size))
            planes[chip, 0, at.astype(int)], planes[chip, 1, at.astype(int)] = c * a / 255, a / 255
            done = np.maximum(weights @ planes.reshape(-1, 2, size, size) @ weights.T, 0).reshape(-1, 2, side * side)
            alpha = done[:, 1]
            colour = np.where(alpha > 0, np.rint(np.clip(done[:, 0] / np.where(alpha > 0, alpha, 1), 0, 255)), 0)
            offsets = pa.array(np.arange(len(lists) + 1) * side * side, pa.int32())
            whole = lambda v: pa.ListArray.from_arrays(offsets, pa.array(v.ravel().astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("chip"), whole(colour), whole(np.rint(np.clip(alpha, 0, 1) * 255))], ["chip", "c", "a"])

    kind = chips.schema["chip"].dataType.simpleString()
    rows = arrow_map(packed, warped, f"chip {kind}, c array<int>, a array<int>")
    each = rows.select("chip", F.posexplode(F.arrays_zip("c", "a")).alias("at", "v"))
    return each.select("chip", (F.col("at") % side).cast("int").alias("px"), F.floor(F.col("at") / side).cast("int").alias("py"), "v.c", "v.a")


def packed_blocks(pixels: DataFrame, block: int) -> DataFrame:
    """Gray pixels ``ord, x, y, c, a`` to packed blocks ``ord, bx, by, rgba``; pixels that aren't there are zero.

    A block is one group, ``block`` pixels square at most.
    """

    def packed(table: pa.Table) -> pa.Table:
        x, y, c, a = (table.column(n).to_numpy() for n in ("x", "y", "c", "a"))
        image = np.zeros((block, block, 4), np.uint8)
        image[y % block, x % block, :3], image[y % block, x % block, 3] = c[:, None], a
        first = [table.column(n).slice(0, 1) for n in ("ord", "bx", "by")]
        return pa.table([*first, pa.array([image.tobytes()], pa.binary())], names=["ord", "bx", "by", "rgba"])

    at = lambda name: F.floor(F.col(name) / block).cast("int").alias(f"b{name}")
    ship(pixels.sparkSession)
    rows = pixels.select(F.col("ord").cast("long").alias("ord"), at("x"), at("y"), F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y"), "c", "a")
    return rows.groupBy("ord", "bx", "by").applyInArrow(packed, "ord long, bx int, by int, rgba binary")


def unpacked_blocks(blocks: DataFrame, block: int) -> DataFrame:
    """Packed blocks to pixels ``ord, x, y, r, g, b, a``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        y, x = np.mgrid[:block, :block]
        for batch in batches:
            for order, bx, by, rgba in zip(*(batch.column(c).to_pylist() for c in ("ord", "bx", "by", "rgba")), strict=True):
                image = np.frombuffer(rgba, np.uint8).reshape(-1, 4).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(block * block, order, np.int64)), pa.array((x + bx * block).ravel().astype(np.int64)), pa.array((y + by * block).ravel().astype(np.int64)), *(pa.array(image[:, k]) for k in range(4))], ["ord", "x", "y", "r", "g", "b", "a"])

    return arrow_map(blocks.select("ord", "bx", "by", "rgba"), read, "ord long, x long, y long, r int, g int, b int, a int")
