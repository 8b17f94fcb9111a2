"""Queries of what lies between files and tiles: manifests, extents, windows, palettes, trees."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessella.functions import geo, pixels
from tessella.functions.grid import GEOGRAPHIC, HALF_WORLD, RADIUS
from tessella.operators import bounds, discover, overview, resample, tileset
from tessella.plans import area, tiles, views
from tessella.plans.views import with_views
from tessella.registry import query
from tessella.sources import png, tiff
from tessella.streaming import seams

col, lit = F.col, F.lit


# -- manifests and files ---------------------------------------------------------


@query("""SELECT 's' || s_suppkey || '.tif' AS sheet, CAST(s_suppkey % 50 AS DOUBLE) AS south, 'pixel' AS include_frame, CAST(2 * (4 * s_suppkey) AS DOUBLE) AS include_x, CAST(2 * 20 AS DOUBLE) AS include_y,
    CASE WHEN s_suppkey % 3 = 0 THEN 'lonlat' END AS exclude_frame, CASE WHEN s_suppkey % 3 = 0 THEN CAST(3 + s_suppkey AS DOUBLE) END AS exclude_x FROM supplier""")
def manifest_areas(spark, sf_dir):
    """Area manifests read from their text, pixel polygons at twice the size."""
    k = col("s_suppkey").cast("string")
    exclude = F.when(col("s_suppkey") % 3 == 0, F.concat(lit('"exclude":[{"lonlat":[[1,1],[2,1],['), k, lit(',5]]}],'))).otherwise("")
    text = F.concat(lit('{"s'), k, lit('.tif":{"limits":{"south":'), (col("s_suppkey") % 50).cast("string"), lit('},'), exclude, lit('"include":[{"pixel":[[0,0],['), (col("s_suppkey") * 3).cast("string"), lit(',10],['), k, lit(',10]]}],"manual":true}}'))
    rows = views.table(spark, sf_dir, "supplier").select(F.explode(area.from_manifest(text, lit(2.0))).alias("sheet", "a"))
    total = lambda kind, name: F.aggregate(F.get(f"a.{kind}", lit(0))["points"], lit(0.0), lambda s, p: s + p[name])
    return rows.select("sheet", "a.limits.south", F.get("a.include", lit(0))["frame"].alias("include_frame"), total("include", "x").alias("include_x"), total("include", "y").alias("include_y"), F.get("a.exclude", lit(0))["frame"].alias("exclude_frame"), total("exclude", "x").alias("exclude_x"))


@query("""SELECT p_partkey AS name, CASE WHEN p_partkey % 4 = 0 THEN 'no reference' WHEN p_partkey % 5 = 0 THEN 'no georeference' WHEN p_size % 3 = 0 THEN 'sizes differ' ELSE 'ok' END AS verdict FROM part""")
def georeference_transfers(spark, sf_dir):
    p = views.table(spark, sf_dir, "part").select(col("p_partkey").alias("name"), (col("p_size") * 10).alias("width"), lit(500).alias("height"), "p_size")
    references = p.where("name % 4 <> 0").select("name", (col("width") + F.when(col("p_size") % 3 == 0, 1).otherwise(0)).alias("width"), "height", (col("name") % 5 != 0).alias("georeferenced"))
    return tiff.transfers(references, p)


@query("SELECT * FROM (VALUES ('Lambert', CAST(45 AS DOUBLE), CAST(33 AS DOUBLE), CAST(39 AS DOUBLE), CAST(-95 AS DOUBLE), CAST(500 AS DOUBLE), CAST(298.25 AS DOUBLE)), ('Mercator', NULL, NULL, NULL, NULL, NULL, NULL)) AS t(name, lat_1, lat_2, lat_0, lon_0, false_easting, inverse_flattening)")
def conic_parameters(spark, sf_dir):
    conic = 'PROJCS["x",GEOGCS["y",DATUM["d",SPHEROID["s",6378137,298.25]]],PROJECTION["Lambert_Conformal_Conic_2SP"],PARAMETER["standard_parallel_1",45],PARAMETER["standard_parallel_2",33],PARAMETER["latitude_of_origin",39],PARAMETER["central_meridian",-95],PARAMETER["false_easting",500]]'
    found = [("Lambert", geo.LambertConformalConic.from_wkt(conic)), ("Mercator", geo.LambertConformalConic.from_wkt('PROJCS["x",PROJECTION["Mercator_1SP"]]'))]
    names = ("lat_1", "lat_2", "lat_0", "lon_0", "false_easting", "inverse_flattening")
    return spark.createDataFrame([(n, *(getattr(p, k) if p else None for k in names)) for n, p in found], "name string, " + ", ".join(f"{k} double" for k in names))


@query("SELECT event_id, c * 3 % 256 AS r, (c * 7 + s) % 256 AS g, 255 - c AS b FROM (SELECT event_id, event_id % 20 AS s, event_id * 31 % 256 AS c FROM events) WHERE c < 250")
def palette_colours(spark, sf_dir):
    e = views.table(spark, sf_dir, "events").select("event_id", (col("event_id") % 20).alias("sheet"), (col("event_id") * 31 % 256).alias("idx"))
    c = col("idx")
    palette = spark.range(20).select(col("id").alias("sheet"), F.explode(F.sequence(lit(0).cast("long"), lit(249).cast("long"))).alias("idx"))
    return pixels.through_palette(e, palette.select("sheet", "idx", (c * 3 % 256).alias("r"), ((c * 7 + col("sheet")) % 256).alias("g"), (255 - c).alias("b"))).select("event_id", "r", "g", "b")


@query("SELECT * FROM (VALUES ('cubic', 'bicubic'), ('bicubic', 'bicubic'), ('cubicspline', 'bicubic'), ('bilinear', 'bilinear'), ('linear', 'bilinear'), ('near', 'nearest'), ('nearest', 'nearest')) AS t(name, kernel)")
def resampling_names(spark, sf_dir):
    return resample.kernels(spark)


# -- extents ---------------------------------------------------------------------


@query(with_views(f"SELECT ord, round((west + east) * 2 * {HALF_WORLD} / 180, 3) AS x, round(2 * {RADIUS} * (ln(tan(pi() / 4 + radians(south) / 2)) + ln(tan(pi() / 4 + radians(north) / 2))), 3) AS y FROM sheets", "sheets"))
def mapped_rings(spark, sf_dir):
    """Every corner of each box in Mercator metres, summed."""
    s = views.sheets(spark, sf_dir)
    ring = geo.map_points(geo.box_ring(col("west"), col("south"), col("east"), col("north")), lambda x, y: (geo.lon_to_x(x), geo.lat_to_y(y)))
    total = lambda name: F.round(F.aggregate(ring, lit(0.0), lambda a, p: a + p[name]), 3).alias(name)
    return s.select("ord", total("x"), total("y"))


@query(with_views("SELECT ord, least(g0, g0 + g1 * 300) AS west, least(g3, g3 + g5 * 200) AS south, greatest(g0, g0 + g1 * 300) AS east, greatest(g3, g3 + g5 * 200) AS north FROM (SELECT ord, CAST(ord * 100 AS DOUBLE) AS g0, CAST((ord % 3 + 1) * CASE WHEN ord % 2 = 0 THEN -1 ELSE 1 END AS DOUBLE) AS g1, CAST(ord * -50 AS DOUBLE) AS g3, CAST(-3 - ord % 2 AS DOUBLE) AS g5 FROM sheets)", "sheets"))
def source_extents(spark, sf_dir):
    gt = F.expr("array(cast(ord * 100 as double), cast((ord % 3 + 1) * case when ord % 2 = 0 then -1 else 1 end as double), 0D, cast(ord * -50 as double), 0D, cast(-3 - ord % 2 as double))")
    return views.sheets(spark, sf_dir).withColumn("gt", gt).select("ord", geo.source_extent(col("gt"), lit(300), lit(200)).alias("e")).select("ord", "e.*")


@query(with_views("SELECT ord, greatest(west, -60) AS west, greatest(south, -20) AS south, least(east, 70) AS east, least(north, 35) AS north FROM sheets WHERE greatest(west, -60) < least(east, 70) AND greatest(south, -20) < least(north, 35)", "sheets"))
def crop_overlap(spark, sf_dir):
    box = lambda *v: F.struct(*(x.alias(n) for x, n in zip(v, ("west", "south", "east", "north"), strict=True)))
    own = box(*(col(c) for c in ("west", "south", "east", "north")))
    return views.sheets(spark, sf_dir).select("ord", bounds.clipped(own, box(*(lit(float(v)) for v in (-60, -20, 70, 35)))).alias("b")).where("b is not null").select("ord", "b.*")


@query(with_views(f"SELECT ord % 7 AS g, CAST(max(greatest(0, ceil(log2(({2 * HALF_WORLD} / 256) / (sqrt((10 + ord) ** 2 + 4) / cos(radians(CASE WHEN south <= 0 AND north >= 0 THEN 0 ELSE least(abs(south), abs(north)) END)))) - 1e-9))) AS BIGINT) AS zoom FROM sheets GROUP BY 1", "sheets"))
def finest_zoom(spark, sf_dir):
    gt = F.array(lit(0.0), (10 + col("ord")).cast("double"), lit(0.0), lit(0.0), lit(2.0), lit(-1.0))
    return views.sheets(spark, sf_dir).groupBy((col("ord") % 7).alias("g")).agg(F.max(geo.source_zoom(gt, col("south"), col("north"))).alias("zoom"))


# -- windows ---------------------------------------------------------------------


@query(f"""SELECT event_id, round(((x * {2 * HALF_WORLD} / (1 << 6) + (px + 0.5) * {2 * HALF_WORLD} / (1 << 6) / 256 - {HALF_WORLD}) * 180 / {HALF_WORLD} + 200) / CAST(0.5 AS DOUBLE), 6) AS c,
    round((90 - degrees(2 * atan(exp(({HALF_WORLD} - (y + (py + 0.5) / CAST(256 AS DOUBLE)) * {2 * HALF_WORLD} / (1 << 6)) / {RADIUS})) - pi() / 2)) / CAST(0.25 AS DOUBLE), 6) AS r
    FROM (SELECT event_id, event_id % 64 AS x, event_id // 64 % 64 AS y, event_id * 7 % 256 AS px, event_id * 11 % 256 AS py FROM events)""")
def pixel_centres(spark, sf_dir):
    """Source pixels of tile pixels' centres, through Mercator, degrees and an inverted affine map."""
    n, span = col("event_id"), 2 * HALF_WORLD / 64
    x = (n % 64 + (n * 7 % 256 + 0.5) / 256.0) * span - HALF_WORLD
    y = HALF_WORLD - (F.floor(n / 64) % 64 + (n * 11 % 256 + 0.5) / 256.0) * span
    inverse = geo.invert_affine(F.array(*(lit(float(v)) for v in (-200, 0.5, 0, 90, 0, -0.25))))
    at = geo.apply_affine(inverse, geo.x_to_lon(x), geo.y_to_lat(y))
    return views.table(spark, sf_dir, "events").select("event_id", at.alias("p")).select("event_id", F.round("p.x", 6).alias("c"), F.round("p.y", 6).alias("r"))


def _windows(spark, sf_dir):
    """Source windows of planned tiles; a sheet has ten pixels a degree and begins at its own corner."""
    s = views.sheets(spark, sf_dir)
    plan = tiles.plan_tiles(s.withColumn("ring", geo.box_ring(col("west"), col("south"), col("east"), col("north"))), GEOGRAPHIC, 5)
    return tiles.source_windows(plan, GEOGRAPHIC, lambda x, y: ((x - col("west")) * 10, (col("north") - y) * 10))


PLAN = """, plan AS (SELECT ord, west, north, tx - floor(tx / 64) * 64 AS x, ty AS y, CAST(floor(tx / CAST(64 AS DOUBLE)) AS BIGINT) AS wrap, tx FROM (SELECT *, unnest(range(CAST(floor((west + 180) / 5.625 + 1e-9) AS BIGINT), CAST(ceil((east + 180) / 5.625 - 1e-9) AS BIGINT))) AS tx
        FROM (SELECT *, unnest(range(greatest(0, CAST(floor((90 - north) / 5.625 + 1e-9) AS BIGINT)), least(32, CAST(ceil((90 - south) / 5.625 - 1e-9) AS BIGINT)))) AS ty FROM sheets))),
    w AS (SELECT ord, CAST(x AS BIGINT) AS x, y, wrap, (-180 + tx * CAST(5.625 AS DOUBLE) - west) * 10 AS col_min, (-180 + (tx + 1) * CAST(5.625 AS DOUBLE) - west) * 10 AS col_max, (north - 90 + y * CAST(5.625 AS DOUBLE)) * 10 AS row_min, (north - 90 + (y + 1) * CAST(5.625 AS DOUBLE)) * 10 AS row_max FROM plan)"""


@query(with_views(PLAN + " SELECT ord, x, y, wrap, round(col_min, 6) AS col_min, round(col_max, 6) AS col_max, round(row_min, 6) AS row_min, round(row_max, 6) AS row_max FROM w", "sheets").replace(") , plan", "), plan", 1))
def source_windows(spark, sf_dir):
    return _windows(spark, sf_dir).select("ord", "x", "y", "wrap", *(F.round(c, 6).alias(c) for c in ("col_min", "col_max", "row_min", "row_max")))


@query(with_views(PLAN + """ SELECT ord, bx, "by", CAST(floor((a - 12 * f) / f) * f AS BIGINT) AS col_min, CAST(ceil((b + 12 * f) / f) * f AS BIGINT) AS col_max, CAST(floor((c - 12 * f) / f) * f AS BIGINT) AS row_min, CAST(ceil((d + 12 * f) / f) * f AS BIGINT) AS row_max, f AS factor
    FROM (SELECT ord, x - x % 8 AS bx, y - y % 8 AS "by", min(round(col_min, 6)) AS a, max(round(col_max, 6)) AS b, min(round(row_min, 6)) AS c, max(round(row_max, 6)) AS d, max(1 << CAST(ord % 3 AS INTEGER)) AS f FROM w GROUP BY 1, 2, 3)""", "sheets").replace(") , plan", "), plan", 1))
def chunk_windows(spark, sf_dir):
    w = _windows(spark, sf_dir)
    for c in ("col_min", "col_max", "row_min", "row_max"):
        w = w.withColumn(c, F.round(c, 6))
    at = w.withColumn("bx", col("x") - col("x") % 8).withColumn("by", col("y") - col("y") % 8)
    return tiles.chunk_windows(at, ["ord", "bx", "by"], F.pow(lit(2), col("ord") % 3).cast("long"))


# -- trees -----------------------------------------------------------------------


@query("SELECT event_id, CAST(regexp_extract(p, '/(\\d+)/(\\d+)/(\\d+)\\.png$', 1) AS INTEGER) AS z, CAST(regexp_extract(p, '/(\\d+)/(\\d+)/(\\d+)\\.png$', 2) AS BIGINT) AS x, CAST(regexp_extract(p, '/(\\d+)/(\\d+)/(\\d+)\\.png$', 3) AS BIGINT) AS y FROM (SELECT event_id, '/t/' || (event_id % 9) || '/' || event_id || CASE event_id % 4 WHEN 1 THEN '/a/' ELSE '/' END || event_id || CASE event_id % 5 WHEN 2 THEN '.png.part' WHEN 3 THEN '.webp' ELSE '.png' END AS p FROM events) WHERE regexp_matches(p, '/(\\d+)/(\\d+)/(\\d+)\\.png$')")
def tile_paths(spark, sf_dir):
    """Names in a tree, some of them parts, of another kind, or not numbers."""
    n = col("event_id")
    path = F.concat(lit("/t/"), (n % 9).cast("string"), lit("/"), n.cast("string"), F.when(n % 4 == 1, "/a/").otherwise("/"), n.cast("string"), F.when(n % 5 == 2, ".png.part").when(n % 5 == 3, ".webp").otherwise(".png"))
    return views.table(spark, sf_dir, "events").select("event_id", png.tile_of_path(path).alias("t")).where("t is not null").select("event_id", "t.*")


def _tree(spark, sf_dir):
    """A tile tree of two levels: each event has a tile at zoom 7."""
    n = col("event_id")
    return views.table(spark, sf_dir, "events").select(lit(7).alias("z"), (n * 13 % 128).alias("x"), (n * 29 % 64).alias("y")).distinct()


@query("""WITH t AS (SELECT DISTINCT event_id * 13 % 128 AS x, event_id * 29 % 64 AS y FROM events), lacking AS (SELECT DISTINCT x // 2 AS x, y // 2 AS y FROM t WHERE (x // 2 + y // 2) % 3 <> 0)
    SELECT 7 AS z, t.x, t.y FROM t JOIN lacking l ON t.x // 2 = l.x AND t.y // 2 = l.y""")
def resumed_children(spark, sf_dir):
    """Children that a resumed build reads again: those of parents that aren't there."""
    t = _tree(spark, sf_dir)
    parents = overview.parents(t)
    return overview.children_of(t, tiles.resume(parents, parents.where("(x + y) % 3 = 0"))).select("z", "x", "y")


@query("SELECT format('{} tiles, {:.1f} MB, zooms 6-7', count(*), sum(n) / CAST(1e6 AS DOUBLE)) AS summary FROM (SELECT 1000 + x * 17 AS n FROM (SELECT DISTINCT event_id * 13 % 128 AS x, event_id * 29 % 64 AS y FROM events) UNION ALL SELECT 1000 + x * 17 FROM (SELECT DISTINCT (event_id * 13 % 128) // 2 AS x, (event_id * 29 % 64) // 2 AS y FROM events))")
def tileset_summary(spark, sf_dir):
    t = _tree(spark, sf_dir)
    both = t.union(overview.parents(t)).withColumn("nbytes", 1000 + col("x") * 17)
    return tileset.summary(tileset.totals(tileset.per_zoom(both)))


@query(f"""WITH c AS (SELECT DISTINCT (event_id * 13 % 87 + 61) % 128 AS x, event_id * 29 % 64 AS y FROM events)
    SELECT CASE WHEN min(x) FILTER (WHERE x > 60) IS NULL THEN min(x) * 2.8125 - 180 ELSE min(x) FILTER (WHERE x > 60) * CAST(2.8125 AS DOUBLE) - 180 END AS west, round(degrees(2 * atan(exp(({HALF_WORLD} - (max(y) + 1) * {HALF_WORLD / 64}) / {RADIUS})) - pi() / 2), 6) AS south,
        (max(x) FILTER (WHERE x < 20) + 1) * CAST(2.8125 AS DOUBLE) - 180 AS east, round(degrees(2 * atan(exp(({HALF_WORLD} - min(y) * {HALF_WORLD / 64}) / {RADIUS})) - pi() / 2), 6) AS north FROM c""")
def covered_bounds(spark, sf_dir):
    """Bounds of a level's columns, which go on across the antimeridian."""
    n = col("event_id")
    t = views.table(spark, sf_dir, "events").select(lit(7).alias("z"), ((n * 13 % 87 + 61) % 128).alias("x"), (n * 29 % 64).alias("y")).distinct().withColumn("nbytes", lit(1).cast("long"))
    b = tileset.covered(t, tileset.per_zoom(t))
    return b.select("west", F.round("south", 6).alias("south"), "east", F.round("north", 6).alias("north"))


@query("""WITH l AS (SELECT DISTINCT event_id * 13 % 128 AS x, event_id * 29 % 64 AS y, user_id FROM events), n AS (SELECT x, y, count(*) AS n FROM l GROUP BY x, y), got AS (SELECT x, y, count(*) AS n FROM l WHERE user_id % 10 <> 3 GROUP BY x, y)
    SELECT 7 AS z, n.x, n.y FROM n LEFT JOIN got USING (x, y) WHERE got.n IS NULL OR got.n < n.n""")
def incomplete_seams(spark, sf_dir):
    """Tiles that never got all their layers, as one user in ten never delivers."""
    n = col("event_id")
    layers = views.table(spark, sf_dir, "events").select(lit(7).alias("z"), (n * 13 % 128).alias("x"), (n * 29 % 64).alias("y"), "user_id").distinct()
    counted = lambda df: df.groupBy("z", "x", "y").agg(F.count("*").alias("n"))
    expected = counted(layers)
    done = expected.join(counted(layers.where("user_id % 10 <> 3")), ["z", "x", "y", "n"])
    return seams.incomplete(expected, done)


@query("SELECT path, row_number() OVER (ORDER BY path <> '', path) AS place FROM (SELECT 'set' || lpad(CAST(s_suppkey AS VARCHAR), 5, '0') AS path FROM supplier UNION ALL SELECT '')")
def listing_order(spark, sf_dir):
    """Tilesets in the order in which they are listed."""
    folders = views.table(spark, sf_dir, "supplier").select(F.concat(lit("set"), F.lpad(col("s_suppkey").cast("string"), 5, "0")).alias("folder")).union(spark.createDataFrame([("",)], "folder string"))
    listed = discover.tilesets(folders.withColumn("content", lit("{}"))).coalesce(1)  # one folder's tilesets
    return listed.select("path", (F.monotonically_increasing_id() + 1).alias("place"))
