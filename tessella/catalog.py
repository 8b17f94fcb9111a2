"""The queries by operator, each with its DuckDB counterpart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.functions import geo, grid, pixels, text
from tessella.functions.grid import GEOGRAPHIC, HALF_WORLD, MAX_LATITUDE, MERCATOR, RADIUS
from tessella.operators import account, bounds, composite, detect, discover, overview, register, resample, tileset
from tessella.plans import area, tiles, views
from tessella.plans import catalog as charts
from tessella.plans.views import with_views
from tessella.registry import ORACLE_SQL, QUERIES, query
from tessella import catalog_rasters, catalog_rules  # noqa: F401  (they register their queries)
from tessella.catalog_sheets import fit_sql
from tessella.sources import archives, png
from tessella.sources.folders import cut
from tessella.streaming import seams, traffic

col, lit = F.col, F.lit

# -- grid ------------------------------------------------------------------


MERCATOR_XY = f"lon * {HALF_WORLD} / 180 AS px, {RADIUS} * ln(tan(pi() / 4 + radians(least(greatest(lat, -{MAX_LATITUDE}), {MAX_LATITUDE})) / 2)) AS py"
CLAMPED = "greatest(least(CAST(floor({v}) AS BIGINT), {n} - 1), 0)"


@query(with_views(f"SELECT event_id, z, {CLAMPED.format(v=f'(px + {HALF_WORLD}) / ({2 * HALF_WORLD} / (1 << z))', n='(1 << z)')} AS x, {CLAMPED.format(v=f'({HALF_WORLD} - py) / ({2 * HALF_WORLD} / (1 << z))', n='(1 << z)')} AS y FROM (SELECT event_id, CAST(z AS INTEGER) AS z, {MERCATOR_XY} FROM points)", "points"))
def tile_of_point_mercator(spark, sf_dir):
    p = views.points(spark, sf_dir)
    t = MERCATOR.tile_of(col("z"), geo.lon_to_x(col("lon")), geo.lat_to_y(col("lat")))
    return p.select("event_id", "z", t["x"].alias("x"), t["y"].alias("y"))


@query(with_views(f"SELECT event_id, z, {CLAMPED.format(v='(lon + 180) / (CAST(360 AS DOUBLE) / (2 << z))', n='(2 << z)')} AS x, {CLAMPED.format(v='(90 - lat) / (CAST(180 AS DOUBLE) / (1 << z))', n='(1 << z)')} AS y FROM points", "points"))
def tile_of_point_geographic(spark, sf_dir):
    t = GEOGRAPHIC.tile_of(col("z"), col("lon"), col("lat"))
    return views.points(spark, sf_dir).select("event_id", "z", t["x"].alias("x"), t["y"].alias("y"))


@query(with_views("SELECT event_id, -180 + x * s AS west, 90 - (y + 1) * s AS south, -180 + (x + 1) * s AS east, 90 - y * s AS north FROM (SELECT event_id, CAST(180 AS DOUBLE) / (1 << z) AS s, event_id % (2 << z) AS x, (event_id // 3) % (1 << z) AS y FROM points)", "points"))
def tile_bounds(spark, sf_dir):
    p = views.points(spark, sf_dir).withColumn("x", col("event_id") % grid.shifted(2, col("z"))).withColumn("y", F.floor(col("event_id") / 3) % grid.shifted(1, col("z")))
    return p.select("event_id", GEOGRAPHIC.tile_bounds(col("z"), col("x"), col("y")).alias("b")).select("event_id", "b.*")


@query(with_views("""SELECT ord, 5 AS z, CAST(floor((west + 180) / 5.625 + 1e-9) AS BIGINT) AS x_min, CAST(ceil((east + 180) / 5.625 - 1e-9) AS BIGINT) - 1 AS x_max,
    CAST(floor((90 - north) / 5.625 + 1e-9) AS BIGINT) AS y_min, CAST(ceil((90 - south) / 5.625 - 1e-9) AS BIGINT) - 1 AS y_max,
    (CAST(ceil((east + 180) / 5.625 - 1e-9) AS BIGINT) - CAST(floor((west + 180) / 5.625 + 1e-9) AS BIGINT)) * (CAST(ceil((90 - south) / 5.625 - 1e-9) AS BIGINT) - CAST(floor((90 - north) / 5.625 + 1e-9) AS BIGINT)) AS n FROM sheets""", "sheets"))
def tile_range(spark, sf_dir):
    r = GEOGRAPHIC.tile_range(lit(5), col("west"), col("south"), col("east"), col("north"))
    return views.sheets(spark, sf_dir).select("ord", r.alias("r")).select("ord", "r.*", grid.range_count(col("r")).alias("n"))


@query(with_views("SELECT event_id, z, (event_id % (1 << z)) AS y, (1 << z) - 1 - event_id % (1 << z) AS tms FROM points", "points"))
def flip_y(spark, sf_dir):
    p = views.points(spark, sf_dir).withColumn("y", col("event_id") % grid.shifted(1, col("z")))
    return p.select("event_id", "z", "y", MERCATOR.flip_y(col("z"), col("y")).cast("long").alias("tms"))


@query(with_views(f"SELECT event_id, CAST(greatest(0, ceil(log2(({2 * HALF_WORLD} / 256) / ((event_id % 1000 + 1) * 0.5)) - 1e-9)) AS BIGINT) AS zoom FROM points", "points"))
def native_zoom(spark, sf_dir):
    return views.points(spark, sf_dir).select("event_id", MERCATOR.zoom_for_resolution((col("event_id") % 1000 + 1) * 0.5).alias("zoom"))


@query(with_views("SELECT ord, greatest(west * 1.3, -180) AS west, greatest(south * 1.6, -90) AS south, least(east * 1.3, 180) AS east, least(north * 1.6, 90) AS north FROM (SELECT ord, least(west, east) AS west, south, greatest(west, east) AS east, north FROM sheets) WHERE south * 1.6 < 90 AND north * 1.6 > -90 AND west * 1.3 < 180 AND east * 1.3 > -180", "sheets").replace("1.3", "CAST(1.3 AS DOUBLE)").replace("1.6", "CAST(1.6 AS DOUBLE)"))
def clamp_bounds(spark, sf_dir):
    wide = views.sheets(spark, sf_dir).select("ord", (col("west") * 1.3).alias("w"), (col("south") * 1.6).alias("s"), (col("east") * 1.3).alias("e"), (col("north") * 1.6).alias("n")).where("s < 90 and n > -90 and w < 180 and e > -180")
    return wide.select("ord", GEOGRAPHIC.clamp_bounds(col("w"), col("s"), col("e"), col("n")).alias("b")).select("ord", "b.*")


@query(with_views("SELECT event_id, event_id >> 1 AS px, (event_id * 3) >> 1 AS py FROM points", "points"))
def parent_key(spark, sf_dir):
    return views.points(spark, sf_dir).select("event_id", grid.parent(col("event_id")).alias("px"), grid.parent(col("event_id") * 3).alias("py"))


@query(with_views("SELECT event_id, event_id - event_id % 8 AS bx FROM points", "points"))
def block_key(spark, sf_dir):
    return views.points(spark, sf_dir).select("event_id", grid.block_of(col("event_id")).alias("bx"))


@query("SELECT * FROM (VALUES ('mercator', 'EPSG:3857', 1, 1, 256), ('geographic', 'EPSG:4326', 2, 1, 256)) AS t(name, crs, base_columns, base_rows, tile_size)")
def schemes(spark, sf_dir):
    return grid.schemes(spark).select("name", "crs", "base_columns", "base_rows", "tile_size")


@query("""SELECT o_orderkey, CAST(b * 8192 AS BIGINT) AS "offset", CAST(least(8192, total - b * 8192) AS BIGINT) AS length
    FROM (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS total FROM orders) o, LATERAL (SELECT unnest(range(CAST(ceil(total / 8192) AS BIGINT))) AS b)""")
def render_blocks(spark, sf_dir):
    o = views.table(spark, sf_dir, "orders").select("o_orderkey", F.floor("o_totalprice").cast("long").alias("total"))
    return grid.blocks(o, "total", 8192).select("o_orderkey", "offset", "length")


@query(with_views("SELECT event_id, CASE WHEN s < 2 THEN 1 ELSE CAST(pow(2, floor(log2(s))) AS BIGINT) END AS factor, CASE WHEN t <= 1.2e-4 THEN 16 ELSE greatest(1, CAST(pow(2, floor(log2(least(16 * sqrt(t / 1.2e-4), 16)))) AS BIGINT)) END AS step FROM (SELECT event_id, (event_id % 500) / CAST(16 AS DOUBLE) + 0.01 AS s, (event_id % 7) * 5e-5 AS t FROM points)", "points"))
def mip_and_lattice(spark, sf_dir):
    p = views.points(spark, sf_dir)
    return p.select("event_id", grid.mip_factor((col("event_id") % 500) / 16.0 + 0.01).alias("factor"), grid.lattice_step((col("event_id") % 7) * 5e-5).alias("step"))


# -- projections -------------------------------------------------------------


@query(with_views(f"SELECT event_id, round(px, 3) AS x, round(py, 3) AS y FROM (SELECT event_id, {MERCATOR_XY} FROM points)", "points"))
def mercator_forward(spark, sf_dir):
    return views.points(spark, sf_dir).select("event_id", F.round(geo.lon_to_x(col("lon")), 3).alias("x"), F.round(geo.lat_to_y(col("lat")), 3).alias("y"))


@query(with_views(f"SELECT event_id, round(px * 180 / {HALF_WORLD}, 6) AS lon, round(degrees(2 * atan(exp(py / {RADIUS})) - pi() / 2), 6) AS lat FROM (SELECT event_id, CAST((event_id * 7919) % 40000000 - 20000000 AS DOUBLE) AS px, CAST((event_id * 104729) % 40000000 - 20000000 AS DOUBLE) AS py FROM points)", "points"))
def mercator_inverse(spark, sf_dir):
    p = views.points(spark, sf_dir).select("event_id", ((col("event_id") * 7919) % 40000000 - 20000000).cast("double").alias("px"), ((col("event_id") * 104729) % 40000000 - 20000000).cast("double").alias("py"))
    return p.select("event_id", F.round(geo.x_to_lon(col("px")), 6).alias("lon"), F.round(geo.y_to_lat(col("py")), 6).alias("lat"))


@query(with_views("SELECT event_id, round(c + (v - 360 * floor(v / 360)) - 180, 6) AS lon FROM (SELECT event_id, c, lon * 3 - c + 180 AS v FROM (SELECT event_id, lon, CAST(event_id % 360 - 180 AS DOUBLE) AS c FROM points))", "points"))
def unwrap_lon(spark, sf_dir):
    return views.points(spark, sf_dir).select("event_id", F.round(geo.unwrap(col("lon") * 3, (col("event_id") % 360 - 180).cast("double")), 6).alias("lon"))


@query(with_views("SELECT event_id, round(CASE WHEN v BETWEEN -180 AND 180 THEN v WHEN v > 180 THEN v - 360 * ceil((v - 180) / 360) ELSE v + 360 * ceil((-180 - v) / 360) END, 6) AS lon FROM (SELECT event_id, lon * 5 AS v FROM points)", "points"))
def normalise_lon(spark, sf_dir):
    return views.points(spark, sf_dir).select("event_id", F.round(geo.normalise(col("lon") * 5), 6).alias("lon"))


@query(with_views("SELECT event_id, round(CASE WHEN m > 180 THEN m - 360 ELSE m END, 6) AS centre FROM (SELECT event_id, w + (CASE WHEN e >= w THEN e - w ELSE e - w + 360 END) / 2 AS m FROM (SELECT event_id, lon AS w, CAST(event_id % 360 - 180 AS DOUBLE) AS e FROM points))", "points"))
def arc_centre(spark, sf_dir):
    return views.points(spark, sf_dir).select("event_id", F.round(geo.arc_centre(col("lon"), (col("event_id") % 360 - 180).cast("double")), 6).alias("centre"))


LCC = geo.LambertConformalConic(45, 33, 39, -95)


@query(with_views("""
    , e AS (SELECT sqrt((1 / 298.257222101) * (2 - 1 / 298.257222101)) AS e),
    k AS (SELECT e, cos(radians(45)) / sqrt(1 - (e * sin(radians(45))) ** 2) AS m1, cos(radians(33)) / sqrt(1 - (e * sin(radians(33))) ** 2) AS m2,
                 tan(pi() / 4 - radians(45) / 2) / (((1 - e * sin(radians(45))) / (1 + e * sin(radians(45)))) ** (e / 2)) AS t1,
                 tan(pi() / 4 - radians(33) / 2) / (((1 - e * sin(radians(33))) / (1 + e * sin(radians(33)))) ** (e / 2)) AS t2,
                 tan(pi() / 4 - radians(39) / 2) / (((1 - e * sin(radians(39))) / (1 + e * sin(radians(39)))) ** (e / 2)) AS t0 FROM e),
    c AS (SELECT *, ln(m1 / m2) / ln(t1 / t2) AS n FROM k),
    p AS (SELECT event_id, -125 + ((event_id * 7919) % 6000) / CAST(100 AS DOUBLE) AS lon, 24 + ((event_id * 104729) % 2600) / CAST(100 AS DOUBLE) AS lat FROM points),
    q AS (SELECT event_id, n, 6378137 * m1 / (n * t1 ** n) * (tan(pi() / 4 - radians(lat) / 2) / (((1 - e * sin(radians(lat))) / (1 + e * sin(radians(lat)))) ** (e / 2))) ** n AS rho,
                 6378137 * m1 / (n * t1 ** n) * t0 ** n AS rho0, n * radians(lon + 95) AS theta FROM p, c)
    SELECT event_id, round(rho * sin(theta), 3) AS x, round(rho0 - rho * cos(theta), 3) AS y FROM q""".lstrip(), "points").replace(") , e AS", "), e AS"))
def lcc_forward(spark, sf_dir):
    p = views.points(spark, sf_dir).select("event_id", (-125 + ((col("event_id") * 7919) % 6000) / 100.0).alias("lon"), (24 + ((col("event_id") * 104729) % 2600) / 100.0).alias("lat"))
    x, y = LCC.forward(col("lon"), col("lat"))
    return p.select("event_id", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


GT = "array(cast(ord * 100 as double), 2D + ord % 3, 0.5D, cast(ord * -50 as double), 0.25D, -3D - ord % 2)"
GT_SQL = "CAST(ord * 100 AS DOUBLE) AS g0, 2.0 + ord % 3 AS g1, CAST(0.5 AS DOUBLE) AS g2, CAST(ord * -50 AS DOUBLE) AS g3, CAST(0.25 AS DOUBLE) AS g4, CAST(-3 - ord % 2 AS DOUBLE) AS g5"


@query(with_views(f"SELECT ord, CAST(g0 + g1 * 17 + g2 * 29 AS DOUBLE) AS x, CAST(g3 + g4 * 17 + g5 * 29 AS DOUBLE) AS y FROM (SELECT ord, {GT_SQL} FROM sheets)", "sheets"))
def affine_apply(spark, sf_dir):
    s = views.sheets(spark, sf_dir).withColumn("gt", F.expr(GT))
    return s.select("ord", geo.apply_affine(col("gt"), lit(17), lit(29)).alias("p")).select("ord", "p.*")


@query(with_views(f"SELECT ord, round(((-g0) * g5 + g2 * g3) / d, 6) + 0 AS i0, round(g5 / d, 6) AS i1, round(-g2 / d, 6) AS i2, round((g0 * g4 - g1 * g3) / d, 6) + 0 AS i3, round(-g4 / d, 6) AS i4, round(g1 / d, 6) AS i5 FROM (SELECT *, CAST(g1 AS DOUBLE) * g5 - g2 * g4 AS d FROM (SELECT ord, {GT_SQL} FROM sheets))", "sheets"))
def affine_inverse(spark, sf_dir):
    s = views.sheets(spark, sf_dir).withColumn("inv", geo.invert_affine(F.expr(GT)))
    return s.select("ord", *((F.round(col("inv")[i], 6) + 0.0).alias(f"i{i}") for i in range(6)))


@query(with_views(f"SELECT ord, g0 AS r0, CAST(g1 / 2 AS DOUBLE) AS r1, g2 / 2 AS r2, g3 AS r3, g4 / 2 AS r4, g5 / 2 AS r5 FROM (SELECT ord, {GT_SQL} FROM sheets)", "sheets"))
def affine_rescale(spark, sf_dir):
    s = views.sheets(spark, sf_dir).withColumn("gt", geo.rescale_affine(F.expr(GT), lit(2)))
    return s.select("ord", *(col("gt")[i].alias(f"r{i}") for i in range(6)))


@query(with_views(f"SELECT ord, round(west * {HALF_WORLD} / 180, 3) AS west, round({RADIUS} * ln(tan(pi() / 4 + radians(south) / 2)), 3) AS south, round(east * {HALF_WORLD} / 180, 3) AS east, round({RADIUS} * ln(tan(pi() / 4 + radians(north) / 2)), 3) AS north FROM sheets", "sheets"))
def reproject_bounds(spark, sf_dir):
    done = geo.reproject_bounds(views.sheets(spark, sf_dir), "ord", lambda x, y: (geo.lon_to_x(x), geo.lat_to_y(y)))
    return done.select("ord", *(F.round(c, 3).alias(c) for c in ("west", "south", "east", "north")))


@query(with_views(f"SELECT ord, CAST(greatest(0, ceil(log2(({2 * HALF_WORLD} / 256) / (sqrt((10 + ord) ** 2 + 4) / cos(radians(CASE WHEN south <= 0 AND north >= 0 THEN 0 ELSE least(abs(south), abs(north)) END)))) - 1e-9)) AS BIGINT) AS zoom FROM sheets", "sheets"))
def source_native_zoom(spark, sf_dir):
    s = views.sheets(spark, sf_dir).withColumn("gt", F.array(lit(0.0), (10 + col("ord")).cast("double"), lit(0.0), lit(0.0), lit(2.0), lit(-1.0)))
    return s.select("ord", geo.source_zoom(col("gt"), col("south"), col("north")).alias("zoom"))


@query(with_views("SELECT ord, 2 * (CAST(ceil(w / 0.5 - 1e-9) AS BIGINT) + CAST(ceil(h / 0.5 - 1e-9) AS BIGINT)) AS vertices FROM (SELECT ord, east - west AS w, north - south AS h FROM sheets)", "sheets"))
def densify_ring(spark, sf_dir):
    s = views.sheets(spark, sf_dir).withColumn("ring", geo.box_ring(col("west"), col("south"), col("east"), col("north")))
    return s.select("ord", F.size(geo.densify(col("ring"), 0.5)).cast("long").alias("vertices"))


# -- planning ----------------------------------------------------------------


def _planned(spark, sf_dir, z=5, shift=0.0):
    s = views.sheets(spark, sf_dir)
    ring = geo.box_ring(col("west") + shift, col("south"), col("east") + shift, col("north"))
    return tiles.plan_tiles(s.withColumn("ring", ring), GEOGRAPHIC, z).drop("ring")


def plan_sql(z: int = 5, shift: int = 0) -> str:
    span, n = 180 / 2**z, 2 * 2**z
    return f"""SELECT ord, detail, a, c, {z} AS z, CAST(tx - floor(tx / {n}) * {n} AS BIGINT) AS x, ty AS y, CAST(floor(tx / CAST({n} AS DOUBLE)) AS BIGINT) AS wrap
        FROM (SELECT *, unnest(range(CAST(floor((west + {shift} + 180) / {span} + 1e-9) AS BIGINT), CAST(ceil((east + {shift} + 180) / {span} - 1e-9) AS BIGINT))) AS tx
              FROM (SELECT *, unnest(range(greatest(0, CAST(floor((90 - north) / {span} + 1e-9) AS BIGINT)), least({2**z}, CAST(ceil((90 - south) / {span} - 1e-9) AS BIGINT)))) AS ty FROM sheets))"""


def planned_sql(select: str, *more: str, z: int = 5, shift: int = 0) -> str:
    return with_views(f", plan AS ({plan_sql(z, shift)}) {select}", "sheets", *more).replace(") , plan", "), plan", 1)


@query(planned_sql("SELECT z, x, y, ord, wrap FROM plan"))
def plan_tiles(spark, sf_dir):
    return _planned(spark, sf_dir).select("z", "x", "y", "ord", "wrap")


@query(planned_sql("SELECT z, x, y, string_agg(ord || ':' || wrap, ',' ORDER BY ord, wrap) AS layers, CAST(count(*) AS INTEGER) AS n FROM plan GROUP BY z, x, y"))
def plan_contributors(spark, sf_dir):
    listed = tiles.contributors(_planned(spark, sf_dir))
    return listed.select("z", "x", "y", F.array_join(F.transform("layers", lambda v: F.concat_ws(":", v["ord"].cast("string"), v["wrap"].cast("string"))), ",").alias("layers"), "n")


@query(planned_sql("SELECT wrap, count(*) AS tiles, min(x) AS x_min, max(x) AS x_max FROM plan GROUP BY wrap", shift=100))
def plan_wraps(spark, sf_dir):
    return _planned(spark, sf_dir, shift=100.0).groupBy("wrap").agg(F.count("*").alias("tiles"), F.min("x").alias("x_min"), F.max("x").alias("x_max"))


@query(planned_sql("SELECT z, x, y, ord FROM plan WHERE (x, y) IN (SELECT (x, y) FROM plan WHERE detail)", z=6))
def plan_detail(spark, sf_dir):
    return tiles.plan_detail(_planned(spark, sf_dir, 6)).select("z", "x", "y", "ord")


@query(planned_sql("SELECT n > 1 AS seam, count(*) AS tiles, CAST(sum(n) AS BIGINT) AS layers FROM (SELECT x, y, count(*) AS n FROM plan GROUP BY x, y) GROUP BY n > 1"))
def plan_seams(spark, sf_dir):
    return tiles.contributors(_planned(spark, sf_dir)).groupBy((col("n") > 1).alias("seam")).agg(F.count("*").alias("tiles"), F.sum("n").alias("layers"))


@query(planned_sql("SELECT z, x - x % 8 AS bx, y - y % 8 AS by, count(DISTINCT (x, y)) AS tiles, count(*) AS rows, count(DISTINCT (ord, wrap)) AS layers FROM plan GROUP BY ALL"))
def plan_blocks(spark, sf_dir):
    return tiles.plan_blocks(_planned(spark, sf_dir)).select("z", "bx", "by", "tiles", "rows", F.size("layers").cast("long").alias("layers"))


@query(planned_sql("SELECT x, y, count(*) AS n FROM plan WHERE (x, y) NOT IN (SELECT (x, y) FROM plan WHERE ord % 2 = 0) GROUP BY x, y"))
def plan_resume(spark, sf_dir):
    plan = _planned(spark, sf_dir)
    return tiles.resume(plan, plan.where("ord % 2 = 0")).groupBy("x", "y").agg(F.count("*").alias("n"))


# -- map areas ---------------------------------------------------------------


def _masked(spark, sf_dir, include=True, exclude=True, limits=True):
    """Per sheet a grid of 16 by 16 pixels, a diamond to include, a box to exclude, a limit in the south."""
    polygon = lambda ring: F.struct(lit("pixel").alias("frame"), ring.alias("points"))
    point = lambda x, y: F.struct(lit(float(x)).alias("x"), lit(float(y)).alias("y"))
    none = F.array().cast(f"array<{area.POLYGON}>")
    diamond = F.array(point(8, 0.25), point(15.75, 8), point(8, 15.75), point(0.25, 8))
    box = F.array(point(6, 6), point(9, 6), point(9, 11), point(6, 11))
    edge = F.struct(*(F.lit(None).cast("double").alias(n) if n != "south" else (col("south") + (col("ord") % 3)).alias(n) for n in ("west", "south", "east", "north")))
    made = F.struct((edge if limits else F.lit(None).cast("struct<west:double,south:double,east:double,north:double>")).alias("limits"), (F.array(polygon(diamond)) if include else none).alias("include"), (F.array(polygon(box)) if exclude else none).alias("exclude"))
    cells = views.sheets(spark, sf_dir).withColumn("area", made).withColumn("row", F.explode(F.sequence(lit(0), lit(15)))).withColumn("col", F.explode(F.sequence(lit(0), lit(15))))
    x, y = col("col") + 0.5, col("row") + 0.5
    lon, lat = col("west") + x * (col("east") - col("west")) / 16, col("north") - y * (col("north") - col("south")) / 16
    return cells.withColumn("inside", area.in_area(col("area"), x, y, lon, lat, lit(16), lit(16)))


def mask_sql(select: str, include=True, exclude=True, limits=True) -> str:
    tests = ["true"]
    tests += ["abs(col + 0.5 - 8) + abs(row + 0.5 - 8) < 7.75"] if include else []
    tests += ["NOT (col + 0.5 BETWEEN 6 AND 9 AND row + 0.5 BETWEEN 6 AND 11)"] if exclude else []
    tests += ["north - (row + 0.5) * (north - south) / 16 >= south + ord % 3"] if limits else []
    return with_views(f", cells AS (SELECT ord, CAST(col AS INTEGER) AS col, CAST(row AS INTEGER) AS row, {' AND '.join(tests)} AS inside FROM sheets, range(16) AS a(col), range(16) AS b(row)) {select}", "sheets").replace(") , cells", "), cells", 1)


@query(mask_sql("SELECT ord, col, row FROM cells WHERE inside"))
def mask_pixels(spark, sf_dir):
    return _masked(spark, sf_dir).where("inside").select("ord", "col", "row")


@query(mask_sql("SELECT ord, count(*) FILTER (WHERE inside) AS pixels FROM cells GROUP BY ord"))
def mask_area(spark, sf_dir):
    return _masked(spark, sf_dir).groupBy("ord").agg(F.count_if("inside").alias("pixels"))


@query(mask_sql("SELECT ord, count(*) FILTER (WHERE inside) AS pixels FROM cells GROUP BY ord", include=False, exclude=False))
def limits_clip(spark, sf_dir):
    return _masked(spark, sf_dir, include=False, exclude=False).groupBy("ord").agg(F.count_if("inside").alias("pixels"))


@query(mask_sql("SELECT ord, count(*) FILTER (WHERE inside) AS pixels FROM cells GROUP BY ord", exclude=False, limits=False))
def include_union(spark, sf_dir):
    return _masked(spark, sf_dir, exclude=False, limits=False).groupBy("ord").agg(F.count_if("inside").alias("pixels"))


@query(mask_sql("SELECT ord, count(*) FILTER (WHERE inside) AS pixels FROM cells GROUP BY ord", include=False, limits=False))
def exclude_diff(spark, sf_dir):
    return _masked(spark, sf_dir, include=False, limits=False).groupBy("ord").agg(F.count_if("inside").alias("pixels"))


# -- compositing and overviews -------------------------------------------------

KEYS = ["z", "x", "y"]
COMPOSITED = """, layers AS (SELECT *, coalesce(product(1 - a) OVER (PARTITION BY x, y ORDER BY ord DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1) AS t FROM plan),
    done AS (SELECT z, x, y, sum(t * a * c) AS pc, sum(t * a) AS pa FROM layers WHERE t > 1e-6 GROUP BY z, x, y)"""
FINISHED = COMPOSITED + """, finished AS (SELECT z, x, y, CASE WHEN pa > 0 THEN CAST(round_even(least(greatest(pc / pa, 0), 255), 0) AS INTEGER) ELSE 0 END AS c,
    CAST(round_even(least(greatest(pa * 255, 0), 255), 0) AS INTEGER) AS a FROM done)"""


def stack_sql(select: str, ctes: str = COMPOSITED, z: int = 4) -> str:
    return planned_sql(f"{ctes} {select}", z=z).replace(") , layers", "), layers", 1)


@query(stack_sql("SELECT z, x, y, round(pc, 6) AS pc, round(pa, 6) AS pa FROM done"))
def composite_under(spark, sf_dir):
    done = composite.composite(_planned(spark, sf_dir, 4), KEYS, ["c"])
    return done.select(*KEYS, F.round("pc", 6).alias("pc"), F.round("pa", 6).alias("pa"))


@query(stack_sql("SELECT z, x, y, round(pc, 4) AS pc, round(pa, 4) AS pa FROM done"))
def composite_fold(spark, sf_dir):
    done = composite.folded(_planned(spark, sf_dir, 4), KEYS)
    return done.select(*KEYS, F.round("pc", 4).alias("pc"), F.round("pa", 4).alias("pa"))


@query(stack_sql("SELECT z, x, y, c, a FROM finished", FINISHED))
def composite_finish(spark, sf_dir):
    return composite.finish(composite.composite(_planned(spark, sf_dir, 4), KEYS, ["c"]), KEYS, ["c"])


@query(stack_sql("SELECT z, count(*) AS layers, count(*) FILTER (WHERE t <= 1e-6) AS hidden FROM layers GROUP BY z", ", layers AS (SELECT *, coalesce(product(1 - a) OVER (PARTITION BY x, y ORDER BY ord DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1) AS t FROM plan)", z=3))
def composite_opaque_stop(spark, sf_dir):
    t = _planned(spark, sf_dir, 3).withColumn("t", composite.passing(KEYS))
    return t.groupBy("z").agg(F.count("*").alias("layers"), F.count_if(col("t") <= pixels.OPAQUE).alias("hidden"))


@query(stack_sql("SELECT z, x, y, round(pa, 6) AS pa FROM done WHERE pa > 0.5 / 255", COMPOSITED.replace("FROM plan", "FROM (SELECT * REPLACE (CASE WHEN ord % 4 = 0 THEN 0 ELSE a END AS a) FROM plan)")))
def blank_tiles_dropped(spark, sf_dir):
    faint = _planned(spark, sf_dir, 4).withColumn("a", F.when(col("ord") % 4 == 0, 0.0).otherwise(col("a")))
    return composite.drop_blank(composite.composite(faint, KEYS, ["c"])).select(*KEYS, F.round("pa", 6).alias("pa"))


@query(planned_sql("SELECT DISTINCT 4 AS z, x >> 1 AS x, y >> 1 AS y FROM plan"))
def overview_parents(spark, sf_dir):
    return overview.parents(_planned(spark, sf_dir))


HALVED = """SELECT 7 AS z, x // 2 AS x, y // 2 AS y, CAST((x % 2 * 8 + px) // 2 AS INTEGER) AS px, CAST((y % 2 * 8 + py) // 2 AS INTEGER) AS py,
    CASE WHEN sum(a) > 0 THEN CAST(round_even(sum(c * a) / sum(a), 0) AS INTEGER) ELSE 0 END AS c, CAST(round_even(sum(a) / CAST(4 AS DOUBLE), 0) AS INTEGER) AS a FROM chips GROUP BY ALL"""


@query(with_views("SELECT z, x, y, px, py, c, a FROM (" + HALVED.replace("GROUP BY ALL", "GROUP BY 1, 2, 3, 4, 5") + ")", "chips"))
def overview_pixels(spark, sf_dir):
    return overview.halve(views.chips(spark, sf_dir), 8, ("c",))


CASCADE = "SELECT 5 AS z, x, y FROM (SELECT DISTINCT x, y FROM plan)" + "".join(f" UNION ALL SELECT * FROM (SELECT DISTINCT {5 - k} AS z, x >> {k} AS x, y >> {k} AS y FROM plan)" for k in range(1, 6))


@query(planned_sql(f"SELECT z, count(*) AS tiles FROM ({CASCADE}) GROUP BY z"))
def overview_cascade_counts(spark, sf_dir):
    return overview.cascade(_planned(spark, sf_dir), 5, 0).groupBy("z").agg(F.count("*").alias("tiles"))


@query(with_views("SELECT vec_id, px, py, round(sum(c * a) / 4 / CAST(65025 AS DOUBLE), 6) AS pc, round(sum(a) / 4 / CAST(255 AS DOUBLE), 6) AS pa FROM (SELECT vec_id, CAST(px // 2 AS INTEGER) AS px, CAST(py // 2 AS INTEGER) AS py, c, a FROM chips) GROUP BY vec_id, px, py", "chips"))
def premultiplied_box_reduce(spark, sf_dir):
    done = overview.box_reduce(views.chips(spark, sf_dir), ["vec_id"], 2)
    return done.select("vec_id", "px", "py", F.round("pc", 6).alias("pc"), F.round("pa", 6).alias("pa"))


# -- tilesets ------------------------------------------------------------------


def _written(spark, sf_dir):
    return overview.cascade(_planned(spark, sf_dir), 5, 0).withColumn("nbytes", 1000 + (col("x") * 131 + col("y") * 17) % 977)


WRITTEN = f", written AS (SELECT z, x, y, 1000 + (x * 131 + y * 17) % 977 AS nbytes FROM ({CASCADE}))"


def written_sql(select: str) -> str:
    return planned_sql(f"{WRITTEN} {select}").replace(") , written", "), written", 1)


@query(written_sql("SELECT z, count(*) AS tiles, CAST(sum(nbytes) AS BIGINT) AS bytes, min(x) AS x_min, max(x) AS x_max, min(y) AS y_min, max(y) AS y_max FROM written GROUP BY z"))
def tiles_per_zoom(spark, sf_dir):
    return tileset.per_zoom(_written(spark, sf_dir))


@query(written_sql("SELECT count(*) AS tiles, CAST(sum(nbytes) AS BIGINT) AS bytes, min(z) AS minzoom, max(z) AS maxzoom, max(z) FILTER (WHERE z < 5) AS fullzoom FROM written"))
def fullzoom(spark, sf_dir):
    return tileset.totals(tileset.per_zoom(_written(spark, sf_dir)), detail_zoom=5).select(*(col(c).cast("long").alias(c) for c in ("tiles", "bytes")), "minzoom", "maxzoom", "fullzoom")


@query(written_sql(f"""SELECT z, x_min, x_max, y_min, y_max, round((x_min * s - {HALF_WORLD}) * 180 / {HALF_WORLD}, 6) AS west, round(degrees(2 * atan(exp(({HALF_WORLD} - (y_max + 1) * s) / {RADIUS})) - pi() / 2), 6) AS south,
    round(((x_max + 1) * s - {HALF_WORLD}) * 180 / {HALF_WORLD}, 6) AS east, round(degrees(2 * atan(exp(({HALF_WORLD} - y_min * s) / {RADIUS})) - pi() / 2), 6) AS north
    FROM (SELECT z, min(x) AS x_min, max(x) AS x_max, min(y) AS y_min, max(y) AS y_max, {2 * HALF_WORLD} / 16 AS s FROM written WHERE z = 4 GROUP BY z)"""))
def tileset_extent(spark, sf_dir):
    e = tileset.extent(tileset.per_zoom(_written(spark, sf_dir)), detail_zoom=5)
    return e.select("z", "x_min", "x_max", "y_min", "y_max", *(F.round(c, 6).alias(c) for c in ("west", "south", "east", "north")))


ARC = """
    , seg AS (SELECT g, start AS lo, start + hi - lo AS hi, hi - lo >= 360 AS world FROM (SELECT g, lo, hi, (lo + 180) - 360 * floor((lo + 180) / 360) - 180 AS start FROM spans)),
    marked AS (SELECT *, CASE WHEN lo <= max(hi) OVER (PARTITION BY g ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM seg),
    runs AS (SELECT g, run, min(lo) AS lo, max(hi) AS hi, bool_or(world) AS world FROM (SELECT *, sum(new) OVER (PARTITION BY g ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS run FROM marked) GROUP BY g, run),
    gaps AS (SELECT g, run, bool_or(world) OVER (PARTITION BY g) AS world, min(lo) OVER (PARTITION BY g) AS first_lo, max(hi) OVER (PARTITION BY g) AS last_hi, lead(lo) OVER (PARTITION BY g ORDER BY run) AS next_lo, hi FROM runs),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY gap DESC, run) AS rank FROM (SELECT g, run, world, coalesce(next_lo - hi, first_lo + 360 - last_hi) AS gap, coalesce(next_lo, first_lo) AS w, CASE WHEN next_lo IS NULL THEN last_hi ELSE hi END AS e FROM gaps)),
    arcs AS (SELECT g, CASE WHEN world OR gap <= 0 THEN -180 ELSE CASE WHEN w > 180 THEN w - 360 ELSE w END END AS west, CASE WHEN world OR gap <= 0 THEN 180 ELSE CASE WHEN e > 180 THEN e - 360 ELSE e END END AS east FROM ranked WHERE rank = 1)"""


@query(with_views(f", spans AS (SELECT ord % 25 AS g, west + ord % 2 * 90 AS lo, east + ord % 2 * 90 AS hi FROM sheets){ARC} SELECT g, CAST(west AS DOUBLE) AS west, CAST(east AS DOUBLE) AS east FROM arcs", "sheets").replace(") , spans", "), spans", 1))
def covering_arc(spark, sf_dir):
    spans = views.sheets(spark, sf_dir).select((col("ord") % 25).alias("g"), (col("west") + col("ord") % 2 * 90).alias("lo"), (col("east") + col("ord") % 2 * 90).alias("hi"))
    return bounds.covering_arc(spans, ["g"])


@query(with_views(f""", spans AS (SELECT ord % 10 AS g, west AS lo, east AS hi FROM sheets){ARC}
    SELECT g, CAST(west AS DOUBLE) AS west, south, CAST(east AS DOUBLE) AS east, north, CAST(CASE WHEN m > 180 THEN m - 360 ELSE m END AS DOUBLE) AS centre_lon, (south + north) / 2 AS centre_lat
    FROM (SELECT *, west + (CASE WHEN east >= west THEN east - west ELSE east - west + 360 END) / 2 AS m FROM arcs) JOIN (SELECT ord % 10 AS g, min(south) AS south, max(north) AS north FROM sheets GROUP BY 1) USING (g)""", "sheets").replace(") , spans", "), spans", 1))
def data_bounds(spark, sf_dir):
    s = views.sheets(spark, sf_dir).select((col("ord") % 10).alias("g"), col("west").alias("lon_lo"), col("east").alias("lon_hi"), col("south").alias("lat_lo"), col("north").alias("lat_hi"))
    return bounds.data_bounds(s, ["g"])


@query(written_sql("SELECT count(*) AS tiles, CAST(sum(nbytes) AS BIGINT) AS bytes, min(z) AS minzoom, max(z) AS maxzoom, 'chart' AS name, 'xyz' AS convention, '{z}/{x}/{y}.png' AS url_template, count(*) FILTER (WHERE z = 5) AS at_five FROM written"))
def metadata_row(spark, sf_dir):
    by_zoom = tileset.per_zoom(_written(spark, sf_dir))
    s = views.sheets(spark, sf_dir).select(col("west").alias("lon_lo"), col("east").alias("lon_hi"), col("south").alias("lat_lo"), col("north").alias("lat_hi"), lit(0).alias("g"))
    row = tileset.metadata(tileset.totals(by_zoom, 5), tileset.extent(by_zoom, 5), bounds.data_bounds(s, ["g"]), name="chart", source="sheets", tile_format="png", scheme="geographic", crs="EPSG:4326", native_zoom=5, sources=["sheets"])
    parsed = F.from_json("metadata", "tiles long, bytes long, minzoom int, maxzoom int, name string, convention string, url_template string, tiles_per_zoom map<string,long>")
    return row.select(parsed.alias("m")).select("m.tiles", "m.bytes", "m.minzoom", "m.maxzoom", "m.name", "m.convention", "m.url_template", col("m.tiles_per_zoom")["5"].alias("at_five"))


# -- accounting ------------------------------------------------------------------

REQUESTS = """, rows AS (SELECT *, CAST(regexp_extract(url, '(\\d+)/(\\d+)/(\\d+)', 1) AS BIGINT) AS z, CAST(regexp_extract(url, '(\\d+)/(\\d+)/(\\d+)', 2) AS BIGINT) AS x, CAST(regexp_extract(url, '(\\d+)/(\\d+)/(\\d+)', 3) AS BIGINT) AS y,
    CASE WHEN transfer = 0 AND encoded = 0 AND decoded = 0 THEN 'opaque' WHEN encoded > 0 AND transfer < encoded THEN 'cached' ELSE 'downloaded' END AS class FROM requests WHERE url LIKE '/tiles/%')"""


def requests_sql(select: str) -> str:
    return with_views(f"{REQUESTS} {select}", "requests").replace(") , rows", "), rows", 1)


def _requests(spark, sf_dir):
    return account.classified(views.requests(spark, sf_dir), "/tiles/")


SUMS = "count(*) FILTER (WHERE class = 'downloaded') AS downloaded, count(*) FILTER (WHERE class = 'cached') AS cached, count(*) FILTER (WHERE class = 'opaque') AS opaque, CAST(sum(transfer) AS BIGINT) AS network, CAST(sum(CASE WHEN class = 'downloaded' THEN encoded ELSE 0 END) AS BIGINT) AS payload, CAST(sum(decoded) AS BIGINT) AS imagery"


@query(requests_sql(f"SELECT event_type, {SUMS} FROM rows GROUP BY event_type"))
def request_classes(spark, sf_dir):
    return account.totals(_requests(spark, sf_dir), ["event_type"])


@query(requests_sql("SELECT z, count(*) AS requests FROM rows GROUP BY z"))
def requests_by_level(spark, sf_dir):
    return account.by_level(_requests(spark, sf_dir))


@query(requests_sql(f"SELECT user_id, downloaded, payload, CAST(round(payload / nullif(downloaded, 0)) AS BIGINT) AS average FROM (SELECT user_id, {SUMS} FROM rows GROUP BY user_id)"))
def avg_tile(spark, sf_dir):
    return account.average_tile(account.totals(_requests(spark, sf_dir), ["user_id"])).select("user_id", "downloaded", "payload", "average")


@query(requests_sql("SELECT user_id, arg_max(z || '/' || x || '/' || y, (ts, event_id)) AS last FROM rows GROUP BY user_id"))
def last_tile(spark, sf_dir):
    return account.last_tile(_requests(spark, sf_dir), ["user_id"])


@query(requests_sql("SELECT z, count(DISTINCT (x, y)) AS n, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM rows GROUP BY z"))
def visible_bbox(spark, sf_dir):
    return account.visible(_requests(spark, sf_dir))


@query(requests_sql("SELECT event_id, CASE WHEN encoded < 1024 THEN encoded || ' B' ELSE printf('%.1f KB', floor(encoded / CAST(1024 AS DOUBLE) * 10 + 0.5) / 10) END AS size FROM rows"))
def readable_sizes(spark, sf_dir):
    return _requests(spark, sf_dir).select("event_id", text.readable_bytes(col("encoded")).alias("size"))


# -- the catalog of series --------------------------------------------------------


@query("""SELECT p_partkey, regexp_full_match(p_name, '.+ .*[aeiou]', 'i') AS any_name, regexp_full_match(p_type, '(STANDARD|PROMO).+', 'i') AS tif, regexp_full_match(p_brand, 'brand#\\d\\d?', 'i') AS zip FROM part""")
def pattern_match(spark, sf_dir):
    p = views.table(spark, sf_dir, "part")
    return p.select("p_partkey", text.full_match(col("p_name"), ".+ .*[aeiou]").alias("any_name"), text.full_match(col("p_type"), "(STANDARD|PROMO).+").alias("tif"), text.full_match(col("p_brand"), r"brand#\d\d?").alias("zip"))


@query("""WITH names AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'Mariana Islands Inset SEC.tif' WHEN 1 THEN 'mariana islands inset sec.TIF' WHEN 2 THEN 'ENR_L' || lpad(CAST(p_partkey % 100 AS VARCHAR), 2, '0') || 'N.tif' WHEN 3 THEN 'Chart ' || p_partkey || ' TAC.tif' ELSE 'notes.txt' END AS name FROM part)
    SELECT p_partkey, regexp_full_match(name, '.+\\.tif', 'i') AND name NOT IN ('Mariana Islands Inset SEC.tif', 'Samoan Islands Inset SEC.tif') AS sectionals, regexp_full_match(name, 'ENR_L\\d\\d[NS]?\\.tif', 'i') AS low, regexp_full_match(name, '.+ TAC\\.tif', 'i') AS tac FROM names""")
def excluded_names(spark, sf_dir):
    n, k = views.table(spark, sf_dir, "part"), col("p_partkey")
    name = F.when(k % 5 == 0, "Mariana Islands Inset SEC.tif").when(k % 5 == 1, "mariana islands inset sec.TIF").when(k % 5 == 2, F.concat(lit("ENR_L"), F.lpad((k % 100).cast("string"), 2, "0"), lit("N.tif"))).when(k % 5 == 3, F.concat(lit("Chart "), k.cast("string"), lit(" TAC.tif"))).otherwise("notes.txt")
    of = lambda s: charts.wants(name, charts.one(s), "tif")
    return n.select("p_partkey", of("sectionals").alias("sectionals"), of("ifr-low").alias("low"), of("tac").alias("tac"))


@query("""SELECT o_custkey, CAST(max(d) AS VARCHAR) AS date, 'charts/' || strftime(max(d), '%m-%d-%Y') || '/a.zip' AS link FROM (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders) WHERE d <= DATE '1998-06-30' GROUP BY o_custkey""")
def current_edition(spark, sf_dir):
    o = views.table(spark, sf_dir, "orders").select("o_custkey", F.concat(lit("charts/"), F.date_format(col("o_orderdate").cast("date"), "MM-dd-yyyy"), lit("/a.zip")).alias("link"))
    dated = o.withColumn("date", text.edition_date(col("link")))
    return charts.current_edition(dated, lit("1998-06-30").cast("date"), ["o_custkey"]).select("o_custkey", col("date").cast("string").alias("date"), "link")


@query("""SELECT i.o_orderkey, o.o_orderkey IS NULL AS missing FROM orders i LEFT JOIN (SELECT o_orderkey, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 5 - 1 AS INTEGER) AS made FROM orders WHERE o_orderkey % 7 <> 0) o USING (o_orderkey) WHERE o.o_orderkey IS NULL OR o.made < CAST(i.o_orderdate AS DATE)""")
def stage_staleness(spark, sf_dir):
    o = views.table(spark, sf_dir, "orders").select("o_orderkey", col("o_orderdate").cast("date").alias("mtime"))
    made = o.where("o_orderkey % 7 <> 0").select("o_orderkey", F.date_add("mtime", (col("o_orderkey") % 5 - 1).cast("int")).alias("mtime"))
    return charts.stale(o, made, "o_orderkey")


@query("SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT s_suppkey * 3 FROM supplier)")
def missing_manifest(spark, sf_dir):
    have = views.table(spark, sf_dir, "supplier").select((col("s_suppkey") * 3).alias("p_partkey"))
    return charts.missing(views.table(spark, sf_dir, "part"), have, "p_partkey")


@query("""SELECT * FROM (VALUES ('sectionals', 2, 'upsample', true), ('ifr-low', 4, 'render,heal', false), ('ifr-high', 4, 'render', false), ('tac', 2, 'upsample', true), ('sectionals-tac', 1, '', true)) AS t(name, scale, stages, fetches_tifs)""")
def pixel_scale(spark, sf_dir):
    s = charts.series(spark)
    return s.select("name", charts.pixel_scale(col("pdf_scale"), col("upsample_scale")).alias("scale"), F.array_join(charts.stages(col("pdf_scale"), col("upsample_scale"), col("heal")), ",").alias("stages"), charts.fetches_tifs(col("pdf_scale")).alias("fetches_tifs"))


@query("SELECT * FROM (VALUES ('sectionals-tac', 0, 'sectionals', false), ('sectionals-tac', 1, 'tac', true)) AS t(name, layer, member, detail)")
def composite_members(spark, sf_dir):
    return charts.members(charts.series(spark))


@query("""SELECT s_suppkey, before + CASE WHEN layer = 1 THEN row_number() OVER (PARTITION BY layer ORDER BY s_name DESC) ELSE row_number() OVER (PARTITION BY layer ORDER BY s_name) END - 1 AS ord
    FROM (SELECT s_suppkey, s_name, s_suppkey % 3 AS layer FROM supplier) JOIN (SELECT layer, CAST(coalesce(sum(n) OVER (ORDER BY layer ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before FROM (SELECT s_suppkey % 3 AS layer, count(*) AS n FROM supplier GROUP BY 1)) USING (layer)""")
def paint_order(spark, sf_dir):
    s = views.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", (col("s_suppkey") % 3).alias("layer"), (col("s_suppkey") % 3 == 1).alias("reverse"))
    return charts.paint_order(s, name="s_name").select("s_suppkey", "ord")


@query("""WITH sheets AS (SELECT p_partkey, 'ENR_L' || p_partkey || CASE p_partkey % 3 WHEN 0 THEN 'N' WHEN 1 THEN 'S' ELSE '' END AS stem FROM part), pdfs AS (SELECT 'ENR_L' || p_partkey AS stem FROM part WHERE p_partkey % 4 <> 0 UNION ALL SELECT 'ENR_L' || p_partkey || 'N' FROM part WHERE p_partkey % 6 = 0)
    SELECT p_partkey, coalesce(a.stem, b.stem) AS pdf FROM sheets s LEFT JOIN pdfs a ON s.stem = a.stem LEFT JOIN pdfs b ON rtrim(s.stem, 'NS') = b.stem""")
def pdf_lookup(spark, sf_dir):
    p, k = views.table(spark, sf_dir, "part"), col("p_partkey")
    base = F.concat(lit("ENR_L"), k.cast("string"))
    s = p.select("p_partkey", F.concat(base, F.when(k % 3 == 0, "N").when(k % 3 == 1, "S").otherwise("")).alias("stem"))
    pdfs = p.where(k % 4 != 0).select(base.alias("stem")).union(p.where(k % 6 == 0).select(F.concat(base, lit("N")).alias("stem")))
    return charts.pdf_for(s, pdfs).select("p_partkey", "pdf")


@query("""SELECT p_partkey, o0 >= 0 AND o0 < c0 AND c0 < c2 AND c2 < o2 AND o2 <= 1000 AND o0 < c0 AND c0 < c2 AND c2 < o2 AND o2 <= 900 AS plausible, CASE WHEN p_partkey % 2 = 0 THEN o0 ELSE c0 END AS x0, CASE WHEN p_partkey % 2 = 0 THEN o2 ELSE c2 END AS x1
    FROM (SELECT p_partkey, p_partkey % 20 - 2 AS o0, p_partkey % 20 + p_size % 3 AS c0, 880 + p_partkey % 25 - p_size % 4 AS c2, 882 + p_partkey % 25 AS o2 FROM part)""")
def frame_plausible(spark, sf_dir):
    k, s = col("p_partkey"), col("p_size")
    o0, c0, c2, o2 = k % 20 - 2, k % 20 + s % 3, 880 + k % 25 - s % 4, 882 + k % 25
    box = detect.map_area(F.array(o0, o0, o2, o2), F.array(c0, c0, c2, c2), k % 2 == 0)
    ok = detect.plausible_frame(F.array(o0, o0, o2, o2), F.array(c0, c0, c2, c2), lit(1000), lit(900))
    return views.table(spark, sf_dir, "part").select("p_partkey", ok.alias("plausible"), box[0][0].cast("long").alias("x0"), box[1][0].cast("long").alias("x1"))


# -- detection ------------------------------------------------------------------


def _gray(spark, sf_dir):
    """Chips as small sheets: ``sheet, col, row, r, g, b, width``."""
    c = views.chips(spark, sf_dir)
    return c.select(col("vec_id").alias("sheet"), col("px").alias("col"), col("py").alias("row"), col("c").alias("r"), col("c").alias("g"), F.least(col("c") + 5 * (col("vec_id") % 5), lit(255)).cast("int").alias("b"), lit(8).alias("width"))


GRAY = "gray AS (SELECT vec_id AS sheet, px AS col, py AS row, c AS r, c AS g, CAST(least(c + 5 * (vec_id % 5), 255) AS INTEGER) AS b FROM chips)"


def gray_sql(select: str) -> str:
    return with_views(f", {GRAY} {select}", "chips").replace(") , gray", "), gray", 1)


@query(gray_sql("SELECT sheet, row, round(avg(CASE WHEN greatest(r, g, b) < 110 THEN 1 ELSE 0 END), 6) AS fraction FROM gray WHERE col >= 2 AND col < 5 GROUP BY sheet, row"))
def dark_fraction(spark, sf_dir):
    return detect.dark_fraction(_gray(spark, sf_dir), "row", "col", "width").select("sheet", "row", F.round("fraction", 6).alias("fraction"))


@query(gray_sql("SELECT sheet, count(*) FILTER (WHERE least(r, g, b) < 128) AS ink, count(*) FILTER (WHERE least(r, g, b) >= 120) AS paper, count(*) FILTER (WHERE greatest(r, g, b) - least(r, g, b) > 10) AS chroma FROM gray GROUP BY sheet"))
def pixel_flags(spark, sf_dir):
    c = [col(x) for x in "rgb"]
    return _gray(spark, sf_dir).groupBy("sheet").agg(F.count_if(pixels.ink(*c)).alias("ink"), F.count_if(pixels.paper(*c, 120)).alias("paper"), F.count_if(pixels.chroma(*c)).alias("chroma"))


RUNS = """, full_lines AS (SELECT user_id % 10 AS g, event_id AS i, event_id - row_number() OVER (PARTITION BY user_id % 10 ORDER BY event_id) AS run FROM (SELECT event_id // 16 AS user_id, event_id FROM events WHERE (event_id * 37) % 11 < 9)),
    runs AS (SELECT g, min(i) AS first, max(i) AS last FROM full_lines GROUP BY g, run HAVING max(i) - min(i) + 1 >= 3)"""


def _runs(spark, sf_dir):
    e = views.table(spark, sf_dir, "events").select(F.floor(col("event_id") / 16 % 10).cast("long").alias("g"), col("event_id").alias("i"), F.when((col("event_id") * 37) % 11 < 9, 1.0).otherwise(0.0).alias("fraction"))
    return detect.thick_runs(e, ["g"], "i", 0.9, 3)


@query("WITH " + RUNS[2:] + " SELECT g, first, last FROM runs")
def thick_runs(spark, sf_dir):
    return _runs(spark, sf_dir)


@query("WITH " + RUNS[2:] + """, pairs AS (SELECT g, first AS a_first, last AS a_last, lead(first) OVER w AS b_first, lead(last) OVER w AS b_last FROM runs WINDOW w AS (PARTITION BY g ORDER BY first)),
    ranked AS (SELECT *, b_first - a_last AS gap, row_number() OVER (PARTITION BY g ORDER BY b_first - a_last DESC, a_first) AS rank FROM pairs WHERE b_first IS NOT NULL) SELECT g, a_first, a_last, b_first, b_last, gap, 0 AS others FROM ranked WHERE rank = 1""")
def widest_panel(spark, sf_dir):
    return detect.widest_panel(_runs(spark, sf_dir), ["g"])


@query(gray_sql(", flags AS (SELECT sheet, row, col, r > 120 AS f FROM gray), runs AS (SELECT sheet, row, count(*) AS n FROM (SELECT sheet, row, col - row_number() OVER (PARTITION BY sheet, row ORDER BY col) AS run FROM flags WHERE f) GROUP BY sheet, row, run) SELECT f.sheet, f.row, coalesce(max(n), 0) AS longest FROM (SELECT DISTINCT sheet, row FROM flags) f LEFT JOIN runs USING (sheet, row) GROUP BY f.sheet, f.row").replace(") , flags", "), flags"))
def longest_run(spark, sf_dir):
    return detect.longest_run(_gray(spark, sf_dir).withColumn("f", col("r") > 120), ["sheet", "row"], "col", "f")


@query(gray_sql(", lit AS (SELECT *, greatest(r, g, b) - least(r, g, b) > 10 AS f FROM gray), c AS (SELECT sheet, min(col) AS a, max(col) AS b FROM (SELECT sheet, col FROM lit GROUP BY sheet, col HAVING avg(CAST(f AS INTEGER)) > 0.25) GROUP BY sheet), r AS (SELECT sheet, min(row) AS a, max(row) AS b FROM (SELECT sheet, row FROM lit GROUP BY sheet, row HAVING avg(CAST(f AS INTEGER)) > 0.25) GROUP BY sheet) SELECT sheet, CAST(c.a * 8 AS INTEGER) AS \"left\", CAST(r.a * 8 AS INTEGER) AS top, CAST((c.b + 1) * 8 AS INTEGER) AS \"right\", CAST((r.b + 1) * 8 AS INTEGER) AS bottom FROM c JOIN r USING (sheet)").replace(") , lit", "), lit"))
def neatline_bbox(spark, sf_dir):
    return detect.chroma_box(_gray(spark, sf_dir))


@query(gray_sql("SELECT sheet, side, count(*) AS n, round(avg(CAST(paper AS INTEGER)), 6) AS paper FROM (SELECT sheet % 20 AS sheet, CASE WHEN col <= least(8 - col, row, 8 - row) THEN 'west' WHEN 8 - col <= least(row, 8 - row) THEN 'east' WHEN row <= 8 - row THEN 'north' ELSE 'south' END AS side, least(r, g, b) >= 120 AS paper FROM gray) GROUP BY sheet, side HAVING count(*) > 50"))
def paper_by_side(spark, sf_dir):
    g = _gray(spark, sf_dir).select((col("sheet") % 20).alias("sheet"), "col", "row", lit(8).alias("cols"), lit(8).alias("rows"), pixels.paper(col("r"), col("g"), col("b"), 120).alias("paper"))
    return detect.paper_by_side(g).select("sheet", "side", "n", F.round("paper", 6).alias("paper"))


BAND = "SELECT event_id % 25 AS band, event_id // 25 AS i, CAST(CASE WHEN event_id // 25 < 40 + event_id % 25 THEN 0.9 ELSE ((event_id * 13) % 28) / 100.0 END AS DOUBLE) AS fraction FROM events"


@query(f"WITH p AS ({BAND}), w AS (SELECT band, i, avg(fraction) OVER (PARTITION BY band ORDER BY i ROWS BETWEEN CURRENT ROW AND 11 FOLLOWING) AS near, median(fraction) OVER (PARTITION BY band ORDER BY i ROWS BETWEEN CURRENT ROW AND 29 FOLLOWING) AS ahead, count(*) OVER (PARTITION BY band ORDER BY i ROWS BETWEEN CURRENT ROW AND 30 FOLLOWING) AS n FROM p) SELECT band, min(i) AS depth FROM w WHERE near < 0.35 AND ahead < 0.3 AND n = 31 GROUP BY band")
def collar_onset(spark, sf_dir):
    i, band = F.floor(col("event_id") / 25).cast("long"), col("event_id") % 25
    p = views.table(spark, sf_dir, "events").select(band.alias("band"), i.alias("i"), F.when(i < 40 + band, 0.9).otherwise(((col("event_id") * 13) % 28) / 100.0).alias("fraction"))
    return detect.collar_onset(p, ["band"], onset=12, run=30)


@query("""WITH p AS (SELECT s_nationkey AS side, CAST(s_suppkey AS DOUBLE) AS pos, CAST((s_suppkey * 7) % 40 + CASE WHEN s_suppkey % 6 = 0 THEN 300 ELSE 0 END AS DOUBLE) AS depth FROM supplier),
    m AS (SELECT side, median(depth) AS m FROM p GROUP BY side), d AS (SELECT p.*, abs(depth - m) AS d FROM p JOIN m USING (side)), k AS (SELECT side, median(d) AS mad FROM d GROUP BY side)
    SELECT side, CASE WHEN count(*) > 1 THEN round(regr_slope(depth, pos), 6) + 0 END AS slope, CASE WHEN count(*) > 1 THEN round(regr_intercept(depth, pos), 6) + 0 END AS intercept, count(*) AS kept FROM d JOIN k USING (side) WHERE d <= greatest(60, 3 * mad) GROUP BY side""")
def robust_fit(spark, sf_dir):
    s = views.table(spark, sf_dir, "supplier").select(col("s_nationkey").alias("side"), col("s_suppkey").cast("double").alias("pos"), ((col("s_suppkey") * 7) % 40 + F.when(col("s_suppkey") % 6 == 0, 300).otherwise(0)).cast("double").alias("depth"))
    return detect.trimmed_line(s, ["side"]).select("side", (F.round("slope", 6) + 0.0).alias("slope"), (F.round("intercept", 6) + 0.0).alias("intercept"), "kept")


# -- registration ---------------------------------------------------------------


@query(gray_sql("SELECT sheet, row, count(*) AS total FROM gray WHERE least(r, g, b) < 128 GROUP BY sheet, row"))
def ink_profile(spark, sf_dir):
    g = _gray(spark, sf_dir).withColumn("ink", pixels.ink(col("r"), col("g"), col("b")))
    return register.profile(g, ["sheet"], "row")


@query("""WITH page AS (SELECT event_id // 100 AS g, event_id % 100 AS i, (event_id * 7919) % 97 AS total FROM events), sheet AS (SELECT g, i, (((g * 100 + i + 10 + g % 60) * 7919) % 97) + i % 2 AS total FROM page WHERE i < 30),
    met AS (SELECT s.g, k.s AS s, sum(CAST(s.total AS DOUBLE) * p.total) AS ab, sum(CAST(s.total AS DOUBLE) * s.total) AS aa, sum(CAST(p.total AS DOUBLE) * p.total) AS bb FROM sheet s, range(71) AS k(s), page p WHERE p.g = s.g AND p.i = s.i + k.s GROUP BY s.g, k.s),
    scored AS (SELECT g, s, round(CASE WHEN aa * bb > 0 THEN ab / sqrt(aa * bb) ELSE 0 END, 9) AS score FROM met) SELECT g, s, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY score DESC, s) AS rank FROM scored) WHERE rank = 1""")
def best_shift(spark, sf_dir):
    e = views.table(spark, sf_dir, "events")
    page = e.select(F.floor(col("event_id") / 100).cast("long").alias("g"), (col("event_id") % 100).alias("i"), ((col("event_id") * 7919) % 97).alias("total"))
    sheet = page.where("i < 30").select("g", "i", (((col("g") * 100 + col("i") + 10 + col("g") % 60) * 7919) % 97 + col("i") % 2).alias("total"))
    return register.best_shift(page, sheet, ["g"]).select("g", "s", F.round("score", 6).alias("score"))


@query("SELECT a.label, round(CASE WHEN sum(x * x) * sum(y * y) > 0 THEN sum(x * y) / sqrt(sum(x * x) * sum(y * y)) ELSE 0 END, 6) AS match FROM (SELECT label, vec_id, CAST(unnest(embedding) AS DOUBLE) AS x, CAST(unnest(list_reverse(embedding)) AS DOUBLE) AS y FROM embeddings) a GROUP BY a.label")
def cosine_match(spark, sf_dir):
    e = views.table(spark, sf_dir, "embeddings").select("label", F.explode(F.arrays_zip(col("embedding").alias("x"), F.reverse("embedding").alias("y"))).alias("p"))
    x, y = col("p.x").cast("double"), col("p.y").cast("double")
    return e.groupBy("label").agg(F.round(register.cosine(F.sum(x * y), F.sum(x * x), F.sum(y * y)), 6).alias("match"))


@query("""WITH p AS (SELECT event_id // 5 AS g, event_id % 7 - 3 AS dx, (event_id * 3) % 5 - 2 AS dy, ((event_id * 31) % 100) / CAST(100 AS DOUBLE) AS score FROM events), m AS (SELECT g, trunc(median(dx)) AS mx, trunc(median(dy)) AS my, median(score) AS match FROM p GROUP BY g),
    v AS (SELECT g, mx, my, match, max(greatest(abs(dx - mx), abs(dy - my))) AS spread FROM p JOIN m USING (g) GROUP BY ALL) SELECT g, CAST(mx AS INTEGER) AS dx, CAST(my AS INTEGER) AS dy, CAST(spread AS INTEGER) AS spread, round(match, 6) AS match, spread > 2 OR match < 0.7 AS doubtful FROM v""")
def offset_vote(spark, sf_dir):
    p = views.table(spark, sf_dir, "events").select(F.floor(col("event_id") / 5).cast("long").alias("g"), (col("event_id") % 7 - 3).alias("dx"), ((col("event_id") * 3) % 5 - 2).alias("dy"), (((col("event_id") * 31) % 100) / 100.0).alias("score"))
    return register.vote(p, ["g"]).withColumn("match", F.round("match", 6))


# -- healing and resampling ------------------------------------------------------


HEALED = """, place AS MATERIALIZED (SELECT vec_id, px, py, px >= 1 AND px < 8 AND py < 7 AS framed, c FROM chips),
    wanted AS MATERIALIZED (SELECT vec_id, px, py, CASE WHEN framed THEN least(greatest(px, 3), 5) ELSE px END AS sx, CASE WHEN framed THEN least(greatest(py, 2), 4) ELSE py END AS sy FROM place)
    SELECT w.vec_id AS sheet, w.px AS col, w.py AS row, s.c FROM wanted w JOIN place s ON s.vec_id = w.vec_id AND s.px = w.sx AND s.py = w.sy"""


@query(with_views(HEALED, "chips").replace(") , place", "), place", 1))
def heal_clamp(spark, sf_dir):
    p = views.chips(spark, sf_dir).select(col("vec_id").alias("sheet"), col("px").alias("col"), col("py").alias("row"), "c")
    frames = p.select("sheet").distinct().select("sheet", F.array(lit(1), lit(0), lit(8), lit(7)).alias("outer"), F.array(lit(3), lit(2), lit(6), lit(5)).alias("clean"))
    return resample.heal(p, frames, ("c",))


@query(with_views("SELECT vec_id, CAST(px * 2 + dx AS INTEGER) AS px, CAST(py * 2 + dy AS INTEGER) AS py, c FROM chips, range(2) AS i(dx), range(2) AS j(dy)", "chips"))
def upsample_nearest_2x(spark, sf_dir):
    return resample.upsample_nearest(views.chips(spark, sf_dir), ["vec_id"], ["c"])


@query(with_views(""", up AS (SELECT vec_id, px * 2 + dx AS px, py * 2 + dy AS py, c + dx * 40 - dy * 3 AS c FROM chips, range(2) AS i(dx), range(2) AS j(dy)),
    env AS (SELECT vec_id, px + dx AS sx, py + dy AS sy, min(c) AS low, max(c) AS high FROM chips, range(-1, 2) AS i(dx), range(-1, 2) AS j(dy) GROUP BY ALL HAVING count(*) = 9),
    over AS (SELECT vec_id, greatest(c - high, 0) + greatest(low - c, 0) AS o FROM up JOIN env USING (vec_id) WHERE sx = px // 2 AND sy = py // 2),
    m AS (SELECT vec_id, avg(CAST(o > 1 AS INTEGER)) * 100 AS ringing, max(o) AS worst FROM over GROUP BY vec_id),
    gx AS (SELECT a.vec_id, avg(abs(b.c - a.c)) AS g FROM up a JOIN up b ON a.vec_id = b.vec_id AND b.px = a.px + 1 AND b.py = a.py GROUP BY 1), gy AS (SELECT a.vec_id, avg(abs(b.c - a.c)) AS g FROM up a JOIN up b ON a.vec_id = b.vec_id AND b.py = a.py + 1 AND b.px = a.px GROUP BY 1)
    SELECT vec_id, round(ringing, 6) AS ringing, CAST(worst AS BIGINT) AS worst, round((gx.g + gy.g) / 2, 6) AS sharpness FROM m JOIN gx USING (vec_id) JOIN gy USING (vec_id)""", "chips").replace(") , up", "), up"))
def ringing_metrics(spark, sf_dir):
    c = views.chips(spark, sf_dir)
    up = resample.upsample_nearest(c, ["vec_id"], ["c"]).withColumn("c", col("c") + col("px") % 2 * 40 - col("py") % 2 * 3)
    m = resample.ringing(up, c, ["vec_id"])
    return m.select("vec_id", F.round("ringing", 6).alias("ringing"), col("worst").cast("long").alias("worst"), F.round("sharpness", 6).alias("sharpness"))


# -- discovery -------------------------------------------------------------------


@query(r"SELECT page_id, regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1) || link AS link FROM (SELECT page_id, url, unnest(regexp_extract_all(html, '(?i)href=\"([^\"]+)\"', 1)) AS link FROM pages)")
def link_extract(spark, sf_dir):
    return discover.page_links(views.table(spark, sf_dir, "pages"))


SETS = "SELECT s_suppkey, 'set' || lpad(CAST(s_suppkey AS VARCHAR), 5, '0') AS path, CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE 'Chart ' || (s_suppkey % 30) END AS title FROM supplier"


def _metadata(spark, sf_dir):
    k = col("s_suppkey")
    good = F.to_json(F.struct(F.concat(lit("Chart "), (k % 30).cast("string")).alias("name"), lit(5).alias("maxzoom")))
    return views.table(spark, sf_dir, "supplier").select(F.concat(lit("set"), F.lpad(k.cast("string"), 5, "0")).alias("folder"), F.when(k % 4 == 0, "{broken").otherwise(good).alias("content"))


@query(f"SELECT path, coalesce(title, path) AS name, title IS NOT NULL AS valid FROM ({SETS})")
def tileset_menu(spark, sf_dir):
    return discover.tilesets(_metadata(spark, sf_dir))


@query(f"SELECT path, CASE WHEN count(*) OVER (PARTITION BY name) > 1 THEN name || ' (' || path || ')' ELSE name END AS name FROM (SELECT path, coalesce(title, path) AS name FROM ({SETS}))")
def label_dedupe(spark, sf_dir):
    return discover.distinct_labels(discover.tilesets(_metadata(spark, sf_dir))).select("path", "name")


@query("SELECT DISTINCT s_nationkey AS k, 'local' AS origin FROM supplier UNION ALL SELECT DISTINCT c_nationkey, 'connected' FROM customer WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier)")
def connected_menu(spark, sf_dir):
    local = views.table(spark, sf_dir, "supplier").select(col("s_nationkey").alias("k")).distinct()
    return discover.menu(local, views.table(spark, sf_dir, "customer").select(col("c_nationkey").alias("k")), "k")


# -- smaller rules -----------------------------------------------------------------


@query(with_views("SELECT event_id, printf('oklch(%.3f 0.25 %.1f / 0.75)', floor((0.55 + 0.08 * s) * 1000 + 0.5) / 1000, floor((264 - 235 * s) * 10 + 0.5) / 10) AS colour FROM (SELECT event_id, least(greatest(z / CAST(16 AS DOUBLE), 0), 1) AS s FROM points)", "points"))
def zoom_colours(spark, sf_dir):
    return views.points(spark, sf_dir).select("event_id", text.zoom_colour(col("z"), lit(16), 0.75).alias("colour"))


@query(with_views("SELECT ord, CASE WHEN w > e THEN -180 + 1e-5 ELSE w END AS west, CASE WHEN w > e THEN 180 - 1e-5 ELSE e END AS east FROM (SELECT ord, CASE WHEN west + ord % 2 * 180 > 180 THEN west + ord % 2 * 180 - 360 ELSE west + ord % 2 * 180 END AS w, CASE WHEN east + ord % 2 * 180 > 180 THEN east + ord % 2 * 180 - 360 ELSE east + ord % 2 * 180 END AS e FROM sheets)", "sheets"))
def imagery_extent(spark, sf_dir):
    shift = col("ord") % 2 * 180
    e = bounds.imagery_extent(geo.normalise(col("west") + shift), col("south"), geo.normalise(col("east") + shift), col("north"))
    return views.sheets(spark, sf_dir).select("ord", e["west"].alias("west"), e["east"].alias("east"))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'http://h/' || s_suppkey || '/{z}/{x}/{y}.png' ELSE 'http://h/' || s_suppkey || '/{z}/{x}/{y}.webp' END AS url FROM supplier")
def source_templates(spark, sf_dir):
    k = col("s_suppkey").cast("string")
    spec = F.when(col("s_suppkey") % 3 == 0, F.concat(lit("http://h/"), k, lit("/{z}/{x}/{y}.png"))).when(col("s_suppkey") % 3 == 1, F.concat(lit("http://h/"), k, lit("/"))).otherwise(F.concat(lit("http://h/"), k))
    return views.table(spark, sf_dir, "supplier").select("s_suppkey", discover.source_template(spec, lit("{z}/{x}/{y}.webp")).alias("url"))


@query(with_views("SELECT vec_id, round(greatest(dx, dy), 6) AS scale FROM (SELECT vec_id, median(abs(r - c)) FILTER (WHERE r IS NOT NULL) AS dx, median(abs(b - c)) FILTER (WHERE b IS NOT NULL) AS dy FROM (SELECT vec_id, c, lead(c) OVER (PARTITION BY vec_id, py ORDER BY px) AS r, lead(c) OVER (PARTITION BY vec_id, px ORDER BY py) AS b FROM chips) GROUP BY vec_id)", "chips"))
def footprint_scale(spark, sf_dir):
    return resample.footprint_scale(views.chips(spark, sf_dir), ["vec_id"], "c").withColumn("scale", F.round("scale", 6))


@query("SELECT user_id, event_id, done, round(done / CAST(elapsed AS DOUBLE), 6) AS rate, round((total - done) * elapsed / CAST(done AS DOUBLE), 6) AS eta FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS done, event_id + 1 AS elapsed, count(*) OVER (PARTITION BY user_id) AS total FROM events)")
def progress_rate(spark, sf_dir):
    e = views.table(spark, sf_dir, "events").select("user_id", "event_id", (col("event_id") + 1).alias("elapsed"))
    done = account.progress(e, ["user_id"], "event_id", "elapsed")
    return done.select("user_id", "event_id", "done", F.round("rate", 6).alias("rate"), F.round("eta", 6).alias("eta"))


@query(with_views(f", {GRAY}, wide AS (SELECT sheet // 10 AS sheet, (sheet % 10) * 8 + col AS col, row, CASE WHEN (sheet % 10) IN (1, 7) AND col < 6 OR row IN (1, 2) THEN 0 ELSE 200 END AS v FROM gray), f AS (SELECT sheet, col, avg(CASE WHEN v < 110 THEN 1 ELSE 0 END) AS fraction FROM wide WHERE row >= 2 AND row < 5 GROUP BY sheet, col), r AS (SELECT sheet, min(col) AS first, max(col) AS last FROM (SELECT sheet, col, col - row_number() OVER (PARTITION BY sheet ORDER BY col) AS run FROM f WHERE fraction >= 0.9) GROUP BY sheet, run HAVING count(*) >= 6) SELECT sheet, min(first) AS x0, max(last) + 1 AS x1 FROM r GROUP BY sheet HAVING count(*) = 2", "chips").replace(") , gray", "), gray", 1))
def frame_rules(spark, sf_dir):
    g = _gray(spark, sf_dir)
    at = col("sheet") % 10
    v = F.when((at.isin(1, 7) & (col("col") < 6)) | col("row").isin(1, 2), 0).otherwise(200)
    wide = g.select(F.floor(col("sheet") / 10).cast("long").alias("sheet"), (at * 8 + col("col")).alias("col"), "row", v.alias("r"), v.alias("g"), v.alias("b"), "width")
    panel = detect.widest_panel(detect.thick_runs(detect.dark_fraction(wide, "col", "row", "width"), ["sheet"], "col"), ["sheet"])
    return panel.select("sheet", col("a_first").alias("x0"), (col("b_last") + 1).alias("x1"))


@query("SELECT s_nationkey AS folder, '{' || string_agg('\"' || s_name || '\":' || s_suppkey, ',' ORDER BY s_name) || '}' AS manifest FROM supplier GROUP BY s_nationkey")
def sorted_manifest(spark, sf_dir):
    s = views.table(spark, sf_dir, "supplier").withColumnRenamed("s_nationkey", "folder")
    return archives.manifest_text(s, "s_name", "s_suppkey", ["folder"])


@query("SELECT p_partkey, regexp_full_match(zip, 'ENR_L\\d\\d\\.zip', 'i') AND false OR regexp_full_match(zip, 'DELUS\\d{1,2}\\.zip', 'i') AS low, regexp_full_match(zip, '.+_TAC\\.zip', 'i') AS tac FROM (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'delus' || (p_partkey % 200) || '.zip' WHEN 1 THEN 'Chart_TAC.ZIP' ELSE 'ENR_L0' || (p_partkey % 10) || '.zip' END AS zip FROM part)")
def fetched_archives(spark, sf_dir):
    k = col("p_partkey")
    name = F.when(k % 3 == 0, F.concat(lit("delus"), (k % 200).cast("string"), lit(".zip"))).when(k % 3 == 1, "Chart_TAC.ZIP").otherwise(F.concat(lit("ENR_L0"), (k % 10).cast("string"), lit(".zip")))
    return views.table(spark, sf_dir, "part").select("p_partkey", charts.fetched(name, charts.one("ifr-low")).alias("low"), charts.fetched(name, charts.one("tac")).alias("tac"))


# -- kernels and streams, without a SQL form ----------------------------------------


def kernel_sql(size: int, side: int) -> str:
    """Rows ``(i, p, w)``: weight of source pixel ``p`` in target pixel ``i``, bicubic after the Gaussian of a reduction below 2."""
    from math import ceil, exp, floor, sqrt

    step, a = size / side, resample.CUBIC_A
    sigma = 0.5 * sqrt(step * step - 1)
    reach = max(1, ceil(3 * sigma))
    bell = {k: exp(-0.5 * (k / sigma) ** 2) for k in range(-reach, reach + 1)}
    cubic = lambda d: (a + 2) * d**3 - (a + 3) * d**2 + 1 if d <= 1 else a * (d**3 - 5 * d**2 + 8 * d - 4) if d < 2 else 0.0
    rows = []
    for i in range(side):
        at = (i + 0.5) * step - 0.5
        weights = [0.0] * size
        for p in range(floor(at) - 1, floor(at) + 3):
            if 0 <= p < size:
                for k, v in bell.items():
                    weights[min(max(p + k, 0), size - 1)] += cubic(abs(at - p)) * v / sum(bell.values())
        rows += [f"({i}, {p}, CAST({w!r} AS DOUBLE))" for p, w in enumerate(weights)]
    return f"(VALUES {', '.join(rows)})"


WARPED = f""", k(i, p, w) AS MATERIALIZED (SELECT * FROM {kernel_sql(8, 6)}), v AS MATERIALIZED (SELECT vec_id, px, py, CAST(c AS DOUBLE) * a / 255 AS c, a / CAST(255 AS DOUBLE) AS a FROM chips),
    across AS MATERIALIZED (SELECT vec_id, i AS px, py, sum(w * c) AS c, sum(w * a) AS a FROM v JOIN k ON k.p = v.px GROUP BY vec_id, i, py),
    done AS MATERIALIZED (SELECT vec_id, px, i AS py, greatest(sum(w * c), 0) AS c, greatest(sum(w * a), 0) AS a FROM across JOIN k ON k.p = across.py GROUP BY vec_id, px, i)
    SELECT vec_id AS chip, CAST(px AS INTEGER) AS px, CAST(py AS INTEGER) AS py, CASE WHEN a > 0 THEN CAST(round_even(least(c / a, 255), 0) AS INTEGER) ELSE 0 END AS c, CAST(round_even(least(a, 1) * 255, 0) AS INTEGER) AS a FROM done"""


@query(with_views(WARPED, "chips").replace(") , k(", "), k(", 1))
def warp_kernel(spark, sf_dir):
    c = views.chips(spark, sf_dir).select(col("vec_id").alias("chip"), "px", "py", "c", "a")
    return resample.warp_chips(c, 8, 0.75)


#: 48 measurements along each of many sides, some of them wild, some sides bent, some without a collar.
SIDE_POINTS = "SELECT event_id // 48 AS side, CAST(event_id % 48 * 100 AS DOUBLE) AS pos, CAST(CASE WHEN event_id // 48 % 5 = 4 THEN event_id % 3 ELSE 100 + (event_id * 7) % 40 + (event_id % 48) * (event_id // 48 % 9) + CASE WHEN event_id % 13 = 0 THEN 900 ELSE 0 END END AS DOUBLE) AS depth, 1 + CAST(event_id // 48 % 2 AS INTEGER) AS degree FROM events"


@query(f"WITH {fit_sql(SIDE_POINTS, 'side', 'p')} SELECT side, round(a, 4) + 0 AS a, round(b, 4) + 0 AS b, round(c, 4) + 0 AS c, round(shift, 4) AS shift, lo, hi FROM p_fit")
def collar_fit(spark, sf_dir):
    e, n = views.table(spark, sf_dir, "events"), col("event_id")
    side = F.floor(n / 48)
    depth = F.when(side % 5 == 4, n % 3).otherwise(100 + (n * 7) % 40 + n % 48 * (side % 9) + F.when(n % 13 == 0, 900).otherwise(0))
    points = e.select(side.alias("side"), (n % 48 * 100).alias("pos"), depth.alias("depth"), (1 + side % 2).cast("int").alias("degree"))
    fits = detect.fit_sides(points, ["side"], col("degree"))
    return fits.select("side", *((F.round(c, 4) + 0.0).alias(c) for c in ("a", "b", "c", "shift")), "lo", "hi")


@query(with_views("SELECT z, x, y, px, py, c AS r, c AS g, c AS b, a FROM chips", "chips"))
def png_encode(spark, sf_dir):
    """The pixels that come back from the encoded tiles."""
    packed = png.pack_chips(views.chips(spark, sf_dir), 8)
    return png.unpacked(png.decode(png.encode(packed, 8)), 8)


STACKED = """, layers AS MATERIALIZED (SELECT vec_id, x // 2 AS x, y // 2 AS y, px, py, CAST(c AS DOUBLE) AS c, a / CAST(255 AS DOUBLE) AS a FROM chips),
    under AS MATERIALIZED (SELECT *, coalesce(product(1 - a) OVER (PARTITION BY x, y, px, py ORDER BY vec_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1) AS t FROM layers),
    done AS MATERIALIZED (SELECT x, y, px, py, sum(t * a * c) AS pc, sum(t * a) AS pa FROM under GROUP BY x, y, px, py),
    bytes AS MATERIALIZED (SELECT x, y, px, py, CASE WHEN pa > 0 THEN CAST(round_even(least(pc / pa, 255), 0) AS INTEGER) ELSE 0 END AS c, CAST(round_even(least(pa, 1) * 255, 0) AS INTEGER) AS a FROM done)
    SELECT 7 AS z, x // 2 AS x, y // 2 AS y, CAST((x % 2 * 8 + px) // 2 AS INTEGER) AS px, CAST((y % 2 * 8 + py) // 2 AS INTEGER) AS py,
        CASE WHEN sum(a) > 0 THEN CAST(round_even(CAST(sum(c * a) AS DOUBLE) / sum(a), 0) AS INTEGER) ELSE 0 END AS c, CAST(round_even(sum(a) / CAST(4 AS DOUBLE), 0) AS INTEGER) AS a
    FROM bytes GROUP BY 2, 3, 4, 5 HAVING round_even(sum(a) / CAST(4 AS DOUBLE), 0) > 0"""


@query(with_views(STACKED, "chips").replace(") , layers", "), layers", 1))
def packed_tiles(spark, sf_dir):
    """Packed chips stacked four deep, composited and halved by the worker kernels."""
    c = views.chips(spark, sf_dir).withColumn("x", F.floor(col("x") / 2)).withColumn("y", F.floor(col("y") / 2))
    packed = png.pack_chips(c, 8, ["vec_id"]).withColumnRenamed("vec_id", "ord")
    halved = png.unpacked(overview.halve_packed(composite.composite_packed(packed, 8), 8), 8)
    return halved.where("a > 0").select("z", "x", "y", "px", "py", col("r").alias("c"), "a")


@query(planned_sql("SELECT z, x, y, round(pc, 6) AS pc, round(pa, 6) AS pa, n FROM (SELECT z, x, y, sum(t * a * c) AS pc, sum(t * a) AS pa, CAST(count(*) AS INTEGER) AS n FROM (SELECT *, coalesce(product(1 - a) OVER (PARTITION BY x, y ORDER BY ord DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1) AS t FROM plan) GROUP BY z, x, y)", z=4))
def seam_stateful(spark, sf_dir):
    plan = _planned(spark, sf_dir, 4)
    done = seams.assembled(spark, plan.select("z", "x", "y", "ord", "a", "c"))
    return done.withColumn("pc", F.round("pc", 6)).withColumn("pa", F.round("pa", 6))


@query(requests_sql(f"SELECT z, {SUMS} FROM rows GROUP BY z"))
def request_stream(spark, sf_dir):
    return traffic.counted(spark, views.requests(spark, sf_dir), "/tiles/")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plan, composite, finish and average down to the whole world, tile counts and mean colour by zoom."""
    level = composite.finish(composite.composite(_planned(spark, sf_dir), KEYS, ["c"]), KEYS, ["c"]).where("a > 0").withColumn("px", lit(0)).withColumn("py", lit(0))
    summed = lambda df: df.groupBy("z").agg(F.count("*").alias("tiles"), F.sum("c").alias("c"), F.sum("a").alias("a"))
    level = cut(level, "level")
    found = summed(level)
    for _ in range(2):
        level = cut(overview.halve(level, 1, ("c",)), "level")
        found = found.union(summed(level))
    return found


FLAGSHIP = FINISHED + "".join(f""", l{z} AS (SELECT * FROM (SELECT x >> 1 AS x, y >> 1 AS y, CASE WHEN sum(a) > 0 THEN CAST(round_even(CAST(sum(c * a) AS DOUBLE) / sum(a), 0) AS INTEGER) ELSE 0 END AS c, CAST(round_even(sum(a) / CAST(4 AS DOUBLE), 0) AS INTEGER) AS a FROM {'finished' if z == 4 else f'l{z + 1}'} WHERE a > 0 GROUP BY 1, 2) WHERE a > 0)""" for z in (4, 3))
QUERIES["pyramid"] = flagship
ORACLE_SQL["pyramid"] = stack_sql("SELECT 5 AS z, count(*) AS tiles, CAST(sum(c) AS BIGINT) AS c, CAST(sum(a) AS BIGINT) AS a FROM finished WHERE a > 0 UNION ALL SELECT 4, count(*), CAST(sum(c) AS BIGINT), CAST(sum(a) AS BIGINT) FROM l4 UNION ALL SELECT 3, count(*), CAST(sum(c) AS BIGINT), CAST(sum(a) AS BIGINT) FROM l3", FLAGSHIP, z=5)
