"""Queries of smaller rules: windows, labels, sites, stages, doubled blocks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessella.functions import geo
from tessella.functions.grid import HALF_WORLD, RADIUS
from tessella.operators import account, discover, resample
from tessella.plans import catalog as charts
from tessella.plans import tiles, views
from tessella.plans.views import with_views
from tessella.registry import query
from tessella.sources import fetch
from tessella.streaming import rescans

col, lit = F.col, F.lit


# -- windows and labels ----------------------------------------------------------


@query("SELECT l_suppkey, l_orderkey, n, CAST(coalesce(sum(n) OVER (PARTITION BY l_suppkey ORDER BY l_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM (SELECT l_suppkey, l_orderkey, count(*) AS n FROM lineitem GROUP BY ALL)")
def window_starts(spark, sf_dir):
    """Orders stand for the windows of a supplier's sheet, their lines for the tiles."""
    w = views.table(spark, sf_dir, "lineitem").groupBy(col("l_suppkey").alias("ord"), col("l_orderkey").alias("by")).agg(F.count("*").alias("tiles")).withColumn("z", lit(0)).withColumn("bx", lit(0))
    return tiles.window_starts(w).select(col("ord").alias("l_suppkey"), col("by").alias("l_orderkey"), col("tiles").alias("n"), "start")


@query("SELECT l_suppkey, l_orderkey, l_linenumber FROM (SELECT DISTINCT l_suppkey, l_orderkey, l_linenumber FROM lineitem) QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber) <= 5")
def trial_blocks(spark, sf_dir):
    """The first five blocks of each sheet: a limit for trials is what this is for."""
    b = views.table(spark, sf_dir, "lineitem").select(col("l_suppkey").alias("ord"), col("l_orderkey").alias("by"), col("l_linenumber").alias("bx")).distinct()
    return tiles.first_blocks(b, 5).select(col("ord").alias("l_suppkey"), col("by").alias("l_orderkey"), col("bx").alias("l_linenumber"))


@query("SELECT p_partkey, greatest(0, least(p_size, CAST(floor(p_retailprice * 10000 / CAST(524288 AS DOUBLE)) AS BIGINT))) AS slots FROM part")
def seam_slots(spark, sf_dir):
    p = views.table(spark, sf_dir, "part")
    return p.select("p_partkey", tiles.seam_slots(col("p_size").cast("long"), col("p_retailprice") * 10000).alias("slots"))


@query(with_views("""SELECT 'z' || z AS level, n || ' ×  x ' || x0 || CASE WHEN x1 > x0 THEN '-' || x1 ELSE '' END || '  y ' || y0 || CASE WHEN y1 > y0 THEN '-' || y1 ELSE '' END AS label
    FROM (SELECT z, count(DISTINCT (x, y)) AS n, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM (SELECT CAST(regexp_extract(url, '(\\d+)/(\\d+)/(\\d+)', 1) AS BIGINT) AS z, CAST(regexp_extract(url, '(\\d+)/(\\d+)/(\\d+)', 2) AS BIGINT) AS x, CAST(regexp_extract(url, '(\\d+)/(\\d+)/(\\d+)', 3) AS BIGINT) AS y FROM requests WHERE url LIKE '/tiles/%') GROUP BY z)""", "requests"))
def visible_labels(spark, sf_dir):
    return account.visible_labels(account.visible(account.classified(views.requests(spark, sf_dir), "/tiles/")))


@query("SELECT user_id, count(*) FILTER (WHERE s >= 400) AS failed, count(*) FILTER (WHERE s >= 400 AND NOT (s = 404 AND event_type = 'click')) AS noted FROM (SELECT *, CASE WHEN event_id % 5 = 0 THEN 404 WHEN event_id % 7 = 0 THEN 500 ELSE 200 END AS s FROM events) GROUP BY user_id")
def noted_failures(spark, sf_dir):
    status = F.when(col("event_id") % 5 == 0, 404).when(col("event_id") % 7 == 0, 500).otherwise(200)
    e = views.table(spark, sf_dir, "events").withColumn("s", status)
    return e.groupBy("user_id").agg(F.count_if(col("s") >= 400).alias("failed"), F.count_if(account.worth_noting(col("s"), col("event_type") == "click")).alias("noted"))


LAT = f"degrees(2 * atan(exp(({HALF_WORLD} - ({{at}}) * {HALF_WORLD / 512}) / {RADIUS})) - pi() / 2)"


@query(f"SELECT event_id, round(a * (1 - s) + b * s, 6) AS lat, round(2 * (a * (1 - s) + b * s) / 90 - 1, 6) AS place FROM (SELECT event_id, (p - low) / 16 AS s, {LAT.format(at='low')} AS a, {LAT.format(at='low + 16')} AS b FROM (SELECT event_id, event_id % 1024 + CAST(0.5 AS DOUBLE) AS p, floor((event_id % 1024 + CAST(0.5 AS DOUBLE)) / 16) * 16 AS low FROM events))")
def lattice_places(spark, sf_dir):
    """Latitudes of pixel rows, by interpolation between every sixteenth."""
    lat = geo.on_lattice(col("event_id") % 1024 + 0.5, 16, lambda at: geo.y_to_lat(HALF_WORLD - at * (HALF_WORLD / 512)))
    return views.table(spark, sf_dir, "events").select("event_id", F.round(lat, 6).alias("lat"), F.round(geo.sampling_place(lat, lit(90.0)), 6).alias("place"))


# -- stages ----------------------------------------------------------------------


@query("SELECT p_partkey FROM part WHERE p_name LIKE 'a%' OR p_name LIKE 'blue%' OR p_name LIKE 'Part#1%' OR p_name LIKE 'part 1%'")
def chosen_sheets(spark, sf_dir):
    p = views.table(spark, sf_dir, "part").select("p_partkey", col("p_name").alias("name"))
    return charts.chosen(p, ["a", "blue", "Part#1", "part 1"]).select("p_partkey")


CHAIN = "SELECT CAST(o_orderkey AS VARCHAR) AS name, o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders"


@query(f"""WITH o AS ({CHAIN}), a AS (SELECT name, o_orderkey, d, d + CAST(o_orderkey % 5 - 1 AS INTEGER) AS up FROM o), up AS (SELECT name, o_orderkey, up FROM a WHERE o_orderkey % 7 <> 0), heal AS (SELECT name, up + CAST(o_orderkey % 3 - 1 AS INTEGER) AS healed FROM up WHERE o_orderkey % 11 <> 0)
    SELECT name, 'upsample' AS stage, u.up IS NULL AS missing FROM o LEFT JOIN up u USING (name) WHERE u.up IS NULL OR u.up < o.d UNION ALL SELECT u.name, 'heal', h.healed IS NULL FROM up u LEFT JOIN heal h USING (name) WHERE h.healed IS NULL OR h.healed < u.up""")
def stage_chain(spark, sf_dir):
    o = views.table(spark, sf_dir, "orders").select(col("o_orderkey").cast("string").alias("name"), "o_orderkey", col("o_orderdate").cast("date").alias("mtime"))
    up = o.where("o_orderkey % 7 <> 0").withColumn("mtime", F.date_add("mtime", (col("o_orderkey") % 5 - 1).cast("int")))
    healed = up.where("o_orderkey % 11 <> 0").withColumn("mtime", F.date_add("mtime", (col("o_orderkey") % 3 - 1).cast("int")))
    staged = lambda df, name: df.select(lit(name).alias("stage"), "name", "mtime")
    return charts.chained(staged(o, "download").union(staged(up, "upsample")).union(staged(healed, "heal")), ["download", "upsample", "heal"])


@query("SELECT 'frame, sectional' AS detectors")
def detector_names(spark, sf_dir):
    return charts.detectors(charts.series(spark))


@query("SELECT s_nationkey, count(*) FILTER (WHERE s_acctbal >= 0) AS done, count(*) FILTER (WHERE s_acctbal < 0) AS failed, coalesce(string_agg(DISTINCT CASE WHEN s_acctbal < 0 THEN s_name END, ', ' ORDER BY CASE WHEN s_acctbal < 0 THEN s_name END), '') AS names FROM supplier GROUP BY s_nationkey")
def fetch_outcomes(spark, sf_dir):
    """Suppliers stand for archives, those in debt for downloads that failed."""
    s = views.table(spark, sf_dir, "supplier").select("s_nationkey", "s_name", F.when(col("s_acctbal") < 0, "short").alias("error"))
    return fetch.outcome(s, "s_name", by=["s_nationkey"])


@query("SELECT s_nationkey, coalesce(string_agg(CASE WHEN s_suppkey % 3 <> 0 THEN s_name END, ', ' ORDER BY s_name), '') AS failed FROM supplier GROUP BY s_nationkey")
def process_exits(spark, sf_dir):
    pairs = F.array_sort(F.collect_list(F.struct("s_suppkey", "s_name")))
    runs = views.table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(pairs.alias("p")).select("s_nationkey", F.transform("p", lambda x: x["s_name"]).alias("names"), F.transform("p", lambda x: x["s_suppkey"] % 3).alias("codes"))
    return account.exits(runs).select("s_nationkey", "failed")


# -- sites -----------------------------------------------------------------------

HOSTS = "'http://h' || s_nationkey || '/'"
META = "CASE WHEN s_suppkey % 6 = 5 THEN '{broken' ELSE '{\"name\":\"' || CASE WHEN s_suppkey % 6 = 4 THEN '' ELSE 'Chart ' || (s_suppkey % 8) END || '\",\"minzoom\":' || (s_suppkey % 4) || ',\"maxzoom\":' || (8 + s_suppkey % 5) || CASE WHEN s_suppkey % 6 = 3 THEN '' ELSE ',\"url_template\":\"tiles/{z}/{x}/{y}.png\"' END || CASE WHEN s_suppkey % 2 = 0 THEN ',\"scheme\":\"geographic\"' ELSE ',\"scheme\":\"mercator\",\"format\":\"png\"' END || ',\"tiles\":' || (s_suppkey * 1234) || '}' END"


def _metadata(spark, sf_dir):
    """One metadata document a supplier: some broken, some without a name or a template."""
    return views.table(spark, sf_dir, "supplier").select(F.expr(HOSTS).alias("url"), F.concat(lit("set "), col("s_suppkey").cast("string")).alias("folder"), "s_suppkey", F.expr(META).alias("content"))


@query(f"""WITH m AS (SELECT {HOSTS} AS url, 'set ' || s_suppkey AS folder, s_suppkey, s_nationkey FROM supplier),
    told AS (SELECT *, s_nationkey % 2 = 0 AND s_suppkey % 4 <> 1 AS listed FROM m), known AS (SELECT * FROM (SELECT *, bool_or(listed) OVER (PARTITION BY url) AS has FROM told) WHERE CASE WHEN has THEN listed ELSE s_suppkey % 5 <> 2 END),
    good AS (SELECT *, CASE WHEN s_suppkey % 6 = 4 THEN '' ELSE 'Chart ' || (s_suppkey % 8) END AS name FROM known WHERE s_suppkey % 6 NOT IN (3, 5)),
    plain AS (SELECT *, CASE WHEN name = '' THEN folder ELSE name END AS p, count(*) OVER (PARTITION BY url, name) AS n FROM good)
    SELECT url, folder, CASE WHEN n > 1 THEN p || ' (' || folder || ')' ELSE p END AS label, url || folder || '/tiles/{{z}}/{{x}}/{{y}}.png' AS template FROM plain""")
def site_menu(spark, sf_dir):
    """Hosts of even number have a manifest, the others a listing, with links that lead elsewhere too."""
    m, k = _metadata(spark, sf_dir), col("s_suppkey")
    even = F.regexp_extract("url", "h([0-9]+)/", 1).cast("int") % 2 == 0
    manifest = m.where(even & (k % 4 != 1)).select("url", "folder")
    link = F.concat(lit('<a href="'), F.when(k % 5 == 2, F.concat(lit("deeper/set%20"), k.cast("string"), lit("/"))).otherwise(F.concat(lit("set%20"), k.cast("string"), lit("/"))), lit('">'))
    pages = m.groupBy("url").agg(F.concat(F.array_join(F.collect_list(link), ""), lit('<a href="../"><a href="?C=N"><a href="http://other/set 1/">')).alias("html"))
    return discover.site(manifest, discover.listed_folders(pages), m.drop("s_suppkey"))


@query("SELECT '' AS path, 'Chart 1' AS name, true AS valid")
def first_tileset(spark, sf_dir):
    root = spark.createDataFrame([("", '{"name":"Chart 1"}')], "folder string, content string")
    return discover.first_tileset(discover.tilesets(_metadata(spark, sf_dir).select("folder", "content").union(root)))


@query("SELECT './set ' || s_suppkey AS path, 'set ' || s_suppkey AS name FROM supplier")
def tileset_folders(spark, sf_dir):
    return discover.present(_metadata(spark, sf_dir))


@query(f"SELECT '[' || string_agg('{{\"path\":\"set ' || s_suppkey || '\",\"name\":\"set ' || s_suppkey || '\"}}', ',' ORDER BY 'set ' || s_suppkey) || ']' AS tilesets FROM supplier")
def tilesets_document(spark, sf_dir):
    return discover.as_json(_metadata(spark, sf_dir).select(col("folder").alias("path"), col("folder").alias("name")))


@query("""WITH m AS (SELECT 'set ' || s_suppkey AS folder, s_suppkey AS k FROM supplier WHERE s_suppkey % 6 <> 5),
    f AS (SELECT folder, 0 AS p, 'name' AS fact, CASE WHEN k % 6 = 4 THEN '' ELSE 'Chart ' || (k % 8) END AS value FROM m
        UNION ALL SELECT folder, 1, 'scheme', CASE WHEN k % 2 = 0 THEN 'geographic / EPSG:4326' ELSE 'mercator / EPSG:3857' END FROM m UNION ALL SELECT folder, 2, 'zooms', (k % 4) || '-' || (8 + k % 5) FROM m
        UNION ALL SELECT folder, 3, 'format', 'png (xyz)' FROM m WHERE k % 2 = 1 UNION ALL SELECT folder, CASE WHEN k % 2 = 1 THEN 4 ELSE 3 END, 'tiles', format('{:,}', k * 1234) FROM m)
    SELECT folder, CAST(p AS INTEGER) AS place, fact, value FROM f""")
def tileset_facts(spark, sf_dir):
    return discover.facts(_metadata(spark, sf_dir).where("content <> '{broken'"))


@query("SELECT 'set ' || k AS path, coalesce('Chart ' || last, 'set ' || k) AS name, last IS NOT NULL AS valid FROM (SELECT event_id % 50 AS k, CASE WHEN max(event_id) % 4 = 3 THEN NULL ELSE max(event_id) % 9 END AS last FROM events GROUP BY 1)")
def rescanned_menu(spark, sf_dir):
    """Metadata files that are written again and again, some broken, through the stream."""
    n = col("event_id")
    content = F.when(n % 4 == 3, "{broken").otherwise(F.concat(lit('{"name":"Chart '), (n % 9).cast("string"), lit('"}')))
    files = views.table(spark, sf_dir, "events").select(F.concat(lit("set "), (n % 50).cast("string")).alias("folder"), content.alias("content"), n.alias("mtime"))
    return rescans.rescanned(spark, files)


# -- doubling --------------------------------------------------------------------

DOUBLED = """, size AS (SELECT max(x) * 8 + 8 AS w, max(y) * 8 + 8 AS h FROM chips), whole AS MATERIALIZED (SELECT x * 8 + px AS x, y * 8 + py AS y, c, a FROM chips),
    out AS (SELECT 2 * s.x + dx AS u, 2 * s.y + dy AS v, s.x + CASE WHEN dx = 0 THEN -1 ELSE 1 END AS nx, s.y + CASE WHEN dy = 0 THEN -1 ELSE 1 END AS ny, s.x AS x, s.y AS y FROM whole s, range(2) AS i(dx), range(2) AS j(dy)),
    held AS MATERIALIZED (SELECT u, v, x, y, least(greatest(nx, 0), w - 1) AS nx, least(greatest(ny, 0), h - 1) AS ny FROM out, size)
    SELECT CAST(u AS INTEGER) AS px, CAST(v AS INTEGER) AS py, CAST(round_even(0.5625::DOUBLE * p.c + 0.1875::DOUBLE * coalesce(q.c, 0) + 0.1875::DOUBLE * coalesce(r.c, 0) + 0.0625::DOUBLE * coalesce(s.c, 0), 0) AS INTEGER) AS c,
        CAST(round_even(0.5625::DOUBLE * p.a + 0.1875::DOUBLE * coalesce(q.a, 0) + 0.1875::DOUBLE * coalesce(r.a, 0) + 0.0625::DOUBLE * coalesce(s.a, 0), 0) AS INTEGER) AS a
    FROM held h JOIN whole p ON p.x = h.x AND p.y = h.y LEFT JOIN whole q ON q.x = h.nx AND q.y = h.y LEFT JOIN whole r ON r.x = h.x AND r.y = h.ny LEFT JOIN whole s ON s.x = h.nx AND s.y = h.ny"""


@query(with_views(DOUBLED, "chips").replace(") , size", "), size", 1))
def upsample_blocks(spark, sf_dir):
    """All chips side by side as one sheet, doubled in blocks of 64 pixels with 16 around them."""
    c = views.chips(spark, sf_dir)
    at = lambda tile, pixel: col(tile) * 8 + col(pixel)
    whole = c.select(at("x", "px").alias("x"), at("y", "py").alias("y"), "c", "a")
    blocks = resample.packed_blocks(whole.withColumn("ord", lit(0)), 64)
    sizes = whole.agg((F.max("x") + 1).cast("int").alias("width"), (F.max("y") + 1).cast("int").alias("height")).select(lit(0).cast("long").alias("ord"), "width", "height")
    done = resample.upsample(blocks, sizes, "bilinear", 64)
    inside = whole.select((col("x") * 2).alias("_x"), (col("y") * 2).alias("_y"))
    each = resample.unpacked_blocks(done, 128).select(col("x").cast("int").alias("px"), col("y").cast("int").alias("py"), col("r").alias("c"), "a")
    return each.join(inside, (F.floor(col("px") / 2) * 2 == col("_x")) & (F.floor(col("py") / 2) * 2 == col("_y"))).drop("_x", "_y")
