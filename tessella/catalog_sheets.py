"""Queries over whole sheets, which are made from suppliers by whole-number arithmetic: areas, frames, neatlines, registration."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessella.operators import detect, register
from tessella.plans import views
from tessella.registry import query

col, lit = F.col, F.lit


#: Pixels that one task makes of the sheets dealt to it.
TASK_CELLS = 4_000_000


def _cells(spark, sf_dir, columns: int, rows: int):
    """One row a pixel of each supplier's sheet: ``sheet, col, row``.

    The table's one small file would be one task's, so sheets are dealt out by their key before
    their pixels are made; what is grouped by sheet later finds them in place.
    """
    s = views.table(spark, sf_dir, "supplier").select(col("s_suppkey").alias("sheet"))
    tasks = max(spark.sparkContext.defaultParallelism, -(-s.count() * columns * rows // TASK_CELLS))
    s = s.repartition(tasks, "sheet")
    return s.withColumn("row", F.explode(F.sequence(lit(0), lit(rows - 1)))).withColumn("col", F.explode(F.sequence(lit(0), lit(columns - 1))))


# -- curves ----------------------------------------------------------------------


def fit_sql(points: str, keys: str, name: str) -> str:
    """CTEs that fit every group of ``points`` (keys, pos, depth, degree); the last is ``{name}_fit``."""
    n = name
    sums = "count(*)::DOUBLE AS n, " + ", ".join(f"sum(u ** {k}) AS s{k}" for k in (1, 2, 3, 4)) + ", sum(d) AS t0, sum(u * d) AS t1, sum(u * u * d) AS t2"
    det = "(n * (s2 * s4 - s3 * s3) - s1 * (s1 * s4 - s2 * s3) + s2 * (s1 * s3 - s2 * s2))"
    line = "CASE WHEN n * s2 - s1 * s1 <> 0 THEN (n * t1 - s1 * t0) / (n * s2 - s1 * s1) ELSE 0 END"
    solved = f"""SELECT {keys}, n, CASE WHEN degree = 1 THEN (t0 - ({line}) * s1) / n ELSE (t0 * (s2 * s4 - s3 * s3) - s1 * (t1 * s4 - s3 * t2) + s2 * (t1 * s3 - s2 * t2)) / {det} END AS a,
        CASE WHEN degree = 1 THEN {line} ELSE (n * (t1 * s4 - s3 * t2) - t0 * (s1 * s4 - s2 * s3) + s2 * (s1 * t2 - s2 * t1)) / {det} END AS b,
        CASE WHEN degree = 1 THEN 0 ELSE (n * (s2 * t2 - s3 * t1) - s1 * (s1 * t2 - s2 * t1) + t0 * (s1 * s3 - s2 * s2)) / {det} END AS c"""
    ctes = [
        f"{n}_side AS MATERIALIZED (SELECT {keys}, avg(pos) AS centre, greatest(1, max(pos) - avg(pos), avg(pos) - min(pos)) AS half, median(depth) AS typical FROM ({points}) GROUP BY {keys} HAVING count(*) >= 8 AND median(depth) >= {detect.MIN_COLLAR})",
        f"{n}_all AS MATERIALIZED (SELECT {keys}, (pos - centre) / half AS u, depth AS d, pos, degree, abs(depth - typical) AS off FROM ({points}) JOIN {n}_side USING ({keys}))",
        f"{n}_k0 AS MATERIALIZED (SELECT * FROM {n}_all JOIN (SELECT {keys}, greatest({detect.KEEP_RESIDUAL}, 3 * median(off)) AS most FROM {n}_all GROUP BY {keys}) USING ({keys}) WHERE off <= most)",
    ]
    for k in range(detect.TRIM_PASSES):
        ctes += [
            f"{n}_f{k} AS MATERIALIZED ({solved} FROM (SELECT {keys}, degree, {sums} FROM {n}_k{k} GROUP BY {keys}, degree HAVING count(*) >= degree + 4))",
            f"{n}_m{k} AS MATERIALIZED (SELECT {keys}, greatest({detect.KEEP_RESIDUAL}, 4 * median(abs(d - (a + u * (b + u * c))))) AS most FROM {n}_k{k} JOIN {n}_f{k} USING ({keys}) GROUP BY {keys})",
            f"{n}_k{k + 1} AS MATERIALIZED (SELECT x.* FROM {n}_all x JOIN {n}_f{k} USING ({keys}) JOIN {n}_m{k} USING ({keys}) WHERE abs(d - (a + u * (b + u * c))) <= {n}_m{k}.most)",
        ]
    last = f"{n}_k{detect.TRIM_PASSES}"
    ctes += [
        f"{n}_last AS MATERIALIZED ({solved} FROM (SELECT {keys}, degree, {sums} FROM {last} GROUP BY {keys}, degree))",
        f"{n}_fit AS MATERIALIZED (SELECT {keys}, centre, half, a, b, c, shift, lo, hi FROM {n}_last JOIN {n}_side USING ({keys}) JOIN (SELECT {keys}, greatest(max(d - (a + u * (b + u * c))), 0) + {detect.MARGIN} AS shift, min(pos) AS lo, max(pos) AS hi FROM {last} JOIN {n}_last USING ({keys}) GROUP BY {keys}) USING ({keys}))",
    ]
    return ", ".join(ctes)


# -- collars ---------------------------------------------------------------------

COLUMNS, ROWS, ONSET, RUN = 112, 96, 3, 10
WIDTH, HEIGHT = COLUMNS * detect.DECIMATE, ROWS * detect.DECIMATE


def _paper(spark, sf_dir):
    """Decimated sheets with a collar on most sides, some bands with a wild one, and specks of paper."""
    s, x, y = col("sheet"), col("col"), col("row")
    west = 6 + s % 5 + F.floor(y / 24) + F.when(F.floor(y / 2) % 13 == s % 13, 30).otherwise(0)
    east = F.when(s % 3 == 0, 0).otherwise(5 + F.floor(y / 32))
    north = 4 + s % 4 + F.floor(x * x / 4000)
    collar = (x < west) | (x >= COLUMNS - east) | (y < north) | (y >= ROWS - 7)
    cells = _cells(spark, sf_dir, COLUMNS, ROWS)
    return cells.select("sheet", "col", "row", lit(COLUMNS).alias("cols"), lit(ROWS).alias("rows"), (collar | ((y * 31 + x * 17 + s * 7) % 23 == 0)).alias("paper"))


def _sheets(spark, sf_dir):
    open_sides = F.when(col("sheet") % 11 == 5, F.array(lit("south")))
    return views.table(spark, sf_dir, "supplier").select(col("s_suppkey").alias("sheet"), lit(WIDTH).alias("width"), lit(HEIGHT).alias("height")).withColumn("open_sides", open_sides)


def _fits(spark, sf_dir):
    return detect.sectional_fits(detect.collar_depths(_paper(spark, sf_dir), ONSET, RUN), _sheets(spark, sf_dir))


PAPER = f"""cells AS MATERIALIZED (SELECT s_suppkey AS sheet, CAST(x AS INTEGER) AS col, CAST(y AS INTEGER) AS row,
        x < 6 + s_suppkey % 5 + y // 24 + CASE WHEN (y // 2) % 13 = s_suppkey % 13 THEN 30 ELSE 0 END OR x >= {COLUMNS} - CASE WHEN s_suppkey % 3 = 0 THEN 0 ELSE 5 + y // 32 END
        OR y < 4 + s_suppkey % 4 + (x * x) // 4000 OR y >= {ROWS} - 7 OR (y * 31 + x * 17 + s_suppkey * 7) % 23 = 0 AS paper
        FROM supplier, range({COLUMNS}) AS a(x), range({ROWS}) AS b(y))"""
DEPTHS = f"""upright AS MATERIALIZED (SELECT sheet, CAST(ceil((row + 1) * 48 / CAST({ROWS} AS DOUBLE)) - 1 AS INTEGER) AS band, col AS i, avg(CAST(paper AS INTEGER)) AS f FROM cells GROUP BY 1, 2, 3),
    flat AS MATERIALIZED (SELECT sheet, CAST(ceil((col + 1) * 48 / CAST({COLUMNS} AS DOUBLE)) - 1 AS INTEGER) AS band, row AS i, avg(CAST(paper AS INTEGER)) AS f FROM cells GROUP BY 1, 2, 3),
    profile AS MATERIALIZED (SELECT sheet, 'west' AS side, band, i, f FROM upright UNION ALL SELECT sheet, 'east', band, {COLUMNS} - 1 - i, f FROM upright UNION ALL SELECT sheet, 'north', band, i, f FROM flat UNION ALL SELECT sheet, 'south', band, {ROWS} - 1 - i, f FROM flat),
    ahead AS (SELECT sheet, side, band, i, avg(f) OVER (w ROWS BETWEEN CURRENT ROW AND {ONSET - 1} FOLLOWING) AS near, median(f) OVER (w ROWS BETWEEN CURRENT ROW AND {RUN - 1} FOLLOWING) AS far, count(*) OVER (w ROWS BETWEEN CURRENT ROW AND {RUN} FOLLOWING) AS n FROM profile WINDOW w AS (PARTITION BY sheet, side, band ORDER BY i)),
    depths AS MATERIALIZED (SELECT sheet, side, ((band * e) // 48 + ((band + 1) * e) // 48) / CAST(2 AS DOUBLE) * 4 AS pos, CAST(depth * 4 AS DOUBLE) AS depth
        FROM (SELECT sheet, side, band, min(i) AS depth, CASE WHEN side IN ('west', 'east') THEN {ROWS} ELSE {COLUMNS} END AS e FROM ahead WHERE n = {RUN + 1} AND near < 0.35 AND far < 0.3 GROUP BY sheet, side, band)
        WHERE NOT (sheet % 11 = 5 AND side = 'south'))"""


def depth_sql(t: str, fit: str) -> str:
    u = f"((least(greatest({t}, {fit}.lo), {fit}.hi) - {fit}.centre) / {fit}.half)"
    return f"coalesce({fit}.a + {u} * ({fit}.b + {u} * {fit}.c) + {fit}.shift, 0)"


def fits_sql() -> str:
    ctes = [PAPER, DEPTHS, f"span0 AS (SELECT s_suppkey AS sheet, CAST({HEIGHT * 0.25} AS DOUBLE) AS low, CAST({HEIGHT * 0.75} AS DOUBLE) AS high FROM supplier)"]
    for k, (near, far) in enumerate((("west", "east"), ("north", "south")) * 2):
        along, extent = (HEIGHT, WIDTH) if near == "west" else (WIDTH, HEIGHT)
        points = f"SELECT sheet, side, pos, depth, {detect.SIDES[near]} AS degree FROM depths JOIN span{k} USING (sheet) WHERE side IN ('{near}', '{far}') AND pos BETWEEN low AND high"
        ctes.append(fit_sql(points, "sheet, side", f"r{k}"))
        at = lambda side: f"(SELECT * FROM r{k}_fit WHERE side = '{side}')"  # noqa: B023, E731
        middle = f"CAST({along / 2} AS DOUBLE)"
        ctes.append(f"span{k + 1} AS MATERIALIZED (SELECT s_suppkey AS sheet, {depth_sql(middle, 'n')} + 0.02::DOUBLE * {extent} AS low, {extent} - {depth_sql(middle, 'f')} - 0.02::DOUBLE * {extent} AS high FROM supplier LEFT JOIN {at(near)} n ON n.sheet = s_suppkey LEFT JOIN {at(far)} f ON f.sheet = s_suppkey)")
    ctes.append("fits AS MATERIALIZED (SELECT * FROM r2_fit UNION ALL SELECT * FROM r3_fit)")
    return "WITH " + ", ".join(ctes)


SIDED = "FROM supplier LEFT JOIN (SELECT * FROM fits WHERE side = 'west') w ON w.sheet = s_suppkey LEFT JOIN (SELECT * FROM fits WHERE side = 'east') e ON e.sheet = s_suppkey LEFT JOIN (SELECT * FROM fits WHERE side = 'north') n ON n.sheet = s_suppkey LEFT JOIN (SELECT * FROM fits WHERE side = 'south') s ON s.sheet = s_suppkey"


def edge_sql(side: str, t: str) -> str:
    held = f"greatest({detect.EDGE_TRIM}, {depth_sql(t, side)})"
    return {"w": held, "n": held, "e": f"{WIDTH} - {held}", "s": f"{HEIGHT} - {held}"}[side]


def corners_sql() -> str:
    """Eight steps back and forth to the corners in the north-west and the south-east."""
    steps = f"c0 AS (SELECT s_suppkey AS sheet, CAST({WIDTH / 2} AS DOUBLE) AS nx, CAST({HEIGHT / 2} AS DOUBLE) AS ny, CAST({WIDTH / 2} AS DOUBLE) AS sx, CAST({HEIGHT / 2} AS DOUBLE) AS sy FROM supplier)"
    for k in range(8):
        steps += f", x{k} AS MATERIALIZED (SELECT c.*, {edge_sql('w', 'c.ny')} AS nx1, {edge_sql('e', 'c.sy')} AS sx1 {SIDED} JOIN c{k} c ON c.sheet = s_suppkey)"
        steps += f", c{k + 1} AS MATERIALIZED (SELECT c.sheet, c.nx1 AS nx, {edge_sql('n', 'c.nx1')} AS ny, c.sx1 AS sx, {edge_sql('s', 'c.sx1')} AS sy {SIDED} JOIN x{k} c ON c.sheet = s_suppkey)"
    return steps


@query(f"{fits_sql()} SELECT sheet, side, round(a, 4) + 0 AS a, round(b, 4) + 0 AS b, round(c, 4) + 0 AS c, round(shift, 4) AS shift, lo, hi FROM fits")
def sectional_fits(spark, sf_dir):
    each = F.array(*(F.struct(lit(s).alias("side"), col(s).alias("fit")) for s in detect.SIDES))
    long = _fits(spark, sf_dir).select("sheet", F.explode(each).alias("s")).where("s.fit is not null").select("sheet", "s.side", "s.fit.*")
    return long.select("sheet", "side", *((F.round(c, 4) + 0.0).alias(c) for c in ("a", "b", "c", "shift")), "lo", "hi")


@query(f"{fits_sql()}, {corners_sql()} SELECT sheet, CAST(256 AS INTEGER) AS points, round(nx, 1) AS left, round(ny, 1) AS top, round(sx, 1) AS right, round(sy, 1) AS bottom FROM c8")
def sectional_area(spark, sf_dir):
    areas = detect.sectional_areas(_fits(spark, sf_dir))
    nw, se = F.get("ring", lit(0)), F.get("ring", lit(128))
    return areas.select("sheet", F.size("ring").alias("points"), nw["x"].alias("left"), nw["y"].alias("top"), se["x"].alias("right"), se["y"].alias("bottom"))


INSIDE = f"least((c.col + 0.5::DOUBLE) * 4 - ({edge_sql('w', '(c.row + 0.5::DOUBLE) * 4')}), {edge_sql('e', '(c.row + 0.5::DOUBLE) * 4')} - (c.col + 0.5::DOUBLE) * 4, (c.row + 0.5::DOUBLE) * 4 - ({edge_sql('n', '(c.col + 0.5::DOUBLE) * 4')}), {edge_sql('s', '(c.col + 0.5::DOUBLE) * 4')} - (c.row + 0.5::DOUBLE) * 4)"


@query(f"""{fits_sql()}, inside AS (SELECT c.*, {INSIDE} AS d {SIDED} JOIN cells c ON c.sheet = s_suppkey),
    sided AS (SELECT sheet, paper, CASE WHEN col <= least({COLUMNS} - col, row, {ROWS} - row) THEN 'west' WHEN {COLUMNS} - col <= least(row, {ROWS} - row) THEN 'east' WHEN row <= {ROWS} - row THEN 'north' ELSE 'south' END AS side FROM inside WHERE d BETWEEN 4 AND 40)
    SELECT sheet, side, count(*) AS n, round(avg(CAST(paper AS INTEGER)), 6) AS paper, avg(CAST(paper AS INTEGER)) > 0.25 AS flagged FROM sided GROUP BY sheet, side HAVING count(*) > 50""")
def paper_inside(spark, sf_dir):
    return detect.paper_inside(_paper(spark, sf_dir), _fits(spark, sf_dir), 40).withColumn("paper", F.round("paper", 6))


# -- frames ----------------------------------------------------------------------

FRAME = """p AS MATERIALIZED (SELECT s_suppkey AS sheet, x, y, (x >= 4 AND x < 10) OR (x >= 50 AND x < CASE WHEN s_suppkey % 7 = 0 THEN 54 ELSE 56 END) OR (s_suppkey % 4 = 0 AND x >= 20 AND x < 26)
        OR (y >= 3 AND y < 9) OR (y >= 40 AND y < 46) OR (y * 7 + x * 3 + s_suppkey) % 13 = 0 AS dark FROM supplier, range(60) AS a(x), range(48) AS b(y) WHERE s_suppkey % 10 <> 3),
    f AS MATERIALIZED (SELECT sheet, 'x' AS axis, x AS i, avg(CAST(dark AS INTEGER)) AS v FROM p WHERE y >= 14 AND y < 33 GROUP BY ALL UNION ALL SELECT sheet, 'y', y, avg(CAST(dark AS INTEGER)) FROM p WHERE x >= 18 AND x < 42 GROUP BY ALL),
    r AS MATERIALIZED (SELECT sheet, axis, min(i) AS a, max(i) AS b FROM (SELECT sheet, axis, i, i - row_number() OVER (PARTITION BY sheet, axis ORDER BY i) AS run FROM f WHERE v >= 0.9) GROUP BY sheet, axis, run HAVING max(i) - min(i) + 1 >= 6),
    g AS MATERIALIZED (SELECT *, c - b AS gap FROM (SELECT sheet, axis, a, b, lead(a) OVER w AS c, lead(b) OVER w AS d FROM r WINDOW w AS (PARTITION BY sheet, axis ORDER BY a)) WHERE c IS NOT NULL),
    best AS MATERIALIZED (SELECT sheet, axis, arg_max(a, (gap, -a)) AS a, arg_max(b, (gap, -a)) AS b, arg_max(c, (gap, -a)) AS c, arg_max(d, (gap, -a)) AS d, count(*) FILTER (WHERE gap > 10) - CAST(max(gap) > 10 AS INTEGER) AS others FROM g GROUP BY sheet, axis)"""


@query(f"""WITH {FRAME} SELECT s_suppkey AS sheet, x.a IS NOT NULL AND y.a IS NOT NULL AS found, CASE WHEN y.a IS NOT NULL THEN CAST(x.others + y.others AS INTEGER) END AS others,
    CASE WHEN y.a IS NOT NULL THEN x.a END AS x0, CASE WHEN x.a IS NOT NULL THEN y.a END AS y0, CASE WHEN y.a IS NOT NULL THEN x.d + 1 END AS x1, CASE WHEN x.a IS NOT NULL THEN y.d + 1 END AS y1,
    CASE WHEN y.a IS NOT NULL THEN x.b + 4 END AS clean_x0, CASE WHEN x.a IS NOT NULL THEN y.c - 3 END AS clean_y1
    FROM supplier LEFT JOIN (SELECT * FROM best WHERE axis = 'x') x ON x.sheet = s_suppkey LEFT JOIN (SELECT * FROM best WHERE axis = 'y') y ON y.sheet = s_suppkey WHERE s_suppkey % 10 <> 3""")
def frame_areas(spark, sf_dir):
    s, x, y = col("sheet"), col("col"), col("row")
    rule = x.between(4, 9) | ((x >= 50) & (x < F.when(s % 7 == 0, 54).otherwise(56))) | ((s % 4 == 0) & x.between(20, 25)) | y.between(3, 8) | y.between(40, 45)
    v = F.when(rule | ((y * 7 + x * 3 + s) % 13 == 0), 0).otherwise(200)
    cells = _cells(spark, sf_dir, 60, 48).select("sheet", "col", "row", v.alias("r"), v.alias("g"), v.alias("b"), lit(60).alias("width"), lit(48).alias("height"))
    manual = views.table(spark, sf_dir, "supplier").where("s_suppkey % 10 = 3").select(col("s_suppkey").alias("sheet"))
    found = detect.frames(cells, manual, other_panel=10)
    at = lambda box, i: F.get(col(box), lit(i)).cast("long")
    return found.select("sheet", "found", "others", at("outer", 0).alias("x0"), at("outer", 1).alias("y0"), at("outer", 2).alias("x1"), at("outer", 3).alias("y1"), at("clean", 0).alias("clean_x0"), at("clean", 3).alias("clean_y1"))


# -- neatlines -------------------------------------------------------------------

NEAT_WIDTH, NEAT_HEIGHT, NEAT_RUN, NEAT_STEP, NEAT_ROUNDS = 60, 50, 8, 2, 20
NEAT = f"""p AS MATERIALIZED (SELECT s_suppkey AS sheet, CAST(x AS INTEGER) AS x, CAST(y AS INTEGER) AS y, CASE WHEN x < 5 + s_suppkey % 4 OR y < 4 OR x >= 55 OR y >= 46 THEN 'paper'
        WHEN x < 9 + s_suppkey % 3 AND y >= 20 + s_suppkey % 9 THEN 'paper' WHEN y < 8 AND x % 30 >= 2 + s_suppkey % 5 THEN 'ink' WHEN y >= 44 - s_suppkey % 6 AND x >= 30 THEN 'ink' WHEN (x * 5 + y * 3 + s_suppkey) % 7 = 0 THEN 'paper' ELSE 'map' END AS kind
        FROM supplier, range({NEAT_WIDTH}) AS a(x), range({NEAT_HEIGHT}) AS b(y)),
    box AS MATERIALIZED (SELECT sheet, l, t, r, b FROM (SELECT sheet, min(x) AS l, max(x) + 1 AS r FROM (SELECT sheet, x FROM p GROUP BY sheet, x HAVING avg(CAST(kind = 'map' AS INTEGER)) > 0.25) GROUP BY sheet) JOIN (SELECT sheet, min(y) AS t, max(y) + 1 AS b FROM (SELECT sheet, y FROM p GROUP BY sheet, y HAVING avg(CAST(kind = 'map' AS INTEGER)) > 0.25) GROUP BY sheet) USING (sheet)),
    inner_p AS MATERIALIZED (SELECT p.* FROM p JOIN box USING (sheet) WHERE x >= l AND x < r AND y >= t AND y < b AND kind <> 'map'),
    runs AS MATERIALIZED (SELECT sheet, 'y' AS axis, y AS at, min(x) AS a, max(x) + 1 AS b FROM (SELECT *, x - row_number() OVER (PARTITION BY sheet, y, kind ORDER BY x) AS run FROM inner_p) GROUP BY sheet, y, kind, run HAVING count(*) > {NEAT_RUN}
        UNION ALL SELECT sheet, 'x', x, min(y), max(y) + 1 FROM (SELECT *, y - row_number() OVER (PARTITION BY sheet, x, kind ORDER BY y) AS run FROM inner_p) GROUP BY sheet, x, kind, run HAVING count(*) > {NEAT_RUN})"""


def neat_sql() -> str:
    """Rounds one after the other; a box that is clean stays as it is."""
    ctes = ["WITH " + NEAT, "s0 AS (SELECT sheet, l, t, r, b, false AS settled FROM box)"]
    for k in range(NEAT_ROUNDS):
        dirty = lambda axis, at, low, high: f"max(CASE WHEN u.axis = '{axis}' AND u.at = {at} AND least(u.b, {high}) - greatest(u.a, {low}) > {NEAT_RUN} THEN {NEAT_STEP} ELSE 0 END)"
        moves = f"SELECT s.sheet, coalesce({dirty('y', 's.t', 's.l', 's.r')}, 0) AS n, coalesce({dirty('y', 's.b - 1', 's.l', 's.r')}, 0) AS o, coalesce({dirty('x', 's.l', 's.t', 's.b')}, 0) AS w, coalesce({dirty('x', 's.r - 1', 's.t', 's.b')}, 0) AS e FROM s{k} s LEFT JOIN runs u ON u.sheet = s.sheet GROUP BY s.sheet"
        ctes.append(f"s{k + 1} AS MATERIALIZED (SELECT sheet, CASE WHEN settled THEN l ELSE l + w END AS l, CASE WHEN settled THEN t ELSE t + n END AS t, CASE WHEN settled THEN r ELSE r - e END AS r, CASE WHEN settled THEN b ELSE b - o END AS b, settled OR n + o + w + e = 0 AS settled FROM s{k} JOIN ({moves}) USING (sheet))")
    return ", ".join(ctes) + f' SELECT sheet, CAST(l AS INTEGER) AS "left", CAST(t AS INTEGER) AS top, CAST(r AS INTEGER) AS "right", CAST(b AS INTEGER) AS bottom, settled FROM s{NEAT_ROUNDS}'


@query(neat_sql())
def neatline(spark, sf_dir):
    s, x, y = col("sheet"), col("col"), col("row")
    margin = (x < 5 + s % 4) | (y < 4) | (x >= 55) | (y >= 46)
    ink, paper, other = (F.struct(*(lit(v).alias(c) for c, v in zip("rgb", rgb, strict=True))) for rgb in ((20, 20, 20), (255, 255, 255), (90, 140, 200)))
    colour = F.when(margin, paper).when((x < 9 + s % 3) & (y >= 20 + s % 9), paper).when((y < 8) & (x % 30 >= 2 + s % 5), ink).when((y >= 44 - s % 6) & (x >= 30), ink).when((x * 5 + y * 3 + s) % 7 == 0, paper).otherwise(other)
    # The explode keeps the colour from being worked out anew wherever a band of it is looked at.
    cells = _cells(spark, sf_dir, NEAT_WIDTH, NEAT_HEIGHT).select("sheet", "col", "row", F.explode(F.array(colour)).alias("c")).select("sheet", "col", "row", "c.*")
    return detect.neatlines(cells, NEAT_RUN, NEAT_STEP, NEAT_ROUNDS)


# -- registration ----------------------------------------------------------------

PAGE, SHEET, PROBE, FINE, LEAST_INK, COARSE = (72, 60), (40, 36), 12, 3, 20, 2


def _inked(x, y, s):
    return (x * 7919 + y * 104729 + x * y * 31 + s * 17) % 97 < 20


def _ink_of(spark, sf_dir):
    """Ink pixels of each supplier's page, and of its sheet, a window of the page with some ink missing."""
    s = col("sheet")
    page = _cells(spark, sf_dir, *PAGE).select("sheet", col("col").alias("x"), col("row").alias("y"))
    page = page.where(_inked(col("x"), col("y"), s))
    inside = page.select("sheet", (col("x") - 5 - s % 9).alias("x"), (col("y") - 4 - s % 7).alias("y"))
    sheet = inside.where((col("x") >= 0) & (col("x") < SHEET[0]) & (col("y") >= 0) & (col("y") < SHEET[1]) & ((col("x") + col("y") * 3 + s) % 11 != 0))
    small = lambda ink: ink.where((col("x") % COARSE == 0) & (col("y") % COARSE == 0)).select("sheet", F.floor(col("x") / COARSE).alias("x"), F.floor(col("y") / COARSE).alias("y"))
    return page, sheet, small(page), small(sheet)


def _axis_sql(name: str, along: str, page: int, size: int) -> str:
    """Best shift of the reduced profiles along one axis, and the origin that follows."""
    n, m = page // COARSE, size // COARSE
    count = lambda ink, k: f"(SELECT s_suppkey AS sheet, g.i AS i, coalesce(c.t, 0) AS t FROM supplier CROSS JOIN range({k}) AS g(i) LEFT JOIN (SELECT sheet, {along} // 2 AS i, count(*) AS t FROM {ink} WHERE x % 2 = 0 AND y % 2 = 0 GROUP BY 1, 2) c ON c.sheet = s_suppkey AND c.i = g.i)"
    return f"""{name}_p AS MATERIALIZED {count('page', n)}, {name}_s AS MATERIALIZED {count('sheet', m)},
        {name}_m AS MATERIALIZED (SELECT s.sheet, k, sum(CAST(s.t AS DOUBLE) * p.t) AS ab, sum(CAST(s.t AS DOUBLE) * s.t) AS aa, sum(CAST(p.t AS DOUBLE) * p.t) AS bb FROM {name}_s s CROSS JOIN range({n - m + 1}) AS r(k) JOIN {name}_p p ON p.sheet = s.sheet AND p.i = s.i + k GROUP BY s.sheet, k),
        {name} AS MATERIALIZED (SELECT sheet, least(2 * arg_max(k, (round(CASE WHEN aa * bb > 0 THEN ab / sqrt(aa * bb) ELSE 0 END, 9), -k)), {page - size}) AS o FROM {name}_m GROUP BY sheet)"""


def registered_sql() -> str:
    probes = ", ".join(f"({k}, {min(max(int(SHEET[0] * fx) - PROBE // 2, 0), SHEET[0] - PROBE)}, {min(max(int(SHEET[1] * fy) - PROBE // 2, 0), SHEET[1] - PROBE)})" for k, (fx, fy) in enumerate(register.PROBES))
    wide = PROBE + 2 * FINE
    return f"""WITH page AS MATERIALIZED (SELECT s_suppkey AS sheet, x, y FROM supplier, range({PAGE[0]}) AS a(x), range({PAGE[1]}) AS b(y) WHERE (x * 7919 + y * 104729 + x * y * 31 + s_suppkey * 17) % 97 < 20),
        sheet AS MATERIALIZED (SELECT * FROM (SELECT sheet, x - 5 - sheet % 9 AS x, y - 4 - sheet % 7 AS y FROM page) WHERE x >= 0 AND x < {SHEET[0]} AND y >= 0 AND y < {SHEET[1]} AND (x + y * 3 + sheet) % 11 <> 0),
        {_axis_sql('ax', 'x', PAGE[0], SHEET[0])}, {_axis_sql('ay', 'y', PAGE[1], SHEET[1])},
        probes AS MATERIALIZED (SELECT ax.sheet, probe, px, py, ax.o AS ox, ay.o AS oy FROM ax JOIN ay USING (sheet), (VALUES {probes}) AS v(probe, px, py)
            WHERE ax.o + px >= {FINE} AND ay.o + py >= {FINE} AND ax.o + px - {FINE} + {wide} <= {PAGE[0]} AND ay.o + py - {FINE} + {wide} <= {PAGE[1]}),
        mine AS MATERIALIZED (SELECT p.sheet, probe, ox + s.x AS gx, oy + s.y AS gy, px, py, ox, oy FROM probes p JOIN sheet s ON s.sheet = p.sheet AND s.x >= px AND s.x < px + {PROBE} AND s.y >= py AND s.y < py + {PROBE}),
        inked AS MATERIALIZED (SELECT sheet, probe, count(*) AS aa FROM mine GROUP BY sheet, probe HAVING count(*) >= {LEAST_INK}),
        moves AS MATERIALIZED (SELECT dx, dy FROM range(-{FINE}, {FINE + 1}) AS a(dx), range(-{FINE}, {FINE + 1}) AS b(dy)),
        common AS MATERIALIZED (SELECT m.sheet, m.probe, dx, dy, count(*) AS ab FROM mine m CROSS JOIN moves JOIN page p ON p.sheet = m.sheet AND p.x = gx + dx AND p.y = gy + dy GROUP BY ALL),
        beneath AS MATERIALIZED (SELECT b.sheet, probe, dx, dy, count(*) AS bb FROM probes b CROSS JOIN moves JOIN page p ON p.sheet = b.sheet AND p.x >= ox + px + dx AND p.x < ox + px + dx + {PROBE} AND p.y >= oy + py + dy AND p.y < oy + py + dy + {PROBE} GROUP BY ALL),
        scored AS (SELECT i.sheet, i.probe, dx, dy, coalesce(ab, 0) / sqrt(CAST(aa AS DOUBLE) * bb) AS score FROM inked i JOIN beneath USING (sheet, probe) LEFT JOIN common USING (sheet, probe, dx, dy)),
        best AS MATERIALIZED (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sheet, probe ORDER BY round(score, 9) DESC, dy, dx) AS rank FROM scored) WHERE rank = 1),
        middle AS (SELECT sheet, CAST(trunc(median(dx)) AS INTEGER) AS mx, CAST(trunc(median(dy)) AS INTEGER) AS my, median(score) AS match FROM best GROUP BY sheet),
        voted AS (SELECT m.*, max(greatest(abs(dx - mx), abs(dy - my))) AS spread FROM middle m JOIN best USING (sheet) GROUP BY ALL)
        SELECT ax.sheet, CAST(ax.o + coalesce(mx, 0) AS BIGINT) AS x, CAST(ay.o + coalesce(my, 0) AS BIGINT) AS y, {SHEET[0]} AS width, {SHEET[1]} AS height, round(coalesce(match, 0), 6) AS match, CAST(coalesce(spread, 0) AS INTEGER) AS spread, coalesce(spread > 2 OR match < 0.7, true) AS doubtful
        FROM ax JOIN ay USING (sheet) LEFT JOIN voted USING (sheet)"""


@query(registered_sql())
def registered_windows(spark, sf_dir):
    sizes = views.table(spark, sf_dir, "supplier").select(col("s_suppkey").alias("sheet"), lit(PAGE[0]).alias("page_width"), lit(PAGE[1]).alias("page_height"), lit(SHEET[0]).alias("width"), lit(SHEET[1]).alias("height"))
    page, sheet, page_small, sheet_small = _ink_of(spark, sf_dir)
    return register.registered(page, sheet, page_small, sheet_small, sizes, COARSE, PROBE, FINE, LEAST_INK).withColumn("match", F.round("match", 6))


@query("""SELECT p_partkey, round(scale, 6) AS scale, CAST(round_even(w * scale, 0) AS BIGINT) AS page_width, CAST(round_even(h * scale, 0) AS BIGINT) AS page_height, scale * 72 BETWEEN 100 AND 1200 AS plausible, CAST(p_size * 40 * 4 AS BIGINT) AS render_width, CAST(3000 * 4 AS BIGINT) AS render_height
    FROM (SELECT *, greatest(p_size * 40 / w, 3000 / h) AS scale FROM (SELECT p_partkey, p_size, CAST(600 + p_partkey % 500 AS DOUBLE) AS w, CAST(700 + p_partkey % 300 AS DOUBLE) AS h FROM part))""")
def page_scales(spark, sf_dir):
    p = views.table(spark, sf_dir, "part")
    w, h = (600 + col("p_partkey") % 500).cast("double"), (700 + col("p_partkey") % 300).cast("double")
    at = p.select("p_partkey", "p_size", register.page_scale(col("p_size") * 40, lit(3000), w, h).alias("s"))
    size = register.expected_size(F.array(lit(0), lit(0), col("p_size") * 40, lit(3000)), lit(4))
    return at.select("p_partkey", F.round("s.scale", 6).alias("scale"), "s.page_width", "s.page_height", register.plausible_dpi(col("s.dpi")).alias("plausible"), size["width"].alias("render_width"), size["height"].alias("render_height"))
