"""Operators on small made-up scenes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella import catalog_sheets
from tessella.functions import geo
from tessella.functions.grid import GEOGRAPHIC
from tessella.operators import bounds, composite, detect, overview, register, resample
from tessella.plans import area, catalog, tiles


def ring(*points):
    return [{"x": float(x), "y": float(y)} for x, y in points]


def test_plan_follows_a_slanted_ring(spark):
    rows = [(0, ring((0, 0), (22.5, 0), (22.5, 22.5)))]
    df = spark.createDataFrame(rows, "ord long, ring array<struct<x:double,y:double>>")
    found = {(r.x, r.y) for r in tiles.plan_tiles(df, GEOGRAPHIC, 4).collect()}
    full = {(x, y) for x in (16, 17) for y in (6, 7)}
    assert found == full - {(16, 6)}


def test_plan_wraps_beyond_the_world(spark):
    df = spark.createDataFrame([(0, ring((170, 0), (190, 0), (190, 10), (170, 10)))], "ord long, ring array<struct<x:double,y:double>>")
    found = {(r.x, r.wrap) for r in tiles.plan_tiles(df, GEOGRAPHIC, 3).collect()}
    assert found == {(15, 0), (0, 1)}


@pytest.mark.parametrize(("intervals", "expected"), [([(-106, -104), (-105, -103)], (-106, -103)), ([(170, 178), (-178, -170)], (170, -170)), ([(175, 185)], (175, -175)), ([(-180, 0), (0, 180)], (-180, 180)), ([(0, 360)], (-180, 180))])
def test_covering_arc(spark, intervals, expected):
    df = spark.createDataFrame([(0, float(a), float(b)) for a, b in intervals], "g int, lo double, hi double")
    row = bounds.covering_arc(df, ["g"]).first()
    assert (row.west, row.east) == expected


def test_window_fold_and_kernel_composite_alike(spark):
    rng = np.random.default_rng(1)
    layers = [(0, o, int(rng.integers(256)), float(rng.choice([0, 0.25, 0.5, 1]))) for o in range(6)]
    df = spark.createDataFrame(layers, "t int, ord int, c int, a double")
    colour = alpha = 0.0
    for _, _, c, a in sorted(layers, key=lambda v: -v[1]):
        colour, alpha = colour + (1 - alpha) * a * c, alpha + (1 - alpha) * a
    for found in (composite.composite(df, ["t"], ["c"]).first(), composite.folded(df, ["t"]).first()):
        assert found.pc == pytest.approx(colour) and found.pa == pytest.approx(alpha)


def test_packed_tiles_match_pixel_rows(spark):
    rng = np.random.default_rng(2)
    size, tiles_ = 4, [(3, x, y) for x in (0, 1) for y in (0, 1)][:3]
    data = {t: rng.integers(0, 256, (size, size, 4)).astype(np.uint8) for t in tiles_}
    for v in data.values():
        v[..., 3] = rng.choice([0, 128, 255], (size, size))
    packed = spark.createDataFrame([(*t, v.tobytes()) for t, v in data.items()], "z int, x long, y long, rgba binary")
    rows = [(*t, px, py, *map(int, v[py, px])) for t, v in data.items() for py in range(size) for px in range(size)]
    exploded = spark.createDataFrame(rows, "z int, x long, y long, px int, py int, r int, g int, b int, a int")
    tile = np.frombuffer(overview.halve_packed(packed, size).first().rgba, np.uint8).reshape(size, size, 4)
    for r in overview.halve(exploded, size).collect():
        assert [r.r, r.g, r.b, r.a] == tile[r.py, r.px].tolist()


def test_transparent_children_dilute_alpha_only(spark):
    rows = [(1, 0, 0, 0, 0, 200, 200, 200, 255)]
    df = spark.createDataFrame(rows, "z int, x long, y long, px int, py int, r int, g int, b int, a int")
    row = overview.halve(df, 1).first()
    assert (row.r, row.a) == (200, 64)


def test_blank_tiles_go(spark):
    df = spark.createDataFrame([(0, 0, 0, 0.001), (0, 1, 0, 0.5)], "z int, x int, y int, pa double")
    assert [r.x for r in composite.drop_blank(df).collect()] == [1]


def test_area_is_image_limits_include_exclude(spark):
    spec = '{"a": {"limits": {"south": 2}, "include": [{"pixel": [[0,0],[8,0],[8,8],[0,8]]}], "exclude": [{"lonlat": [[0,0],[4,0],[4,4],[0,4]]}], "manual": true}}'
    areas = spark.createDataFrame([(spec,)], "t string").select(F.explode(area.from_manifest(F.col("t"))).alias("s", "area"))
    cells = areas.select("area", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("i")).withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(9))))
    x, y = F.col("i") + 0.5, F.col("j") + 0.5
    inside = {(r.i, r.j) for r in cells.where(area.in_area(F.col("area"), x, y, x, y, F.lit(10), F.lit(10))).collect()}
    assert inside == {(i, j) for i in range(8) for j in range(2, 8) if not (i < 4 and j < 4)}


def test_thick_runs_and_widest_panel(spark):
    dark = set(range(10, 17)) | set(range(60, 66)) | set(range(200, 203)) | set(range(300, 310))
    df = spark.createDataFrame([("s", i, 1.0 if i in dark else 0.1) for i in range(400)], "sheet string, i int, fraction double")
    runs = detect.thick_runs(df, ["sheet"], "i")
    assert sorted((r.first, r.last) for r in runs.select("first", "last").collect()) == [(10, 16), (60, 65), (300, 309)]
    panel = detect.widest_panel(runs, ["sheet"]).first()
    assert (panel.a_last, panel.b_first) == (65, 300)


def test_fit_sides_ignores_outliers(spark):
    pos = np.arange(48) * 100.0
    depth = 200 + 0.05 * pos
    depth[::7] += 900
    df = spark.createDataFrame([("w", float(p), float(d)) for p, d in zip(pos, depth, strict=True)], "side string, pos double, depth double")
    row = detect.fit_sides(df, ["side"], 1).first()
    at = lambda p: row.a + (p - row.centre) / row.half * row.b
    assert at(0) == pytest.approx(200) and at(1000) == pytest.approx(250) and row.c == 0 and row.shift == pytest.approx(24)
    assert (row.lo, row.hi) == (100, 4700)


def test_sides_without_a_fit_give_no_row(spark):
    sides = {"few": [100.0] * 7, "no collar": [3.0] * 48, "wild": [100.0] * 5 + [1e6, 2e6, 3e6, 4e6], "arc": [100 + 0.01 * (i - 20) ** 2 for i in range(48)]}
    df = spark.createDataFrame([(s, float(i), d) for s, v in sides.items() for i, d in enumerate(v)], "side string, pos double, depth double")
    found = {r.side: r for r in detect.fit_sides(df, ["side"], 2).collect()}
    assert set(found) == {"arc"}
    exact = np.polyfit((np.arange(48) - found["arc"].centre) / found["arc"].half, sides["arc"], 2)
    assert [found["arc"].c, found["arc"].b, found["arc"].a] == pytest.approx(exact)


def sheet(spark, image):
    height, width = image.shape[:2]
    rows = [("s", c, r, *map(int, image[r, c])) for r in range(height) for c in range(width)]
    return spark.createDataFrame(rows, "sheet string, col int, row int, r int, g int, b int")


def test_neatline_shrinks_to_the_map(spark):
    image = np.full((60, 70, 3), 255, np.uint8)
    rng = np.random.default_rng(3)
    image[10:50, 12:60] = rng.integers(0, 255, (40, 48, 3))
    image[10:14, 12:60] = 20  # the neatline
    row = detect.neatlines(sheet(spark, image), 10, 2).first()
    assert (row.left, row.top, row.right, row.bottom, row.settled) == (12, 14, 60, 50, True)
    assert detect.neatlines(sheet(spark, np.full((20, 20, 3), 255, np.uint8)), 10, 2).count() == 0


def test_sectional_area_follows_its_collars(spark):
    """A collar of 80 to 120 pixels in the west, 60 in the north, none elsewhere."""
    rows, cols = 240, 240
    cells = spark.range(rows * cols).select(F.lit("s").alias("sheet"), (F.col("id") % cols).cast("int").alias("col"), F.floor(F.col("id") / cols).cast("int").alias("row"))
    paper = (F.col("col") < 20 + F.col("row") / 24) | (F.col("row") < 15)
    cells = cells.select("*", F.lit(cols).alias("cols"), F.lit(rows).alias("rows"), paper.alias("paper"))
    sheets = spark.createDataFrame([("s", 960, 960, None), ("t", 500, 400, None)], "sheet string, width int, height int, open_sides array<string>")
    fits = detect.sectional_fits(detect.collar_depths(cells, 12, 60), sheets)
    found = {r.sheet: r for r in detect.sectional_areas(fits).collect()}
    ring = [(p.x, p.y) for p in found["s"].ring]
    assert min(x for x, _ in ring) == pytest.approx(80 + 24 - 8, abs=12) and min(y for _, y in ring) == pytest.approx(60 + 24 - 8, abs=12)
    assert max(x for x, _ in ring) == 920 and max(y for _, y in ring) == 920 and "west" in found["s"].notes
    low = [x for x, y in ring if y > 900 and x < 300]
    assert min(low) > 115, "the west side slants"
    assert {(p.x, p.y) for p in found["t"].ring} >= {(40.0, 40.0), (460.0, 360.0)}
    shares = {r.side: r for r in detect.paper_inside(cells, fits).collect()}
    assert shares["north"].paper == 0 and not shares["west"].flagged


def test_shift_and_probe_offsets(spark):
    rng = np.random.default_rng(4)
    profile = rng.integers(0, 50, 60).tolist()
    page = spark.createDataFrame([(0, i, v) for i, v in enumerate(profile)], "g int, i long, total long")
    sheet = spark.createDataFrame([(0, i, v) for i, v in enumerate(profile[13:40])], "g int, i long, total long")
    assert register.best_shift(page, sheet, ["g"]).first().s == 13
    rendered = rng.integers(0, 2, (40, 40)).astype(bool)
    own = rendered[4 + 3 : 36 + 3, 4 - 2 : 36 - 2]
    assert register._correlated(own.astype(float), rendered.astype(float), 4)[:2] == (-2, 3)
    ink = [("s", 0, page, int(x), int(y)) for page, image in ((False, own), (True, rendered)) for y, x in np.argwhere(image)] + [("s", 1, False, 0, 0)]
    found = register.probe_offsets(spark.createDataFrame(ink, "sheet string, probe int, page boolean, x int, y int"), 32, 4, 20).collect()
    assert [(r.probe, r.dx, r.dy) for r in found] == [(0, -2, 3)] and found[0].score == pytest.approx(1)


def test_heal_is_columns_then_rows(spark):
    rng = np.random.default_rng(5)
    image = rng.integers(0, 256, (8, 9))
    outer, clean = [1, 1, 8, 7], [3, 2, 6, 5]
    expected = image.copy()
    expected[1:7, 1:3], expected[1:7, 6:8] = expected[1:7, 3:4], expected[1:7, 5:6]
    expected[1:2, 1:8], expected[5:7, 1:8] = expected[2:3, 1:8], expected[4:5, 1:8]
    cells = spark.createDataFrame([("s", c, r, int(image[r, c])) for r in range(8) for c in range(9)], "sheet string, col int, row int, c int")
    frames = spark.createDataFrame([("s", outer, clean)], "sheet string, outer array<int>, clean array<int>")
    for r in resample.heal(cells, frames, ("c",)).collect():
        assert r.c == expected[r.row, r.col]


@pytest.mark.parametrize("kernel", ["bicubic", "bilinear", "nearest"])
def test_identity_warp_is_exact(kernel):
    rgba = np.random.default_rng(6).integers(0, 256, (16, 16, 4)).astype(np.uint8)
    rgba[..., 3] = 255
    cols, rows = np.meshgrid(np.arange(16) + 0.5, np.arange(16) + 0.5)
    assert np.allclose(resample.warp(rgba, cols, rows, kernel)[..., :3], rgba[..., :3])


def test_flat_field_survives_reduction():
    rgba = np.full((64, 64, 4), 90, np.uint8)
    rgba[..., 3] = 255
    at = (np.arange(12) + 0.5) * 4 + 8
    done = resample.warp(rgba, *np.meshgrid(at, at))
    assert np.allclose(done[..., :3], 90, atol=1e-6) and np.allclose(done[..., 3], 1)


def test_blockwise_upsampling_is_seamless():
    image = np.random.default_rng(7).integers(0, 256, (70, 90, 3)).astype(np.uint8)
    model = resample.model_of("bilinear")
    assert (resample.upsample_blocks(image, model, 32, 16) == model(image)).all()
    with pytest.raises(ValueError, match="no kernel"):
        resample.kernel_of("lanczos")


def test_catalog_stages_and_editions(spark):
    rows = {r.name: r for r in catalog.series(spark).select("name", catalog.stages(F.col("pdf_scale"), F.col("upsample_scale"), F.col("heal")).alias("s")).collect()}
    assert rows["ifr-low"].s == ["render", "heal"] and rows["ifr-high"].s == ["render"]
    with pytest.raises(ValueError, match="no series"):
        catalog.one("x")
    df = spark.createDataFrame([("g", "2025-01-01", "a"), ("g", "2025-02-01", "b"), ("g", "2026-01-01", "c")], "k string, date string, link string").withColumn("date", F.col("date").cast("date"))
    assert catalog.current_edition(df, F.lit("2025-06-01").cast("date"), ["k"]).first().link == "b"


def test_reprojected_bounds_bulge(spark):
    lcc = geo.LambertConformalConic(45, 33, 39, -95)
    df = spark.createDataFrame([(0, -100.0, 35.0, -90.0, 45.0)], "k int, west double, south double, east double, north double")
    row = geo.reproject_bounds(df, "k", lcc.forward).first()
    corner = spark.range(1).select(lcc.forward(F.lit(-100.0), F.lit(45.0))[1].alias("y"), lcc.forward(F.lit(-95.0), F.lit(35.0))[1].alias("s")).first()
    assert row.north == pytest.approx(corner.y) and row.south == pytest.approx(corner.s)


def planned(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def test_registration_gathers_no_ink(spark):
    """Exploded rows pass for as few as their sheets, so that ink and profiles were broadcast."""
    sizes = spark.range(3).select(F.col("id").alias("sheet"), F.lit(60).alias("page_width"), F.lit(60).alias("page_height"), F.lit(40).alias("width"), F.lit(40).alias("height"))
    page = sizes.select("sheet", F.explode(F.sequence(F.lit(0), F.lit(59))).alias("x")).withColumn("y", F.explode(F.sequence(F.lit(0), F.lit(59)))).where((F.col("x") * F.col("x") * 7 + F.col("y") * 13 + F.col("x") * F.col("y")) % 11 < 3)
    sheet = page.select("sheet", (F.col("x") - 8).alias("x"), (F.col("y") - 6).alias("y")).where("x between 0 and 39 and y between 0 and 39")
    small = lambda ink: ink.where("x % 2 = 0 and y % 2 = 0").select("sheet", F.floor(F.col("x") / 2).alias("x"), F.floor(F.col("y") / 2).alias("y"))
    found = register.registered(page, sheet, small(page), small(sheet), sizes, 2, 12, 3, 20)
    assert planned(found).count("ShuffledHashJoin") == 2, "ink meets the few boxes"
    assert {(r.x, r.y, r.match) for r in found.collect()} == {(8, 6, 1.0)}
    lines = lambda n: sizes.select("sheet", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias("i")).withColumn("total", F.col("i") % 7)
    assert planned(register.best_shift(lines(60), lines(40), ["sheet"])).count("SortMergeJoin") >= 2


def test_probes_without_ink_of_their_own_give_no_row(spark):
    ink = [("s", 0, True, 1, 1), ("s", 1, False, 2, 2), ("s", 1, True, 4, 4), ("s", 2, False, 0, 0), ("s", 2, False, 1, 0), ("s", 2, True, 2, 2), ("s", 2, True, 3, 2)]
    df = spark.createDataFrame(ink, "sheet string, probe int, page boolean, x int, y int")
    assert [(r.probe, r.dx, r.dy) for r in register.probe_offsets(df, 8, 2, 2).collect()] == [(2, 0, 0)]
    assert {r.probe for r in register.probe_offsets(df, 8, 2, 0).collect()} == {1, 2}


def test_neatline_works_out_a_colour_once(spark, tmp_path):
    """Six conditions a pixel, repeated in every band of every filter, took most of the time."""
    spark.createDataFrame([(k,) for k in range(3)], "s_suppkey long").write.parquet(f"{tmp_path}/supplier.parquet")
    found = catalog_sheets.neatline(spark, str(tmp_path))
    assert found._jdf.queryExecution().optimizedPlan().toString().count(" % 30)") == 2, "once for each axis' runs"
    assert found.count() == 3


def test_neatlines_of_many_sheets_gather_no_pixels(spark, monkeypatch):
    image = np.full((60, 70, 3), 255, np.uint8)
    image[10:50, 12:60] = np.random.default_rng(3).integers(0, 255, (40, 48, 3))
    image[10:14, 12:60] = 20
    monkeypatch.setattr(detect, "MOST_SHEETS", 0)
    found = detect.neatlines(sheet(spark, image), 10, 2)
    assert planned(found).count("ShuffledHashJoin") == 2
    row = found.first()
    assert (row.left, row.top, row.right, row.bottom, row.settled) == (12, 14, 60, 50, True)


def test_paper_inside_measures_a_distance_once(spark):
    """Also with sides that have no fit, or one without a curve; the distance is not worked out for each end of the band."""
    fit = "struct<centre:double,half:double,a:double,b:double,c:double,shift:double,lo:double,hi:double>"
    fits = spark.createDataFrame([("s", 240, 240, (120.0, 100.0, 60.0, 20.0, 0.0, 4.0, 20.0, 220.0), None, None, (120.0, 100.0, None, None, None, None, 20.0, 220.0))], f"sheet string, width int, height int, west {fit}, east {fit}, north {fit}, south {fit}")
    flag = lambda c, r: (c * 7 + r * 3) % 5 == 0
    cells = spark.createDataFrame([("s", c, r, 60, 60, flag(c, r)) for c in range(60) for r in range(60)], "sheet string, col int, row int, cols int, rows int, paper boolean")
    found = detect.paper_inside(cells, fits, 40, 5)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("least(") <= 9
    expected: dict[str, list[int]] = {}
    for c in range(60):
        for r in range(60):
            x, y = (c + 0.5) * 4, (r + 0.5) * 4
            west = 60 + (min(max(y, 20), 220) - 120) / 100 * 20 + 4
            if 4 <= min(x - max(40, west), 200 - x, y - 40, 200 - y) <= 40:
                distance = [c, 60 - c, r, 60 - r]
                expected.setdefault(["west", "east", "north", "south"][distance.index(min(distance))], []).append(flag(c, r))
    assert {r.side: (r.n, r.paper) for r in found.collect()} == {s: (len(v), pytest.approx(sum(v) / len(v))) for s, v in expected.items() if len(v) > 5}


def test_sectional_fits_gather_no_points(spark, monkeypatch):
    """Points are written in so few bytes that every round broadcast them, all of a collection at once."""
    plans, kept = [], detect.cut
    monkeypatch.setattr(detect, "cut", lambda df, label: (plans.append(planned(df)), kept(df, label))[1])
    upright, flat = [(k + 0.5) * 800 / 48 for k in range(48)], [(k + 0.5) * 1000 / 48 for k in range(48)]
    points = [(s, side, p, d) for s in ("s", "open") for side, along, d in (("west", upright, 80.0), ("north", flat, 60.0)) for p in along] + [("s", "east", p, 50.0) for p in upright[:7]]
    depths = spark.createDataFrame(points, "sheet string, side string, pos double, depth double")
    sheets = spark.createDataFrame([("s", 1000, 800, None), ("open", 1000, 800, ["west"]), ("bare", 1000, 800, None)], "sheet string, width int, height int, open_sides array<string>")
    found = {r.sheet: r for r in detect.sectional_fits(depths, sheets).collect()}
    assert plans and not any("Broadcast" in p for p in plans)
    ends = lambda along, low, high: (min(p for p in along if p >= low), max(p for p in along if p <= high))
    for name, west, low in (("s", True, 80 + 24 + 20), ("open", False, 20)):
        r = found[name]
        assert (r.east, r.south) == (None, None) and (r.west is not None) == west, "too few points, or none"
        assert (r.north.a, r.north.shift) == pytest.approx((60, 24)) and (r.north.lo, r.north.hi) == ends(flat, low, 980)
    assert (found["s"].west.a, found["s"].west.b) == pytest.approx((80, 0)) and (found["s"].west.lo, found["s"].west.hi) == ends(upright, 60 + 24 + 16, 784)
    assert (found["bare"].width, found["bare"].west, found["bare"].north) == (1000, None, None)


@pytest.mark.parametrize(("cols", "rows"), [(150, 70), (64, 129), (5, 40)])
def test_band_profiles_of_packed_lines(spark, cols, rows):
    """Against plain means, on sheets with lines longer than a number's bits and bands of unequal or no width."""
    flags = np.random.default_rng(6).random((rows, cols)) < 0.4
    cells = spark.createDataFrame([("s", c, r, cols, rows, bool(flags[r, c])) for r in range(rows) for c in range(cols)], "sheet string, col int, row int, cols int, rows int, paper boolean")
    found = {(r.side, r.band): (r.extent, r.fractions) for r in detect.band_profiles(cells).collect()}
    expected = {}
    for lines, near, far in ((flags, "west", "east"), (flags.T, "north", "south")):
        band = np.array([-(-(k + 1) * 48 // len(lines)) - 1 for k in range(len(lines))])
        for b in set(band.tolist()):
            f = lines[band == b].mean(axis=0).tolist()
            expected |= {(near, b): (len(lines), f), (far, b): (len(lines), f[::-1])}
    assert found == expected
