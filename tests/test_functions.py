"""Scalar rules: grid, projections, pixels, names."""

import math

import pytest
from pyspark.sql import functions as F

from tessella.functions import geo, grid, pixels, text
from tessella.functions.grid import GEOGRAPHIC, MERCATOR


def one(spark, **columns):
    return spark.range(1).select(*(c.alias(n) for n, c in columns.items())).first()


def test_tile_range_is_edge_exact_and_clamped(spark):
    r = one(spark, r=GEOGRAPHIC.tile_range(F.lit(2), F.lit(-90.0), F.lit(0.0), F.lit(0.0), F.lit(45.0))).r
    assert (r.x_min, r.x_max, r.y_min, r.y_max) == (2, 3, 1, 1)
    r = one(spark, r=GEOGRAPHIC.tile_range(F.lit(1), F.lit(-999.0), F.lit(-99.0), F.lit(999.0), F.lit(99.0))).r
    assert (r.x_min, r.x_max, r.y_min, r.y_max) == (0, 3, 0, 1)


def test_empty_bounds_are_an_error(spark):
    with pytest.raises(Exception, match="bounds are empty"):
        one(spark, r=GEOGRAPHIC.tile_range(F.lit(2), F.lit(5.0), F.lit(0.0), F.lit(5.0), F.lit(1.0)))


def test_flip_is_an_involution_and_bounds_meet(spark):
    row = one(spark, f=MERCATOR.flip_y(F.lit(5), MERCATOR.flip_y(F.lit(5), F.lit(7))), a=GEOGRAPHIC.tile_bounds(F.lit(3), F.lit(2), F.lit(1)), b=GEOGRAPHIC.tile_bounds(F.lit(3), F.lit(3), F.lit(1)))
    assert row.f == 7
    assert row.a.east == row.b.west


def test_zoom_rounds_up_unless_almost_there(spark):
    base = 2 * grid.HALF_WORLD / 256
    row = one(spark, a=MERCATOR.zoom_for_resolution(F.lit(base / 8)), b=MERCATOR.zoom_for_resolution(F.lit(base / 8 * 0.99)), c=MERCATOR.zoom_for_resolution(F.lit(base * 9)))
    assert (row.a, row.b, row.c) == (3, 4, 0)
    with pytest.raises(Exception, match="positive"):
        one(spark, a=MERCATOR.zoom_for_resolution(F.lit(0.0)))


def test_mercator_round_trip(spark):
    row = one(spark, lat=geo.y_to_lat(geo.lat_to_y(F.lit(51.5))), lon=geo.x_to_lon(geo.lon_to_x(F.lit(-179.9))), cap=geo.lat_to_y(F.lit(90.0)))
    assert row.lat == pytest.approx(51.5) and row.lon == pytest.approx(-179.9) and row.cap == pytest.approx(grid.HALF_WORLD, abs=1e-3)


def test_longitudes(spark):
    row = one(spark, a=geo.unwrap(F.lit(-170.0), F.lit(175.0)), b=geo.normalise(F.lit(180.0)), c=geo.normalise(F.lit(190.0)), d=geo.normalise(F.lit(-541.0)), e=geo.arc_centre(F.lit(170.0), F.lit(-170.0)))
    assert (row.a, row.b, row.c, row.d, row.e) == (190.0, 180.0, -170.0, 179.0, 180.0)


def test_lambert_agrees_with_its_inverse(spark):
    import numpy as np

    from tessella.build import _lcc_inverse

    lcc = geo.LambertConformalConic(45, 33, 39, -95, 1000.0, 2000.0)
    x, y = lcc.forward(F.lit(-100.25), F.lit(41.5))
    row = one(spark, x=x, y=y)
    lon, lat = _lcc_inverse(lcc, np.array(row.x), np.array(row.y))
    assert float(lon) == pytest.approx(-100.25, abs=1e-9) and float(lat) == pytest.approx(41.5, abs=1e-9)


def test_lambert_from_wkt():
    wkt = 'PROJCS["x",GEOGCS["g",DATUM["d",SPHEROID["s",6378137,298.25]]],PROJECTION["Lambert_Conformal_Conic_2SP"],PARAMETER["standard_parallel_1",45],PARAMETER["standard_parallel_2",33],PARAMETER["latitude_of_origin",39],PARAMETER["central_meridian",-95],PARAMETER["false_easting",5]]'
    found = geo.LambertConformalConic.from_wkt(wkt)
    assert (found.lat_1, found.lon_0, found.false_easting, found.inverse_flattening) == (45, -95, 5, 298.25)
    assert geo.LambertConformalConic.from_wkt('PROJCS["x",PROJECTION["Mercator_1SP"]]') is None


def test_affine_inverse_undoes(spark):
    gt = F.array(*(F.lit(float(v)) for v in (100, 2, 0.5, -50, 0.25, -3)))
    p = geo.apply_affine(gt, F.lit(17), F.lit(29))
    q = geo.apply_affine(geo.invert_affine(gt), p["x"], p["y"])
    row = one(spark, q=q, none=geo.invert_affine(F.array(*(F.lit(0.0) for _ in range(6)))))
    assert row.q.x == pytest.approx(17) and row.q.y == pytest.approx(29) and row.none is None


def test_quantise_rounds_half_to_even(spark):
    row = one(spark, a=pixels.quantise(F.lit(0.5)), b=pixels.quantise(F.lit(1.5)), c=pixels.quantise(F.lit(-3.0)), d=pixels.quantise(F.lit(999.0)), e=pixels.finish_colour(F.lit(5.0), F.lit(0.0)))
    assert (row.a, row.b, row.c, row.d, row.e) == (0, 2, 0, 255, 0)


@pytest.mark.parametrize(("name", "pattern", "expected"), [("ENR_L01.zip", r"ENR_L\d\d\.zip", True), ("enr_l01.ZIP", r"ENR_L\d\d\.zip", True), ("ENR_L01.zip\n", r"ENR_L\d\d\.zip", False), ("xENR_L01.zip", r"ENR_L\d\d\.zip", False), ("a", "", False)])
def test_full_match(spark, name, pattern, expected):
    assert one(spark, m=text.full_match(F.lit(name), pattern)).m is expected


def test_links_are_made_absolute(spark):
    base = F.lit("https://a.example/b/c.html?q=1#f")
    cases = {"/x": "https://a.example/x", "y": "https://a.example/b/y", "//h/z": "https://h/z", "http://o/p": "http://o/p"}
    row = one(spark, **{f"c{i}": text.resolve(base, F.lit(k)) for i, k in enumerate(cases)})
    assert list(row) == list(cases.values())


def test_tracker_urls_and_classes(spark):
    row = one(spark, a=text.tile_of_url(F.lit("/t/3/1/2.webp?v=1"), "/t/"), b=text.tile_of_url(F.lit("/t/3/1.webp"), "/t/"), c=text.request_class(F.lit(0), F.lit(0), F.lit(0)), d=text.request_class(F.lit(10), F.lit(50), F.lit(50)), e=text.request_class(F.lit(350), F.lit(50), F.lit(50)), f=text.edition_date(F.lit("/12-25-2025/x.zip")), g=text.edition_date(F.lit("/13-45-2025/x.zip")))
    assert (row.a.z, row.a.x, row.a.y) == (3, 1, 2) and row.b is None
    assert (row.c, row.d, row.e) == ("opaque", "cached", "downloaded")
    assert str(row.f) == "2025-12-25" and row.g is None


def test_mip_and_lattice(spark):
    row = one(spark, a=grid.mip_factor(F.lit(1.9)), b=grid.mip_factor(F.lit(9.0)), c=grid.lattice_step(F.lit(0.0)), d=grid.lattice_step(F.lit(1.0)), e=grid.lattice_step(F.lit(1.0), 256, 4))
    assert (row.a, row.b, row.c, row.d, row.e) == (1, 8, 16, 16, 4)


def test_mercator_tile_matches_arithmetic(spark):
    t = MERCATOR.tile_of(F.lit(10), geo.lon_to_x(F.lit(13.4)), geo.lat_to_y(F.lit(52.5)))
    row = one(spark, t=t).t
    n = 1 << 10
    y = (1 - math.log(math.tan(math.radians(52.5)) + 1 / math.cos(math.radians(52.5))) / math.pi) / 2
    assert (row.x, row.y) == (int((13.4 + 180) / 360 * n), int(y * n))


def test_mercator_x_on_a_tile_edge_is_the_statements(spark):
    """Where multiplying by a ready-made quotient comes out on the other side of the edge."""
    edges = [(135.0, 5), (112.5, 6), (-135.0, 4), (135.0, 8), (112.5, 9)]
    row = one(spark, x=F.array(*(MERCATOR.tile_of(F.lit(z), geo.lon_to_x(F.lit(lon)), F.lit(0.0))["x"] for lon, z in edges)))
    assert row.x == [27, 51, 2, 223, 415]
