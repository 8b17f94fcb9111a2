"""Files, tilesets from rasters, streams, the query catalog."""

import glob
import json
import os

import duckdb
import numpy as np
import pytest

from tessella import catalog, cli
from tessella.build import MapArea, MosaicSource, Polygon, TileBuildError, build_mosaic
from tessella.functions.geo import LambertConformalConic
from tessella.sources import archives, png, tiff

SF = "/root/testdata/sf0.001"


def save(path, image, gt=None, epsg=None):
    path.write_bytes(tiff.written(image, gt, epsg))
    return str(path)


def flat(height, width, rgb):
    return np.tile(np.array(rgb, np.uint8), (height, width, 1))


def test_png_round_trip():
    rng = np.random.default_rng(0)
    rgba = rng.integers(0, 256, (16, 16, 4)).astype(np.uint8)
    assert (png.decoded(png.encoded(rgba)) == rgba).all()
    rgba[..., 3] = 255
    assert png.encoded(rgba)[25] == 2 and (png.decoded(png.encoded(rgba)) == rgba).all()


def test_tiff_round_trip_and_georeference(tmp_path):
    image = np.random.default_rng(1).integers(0, 256, (20, 32, 3)).astype(np.uint8)
    gt = [-2189360.54, 262.48, 0.0, 1531470.09, 0.0, -262.47]
    reference, plain = save(tmp_path / "r.tif", image[..., :1], gt, 3857), save(tmp_path / "p.tif", image)
    out = tiff.copy_georeference(reference, plain, str(tmp_path / "o.tif"))
    data = open(out, "rb").read()
    h = tiff.header(data)
    assert h.geotransform == gt and h.epsg == 3857 and (tiff.pixels(data)[..., :3] == image).all()
    with pytest.raises(FileExistsError):
        tiff.copy_georeference(reference, plain, out)
    with pytest.raises(tiff.GeoReferenceError):
        tiff.copy_georeference(plain, reference, str(tmp_path / "x.tif"))
    with pytest.raises(ValueError, match="sizes differ"):
        tiff.copy_georeference(reference, save(tmp_path / "s.tif", image[:10]), str(tmp_path / "y.tif"))
    assert cli.main(["georef", reference, plain, out]) == 1
    assert cli.main(["georef", reference, plain, out, "--overwrite"]) == 0


def test_mosaic_paints_masks_and_averages(spark, tmp_path):
    red = save(tmp_path / "a.tif", flat(64, 64, (200, 0, 0)), [-20.0, 0.3125, 0, 10.0, 0, -0.3125], 4326)
    blue = save(tmp_path / "b.tif", flat(64, 64, (0, 0, 200)), [-10.0, 0.3125, 0, 10.0, 0, -0.3125], 4326)
    hole = Polygon("lonlat", ((-5, -5), (0, -5), (0, 5), (-5, 5)))
    sources = [MosaicSource(red), MosaicSource(blue, MapArea(exclude=(hole,)), detail=True)]
    out = str(tmp_path / "out")
    found = build_mosaic(spark, sources, out, min_zoom=0, max_zoom=2, detail_zoom=3, title="t")
    assert found["tiles_per_zoom"]["0"] == 1 and found["maxzoom"] == 3 and found["fullzoom"] == 2
    assert found["data_bounds"] == [-20.0, -10.0, 10.0, 10.0]
    levels = {z: {tuple(map(int, p[:-4].split(os.sep)[-2:])) for p in glob.glob(f"{out}/tiles/{z}/*/*.png")} for z in range(3)}
    assert levels[1] == {(x >> 1, y >> 1) for x, y in levels[2]} and levels[0] == {(0, 0)}
    tile = png.decoded(open(f"{out}/tiles/2/1/1.png", "rb").read())
    degrees = lambda lon: int((lon + 180) / 360 * 1024) - 256
    row = 250  # about 2 degrees north
    assert tile[row, degrees(-15), 0] > 190 and tile[row, degrees(-15), 3] == 255
    assert tile[row, degrees(-8), 2] > 190 and tile[row, degrees(-8), 0] < 10
    assert tile[row, degrees(-2.5), 0] > 190, "the sheet beneath shows through the hole"
    with pytest.raises(FileExistsError):
        build_mosaic(spark, sources, out)
    again = build_mosaic(spark, sources, out, max_zoom=2, resume=True)
    assert again["tiles"] == found["tiles"] and json.load(open(f"{out}/metadata.json"))["name"] == "out"


def test_mosaic_in_a_conic_projection(spark, tmp_path):
    lcc = LambertConformalConic(55, 50, 52, 180)
    sheet = save(tmp_path / "c.tif", flat(40, 80, (0, 150, 0)), [-300000.0, 7500.0, 0, 150000.0, 0, -7500.0])
    found = build_mosaic(spark, [MosaicSource(sheet, crs=lcc)], str(tmp_path / "o"), min_zoom=3, max_zoom=3)
    assert found["bounds"][0] > found["bounds"][2] and found["tiles"] == 2
    assert found["data_bounds"][0] > 0 > found["data_bounds"][2]


def test_build_errors(spark, tmp_path):
    plain = save(tmp_path / "p.tif", flat(8, 8, (1, 2, 3)))
    geo = save(tmp_path / "g.tif", flat(8, 8, (1, 2, 3)), [0.0, 1, 0, 8.0, 0, -1], 4326)
    with pytest.raises(TileBuildError, match="coordinate"):
        build_mosaic(spark, [MosaicSource(plain)], str(tmp_path / "a"))
    with pytest.raises(ValueError, match="none"):
        build_mosaic(spark, [MosaicSource(geo)], str(tmp_path / "b"), min_zoom=9)
    with pytest.raises(ValueError, match="finer"):
        build_mosaic(spark, [MosaicSource(geo)], str(tmp_path / "c"), max_zoom=3, detail_zoom=3)
    with pytest.raises(ValueError, match="limits"):
        MapArea(limits=(5, None, 5, None))


def test_archives_are_routed(spark, tmp_path):
    import zipfile

    from tessella.plans.catalog import one

    with zipfile.ZipFile(tmp_path / "x.zip", "w") as z:
        for name in ("in/ENR_L01.tif", "ENR_L01.pdf", "ENR_H01.tif", "notes.txt"):
            z.writestr(name, name)
    rows = archives.routed(archives.members(spark, str(tmp_path)), one("ifr-low")).collect()
    assert {r.target for r in rows} == {"ENR_L01.tif", "pdf/ENR_L01.pdf"}
    (tmp_path / "m.json").write_text('{"s.tif": {"frame": {"outer": [1,2,3,4], "clean": [2,3,2,3]}, "include": [{"pixel": [[0,0],[1,0],[1,1]]}]}}')
    frame = archives.frames(spark, str(tmp_path / "m.json"), 4).first()
    assert frame.outer == [4, 8, 12, 16] and frame.manual is False
    assert archives.manifest(spark, str(tmp_path / "m.json"), 2.0).first().area.include[0].points[1].x == 2.0


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    result = con.execute(catalog.ORACLE_SQL[name])
    columns = [c[0] for c in result.description]
    expected = result.fetchall()
    df = catalog.QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    key = lambda row: tuple((v is None, str(v)) for v in row)
    got = [tuple(r[c] for c in columns) for r in df.collect()]
    assert sorted(got, key=key) == sorted(expected, key=key)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_other_queries_run(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


def test_collar_onset_looks_at_all_events(spark, tmp_path):
    spark.range(6000, 8000).withColumnRenamed("id", "event_id").write.parquet(str(tmp_path / "events.parquet"))
    found = catalog.QUERIES["collar_onset"](spark, str(tmp_path)).collect()
    assert sorted((r.band, r.depth) for r in found) == [(band, 240) for band in range(25)]
