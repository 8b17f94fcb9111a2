"""Stages of products on small sheets, tile options, downloads."""

import glob
import http.server
import io
import json
import os
import threading
import zipfile

import numpy as np
import pytest

from tessella import cli, products
from tessella.build import MapArea, MosaicSource, Polygon, TileBuildError, build_mosaic, build_tileset
from tessella.operators import resample
from tessella.plans import catalog
from tessella.sources import fetch, png, tiff


def save(path, image, gt=None, epsg=None):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(tiff.written(image, gt, epsg))
    return str(path)


def noise(height, width, seed=0):
    return np.random.default_rng(seed).integers(0, 256, (height, width, 3)).astype(np.uint8)


GT = [-20.0, 0.3125, 0, 10.0, 0, -0.3125]


def tiles_of(out):
    return {p.removeprefix(f"{out}/tiles/"): open(p, "rb").read() for p in glob.glob(f"{out}/tiles/*/*/*.png")}


# -- files


def test_tiled_files_round_trip(tmp_path):
    image = noise(70, 90)
    writer = tiff.TiledWriter(str(tmp_path / "t.tif"), 90, 70, 32, tiff.georeference_tags(tiff.header(tiff.written(image, GT, 4326)), 2))
    for r in range(3):
        for c in range(3):
            if (r, c) != (1, 1):
                writer.put(r, c, image[r * 32 : (r + 1) * 32, c * 32 : (c + 1) * 32])
    assert not (tmp_path / "t.tif").exists()
    writer.close()
    data = (tmp_path / "t.tif").read_bytes()
    h = tiff.read_header(str(tmp_path / "t.tif"))
    image[32:64, 32:64] = 0
    assert (tiff.pixels(data)[..., :3] == image).all() and h.epsg == 4326
    assert h.geotransform == [-20.0, 0.15625, 0, 10.0, 0, -0.15625]


def test_lzw_is_unpacked():
    # 9-bit codes: clear, 65, 66, 258 ("AB"), 260 ("ABA", not yet known), end
    codes = [256, 65, 66, 258, 260, 257]
    bits = "".join(format(c, "09b") for c in codes)
    data = int(bits.ljust(-(-len(bits) // 8) * 8, "0"), 2).to_bytes(-(-len(bits) // 8), "big")
    assert tiff._unlzw(data) == b"ABABABA"


def test_blocks_and_samples_of_strips_and_tiles(spark, tmp_path):
    image = noise(150, 130, 1)
    save(tmp_path / "s.tif", image)
    writer = tiff.TiledWriter(str(tmp_path / "t.tif"), 130, 150, 48)
    for r in range(writer.down):
        for c in range(writer.across):
            writer.put(r, c, image[r * 48 : (r + 1) * 48, c * 48 : (c + 1) * 48])
    writer.close()
    for name in ("s.tif", "t.tif"):
        files = spark.createDataFrame([(0, name, (tmp_path / name).read_bytes())], "ord long, sheet string, content binary")
        blocks = tiff.raster_blocks(files, 64).collect()
        assert sorted((r.by, r.bx) for r in blocks) == [(y, x) for y in range(3) for x in range(3)]
        whole = np.zeros((192, 192, 4), np.uint8)
        for r in blocks:
            whole[r.by * 64 : r.by * 64 + 64, r.bx * 64 : r.bx * 64 + 64] = np.frombuffer(r.rgba, np.uint8).reshape(64, 64, 4)
        assert (whole[:150, :130, :3] == image).all() and whole[150:].max() == 0
        seen = {(r.row, r.col): (r.r, r.g, r.b) for r in tiff.sampled(files, 4).collect()}
        assert seen == {(y, x): tuple(map(int, image[4 * y, 4 * x])) for y in range(37) for x in range(32)}


# -- tilesets


def test_resumed_tiles_are_left_alone(spark, tmp_path):
    sheet = save(tmp_path / "a.tif", noise(64, 64), GT, 4326)
    out = str(tmp_path / "out")
    build_mosaic(spark, [MosaicSource(sheet)], out, max_zoom=3)
    first = tiles_of(out)
    lost = ["3/3/3.png", "1/0/0.png"]
    assert set(lost) <= set(first)
    (tmp_path / "out/tiles/2/1/1.png").write_bytes(png.encoded(np.full((256, 256, 4), 255, np.uint8)))  # a mark
    for name in lost:
        os.unlink(f"{out}/tiles/{name}")
    build_mosaic(spark, [MosaicSource(sheet)], out, max_zoom=3, resume=True)
    again = tiles_of(out)
    assert set(again) == set(first) and again["3/3/3.png"] == first["3/3/3.png"]
    assert again["2/1/1.png"] != first["2/1/1.png"], "a tile that exists is kept"
    assert again["1/0/0.png"] != first["1/0/0.png"], "its parent is made from what is there"


def test_geographic_tiles(spark, tmp_path):
    sheet = save(tmp_path / "a.tif", np.tile(np.array([9, 99, 199], np.uint8), (64, 64, 1)), GT, 4326)
    found = build_tileset(spark, sheet, str(tmp_path / "o"), scheme="geographic", max_zoom=2)
    assert found["scheme"] == "geographic" and found["crs"] == "EPSG:4326"
    assert found["bounds"] == [-45.0, -45.0, 0.0, 45.0]
    tile = png.decoded(open(tmp_path / "o/tiles/2/3/1.png", "rb").read())
    at = lambda lon, lat: (int((45 - lat) / 45 * 256), int((lon + 45) / 45 * 256))
    assert tile[at(-10, 5)].tolist() == [9, 99, 199, 255] and tile[at(-30, 5)][3] == 0
    with pytest.raises(ValueError, match="scheme"):
        build_tileset(spark, sheet, str(tmp_path / "p"), scheme="polar")


def test_box_in_the_source_s_system_and_blank_tiles(spark, tmp_path):
    sheet = save(tmp_path / "a.tif", noise(64, 64), GT, 4326)
    boxed = build_tileset(spark, sheet, str(tmp_path / "a"), bbox=(-15, -5, -10, 5), bbox_crs="source", max_zoom=4)
    plain = build_tileset(spark, sheet, str(tmp_path / "b"), bbox=(-15, -5, -10, 5), max_zoom=4)
    assert boxed["data_bounds"] == [-15.0, -5.0, -10.0, 5.0] == plain["data_bounds"] and tiles_of(tmp_path / "a") == tiles_of(tmp_path / "b")
    hole = MapArea(exclude=(Polygon("lonlat", ((-30, -20), (10, -20), (10, 20), (-30, 20))),))
    with pytest.raises(TileBuildError, match="no tiles"):
        build_mosaic(spark, [MosaicSource(sheet, hole)], str(tmp_path / "c"), max_zoom=3)
    assert build_mosaic(spark, [MosaicSource(sheet, hole)], str(tmp_path / "d"), max_zoom=3, min_zoom=3, skip_blank=False)["tiles"] > 0
    with pytest.raises(ValueError, match="EPSG:4326"):
        build_tileset(spark, sheet, str(tmp_path / "e"), bbox=(0, 0, 1, 1), bbox_crs="EPSG:3857")


def test_sources_without_map_area_are_left_out(spark, tmp_path, caplog):
    a, b = save(tmp_path / "a.tif", noise(64, 64), GT, 4326), save(tmp_path / "b.tif", noise(64, 64), GT, 4326)
    empty = MapArea(limits=(50, None, None, None))
    found = build_mosaic(spark, [MosaicSource(a), MosaicSource(b, empty)], str(tmp_path / "o"), max_zoom=2)
    assert found["sources"] == ["a.tif"] and "b.tif" in caplog.text
    with pytest.raises(TileBuildError, match="map area"):
        build_mosaic(spark, [MosaicSource(b, empty)], str(tmp_path / "p"))


def test_a_tolerance_moves_few_pixels(spark, tmp_path):
    sheet = save(tmp_path / "a.tif", noise(64, 64), GT, 4326)
    exact, near = str(tmp_path / "x"), str(tmp_path / "y")
    build_mosaic(spark, [MosaicSource(sheet)], exact, max_zoom=3, min_zoom=3)
    build_mosaic(spark, [MosaicSource(sheet)], near, max_zoom=3, min_zoom=3, tolerance=0.125)
    a, b = (png.decoded(tiles_of(p)["3/3/3.png"]).astype(int) for p in (exact, near))
    assert np.abs(a - b).max() > 0 and np.abs(a - b).mean() < 3


# -- healing and doubling


def test_upsampled_blocks_are_seamless(spark):
    image = np.concatenate([noise(70, 90, 7), np.full((70, 90, 1), 255, np.uint8)], axis=2)
    rows = []
    for by in range(3):
        for bx in range(3):
            part = np.zeros((32, 32, 4), np.uint8)
            piece = image[by * 32 : (by + 1) * 32, bx * 32 : (bx + 1) * 32]
            part[: piece.shape[0], : piece.shape[1]] = piece
            rows.append((5, bx, by, part.tobytes()))
    blocks = spark.createDataFrame(rows, "ord long, bx int, by int, rgba binary")
    sizes = spark.createDataFrame([(5, 90, 70)], "ord long, width int, height int")
    for model in ("bilinear", "bicubic"):
        whole = resample.model_of(model)(image)
        for r in resample.upsample(blocks, sizes, model, 32, 16).collect():
            got = np.frombuffer(r.rgba, np.uint8).reshape(64, 64, 4)
            want = whole[r.by * 64 : (r.by + 1) * 64, r.bx * 64 : (r.bx + 1) * 64]
            assert (got[: want.shape[0], : want.shape[1]] == want).all()


def healed_plainly(image, outer, clean):
    """Columns first over the frame's height, then rows over its width."""
    (x0, y0, x1, y1), (a0, b0, a1, b1), done = outer, clean, image.copy()
    for x in range(x0, x1):
        done[y0:y1, x] = image[y0:y1, min(max(x, a0), a1 - 1)]
    for y in [*range(y0, b0), *range(b1, y1)]:
        done[y, x0:x1] = done[min(max(y, b0), b1 - 1), x0:x1]
    return done


@pytest.mark.parametrize("rows", [1, 7, 64, 500])
def test_healing_by_bands(rows):
    image = noise(90, 80, 4)
    outer, clean = [6, 5, 75, 80], [12, 17, 70, 66]
    bands = lambda: (image[k : k + rows] for k in range(0, 90, rows))
    done = np.concatenate(list(resample.heal_bands(bands, (80, 90), outer, clean)))
    assert (done == healed_plainly(image, outer, clean)).all()
    with pytest.raises(ValueError, match="plausible"):
        list(resample.heal_bands(bands, (80, 70), outer, clean))


def test_windows_of_a_sheet(spark, tmp_path):
    image = noise(100, 90, 5)
    folder = tmp_path / "tac"
    save(folder / "A TAC.tif", image, GT, 4326)
    tac = catalog.one("tac")
    products.upsample(spark, str(folder), tac, "nearest", windows={"A TAC.tif": (10, 20, 70, 95)}).collect()
    h = tiff.read_header(str(folder / "upscaled/A TAC.tif"))
    assert (h.width, h.height) == (120, 150) and h.geotransform[:2] == [GT[0] + 10 * GT[1], GT[1] / 2] and h.geotransform[3] == GT[3] + 20 * GT[5]
    assert (tiff.pixels((folder / "upscaled/A TAC.tif").read_bytes())[::2, ::2, :3] == image[20:95, 10:70]).all()
    with pytest.raises(ValueError, match="window"):
        products.upsample(spark, str(folder), tac, windows={"A TAC.tif": (10, 20, 200, 95)}, force=True)
    assert products.required(str(folder), ["A TAC.tif", "B.tif"]) == ["B.tif"] and products.required(str(folder), ["B.tif"], "A TAC.tif") == []


def test_stages_of_a_series(spark, tmp_path, capsys):
    """Frames are found and healed, sheets doubled, the product built; what is up to date is left."""
    low = catalog.one("ifr-low") | {"pdf_scale": 0, "upsample_scale": 2}
    image = np.full((120, 160, 3), 220, np.uint8)
    image[::7, ::5] = 60
    image[8:15, 5:150], image[100:107, 5:150] = 0, 0
    image[8:107, 5:12], image[8:107, 143:150] = 0, 0
    folder = tmp_path / "ifr-low"
    for name in ("ENR_L01.tif", "ENR_L02.tif", "notes.tif"):
        save(folder / name, image, GT, 4326)
    (folder / "areas.json").write_text('{"ENR_L02.tif": {"manual": true, "frame": {"outer": [5, 8, 150, 107], "clean": [15, 18, 140, 97]}, "include": [{"pixel": [[5, 8], [150, 8], [150, 107], [5, 107]]}]}}')
    found = {r.name: r.status for r in products.detect_areas(spark, str(folder), low).collect()}
    assert found == {"ENR_L01.tif": "found", "ENR_L02.tif": "manual"}
    entry = json.load(open(folder / "areas.json"))["ENR_L01.tif"]
    assert entry["frame"] == {"outer": [5, 8, 150, 107], "clean": [15, 18, 140, 97]} and entry["include"][0]["pixel"][2] == [150, 107]

    assert sorted(r.name for r in products.heal(spark, str(folder), low).collect()) == ["ENR_L01.tif", "ENR_L02.tif"]
    healed = tiff.pixels((folder / "healed/ENR_L01.tif").read_bytes())
    assert healed[8:107, 5:150, :3].min() == 60 and (healed[..., :3] == healed_plainly(image, [5, 8, 150, 107], [15, 18, 140, 97])).all()
    assert products.heal(spark, str(folder), low).count() == 0
    assert products.heal(spark, str(folder), low, force=True).count() == 2

    done = products.upsample(spark, str(folder), low, "nearest").collect()
    assert sorted((r.name, r.blocks) for r in done) == [("ENR_L01.tif", 1), ("ENR_L02.tif", 1)]
    doubled = folder / "upscaled/ENR_L01.tif"
    assert tiff.read_header(str(doubled)).geotransform[1] == GT[1] / 2
    assert (tiff.pixels(doubled.read_bytes())[::2, ::2, :3] == image).all()
    assert products.upsample(spark, str(folder), low).count() == 0

    with pytest.raises(ValueError, match="out of date|missing"):
        products.check_stages(spark, str(folder), low)  # healed from sheets older than the doubled ones
    products.heal(spark, str(folder), low, str(folder / "upscaled"), 2, force=True)
    products.check_stages(spark, str(folder), low)
    sources = products.sources_of(str(folder), low)
    assert [os.path.basename(s.path) for s in sources] == ["ENR_L01.tif", "ENR_L02.tif"] and sources[0].area.include[0].points[2] == (300, 214)

    out = str(tmp_path / "out")
    assert cli.main(["product", "ifr-low", str(tmp_path), out, "--charts", str(folder), "--only", "ENR_L01", "--max-zoom", "2"]) == 0
    assert json.load(open(f"{out}/metadata.json"))["sources"] == ["ENR_L01.tif"]
    assert cli.main(["product", "ifr-low", str(tmp_path), out + "2", "--charts", str(folder), "--only", "X"]) == 1
    assert "begins with X" in capsys.readouterr().err


# -- downloads


@pytest.fixture
def server(tmp_path):
    """Serves x.zip well, short.zip cut off twice and then well, bad.zip always cut off, none.zip without charts."""
    def packed(*names):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for n in names:
                z.writestr(n, n)
        return out.getvalue()

    whole, tries = packed("deep/ENR_L01.tif", "ENR_L01.pdf", "ENR_H01.tif", "notes.txt"), {}

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            name = self.path.strip("/")
            tries[name] = tries.get(name, 0) + 1
            data = packed("notes.txt") if name == "none.zip" else whole
            if name == "lost.zip":
                self.send_error(404)
                return
            self.send_response(200)
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            cut_off = name == "bad.zip" or (name == "short.zip" and tries[name] < 3)
            self.wfile.write(data[:50] if cut_off else data)

        def log_message(self, *args):
            pass

    httpd = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=httpd.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{httpd.server_address[1]}", tries
    httpd.shutdown()


def test_archives_are_fetched_with_retries(spark, server, tmp_path):
    url, tries = server
    names = ("x.zip", "short.zip", "bad.zip", "none.zip", "lost.zip")
    done = fetch.fetch(spark, [f"{url}/{n}" for n in names], catalog.one("ifr-low"), str(tmp_path / "low"), pause=0.01).collect()
    rows = {r.archive: r for r in done}
    assert rows["x.zip"].files == ["ENR_L01.tif", "pdf/ENR_L01.pdf"] and rows["x.zip"].bytes > 0
    assert rows["short.zip"].error is None and tries["short.zip"] == 3
    assert "50 of" in rows["bad.zip"].error or "retrieval incomplete" in rows["bad.zip"].error.lower()
    assert "no chart" in rows["none.zip"].error and "404" in rows["lost.zip"].error
    assert sorted(os.listdir(tmp_path / "low")) == ["ENR_L01.tif", "pdf"]
    row = fetch.outcome(spark.createDataFrame(done, "url string, archive string, files array<string>, bytes long, seconds double, error string")).first()
    assert (row.done, row.failed, row.names) == (2, 3, "bad.zip, lost.zip, none.zip")


def test_tilesets_are_served(tmp_path):
    import urllib.error
    import urllib.request

    from tessella import serve

    (tmp_path / "b/3/1").mkdir(parents=True)
    (tmp_path / "a").mkdir()
    (tmp_path / "b/metadata.json").write_text('{"name": "B"}')
    (tmp_path / "a/metadata.json").write_text("{broken")
    (tmp_path / "b/3/1/2.png").write_bytes(png.encoded(np.zeros((4, 4, 4), np.uint8)))
    httpd = serve.server(str(tmp_path), port=0)
    threading.Thread(target=httpd.serve_forever, daemon=True).start()
    root = f"http://127.0.0.1:{httpd.server_address[1]}"
    listed = lambda: json.load(urllib.request.urlopen(f"{root}/tilesets.json"))
    assert listed() == [{"path": "a", "name": "a", "valid": False}, {"path": "b", "name": "B", "valid": True}]
    (tmp_path / "metadata.json").write_text("{}")
    assert listed()[0] == {"path": "", "name": "tileset", "valid": True}, "each request looks again"
    tile = urllib.request.urlopen(f"{root}/b/3/1/2.png")
    assert tile.headers["Content-Type"] == "image/png" and tile.headers["Access-Control-Allow-Origin"] == "*" and tile.headers["Cache-Control"] is None
    assert urllib.request.urlopen(f"{root}/b/metadata.json").headers["Cache-Control"] == "no-cache"
    with pytest.raises(urllib.error.HTTPError, match="404"):
        urllib.request.urlopen(f"{root}/b/3/1/3.png")
    httpd.shutdown()
    with pytest.raises(FileNotFoundError):
        serve.server(str(tmp_path / "none"))
