import numpy as np
import pytest

from plumbline.operators import evaluator, raster
from plumbline.sources import png


def stroke(img, x1, y1, x2, y2, w=3, v=0):
    half = w // 2
    img[min(y1, y2) - half : max(y1, y2) + w - half, min(x1, x2) - half : max(x1, x2) + w - half] = v


def two_rooms():
    img = np.full((700, 900), 255, dtype=np.uint8)
    stroke(img, 100, 100, 800, 100)
    stroke(img, 100, 600, 800, 600)
    stroke(img, 100, 100, 100, 600)
    stroke(img, 800, 100, 800, 600)
    stroke(img, 450, 100, 450, 300)
    stroke(img, 450, 380, 450, 600)  # a passage of 80 px
    return img


def test_png_round_trip():
    rng = np.random.default_rng(1)
    for pixels in (rng.integers(0, 256, (7, 5), dtype=np.uint8), rng.integers(0, 65536, (4, 6)).astype(np.uint16), rng.integers(0, 256, (3, 4, 3), dtype=np.uint8)):
        assert np.array_equal(png.decode(png.encode(pixels)), pixels)


def test_headers_and_histograms(spark):
    depth = np.array([[1000, 1000], [0, 65535]], dtype=np.uint16)
    rows = [("a", bytearray(png.encode(depth))), ("b", bytearray(b"no image")), ("c", None)]
    df = spark.createDataFrame(rows, "id string, content binary")
    from pyspark.sql import functions as F

    h = {r.id: r.h for r in df.select("id", png.header(F.col("content")).alias("h")).collect()}
    assert (h["a"].width, h["a"].height, h["a"].depth, h["a"].colour) == (2, 2, 16, 0) and h["b"] is None and h["c"] is None
    assert {(r.v, r.n) for r in png.histograms(df.where("content is not null"), "id").collect()} == {(0, 1), (1000, 2), (65535, 1)}


def test_components_in_scan_order():
    mask = np.array([[1, 0, 1, 0, 1], [0, 1, 0, 0, 1], [0, 0, 0, 0, 0], [1, 1, 0, 0, 1]], dtype=bool)
    label, n = raster.components(mask)
    assert n == 4 and label.tolist() == [[1, 0, 1, 0, 2], [0, 1, 0, 0, 2], [0, 0, 0, 0, 0], [3, 3, 0, 0, 4]]


def test_two_rooms(spark):
    df = spark.createDataFrame([("p", bytearray(png.encode(two_rooms())))], "plan_id string, content binary")
    rows = raster.recognise(df).collect()
    kinds = [r.kind for r in rows]
    assert "finding" not in kinds, [r.code for r in rows if r.kind == "finding"]
    assert kinds.count("segment") == 5 and kinds.count("room") == 2 and kinds.count("passage") == 1
    assert all(r.thickness == 3 for r in rows if r.kind == "segment")
    scale = spark.createDataFrame([("p", 0.005)], "plan_id string, m_per_px double")
    mm = raster.in_millimetres(raster.recognise(df), scale)
    areas = sorted(abs(sum(a.x * b.y - b.x * a.y for a, b in zip(r.polygon, [*r.polygon[1:], r.polygon[0]]))) / 2e6 for r in mm.where("kind = 'room'").collect())
    assert areas == pytest.approx([4.375, 4.375], rel=0.03)


def test_arc():
    img = np.full((900, 900), 255, dtype=np.uint8)
    yy, xx = np.mgrid[:900, :900]
    ring = (np.abs(np.hypot(xx - 450, yy - 450) - 250) <= 1.5) & (xx >= 450)
    img[ring] = 0
    stroke(img, 100, 200, 450, 200)
    stroke(img, 100, 700, 450, 700)
    stroke(img, 100, 200, 100, 700)
    arc = raster.find_arc(img == 0)
    assert arc and abs(arc["r"] - 250) < 2 and abs(arc["cx"] - 450) < 2 and (arc["end"] - arc["start"]) % 360 >= 180


def test_guards(spark):
    flat = np.full((50, 50), 200, dtype=np.uint8)
    full = np.zeros((50, 50), dtype=np.uint8)
    full[0, 0] = 255
    df = spark.createDataFrame([("flat", bytearray(png.encode(flat))), ("full", bytearray(png.encode(full))), ("junk", bytearray(b"x"))], "plan_id string, content binary")
    codes = {(r.plan_id, r.code) for r in raster.recognise(df).where("kind = 'finding'").collect()}
    assert ("flat", "RASTER_LOW_CONTRAST") in codes and ("full", "RASTER_CLUTTER_EXCEEDS_ENVELOPE") in codes and ("junk", "PARSE_SOURCE_UNSUPPORTED") in codes


def test_fits(spark):
    t = np.linspace(0, 2, 40)
    points = spark.createDataFrame([("c", float(10 + 5 * np.cos(a)), float(-3 + 5 * np.sin(a))) for a in t], "id string, x double, y double")
    c = evaluator.circle_fit(points, "id").first()
    assert (c.cx, c.cy, c.r) == pytest.approx((10, -3, 5))
    line = spark.createDataFrame([("l", float(k), float(k)) for k in range(11)], "id string, x double, y double")
    assert evaluator.principal_extent(line, "id").first().extent == pytest.approx(10 * 2**0.5 + 1)


def test_anchors_and_probe(spark):
    img = two_rooms()
    stroke(img, 100, 650, 300, 650, w=2, v=64)
    stroke(img, 500, 650, 600, 650, w=2, v=64)
    df = spark.createDataFrame([("p", bytearray(png.encode(img))), ("q", bytearray(b"x"))], "plan_id string, content binary")
    rows = [("p", "a", 0, 1.0, 200.0, 200.0, 650.0), ("p", "b", 1, 0.5, 100.0, 210.0, 650.0), ("p", "c", 2, 0.5, 100.0, 0.0, 0.0), ("q", "a", 0, 1.0, 200.0, 1.0, 1.0)]
    anchors = spark.createDataFrame(rows, "plan_id string, id string, ord int, real_length_m double, span_px double, x double, y double")
    got = {(r.plan_id, r.id): r.measured_px for r in raster.measured_anchors(df, anchors).collect()}
    assert got[("p", "a")] == pytest.approx(202, abs=2) and got[("p", "b")] == pytest.approx(102, abs=2) and got[("p", "c")] is None and got[("q", "a")] is None
    seen = raster.probe(df.where("plan_id = 'p'")).first()
    assert (seen.width, seen.height) == (900, 700) and seen.dark_64 == int((img < 64).sum()) and seen.edges_64 > 0


def test_top_view(spark):
    from plumbline.operators import compile as comp, normalize
    from plumbline.sinks import topview
    from tests import layer_a

    m = comp.compile_model(normalize.normalize(layer_a.drawing(spark)))
    img = png.decode(bytes(topview.render(m.wall, m.room, m.opening).first().png))
    assert img.shape == (340, 440, 3) and (img == (180, 83, 9)).all(axis=2).any() and (img == (20, 83, 45)).all(axis=2).any()
