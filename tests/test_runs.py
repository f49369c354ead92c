import json

import numpy as np
from pyspark.sql import functions as F

from plumbline.functions.canonical import document_hash
from plumbline.operators import cad_exact, evaluator, intake
from plumbline.plans import pipeline
from plumbline.sources import artifacts, dxf, png
from plumbline.sources.tables import plans, together
from tests import layer_a


def test_whole_way(spark):
    bad = plans(spark, frame=[("bad", "dxf", 0.001, False, None, "mm")], wall=[("bad", 0, "w0", (0.0, 0.0), (10.0, 0.0))], room=[("bad", 0, "r0", [(0.0, 0.0), (1.0, 0.0)])])
    lost = plans(spark, finding=[("lost", "PARSE_SCALE_UNKNOWN", "error", 1, None, "no scale")])
    r = pipeline.run(together(layer_a.drawing(spark), bad, lost))
    status = {(s.stage, s.plan_id): (s.status, s.exit_code) for s in r.status.collect()}
    assert status == {("parse", "a"): ("complete", 0), ("parse", "bad"): ("failed", 3), ("parse", "lost"): ("failed", 3), ("geometry", "a"): ("complete", 0), ("camera", "a"): ("complete", 0)}
    assert r.viewpoint.count() == 2 and r.edge.count() == 1 and [x.key for x in r.map_entry.orderBy("pos").collect()] == ["0000", "0001"]
    assert r.coverage.first().every_room_covered


def test_intake(spark):
    image = bytearray(png.encode(np.zeros((4, 6), dtype=np.uint8)))
    jpeg = bytearray(bytes.fromhex("FFD8FFE000104A46494600010100000100010000FFC0001108000A00140301220002110103110100"))
    draw = bytearray(b"0\nSECTION\n2\nHEADER\n9\n$INSUNITS\n70\n6\n0\nENDSEC\n0\nEOF\n")
    rows = [("p", "a.png", "floorplan", image), ("q", "a.jpg", "floorplan", jpeg), ("r", "a.dxf", "floorplan", draw), ("s", "a.pdf", "floorplan", bytearray(b"%PDF-1.4 /Type /Page /Type /Pages")), ("t", "b.png", "floorplan", jpeg), ("u", "../c.png", "style", image), ("v", "x.gif", "style", image)]
    files = spark.createDataFrame(rows, "project string, path string, kind string, content binary").withColumn("length", F.length("content").cast("long"))
    seen = intake.inspect(files)
    got = {r.project: (r.format, r.fault, tuple(r["size"]) if r["size"] else None) for r in seen.collect()}
    assert got["p"] == ("png", None, (6, 4)) and got["q"] == ("jpg", None, (20, 10)) and got["r"][:2] == ("dxf", None) and got["s"][:2] == ("pdf", None)
    assert (got["t"][1], got["u"][1], got["v"][1]) == ("FORMAT_MISMATCH", "UNSAFE_PATH", "UNSUPPORTED_EXTENSION")
    given = spark.createDataFrame([("p", 0.01, None), ("q", None, None)], "project string, m_per_px double, units string")
    q = {r.project: (r.scale_known, r.units, r.status, r.blocker) for r in intake.quality(seen, given).collect()}
    assert q["p"][0] and q["q"] == (False, None, "partial", "INPUT_SCALE_UNKNOWN") and q["r"][:2] == (True, "m")
    runs = spark.createDataFrame([("p", "run-1"), ("q", "bad id!")], "project string, run_id string")
    declared = spark.createDataFrame([("p", "a.png", "1", "floorplan"), ("q", "a.jpg", "2", "style")], "project string, path string, sha256 string, kind string")
    actual = spark.createDataFrame([("p", "a.png", "1"), ("q", "a.jpg", "3")], "project string, path string, sha256 string")
    faults = sorted(map(tuple, intake.preflight(runs, declared, actual, intake.quality(seen, given)).collect()))
    assert faults == [("q", "FLOORPLAN_COUNT"), ("q", "HASH_MISMATCH"), ("q", "QUALITY"), ("q", "RUN_ID")]
    frames = spark.createDataFrame([("a", "dxf", "mm", 0.001), ("b", "raster", "px", 0.005), ("c", "dxf", "cm", 0.01)], "plan_id string, kind string, source_units string, unit_scale_m double")
    manifest = spark.createDataFrame([("a", "mm", None), ("b", None, 0.005), ("c", "m", None)], "plan_id string, units string, m_per_px double")
    assert [r.plan_id for r in intake.units_agree(frames, manifest).collect()] == ["c"]


def test_exact_route(spark):
    body = ["0", "SECTION", "2", "HEADER", "9", "$INSUNITS", "70", "4", "0", "ENDSEC", "0", "SECTION", "2", "ENTITIES"]
    body += ["0", "LINE", "8", "PLAN-WALL", "10", "0", "20", "0", "11", "4000", "21", "0", "1001", "PLAN", "1040", "0.2"]
    body += ["0", "ARC", "8", "PLAN-WALL", "10", "4000", "20", "1000", "40", "1000", "50", "-90", "51", "90"]
    body += ["0", "ARC", "8", "PLAN-WALL", "10", "0", "20", "0", "40", "10", "50", "0", "51", "360"]
    files = spark.createDataFrame([("a", "\n".join([*body, "0", "ENDSEC", "0", "EOF"]), 900)], "plan_id string, text string, bytes long")
    wall = cad_exact.walls(files).orderBy("idx").collect()
    assert [(w.id, w.kind) for w in wall] == [("w-0000", "segment"), ("w-0001", "circular_arc")] and wall[0].thickness_mm == 200 and abs(wall[1].bulge - 1) < 1e-9 and wall[1].segments >= 8
    spans = [("a", 0, [(1000.0, 0.0), (1900.0, 0.0)]), ("a", 1, [(5000.0, 1000.0), (5000.0, 1001.0)]), ("a", 2, [(0.0, 900.0), (0.0, 950.0)])]
    o = spark.createDataFrame(spans, "plan_id string, idx int, span array<struct<x: double, y: double>>")
    assert [r.wall_id for r in cad_exact.hosts(o, cad_exact.walls(files)).orderBy("idx").collect()] == ["w-0000", "w-0001", None]
    rec = cad_exact.records(cad_exact.walls(files))
    key = evaluator.geometry_key(*(F.to_json(F.struct(c)) for c in ("kind", "a_mm", "b_mm", "center_mm", "radius_mm", "start_deg", "end_deg")))
    keyed = rec.withColumn("key", key)
    scores = evaluator.plan_scores(keyed, evaluator.matches(keyed, keyed.where("ord = 0"), "plan_id", "key"))
    assert scores.first().score == 0.5
    assert dxf.parse(files, exact=True).wall.count() == 2


def test_stored_artifacts(spark, tmp_path):
    first = {"schema_id": "floorplan_parse", "schema_version": "1.0.0", "artifact_id": "x", "status": "complete", "inputs": [], "errors": [], "payload": {"walls": [{"id": "w", "start": [0, 0], "end": [1, 0]}], "rooms": [], "openings": []}}
    first["content_hash"] = document_hash(first)
    second = {**first, "artifact_id": "y", "status": "failed", "inputs": [{"artifact_id": "x", "content_hash": first["content_hash"]}, {"artifact_id": "z", "content_hash": "h"}]}
    second["content_hash"] = document_hash(second)
    for name, doc in (("x", first), ("y", second), ("z", {**first, "status": "partial"})):
        (tmp_path / f"{name}.json").write_text(json.dumps(doc))
    docs = artifacts.read(spark, f"file://{tmp_path}")
    assert sorted(r.fault for r in artifacts.envelope_faults(docs).collect()) == ["HASH_MISMATCH", "NO_ERRORS"]
    assert {(r.input_id, r.state) for r in artifacts.lineage(docs.where("artifact_id <> 'x' or status = 'complete'")).collect()} == {("x", "intact"), ("z", "missing")}
    far = {"payload": {"walls": [{"id": "w", "start": [1e9, 0], "end": [0, 0]}], "rooms": [], "openings": []}}
    none = {"payload": {"walls": [], "rooms": [], "openings": []}}
    rows = [("ok", json.dumps(first)), ("far", json.dumps(far)), ("none", json.dumps(none))]
    wall, room, opening, found = artifacts.geometry(spark.createDataFrame(rows, "plan_id string, json string"))
    assert [r.plan_id for r in wall.collect()] == ["ok"] and {(r.plan_id, r.code) for r in found.collect()} == {("far", "GEOM_RESOURCE_LIMIT"), ("none", "GEOM_EMPTY_GEOMETRY")}
    import hashlib

    images = spark.createDataFrame([("p", bytearray(b"img")), ("q", bytearray(b"other"))], "plan_id string, content binary")
    anchors = json.dumps({"raster_sha256": hashlib.sha256(b"img").hexdigest(), "anchors": [{"id": "a", "real_length_m": 1.0, "span_px": 200.0}]})
    got = artifacts.scale_anchors(images, spark.createDataFrame([("p", anchors), ("q", anchors)], "plan_id string, json string"))
    assert [r.plan_id for r in got.collect()] == ["p"]
