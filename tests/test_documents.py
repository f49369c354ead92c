"""Sources, contracts, packages, sinks and runs."""

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.functions.canonical import document_hash
from plumbline.operators import camera, compile as comp, contracts, lifecycle, normalize, package
from plumbline.sinks import commit, overlays
from plumbline.sources import annotation, dxf, png, scenes
from plumbline.streaming import run_states
from tests import layer_a

MACHINE = {
    "states": ["NEW", "READY", "CHECKED", "DONE", "BLOCKED", "CANCELLED"],
    "terminal_states": ["DONE", "CANCELLED"],
    "gates": {"G1": {"name": "check", "human": True, "evidence": ["approval"]}},
    "transitions": [
        {"from": "NEW", "to": "READY", "gate": None, "required_artifacts": ["manifest"], "on_fail": "BLOCKED"},
        {"from": "READY", "to": "CHECKED", "gate": "G1", "required_artifacts": [], "on_fail": "REWORK"},
        {"from": "CHECKED", "to": "DONE", "gate": None, "required_artifacts": [], "on_fail": "REWORK"},
    ],
    "rework_policy": {"default_targets_by_reason_prefix": {"A_": "NEW", "A_B_": "READY"}},
}


def drawing():
    out = ["0", "SECTION", "2", "HEADER", "9", "$INSUNITS", "70", "4", "0", "ENDSEC", "0", "SECTION", "2", "ENTITIES"]
    line = lambda layer, a, b: ["0", "LINE", "8", layer, "10", str(a[0]), "20", str(a[1]), "30", "0.0", "11", str(b[0]), "21", str(b[1]), "31", "0.0"]
    for a, b in layer_a.WALLS:
        out += line("PLAN-WALL", a, b)
    for r in layer_a.ROOMS:
        out += ["0", "LWPOLYLINE", "8", "PLAN-ROOM", "90", str(len(r)), "70", "1"]
        for x, y in r:
            out += ["10", str(x), "20", str(y)]
    for kind, (x, y), w, host in layer_a.OPENINGS:
        h = 500 * w
        a, b = ((x, y - h), (x, y + h)) if host in (1, 4) else ((x - h, y), (x + h, y))
        out += line(f"PLAN-{kind.upper()}", a, b)
    out += ["0", "CIRCLE", "8", "NOTES", "10", "0", "20", "0", "40", "5", "0", "SPLINE", "8", "NOTES"]
    return "\n".join([*out, "0", "ENDSEC", "0", "EOF"]) + "\n"


def test_drawing(spark, tmp_path):
    (tmp_path / "a.dxf").write_text(drawing())
    plans = dxf.parse(dxf.read(spark, f"file://{tmp_path}"))
    n = normalize.normalize(plans)
    assert normalize.projection(n).first().projection_hash == layer_a.PROJECTION
    assert sorted((r.code, r.source_ref) for r in n.finding.unionByName(plans.finding).collect()) == [("PARSE_UNMAPPED_SOURCE_ENTITY", "unknown-layer-0001"), ("PARSE_UNSUPPORTED_FEATURE", plans.finding.where("severity = 'error'").first().source_ref)]


def test_bulged_ring_and_thickness(spark):
    ring = F.array(*(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((0.0, 0.0), (1000.0, 0.0), (1000.0, 1000.0), (0.0, 1000.0))))
    out = spark.range(1).select(dxf.bulged_ring(ring, F.array(*map(F.lit, (0.0, 1.0, 0.0, 0.0)))).alias("r")).first().r
    assert len(out) > 10 and max(p.x for p in out) == pytest.approx(1500, abs=3)
    tags = spark.createDataFrame([([(1, 1001, "OTHER"), (2, 1040, "9"), (3, 1001, "APP"), (4, 1000, "thick"), (5, 1040, "0.15")],)], "tags array<struct<pos: int, code: int, value: string>>")
    assert tags.select(dxf.thickness(F.col("tags"), "APP")).first()[0] == 0.15


def annotated():
    px = lambda p: [p[0] / 5, 1800 - p[1] / 5]
    doc = {
        "schema_id": "floorplan_annotation",
        "schema_version": "1.0.0",
        "payload": {
            "image": {"source_image_ref": "i.png", "sha256": "sha256:00", "width_px": 2000, "height_px": 1800},
            "scale_m_per_px": 0.005,
            "walls": [{"start_px": px(a), "end_px": px(b)} for a, b in layer_a.WALLS],
            "rooms": [{"polygon_px": [px(p) for p in r]} for r in layer_a.ROOMS],
            "openings": [{"type": k, "wall_index": h, "center_px": px(c), "width_m": w} for k, c, w, h in layer_a.OPENINGS],
            "declared_dimensions": [],
        },
    }
    return {**doc, "content_hash": document_hash(doc)}


def test_annotation(spark):
    doc = annotated()
    rows = [("good", json.dumps(doc)), ("changed", json.dumps({**doc, "schema_version": "9"})), ("junk", "{")]
    plans = annotation.parse(spark.createDataFrame(rows, "plan_id string, json string"))
    assert {(r.plan_id, r.code) for r in plans.finding.collect()} == {("changed", "PARSE_SOURCE_HASH_MISMATCH"), ("junk", "PARSE_SOURCE_UNSUPPORTED")}
    assert normalize.projection(normalize.normalize(plans)).where("plan_id = 'good'").first().projection_hash == layer_a.PROJECTION


def test_contracts(spark):
    schema = {"$id": "u", "type": "object", "required": ["a"], "additionalProperties": False, "properties": {"schema_id": {}, "schema_version": {}, "a": {"type": "integer", "minimum": 1}, "b": {"type": "array", "minItems": 1, "items": {"$ref": "#/$defs/s"}}}, "$defs": {"s": {"type": "string", "pattern": "^x"}}}
    base = {"schema_id": "s", "schema_version": "1.0.0"}
    docs = [("ok", {**base, "a": 1.0}), ("bad", {**base, "a": 0, "b": ["y", 3], "c": 1}), ("none", {"schema_id": "t"})]
    df = spark.createDataFrame([(k, json.dumps(v)) for k, v in docs], "doc string, json string")
    got = {r.doc: [(e.path, e.keyword) for e in r.errors] for r in contracts.validate_documents(df, {("s", "1.0.0"): schema}).collect()}
    assert got == {"ok": [], "bad": [("$", "additionalProperties"), ("$.a", "minimum"), ("$.b[0]", "pattern"), ("$.b[1]", "type")], "none": [("$", "unknown schema")]}
    body = {"z": 1, "a": "é"}
    full = json.dumps({**body, "content_hash": document_hash(body)})
    assert contracts.with_hash(spark.createDataFrame([(full,), ('{"a":1}',)], "json string")).orderBy(F.desc("intact")).select("intact").collect()[0].intact
    paths = spark.createDataFrame([(p,) for p in ("a/b.txt", "/a", "a/../b", "a//b", "c:/x", "a\\b", "", ".")], "p string")
    assert [r.ok for r in paths.select(contracts.safe_path(F.col("p")).alias("ok")).collect()] == [True] + [False] * 7
    a = spark.createDataFrame([("p", "run-1", "complete", '{"x":1}', "[]", "[]", "2026-01-01T00:00:00Z")], "plan_id string, run_id string, status string, payload string, errors string, inputs string, created_at string")
    made = json.loads(contracts.artifact(a, "camera_plan", "1.0.0", "engine").first().json)
    assert made["content_hash"] == document_hash(made)


def test_lifecycle(spark):
    m = lifecycle.machine(spark, MACHINE)
    assert {(r.state, r.depth) for r in lifecycle.reachable(m).collect()} == {("NEW", 0), ("READY", 1), ("CHECKED", 2), ("DONE", 3)}
    events = [("1", "NEW", "READY", ["manifest"], False, False), ("2", "NEW", "READY", [], False, False), ("3", "NEW", "READY", ["manifest"], True, False), ("4", "READY", "CHECKED", [], False, False), ("5", "READY", "CHECKED", [], False, True), ("6", "DONE", "BLOCKED", [], False, True), ("7", "READY", "DONE", [], False, True), ("8", "READY", "CANCELLED", [], False, True)]
    got = {r.run: (r.next_state, r.reason) for r in lifecycle.next_states(spark.createDataFrame(events, "run string, state string, target string, artifacts array<string>, failed boolean, approved boolean"), m).collect()}
    assert got == {"1": ("READY", None), "2": ("NEW", "MISSING_ARTIFACT"), "3": ("BLOCKED", "FAILED"), "4": ("READY", "NOT_APPROVED"), "5": ("CHECKED", None), "6": ("DONE", "TERMINAL"), "7": ("READY", "NO_TRANSITION"), "8": ("CANCELLED", None)}
    codes = spark.createDataFrame([("A_B_C",), ("A_X",), ("Q",)], "code string")
    assert {tuple(r) for r in lifecycle.rework_targets(codes, m).collect()} == {("A_B_C", "READY"), ("A_X", "NEW"), ("Q", None)}
    reviews = [("c", 1, "r1", None, False), ("c", 2, "r2", "r1", False), ("c", 3, "r3", "nope", False), ("c", 4, "r1", None, False)]
    faults = lifecycle.review_faults(spark.createDataFrame(reviews, "chain_id string, ord int, review_id string, parent_id string, supersedes boolean"))
    assert sorted(r.ord for r in faults.collect()) == [3, 4]


def test_recognition_codes(spark):
    rows = [("raster_auto", None, 0.5, "cw", None, "circular_arc", None), ("odd", 0.5, None, None, 0.1, "segment", None), ("cad_exact", None, None, None, None, "door", 1.6), ("cad_exact", None, None, None, None, "passage", 3.0)]
    df = spark.createDataFrame(rows, "sc string, sg double, b double, sw string, th double, k string, w double")
    got = [r.c for r in df.select(lifecycle.recognition_codes(*(F.col(c) for c in ("sc", "sg", "b", "sw", "th", "k", "w"))).alias("c")).collect()]
    assert got[0] == ["RECOGNITION_ARC_NO_SAGITTA_BOUND", "RECOGNITION_ARC_BULGE_SWEEP_MISMATCH", "RECOGNITION_THICKNESS_MISSING"]
    assert got[1:] == [["RECOGNITION_SOURCE_CLASS_INVALID"], ["RECOGNITION_OPENING_SPAN_EXCEEDS_BOUND"], []]


def matrix(x, height=1.35):
    return f"-1 0 0 {x}\n0 0 -1 2\n0 -1 0 {height}\n0 0 0 1\n"


def build_scene(root, name, **change):
    rgb, depth = np.zeros((16, 32, 3), dtype=np.uint8), np.full((16, 32), 2000, dtype=np.uint16)
    files = {"map.json": '{"0000": ["0001"]}'}
    for k, v in enumerate(("0000", "0001")):
        files |= {f"viewpoints/{v}/extrinsics.txt": matrix(k), f"viewpoints/{v}/place_image.png": png.encode(rgb), f"viewpoints/{v}/place_depth.png": png.encode(depth), f"viewpoints/{v}/place_depth_scale.txt": "1000\n"}
    for path, content in {**files, **change.get("files", {})}.items():
        if content is None:
            continue
        target = os.path.join(root, name, path)
        os.makedirs(os.path.dirname(target), exist_ok=True)
        with open(target, "wb") as f:
            f.write(content.encode() if isinstance(content, str) else content)


SCENES = {
    "good": ({}, set()),
    "no map": ({"map.json": None}, {"NO_MAP_FILE", "VIEWPOINT_NOT_IN_MAP"}),
    "bad map": ({"map.json": "[1]"}, {"MAP_JSON_INVALID", "VIEWPOINT_NOT_IN_MAP"}),
    "same key": ({"map.json": '{"0000": ["0001"], "0000": []}'}, {"DUPLICATE_MAP_KEY", "VIEWPOINT_NOT_IN_MAP"}),
    "no values": ({"map.json": '{"0000": [], "0001": []}'}, {"EMPTY_MAP_VALUES"}),
    "unknown": ({"map.json": '{"0000": ["0001", "0007"]}'}, {"MAP_REFERENCES_UNKNOWN_VIEWPOINT"}),
    "again": ({"map.json": '{"0000": ["0001", "0001"]}'}, {"DUPLICATE_VIEWPOINT_IN_MAP"}),
    "missing": ({"viewpoints/0001/extrinsics.txt": None}, {"MISSING_REQUIRED_FILE"}),
    "empty": ({"viewpoints/0001/place_depth_scale.txt": ""}, {"EMPTY_FILE"}),
    "words": ({"viewpoints/0001/extrinsics.txt": "a b\n"}, {"MATRIX_PARSE_ERROR"}),
    "3x3": ({"viewpoints/0001/extrinsics.txt": "1 0 0\n0 1 0\n0 0 1\n"}, {"INVALID_MATRIX_SHAPE"}),
    "flat": ({"viewpoints/0001/extrinsics.txt": "0 0 0 0\n0 0 0 0\n0 0 0 0\n0 0 0 1\n"}, {"MATRIX_NOT_INVERTIBLE"}),
    "high": ({"viewpoints/0001/extrinsics.txt": matrix(1, 9)}, {"CAMERA_HEIGHT_OUTLIER"}),
    "near": ({"viewpoints/0001/extrinsics.txt": matrix(0.1)}, {"VIEWPOINTS_TOO_CLOSE"}),
    "square": ({"viewpoints/0001/place_image.png": png.encode(np.zeros((16, 16, 3), dtype=np.uint8))}, {"INVALID_ASPECT_RATIO", "DEPTH_RGB_DIMENSION_MISMATCH"}),
    "grey": ({"viewpoints/0001/place_image.png": png.encode(np.zeros((16, 32), dtype=np.uint8))}, {"INVALID_IMAGE_MODE"}),
    "no image": ({"viewpoints/0001/place_image.png": "text"}, {"IMAGE_UNREADABLE"}),
    "no depth": ({"viewpoints/0001/place_depth.png": png.encode(np.zeros((16, 32), dtype=np.uint16))}, {"DEPTH_MOSTLY_INVALID"}),
    "scale": ({"viewpoints/0001/place_depth_scale.txt": "-1"}, {"INVALID_DEPTH_SCALE"}),
    "range": ({"viewpoints/0001/place_depth_scale.txt": "1"}, {"DEPTH_RANGE_IMPLAUSIBLE"}),
    "ceiling": ({"viewpoints/0001/place_depth.png": png.encode(np.full((16, 32), 65535, dtype=np.uint16)), "viewpoints/0001/place_depth_scale.txt": "5000"}, {"DEPTH_SCALE_SATURATED"}),
    "name": ({"viewpoints/CON/x.txt": "x"}, {"INVALID_FILENAME", "VIEWPOINT_NOT_IN_MAP"}),
    "views": ({f"viewpoints/{v}/{f}": None for v in ("0000", "0001") for f in package.REQUIRED}, {"MISSING_VIEWPOINTS_DIR"}),
}


def test_packages(spark, tmp_path):
    for name, (files, _) in SCENES.items():
        build_scene(tmp_path, name, files=files)
    config = spark.createDataFrame([("good", "start.png", "place_image.png", 1)], "scene string, start_image string, pano_image_name string, max_views int")
    s = scenes.read(spark, f"file://{tmp_path}", config)
    found = package.validate(s)
    got = {name: set() for name in SCENES}
    for r in found.collect():
        got[r.scene].add(r.code)
    assert got.pop("good") == {"START_IMAGE_MISSING", "PANO_NAME_COLLISION", "VIEWPOINT_BUDGET_EXCEEDED"}
    assert got == {name: codes for name, (_, codes) in SCENES.items() if name != "good"}


def test_overlay_and_commit(spark, tmp_path):
    n = normalize.normalize(layer_a.drawing(spark))
    model = comp.compile_model(n)
    views, _ = camera.place_viewpoints(model)
    svg = overlays.render(model.wall, model.room, model.opening, views).first().svg
    assert svg.startswith("<svg") and svg.count("<line") == 5 and svg.count("<polygon") == 2 and svg.count("<circle") == 6 and "-0," not in svg
    folder = f"file://{tmp_path}/runs"
    final = commit.commit({"wall": model.wall.drop("start", "end"), "view": views.select("plan_id", "id")}, folder, "run-1")
    assert spark.read.parquet(f"{final}/wall").count() == 5 and not os.path.exists(f"{tmp_path}/runs/.staging/run-1")
    with pytest.raises(FileExistsError):
        commit.commit({"view": views}, folder, "run-1")
    assert commit.verify(spark, final, commit.file_hashes(spark, final)).count() == 0
    tree = contracts.tree_hashes(commit.file_hashes(spark, final).withColumn("run", F.lit("run-1")), "run").first().tree_hash
    assert tree.startswith("sha256:")


def test_stream_of_runs(spark, tmp_path):
    rows = [("r", 1, "READY", ["manifest"], False, False), ("r", 2, "CHECKED", [], True, False), ("r", 3, "CHECKED", [], False, True), ("r", 4, "DONE", [], False, False), ("r", 5, "READY", [], False, False), ("q", 1, "READY", [], False, False)]
    spark.createDataFrame(rows, run_states.EVENT).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(run_states.EVENT).parquet(str(tmp_path / "in"))
    q = run_states.advance(stream, MACHINE).writeStream.format("memory").queryName("plumbline_runs").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = [tuple(r) for r in spark.table("plumbline_runs").orderBy("run", "seq").collect()]
    assert got == [("q", 1, "NEW", 0, "MISSING_ARTIFACT"), ("r", 1, "READY", 0, None), ("r", 2, "READY", 1, "FAILED"), ("r", 3, "CHECKED", 0, None), ("r", 4, "DONE", 0, None), ("r", 5, "DONE", 0, "TERMINAL")]
