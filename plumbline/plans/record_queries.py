"""Queries of the operators on packages, white models, runs and documents, with SQL.

Their inputs are made from the star-schema tables by arithmetic on the keys, over all
rows, so that every code occurs; expressions that say only what an input holds are
common to both sides, what follows from it isn't."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions import geometry as g
from plumbline.functions.canonical import content_hash
from plumbline.operators import compile as comp, contracts, evaluator, intake, lifecycle, package
from plumbline.plans import projections as pj
from plumbline.plans.queries import query

# A package is a customer, a viewpoint an order.
_VIEW = """SELECT o_custkey AS c, CAST(o_custkey AS STRING) AS scene, o_orderkey AS k, 'v' || CAST(o_orderkey AS STRING) || CASE WHEN o_orderkey % 29 = 0 THEN '.' ELSE '' END AS viewpoint FROM orders"""
_NAMES = (*package.REQUIRED, "start.png", "pano.png", "aux.txt")
_SIZE = "CASE WHEN i < 4 AND (k + i) % 31 = 0 THEN 0 ELSE 10 END"
_THERE = "CASE i WHEN 4 THEN k % 2 = 0 WHEN 5 THEN k % 41 = 0 WHEN 6 THEN k % 43 = 0 ELSE (k + i) % 37 <> 1 END"
_MAPPED = "c % 5 <> 4"
_FAULT = "CASE WHEN c % 11 = 0 THEN 'MAP_JSON_INVALID' END"
_ENTRY = f"""SELECT c, scene, 'map_1.json' AS map_file, CAST(row_number() OVER (PARTITION BY scene ORDER BY k) - 1 AS INT) AS pos, viewpoint AS key, CASE k % 3 WHEN 1 THEN nxt WHEN 2 THEN 'ghost' END AS val
FROM (SELECT *, lead(viewpoint) OVER (PARTITION BY scene ORDER BY k) AS nxt FROM ({_VIEW}) v) x WHERE k % 7 <> 0 AND {_MAPPED} AND c % 11 <> 0"""
_IMAGE_MODE = "CASE WHEN k % 61 = 0 THEN NULL WHEN k % 13 = 0 THEN 'RGBA' ELSE 'RGB' END"
_DEPTH_MODE = "CASE WHEN k % 19 = 0 THEN 'L' ELSE 'I;16' END"
_WIDTH = "CAST(CASE WHEN k % 6 = 0 THEN 1001 WHEN k % 2 = 0 THEN 2048 ELSE 1024 END AS INT)"
_HEIGHT = "CAST(CASE WHEN k % 9 = 0 THEN 500 WHEN k % 6 = 0 THEN 500 WHEN k % 2 = 0 THEN 1024 ELSE 512 END AS INT)"
_DEPTH_WIDTH = f"CASE WHEN k % 15 = 0 THEN 512 ELSE {_WIDTH} END"
_DEPTH_HEIGHT = f"CASE WHEN k % 15 = 0 THEN 256 ELSE {_HEIGHT} END"
_DEPTHS = f"""SELECT scene, viewpoint, CAST(CASE WHEN l_partkey % 4 = 0 THEN 0 WHEN l_suppkey % 31 = 0 THEN 65535 ELSE (l_partkey * 7) % 4000 END AS INT) AS v, count(*) AS n
FROM lineitem JOIN ({_VIEW}) o ON l_orderkey = k GROUP BY 1, 2, 3"""
_RAW = "CASE WHEN k % 47 = 0 THEN NULL WHEN k % 16 = 0 THEN 'x' WHEN k % 16 = 1 THEN '0' WHEN k % 16 = 2 THEN ' -3' WHEN k % 3 = 0 THEN '20' ELSE ' 1000.0 ' END"
_A, _B, _C = ("CASE WHEN k % 3 = 0 THEN -1.0 ELSE 1.0 END", "CASE WHEN k % 5 = 0 THEN 0.0 ELSE 1.0 END", "CASE WHEN k % 7 = 0 THEN 2.0 ELSE 1.0 END")


def _scenes(spark: SparkSession, sf_dir: str) -> package.Scenes:
    pj.tables(spark, sf_dir, "orders", "lineitem")
    v = spark.sql(_VIEW)
    names = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(name).alias("name")) for i, name in enumerate(_NAMES)))
    file = v.select("*", F.inline(names)).where(_THERE)
    file = file.select("scene", "viewpoint", "name", F.concat_ws("/", F.lit("viewpoints"), "viewpoint", "name").alias("path"), F.expr(_SIZE).alias("size"))
    scene = v.select("scene", "c").distinct()
    d = lambda e: F.expr(f"CAST({e} AS DOUBLE)")
    z = F.lit(0.0)
    matrix = F.array(d(_A), z, z, d("k % 90"), z, z, -d(_B), z, z, F.lit(-1.0), z, d("(k % 11) * 0.5"), z, z, z, d(_C))
    image = lambda name, mode, width, height: v.select("scene", "viewpoint", F.lit(name).alias("name"), F.expr(mode).alias("mode"), F.expr(width).alias("width"), F.expr(height).alias("height"))
    return package.Scenes(
        scene=scene.select("scene", (F.col("c") % 17 != 0).alias("has_views")),
        file=file,
        map_file=scene.where(_MAPPED).select("scene", F.lit("map_1.json").alias("map_file"), F.expr(_FAULT).alias("fault")),
        map_entry=spark.sql(_ENTRY).select("scene", "map_file", "pos", "key", F.array_compact(F.array("val")).alias("values")),
        extrinsics=v.select("scene", "viewpoint", F.when(F.col("k") % 53 != 0, matrix).alias("matrix"), F.when(F.col("k") % 59 == 0, 3).otherwise(4).alias("n_rows")),
        image=image("place_image.png", _IMAGE_MODE, _WIDTH, _HEIGHT).unionByName(image("place_depth.png", _DEPTH_MODE, _DEPTH_WIDTH, _DEPTH_HEIGHT)),
        depth=spark.sql(_DEPTHS),
        scale=v.select("scene", "viewpoint", F.expr(_RAW).alias("raw")),
        config=scene.select("scene", F.lit("start.png").alias("start_image"), F.lit("pano.png").alias("pano_image_name"), F.lit(12).alias("max_views")),
    )


_HERE = "'viewpoints/' || viewpoint"
_PACKAGE_SQL = f"""WITH o AS ({_VIEW}), scenes AS (SELECT DISTINCT c, scene FROM o), v AS (SELECT * FROM o WHERE c % 17 <> 0), s AS (SELECT * FROM scenes WHERE c % 17 <> 0),
f AS (SELECT scene, viewpoint, name, {_SIZE} AS size FROM v CROSS JOIN (VALUES {', '.join(f"({i}, '{n}')" for i, n in enumerate(_NAMES))}) n(i, name) WHERE {_THERE}),
e AS (SELECT * FROM ({_ENTRY}) x WHERE c % 17 <> 0),
r AS (SELECT *, row_number() OVER (PARTITION BY scene, map_file, name ORDER BY pos, j) AS nth FROM (SELECT scene, map_file, pos, 0 AS j, key AS name FROM e UNION ALL SELECT scene, map_file, pos, 1, val FROM e WHERE val IS NOT NULL) q),
m AS (SELECT * FROM v WHERE (scene, viewpoint) IN (SELECT (scene, name) FROM r)),
st AS (SELECT m.*, n.name, f.size, 'viewpoints/' || m.viewpoint || '/' || n.name AS file_path FROM m CROSS JOIN (VALUES {', '.join(f"('{n}')" for n in package.REQUIRED)}) n(name) LEFT JOIN f ON f.scene = m.scene AND f.viewpoint = m.viewpoint AND f.name = n.name),
p AS (SELECT * FROM st WHERE size > 0),
x AS (SELECT *, {_A} AS a, {_B} AS b, {_C} AS cc, k % 90 AS t, (k % 11) * 0.5 AS h FROM p WHERE name = 'extrinsics.txt' AND k % 53 <> 0),
xc AS (SELECT *, CASE WHEN k % 59 = 0 THEN ['INVALID_MATRIX_SHAPE'] WHEN b = 0 AND cc = 2 THEN ['MATRIX_NOT_INVERTIBLE', 'MATRIX_LAST_ROW_INVALID'] WHEN b = 0 THEN ['MATRIX_NOT_INVERTIBLE'] WHEN cc = 2 AND a = -1 THEN ['MATRIX_LAST_ROW_INVALID']
  WHEN cc = 2 THEN ['MATRIX_LAST_ROW_INVALID', 'MATRIX_NOT_RIGHT_HANDED'] WHEN a = 1 THEN ['MATRIX_NOT_RIGHT_HANDED'] ELSE list_filter([CASE WHEN h NOT BETWEEN 0.5 AND 3.0 THEN 'CAMERA_HEIGHT_OUTLIER' END, CASE WHEN sqrt(t * t + h * h) > 50 THEN 'CAMERA_POSITION_OUTLIER' END], lambda q: q IS NOT NULL) END AS codes FROM x),
ic AS (SELECT *, {_IMAGE_MODE} AS mode, {_WIDTH} AS w, {_HEIGHT} AS h FROM p WHERE name = 'place_image.png'), ig AS (SELECT * FROM ic WHERE mode IS NOT NULL),
dg AS (SELECT *, {_DEPTH_MODE} AS mode, {_DEPTH_WIDTH} AS w, {_DEPTH_HEIGHT} AS h FROM p WHERE name = 'place_depth.png'),
px AS (SELECT p.scene, p.viewpoint, p.file_path, unnest(list_resize([d.v], d.n, d.v)) AS v FROM p JOIN ({_DEPTHS}) d ON d.scene = p.scene AND d.viewpoint = p.viewpoint WHERE name = 'place_depth.png'),
ds AS (SELECT scene, viewpoint, file_path, avg(CASE WHEN v = 0 THEN 1.0 ELSE 0.0 END) AS zeros, max(v) FILTER (v > 0) AS largest, median(v) FILTER (v > 0) AS med, avg(CASE WHEN v >= 65535 THEN 1.0 WHEN v > 0 THEN 0.0 END) AS full_ FROM px GROUP BY 1, 2, 3),
sc AS (SELECT *, {_RAW} AS raw, TRY_CAST(trim({_RAW}) AS DOUBLE) AS val FROM p WHERE name = 'place_depth_scale.txt'),
sr AS (SELECT sc.*, ds.largest / val AS most, ds.med / val AS middle, full_, ds.file_path AS depth_at FROM sc JOIN ds USING (scene, viewpoint) WHERE (val > 0 OR raw IS NULL) AND largest IS NOT NULL),
n AS (SELECT scene, map_file, count(DISTINCT key) + count(val) AS nodes FROM e GROUP BY 1, 2),
found AS (SELECT scene, 'MISSING_VIEWPOINTS_DIR' AS code, 'viewpoints' AS path FROM scenes WHERE c % 17 = 0
UNION ALL SELECT scene, 'INVALID_FILENAME', {_HERE} FROM v WHERE viewpoint LIKE '%.'
UNION ALL SELECT scene, 'INVALID_FILENAME', {_HERE} || '/' || name FROM f WHERE name = 'aux.txt'
UNION ALL SELECT scene, 'NO_MAP_FILE', '.' FROM s WHERE NOT ({_MAPPED})
UNION ALL SELECT scene, 'MAP_JSON_INVALID', 'map_1.json' FROM s WHERE {_MAPPED} AND c % 11 = 0
UNION ALL SELECT scene, 'EMPTY_MAP_VALUES', map_file FROM e WHERE pos = 0 AND val IS NULL
UNION ALL SELECT scene, 'DUPLICATE_VIEWPOINT_IN_MAP', map_file FROM r WHERE nth > 1
UNION ALL SELECT scene, 'MAP_REFERENCES_UNKNOWN_VIEWPOINT', map_file FROM r WHERE (scene, name) NOT IN (SELECT (scene, viewpoint) FROM v)
UNION ALL SELECT scene, 'VIEWPOINT_NOT_IN_MAP', {_HERE} FROM v WHERE (scene, viewpoint) NOT IN (SELECT (scene, viewpoint) FROM m)
UNION ALL SELECT scene, CASE WHEN size IS NULL THEN 'MISSING_REQUIRED_FILE' ELSE 'EMPTY_FILE' END, file_path FROM st WHERE size IS NULL OR size = 0
UNION ALL SELECT scene, 'MATRIX_PARSE_ERROR', file_path FROM p WHERE name = 'extrinsics.txt' AND k % 53 = 0
UNION ALL SELECT scene, unnest(codes), file_path FROM xc
UNION ALL SELECT scene, 'IMAGE_UNREADABLE', file_path FROM ic WHERE mode IS NULL
UNION ALL SELECT scene, 'INVALID_IMAGE_MODE', file_path FROM ig WHERE mode <> 'RGB' UNION ALL SELECT scene, 'INVALID_IMAGE_MODE', file_path FROM dg WHERE mode = 'L'
UNION ALL SELECT scene, 'INVALID_ASPECT_RATIO', file_path FROM (SELECT * FROM ig UNION ALL SELECT * FROM dg) i WHERE w <> 2 * h
UNION ALL SELECT scene, 'ODD_DIMENSIONS', file_path FROM (SELECT * FROM ig UNION ALL SELECT * FROM dg) i WHERE w % 2 = 1 OR h % 2 = 1
UNION ALL SELECT dg.scene, 'DEPTH_RGB_DIMENSION_MISMATCH', dg.file_path FROM dg JOIN ig USING (scene, viewpoint) WHERE dg.w <> ig.w OR dg.h <> ig.h
UNION ALL SELECT scene, 'DEPTH_MOSTLY_INVALID', file_path FROM ds WHERE zeros > 0.5
UNION ALL SELECT scene, 'INVALID_DEPTH_SCALE', file_path FROM sc WHERE NOT coalesce(val > 0, false)
UNION ALL SELECT scene, 'DEPTH_RANGE_IMPLAUSIBLE', file_path FROM sr WHERE NOT coalesce(most > 0.05 AND most < 50 AND middle > 0.1 AND middle < 30, false)
UNION ALL SELECT scene, 'DEPTH_SCALE_SATURATED', depth_at FROM sr WHERE full_ > 0.01
UNION ALL SELECT l.scene, 'VIEWPOINTS_TOO_CLOSE', 'viewpoints/' || l.viewpoint FROM x l JOIN x q ON l.scene = q.scene AND l.viewpoint < q.viewpoint WHERE l.k % 59 <> 0 AND q.k % 59 <> 0 AND sqrt((l.t - q.t) ** 2 + (l.h - q.h) ** 2) < 0.2
UNION ALL SELECT scene, 'START_IMAGE_MISSING', 'viewpoints/' || key || '/start.png' FROM e WHERE pos = 0 AND (scene, key) NOT IN (SELECT (scene, viewpoint) FROM f WHERE name = 'start.png')
UNION ALL SELECT scene, 'VIEWPOINT_BUDGET_EXCEEDED', map_file FROM n WHERE nodes > 12
UNION ALL SELECT f.scene, 'PANO_NAME_COLLISION', 'viewpoints/' || f.viewpoint || '/pano.png' FROM f JOIN m USING (scene, viewpoint) WHERE f.name = 'pano.png'
UNION ALL SELECT scene, 'VRAM_BUDGET_WARNING', '.' FROM (SELECT scene FROM ig GROUP BY 1 HAVING max(w) >= 2048) a JOIN (SELECT scene FROM n GROUP BY 1 HAVING max(nodes) >= 12) b USING (scene)),
d AS (SELECT *, CASE WHEN code IN ({', '.join(f"'{c}'" for c in package.WARNINGS)}) THEN 'warn' ELSE 'error' END AS severity FROM found)
"""


@query(_PACKAGE_SQL + "SELECT scene, code, severity, path, count(*) AS n FROM d GROUP BY ALL")
def package_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything that is wrong with the packages."""
    return package.validate(_scenes(spark, sf_dir)).groupBy("scene", "code", "severity", "path").agg(F.count("*").alias("n"))


@query(_PACKAGE_SQL + """SELECT scene, count(code) FILTER (severity = 'error') AS errors, count(code) FILTER (severity = 'warn') AS warnings, count(code) FILTER (severity = 'error') = 0 AS ok FROM scenes LEFT JOIN d USING (scene) GROUP BY 1""")
def package_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of errors and warnings, and whether a package is sound."""
    s = _scenes(spark, sf_dir)
    return package.summary(s, package.validate(s))


# Rooms of four kinds (flat, crossed with and without an area, sound), each with a
# wall on its lower side and a door in it.
_TOPOLOGY = f"SELECT plan_id, idx, x0, y0, x0 + w AS x1, y0 + h AS y1, CASE WHEN idx % 8 = 0 THEN 30 ELSE w END AS len FROM ({pj.RECTS}) r"


@query(f"""WITH t AS ({_TOPOLOGY}), o AS (SELECT *, 'o' || CAST(idx - idx % 2 AS VARCHAR) AS ref, idx % 6 AS kind FROM t),
f AS (SELECT plan_id, 'GEOM_OPEN_POLYGON' AS code, 3 AS tier, 'r' || idx AS source_ref, 'room polygon has fewer than three distinct vertices' AS message FROM t WHERE idx % 5 = 0
UNION ALL SELECT plan_id, 'GEOM_SELF_INTERSECTING_POLYGON', 3, 'r' || idx, CASE idx % 5 WHEN 1 THEN 'room polygon has zero area' ELSE 'room polygon self-intersects' END FROM t WHERE idx % 5 IN (1, 2)
UNION ALL SELECT plan_id, 'GEOM_DEGENERATE_WALL', 3, 'w' || idx, 'wall is shorter than the minimum length' FROM t WHERE len < 50
UNION ALL SELECT plan_id, 'GEOM_OPENING_UNRESOLVED_WALL', 3, ref, 'opening references an unknown wall' FROM o WHERE kind = 0
UNION ALL SELECT plan_id, 'GEOM_OPENING_OFF_WALL', 3, ref, 'opening centre is off its host wall' FROM o WHERE kind = 1
UNION ALL SELECT plan_id, 'GEOM_OPENING_WIDTH_EXCEEDS_WALL', 3, ref, 'opening span does not fit within its host wall' FROM o WHERE kind <> 0 AND (kind = 2 OR len < 900)
UNION ALL SELECT plan_id, 'GEOM_OPENING_ABOVE_WALL', 3, ref, 'opening rises above the host wall' FROM o WHERE kind = 3
UNION ALL SELECT plan_id, 'GEOM_DUPLICATE_ENTITY', 2, ref, 'derived geometry opening id collision' FROM o GROUP BY plan_id, ref HAVING count(*) > 1)
SELECT plan_id, code, 'error' AS severity, tier, source_ref, message FROM f""")
def topology_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Defects of white models; borders that are open have
    queries of their own (vertex_anti, edge_support_anti)."""
    pj.tables(spark, sf_dir, "orders")
    t = spark.sql(_TOPOLOGY)
    x0, y0, x1, y1, k = F.col("x0") / 1000, F.col("y0") / 1000, F.col("x1") / 1000, F.col("y1") / 1000, F.col("idx")
    name = lambda letter, i: F.concat(F.lit(letter), i.cast("string"))
    ring = (
        F.when(k % 5 == 0, F.array(g.point(x0, y0), g.point(x1, y0), g.point(x1, y0), g.point(x0, y0)))
        .when(k % 5 == 1, F.array(g.point(x0, y0), g.point(x1, y1), g.point(x1, y0), g.point(x0, y1)))
        .when(k % 5 == 2, F.array(g.point(x0, y0), g.point(x1, y1), g.point(x1, y0), g.point(x0, y1 + 0.5)))
        .otherwise(F.array(g.point(x0, y0), g.point(x1, y0), g.point(x1, y1), g.point(x0, y1)))
    )
    span = F.col("len") / 1000
    wall = t.select("plan_id", name("w", k).alias("id"), g.point(x0, y0).alias("start"), g.point(x0 + span, y0).alias("end"), F.lit(2.6).alias("height_m"))
    room = t.select("plan_id", name("r", k).alias("id"), ring.alias("polygon"))
    kind = k % 6
    opening = t.select(
        "plan_id",
        name("o", k - k % 2).alias("id"),
        F.lit("door").alias("type"),
        F.when(kind == 0, "none").otherwise(name("w", k)).alias("wall_id"),
        g.point(x0 + span / 2, y0 + F.when(kind == 1, 0.03).otherwise(0.0)).alias("center"),
        F.when(kind == 2, 9.0).otherwise(0.9).alias("width_m"),
        F.lit(2.1).alias("height_m"),
        F.when(kind == 3, 1.0).otherwise(0.0).alias("sill_m"),
    )
    return comp.validate_topology(comp.Model(wall, room, opening)).where("code <> 'GEOM_OPEN_ROOM_BOUNDARY'")


_RUN = """SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'DRAFT' WHEN 1 THEN 'CHECKED' WHEN 2 THEN 'APPROVED' ELSE 'DONE' END AS state, CASE event_id % 5 WHEN 0 THEN 'CHECKED' WHEN 1 THEN 'APPROVED' WHEN 2 THEN 'DONE' WHEN 3 THEN 'BLOCKED' ELSE 'CANCELLED' END AS target,
user_id % 3 AS held, user_id % 7 = 0 AS failed, user_id % 2 = 0 AS approved FROM events"""
_MACHINE = {
    "states": ["DRAFT", "CHECKED", "APPROVED", "DONE", "BLOCKED", "CANCELLED"],
    "terminal_states": ["DONE", "CANCELLED"],
    "gates": {"g1": {"name": "check", "human": False}, "g2": {"name": "approve", "human": True}},
    "transitions": [
        {"from": "DRAFT", "to": "CHECKED", "gate": "g1", "required_artifacts": ["a"], "on_fail": "BLOCKED"},
        {"from": "CHECKED", "to": "APPROVED", "gate": "g2", "required_artifacts": ["a", "b"], "on_fail": "DRAFT"},
        {"from": "APPROVED", "to": "DONE"},
    ],
    "rework_policy": {"default_targets_by_reason_prefix": {"CLICK": "DRAFT", "CLICK_1": "CHECKED", "CLICK_17": "APPROVED", "VIEW_": "CHECKED", "ERR": "DRAFT"}},
}


@query(f"""WITH r AS ({_RUN}), q AS (SELECT *, CASE WHEN state = 'DONE' THEN 'TERMINAL' WHEN target IN ('BLOCKED', 'CANCELLED') THEN NULL
WHEN state = 'DRAFT' AND target = 'CHECKED' THEN CASE WHEN failed THEN 'FAILED' WHEN held < 1 THEN 'MISSING_ARTIFACT' END
WHEN state = 'CHECKED' AND target = 'APPROVED' THEN CASE WHEN failed THEN 'FAILED' WHEN held < 2 THEN 'MISSING_ARTIFACT' WHEN NOT approved THEN 'NOT_APPROVED' END
WHEN state = 'APPROVED' AND target = 'DONE' THEN CASE WHEN failed THEN 'FAILED' END ELSE 'NO_TRANSITION' END AS reason FROM r)
SELECT event_id AS run, state, target, CASE WHEN reason IS NULL THEN target WHEN reason <> 'FAILED' THEN state WHEN state = 'DRAFT' THEN 'BLOCKED' WHEN state = 'CHECKED' THEN 'DRAFT' END AS next_state, reason FROM q""")
def run_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each event leads a run, and why not to its target."""
    pj.tables(spark, sf_dir, "events")
    e = spark.sql(_RUN).select(F.col("event_id").alias("run"), "state", "target", F.slice(F.array(F.lit("a"), F.lit("b")), F.lit(1), F.col("held").cast("int")).alias("artifacts"), "failed", "approved")
    return lifecycle.next_states(e, lifecycle.machine(spark, _MACHINE))


_REASON = "SELECT DISTINCT upper(event_type) || '_' || CAST(event_id % 40 AS STRING) AS code FROM events"


@query(f"SELECT code, CASE WHEN code LIKE 'CLICK\\_17%' ESCAPE '\\' THEN 'APPROVED' WHEN code LIKE 'CLICK\\_1%' ESCAPE '\\' THEN 'CHECKED' WHEN code LIKE 'CLICK%' OR code LIKE 'ERR%' THEN 'DRAFT' WHEN code LIKE 'VIEW\\_%' ESCAPE '\\' THEN 'CHECKED' END AS target FROM ({_REASON}) r")
def rework_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2: the state that a reason sends a run back to."""
    pj.tables(spark, sf_dir, "events")
    return lifecycle.rework_targets(spark.sql(_REASON), lifecycle.machine(spark, _MACHINE))


@query("""WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS content_hash FROM documents)
SELECT doc_id AS artifact_id, content_hash, content_hash IN (SELECT content_hash FROM d WHERE doc_id % 3 = 0) AS approved FROM d""")
def approval_binding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Artifacts that are approved as they are now, by their hash."""
    pj.tables(spark, sf_dir, "documents")
    d = spark.table("documents").select(F.col("doc_id").alias("artifact_id"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("content_hash"))
    records = d.select(F.lit("g2").alias("gate_id"), F.when(F.col("artifact_id") % 3 == 0, "approve").otherwise("reject").alias("decision"), F.col("content_hash").alias("target_content_hash"))
    return lifecycle.approvals(d, records)


_REVIEW = "SELECT user_id AS chain_id, event_id AS ord, 'r' || CAST(event_id % 400 AS STRING) AS review_id, CASE event_id % 4 WHEN 0 THEN NULL ELSE 'r' || CAST((event_id + event_id % 3 * 7) % 400 AS STRING) END AS parent_id FROM events"


@query(f"""WITH r AS ({_REVIEW}), n AS (SELECT *, row_number() OVER (PARTITION BY chain_id, review_id ORDER BY ord) AS nth FROM r)
SELECT chain_id, ord, review_id, 'REVIEW_LINEAGE_CYCLE' AS code FROM n WHERE nth > 1 OR (parent_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM r p WHERE p.chain_id = n.chain_id AND p.review_id = n.parent_id AND p.ord < n.ord))""")
def review_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L4: reviews that reuse an id or whose parent isn't earlier."""
    pj.tables(spark, sf_dir, "events")
    return lifecycle.review_faults(spark.sql(_REVIEW))


_SCHEMA = {
    "$id": "urn:t",
    "type": "object",
    "required": ["a", "b"],
    "additionalProperties": False,
    "properties": {"schema_id": {"const": "t"}, "schema_version": {"type": "string", "pattern": r"^\d+\.\d+\.\d+$"}, "a": {"type": "integer", "minimum": 0, "maximum": 100}, "b": {"$ref": "urn:colour#/$defs/one"}},
}
_COLOURS = {"$id": "urn:colour", "$defs": {"one": {"enum": ["red", "green"]}}}
_DOCUMENT = """SELECT event_id AS doc, CASE WHEN event_id % 11 = 0 THEN 'not json' ELSE '{"schema_id":"t","schema_version":"' || CASE WHEN event_id % 13 = 0 THEN '9.0.0' ELSE '1.0.0' END || '","a":' || CASE event_id % 5 WHEN 0 THEN '"x"' WHEN 1 THEN '-1' WHEN 2 THEN '101' WHEN 3 THEN '1.5' ELSE '7' END
|| CASE event_id % 3 WHEN 0 THEN ',"b":"red"' WHEN 1 THEN ',"b":"blue"' ELSE '' END || CASE WHEN event_id % 7 = 0 THEN ',"z":1' ELSE '' END || '}' END AS json FROM events"""


@query("""SELECT event_id AS doc, CASE WHEN event_id % 11 = 0 THEN '$ json' WHEN event_id % 13 = 0 THEN '$ unknown schema' ELSE array_to_string(list_filter([CASE WHEN event_id % 7 = 0 THEN '$ additionalProperties' END, CASE WHEN event_id % 3 = 2 THEN '$ required' END,
CASE event_id % 5 WHEN 0 THEN '$.a type' WHEN 1 THEN '$.a minimum' WHEN 2 THEN '$.a maximum' WHEN 3 THEN '$.a type' END, CASE WHEN event_id % 3 = 1 THEN '$.b enum' END], lambda q: q IS NOT NULL), ',') END AS errors FROM events""")
def schema_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All errors of documents under their schemas, by path."""
    pj.tables(spark, sf_dir, "events")
    out = contracts.validate_documents(spark.sql(_DOCUMENT), {("t", "1.0.0"): _SCHEMA, ("colour", "1.0.0"): _COLOURS})
    return out.select("doc", F.array_join(F.transform("errors", lambda e: F.concat_ws(" ", e["path"], e["keyword"])), ",").alias("errors"))


_CATALOG_FILE = """SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'room' WHEN 1 THEN 'wall_run' ELSE 'door' END AS schema_id, CAST(1 + p_size % 3 AS STRING) || '.' || CAST(p_partkey % 12 AS STRING) || '.' || CASE WHEN p_partkey % 17 = 0 THEN '0' ELSE CAST(p_partkey AS STRING) END AS schema_version,
CAST(1 + p_size % 3 + CASE WHEN p_partkey % 13 = 0 THEN 1 ELSE 0 END AS STRING) AS folder, 'urn:' || CAST(p_partkey - CASE WHEN p_partkey % 19 = 0 THEN 1 ELSE 0 END AS STRING) AS doc_id FROM part"""
_CATALOG_PATH = "schema_id || '/v' || folder || '/' || schema_id || '-' || schema_version || '.schema.json'"


@query(f"""WITH c AS (SELECT *, {_CATALOG_PATH} AS path FROM ({_CATALOG_FILE}) f), v AS (SELECT schema_id, schema_version FROM c GROUP BY 1, 2 HAVING count(*) > 1), i AS (SELECT doc_id FROM c GROUP BY 1 HAVING count(*) > 1)
SELECT path, CASE WHEN p_partkey % 13 = 0 THEN 'NAME_MISMATCH' WHEN (schema_id, schema_version) IN (SELECT (schema_id, schema_version) FROM v) THEN 'DUPLICATE_VERSION' ELSE 'DUPLICATE_ID' END AS fault FROM c
WHERE p_partkey % 13 = 0 OR (schema_id, schema_version) IN (SELECT (schema_id, schema_version) FROM v) OR doc_id IN (SELECT doc_id FROM i)""")
def catalog_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema files whose names lie, and versions and ids that occur twice."""
    pj.tables(spark, sf_dir, "part")
    c = spark.sql(f"SELECT {_CATALOG_PATH} AS path, schema_id, schema_version, doc_id FROM ({_CATALOG_FILE}) f")
    return contracts.catalog_faults(c)


@query("""WITH f AS (SELECT o_custkey, 'd/' || o_orderkey || '.png' AS path, o_orderkey % 1000 AS size, sha256(coalesce(o_orderpriority, '')) AS sha FROM orders)
SELECT o_custkey, 'sha256:' || sha256('[' || string_agg('{"path":"' || path || '","sha256":"' || sha || '","size":' || size || '}', ',' ORDER BY path) || ']') AS tree_hash FROM f GROUP BY 1""")
def tree_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One hash of each package's files, by sorted path."""
    pj.tables(spark, sf_dir, "orders")
    f = spark.table("orders").select("o_custkey", F.concat(F.lit("d/"), F.col("o_orderkey").cast("string"), F.lit(".png")).alias("path"), (F.col("o_orderkey") % 1000).alias("size"), F.sha2(F.coalesce("o_orderpriority", F.lit("")), 256).alias("sha256"))
    return contracts.tree_hashes(f, "o_custkey")


@query("""SELECT event_id, 'sha256:' || sha256('{"a":' || event_id || ',"k":' || user_id || ',"é":[true,null,"x"]}') AS content_hash FROM events""")
def canonical_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hash doesn't depend on the order of keys or on blanks, nor on the
    hash that a document states."""
    pj.tables(spark, sf_dir, "events")
    text = F.concat(F.lit('{ "é" : [true, null, "x"], "content_hash": "old", "k": '), F.col("user_id").cast("string"), F.lit(',\n"a":'), F.col("event_id").cast("string"), F.lit("}"))
    return spark.table("events").select("event_id", content_hash(text).alias("content_hash"))


_PATHS = "CASE page_id % 8 WHEN 0 THEN 'a/b.png' WHEN 1 THEN '/a' WHEN 2 THEN 'a/../b' WHEN 3 THEN 'a//b' WHEN 4 THEN 'c:x' WHEN 5 THEN './a' WHEN 6 THEN '' ELSE url END"
_RUN_NAME = "CASE page_id % 5 WHEN 0 THEN 'run-' || CAST(page_id AS STRING) WHEN 1 THEN '.hidden' WHEN 2 THEN '' WHEN 3 THEN repeat('a', CAST(100 + page_id % 50 AS INT)) ELSE url END"


@query(f"""WITH p AS (SELECT page_id, {_PATHS} AS p, {_RUN_NAME} AS r FROM pages)
SELECT page_id, coalesce(p <> '' AND NOT contains(p, ':') AND NOT contains(p, chr(92)) AND NOT list_has_any(string_split(p, '/'), ['', '.', '..']), false) AS path_safe,
coalesce(len(r) BETWEEN 1 AND 128 AND length(translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._-', '')) = 0 AND NOT contains('._-', r[1]), false) AS run_valid FROM p""")
def path_and_run_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths that stay inside, and names of runs."""
    pj.tables(spark, sf_dir, "pages")
    return spark.table("pages").select("page_id", contracts.safe_path(F.expr(_PATHS)).alias("path_safe"), contracts.valid_run_id(F.expr(_RUN_NAME)).alias("run_valid"))


_RECOGNISED = """SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'cad_exact' WHEN 1 THEN 'raster_auto' WHEN 2 THEN 'annotation' WHEN 3 THEN 'dxf' WHEN 4 THEN 'manual' END AS source_class, CASE p_size % 7 WHEN 0 THEN 'segment' WHEN 1 THEN 'circular_arc' WHEN 2 THEN 'passage' WHEN 3 THEN 'door' WHEN 4 THEN 'window' WHEN 5 THEN 'circular_arc' ELSE 'diagonal_3_4_5' END AS kind,
CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN -0.5 ELSE 0.25 END AS sagitta, CAST(p_partkey % 3 - 1 AS DOUBLE) AS bulge, CASE p_partkey % 5 WHEN 0 THEN 'ccw' WHEN 1 THEN 'cw' WHEN 2 THEN 'none' END AS sweep, CASE p_partkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 0.0 ELSE 0.1 END AS thickness, p_partkey % 17 * 0.25 AS width FROM part"""


@query(f"""SELECT p_partkey, array_to_string(list_filter([CASE WHEN source_class IS NULL OR source_class = 'manual' THEN 'RECOGNITION_SOURCE_CLASS_INVALID' END, CASE WHEN kind = 'circular_arc' AND (sagitta IS NULL OR sagitta < 0) THEN 'RECOGNITION_ARC_NO_SAGITTA_BOUND' END,
CASE WHEN kind = 'circular_arc' AND ((bulge > 0 AND sweep = 'cw') OR (bulge < 0 AND sweep = 'ccw')) THEN 'RECOGNITION_ARC_BULGE_SWEEP_MISMATCH' END, CASE WHEN kind IN ('segment', 'circular_arc') AND source_class IN ('cad_exact', 'raster_auto') AND coalesce(thickness, 0) <= 0 THEN 'RECOGNITION_THICKNESS_MISSING' END,
CASE WHEN kind = 'passage' AND width > 3 THEN 'RECOGNITION_PASSAGE_SPAN_EXCEEDS_BOUND' END, CASE WHEN kind IN ('door', 'window') AND width > 1.5 THEN 'RECOGNITION_OPENING_SPAN_EXCEEDS_BOUND' END], lambda q: q IS NOT NULL), ',') AS codes,
CASE WHEN kind IN ('segment', 'diagonal_3_4_5') THEN true WHEN kind = 'circular_arc' THEN coalesce(sagitta >= 0, false) WHEN kind = 'passage' THEN width <= 3 ELSE width <= 1.5 END AS supported FROM ({_RECOGNISED}) r""")
def recognition_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What blocks a recognised wall or opening, and whether its kind is
    among the supported."""
    pj.tables(spark, sf_dir, "part")
    c = {k: F.col(k) for k in ("source_class", "sagitta", "bulge", "sweep", "thickness", "kind", "width")}
    codes = lifecycle.recognition_codes(*c.values())
    return spark.sql(_RECOGNISED).select("p_partkey", F.array_join(codes, ",").alias("codes"), evaluator.supported(c["kind"], c["sagitta"], c["width"] * 1000.0).alias("supported"))


_INVENTORY = """SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'png' WHEN 1 THEN 'jpg' WHEN 2 THEN 'pdf' WHEN 3 THEN 'dxf' ELSE 'dwg' END AS kind, CASE p_partkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 0.0 ELSE 0.01 END AS m_per_px, CASE p_partkey % 4 WHEN 0 THEN 'mm' WHEN 1 THEN 'm' WHEN 2 THEN 'inch' END AS units FROM part"""


@query(f"""WITH k AS (SELECT p_partkey, CASE WHEN kind IN ('dxf', 'dwg') THEN coalesce(units IN ('mm', 'm'), false) ELSE coalesce(m_per_px > 0, false) END AS known FROM ({_INVENTORY}) i)
SELECT p_partkey AS project, known AS scale_known, CASE WHEN known THEN 'complete' ELSE 'partial' END AS status, CASE WHEN NOT known THEN 'INPUT_SCALE_UNKNOWN' END AS blocker FROM k""")
def scale_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Projects whose scale is known; others are blocked."""
    pj.tables(spark, sf_dir, "part")
    return contracts.quality(spark, spark.sql(_INVENTORY).withColumnRenamed("p_partkey", "project"))


@query("""WITH r AS (SELECT c_custkey AS project, CASE WHEN c_custkey % 9 = 0 THEN '-x' ELSE 'run' END AS run_id FROM customer),
d AS (SELECT o_custkey AS project, CASE WHEN o_orderkey % 23 = 0 THEN '../x' WHEN o_orderkey % 12 = 0 THEN 'same' ELSE 'f' || o_orderkey END AS path, o_orderkey AS k, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders)
SELECT project, 'RUN_ID' AS fault FROM r WHERE run_id = '-x' UNION ALL SELECT DISTINCT project, 'UNSAFE_PATH' FROM d WHERE path = '../x'
UNION ALL SELECT DISTINCT project, 'DUPLICATE_PATH' FROM (SELECT project FROM d GROUP BY project, path HAVING count(*) > 1) q
UNION ALL SELECT DISTINCT project, 'HASH_MISMATCH' FROM d WHERE k % 62 = 31 OR (k % 62 = 0 AND (project, path) NOT IN (SELECT (project, path) FROM d WHERE k % 62 <> 0))
UNION ALL SELECT project, 'FLOORPLAN_COUNT' FROM r LEFT JOIN d USING (project) GROUP BY project HAVING count(k) FILTER (n = 1 AND project % 7 <> 0 OR n = 2 AND project % 8 = 0) <> 1
UNION ALL SELECT project, 'QUALITY' FROM r WHERE project % 10 = 0""")
def preflight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What keeps a run from being parsed.  A file is missing if its
    order's key is a multiple of 62, and has another hash if it is another one of 31."""
    pj.tables(spark, sf_dir, "customer", "orders")
    runs = spark.sql("SELECT c_custkey AS project, CASE WHEN c_custkey % 9 = 0 THEN '-x' ELSE 'run' END AS run_id FROM customer")
    declared = spark.sql("""SELECT project, path, sha2(path, 256) AS sha256, k, CASE WHEN (n = 1 AND project % 7 <> 0) OR (n = 2 AND project % 8 = 0) THEN 'floorplan' ELSE 'style' END AS kind FROM (SELECT o_custkey AS project, o_orderkey AS k,
        CASE WHEN o_orderkey % 23 = 0 THEN '../x' WHEN o_orderkey % 12 = 0 THEN 'same' ELSE 'f' || CAST(o_orderkey AS STRING) END AS path, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders) q""")
    changed = F.when(F.col("k") % 31 == 0, "other").otherwise(F.col("sha256"))
    actual = declared.where("k % 62 <> 0").select("project", "path", changed.alias("sha256"))
    reports = runs.select("project", F.when(F.col("project") % 20 == 0, "partial").otherwise("complete").alias("status"), F.when(F.col("project") % 20 == 10, "INPUT_SCALE_UNKNOWN").alias("blocker"))
    return intake.preflight(runs, declared, actual, reports)


_POINTS = "SELECT user_id, (event_id * 7 % 101) * 0.5 AS x, (event_id * 13 % 97) * 0.25 + (event_id * 7 % 101) * 0.1 AS y FROM events"


@query(f"""WITH p AS (SELECT user_id, x::DOUBLE AS x, y::DOUBLE AS y FROM ({_POINTS}) e), m AS (SELECT user_id, avg(x) AS mx, avg(y) AS my, atan2(2 * covar_pop(x, y), var_pop(x) - var_pop(y)) / 2 AS w FROM p GROUP BY 1)
SELECT user_id, round(max((x - mx) * cos(w) + (y - my) * sin(w)) - min((x - mx) * cos(w) + (y - my) * sin(w)) + 1, 6) AS extent FROM p JOIN m USING (user_id) GROUP BY 1""")
def principal_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extents along the principal axis."""
    pj.tables(spark, sf_dir, "events")
    p = spark.sql(_POINTS).select("user_id", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    return evaluator.principal_extent(p, "user_id").select("user_id", F.round("extent", 6).alias("extent"))


@query("""SELECT user_id, (user_id % 50) * 0.5::DOUBLE AS cx, (user_id % 30) * 0.25::DOUBLE AS cy, 2.0 + user_id % 9::DOUBLE AS r, count(*) AS n FROM events GROUP BY user_id HAVING count(DISTINCT event_id % 12) > 2""")
def circle_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Circles found again from points that lie on them (three places at least)."""
    pj.tables(spark, sf_dir, "events")
    u, a, r = F.col("user_id"), F.col("event_id") % 12 * (3.141592653589793 / 6), F.lit(2.0) + F.col("user_id") % 9
    p = spark.table("events").select("user_id", "event_id", ((u % 50) * 0.5 + r * F.cos(a)).alias("x"), ((u % 30) * 0.25 + r * F.sin(a)).alias("y"))
    enough = p.groupBy("user_id").agg(F.countDistinct(F.col("event_id") % 12).alias("places")).where("places > 2").select("user_id")
    fit = evaluator.circle_fit(p.join(enough, "user_id", "left_semi"), "user_id")
    return fit.select("user_id", *((F.round(c, 6) + 0.0).alias(c) for c in ("cx", "cy", "r")), "n")


_COUNTED = "SELECT CAST(o_orderkey AS STRING) AS plan_id, o_orderkey % 5 AS walls, o_custkey % 4 AS rooms FROM orders"
_RECOVERED = "SELECT CAST(o_orderkey AS STRING) AS plan_id, o_custkey % 5 AS got_walls, o_orderkey % 4 AS got_rooms, CASE WHEN o_orderkey % 6 = 0 THEN 1 ELSE 0 END AS errors FROM orders WHERE o_orderkey % 11 <> 0"


@query(f"""SELECT count(*) AS plans, count(*) FILTER (got_walls = walls AND errors = 0) AS walls_converged, count(*) FILTER (got_rooms = rooms AND errors = 0) AS rooms_converged FROM ({_COUNTED}) t LEFT JOIN ({_RECOVERED}) g USING (plan_id)""")
def convergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plans whose counts were recovered; some were never answered."""
    pj.tables(spark, sf_dir, "orders")
    return evaluator.convergence(spark.sql(_COUNTED), spark.sql(_RECOVERED), "walls", "rooms")


_TYPED = f"SELECT plan_id, idx, CASE WHEN idx % 3 = 0 THEN 'window' ELSE 'door' END AS type, idx % 13 = 0 AS wrong FROM ({pj.RECTS}) r"


@query(f"""WITH t AS ({_TYPED}) SELECT plan_id, count(*) AS walls, count(*) FILTER (idx % 2 = 0) AS rooms, count(*) FILTER (type = 'door') AS doors, count(*) FILTER (type = 'window') AS windows, count(*) FILTER (wrong) AS errors, count(*) FILTER (NOT wrong AND idx % 17 = 0) AS warnings, count(*) FILTER (wrong) = 0 AS closed FROM t GROUP BY 1""")
def topology_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and checks of each white model."""
    pj.tables(spark, sf_dir, "orders")
    t = spark.sql(_TYPED)
    found = t.where("wrong or idx % 17 = 0").select("plan_id", F.when(F.col("wrong"), "error").otherwise("warn").alias("severity"))
    return comp.topology_report(comp.Model(t, t.where("idx % 2 = 0"), t), found)

