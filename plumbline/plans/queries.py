"""Queries of the engine's operators over the star-schema tables, with SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.functions import arcs, colour, geometry as g
from plumbline.functions.canonical import content_hash
from plumbline.functions.matrix import extrinsics_codes
from plumbline.functions.numeric import floor_grid, grid, key_text, short_number
from plumbline.operators import camera, compile as comp, contracts, evaluator, findings, lifecycle, normalize, package, parse_checks
from plumbline.plans import projections as pj
from plumbline.plans.stages import settled

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


# Grid points of walls as the oracle sees them: millimetres times ten, moved.
_GRID = f"""w AS ({pj.WALLS}),
e AS (SELECT plan_id, idx, f, CASE WHEN x1 < x2 OR (x1 = x2 AND y1 <= y2) THEN x1 ELSE x2 END AS ax, CASE WHEN x1 < x2 OR (x1 = x2 AND y1 <= y2) THEN y1 ELSE y2 END AS ay,
  CASE WHEN x1 < x2 OR (x1 = x2 AND y1 <= y2) THEN x2 ELSE x1 END AS bx, CASE WHEN x1 < x2 OR (x1 = x2 AND y1 <= y2) THEN y2 ELSE y1 END AS by_ FROM w),
t AS (SELECT plan_id, min(least(ax, bx)) AS tx, min(least(ay, by_)) AS ty FROM e GROUP BY plan_id),
n AS (SELECT plan_id, idx, f, (ax - tx) * 10 AS ax, (ay - ty) * 10 AS ay, (bx - tx) * 10 AS bx, (by_ - ty) * 10 AS by_, tx, ty FROM e JOIN t USING (plan_id))"""
_KEY = lambda c: f"CAST(CAST({c} * 0.0001 AS DECIMAL(20,4)) AS VARCHAR)"
_WALL_ID = "'w-' || substr(sha256('wall|' || " + " || '|' || ".join(_KEY(c) for c in ("ax", "ay", "bx", "by_")) + "), 1, 12)"


@query("""SELECT DISTINCT l_extendedprice AS raw, CAST(round_even(CAST(CAST(l_extendedprice AS VARCHAR) AS DECIMAL(22,13)) * CAST(0.001 AS DECIMAL(14,10)), 4) * 10000 AS BIGINT) AS grid_value,
CAST(CAST(round_even(CAST(CAST(l_extendedprice AS VARCHAR) AS DECIMAL(22,13)) * CAST(0.001 AS DECIMAL(14,10)), 4) AS DECIMAL(20,4)) AS VARCHAR) AS key_value FROM lineitem""")
def norm_quantize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinates on the grid, half to even."""
    pj.tables(spark, sf_dir, "lineitem")
    v = spark.table("lineitem").select(F.col("l_extendedprice").alias("raw")).distinct()
    return v.withColumn("grid_value", grid(F.col("raw"), F.lit(0.001))).withColumn("key_value", key_text(F.col("grid_value")))


@query(f"WITH {_GRID} SELECT plan_id, idx, {_WALL_ID} AS id, CAST(row_number() OVER (PARTITION BY plan_id ORDER BY ax, ay, bx, by_, idx) AS INT) AS ord FROM n")
def norm_wall_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered ends, anchor, content ids and order of walls."""
    return normalize.normalize(pj.wall_plans(spark, sf_dir)).wall.select("plan_id", "idx", "id", "ord")


@query(f"WITH {_GRID} SELECT DISTINCT plan_id, tx / 1000.0::DOUBLE AS tx, ty / 1000.0::DOUBLE AS ty FROM n")
def anchor_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The translation of every plan."""
    t = normalize.normalize(pj.wall_plans(spark, sf_dir)).normalization
    return t.select("plan_id", F.col("translation_m")[0].alias("tx"), F.col("translation_m")[1].alias("ty"))


_RECT_TEXT = "printf('%d,%d %d,%d %d,%d %d,%d', x0, y0, x0 + w, y0, x0 + w, y0 + h, x0, y0 + h)"


@query(f"SELECT plan_id, idx, {_RECT_TEXT} AS ring, 2 * w * h AS twice_area FROM ({pj.RECTS}) r")
def canonical_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rings turned and rotated to one form, with their area."""
    r = pj.rect_rings(spark, sf_dir)
    point = lambda p: F.struct(p["x"].cast("long").alias("x"), p["y"].cast("long").alias("y"))
    r = r.withColumn("turned", g.canonical_ring(F.transform("polygon", point)))
    text = F.array_join(F.transform("turned", lambda p: F.concat_ws(",", p["x"].cast("string"), p["y"].cast("string"))), " ")
    return r.select("plan_id", "idx", text.alias("ring"), g.twice_area(F.col("turned")).cast("long").alias("twice_area"))


@query(f"WITH {_GRID} SELECT plan_id, 'l' || idx AS source_ref FROM n WHERE (bx - ax) * (bx - ax) + (by_ - ay) * (by_ - ay) < 500 * 500")
def degenerate_walls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Walls that are too short."""
    wall = normalize.normalize(pj.wall_plans(spark, sf_dir)).wall
    return parse_checks.degenerate_walls(wall).select("plan_id", "source_ref")


@query(f"WITH {_GRID} SELECT plan_id, idx FROM (SELECT plan_id, idx, row_number() OVER (PARTITION BY plan_id, bx - ax, by_ - ay ORDER BY ax, ay, bx, by_, idx) AS k FROM n) WHERE k > 1")
def duplicate_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second and later walls of the same direction and length."""
    wall = normalize.normalize(pj.wall_plans(spark, sf_dir)).wall
    wall = wall.withColumn("dx", F.col("end_g.x") - F.col("start_g.x")).withColumn("dy", F.col("end_g.y") - F.col("start_g.y"))
    return parse_checks.duplicates(wall, "dx", "dy").select("plan_id", "idx")


_QUADS = """SELECT CAST(o_orderkey AS STRING) AS plan_id, CAST(o_orderkey % 13 AS BIGINT) AS ax, CAST(o_orderkey % 7 AS BIGINT) AS ay, CAST(o_custkey % 11 AS BIGINT) AS bx, CAST(o_custkey % 5 AS BIGINT) AS by_,
CAST((o_orderkey + o_custkey) % 17 AS BIGINT) AS cx, CAST((o_orderkey * 3 + o_custkey) % 9 AS BIGINT) AS cy, CAST((o_orderkey * 7) % 10 AS BIGINT) AS dx, CAST((o_custkey * 5) % 12 AS BIGINT) AS dy FROM orders"""
_X = lambda p: f"{p}x"
_Y = lambda p: "by_" if p == "b" else f"{p}y"
_T = lambda p, q, r: f"(({_X(q)} - {_X(p)}) * ({_Y(r)} - {_Y(p)}) - ({_Y(q)} - {_Y(p)}) * ({_X(r)} - {_X(p)}))"
_BOX = lambda p, q, r: f"({_X(r)} BETWEEN least({_X(p)}, {_X(q)}) AND greatest({_X(p)}, {_X(q)}) AND {_Y(r)} BETWEEN least({_Y(p)}, {_Y(q)}) AND greatest({_Y(p)}, {_Y(q)}))"


def _meet(p: str, q: str, r: str, s: str) -> str:
    o = [_T(p, q, r), _T(p, q, s), _T(r, s, p), _T(r, s, q)]
    pair = lambda v: f"row({_X(v)}, {_Y(v)})"
    overlap = f"greatest(least({pair(p)}, {pair(q)}), least({pair(r)}, {pair(s)})) < least(greatest({pair(p)}, {pair(q)}), greatest({pair(r)}, {pair(s)}))"
    touch = f"({o[0]} = 0 AND {_BOX(p, q, r)}) OR ({o[1]} = 0 AND {_BOX(p, q, s)}) OR ({o[2]} = 0 AND {_BOX(r, s, p)}) OR ({o[3]} = 0 AND {_BOX(r, s, q)})"
    cross = f"(({o[0]} > 0) <> ({o[1]} > 0) AND ({o[2]} > 0) <> ({o[3]} > 0))"
    return f"(CASE WHEN {o[0]} = 0 AND {o[1]} = 0 AND {o[2]} = 0 AND {o[3]} = 0 THEN {overlap} ELSE {touch} OR {cross} END)"


@query(f"""WITH q AS ({_QUADS}) SELECT plan_id, CASE
WHEN row(ax, ay) = row(bx, by_) OR row(bx, by_) = row(cx, cy) OR row(cx, cy) = row(dx, dy) THEN 'PARSE_OPEN_POLYGON'
WHEN row(ax, ay) = row(cx, cy) OR row(ax, ay) = row(dx, dy) OR row(bx, by_) = row(dx, dy) THEN 'PARSE_SELF_INTERSECTING_POLYGON'
WHEN ax * by_ - bx * ay + bx * cy - cx * by_ + cx * dy - dx * cy + dx * ay - ax * dy = 0 THEN 'PARSE_SELF_INTERSECTING_POLYGON'
WHEN {_meet('a', 'b', 'c', 'd')} OR {_meet('b', 'c', 'd', 'a')} THEN 'PARSE_SELF_INTERSECTING_POLYGON' END AS code FROM q""")
def polygon_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact predicates on quadrilaterals."""
    pj.tables(spark, sf_dir, "orders")
    p = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    q = spark.sql(_QUADS).withColumn("ring_g", F.array(p("ax", "ay"), p("bx", "by_"), p("cx", "cy"), p("dx", "dy")))
    return parse_checks.ring_faults(q).select("plan_id", F.col("fault.code").alias("code"))


@query(f"""WITH {_GRID}, o AS (SELECT plan_id, idx, (ax + bx) AS cx2, (ay + by_) AS cy2 FROM n WHERE f = 'R'),
c AS (SELECT o.plan_id, o.idx, count(*) FILTER (WHERE len > 0 AND abs((cx - w.ax / 10000.0) * uy - (cy - w.ay / 10000.0) * ux) <= 0.02
   AND ((cx - w.ax / 10000.0) * ux + (cy - w.ay / 10000.0) * uy) BETWEEN -0.0001 AND len + 0.0001) AS n_walls FROM (SELECT plan_id, idx, cx2 / 20000.0 AS cx, cy2 / 20000.0 AS cy FROM o) o
  JOIN (SELECT *, sqrt((bx - ax) * (bx - ax) + (by_ - ay) * (by_ - ay)) / 10000.0 AS len, (bx - ax) / 10000.0 / nullif(sqrt((bx - ax) * (bx - ax) + (by_ - ay) * (by_ - ay)) / 10000.0, 0) AS ux,
    (by_ - ay) / 10000.0 / nullif(sqrt((bx - ax) * (bx - ax) + (by_ - ay) * (by_ - ay)) / 10000.0, 0) AS uy FROM n) w ON w.plan_id = o.plan_id GROUP BY o.plan_id, o.idx)
SELECT plan_id, idx, n_walls, CASE WHEN n_walls = 0 THEN 'UNKNOWN' WHEN n_walls > 1 THEN 'AMBIGUOUS' ELSE 'RESOLVED' END AS outcome FROM c""")
def opening_wall_exactly_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Openings that resolve to exactly one wall."""
    o = normalize.normalize(pj.wall_plans(spark, sf_dir, openings=True)).opening
    outcome = F.when(F.col("n_walls") == 0, "UNKNOWN").when(F.col("n_walls") > 1, "AMBIGUOUS").otherwise("RESOLVED")
    return o.select("plan_id", "idx", "n_walls", outcome.alias("outcome"))


@query(f"""WITH r AS (SELECT *, x0 + w AS x1, y0 + h AS y1 FROM ({pj.RECTS}) q),
e AS (SELECT plan_id, idx, x0 AS ax, y0 AS ay, x1 AS bx, y0 AS by_ FROM r UNION ALL SELECT plan_id, idx, x1, y0, x1, y1 FROM r UNION ALL SELECT plan_id, idx, x1, y1, x0, y1 FROM r UNION ALL SELECT plan_id, idx, x0, y1, x0, y0 FROM r),
p AS (SELECT l.plan_id, l.idx AS i, m.idx AS j FROM r l JOIN r m ON l.plan_id = m.plan_id AND l.idx < m.idx AND NOT (l.x0 = m.x0 AND l.y0 = m.y0 AND l.x1 = m.x1 AND l.y1 = m.y1)),
x AS (SELECT DISTINCT p.plan_id, p.i, p.j FROM p JOIN e a ON a.plan_id = p.plan_id AND a.idx = p.i JOIN e b ON b.plan_id = p.plan_id AND b.idx = p.j
 WHERE (((a.bx - a.ax) * (b.ay - a.ay) - (a.by_ - a.ay) * (b.ax - a.ax)) > 0) <> (((a.bx - a.ax) * (b.by_ - a.ay) - (a.by_ - a.ay) * (b.bx - a.ax)) > 0)
   AND (((b.bx - b.ax) * (a.ay - b.ay) - (b.by_ - b.ay) * (a.ax - b.ax)) > 0) <> (((b.bx - b.ax) * (a.by_ - b.ay) - (b.by_ - b.ay) * (a.bx - b.ax)) > 0))
SELECT plan_id, 'r' || lpad(CAST(least(i, j) AS VARCHAR), 10, '0') AS source_ref, count(*) AS pairs FROM x GROUP BY 1, 2""")
def room_pair_crossing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of rooms whose borders cross, by their smaller reference.

    Which edge of a pair is first matters to the test (a turn of zero counts as to
    the right), so rooms are compared in the order of their references."""
    room = normalize.normalize(pj.rect_plans(spark, sf_dir)).room
    room = room.withColumn("ord", F.row_number().over(Window.partitionBy("plan_id").orderBy("source_ref")))
    return parse_checks.crossing_rooms(room).groupBy("plan_id", "source_ref").agg(F.count("*").alias("pairs"))


# Plans of odd users have warnings only.
_FOUND = """SELECT plan_id, CASE k WHEN 0 THEN 'PARSE_DEGENERATE_WALL' WHEN 1 THEN 'PARSE_LOW_CONFIDENCE' WHEN 2 THEN 'PARSE_DUPLICATE_ENTITY' WHEN 3 THEN 'PARSE_ROOM_BOUNDARY_UNMATCHED' ELSE 'PARSE_UNMAPPED_SOURCE_ENTITY' END AS code,
CASE WHEN k IN (0, 2) THEN 'error' ELSE 'warn' END AS severity, CASE k WHEN 0 THEN 3 WHEN 2 THEN 2 ELSE 4 END AS tier, source_ref, message
FROM (SELECT CAST(user_id AS STRING) AS plan_id, CASE WHEN user_id % 2 = 0 THEN event_id % 5 WHEN event_id % 5 = 0 THEN 1 WHEN event_id % 5 = 2 THEN 3 ELSE event_id % 5 END AS k,
CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_type END AS source_ref, CAST(event_id % 4 AS STRING) AS message FROM events) e"""


def _found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pj.tables(spark, sf_dir, "events")
    return spark.sql(_FOUND)


@query(f"""SELECT plan_id, code, severity, tier, source_ref, message, CAST(row_number() OVER (PARTITION BY plan_id ORDER BY tier, code, coalesce(source_ref, ''), message) AS INT) AS ord
FROM (SELECT DISTINCT * FROM ({_FOUND}) f) d""")
def finding_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct findings in their order."""
    return findings.precedence(_found(spark, sf_dir))


@query(f"""SELECT plan_id, code, tier, source_ref FROM (SELECT *, row_number() OVER (PARTITION BY plan_id ORDER BY tier, code, coalesce(source_ref, ''), message) AS k FROM ({_FOUND}) f) d WHERE k = 1""")
def terminal_finding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3, P10: the first finding of each plan."""
    return findings.terminal(_found(spark, sf_dir)).select("plan_id", "code", "tier", "source_ref")


@query(f"""WITH d AS (SELECT DISTINCT * FROM ({_FOUND}) f), n AS (SELECT plan_id, count(*) FILTER (severity = 'error') AS n_errors, count(*) FILTER (severity = 'warn') AS n_warnings FROM d GROUP BY plan_id),
p AS (SELECT DISTINCT CAST(user_id AS STRING) AS plan_id FROM events)
SELECT p.plan_id, coalesce(n_errors, 0) AS n_errors, coalesce(n_warnings, 0) AS n_warnings, CASE WHEN n_errors > 0 THEN 'failed' WHEN n_warnings > 0 THEN 'partial' ELSE 'complete' END AS status,
CASE WHEN n_errors > 0 THEN 3 WHEN n_warnings > 0 THEN 1 ELSE 0 END AS exit_code FROM p LEFT JOIN n USING (plan_id)""")
def status_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status and exit code of each plan."""
    f = _found(spark, sf_dir)
    plans = spark.table("events").select(F.col("user_id").cast("string").alias("plan_id"))
    return findings.rollup(plans, f)


@query("""WITH d AS (SELECT doc_id, len(string_split(text, ' ')) AS n, n_chars AS m FROM documents WHERE text IS NOT NULL)
SELECT CAST(doc_id AS STRING) AS plan_id, 'PARSE_DIMENSION_INCONSISTENT' AS code FROM d WHERE abs(n * 5 - m) > greatest(0.02, m * 0.01)""")
def dimension_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A declared length against the measured one (words against characters)."""
    pj.tables(spark, sf_dir, "documents")
    d = spark.table("documents").where("text is not null").select(F.col("doc_id").cast("string").alias("plan_id"), F.size(F.split("text", " ")).cast("double").alias("n"), F.col("n_chars").cast("double").alias("declared_m"))
    zero = F.lit(0.0)
    d = d.select("plan_id", g.point(zero, zero).alias("a_m"), g.point(F.col("n") * 5, zero).alias("b_m"), "declared_m")
    return parse_checks.dimension_faults(d).select("plan_id", "code")


_MODEL_WALL = f"SELECT plan_id, idx AS id, ax / 10000.0 AS ax, ay / 10000.0 AS ay, bx / 10000.0 AS bx, by_ / 10000.0 AS by_ FROM n"


def _wall_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = normalize.normalize(pj.wall_plans(spark, sf_dir)).wall
    return n.select("plan_id", F.col("idx").alias("id"), F.col("start_m").alias("start"), F.col("end_m").alias("end"), F.lit(0.1).alias("thickness_m"))


_CORNERS = "SELECT CAST(o_orderkey AS STRING) AS plan_id, (o_custkey % 97) * 0.1 AS x, (o_custkey % 89) * 0.1 AS y FROM orders UNION ALL SELECT CAST(o_orderkey AS STRING), 0.0, 0.0 FROM orders UNION ALL SELECT CAST(o_orderkey AS STRING), (o_custkey % 7) * 0.5, 0.0 FROM orders"


@query(f"""WITH {_GRID}, m AS ({_MODEL_WALL}), v AS ({_CORNERS}), k AS (SELECT plan_id, id, ax AS x, ay AS y FROM m UNION SELECT plan_id, id, bx, by_ FROM m)
SELECT DISTINCT k.plan_id, k.id FROM k WHERE NOT EXISTS (SELECT 1 FROM v WHERE v.plan_id = k.plan_id AND abs(v.x - k.x) <= 0.02 AND abs(v.y - k.y) <= 0.02)""")
def vertex_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Walls with an end on no vertex, through a grid."""
    wall = _wall_model(spark, sf_dir)
    pj.tables(spark, sf_dir, "orders")
    rooms = spark.sql(_CORNERS).select("plan_id", F.array(F.struct(F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))).alias("polygon"))
    return comp.loose_walls(wall, rooms)


@query(f"""WITH r AS (SELECT *, x0 + w AS x1, y0 + h AS y1 FROM ({pj.RECTS}) q),
e AS (SELECT plan_id, idx, x0 AS ax, y0 AS ay, x1 AS bx, y0 AS by_ FROM r UNION ALL SELECT plan_id, idx, x1, y0, x1, y1 FROM r UNION ALL SELECT plan_id, idx, x0, y1, x1, y1 FROM r UNION ALL SELECT plan_id, idx, x0, y0, x0, y1 FROM r),
w AS (SELECT plan_id, idx, ax + CASE WHEN idx % 3 = 0 THEN 50 ELSE 0 END AS ax, ay + CASE WHEN idx % 3 = 0 THEN 50 ELSE 0 END AS ay, bx + CASE WHEN idx % 3 = 0 THEN 50 ELSE 0 END AS bx, by_ + CASE WHEN idx % 3 = 0 THEN 50 ELSE 0 END AS by_ FROM e)
SELECT e.plan_id, e.idx AS id, count(*) AS edges FROM e WHERE NOT EXISTS (SELECT 1 FROM w WHERE w.plan_id = e.plan_id AND ((w.ay = w.by_ AND e.ay = w.ay AND e.by_ = w.ay AND e.ax BETWEEN w.ax AND w.bx AND e.bx BETWEEN w.ax AND w.bx)
 OR (w.ax = w.bx AND e.ax = w.ax AND e.bx = w.ax AND e.ay BETWEEN w.ay AND w.by_ AND e.by_ BETWEEN w.ay AND w.by_))) GROUP BY 1, 2""")
def edge_support_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Room edges that lie within no wall (those of a third
    of the rooms stand 50 mm off)."""
    r = pj.rect_rings(spark, sf_dir)
    off = F.when(F.col("idx") % 3 == 0, 50).otherwise(0)
    edges = r.withColumn("moved", F.transform("polygon", lambda p: g.point((p["x"] + off) / 1000, (p["y"] + off) / 1000))).select("plan_id", F.explode(g.ring_edges(F.col("moved"))).alias("e"))
    r = r.withColumn("polygon", F.transform("polygon", lambda p: g.point(p["x"] / 1000, p["y"] / 1000)))
    wall = edges.select("plan_id", F.col("e.a").alias("start"), F.col("e.b").alias("end"))
    return comp.unsupported_edges(wall, r.select("plan_id", F.col("idx").alias("id"), "polygon")).groupBy("plan_id", "id").agg(F.count("*").alias("edges"))


_PLACES = "SELECT CAST(label AS STRING) AS scene, CAST(vec_id AS STRING) AS viewpoint, floor(embedding[{0}] * 20) * 0.1 AS x, floor(embedding[{1}] * 20) * 0.1 AS y, floor(embedding[{2}] * 20) * 0.1 AS z FROM embeddings"


@query(f"""WITH p AS ({_PLACES.format(1, 2, 3)}) SELECT a.scene, a.viewpoint, b.viewpoint AS other FROM p a JOIN p b ON a.scene = b.scene AND a.viewpoint < b.viewpoint
WHERE sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2) < 0.15""")
def too_close_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Viewpoints that are too close, through a grid."""
    pj.tables(spark, sf_dir, "embeddings")
    p = spark.sql(_PLACES.format(0, 1, 2)).select("scene", "viewpoint", *(F.col(c).cast("double") for c in "xyz"))
    return package.close_pairs(p, 0.15)


@query(f"""WITH {_GRID}, d AS (SELECT plan_id, idx, {_WALL_ID} AS wid FROM n)
SELECT plan_id, idx, 'gw-' || substr(sha256('geom-wall|' || wid), 1, 12) AS id, 0.1::DOUBLE AS thickness_m, 2.6::DOUBLE AS height_m FROM d""")
def compile_walls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived ids and defaults of the white model."""
    n = normalize.normalize(pj.wall_plans(spark, sf_dir))
    w = comp.compile_model(n).wall
    return w.join(n.wall.select("plan_id", "ord", "idx"), ["plan_id", "ord"]).select("plan_id", "idx", "id", "thickness_m", "height_m")


@query(f"SELECT plan_id, idx, round((x0 + w / 2.0) / 1000.0, 6) AS cx, round((y0 + h / 2.0) / 1000.0, 6) AS cy FROM ({pj.RECTS}) r")
def room_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: area-weighted centres."""
    r = pj.rect_rings(spark, sf_dir).withColumn("c", g.centroid(F.transform("polygon", lambda p: g.point(p["x"] / 1000, p["y"] / 1000))))
    return r.select("plan_id", "idx", F.round("c.x", 6).alias("cx"), F.round("c.y", 6).alias("cy"))


@query(f"""WITH r AS (SELECT *, x0 + w AS x1, y0 + h AS y1 FROM ({pj.RECTS}) q) SELECT a.plan_id, a.idx, b.idx AS other FROM r a JOIN r b ON a.plan_id = b.plan_id AND a.idx <> b.idx
WHERE a.x0 + a.w / 2.0 > b.x0 AND a.x0 + a.w / 2.0 < b.x1 AND a.y0 + a.h / 2.0 > b.y0 AND a.y0 + a.h / 2.0 < b.y1""")
def points_in_rooms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P20: centres of rooms that lie inside another room, borders left out."""
    r = pj.rect_rings(spark, sf_dir).withColumn("ring", F.transform("polygon", lambda p: g.point(p["x"] / 1000, p["y"] / 1000)))
    a = r.select("plan_id", "idx", g.centroid(F.col("ring")).alias("c"))
    b = r.select("plan_id", F.col("idx").alias("other"), "ring")
    return a.join(b, "plan_id").where((F.col("idx") != F.col("other")) & g.inside(F.col("c"), F.col("ring"))).select("plan_id", "idx", "other")


@query(f"""WITH r AS (SELECT *, x0 + w AS x1, y0 + h AS y1, x0 + w / 2.0 AS cx, y0 + h / 2.0 AS cy FROM ({pj.RECTS}) q),
f AS (SELECT plan_id, unnest([{{'ax': x0, 'ay': y0, 'bx': x1, 'by_': y0}}, {{'ax': x1, 'ay': y0, 'bx': x1, 'by_': y1}}, {{'ax': x0, 'ay': y1, 'bx': x1, 'by_': y1}}, {{'ax': x0, 'ay': y0, 'bx': x0, 'by_': y1}}]) AS s FROM r)
SELECT a.plan_id, a.idx, count(*) AS walls FROM r a JOIN f b ON a.plan_id = b.plan_id
WHERE greatest(s.ax - a.cx, 0, a.cx - s.bx) ** 2 + greatest(s.ay - a.cy, 0, a.cy - s.by_) ** 2 < 415 ** 2 GROUP BY 1, 2""")
def free_space(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points closer than the clearance to walls (all sides of all rooms)."""
    r = pj.rect_rings(spark, sf_dir).withColumn("m", F.transform("polygon", lambda p: g.point(p["x"] / 1000, p["y"] / 1000)))
    points = r.select("plan_id", F.col("idx").alias("room_id"), g.centroid(F.col("m")).alias("point"), F.col("m").alias("polygon"))
    edges = r.select("plan_id", "idx", F.posexplode(g.ring_edges(F.col("m"))).alias("k", "e"))
    wall = edges.select("plan_id", (F.col("idx") * 4 + F.col("k")).alias("id"), F.col("e.a").alias("start"), F.col("e.b").alias("end"), F.lit(0.13).alias("thickness_m"))
    model = comp.Model(wall, r, spark.createDataFrame([], "plan_id string, id bigint, center struct<x: double, y: double>"))
    return camera.free_space(points, model).where("code = 'CAM_VIEWPOINT_COLLIDES_WALL'").groupBy("plan_id", F.col("room_id").alias("idx")).agg(F.count("*").alias("walls"))


@query(f"""WITH r AS (SELECT plan_id, 'gr-' || lpad(CAST(idx AS VARCHAR), 10, '0') AS room_id FROM ({pj.RECTS}) q WHERE idx % 5 <> 0)
SELECT plan_id, room_id, lpad(CAST(row_number() OVER (PARTITION BY plan_id ORDER BY room_id) - 1 AS VARCHAR), 4, '0') AS id FROM r""")
def viewpoint_ordinals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Viewpoints are numbered over the rooms that have one; each fifth room
    is flat, so no point is inside."""
    return camera.place_viewpoints(_room_model(spark, sf_dir, flat=True))[0].select("plan_id", "room_id", "id")


def _room_model(spark: SparkSession, sf_dir: str, flat: bool) -> comp.Model:
    pj.tables(spark, sf_dir, "orders")
    x0, y0, x1 = F.col("x0") / 1000, F.col("y0") / 1000, (F.col("x0") + F.col("w")) / 1000
    h = F.when(F.col("idx") % 5 == 0, 0).otherwise(F.col("h")) if flat else F.col("h")
    y1 = (F.col("y0") + h) / 1000
    room = spark.sql(pj.RECTS).select("plan_id", F.concat(F.lit("gr-"), F.lpad(F.col("idx").cast("string"), 10, "0")).alias("id"), F.array(g.point(x0, y0), g.point(x1, y0), g.point(x1, y1), g.point(x0, y1)).alias("polygon"))
    none = lambda schema: spark.createDataFrame([], schema).where(F.lit(False))
    wall = none("plan_id string, id string, ord int, start struct<x: double, y: double>, end struct<x: double, y: double>, thickness_m double")
    return comp.Model(wall, room, none("plan_id string, id string, ord int, center struct<x: double, y: double>"))


@query(f"""SELECT plan_id, count(*) - count(DISTINCT row(2 * x0 + w, 2 * y0 + h)) AS n FROM ({pj.RECTS}) r GROUP BY 1 HAVING count(*) > count(DISTINCT row(2 * x0 + w, 2 * y0 + h))""")
def duplicate_viewpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Viewpoints of a plan that stand where another one does."""
    found = camera.place_viewpoints(_room_model(spark, sf_dir, flat=False))[1]
    return found.where("code = 'CAM_DUPLICATE_ENTITY'").groupBy("plan_id").agg(F.count("*").alias("n"))


@query(f"SELECT plan_id, 'gr-' || lpad(CAST(idx AS VARCHAR), 10, '0') AS source_ref FROM ({pj.RECTS}) r WHERE idx % 5 = 0")
def uncovered_rooms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rooms where no viewpoint can stand."""
    found = camera.place_viewpoints(_room_model(spark, sf_dir, flat=True))[1]
    return found.where("code = 'CAM_UNCOVERED_ROOM'").select("plan_id", "source_ref")


_FITS = """len > 0 AND abs((cx - w.ax / 10000.0) * uy - (cy - w.ay / 10000.0) * ux) <= 0.02 AND ((cx - w.ax / 10000.0) * ux + (cy - w.ay / 10000.0) * uy) BETWEEN -0.0001 AND len + 0.0001"""
_HOSTS = f"""{_GRID}, d AS (SELECT *, {_WALL_ID} AS wid, sqrt((bx - ax) * (bx - ax) + (by_ - ay) * (by_ - ay)) / 10000.0 AS len FROM n),
u AS (SELECT *, (bx - ax) / 10000.0 / nullif(len, 0) AS ux, (by_ - ay) / 10000.0 / nullif(len, 0) AS uy FROM d),
o AS (SELECT plan_id, idx, (ax + bx) // 2 AS gx, (ay + by_) // 2 AS gy, (ax + bx) / 20000.0 AS cx, (ay + by_) / 20000.0 AS cy FROM n WHERE f = 'R'),
c AS (SELECT o.plan_id, o.idx, gx, gy, count(*) FILTER (WHERE {_FITS}) AS n_walls, min(w.wid) FILTER (WHERE {_FITS}) AS wid, max(least((cx - w.ax / 10000.0) * ux + (cy - w.ay / 10000.0) * uy, len - (cx - w.ax / 10000.0) * ux - (cy - w.ay / 10000.0) * uy)) FILTER (WHERE {_FITS}) AS room FROM o JOIN u w ON w.plan_id = o.plan_id GROUP BY ALL)"""


@query(f"""WITH {_HOSTS} SELECT plan_id, idx, CASE WHEN n_walls = 0 THEN 'PARSE_UNKNOWN_WALL_REF' WHEN n_walls > 1 THEN 'PARSE_AMBIGUOUS_WALL_REF' WHEN room < 0.45 - 0.0001 THEN 'PARSE_OPENING_WIDTH_EXCEEDS_WALL' END AS code FROM c""")
def opening_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with an opening's wall."""
    n = normalize.normalize(pj.wall_plans(spark, sf_dir, openings=True))
    return parse_checks.opening_faults(n.opening, n.wall).select("plan_id", "idx", F.col("fault.code").alias("code"))


_HOST_ID = "CASE WHEN n_walls = 1 THEN wid ELSE '__dxf_probe__' END"


@query(f"""WITH {_HOSTS}, i AS (SELECT *, 'o-' || substr(sha256('opening|door|' || {_HOST_ID} || '|' || {_KEY('gx')} || '|' || {_KEY('gy')} || '|0.9000'), 1, 12) AS oid FROM c)
SELECT plan_id, 'go-' || substr(sha256('geom-opening|' || oid), 1, 12) AS id, 'gw-' || substr(sha256('geom-wall|' || {_HOST_ID}), 1, 12) AS wall_id, gx / 10000.0::DOUBLE AS cx, gy / 10000.0::DOUBLE AS cy, 0.9::DOUBLE AS width_m, 2.1::DOUBLE AS height_m, 0.0::DOUBLE AS sill_m, 0.1::DOUBLE AS depth_m FROM i""")
def compile_openings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Openings of the white model."""
    o = comp.compile_model(normalize.normalize(pj.wall_plans(spark, sf_dir, openings=True))).opening
    return o.select("plan_id", "id", "wall_id", F.col("center.x").alias("cx"), F.col("center.y").alias("cy"), "width_m", "height_m", "sill_m", "depth_m")


_MOVED = f"m AS (SELECT plan_id, idx, x0 - min(x0) OVER p AS x0, y0 - min(y0) OVER p AS y0, w, h FROM ({pj.RECTS}) r WINDOW p AS (PARTITION BY plan_id))"
_RING_KEY = " || '|' || ".join(_KEY(f"({c}) * 10") for c in ("x0", "y0", "x0 + w", "y0", "x0 + w", "y0 + h", "x0", "y0 + h"))


@query(f"""WITH {_MOVED}, i AS (SELECT plan_id, idx, 'r-' || substr(sha256('room|' || {_RING_KEY}), 1, 12) AS rid FROM m)
SELECT plan_id, rid AS parse_id, 'gr-' || substr(sha256('geom-room|' || rid), 1, 12) AS id, 0.0::DOUBLE AS floor_z_m, 2.6::DOUBLE AS ceiling_z_m FROM i""")
def compile_rooms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rooms of the white model, and the ids that theirs come from."""
    n = normalize.normalize(pj.rect_plans(spark, sf_dir))
    r = comp.compile_model(n).room
    return r.join(n.room.select("plan_id", "ord", F.col("id").alias("parse_id")), ["plan_id", "ord"]).select("plan_id", "parse_id", "id", "floor_z_m", "ceiling_z_m")


_YAW = "SELECT vec_id, (vec_id % 16) * 0.375 AS yaw, (vec_id % 90) * 0.5 AS x, (vec_id % 7) * 0.25 AS y FROM embeddings"


@query(f"""WITH v AS ({_YAW}) SELECT vec_id, round(-cos(yaw), 9) + 0.0 AS m00, round(sin(yaw), 9) + 0.0 AS m02, x::DOUBLE AS m03, round(-sin(yaw), 9) + 0.0 AS m10, round(-cos(yaw), 9) + 0.0 AS m12, y::DOUBLE AS m13, -1.0::DOUBLE AS m21, 1.35::DOUBLE AS m23, 1.0::DOUBLE AS m33 FROM v""")
def extrinsics_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Camera-to-world matrices from the yaw."""
    pj.tables(spark, sf_dir, "embeddings")
    v = spark.sql(_YAW).select("vec_id", F.col("yaw").cast("double").alias("yaw_rad"), F.struct(F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), F.lit(camera.CAMERA_HEIGHT_M).alias("z")).alias("position"))
    at = {"m00": 0, "m02": 2, "m03": 3, "m10": 4, "m12": 6, "m13": 7, "m21": 9, "m23": 11, "m33": 15}
    return camera.extrinsics(v).select("vec_id", *((F.round(F.col("matrix")[k], 9) + 0.0).alias(c) for c, k in at.items()))


@query(f"""WITH v AS ({_YAW}) SELECT CAST(vec_id AS STRING) AS id, array_to_string(list_transform([[-cos(0.0), 0.0, 0.0, x], [0.0, 0.0, -cos(0.0), y], [0.0, -1.0, 0.0, 1.35], [0.0, 0.0, 0.0, 1.0]], lambda r: array_to_string(list_transform(r, lambda c: printf('%.10f', c::DOUBLE)), ' ')), chr(10)) || chr(10) AS text FROM v""")
def extrinsics_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: the text of a matrix, here of cameras that look along an axis."""
    pj.tables(spark, sf_dir, "embeddings")
    v = spark.sql(_YAW).select(F.lit("p").alias("plan_id"), F.col("vec_id").cast("string").alias("id"), F.lit(0.0).alias("yaw_rad"), F.struct(F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), F.lit(camera.CAMERA_HEIGHT_M).alias("z")).alias("position"))
    return camera.extrinsics_text(v).select("id", F.replace("text", F.lit("-0.0000000000"), F.lit("0.0000000000")).alias("text"))


_VIEWS = "SELECT CAST(conv_id AS STRING) AS plan_id, lpad(CAST(turn AS STRING), 4, '0') AS id, max(coalesce(role, '') || lpad(CAST(100 - turn AS STRING), 4, '0')) AS room_id, max(turn) AS turn FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY 1, 2"
_STEPS = f"SELECT a.plan_id, a.id AS a, b.id AS b, CAST(a.turn AS INT) AS ord FROM ({_VIEWS}) a JOIN ({_VIEWS}) b ON a.plan_id = b.plan_id AND b.turn = a.turn + 1"


@query(f"""WITH v AS ({_VIEWS}), e AS ({_STEPS}), b AS (SELECT plan_id, a AS key, b AS value, ord FROM e UNION ALL SELECT plan_id, b, a, ord FROM e), g AS (SELECT plan_id, key, string_agg(value, ',' ORDER BY ord) AS vals FROM b GROUP BY 1, 2),
s AS (SELECT plan_id, arg_min(id, room_id) AS start FROM v GROUP BY 1)
SELECT v.plan_id, CAST(row_number() OVER (PARTITION BY v.plan_id ORDER BY id <> start, id) AS INT) AS pos, id AS key, coalesce(vals, '') AS "values" FROM v JOIN s USING (plan_id) LEFT JOIN g ON g.plan_id = v.plan_id AND g.key = v.id""")
def map_draft(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbours of each viewpoint, the start first."""
    pj.tables(spark, sf_dir, "conversations")
    views = spark.sql(_VIEWS)
    return camera.map_draft(views, spark.sql(_STEPS)).select("plan_id", "pos", "key", F.array_join("values", ",").alias("values"))


@query(f"""WITH r AS (SELECT *, x0 + w AS x1, y0 + h AS y1 FROM ({pj.RECTS}) q),
t AS (SELECT a.plan_id, a.idx AS door, b.idx AS room FROM r a JOIN r b ON a.plan_id = b.plan_id AND ((b.y0 = a.y0 OR b.y1 = a.y0) AND a.x0 >= b.x0 AND a.x1 <= b.x1)),
c AS (SELECT plan_id, door, count(DISTINCT room) AS rooms FROM t GROUP BY 1, 2)
SELECT plan_id, door AS door_id, rooms, rooms = 2 AS joins FROM c""")
def door_adjacency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A door in the lower wall of each room, and the rooms that hold it."""
    r = pj.rect_rings(spark, sf_dir).withColumn("ring", g.canonical_ring(F.transform("polygon", lambda p: g.point(p["x"].cast("long"), p["y"].cast("long")))))
    r = settled(r.withColumn("polygon", F.transform("ring", lambda p: g.point(p["x"] / 1000, p["y"] / 1000))).select("plan_id", "idx", "polygon"))
    wall = r.select("plan_id", F.col("idx").alias("id"), F.col("polygon")[0].alias("start"), F.col("polygon")[1].alias("end"))
    door = r.select("plan_id", F.col("idx").alias("id"), F.lit("door").alias("type"), F.col("idx").alias("wall_id"))
    views = r.select("plan_id", F.col("idx").alias("room_id"), F.col("idx").cast("string").alias("id"))
    out = camera.door_rooms(comp.Model(wall, r.select("plan_id", F.col("idx").alias("id"), "polygon"), door), views)
    return out.select("plan_id", "door_id", F.size("rooms").cast("long").alias("rooms"), (F.size("rooms") == 2).alias("joins"))


@query("""WITH m AS (SELECT vec_id, CASE WHEN vec_id % 3 = 0 THEN -1.0 ELSE 1.0 END AS a, CASE WHEN vec_id % 5 = 0 THEN 0.0 ELSE 1.0 END AS b, CASE WHEN vec_id % 7 = 0 THEN 2.0 ELSE 1.0 END AS c, vec_id % 90 AS t, (vec_id % 11) * 0.5 AS h FROM embeddings)
SELECT vec_id, CASE WHEN b = 0 AND c = 2 THEN 'MATRIX_NOT_INVERTIBLE,MATRIX_LAST_ROW_INVALID' WHEN b = 0 THEN 'MATRIX_NOT_INVERTIBLE' WHEN c = 2 AND a = -1 THEN 'MATRIX_LAST_ROW_INVALID' WHEN c = 2 THEN 'MATRIX_LAST_ROW_INVALID,MATRIX_NOT_RIGHT_HANDED'
WHEN a = 1 THEN 'MATRIX_NOT_RIGHT_HANDED' ELSE array_to_string(list_filter([CASE WHEN h NOT BETWEEN 0.5 AND 3.0 THEN 'CAMERA_HEIGHT_OUTLIER' END, CASE WHEN sqrt(t * t + h * h) > 50 THEN 'CAMERA_POSITION_OUTLIER' END], lambda x: x IS NOT NULL), ',') END AS codes FROM m""")
def extrinsics_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matrices made sound and unsound by their id."""
    pj.tables(spark, sf_dir, "embeddings")
    k = F.col("vec_id")
    a = F.when(k % 3 == 0, -1.0).otherwise(1.0)
    b, c = F.when(k % 5 == 0, 0.0).otherwise(1.0), F.when(k % 7 == 0, 2.0).otherwise(1.0)
    z = F.lit(0.0)
    m = F.array(a, z, z, (k % 90).cast("double"), z, z, F.lit(-1.0) * b, z, z, F.lit(-1.0), z, (k % 11) * 0.5, z, z, z, c)
    return spark.table("embeddings").select("vec_id", F.array_join(extrinsics_codes(m), ",").alias("codes"))


_TRUTH = f"SELECT plan_id, idx AS ord, x2 - x1 AS dx, y2 - y1 AS dy FROM ({pj.WALLS}) w"
_PRED = f"SELECT plan_id, idx AS ord, x2 - x1 AS dx, CASE WHEN idx % 2 = 0 THEN y2 - y1 ELSE 250 END AS dy FROM ({pj.WALLS}) w WHERE idx <> 3"


def _matched(spark: SparkSession, sf_dir: str):
    pj.tables(spark, sf_dir, "lineitem")
    truth = spark.sql(_TRUTH).withColumn("supported", F.col("dx") > 0)
    return truth, evaluator.matches(truth, spark.sql(_PRED), "plan_id", "dx", "dy")


_MATCH_SQL = f"""t AS (SELECT *, row_number() OVER (PARTITION BY plan_id, dx, dy ORDER BY ord) AS k FROM ({_TRUTH}) a), p AS (SELECT *, row_number() OVER (PARTITION BY plan_id, dx, dy ORDER BY ord) AS k FROM ({_PRED}) b),
m AS (SELECT t.plan_id, t.ord AS truth_ord, p.ord AS predicted_ord, t.dx FROM t JOIN p USING (plan_id, dx, dy, k))"""


@query(f"WITH {_MATCH_SQL} SELECT plan_id, truth_ord, predicted_ord FROM m")
def truth_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-to-one matches by exact key."""
    return _matched(spark, sf_dir)[1].select("plan_id", "truth_ord", "predicted_ord")


@query(f"""WITH {_MATCH_SQL}, s AS (SELECT plan_id, count(*) FILTER (dx > 0) AS supportable FROM ({_TRUTH}) a GROUP BY plan_id), c AS (SELECT plan_id, count(*) AS correct FROM m WHERE dx > 0 GROUP BY plan_id),
r AS (SELECT plan_id, supportable, coalesce(correct, 0) AS correct FROM s LEFT JOIN c USING (plan_id))
SELECT round(avg(CASE WHEN supportable > 0 THEN correct / supportable ELSE 0 END), 9) AS macro, round(sum(correct) / sum(supportable), 9) AS micro FROM r""")
def macro_micro(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of plans and their averages."""
    truth, matched = _matched(spark, sf_dir)
    return evaluator.averages(evaluator.plan_scores(truth, matched)).select(F.round("macro", 9).alias("macro"), F.round("micro", 9).alias("micro"))


_PROPORTION = "SELECT user_id, count(*) AS trials, sum(CASE WHEN user_id % 5 = 0 THEN 0 WHEN user_id % 7 = 0 THEN 1 WHEN event_type = 'click' THEN 1 ELSE 0 END) AS successes FROM events GROUP BY user_id"


@query(f"""SELECT user_id, round(CASE WHEN successes = 0 THEN least(3.0 / trials, 1.0) WHEN successes = trials THEN trials / (trials + {evaluator.Z} * {evaluator.Z})
ELSE greatest(0, (successes / trials + {evaluator.Z} * {evaluator.Z} / (2 * trials) - {evaluator.Z} * sqrt((successes / trials * (1 - successes / trials) + {evaluator.Z} * {evaluator.Z} / (4 * trials)) / trials)) / (1 + {evaluator.Z} * {evaluator.Z} / trials)) END, 9) AS lower_bound FROM ({_PROPORTION}) p""")
def wilson_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: bounds of proportions."""
    pj.tables(spark, sf_dir, "events")
    return spark.sql(_PROPORTION).select("user_id", F.round(evaluator.lower_bound(F.col("successes"), F.col("trials")), 9).alias("lower_bound"))


@query("""WITH r AS (SELECT CAST(user_id AS STRING) AS plan_id, count(*) AS total, count(*) FILTER (event_id % 3 = 0) AS false_negative FROM events WHERE event_type = 'view' GROUP BY 1), p AS (SELECT CAST(user_id AS STRING) AS plan_id, count(*) FILTER (event_type = 'click') AS supportable FROM events GROUP BY 1)
SELECT p.plan_id, coalesce(total, 0) AS total, coalesce(total, 0) - coalesce(false_negative, 0) AS handled, coalesce(false_negative, 0) AS false_negative, round(CASE WHEN supportable > 0 THEN coalesce(total, 0) / supportable ELSE 0 END, 9) AS refusal_rate FROM p LEFT JOIN r USING (plan_id)""")
def refusals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refusals by kind."""
    pj.tables(spark, sf_dir, "events")
    e = spark.table("events").withColumn("plan_id", F.col("user_id").cast("string"))
    rows = e.where("event_type = 'view'").select("plan_id", F.when(F.col("event_id") % 3 == 0, "supported").otherwise("unsupported").alias("kind"))
    scores = e.groupBy("plan_id").agg(F.count_if(F.col("event_type") == "click").alias("supportable"))
    return evaluator.refusals(rows, scores).withColumn("refusal_rate", F.round("refusal_rate", 9))


_ANCHORS = "SELECT CAST(user_id AS STRING) || '-' || CAST(event_id % 23 AS STRING) AS plan_id, 1.0 + event_id % 9 AS real_length_m, 100.0 + event_id % 50 AS span_px FROM events"


@query(f"""WITH a AS (SELECT plan_id, real_length_m::DOUBLE / span_px::DOUBLE AS m FROM ({_ANCHORS}) e), f AS (SELECT plan_id, median(m) AS md, min(m) AS lo, max(m) AS hi, count(*) AS anchors FROM a GROUP BY plan_id)
SELECT plan_id, round(CASE WHEN anchors >= 3 THEN md END, 9) AS m_per_px, round(CASE WHEN anchors >= 3 THEN greatest(hi - md, md - lo) / md END, 9) AS median_residual, round(CASE WHEN anchors >= 3 THEN (hi - lo) / md END, 9) AS disagreement, anchors FROM f""")
def scale_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scale from anchors, of all events; the plans are parts of users, so
    that some have fewer than three."""
    pj.tables(spark, sf_dir, "events")
    a = spark.sql(_ANCHORS).select("plan_id", F.col("real_length_m").cast("double").alias("real_length_m"), F.col("span_px").cast("double").alias("span_px"))
    out = evaluator.scale_fit(a)
    return out.select("plan_id", *(F.round(c, 9).alias(c) for c in ("m_per_px", "median_residual", "disagreement")), "anchors")


_HIST = "SELECT event_type, CAST((event_id * event_id + user_id * 3) % 256 AS INT) AS bin, count(*) AS n FROM events GROUP BY 1, 2"


@query(f"""WITH h AS ({_HIST}), f AS (SELECT t.event_type, b.bin, coalesce(h.n, 0) AS n FROM (SELECT DISTINCT event_type FROM h) t CROSS JOIN (SELECT unnest(range(256))::INT AS bin) b LEFT JOIN h ON h.event_type = t.event_type AND h.bin = b.bin),
c AS (SELECT event_type, bin, n, sum(n) OVER w AS nn, sum(n * bin) OVER w AS mm, sum(n) OVER (PARTITION BY event_type) AS tn, sum(n * bin) OVER (PARTITION BY event_type) AS tm, sum(n * bin * bin) OVER (PARTITION BY event_type) AS ts FROM f WINDOW w AS (PARTITION BY event_type ORDER BY bin)),
s AS (SELECT *, CASE WHEN nn > 0 AND nn < tn THEN ((tm * nn - mm * tn)::DOUBLE * (tm * nn - mm * tn)::DOUBLE) / (nn * (tn - nn)) ELSE 0 END AS score,
 CASE WHEN nn - n > 0 AND nn - n < tn THEN ((tm * (nn - n) - (mm - n * bin) * tn)::DOUBLE * (tm * (nn - n) - (mm - n * bin) * tn)::DOUBLE) / ((nn - n) * (tn - nn + n)) ELSE 0 END AS eta FROM c)
SELECT event_type, bin AS threshold, round(eta / (ts * tn - tm * tm), 9) AS separability FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY score DESC, bin) AS k FROM s WHERE bin BETWEEN 1 AND 254) WHERE k = 1""")
def otsu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The threshold between two classes of grey."""
    pj.tables(spark, sf_dir, "events")
    return evaluator.otsu(spark.sql(_HIST), "event_type")


@query("""WITH e AS (SELECT conv_id, turn, role, len(string_split(text, ' ')) % 5 AS n FROM conversations WHERE text IS NOT NULL AND role IS NOT NULL)
SELECT CAST(conv_id % 50 AS STRING) AS scene, CAST(conv_id AS STRING) AS map_file, count(DISTINCT role) + sum(n) AS nodes FROM e GROUP BY conv_id""")
def map_traversal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes that a map visits."""
    pj.tables(spark, sf_dir, "conversations")
    c = spark.table("conversations").where("text is not null and role is not null").withColumn("n", F.size(F.split("text", " ")) % 5)
    entries = c.select((F.col("conv_id") % 50).cast("string").alias("scene"), F.col("conv_id").cast("string").alias("map_file"), F.col("role").alias("key"), F.slice(F.split("text", " "), F.lit(1), F.col("n")).alias("values"))
    return package.traversals(entries).withColumn("nodes", F.col("nodes").cast("long"))


_NAME = "CASE page_id % 6 WHEN 0 THEN 'con.txt' WHEN 1 THEN 'file.' WHEN 2 THEN 'Lpt1' WHEN 3 THEN 'comet' WHEN 4 THEN 'a b ' ELSE url END"


@query(f"SELECT page_id, CASE page_id % 6 WHEN 0 THEN false WHEN 1 THEN false WHEN 2 THEN false WHEN 3 THEN true WHEN 4 THEN false ELSE NOT regexp_matches(url, '[. ]$') END AS safe FROM pages WHERE url IS NOT NULL")
def filename_safety(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2: names that all systems can keep."""
    pj.tables(spark, sf_dir, "pages")
    return spark.table("pages").where("url is not null").select("page_id", package.safe_name(F.expr(_NAME)).alias("safe"))


_DEPTH = "SELECT CAST(user_id AS STRING) AS scene, CAST(CASE WHEN event_id % 4 = 0 THEN 0 WHEN event_id % 31 = 0 THEN 65535 ELSE (event_id * 7) % 4000 END AS INT) AS v, 1 AS one FROM events"


@query(f"""WITH d AS ({_DEPTH}) SELECT scene, round(avg(CASE WHEN v = 0 THEN 1.0 ELSE 0.0 END), 9) AS zero_share, max(CASE WHEN v > 0 THEN v END) AS largest, median(CASE WHEN v > 0 THEN v END) AS median,
round(avg(CASE WHEN v = 0 THEN NULL WHEN v >= 65535 THEN 1.0 ELSE 0.0 END), 9) AS saturated_share FROM d GROUP BY scene""")
def depth_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of depths from histograms."""
    pj.tables(spark, sf_dir, "events")
    h = spark.sql(_DEPTH).groupBy("scene", "v").agg(F.count("*").alias("n"))
    out = package.depth_statistics(h, "scene")
    return out.select("scene", F.round("zero_share", 9).alias("zero_share"), "largest", "median", F.round("saturated_share", 9).alias("saturated_share"))


_CATALOG = "SELECT DISTINCT p_brand AS schema_id, CAST(p_size % 3 AS STRING) || '.' || CAST(p_partkey % 12 AS STRING) || '.' || CAST(p_size % 11 AS STRING) AS schema_version FROM part"


@query(f"""WITH c AS ({_CATALOG}) SELECT schema_id, schema_version FROM (SELECT *, row_number() OVER (PARTITION BY schema_id ORDER BY CAST(split_part(schema_version, '.', 1) AS INT) DESC, CAST(split_part(schema_version, '.', 2) AS INT) DESC, CAST(split_part(schema_version, '.', 3) AS INT) DESC) AS k FROM c) WHERE k = 1""")
def schema_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4: the latest version, by number and not by text."""
    pj.tables(spark, sf_dir, "part")
    return contracts.latest(spark.sql(_CATALOG))


@query(f"""WITH c AS ({_CATALOG}), d AS (SELECT p_partkey AS doc, p_brand AS schema_id, CAST(p_size % 3 AS STRING) || '.1.0' AS schema_version, CAST((p_size + p_partkey) % 4 AS STRING) || '.' || CAST(p_partkey % 12 AS STRING) || '.' || CAST(p_size % 11 AS STRING) AS consumer_version FROM part)
SELECT doc, CASE WHEN NOT EXISTS (SELECT 1 FROM c WHERE c.schema_id = d.schema_id AND c.schema_version = d.consumer_version) THEN 'unknown version'
WHEN row(CAST(split_part(schema_version, '.', 1) AS INT), CAST(split_part(schema_version, '.', 2) AS INT), 0) > row(CAST(split_part(consumer_version, '.', 1) AS INT), CAST(split_part(consumer_version, '.', 2) AS INT), CAST(split_part(consumer_version, '.', 3) AS INT)) THEN 'newer document' END AS detail FROM d""")
def consumer_rejection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that a consumer can't read."""
    pj.tables(spark, sf_dir, "part")
    d = spark.sql("SELECT p_partkey AS doc, p_brand AS schema_id, CAST(p_size % 3 AS STRING) || '.1.0' AS schema_version, CAST((p_size + p_partkey) % 4 AS STRING) || '.' || CAST(p_partkey % 12 AS STRING) || '.' || CAST(p_size % 11 AS STRING) AS consumer_version, 0 AS n_errors FROM part")
    return contracts.consumer_rejections(d, spark.sql(_CATALOG)).select("doc", "detail")


@query("""WITH RECURSIVE r AS (SELECT DISTINCT 's' || n_nationkey AS a, 's' || ((n_nationkey * 3 + n_regionkey) % 25) AS b FROM nation), w(state, depth) AS (SELECT 's1', 0 UNION SELECT r.b, w.depth + 1 FROM w JOIN r ON r.a = w.state WHERE w.depth < 24)
SELECT state, min(depth) AS depth FROM w GROUP BY state""")
def state_reachability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3: states that a run can reach, and in how few steps."""
    pj.tables(spark, sf_dir, "nation")
    rows = spark.sql("SELECT DISTINCT n_nationkey AS a, (n_nationkey * 3 + n_regionkey) % 25 AS b FROM nation").collect()
    doc = {"states": ["s1"], "transitions": [{"from": f"s{r.a}", "to": f"s{r.b}"} for r in rows]}
    return lifecycle.reachable(lifecycle.machine(spark, doc), most=24)


@query("""WITH r AS (SELECT conv_id AS chain_id, turn AS ord, role || '-' || turn AS review_id, turn % 4 = 3 AS supersedes FROM conversations WHERE role IS NOT NULL), s AS (SELECT *, max(CASE WHEN supersedes THEN ord END) OVER (PARTITION BY chain_id) AS since FROM r)
SELECT chain_id, arg_max(review_id, ord) AS current_head_id, count(*) AS length FROM s WHERE ord >= coalesce(since, 0) GROUP BY chain_id""")
def review_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heads of review chains."""
    pj.tables(spark, sf_dir, "conversations")
    r = spark.table("conversations").where("role is not null").select(F.col("conv_id").alias("chain_id"), F.col("turn").alias("ord"), F.concat_ws("-", "role", "turn").alias("review_id"), (F.col("turn") % 4 == 3).alias("supersedes"))
    return lifecycle.review_heads(r)


_SPANS = "SELECT user_id, (event_id * 37) % 5000 AS lo, (event_id * 37) % 5000 + event_id % 60 AS hi FROM events"
_ISLANDS = "m AS (SELECT *, max(hi) OVER (PARTITION BY user_id ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM s), i AS (SELECT *, sum(CASE WHEN before IS NULL OR lo - before > {gap} THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS island FROM m)"


@query(f"WITH s AS ({_SPANS}), {_ISLANDS.format(gap=35)} SELECT user_id, min(lo) AS lo, max(hi) AS hi, count(*) AS n FROM i GROUP BY user_id, island")
def interval_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intervals that are near are one."""
    pj.tables(spark, sf_dir, "events")
    return lifecycle.merge_intervals(spark.sql(_SPANS), 35, "user_id").drop("island")


@query(f"WITH s AS (SELECT user_id, event_id AS lo, event_id AS hi FROM events), {_ISLANDS.format(gap=100)} SELECT user_id, min(lo) AS lo, max(hi) AS hi, count(*) AS n FROM i GROUP BY user_id, island")
def gap_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximal runs of neighbours."""
    pj.tables(spark, sf_dir, "events")
    return lifecycle.runs(spark.table("events").select("user_id", F.col("event_id").alias("x")), 100, "user_id").drop("island")


@query("""WITH d AS (SELECT CASE WHEN doc_id % 7 = 0 THEN -1 - doc_id ELSE doc_id END AS doc_id, sha256(coalesce(text, '')) AS h FROM documents), a AS (SELECT doc_id, sha256(CASE WHEN doc_id % 5 = 0 THEN 'x' ELSE coalesce(text, '') END) AS h FROM documents)
SELECT doc_id, CASE WHEN a.h IS NULL THEN 'missing' WHEN d.h IS NULL THEN 'unexpected' ELSE 'different' END AS state FROM d FULL JOIN a USING (doc_id) WHERE a.h IS NULL OR d.h IS NULL OR a.h <> d.h""")
def hash_full_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared against actual hashes; some are declared under another
    name, and some files differ."""
    pj.tables(spark, sf_dir, "documents")
    d = spark.table("documents").withColumn("t", F.coalesce("text", F.lit("")))
    name = F.when(F.col("doc_id") % 7 == 0, -1 - F.col("doc_id")).otherwise(F.col("doc_id"))
    declared = d.select(name.alias("doc_id"), F.sha2("t", 256).alias("sha256"))
    actual = d.select("doc_id", F.sha2(F.when(F.col("doc_id") % 5 == 0, "x").otherwise(F.col("t")), 256).alias("sha256"))
    return contracts.compare_hashes(declared, actual, "doc_id")


@query("SELECT sha256(text) AS family, count(DISTINCT source) AS splits FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(DISTINCT source) > 1")
def split_leakage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that occur in more than one source."""
    pj.tables(spark, sf_dir, "documents")
    d = spark.table("documents").where("text is not null").select(F.sha2("text", 256).alias("family"), "source")
    return lifecycle.split_leaks(d, "family", "source")


_ARC = "SELECT p_partkey, CAST(500 + p_size * 40 AS DOUBLE) AS r, CAST(10 + p_partkey % 340 AS DOUBLE) AS deg FROM part"


@query(f"""WITH a AS ({_ARC}), n AS (SELECT p_partkey, r, deg, min(k) AS segments FROM a CROSS JOIN (SELECT 2 ** unnest(range(1, 12)) AS k) c WHERE r * (1 - cos(radians(deg) / (2 * k))) / 5 <= 0.5 GROUP BY 1, 2, 3)
SELECT p_partkey, CAST(segments AS INT) AS segments, round(tan(radians(deg) / 4), 9) AS bulge FROM n""")
def arc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of arcs within a sagitta, in closed form, and bulges."""
    pj.tables(spark, sf_dir, "part")
    theta = F.radians("deg")
    return spark.sql(_ARC).select("p_partkey", arcs.segments(F.col("r"), theta, 0.5, 5.0).alias("segments"), F.round(arcs.bulge(theta, F.lit("ccw")), 9).alias("bulge"))


_LIN = lambda c: f"CASE WHEN {c} / 255.0 <= 0.04045 THEN {c} / 255.0 / 12.92 ELSE (({c} / 255.0 + 0.055) / 1.055) ** 2.4 END"
_LUM = lambda r, g_, b: f"(0.2126 * {_LIN(r)} + 0.7152 * {_LIN(g_)} + 0.0722 * {_LIN(b)})"


@query(f"""WITH c AS (SELECT p_partkey, p_partkey % 256 AS r, (p_partkey * 7) % 256 AS g, p_size * 5 % 256 AS b FROM part), l AS (SELECT p_partkey, {_LUM('r', 'g', 'b')} AS f, {_LUM('(255 - r)', '((g * 3) % 256)', 'b')} AS k FROM c)
SELECT p_partkey, round((greatest(f, k) + 0.05) / (least(f, k) + 0.05), 6) AS contrast FROM l""")
def contrast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contrast of colours."""
    pj.tables(spark, sf_dir, "part")
    k, s = F.col("p_partkey"), F.col("p_size")
    r, g_, b = k % 256, (k * 7) % 256, s * 5 % 256
    return spark.table("part").select("p_partkey", F.round(colour.contrast([r, g_, b], [255 - r, (g_ * 3) % 256, b]), 6).alias("contrast"))


@query("SELECT DISTINCT o_totalprice AS value, rtrim(rtrim(printf('%.3f', o_totalprice), '0'), '.') AS text, floor(o_totalprice / 0.25 + 0.5) * 0.25 AS on_grid FROM orders")
def number_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8 and the evaluator's grid."""
    pj.tables(spark, sf_dir, "orders")
    v = spark.table("orders").select(F.col("o_totalprice").alias("value")).distinct()
    return v.select("value", short_number(F.col("value")).alias("text"), floor_grid(F.col("value"), 0.25).cast("double").alias("on_grid"))


@query()
def content_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashes of canonical JSON (no SQL form; held against golden values)."""
    pj.tables(spark, sf_dir, "events")
    return spark.table("events").select("event_id", content_hash("props").alias("content_hash"))


@query()
def pull_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Viewpoints, pulled back where walls are too close (no SQL form)."""
    model = comp.compile_model(normalize.normalize(pj.rect_plans(spark, sf_dir)))
    views, _ = camera.place_viewpoints(model)
    return views.select("plan_id", "id", "room_id", F.round("position.x", 6).alias("x"), F.round("position.y", 6).alias("y"))


@query()
def projection_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hash of each plan's canonical projection (no SQL form)."""
    return normalize.projection(normalize.normalize(pj.rect_plans(spark, sf_dir)))
