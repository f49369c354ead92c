"""Plans made from the star-schema tables, by integer arithmetic alone, so that
any engine makes the same ones.  The SQL is common to Spark and the oracle.

A plan is an order; its walls are its line items (one for each line number), its
openings the returned ones, its rooms rectangles in the plan of a customer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.sources.tables import Plans

ITEMS = """SELECT l_orderkey, l_linenumber, min(l_partkey) AS p, min(l_suppkey) AS s, min(CAST(l_quantity AS INT)) AS q, max(l_returnflag) AS f
FROM lineitem GROUP BY l_orderkey, l_linenumber"""
WALLS = f"""SELECT CAST(l_orderkey AS STRING) AS plan_id, l_linenumber AS idx, CAST(p % 97 * 100 AS BIGINT) AS x1, CAST(s % 89 * 100 AS BIGINT) AS y1,
CAST(p % 97 * 100 + (q % 7) * 500 AS BIGINT) AS x2, CAST(s % 89 * 100 + ((p + s) % 3) * 250 AS BIGINT) AS y2, f FROM ({ITEMS}) i"""
RECTS = """SELECT CAST(o_custkey AS STRING) AS plan_id, CAST(o_orderkey AS BIGINT) AS idx, CAST((o_orderkey % 7) * 900 AS BIGINT) AS x0, CAST((o_orderkey % 5) * 700 AS BIGINT) AS y0,
CAST(1000 + (o_orderkey % 11) * 300 AS BIGINT) AS w, CAST(1000 + (o_orderkey % 3) * 400 AS BIGINT) AS h FROM orders"""


def tables(spark: SparkSession, sf_dir: str, *names: str) -> None:
    for name in names:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)


def empty(spark: SparkSession) -> Plans:
    from plumbline.sources import tables as t

    return t.plans(spark)


def _dealt(df: DataFrame) -> DataFrame:
    """By plan, as all that follows joins by plan: rows are few bytes and much work,
    so the number of tasks isn't left to their size."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "plan_id")


def _frame(df: DataFrame) -> DataFrame:
    return df.select("plan_id").distinct().select("plan_id", F.lit("dxf").alias("kind"), F.lit(0.001).alias("unit_scale_m"), F.lit(False).alias("y_down"), F.lit(None).cast("int").alias("height_px"), F.lit("mm").alias("source_units"))


def _point(x: str, y: str):
    return F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))


def wall_plans(spark: SparkSession, sf_dir: str, openings: bool = False) -> Plans:
    tables(spark, sf_dir, "lineitem")
    w = _dealt(spark.sql(WALLS))
    none = empty(spark)
    wall = w.select("plan_id", F.col("idx").cast("int").alias("idx"), F.concat(F.lit("l"), F.col("idx").cast("string")).alias("source_ref"), _point("x1", "y1").alias("start"), _point("x2", "y2").alias("end"))
    opening = none.opening
    if openings:
        mid = F.struct(((F.col("x1") + F.col("x2")) / 2).alias("x"), ((F.col("y1") + F.col("y2")) / 2).alias("y"))
        opening = w.where("f = 'R'").select("plan_id", F.col("idx").cast("int").alias("idx"), F.concat(F.lit("o"), F.col("idx").cast("string")).alias("source_ref"), F.lit("door").alias("kind"), mid.alias("center"), F.lit(0.9).alias("width_m"), F.lit(None).cast("array<struct<x: double, y: double>>").alias("span"), F.lit(None).cast("int").alias("wall_index"))
    return Plans(_frame(w), wall, none.room, opening, none.dimension, none.finding)


def rect_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """plan_id, idx and the ring of each rectangle, some turned the other way and
    all started at one of four corners."""
    tables(spark, sf_dir, "orders")
    r = _dealt(spark.sql(RECTS))
    p = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    x0, y0, x1, y1 = F.col("x0"), F.col("y0"), F.col("x0") + F.col("w"), F.col("y0") + F.col("h")
    ring = F.array(p(x0, y0), p(x1, y0), p(x1, y1), p(x0, y1))
    k = (F.col("idx") % 4).cast("int")
    ring = F.concat(F.slice(ring, k + 1, F.lit(4)), F.slice(ring, F.lit(1), k))
    return r.select("plan_id", "idx", F.when(F.col("idx") % 2 == 0, ring).otherwise(F.reverse(ring)).alias("polygon"))


def rect_plans(spark: SparkSession, sf_dir: str) -> Plans:
    """Rooms, with a wall along each of their edges."""
    r = rect_rings(spark, sf_dir)
    none = empty(spark)
    room = r.select("plan_id", F.col("idx").cast("int").alias("idx"), F.concat(F.lit("r"), F.lpad(F.col("idx").cast("string"), 10, "0")).alias("source_ref"), "polygon")
    from plumbline.functions.geometry import ring_edges

    edge = r.select("plan_id", "idx", F.posexplode(ring_edges(F.col("polygon"))).alias("k", "e"))
    wall = edge.select("plan_id", (F.col("idx") * 4 + F.col("k")).cast("int").alias("idx"), F.concat(F.lit("w"), (F.col("idx") * 4 + F.col("k")).cast("string")).alias("source_ref"), F.col("e.a").alias("start"), F.col("e.b").alias("end"))
    return Plans(_frame(r), wall, room, none.opening, none.dimension, none.finding)
