"""Manual annotations of raster plans, as JSON documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.canonical import content_hash
from plumbline.operators.findings import finding, union
from plumbline.sources.tables import Plans

SCHEMA = """struct<schema_id: string, schema_version: string, artifact_id: string, project_id: string, content_hash: string, payload: struct<
 image: struct<source_image_ref: string, sha256: string, width_px: int, height_px: int>, scale_m_per_px: double,
 walls: array<struct<start_px: array<double>, end_px: array<double>>>, rooms: array<struct<polygon_px: array<array<double>>>>,
 openings: array<struct<type: string, wall_index: int, center_px: array<double>, width_m: double>>,
 declared_dimensions: array<struct<a_px: array<double>, b_px: array<double>, length_m: double>>>>"""


def _point(p: Column) -> Column:
    return F.struct(p[0].alias("x"), p[1].alias("y"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """plan_id, json of every document under the path."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("json"))
    return files.select(F.regexp_extract("path", r"([^/]+)\.json$", 1).alias("plan_id"), "json")


def parse(documents: DataFrame, images: DataFrame | None = None) -> Plans:
    """documents: plan_id, json.  images: plan_id, sha256, width, height, kind of the
    image in the inventory; a document must agree with it."""
    d = documents.withColumn("d", F.from_json("json", SCHEMA)).withColumn("p", F.col("d.payload")).withColumn("hash", content_hash("json"))
    whole = F.col("p").isNotNull() & F.col("p.image").isNotNull() & F.col("p.walls").isNotNull() & F.col("p.rooms").isNotNull() & F.col("p.openings").isNotNull()
    parts = [finding(d.where(~F.coalesce(whole, F.lit(False))), "PARSE_SOURCE_UNSUPPORTED", "annotation is not valid"), finding(d.where(whole & (F.col("d.content_hash") != F.col("hash"))), "PARSE_SOURCE_HASH_MISMATCH", "annotation content hash differs")]
    d = d.where(whole & F.coalesce(F.col("d.content_hash") == F.col("hash"), F.lit(True)))
    if images is not None:
        j = d.join(images, "plan_id", "left")
        agrees = F.coalesce((F.regexp_replace("p.image.sha256", "^sha256:", "") == F.regexp_replace("sha256", "^sha256:", "")) & (F.col("p.image.width_px") == F.col("width")) & (F.col("p.image.height_px") == F.col("height")) & F.col("kind").isin("floorplan", "floorplan_page"), F.lit(False))
        parts.append(finding(j.where(~agrees), "PARSE_SOURCE_HASH_MISMATCH", "annotation and image differ"))
        d = j.where(agrees)
    scale = F.col("p.scale_m_per_px")
    parts.append(finding(d.where(scale.isNull() | (scale <= 0)), "PARSE_SCALE_UNKNOWN", "annotation has no scale"))
    d = d.where(scale > 0)
    each = lambda name: d.select("plan_id", F.posexplode(f"p.{name}").alias("idx", "v"))
    ref = lambda name: F.concat(F.lit(f"{name}["), F.col("idx").cast("string"), F.lit("]")).alias("source_ref")
    none = F.lit(None).cast("array<struct<x: double, y: double>>")
    return Plans(
        d.select("plan_id", F.lit("raster").alias("kind"), scale.alias("unit_scale_m"), F.lit(True).alias("y_down"), F.col("p.image.height_px").alias("height_px"), F.lit("px").alias("source_units")),
        each("walls").select("plan_id", "idx", ref("walls"), _point(F.col("v.start_px")).alias("start"), _point(F.col("v.end_px")).alias("end")),
        each("rooms").select("plan_id", "idx", ref("rooms"), F.transform("v.polygon_px", _point).alias("polygon")),
        each("openings").select("plan_id", "idx", ref("openings"), F.col("v.type").alias("kind"), _point(F.col("v.center_px")).alias("center"), F.col("v.width_m").alias("width_m"), none.alias("span"), F.col("v.wall_index").alias("wall_index")),
        each("declared_dimensions").select("plan_id", "idx", ref("declared_dimensions"), _point(F.col("v.a_px")).alias("a"), _point(F.col("v.b_px")).alias("b"), F.col("v.length_m").alias("declared_length_m")),
        union(parts),
    )
