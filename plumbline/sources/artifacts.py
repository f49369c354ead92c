"""Stored artifacts: enveloped JSON documents as tables.

A loader lifts the fields that a stage needs, and reports what breaks the limits
instead of failing; scale anchors count only for the image they were made for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.canonical import content_hash
from plumbline.operators.findings import finding, union

ENVELOPE = """struct<schema_id: string, schema_version: string, artifact_id: string, project_id: string, run_id: string, created_at: string,
 producer: struct<agent: string, provider: string, model: string, effort: string>, inputs: array<struct<artifact_id: string, content_hash: string>>,
 content_hash: string, status: string, errors: array<struct<code: string, message: string, path: string>>>"""
PARSED = """struct<rooms: array<struct<id: string, polygon: array<array<double>>, confidence: double>>, walls: array<struct<id: string, start: array<double>, end: array<double>, thickness_m: double, confidence: double>>,
 openings: array<struct<id: string, type: string, wall_id: string, center: array<double>, width_m: double, confidence: double>>>"""
LIMITS = {"walls": 20_000, "rooms": 5_000, "openings": 20_000}
MAX_VERTICES, MAX_COORDINATE_M = 10_000, 100_000.0


def read(spark: SparkSession, path: str) -> DataFrame:
    """path, json and the envelope's fields of every document under the path."""
    t = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("json"))
    return t.withColumn("e", F.from_json("json", ENVELOPE)).select("path", "json", "e.*", content_hash("json").alias("computed_hash"))


def envelope_faults(documents: DataFrame) -> DataFrame:
    """Documents that aren't intact, or failed without an error."""
    d = documents
    fault = F.when(F.col("schema_id").isNull(), "NOT_AN_ARTIFACT").when(~F.coalesce(F.col("content_hash") == F.col("computed_hash"), F.lit(False)), "HASH_MISMATCH").when(F.col("status").isin("partial", "failed") & (F.coalesce(F.size("errors"), F.lit(0)) < 1), "NO_ERRORS")
    return d.withColumn("fault", fault).where("fault is not null").select("path", "fault")


def lineage(documents: DataFrame) -> DataFrame:
    """Inputs of each artifact, and whether they are there as they were."""
    i = documents.select("artifact_id", F.explode("inputs").alias("i")).select("artifact_id", F.col("i.artifact_id").alias("input_id"), F.col("i.content_hash").alias("expected"))
    have = documents.select(F.col("artifact_id").alias("input_id"), F.col("content_hash").alias("found")).distinct()
    j = i.join(have, "input_id", "left")
    return j.select("artifact_id", "input_id", F.when(F.col("found").isNull(), "missing").when(F.col("found") != F.col("expected"), "changed").otherwise("intact").alias("state"))


def geometry(documents: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """documents: plan_id, json of parse artifacts.  Walls, rooms and openings, and
    findings for plans that break a limit (which give no geometry)."""
    d = documents.withColumn("p", F.from_json("json", f"struct<payload: {PARSED}>")["payload"])
    values = F.flatten(F.array(F.flatten(F.transform("p.walls", lambda w: F.concat(w["start"], w["end"]))), F.flatten(F.transform("p.rooms", lambda r: F.flatten(r["polygon"]))), F.flatten(F.transform("p.openings", lambda o: o["center"]))))
    finite = F.coalesce(F.forall(values, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) <= MAX_COORDINATE_M)), F.lit(False))
    over = F.lit(False)
    for k, most in LIMITS.items():
        over = over | (F.size(F.col(f"p.{k}")) > most)
    over = over | F.exists("p.rooms", lambda r: F.size(r["polygon"]) > MAX_VERTICES)
    empty = F.coalesce((F.size("p.walls") == 0) & (F.size("p.rooms") == 0), F.lit(True))
    d = d.withColumn("bad", F.coalesce(over, F.lit(False)) | ~finite).withColumn("empty", empty)
    found = union([finding(d.where("bad"), "GEOM_RESOURCE_LIMIT", "geometry breaks a limit"), finding(d.where("not bad and empty"), "GEOM_EMPTY_GEOMETRY", "no geometry")])
    d = d.where("not bad and not empty")
    at = lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))
    wall = d.select("plan_id", F.posexplode("p.walls").alias("ord", "w")).select("plan_id", "ord", F.col("w.id").alias("id"), at(F.col("w.start")).alias("start"), at(F.col("w.end")).alias("end"), F.col("w.thickness_m").alias("thickness_m"))
    room = d.select("plan_id", F.posexplode("p.rooms").alias("ord", "r")).select("plan_id", "ord", F.col("r.id").alias("id"), F.transform("r.polygon", at).alias("polygon"))
    opening = d.select("plan_id", F.posexplode("p.openings").alias("ord", "o")).select("plan_id", "ord", F.col("o.id").alias("id"), F.col("o.type").alias("type"), F.col("o.wall_id").alias("wall_id"), at(F.col("o.center")).alias("center"), F.col("o.width_m").alias("width_m"))
    return wall, room, opening, found


def scale_anchors(images: DataFrame, manifests: DataFrame) -> DataFrame:
    """images: plan_id, content; manifests: plan_id, json with raster_sha256 and
    anchors (id, real_length_m, span_px).  Anchors of another image don't count."""
    m = manifests.select("plan_id", F.from_json("json", "struct<raster_sha256: string, anchors: array<struct<id: string, real_length_m: double, span_px: double>>>").alias("m"))
    i = images.select("plan_id", F.concat(F.lit("sha256:"), F.sha2("content", 256)).alias("sha"))
    same = F.regexp_replace("m.raster_sha256", "^(sha256:)?", "sha256:") == F.col("sha")
    return m.join(i, "plan_id").where(same).select("plan_id", F.explode("m.anchors").alias("a")).select("plan_id", "a.*").where("span_px > 0 and real_length_m > 0")
