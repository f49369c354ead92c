"""Findings: the fixed codes with severity and tier, their order and roll-up."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Code, severity, tier.
PARSE = {
    "PARSE_SOURCE_UNSUPPORTED": ("error", 0),
    "PARSE_SOURCE_HASH_MISMATCH": ("error", 0),
    "PARSE_RESOURCE_LIMIT": ("error", 0),
    "PARSE_TIMEOUT": ("error", 0),
    "PARSE_UNITS_MISMATCH": ("error", 1),
    "PARSE_UNSUPPORTED_FEATURE": ("error", 1),
    "PARSE_SCALE_UNKNOWN": ("error", 1),
    "PARSE_EMPTY_GEOMETRY": ("error", 2),
    "PARSE_DUPLICATE_ENTITY": ("error", 2),
    "PARSE_OPEN_POLYGON": ("error", 3),
    "PARSE_SELF_INTERSECTING_POLYGON": ("error", 3),
    "PARSE_DEGENERATE_WALL": ("error", 3),
    "PARSE_UNKNOWN_WALL_REF": ("error", 3),
    "PARSE_AMBIGUOUS_WALL_REF": ("error", 3),
    "PARSE_OPENING_OFF_WALL": ("error", 3),
    "PARSE_OPENING_WIDTH_EXCEEDS_WALL": ("error", 3),
    "PARSE_DIMENSION_INCONSISTENT": ("error", 3),
    "PARSE_LOW_CONFIDENCE": ("warn", 4),
    "PARSE_UNMAPPED_SOURCE_ENTITY": ("warn", 4),
    "PARSE_ROOM_BOUNDARY_UNMATCHED": ("warn", 4),
}
GEOMETRY = {
    "GEOM_SOURCE_HASH_MISMATCH": ("error", 0),
    "GEOM_RESOURCE_LIMIT": ("error", 0),
    "GEOM_EMPTY_GEOMETRY": ("error", 2),
    "GEOM_DUPLICATE_ENTITY": ("error", 2),
    "GEOM_OPEN_POLYGON": ("error", 3),
    "GEOM_SELF_INTERSECTING_POLYGON": ("error", 3),
    "GEOM_DEGENERATE_WALL": ("error", 3),
    "GEOM_OPENING_UNRESOLVED_WALL": ("error", 3),
    "GEOM_OPENING_AMBIGUOUS_WALL_REF": ("error", 3),
    "GEOM_OPENING_OFF_WALL": ("error", 3),
    "GEOM_OPENING_WIDTH_EXCEEDS_WALL": ("error", 3),
    "GEOM_OPENING_ABOVE_WALL": ("error", 3),
    "GEOM_OPEN_ROOM_BOUNDARY": ("warn", 4),
}
CAMERA = {
    "CAM_SOURCE_HASH_MISMATCH": ("error", 0),
    "CAM_RESOURCE_LIMIT": ("error", 0),
    "CAM_EMPTY_GEOMETRY": ("error", 2),
    "CAM_DUPLICATE_ENTITY": ("error", 2),
    "CAM_UNCOVERED_ROOM": ("error", 3),
    "CAM_VIEWPOINT_OUTSIDE_ROOM": ("error", 3),
    "CAM_VIEWPOINT_COLLIDES_WALL": ("error", 3),
    "CAM_VIEWPOINT_COLLIDES_OPENING": ("error", 3),
    "CAM_EXTRINSICS_INVALID": ("error", 3),
    "CAM_CAMERA_HEIGHT_OUT_OF_RANGE": ("error", 3),
    "CAM_MAP_ADJACENCY_UNRESOLVED": ("warn", 4),
}
SPECS = {**PARSE, **GEOMETRY, **CAMERA}
COLUMNS = ("plan_id", "code", "severity", "tier", "source_ref", "message")


def finding(df: DataFrame, code: str, message: str, ref: Column | None = None) -> DataFrame:
    """One finding for each row of df (plan_id and what `ref` needs)."""
    severity, tier = SPECS[code]
    ref = F.lit(None).cast("string") if ref is None else ref.cast("string")
    return df.select("plan_id", F.lit(code).alias("code"), F.lit(severity).alias("severity"), F.lit(tier).alias("tier"), ref.alias("source_ref"), F.lit(message).alias("message"))


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def distinct(findings: DataFrame) -> DataFrame:
    return findings.dropDuplicates(["plan_id", "code", "source_ref", "message"])


def order(stage: str = "parse") -> list[Column]:
    """Precedence within a plan: tier, code, reference (none first), message."""
    return [F.col("tier"), F.col("code"), F.coalesce("source_ref", F.lit("")), F.col("message")]


def precedence(findings: DataFrame) -> DataFrame:
    """Distinct findings with their position within the plan."""
    from pyspark.sql import Window

    return distinct(findings).withColumn("ord", F.row_number().over(Window.partitionBy("plan_id").orderBy(*order())))


def terminal(findings: DataFrame) -> DataFrame:
    """The first finding of each plan, without a sort of all of them."""
    first = F.min(F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order())], F.col("severity"), F.col("source_ref")))
    return findings.groupBy("plan_id").agg(first.alias("f")).select("plan_id", F.col("f.k1").alias("code"), F.col("f.severity").alias("severity"), F.col("f.k0").alias("tier"), F.col("f.source_ref").alias("source_ref"), F.col("f.k3").alias("message"))


def rollup(plans: DataFrame, findings: DataFrame, warnings_matter: bool = True) -> DataFrame:
    """plan_id, n_errors, n_warnings, status, exit_code.  The camera stage stays
    complete with warnings (warnings_matter=False)."""
    n = distinct(findings).groupBy("plan_id").agg(F.count_if(F.col("severity") == "error").alias("n_errors"), F.count_if(F.col("severity") == "warn").alias("n_warnings"))
    out = plans.select("plan_id").distinct().join(n, "plan_id", "left").fillna(0, ["n_errors", "n_warnings"])
    warns = (F.col("n_warnings") > 0) & F.lit(warnings_matter)
    status = F.when(F.col("n_errors") > 0, "failed").when(warns, "partial").otherwise("complete")
    code = F.when(F.col("n_errors") > 0, 3).when(warns, 1).otherwise(0)
    return out.select("plan_id", "n_errors", "n_warnings", status.alias("status"), code.alias("exit_code"))


def report(findings: DataFrame) -> DataFrame:
    """Findings counted by plan and code."""
    return distinct(findings).groupBy("plan_id", "code", "severity", "tier").agg(F.count("*").alias("n"))


def spec_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(c, s, t) for c, (s, t) in SPECS.items()], "code string, severity string, tier int")
