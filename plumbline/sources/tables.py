"""The tables that describe raw plans, however they were drawn."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POINT = "struct<x: double, y: double>"
FRAME = "plan_id string, kind string, unit_scale_m double, y_down boolean, height_px int, source_units string"
WALL = f"plan_id string, idx int, source_ref string, start {POINT}, end {POINT}"
ROOM = f"plan_id string, idx int, source_ref string, polygon array<{POINT}>"
OPENING = f"plan_id string, idx int, source_ref string, kind string, center {POINT}, width_m double, span array<{POINT}>, wall_index int"
DIMENSION = f"plan_id string, idx int, source_ref string, a {POINT}, b {POINT}, declared_length_m double"
FINDING = "plan_id string, code string, severity string, tier int, source_ref string, message string"


@dataclass(frozen=True)
class Plans:
    """Raw geometry of many plans; `finding` holds what the source reported."""

    frame: DataFrame
    wall: DataFrame
    room: DataFrame
    opening: DataFrame
    dimension: DataFrame
    finding: DataFrame


def plans(spark: SparkSession, frame=(), wall=(), room=(), opening=(), dimension=(), finding=()) -> Plans:
    """Plans from literal rows."""


    def make(rows, schema: str) -> DataFrame:
        # Known to be empty when it is: the optimizer then drops what reads it.
        return spark.createDataFrame(list(rows), schema) if rows else spark.createDataFrame([], schema).where(F.lit(False))

    return Plans(make(frame, FRAME), make(wall, WALL), make(room, ROOM), make(opening, OPENING), make(dimension, DIMENSION), make(finding, FINDING))


def together(*many: Plans) -> Plans:
    return Plans(*(reduce(DataFrame.unionByName, [getattr(p, f) for p in many]) for f in Plans.__dataclass_fields__))
