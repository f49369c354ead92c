"""Stage borders: tables that later steps read more than once are written to the
checkpoint folder, so each is computed once, its lineage ends there and a lost
executor costs no more than a read."""

from __future__ import annotations

from dataclasses import fields, is_dataclass, replace

from pyspark.sql import DataFrame


def settled(value):
    """A DataFrame, or all of a dataclass's or tuple's, as checkpoints."""
    if isinstance(value, DataFrame):
        spark = value.sparkSession
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir"))
        return value.checkpoint()
    if is_dataclass(value):
        return replace(value, **{f.name: settled(getattr(value, f.name)) for f in fields(value) if isinstance(getattr(value, f.name), DataFrame)})
    return tuple(settled(v) for v in value)
