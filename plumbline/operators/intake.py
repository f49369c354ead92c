"""Intake of projects and the checks before a parse run.

files: project, path, kind (role in the inventory), content, length;
declared: project, path, sha256, kind; manifests and quality reports as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.operators.contracts import compare_hashes, safe_path, valid_run_id
from plumbline.operators.findings import union
from plumbline.sources import dxf, png

MAX_BYTES, MAX_PIXELS, PDF_PAGES = 250 * 1024 * 1024, 100_000_000, (1, 20)
EXTENSIONS = {"png": ("png",), "jpg": ("jpg", "jpeg"), "pdf": ("pdf",), "dxf": ("dxf",), "dwg": ("dwg",)}
RASTER, DRAWING = ("png", "jpg", "pdf"), ("dxf", "dwg")


def jpeg_size(content: Column) -> Column:
    """width and height of a JPEG from its first frame header, else null."""
    text = F.hex(content)
    at = F.regexp_instr(text, F.lit("FFC[0-2]0011[0-9A-F]{10}"))
    number = lambda k: F.conv(F.substring(text, F.when(at > 0, at + k).otherwise(F.lit(1)), F.lit(4)), 16, 10).cast("int")
    return F.when(at > 0, F.struct(number(14).alias("width"), number(10).alias("height")))


def inspect(files: DataFrame) -> DataFrame:
    """files (project, path, content, length) with format, size in pixels and what is
    wrong: the bytes must be what the name says, and within the limits."""
    kind = png.kind(F.col("content"))
    suffix = F.lower(F.substring_index("path", ".", -1))
    wanted = F.lit(None).cast("string")
    for k, names in EXTENSIONS.items():
        wanted = F.when(suffix.isin(*names), F.lit(k)).otherwise(wanted)
    f = files.withColumn("format", kind).withColumn("wanted", wanted)
    size = F.when(F.col("format") == "png", F.struct(png.header(F.col("content"))["width"].cast("int").alias("width"), png.header(F.col("content"))["height"].cast("int").alias("height"))).when(F.col("format") == "jpg", jpeg_size(F.col("content")))
    pages = F.when(F.col("format") == "pdf", F.regexp_count(F.decode("content", "ISO-8859-1"), F.lit(r"/Type\s*/Page[^s]")))
    f = f.withColumn("size", size).withColumn("pages", pages)
    fault = (
        F.when(F.col("length") > MAX_BYTES, "TOO_LARGE")
        .when(~safe_path(F.col("path")), "UNSAFE_PATH")
        .when(F.col("wanted").isNull(), "UNSUPPORTED_EXTENSION")
        .when(F.col("format").isNull() | (F.col("format") != F.col("wanted")), "FORMAT_MISMATCH")
        .when(F.col("size.width").cast("long") * F.col("size.height") > MAX_PIXELS, "TOO_MANY_PIXELS")
        .when(~F.col("pages").between(*PDF_PAGES), "PAGE_COUNT")
    )
    return f.withColumn("fault", fault).drop("wanted")


def drawing_units(files: DataFrame) -> DataFrame:
    """project, path and the units that a drawing states, or null."""
    d = files.where("format = 'dxf'").select(F.concat_ws("|", "project", "path").alias("plan_id"), F.decode("content", "ISO-8859-1").alias("text"))
    u = dxf.units(dxf.tags(d))
    return u.select(F.substring_index("plan_id", "|", 1).alias("project"), F.expr("substring(plan_id, instr(plan_id, '|') + 1)").alias("path"), F.col("source_units").alias("units"))


def quality(files: DataFrame, given: DataFrame) -> DataFrame:
    """given: project, m_per_px, units.  A raster's scale is known if it is given, a
    drawing's if its units are stated or given; an unknown one blocks packaging."""
    stated = drawing_units(files).groupBy("project").agg(F.first("units", ignorenulls=True).alias("stated"))
    plan = files.where("kind = 'floorplan' and fault is null").select("project", "format")
    j = plan.join(given, "project", "left").join(stated, "project", "left")
    known = F.coalesce(F.when(F.col("format").isin(*RASTER), F.col("m_per_px") > 0).otherwise(F.coalesce("units", "stated").isin("mm", "cm", "m")), F.lit(False))
    return j.select("project", known.alias("scale_known"), F.coalesce("units", "stated").alias("units"), F.when(known, "complete").otherwise("partial").alias("status"), F.when(~known, F.lit("INPUT_SCALE_UNKNOWN")).alias("blocker"))


def preflight(runs: DataFrame, declared: DataFrame, actual: DataFrame, reports: DataFrame) -> DataFrame:
    """runs: project, run_id.  What keeps a run from being parsed: its id, the files'
    hashes and paths, the number of floor plans, and the quality report."""
    fault = lambda df, code: df.select("project", F.lit(code).alias("fault")).distinct()
    plans = runs.select("project").join(declared.where(F.col("kind").isin("floorplan", "floorplan_page")), "project", "left").groupBy("project").agg(F.count("path").alias("n"))
    parts = [
        fault(runs.where(~valid_run_id(F.col("run_id"))), "RUN_ID"),
        fault(declared.where(~safe_path(F.col("path"))), "UNSAFE_PATH"),
        fault(declared.groupBy("project", "path").count().where("count > 1"), "DUPLICATE_PATH"),
        fault(compare_hashes(declared, actual, "project", "path"), "HASH_MISMATCH"),
        fault(plans.where("n <> 1"), "FLOORPLAN_COUNT"),
        fault(runs.join(reports.where("status = 'complete' and blocker is null"), "project", "left_anti"), "QUALITY"),
    ]
    return union(parts)


def units_agree(frames: DataFrame, manifests: DataFrame) -> DataFrame:
    """frames: plan_id, kind, source_units, unit_scale_m; manifests: plan_id, units,
    m_per_px.  Plans whose units or scale aren't the manifest's, compared as decimals."""
    j = frames.join(manifests, "plan_id", "left")
    exact = lambda c: F.col(c).cast("string").try_cast("decimal(30,15)")
    bad = F.when(F.col("kind") == "dxf", ~F.coalesce(F.col("units") == F.col("source_units"), F.lit(False))).otherwise(~F.coalesce(exact("m_per_px") == exact("unit_scale_m"), F.lit(False)))
    from plumbline.operators.findings import finding

    return finding(j.where(bad), "PARSE_UNITS_MISMATCH", "units or scale differ from the manifest")
