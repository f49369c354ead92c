"""Scene packages in folders, read as the tables of operators.package.Scenes."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.package import Scenes
from plumbline.sources import png


def map_faults(maps: DataFrame) -> DataFrame:
    """maps: scene, map_file, json.  A document with a duplicate key parses as a
    map and not as a variant; one that is neither isn't valid."""
    entries = F.from_json("json", "map<string, array<string>>")
    typed = F.coalesce(F.size(entries) > 0, F.lit(False)) & F.forall(F.map_values(entries), lambda v: v.isNotNull() & F.forall(v, lambda x: x.isNotNull()))
    strings = F.coalesce(~F.exists(F.map_values(F.from_json("json", "map<string, string>")), lambda v: ~v.startswith("[")), F.lit(False))
    strict = F.try_parse_json("json").isNotNull()
    fault = F.when(F.coalesce(typed, F.lit(False)) & ~strict, "DUPLICATE_MAP_KEY").when(~F.coalesce(typed & strings, F.lit(False)), "MAP_JSON_INVALID")
    return maps.withColumn("fault", fault)


def map_entries(maps: DataFrame) -> DataFrame:
    """Entries of the maps without fault, in their order."""
    good = map_faults(maps).where("fault is null").withColumn("m", F.from_json("json", "map<string, array<string>>"))
    return good.select("scene", "map_file", F.posexplode(F.map_entries("m")).alias("pos", "e")).select("scene", "map_file", "pos", F.col("e.key").alias("key"), F.col("e.value").alias("values"))


def matrices(texts: DataFrame) -> DataFrame:
    """texts: scene, viewpoint, text.  Matrices in row order; null if not numbers
    or not rows of one length."""
    lines = F.filter(F.transform(F.split("text", r"\r?\n"), lambda l: F.trim(F.regexp_replace(l, "#.*$", ""))), lambda l: l != "")
    rows = F.transform(lines, lambda l: F.transform(F.split(l, r"\s+"), lambda v: v.try_cast("double")))
    even = F.size(F.array_distinct(F.transform(rows, F.size))) == 1
    sound = F.coalesce(even & F.forall(F.flatten(rows), lambda v: v.isNotNull()), F.lit(False))
    return texts.select("scene", "viewpoint", F.when(sound, F.flatten(rows)).alias("matrix"), F.size(rows).alias("n_rows"))


def read(spark: SparkSession, root: str, config: DataFrame | None = None) -> Scenes:
    """Packages under root/<scene>/: map*.json and viewpoints/<name>/<file>.
    Contents come only for the files that are parsed."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    inside = F.regexp_extract("path", rf"{root.split('://')[-1].rstrip('/')}/+(.*)$", 1)
    files = files.withColumn("rel", inside).withColumn("scene", F.substring_index("rel", "/", 1)).withColumn("path", F.expr("substring(rel, length(scene) + 2)"))
    view = F.nullif(F.regexp_extract("path", r"^viewpoints/([^/]+)/", 1), F.lit(""))
    files = files.withColumn("viewpoint", view).withColumn("name", F.substring_index("path", "/", -1))
    file = files.select("scene", "viewpoint", "name", "path", F.col("length").alias("size"))
    # Spark skips empty files; its own listing, which the driver holds, has them.
    base = root.split("://")[-1].rstrip("/") + "/"
    listed = [unquote(p).split(base, 1)[-1].lstrip("/") for p in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).inputFiles()]
    every = spark.createDataFrame([(p,) for p in listed], "rel string").withColumn("scene", F.substring_index("rel", "/", 1)).withColumn("path", F.expr("substring(rel, length(scene) + 2)"))
    empty = every.join(file, ["scene", "path"], "left_anti").select("scene", view.alias("viewpoint"), F.substring_index("path", "/", -1).alias("name"), "path", F.lit(0).cast("long").alias("size"))
    file = file.unionByName(empty)
    maps = files.where(F.col("path").rlike(r"^map[^/]*\.json$")).select("scene", F.col("path").alias("map_file"), F.try_validate_utf8(F.col("content").cast("string")).alias("json"))
    of = lambda name: files.where(F.col("name") == name).where("viewpoint is not null")
    text = lambda name: of(name).select("scene", "viewpoint", F.try_validate_utf8(F.col("content").cast("string")).alias("text"))
    images = of("place_image.png").unionByName(of("place_depth.png")).withColumn("h", png.header(F.col("content")))
    image = images.select("scene", "viewpoint", "name", png.mode(F.col("h")).alias("mode"), F.col("h.width").alias("width"), F.col("h.height").alias("height"))
    scene = file.groupBy("scene").agg(F.bool_or(F.col("path").startswith("viewpoints/")).alias("has_views"))
    none = spark.createDataFrame([], "scene string, start_image string, pano_image_name string, max_views int")
    return Scenes(scene, file, map_faults(maps).select("scene", "map_file", "fault"), map_entries(maps), matrices(text("extrinsics.txt")), image, png.histograms(of("place_depth.png"), "scene", "viewpoint"), text("place_depth_scale.txt").withColumnRenamed("text", "raw"), config if config is not None else none)
