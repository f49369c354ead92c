"""Validation of scene packages, many at once.

Inputs (see plumbline.sources.scenes): files (scene, path, size), maps (scene,
map_file, pos, key, values), extrinsics, images, depths, scales, config.  Every
check is a query; findings are rows (scene, code, path, message)."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.matrix import extrinsics_codes

REQUIRED = ("extrinsics.txt", "place_image.png", "place_depth.png", "place_depth_scale.txt")
# Codes that report but never fail a package.
WARNINGS = (
    "VIEWPOINT_NOT_IN_MAP",
    "DUPLICATE_VIEWPOINT_IN_MAP",
    "NONSTANDARD_WORLD_CONVENTION",
    "CAMERA_HEIGHT_OUTLIER",
    "CAMERA_POSITION_OUTLIER",
    "VIEWPOINTS_TOO_CLOSE",
    "ODD_DIMENSIONS",
    "DEPTH_RANGE_IMPLAUSIBLE",
    "DEPTH_SCALE_SATURATED",
    "VRAM_BUDGET_WARNING",
)
RESERVED = r"(?i)^(CON|PRN|AUX|NUL|COM[1-9]|LPT[1-9])$"
TOO_CLOSE_M = 0.2


@dataclass(frozen=True)
class Scenes:
    scene: DataFrame  # scene, has_views
    file: DataFrame  # scene, viewpoint, name, path, size
    map_file: DataFrame  # scene, map_file, fault (null: readable)
    map_entry: DataFrame  # scene, map_file, pos, key, values
    extrinsics: DataFrame  # scene, viewpoint, matrix (null: unreadable), n_rows
    image: DataFrame  # scene, viewpoint, name, mode, width, height (mode null: unreadable)
    depth: DataFrame  # scene, viewpoint, v, n: histogram of depth values
    scale: DataFrame  # scene, viewpoint, raw
    config: DataFrame  # scene, start_image, pano_image_name, max_views


def safe_name(name: Column) -> Column:
    """No reserved device name, and no dot or space at the end."""
    stem = F.element_at(F.split(name, r"\.", 2), 1)
    return F.coalesce((name != "") & ~name.rlike(r"[. ]$") & ~stem.rlike(RESERVED), F.lit(False))


def _found(df: DataFrame, code, path: Column, message: str) -> DataFrame:
    code = F.lit(code) if isinstance(code, str) else code
    return df.select("scene", code.alias("code"), path.alias("path"), F.lit(message).alias("message"))


def traversals(entries: DataFrame) -> DataFrame:
    """Nodes that each map visits: its keys and all its values."""
    return entries.groupBy("scene", "map_file").agg((F.countDistinct("key") + F.sum(F.size("values"))).alias("nodes"))


def references(entries: DataFrame) -> DataFrame:
    """Names in the order in which a map visits them."""
    names = entries.select("scene", "map_file", "pos", F.posexplode(F.concat(F.array("key"), F.col("values"))).alias("k", "name"))
    order = Window.partitionBy("scene", "map_file", "name").orderBy("pos", "k")
    return names.withColumn("nth", F.row_number().over(order))


def close_pairs(points: DataFrame, distance: float = TOO_CLOSE_M) -> DataFrame:
    """points: scene, viewpoint, x, y, z.  Pairs nearer than the distance, through
    a grid: each point looks into the cells around it, so it is an equi-join."""
    cell = lambda c: F.floor(F.col(c) / F.lit(distance)).cast("long")
    p = points.select("scene", "viewpoint", "x", "y", "z", cell("x").alias("i"), cell("y").alias("j"), cell("z").alias("k"))
    steps = F.array(*[F.struct(*(F.lit(v).alias(n) for v, n in zip((a, b, c), "abc"))) for a in (-1, 0, 1) for b in (-1, 0, 1) for c in (-1, 0, 1)])
    q = p.withColumn("s", F.explode(steps)).select("scene", F.col("viewpoint").alias("other"), F.col("x").alias("ox"), F.col("y").alias("oy"), F.col("z").alias("oz"), (F.col("i") + F.col("s.a")).alias("i"), (F.col("j") + F.col("s.b")).alias("j"), (F.col("k") + F.col("s.c")).alias("k"))
    d = F.sqrt(F.pow(F.col("x") - F.col("ox"), 2) + F.pow(F.col("y") - F.col("oy"), 2) + F.pow(F.col("z") - F.col("oz"), 2))
    return p.join(q, ["scene", "i", "j", "k"]).where((F.col("viewpoint") < F.col("other")) & (d < distance)).select("scene", "viewpoint", "other")


def depth_statistics(depth: DataFrame, *by: str) -> DataFrame:
    """Share of zeros, and largest, median and saturated share of the rest, from
    a histogram (v, n): a running sum finds the median without sorting pixels."""
    total = depth.groupBy(*by).agg(F.sum("n").alias("pixels"), F.sum(F.when(F.col("v") == 0, F.col("n")).otherwise(0)).alias("zeros"), F.max(F.when(F.col("v") > 0, F.col("v"))).alias("largest"), F.sum(F.when(F.col("v") >= 65535, F.col("n")).otherwise(0)).alias("full"))
    run = depth.where("v > 0").withColumn("c", F.sum("n").over(Window.partitionBy(*by).orderBy("v").rowsBetween(Window.unboundedPreceding, 0)))
    run = run.join(total.select(*by, (F.col("pixels") - F.col("zeros")).alias("m")), list(by))
    at = lambda k: F.min(F.when(F.col("c") >= k, F.col("v")))
    mid = run.groupBy(*by).agg(((at(F.floor((F.col("m") + 1) / 2)) + at(F.floor(F.col("m") / 2) + 1)) / 2).alias("median"))
    out = total.join(mid, list(by), "left")
    valid = F.nullif(F.col("pixels") - F.col("zeros"), F.lit(0))
    return out.select(*by, (F.col("zeros") / F.col("pixels")).alias("zero_share"), "largest", "median", (F.col("full") / valid).alias("saturated_share"))


def validate(s: Scenes) -> DataFrame:
    """All findings: scene, code, severity, path, message."""
    scenes = s.scene.where("has_views")
    live = lambda df: df.join(scenes.select("scene"), "scene", "left_semi")
    parts = [_found(s.scene.where("not has_views"), "MISSING_VIEWPOINTS_DIR", F.lit("viewpoints"), "viewpoints directory is missing")]
    dirs = live(s.file.where("viewpoint is not null")).select("scene", "viewpoint").distinct()
    here = F.concat(F.lit("viewpoints/"), F.col("viewpoint"))
    parts.append(_found(dirs.where(~safe_name(F.col("viewpoint"))), "INVALID_FILENAME", here, "name is not portable"))
    parts.append(_found(live(s.file).where(F.col("name").isNotNull() & ~safe_name(F.col("name"))), "INVALID_FILENAME", F.col("path"), "name is not portable"))
    parts.append(_found(scenes.join(s.map_file, "scene", "left_anti"), "NO_MAP_FILE", F.lit("."), "no map file"))
    parts.append(_found(live(s.map_file).where("fault is not null"), F.col("fault"), F.col("map_file"), "map file is not valid"))
    entries = live(s.map_entry)
    first = entries.where("pos = 0")
    parts.append(_found(first.where("size(values) = 0"), "EMPTY_MAP_VALUES", F.col("map_file"), "the start key has no values"))
    refs = references(entries)
    parts.append(_found(refs.where("nth > 1"), "DUPLICATE_VIEWPOINT_IN_MAP", F.col("map_file"), "viewpoint is visited more than once"))
    on_disk = dirs.withColumnRenamed("viewpoint", "name")
    parts.append(_found(refs.join(on_disk, ["scene", "name"], "left_anti"), "MAP_REFERENCES_UNKNOWN_VIEWPOINT", F.col("map_file"), "no directory for a viewpoint"))
    mapped = dirs.join(refs.select("scene", F.col("name").alias("viewpoint")).distinct(), ["scene", "viewpoint"], "left_semi")
    parts.append(_found(dirs.join(mapped, ["scene", "viewpoint"], "left_anti"), "VIEWPOINT_NOT_IN_MAP", here, "no map references the directory"))

    wanted = mapped.withColumn("name", F.explode(F.array(*map(F.lit, REQUIRED))))
    have = s.file.select("scene", "viewpoint", "name", "size")
    at = F.concat(here, F.lit("/"), F.col("name"))
    state = wanted.join(have, ["scene", "viewpoint", "name"], "left")
    parts.append(_found(state.where("size is null"), "MISSING_REQUIRED_FILE", at, "required file missing"))
    parts.append(_found(state.where("size = 0"), "EMPTY_FILE", at, "file is empty"))
    present = state.where("size > 0").select("scene", "viewpoint", "name")
    of = lambda df, name: df.join(present.where(F.col("name") == name).select("scene", "viewpoint"), ["scene", "viewpoint"], "left_semi")
    file = lambda name: F.concat(here, F.lit(f"/{name}"))

    matrix = of(s.extrinsics, REQUIRED[0])
    parts.append(_found(matrix.where("matrix is null"), "MATRIX_PARSE_ERROR", file(REQUIRED[0]), "extrinsics can't be read"))
    shaped = matrix.where("matrix is not null")
    four = (F.col("n_rows") == 4) & (F.size("matrix") == 16)
    codes = F.when(four, extrinsics_codes(F.col("matrix"))).otherwise(F.array(F.lit("INVALID_MATRIX_SHAPE")))
    parts.append(_found(shaped.withColumn("c", F.explode(codes)), F.col("c"), file(REQUIRED[0]), "extrinsics check failed"))

    image = s.image.join(present, ["scene", "viewpoint", "name"], "left_semi")
    parts.append(_found(image.where("mode is null"), "IMAGE_UNREADABLE", at, "cannot open image"))
    good = image.where("mode is not null")
    colour, depth = good.where(F.col("name") == REQUIRED[1]), good.where(F.col("name") == REQUIRED[2])
    parts.append(_found(colour.where("mode <> 'RGB'").unionByName(depth.where(~F.col("mode").isin("I", "I;16"))), "INVALID_IMAGE_MODE", at, "unexpected image mode"))
    parts.append(_found(good.where("width <> 2 * height"), "INVALID_ASPECT_RATIO", at, "width must be twice the height"))
    parts.append(_found(good.where("width % 2 <> 0 or height % 2 <> 0"), "ODD_DIMENSIONS", at, "dimensions must be even"))
    size = colour.select("scene", "viewpoint", F.col("width").alias("w"), F.col("height").alias("h"))
    parts.append(_found(depth.join(size, ["scene", "viewpoint"]).where("width <> w or height <> h"), "DEPTH_RGB_DIMENSION_MISMATCH", at, "depth and image differ in size"))

    stats = depth_statistics(of(s.depth, REQUIRED[2]), "scene", "viewpoint")
    parts.append(_found(stats.where("zero_share > 0.5"), "DEPTH_MOSTLY_INVALID", file(REQUIRED[2]), "most depth pixels are invalid"))
    scale = of(s.scale, REQUIRED[3]).withColumn("v", F.trim("raw").try_cast("double"))
    sound = F.coalesce((F.col("v") > 0) & ~F.isnan("v") & (F.col("v") < float("inf")), F.lit(False))
    parts.append(_found(scale.where(~sound), "INVALID_DEPTH_SCALE", file(REQUIRED[3]), "must be a finite positive number"))
    # Bytes that aren't text (raw null) give a scale of no value, and so a range
    # that can't be plausible either.
    ranged = scale.where(sound | F.col("raw").isNull()).join(stats, ["scene", "viewpoint"]).where("largest is not null")
    within = F.coalesce((F.col("largest") / F.col("v")).between(0.05, 50.0) & (F.col("largest") / F.col("v") != 0.05) & (F.col("largest") / F.col("v") != 50.0) & (F.col("median") / F.col("v") > 0.1) & (F.col("median") / F.col("v") < 30.0), F.lit(False))
    parts.append(_found(ranged.where(~within), "DEPTH_RANGE_IMPLAUSIBLE", file(REQUIRED[3]), "depths are outside the plausible range"))
    parts.append(_found(ranged.where("saturated_share > 0.01"), "DEPTH_SCALE_SATURATED", file(REQUIRED[2]), "depths reach the ceiling"))

    place = shaped.where(four).select("scene", "viewpoint", *(F.get("matrix", F.lit(k)).alias(c) for k, c in ((3, "x"), (7, "y"), (11, "z"))))
    parts.append(_found(close_pairs(place), "VIEWPOINTS_TOO_CLOSE", here, "another viewpoint is too close"))
    start = first.join(s.config.where("start_image is not null"), "scene").select("scene", F.col("key").alias("viewpoint"), F.col("start_image").alias("name"))
    start = start.join(dirs, ["scene", "viewpoint"], "left_semi")
    parts.append(_found(start.join(have, ["scene", "viewpoint", "name"], "left_anti"), "START_IMAGE_MISSING", at, "start viewpoint lacks the start image"))
    nodes = traversals(entries)
    parts.append(_found(nodes.join(s.config, "scene").where("nodes > max_views"), "VIEWPOINT_BUDGET_EXCEEDED", F.col("map_file"), "too many nodes"))
    collide = mapped.join(s.config.select("scene", F.col("pano_image_name").alias("name")).where("name is not null"), "scene")
    collide = collide.join(s.map_entry.select("scene").distinct(), "scene", "left_semi")
    parts.append(_found(collide.join(have, ["scene", "viewpoint", "name"], "left_semi"), "PANO_NAME_COLLISION", at, "output name collides with an input"))
    wide = colour.groupBy("scene").agg(F.max("width").alias("w")).join(nodes.groupBy("scene").agg(F.max("nodes").alias("worst")), "scene")
    parts.append(_found(wide.where("w >= 2048 and worst >= 12"), "VRAM_BUDGET_WARNING", F.lit("."), "too many nodes at this width"))
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("severity", F.when(F.col("code").isin(*WARNINGS), "warn").otherwise("error"))


def summary(s: Scenes, findings: DataFrame) -> DataFrame:
    n = findings.groupBy("scene").agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warn").alias("warnings"))
    return s.scene.select("scene").join(n, "scene", "left").fillna(0).withColumn("ok", F.col("errors") == 0)
