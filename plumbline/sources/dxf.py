"""ASCII drawings: lines to (group code, value) tags, tags to entities, entities
to plan tables.  Files are whole rows below a size limit; windows are by file.

Layers are <prefix>-WALL, -ROOM, -DOOR, -WINDOW, -DIM (and -PASSAGE in the exact
convention); the prefix is a parameter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.functions import arcs
from plumbline.functions import geometry as g
from plumbline.operators.findings import finding, union
from plumbline.sources.tables import Plans

MAX_BYTES, MAX_ENTITIES = 50 * 1024 * 1024, 200_000
UNITS = {4: ("mm", 0.001), 5: ("cm", 0.01), 6: ("m", 1.0)}
UNSUPPORTED = ("ARC", "SPLINE", "INSERT", "IMAGE", "OLE2FRAME")


def read(spark: SparkSession, path: str) -> DataFrame:
    """plan_id, text, bytes; files over the limit come without their text."""
    files = spark.read.format("binaryFile").load(path)
    name = F.regexp_extract("path", r"([^/]+)\.dxf$", 1).alias("plan_id")
    return files.select(name, F.when(F.col("length") <= MAX_BYTES, F.decode("content", "utf-8")).alias("text"), F.col("length").alias("bytes"))


def tags(files: DataFrame) -> DataFrame:
    """plan_id, entity_no, pos, code, value, section."""
    lines = F.split(F.regexp_replace("text", r"\r\n?", "\n"), "\n")
    pairs = lambda l: F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor(F.size(l) / 2) - 1).cast("int")), lambda k: F.struct(k.alias("pos"), F.trim(F.get(l, k * 2)).try_cast("int").alias("code"), F.trim(F.get(l, k * 2 + 1)).alias("value")))
    held = F.element_at(F.transform(F.array(lines), pairs), 1)
    exploded = files.where("text is not null").select("plan_id", F.explode(held).alias("t")).select("plan_id", "t.*").where("code is not null")
    # An entity starts at each code 0: its number is how many there were.
    w = Window.partitionBy("plan_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return exploded.withColumn("entity_no", F.sum((F.col("code") == 0).cast("int")).over(w))


def entities(t: DataFrame) -> DataFrame:
    """One row an entity of the ENTITIES section: kind, layer, layout, numbers by
    code in order, and extended data of the given application."""
    by = t.groupBy("plan_id", "entity_no").agg(F.array_sort(F.collect_list(F.struct("pos", "code", "value"))).alias("tags"))
    number = lambda code: F.transform(F.filter("tags", lambda x: (x["code"] == code) & x["value"].isNotNull()), lambda x: x["value"].try_cast("double"))
    text = lambda code: F.get(F.filter("tags", lambda x: x["code"] == code), F.lit(0))["value"]
    e = by.select("plan_id", "entity_no", text(0).alias("kind"), text(2).alias("name"), text(8).alias("layer"), F.coalesce(text(67).try_cast("int"), F.lit(0)).alias("paper"), text(5).alias("handle"), *(number(c).alias(f"c{c}") for c in (10, 20, 30, 11, 21, 31, 40, 42, 50, 51, 70, 38)), F.col("tags"))
    w = Window.partitionBy("plan_id").orderBy("entity_no").rowsBetween(Window.unboundedPreceding, 0)
    section = F.last(F.when(F.col("kind") == "SECTION", F.col("name")).when(F.col("kind") == "ENDSEC", F.lit("")), ignorenulls=True).over(w)
    return e.withColumn("section", section).where("section = 'ENTITIES' and kind <> 'SECTION'")


def units(t: DataFrame) -> DataFrame:
    """plan_id, source_units, unit_scale_m from the header; null if not stated."""
    w = Window.partitionBy("plan_id").orderBy("pos")
    v = t.withColumn("next", F.lead("value").over(w)).where("code = 9 and value = '$INSUNITS'")
    names = F.create_map(*[x for k, (n, _) in UNITS.items() for x in (F.lit(k), F.lit(n))])
    scales = F.create_map(*[x for k, (_, s) in UNITS.items() for x in (F.lit(k), F.lit(s))])
    code = F.col("next").try_cast("int")
    return v.select("plan_id", names[code].alias("source_units"), scales[code].alias("unit_scale_m"))


def opaque_names(rows: DataFrame, value: str, prefix: str) -> DataFrame:
    """Names as tokens, numbered by first appearance: prefix-0001 and so on."""
    first = rows.groupBy("plan_id", value).agg(F.min("entity_no").alias("at"))
    n = F.row_number().over(Window.partitionBy("plan_id").orderBy("at"))
    return first.select("plan_id", value, F.concat(F.lit(prefix + "-"), F.lpad(n.cast("string"), 4, "0")).alias("token"))


def thickness(tags_: Column, app: str) -> Column:
    """The first number (code 1040) of the application's extended data, if > 0."""
    at = F.array_position(F.transform(tags_, lambda x: F.coalesce((x["code"] == 1001) & (x["value"] == app), F.lit(False))), True)
    rest = F.when(at > 0, F.slice(tags_, at.cast("int") + 1, F.size(tags_)))
    own = F.filter(rest, lambda x: x["code"] == 1040)
    value = F.get(own, F.lit(0))["value"].try_cast("double")
    return F.when(value > 0, value)


def parse(files: DataFrame, prefix: str = "PLAN", exact: bool = False) -> Plans:
    """Plans of drawings.  exact: arcs are walls, rings may have bulges, thickness
    comes from extended data, and unknown layers are left out in silence."""
    t = tags(files)
    e = entities(t)
    known = [f"{prefix}-{k}" for k in ("WALL", "ROOM", "DOOR", "WINDOW", "DIM", *(("PASSAGE",) if exact else ()))]
    layer, kind = F.col("layer"), F.col("kind")
    role = F.when(layer.isin(*known), F.substring_index(layer, "-", -1))
    flat = F.coalesce((F.abs(F.get("c30", F.lit(0))) < 1e-12) & (F.abs(F.get("c31", F.lit(0))) < 1e-12), F.lit(True))
    closed = F.coalesce(F.get("c70", F.lit(0)).cast("int").bitwiseAND(F.lit(1)) == 1, F.lit(False))
    bulged = F.exists("c42", lambda b: F.abs(b) > 1e-12)
    e = e.withColumn("role", role).withColumn("closed", closed).withColumn("bulged", bulged).withColumn("flat", flat)
    bad = [k for k in UNSUPPORTED if not (exact and k == "ARC")]
    wall_kinds = ("LINE", "ARC") if exact else ("LINE",)
    fault = (
        F.when(F.col("paper") != 0, "entity outside the model layout")
        .when(kind.isin(*bad), "unsupported entity")
        .when(F.col("role").isNull(), None)
        .when(F.col("role") == "DIM", "dimensions are not supported")
        .when(kind.isin("TEXT", "MTEXT"), "text on a geometry layer")
        .when((F.col("role") == "WALL") & (~kind.isin(*wall_kinds) | ~F.col("flat")), "walls must be flat lines")
        .when(F.col("role").isin("DOOR", "WINDOW", "PASSAGE") & ((kind != "LINE") | ~F.col("flat")), "openings must be flat lines")
        .when((F.col("role") == "ROOM") & ((kind != "LWPOLYLINE") | ~F.col("closed")), "rooms must be closed polylines")
        .when((F.col("role") == "ROOM") & F.col("bulged") & F.lit(not exact), "rooms must not have bulges")
    )
    e = e.withColumn("fault", fault)
    ref = F.concat(F.col("kind"), F.lit(":"), F.coalesce("handle", F.col("entity_no").cast("string")))
    parts = [finding(e.where(F.col("fault") == m), "PARSE_UNSUPPORTED_FEATURE", m, ref) for m in ("entity outside the model layout", "unsupported entity", "dimensions are not supported", "text on a geometry layer", "walls must be flat lines", "openings must be flat lines", "rooms must be closed polylines", "rooms must not have bulges")]
    other = e.where("role is null and fault is null")
    if not exact:
        parts.append(finding(other.join(opaque_names(other, "layer", "unknown-layer"), ["plan_id", "layer"]), "PARSE_UNMAPPED_SOURCE_ENTITY", "entity on an unknown layer", F.col("token")))
    parts.append(finding(e.groupBy("plan_id").count().where(F.col("count") > MAX_ENTITIES), "PARSE_RESOURCE_LIMIT", "too many entities"))
    parts.append(finding(files.where(F.col("bytes") > MAX_BYTES), "PARSE_RESOURCE_LIMIT", "drawing exceeds the size limit"))
    u = units(t)
    frame = files.where("text is not null").select("plan_id").join(u, "plan_id", "left")
    parts.append(finding(frame.where("source_units is null"), "PARSE_SCALE_UNKNOWN", "drawing units are not known"))
    frame = frame.where("source_units is not null")
    good = e.where("role is not null and fault is null").join(frame.select("plan_id", "unit_scale_m"), "plan_id")
    at = lambda x, y: F.struct(F.get(x, F.lit(0)).alias("x"), F.get(y, F.lit(0)).alias("y"))
    on = lambda *roles: good.where(F.col("role").isin(*roles))
    lines = on("WALL").where("kind = 'LINE'").select("plan_id", F.col("entity_no").alias("idx"), ref.alias("source_ref"), at("c10", "c20").alias("start"), at("c11", "c21").alias("end"))
    if exact:
        lines = lines.unionByName(arc_chords(on("WALL").where("kind = 'ARC'"), ref))
    ring = F.arrays_zip(F.col("c10").alias("x"), F.col("c20").alias("y"))
    room = on("ROOM").select("plan_id", F.col("entity_no").alias("idx"), ref.alias("source_ref"), (bulged_ring(ring, F.col("c42")) if exact else ring).alias("polygon"))
    a, b = at("c10", "c20"), at("c11", "c21")
    mid = F.struct(((a["x"] + b["x"]) / 2).alias("x"), ((a["y"] + b["y"]) / 2).alias("y"))
    opening = on("DOOR", "WINDOW", "PASSAGE").select("plan_id", F.col("entity_no").alias("idx"), ref.alias("source_ref"), F.lower("role").alias("kind"), mid.alias("center"), (g.length(a, b) * F.col("unit_scale_m")).alias("width_m"), F.array(a, b).alias("span"), F.lit(None).cast("int").alias("wall_index"))
    none = files.sparkSession.createDataFrame([], "plan_id string, idx int, source_ref string, a struct<x: double, y: double>, b struct<x: double, y: double>, declared_length_m double")
    frames = frame.select("plan_id", F.lit("dxf").alias("kind"), "unit_scale_m", F.lit(False).alias("y_down"), F.lit(None).cast("int").alias("height_px"), "source_units")
    return Plans(frames, lines, room, opening, none, union(parts))


def arc_chords(arc: DataFrame, ref: Column) -> DataFrame:
    """An arc wall as its chord; a full circle has no ends and is left out."""
    r = F.get("c40", F.lit(0))
    start, end = F.get("c50", F.lit(0)), F.get("c51", F.lit(0))
    end_at = lambda d: F.struct((F.get("c10", F.lit(0)) + r * F.cos(F.radians(d))).alias("x"), (F.get("c20", F.lit(0)) + r * F.sin(F.radians(d))).alias("y"))
    part = arc.where(arcs.bounded(r, start, end) & (F.abs(end - start) < 360))
    return part.select("plan_id", F.col("entity_no").alias("idx"), ref.alias("source_ref"), end_at(start).alias("start"), end_at(end).alias("end"))


def bulged_ring(ring: Column, bulges: Column, bound_px: float = 0.5, mm_per_px: float = 5.0) -> Column:
    """A ring whose bulged edges are replaced by points on their arcs."""
    full = F.transform(ring, lambda p, i: F.struct(p.alias("p"), F.coalesce(F.get(bulges, i), F.lit(0.0)).alias("b")))
    n = F.size(full)

    def edge(v: Column, i: Column) -> Column:
        p, b = v["p"], v["b"]
        q = F.get(full, F.when(i + 1 < n, i + 1).otherwise(F.lit(0)))["p"]
        dx, dy = q["x"] - p["x"], q["y"] - p["y"]
        chord = F.hypot(dx, dy)
        theta = arcs.swept_by_bulge(b)
        r = chord / (F.lit(2.0) * F.sin(theta / 2))
        apothem = chord * (F.lit(1.0) - b * b) / (b * 4)
        cx, cy = (p["x"] + q["x"]) / 2 - dy / chord * apothem, (p["y"] + q["y"]) / 2 + dx / chord * apothem
        first = F.atan2(p["y"] - cy, p["x"] - cx)
        k = arcs.segments(r, theta, bound_px, mm_per_px)
        inner = F.transform(F.sequence(F.lit(0), k - 1), lambda j: F.struct((cx + r * F.cos(first + F.signum(b) * theta * j / k)).alias("x"), (cy + r * F.sin(first + F.signum(b) * theta * j / k)).alias("y")))
        return F.when((F.abs(b) > 1e-12) & (chord > 0), inner).otherwise(F.array(p))

    return F.flatten(F.transform(full, edge))
