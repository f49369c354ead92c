"""SVG overlays as one row of text for each plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.numeric import short_number

MARGIN = 0.05


def escaped(text: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def viewports(walls: DataFrame, rooms: DataFrame) -> DataFrame:
    """Bounds of each plan with a margin: x0, y0, width, height."""
    ends = walls.select("plan_id", F.explode(F.array("start", "end")).alias("p")).unionByName(rooms.select("plan_id", F.explode("polygon").alias("p")))
    b = ends.groupBy("plan_id").agg(F.min("p.x").alias("x0"), F.max("p.x").alias("x1"), F.min("p.y").alias("y0"), F.max("p.y").alias("y1"))
    pad = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")) * MARGIN
    return b.select("plan_id", (F.col("x0") - pad).alias("x0"), (F.col("y0") - pad).alias("y0"), (F.col("x1") - F.col("x0") + pad * 2).alias("w"), (F.col("y1") - F.col("y0") + pad * 2).alias("h"))


def render(walls: DataFrame, rooms: DataFrame, openings: DataFrame, views: DataFrame | None = None) -> DataFrame:
    """plan_id, svg: rooms, walls, openings and viewpoints in the order of ids; y up."""
    box = viewports(walls, rooms)
    x = lambda p: short_number(p["x"] - F.col("x0"))
    y = lambda p: short_number(F.col("y0") + F.col("h") - p["y"])
    size = F.greatest("w", "h")
    on = lambda df: df.join(box, "plan_id")
    layer = lambda df, k, text: on(df).select("plan_id", F.lit(k).alias("k"), F.col("id"), text.alias("text"))
    points = F.array_join(F.transform("polygon", lambda p: F.concat(x(p), F.lit(","), y(p))), " ")
    parts = layer(rooms, 1, F.concat(F.lit('<polygon class="room" id="'), escaped(F.col("id")), F.lit('" points="'), points, F.lit('"/>')))
    a, b = F.col("start"), F.col("end")
    parts = parts.unionByName(layer(walls, 2, F.concat(F.lit('<line class="wall" id="'), escaped(F.col("id")), F.lit('" x1="'), x(a), F.lit('" y1="'), y(a), F.lit('" x2="'), x(b), F.lit('" y2="'), y(b), F.lit('"/>'))))
    circle = lambda what, p: F.concat(F.lit(f'<circle class="{what}" id="'), escaped(F.col("id")), F.lit('" cx="'), x(p), F.lit('" cy="'), y(p), F.lit('" r="'), short_number(size * 0.01), F.lit('"/>'))
    parts = parts.unionByName(layer(openings, 3, circle("opening", F.col("center"))))
    if views is not None:
        parts = parts.unionByName(layer(views, 4, circle("viewpoint", F.col("position"))))
    body = parts.groupBy("plan_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "id", "text"))), lambda s: s["text"]), "\n").alias("body"))
    head = F.concat(F.lit('<svg xmlns="http://www.w3.org/2000/svg" viewBox="0 0 '), short_number(F.col("w")), F.lit(" "), short_number(F.col("h")), F.lit('">\n'))
    return body.join(box, "plan_id").select("plan_id", F.concat(head, F.col("body"), F.lit("\n</svg>\n")).alias("svg"))
