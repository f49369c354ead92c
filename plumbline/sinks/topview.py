"""PNG top views of compiled plans, one image a plan."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.sources import png

PX_PER_M, MARGIN, MAX_SIDE = 50.0, 0.05, 4000
WALL, ROOM, DOOR, WINDOW = (20, 83, 45), (37, 99, 235), (180, 83, 9), (8, 145, 178)


def _segment(img: np.ndarray, a: tuple[float, float], b: tuple[float, float], width: float, colour) -> None:
    """All pixels within half the width of the segment."""
    h = width / 2
    x0, x1 = max(0, math.floor(min(a[0], b[0]) - h)), min(img.shape[1], math.ceil(max(a[0], b[0]) + h) + 1)
    y0, y1 = max(0, math.floor(min(a[1], b[1]) - h)), min(img.shape[0], math.ceil(max(a[1], b[1]) + h) + 1)
    if x0 >= x1 or y0 >= y1:
        return
    yy, xx = np.mgrid[y0:y1, x0:x1]
    dx, dy = b[0] - a[0], b[1] - a[1]
    t = np.clip(((xx - a[0]) * dx + (yy - a[1]) * dy) / max(dx * dx + dy * dy, 1e-12), 0, 1)
    img[y0:y1, x0:x1][np.hypot(xx - a[0] - t * dx, yy - a[1] - t * dy) <= max(h, 0.5)] = colour


def _draw(walls, rooms, openings) -> bytes:
    ends = [p for w in walls for p in (w["start"], w["end"])] + [p for r in rooms for p in r["polygon"]]
    xs, ys = [p["x"] for p in ends] or [0.0], [p["y"] for p in ends] or [0.0]
    side = max(max(xs) - min(xs), max(ys) - min(ys), 1e-6)
    pad = side * MARGIN
    scale = min(PX_PER_M, MAX_SIDE / (side + 2 * pad))
    size = lambda v: max(1, round((max(v) - min(v) + 2 * pad) * scale))
    img = np.full((size(ys), size(xs), 3), 255, dtype=np.uint8)
    at = lambda p: ((p["x"] - min(xs) + pad) * scale, img.shape[0] - 1 - (p["y"] - min(ys) + pad) * scale)
    for w in walls:
        _segment(img, at(w["start"]), at(w["end"]), max(1.0, w["thickness_m"] * scale), WALL)
    for r in rooms:
        ring = list(r["polygon"])
        for p, q in zip(ring, [*ring[1:], ring[0]]):
            _segment(img, at(p), at(q), 1.0, ROOM)
    for o in openings:
        c = at(o["center"])
        _segment(img, c, c, max(2.0, 0.02 * side * scale), DOOR if o["type"] == "door" else WINDOW)
    return png.encode(img)


def render(wall: DataFrame, room: DataFrame, opening: DataFrame) -> DataFrame:
    """plan_id, png.  A plan's shapes travel together; plans are capped."""
    lists = lambda df, name, *c: df.groupBy("plan_id").agg(F.array_sort(F.collect_list(F.struct("id", *c))).alias(name))
    j = lists(wall, "walls", "start", "end", "thickness_m").join(lists(room, "rooms", "polygon"), "plan_id", "full").join(lists(opening, "openings", "center", "type"), "plan_id", "full")

    def run(batches):
        for df in batches:
            held = [[v if v is not None else [] for v in df[c]] for c in ("walls", "rooms", "openings")]
            yield pd.DataFrame({"plan_id": df["plan_id"], "png": [_draw(*x) for x in zip(*held)]})

    return j.mapInPandas(run, "plan_id string, png binary")
