"""Recognition of clean line-drawn rasters: walls, openings, rooms.

One image is one row and one unit of work; cheap guards (contrast, share of ink,
amount of ink) come first and end in findings, so only images worth it are
searched.  The search is numpy on the image's ink alone:

* arcs: circles through random triples of ink (a fixed seed), refitted on their
  inliers and kept if round, long and contiguous;
* straight walls: the strongest line of a Hough accumulator is taken, its ink is
  cut into runs and removed, and so on until no line is left, so a stroke can't
  be found twice;
* openings: gaps in a wall's ink, told apart by what is drawn at them;
* rooms: walls are split where others end on them, ends that are close become one
  node, and the faces of that planar graph are walked.

All lengths in pixels until the scale from the anchors turns them into mm.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.sources import png

# Fixed values of the supported style.
MIN_SEPARABILITY = 0.70
INK_BAND = (0.001, 0.35)
MAX_INK_PIXELS = 2_000_000
MAX_UNEXPLAINED = 0.10
STROKE_PX, RUN_GAP_PX, OPENING_GAP_PX, MIN_WALL_PX = 3, 8.0, 350.0, 10.0
MIN_VOTES, THETA_STEP_DEG = 20, 0.25
ARC_RADIUS_PX, ARC_TRIES, ARC_SEED = (150.0, 450.0), 20_000, 20260817
ARC_RESIDUAL_PX, ARC_SWEEP_DEG, ARC_CONTIGUOUS = 2.0, (45.0, 355.0), 0.6
SNAP_PX, MIN_FACE_PX2 = 10.0, 60.0
ANCHOR_MIN_PX, ANCHOR_BAND_PX, MAX_RESIDUAL, MAX_DISAGREEMENT = 50.0, 31.0, 0.01, 0.02

RESULT = """plan_id string, kind string, idx int, x1 double, y1 double, x2 double, y2 double, radius double, start_deg double, end_deg double,
thickness double, host int, polygon array<struct<x: double, y: double>>, code string, n long"""


def otsu(histogram: np.ndarray) -> tuple[int, float]:
    """Threshold (the lowest of the best, ends left out) and class separability."""
    n = histogram.astype(np.float64)
    total = n.sum()
    if not total:
        return 0, 0.0
    p, v = n / total, np.arange(256)
    w, m = np.cumsum(p), np.cumsum(p * v)
    with np.errstate(divide="ignore", invalid="ignore"):
        between = np.nan_to_num((m[-1] * w - m) ** 2 / (w * (1 - w)))
    t = int(np.argmax(between[1:-1])) + 1
    variance = (p * (v - m[-1]) ** 2).sum()
    below, mass = p[:t].sum(), (p[:t] * v[:t]).sum()
    if variance <= 0 or not 0 < below < 1:
        return t, 0.0
    return t, float((m[-1] * below - mass) ** 2 / (below * (1 - below)) / variance)


def eroded(mask: np.ndarray) -> np.ndarray:
    """Pixels whose eight neighbours are set too; what is outside isn't."""
    padded = np.pad(mask, 1)
    h, w = mask.shape
    out = np.ones_like(mask)
    for dy in range(3):
        for dx in range(3):
            out &= padded[dy : dy + h, dx : dx + w]
    return out


def components(mask: np.ndarray) -> tuple[np.ndarray, int]:
    """Labels of 8-connected components in the order of a scan: runs of each row
    are joined with the runs above that touch them."""
    h, w = mask.shape
    edge = np.diff(np.pad(mask.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    rows, starts = np.nonzero(edge == 1)
    stops = np.nonzero(edge == -1)[1]
    up = list(range(len(rows)))

    def root(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    first = np.searchsorted(rows, np.arange(h + 1))
    for y in range(1, h):
        a, b = first[y - 1], first[y]
        while a < first[y] and b < first[y + 1]:
            if starts[a] <= stops[b] and starts[b] <= stops[a]:
                i, j = root(int(a)), root(int(b))
                up[max(i, j)] = min(i, j)
            if stops[a] < stops[b]:
                a += 1
            else:
                b += 1
    roots = np.array([root(i) for i in range(len(rows))], dtype=np.int64)
    names, label = np.unique(roots, return_inverse=True)
    out = np.zeros((h, w), dtype=np.int32)
    for y, s, e, k in zip(rows.tolist(), starts.tolist(), stops.tolist(), label.tolist()):
        out[y, s:e] = k + 1
    return out, len(names)


def _circles(p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Circles through triples of points (n x 3 x 2)."""
    a, b = p[:, 1] - p[:, 0], p[:, 2] - p[:, 0]
    d = 2 * (a[:, 0] * b[:, 1] - a[:, 1] * b[:, 0])
    aa, bb = (a**2).sum(axis=1), (b**2).sum(axis=1)
    with np.errstate(divide="ignore", invalid="ignore"):
        ux, uy = (b[:, 1] * aa - a[:, 1] * bb) / d, (a[:, 0] * bb - b[:, 0] * aa) / d
    return p[:, 0, 0] + ux, p[:, 0, 1] + uy, np.hypot(ux, uy)


def fit_circle(p: np.ndarray) -> tuple[float, float, float]:
    """Algebraic least squares."""
    m = p.mean(axis=0)
    q = p - m
    s, *_ = np.linalg.lstsq(np.column_stack([2 * q, np.ones(len(q))]), (q**2).sum(axis=1), rcond=None)
    return float(s[0] + m[0]), float(s[1] + m[1]), float(math.sqrt(max(0.0, s[2] + s[0] ** 2 + s[1] ** 2)))


def find_arc(mask: np.ndarray) -> dict | None:
    ys, xs = np.nonzero(mask)
    points = np.column_stack([xs, ys]).astype(np.float64)
    lo, hi = ARC_RADIUS_PX
    support = max(int(lo * math.pi / 4), 10)
    if len(points) < 200:
        return None
    rng = np.random.default_rng(ARC_SEED)
    some, best = points[::4], (0, None)
    for _ in range(ARC_TRIES // 2000):
        t = points[rng.integers(0, len(points), (2000, 3))]
        spread = np.min([np.hypot(*(t[:, i] - t[:, j]).T) for i, j in ((0, 1), (0, 2), (1, 2))], axis=0)
        cx, cy, r = _circles(t)
        ok = np.flatnonzero((spread >= 0.05 * hi) & np.isfinite(r) & (r >= lo) & (r <= hi))
        for k in ok:
            n = int((np.abs(np.hypot(some[:, 0] - cx[k], some[:, 1] - cy[k]) - r[k]) <= STROKE_PX).sum())
            if n > best[0]:
                best = (n, (cx[k], cy[k], r[k]))
    if best[1] is None or best[0] < support / 4:
        return None
    cx, cy, r = best[1]
    on = np.abs(np.hypot(points[:, 0] - cx, points[:, 1] - cy) - r) <= STROKE_PX
    if on.sum() < support:
        return None
    cx, cy, r = fit_circle(points[on])
    if np.sqrt(np.mean((np.hypot(points[on, 0] - cx, points[on, 1] - cy) - r) ** 2)) > ARC_RESIDUAL_PX:
        return None
    angles = np.sort(np.degrees(np.arctan2(points[on, 1] - cy, points[on, 0] - cx)))
    gaps = np.append(np.diff(angles), angles[0] + 360 - angles[-1])
    g = int(np.argmax(gaps))
    if not ARC_SWEEP_DEG[0] <= 360 - gaps[g] < ARC_SWEEP_DEG[1]:
        return None
    ring = np.zeros_like(mask)
    ring[ys[on], xs[on]] = True
    label, n = components(ring)
    if np.bincount(label.ravel())[1:].max() < ARC_CONTIGUOUS * on.sum():
        return None
    return {"cx": cx, "cy": cy, "r": r, "start": float(angles[(g + 1) % len(angles)]), "end": float(angles[g])}


def _runs(t: np.ndarray, gap: float) -> list[tuple[float, float]]:
    """Maximal runs of sorted values no further apart than the gap."""
    if not len(t):
        return []
    cut = np.flatnonzero(np.diff(t) > gap)
    return list(zip(t[np.concatenate([[0], cut + 1])].tolist(), t[np.concatenate([cut, [len(t) - 1]])].tolist()))


def _joined(runs: list[tuple[float, float]], gap: float) -> list[list[tuple[float, float]]]:
    """Runs grouped into walls: what is no further apart than an opening."""
    out: list[list[tuple[float, float]]] = []
    for r in runs:
        if out and r[0] - out[-1][-1][1] <= gap:
            out[-1].append(r)
        else:
            out.append([r])
    return out


def find_walls(skeleton: np.ndarray) -> list[dict]:
    """Straight walls of a one-pixel skeleton: the strongest line first; its ink is
    taken away before the next is sought."""
    ys, xs = np.nonzero(skeleton)
    x, y = xs.astype(np.float64), ys.astype(np.float64)
    reach = int(math.hypot(*skeleton.shape)) + 2
    theta = np.deg2rad(np.arange(0.0, 180.0, THETA_STEP_DEG))
    walls: list[dict] = []
    left = np.ones(len(x), dtype=bool)
    acc = np.zeros((len(theta), 2 * reach), dtype=np.int32)
    cast = lambda k, which: np.bincount(np.rint(x[which] * math.cos(theta[k]) + y[which] * math.sin(theta[k])).astype(np.int64) + reach, minlength=2 * reach)
    for k in range(len(theta)):
        acc[k] = cast(k, left)
    while len(walls) < 200 and acc.max() >= MIN_VOTES:
        k, r = np.unravel_index(int(np.argmax(acc)), acc.shape)
        c, s, rho = math.cos(theta[k]), math.sin(theta[k]), float(r - reach)
        near = left & (np.abs(x * c + y * s - rho) <= 2.0)
        along = np.sort((-x * s + y * c)[near])
        found = False
        for group in _joined(_runs(along, RUN_GAP_PX), OPENING_GAP_PX):
            t0, t1 = group[0][0], group[-1][1]
            ink = sum(b - a + 1 for a, b in group)
            if t1 - t0 >= MIN_WALL_PX and ink >= MIN_VOTES:
                found = True
                at = lambda t: (c * rho - s * t, s * rho + c * t)
                (x1, y1), (x2, y2) = at(t0), at(t1)
                walls.append({"x1": x1, "y1": y1, "x2": x2, "y2": y2, "gaps": [(a[1] - t0, b[0] - t0) for a, b in zip(group, group[1:])]})
        taken = np.flatnonzero(near)
        if not len(taken) or not found:
            acc[k, max(0, r - 2) : r + 3] = 0
            if not len(taken):
                continue
        left[near] = False
        for k2 in range(len(theta)):
            acc[k2] -= cast(k2, taken).astype(np.int32)
        np.maximum(acc, 0, out=acc)
    return walls


def thickness(mask: np.ndarray, w: dict) -> float:
    """Median length of the ink across the wall."""
    n = math.hypot(w["x2"] - w["x1"], w["y2"] - w["y1"])
    ux, uy = (w["x2"] - w["x1"]) / n, (w["y2"] - w["y1"]) / n
    h, wd = mask.shape
    out = []
    for t in np.linspace(0.1, 0.9, 33) * n:
        cx, cy = w["x1"] + ux * t, w["y1"] + uy * t
        k = np.arange(-12, 13)
        px, py = np.rint(cx - uy * k).astype(int), np.rint(cy + ux * k).astype(int)
        ok = (px >= 0) & (px < wd) & (py >= 0) & (py < h)
        line = np.zeros(25, dtype=bool)
        line[ok] = mask[py[ok], px[ok]]
        if line[12]:
            a, b = 12, 12
            while a > 0 and line[a - 1]:
                a -= 1
            while b < 24 and line[b + 1]:
                b += 1
            out.append(b - a + 1)
    return float(np.median(out)) if out else float(STROKE_PX)


def find_openings(mask: np.ndarray, walls: list[dict]) -> list[dict]:
    """Gaps in walls: with strokes beside and along the gap a window, with a stroke
    that leaves from one end a door, with nothing a passage."""
    out = []
    h, wd = mask.shape
    for i, w in enumerate(walls):
        n = math.hypot(w["x2"] - w["x1"], w["y2"] - w["y1"])
        ux, uy = (w["x2"] - w["x1"]) / n, (w["y2"] - w["y1"]) / n
        for a, b in w["gaps"]:
            if b - a < 2 * RUN_GAP_PX:
                continue
            t, k = np.meshgrid(np.arange(math.ceil(a) + 3, math.floor(b) - 2), np.arange(-int(b - a) - 8, int(b - a) + 9), indexing="ij")
            px, py = np.rint(w["x1"] + ux * t - uy * k).astype(int), np.rint(w["y1"] + uy * t + ux * k).astype(int)
            ok = (px >= 0) & (px < wd) & (py >= 0) & (py < h)
            ink = np.zeros(t.shape, dtype=bool)
            ink[ok] = mask[py[ok], px[ok]]
            offset = np.abs(k[0])
            beside = ink[:, (offset <= 12)].any(axis=1).mean()
            far = ink[:, (offset > 12)].any(axis=0).sum()
            kind = "window" if beside > 0.6 else "door" if far > 0.3 * (b - a) else "passage"
            out.append({"kind": kind, "host": i, "x1": w["x1"] + ux * a, "y1": w["y1"] + uy * a, "x2": w["x1"] + ux * b, "y2": w["y1"] + uy * b})
    return out


def unexplained(mask: np.ndarray, walls: list[dict], arc: dict | None, openings: list[dict]) -> float:
    """Share of the ink that isn't near anything that was recognised."""
    ys, xs = np.nonzero(mask)
    if not len(xs):
        return 0.0
    near = np.zeros(len(xs), dtype=bool)
    for w in walls:
        dx, dy = w["x2"] - w["x1"], w["y2"] - w["y1"]
        t = np.clip(((xs - w["x1"]) * dx + (ys - w["y1"]) * dy) / max(dx * dx + dy * dy, 1e-9), 0, 1)
        near |= np.hypot(xs - w["x1"] - t * dx, ys - w["y1"] - t * dy) <= 6
    if arc:
        near |= np.abs(np.hypot(xs - arc["cx"], ys - arc["cy"]) - arc["r"]) <= 12
    for o in openings:
        cx, cy, r = (o["x1"] + o["x2"]) / 2, (o["y1"] + o["y2"]) / 2, math.hypot(o["x2"] - o["x1"], o["y2"] - o["y1"])
        near |= np.hypot(xs - cx, ys - cy) <= 1.2 * r + 6
    return float(1 - near.mean())


def overlaps(walls: list[dict]) -> int:
    """Pairs of walls that lie on each other: a wall that was found twice."""
    n = 0
    for i, a in enumerate(walls):
        la = math.hypot(a["x2"] - a["x1"], a["y2"] - a["y1"])
        ux, uy = (a["x2"] - a["x1"]) / la, (a["y2"] - a["y1"]) / la
        for b in walls[i + 1 :]:
            lb = math.hypot(b["x2"] - b["x1"], b["y2"] - b["y1"])
            if abs((b["x2"] - b["x1"]) * ux + (b["y2"] - b["y1"]) * uy) / lb < 0.98:
                continue
            away = max(abs((b[f"x{k}"] - a["x1"]) * uy - (b[f"y{k}"] - a["y1"]) * ux) for k in (1, 2))
            t = sorted((b[f"x{k}"] - a["x1"]) * ux + (b[f"y{k}"] - a["y1"]) * uy for k in (1, 2))
            n += away <= STROKE_PX and min(la, t[1]) - max(0.0, t[0]) > 2
    return n


def faces(segments: list[tuple[float, float, float, float]]) -> list[list[tuple[float, float]]]:
    """Inner faces of the planar graph of segments."""
    pieces = []
    for x1, y1, x2, y2 in segments:
        dx, dy = x2 - x1, y2 - y1
        n = math.hypot(dx, dy)
        cuts = {0.0, 1.0}
        for ends in segments:
            for px, py in (ends[:2], ends[2:]):
                t = ((px - x1) * dx + (py - y1) * dy) / (n * n)
                if 0.03 < t < 0.97 and abs((px - x1) * dy - (py - y1) * dx) / n < SNAP_PX:
                    cuts.add(t)
        c = sorted(cuts)
        pieces += [(x1 + a * dx, y1 + a * dy, x1 + b * dx, y1 + b * dy) for a, b in zip(c, c[1:])]
    points = [p for s in pieces for p in (s[:2], s[2:])]
    # Ends that are close are one node, through a grid of cells.
    up = list(range(len(points)))

    def root(i: int) -> int:
        while up[i] != i:
            i = up[i]
        return i

    cells = defaultdict(list)
    for i, (x, y) in enumerate(points):
        for cx in (-1, 0, 1):
            for cy in (-1, 0, 1):
                for j in cells[(int(x // SNAP_PX) + cx, int(y // SNAP_PX) + cy)]:
                    if math.hypot(x - points[j][0], y - points[j][1]) <= SNAP_PX:
                        a, b = root(i), root(j)
                        up[max(a, b)] = min(a, b)
        cells[(int(x // SNAP_PX), int(y // SNAP_PX))].append(i)
    around = defaultdict(set)
    for k in range(len(pieces)):
        a, b = root(2 * k), root(2 * k + 1)
        if a != b:
            around[a].add(b)
            around[b].add(a)
    angle = lambda a, b: math.atan2(points[b][1] - points[a][1], points[b][0] - points[a][0])
    order = {a: sorted(bs, key=lambda b: angle(a, b)) for a, bs in around.items()}
    done, out = set(), []
    for a in sorted(around):
        for b in order[a]:
            if (a, b) in done:
                continue
            ring, u, v = [], a, b
            while (u, v) not in done:
                done.add((u, v))
                ring.append(u)
                turn = order[v]
                u, v = v, turn[(turn.index(u) - 1) % len(turn)]
            p = [points[i] for i in ring]
            area = sum(p[i][0] * p[(i + 1) % len(p)][1] - p[(i + 1) % len(p)][0] * p[i][1] for i in range(len(p))) / 2
            if area >= MIN_FACE_PX2:
                out.append(p)
    return out


def _row(plan_id: str, kind: str, idx: int, **values) -> dict:
    return {"plan_id": plan_id, "kind": kind, "idx": idx, **values}


def recognise_image(plan_id: str, content: bytes) -> list[dict]:
    """Rows of RESULT (pixels) of one image; any finding leaves only findings."""
    try:
        grey = png.grey(png.decode(content))
    except Exception:
        return [_row(plan_id, "finding", 0, code="PARSE_SOURCE_UNSUPPORTED")]
    codes = []
    _, eta = otsu(np.bincount(grey.ravel(), minlength=256))
    if eta < MIN_SEPARABILITY:
        codes.append("RASTER_LOW_CONTRAST")
    ink = grey == 0
    n = int(ink.sum())
    if not INK_BAND[0] <= n / max(1, ink.size) <= INK_BAND[1]:
        codes.append("RASTER_CLUTTER_EXCEEDS_ENVELOPE")
    if n > MAX_INK_PIXELS:
        codes.append("PARSE_RESOURCE_LIMIT")
    frame = _row(plan_id, "frame", 0, x2=float(grey.shape[1]), y2=float(grey.shape[0]), n=n)
    if codes:
        return [frame, *(_row(plan_id, "finding", k, code=c) for k, c in enumerate(codes))]
    arc = find_arc(ink)
    rest = ink.copy()
    if arc:
        ys, xs = np.nonzero(ink)
        ring = np.abs(np.hypot(xs - arc["cx"], ys - arc["cy"]) - arc["r"]) <= STROKE_PX + 2
        rest[ys[ring], xs[ring]] = False
    walls = find_walls(eroded(rest))
    openings = find_openings(ink, walls)
    if overlaps(walls):
        codes.append("RASTER_OVERSEGMENTED")
    if unexplained(ink, walls, arc, openings) > MAX_UNEXPLAINED:
        codes.append("RASTER_UNEXPLAINED_INK")
    if codes:
        return [frame, *(_row(plan_id, "finding", k, code=c) for k, c in enumerate(codes))]
    rows = [frame]
    for k, w in enumerate(walls):
        rows.append(_row(plan_id, "segment", k, **{c: w[c] for c in ("x1", "y1", "x2", "y2")}, thickness=thickness(ink, w)))
    segments = [(w["x1"], w["y1"], w["x2"], w["y2"]) for w in walls]
    if arc:
        rows.append(_row(plan_id, "circular_arc", len(walls), x1=arc["cx"], y1=arc["cy"], radius=arc["r"], start_deg=arc["start"], end_deg=arc["end"], thickness=float(STROKE_PX)))
        sweep = (arc["end"] - arc["start"]) % 360
        t = np.radians(arc["start"] + np.linspace(0, sweep, 33))
        px, py = arc["cx"] + arc["r"] * np.cos(t), arc["cy"] + arc["r"] * np.sin(t)
        segments += list(zip(px[:-1].tolist(), py[:-1].tolist(), px[1:].tolist(), py[1:].tolist()))
    rows += [_row(plan_id, o["kind"], k, host=o["host"], **{c: o[c] for c in ("x1", "y1", "x2", "y2")}) for k, o in enumerate(openings)]
    rows += [_row(plan_id, "room", k, polygon=[{"x": x, "y": y} for x, y in p]) for k, p in enumerate(faces(segments))]
    return rows


def recognise(images: DataFrame) -> DataFrame:
    """images: plan_id, content.  Headers are checked before anything is decoded."""
    h = png.header(F.col("content"))
    cheap = images.where(h.isNull() | (h["width"] * h["height"] <= png.MAX_PIXELS))

    def run(batches):
        for df in batches:
            for plan_id, content in zip(df["plan_id"], df["content"]):
                out = pd.DataFrame(recognise_image(plan_id, bytes(content))).reindex(columns=COLUMNS)
                for c in ("polygon", "code"):
                    out[c] = [v if isinstance(v, (list, str)) else None for v in out[c]]
                yield out.astype({"idx": "int32", "host": "Int32", "n": "Int64"})

    return cheap.select("plan_id", "content").mapInPandas(run, RESULT)


COLUMNS = ["plan_id", "kind", "idx", "x1", "y1", "x2", "y2", "radius", "start_deg", "end_deg", "thickness", "host", "polygon", "code", "n"]


def in_millimetres(rows: DataFrame, scale: DataFrame) -> DataFrame:
    """rows with lengths in mm and y up.  scale: plan_id, m_per_px.  Plans without a
    scale keep only findings, and get one."""
    height = rows.where("kind = 'frame'").select("plan_id", F.col("y2").alias("height"))
    j = rows.join(scale.select("plan_id", "m_per_px"), "plan_id", "left").join(height, "plan_id", "left")
    k = F.col("m_per_px") * 1000.0
    flip = lambda c: (F.col("height") - c) * k
    shape = j.where("m_per_px is not null and kind not in ('finding', 'frame')")
    angle = lambda c: F.when(F.col(c).isNotNull(), F.pmod(-F.col(c) + 180.0, F.lit(360.0)) - 180.0)
    mm = shape.select("plan_id", "kind", "idx", (F.col("x1") * k).alias("x1"), flip(F.col("y1")).alias("y1"), (F.col("x2") * k).alias("x2"), flip(F.col("y2")).alias("y2"), (F.col("radius") * k).alias("radius"), angle("end_deg").alias("start_deg"), angle("start_deg").alias("end_deg"), (F.col("thickness") * k).alias("thickness"), "host", F.transform("polygon", lambda p: F.struct((p["x"] * k).alias("x"), flip(p["y"]).alias("y"))).alias("polygon"), "code")
    lost = j.where("m_per_px is null and kind = 'frame'").select("plan_id", F.lit("SCALE_ANCHORS_INSUFFICIENT").alias("code"))
    found = rows.where("kind = 'finding'").select("plan_id", "code").unionByName(lost)
    return mm.drop("code").unionByName(found.withColumn("kind", F.lit("finding")), allowMissingColumns=True)


ANCHOR_INK = 64


def anchor_extent(mask: np.ndarray) -> float:
    """Extent (max - min + 1) of the set pixels along their principal axis."""
    ys, xs = np.nonzero(mask)
    if len(xs) < 2:
        return float(len(xs))
    q = np.column_stack([xs - xs.mean(), ys - ys.mean()])
    t = q @ np.linalg.eigh(q.T @ q / len(q))[1][:, -1]
    return float(t.max() - t.min() + 1)


def measured_anchors(images: DataFrame, anchors: DataFrame) -> DataFrame:
    """anchors: plan_id, id, ord, real_length_m, span_px, x, y (the middle).  Adds
    measured_px: in order, each anchor takes the nearest component of anchor ink that
    is left; null if there is none.  A plan's anchors are a handful."""
    lists = anchors.groupBy("plan_id").agg(F.array_sort(F.collect_list(F.struct("ord", "id", "real_length_m", "span_px", "x", "y"))).alias("anchors"))

    def run(batches):
        for df in batches:
            for plan_id, content, mine in zip(df["plan_id"], df["content"], df["anchors"]):
                try:
                    label, n = components(png.grey(png.decode(bytes(content))) == ANCHOR_INK)
                except Exception:
                    label, n = np.zeros((1, 1), dtype=np.int32), 0
                left = []
                for k in range(1, n + 1):
                    ys, xs = np.nonzero(label == k)
                    left.append((float(xs.mean()), float(ys.mean()), k))
                out = []
                for a in mine:
                    size = None
                    if left:
                        best = min(range(len(left)), key=lambda i: math.hypot(left[i][0] - a["x"], left[i][1] - a["y"]))
                        size = anchor_extent(label == left.pop(best)[2])
                    out.append((plan_id, a["id"], a["real_length_m"], a["span_px"], size))
                yield pd.DataFrame(out, columns=["plan_id", "id", "real_length_m", "span_px", "measured_px"])

    return images.select("plan_id", "content").join(lists, "plan_id").mapInPandas(run, "plan_id string, id string, real_length_m double, span_px double, measured_px double")


def probe(images: DataFrame) -> DataFrame:
    """Diagnostics of an image: dark pixels and pixels on edges (a 3x3 Laplacian over
    64; the border isn't filtered)."""

    def run(batches):
        for df in batches:
            for plan_id, content in zip(df["plan_id"], df["content"]):
                g = png.grey(png.decode(bytes(content))).astype(np.int64)
                near = sum(g[1 + dy : g.shape[0] - 1 + dy, 1 + dx : g.shape[1] - 1 + dx] for dy in (-1, 0, 1) for dx in (-1, 0, 1))
                e = np.clip(g, 0, 255)
                e[1:-1, 1:-1] = np.clip(9 * g[1:-1, 1:-1] - near, 0, 255)
                yield pd.DataFrame([(plan_id, g.shape[1], g.shape[0], int((g < 64).sum()), int((g < 128).sum()), int((e > 64).sum()))], columns=["plan_id", "width", "height", "dark_64", "dark_128", "edges_64"])

    return images.mapInPandas(run, "plan_id string, width int, height int, dark_64 long, dark_128 long, edges_64 long")


def scale_findings(anchors: DataFrame, fit: DataFrame) -> DataFrame:
    """anchors: plan_id, span_px, measured_px.  Scales that can't be trusted."""
    a = anchors.groupBy("plan_id").agg(F.min("span_px").alias("least"), F.bool_or(F.col("measured_px").isNull() | (F.abs(F.col("measured_px") - F.col("span_px")) > ANCHOR_BAND_PX)).alias("off"))
    j = fit.join(a, "plan_id", "left")
    bad = (F.col("least") < ANCHOR_MIN_PX) | F.col("off") | (F.col("median_residual") > MAX_RESIDUAL) | (F.col("disagreement") > MAX_DISAGREEMENT)
    code = F.when(F.col("m_per_px").isNull(), "SCALE_ANCHORS_INSUFFICIENT").when(bad, "PARSE_DIMENSION_INCONSISTENT")
    return j.select("plan_id", code.alias("code")).where("code is not null")


def gated(shapes: DataFrame, findings: DataFrame) -> DataFrame:
    """Shapes of the plans that have no finding at all."""
    return shapes.join(findings.select("plan_id").distinct(), "plan_id", "left_anti")
