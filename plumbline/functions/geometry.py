"""Geometry as column expressions: points are structs of x and y, rings are
arrays of them without the closing point.  No UDFs; Catalyst sees it all."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def point(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


def bound(value: Column, use) -> Column:
    """use(value), where the value is computed once however often it is used: a
    lambda's argument is a value, while an expression is computed at each use."""
    return F.transform(F.array(value), use)[0]


def ring_edges(ring: Column) -> Column:
    """Edges (a, b) from each vertex to the next, with the one that closes."""
    return bound(ring, lambda r: F.transform(r, lambda p, i: F.struct(p.alias("a"), F.element_at(r, F.when(i + 1 < F.size(r), i + 2).otherwise(F.lit(1))).alias("b"))))


def cross(a: Column, b: Column, kind: str) -> Column:
    return a["x"].cast(kind) * b["y"].cast(kind) - b["x"].cast(kind) * a["y"].cast(kind)


def twice_area(ring: Column, kind: str = "decimal(19,0)", total: str = "decimal(38,0)") -> Column:
    """Twice the signed area; exact on the grid, or in doubles."""
    zero = F.lit(0).cast(total)
    return F.aggregate(ring_edges(ring), zero, lambda s, e: (s + cross(e["a"], e["b"], kind)).cast(total))


def without_closing(ring: Column) -> Column:
    closes = (F.size(ring) > 1) & (F.element_at(ring, 1) == F.element_at(ring, -1))
    return F.when(closes, F.slice(ring, 1, F.size(ring) - 1)).otherwise(ring)


def canonical_ring(ring: Column) -> Column:
    """Counter-clockwise, and the smallest rotation."""
    turned = F.when(twice_area(ring) < 0, F.reverse(ring)).otherwise(ring)
    rotations = F.transform(F.sequence(F.lit(1), F.size(turned)), lambda k: F.concat(F.slice(turned, k, F.size(turned)), F.slice(turned, F.lit(1), k - 1)))
    return F.when(F.size(ring) > 0, F.array_min(rotations)).otherwise(ring)


def length(a: Column, b: Column) -> Column:
    return F.hypot(b["x"] - a["x"], b["y"] - a["y"])


def along(p: Column, a: Column, b: Column) -> Column:
    """Distance of p's foot from a, along the line from a to b; null if a = b."""
    n = length(a, b)
    return F.when(n > 0, ((p["x"] - a["x"]) * ((b["x"] - a["x"]) / n)) + ((p["y"] - a["y"]) * ((b["y"] - a["y"]) / n)))


def offset(p: Column, a: Column, b: Column) -> Column:
    """Distance of p from the infinite line through a and b; null if a = b."""
    n = length(a, b)
    return F.when(n > 0, F.abs((p["x"] - a["x"]) * ((b["y"] - a["y"]) / n) - (p["y"] - a["y"]) * ((b["x"] - a["x"]) / n)))


def segment_distance(p: Column, a: Column, b: Column) -> Column:
    """Distance of p from the segment; from a if it has no length."""
    dx, dy = b["x"] - a["x"], b["y"] - a["y"]
    square = dx * dx + dy * dy
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((p["x"] - a["x"]) * dx + (p["y"] - a["y"]) * dy) / square))
    return F.when(square < 1e-12, length(a, p)).otherwise(F.hypot(p["x"] - (a["x"] + t * dx), p["y"] - (a["y"] + t * dy)))


def turn(a: Column, b: Column, c: Column, kind: str = "decimal(18,0)") -> Column:
    """Twice the area of a triangle on the grid, exactly: as a decimal, or as a
    bigint where differences are known to stay below 2**31."""
    d = lambda x: x.cast(kind)
    return (d(b["x"]) - d(a["x"])) * (d(c["y"]) - d(a["y"])) - (d(b["y"]) - d(a["y"])) * (d(c["x"]) - d(a["x"]))


def proper_cross(p: Column, q: Column, kind: str = "decimal(18,0)") -> Column:
    """Segments cross; a turn of zero counts as to the right."""
    left = (turn(p["a"], p["b"], q["a"], kind) > 0) != (turn(p["a"], p["b"], q["b"], kind) > 0)
    return left & ((turn(q["a"], q["b"], p["a"], kind) > 0) != (turn(q["a"], q["b"], p["b"], kind) > 0))


def boxes_meet(p: Column, q: Column) -> Column:
    """The boxes around two segments share a point, as those that cross do."""
    low = lambda e, c: F.least(e["a"][c], e["b"][c])
    high = lambda e, c: F.greatest(e["a"][c], e["b"][c])
    return (low(p, "x") <= high(q, "x")) & (low(q, "x") <= high(p, "x")) & (low(p, "y") <= high(q, "y")) & (low(q, "y") <= high(p, "y"))


def _in_box(a: Column, b: Column, p: Column) -> Column:
    return p["x"].between(F.least(a["x"], b["x"]), F.greatest(a["x"], b["x"])) & p["y"].between(F.least(a["y"], b["y"]), F.greatest(a["y"], b["y"]))


def touches(p: Column, q: Column) -> Column:
    """Segments share a point, other than collinear ones that share just one."""
    o1, o2 = turn(p["a"], p["b"], q["a"]), turn(p["a"], p["b"], q["b"])
    o3, o4 = turn(q["a"], q["b"], p["a"]), turn(q["a"], q["b"], p["b"])
    overlap = F.greatest(F.least(p["a"], p["b"]), F.least(q["a"], q["b"])) < F.least(F.greatest(p["a"], p["b"]), F.greatest(q["a"], q["b"]))
    on = ((o1 == 0) & _in_box(p["a"], p["b"], q["a"])) | ((o2 == 0) & _in_box(p["a"], p["b"], q["b"])) | ((o3 == 0) & _in_box(q["a"], q["b"], p["a"])) | ((o4 == 0) & _in_box(q["a"], q["b"], p["b"]))
    return F.when((o1 == 0) & (o2 == 0) & (o3 == 0) & (o4 == 0), overlap).otherwise(on | (((o1 > 0) != (o2 > 0)) & ((o3 > 0) != (o4 > 0))))


def self_touching(ring: Column, test=touches) -> Column:
    """Whether two edges that aren't neighbours meet, by the given test."""

    def meets(edges: Column) -> Column:
        # Each edge against those after its neighbour; the first isn't apart from the last.
        rest = lambda i: F.slice(edges, i + 3, F.greatest(F.size(edges) - i - 2 - F.when(i == 0, 1).otherwise(0), F.lit(0)))
        return F.exists(F.transform(edges, lambda e, i: F.exists(rest(i), lambda f: test(e, f))), lambda x: x)

    return bound(ring_edges(ring), meets)


def tolerant_touch(quantum: float):
    """The test in doubles: turns smaller than the quantum are none."""

    def sign(p: Column, q: Column, r: Column) -> Column:
        v = (q["y"] - p["y"]) * (r["x"] - q["x"]) - (q["x"] - p["x"]) * (r["y"] - q["y"])
        return F.when(F.abs(v) < quantum, F.lit(0)).otherwise(F.signum(v).cast("int"))

    def near(p: Column, q: Column, r: Column) -> Column:
        inside = lambda c: q[c].between(F.least(p[c], r[c]) - quantum, F.greatest(p[c], r[c]) + quantum)
        return inside("x") & inside("y")

    def test(e: Column, f: Column) -> Column:
        p1, q1, p2, q2 = e["a"], e["b"], f["a"], f["b"]
        o1, o2, o3, o4 = sign(p1, q1, p2), sign(p1, q1, q2), sign(p2, q2, p1), sign(p2, q2, q1)
        on = ((o1 == 0) & near(p1, p2, q1)) | ((o2 == 0) & near(p1, q2, q1)) | ((o3 == 0) & near(p2, p1, q2)) | ((o4 == 0) & near(p2, q1, q2))
        return ((o1 != o2) & (o3 != o4)) | on

    return test


def distinct_vertices(ring: Column, tolerance: float) -> Column:
    """Vertices without such as are close to the one kept before, or (the last)
    to the first."""
    close = lambda a, b: (F.abs(a["x"] - b["x"]) <= tolerance) & (F.abs(a["y"] - b["y"]) <= tolerance)
    start = F.slice(ring, 1, 1)
    kept = F.aggregate(F.slice(ring, 2, F.greatest(F.size(ring), F.lit(1))), start, lambda acc, p: F.when(close(F.element_at(acc, -1), p), acc).otherwise(F.array_append(acc, p)))
    wraps = (F.size(kept) > 1) & close(F.element_at(kept, 1), F.element_at(kept, -1))
    return F.when(F.size(ring) == 0, ring).when(wraps, F.slice(kept, 1, F.size(kept) - 1)).otherwise(kept)


def centroid(ring: Column) -> Column:
    """The area-weighted centre; the vertices' mean where there is no area."""
    edges = ring_edges(ring)
    area2 = twice_area(ring, "double", "double")
    sums = lambda c: F.aggregate(edges, F.lit(0.0), lambda s, e: s + (e["a"][c] + e["b"][c]) * cross(e["a"], e["b"], "double"))
    mean = lambda c: F.aggregate(ring, F.lit(0.0), lambda s, p: s + p[c]) / F.size(ring)
    flat = F.abs(area2) < 1e-12
    return point(*(F.when(flat, mean(c)).otherwise(sums(c) / (F.lit(3.0) * area2)) for c in ("x", "y")))


def inside(p: Column, ring: Column, border: float = 1e-6) -> Column:
    """Even-odd rule; points within `border` of an edge are outside."""
    edges = ring_edges(ring)
    crosses = lambda e: ((e["a"]["y"] > p["y"]) != (e["b"]["y"] > p["y"])) & (
        p["x"] < (e["b"]["x"] - e["a"]["x"]) * (p["y"] - e["a"]["y"]) / F.nullif(e["b"]["y"] - e["a"]["y"], F.lit(0.0)) + e["a"]["x"]
    )
    odd = F.aggregate(edges, F.lit(False), lambda s, e: F.when(F.coalesce(crosses(e), F.lit(False)), ~s).otherwise(s))
    return odd & ~F.exists(edges, lambda e: segment_distance(p, e["a"], e["b"]) <= border)


def determinant3(m) -> Column:
    return m[0][0] * (m[1][1] * m[2][2] - m[1][2] * m[2][1]) - m[0][1] * (m[1][0] * m[2][2] - m[1][2] * m[2][0]) + m[0][2] * (m[1][0] * m[2][1] - m[1][1] * m[2][0])


def determinant4(m) -> Column:
    out = None
    for c in range(4):
        minor = [[m[r][k] for k in range(4) if k != c] for r in range(1, 4)]
        term = m[0][c] * determinant3(minor) * F.lit(1.0 if c % 2 == 0 else -1.0)
        out = term if out is None else out + term
    return out
