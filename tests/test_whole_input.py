"""Queries that leave out no rows of their tables."""

from plumbline.plans.registry import QUERIES


def test_every_event_is_an_anchor(spark, tmp_path):
    rows = [(i, i % 3) for i in range(400)]
    spark.createDataFrame(rows, "event_id long, user_id long").write.parquet(str(tmp_path / "events.parquet"))
    got = QUERIES["scale_fit"](spark, str(tmp_path)).collect()
    assert sum(r.anchors for r in got) == len(rows)
    assert all((r.m_per_px is None) == (r.anchors < 3) for r in got)


def test_every_side_of_every_room_is_a_wall(spark, tmp_path):
    rows = [(k, 7) for k in range(1, 60)]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long").write.parquet(str(tmp_path / "orders.parquet"))
    rooms = {k: (k % 7 * 900, k % 5 * 700, k % 7 * 900 + 1000 + k % 11 * 300, k % 5 * 700 + 1000 + k % 3 * 400) for k, _ in rows}
    want = {}
    for k, (x0, y0, x1, y1) in rooms.items():
        cx, cy = (x0 + x1) / 2, (y0 + y1) / 2
        sides = [s for a, b, c, d in rooms.values() for s in ((a, b, c, b), (c, b, c, d), (a, d, c, d), (a, b, a, d))]
        near = sum(max(a - cx, 0, cx - c) ** 2 + max(b - cy, 0, cy - d) ** 2 < 415**2 for a, b, c, d in sides)
        if near:
            want[k] = near
    got = {r.idx: r.walls for r in QUERIES["free_space"](spark, str(tmp_path)).collect()}
    assert got == want
