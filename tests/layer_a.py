"""The two-room plan that the golden values are for, as drawing and annotation."""

P = lambda x, y: (float(x), float(y))
WALLS = [((1000, 2000), (9000, 2000)), ((9000, 2000), (9000, 8000)), ((1000, 8000), (9000, 8000)), ((1000, 2000), (1000, 8000)), ((6000, 2000), (6000, 8000))]
ROOMS = [[(1000, 2000), (6000, 2000), (6000, 8000), (1000, 8000)], [(6000, 2000), (9000, 2000), (9000, 8000), (6000, 8000)]]
OPENINGS = [("window", (3000, 8000), 1.2, 2), ("window", (9000, 6500), 1.2, 1), ("door", (3500, 2000), 0.9, 0), ("door", (6000, 5000), 0.9, 4)]
WALL_IDS = ["w-b38b11821642", "w-8829e7c2d2cc", "w-0df3b64861a5", "w-6e35a882252a", "w-5e931339aa8f"]
ROOM_IDS = ["r-ab354c288e8a", "r-bea085b2f952"]
OPENING_IDS = ["o-13a46a7d32db", "o-9585ee57fe3e", "o-3a101c4fd203", "o-378d46ae40f1"]
PROJECTION = "sha256:e5041ddcf05eb02da0a07176d483ee4eaef311bf885204078710f07fe3b7e77e"


def drawing(spark, plan_id="a"):
    from plumbline.sources.tables import plans

    vertical = {1, 4}
    span = lambda c, w, i: [P(c[0], c[1] - 500 * w), P(c[0], c[1] + 500 * w)] if i in vertical else [P(c[0] - 500 * w, c[1]), P(c[0] + 500 * w, c[1])]
    return plans(
        spark,
        frame=[(plan_id, "dxf", 0.001, False, None, "mm")],
        wall=[(plan_id, i, f"wall-{i}", P(*a), P(*b)) for i, (a, b) in enumerate(WALLS)],
        room=[(plan_id, i, f"room-{i}", [P(*p) for p in r]) for i, r in enumerate(ROOMS)],
        opening=[(plan_id, i, f"opening-{i}", k, P(*c), w, span(c, w, h), None) for i, (k, c, w, h) in enumerate(OPENINGS)],
    )


def annotation(spark, plan_id="b"):
    from plumbline.sources.tables import plans

    px = lambda p: P(p[0] / 5, 1800 - p[1] / 5)
    return plans(
        spark,
        frame=[(plan_id, "raster", 0.005, True, 1800, "px")],
        wall=[(plan_id, i, f"wall-{i}", px(a), px(b)) for i, (a, b) in enumerate(WALLS)],
        room=[(plan_id, i, f"room-{i}", [px(p) for p in r]) for i, r in enumerate(ROOMS)],
        opening=[(plan_id, i, f"opening-{i}", k, px(c), w, None, h) for i, (k, c, w, h) in enumerate(OPENINGS)],
        dimension=[(plan_id, 0, "d0", px((1000, 2000)), px((9000, 2000)), 8.0), (plan_id, 1, "d1", px((1000, 2000)), px((1000, 8000)), 6.0)],
    )
