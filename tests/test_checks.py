"""The failure matrix as data: one tiny plan for each code, one job for all."""

from collections import defaultdict

import pytest

from plumbline.operators import compile as comp, findings, normalize, parse_checks
from plumbline.sources.tables import plans

BOX = [(0.0, 0.0), (4000.0, 0.0), (4000.0, 3000.0), (0.0, 3000.0)]
WALLS = list(zip(BOX, BOX[1:] + BOX[:1]))
CASES = {
    "clean": ({}, set()),
    "short wall": ({"walls": [*WALLS, ((10.0, 10.0), (40.0, 10.0))]}, {"PARSE_DEGENERATE_WALL"}),
    "wall twice": ({"walls": [*WALLS, (BOX[1], BOX[0])]}, {"PARSE_DUPLICATE_ENTITY"}),
    "room twice": ({"rooms": [BOX, BOX[2:] + BOX[:2]]}, {"PARSE_DUPLICATE_ENTITY"}),
    "two vertices": ({"rooms": [BOX[:2]]}, {"PARSE_OPEN_POLYGON"}),
    "vertex beside itself": ({"rooms": [[BOX[0], BOX[1], BOX[1], BOX[2]]]}, {"PARSE_OPEN_POLYGON"}),
    "vertex again": ({"rooms": [[(0.0, 0.0), (2000.0, 0.0), (1000.0, 1000.0), (2000.0, 2000.0), (0.0, 2000.0), (1000.0, 1000.0)]]}, {"PARSE_SELF_INTERSECTING_POLYGON"}),
    "no area": ({"rooms": [[(0.0, 0.0), (1000.0, 0.0), (2000.0, 0.0)]]}, {"PARSE_SELF_INTERSECTING_POLYGON"}),
    "bow tie": ({"rooms": [[(0.0, 0.0), (2000.0, 2000.0), (2000.0, 0.0), (0.0, 3000.0)]]}, {"PARSE_SELF_INTERSECTING_POLYGON"}),
    "rooms cross": ({"rooms": [BOX, [(2000.0, 1000.0), (6000.0, 1000.0), (6000.0, 2000.0), (2000.0, 2000.0)]]}, {"PARSE_ROOM_BOUNDARY_UNMATCHED"}),
    "opening nowhere": ({"openings": [("door", (2000.0, 1500.0), 0.9, None)]}, {"PARSE_UNKNOWN_WALL_REF"}),
    "opening at a corner": ({"openings": [("door", (0.0, 0.0), 0.9, None)]}, {"PARSE_AMBIGUOUS_WALL_REF"}),
    "declared wall is missing": ({"openings": [("door", (2000.0, 0.0), 0.9, 9)]}, {"PARSE_UNKNOWN_WALL_REF"}),
    "off its declared wall": ({"openings": [("door", (2000.0, 30.0), 0.9, 0)]}, {"PARSE_OPENING_OFF_WALL"}),
    "wider than its wall": ({"openings": [("door", (2000.0, 0.0), 4.5, None)]}, {"PARSE_OPENING_WIDTH_EXCEEDS_WALL"}),
    "opening twice": ({"openings": [("door", (2000.0, 0.0), 0.9, None)] * 2}, {"PARSE_DUPLICATE_ENTITY"}),
    "no width": ({"openings": [("door", (2000.0, 0.0), 0.0, None)]}, {"PARSE_RESOURCE_LIMIT"}),
    "far away": ({"walls": [*WALLS, ((0.0, 0.0), (3e8, 0.0))]}, {"PARSE_RESOURCE_LIMIT"}),
    "wrong dimension": ({"dimensions": [((0.0, 0.0), (4000.0, 0.0), 4.2)]}, {"PARSE_DIMENSION_INCONSISTENT"}),
    "nothing usable": ({"walls": [((0.0, 0.0), (10.0, 0.0))], "rooms": [BOX[:2]]}, {"PARSE_EMPTY_GEOMETRY", "PARSE_DEGENERATE_WALL", "PARSE_OPEN_POLYGON"}),
}


@pytest.fixture(scope="module")
def normal(spark):
    wall, room, opening, dimension = [], [], [], []
    for name, (case, _) in CASES.items():
        wall += [(name, i, f"w{i}", a, b) for i, (a, b) in enumerate(case.get("walls", WALLS))]
        room += [(name, i, f"r{i}", r) for i, r in enumerate(case.get("rooms", [BOX]))]
        opening += [(name, i, f"o{i}", k, c, w, None, h) for i, (k, c, w, h) in enumerate(case.get("openings", []))]
        dimension += [(name, i, f"d{i}", a, b, n) for i, (a, b, n) in enumerate(case.get("dimensions", []))]
    frame = [(name, "dxf", 0.001, False, None, "mm") for name in CASES]
    return normalize.normalize(plans(spark, frame, wall, room, opening, dimension))


def test_each_code(normal):
    got = defaultdict(set)
    for r in parse_checks.validate(normal).collect():
        got[r.plan_id].add(r.code)
        assert (r.severity, r.tier) == findings.PARSE[r.code]
    assert dict(got) == {name: codes for name, (_, codes) in CASES.items() if codes}


def test_topology(normal):
    model = comp.compile_model(normal)
    got = defaultdict(set)
    for r in comp.validate_topology(model).collect():
        got[r.plan_id].add(r.code)
    assert not got["clean"]
    assert "GEOM_DEGENERATE_WALL" in got["short wall"] and "GEOM_DUPLICATE_ENTITY" in got["wall twice"]
    assert "GEOM_OPEN_POLYGON" in got["two vertices"] and "GEOM_SELF_INTERSECTING_POLYGON" in got["bow tie"]
    assert "GEOM_OPENING_UNRESOLVED_WALL" in got["opening nowhere"] and "GEOM_OPENING_OFF_WALL" in got["off its declared wall"]
    assert "GEOM_OPENING_WIDTH_EXCEEDS_WALL" in got["wider than its wall"]
    assert "GEOM_OPEN_ROOM_BOUNDARY" in got["rooms cross"]


def test_rollup(normal):
    found = parse_checks.validate(normal)
    got = {r.plan_id: (r.status, r.exit_code) for r in findings.rollup(normal.frame, found).collect()}
    assert got["clean"] == ("complete", 0) and got["rooms cross"] == ("partial", 1) and got["short wall"] == ("failed", 3)
    assert findings.terminal(found).where("plan_id = 'nothing usable'").first().code == "PARSE_EMPTY_GEOMETRY"
