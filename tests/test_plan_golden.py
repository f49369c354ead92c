import pytest
from pyspark.sql import functions as F

from plumbline.operators import camera, compile as comp, findings, normalize, parse_checks
from plumbline.sources.tables import together
from tests import layer_a


def ids(df):
    return [r.id for r in df.orderBy("ord").collect()]


@pytest.fixture(scope="module")
def both(spark):
    return normalize.normalize(together(layer_a.drawing(spark), layer_a.annotation(spark)))


def test_ids_and_projection(both):
    for plan in ("a", "b"):
        one = lambda t: t.where(F.col("plan_id") == plan)
        assert sorted(ids(one(both.wall))) == sorted(layer_a.WALL_IDS)
        assert ids(one(both.room)) == layer_a.ROOM_IDS
        assert sorted(ids(one(both.opening))) == sorted(layer_a.OPENING_IDS)
    assert {r.projection_hash for r in normalize.projection(both).collect()} == {layer_a.PROJECTION}
    rows = {r.plan_id: r for r in both.normalization.collect()}
    assert rows["a"].translation_m == [1.0, 2.0] and rows["b"].y_axis == "flipped_from_raster"


def test_confidence(both):
    got = lambda t: sorted(r.confidence for r in t.where("plan_id = 'b'").collect())
    assert got(both.wall) == [0.6, 0.6, 0.6, 0.9, 0.9] and got(both.room) == [0.6, 0.9] and got(both.opening) == [0.6, 0.6, 0.6, 0.9]
    assert {r.confidence for r in both.wall.where("plan_id = 'a'").collect()} == {1.0}


def test_clean_plan_has_no_finding(both):
    found = parse_checks.validate(both)
    assert found.count() == 0
    assert {tuple(r) for r in findings.rollup(both.frame, found).collect()} == {("a", 0, 0, "complete", 0), ("b", 0, 0, "complete", 0)}


def test_geometry_and_camera(both):
    model = comp.compile_model(both)
    assert "gw-152c08054052" in {r.id for r in model.wall.collect()} and "gr-0647acdd02a3" in {r.id for r in model.room.collect()}
    # The inner wall's ends are on the outer walls, and on no room's vertex but its own.
    assert {r.code for r in comp.validate_topology(model).collect()} <= {"GEOM_OPEN_ROOM_BOUNDARY"}
    views, found = camera.place_viewpoints(model)
    got = sorted((r.plan_id, r.id, r.position.x, r.position.y, r.position.z) for r in views.collect())
    assert got == [(p, i, x, 3.0, 1.35) for p in "ab" for i, x in (("0000", 2.5), ("0001", 6.5))]
    assert found.count() == 0
    edges, loose = camera.adjacency(model, views)
    assert {tuple(r) for r in edges.collect()} == {("a", "0000", "0001", 1), ("b", "0000", "0001", 1)}
    assert [r.code for r in loose.collect()] == ["CAM_MAP_ADJACENCY_UNRESOLVED"] * 2
    report = camera.coverage_report(model, views, edges, found.unionByName(loose)).where("plan_id = 'a'").first()
    assert report.every_room_covered and report.edges == 1 and report.unresolved_doors == 1
    draft = [tuple(r) for r in camera.map_draft(views, edges).where("plan_id = 'a'").orderBy("pos").collect()]
    assert draft == [("a", 1, "0000", ["0001"]), ("a", 2, "0001", ["0000"])]
    text = camera.extrinsics_text(views).first().text
    assert text.startswith("-1.0000000000 ") and text.count("\n") == 4


def test_order_of_input_does_not_matter(spark):
    plan = layer_a.drawing(spark)
    from dataclasses import replace

    mixed = replace(plan, wall=plan.wall.orderBy(F.desc("idx")).repartition(3), room=plan.room.repartition(2), opening=plan.opening.repartition(4))
    assert normalize.projection(normalize.normalize(mixed)).first().projection_hash == layer_a.PROJECTION
