"""The whole way of many plans: parse, geometry, cameras.  Each stage's tables are
settled before the next; a plan that fails a stage goes no further, and says so in
its status, while the others go on."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators import camera, compile as comp, findings, normalize, parse_checks
from plumbline.plans.stages import settled
from plumbline.sources.tables import Plans


@dataclass(frozen=True)
class Result:
    normalized: normalize.Normalized
    model: comp.Model
    viewpoint: DataFrame
    edge: DataFrame
    map_entry: DataFrame
    finding: DataFrame  # stage, plan_id, code, ...
    status: DataFrame  # stage, plan_id, status, exit_code
    coverage: DataFrame


def _only(tables, good: DataFrame):
    keep = lambda df: df.join(good, "plan_id", "left_semi") if "plan_id" in df.columns else df
    return replace(tables, **{f.name: keep(getattr(tables, f.name)) for f in fields(tables)})


def _passed(status: DataFrame) -> DataFrame:
    return status.where("status <> 'failed'").select("plan_id")


def run(plans: Plans) -> Result:
    n = normalize.normalize(plans).settled()
    # What the source reported belongs to the parse stage.
    found = settled(findings.distinct(parse_checks.validate(n).unionByName(plans.finding)))
    everyone = plans.frame.select("plan_id").unionByName(plans.finding.select("plan_id")).distinct()
    parse = settled(findings.rollup(everyone, found))
    sound = settled(_passed(parse).join(plans.frame.select("plan_id"), "plan_id", "left_semi"))

    model = comp.compile_model(_only(n, sound))
    topology = settled(comp.validate_topology(model))
    geometry = settled(findings.rollup(sound, topology))
    built = settled(_passed(geometry))
    model = settled(_only(model, built))

    views, placed = camera.place_viewpoints(model)
    views = settled(views)
    edges, loose = settled(camera.adjacency(model, views))
    seen = settled(findings.distinct(placed.unionByName(loose)))
    # A plan without a viewpoint has no camera plan at all.
    cams = findings.rollup(built, seen, warnings_matter=False)
    none = built.join(views.select("plan_id").distinct(), "plan_id", "left_anti").withColumn("bare", F.lit(True))
    cams = cams.join(none, "plan_id", "left").withColumn("exit_code", F.when(F.col("bare"), 2).otherwise(F.col("exit_code"))).withColumn("status", F.when(F.col("bare"), "operational").otherwise(F.col("status"))).drop("bare")
    tag = lambda df, stage: df.withColumn("stage", F.lit(stage))
    all_found = findings.union([tag(found, "parse"), tag(topology, "geometry"), tag(seen, "camera")])
    all_status = findings.union([tag(parse, "parse"), tag(geometry, "geometry"), tag(cams, "camera")])
    return Result(n, model, views, edges, camera.map_draft(views, edges), all_found, all_status, camera.coverage_report(model, views, edges, seen))
