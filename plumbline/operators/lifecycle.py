"""Runs and reviews: states, gates, rework targets and append-only chains."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

@dataclass(frozen=True)
class Machine:
    """A state machine, as read from its document."""

    transition: DataFrame  # from_state, to_state, gate, required, on_fail
    gate: DataFrame  # gate, name, human, evidence
    rework: DataFrame  # prefix, target
    terminal: tuple[str, ...]
    start: str


def read_machine(spark: SparkSession, path: str) -> Machine:
    """A machine from its JSON document (states, terminal_states, gates,
    transitions, rework_policy).  It is small and fixed: it is read once."""
    import json

    text = spark.read.text(path, wholetext=True).first().value
    return machine(spark, json.loads(text))


def machine(spark: SparkSession, doc: dict) -> Machine:
    rows = [(t["from"], t["to"], t.get("gate"), list(t.get("required_artifacts", [])), t.get("on_fail")) for t in doc["transitions"]]
    gates = [(k, g.get("name"), bool(g.get("human")), list(g.get("evidence", []))) for k, g in doc.get("gates", {}).items()]
    targets = list(doc.get("rework_policy", {}).get("default_targets_by_reason_prefix", {}).items())
    return Machine(
        spark.createDataFrame(rows, "from_state string, to_state string, gate string, required array<string>, on_fail string"),
        spark.createDataFrame(gates, "gate string, name string, human boolean, evidence array<string>"),
        spark.createDataFrame(targets, "prefix string, target string"),
        tuple(doc.get("terminal_states", ())),
        doc["states"][0],
    )


def reachable(m: Machine, most: int = 64) -> DataFrame:
    """state, depth: how many steps (`most` at the most) from the start."""
    m.transition.createOrReplaceTempView("plumbline_transitions")
    return m.transition.sparkSession.sql("""
        WITH RECURSIVE walk(state, depth) AS (
          SELECT :start, 0 UNION ALL
          SELECT t.to_state, w.depth + 1 FROM walk w JOIN plumbline_transitions t ON t.from_state = w.state WHERE w.depth < :most)
        SELECT state, min(depth) AS depth FROM walk GROUP BY state""", {"start": m.start, "most": most})


def next_states(events: DataFrame, m: Machine) -> DataFrame:
    """events: run, state, target, artifacts, failed, approved (whether an approval
    is bound to the content hash).  The state each event leads to, and why not.
    Any state that isn't terminal may go to BLOCKED or CANCELLED."""
    t = F.broadcast(m.transition.join(m.gate.select("gate", "human"), "gate", "left"))  # a few dozen rows
    j = events.join(t, (F.col("state") == F.col("from_state")) & (F.col("target") == F.col("to_state")), "left")
    human = F.coalesce("human", F.lit(False))
    lacks = F.size(F.array_except("required", "artifacts")) > 0
    reason = (
        F.when(F.col("state").isin(*m.terminal), "TERMINAL")
        .when(F.col("target").isin("CANCELLED", "BLOCKED"), None)
        .when(F.col("to_state").isNull(), "NO_TRANSITION")
        .when(F.col("failed"), "FAILED")
        .when(lacks, "MISSING_ARTIFACT")
        .when(human & ~F.col("approved"), "NOT_APPROVED")
    )
    to = F.when(reason.isNull(), F.col("target")).when(reason == "FAILED", F.col("on_fail")).otherwise(F.col("state"))
    return j.select("run", "state", "target", to.alias("next_state"), reason.alias("reason"))


def rework_targets(reasons: DataFrame, m: Machine) -> DataFrame:
    """reasons: code.  The state to return to, by the longest prefix that fits."""
    j = reasons.join(F.broadcast(m.rework), F.col("code").startswith(F.col("prefix")), "left")
    return j.groupBy("code").agg(F.max_by("target", F.length("prefix")).alias("target"))


def review_heads(reviews: DataFrame) -> DataFrame:
    """reviews: chain_id, ord, review_id, parent_id, supersedes.  The head of each
    chain: a review that supersedes starts the chain anew."""
    last = F.max(F.when(F.col("supersedes"), F.col("ord"))).over(Window.partitionBy("chain_id"))
    live = reviews.withColumn("since", F.coalesce(last, F.lit(0))).where("ord >= since")
    return live.groupBy("chain_id").agg(F.max_by("review_id", "ord").alias("current_head_id"), F.count("*").alias("length"))


def review_faults(reviews: DataFrame) -> DataFrame:
    """Reviews that reuse an id, or whose parent isn't earlier in the chain."""
    same = Window.partitionBy("chain_id", "review_id").orderBy("ord")
    r = reviews.withColumn("nth", F.row_number().over(same))
    first = r.where("nth = 1").select("chain_id", F.col("review_id").alias("parent_id"), F.col("ord").alias("parent_ord"))
    j = r.join(first, ["chain_id", "parent_id"], "left")
    bad = (F.col("nth") > 1) | (F.col("parent_id").isNotNull() & (F.col("parent_ord").isNull() | (F.col("parent_ord") >= F.col("ord"))))
    return j.where(bad).select("chain_id", "ord", "review_id", F.lit("REVIEW_LINEAGE_CYCLE").alias("code"))


def approvals(artifacts: DataFrame, records: DataFrame) -> DataFrame:
    """artifacts: artifact_id, content_hash; records: gate_id, decision,
    target_content_hash.  Whether each artifact is approved as it is now."""
    yes = records.where("decision = 'approve'").select(F.col("target_content_hash").alias("content_hash")).distinct().withColumn("approved", F.lit(True))
    return artifacts.join(yes, "content_hash", "left").fillna(False, ["approved"])


def merge_intervals(rows: DataFrame, gap, *by: str) -> DataFrame:
    """rows: by columns, lo, hi.  Intervals no further apart than the gap are one:
    islands by the running maximum of the ends."""
    w = Window.partitionBy(*by).orderBy("lo", "hi")
    before = F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1))
    r = rows.withColumn("new", F.coalesce((F.col("lo") - before > gap).cast("int"), F.lit(1)))
    r = r.withColumn("island", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return r.groupBy(*by, "island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.count("*").alias("n"))


def runs(rows: DataFrame, gap, *by: str) -> DataFrame:
    """rows: by columns, x.  Maximal runs in which neighbours are at most `gap` apart."""
    return merge_intervals(rows.select(*by, F.col("x").alias("lo"), F.col("x").alias("hi")), gap, *by)


def split_leaks(rows: DataFrame, family: str, split: str) -> DataFrame:
    """Families that occur in more than one split."""
    return rows.groupBy(family).agg(F.countDistinct(split).alias("splits")).where("splits > 1")


# Recognition invariants: blocking codes of arcs, thickness and spans.
SOURCE_CLASSES = ("cad_exact", "raster_auto", "annotation", "dxf")
PRODUCT_CLASSES = ("cad_exact", "raster_auto")


def recognition_codes(source_class, sagitta, bulge, sweep, thickness, kind, width) -> F.Column:
    """Codes of one wall or opening; null inputs that don't apply are skipped."""
    say = lambda cond, code: F.when(cond, F.lit(code))
    arc = kind == "circular_arc"
    return F.array_compact(
        F.array(
            say(~F.coalesce(source_class.isin(*SOURCE_CLASSES), F.lit(False)), "RECOGNITION_SOURCE_CLASS_INVALID"),
            say(arc & ~F.coalesce(sagitta >= 0, F.lit(False)), "RECOGNITION_ARC_NO_SAGITTA_BOUND"),
            say(arc & (bulge != 0) & sweep.isin("ccw", "cw") & ((bulge > 0) != (sweep == "ccw")), "RECOGNITION_ARC_BULGE_SWEEP_MISMATCH"),
            say(kind.isin("segment", "circular_arc") & source_class.isin(*PRODUCT_CLASSES) & ~F.coalesce(thickness > 0, F.lit(False)), "RECOGNITION_THICKNESS_MISSING"),
            say((kind == "passage") & (width > 3.0), "RECOGNITION_PASSAGE_SPAN_EXCEEDS_BOUND"),
            say(kind.isin("door", "window") & (width * 1000.0 > 1500.0), "RECOGNITION_OPENING_SPAN_EXCEEDS_BOUND"),
        )
    )
