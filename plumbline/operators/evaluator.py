"""Scores of recovered geometry against truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Z = 1.959963984540054
MAX_OPENING_MM, MIN_ANCHORS = 1500.0, 3


def geometry_key(*fields: Column) -> Column:
    """A key of geometry alone: no id, confidence or width."""
    return F.sha2(F.concat_ws("|", *(F.coalesce(f.cast("string"), F.lit("-")) for f in fields)), 256)


def matches(truth: DataFrame, predicted: DataFrame, *on: str) -> DataFrame:
    """One-to-one matches of equal keys: the n-th of a key on one side with the
    n-th on the other.  Both sides: `on` columns and an `ord` of their own."""
    rank = lambda df: df.withColumn("nth", F.row_number().over(Window.partitionBy(*on).orderBy("ord")))
    left, right = rank(truth).withColumnRenamed("ord", "truth_ord"), rank(predicted).withColumnRenamed("ord", "predicted_ord")
    return left.join(right.select(*on, "nth", "predicted_ord"), [*on, "nth"])


def plan_scores(truth: DataFrame, matched: DataFrame) -> DataFrame:
    """supportable, correct and score of each plan; 0 where nothing can be scored."""
    n = truth.groupBy("plan_id").agg(F.count_if("supported").alias("supportable"))
    m = matched.where("supported").groupBy("plan_id").agg(F.count("*").alias("correct"))
    out = n.join(m, "plan_id", "left").fillna(0, ["correct"])
    return out.withColumn("score", F.when(F.col("supportable") > 0, F.col("correct") / F.col("supportable")).otherwise(F.lit(0.0)))


def averages(scores: DataFrame) -> DataFrame:
    """Macro average over plans and micro average over records; 0 if there are none."""
    return scores.agg(F.coalesce(F.avg("score"), F.lit(0.0)).alias("macro"), F.coalesce(F.sum("correct") / F.nullif(F.sum("supportable"), F.lit(0)), F.lit(0.0)).alias("micro"))


def refusals(rows: DataFrame, scores: DataFrame) -> DataFrame:
    """rows: plan_id, kind.  A refusal of a supported input is a false negative."""
    n = rows.groupBy("plan_id").agg(F.count("*").alias("total"), F.count_if(F.col("kind") == "supported").alias("false_negative"))
    out = scores.select("plan_id", "supportable").join(n, "plan_id", "left").fillna(0, ["total", "false_negative"])
    return out.select("plan_id", "total", (F.col("total") - F.col("false_negative")).alias("handled"), "false_negative", F.when(F.col("supportable") > 0, F.col("total") / F.col("supportable")).otherwise(F.lit(0.0)).alias("refusal_rate"))


def lower_bound(successes: Column, trials: Column) -> Column:
    """3/n with no success, n / (n + z^2) with all, else Wilson's; null without
    trials or with more successes than trials."""
    n, p, z2 = trials.cast("double"), successes / trials, Z * Z
    wilson = (p + z2 / (2 * n) - Z * F.sqrt((p * (1 - p) + z2 / (4 * n)) / n)) / (1 + z2 / n)
    out = F.when(successes == 0, F.least(F.lit(3.0) / n, F.lit(1.0))).when(successes == trials, n / (n + z2)).otherwise(F.greatest(F.lit(0.0), wilson))
    return F.when((trials > 0) & successes.between(F.lit(0), trials), out)


def supported(kind: Column, max_sagitta: Column, width_mm: Column) -> Column:
    """Segments; arcs with a stated sagitta bound; openings of bounded span."""
    opening = kind.isin("door", "window", "passage") & (width_mm <= F.when(kind == "passage", 3000.0).otherwise(MAX_OPENING_MM))
    return F.coalesce(kind.isin("segment", "diagonal_3_4_5") | ((kind == "circular_arc") & (max_sagitta >= 0)) | opening, F.lit(False))


def scale_fit(anchors: DataFrame) -> DataFrame:
    """anchors: plan_id, real_length_m, span_px.  Median scale, largest deviation
    and largest disagreement (both relative); null with fewer than three."""
    per = anchors.where("span_px > 0").withColumn("mpp", F.col("real_length_m") / F.col("span_px"))
    mid = per.groupBy("plan_id").agg(F.median("mpp").alias("m"), F.min("mpp").alias("lo"), F.max("mpp").alias("hi"), F.count("*").alias("n"))
    enough = F.col("n") >= MIN_ANCHORS
    dev = F.greatest(F.col("hi") - F.col("m"), F.col("m") - F.col("lo")) / F.col("m")
    return mid.select("plan_id", F.when(enough, F.col("m")).alias("m_per_px"), F.when(enough, dev).alias("median_residual"), F.when(enough, (F.col("hi") - F.col("lo")) / F.col("m")).alias("disagreement"), F.col("n").alias("anchors"))


def convergence(truth: DataFrame, got: DataFrame, *counts: str) -> DataFrame:
    """Plans whose counts were recovered without errors, by kind of count."""
    j = truth.join(got, "plan_id", "left")
    return j.agg(F.count("*").alias("plans"), *[F.count_if(F.coalesce((F.col(c) == F.col(f"got_{c}")) & (F.col("errors") == 0), F.lit(False))).alias(f"{c}_converged") for c in counts])


def circle_fit(points: DataFrame, *by: str) -> DataFrame:
    """Algebraic circle fit (least squares) by group: sums, then a 3x3 solve by
    Cramer's rule.  Coordinates are centred first, which the fit allows."""
    mean = points.groupBy(*by).agg(F.avg("x").alias("mx"), F.avg("y").alias("my"))
    p = points.join(mean, list(by)).withColumn("u", F.col("x") - F.col("mx")).withColumn("v", F.col("y") - F.col("my"))
    s = lambda e, n: F.sum(F.expr(e)).alias(n)
    sums = p.groupBy(*by, "mx", "my").agg(s("u*u", "uu"), s("v*v", "vv"), s("u*v", "uv"), s("u*u*u", "uuu"), s("v*v*v", "vvv"), s("u*v*v", "uvv"), s("u*u*v", "uuv"), F.count("*").alias("n"))
    det = F.col("uu") * F.col("vv") - F.col("uv") * F.col("uv")
    a, b = (F.col("uuu") + F.col("uvv")) / 2, (F.col("vvv") + F.col("uuv")) / 2
    uc, vc = (a * F.col("vv") - b * F.col("uv")) / F.nullif(det, F.lit(0.0)), (b * F.col("uu") - a * F.col("uv")) / F.nullif(det, F.lit(0.0))
    return sums.select(*by, (F.col("mx") + uc).alias("cx"), (F.col("my") + vc).alias("cy"), F.sqrt(uc * uc + vc * vc + (F.col("uu") + F.col("vv")) / F.col("n")).alias("r"), "n")


def principal_extent(points: DataFrame, *by: str) -> DataFrame:
    """Extent (max - min + 1) of each group along its principal axis."""
    stats = points.groupBy(*by).agg(F.avg("x").alias("mx"), F.avg("y").alias("my"), F.var_pop("x").alias("a"), F.covar_pop("x", "y").alias("b"), F.var_pop("y").alias("c"))
    angle = F.atan2(F.col("b") * 2, F.col("a") - F.col("c")) / 2
    t = (F.col("x") - F.col("mx")) * F.cos(angle) + (F.col("y") - F.col("my")) * F.sin(angle)
    return points.join(stats, list(by)).groupBy(*by).agg((F.max(t) - F.min(t) + 1).alias("extent"))


def otsu(histogram: DataFrame, *by: str) -> DataFrame:
    """histogram: by columns, bin (0 to 255), n.  The threshold of the largest
    between-class variance (lowest on ties, ends left out) and its share of all."""
    full = histogram.select(*by).distinct().withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(255))))
    h = full.join(histogram, [*by, "bin"], "left").fillna(0, ["n"])
    w = Window.partitionBy(*by).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*by)
    h = h.withColumn("total", F.sum("n").over(whole)).where("total > 0").withColumn("mass", F.sum(F.col("n") * F.col("bin")).over(whole)).withColumn("square", F.sum(F.col("n") * F.col("bin") * F.col("bin")).over(whole))
    h = h.withColumn("below", F.sum("n").over(w)).withColumn("below_mass", F.sum(F.col("n") * F.col("bin")).over(w))
    spread = lambda n, m: F.when((n > 0) & (n < F.col("total")), (F.col("mass") * n - m * F.col("total")).cast("double") * (F.col("mass") * n - m * F.col("total")) / (n * (F.col("total") - n))).otherwise(F.lit(0.0))
    h = h.withColumn("score", spread(F.col("below"), F.col("below_mass"))).withColumn("variance", F.col("square") * F.col("total") - F.col("mass") * F.col("mass"))
    # The share counts what is strictly below the threshold.
    h = h.withColumn("eta", spread(F.col("below") - F.col("n"), F.col("below_mass") - F.col("n") * F.col("bin")))
    best = h.where("bin between 1 and 254").groupBy(*by).agg(F.max(F.struct("score", (-F.col("bin")).alias("low"), "eta")).alias("b"), F.max("variance").alias("variance"))
    return best.select(*by, (-F.col("b.low")).alias("threshold"), F.round(F.when(F.col("variance") > 0, F.col("b.eta") / F.col("variance")).otherwise(F.lit(0.0)), 9).alias("separability"))
