"""URL filters: allow and block rules, and boosted trees where no rule fits.

Rules are (host, path) pairs: a rule fits its host and all its subdomains if the
url's path starts with the rule's; the longest rule wins (ties: the smaller).

Where none fits, gradient-boosted trees decide on lexical features: length,
path depth, digit ratio, character entropy, parameter counts and more, and the
share of blocked urls among the labelled ones of the same host suffix.  The trees
are fitted on no more than TRAIN_ROWS labelled urls (chosen by hash; statistics
by suffix cover all of them) and become one column expression, so scoring is a
projection.  With labels of one kind only, all else gets that verdict; with no
labels, `allow`.

Edge cases: a null url, or one without `://`, has an empty host and path; no
rule fits an empty host; rows that repeat are judged each; an empty table gives
no rows; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import Work, table

TRAIN_ROWS = 20_000
TREES, DEPTH, RATE, BINS, LEAST = 30, 3, 0.2, 16, 20
#: Suffix statistics (some 40 bytes a row) up to which they are broadcast.
BROADCAST_ROWS = 100_000
RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)
FEATURES = ("length", "host_length", "host_labels", "depth", "digit_ratio", "entropy", "params", "hyphens", "path_length", "has_fragment", "suffix_blocked", "suffix_log_count")


def with_parts(pages: DataFrame) -> DataFrame:
    """pages (url) with host, path and query."""
    at = F.locate("://", F.col("url"))
    rest = F.when(F.coalesce(at, F.lit(0)) > 0, F.expr("substring(url, locate('://', url) + 3)")).otherwise(F.lit(""))
    df = pages.withColumn("_rest", rest).withColumn("_host", F.regexp_extract("_rest", r"^[^/?#]*", 0))
    after = F.expr("substring(_rest, length(_host) + 1)")
    df = df.withColumn("_after", after).withColumn("path", F.regexp_extract("_after", r"^[^?#]*", 0))
    df = df.withColumn("_query", F.expr("substring(_after, length(path) + 1)"))
    return df.withColumn("host", F.translate("_host", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def with_rule(pages: DataFrame, rules=RULES) -> DataFrame:
    """pages (host, path) with the rule that fits and its verdict, or nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, host, path in sorted(rules, key=lambda r: (len(r[1] + r[2]), [-ord(c) for c in r[1] + r[2]])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, F.lit(host + path)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return pages.withColumn("rule", rule).withColumn("rule_verdict", verdict)


def _count(c: Column, char: str) -> Column:
    return (F.length(c) - F.length(F.replace(c, F.lit(char), F.lit("")))).cast("double")


def with_features(pages: DataFrame) -> DataFrame:
    url = F.coalesce("url", F.lit(""))
    n = F.length(url)
    kinds = F.array_distinct(F.split(url, ""))
    share = lambda c: (n - F.length(F.replace(url, c, F.lit("")))) / F.greatest(n, F.lit(1))
    entropy = F.aggregate(F.filter(kinds, lambda c: c != ""), F.lit(0.0), lambda s, c: s - share(c) * F.log2(share(c)))
    return (
        pages.withColumn("length", n.cast("double"))
        .withColumn("host_length", F.length("host").cast("double"))
        .withColumn("host_labels", _count(F.col("host"), "."))
        .withColumn("depth", _count(F.col("path"), "/"))
        .withColumn("digit_ratio", F.length(F.regexp_replace(url, "[^0-9]", "")) / F.greatest(n, F.lit(1)))
        .withColumn("entropy", entropy)
        .withColumn("params", _count(F.col("_query"), "=") + _count(F.col("_query"), "&"))
        .withColumn("hyphens", _count(F.col("host"), "-"))
        .withColumn("path_length", F.length("path").cast("double"))
        .withColumn("has_fragment", F.col("_query").contains("#").cast("double"))
        .withColumn("suffix", F.substring_index("host", ".", -1))
    )


def with_suffix_statistics(pages: DataFrame, labelled: DataFrame, own: bool = False) -> DataFrame:
    """Smoothed share of blocked urls, and how many there are, by last host label.
    own: pages are labelled themselves, and each is left out of its own statistics."""
    stats = labelled.groupBy("suffix").agg(F.sum("blocked").alias("b"), F.count("*").alias("n"))
    # Small by check, not by hope; beyond the bound it is a plain join.
    small = stats.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    out = pages.join(F.broadcast(stats) if small else stats, "suffix", "left")
    b, n = (F.coalesce(c, F.lit(0)) for c in ("b", "n"))
    b, n = (b - F.col("blocked"), n - 1) if own else (b, n)
    return out.withColumn("suffix_blocked", (b + 1) / (n + 2)).withColumn("suffix_log_count", F.log1p(n.cast("double"))).drop("b", "n")


class Trees:
    """Gradient-boosted regression trees for log loss, on binned features."""

    def __init__(self) -> None:
        self.base = 0.0
        self.trees: list = []

    def fit(self, x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
        p = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
        self.base = math.log(p / (1 - p))
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        bins = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)], axis=1)
        score = np.full(len(y), self.base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-score))
            grad, hess = y - p, p * (1 - p)
            tree = self._grow(bins, cuts, grad, hess, np.arange(len(y)), depth)
            self.trees.append(tree)
            score += self._apply(tree, x)
        return self

    def _grow(self, bins, cuts, grad, hess, rows, depth):
        g, h = grad[rows].sum(), hess[rows].sum()
        leaf = RATE * g / (h + 1.0)
        if depth == 0 or len(rows) < 2 * LEAST:
            return leaf
        best = (1e-6, None, None)
        for f, c in enumerate(cuts):
            b = bins[rows, f]
            n = len(c) + 1
            gs, hs, ns = (np.cumsum(np.bincount(b, weights=w, minlength=n))[:-1] for w in (grad[rows], hess[rows], None))
            gain = np.where((ns >= LEAST) & (len(rows) - ns >= LEAST), gs**2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g * g / (h + 1), 0)
            if len(gain) and gain.max() > best[0]:
                best = (float(gain.max()), f, int(gain.argmax()))
        _, f, k = best
        if f is None:
            return leaf
        left = bins[rows, f] <= k
        grow = lambda part: self._grow(bins, cuts, grad, hess, part, depth - 1)
        return (f, float(cuts[f][k]), grow(rows[left]), grow(rows[~left]))

    def _apply(self, tree, x: np.ndarray) -> np.ndarray:
        if not isinstance(tree, tuple):
            return np.full(len(x), tree)
        f, cut, low, high = tree
        return np.where(x[:, f] <= cut, self._apply(low, x), self._apply(high, x))

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.base + sum(self._apply(t, x) for t in self.trees)

    def column(self, features=FEATURES) -> Column:
        """The score as one expression."""

        def expr(tree) -> Column:
            if not isinstance(tree, tuple):
                return F.lit(float(tree))
            f, cut, low, high = tree
            return F.when(F.col(features[f]) <= F.lit(cut), expr(low)).otherwise(expr(high))

        out = F.lit(self.base)
        for t in self.trees:
            out = out + expr(t)
        return out


def train(labelled: DataFrame, most: int = TRAIN_ROWS) -> Trees | None:
    """labelled: page_id, url, blocked (0 or 1) and FEATURES."""
    # The rows below a bound on their hash: somewhat more than needed in all, so no
    # task sends more than its share of them.
    share = min(1.0, (1.2 * most + 100) / max(1, labelled.count()))
    rows = labelled.select(*FEATURES, "blocked", F.pmod(F.xxhash64("page_id", "url"), F.lit(1 << 40)).alias("pick"))
    rows = rows.where(F.col("pick") < int(share * (1 << 40))).orderBy("pick").limit(most).collect()
    if not rows:
        return None
    data = np.array([tuple(r)[:-1] for r in rows], dtype=np.float64)
    return Trees().fit(data[:, :-1], data[:, -1])


def judge(pages: DataFrame, labels: DataFrame | None = None, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, score of every row (page_id, url).

    labels: page_id, url, blocked; without them, urls that a rule fits are the
    labelled ones, with the rule's verdict."""
    Work(pages.sparkSession, "urls")
    base = with_features(with_rule(with_parts(pages.select("page_id", "url")), rules))
    if labels is None:
        known = base.where("rule is not null").withColumn("blocked", (F.col("rule_verdict") == "block").cast("int"))
    else:
        known = with_features(with_rule(with_parts(labels.select("page_id", "url", "blocked")), rules))
    base, sample = with_suffix_statistics(base, known), with_suffix_statistics(known, known, own=True)
    trees = train(sample)
    score = F.lit(0.0) - 1 if trees is None else trees.column()
    out = base.withColumn("score", score)
    verdict = F.coalesce("rule_verdict", F.when(F.col("score") > 0, F.lit("block")).otherwise(F.lit("allow")))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")
