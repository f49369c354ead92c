"""Exact top-k inner-product search with MaxScore, shard by shard.

Each dimension is a term, each shard holds its postings (the dimension's column
of quantised components).  A query term's contribution lies between the query
component times the shard's smallest and largest posting, which bounds every
score.  Per query and shard: the best k of a first look set the threshold; terms
are ordered by the width of their bounds; the leading ones are essential and are
traversed for all rows; the rest are non-essential: they are probed, in groups,
only for rows whose score so far plus the bounds of what is left can still reach
the threshold, which rises to the k-th best of the scores' lower bounds.  Shards
are merged at last.  Where sums of products could leave 64 bits, pairs with large
components are scored in whole numbers of any size.

Edge cases: vectors that are null, empty, or hold a null or non-finite component
take no part; a score among a shard's best that doesn't fit 64 bits is an error, as
in SQL; a query meets vectors of its own length;
ties go to the smaller vec_id; rows with a null vec_id take no part; rows that
repeat a vec_id are candidates each, other than for a query of the same id.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.common import Work, table

K, SCALE = 10, 1024
#: Vectors in a shard and queries in a block: bounds what one task holds.
SHARD_ROWS, QUERY_ROWS = 8192, 512
#: Sums of products stay below, where int64 is used.
_LIMIT = 1 << 61
#: Terms that are probed together, between two looks at the bounds.
GROUP = 16


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, terms (floor(scale * x)) of all vectors that take part."""
    # Whole numbers as doubles: from 2**52 on all doubles are whole.
    scaled = lambda v: v * F.lit(float(scale))
    x = F.transform(F.col("embedding").cast("array<double>"), lambda v: F.when(F.abs(scaled(v)) < float(1 << 52), F.floor(scaled(v)).cast("double")).otherwise(scaled(v)))
    sound = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0)
    each = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < F.lit(float("inf"))))
    return vectors.where(sound).where(F.coalesce(each, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("terms"))


def shard_top(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, k: int):
    """The k best rows of one shard for each query, and how many scores were
    completed.  rows must be sorted by id, so that ties keep the smaller."""
    n, dims = rows.shape
    low, high = rows.min(axis=0), rows.max(axis=0)
    columns = np.ascontiguousarray(rows.T)
    out, complete = [], 0
    seed = np.arange(min(n, max(4 * k, 64)))
    for q, qid in zip(queries, query_ids):
        upper, lower = np.maximum(q * low, q * high), np.minimum(q * low, q * high)
        order = np.argsort(-(upper - lower), kind="stable")
        rest = np.concatenate([np.cumsum(upper[order][::-1])[::-1], [0]])
        least = np.concatenate([np.cumsum(lower[order][::-1])[::-1], [0]])
        first = rows[seed] @ q
        first = first[row_ids[seed] != qid]
        threshold = np.sort(first)[-k] if len(first) >= k else np.iinfo(np.int64).min
        # Essential: as many terms as it takes until the rest's spread is below
        # a fourth of all; without them no row can be told from another.
        spread = np.cumsum((upper - lower)[order])
        essential = int(np.searchsorted(spread, 0.75 * spread[-1])) + 1
        terms = order[:essential]
        alive = np.arange(n)
        score = q[terms] @ columns[terms]
        done = essential
        while True:
            sure = (score + least[done])[row_ids[alive] != qid]
            if len(sure) >= k:
                threshold = max(threshold, np.partition(sure, -k)[-k])
            keep = score + rest[done] >= threshold
            alive, score = alive[keep], score[keep]
            if done == dims or not len(alive):
                break
            terms = order[done : done + GROUP]
            score = score + rows[np.ix_(alive, terms)] @ q[terms]
            done += len(terms)
        keep = row_ids[alive] != qid
        alive, score = alive[keep], score[keep]
        complete += len(alive)
        best = np.lexsort((row_ids[alive], -score))[:k]
        out.append((np.full(len(best), qid), row_ids[alive][best], score[best]))
    parts = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, dtype=np.int64)] * 3
    return parts, complete


def exact_top(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, k: int):
    """shard_top()'s parts for whole numbers (as doubles) of any size."""
    limit = np.sqrt(_LIMIT / rows.shape[1])
    wide, broad = (np.abs(x).max(axis=1) >= limit for x in (rows, queries))
    narrow = ~wide
    out = []
    if narrow.any() and not broad.all():
        parts, _ = shard_top(queries[~broad].astype(np.int64), query_ids[~broad], rows[narrow].astype(np.int64), row_ids[narrow], k)
        out.append(parts)
    whole = np.frompyfunc(int, 1, 1)
    for b, mine in ((False, wide), (True, np.ones(len(rows), dtype=bool))):
        if not mine.any() or not (broad == b).any():
            continue
        numbers, ids = whole(rows[mine]), row_ids[mine]
        for q, qid in zip(whole(queries[broad == b]), query_ids[broad == b]):
            best = sorted((-x, i) for x, i in zip(numbers @ q, ids.tolist()) if i != qid)[:k]
            if any(abs(x) >= 1 << 63 for x, _ in best):
                raise OverflowError(f"a score of query {qid} doesn't fit 64 bits")
            out.append([np.full(len(best), qid), np.array([i for _, i in best], dtype=np.int64), np.array([-x for x, _ in best], dtype=np.int64)])
    return [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, dtype=np.int64)] * 3


def search(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best rows but its own.
    Both sides: vec_id, terms.  Queries meet the shards block by block."""
    work = Work(vectors.sparkSession, "maxscore", vectors)
    vectors = work.keep(vectors, "vectors")
    queries = work.keep(queries, "queries")
    n, m = vectors.count(), queries.count()
    shards, blocks = max(1, -(-n // SHARD_ROWS)), max(1, -(-m // QUERY_ROWS))
    shard = F.pmod(F.xxhash64("vec_id", "terms"), F.lit(shards)).cast("int")
    block = F.pmod(F.xxhash64("vec_id", "terms"), F.lit(blocks)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.lit(c - 1)))
    left = vectors.select(shard.alias("shard"), every(blocks).alias("block"), "vec_id", "terms")
    right = queries.select(every(shards).alias("shard"), block.alias("block"), "vec_id", "terms")

    def run(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found = []
        for size, mine in rows.groupby(rows["terms"].map(len)) if len(rows) else ():
            q = asked[asked["terms"].map(len) == size] if len(asked) else asked
            if not len(q):
                continue
            mine = mine.sort_values("vec_id", kind="stable")
            parts = exact_top(np.stack(q["terms"].to_numpy()), q["vec_id"].to_numpy(), np.stack(mine["terms"].to_numpy()), mine["vec_id"].to_numpy(), k)
            found.append(pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), parts))))
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")

    parts = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInPandas(run, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return parts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_exact_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = quantised(table(spark, sf_dir, "embeddings"))
    return search(vectors, vectors.where("vec_id % 100 = 0"))
