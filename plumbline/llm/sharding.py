"""Sharding by balanced label propagation.

Linked documents should share a shard, and shards should be even (law `rows`:
counts at most one apart).  A link group stands for its links (all its documents
are each other's neighbours), so a round needs no pairs: a document wants to the
shard that holds most of its group.

Large groups (over a share of 1/BIG of a shard, so at most BIG for each shard) are
packed first, largest first: into the fullest shard that holds them, else they fill
the emptiest shard and their rest is packed like a group of its own.  A group
larger than a shard so gets whole shards, and no other group starts in those.

The rows of small groups are dealt over the room that is left.  Each round: rows are
counted by group and shard; those of a group want to its fullest shard, ties by
hash, wherever they stand; wishes are counted by pair of shards; a shard grants the
share of its wishes that its room and the rows that leave it allow (its quota); a
hash of the group settles who moves, and all tasks agree without talking.  A shard
that granted less than half isn't wished for in the next round.  Rounds end when
few wishes are left or after ROUNDS.

A last step makes sizes exact, whatever the rounds left: groups keep their fullest
shard, whole, as far as its room goes; the others are laid whole over the free
places, larger ones first; the few that meet an end of a shard are packed like
large ones.  So a group is only split if no shard had room for it when it was
packed, and rows without a link fill what is left.

Edge cases: a null text has no bytes, crc32 0 and is in a group with other
null and empty texts; rows that repeat are rows of their own; an empty table
gives no rows; with more shards than rows some shards stay empty.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.common import Work, partitions, table

SHARDS, ROUNDS, ENOUGH, BIG = 24, 6, 0.002, 64


def pack(groups: list[tuple[int, int]], room: list[int]) -> list[tuple[int, int, int, int]]:
    """(group, members), largest first -> (group, first, last, shard): ranks in the
    group from first up to last.  Takes the places from room."""
    left = [(-members, group, 0) for group, members in groups]
    heapq.heapify(left)
    out = []
    while left:
        less, group, first = heapq.heappop(left)
        members = -less
        fits = [(r, k) for k, r in enumerate(room) if r >= members]
        r, k = min(fits) if fits else max((r, -k) for k, r in enumerate(room))
        k, n = (k, members) if fits else (-k, r)
        out.append((group, first, first + n, k))
        room[k] -= n
        if n < members:
            heapq.heappush(left, (n - members, group, first + n))
    return out


def _interval(ends: list[int], at: Column) -> Column:
    """The first interval that ends after `at`."""
    return F.size(F.filter(F.array(*[F.lit(x).cast("long") for x in ends]), lambda e: e <= at))


def _ends(numbers: list[int]) -> list[int]:
    return [sum(numbers[: k + 1]) for k in range(len(numbers))]


def _of(numbers: list[int], k: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x).cast("long") for x in numbers]), k + 1)


def propagate(small: DataFrame, room: list[int], total: int, work: Work, rounds: int = ROUNDS) -> DataFrame:
    """small: uid, group of the rows of small groups.  group, members, shard and
    places (shards that the group stands in) after the rounds, under the quotas."""
    spark, shards = work.spark, len(room)
    ends = _ends(room)
    start = _interval(ends, F.pmod(F.xxhash64("uid", F.lit("start")), F.lit(max(ends[-1], 1))))
    state = work.keep(small.groupBy("group", start.alias("shard")).agg(F.count("*").alias("n")), "round0")
    closed: list[int] = []
    for step in range(1, rounds + 1):
        # The fullest shard that isn't closed, ties by hash.
        rank = F.struct((~F.col("shard").isin(closed)).alias("open"), "n", F.xxhash64("group", "shard", F.lit(step)).alias("tie"), "shard")
        best = state.groupBy("group").agg(F.max(rank).getField("shard").alias("best"))
        wish = work.keep(state.join(best, "group"), f"wish{step}")
        # A row for each pair of shards, whatever the input.
        flow = {(r.shard, r.best): r.n for r in wish.groupBy("shard", "best").agg(F.sum("n").alias("n")).collect()}
        free = [room[k] - sum(n for (a, _), n in flow.items() if a == k) for k in range(shards)]
        flow = {ab: n for ab, n in flow.items() if ab[0] != ab[1]}
        asked = [sum(n for (_, b), n in flow.items() if b == k) for k in range(shards)]
        if sum(asked) <= ENOUGH * total:
            break
        # The largest shares under which no shard exceeds its room: who leaves makes room.
        share = [1.0] * shards
        for _ in range(100):
            leave = [sum(n * share[b] for (a, b), n in flow.items() if a == k) for k in range(shards)]
            share = [min(1.0, max(0.0, (free[k] + leave[k]) / asked[k])) if asked[k] else 1.0 for k in range(shards)]
        closed = [k for k in range(shards) if share[k] < 0.5]
        quota = F.element_at(F.array(*[F.lit(x) for x in share]), F.col("best") + 1)
        chance = F.pmod(F.xxhash64("group", F.lit(step)), F.lit(1 << 30)) / F.lit(float(1 << 30))
        moved = wish.withColumn("shard", F.when(chance < quota, F.col("best")).otherwise(F.col("shard")))
        state = work.keep(moved.groupBy("group", "shard").agg(F.sum("n").alias("n")), f"round{step}")
        work.drop(f"round{step - 1}", f"wish{step}")
        work.release()
    most = F.max(F.struct("n", F.xxhash64("group", "shard").alias("tie"), "shard")).getField("shard")
    return state.groupBy("group").agg(F.sum("n").alias("members"), most.alias("shard"), F.count("*").alias("places"))


def ranked(rows: DataFrame, work: Work, name: str, *order: str, weight: str | None = None) -> DataFrame:
    """rows with `rank`: the gapless position (from 0) in the order, or the sum of
    the weights before, without bringing all rows to one task: range partitions,
    counted, then numbered."""
    n = partitions(work.spark)
    sorted_ = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    placed = work.keep(sorted_.withColumn("part", F.spark_partition_id()), name)
    one = F.col(weight) if weight else F.lit(1)
    # A row for each partition.
    sizes = {r.part: r.n for r in placed.groupBy("part").agg(F.sum(one).alias("n")).collect()}
    before, starts = 0, []
    for part in sorted(sizes):
        starts.append((part, before))
        before += sizes[part]
    starts = work.spark.createDataFrame(starts, "part int, before long")
    window = Window.partitionBy("part").orderBy(*order)
    inside = F.sum(one).over(window.rowsBetween(Window.unboundedPreceding, 0)) - one if weight else F.row_number().over(window) - 1
    return placed.withColumn("inside", inside).join(F.broadcast(starts), "part").withColumn("rank", F.col("before") + F.col("inside")).drop("part", "inside", "before")


def settle(homes: DataFrame, room: list[int], work: Work) -> tuple[DataFrame, list[tuple[int, int, int, int]]]:
    """homes as propagate() gives them: (group, shard) of those that have a place as
    a whole, and pieces as pack() gives them of the few others.  Takes the places
    from room."""
    shards = len(room)
    homes = homes.withColumn("torn", F.col("places") > 1).withColumn("less", -F.col("members"))
    homes = ranked(homes, work, "homes", "shard", "torn", "less", "group", weight="members")
    sums = {r.shard: r.n for r in homes.groupBy("shard").agg(F.sum("members").alias("n")).collect()}
    first = [0, *_ends([sums.get(k, 0) for k in range(shards)])[:-1]]
    end = F.col("rank") - _of(first, F.col("shard")) + F.col("members")
    homes = work.keep(homes.withColumn("stays", end <= _of(room, F.col("shard"))).drop("rank"), "stays")
    for r in homes.where("stays").groupBy("shard").agg(F.sum("members").alias("n")).collect():
        room[r.shard] -= r.n
    kept = homes.where("stays").select("group", "shard")
    pool = ranked(homes.where("not stays").select("group", "members", "less"), work, "evicted", "less", "group", weight="members")
    order = sorted(range(shards), key=lambda k: (-room[k], k))
    ends = _ends([room[k] for k in order])
    at = _interval(ends, F.col("rank"))
    pool = pool.withColumn("at", at).withColumn("whole", at == _interval(ends, F.col("rank") + F.col("members") - 1))
    pool = work.keep(pool.withColumn("shard", _of(order, F.col("at")).cast("int")).drop("rank", "less", "at"), "laid")
    for r in pool.where("whole").groupBy("shard").agg(F.sum("members").alias("n")).collect():
        room[r.shard] -= r.n
    # At most one for each end of a shard.
    torn = [(r.group, r.members) for r in pool.where("not whole").collect()]
    return kept.unionByName(pool.where("whole").select("group", "shard")), pack(torn, room)


def assign(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row of
    docs (doc_id, text)."""
    work = Work(docs.sparkSession, "shards", docs.select("doc_id"))
    spark = work.spark
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("group"),
    ).withColumn("uid", F.xxhash64("doc_id", "group"))
    rows = work.keep(rows, "rows")
    groups = work.keep(rows.groupBy("group").agg(F.count("*").alias("members")).where("members > 1"), "groups")
    total = rows.count()
    size = [total * (k + 1) // shards - total * k // shards for k in range(shards)]
    room = list(size)
    # Fewer than BIG * shards groups are that large.
    large = F.col("members") * BIG * shards > total
    pieces = pack([(r.group, r.members) for r in groups.where(large).collect()], room)
    packed = F.broadcast(spark.createDataFrame(sorted({(p[0],) for p in pieces}), "group long"))
    others = rows.join(packed, "group", "left_anti")
    small = others.join(groups.where(~large).select("group"), "group", "left_semi").select("uid", "group")
    homes, more = settle(propagate(small, room, total, work, rounds), room, work)
    pieces += more
    # Whole groups by a plain join; at most `shards` groups (and a few of the last
    # step) are in pieces, by the ranks of their rows.
    several = {g for g, first, *_ in pieces if first}
    one = spark.createDataFrame([(g, k) for g, _, _, k in pieces if g not in several], "group long, shard int")
    cut = F.broadcast(spark.createDataFrame(sorted((g,) for g in several), "group long"))
    linked = rows.join(F.broadcast(one), "group").unionByName(_cut(rows.join(cut, "group", "left_semi"), pieces, several, work))
    known = F.broadcast(spark.createDataFrame(sorted({(p[0],) for p in pieces}), "group long"))
    rest = work.keep(rows.join(known, "group", "left_anti").join(homes, "group", "left"), "rest")
    linked = linked.unionByName(rest.where("shard is not null"))
    out = work.few(fill(linked, rest.where("shard is null").drop("shard"), size, work))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def _cut(rows: DataFrame, pieces: list[tuple[int, int, int, int]], several: set[int], work: Work) -> DataFrame:
    """rows of groups in pieces, with their shards."""
    parts = sorted(p for p in pieces if p[0] in several)
    counts = _ends([last - first for _, first, last, _ in parts])
    # Ranks count through all these groups, in the order of the pieces.
    rank = ranked(rows, work, "cut", "group", "doc_id")
    shard = _of([p[3] for p in parts], _interval(counts, F.col("rank"))) if parts else F.lit(None)
    return rank.withColumn("shard", shard.cast("int")).drop("rank")


def fill(linked: DataFrame, alone: DataFrame, size: list[int], work: Work) -> DataFrame:
    """Slots: linked rows (with shard, no more than its size) in the order of their
    groups, then the free places for rows without a link."""
    linked = work.keep(linked, "linked")
    counts = {r.shard: r.n for r in linked.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    stay = [counts.get(k, 0) for k in range(len(size))]
    shard = F.col("shard")
    placed = ranked(linked, work, "placed", "shard", "group", "doc_id").withColumn("slot", F.col("rank") - _of([0, *_ends(stay)[:-1]], shard)).drop("rank")
    ends = _ends([a - b for a, b in zip(size, stay)])
    filled = ranked(alone, work, "pool", "group", "doc_id")
    filled = filled.withColumn("shard", _interval(ends, F.col("rank")).cast("int"))
    filled = filled.withColumn("slot", F.col("rank") - _of([0, *ends[:-1]], shard) + _of(stay, shard)).drop("rank")
    return placed.unionByName(filled)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(table(spark, sf_dir, "documents"))
