import zlib
from collections import Counter, defaultdict

from plumbline.llm import sharding


def test_law_slots_and_cut(spark):
    rows = [(i, f"text {i}", 0) for i in range(300)] + [(1000 + i, f"group {i % 9}", 0) for i in range(180)] + [(2000 + i, "hot é", 0) for i in range(250)]
    rows += [(1, None, 0), (2, "", 0), (2, "", 0), (None, "no id", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int").repartition(6)
    got = sharding.assign(docs).collect()
    assert Counter((r.doc_id, r.text_crc32) for r in got) == Counter((d, zlib.crc32((t or "").encode())) for d, t, _ in rows)
    assert all(r.size in {len((t or "").encode()) + 8 for d, t, _ in rows if d == r.doc_id} and r.law == "rows" and r.grown_shard is None for r in got)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    places = defaultdict(set)
    for r in got:
        if r.doc_id and 1000 <= r.doc_id < 2000:
            places[r.text_crc32].add(r.shard)
    # Dealt at random, the nine groups would stand in some 120 places.
    assert sum(len(p) for p in places.values()) <= 40
    hot = {r.shard for r in got if r.doc_id and r.doc_id >= 2000}
    assert len(hot) <= 250 * 24 // len(rows) + 3


def test_few_rows(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "a")], "doc_id long, text string")
    assert sorted(r.slot for r in sharding.assign(docs).collect()) == [0, 0]
    assert sharding.assign(docs.limit(0)).count() == 0


def places(spark, hot, pairs, fours, singles):
    """Shards of each text, and rows a shard."""
    texts = ["hot"] * hot + [f"pair {i % pairs}" for i in range(2 * pairs)] + [f"four {i % fours}" for i in range(4 * fours)] + [f"alone {i}" for i in range(singles)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    found, slots = defaultdict(set), defaultdict(list)
    for r in sharding.assign(docs).collect():
        found[texts[r.doc_id]].add(r.shard)
        slots[r.shard].append(r.slot)
    assert sum(map(len, slots.values())) == len(texts)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    return found


def test_no_group_that_fits_is_split(spark):
    found = places(spark, 2400, 700, 500, 1800)
    assert [t for t, p in found.items() if t != "hot" and len(p) > 1] == []
    assert len(found["hot"]) == -(-2400 * 24 // 7600)


def test_no_row_without_a_link(spark):
    # Sizes are exact: the last groups may not fit, but fewer than there are shards.
    found = places(spark, 2500, 1251, 600, 0)
    assert sum(len(p) > 1 for t, p in found.items() if t != "hot") < 24
