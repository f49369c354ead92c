import random
import re

from plumbline.llm import decontamination

ITEMS = [(1, "the quick brown fox jumps over the lazy dog and runs away from all of them today"), (2, "only three words"), (3, None), (4, ""), (5, "One Two three four FIVE six seven")]


def grams(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute(docs, items):
    out = []
    for i, text in items:
        k = min(5, len((text or "").split()))
        g = grams(text, k) if k else set()
        for d, t in docs:
            n = len(g & grams(t, k)) if g else 0
            if g and 100 * n >= 80 * len(g):
                out.append((d, i, len(g), n))
    return sorted(out)


def test_equals_brute_force(spark):
    rng = random.Random(4)
    noise = lambda n: " ".join(rng.choice("abcdefgh") + str(rng.randint(0, 99)) for _ in range(n))
    item = ITEMS[0][1]
    words = item.split()
    broken = " ".join(words[:6] + ["zzz"] + words[7:])
    docs = [
        (1, noise(900) + " " + item.upper() + "\n" + noise(2000)),
        (2, noise(50) + " " + " ".join(words[1:]) + " " + noise(4)),
        (3, noise(10) + " " + broken),
        (4, None),
        (5, "  "),
        (6, "we have only\tthree  words here"),
        (7, "one two three four five six seven"),
        (7, "one two three four five six seven"),
        (8, noise(3000)),
    ]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontamination.contaminated(spark.createDataFrame([(d, t, 0) for d, t in docs], "doc_id long, text string, item_id int"), items).collect()
    assert sorted((r.doc_id, r.item_id, r.n_item, r.n_found) for r in got) == brute(docs, ITEMS)


def test_nothing_to_find(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    assert decontamination.contaminated(docs, spark.createDataFrame([], "item_id long, text string")).count() == 0
    assert decontamination.contaminated(docs.limit(0), spark.createDataFrame(ITEMS, "item_id long, text string")).count() == 0


def test_no_python_on_executors(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    plan = decontamination.contaminated(docs, spark.createDataFrame(ITEMS, "item_id long, text string"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|MapInArrow|ArrowEval", plan)


def test_null_and_repeated_ids(spark):
    docs = spark.createDataFrame([(None, "x a b c d e f g y"), (2, "h i j k l m")], "doc_id long, text string")
    items = [(None, "a b c d e f g"), (None, "h i j k l m"), (4, "a b c d e f g"), (4, "h i j k l m"), (4, "h i j k l m")]
    got = decontamination.contaminated(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted(((r.doc_id, r.item_id, r.n_item, r.n_found) for r in got), key=str) == sorted([(None, None, 3, 3), (None, 4, 3, 3), (2, None, 2, 2), (2, 4, 2, 2)], key=str)


def test_partitions_hold_all_that_can_contain(spark):
    rows = [(n,) for n in [1, 2, 3, 4, 7, 8, 1000, 65535, 65536, 10**6]]
    df = spark.createDataFrame(rows, "n long")
    got = {r.n: r.p for r in df.select("n", decontamination.partition(df.n).alias("p")).collect()}
    assert got == {n: min(n.bit_length() - 1, decontamination.TOP) for (n,) in rows}
