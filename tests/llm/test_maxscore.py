import math
import random

from plumbline.llm import maxscore


def test_equals_brute_force(spark, monkeypatch):
    rng = random.Random(9)
    monkeypatch.setattr(maxscore, "SHARD_ROWS", 60)
    monkeypatch.setattr(maxscore, "QUERY_ROWS", 2)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(24)], 1) for i in range(400)]
    rows += [(400 + i, list(rows[3][1]), 1) for i in range(30)]  # ties
    rows += [(500, [0.5] * 5, 1), (501, [0.25] * 5, 1), (600, None, 1), (601, [], 1), (602, [1.0, None], 1), (603, [float("nan")] * 24, 1), (604, [float("inf")] + [0.0] * 23, 1), (None, [1.0] * 24, 1)]
    vectors = maxscore.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int"))
    got = sorted(map(tuple, maxscore.search(vectors, vectors.where("vec_id % 100 = 0")).collect()))
    import numpy as np

    sound = {i: [math.floor(1024 * float(np.float32(x))) for x in v] for i, v, _ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    want = []
    for q in (i for i in sound if i % 100 == 0):
        scores = sorted((-sum(a * b for a, b in zip(sound[q], v)), i) for i, v in sound.items() if i != q and len(v) == len(sound[q]))
        want += [(q, r, i, -s) for r, (s, i) in enumerate(scores[:10], 1)]
    assert got == sorted(want)


def test_bounds_skip_work():
    import numpy as np

    rng = np.random.default_rng(1)
    rows = rng.integers(-50, 50, (2000, 32))
    rows[:40] += 400 * np.eye(40, 32, dtype=int)
    query = np.zeros((1, 32), dtype=int)
    query[0, :3] = (300, 200, 5)
    (_, ids, scores), complete = maxscore.shard_top(query, np.array([-1]), rows, np.arange(2000), 10)
    want = sorted(((-int(s), i) for i, s in enumerate(rows @ query[0])))[:10]
    assert [(-s, i) for s, i in zip(scores.tolist(), ids.tolist())] == want and complete < 2000


def test_no_rows(spark):
    none = maxscore.quantised(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert maxscore.search(none, none).count() == 0


def test_large_components(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(1, 150)]
    rows += [(200, [float(1 << 19)] + [0.5] * 7), (201, [0.0, float(-(1 << 30))] + [0.25] * 6), (300, [float(1 << 20)] + [0.0] * 7), (400, [0.0] * 7 + [float(1 << 45)])]
    rows += [(500, [0.0] * 8)]
    vectors = maxscore.quantised(spark.createDataFrame(rows[:-2] + rows[-1:], "vec_id long, embedding array<float>"))
    got = sorted(map(tuple, maxscore.search(vectors, vectors.where("vec_id % 100 = 0")).collect()))
    import numpy as np

    sound = {i: [math.floor(1024 * float(np.float32(x))) for x in v] for i, v in rows if i != 400}
    want = []
    for q in (i for i in sound if i % 100 == 0):
        scores = sorted((-sum(a * b for a, b in zip(sound[q], v)), i) for i, v in sound.items() if i != q)
        want += [(q, r, i, -s) for r, (s, i) in enumerate(scores[:10], 1)]
    assert got == sorted(want)
    assert {200, 300} <= {r[0] for r in got}
    assert maxscore.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).count() == len(rows)


def test_threshold_rises():
    import numpy as np

    # The best rows come after the first look.
    rng = np.random.default_rng(2)
    rows = rng.integers(-50, 50, (4000, 64))
    rows[2000:2040, :] += 300
    query = np.arange(64, 0, -1)[None, :]
    (_, ids, scores), complete = maxscore.shard_top(query, np.array([-1]), rows, np.arange(4000), 10)
    want = sorted((-int(s), i) for i, s in enumerate(rows @ query[0]))[:10]
    assert [(-s, i) for s, i in zip(scores.tolist(), ids.tolist())] == want and complete <= 40
