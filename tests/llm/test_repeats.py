import hashlib
import random
import re
from collections import Counter

import pytest

from plumbline.llm import debruijn_dedup, suffix_dedup
from plumbline.llm.common import Work


def brute(sequences, window):
    seen = Counter(tuple(s[i : i + window]) for s in sequences for i in range(len(s) - window + 1))
    covers = []
    for s in sequences:
        cover = [False] * len(s)
        for i in range(len(s) - window + 1):
            if seen[tuple(s[i : i + window])] > 1:
                cover[i : i + window] = [True] * window
        covers.append(cover)
    return covers


def corpus(seed):
    rng = random.Random(seed)
    vocab = ["ab", "é", "zz.", "x" * 9, "Foo", "foo", "b,", "longer-word"] + [f"w{i}" for i in range(60)]
    passages = [[rng.choice(vocab) for _ in range(rng.choice([36, 60, 200]))] for _ in range(6)]
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "aaaa " * 300), (5, "q" * 900), (6, "tiny text")]
    for _ in range(50):
        words = []
        for _ in range(rng.randint(1, 4)):
            if rng.random() < 0.5:
                words += [rng.choice(vocab) for _ in range(rng.randint(1, 80))]
            else:
                p = rng.choice(passages)
                a = rng.randint(0, 20)
                words += p[a : a + rng.randint(20, 200)]
        rows.append((len(rows) + 1, rng.choice(["", " "]) + rng.choice([" ", "  ", "\n"]).join(words)))
    rows += [(100, rows[20][1]), (101, rows[20][1]), (101, rows[20][1])]
    return rows


@pytest.mark.parametrize("seed,window", [(1, 400), (2, 60)])
def test_bytes_equal_brute_force(spark, seed, window):
    rows = corpus(seed)
    texts = [(t or "").encode() for _, t in rows]
    want = []
    for (d, _), t, cover in zip(rows, texts, brute(texts, window)):
        kept = bytes(c for c, gone in zip(t, cover) if not gone)
        spans = sum(1 for i, gone in enumerate(cover) if gone and not (i and cover[i - 1]))
        want.append((d, len(t), sum(cover), spans, hashlib.sha256(kept).hexdigest()))
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, spans int").repartition(5)
    got = suffix_dedup.dedup(docs, window).collect()
    got = [(r.doc_id, r.n_bytes, sum(s.stop - s.start for s in r.spans), len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in got]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("seed,window", [(3, 35), (4, 12)])
def test_words_equal_brute_force(spark, seed, window):
    rows = corpus(seed)
    words = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for _, t in rows]
    want = []
    for (d, _), w, cover in zip(rows, words, brute(words, window)):
        want.append((d, len(w), sum(cover), b" ".join(x for x, gone in zip(w, cover) if not gone).decode()))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = debruijn_dedup.dedup(docs, window).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == sorted(want)
    for r in got:
        if r.text_kept is not None:
            assert re.split(r"[\x20\x09-\x0D]+", r.text_kept.strip(" \t\n\v\f\r")) == r.kept.split(" ")
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].text_kept is None and by_id[6].text_kept == "tiny text"


def test_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.dedup(none).count() == 0
    assert debruijn_dedup.dedup(none).count() == 0


def test_long_rows_go_in_pieces(spark, monkeypatch):
    from plumbline.llm import repeats

    monkeypatch.setattr(repeats, "PIECE", 700)
    monkeypatch.setattr(repeats, "SLICE_BYTES", 800)
    rng = random.Random(5)
    text = "".join(rng.choice("abcdef ") for _ in range(3000))
    rows = [(1, text), (2, "xyz" * 10 + text[350:2700]), (3, text[900:1299])]
    texts = [t.encode() for _, t in rows]
    want = [(d, sum(c)) for (d, _), c in zip(rows, brute(texts, 400))]
    got = suffix_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, sum(s.stop - s.start for s in r.spans)) for r in got) == want


def test_paths_name_what_repeats(spark):
    """Compaction: a passage is one path with one name wherever it stands."""
    rng = random.Random(8)
    word = lambda: f"v{rng.randint(0, 10**6)}"
    long, short = [word() for _ in range(300)], [word() for _ in range(120)]
    noise = lambda: [word() for _ in range(rng.randint(40, 90))]
    rows = [(1, noise() + long + noise()), (2, noise() + long + noise() + short), (3, short + noise() + long), (4, noise())]
    docs = spark.createDataFrame([(d, " ".join(w), 7) for d, w in rows], "doc_id long, text string, paths int")
    got = {r.doc_id: r.paths for r in debruijn_dedup.dedup(docs, 35).collect()}
    assert [len(got[d]) for d in (1, 2, 3, 4)] == [1, 2, 2, 0]
    assert got[1][0].path == got[2][0].path == got[3][1].path != got[2][1].path == got[3][0].path
    for d, w in rows:
        for p in got[d]:
            read = w[p.start : p.stop]
            assert len(read) >= 70 and any(read == x[i : i + len(read)] for x in (long, short) for i in range(len(x)))


def test_columns_named_like_results_stay(spark):
    docs = spark.createDataFrame([(1, "a b", 5, "k", 2.5), (None, None, 6, None, None)], "doc_id long, text string, n_words int, kept string, uid double")
    got = debruijn_dedup.passage_free(docs)
    assert got.columns == docs.columns and got.dtypes == docs.dtypes
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, docs.collect()), key=str)


def test_structured_texts_do_not_collide(spark):
    """Thue-Morse strings agree under polynomials modulo 2**64."""
    t = "a"
    while len(t) < 1024:
        t += t.translate(str.maketrans("ab", "ba"))
    rows = [(1, "ab" * 300 + t), (2, t.translate(str.maketrans("ab", "ba")) + "xy" * 9)]
    texts = [x.encode() for _, x in rows]
    want = [sum(c) for c in brute(texts, 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: sum(s.stop - s.start for s in r.spans) for r in suffix_dedup.dedup(docs, 400).collect()}
    assert [got[1], got[2]] == want


def test_words_at_source_coordinates_decide(spark):
    """A path whose places don't read the same, as if hashes had collided."""
    rows = [(1, "a  b c d"), (2, "a b\nc e"), (3, " a b c f"), (3, " a b c f")]
    docs = spark.createDataFrame(rows, "uid long, text string")
    places = [(1, 0, 3, 7, 7, True), (2, 0, 3, 7, 7, True)]  # a b c twice
    places += [(1, 1, 4, 8, 8, True), (2, 1, 4, 8, 8, True)]  # b c d, b c e
    places += [(3, 1, 4, 9, 9, True)]  # in two rows that are equal
    places += [(1, 1, 3, None, 5, True), (2, 1, 3, None, 5, False)]  # b c: one of them wanted
    places = spark.createDataFrame(places, "uid long, start long, stop long, path long, key long, wanted boolean")
    got = debruijn_dedup.verified(docs, places, Work(spark, "verified", docs)).distinct().collect()
    assert {tuple(r) for r in got} == {(1, 0, 3, 7), (2, 0, 3, 7), (3, 1, 4, 9), (1, 1, 3, None)}


def test_a_path_starts_where_another_place_starts(spark):
    """B stands after A at two places and alone at a third: B is a path of its own,
    else its third place would have no other."""
    rng = random.Random(9)
    word = lambda: f"u{rng.randint(0, 10**6)}"
    a, b = [word() for _ in range(150)], [word() for _ in range(150)]
    noise = lambda: [word() for _ in range(rng.randint(40, 90))]
    rows = [(1, noise() + a + b), (2, a + b + noise()), (3, noise() + b + noise()), (4, b), (5, b[:80])]
    docs = spark.createDataFrame([(d, " ".join(w)) for d, w in rows], "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in debruijn_dedup.dedup(docs, 35).collect()}
    assert got == {1: 300, 2: 300, 3: 150, 4: 150, 5: 80}
