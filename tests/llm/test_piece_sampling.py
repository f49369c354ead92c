import itertools
import math
from collections import Counter

import numpy as np
import pytest

from plumbline.llm import piece_sampling as ps

TEXTS = [
    "The quick brown fox.\nJumps  over   it",
    "",
    None,
    " leading and trailing ",
    "Zażółć gęślą jaźń 東京 \U0001f600 ▁ mark ▁▁",
    "x" * 5000,
    "word " * 3000,
    "\t\x00\x7f\u200b",
    "abcdefghijklmnopqrstuvwxyz0123456789" * 9,
]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "a") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string")


def test_round_trip_and_reproducible(spark):
    docs = frame(spark, TEXTS)
    one = ps.encode(docs.coalesce(1)).cache()
    many = {r.doc_id: r.token_ids for r in ps.encode(docs.repartition(5)).collect()}
    for r in one.collect():
        assert r.lossless and r.token_ids == many[r.doc_id] and r.n_tokens == len(r.token_ids or [])
    assert {r.doc_id: r.decoded for r in ps.decode(one).collect()} == dict(enumerate(TEXTS))
    other = {r.doc_id: r.token_ids for r in ps.encode(docs, seed=7).collect()}
    assert other[0] != many[0] and other[1] == [] and other[2] is None
    assert ps.encode(docs.limit(0)).count() == 0


def paths(p, text):
    """All segmentations of a short text, with their shares."""
    chars = [ps.MARK if c == " " else ord(c) for c in text]
    names = {}
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=ps.default_model())
    for i in range(model.get_piece_size()):
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)):
            names[tuple(ord(c) for c in model.id_to_piece(i))] = i
    out = {}
    for cuts in itertools.product([0, 1], repeat=len(chars) - 1):
        edges = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(chars)]
        parts = [names.get(tuple(chars[a:b])) for a, b in zip(edges, edges[1:])]
        if None not in parts:
            out[tuple(parts)] = math.exp(sum(p.log_weight[i] for i in parts))
    total = sum(out.values())
    return {k: v / total for k, v in out.items()}


@pytest.mark.parametrize("limit", [ps.LONG_UNIT, 2])
def test_samples_follow_the_lattice(limit, monkeypatch):
    monkeypatch.setattr(ps, "LONG_UNIT", limit)
    p = ps.pieces(ps.default_model(), 0.5)
    text, n = " there", 6000
    want = paths(p, text)
    data = np.frombuffer((text * 1).encode() * n, dtype=np.uint8)
    offsets = np.arange(n + 1) * len(text)
    if limit == 2:
        monkeypatch.setattr(ps._Lattice, "__init__", None)
        lens = (4, 8, 12, 16, 24, 2)
        del lens
        found = Counter()
        chars = np.array([ps.MARK if c == " " else ord(c) for c in text], dtype=np.uint32)
        rolling = ps.sh.Rolling(ps.char_values(chars))
        for seed in ps.sh.mix(np.arange(n, dtype=np.uint64)):
            found[tuple(ps._long_unit(p, chars, rolling, 0, len(chars), seed).tolist())] += 1
    else:
        tokens, at = ps.encode_rows(p, data, offsets, np.arange(n), 1)
        found = Counter(tuple(tokens[a:b].tolist()) for a, b in zip(at, at[1:]))
    assert set(found) <= set(want)
    for path, share in want.items():
        assert abs(found[path] / n - share) < 5 * math.sqrt(share * (1 - share) / n) + 1e-3


def test_long_units_in_pieces(monkeypatch):
    """One unit of many places: the same tokens however many places are held at once."""
    import numpy as np

    p = ps.pieces(ps.default_model(), 0.5)
    data = np.random.default_rng(7).integers(97, 101, 5000).astype(np.uint8)
    found = []
    for places in (64, 1 << 14):
        monkeypatch.setattr(ps, "PLACES", places)
        tokens, at = ps.encode_rows(p, data, np.array([0, len(data)]), np.array([3]), 1)
        back, _ = ps.decode_rows(p, tokens, at)
        assert (back == data).all() and len(tokens) < 5000
        found.append(tokens.tolist())
    assert found[0] == found[1]
