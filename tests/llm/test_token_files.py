import zlib

import numpy as np
import pyarrow.fs as pafs
import pytest
from tokenizers import Tokenizer

from plumbline.llm import token_files as tf
from plumbline.llm.common import Work

TEXTS = ["hello world, it's fine", None, "", " x", "x ", "a  b", "a \n b", "tab\there don't", "<|endoftext|> is <|endoftext|>", "Zażółć 東京 \U0001f600", "line one.\nLine two ", "\u00a0odd \u2003 spaces\x1c x", "word " * 5000, "y" * 3000]


def test_equals_the_library(spark):
    rows = [(i * 7 % 100, t) for i, t in enumerate(TEXTS * 3)] + [(None, "null id"), (5, "twice"), (5, "twice")]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, start int").repartition(5)
    files = tf.write(docs, Work(spark, "test").path("files"))
    got = tf.read(spark, files).collect()
    lib = Tokenizer.from_file(tf.default_tokenizer())
    want = sorted((-1 if d is None else d, t or "") for d, t in rows)
    got.sort(key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None if d < 0 else d for d, _ in want]
    at = 0
    by_id = {}
    for d, t in want:
        ids = lib.encode(t, add_special_tokens=False).ids + [2]
        by_id.setdefault(d, []).append(ids)
    for d in by_id:
        mine = [r for r in got if (-1 if r.doc_id is None else r.doc_id) == d]
        assert sorted(r.ids for r in mine) == sorted(by_id[d])
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())
        at += r.n_tokens
    assert tf.read(spark, tf.write(docs.limit(0), Work(spark, "test").path("none"))).count() == 0


@pytest.mark.parametrize("bits,block", [(1, 8), (3, 5), (13, 4096), (16, 100), (17, 7), (32, 3)])
def test_random_access(tmp_path, bits, block):
    rng = np.random.default_rng(bits)
    docs = [rng.integers(0, 1 << bits, rng.integers(0, 400), dtype=np.uint64).astype(np.uint32) for _ in range(50)]
    fs = pafs.LocalFileSystem()
    path = str(tmp_path / "f")
    writer = tf.Writer(fs.open_output_stream(path), bits, block)
    for i, ids in enumerate(docs):
        writer.add(i if i % 9 else None, ids)
    writer.close()
    flat = np.concatenate(docs)
    reader = tf.Reader(fs.open_input_file(path))
    assert reader.n_ids == len(flat) and np.array_equal(reader.nulls, np.arange(50) % 9 == 0)
    for _ in range(200):
        a, b = sorted(rng.integers(0, len(flat) + 1, 2).tolist())
        assert np.array_equal(reader.ids(a, b), flat[a:b])
    parts = [ids for _, _, ids in reader.documents(300)]
    assert np.array_equal(np.concatenate(parts), flat)


def test_memory_of_chunks_is_bounded_in_bytes(monkeypatch):
    monkeypatch.setattr(tf, "REMEMBERED_BYTES", 2000)
    enc = tf.Encoder(tf.default_tokenizer())
    lib = Tokenizer.from_file(tf.default_tokenizer())
    for k in range(5):
        texts = [" ".join(f"{k}{i}" + "q" * 200 for i in range(20)), "a b c"]
        assert enc.encode(texts) == [np.array(lib.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]
        assert enc.known_bytes == sum(4 * len(c) + len(i) for c, i in enc.known.items()) <= 2000
