"""Token ids in bit-packed files, and back.

A file holds the documents of one range of doc_id, in ascending order:

    b"PLMBTOK1"
    blocks    BLOCK ids each (the last may be shorter), every id in the least
              number of bits that the vocabulary needs, low bit first; a block
              starts on a byte
    index     for each document: doc_id (int64), whether it is null (uint8), and
              the number of ids before it in the file (int64; one more at the end)
    offsets   of the blocks in the file (int64; one more at the end)
    footer    n_docs, n_ids, n_blocks, index offset, bits, block size (int64 each)
    b"PLMBTOK1"

All numbers are little-endian.  Any run of ids is read by its blocks alone.

Texts go through the tokenizers library.  A byte-level vocabulary cuts a text
before each single space between two other characters, so what lies between
such spaces is encoded by the library once and remembered, up to a bound.

Edge cases: a null or empty text is just the end id; null doc_ids come first;
rows that repeat a doc_id stand side by side, in the order of their texts; an
empty table gives no files; further columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import seqhash as sh
from plumbline.llm.common import Work, batch, partitions, table

MAGIC = b"PLMBTOK1"
BLOCK = 4096
END_ID = 2
#: Chunks whose ids a worker remembers, and bytes of them with their ids.
REMEMBERED, REMEMBERED_BYTES = 800_000, 64 << 20
_TWO_SPACES = re.compile(r"\s\s")


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


class Encoder:
    """A tokenizer of the library, with a bounded memory of chunks."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        os.environ["RAYON_NUM_THREADS"] = "1"
        from tokenizers import Tokenizer, models, pre_tokenizers

        self.lib = Tokenizer.from_file(path)
        self.size = self.lib.get_vocab_size(with_added_tokens=True)
        pre = self.lib.pre_tokenizer
        self.chunked = isinstance(pre, pre_tokenizers.ByteLevel) and not pre.add_prefix_space and pre.use_regex and isinstance(self.lib.model, models.BPE) and self.lib.normalizer is None and self.lib.model.dropout is None
        special = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.known: dict[str, bytes] = {}
        self.known_bytes = 0
        vocab = self.lib.get_vocab(with_added_tokens=False)
        self.bytes_of = np.zeros(self.size, dtype=np.int64)
        for token, i in vocab.items():
            self.bytes_of[i] = len(token)

    def plain(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, chunks: list[str]) -> dict[str, bytes]:
        """The ids of chunks, each with a space before it."""
        even = [c for c in chunks if c and c == c.strip()]
        odd = [c for c in chunks if not c or c != c.strip()]
        found = dict(zip(odd, self.plain([" " + c for c in odd])))
        groups = [even[i : i + 256] for i in range(0, len(even), 256)]
        for group, ids in zip(groups, self.plain([" " + " ".join(g) for g in groups])):
            flat = np.frombuffer(ids, dtype="<u4")
            ends = np.cumsum(self.bytes_of[flat])
            want = np.cumsum([len(c.encode()) + 1 for c in group])
            cut = np.searchsorted(ends, want) + 1
            if len(ends) and np.array_equal(ends[np.minimum(cut, len(ends)) - 1], want):
                edges = [0, *(4 * cut).tolist()]
                found.update((c, ids[a:b]) for c, a, b in zip(group, edges, edges[1:]))
            else:
                found.update(zip(group, self.plain([" " + c for c in group])))
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if not self.chunked:
            return self.plain(texts)
        whole = [i for i, t in enumerate(texts) if _TWO_SPACES.search(t) or (self.special and self.special.search(t))]
        out: list[bytes] = [b""] * len(texts)
        for i, ids in zip(whole, self.plain([texts[i] for i in whole])):
            out[i] = ids
        whole_set = set(whole)
        rest = [i for i in range(len(texts)) if i not in whole_set]
        parts = [texts[i].split(" ") for i in rest]
        heads = self.plain([p[0] for p in parts])
        known = self.known
        missing = list(set().union(*parts).difference(known))
        known.update(self._learn(missing) if missing else ())
        get = known.__getitem__
        for i, p, head in zip(rest, parts, heads):
            out[i] = head + b"".join(map(get, p[1:]))
        # What is too much is forgotten again: what came first is the frequent.
        self.known_bytes += sum(4 * len(c) + len(known[c]) for c in missing)
        while missing and (len(known) > REMEMBERED or self.known_bytes > REMEMBERED_BYTES):
            c = missing.pop()
            self.known_bytes -= 4 * len(c) + len(known.pop(c))
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def bits_for(vocabulary: int) -> int:
    return max(1, (max(vocabulary, 1) - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    return np.packbits(((ids.astype(np.uint64)[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, n: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, dtype=f"<u{bits // 8}", count=n).astype(np.uint32)
    flat = np.unpackbits(np.frombuffer(data, dtype=np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    return (flat.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(axis=1, dtype=np.uint32)


class Writer:
    def __init__(self, sink, bits: int, block: int = BLOCK) -> None:
        self.sink, self.bits, self.block = sink, bits, block
        self.at = len(MAGIC)
        sink.write(MAGIC)
        self.held: list[np.ndarray] = []
        self.n_held = self.n_ids = 0
        self.docs: list[int] = []
        self.nulls: list[int] = []
        self.starts: list[int] = []
        self.offsets: list[int] = []

    def _blocks(self, last: bool) -> None:
        flat = np.concatenate(self.held) if self.held else np.zeros(0, dtype=np.uint32)
        stop = len(flat) if last else len(flat) // self.block * self.block
        for i in range(0, stop, self.block):
            self.offsets.append(self.at)
            data = pack(flat[i : min(i + self.block, stop)], self.bits)
            self.sink.write(data)
            self.at += len(data)
        self.held, self.n_held = [flat[stop:]], len(flat) - stop

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.starts.append(self.n_ids)
        self.held.append(ids)
        self.n_ids += len(ids)
        self.n_held += len(ids)
        if self.n_held >= 64 * self.block:
            self._blocks(False)

    def close(self) -> None:
        self._blocks(True)
        index = self.at
        self.sink.write(np.array(self.docs, dtype="<i8").tobytes() + np.array(self.nulls, dtype="u1").tobytes() + np.array([*self.starts, self.n_ids], dtype="<i8").tobytes())
        self.sink.write(np.array([*self.offsets, index], dtype="<i8").tobytes())
        self.sink.write(np.array([len(self.docs), self.n_ids, len(self.offsets), index, self.bits, self.block], dtype="<i8").tobytes() + MAGIC)
        self.sink.close()


class Reader:
    """Random access to a file's documents and ids."""

    def __init__(self, source) -> None:
        self.source = source
        size = source.size()
        tail = 6 * 8 + len(MAGIC)
        end = source.read_at(tail, size - tail)
        if end[-len(MAGIC) :] != MAGIC:
            raise ValueError("not a token file")
        self.n_docs, self.n_ids, n_blocks, index, self.bits, self.block = np.frombuffer(end[: 6 * 8], dtype="<i8").tolist()
        raw = source.read_at(size - tail - index, index)
        n = self.n_docs
        self.docs = np.frombuffer(raw, dtype="<i8", count=n)
        self.nulls = np.frombuffer(raw, dtype="u1", count=n, offset=8 * n).astype(bool)
        self.starts = np.frombuffer(raw, dtype="<i8", count=n + 1, offset=9 * n)
        self.offsets = np.frombuffer(raw, dtype="<i8", count=n_blocks + 1, offset=9 * n + 8 * (n + 1))

    def ids(self, start: int, stop: int) -> np.ndarray:
        if stop <= start:
            return np.zeros(0, dtype=np.uint32)
        first, last = start // self.block, (stop - 1) // self.block
        data = self.source.read_at(int(self.offsets[last + 1] - self.offsets[first]), int(self.offsets[first]))
        n = min(self.n_ids, (last + 1) * self.block) - first * self.block
        if self.block * self.bits % 8 == 0:
            flat = unpack(data, n, self.bits)
        else:
            edge = self.offsets[first : last + 2] - self.offsets[first]
            flat = np.concatenate([unpack(data[edge[i] : edge[i + 1]], min(self.block, n - i * self.block), self.bits) for i in range(last - first + 1)])
        return flat[start - first * self.block : stop - first * self.block]

    def documents(self, at_once: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray]]:
        """(first document, document after the last, their ids), in pieces."""
        doc = 0
        while doc < self.n_docs:
            stop = max(doc + 1, int(np.searchsorted(self.starts, self.starts[doc] + at_once, side="right")) - 1)
            stop = min(stop, self.n_docs)
            yield doc, stop, self.ids(int(self.starts[doc]), int(self.starts[stop]))
            doc = stop


def _place(uri: str):
    return pafs.FileSystem.from_uri(uri)


def write(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = END_ID) -> list[tuple[int, str, int, int]]:
    """Writes docs (doc_id, text) to files in the folder, which all executors
    share; returns (part, path, documents, ids) of each file in order."""
    path = tokenizer or default_tokenizer()
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = ordered.repartitionByRange(partitions(docs.sparkSession), "doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches):
        enc, writer = encoder(path), None
        bits = bits_for(max(enc.size, end_id + 1))
        part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        fs, base = _place(folder)
        end = np.array([end_id], dtype="<u4")
        for b in batches:
            data, offsets = sh.text_buffer(b.column("text"))
            ids_ = b.column("doc_id").to_pylist()
            for lo, hi in sh.row_slices(offsets, 1 << 20):
                flat = data[offsets[lo] : offsets[hi]].tobytes()
                o = (offsets[lo : hi + 1] - offsets[lo]).tolist()
                if writer is None:
                    fs.create_dir(base, recursive=True)
                    writer = Writer(fs.open_output_stream(f"{base}/.part-{part:05d}-{attempt}"), bits)
                for doc_id, ids in zip(ids_[lo:hi], enc.encode([flat[x:y].decode() for x, y in zip(o, o[1:])])):
                    writer.add(doc_id, np.concatenate([np.frombuffer(ids, dtype="<u4"), end]))
        if writer is not None:
            writer.close()
            # A task that runs again replaces the file as a whole.
            fs.move(f"{base}/.part-{part:05d}-{attempt}", f"{base}/part-{part:05d}.tok")
            yield batch(part=[part], docs=[len(writer.docs)], ids=[writer.n_ids])

    # A row for each file: no more than there are partitions.
    files = ordered.mapInArrow(run, "part long, docs long, ids long").collect()
    return [(r.part, f"{folder}/part-{r.part:05d}.tok", r.docs, r.ids) for r in sorted(files)]


def read(spark: SparkSession, files: list[tuple[int, str, int, int]], with_ids: bool = True) -> DataFrame:
    """doc_id, start (ids before it), n_tokens, ids_crc32 (and ids) of every
    document in the files, in their order."""
    rows, before = [], 0
    for part, path, _, ids in files:
        rows.append((path, before))
        before += ids
    listed = spark.createDataFrame(rows, "path string, before long")
    if rows:
        listed = listed.repartition(len(rows))

    def run(batches):
        for b in batches:
            for path, base in zip(b.column("path").to_pylist(), b.column("before").to_pylist()):
                fs, at = _place(path)
                with fs.open_input_file(at) as source:
                    reader = Reader(source)
                    for lo, hi, flat in reader.documents():
                        edge = reader.starts[lo : hi + 1] - reader.starts[lo]
                        raw = flat.astype("<u4").tobytes()
                        columns = {
                            "doc_id": pa.array(reader.docs[lo:hi], mask=reader.nulls[lo:hi]),
                            "start": reader.starts[lo:hi] + base,
                            "n_tokens": np.diff(edge),
                            "ids_crc32": np.array([zlib.crc32(raw[4 * x : 4 * y]) for x, y in zip(edge.tolist(), edge[1:].tolist())], dtype=np.int64),
                        }
                        if with_ids:
                            columns["ids"] = pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), pa.array(flat.astype(np.int32)))
                        yield batch(**columns)

    return listed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids)


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    work = Work(spark, "tokens", docs)
    return work.few(read(spark, write(docs, work.path("files")), with_ids=False))
