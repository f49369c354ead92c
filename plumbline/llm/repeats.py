"""Exact search for windows of a sequence that also start somewhere else.

Shared by the byte-wise and the word-wise removal of repeated passages.  A
sequence is a row's bytes or words; a window is `window` consecutive symbols.

Sampled positions.  Each window has an anchor: the start of its smallest gram.
Equal windows have equal anchors at the same distance, so it is enough to rank
anchors (two in about `window` positions).  Windows with one anchor stand side
by side in a run; runs, not positions, are what is written and shuffled.

Ranks grow in rounds, and each keeps only what is still shared:

round 0      rank = the anchor's gram; a gram that stands alone ends there.
whole runs   rank pair (gram, whole run): equal runs are past the threshold,
             all their windows repeat, and nothing more is asked of them.
finer steps  for what is left, blocks of 64, 8, 1 (8, 1) window starts: the part
             that all windows of a block share is ranked with its gram; alone
             means unique, the whole block equal means repeated, else the block
             is cut into smaller ones, until a block is one window.

All decisions are on pairs of hashes, of the gram and of the extension (see
seqhash.Field): two different strings pass as equal with a chance below 2**-100.  Each round
is a grouping with map-side partial aggregation, so a passage that stands in a
third of all rows is counted before it is shuffled; joins back are plain equi
joins, which adaptive execution splits where a key is hot.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm import seqhash as sh
from plumbline.llm.common import SLICE_BYTES, Work, batch, binary_rows, signed

#: Window starts that one call handles; longer rows go in overlapping pieces.
PIECE = 1 << 19
_LO_BITS, _MASK = 20, (1 << 10) - 1


def sequences(b: pa.RecordBatch, kind: str):
    """(first row, last row, symbols, offsets) of bounded slices of a batch."""
    data, offsets = sh.text_buffer(b.column("text"))
    for lo, hi in sh.row_slices(offsets, SLICE_BYTES):
        d, o = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        if kind == "words":
            starts, ends, rows = sh.word_bounds(d, o)
            yield lo, hi, sh.word_hashes(d, starts, ends), rows
        else:
            yield lo, hi, d, o


def values(symbols: np.ndarray) -> np.ndarray:
    return sh.BYTE_VALUE[symbols] if symbols.dtype == np.uint8 else symbols


def _scan(docs: DataFrame, kind: str, window: int, gram: int) -> DataFrame:
    def one(uid: np.ndarray, symbols: np.ndarray, offsets: np.ndarray, shift: int):
        r = sh.window_runs(values(symbols), offsets, window, gram)
        at = ((r["lo"] + shift) << _LO_BITS) | ((r["hi"] - r["lo"]) << 10) | (r["anchor"] - r["lo"])
        return batch(uid=uid[r["row"]], at=at, gram=signed(r["gram"]), full=signed(r["full"]))

    def scan(batches):
        for b in batches:
            uid = b.column("uid").to_numpy(zero_copy_only=False)
            for lo, hi, symbols, offsets in sequences(b, kind):
                if len(symbols) <= PIECE + window:
                    yield one(uid[lo:hi], symbols, offsets, 0)
                    continue
                for row in range(hi - lo):
                    mine = symbols[offsets[row] : offsets[row + 1]]
                    for p in range(0, max(1, len(mine) - window + 1), PIECE):
                        part = mine[p : p + PIECE + window - 1]
                        yield one(uid[lo + row : lo + row + 1], part, np.array([0, len(part)]), p)

    return docs.mapInArrow(scan, "uid long, at long, gram long, full long")


_LO = f"shiftright(at, {_LO_BITS})"
_SPAN = f"cast(shiftright(at, 10) & {_MASK} as int)"


def run_lo():
    return F.expr(_LO)


def run_hi():
    return F.expr(f"{_LO} + {_SPAN}")


def _contexts(docs: DataFrame, wanted: DataFrame, kind: str, window: int) -> DataFrame:
    """The symbols under each wanted run."""
    per_row = wanted.groupBy("uid").agg(F.collect_set(F.struct("at", "gram", "single")).alias("runs"))

    def scan(batches):
        seen: set[int] = set()
        for b in batches:
            uids, runs = b.column("uid").to_pylist(), b.column("runs")
            for lo, hi, symbols, offsets in sequences(b, kind):
                for row in range(lo, hi):
                    if uids[row] in seen:  # equal rows
                        continue
                    seen.add(uids[row])
                    mine = runs[row].values
                    at = mine.field("at").to_numpy()
                    start = at >> _LO_BITS
                    size = ((at >> 10) & _MASK) + window
                    ends = np.cumsum(size)
                    take = np.repeat(start - (ends - size), size) + np.arange(ends[-1])
                    text = symbols[offsets[row - lo] : offsets[row - lo + 1]][take]
                    yield batch(uid=np.full(len(at), uids[row]), at=at, gram=mine.field("gram"), single=mine.field("single"), context=binary_rows(text, np.concatenate([[0], ends])))

    def small(batches):  # many small batches cost more than their rows
        held: list[pa.RecordBatch] = []
        rows = 0
        for b in scan(batches):
            held.append(b)
            rows += b.num_rows
            if rows >= 2000:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, rows = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return docs.select("uid", "text").join(per_row, "uid").mapInArrow(small, "uid long, at long, gram long, single boolean, context binary")


def _nodes(rows: DataFrame, kind: str, window: int, block: int, parent: int | None) -> DataFrame:
    """Blocks of window starts, by distance to the anchor: rank of what all
    windows of the block share, and rank of all that they cover."""
    dtype = np.uint8 if kind == "bytes" else np.uint64

    def scan(batches):
        for b in batches:
            lengths = pa.compute.binary_length(b.column("context")).to_numpy(zero_copy_only=False).astype(np.int64) // np.dtype(dtype).itemsize
            for lo, hi in sh.row_slices(np.concatenate([[0], np.cumsum(lengths)]), SLICE_BYTES):
                part = b.slice(lo, hi - lo)
                flat = np.frombuffer(b"".join(part.column("context").to_pylist()), dtype=dtype)
                base = np.cumsum(lengths[lo:hi]) - lengths[lo:hi]
                at = part.column("at").to_numpy()
                far = at & _MASK
                near = far - ((at >> 10) & _MASK)
                if parent is None:
                    n = far // block - near // block + 1
                    row = np.repeat(np.arange(len(at)), n)
                    blk = (near // block)[row] + (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n))
                else:
                    lists = part.column("blocks")
                    held = np.diff(lists.offsets.to_numpy())
                    ratio = parent // block
                    flat_blocks = lists.values.slice(lists.offsets[0].as_py(), int(held.sum())).to_numpy().astype(np.int64)
                    row = np.repeat(np.repeat(np.arange(len(at)), held), ratio)
                    blk = np.repeat(flat_blocks * ratio, ratio) + np.tile(np.arange(ratio), len(flat_blocks))
                    ok = (blk >= near[row] // block) & (blk <= far[row] // block)
                    row, blk = row[ok], blk[ok]
                if not len(row):
                    continue
                rolling = sh.Field(values(flat))
                origin = base[row] + far[row]
                first, last = np.maximum(blk * block, near[row]), np.minimum(blk * block + block - 1, far[row])
                core = rolling.hash(origin - blk * block, origin - (blk * block + block - 1) + window)
                full = sh.mix(rolling.hash(origin - last, origin - first + window) ^ sh.mix((first * 4096 + last).astype(np.uint64)))
                anchor = (at >> _LO_BITS) + far
                yield batch(
                    uid=part.column("uid").to_numpy()[row],
                    at=at[row],
                    single=part.column("single").to_numpy(zero_copy_only=False)[row],
                    gram=part.column("gram").to_numpy()[row],
                    blk=blk.astype(np.int32),
                    core=signed(core),
                    full=signed(full),
                    start=anchor[row] - last,
                    stop=anchor[row] - first + window,
                )

    return rows.mapInArrow(scan, "uid long, at long, single boolean, gram long, blk int, core long, full long, start long, stop long")


def repeated(docs: DataFrame, work: Work, kind: str, window: int, gram: int, blocks: tuple[int, ...], partners: bool = False) -> tuple[DataFrame, DataFrame]:
    """docs: uid, text.  Returns the runs that stand elsewhere as a whole (uid,
    at, gram, full) and further covered spans (uid, start, stop).

    partners: spans come with the key of what they read (key), and so do places
    that read the same and are already in a run that stands elsewhere (single: false)."""
    runs = work.keep(_scan(docs, kind, window, gram), "runs")
    # first() of two columns is of one and the same row: a run of that content.
    contents = work.keep(runs.groupBy("gram", "full").agg(F.count("*").alias("n"), F.first("uid").alias("uid"), F.first("at").alias("at")), "contents")
    work.release()
    whole = runs.join(contents.where("n > 1").select("gram", "full"), ["gram", "full"], "left_semi").select("uid", "at", "gram", "full")
    whole = work.keep(whole, "whole")
    work.drop("runs")
    shared = contents.groupBy("gram").agg(F.count("*").alias("contents")).where("contents > 1").select("gram")
    wanted = contents.join(shared, "gram", "left_semi").select("uid", "at", "gram", (F.col("n") == 1).alias("single"))
    work.release()
    contexts = work.keep(_contexts(docs, wanted, kind, window), "contexts", "zstd" if kind == "bytes" else "uncompressed")
    work.drop("contents")
    spans, rows, parent = [], contexts, None
    blocks = tuple(x for x in blocks if x == 1 or 2 * x <= window)
    me = F.xxhash64("uid", "at")
    for block in blocks:
        nodes = work.keep(_nodes(rows, kind, window, block, parent), f"nodes{block}").withColumn("me", me)
        same = nodes.groupBy("gram", "full").agg(F.min("me").alias("a"), F.max("me").alias("b")).where("a <> b").select("gram", "full")
        mine = (nodes if partners else nodes.where("single")).join(same, ["gram", "full"], "left_semi")
        more = (F.xxhash64("gram", "full").alias("key"), "single") if partners else ()
        spans.append(work.keep(mine.select("uid", "start", "stop", *more), f"spans{block}"))
        if parent is not None:
            work.drop(f"nodes{parent}")
        if block > 1:
            alive = nodes.groupBy("gram", "blk", "core").agg(F.min("me").alias("a"), F.max("me").alias("b"), F.min("full").alias("c"), F.max("full").alias("d"))
            alive = alive.where("a <> b and c <> d").select("gram", "blk", "core")
            todo = nodes.join(alive, ["gram", "blk", "core"], "left_semi").groupBy("uid", "at").agg(F.collect_set("blk").alias("blocks"))
            rows, parent = contexts.join(todo, ["uid", "at"]), block
        work.release()
    work.drop("contexts", f"nodes{blocks[-1]}")
    found = spans[0]
    for more in spans[1:]:
        found = found.unionByName(more)
    return whole, found


def merged(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal covered spans; spans that touch are one."""
    order = np.argsort(starts, kind="stable")
    starts, stops = starts[order], np.maximum.accumulate(stops[order])
    new = np.concatenate([[True], starts[1:] > stops[:-1]])
    return starts[new], stops[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(stops) - 1]])]


def with_spans(docs: DataFrame, spans: DataFrame, *more: str) -> DataFrame:
    """docs with their spans (array of start, stop; null: none).  Spans of one
    row are no more than its symbols, also where many rows are equal (and so share
    their uid)."""
    return docs.join(spans.groupBy("uid").agg(F.collect_set(F.struct("start", "stop", *more)).alias("spans")), "uid", "left")


def row_spans(spans: pa.Array, row: int) -> tuple[np.ndarray, np.ndarray]:
    if not spans[row].is_valid:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    mine = spans[row].values
    return merged(mine.field("start").to_numpy(), mine.field("stop").to_numpy())
