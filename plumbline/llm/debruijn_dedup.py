"""Removal of long word passages that repeat, by de Bruijn compaction.

Nodes are anchored token k-mers, edges the token strings between them (see
repeats.py: a run of windows is an edge; its content is its label).  Edges that
stand in two places or more make the graph of repeats.  Where an edge is always
followed by one other, and that one always preceded by it, the path doesn't branch;
such paths are compacted through joins on the edges, so that all places of a path
read the same from its first word to its last.  At the ends of a path, where an edge
is only in part repeated, blocks of windows and single 35-word edges are the paths.

Paths are candidates.  Each place of each path is read again at its source
coordinates, and what it reads there (a 128-bit digest of the words themselves, not
of their hashes) must stand at another place of the path: only then do its words go.

Edge cases: null and blank texts have no words; equal rows count as two places;
windows are judged on the input and never cross rows; further columns are
ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 (pa.compute)
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm import repeats
from plumbline.llm.common import SLICE_BYTES, Work, batch, binary_rows, row_key, table
from plumbline.llm.seqhash import row_slices, text_buffer, word_bounds

WINDOW, GRAM, BLOCKS = 35, 5, (8, 1)
#: Rows up to which a list of edges (16 bytes each) or of digests (24) is broadcast.
BROADCAST_EDGES = 500_000


def compact(whole: DataFrame, window: int, work: Work) -> DataFrame:
    """Nonbranching paths of repeated edges at their places: uid, start, stop, path.

    path: an id of what the path reads (its first and last edge, and how many), the
    same wherever it stands; windows are by row, and hold no more than its edges."""
    by_row = Window.partitionBy("uid").orderBy("lo")
    edges = whole.select("uid", repeats.run_lo().alias("lo"), repeats.run_hi().alias("hi"), F.xxhash64("gram", "full").alias("edge"))
    edges = edges.distinct()  # equal rows have equal edges
    follows = F.lead("lo").over(by_row) == F.col("hi") + 1
    after = F.lag("hi").over(by_row) + 1 == F.col("lo")
    edges = edges.withColumn("next", F.when(follows, F.lead("edge").over(by_row))).withColumn("prev", F.when(after, F.lag("edge").over(by_row)))
    edges = work.keep(edges, "edges")
    # An end of a row, or of the repeats in it, counts as one more neighbour.
    sides = edges.groupBy("edge").agg(*[f(c).alias(f"{n}_{c}") for c in ("next", "prev") for n, f in (("a", F.min), ("b", F.max), ("ends", lambda c: F.count_if(F.col(c).isNull())))])
    sides = work.keep(sides.where("(a_next = b_next and ends_next = 0) or (a_prev = b_prev and ends_prev = 0)"), "sides")
    out = sides.where("a_next = b_next and ends_next = 0").select("edge", F.col("a_next").alias("next"))
    into = sides.where("a_prev = b_prev and ends_prev = 0").select(F.col("edge").alias("next"), F.col("a_prev").alias("edge"))
    plain = work.keep(out.join(into, ["edge", "next"]).select("edge", F.lit(1).alias("joined")), "plain")
    # A line that stands in very many rows is one hot edge: below the bound its rows
    # stay where they are; beyond it, adaptive execution splits the join.
    small = plain.limit(BROADCAST_EDGES + 1).count() <= BROADCAST_EDGES
    joined = edges.join(F.broadcast(plain) if small else plain, "edge", "left")
    joined = joined.withColumn("begins", (F.coalesce(F.lag("joined").over(by_row), F.lit(0)) == 0).cast("int"))
    joined = joined.withColumn("path", F.sum("begins").over(by_row))
    # As a path has no branch, its first edge and its length tell all edges of it.
    paths = joined.groupBy("uid", "path").agg(F.min("lo").alias("start"), (F.max("hi") + window).alias("stop"), F.min(F.struct("lo", "edge")).alias("first"), F.max(F.struct("lo", "edge")).alias("last"), F.count("*").alias("edges"))
    return paths.select("uid", "start", "stop", F.xxhash64("first.edge", "last.edge", "edges", F.col("stop") - F.col("start")).alias("path"))


def _spaced(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words with one space after each, and where each begins (and the end)."""
    sizes = ends - starts
    at = np.concatenate([[0], np.cumsum(sizes + 1)])
    words = np.full(at[-1], 0x20, dtype=np.uint8)
    step = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    words[np.repeat(at[:-1], sizes) + step] = data[np.repeat(starts, sizes) + step]
    return words, at


def _listed(lists: pa.Array) -> tuple[np.ndarray, pa.StructArray]:
    """The rows (from 0) and values of a column of lists; null is empty."""
    sizes = pa.compute.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(lists)), sizes.astype(np.int64)), lists.flatten()


def _lists(sizes: np.ndarray, **fields) -> pa.Array:
    values = pa.StructArray.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, type=pa.int64()) for x in fields.values()], names=list(fields))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), type=pa.int32()), values)


def verified(docs: DataFrame, places: DataFrame, work: Work) -> DataFrame:
    """The places (uid, start, stop, path, key, wanted) that are wanted and whose words
    stand at another place of the same key: uid, start, stop, path.

    Each row of docs (uid, text) reads its own places, so rows that are equal count
    as so many places.  Only a key that hashes got wrong leaves lone digests."""
    per_row = places.groupBy("uid").agg(F.collect_set(F.struct("start", "stop", "path", "key", "wanted")).alias("places"))

    def read(batches):
        for b in batches:
            data, offsets = text_buffer(b.column("text"))
            for lo, hi in row_slices(offsets, SLICE_BYTES):
                d, o = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
                starts, ends, rows = word_bounds(d, o)
                words, at = _spaced(d, starts, ends)
                words = memoryview(words)
                row, mine = _listed(b.column("places").slice(lo, hi - lo))
                first, last = (mine.field(x).to_numpy() for x in ("start", "stop"))
                begin, stop = at[rows[row] + first].tolist(), at[rows[row] + last].tolist()
                digests = [hashlib.blake2b(words[x:y], digest_size=16).digest() for x, y in zip(begin, stop)]
                yield batch(uid=b.column("uid").slice(lo, hi - lo).take(pa.array(row)), start=mine.field("start"), stop=mine.field("stop"), path=mine.field("path"), key=mine.field("key"), wanted=mine.field("wanted"), digest=pa.array(digests, type=pa.binary()))

    schema = "uid long, start long, stop long, path long, key long, wanted boolean, digest binary"
    seen = work.keep(docs.select("uid", "text").join(per_row, "uid").mapInArrow(read, schema), "read")
    lone = work.keep(seen.groupBy("key", "digest").count().where("count = 1").select("key", "digest"), "lone")
    small = lone.limit(BROADCAST_EDGES + 1).count() <= BROADCAST_EDGES
    return seen.where("wanted").join(F.broadcast(lone) if small else lone, ["key", "digest"], "left_anti").select("uid", "start", "stop", "path")


def dedup(docs: DataFrame, window: int = WINDOW, extra: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_words, n_removed, spans (start, stop in words), paths (start, stop
    and path: compacted repeats and what they read), kept (words joined by one space)
    and text_kept (the text without the removed words and
    the gaps after them) and `extra` columns of every row of docs (doc_id, text)."""
    gram = max(1, min(GRAM, window // 4))
    work = Work(docs.sparkSession, "debruijn", docs)
    types = dict(docs.dtypes)
    held = [f"extra{i}" for i in range(len(extra))]
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *(F.col(f"`{c}`").alias(h) for c, h in zip(extra, held))).withColumn("uid", row_key("doc_id", "text"))
    whole, found = repeats.repeated(docs, work, "words", window, gram, BLOCKS, partners=True)
    paths = compact(whole, window, work).select("uid", "start", "stop", "path", F.col("path").alias("key"), F.lit(True).alias("wanted"))
    ends = found.select("uid", "start", "stop", F.lit(None).cast("long").alias("path"), "key", F.col("single").alias("wanted"))
    spans = work.keep(verified(docs, paths.unionByName(ends), work), "spans")
    work.drop("read")
    work.release()

    def cut(batches):
        for b in batches:
            data, offsets = text_buffer(b.column("text"))
            for lo, hi in row_slices(offsets, SLICE_BYTES):
                d, o = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
                starts, ends, rows = word_bounds(d, o)
                row, value = _listed(b.column("spans").slice(lo, hi - lo))
                first, last = (value.field(x).to_numpy() for x in ("start", "stop"))
                n = len(starts)
                cover = np.bincount(rows[row] + first, minlength=n + 1) - np.bincount(rows[row] + last, minlength=n + 1)
                keep = np.cumsum(cover)[:-1] == 0
                row_of = np.repeat(np.arange(hi - lo), np.diff(rows))
                heads = np.ones(n + 1, dtype=bool)  # words that begin a row
                heads[1:-1] = row_of[1:] != row_of[:-1]
                begins = np.flatnonzero(~keep & (heads[:-1] | np.concatenate([[True], keep[:-1]])))
                closes = np.flatnonzero(~keep & (heads[1:] | np.concatenate([keep[1:], [True]]))) + 1
                of = row_of[begins]
                removed = _lists(np.bincount(of, minlength=hi - lo), start=begins - rows[of], stop=closes - rows[of])
                named = value.field("path").is_valid().to_numpy(zero_copy_only=False)
                order = np.flatnonzero(named)[np.lexsort([first[named], row[named]])]
                paths = _lists(np.bincount(row[order], minlength=hi - lo), start=first[order], stop=last[order], path=value.field("path").take(pa.array(order)))
                # Kept words with one space after each, but for a row's last.
                words, at = _spaced(d, starts, ends)
                sizes = np.where(keep, np.diff(at), 0)
                chosen = np.repeat(keep, np.diff(at))
                tails = np.flatnonzero(keep)
                tails = tails[np.concatenate([row_of[tails][1:] != row_of[tails][:-1], [True]])] if len(tails) else tails
                chosen[at[tails + 1] - 1] = False
                sizes[tails] -= 1
                kept = binary_rows(words[chosen], np.concatenate([[0], np.cumsum(sizes)])[rows])
                # A word goes with the gap after it, a row's first also with the one before.
                word_begins = np.where(heads[:-1], o[:-1][row_of], starts)
                word_stops = np.where(heads[1:], o[1:][row_of], np.concatenate([starts[1:], [0]])[:n])
                gone = np.zeros(len(d) + 1, dtype=np.int64)
                gone[word_begins[~keep]] += 1
                gone[word_stops[~keep]] -= 1
                left = np.cumsum(gone)[:-1] == 0
                text_kept = binary_rows(d[left], np.concatenate([[0], np.cumsum(left)])[o]).cast(pa.string())
                yield batch(
                    doc_id=b.column("doc_id").slice(lo, hi - lo),
                    n_words=np.diff(rows).astype(np.int64),
                    n_removed=np.bincount(row_of[~keep], minlength=hi - lo).astype(np.int64),
                    spans=removed,
                    paths=paths,
                    kept=kept.cast(pa.string()),
                    text_kept=pa.compute.if_else(b.column("text").slice(lo, hi - lo).is_valid(), text_kept, None),
                    **{h: b.column(h).slice(lo, hi - lo) for h in held},
                )

    rows = repeats.with_spans(docs, spans, "path").select("doc_id", "text", "spans", *held)
    schema = "doc_id long, n_words long, n_removed long, spans array<struct<start: long, stop: long>>, paths array<struct<start: long, stop: long, path: long>>, kept string, text_kept string"
    out = rows.mapInArrow(cut, ", ".join([schema, *(f"{h} {types[c]}" for c, h in zip(extra, held))]))
    return work.few(out).withColumnsRenamed(dict(zip(held, extra)))


def passage_free(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """docs with the repeated passages cut from their texts, and n_chars (where
    there is such a column) counted anew for texts that changed."""
    extra = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    # Held under names of their own, as they may be called like a result's column.
    held = {c: f"held{i}_{c}" for i, c in enumerate(extra)}
    out = dedup(docs.withColumnsRenamed(held), window, tuple(held.values()))
    kept = {"text": F.col("text_kept"), "doc_id": F.col("doc_id")} | {c: F.col(f"`{h}`") for c, h in held.items()}
    if "n_chars" in extra:
        kept["n_chars"] = F.when(F.col("n_removed") > 0, F.length("text_kept").cast(dict(docs.dtypes)["n_chars"])).otherwise(kept["n_chars"])
    return out.select(*[kept[c].alias(c) for c in docs.columns])


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
