"""Removal of every byte under a long byte string that also starts elsewhere.

Prefix doubling on sampled positions (see repeats.py): Spark groups positions by
rank pairs - the rank of what came before and of what follows it - at growing
lengths, drops what is unique and stops at the threshold.  Doubling over each
single byte position would write some 24 bytes a position and round; sampling
keeps the result exact, and writes about a quarter byte a position.

Edge cases: null and empty texts have no bytes; equal rows count as two places;
a row with a null doc_id counts like any other; strings are judged on the input;
matches never cross rows; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import repeats
from plumbline.llm.common import Work, batch, row_key, table
from plumbline.llm.seqhash import text_buffer

WINDOW, GRAM, BLOCKS = 400, 50, (64, 8, 1)


def dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_bytes, spans (start, stop: maximal removed runs) and kept
    (the remaining bytes) of every row of docs (doc_id, text)."""
    gram = max(1, min(GRAM, window // 8))
    work = Work(docs.sparkSession, "suffix", docs)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("uid", row_key("doc_id", "text"))
    whole, found = repeats.repeated(docs, work, "bytes", window, gram, BLOCKS)
    spans = whole.select("uid", repeats.run_lo().alias("start"), (repeats.run_hi() + window).alias("stop")).unionByName(found)

    def cut(batches):
        for b in batches:
            data, offsets = text_buffer(b.column("text"))
            removed, kept = [], []
            for row in range(b.num_rows):
                mine = data[offsets[row] : offsets[row + 1]]
                starts, stops = repeats.row_spans(b.column("spans"), row)
                removed.append([{"start": s, "stop": e} for s, e in zip(starts.tolist(), stops.tolist())])
                edges = np.concatenate([[0], np.stack([starts, stops], axis=1).ravel(), [len(mine)]]).astype(np.int64)
                kept.append(b"".join(mine[s:e].tobytes() for s, e in zip(edges[::2], edges[1::2])))
            yield batch(
                doc_id=b.column("doc_id"),
                n_bytes=np.diff(offsets),
                spans=pa.array(removed, type=pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                kept=pa.array(kept, type=pa.binary()),
            )

    rows = repeats.with_spans(docs, spans).select("doc_id", "text", "spans")
    return work.few(rows.mapInArrow(cut, "doc_id long, n_bytes long, spans array<struct<start: long, stop: long>>, kept binary"))


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id",
        "n_bytes",
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"]).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
