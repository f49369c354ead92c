"""Benchmark decontamination: short test items inside long documents.

Containment is the share of an item's distinct word shingles that a document
has; 0.8 or more contaminates.  The search is a MinHash containment search over
documents in partitions by size (powers of two of their shingles): an item of q
shingles is sketched by its k = floor(0.2 q) + 1 smallest shingle hashes, a
bottom-k MinHash sketch, and stands in the index of just those partitions whose
documents are large enough to hold 0.8 of it; the join's key is partition and hash.
A document that holds 0.8 of the item lacks no more than floor(0.2 q) of its
shingles, so it holds one of the sketch, however long it is: no hit is lost.  What
is found is verified on the words: both sides' shingles are compared as texts.

Everything is DataFrame expressions; the text is shingled inside the row.

Edge cases: null and blank texts contain nothing and are in nothing; items of
fewer than five words are searched by shingles of their own length, so they too
are found inside longer texts; equal documents are judged each; items that share an
id are judged each (equal ones once); null ids are kept; an empty table gives no
rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import GAP, Work, row_key, table

WORDS, PERCENT = 5, 80
#: Sketch rows (16 bytes each) up to which the index is broadcast.
BROADCAST_ROWS = 1_000_000
#: The last partition by size holds all documents of 2**TOP shingles and more.
TOP = 16


def words(text: Column) -> Column:
    trimmed = F.btrim(F.lower(text), F.lit(" \t\n\x0b\f\r"))
    return F.when(trimmed.isNull() | (trimmed == ""), F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP))


def shingles(text: Column, k: int) -> Column:
    """Hashes of k consecutive words, in order.  The words are bound once, as a
    lambda's variable; as a plain expression they would be made anew for each."""
    each = lambda w: F.when(
        F.size(w) >= k, F.transform(F.sequence(F.lit(1), F.size(w) - (k - 1)), lambda i: F.xxhash64(F.slice(w, i, k)))
    ).otherwise(F.array().cast("array<bigint>"))
    return F.element_at(F.transform(F.array(words(text)), each), 1)


def shingle_texts(text: Column, k: int) -> Column:
    """The same as texts, words joined by one space."""
    each = lambda w: F.when(
        F.size(w) >= k, F.transform(F.sequence(F.lit(1), F.size(w) - (k - 1)), lambda i: F.array_join(F.slice(w, i, k), " "))
    ).otherwise(F.array().cast("array<string>"))
    return F.element_at(F.transform(F.array(words(text)), each), 1)


def partition(n: Column) -> Column:
    """The partition by size of documents with n shingles, n > 0."""
    return F.least(F.floor(F.log2(n.cast("double"))).cast("int"), F.lit(TOP))


def _sized(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def contaminated(docs: DataFrame, items: DataFrame, percent: int = PERCENT, most_words: int = WORDS) -> DataFrame:
    """doc_id, uid, item_id, n_item, n_found of each document (doc_id, text) that
    contains `percent` of an item's (item_id, text) shingles or more."""
    work = Work(docs.sparkSession, "contain", docs)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("uid", row_key("doc_id", "text"))
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("item_text"), F.xxhash64("item_id", "text").alias("item")).distinct().withColumn("words", F.least(F.size(words(F.col("item_text"))), F.lit(most_words)))
    widths = [r.words for r in items.where("words > 0").select("words").distinct().collect()]
    found = None
    for k in sorted(widths):
        mine = items.where(F.col("words") == k).select("item", "item_id", F.sort_array(F.array_distinct(shingles(F.col("item_text"), k))).alias("item_shingles"), F.array_distinct(shingle_texts(F.col("item_text"), k)).alias("item_texts"))
        mine = mine.withColumn("n_item", F.size("item_texts").cast("long"))
        mine = work.keep(mine.withColumn("need", F.expr(f"(n_item * {percent} + 99) div 100")), f"items{k}")
        sketch = mine.select("item", "need", F.explode(F.expr("slice(item_shingles, 1, cast(n_item - need + 1 as int))")).alias("shingle"))
        sketch = sketch.select("shingle", "item", "need", F.explode(F.sequence(partition(F.col("need")), F.lit(TOP))).alias("part"))
        probes = docs.select("uid", shingles(F.col("text"), k).alias("s")).where(F.size("s") > 0)
        probes = probes.select("uid", F.size("s").alias("n"), partition(F.size("s")).alias("part"), F.explode("s").alias("shingle"))
        hits = probes.join(_sized(sketch, sketch.count()), ["part", "shingle"]).where("n >= need").select("uid", "item").distinct()
        hits = work.keep(hits, f"hits{k}")
        n_items = mine.count()
        pairs = docs.join(hits, "uid").join(_sized(mine, n_items * 256), "item")
        pairs = pairs.withColumn("n_found", F.size(F.array_intersect("item_texts", shingle_texts(F.col("text"), k))).cast("long"))
        pairs = pairs.where("n_found >= need").select("doc_id", "uid", "item_id", "n_item", "n_found")
        found = pairs if found is None else found.unionByName(pairs)
    if found is None:
        found = docs.select("doc_id", "uid", *(F.lit(0).cast("long").alias(c) for c in ("item_id", "n_item", "n_found"))).limit(0)
    return work.few(found)


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "item_id", "n_item", "n_found")
