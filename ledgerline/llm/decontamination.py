"""Benchmark items inside documents: size-partitioned MinHash containment search.

An item is found in a document when at least ``threshold`` of the item's
distinct five-word shingles occur in the document, however long the document.

Sketches: items are partitioned by size (powers of two of their shingle
count). Every item of a partition keeps the k smallest hashes of its shingles,
where k is one more than the shingles that an item of the partition's largest
size may miss. An item contained to the threshold misses fewer than k of its
shingles, so at least one of any k is in the document: the search loses
nothing. Shingles that several items share are passed over where an item has
enough of its own, so that a common phrase does not pair every item with every
document that has it.

Search: the shingle hashes of each document stream against the sketches (a
broadcast join while the sketches are few, a shuffled one beyond) and only
hits leave the scan. Verification: the candidates' texts are read again, and
the item's shingles are counted in them as strings, exactly.

Native: DataFrame functions only. Scale: one pass over all texts with nothing
shuffled but hits; a document's pairs are bounded by the items it holds.

Defined results: letters compare without case and words are what white space
separates. A text of one to four words has one shingle, all of it, so it is
found only in a document of the same words. Null and blank items match
nothing, null and blank documents hold nothing. Rows that repeat (same id and
text) give one result pair; items that repeat (same id and text) count once,
the same text under two ids gives two pairs; null ids are kept apart like any
value. Empty tables give an empty result; extra columns are ignored in pairs
and carried by ``drop_contaminated``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.common import col, fresh, let, shingles, stage_table, words

SHINGLE_WORDS, THRESHOLD = 5, 0.8
#: Rows of a table (sketches: 16 bytes a row; candidates: about 40) up to which it is broadcast; larger ones are shuffled.
BROADCAST_ROWS = 100_000
SEED = 7


def _words(text: Column) -> Column:
    return words(F.lower(text))


def _hash(s: Column) -> Column:
    return F.xxhash64(s, F.lit(SEED))


def _items(bench: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """One row per distinct (id, text): ``item``, ``ikey`` and its distinct ``grams``."""
    b = bench.select(col(id_col).alias("item"), col(text_col).alias("t")).distinct()
    b = b.select("item", F.xxhash64("item", "t").alias("ikey"),
                 let(_words(F.col("t")), lambda w: F.array_distinct(shingles(w, k, lambda s: s))).alias("grams"))
    return b.where(F.size("grams") > 0)


def _sketches(items: DataFrame, threshold: float) -> DataFrame:
    """(ikey, h): the smallest hashes of every item, as many as its size partition asks for."""
    g = items.select("ikey", F.size("grams").alias("n"), F.explode("grams").alias("s")).select("ikey", "n", _hash(F.col("s")).alias("h"))
    shared = g.groupBy("h").agg(F.count(F.lit(1)).alias("items")).where("items > 1")
    g = g.join(shared, "h", "left").select("ikey", "n", "h", F.coalesce("items", F.lit(1)).alias("items"))
    largest = F.pow(F.lit(2.0), F.floor(F.log2(F.col("n").cast("double"))) + 1) - 1  # of the item's size partition
    keep = F.least(F.col("n"), F.floor(largest * F.lit(1 - threshold) + 1e-9) + 1)
    rank = F.row_number().over(Window.partitionBy("ikey").orderBy("items", "h"))
    return g.withColumn("r", rank).where(F.col("r") <= keep).select("ikey", "h")


def _bounded(counted: DataFrame):
    """``broadcast`` if the written table ``counted`` is small, else no hint."""
    return F.broadcast if counted.count() <= BROADCAST_ROWS else (lambda df: df)


def contained(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
              item_text: str = "text", k: int = SHINGLE_WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """(doc, dkey, item, n_item, n_shared): pairs whose containment reaches the threshold.

    ``dkey`` is a hash of the document's text that tells apart rows of one id.
    """
    items = stage_table(_items(bench, item_id, item_text, k), "items")
    sketch = stage_table(_sketches(items, threshold), "sketches")
    bounded = _bounded(sketch)  # the items have at most some five shingles a sketch row
    base = docs.select(col(id_col).alias("doc"), F.xxhash64(col(text_col), F.lit(SEED)).alias("dkey"), col(text_col).alias("t"))
    stream = base.select("doc", "dkey", F.explode(
        let(_words(F.col("t")), lambda w: shingles(w, k, _hash))).alias("h"))
    hits = stage_table(stream.join(bounded(sketch), "h").select("doc", "dkey", "ikey").distinct(), "hits")
    wanted = hits.groupBy("doc", "dkey").agg(F.collect_set("ikey").alias("ikeys"))
    texts = (base.join(_bounded(hits)(wanted.withColumnRenamed("doc", "d2").withColumnRenamed("dkey", "k2")),
                       F.col("doc").eqNullSafe(F.col("d2")) & (F.col("dkey") == F.col("k2")))
             .select("doc", "dkey", "t", F.explode("ikeys").alias("ikey")))
    found = texts.join(bounded(items), "ikey").select(
        "doc", "dkey", "item", F.size("grams").alias("n_item"),
        let(_words(F.col("t")), lambda w: F.size(F.array_intersect(F.col("grams"), shingles(w, k, lambda s: s)))).alias("n_shared"))
    return found.where(F.col("n_shared") >= F.ceil(F.col("n_item") * F.lit(threshold) - 1e-9)).distinct()


def drop_contaminated(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with the columns of ``docs``."""
    key, b = fresh(docs, "dkey", "bad")
    bad = contained(docs, bench, id_col, text_col, **options).select(F.struct(F.col("doc").alias("doc"), F.col("dkey").alias("dkey")).alias(b))
    bad = stage_table(bad.distinct(), "contaminated")
    d = docs.withColumn(key, F.xxhash64(col(text_col), F.lit(SEED)))
    return d.join(_bounded(bad)(bad), col(id_col).eqNullSafe(col(b)["doc"]) & (col(key) == col(b)["dkey"]), "left_anti").select(*[col(c) for c in docs.columns])
