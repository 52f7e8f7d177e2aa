"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingles.

Containment of a short item in a long document says nothing about their Jaccard similarity, so whole
signatures cannot be compared. Items are partitioned by size instead (powers of two of their number of
distinct shingles). A partition has one sketch length: with ``n`` shingles an item may miss at most
``n - ceil(0.8 n)`` of them, and the partition takes one more than its largest item may miss. The sketch
of an item is that many of its smallest shingle hashes. A document that contains the item holds at
least one of them for certain, so the sketches are searched among all shingles of the documents,
and what is found is verified by counting the item's shingles, compared as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wheelpace.llm.common import rows_of_text, shingle, shingle_text, words
from wheelpace.session import settle

SHINGLE_WORDS = 5
CONTAINMENT = 0.8
#: Bytes of sketches, shingles and candidates that are broadcast; beyond, Spark shuffles.
BROADCAST_BYTES = 20_000_000
#: What a row takes besides its texts.
_ROW_BYTES = 100

_DOC = ["doc_id", "text_hash"]


def _at(length: int, tokens: Column) -> Column:
    return F.sequence(F.lit(0), F.size(tokens) - length)


def _needed(n: Column, containment: float) -> Column:
    return F.ceil(n * F.lit(containment) - F.lit(1e-9))


def item_classes(benchmark: DataFrame) -> DataFrame:
    """(item_id, n_items, tokens, length): one row for all items of the same words, under the smallest id.

    ``length`` is the number of words per shingle: five, or all words of an item that has fewer.
    Null, empty and wordless items have no shingle and are left out.
    """
    tokens = words(F.coalesce(benchmark["text"].cast("string"), F.lit("")))
    items = benchmark.select(benchmark["item_id"], tokens.alias("tokens")).where(F.size("tokens") > 0)
    return items.groupBy("tokens").agg(F.min("item_id").alias("item_id"), F.count("*").alias("n_items")).withColumn(
        "length", F.least(F.size("tokens"), F.lit(SHINGLE_WORDS)))


def _lengths(classes: DataFrame) -> list[int]:
    """At most ``SHINGLE_WORDS`` numbers."""
    return sorted(r["length"] for r in classes.select("length").distinct().collect())


def item_shingles(classes: DataFrame, lengths: list[int]) -> DataFrame:
    """(item, h, s): the distinct shingles of every item class."""
    found = None
    for length in lengths:
        part = classes.where(F.col("length") == length)
        part = part.select("item", "tokens", F.explode(_at(length, F.col("tokens"))).alias("i")).select(
            "item", shingle(F.col("tokens"), F.col("i"), length).alias("h"),
            shingle_text(F.col("tokens"), F.col("i"), length).alias("s"))
        found = part if found is None else found.union(part)
    return found.distinct()


def doc_shingles(docs: DataFrame, lengths: list[int], text: bool) -> DataFrame:
    """(doc_id, text_hash, h[, s]) for every position of every document and every shingle length in use."""
    tokens = docs.select(*_DOC, words(docs["text"]).alias("tokens"))
    found = None
    for length in lengths:
        placed = tokens.where(F.size("tokens") >= length).select(
            *_DOC, "tokens", F.explode(_at(length, F.col("tokens"))).alias("i"))
        part = placed.select(*_DOC, shingle(F.col("tokens"), F.col("i"), length).alias("h"),
                             *([shingle_text(F.col("tokens"), F.col("i"), length).alias("s")] if text else []))
        found = part if found is None else found.union(part)
    return found


def _small(df: DataFrame) -> DataFrame:
    """``df``, to be broadcast if its rows and texts are measured to be small."""
    texts = [F.octet_length(c) for c, kind in df.dtypes if kind == "string"]
    size = sum((F.coalesce(t, F.lit(0)) for t in texts), F.lit(_ROW_BYTES))
    found = df.agg(F.coalesce(F.sum(size.cast("long")), F.lit(0)).alias("bytes")).first()
    return F.broadcast(df) if found["bytes"] <= BROADCAST_BYTES else df


def contained_items(docs: DataFrame, benchmark: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """(doc_id, item_id, n_items, item_shingles, shared_shingles, containment): items found in documents.

    One row per document and class of equal items with at least ``containment`` of the item's distinct
    shingles in the document. Words are lower-case runs of letters and digits. Rows that share a doc_id
    report their best containment; null ids count as one id. Null and empty texts contain nothing.
    An empty table on either side gives no rows. Items without id are searched like others.
    """
    spark = docs.sparkSession
    texts = rows_of_text(docs)
    classes = settle(item_classes(benchmark).withColumn("item", F.xxhash64("tokens")), "items")
    lengths = _lengths(classes)
    if not lengths:
        schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, item_id " \
                 f"{benchmark.schema['item_id'].dataType.simpleString()}, n_items long, item_shingles long, " \
                 "shared_shingles long, containment double"
        return spark.createDataFrame([], schema)

    shingles = settle(item_shingles(classes, lengths), "item-shingles")
    hashes = shingles.groupBy("item").agg(F.sort_array(F.collect_set("h")).alias("hashes"),
                                          F.count("*").alias("item_shingles"))
    largest = F.pow(F.lit(2), F.floor(F.log2("item_shingles")) + 1) - 1  # of the size partition
    kept = (largest - _needed(largest, containment) + 1).cast("int")
    sketches = settle(hashes.select("item", F.explode(F.slice("hashes", 1, F.least(kept, F.size("hashes")))).alias("h")),
                      "sketches")

    met = doc_shingles(texts, lengths, text=False).join(_small(sketches), "h")
    candidates = settle(met.select(*_DOC, "item").distinct(), "candidates")

    sizes = classes.join(shingles.groupBy("item").agg(F.count("*").alias("item_shingles")), "item").select(
        "item", "item_id", "n_items", "item_shingles")
    found = _small(settle(candidates.select(*_DOC).distinct(), "candidate-documents")).alias("c")
    again = texts.alias("t").join(
        found, F.col("t.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("t.text_hash") == F.col("c.text_hash")),
        "left_semi")
    shared = doc_shingles(again, lengths, text=True).join(_small(shingles), ["h", "s"])
    shared = shared.select(*_DOC, "item", "h", "s").distinct().groupBy(*_DOC, "item").agg(
        F.count("*").alias("shared_shingles"))
    shared, candidates = shared.alias("s"), candidates.alias("c")
    verified = shared.join(candidates, F.col("s.doc_id").eqNullSafe(F.col("c.doc_id")) & (
        F.col("s.text_hash") == F.col("c.text_hash")) & (F.col("s.item") == F.col("c.item")), "left_semi")
    verified = verified.join(_small(settle(sizes, "item-sizes")), "item").where(
        F.col("shared_shingles") >= _needed(F.col("item_shingles"), containment))
    return verified.groupBy("doc_id", "item_id", "n_items", "item_shingles").agg(
        F.max("shared_shingles").alias("shared_shingles")).withColumn(
        "containment", F.col("shared_shingles") / F.col("item_shingles"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """The rows of ``docs`` whose doc_id holds no benchmark item, with all their columns.

    A row without id goes if any row without id holds an item.
    """
    leaked = settle(contained_items(docs, benchmark, containment).select("doc_id").distinct(), "leaked")
    return docs.alias("d").join(leaked.alias("l"), F.col("d.doc_id").eqNullSafe(F.col("l.doc_id")), "left_anti")
