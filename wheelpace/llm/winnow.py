"""Document fingerprints by winnowing, in DataFrame functions only.

Tokens are runs of up to 12 characters other than white space, in lower case; of longer runs, as in scripts
without spaces, every character is a token, so that an inserted one moves no others. Every window of
``WINDOW`` consecutive k-gram hashes keeps its smallest, the rightmost where several are equal, with
its position. Two texts that share ``K + WINDOW - 1`` tokens in a row share a kept hash for certain;
matches under ``K`` tokens are never reported.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TOKEN = r"(?<!\S)\S{1,12}(?!\S)|\S"
K = 5
#: A power of two: window minima are found by doubling.
WINDOW = 8
#: Buckets of documents per shuffle partition, so that partitions are even.
BUCKETS = 16

_HASH, _PLACE = 0x7FFFFFFF, 0xFFFFFFFF


def fingerprint_columns(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``<out>``, an array of (hash << 32 | 2^32 - 1 - position) of the kept k-grams in their order.

    Positions count tokens from 0. A text of fewer than ``K`` tokens has one k-gram of all its tokens, an
    empty or null text has none. A text with fewer than ``WINDOW`` k-grams is one window.
    """
    tokens, grams = F.col(f"{out}_tokens"), F.col(out)
    df = df.withColumn(f"{out}_tokens", F.regexp_extract_all(
        F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(TOKEN), F.lit(0)))

    def placed(value: Column, at: Column) -> Column:
        # The smaller number is the smaller hash or, where hashes are equal, the one further right.
        return F.shiftleft(value.bitwiseAND(F.lit(_HASH)), 32).bitwiseOR(F.lit(_PLACE) - at)

    def gram(at: Column) -> Column:
        return placed(F.xxhash64(*(F.get(tokens, at.cast("int") + i) for i in range(K))), at)

    few = F.when(F.size(tokens) > 0, F.array(placed(F.xxhash64(F.concat_ws(" ", tokens)), F.lit(0).cast("long"))))
    many = F.transform(F.sequence(F.lit(0).cast("long"), (F.size(tokens) - K).cast("long")), gram)
    df = df.withColumn(out, F.when(F.size(tokens) >= K, many).otherwise(F.coalesce(few, F.array().cast("array<long>"))))
    df = df.drop(f"{out}_tokens").withColumn(f"{out}_windows", F.greatest(F.size(out) - (WINDOW - 1), F.lit(1)))
    reach = 1
    while reach < WINDOW:  # the minimum of 2, 4, 8, ... k-grams from each position on
        df = df.withColumn(out, F.zip_with(grams, F.slice(grams, reach + 1, F.size(grams)), lambda a, b: F.least(a, b)))
        reach *= 2
    return df.withColumn(out, F.array_distinct(F.slice(grams, 1, F.col(f"{out}_windows")))).drop(f"{out}_windows")


def hashes(kept: Column) -> Column:
    """The set of hashes of kept k-grams, without positions."""
    return F.array_distinct(F.transform(kept, lambda x: F.shiftright(x, 32).cast("int")))


def digest(kept: Column) -> Column:
    """128 bits of the kept hashes and positions, in hex; equal for equal texts."""
    return F.concat(*(F.lpad(F.lower(F.hex(F.xxhash64(F.lit(seed), kept))), 16, "0") for seed in (1, 2)))


def likeness(a: Column, b: Column) -> Column:
    """Twice the shared hashes over all hashes of both; 1 for two texts without hashes."""
    total = F.size(a) + F.size(b)
    return F.when(total == 0, 1.0).otherwise(2.0 * F.size(F.array_intersect(a, b)) / total)


def _bounds(rows: DataFrame, buckets: int) -> tuple[list[int], int | None, bool]:
    """Ids that start a bucket, the smallest id and whether there are rows without id.

    The number of ids that reach the driver is the number of buckets.
    """
    shares = F.array(*(F.lit(i / buckets) for i in range(1, buckets)))
    found = rows.agg(F.percentile_approx("doc_id", shares, 10_000).alias("ids"), F.min("doc_id").alias("low"),
                     F.coalesce(F.bool_or(F.col("doc_id").isNull()), F.lit(False)).alias("nulls")).first()
    return sorted({x for x in found["ids"] or [] if x > found["low"]}), found["low"], found["nulls"]


def with_next(docs: DataFrame, add=lambda df: df, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, text, next_text, ...): every row with the text of the next one by doc_id, after the last the first.

    Rows of one id follow each other by text, rows without id come first. ``add`` adds columns to every
    row, computed once, of which ``carry`` also come with the next row as ``next_<name>``. Texts are
    shuffled once: rows are dealt into ranges of ids, and the first rows of a range are also sent to the
    range before.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"),
                       F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    bounds, low, nulls = _bounds(rows, parts * BUCKETS)
    ids, last = F.lit(bounds or [2 ** 62]), len(bounds)

    # Binary search of the number of bounds that are not above the id.
    steps = [1 << i for i in range(max(1, last.bit_length()) - 1, -1, -1)] if last else []
    bucket = F.lit(0)
    if steps:
        bucket = F.aggregate(F.lit(steps), F.lit(0), lambda at, step: F.when(
            F.get(ids, at + step - 1) <= F.col("doc_id"), at + step).otherwise(at))
    first = F.col("doc_id").isNull() if nulls else F.col("doc_id") == F.lit(low)
    opens = (F.col("bucket") > 0) & (F.col("doc_id") == F.get(ids, F.col("bucket") - 1))
    sent = F.array(
        F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("guest")),
        F.when(F.coalesce(opens, F.lit(False)), F.struct((F.col("bucket") - 1).alias("bucket"), F.lit(1).alias("guest"))),
        F.when(F.coalesce(first, F.lit(False)), F.struct(F.lit(last).alias("bucket"), F.lit(2).alias("guest"))))
    rows = rows.withColumn("bucket", bucket).withColumn(
        "sent", F.explode(F.filter(sent, lambda x: x.isNotNull()))).select("doc_id", "text", "sent.*")
    rows = add(rows.repartition(parts, "bucket"))
    order = Window.partitionBy("bucket").orderBy("guest", "doc_id", "text")
    following = {f"next_{name}": F.lead(name).over(order) for name in ("text", *carry)}
    return rows.withColumns(following).where("guest = 0").drop("bucket", "guest")


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every whole text and of the text whose second half comes from the next document.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    n_kept, edited_kept. The last floor(n_chars / 2) code points are replaced by the first as many (or all)
    of the next document. Null texts are empty; two empty texts have likeness 1. A single row follows
    itself. Of repeated rows each has its own result row.
    """
    def own(df: DataFrame) -> DataFrame:
        df = fingerprint_columns(df, "text", "kept")
        return df.withColumns({"fingerprint": digest(F.col("kept")), "marks": hashes(F.col("kept")),
                               "n_kept": F.size("kept")}).drop("kept")

    rows = with_next(docs, own, ("marks",))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumn("n_chars", F.char_length("text").cast("long"))
    rows = rows.withColumn("edited", F.concat(
        F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - half).cast("int")),
        F.substring(F.col("next_text"), F.lit(1), half))).drop("text", "next_text")
    rows = rows.withColumn("near_next", likeness(F.col("marks"), F.col("next_marks"))).drop("next_marks")
    rows = fingerprint_columns(rows, "edited", "edited_kept")
    rows = rows.withColumn("edited_marks", hashes(F.col("edited_kept")))
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"), "fingerprint",
        digest(F.col("edited_kept")).alias("edited_fingerprint"),
        likeness(F.col("marks"), F.col("edited_marks")).alias("near_edited"), "near_next",
        "n_kept", F.size("edited_kept").alias("edited_kept"))
