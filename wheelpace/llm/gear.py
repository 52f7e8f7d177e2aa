"""Substring dedup by content-defined chunking with a gear rolling hash.

The gear hash of a place mixes the last ``REACH`` bytes. A chunk ends where no hash is smaller
among ``SPREAD`` places on either side, so an ending depends on the bytes around it only:
after an insertion the same endings are found again. Text of a period up to ``SPREAD`` has equal smallest
hashes in a row: of these the first ends a chunk, then each that is ``SPREAD`` bytes or more after the last end, and
the last, so that such text is cut alike whatever is around it. Chunks are at least ``SPREAD`` bytes long, but
for the last of periodic text, and about twice that on average. Equal chunks are found by digest; runs of repeated chunks of at
least ``LEAST_BYTES`` are reported, shorter ones are chance.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wheelpace.llm.common import rows_of_text
from wheelpace.session import settle

REACH = 16
SPREAD = 24
#: A passage of 51 words has about 300 bytes, of which the endings around its chunks take up to 130.
LEAST_BYTES = 80

_DOC = ["doc_id", "text_hash"]
_CHUNKS = "h array<long>, h2 array<long>, at array<int>, size array<int>, of long"
_GEAR = np.random.default_rng(7).integers(0, 1 << 32, 256, dtype=np.uint32)


def gear(data: np.ndarray) -> np.ndarray:
    """Sum of the last 16 bytes' gear values, each shifted by twice its distance: rolled by doubling."""
    value = _GEAR[data]
    reach = 1
    while reach < REACH:
        value[reach:] += value[:-reach] << np.uint32(2 * reach)
        reach *= 2
    return value


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of ``width`` values from each place on; beyond the end counts as large."""
    out, reach = values.copy(), 1
    while reach < width:
        step = min(reach, width - reach)
        out[:-step] = np.minimum(out[:-step], out[step:])
        reach += step
    return out


def ends(data: np.ndarray) -> np.ndarray:
    """Places after the last byte of each chunk, at starts of UTF-8 characters; the last is the end."""
    n = len(data)
    if n <= 2 * SPREAD:
        return np.array([n] if n else [], np.int64)
    # Low bits of a gear value hold few bytes; a multiplication spreads all of them over the high bits.
    value = gear(data) * np.uint32(2654435761)
    value ^= value >> np.uint32(16)
    ahead = _smallest(value, SPREAD)  # of places i to i + SPREAD - 1
    inner = np.arange(SPREAD, n - SPREAD)
    chosen = _thinned(inner[(value[inner] <= ahead[inner - SPREAD]) & (value[inner] <= ahead[inner + 1])]) + 1
    while len(chosen) and (inside := (data[np.minimum(chosen, n - 1)] & 0xC0) == 0x80).any():
        chosen = chosen + (inside & (chosen < n))
    return np.append(np.unique(chosen[chosen < n]), n)


def _thinned(smallest: np.ndarray) -> np.ndarray:
    """Of places within ``SPREAD`` of each other, which have equal hashes: the first, every ``SPREAD`` bytes one, the last."""
    tied = np.diff(smallest) <= SPREAD
    if not tied.any():
        return smallest
    keep, last = np.ones(len(smallest), bool), -1
    for i in np.flatnonzero(tied).tolist():
        if i == 0 or not tied[i - 1]:
            last = smallest[i]
        keep[i + 1] = smallest[i + 1] - last >= SPREAD or i + 1 == len(tied) or not tied[i + 1]
        if keep[i + 1]:
            last = smallest[i + 1]
    return smallest[keep]


def _chunks(texts: pd.Series) -> pd.DataFrame:
    """Two 64-bit digests of each chunk, its place in code points and its size in bytes; the bytes of the text."""
    columns: tuple[list, ...] = ([], [], [], [])
    sizes = []
    for text in texts:
        raw = text.encode()
        data = np.frombuffer(raw, np.uint8)
        stops = ends(data)
        starts = np.concatenate([[0], stops[:-1]]).astype(np.int64) if len(stops) else stops
        digests = b"".join([xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(starts.tolist(), stops.tolist(), strict=True)])
        both = np.frombuffer(digests, "<i8").reshape(-1, 2)
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        for column, values in zip(columns, (both[:, 0], both[:, 1], points[starts].astype(np.int32),
                                            (stops - starts).astype(np.int32)), strict=True):
            column.append(np.ascontiguousarray(values))
        sizes.append(len(raw))
    return pd.DataFrame(dict(zip(("h", "h2", "at", "size", "of"), (*columns, sizes), strict=True)))


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, no, at, size, of, stays, first_id): every chunk that occurs more than once.

    ``at`` counts code points, ``size`` bytes, ``of`` those of the whole text. Of equal chunks the one of the smallest (doc_id, text_hash,
    number) stays; ``first_id`` is its doc_id. Rows without id come first. Two shuffles of all chunks by half
    a digest find what may be repeated; only that is compared by the whole digest.
    """
    cut = rows_of_text(docs).select(*_DOC, F.pandas_udf(_chunks, _CHUNKS)("text").alias("c"))
    each = cut.select(*_DOC, F.col("c.of").alias("of"), F.posexplode(F.arrays_zip("c.h", "c.h2", "c.at", "c.size")).alias("no", "c"))
    each = each.select(*_DOC, "no", "c.*", "of")
    repeated = settle(cut.select(F.explode("c.h").alias("h")).groupBy("h").count().where("count > 1").select("h"),
                      "repeated-digests")
    members = settle(each.join(repeated, "h"), "chunks")
    place = F.struct(*_DOC, "no")
    first = settle(members.groupBy("h", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n"))
                   .where("n > 1").select("h", "h2", "first"), "first-places")
    found = members.join(first, ["h", "h2"])
    return found.select(*_DOC, "no", "at", "size", "of", place.eqNullSafe(F.col("first")).alias("stays"),
                        F.col("first.doc_id").alias("first_id"))


def repeated_spans(docs: DataFrame, least_bytes: int = LEAST_BYTES, whole_texts: bool = False) -> DataFrame:
    """(doc_id, text_hash, start, chunks, bytes, removed_bytes, first_doc_id): runs of repeated chunks.

    A run is a longest row of neighbouring chunks of a document that all occur more than once anywhere,
    of ``least_bytes`` or more or, with ``whole_texts``, of the whole text however short; ``start`` counts code points. ``removed_bytes`` are those of its chunks that
    have an earlier place, ``first_doc_id`` the smallest document that holds one of its chunks first. Every
    document that holds a repeated passage is reported, also the first. Null, empty and short texts are one
    chunk or none. Rows of equal id and text are one document, reported once, and repeat each other. No
    rows give no rows; extra columns are ignored.
    """
    found = repeated_chunks(docs).distinct()
    order = Window.partitionBy(*_DOC).orderBy("no")
    runs = found.withColumn("run", F.col("no") - F.row_number().over(order)).groupBy(*_DOC, "run").agg(
        F.min("at").alias("start"), F.count("*").cast("int").alias("chunks"), F.sum("size").alias("bytes"),
        F.sum(F.when(F.col("stays"), 0).otherwise(F.col("size"))).alias("removed_bytes"),
        F.min("first_id").alias("first_doc_id"), F.first("of").alias("of"))
    whole = F.lit(whole_texts) & (F.col("bytes") == F.col("of"))
    return runs.where((F.col("bytes") >= least_bytes) | whole).drop("run", "of")


def without_repeats(docs: DataFrame) -> DataFrame:
    """All rows of ``docs`` with the chunks that have an earlier place taken out of ``text``; other columns stay as they are.

    Of equal chunks the one of the smallest (doc_id, text_hash, number) stays; a document without id comes first. Rows of
    equal id and text are one document and stay alike. A null text stays null; a text may become empty.
    """
    def left(texts: pd.Series, removed: pd.Series) -> pd.Series:
        found = []
        for text, numbers in zip(texts, removed, strict=True):
            if text is not None and numbers is not None and len(numbers):
                raw, gone = text.encode(), set(numbers)
                stops = ends(np.frombuffer(raw, np.uint8)).tolist()
                text = b"".join(raw[a:b] for no, (a, b) in enumerate(zip([0, *stops], stops, strict=False)) if no not in gone).decode()
            found.append(text)
        return pd.Series(found)

    mark = "text_hash"
    while mark in docs.columns:
        mark = f"_{mark}"
    gone = settle(repeated_chunks(docs).where("not stays").groupBy(*_DOC).agg(F.collect_set("no").alias("removed")), "removed-chunks")
    marked = docs.withColumn(mark, F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))).alias("d")
    joined = marked.join(gone.hint("merge").alias("g"), F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")) & (
        F.col(f"d.{mark}") == F.col("g.text_hash")), "left")
    rest = F.pandas_udf(left, "string")(F.col("d.text").cast("string"), F.col("g.removed"))
    return joined.select(*(rest.alias(c) if c == "text" else F.col(f"d.`{c}`") for c in docs.columns))
