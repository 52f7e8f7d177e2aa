"""SimHash near-duplicates by Golay-code fuzzy hashing.

A fingerprint has 64 bits, cut into segments of 22, 21 and 21. If two fingerprints differ in at most
four bits, some two of the three segments differ in at most two bits together, so one word in between
differs from either in at most one bit of those two segments. Each fingerprint therefore lists, for
every pair of segments, itself and its one-bit changes, every segment decoded to the index of the
nearest codeword of the perfect (23, 12) Golay code: about ten distinct keys of 24 bits per pair. Two
fingerprints within four bits share such a key for certain; what shares one is compared exactly.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wheelpace.llm.common import components, rows_of_text
from wheelpace.session import settle

SHINGLE_WORDS = 4
HASH_SEED = 42
MAX_BITS = 4
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Fixed value: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1 generates the (23, 12) Golay code.
GENERATOR = 0b101011100011
#: Members of a key that one comparison takes; a key with more is cut into blocks, compared in pairs.
BLOCK = 1024


# --- fingerprints ---------------------------------------------------------------------------------

def fingerprint(text: str) -> int:
    """Majority of the bits of all shingle hashes, repeats included; zero for a text without words."""
    words = text.encode().lower().split()  # bytes: only A-Z change case, only ASCII white space splits
    if not words:
        return 0
    joined, n = b" ".join(words), len(words)
    if n <= SHINGLE_WORDS:
        hashes = [xxhash.xxh64_intdigest(joined, HASH_SEED)]
    else:
        starts = np.zeros(n + 1, np.int64)
        np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1, out=starts[1:])
        last = n - SHINGLE_WORDS + 1
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], HASH_SEED)
                  for a, b in zip(starts[:last].tolist(), (starts[SHINGLE_WORDS:] - 1).tolist(), strict=True)]
    total, ones = len(hashes), np.zeros(64, np.int64)
    for at in range(0, total, 1 << 16):  # bits of a very long text in pieces
        bits = np.array(hashes[at:at + (1 << 16)], np.uint64).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(bits, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def _mixed(values: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers, so that node numbers are in random order."""
    x = values.astype(np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):  # fixed values of splitmix64
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(31))).view(np.int64)


def _fingerprints(texts: pd.Series) -> pd.DataFrame:
    marks = np.fromiter(map(fingerprint, texts), np.uint64, len(texts))
    return pd.DataFrame({"mark": marks.view(np.int64), "node": _mixed(marks)})


def simhash(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, mark, node): the fingerprint of every whole text and its number as a node."""
    return rows_of_text(docs).select("doc_id", "text_hash", F.pandas_udf(_fingerprints, "mark long, node long")("text").alias("found")
    ).select("doc_id", "text_hash", "found.*")


# --- keys -----------------------------------------------------------------------------------------

@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Remainders of the upper 12 bits of a word; the correction of up to three bits by remainder."""
    def remainder(word: int) -> int:
        for bit in range(22, 10, -1):
            if word >> bit & 1:
                word ^= GENERATOR << (bit - 11)
        return word

    single = [remainder(1 << bit) for bit in range(23)]
    upper = np.zeros(4096, np.uint32)
    for bit in range(12):
        upper[1 << bit:2 << bit] = upper[:1 << bit] ^ single[11 + bit]
    correction = np.zeros(2048, np.uint32)
    for a in range(23):
        for b in range(a, 23):
            for c in range(b, 23):
                bits = {a, b, c}
                correction[functools.reduce(lambda x, y: x ^ single[y], bits, 0)] = sum(1 << x for x in bits)
    return upper, correction


def decode(words: np.ndarray) -> np.ndarray:
    """Index of the one codeword within three bits of each 23-bit word."""
    upper, correction = _tables()
    found = upper[words >> 11] ^ (words & 0x7FF)
    return (words ^ correction[found]) >> 11


def keys_of(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of every key of every fingerprint."""
    near = []
    for start, width in SEGMENTS:
        segment = ((marks >> np.uint64(start)) & np.uint64((1 << width) - 1)).astype(np.uint32)
        changes = np.concatenate([[0], 1 << np.arange(width)]).astype(np.uint32)
        near.append(decode(segment[:, None] ^ changes).astype(np.int64))
    rows, keys = [], []
    for pair, (a, b) in enumerate(((0, 1), (0, 2), (1, 2))):
        both = np.concatenate([near[a] << 12 | near[b][:, :1], near[a][:, :1] << 12 | near[b]], axis=1)
        both.sort(axis=1)
        new = np.ones(both.shape, bool)
        new[:, 1:] = both[:, 1:] != both[:, :-1]
        row, at = np.nonzero(new)
        rows.append(row)
        keys.append(both[row, at] | pair << 24)
    return np.concatenate(rows), np.concatenate(keys)


def _keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        marks = rows["mark"].to_numpy(np.int64)
        row, key = keys_of(marks.view(np.uint64))
        yield pd.DataFrame({"key": key, "mark": marks[row]})


# --- links ----------------------------------------------------------------------------------------

def _star(marks: np.ndarray, group: np.ndarray, block: np.ndarray, across: np.ndarray) -> pd.DataFrame:
    """Links of rows sorted by group, as one star for each set of rows that hang together.

    Rows of one group are compared by their distance in the order. As soon as a set hangs together, its
    further links are not kept, so the links of a dense group take no more room than its rows.
    """
    label = np.arange(len(marks))
    left = np.arange(len(marks) - 1)
    distance = 1
    while len(left):
        left = left[left + distance < len(marks)]
        left = left[group[left] == group[left + distance]]
        right = left + distance
        apart = ~across[left] | (block[left] != block[right])
        linked = apart & (np.bitwise_count(marks[left] ^ marks[right]) <= MAX_BITS)
        a, b = left[linked], right[linked]
        while len(a):
            a, b = label[a], label[b]
            differ = a != b
            a, b = a[differ], b[differ]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while (label != label[label]).any():
                label = label[label]
        distance += 1
    out = np.nonzero(label != np.arange(len(marks)))[0]
    return pd.DataFrame({"u": _mixed(marks[label[out]]), "v": _mixed(marks[out])})


def _links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows arrive sorted by (key, i, j); a group that a batch ends in waits for the next batch."""
    rest = None
    for rows in batches:
        rows = rows if rest is None else pd.concat([rest, rows], ignore_index=True)
        group = _numbered(rows)
        done = int(np.searchsorted(group, group[-1])) if len(rows) else 0
        rest = rows.iloc[done:]
        if done:
            yield _linked(rows.iloc[:done], group[:done])
    if rest is not None and len(rest):
        yield _linked(rest, _numbered(rest))


def _numbered(rows: pd.DataFrame) -> np.ndarray:
    parts = [rows[c].to_numpy() for c in ("key", "i", "j")]
    new = np.zeros(len(rows), bool)
    for part in parts:
        new[1:] |= part[1:] != part[:-1]
    return np.cumsum(new)


def _linked(rows: pd.DataFrame, group: np.ndarray) -> pd.DataFrame:
    return _star(rows["mark"].to_numpy(np.int64).view(np.uint64), group, rows["own"].to_numpy(),
                 (rows["i"] != rows["j"]).to_numpy())


def links(marks: DataFrame, block: int = BLOCK) -> DataFrame:
    """(u, v): links between nodes of distinct fingerprints ``marks`` (mark) that connect what is within
    ``MAX_BITS`` bits.

    A key with more than ``block`` fingerprints is dealt into blocks by hash; every two of its blocks
    are one group, so a group has a bounded size, however many fingerprints share a key.
    """
    keys = marks.select("mark").mapInPandas(_keys, "key long, mark long")
    crowded = settle(keys.groupBy("key").count().where(F.col("count") > block)
                     .select("key", F.ceil(F.col("count") * 2 / block).alias("blocks")), "crowded-keys")
    blocks = F.coalesce("blocks", F.lit(1))
    own = keys.join(crowded, "key", "left").select(
        "key", "mark", blocks.alias("blocks"), F.pmod(F.xxhash64("mark"), blocks).cast("int").alias("own"))
    dealt = own.withColumn("other", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int")))).select(
        "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "mark", "own")
    return (dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "mark")
            .mapInPandas(_links, "u long, v long"))


def near_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id, text_hash, label) of every row of ``docs`` (doc_id, text).

    Fingerprints link at ``MAX_BITS`` differing bits or fewer; ``component_id`` is the smallest doc_id
    reachable, itself included, and ``label`` names the same group even where all its ids are null.
    Null and empty texts and those without words have fingerprint zero and are linked like any other.
    Repeated rows have the same group; extra columns are ignored; no rows give no rows.
    """
    rows = settle(simhash(docs), "fingerprints")
    marks = settle(rows.groupBy("mark", "node").agg(F.min("doc_id").alias("smallest")), "distinct-fingerprints")
    labels = components(links(marks))
    labelled = settle(marks.join(labels, "node", "left").select(
        "mark", "smallest", F.coalesce("label", "node").alias("label")), "labelled")
    smallest = settle(labelled.groupBy("label").agg(F.min("smallest").alias("component_id")), "smallest")
    groups = settle(labelled.select("mark", "label").join(smallest, "label"), "groups")
    return rows.join(groups, "mark").select(
        "doc_id", F.lpad(F.lower(F.hex("mark")), 16, "0").alias("fingerprint"), "component_id", "text_hash", "label")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each group the row of the smallest (doc_id, text_hash).

    A row without doc_id comes before all others. Of repeated rows one stays. All columns are kept.
    """
    kept = settle(near_groups(docs).groupBy("label").agg(F.min(F.struct("doc_id", "text_hash")).alias("k"))
                  .select("k.doc_id", "k.text_hash"), "kept")
    columns, mark = docs.columns, "text_hash"
    while mark in columns:
        mark = f"_{mark}"
    marked = docs.withColumn(mark, F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))))
    kept = kept.select("doc_id", F.col("text_hash").alias(mark))
    found = marked.alias("d").join(kept.alias("k"), (F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")))
                                   & (F.col(f"d.{mark}") == F.col(f"k.{mark}")), "left_semi")
    return found.dropDuplicates(["doc_id", mark]).select(*columns)
