"""The prefix trie of conversations, with a count-min sketch that keeps unshared prefixes out of the shuffle.

Every conversation is a path from the root; a prefix is known by a 128-bit digest of its turns. A count-min
sketch counts the digests of all prefixes. Its estimates are never too low, so an estimate of one proves
that one conversation alone has the prefix: such a node is written out where it stands, with what its own
conversation tells. Only prefixes with a higher estimate are shuffled and grouped exactly; a prefix that was
estimated too high is grouped like the others and found to be a single one.

Sums over subtrees need no walk over levels: every node has a representative, its smallest member, and what a
node adds is credited to the prefixes of that one conversation, as a running sum from its end.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wheelpace.session import settle

FAMILY = 5
MOST_SHARED_TURNS = 9
SKETCH_ROWS = 4
#: Counters a row of the sketch has at least and at most. With more prefixes than the largest holds, estimates
#: grow and more prefixes take the exact way; results stay the same.
LEAST_CELLS, MOST_CELLS = 1 << 16, 1 << 24
SEGMENT = 1 << 14
#: Ids that one piece of a list of ids holds.
PIECE = 4096

_KEY, _ABOVE = ["k1", "k2"], ["p1", "p2"]
_PREFIX = "conv_id long, depth long, k1 long, k2 long, p1 long, p2 long, bytes long, ends boolean"
_NO_IDS = hashlib.sha256(b"").hexdigest()


# --- rebuilt conversations and their prefixes -----------------------------------------------------

def turn_rows(conversations: DataFrame) -> DataFrame:
    """(family, conv_id, turn, d1, d2, bytes): every turn with 128 bits for its role and text, which stay behind."""
    def plain(name: str) -> Column:
        return F.coalesce(conversations[name].cast("string"), F.lit(""))

    conv_id = conversations["conv_id"].cast("long")
    digest = F.sha2(F.concat(F.octet_length(plain("role")).cast("string"), F.lit(":"), plain("role"), plain("text")), 256)

    def number(at: int) -> Column:  # 60 bits
        return F.conv(F.substring(digest, at, 15), 16, 10).cast("long")

    return conversations.select(
        (conv_id - F.pmod(conv_id, F.lit(FAMILY))).alias("family"), conv_id.alias("conv_id"),
        conversations["turn"].cast("long").alias("turn"), number(1).alias("d1"), number(16).alias("d2"),
        F.octet_length(plain("text")).cast("long").alias("bytes")).where(F.col("conv_id").isNotNull())


def borrowed(conv_id: int) -> int:
    """How many turns a conversation takes from the first of its family."""
    return zlib.crc32(str(conv_id).encode()) % MOST_SHARED_TURNS


class _Path:
    """The prefixes of one conversation, as rows; the last row is held back until it is known whether it ends."""

    def __init__(self, conv_id: int):
        self.conv_id, self.depth, self.key, self.above, self.size = conv_id, 0, (0, 0), (0, 0), 0

    def row(self, ends: bool) -> tuple:
        return (self.conv_id, self.depth, *self.key, *self.above, self.size, ends)

    def grow(self, turn: tuple[int, int, int]) -> tuple:
        done = self.row(False)
        d1, d2, self.size = turn
        digest = hashlib.blake2b(b"%d %d %d %d" % (*self.key, d1, d2), digest_size=16).digest()
        self.above, self.depth = self.key, self.depth + 1
        self.key = (int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True))
        return done


def _prefixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Turns arrive by family, conversation and turn; at most ``MOST_SHARED_TURNS`` of them are remembered."""
    family, first = None, []
    path, own, out = None, 0, []
    for batch in batches:
        for fam, conv, *turn in zip(*(batch[c].tolist() for c in ("family", "conv_id", "d1", "d2", "bytes")), strict=True):
            if fam != family:
                family, first = fam, []
            if path is None or conv != path.conv_id:
                if path is not None:
                    out.append(path.row(True))
                path, own, skip = _Path(conv), 0, borrowed(conv)
                if conv != family:
                    out += [path.grow(t) for t in first[:skip]]
            if conv == family and len(first) < MOST_SHARED_TURNS:
                first.append(turn)
            own += 1
            if conv == family or own > skip:
                out.append(path.grow(turn))
        if out:
            yield _as_rows(out)
            out = []
    if path is not None:
        yield _as_rows([*out, path.row(True)])


def _as_rows(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[f.split()[0] for f in _PREFIX.split(", ")])


def prefixes(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, k1, k2, p1, p2, bytes, ends): a row for every prefix of every rebuilt conversation.

    ``k`` is the prefix, ``p`` the one above, ``bytes`` the size of its last text, ``ends`` whether the
    conversation is no longer than that. The root has the key (0, 0).
    """
    turns = turn_rows(conversations)
    order = ["family", "conv_id", F.asc_nulls_first("turn"), "d1", "d2"]
    return turns.repartition("family").sortWithinPartitions(*order).mapInPandas(_prefixes, _PREFIX)


# --- count-min sketch -----------------------------------------------------------------------------

def _cells(k1: np.ndarray, k2: np.ndarray, cells: int) -> np.ndarray:
    """The counter of each key in every row of the sketch; ``cells`` is a power of two."""
    a, b = k1.view(np.uint64), k2.view(np.uint64) | np.uint64(1)
    rows = np.arange(SKETCH_ROWS, dtype=np.uint64)[:, None]
    return ((a + rows * b) >> np.uint64(7) & np.uint64(cells - 1)).astype(np.int64)


def _add(row: np.ndarray, more: np.ndarray) -> None:
    """Counters stop at 2: all that is asked is whether it was more than one."""
    np.minimum(row + more, 2, out=row)


def sketch(rows: DataFrame, cells: int) -> np.ndarray:
    """Counts of the keys of ``rows`` (k1, k2) up to 2, ``SKETCH_ROWS`` by ``cells``.

    Tasks send the segments in which they counted anything; segments are added up as they stream in, each
    in one task, which holds no more than the segments it is given. The driver gets the sketch.
    """
    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = np.zeros((SKETCH_ROWS, cells), np.uint8)
        for batch in batches:
            at = _cells(batch["k1"].to_numpy(np.int64), batch["k2"].to_numpy(np.int64), cells)
            for row, places in zip(found, at, strict=True):
                place, n = np.unique(places, return_counts=True)
                row[place] = np.minimum(row[place] + np.minimum(n, 2), 2)
        segments = found.reshape(-1, SEGMENT)
        for number in np.nonzero(segments.any(axis=1))[0].tolist():
            yield pd.DataFrame({"segment": [number], "counts": [zlib.compress(segments[number].tobytes(), 1)]})

    def added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, counts in zip(batch["segment"].tolist(), batch["counts"], strict=True):
                _add(total.setdefault(number, np.zeros(SEGMENT, np.uint8)), np.frombuffer(zlib.decompress(counts), np.uint8))
        for number, counts in total.items():
            yield pd.DataFrame({"segment": [number], "counts": [zlib.compress(counts.tobytes(), 1)]})

    schema = "segment long, counts binary"
    out = np.zeros((SKETCH_ROWS * cells // SEGMENT, SEGMENT), np.uint8)
    for row in rows.select(*_KEY).mapInPandas(counted, schema).repartition("segment").mapInPandas(added, schema).collect():
        out[row["segment"]] = np.frombuffer(zlib.decompress(row["counts"]), np.uint8)
    return out.reshape(SKETCH_ROWS, cells)


def screened(rows: DataFrame, cells: int | None = None) -> DataFrame:
    """``rows`` with ``shared`` and ``above_shared``: whether the prefix, and the one above, may be shared."""
    if cells is None:
        cells = min(MOST_CELLS, max(LEAST_CELLS, 1 << (2 * rows.count()).bit_length()))
    sent = rows.sparkSession.sparkContext.broadcast(zlib.compress(sketch(rows, cells).tobytes(), 1))

    @F.pandas_udf("shared boolean, above_shared boolean")
    def screen(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        counts = np.frombuffer(zlib.decompress(sent.value), np.uint8).reshape(SKETCH_ROWS, cells)
        lines = np.arange(SKETCH_ROWS)[:, None]

        def more(k1: pd.Series, k2: pd.Series) -> np.ndarray:
            return counts[lines, _cells(k1.to_numpy(np.int64), k2.to_numpy(np.int64), cells)].min(axis=0) > 1

        for k1, k2, p1, p2 in batches:
            yield pd.DataFrame({"shared": more(k1, k2), "above_shared": more(p1, p2)})

    return rows.withColumn("found", screen(*_KEY, *_ABOVE)).select(*rows.columns, "found.*")


# --- nodes ----------------------------------------------------------------------------------------

def id_list_hashes(ending: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256): the hash of the ascending, comma-joined ids (k1, k2, conv_id) of every key.

    Ids are sorted in ranges and joined to pieces there, so a key that holds most ids is spread over many
    tasks; one task then feeds the pieces of a key, in their order, to the hash and holds one at a time.
    """
    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            k1, k2, ids = (batch[c].to_numpy(np.int64) for c in (*_KEY, "conv_id"))
            new = np.ones(len(ids), bool)
            new[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
            bounds = sorted({*np.nonzero(new)[0].tolist(), *range(0, len(ids), PIECE), len(ids)})
            parts = list(zip(bounds[:-1], bounds[1:], strict=True))
            yield pd.DataFrame({"k1": [k1[a] for a, _ in parts], "k2": [k2[a] for a, _ in parts],
                                "first": [ids[a] for a, _ in parts],
                                "ids": [",".join(map(str, ids[a:b].tolist())) for a, b in parts]})

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, running = None, None
        for batch in batches:
            done = []
            for k1, k2, ids in zip(batch["k1"].tolist(), batch["k2"].tolist(), batch["ids"], strict=True):
                if (k1, k2) != key:
                    if key is not None:
                        done.append((*key, running.hexdigest()))
                    key, running = (k1, k2), hashlib.sha256(ids.encode())
                else:
                    running.update(b"," + ids.encode())
            yield pd.DataFrame(done, columns=[*_KEY, "ends_sha256"])
        if key is not None:
            yield pd.DataFrame([(*key, running.hexdigest())], columns=[*_KEY, "ends_sha256"])

    order = [*_KEY, "conv_id"]
    short = ending.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(
        pieces, "k1 long, k2 long, first long, ids string")
    return short.repartition(*_KEY).sortWithinPartitions(*_KEY, "first").mapInPandas(
        hashed, "k1 long, k2 long, ends_sha256 string")


def subtree_sums(shared: DataFrame, nodes: DataFrame) -> DataFrame:
    """(k1, k2, n_leaves, saved_tokens) of every node of ``nodes``, from the ``shared`` prefix rows."""
    own = nodes.select("conv_id", "depth", ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
                       (F.col("n_convs") == F.col("n_ends")).alias("childless"))
    rows = shared.select("conv_id", "depth", *_KEY, "ends").unionByName(own, allowMissingColumns=True)
    # A conversation is the smallest member of at most one node of each depth, which is on its path.
    paths = rows.repartition("conv_id").groupBy("conv_id", "depth").agg(*(F.max(c).alias(c) for c in (
        *_KEY, "ends", "saved", "childless")))
    from_end = Window.partitionBy("conv_id").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    leaf = (F.col("ends") & F.coalesce("childless", F.lit(False))).cast("long")
    # A conversation whose end is not among these rows ends in a node of its own, which is a leaf.
    sums = paths.select(*_KEY, F.sum(F.coalesce("saved", F.lit(0))).over(from_end).alias("saved"),
                        F.when(F.max("ends").over(from_end), F.sum(leaf).over(from_end)).otherwise(1).alias("leaves"))
    return sums.groupBy(*_KEY).agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))


def prefix_nodes(conversations: DataFrame, cells: int | None = None) -> DataFrame:
    """The trie of the rebuilt ``conversations`` (conv_id, turn, role, text), one row per node: conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Conversation c is rebuilt from the first h turns of conversation c - c mod 5 and its own turns after its
    first h, where h is crc32 of c in decimals mod 9; the first of a family stays as it is. Turns are ordered by
    number, null first, and by a digest of role and text where numbers are equal. Null roles and texts are
    empty; repeated rows are turns of their own. Rows without conv_id belong to no conversation and are left
    out. A conversation without turns after rebuilding is a member of the root alone. No rows give no rows;
    other columns are ignored. ``cells`` is the width of the sketch, a power of two of ``SEGMENT`` or more; it
    follows from the number of prefixes and changes no result.
    """
    rows = settle(screened(settle(prefixes(conversations), "prefixes"), cells), "screened")
    alone, shared = rows.where(~F.col("shared")), rows.where("shared")
    nodes = settle(shared.groupBy(*_KEY).agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("p1").alias("p1"), F.max("p2").alias("p2"),
        F.max("bytes").alias("bytes"), F.count("*").alias("n_convs"), F.count_if("ends").alias("n_ends"),
        F.min(F.when(F.col("ends"), F.col("conv_id"))).alias("first_end")), "shared-nodes")

    one = F.sha2(F.col("first_end").cast("string"), 256)
    several = shared.where("ends").join(nodes.where("n_ends > 1").select(*_KEY), _KEY, "left_semi")
    # One row a key from each side; a single exchange brings them together.
    parts = [
        nodes.select(*_KEY, *_ABOVE, "conv_id", "depth", "n_convs",
                     F.when(F.col("n_ends") == 0, F.lit(_NO_IDS)).when(F.col("n_ends") == 1, one).alias("ends_sha256")),
        subtree_sums(shared, nodes), id_list_hashes(several),
        # Below a shared prefix: nodes that were grouped, and the first node of each tail.
        nodes.where("depth > 0").select(*_ABOVE).unionByName(alone.where("above_shared and depth > 0").select(*_ABOVE))
        .groupBy(*_ABOVE).agg(F.count("*").alias("n_children")).select(
            F.col("p1").alias("k1"), F.col("p2").alias("k2"), "n_children")]
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part, allowMissingColumns=True)
    values = ["conv_id", "depth", *_ABOVE, "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    # A node above that was proved to be a single one counts its child by itself and has no row here.
    exact = together.groupBy(*_KEY).agg(*(F.max(c).alias(c) for c in values)).where("n_convs is not null").select(
        *values[:5], F.coalesce("n_children", F.lit(0)).alias("n_children"), *values[6:])

    tail = alone.select(
        "conv_id", "depth", *_ABOVE, F.lit(1).cast("long").alias("n_convs"),
        F.when(F.col("ends"), 0).otherwise(1).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
        F.when(F.col("ends"), F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(F.lit(_NO_IDS)).alias("ends_sha256"),
        "above_shared")
    inner = tail.where("not above_shared and depth > 0").withColumn("parent_conv_id", F.col("conv_id"))
    heads = exact.unionByName(tail.where("above_shared or depth = 0").drop("above_shared"))
    above = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("above"))
    # Many nodes may hang on one: a shuffle join, whose large partitions Spark splits.
    heads = heads.join(above.hint("merge"), _ABOVE, "left").withColumn("parent_conv_id", F.when(
        F.col("depth") > 0, F.coalesce("above", "conv_id")))
    columns = ["conv_id", "depth", "parent_conv_id", *values[4:]]
    return heads.select(*columns).unionByName(inner.select(*columns))
