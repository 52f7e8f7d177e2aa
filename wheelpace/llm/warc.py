"""WARC archives of captured pages and a global capture history by external index merge.

Archives are written by Spark's text writer, one record per row with the record's last line end as the
row separator, so that committing, retries and lost executors are Spark's business. Reading them back gives
one index run per archive. Runs are dealt into ranges of (URL key, time, page) and each range merges what
the runs hold of it with a loser tree.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wheelpace.session import discard, fresh_path, settle

#: Payloads of fewer bytes are always stored.
LEAST_BYTES = 1000
#: Records per archive, of pages up to some MB; an archive is read by one task, in pieces.
RECORDS_PER_ARCHIVE = 10_000
#: Index entries that one range merges, of about 300 bytes each.
ENTRIES_PER_RANGE = 100_000
#: Runs that one tree merges; archives beyond that share a run, sorted together.
FAN_IN = 256
#: Pages carry no time of capture: page n counts as captured n seconds after this.
EPOCH = 1_704_067_200

#: Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LINE_END = "\r\n"

_ENTRY = ("page_id long, record_type string, refers_to long, url string, captured string, payload_bytes long, "
          "payload_digest string, archive string, offset long, length long")


# --- writing --------------------------------------------------------------------------------------

def _decided(pages: DataFrame, least_bytes: int) -> DataFrame:
    """Pages with payload, its digest and size, and ``original``: the page that a revisit refers to."""
    html = F.coalesce(pages["html"].cast("string"), F.lit(""))
    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"),
                        html.alias("payload"))
    rows = rows.withColumns({"bytes": F.octet_length("payload").cast("long"),
                             "digest": F.sha1(F.encode("payload", "UTF-8"))})
    copies = rows.where(F.col("bytes") >= least_bytes).groupBy("digest").agg(
        F.max("page_id").alias("largest"), F.count("*").alias("n")).where("n > 1 and largest is not null")
    copies = settle(copies.select("digest", "largest"), "repeated-payloads")
    return rows.join(copies, "digest", "left").withColumn(
        "original", F.when(~F.col("page_id").eqNullSafe(F.col("largest")), F.col("largest")))


def write_archives(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES) -> None:
    """Write a record per row of ``pages`` (page_id, url, html) to gzip-compressed archives under ``path``.

    Of records with equal payloads of at least ``least_bytes`` the largest page_id is a response, others
    revisit it; rows without page_id revisit it too, and where all are without, each is a response. Rows of
    the largest page_id that repeat are all responses. A null payload is empty, a null URL is left
    out. Blanks and control characters in URLs are written as %20.
    """
    rows = _decided(pages, least_bytes)
    revisit = F.col("original").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{LINE_END}Content-Type: text/html; charset=utf-8{LINE_END}Content-Length: "),
                    F.col("bytes").cast("string"), F.lit(2 * LINE_END))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("none"))
    captured = F.date_format(F.timestamp_seconds(F.coalesce("page_id", F.lit(0)) + EPOCH), "yyyy-MM-dd'T'HH:mm:ss'Z'")

    def line(name: str, *value) -> Column:
        return F.concat(F.lit(f"{name}: "), *value, F.lit(LINE_END))

    header = F.concat(
        F.lit(f"{VERSION}{LINE_END}"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", F.lit("<urn:page:"), page, F.lit(">")),
        line("WARC-Date", captured),
        F.coalesce(line("WARC-Target-URI", F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20")), F.lit("")),
        line("WARC-Payload-Digest", F.lit("sha1:"), F.col("digest")),
        F.when(revisit, F.concat(line("WARC-Refers-To", F.lit("<urn:page:"), F.col("original").cast("string"), F.lit(">")),
                                 line("WARC-Profile", F.lit(PROFILE)))).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")))
    # A record ends with two line ends, of which the writer adds the second.
    rows.select(F.concat(header, F.lit(LINE_END), block, F.lit(LINE_END)).alias("value")).write.option(
        "lineSep", LINE_END).option("compression", "gzip").option(
        "maxRecordsPerFile", RECORDS_PER_ARCHIVE).text(path)


# --- reading --------------------------------------------------------------------------------------

class _Stream:
    """Bytes of a gzip file in turn, unpacked piece by piece."""

    def __init__(self, packed: bytes):
        self._packed, self._unpack, self._held = packed, zlib.decompressobj(31), b""
        self.place = self._read = 0

    def _more(self) -> bool:
        if self._unpack.eof:  # a file may hold several members
            left = self._unpack.unused_data
            self._read -= len(left)
            self._unpack = zlib.decompressobj(31)
        piece = self._packed[self._read:self._read + (1 << 18)]
        if not piece:
            return False
        self._read += len(piece)
        self._held += self._unpack.decompress(piece)
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to ``mark``, which is skipped; None at the end of the file."""
        at = 0
        while (found := self._held.find(mark, at)) < 0:
            at = max(0, len(self._held) - len(mark) + 1)
            if not self._more():
                if self._held:
                    raise ValueError("an archive ends within a record")
                return None
        return self.take(found + len(mark))[:found]

    def take(self, size: int) -> bytes:
        while len(self._held) < size:
            if not self._more():
                raise ValueError("an archive ends within a record")
        out, self._held = self._held[:size], self._held[size:]
        self.place += size
        return out


def _number(uri: str | None) -> int | None:
    text = (uri or "").removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text not in ("", "none") else None


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split(LINE_END)[1:]
    return dict(line.split(": ", 1) for line in lines)


def entries(packed: bytes, archive: str) -> Iterator[tuple]:
    """An index entry for each record of an archive; a payload that does not match its digest is an error."""
    stream = _Stream(packed)
    ending = (2 * LINE_END).encode()
    while True:
        offset = stream.place
        head = stream.until(ending)
        if head is None:
            return
        fields = _fields(head)
        block = stream.take(int(fields["Content-Length"]))
        if stream.take(4) != ending:
            raise ValueError(f"a record of {archive} is longer than it says")
        http, _, payload = block.partition(ending)
        size, digest = int(_fields(http)["Content-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha1:")
        if fields["WARC-Type"] == "response" and (len(payload), hashlib.sha1(payload).hexdigest()) != (size, digest):
            raise ValueError(f"a payload of {archive} differs from its digest")
        yield (_number(fields["WARC-Record-ID"]), fields["WARC-Type"], _number(fields.get("WARC-Refers-To")),
               fields.get("WARC-Target-URI"), fields["WARC-Date"], size, digest, archive, offset, stream.place - offset)


def _table(rows: Iterable[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _arrow(schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.schema([(n, kinds[k]) for n, k in (f.split() for f in schema.split(", "))])


def read_archives(spark, path: str) -> DataFrame:
    """An index entry for each record of the archives under ``path``."""
    schema = _arrow(_ENTRY)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, packed in zip(batch["path"].to_pylist(), batch["content"], strict=True):
                yield _table(entries(packed.as_py(), archive.rsplit("/", 1)[-1]), schema)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(parse, _ENTRY)


# --- merging --------------------------------------------------------------------------------------

def url_key(url) -> Column:
    """Host in reverse order, then path and query in lower case; scheme, port and fragment are left out."""
    url = F.coalesce(url, F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#:]*)", 1))
    path = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^#]*)", 1))
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), path)


class LoserTree:
    """Merge of sorted runs: each inner node keeps the run that lost there, the root's winner comes next."""

    def __init__(self, runs: list[Iterator]):
        self._runs = runs
        self._size = max(1, len(runs))
        self._heads = [next(run, None) for run in runs] or [None]
        self._losers = [0] * self._size
        winners = [0] * self._size + list(range(self._size))
        for node in range(self._size - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            if self._before(b, a):
                a, b = b, a
            winners[node], self._losers[node] = a, b
        self._winner = winners[1] if self._size > 1 else 0

    def _before(self, a: int, b: int) -> bool:
        x, y = self._heads[a], self._heads[b]
        return x is not None and (y is None or (x, a) < (y, b))

    def __iter__(self) -> Iterator:
        while (head := self._heads[self._winner]) is not None:
            yield head
            run = self._winner
            self._heads[run] = next(self._runs[run], None)
            node = (run + self._size) // 2
            while node:
                if self._before(self._losers[node], run):
                    run, self._losers[node] = self._losers[node], run
                node //= 2
            self._winner = run


_MERGED = _ENTRY + ", url_key string, part long, place long"


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a range arrive run by run, each in order."""
    from pyspark import TaskContext

    part, table = TaskContext.get().partitionId(), pa.Table.from_batches(batches) if (
        batches := list(batches)) else None
    if table is None or not table.num_rows:
        return
    numbers = table["run"].to_pylist()
    keys = list(zip(table["url_key"].to_pylist(), table["captured"].to_pylist(),
                    [(p is not None, p or 0) for p in table["page_id"].to_pylist()],
                    table["archive"].to_pylist(), table["offset"].to_pylist(), range(len(numbers)), strict=True))
    starts = [i for i, n in enumerate(numbers) if not i or n != numbers[i - 1]] + [len(numbers)]
    runs = [iter(keys[a:b]) for a, b in zip(starts, starts[1:], strict=False)]
    order = pa.array([key[-1] for key in LoserTree(runs)])
    merged = table.drop_columns(["run"]).take(order)
    merged = merged.append_column("part", pa.array([part] * len(order), pa.int64()))
    yield from merged.append_column("place", pa.array(range(len(order)), pa.int64())).to_batches()


def capture_history(index: DataFrame, entries_per_range: int = ENTRIES_PER_RANGE) -> DataFrame:
    """Index entries with ``url_key`` and ``capture_no``, their place in the order of (key, time, page) from 0.

    Ranges end within the captures of one URL where it has many, so no URL is a hot key. Entries without
    page_id come first among equal keys and times; equal entries follow by archive and offset.
    """
    spark = index.sparkSession
    index = settle(index.withColumn("url_key", url_key(F.col("url"))), "capture-runs")
    ranges = max(1, -(-index.count() // entries_per_range), int(spark.conf.get("spark.sql.shuffle.partitions")))
    run = F.pmod(F.xxhash64("archive"), F.lit(FAN_IN)).cast("int")
    order = ["url_key", "captured", "page_id", "archive", "offset"]
    dealt = index.withColumn("run", run).repartitionByRange(ranges, *order).sortWithinPartitions("run", *order)
    merged = settle(dealt.mapInArrow(_merge, _MERGED), "captures")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = merged.groupBy("part").agg(F.count("*").alias("n")).withColumn(
        "first", F.coalesce(F.sum("n").over(before), F.lit(0))).select("part", "first")
    return merged.join(F.broadcast(offsets), "part").withColumn("capture_no", F.col("first") + F.col("place")).drop(
        "part", "place", "first")


def archive_and_read(pages: DataFrame, least_bytes: int = LEAST_BYTES, path: str | None = None) -> DataFrame:
    """Write ``pages`` to archives and read their history back: one row per page.

    Without ``path`` the archives go to the shared folder and are deleted once they are read. An empty
    table gives an empty history; extra columns are ignored.
    """
    spark = pages.sparkSession
    folder = path or fresh_path(spark, "archives")
    write_archives(pages, folder, least_bytes)
    found = capture_history(read_archives(spark, folder))
    if path is None:
        discard(spark, folder)
    return found
