"""Sum-of-squares packing of tokenised documents into sequences of at most 4096 tokens.

Every task packs its own documents in one pass. A document is cut into full sequences; what is left of
it is an item. Of all fill levels that it fits on, an item goes where the sum of squares of the numbers
of open sequences per level becomes smallest, which keeps every level equally likely to be met by a
fitting item; the numbers are kept in a level array. At the end of a task the sequences that are still
open stay as they are, the fullest first, and what each lacks is cut from the pieces of the emptiest ones;
the one that is left over is cut into lengths that are powers of two, which need no padding.
"""

from __future__ import annotations

import functools
import gc
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LENGTH = 4096
END_OF_DOCUMENT = 2
#: Words whose ids a task remembers, of about 200 bytes each.
REMEMBERED = 500_000
#: Characters of texts whose unknown words are tokenised together.
TOGETHER = 2_000_000
_LOWER = "a-z\u00df-\u00f6\u00f8-\u00ff"
#: A place between a lower-case Latin letter and ASCII punctuation other than an apostrophe.
_EDGE = re.compile(f"(?<=[{_LOWER}])(?=[!-&(-/:-@[-`{{-~])")
_PLAIN = re.compile(f"[{_LOWER}]+").fullmatch
#: How a byte-level vocabulary writes bytes: printable ones as they are, the others as characters from 256 on.
_BYTES = {b: 256 + i for i, b in enumerate(
    b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255))}

NUMBERS = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_length", "by_rule"]


class Words:
    """Token ids of texts as bytes (little-endian, 32 bits each), by looking their words up.

    White space separates words for this tokenizer and takes no id, so the ids of a text are those of
    its words in turn. The tokenizer also parts letters from punctuation, except around an apostrophe, and
    lowers case. That is done here first, for Latin-1 texts without anything like a special token, so
    that fewer words differ; the tokenizer gets the same words either way. A word of lower-case Latin
    letters only needs no further normalisation and goes to the tokenizer's model at once.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    @staticmethod
    def spaced(text: str) -> str:
        """The text with its words apart at single spaces, where that changes no id."""
        if "<|" not in text:
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                pass
            else:
                text = _EDGE.sub(" ", text.lower())
        return text.replace("\n", " ")

    def _learn(self, words: list[str]) -> None:
        """Add the ids of ``words``, from the older half if they are there."""
        older, new, parse = self._older, [], self._tokenizer.model.tokenize
        gc.disable()  # none of the many small objects made here is part of a cycle
        for word in words:
            found = older.get(word)
            if found is not None:
                self._known[word] = found
            elif _PLAIN(word):
                spelled = word if word.isascii() else word.encode().decode("latin-1").translate(_BYTES)
                self._known[word] = struct.pack(f"<{len(found := [t.id for t in parse(spelled)])}I", *found)
            else:
                new.append(word)
        gc.enable()
        if not new:
            return
        found = self._tokenizer.encode(" ".join(new), add_special_tokens=False)
        ids = np.array(found.ids, "<u4")
        first = np.fromiter((start for start, _ in found.offsets), np.int64, len(ids))
        after = np.cumsum(np.fromiter(map(len, new), np.int64, len(new)) + 1)
        stops = np.searchsorted(first, after).tolist()
        raw, at = ids.tobytes(), 0
        for word, stop in zip(new, stops, strict=True):
            self._known[word] = raw[4 * at:4 * stop]
            at = stop

    def ids(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; at the bound the half of the words that was not used for longest is forgotten."""
        split = pc.split_pattern(pa.array(map(self.spaced, texts), pa.large_string()), " ")
        coded = split.flatten().dictionary_encode()
        words, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        if len(self._known) + len(words) > REMEMBERED // 2:
            self._older, self._known = self._known, {}
        known = self._known
        self._learn([w for w in words if w not in known])
        found = [known[w] for w in words]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        ids, first = np.frombuffer(b"".join(found), "<u4"), np.cumsum(sizes) - sizes
        counts = sizes[codes]
        after = np.concatenate([[0], np.cumsum(counts)])
        ids = ids[np.repeat(first[codes] - after[:-1], counts) + np.arange(after[-1])]
        bounds = after[split.offsets.to_numpy()].tolist()
        return [ids[a:b].tobytes() for a, b in zip(bounds, bounds[1:], strict=False)]

    def forget(self) -> None:
        """Drop all remembered words."""
        self._known, self._older = {}, {}


@functools.cache
def _words(path: str) -> Words:
    """One tokenizer per worker, kept over its tasks; its table of words is filled anew by each."""
    return Words(path)


def _together(texts: list[str]) -> Iterator[slice]:
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= TOGETHER:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


class Packer:
    """Open sequences by fill level; pieces (document, start, length, crc) are placed one at a time."""

    def __init__(self, length: int = LENGTH):
        self.length = length
        self._open: list[list[list]] = [[] for _ in range(length)]
        self._number = np.zeros(length + 1, np.int64)  # open sequences per level

    def place(self, size: int, piece) -> list | None:
        """Put a piece of 1 to ``length`` - 1 tokens into a sequence; return its pieces when it is full."""
        levels = np.nonzero(self._number[:self.length - size + 1])[0]
        best, gain = 0, 2 * self._number[size] + 1  # a new sequence
        if len(levels):
            above = self._number[levels + size]
            change = np.where(levels + size < self.length, 2 * (above - self._number[levels]) + 2,
                              1 - 2 * self._number[levels])
            at = int(np.flatnonzero(change == change.min())[-1])  # ties: the fullest
            if change[at] <= gain:
                best = int(levels[at])
        sequence = self._open[best].pop() if best else []
        self._number[best] -= best > 0
        sequence.append(piece)
        if best + size == self.length:
            return sequence
        self._open[best + size].append(sequence)
        self._number[best + size] += 1
        return None

    def rest(self) -> list[list]:
        """The open sequences, fullest first."""
        return [s for level in reversed(self._open) for s in level]


def _pack(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    words, packer = _words(path), Packer()
    following = TaskContext.get().partitionId() << 40
    ending = np.array([END_OF_DOCUMENT], "<u4").tobytes()
    # Ids of the pieces in open sequences, by number: where the rule put them, and where the end of the task did.
    kept: dict[int, bytes] = {}
    moving: dict[int, bytes] = {}

    def closed(sequence: list) -> list:
        nonlocal following
        rows, offset, total = [], 0, sum(p[2] for p in sequence)
        for doc, start, length, crc, tokens, number in sequence:
            by_rule = 1 if number is None or kept.pop(number, None) else 0
            moving.pop(number, None)
            rows.append((doc, start, length, crc, tokens, following, offset, total, by_rule))
            offset += length
        following += 1
        return rows

    def frame(rows: list) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [[]] * (1 + len(NUMBERS))
        types = [kind, *[pa.int64()] * len(NUMBERS)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                          ["doc_id", *NUMBERS])

    number, kind = 0, pa.int64()
    for batch in batches:
        rows, kind = [], batch.schema.field("doc_id").type
        docs, texts = batch["doc_id"].to_pylist(), batch["text"].to_pylist()
        found = (x for part in _together(texts) for x in words.ids(texts[part]))
        for doc, ids in zip(docs, found, strict=True):
            ids += ending
            tokens = len(ids) // 4
            for start in range(0, tokens, LENGTH):
                piece = ids[4 * start:4 * (start + LENGTH)]
                size, number = len(piece) // 4, number + 1
                if size == LENGTH:
                    rows += closed([(doc, start, size, zlib.crc32(piece), tokens, None)])
                    continue
                entry = (doc, start, size, zlib.crc32(piece), tokens, number)
                kept[number] = piece
                full = packer.place(size, entry)
                if full:
                    rows += closed(full)
        yield frame(rows)

    def moved(source: list, room: int, sequence: list) -> int:
        """Cut at most ``room`` tokens from the last piece of ``source`` into ``sequence``; how many."""
        nonlocal number
        doc, start, size, _, tokens, mark = source.pop()
        taken, ids = min(size, room), kept.pop(mark, None) or moving.pop(mark)
        number += 1
        moving[number] = ids[:4 * taken]
        sequence.append((doc, start, taken, zlib.crc32(moving[number]), tokens, number))
        if taken < size:
            moving[mark] = ids[4 * taken:]
            source.append((doc, start + taken, size - taken, 0, tokens, mark))
        return taken

    rows, waiting = [], packer.rest()
    first, last = 0, len(waiting) - 1
    while first < last:
        room = LENGTH - sum(p[2] for p in waiting[first])
        while room and first < last:
            room -= moved(waiting[last], room, waiting[first])
            last -= not waiting[last]
        if room:
            break
        rows += closed(waiting[first])
        first += 1
    rest = waiting[first] if first <= last else []
    total = sum(p[2] for p in rest)
    while total:
        room, sequence = 1 << (total.bit_length() - 1), []
        total -= room
        while room:
            room -= moved(rest, room, sequence)
        rows += closed(sequence)
    if rows:
        yield frame(rows)
    words.forget()  # the worker lives on, and later stages need the room
    pa.default_memory_pool().release_unused()


def pack(docs: DataFrame, tokenizer: str) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_length, by_rule.

    ``tokenizer`` is the path of a tokenizer file on the executors that ignores white space between words.
    The pieces of a sequence fill it without gaps from 0; ``by_rule`` is 1 for a piece that lies where the rule put
    it or is a whole sequence, 0 where the end of the task moved it. Null and empty texts consist of the final id.
    Every row is packed, repeated ones too; extra columns are ignored; no rows give no pieces. A task holds
    the ids of its open sequences only, at most one piece per fill level and open sequence.
    """
    schema = ", ".join([f"doc_id {docs.schema['doc_id'].dataType.simpleString()}", *(f"{n} long" for n in NUMBERS)])
    texts = docs.select("doc_id", F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    return texts.mapInArrow(lambda batches: _pack(batches, tokenizer), schema)
