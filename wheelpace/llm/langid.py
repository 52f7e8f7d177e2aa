"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text is built. A document is parsed greedily into the
longest phrases that occur somewhere in that text; the fewer phrases, the closer the language. Phrases
are normalised to bits per character: each phrase names a place among the characters of the labelled
text, so it costs the logarithm of their number. The language of the fewest bits wins, the
alphabetically first where several are equal.

The automata are fitted on a bounded sample of labelled rows and sent to the executors; every whole
text is parsed. Numpy follows many stretches of ``STRETCH`` characters at once, however long a single text
is: each is first parsed by itself and then again from where the stretch before it ended, until both parses
meet. The phrases are those of one parse from the first character to the last.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNDETERMINED = "und"
#: Bound of the fitting sample, per language: about so many distinct texts, whole, of together so many characters.
SAMPLE_TEXTS, SAMPLE_CHARS = 200, 40_000
#: The most frequent characters of the sample have a column of transitions; those of all others are searched for.
ALPHABET = 128
#: Bits of a class in a key of state and class.
CLASS_BITS = 21
STRETCH = 512
#: Stretches parsed at once, and characters of texts normalised at once.
LANES, TOGETHER = 8192, 2_000_000


@dataclass(frozen=True)
class Model:
    """Transition tables of all languages, stacked.

    ``steps[state, class]`` is twice the next state, plus one where the phrase ended and a new one began
    with this character, for class 0 and the most frequent ones. Transitions of all other classes stand in
    ``values``, by the sorted ``keys`` of state and class; where there is none, ``starts[language, class]`` holds.
    State 0 of a language is its root.
    """

    languages: list[str]
    classes: np.ndarray  # of a code point, 0: not in the sample
    steps: np.ndarray
    keys: np.ndarray
    values: np.ndarray
    starts: np.ndarray
    roots: np.ndarray
    bits: np.ndarray  # per phrase


@functools.cache
def _letters() -> np.ndarray:
    """1 for code points that are letters, 2 for marks that belong to them."""
    import unicodedata

    kinds = np.zeros(0x110000, np.uint8)
    for point in range(0x110000):
        kind = unicodedata.category(chr(point))[0]
        if kind in "LM":
            kinds[point] = 1 if kind == "L" else 2
    return kinds


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def normalised(text: str) -> tuple[np.ndarray, int]:
    """Code points in lower case with one space for each run of other characters; the number of letters."""
    points = _points(text)
    kinds = _letters()[points]
    points = np.where(kinds > 0, points, 32)
    space = points == 32
    keep = ~space
    keep[1:] |= ~space[:-1]
    return points[keep], int((kinds == 1).sum())


def automaton(text: list[int]) -> list[dict[int, int]]:
    """Suffix automaton of a sequence of classes: of each state the next one by class."""
    step, link, length = [{}], [-1], [0]
    last = 0
    for c in text:
        new = len(step)
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                copy = len(step)
                step.append(dict(step[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return step


def build(samples: dict[str, list[str]]) -> Model:
    """A model of the languages whose sample has letters. Texts of a language are kept apart by a break."""
    texts = {lang: [normalised(t) for t in sorted(found)] for lang, found in sorted(samples.items())}
    texts = {lang: [p for p, letters in found if letters] for lang, found in texts.items()}
    texts = {lang: found for lang, found in texts.items() if found}
    points, counts = np.unique(np.concatenate([np.zeros(0, np.uint32), *(p for f in texts.values() for p in f)]),
                               return_counts=True)
    alphabet = points[np.lexsort((points, -counts))]
    classes = np.zeros(0x110000, np.int32)
    classes[alphabet] = np.arange(1, len(alphabet) + 1)
    apart = len(alphabet) + 1  # break between texts
    width = min(len(alphabet), ALPHABET) + 1
    tables, keys, values, starts, roots, bits, first = [], [], [], [], [], [], 0
    for found in texts.values():
        sequence = [c for p in found for c in (*classes[p].tolist(), apart)]
        step = automaton(sequence)
        start = np.full(apart, first, np.int32)  # after a phrase ended
        for c, state in step[0].items():
            if c != apart:
                start[c] += state
        states = np.repeat(np.arange(len(step)), [len(x) for x in step])
        by = np.fromiter((c for x in step for c in x), np.int64, len(states))
        to = 2 * (np.fromiter((n for x in step for n in x.values()), np.int64, len(states)) + first)
        dense, rare = by < width, (by >= width) & (by != apart)
        table = np.tile(2 * start[:width] + 1, (len(step), 1))
        table[states[dense], by[dense]] = to[dense]
        key = (states[rare] + first) << CLASS_BITS | by[rare]
        order = np.argsort(key)
        tables.append(table)
        keys.append(key[order])  # states of later languages are larger
        values.append(to[rare][order].astype(np.int32))
        starts.append(2 * start + 1)
        roots.append(first)
        first += len(step)
        bits.append(math.log2(len(sequence) + 1))
    steps = np.concatenate(tables) if tables else np.zeros((0, width), np.int32)
    none = np.zeros(0, np.int32)
    return Model(list(texts), classes, steps, np.concatenate([none.astype(np.int64), *keys]), np.concatenate([none, *values]),
                 np.array(starts, np.int32).reshape(len(texts), apart), np.array(roots, np.int32), np.array(bits))


def phrases(model: Model, texts: list[np.ndarray]) -> np.ndarray:
    """(text, language): number of phrases of each text, given as classes of its characters; 1 for an empty text."""
    total = np.ones((len(texts), len(model.languages)), np.int64)  # the first phrase; others count where they begin
    pieces = [(i, at) for i, codes in enumerate(texts) for at in range(0, len(codes), STRETCH)]
    ended = model.roots.copy()  # state of each language where the stretches before ended
    for lane in range(0, len(pieces), LANES):
        chosen = pieces[lane:lane + LANES]
        owners = np.array([i for i, _ in chosen])
        sizes = np.array([min(STRETCH, len(texts[i]) - at) for i, at in chosen])
        order = np.argsort(-sizes, kind="stable")
        place, lengths = np.argsort(order), sizes[order]
        grid = np.zeros((int(lengths[0]), len(chosen)), np.int32)
        for j, at in enumerate(order.tolist()):
            text, first = chosen[at]
            grid[:lengths[j], j] = texts[text][first:first + STRETCH]
        following = np.full(len(chosen), -1)  # the stretch that goes on where this one ends
        following[place[:-1]] = np.where(owners[1:] == owners[:-1], place[1:], -1)
        for k, root in enumerate(model.roots):
            state = np.full(len(chosen), root, np.int32)
            if chosen[0][1]:  # goes on with a text of the stretches before
                state[place[0]] = ended[k]
            count, end = _parse(model, k, grid, lengths, state, following)
            np.add.at(total[:, k], owners[order], count)
            ended[k] = end[place[-1]]
    return total


def _parse(model: Model, language: int, grid: np.ndarray, lengths: np.ndarray, state: np.ndarray,
           following: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phrases that begin in each stretch after its start, and its last state.

    All stretches are parsed side by side from ``state``, then those that go on with another one again from its
    last state, until they are in a state of the parse before: from there on both are the same. Where they reach
    the end without that, the next stretch is parsed again.
    """
    active = np.searchsorted(-lengths, -np.arange(1, len(grid) + 1), side="right")
    count, end = np.zeros(len(lengths), np.int64), state.copy()
    taken = np.zeros(grid.shape, np.int32)
    for row, kept, n in zip(grid, taken, active.tolist(), strict=True):  # n: stretches that are still going on
        kept[:n] = _next(model, language, end[:n], row[:n])
        count[:n] += kept[:n] & 1
        np.right_shift(kept[:n], 1, out=end[:n])
    moved = np.flatnonzero(following >= 0)
    while len(moved):
        lanes, now = following[moved], end[moved]
        at, finished = 0, [moved[:0]]
        while len(lanes):
            old, new = taken[at, lanes], _next(model, language, now, grid[at, lanes])
            count[lanes] += (new & 1) - (old & 1)
            taken[at, lanes] = new
            now = new >> 1
            at += 1
            apart = now != old >> 1
            last = apart & (lengths[lanes] == at)
            end[lanes[last]] = now[last]
            finished.append(lanes[last])
            lanes, now = lanes[apart & ~last], now[apart & ~last]
        moved = np.concatenate(finished)
        moved = moved[following[moved] >= 0]
    return count, end


def _next(model: Model, language: int, state: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Steps of a language from states by classes."""
    width = model.steps.shape[1]
    rare = np.flatnonzero(classes >= width)
    if not len(rare):
        return model.steps.ravel()[state * width + classes]
    found = model.steps.ravel()[state * width + np.where(classes < width, classes, 0)]
    found[rare] = _searched(model, language, state[rare], classes[rare])
    return found


def _searched(model: Model, language: int, state: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Steps by classes that have no column."""
    out = model.starts[language, classes]
    if len(model.keys):
        key = state.astype(np.int64) << CLASS_BITS | classes
        at = np.minimum(np.searchsorted(model.keys, key), len(model.keys) - 1)
        out = np.where(model.keys[at] == key, model.values[at], out)
    return out


def predict(model: Model, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and bits per character of the winner."""
    lang, score, bits = [], [np.zeros(0)], [np.zeros(0)]
    waiting, size = [], 0
    for i, text in enumerate(texts, 1):
        waiting.append(text)
        size += len(text)
        if size >= TOGETHER or i == len(texts):
            found = _predict(model, waiting)
            lang += found[0]
            score.append(found[1])
            bits.append(found[2])
            waiting, size = [], 0
    return lang, np.concatenate(score), np.concatenate(bits)


def _predict(model: Model, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    if not model.languages:
        return [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
    codes, letters = [], np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        points, letters[i] = normalised(text)
        codes.append(model.classes[points])
    sizes = np.array([max(1, len(c)) for c in codes])
    cost = phrases(model, codes) * model.bits / sizes[:, None]
    best = cost.argmin(axis=1)
    ranked = np.sort(cost, axis=1)
    runner = ranked[:, 1] if cost.shape[1] > 1 else 2 * ranked[:, 0]
    score = np.where(letters > 0, 1 - ranked[:, 0] / np.maximum(runner, 1e-9), 0.0)
    lang = [model.languages[b] if n else UNDETERMINED for b, n in zip(best, letters, strict=True)]
    return lang, np.clip(score, 0, 1), ranked[:, 0]


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 1 when divided by 3; false without an id."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def fit(labelled: DataFrame) -> Model:
    """A model of the languages in ``labelled`` (lang, text).

    Of each language about ``SAMPLE_TEXTS`` distinct texts are drawn, those of the smallest hashes; copies of a
    text count once. In the order of their hashes whole texts are learned from as long as they fit into
    ``SAMPLE_CHARS`` together; one that does not fit is passed over. Only where no drawn text fits are
    ``SAMPLE_CHARS`` characters from the middle of one taken. That is all that reaches the driver. Rows of null language
    or text teach nothing.
    """
    rows = labelled.select(labelled["lang"].cast("string").alias("lang"), labelled["text"].cast("string").alias("text"))
    rows = rows.where("lang is not null and text is not null").withColumn("n", F.char_length("text"))
    rows = rows.select("lang", F.xxhash64("text").alias("h"), "n", F.when(F.col("n") <= SAMPLE_CHARS, F.col("text")).otherwise(
        F.substring(F.col("text"), F.floor((F.col("n") - SAMPLE_CHARS) / 2).cast("int") + 1, F.lit(SAMPLE_CHARS))).alias("piece"))
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct("h", 0.02).alias("n")).select(F.col("lang").alias("of"), F.col("n").alias("texts"))
    share = F.lit(float(SAMPLE_TEXTS)) / F.col("texts")
    place = F.pmod("h", F.lit(1 << 40)) / float(1 << 40)
    chosen = rows.join(F.broadcast(sizes), F.col("lang") == F.col("of")).where(place < share)
    chosen = chosen.groupBy("lang", "h").agg(F.min("n").alias("n"), F.min("piece").alias("piece"))
    samples: dict[str, list[str]] = {}
    left: dict[str, int] = {}
    for row in sorted(chosen.collect(), key=lambda r: (r["n"] > SAMPLE_CHARS, r["h"])):  # texts cut to size come last
        free = left.setdefault(row["lang"], SAMPLE_CHARS)
        if len(row["piece"]) <= free:
            samples.setdefault(row["lang"], []).append(row["piece"])
            left[row["lang"]] = free - len(row["piece"])
    return build(samples)


def _parser(docs: DataFrame, model: Model, once: bool = False):
    """A column function: text to struct (lang_pred, score, bits_per_char); ``once`` keeps a filter from parsing again."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, bits_per_char double")
    def parse(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            lang, score, bits = predict(sent.value, texts.tolist())
            yield pd.DataFrame({"lang_pred": lang, "score": score, "bits_per_char": bits})

    return (parse.asNondeterministic() if once else parse)(F.coalesce(docs["text"].cast("string"), F.lit("")))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, bits_per_char) of every row of ``docs``.

    ``lang_pred`` is ``und`` with score 0 for texts that are null, empty or without letters; the score is the
    share of bits that the best language saves over the second. Repeated rows get equal results; extra
    columns are ignored; no rows give no rows.
    """
    return docs.select(docs["doc_id"], _parser(docs, model).alias("found")).select("doc_id", "found.*")


def with_language(docs: DataFrame) -> DataFrame:
    """Identify every document by a model of those that are not held out: doc_id, held_out, lang_pred, score, ..."""
    model = fit(docs.where(~held_out(docs["doc_id"])))
    found = identify(docs, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "bits_per_char")


def known_language(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text has a letter, with the identified language as ``lang``: what is ``und`` goes.

    Every row is decided by its own text, also where rows share an id. Other columns stay. Where nothing is
    labelled nothing can be told apart: all rows with a letter stay as they are.
    """
    model = fit(docs.where(~held_out(docs["doc_id"])))
    if not model.languages:
        return docs.where(F.coalesce(docs["text"].cast("string"), F.lit("")).rlike(r"\p{L}"))
    out = "lang_pred"
    while out in docs.columns:
        out = f"_{out}"
    rows = docs.withColumn(out, _parser(docs, model, once=True)["lang_pred"]).where(F.col(out) != UNDETERMINED)
    kind = docs.schema["lang"].dataType
    return rows.select(*(F.col(out).cast(kind).alias(c) if c == "lang" else F.col(f"`{c}`") for c in docs.columns))
