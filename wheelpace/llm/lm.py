"""Masked pseudo-likelihood: a window network predicts every word from both sides; documents are scored by
the sum of the conditional log-probabilities of their words.

Words become ids: the most frequent words of the whole corpus have their own, all others share ids by
hash, and each of these has its share of the counts of its id: the probability of a word is that of its id
times that share, so that all counted words enter the score and the sum over them is a probability. The shares
of the ``NEXT`` most frequent of them are sent to the tasks, those of all rarer words are joined.

Each of ``SIDE`` places left and right has its own table of vectors; their sum and a bias, through a
tanh, predict the class of the word in the middle and the word within its class. The network is trained in
numpy over all documents: in each of ``ROUNDS`` rounds every task starts from the common weights, trains
on its share of the round's documents at masked places, and the weights are averaged by the
number of places. They are added up piece by piece as the tasks' pieces stream in. Then every place of every
whole text is scored.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wheelpace.llm.resample import lowest
from wheelpace.session import settle

SIDE = 2
CLASSES = 64
PER_CLASS = 64
SHARED = 256  # ids for words without an own one
IDS = CLASSES * PER_CLASS
OWN = IDS - SHARED - 1  # id IDS - 1 stands for places beyond the text
WIDTH = 16
ROUNDS = 2
#: One of so many places is masked and predicted in training.
MASKED = 8
PLACES = 4096  # per step
RATE = 0.2
#: Weights are added up in pieces of so many numbers, every piece in one task.
PIECE = 4096
#: Words without an own id whose shares are sent to the tasks, some 30 bytes each; rarer ones are joined.
NEXT = 200_000
#: Logarithms of shares are summed as whole numbers of this part of one, so that no order changes a sum.
GRAIN = 1 << 28
#: Places whose scores of all classes are worked on at once.
NEAR = 2048
#: Rows scored at once.
TOGETHER = 500
SEED = 5

Weights = dict[str, np.ndarray]


def tokens(text: str) -> list[str]:
    return text.lower().split()


def bucket(word: str) -> int:
    """Which of the shared ids a word without an own one has, from 0."""
    return xxhash.xxh32_intdigest(word.encode()) % SHARED


class Vocabulary:
    """Ids of words; what is looked up is remembered, up to a bound."""

    def __init__(self, own: list[str]):
        self._own = {word: i for i, word in enumerate(own)}
        self._known = dict(self._own)

    def _id(self, word: str) -> int:
        found = self._known.get(word)
        if found is None:
            if len(self._known) > 300_000:
                self._known = dict(self._own)
            found = self._known[word] = OWN + bucket(word)
        return found

    def ids(self, text: str) -> np.ndarray:
        return self.ids_of(tokens(text))

    def ids_of(self, words: list[str]) -> np.ndarray:
        known = self._known
        try:
            return np.array([known[w] for w in words], np.int32)
        except KeyError:
            return np.array([self._id(w) for w in words], np.int32)


def initial(counts: list[int], total: int) -> Weights:
    """Small random weights; biases give every id its share of the corpus, so that training starts from there."""
    rng = np.random.default_rng(SEED)
    shared = max(0, total - sum(counts)) / SHARED
    share = np.full(IDS, 0.5)
    share[:len(counts)] += counts
    share[OWN:OWN + SHARED] += shared
    share = share.reshape(CLASSES, PER_CLASS)
    of_class = share.sum(axis=1)
    return {
        "context": rng.normal(0, 0.1, (2 * SIDE, IDS, WIDTH)).astype(np.float32),
        "bias": np.zeros(WIDTH, np.float32),
        "classes": rng.normal(0, 0.1, (CLASSES, WIDTH)).astype(np.float32),
        "class_bias": np.log(of_class / of_class.sum()).astype(np.float32),
        "words": rng.normal(0, 0.1, (CLASSES, PER_CLASS, WIDTH)).astype(np.float32),
        "word_bias": np.log(share / of_class[:, None]).astype(np.float32),
    }


def _around(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All words of some texts one after the other, with gaps that stand for the ends; places of the words."""
    gap = np.full(SIDE, IDS - 1, np.int32)
    parts, places, at = [gap], [], SIDE
    for x in ids:
        parts += [x, gap]
        places.append(np.arange(at, at + len(x)))
        at += len(x) + SIDE
    return np.concatenate(parts), np.concatenate(places) if places else np.zeros(0, np.int64)


_OFFSETS = [o for o in range(-SIDE, SIDE + 1) if o]


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def _hidden(w: Weights, line: np.ndarray, places: np.ndarray) -> np.ndarray:
    total = w["context"][0][line[places + _OFFSETS[0]]]
    for k, offset in enumerate(_OFFSETS[1:], 1):
        total += w["context"][k][line[places + offset]]
    return np.tanh(total + w["bias"])


def _by_class(targets: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    own = targets // PER_CLASS
    order = np.argsort(own, kind="stable")
    bounds = np.searchsorted(own[order], np.arange(CLASSES + 1))
    for c in range(CLASSES):
        if bounds[c] < bounds[c + 1]:
            yield c, order[bounds[c]:bounds[c + 1]]


def log_probabilities(w: Weights, line: np.ndarray, places: np.ndarray) -> np.ndarray:
    """log P(word | words around it) at each place."""
    out = np.empty(len(places), np.float32)
    for at in range(0, len(places), 1 << 15):
        part = places[at:at + (1 << 15)]
        targets = line[part]
        h = np.concatenate([_hidden(w, line, part[k:k + NEAR]) for k in range(0, len(part), NEAR)])
        found = _log_shares(h, w["classes"], w["class_bias"], targets // PER_CLASS)
        for c, rows in _by_class(targets):
            found[rows] += _log_shares(h[rows], w["words"][c], w["word_bias"][c], targets[rows] % PER_CLASS)
        out[at:at + len(part)] = found
    return out


def _log_shares(h: np.ndarray, vectors: np.ndarray, bias: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The logarithm of the softmax of each row at its ``wanted`` place, in one array that is written in place."""
    scores = h @ vectors.T
    out = np.empty(len(h), np.float32)
    for at in range(0, len(h), NEAR):  # a piece stays in the processor's cache
        x = scores[at:at + NEAR]
        x += bias
        found, top = x[np.arange(len(x)), wanted[at:at + NEAR]], x.max(axis=1)
        x -= top[:, None]
        np.exp(x, out=x)
        out[at:at + NEAR] = found - (np.log(x.sum(axis=1)) + top)
    return out


def _step(w: Weights, line: np.ndarray, places: np.ndarray, rate: float) -> None:
    """One step of gradient ascent on the masked ``places``, in place."""
    targets, h = line[places], _hidden(w, line, places)
    n = len(places)
    rows = np.arange(n)
    wrong = _softmax(h @ w["classes"].T + w["class_bias"])
    wrong[rows, targets // PER_CLASS] -= 1
    back = wrong @ w["classes"]
    w["classes"] -= rate * (wrong.T @ h) / n * CLASSES ** 0.5
    w["class_bias"] -= rate * wrong.mean(axis=0) * CLASSES ** 0.5
    for c, own in _by_class(targets):
        inner = _softmax(h[own] @ w["words"][c].T + w["word_bias"][c])
        inner[np.arange(len(own)), targets[own] % PER_CLASS] -= 1
        back[own] += inner @ w["words"][c]
        w["words"][c] -= rate * (inner.T @ h[own]) / len(own)
        w["word_bias"][c] -= rate * inner.mean(axis=0)
    back *= 1 - h * h
    w["bias"] -= rate * back.mean(axis=0)
    for k, offset in enumerate(_OFFSETS):
        around = line[places + offset]
        order = np.argsort(around, kind="stable")
        ids, first = np.unique(around[order], return_index=True)
        sums = np.add.reduceat(back[order], first, axis=0)
        counts = np.diff(np.append(first, n))[:, None]
        w["context"][k][ids] -= rate * sums / np.sqrt(counts)  # frequent words do not drown rare ones


def _flat(w: Weights) -> np.ndarray:
    return np.concatenate([w[k].ravel() for k in sorted(w)]).astype(np.float64)


def _shaped(flat: np.ndarray) -> Weights:
    out, at = {}, 0
    for k, v in sorted(initial([], 0).items()):
        out[k] = flat[at:at + v.size].reshape(v.shape).astype(np.float32)
        at += v.size
    return out


def most_frequent(words: DataFrame, wanted: int) -> list[tuple[str, int]]:
    """The ``wanted`` most frequent of ``words`` (word, n), ties in the order of their hashes.

    The last count among them follows from how many words have each count, the last hash by bisection with
    counts alone, so that no partition sends words that are not wanted. The numbers of words by count are few:
    n different counts take n * (n + 1) / 2 words of text.
    """
    if words.count() > wanted:
        sizes = words.groupBy("n").agg(F.count("*").alias("words"))
        upto = sizes.withColumn("upto", F.sum("words").over(Window.orderBy(F.desc("n")))).where(F.col("upto") >= wanted)
        last = upto.orderBy(F.desc("n")).first()
        left = wanted - (last["upto"] - last["words"])
        tied = settle(words.where(F.col("n") == last["n"]).select(F.xxhash64("word").alias("h")), "tied-words")
        words = words.where((F.col("n") > last["n"]) | (F.col("n") == last["n"]) & (
            F.xxhash64("word") <= lowest(tied, F.col("h"), left)))
    found = words.select("word", "n", F.xxhash64("word").alias("h")).collect()
    return [(r["word"], r["n"]) for r in sorted(found, key=lambda r: (-r["n"], r["h"], r["word"]))]


def _behind(words: DataFrame, last: tuple[str, int]) -> DataFrame:
    """The words that come after ``last`` in the order of ``most_frequent``."""
    word, n = last
    hashed, at = F.xxhash64("word"), F.xxhash64(F.lit(word))
    return words.where((F.col("n") < n) | (F.col("n") == n) & ((hashed > at) | (hashed == at) & (F.col("word") > word)))


def vocabulary(texts: DataFrame) -> tuple[list[str], list[int], int, list[tuple[str, int]], DataFrame]:
    """The ``OWN`` most frequent words of all texts, ties in the order of their hashes; their counts; the count of all
    words; (word, n) of the ``NEXT`` most frequent others, and of all others."""
    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: Counter[str] = Counter()
            for text in batch["text"]:
                found.update(tokens(text))
            yield pd.DataFrame({"word": list(found), "n": list(found.values())})

    words = settle(texts.mapInPandas(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")),
                   "word-counts")
    first = most_frequent(words, OWN + NEXT)
    own, following = first[:OWN], first[OWN:OWN + NEXT]
    others = _behind(words, own[-1]) if len(own) == OWN else words.where("false")
    return [w for w, _ in own], [n for _, n in own], words.agg(F.sum("n")).first()[0] or 0, following, others


def shares(others: DataFrame, following: list[tuple[str, int]]) -> tuple[dict[str, int], DataFrame]:
    """The logarithm, in ``GRAIN``, of the part of its id's counts that a word without an own id has: of the
    ``following`` words, and (word, share) of the rest of ``others``.

    Of the counts of an id one more is set aside for words that were never seen.
    """
    @F.pandas_udf("int")
    def buckets(words: pd.Series) -> pd.Series:
        return pd.Series([bucket(w) for w in words], dtype=np.int32)

    others = others.withColumn("bucket", buckets("word"))
    found = {r["bucket"]: r["n"] for r in others.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}
    sent = {w: round(math.log(n / (found[bucket(w)] + 1)) * GRAIN) for w, n in following}
    rest = _behind(others, following[-1]) if len(following) == NEXT else others.where("false")
    of_id = F.get(F.array(*(F.lit(float(found.get(i, 0) + 1)) for i in range(SHARED))), F.col("bucket"))
    return sent, rest.select("word", F.round(F.log(F.col("n") / of_id) * GRAIN).cast("long").alias("share"))


def _added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums of (piece, n, weights), one piece at a time in memory for each that this task has to add."""
    total: dict[int, list] = {}
    for batch in batches:
        for piece, n, weights in zip(batch["piece"].tolist(), batch["n"].tolist(), batch["weights"], strict=True):
            sums = total.setdefault(piece, [0.0, 0.0])
            sums[0] += n
            sums[1] = sums[1] + np.frombuffer(weights, np.float32).astype(np.float64)
    for piece, (n, sums) in total.items():
        yield pd.DataFrame({"piece": [piece], "n": [n], "weights": [(sums / n).tobytes()]})


def train(texts: DataFrame, own: list[str], counts: list[int], total: int) -> Weights:
    """Weights after ``ROUNDS`` rounds; each document is read in one of them, by the hash of its text."""
    flat = _flat(initial(counts, total))
    context = texts.sparkSession.sparkContext
    for number in range(ROUNDS):
        sent = context.broadcast(pickle.dumps((own, flat)))

        def learn(batches: Iterator[pd.DataFrame], sent=sent, number=number) -> Iterator[pd.DataFrame]:
            words, start = pickle.loads(sent.value)
            known, w, learned, part = Vocabulary(words), _shaped(start), 0, TaskContext.get().partitionId()
            for batch in batches:
                line, places = _around([known.ids(t) for t in batch["text"]])
                rng = np.random.default_rng([SEED, number, part, learned])
                masked = rng.permutation(places)[:math.ceil(len(places) / MASKED)]
                for at in range(0, len(masked), PLACES):
                    chosen = masked[at:at + PLACES]
                    _step(w, line, chosen, RATE / (1 + number))
                    learned += len(chosen)
            if learned:
                sums = (_flat(w) * learned).astype(np.float32)
                pieces = range(0, len(sums), PIECE)
                yield pd.DataFrame({"piece": [at // PIECE for at in pieces], "n": float(learned),
                                    "weights": [sums[at:at + PIECE].tobytes() for at in pieces]})

        share = texts.where(F.pmod(F.xxhash64("text"), F.lit(ROUNDS)) == number)
        schema = "piece int, n double, weights binary"
        found = share.mapInPandas(learn, schema).repartition("piece").mapInPandas(_added, schema).collect()
        if found:
            flat = np.concatenate([np.frombuffer(r["weights"]) for r in sorted(found, key=lambda r: r["piece"])])
        sent.unpersist()
    return _shaped(flat)


def pseudo_likelihood(docs: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, log_likelihood, mean_log_likelihood) of every row of ``docs``.

    Natural logarithms; a word without an own id has the probability of its shared id times its share of that
    id's counts, by a join with the counts of all words. Null, empty and blank texts
    have no words, likelihood 0 and a null mean. Equal texts get equal scores; extra columns are ignored;
    no rows give no rows. What reaches the driver is the vocabulary, the ``NEXT`` words after it, the counts of
    the shared ids and the weights of a round.
    """
    text = F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text")
    texts = docs.select(text)
    own, counts, total, following, others = vocabulary(texts)
    near, rest = shares(others, following)
    sent = docs.sparkSession.sparkContext.broadcast(pickle.dumps((own, near, train(texts, own, counts, total))))

    @F.pandas_udf("n_tokens long, of_ids double, share long, others array<string>")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        words, near, w = pickle.loads(sent.value)
        known = Vocabulary(words)
        for column in (batch[at:at + TOGETHER] for batch in batches for at in range(0, len(batch), TOGETHER)):
            texts = [tokens(t) for t in column]
            ids = [known.ids_of(t) for t in texts]
            line, places = _around(ids)
            sizes = np.array([len(x) for x in ids], np.int64)
            total = np.concatenate([[0.0], np.cumsum(log_probabilities(w, line, places), dtype=np.float64)])
            stops = np.cumsum(sizes)
            others, share = [], np.zeros(len(texts), np.int64)
            for i, (text, x) in enumerate(zip(texts, ids, strict=True)):
                rare = list(compress(text, (x >= OWN).tolist()))
                share[i] = sum(near.get(word, 0) for word in rare)
                others.append([word for word in rare if word not in near])
            yield pd.DataFrame({"n_tokens": sizes, "of_ids": total[stops] - total[stops - sizes], "share": share,
                                "others": others})

    found = settle(docs.select(F.monotonically_increasing_id().alias("row"), docs["doc_id"], scored(text).alias("s"))
                   .select("row", "doc_id", "s.*"), "scores-of-ids")
    # Words that are joined are rarer than ``OWN + NEXT`` others, so no key of the join is hot.
    within = found.select("row", F.explode("others").alias("word")).join(rest.hint("merge"), "word")
    within = within.groupBy("row").agg(F.sum("share").alias("joined"))
    found = found.join(within.hint("merge"), "row", "left").select("doc_id", "n_tokens", (
        F.col("of_ids") + (F.col("share") + F.coalesce("joined", F.lit(0))) / GRAIN).alias("log_likelihood"))
    return found.withColumn("mean_log_likelihood", F.when(
        F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens")))
