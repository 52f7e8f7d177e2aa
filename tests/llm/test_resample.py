import hashlib
import math
import re
import zlib

import pytest

from wheelpace.llm import resample
from wheelpace.session import settle

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def by_hand(docs, target, percent=10, least=20, longest=1, buckets=10_000, seed=2024):
    """Rows (doc_id, n_features, weight, score, rank) from plain loops and one sort."""
    def features(text):
        words = WORD.findall((text or "").translate(UPPER))
        runs = [" ".join(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(x.encode()) % buckets for x in runs]

    found = [(doc_id, *features(text)) for doc_id, text in docs]
    corpus = [b for _, _, bs in found for b in bs]
    wanted = [b for text in target for b in features(text)[1]]

    def gain(b):
        s, t = corpus.count(b), wanted.count(b)
        return math.floor(1000 * math.log((t + 1) * (len(corpus) + buckets) / ((s + 1) * (len(wanted) + buckets))))

    gains = {b: gain(b) for b in set(corpus)}
    rows = []
    for doc_id, n_words, bs in found:
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gains[b] for b in bs)
        rows.append([doc_id, n_words, len(bs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32)))])
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    rank = {id(r): i for i, r in enumerate(able[:len(able) * percent // 100], 1)}
    return sorted((repr((r[0], r[2], r[3], r[4], rank.get(id(r)))) for r in rows))


TEXTS = ["The cat SAT on a mat 7 times; über Straße élan", "one two three four", "", None, "... !!", "z" * 5000,
         "word " * 3000, "a\x00b\x7fc d e", "日本語 テキスト 日本語", "Target words only here target words"]


@pytest.mark.parametrize("longest, buckets, least, percent", [(1, 10_000, 3, 50), (3, 50, 1, 30), (1, 7, 20, 10)])
def test_rows_equal_plain_loops(spark, docs, longest, buckets, least, percent):
    rows = [(i, TEXTS[i % len(TEXTS)] if i % 3 else f"{TEXTS[i % len(TEXTS)]} extra{i} target") for i in range(60)]
    target = [(1, "target words target"), (2, None), (3, "extra6 extra9")]
    found = resample.resample(docs(*rows), docs(*target), percent, least, longest, buckets)
    assert sorted(repr(tuple(r)) for r in found.collect()) == by_hand(rows, [t for _, t in target], percent, least, longest, buckets)


def test_ties_nulls_and_repeated_rows(spark, docs):
    text = "five words are in here"
    rows = [(7, text)] * 12 + [(None, text)] * 5 + [(3, text), (3, "x")]
    found = resample.resample(docs(*rows), docs((1, "here")), 50, 5).collect()
    drawn = sorted((r["rank"], r["doc_id"]) for r in found if r["rank"] is not None)
    assert len(found) == 19 and [r for r, _ in drawn] == list(range(1, 10))
    want = by_hand(rows, ["here"], 50, 5)
    assert sorted(repr((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"])) for r in found) == want


def test_empty_tables(spark, docs):
    none = docs().limit(0)
    assert resample.resample(none, docs((1, "a"))).count() == 0
    found = resample.resample(docs((1, "a b"), (2, "a")), none, 100, 1).collect()
    assert {r["doc_id"]: r["rank"] is not None for r in found} == {1: True, 2: True}
    assert [r["rank"] for r in resample.resample(docs((1, "a b")), none, 10, 1).collect()] == [None]


@pytest.mark.parametrize("wanted", [0, 1, 7, 499, 500, 999, 1000])
def test_the_cutoff_counts_exactly(spark, wanted):
    """Hot scores, hot ids and repeated rows: the draw has as many rows as asked for, from the top."""
    rows = spark.range(1000, numPartitions=5).selectExpr(
        "if(id % 3 = 0, -9000000000000, id % 11) as score", "if(id % 7 = 0, null, id % 2) as doc_id", "id as row")
    scored = settle(rows, "t")
    want = sorted(((-r["score"], r["doc_id"] is not None, r["doc_id"] or 0, r["row"]) for r in scored.collect()))[:wanted]
    found = scored.where(resample.drawn(scored, wanted)).collect()
    assert sorted((-r["score"], r["doc_id"] is not None, r["doc_id"] or 0, r["row"]) for r in found) == want
    numbered = resample.ranked(scored.where(resample.drawn(scored, wanted))).orderBy("rank").collect()
    assert [r["rank"] for r in numbered] == list(range(1, wanted + 1))
    assert [(-r["score"], r["doc_id"] is not None, r["doc_id"] or 0, r["row"]) for r in numbered] == want


def test_very_long_texts_are_taken_in_pieces(spark, docs, monkeypatch):
    monkeypatch.setattr(resample, "TOGETHER", 16)
    rows = [(1, "alpha beta gamma " * 50), (2, "beta")]
    found = resample.resample(docs(*rows), docs((1, "beta")), 100, 1, 2)
    assert sorted(repr(tuple(r)) for r in found.collect()) == by_hand(rows, ["beta"], 100, 1, 2)
