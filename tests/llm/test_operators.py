"""The text operators against brute force, on hand-made tables with nulls, ties, repeated and long rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
import public_tokenizers
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from wheelpace.llm import contain, gear, golay, langid, lines, lm, packing, quality, warc, winnow

WORDS = [a + b + c for a in "bdfgklm" for b in "aeiou" for c in ("n", "r", "st", "")]
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def prose(seed, n, words=WORDS):
    rng = random.Random(seed)
    return " ".join(rng.choice(words) for _ in range(n))


ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (None, "no id here"), (5, "!!! 123"), (6, prose(1, 30)),
       (6, prose(1, 30)), (7, prose(1, 30)), (8, "x" * 50_000), (9, prose(2, 20_000))]


# --- 1 --------------------------------------------------------------------------------------------

def items(spark, *rows):
    return spark.createDataFrame(list(rows), "item_id long, text string")


def test_contained_items(spark, docs):
    item = prose(10, 40).split()
    edited = list(item)
    edited[20] = "zzz"  # 5 of 36 shingles are gone: 0.86
    cut = item[:25]  # 21 of 36
    table = docs((1, prose(11, 300) + " " + " ".join(item).upper() + ", " + prose(12, 300)), (2, " ".join(edited)),
                 (3, " ".join(cut)), (4, prose(13, 500)), (5, "say alpha beta, now"), (6, None), (None, " ".join(item)))
    bench = items(spark, (7, " ".join(item)), (8, " ".join(item)), (9, "alpha beta"), (10, None), (11, "..."),
                  (None, "now say"))
    found = {(r.doc_id, r.item_id): (r.n_items, r.shared_shingles, r.item_shingles)
             for r in contain.contained_items(table, bench).collect()}
    assert found == {(1, 7): (2, 36, 36), (2, 7): (2, 31, 36), (None, 7): (2, 36, 36), (5, 9): (1, 1, 1)}
    left = {r.doc_id for r in contain.decontaminate(table, bench).collect()}
    assert left == {3, 4, 6}


def test_contained_items_of_nothing(spark, docs):
    table = docs(*ODD)
    assert contain.contained_items(table, items(spark)).count() == 0
    assert contain.contained_items(table.limit(0), items(spark, (1, "a b c d e f"))).count() == 0
    assert contain.decontaminate(table, items(spark)).count() == len(ODD)


@pytest.mark.parametrize("n", [1, 5, 6, 9, 10, 37])
def test_any_sketch_finds_an_item_that_misses_as_much_as_allowed(spark, docs, n):
    item = [f"w{i}" for i in range(n + 4)]
    keep = math.ceil(0.8 * n)
    table = docs((1, " ".join(item[:keep + 4])), (2, " ".join(item[:keep + 3])))
    assert [r.doc_id for r in contain.contained_items(table, items(spark, (1, " ".join(item)))).collect()] == [1]


def test_decontamination_is_native(spark, docs):
    plan = contain.contained_items(docs(*ODD), items(spark, (1, prose(1, 30))))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# --- 2 --------------------------------------------------------------------------------------------

def tokens_of(text):
    return [t for run in text.lower().split() for t in ([run] if len(run) <= 12 else run)]


def kept_grams(text):
    """Winnowing by its definition, with Spark's hash taken from the tokens' order only."""
    tokens = tokens_of(text)
    return [tuple(tokens[i:i + winnow.K]) for i in range(max(1, len(tokens) - winnow.K + 1))] if tokens else []


def test_winnowing_takes_the_rightmost_minimum_of_each_window(spark):
    text = f"{prose(3, 60)} {prose(3, 60)} {prose(4, 9).replace(' ', '')} exactlytwelv"  # repeats: equal hashes
    row = winnow.fingerprint_columns(spark.createDataFrame([(text,)], "text string"), "text", "f").first()
    tokens = tokens_of(text)
    import pyspark.sql.functions as F
    grams = spark.createDataFrame([tuple(tokens[i:i + 5]) for i in range(len(tokens) - 4)], "a string, b string, c string, d string, e string")
    hashes = [r[0] & 0x7FFFFFFF for r in grams.coalesce(1).select(F.xxhash64("a", "b", "c", "d", "e")).collect()]
    want = []
    for i in range(len(hashes) - winnow.WINDOW + 1):
        window = hashes[i:i + winnow.WINDOW]
        at = i + max(j for j, h in enumerate(window) if h == min(window))
        if (hashes[at], at) not in want:
            want.append((hashes[at], at))
    assert [(x >> 32, 0xFFFFFFFF - (x & 0xFFFFFFFF)) for x in row.f] == want


def test_an_inserted_character_moves_no_others_in_text_without_spaces(spark):
    rng = random.Random(3)
    text = "".join(chr(rng.randrange(0x4E00, 0x5E00)) for _ in range(600))
    frame = spark.createDataFrame([(text,), (text[:50] + "\U00020000" + text[50:],), (text[7:] + "zu",)], "text string")
    kept = winnow.fingerprint_columns(frame, "text", "f").select(winnow.hashes(F.col("f")).alias("h")).collect()
    first, *others = (set(r.h) for r in kept)
    assert all(2 * len(first & other) / (len(first) + len(other)) > 0.9 for other in others)


def test_fingerprint_edits(spark, docs):
    rows = [r for r in ODD if r[0] != 6]
    table = docs(*rows)
    found = {r.doc_id: r for r in winnow.fingerprint_edits(table.repartition(3)).collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for at, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(at + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        r = found[doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if text == edited:
            assert r.near_edited == 1 and r.fingerprint == r.edited_fingerprint
    assert found[1].fingerprint == found[2].fingerprint != found[4].fingerprint
    assert found[9].near_edited > 0.4
    assert winnow.fingerprint_edits(table.limit(0)).count() == 0
    one = winnow.fingerprint_edits(docs((3, "abcd efgh"))).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcd abcd").hexdigest() and one.near_next == 1


def test_repeated_rows_follow_each_other(docs):
    found = winnow.fingerprint_edits(docs((6, "a b c d e f g"), (6, "a b c d e f g"), (7, "z"))).collect()
    assert sorted((r.doc_id, r.near_next) for r in found) == [(6, 0.0), (6, 1.0), (7, 0.0)]


# --- 3 --------------------------------------------------------------------------------------------

def phrases_by_search(text, source):
    """Cross-parsing by substring search."""
    count, start, at = 1, 0, 0
    while at < len(text):
        if text[start:at + 1] in source:
            at += 1
        else:
            count, start = count + 1, at if text[at] in source else at + 1
            at += 1
    return count


def test_phrases_equal_a_search_for_longest_matches():
    sources = {"aa": ["the cat sat on the mat", "dogs"], "bb": ["le chat noir", "un chien"]}
    model = langid.build(sources)
    for text in ("the dog on the chat", "noir noir zz noir", "a", "mat mat mat"):
        points, _ = langid.normalised(text)
        got = langid.phrases(model, [model.classes[points]])[0].tolist()
        # the normalised order of texts, apart by a break that no text holds
        want = [phrases_by_search(text, "\0".join(sorted(s)) + "\0") for s in sources.values()]
        assert got == want, text


def test_language_of_every_text(spark, docs):
    tongues = {"xa": WORDS, "xb": ["zu" + w for w in WORDS[:60]]}
    rows = [(i, prose(i, 60, tongues[lang]), lang) for i in range(60) for lang in [("xa", "xb")[i % 2]]]
    table = spark.createDataFrame([(i, t, lang, None, 0) for i, t, lang in rows],
                                  "doc_id long, text string, lang string, source string, n_chars long")
    odd = docs(*ODD).select("doc_id", "text", "lang", "source", "n_chars")
    found = langid.with_language(table.withColumn("lang_pred", table["text"]).union(
        odd.withColumn("lang_pred", odd["text"]))).collect()
    truth = {i: lang for i, _, lang in rows if i > 9}
    assert all(r.lang_pred == truth[r.doc_id] for r in found if r.doc_id in truth)
    assert {r.held_out for r in found if r.doc_id == 12} == {zlib.crc32(b"12") % 3 == 1}
    empty = langid.identify(docs(*ODD), langid.build({"xa": [prose(1, 50)]})).collect()
    assert {r.doc_id for r in empty if r.lang_pred == "und"} == {1, 2, 3, 5}
    assert all(0 <= r.score <= 1 for r in found + empty)
    kept = langid.known_language(table.union(odd)).where("doc_id < 10 or doc_id is null")
    assert {r.doc_id for r in kept.collect()} == {None, *range(10)} and kept.where("text is null").count() == 0
    assert langid.with_language(docs(*ODD)).where("lang_pred <> 'und'").count() == 0  # nothing is labelled
    assert langid.with_language(table.limit(0)).count() == 0


def test_known_language_takes_effect(spark, docs):
    wrong = next(i for i in range(1, 60, 2) if zlib.crc32(str(i).encode()) % 3 == 1)  # held out, so it teaches nothing
    tongues = {"xa": WORDS, "xb": ["zu" + w for w in WORDS[:60]]}
    rows = [(i, prose(i, 60, tongues[lang]), "xa" if i == wrong else lang) for i in range(60) for lang in [("xa", "xb")[i % 2]]]
    table = spark.createDataFrame([*rows, (70, prose(70, 60), None), (71, "123", "xa"), (72, None, "xa")],
                                  "doc_id long, text string, lang string").selectExpr("*", "lang AS lang_pred")
    found = langid.known_language(table)
    assert found.columns == table.columns
    assert {r.doc_id: r.lang for r in found.collect()} == {i: ("xa", "xb")[i % 2] for i in (*range(60), 70)}
    unlabelled = langid.known_language(docs(*ODD)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in unlabelled) == sorted(
        (i or 0, t) for i, t in ODD if any(c.isalpha() for c in t or ""))


def test_scripts_of_many_letters():
    rng = random.Random(7)
    letters = {"ja": range(0x3400, 0x3400 + 500), "ko": range(0xAC00, 0xAC00 + 700), "zh": range(0x4E00, 0x4E00 + 700)}
    words = {lang: ["".join(chr(rng.choice(found)) for _ in range(3)) for _ in range(300)] for lang, found in letters.items()}
    words["zz"] = [w[::-1] for w in words["zh"]]  # the same letters in another order
    sources = {lang: [prose(i, 60, found) for i in range(20)] for lang, found in sorted(words.items())}
    sources["xa"] = [prose(i, 400) for i in range(20)]
    model = langid.build(sources)
    texts = {lang: prose(99, 40, found) for lang, found in words.items()}
    assert langid.predict(model, list(texts.values()))[0] == list(texts)
    for text in texts.values():
        got = langid.phrases(model, [model.classes[langid.normalised(text)[0]]])[0].tolist()
        assert got == [phrases_by_search(text, "\0".join(sorted(sources[lang])) + "\0") for lang in sorted(sources)]


@pytest.mark.parametrize("stretch, lanes", [(512, 8192), (7, 8192), (16, 3), (1, 2), (64, 1)])
def test_a_parse_goes_on_across_stretches(monkeypatch, stretch, lanes):
    monkeypatch.setattr(langid, "STRETCH", stretch)
    monkeypatch.setattr(langid, "LANES", lanes)
    tongues = {"xa": WORDS, "xb": ["zu" + w for w in WORDS[:60]], "xc": [chr(0x4E00 + 3 * i) * 2 for i in range(300)]}
    sources = {lang: [prose(i, 80, words) for i in range(5)] for lang, words in tongues.items()}
    model = langid.build(sources)
    # Long matches of whole stretches, texts of another language, one letter again and again, empty and short ones.
    texts = [prose(50, 300), sources["xa"][0] * 3, prose(51, 200, tongues["xc"]), "a" * 1500, "", "ba", sources["xb"][2]]
    points = [langid.normalised(t)[0] for t in texts]
    got = langid.phrases(model, [model.classes[p] for p in points])
    flat = ["".join(map(chr, p)) for p in points]
    for text, found in zip(flat, got.tolist(), strict=True):
        assert found == [phrases_by_search(text, "\0".join(sorted(sources[lang])) + "\0") for lang in sorted(sources)]


def test_whole_texts_are_learned_from(spark, monkeypatch):
    built = []
    monkeypatch.setattr(langid, "SAMPLE_CHARS", 100)
    monkeypatch.setattr(langid, "build", lambda samples: built.append({k: sorted(v) for k, v in samples.items()}))
    rows = [("xa", "a" * 60), ("xa", "a" * 60), ("xa", "b" * 30), ("xa", "c" * 4000), ("xb", "de" * 300), (None, "f"), ("xc", None)]
    langid.fit(spark.createDataFrame(rows, "lang string, text string"))
    assert built == [{"xa": ["a" * 60, "b" * 30], "xb": ["de" * 50]}]


# --- 4 --------------------------------------------------------------------------------------------

def test_pseudo_likelihood(spark, docs):
    easy = "red green blue white " * 40
    table = docs(*[(i, easy) for i in range(10, 60)], (60, "green green red blue white " * 32), *ODD)
    found = {r.doc_id: r for r in lm.pseudo_likelihood(table).collect()}
    assert found[1].n_tokens == found[3].n_tokens == 0 and found[2].mean_log_likelihood is None
    assert found[1].log_likelihood == 0 and found[10].n_tokens == 160
    assert len({round(found[i].log_likelihood, 3) for i in range(10, 60)}) == 1
    assert found[10].mean_log_likelihood > found[9].mean_log_likelihood
    assert all(r.log_likelihood <= 0 for r in found.values())
    assert lm.pseudo_likelihood(table.limit(0)).count() == 0


def test_probabilities_sum_to_one_and_steps_raise_them():
    w = lm.initial([5, 3, 1], 20)
    rng = np.random.default_rng(0)
    line, places = lm._around([np.tile(np.array([1, 2, 700, 9], np.int32), 50)])
    total = np.zeros(1)
    for target in range(lm.IDS):
        probe = line.copy()
        probe[places[60]] = target
        total += np.exp(lm.log_probabilities(w, probe, places[60:61]))
    assert total == pytest.approx(1, abs=1e-3)
    before = lm.log_probabilities(w, line, places).sum()
    for _ in range(20):
        lm._step(w, line, rng.permutation(places)[:50], 0.2)
    assert lm.log_probabilities(w, line, places).sum() > before


def test_every_counted_word_has_its_own_probability(docs):
    same = [w for w in (f"rare{i}" for i in range(2000)) if lm.bucket(w) == lm.bucket("rare0")][:2]
    own = [f"own{i}" for i in range(lm.OWN)]
    table = docs((1, " ".join(own * 8)), (2, f"own1 own2 {same[0]} own3 own4"), (3, f"own1 own2 {same[1]} own3 own4"),
                 (4, " ".join(same[1:] * 6)), (5, "zzz"), (6, None))
    found = {r.doc_id: r.log_likelihood for r in lm.pseudo_likelihood(table).collect()}
    assert found[2] - found[3] == pytest.approx(math.log(1 / 7), abs=1e-5)
    following, others = lm.vocabulary(table.selectExpr("coalesce(text, '') AS text"))[3:]
    assert {r.word: r.n for r in others.collect()} == {same[0]: 1, same[1]: 7, "zzz": 1}
    sent, rest = lm.shares(others, following)
    assert rest.isEmpty()
    share = {word: math.exp(x / lm.GRAIN) for word, x in sent.items()}
    assert share == pytest.approx({same[0]: 1 / 9, same[1]: 7 / 9, "zzz": 1 / 2})


# --- 5 --------------------------------------------------------------------------------------------

def test_repeated_spans(docs):
    rng = random.Random(4)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(330))
    fill = ["".join(rng.choice("ijklmnop ") for _ in range(400)) for _ in range(7)]
    table = docs((1, fill[0] + passage + fill[1]), (2, "é" + fill[2] + passage), (3, fill[3]), (4, passage + fill[4]),
                 (None, fill[5]), (5, None), (6, ""), (7, "tiny"), (8, "tiny"))
    found = {r.doc_id: r for r in gear.repeated_spans(table).collect()}
    assert set(found) == {1, 2, 4} and {r.first_doc_id for r in found.values()} == {1}
    assert [found[i].removed_bytes > 0 for i in (1, 2, 4)] == [False, True, True]
    span = (fill[0] + passage + fill[1])[found[1].start:found[1].start + found[1].bytes]
    assert span in passage and (("é" + fill[2] + passage)[found[2].start:]).startswith(span[:60])
    assert gear.repeated_spans(table.limit(0)).count() == 0
    gear.repeated_spans(docs(*ODD)).collect()


def test_chunk_ends_resist_insertions_and_keep_characters_whole():
    text = "".join(random.Random(1).choice("abcdeféü漢 ") for _ in range(3000)).encode()
    data, moved = np.frombuffer(text, np.uint8), np.frombuffer("new é ".encode() + text, np.uint8)
    a, b = gear.ends(data), gear.ends(moved) - 7
    assert set(a[3:]) <= set(b) and a[-1] == len(text)
    for start, stop in zip([0, *a], a, strict=False):
        text[start:stop].decode()
    value = gear.gear(data)
    for at in (0, 5, 100):
        want = sum(int(gear._GEAR[data[at - j]]) << (2 * j) for j in range(min(16, at + 1))) % (1 << 32)
        assert value[at] == want


@pytest.mark.parametrize("word", ["a", "ab ", "na\u00efve ", "\u6f22\u5b57", "two words, ", "twenty-four characters. "])
def test_periodic_passages_are_found(docs, word):
    rng = random.Random(5)
    fill = ["".join(rng.choice("ijklmnop ") for _ in range(400)) for _ in range(6)]
    rest = "".join(rng.choice("bcdefgh ") for _ in range(60))  # too short to be found without the run before it
    run = (word * 400)[:400]
    table = docs((1, fill[0] + run + rest + fill[1]), (2, "\u00e9" + fill[2] + run + rest + fill[3]), (3, fill[4] + run[:300] + fill[5]))
    found = gear.repeated_spans(table).collect()
    assert {r.doc_id for r in found} == {1, 2, 3}
    sizes = np.diff(gear.ends(np.frombuffer((word * 400).encode(), np.uint8)))
    assert sizes[:-1].max() < 2 * gear.SPREAD
    assert gear.repeated_spans(docs((1, fill[0] + run + fill[1]))).count() == 1  # repeated within one text


def test_copies_of_short_texts_are_reported(docs):
    short = prose(8, 14)
    table = docs((1, "tiny"), (2, "tiny"), (3, short), (4, short), (5, short + " " + prose(9, 300)), (6, ""), (7, ""))
    found = {r.doc_id: r for r in gear.repeated_spans(table, whole_texts=True).collect()}
    assert set(found) == {1, 2, 3, 4} and [found[i].removed_bytes for i in (1, 2, 3, 4)] == [0, 4, 0, len(short)]


# --- 6 --------------------------------------------------------------------------------------------

def check_packing(pieces, texts):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(TOKENIZER)
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert set(by_doc) == set(texts)
    for doc, own in by_doc.items():
        ids = np.array(tokenizer.encode(texts[doc] or "", add_special_tokens=False).ids + [2], "<u4")
        at = 0
        for p in sorted(own, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[at:at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == own[0].sequence_length <= 4096 and (at & (at - 1)) == 0


def test_packing(spark, docs):
    rows = [(i, t) for i, t in ODD if i != 6] + [(100 + i, prose(i, 20 * i)) for i in range(60)] + [
        (200, "Don't stop!! <|endoftext|> Éá ΌΣΟΣ we'LL ½µ漢字 a b\x85c")]
    pieces = packing.pack(docs(*rows).repartition(3), TOKENIZER).collect()
    check_packing(pieces, dict(rows))
    assert packing.pack(docs(*rows).limit(0), TOKENIZER).count() == 0
    assert packing.pack(docs((6, "a"), (6, "a")), TOKENIZER).count() == 2


def test_most_pieces_stay_where_the_rule_put_them(spark, docs):
    rows = [(i, prose(i, 30 + 37 * i % 900)) for i in range(1200)]
    pieces = packing.pack(docs(*rows).coalesce(1), TOKENIZER).collect()
    check_packing(pieces, dict(rows))
    share = sum(p.length for p in pieces if p.by_rule) / sum(p.length for p in pieces)
    short = {p.sequence_id for p in pieces if p.sequence_length < 4096}
    assert share > 0.5 and len(short) <= 12


def test_sum_of_squares_rule():
    packer, rng = packing.Packer(16), random.Random(2)
    full = 0
    for number in range(400):
        size = rng.randint(1, 15)
        counts = packer._number.copy()

        def squares(level, size=size, counts=counts):
            after = counts.copy()
            after[level] -= level > 0
            after[level + size] += 1
            return int((after[1:16] ** 2).sum())

        best = min(squares(h) for h in range(16 - size + 1) if h == 0 or counts[h])
        full += packer.place(size, (number, 0, size)) is not None
        assert int((packer._number[1:16] ** 2).sum()) == best
    assert full > 150


# --- 7 --------------------------------------------------------------------------------------------

def dedup_by_hand(rows):
    chunks = {}
    for doc, text in rows:
        found = (text or "").split("\n")
        for no, (a, b) in enumerate(lines.cut(found)):
            chunks.setdefault("\n".join(found[a:b]), set()).add((doc, no))
    out = {}
    for doc, text in rows:
        found, kept = (text or "").split("\n"), []
        for no, (a, b) in enumerate(lines.cut(found)):
            chunk = "\n".join(found[a:b])
            several = sum(1 for x in found[a:b] if x.strip()) >= 2
            if not several or min(chunks[chunk]) == (doc, no):
                kept += found[a:b]
        out[doc] = "\n".join(kept)
    return out


def test_line_dedup(docs):
    shared = [prose(50 + i, 6) for i in range(12)]
    rows = [(i, "\n".join([prose(100 + 10 * i + j, 5) for j in range(i % 4)] + shared[i % 3:] + [prose(900 + i, 4)]))
            for i in range(9)] + [(20, "\n\n\n\n"), (21, "\n\n\n\n"), (22, None), (23, "")]
    table = docs(*rows)
    want = dedup_by_hand(rows)
    found = {r.doc_id: r.text for r in lines.without_repeats(table).collect()}
    assert {k: v or "" for k, v in found.items()} == want and found[22] is None and found[20] == "\n\n\n\n"
    assert sum(map(len, want.values())) < 0.5 * sum(len(t or "") for _, t in rows)
    report = {r.doc_id: r for r in lines.line_report(table).collect()}
    assert all(r.kept_chars == len(want[i]) for i, r in report.items()) and report[23].n_lines == 0
    assert lines.without_repeats(table).columns == table.columns
    assert lines.line_report(table.limit(0)).count() == 0
    assert lines.line_report(docs(*ODD, (None, "a b\nc d"), (6, "other"))).count() == len(ODD) + 2


def test_equal_rows_keep_their_chunks(docs):
    text = "\n".join(prose(i, 5) for i in range(20))
    found = lines.line_report(docs((1, text), (1, text), (2, text))).collect()
    assert sorted((r.doc_id, r.kept_lines == r.n_lines) for r in found) == [(1, True), (1, True), (2, False)]


def passages_by_hand(rows):
    """What is left of each text without the pairs of neighbouring lines that have an earlier place."""
    first, want = {}, {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        found = (text or "").split("\n")
        full = [i for i, x in enumerate(found) if x.strip()]
        gone = set()
        for k, (i, j) in enumerate(zip(full, full[1:], strict=False)):
            place = first.setdefault((found[i], found[j]), (doc, k))
            if place not in ((doc, k), (doc, k - 1)):
                gone |= {i, j}
        owner = [max((i for i in full if i <= at), default=full[0] if full else -1) for at in range(len(found))]
        want[doc] = "\n".join(x for x, own in zip(found, owner, strict=True) if own not in gone)
    return want


def test_passages_of_any_length_go_whole(docs):
    def fill(seed):
        return [prose(seed + i, 7) for i in range(3)]

    rows, again = [], ["same", "same"]
    for n in (2, 3, 4, 5, 6):
        passage = [prose(2000 + 10 * n + i, 12) for i in range(n)]
        rows += [(n, "\n".join(fill(3000 + 10 * n) + passage)),
                 (10 + n, "\n\n".join(fill(4000 + 10 * n) + passage + fill(5000 + 10 * n))),
                 (20 + n, "\n".join([""] + passage + fill(6000 + 10 * n)))]
    rows += [(30, "\n".join(again)), (31, "\n".join(again + again[:1])), (32, "same\n\nother"), (33, None), (34, "\n \n"),
             (None, "\n".join(fill(3020)[1:])), (35, "\n".join(["a", "b", "c", "a", "b", "x"]))]
    want = passages_by_hand(rows)
    table = docs(*rows)
    got = {r.doc_id: r.text or "" for r in lines.without_passages(table.repartition(3)).collect()}
    assert got == want
    for n in (2, 3, 4, 5, 6):
        assert got[10 + n] == "\n\n".join(fill(4000 + 10 * n) + fill(5000 + 10 * n))
        assert got[20 + n] == "\n".join(fill(6000 + 10 * n))
    assert got[35] == "a\nb\nc\nx" and got[31] == ""
    report = {r.doc_id: r for r in lines.passage_report(table).collect()}
    assert all(r.kept_sha256 == hashlib.sha256(want[i].encode()).hexdigest() for i, r in report.items())
    assert lines.without_passages(table).columns == table.columns and lines.passage_report(table.limit(0)).count() == 0
    copies = lines.passage_report(docs((1, "a\nb"), (1, "a\nb"), (2, "a\nb"))).collect()
    assert sorted((r.doc_id, r.kept_lines) for r in copies) == [(1, 2), (1, 2), (2, 0)]


def test_chunks_with_an_earlier_place_go_before_pairs_are_compared(docs):
    """A passage is cut at the same lines wherever it stands, so its chunks are found by themselves; pairs are the rest."""
    passage = [prose(7000 + i, 6) for i in range(40)]
    rows = [(1, "\n".join(passage)), (2, "\n\n".join([prose(7100, 4), *passage, prose(7101, 4)])),
            (3, "\n".join([*(prose(7200 + i, 4) for i in range(3)), *passage[5:35]])), (None, "\n".join(passage[10:13]))]
    table, covered = docs(*rows), {}
    for r in lines.later_chunks(table).collect():
        found = [x for x in dict(rows)[r.doc_id].split("\n") if x.strip()]
        a, b = lines.cut(found)[r.chunk]
        assert b - a >= 2 and "\n".join(found[a:b]) in rows[0][1]
        covered[r.doc_id] = covered.get(r.doc_id, 0) + b - a
    assert covered[2] >= 30 and covered[3] >= 20 and None not in covered
    got = {r.doc_id: r.text or "" for r in lines.without_passages(table.repartition(3)).collect()}
    assert got == passages_by_hand(rows)


# --- 8 --------------------------------------------------------------------------------------------

def test_archives_round_trip(spark):
    long, tricky = "é" * 600, "x\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" * 40
    rows = [(1, "http://a.b/x", long), (2, "http://a.b/x", long), (3, None, "short"), (4, "http://a.b/y z\n", "short"),
            (5, "https://c.a:80/Q?r=1#f", tricky), (None, "http://a.b/x", long), (6, "http://a.b/x", None),
            (7, "http://a.b/x", ""), (None, "u", "w" * 2000), (None, "u", "w" * 2000), (9, "u", "v" * 1000), (9, "u", "v" * 1000)]
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, archive string")
    found = warc.archive_and_read(pages.repartition(3)).collect()
    got = sorted(((r.page_id or 0), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found)
    want = []
    for page, _, html in rows:
        body = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == body and p is not None]
        again = len(body) >= 1000 and same and page != max(same)
        want.append((page or 0, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response",
                     max(same) if again else None))
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sorted(r.capture_no for r in found) == list(range(len(rows)))
    keys = [(r.url_key.encode(), r.captured, r.page_id or 0) for r in sorted(found, key=lambda r: r.capture_no)]
    assert keys == sorted(keys) and "a,c)/q?r=1" in {r.url_key for r in found}
    assert warc.archive_and_read(pages.limit(0)).count() == 0


def test_broken_archives_are_an_error():
    import gzip
    head = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Payload-Digest: sha1:00\r\nContent-Length: {}\r\n\r\n"
    block = "HTTP/1.1 200 OK\r\nContent-Length: 2\r\n\r\nab"
    for text in (head.format(len(block)) + block + "\r\n\r\n", head.format(999) + block):
        with pytest.raises(ValueError):
            list(warc.entries(gzip.compress(text.encode()), "a"))


@pytest.mark.parametrize("runs", [0, 1, 2, 3, 5, 8, 13])
def test_loser_tree(runs):
    rng = random.Random(runs)
    lists = [sorted(rng.choices(range(9), k=rng.randint(0, 6))) for _ in range(runs)]
    assert list(warc.LoserTree([iter(x) for x in lists])) == sorted(x for y in lists for x in y)


# --- 9 --------------------------------------------------------------------------------------------

def test_quality_scores(spark, docs):
    rows = [(i, prose(i, 80) if i % 2 else prose(i, 80).upper().replace(" ", "!! ")) for i in range(10, 200)]
    table = docs(*rows, *ODD)
    labels = spark.createDataFrame([(i, i % 2, 0) for i, _ in rows if i % 5] + [(None, 1, 0), (11, None, 0), (12, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in quality.quality_scores(table, labels).collect()}
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in found.values())
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert held and all(found[i].held_out and found[i].predicted == i % 2 for i in held)
    assert {r.score for r in quality.quality_scores(table, labels.limit(0)).collect()} == {0.5}
    assert quality.quality_scores(table.limit(0), labels).count() == 0


def test_isotonic_regression():
    sums, counts = np.array([0.0, 2, 0, 0, 3, 1]), np.array([2.0, 2, 2, 0, 3, 2])
    assert quality.increasing(sums, counts).tolist() == pytest.approx([0, 0.5, 0.5, 0.65, 0.8, 0.8])


# --- 10 -------------------------------------------------------------------------------------------

def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    parts = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_groups(docs):
    base = prose(70, 400).split()
    near = []
    for i in range(40):
        words = list(base)
        for at in random.Random(i).sample(range(400), 3):
            words[at] = f"new{i}"
        near.append((300 + i, " ".join(words)))
    rows = [r for r in ODD if r[0] not in (6, 9)] + near + [(400 + i, prose(200 + i, 40)) for i in range(30)]
    found = {r.doc_id: r for r in golay.near_groups(docs(*rows)).collect()}
    marks = {i: slow_fingerprint(t) for i, t in rows}
    assert all(int(r.fingerprint, 16) == marks[i] for i, r in found.items())
    group = {i: i for i in marks}
    for _ in marks:
        for a in marks:
            for b in marks:
                if (marks[a] ^ marks[b]).bit_count() <= 4:
                    low = min((group[a], group[b]), key=lambda x: (x is None, x or 0))
                    group[a] = group[b] = low
    assert {i: r.component_id for i, r in found.items() if i is not None} == {i: g for i, g in group.items() if i is not None}
    stay = golay.one_of_each(docs(*rows, (7, prose(1, 30)), (7, prose(1, 30))))
    assert sorted(r.doc_id for r in stay.collect() if r.doc_id is not None) == sorted(
        {g for g in group.values() if g is not None})
    assert golay.near_groups(docs(*rows).limit(0)).count() == 0 == golay.one_of_each(docs(*rows).limit(0)).count()


def test_crowded_keys_are_compared_in_blocks(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, dtype=np.int64)
    marks = {int(base ^ (1 << int(a)) ^ (1 << int(b))) for a, b in rng.integers(0, 62, (300, 2))}
    frame = spark.createDataFrame([(m,) for m in marks], "mark long")
    wanted = golay.components(golay.links(frame)).groupBy("label").count().collect()
    blocks = golay.components(golay.links(frame, block=16)).groupBy("label").count().collect()
    assert [r["count"] for r in wanted] == [r["count"] for r in blocks] == [len(marks)]


def test_golay_keys_meet_within_four_bits():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 64, 3000, dtype=np.uint64)
    b = a.copy()
    for i in range(len(b)):
        for bit in rng.choice(64, rng.integers(0, 5), replace=False):
            b[i] ^= np.uint64(1) << np.uint64(bit)
    left, right = (set(zip(*(x.tolist() for x in golay.keys_of(m)), strict=True)) for m in (a, b))
    assert {row for row, _ in left & right} == set(range(len(a)))


# --- pipeline -------------------------------------------------------------------------------------

def test_pipeline_stages(spark, docs, tmp_path):
    item, copy = prose(80, 40), prose(81, 200)
    rows = [(1, copy), (2, copy), (3, prose(82, 100) + " " + item), (4, "..."), (5, None), (6, prose(83, 5000)),
            (7, "\n".join(prose(90 + i, 9) for i in range(8))),
            (8, prose(84, 30) + "\n" + "\n".join(prose(90 + i, 9) for i in range(8)) + "\n" + prose(85, 30))]
    table = docs(*rows).select("doc_id", "text", "lang", "source", "n_chars")
    table = table.withColumn("lang", table["source"])
    table.write.parquet(f"{tmp_path}/documents.parquet")
    items(spark, (1, item)).write.parquet(f"{tmp_path}/benchmark.parquet")
    step, left = table, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        step = stage(spark, step, str(tmp_path))
        assert step.columns == table.columns
        left.append({r.doc_id: r.text for r in step.collect()})
    assert set(left[0]) == {1, 2, 3, 6, 7, 8}
    assert left[1] == passages_by_hand(list(left[0].items()))
    assert left[1][8] == f"{prose(84, 30)}\n{prose(85, 30)}"
    assert set(left[2]) == {1, 3, 6, 7, 8} and set(left[3]) == {1, 6, 7, 8}
    check_packing(corpus_pipeline.run(spark, str(tmp_path)).collect(), left[3])
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID", "line dedup", "near-duplicates", "decontamination", "packing"]


def test_whole_scores_equal_plain_loops(spark, docs, monkeypatch):
    """Every place of whole texts: class, word within the class and the share of a shared id, by plain loops; the
    shares of the most frequent words without an own id are sent, those of the others joined, and give the same."""
    rng = np.random.default_rng(4)
    own = [f"own{i}" for i in range(lm.OWN)]
    rare = [f"rare{i}" for i in range(60)]
    texts = [" ".join(own * 2)] + [" ".join(rng.choice(own[:30] + rare, rng.integers(1, 40))) for _ in range(20)] + ["", None]
    rows = list(enumerate(texts))
    w = lm.initial([3] * lm.OWN, 5 * lm.OWN)
    monkeypatch.setattr(lm, "train", lambda *_: w)
    counts = Counter(t for text in texts for t in lm.tokens(text or ""))
    names = sorted(counts, key=lambda t: (-counts[t], np.uint64(xxhash.xxh64_intdigest(t.encode(), 42)).view(np.int64)))[:lm.OWN]
    ids = {t: names.index(t) if t in names else lm.OWN + lm.bucket(t) for t in counts}
    of_bucket = Counter()
    for t, n in counts.items():
        of_bucket[ids[t]] += n if ids[t] >= lm.OWN else 0

    def score(text):
        line, total = [lm.IDS - 1] * lm.SIDE + [ids[t] for t in lm.tokens(text)] + [lm.IDS - 1] * lm.SIDE, 0.0
        for at, word in enumerate(lm.tokens(text), lm.SIDE):
            around = [line[at + o] for o in range(-lm.SIDE, lm.SIDE + 1) if o]
            h = np.tanh(sum(w["context"][k][x].astype(float) for k, x in enumerate(around)) + w["bias"])
            group, inner = divmod(line[at], lm.PER_CLASS)
            classes = w["classes"] @ h + w["class_bias"]
            words = w["words"][group] @ h + w["word_bias"][group]
            total += classes[group] - np.log(np.exp(classes).sum()) + words[inner] - np.log(np.exp(words).sum())
            if line[at] >= lm.OWN:
                total += math.log(counts[word] / (of_bucket[line[at]] + 1))
        return total

    for limit in (7, lm.NEXT):
        monkeypatch.setattr(lm, "NEXT", limit)
        found = {r.doc_id: r for r in lm.pseudo_likelihood(docs(*rows)).collect()}
        for i, text in rows[1:]:
            assert found[i].n_tokens == len(lm.tokens(text or ""))
            assert found[i].log_likelihood == pytest.approx(score(text or ""), rel=1e-5, abs=1e-6)


def test_pieces_of_weights_are_averaged():
    rows = pd.DataFrame({"piece": [0, 1, 0, 1], "n": [1.0, 1.0, 3.0, 3.0],
                         "weights": [np.full(4, x, np.float32).tobytes() for x in (1, 2, 9, 6)]})
    found = {r.piece: np.frombuffer(r.weights) for part in lm._added(iter([rows[:3], rows[3:]])) for r in part.itertuples()}
    assert found[0].tolist() == [2.5] * 4 and found[1].tolist() == [2.0] * 4


@pytest.mark.parametrize("wanted", [1, 5, 6, 40, 300, 301])
def test_the_most_frequent_words_are_found_by_counts(spark, wanted):
    rows = [(f"w{i}", 1000 - i if i < 5 else 7 if i < 200 else 1) for i in range(300)]
    found = lm.most_frequent(spark.createDataFrame(rows, "word string, n long").repartition(5), wanted)
    order = sorted(rows, key=lambda r: (-r[1], np.uint64(xxhash.xxh64_intdigest(r[0].encode(), 42)).view(np.int64)))
    assert found == order[:wanted]
    behind = lm._behind(spark.createDataFrame(rows, "word string, n long"), found[-1])
    assert sorted((r.word, r.n) for r in behind.collect()) == sorted(order[wanted:])


def test_normal_equations_equal_one_product(spark):
    """Sums of many tasks, sent and added up in pieces, are those of one matrix product."""
    rng = np.random.default_rng(8)
    x, y = rng.normal(0, 1, (300, len(quality.STATISTICS))), rng.integers(0, 2, 300).astype(float)
    rows = spark.createDataFrame([(a.tolist(), float(b)) for a, b in zip(x, y)], "x array<double>, y double").repartition(7)
    centre, scale = x.mean(axis=0), x.std(axis=0)
    products, right, n = quality._normal_equations(rows, centre, scale)
    f = quality.features(x, centre, scale)
    assert n == 300 and np.allclose(products, f.T @ f) and np.allclose(right, f.T @ y)
    products, right, n = quality._normal_equations(rows.limit(0), centre, scale)
    assert n == 0 and not products.any() and not right.any()


def test_texts_without_repeated_chunks(docs):
    """Every chunk stays at its first place only, in the order of ids, by plain loops over the chunks."""
    rng = random.Random(12)
    passage = "".join(rng.choice("abcdefgh é") for _ in range(600))
    rows = [(None, prose(1, 60)), (3, prose(2, 50) + passage), (1, passage + prose(3, 80)), (2, prose(1, 60)), (4, None), (5, ""),
            (6, "xy" * 300), (7, "xy" * 300 + "end"), (8, passage[200:] + passage)]
    first, want = set(), {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        raw = (text or "").encode()
        stops = gear.ends(np.frombuffer(raw, np.uint8)).tolist()
        chunks = [raw[a:b] for a, b in zip([0, *stops], stops)]
        kept = []
        for chunk in chunks:
            if chunk not in first:
                kept.append(chunk)
            first.add(chunk)
        want[doc] = None if text is None else b"".join(kept).decode()
    table = docs(*rows)
    left = gear.without_repeats(table.repartition(3))
    assert left.columns == table.columns and {r.doc_id: r.text for r in left.collect()} == want
    assert want[2] == "" and len(want[3]) < 50 * 8 + 200
    assert [r.text for r in gear.without_repeats(docs((1, "a b"), (1, "a b"))).collect()] == ["a b", "a b"]
    assert gear.without_repeats(table.limit(0)).count() == 0
