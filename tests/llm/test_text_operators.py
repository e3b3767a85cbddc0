"""License scan, language, shingle join and suffix sorting against brute force, with the odd cases of their inputs."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from gridyield.llm import ngram_join, suffix_dedup
from gridyield.llm.language_id import CELLS, Space, _trigram_codes, learn, predicted, reject_unknown
from gridyield.llm.license_scan import Scanner, scan_licenses, words_of
from gridyield.llm.ngram_join import link_documents, most_different, sketch_keys, verify_sets
from gridyield.llm.queries_license import BASE, NOTICES
from gridyield.llm.shingles import shingle_sets
from gridyield.llm.suffix_dedup import anchors, common_prefixes, removed_repeats, suffix_order

SCHEMA = "doc_id bigint, text string, lang string, name string, number bigint, id bigint, h bigint, word string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def frame(spark, rows):
    """(doc_id, text) rows, with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "en", "x", 1, 2, 3, "y") for i, t in rows], SCHEMA)


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdefghijklmnop", k=draw.randint(2, 7))) for _ in range(words))


# Shingle join


def brute_components(rows):
    sets = {}
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        sets[i] = frozenset(tuple(words[k:k + 5]) for k in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    names = sorted(sets)
    for k, a in enumerate(names):
        for b in names[k + 1:]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= 80 * (len(sets[a]) + len(sets[b]) - shared):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def near_copies(seed: int):
    draw, rows = random.Random(seed), []
    for family in range(12):
        base = prose(1000 * seed + family, draw.choice([3, 5, 6, 9, 30, 120, 400])).split()
        for _ in range(draw.randint(1, 6)):
            words = list(base)
            for _ in range(draw.randint(0, 1 + len(words) // 25)):
                words[draw.randrange(len(words))] = draw.choice(["new", "Word", "x"])
            rows.append((len(rows), draw.choice([" ", "\n", "\t "]).join(words).upper() if draw.random() < 0.2 else " ".join(words)))
    return rows


@pytest.mark.parametrize("block", [2048, 2])
def test_components_equal_brute_force(spark, block):
    rows = near_copies(block) + [(500, None), (501, ""), (502, " \n "), (503, "one two"), (504, "One  two"), (505, "a b c")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in link_documents(frame(spark, rows), block=block).collect()}
    assert got == brute_components(rows)


def test_repeated_rows_and_null_ids_come_back(spark):
    text = prose(1, 40)
    got = link_documents(frame(spark, [(7, text), (7, text), (None, text), (None, prose(2, 40)), (9, text + " more")])).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.component_id if r.component_id is not None else -1) for r in got) == [
        (False, 7, 7), (False, 7, 7), (False, 9, 7), (True, 0, -1), (True, 0, 7)]
    assert link_documents(frame(spark, [])).collect() == []


@given(st.integers(0, 10**6), st.integers(1, 400), st.integers(50, 95))
@settings(max_examples=60, deadline=None)
def test_linked_sets_share_a_lane(seed, size, percent):
    draw = np.random.default_rng(seed)
    a = np.unique(draw.integers(0, 2**63, size).astype(np.uint64))
    out = int(draw.integers(0, len(a) // 4 + 1))
    b = np.unique(np.concatenate([a[out:], draw.integers(0, 2**63, int(draw.integers(0, len(a) // 4 + 1))).astype(np.uint64)]))
    shared = len(np.intersect1d(a, b))
    union = len(a) + len(b) - shared
    if not shared or 100 * shared < percent * union:
        return
    assert union - shared <= most_different(np.array([len(a)]), np.array([len(b)]), percent)[0]
    keys, owners = sketch_keys(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), percent)
    assert set(keys[owners == 0]) & set(keys[owners == 1])


def test_signatures_of_linked_sets_agree():
    draw = np.random.default_rng(4)
    for _ in range(200):
        a = np.unique(draw.integers(0, 2**63, 90).astype(np.uint64))
        b = np.concatenate([a[10:], draw.integers(0, 2**63, 10).astype(np.uint64)])
        b.sort()
        one, two = ngram_join.min_hashes(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        assert sum(x == y for x, y in zip(one, two)) >= ngram_join.AGREE


def test_hot_lanes_are_cut_into_blocks(spark):
    met = spark.createDataFrame([(1, k) for k in range(300)] + [(2, 5), (2, 6), (3, 6), (3, 7), (3, 8)], "lane bigint, number bigint")
    tasks: dict = {}
    for r in ngram_join._dealt_lanes(met, 4, 40).collect():
        tasks.setdefault((r.slot, r.i, r.j), []).append((r.lane, r.number))
    assert max(map(len, tasks.values())) <= 2 * 2 * 40
    pairs = {(lane, *sorted((a, b))) for t in tasks.values() for lane, a in t for other, b in t if lane == other and a != b}
    assert pairs == {(1, a, b) for a in range(300) for b in range(a + 1, 300)} | {(2, 5, 6), (3, 6, 7), (3, 6, 8), (3, 7, 8)}
    # Families of alike sets that share nothing but the lane: the blocks give the components of the whole lane.
    draw = np.random.default_rng(1)
    base = draw.integers(0, 256, (6, ngram_join.HASHES))
    sign = np.array([np.where(draw.random(ngram_join.HASHES) < 0.2, draw.integers(0, 256, ngram_join.HASHES), base[k % 6]) for k in range(300)], np.uint8)
    signatures = spark.createDataFrame([(k, bytearray(x.tobytes())) for k, x in enumerate(sign)], "number bigint, signature binary")
    whole, cut = ({frozenset(x) for x in joined(300, ngram_join._candidates(met.where("lane = 1"), signatures, 4, n).collect())} for n in (2048, 40))
    assert whole == cut == {frozenset(range(k, 300, 6)) for k in range(6)}


def joined(n, links):
    group = {k: {k} for k in range(n)}
    for a, b in links:
        if group[a] is not group[b]:
            group[a] |= group[b]
            for k in group[b]:
                group[k] = group[a]
    return group.values()


def test_verify_sets_joins_what_is_linked_only():
    sets = [np.arange(100, dtype=np.uint64), np.arange(10, 110, dtype=np.uint64), np.arange(40, 140, dtype=np.uint64), np.arange(1000, 1005, dtype=np.uint64)]
    assert verify_sets(sets, np.arange(4), 80).tolist() == [[0, 1]]
    assert verify_sets(sets, np.arange(4), 80, split=1).tolist() == [[0, 1]]
    assert verify_sets([], np.zeros(0, np.int64), 80).shape == (0, 2)


def test_shingles_of_short_and_long_texts():
    value, borders = shingle_sets([b"", b"a b", b"A B", b"a b c d e f", b"x " * 50, b"\xc3\xa4 b c d e"], 5)
    assert np.diff(borders).tolist() == [0, 1, 1, 2, 1, 1]
    assert value[borders[1]] == value[borders[2]]


# Suffix sorting


@given(st.text("ab", max_size=300) | st.text(max_size=60))
@settings(max_examples=150, deadline=None)
def test_suffix_order(text):
    raw = text.encode("utf-8", "surrogatepass")
    got = suffix_order(np.frombuffer(raw, np.uint8), 400).tolist()
    assert got == sorted(range(len(raw)), key=lambda i: raw[i:])


def test_common_prefixes():
    data = np.frombuffer(b"abcabcabd" * 30, np.uint8)
    a, b = np.array([0, 0, 9]), np.array([3, 9, 18])
    assert common_prefixes(data, a, b, 100).tolist() == [5, 100, 100]


def test_equal_strings_have_an_anchor_at_the_same_place():
    draw = random.Random(5)
    string = bytes(draw.choices(b"abcdef \n", k=400))
    places = []
    for lead in (0, 37, 500):
        text = bytes(draw.choices(b"abcdef \n", k=lead)) + string + bytes(draw.choices(b"abcdef \n", k=300))
        at = anchors(np.frombuffer(text, np.uint8), np.array([len(text)]), 400, 160) - lead
        places.append({x for x in at.tolist() if 0 <= x <= 240})
    assert set.intersection(*places)


def brute_removed(rows, length):
    counts = Counter()
    for _, text in rows:
        raw = (text or "").encode()
        counts.update(raw[i:i + length] for i in range(len(raw) - length + 1))
    out = []
    for i, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for k in range(len(raw) - length + 1):
            if counts[raw[k:k + length]] > 1:
                gone[k:k + length] = True
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((i, len(raw), int(gone.sum()), int((gone[:-1] & ~gone[1:]).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def passages(seed: int):
    draw = random.Random(seed)
    shared = [prose(seed + k, 90) for k in range(4)]
    rows = [(k, " ".join(draw.choice(shared) if draw.random() < 0.4 else prose(draw.randrange(10**6), 30) for _ in range(5))) for k in range(25)]
    rows += [(30, rows[0][1]), (31, None), (32, ""), (33, "é" * 900), (34, "a" * 2000), (35, "ab" * 700), (36, rows[2][1][100:1500]), (37, "é" * 450)]
    return rows + [rows[0], (None, shared[0]), (None, "alone")]


@pytest.mark.parametrize(("part", "cut"), [(3000, 1 << 21), (2, 1 << 21), (3000, 700)])
def test_removed_bytes_equal_brute_force(spark, monkeypatch, part, cut):
    monkeypatch.setattr(suffix_dedup, "SLICE", cut)
    rows = passages(part)
    got = removed_repeats(frame(spark, rows), part=part).drop("kept").collect()
    assert sorted(map(tuple, got), key=str) == brute_removed(rows, 400)


def test_nothing_to_remove(spark):
    assert removed_repeats(frame(spark, [])).collect() == []
    got = removed_repeats(frame(spark, [(1, "short"), (2, "short")]), others=["id", "h"]).collect()
    assert sorted((r.doc_id, r.n_removed, r.kept, r.id, r.h) for r in got) == [(1, 0, "short", 2, 3), (2, 0, "short", 2, 3)]


# License scan


def test_notices_equal_search_of_whole_texts():
    draw, scanner = random.Random(2), Scanner(BASE + NOTICES)
    for _ in range(600):
        parts = []
        for _ in range(draw.randint(0, 5)):
            words = list(draw.choice(BASE + NOTICES).words)
            for _ in range(draw.choice([0, 0, 1, 2, 3, 5])):
                k, what = draw.randrange(len(words) - 1), draw.random()
                if what < 0.3:
                    words.pop(k)
                else:
                    words[k:k + (what < 0.6)] = draw.choice("abc xyz")
            parts += ["".join(words), draw.choice(["", " ", "foo bar", "cc by cc by", "license "])]
        words = words_of(" ".join(parts))
        text = " ".join(words)
        got = sorted((f.notice.words, f.notice.errors, f.start, f.end, f.errors) for f in scanner.scan(words))
        whole = [(n, p) for n, p in zip(scanner.notices, scanner.patterns)]
        assert got == sorted((n.words, n.errors, m.start(), m.end(), sum(m.fuzzy_counts)) for n, p in whole for m in p.finditer(text))
        for phrase in BASE:
            run = phrase.words.split()
            assert [f.word for f in scanner.scan(words) if f.notice == phrase] == [k for k in range(len(words)) if words[k:k + len(run)] == run]


def test_license_rows(spark):
    long = "filler, " * 200_000 + "All Rights\nReserved."
    rows = [(1, "Licensed under CC BY-NC 4.0."), (2, None), (3, ""), (4, long), (5, "Relaesed under the MIT Licence."), (5, "cc by, cc by"), (None, "ccby")]
    got = scan_licenses(frame(spark, rows), BASE + NOTICES).collect()
    shown = sorted((str(r.doc_id), r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 2)) for r in got)
    assert shown == [
        ("1", 7, 1, 2, 2, "cc-by", "cc-by,cc-by-nc", 1.0), ("2", 0, 0, None, None, "", "", 0.0), ("3", 0, 0, None, None, "", "", 0.0),
        ("4", 200_003, 1, 200_000, 200_000, "reserved", "reserved,reserved-like", 1.0), ("5", 4, 2, 0, 2, "cc-by", "cc-by", 1.0),
        ("5", 5, 0, None, None, "", "mit", 0.9), ("None", 1, 0, None, None, "", "", 0.0)]
    spans = {(s.label, s.matched) for r in got for s in r.spans}
    assert ("mit", "relaesed under the mit licence") in spans and ("cc-by-nc", "licensed under cc by nc") in spans
    assert regex.fullmatch("(?:all rights reserved){e<=2}", "all right reserved")


# Language


def test_language_of_odd_texts(spark):
    english, german = "the quick brown fox and the lazy dog " * 5, "der schnelle braune fuchs und der faule hund " * 5
    rows = spark.createDataFrame(
        [(1, english, "en"), (2, german, "de"), (3, None, "en"), (4, "", None), (5, "123 !?", "de"), (6, "the fox", None), (7, "der hund und fuchs" * 50_000, None), (7, "THE FOX", None)],
        "doc_id bigint, text string, lang string")
    profiles = learn(rows)
    assert profiles.languages == ("de", "en")
    got = rows.select("doc_id", "text", predicted(profiles).alias("p")).collect()
    assert sorted((r.doc_id, r.p.lang) for r in got) == [(1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "und"), (6, "en"), (7, "de"), (7, "en")]
    assert all(0 <= r.p.score <= 1 for r in got)
    assert sorted(r.doc_id for r in reject_unknown(rows, profiles).collect()) == [1, 2, 6, 7, 7]
    none = learn(rows.where("false"))
    assert none.languages == () and rows.select(predicted(none).alias("p")).where("p.lang <> 'und'").count() == 0


def test_vectors_of_many_letters_are_bounded(monkeypatch):
    text, sizes, vectors = " ".join(chr(0x4E00 + i) + chr(0x4E01 + i) for i in range(0, 6000, 2)), [], Space.trigrams

    def counted(self, letters, a, b, c):
        sizes.append(len(a) * self.dims)
        return vectors(self, letters, a, b, c)

    monkeypatch.setattr(Space, "trigrams", counted)
    got = Space(1024, 7).bundle([text], np.zeros(1, np.int64), 1)
    assert max(sizes) <= CELLS < sum(sizes)
    codes, _, letters = _trigram_codes([text])
    n, space = len(letters), Space(1024, 7)
    monkeypatch.setattr(Space, "trigrams", vectors)
    assert (got[0] == sum(space.trigrams(letters, some // n // n, some // n % n, some % n).sum(0) for some in np.array_split(codes, 8))).all()


def test_profiles_do_not_depend_on_partitions(spark):
    rows = spark.createDataFrame([(prose(k, 50), "a" if k % 3 else "b") for k in range(60)], "text string, lang string")
    assert (learn(rows.repartition(1)).vectors == learn(rows.repartition(7)).vectors).all()
