"""Hard negatives, repeated word windows and collocations against brute force, with the odd cases of their inputs."""

from __future__ import annotations

import hashlib
import os
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
from gridyield.llm import collocations as phrases_module
from gridyield.llm.collocations import collocations
from gridyield.llm.cover_tree import asked, bounds, build, distances, dot, leaf_bounds, lifted
from gridyield.llm.hard_negatives import hard_negatives, search
from gridyield.llm.quotient_filter import counted, merged, pack, parts_of, permuted, restored, unpack
from gridyield.llm.superkmer import least_ids, plain, removed_windows, super_kmers

SMALL = "/root/testdata/sf0.001"


# Hard negatives


def brute_negatives(rows, every=100, positives=5, negatives=10, low=30, high=90, scale=256):
    good = [r for r in rows if None not in r[:3] and all(x is not None and np.isfinite(x) for x in r[2])]
    values = {r: [int(np.floor(float(x) * scale)) for x in r[2]] for r in good}
    out = []
    for anchor in sorted({r[0] for r in good if r[0] % every == 0}):
        me = min((r for r in good if r[0] == anchor), key=lambda r: (str(r[1]), values[r]))

        def best(same):
            found = {}
            for r in good:
                if r[0] != anchor and (str(r[1]) == str(me[1])) == same and len(r[2]) == len(me[2]):
                    score = sum(a * b for a, b in zip(values[me], values[r]))
                    found[r[0]] = max(found.get(r[0], score), score)
            return sorted(((-s, i) for i, s in found.items()))

        others = []
        for r in good:
            if r[0] != anchor and str(r[1]) != str(me[1]) and len(r[2]) == len(me[2]):
                others.append((sum(a * b for a, b in zip(values[me], values[r])), r[0]))
        for p, positive in best(True)[:positives]:
            inside = {}
            for s, i in others:
                if low * -p <= 100 * s <= high * -p:
                    inside[i] = max(inside.get(i, s), s)
            for rank, (s, i) in enumerate(sorted(((-s, i) for i, s in inside.items()))[:negatives], 1):
                out.append((anchor, positive, rank, i, -p, -s))
    return sorted(out)


def vectors(seed=3, n=260, dims=6):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(4, dims))
    rows = [(i, int(draw.integers(0, 3)), tuple(float(x) for x in centres[i % 4] + 0.4 * draw.normal(size=dims))) for i in range(n)]
    rows += [(300, 1, rows[7][2]), (301, 2, rows[7][2]), (302, 1, rows[7][2]), (400, 1, rows[8][2])]  # ties
    rows += [(500, 0, (0.0,) * dims), (600, None, rows[0][2]), (601, 1, None), (602, 1, (None,) * dims), (603, 2, (float("nan"),) * dims), (604, 1, (float("inf"),) * dims)]
    rows += [(700, 1, (1.0, 2.0)), (701, 1, (2.0, 2.0)), (702, 2, (1.0, 1.0)), (None, 1, rows[0][2]), (800, 2, ()), rows[5], rows[5], (9, 1, rows[10][2])]
    return rows


@pytest.mark.parametrize(("cell", "block", "most_asked"), [(8192, 16384, 512), (20, 16, 1)])
def test_hard_negatives_equal_brute_force(spark, cell, block, most_asked):
    rows = vectors()
    table = spark.createDataFrame([(i, g, None if v is None else list(v), "x", 1) for i, g, v in rows], "vec_id bigint, label int, embedding array<double>, cell string, low int")
    got = hard_negatives(table, every=20, cell=cell, block=block, most_asked=most_asked).collect()
    assert sorted(map(tuple, got)) == brute_negatives(rows, every=20) and len(got) > 100
    assert hard_negatives(table.limit(0)).count() == 0
    assert hard_negatives(table.where("vec_id = 100")).count() == 0


def test_bounds_hold_and_leaves_are_skipped():
    draw = np.random.default_rng(1)
    values = np.concatenate([draw.normal(size=(400, 3)) * 3 + c for c in ((60, 0, 0), (0, 60, 0), (0, 0, 60))]).round() * 1.0
    queries = draw.normal(size=(10, 3)).round(2) * 50
    norm = float(np.sqrt((values**2).sum(1).max()))
    points, length = asked(queries, norm)
    tree = build(lifted(values, norm), leaf=16)
    true = queries @ values.T
    for centres, radius, begin, end in tree.levels:
        low, high = bounds(points, length, centres, radius, norm)
        for k in range(len(begin)):
            rows = tree.order[tree.border[begin[k]]:tree.border[end[k]]]
            assert (true[:, rows] >= low[:, k:k + 1] - 1e-6).all() and (true[:, rows] <= high[:, k:k + 1] + 1e-6).all()
            assert (distances(lifted(values[rows], norm), centres[k:k + 1]) <= radius[k] + 1e-6).all()
    assert sorted(tree.order) == list(range(len(values)))
    _, open_ = leaf_bounds(tree, points, length, norm, np.full(10, true.max() * 0.95), np.full(10, np.inf))
    assert open_.mean() < 0.5


def test_products_beyond_doubles_are_exact():
    a = np.array([[2**30, 1]], np.int64)
    assert dot(a, a)[0, 0] == 2**60 + 1
    with pytest.raises(OverflowError):
        dot(a * 4, a * 4)
    found = list(search(a.repeat(3, 0), np.arange(3), np.array(["b"] * 3), a, np.array([9]), np.array(["a"]), [np.array([0])], [np.array([2**61])], 2, False))
    assert [(q, w, i.tolist(), s.tolist()) for q, w, i, s in found] == [(0, 0, [0, 1], [2**60 + 1] * 2)]


# Repeated windows


def brute_windows(rows, window=13):
    words = [(i, (t or "").split() if not re.search(r"[\x1c-\x1f\x85\xa0]", t or "") else re.findall(r"[^ \t-\r]+", t)) for i, t in rows]
    order = lambda i: float("inf") if i is None else i
    first = {}
    for i, w in words:
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            first[key] = min(first.get(key, float("inf")), order(i))
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k:k + window])] < order(i):
                gone.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=str)


def texts_with_repeats(seed: int):
    draw = random.Random(seed)
    prose = lambda n: " ".join(draw.choice("ab cd ef gh ij kl mn op qr st uv wx yz é ü".split()) + str(draw.randrange(60)) for _ in range(n))
    shared = [prose(n) for n in (13, 14, 30, 60)]
    rows = [(k, "\n".join(draw.choice(shared) if draw.random() < 0.4 else prose(25) for _ in range(6))) for k in range(40)]
    line = "the same line of nine words in every text"
    rows += [(100 + k, f"{line} {prose(1)}\t{line}  {prose(2)} {line}") for k in range(30)]
    return rows + [(60, None), (61, ""), (62, "a b"), (63, rows[3][1]), (None, rows[4][1]), (None, "x y\x1cz " * 14), rows[5], (5, prose(40)), (64, "w " * 500)]


@pytest.mark.parametrize("most", [20_000, 3])
def test_removed_windows_equal_brute_force(spark, most):
    rows = texts_with_repeats(most)
    table = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id bigint, text string, bucket string, id int")
    got = removed_windows(table, most=most).collect()
    assert sorted(map(tuple, got), key=str) == brute_windows(rows)
    assert removed_windows(table.limit(0)).count() == 0


def test_each_window_is_in_one_super_kmer(monkeypatch):
    from gridyield.llm import superkmer

    texts = [plain((t or "").encode()) for _, t in texts_with_repeats(1)]
    whole = {}
    for together, words in ((1 << 21, 1 << 18), (400, 17)):
        monkeypatch.setattr(superkmer, "TOGETHER", together)
        monkeypatch.setattr(superkmer, "WORDS", words)
        found = {}
        for i, text, first, n, bucket, a, b in super_kmers(texts):
            split = text.split(b" ")
            for s, m, name, x, y in zip(first.tolist(), n.tolist(), bucket.tolist(), a.tolist(), b.tolist()):
                assert text[x:y] == b" ".join(split[s:s + m + 12])
                for k in range(m):
                    assert (i, s + k) not in found
                    found[i, s + k] = name
        assert len(found) == sum(max(len(t.split()) - 12, 0) for t in texts)
        whole = whole or found
        assert found == whole  # the bucket is the window's own


def test_least_ids():
    got = least_ids([b"a b c d", b"b c d", b"x b c"], np.array([5, 3, 4]), window=2)
    assert [g.tolist() for g in got] == [[5, 3, 3], [3, 3], [4, 3]]


def test_a_long_text_of_windows(spark):
    text = " ".join(f"w{k % 7001}" for k in range(400_000))
    table = spark.createDataFrame([(1, text), (2, "start " + text[:100_000].rsplit(" ", 1)[0])], "doc_id bigint, text string")
    got = {r.doc_id: r for r in removed_windows(table).collect()}
    assert got[1].n_removed == 0 and got[2].kept == "start"


# Quotient filters and collocations


@pytest.mark.parametrize("bits", [40, 56, 64])
def test_filters_give_everything_back(bits):
    draw = np.random.default_rng(bits)
    for n in (2, 3, 4):
        ids = draw.integers(0, 2**bits, (n, 3000), dtype=np.uint64)
        ids[:, 1000:] = ids[:, draw.integers(0, 5, 2000)]
        assert (restored(permuted(ids, bits), bits) == ids).all()
        keys, counts = counted(permuted(ids, bits))
        assert Counter(map(tuple, ids.T.tolist())) == dict(zip(map(tuple, restored(keys, bits).T.tolist()), counts.tolist()))
        for part_bits in (0, 4):
            part = parts_of(keys, bits, part_bits)
            for p in np.unique(part):
                mine = part == p
                raw = pack(keys[:, mine], counts[mine], bits, part_bits)
                again, n_again = unpack(raw, int(p))
                assert (again == keys[:, mine]).all() and (n_again == counts[mine]).all()
                both, n_both = merged([raw, raw, raw], int(p))
                assert (both == again).all() and (n_both == 3 * n_again).all()


def brute_collocations(rows, least, top, share=80, longest=4):
    f, n = {}, Counter()
    for lang, text in rows:
        lang = lang or "und"
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall(r"[^ \t]+", piece)
            n[lang] += len(words)
            for m in range(1, longest + 1):
                for k in range(len(words) - m + 1):
                    key = (lang, *words[k:k + m])
                    f[key] = f.get(key, 0) + 1
    some = {k: a for k, a in f.items() if len(k) > 2 and a >= least}
    out = []
    for lang in n:
        scored = []
        for key, a in some.items():
            if key[0] != lang:
                continue
            words = key[1:]
            cuts = [(2_000_000 * a // (f[(lang, *words[:k])] + f[(lang, *words[k:])]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            inside = any(
                o[0] == lang and len(o) > len(key) and 100 * b >= share * a and any(o[j:j + len(words)] == words for j in range(1, len(o) - len(words) + 1))
                for o, b in some.items()
            )
            if not inside:
                scored.append((-score, -a, " ".join(words).encode(), f[(lang, *words[:k])], f[(lang, *words[k:])]))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def speech(seed: int):
    draw = random.Random(seed)
    words = [f"w{k}" for k in range(25)] + ["Über", "ÉTÉ", "x-y", "a b"]
    fixed = ["New York City", "in the end of it", "as well as"]
    rows = []
    for k in range(120):
        parts = [draw.choice(fixed) if draw.random() < 0.3 else draw.choice(words) for _ in range(draw.randrange(1, 40))]
        rows.append((draw.choice(["en", "en", "de", None]), draw.choice([" ", "  ", "\t", ", ", ".\n"]).join(parts)))
    return rows + [("en", None), ("en", ""), ("xx", "one two"), (None, ";;; ,"), ("en", "go " * 300), rows[0], rows[0]]


@pytest.mark.parametrize(("chunk", "part", "bitmap", "top"), [(8 << 20, 500_000, 1 << 29, 2000), (97, 50, 1 << 15, 7)])
def test_collocations_equal_brute_force(spark, chunk, part, bitmap, top):
    rows = speech(chunk)
    table = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "lang string, text string, ids int, word string")
    got = collocations(table, least=6, top=top, chunk=chunk, part=part, bitmap=bitmap).collect()
    assert sorted(map(tuple, got)) == brute_collocations(rows, 6, top) and len(got) > 10
    assert collocations(table.limit(0)).count() == 0


def test_longer_ids_where_hashes_meet(spark, monkeypatch):
    monkeypatch.setattr(phrases_module, "ID_BITS", (8, 12, 40))
    rows = speech(5)
    table = spark.createDataFrame(rows, "lang string, text string")
    assert sorted(map(tuple, collocations(table, least=6).collect())) == brute_collocations(rows, 6, 2000)


# The registered queries


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="driver tables are not here")
@pytest.mark.parametrize("name", ["op11_hard_negatives", "op12_superkmer_dedup", "op13_collocations"])
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    want = con.execute(entry.oracle_sql()[name])
    names = [c[0] for c in want.description]
    got = entry.queries()[name](spark, SMALL).select(names)
    assert Counter(map(tuple, got.collect())) == Counter(want.fetchall())


# Classes of equal vectors


def test_very_many_equal_vectors_are_one_class(spark):
    from pyspark.sql import functions as F

    from gridyield.llm.embedding_dedup import linked_vectors

    same = spark.range(20_000).select(F.col("id").alias("vec_id"), F.array(*[F.lit(float(k)) for k in range(1, 9)]).alias("embedding"), F.lit("text label").alias("label"))
    near = spark.createDataFrame([(50_000, [1.01, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0], "text label"), (50_001, [-1.0] * 8, "text label"), (50_002, [1.0] * 4, "a"), (50_003, [1.0] * 4, "a"),
                                  (50_004, [float(k) for k in range(1, 9)], "1.2"), (50_005, [float(k) for k in range(1, 9)], "1.7")], same.schema)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in linked_vectors(same.unionByName(near)).collect()}
    assert len(got) == 20_006 and {got[k] for k in range(1, 20_000)} == {(20_000, 0, False)} and got[0] == (20_000, 0, True)
    assert got[50_000] == (20_000, 0, False) and got[50_001] == (0, 50_001, True)
    assert got[50_002] == (1, 50_002, True) and got[50_003] == (1, 50_002, False)
    assert got[50_004] == (0, 50_004, True) and got[50_005] == (0, 50_005, True)


# Languages, letter by letter


def test_language_profiles_equal_plain_sums(spark):
    import zlib

    rows = duckdb.sql(f"select doc_id, text, lang from '{SMALL}/documents.parquet'").fetchall()
    base = {}

    def vector(letter):
        if letter not in base:
            base[letter] = np.random.Generator(np.random.Philox(key=[7, ord(letter)])).integers(0, 2, 1024, dtype=np.int8).astype(int) * 2 - 1
        return base[letter]

    def bundle(text):
        counts, total = Counter(), np.zeros(1024)
        padded = "".join(c if c.isalpha() else " " for c in f" {(text or '').lower()} ")
        counts.update(padded[k - 1:k + 2] for k in range(1, len(padded) - 1) if padded[k] != " ")
        for (a, b, c), n in counts.items():
            total += n * np.roll(vector(a), 2) * np.roll(vector(b), 1) * vector(c)
        return total

    each = {i: bundle(t) for i, t, _ in rows}
    held_out = {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in each}
    profiles = {}
    for i, text, lang in rows:
        if lang is not None and not held_out[i]:
            profiles[lang] = profiles.get(lang, 0) + each[i]
    names = sorted(profiles)
    unit = np.array([profiles[n] / np.linalg.norm(profiles[n]) for n in names])
    for r in entry.queries()["op7_language_id"](spark, SMALL).collect():
        assert r.held_out == held_out[r.doc_id]
        length = np.linalg.norm(each[r.doc_id])
        if not length:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        cosines = unit @ each[r.doc_id] / length
        assert abs(r.score - np.clip(cosines.max(), 0, 1)) < 1e-5 and cosines[names.index(r.lang_pred)] > cosines.max() - 1e-5
