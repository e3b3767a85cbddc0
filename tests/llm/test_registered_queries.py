"""The registered queries over the smallest driver tables, against brute force or held-out rows."""

from __future__ import annotations

import os
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

import __spark_entry__ as entry
from gridyield.llm.license_scan import Scanner, words_of
from gridyield.llm.queries_license import BASE, NOTICES
from test_text_operators import brute_components, brute_removed
from test_vector_and_url_operators import brute_links

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="driver tables are not here")


@pytest.fixture(scope="module")
def texts():
    return duckdb.sql(f"select doc_id, text, lang from '{SMALL}/documents.parquet'").fetchall()


@pytest.fixture(scope="module")
def ids(texts):
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = whole.encode_batch([t or "" for _, t, _ in texts], add_special_tokens=False)
    return {i: e.ids for (i, _, _), e in zip(texts, got)}


def rows(spark, name):
    return entry.queries()[name](spark, SMALL).collect()


def crc(values) -> int:
    return zlib.crc32(np.array(values, "<u4").tobytes())


def test_op1_and_op4(spark):
    table = duckdb.sql(f"select vec_id, embedding, label from '{SMALL}/embeddings.parquet'").fetchall()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in rows(spark, "op1_embedding_dedup")} == brute_links([(i, list(v), g) for i, v, g in table], 0.98)
    names, values = np.array([r[0] for r in table]), np.array([r[1] for r in table], float)
    found, right = rows(spark, "op4_nearest_neighbours"), 0
    for q in np.flatnonzero(names % 100 == 0):
        far = np.sqrt(((values - values[q]) ** 2).sum(1))
        far[q] = np.inf
        best = set(names[np.lexsort((names, far))[:10]].tolist())
        mine = [r for r in found if r.query_id == names[q]]
        assert len(mine) == 10 and all(abs(r.score - far[names == r.vec_id][0]) < 1e-12 for r in mine)
        right += len(best & {r.vec_id for r in mine})
    assert right >= 0.9 * len(found)


def test_op2(spark, texts):
    scanner, expected = Scanner(BASE + NOTICES), {}
    for i, text, _ in texts:
        words = words_of(text)
        places = [k for n in BASE for k in range(len(words)) if words[k:k + len(n.words.split())] == n.words.split()]
        body = " ".join(words)
        labels = {n.label for n, p in zip(scanner.notices, scanner.patterns) if p.search(body)}
        expected[i] = (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))
    assert {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.labels) for r in rows(spark, "op2_license_scan")} == expected


def test_op3(spark, texts):
    own = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = rows(spark, "op3_sentence_pieces")
    assert {r.doc_id: r.ids for r in got} == {i: own.encode(t or "") for i, t, _ in texts} and all(r.round_trip for r in got)


def test_op6(spark, texts):
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows(spark, "op6_ngram_join")} == brute_components([(i, t) for i, t, _ in texts])


def test_op7_on_held_out_rows(spark, texts):
    langs = {i: g for i, _, g in texts}
    got = rows(spark, "op7_language_id")
    assert len(got) == len(langs) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out and langs[r.doc_id]]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.95 * len(held) > 0


def test_op8(spark, texts, ids):
    at, expected = 0, {}
    for i in sorted(ids):
        expected[i] = (at, len(ids[i]) + 1, crc([*ids[i], 2]))
        at += len(ids[i]) + 1
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in rows(spark, "op8_token_files")} == expected


def test_op9(spark, ids):
    got = rows(spark, "op9_best_fit_packing")
    seen: dict = {}
    places: dict = {}
    for r in sorted(got, key=lambda r: (r.doc_id, r.piece)):
        whole = [*ids[r.doc_id], 0]
        assert r.piece == 0 or r.length == 2048
        assert r.start == seen.get(r.doc_id, 0) and crc(whole[r.start:r.start + r.length]) == r.ids_crc32
        seen[r.doc_id] = r.start + r.length
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert seen == {i: len(v) + 1 for i, v in ids.items()}
    for members in places.values():
        members.sort()
        assert [o for o, _ in members] == list(np.cumsum([0] + [n for _, n in members[:-1]])) and sum(n for _, n in members) <= 2048
    assert len(places) <= -(-sum(seen.values()) // 2048) + 1


def test_op10(spark, texts):
    got = [tuple(r)[:5] for r in rows(spark, "op10_suffix_dedup")]
    assert sorted(got, key=str) == brute_removed([(i, t) for i, t, _ in texts], 400)
