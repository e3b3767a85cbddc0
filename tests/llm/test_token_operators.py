"""Token files, packing and SentencePiece against the libraries, and the pipeline."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gridyield.llm import piece_lattice, sentence_pieces, token_files, tokens
from gridyield.llm.packing import encode_pieces, pack_pieces, plan_bins
from gridyield.llm.piece_lattice import PieceLattice
from gridyield.llm.sentence_pieces import decoded, encode, encode_words, piece_table, pieces_of
from gridyield.llm.token_files import TokenFile, id_bits, pack, read_tokens, unpack, write_tokens
from test_text_operators import frame, prose

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = [(3, None), (1, ""), (2, "Hello  world"), (9, "x" * 5000), (4, " lead and trail "), (5, "日本 \n \t<|endoftext|> é🙂"), (9, "again"), (9, "again"), (None, "no id"), (8, prose(8, 3000))]
PARTS = [" ", "  ", "\n", "\t", "a", "é", "ñ", "1", "!", "'s", "\xa0", "​", "\x1c", "\x85", "日", "🙂", "́", " b", "c, ", "d. ", "<|endoftext|>", "\r\n", "﻿", "　"]


@given(st.lists(st.sampled_from(PARTS), max_size=12).map("".join) | st.text(max_size=40))
@settings(max_examples=400, deadline=None)
def test_ids_equal_the_library(text):
    own = tokens.encoder(BYTES)
    assert own.ids([text])[0].tolist() == own.whole.encode(text, add_special_tokens=False).ids


@given(st.lists(st.text(st.sampled_from(" \nabzÀéßøŁɏɐ×÷µªʼ'!~.*:@[_{1٣½日\t\x85"), max_size=9), max_size=9).map(" ".join))
@settings(max_examples=800, deadline=None)
def test_runs_that_are_pieces_for_certain(text):
    own = tokens.encoder(BYTES)
    own.known.clear()
    assert own.ids([text])[0].tolist() == own.whole.encode(text, add_special_tokens=False).ids


def test_plain_runs_need_no_search_for_pieces(monkeypatch):
    own, text, asked = tokens.Encoder(BYTES), "x Größe, naïve.\nThe end*** 1995: 3,5 " + prose(4, 300), []
    monkeypatch.setattr(own, "_encode_parts", lambda parts: asked.extend(parts) or {})
    assert own.ids([text])[0].tolist() == own.whole.encode(text, add_special_tokens=False).ids and asked == []


def test_words_that_find_no_room_are_encoded_all_the_same(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_WORDS", 3)
    own = tokens.Encoder(BYTES)
    text = prose(1, 200)
    assert own.ids([text, None, text])[2].tolist() == own.whole.encode(text, add_special_tokens=False).ids


def test_other_tokenizers_are_used_whole():
    own = tokens.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert own.ids(["Some Words, here"])[0].tolist() == own.whole.encode("Some Words, here", add_special_tokens=False).ids


@given(st.integers(1, 32), st.integers(0, 300), st.integers(0, 2**32))
@settings(max_examples=80, deadline=None)
def test_packing_of_bits(bits, n, seed):
    ids = np.random.default_rng(seed).integers(0, 2**bits, n).astype("<u4")
    raw = pack(ids, bits)
    assert len(raw) == -(-n * bits // 8) and unpack(raw, bits, n).tolist() == ids.tolist()


def test_fewest_bits():
    assert [id_bits(n) for n in (1, 2, 3, 256, 257, 50257)] == [1, 1, 2, 8, 9, 16]


@pytest.mark.parametrize("bits", [16, 17])
def test_files_are_read_from_any_place(folder, bits, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK", 64)
    parts = [np.random.default_rng(k).integers(0, 50000, k * 37 % 200).astype("<u4") for k in range(30)]
    with open(f"{folder}/a.tok", "wb") as out:
        out.write(token_files.file_bytes([None, *range(1, 30)], parts, bits))
    file, whole = TokenFile(f"{folder}/a.tok"), np.concatenate(parts)
    assert file.doc_ids[:3] == [None, 1, 2] and file.n_ids == len(whole)
    assert all(file.doc(k).tolist() == p.tolist() for k, p in enumerate(parts))
    assert all(file.ids(a, b).tolist() == whole[a:b].tolist() for a, b in ((0, 0), (5, 70), (64, 128), (100, len(whole))))
    assert [ids.tolist() for _, ids in file.runs(100)] == [p.tolist() for p in parts]


def test_token_files_round_trip(spark, monkeypatch):
    whole = Tokenizer.from_file(BYTES)
    docs = frame(spark, ODD)
    got = read_tokens(write_tokens(docs, BYTES, end_id=2)).collect()
    rows = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, 1, 2, 3, 4, 5, 8, 9, 9, 9]
    at = 0
    for row in rows:
        assert (row.start, row.n_tokens) == (at, len(row.ids))
        at += row.n_tokens
    expected = sorted([*whole.encode(t or "", add_special_tokens=False).ids, 2] for _, t in ODD)
    assert sorted(r.ids for r in rows) == expected
    sums = {(r.start, r.ids_crc32) for r in read_tokens(write_tokens(docs, BYTES, end_id=2), digest=True).collect()}
    assert len(sums & {(r.start, zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in rows}) >= 8  # equal doc_ids may change places
    assert read_tokens(write_tokens(frame(spark, []), BYTES, end_id=2)).collect() == []


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=30))
@settings(max_examples=150, deadline=None)
def test_plan_holds_every_piece_once(counts):
    plan = plan_bins(counts, 64)
    seen: dict[int, int] = {}
    for times, members in plan:
        assert times > 0 and sum(members) <= 64
        for n in members:
            seen[n] = seen.get(n, 0) + times
    assert seen == counts
    # Two neighbouring bins of the plan are never both half empty, so at most twice the fewest possible.
    total = sum(n * c for n, c in counts.items())
    assert sum(t for t, _ in plan) <= 2 * -(-total // 64) + 1


def test_smallest_piece_makes_room_for_two():
    assert plan_bins({60: 1, 30: 1, 39: 1, 1: 1}, 100)[0] == (1, [60, 39, 1])
    assert plan_bins({60: 1, 35: 1, 22: 1, 18: 1}, 100)[0] == (1, [60, 22, 18])


def test_packed_pieces(spark):
    whole, end = Tokenizer.from_file(BYTES), 0
    rows = ODD + [(100 + k, prose(k, 5 + k % 7)) for k in range(300)] + [(500 + k, "same text") for k in range(200)]
    got = pack_pieces(encode_pieces(frame(spark, rows), BYTES, 64, end_id=end, with_ids=True), 64).collect()
    texts: dict = {}
    sequences: dict = {}
    for r in sorted(got, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.piece)):
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and (r.piece == 0 or r.length == 64)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        texts.setdefault(r.doc_id, []).append(r.ids)
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    expected: dict = {}
    for i, t in rows:
        expected.setdefault(i, []).append([*whole.encode(t or "", add_special_tokens=False).ids, end])
    assert sum(map(len, texts[8]), 0) == len(expected[8][0]) and [x for p in texts[8] for x in p] == expected[8][0]
    total = sum(len(x) for many in expected.values() for x in many)
    assert sum(r.length for r in got) == total and len(sequences) <= 1.05 * total / 64 + 1
    assert pack_pieces(encode_pieces(frame(spark, []), BYTES, 64, end_id=0), 64).collect() == []


# SentencePiece


def unigram() -> sentencepiece.SentencePieceProcessor:
    """The same pieces and scores as a unigram model: the type in the file's trainer settings is 1 instead of 2."""
    with open(PIECES, "rb") as file:
        raw = file.read()
    at = raw.rfind(b"\x18\x02 \x80\xfa\x01") + 1
    return sentencepiece.SentencePieceProcessor(model_proto=raw[:at] + b"\x01" + raw[at + 1:])


def test_pieces_equal_the_library_and_come_back(spark):
    own = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = encode(frame(spark, [*ODD, (20, "Größe  ça  naïve"), (21, "a ▁b")]), PIECES)
    got = rows.select("doc_id", "ids", decoded(rows.ids, PIECES).alias("text")).collect()
    texts = [(i, t or "") for i, t in [*ODD, (20, "Größe  ça  naïve"), (21, "a ▁b")]]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r.doc_id, r.ids) for r in got), key=key) == sorted(((i, own.encode(t)) for i, t in texts), key=key)
    assert sorted(r.text or "" for r in got) == sorted(t.replace("▁", " ") for _, t in texts)
    assert encode(frame(spark, []), PIECES).collect() == []


def test_merges_need_no_shuffle_and_no_library(spark, plan, monkeypatch):
    own, draw = sentencepiece.SentencePieceProcessor(model_file=PIECES), random.Random(5)
    texts = ["a" * 3000, "ab" * 500, "".join(draw.choices("0123456789+/ABCabc", k=2000)), "的一是不了人我在有他" * 80, "line\nbreak\n" * 40, "x  y ", "▁▁ é🙂\x00", *(prose(k, 40) for k in range(20))]
    docs = frame(spark, list(enumerate(texts)))
    rows = encode(docs, PIECES)
    assert "Exchange" not in plan(rows) and {r.doc_id: r.ids for r in rows.collect()} == {i: own.encode(t) for i, t in enumerate(texts)}
    lattice, words = PieceLattice(*pieces_of(PIECES)), ["▁" + w for t in texts for w in t.split(" ")]
    whole = lattice.encode(words)
    for long in (1, 100_000):  # the heap and the common fold give the same
        monkeypatch.setattr(piece_lattice, "LONG", long)
        assert lattice.encode(words) == whole
    table, unknown, zero = piece_table(spark, PIECES)
    short = sorted({w for w in words if len(w) <= 20})
    folded = encode_words(spark.createDataFrame([(w,) for w in short], "word string"), table, unknown, zero, 16, "merges").collect()
    assert {r.word: r.ids for r in folded} == {w: np.frombuffer(b, "<i4").tolist() for w, b in zip(short, lattice.encode(short))}


def test_words_that_are_let_go_are_folded_again(monkeypatch):
    monkeypatch.setattr(sentence_pieces, "KEPT_WORDS", 4)
    own, words = sentencepiece.SentencePieceProcessor(model_file=PIECES), sentence_pieces.WordEncoder(PIECES)
    for text in (prose(1, 50), prose(2, 50), prose(1, 50), ""):
        assert np.frombuffer(words.ids([text])[0], "<i4").tolist() == own.encode(text)
        assert len(words.known) <= 4


def test_viterbi_finds_the_best_sum(spark):
    own, pieces, (table, unknown, zero) = unigram(), {}, piece_table(spark, PIECES)
    pieces = {r.id: r.score for r in table.collect()}
    draw = random.Random(3)
    words = sorted({"▁" + "".join(draw.choices("aeinorst", k=draw.randint(1, 14))) for _ in range(300)})
    got = encode_words(spark.createDataFrame([(w,) for w in words], "word string"), table, unknown, zero, 16, "viterbi").collect()
    assert len(got) == len(words)
    for r in got:
        assert own.decode(r.ids) == r.word[1:]
        assert sum(pieces[i] for i in r.ids) == sum(pieces[i] for i in own.encode(r.word[1:]))


# Pipeline


def test_stages(spark, folder):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    shared, base = prose(77, 100), [prose(k, 120) for k in range(6)]
    rows = [(k, f"the cat and the dog of the house {t}", "en") for k, t in enumerate(base)]
    rows += [(10, rows[0][1] + " more", "en"), (11, rows[1][1], "en"), (20, prose(20, 30) + " " + shared, "en"), (21, prose(21, 30) + " " + shared, "en"), (30, None, "en"), (31, "12 345", None)]
    spark.createDataFrame([(i, t, g, "s", len(t or "")) for i, t, g in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{folder}/documents.parquet")
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == corpus_pipeline.COLUMNS
        kept.append({r.doc_id: r for r in docs.collect()})
    assert set(kept[0]) == {*range(6), 10, 11, 20, 21} and set(kept[1]) == {*range(6), 20, 21} == set(kept[2])
    assert kept[2][0].text == rows[0][1] and kept[2][0].n_chars == len(rows[0][1])
    assert shared not in kept[2][20].text and kept[2][20].text.startswith(prose(20, 30)) and kept[2][20].n_chars == len(kept[2][20].text)
    out = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in out} == set(kept[2]) and all(r.offset + r.length <= 2048 for r in out)


def test_stages_hold_few_texts_at_a_time(spark, folder):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        for asked, used in (("10000", "1000"), ("0", "1000"), ("300", "300")):
            spark.conf.set(key, asked)
            docs = spark.range(2500).selectExpr("id AS doc_id", "'a word' AS text", "'en' AS lang", "'s' AS source", "6L AS n_chars").coalesce(1)
            kept = corpus_pipeline.language(spark, docs, folder)
            assert kept.count() == 2500 and spark.conf.get(key) == used
            sizes = kept.mapInArrow(lambda batches: (b.select(["doc_id"]).slice(0, 1).set_column(0, "doc_id", pa.array([len(b)])) for b in batches), "doc_id bigint")
            assert max(r.doc_id for r in sizes.collect()) <= int(used)
    finally:
        spark.conf.set(key, before)


def test_near_duplicates_are_judged_by_row(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    a, b, c, d, e = (prose(k, 60) for k in range(200, 205))
    rows = [(1, a), (5, a), (5, b), (5, b), (7, b), (8, c), (None, c), (None, d), (None, d), (None, d + " more"), (9, e), (9, e + " more"), (10, " "), (10, " "), (None, " "), (11, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs.repartition(5), "").collect()]
    kept = [(i, t) for i, t in got if i not in (9, None)]
    assert sorted(map(str, kept)) == sorted(map(str, [(1, a), (5, b), (8, c), (10, " "), (11, None)]))
    assert len(got) == 8 and sum(i == 9 for i, _ in got) == 1
    assert sorted(t[:len(d)] for i, t in got if i is None) == sorted([" ", d])


def test_marked_words_are_split_in_front_of_blanks():
    assert re.split("(?<=[^▁])(?=▁)", "▁a▁▁b▁") == ["▁a", "▁▁b", "▁"]
