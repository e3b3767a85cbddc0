"""License notices in texts, exact and with a bounded number of edits.

A text is reduced to its lower-cased words with one blank between them. A notice that may differ in k
characters is cut into k + 1 pieces: whatever the edits, one piece stays as it is (pigeonhole). All pieces
of all notices are found in one pass of an automaton; only around them the ``regex`` library looks for the
notice with at most k errors. Phrases must stand exactly, so their one piece is the whole phrase.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: a word.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {65 + i: 97 + i for i in range(26)}
ROWS = 2000  # rows of a batch that is sent on


@dataclass(frozen=True)
class Notice:
    """Words with one blank between them, the label they give, the errors allowed, and whether it is a base phrase."""

    words: str
    label: str
    errors: int = 0
    base: bool = False


@dataclass(frozen=True)
class Found:
    notice: Notice
    start: int  # in the text of words
    end: int
    word: int  # number of the word it starts in
    errors: int

    @property
    def score(self) -> float:
        return 1.0 - self.errors / len(self.notice.words)


def pieces(words: str, errors: int) -> list[tuple[int, str]]:
    """(offset, piece): errors + 1 pieces of nearly equal length."""
    n = errors + 1
    borders = [len(words) * i // n for i in range(n + 1)]
    return [(a, words[a:b]) for a, b in zip(borders, borders[1:])]


class Scanner:
    def __init__(self, notices: list[Notice]):
        self.notices = notices
        self.automaton = ahocorasick.Automaton()
        seeds: dict[str, list[tuple[int, int]]] = {}
        for i, notice in enumerate(notices):
            for offset, piece in pieces(notice.words, notice.errors):
                if not piece:
                    raise ValueError(f"{notice.words!r} is too short for {notice.errors} errors")
                seeds.setdefault(piece, []).append((i, offset))
        for piece, users in seeds.items():
            self.automaton.add_word(piece, (len(piece), users))
        self.automaton.make_automaton()
        # (?e) improves a match where it stands; without errors a notice must be made of whole words.
        self.patterns = [
            regex.compile(rf"(?e)(?:{regex.escape(n.words)}){{e<={n.errors}}}") if n.errors else regex.compile(rf"(?<![^ ]){regex.escape(n.words)}(?![^ ])")
            for n in notices
        ]

    def scan(self, words: list[str]) -> list[Found]:
        """All notices in a word list: leftmost matches of each notice that do not overlap each other."""
        text = " ".join(words)
        windows: dict[int, list[list[int]]] = {}
        for last, (size, users) in self.automaton.iter(text):
            for i, offset in users:
                k, at = self.notices[i].errors, last - size + 1 - offset
                a, b = max(0, at - 2 * k - 1), at + len(self.notices[i].words) + 2 * k + 1
                of = windows.setdefault(i, [])
                if of and a <= of[-1][1]:
                    of[-1][1] = max(of[-1][1], b)
                    of[-1][0] = min(of[-1][0], a)
                else:
                    of.append([a, b])
        out = []
        starts = [0, *accumulate(len(w) + 1 for w in words)] if windows else []
        for i, spans in windows.items():
            for a, b in _joined(spans):
                for m in self.patterns[i].finditer(text, a, min(b, len(text))):
                    # A match that begins with a blank belongs to the word before it.
                    out.append(Found(self.notices[i], m.start(), m.end(), bisect_right(starts, m.start()) - 1, sum(m.fuzzy_counts)))
        return sorted(out, key=lambda f: (f.start, f.notice.words))


def _joined(spans: list[list[int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.translate(UPPER)) if text else []


SPANS = "array<struct<label: string, base: boolean, word: bigint, start: bigint, end: bigint, errors: int, matched: string>>"


def scan_licenses(docs: DataFrame, notices: list[Notice], doc_id: str = "doc_id", text: str = "text", spans: bool = True) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and, if asked for, spans: a row per row.

    Base columns cover base phrases at all their places; ``labels`` those and the notices. Labels are
    distinct, sorted, joined by commas, empty if nothing is found. ``score`` is the best share of right characters,
    0 if nothing is found. ``spans`` gives the place of each find in the words with blanks between them. Null and
    empty texts have no words. Whole texts are scanned, each on its own, without a shuffle.
    """
    span_type = pa.list_(pa.struct([
        ("label", pa.string()), ("base", pa.bool_()), ("word", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("errors", pa.int32()), ("matched", pa.string()),
    ]))
    fields = [
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
        ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
    ] + [("spans", span_type)] * spans
    schema = pa.schema(fields)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(notices)
        for whole in batches:
            for k in range(0, len(whole), ROWS):
                batch, rows = whole.slice(k, ROWS), []
                for name, body in zip(*(c.to_pylist() for c in batch.columns)):
                    words = words_of(body)
                    found = scanner.scan(words)
                    base = [f.word for f in found if f.notice.base]
                    row = [
                        name, len(words), len(base), min(base, default=None), max(base, default=None),
                        ",".join(sorted({f.notice.label for f in found if f.notice.base})), ",".join(sorted({f.notice.label for f in found})),
                        max((f.score for f in found), default=0.0),
                    ]
                    if spans:
                        joined = " ".join(words) if found else ""
                        row.append([
                            {"label": f.notice.label, "base": f.notice.base, "word": f.word, "start": f.start, "end": f.end, "errors": f.errors, "matched": joined[f.start:f.end]}
                            for f in found
                        ])
                    rows.append(row)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    kind = "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double"
    pairs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return pairs.mapInArrow(scan, kind + f", spans {SPANS}" * spans)
