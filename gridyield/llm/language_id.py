"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. The vector of a letter
trigram is the product of the three letter vectors, the first shifted by two places and the second
by one. A text is the sum of its trigram vectors, a language the sum of its texts; a text gets the
language with the largest cosine. Sums of counts are whole numbers, so the profiles do not depend on
how the rows are dealt out.

Words are runs of letters, lower-cased, with a blank on both sides; a trigram has a letter in its
middle. A run of more than ``SLICE`` letters counts as several words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridyield.llm.common import small

UNKNOWN = "und"
SLICE = 1 << 19  # characters that are counted at a time
ROWS = 500  # texts in work at a time
CELLS = 1 << 21  # largest table of counts, texts times trigrams, and of vectors, trigrams times dimensions
BLANK = 32
_letters: np.ndarray | None = None


def letter_table() -> np.ndarray:
    """For each code point whether it is a letter."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


class Space:
    """Letter vectors of one seed."""

    def __init__(self, dims: int, seed: int):
        self.dims, self.seed, self.known = dims, seed, {}

    def letter(self, code: int) -> np.ndarray:
        if code not in self.known:
            draw = np.random.Generator(np.random.Philox(key=[self.seed, code]))
            self.known[code] = draw.integers(0, 2, self.dims, dtype=np.int8) * 2 - 1
        return self.known[code]

    def trigrams(self, letters: np.ndarray, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Vectors of the trigrams (letters[a], letters[b], letters[c])."""
        base = np.array([self.letter(int(x)) for x in letters])
        return (np.roll(base, 2, 1)[a] * np.roll(base, 1, 1)[b] * base[c]).astype(np.float32)

    def bundle(self, texts: list[str], owners: np.ndarray, n: int) -> np.ndarray:
        """Sum of trigram vectors for each of ``n`` owners; text i belongs to owners[i]."""
        out = np.zeros((n, self.dims))
        for start, part in _groups(texts):
            codes, of, letters = _trigram_codes(part)
            if not len(codes):
                continue
            size = len(letters)
            if size ** 3 <= CELLS:
                used = np.flatnonzero(np.bincount(codes, minlength=size ** 3))
                place = np.zeros(size ** 3, np.int64)
                place[used] = np.arange(len(used))
                which = place[codes]
            else:
                used, which = np.unique(codes, return_inverse=True)
            who, row = np.unique(owners[start:start + len(part)][of], return_inverse=True)
            step = max(1, CELLS // max(len(who), self.dims))  # vectors are a table too, with a column per dimension
            for k in range(0, len(used), step):
                some = used[k:k + step]
                inside = (which >= k) & (which < k + step)
                counts = np.bincount(row[inside] * len(some) + which[inside] - k, minlength=len(who) * len(some))
                vectors = self.trigrams(letters, some // size // size, some // size % size, some % size)
                out[who] += counts.reshape(len(who), len(some)).astype(np.float32) @ vectors
        return out


def _groups(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Runs of neighbouring texts of about SLICE characters together."""
    start, chars = 0, 0
    for i, text in enumerate(texts):
        if i > start and (chars + len(text) > SLICE or i - start >= 512):
            yield start, texts[start:i]
            start, chars = i, 0
        chars += len(text)
    if start < len(texts):
        yield start, texts[start:]


def _trigram_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code of each trigram in base len(letters), the text it is from, and the letters."""
    lower = [f" {t.lower()} " for t in texts]
    codes = np.frombuffer("".join(lower).encode("utf-32-le", "surrogatepass"), "<u4")
    is_letter = letter_table()[codes]
    codes = np.where(is_letter, codes, BLANK)
    of = np.repeat(np.arange(len(lower)), [len(t) for t in lower])
    middle = np.flatnonzero(is_letter[1:-1]) + 1  # a text starts and ends with a blank, so it has both neighbours
    letters = np.flatnonzero(np.bincount(codes))
    place = np.zeros(int(letters[-1]) + 1, np.int64)
    place[letters] = np.arange(len(letters))
    short = place[codes]
    size = len(letters)
    return (short[middle - 1] * size + short[middle]) * size + short[middle + 1], of[middle], letters


def slices(text: str) -> list[str]:
    """The text in pieces of about SLICE characters, cut where no letter stands."""
    out, start, table = [], 0, letter_table()
    while len(text) - start > 2 * SLICE:
        end = start + SLICE
        while end < start + 2 * SLICE and table[ord(text[end])]:
            end += 1
        out.append(text[start:end])
        start = end
    out.append(text[start:])
    return out


def bundle_texts(space: Space, texts: list[str | None], owners: np.ndarray, n: int) -> np.ndarray:
    """As ``Space.bundle``, for texts of any length, null texts included."""
    parts, of = [], []
    for text, owner in zip(texts, owners):
        for part in slices(text or ""):
            parts.append(part)
            of.append(owner)
    return space.bundle(parts, np.asarray(of, np.int64), n)


@dataclass(frozen=True)
class Profiles:
    """Language names in ascending order and their unit vectors."""

    languages: tuple[str, ...]
    vectors: np.ndarray
    seed: int


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", dims: int = 1024, seed: int = 7) -> Profiles:
    """Profiles of all languages of ``docs`` from all rows; rows with a null language or text teach nothing.

    Each task sends one vector per language; they are summed in Spark, and the driver receives
    languages x dims numbers, whatever the number of rows. Neither empty tables nor texts without a letter
    are an error: a language without a letter has no profile.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, names, total = Space(dims, seed), {}, np.zeros((0, dims))
        for batch in small(batches, ROWS):
            owners = np.array([names.setdefault(name, len(names)) for name in batch.column(1).to_pylist()], np.int64)
            if len(names) > len(total):
                total = np.vstack([total, np.zeros((len(names) - len(total), dims))])
            total += bundle_texts(space, batch.column(0).to_pylist(), owners, len(names))
        if names:
            vectors = pa.array(list(np.rint(total).astype(np.int64)), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(list(names), pa.string()), vectors], names=["lang", "v"])

    some = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    parts = some.select(F.col(text).alias("text"), F.col(lang).alias("lang")).mapInArrow(sums, "lang string, v array<bigint>")
    rows = (
        parts.select("lang", F.posexplode("v").alias("i", "x"))
        .groupBy("lang", "i").agg(F.sum("x").alias("x"))
        .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("v"))
        .select("lang", F.col("v.x").alias("v")).collect()
    )
    found = {r["lang"]: np.array(r["v"], np.float64) for r in rows}
    names = tuple(sorted(k for k, v in found.items() if v.any()))
    vectors = np.array([found[k] / np.linalg.norm(found[k]) for k in names]).reshape(len(names), dims)
    return Profiles(names, vectors, seed)


def predicted(profiles: Profiles, text: str = "text") -> Column:
    """struct<lang string, score double> of a text column; ``score`` is the cosine, cut at 0.

    ``und`` and 0 for null texts, texts without a letter, and where no language was learned. Of equal cosines
    the language that sorts first wins.
    """
    languages, vectors, seed = profiles.languages, profiles.vectors, profiles.seed

    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        space = Space(vectors.shape[1], seed)
        for batch in batches:
            names, scores = np.full(len(batch), UNKNOWN, object), np.zeros(len(batch))
            for k in range(0, len(batch) if languages else 0, ROWS):
                texts = batch.iloc[k:k + ROWS].tolist()
                sums = bundle_texts(space, texts, np.arange(len(texts)), len(texts))
                length = np.linalg.norm(sums, axis=1)
                cosine = sums @ vectors.T / np.where(length > 0, length, 1.0)[:, None]
                best = cosine.argmax(1)
                names[k:k + ROWS] = np.where(length > 0, np.array(languages, object)[best], UNKNOWN)
                scores[k:k + ROWS] = np.where(length > 0, np.clip(cosine[np.arange(len(best)), best], 0.0, 1.0), 0.0)
            yield pd.DataFrame({"lang": names, "score": scores})

    from pyspark.sql.pandas.functions import pandas_udf

    typed: type = Iterator[pd.Series]
    predict.__annotations__ = {"batches": typed, "return": Iterator[pd.DataFrame]}
    return pandas_udf(predict, "lang string, score double")(F.col(text))


def bucket(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 4; bucket 2 is held out. A null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4


def reject_unknown(docs: DataFrame, profiles: Profiles, text: str = "text", least: float = 0.0) -> DataFrame:
    """The rows whose text has a language with at least the given cosine; all columns stay as they are."""
    name = "_language"
    while name in docs.columns:
        name += "_"
    judged = docs.withColumn(name, predicted(profiles, text))
    return judged.where((F.col(name)["lang"] != UNKNOWN) & (F.col(name)["score"] >= least)).drop(name)
