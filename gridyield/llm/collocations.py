"""Phrases whose words stand together more often than apart, per language.

Texts are read three times. First words are counted; a word gets as its id the shortest prefix of a 64-bit hash that keeps
all frequent words apart from every other word, which is verified on all words. Then pairs of frequent words, then
phrases of three and more words all of whose pairs are frequent. Phrases are counted in counting quotient filters (``quotient_filter``), one per
shard and part, and the sorted filters of a part are merged.

What is frequent reaches the tasks as a bitmap of bounded size. A bit too many costs time and changes no count, since the
merged counts decide.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridyield.llm.common import written
from gridyield.llm.quotient_filter import counted, merged, pack, parts_of, permuted, restored
from gridyield.llm.shingles import BYTE, LOWER, STEP, mix, powers, span_hash

LEAST = 30
WORDS = 4
CHUNK = 8 << 20  # bytes of text that are counted together
PART = 500_000  # words of a language to one part
BITMAP = 1 << 29  # most bits of a bitmap
ID_BITS = (40, 48, 56, 64)
BUCKET_BITS = 8 * 4096  # of Spark's bitmaps
END = np.zeros(256, bool)
END[list(b".,;:!?\n\x0b\x0c\r")] = True
BLANK = np.zeros(256, bool)
BLANK[[9, 32]] = True
CUT = re.compile(rb"[ \t.,;:!?\n\x0b\x0c\r]")
WORD = re.compile(rb"[ \t]*[^ \t.,;:!?\n\x0b\x0c\r]*")


# Words of texts


def _stretches(text: bytes, chunk: int, words: int) -> Iterator[tuple[bytes, int]]:
    """(bytes, own): a long text in stretches, cut between words; phrases that start in the first ``own`` bytes of a stretch are its own."""
    a = 0
    while len(text) - a > chunk and (cut := CUT.search(text, a + chunk)):
        b = over = cut.start()
        for _ in range(words):  # the words that a phrase may reach beyond the cut
            over = WORD.match(text, over).end()
        yield text[a:over], b - a
        a = b
    yield text[a:], len(text) - a


def _chunks(batches: Iterator[pa.RecordBatch], chunk: int, words: int) -> Iterator[tuple]:
    """(languages with their salts, language, data, start, end, own, piece): the words of about ``chunk`` bytes of text at a time."""
    held: list[tuple[tuple[str, int], bytes, int]] = []
    size = 0

    def flush():
        names = sorted({lang for lang, _, _ in held})
        number = {lang: k for k, lang in enumerate(names)}
        data = LOWER[np.frombuffer(b"\n".join(t for _, t, _ in held) + b"\n", np.uint8)]
        ends = np.cumsum([len(t) + 1 for _, t, _ in held])
        stop = END[data]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], ~(stop | BLANK[data]), [False]]).astype(np.int8)))
        start, end = edge[::2], edge[1::2]
        of = np.searchsorted(ends, start, "right")
        begins = ends - np.array([len(t) + 1 for _, t, _ in held])
        own = start < (begins + np.array([n for _, _, n in held]))[of]
        return names, np.array([number[lang] for lang, _, _ in held])[of], data, start, end, own, np.cumsum(stop, dtype=np.int32)[start]

    for batch in batches:
        for lang, salt, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary())):
            text = text.as_py()
            if not text:
                continue
            for stretch in _stretches(text, chunk, words):
                held.append(((lang, salt), *stretch))
                size += len(stretch[0]) + 1
                if size >= chunk:
                    yield flush()
                    held, size = [], 0
    if held:
        yield flush()


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int, together: int = 1 << 16) -> np.ndarray:
    """64-bit hashes of the words, some at a time because the sums take many bytes for each byte of text."""
    random, out = mix(BYTE + np.uint64(seed)), np.empty(len(start), np.uint64)
    for a in range(0, len(start), together):
        first, last = start[a:a + together], end[a:a + together]
        some = data[first[0]:last[-1]]
        forward, _ = powers(len(some) + 1)
        sums = np.zeros(len(some) + 1, np.uint64)
        np.cumsum(random[some] * forward[:-1], out=sums[1:])
        out[a:a + together] = mix(span_hash(sums, first - first[0], last - first[0]) + (last - first).astype(np.uint64) * STEP)
    return out


def _words(seed: int, chunk: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names, lang, data, start, end, own, _ in _chunks(batches, chunk, 0):
            value = _hashes(data, start, end, seed)
            raw = data.tobytes()
            for k, (name, _) in enumerate(names):
                mine = np.flatnonzero((lang == k) & own)
                ids, at, n = np.unique(value[mine], return_index=True, return_counts=True)
                words = [raw[a:b] for a, b in zip(start[mine[at]].tolist(), end[mine[at]].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(ids), pa.string()), pa.array(ids.view(np.int64)), pa.array(words, pa.binary()).cast(pa.string()), pa.array(n)],
                    names=["lang", "id", "word", "f"],
                )

    return count


# Bitmaps of what is frequent


def _spots(ids: np.ndarray, salt: int, size: int) -> np.ndarray:
    """Bits of n-grams (rows of ids) of one language in a bitmap of ``size`` bits, a power of two."""
    x = np.full(ids.shape[1], salt & (2**64 - 1), np.uint64)
    for row in ids:
        x = mix(x * STEP + row)
    return (x & np.uint64(size - 1)).astype(np.int64)


def _bitmap(spark: SparkSession, frequent: DataFrame, n: int, most: int) -> tuple[Broadcast, int]:
    """A bitmap of the n-grams in ``frequent`` (salt, ids) with 16 bits for each, up to ``most`` bits."""
    size = max(BUCKET_BITS, min(most, 1 << max(16 * n, 1).bit_length()))

    def spots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            salt = batch.column(0).to_numpy()
            flat = batch.column(1).flatten().to_numpy().view(np.uint64).reshape(len(salt), -1).T if len(salt) else np.zeros((1, 0), np.uint64)
            x = salt.view(np.uint64).copy()
            for row in flat:
                x = mix(x * STEP + row)
            yield pa.RecordBatch.from_arrays([pa.array((x & np.uint64(size - 1)).astype(np.int64))], names=["spot"])

    found = frequent.mapInArrow(spots, "spot bigint")
    rows = found.groupBy(F.floor(F.col("spot") / BUCKET_BITS).alias("bucket")).agg(F.bitmap_construct_agg(F.col("spot") % BUCKET_BITS).alias("bits")).collect()
    bits = np.zeros(size // 8, np.uint8)
    for row in rows:  # at most ``most`` bits in all
        bits[row["bucket"] * BUCKET_BITS // 8:][:BUCKET_BITS // 8] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return spark.sparkContext.broadcast(bits), size


def _set(bits: np.ndarray, spots: np.ndarray) -> np.ndarray:
    return (bits[spots >> 3] >> (spots & 7).astype(np.uint8)) & 1 == 1


# Counting


def _filters(sizes: tuple[int, ...], seed: int, bits: int, words: tuple[Broadcast, int], pairs: tuple[Broadcast, int] | None, part_bits: int, chunk: int):
    """lang, n, part, filter: phrases of ``sizes`` words in which all words, and all pairs if given, are frequent."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("lang", pa.string()), ("n", pa.int32()), ("part", pa.int64()), ("filter", pa.binary())])
        longest = max(sizes)
        for names, lang, data, start, end, own, piece in _chunks(batches, chunk, longest):
            value = _hashes(data, start, end, seed) >> np.uint64(64 - bits)
            out: list[tuple] = []
            for k, (name, salt) in enumerate(names):
                mine = np.flatnonzero(lang == k)
                ids, at, first = value[mine], piece[mine], own[mine]
                known = _set(words[0].value, _spots(ids[None], salt, words[1]))
                # good[i]: words i and i + 1 stand in one piece and may be a frequent pair.
                good = known[:-1] & known[1:] & (at[:-1] == at[1:])
                if pairs and len(good):
                    where = np.flatnonzero(good)
                    good[where] = _set(pairs[0].value, _spots(np.stack([ids[where], ids[where + 1]]), salt, pairs[1]))
                for n in sizes:
                    if len(ids) < n:
                        continue
                    begins = first[:len(ids) - n + 1].copy()
                    for j in range(n - 1):
                        begins &= good[j:j + len(begins)]
                    where = np.flatnonzero(begins)
                    if not len(where):
                        continue
                    keys, counts = counted(permuted(np.stack([ids[where + j] for j in range(n)]), bits))
                    part = parts_of(keys, bits, part_bits)
                    border = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
                    for a, b in zip(border.tolist(), [*border[1:].tolist(), len(part)]):
                        out.append((name, n, int(part[a]), pack(keys[:, a:b], counts[a:b], bits, part_bits)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    return count


def _merge(bits: int, least: int):
    def merge(table: pa.Table) -> pa.Table:
        n, lang = table.column("n")[0].as_py(), table.column("lang")[0].as_py()
        keys, counts = merged(table.column("filter").to_pylist(), table.column("part")[0].as_py())
        keep = counts >= least
        ids = restored(keys[:, keep], bits).T
        m = len(ids)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(m + 1, dtype=np.int32) * n), pa.array(np.ascontiguousarray(ids).reshape(-1).view(np.int64)))
        return pa.table({"lang": pa.array([lang] * m, pa.string()), "ids": lists, "f": pa.array(counts[keep])})

    return merge


def _exact(x: Column | str) -> Column:
    return (F.col(x) if isinstance(x, str) else x).cast("decimal(20,0)")


def _apart(words: DataFrame, bits: int, least: int) -> bool:
    """Whether no frequent word shares the first ``bits`` bits of its hash with another word of its language."""
    prefix = F.shiftrightunsigned("id", 64 - bits) if bits < 64 else F.col("id")
    shared = words.groupBy("lang", prefix.alias("prefix")).agg(F.count(F.lit(1)).alias("words"), F.max("f").alias("f"))
    return shared.where((F.col("words") > 1) & (F.col("f") >= least)).isEmpty()


def counted_phrases(
    docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, longest: int = WORDS, chunk: int = CHUNK, part: int = PART, bitmap: int = BITMAP
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(totals, words, phrases): lang, n; lang, id, word, f of frequent words; lang, ids, f of frequent phrases of 1 to ``longest`` words."""
    spark = docs.sparkSession
    name = F.coalesce(F.col(lang), F.lit("und"))
    texts = docs.select(name.alias("lang"), F.xxhash64(name).alias("salt"), F.col(text).alias("body"))
    for seed in range(1, 6):
        each = texts.mapInArrow(_words(seed, chunk), "lang string, id bigint, word string, f bigint")
        each = each.groupBy("lang", "id", "word").agg(F.sum("f").alias("f"))
        all_words = written(each, "words")
        bits = next((b for b in ID_BITS if _apart(all_words, b, least)), None)
        if bits:
            break
    else:
        raise RuntimeError("five hashes in a row give two words one number")
    totals = written(all_words.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    short = F.shiftrightunsigned("id", 64 - bits) if bits < 64 else F.col("id")
    words = written(all_words.where(F.col("f") >= least).withColumn("id", short), "frequent-words")
    total = totals.agg(F.sum("n")).first()[0] or 0
    part_bits = min(max(-(-total // part) - 1, 0).bit_length(), 30)

    def bits_of(frequent: DataFrame) -> tuple[Broadcast, int]:
        return _bitmap(spark, frequent.select(F.xxhash64("lang").alias("salt"), "ids"), frequent.count(), bitmap)

    def phrases_of(sizes: tuple[int, ...], pairs: tuple[Broadcast, int] | None) -> DataFrame:
        found = texts.mapInArrow(_filters(sizes, seed, bits, known, pairs, part_bits, chunk), "lang string, n int, part bigint, filter binary")
        return written(found.groupBy("lang", "n", "part").applyInArrow(_merge(bits, least), "lang string, ids array<bigint>, f bigint"), "phrases")

    single = words.select("lang", F.array("id").alias("ids"), "f")
    if longest < 2:
        return totals, words, single
    known = bits_of(single)
    phrases = phrases_of((2,), None)
    out = single.unionByName(phrases)
    if longest > 2:
        out = out.unionByName(phrases_of(tuple(range(3, longest + 1)), bits_of(phrases)))
    return totals, words, out


def collocations(
    docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, longest: int = WORDS, top: int = 2000, share: int = 80,
    chunk: int = CHUNK, part: int = PART, bitmap: int = BITMAP,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of 2 to ``longest`` words of each language.

    A-Z count as a-z. Pieces end at ``.,;:!?`` and line ends, words at blanks and tabs; phrases do not cross pieces. a is the number of
    places of the phrase (``least`` at least, overlaps included), l and r those of its two parts at the cut with the lowest score
    floor(2000000 a / (l + r)), of equal ones the first; n is the number of words of the language. A phrase within a longer one of at least ``share``
    percent of its places is left out. Order: score, a, then the phrase by its bytes. A null language is ``und``; null and
    empty texts have no words; every row counts, also repeated ones. Other columns are not read, whatever their names.
    """
    totals, words, phrases = counted_phrases(docs, lang, text, least, longest, chunk, part, bitmap)
    some = phrases.where(F.size("ids") > 1).select("lang", "ids", F.col("f").alias("a"))
    cuts = some.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)))
    cuts = cuts.select("lang", "ids", "a", "k", F.slice("ids", F.lit(1), F.col("k")).alias("head"), F.slice("ids", F.col("k") + 1, F.size("ids") - F.col("k")).alias("tail"))
    cuts = cuts.join(phrases.select("lang", F.col("ids").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cuts = cuts.join(phrases.select("lang", F.col("ids").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
    # Decimals hold the product, and the quotient is below 2000000.
    cuts = cuts.withColumn("score", F.expr("(cast(a as decimal(20,0)) * 2000000) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))").cast("bigint"))
    scored = cuts.groupBy("lang", "ids", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    longer = some.where(F.size("ids") > 2).withColumn("m", F.explode(F.sequence(F.lit(2), F.size("ids") - 1)))
    longer = longer.withColumn("at", F.explode(F.sequence(F.lit(1), F.size("ids") - F.col("m") + 1)))
    longer = longer.groupBy("lang", F.slice("ids", F.col("at"), F.col("m")).alias("ids")).agg(F.max("a").alias("longer"))
    kept = scored.join(longer, ["lang", "ids"], "left")
    kept = kept.where(F.col("longer").isNull() | (_exact("longer") * 100 < _exact("a") * share)).select("lang", "ids", "a", "cut.*")

    # Ties at the end of the list are told apart by the words, so all of them are spelled.
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    near = written(kept.withColumn("place", F.rank().over(order)).where(F.col("place") <= top), "best-phrases")
    letters = near.select("lang", "ids", F.posexplode("ids").alias("at", "id")).join(words.select("lang", "id", "word"), ["lang", "id"])
    spelled = letters.groupBy("lang", "ids").agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("parts"))
    spelled = spelled.select("lang", "ids", F.concat_ws(" ", F.transform("parts", lambda p: p["word"])).alias("phrase"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    out = near.join(spelled, ["lang", "ids"]).withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= top)
    return out.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
