"""SentencePiece encoding and decoding by lattices of distinct words.

A text is marked (blanks become ``MARK``, one is put in front) and split in front of every run of marks, which
no piece crosses. The substrings of a word meet the piece table by equality, those that match are the edges of its lattice, and a fold
over them finds the path. For unigram models it keeps the best path to every position: Viterbi. Models of merges (BPE) are not
defined by the best sum of scores, and Viterbi gives other pieces than they do; for them the fold joins the two
neighbouring pieces whose union has the highest score, over and over. A character without a piece becomes its
bytes; in Viterbi it costs ten more than the worst piece.

``encode_words`` is the lattice as tables (explode, join, group, ``aggregate``) for both folds. With merges, texts are encoded where they are
read: tasks hold the lattices of the distinct words of a batch as arrays (``piece_lattice``), so neither words nor texts move. With
Viterbi, each distinct word is encoded once, and words find their documents again in groups of documents.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridyield.llm.common import shuffle_partitions, small, text_bytes, written
from gridyield.llm.piece_lattice import PieceLattice

MARK = "▁"
UNKNOWN_COST = 10.0
KEPT_WORDS = 500_000  # kept words of a worker, about 200 bytes each; the older half makes room for new ones
BY_MARKS = re.compile(f"{MARK}|  |^ | $")  # texts that need the split by marks; others are split at their blanks
SPLIT = re.compile(f"(?<=[^{MARK}])(?={MARK})")
NO_ID = -(2**63)
_encoders: dict[str, "WordEncoder"] = {}


def pieces_of(model: str) -> tuple[list[tuple[str, int, float]], int]:
    """(piece, id, score) of the pieces that stand for text, and the id of byte 0."""
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=model)
    rows, byte_zero = [], None
    for i in range(own.get_piece_size()):
        if own.is_byte(i):
            byte_zero = i if byte_zero is None else byte_zero
        elif not (own.is_control(i) or own.is_unknown(i) or own.is_unused(i)):
            rows.append((own.id_to_piece(i), i, own.get_score(i)))
    if byte_zero is None:
        raise ValueError("the model has no byte pieces")
    return rows, byte_zero


def piece_table(spark: SparkSession, model: str) -> tuple[DataFrame, float, int]:
    """(piece, id, score) of the pieces that stand for text, the score of an unknown character, and the id of byte 0.

    Its size is that of the vocabulary, whatever the number of documents.
    """
    import pandas as pd

    rows, byte_zero = pieces_of(model)
    frame = spark.createDataFrame(pd.DataFrame(rows, columns=["piece", "id", "score"]), "piece string, id int, score double")
    return frame, min(r[2] for r in rows) - UNKNOWN_COST, byte_zero


def marked_words(text: Column) -> Column:
    """Words of a text, each with the marks in front of it; none for a null or empty text."""
    marked = F.concat(F.lit(MARK), F.regexp_replace(text, " ", MARK))
    words = F.split(marked, f"(?<=[^{MARK}])(?={MARK})")
    return F.when(F.length(text) > 0, words).otherwise(F.array().cast("array<string>"))


VITERBI = """aggregate(
  reverse(aggregate(edges,
    named_struct('score', transform(sequence(0, n), i -> if(i = 0, 0D, cast('-Infinity' as double))),
                 'last', transform(sequence(0, n), i -> named_struct('s', 0, 'ids', cast(array() as array<int>)))),
    (a, x) -> if(a.score[x.s] + x.score > a.score[x.e],
      named_struct('score', transform(a.score, (v, i) -> if(i = x.e, a.score[x.s] + x.score, v)),
                   'last', transform(a.last, (v, i) -> if(i = x.e, named_struct('s', x.s, 'ids', x.ids), v))), a),
    a -> transform(a.last, (v, i) -> named_struct('e', i, 's', v.s, 'ids', v.ids)))),
  named_struct('at', n, 'ids', cast(array() as array<int>)),
  (a, x) -> if(a.at = x.e and x.e > 0, named_struct('at', x.s, 'ids', concat(x.ids, a.ids)), a), a -> a.ids)"""
# The state is the ascending list of borders; a union of two neighbours is an edge with one border inside.
MERGES = """aggregate(if(n > 1, sequence(1, n - 1), cast(array() as array<int>)),
  named_struct('open', true, 'at', sequence(0, n)),
  (a, i) -> if(not a.open, a, transform(
    array(filter(unions, x -> array_position(a.at, x.s) > 0 and array_position(a.at, x.e) = array_position(a.at, x.s) + 2)),
    found -> if(size(found) = 0, named_struct('open', false, 'at', a.at),
      named_struct('open', true, 'at', filter(a.at, p -> p <= found[0].s or p >= found[0].e))))[0]),
  a -> flatten(transform(sequence(1, size(a.at) - 1), i -> filter(edges, x -> x.s = a.at[i - 1] and x.e = a.at[i])[0].ids)))"""
FOLDS = {"viterbi": VITERBI, "merges": MERGES}


def encode_words(words: DataFrame, pieces: DataFrame, unknown: float, byte_zero: int, longest: int, fold: str) -> DataFrame:
    """word, ids for distinct words.

    Fold ``viterbi``: the path with the highest sum of scores, of equal ones the one met first by start. Fold ``merges``: the
    highest score first, of equal ones the leftmost.
    """
    spans = F.expr(
        f"flatten(transform(sequence(1, length(word)), s -> transform(sequence(1, least({longest}, length(word) - s + 1)), "
        "l -> named_struct('s', s - 1, 'e', s + l - 1, 'piece', substring(word, s, l)))))"
    )
    parts = words.select("word", F.explode(spans).alias("p")).select("word", "p.s", "p.e", "p.piece")
    # The table of pieces has the size of a vocabulary.
    met = parts.join(F.broadcast(pieces), "piece", "left").where("id is not null or e - s = 1")
    as_bytes = F.expr(f"transform(sequence(1, cast(length(hex(piece)) / 2 as int)), i -> cast(conv(substring(hex(piece), 2 * i - 1, 2), 16, 10) as int) + {byte_zero})")
    edge = F.struct("s", "e", F.coalesce("score", F.lit(unknown)).alias("score"), F.when(F.col("id").isNull(), as_bytes).otherwise(F.array("id")).alias("ids"))
    edges = met.groupBy("word").agg(F.sort_array(F.collect_list(edge)).alias("edges"))
    edges = edges.withColumn("n", F.length("word"))
    if fold == "merges":
        order = "(x, y) -> case when x.score > y.score or x.score = y.score and x.s < y.s then -1 else 1 end"
        edges = edges.withColumn("unions", F.expr(f"array_sort(filter(edges, x -> x.e - x.s > 1), {order})"))
    return edges.select("word", F.expr(FOLDS[fold]).alias("ids"))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        packed = [squeeze.compress(text_bytes(t)) for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=["g", "id", "packed"])


class WordEncoder:
    """ids(texts): the piece ids of each text as bytes, with each distinct word folded once as long as it is kept."""

    def __init__(self, model: str):
        self.lattice = PieceLattice(*pieces_of(model))
        self.known: dict[str, bytes] = {}  # words without their first mark

    @staticmethod
    def words(text: str) -> list[str]:
        if not text:
            return []
        if not BY_MARKS.search(text):
            return text.split(" ")
        return [w[1:] for w in SPLIT.split(MARK + text.replace(" ", MARK))]

    def ids(self, texts: list[str]) -> list[bytes]:
        split, known = [self.words(t) for t in texts], self.known
        new = list({w for words in split for w in words if w not in known})
        known.update(zip(new, self.lattice.encode([MARK + w for w in new])))
        out = [b"".join([known[w] for w in words]) for words in split]
        if len(known) > KEPT_WORDS:
            self.known = dict(islice(known.items(), len(known) - KEPT_WORDS // 2, None))
        return out


def _by_merges(model: str):
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("text_crc32", pa.int64())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model not in _encoders:
            _encoders[model] = WordEncoder(model)
        for batch in small(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            raw = _encoders[model].ids(texts)
            borders = np.concatenate([[0], np.cumsum([len(r) // 4 for r in raw])]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(borders), pa.array(np.frombuffer(b"".join(raw), "<i4")))
            sums = pa.array([zlib.crc32(text_bytes(t)) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), ids, sums], schema=schema)

    return rows


def encode(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text", fold: str = "merges", longest: int = 16) -> DataFrame:
    """doc_id, ids, text_crc32: the piece ids of every text, one row per row; no ids for null and empty texts.

    ``fold`` goes with the type of the model: ``merges`` or ``viterbi``. With ``merges`` nothing is shuffled; a word takes memory of 64
    bytes a character while it is folded. With ``viterbi``, ``longest`` is the length of the longest piece in characters. Documents are then
    dealt into groups by a hash of id and text; each group receives its own distinct words with their ids, so no task holds the whole vocabulary.
    """
    if fold == "merges":
        rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
        return rows.mapInArrow(_by_merges(model), "doc_id bigint, ids array<int>, text_crc32 bigint")
    spark = docs.sparkSession
    pieces, unknown, byte_zero = piece_table(spark, model)
    groups = shuffle_partitions(spark)
    key = F.coalesce(F.col(doc_id).cast("bigint"), F.lit(NO_ID))
    keyed = docs.select(F.pmod(F.xxhash64(key, F.col(text)), F.lit(groups)).cast("int").alias("g"), key.alias("id"), F.col(text).alias("text"))
    used = written(keyed.select("g", F.explode(marked_words(F.col("text"))).alias("word")).distinct(), "words-of-groups")
    words = used.select("word").distinct()
    known = written(encode_words(words, pieces, unknown, byte_zero, longest, fold), "word-pieces")
    wanted = used.join(known, "word").select("g", "word", "ids")
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("text_crc32", pa.int64())])

    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        lists = right.column("ids").combine_chunks()
        if isinstance(lists, pa.ChunkedArray):
            lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], pa.list_(pa.int32()))
        flat, border = lists.flatten().to_numpy(zero_copy_only=False).astype("<i4"), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
        raw = flat.tobytes()
        ids_of = {w: raw[4 * a:4 * b] for w, a, b in zip(right.column("word").to_pylist(), border[:-1].tolist(), border[1:].tolist())}
        open_ = zstandard.ZstdDecompressor()
        names, ids, sums = [], [], []
        for name, packed in zip(left.column("id").to_pylist(), left.column("packed").to_pylist()):
            body = open_.decompress(packed)
            words = SPLIT.split(MARK + body.decode("utf-8", "surrogatepass").replace(" ", MARK)) if body else []
            names.append(None if name == NO_ID else name)
            ids.append(np.frombuffer(b"".join([ids_of[w] for w in words]), "<i4"))
            sums.append(zlib.crc32(body))
        return pa.table([pa.array(c, t) for c, t in zip((names, ids, sums), schema.types)], schema=schema)

    packed = keyed.mapInArrow(_packed, "g int, id bigint, packed binary")
    return packed.groupBy("g").cogroup(wanted.groupBy("g")).applyInArrow(join, "doc_id bigint, ids array<int>, text_crc32 bigint")


def decoded(ids: Column, model: str) -> Column:
    """The text of piece ids: the bytes of all pieces in a row, marks as blanks, without the blank in front."""
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=model)
    size = own.get_piece_size()
    # Byte pieces are named <0x00> to <0xFF>; other pieces stand for their own bytes.
    names = [own.id_to_piece(i)[3:5] if own.is_byte(i) else own.id_to_piece(i).encode().hex() for i in range(size)]
    table = F.split(F.lit(",".join(names)), ",")
    whole = F.array_join(F.transform(ids, lambda i: F.element_at(table, i + 1)), "")
    return F.substring(F.regexp_replace(F.decode(F.unhex(whole), "UTF-8"), MARK, " "), 2, 2**31 - 1)
