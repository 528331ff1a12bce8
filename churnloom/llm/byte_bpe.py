"""Byte-level BPE: Spark higher-order functions fold the ranked merges of distinct words.

Words are split by the pattern with Spark. The corpus's frequent words (a bounded table) are folded once and
broadcast; any other word is folded with the document that holds it, once per document. Documents are then put
together from word results in Arrow batches, without moving rows between partitions.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import c, fresh, give_back, materialize, short_plans, small_batches

RANKS = "byte_bpe_50k.tiktoken"
#: The broadcast table of words and ids: its words, the bytes of a word, and the bytes of the whole.
TABLE_WORDS = 2**19
WORD_BYTES = 64
TABLE_BYTES = 96_000_000
#: Words that a worker holds, as numbers, between two searches of the table.
HELD_WORDS = 2_000_000
#: Rows of an Arrow batch: a row holds all words of a text.
BATCH_ROWS = 500
_NONE = 2**62
#: Places of the pair table that are tried at once.
_BLOCK = 2048
_SLICE = 200_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, lines))}


def java_pattern(pattern: str) -> str:
    """The pattern for Java's engine; the flag gives ``\\s`` and letters their Unicode meaning."""
    return "(?U)" + pattern


def words_of(text: Column, pattern: str = public_tokenizers.PATTERN) -> Column:
    """The matches of the pattern in a text, in order; none for a null text."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(java_pattern(pattern)), F.lit(0))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row."""
    return F.transform(F.array(value), use)[0]


def pack_pairs(ranks: dict[bytes, int], unit: int) -> tuple[list[int | None], list[int | None]]:
    """The ranked merges in one table: a pair of ids (a, b) can only stand at ``places[a] + b``, as a * unit + rank.

    The pairs of one left id keep their distances and move to the first place where all of them fit, largest groups
    first. What is left free or lies beyond either list is null: no boxed number, and no other id finds a pair.
    """
    most = max(ranks.values(), default=-1)
    rows: dict[int, dict[int, int]] = {}
    for piece, rank in ranks.items():
        for i in range(1, len(piece)):
            left, right = ranks.get(piece[:i]), ranks.get(piece[i:])
            if left is not None and right is not None:
                rows.setdefault(left, {})[right] = rank
    places, at, size = [None] * (most + 1), 0, 0
    table, free = np.empty(0, np.int64), np.ones(0, bool)
    for left, row in sorted(rows.items(), key=lambda x: -len(x[1])):
        rights = np.array(list(row))
        # Groups of about the same size hardly fit before the last one.
        at, size = at if len(row).bit_length() == size else 0, len(row).bit_length()
        while True:
            if at + most + 1 + _BLOCK > len(table):
                more = len(table) + most + 1 + _BLOCK
                table, free = np.append(table, np.zeros(more, np.int64)), np.append(free, np.ones(more, bool))
            fits = at + np.flatnonzero(free[at + rights[0] : at + rights[0] + _BLOCK])
            for right in rights[1:]:
                if not len(fits):
                    break
                fits = fits[free[fits + right]]
            if len(fits):
                break
            at += _BLOCK
        places[left] = int(fits[0])
        table[fits[0] + rights], free[fits[0] + rights] = left * unit + np.array(list(row.values())), False
    last = int(np.flatnonzero(~free).max(initial=-1)) + 1
    packed = table[:last].astype(object)
    packed[free[:last]] = None
    return places, packed.tolist()


def _rank(m: Column, unit: int, left: Column, right: Column) -> Column:
    """Rank of two joined pieces by their ids; ``unit`` if they are no piece or an id is null or unknown."""
    entry = F.get(m["table"], F.get(m["places"], left) + right)
    return F.least(entry.bitwiseXOR(left * unit), F.lit(unit))


def merge_bytes(word: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The pieces of one word by the definition; for small helpers and tests."""
    p = [word[i : i + 1] for i in range(len(word))]
    while len(p) > 1:
        rank, i = min((ranks.get(p[i] + p[i + 1], _NONE), i) for i in range(len(p) - 1))
        if rank == _NONE:
            break
        p[i : i + 2] = [p[i] + p[i + 1]]
    return p


def _fold(m: Column, unit: int, word: Column) -> Column:
    """Token ids of one word: merges the leftmost pair of lowest rank until no pair has a rank.

    A piece is one number: the rank of its pair with the next piece, its place in the word and its id. The least number
    is then the leftmost pair of lowest rank. One entry that merges with nothing stands before the first piece.
    """
    bits = unit.bit_length() - 1
    high = 62 - bits

    def number(rank: Column, rest: Column) -> Column:
        return F.shiftleft(rank, high) + rest

    def rest(piece: Column) -> Column:
        return piece.bitwiseAND(F.lit(2**high - 1))

    def id_of(piece: Column) -> Column:
        return piece.bitwiseAND(F.lit(unit - 1))

    def merge(p: Column) -> Column:
        least = F.array_min(p)

        def at(found: Column) -> Column:
            # ``x`` is the id of the joined piece; its neighbours' ranks are looked up again.
            i, x, before = found["i"], F.shiftright(found["x"], high), F.get(p, found["i"] - 2)
            place = rest(found["x"]).bitwiseAND(F.lit(-unit))
            left = number(_rank(m, unit, id_of(before), x), rest(before))
            joined = number(_rank(m, unit, x, id_of(F.get(p, i + 1))), place + x)
            return F.concat(F.slice(p, F.lit(1), i - 2), F.array(left, joined), F.slice(p, i + 2, F.size(p)))

        found = F.struct(F.array_position(p, least).cast("int").alias("i"), least.alias("x"))
        return F.when(least >= F.lit(unit << high), p).otherwise(_let(found, at))

    def start(ids: Column) -> Column:
        pieces = F.transform(ids, lambda x, i: number(_rank(m, unit, x, F.get(ids, i + 1)), (i + 1).cast("bigint") * unit + x))
        first = F.array(F.lit((unit << high) + unit - 1))
        rounds = F.sequence(F.lit(1), F.greatest(F.size(ids) - 1, F.lit(1)))
        return F.aggregate(rounds, F.concat(first, pieces), lambda p, _: merge(p), lambda p: F.transform(F.slice(p, F.lit(2), F.size(p)), id_of))

    # Each byte as one character, then as the id of the single byte.
    letters = F.split(F.decode(F.encode(word, "UTF-8"), "ISO-8859-1"), "")
    unknown = F.raise_error(F.lit("a byte has no rank"))
    return _let(F.transform(letters, lambda x: F.coalesce(m["single"][F.ascii(x)], unknown)), start)


class Merges:
    """The vocabulary as literals: one column that holds the pairs and the ids of single bytes, built once."""

    def __init__(self, ranks: dict[bytes, int]):
        # The last id below ``unit`` is no piece's.
        self.unit = 1 << (max(ranks.values(), default=-1) + 3).bit_length()
        places, table = pack_pairs(ranks, self.unit)
        lists = {"single": [ranks.get(bytes([i])) for i in range(256)], "places": places, "table": table}
        # from_json of a constant is folded into a literal by the optimizer.
        self.literals = F.array(F.struct(*[F.from_json(F.lit(json.dumps(x, separators=(",", ":"))), "array<bigint>").alias(k) for k, x in lists.items()]))
        # A piece that its own merges don't reach is one id all the same, where it is a word by itself.
        self.odd = {p.hex().upper(): rank for p, rank in ranks.items() if len(p) > 1 and merge_bytes(p, ranks) != [p]}

    def ids(self, m: Column, word: Column) -> Column:
        folded = _fold(m, self.unit, word)
        if not self.odd:
            return folded
        one = F.from_json(F.lit(json.dumps(self.odd)), "map<string,bigint>")[F.hex(F.encode(word, "UTF-8"))]
        return F.when(one.isNotNull(), F.array(one)).otherwise(folded)


def fold_words(words: Column, merges: Merges) -> Column:
    """Ids of each word of an array column."""
    # One reference to the literals keeps plans and tasks small.
    return F.flatten(F.transform(merges.literals, lambda m: F.transform(words, lambda w: merges.ids(m, w)))).cast("array<array<int>>")


def word_table(docs: DataFrame, text: str, merges: Merges, pattern: str, most: int = TABLE_WORDS) -> pa.Table:
    """The corpus's most frequent words with their ids: at most ``most`` words, and at most ``TABLE_BYTES`` with their ids.

    All words of all texts are counted. Words enter by classes of frequency, so that no sort is needed; a word of b
    bytes has at most b ids of four bytes.
    """
    words = docs.select(F.explode(words_of(c(text), pattern)).alias("word"))
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    size = F.octet_length("word")
    counts = materialize(counts.where(size <= WORD_BYTES).select("word", F.floor(F.log2("n") * 16).cast("int").alias("class")), "words")
    words_taken, bytes_taken, least = 0, 0, 2**31 - 1
    classes = counts.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.sum(5 * size + 8).alias("b")).collect()
    for row in sorted(classes, key=lambda r: -r["class"]):
        words_taken, bytes_taken = words_taken + row["n"], bytes_taken + row["b"]
        if words_taken > most or bytes_taken > TABLE_BYTES:
            break
        least = row["class"]
    chosen = counts.where(F.col("class") >= least)
    return chosen.select("word", fold_words(F.array("word"), merges)[0].alias("ids")).toArrow()


def _slices(offsets: np.ndarray, most: int = _SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``most`` elements each, or one row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def _expand(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions starts[i], starts[i] + 1, ... for each i, one after another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def _offsets(array: pa.ListArray) -> np.ndarray:
    return array.offsets.to_numpy().astype(np.int64)


def _binary(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


class Pieces:
    """Bytes of every id, for decoding."""

    def __init__(self, ranks: dict[bytes, int]):
        by_id = [b""] * (max(ranks.values(), default=-1) + 1)
        for piece, rank in ranks.items():
            by_id[rank] = piece
        self.size = np.array([len(x) for x in by_id], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(by_id), np.uint8)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pieces of ids joined, and where each id's piece ends."""
        sizes = self.size[ids]
        return self.data[_expand(self.start[ids], sizes)], np.cumsum(sizes)


def encode(
    docs: DataFrame,
    text: str = "text",
    outputs: tuple[str, ...] = ("n_tokens", "ids"),
    path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    table_words: int = TABLE_WORDS,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all if not given) and those of ``outputs``: ``n_tokens``, ``ids`` (array of int),
    ``packed`` (the ids as little-endian unsigned 32-bit integers) and ``decoded`` (the ids' pieces joined).

    Each match of ``pattern`` is encoded by itself with the ranks in ``path``; a word that is a piece is one id. Null
    and empty texts have no ids. Columns of ``docs`` with the name of an output are replaced, other columns and
    repeated rows stay. A column left out of ``keep`` is not passed through Python.
    """
    ranks = read_ranks(path or public_tokenizers.path(RANKS))
    spark: SparkSession = docs.sparkSession
    small_batches(spark, BATCH_ROWS)
    short_plans(spark)
    merges = Merges(ranks)
    table = word_table(docs, text, merges, pattern, table_words).combine_chunks()
    words = table["word"].combine_chunks() if len(table) else pa.array([], pa.string())
    ids = table["ids"].combine_chunks() if len(table) else pa.array([], pa.list_(pa.int32()))
    shared = spark.sparkContext.broadcast(words)
    lists = spark.sparkContext.broadcast((np.diff(_offsets(ids)).astype(np.int32), ids.flatten().to_numpy().astype(np.int32), Pieces(ranks)))
    # The table lives on in the broadcasts' files only.
    del table, words, ids
    give_back()

    taken = {x.lower() for x in outputs}
    kept = [x for x in (docs.columns if keep is None else keep) if x.lower() not in taken]
    w, rare = fresh(docs, "words"), fresh(docs, "rare")
    split = docs.select(*[c(x) for x in kept], words_of(c(text), pattern).alias(w))
    middle = T.StructType([*split.schema.fields[:-1], T.StructField(w, T.ArrayType(T.IntegerType())), T.StructField(rare, T.ArrayType(T.StringType()))])
    width = len(kept)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Words become places in the table, or -1 - k for the k-th of the row's other words."""
        held: list[tuple] = []
        count = 0

        def flush() -> Iterator[pa.RecordBatch]:
            # One search builds one hash table of the known words for many batches.
            found = pc.index_in(pa.concat_arrays([d for _, _, d, _ in held]), value_set=shared.value)
            found = pc.fill_null(found, -1).to_numpy().astype(np.int32)
            base = 0
            for columns, offsets, distinct, code in held:
                place = found[base : base + len(distinct)][code]
                base += len(distinct)
                missing = np.flatnonzero(place < 0)
                row = np.searchsorted(offsets, missing, side="right") - 1
                pairs, back = np.unique(row * (len(distinct) + 1) + code[missing], return_inverse=True)
                owner, word = np.divmod(pairs, len(distinct) + 1)
                first = np.searchsorted(owner, np.arange(len(offsets)))
                place[missing] = -1 - (back - first[row])
                lists = [
                    pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(place)),
                    pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), distinct.take(pa.array(word))),
                ]
                yield pa.RecordBatch.from_arrays([*columns, *lists], names=[f.name for f in middle.fields])
            held.clear()
            give_back()

        for batch in batches:
            column, rows = batch.column(width), pa.array(np.arange(batch.num_rows))
            coded = column.flatten().dictionary_encode()
            # Taking copies: a column of the batch would keep all its words in memory.
            own = [batch.column(k).take(rows) for k in range(width)]
            held.append((own, _offsets(column) - _offsets(column)[0], coded.dictionary, coded.indices.to_numpy().astype(np.int32)))
            count += len(coded)
            if count >= HELD_WORDS:
                yield from flush()
                count = 0
        if held:
            yield from flush()

    placed = split.mapInArrow(look_up, middle).withColumn(rare, fold_words(c(rare), merges))
    kinds = {"n_tokens": T.LongType(), "ids": T.ArrayType(T.IntegerType()), "packed": T.BinaryType(), "decoded": T.BinaryType()}
    final = T.StructType([*placed.schema.fields[:width], *[T.StructField(x, kinds[x]) for x in outputs]])

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, flat_ids, pieces = lists.value
        for batch in batches:
            for i, j in _slices(_offsets(batch.column(width))):
                rows = batch.slice(i, j - i)
                column, folded = rows.column(width), rows.column(width + 1)
                place, offsets = column.flatten().to_numpy(), _offsets(column) - _offsets(column)[0]
                others = folded.flatten()
                size = np.concatenate([sizes, np.diff(_offsets(others))])
                all_ids = np.concatenate([flat_ids, others.flatten().to_numpy().astype(np.int32)])
                row = np.repeat(np.arange(j - i), np.diff(offsets))
                base = len(sizes) + (_offsets(folded) - _offsets(folded)[0])[row]
                word = np.where(place < 0, base - 1 - place, place)
                count = size[word]
                got = all_ids[_expand((np.cumsum(size) - size)[word], count)]
                ends = np.concatenate([[0], np.cumsum(count)])[offsets[1:]]
                made = {"n_tokens": lambda: pa.array(np.diff(ends, prepend=0), pa.int64())}
                made["ids"] = lambda: pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(got))
                made["packed"] = lambda: _binary(got.astype("<u4").view(np.uint8), ends * 4)

                def decoded() -> pa.Array:
                    data, stops = pieces.decode(got)
                    return _binary(data, np.concatenate([[0], stops])[ends])

                made["decoded"] = decoded
                yield pa.RecordBatch.from_arrays(
                    [rows.column(k) for k in range(width)] + [made[x]() for x in outputs], names=[f.name for f in final.fields]
                )
        give_back()

    return placed.mapInArrow(assemble, final)
