"""Benchmark decontamination by the q-gram lemma and banded alignment.

Benchmark items are cut into overlapping segments. A place of a text that holds a segment of m characters with at most
k edits shares at least m - q + 1 - k*q of its q-grams, on diagonals within k of each other. Shared q-grams are counted
in overlapping bands of diagonals; bands that reach the bound are verified by alignment inside the band.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import append_columns, c, fresh, small_batches

Q = 12
SEGMENT_CHARS = 120
STRIDE_CHARS = 60
EDIT_RATE = 0.06
#: Benchmark characters that are indexed and broadcast at a time, on average.
BLOCK_CHARS = 2_000_000
_SLICE_CHARS = 400_000
#: Pairs of a place and a segment with its q-gram that are held at a time.
_POSTINGS = 500_000
_PRUNE_EVERY = 8
_MULTIPLIERS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def normalise(text: str | None) -> str:
    """Lower case, with runs of white space as one space."""
    return " ".join((text or "").lower().split())


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def _grams(points: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the q-gram at each position, from one byte of every character; equal q-grams agree."""
    n = len(points) - Q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    narrow = np.ascontiguousarray((points ^ (points >> 8)).astype(np.uint8))
    eight = np.ndarray((n,), "<u8", narrow, 0, (1,))
    four = np.ndarray((n,), "<u4", narrow, 8, (1,))
    out = eight * _MULTIPLIERS[0]
    out ^= out >> np.uint64(31)
    out += four
    out *= _MULTIPLIERS[1]
    return out


@dataclass
class Index:
    """Distinct segments with their holders, length, edit budget and q-gram bound, and the places of each q-gram in them.

    A passage that stands in many items is one segment: ``items`` has the item of each standing, ``holders`` the
    standings of each segment.
    """

    items: list
    holders: list[list[int]]
    points: np.ndarray
    start: np.ndarray
    size: np.ndarray
    budget: np.ndarray
    bound: np.ndarray
    table: np.ndarray
    shift: int
    grams: np.ndarray
    first: np.ndarray
    segment: np.ndarray
    offset: np.ndarray


def build_index(items: list[tuple[int, str | None]], segment: int = SEGMENT_CHARS, stride: int = STRIDE_CHARS, rate: float = EDIT_RATE) -> Index:
    """Indexes items; those of under ``Q`` characters after ``normalise`` are too short to be told apart and are left out."""
    known: dict[bytes, int] = {}
    owners, holders, parts = [], [], []
    for item, text in items:
        points = _points(normalise(text))
        last = max(len(points) - segment, 0)
        for at in sorted({*range(0, last, stride), last}):
            piece = points[at : at + segment]
            if len(piece) >= Q:
                at_segment = known.setdefault(piece.tobytes(), len(parts))
                if at_segment == len(parts):
                    parts.append(piece)
                    holders.append([])
                holders[at_segment].append(len(owners))
                owners.append(item)
    size = np.array([len(p) for p in parts], np.int64)
    budget = np.minimum((size * rate).astype(np.int64), (size - Q) // Q)
    hashes = [_grams(p) for p in parts]
    gram = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
    seg = np.repeat(np.arange(len(parts)), size - Q + 1)
    off = np.concatenate([np.arange(len(h)) for h in hashes]) if hashes else np.empty(0, np.int64)
    order = np.argsort(gram, kind="stable")
    grams, first = np.unique(gram[order], return_index=True)
    bits = int(np.clip(np.ceil(np.log2(max(len(grams), 1) * 32)), 16, 26))
    table = np.zeros(1 << bits, bool)
    table[(grams >> np.uint64(64 - bits)).astype(np.int64)] = True
    return Index(
        owners,
        holders,
        np.concatenate(parts) if parts else np.empty(0, np.uint32),
        np.cumsum(size) - size,
        size,
        budget,
        size - Q + 1 - budget * Q,
        table,
        64 - bits,
        grams,
        np.append(first, len(order)),
        seg[order],
        off[order],
    )


def _dense(places: np.ndarray, least: int, reach: int) -> np.ndarray:
    """The sorted places that lie in a stretch of ``reach`` characters with ``least`` of them."""
    if least <= 1 or len(places) < least:
        return places if least <= 1 else places[:0]
    begins = np.flatnonzero(places[least - 1 :] - places[: len(places) - least + 1] <= reach)
    edges = np.zeros(len(places) + 1, np.int64)
    np.add.at(edges, begins, 1)
    np.add.at(edges, begins + least, -1)
    return places[np.cumsum(edges[:-1]) > 0]


def _align(index: Index, seg: np.ndarray, low: np.ndarray, width: int, points: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Best alignment of each segment inside its band, where it keeps the budget: (which, edits, start, end) in ``points``.

    The band holds the diagonals low .. low + width - 1; characters outside begin .. end match nothing. A cell is
    edits * 2**20 + start diagonal, so that the start of the best alignment is carried along. Edits never fall from one
    character to the next, so a band whose cells are all over the budget is given up.
    """
    one, step = np.int64(1) << 20, np.arange(width)
    alive = np.arange(len(seg))
    cost = np.tile(step.astype(np.int64), (len(seg), 1))
    for i in range(int(index.size[seg].max())):
        if i % _PRUNE_EVERY == 0 and i:
            keep = cost.min(axis=1) >> 20 <= index.budget[seg]
            alive, seg, low, begin, end, cost = (x[keep] for x in (alive, seg, low, begin, end, cost))
            if not len(seg):
                break
        at = low[:, None] + step + i
        inside = (at >= begin[:, None]) & (at < end[:, None])
        there = points[np.clip(at, 0, len(points) - 1)]
        mine = index.points[np.minimum(index.start[seg] + i, len(index.points) - 1)]
        new = cost + np.where(inside & (there == mine[:, None]), 0, one)
        new[:, :-1] = np.minimum(new[:, :-1], cost[:, 1:] + one)
        new = np.minimum.accumulate(new - step * one, axis=1) + step * one
        cost = np.where((index.size[seg] > i)[:, None], new, cost)
    best = cost.argmin(axis=1)
    value = cost[np.arange(len(seg)), best]
    keep = value >> 20 <= index.budget[seg]
    low, best, value = low[keep], best[keep], value[keep]
    return alive[keep], value >> 20, low + (value & (one - 1)), low + best + index.size[seg[keep]]


def search(index: Index, texts: list[str | None]) -> list[dict[object, tuple[set[int], tuple[int, int, int]]]]:
    """For each text its items: (standings of segments found, (least edits, start and end of that match in the normalised text))."""
    found: list[dict] = [{} for _ in texts]
    if not len(index.size):
        return found
    held: list[str] = []
    numbers: list[int] = []
    total = 0
    for i, text in enumerate(texts):
        clean = normalise(text)
        if len(clean) >= Q:
            held.append(clean)
            numbers.append(i)
            total += len(clean) + 1
        if total >= _SLICE_CHARS or (held and i == len(texts) - 1):
            _search_slice(index, held, numbers, found)
            held, numbers, total = [], [], 0
    if held:
        _search_slice(index, held, numbers, found)
    return found


def _search_slice(index: Index, texts: list[str], numbers: list[int], found: list[dict]) -> None:
    # No normalised text holds a line feed, so no q-gram of an item reaches over a border.
    points = _points("\n".join(texts))
    sizes = np.array([len(t) for t in texts], np.int64)
    begin = np.cumsum(sizes + 1) - sizes - 1
    grams = _grams(points)
    places = np.flatnonzero(index.table[(grams >> np.uint64(index.shift)).astype(np.int64)])
    at = np.minimum(np.searchsorted(index.grams, grams[places]), len(index.grams) - 1)
    exact = index.grams[at] == grams[places]
    places, at = places[exact], at[exact]
    stay = np.isin(places, _dense(places, int(index.bound.min()), int((index.size + index.budget).max())), assume_unique=True)
    places, at = places[stay], at[stay]
    if not len(places):
        return
    for doc, seg, band in _full_bands(index, places, at, begin):
        k = index.budget[seg]
        low = begin[doc] + band * (k + 1) - index.size[seg] - k
        width = int((4 * k + 3).max())
        for i in range(0, len(seg), 4096):
            s = slice(i, i + 4096)
            which, edits, start, stop = _align(index, seg[s], low[s], width, points, begin[doc[s]], begin[doc[s]] + sizes[doc[s]])
            owner, mine = doc[s][which], seg[s][which]
            rows = np.stack([owner, mine, edits, start - begin[owner], stop - begin[owner]], axis=1)
            # The best match of each text and segment is shared out to the segment's items.
            rows = rows[np.lexsort(rows.T[::-1])]
            first = np.ones(len(rows), bool)
            first[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
            for d, g, *row in rows[first].tolist():
                items = found[numbers[d]]
                for number in index.holders[g]:
                    item = index.items[number]
                    held = items.setdefault(item, (set(), tuple(row)))
                    held[0].add(number)
                    items[item] = (held[0], min(held[1], tuple(row)))


def _full_bands(index: Index, places: np.ndarray, at: np.ndarray, begin: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, segment, band) of the bands whose shared q-grams reach the segment's bound, each once.

    ``places`` ascend. Diagonals of a text start at 0; band j holds those from j * step to (j + 2) * step, so any k + 1 lie
    in one. Pairs of a place and a segment are made for a bounded number at a time; a band is counted to its end
    once the next place lies beyond its diagonals, and is dropped then if it is short of its bound.
    """
    total = np.concatenate([[0], np.cumsum(index.first[at + 1] - index.first[at])])
    segments, bands = len(index.size), int(places[-1] + index.size.max()) + 2
    open_codes, open_counts = np.empty(0, np.int64), np.empty(0, np.int64)
    i = 0
    while i < len(places):
        j = max(i + 1, int(np.searchsorted(total, total[i] + _POSTINGS, side="right")) - 1)
        counts = np.diff(total[i : j + 1])
        posting = np.arange(total[j] - total[i]) + np.repeat(index.first[at[i:j]] - (total[i:j] - total[i]), counts)
        seg, place = index.segment[posting], np.repeat(places[i:j], counts)
        doc = np.searchsorted(begin, place, side="right") - 1
        band = (place - begin[doc] - index.offset[posting] + index.size[seg]) // (index.budget[seg] + 1)
        code = (doc * segments + seg) * bands + band
        # The code of band - 1, written one higher so that it stays in the range of its text and segment.
        codes, new_counts = np.unique(np.concatenate([code + 1, code]), return_counts=True)
        codes, back = np.unique(np.concatenate([open_codes, codes]), return_inverse=True)
        counted = np.bincount(back, np.concatenate([open_counts, new_counts]), len(codes)).astype(np.int64)
        rest, band = np.divmod(codes, bands)
        doc, seg = np.divmod(rest, segments)
        band -= 1
        last = begin[doc] + (band + 2) * (index.budget[seg] + 1)
        done = np.full(len(codes), True) if j == len(places) else last < places[j]
        full = done & (counted >= index.bound[seg])
        if full.any():
            yield doc[full], seg[full], band[full]
        open_codes, open_counts = codes[~done], counted[~done]
        i = j


def blocks(benchmark: DataFrame, item: str = "item_id", text: str = "text", block_chars: int = BLOCK_CHARS) -> Iterator[Index]:
    """Indexes of the items, dealt by a hash into blocks of about ``block_chars`` characters; null texts are left out."""
    rows = benchmark.select(c(item).alias("item"), c(text).alias("text")).where("text IS NOT NULL").distinct()
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-size // block_chars))
    for k in range(n):
        own = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n).cast("long")) == k)
        yield build_index([(r["item"], r["text"]) for r in own.collect()])


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """One row per row of ``docs`` and item found in it: the key, the item, ``n_segments``, ``n_edits``, ``start``, ``end``.

    An item is found where the text holds one of its segments (all of it, up to ``SEGMENT_CHARS`` characters) with
    at most ``EDIT_RATE`` edits per character, after ``normalise``; ``start`` and ``end`` place the best match in the
    normalised text. Null and empty texts hold nothing; items that share segments are all found; repeated rows are
    searched each; null keys are kept. An empty benchmark finds nothing.
    """
    small_batches(docs.sparkSession)
    narrow = docs.select(c(key).alias("key"), c(text).alias("text"))
    kinds = [T.StructField(key, narrow.schema["key"].dataType), T.StructField(item, benchmark.schema[item].dataType)]
    schema = T.StructType([*kinds, *[T.StructField(x, T.LongType()) for x in ("n_segments", "n_edits", "start", "end")]])
    batch_type = to_arrow_type(kinds[1].dataType)
    out = None
    for index in blocks(benchmark, item, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows, values = [], []
                for i, items in enumerate(search(shared.value, batch.column(1).to_pylist())):
                    for name, (segments, best) in items.items():
                        rows.append(i)
                        values.append((name, len(segments), *best))
                columns = list(zip(*values)) if values else [[]] * 5
                arrow = [pa.array(columns[0], batch_type)] + [pa.array(x, pa.int64()) for x in columns[1:]]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *arrow], names=schema.names)

        part = narrow.mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return out


def drop_leaks(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item in the sense of ``find_leaks``; all columns stay."""
    columns = [c(x) for x in docs.columns]
    name = fresh(docs, "leaks")
    flag = T.StructType([T.StructField(name, T.BooleanType())])
    out = docs
    for index in blocks(benchmark, item, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def compute(column: pa.Array, shared=shared) -> list[pa.Array]:
            return [pa.array([bool(x) for x in search(shared.value, column.to_pylist())], pa.bool_())]

        out = append_columns(out, text, flag, compute).where(~F.col(name)).select(*columns)
    return out
