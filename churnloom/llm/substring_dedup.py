"""Substring dedup: a count-min sketch of all word windows first, then exact grouping of those it lets through.

Every task sketches its windows; the sketches are merged by cell, and since a cell never counts less than any of its
windows, a window whose cells stay below two is unique. The second pass sends only the other windows, with 96 bits of
hash, to be grouped exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import c, fresh, materialize, small_batches

WINDOW_WORDS = 35
#: The sketch has two rows of at most 2**MAX_WIDTH_BITS counters, whose merged "two or more" bits are broadcast (64 MB).
#: More text than that many windows can tell apart lets more unique windows through, but never loses a repeated one.
MAX_WIDTH_BITS = 28
MIN_WIDTH_BITS = 16
CELL_BITS = 20
FLUSH_WINDOWS = 1_000_000
#: A shard is planned for at most twice as many windows.
SHARD_WINDOWS = 1_000_000
#: Anchors are counted in so many buckets, by which windows are dealt to shards, and these counts merged in so many pieces.
BUCKET_BITS = 16
BUCKET_PIECES = 16
_SLICE_WORDS = 200_000
#: Words of the runs by which windows are dealt to shards.
ANCHOR_WORDS = 5
_FACTORS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_NO_REF = 2**32 - 1
_ALL = b"all"


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def window_hashes(words: np.ndarray, size: int) -> list[np.ndarray]:
    """Two 64-bit hashes of every ``size`` consecutive word hashes: polynomials modulo 2**64 from prefix sums."""
    out = []
    n = len(words)

    def powers(x: int) -> np.ndarray:
        base = np.full(n + 1, x, np.uint64)
        base[0] = 1
        return np.cumprod(base)

    for factor in _FACTORS:
        up, down = powers(factor), powers(pow(factor, -1, 2**64))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * up[:n])])
        out.append(_mix((sums[size:] - sums[:-size]) * down[: n - size + 1]))
    return out


def anchors(words: np.ndarray, size: int) -> np.ndarray:
    """For each window of ``size`` words the smallest hash of its runs of ``ANCHOR_WORDS`` words.

    Equal windows have equal anchors, and neighbouring windows mostly share theirs.
    """
    run = min(ANCHOR_WORDS, size)
    low, width = window_hashes(words, run)[0], 1
    while 2 * width <= size - run + 1:
        low = np.minimum(low[: len(low) - width], low[width:])
        width *= 2
    rest = size - run + 1 - width
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def _groups(texts: list[bytes | None], marks: list, window: int) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]]:
    """Windows of distinct texts, some at a time: (marks, copies of each text here, text and word index of each window,
    hashes: two of the window and its anchor)."""
    seen: dict = {}
    order = []
    for text, mark in zip(texts, marks):
        if mark in seen:
            seen[mark] += 1
        else:
            seen[mark] = 1
            order.append((mark, text))
    digest = xxhash.xxh3_64_intdigest
    names, copies, sizes, parts, held = [], [], [], [], 0

    def make():
        words = np.concatenate(parts)
        n = np.array(sizes)
        start = np.cumsum(n) - n
        hashes = [*window_hashes(words, window), anchors(words, window)]
        text = np.repeat(np.arange(len(n)), n - window + 1)
        place = np.arange(len(text)) - np.repeat(np.cumsum(n - window + 1) - (n - window + 1), n - window + 1)
        at = start[text] + place
        return names, np.array(copies), text, place, [h[at] for h in hashes]

    for mark, text in order:
        words = (text or b"").split()
        if len(words) < window:
            continue
        names.append(mark), copies.append(seen[mark]), sizes.append(len(words))
        parts.append(np.fromiter(map(digest, words), np.uint64, len(words)))
        held += len(words)
        if held >= _SLICE_WORDS:
            yield make()
            names, copies, sizes, parts, held = [], [], [], [], 0
    if names:
        yield make()


def _cells(hash1: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A counter in each of the sketch's two rows, from separate bits of the hash."""
    return (hash1 >> np.uint64(64 - bits)).astype(np.int64), (hash1 & np.uint64(2**bits - 1)).astype(np.int64)


def _marked(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(F.unhex(F.md5(F.encode(F.coalesce(c(text), F.lit("")), "UTF-8"))).alias("mark"), c(text).alias("text"))


def _batches(batches: Iterator[pa.RecordBatch], window: int):
    for batch in batches:
        yield from _groups(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(0).to_pylist(), window)


def _bucket(anchor: np.ndarray) -> np.ndarray:
    return (anchor & np.uint64(2**BUCKET_BITS - 1)).astype(np.int64)


def plan_shards(loads: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, int]:
    """First shard and number of shards of each bucket, and all shards, so that no shard is planned for over ``most`` windows.

    Buckets share shards while they fit; one of more than ``most`` windows has shards of its own, among which its
    windows are dealt by their hash. Equal windows have anchor and hash alike, so they still meet.
    """
    parts = np.maximum(-(-loads // most), 1)
    first = np.zeros(len(loads), np.int64)
    shard, held = 0, 0
    for k in np.flatnonzero(parts == 1).tolist():
        if held + int(loads[k]) > most:
            shard, held = shard + 1, 0
        first[k] = shard
        held += int(loads[k])
    large = np.flatnonzero(parts > 1)
    first[large] = shard + 1 + np.cumsum(parts[large]) - parts[large]
    return first, parts, int(shard + 1 + parts[large].sum())


def sketch(docs: DataFrame, text: str, window: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row of the sketch the bits of its counters that reach two, over all windows of all texts."""
    return sketch_and_loads(docs, text, window, bits)[:2]


def sketch_and_loads(docs: DataFrame, text: str, window: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows of ``sketch``, and how many windows of distinct texts of a batch have their anchor in each bucket."""
    cell_bits = min(CELL_BITS, bits)
    per_row = 1 << (bits - cell_bits)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        rows: list[list[np.ndarray]] = [[], []]
        held = 0
        loads = np.zeros(1 << BUCKET_BITS, np.int64)

        def flush() -> Iterator[pa.RecordBatch]:
            cells, data = [], []
            for r in (0, 1):
                index, count = np.unique(np.concatenate(rows[r]), return_counts=True)
                index = np.repeat(index, np.minimum(count, 2))
                cuts = np.searchsorted(index, np.arange(per_row + 1) << cell_bits)
                for k in np.flatnonzero(np.diff(cuts)):
                    own = index[cuts[k] : cuts[k + 1]] & ((1 << cell_bits) - 1)
                    cells.append(r * per_row + int(k))
                    data.append(packer.compress(np.diff(own, prepend=0).astype(np.uint32).tobytes()))
                rows[r].clear()
            yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), pa.array(data, pa.binary())], names=["cell", "data"])

        for _, copies, owner, _, hashes in _batches(batches, window):
            np.add(loads, np.bincount(_bucket(hashes[2]), minlength=len(loads)), out=loads)
            again = copies[owner] > 1
            for r, index in enumerate(_cells(hashes[0], bits)):
                rows[r] += [index.astype(np.uint32), index[again].astype(np.uint32)]
            held += len(owner)
            if held >= FLUSH_WINDOWS:
                yield from flush()
                held = 0
        if held:
            yield from flush()
        if loads.any():
            pieces = [packer.compress(x.tobytes()) for x in np.split(loads, BUCKET_PIECES)]
            cells = range(2 * per_row, 2 * per_row + BUCKET_PIECES)
            yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), pa.array(pieces, pa.binary())], names=["cell", "data"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by cell, so one cell's counters are held at a time, however many sketches there are."""
        unpacker = zstandard.ZstdDecompressor()
        cell, counts = None, np.zeros(1 << cell_bits, np.uint8)
        loads = np.zeros((1 << BUCKET_BITS) // BUCKET_PIECES, np.int64)

        def done() -> pa.RecordBatch:
            packed = loads.tobytes() if cell >= 2 * per_row else np.packbits(counts >= 2, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([cell], pa.int32()), pa.array([packed], pa.binary())], names=["cell", "data"])

        for batch in batches:
            for k, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if k != cell:
                    if cell is not None:
                        yield done()
                    cell = k
                    counts[:] = 0
                    loads[:] = 0
                if k >= 2 * per_row:
                    np.add(loads, np.frombuffer(unpacker.decompress(data), np.int64), out=loads)
                    continue
                index = np.cumsum(np.frombuffer(unpacker.decompress(data), np.uint32).astype(np.int64))
                second = np.diff(index, prepend=-1) == 0
                counts[index[~second]] += 1
                counts[index[second]] += 1
                np.minimum(counts, 2, out=counts)
        if cell is not None:
            yield done()

    parts = _marked(docs, text).mapInArrow(partial, "cell int, data binary")
    merged = parts.repartition("cell").sortWithinPartitions("cell").mapInArrow(merge, "cell int, data binary").toArrow()
    whole = np.zeros((2 * per_row, (1 << cell_bits) // 8 or 1), np.uint8)
    loads = np.zeros((BUCKET_PIECES, (1 << BUCKET_BITS) // BUCKET_PIECES), np.int64)
    for k, data in zip(merged["cell"].to_pylist(), merged["data"]):
        if k >= 2 * per_row:
            loads[k - 2 * per_row] = np.frombuffer(data.as_buffer(), np.int64)
        else:
            whole[k] = np.frombuffer(data.as_buffer(), np.uint8)
    flat = whole.reshape(2, -1)
    return flat[0], flat[1], loads.reshape(-1)


def _bit(bits: np.ndarray, index: np.ndarray) -> np.ndarray:
    return (bits[index >> 3] >> (index & 7).astype(np.uint8)) & 1


def dealt_windows(docs: DataFrame, text: str, window: int = WINDOW_WORDS, max_width_bits: int = MAX_WIDTH_BITS) -> DataFrame:
    """Rows of two kinds for each shard: repeats known inside a task (``mark, starts``), and 12 bytes of hash for each
    window that the sketch lets through (``hashes``) with their texts and places (``owners, places, marks``).

    Windows of one shard are grouped in one task, so shards are planned from counted windows (``plan_shards``).
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(c(text)))).first()[0] or 0
    # About two counters for each word of six bytes, spaces included.
    bits = int(np.clip(np.ceil(np.log2(max(size, 1) / 3)), MIN_WIDTH_BITS, max_width_bits))
    row0, row1, loads = sketch_and_loads(docs, text, window, bits)
    first_shard, shard_parts, shards = plan_shards(loads, 2 * SHARD_WINDOWS)
    shared = spark.sparkContext.broadcast((row0, row1, first_shard, shard_parts))

    def pack(x: np.ndarray, packer) -> bytes:
        return packer.compress(np.diff(x.astype(np.int64), prepend=0).astype(np.int32).tobytes())

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row0, row1, first_shard, shard_parts = shared.value
        packer = zstandard.ZstdCompressor(level=1)
        held: list[tuple] = []
        marks: list = []
        count = 0
        names = ["shard", "mark", "starts", "hashes", "owners", "places", "marks"]

        def home(mark: bytes) -> int:
            return int.from_bytes(mark[:4], "little") % shards

        def flush() -> Iterator[pa.RecordBatch]:
            h1, h2, anchor, owner, place, sure = (np.concatenate(x) for x in zip(*held))
            held.clear()
            order = np.lexsort((h2, h1))
            h1, h2, anchor, owner, place, sure = h1[order], h2[order], anchor[order], owner[order], place[order], sure[order]
            new = np.ones(len(h1), bool)
            new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            run = np.cumsum(new) - 1
            known = (np.bincount(run)[run] > 1) | (np.bincount(run, sure)[run] > 0)
            out = {n: [] for n in names}

            def add(**row) -> None:
                for n in names:
                    out[n].append(row.get(n))

            mine = known & ~sure
            o = np.lexsort((place[mine], owner[mine]))
            own, at = owner[mine][o], place[mine][o]
            cuts = np.flatnonzero(np.diff(own, prepend=-1))
            for i, j in zip(cuts, np.append(cuts[1:], len(own))):
                add(shard=home(marks[own[i]]), mark=marks[own[i]], starts=at[i:j].astype("<i4").tobytes())
            # One row for each hash: known ones travel without a place, to tell the others of that hash.
            send = new
            owner, place = np.where(known, _NO_REF, owner)[send], np.where(known, 0, place)[send]
            h1, h2 = h1[send], h2[send]
            # By anchor, so that a text's windows go to as many shards as it has anchors, however many shards there are;
            # only those of a crowded anchor are dealt further.
            bucket = _bucket(anchor[send])
            shard = first_shard[bucket] + (h1 % shard_parts[bucket].astype(np.uint64)).astype(np.int64)
            o = np.lexsort((place, owner, shard))
            h1, h2, owner, place, shard = h1[o], h2[o], owner[o], place[o], shard[o]
            cuts = np.searchsorted(shard, np.arange(shards + 1))
            for k in np.flatnonzero(np.diff(cuts)):
                i, j = cuts[k], cuts[k + 1]
                texts, local = np.unique(owner[i:j], return_inverse=True)
                table = b"".join(b"\0" * 16 if t == _NO_REF else marks[t] for t in texts.tolist())
                local = np.where(owner[i:j] == _NO_REF, -1, local)
                add(
                    shard=int(k),
                    hashes=h1[i:j].tobytes() + h2[i:j].tobytes(),
                    owners=pack(local, packer),
                    places=pack(place[i:j], packer),
                    marks=table,
                )
            marks.clear()
            types = [pa.int32(), *[pa.binary()] * 6]
            yield pa.RecordBatch.from_arrays([pa.array(out[n], t) for n, t in zip(names, types)], names=names)

        for own, copies, owner, place, hashes in _batches(batches, window):
            full = [m for m, n in zip(own, copies) if n > 1]
            if full:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(map(home, full), pa.int32()), pa.array(full, pa.binary()), pa.array([_ALL] * len(full), pa.binary()), *[pa.nulls(len(full), pa.binary())] * 4],
                    names=names,
                )
            first, second = _cells(hashes[0], bits)
            passed = np.flatnonzero(_bit(row0, first) & _bit(row1, second))
            held.append((hashes[0][passed], (hashes[1][passed] >> np.uint64(32)).astype(np.uint32), hashes[2][passed], owner[passed] + len(marks), place[passed], copies[owner[passed]] > 1))
            marks += own
            count += len(passed)
            if count >= FLUSH_WINDOWS or len(marks) > 500_000:
                yield from flush()
                count = 0
        if held:
            yield from flush()

    kinds = "shard int, mark binary, starts binary, hashes binary, owners binary, places binary, marks binary"
    return _marked(docs, text).mapInArrow(candidates, kinds)


def repeated_starts(docs: DataFrame, text: str, window: int = WINDOW_WORDS, max_width_bits: int = MAX_WIDTH_BITS) -> DataFrame:
    """``mark, starts``: for each distinct text (MD5) with repeated windows, the word indexes where these start.

    ``starts`` holds little-endian 32-bit integers in order, or ``all`` for a text that occurs more than once in full.
    """

    def unpack(x: bytes, unpacker) -> np.ndarray:
        return np.cumsum(np.frombuffer(unpacker.decompress(x), np.int32).astype(np.int64))

    def group(table: pa.Table) -> pa.Table:
        unpacker = zstandard.ZstdDecompressor()
        known = table.filter(pc.is_valid(table["mark"])).select(["mark", "starts"])
        table = table.filter(pc.is_null(table["mark"]))
        if not len(table):
            return known
        h1, h2, owner, place, marks, n = [], [], [], [], [], 0
        for row in table.to_pylist():
            m = len(row["hashes"]) // 12
            h1.append(np.frombuffer(row["hashes"], np.uint64, m))
            h2.append(np.frombuffer(row["hashes"], np.uint32, m, 8 * m))
            local = unpack(row["owners"], unpacker)
            owner.append(np.where(local < 0, -1, local + n))
            place.append(unpack(row["places"], unpacker))
            marks.append(row["marks"])
            n += len(row["marks"]) // 16
        h1, h2, owner, place = (np.concatenate(x) for x in (h1, h2, owner, place))
        # Equal texts get one number, by their marks.
        _, first, same = np.unique(np.frombuffer(b"".join(marks), "S16"), return_index=True, return_inverse=True)
        table16 = np.frombuffer(b"".join(marks), np.uint8).reshape(-1, 16)
        order = np.lexsort((h2, h1))
        new = np.ones(len(h1), bool)
        new[1:] = (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1])
        run = np.cumsum(new) - 1
        often = (np.bincount(run)[run] > 1) | (np.bincount(run, owner[order] < 0)[run] > 0)
        hit = order[often]
        hit = hit[owner[hit] >= 0]
        text, at = same[owner[hit]], place[hit]
        pairs = np.unique(text * (2**32) + at) if len(text) else np.empty(0, np.int64)
        text, at = np.divmod(pairs, 2**32)
        cuts = np.flatnonzero(np.diff(text, prepend=-1))
        ends = np.append(cuts[1:], len(text))
        out_marks = [table16[first[text[i]]].tobytes() for i in cuts]
        starts = [at[i:j].astype("<i4").tobytes() for i, j in zip(cuts, ends)]
        return pa.concat_tables([known, pa.table({"mark": pa.array(out_marks, pa.binary()), "starts": pa.array(starts, pa.binary())}, known.schema)])

    found = dealt_windows(docs, text, window, max_width_bits)
    return found.groupBy("shard").applyInArrow(group, "mark binary, starts binary")


def _merge_starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joins the starts of each mark; rows come sorted by mark, so one text's starts are held at a time."""
    mark, held = None, []

    def done() -> pa.RecordBatch:
        merged = _ALL if _ALL in held else np.unique(np.frombuffer(b"".join(held), "<i4")).astype("<i4").tobytes()
        return pa.RecordBatch.from_arrays([pa.array([mark], pa.binary()), pa.array([merged], pa.binary())], names=["mark", "starts"])

    for batch in batches:
        for m, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if m != mark:
                if mark is not None:
                    yield done()
                mark, held = m, []
            held.append(s)
            if len(held) > 1000:
                held = [_ALL] if _ALL in held else [np.unique(np.frombuffer(b"".join(held), "<i4")).tobytes()]
    if mark is not None:
        yield done()


def remove_repeats(
    docs: DataFrame, text: str = "text", window: int = WINDOW_WORDS, max_width_bits: int = MAX_WIDTH_BITS
) -> DataFrame:
    """All columns of ``docs``, with ``text`` less the words of repeated windows, and ``n_words`` and ``n_removed``.

    A word is a run without ASCII white space; a window is ``window`` consecutive words of one text. Every word of
    every window whose word sequence also starts at another place of any row goes, all occurrences alike; windows are judged on the input.
    Kept words are joined by one space. Null texts count as empty and come back empty; texts shorter than a window keep
    their words. Repeated rows are copies of each other and lose all words of their windows. Old columns named like the
    new ones are replaced.
    """
    new = ("n_words", "n_removed")
    kept = [x for x in docs.columns if x.lower() not in new]
    small_batches(docs.sparkSession)
    starts = repeated_starts(docs, text, window, max_width_bits)
    starts = materialize(starts.repartition("mark").sortWithinPartitions("mark").mapInArrow(_merge_starts, "mark binary, starts binary"), "starts")
    mark, hits = fresh(docs, "mark"), fresh(docs, "starts")
    rows = docs.select(*[c(x) for x in kept], F.unhex(F.md5(F.encode(F.coalesce(c(text), F.lit("")), "UTF-8"))).alias(mark))
    joined = rows.join(starts.select(F.col("mark").alias(mark), F.col("starts").alias(hits)), mark, "left").drop(mark)
    schema = T.StructType([*docs.select(*[c(x) for x in kept]).schema.fields, T.StructField(new[0], T.LongType()), T.StructField(new[1], T.LongType())])
    width, place = len(kept), kept.index(text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, sizes, gone = [], [], []
            for raw, found in zip(batch.column(place).cast(pa.binary()).to_pylist(), batch.column(width).to_pylist()):
                words = (raw or b"").split()
                drop = np.zeros(len(words), bool)
                if found == _ALL:
                    drop[:] = len(words) >= window
                elif found:
                    at = np.frombuffer(found, "<i4").astype(np.int64)
                    edges = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edges, at, 1)
                    np.add.at(edges, at + window, -1)
                    drop = np.cumsum(edges[:-1]) > 0
                texts.append(b" ".join(w for w, d in zip(words, drop.tolist()) if not d) if drop.any() else b" ".join(words))
                sizes.append(len(words))
                gone.append(int(drop.sum()))
            columns = [batch.column(i) for i in range(width)]
            columns[place] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sizes, pa.int64()), pa.array(gone, pa.int64())], names=[f.name for f in schema.fields])

    return joined.mapInArrow(cut, schema)
