"""Language identification by a bidirectional gated recurrent network over bytes, trained with numpy.

The network reads UTF-8 bytes in windows of fixed length, forwards and backwards, and labels every position from both
states; a document's probabilities are the mean over all its positions.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append_columns, c, fresh

HIDDEN = 8
WINDOW = 256
#: Training reads at most this many documents of each language, and one slice of each.
SAMPLE_DOCS = 500
SLICE_CHARS = 480
TRAIN_BYTES = 96
STEPS = 260
BATCH = 192
RATE = 0.02
MIN_SCORE = 0.5
UNKNOWN = "und"
_CHUNK = 2048
_LETTER = re.compile(rb"[A-Za-z]")



@dataclass
class Network:
    """Weights: per direction input rows ``e`` (3H x 256) and recurrent ``u`` (3H x H); labels from ``v`` and ``b``."""

    languages: list[str]
    e: list[np.ndarray]
    u: list[np.ndarray]
    v: np.ndarray
    b: np.ndarray

    @property
    def hidden(self) -> int:
        return self.u[0].shape[1]

    def arrays(self) -> list[np.ndarray]:
        return [*self.e, *self.u, self.v, self.b]


def new_network(languages: Sequence[str], hidden: int = HIDDEN, seed: int = 0) -> Network:
    rng = np.random.default_rng(seed)
    normal = lambda s, *shape: (rng.standard_normal(shape) * s).astype(np.float32)
    n = len(languages)
    return Network(
        list(languages),
        [normal(0.3, 3 * hidden, 256) for _ in range(2)],
        [normal(0.3, 3 * hidden, hidden) for _ in range(2)],
        normal(0.3, n, 2 * hidden),
        np.zeros((n, 1), np.float32),
    )


def _run(net: Network, side: int, x: np.ndarray, valid: np.ndarray | None, keep: list | None = None) -> np.ndarray:
    """States (T, H, B) after each byte of ``x`` (T, B) in one direction; ``keep`` collects what training needs."""
    e, u, h = net.e[side], net.u[side], net.hidden
    width = x.shape[1]
    steps = range(len(x)) if side == 0 else range(len(x) - 1, -1, -1)
    state = np.zeros((h, width), np.float32)
    out = np.empty((len(x), h, width), np.float32)
    a, r, size = np.empty((3 * h, width), np.float32), np.empty((3 * h, width), np.float32), np.empty((h, width), np.float32)
    gates, z, g, n = a[: 2 * h], a[:h], a[h : 2 * h], a[2 * h :]
    for t in steps:
        np.take(e, x[t], axis=1, out=a, mode="clip")
        np.matmul(u, state, out=r)
        # Gates are a piecewise linear sigmoid; the candidate is x / (1 + |x|).
        gates += r[: 2 * h]
        gates *= 0.25
        gates += 0.5
        np.clip(gates, 0.0, 1.0, out=gates)
        np.multiply(g, r[2 * h :], out=size)
        n += size
        np.abs(n, out=size)
        size += 1.0
        n /= size
        new = np.subtract(state, n, out=out[t])
        new *= z
        new += n
        if valid is not None:
            new *= valid[t]
        if keep is not None:
            keep.append((t, state, z.copy(), g.copy(), n.copy(), r[2 * h :].copy()))
        state = new
    return out


def _softmax(x: np.ndarray) -> np.ndarray:
    """Over the first axis, in place. States lie in -1..1, so trained scores stay far inside the bounds."""
    np.clip(x, -60.0, 60.0, out=x)
    np.exp(x, out=x)
    x /= x.sum(axis=0)
    return x


def label_windows(net: Network, x: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sums over positions of the label probabilities (labels, windows) of windows ``x`` (T, B) of ``size`` bytes."""
    valid = None
    if (size < len(x)).any():
        valid = (np.arange(len(x))[:, None] < size[None, :]).astype(np.float32)
    forward, backward = _run(net, 0, x, valid), _run(net, 1, x, valid)
    total = np.zeros((len(net.languages), x.shape[1]), np.float32)
    h = net.hidden
    left, right = np.ascontiguousarray(net.v[:, :h]), np.ascontiguousarray(net.v[:, h:])
    p, q = np.empty_like(total), np.empty_like(total)
    for t in range(len(x)):
        np.matmul(left, forward[t], out=p)
        np.matmul(right, backward[t], out=q)
        p += q
        p += net.b
        _softmax(p)
        if valid is not None:
            p *= valid[t]
        total += p
    return total


def label_positions(net: Network, text: str | bytes, window: int = WINDOW) -> list[str]:
    """The label of every byte of one text."""
    data = text.encode() if isinstance(text, str) else text
    out: list[str] = []
    h = net.hidden
    for i in range(0, len(data), window):
        x = np.frombuffer(data[i : i + window], np.uint8)[:, None]
        f, b = _run(net, 0, x, None), _run(net, 1, x, None)
        for t in range(len(x)):
            out.append(net.languages[int(np.argmax(net.v[:, :h] @ f[t] + net.v[:, h:] @ b[t] + net.b))])
    return out


def pool(net: Network, texts: list[bytes], window: int = WINDOW, chunk: int = _CHUNK) -> np.ndarray:
    """Mean label probabilities of each text over all its bytes (texts, labels); zeros for an empty text.

    Texts pass in groups of about ``chunk`` windows, so that memory does not grow with their number or length.
    """
    sums = np.zeros((len(texts), len(net.languages)))
    owner: list[np.ndarray] = []
    parts: list[bytes] = []
    sizes: list[np.ndarray] = []
    held = 0

    def flush() -> None:
        nonlocal held
        if held:
            x = np.frombuffer(b"".join(parts), np.uint8).reshape(-1, window)
            size, own = np.concatenate(sizes), np.concatenate(owner)
            for some in np.array_split(np.arange(len(x)), -(-2 * len(x) // (3 * chunk))):
                np.add.at(sums, own[some], label_windows(net, np.ascontiguousarray(x[some].T), size[some]).T)
        owner.clear(), parts.clear(), sizes.clear()
        held = 0

    for i, text in enumerate(texts):
        if not text:
            continue
        n = -(-len(text) // window)
        parts.append(text.ljust(n * window, b"\0"))
        size = np.full(n, window)
        size[-1] = len(text) - (n - 1) * window
        sizes.append(size)
        owner.append(np.full(n, i))
        held += n
        if held >= chunk:
            flush()
    flush()
    lengths = np.array([max(len(t), 1) for t in texts])
    return sums / lengths[:, None]


def train(
    texts: list[bytes],
    labels: list[str],
    hidden: int = HIDDEN,
    steps: int = STEPS,
    batch: int = BATCH,
    length: int = TRAIN_BYTES,
    rate: float = RATE,
    seed: int = 0,
) -> Network:
    """Fits a network by backpropagation through time on the cross entropy of every position's label."""
    names = sorted(set(labels))
    net = new_network(names, hidden, seed)
    pieces = [(t[i : i + length], names.index(y)) for t, y in zip(texts, labels) for i in range(0, len(t), length) if i == 0 or len(t) - i >= length // 2]
    if not pieces:
        return net
    x_all = np.stack([np.frombuffer(p.ljust(length, b"\0"), np.uint8) for p, _ in pieces])
    size_all = np.array([len(p) for p, _ in pieces])
    y_all = np.array([y for _, y in pieces])
    # Each language gives the same share of every batch.
    members = [np.flatnonzero(y_all == k) for k in range(len(names))]
    members = [m for m in members if len(m)]
    rng = np.random.default_rng(seed + 1)
    moments = [(np.zeros_like(a), np.zeros_like(a)) for a in net.arrays()]
    for step in range(1, steps + 1):
        pick = np.concatenate([rng.choice(m, max(1, batch // len(members))) for m in members])
        grads = _gradients(net, np.ascontiguousarray(x_all[pick].T), size_all[pick], y_all[pick])
        pace = rate * min(1.0, 2.0 * (1 - step / (steps + 1)))
        for a, g, (m, s) in zip(net.arrays(), grads, moments):
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            a -= (pace * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def _gradients(net: Network, x: np.ndarray, size: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean cross entropy, in the order of ``Network.arrays``."""
    h, (t_all, n) = net.hidden, x.shape
    valid = (np.arange(t_all)[:, None] < size[None, :]).astype(np.float32)
    kept: list[list] = [[], []]
    states = [_run(net, s, x, valid, kept[s]) for s in (0, 1)]
    both = np.concatenate(states, axis=1)
    p = _softmax((net.v @ both + net.b).transpose(1, 0, 2)).transpose(1, 0, 2).copy()
    p[:, y, np.arange(n)] -= 1
    p *= valid[:, None, :] / valid.sum()
    gv, gb = np.einsum("tcb,thb->ch", p, both), p.sum(axis=(0, 2))[:, None]
    back = np.einsum("ch,tcb->thb", net.v, p)
    ge, gu = [], []
    for side in (0, 1):
        u = net.u[side]
        gx = np.empty((t_all, 3 * h, n), np.float32)
        du = np.zeros_like(u)
        d = np.zeros((h, n), np.float32)
        for t, before, z, g, cand, r in reversed(kept[side]):
            d = (d + back[t, side * h : side * h + h]) * valid[t]
            dn = d * (1 - z) * np.square(1 - np.abs(cand))
            dz = d * (before - cand) * (0.25 * ((z > 0) & (z < 1)))
            dg = dn * r * (0.25 * ((g > 0) & (g < 1)))
            through = np.concatenate([dz, dg, dn * g])
            du += through @ before.T
            gx[t] = np.concatenate([dz, dg, dn])
            d = d * z + u.T @ through
        flat = x.ravel()
        ge.append(np.stack([np.bincount(flat, gx[:, k].ravel(), 256) for k in range(3 * h)]).astype(np.float32))
        gu.append(du)
    return [*ge, *gu, gv, gb]


def training_sample(docs: DataFrame, usable: Column, key: str, text: str, lang: str, per_language: int = SAMPLE_DOCS) -> tuple[list[bytes], list[str]]:
    """At most ``per_language`` slices of labelled texts of each language, chosen and placed by hashes.

    Documents are counted per language first; a hash then keeps about three times as many as are wanted, whatever the
    size of the table, and of these the lowest hashes are taken.
    """
    size = F.length("text")
    place = F.pmod(F.xxhash64("text"), F.greatest(size - SLICE_CHARS, F.lit(0)) + F.lit(1)).cast("int") + F.lit(1)
    order = Window.partitionBy("lang").orderBy("mark", "part")
    labelled = docs.where(F.coalesce(usable, F.lit(False)) & c(lang).isNotNull()).select(
        c(key).alias("key"), c(text).alias("text"), c(lang).cast("string").alias("lang")
    )
    counts = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    # As many rows as the network has outputs.
    near = labelled.join(F.broadcast(counts), "lang").where(
        F.pmod(F.xxhash64(F.lit(1), "key"), F.lit(2**30)) / float(2**30) * F.col("n") < 3 * per_language + 50
    )
    rows = (
        near.where(F.col("text").rlike(r"\p{L}"))
        .select("lang", F.xxhash64("key", "text").alias("mark"), F.substring("text", place, F.lit(SLICE_CHARS)).alias("part"))
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= per_language)
        .orderBy("lang", "place")
        .select("part", "lang")
        .collect()
    )
    return [r["part"].encode() for r in rows], [r["lang"] for r in rows]


def has_letter(text: bytes | None) -> bool:
    if not text:
        return False
    return bool(_LETTER.search(text)) or any(map(str.isalpha, text.decode("utf-8", "ignore")))


def predict(
    docs: DataFrame, net: Network, text: str = "text", window: int = WINDOW, names: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """All columns of ``docs`` with ``lang_pred`` and ``score`` (or other ``names``), from the whole text alone.

    ``lang_pred`` is the language of the highest pooled probability (ties: the first by name) and ``score`` that
    probability. Null texts and texts without a letter, empty ones included, get ``und`` and 0; so does every text
    if the network knows no language. Repeated rows get equal results; old columns of these names are replaced.
    """

    def compute(column: pa.Array) -> list[pa.Array]:
        texts = column.cast(pa.binary()).to_pylist()
        readable = np.array([bool(net.languages) and has_letter(t) for t in texts], bool)
        labels = np.full(len(texts), UNKNOWN, object)
        scores = np.zeros(len(texts))
        if readable.any():
            p = pool(net, [t if ok else b"" for t, ok in zip(texts, readable)], window)
            best = p.argmax(axis=1)
            labels[readable] = np.array(net.languages, object)[best[readable]]
            scores[readable] = np.minimum(p.max(axis=1)[readable], 1.0)
        return [pa.array(labels.tolist(), pa.string()), pa.array(scores)]

    fields = T.StructType([T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])
    return append_columns(docs, text, fields, compute)


def held_out(key: Column) -> Column:
    """Documents kept for testing: those whose key, as text, has a CRC-32 of remainder 2 by 4. Null keys are not."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = SAMPLE_DOCS) -> Network:
    """A network fitted on a bounded sample of the labelled documents that are not held out; rows without key are not used."""
    texts, labels = training_sample(docs, c(key).isNotNull() & ~held_out(c(key)), key, text, lang, per_language)
    return train(texts, labels)


def keep_known(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` whose text is in a learned language with a pooled probability of ``min_score`` or more."""
    name, score = fresh(docs, "lang"), fresh(docs, "score")
    told = predict(docs, learn(docs, key, text, lang), text, names=(name, score))
    return told.where((F.col(name) != UNKNOWN) & (F.col(score) >= min_score)).select(*[c(x) for x in docs.columns])
