"""Language-model scores by masked pseudo-likelihood."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import materialize, read

#: Tokens are characters: a token for each that occurs so often in the corpus,
#: hashed ones for the rest, 0 beyond a text's ends.
LEAST, HASHED = 20, 64
#: Widths of the network; rounds of training, windows of a batch.
EMBEDDING, HIDDEN = 10, 48
ROUNDS, BATCH = 30, 4096
#: Characters that are handled at a time; windows whose scores a task remembers.
SLICE = 1 << 20
KNOWN = 1 << 20
#: A window is packed in two numbers: the tokens two and one to the left; those one
#: and two to the right and the token itself. A token has 21 bits, as many as a code point.
LOW = (1 << 21) - 1


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def token_table(letters: list[str]) -> np.ndarray:
    """Token of each code point: the corpus's characters by their place, others by a hash."""
    table = 1 + (np.arange(0x110000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % HASHED
    table[[ord(c) for c in letters]] = 1 + HASHED + np.arange(len(letters))
    table[0] = 0
    return table


def windows(texts: list[str | None], table: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, a packed window for each character, numbers by
    row). Whole texts; a long one comes in several slices."""
    texts = [(t or "").replace("\0", "\1") for t in texts]

    def around(padded: str) -> np.ndarray:
        s = table[_points(padded)]
        return np.stack([s[:-4] << 21 | s[1:-3], s[3:-1] << 42 | s[4:] << 21 | s[2:-2]])

    row = 0
    while row < len(texts):
        end, total = row, 0
        while end < len(texts) and (end == row or total + len(texts[end]) <= SLICE):
            total += len(texts[end])
            end += 1
        padded = "\0\0" + "\0\0".join(texts[row:end]) + "\0\0"
        if total > SLICE:  # one long text
            for at in range(0, total, SLICE):
                got = around(padded[at : at + SLICE + 4])
                yield row, end, got, np.array([got.shape[1]])
        else:
            got = around(padded)
            yield row, end, got[:, got[1] & LOW != 0], np.array([len(t) for t in texts[row:end]])
        row = end


def unpacked(p: np.ndarray) -> np.ndarray:
    """The five tokens of each window."""
    return np.stack([p[0] >> 21, p[0] & LOW, p[1] >> 42, p[1] >> 21 & LOW, p[1] & LOW], 1)


def keys(p: np.ndarray) -> np.ndarray | None:
    """A number for each window, which tells it from all others; None if there are
    too many tokens for that."""
    w = [p[0] >> 21, p[0] & LOW, p[1] >> 42, p[1] >> 21 & LOW, p[1] & LOW]
    if max((int(x.max()) for x in w if len(x)), default=0) < 1 << 12:
        return w[0] << 48 | w[1] << 36 | w[2] << 24 | w[3] << 12 | w[4]
    return None


def distinct(p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order that puts equal windows side by side (that of ``keys``, if there are
    such), where each begins in it, and the place among the distinct ones of each in
    that order."""
    key = keys(p)
    order = np.argsort(key) if key is not None else np.lexsort(p)
    new = np.ones(p.shape[1], bool)
    q = p[:, order]
    new[1:] = (q[0, 1:] != q[0, :-1]) | (q[1, 1:] != q[1, :-1])
    return order, np.flatnonzero(new), np.cumsum(new) - 1


def counted(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct windows and how often each is there."""
    key = keys(p)
    if key is None:
        order, starts, _ = distinct(p)
        return p[:, order[starts]], np.diff(np.append(starts, len(order)))
    key.sort()
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, np.int64)
    k, token = key[starts], (1 << 12) - 1
    windows_ = np.stack([k >> 48 << 21 | k >> 36 & token, (k >> 24 & token) << 42 | (k >> 12 & token) << 21 | k & token])
    return windows_, np.diff(np.append(starts, len(key)))


class Known:
    """What a task has worked out for each window, by ``keys``; begun anew when
    that is too much."""

    def __init__(self):
        self.keys, self.values = np.empty(0, np.int64), np.empty(0, np.float32)

    def of(self, key: np.ndarray, work) -> np.ndarray:
        """The values of sorted distinct keys; ``work`` gives those at some places."""
        at = np.searchsorted(self.keys, key)
        met = at < len(self.keys)
        met[met] = self.keys[at[met]] == key[met]
        out = np.empty(len(key), np.float32)
        out[met] = self.values[at[met]]
        if len(new := np.flatnonzero(~met)):
            out[new] = work(new)
            if len(self.keys) + len(new) > KNOWN:
                self.keys, self.values = key[new], out[new]
            else:
                self.keys, self.values = np.insert(self.keys, at[new], key[new]), np.insert(self.values, at[new], out[new])
        return out


class Network:
    """Embeddings of the four neighbours, one hidden layer, softmax over tokens."""

    def __init__(self, flat: np.ndarray | None = None, seed: int = 0, tokens: int = 1 + HASHED):
        if flat is not None:
            tokens = (len(flat) - 4 * EMBEDDING * HIDDEN - HIDDEN) // (EMBEDDING + HIDDEN + 1)
        self.shapes = [(tokens, EMBEDDING), (4 * EMBEDDING, HIDDEN), (HIDDEN,), (HIDDEN, tokens), (tokens,)]
        if flat is None:
            rng = np.random.default_rng(seed)
            # Embeddings are looked up, not summed: their size doesn't depend on how many there are.
            flat = np.concatenate([(rng.normal(size=s) / np.sqrt(s[0] if k else 32) if len(s) > 1 else np.zeros(s)).ravel() for k, s in enumerate(self.shapes)])
        self.flat = np.asarray(flat, np.float64)

    def parts(self, flat: np.ndarray) -> list[np.ndarray]:
        ends = np.cumsum([int(np.prod(s)) for s in self.shapes])
        return [flat[e - int(np.prod(s)) : e].reshape(s) for e, s in zip(ends, self.shapes)]

    def log_probabilities(self, context: np.ndarray) -> np.ndarray:
        """Log-probability of each token between the neighbours in ``context``.
        A text has no character that is token 0, so that one has none."""
        e, w, b, v, c = (x.astype(np.float32) for x in self.parts(self.flat))
        z = np.tanh(e[context].reshape(len(context), -1) @ w + b) @ v + c
        z[:, 0] = -np.inf
        z -= z.max(1, keepdims=True)
        return z - np.log(np.exp(z).sum(1, keepdims=True))

    def of_windows(self, w: np.ndarray) -> np.ndarray:
        """Log-probability of the last token of each window, in blocks."""
        out = np.empty(len(w), np.float32)
        for at in range(0, len(w), BATCH):
            part = w[at : at + BATCH]
            out[at : at + BATCH] = self.log_probabilities(part[:, :4])[np.arange(len(part)), part[:, 4]]
        return out

    def gradient(self, w_: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Of the summed loss of these windows, each as often as it was counted."""
        e, w, b, v, c = (x.astype(np.float32) for x in self.parts(self.flat))
        context, target = w_[:, :4], w_[:, 4]
        x = e[context].reshape(len(w_), -1)
        h = np.tanh(x @ w + b)
        z = h @ v + c
        z[:, 0] = -np.inf
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(w_)), target] -= 1
        p *= counts[:, None].astype(np.float32)
        out = np.zeros_like(self.flat)
        ge, gw, gb, gv, gc = self.parts(out)
        gv[:], gc[:] = h.T @ p, p.sum(0)
        dh = (p @ v.T) * (1 - h * h)
        gw[:], gb[:] = x.T @ dh, dh.sum(0)
        dx = (dh @ w.T).reshape(-1, EMBEDDING)
        for k in range(EMBEDDING):
            ge[:, k] = np.bincount(context.ravel(), dx[:, k], minlength=len(ge))
        return out


class Model:
    """A trained network with the corpus's tokens."""

    def __init__(self, letters: list[str], network: Network):
        self.letters, self.flat = letters, network.flat.tobytes()

    def scores(self, texts: list[str | None], table: np.ndarray, known: Known | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Characters and summed log-probabilities of whole texts; the network sees
        each distinct window of a slice once, and none that is in ``known``."""
        known = known or Known()
        n, total = np.zeros(len(texts), np.int64), np.zeros(len(texts))
        net = Network(np.frombuffer(self.flat))
        for row, end, w, lengths in windows(texts, table):
            order, starts, place = distinct(w)
            once = w[:, order[starts]]
            key = keys(once)
            values = net.of_windows(unpacked(once)) if key is None else known.of(key, lambda at: net.of_windows(unpacked(once[:, at])))
            each = np.empty(len(order))
            each[order] = values[place]
            upto = np.concatenate([[0.0], np.cumsum(each)])
            at = np.concatenate([[0], np.cumsum(lengths)])
            n[row:end] += lengths
            total[row:end] += upto[at[1:]] - upto[at[:-1]]
        return n, total


def letters_of(docs: DataFrame, text_col: str = "text", least: int = LEAST) -> list[str]:
    """Every character that all texts hold ``least`` times together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, int] = {}
        for b in batches:
            texts = [t for t in b.column(0).to_pylist() if t]
            for at in range(0, len(texts), 256):
                joined = "".join(texts[at : at + 256])
                for k in range(0, len(joined), 4 * SLICE):
                    counts = np.bincount(_points(joined[k : k + 4 * SLICE]))
                    for p in np.flatnonzero(counts).tolist():
                        total[p or 1] = total.get(p or 1, 0) + int(counts[p])
        yield pa.record_batch([pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.int64())], names=["point", "n"])

    found = docs.select(F.col(text_col).cast("string")).mapInArrow(run, "point int, n long")
    top = found.groupBy("point").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).collect()
    return [chr(p) for p in sorted(r.point for r in top)]


def window_counts(docs: DataFrame, letters: list[str], text_col: str = "text") -> DataFrame:
    """``left``, ``right`` (see ``LOW``), ``n``: how often each window occurs in all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_table(letters)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        rows = 0

        def merged(p: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            order, starts, _ = distinct(p)
            return p[:, order[starts]], np.add.reduceat(n[order], starts)

        def out() -> Iterator[pa.RecordBatch]:
            if held:
                p, n = merged(np.concatenate([p for p, _ in held], 1), np.concatenate([n for _, n in held]))
                held.clear()
                for at in range(0, p.shape[1], 100_000):
                    left, right = p[:, at : at + 100_000]
                    yield pa.record_batch([pa.array(left), pa.array(right), pa.array(n[at : at + 100_000])], names=["left", "right", "n"])

        for b in batches:
            for _, _, w, _ in windows(b.column(0).to_pylist(), table):
                if w.size:
                    held.append(counted(w))
                    rows += len(held[-1][1])
                if rows > 2_000_000:
                    yield from out()
                    rows = 0
        yield from out()

    return docs.select(F.col(text_col).cast("string")).mapInArrow(run, "left long, right long, n long").groupBy("left", "right").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, text_col: str = "text", rounds: int = ROUNDS) -> Model:
    """Trains on the windows of all texts. Windows are counted over the corpus;
    each round is a full pass: every task sums the gradient over all of its
    windows, each weighted by its count, and a step of Adam follows the sum of
    all tasks. Only gradients (some thousand numbers a task) come to the driver."""
    letters = letters_of(docs, text_col)
    counts = materialize(window_counts(docs, letters, text_col))
    net = Network(tokens=1 + HASHED + len(letters))
    m, v = np.zeros_like(net.flat), np.zeros_like(net.flat)
    for r in range(1, rounds + 1):

        def run(batches: Iterator[pa.RecordBatch], flat=net.flat.copy()) -> Iterator[pa.RecordBatch]:
            local, total, weight = Network(flat), np.zeros_like(flat), 0
            for b in batches:
                w, n = unpacked(np.stack([b.column(0).to_numpy(), b.column(1).to_numpy()])), b.column(2).to_numpy()
                weight += int(n.sum())
                for at in range(0, len(w), BATCH):
                    total += local.gradient(w[at : at + BATCH], n[at : at + BATCH])
            if weight:
                yield pa.record_batch([pa.array([float(weight)]), pa.array([total.tolist()], pa.list_(pa.float64()))], names=["weight", "gradient"])

        results = sorted(counts.mapInArrow(run, "weight double, gradient array<double>").collect())
        if results:
            g = np.sum([x.gradient for x in results], axis=0) / sum(x.weight for x in results)
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            net.flat = net.flat - 0.05 * (m / (1 - 0.9**r)) / (np.sqrt(v / (1 - 0.99**r)) + 1e-8)
    return Model(letters, net)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens``, ``log_likelihood`` (the sum over a text's tokens of
    the log-probability given the tokens on both sides), ``mean_log_likelihood``
    (null without tokens), for each row of ``docs``. Null counts as empty, with
    likelihood 0; null and repeated ids are kept; other columns are ignored."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, known = token_table(held.value.letters), Known()
        for b in batches:
            n, total = held.value.scores(b.column(1).to_pylist(), table, known)
            yield pa.record_batch([b.column(0), pa.array(n), pa.array(total)], names=["doc_id", "n_tokens", "log_likelihood"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = rows.mapInArrow(run, "doc_id long, n_tokens long, log_likelihood double")
    return out.withColumn("mean_log_likelihood", F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, train(docs))
