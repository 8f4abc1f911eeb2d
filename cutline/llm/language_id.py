"""Language of a text by a bidirectional gated recurrent network over its bytes, trained here in numpy.

The network reads segments of ``SEGMENT`` bytes in both directions, gives every position a distribution over the learned
languages, and the mean over all positions of a text is the document's distribution. Arrays hold features in rows and
segments in columns. Training uses backpropagation through time on a bounded sample: about ``PER_LANG`` documents of each
language, ``WINDOWS`` segments each. Prediction reads every byte of every text, batch by batch, without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cutline.llm.common import text_batches, uniform

SEGMENT = 96
HIDDEN = 8
PER_LANG = 400
WINDOWS = 4
EPOCHS = 8
BATCH = 128
RATE = 0.02
SIDE = 8192  # segments read side by side
PAD = 256
LETTER = re.compile(r"[^\W\d_]")
UNKNOWN = "und"


def segments(raw: bytes, size: int = SEGMENT) -> np.ndarray:
    """Bytes in rows of ``size``, the last filled with ``PAD``; at least one row."""
    n = max(1, -(-len(raw) // size))
    out = np.full(n * size, PAD, np.int16)
    out[: len(raw)] = np.frombuffer(raw, np.uint8)
    return out.reshape(n, size)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    np.negative(x, out=x)
    np.minimum(x, 60, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


@dataclass
class Direction:
    """One gated recurrent layer: input weights by byte, recurrent weights; rows: update, reset, candidate."""

    inputs: np.ndarray  # 3H x 257
    recurrent: np.ndarray  # 3H x H

    def step(self, x: np.ndarray, h: np.ndarray) -> tuple:
        k = h.shape[0]
        a = np.take(self.inputs, x, axis=1)
        u = self.recurrent @ h
        gates = a[: 2 * k]
        gates += u[: 2 * k]
        _sigmoid(gates)
        z, r = gates[:k], gates[k:]
        n = r * u[2 * k :]
        n += a[2 * k :]
        n *= 2
        _sigmoid(n)
        n *= 2
        n -= 1
        out = h - n
        out *= z
        out += n
        return out, z, r, n, u[2 * k :]

    def run(self, x: np.ndarray, order: range, keep: bool = False) -> tuple[np.ndarray, list]:
        """States at every position of segments ``x`` (rows: positions), and what training needs."""
        h = np.zeros((self.recurrent.shape[1], x.shape[1]), np.float32)
        states, trace = np.empty((x.shape[0], *h.shape), np.float32), []
        for t in order:
            new, *parts = self.step(x[t], h)
            if keep:
                trace.append((t, h, *parts))
            h = states[t] = new
        return states, trace

    def back(self, x: np.ndarray, trace: list, d_states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of the input and recurrent weights by backpropagation through time."""
        k = self.recurrent.shape[1]
        d_in, d_rec = np.zeros((PAD + 1, 3 * k), np.float32), np.zeros_like(self.recurrent)
        dh = np.zeros_like(d_states[0])
        for t, h, z, r, n, u in reversed(trace):
            dh = dh + d_states[t]
            dz = dh * (h - n) * z * (1 - z)
            dn = dh * (1 - z) * (1 - n * n)
            dr = dn * u * r * (1 - r)
            np.add.at(d_in, x[t], np.concatenate([dz, dr, dn]).T)
            du = np.concatenate([dz, dr, dn * r])
            d_rec += du @ h.T
            dh = dh * z + self.recurrent.T @ du
        return d_in.T, d_rec


@dataclass
class Network:
    langs: list[str]
    forward: Direction
    backward: Direction
    out: np.ndarray  # L x (2H + 1), the last column is the bias

    @classmethod
    def fresh(cls, langs: list[str], hidden: int, seed: int) -> "Network":
        rng = np.random.default_rng(seed)

        def direction() -> Direction:
            scale = 1 / np.sqrt(hidden)
            return Direction(rng.normal(0, 0.3, (3 * hidden, PAD + 1)).astype("f4"), rng.uniform(-scale, scale, (3 * hidden, hidden)).astype("f4"))

        return cls(langs, direction(), direction(), rng.normal(0, 0.1, (len(langs), 2 * hidden + 1)).astype("f4"))

    def weights(self) -> list[np.ndarray]:
        return [self.forward.inputs, self.forward.recurrent, self.backward.inputs, self.backward.recurrent, self.out]

    def _probabilities(self, f: np.ndarray, b: np.ndarray) -> np.ndarray:
        k = len(f)
        p = self.out[:, :k] @ f
        p += self.out[:, k : 2 * k] @ b
        p += self.out[:, -1:]
        p -= p.max(axis=0)
        np.exp(p, out=p)
        p /= p.sum(axis=0)
        return p

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross-entropy over the positions that are no padding, and its gradients. x: positions x segments."""
        size, k = x.shape[0], self.forward.recurrent.shape[1]
        fs, f_trace = self.forward.run(x, range(size), True)
        bs, b_trace = self.backward.run(x, range(size - 1, -1, -1), True)
        d_f, d_b, d_out, loss = np.empty_like(fs), np.empty_like(bs), np.zeros_like(self.out), 0.0
        total = max(1, int((x != PAD).sum()))
        for t in range(size):
            p = self._probabilities(fs[t], bs[t])
            real = x[t] != PAD
            loss -= float(np.log(p[y, np.arange(len(y))] + 1e-9)[real].sum())
            p[y, np.arange(len(y))] -= 1
            p *= real / total
            p = p.astype(np.float32)
            d_out[:, :k] += p @ fs[t].T
            d_out[:, k : 2 * k] += p @ bs[t].T
            d_out[:, -1] += p.sum(axis=1)
            d_f[t], d_b[t] = self.out[:, :k].T @ p, self.out[:, k : 2 * k].T @ p
        return loss / total, [*self.forward.back(x, f_trace, d_f), *self.backward.back(x, b_trace, d_b), d_out]

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> "Network":
        """Adam on shuffled batches. x: segments x positions."""
        rng = np.random.default_rng(seed)
        weights = self.weights()
        m, v, turn = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
        for epoch in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), BATCH):
                pick = order[at : at + BATCH]
                _, grads = self.gradients(np.ascontiguousarray(x[pick].T), y[pick])
                norm = float(np.sqrt(sum(float((g * g).sum()) for g in grads)))
                turn += 1
                rate = RATE * 0.5 ** (epoch / 3)
                for w, g, a, b in zip(weights, grads, m, v):
                    g = g * min(1.0, 1.0 / (norm + 1e-9))
                    a += 0.1 * (g - a)
                    b += 0.01 * (g * g - b)
                    w -= rate * (a / (1 - 0.9**turn)) / (np.sqrt(b / (1 - 0.99**turn)) + 1e-6)
        return self

    def pooled(self, raws: list[bytes]) -> np.ndarray:
        """Mean distribution over all positions of each text. Texts x languages."""
        rows = [segments(r) for r in raws]
        owners = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        flat = np.concatenate(rows)
        sums = np.zeros((len(raws), len(self.langs)))
        for at in range(0, len(flat), SIDE):
            x = np.ascontiguousarray(flat[at : at + SIDE].T)
            fs, _ = self.forward.run(x, range(len(x)))
            h = np.zeros_like(fs[0])
            part = np.zeros((len(self.langs), x.shape[1]))
            for t in range(len(x) - 1, -1, -1):
                h = self.backward.step(x[t], h)[0]
                p = self._probabilities(fs[t], h)
                if (pad := x[t] == PAD).any():
                    p[:, pad] = 0
                part += p
            np.add.at(sums, owners[at : at + SIDE], part.T)
        return sums / np.maximum(1, [[len(r)] for r in raws])


def held_out(key: str):
    """True where crc32(key as text) mod 5 is 0; a null key is never learned from."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(0)) % F.lit(5) == F.lit(0)


def training_sample(docs: DataFrame, key: str = "doc_id", per_lang: int = PER_LANG, windows: int = WINDOWS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, segments and labels from about ``per_lang`` documents a language that are not held out."""
    usable = docs.where(~held_out(key) & F.col("lang").isNotNull() & (F.length("text") > 0))
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return [], np.zeros((0, SEGMENT), np.int16), np.zeros(0, np.int64)
    shares = F.element_at(F.create_map(*(F.lit(v) for lang, n in sorted(counts.items()) for v in (lang, min(1.0, per_lang / n)))), F.col("lang"))
    drawn = usable.withColumn("__draw", uniform(F.col(key), 70)).where(F.col("__draw") < shares)
    room = F.greatest(F.length("text") - F.lit(SEGMENT), F.lit(0))
    pieces = [F.substring(F.col("text"), F.floor(uniform(F.col(key), 71 + i) * room).cast("int") + F.lit(1), F.lit(SEGMENT)) for i in range(windows)]
    rows = drawn.select("lang", F.array(*pieces).alias("pieces")).collect()
    langs, taken, x, y = sorted(counts), dict.fromkeys(counts, 0), [], []
    for r in sorted(rows, key=lambda r: (r["lang"], r["pieces"])):
        if taken[r["lang"]] < 2 * per_lang:
            taken[r["lang"]] += 1
            for piece in r["pieces"]:
                x.append(segments(piece.encode("utf-8", "replace"))[0])
                y.append(langs.index(r["lang"]))
    return langs, np.array(x), np.array(y)


def train(docs: DataFrame, key: str = "doc_id", seed: int = 7) -> Network | None:
    """A network fitted to the sample; None if there is nothing to learn from."""
    langs, x, y = training_sample(docs, key)
    return Network.fresh(langs, HIDDEN, seed).fit(x, y) if langs else None


def predict(docs: DataFrame, network: Network | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, held_out, lang_pred, score.

    Reads the text alone. Texts that are null, empty or without a letter get ``und`` and score 0, as does every text if there
    is no network. Rows may repeat. An empty table gives no rows.
    """
    kind = dict(docs.dtypes)[key]
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            texts = batch.column("__text").to_pylist()
            known = [i for i, t in enumerate(texts) if t and net and LETTER.search(t)]
            lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
            if known:
                p = net.pooled([texts[i].encode("utf-8", "replace") for i in known])
                for i, row in zip(known, p):
                    best = int(row.argmax())
                    lang[i], score[i] = net.langs[best], min(1.0, float(row[best]))
            yield pa.RecordBatch.from_arrays([batch.column(key), batch.column("held_out"), pa.array(lang), pa.array(score)], [key, "held_out", "lang_pred", "score"])

    narrow = docs.select(F.col(key), held_out(key).alias("held_out"), F.col(text).alias("__text"))
    return text_batches(narrow, run, f"`{key}` {kind}, held_out boolean, lang_pred string, score double")
