"""Language ID: a bidirectional gated recurrent network over bytes.

The network reads the bytes of a text in both directions and gives every position a
probability for each language; a document's probabilities are the means over all of
its positions.  Texts are read in segments (``SEGMENT`` bytes, of which none is left
out); the state starts anew in each, which keeps the recurrence short and lets a task
run thousands of segments side by side.

Training is backpropagation through time in numpy, on a bounded sample: ``max_rows``
documents of each language, in the order of a hash of doc_id, and ``STEPS`` batches of
segments from them.  Everything is predicted with the trained network.

Defined results: a null text, or one without a letter, is ``und`` with score 0, as is
every text if there is nothing to learn from.  With one language in the sample all
other texts get it.  Repeated rows get the same result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.llm.common import held_out, pieces, ranges, renamed, replacing, shared, with_fields
from demandspark.llm.toxicity import labelled_sample

HIDDEN = 8
SEGMENT = 128
MAX_ROWS = 400
BATCH, BATCH_BYTES, STEPS, RATE = 256, 48, 350, 0.02
#: Segments that run side by side.
LANES = 4096
UNKNOWN = "und"


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


@dataclass
class Direction:
    """One direction: gate inputs of each byte (reset, update, new), recurrent weights, bias of the new state."""

    byte: np.ndarray
    state: np.ndarray
    bias: np.ndarray

    def step(self, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
        n = HIDDEN
        a, u = self.byte[x], h @ self.state
        gates = _sigmoid(a[:, : 2 * n] + u[:, : 2 * n])
        r, z = gates[:, :n], gates[:, n:]
        inner = u[:, 2 * n :] + self.bias
        new = np.tanh(a[:, 2 * n :] + r * inner)
        return new + z * (h - new), r, z, new, inner

    def run(self, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """States at all positions of segments (descending lengths)."""
        out = np.zeros((*x.shape, HIDDEN), np.float32)
        h = np.zeros((len(x), HIDDEN), np.float32)
        for t in range(x.shape[1]):
            live = int(np.searchsorted(-lengths, -t, "left"))
            h[:live] = self.step(x[:live, t], h[:live])[0]
            out[:live, t] = h[:live]
        return out

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, list]:
        h, trace, out = np.zeros((len(x), HIDDEN), np.float32), [], []
        for t in range(x.shape[1]):
            new_h, *kept = self.step(x[:, t], h)
            trace.append((h, *kept))
            h = new_h
            out.append(h)
        return np.stack(out, 1), trace

    def backward(self, x: np.ndarray, trace: list, d_out: np.ndarray) -> list[np.ndarray]:
        """Gradients of byte, state and bias from those of the states."""
        d_state, d_bias = np.zeros_like(self.state), np.zeros_like(self.bias)
        d_in = np.zeros((*x.shape, 3 * HIDDEN), np.float32)
        dh = np.zeros((len(x), HIDDEN), np.float32)
        for t in range(x.shape[1] - 1, -1, -1):
            before, r, z, new, inner = trace[t]
            dh = dh + d_out[:, t]
            d_new = dh * (1 - z) * (1 - new * new)
            d_z = dh * (before - new) * z * (1 - z)
            d_r = d_new * inner * r * (1 - r)
            d_inner = d_new * r
            d_in[:, t] = np.concatenate([d_r, d_z, d_new], 1)
            d_u = np.concatenate([d_r, d_z, d_inner], 1)
            d_state += before.T @ d_u
            d_bias += d_inner.sum(0)
            dh = dh * z + d_u @ self.state.T
        flat, where = d_in.reshape(-1, 3 * HIDDEN), x.ravel()
        d_byte = np.stack([np.bincount(where, flat[:, k], minlength=256) for k in range(3 * HIDDEN)], 1).astype(np.float32)
        return [d_byte, d_state, d_bias]


@dataclass
class Network:
    languages: list[str]
    ahead: Direction
    back: Direction
    out: np.ndarray
    out_bias: np.ndarray

    @property
    def parameters(self) -> list[np.ndarray]:
        return [*[p for d in (self.ahead, self.back) for p in (d.byte, d.state, d.bias)], self.out, self.out_bias]

    def labels(self, hidden: np.ndarray) -> np.ndarray:
        """Probabilities of each language from the states of both directions."""
        e = hidden @ self.out + self.out_bias
        e = np.exp(e - e.max(-1, keepdims=True))
        return e / e.sum(-1, keepdims=True)

    def pooled(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The mean over all positions, for each row; zeros for an empty one."""
        size = np.diff(offsets)
        count = -(-size // SEGMENT)
        row = np.repeat(np.arange(len(size)), count)
        nth = ranges(np.zeros(len(size), np.int64), count)
        start = offsets[:-1][row] + nth * SEGMENT
        length = np.minimum(SEGMENT, offsets[1:][row] - start)
        order = np.argsort(-length, kind="stable")
        total = np.zeros((len(size), len(self.languages)))
        for i in range(0, len(order), LANES):
            part = order[i : i + LANES]
            n = length[part]
            t = np.arange(n[0])
            inside = t[None, :] < n[:, None]
            x = data[np.minimum(start[part][:, None] + t, len(data) - 1)]
            mirrored = np.where(inside, n[:, None] - 1 - t, t)
            back = self.back.run(np.take_along_axis(x, mirrored, 1), n)
            back = np.take_along_axis(back, mirrored[:, :, None], 1)
            p = self.labels(np.concatenate([self.ahead.run(x, n), back], 2))
            sums = (p * inside[:, :, None]).sum(1)
            for k in range(len(self.languages)):
                total[:, k] += np.bincount(row[part], sums[:, k], minlength=len(size))
        return total / np.maximum(size, 1)[:, None]


def new_network(languages: list[str], rng: np.random.Generator) -> Network:
    def normal(*shape):
        return (rng.normal(size=shape) * 0.3).astype(np.float32)

    def direction():
        return Direction(normal(256, 3 * HIDDEN), normal(HIDDEN, 3 * HIDDEN), np.zeros(HIDDEN, np.float32))

    return Network(languages, direction(), direction(), normal(2 * HIDDEN, len(languages)), np.zeros(len(languages), np.float32))


def gradients(net: Network, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy of all positions of a batch, and its gradients in the order of the parameters."""
    ahead, trace_a = net.ahead.forward(x)
    flipped = np.ascontiguousarray(x[:, ::-1])
    back, trace_b = net.back.forward(flipped)
    hidden = np.concatenate([ahead, back[:, ::-1]], 2)
    p = net.labels(hidden)
    rows = np.arange(len(y))
    loss = -np.log(p[rows, :, y] + 1e-9).mean()
    d = p.copy()
    d[rows, :, y] -= 1
    d /= d.shape[0] * d.shape[1]
    d_hidden = d @ net.out.T
    flat = hidden.reshape(-1, hidden.shape[2])
    grads = [
        *net.ahead.backward(x, trace_a, d_hidden[:, :, :HIDDEN]),
        *net.back.backward(flipped, trace_b, np.ascontiguousarray(d_hidden[:, ::-1, HIDDEN:])),
        flat.T @ d.reshape(-1, d.shape[2]),
        d.sum((0, 1)),
    ]
    return float(loss), grads


def fit(texts: list[str], languages: np.ndarray, steps: int = STEPS, seed: int = 11) -> Network:
    """Adam on batches of segments; every language has the same share of each batch."""
    names = sorted({str(x) for x in languages})
    rng = np.random.default_rng(seed)
    net = new_network(names, rng)
    raw = [t.encode() for t in texts]
    groups = [[r for r, g in zip(raw, languages, strict=True) if str(g) == name and len(r) >= BATCH_BYTES] for name in names]
    groups = [g or [r + b" " * BATCH_BYTES for r, x in zip(raw, languages, strict=True) if str(x) == name] for g, name in zip(groups, names, strict=True)]
    if len(names) < 2:
        return net
    params = net.parameters
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        y = np.arange(BATCH) % len(names)
        x = np.zeros((BATCH, BATCH_BYTES), np.uint8)
        for i, k in enumerate(y):
            text = groups[k][rng.integers(len(groups[k]))]
            at = rng.integers(len(text) - BATCH_BYTES + 1)
            x[i] = np.frombuffer(text, np.uint8, BATCH_BYTES, at)
        _, grads = gradients(net, x, y)
        rate = RATE * (1 - 0.9 * step / steps)
        for p, g, a, b in zip(params, grads, m, v, strict=True):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-7)
    return net


def train(docs: DataFrame, max_rows: int = MAX_ROWS) -> Network | None:
    known = renamed(docs, doc_id="doc_id", lang="lang", text="text").where("text is not null and lang is not null")
    texts, languages = labelled_sample(known, known, "lang", max_rows)
    return fit(texts, languages) if texts else None


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    ascii_letter = np.concatenate([[0], np.cumsum(((data | 32) >= 97) & ((data | 32) <= 122))])
    found = np.diff(ascii_letter[offsets]) > 0
    for i in np.flatnonzero(~found):
        found[i] = any(c.isalpha() for c in data[offsets[i] : offsets[i + 1]].tobytes().decode())
    return found


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """``docs`` with lang_pred and score, which replace columns of these names."""
    fields = "lang_pred string, score double"
    docs = replacing(docs, fields)
    names, sent = docs.columns, shared(docs.sparkSession, net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = sent.value
        for batch, data, offsets in pieces(batches):
            known = has_letter(data, offsets) if net is not None else np.zeros(batch.num_rows, bool)
            p = net.pooled(data, offsets) if net is not None else np.zeros((batch.num_rows, 1))
            best = p.argmax(1)
            languages = [net.languages[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist(), strict=True)]
            score = np.where(known, np.clip(p[np.arange(len(p)), best], 0, 1), 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(languages, pa.string()), pa.array(score, pa.float64())], names=[*names, "lang_pred", "score"])

    return docs.mapInArrow(run, with_fields(docs.schema, fields))


def language_digest(docs: DataFrame) -> DataFrame:
    """Per document: whether its language may not be learned from, the language and its probability."""
    found = predict(renamed(docs, doc_id="doc_id", text="text"), train(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
