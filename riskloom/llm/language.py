"""Language ID by a bidirectional gated recurrent network over bytes.

The network reads the UTF-8 bytes of a text in windows, once forwards and once backwards,
gives every byte a distribution over the languages from both states, and a document the mean
of the distributions of its bytes. It is trained in numpy by backpropagation through time on
a bounded sample of pieces of labelled texts, taken from anywhere in them. Every byte of
every text is read when predicting.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import bound_batches, table

#: Labelled texts that the network is fitted on at most, and pieces taken from each.
TRAIN_TEXTS, TRAIN_PIECES = 2_500, 6
#: Bytes of a training piece, and bytes that are read in one go when predicting.
TRAIN_BYTES, WINDOW = 64, 128
HIDDEN = 8
UNDEFINED = "und"
_LETTER = regex.compile(r"\p{L}")
_ROWS = 2048


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Gru:
    """One direction: parameters and the two passes over a batch of windows.

    ``wx`` has a row for each byte (256 x 3H, gates update, reset, candidate), ``wh`` maps the
    last state (H x 3H) and ``b`` is added.
    """

    def __init__(self, wx: np.ndarray, wh: np.ndarray, b: np.ndarray) -> None:
        self.wx, self.wh, self.b = wx, wh, b

    def forward(self, x: np.ndarray, keep: bool = False):
        """States after each byte of x (steps, rows); what the backward pass needs, if kept."""
        steps, rows = x.shape
        h_size = self.wh.shape[0]
        h = np.zeros((rows, h_size), dtype=self.wx.dtype)
        table_ = self.wx + self.b
        states = np.empty((steps, rows, h_size), dtype=h.dtype)
        kept = []
        for t in range(steps):
            a = table_[x[t]]
            u = h @ self.wh
            gates = _sigmoid(a[:, :2 * h_size] + u[:, :2 * h_size])
            z, r = gates[:, :h_size], gates[:, h_size:]
            n = np.tanh(a[:, 2 * h_size:] + r * u[:, 2 * h_size:])
            if keep:
                kept.append((h, z, r, n, u[:, 2 * h_size:]))
            h = n + z * (h - n)
            states[t] = h
        return states, kept

    def backward(self, x: np.ndarray, kept: list, grad: np.ndarray) -> list[np.ndarray]:
        """Gradients of wx, wh and b from the gradients of the states."""
        h_size = self.wh.shape[0]
        g_wx, g_wh, g_b = np.zeros_like(self.wx), np.zeros_like(self.wh), np.zeros_like(self.b)
        carried = np.zeros_like(grad[0])
        for t in range(len(x) - 1, -1, -1):
            h, z, r, n, u = kept[t]
            g = grad[t] + carried
            g_n = g * (1 - z) * (1 - n * n)
            g_z = g * (h - n) * z * (1 - z)
            g_r = g_n * u * r * (1 - r)
            g_a = np.concatenate([g_z, g_r, g_n], axis=1)
            g_u = np.concatenate([g_z, g_r, g_n * r], axis=1)
            np.add.at(g_wx, x[t], g_a)
            g_b += g_a.sum(axis=0)
            g_wh += h.T @ g_u
            carried = g * z + g_u @ self.wh.T
        return [g_wx, g_wh, g_b]


@dataclass
class Network:
    """Both directions and the output layer; ``languages`` names its columns."""

    parameters: list[np.ndarray]
    languages: list[str]

    @classmethod
    def start(cls, languages: list[str], hidden: int = HIDDEN, seed: int = 0, kind=np.float32) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda *s, scale: (rng.standard_normal(s) * scale).astype(kind)
        one = lambda: [draw(256, 3 * hidden, scale=0.3), draw(hidden, 3 * hidden, scale=hidden ** -0.5),
                       np.zeros(3 * hidden, dtype=kind)]
        n = len(languages)
        return cls([*one(), *one(), draw(2 * hidden, n, scale=0.3), np.zeros(n, dtype=kind)], languages)

    def loss(self, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross entropy of all bytes of x (steps, rows), and its gradients."""
        p = self.parameters
        ahead, back = Gru(*p[:3]), Gru(*p[3:6])
        f, f_kept = ahead.forward(x, keep=True)
        b, b_kept = back.forward(x[::-1], keep=True)
        both = np.concatenate([f, b[::-1]], axis=2)
        probability = _softmax(both @ p[6] + p[7])
        steps, rows = x.shape
        chosen = probability[:, np.arange(rows), y]
        loss = -np.log(np.maximum(chosen, 1e-12)).mean()
        g = probability
        g[:, np.arange(rows), y] -= 1
        g /= steps * rows
        h_size = p[1].shape[0]
        g_both = g @ p[6].T
        flat = both.reshape(-1, both.shape[2])
        gradients = [
            *ahead.backward(x, f_kept, g_both[:, :, :h_size]),
            *back.backward(x[::-1], b_kept, g_both[::-1, :, h_size:]),
            flat.T @ g.reshape(-1, g.shape[2]), g.sum(axis=(0, 1)),
        ]
        return float(loss), gradients

    def pooled(self, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Sums of the distributions of the bytes of each row of x (steps, rows).

        Rows end after ``lengths`` bytes, shorter ones first; what follows is left out. All
        arrays here have a column for each row, so that every operation runs over
        contiguous numbers.
        """
        p = self.parameters
        h_size = p[1].shape[0]
        steps, rows = x.shape
        scores = np.empty((steps, len(self.languages), rows), dtype=p[0].dtype)
        whole = int(np.searchsorted(lengths, steps))  # rows from here on have no padding
        _score(p[0], p[1], p[2], p[6][:h_size], x, range(steps), whole, lengths, scores, add=False)
        _score(p[3], p[4], p[5], p[6][h_size:], x, range(steps - 1, -1, -1), whole, lengths, scores, add=True)
        scores += p[7][:, None]
        np.clip(scores, -60, 60, out=scores)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=1, keepdims=True)
        if whole:
            scores[:, :, :whole] *= (np.arange(steps)[:, None, None] < lengths[:whole])
        return scores.sum(axis=0, dtype=np.float64).T


def _score(wx, wh, b, out, x, order, whole, lengths, scores, add) -> None:
    """Run one direction over x in ``order`` and put its part of every byte's scores in place."""
    h_size, rows = wh.shape[0], x.shape[1]
    half = np.repeat(np.array([0.5, 1.0], dtype=wx.dtype), [2 * h_size, h_size])  # sigmoid by tanh
    table_, turn, out = ((wx + b) * half).T.copy(), (wh * half).T.copy(), out.T.copy()
    h = np.zeros((h_size, rows), dtype=wx.dtype)
    a, u = np.empty((3 * h_size, rows), dtype=wx.dtype), np.empty((3 * h_size, rows), dtype=wx.dtype)
    gates, z, r, n = a[:2 * h_size], a[:h_size], a[h_size:2 * h_size], a[2 * h_size:]
    for t in order:
        np.take(table_, x[t], axis=1, out=a, mode="clip")
        np.dot(turn, h, out=u)
        gates += u[:2 * h_size]
        np.tanh(gates, out=gates)
        gates *= 0.5
        gates += 0.5
        r *= u[2 * h_size:]
        n += r
        np.tanh(n, out=n)
        h -= n
        h *= z
        h += n
        if add and whole:
            h[:, :whole] *= t < lengths[:whole]  # backwards, padding comes first
        if add:
            scores[t] += out @ h
        else:
            np.dot(out, h, out=scores[t])


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(texts: list[bytes], labels: list[str], rounds: int = 400, rows: int = 256, rate: float = 0.02,
          seed: int = 0, size: int = TRAIN_BYTES) -> Network | None:
    """Fit a network by Adam on pieces of ``size`` bytes; None where there is no text. A language
    that has shorter texts only is learned from these, repeated up to that size."""
    usable = [(t[:size], y) for t, y in zip(texts, labels) if len(t) >= size]
    long = {y for _, y in usable}
    usable += [((t * -(-size // len(t)))[:size], y) for t, y in zip(texts, labels) if t and y not in long]
    if not usable:
        return None
    languages = sorted({y for _, y in usable})
    net = Network.start(languages, seed=seed)
    x = np.frombuffer(b"".join(t for t, _ in usable), np.uint8).reshape(-1, size)
    y = np.searchsorted(languages, [y for _, y in usable])
    # Every language as often as any other.
    members = [np.flatnonzero(y == k) for k in range(len(languages))]
    rng = np.random.default_rng(seed)
    m = [np.zeros_like(p) for p in net.parameters]
    v = [np.zeros_like(p) for p in net.parameters]
    for step in range(1, rounds + 1):
        own = rng.integers(0, len(languages), rows)
        pick = np.array([members[k][rng.integers(0, len(members[k]))] for k in own])
        _, gradients = net.loss(np.ascontiguousarray(x[pick].T), y[pick])
        norm = np.sqrt(sum(float((g * g).sum()) for g in gradients))
        shrink = min(1.0, 1.0 / max(norm, 1e-12))
        now = rate * min(1.0, 2 * (1 - step / (rounds + 1)))
        for p, g, a, b in zip(net.parameters, gradients, m, v):
            g = g * shrink
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p -= (now * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-8)).astype(p.dtype)
    return net


def predict(net: Network | None, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Language and pooled probability of each text."""
    names, scores = [UNDEFINED] * len(texts), np.zeros(len(texts))
    if net is None:
        return names, scores
    known = [i for i, t in enumerate(texts) if t and _LETTER.search(t)]
    pooled = np.zeros((len(known), len(net.languages)))
    totals = np.zeros(len(known))
    held: list[tuple[int, bytes]] = []

    def flush() -> None:
        lengths = np.array([len(w) for _, w in held])
        order = np.argsort(lengths, kind="stable")
        for i in range(0, len(held), _ROWS):
            mine = order[i:i + _ROWS]
            steps = int(lengths[mine].max())
            x = np.frombuffer(b"".join(held[j][1].ljust(steps, b" ") for j in mine), np.uint8).reshape(-1, steps).T
            sums = net.pooled(np.ascontiguousarray(x), lengths[mine])
            np.add.at(pooled, [held[j][0] for j in mine], sums)
        held.clear()

    for k, i in enumerate(known):
        data = texts[i].encode("utf-8", "surrogatepass")
        totals[k] = len(data)
        for a in range(0, len(data), WINDOW):
            held.append((k, data[a:a + WINDOW]))
            if len(held) >= 8 * _ROWS:
                flush()
    if held:
        flush()
    mean = pooled / np.maximum(totals, 1)[:, None]
    for k, i in enumerate(known):
        best = int(mean[k].argmax())
        names[i], scores[i] = net.languages[best], min(1.0, max(0.0, float(mean[k, best])))
    return names, scores


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def quotas(counts: dict[str, int], texts: int) -> dict[str, int]:
    """Texts to take of each language: about ``texts`` in all, as many of each as there are or as
    of any other. With more languages than texts, one of each of the most frequent."""
    order = sorted(counts, key=lambda k: (-counts[k], k))[:texts]
    out, left = {}, texts
    for i, name in enumerate(reversed(order)):
        out[name] = min(counts[name], left // (len(order) - i))
        left -= out[name]
    return out


def training_rows(docs: DataFrame, texts: int = TRAIN_TEXTS) -> DataFrame:
    """Labelled rows of ``docs(doc_id, text, lang)`` with a letter that are not held out, at most
    ``texts`` of them, by a hash of identifier and text: all where there are no more, or else
    the same number of each language as far as it has them."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out(F.col("doc_id"))).select(
        "doc_id", "text", "lang", F.xxhash64("doc_id", "text").alias("_order"))
    counts = {r.lang: r["count"] for r in usable.groupBy("lang").count().collect()}
    taken = quotas(counts, texts)
    # What is put in order stays small: a share by hash, with enough to spare for small quotas.
    shares = [(k, n, int(min(1.0, (4 * n + 64) / counts[k]) * (1 << 40))) for k, n in taken.items()]
    wanted = docs.sparkSession.createDataFrame(shares, "lang string, _quota bigint, _share bigint")
    some = usable.join(F.broadcast(wanted), "lang").where(F.pmod(F.xxhash64("_order", F.lit(5)), F.lit(1 << 40)) < F.col("_share"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("_order"))
    return some.withColumn("_rank", rank).where("_rank <= _quota").drop("_rank", "_quota", "_share")


def fit(docs: DataFrame, texts: int = TRAIN_TEXTS, pieces: int = TRAIN_PIECES) -> Network | None:
    """Train on ``pieces`` pieces of each of ``training_rows``."""
    length = F.greatest(F.length("text") - TRAIN_BYTES, F.lit(1))
    cuts = [F.col("text").substr((F.pmod(F.xxhash64("doc_id", F.lit(k)), length) + 1).cast("int"), F.lit(TRAIN_BYTES))
            for k in range(pieces)]
    rows = training_rows(docs, texts).select("lang", F.array(*cuts).alias("cuts"), "_order").orderBy("_order", "lang").collect()
    data = [(c.encode("utf-8", "surrogatepass"), r.lang) for r in rows for c in r.cuts if c]
    return train([d for d, _ in data], [y for _, y in data])


def identify(docs: DataFrame, net: Network | None, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score``.

    ``und`` with score 0 where the text is null or has no letter, or where nothing was learned.
    Ties between languages go to the first in alphabetical order. An empty table gives an
    empty result. Only the text column is read; others are kept, whatever their names.
    """
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(net)  # a fixed number of weights
    kind = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    @F.pandas_udf(kind)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            names, scores = predict(shared.value, batch.tolist())
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    found = docs.select(F.struct(*docs.columns).alias("_row"), run(F.col(text)).alias("_found"))
    return found.select("_row.*", "_found.lang_pred", "_found.score")


def op5_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return identify(docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"), fit(docs)).drop("text")


#: A document of the pipeline whose pooled probability is lower counts as no language.
LEAST_SCORE = 0.3


def stage(spark, docs, sf_dir):
    """Pipeline stage: documents without a language go, the others stay as they were.

    Null and empty texts and texts without a letter go; rows that repeat stay or go together;
    an empty table gives an empty result; all columns come back, whatever their names. Where no labelled text
    teaches a language, none can be told from another and every document stays.
    """
    net = fit(docs)
    if net is None:
        return docs
    rows = docs.select(F.struct(*docs.columns).alias("all_columns"), F.col("text").alias("whole_text"))
    found = identify(rows, net, text="whole_text")
    return found.where((F.col("lang_pred") != UNDEFINED) & (F.col("score") >= LEAST_SCORE)).select("all_columns.*")
