"""Scoring texts with a Katz backoff language model learned from the same table.

The model. ``p1(w) = d c(w) / N``; what the discounts ``d`` leave over is the probability of
the one class of unknown words. For a history h seen in training,

    p(w | h) = d c(hw) / c(h)         where hw was seen, and
             = alpha(h) p(w | h')     elsewhere, h' being h without its first word;

alpha(h) is what the discounts leave over, divided by one minus the sum of p(w | h') over the
words seen after h, so that every distribution sums to one exactly. A history never seen hands
over to h' unchanged. Counts up to ``LARGEST_DISCOUNTED`` get Good-Turing discounts from the
counts of counts of their order; where those do not lie between 0 and 1, as in tiny corpora, an
absolute discount takes their place. A history without any discounted count gives one part in
c(h) + 1 away. A text starts after a begin mark and ends with an end token.

How it runs. Texts are tokenised once into chunks of a million tokens, stored as numbers. For
each order, every chunk sends its distinct n-grams with their counts, and with the probability of
their last word one order lower, to buckets of the history (a frequent history has as many
buckets as its count asks for). A bucket adds up counts and returns to every chunk the counts of just the
n-grams that it sent, and what alpha needs of their histories. So the tables of n-grams are
partitioned, no chunk holds more of them than it uses, and orders follow one another by the
recursion above. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import bound_batches, table
from riskloom.session import durable

ORDER = 2
LARGEST_DISCOUNTED = 5
CHUNK_TOKENS = 1_000_000
#: Distinct n-grams of all chunks that a bucket takes, more or less.
BUCKET_TOKENS = 1_500_000
#: A history of so many tokens may be split over buckets.
FREQUENT = 50_000
#: Stands for the end of a text; no word holds a space.
END = b" "
_PIECE = 4 << 20
_BEGIN, _UNKNOWN, _ASKED = -2, -1, -3
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_SENT = "bucket int, chunk bigint, data binary"
_RETURNED = "bucket int, chunk bigint, data binary, tally array<bigint>"


# Numbers in few bytes

def pack(values: np.ndarray) -> bytes:
    """Numbers as compressed byte planes; whole numbers from 0 on take the fewest bytes that hold them."""
    if values.dtype.kind == "b":
        values = values.astype(np.uint8)
    if values.dtype.kind in "iu" and (not len(values) or values.min() >= 0):
        values = values.astype(np.min_scalar_type(int(values.max(initial=0))))
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.dtype.itemsize).T
    return values.dtype.str.encode().ljust(4) + zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes) -> np.ndarray:
    kind = np.dtype(data[:4].decode().strip())
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[4:]), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(kind.itemsize, -1).T).view(kind).ravel()


def bundle(*arrays: np.ndarray) -> bytes:
    parts = [pack(a) for a in arrays]
    return struct.pack(f"<{len(parts) + 1}I", len(parts), *map(len, parts)) + b"".join(parts)


def unbundle(data: bytes) -> list[np.ndarray]:
    n = struct.unpack_from("<I", data)[0]
    out, at = [], 4 * (n + 1)
    for size in struct.unpack_from(f"<{n}I", data, 4):
        out.append(unpack(data[at:at + size]))
        at += size
    return out


def mixed(values: np.ndarray) -> np.ndarray:
    """Evenly spread 64-bit numbers."""
    x = values.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


# The model's numbers

def discounts(counts_of_counts: list[int]) -> np.ndarray:
    """Factors for counts 0, 1, ... ``LARGEST_DISCOUNTED``; the first is of no use."""
    k, n = LARGEST_DISCOUNTED, [0, *counts_of_counts]
    r = np.arange(1, k + 1)
    if all(n[1:k + 2]):
        common = (k + 1) * n[k + 1] / n[1]
        found = (((r + 1) * np.array(n[2:k + 2]) / (r * np.array(n[1:k + 1])) - common) / (1 - common)
                 if common < 1 else np.zeros(k))
        if ((found > 0) & (found < 1)).all():
            return np.r_[1.0, found]
    less = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
    return np.r_[1.0, (r - less) / r]


class Order:
    """What the whole corpus says about one order."""

    def __init__(self, tally: list[int]) -> None:
        self.tokens, self.types, *counts = tally
        self.factors = discounts(counts)
        left = float(sum((1 - self.factors[r]) * r * counts[r - 1] for r in range(1, LARGEST_DISCOUNTED + 1)))
        #: For order one: the total that counts are divided by, and the share of unknown words.
        self.total = self.tokens if left > 0 else self.tokens + 1
        self.unknown = (left if left > 0 else 1.0) / self.total

    def discounted(self, counts: np.ndarray) -> np.ndarray:
        return counts * np.where(counts <= LARGEST_DISCOUNTED, self.factors[np.minimum(counts, LARGEST_DISCOUNTED)], 1.0)


# Texts to chunks

def _words(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text in pieces, so that a very long one is never a list of words as a whole."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()
    at = 0
    while len(data) - at > _PIECE:
        gap = _SPACE.search(data, at + _PIECE)
        if gap is None:
            break
        yield data[at:gap.start()].split()
        at = gap.end()
    yield [*data[at:].split(), END]


class _Chunk:
    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}
        self.codes: list[np.ndarray] = []
        self.waiting: list[bytes] = []
        self.ids: list = []
        self.held: list[bool] = []
        self.sizes: list[int] = []
        self.tokens = 0

    def code(self) -> None:
        if self.waiting:
            words = np.empty(len(self.waiting), dtype=object)
            words[:] = self.waiting
            codes, distinct = pd.factorize(words)
            own = np.array([self.known.setdefault(w, len(self.known)) for w in distinct], dtype=np.int32)
            self.codes.append(own[codes])
            self.waiting = []

    def add(self, key, held: bool, text: str | None) -> None:
        size = 0
        for words in _words(text):
            size += len(words)
            self.waiting += words
            if len(self.waiting) > 300_000:
                self.code()
        self.ids.append(key)
        self.held.append(held)
        self.sizes.append(size)
        self.tokens += size

    def batch(self, number: int, schema: pa.Schema) -> pa.RecordBatch:
        self.code()
        hashes = np.array([xxhash.xxh64_intdigest(w, 7) for w in self.known], dtype=np.uint64)
        hashes, place = np.unique(hashes, return_inverse=True)
        codes = place[np.concatenate(self.codes)].astype(np.int64)
        sizes = np.array(self.sizes, dtype=np.int64)
        held = np.array(self.held, dtype=bool)
        counts = np.bincount(codes[~np.repeat(held, sizes)], minlength=len(hashes))
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([self.ids], schema.field("ids").type), pa.array([int((~held).sum())], pa.int64()),
             pa.array([self.tokens], pa.int64()), pa.array([bundle(hashes, counts)], pa.binary()),
             pa.array([bundle(codes, sizes, held)], pa.binary())], schema=schema)


def _chunked(batches: Iterator[pa.RecordBatch], chunk_tokens: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    first, made, chunk, schema = TaskContext.get().partitionId() << 32, 0, _Chunk(), None
    for batch in batches:
        schema = schema or pa.schema([("chunk", pa.int64()), ("ids", pa.list_(batch.schema.field(0).type)), ("trained", pa.int64()),
                                      ("tokens", pa.int64()), ("words", pa.binary()), ("body", pa.binary())])
        for key, held, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            chunk.add(key, held, text.as_py())
            if chunk.tokens >= chunk_tokens:
                yield chunk.batch(first + made, schema)
                made, chunk = made + 1, _Chunk()
    if chunk.ids:
        yield chunk.batch(first + made, schema)


# Order one: words

def _word_buckets(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each word: ranges of the hash, so that words sorted by hash lie in the order of buckets."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _sent(chunk: int, bucket: np.ndarray, cut, names=("bucket", "chunk", "data")) -> dict:
    """A row for each run of equal numbers in ``bucket``; ``cut`` makes its data."""
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.array([], int)
    ends = np.r_[starts[1:], len(bucket)]
    return dict(zip(names, ([int(bucket[s]) for s in starts], [chunk] * len(starts),
                            [cut(slice(int(s), int(e))) for s, e in zip(starts, ends)])))


def _send_words(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk, words in zip(batch.column(0).to_pylist(), batch.column(1)):
            hashes, counts = unbundle(words.as_py())
            rows = _sent(chunk, _word_buckets(hashes, buckets), lambda s: bundle(hashes[s], counts[s]))
            yield pa.RecordBatch.from_pydict(rows, schema=_arrow(_SENT))


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in ddl.split(", "))])


def _tally(counts: np.ndarray) -> list[int]:
    """Tokens, types, and how many types have each of the smallest counts."""
    return [int(counts.sum()), int((counts > 0).sum()),
            *np.bincount(counts[counts <= LARGEST_DISCOUNTED + 1], minlength=LARGEST_DISCOUNTED + 2)[1:].tolist()]


def _returned(bucket: int, chunks: list[int], data: list[bytes], counts: np.ndarray) -> pa.Table:
    """What goes back to the chunks, and a last row that counts for the corpus."""
    n = len(chunks)
    return pa.Table.from_pydict({"bucket": [bucket] * (n + 1), "chunk": [*chunks, -1], "data": [*data, None],
                                 "tally": [None] * n + [_tally(counts)]}, schema=_arrow(_RETURNED))


def _count_words(rows: pa.Table) -> pa.Table:
    sent = [unbundle(d) for d in rows["data"].to_pylist()]
    sizes = [len(h) for h, _ in sent]
    hashes, place = np.unique(np.concatenate([h for h, _ in sent]), return_inverse=True)
    counts = np.bincount(place, np.concatenate([c for _, c in sent]), len(hashes)).astype(np.int64)
    own = np.split(place, np.cumsum(sizes)[:-1])
    bucket = rows["bucket"][0].as_py()
    # Words never seen in training get no number.
    number = np.where(counts > 0, (bucket << 40) | np.cumsum(counts > 0), 0)
    return _returned(bucket, rows["chunk"].to_pylist(), [bundle(counts[p], number[p]) for p in own], counts)


# Higher orders

class Grams:
    """The distinct n-grams of a chunk in the order in which they are sent."""

    def __init__(self, history: np.ndarray, seen: np.ndarray, word: np.ndarray, number: np.ndarray, low: np.ndarray,
                 train: np.ndarray, buckets: int, share: int) -> None:
        """By token: key and count of the history (0: unseen), local word code, global word number,
        probability one order lower, whether it counts for training. ``share``: the count up to
        which a history has one bucket."""
        self.at = np.flatnonzero(seen > 0)
        keys, place = np.unique(history[self.at], return_inverse=True)
        words = int(word.max(initial=0)) + 1
        pair, first, self.of = np.unique(place * words + word[self.at], return_index=True, return_inverse=True)
        own, count = pair // words, np.zeros(len(keys), dtype=np.int64)
        count[place] = seen[self.at]
        n = np.bincount(self.of[train[self.at]], minlength=len(pair))
        number, low = number[self.at][first], low[self.at][first]
        # Every bucket of a frequent history is asked for its part of what alpha needs.
        split = np.minimum(-(-count // share), buckets)
        many = np.flatnonzero(split > 1)
        asked = np.repeat(many, split[many])
        turn = np.arange(len(asked)) - np.repeat(np.cumsum(split[many]) - split[many], split[many])
        home = (mixed(keys) % np.uint64(buckets)).astype(np.int64)
        bucket = home[own] + (mixed(number) % split[own].astype(np.uint64)).astype(np.int64)
        bucket = np.r_[bucket, home[asked] + turn] % buckets
        own, number = np.r_[own, asked], np.r_[number, np.full(len(asked), _ASKED)]
        order = np.lexsort((number, own, bucket))
        self.rank = np.empty(len(order), dtype=np.int64)
        self.rank[order] = np.arange(len(order))
        self.bucket, self.own, self.number = bucket[order], own[order], number[order]
        self.n = np.r_[n, np.zeros(len(asked), np.int64)][order]
        self.low = np.r_[low, np.zeros(len(asked))][order]
        self.keys, self.count, self.home = keys, count, place

    def cut(self, s: slice) -> bytes:
        own = self.own[s]
        starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        values, codes = np.unique(self.low[s], return_inverse=True)
        return bundle(self.keys[own[starts]], np.diff(np.r_[starts, len(own)]), self.number[s], self.n[s], values, codes)

    def take(self, data: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """From the buckets' answers, in their order: count of each n-gram, and by history how many
        words have each small count and the sum of their probabilities one order lower."""
        answers = [unbundle(d) for d in data]
        counts = np.concatenate([a[0] for a in answers]).astype(np.int64)
        small = np.zeros((LARGEST_DISCOUNTED, len(self.keys)), dtype=np.int64)
        low = np.zeros(len(self.keys))
        fresh = np.r_[True, (self.own[1:] != self.own[:-1]) | (self.bucket[1:] != self.bucket[:-1])]
        own = self.own[fresh]
        for r in range(LARGEST_DISCOUNTED):
            np.add.at(small[r], own, np.concatenate([a[1 + r] for a in answers]).astype(np.int64))
        np.add.at(low, own, np.concatenate([a[1 + LARGEST_DISCOUNTED] for a in answers]))
        return counts, small, low


def _count_grams(rows: pa.Table) -> pa.Table:
    sent = [unbundle(d) for d in rows["data"].to_pylist()]
    history = np.concatenate([np.repeat(keys, runs.astype(np.int64)) for keys, runs, *_ in sent])
    number = np.concatenate([s[2].astype(np.int64) for s in sent])
    n = np.concatenate([s[3] for s in sent])
    low = np.concatenate([s[4][s[5]] for s in sent])
    keys, own = np.unique(history, return_inverse=True)
    words, word = np.unique(number, return_inverse=True)
    pair, first, place = np.unique(own * len(words) + word, return_index=True, return_inverse=True)
    counts = np.bincount(place, n, len(pair)).astype(np.int64)
    home = own[first]
    small = [np.bincount(home[counts == r], minlength=len(keys)) for r in range(1, LARGEST_DISCOUNTED + 1)]
    below = np.bincount(home[counts > 0], low[first][counts > 0], len(keys))
    data, at = [], 0
    for s in sent:
        size = len(s[2])
        heads = own[at + np.r_[0, np.cumsum(s[1].astype(np.int64))[:-1]]]
        data.append(bundle(counts[place[at:at + size]], *[x[heads] for x in small], below[heads]))
        at += size
    return _returned(rows["bucket"][0].as_py(), rows["chunk"].to_pylist(), data, counts)


# Chunks with what came back

class _State:
    """A chunk's tokens with what is known of them up to some order."""

    def __init__(self, own: dict, answers: pa.Table, orders: list[Order], trained: int, buckets: int, share: int) -> None:
        self.ids = own["ids"]
        codes, self.sizes, held = unbundle(own["body"])
        codes, self.sizes, self.held = codes.astype(np.int64), self.sizes.astype(np.int64), held.astype(bool)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.train = ~np.repeat(self.held, self.sizes)
        by_order: dict[int, list[tuple[int, bytes]]] = {}
        for order, bucket, data in zip(*(answers[c].to_pylist() for c in ("gram", "bucket", "data"))):
            by_order.setdefault(order, []).append((bucket, data))
        data = {order: [d for _, d in sorted(found, key=lambda x: x[0])] for order, found in by_order.items()}

        # Words are in the order of their buckets.
        count, number = (np.concatenate(a).astype(np.int64) for a in zip(*map(unbundle, data[1])))
        number = np.where(count > 0, number, _UNKNOWN)
        # Unknown words are one class.
        self.word = np.where(count > 0, np.arange(len(count)), len(count))[codes]
        self.number, self.count = number[codes], count[codes]
        first = orders[0]
        self.p = np.where(count > 0, first.discounted(count) / first.total, first.unknown)[codes]

        begins = np.zeros(len(codes), dtype=bool)
        begins[self.starts] = True
        key, seen = self.number, self.count
        for level in range(2, len(orders) + 2):
            # The n-gram that ends with the token before is the history.
            key, seen = np.r_[0, key[:-1]], np.r_[0, seen[:-1]]
            key[begins], seen[begins] = _BEGIN, trained if level == 2 else 0
            grams = Grams(key, seen, self.word, self.number, self.p, self.train, buckets, share)
            if level > len(orders):
                self.grams = grams
                return
            key, seen = self._apply(grams, data.get(level, []), orders[level - 1], key)

    def _apply(self, grams: Grams, data: list[bytes], order: Order, history: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of the next order; keys and counts of its n-grams by token."""
        seen = np.zeros(len(history), dtype=np.int64)
        if len(grams.at):
            counts, small, low = grams.take(data)
            r = np.arange(1, LARGEST_DISCOUNTED + 1)
            left = ((1 - order.factors[1:]) * r) @ small
            total = np.where(left > 0, grams.count, grams.count + 1)
            alpha = np.where(left > 0, left, 1.0) / total / (1 - low)
            c = counts[grams.rank[grams.of]]
            seen[grams.at] = c
            self.p[grams.at] = np.where(c > 0, order.discounted(c) / total[grams.home], alpha[grams.home] * self.p[grams.at])
        return mixed(mixed(history).view(np.int64) + self.number).view(np.int64), seen


def _send_grams(*settings):
    def send(own: pa.Table, answers: pa.Table) -> pa.Table:
        rows = {"bucket": [], "chunk": [], "data": []}
        if len(own):
            grams = _State(own.to_pylist()[0], answers, *settings).grams
            rows = _sent(own["chunk"][0].as_py(), grams.bucket, grams.cut)
        return pa.Table.from_pydict(rows, schema=_arrow(_SENT))

    return send


def _scores(own: pa.Table, answers: pa.Table, id_type: pa.DataType, orders: list[Order], trained: int, buckets: int, share: int) -> pa.Table:
    columns = ["_id", "held_out", "n_tokens", "n_known", "base_score", "score"]
    if not len(own):
        return pa.Table.from_arrays([pa.array([], id_type), pa.array([], pa.bool_()), *[pa.array([], pa.int64())] * 2,
                                     *[pa.array([], pa.float64())] * 2], names=columns)
    state = _State(own.to_pylist()[0], answers, orders, trained, buckets, share)
    base = np.log10((state.count + 1) / (orders[0].tokens + orders[0].types + 1))
    return pa.Table.from_arrays(
        [pa.array(state.ids, id_type), pa.array(state.held), pa.array(state.sizes),
         pa.array(np.add.reduceat((state.count > 0).astype(np.int64), state.starts)),
         pa.array(np.add.reduceat(base, state.starts)), pa.array(np.add.reduceat(np.log10(state.p), state.starts))], names=columns)


def katz_scores(docs: DataFrame, text: str = "text", key: str = "doc_id", held_out: Column | None = None, order: int = ORDER,
                chunk_tokens: int = CHUNK_TOKENS, bucket_tokens: int = BUCKET_TOKENS, frequent: int = FREQUENT) -> DataFrame:
    """log10 probabilities of whole texts.

    Tokens are the runs of characters other than space and U+0009 to U+000D, A-Z in lower case,
    and one end token; a null text counts as empty. The model of order ``order`` is learned from all
    rows for which ``held_out`` (default: nowhere) does not hold, and scores every row; a
    null in that condition counts as false.

    Returns a row per row of ``docs``, repeats included: the key (null as it is), ``held_out``, ``n_tokens``,
    ``n_known`` (tokens seen in training), ``train_tokens`` (their number N), ``base_score`` (the
    sum of log10((c + 1) / (N + V + 1)) over tokens, c being the token's count and V the number
    of distinct ones) and ``score`` (the sum of the model's log10 probabilities). Without any
    training text every word is unknown and of probability one. An empty table gives an empty
    result; other columns are ignored. A text of any length is cut into words piece by piece,
    and its tokens, numbers by then, are held by one task.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    kind = docs.schema[key].dataType
    held = F.lit(False) if held_out is None else F.coalesce(held_out, F.lit(False))
    layout = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("ids", T.ArrayType(kind)),
                           *T.StructType.fromDDL("trained bigint, tokens bigint, words binary, body binary").fields])
    chunks = durable(docs.select(F.col(key).alias("_id"), held.alias("_held"), F.col(text).alias("_text")).mapInArrow(
        lambda b: _chunked(b, chunk_tokens), layout))
    tokens, trained = (int(v or 0) for v in chunks.agg(F.sum("tokens"), F.sum("trained")).first())
    buckets = max(1, -(-tokens // bucket_tokens))
    share = max(frequent, tokens // (4 * buckets))

    sent = chunks.select("chunk", "words").mapInArrow(lambda b: _send_words(b, buckets), _SENT)
    answers, orders = _answers(sent, _count_words, 1)
    for level in range(2, order + 1):
        settings = (list(orders), trained, buckets, share)
        sent = _with_answers(chunks, answers).applyInArrow(_send_grams(*settings), _SENT)
        more, about = _answers(sent, _count_grams, level)
        answers, orders = answers.unionByName(more), orders + about
    result = T.StructType([T.StructField("_id", kind), *T.StructType.fromDDL(
        "held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double").fields])
    id_type = chunks.limit(0).select("ids").toArrow().schema.field(0).type.value_type
    scored = _with_answers(chunks, answers).applyInArrow(
        lambda own, found: _scores(own, found, id_type, orders, trained, buckets, share), result)
    return scored.select(F.col("_id").alias(key), "held_out", "n_tokens", "n_known",
                         F.lit(orders[0].tokens).cast("bigint").alias("train_tokens"), "base_score", "score")


def _with_answers(chunks: DataFrame, answers: DataFrame):
    found = answers.where("chunk >= 0").select("chunk", "gram", "bucket", "data")
    return chunks.select("chunk", "ids", "body").groupBy("chunk").cogroup(found.groupBy("chunk"))


def _answers(sent: DataFrame, count, level: int) -> tuple[DataFrame, list[Order]]:
    """The buckets' answers, stored, and what they say about the order as a whole."""
    found = durable(sent.groupBy("bucket").applyInArrow(count, _RETURNED).withColumn("gram", F.lit(level)))
    tally = [0] * (LARGEST_DISCOUNTED + 3)
    for r in found.where("chunk < 0").select(F.posexplode("tally")).groupBy("pos").agg(F.sum("col").alias("n")).collect():
        tally[r["pos"]] = r["n"]
    return found, [Order(tally)]


def op13_katz_scores(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return katz_scores(docs, held_out=held)
