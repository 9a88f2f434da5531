"""Best-fit packing by a configuration linear program.

Texts become token pieces on the executors; from there only the histogram of piece lengths,
at most ``capacity`` numbers, decides the packing. A configuration is a multiset of lengths
that fits one sequence. The fractional covering program over all configurations is solved
by multiplicative weights: lengths not yet covered gain weight, and the next configuration
is the heaviest one, found by an unbounded-knapsack dynamic program. The fractional uses are
rounded down to whole numbers and what is left over, a remainder that does not grow with the
data, is packed best fit. Every use count is a number, so neither the driver's work nor the
plan grows with the number of pieces; pieces find their place from their rank within their
length by binary search in the plan.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import bound_batches, numbered, table
from riskloom.session import durable

CAPACITY = 2048
END = 0
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def _tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(maxsize=2)
def encoder(path: str) -> tiktoken.Encoding:
    """The byte-level BPE of a tokenizers file. Vocabulary order is merge order there, so the
    same merges run in the faster library; special tokens in a text count as such in both."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {chr(b): b for b in kept}
    shown |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(kept))}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(shown[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding(
        "byte-bpe", mergeable_ranks=ranks, special_tokens=special,
        pat_str=r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens; the first takes the remainder."""
    if n <= capacity:
        return [(0, n)]
    head = n % capacity
    starts = ([0] if head else []) + list(range(head, n, capacity))
    return [(s, head if s == 0 and head else capacity) for s in starts]


def _pieces(batches: Iterator[pa.RecordBatch], path: str, capacity: int) -> Iterator[pa.RecordBatch]:
    encode = encoder(path)
    for batch in batches:
        ids, pieces, starts, lengths, sums = [], [], [], [], []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            tokens = encode.encode_to_numpy(text.as_py() or "", allowed_special="all")
            tokens = np.append(tokens, END).astype("<u4")
            for k, (start, length) in enumerate(cut(len(tokens), capacity)):
                ids.append(doc)
                pieces.append(k)
                starts.append(start)
                lengths.append(length)
                sums.append(zlib.crc32(tokens[start:start + length].tobytes()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(pieces, pa.int32()), pa.array(starts, pa.int64()),
             pa.array(lengths, pa.int64()), pa.array(sums, pa.int64())],
            names=["doc_id", "piece", "start", "length", "ids_crc32"])


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    bound_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        lambda batches: _pieces(batches, path, capacity), PIECES)


def _heaviest(lengths: np.ndarray, fits: np.ndarray, values: np.ndarray, capacity: int) -> np.ndarray:
    """The multiset of ``lengths`` (ascending) of the greatest value that fits: counts by length.

    best[c] is the greatest value within c; each step looks at the ``fits[c]`` lengths up to
    c at once.
    """
    best = np.zeros(capacity + 1)
    took = np.zeros(capacity + 1, dtype=np.int64)
    for c in range(1, capacity + 1):
        m = fits[c]
        if m:
            total = values[:m] + best[c - lengths[:m]]
            k = total.argmax()
            if total[k] > best[c - 1]:
                best[c], took[c] = total[k], lengths[k]
                continue
        best[c] = best[c - 1]
    counts = np.zeros(capacity + 1, dtype=np.int64)
    c = capacity
    while c > 0:
        if took[c]:
            counts[took[c]] += 1
            c -= took[c]
        else:
            c -= 1
    return counts


def configurations(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int | None = None,
                   step: float = 0.5) -> list[tuple[list[tuple[int, int]], int]]:
    """A packing of the histogram: configurations as [(length, copies)] with their uses.

    ``rounds`` bounds the pricing steps (default: one for each length, 64 at least). A
    length's price starts in proportion to its size, and falls by a factor of
    ``lengths ** -step`` each time its whole demand is covered.
    """
    demand = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in histogram.items():
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} does not fit")
        demand[length] = n
    plan: dict[tuple, int] = {}

    def use(counts: np.ndarray, times: int) -> None:
        if times > 0:
            key = tuple((int(s), int(counts[s])) for s in np.flatnonzero(counts))
            plan[key] = plan.get(key, 0) + int(times)

    if demand[capacity]:
        full = np.zeros(capacity + 1, dtype=np.int64)
        full[capacity] = 1
        use(full, demand[capacity])
        demand[capacity] = 0
    found: dict[tuple, list] = {}
    needed = demand > 0
    covered = np.zeros(capacity + 1)
    left = demand.copy()
    if needed.any():
        lengths = np.flatnonzero(needed)
        fits = np.searchsorted(lengths, np.arange(capacity + 1), side="right").tolist()
        fall = step * np.log(max(2, len(lengths)))
        for _ in range(rounds or max(64, len(lengths))):
            price = lengths * np.exp(-fall * covered[lengths])
            counts = _heaviest(lengths, fits, price, capacity)
            used = counts > 0
            amount = (demand[used] / counts[used]).min()
            covered[used] += amount * counts[used] / demand[used]
            entry = found.setdefault(counts.tobytes(), [counts, 0.0])
            entry[1] += amount
        scale = max(1.0, covered[needed].min())
        # Round to whole uses, never above what is left.
        for counts, amount in sorted(found.values(), key=lambda e: -e[1]):
            used = counts > 0
            times = min(round(amount / scale), int((left[used] // counts[used]).min()))
            if times > 0:
                left -= times * counts
                use(counts, times)
    _best_fit(left, capacity, use)
    return [(list(key), times) for key, times in plan.items()]


def _best_fit(left: np.ndarray, capacity: int, use) -> None:
    """Pack what is left: the longest piece opens a sequence, which takes the longest piece
    that still fits until none does; the same sequence is repeated while its pieces last."""
    while left.any():
        counts = np.zeros(capacity + 1, dtype=np.int64)
        room = capacity
        rest = left.copy()
        while room:
            fits = np.flatnonzero(rest[:room + 1])
            if not len(fits):
                break
            length = int(fits[-1])
            n = min(int(rest[length]), room // length)
            counts[length] += n
            rest[length] -= n
            room -= n * length
        used = counts > 0
        times = int((left[used] // counts[used]).min())
        left -= times * counts
        use(counts, times)


def _plan_arrays(plan, capacity: int):
    """For each length the ranks that each configuration takes: arrays for a binary search."""
    rows = []
    first_id = 0
    taken = np.zeros(capacity + 1, dtype=np.int64)
    for items, times in plan:
        offset = 0
        for length, copies in sorted(items, reverse=True):
            rows.append((length, taken[length], first_id, copies, offset))
            taken[length] += times * copies
            offset += length * copies
        first_id += times
    rows.sort()
    return np.array(rows, dtype=np.int64).reshape(-1, 5)


def _place(length: np.ndarray, rank: np.ndarray, rows: np.ndarray) -> pd.DataFrame:
    """Sequence and offset of the piece of that rank among the pieces of its length."""
    out_id = np.zeros(len(length), dtype=np.int64)
    out_offset = np.zeros(len(length), dtype=np.int64)
    for size in np.unique(length):
        mine = rows[np.searchsorted(rows[:, 0], size):np.searchsorted(rows[:, 0], size, "right")]
        at = length == size
        own = mine[np.searchsorted(mine[:, 1], rank[at], "right") - 1]
        within = rank[at] - own[:, 1]
        out_id[at] = own[:, 2] + within // own[:, 3]
        out_offset[at] = own[:, 4] + within % own[:, 3] * size
    return pd.DataFrame({"sequence_id": out_id, "offset": out_offset})


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with a ``length`` of 1 to ``capacity``.

    Pieces in one sequence fill it from offset 0 without gaps. Equal rows are packed one by
    one; an empty table gives an empty result. Only the histogram comes to the driver.
    """
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    rows = _plan_arrays(configurations(histogram, capacity), capacity)
    # Pieces of one length are numbered in buckets of about 100,000.
    buckets = min(4096, max(64, max(histogram.values(), default=0) // 100_000))
    shared = pieces.sparkSession.sparkContext.broadcast(rows)  # at most a few for each length and round

    def place(batches):
        for frame in batches:
            spots = _place(frame["length"].to_numpy(), frame["_rank_in_length"].to_numpy(), shared.value)
            frame = frame.drop(columns="_rank_in_length")
            frame["sequence_id"], frame["offset"] = spots["sequence_id"], spots["offset"]
            yield frame

    ranked = numbered(pieces, ["length"], ["doc_id", "piece", "ids_crc32"], buckets, "_rank_in_length")
    fields = ", ".join(f"`{n}` {t}" for n, t in pieces.dtypes)
    return ranked.mapInPandas(place, f"{fields}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Tokenise ``docs(doc_id, text)``, end each with id 0, cut what is longer than a sequence
    and pack. A null or empty text is the end id alone. Rows that repeat an identifier are
    separate documents. Other columns are ignored."""
    return pack(durable(token_pieces(docs, path or _tokenizer_path(), capacity)), capacity)


def op8_best_fit_packing(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents"))


def stage(spark, docs, sf_dir):
    """Pipeline stage: all documents, as placed pieces."""
    return pack_documents(docs)
