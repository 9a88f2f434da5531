"""Katz backoff against a plain model from dictionaries of counts."""

from __future__ import annotations

import math
import random
import re
import string
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import katz

SCHEMA = "doc_id bigint, text string, score double, held_out string, chunk int, _id string"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def tokens(text):
    return [*re.findall("[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), " end"]


def factors(counts):
    """Discount of counts 1 to 5."""
    n = Counter(counts)
    common = 6 * n[6] / n[1] if n[1] else 1
    if common < 1 and all(n[r] for r in range(1, 7)):
        d = {r: ((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common) for r in range(1, 6)}
        if all(0 < v < 1 for v in d.values()):
            return d
    less = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
    return {r: (r - less) / r for r in range(1, 6)}


class Plain:
    def __init__(self, texts, order):
        self.order = order
        self.grams = [Counter() for _ in range(order + 1)]
        for words in map(tokens, texts):
            padded = [" begin", *words]
            for i in range(1, len(padded)):
                for n in range(1, order + 1):
                    if i - n + 1 >= (1 if n == 1 else 0):
                        self.grams[n][tuple(padded[i - n + 1:i + 1])] += 1
        self.d = [None] + [factors(self.grams[n].values()) for n in range(1, order + 1)]
        self.total = sum(self.grams[1].values())
        self.after = defaultdict(dict)
        for n in range(1, order + 1):
            for gram, c in self.grams[n].items():
                self.after[gram[:-1]][gram[-1]] = c

    def discounted(self, n, c):
        return self.d[n].get(c, 1) * c

    def p(self, word, history=()):
        own = self.after.get(history)
        if not history:
            if not own:
                return 1.0
            left = sum(c - self.discounted(1, c) for c in own.values())
            total = self.total if left > 0 else self.total + 1
            return self.discounted(1, own[word]) / total if word in own else (left or 1) / total
        if not own:
            return self.p(word, history[1:])
        n, seen = len(history) + 1, sum(own.values())
        left = sum(c - self.discounted(n, c) for c in own.values())
        total = seen if left > 1e-9 else seen + 1
        if word in own:
            return self.discounted(n, own[word]) / total
        below = 1 - sum(self.p(w, history[1:]) for w in own)
        return (left if left > 1e-9 else 1) / total / below * self.p(word, history[1:])

    def score(self, text):
        padded, out = [" begin", *tokens(text)], 0.0
        for i in range(1, len(padded)):
            out += math.log10(self.p(padded[i], tuple(padded[max(0, i - self.order + 1):i])))
        return out


def prose(n, seed=1, size=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    out = []
    for _ in range(n):
        text = rng.choices(words, weights, k=rng.randint(0, size))
        for i in range(1, len(text)):
            if rng.random() < 0.5:
                text[i] = f"w{(int(text[i - 1][1:]) * 7 + rng.randint(0, 3)) % 400}"
        out.append(" ".join(text))
    return out


def check(spark, rows, held=lambda i: zlib.crc32(str(i).encode()) % 7 == 2, order=2, **settings):
    docs = spark.createDataFrame([(i, t, 1.0, "x", 1, "y") for i, t in rows], SCHEMA).repartition(3)
    condition = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    got = katz.katz_scores(docs, held_out=condition, order=order, **settings).collect()
    train = [t for i, t in rows if i is None or not held(i)]
    model = Plain(train, order)
    known, types = model.grams[1], len(model.grams[1])
    want = []
    for i, t in rows:
        words = tokens(t)
        base = sum(math.log10((known[(w,)] + 1) / (model.total + types + 1)) for w in words)
        want.append((i, i is not None and held(i), len(words), sum((w,) in known for w in words), model.total, base, model.score(t)))
    order_of = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    assert len(got) == len(want)
    for r, w in zip(sorted(map(tuple, got), key=order_of), sorted(want, key=order_of)):
        assert r[:5] == w[:5]
        assert r[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-9)
    return got, model


@pytest.mark.parametrize("order,settings", [
    (1, {}), (2, {}), (2, dict(chunk_tokens=300, bucket_tokens=700, frequent=40)),
    (3, dict(chunk_tokens=500, bucket_tokens=2000, frequent=100)), (4, dict(chunk_tokens=5000))])
def test_against_dictionaries(spark, order, settings):
    rows = list(enumerate(prose(260)))
    got, model = check(spark, rows, order=order, **settings)
    if order > 1:
        assert sum(r.score for r in got if r.held_out) > sum(r.base_score for r in got if r.held_out)
    if order == 2:
        words = [w for w, in model.grams[1]]
        for history in [(" begin",), ("w0",), ("w3",), ("w399",), (), ("never",)]:
            # The last term stands for the one class of unknown words.
            assert sum(model.p(w, history) for w in words) + model.p("<unknown>", history) == pytest.approx(1, abs=1e-9)


def test_every_distribution_sums_to_one(spark):
    """The operator's own probabilities: of one-word texts after a word, and of every other word."""
    train = prose(120, 3, 30)
    words = sorted({w for t in train for w in tokens(t)[:-1]})
    # Keys that are held out are asked, the others taught.
    keys = [i for i in range(20_000) if zlib.crc32(str(i).encode()) % 7 == 2]
    taught = [i for i in range(20_000) if zlib.crc32(str(i).encode()) % 7 != 2]
    asked = ["", *words, "never-seen"]
    rows = [*zip(taught, train), *zip(keys, asked)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    score = {r.doc_id: r.score for r in katz.katz_scores(docs, held_out=held).collect()}
    model = Plain(train, 2)
    by = dict(zip(asked, keys))
    total = 10 ** score[by[""]]
    for w in [*words, "never-seen"]:
        # p(w | begin) p(end | w), divided by the plain model's second factor.
        total += 10 ** score[by[w]] / model.p(" end", (w,))
    assert total == pytest.approx(1, abs=1e-9)


def test_odd_texts(spark):
    rows = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "A b"), (4, "A b"), (None, "a B"), (None, None), (5, "É É x \x1c y"),
            (6, "x " * 5000), (7, "ä" * 9000), (8, "end <end> <begin>"), (15, "unknown only"), (16, "a b c")]
    for settings in ({}, dict(chunk_tokens=3, bucket_tokens=5, frequent=1)):
        check(spark, rows, **settings)
        check(spark, rows, order=3, **settings)


def test_no_training_text_and_empty_table(spark):
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2]
    got, _ = check(spark, [(i, "a b c") for i in held])
    assert {(r.n_known, r.train_tokens, r.base_score, r.score) for r in got} == {(0, 0, 0.0, 0.0)}
    empty = katz.katz_scores(spark.createDataFrame([], SCHEMA))
    assert empty.collect() == [] and empty.columns == [
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def test_very_long_texts_are_cut_at_spaces(monkeypatch):
    monkeypatch.setattr(katz, "_PIECE", 50)
    for text in ("word " * 300, "x" * 500, "x" * 500 + " y", " " * 400, "a\tb\n" * 200):
        assert [w for part in katz._words(text) for w in part] == [*text.encode().split(), katz.END]


@pytest.mark.parametrize("values", [
    np.array([], np.int64), np.arange(300), np.array([-3, 5, 2**40]), np.array([0.5, -1e300, math.pi]),
    np.array([True, False]), np.array([2**64 - 1, 0], np.uint64)])
def test_numbers_survive_packing(values):
    assert (katz.unpack(katz.pack(values)) == values).all() and len(katz.unpack(katz.pack(values))) == len(values)


def test_good_turing_factors():
    counts = [1] * 500 + [2] * 200 + [3] * 110 + [4] * 70 + [5] * 50 + [6] * 38 + [90] * 10
    tally = katz._tally(np.array([0, *counts]))
    assert tally[:2] == [sum(counts), len(counts)]
    assert katz.discounts(tally[2:])[1:] == pytest.approx([factors(counts)[r] for r in range(1, 6)])
    assert katz.discounts([0] * 6)[1] == 0.5
