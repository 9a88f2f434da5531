"""Embeddings and conversations against brute force."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from riskloom.llm import chat, vectors
from riskloom.llm.common import components


def brute(ids, matrix):
    unit = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    linked = unit @ unit.T >= vectors.THRESHOLD
    np.fill_diagonal(linked, False)
    label = np.array(ids)
    while True:
        new = np.minimum(label, np.where(linked, label[None, :], 1 << 60).min(axis=1))
        if (new == label).all():
            return linked.sum(axis=1), label
        label = new


@pytest.mark.parametrize("tile", [1024, 9])
def test_links_and_components(spark, monkeypatch, tile):
    monkeypatch.setattr(vectors, "TILE", tile)
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((25, 16))
    near = np.concatenate([centres[i % 25] + 0.08 * rng.standard_normal((1, 16)) for i in range(260)])
    x = np.concatenate([near, near[:40], near[:1].repeat(60, axis=0), rng.standard_normal((100, 16))]).astype(np.float32)
    rows = [(i + 5, v.tolist()) for i, v in enumerate(x)]
    got = vectors.near_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")).toPandas().sort_values("vec_id")
    links, label = brute(range(5, 5 + len(x)), x.astype(np.float64))
    assert (got.n_links.to_numpy() <= links).all() and got.n_links.sum() >= 0.9 * links.sum()
    assert (got.component_id.to_numpy() == label).mean() > 0.98
    assert (got.kept == (got.vec_id == got.component_id)).all()


def test_big_group_in_one_python_task(monkeypatch):
    """Tiles and small groups count the same links."""
    rng = np.random.default_rng(3)
    x = (np.ones((90, 8)) + 0.02 * rng.standard_normal((90, 8))).astype(np.float32)
    hashing = vectors.Hashing(8, 2, 3)
    keys = hashing.keys(x / np.linalg.norm(x, axis=1, keepdims=True).astype(np.float64))
    bucket = keys[0, 0]
    rows = pa.RecordBatch.from_arrays(
        [pa.array([bucket] * 90), *[pa.array(np.zeros(90, np.int32))] * 3, pa.array(range(90)), pa.array(np.ones(90, np.int64)),
         pa.array(x.tolist(), pa.list_(pa.float32()))], names=["bucket", "left", "right", "tile", "cls", "n", "embedding"])
    results = []
    for small in (1000, 4):
        monkeypatch.setattr(vectors, "_SMALL", small)
        batches = [rows.slice(0, 50), rows.slice(50)]
        counts = defaultdict(int)
        for b in vectors._compare(iter(batches), 2, 3, 0.9):
            for a, other, n in zip(*b.to_pydict().values()):
                if other < 0:
                    counts[a] += n
        results.append(dict(counts))
    assert results[0] == results[1] and results[0]


def test_vectors_that_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [1.0, None]), (6, [inf, 1.0]), (7, [1.0, 0.0]),
            (8, [2.0, 0.0]), (None, [1.0, 0.0]), (7, [1.0, 0.0]), (9, [1.0, 0.0, 0.0]), (10, [-1.0, 0.0])]
    got = vectors.near_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    by = defaultdict(list)
    for r in got:
        by[r.vec_id].append((r.n_links, r.component_id, r.kept))
    assert all(by[i] == [(0, i, True)] for i in (1, 2, 3, 4, 5, 6, 9, 10))
    assert by[7] == [(3, 7, True)] * 2 and by[8] == [(3, 7, False)] and by[None] == [(3, 7, False)]
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert vectors.near_vectors(empty).collect() == []


def test_recall_at_the_threshold():
    """Pairs right at the threshold meet about as often as promised."""
    rng = np.random.default_rng(5)
    projections, tables = vectors.tuned(50_000)
    a = rng.standard_normal((600, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.standard_normal((600, 64))
    side -= (side * a).sum(axis=1, keepdims=True) * a
    b = 0.9 * a + np.sqrt(1 - 0.81) * side / np.linalg.norm(side, axis=1, keepdims=True)
    hashing = vectors.Hashing(64, projections, tables)
    met = (hashing.keys(a) == hashing.keys(b)).any(axis=1).mean()
    assert met >= 0.9


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 180)] + [(7, 7), (None, 3), (300, 299), (299, 301)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = {i: 1 for i in range(1, 41)} | {i: 100 for i in range(100, 180)} | {i: 299 for i in (299, 300, 301)}
    assert got == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


# Conversations

@pytest.mark.parametrize("text", ["", "<|im_end|>", "<\\|x", "<\\\\|", "<<|>", "a\nb", "|<", "<|im_start|>user\n<|im_end|>\n"])
def test_escape_round_trip(text):
    escaped = chat.escape(text)
    assert "<|" not in escaped and chat.unescape(escaped) == text
    shown, a, b = chat.render(text, text)
    assert chat.parse(shown + shown) == [(text, text)] * 2 and chat.unescape(shown[a:b]) == text


def expected(rows):
    by = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        by[conv].append((role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss),
                     hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_windows_of_long_conversations(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK_TURNS", 8)
    monkeypatch.setattr(chat, "BLOCK_STRETCHES", 3)
    rng = np.random.default_rng(6)
    rows = [(1, 0, "system", "Be kind. " * 5)]
    rows += [(1, i, ("user", "assistant")[i % 2], "word " * int(rng.integers(0, 60))) for i in range(1, 300)]
    rows += [(1, 300, "assistant", "long " * 900), (1, 301, "user", "<|im_end|> \\ <\\|"), (2, 0, "assistant", "héllo 🙂")]
    rows += [(3, 0, "system", "sys " * 700), (3, 1, "user", None), (3, 1, "user", None), (3, None, None, "x"), (None, 4, "assistant", "a")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    windows = chat.format_windows(frame.repartition(5), budget=400, history=60, system=80)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(windows).collect()}
    assert got == expected(rows)
    shown = windows.where("conv_id = 1").orderBy("window").collect()
    assert all((w.tokens <= 400) != w.over_budget for w in shown) and sum(w.over_budget for w in shown) == 1
    assert len(shown) > 20
    lead = chat.render("system", "Be kind. " * 5)[0]
    assert all(w.formatted.startswith(lead) for w in shown)
    assert sum(w.new_from > len(lead) for w in shown) > 10  # history is repeated
    for w in shown:
        assert all(w.new_from <= s.start <= s.end <= len(w.formatted) for s in w.targets)


def test_long_system_turn_stays_in_every_window(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK_TURNS", 8)
    monkeypatch.setattr(chat, "BLOCK_STRETCHES", 3)
    rng = np.random.default_rng(7)
    systems = {1: "sys " * 150, 2: "sys " * 385, 3: "sys " * 700, 4: "sys " * 10, None: "sys " * 200}
    rows = [(c, 0, "system", text) for c, text in systems.items()]
    rows += [(c, i, ("user", "assistant")[i % 2], "word " * int(rng.integers(0, 40))) for c in systems for i in range(1, 120)]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    windows = chat.format_windows(frame.repartition(5), budget=400, history=60, system=80)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(windows).collect()}
    assert got == expected(rows)
    shown = defaultdict(list)
    for w in windows.collect():
        shown[w.conv_id].append(w)
    for c, text in systems.items():
        lead = chat.render("system", text)[0]
        assert len(shown[c]) > 5 and all(w.formatted.startswith(lead) for w in shown[c])
        assert all(w.over_budget == (w.tokens > 400) for w in shown[c])
    assert not any(w.over_budget for c in (1, 4, None) for w in shown[c])
    assert all(w.over_budget for w in shown[3])
    assert sum(w.new_from > len(chat.render("system", systems[1])[0]) for w in shown[1]) > 5


def test_no_conversations(spark):
    empty = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string, window string")
    assert chat.read_back(chat.format_windows(empty)).collect() == []
