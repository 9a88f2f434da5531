"""Text operators against brute force, the tokenizers library and hand-made cases."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskloom.llm import bpe, exact_dedup, language, licenses, packing, paragraphs, secrets, simhash

SCHEMA = "doc_id bigint, text string, lang string, kept string, score double"
LONG = " ".join(f"word{i % 977} tail{i % 31}" for i in range(9000))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, repeats, and columns that clash."""
    rows = [
        (1, None, "en", "x", 1.0), (2, "", None, None, None), (3, "a", "en", "x", 1.0), (4, LONG, "de", "x", 1.0),
        (5, LONG, "de", "x", 1.0), (None, "a", "en", "x", None), (None, None, None, None, None), (3, "a", "en", "x", 1.0),
        (6, "!!! ... 123", "en", "x", 1.0), (7, "Released under the MIT License.", "en", "x", 1.0),
        (8, "tab\tand\x0bnewline\n\n", "en", "x", 1.0),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


# Exact dedup

@pytest.mark.parametrize("hot_rows", [0, 1, 1000])
def test_exact_groups_with_and_without_hot_texts(spark, odd, hot_rows):
    spark.conf.set("spark.sql.shuffle.partitions", "64")  # so that few rows count as hot
    try:
        got = exact_dedup.exact_dedup(odd, hot_rows=hot_rows).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(got) == odd.count()
    texts = Counter((r.text or "") for r in odd.collect())
    by_hash = {hashlib.sha256(t.encode()).hexdigest(): n for t, n in texts.items()}
    kept = Counter()
    for r in got:
        assert r.group_size == by_hash[r.text_sha256]
        kept[r.text_sha256] += r.kept
    assert set(kept.values()) == {1}
    assert {(r.doc_id, r.keep_id) for r in got if r.text_sha256 == hashlib.sha256(b"a").hexdigest()} == {(3, 3), (None, 3)}
    assert {r.keep_id for r in got if r.doc_id in (4, 5)} == {5}


def test_exact_smallest_and_empty(odd, empty):
    got = exact_dedup.exact_dedup(odd, keep="smallest")
    assert got.where("doc_id in (4, 5) and kept").collect()[0].doc_id == 4
    assert exact_dedup.exact_dedup(empty).collect() == []


def test_exact_stage_keeps_columns(spark, odd):
    got = exact_dedup.stage(spark, odd, "")
    assert got.columns == odd.columns and got.count() == 6
    assert got.where("doc_id = 2 or doc_id = 1").count() == 1


# SimHash

def brute_print(text):
    words = [w for w in (text or "").encode().lower().split()]
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [b" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \t", "one", "One two", "a b c", "A B C d e " * 300, "é Ü x\x0by z", LONG])
def test_fingerprint_is_the_plain_definition(text):
    assert simhash.fingerprint(text) == brute_print(text)


def test_links_join_exactly_the_components(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, 30, dtype=np.uint64)
    flips = [base[i % 30] ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False))) for i in range(300)]
    prints = np.unique(np.array(flips, dtype=np.uint64))
    frame = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "fp bigint")
    from riskloom.llm.common import components
    roots = {r.node: r.root for r in components(simhash.links(frame)).collect()}
    distance = np.bitwise_count(prints[:, None] ^ prints[None, :])
    label = prints.view(np.int64).copy()
    while True:
        new = np.where(distance <= 2, label[None, :], np.iinfo(np.int64).max).min(axis=1)
        if (new == label).all():
            break
        label = new
    assert {int(p): int(c) for p, c in zip(prints.view(np.int64), label) if (label == c).sum() > 1} == roots


def test_simhash_odd_rows(spark, odd, empty):
    got = simhash.simhash_groups(odd).collect()
    assert len(got) == odd.count()
    zero = [r for r in got if r.fingerprint == "0" * 16]
    assert {r.doc_id for r in zero} == {1, 2, None} and {r.component_id for r in zero} == {1}
    assert simhash.simhash_groups(empty).collect() == []
    stage = simhash.stage(spark, odd, "")
    assert stage.columns == odd.columns
    assert sorted(r.doc_id for r in stage.select("doc_id").collect()) == [1, 3, 4, 6, 7, 8]


# Licenses

def test_license_cases(spark, empty):
    mit = licenses.TEMPLATES["mit"][0].split()
    changed = " ".join(mit[:20] + ["newly", "added"] + mit[20:30] + mit[31:])
    cases = {
        1: ("Released UNDER the MIT-License!", 1, "mit", "mit", 1.0),
        2: ("under the mit", 0, "", "", 0.0),
        3: ("x cc by, nc. cc by nc under the mit license", 3, "cc-by-nc,mit", "cc-by-nc,mit", 1.0),
        4: (f"Foo {changed} bar", 0, "", "mit", None),
        5: (" ".join(mit[:15]), 0, "", "", 0.0),
        6: (None, 0, "", "", 0.0), 7: ("", 0, "", "", 0.0),
        8: ("cc by nc by nc", 1, "cc-by-nc", "cc-by-nc", 1.0),
    }
    rows = [(k, v[0]) for k, v in cases.items()] + [(3, cases[3][0]), (None, "under the mit license")]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.n_base == 1
            continue
        _, n, base, labels, score = cases[r.doc_id]
        assert (r.n_base, r.base_labels, r.labels) == (n, base, labels)
        assert score is None or r.score == score
    by = {r.doc_id: r for r in got}
    assert (by[3].first_word, by[3].last_word, by[3].n_words) == (1, 7, 11)
    assert 0.8 <= by[4].score < 1 and by[6].n_words == 0 and by[2].first_word is None
    assert licenses.scan(empty).collect() == []


# Byte-pair encoding

@pytest.fixture(scope="module")
def coder(documents):
    path = bpe._tokenizer_path()
    return bpe.Encoder(bpe.build_lexicon(documents, path, 3000), path), Tokenizer.from_file(path)


@pytest.mark.parametrize("text", [
    "", " ", "plain words, and more.", "<|endoftext|>", "A<|startoftext|>b <|endoftext|>x", "<|endof",
    "it's I'LL ΑΣ ΣΑΣ. İstanbul ǅ", "x\x1cy\x1dz 12½ ３４", "été    x", "日本語テキスト🙂👍🏽", "a" * 3000, "ab" * 700,
    "﻿q​z", "ﬁ ſ K Å ẞ", "\x85a b　c", "123 4567",
])
def test_same_ids_as_the_library(coder, text):
    encoder, library = coder
    ids = library.encode(text, add_special_tokens=False).ids
    assert encoder.encode(text) == ids
    assert encoder.vocab.text(ids) == library.decode(ids, skip_special_tokens=False)


def test_merging_many_words_is_merging_each(coder):
    vocab = coder[0].vocab
    words = ["a", "zz", "the", "internationalization"] * 20 + [f"w{i}x{i * 7}" for i in range(400)] + ["", "é", "ü" * 40]
    assert vocab.merge_all(words) == [vocab.merge(w) for w in words]
    long = "abcdefg" * 100
    assert vocab.merge(long) == coder[1].encode(long, add_special_tokens=False).ids


def test_transducer_is_minimal_and_exact():
    words = {w: [i, i + 1] for i, w in enumerate(["tap", "taps", "top", "tops", "stop", "stops", "a"])}
    lexicon = bpe.Lexicon(bpe.compile_lexicon(words))
    asked = [*words, "ta", "tapsx", "x", ""]
    places = lexicon.find([w.encode() for w in asked])
    for word, place in zip(asked, places):
        found = lexicon.ids[lexicon.offsets[place]:lexicon.offsets[place + 1]].tolist() if place >= 0 else None
        assert found == words.get(word)
    # As few states as there are different sets of ends.
    ends = {frozenset(w[len(p):] for w in words if w.startswith(p)) for w in words for p in (w[:i] for i in range(len(w) + 1))}
    assert len(lexicon.final) == len(ends)
    assert bpe.Lexicon(bpe.compile_lexicon({})).find([b"x"]).tolist() == [-1]


def test_bpe_round_trip_and_odd_rows(spark, odd, empty):
    library = Tokenizer.from_file(bpe._tokenizer_path())
    coded = bpe.encode(odd)
    texts = Counter(library.decode(library.encode(r.text or "", add_special_tokens=False).ids, skip_special_tokens=False)
                    for r in odd.collect())
    assert Counter(r.text for r in bpe.decode(coded).collect()) == texts
    got = bpe.digests(odd).collect()
    assert Counter(r.decoded_sha256 for r in got) == Counter(
        hashlib.sha256(t.encode()).hexdigest() for t in texts.elements())
    assert bpe.digests(empty).collect() == []


# Language

def test_gradients_of_the_network():
    net = language.Network.start(["a", "b", "c"], hidden=4, kind=np.float64)
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 256, (7, 5)), rng.integers(0, 3, 5)
    _, gradients = net.loss(x, y)
    for p, g in zip(net.parameters, gradients):
        for _ in range(5):
            at = tuple(int(rng.integers(0, s)) for s in p.shape)
            if p.shape[0] == 256:
                at = (int(x[rng.integers(0, 7), rng.integers(0, 5)]), at[1])
            old = p[at]
            p[at] = old + 1e-5
            above = net.loss(x, y)[0]
            p[at] = old - 1e-5
            below = net.loss(x, y)[0]
            p[at] = old
            assert abs((above - below) / 2e-5 - g[at]) < 1e-6


def test_pooling_is_the_mean_over_all_bytes():
    net = language.Network.start(["a", "b", "c"], hidden=4, kind=np.float64)
    texts = ["short", "x" * 300, "Ein längerer Text, der über ein Fenster geht. " * 9]
    names, scores = language.predict(net, texts)
    p = net.parameters
    for text, name, score in zip(texts, names, scores):
        data, total = text.encode(), np.zeros(3)
        for a in range(0, len(data), language.WINDOW):
            x = np.frombuffer(data[a:a + language.WINDOW], np.uint8)[:, None]
            f, _ = language.Gru(*p[:3]).forward(x)
            b, _ = language.Gru(*p[3:6]).forward(x[::-1])
            total += language._softmax(np.concatenate([f, b[::-1]], axis=2) @ p[6] + p[7]).sum(axis=(0, 1))
        total /= len(data)
        assert name == net.languages[total.argmax()] and score == pytest.approx(total.max(), abs=1e-9)


def test_held_out_accuracy_and_odd_rows(spark, documents, odd, empty):
    net = language.fit(documents)
    rows = language.identify(documents.select("doc_id", "text", "lang"), net).toPandas()
    apart = rows.doc_id.map(lambda d: zlib.crc32(str(d).encode()) % 4 == 2)
    assert (rows.lang == rows.lang_pred)[apart].mean() > 0.95
    got = language.identify(odd.drop("score"), net).collect()
    assert len(got) == odd.count()
    for r in got:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) and 0 <= r.score <= 1
    assert language.identify(empty.drop("score"), net).collect() == []
    assert language.fit(empty) is None
    assert {r.lang_pred for r in language.identify(odd.select("doc_id", "text"), None).collect()} == {"und"}
    assert language.stage(spark, odd.union(documents.select(
        "doc_id", "text", "lang", F.lit("x"), F.lit(1.0)).limit(100)), "").columns == odd.columns


@pytest.mark.parametrize("counts, texts, want", [
    ({}, 5, {}), ({"a": 3, "b": 1}, 9, {"a": 3, "b": 1}), ({"a": 900, "b": 2, "c": 70}, 100, {"a": 49, "b": 2, "c": 49}),
    ({"a": 5, "b": 4, "c": 9}, 2, {"a": 1, "c": 1}),
])
def test_quotas(counts, texts, want):
    assert language.quotas(counts, texts) == want


def test_few_labels_in_many_rows_are_all_used(spark):
    words = F.concat_ws(" ", *[F.sha1(F.concat("id", F.lit(f" {k}"))) for k in range(2)])
    lang = F.when(F.col("id") % 4000 == 1, "aa").when(F.col("id") == 2, "bb").when(F.col("id") == 3, "cc")
    docs = spark.range(40_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") == 3, "123").otherwise(words).alias("text"), lang.alias("lang"))
    used = {i for i in [*range(1, 40_000, 4000), 2] if zlib.crc32(str(i).encode()) % 4 != 2}
    assert {r.doc_id for r in language.training_rows(docs).collect()} == used
    assert language.fit(docs).languages == ["aa", "bb"]
    many = docs.withColumn("lang", F.when(F.col("doc_id") % 5000 == 6, "rare").otherwise("often"))
    got = Counter(r.lang for r in language.training_rows(many, 500).collect())
    rare = sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(6, 40_000, 5000))
    assert got == {"rare": rare, "often": 500 - rare}


# Secrets

def test_forest_on_findings_of_other_texts(documents):
    words = secrets.frequent_words(documents)
    model = secrets.train(secrets.labelled_findings(documents.where("doc_id % 2 = 0")), words)
    found = secrets.judged(secrets.labelled_findings(documents.where("doc_id % 2 = 1")), model, words).toPandas()
    assert ((found.label == 1) == found.secret).mean() > 0.97


def test_secret_places_and_mask(spark, documents):
    key, other = "04dbebab91ab85687d33eeaaf9ac699e1188f962", "Zk9Qw3rTy7UiOp2AsDf5Gh"
    made = spark.createDataFrame([
        (10**6, f'start token = "{key}" end and api_key: {other}, commit {key[::-1]} done'), (10**6 + 1, None),
        (10**6 + 2, ""), (10**6 + 3, f"{key}"), (None, f'password="{other}!"'),
    ], "doc_id bigint, text string")
    docs = documents.select("doc_id", "text").union(made)
    found = secrets.scan(docs)
    mine = found.where(f"doc_id = {10**6} or doc_id is null").toPandas()
    first = mine[mine.doc_id == 10**6].sort_values("start")
    assert first.value.tolist() == [key, other, key[::-1]]
    assert first.secret.tolist() == [True, True, False]
    text = made.first().text
    assert all(text[s:s + len(v)] == v for s, v in zip(first.start, first.value))
    masked = secrets.stage(spark, docs, "")
    by = {r.doc_id: r.text for r in masked.where(f"doc_id >= {10**6}").collect()}
    assert by[10**6] == text.replace(key, "[SECRET]").replace(other, "[SECRET]")
    assert by[10**6 + 1] is None and by[10**6 + 2] == ""
    assert masked.count() == docs.count() and masked.columns == docs.columns


def test_secrets_without_candidates(empty):
    assert secrets.scan(empty).collect() == []


# Paragraphs

def plain_lines(text):
    """(start, stop, words) of the lines of a text, short ones next to each other joined."""
    lines = []
    at = 0
    for line in text.split("\n"):
        found = [(at + m.start(), at + m.end(), m.group().lower()) for m in re.finditer(r"[^\W_]+", line)]
        at += len(line) + 1
        if found:
            lines.append(found)
    out = []
    for line in lines:
        if out and len(line) < paragraphs.LEAST_WORDS and out[-1][1]:
            out[-1][0].extend(line)
        else:
            out.append(([*line], len(line) < paragraphs.LEAST_WORDS))
    return [(words[0][0], words[-1][1], [w for _, _, w in words]) for words, _ in out]


def sets_of(words):
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def clusters_of(sets):
    """The cluster of each set, by comparing all that share a member."""
    holders, parent = {}, list(range(len(sets)))
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for same in holders.values():
        for x, a in enumerate(same):
            for b in same[x + 1:]:
                if root(a) != root(b) and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                    parent[root(b)] = root(a)
    return [root(i) for i in range(len(sets))]


def test_lines_against_all_pairs(documents):
    """Without any of the operator's own cuts."""
    got = {(r.doc_id, r.start): r.kept for r in paragraphs.repeated(documents).where("kind = 0").collect()}
    rows = sorted((r.doc_id, r.text or "") for r in documents.select("doc_id", "text").collect())
    lines = [(d, a, b, w) for d, t in rows for a, b, w in plain_lines(t) if paragraphs.LEAST_PARAGRAPH <= len(w) <= paragraphs.WHOLE_LINE]
    root = clusters_of([sets_of(w) for *_, w in lines])
    size, first = Counter(root), {}
    want = {}
    for (d, a, b, _), r in zip(lines, root):
        if size[r] > 1:
            want[d, a] = (d, a) == first.setdefault(r, (d, a))
    assert set(got) <= set(want) and len(got) >= 0.97 * len(want) and len(want) > 40
    assert sum(got[k] == want[k] for k in got) >= 0.97 * len(got)


def test_changed_lines_are_found(spark):
    """Lines of 30 to 200 words with replaced words, at a similarity of 0.8 or more, by bands alone."""
    rng = np.random.default_rng(12)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6))
    rows, want = [], {}
    for k in range(150):
        line = [word() for _ in range(int(rng.integers(30, 201)))]
        changed, most = list(line), 0.05
        while True:
            more = list(changed)
            more[int(rng.integers(len(line)))] = word()
            a, b = sets_of(line), sets_of(more)
            if len(a & b) < 0.8 * len(a | b) or rng.random() < most:
                break
            changed = more
        if changed == line:
            changed[3] = word()
        rows += [(2 * k, f"first words {word()}\n{' '.join(line)}"), (2 * k + 1, f"{' '.join(changed)}\nlast words {word()}")]
        want[2 * k + 1] = len(changed) if len(sets_of(line) & sets_of(changed)) >= 0.8 * len(sets_of(line) | sets_of(changed)) else None
    want = {k: n for k, n in want.items() if n}
    got = {r.doc_id: r.removed_words for r in paragraphs.repeated_by_document(
        spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert len(want) > 130 and sum(got.get(k, 0) >= 0.9 * n for k, n in want.items()) >= 0.95 * len(want)


def test_windows_of_long_lines_and_what_stays(spark):
    """A part that two long lines share goes once; of everything, one place stays."""
    rng = np.random.default_rng(22)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared, line = prose(400), prose(60)
    near = line.split()
    near[30] = word()
    rows = [(1, f"{prose(300)} {shared} {prose(200)}"), (2, f"{prose(250)} {shared} {prose(300)}"),
            (3, line), (4, " ".join(near)), (5, f"{prose(120)} {' '.join(near[31:])} {prose(80)}"), (6, f"{prose(90)} {' '.join(near[31:])} {prose(30)}")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    spans = paragraphs.repeated(docs).collect()
    gone = {d: sorted((r.start, r.stop) for r in spans if r.doc_id == d and not r.kept) for d in range(1, 7)}
    assert not gone[1] and not gone[3] and gone[4] == [(0, len(" ".join(near)))]
    assert all(a[1] <= b[0] for g in gone.values() for a, b in zip(g, g[1:]))
    found = sum(len(rows[1][1][a:b].split()) for a, b in gone[2])
    assert found >= 0.8 * 400 and any(r.kind == paragraphs.WINDOW for r in spans)
    # What was only left in a removed line is left in one place at least.
    rest = {r.doc_id: r.text for r in paragraphs.without_repeats(docs).collect()}
    for part in [line, shared, " ".join(near[40:50])]:
        assert any(part in t for t in rest.values())


def test_pasted_passage_is_found_wherever_it_stands(spark):
    rng = np.random.default_rng(8)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage = prose(60)
    rows = [(i, f"{prose(40 + 7 * i)} {passage} {prose(90 - 5 * i)}") for i in range(6)]
    rows += [(10 + i, prose(150)) for i in range(6)] + [(20, None), (21, ""), (None, prose(30))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = paragraphs.repeated_by_document(docs).toPandas()
    assert sorted(got.doc_id) == list(range(6))
    assert got[got.doc_id == 0].n_removed.item() == 0 and (got[got.doc_id > 0].n_removed > 0).all()
    rest = {r.doc_id: r.text for r in paragraphs.without_repeats(docs).collect()}
    assert rest[0] == rows[0][1] and len(rest[3]) < len(rows[3][1]) - 100 and rest[11] == rows[7][1]


def test_whole_inside_of_passages_by_plain_comparison(spark):
    """Words of a text that are found run from one end of a pasted passage almost to the other."""
    rng = np.random.default_rng(18)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6))
    prose = lambda n: [word() for _ in range(n)]
    rows, want = [], {}
    for p in range(40):
        passage = prose(60)
        for copy in range(2):
            i = 2 * p + copy
            before, own = prose(40 + p), list(passage)
            if copy and p >= 20:
                own[30] = word()  # one word changed
            rows.append((i, " ".join(before + own + prose(70 - p))))
            want[i] = (len(" ".join(before)) + 1, len(" ".join(before + own)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in paragraphs.repeated_by_document(docs).collect()}
    assert set(got) == set(want)
    covered = []
    for i, (a, b) in want.items():
        spans = got[i].spans
        # A paragraph at either end may take in some words more and still be similar.
        assert all(a - 50 <= s.start < s.stop <= b + 50 for s in spans)
        assert all(x.stop == y.start for x, y in zip(spans, spans[1:]) if not 2 * 20 <= i)
        covered.append(sum(len(rows[i][1][max(a, s.start):min(b, s.stop)].split()) for s in spans) / 60)
        assert sum(s.words for s in spans) == sum(len(rows[i][1][s.start:s.stop].split()) for s in spans)
    print("covered", np.mean(covered[:40]), np.mean(covered[40:]))
    assert np.mean(covered[:40]) > 0.68 and np.mean(covered[40:]) > 0.6


def test_passage_in_short_lines_is_found(spark):
    rng = np.random.default_rng(28)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6))
    prose = lambda n: " ".join(word() for _ in range(n))
    verse, mixed = "\n".join(prose(6) for _ in range(10)), "\n".join(prose(n) for n in (9, 2, 12, 3, 8))
    rows = [(i, f"{prose(30)}\n{verse}\n{prose(25)}") for i in range(3)]
    rows += [(3, f"{prose(4)}\n{prose(5)}\n{verse}\n{prose(3)}"), (4, verse)]
    rows += [(10 + i, f"{prose(30)}\n{mixed}\n{prose(25)}") for i in range(2)]
    couplets = "\n".join(prose(n) for n in (4, 3, 4, 2, 4, 3, 4, 4))
    rows += [(30 + i, f"{prose(30)}\n{couplets}\n{prose(25)}") for i in range(2)]
    rows += [(20 + i, f"{prose(30)}\nyours truly and so on\n{prose(25)}") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in paragraphs.repeated_by_document(docs).collect()}
    assert set(got) == {0, 1, 2, 3, 4, 10, 11, 30, 31} and got[31].removed_words == 28
    assert all(got[i].removed_words == 60 for i in (1, 2, 4)) and got[3].removed_words >= 30
    rest = {r.doc_id: r.text for r in paragraphs.without_repeats(docs).collect()}
    assert rest[0] == rows[0][1] and rest[1] == rows[1][1].replace(verse, "") and rest[4] == ""
    assert rest[11] == rows[6][1].replace(mixed, "") and rest[20] == rows[9][1]


def test_wide_band_is_compared_in_tiles(monkeypatch):
    monkeypatch.setattr(paragraphs, "TILE", 7)
    import pyarrow as pa
    rng = np.random.default_rng(2)
    base = rng.integers(0, 10**9, 12).tolist()
    sets = [sorted({*base[:11], int(rng.integers(0, 3))}) for _ in range(40)] + [rng.integers(0, 10**9, 9).tolist() for _ in range(9)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([5] * 49), pa.array([0] * 49), pa.array([0] * 49), pa.array([0] * 49), pa.array(range(49)), pa.array(sets)],
        names=["band", "left", "right", "tile", "key", "shingles"])
    linked = {tuple(x) for b in paragraphs._links(iter([batch]), 0.8) for x in zip(*b.to_pydict().values())}
    near = paragraphs.similar(sets, sets)
    seen = {0}
    while True:
        more = seen | {y for x, y in linked if x in seen} | {x for x, y in linked if y in seen}
        if more == seen:
            break
        seen = more
    assert seen == set(range(40)) and near[:40, :40].sum() >= 40 and not near[:40, 40:].any()


def test_paragraphs_odd_rows(odd, empty):
    assert paragraphs.repeated(empty).collect() == []
    got = paragraphs.repeated_by_document(odd).toPandas()
    assert set(got.doc_id) == {4, 5}
    assert paragraphs.without_repeats(odd).columns == odd.columns


# Packing

def test_pieces_cut_and_summed(spark, odd, empty):
    library = Tokenizer.from_file(packing._tokenizer_path())
    got = packing.pack_documents(odd).toPandas()
    assert (got.groupby("sequence_id").length.sum() <= packing.CAPACITY).all()
    ordered = got.sort_values(["sequence_id", "offset"])
    assert (ordered.groupby("sequence_id").length.cumsum() - ordered.length == ordered.offset).all()
    for r in odd.where("doc_id in (1, 2, 4, 6)").collect():
        ids = np.array(library.encode(r.text or "", add_special_tokens=False).ids + [0], dtype="<u4")
        mine = got[got.doc_id == r.doc_id].sort_values("piece")
        assert mine.length.sum() == len(ids) and mine.piece.tolist() == list(range(len(mine)))
        assert (mine.length[1:] == packing.CAPACITY).all()
        for p in mine.itertuples():
            assert p.ids_crc32 == zlib.crc32(ids[p.start:p.start + p.length].tobytes())
    assert packing.pack_documents(empty).collect() == []


@pytest.mark.parametrize("text", ["", "<|endoftext|>", "a<|endoftext|>b  c\n\n d", "é" * 50 + " ñ 　x\x1cz", "x" * 5000,
                                  " ￼ ٣٤½ it's I'LL", "🙂👍🏽 日本語テキスト"])
def test_fast_encoder_gives_the_librarys_ids(text):
    path = packing._tokenizer_path()
    assert packing.encoder(path).encode(text, allowed_special="all") == Tokenizer.from_file(path).encode(
        text, add_special_tokens=False).ids


@pytest.mark.parametrize("counts", [
    {}, {5: 1}, {2048: 3}, {1: 5000}, {1024: 7, 1025: 3}, {700: 10, 680: 10, 660: 10, 9: 4}, {1500: 4, 548: 4, 300: 50, 37: 11},
])
def test_packings_are_whole_and_near_the_bound(counts):
    plan = packing.configurations(counts)
    packed = Counter()
    for items, times in plan:
        assert sum(size * n for size, n in items) <= packing.CAPACITY and times > 0
        for size, n in items:
            packed[size] += n * times
    assert packed == Counter(counts)
    bound = max(-(-sum(k * v for k, v in counts.items()) // packing.CAPACITY), sum(v for k, v in counts.items() if k > 1024))
    assert sum(t for _, t in plan) <= bound + 1 + bound // 20


def test_heaviest_configuration_is_the_best_of_all():
    lengths, values = np.array([3, 5, 7]), np.array([2.0, 3.6, 5.1])
    fits = np.searchsorted(lengths, np.arange(17), side="right").tolist()
    best = max(2.0 * a + 3.6 * b + 5.1 * c for a in range(6) for b in range(4) for c in range(3) if 3 * a + 5 * b + 7 * c <= 16)
    counts = packing._heaviest(lengths, fits, values, 16)
    assert counts[lengths] @ values == pytest.approx(best)
