"""BPE encoding and decoding over a memory-mapped lexicon transducer.

The words of the whole corpus are counted on the executors; the most frequent ones, a fixed
number, are compiled into a minimal acyclic transducer. Common prefixes and suffixes share
states, and numbers on the arcs sum up to a word's place in the table of its token ids. The
compiled file is sent to the executors, where a worker maps it into memory from an unlinked
temporary file. Words that are not in it are merged pair by pair, exactly as the vocabulary's
merge order says. Both ways give the same ids; the transducer only saves merging.
"""

from __future__ import annotations

import contextlib
import gc
import hashlib
import heapq
import json
import mmap
import re
import tempfile
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskloom.llm.common import bound_batches, most_frequent, table

#: Words in the lexicon; bounds the compiled file to a few MB whatever the corpus.
LEXICON_WORDS = 262_144
#: Distinct chunks that a task counts before it hands them on, and encoded ones it remembers.
COUNTED, HELD = 300_000, 800_000
#: Characters of text that a task works on at a time.
BATCH_CHARS = 2_000_000
#: Characters that Python's split() takes as white space and the tokenizer doesn't.
_NOT_SPACE = re.compile("[\x1c-\x1f]")
#: A full stop or comma that belongs to a run of marks.
_MARK_RUN = re.compile(r"[^\w\s][.,][ \n]|_[.,][ \n]")
#: Outside these blocks character classes may differ between Unicode versions; the
#: tokenizer's own normaliser and splitter decide there.
_RARE = re.compile("[^\x00-\u024f\u0370-\u052f\u2000-\u206f]")


_SLOTS = 1 << 18
_SPREAD = np.int64(0x1E3779B97F4A7C15)


def _tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    kept = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, extra = [], 0
    for b in range(256):
        letters.append(chr(b if b in kept else 256 + extra))
        extra += b not in kept
    return letters


class Vocabulary:
    """Ids, merge ranks and splitting rules read from a tokenizers file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        #: Rank of a pair of ids, packed in one number, and the id that a merge of that rank makes.
        self.pair_rank = {self.ids[a] << 20 | self.ids[b]: i for i, (a, b) in enumerate(merges)}
        self.joined = [self.ids[a + b] for a, b in merges]
        self.none = len(merges)
        self.joined_table = np.array(self.joined, dtype=np.int32)
        # The same pairs in an open hash table, for many look-ups at once.
        self.slot_key = np.full(_SLOTS, -1, dtype=np.int64)
        self.slot_rank = np.zeros(_SLOTS, dtype=np.int32)
        self.probes = 1
        for pair, i in self.pair_rank.items():
            slot, probes = (((pair * int(_SPREAD)) & (1 << 64) - 1) >> 44) & _SLOTS - 1, 1
            while self.slot_key[slot] >= 0:
                slot, probes = slot + 1 & _SLOTS - 1, probes + 1
            self.slot_key[slot], self.slot_rank[slot] = pair, i
            self.probes = max(self.probes, probes)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        by_id = {i: t for t, i in (self.ids | self.special).items()}
        self.tokens = [by_id.get(i, "") for i in range(max(by_id) + 1)]
        self.numbers = [str(i) for i in range(len(self.tokens))]
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.letters = _byte_letters()
        self.byte_ids = [self.ids[c] for c in self.letters]
        self.last_ids = [self.ids[c + self.end] for c in self.letters]
        self.byte_table = np.array([self.byte_ids, self.last_ids], dtype=np.int32)
        self.bytes = {c: b for b, c in enumerate(self.letters)}
        library = Tokenizer.from_file(path)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer

    def chunks(self, text: str, apart: bool = False) -> list[str]:
        """White-space-free chunks of normalised text; words never reach over white space.
        A special token is a chunk of its own. With ``apart``, most full stops and commas are,
        too, which leaves fewer different chunks."""
        if "<|" in text:
            parts = self.special_pattern.split(text)
            if len(parts) > 1:
                return [c for i, p in enumerate(parts) for c in ([p] if i % 2 else self._plain(p, apart))]
        return self._plain(text, apart)

    def _plain(self, text: str, apart: bool = False) -> list[str]:
        if _RARE.search(text):
            return [c for c in self.normalizer.normalize_str(text).split(" ") if c]
        # Letter by letter: no special form of sigma at a word's end.
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        if _NOT_SPACE.search(text):
            return regex.findall(r"\S+", text)
        if apart and not _MARK_RUN.search(text):
            # A mark that ends a word is a word of its own.
            text = text.replace(", ", " , ").replace(". ", " . ").replace(".\n", " .\n")
        return text.split()

    def words(self, chunk: str) -> list[str]:
        if chunk.isascii():
            # Most chunks are letters, or letters and one mark: the pattern would say the same.
            if chunk.isalpha():
                return [chunk]
            if chunk[:-1].isalpha() and chunk[-1] in ".,;:!?":
                return [chunk[:-1], chunk[-1]]
        elif _RARE.search(chunk):
            return [bytes(self.bytes[c] for c in w).decode("utf-8", "surrogatepass")
                    for w, _ in self.splitter.pre_tokenize_str(chunk)]
        return self.pattern.findall(chunk)

    def merge(self, word: str) -> list[int]:
        """Ids of one word by merging the pair of lowest rank, leftmost first, until none is left."""
        data = word.encode("utf-8", "surrogatepass")
        if not data:
            return []
        ids = [*map(self.byte_ids.__getitem__, data[:-1]), self.last_ids[data[-1]]]
        if len(ids) > 256:
            return self._merge_long(ids)
        get, joined, none = self.pair_rank.get, self.joined, self.none
        ranks = [get(a << 20 | b, none) for a, b in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) < none:
            i = ranks.index(best)
            ids[i:i + 2] = (joined[best],)
            del ranks[i]
            if i:
                ranks[i - 1] = get(ids[i - 1] << 20 | ids[i], none)
            if i < len(ranks):
                ranks[i] = get(ids[i] << 20 | ids[i + 1], none)
        return ids

    def merge_all(self, words: list[str]) -> list[list[int]]:
        """``merge`` of many words. Words of one length are merged side by side, one merge of
        each at a time; the lowest rank comes first, and the leftmost where it is there twice."""
        data = [w.encode("utf-8", "surrogatepass") for w in words]
        out: list[list[int]] = [[]] * len(words)
        of_size: dict[int, list[int]] = {}
        for i, d in enumerate(data):
            of_size.setdefault(len(d), []).append(i)
        for size, mine in of_size.items():
            if size > 48 or len(mine) < 16:
                for i in mine:
                    out[i] = self.merge(words[i])
                continue
            raw = np.frombuffer(b"".join([data[i] for i in mine]), np.uint8).reshape(-1, size)
            ids = self.byte_table[0][raw]
            ids[:, -1] = self.byte_table[1][raw[:, -1]]
            rank = self._ranks(ids[:, :-1], ids[:, 1:])
            live, left = np.arange(len(mine)), np.full(len(mine), size)
            done = np.zeros_like(ids)
            for width in range(size - 1, 0, -1):
                best = rank.min(axis=1)
                more = best < self.none
                if not more.all():
                    stop = ~more
                    done[live[stop], :width + 1] = ids[stop]
                    left[live[stop]] = width + 1
                    live, ids, rank, best = live[more], ids[more], rank[more], best[more]
                    if not len(live):
                        break
                at = rank.argmin(axis=1)
                rows = np.arange(len(live))
                ids[rows, at] = self.joined_table[best]
                # What stands after the merged pair moves one place to the left.
                column = np.arange(width)[None, :]
                ids = np.take_along_axis(ids, column + (column > at[:, None]), axis=1)
                column = column[:, :width - 1]
                rank = np.take_along_axis(rank, column + (column >= at[:, None]), axis=1) if width > 1 else rank[:, :0]
                for side in (at - 1, at):
                    there = (side >= 0) & (side < width - 1)
                    r, c = rows[there], side[there]
                    rank[r, c] = self._ranks(ids[r, c], ids[r, c + 1])
                if width == 1:
                    done[live, :1] = ids
                    left[live] = 1
                    live = live[:0]
            if size == 1:
                done = ids
            for i, row, n in zip(mine, done.tolist(), left.tolist()):
                out[i] = row[:n]
        return out

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        pair = a.astype(np.int64) << 20 | b
        slot = (pair * _SPREAD) >> 44 & _SLOTS - 1
        out = np.full(pair.shape, self.none, dtype=np.int32)
        flat_pair, flat_slot, flat_out = pair.ravel(), slot.ravel(), out.ravel()
        open_ = np.arange(len(flat_pair))
        for _ in range(self.probes):
            key = self.slot_key[flat_slot[open_]]
            hit = key == flat_pair[open_]
            flat_out[open_[hit]] = self.slot_rank[flat_slot[open_[hit]]]
            open_ = open_[~hit & (key >= 0)]
            if not len(open_):
                break
            flat_slot[open_] = flat_slot[open_] + 1 & _SLOTS - 1
        return flat_out.reshape(pair.shape)

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same for long words, with a heap of pairs and links between neighbours."""
        get, joined, none = self.pair_rank.get, self.joined, self.none
        after, before = [*range(1, len(ids)), -1], [*range(-1, len(ids) - 1)]
        heap = [(r, i) for i in range(len(ids) - 1) if (r := get(ids[i] << 20 | ids[i + 1], none)) < none]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j < 0 or get(ids[i] << 20 | ids[j], none) != r:
                continue  # merged otherwise meanwhile
            ids[i], ids[j] = joined[r], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
                if (new := get(ids[i] << 20 | ids[after[i]], none)) < none:
                    heapq.heappush(heap, (new, i))
            if before[i] >= 0 and (new := get(ids[before[i]] << 20 | ids[i], none)) < none:
                heapq.heappush(heap, (new, before[i]))
        return [i for i in ids if i >= 0]

    def text(self, ids: Iterable[int]) -> str:
        """Decoded text. The file has no decoder, so tokens are joined by one blank."""
        return " ".join([self.tokens[i] for i in ids])

    def digits(self, ids: Iterable[int]) -> str:
        """The ids as decimal numbers, joined by one blank."""
        return " ".join([self.numbers[i] for i in ids])


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    vocab = Vocabulary(path)
    gc.freeze()
    return vocab


@contextlib.contextmanager
def _no_cycles():
    """Millions of small lists and strings, and no cycles among them, are made inside; looking
    for such cycles would take longer than the work."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def compile_lexicon(words: dict[str, list[int]]) -> bytes:
    """Compile words and their ids into a minimal acyclic transducer.

    Words are added in byte order; a state is replaced by an equal one as soon as no further
    word can change it. The file holds a header of four numbers (arcs, states, words, ids),
    arc keys (state * 256 + byte, ascending), arc targets, arc outputs (words that come
    before along other arcs and the end of a word), final flags, id offsets and ids.
    """
    keys = sorted((w.encode("utf-8", "surrogatepass"), ids) for w, ids in words.items())
    register: dict[tuple, int] = {}
    frozen: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
    counts: list[int] = []

    def freeze(final: bool, arcs: list[list[int]]) -> int:
        shape = (final, tuple((b, t) for b, t in arcs))
        if shape not in register:
            register[shape] = len(frozen)
            frozen.append(shape)
            counts.append(final + sum(counts[t] for _, t in arcs))
        return register[shape]

    # The path of the last word: [final, frozen arcs, byte that leads on].
    path: list[list] = [[False, [], None]]

    def shrink(depth: int) -> None:
        while len(path) > depth:
            final, arcs, _ = path.pop()
            path[-1][1].append([path[-1][2], freeze(final, arcs)])

    last = b""
    for key, _ in keys:
        common = 0
        while common < min(len(key), len(last)) and key[common] == last[common]:
            common += 1
        shrink(common + 1)
        for b in key[common:]:
            path[-1][2] = b
            path.append([False, [], None])
        path[-1][0] = True
        last = key
    shrink(1)
    root = freeze(path[0][0], path[0][1])
    arc_key, arc_to, arc_out = [], [], []
    for state, (final, arcs) in enumerate(frozen):
        before = int(final)
        for b, to in arcs:
            arc_key.append(state * 256 + b)
            arc_to.append(to)
            arc_out.append(before)
            before += counts[to]
    offsets = np.cumsum([0, *(len(ids) for _, ids in keys)])
    flat = [i for _, ids in keys for i in ids]
    parts = [np.array([len(arc_key), len(frozen), len(keys), len(flat), root], "<i8"), np.array(arc_key, "<i8"),
             np.array(arc_to, "<i4"), np.array(arc_out, "<i4"),
             np.array([f for f, _ in frozen], "<i4"), np.array(offsets, "<i4"), np.array(flat, "<i4")]
    return b"".join(p.tobytes() for p in parts)


class Lexicon:
    """A compiled lexicon, mapped into memory; looks up many words at once."""

    def __init__(self, data: bytes) -> None:
        with tempfile.TemporaryFile() as f:  # has no name, so nothing is left behind
            f.write(data)
            f.flush()
            self.file = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        n_arcs, n_states, n_words, n_ids, self.root = np.frombuffer(self.file, "<i8", 5).tolist()
        at = 40

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(self.file, kind, n, at)
            at += out.nbytes
            return out

        self.keys = take("<i8", n_arcs)
        self.to, self.out = take("<i4", n_arcs), take("<i4", n_arcs)
        self.final, self.offsets, self.ids = take("<i4", n_states), take("<i4", n_words + 1), take("<i4", n_ids)

    def find(self, words: list[bytes]) -> np.ndarray:
        """The place of each word in the lexicon, -1 where it has none. All words take one
        step at a time."""
        n = len(words)
        result = np.full(n, -1, dtype=np.int64)
        if not n or not len(self.keys):
            return result
        lengths = np.fromiter(map(len, words), np.int64, n)
        order = np.argsort(-lengths, kind="stable")
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])[order]
        flat = np.frombuffer(b"".join(words), np.uint8)
        lengths = lengths[order]
        state = np.full(n, self.root, dtype=np.int64)
        place = np.zeros(n, dtype=np.int64)
        live = np.arange(n)
        step = 0
        while len(live):
            ended = live[lengths[live] == step]
            good = ended[self.final[state[ended]] == 1]
            result[order[good]] = place[good]
            live = live[lengths[live] > step]
            if not len(live):
                break
            wanted = state[live] * 256 + flat[starts[live] + step]
            arc = np.searchsorted(self.keys, wanted)
            arc[arc == len(self.keys)] = 0
            there = self.keys[arc] == wanted
            live, arc = live[there], arc[there]
            place[live] += self.out[arc]
            state[live] = self.to[arc]
            step += 1
        return result


#: What a worker keeps from task to task, for the lexicon it used last.
_lexicons: dict[str, Lexicon] = {}
_digest_encoders: dict[int, Encoder] = {}


def _lexicon(data: bytes) -> Lexicon:
    name = hashlib.sha256(data).hexdigest()
    if name not in _lexicons:
        _lexicons.clear()
        _lexicons[name] = Lexicon(data)
    return _lexicons[name]


def _slices(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about BATCH_CHARS characters, nulls as empty."""
    start, held, size = 0, [], 0
    for i, value in enumerate(column):
        held.append(value.as_py() or "")
        size += len(held[-1])
        if size >= BATCH_CHARS:
            yield start, held
            start, held, size = i + 1, [], 0
    if held:
        yield start, held


def _count_words(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    vocab = vocabulary(path)
    chunks: Counter = Counter()

    def flush() -> pa.RecordBatch:
        words: Counter = Counter()
        for chunk, n in chunks.items():
            if chunk not in vocab.special:
                for w in vocab.words(chunk):
                    words[w] += n
        chunks.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], names=["word", "n"])

    for batch in batches:
        for _, texts in _slices(batch.column(0)):
            with _no_cycles():
                for text in texts:
                    chunks.update(vocab.chunks(text))
                full = flush() if len(chunks) >= COUNTED else None
            if full is not None:
                yield full
    if chunks:
        yield flush()


def word_counts(docs: DataFrame, path: str) -> DataFrame:
    """How often each word occurs in the whole corpus: ``word``, ``n``."""
    bound_batches(docs.sparkSession)
    return docs.select("text").mapInArrow(lambda b: _count_words(b, path), "word string, n bigint").groupBy(
        "word").agg(F.sum("n").alias("n"))


def build_lexicon(docs: DataFrame, path: str, size: int = LEXICON_WORDS) -> bytes:
    """The compiled lexicon of the ``size`` most frequent words of the corpus."""
    top = most_frequent(word_counts(docs, path), size)
    return compile_lexicon(dict(zip(top, vocabulary(path).merge_all(top))))


class Encoder:
    """Encodes texts of a task by the transducer, merging what it doesn't hold.

    ``form`` makes of a chunk's ids what the caller needs; the chunks met last are remembered
    in that form, in two generations: what is not met again while one fills up is forgotten.
    """

    def __init__(self, data: bytes, path: str, form=lambda ids: ids) -> None:
        self.vocab, self.lexicon, self.form = vocabulary(path), _lexicon(data), form
        self.known: dict = {}
        self.older: dict = {}

    def _learn(self, chunks: list[str]) -> None:
        vocab, lex, form, known = self.vocab, self.lexicon, self.form, self.known
        whole = [c for c in chunks if c.isascii() and c.isalpha()]  # one word each
        split = [(c, vocab.words(c)) for c in set(chunks).difference(whole) if c not in vocab.special]
        words = list({w for _, ws in split for w in ws}.union(whole))
        places = lex.find([w.encode("utf-8", "surrogatepass") for w in words])
        starts, ends = lex.offsets[places].tolist(), lex.offsets[places + 1].tolist()
        held, place = lex.ids, places.tolist()
        ids = {w: held[a:b].tolist() for w, p, a, b in zip(words, place, starts, ends) if p >= 0}
        unseen = [w for w, p in zip(words, place) if p < 0]
        ids.update(zip(unseen, vocab.merge_all(unseen)))
        for c in whole:
            known[c] = form(ids[c])
        for c, ws in split:
            known[c] = form(ids[ws[0]] if len(ws) == 1 else [i for w in ws for i in ids[w]])
        for c in chunks:
            if c in vocab.special:
                known[c] = form([vocab.special[c]])

    def encode_all(self, texts: list[str]) -> Iterator[list]:
        """For each text the forms of its chunks."""
        chunked = [self.vocab.chunks(t, apart=True) for t in texts]
        wanted = set().union(*chunked)
        if len(self.known) + len(wanted) > HELD // 2:
            self.known, self.older = {}, self.known
        known, older, new = self.known, self.older, []
        for c in wanted.difference(known):
            if c in older:
                known[c] = older[c]
            else:
                new.append(c)
        self._learn(new)
        for chunks in chunked:
            yield list(map(self.known.__getitem__, chunks))

    def encode(self, text: str) -> list[int]:
        return [i for ids in next(self.encode_all([text])) for i in ids]


def _digests(batches: Iterator[pa.RecordBatch], data, path: str) -> Iterator[pa.RecordBatch]:
    vocab, lexicon = vocabulary(path), _lexicon(data.value)
    encoder = _digest_encoders.get(id(lexicon))
    if encoder is None or encoder.lexicon is not lexicon or encoder.vocab is not vocab:
        _digest_encoders.clear()
        encoder = Encoder(data.value, path, lambda ids: (len(ids), vocab.digits(ids), vocab.text(ids)))
        _digest_encoders[id(lexicon)] = encoder
    sha = hashlib.sha256
    for batch in batches:
        doc_ids = batch.column(0)
        for start, texts in _slices(batch.column(1)):
            n, of_ids, of_text = [], [], []
            with _no_cycles():
                for forms in encoder.encode_all(texts):
                    counts, ids, shown = zip(*forms) if forms else ((), (), ())
                    n.append(sum(counts))
                    of_ids.append(sha(" ".join(ids).encode()).hexdigest())
                    of_text.append(sha(" ".join(shown).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [doc_ids.slice(start, len(texts)), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def _encoded(batches: Iterator[pa.RecordBatch], data, path: str) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(data.value, path)
    for batch in batches:
        for start, texts in _slices(batch.column(1)):
            with _no_cycles():
                ids = [[i for known in forms for i in known] for forms in encoder.encode_all(texts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(start, len(texts)), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])


def encode(docs: DataFrame, path: str | None = None, lexicon: bytes | None = None) -> DataFrame:
    """``doc_id, ids`` of each row of ``docs(doc_id, text)``.

    A null or empty text has no ids; strings of special tokens in a text become their ids.
    Rows that repeat an identifier are encoded each. Other columns are ignored.
    """
    path = path or _tokenizer_path()
    bound_batches(docs.sparkSession)
    data = _shared(docs.sparkSession, lexicon if lexicon is not None else build_lexicon(docs, path))
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        lambda b: _encoded(b, data, path), "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, text`` of each row of ``encoded(doc_id, ids)``; null ids give an empty text."""
    path = path or _tokenizer_path()

    def run(batches):
        vocab = vocabulary(path)
        for batch in batches:
            texts = [vocab.text(ids.as_py() or []) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("bigint"), "ids").mapInArrow(run, "doc_id bigint, text string")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Number of tokens and digests of ids and decoded text, without keeping either."""
    path = path or _tokenizer_path()
    data = _shared(docs.sparkSession, build_lexicon(docs, path))
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        lambda b: _digests(b, data, path),
        "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def _shared(spark: SparkSession, data: bytes):
    return spark.sparkContext.broadcast(data)  # bounded by LEXICON_WORDS


def op4_bpe_transducer(spark, sf_dir):
    return digests(table(spark, sf_dir, "documents"))
