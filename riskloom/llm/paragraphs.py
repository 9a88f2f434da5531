"""Substring dedup by paragraph MinHash banding.

A paragraph is a line; short lines next to each other count as one, and a long line is also cut
into windows of some fifty words, before a word whose hash, taken with the next word's, is the smallest among
``WINDOW_REACH`` words to either side. Paragraphs are described by minima of hashes of their five-word
shingles; those that share a band of minima are joined and their shingle sets compared exactly.
Repeated paragraphs, equal or similar, are clustered by components, and of each cluster the
first one stays.

Passages that repeat inside paragraphs which stay are found by smaller pieces, cut in the same way with
``REACH`` words to either side: such cuts depend on nothing further away, so a passage that is
pasted into another text falls into the same pieces there, but for its ends. Equal pieces are counted. A short
line that many texts share is no passage: only pieces count that are repeated next to others,
``LEAST_PASSAGE`` words in all. Words between two repeated pieces belong to the passage where
the places that are kept of both stand as near each other in one text.

Equal paragraphs share a key and are counted, never joined with each other. Bands are
reduced to their smallest and largest key before anything is gathered, so only bands of
different paragraphs go further; a band of very many is compared tile by tile.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import bound_batches, components, table
from riskloom.llm.vectors import _spread
from riskloom.session import durable

SHINGLE, THRESHOLD = 5, 0.8
#: Words to either side among which a cut is the smallest; paragraphs of long lines have more
#: words than this.
REACH = 4
#: Lines with fewer words are joined with such lines next to them, and of a passage's paragraphs
#: fewer than twice as many words lie between one and the next.
LEAST_WORDS = 7
#: Pieces whose kept places lie as far from each other belong to one passage, up to so many words
#: apart and give or take a few: what lies between them was changed.
CHANGED_WORDS, SHIFT = 48, 4
#: Words that repeated paragraphs next to each other need to have in all to count as a passage.
LEAST_PASSAGE = 12
#: Words of a paragraph that counts by itself; lines of more than so many are cut into windows
#: as well, and are no paragraph as a whole beyond the second number.
LEAST_PARAGRAPH, LONG_LINE, WHOLE_LINE = 12, 100, 400
#: Words to either side among which a window's cut is the smallest.
WINDOW_REACH = 24
#: Minima in a band, and the chance that two paragraphs right at the threshold share a band.
BAND_ROWS, BAND_RECALL = 4, 0.99
#: Paragraphs of one band that are compared in one piece.
TILE = 512
#: Numbers in the matrix of two tiles' shingles.
_CELLS = 4_000_000
#: Numbers in a list that is broadcast; longer ones are joined by the optimiser's choice.
BROADCAST_NUMBERS = 2_000_000
_BATCH_CHARS = 500_000

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def bands(rows: int = BAND_ROWS, threshold: float = THRESHOLD, recall: float = BAND_RECALL) -> int:
    """Bands that two paragraphs at the threshold need to share one with the chance ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _odd(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_letters: list[np.ndarray] = []


def _alphabet() -> tuple[np.ndarray, np.ndarray]:
    """For every code point: whether it is part of a word, and its lower-case form."""
    if not _letters:
        points = range(0x110000)
        _letters.append(np.array([chr(c).isalnum() for c in points]))
        lower = np.arange(0x110000, dtype=np.uint32)
        for c in points:
            if chr(c).isupper() and len(low := chr(c).lower()) == 1:
                lower[c] = ord(low)
        _letters.append(lower)
    return _letters[0], _letters[1]


class Spans:
    """Runs of words: for each its text, span of characters, words and key, the number ``word`` of
    its first word in the text, and the hashes of its words in ``hashes[first:first + words]``."""

    def __init__(self, cut: Cut, first: np.ndarray, words: np.ndarray) -> None:
        self.cut, self.first, self.words, self.text = cut, first, words, cut.text_of[first]
        self.word = first - np.searchsorted(cut.text_of, self.text)
        self.start = cut.opens[first] - cut.offsets[self.text]
        self.stop = cut.closes[first + words - 1] - cut.offsets[self.text]
        self.key = np.zeros(0, dtype=np.uint64)
        if len(first):
            heads = np.r_[0, np.cumsum(words)[:-1]]
            index = np.repeat(first - heads, words) + np.arange(words.sum())
            power = np.multiply.accumulate(np.full(int(words.max()) + 1, _odd(3, 1)[0], dtype=np.uint64))
            self.key = _mix(np.add.reduceat(cut.hashes[index] * power[index - np.repeat(first, words)], heads))

    def banded(self, count: int, rows: int) -> np.ndarray:
        """Band keys of each run (runs, count)."""
        out = np.zeros((len(self.first), count), dtype=np.uint64)
        if not len(self.first):
            return out
        shingles = np.r_[self.cut.shingles(), np.uint64(2**64 - 1)]
        edges = np.stack([self.first, self.first + self.words - SHINGLE + 1], axis=1).ravel()
        multiply, join = _odd(5, count * rows), _odd(6, rows)
        # Every other result is that of a gap, and left out.
        for k in range(count * rows):
            least = np.minimum.reduceat(_mix(shingles * multiply[k]), edges)[::2]
            out[:, k // rows] += least * join[k % rows]
        return _mix(out + np.arange(count, dtype=np.uint64))


class Cut:
    """Some texts as ``lines``, as ``windows`` of long lines, and as ``pieces``."""

    def __init__(self, texts: list[str]) -> None:
        inside, lower = _alphabet()
        codes = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
        self.offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
        part = inside[codes]
        at = np.flatnonzero(part)
        self.opens = np.flatnonzero(part & ~np.r_[False, part[:-1]])
        self.closes = np.flatnonzero(part & ~np.r_[part[1:], False]) + 1
        n = len(self.opens)
        self.hashes = np.zeros(0, dtype=np.uint64)
        self.text_of = np.searchsorted(self.offsets, self.opens, side="right") - 1
        if not n:
            none = np.zeros(0, dtype=np.int64)
            self.pieces = self.lines = self.windows = Spans(self, none, none)
            return
        lengths = self.closes - self.opens
        heads = np.r_[0, np.cumsum(lengths)[:-1]]
        place = np.arange(len(at)) - np.repeat(heads, lengths)
        power = np.multiply.accumulate(np.full(int(lengths.max()) + 1, _odd(1, 1)[0], dtype=np.uint64))
        self.hashes = _mix(np.add.reduceat(_mix(lower[codes[at]].astype(np.uint64) + np.uint64(1)) * power[place], heads))
        text = self.text_of
        line = np.cumsum(codes == 10)[self.opens]
        c = _odd(2, 2)
        value = _mix(self.hashes * c[0] + np.r_[self.hashes[1:], np.uint64(0)] * c[1])
        opens_line = np.r_[True, line[1:] != line[:-1]]
        lines = np.flatnonzero(opens_line)
        short = np.diff(np.r_[lines, n]) < LEAST_WORDS
        opens_line[lines[1:][short[1:] & short[:-1] & (text[lines[1:]] == text[lines[:-1]])]] = False
        cut = np.ones(n, dtype=bool)
        for d in range(1, WINDOW_REACH + 1):
            cut[d:] &= (value[d:] < value[:-d]) | (text[d:] != text[:-d])
            cut[:-d] &= (value[:-d] <= value[d:]) | (text[:-d] != text[d:])
            if d == REACH:
                fine = cut.copy()
        # Near a text's edge there are too few words to tell.
        for found in (fine, cut):
            found[1:] &= text[1:] == text[:-1]
        self._pieces(np.flatnonzero(fine | opens_line), opens_line)
        self._paragraphs(np.flatnonzero(opens_line), cut)

    def _pieces(self, first: np.ndarray, opens_line: np.ndarray) -> None:
        n = len(self.opens)
        # What is too short for a shingle at a line's start or end goes with the piece next to it.
        few, leads = np.diff(np.r_[first, n]) < SHINGLE, opens_line[first]
        joined = few & ~leads
        joined[1:] |= few[:-1] & leads[:-1] & ~leads[1:]
        first = first[~joined]
        words = np.diff(np.r_[first, n])
        keep = words >= SHINGLE
        self.pieces = Spans(self, first[keep], words[keep])

    def _paragraphs(self, lines: np.ndarray, cut: np.ndarray) -> None:
        """Lines, and the windows of long ones."""
        n = len(self.opens)
        words = np.diff(np.r_[lines, n])
        whole = (words >= LEAST_PARAGRAPH) & (words <= WHOLE_LINE)
        self.lines = Spans(self, lines[whole], words[whole])
        of = np.searchsorted(lines, np.arange(n), side="right") - 1
        inner = cut & (words > LONG_LINE)[of]
        # A window has enough words at a line's start and end, too.
        inner &= (np.arange(n) - lines[of] >= LEAST_PARAGRAPH) & (lines[of] + words[of] - np.arange(n) >= LEAST_PARAGRAPH)
        first = np.union1d(lines[words > LONG_LINE], np.flatnonzero(inner))
        of = of[first]
        size = np.minimum(np.r_[first[1:], n], (lines + words)[of]) - first if len(first) else first
        # A line without a cut inside is no window besides.
        keep = ~whole[of] | (size < words[of])
        self.windows = Spans(self, first[keep], size[keep])

    def shingles(self) -> np.ndarray:
        """Hashes of five words in a row; a paragraph's are [first, first + words - 4)."""
        c = _odd(4, SHINGLE)
        n = len(self.hashes) - SHINGLE + 1
        return _mix(sum(self.hashes[k:k + n] * c[k] for k in range(SHINGLE)))


def _runs(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    start, held, size = 0, [], 0
    for i, value in enumerate(texts):
        held.append(value.as_py() or "")
        size += len(held[-1])
        if size >= _BATCH_CHARS:
            yield start, held
            start, held, size = i + 1, [], 0
    if held:
        yield start, held


LINE, WINDOW, PIECE = 0, 1, 2
_SPANS = ("kind int, row bigint, doc_id bigint, text_hash bigint, start int, stop int, word int, words int, key bigint,"
          " bands array<bigint>")


def _spans(batches: Iterator[pa.RecordBatch], count: int, rows: int) -> Iterator[pa.RecordBatch]:
    """Lines and windows, which have bands, and pieces, which have none."""
    for batch in batches:
        for start, texts in _runs(batch.column(3)):
            cut = Cut(texts)
            for kind, found in ((LINE, cut.lines), (WINDOW, cut.windows), (PIECE, cut.pieces)):
                of = pa.array(found.text + start)
                held = pa.nulls(len(found.first), pa.list_(pa.int64()))
                if kind != PIECE:
                    keys = found.banded(count, rows).view(np.int64)
                    held = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, count, dtype=np.int32)), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(found.first), kind, np.int32)), *[batch.column(i).take(of) for i in range(3)],
                     *[pa.array(v.astype(np.int32)) for v in (found.start, found.stop, found.word, found.words)],
                     pa.array(found.key.view(np.int64)), held],
                    names=["kind", "row", "doc_id", "text_hash", "start", "stop", "word", "words", "key", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingle sets of the paragraphs that are asked for by key."""
    for batch in batches:
        for start, texts in _runs(batch.column(0)):
            cut = Cut(texts)
            shingles = cut.shingles() if len(cut.hashes) >= SHINGLE else None
            wanted = [set(batch.column(1)[start + i].as_py()) for i in range(len(texts))]
            keys, sets = [], []
            for found in (cut.lines, cut.windows):
                for text, key, a, n in zip(found.text.tolist(), found.key.view(np.int64).tolist(), found.first.tolist(), found.words.tolist()):
                    if key in wanted[text]:
                        keys.append(key)
                        sets.append(np.unique(shingles[a:a + n - SHINGLE + 1]).view(np.int64).tolist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["key", "shingles"])


def similar(left: list, right: list, threshold: float = THRESHOLD) -> np.ndarray:
    """Which sets have at least that Jaccard similarity: a matrix of left by right."""
    rows = [np.asarray(x, dtype=np.int64) for x in left + right]
    sizes = np.array([len(r) for r in rows], dtype=np.float32)
    _, member, counts = np.unique(np.concatenate(rows), return_inverse=True, return_counts=True)
    # What only one set has is in no intersection.
    shared = counts > 1
    column = np.cumsum(shared) - 1
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    use = shared[member]
    there = np.zeros((len(rows), int(shared.sum())), dtype=np.float32)
    there[row[use], column[member[use]]] = 1
    n = len(left)
    common = there[:n] @ there[n:].T
    either = sizes[:n, None] + sizes[None, n:] - common
    return common >= threshold * either - 1e-6


def _tile(sets: list) -> int:
    """Sets that are compared at a time, so that their matrix stays within some tens of MB."""
    mean = sum(map(len, sets)) / max(len(sets), 1)
    return max(1, min(TILE, int(math.sqrt(_CELLS / max(mean, 1)))))


def _links(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Links of the groups (band, left, right), rows of which follow each other."""
    held: list[tuple] = []
    out_a: list[np.ndarray] = []
    out_b: list[np.ndarray] = []

    def close() -> None:
        _, left, right, _, _, _ = held[0]
        ours = [r for r in held if r[3] == left]
        theirs = ours if left == right else [r for r in held if r[3] == right]
        size = _tile([r[5] for r in held])
        for p in range(0, len(ours), size):
            for q in range(p if left == right else 0, len(theirs), size):
                x, y = ours[p:p + size], theirs[q:q + size]
                near = similar([r[5] for r in x], [r[5] for r in y], threshold)
                kx, ky = np.array([r[4] for r in x], dtype=np.int64), np.array([r[4] for r in y], dtype=np.int64)
                for own, to in zip((kx, ky), _spread(near, kx, ky)):
                    moved = own != to
                    out_a.append(to[moved])
                    out_b.append(own[moved])
        held.clear()

    def batch() -> pa.RecordBatch:
        rows = np.unique(np.stack([np.concatenate(out_a), np.concatenate(out_b)]), axis=1)
        out_a.clear()
        out_b.clear()
        return pa.RecordBatch.from_arrays([pa.array(rows[0]), pa.array(rows[1])], names=["a", "b"])

    for rows in batches:
        for r in zip(*(rows.column(i).to_pylist() for i in range(5)), (x.values.to_numpy() for x in rows.column(5))):
            if held and held[0][:3] != r[:3]:
                close()
            held.append(r)
        if len(out_a) > 10_000:
            yield batch()
    if held:
        close()
    if out_a:
        yield batch()


def _small(keys: DataFrame, numbers: str = "1") -> DataFrame:
    """A durable list, broadcast if the numbers in it are few enough."""
    total = keys.agg(F.sum(F.expr(numbers))).first()[0] or 0
    return F.broadcast(keys) if total <= BROADCAST_NUMBERS else keys


def similar_links(docs: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """Links ``a, b`` between keys of different paragraphs whose similarity reaches the threshold."""
    exploded = paragraphs.select("key", F.explode("bands").alias("band"))
    shared = durable(exploded.groupBy("band").agg(F.min("key").alias("lo"), F.max("key").alias("hi"))
                     .where("lo < hi").select("band"))
    met = durable(exploded.join(_small(shared), "band").select("band", "key").distinct())
    wanted = durable(met.select("key").distinct())
    # One place of each of these paragraphs, to read its words again.
    places = paragraphs.select("key", "doc_id", "text_hash").join(_small(wanted), "key").groupBy("key").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("p"))
    asked = durable(places.groupBy(F.col("p.doc_id").alias("its_id"), F.col("p.text_hash").alias("its_hash")).agg(
        F.collect_list("key").alias("keys")))
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("hash")).join(
        _small(asked, "2 + size(keys)"), F.col("doc_id").eqNullSafe(F.col("its_id")) & (F.col("hash") == F.col("its_hash")))
    sets = durable(texts.select("text", "keys").mapInArrow(_sets, "key bigint, shingles array<bigint>").dropDuplicates(["key"]))
    sizes = met.groupBy("band").agg(F.count("*").alias("n")).withColumn("tiles", F.ceil(F.col("n") / TILE).cast("int"))
    dealt = met.join(sizes, "band").withColumn("tile", F.pmod(F.xxhash64("key"), F.col("tiles")).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    full = dealt.join(sets, "key").select(
        "band", F.least("tile", "other").alias("left"), F.greatest("tile", "other").alias("right"), "tile", "key", "shingles")
    return full.repartition("band", "left", "right").sortWithinPartitions("band", "left", "right", "key").mapInArrow(
        lambda b: _links(b, THRESHOLD), "a bigint, b bigint").distinct()


def _placed(found: DataFrame) -> DataFrame:
    """``found`` with the place of its cluster that is kept, lines before windows, as ``first``, and whether it
    is that place. Clusters of a single place are left out."""
    first = durable(found.groupBy("cluster").agg(
        F.min(F.struct("kind", "doc_id", "row", "start", "word", "words")).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))
    here = F.struct("kind", "doc_id", "row", "start")
    return found.join(first, "cluster").withColumn("kept", here.eqNullSafe(F.struct(*[f"first.{c}" for c in ("kind", "doc_id", "row", "start")])))


def _outside(found: DataFrame, removed: DataFrame) -> DataFrame:
    """Rows of ``found`` that do not lie in a removed span of their text; none lies in one in part,
    since windows are cut where pieces are."""
    both = found.withColumn("gone", F.lit(None).cast("int")).unionByName(
        removed.select("row", "start", F.col("stop").alias("gone")), allowMissingColumns=True)
    upto = F.max("gone").over(Window.partitionBy("row").orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    return both.withColumn("upto", upto).where("gone is null and (upto is null or upto <= start)").select(*found.columns)


def repeated_paragraphs(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Every line that occurs again, equal or similar, and every window that does in what is left."""
    paragraphs = spans.where(F.col("kind") != PIECE)
    again = paragraphs.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    roots = components(similar_links(docs, paragraphs)).withColumnRenamed("node", "key")
    clusters = durable(again.join(roots, "key", "full_outer").select("key", F.coalesce("root", "key").alias("cluster")))
    found = durable(paragraphs.drop("bands").join(clusters, "key").drop("key"))
    lines = durable(_placed(found.where(F.col("kind") == LINE)))
    left = _outside(found.where(F.col("kind") == WINDOW), lines.where("not kept"))
    # A line stands for its cluster; those that are gone already stand for nothing.
    stays = found.where(F.col("kind") == LINE).join(
        lines.where("not kept").select("row", "start", "cluster"), ["row", "start", "cluster"], "left_anti")
    windows = _placed(durable(left.unionByName(stays.select(*left.columns)))).where(F.col("kind") == WINDOW)
    return durable(lines.unionByName(windows.select(*lines.columns)))


def repeated(docs: DataFrame) -> DataFrame:
    """Every paragraph of ``docs(doc_id, text)`` that occurs again, equal or similar, and every
    piece of a repeated passage in what is left: ``kind, row, doc_id, text_hash, start, stop,
    word, words, cluster, kept``.

    ``kind`` is LINE, WINDOW or PIECE. ``start`` and ``stop`` count characters; those of a piece
    take in what lies between it and the next one of the same passage. ``cluster`` is shared by
    all places of a paragraph and what is similar to it, or by all places of a piece; one of them is ``kept``: lines
    before windows, then the smallest identifier, then in one text the first. Spans that are not kept do not overlap, and a place that is
    kept lies in none of them. Paragraphs of a text that repeat each other count. Null and empty
    texts have no paragraphs, and fewer than ``SHINGLE`` words alone are none. Rows
    that repeat an identifier are texts of their own; a null identifier sorts first. An
    empty table gives an empty result; other columns are ignored.
    """
    bound_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("bigint"), "text")
    count = bands()
    spans = durable(docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("text").alias("text_hash"), "text",
    ).mapInArrow(lambda b: _spans(b, count, BAND_ROWS), _SPANS))
    whole = repeated_paragraphs(docs, spans)
    pieces = spans.where(F.col("kind") == PIECE).drop("bands")
    again = durable(pieces.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"))
    found = durable(_outside(pieces.join(again, "key"), whole.where("not kept")).withColumnRenamed("key", "cluster"))
    # What was repeated in removed paragraphs only is not repeated any more.
    still = found.groupBy("cluster").agg(F.count("*").alias("n")).where("n > 1").select("cluster")
    along = Window.partitionBy("row").orderBy("word", "kind")
    placed = _placed(_passages(found.join(still, "cluster"), whole.drop("first"), along))
    return _covering(durable(whole.unionByName(placed.select(*whole.columns))), along)


def _follows(gap: Column, there: Column, same: Column) -> Column:
    """Whether pieces ``gap`` words apart belong together; in the place that is kept they are ``there`` words apart."""
    return (gap < 2 * LEAST_WORDS) | F.coalesce(
        same & (gap < CHANGED_WORDS) & (there - gap).between(-SHIFT, SHIFT), F.lit(False))


def _passages(found: DataFrame, whole: DataFrame, along) -> DataFrame:
    """Pieces in runs of enough words; repeated paragraphs beside them are part of a run."""
    first = found.groupBy("cluster").agg(F.min(F.struct("doc_id", "row", "word")).alias("first"))
    both = found.join(first, "cluster").unionByName(whole.select(*found.columns), allowMissingColumns=True)
    # Between two of a run there is at most what is too short for a piece, or what was changed.
    upto = F.max(F.col("word") + F.col("words")).over(along.rowsBetween(Window.unboundedPreceding, -1))
    before = F.lag(F.struct("word", "words", "first")).over(along)
    there = F.col("first.word") - before["first"]["word"] - before["words"]
    together = _follows(F.col("word") - upto, there, F.col("first.row") == before["first"]["row"])
    runs = both.withColumn("_run", F.sum(F.when(together, 0).otherwise(1)).over(along))
    total = F.sum("words").over(Window.partitionBy("row", "_run"))
    return durable(runs.withColumn("_total", total).where(
        (F.col("_total") >= LEAST_PASSAGE) & (F.col("kind") == PIECE)).drop("_run", "_total", "first"))


def _covering(placed: DataFrame, along) -> DataFrame:
    """Spans up to the next one, where the places that are kept of both follow each other as well."""
    following = F.lead(F.struct("start", "word", "first")).over(along)
    placed = placed.withColumn("_next", following)
    between = F.col("_next.word") - F.col("word") - F.col("words")
    there = F.col("_next.first.word") - F.col("first.word") - F.col("first.words")
    same = F.col("_next.first.row") == F.col("first.row")
    near = (between < 2 * LEAST_WORDS) & there.between(0, 2 * LEAST_WORDS - 1)
    changed = (between < CHANGED_WORDS) & (there - between).between(-SHIFT, SHIFT)
    covers = same & (between >= 0) & (near | changed)
    return placed.withColumn("stop", F.when(covers, F.col("_next.start")).otherwise(F.col("stop"))).withColumn(
        "words", F.when(covers, F.col("words") + between).otherwise(F.col("words"))).drop("_next", "first")


def repeated_by_document(docs: DataFrame) -> DataFrame:
    """One row per text with a repeated paragraph: ``doc_id, n_repeated, n_removed,
    removed_words, spans``; spans are in order of their place."""
    return repeated(docs).groupBy("row", "doc_id").agg(
        F.count("*").alias("n_repeated"), F.count_if(~F.col("kept")).alias("n_removed"),
        F.coalesce(F.sum(F.when(~F.col("kept"), F.col("words"))), F.lit(0)).cast("long").alias("removed_words"),
        F.array_sort(F.collect_list(F.struct("start", "stop", "words", "cluster", "kept"))).alias("spans")).drop("row")


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with all but the kept place of each repeated paragraph cut out of ``text``."""
    cuts = repeated(docs).where("not kept").groupBy(F.col("doc_id").alias("its_id"), F.col("text_hash").alias("its_hash")).agg(
        F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("cuts"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"))
    joined = rows.join(cuts, F.col("id").eqNullSafe(F.col("its_id")) & (F.col("hash") == F.col("its_hash")), "left")
    text = F.col("row.text")
    # What lies between two cuts; none grows with the text.
    before = lambda i: F.when(i > 0, F.get("cuts", i - 1)["stop"]).otherwise(0)
    rest = F.concat(
        F.array_join(F.transform("cuts", lambda c, i: F.substr(text, before(i) + 1, c["start"] - before(i))), ""),
        F.substr(text, before(F.size("cuts")) + 1))
    new = F.when(F.col("cuts").isNull(), text).otherwise(rest)
    return joined.select(*[(new if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns])


def op1_paragraph_dedup(spark, sf_dir):
    return repeated_by_document(table(spark, sf_dir, "documents"))
