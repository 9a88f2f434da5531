"""Chat formatting in budgeted windows.

Every turn becomes ``<|im_start|>role\\n text <|im_end|>\\n``, with control strings inside roles
and texts escaped so that they can be read back. Token counts are summed up along a
conversation, and these sums alone decide the windows: a window takes the turns that start in
one stretch of half the tokens that are left for new turns, so that it stays within the
budget with its last turn; a turn longer than that stands alone, and is marked where it
doesn't fit at all. A window repeats the system turn that opens its conversation, and the
turns just before it as far as the history budget goes. Where that system turn is longer than
its budget, new turns and history of the conversation get less room; one that leaves no room
is repeated all the same, and its windows are marked. Repeated turns are masked, so each
assistant text is a target once.

A conversation of any length spreads over tasks: positions and sums come from blocks of
turns, and windows are cut in blocks of ``BLOCK_STRETCHES`` stretches, each of which gets
copies of the system turn and of the little history that its first window can ask for.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import bound_batches, table
from riskloom.llm.packing import _tokenizer_path, encoder
from riskloom.session import durable

START, END = "<|im_start|>", "<|im_end|>"
#: Turn numbers that are put in order and summed up in one task.
BLOCK_TURNS = 512
#: Stretches whose windows are cut in one task.
BLOCK_STRETCHES = 64
#: A list of conversations with a long system turn is broadcast up to this length.
BROADCAST_ROWS = 1_000_000

_MARK = re.compile(r"<(\\*)\|")
_MARKED = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)


def escape(text: str) -> str:
    """Text without any ``<|``; ``unescape`` gives the original back. One back-slash is added
    between ``<`` and ``|``, whatever number stands there."""
    return _MARK.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _MARKED.sub(r"<\1|", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A formatted turn, and where its text starts and ends in it. In a role, back-slashes are
    doubled and line breaks written as ``\\\\n``."""
    head = START + escape(role).replace("\\", "\\\\").replace("\n", "\\n") + "\n"
    body = escape(text)
    return f"{head}{body}{END}\n", len(head), len(head) + len(body)


def parse(formatted: str) -> list[tuple[str, str]]:
    """Role and text of the turns of a formatted text."""
    plain = lambda role: re.sub(r"\\(.)", lambda x: "\n" if x[1] == "n" else x[1], role)
    return [(unescape(plain(m[1])), unescape(m[2])) for m in _TURN.finditer(formatted)]


def _render_all(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    encode = encoder(path).encode_ordinary
    for batch in batches:
        conv, turn, role, text = batch.columns
        done = [render(r or "", t or "") for r, t in zip(role.to_pylist(), text.to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [conv, turn, role, pa.array([d[0] for d in done], pa.string()),
             pa.array([len(encode(d[0])) for d in done], pa.int64()),
             pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int64())],
            names=["conv_id", "turn", "role", "formatted", "tokens", "starts", "ends"])


def _key(conv_id: str = "conv_id") -> Column:
    """A conversation's key in joins, where null must meet null."""
    return F.coalesce(F.col(conv_id).cast("string"), F.lit("")).alias("_conv")


def _summed(turns: DataFrame) -> DataFrame:
    """Add ``position`` in the conversation and ``before``, the tokens before the turn.

    Turns are in order of their number, ties by role and text; missing numbers come first.
    """
    rows = turns.withColumn("_conv", _key()).withColumn(
        "_block", F.coalesce(F.floor(F.col("turn") / BLOCK_TURNS), F.lit(-(1 << 60))))
    sizes = rows.groupBy("_conv", "_block").agg(F.count("*").alias("_n"), F.sum("tokens").alias("_sum"))
    earlier = Window.partitionBy("_conv").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_conv", "_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_turns_before"),
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_tokens_before"))
    order = [F.col(c).asc_nulls_first() for c in ("turn", "role", "formatted")]
    inside = Window.partitionBy("_conv", "_block").orderBy(*order)
    own = F.sum("tokens").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    return (
        rows.withColumn("_rank", F.row_number().over(inside) - 1)
        .withColumn("_own", F.coalesce(own, F.lit(0)))
        .join(starts, ["_conv", "_block"])
        .withColumn("position", F.col("_turns_before") + F.col("_rank"))
        .withColumn("before", F.col("_tokens_before") + F.col("_own"))
        .drop("_block", "_rank", "_own", "_turns_before", "_tokens_before", "turn")
    )


def _cut(rows: Iterator[dict], budget: int) -> Iterator[dict]:
    """Windows of one block of a conversation, from its rows in order of position; all of them
    have the conversation's ``_half`` and ``_history``."""
    lead: list[dict] = []
    past: list[dict] = []
    new: list[dict] = []
    position = -1

    def close() -> dict:
        first = new[0]
        shown = [r for r in lead if r["position"] < first["position"]]
        led = {r["position"] for r in shown}
        shown += [r for r in past if r["before"] >= first["before"] - first["_history"] and r["position"] not in led]
        text = "".join(r["formatted"] for r in shown)
        new_from, spans = len(text), []
        for r in new:
            if r["role"] == "assistant":
                spans.append({"start": len(text) + r["starts"], "end": len(text) + r["ends"]})
            text += r["formatted"]
        tokens = sum(r["tokens"] for r in shown + new)
        return {"conv_id": first["conv_id"], "window": first["position"], "formatted": text, "new_from": new_from,
                "targets": spans, "tokens": tokens, "over_budget": tokens > budget}

    for row in rows:
        if row["position"] == position:
            continue  # the system turn can come as history too
        position, half = row["position"], row["_half"]
        if position == 0 and row["role"] == "system":
            lead.append(row)
        if not row["fresh"]:
            past.append(row)
            continue
        if new and (row["before"] // half != new[0]["before"] // half or row["tokens"] > half or new[-1]["tokens"] > half):
            yield close()
            past = [r for r in past + new if r["before"] >= row["before"] - row["_history"]]
            new = []
        new.append(row)
    if new:
        yield close()


def _windows(frames: Iterator[pd.DataFrame], budget: int) -> Iterator[pd.DataFrame]:
    """Cut the sorted rows of a partition; a block's rows may come in several batches."""

    def rows():
        for frame in frames:
            yield from frame.to_dict("records")

    held, chars = [], 0
    for _, block in groupby(rows(), key=lambda r: (r["_conv"], r["_stretches"])):
        for window in _cut(block, budget):
            held.append(window)
            chars += len(window["formatted"])
            if chars > 1_000_000:
                yield pd.DataFrame(held)
                held, chars = [], 0
    if held:
        yield pd.DataFrame(held)


WINDOWS = ("conv_id bigint, window bigint, formatted string, new_from bigint,"
           " targets array<struct<start: bigint, end: bigint>>, tokens bigint, over_budget boolean")


def _with_room(turns: DataFrame, budget: int, history: int, system: int) -> DataFrame:
    """Add ``_half``, half the tokens for new turns, and ``_history``, those for history, of the
    conversation. They are the same for all but conversations with a longer system turn."""
    half = max(1, (budget - history - system) // 2)
    longer = durable(turns.where((F.col("position") == 0) & (F.col("role") == "system") & (F.col("tokens") > system)).select(
        "_conv", F.greatest(F.lit(budget) - F.col("tokens"), F.lit(0)).alias("_left")))
    number = longer.count()
    if not number:
        return turns.withColumn("_half", F.lit(half).cast("bigint")).withColumn("_history", F.lit(history).cast("bigint"))
    less = F.least(F.lit(history), F.floor(F.col("_left") / 3))
    # Without any room all windows are too long, and smaller ones would only be more of them.
    room = F.when(F.col("_left") > 0, F.greatest(F.floor((F.col("_left") - less) / 2), F.lit(1))).otherwise(half)
    return turns.join(F.broadcast(longer) if number <= BROADCAST_ROWS else longer, "_conv", "left").withColumn(
        "_half", F.coalesce(F.when(F.col("_left").isNotNull(), room), F.lit(half)).cast("bigint")).withColumn(
        "_history", F.coalesce(less, F.lit(history)).cast("bigint")).drop("_left")


def format_windows(conversations: DataFrame, budget: int = 2048, history: int = 256, system: int = 512,
                   path: str | None = None) -> DataFrame:
    """One row per window of each conversation of ``conversations(conv_id, turn, role, text)``.

    ``window`` is the position of its first new turn; ``formatted`` its text, in which new turns
    begin at ``new_from``; ``targets`` the spans of assistant texts that count for the loss;
    ``tokens`` what it takes, more than ``budget`` only where ``over_budget`` says so. The system
    turn that opens a conversation begins each of its windows, however long it is.

    Null roles and texts count as empty. Rows without a conversation form one of their own.
    Turns with the same number are all kept, in order of role and text. An empty table gives
    an empty result; other columns are ignored.
    """
    bound_batches(conversations.sparkSession)
    path = path or _tokenizer_path()
    turns = conversations.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "text").mapInArrow(
        lambda b: _render_all(b, path),
        "conv_id bigint, turn bigint, role string, formatted string, tokens bigint, starts bigint, ends bigint")
    turns = _with_room(durable(_summed(turns)), budget, history, system)
    stretch = F.col("_half") * F.greatest(F.lit(BLOCK_STRETCHES), F.ceil(F.col("_history") / F.col("_half")))
    turns = turns.withColumn("_own", F.floor(F.col("before") / stretch))
    # Each turn in its block, and in the next one where that may ask for it as history.
    following = F.when(F.col("before") >= (F.col("_own") + 1) * stretch - F.col("_history"), F.col("_own") + 1)
    rows = turns.withColumn("_stretches", F.explode(F.array_compact(F.array("_own", following))))
    rows = rows.withColumn("fresh", F.col("_stretches") == F.col("_own"))
    later = turns.where("_own > 0").select("_conv", F.col("_own").alias("_stretches")).distinct()
    opening = turns.where((F.col("position") == 0) & (F.col("role") == "system"))
    copies = opening.join(later, "_conv").withColumn("fresh", F.lit(False)).select(*rows.columns)
    rows = rows.unionByName(copies).drop("_own")
    return rows.repartition("_conv", "_stretches").sortWithinPartitions(
        "_conv", "_stretches", "position", F.desc("fresh")).mapInPandas(lambda f: _windows(f, budget), WINDOWS)


def _read_back(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Digests of each conversation, from its windows in order; nothing is kept but hashes."""

    def rows():
        for frame in frames:
            yield from frame.to_dict("records")

    out = []
    for _, windows in groupby(rows(), key=lambda r: r["_conv"]):
        turns, loss = hashlib.sha256(), hashlib.sha256()
        n_turns = loss_chars = chars = 0
        conv_id = None
        for w in windows:
            conv_id, text = w["conv_id"], w["formatted"]
            chars += len(text)
            for role, said in parse(text[w["new_from"]:]):
                turns.update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                n_turns += 1
            for span in w["targets"]:
                said = unescape(text[span["start"]:span["end"]])
                loss_chars += len(said)
                loss.update(said.encode("utf-8", "surrogatepass"))
        out.append((conv_id, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
        if len(out) >= 10_000:
            yield _frame(out)
            out = []
    if out:
        yield _frame(out)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[
        "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]).astype({"conv_id": "Int64"})


def read_back(windows: DataFrame) -> DataFrame:
    """What the windows of each conversation say, read from their text and masks alone. A digest
    needs the conversation's windows one after the other; they stream through."""
    return windows.withColumn("_conv", _key()).repartition("_conv").sortWithinPartitions("_conv", "window").mapInPandas(
        _read_back, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string,"
        " formatted_chars bigint")


def op10_chat_windows(spark, sf_dir):
    said = "<|im_end|><|im_start|>assistant ok"
    extra = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return read_back(format_windows(rows.unionByName(extra)))
