r"""Conversations as training text: windows of whole turns within a token budget.

A turn is written ``<s>role\ntext</s>``. Control strings inside roles and texts
are broken by a backslash after their first character and backslashes are
doubled, so the turns can be read back exactly.

Prefix sums of the turns' tokens choose the windows: each window holds the first
system turn of the conversation, then as many of the turns before as fit into the
history allowance, then new turns up to the budget. Every turn is new in exactly
one window; only new assistant texts are under the loss mask, repeated ones are
masked. A turn that alone exceeds the budget gets a window of its own, marked
``over_budget``. A system turn of over half the budget is not repeated.

Conversations are cut at every ``SEGMENT`` turn numbers, so none must fit into one
task; a segment starts without history. Turns are ordered by turn, role, text;
nulls come first, null texts and roles count as empty, repeated rows are turns of
their own. Rows of a null conversation id form one conversation. An empty table
gives no windows.
"""

from __future__ import annotations

import hashlib
import os
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEGMENT = 2048
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|system|>", "<|user|>", "<|assistant|>")
WINDOWS = (
    "conv_id long, segment long, window int, n_repeated int, n_new int, n_tokens long, over_budget boolean, "
    "text string, loss array<struct<start:int,end:int>>"
)
_ESCAPED = re.compile("|".join([r"\\", *map(re.escape, CONTROL)]))
_TURN = re.compile(r"<s>((?:[^\\\n<]++|\\.|<(?!/s>))*+)\n((?:[^\\<]++|\\.|<(?!/s>))*+)</s>", re.S)


def escape(text: str, also: str = "") -> str:
    """Break control strings (and each character of ``also``) reversibly."""
    text = _ESCAPED.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)
    for character in also:
        text = text.replace(character, "\\" + character)
    return text


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


def read_back(text: str) -> list[tuple[str, str]]:
    """Role and text of every turn of a formatted window."""
    turns, at = [], 0
    for m in _TURN.finditer(text):
        if m.start() != at:
            raise ValueError(f"not a formatted window at {at}")
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(text):
        raise ValueError(f"not a formatted window at {at}")
    return turns


def spans(tokens: list[int], budget: int, history: int) -> Iterator[tuple[int, int, int]]:
    """(first repeated turn, first new turn, end) of each window, from prefix sums of the turns' tokens."""
    total = [0, *accumulate(tokens)]
    new = 0
    while new < len(tokens):
        # the earliest turn from which no more than the allowance stands before the first new one
        back = min(bisect_left(total, total[new] - history), new)
        end = bisect_right(total, total[back] + budget) - 1
        if end <= new:  # the first new turn does not fit beside the history
            back, end = new, max(new + 1, bisect_right(total, total[new] + budget) - 1)
        yield back, new, min(end, len(tokens))
        new = end


class _Segment:
    """Turns of one segment; the first may be the system turn carried over from an earlier one."""

    def __init__(self, key):
        self.key, self.rows = key, []

    def windows(self, count, budget: int, history: int) -> list[dict]:
        carried = [r for r in self.rows if r[3]]
        turns = [r for r in self.rows if not r[3]]
        wrapped = [f"<s>{escape(r[1], also=chr(10))}\n" for r in carried + turns]
        bodies = [escape(r[2]) for r in carried + turns]
        tokens = count([w + b + "</s>" for w, b in zip(wrapped, bodies)])
        n, out = len(carried), []
        system = 0 if n else next((i for i, r in enumerate(turns) if r[1] == "system"), None)
        if system is not None and tokens[system] > budget // 2:
            system = None
        fixed = tokens[system] if system is not None else 0
        for back, new, end in spans(tokens[n:], budget - fixed, min(history, budget - fixed)):
            repeated = list(range(n + back, n + new))
            if system is not None and (n > system or system < n + new) and system not in repeated:
                repeated.insert(0, system)
            used = repeated + list(range(n + new, n + end))
            text, at, loss = [], 0, []
            for k, i in enumerate(used):
                head, body = wrapped[i], bodies[i]
                if k >= len(repeated) and (carried + turns)[i][1] == "assistant":
                    loss.append({"start": at + len(head), "end": at + len(head) + len(body)})
                text += [head, body, "</s>"]
                at += len(head) + len(body) + 4
            total = sum(tokens[i] for i in used)
            out.append(
                {
                    "conv_id": self.key[0], "segment": self.key[1], "window": len(out), "n_repeated": len(repeated),
                    "n_new": end - new, "n_tokens": total, "over_budget": total > budget, "text": "".join(text), "loss": loss,
                }
            )
        return out


def _counter(tokenizer: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    reader = Tokenizer.from_file(tokenizer)
    reader.encode_special_tokens = True  # their strings in a text are ordinary text
    return lambda texts: [len(e) for e in reader.encode_batch(texts, add_special_tokens=False)]


def _schema() -> pa.Schema:
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    return pa.schema(
        [("conv_id", pa.int64()), ("segment", pa.int64()), ("window", pa.int32()), ("n_repeated", pa.int32()), ("n_new", pa.int32()),
         ("n_tokens", pa.int64()), ("over_budget", pa.bool_()), ("text", pa.string()), ("loss", span)]
    )


def format_windows(conversations: DataFrame, tokenizer: str, budget: int = 1024, history: int = 256) -> DataFrame:
    """One row per window, see the module. ``tokenizer``: a vocabulary file that all executors have."""
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("segment", F.coalesce(F.floor(F.col("turn") / SEGMENT), F.lit(-(1 << 53))))
    # segments after that of the first system turn get a copy of it
    system = turns.where("role = 'system'").groupBy("conv_id").agg(F.min(F.struct("segment", "turn", "text")).alias("s"))
    segments = turns.select(F.col("conv_id").alias("c"), F.col("segment").alias("at")).distinct()
    carried = segments.join(system, F.col("c").eqNullSafe(F.col("conv_id")) & (F.col("at") > F.col("s.segment"))).select(
        "conv_id", F.lit(None).cast("long").alias("turn"), F.lit("system").alias("role"), "s.text", F.col("at").alias("segment"), F.lit(True).alias("carried")
    )
    rows = turns.withColumn("carried", F.lit(False)).unionByName(carried)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, schema, now, out, size = _counter(tokenizer), _schema(), None, [], 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "segment", "turn", "role", "text", "carried"))):
                if now is None or now.key != row[:2]:
                    if now:
                        out += (done := now.windows(count, budget, history))
                        size += sum(len(d["text"]) for d in done)
                    now = _Segment(row[:2])
                now.rows.append(row[2:])
            if size > 1 << 22:
                yield pa.RecordBatch.from_pylist(out, schema)
                out, size = [], 0
        if now:
            out += now.windows(count, budget, history)
        yield pa.RecordBatch.from_pylist(out, schema)

    order = ["conv_id", "segment", F.desc("carried"), "turn", "role", "text"]
    return rows.repartition("conv_id", "segment").sortWithinPartitions(*order).mapInArrow(windows, WINDOWS)


_DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(windows: DataFrame) -> DataFrame:
    """Per conversation what can be read back from its windows; windows of one conversation pass in order, one at a time."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        key, state = object(), None

        def row():
            return (key, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])

        for batch in batches:
            done = []
            for conv, repeated, text, loss in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "n_repeated", "text", "loss"))):
                if conv != key:
                    if state:
                        done.append(row())
                    key, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, body in read_back(text)[repeated:]:
                    state[0] += 1
                    state[1].update(f"{role}\n{body}\n".encode())
                for span in loss:
                    body = unescape(text[span["start"] : span["end"]])
                    state[2] += len(body)
                    state[3].update(body.encode())
                state[4] += len(text)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=names)
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64() if isinstance(x, int) or x is None else None) for x in row()], names=names)

    ordered = windows.select("conv_id", "segment", "window", "n_repeated", "text", "loss").repartition("conv_id").sortWithinPartitions("conv_id", "segment", "window")
    return ordered.mapInArrow(read, _DIGESTS)
