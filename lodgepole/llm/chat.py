"""Chat formatting by incremental black-box rendering.

The template is any function from a list of turns to a string; nothing is
known about it.  Rendering the prefixes of 1, 2, ... turns and comparing each
output with the one before locates the span of every turn: what the longer
output adds.  A template that changes what it wrote earlier (moves the system
turn, closes an open block later) is found because the shorter output is then
no prefix of the longer one; such a conversation is marked ``rewrites`` and
has no spans.  Inside a span the text itself is located by rendering the turn
once more with an empty text: the common prefix and suffix of both spans frame
the text.

Conversations are streamed in order through a task, so memory is bounded by
a few copies of one conversation's formatted text (which is one row of the result, so one
conversation cannot be split).  A black box must be asked for every prefix: a template that
renders from scratch takes the square of a conversation's turns; ``ChatML`` appends
to what it last wrote, so that only copying and comparing its output does.

``chatml`` is the template of the registered query.  It escapes control strings
in roles and texts: ``\\`` becomes ``\\\\`` and ``<|`` becomes ``<\\|``; both
are undone by ``unescape``, and no escaped text holds ``<|``.

Defined results: rows are ordered by turn (null first), then role, then text;
repeated rows are turns of their own; null role and null text count as empty;
rows with a null conv_id form one conversation; an empty table gives none.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

START, END = "<|im_start|>", "<|im_end|>"


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    """Inverse of ``escape``: a backslash stands for the character after it."""
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def _one(turn: Turn) -> str:
    role = escape(turn[0]).replace("\n", "\\\n")
    return f"{START}{role}\n{escape(turn[1])}{END}\n"


class ChatML:
    """The template of the registered query.

    A call that adds one turn to what one of the last calls was given appends to that
    call's output; any other renders all turns.  The result never depends on it.
    """

    _KEPT = 2

    def __init__(self) -> None:
        self._last: deque[tuple[list[Turn], str]] = deque(maxlen=self._KEPT)

    def __call__(self, turns: list[Turn]) -> str:
        turns = list(turns)
        for before, text in self._last:
            if len(before) == len(turns) - 1 and turns[:-1] == before:
                out = text + _one(turns[-1])
                break
        else:
            out = "".join(map(_one, turns))
        self._last.append((turns, out))
        return out

    def __reduce__(self):
        return ChatML, ()


chatml = ChatML()


@dataclass
class Rendered:
    text: str
    turns: list[tuple[int, int]]  # span of each turn, empty if the template rewrites
    texts: list[tuple[int, int]]  # span of each turn's own (escaped) text
    rewrites: bool


def _common(a: str, b: str) -> int:
    """Length of the common prefix, by doubling and halving slices."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n
    while lo < hi - 1:
        mid = (lo + hi) // 2
        lo, hi = (mid, hi) if a[lo:mid] == b[lo:mid] else (lo, mid)
    return lo


def render(template: Template, turns: list[Turn], text_of: Callable[[str], str] = escape) -> Rendered:
    """Render all prefixes and locate the span of each turn and of its text.

    ``text_of`` is how the template writes a text; where the frame alone leaves
    the place open (a text that looks like the frame), it settles it.
    """
    so_far, spans, texts = "", [], []
    for k, (role, text) in enumerate(turns, 1):
        out = template(turns[:k])
        if not out.startswith(so_far):
            return Rendered(template(turns), [], [], True)
        empty = template([*turns[: k - 1], (role, "")])
        at = len(so_far)
        if not empty.startswith(so_far):
            return Rendered(template(turns), [], [], True)
        tail, bare, own = out[at:], empty[at:], text_of(text)
        lead = _common(tail, bare)
        # the text stands where taking it out leaves the bare turn
        while lead >= 0 and not (tail.startswith(own, lead) and tail[:lead] + tail[lead + len(own) :] == bare):
            lead -= 1
        if lead < 0:
            return Rendered(template(turns), [], [], True)
        spans.append((at, len(out)))
        texts.append((at + lead, at + lead + len(own)))
        so_far = out
    return Rendered(so_far, spans, texts, False)


def read_back(formatted: str) -> list[Turn]:
    """Turns of a ``chatml`` text."""
    turns = []
    for part in formatted.split(START)[1:]:
        body = part.removesuffix("\n").removesuffix(END)
        # the role ends at the first newline that no backslash escapes
        m = re.match(r"((?:[^\\\n]|\\.)*)\n", body, re.S)
        turns.append((unescape(m[1]), unescape(body[m.end() :])))
    return turns


def _conversations(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[object, list[Turn]]]:
    """Whole conversations of sorted rows, across batch borders."""
    now, turns, any_ = None, [], False
    for b in batches:
        for c, is_null, role, text in zip(b["conv_id"], b["no_id"], b["role"], b["text"], strict=True):
            c = None if is_null else int(c)
            if any_ and c != now:
                yield now, turns
                turns = []
            now, any_ = c, True
            turns.append((role, text))
    if any_:
        yield now, turns


def format_conversations(rows: DataFrame, template: Template = chatml, text_of: Callable[[str], str] = escape, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: formatted text, turn and loss spans, ``rewrites``.

    ``loss`` holds the spans of the texts of ``loss_roles``: the loss mask.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        size = 0
        for conv, turns in _conversations(batches):
            got = render(template, turns, text_of)
            loss = [list(s) for s, (role, _) in zip(got.texts, turns, strict=False) if role in loss_roles]
            out.append((conv, got.text, [list(s) for s in got.turns], loss, got.rewrites))
            size += len(got.text)
            if size > 4 << 20:
                yield _frame(out)
                out, size = [], 0
        if out:
            yield _frame(out)

    clean = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.col("conv_id").isNull().alias("no_id"),
    )
    ordered = clean.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    keyed = ordered.select(F.coalesce("conv_id", F.lit(0)).alias("conv_id"), "no_id", "role", "text")
    return keyed.mapInPandas(run, "conv_id long, formatted string, turns array<array<int>>, loss array<array<int>>, rewrites boolean")


def _frame(rows: list[tuple]) -> pd.DataFrame:
    f = pd.DataFrame(rows, columns=["conv_id", "formatted", "turns", "loss", "rewrites"])
    f["conv_id"] = f["conv_id"].astype("Int64")
    return f


def digests(formatted: DataFrame) -> DataFrame:
    """What reading the formatted conversations back gives, as counts and digests."""

    @F.pandas_udf("struct<n_turns: long, turns_sha256: string, loss_chars: long, loss_sha256: string, formatted_chars: long>")
    def measure(text: pd.Series, loss: pd.Series) -> pd.DataFrame:
        out = []
        for t, spans in zip(text, loss, strict=True):
            turns = read_back(t)
            told = hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest()
            learned = "".join(unescape(t[a:b]) for a, b in spans)
            out.append((len(turns), told, len(learned), hashlib.sha256(learned.encode()).hexdigest(), len(t)))
        return pd.DataFrame(out, columns=["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.select("conv_id", measure("formatted", "loss").alias("m")).select("conv_id", "m.*")
