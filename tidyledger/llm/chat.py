"""Chat formatting with any template, and the span of every turn found by rendering alone.

A template is a black box: a function from a list of (role, text) turns to a string. The conversation is rendered prefix
by prefix. If each rendering begins with the one before, what it adds is the new turn's span; a template that changes
earlier output is reported with the first turn that does so. Within a turn's span the text itself is found by rendering the
same prefix with another text in the last turn: what both renderings share at both ends is the template's own marks.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

# The marks of the common instruction format.
MARKS = {"user": ("<s>[INST] ", " [/INST]"), "assistant": (" ", " </s>"), "system": ("<<SYS>>\n", "\n<</SYS>>\n\n")}
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<<ROLE>>", "<</ROLE>>")

#: Turns before the new one that a prefix of a long conversation keeps.
WINDOW = 16

_ESCAPE = "\x1b"
_CONTROL = re.compile("|".join(re.escape(c) for c in sorted(CONTROLS, key=len, reverse=True)))


def escape(text: str) -> str:
    """``text`` without control strings: a mark goes inside each, and the escape character itself is marked too."""
    text = text.replace(_ESCAPE, _ESCAPE + "0")
    return _CONTROL.sub(lambda m: f"{m[0][0]}{_ESCAPE}1{m[0][1:]}", text)


def _one_line(role: str) -> str:
    return escape(role).replace("\n", _ESCAPE + "2")


def unescape(text: str) -> str:
    return text.replace(_ESCAPE + "1", "").replace(_ESCAPE + "2", "\n").replace(_ESCAPE + "0", _ESCAPE)


def instruction_template(turns: list[Turn]) -> str:
    """The instruction format; a role without marks of its own is named inside ROLE marks. Texts are escaped."""
    out = []
    for role, text in turns:
        before, after = MARKS.get(role, (f"<<ROLE>>{_one_line(role)}\n", "<</ROLE>>"))
        out.append(before + escape(text) + after)
    return "".join(out)


@dataclass
class Rendered:
    """A rendered conversation; spans are (begin, end) in ``text``, or empty where the template rewrites history."""

    text: str = ""
    turns: list[tuple[int, int]] = field(default_factory=list)
    texts: list[tuple[int, int]] = field(default_factory=list)
    rewrites_at: int | None = None


def _shared(a: str, b: str) -> int:
    """Length of the common beginning, by halving."""
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[lo:mid] == b[lo:mid] else (lo, mid - 1)
    return lo


def render(template: Template, turns: list[Turn], window: int = WINDOW) -> Rendered:
    """Renders successive prefixes and compares consecutive outputs.

    The part of a text that its span covers is what changes when the text changes, so for a template that strips or
    rewrites a text the span covers what is left of it.

    In a long conversation prefixes begin ``window`` turns before the new one, so the work grows with the length and not
    with its square. The whole conversation is rendered once at the end; unless the spans add up to exactly that,
    prefixes are taken from the beginning.
    """
    out = Rendered()
    for i, (role, text) in enumerate(turns):
        base = turns[max(0, i - window) : i]
        before = out.text if i <= window else template(base)
        now = template([*base, (role, text)])
        if not now.startswith(before):
            return Rendered(template(turns), rewrites_at=i) if i <= window else render(template, turns, len(turns))
        # two probes that differ in their first and last characters: their shared ends are the marks
        one, two = template([*base, (role, "0")]), template([*base, (role, "1")])
        head = _shared(one, two)
        tail = _shared(one[head:][::-1], two[head:][::-1])
        first = min(head, len(now))
        shift = len(out.text) - len(before)
        out.turns.append((len(out.text), shift + len(now)))
        out.texts.append((shift + first, shift + max(first, len(now) - tail)))
        out.text += now[len(before) :]
    if len(turns) > window + 1 and template(turns) != out.text:
        return render(template, turns, len(turns))
    return out


def read_back(text: str) -> list[Turn]:
    """The turns of a string made by ``instruction_template``."""
    marks = {before: (role, after) for role, (before, after) in MARKS.items()}
    order = sorted(marks, key=len, reverse=True)  # the assistant's mark, a blank, is tried last
    turns, at = [], 0
    while at < len(text):
        if text.startswith("<<ROLE>>", at):
            line = text.index("\n", at)
            role, after = unescape(text[at + 8 : line]), "<</ROLE>>"
            at = line + 1
        else:
            before = next(b for b in order if text.startswith(b, at))
            role, after = marks[before]
            at += len(before)
        end = text.index(after, at)
        turns.append((role, unescape(text[at:end])))
        at = end + len(after)
    return turns


SCHEMA = (
    "conv_id {kind}, formatted string, n_turns bigint, turn_spans array<struct<begin:int,end:int>>, "
    "loss_spans array<struct<begin:int,end:int>>, rewrites_at int"
)


def formatted(
    rows: DataFrame, template: Template = instruction_template, learn: tuple[str, ...] = ("assistant",),
    conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """One row per conversation: conv_id, formatted, n_turns, turn_spans, loss_spans (texts of the ``learn`` roles), rewrites_at.

    Turns are ordered by turn (NULL first), ties by role and text, so repeated rows are repeated turns. A NULL text is
    empty, a NULL role is the empty role, rows with a NULL conv_id are one conversation. Where the template rewrites
    history, rewrites_at is the first turn that shows it and there are no spans. An empty table gives an empty result.
    A conversation becomes one string and so must fit in a task; conversations are streamed one by one.
    """
    own = rows.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    dealt = own.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def finish(conv, turns: list[Turn]) -> dict:
        done = render(template, turns)
        span = lambda s: {"begin": s[0], "end": s[1]}
        loss = [span(s) for s, (role, _) in zip(done.texts, turns) if role in learn]
        return {
            "conv_id": conv, "formatted": done.text, "n_turns": len(turns), "turn_spans": [span(s) for s in done.turns],
            "loss_spans": loss, "rewrites_at": done.rewrites_at,
        }

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["conv_id", "formatted", "n_turns", "turn_spans", "loss_spans", "rewrites_at"]
        conv, turns, out, held = None, [], [], 0
        for batch in batches:
            missing = batch["conv_id"].isna()
            for cid, null, role, text in zip(batch["conv_id"], missing, batch["role"], batch["text"], strict=True):
                cid = None if null else cid
                if turns and cid != conv:
                    out.append(finish(conv, turns))
                    held, turns = held + len(out[-1]["formatted"]), []
                conv = cid
                turns.append((role, text))
                if held > 1 << 22:
                    yield pd.DataFrame(out, columns=names)
                    out, held = [], 0
        if turns:
            out.append(finish(conv, turns))
        if out:
            yield pd.DataFrame(out, columns=names).astype({"rewrites_at": "Int32"})

    kind = rows.schema[conv_col].dataType.simpleString()
    return dealt.mapInPandas(stream, SCHEMA.format(kind=kind))


def digests(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, all read back from the formatted text."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                turns = read_back(row.formatted)
                told = "".join(f"{role}\n{text}\n" for role, text in turns)
                loss = "".join(unescape(row.formatted[s["begin"] : s["end"]]) for s in row.loss_spans)
                out.append(
                    (
                        row.conv_id, len(turns), hashlib.sha256(told.encode()).hexdigest(), len(loss),
                        hashlib.sha256(loss.encode()).hexdigest(), len(row.formatted),
                    )
                )
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            yield pd.DataFrame(out, columns=names)

    kind = conversations.schema["conv_id"].dataType.simpleString()
    return conversations.select("conv_id", "formatted", "loss_spans").mapInPandas(
        read, f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    )
