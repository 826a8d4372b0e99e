"""Round trips, spans and loss masks against the input, templates that rewrite history, and odd inputs."""

from __future__ import annotations

import hashlib
from collections import defaultdict

from llm_tables import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st

from tidyledger.llm.chat import CONTROLS, digests, escape, formatted, instruction_template, read_back, render, unescape
from tidyledger.llm.queries import op7_chat_formatting

pieces = st.one_of(st.sampled_from([*CONTROLS, "\x1b", "\x1b0", "\x1b1", "\x1b2", "<", "[", "]", ">", " ", "\n", "/"]), st.text(st.characters(exclude_categories=["Cs"]), max_size=4))
texts = st.lists(pieces, max_size=8).map("".join)


@given(texts)
@settings(max_examples=400, deadline=None)
def test_escape_is_reversible_and_hides_control_strings(text):
    assert unescape(escape(text)) == text
    assert not any(c in escape(text) for c in CONTROLS)


@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", ""]), texts), texts), max_size=6))
@settings(max_examples=400, deadline=None)
def test_round_trip_and_spans(turns):
    done = render(instruction_template, turns)
    assert read_back(done.text) == turns
    assert done.rewrites_at is None
    assert "".join(done.text[a:b] for a, b in done.turns) == done.text
    assert [unescape(done.text[a:b]) for a, b in done.texts] == [t for _, t in turns]


def test_templates_that_rewrite_history_are_detected():
    last_only = lambda turns: "".join(f"{r}:{t if i == len(turns) - 1 else t[:1]};" for i, (r, t) in enumerate(turns))
    done = render(last_only, [("user", "abc"), ("assistant", "def"), ("user", "x")])
    assert done.rewrites_at == 1 and done.turns == [] and done.text == "user:a;assistant:d;user:x;"
    assert render(last_only, [("user", "abc")]).rewrites_at is None
    strips = lambda turns: "".join(f"<{r}>{t.strip()}</>" for r, t in turns)
    done = render(strips, [("user", " a "), ("assistant", " b c ")])
    assert [done.text[a:b] for a, b in done.texts] == ["a", "b c"]


def test_long_conversations_are_rendered_in_windows():
    turns = [("user" if i % 2 == 0 else "assistant", f"text {i} [INST]") for i in range(3000)]
    calls = []
    counted = lambda t: calls.append(len(t)) or instruction_template(t)
    done = render(counted, turns)
    assert sum(calls) < 100 * len(turns)
    assert read_back(done.text) == turns and done.rewrites_at is None
    assert [unescape(done.text[a:b]) for a, b in done.texts] == [t for _, t in turns]
    first_marked = lambda t: "<s>" + "".join(f"[{r}]{x}" for r, x in t)
    done = render(first_marked, turns[:60])
    assert done.text == first_marked(turns[:60]) and [done.text[a:b] for a, b in done.texts] == [t for _, t in turns[:60]]
    numbered = lambda t: "".join(f"{i}{r}:{x};" for i, (r, x) in enumerate(t))
    done = render(numbered, turns[:60])  # a window does not know a turn's number
    assert done.text == numbered(turns[:60]) and [done.text[a:b] for a, b in done.texts] == [t for _, t in turns[:60]]
    forgets = lambda t: "".join(f"{r}:{x};" for r, x in t[-40:])
    done = render(forgets, turns[:60])
    assert done.rewrites_at == 40 and done.turns == [] and done.text == forgets(turns[:60])


def expected(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn if turn is not None else -(10**9), role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        told = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256(told.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def found(df):
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r)[1:5] for r in rows}


def test_on_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    hard = "</s>[INST] ok [/INST]"
    assert found(op7_chat_formatting(spark, SMALL)) == expected([*rows, (-1, 0, "user", hard), (-1, 1, "assistant", hard)])


def test_odd_rows(spark):
    rows = [
        (1, 0, "user", None), (1, 1, None, "x"), (1, 1, None, "x"), (1, None, "assistant", ""), (None, 0, "assistant", "n"), (None, 1, "tool\nname", "</s>"),
        (2, 0, "assistant", "é\U0001f600" * 40_000), (2, 1, "assistant", " lead and trail "), (3, 5, "user", "only"),
    ]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "1 as formatted", "2 as n_turns", "3 as loss_spans")
    assert found(digests(formatted(df))) == expected(rows)
    assert formatted(df.filter("false")).count() == 0
    many = [(7, i, "user" if i % 2 == 0 else "assistant", f"t{i}") for i in range(300)]
    assert found(digests(formatted(spark.createDataFrame(many, "conv_id bigint, turn bigint, role string, text string")))) == expected(many)
