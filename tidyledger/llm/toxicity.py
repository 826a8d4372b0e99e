"""Toxicity by a misspelling-tolerant lexicon and the context of its hits.

The lexicon is a trie of words and of stems (``abc*``: any word that begins so). A Levenshtein automaton runs along it:
its states are sets of (trie node, edits so far), so one pass over a word finds the terms within the allowed number of
edits. The states that occur are numbered once, on the driver, and tasks step all words of a chunk through the
resulting table at the same time. Look-alikes (1 for i, @ for a) are free.

A hit is *quoted* if a quotation mark or a reporting word stands near and no direct address; else it is *abuse*. How
much a hit says is learned: per term, number of edits, context and how often it occurs, the smoothed share of toxic
documents among labelled ones that hold such a hit. A document's score is the chance that at least one of its different
hits is abuse.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyledger.llm.grams import chunks
from tidyledger.llm.labelled import held_out, training_labels
from tidyledger.llm.runtime import cut, share, small

FOLDS, FOLD = 3, 1
THRESHOLD = 0.7
#: Labelled rows from which further terms are taken, at most about this many.
SAMPLE_ROWS = 10_000
#: Words of context on either side of a hit.
WINDOW = 6
#: A further term needs this many toxic documents that no earlier term explains, and this share of toxic ones.
SUPPORT, PRECISION = 4, 0.85
#: Letters of the stems that are considered.
STEMS = (4, 5, 6)
#: A hit that occurs this often or more counts as one that often.
OFTEN = 3
#: Prior chance that a hit is abuse, by context, and its weight in documents.
PRIOR_ABUSE, PRIOR_QUOTED, PRIOR_ROWS = 0.9, 0.3, 2.0

# Common English insults, and words and marks of context.
LEXICON = (
    "bastard", "bitch", "clown", "cretin", "degenerate", "disgusting", "dumbass", "freak", "garbage", "idiot", "imbecile",
    "jerk", "loser", "lunatic", "maggot", "moron", "pathetic", "psycho", "retard", "scum", "scumbag", "stupid", "trash",
    "vermin", "whore", "worthless",
)
REPORTING = ("called", "defined", "means", "quote", "quoted", "quotes", "reported", "said", "saying", "says", "spelled", "term", "word", "wrote")
ADDRESS = ("you", "your", "youre", "ur", "yourself")
QUOTES = ('"', "“", "”", "«", "»", "„", "`")

_LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}


def allowed_edits(term: str) -> int:
    if term.endswith("*"):
        return 0 if len(term) < 8 else 1
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Automaton:
    """All words within the allowed edits of a lexicon, as a table: state, letter -> state. State 0 is dead."""

    def __init__(self, terms: Sequence[str]):
        known = {t for t in terms if t.removesuffix("*").isalpha() and t == t.lower()}
        self.terms = tuple(sorted(known))
        self.letters = "".join(sorted({c for t in self.terms for c in t} - {"*"}))
        children: list[dict[int, int]] = [{}]
        term_at, stem, edits_below = {}, set(), [0]
        for number, term in enumerate(self.terms):
            node, allowed = 0, allowed_edits(term)
            edits_below[0] = max(edits_below[0], allowed)
            for c in term.removesuffix("*"):
                code = self.letters.index(c) + 1
                if code not in children[node]:
                    children[node][code] = len(children)
                    children.append({})
                    edits_below.append(0)
                node = children[node][code]
                edits_below[node] = max(edits_below[node], allowed)
            if term.endswith("*"):  # a node of its own: a word and a stem may be spelled alike
                children[node][-1] = len(children)
                children.append({})
                edits_below.append(allowed)
                node = children[node][-1]
                stem.add(node)
            term_at[node] = number

        def closed(state: dict[int, int]) -> tuple[tuple[int, int], ...]:
            """With letters of the lexicon that the word leaves out; fewest edits per node."""
            best, todo = dict(state), list(state.items())
            while todo:
                node, e = todo.pop()
                for code, child in children[node].items():
                    cost = e + (code > 0)
                    if cost <= edits_below[child] and cost < best.get(child, 99):
                        best[child] = cost
                        todo.append((child, cost))
            return tuple(sorted(best.items()))

        def step(state: tuple[tuple[int, int], ...], letter: int) -> dict[int, int]:
            out: dict[int, int] = {}
            for node, e in state:
                cost = e if node in stem else e + 1  # after a stem any letter, else a letter too many
                if cost <= edits_below[node] and cost < out.get(node, 99):
                    out[node] = cost
                for code, child in children[node].items():
                    cost = e + (code != letter)
                    if code > 0 and cost <= edits_below[child] and cost < out.get(child, 99):
                        out[child] = cost
            return out

        start = closed({0: 0}) if self.terms else ()
        number, states, rows = {(): 0, start: 1}, [(), start], []
        while len(rows) < len(states):
            state = states[len(rows)]
            row = []
            for letter in range(len(self.letters) + 1):  # 0 stands for every letter that is in no term
                to = closed(step(state, letter))
                if to not in number:
                    number[to] = len(states)
                    states.append(to)
                row.append(number[to])
            rows.append(row)
        self.table = np.array(rows, np.int32)
        self.hit = np.full((len(states), 2), -1, np.int32)  # term and edits: fewest edits, then the first term
        for i, state in enumerate(states):
            found = [(e, term_at[n]) for n, e in state if n in term_at and e <= allowed_edits(self.terms[term_at[n]])]
            if found:
                self.hit[i] = min(found)[::-1]
        self.start = 1 if self.terms else 0


class Matcher:
    """Finds hits in texts; made once per task."""

    def __init__(self, automaton: Automaton):
        self.automaton = automaton
        basic = [chr(c) if not 0xD800 <= c < 0xE000 else " " for c in range(1 << 16)]
        self.alpha = np.array([c.isalpha() for c in basic])
        code = {c: i + 1 for i, c in enumerate(automaton.letters)}
        self.letter = np.array([code.get(c.lower(), 0) for c in basic], np.int16)
        self.sign = np.zeros(1 << 16, bool)
        for sign, c in _LOOKALIKES.items():
            self.sign[ord(sign)] = True
            self.letter[ord(sign)] = code.get(c, 0)

    @staticmethod
    def characters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A chunk of UTF-8 as code points (those beyond 16 bits as blanks) and the offsets of its rows."""
        texts = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        return np.where(points < 1 << 16, points, 32), np.r_[0, np.cumsum([len(t) for t in texts])].astype(np.int64)

    def tokens(self, points: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin, end and row of runs of letters; look-alikes belong to a run if a letter follows them."""
        n = len(points)
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        alpha, sign = self.alpha[points], self.sign[points]
        inside = alpha
        if sign.any():
            later = np.minimum.accumulate(np.where(sign, n, np.arange(n))[::-1])[::-1]  # the next that is no look-alike
            row = np.cumsum(edge[:-1])
            inside = alpha | (sign & np.r_[alpha, False][later] & (row[np.minimum(later, n - 1)] == row))
        before = np.r_[False, inside][:-1] & ~edge[:-1]
        after = np.r_[inside[1:], False][:n] & ~edge[1:]
        begin, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        return begin, end, np.searchsorted(offsets, begin, side="right") - 1

    def hits(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, bool]]:
        """(row, term, edits, quoted) for every hit."""
        points, offsets = self.characters(data, offsets)
        begin, end, row = self.tokens(points, offsets)
        letter, table = self.letter[points], self.automaton.table
        state = np.full(len(begin), self.automaton.start, np.int32)
        at = begin.copy()
        live = np.arange(len(begin))
        found: list[np.ndarray] = []
        while len(live):
            state[live] = table[state[live], letter[at[live]]]
            at[live] += 1
            live = live[state[live] > 0]
            done = at[live] == end[live]
            found.append(live[done])
            live = live[~done]
        final = np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)
        for i in final[self.automaton.hit[state[final], 0] >= 0]:
            term, edits = self.automaton.hit[state[i]]
            yield int(row[i]), int(term), int(edits), self.quoted(points, begin, end, row, int(i))

    def quoted(self, points: np.ndarray, begin: np.ndarray, end: np.ndarray, row: np.ndarray, at: int) -> bool:
        first, last = max(0, at - WINDOW), min(len(begin), at + WINDOW + 1)
        spell = lambda a, b: "".join(map(chr, points[a:b]))
        words = {spell(begin[j], end[j]).lower() for j in range(first, last) if row[j] == row[at] and j != at}
        if not words.isdisjoint(ADDRESS):
            return False
        beside = spell(max(0, begin[at] - 1), begin[at]), spell(end[at], end[at] + 1)
        return any(c in QUOTES for c in beside) or not words.isdisjoint(REPORTING)


def candidate_terms(text: str | None) -> set[str]:
    """The different words and stems of a text; a plus is added to those that occur more than once, beside the plain ones."""
    times: Counter[str] = Counter()
    for word, n in Counter(re.findall(r"[^\W\d_]{4,20}", (text or "").lower())).items():
        times[word] += n
        for length in STEMS:
            if len(word) > length:
                times[word[:length] + "*"] += n
    return set(times) | {term + "+" for term, n in times.items() if n > 1}


def _term_counts(texts: DataFrame) -> DataFrame:
    """(term, toxic, clean): labelled texts that hold the term; each task sums its own first."""

    def batch_of(sums: dict[str, list[int]]) -> pa.RecordBatch:
        terms = list(sums)
        columns = [pa.array(terms, pa.string()), *(pa.array([sums[t][i] for t in terms], pa.int64()) for i in (1, 0))]
        return pa.RecordBatch.from_arrays(columns, ["term", "toxic", "clean"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, list[int]] = defaultdict(lambda: [0, 0])
        for batch in batches:
            for label, text in zip(batch.column(0), batch.column(1), strict=True):
                for term in candidate_terms(text.as_py()):
                    sums[term][label.as_py()] += 1
                if len(sums) > 500_000:
                    yield batch_of(sums)
                    sums.clear()
        yield batch_of(sums)

    counted = texts.select("label", "text").mapInArrow(count, "term string, toxic bigint, clean bigint")
    return counted.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def learn_terms(texts: DataFrame, known: Sequence[str] = LEXICON, support: int = SUPPORT) -> list[str]:
    """``known`` and the words and stems that explain further toxic documents, most explaining first.

    ``texts`` (label, text) is a bounded sample. Candidates are held by at least ``support`` toxic texts and by few clean
    ones. One is taken as long as it explains ``support`` toxic texts that none before it does, so words that
    merely stand beside a term are not taken; of equals words come before stems and long ones before short ones.
    """
    toxic, clean = F.col("toxic"), F.col("clean")
    good = _term_counts(texts).filter((toxic >= support) & (toxic >= PRECISION * (toxic + clean + 0.5)))
    top = good.orderBy(F.desc(toxic - 5 * clean), "term").limit(5_000)  # a top-k of candidates
    spoilt = {r.term: r.clean for r in top.collect()}
    wanted = set(spoilt) | set(known)

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [sorted(candidate_terms(text.as_py()) & wanted) for text in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.string()))], ["terms"])

    held = texts.filter("label = 1").select("text").mapInArrow(hold, "terms array<string>")
    open_ = [own for own in (set(r[0]) for r in held.toLocalIterator()) if own.isdisjoint(known)]
    terms = list(known)
    while True:
        gain: dict[str, int] = defaultdict(int)
        for own in open_:
            for term in own:
                gain[term] += 1
        rank = lambda t: (gain[t] - 5 * spoilt[t], "+" not in t, "*" not in t, len(t), t)
        best = max((t for t in gain if gain[t] >= support), key=rank, default=None)
        if best is None:
            return terms
        terms.append(best.removesuffix("+"))
        open_ = [own for own in open_ if best not in own]


def hits(docs: DataFrame, automaton: Automaton, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, hits): the different (term, edits, quoted) of every row with how often, at most OFTEN; empty for no text."""
    shared = share(docs.sparkSession, automaton)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shared())
        kind = pa.list_(pa.struct([("term", pa.int32()), ("edits", pa.int32()), ("quoted", pa.bool_()), ("times", pa.int32())]))
        for batch in batches:
            own: list[Counter] = [Counter() for _ in range(len(batch))]
            for first, data, offsets in chunks(batch.column(1)):
                for row, *hit in matcher.hits(data, offsets):
                    own[first + row][tuple(hit)] += 1
            rows = [[{"term": t, "edits": e, "quoted": q, "times": min(n, OFTEN)} for (t, e, q), n in sorted(h.items())] for h in own]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], ["doc_id", "hits"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), text_col).mapInArrow(
        find, f"doc_id {kind}, hits array<struct<term:int,edits:int,quoted:boolean,times:int>>"
    )


def rates(found: DataFrame, labels: DataFrame, terms: int) -> np.ndarray:
    """Chance of abuse by (term, edits, quoted, times), from all labelled rows given.

    The share of toxic documents among those with such a hit, smoothed by the same over all times, that by the same over all
    terms, and that by the priors.
    """
    rows = found.join(labels, "doc_id").select("label", F.explode("hits").alias("h"))
    counted = rows.groupBy("h.term", "h.edits", "h.quoted", "h.times").agg(F.sum("label").alias("toxic"), F.count(F.lit(1)).alias("n"))
    toxic, n = np.zeros((terms, 3, 2, OFTEN)), np.zeros((terms, 3, 2, OFTEN))
    for r in counted.collect():  # at most 6 * OFTEN per term
        at = r.term, r.edits, int(r.quoted), r.times - 1
        toxic[at], n[at] = r.toxic, r.n
    prior = np.array([PRIOR_ABUSE, PRIOR_QUOTED])
    smooth = lambda t, n, towards: (t + PRIOR_ROWS * towards) / (n + PRIOR_ROWS)
    pooled = smooth(toxic.sum((0, 3)), n.sum((0, 3)), prior)
    per_term = smooth(toxic.sum(3), n.sum(3), pooled)
    return smooth(toxic, n, per_term[..., None])


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted, hits) for every row of ``docs``.

    A text without hits, empty or NULL, scores 0. A NULL id is held out. A repeated row is scored again; in learning it
    counts like any other. Without labels the priors decide. An empty table gives an empty result. Other columns are
    not read.
    """
    sample = small(cut(training_labels(labels, "toxic", FOLDS, FOLD, SAMPLE_ROWS)))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    automaton = Automaton(learn_terms(texts.join(sample, "doc_id").select("label", "text")))
    found = cut(hits(texts, automaton, "doc_id", "text"))
    every = training_labels(labels, "toxic", FOLDS, FOLD, rows=1 << 62)
    chance = rates(found, every, max(1, len(automaton.terms)))
    table = F.array(*[F.lit(float(x)) for x in chance.ravel()])
    place = lambda h: ((h["term"] * 3 + h["edits"]) * 2 + h["quoted"].cast("int")) * OFTEN + h["times"] - 1
    miss = F.aggregate("hits", F.lit(1.0), lambda a, h: a * (1.0 - F.get(table, place(h))))
    score = F.lit(1.0) - miss
    terms = F.array(*[F.lit(t) for t in automaton.terms]) if automaton.terms else F.array(F.lit(""))
    named = F.transform("hits", lambda h: F.concat(F.get(terms, h["term"]), F.lit("~"), h["edits"].cast("string"), F.when(h["quoted"], "q").otherwise("")))
    return found.select(
        F.col("doc_id").alias(id_col), held_out("doc_id", FOLDS, FOLD).alias("held_out"), score.alias("score"),
        (score >= threshold).cast("int").alias("predicted"), F.array_join(named, " ").alias("hits"),
    )
