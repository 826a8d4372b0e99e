"""N-gram Jaccard self-join by vertical partitioning.

The global order of n-grams is the order of their 64-bit hashes. It is cut into FRAGMENTS equal ranges; a set is cut
into one segment per range. For each candidate pair the overlap is counted in every fragment on its own, in separate
rows, and the partial counts are summed per pair.

Sets are joined, not documents: documents with equal sets are one class. Candidates come from two filters:

* The *low end* of a set, its SKETCH smallest n-grams, is looked at for all sets. Two linked sets share most of them, so a set
  of whose low end too few n-grams occur in any other set has no links and is done. For sets that lie wholly in
  their low end this is exact; for larger ones a linked set passes but for a chance below 1e-9 (binomial tail at the
  threshold, far less above it).
* The sets that are left are taken whole. N-grams are ordered by how many of these sets hold them, and linked sets must
  share one of the rarest few (prefix filter), at positions that leave enough n-grams after them (positional filter).

Popular n-grams never pair everybody with everybody. In the first round each set is compared with one hub per
n-gram, the set with the smallest share of n-grams of its own, which joins a large group of near copies with as many
comparisons as sets. In the second, an n-gram is looked at again only where it still spans several components, and only
the sets outside its largest component are compared with the others, if sizes and positions allow a link. Both rounds
together lose no link between components.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidyledger.llm.components import components
from tidyledger.llm.grams import K, Words, lists, mix
from tidyledger.llm.runtime import cut, small

SKETCH = 32
FRAGMENTS = 8
PERCENT = 80


def shared_at_least(size: int, percent: int, miss: float = 1e-9) -> int:
    """n-grams that the low ends of two linked sets share but for a chance of ``miss``."""
    p, below = percent / 100, 0.0
    for i in range(size + 1):
        below += comb(size, i) * p**i * (1 - p) ** (size - i)
        if below > miss:
            return i
    return size


def sketches(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """Per row: id, a key of id and text, n_shingles, set_id (a hash of the set; NULL for the empty one) and its low end."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(k)
        for batch in batches:
            sizes, ids, low = [], [], []
            for grams in words.sets(batch.column(2)):
                sizes.append(len(grams))
                ids.append(mix(mix(grams).sum(keepdims=True)).view(np.int64)[0])
                low.append(grams[:SKETCH])
            n = pa.array(sizes, pa.int64())
            set_id = pa.array(np.array(ids, np.int64), mask=np.array(sizes, np.int64) == 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), n, set_id, lists(low)], ["id", "key", "n_shingles", "set_id", "low"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    keyed = docs.select(id_col, F.xxhash64(id_col, text_col), text_col)
    return keyed.mapInArrow(rows, f"id {kind}, key bigint, n_shingles bigint, set_id bigint, low array<bigint>")


def segments(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(set_id, n, part, grams): the sets of the rows with a wanted key, cut by ranges of the global order."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, bounds = Words(k), np.arange(1, FRAGMENTS, dtype=np.uint64) * np.uint64((1 << 64) // FRAGMENTS)
        for batch in batches:
            for at in range(0, len(batch), 256):  # whole sets: small output batches
                piece = batch.slice(at, 256)
                set_ids, sizes, parts, grams = [], [], [], []
                for set_id, whole in zip(piece.column(0).to_pylist(), words.sets(piece.column(1)), strict=True):
                    for part, own in enumerate(np.split(whole, np.searchsorted(whole, bounds))):
                        if len(own):
                            set_ids.append(set_id)
                            sizes.append(len(whole))
                            parts.append(part)
                            grams.append(own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(set_ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(parts, pa.int32()), lists(grams)],
                    ["set_id", "n", "part", "grams"],
                )

    texts = docs.select(F.xxhash64(id_col, text_col).alias("key"), F.col(text_col).alias("_text"))
    chosen = texts.join(small(wanted.select("key", "set_id")), "key").select("set_id", "_text")
    return chosen.mapInArrow(rows, "set_id bigint, n bigint, part int, grams array<bigint>")


def _own_key(key: str) -> Column:
    """A new column of the same values, so that a join on it adds a plain exchange on both sides and a hot key can be split."""
    return (F.col(key) + F.lit(0)).alias(key)


def _popular(held: DataFrame) -> DataFrame:
    """(gram, sets) of the n-grams that several sets hold."""
    counts = held.groupBy("gram").agg(F.count(F.lit(1)).alias("sets")).filter("sets > 1")
    return counts.select(_own_key("gram"), "sets")


def _may_link(classes: DataFrame, percent: int) -> DataFrame:
    """(set_id, key) of the sets of whose low end enough n-grams occur elsewhere."""
    held = classes.select("set_id", "n", F.size("low").alias("size"), F.explode("low").alias("gram"))
    met = held.join(_popular(held).select("gram"), "gram").groupBy("set_id", "n").agg(F.count(F.lit(1)).alias("met"))
    exact = F.ceil(F.col("n") * percent / F.lit(100))
    partner_may_be_cut = F.col("n") * 100 > SKETCH * percent
    enough = F.when(partner_may_be_cut, F.lit(shared_at_least(SKETCH, percent))).otherwise(exact)
    passed = met.filter(F.col("met") >= enough).select(_own_key("set_id"))
    return classes.select("set_id", "key").join(passed, "set_id")


def _postings(cuts: DataFrame, percent: int) -> DataFrame:
    """(set_id, n, alone, gram, left): the n-grams by which a set may meet a linked one.

    alone is how many of its n-grams no other set holds; left is what follows from this one on, itself included.
    """
    held = cuts.select("set_id", "n", F.explode("grams").alias("gram"))
    met = held.join(_popular(held), "gram").groupBy("set_id", "n").agg(
        F.array_sort(F.collect_list(F.struct("sets", "gram"))).alias("met")  # at most one set
    )
    alone = F.col("n") - F.size("met")
    prefix = F.col("n") - F.ceil(F.col("n") * percent / F.lit(100)) + 1
    take = F.greatest(F.lit(0), prefix - alone).cast("int")
    rows = met.select("set_id", "n", alone.alias("alone"), F.posexplode(F.slice("met", F.lit(1), take)).alias("at", "m"))
    return rows.select("set_id", "n", "alone", "m.gram", (F.col("n") - F.col("alone") - F.col("at")).alias("left"))


def _may_pair(n: Column, left: Column, m: Column, right: Column, percent: int) -> Column:
    """Whether sizes, and what is left in both sets from the shared n-gram on, allow a link."""
    enough = F.least(left, right) * (100 + percent) >= (n + m) * percent
    return enough & (F.least(n, m) * 100 >= F.greatest(n, m) * percent)


def _verified(pairs: DataFrame, cuts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are links, by the sum of their partial overlaps. ``pairs``: a, b, na, nb."""
    mine = cuts.select(F.col("set_id").alias("a"), "part", F.col("grams").alias("grams_a"))
    theirs = cuts.select(F.col("set_id").alias("b"), "part", F.col("grams").alias("grams_b"))
    parts = pairs.select("*", F.explode(F.sequence(F.lit(0), F.lit(FRAGMENTS - 1))).alias("part"))
    met = parts.join(mine, ["a", "part"]).join(theirs, ["b", "part"])
    partial = met.select("a", "b", "na", "nb", F.size(F.array_intersect("grams_a", "grams_b")).alias("o"))
    summed = partial.groupBy("a", "b", "na", "nb").agg(F.sum("o").alias("o"))
    return summed.filter(F.col("o") * 100 >= (F.col("na") + F.col("nb") - F.col("o")) * percent).select("a", "b")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, percent: int = PERCENT
) -> DataFrame:
    """One row per row of ``docs``: its id, n_shingles, component_id (the smallest id reachable by links).

    Two texts are linked when the Jaccard similarity of their sets of ``k``-word shingles is ``percent`` / 100 or more,
    decided in whole numbers. A text without words (or NULL) has the empty set, no links and its own id. Rows with equal
    sets are always linked, repeated rows included, and each is returned. A row with a NULL id takes part; it gets the
    component's smallest id, NULL if there is none. An empty table gives an empty result. Other columns are not read.
    """
    rows = cut(sketches(docs, id_col, text_col, k))
    full = rows.filter("n_shingles > 0")
    first = F.min(F.struct(F.col("key"), F.col("low")))  # equal sets have equal low ends
    classes = full.groupBy("set_id").agg(F.first("n_shingles").alias("n"), F.min("id").alias("first_id"), first.alias("f"))
    classes = cut(classes.select("set_id", "n", "first_id", "f.key", "f.low"))
    cuts = segments(docs, cut(_may_link(classes, percent)), id_col, text_col, k)
    if rows.groupBy("key").count().filter("count > 1").limit(1).count():  # a repeated row gives its set again
        cuts = cuts.dropDuplicates(["set_id", "part"])
    cuts = cut(cuts)
    postings = cut(_postings(cuts, percent))

    c = F.col
    central = F.min(F.struct((c("alone") / c("n")).alias("share"), "set_id", "n", "left"))
    hubs = postings.groupBy("gram").agg(central.alias("h"), F.count(F.lit(1)).alias("sets")).filter("sets > 1")
    hubs = hubs.select(_own_key("gram"), c("h.set_id").alias("a"), c("h.n").alias("na"), c("h.left").alias("right"))
    near_hub = postings.join(hubs, "gram").filter("set_id <> a").filter(_may_pair(c("n"), c("left"), c("na"), c("right"), percent))
    tried = cut(near_hub.select("a", c("set_id").alias("b"), "na", c("n").alias("nb")).distinct())
    links = cut(_verified(tried, cuts, percent))
    labels = components(links)

    known = labels.select(c("node").alias("set_id"), "label")
    placed = cut(postings.join(known, "set_id", "left").withColumn("label", F.coalesce("label", "set_id")).drop("alone"))
    per_label = placed.groupBy("gram", "label").agg(F.count(F.lit(1)).alias("sets"))
    spans = per_label.groupBy("gram").agg(F.max_by("label", F.struct("sets", "label")).alias("major"), F.count(F.lit(1)).alias("labels"))
    spans = spans.filter("labels > 1").select(_own_key("gram"), "major")
    open_ = cut(placed.join(spans, "gram"))
    x, y = open_.filter("label <> major").alias("x"), open_.alias("y")
    apart = x.join(
        y,
        (c("x.gram") == c("y.gram"))
        & (c("x.label") != c("y.label"))
        & ((c("y.label") == c("y.major")) | (c("x.set_id") < c("y.set_id")))
        & _may_pair(c("x.n"), c("x.left"), c("y.n"), c("y.left"), percent),
    )
    ends = apart.select(
        F.when(c("x.set_id") < c("y.set_id"), F.struct(c("x.set_id").alias("a"), c("y.set_id").alias("b"), c("x.n").alias("na"), c("y.n").alias("nb")))
        .otherwise(F.struct(c("y.set_id").alias("a"), c("x.set_id").alias("b"), c("y.n").alias("na"), c("x.n").alias("nb"))).alias("p")
    ).select("p.*").distinct()
    done = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    rest = cut(ends.join(done, ["a", "b"], "left_anti"))
    more = cut(_verified(rest, cuts, percent))
    if more.limit(1).count():
        labels = components(links.union(more))

    component = labels.select(c("node").alias("set_id"), "label")
    of_class = classes.join(component, "set_id", "left").select("set_id", "first_id", F.coalesce("label", "set_id").alias("label"))
    smallest = of_class.groupBy("label").agg(F.min("first_id").alias("component_id"))
    named = of_class.join(smallest, "label").select(_own_key("set_id"), "component_id")
    out = rows.select("id", "n_shingles", "set_id").join(named, "set_id", "left")
    own = F.when(c("n_shingles") > 0, c("component_id")).otherwise(c("id"))
    return out.select(c("id").alias(id_col), "n_shingles", own.alias("component_id"))
