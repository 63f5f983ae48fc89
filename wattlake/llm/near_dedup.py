"""Near-duplicate documents by bottom-k sketches.

A document is the set of the 64-bit hashes of its word shingles.  Documents
with equal sets are one class from the start; all work below is on class
representatives.  The *bottom-k sketch* of a set is its ``K`` smallest hashes.
Two sets of the threshold's similarity share at least so many values of the
sketch of their union as ``bounds`` says (10 of 32 at 0.8), but for a chance of
at most ``MISS`` (small sets: for certain, as the sketch is the set); low
thresholds take longer sketches.  Hence:

1. inverted lists: each class is listed under its rarest sketch values only,
   as many as two sketches with so many common values must meet in (prefix
   filter: one order of values, by frequency then value, for all).  A value
   that a passage spreads over a third of the corpus is thus never a list
   unless documents have little else;
2. overlaps: short lists give all their pairs.  A long list gives pairs with
   its most central member only (whose sketch values are the most frequent);
3. estimation: pairs whose sizes or union sketch rule out the similarity go;
4. verification on full sets: first one pair for each class, then what is left
   between different components;
5. long lists whose members still lie in several components are replaced, for
   these members, by lists under the rarest values of their *full* sets.  If a
   value is the first one that two sets share, in an order by frequency, their
   overlap is at most what comes from it on in either set, its *reach*; a pair
   is only looked at where both reaches make the threshold with both sizes
   (exact, no estimate).  A member whose reach suits no size in its list leaves
   it: documents that share a passage, and copies edited just too much, whose
   own rare values come first.  What is left is paired across components only,
   the members outside a list's largest component with the others, as links
   inside a component cannot change it.

Similarity is decided on sets of 64-bit shingle hashes in integers
(100 * common >= threshold * union).

Defined results
* ``A-Z`` are lower-cased, words are runs of other than ASCII white space; a
  text with fewer words than a shingle is one shingle; null or wordless texts
  have the empty set and are linked with nothing;
* every row is judged by its own text; a doc_id that is the smallest of two
  classes (rows with one id and different texts) ties these together;
* a null doc_id is linked with nothing and kept; its component is null;
* an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlake.llm.common import forget, stored, trim
from wattlake.operators.joins import join_small
from wattlake.session import session_conf

K = 32  # at least; see ``bounds``
MISS = 1e-9
SHORT_LIST = 16
WORDS = 5
THRESHOLD = 80  # per cent
RARE = 128  # values of a set that are counted while its lists are paired
VALUES = 100_000  # of a set that become rows at a time
VOCABULARY = 100_000  # word hashes a task remembers at most
BATCH = "4m"  # bytes of texts or sets sent to a Python worker at a time
SLICE = 256  # rows whose texts and sets a task holds as Python objects at a time
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Shingles:
    """Sorted distinct 64-bit hashes of a text's word shingles."""

    def __init__(self, words: int):
        self.words, self.known = words, {}

    def of(self, text: str | None) -> np.ndarray:
        tokens = (text or "").encode("utf-8").lower().split()  # bytes: only A-Z and ASCII white space
        if not tokens:
            return np.zeros(0, np.uint64)
        known, ids = self.known, []
        if len(known) > VOCABULARY:
            known.clear()
        for t in tokens:
            h = known.get(t)
            if h is None:
                h = known[t] = xxhash.xxh64_intdigest(t)
            ids.append(h)
        h = np.array(ids, np.uint64)
        n = max(1, len(h) - self.words + 1)
        out = np.full(n, len(h) if len(h) < self.words else self.words, np.uint64)
        for i in range(min(self.words, len(h))):
            out = self.mix(out ^ h[i : n + i])
        return np.unique(out)

    @staticmethod
    def mix(x: np.ndarray) -> np.ndarray:
        x = (x ^ (x >> np.uint64(32))) * _MIX
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


def slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in pieces of at most SLICE, none empty; their buffers are shared, not copied."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


def bounds(threshold: int) -> tuple[int, int]:
    """(sketch length k, values shared): pairs at ``threshold`` per cent share fewer with a chance of at most MISS.

    The shared values of a union's sketch are drawn without replacement, so
    the binomial tail bounds the chance from above.
    """
    if not 1 <= threshold <= 100:
        raise ValueError(f"threshold must be 1 to 100 per cent, not {threshold}")
    t, k = threshold / 100, K
    while (1 - t) ** k > MISS:
        k += 1
    shared, tail = 0, 0.0
    while shared < k:
        tail += math.comb(k, shared) * t**shared * (1 - t) ** (k - shared)
        if tail > MISS:
            break
        shared += 1
    return k, shared


def sketches(docs: DataFrame, words: int = WORDS, k: int = K, text_key: str | None = None) -> DataFrame:
    """(doc_id, n_shingles, s1, s2, sketch): set size, 128-bit hash of the set, the k smallest hashes.

    With ``text_key``, a 64-bit hash of the text comes along under that name.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        shingles = Shingles(words)
        for batch in slices(batches):
            n_shingles, whole, least = [], [], []
            for text in batch.column("text").to_pylist():
                found = shingles.of(text)
                n_shingles.append(len(found))
                whole.append(np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), np.int64))
                least.append(found[:k].copy())  # a view would hold the whole set
            ends = np.cumsum([0, *map(len, least)], dtype=np.int32)
            sketch = pa.ListArray.from_arrays(ends, np.concatenate(least).view(np.int64))
            s1, s2 = np.array(whole).T.copy()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_shingles, pa.int64()), pa.array(s1), pa.array(s2), sketch, *map(batch.column, keys)], names=["doc_id", "n_shingles", "s1", "s2", "sketch", *keys])
        trim()

    keys = [text_key] if text_key else []
    schema = "doc_id string, n_shingles long, s1 long, s2 long, sketch array<long>" + "".join(f", {c} long" for c in keys)
    kind = docs.schema["doc_id"].dataType
    out = docs.select(F.col("doc_id").cast("string"), "text", *[F.xxhash64("text").alias(c) for c in keys]).mapInArrow(run, schema)
    return out.withColumn("doc_id", F.col("doc_id").cast(kind))


def sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(node, members): the full sets, as 64-bit numbers in order, of the documents in ``wanted``."""
    kind = docs.schema["doc_id"].dataType

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        shingles = Shingles(words)
        for batch in slices(batches):
            members = [shingles.of(t).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(members, pa.binary())], names=["node", "members"])
        trim()

    # ids are small beside texts: up to a checked bound they travel, not the texts
    some = join_small(docs, stored(wanted.select(F.col("node").alias("doc_id")).distinct(), "near-wanted"), "doc_id", "left_semi")
    out = some.select(F.col("doc_id").cast("string"), "text").mapInArrow(run, "node string, members binary")
    return out.withColumn("node", F.col("node").cast(kind))


def _least_shared(n: Column, threshold: int) -> Column:
    """Sketch values that a linked pair shares at least, if one of its sets has ``n``."""
    k, shared = bounds(threshold)
    whole = F.ceil(n * threshold / 100)
    # where partners' sketches are whole sets too, the bound is exact
    return F.when(n <= k * threshold // 100, whole).otherwise(F.lit(shared))


def _prefixes(reps: DataFrame, threshold: int) -> DataFrame:
    """(value, node, n, centrality): each class under its rarest sketch values that others have too."""
    values = reps.select("node", "n", F.explode("sketch").alias("value"))
    often = values.groupBy("value").agg(F.count(F.lit(1)).alias("df"))
    ranked = values.join(often, "value").groupBy("node", "n").agg(
        F.sort_array(F.collect_list(F.struct("df", "value"))).alias("values"), F.sum("df").alias("centrality")
    )
    length = F.greatest(F.lit(1), F.size("values") - _least_shared(F.col("n"), threshold) + 1).cast("int")
    first = F.filter(F.slice("values", 1, length), lambda v: v["df"] > 1)
    return ranked.select("node", "n", "centrality", F.explode(first).alias("v")).select(
        "v.value", F.col("v.df").alias("df"), "node", "n", "centrality"
    )


def _fits(na: str, nb: str, threshold: int) -> Column:
    return (F.least(na, nb) * 100 >= F.greatest(na, nb) * threshold)


def _estimated(pairs: DataFrame, reps: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) that their union sketch does not rule out, with the shared values ``m``."""
    k, shared = bounds(threshold)
    side = lambda x: reps.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").where(_fits("na", "nb", threshold))
    union = F.slice(F.sort_array(F.array_union("sa", "sb")), 1, k)
    both = both.select("a", "b", "na", "nb", F.size(F.array_intersect(F.array_intersect("sa", "sb"), union)).alias("m"))
    return both.where(F.col("m") >= F.least(_least_shared(F.col("na"), threshold), _least_shared(F.col("nb"), threshold), F.lit(shared)))


def _verified(pairs: DataFrame, full: DataFrame, threshold: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""

    @F.pandas_udf("boolean")
    def linked(left: pd.Series, right: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(left, right):
            a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            common = len(np.intersect1d(a, b, assume_unique=True))
            out.append(bool(common) and 100 * common >= threshold * (len(a) + len(b) - common))
        return pd.Series(out, dtype=bool)

    side = lambda x: full.select(F.col("node").alias(x), F.col("members").alias(f"m{x}"))
    both = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    return both.where(linked("ma", "mb")).select("a", "b")


def _links(pairs: DataFrame) -> DataFrame:
    """The verified pairs, stored: few rows from the many tasks that compare sets, so they are dealt to few files."""
    return stored(pairs.hint("rebalance"), "near-links")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of ``edges`` (a, b).

    Large-star and small-star steps in turn: each node's larger neighbours,
    then its smaller ones, are tied to the smallest node it knows, until
    nothing changes.
    """
    edges = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "near-edges")
    seen = None
    while True:
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select(F.col("u").alias("x"), F.least("u", "low").alias("low"))
        large = both.where("v > u").join(low, F.col("u") == F.col("x")).select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("low")).select(F.col("u").alias("x"), "low")
        small = large.join(least, F.col("u") == F.col("x"))
        small = small.select(F.col("v").alias("u"), F.col("low").alias("v")).union(small.select("u", F.col("low").alias("v")))
        edges = stored(small.where("u <> v").distinct(), "near-edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now


def _ordered(docs: DataFrame, members: DataFrame, words: int) -> DataFrame:
    """(node, text, n, value, df, rank): the full sets of ``members``, each in the order by frequency among them.

    Several texts with one doc_id are sets of their own.
    """

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for node, text, members in zip(batch["node"], batch["text"], batch["members"]):
                values = np.frombuffer(members, np.int64)
                for at in range(0, len(values), VALUES):
                    yield pd.DataFrame({"node": node, "text": text, "n": len(values), "value": values[at : at + VALUES]})

    kind = docs.schema["doc_id"].dataType
    full = sets(docs, members, words).select(F.col("node").cast("string"), F.xxhash64("members").alias("text"), "members")
    values = full.dropDuplicates(["node", "text"]).mapInPandas(run, "node string, text long, n long, value long")
    values = stored(values, "near-values")
    often = values.groupBy("value").agg(F.count(F.lit(1)).alias("df"))
    rank = F.row_number().over(Window.partitionBy("node", "text").orderBy("df", "value"))
    return values.join(often, "value").withColumn("rank", rank).withColumn("node", F.col("node").cast(kind))


def _still_open(docs: DataFrame, members: DataFrame, words: int, threshold: int) -> DataFrame:
    """Pairs (a, b) across components among ``members`` (node, root) that their full sets' rarest values allow."""

    def linkable(overlap: Column, one: Column, other: Column) -> Column:
        # overlap >= threshold * union, with the union as both sizes less the overlap
        return overlap * (100 + threshold) >= (one + other) * threshold

    prefix = F.col("n") - F.ceil(F.col("n") * threshold / 100) + 1  # a partner shares one of so many
    placed = _ordered(docs, members.select("node"), words).where(F.col("rank") <= F.greatest(prefix, F.lit(RARE)))
    placed = stored(placed, "near-placed")
    rare = placed.where(F.col("rank") <= RARE).groupBy("node", "text").agg(F.collect_list("value").alias("rare"))
    at = placed.where((F.col("rank") <= prefix) & (F.col("df") > 1)).withColumn("reach", F.col("n") - F.col("rank") + 1)
    at = stored(at.join(members, "node").select("value", "node", "text", "n", "reach", "root"), "near-places")
    least = at.groupBy("value").agg(F.min("n").alias("least"))
    at = at.join(least, "value").where(linkable(F.col("reach"), F.col("n"), F.col("least"))).drop("least")
    parts = at.groupBy("value", "root").agg(F.count(F.lit(1)).alias("size")).groupBy("value")
    parts = parts.agg(F.max(F.struct("size", "root"))["root"].alias("largest"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    at = stored(at.join(parts.select("value", "largest"), "value").join(rare, ["node", "text"]), "near-parted")
    side = lambda x: [F.col(c).alias(f"{c}_{x}") for c in ("node", "n", "root", "reach", "rare")]
    left = at.select("value", "largest", *side("a"))
    right = at.where("root <> largest").select("value", *side("b"))
    once = (F.col("root_a") == F.col("largest")) | (F.col("node_a") < F.col("node_b"))
    unseen = F.greatest(F.col("n_a") - F.size("rare_a"), F.col("n_b") - F.size("rare_b"))
    allowed = (
        (F.col("root_a") != F.col("root_b")) & once & _fits("n_a", "n_b", threshold)
        & linkable(F.least("reach_a", "reach_b"), F.col("n_a"), F.col("n_b"))
        & linkable(F.size(F.array_intersect("rare_a", "rare_b")) + unseen, F.col("n_a"), F.col("n_b"))
    )
    both = left.join(right, (left["value"] == right["value"]) & allowed)
    return both.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def _across(pairs: DataFrame, roots: DataFrame, *more: str) -> DataFrame:
    """Pairs whose ends lie in different components."""
    for x in ("a", "b"):
        side = roots.select(F.col("node").alias(x), F.col("root").alias(f"r{x}"))
        pairs = pairs.join(side, x, "left").withColumn(f"r{x}", F.coalesce(f"r{x}", x))
    return pairs.where("ra <> rb").select("a", "b", *more)


def near_duplicates(docs: DataFrame, words: int = WORDS, threshold: int = THRESHOLD, text_key: str | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs``; with ``text_key``, also a hash of its text."""
    with session_conf(docs.sparkSession, {"spark.sql.execution.arrow.maxBytesPerBatch": BATCH}):
        return _near_duplicates(docs, words, threshold, text_key)


def _near_duplicates(docs: DataFrame, words: int, threshold: int, text_key: str | None) -> DataFrame:
    rows = stored(sketches(docs, words, bounds(threshold)[0], text_key), "near-sketches")
    named = rows.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = stored(named.groupBy("s1", "s2").agg(F.min("doc_id").alias("node")), "near-classes")
    rep = named.join(classes.select("node", F.col("s1").alias("t1"), F.col("s2").alias("t2")), (F.col("doc_id") == F.col("node")) & (F.col("s1") == F.col("t1")) & (F.col("s2") == F.col("t2")))
    reps = stored(rep.select("node", F.col("n_shingles").alias("n"), "sketch").dropDuplicates(["node", "sketch"]), "near-reps")
    lists = stored(_prefixes(reps, threshold), "near-lists")
    sizes = lists.groupBy("value").agg(
        F.count(F.lit(1)).alias("size"), F.max(F.struct("centrality", "n", "node")).alias("centre")
    ).where("size > 1")
    sizes = stored(sizes, "near-list-sizes")
    # short lists: all pairs; long ones: pairs with the centre
    short = lists.join(sizes.where(F.col("size") <= SHORT_LIST).select("value"), "value")
    other = short.select("value", F.col("node").alias("b"), F.col("n").alias("nb"))
    pairs = short.select("value", F.col("node").alias("a"), F.col("n").alias("na")).join(other, "value")
    pairs = pairs.where((F.col("a") < F.col("b")) & _fits("na", "nb", threshold)).select("a", "b")
    centre = sizes.where(F.col("size") > SHORT_LIST).select("value", F.col("centre.node").alias("c"), F.col("centre.n").alias("nc"))
    star = lists.join(centre, "value").where((F.col("node") != F.col("c")) & _fits("n", "nc", threshold))
    pairs = pairs.union(star.select(F.least("node", "c"), F.greatest("node", "c"))).distinct()
    found = stored(_estimated(pairs, reps, threshold), "near-pairs")
    wanted = found.select(F.col("a").alias("node")).union(found.select("b")).distinct()
    full = stored(sets(docs, wanted, words), "near-sets")
    # one pair for each document first: what is likeliest to be linked
    best = found.groupBy("b").agg(F.max(F.struct(F.col("m") / F.greatest("na", "nb"), "m", "a")).alias("p")).select(F.col("p.a").alias("a"), "b")
    edges = _links(_verified(best, full, threshold))
    roots = components(edges)
    rest = stored(_across(found, roots), "near-rest")
    edges = _links(edges.union(_verified(rest, full, threshold)))
    roots = components(edges)
    # long lists that still lie in several components
    at = lists.join(centre.select("value"), "value").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_ = at.groupBy("value").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("value")
    at = stored(at.join(open_, "value", "left_semi").select("node", "root").distinct(), "near-open")
    cross = _still_open(docs, at, words, threshold).join(found.select("a", "b"), ["a", "b"], "left_anti")
    more = stored(_estimated(cross, reps, threshold), "near-more")
    if not more.isEmpty():
        wanted = more.select(F.col("a").alias("node")).union(more.select("b")).distinct()
        edges = _links(edges.union(_verified(more, stored(sets(docs, wanted, words), "near-sets"), threshold)))
        roots = components(edges)
    # documents -> class -> component
    of_class = classes.join(roots, "node", "left").select(F.col("s1").alias("t1"), F.col("s2").alias("t2"), F.coalesce("root", "node").alias("root"))
    out = rows.join(of_class, (F.col("s1") == F.col("t1")) & (F.col("s2") == F.col("t2")) & (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), "left")
    component = F.coalesce("root", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"), *([text_key] if text_key else []))
