"""Mixing sources to target weights by hash-threshold histograms (built-ins only).

Each source gets a word budget (its target).  Whole copies of a source are
taken by integer division; what remains of the budget is filled by the
documents whose hash lies under a threshold.  The threshold is found without
sorting documents: words are summed by (source, hash bucket), a running sum
over the buckets finds the one in which the budget ends, and only that bucket
is divided again by the next bits of the hash, until the hash is used up or no
boundary bucket has documents.  A document is then taken or not by one
comparison.

Defined results
* null or wordless text: size 0, never taken; null ``source`` is a source of
  its own, last in order; the hash is of id and text, so rows without an id, or
  with one id and different texts, are taken one by one;
* rows equal in id and text stand or fall together (one threshold);
* an empty table gives an empty result; other columns pass through.

Per-source tables have one row for each source (or bucket of a source) and
are the only thing that is ever sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlake.llm.common import stored, word_count

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
LEVEL_BITS = 12
LEVELS = 5  # 5 x 12 = 60 bits of the hash
EPSILON = 1e-6  # words; targets are doubles, budgets whole words


def hash60(doc_id: Column, text: Column) -> Column:
    """60 bits of md5 of the id, a line break and the text, as a non-negative long."""
    both = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("\n"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(both), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, target) from one row per source (source, source_size).

    Weights repeat over the sources by code point, null last.  Targets share
    the total by weight, each at most ``repeats`` times its source.  Sources
    are filled in the order of cap over weight: once a source is under its
    cap at the level of what is left, so are all after it.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    ranked = sizes.withColumn("w", w).withColumn("cap", (F.lit(repeats) * F.col("source_size")).cast("double"))
    fill = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), F.col("source"))
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    level = (F.sum(F.col("source_size")).over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(after)
    ranked = ranked.withColumn("level", level).withColumn("at", F.row_number().over(fill))
    # the level at the first source under its cap holds for all that follow
    first = F.min(F.when(F.col("cap") > F.col("level") * F.col("w"), F.struct("at", "level"))).over(whole)
    ranked = ranked.withColumn("final", first["level"])
    target = F.least(F.col("cap"), F.coalesce(F.col("final") * F.col("w"), F.col("cap")))
    return ranked.select("source", "source_size", target.alias("target"))


def _bucket(level: int) -> Column:
    shift = LEVEL_BITS * (LEVELS - 1 - level)
    return F.shiftright(F.col("h"), shift)


def thresholds(narrow: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, copies, below): take ``copies`` of all, one more where ``h`` < ``below``.

    ``narrow`` has (source, h, size); ``targets`` one row per source.  The
    budget left after whole copies is a whole number of words; documents are
    taken in the order of their hash for as long as the sum fits.
    """
    size, target = F.col("source_size"), F.col("target")
    copies = F.when(size > 0, F.floor(target / size + EPSILON)).otherwise(0).cast("long")
    rest = F.floor(target - copies * size + EPSILON).cast("long")
    state = targets.select("source", copies.alias("copies"), rest.alias("rest"), F.lit(0).cast("long").alias("prefix"))
    live = narrow.where("size > 0")
    for level in range(LEVELS):
        if level:  # only the documents of the boundary buckets go on
            keys = state.select(F.col("source").alias("s_"), F.col("prefix").alias("p_"))
            same = F.col("source").eqNullSafe(F.col("s_")) & (_bucket(level - 1) == F.col("p_"))
            live = live.join(keys, same, "left_semi")
        sums = live.groupBy("source", _bucket(level).alias("b")).agg(
            F.sum("size").alias("words"), F.min("h").alias("lo"), (F.min("h") < F.max("h")).alias("many")
        )
        run = Window.partitionBy("source").orderBy("b")
        sums = sums.select(F.col("source").alias("s_"), "b", "lo", "many", "words", F.sum("words").over(run).alias("upto"))
        joined = state.select("source", "copies", "rest", "prefix").join(sums, F.col("source").eqNullSafe(F.col("s_")), "left")
        over = F.col("upto") > F.col("rest")
        found = joined.groupBy("source", "copies", "rest", "prefix").agg(
            F.min(F.when(over, F.struct("b", "lo", "many", "words"))).alias("edge"),
            F.coalesce(F.max(F.when(~over, F.col("upto"))), F.lit(0)).alias("spent"),
        )
        # Without a boundary at the top all documents fit.  Below it there is
        # always one, unless no document lies in the bucket: then it stays shut.
        none = F.lit(1 << LEVEL_BITS).cast("long") if level == 0 else F.shiftleft(F.col("prefix"), LEVEL_BITS)
        left = F.col("rest") - F.col("spent")
        last = F.col("edge.lo") + (2 * left >= F.col("edge.words")).cast("long")
        state = stored(
            found.select(
                "source",
                "copies",
                left.alias("rest"),
                F.coalesce(F.col("edge.b"), none).cast("long").alias("prefix"),
                F.coalesce(F.col("edge.many"), F.lit(False)).alias("many"),
                F.coalesce(last, F.shiftleft(none, LEVEL_BITS * (LEVELS - 1 - level))).alias("below"),
            ),
            f"mix-level{level}",
        )
        if state.where("many").isEmpty():
            break
    return state.select("source", "copies", "below")


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = MAX_REPEATS) -> tuple[DataFrame, DataFrame]:
    """What ``docs`` amounts to and what to take of it.

    The rows (doc_id, source, size, h), and per source (s_, source_size,
    target, whole, below): ``whole`` copies of each document that has words,
    and one more of those with ``h`` < ``below``.
    """
    narrow = stored(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), hash60(F.col("doc_id"), F.col("text")).alias("h")), "mix-docs"
    )
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = stored(source_targets(sizes, weights, repeats), "mix-targets")
    cut = thresholds(narrow, targets).select(F.col("source").alias("c_"), F.col("copies").alias("whole"), "below")
    per_source = targets.join(cut, F.col("source").eqNullSafe(F.col("c_")))
    return narrow, stored(per_source.select(F.col("source").alias("s_"), "source_size", "target", "whole", "below"), "mix-plan")


def _copies(size: Column, h: Column) -> Column:
    return F.when(size > 0, F.col("whole") + (h < F.col("below")).cast("long")).otherwise(0).cast("long")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = MAX_REPEATS) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) of every row of ``docs``."""
    narrow, per_source = plan(docs, weights, repeats)
    out = narrow.join(per_source, F.col("source").eqNullSafe(F.col("s_")))
    return out.select("doc_id", "source", "size", "source_size", "target", _copies(F.col("size"), F.col("h")).alias("copies"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = MAX_REPEATS) -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it takes it."""
    _, per_source = plan(docs, weights, repeats)
    own = [f"own{i}" for i in range(len(docs.columns))]  # the plan's names cannot clash with these
    rows = docs.toDF(*own)
    at = {c.lower(): o for c, o in zip(docs.columns, own)}
    rows = rows.join(per_source, F.col(at["source"]).eqNullSafe(F.col("s_")))
    copies = _copies(word_count(F.col(at["text"])), hash60(F.col(at["doc_id"]), F.col(at["text"])))
    rows = rows.withColumn("copies", copies).where("copies > 0")
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return rows.select(*own).toDF(*docs.columns)
