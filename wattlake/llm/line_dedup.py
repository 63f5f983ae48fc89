"""Line dedup: repeated line runs by distributed prefix doubling (built-ins only).

The corpus is a sequence of line ids, document after document; blank lines
are not part of it.  A *run* is a stretch of consecutive lines of one document
with at least ``min_words`` words.  A run that occurs at an earlier place (in
the order doc_id, then hash of the text, then line) is a later copy, and all
its lines are deleted; so the first copy of everything stays.

Suffixes are ranked by their first 1, 2, 4, ... lines: the rank for 2h lines
comes from sorting the pairs (rank at i, rank at i + h), as in prefix doubling
for suffix arrays; suffixes of equal rank form an interval whose longest common
prefix is at least 2h lines.  Pairs that occur once leave the race, so later
rounds only carry repeated text.  The lines of all later copies of at least
``min_words`` words are the union of the later copies among the *shortest* such
runs from each line forwards and from each line backwards (at most
``min_words`` lines, as every line has a word); each is named by two ranks of
overlapping power-of-two prefixes, so ``log2(min_words)`` rounds settle all.

Line ids are 64-bit hashes.  Two different runs are taken for one only if
hashes of lines collide inside a repeated run of ``min_words`` words.

Defined results
* null text: no lines, stays null; empty or blank text stays as it is;
* rows equal in doc_id and text are one document and are cleaned alike; equal
  doc_id with different texts are different documents;
* null doc_id: a document like any other, after all others in order;
* blank lines inside a deleted run go with it, all other blank lines stay;
* an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlake.llm.common import fresh, stored, word_count

MIN_WORDS = 50


def _text_key(text: Column) -> Column:
    return F.xxhash64(text)


def _lines(docs: DataFrame) -> DataFrame:
    """(doc, th, idx, pos, id, wc): the lines with a word, numbered in their document."""
    lines = F.transform(
        F.split("text", "\n"),
        lambda line, i: F.struct(i.alias("pos"), F.xxhash64(line).alias("id"), word_count(line).alias("wc")),
    )
    return docs.where(F.col("text").isNotNull()).select(
        F.col("doc_id").alias("doc"),
        _text_key(F.col("text")).alias("th"),
        F.posexplode(F.filter(lines, lambda x: x["wc"] > 0)).alias("idx", "line"),
    ).select("doc", "th", "idx", "line.*")


def _repeated_lines(lines: DataFrame, min_words: int) -> DataFrame:
    """Lines that occur twice or more, with the lengths of the shortest runs from each.

    ``ahead`` / ``back``: lines of the shortest run of ``min_words`` words that
    starts / ends here, null where the stretch of repeated lines is too short.
    """
    twice = lines.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id")
    lines = lines.join(twice, "id", "left_semi")
    in_doc = Window.partitionBy("doc", "th").orderBy("idx")
    lines = lines.withColumn("prev", F.lag("idx").over(in_doc)).where(F.col("prev").isNull() | (F.col("prev") < F.col("idx")))
    lines = lines.withColumn("stretch", F.col("idx") - F.row_number().over(in_doc))
    one = Window.partitionBy("doc", "th", "stretch")
    lines = lines.withColumn("upto", F.sum("wc").over(one.orderBy("idx"))).withColumn("before", F.col("upto") - F.col("wc"))
    on = one.orderBy("before").rangeBetween(0, min_words - 1)
    off = one.orderBy("upto").rangeBetween(-(min_words - 1), 0)
    ahead = F.when(F.max("upto").over(on) - F.col("before") >= min_words, F.count(F.lit(1)).over(on))
    back = F.when(F.col("upto") - F.min("before").over(off) >= min_words, F.count(F.lit(1)).over(off))
    return lines.select("doc", "th", "idx", "pos", F.col("id").alias("r"), ahead.cast("int").alias("ahead"), back.cast("int").alias("back"))


def _double(ranks: DataFrame, width: int) -> DataFrame:
    """Ranks by the first ``2 * width`` lines, for the suffixes whose prefix is repeated."""
    there = Window.partitionBy("doc", "th").orderBy("idx").rangeBetween(width, width)
    pairs = ranks.withColumn("r2", F.first("r").over(there)).where("r2 IS NOT NULL")
    twice = pairs.groupBy("r", "r2").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # ids that rise with (r, r2) and need no single task; kept, as they depend on how rows were dealt
    order = stored(twice.sort("r", "r2").select("r", "r2", F.monotonically_increasing_id().alias("rank")), f"lines-rank{2 * width}")
    return pairs.join(order, ["r", "r2"]).select("doc", "th", "idx", F.col("rank").alias("r"))


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, th, first, last, n_lines): maximal stretches of later copies, in line positions."""
    lines = stored(_lines(docs), "lines")
    base = stored(_repeated_lines(lines, min_words), "lines-repeated")
    runs = base.select("doc", "th", F.col("idx").alias("start"), F.col("ahead").alias("len")).union(
        base.select("doc", "th", F.col("idx") - F.col("back") + 1, "back")
    ).where("len IS NOT NULL").distinct()
    runs = stored(runs.withColumn("k", F.floor(F.log2("len")).cast("int")), "lines-runs")
    most = runs.agg(F.max("k")).first()[0]
    ranks, later = base.select("doc", "th", "idx", "r"), None
    for k in range(0, -1 if most is None else most + 1):
        if k:
            ranks = stored(_double(ranks, 1 << (k - 1)), f"lines-suffixes{1 << k}")
        named = _named(runs.where(F.col("k") == k), ranks, 1 << k)
        # stored round by round: one plan of all rounds' joins takes the driver hundreds of MB
        found = stored(_later_copies(named), f"lines-later{1 << k}")
        later = found if later is None else later.union(found)
    if later is None:
        later = runs.select("doc", "th", "start", "len")
    lines_out = later.select("doc", "th", F.explode(F.sequence("start", F.col("start") + F.col("len") - 1)).alias("idx")).distinct()
    same = _same(base, lines_out) & (base["idx"] == lines_out["idx"])
    gone = base.join(lines_out, same, "left_semi").select("doc", "th", "idx", "pos")
    island = F.col("idx") - F.row_number().over(Window.partitionBy("doc", "th").orderBy("idx"))
    return gone.withColumn("island", island).groupBy("doc", "th", "island").agg(
        F.min("pos").alias("first"), F.max("pos").alias("last"), F.count(F.lit(1)).alias("n_lines")
    ).drop("island")


def _same(a: DataFrame, b: DataFrame) -> Column:
    return a["doc"].eqNullSafe(b["doc"]) & (a["th"] == b["th"])


def _named(runs: DataFrame, ranks: DataFrame, width: int) -> DataFrame:
    """Runs with their name: the ranks of the first and the last ``width`` lines, and the length."""
    for name, at in (("a", F.col("start")), ("b", F.col("start") + F.col("len") - width)):
        side = ranks.select(F.col("doc").alias("d_"), F.col("th").alias("t_"), F.col("idx").alias("i_"), F.col("r").alias(name))
        runs = runs.join(side, F.col("doc").eqNullSafe(F.col("d_")) & (F.col("th") == F.col("t_")) & (at == F.col("i_"))).drop("d_", "t_", "i_")
    return runs


def _later_copies(named: DataFrame) -> DataFrame:
    place = F.struct(F.col("doc").isNull().alias("no_id"), "doc", "th", "start")
    firsts = named.groupBy("a", "b", "len").agg(F.min(place).alias("at"), F.count(F.lit(1)).alias("n")).where("n > 1")
    both = named.join(firsts, ["a", "b", "len"])
    return both.where(place > F.col("at")).select("doc", "th", "start", "len")


def line_dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with later copies of repeated line runs cut out of ``text``.

    Adds ``n_lines`` (lines of the whole text) and ``n_deleted_lines`` (blank
    lines inside deleted runs not counted); where ``docs`` has columns of
    these names, theirs are replaced.
    """
    runs = repeated_runs(docs, min_words)
    d_, t_, cuts, lines = fresh(docs, "cut_doc", "cut_text", "cuts", "cut_lines")
    per_doc = runs.groupBy(F.col("doc").alias(d_), F.col("th").alias(t_)).agg(
        F.sort_array(F.collect_list(F.struct("first", "last", "n_lines"))).alias(cuts)
    )
    same = docs["doc_id"].eqNullSafe(per_doc[d_]) & (_text_key(docs["text"]) == per_doc[t_])
    out = docs.drop("n_lines", "n_deleted_lines").join(per_doc, same, "left")
    split = F.split("text", "\n")
    begin = F.col(cuts)
    # what stays lies before each cut (after the one before it) and after the last
    before = F.transform(
        begin,
        lambda cut, i: F.struct(
            F.when(i == 0, F.lit(0)).otherwise(F.get(begin, i - 1)["last"] + 1).alias("from"), cut["first"].alias("to")
        ),
    )
    tail = F.struct((F.element_at(begin, -1)["last"] + 1).alias("from"), F.size(split).alias("to"))
    kept = F.transform(
        F.array(split),
        lambda all_: F.array_join(
            F.flatten(F.transform(F.concat(before, F.array(tail)), lambda s: F.slice(all_, s["from"] + 1, s["to"] - s["from"]))), "\n"
        ),
    )[0]
    n_cut = F.aggregate(begin, F.lit(0).cast("long"), lambda n, cut: n + cut["n_lines"])
    out = out.withColumns(
        {
            "n_lines": F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(split)).cast("long"),
            "n_deleted_lines": F.coalesce(n_cut, F.lit(0)).cast("long"),
            "text": F.when(begin.isNull(), F.col("text")).otherwise(kept),
        }
    )
    return out.select(*[c for c in docs.columns if c not in ("n_lines", "n_deleted_lines")], "n_lines", "n_deleted_lines")
