"""Benchmark decontamination by a distributed positional inverted index (built-ins only).

A posting says that a term stands at a word position of a text.  Postings of
all texts are written once, for the terms that the benchmark uses.  A benchmark
item is aligned with a text by a *diagonal* (text position minus item position),
so the lists of an item's terms are intersected after subtracting their offsets:

1. term counts come from the postings; in every window of an item (``window``
   consecutive words, or the whole of a shorter item) terms are ranked from the
   rarest.  A window with a term that no text has is dropped;
2. the list of each window's rarest term gives diagonals; those at which the
   second rarest term stands at its place too are alignments;
3. around an alignment the lists of all terms of the item are intersected at
   their offsets.  Runs of ``window`` consecutive item words (or the whole of a
   shorter item) are matches: exact phrases, as every word is compared by its
   term.  With ``slop`` over 0, every word but the rarest may stand up to
   ``slop`` places off its offset: a proximity match.

What is moved grows with the postings of rare terms and with the matches, not
with the text.  The benchmark's tables (terms, windows) are broadcast only
behind a check of their size; beyond it the joins are shuffled, and AQE splits
hot terms.  Texts are known by a 128-bit hash, so copies of a text share one
list: every list is made distinct map-side before it meets the other one, and a
text that a third of the rows hold is moved once a task.

Defined results
* ``A-Z`` are lower-cased, words are runs of ASCII letters, digits and anything
  beyond ASCII; null texts and items have no words;
* items without words match nothing; items with equal words are matched once
  and all listed; repeated item ids count once; an item without an id marks the
  words it hits but is in no list;
* every row is judged by its own text, whatever its doc_id; repeated rows alike;
* no benchmark: nothing is hit; no documents: an empty result;
* columns of ``docs`` with the names of new ones are replaced by these.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlake.llm.common import fresh, stored
from wattlake.operators.joins import join_small

WINDOW = 10
#: ASCII characters that are in no word, as a list and as a pattern.
SEPARATORS = "".join(chr(c) for c in range(128) if not chr(c).isalnum())
SEPARATOR_RUN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The pseudo-term that ends every text: its position is the number of words.
END = ""
KEY = ["t1", "t2"]


def _text_key() -> list[Column]:
    text = F.coalesce("text", F.lit(""))
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2")]


def _words(text: Column) -> Column:
    """The words as written; no words, no elements."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(SEPARATORS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SEPARATOR_RUN))


def _lowered(word: Column) -> Column:
    return F.when(F.octet_length(word) == F.length(word), F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))


def items_of(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(item, ids) and (item, ipos, n, word): items of equal words are one; ids sorted as strings."""
    worded = benchmark.select(F.col("item_id").cast("string").alias("id"), F.transform(_words(F.col("text")), _lowered).alias("words"))
    one = worded.where(F.size("words") > 0).groupBy("words").agg(F.collect_set("id").alias("ids"))
    items = stored(one.select(F.monotonically_increasing_id().alias("item"), "ids", "words"), "bench-items")
    return items.select("item", "ids"), items.select("item", F.size("words").alias("n"), F.posexplode("words").alias("ipos", "word"))


def terms_of(words: DataFrame) -> DataFrame:
    """(word, term): a number for each distinct word of the benchmark, and one for the end of texts."""
    end = words.sparkSession.range(1).select(F.lit(END).alias("word"), F.lit(-1).cast("long").alias("term"))
    return stored(words.select("word").distinct().select("word", F.monotonically_increasing_id().alias("term")).union(end), "bench-terms")


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(t1, t2, pos, term): where the terms stand in the texts; the end of each text too."""
    ended = F.concat(_words(F.col("text")), F.array(F.lit(END)))
    tokens = docs.select(*_text_key(), F.posexplode(ended).alias("pos", "word")).withColumn("word", _lowered(F.col("word")))
    return stored(join_small(tokens, terms, "word", "inner").select(*KEY, "pos", "term"), "postings")


def _windows(occurrences: DataFrame, counts: DataFrame, window: int) -> DataFrame:
    """(item, p1, term1, p2, term2): places of the rarest and the second rarest term of each window (null: one word)."""
    first = F.greatest(F.lit(0), F.col("ipos") - window + 1)
    last = F.least(F.col("ipos"), F.greatest(F.lit(0), F.col("n") - window))
    placed = join_small(occurrences, counts, "term").withColumn("start", F.explode(F.sequence(first, last)))
    # at most ``window`` entries in a group
    ranked = placed.groupBy("item", "start").agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce("often", F.lit(0)).alias("often"), F.col("ipos").alias("p"), "term"))).alias("r")
    )
    live = ranked.where(F.col("r")[0]["often"] > 0)
    one, two = F.get("r", F.lit(0)), F.get("r", F.lit(1))
    pairs = live.select("item", one["p"].alias("p1"), one["term"].alias("term1"), two["p"].alias("p2"), two["term"].alias("term2"))
    return stored(pairs.distinct(), "bench-windows")


def _near(place: Column, slop: int) -> Column:
    return place if not slop else F.explode(F.sequence(place - slop, place + slop))


def _listed(index: DataFrame, wanted: DataFrame, on: list[str]) -> DataFrame:
    """The postings with a partner in ``wanted``, each once (copies of a text meet map-side)."""
    return join_small(index, wanted.distinct(), on, "left_semi").select(*KEY, "pos", "term").distinct()


def alignments(index: DataFrame, windows: DataFrame, slop: int = 0) -> DataFrame:
    """(t1, t2, item, diagonal, p1): where both rarest terms of a window stand at their offsets."""
    near = join_small(index, windows.withColumnRenamed("term1", "term"), "term", "inner")
    near = near.select(*KEY, "item", (F.col("pos") - F.col("p1")).alias("diagonal"), "p1", "p2", "term2").distinct()
    seconds = windows.where("term2 IS NOT NULL").select(F.col("term2").alias("term"))
    second = _listed(index, seconds, ["term"])
    both = near.where("term2 IS NOT NULL").withColumnRenamed("term2", "term").withColumn("pos", _near(F.col("diagonal") + F.col("p2"), slop))
    found = both.join(second, [*KEY, "pos", "term"], "left_semi").select(*KEY, "item", "diagonal", "p1")
    alone = near.where("term2 IS NULL").select(*KEY, "item", "diagonal", "p1")
    return stored(found.union(alone).distinct(), "alignments")


def matches(index: DataFrame, occurrences: DataFrame, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """(t1, t2, item, diagonal, first, last, positions): runs of item words ``first`` to ``last`` found in a text.

    ``positions`` are the places in the text; with ``slop`` 0 the run is an exact phrase.
    """
    counts = stored(index.groupBy("term").agg(F.count(F.lit(1)).alias("often")), "term-counts")
    at = alignments(index, _windows(occurrences, counts, window), slop)
    around = F.sequence(F.greatest(F.lit(0), F.col("p1") - window + 1), F.col("p1") + window - 1)
    needed = at.select(*KEY, "item", "diagonal", F.explode(around).alias("ipos")).distinct()
    needed = join_small(needed, occurrences, ["item", "ipos"], "inner")
    needed = needed.withColumn("pos", _near(F.col("diagonal") + F.col("ipos"), slop))
    texts = at.select(*KEY)
    hits = needed.join(_listed(index, texts, KEY), [*KEY, "pos", "term"], "left_semi")
    line = [*KEY, "item", "diagonal"]
    # words of a run differ from their rank by a constant; a group holds the words of one item at most
    rank = F.dense_rank().over(Window.partitionBy(*line).orderBy("ipos"))
    runs = hits.withColumn("island", F.col("ipos") - rank).groupBy(*line, "island").agg(
        F.min("ipos").alias("first"), F.max("ipos").alias("last"), F.max("n").alias("n"), F.collect_set("pos").alias("positions")
    )
    return runs.where(F.col("last") - F.col("first") + 1 >= F.least("n", F.lit(window))).drop("island", "n")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit`` (words inside matches) and ``items`` (ids, sorted as strings, of the items matched)."""
    ids, words = items_of(benchmark)
    terms = terms_of(words)
    index = postings(docs, terms)
    occurrences = stored(join_small(words, terms, "word", "inner").drop("word"), "bench-words")
    found = stored(matches(index, occurrences, window, slop), "matches")
    lengths = index.where("term = -1").groupBy(*KEY).agg(F.max("pos").cast("long").alias("n_words"))
    hit = found.select(*KEY, F.explode("positions").alias("pos")).distinct().groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_hit"))
    listed = join_small(found.select(*KEY, "item").distinct(), ids, "item", "inner")
    listed = listed.groupBy(*KEY).agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("items"))
    per_text = lengths.join(hit, KEY, "left").join(listed, KEY, "left")
    names = fresh(docs, *KEY)
    key = [c.alias(n) for c, n in zip(_text_key(), names)]
    renamed = per_text.select(*[F.col(k).alias(f"{n}_") for k, n in zip(KEY, names)], F.col("n_words").alias("w_"), F.col("n_hit").alias("h_"), F.col("items").alias("i_"))
    kept = [c for c in docs.columns if c.lower() not in ("n_words", "n_hit", "items")]
    rows = docs.select(*kept, *key)
    out = rows.join(renamed, [rows[n] == renamed[f"{n}_"] for n in names], "left")
    none = F.array().cast("array<string>")
    return out.select(
        *[rows[c] for c in kept], F.coalesce("w_", F.lit(0).cast("long")).alias("n_words"),
        F.coalesce("h_", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("i_", none).cast("array<string>").alias("items"),
    )
