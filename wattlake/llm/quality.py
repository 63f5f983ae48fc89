"""Quality rules: base rules, then a hashed n-gram log-likelihood ratio (built-ins only).

Every document is a bag of hashed n-grams (tokens and pairs of tokens, where a
token is a run of letters, digits and underscores or a run of other signs).
Two smoothed multinomials over ``2 ** BUCKET_BITS`` buckets are estimated: one of the trusted target
and one of the whole raw corpus.  A document's score is its log-likelihood
ratio divided by its number of n-grams; every document at or above
``MIN_SCORE`` is kept, whatever else is in the corpus.

The trusted target is a bounded sample: of the documents labelled good
(``quality`` 1), the ``TRUSTED_DOCS`` with the smallest id hashes; their ids
(at most 16 bytes each) are what is broadcast.  The raw counts cover all words
of all documents; the table of weights that is broadcast has one row a bucket.

Defined results
* null text or text without a word: all counts 0, base_failed, score 0;
* no trusted document: all scores are 0 and the base rules decide;
* null doc_id is never trusted; repeated rows count as often as they occur and
  get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.llm.common import SPACES, stored

BUCKET_BITS = 16
TRUSTED_DOCS = 20_000
MIN_SCORE = -0.25
MIN_WORDS = 20
MAX_REPEATED = 30  # per cent of the words
WINDOW = 8
SPACE_RUN = r"[\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
TOKEN = r"\w+|[^\w\s]+"


def _words(text: Column) -> Column:
    inner = F.btrim(text, F.lit(SPACES))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACE_RUN))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside windows of ``window`` (a power of two) words that the text has twice or more."""

    half = window // 2  # windows are hashed by doubling: 2, 4, ... words

    def double(h: Column, width: int) -> Column:
        return F.transform(F.slice(h, 1, F.greatest(F.size(h) - width, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(h, i + width)))

    def of_grams(width: int):
        def grow(g: Column) -> Column:
            return of_halves(g) if width == half else _let(double(g, width), of_grams(2 * width))

        return grow

    def of_halves(g: Column) -> Column:
        # no half window twice: no window twice
        none = F.size(F.array_distinct(g)) == F.size(g)
        return F.when(none, F.lit(0).cast("long")).otherwise(_let(double(g, half), of_windows))

    def of_windows(w: Column) -> Column:
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(
            _let(F.array_sort(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), covered)
        )

    def covered(s: Column) -> Column:
        again = F.filter(
            s,
            lambda x, i: F.get(s, i + 1)["h"].eqNullSafe(x["h"]) | F.get(s, i - 1)["h"].eqNullSafe(x["h"]),
        )
        return _let(F.array_sort(F.transform(again, lambda x: x["i"])), union_length)

    def union_length(starts: Column) -> Column:
        steps = F.transform(starts, lambda x, i: F.least(F.coalesce(F.get(starts, i + 1) - x, F.lit(window)), F.lit(window)))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)

    return _let(F.transform(words, lambda w: F.xxhash64(w)), of_grams(1))


def base_columns(text: Column) -> dict[str, Column]:
    """n_symbols, n_dup_lines and, in ``of_words``, n_words, word_chars and n_repeat_words of ``text``, as longs."""
    text = F.coalesce(text, F.lit(""))
    # translate() looks every character up in a map, so words are joined, symbols matched and lines trimmed instead
    of_words = _let(_words(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"), repeated_words(w).alias("n_repeat_words")
    ))
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    return {
        "of_words": of_words,
        "n_symbols": F.regexp_count(text, F.lit(SYMBOL)).cast("long"),
        "n_dup_lines": _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
    }


def _buckets(text: Column, bits: int) -> Column:
    """The buckets of all tokens and token pairs of ``text``."""
    tokens = F.transform(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)), lambda t: F.xxhash64(t))

    def bucket(h: Column) -> Column:
        return F.shiftrightunsigned(h, 64 - bits).cast("int")

    def both(h: Column) -> Column:
        # the first token has nothing before it: a null, which the hash passes over
        return F.concat(F.transform(h, bucket), F.transform(h, lambda x, i: bucket(F.xxhash64(F.get(h, i - 1), x, F.lit(2)))))

    return _let(tokens, both)


def weights(docs: DataFrame, trusted: DataFrame, bits: int = BUCKET_BITS) -> DataFrame:
    """(bucket, weight): log ratio of the trusted and the raw probability of every bucket seen.

    ``trusted`` (doc_id) must be bounded: it is broadcast.
    """
    mark = trusted.select(F.col("doc_id").alias("trusted_id")).distinct()
    marked = docs.select("doc_id", "text").join(F.broadcast(mark), F.col("doc_id") == F.col("trusted_id"), "left")
    grams = marked.select(F.col("trusted_id").isNotNull().cast("long").alias("good"), F.explode(_buckets(F.col("text"), bits)).alias("bucket"))
    counts = stored(grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.sum("good").alias("good")), "quality-counts")
    total = counts.agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")).first()
    raw, good, size = float(total["raw"] or 0), float(total["good"] or 0), float(1 << bits)
    # the target is smoothed with the raw corpus, so that what it has not seen counts a little against
    p_raw = (F.col("raw") + 1) / (raw + size)
    p_good = (F.col("good") + size * p_raw) / (good + size)
    weight = F.log(p_good / p_raw) if good else F.lit(0.0)
    return counts.select("bucket", weight.alias("weight"))


def weight_array(table: DataFrame, bits: int = BUCKET_BITS) -> Column:
    """The weights of all ``2 ** bits`` buckets in order, as one value; 0 for buckets not seen."""
    every = table.sparkSession.range(1 << bits).select(F.col("id").cast("int").alias("bucket"))
    dense = every.join(table, "bucket", "left").select("bucket", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    pairs = F.sort_array(F.collect_list(F.struct("bucket", "weight")))
    return dense.agg(F.transform(pairs, lambda x: x["weight"]).alias("weights")).scalar()


def trusted_sample(labels: DataFrame, most: int = TRUSTED_DOCS) -> DataFrame:
    """At most ``most`` ids of documents labelled good, spread by hash."""
    good = labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def judge(docs: DataFrame, labels: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """One row per row of ``docs``: doc_id, the base counts, base_failed, score and kept."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    table = stored(weights(docs, trusted_sample(labels)), "quality-weights")

    def mean(buckets: Column) -> Column:
        total = F.aggregate(buckets, F.lit(0.0), lambda sum_, b: sum_ + F.get("weights", b))
        return F.when(F.size(buckets) > 0, total / F.size(buckets)).otherwise(0.0)

    score = F.coalesce(_let(_buckets(F.col("text"), BUCKET_BITS), mean), F.lit(0.0))
    out = docs.select("doc_id", "text", weight_array(table).alias("weights")).withColumns(base_columns(F.col("text")) | {"score": score}).drop("text", "weights")
    out = out.select("doc_id", "of_words.*", "n_symbols", "n_dup_lines", "score")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    out = out.withColumn("base_failed", failed)
    return out.select("doc_id", *names, "base_failed", "score", (~F.col("base_failed") & (F.col("score") >= min_score)).alias("kept"))
