import math
import re
import struct
from collections import Counter, defaultdict

import xxhash

from tests.llm import cases
from wattlake.llm import quality


def repeated(words, window=8):
    at = defaultdict(list)
    for i in range(len(words) - window + 1):
        at[tuple(words[i : i + window])].append(i)
    return len({k for v in at.values() if len(v) > 1 for i in v for k in range(i, i + window)})


def test_base_rules_and_verdicts(spark):
    made = cases.rows()
    good = [(i, 1) for i in range(10)] + [(None, 1)]
    labels = spark.createDataFrame(good + [(11, 0)], "doc_id long, quality int")
    got = quality.judge(cases.table(spark, made), labels).collect()
    assert len(got) == len(made)
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    for doc_id, text, *_ in made:
        if doc_id is None:
            continue
        text = text or ""
        words = re.findall("[^\x20\x09-\x0d]+", text)
        lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
        r = by_id[doc_id]
        assert (r.n_words, r.word_chars) == (len(words), sum(map(len, words)))
        assert r.n_symbols == sum(text.count(c) for c in "#*$%&|<>")
        assert (r.n_dup_lines, r.n_repeat_words) == (len(lines) - len(set(lines)), repeated(words))
        assert r.base_failed == (len(words) < 20 or 100 * repeated(words) > 30 * len(words))
        assert r.kept == (not r.base_failed and r.score >= quality.MIN_SCORE)


def test_no_trusted_document_and_empty_table(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = quality.judge(cases.table(spark), labels).collect()
    assert all(r.score == 0 and r.kept == (not r.base_failed) for r in got)
    assert quality.judge(cases.table(spark, []), labels).collect() == []


def test_labelled_junk_goes_and_good_text_stays(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    verdicts = quality.judge(spark.read.parquet(f"{sf}/documents.parquet"), labels)
    got = verdicts.where("NOT base_failed").join(labels, "doc_id").collect()
    good, bad = ([r.kept for r in got if r.quality == q] for q in (1, 0))
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.2 * len(bad)


def gram_buckets(text):
    """Buckets of a text's tokens and token pairs, from Spark's hash by another library."""
    tokens = [xxhash.xxh64_intdigest(t.encode(), 42) for t in re.findall(r"\w+|[^\w\s]+", text or "", re.ASCII)]
    out = list(tokens)
    for i, t in enumerate(tokens):
        h = 42
        for number, size in [*[(tokens[i - 1], "Q")] * (i > 0), (t, "Q"), (2, "I")]:
            h = xxhash.xxh64_intdigest(struct.pack("<" + size, number), h)
        out.append(h)
    return [h >> 48 for h in out]


def test_score_equals_brute_force(spark):
    made = cases.rows(21)
    trusted = {i for i in range(12)}
    labels = spark.createDataFrame([(i, 1) for i in trusted] + [(20, 0), (None, 1)], "doc_id long, quality int")
    grams = [(r[0], gram_buckets(r[1])) for r in made]
    raw, good = Counter(), Counter()
    for doc_id, found in grams:
        raw.update(found)
        if doc_id in trusted:
            good.update(found)
    size, n_raw, n_good = 2**16, sum(raw.values()), sum(good.values())

    def weight(b):
        p = (raw[b] + 1) / (n_raw + size)
        return math.log((good[b] + size * p) / (n_good + size) / p)

    got = Counter((r.doc_id, round(r.score, 9)) for r in quality.judge(cases.table(spark, made), labels).collect())
    assert got == Counter((i, round(sum(map(weight, found)) / len(found) if found else 0.0, 9)) for i, found in grams)
    assert len({score for _, score in got}) > 30


def test_counts_of_odd_characters_without_a_look_up_for_each(spark):
    texts = ["# \x0b $\U0001f600 <a>\n\x0b\f\r\n \n \n", " \n\t\n", "", None, "&|%*\r\n&|%*\r", "\U0001f600" * 3]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    verdicts = quality.judge(docs, spark.createDataFrame([], "doc_id long, quality int"))
    got = {r.doc_id: r for r in verdicts.collect()}
    for i, text in enumerate(texts):
        words = re.findall("[^\x20\x09-\x0d]+", text or "")
        lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
        want = (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)))
        assert (got[i].n_words, got[i].word_chars, got[i].n_symbols, got[i].n_dup_lines) == want
    assert "translate(" not in verdicts._jdf.queryExecution().toString()
