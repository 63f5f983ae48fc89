from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import cases
from wattlake.llm import common, near_dedup


def shingles(text, n):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def brute(made, n):
    """Components over all pairs of rows that share a shingle."""
    sets = {(r[0], r[1]): shingles(r[1], n) for r in made if r[0] is not None}
    keys = sorted(sets, key=lambda k: k[0])
    root = {k: k for k in keys}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((find(a), find(b)), key=lambda k: k[0])
                root[y] = x
    return {k: find(k)[0] for k in keys}, sets


@pytest.mark.parametrize("words", [4, 5])
def test_equals_all_pairs(spark, words):
    made = cases.rows()
    got = near_dedup.near_duplicates(cases.table(spark, made), words=words).collect()
    roots, sets = brute(made, words)
    want = Counter()
    for doc_id, text, *_ in made:
        if doc_id is None:
            want[(None, len(shingles(text, words)), None, True)] += 1
        else:
            want[(doc_id, len(sets[(doc_id, text)]), roots[(doc_id, text)], roots[(doc_id, text)] == doc_id)] += 1
    assert Counter(map(tuple, got)) == want
    assert len(set(roots.values())) < len(roots) - 10


def test_long_lists_lose_no_link(spark, monkeypatch):
    """With every list taken for a long one, only centres and open lists give pairs."""
    monkeypatch.setattr(near_dedup, "SHORT_LIST", 1)
    made = cases.rows(11)
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(cases.table(spark, made), words=4).collect()}
    roots, _ = brute(made, 4)
    assert {k[0]: v for k, v in roots.items()} == {k: v for k, v in got.items() if k is not None}


def test_chains_of_links(spark):
    edges = spark.range(1, 60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.root for r in near_dedup.components(edges).collect()} == {1}


def test_empty_table(spark):
    assert near_dedup.near_duplicates(cases.table(spark, [])).collect() == []


def test_bounds_hold_for_every_threshold():
    from math import comb

    assert near_dedup.bounds(80) == (32, 10)
    for threshold in range(1, 101):
        k, shared = near_dedup.bounds(threshold)
        t = threshold / 100
        assert shared >= 1
        assert sum(comb(k, i) * t**i * (1 - t) ** (k - i) for i in range(shared)) <= near_dedup.MISS
    with pytest.raises(ValueError):
        near_dedup.bounds(0)


def test_low_thresholds_lose_no_link(spark):
    """Pairs with a similarity of 30 per cent, 60 of 200 words."""
    rows = []
    for i in range(20):
        words = [f"w{i}x{j}" for j in range(200)]
        rows += [(2 * i, " ".join(words[:130])), (2 * i + 1, " ".join(words[70:]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs, words=1, threshold=30).collect()}
    assert got == {i: i - i % 2 for i in range(40)}


def test_tasks_hold_few_texts_and_no_other_operators_memory(spark):
    batch = pa.RecordBatch.from_pydict({"doc_id": [str(i) for i in range(2 * near_dedup.SLICE + 1)]})
    parts = list(near_dedup.slices([batch, batch.slice(0, 0)]))
    assert [p.num_rows for p in parts] == [near_dedup.SLICE, near_dedup.SLICE, 1]
    assert pa.Table.from_batches(parts).to_pydict() == batch.to_pydict()
    assert common.remembered(("one",), lambda: "kept") == common.remembered(("one",), lambda: "new") == "kept"
    common.forget()
    assert common.remembered(("one",), lambda: "new") == "new"
    common.forget()
    common.forget()  # nothing to let go of
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    near_dedup.near_duplicates(cases.table(spark, [])).collect()
    assert spark.conf.get(key) == before


def test_links_of_many_tasks_are_few_files(spark):
    pairs = spark.range(1000, numPartitions=40).selectExpr("id AS a", "id + 1 AS b")
    links = near_dedup._links(pairs)
    assert links.exceptAll(pairs).isEmpty() and pairs.exceptAll(links).isEmpty()
    assert len(links.inputFiles()) < 8
