import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm import cases
from wattlake.llm import mixing


def fill(sizes):
    """Targets by rounds: whoever passes its cap is fixed there and the rest shared again."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    capped, total = set(), sum(sizes.values())
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(3 * sizes[s] for s in capped)
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            return {s: 3 * sizes[s] if s in capped else share[s] for s in names}
        capped |= over


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 50, None: 3}, {"a": 5}, {"a": 0, "b": 7}, {"x": 100, "y": 100, "z": 100, "zz": 1}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(fill(sizes))


def test_taken_words_come_near_the_targets(spark):
    made = [(i, "w " * (1 + i % 9), None, f"s{i % 5}", 0, "x", "y") for i in range(3000)] + cases.rows()
    docs = cases.table(spark, made)
    got = mixing.mix(docs).collect()
    assert len(got) == len(made)
    taken, of = defaultdict(int), {}
    for r in got:
        assert 0 <= r.copies <= 3 and (r.size or not r.copies)
        taken[r.source] += r.copies * r.size
        of[r.source] = (r.target, r.source_size)
    want = fill({s: n for s, (_, n) in of.items()})
    for s, (target, _) in of.items():
        assert target == pytest.approx(want[s])
        biggest = max(r.size for r in got if r.source == s)
        assert abs(taken[s] - target) <= biggest
    again = mixing.mix(docs.repartition(7)).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.size, r.copies)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_hash_is_whole_and_equal_rows_stand_together(spark):
    docs = spark.createDataFrame([(1, "a b", "s")] * 4 + [(2, None, "s")], "doc_id long, text string, source string")
    got = mixing.mix(docs).collect()
    assert len({r.copies for r in got if r.doc_id == 1}) == 1
    assert [r.copies for r in got if r.doc_id == 2] == [0]
    assert docs.select(mixing.hash60(F.col("doc_id"), F.lit("x")).alias("h")).where("h < 0").count() == 0


def test_mixed_rows_and_empty_table(spark):
    docs = cases.table(spark)
    rows = mixing.mixed(docs)
    assert rows.columns == docs.columns
    copies = sum(r.copies for r in mixing.mix(docs).collect())
    assert rows.count() == copies
    assert mixing.mixed(cases.table(spark, [])).collect() == [] == mixing.mix(cases.table(spark, [])).collect()


def test_rows_without_or_with_equal_ids_meet_the_target(spark):
    """Texts, not ids alone, decide which rows are taken."""
    rnd = random.Random(4)
    text = lambda: " ".join(f"w{rnd.randint(0, 999)}" for _ in range(rnd.randint(5, 15)))
    rows = [(None, text(), "a") for _ in range(200)] + [(7, text(), "b") for _ in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(docs).groupBy("source").agg(F.first("target").alias("target"), F.sum(F.col("copies") * F.col("size")).alias("taken"))
    for r in out.collect():
        assert abs(r["taken"] - r["target"]) <= 15
