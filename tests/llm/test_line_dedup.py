from collections import Counter

from tests.llm import cases
from wattlake.llm.line_dedup import line_dedup


def brute(made, min_words):
    """Every run of ``min_words`` words that occurs at an earlier place, by trying all runs."""
    docs = sorted({(r[0] is None, r[0] or 0, r[1]) for r in made if r[1] is not None})
    seen, out = set(), {}
    lines_of = {}
    for d in docs:
        lines = d[2].split("\n")
        lines_of[d] = [(i, x) for i, x in enumerate(lines) if len(x.encode().split())]
    for d in docs:
        worded, gone = lines_of[d], set()
        for i in range(len(worded)):
            n = 0
            for e in range(i, len(worded)):
                n += len(worded[e][1].encode().split())
                if n >= min_words:
                    run = tuple(x for _, x in worded[i : e + 1])
                    if run in seen:
                        gone.update(range(i, e + 1))
                    seen.add(run)
        cut = set()
        for k in gone:
            cut.add(worded[k][0])
            if k + 1 in gone:
                cut.update(range(worded[k][0], worded[k + 1][0]))
        out[d] = (len(gone), "\n".join(x for i, x in enumerate(d[2].split("\n")) if i not in cut))
    return out


def test_equals_brute_force_on_awkward_rows(spark):
    made = cases.rows()
    got = line_dedup(cases.table(spark, made)).select("doc_id", "text", "n_deleted_lines", "n_lines").collect()
    want = brute(made, 50)
    expected = Counter()
    for r in made:
        if r[1] is None:
            expected[(r[0], None, 0, 0)] += 1
        else:
            n, text = want[(r[0] is None, r[0] or 0, r[1])]
            expected[(r[0], text, n, len(r[1].split("\n")))] += 1
    assert Counter(map(tuple, got)) == expected
    assert sum(n for n, _ in want.values()) > 10


def test_empty_table_and_other_columns(spark):
    out = line_dedup(cases.table(spark, []))
    assert out.collect() == []
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "copies", "sketch", "n_lines", "n_deleted_lines"]


def test_the_last_plan_does_not_hold_the_joins_of_all_rounds(spark):
    plan = line_dedup(cases.table(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") <= 4
