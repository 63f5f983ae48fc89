import hashlib
import math
import random

from wattlake.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string"


def brute(made, k=16, rounds=3, dims=64, scale=64):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v, *_ in made if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    at = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]
    assign = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(at))
    for _ in range(rounds):
        groups = [[] for _ in at]
        for _, v in kept:
            groups[assign(v)[1]].append(v)
        at = [[sum(x) // len(g) for x in zip(*g)] if g else c for c, g in zip(at, groups)]
    found = [(i, *assign(v)) for i, v in kept]
    by = [sum(d for _, d, c in found if c == n) for n in range(len(at))]
    return sorted(((i is None, i or 0, c, d, by[c], sum(by)) for i, d, c in found)), at


def rows(n=150, dims=64, seed=5):
    rnd = random.Random(seed)
    f = lambda x: round(x * 512) / 512  # floats that are the same as doubles
    made = [(i, [f(rnd.gauss(0, 0.2)) for _ in range(dims)], i % 10, "c") for i in range(n)]
    made += [(n + i, made[0][1], 0, None) for i in range(60)]  # one common vector
    made += [made[3], made[3], (3, made[4][1], 1, "c"), (None, made[5][1], None, "c"), (None, made[6][1], None, "c")]
    bad = [None, [], [0.5] * (dims - 1), [0.5] * (dims + 1), [None] + [0.5] * (dims - 1), [math.nan] * dims, [math.inf] + [0.0] * (dims - 1)]
    return made + [(1000 + i, v, 0, "c") for i, v in enumerate(bad)]


def result(spark, made, **how):
    out, at = centroids.clustered(spark.createDataFrame(made, SCHEMA), **how)
    got = out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia").collect()
    return sorted((r[0] is None, r[0] or 0, *r[1:]) for r in got), at


def test_equals_brute_force(spark):
    made = rows()
    assert result(spark, made) == brute(made)


def test_few_vectors_and_none(spark):
    made = rows(3, 2)[:3] + [(9, None, 0, "c")]
    assert result(spark, made, dims=2) == brute(made, dims=2)
    assert len(brute(made, dims=2)[1]) == 3
    out, at = centroids.clustered(spark.createDataFrame([(1, None, 0, "c")], SCHEMA))
    assert (out.collect(), at) == ([], [])
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia"]


def test_empty_cluster_keeps_its_centroid(spark):
    made = [(i, [float(i // 4), 0.0], 0, "c") for i in range(8)]  # equal first centroids: the later one stays empty
    assert result(spark, made, dims=2, k=5) == brute(made, dims=2, k=5)
