"""Hard-negative mining with rotated one-bit codes.

A vector is cut to integers (``floor(scale * x)``), rotated (random signs, then
a Walsh-Hadamard transform) and reduced to the signs of its components: a code
of one bit a dimension.  The *alignment* of vector and code (their inner product)
is stored with it; what the code leaves is rotated and coded again, ``LEVELS``
times, and the length of the last rest is stored.  For an anchor the same
rotations are cut to ``PLANES`` bit planes, so its inner product with a code is
a sum of popcounts.  Alignment times that product, summed over the levels, is the
estimate of a score; the rest adds at most its length times the anchor's
(Cauchy-Schwarz) and the bit planes their exact cutting error.  These bounds are
certain, not likely ones: a row whose interval cannot reach what is still wanted
is never scored, all others are scored in integers.  So results are exact.

Plan: rows are written once with their codes; they are dealt over *lanes* of
about ``LANE`` rows by a hash of a row number, anchors over groups of about
``GROUP``; each lane meets each anchor group once (the anchors are a stated query
set, compared in blocks).  A task holds one lane and one group, whatever labels or
copies are frequent.  First each lane gives its best positives of each anchor,
ranked over all lanes; then, with these scores known, the best negatives in their
bands.  No anchor, code or score passes through the driver.

Defined results
* rows with a null label, a null vector, or a component that is null or not finite
  take no part; vectors of different lengths are padded with zeros;
* repeated rows and ids are rows of their own (a copy of an anchor is another row);
* ties go to the smaller id, null ids last; an anchor without other rows of its
  label, or without negatives in the band, gives no rows;
* an empty table gives an empty result;
* scores are 64-bit integers: components up to 2**28 of the grid (64 of them) are exact.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlake.llm.centroids import finite, grid
from wattlake.llm.common import stored

POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # per cent of the positive's score
SCALE = 256
LEVELS = 4
PLANES = 8
LANE, GROUP = 8_192, 4_096
CHUNK, ANCHORS = 2_048, 128  # of a lane's rows and of a group's anchors that are compared at once
SEED = 13
SLACK = 1e-9  # relative, for rounding of doubles


class Coder:
    """Rotations, codes and bit planes of vectors with ``dims`` components."""

    def __init__(self, dims: int):
        self.width = 64
        while self.width < dims:
            self.width *= 2
        self.root = np.sqrt(self.width)
        self.signs = [np.random.default_rng([SEED, level]).choice([-1.0, 1.0], self.width) for level in range(LEVELS)]

    def rotated(self, x: np.ndarray, level: int) -> np.ndarray:
        y, half = x * self.signs[level], 1
        while half < self.width:
            y = y.reshape(len(x), self.width // (2 * half), 2, half)
            y = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), axis=2)
            half *= 2
        return y.reshape(len(x), self.width) / self.root

    def padded(self, vectors: np.ndarray) -> np.ndarray:
        out = np.zeros((len(vectors), self.width))
        out[:, : vectors.shape[1]] = vectors
        return out

    def codes(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes (rows, levels, words), alignments (rows, levels), lengths of the rests."""
        x, codes, alignments = self.padded(vectors), [], []
        for level in range(LEVELS):
            x = self.rotated(x, level)
            ones = x >= 0
            alignment = np.abs(x).sum(axis=1) / self.root
            codes.append(np.packbits(ones, axis=1).view(np.uint64))
            alignments.append(alignment)
            x = x - np.where(ones, 1.0, -1.0) * (alignment / self.root)[:, None]
        return np.stack(codes, axis=1), np.stack(alignments, axis=1), np.sqrt((x * x).sum(axis=1))

    def planes(self, vectors: np.ndarray) -> dict[str, np.ndarray]:
        """Of anchors: bit planes (anchors, levels, planes, words), their lowest value, step, sum and error, and the length."""
        x = self.padded(vectors)
        out: dict[str, list] = {"planes": [], "least": [], "step": [], "sum": [], "error": []}
        length = np.sqrt((x * x).sum(axis=1))
        for level in range(LEVELS):
            x = self.rotated(x, level)
            least = x.min(axis=1)
            step = (x.max(axis=1) - least) / (2**PLANES - 1)
            step[step == 0] = 1.0
            cut = np.rint((x - least[:, None]) / step[:, None])
            out["planes"].append(np.stack([np.packbits((cut.astype(np.int64) >> j) & 1, axis=1).view(np.uint64) for j in range(PLANES)], axis=1))
            out["least"].append(least)
            out["step"].append(step)
            out["sum"].append(least * self.width + step * cut.sum(axis=1))
            out["error"].append(np.abs(x - least[:, None] - step[:, None] * cut).sum(axis=1))
        return {k: np.stack(v, axis=1) for k, v in out.items()} | {"length": length}

    def intervals(self, rows: dict[str, np.ndarray], anchors: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score (anchors, rows) that codes and alignments allow."""
        n, m = len(anchors["length"]), len(rows["rest"])
        estimate, margin = np.zeros((n, m)), anchors["length"][:, None] * rows["rest"][None, :]
        total = rows["alignments"].sum(axis=1) + rows["rest"]
        margin += SLACK * (anchors["length"][:, None] * total[None, :] + 1.0)
        for level in range(LEVELS):
            code, alignment = rows["codes"][:, level], rows["alignments"][:, level] / self.root
            inside = np.zeros((n, m))
            for j in range(PLANES):
                for w in range(code.shape[1]):
                    inside += np.bitwise_count(anchors["planes"][:, level, j, w][:, None] & code[None, :, w]) * float(1 << j)
            ones = np.bitwise_count(code).sum(axis=1, dtype=np.int64)
            inside = anchors["least"][:, level][:, None] * ones[None, :] + anchors["step"][:, level][:, None] * inside
            estimate += (2 * inside - anchors["sum"][:, level][:, None]) * alignment[None, :]
            margin += anchors["error"][:, level][:, None] * alignment[None, :]
        return estimate - margin, estimate + margin


def ranked(keys: np.ndarray, scores: np.ndarray, late: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the first k of each key (highest score, then smallest id, ids of ``late`` rows last), and their ranks from 0."""
    order = np.lexsort((ids, late, -scores, keys))
    ordered = keys[order]
    starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else np.zeros(0, np.int64)
    rank = np.arange(len(ordered)) - np.repeat(starts, np.diff(np.r_[starts, len(ordered)]))
    return order[rank < k], rank[rank < k]


def _raised(floor: np.ndarray, keys: np.ndarray, scores: np.ndarray, rank: np.ndarray, k: int) -> None:
    """Where k rows were found, nothing under the last of them is wanted any more."""
    last = rank == k - 1
    np.maximum.at(floor, keys[last], scores[last].astype(float))


def _kth(values: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest value of each line; minus infinity where there are fewer."""
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    return np.partition(values, values.shape[1] - k, axis=1)[:, values.shape[1] - k]


class Side:
    """Rows of one lane or anchors of one group as arrays."""

    def __init__(self, frame: pd.DataFrame, dims: int):
        whole = lambda c, kind, *shape: np.frombuffer(b"".join(frame[c]), kind).reshape(len(frame), *shape)
        self.row = frame["row"].to_numpy(np.int64)
        self.label = frame["label"].to_numpy(np.int64)
        self.late = frame["vec_id"].isna().to_numpy()
        self.id = frame["vec_id"].fillna(0).astype("int64").to_numpy()
        self.vector = whole("vector", np.int64, dims)
        self.coded = {}
        if "codes" in frame:
            self.coded = {
                "codes": whole("codes", np.uint64, LEVELS, -1), "alignments": whole("alignments", np.float64, LEVELS), "rest": frame["rest"].to_numpy(np.float64)
            }

    def __len__(self) -> int:
        return len(self.row)


def _compared(rows: Side, anchors: Side, dims: int):
    """(anchor places, row places, least, greatest) of each block of the lane and the group."""
    coder = Coder(dims)
    for a in range(0, len(anchors), ANCHORS):
        some = np.arange(a, min(a + ANCHORS, len(anchors)))
        planes = coder.planes(anchors.vector[some])
        for r in range(0, len(rows), CHUNK):
            part = np.arange(r, min(r + CHUNK, len(rows)))
            yield some, part, *coder.intervals({k: v[part] for k, v in rows.coded.items()}, planes)


def _scored(rows: Side, anchors: Side, some: np.ndarray, part: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    i, j = np.nonzero(wanted)
    i, j = some[i], part[j]
    return i, j, np.einsum("ij,ij->i", anchors.vector[i], rows.vector[j])


def best_positives(rows: Side, anchors: Side, dims: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score): the first k other rows with the anchor's label, and some that a later block outdid."""
    floor, found = np.full(len(anchors), -np.inf), [(np.zeros(0, np.int64),) * 3]
    for some, part, least, most in _compared(rows, anchors, dims):
        same = (anchors.label[some][:, None] == rows.label[part][None, :]) & (anchors.row[some][:, None] != rows.row[part][None, :])
        bound = np.maximum(floor[some], _kth(np.where(same, least, -np.inf), k))
        i, j, score = _scored(rows, anchors, some, part, same & (most >= bound[:, None]))
        at, rank = ranked(i, score, rows.late[j], rows.id[j], k)
        found.append((i[at], j[at], score[at]))
        _raised(floor, i[at], score[at], rank, k)
    i, j, score = map(np.concatenate, zip(*found))
    at, _ = ranked(i, score, rows.late[j], rows.id[j], k)
    return i[at], j[at], score[at]


def best_negatives(rows: Side, anchors: Side, positive: np.ndarray, known: np.ndarray, dims: int, k: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score): the first k rows of another label in the band of each of the anchor's positives.

    ``positive`` (anchors, positives) are scores, ``known`` says which there are.
    """

    def picked(i, j, score):
        """Places of all that is among the first k for some positive; raises the floors."""
        out = np.zeros(len(i), bool)
        for p in range(positive.shape[1]):
            goal = positive[i, p]
            inside = np.flatnonzero(known[i, p] & (low * goal <= 100 * score) & (100 * score <= high * goal))
            at, rank = ranked(i[inside], score[inside], rows.late[j[inside]], rows.id[j[inside]], k)
            out[inside[at]] = True
            _raised(floors[p], i[inside[at]], score[inside[at]], rank, k)
        return out

    caps = np.where(known, positive * (high / 100), -np.inf)
    lows = np.where(known, positive * (low / 100), np.inf)
    floors = [lows[:, p].copy() for p in range(positive.shape[1])]
    slack = SLACK * (np.abs(np.where(known, positive, 0)).max(axis=1, initial=0) + 1.0)
    least_cap, most_low = np.where(known, caps, np.inf).min(axis=1, initial=np.inf), np.where(known, lows, -np.inf).max(axis=1, initial=-np.inf)
    found = [(np.zeros(0, np.int64),) * 3]
    for some, part, least, most in _compared(rows, anchors, dims):
        other = anchors.label[some][:, None] != rows.label[part][None, :]
        # rows that are in every band for certain
        sure = other & (most <= (least_cap - slack)[some][:, None]) & (least >= (most_low + slack)[some][:, None])
        floor = np.min([f[some] for f in floors], axis=0) if floors else np.full(len(some), np.inf)
        floor = np.maximum(floor, _kth(np.where(sure, least, -np.inf), k)) - slack[some]
        cap = caps[some].max(axis=1, initial=-np.inf) + slack[some]
        i, j, score = _scored(rows, anchors, some, part, other & (most >= floor[:, None]) & (least <= cap[:, None]))
        keep = picked(i, j, score)
        found.append((i[keep], j[keep], score[keep]))
    i, j, score = map(np.concatenate, zip(*found))
    keep = picked(i, j, score)
    return i[keep], j[keep], score[keep]


def coded(rows: DataFrame, dims: int) -> DataFrame:
    """``rows`` (row, vec_id, label, vector) with the vector as bytes, its codes, alignments and rest."""

    def run(batches):
        coder = Coder(dims)
        for batch in batches:
            if not len(batch):
                continue
            vectors = np.zeros((len(batch), dims), np.int64)
            for at, v in enumerate(batch["vector"]):
                vectors[at, : len(v)] = v
            codes, alignments, rest = coder.codes(vectors)
            raw = lambda x: [line.tobytes() for line in np.ascontiguousarray(x)]
            yield batch.assign(vector=raw(vectors), codes=raw(codes), alignments=raw(alignments), rest=rest)

    return rows.mapInPandas(run, "row long, vec_id long, label long, vector binary, codes binary, alignments binary, rest double")


def mine(
    rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of ``rows`` (vec_id, label, embedding).

    ``is_anchor`` is a condition on ``vec_id``.
    """
    good = F.col("label").isNotNull() & finite(F.col("embedding"))
    vectors = rows.where(good).select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        grid(F.col("embedding"), scale).alias("vector"),
    )
    vectors = stored(vectors, "negative-vectors")  # row numbers hold from here on
    n, n_anchors, dims = vectors.agg(F.count(F.lit(1)), F.count(F.when(is_anchor, 1)), F.max(F.size("vector"))).first()
    dims = max(dims or 0, 1)
    index = stored(coded(vectors, dims), "negative-codes")
    lanes, groups = n // LANE + 1, n_anchors // GROUP + 1
    each = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    hashed = lambda count: F.pmod(F.xxhash64("row"), F.lit(count)).cast("int")
    left = index.withColumns({"lane": hashed(lanes), "group": each(groups)})
    # columns of their own: Spark must tell the two sides apart
    anchors = index.where(is_anchor).select(*[F.col(c).alias(c) for c in ("row", "vec_id", "label", "vector")])

    def dealt(some: DataFrame) -> DataFrame:
        return some.withColumns({"lane": each(lanes), "group": hashed(groups)})

    def met(run, some: DataFrame) -> DataFrame:
        found = left.groupBy("lane", "group").cogroup(dealt(some).groupBy("lane", "group"))
        return found.applyInPandas(run, "anchor long, id long, score long")

    def frame(rows_: Side, anchors_: Side, i, j, score) -> pd.DataFrame:
        ids = pd.array(rows_.id[j], dtype="Int64")
        ids[rows_.late[j]] = pd.NA
        return pd.DataFrame({"anchor": anchors_.row[i], "id": ids, "score": score})

    nothing = pd.DataFrame({"anchor": pd.array([], "int64"), "id": pd.array([], "Int64"), "score": pd.array([], "int64")})

    def positive_lane(some_rows: pd.DataFrame, some_anchors: pd.DataFrame) -> pd.DataFrame:
        if not len(some_rows) or not len(some_anchors):
            return nothing
        r, a = Side(some_rows, dims), Side(some_anchors, dims)
        return frame(r, a, *best_positives(r, a, dims, positives))

    def negative_lane(some_rows: pd.DataFrame, some_anchors: pd.DataFrame) -> pd.DataFrame:
        if not len(some_rows) or not len(some_anchors):
            return nothing
        r, a = Side(some_rows, dims), Side(some_anchors, dims)
        goals, known = np.zeros((len(a), positives), np.int64), np.zeros((len(a), positives), bool)
        for at, scores in enumerate(some_anchors["scores"]):
            goals[at, : len(scores)], known[at, : len(scores)] = scores, True
        return frame(r, a, *best_negatives(r, a, goals, known, dims, negatives, low, high))

    def first(found: DataFrame, by: list[str], count: int) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("id"))
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)

    near = stored(first(met(positive_lane, anchors), ["anchor"], positives), "negative-positives")
    goals = near.groupBy(F.col("anchor").alias("row")).agg(F.sort_array(F.collect_list("score"), asc=False).alias("scores"))
    far = stored(met(negative_lane, anchors.join(goals, "row")), "negative-candidates")
    goal = near.select("anchor", F.col("rank").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    inside = (low * F.col("positive_score") <= 100 * F.col("score")) & (100 * F.col("score") <= high * F.col("positive_score"))
    pairs = first(far.join(goal, "anchor").where(inside), ["anchor", "place"], negatives)
    names = vectors.where(is_anchor).select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return pairs.join(names, "anchor").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
