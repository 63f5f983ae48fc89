"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over the last ``WINDOW`` bytes ends a piece wherever it is
congruent to -1 modulo the block size, so boundaries move with the content; each piece
becomes one of 64 characters.  The block size is the smallest ``3 * 2 ** i``
whose signature has at most ``LENGTH`` characters.  A fingerprint is
``block size:signature:signature at twice the block size``.  Two fingerprints
are compared at equal block sizes: likeness is 1 - edit distance / length of
the longer signature; it is 0 if no block size is common.

Defined results
* null text is the empty text (fingerprint ``3::``); two empty texts are alike (1);
* equal texts have equal fingerprints, and equal fingerprints likeness 1;
* rows are ordered by doc_id descending, null last, then by text; repeated
  rows stand next to each other; a single row is its own next document;
* an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 7
LENGTH = 64
CODES = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
RANGES_PER_PARTITION = 4

_FACTORS = [pow(0x01000193, i + 1, 1 << 32) for i in range(WINDOW)]


def _mix(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def rolling(raw: bytes) -> np.ndarray:
    """A 32-bit hash of the last WINDOW bytes at every byte."""
    b = np.frombuffer(b"\0" * (WINDOW - 1) + raw, np.uint8).astype(np.uint32)
    n = len(raw)
    h = np.zeros(n, np.uint32)
    for i, factor in enumerate(_FACTORS):
        h += (b[i : n + i] + np.uint32(1)) * np.uint32(factor)
    return _mix(h)


def _signature(h: np.ndarray, ends: np.ndarray) -> str:
    """One character for each piece; ``ends`` are the last bytes of the pieces but a rest."""
    if not len(h):
        return ""
    starts = np.concatenate(([0], ends + 1))
    starts = starts[starts < len(h)]
    codes = np.add.reduceat(h, starts, dtype=np.uint64) >> np.uint64(5)
    return "".join(CODES[c] for c in (codes % np.uint64(64)).tolist())


def fingerprint(text: str) -> str:
    h = rolling(text.encode("utf-8", "replace"))
    block, hits = 3, np.flatnonzero(h % np.uint32(3) == 2)
    while len(hits) >= LENGTH:
        block *= 2
        hits = hits[h[hits] % np.uint32(block) == block - 1]
    twice = hits[h[hits] % np.uint32(2 * block) == 2 * block - 1]
    return f"{block}:{_signature(h, hits)}:{_signature(h, twice)}"


def edit_distance(a: str, b: str) -> int:
    """Levenshtein distance, a column of bits at a time."""
    if not a or not b:
        return len(a) + len(b)
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    rises, falls, distance = full, 0, len(a)  # where a column steps up or down from row to row
    for c in b:
        match = at.get(c, 0) | falls
        same = (((match & rises) + rises) ^ rises) | match
        more, less = falls | full & ~(rises | same), rises & same
        distance += bool(more & top) - bool(less & top)
        more = (more << 1 | 1) & full
        falls = more & same
        rises = (less << 1 | ~(more | same)) & full
    return distance


def likeness(x: str, y: str) -> float:
    """0 to 1: by edit distance of the signatures at a block size that both have."""
    if x == y:
        return 1.0
    bx, x1, x2 = x.split(":")
    by, y1, y2 = y.split(":")
    pairs = {(int(bx) << i, s) for i, s in enumerate((x1, x2))}, {int(by) << i: s for i, s in enumerate((y1, y2))}
    found = [1 - edit_distance(s, pairs[1][b]) / max(len(s), len(pairs[1][b]), 1) for b, s in pairs[0] if b in pairs[1]]
    return max(found, default=0.0)


def edited(text: str, following: str) -> str:
    """The last half (rounded down) replaced by the first as many code points of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _ranges(docs: DataFrame) -> tuple[list, dict]:
    """(cuts, heads): ids that cut the rows into ranges, and which range needs a range's largest id.

    From the ids alone.  The range above needs it as the next document of its
    last row; the lowest one needs the largest id of all, after the last comes
    the first.  Both lists have a few entries for each shuffle partition.
    """
    wanted = RANGES_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / wanted for i in range(1, wanted)]
    ids = docs.select("doc_id")
    cuts = sorted(set(ids.agg(F.percentile_approx("doc_id", shares, 20 * wanted)).first()[0] or []))
    of_range = ids.select("doc_id", _dealt(cuts, {})("doc_id")["range"].alias("range"))
    largest = {r["range"]: r["doc_id"] for r in of_range.groupBy("range").agg(F.max("doc_id").alias("doc_id")).collect()}
    order = sorted(largest)
    return cuts, {largest[r]: above for r, above in zip(order, [*order[1:], *order[:1]])}


def _dealt(cuts: list, heads: dict):
    """A function of doc_id: its range (null ids: -1, below all), and the other range that needs it."""

    @F.pandas_udf("range int, also int")
    def deal(ids: pd.Series) -> pd.DataFrame:
        there = ids.notna()
        at = np.full(len(ids), -1)
        at[there] = np.searchsorted(cuts, ids[there].to_numpy(dtype=np.int64), side="right") if len(cuts) else 0
        also = [heads.get(None if pd.isna(i) else int(i)) for i in ids]
        return pd.DataFrame({"range": at.astype(np.int32), "also": pd.array(also, dtype="Int32")})

    return deal.asNondeterministic()


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text), as the registered query returns them.

    Texts are moved once, by range of doc_id; a task walks its ranges in order
    and holds one document and the one after it.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    cuts, heads = _ranges(docs)
    dealt = docs.withColumn("to", _dealt(cuts, heads)("doc_id"))
    places = F.array(
        F.struct(F.col("to.range").alias("range"), F.lit(0).alias("guest")), F.struct(F.col("to.also").alias("range"), F.lit(1).alias("guest"))
    )
    dealt = dealt.select("doc_id", "text", F.explode(F.filter(places, lambda p: p["range"].isNotNull())).alias("at"))
    dealt = dealt.select("doc_id", "text", "at.range", "at.guest")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(n, "range").sortWithinPartitions("range", "guest", F.desc_nulls_last("doc_id"), "text")

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None  # the document that waits for its next: (range, id, text, fingerprint)
        for batch in batches:
            rows = []
            ids = batch["doc_id"].astype("Int64")
            for doc_id, text, where, guest in zip(ids, batch["text"], batch["range"], batch["guest"]):
                own = last is not None and last[0] == where
                if guest and not own:
                    continue  # the range has its next document already
                mark = fingerprint(text)
                if own:
                    rows.append(_row(last, text, mark))
                last = None if guest else (where, doc_id, text, mark)
            yield pd.DataFrame(rows, columns=COLUMNS).astype({"doc_id": "Int64"})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return dealt.mapInPandas(
        run,
        f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    )


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _row(document: tuple, following: str, next_mark: str) -> tuple:
    _, doc_id, text, mark = document
    other = edited(text, following)
    other_mark = fingerprint(other)
    digest = hashlib.sha256(other.encode("utf-8")).hexdigest()
    return doc_id, len(text), digest, mark, other_mark, likeness(mark, other_mark), likeness(mark, next_mark)
