"""Token ids in files of patched frame-of-reference blocks.

Documents are encoded, ``END`` is appended to each, and the ids are written in
ascending doc_id order as segments: rows of a Parquet table, each holding whole
documents of about ``SEGMENT_IDS`` ids, so that Spark's committer and lost
tasks need no care.  A segment's ``blocks`` are the file format proper:

* a header: the number of ids and of blocks, then where each block starts;
* a block holds ``BLOCK`` ids (the last one fewer): its minimum, the width in bits and the number
  of exceptions; the differences to the minimum, packed at that width, which
  the ``PACKED_SHARE`` percentile of the differences fits; then position and
  whole difference of each exception.  Widths are even, beyond 16 multiples of
  4: four (two) differences fill the low bytes of a little-endian 64-bit word,
  and only these bytes are written.

``part`` and ``seq`` order the segments; ``before`` counts the ids of the part
before the segment, so a reader only adds what earlier parts hold.

Tasks take ranges of (doc_id, hash of the text, row), so that rows of one doc_id,
or without any, are divided too.

Defined results: null or empty text is ``END`` alone; doc_ids of any type go in
ascending order, null first; equal doc_ids are ordered by a hash of their text,
then by text; an empty table gives no segment.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from wattlake.llm.bpe import load_tokenizer, text_encoder
from wattlake.llm.common import remembered

END = 0
BLOCK = 256
PACKED_SHARE = 0.9
SEGMENT_IDS = 1 << 16

SCHEMA = "part int, seq int, before long, n_ids long, doc_ids array<string>, lengths array<int>, blocks binary"


def _per_word(width: int) -> int:
    return 4 if width <= 16 else 2


def _packed(values: np.ndarray, width: int) -> np.ndarray:
    """The bytes (lines) of ``values`` (lines of BLOCK 64-bit numbers) at ``width``."""
    per = _per_word(width)
    parts = values.reshape(len(values), -1, per)
    words = parts[:, :, 0].copy()
    for i in range(1, per):
        words |= parts[:, :, i] << np.uint64(i * width)
    raw = words.astype("<u8").view(np.uint8).reshape(len(values), BLOCK // per, 8)
    return np.ascontiguousarray(raw[:, :, : per * width // 8]).reshape(len(values), -1)


def _unpacked(raw: np.ndarray, width: int) -> np.ndarray:
    """What ``_packed`` was given, as 32-bit numbers."""
    if not width:
        return np.zeros((len(raw), BLOCK), np.uint32)
    per = _per_word(width)
    words = np.zeros((len(raw), BLOCK // per, 8), np.uint8)
    words[:, :, : per * width // 8] = raw.reshape(len(raw), BLOCK // per, -1)
    words = words.reshape(len(raw), -1).view("<u8")
    mask, out = np.uint64((1 << width) - 1), np.empty((len(raw), BLOCK // per, per), np.uint32)
    for i in range(per):
        out[:, :, i] = (words >> np.uint64(i * width)) & mask
    return out.reshape(len(raw), BLOCK)


def pack(ids: np.ndarray) -> bytes:
    """The blocks of ``ids`` (32-bit unsigned)."""
    n_blocks = -(-len(ids) // BLOCK)
    padded = np.zeros(n_blocks * BLOCK, np.uint32)
    padded[: len(ids)] = ids
    if len(ids) % BLOCK:
        padded[len(ids) :] = ids[-1]  # filler that needs no width of its own
    grid = padded.reshape(n_blocks, BLOCK)
    least = grid.min(1) if n_blocks else np.zeros(0, np.uint32)
    grid = grid - least[:, None]
    at = int(np.ceil(PACKED_SHARE * BLOCK)) - 1
    fits = np.partition(grid, at, axis=1)[:, at] if n_blocks else least
    widths = np.ceil(np.log2(fits.astype(np.float64) + 1)).astype(int)
    widths = np.where(widths <= 16, -(-widths // 2) * 2, -(-widths // 4) * 4)
    out: list[bytes] = [b""] * n_blocks
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == width)
        some = grid[rows].astype(np.uint64)
        packed = _packed(some & np.uint64((1 << width) - 1), width)
        line, place = np.nonzero(some >> np.uint64(width))
        over = some[line, place].astype("<u4")
        place, ends = place.astype("<u2"), np.searchsorted(line, np.arange(len(rows) + 1))
        for i, row in enumerate(rows.tolist()):
            a, b = ends[i], ends[i + 1]
            head = np.array([least[row], width, b - a], "<u4").tobytes()
            out[row] = head + packed[i].tobytes() + place[a:b].tobytes() + over[a:b].tobytes()
    starts = np.cumsum([0, *map(len, out)]).astype("<u4")
    return np.array([len(ids), n_blocks], "<u4").tobytes() + starts.tobytes() + b"".join(out)


def unpack(data: bytes) -> np.ndarray:
    """The ids that ``pack`` was given."""
    n, n_blocks = np.frombuffer(data, "<u4", 2).tolist()
    raw = np.frombuffer(data, np.uint8)
    starts = np.frombuffer(data, "<u4", n_blocks + 1, 8).astype(np.int64)[:-1] + 8 + 4 * (n_blocks + 1)
    heads = raw[starts[:, None] + np.arange(12)].view("<u4") if n_blocks else np.zeros((0, 3), np.uint32)
    out = np.empty((n_blocks, BLOCK), np.uint32)
    for width in np.unique(heads[:, 1]).tolist():
        rows, size = np.flatnonzero(heads[:, 1] == width), BLOCK * width // 8
        values = _unpacked(raw[starts[rows][:, None] + 12 + np.arange(size)], width)
        for i in np.flatnonzero(heads[rows, 2]).tolist():
            at, n_over = int(starts[rows[i]]) + 12 + size, int(heads[rows[i], 2])
            values[i, np.frombuffer(data, "<u2", n_over, at)] = np.frombuffer(data, "<u4", n_over, at + 2 * n_over)
        out[rows] = values + heads[rows, 0][:, None]
    return out.reshape(-1)[:n]


def segments(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """The segments of ``docs`` (doc_id, text), ready to be written as a Parquet table."""
    tokenizer = docs.sparkSession.sparkContext.broadcast(load_tokenizer(tokenizer_path))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.select("doc_id", "text", F.when(F.col("text").isNotNull(), F.xxhash64("text")).alias("h"), F.monotonically_increasing_id().alias("row"))
    ordered = keyed.repartitionByRange(n, "doc_id", "h", "row").sortWithinPartitions("doc_id", "h", "text")
    ordered = ordered.select(F.col("doc_id").cast("string").alias("doc_id"), "text")

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = remembered(("texts", tokenizer.value["key"]), lambda: text_encoder(tokenizer.value))
        part, end = TaskContext.get().partitionId(), np.array([END], np.uint32)
        seq, before, size, doc_ids, parts = 0, 0, 0, [], []

        def segment() -> pd.DataFrame:
            row = (part, seq, before, size, doc_ids, [len(p) for p in parts], pack(np.concatenate(parts)))
            return pd.DataFrame([row], columns=["part", "seq", "before", "n_ids", "doc_ids", "lengths", "blocks"])

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = encode(text)
                doc_ids.append(doc_id)
                parts.append(np.concatenate((ids, end)))
                size += len(ids) + 1
                if size >= SEGMENT_IDS:
                    yield segment()
                    seq, before, size, doc_ids, parts = seq + 1, before + size, 0, [], []
        if parts:
            yield segment()

    return ordered.mapInPandas(run, SCHEMA)


def read_documents(files: DataFrame, id_type: DataType | str = "long") -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the segments ``files``, with doc_ids of ``id_type``."""
    sums = files.groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each task that wrote: bounded by the partitions of the write
    offsets = sums.select("part", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).alias("offset"))
    placed = files.join(F.broadcast(offsets), "part").select((F.col("offset") + F.col("before")).alias("first"), "doc_ids", "lengths", "blocks")

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for first, doc_ids, lengths, blocks in zip(batch["first"], batch["doc_ids"], batch["lengths"], batch["blocks"]):
                raw = unpack(blocks).astype("<u4").tobytes()
                lengths = np.asarray(lengths, np.int64)
                ends = np.cumsum(lengths)
                starts = ends - lengths
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pd.DataFrame({"doc_id": list(doc_ids), "start": first + starts, "n_tokens": lengths, "ids_crc32": crc})

    out = placed.mapInPandas(run, "doc_id string, start long, n_tokens long, ids_crc32 long")
    return out.withColumn("doc_id", F.col("doc_id").cast(id_type))
