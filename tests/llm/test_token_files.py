import zlib

import numpy as np
import pytest

from tests.llm import cases
from wattlake.llm import token_files
from wattlake.llm.common import stored

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 5000])
def test_blocks_round_trip(n):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, 50257, n).astype(np.uint32)
    ids[: n // 20] = 2**32 - 1
    assert (token_files.unpack(token_files.pack(ids)) == ids).all()
    same = np.full(n, 7, np.uint32)
    assert (token_files.unpack(token_files.pack(same)) == same).all()


def test_small_ids_pack_small():
    ids = np.random.default_rng(1).integers(100, 163, 25600).astype(np.uint32)
    assert len(token_files.pack(ids)) < 25600 * 6 / 8 + 100 * 20


def test_documents_come_back(spark, monkeypatch):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(PATH)
    made = cases.rows()
    files = stored(token_files.segments(cases.table(spark, made), PATH), "test-files")
    got = sorted(map(tuple, token_files.read_documents(files).collect()), key=lambda r: r[1])
    order = sorted(made, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start = 0
    for row, (doc_id, text, *_) in zip(got, order, strict=True):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        assert row == (doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_empty_table(spark):
    files = stored(token_files.segments(cases.table(spark, []), PATH), "test-files")
    assert token_files.read_documents(files).collect() == []


def test_ids_of_any_type_and_copies_of_one_id(spark):
    rows = [("b", "two words"), ("a", None), (None, "x"), (None, "y"), ("a", "one"), ("a", "one")] + [("z", f"text {i}") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    files = stored(token_files.segments(docs, PATH), "test-files")
    got = sorted(map(tuple, token_files.read_documents(files, "string").collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None] * 2 + ["a"] * 3 + ["b"] + ["z"] * 50
    assert [r[1] for r in got] == [sum(r[2] for r in got[:i]) for i in range(len(got))]
    assert got[2][2] == 1  # the null text of "a" comes first


@pytest.mark.parametrize("width", range(33))
def test_every_width_round_trips(width):
    rng = np.random.default_rng(width)
    ids = rng.integers(0, 2**width, 3000, dtype=np.uint64).astype(np.uint32)
    ids[::97] = rng.integers(0, 2**32, len(ids[::97]), dtype=np.uint64).astype(np.uint32)
    packed = token_files.pack(ids)
    assert (token_files.unpack(packed) == ids).all()
    assert len(packed) < 3000 * (width + 4) / 8 + 12 * (6 * 31 + 32) + 100
