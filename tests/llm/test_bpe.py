import gc
import hashlib
import random
import weakref
from array import array

import numpy as np
import pytest

from tests.llm import cases
from wattlake.llm import bpe, common

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def data():
    return bpe.load_tokenizer(PATH)


def texts():
    rnd = random.Random(3)
    parts = ["a", "B", " ", "  ", "\n", "\t", "é", "ß", "1", "'s", "'", "<|endoftext|>", "\xa0", "　", ".", ",", "!", "\u0558", "漢", "😀"]
    parts += ["\x1c", "\x85", "the", "ing", " <|endoftext|>", "\r\n", "²", "\u0301", "\u088f"]
    made = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))) for _ in range(4000)]
    return made + ["a" * 500, "ab" * 2000, " " * 300, "\n" * 50, "xyz" * 100 + "é" * 300, "\n\xa0", " a", "a ", "a\n", None]


def test_all_paths_equal_the_library(library, data):
    merger = bpe.Merger(data)
    words = {p.encode(): merger.ids(p.encode()) for p in [" the", "the", "\n", "a", " a", "ing", ".", " B1"]}
    encoding, counting = bpe.Encoding(data, bpe.Lexicon(bpe.compile_lexicon(words))), bpe.Counting(data, {" the": 1})
    once = bpe.text_encoder(data)
    for text in texts():
        want = library.encode(text or "", add_special_tokens=False).ids
        got = array("I", encoding.encode(text)).tolist()
        assert got == want == once(text).tolist(), text
        assert counting.count(text) == len(want)
        assert encoding.decode(got) == library.decode(want, skip_special_tokens=False)


def test_lexicon_has_its_words_and_no_others(data):
    rnd = random.Random(5)
    words = {bytes(rnd.choice(b"abc\xff") for _ in range(rnd.randint(1, 6))): [rnd.randint(0, 9) for _ in range(rnd.randint(0, 3))] for _ in range(400)}
    lexicon = bpe.Lexicon(bpe.compile_lexicon(words))
    for word, ids in words.items():
        assert array("I", lexicon.get(word)).tolist() == ids
    for _ in range(2000):
        word = bytes(rnd.choice(b"abc\xffd") for _ in range(rnd.randint(0, 8)))
        assert word in words or lexicon.get(word) is None
    assert bpe.Lexicon(bpe.compile_lexicon({})).get(b"a") is None


def test_tokens_that_merges_cannot_make_are_left_out(data):
    assert all(bpe.Merger(data).ids(data["tokens"][i]) == [i] for i in data["ranked"][::500])


def test_cache_forgets_and_finds_again():
    asked = []
    cache = bpe.Cache(lambda k: asked.append(k) or k * 2, entries=2)
    assert [cache[k] for k in (1, 2, 3, 1, 4, 5, 1)] == [2, 4, 6, 2, 8, 10, 2]
    assert len(cache) <= 2


def test_queries_equal_the_library(spark, library):
    docs = cases.table(spark)
    want = {}
    for r in cases.rows():
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        want[(r[0], r[1])] = (ids, library.decode(ids, skip_special_tokens=False))
    counted = bpe.count_tokens(docs, PATH).collect()
    assert len(counted) == len(cases.rows()) and all(r.n_tokens == len(want[(r.doc_id, r.text)][0]) for r in counted)
    for r in bpe.round_trip_digests(docs, PATH).collect():
        ids, text = want[(r.doc_id, r.text)]
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert (r.n_tokens, r.decoded_sha256) == (len(ids), hashlib.sha256(text.encode()).hexdigest())
    for r in bpe.round_trip(docs, PATH).collect():
        assert (r.ids, r.decoded) == want[(r.doc_id, r.text)]


def test_empty_table(spark):
    assert bpe.count_tokens(cases.table(spark, []), PATH).collect() == []
    assert bpe.round_trip(cases.table(spark, []), PATH).collect() == []


def test_a_forgotten_encoder_is_freed_at_once(data):
    """It and its cache refer to each other, so the worker would keep both while other operators run."""
    small = bpe.for_tasks(data)
    make = lambda: bpe.Encoding(small, None)
    common.forget()
    gc.disable()
    try:
        first = weakref.ref(common.remembered(("first",), make))
        assert first().decode(np.frombuffer(first().encode("as it was"), np.uint32).tolist()) == "as it was"
        second = weakref.ref(common.remembered(("second",), make))
        assert first() is None and second() is not None
        common.forget()
        assert second() is None
    finally:
        gc.enable()
        common.forget()
