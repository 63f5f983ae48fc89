import corpus_pipeline
import pytest

from tests.llm import cases
from wattlake.llm.common import stored

pytest.importorskip("public_tokenizers")


def test_stages_keep_columns_and_take_effect(spark):
    from tokenizers import Tokenizer

    from tests.llm.test_line_dedup import brute as brute_lines
    from tests.llm.test_near_dedup import brute as brute_near

    library = Tokenizer.from_file(corpus_pipeline.tokenizer_path())
    docs = cases.table(spark)
    columns, made = docs.columns, [tuple(r) for r in docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, ""), f"test-{name}")
        got = [tuple(r) for r in out.collect()]
        if name == "language_id":
            assert {r[0] for r in made if r[1] and any(c.isalpha() for c in r[1])} >= {r[0] for r in got}
            assert not [r for r in got if not r[1] or not any(c.isalpha() for c in r[1])]
            # every text of some length in the letters that the labelled ones have stays
            assert {r[0] for r in got} >= {r[0] for r in made if r[1] and len(r[1]) > 100 and not set(r[1].lower()) - set("abcdeéßñ \n")}
        elif name == "line_dedup":
            want = brute_lines(made, 50)
            assert sorted((r[0] or -1, r[1]) for r in got) == sorted((r[0] or -1, want[(r[0] is None, r[0] or 0, r[1])][1]) for r in made)
            assert all(r[4] == len(r[1]) for r in got)
        elif name == "near_dedup":
            roots, _ = brute_near(made, 5)
            assert sorted(r[0] for r in got if r[0] is not None) == sorted({v for v in roots.values()})
        elif name == "source_mixing":
            assert set(got) <= set(made)
            words = lambda rows, s: sum(len(r[1].encode().split()) for r in rows if r[3] == s and r[1])
            for source in {r[3] for r in made}:
                had, took = words(made, source), words(got, source)
                assert (took > 0) == (had > 0) and took <= 3 * had
            total = sum(words(made, s) for s in {r[3] for r in made})
            assert sum(words(got, s) for s in {r[3] for r in made}) == pytest.approx(total, rel=0.35)
        else:
            for doc_id, _, _, n, ids, same in got:
                texts = [r[1] for r in made if r[0] == doc_id]
                assert same and n == len(ids) and ids in [library.encode(t, add_special_tokens=False).ids for t in texts]
        if name != "bpe_encode":
            assert out.columns == columns
        docs, made = out, got


def test_language_stage_drops_noise_whatever_the_number_of_languages(spark):
    import random

    rnd = random.Random(1)
    prose = {"de": "der hund lief schnell durch den garten und sah die katze ", "en": "the dog ran quickly through the garden and saw the cat "}
    noise = "".join(chr(rnd.randint(0x4E00, 0x9FFF)) for _ in range(400))
    for langs in (["de"], ["de", "en"]):
        rows = [(i, prose[x] * 5, x) for i, x in enumerate(langs * 20)] + [(1000, noise, None), (1001, "12 34", None)]
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        kept = {r.doc_id for r in corpus_pipeline.language_id(spark, docs, "").collect()}
        assert kept == {r[0] for r in rows[:-2]}


def test_empty_table(spark):
    docs = cases.table(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, ""), f"test-empty-{name}")
    assert docs.collect() == []


def test_near_dedup_judges_rows_by_their_own_text(spark):
    """Document 2 has a text of its own and a copy of document 1; null ids repeat a text."""
    one, own, other = (" ".join(f"{c}{i}" for i in range(30)) for c in "abc")
    rows = [(1, one), (2, own), (2, one), (3, own + " x"), (None, other), (None, other), (None, own), (None, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in corpus_pipeline.near_dedup(spark, docs, "").collect()]
    assert sorted(got, key=str) == sorted([(1, one), (2, own), (None, other), (None, own), (None, None)], key=str)
