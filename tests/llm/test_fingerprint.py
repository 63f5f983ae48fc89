import hashlib
import random
from collections import Counter

from tests.llm import cases
from wattlake.llm import fingerprint as fp


def distance(x, y):
    row = list(range(len(y) + 1))
    for i, c in enumerate(x):
        new = [i + 1]
        for j, d in enumerate(y):
            new.append(min(new[-1] + 1, row[j + 1] + 1, row[j] + (c != d)))
        row = new
    return row[-1]


def test_edit_distance():
    rnd = random.Random(1)
    for _ in range(300):
        x, y = ("".join(rnd.choice("abc") for _ in range(rnd.randint(0, 20))) for _ in range(2))
        assert fp.edit_distance(x, y) == distance(x, y)


def test_likeness_follows_edits():
    rnd = random.Random(2)
    text = cases.sentence(rnd, 800)
    other = cases.sentence(rnd, 800)
    words = text.split(" ")
    words[300:305] = ["changed"]
    mark = fp.fingerprint(text)
    assert fp.likeness(mark, mark) == 1 and fp.likeness(fp.fingerprint(""), fp.fingerprint("")) == 1
    assert fp.likeness(mark, fp.fingerprint(" ".join(words))) > 0.8
    assert 0.3 < fp.likeness(mark, fp.fingerprint(fp.edited(text, other))) < 0.8
    assert fp.likeness(mark, fp.fingerprint(other)) < 0.3
    assert fp.likeness(mark, fp.fingerprint("")) == 0


def test_rows_equal_a_walk_over_all(spark):
    made = cases.rows()
    got = fp.fingerprints(cases.table(spark, made)).collect()
    order = sorted(made, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    texts = [r[1] or "" for r in order]
    want = Counter()
    for i, (doc_id, *_) in enumerate(order):
        text, after = texts[i], texts[(i + 1) % len(texts)]
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        marks = [fp.fingerprint(t) for t in (text, edited, after)]
        digest = hashlib.sha256(edited.encode()).hexdigest()
        want[(doc_id, len(text), digest, marks[0], marks[1], fp.likeness(marks[0], marks[1]), fp.likeness(marks[0], marks[2]))] += 1
    assert Counter(map(tuple, got)) == want


def test_one_row_and_none(spark):
    one = fp.fingerprints(cases.table(spark, [(4, "abcd", None, None, None, None, None)])).collect()
    assert [(r.doc_id, r.edited_sha256, r.near_next) for r in one] == [(4, hashlib.sha256(b"abab").hexdigest(), 1.0)]
    assert fp.fingerprints(cases.table(spark, [])).collect() == []


def walked(text):
    """The fingerprint by a walk over the bytes, piece after piece."""
    codes = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    raw, hashes = text.encode(), []
    for k in range(len(raw)):
        h = 0
        for age in range(7):  # the byte itself has the highest power
            byte = raw[k - age] if k >= age else 0
            h = (h + (byte + 1) * 16777619 ** (7 - age)) % 2**32
        for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
            h = (h ^ h >> shift) * factor % 2**32
        hashes.append(h)

    def signature(block):
        out, ends, total, filled = "", 0, 0, False
        for h in hashes:
            total, filled = total + h, True
            if h % block == block - 1:
                out, ends, total, filled = out + codes[(total >> 5) % 64], ends + 1, 0, False
        return out + codes[(total >> 5) % 64] * filled, ends

    block = 3
    while signature(block)[1] >= 64:
        block *= 2
    return f"{block}:{signature(block)[0]}:{signature(2 * block)[0]}"


def test_fingerprints_equal_a_walk_over_the_bytes():
    rnd = random.Random(8)
    texts = ["", "a", "ab" * 400, "é" * 30, *[cases.sentence(rnd, n) for n in (1, 5, 40, 150, 900)], *[r[1] for r in cases.rows() if r[1]][:30]]
    assert [fp.fingerprint(t) for t in texts] == [walked(t) for t in texts]
    assert len({walked(t).split(":")[0] for t in texts}) > 3
