"""Small tables with the awkward rows that every operator has to take."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, copies string, sketch string"


def sentence(rnd: random.Random, words: int) -> str:
    return " ".join("".join(rnd.choice("abcdeéßñ") for _ in range(rnd.randint(1, 8))) for _ in range(words))


def rows(seed: int = 7) -> list[tuple]:
    """Copies, near copies, shared passages, nulls, empty and long texts, repeated rows."""
    rnd = random.Random(seed)
    passage = "\n".join(sentence(rnd, 20) for _ in range(4))
    long_line = sentence(rnd, 60)
    base = sentence(rnd, 120)
    texts = [sentence(rnd, rnd.randint(1, 90)) + "\n" + sentence(rnd, 12) for _ in range(12)]
    texts += [f"{sentence(rnd, 30)}\n{passage}\n{sentence(rnd, 9)}" for _ in range(5)]
    texts += [f"{long_line}\n\n{sentence(rnd, 5)}\n{long_line}", f"{sentence(rnd, 3)}\n{long_line}\n  \n"]
    words = base.split(" ")
    for i in range(25):  # near copies of one text, some further apart from each other
        changed = list(words)
        for at in rnd.sample(range(len(words)), i % 7):
            changed[at] = f"x{i}"
        texts.append(" ".join(changed))
    texts += [base, base.upper().replace("É", "é").replace("ß".upper(), "ß"), None, "", " \n\t ", "one", "ONE", "1 2 3", "a\x0bb\x0cc\td"]
    texts += [sentence(rnd, 6000), "<|endoftext|> in a text<|endoftext|>", "same words " * 30]
    made = [
        (i, t, [None, "en", "de"][i % 3], [None, "s1", "s2", "s3"][i % 4], None if t is None else len(t), "c", "s")
        for i, t in enumerate(texts)
    ]
    made += [made[3], made[3]]  # repeated rows
    made += [(None, texts[5], "en", "s1", 5, None, None), (None, None, None, None, None, None, None)]
    return made


def table(spark, made=None):
    return spark.createDataFrame(rows() if made is None else made, SCHEMA)
