"""Language identification by prediction by partial matching (PPM).

For each language a context tree over bytes (orders 0 to ``ORDER``) is counted
on labelled documents.  A byte's probability in a context is PPM's (escape
method C, with exclusion): a byte seen there has count / (total + distinct);
the rest, distinct / (total + distinct), is shared out as the next shorter
context does, down to the uniform distribution over 256 bytes.  The statistics
are frozen, so every (context, byte) has one exact code length; these are
tabulated once and a document's code length under each language is a sum of
table entries over all its bytes.  The shortest code names the language.

Training sample: every labelled language is learned, from at most
``DOCS_PER_LANG`` of its documents (fewer where there are so many languages that
``SAMPLE_DOCS`` would not do for all, never none).  Documents of any length are
drawn, by a hash under a threshold taken from the language's count; of one
longer than ``MAX_DOC_BYTES`` a slice of that many bytes, from a place given by
the hash, is trained on.  The tree keeps the ``MAX_CONTEXTS`` most frequent
contexts of all orders, or as many as keep the table within ``TABLE_ENTRIES``
for all languages.  These bounds bound the sample and the table that is
broadcast, up to one document and one context (order 0) for each language.
Prediction reads every byte of every text.

Defined results
* null text, or text without a letter: ``und`` with score 0;
* no labelled document at all: every document is ``und``;
* equal code lengths: the language first in code-point order;
* repeated rows get equal results; an empty table gives an empty result;
  other columns pass through, those named as new ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlake.llm.common import forget, fresh, stored

ORDER = 3
DOCS_PER_LANG = 200
MAX_DOC_BYTES = 16_384
MAX_CONTEXTS = 16_384
SAMPLE_DOCS = 40_000
TABLE_ENTRIES = 1 << 26
UNKNOWN = "und"
#: Code-length differences count as those of at most so many bytes, so that scores of long texts stay apart.
SCORE_BYTES = 64
CHUNK = 1 << 20

_LETTER = regex.compile(r"\p{L}")  # number signs are no letters


def held_out(doc_id: Column) -> Column:
    """True for the documents kept out of training."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_sample(labelled: DataFrame, per_lang: int = DOCS_PER_LANG, max_bytes: int = MAX_DOC_BYTES) -> list[tuple[str, str]]:
    """[(lang, text)]: at most ``per_lang`` texts (slices of long ones) of every language, spread by hash."""
    fit = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    fit = fit.select("lang", "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)).alias("h"))
    # one row a language, so small; filtering by it comes before any text is moved
    counts = stored(fit.groupBy("lang").agg(F.count(F.lit(1)).alias("count"), F.min("h").alias("least")), "language-counts")
    per_lang = max(1, min(per_lang, SAMPLE_DOCS // max(1, counts.count())))
    # the least hash always goes in, as copies of one document may all lie over the threshold
    drawn = (F.col("h") * F.col("count") < F.lit(2.0 * per_lang * (1 << 30))) | (F.col("h") == F.col("least"))
    near = fit.join(F.broadcast(counts), "lang").where(drawn)
    start = F.pmod(F.xxhash64("h"), F.greatest(F.octet_length("text") - max_bytes + 1, F.lit(1))).cast("int")
    near = near.select("lang", "h", F.substring(F.col("text").cast("binary"), start + 1, F.lit(max_bytes)).alias("part"))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("h", "part"))
    rows = near.withColumn("n", first).where(F.col("n") <= per_lang).select("lang", "part").collect()
    # a slice may begin or end inside a character
    return sorted((r["lang"], r["part"].decode("utf-8", "ignore")) for r in rows)


class ContextTrees:
    """Code lengths of every kept context and byte class under every language.

    ``classes`` maps a byte to its class (class 0: bytes unseen in training);
    ``deepest`` maps the last ORDER classes to the longest kept context, and
    ``bits[context, class, language]`` are the code lengths.
    """

    def __init__(self, sample: list[tuple[str, str]], max_contexts: int = MAX_CONTEXTS):
        self.langs = sorted({lang for lang, _ in sample})
        texts = {lang: [t.encode("utf-8").lower() for x, t in sample if x == lang] for lang in self.langs}
        seen = np.zeros(256, bool)
        for parts in texts.values():
            for t in parts:
                seen[np.frombuffer(t, np.uint8)] = True
        self.classes = np.zeros(256, np.int64)
        self.classes[seen] = np.arange(1, seen.sum() + 1)
        for upper in range(ord("A"), ord("Z") + 1):  # scored texts are lower-cased in the same way
            self.classes[upper] = self.classes[upper + 32]
        self.size = s = int(seen.sum()) + 1
        unseen = 256 - int(seen.sum())
        grams = [self._grams([self.classes[np.frombuffer(t, np.uint8)] for t in texts[lang]]) for lang in self.langs]
        # contexts of each order by how often they occur in all languages; order 0 always stays
        total = [dict() for _ in range(ORDER + 1)]
        for of_lang in grams:
            for order in range(1, ORDER + 1):
                ctx, n = of_lang[order]
                keys, at = np.unique(ctx // s, return_inverse=True)
                sums = np.bincount(at, n)
                for key, count in zip(keys.tolist(), sums.tolist()):
                    total[order][key] = total[order].get(key, 0) + count
        ranked = sorted(((-n, order, key) for order in range(1, ORDER + 1) for key, n in total[order].items()))
        max_contexts = min(max_contexts, TABLE_ENTRIES // (s * max(1, len(self.langs))))
        kept: list[list[int]] = [[] for _ in range(ORDER + 1)]
        chosen: list[dict[int, int]] = [{} for _ in range(ORDER + 1)]
        for _, order, key in ranked[:max_contexts]:
            # a context's shorter forms are at least as frequent; ties could part them, so ask
            if order == 1 or key % s ** (order - 1) in chosen[order - 1]:
                chosen[order][key] = 0
                kept[order].append(key)
        uniform = np.full(s, 1 / 256)
        uniform[0] = unseen / 256
        parent_of, base = {}, 0
        probs = np.empty((1 + sum(map(len, kept)), s, len(self.langs)))
        deepest = np.zeros(s**ORDER, np.int32)
        for order in range(ORDER + 1):
            keys = np.array(sorted(kept[order]), np.int64) if order else np.zeros(1, np.int64)
            if not len(keys):
                break
            if order == 0:
                parents = np.broadcast_to(uniform[None, :, None], (1, s, len(self.langs)))
            elif order == 1:
                parents = probs[np.zeros(len(keys), int)]
            else:
                parents = probs[[parent_of[k] for k in (keys % s ** (order - 1)).tolist()]]
            for j, of_lang in enumerate(grams):
                counts = np.zeros((len(keys), s))
                ctx, n = of_lang[order]
                at = np.searchsorted(keys, ctx // s).clip(0, len(keys) - 1)
                ok = keys[at] == ctx // s
                counts[at[ok], ctx[ok] % s] = n[ok]
                probs[base : base + len(keys), :, j] = self._blend(counts, parents[:, :, j])
            parent_of = {k: base + i for i, k in enumerate(keys.tolist())}
            if order:
                # every ORDER-long key that ends in this context, longer contexts overwrite later
                view = deepest.reshape(-1, s**order)
                view[:, keys] = np.arange(base, base + len(keys), dtype=np.int32)
            base += len(keys)
        self.deepest = deepest
        with np.errstate(divide="ignore"):
            bits = -np.log2(probs)
        bits[:, 0, :] += np.log2(max(unseen, 1))  # which of the unseen bytes it is
        self.bits = np.minimum(bits, 64).astype(np.float32).reshape(len(probs) * s, len(self.langs))

    def _grams(self, texts: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per order: (context and byte as one number, count)."""
        out = []
        for order in range(ORDER + 1):
            found = []
            for t in texts:
                if len(t) > order:
                    key = np.zeros(len(t) - order, np.int64)
                    for i in range(order + 1):
                        key = key * self.size + t[i : len(t) - order + i]
                    found.append(key)
            out.append(np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.int64), np.zeros(0, int)))
        return out

    @staticmethod
    def _blend(counts: np.ndarray, parent: np.ndarray) -> np.ndarray:
        """Escape method C with exclusion; a context never seen is its parent."""
        n = counts.sum(1, keepdims=True)
        distinct = (counts > 0).sum(1, keepdims=True)
        left = np.where(counts > 0, 0, parent)
        rest = left.sum(1, keepdims=True)
        full = rest <= 0  # nothing left to escape to
        total = np.where(full, n, n + distinct)
        with np.errstate(divide="ignore", invalid="ignore"):
            p = np.where(counts > 0, counts / total, distinct / total * left / rest)
        return np.where(n > 0, p, parent)

    def code_bits(self, text: str) -> tuple[np.ndarray, int]:
        """Code length of the whole text under each language, and its bytes."""
        s, n_langs = self.size, len(self.langs)
        raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
        bits = np.zeros(n_langs)
        start = self.classes[ord("\n")]
        last = np.full(ORDER, start, np.int64)
        for at in range(0, len(raw), CHUNK):
            c = np.concatenate((last, self.classes[raw[at : at + CHUNK]]))
            n = len(c) - ORDER
            ctx = c[:n].copy()
            for i in range(1, ORDER):
                ctx *= s
                ctx += c[i : n + i]
            where = self.deepest[ctx].astype(np.int64) * s + c[ORDER:]
            bits += self.bits[where].sum(0, dtype=np.float64)
            last = c[-ORDER:]
        return bits, len(raw)

    def judge(self, text: str | None) -> tuple[str, float, float | None]:
        """(language, score, bits a byte of the text's code in that language)."""
        if not text or not self.langs or not _LETTER.search(text):
            return UNKNOWN, 0.0, None
        bits, n = self.code_bits(text)
        best = int(bits.argmin())
        share = np.exp2((bits[best] - bits) * min(1.0, SCORE_BYTES / n))
        return self.langs[best], float(1 / share.sum()), float(bits[best] / n)

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.judge(text)[:2]


def identify(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """``docs`` with ``lang_pred``, ``lang_score`` and ``lang_bits`` (bits a byte, null for ``und``), learned from ``labelled``.

    ``labelled`` (default: the documents of ``docs`` that are not held out)
    needs doc_id, text and lang; lang, source and doc_id of a document play no
    part in its own prediction.
    """
    if labelled is None:
        labelled = docs.where(~held_out(F.col("doc_id")))
    trees = docs.sparkSession.sparkContext.broadcast(vars(ContextTrees(training_sample(labelled))))

    @F.pandas_udf("lang string, score double, bits double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        forget()
        model = object.__new__(ContextTrees)
        model.__dict__ = trees.value
        for texts in batches:
            yield pd.DataFrame([model.judge(t) for t in texts], columns=["lang", "score", "bits"])

    docs = docs.drop("lang_pred", "lang_score", "lang_bits")
    (got,) = fresh(docs, "prediction")
    out = docs.withColumn(got, predict.asNondeterministic()("text"))
    return out.select(*docs.columns, F.col(f"{got}.lang").alias("lang_pred"), F.col(f"{got}.score").alias("lang_score"), F.col(f"{got}.bits").alias("lang_bits"))
