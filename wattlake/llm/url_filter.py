"""URL filters: host and path rules, and a character language-model ratio for the rest.

A rule is a host and a path prefix (``example.com/en/``); it fits its host and
all subdomains where the url's path starts with the rule's path, and the
longest fitting rule decides.  Urls that rules accept or reject train two
variable-order Markov models over the characters after the scheme: the
probability of a character after its last 0 to ``ORDER`` characters, each order
smoothed with the one below it by Witten-Bell weights.  A url without a rule is
judged by the difference of its log-likelihoods under both models, divided by
its length: blocked when that lies under a threshold, which is calibrated so
that at most ``LOST`` of the urls accepted by rule would be blocked.

Characters are folded to ``len(ALPHABET)`` + 2 symbols (digits are one symbol,
all others are one), so the models have at most 41 ** (ORDER + 1) entries
whatever the corpus; the counts come from all urls with a rule.

Defined results
* null url or url without ``://``: host and path are empty and no rule fits; the
  models judge the whole string (null: as the empty one, ratio 0, allowed);
* without urls accepted by rule or without rejected ones: allow;
* repeated rows count as often as they occur and are judged alike; an empty
  table gives an empty result; other columns pass through, those named as new
  ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.llm.common import fresh

RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)
ORDER = 3
ALPHABET = "abcdefghijklmnopqrstuvwxyz./-_?=&#%~:+"
LOST = 0.01
#: Log-likelihood differences are kept in steps of this size (nats a character) to find the threshold.
STEP = 1 / 4096

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; null where there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, or null."""
    out = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        of_host, _, of_path = rule.partition("/")
        fits = ((host == of_host) | host.endswith("." + of_host)) & path.startswith("/" + of_path)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


# Symbols: the alphabet, then digits, then everything else, then the start.
_DIGIT, _OTHER = len(ALPHABET), len(ALPHABET) + 1
_START = len(ALPHABET) + 2
SYMBOLS = len(ALPHABET) + 3


def _table() -> np.ndarray:
    table = np.full(256, _OTHER, np.int64)
    for i, c in enumerate(ALPHABET):
        table[ord(c)] = i
        table[ord(c.upper())] = i
    table[ord("0") : ord("9") + 1] = _DIGIT
    return table


def _contexts(url: str | None) -> np.ndarray:
    """For each character: the symbols of its last ORDER characters and its own, as one number."""
    head, mark, tail = (url or "").partition("://")
    rest = tail if mark else head
    symbols = np.concatenate((np.full(ORDER, _START), _table()[np.frombuffer(rest.encode("utf-8", "replace"), np.uint8)]))
    n = len(symbols) - ORDER
    key = np.zeros(n, np.int64)
    for i in range(ORDER + 1):
        key = key * SYMBOLS + symbols[i : n + i]
    return key


def _counts(labelled: DataFrame) -> DataFrame:
    """(verdict, gram, n) over all urls with a rule; tasks count before anything is moved."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for verdict, urls in batch.groupby("verdict")["url"]:
                grams = np.concatenate([_contexts(u) for u in urls])
                keys, n = np.unique(grams, return_counts=True)
                yield pd.DataFrame({"verdict": verdict, "gram": keys, "n": n})

    counted = labelled.select("verdict", "url").mapInPandas(run, "verdict string, gram long, n long")
    return counted.groupBy("verdict", "gram").agg(F.sum("n").alias("n"))


def log_probabilities(grams: np.ndarray, n: np.ndarray) -> np.ndarray:
    """log P(symbol | last ORDER symbols) for every gram: Witten-Bell over all shorter contexts."""
    full = np.zeros(SYMBOLS ** (ORDER + 1))
    full[grams] = n
    p = np.full(SYMBOLS, 1 / SYMBOLS)
    for order in range(ORDER + 1):
        counts = full.reshape(-1, SYMBOLS ** (order + 1)).sum(0).reshape(-1, SYMBOLS)
        total, kinds = counts.sum(1, keepdims=True), (counts > 0).sum(1, keepdims=True)
        below = np.tile(p.reshape(-1, SYMBOLS), (len(counts) // max(1, p.size // SYMBOLS), 1))
        p = (counts + kinds * below) / np.maximum(total + kinds, 1)
        p = np.where(total > 0, p, below)
    return np.log(p).reshape(-1)


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """``pages`` with host, path, rule, ``llr`` (nats a character) and verdict of ``url``."""
    verdict_of = dict(rules)
    pages = pages.drop("host", "path", "rule", "llr", "verdict")
    out = pages.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    out = out.withColumn("rule", fitting_rule(F.col("host"), F.col("path"), rules))
    by_rule = F.lit(None).cast("string")
    for rule, verdict in rules:
        by_rule = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(by_rule)
    labelled = out.where("rule IS NOT NULL").select("url", by_rule.alias("verdict"))
    counts = _counts(labelled).toPandas()  # at most 2 * SYMBOLS ** (ORDER + 1) rows
    parts = {v: counts[counts["verdict"] == v] for v in ("allow", "block")}
    if any(p.empty for p in parts.values()):
        return out.withColumns({"llr": F.lit(0.0), "verdict": F.coalesce(by_rule, F.lit("allow"))})
    logs = [log_probabilities(p["gram"].to_numpy(), p["n"].to_numpy()) for p in parts.values()]
    ratio = pages.sparkSession.sparkContext.broadcast((logs[0] - logs[1]).astype(np.float32))

    @F.pandas_udf("double")
    def llr(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = ratio.value
        for urls in batches:
            found = []
            for url in urls:
                grams = _contexts(url)
                found.append(float(table[grams].mean(dtype=np.float64)) if len(grams) else 0.0)
            yield pd.Series(found, dtype="float64")

    (code,) = fresh(out, "by_rule")
    out = out.withColumn("llr", llr.asNondeterministic()("url")).withColumn(code, by_rule)
    steps = labelled.where("verdict = 'allow'").select(F.floor(llr.asNondeterministic()("url") / STEP).alias("step"))
    steps = steps.groupBy("step").count().toPandas().sort_values("step")  # bounded: llr is, and so are its steps
    under = steps["count"].cumsum() - steps["count"]
    # the highest step with at most LOST of the accepted urls under it, and never above even odds
    threshold = min(0.0, float(steps["step"][under <= LOST * steps["count"].sum()].max()) * STEP)
    rest = F.when(F.col("llr") < threshold, "block").otherwise("allow")
    return out.withColumn("verdict", F.coalesce(code, rest)).drop(code)
