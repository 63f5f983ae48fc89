"""Byte-level BPE with the files of a public tokenizer: counts, ids and back.

Results equal the tokenizers library's for the same file (encode without added
special tokens, decode with them).  Text is cut into pre-tokens by the fixed
pattern; a pre-token's ids do not depend on what surrounds it, so they are
looked up, and only unseen ones are merged, once per Python worker.

Unseen words are merged by tiktoken's merge loop, which joins the adjacent pair
whose *concatenation* ranks lowest, while the file lists *pairs*.  Both agree
if every token in the rank table is what its own bytes merge to: until a pair
is joined, merges inside its bytes are those of the bytes alone, so its two
halves are the listed ones.  ``load_tokenizer`` therefore merges the bytes of
every token by the listed pairs and leaves out those that come to something
else (the listed pairs can never make them).

*Counting* (``count_tokens``): a broadcast table has the lengths of the
frequent pre-tokens and is asked first; misses are merged and remembered in the
worker's cache.  No pre-token is shuffled by its value.

*Encoding* (``round_trip``): the frequent pre-tokens are compiled into a minimal
acyclic automaton whose words are numbered by the counts on its arcs, the
number leading to the ids.  It is one file, sent to each executor by Spark's
file distribution and memory-mapped there by all its workers.

The frequent pre-tokens are counted over all texts.  Each task keeps a
heavy-hitter summary of at most ``FREQUENT`` of them (what falls out lowers the
others' counts alike, so that whatever makes up more than its share of 1 in
``FREQUENT`` stays); summaries, one row a task, are merged ``FAN`` at a time in a
tree, and the last one is all the driver gets.  They decide how fast a pre-token's
ids are found, never which.  A worker's memory holds one encoder or counter at a
time, caches of at most ``CACHE_BYTES`` a generation, and no unit over ``LONG``.

Defined results: null text is the empty text (no token); the strings of
special tokens inside a text become those tokens, as in the library; repeated
rows get equal results; an empty table gives an empty result; other columns
pass through.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import re
import struct
import sys
import unicodedata
import uuid
from array import array
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wattlake.llm.common import forget, fresh, remembered, stored, trim
from wattlake.session import hadoop_fs, scratch_path

# Fixed value: the pattern of byte-level pre-tokenizers.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

FREQUENT = 50_000
FAN = 8  # summaries that are merged at a time
CACHE_ENTRIES = 500_000  # of each of a cache's two generations, at most
CACHE_BYTES = 40 << 20  # and their size
LONG = 64  # characters; longer units are counted and cached nowhere
ROWS = 256  # texts that are encoded before their ids go back to Spark
SHORT = 256  # symbols up to which repeated scans beat a heap

_SPACE = re.compile(r"\s")
#: Code points from here on may be unassigned in one Unicode version and letters in the next.
_LATE = re.compile("[՘-\U0010ffff]")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies -> the byte.

    Printable Latin-1 characters stand for themselves, the others for the
    code points from 256 on, in order.
    """
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    letters = {chr(b): b for b in plain}
    letters |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in letters.values())}
    return letters


def load_tokenizer(path: str) -> dict:
    """What tasks need of a tokenizers file, as plain data (bounded by the vocabulary)."""
    with open(path, encoding="utf-8") as f:
        raw = f.read()
    spec = json.loads(raw)
    letters = byte_letters()
    vocab = spec["model"]["vocab"]
    pairs = [p if isinstance(p, list) else p.split(" ") for p in spec["model"]["merges"]]
    ranks = {vocab[a] << 32 | vocab[b]: rank for rank, (a, b) in enumerate(pairs)}
    made = [vocab[a + b] for a, b in pairs]
    tokens = {i: bytes(letters[c] for c in t) for t, i in vocab.items()}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    tokens |= {i: t.encode() for t, i in special.items()}
    by_byte = [0] * 256
    for letter, b in letters.items():
        by_byte[b] = vocab[letter]
    data = {"raw": raw, "key": hashlib.sha256(raw.encode()).hexdigest(), "ranks": ranks, "made": made, "by_byte": by_byte}
    data |= {"tokens": tokens, "special": special}
    merger = Merger(data)
    reachable = [i for i in dict.fromkeys(made) if merger.ids(tokens[i]) == [i]]
    return data | {"ranked": [*by_byte, *reachable]}


def for_tasks(data: dict) -> dict:
    """The part of ``load_tokenizer``'s answer that tasks need: they merge by ``ranked``, not by pairs."""
    return {name: data[name] for name in ("raw", "key", "special", "tokens", "ranked")}


class Merger:
    """BPE merges of one pre-token by the listed pairs: the lowest rank first, leftmost first."""

    def __init__(self, data: dict):
        self.ranks, self.made, self.by_byte = data["ranks"], data["made"], data["by_byte"]

    def ids(self, piece: bytes) -> list[int]:
        by_byte, get, made = self.by_byte, self.ranks.get, self.made
        ids = [by_byte[b] for b in piece]
        if len(ids) > SHORT:
            return self._long(ids)
        never = len(made)
        ranks = [get(a << 32 | b, never) for a, b in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == never:
                break
            i = ranks.index(best)
            ids[i : i + 2] = [made[best]]
            del ranks[i]
            if i:
                ranks[i - 1] = get(ids[i - 1] << 32 | ids[i], never)
            if i < len(ranks):
                ranks[i] = get(ids[i] << 32 | ids[i + 1], never)
        return ids

    def _long(self, ids: list[int]) -> list[int]:
        get, n = self.ranks.get, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (rank := get(ids[i] << 32 | ids[j])) is not None:
                heapq.heappush(heap, (rank, i, ids[i], ids[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i] if ids[i] == left else n
            if j >= n or ids[j] != right:
                continue
            ids[i], ids[j], after[i] = self.made[rank], -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [x for x in ids if x >= 0]


def fast_merges(data: dict) -> Callable[[str], list[int]]:
    """A function from a pre-token to its ids, for tasks (see the module's text on why it is exact)."""
    import tiktoken

    ranked, tokens = data["ranked"], data["tokens"]
    whole = tiktoken.Encoding(
        "pretoken", pat_str="(?s).+", mergeable_ranks={tokens[i]: rank for rank, i in enumerate(ranked)}, special_tokens={}
    )
    encode, to_id = whole.encode_ordinary, ranked.__getitem__
    return lambda piece: list(map(to_id, encode(piece)))


class Cache(dict):
    """A bounded memory of ``make``: when full, what was not used lately is forgotten."""

    def __init__(self, make: Callable, entries: int = CACHE_ENTRIES, size: int = CACHE_BYTES):
        super().__init__()
        self.make, self.entries, self.size, self.held, self.old = make, entries, size, 0, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
            if isinstance(key, str) and len(key) > LONG:
                return value
        cost = sys.getsizeof(key) + sys.getsizeof(value) + 100  # with its place in the dictionary
        if len(self) >= self.entries or self.held + cost > self.size:
            self.old, self.held = dict(self), 0
            self.clear()
        self.held += cost
        self[key] = value
        return value


class Tiers(dict):
    """A fixed table first; what it does not have is asked of ``rare``."""

    def __init__(self, table: dict, rare: Cache):
        super().__init__(table)
        self.rare = rare

    def __missing__(self, key):
        return self.rare[key]


class Splitter:
    """Cuts texts into units and units into pre-tokens.

    A unit is a word with the single space or line break before it: no
    pre-token reaches from a non-space into a space, so units can be looked
    up as wholes.  Units are written without their space (``"x"`` is " x",
    ``"\\nx"`` is a line break and x); a text's first unit has none.
    """

    def __init__(self, data: dict):
        self.raw, self.special = data["raw"], data["special"]
        self.find = regex.compile(PATTERN).findall
        self.at_special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.library = None

    def segments(self, text: str) -> Iterator[tuple[str, int | None]]:
        """(text between special tokens, id of the special token that follows or None)."""
        start = 0
        if self.at_special and any(s in text for s in self.special):
            for m in self.at_special.finditer(text):
                yield text[start : m.start()], self.special[m[0]]
                start = m.end()
        yield text[start:], None

    def strange(self, text: str) -> bool:
        """Whether ``text`` has unassigned characters, which Unicode versions class differently."""
        return not text.isascii() and bool(_LATE.search(text)) and any(unicodedata.category(c) == "Cn" for c in set(text))

    def by_library(self, text: str) -> list[str]:
        from tokenizers import Tokenizer

        if self.library is None:
            self.library = Tokenizer.from_str(self.raw).pre_tokenizer
        return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]

    def map(self, text: str, of_piece: Callable, of_unit: Callable) -> Iterator[list]:
        """Lists of ``of_piece(pre-token)`` and ``of_unit(unit)`` that make up ``text`` in order.

        ``of_unit`` answers None for a unit that cannot stand alone (it has
        other white space); the text is then cut by the pattern as a whole.
        """
        if not text:
            return
        if self.strange(text):
            yield list(map(of_piece, self.by_library(text)))
            return
        parts = text.replace("\n", " \n").split(" ")
        if "" not in parts and "\n" not in parts and not _SPACE.search(parts[0]):
            found = list(map(of_unit, parts[1:]))
            if None not in found:
                yield list(map(of_piece, self.find(parts[0])))
                yield found
                return
        yield list(map(of_piece, self.find(text)))

    def pieces(self, unit: str) -> list[str] | None:
        """The pre-tokens of a unit; None if it has white space of its own."""
        if unit.isalpha():
            return [" " + unit]
        if unit[-1:] in (".", ",") and unit[:-1].isalpha():
            return [" " + unit[:-1], unit[-1]]
        if _SPACE.search(unit, 1):
            return None
        if unit[0] == "\n":
            return ["\n", *self.find(unit[1:])]
        return None if _SPACE.match(unit) else self.find(" " + unit)


def trimmed(counts: Counter, most: int) -> Counter:
    """At most ``most`` of ``counts``, less what the first one left out has."""
    if len(counts) <= most:
        return counts
    cut = heapq.nlargest(most + 1, counts.values())[-1]
    return Counter({k: n - cut for k, n in counts.items() if n > cut})


def frequent_pretokens(docs: DataFrame, tokenizer: dict, most: int = FREQUENT) -> list[str]:
    """The most frequent pre-tokens of all texts, by heavy-hitter summaries merged in a tree."""

    # a small part of the tokenizer: tasks that only cut texts hold no merges
    cutting = docs.sparkSession.sparkContext.broadcast({name: tokenizer[name] for name in ("raw", "special")})

    def row(part: int, counts: Counter) -> pd.DataFrame:
        return pd.DataFrame({"part": [part], "pieces": [list(counts)], "counts": [list(counts.values())]})

    def count(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget()
        split, units, pieces = Splitter(cutting.value), Counter(), Counter()
        for batch in batches:
            for text in batch["text"]:
                found = text.replace("\n", " \n").split(" ")
                if max(map(len, found)) > LONG:
                    found = [u for u in found if len(u) <= LONG]
                units.update(found)
                if len(units) > 4 * most:
                    units = trimmed(units, 2 * most)
        units.pop("", None)
        for unit, n in units.items():
            for piece in split.pieces(unit) or ():
                pieces[piece] += n
        yield row(TaskContext.get().partitionId(), trimmed(pieces, most))

    def merge(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        total = Counter()
        for pieces, counts in zip(parts["pieces"], parts["counts"]):
            for piece, n in zip(pieces, counts):
                total[piece] += int(n)
        return row(key[0], trimmed(total, most))

    schema = "part long, pieces array<string>, counts array<long>"
    summaries = stored(docs.where(F.col("text").isNotNull()).select("text").mapInPandas(count, schema), "pretoken-counts")
    parts = (summaries.agg(F.max("part")).first()[0] or 0) + 1
    while parts > 1:
        up = summaries.withColumn("part", F.floor(F.col("part") / FAN)).groupBy("part").applyInPandas(merge, schema)
        summaries, parts = stored(up, "pretoken-counts"), -(-parts // FAN)
    last = summaries.first()  # of at most ``most`` pre-tokens
    return [p for p, _ in sorted(zip(last["pieces"], last["counts"]), key=lambda x: (-x[1], x[0]))] if last else []


# ------------------------------------------------------------------ counting


class Counting:
    """Numbers of tokens by the frequent table first, then this worker's cache."""

    def __init__(self, data: dict, frequent: dict[str, int]):
        self.split = Splitter(data)
        merge = fast_merges(data)
        self.pieces = Tiers(frequent, Cache(lambda piece: len(merge(piece))))
        # units are written without their space: those that are one frequent pre-token
        alone = {p[1:]: n for p, n in frequent.items() if len(p) > 1 and p[0] == " " and self.split.pieces(p[1:]) == [p]}
        self.units = Tiers(alone, Cache(self.of_unit))

    def of_unit(self, unit: str) -> int | None:
        pieces = self.split.pieces(unit)
        return None if pieces is None else sum(map(self.pieces.__getitem__, pieces))

    def count(self, text: str | None) -> int:
        total = 0
        for part, special in self.split.segments(text or ""):
            total += sum(map(sum, self.split.map(part, self.pieces.__getitem__, self.units.__getitem__))) + (special is not None)
        return total


def count_tokens(docs: DataFrame, tokenizer_path: str, name: str = "n_tokens") -> DataFrame:
    """``docs`` with the number of tokens of ``text`` in column ``name`` (long)."""
    sc = docs.sparkSession.sparkContext
    data = load_tokenizer(tokenizer_path)
    tokenizer, merger = sc.broadcast(for_tasks(data)), Merger(data)
    frequent = sc.broadcast({p: len(merger.ids(p.encode())) for p in frequent_pretokens(docs, data)})
    run = uuid.uuid4().hex

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counting = remembered(("count", run), lambda: Counting(tokenizer.value, frequent.value))
        for texts in batches:
            yield pd.Series([counting.count(t) for t in texts], dtype="int64")

    return docs.withColumn(name, count.asNondeterministic()("text"))


# ------------------------------------------------------- the lexicon automaton


def compile_lexicon(words: dict[bytes, list[int]]) -> bytes:
    """A minimal acyclic automaton of ``words`` with their ids, as one file.

    Words are added in order; states left behind by the next word are final
    in shape and merged with an equal one (same acceptance, same arcs).  An
    arc carries how many words come before those beyond it, so that the sums
    along a word give its number.  The arc of a state for a byte is found at
    slot ``base[state] + byte``, where ``owner`` tells whose slot it is.
    Layout: eight 32-bit sizes, then the arrays base, accepts (by state),
    owner, target, before (by slot), where each word's ids begin, and ids.
    """
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []

    def settle(accepts: bool, arcs: list[tuple[int, int]]) -> int:
        shape = (accepts, tuple(arcs))
        if shape not in register:
            register[shape] = len(states)
            states.append(shape)
        return register[shape]

    path: list[list] = [[False, []]]  # states along the last word: acceptance, settled arcs
    last = b""
    ordered = sorted(words)
    for word in [*ordered, None]:
        keep = 0
        if word is not None:
            while keep < min(len(last), len(word)) and last[keep] == word[keep]:
                keep += 1
        while len(path) > keep + 1:
            done = path.pop()
            path[-1][1].append((last[len(path) - 1], settle(*done)))
        if word is not None:
            path += [[False, []] for _ in word[keep:]]
            path[-1][0] = True
            last = word
    root = settle(*path[0])
    count = [0] * len(states)  # arcs lead to states settled earlier
    for i, (accepts, arcs) in enumerate(states):
        count[i] = accepts + sum(count[to] for _, to in arcs)
    # each state's arcs lie behind those of the state before it
    base, slots = [0] * len(states), 256
    for i, (_, arcs) in enumerate(states):
        if arcs:
            base[i] = slots - arcs[0][0]
            slots += arcs[-1][0] - arcs[0][0] + 1
    slots += 256  # a look-up may reach past the last arc
    nobody = len(states)
    owner, target, before = array("I", [nobody]) * slots, array("I", [0]) * slots, array("I", [0]) * slots
    for i, (accepts, arcs) in enumerate(states):
        n = int(accepts)
        for label, to in arcs:
            owner[base[i] + label], target[base[i] + label], before[base[i] + label] = i, to, n
            n += count[to]
    begins, ids = array("I", [0]), array("I")
    for word in ordered:
        ids.extend(words[word])
        begins.append(len(ids))
    head = array("I", [len(states), slots, len(ordered), len(ids), root, 0, 0, 0])
    accepts = array("I", [int(a) for a, _ in states])
    return b"".join(a.tobytes() for a in (head, array("I", base), accepts, owner, target, before, begins, ids))


class Lexicon:
    """Looks words up in a compiled automaton (bytes or a memory map)."""

    def __init__(self, buffer):
        numbers = memoryview(buffer).cast("I")
        n_states, n_slots, n_words, n_ids, self.root = numbers[:5]
        parts, at = [], 8
        for size in (n_states, n_states, n_slots, n_slots, n_slots, n_words + 1, n_ids):
            parts.append(numbers[at : at + size])
            at += size
        self.base, self.accepts, self.owner, self.target, self.before, self.begins, self.ids = parts

    def get(self, word: bytes) -> bytes | None:
        """The ids of ``word`` as 32-bit numbers, or None."""
        base, owner, target, before = self.base, self.owner, self.target, self.before
        state, number = self.root, 0
        for byte in word:
            slot = base[state] + byte
            if owner[slot] != state:
                return None
            number += before[slot]
            state = target[slot]
        if not self.accepts[state]:
            return None
        return self.ids[self.begins[number] : self.begins[number + 1]].tobytes()


def share_file(spark: SparkSession, content: bytes, name: str) -> str:
    """Put ``content`` into the shared checkpoint folder and have Spark send it to every executor."""
    name = f"{name}-{uuid.uuid4().hex[:12]}"
    fs, path = hadoop_fs(spark, f"{scratch_path(spark, 'files')}/{name}")
    out = fs.create(path)
    out.write(bytearray(content))
    out.close()
    spark.sparkContext.addFile(fs.makeQualified(path).toString())
    return name


def text_encoder(data: dict) -> Callable[[str | None], np.ndarray]:
    """A function from a text to its ids (32-bit), for tasks that only pass over texts once.

    tiktoken cuts by the same pattern and merges exactly (see above); its ranks
    become ids by one look-up a text.  Special tokens and texts with unassigned
    characters are seen to here.
    """
    import tiktoken

    ranked, tokens, split = data["ranked"], data["tokens"], Splitter(data)
    ranks = {tokens[i]: rank for rank, i in enumerate(ranked)}
    encode = tiktoken.Encoding("texts", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_to_numpy
    table = np.array(ranked, np.uint32)
    merge = fast_merges(data)

    def ids(text: str | None) -> np.ndarray:
        out: list[np.ndarray] = []
        for part, special in split.segments(text or ""):
            if split.strange(part):
                out += [np.array(merge(piece), np.uint32) for piece in split.by_library(part)]
            elif part:
                out.append(table.take(encode(part, disallowed_special=())))
            if special is not None:
                out.append(np.array([special], np.uint32))
        return out[0] if len(out) == 1 else np.concatenate([np.zeros(0, np.uint32), *out])

    return ids


class Encoding:
    """Ids of texts: this worker's memory of units, then the lexicon, then exact merges."""

    def __init__(self, data: dict, lexicon: Lexicon | None):
        self.split, self.lexicon = Splitter(data), lexicon
        self.merge = fast_merges(data)
        self.by_unit = Cache(self.of_unit)
        self.tokens = data["tokens"]
        self.decimal = {i: str(i) for i in self.tokens}

    def of_unit(self, unit: str) -> bytes | None:
        pieces = self.split.pieces(unit)
        return None if pieces is None else b"".join(map(self.of_piece, pieces))

    def of_piece(self, piece: str) -> bytes:
        found = self.lexicon.get(piece.encode("utf-8")) if self.lexicon else None
        return array("I", self.merge(piece)).tobytes() if found is None else found

    def encode(self, text: str | None) -> bytes:
        """The ids of ``text`` as little-endian 32-bit numbers."""
        out: list[bytes] = []
        for part, special in self.split.segments(text or ""):
            for found in self.split.map(part, self.of_piece, self.by_unit.__getitem__):
                out += found
            if special is not None:
                out.append(struct.pack("<I", special))
        return b"".join(out)

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ``ids``; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.tokens.__getitem__, ids)).decode("utf-8", "replace")


def make_lexicon(docs: DataFrame, tokenizer: dict, merger: Merger) -> str:
    """Compile the frequent pre-tokens of ``docs``; the name of the file on the executors."""
    words = {w: merger.ids(w) for w in (p.encode("utf-8") for p in frequent_pretokens(docs, tokenizer))}
    return share_file(docs.sparkSession, compile_lexicon(words), "lexicon")


def worker_encoding(data: dict, file: str | None) -> Encoding:
    """This worker's encoder; the lexicon file is memory-mapped."""

    def make() -> Encoding:
        lexicon = None
        if file:
            with open(SparkFiles.get(file), "rb") as f:
                lexicon = Lexicon(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))
        return Encoding(data, lexicon)

    return remembered(("encode", data["key"], file), make)


def round_trip(docs: DataFrame, tokenizer_path: str, columns: list[str] | None = None) -> DataFrame:
    """``docs`` (or ``columns`` of it) with ``ids`` (array of int), ``n_tokens`` and ``decoded`` of ``text``."""
    return _with_encoding(docs, tokenizer_path, "ids array<int>, n_tokens long, decoded string", _whole, columns)


def encoded(docs: DataFrame, tokenizer_path: str, columns: list[str] | None = None) -> DataFrame:
    """``docs`` (or ``columns`` of it) with ``ids``, ``n_tokens`` and ``round_trips``: whether they decode to ``text`` again."""
    return _with_encoding(docs, tokenizer_path, "ids array<int>, n_tokens long, round_trips boolean", _checked, columns)


def round_trip_digests(docs: DataFrame, tokenizer_path: str, columns: list[str] | None = None) -> DataFrame:
    """``docs`` (or ``columns`` of it) with ``n_tokens`` and the sha256 of the decimal ids joined by commas and of the decoded text."""
    return _with_encoding(docs, tokenizer_path, "n_tokens long, ids_sha256 string, decoded_sha256 string", _digests, columns)


def _lists(ids: list[np.ndarray]) -> tuple[pa.Array, list[int]]:
    lengths = list(map(len, ids))
    flat = np.concatenate([np.zeros(0, np.uint32), *ids]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *lengths]), pa.int32()), pa.array(flat)), lengths


def _whole(encoding: Encoding, texts: list[str | None]) -> list[pa.Array]:
    ids = [np.frombuffer(encoding.encode(t), np.uint32) for t in texts]
    lists, lengths = _lists(ids)
    return [lists, pa.array(lengths, pa.int64()), pa.array([encoding.decode(x.tolist()) for x in ids], pa.string())]


def _checked(encoding: Encoding, texts: list[str | None]) -> list[pa.Array]:
    ids = [np.frombuffer(encoding.encode(t), np.uint32) for t in texts]
    lists, lengths = _lists(ids)
    same = [encoding.decode(x.tolist()) == (t or "") for x, t in zip(ids, texts)]
    return [lists, pa.array(lengths, pa.int64()), pa.array(same, pa.bool_())]


def _digests(encoding: Encoding, texts: list[str | None]) -> list[pa.Array]:
    rows = []
    for text in texts:
        ids = array("I", encoding.encode(text)).tolist()
        decimal = ",".join(map(encoding.decimal.__getitem__, ids)).encode()
        rows.append((len(ids), hashlib.sha256(decimal).hexdigest(), hashlib.sha256(encoding.decode(ids).encode("utf-8")).hexdigest()))
    n, ids_, decoded = zip(*rows) if rows else ((), (), ())
    return [pa.array(n, pa.int64()), pa.array(ids_, pa.string()), pa.array(decoded, pa.string())]


def _with_encoding(docs: DataFrame, tokenizer_path: str, fields: str, made: Callable, columns: list[str] | None) -> DataFrame:
    """``made`` turns an encoder and some texts into the columns ``fields``; few rows at a time leave a task's memory small."""
    data = load_tokenizer(tokenizer_path)  # the driver reads no copy of it from the broadcast
    tokenizer = docs.sparkSession.sparkContext.broadcast(for_tasks(data))
    file = make_lexicon(docs, data, Merger(data))
    del data
    new = StructType.fromDDL(fields)
    kept = [c for c in (docs.columns if columns is None else columns) if c.lower() not in {f.lower() for f in new.names}]
    (text,) = fresh(docs, "text_to_encode")
    given = docs.select(*kept, F.col("text").alias(text))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = worker_encoding(tokenizer.value, file)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                found = made(encoding, part.column(len(kept)).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], *found], names=[*kept, *new.names])
                del part, found
            trim()

    return given.mapInArrow(run, StructType([*given.schema.fields[: len(kept)], *new.fields]))
