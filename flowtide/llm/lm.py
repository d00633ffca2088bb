"""LM scoring: an interpolated modified Kneser-Ney bigram model of a whole corpus.

Counting runs in Spark. Each task adds up what it has read before anything is shuffled, so the most
frequent word costs one entry a task. Words are numbered by the order of their hashes; pairs are
shuffled by ranges of their first word, so every shard is a piece of one sorted array. The model is
a folder of such arrays (``arrays``), which scoring workers map into memory; nothing of it passes
through the driver but sums.

A text's tokens are its words and one end. The first word follows a start. The model gives

    p(w | c) = (max(n(c,w) - D, 0) + (D1 N1(c) + D2 N2(c) + D3 N3(c)) p(w)) / n(c)
    p(w)     = (max(N(.,w) - D', 0) + (D1' N1' + D2' N2' + D3' N3') / (V + 1)) / T

with p(w) alone after a context never seen, and V + 1 for the one unknown word.

Null text is an empty text: one end token. Texts are scored whole at any length. Repeated rows are
scored each. Without training rows every token is unknown and has probability 1.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtide.llm import arrays, common, tokens
from flowtide.llm.kneser_ney import discounts

PART = 2 << 20
HELD = 1 << 21
WORD = np.dtype([("count", "<u8"), ("contexts", "<u8")])
CONTEXT = np.dtype([("first", "<u8"), ("ones", "<u4"), ("twos", "<u4")])


@dataclass(frozen=True)
class Model:
    folder: str
    bits: int  # of a word's hash that name its shard
    first_id: tuple[int, ...]  # of each shard of words, and one past the last
    n_tokens: int
    n_texts: int
    n_pairs: int
    pair_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    word_rest: float  # what the discounts leave for all words

    @property
    def n_words(self) -> int:
        return self.first_id[-1]


def fit(texts: DataFrame, text: str = "text", shards: int | None = None) -> Model:
    """Count the column ``text`` of all rows. ``shards`` is rounded up to a power of two."""
    spark = texts.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = max(1, (shards - 1).bit_length())
    folder = common.new_path(spark, "lm")
    texts = texts.select(F.col(text).alias("text"))

    counted = texts.mapInArrow(_word_counts(bits), "shard int, block binary")
    sums = counted.groupBy("shard").applyInPandas(
        _sum_words(folder), "shard int, words long, tokens long"
    ).collect()  # a row for each shard
    words = {r.shard: r.words for r in sums}
    for shard in range(1 << bits):
        if shard not in words:
            arrays.save(f"{folder}/hashes-{shard}", np.zeros(0, "<u8"))
            arrays.save(f"{folder}/words-{shard}", np.zeros(0, WORD))
    first_id = (0, *np.cumsum([words.get(s, 0) for s in range(1 << bits)]).tolist())
    if first_id[-1] >= 2**32 - 2:
        raise ValueError("more than 2^32 different words: lower-case or split the texts further")

    counted = texts.mapInArrow(_pair_counts(folder, bits, first_id), "shard int, block binary")
    reduced = common.store(counted.groupBy("shard").applyInPandas(
        _sum_pairs(folder, bits, first_id), "shard int, block binary, texts long, " + _COUNTS
    ), "lm-pairs")
    pairs = reduced.agg(*[F.sum(c).alias(c) for c in ("texts", "n1", "n2", "n3", "n4", "n")]).first()
    found = reduced.filter("block is not null").groupBy("shard").applyInPandas(
        _sum_contexts(folder, first_id), _COUNTS
    ).agg(*[F.sum(c).alias(c) for c in ("n1", "n2", "n3", "n4", "n", "over")]).first()
    pair_counts = [pairs[f"n{i}"] or 0 for i in range(1, 5)]
    word_counts = [found[f"n{i}"] or 0 for i in range(1, 5)]
    d = discounts(word_counts)
    return Model(
        folder, bits, first_id, sum(r.tokens for r in sums), pairs["texts"] or 0, found["n"] or 0,
        discounts(pair_counts), d,
        d[0] * word_counts[0] + d[1] * word_counts[1] + d[2] * (found["over"] or 0),
    )


_COUNTS = "n1 long, n2 long, n3 long, n4 long, n long, over long"


def _counts(n: np.ndarray) -> list[int]:
    few = np.bincount(np.minimum(n, 5).astype(np.int64), minlength=6).tolist()
    return [*few[1:5], int(n.sum()), sum(few[3:])]


class _Adder:
    """Sums of counts by key, kept sorted; what is not added up yet stays within ``HELD`` entries."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, keys: np.ndarray, n: np.ndarray | None = None) -> None:
        if n is None:
            keys, n = np.unique(keys, return_counts=True)
        self.parts.append((keys, n.astype(np.uint32)))
        self.waiting += len(keys)

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        keys, n = sum_by_key(*(np.concatenate(x) for x in zip(*self.parts, strict=True))) if self.parts else (
            np.zeros(0, np.uint64), np.zeros(0, np.uint64))
        self.parts, self.waiting = [], 0
        return keys, n


def sum_by_key(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return keys, n.astype(np.uint64)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(n[order].astype(np.uint64), first)


def _rows(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    shard, block = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), pa.array(block, pa.binary())], ["shard", "block"])


def _counted(batches: Iterator[pa.RecordBatch], keys_of: Callable, pack: Callable) -> Iterator[pa.RecordBatch]:
    """Count keys over the whole task, passing sums on whenever ``HELD`` of them have gathered."""
    adder = _Adder()

    def passed_on() -> Iterator[pa.RecordBatch]:
        rows = list(pack(*adder.take()))
        for i in range(0, len(rows), 16):
            yield _rows(rows[i : i + 16])

    for batch in batches:
        for _, _, data, offsets in common.utf8_parts(batch.column(0), PART):
            adder.add(keys_of(*tokens.sentences(data, offsets)))
            if adder.waiting > HELD:
                keys, n = adder.take()
                if len(keys) > HELD // 2:
                    adder.parts = [(keys, n)]
                    yield from passed_on()
                else:
                    adder.parts, adder.waiting = [(keys, n)], len(keys)
    yield from passed_on()


def _word_counts(bits: int) -> Callable:
    def pack(keys: np.ndarray, n: np.ndarray) -> Iterator[tuple[int, bytes]]:
        cuts = np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
        for shard, (a, b) in enumerate(zip(cuts, [*cuts[1:], len(keys)], strict=True)):
            if a < b:
                yield shard, np.int64(b - a).tobytes() + keys[a:b].tobytes() + n[a:b].astype("<u4").tobytes()

    return lambda batches: _counted(batches, lambda h, places: h, pack)


def _unpack_words(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    k = int(np.frombuffer(block, np.int64, 1)[0])
    return np.frombuffer(block, "<u8", k, 8), np.frombuffer(block, "<u4", k, 8 + 8 * k)


def _sum_words(folder: str) -> Callable:
    def reduce(group: pd.DataFrame) -> pd.DataFrame:
        shard = int(group["shard"].iloc[0])
        keys, n = sum_by_key(*(np.concatenate(x) for x in zip(*map(_unpack_words, group["block"]), strict=True)))
        facts = np.zeros(len(keys), WORD)
        facts["count"] = n
        arrays.save(f"{folder}/hashes-{shard}", keys)
        arrays.save(f"{folder}/words-{shard}", facts)
        return pd.DataFrame({"shard": [shard], "words": [len(keys)], "tokens": [int(n.sum())]})

    return reduce


class Vocabulary:
    """Numbers of words by hash, from memory-mapped shards of sorted hashes."""

    def __init__(self, folder: str, bits: int, first_id: tuple[int, ...]) -> None:
        self.bits, self.first_id = bits, first_id
        self.hashes = [arrays.load(f"{folder}/hashes-{s}", "<u8") for s in range(1 << bits)]
        self.starts = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """For sorted hashes; -1 for unknown words."""
        out = np.full(len(hashes), -1, np.int64)
        cuts = np.searchsorted(hashes, self.starts).tolist()
        for shard, (a, b) in enumerate(zip(cuts, [*cuts[1:], len(hashes)], strict=True)):
            known = self.hashes[shard]
            if a < b and len(known):
                at = np.minimum(np.searchsorted(known, hashes[a:b]), len(known) - 1)
                out[a:b] = np.where(known[at] == hashes[a:b], at + self.first_id[shard], -1)
        return out


@cache
def _vocabulary(folder: str, bits: int, first_id: tuple[int, ...]) -> Vocabulary:
    return Vocabulary(folder, bits, first_id)


def _before(ids: np.ndarray, places: np.ndarray, start: int) -> np.ndarray:
    """Each token's context."""
    out = np.empty_like(ids)
    out[1:] = ids[:-1]
    out[places[:-1]] = start
    return out


def _range_starts(bits: int, n: int) -> np.ndarray:
    """First context of each shard of pairs; contexts are all words and, as number ``n``, the start."""
    return np.array([-(-s * (n + 1) >> bits) for s in range(1 << bits)] + [n + 1], np.int64)


def _pair_counts(folder: str, bits: int, first_id: tuple[int, ...]) -> Callable:
    def keys_of(h: np.ndarray, places: np.ndarray) -> np.ndarray:
        unique, inverse = np.unique(h, return_inverse=True)
        ids = _vocabulary(folder, bits, first_id).ids(unique)[inverse]
        return _before(ids, places, first_id[-1]).astype(np.uint64) << np.uint64(32) | ids.astype(np.uint64)

    def pack(keys: np.ndarray, n: np.ndarray) -> Iterator[tuple[int, bytes]]:
        cuts = np.searchsorted(keys, _range_starts(bits, first_id[-1]).astype(np.uint64) << np.uint64(32))
        for shard, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if a < b:
                first, times = np.unique(keys[a:b] >> np.uint64(32), return_counts=True)
                yield shard, b"".join((
                    np.array([len(first), b - a], "<i8").tobytes(), first.astype("<u4").tobytes(), times.astype("<u4").tobytes(),
                    keys[a:b].astype("<u4").tobytes(), n[a:b].astype("<u4").tobytes(),
                ))

    return lambda batches: _counted(batches, keys_of, pack)


def _unpack_pairs(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    k, m = np.frombuffer(block, "<i8", 2).tolist()
    first = np.repeat(np.frombuffer(block, "<u4", k, 16), np.frombuffer(block, "<u4", k, 16 + 4 * k))
    second = np.frombuffer(block, "<u4", m, 16 + 8 * k)
    return first.astype(np.uint64) << np.uint64(32) | second, np.frombuffer(block, "<u4", m, 16 + 8 * k + 4 * m)


def _sum_pairs(folder: str, bits: int, first_id: tuple[int, ...]) -> Callable:
    def reduce(group: pd.DataFrame) -> pd.DataFrame:
        shard = int(group["shard"].iloc[0])
        keys, n = sum_by_key(*(np.concatenate(x) for x in zip(*map(_unpack_pairs, group["block"]), strict=True)))
        low, high = _range_starts(bits, first_id[-1])[shard : shard + 2].tolist()
        context = (keys >> np.uint64(32)).astype(np.int64) - low
        facts = np.zeros(high - low + 1, CONTEXT)
        facts["first"] = np.searchsorted(context, np.arange(high - low + 1))
        facts["ones"][: high - low] = np.bincount(context[n == 1], minlength=high - low)
        facts["twos"][: high - low] = np.bincount(context[n == 2], minlength=high - low)
        arrays.save(f"{folder}/contexts-{shard}", facts)
        second = keys & np.uint64(0xFFFFFFFF)
        arrays.save(f"{folder}/pairs-{shard}", second << np.uint64(32) | np.minimum(n, 0xFFFFFFFF))
        texts = int(n[context == first_id[-1] - low].sum())
        rows = [(None, None, texts, *_counts(n))]
        word, contexts = np.unique(second, return_counts=True)
        cuts = np.searchsorted(word, np.array(first_id, np.uint64))
        for s, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if a < b:
                rows.append((s, np.int64(b - a).tobytes() + word[a:b].tobytes() + contexts[a:b].astype("<u4").tobytes(), *[0] * 7))
        out = pd.DataFrame(rows, columns=["shard", "block", "texts", "n1", "n2", "n3", "n4", "n", "over"])
        return out.astype({"shard": "Int32"})

    return reduce


def _sum_contexts(folder: str, first_id: tuple[int, ...]) -> Callable:
    def reduce(group: pd.DataFrame) -> pd.DataFrame:
        shard = int(group["shard"].iloc[0])
        word, n = sum_by_key(*(np.concatenate(x) for x in zip(*map(_unpack_words, group["block"]), strict=True)))
        facts = arrays.load(f"{folder}/words-{shard}", WORD).copy()
        facts["contexts"][word.astype(np.int64) - first_id[shard]] = n
        arrays.save(f"{folder}/facts-{shard}", facts)
        return pd.DataFrame([_counts(n)], columns=["n1", "n2", "n3", "n4", "n", "over"])

    return reduce


class Reader:
    """A fitted model, memory-mapped."""

    def __init__(self, model: Model) -> None:
        self.model = m = model
        self.words = _vocabulary(m.folder, m.bits, m.first_id)
        self.ranges = _range_starts(m.bits, m.n_words)
        sizes = np.diff(m.first_id)
        self.facts = [arrays.load(f"{m.folder}/facts-{s}", WORD) if sizes[s] else np.zeros(0, WORD) for s in range(1 << m.bits)]
        self.shards: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.held = np.array([0.0, *m.pair_discounts])
        self.word_held = np.array([0.0, *m.word_discounts])

    def shard(self, s: int) -> tuple[np.ndarray, np.ndarray]:
        if s not in self.shards:
            folder = self.model.folder
            try:
                self.shards[s] = arrays.load(f"{folder}/contexts-{s}", CONTEXT), arrays.load(f"{folder}/pairs-{s}", "<u8")
            except FileNotFoundError:  # no pair begins with a word of this range
                size = int(self.ranges[s + 1] - self.ranges[s])
                self.shards[s] = np.zeros(size + 1, CONTEXT), np.zeros(0, "<u8")
        return self.shards[s]

    def word_facts(self, ids: np.ndarray) -> np.ndarray:
        """For sorted ids, all known."""
        out = np.zeros(len(ids), WORD)
        cuts = np.searchsorted(ids, self.model.first_id)
        for s in np.flatnonzero(np.diff(cuts)):
            a, b = cuts[s], cuts[s + 1]
            out[a:b] = self.facts[s][ids[a:b] - self.model.first_id[s]]
        return out

    def pair_facts(self, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count of each pair, and what the discounts leave to its context; sorted by context."""
        n, rest = np.zeros(len(first), np.uint64), np.zeros(len(first))
        d1, d2, d3 = self.model.pair_discounts
        cuts = np.searchsorted(first, self.ranges)
        for s in np.flatnonzero(np.diff(cuts)):
            part = slice(cuts[s], cuts[s + 1])
            contexts, pairs = self.shard(s)
            at = first[part] - self.ranges[s]
            facts, after = contexts[at], contexts["first"][at + 1].astype(np.int64)
            low, high = facts["first"].astype(np.int64), after.copy()
            more = after - low - facts["ones"] - facts["twos"]
            rest[part] = d1 * facts["ones"] + d2 * facts["twos"] + d3 * more
            if not len(pairs):
                continue
            wanted = second[part].astype(np.uint64)
            active = np.flatnonzero(low < high)
            while len(active):
                mid = (low[active] + high[active]) >> 1
                less = (pairs[mid] >> np.uint64(32)) < wanted[active]
                low[active] = np.where(less, mid + 1, low[active])
                high[active] = np.where(less, high[active], mid)
                active = active[low[active] < high[active]]
            found = pairs[np.minimum(low, len(pairs) - 1)]
            n[part] = np.where((low < after) & (found >> np.uint64(32) == wanted), found & np.uint64(0xFFFFFFFF), 0)
        return n, rest

    def score(self, data: np.ndarray, offsets: np.ndarray, finite: bool = False) -> dict[str, np.ndarray]:
        m = self.model
        h, places = tokens.sentences(data, offsets)
        unique, inverse = np.unique(h, return_inverse=True)
        ids = self.words.ids(unique)
        known = ids >= 0
        facts = np.zeros(len(unique), WORD)
        facts[known] = self.word_facts(ids[known])
        base = np.log10((facts["count"] + 0.1) / (m.n_tokens + 0.1 * (m.n_words + 1)))
        if m.n_pairs:
            held = self.word_held[np.minimum(facts["contexts"], 3).astype(np.int64)]
            alone = (np.maximum(facts["contexts"] - held, 0.0) + m.word_rest / (m.n_words + 1)) / m.n_pairs
        else:
            alone = np.ones(len(unique))
        ids = np.where(known, ids, m.n_words + 1)[inverse]
        before = _before(ids, places, m.n_words)
        # The counts of contexts as tokens are their totals; the start's total is the number of texts.
        total = facts["count"].astype(np.float64)[_before(inverse.astype(np.int64), places, 0)]
        total[places[:-1]] = m.n_texts
        keys, where = np.unique(before.astype(np.uint64) << np.uint64(32) | ids.astype(np.uint64), return_inverse=True)
        first, second = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
        usable = first <= m.n_words
        n, rest = np.zeros(len(keys), np.uint64), np.zeros(len(keys))
        n[usable], rest[usable] = self.pair_facts(first[usable], second[usable])
        above = n - self.held[np.minimum(n, 3).astype(np.int64)]
        p = alone[inverse]
        seen = total > 0
        p[seen] = (above[where][seen] + rest[where][seen] * p[seen]) / total[seen]
        if finite:
            p = np.where(p > 0, p, alone[inverse])
        at = places[:-1]
        return {
            "n_tokens": np.diff(places), "n_known": np.add.reduceat(known[inverse].astype(np.int64), at),
            "base_score": np.add.reduceat(base[inverse], at), "score": np.add.reduceat(np.log10(p), at),
        }


@cache
def _reader(model: Model) -> Reader:
    return Reader(model)


SCORED = "n_tokens long, n_known long, base_score double, score double"


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None, finite: bool = False) -> DataFrame:
    """Columns ``keep`` (all but the text by default), the numbers of tokens and of known tokens, and
    the log10 probability of the text by the smoothed unigram base and by the model. With ``finite`` a word that a context's
    discounts leave no probability has that of the word alone."""
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    kept = docs.select(F.col(text).alias("text"), *[F.col(c) for c in keep])
    schema = T.StructType([*kept.schema.fields[1:], *T._parse_datatype_string(SCORED).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in common.utf8_parts(batch.column(0), PART):
                found = _reader(model).score(data, offsets, finite)
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(a, b - a) for c in batch.columns[1:]), *map(pa.array, found.values())], schema.names
                )

    return kept.mapInArrow(run, schema)
