"""Operator 4: score texts with a smoothed n-gram model as a weighted backoff automaton.

Counting. Documents are gathered into blocks of bounded size. A block numbers
its words, and asks for the counts of its distinct n-grams of every size up to
the model's order by 64-bit hashes; what it asks for carries what its training
documents add. The requests are dealt out by ranges of the hash, each range is
summed up, and the totals go back to the blocks that asked. So no task and no
executor ever holds the model, and a word that stands in every text costs one
entry a block.

Scoring. From the totals a block compiles the part of the automaton it can
reach. States are the contexts of up to order - 1 words that the training text
has, and the root. An arc (state, word) is a seen n-gram, has its smoothed
log-probability and leads to the longest state that ends the words read so far.
A state without an arc for a word has a failure arc to the context without its
first word, with the backoff weight; the root has an arc for every word. One
pass from left to right carries the state, follows arcs and failure arcs and
adds up. Long texts are passed in stretches side by side, each of which reads
the order - 1 words before it first, since no state is longer.

The smoothing is the Dirichlet prior, order by order: with c the counts, h a
context and h' the same without its first word, P(w|h) = (c(h,w) + m P(w|h')) /
(c(h) + m), so that a seen arc has log10 of that, and the backoff weight of h is
m / (c(h) + m).
"""

from __future__ import annotations

import math
import zlib
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd  # noqa: F401  (Spark's Arrow functions need it on the executors)
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillstream.llm.packing import mixed, squeeze, squeeze_sorted, stretch as stretch_ints, stretch_sorted
from tillstream.llm.tables import kept, read_table

#: No word has a space in it, so these are the tokens for a text's end and its beginning.
END, START = xxhash.xxh64_intdigest(b" end"), xxhash.xxh64_intdigest(b" start")


class Block:
    """Documents whose tokens are numbers; numbers stand in the order of the words' hashes."""

    def __init__(self) -> None:
        self.numbers: defaultdict[bytes, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.ids: list[int | None] = []
        self.held: list[bool] = []
        self.tokens: list[np.ndarray] = []
        self.bytes = 0

    def add(self, doc_id: int | None, held: bool, text: bytes) -> None:
        words = text.lower().split()
        self.ids.append(doc_id)
        self.held.append(held)
        self.tokens.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
        self.bytes += len(text) + 64

    def record(self, name: int) -> pa.RecordBatch:
        hashes = np.array([xxhash.xxh64_intdigest(w) for w in self.numbers] + [END], np.uint64)
        order = np.argsort(hashes, kind="stable")
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        lengths = np.array([len(t) + 1 for t in self.tokens], np.int32)
        ends = np.cumsum(lengths) - 1
        stream = np.full(int(lengths.sum()), place[-1], np.int32)
        inside = np.ones(len(stream), bool)
        inside[ends] = False
        stream[inside] = place[np.concatenate(self.tokens)]
        train = int(lengths[~np.array(self.held, bool)].sum())
        columns = [
            pa.array([name], pa.int64()),
            pa.array([self.ids], pa.list_(pa.int64())),
            pa.array([self.held], pa.list_(pa.bool_())),
            pa.array([lengths], pa.list_(pa.int32())),
            pa.array([squeeze(stream)], pa.binary()),
            pa.array([squeeze_sorted(hashes[order])], pa.binary()),
            pa.array([train], pa.int64()),
            pa.array([len(self.held) - sum(self.held)], pa.int64()),
            pa.array([len(stream)], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in BLOCK.split(", ")])


BLOCK = (
    "block long, ids array<long>, held array<boolean>, lengths array<int>, stream binary, hashes binary, "
    "train_tokens long, train_docs long, tokens long"
)


def blocked(docs: DataFrame, folds: int, held_fold: int, block_bytes: int) -> DataFrame:
    """The documents as blocks of about ``block_bytes``; a longer text is a block of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, made, block = TaskContext.get().partitionId() << 32, 0, Block()
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())
            for i, doc_id in enumerate(ids):
                held = doc_id is not None and zlib.crc32(str(doc_id).encode()) % folds == held_fold
                block.add(doc_id, held, texts[i].as_py() or b"")
                if block.bytes >= block_bytes:
                    yield block.record(first + made)
                    made, block = made + 1, Block()
        if block.ids:
            yield block.record(first + made)

    return kept(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, BLOCK), "blocks")


class Grams(NamedTuple):
    """The distinct n-grams of one size in a block; ``codes`` are sorted."""

    codes: np.ndarray  #: number of the first words (their n-gram's) * number of words + last word
    keys: np.ndarray
    number: np.ndarray  #: for each token the n-gram that ends there, or -1


def ngrams(hashes: np.ndarray, stream: np.ndarray, lengths: np.ndarray, order: int) -> list[Grams]:
    """The n-grams of sizes 1 to ``order``. The number of words stands for the beginning of a text, which is the first
    word of an n-gram or none of it."""
    n = len(hashes)
    inside = (np.arange(len(stream)) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(np.int32)
    found = [Grams(np.arange(n), hashes, stream)]
    left, number = np.append(hashes, np.uint64(START)), stream
    for size in range(2, order + 1):
        there = np.flatnonzero(inside >= size - 2)
        before = number[there - 1].astype(np.int64)
        if size == 2:
            before[inside == 0] = n
        before *= n
        before += stream[there]
        codes, index = np.unique(before, return_inverse=True)
        del before
        left = mixed(mixed(left[codes // n]) + np.uint64(0x9E3779B97F4A7C15) * hashes[codes % n])
        number = np.full(len(stream), -1, np.int32)
        number[there] = index
        del index
        found.append(Grams(codes, left, number))
    return found


def ranges(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The range of hashes that each key lies in; ranges stand in the order of the keys."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def requests(blocks: DataFrame, buckets: int, order: int) -> DataFrame:
    """Each block's distinct keys by range, with what its training documents add. The kind is the n-grams' size."""
    names = ["bucket", "kind", "block", "keys", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                hashes, stream = stretch_sorted(row["hashes"]), stretch_ints(row["stream"], "<i4")
                lengths = np.array(row["lengths"], np.int64)
                train = np.repeat(~np.array(row["held"], bool), lengths)
                out: dict[str, list] = {c: [] for c in names}
                for kind, grams in enumerate(ngrams(hashes, stream, lengths, order), 1):
                    counts = np.bincount(grams.number[train & (grams.number >= 0)], minlength=len(grams.keys))
                    if not len(counts):
                        continue
                    place = np.argsort(grams.keys, kind="stable")
                    own, counts = grams.keys[place], counts[place]
                    spots = ranges(own, buckets)
                    edges = np.flatnonzero(np.diff(spots)) + 1
                    for a, b in zip([0, *edges], [*edges, len(own)]):
                        values = (int(spots[a]), kind, row["block"], squeeze_sorted(own[a:b]), squeeze(counts[a:b].astype("<u4")))
                        for c, v in zip(names, values):
                            out[c].append(v)
                yield pa.RecordBatch.from_pydict(out, pa.schema(REQUEST))

    ddl = "bucket int, kind int, block long, keys binary, counts binary"
    return blocks.select("block", "held", "lengths", "stream", "hashes").mapInArrow(run, ddl)


REQUEST = [("bucket", pa.int32()), ("kind", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())]


def answers(asked: DataFrame) -> DataFrame:
    """For each request the totals of its keys over all blocks, in their order; and by range, as block -1, how many
    keys have a total above 0."""

    def run(group: pa.Table) -> pa.Table:
        keys = [stretch_sorted(k) for k in group.column("keys").to_pylist()]
        counts = [stretch_ints(c, "<u4") for c in group.column("counts").to_pylist()]
        _, index = np.unique(np.concatenate(keys), return_inverse=True)
        totals = np.bincount(index, weights=np.concatenate(counts)).astype(np.int64)
        parts = np.split(totals[index], np.cumsum([len(k) for k in keys])[:-1])
        n = len(parts)
        bucket, kind = group.column("bucket")[0].as_py(), group.column("kind")[0].as_py()
        return pa.table(
            {
                "block": pa.array([*group.column("block").to_pylist(), -1], pa.int64()),
                "kind": pa.array([kind] * (n + 1), pa.int32()),
                "bucket": pa.array([bucket] * (n + 1), pa.int32()),
                "totals": pa.array([*(squeeze(p) for p in parts), None], pa.binary()),
                "distinct": pa.array([*[0] * n, int((totals > 0).sum())], pa.int64()),
            }
        )

    return kept(
        asked.groupBy("bucket", "kind").applyInArrow(
            run, "block long, kind int, bucket int, totals binary, distinct long"
        ),
        "totals",
    )


class Automaton:
    """The part of the model that a block's texts can reach."""

    def __init__(self, grams: list[Grams], counts: list[np.ndarray], base: np.ndarray, starts: int, prior: float):
        self.words, self.base, self.order = len(base), base, len(grams)
        self.arcs = [g.codes for g in grams]
        self.seen = [c > 0 for c in counts]
        # A word's context, the beginning of a text as the last of them, then contexts of two words and so on; 0 is the root.
        contexts = [np.append(counts[0], starts), *counts[1:-1]] if self.order > 1 else []
        self.first = np.cumsum([1, *(len(c) for c in contexts)])
        total = np.concatenate([[0], *contexts])
        self.exists = total > 0
        self.backoff = np.log10(prior / (total + prior))
        self.failure = np.zeros(len(total), np.int32)
        self.weights, self.targets = [base], [self.state(1, np.arange(self.words))]
        chance = 10.0**base
        for size in range(2, self.order + 1):
            own, shorter = grams[size - 1], grams[size - 2]
            there = own.number >= 0
            suffix = np.zeros(len(own.codes), np.int32)
            suffix[own.number[there]] = shorter.number[there]
            total = contexts[size - 2][own.codes // self.words]
            chance = (counts[size - 1] + prior * chance[suffix]) / (total + prior)
            with np.errstate(divide="ignore"):
                self.weights.append(np.log10(chance))
            if size < self.order:
                self.failure[self.first[size - 1] : self.first[size]] = self.state(size - 1, suffix)
                self.targets.append(self.state(size, np.arange(len(suffix))))
            else:
                self.targets.append(self.state(size - 1, suffix))

    def state(self, size: int, number: np.ndarray) -> np.ndarray:
        """The states of n-grams, the root where the training text lacks one or states are shorter."""
        if size >= self.order:
            return np.zeros(len(number), np.int32)
        states = (number + self.first[size - 1]).astype(np.int32)
        states[~self.exists[states]] = 0
        return states

    def step(self, states: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next states and what is added on the way."""
        states, weights, after = states.astype(np.int64), np.zeros(len(states)), np.zeros(len(states), np.int64)
        open_ = np.ones(len(states), bool)
        for size in range(self.order, 1, -1):
            at = np.flatnonzero(open_ & (states >= self.first[size - 2]))
            if not len(at):
                continue
            codes = (states[at] - self.first[size - 2]) * self.words + words[at]
            arc = np.minimum(np.searchsorted(self.arcs[size - 1], codes), len(self.arcs[size - 1]) - 1)
            hit = (self.arcs[size - 1][arc] == codes) & self.seen[size - 1][arc]
            taken, missed = at[hit], at[~hit]
            weights[taken] += self.weights[size - 1][arc[hit]]
            after[taken] = self.targets[size - 1][arc[hit]]
            open_[taken] = False
            weights[missed] += self.backoff[states[missed]]
            states[missed] = self.failure[states[missed]]
        weights[open_] += self.base[words[open_]]
        after[open_] = self.targets[0][words[open_]]
        return after, weights

    def traverse(self, stream: np.ndarray, lengths: np.ndarray, stretch: int) -> np.ndarray:
        """What each token adds; ``stretch`` tokens of a text at most are read one after the other."""
        parts = -(-lengths // stretch)
        text_begins = np.repeat(np.cumsum(lengths) - lengths, parts)
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        begins = text_begins + nth * stretch
        ends = np.minimum(begins + stretch, text_begins + np.repeat(lengths, parts))
        warm = np.maximum(begins - (self.order - 1), text_begins)
        longest = np.argsort(warm - ends, kind="stable")
        begins, ends, warm, nth = begins[longest], ends[longest], warm[longest], nth[longest]
        start = self.state(1, np.array([self.words]))[0]
        # Only a text's first tokens are read from its beginning; a stretch that warms up there is in the same state.
        states = np.where(warm == text_begins[longest], start, 0)
        path = np.zeros(len(stream))
        sizes = ends - warm
        for t in range(int(sizes[0])):
            active = int(np.searchsorted(-sizes, -t, "left"))
            at = warm[:active] + t
            states, weights = self.step(states[:active], stream[at])
            counted = at >= begins[:active]
            path[at[counted]] = weights[counted]
        return path


def score(
    docs: DataFrame,
    folds: int = 10,
    held_fold: int = 0,
    order: int = 3,
    prior: float = 5.0,
    block_bytes: int = 12 << 20,
    bucket_tokens: int = 1 << 21,
    stretch: int = 256,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per row of ``docs``.

    Documents whose crc32 of the doc_id as text leaves ``held_fold`` modulo
    ``folds`` are held out of the counts; a null doc_id is not. A null text
    counts as empty: its only token is the end. Repeated rows count each time.
    base_score is the add-0.1 unigram log10 probability; score that of the
    automaton of ``order`` (1 and more), with ``prior`` for all orders. Without any training document all counts are 0 and both
    scores are 0. An empty table gives an empty result. Other columns are not read.
    """
    blocks = blocked(docs, folds, held_fold, block_bytes)
    sums = blocks.agg(F.sum("train_tokens"), F.sum("train_docs"), F.sum("tokens")).first()
    train_tokens, train_docs, tokens = (int(x or 0) for x in sums)
    totals = answers(requests(blocks, max(1, -(-tokens // bucket_tokens)), order))
    distinct = totals.where("block = -1 and kind = 1").agg(F.sum("distinct")).first()[0] or 0
    below = train_tokens + 0.1 * (distinct + 1)

    def run(key: tuple, block: pa.Table, got: pa.Table) -> pa.Table:
        row = block.to_pylist()[0]
        asked: dict[int, dict[int, np.ndarray]] = {kind: {} for kind in range(1, order + 1)}
        for answer in got.to_pylist():
            asked[answer["kind"]][answer["bucket"]] = stretch_ints(answer["totals"], "<i8")
        hashes, stream = stretch_sorted(row["hashes"]), stretch_ints(row["stream"], "<i4")
        lengths = np.array(row["lengths"], np.int64)
        grams, counts = ngrams(hashes, stream, lengths, order), []
        for kind, own in enumerate(grams, 1):
            in_order = np.zeros(len(own.keys), np.int64)
            parts = asked.pop(kind)
            if len(in_order):
                in_order[np.argsort(own.keys, kind="stable")] = np.concatenate([parts[b] for b in sorted(parts)])
            counts.append(in_order)
            grams[kind - 1] = own._replace(keys=own.keys[:0].copy())
        words = counts[0]
        base = np.log10((words + 0.1) / below)
        path = Automaton(grams, counts, base, train_docs, prior).traverse(stream, lengths, stretch)
        begins = np.cumsum(lengths) - lengths
        return pa.table(
            {
                "doc_id": pa.array(row["ids"], pa.int64()),
                "held_out": pa.array(row["held"], pa.bool_()),
                "n_tokens": pa.array(lengths, pa.int64()),
                "n_known": pa.array(np.add.reduceat((words[stream] > 0).astype(np.int64), begins)),
                "train_tokens": pa.array(np.full(len(lengths), train_tokens, np.int64)),
                "base_score": pa.array(np.add.reduceat(base[stream], begins)),
                "score": pa.array(np.add.reduceat(path, begins)),
            }
        )

    return (
        blocks.select("block", "ids", "held", "lengths", "stream", "hashes")
        .groupBy("block")
        .cogroup(totals.where("block >= 0").select("block", "kind", "bucket", "totals").groupBy("block"))
        .applyInArrow(
            run,
            "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
        )
    )


def perplexity(log10: float, tokens: int) -> float:
    return math.pow(10.0, -log10 / tokens)


def op4_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(read_table(spark, sf_dir, "documents"))


QUERIES = {"op4_lm": op4_lm}
