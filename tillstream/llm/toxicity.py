"""Operator 9: toxicity by multiple-instance learning.

A document is a bag of sentences and toxic if one of them is. Each sentence has
a score from its words; the document's score is their noisy-or, so the model is
trained from document labels alone and still says which sentences offend.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillstream.llm.tables import kept, read_table
from tillstream.llm.tokencounts import lots

SENTENCE = re.compile(r"[.!?\n]+")
LETTERS = re.compile(r"[^\W_]+")


def features(word: str, size: int) -> list[int]:
    """Hashed features of a piece of text without white space: its runs of letters and digits, and their beginnings."""
    found = []
    for run in LETTERS.findall(word.lower()):
        names = [f"w{run}", *(f"p{run[:n]}" for n in (3, 4, 5, 6) if len(run) >= n)]
        found += [zlib.crc32(name.encode()) % size for name in names]
    return found


@dataclass
class Model:
    """Weights of the hashed features and of a sentence as such. Its size is fixed, whatever the training set."""

    weights: np.ndarray
    bias: float


class Weights(dict):
    """Word -> weight, with at most ``room`` words remembered."""

    def __init__(self, model: Model, room: int = 100_000):
        super().__init__()
        self.model, self.room = model, room

    def __missing__(self, word: str) -> float:
        if len(self) > self.room:
            self.clear()
        own = features(word, len(self.model.weights))
        value = float(self.model.weights[own].sum()) if own else 0.0
        self[word] = value
        return value


def noisy_or(logits: np.ndarray) -> np.ndarray | float:
    """1 - product of (1 - p) for the sentences' logits."""
    return -np.expm1(-np.logaddexp(0.0, logits).sum())


def fit(texts: Iterable[str], labels: list[int], size: int = 1 << 18, rounds: int = 80, rare: int = 8, decay: float = 2e-4) -> Model:
    """Gradient descent on the noisy-or likelihood of document labels.

    Features of fewer than ``rare`` documents keep the weight 0. Without a
    toxic and a clean document the model says 0 for all.
    """
    model = Model(np.zeros(size), -30.0)
    y = np.array(labels, float)
    if not len(y) or y.min() == y.max():
        return model
    numbers: defaultdict[str, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    tokens, lengths, bags, distinct = array("i"), array("i"), array("i"), array("i")
    for d, text in enumerate(texts):
        begin = len(tokens)
        for sentence in SENTENCE.split(text):
            if own := sentence.split():
                tokens.extend(map(numbers.__getitem__, own))
                lengths.append(len(own))
                bags.append(d)
        distinct.extend(set(tokens[begin:]))
    if not tokens:
        return model
    words, doc_of = np.frombuffer(tokens, np.int32), np.frombuffer(bags, np.int32)
    in_sentence = np.frombuffer(lengths, np.int32)
    starts = np.cumsum(in_sentence) - in_sentence
    docs_of_word = np.bincount(np.frombuffer(distinct, np.int32), minlength=len(numbers))
    # Sentences in lots: a gradient over all tokens at once would take several times the memory of the tokens.
    lots_ = [*range(0, len(bags), 20_000), len(bags)]
    hashed, counts = array("i"), array("i")
    for word in numbers:
        own = features(word, size)
        hashed.extend(own)
        counts.append(len(own))
    flat = np.frombuffer(hashed, np.int32)
    word_of = np.repeat(np.arange(len(counts), dtype=np.int32), np.frombuffer(counts, np.int32))
    # The documents of a feature's words, added up: it is at least the number of the feature's documents.
    seen = np.bincount(flat, weights=docs_of_word[word_of], minlength=size)
    common = seen >= rare
    use = common[flat]
    flat, word_of = flat[use], word_of[use]
    w, bias = np.zeros(size), -6.0
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, rounds + 1):
        value = np.bincount(word_of, weights=w[flat], minlength=len(numbers))
        logits = bias + np.add.reduceat(value.astype(np.float32)[words], starts).astype(float)
        total = np.bincount(doc_of, weights=np.logaddexp(0.0, logits), minlength=len(y))
        # d(-log likelihood)/d total: 1 for clean documents, -1 / (e^total - 1) for toxic ones.
        slope = np.where(y > 0, -1 / np.expm1(np.clip(total, 1e-6, 50)), 1.0)
        push = slope[doc_of] * np.exp(-np.logaddexp(0.0, -logits))
        by_word = np.zeros(len(numbers))
        for a, b in zip(lots_, lots_[1:]):
            part = words[starts[a] : starts[b] if b < len(starts) else None]
            by_word += np.bincount(part, weights=np.repeat(push[a:b], in_sentence[a:b]), minlength=len(numbers))
        gradient = np.bincount(flat, weights=by_word[word_of], minlength=size) / len(y) + decay * w
        gradient = np.append(gradient, push.sum() / len(y))
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        move = 0.1 * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        w, bias = w - move[:-1] * common, bias - float(move[-1])
    return Model(w, bias)


def is_held_out(doc_id, folds: int = 4, fold: int = 2):
    """Whether the crc32 of the id as text leaves ``fold``; false for null."""
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string")) % folds == fold, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, most: int = 8_000, folds: int = 4, fold: int = 2) -> Model:
    """Fits the model on labelled documents outside the held-out fold.

    At most ``most`` label rows are used, those of the least hash of the id, so
    the sample is the same in every run and the driver gets a bounded number of
    texts. Null labels, ids and texts are left out; repeated labels of one id
    count once, its largest one.
    """
    known = labels.selectExpr("cast(doc_id as long) doc_id", "cast(toxic as int) toxic").where(
        F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~is_held_out(F.col("doc_id"), folds, fold)
    )
    texts = docs.selectExpr("cast(doc_id as long) doc_id", "text").where("doc_id is not null and text is not null")
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    present = known.join(texts.select("doc_id"), "doc_id", "left_semi")
    chosen = kept(present.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most), "sample")
    rows = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("toxic").alias("toxic"))
    sample = rows.orderBy("doc_id").toArrow()
    return fit((text.as_py() for text in sample.column("text")), sample.column("toxic").to_pylist())


def scores(texts: list[bytes], weights: Weights) -> list[float]:
    """The noisy-or of each text's sentences; 0 without one."""
    get, bias, found = weights.__getitem__, weights.model.bias, []
    for text in texts:
        logits = [sum(map(get, words)) for s in SENTENCE.split(text.decode()) if (words := s.split())]
        found.append(float(noisy_or(np.array(logits) + bias)) if logits else 0.0)
    return found


def score(docs: DataFrame, model: Model, threshold: float = 0.3, offends: float = 0.5, folds: int = 4, fold: int = 2, lot_bytes: int = 1 << 22) -> DataFrame:
    """(doc_id, held_out, score, predicted, offending), one row per row of ``docs``.

    ``predicted`` is 1 from ``threshold`` on. ``offending`` lists (begin, end,
    score) of the sentences of at least ``offends``, in code points. Null and
    empty texts have no sentence and score 0. Repeated rows are answered one by
    one; columns other than doc_id and text are not read; an empty table gives
    an empty result. A document with a null id is not held out.
    """
    small = Model(model.weights.astype(np.float32), model.bias)

    def spans(text: str, weights: Weights) -> list[tuple[int, int, float]]:
        found, begin = [], 0
        for end in [*(m.start() for m in SENTENCE.finditer(text)), len(text)]:
            words = text[begin:end].strip(".!?\n").split()
            logit = small.bias + sum(map(weights.__getitem__, words))
            p = 1 / (1 + np.exp(-logit))
            if words and p >= offends:
                found.append({"begin": begin + len(text[begin:end]) - len(text[begin:end].lstrip(".!?\n \t")), "end": end, "score": float(p)})
            begin = end
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = Weights(small)
        for batch in batches:
            values, offending = [], []
            for _, lot in lots(batch.column(1), lot_bytes):
                found = scores(lot, weights)
                values += found
                offending += [spans(t.decode(), weights) if v >= threshold else [] for t, v in zip(lot, found)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(values, pa.float64()), pa.array(offending, SPANS)],
                ["doc_id", "score", "offending"],
            )

    ddl = "doc_id long, score double, offending array<struct<begin:long,end:long,score:double>>"
    scored = docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, ddl)
    return scored.select(
        "doc_id",
        is_held_out(F.col("doc_id"), folds, fold).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "offending",
    )


SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))


def clean(docs: DataFrame, model: Model, threshold: float = 0.3, lot_bytes: int = 1 << 22) -> DataFrame:
    """The rows of ``docs``, with all columns, whose score is below ``threshold``; texts are not shuffled."""
    small = Model(model.weights.astype(np.float32), model.bias)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = Weights(small)
        for batch in batches:
            good = [s < threshold for _, lot in lots(batch.column(at), lot_bytes) for s in scores(lot, weights)]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return score(docs, train(docs, read_table(spark, sf_dir, "labels"))).drop("offending")


QUERIES = {"op9_toxicity": op9_toxicity}
