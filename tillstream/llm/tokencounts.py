"""Operator 6: count tokens by dynamic programming over a trie.

A word's tokens are the segmentation into vocabulary pieces of the largest
log-probability under a unigram model. The distinct words of a bounded lot of
texts are walked in sorted order, which is the depth-first order of their trie:
the forward scores of a prefix are computed once for all the words that share
it, and each word's end stores its count. The words' counts then sum up to the
texts' counts, without a shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame, SparkSession

from tillstream.llm.tables import read_table

#: Fixed value: stands for the space before a word in the vocabulary's pieces.
SPACE = "▁"


@lru_cache(maxsize=2)
def pieces(path: str) -> dict[str, float]:
    """Log-probability of each piece: the vocabulary is in the order of frequency, so Zipf's law gives it by rank."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    norm = math.log(sum(1 / (rank + 2.7) for rank in range(size)))
    plain = (i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    return {model.id_to_piece(i): -math.log(rank + 2.7) - norm for rank, i in enumerate(plain)}


class Trie:
    """Forward scores along the path from the root to the last word."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.longest = max(map(len, scores), default=1)
        #: A byte of a character that no piece covers is a token of its own, less likely than any piece.
        self.byte = min(scores.values(), default=0.0) - 10.0
        self.path, self.forward = "", [(0.0, 0)]

    def count(self, word: str) -> int:
        """Tokens of the word. Cheapest if words come in sorted order. Equal scores go to fewer tokens."""
        forward, path = self.forward, self.path
        shared, most = 0, min(len(path), len(word))
        while shared < most and path[shared] == word[shared]:
            shared += 1
        del forward[shared + 1 :]
        get, longest = self.scores.get, self.longest
        for end in range(shared + 1, len(word) + 1):
            score, tokens = forward[end - 1]
            width = len(word[end - 1].encode())
            best, least = score + width * self.byte, tokens + width
            for begin in range(max(0, end - longest), end):
                own = get(word[begin:end])
                if own is not None:
                    score, tokens = forward[begin]
                    score += own
                    if score > best or score == best and tokens + 1 < least:
                        best, least = score, tokens + 1
            forward.append((best, least))
        self.path = word
        return forward[-1][1]


class Counts(dict):
    """Token counts of the words met, at most ``room`` of them."""

    def __init__(self, path: str, room: int = 100_000):
        super().__init__()
        self.trie, self.room = Trie(pieces(path)), room

    def of_texts(self, texts: list[bytes]) -> list[tuple[int, int]]:
        """(words, tokens) of each text of a lot."""
        lists = [text.split() for text in texts]
        new = sorted({w for words in lists for w in words}.difference(self))
        if len(self) > self.room:
            self.clear()
            new = sorted({w for words in lists for w in words})
        for word in new:
            self[word] = self.trie.count(SPACE + word.decode())
        self.trie.count("")  # a very long last word would keep its path
        return [(len(words), sum(map(self.__getitem__, words))) for words in lists]


def lots(column: pa.Array, size: int) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) of successive rows with about ``size`` bytes together; null is empty."""
    first, texts, held = 0, [], 0
    for i, text in enumerate(column.cast(pa.binary())):
        texts.append(text.as_py() or b"")
        held += len(texts[-1])
        if held >= size:
            yield first, texts
            first, texts, held = i + 1, [], 0
    if texts:
        yield first, texts


def token_counts(docs: DataFrame, model: str | None = None, lot_bytes: int = 1 << 22) -> DataFrame:
    """(doc_id, n_words, n_tokens), one row per row of ``docs``.

    Words are runs of `[^\\x20\\x09-\\x0D]`, each with the vocabulary's space
    mark before it. A null text counts as empty, with no tokens. A character
    that no piece covers costs one token per UTF-8 byte. ``model`` is the path
    of a piece vocabulary that every executor can read. Memory is bounded by
    ``lot_bytes`` of texts, or one text, and a bounded table of words. Repeated
    rows are counted one by one; other columns are not read; an empty table
    gives an empty result.
    """
    path = model or public_tokenizers.path("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts(path)
        for batch in batches:
            found = [pair for _, texts in lots(batch.column(1), lot_bytes) for pair in counts.of_texts(texts)]
            words, tokens = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())],
                ["doc_id", "n_words", "n_tokens"],
            )

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(
        run, "doc_id long, n_words long, n_tokens long"
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read_table(spark, sf_dir, "documents"))


QUERIES = {"op6_token_counts": op6_token_counts}
