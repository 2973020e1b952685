"""Operator 10: encode texts with a byte-pair vocabulary and decode them again.

White space ends a word, so the words of a text are encoded one by one, each
distinct one once as long as it is remembered. Long texts are cut into pieces that are
encoded in parallel, in any number of tasks: at white space, where a cut
changes nothing, and within a long run without white space anywhere. There the
encodings are put together as a tree: at each join a window around it is
encoded again and grown until the tokens at both of its ends are those that the
two sides had. Neighbouring tokens that an encoding has next to each other stay
valid next to each other, so the joined sequence is the encoding of the whole.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Callable, Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from tillstream.llm.tables import read_table
from tillstream.llm.tokencounts import lots

#: White space of the vocabulary's normalizer: Unicode's, without the four separators that Python adds.
SPACES = re.compile(r"[^\S\x1c-\x1f]+")
SEPARATORS = re.compile(r"[\x1c-\x1f]")
#: Fixed value: how the vocabulary splits text without white space.
PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
#: Below this letter no character is composed anew by normal form C, and classes and cases are the same in all Unicode
#: versions; words with others go to the library whole.
PLAIN = "\u0250"


def words_of(text: str) -> list[str]:
    if SEPARATORS.search(text):
        return [w for w in SPACES.split(text) if w]
    return text.split()


class Remembered:
    """Values by word in two generations of at most ``room`` each: the older one is dropped, what is in use stays."""

    def __init__(self, make: Callable[[str], tuple], room: int):
        self.make, self.room, self.new, self.old = make, room, {}, {}

    def add(self, word: str) -> tuple:
        value = self.old.get(word)
        if value is None:
            value = self.make(word)
        self.new[word] = value
        return value

    def trim(self) -> None:
        if len(self.new) > self.room:
            self.old, self.new = self.new, {}


class Codec:
    """A vocabulary file, whole and in parts. ``room`` bounds the words whose tokens are remembered."""

    def __init__(self, path: str, room: int = 80_000):
        self.path = path
        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.model = self.whole.model
        self.suffix = self.model.end_of_word_suffix or ""
        size = self.whole.get_vocab_size()
        self.tokens = [self.whole.id_to_token(i) or "" for i in range(size)]
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        #: What stands for each byte in the vocabulary's letters, for the bytes of a text read as Latin-1.
        self.bytes = {b: self.letter(b) for b in range(256)}
        self.known, self.parts = Remembered(self.word, room), Remembered(self.part_of_word, room // 2)

    def letter(self, byte: int) -> str:
        """Fixed rule of byte-level vocabularies: printable bytes stand for themselves, others for letters from U+0100 on."""
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        return chr(byte) if byte in printable else chr(0x100 + sum(b not in printable for b in range(byte)))

    @cached_property
    def inner(self):
        """The model without the ending of words, for parts that a word does not end with."""
        with open(self.path, encoding="utf-8") as file:
            data = json.load(file)
        data["model"]["end_of_word_suffix"] = None
        return Tokenizer.from_str(json.dumps(data)).model

    def entry(self, ids: list[int]) -> tuple[int, bytes, str]:
        return len(ids), array("I", ids).tobytes(), " ".join([self.tokens[i] for i in ids])

    def decoded(self, ids: list[int]) -> str:
        """As the library's decode does without a decoder: the tokens, set apart by spaces."""
        return " ".join([self.tokens[i] for i in ids])

    def word(self, word: str) -> tuple[int, bytes, str]:
        """(number of tokens, ids as little-endian uint32, decoded text) of text without white space.

        Words of plain letters are split here and their parts looked up: in
        "end," and "End" the part is the same. Others go to the library.
        """
        lower = word.lower()
        if max(lower) >= PLAIN or "<|" in word or SEPARATORS.search(word):
            return self.entry(self.whole.encode(word, add_special_tokens=False).ids)
        parts = self.parts.new
        found = [parts[part] if part in parts else self.parts.add(part) for part in PARTS.findall(lower)]
        if len(found) == 1:
            return found[0]
        counts, ids, decoded = zip(*found)
        return sum(counts), b"".join(ids), " ".join(decoded)

    def part_of_word(self, part: str) -> tuple[int, bytes, str]:
        letters = part if part.isascii() and part.isalnum() else part.encode().decode("latin-1").translate(self.bytes)
        return self.entry([t.id for t in self.model.tokenize(letters)])

    def texts(self, texts: list[str]) -> Iterator[tuple[int, bytes, str]]:
        """(number of tokens, ids as little-endian uint32, decoded text) of each text."""
        for text in texts:
            words = words_of(text)
            try:
                found = list(map(self.known.new.__getitem__, words))
            except KeyError:
                self.known.trim()
                self.parts.trim()
                for word in set(words).difference(self.known.new):
                    self.known.add(word)
                found = list(map(self.known.new.__getitem__, words))
            if found:
                counts, ids, decoded = zip(*found)
                yield sum(counts), b"".join(ids), " ".join(filter(None, decoded) if 0 in counts else decoded)
            else:
                yield 0, b"", ""

    def part(self, text: str, ends: bool) -> list[int]:
        """The tokens of a part of a word, given in the vocabulary's letters; ``ends`` if the word ends with it."""
        return [t.id for t in (self.model if ends else self.inner).tokenize(text)]

    def letters(self, ids: list[int]) -> str:
        return "".join([self.tokens[i].removesuffix(self.suffix) if self.suffix else self.tokens[i] for i in ids])

    def join(self, left: list[int], right: list[int], ends: bool, window: int = 4) -> list[int]:
        """The tokens of a word from those of its two parts; ``ends`` if the word ends with the right one."""
        while True:
            a, b = max(0, len(left) - window), min(len(right), window)
            found = self.part(self.letters(left[a:] + right[:b]), ends and b == len(right))
            agree_left = a == 0 or found[0] == left[a]
            agree_right = b == len(right) or found[-1] == right[b - 1]
            if agree_left and agree_right:
                return left[:a] + found + right[b:]
            window *= 2

    def tree(self, parts: list[list[int]], ends: bool) -> list[int]:
        """The tokens of a word from those of its parts, joined in pairs."""
        if len(parts) == 1:
            return parts[0]
        half = len(parts) // 2
        return self.join(self.tree(parts[:half], False), self.tree(parts[half:], ends), ends)

    def cut(self, text: str, size: int) -> Iterator[tuple[str, bool, bool]]:
        """(piece, starts, ends) in order: ``ends`` closes a run of pieces that make up one word. Pieces of a long word
        are in the vocabulary's letters and have ``starts`` or not; others both start and end, as plain text."""
        held: list[str] = []
        length = 0
        for word in words_of(text):
            if length + len(word) > size and held:
                yield "t" + " ".join(held), True, True
                held, length = [], 0
            if len(word) <= size:
                held.append(word)
                length += len(word) + 1
                continue
            for run in re.split("(" + "|".join(map(re.escape, self.special)) + ")", word) if self.special else [word]:
                if run in self.special:
                    yield "t" + run, True, True
                elif run:
                    for letters, _ in self.whole.pre_tokenizer.pre_tokenize_str(self.whole.normalizer.normalize_str(run)):
                        for i in range(0, len(letters), size):
                            yield "p" + letters[i : i + size], i == 0, i + size >= len(letters)
        if held:
            yield "t" + " ".join(held), True, True


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


FIELDS = [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
TEXTS = [("ids", pa.list_(pa.int32())), ("decoded", pa.string())]


def record(rows: list[tuple[int, bytes, str]], texts: bool) -> dict[str, pa.Array]:
    """The result's columns for (number of tokens, ids, decoded text)."""
    columns = {
        "n_tokens": pa.array([n for n, _, _ in rows], pa.int64()),
        "ids_sha256": pa.array([hashlib.sha256(ids).hexdigest() for _, ids, _ in rows], pa.string()),
        "decoded_sha256": pa.array([hashlib.sha256(text.encode()).hexdigest() for _, _, text in rows], pa.string()),
    }
    if texts:
        columns["ids"] = pa.array([np.frombuffer(ids, "<i4") for _, ids, _ in rows], pa.list_(pa.int32()))
        columns["decoded"] = pa.array([text for _, _, text in rows], pa.string())
    return columns


def encode(
    docs: DataFrame,
    vocabulary: str | None = None,
    texts: bool = True,
    long_text: int = 1 << 15,
    piece: int = 1 << 13,
    lot_bytes: int = 1 << 22,
) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), and (ids, decoded) if ``texts``, one row per row of ``docs``.

    The ids are those that the tokenizers library gives for the whole text
    without adding special tokens, and the decoded text is the library's too.
    A null text counts as empty: no tokens, and the empty text. Texts above
    ``long_text`` characters are cut into pieces of at most ``piece``; equal
    long texts are encoded once. ``vocabulary`` is the path of a tokenizer file
    that every executor can read; it must be a byte-level one that drops white
    space and ends words by a suffix. Repeated rows are answered one by one;
    other columns are not read; an empty table gives an empty result.
    """
    path = vocabulary or public_tokenizers.path("word_bpe_49k.json")
    ddl = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * texts
    rows = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    is_long = F.coalesce(F.length("text") > long_text, F.lit(False))

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for first, lot in lots(batch.column(1), lot_bytes):
                columns = record(list(own.texts([t.decode() for t in lot])), texts)
                ids = batch.column(0).slice(first, len(lot))
                yield pa.RecordBatch.from_arrays([ids, *columns.values()], ["doc_id", *columns])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                pieces = list(own.cut(text.as_py(), piece))
                names = ["key", "number", "piece", "starts", "ends"]
                columns = list(zip(*pieces)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([key.as_py()] * len(pieces), pa.binary()),
                        pa.array(range(len(pieces)), pa.int32()),
                        pa.array(columns[0], pa.string()),
                        pa.array(columns[1], pa.bool_()),
                        pa.array(columns[2], pa.bool_()),
                    ],
                    names,
                )

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            found = []
            for text, ends in zip(batch.column(2).to_pylist(), batch.column(4).to_pylist()):
                if text[0] == "t":
                    found.append(next(own.texts([text[1:]]))[1])
                else:
                    found.append(np.array(own.part(text[1:], ends), "<u4").tobytes())
            columns = [batch.column(0), batch.column(1), pa.array(found, pa.binary()), batch.column(3), batch.column(4)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "number", "ids", "starts", "ends"])

    def joined(group: pa.Table) -> pa.Table:
        own = codec(path)
        ids: list[int] = []
        parts: list[list[int]] = []
        for row in group.sort_by("number").to_pylist():
            parts.append(np.frombuffer(row["ids"], "<u4").tolist())
            if row["ends"]:
                ids += own.tree(parts, True)
                parts = []
        columns = record([(len(ids), np.array(ids, "<u4").tobytes(), own.decoded(ids))], texts)
        return pa.table({"key": group.column("key").slice(0, 1), **columns})

    key = F.unhex(F.sha2("text", 256))
    long_rows = rows.where(is_long).select("doc_id", key.alias("key"), "text")
    pieces = (
        long_rows.groupBy("key")
        .agg(F.any_value("text").alias("text"))
        .mapInArrow(cut, "key binary, number int, piece string, starts boolean, ends boolean")
        .repartition("key", "number")
        .mapInArrow(encoded, "key binary, number int, ids binary, starts boolean, ends boolean")
        .groupBy("key")
        .applyInArrow(joined, f"key binary, {ddl}")
    )
    # A long text of white space has no pieces.
    blank = record([(0, b"", "")], texts)
    names = list(blank)
    filled: list[Column] = [F.coalesce(c, F.lit(blank[c][0].as_py()) if c != "ids" else F.array().cast("array<int>")).alias(c) for c in names]
    answered = long_rows.select("doc_id", "key").join(pieces, "key", "left").select("doc_id", *filled)
    return rows.where(~is_long).mapInArrow(short, f"doc_id long, {ddl}").union(answered)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(read_table(spark, sf_dir, "documents"), texts=False)


QUERIES = {"op10_bpe": op10_bpe}
