"""Operator 12: phrases whose words stand together more often than apart.

Every n-gram has a Rabin-Karp fingerprint, taken by differences from a
polynomial over all words before it. One size after the other is counted: an
n-gram takes part only if all shorter ones in it are frequent, which a filter of
fingerprints of bounded size tells without a false no. Within a stretch of text,
the places of one fingerprint are compared word by word and the phrase is read at
one of them; a shuffle adds up the counts by the text of the phrase. So a
fingerprint that two phrases share can only bring a phrase too many into a count,
never a wrong number out of it, and no phrase is counted twice over.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tillstream.llm.packing import mixed
from tillstream.llm.tables import kept, read_table

#: Bytes of text that are worked on at once.
CHUNK = 1 << 20
#: Bytes of a batch whose languages are told apart at once.
PART = 8 << 20
#: Words of the longest phrase.
LONGEST = 4
#: The filter has 16 bits for each fingerprint, and this many at most: beyond, it lets more through.
MOST_BITS = 1 << 29
SLICE_BITS = 17

WORD, SPACE, END = 0, 1, 2
KIND = np.zeros(256, np.uint8)
KIND[list(b" \t")] = SPACE
KIND[list(b".,;:!?\n\x0b\x0c\r")] = END
#: A-Z in lower case, and one kind of space.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
FOLD[9] = 32

#: Masks for the first 0 to 8 bytes of a number that was read from text.
FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)

#: An odd number and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """The first n powers of ``base`` modulo 2**64; as many as the longest stretch needed are kept."""
    if n > len(_POWERS.get(base, ())):
        out = np.full(max(n + n // 4, CHUNK), base, np.uint64)
        out[0] = 1
        _POWERS[base] = np.cumprod(out, dtype=np.uint64)
    return _POWERS[base][:n]


def polynomials(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of ``values[begin:end]``, each from two places of one running polynomial."""
    running = np.zeros(len(values) + 1, np.uint64)
    np.multiply(values, powers(BASE, len(values)), out=running[1:], dtype=np.uint64)
    np.cumsum(running, out=running)
    shifted = (running[end] - running[begin]) * powers(INVERSE, len(values) + 1)[begin]
    return mixed(shifted + (end - begin).astype(np.uint64))


class Words:
    """The words of a stretch of text. The first ``own`` of them are counted here, the others only end a phrase."""

    def __init__(self, data: np.ndarray, own: int, lang: str = ""):
        self.salt = np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))
        self.text = FOLD[data]
        kind = KIND[data]
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = kind == WORD
        edges = np.flatnonzero(np.diff(inside))
        self.begin, self.end = edges[0::2], edges[1::2]
        self.piece = np.searchsorted(np.flatnonzero(kind == END), self.begin)
        self.own = int(np.searchsorted(self.begin, own))
        self.codes = polynomials(self.text, self.begin, self.end)

    def together(self, size: int) -> np.ndarray:
        """For each own word: do ``size`` words of one piece begin there?"""
        last = np.arange(self.own) + size - 1
        fits = last < len(self.begin)
        last = np.minimum(last, max(len(self.begin) - 1, 0))
        return fits & (self.piece[last] == self.piece[: self.own])

    def prints(self, size: int) -> np.ndarray:
        """The fingerprints of the ``size`` words that begin at each word, by size and language; zeros at the end, where
        they are not so many."""
        if size == 1:
            return mixed(self.codes ^ self.salt)
        out = np.zeros(len(self.codes), np.uint64)
        at = np.arange(max(len(self.codes) - size + 1, 0))
        out[: len(at)] = mixed(polynomials(self.codes, at, at + size) ^ self.salt)
        return out

    @functools.cached_property
    def eights(self) -> np.ndarray:
        """The eight bytes from each place on, as one number."""
        padded = np.append(self.text, np.zeros(8, np.uint8))
        return np.lib.stride_tricks.as_strided(padded[:8].view(np.uint64), (len(padded) - 7,), (1,))

    def alike(self, a: np.ndarray, b: np.ndarray) -> bool:
        """Are all words ``a`` equal to the words ``b``, byte by byte?"""
        size, x, y = self.end[a] - self.begin[a], self.begin[a], self.begin[b]
        if (size != self.end[b] - y).any():
            return False
        while len(size):
            if ((self.eights[x] ^ self.eights[y]) & FIRST[np.minimum(size, 8)]).any():
                return False
            more = size > 8
            size, x, y = size[more] - 8, x[more] + 8, y[more] + 8
        return True

    def groups(self, at: np.ndarray, size: int, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, counts): one place for each distinct phrase of ``size`` words that begins at one of ``at``.

        The words of one fingerprint are compared; if any differ, the phrases are told apart by their words.
        """
        _, first, same, counts = np.unique(prints[at], return_index=True, return_inverse=True, return_counts=True)
        giver = at[first][same]
        if all(self.alike(at + k, giver + k) for k in range(size)):
            return at[first], counts
        numbers: dict[bytes, int] = {}
        own = np.array([numbers.setdefault(x, len(numbers)) for x in self.phrases(at, size)])
        _, first, counts = np.unique(own, return_index=True, return_counts=True)
        return at[first], counts

    def phrases(self, at: np.ndarray, size: int) -> list[bytes]:
        """The phrases that begin at some words, with one space between their words."""
        blob = self.text.tobytes()
        found = [blob[b:e] for b, e in zip(self.begin[at].tolist(), self.end[at + size - 1].tolist())]
        return [b" ".join(x.split()) if b"  " in x else x for x in found] if size > 1 else found


def stretches(data: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(begin, own, end) of stretches of about CHUNK bytes, cut between pieces.

    A piece that is much longer is cut between words; the stretch then goes on
    past ``own``, by as many words as a phrase that begins before it may need.
    """
    ends, n, begin = np.flatnonzero(KIND[data] == END), len(data), 0
    while begin < n:
        if n - begin <= CHUNK:
            yield begin, n, n
            return
        k = int(np.searchsorted(ends, begin + CHUNK))
        cut = int(ends[k]) if k < len(ends) else n
        if cut - begin <= 2 * CHUNK:
            yield begin, cut, cut
            begin = cut
            continue
        own, end, spaces = 0, begin + CHUNK, 0
        # To the next space, and three words further; several spaces in a row make the stretch no shorter than that.
        while end < n and spaces < LONGEST:
            if KIND[data[end]] != WORD and KIND[data[end - 1]] == WORD:
                spaces += 1
                own = own or end
            end += 1
        own = own or end
        yield begin, own, end
        begin = own


def parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows of about PART bytes, so that what is made of a batch is not as large as the batch again."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    begin = 0
    while begin < len(ends):
        end = max(int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + PART, "right")), begin + 1)
        yield batch.slice(begin, end - begin)
        begin = end


def by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Words]]:
    """The words of (lang, text) rows; texts of one language and part of a batch are worked on together."""
    for batch in (part for whole in batches for part in parts(whole)):
        langs, texts = batch.column(0).dictionary_encode(), batch.column(1).cast(pa.large_binary())
        for number, lang in enumerate(langs.dictionary.to_pylist()):
            mine = pc.equal(langs.indices, number)
            ended = pc.binary_join_element_wise(texts.filter(mine), *[pa.scalar(x, pa.large_binary()) for x in (b"", b"\n")])
            offsets = np.frombuffer(ended.buffers()[1], np.int64)[ended.offset : ended.offset + len(ended) + 1]
            data = np.frombuffer(ended.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
            for begin, own, end in stretches(data):
                yield lang, Words(data[begin:end], own - begin, lang)


class Filter:
    """Tells which fingerprints may be in a set: never no for one that is."""

    def __init__(self, prints: DataFrame):
        """``prints`` has the distinct numbers in its column ``fp``. Only the filter's bits reach the driver."""
        bits = 16
        while 1 << bits < min(16 * prints.count(), MOST_BITS):
            bits += 1
        self.bits = bits

        def sliced(group: pa.Table) -> pa.Table:
            part = np.zeros(1 << SLICE_BITS, np.uint8)
            part[group.column("spot").to_numpy() & ((1 << SLICE_BITS) - 1)] = 1
            return pa.table({"part": [group.column("part")[0].as_py()], "data": [np.packbits(part).tobytes()]})

        fp = F.col("fp")
        spots = F.explode(F.array(F.shiftrightunsigned(fp, 64 - bits), fp.bitwiseAND(F.lit((1 << bits) - 1))))
        rows = prints.select(spots.alias("spot")).select("spot", F.shiftright("spot", SLICE_BITS).alias("part")).distinct()
        self.data = np.zeros(max(1 << bits, 1 << SLICE_BITS) // 8, np.uint8)
        width = (1 << SLICE_BITS) // 8
        for row in rows.groupBy("part").applyInArrow(sliced, "part long, data binary").collect():
            self.data[row.part * width : (row.part + 1) * width] = np.frombuffer(row.data, np.uint8)

    def may_have(self, prints: np.ndarray) -> np.ndarray:
        found = np.ones(len(prints), bool)
        for spot in (prints >> np.uint64(64 - self.bits), prints & np.uint64((1 << self.bits) - 1)):
            spot = spot.astype(np.int64)
            found &= (self.data[spot >> 3] >> (7 - (spot & 7)).astype(np.uint8) & 1).astype(bool)
        return found


def possible(words: Words, filters: dict[int, Filter], size: int, prints: np.ndarray | None = None) -> np.ndarray:
    """For each own word: may a frequent phrase of ``size`` words begin there, by the longest filtered phrases in it?"""
    known = max((s for s in filters if s <= size), default=0)
    good = words.together(size)
    if known:
        own = words.prints(known) if known < size or prints is None else prints
        passed = np.append(filters[known].may_have(own), np.zeros(size, bool))
        for k in range(size - known + 1):
            good &= passed[k : k + len(good)]
    return good


def counted(docs: DataFrame, sizes: tuple[int, ...], filters: dict[int, Filter], least: int) -> DataFrame:
    """(lang, phrase, f): the phrases of some sizes that stand ``least`` times or more in the texts of a lang, of those in
    which all shorter ones may be frequent. With size 1, an empty phrase has the number of all words of a lang."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words in by_language(batches):
            found, counts = [b""] if 1 in sizes else [], [[words.own]] if 1 in sizes else []
            for size in sizes:
                prints = words.prints(size)
                at, times = words.groups(np.flatnonzero(possible(words, filters, size)), size, prints)
                found += words.phrases(at, size)
                counts.append(times)
            text = pa.array(found, pa.binary()).cast(pa.string())
            f = pa.array(np.concatenate(counts).astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.repeat(lang, len(found)), text, f], ["lang", "phrase", "f"])

    found = docs.mapInArrow(read, "lang string, phrase string, f long")
    # Most phrases stand in one stretch only: sums before the shuffle would fill a task's memory and spare few rows.
    sums = found.repartition("lang", "phrase").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    return kept(sums.where((F.col("f") >= least) | (F.col("phrase") == "")), "phrases")


def filtered(phrases: DataFrame, size: int) -> Filter:
    """A filter of the fingerprints of phrases, all of ``size`` words."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, words in by_language(batches):
            prints = words.prints(size)[: words.own][words.together(size)]
            yield pa.RecordBatch.from_arrays([pa.array(prints.view(np.int64))], ["fp"])

    return Filter(kept(phrases.select("lang", "phrase").mapInArrow(hashed, "fp long"), "prints"))


def frequent(docs: DataFrame, least: int = 30) -> DataFrame:
    """(lang, size, phrase, f): all phrases of one to four words that stand ``least`` times or more in the texts of a
    lang; size 0 has the number of all its words. ``docs`` has lang and text, neither null."""
    docs = docs.select("lang", "text")
    ones = counted(docs, (1,), {}, least)
    filters = {1: filtered(ones, 1)}
    twos = counted(docs, (2,), filters, least)
    filters[2] = filtered(twos, 2)
    more = counted(docs, (3, 4), filters, least)
    size = F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " ")))
    return ones.unionByName(twos).unionByName(more).select("lang", size.alias("size"), "phrase", "f")


def _joined(words: Column, begin: Column, size: Column) -> Column:
    return F.array_join(F.slice(words, begin, size), " ")


def collocations(docs: DataFrame, least: int = 30, covered: int = 80, most: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``most`` best phrases of two to four words of each lang.

    Texts have A-Z in lower case; `[.,;:!?\\x0A-\\x0D]` end a piece, spaces and
    tabs a word. a is how often the phrase stands within pieces, ``least`` or
    more; l and r are the same of its two parts by the cut with the smallest
    score, the first of equal ones; score is floor(2000000 * a / (l + r)), by whole
    numbers of any size. A phrase is left out if its words stand within a longer
    frequent one with 100 * f >= ``covered`` * a, whether that one stays or not.
    n is the number of all words of the lang. Order: score, a, both descending,
    phrase.

    A null lang counts as ``und``, a null text as empty; rows without an id or
    with the same one are all counted. A lang without frequent phrases has no
    row, and an empty table gives an empty result. Columns other than lang and
    text are not read. Texts of any length are cut between pieces or, in a piece
    beyond some megabytes, between words with the next three words looked at.
    """
    docs = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    counted = frequent(docs, least)
    phrases, total = counted.where("size > 0"), counted.where("size = 0").select("lang", F.col("f").alias("n"))
    words = F.split("phrase", " ")
    cuts = phrases.where("size > 1").select(
        "lang", "phrase", "size", F.col("f").alias("a"), words.alias("words"),
        F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"),
    )
    cuts = cuts.select(
        "lang", "phrase", "a", "k",
        _joined(F.col("words"), F.lit(1), F.col("k")).alias("first"),
        _joined(F.col("words"), F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"),
    )
    counts = phrases.where(F.col("size") < LONGEST)
    left = counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    score = F.expr("(cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    scored = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).withColumn("score", score)
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    inner = phrases.where("size > 2").withColumn("words", words)
    inner = inner.select("lang", "f", "size", "words", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("part"))
    inner = inner.withColumn("begin", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("part") + 1)))
    inner = inner.select("lang", "f", _joined(F.col("words"), F.col("begin"), F.col("part")).alias("phrase"))
    within = inner.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    wide = "decimal(20,0)"
    is_part = F.col("longer").cast(wide) * 100 >= F.col("a").cast(wide) * covered
    own = best.join(within, ["lang", "phrase"], "left").where(F.col("longer").isNull() | ~is_part)
    rows = own.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    top = rows.withColumn("rank", place.cast("long")).where(F.col("rank") <= most)
    return top.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents"))


QUERIES = {"op12_phrases": op12_phrases}

ORACLE = {
    "op12_phrases": r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(
               translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), worded AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM pieces
), total AS (
    SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM worded GROUP BY lang
), places AS (
    SELECT lang, words, s.size AS size, unnest(range(1, len(words) - s.size + 2)) AS b
    FROM worded, (SELECT unnest(range(1, 5)) AS size) s WHERE len(words) >= s.size
), phrases AS (
    SELECT lang, words[b : b + size - 1] AS words, size, count(*) AS f FROM places GROUP BY ALL HAVING count(*) >= 30
), cuts AS (
    SELECT p.lang, p.words, p.f AS a, p.k, l.f AS l, r.f AS r,
           (2000000 * CAST(p.f AS HUGEINT)) // (CAST(l.f AS HUGEINT) + r.f) AS score
    FROM (SELECT *, unnest(range(1, size)) AS k FROM phrases WHERE size > 1) p
    JOIN phrases l ON l.lang = p.lang AND l.words = p.words[1 : p.k]
    JOIN phrases r ON r.lang = p.lang AND r.words = p.words[p.k + 1 : p.size]
), best AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1
), inner_ AS (
    SELECT lang, words[b : b + part - 1] AS words, max(f) AS f
    FROM (SELECT *, unnest(range(1, size - part + 2)) AS b
          FROM (SELECT *, unnest(range(2, size)) AS part FROM phrases WHERE size > 2))
    GROUP BY 1, 2
), own AS (
    SELECT b.*, array_to_string(b.words, ' ') AS phrase
    FROM best b LEFT JOIN inner_ i ON i.lang = b.lang AND i.words = b.words
    WHERE i.f IS NULL OR 100 * i.f < 80 * b.a
)
SELECT o.lang, row_number() OVER (PARTITION BY o.lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, t.n, CAST(score AS BIGINT) AS score
FROM own o JOIN total t ON t.lang = o.lang QUALIFY rank <= 2000
"""
}
