"""Operator 3: find licence statements by a positional index of their rare words.

Built from SQL functions alone. The words of a text that occur in any licence
template are looked up with their positions. A statement counts only if its
mandatory key phrase stands at its place, so the rarest word of the key phrase
(by document frequency over the whole table) is the anchor: each of its places
proposes where the template would begin, and no statement begins elsewhere. The
template's other words are compared by relative position.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillstream.llm.tables import kept, read_table

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """A licence statement; ``key`` is the phrase in it that must stand word by word."""

    label: str
    text: str
    key: str

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def key_words(self) -> list[str]:
        return self.key.split()

    @property
    def key_at(self) -> int:
        words, key = self.words, self.key_words
        return next(i for i in range(len(words)) if words[i : i + len(key)] == key)


#: The phrases that are counted, and their labels.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

#: Opening words of public licence notices, lower case without punctuation.
TEMPLATES = (
    Template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", "general public license version 2"),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", "general public license version 3"),
    Template("lgpl", "licensed under the gnu lesser general public license", "gnu lesser general public license"),
    Template("agpl", "licensed under the gnu affero general public license", "gnu affero general public license"),
    Template("mit", "released under the mit license", "mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "free of charge to any person obtaining a copy"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "source and binary forms"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "for any purpose with or without fee"),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    Template("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
    Template("cc0", "licensed under cc0 1 0 universal", "cc0 1 0"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
)


def word_array(text: Column) -> Column:
    """The words of a text with A-Z in lower case; none for null."""
    lower = F.translate(
        F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )
    return F.regexp_extract_all(lower, F.lit(WORD), F.lit(0))


#: Words too common to propose a place; they are only compared at their place in a template.
COMMON = frozenset("the to of in and or with without a an any for is are be this that it under by into 0 1 2 3 4 v".split())


def proposing(template: Template) -> list[str]:
    """The words of the key phrase that can propose a place: those that are not common, or all if there are no others."""
    return [w for w in template.key_words if w not in COMMON] or template.key_words


def vocabulary(templates: tuple[Template, ...]) -> list[str]:
    return sorted({w for t in templates for w in t.words})


def indexed(docs: DataFrame, templates: tuple[Template, ...]) -> DataFrame:
    """(doc_id, n_words, seen, words): ``seen`` has the template words of the file, and ``words`` all of its words if
    one of them can propose a place, else null."""
    every = vocabulary(templates)
    rare = F.array(*[F.lit(w) for w in sorted({w for t in templates for w in proposing(t)})])
    # An exploded array of one is read, not computed again, by what follows.
    rows = docs.select("doc_id", F.explode(F.array(word_array(F.col("text")))).alias("words"))
    rows = rows.select(
        "doc_id", "words", F.explode(F.array(F.array_intersect("words", F.array(*[F.lit(w) for w in every])))).alias("seen")
    )
    return kept(
        rows.select(
            "doc_id",
            F.size("words").cast("long").alias("n_words"),
            "seen",
            F.when(F.arrays_overlap("seen", rare), F.col("words")).alias("words"),
        ),
        "words",
    )


def rarity(rows: DataFrame, templates: tuple[Template, ...]) -> dict[str, float]:
    """Inverse document frequency over all files; as many entries as the templates have words."""
    counts = {r.w: r["count"] for r in rows.select(F.explode("seen").alias("w")).groupBy("w").count().collect()}
    total = rows.count()
    return {w: math.log((total + 1) / (counts.get(w, 0) + 0.5)) + 0.01 for w in vocabulary(templates)}


def anchor(template: Template, idf: dict[str, float]) -> str:
    """The rarest word of the key phrase that can propose a place."""
    return max(proposing(template), key=lambda w: (idf[w], w))


def proposals(template: Template, idf: dict[str, float]) -> Column:
    """Where the template would begin, by each place of the anchor, in order."""
    word = anchor(template, idf)
    place = template.key_at + template.key_words.index(word)
    return F.transform(F.filter("hits", lambda h: h["w"] == word), lambda h: h["i"] - place)


def standing(template: Template, idf: dict[str, float], starts: Column) -> Column:
    """The proposed places where the key phrase stands, each with the weight share of the words at their places."""
    words, total = template.words, sum(idf[w] for w in template.words)

    def is_at(start: Column, i: int, word: str) -> Column:
        return F.coalesce(F.get("words", start + i) == word, F.lit(False))

    def has_key(start: Column) -> Column:
        found = F.lit(True)
        for i, word in enumerate(template.key_words):
            found = found & is_at(start, template.key_at + i, word)
        return found

    def share(start: Column) -> Column:
        weight = F.lit(0.0)
        for i, word in enumerate(words):
            weight = weight + F.when(is_at(start, i, word), F.lit(idf[word] / total)).otherwise(F.lit(0.0))
        return F.round(F.least(weight, F.lit(1.0)), 9)

    return F.transform(
        F.filter(starts, has_key), lambda s: F.struct(s.alias("start"), share(s).alias("share"))
    )


def scan(
    docs: DataFrame,
    templates: tuple[Template, ...] = TEMPLATES,
    phrases: tuple[tuple[str, str], ...] = BASE,
    least_share: float = 0.6,
) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, places), one row per row of ``docs``.

    ``phrases`` are counted wherever they stand, overlapping ones too;
    first_word and last_word are the least and the largest word index of a
    phrase, null without one. A template's label is given if its key phrase
    stands and its words at their places make up ``least_share`` of its weight.
    ``places`` lists (label, start, share) of the templates found. ``score`` is
    the largest share, at least 0.5 with a phrase, and 0 if nothing was found.
    Label lists are empty strings if there are none. A null text counts as
    empty. Repeated rows are answered one by one. Other columns are not read.
    """
    counted = tuple(Template(label, phrase, phrase) for phrase, label in phrases)
    every = (*counted, *templates)
    rows = indexed(docs, every)
    idf = rarity(rows, every)
    anchors = sorted({anchor(t, idf) for t in every})
    numbers = F.sequence(F.lit(0), F.size("words") - 1)
    hits = F.transform(
        F.filter(numbers, lambda i: F.get("words", i).isin(anchors)),
        lambda i: F.struct(i.alias("i"), F.get("words", i).alias("w")),
    )
    none = F.array().cast("array<struct<i:int,w:string>>")

    def made(df: DataFrame, name: str, column: Column, *keep: str) -> DataFrame:
        """Adds a column that is computed here, once, and not where it is used."""
        return df.select(*keep, F.explode(F.array(column)).alias(name))

    rows = made(rows, "hits", F.when(F.col("words").isNotNull(), hits).otherwise(none), "*")
    proposed = F.struct(*[proposals(t, idf).alias(f"t{k}") for k, t in enumerate(every)])
    rows = made(rows, "proposed", proposed, "doc_id", "n_words", "words")
    stands = F.struct(
        *[standing(t, idf, F.col(f"proposed.t{k}")).alias(f"t{k}") for k, t in enumerate(every)]
    )
    rows = made(rows, "stands", stands, "doc_id", "n_words")

    def listed(labels: list[Column]) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.filter(F.array(*labels), lambda x: x.isNotNull()))), ",")

    base, more = [], []
    starts, places = [], []
    for k, template in enumerate(every):
        own, label = F.col(f"stands.t{k}"), F.lit(template.label)
        if k < len(counted):
            base.append(F.when(F.size(own) > 0, label))
            starts.append(F.transform(own, lambda x: x["start"]))
        else:
            good = F.filter(own, lambda x: x["share"] >= least_share)
            more.append(F.when(F.size(good) > 0, label))
            places.append(
                F.transform(
                    good,
                    lambda x: F.struct(
                        label.alias("label"), x["start"].cast("long").alias("start"), x["share"].alias("share")
                    ),
                )
            )
    rows = rows.select(
        "doc_id",
        "n_words",
        F.concat(*starts).alias("starts"),
        listed(base).alias("base_labels"),
        listed(base + more).alias("labels"),
        F.concat(*places).alias("places"),
    )
    best = F.array_max(F.transform("places", lambda x: x["share"]))
    return rows.select(
        "doc_id",
        "n_words",
        F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"),
        F.array_max("starts").cast("long").alias("last_word"),
        "base_labels",
        "labels",
        F.greatest(F.coalesce(best, F.lit(0.0)), F.when(F.size("starts") > 0, 0.5).otherwise(0.0)).alias("score"),
        "places",
    )


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read_table(spark, sf_dir, "documents")).drop("places")


QUERIES = {"op3_licenses": op3_licenses}
