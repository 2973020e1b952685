"""Licence statements in files with several notices, against a check of every start."""

import pytest
from test_licenses import LOWER, SCHEMA, WORD

from tillstream.llm.licenses import BASE, TEMPLATES, Template, indexed, rarity, scan

GPL = "distributed under the GNU General Public License version 3"
TWO = f"Parts are licensed under the MIT License. The rest is {GPL}"


def every_place(text, idf, least_share=0.6):
    words, found = WORD.findall((text or "").translate(LOWER)), []
    for t in TEMPLATES:
        for start in range(-len(t.words), len(words)):
            first = start + t.key_at
            if words[max(first, 0) : first + 1] != t.key_words[:1]:
                continue
            at = [0 <= start + i < len(words) and words[start + i] == w for i, w in enumerate(t.words)]
            if all(at[t.key_at : t.key_at + len(t.key_words)]):
                share = sum(idf[w] for w, ok in zip(t.words, at) if ok) / sum(idf[w] for w in t.words)
                if share >= least_share:
                    found.append((t.label, start, pytest.approx(share, abs=1e-8)))
    return found


def compared(docs):
    every = (*(Template(label, phrase, phrase) for phrase, label in BASE), *TEMPLATES)
    idf = rarity(indexed(docs, every), every)
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    found = {r.doc_id: r for r in scan(docs).collect()}
    assert found.keys() == texts.keys()
    for i, text in texts.items():
        assert [tuple(p) for p in found[i].places] == every_place(text, idf)
    return found


def test_several_notices(spark):
    texts = [TWO, GPL, f"licensed {'x ' * 50}{GPL}", " ".join(t.text for t in TEMPLATES), f"{GPL}. {TWO} {GPL}"]
    texts += [f"free person permission {' '.join(t.text.split()[1:])} fee mozilla" for t in TEMPLATES]
    texts += ["gnu general public license version"] * 60 + ["nothing"] * 200
    found = compared(spark.createDataFrame([(i, t, 0, "") for i, t in enumerate(texts)], SCHEMA))
    assert all("gpl-3.0" in found[i].labels.split(",") for i in (0, 1, 2, 4))
    assert sum(p.label == "gpl-3.0" for p in found[4].places) == 3


def test_key_of_common_words(spark):
    df = spark.createDataFrame([(1, "so it is for any use, rare", 0, ""), (2, "rare", 0, "")], SCHEMA)
    found = scan(df, (Template("own", "it is for any use", "for any"),), least_share=0.1)
    assert sorted((r.doc_id, r.labels) for r in found.collect()) == [(1, "own"), (2, "")]
