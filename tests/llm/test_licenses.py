"""Licence scans against a plain scan in Python."""

import re

from tillstream.llm.licenses import BASE, TEMPLATES, op3_licenses, scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id long, text string, words int, score string"


def plain(text):
    """n_words, n_base, first_word, last_word, base_labels"""
    words = WORD.findall((text or "").translate(LOWER))
    found = [
        (i, label)
        for phrase, label in BASE
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    at = [i for i, _ in found]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))


def test_templates_hold_their_keys():
    assert all(0 <= t.key_at <= len(t.words) for t in TEMPLATES)


def test_whole_table_equals_plain_scan(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    df = op3_licenses(spark, folder)
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    found = df.collect()
    assert len(found) == len(texts)
    for r in found:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain(texts[r.doc_id])
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) or not r.base_labels
        assert 0 <= r.score <= 1 and (r.score >= 0.5) >= (r.n_base > 0)


def test_hand_made_rows(spark):
    filler = "thention onre " * 3000
    bsd = next(t for t in TEMPLATES if t.label == "bsd").text
    rows = [
        (1, None, 0, ""), (2, "", 0, ""), (3, "CC-BY cc by; MIT license?", 0, ""), (3, "CC-BY cc by; MIT license?", 0, ""),
        (4, "the Apache\nLicense, Version 2.0 is not licensed", 0, ""), (5, filler + bsd.title() + " " + filler, 0, ""),
        (6, "gnu general public licence; apache licenses; ccby; mit  licenseé", 0, ""),
        (7, "source and binary forms", 0, ""), (None, "gnu general public license " * 2, 0, ""),
        (8, "Licensed under the GNU General Public License, version 3", 0, ""), (9, "é mit ÉCOLE license", 0, ""),
    ]
    found = scan(spark.createDataFrame(rows, SCHEMA)).collect()
    texts = [r[1] for r in rows]
    got = sorted(((r.doc_id or 0, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in found), key=repr)
    assert got == sorted(((r[0] or 0, *plain(t)) for r, t in zip(rows, texts)), key=repr)
    by = {r.doc_id: r for r in found}
    assert by[4].labels == "apache,apache-2.0" and by[4].places[0].start < 0 or by[4].places[0].share < 1
    assert by[5].labels == "bsd" and by[5].score == 1.0 and by[5].places[0].start == 6000
    assert by[7].labels == "" and by[7].score == 0.0
    assert by[8].labels == "gpl,gpl-3.0" and by[8].score == 1.0
    assert by[1].score == 0.0 and by[1].labels == "" and by[1].first_word is None


def test_empty_table(spark):
    assert scan(spark.createDataFrame([], SCHEMA)).collect() == []
