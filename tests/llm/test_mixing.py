"""Mixing against the same rules in Python."""

import math
import re
from collections import Counter, defaultdict

import pytest

from tillstream.llm.mixing import allocate, mix, op5_mixing

SCHEMA = "doc_id long, text string, source string, size string, target int, src string"


def plain_targets(totals, weights=(3, 1, 2), share=1.5, most=2.0):
    names = sorted((s for s in totals if s is not None), key=lambda s: s.encode()) + [None] * (None in totals)
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, target, open_ = share * sum(totals.values()), dict.fromkeys(names, 0.0), set(names)
    while open_ and left > 1e-9:
        total = sum(weight[s] for s in open_)
        extra, left = left, 0.0
        for s in list(open_):
            target[s] += extra * weight[s] / total
            if target[s] > most * totals[s]:
                left += target[s] - most * totals[s]
                target[s] = most * totals[s]
                open_.discard(s)
    return target


def check(rows, found):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    totals = defaultdict(int)
    for _, text, source in rows:
        totals[source] += size(text)
    target = plain_targets(totals)
    assert Counter((r.doc_id, r.size) for r in found) == Counter((i, size(t)) for i, t, _ in rows)
    by_id, got = {i: s for i, _, s in rows}, defaultdict(int)
    for r in found:
        source = by_id[r.doc_id]
        assert r.source_size == totals[source] and r.target == pytest.approx(target[source], rel=1e-9)
        assert 0 <= r.taken <= 2 * r.size
        got[source] += r.taken
    return {s: got[s] - math.floor(target[s] + 1e-6) for s in totals}


def test_whole_table(spark):
    folder = "/root/testdata/sf0.1"
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    found = op5_mixing(spark, folder).collect()
    assert set(check(rows, found).values()) <= {0, -1}
    assert sorted(map(tuple, found)) == sorted(map(tuple, op5_mixing(spark, folder).collect()))


ROWS = [
    *((i, "w " * (i % 7), "hot") for i in range(60)), *((100 + i, "a\x0bb\x85c", "Ünder") for i in range(4)), (200, None, None),
    (201, "only one\there", None), (202, "", "empty"), (203, "x", "a"), (204, "long " * 5000, "b"), (205, "y z", "a"),
]


def test_small_sources_and_nulls(spark):
    df = spark.createDataFrame([(i, t, s, "", 0, "n") for i, t, s in ROWS], SCHEMA)
    assert set(check(ROWS, allocate(df).collect()).values()) <= {0, -1}
    assert allocate(df.limit(0)).collect() == []


def test_equal_rows_share_a_cut(spark):
    rows = [(7, "a b c d e f g h i j", "s")] * 5 + [(8, "a b c", "t")] * 2
    df = spark.createDataFrame([(i, t, s, "", 0, "n") for i, t, s in rows], SCHEMA)
    for r in allocate(df, share=0.7).collect():
        assert 0 <= r.taken <= 2 * r.size and r.taken == allocate(df, share=0.7).where(f"doc_id = {r.doc_id}").first().taken


def test_mixed_documents(spark):
    df = spark.createDataFrame([(i, t, s, "", 0, "n") for i, t, s in ROWS], SCHEMA)
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    taken = {r.doc_id: (r.taken, r.size) for r in allocate(df).collect()}
    out = mix(df)
    assert out.columns == df.columns and out.schema.simpleString() == df.schema.simpleString()
    got, texts = defaultdict(int), defaultdict(list)
    for r in out.collect():
        got[r.doc_id] += words(r.text)
        texts[r.doc_id].append(r.text)
    assert all(got[i] == n for i, (n, _) in taken.items())
    whole = {i: t for i, t, _ in ROWS}
    for i, own in texts.items():
        assert sum(t != whole[i] for t in own) <= 1
    assert len(texts[200]) == len(texts[202]) == 1
    every = Counter(r.doc_id for r in mix(df, least=1.0).collect())
    assert set(every) == set(whole)
    assert mix(df.limit(0)).collect() == []
