"""Language model scores against a plain model in Python."""

import math
import zlib
from collections import Counter

import pytest

from tillstream.llm.lm import op4_lm, score

SCHEMA = "doc_id long, text string, score string, block int"


def plain(rows, prior=5.0, order=3):
    tokens = [[*(text or "").encode().lower().split(), None] for _, text in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows]
    words, grams, contexts = Counter(), Counter(), Counter()
    # 0 stands before a text; a history is cut there.
    histories = lambda own: [tuple([0, *own][max(0, at + 2 - order) : at + 1]) for at in range(len(own))]
    for own, out in zip(tokens, held):
        if not out:
            words.update(own)
            for history, w in zip(histories(own), own):
                for cut in range(len(history)):
                    grams[history[cut:], w] += 1
                    contexts[history[cut:]] += 1
    total, distinct = sum(words.values()), len(words)

    def p(w, history=()):
        if not history:
            return (words[w] + 0.1) / (total + 0.1 * (distinct + 1))
        return (grams[history, w] + prior * p(w, history[1:])) / (contexts[history] + prior)

    result = []
    for (i, _), own, out in zip(rows, tokens, held):
        base = sum(math.log10(p(w)) for w in own)
        full = sum(math.log10(p(w, h)) for h, w in zip(histories(own), own)) if order > 1 else base
        result.append((i, out, len(own), sum(words[w] > 0 for w in own), total, base, full))
    return result


def same(found, wanted):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    found, wanted = sorted(map(tuple, found), key=key), sorted(wanted, key=key)
    assert [r[:5] for r in found] == [r[:5] for r in wanted]
    for a, b in zip(found, wanted):
        assert a[5:] == pytest.approx(b[5:], rel=1e-9, abs=1e-9)


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    found = op4_lm(spark, folder).collect()
    same(found, plain(rows))
    held = [r for r in found if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)


def test_small_blocks_and_many_ranges(spark):
    texts = ["A b a B c", "a b\x85c", "the\x0bend", None, "", "  ", "x " * 500, "a b a b é É"] * 3
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "a b"), (4, "a b"), (4, "a b")]
    df = spark.createDataFrame([(i, t, "s", 1) for i, t in rows], SCHEMA)
    for order, stretch in ((1, 7), (2, 256), (3, 1), (3, 7), (5, 3)):
        found = score(df, order=order, block_bytes=200, bucket_tokens=20, stretch=stretch).collect()
        same(found, plain(rows, order=order))


def test_nothing_to_learn_from(spark):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    df = spark.createDataFrame([(i, "a b", "", 0) for i in ids], SCHEMA)
    assert [(r.n_known, r.train_tokens, r.base_score, r.score) for r in score(df).collect()] == [(0, 0, 0.0, 0.0)] * 3
    assert score(df.limit(0)).collect() == []
