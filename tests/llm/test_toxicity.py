"""Toxicity: held-out accuracy, the sentences that offend, and odd rows."""

import zlib

import numpy as np
import pytest

from tillstream.llm.toxicity import Model, clean, features, fit, noisy_or, op9_toxicity, score, train

SCHEMA = "doc_id long, text string, score string, predicted int"


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    found = op9_toxicity(spark, folder).collect()
    assert len(found) == spark.read.parquet(f"{folder}/documents.parquet").count()
    for r in found:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    held = [(r.score, labels[r.doc_id]) for r in found if r.held_out and r.doc_id in labels]
    toxic = np.array([s for s, y in held if y])
    fine = np.array([s for s, y in held if not y])
    auc = np.mean([(s > fine).mean() for s in toxic])
    assert auc > 0.9 and (fine >= 0.3).mean() < 0.02 and (toxic >= 0.3).mean() > 0.6


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(1)
    words = [f"plain{i}" for i in range(60)]
    texts, labels = [], []
    for d in range(240):
        sentences = [" ".join(rng.choice(words, 6)) for _ in range(int(rng.integers(1, 8)))]
        if d % 3 == 0:
            sentences[0] = sentences[0].replace(" ", " nasty", 1).replace("nastyplain", "nasty plain")
        texts.append(". ".join(sentences))
        labels.append(int(d % 3 == 0))
    return fit(texts, labels)


def test_sentences_are_located(spark, model):
    text = "plain1 plain2 plain3. All nasty plain4! plain5 plain6"
    df = spark.createDataFrame([(1, text, "x", 9)], SCHEMA)
    (row,) = score(df, model).collect()
    assert row.predicted == 1 and [text[s.begin : s.end] for s in row.offending] == ["All nasty plain4"]


def test_odd_rows(spark, model):
    long = "plain1 plain2. " * 20_000
    rows = [(1, None), (2, ""), (3, " .!\n"), (4, "plain1 plain2"), (4, "plain1 plain2"), (None, "NASTY"), (5, long + "Nasty!")]
    df = spark.createDataFrame([(i, t, "", 0) for i, t in rows], SCHEMA)
    found = {r.doc_id: r for r in score(df, model, lot_bytes=10).collect()}
    assert [found[i].score for i in (1, 2, 3)] == [0.0] * 3 and found[1].offending == []
    assert found[4].predicted == 0 and found[None].predicted == 1 and found[None].held_out is False
    assert score(df, model).count() == len(rows) and score(df.limit(0), model).collect() == []
    stay = clean(df, model)
    assert stay.columns == df.columns and None not in {r.doc_id for r in stay.collect()} and stay.count() >= 5


def test_training_rows(spark):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 != 2]
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    docs = [(i, "foul word here" if i % 2 else "good word here", "", 0) for i in ids] + [(i, "good word here", "", 0) for i in held]
    labels = [(i, i % 2) for i in ids] + [(i, 1) for i in held] + [(None, 1), (ids[0], None), (ids[1], ids[1] % 2), (9999, 1)]
    df, known = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, toxic int")
    learned = train(df, known)
    assert {r.predicted for r in score(df, learned).where("doc_id % 2 = 1 and not held_out").collect()} == {1}
    assert {r.predicted for r in score(df, learned).where("held_out").collect()} == {0}
    again = train(df.repartition(7), known.repartition(5), most=100)
    assert (again.weights == train(df, known, most=100).weights).all()
    nothing = train(df.limit(0), known.limit(0))
    assert {r.score < 1e-6 for r in score(df, nothing).collect()} == {True}


def test_noisy_or():
    assert noisy_or(np.array([0.0, 0.0])) == pytest.approx(0.75)
    assert features("***", 16) == [] and len(features("a.b", 1 << 18)) == 2
    assert Model(np.zeros(1), 0.0).bias == 0.0
