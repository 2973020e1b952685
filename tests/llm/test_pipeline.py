"""The pipeline's stages against what each must do to its own input."""

import re
from collections import Counter

import corpus_pipeline
from test_bpe import plain
from test_minhash import brute
from test_mixing import plain_targets

from tillstream.llm.registry import QUERIES
from tillstream.llm.tables import kept

FOLDER = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_every_stage(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    (_, toxic), (_, dedup), (_, mixing), (_, encode) = corpus_pipeline.STAGES
    first = docs
    docs = kept(toxic(spark, first, FOLDER), "t1")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    stay = {r.doc_id for r in docs.collect()}
    known = [i for i, y in labels.items() if not y]
    assert docs.columns == COLUMNS and len(stay & set(known)) > 0.97 * len(known)
    assert len([i for i, y in labels.items() if y and i not in stay]) > 0.5 * sum(labels.values())

    rows = [(r.doc_id, r.text) for r in docs.collect()]
    docs = kept(dedup(spark, docs, FOLDER), "t2")
    assert docs.columns == COLUMNS
    assert sorted(r.doc_id for r in docs.collect()) == sorted(r[0] for r in brute(rows, 80) if r[3])

    before = docs.collect()
    docs = kept(mixing(spark, docs, FOLDER), "t3")
    assert docs.columns == COLUMNS
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, got = Counter(), Counter()
    for r in before:
        sizes[r.source] += words(r.text)
    after = docs.collect()
    for r in after:
        got[r.source] += words(r.text)
    extra = plain_targets(sizes, share=0.5, most=1.0)
    assert {r.doc_id for r in after} == {r.doc_id for r in before}
    assert all(abs(got[s] - sizes[s] - extra[s]) < 2 for s in sizes)

    found = encode(spark, docs, FOLDER)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, found.collect())) == sorted((r.doc_id, *plain(r.text)) for r in after)
    whole = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, found.collect()))


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = kept(stage(spark, docs, FOLDER), name)
    assert docs.count() == 0


def test_every_operator_is_registered_once():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, len(numbers) + 1)) and len(numbers) >= 11
