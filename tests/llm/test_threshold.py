"""Near-duplicates at a threshold of 80, which the pipeline's stage has."""

import corpus_pipeline
import numpy as np
from test_minhash import shingle_set

from tillstream.llm.minhash import MISS, REGISTERS, ROWS, band_keys, band_rows, deduplicated

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def staying(rows, threshold):
    """The least id of each group, by comparing all sets that share a shingle; ids are unique."""
    sets, root, holders = {i: shingle_set(t) for i, t in rows}, {i: i for i, _ in rows}, {}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, own in sets.items():
        for j in {j for s in own for j in holders.get(s, ())}:
            both = len(own & sets[j])
            if 100 * both >= threshold * (len(own) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
        for s in own:
            holders.setdefault(s, []).append(i)
    return sorted(i for i in root if find(i) == i)


def test_bands_follow_the_threshold():
    assert band_rows(85) == ROWS and band_rows(80) == 5
    for threshold in (70, 80, 85, 90):
        rows = band_rows(threshold)
        assert (1 - (threshold / 100) ** rows) ** (REGISTERS // rows) <= MISS
        assert len(set(band_keys(np.zeros(REGISTERS, "<u2"), rows).tolist())) == REGISTERS // rows


def test_stage_drops_copies_from_80_to_85(spark):
    """Pairs of which the second has more words: 80 to 84 of 100 shingles are shared."""
    rows = []
    for i in range(60):
        words = [f"p{i}w{j}" for j in range(104)]
        rows += [(2 * i, " ".join(words[: 84 + i % 5])), (2 * i + 1, " ".join(words))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], SCHEMA)
    found = sorted(r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, FOLDER).collect())
    assert found == staying(rows, 80) == list(range(0, 120, 2))
    assert deduplicated(docs).count() == len(rows)


def test_stage_on_a_whole_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = sorted(r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, FOLDER).collect())
    assert found == staying(rows, 80) != staying(rows, 85)


def test_columns_may_have_any_names(spark):
    rows = [(1, "a b c d e", 7, 1), (2, "a b c d e", 8, 2), (None, "a b c d e", 9, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, gone_ int, own int")
    assert sorted((r.gone_, r.own) for r in deduplicated(docs).collect()) == [(7, 1), (9, 3)]
