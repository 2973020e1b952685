"""Encoding and decoding against the tokenizers library on whole texts."""

import hashlib
import random

import numpy as np
import public_tokenizers
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tillstream.llm.bpe import codec, encode, op10_bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def plain(text):
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
    decoded = LIBRARY.decode(ids, skip_special_tokens=False)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return len(ids), sha(np.array(ids, "<u4").tobytes()), sha(decoded.encode())


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = op10_bpe(spark, folder).collect()
    assert sorted(map(tuple, found)) == sorted((i, *plain(t)) for i, t in texts.items())


ODD = [
    None, "", "  \n\t", "a\x1cb\x1d c", "It's we'LL don't 'S ''s", "<|endoftext|> a<|startoftext|>b <|endoftext|", "é́ ́x",
    "İSTANBUL ΣΑΣ ǅ", "  a　b\u0085c d​e", "12345 ½ ²", "\U0001f600\U0001f468‍\U0001f469 漢字かな", "a" * 300,
]


def test_odd_texts_short_and_long(spark):
    rng = random.Random(1)
    letters = "".join(rng.choice("etaoinshr") for _ in range(3000))
    mixed = "".join(rng.choice(["the", "é", "7", "!", "'s", "漢", "<|endoftext|>", "ing", "́", "A"]) for _ in range(900))
    texts = [*ODD, letters, letters, "x " + letters + " y's", mixed, mixed + " " + letters + "\x1c" + mixed, " \n" * 200, "!?" * 400]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(None, "é", 2)], "doc_id long, text string, ids int")
    for limits in ({}, {"long_text": 50, "piece": 16}, {"long_text": 0, "piece": 700}):
        found = encode(df, **limits).collect()
        assert len(found) == len(texts) + 1
        for r in found:
            text = "é" if r.doc_id is None else texts[r.doc_id]
            assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == plain(text), text
            ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
            assert r.ids == ids and r.decoded == LIBRARY.decode(ids, skip_special_tokens=False)
    assert encode(df.limit(0)).collect() == []


@settings(max_examples=400, deadline=None)
@given(st.sampled_from(["ab", "the", "aeinst", "hello", "xyz!"]), st.integers(1, 7), st.data())
def test_tree_concatenation_equals_the_whole_word(alphabet, size, data):
    word = data.draw(st.text(alphabet.replace("!", ""), min_size=1, max_size=60))
    own = codec(PATH)
    cuts = [word[i : i + size] for i in range(0, len(word), size)]
    parts = [own.part(c, i == len(cuts) - 1) for i, c in enumerate(cuts)]
    assert own.tree(parts, True) == own.part(word, True) == LIBRARY.encode(word, add_special_tokens=False).ids
