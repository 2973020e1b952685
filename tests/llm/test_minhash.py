"""Near-duplicate documents against comparing all pairs."""

import random
import re

import numpy as np

from tillstream.llm.minhash import REGISTERS, ROWS, band_keys, classes, deduplicated, estimate, op8_minhash_dedup, sketch

SCHEMA = "doc_id long, text string, node int, n string"


def shingle_set(text):
    words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows, threshold=85):
    """Sorted (doc_id, size, component, kept) by comparing all sets that share a shingle."""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    holders = {}
    for i, own in enumerate(sets):
        if rows[i][0] is None:
            continue
        for j in {j for s in own for j in holders.get(s, ())}:
            both = len(own & sets[j])
            if 100 * both >= threshold * (len(own) + len(sets[j]) - both):
                root[find(i)] = find(j)
        for s in own:
            holders.setdefault(s, []).append(i)
    first = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None and sets[i]:
            if doc in first:
                root[find(i)] = find(first[doc])
            first[doc] = i
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    result = []
    for i, (doc, _) in enumerate(rows):
        comp = doc if doc is None or not sets[i] else least[find(i)]
        result.append((doc, len(sets[i]), comp, comp == doc))
    return sorted(result, key=repr)


def test_whole_table(spark):
    folder = "/root/testdata/sf0.1"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    found = op8_minhash_dedup(spark, folder).collect()
    assert sorted(map(tuple, found), key=repr) == brute(rows)


def near_copies(rng, base, n, most):
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(0, most)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append(" ".join(words))
    return rows


def test_copies_that_are_near_to_the_original_only(spark):
    rng = random.Random(5)
    texts = []
    for size in (60, 200, 150):
        base = [rng.choice("abcdefghij") + str(rng.randrange(300)) for _ in range(size)]
        texts += [" ".join(base)] * 3 + near_copies(rng, base, 150, size // 25)
    order = list(range(len(texts)))
    rng.shuffle(order)
    rows = list(zip(order, texts))
    df = spark.createDataFrame([(i, t, 0, "") for i, t in rows], SCHEMA)
    assert sorted(map(tuple, classes(df).collect()), key=repr) == brute(rows)
    stay = {r.doc_id for r in deduplicated(df).collect()}
    assert stay == {r[0] for r in brute(rows) if r[3]}


def test_odd_rows(spark):
    long = " ".join(f"x{i}" for i in range(30_000))
    rows = [
        (1, None), (2, ""), (3, " \t\x0b\n"), (4, "one TWO three"), (5, "One two\x0cthree"), (6, "one two"), (7, "É x"), (8, "é x"),
        (9, long), (10, long + " more"), (11, long[: len(long) // 2]), (12, "a b c d e"), (12, "a b c d e"), (13, "a b c d e f g"),
        (13, "A B C D E"), (None, "a b c d e"), (None, None), (14, "q r s t u v"), (15, "a b c d e f g"), (16, "one two"),
    ]
    df = spark.createDataFrame([(i, t, 0, "") for i, t in rows], SCHEMA)
    found = [(i, n, c, bool(k)) for i, n, c, k in classes(df).collect()]
    wanted = [(i, n, c, True if i is None else k) for i, n, c, k in brute(rows)]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)
    assert len(deduplicated(df).collect()) == sum(w[3] for w in wanted)
    assert classes(df.limit(0)).collect() == [] and deduplicated(df.limit(0)).columns == df.columns


def test_sketches_estimate_and_merge():
    rng = np.random.default_rng(2)
    errors = []
    for share in (0.3, 0.6, 0.85, 0.95):
        for _ in range(30):
            a = rng.integers(0, 2**64, 600, dtype=np.uint64)
            keep = int(600 * 2 * share / (1 + share))
            b = np.concatenate([a[:keep], rng.integers(0, 2**64, 600 - keep, dtype=np.uint64)])
            true = keep / (1200 - keep)
            x, y = sketch(np.unique(a)), sketch(np.unique(b))
            errors.append(estimate(x[None], y[None], np.array([600]), np.array([600]))[0] - true)
            assert (sketch(np.unique(np.concatenate([a, b]))) == np.maximum(x, y)).all()
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.05


def test_bands_are_told_apart():
    keys = band_keys(np.zeros(REGISTERS, "<u2"))
    assert len(set(keys.tolist())) == REGISTERS // ROWS
