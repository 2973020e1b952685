"""Best-fit-decreasing shards."""

import zlib
from collections import defaultdict

from hypothesis import given, settings, strategies as st

from tillstream.llm.sharding import best_fit, level_fit, op7_sharding, pack, shard_documents

SCHEMA = "doc_id long, text string, shard string, size int, grp int"


def by_scanning(sizes, capacity):
    free, bins = [], []
    for size in sizes:
        fits = [(room, i) for i, room in enumerate(free) if room >= size]
        if fits:
            i = min(fits)[1]
        else:
            i = len(free)
            free.append(max(capacity, size))
        free[i] -= size
        bins.append(i)
    return bins


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 60), max_size=60), st.integers(1, 80), st.integers(1, 7))
def test_best_fit_takes_the_tightest_bin(sizes, capacity, bins):
    sizes = sorted(sizes, reverse=True)
    assert best_fit(sizes, capacity) == by_scanning(sizes, capacity)
    found = level_fit(sizes, bins)
    loads = [sum(s for s, b in zip(sizes, found) if b == i) for i in range(bins)]
    assert not sizes or max(loads) <= sum(sizes) / bins + max(sizes)


def check(rows, found):
    size = lambda t: len((t or "").encode()) + 1
    crc = lambda t: zlib.crc32((t or "").encode())
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in found) == sorted((i, size(t), crc(t)) for i, t in rows)
    slots, loads, shards = defaultdict(list), defaultdict(int), defaultdict(set)
    for r in found:
        slots[r.shard].append(r.slot)
        loads[r.shard] += r.size
        shards[r.text_crc32, r.size].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in shards.values())
    return loads


def test_whole_table(spark):
    folder = "/root/testdata/sf0.1"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    found = op7_sharding(spark, folder).collect()
    loads = check(rows, found)
    assert set(loads) == set(range(16)) and max(loads.values()) < 1.01 * min(loads.values())
    assert {(r.law, r.grown_shard) for r in found} == {("bytes", None)}


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "é"), (3, "é"), (4, "x" * 50_000), (5, "y"), *((10 + i, "copy") for i in range(40))]
    df = spark.createDataFrame([(i, t, "", 0, 0) for i, t in rows], SCHEMA)
    check(rows, shard_documents(df, shards=4).collect())
    assert shard_documents(df.limit(0)).collect() == []


def test_fixed_capacity_opens_few_shards(spark):
    rows = [(i, "x" * (i * 37 % 900)) for i in range(1500)]
    df = spark.createDataFrame([(i, t, "", 0, 0) for i, t in rows], SCHEMA)
    loads = check(rows, shard_documents(df, shards=None, capacity=20_000).collect())
    assert max(loads.values()) <= 20_000 and len(loads) <= 1.02 * sum(loads.values()) / 20_000 + 1
    groups = df.selectExpr("cast(cast(doc_id as string) as binary) grp", "cast(length(text) + 1 as bigint) size")
    packed = pack(groups, capacity=5_000, cell_shards=20).join(groups, "grp").groupBy("shard").sum("size").collect()
    assert max(r[1] for r in packed) <= 5_000 and len(packed) <= 1.1 * sum(r[1] for r in packed) / 5_000 + 10
    assert sorted(r.shard for r in packed) == list(range(len(packed)))
