import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from convmill.llm import queries, sharding
from convmill.llm.common import Scratch

SF = "/root/testdata/sf0.01"


def checked(rows, texts, slack):
    assert sorted((r.doc_id or 0, r.size, r.text_crc32) for r in rows) == sorted((i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts)
    loads, slots = defaultdict(int), defaultdict(list)
    for r in rows:
        assert 0 <= r.shard < 8
        loads[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean = sum(loads.values()) / 8
    assert max(abs(loads[s] - mean) for s in range(8)) <= slack
    return loads


def test_query_keeps_copies_together_and_sizes_even(spark):
    rows = queries.op1_sharding(spark, SF).collect()
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    total = sum(r.size for r in rows)
    checked(rows, texts, 0.005 * total / 8)
    groups, text = defaultdict(set), dict(texts)
    for r in rows:
        groups[text[r.doc_id]].add(r.shard)
    assert all(len(g) == 1 for g in groups.values())
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}
    assert sorted(rows) == sorted(queries.op1_sharding(spark, SF).collect())


def test_a_group_larger_than_a_shard_is_split_evenly(spark):
    texts = [(i, "copy " * 20) for i in range(400)] + [(400 + i, f"other {i} " * 11) for i in range(600)] + [(2000 + i, "pair" + str(i // 2)) for i in range(200)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    rows = sharding.assign(docs, Scratch(spark)).collect()
    checked(rows, texts, 250)
    hot = defaultdict(int)
    for r in rows:
        if r.doc_id < 400:
            hot[r.shard] += 1
    # No random scatter: whole shards are filled with copies before others get any more.
    assert max(hot.values()) * 101 >= 0.8 * sum(r.size for r in rows) / 8
    pairs = defaultdict(set)
    for r in rows:
        if r.doc_id >= 2000:
            pairs[(r.doc_id - 2000) // 2].add(r.shard)
    assert sum(len(p) == 1 for p in pairs.values()) >= 90


def test_odd_rows(spark):
    texts = [(None, None), (None, "x"), (1, ""), (2, "é" * 3), (2, "é" * 3), (3, "long " * 50000), (4, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("shard", F.lit("mine")).withColumn("size", F.lit(None).cast("int"))
    checked(sharding.assign(docs, Scratch(spark)).collect(), texts, 250001)
    assert sharding.assign(docs.limit(0), Scratch(spark)).count() == 0
    one = sharding.assign(docs.where("doc_id = 3"), Scratch(spark)).collect()
    assert [r.slot for r in one] == [0]


def test_full_shards_exchange(spark):
    # Every text has a copy, so no unlinked document leaves room: pairs come together by exchange.
    texts = [(i, f"text {i // 2} " * (8 + i // 2 % 5)) for i in range(4000)]
    rows = sharding.assign(spark.createDataFrame(texts, "doc_id long, text string"), Scratch(spark)).collect()
    largest = max(r.size for r in rows)
    checked(rows, texts, 16 * largest)
    pairs = defaultdict(set)
    for r in rows:
        pairs[r.doc_id // 2].add(r.shard)
    assert sum(len(p) == 1 for p in pairs.values()) >= 0.95 * len(pairs)


def test_odd_rows_are_balanced(spark):
    texts = [(i % 7 or None, None if i % 5 == 0 else f"word {i % 40} " * (1 + i % 9)) for i in range(1500)]
    rows = sharding.assign(spark.createDataFrame(texts, "doc_id long, text string"), Scratch(spark)).collect()
    checked(rows, texts, 4 * max(r.size for r in rows))
