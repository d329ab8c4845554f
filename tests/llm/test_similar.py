import random
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F
from test_simhash import brute_roots

from convmill.llm import similar
from convmill.llm.common import Scratch


def jaccard(a, b):
    x, y = (set(similar.shingle_set(t.encode()).tolist()) for t in (a, b))
    return len(x & y) / len(x | y) if x | y else 1.0


def edited(rng, words, share):
    return " ".join(rng.choice(["alpha", "beta", "gamma"]) + str(rng.randrange(999)) if rng.random() < share else w for w in words)


def test_plan_grows_with_the_texts():
    assert similar.plan(1000)[0] == 21 and similar.plan(1 << 20)[0] == 23
    assert similar.plan(1 << 20)[1] > similar.plan(1000)[1]


def test_long_texts_are_decided_by_their_whole_sets(spark):
    rng = random.Random(4)
    docs = []
    for f in range(120):
        words = [f"w{rng.randrange(10**6)}" for _ in range(1200)]
        changed = list(words)
        # One changed word in a place far from others takes five shingles.
        for i in range(26 + f % 3):
            changed[40 * i + 20] = f"x{rng.randrange(10**6)}"
        docs += [(2 * f, " ".join(words)), (2 * f + 1, " ".join(changed))]
    text = dict(docs)
    near = {f for f in range(120) if (similar.simhash.simhash(text[2 * f].encode()) ^ similar.simhash.simhash(text[2 * f + 1].encode())).bit_count() <= 4}
    alike = {f for f in range(120) if jaccard(text[2 * f], text[2 * f + 1]) >= 0.8}
    assert 30 <= len(alike) <= 50
    kept = {r.doc_id for r in similar.keep_one(spark.createDataFrame(docs, "doc_id long, text string"), Scratch(spark)).collect()}
    gone = {f for f in range(120) if 2 * f + 1 not in kept}
    assert all(2 * f in kept for f in range(120)) and gone <= alike | near and len(gone & alike) >= 0.95 * len(alike)


def test_short_sets_meet(spark):
    rng = random.Random(6)
    docs = []
    for f in range(600):
        words = [f"w{rng.randrange(10**6)}" for _ in range(9)]
        docs += [(2 * f, " ".join(words[:8])), (2 * f + 1, " ".join(words))]
    kept = {r.doc_id for r in similar.keep_one(spark.createDataFrame(docs, "doc_id long, text string"), Scratch(spark)).collect()}
    assert all(2 * f in kept for f in range(600)) and len(kept) <= 600 * 1.03


def roots_of(nodes, pairs):
    root = {n: n for n in nodes}
    find = lambda n: n if root[n] == n else find(root[n])
    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_meetings_keep_every_close_pair_in_one_family():
    rng = np.random.default_rng(3)
    n = 500
    entry = np.zeros(n, similar.ENTRY)
    # One run of 440 and small ones; centres with members at all distances, so that some are close to a few others only.
    entry["key"], entry["id"] = np.where(np.arange(n) < 440, 5, 6 + np.arange(n) // 10), rng.permutation(n)
    for c in range(similar.CHECKS):
        centres = rng.integers(0, 1 << 63, 5, dtype=np.uint64)
        entry[f"check{c}"] = centres[np.arange(n) % 5]
    for i in range(n):
        for b in rng.integers(0, 64 * similar.CHECKS, int(rng.integers(0, 40))):
            entry[f"check{b // 64}"][i] ^= np.uint64(1) << np.uint64(b % 64)
    near = lambda a, b: sum((int(entry[f"check{c}"][a]) ^ int(entry[f"check{c}"][b])).bit_count() for c in range(similar.CHECKS)) <= similar.CHECK_BITS
    close = [(int(entry["id"][a]), int(entry["id"][b])) for a, b in combinations(range(n), 2) if entry["key"][a] == entry["key"][b] and near(a, b)]
    a, b = similar._meetings(entry)
    got = roots_of(range(n), zip(a.tolist(), b.tolist()))
    assert len(close) > 1000 and all(got[x] == got[y] for x, y in close)
    x, y = similar.forest(a, b)
    assert len(x) < n and roots_of(range(n), zip(x.tolist(), y.tolist())) == got


def test_alike_equals_brute_force():
    rng = np.random.default_rng(8)
    base = rng.integers(0, 1 << 60, 60, dtype=np.uint64)
    sets = [np.unique(np.concatenate([rng.choice(base, int(rng.integers(40, 61)), replace=False), rng.integers(0, 1 << 60, int(rng.integers(0, 9)), dtype=np.uint64)])) for _ in range(60)]
    sets += [np.empty(0, np.uint64)] * 2
    ids = np.arange(len(sets)) * 3
    share = lambda a, b: len(np.intersect1d(a, b)) / len(np.union1d(a, b)) if len(a) or len(b) else 1.0
    for side in (np.zeros(len(sets), int), np.arange(len(sets)) % 2):
        across = side.max() > 0
        pairs = [(int(ids[i]), int(ids[j])) for i, j in combinations(range(len(sets)), 2) if share(sets[i], sets[j]) >= 0.8 and not (across and side[i] == side[j])]
        a, b = similar.alike(ids, sets, side, 0.8)
        assert set(map(tuple, map(sorted, zip(a.tolist(), b.tolist())))) <= set(pairs)
        want = roots_of(ids.tolist(), pairs)
        assert 5 < len(pairs) and roots_of(ids.tolist(), zip(a.tolist(), b.tolist())) == want


def test_a_family_of_many_chunks_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(similar, "FEW", 16)
    monkeypatch.setattr(similar, "CHUNK", 4096)
    rng = random.Random(12)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    docs = [(i, edited(rng, base, rng.choice([0.005, 0.02, 0.03]))) for i in range(240)]
    text = dict(docs)
    close = [(a, b) for a, b in combinations(text, 2) if jaccard(text[a], text[b]) >= 0.8 or (similar.simhash.simhash(text[a].encode()) ^ similar.simhash.simhash(text[b].encode())).bit_count() <= 4]
    want = {i for i, r in roots_of(text, close).items() if i == r}
    kept = {r.doc_id for r in similar.keep_one(spark.createDataFrame(docs, "doc_id long, text string"), Scratch(spark)).collect()}
    assert 3 < len(want) < 200 and want <= kept and len(kept - want) <= 2


def test_equal_ids_clashing_names_and_repeats(spark):
    rows = [(5, "first text of its own here", "a", "b", {"k": 1}), (5, "second text that is not like it", "a", "b", {"k": 1}), (6, "third one about other things", "a", "b", {"k": 1}), (6, "third one about other things", "z", "b", {"k": 2})]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _hash string, _row string, m map<string,int>")
    kept = similar.keep_one(docs, Scratch(spark))
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text[:5], r._hash) for r in kept.collect()) == [(5, "first", "a"), (5, "secon", "a"), (6, "third", "a")]


def test_near_copies_go_and_clean_documents_stay(spark):
    rng = random.Random(9)
    docs, family = [], {}
    for f in range(150):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([40, 150, 700]))]
        docs.append((len(docs), " ".join(words)))
        family[docs[-1][0]] = f
        for _ in range(rng.choice([0, 0, 1, 3, 60 if f < 2 else 1])):
            docs.append((len(docs), edited(rng, words, rng.choice([0.0, 0.005, 0.015]))))
            family[docs[-1][0]] = f
    text = dict(docs)
    rows = spark.createDataFrame(docs, "doc_id long, text string").withColumn("id", F.lit("mine"))
    kept = {r.doc_id for r in similar.keep_one(rows, Scratch(spark)).collect()}
    pairs = [(a, b) for a, b in combinations(text, 2) if family[a] == family[b] and jaccard(text[a], text[b]) >= 0.84]
    clear = brute_roots(pairs, text)
    heads = {i for i, r in clear.items() if i == r}
    # Each family keeps at least its first; nothing that is clearly a copy stays, but for the odd one.
    assert {min(i for i in family if family[i] == f) for f in range(150)} <= kept
    assert len(kept - heads) <= 0.02 * len(docs)


def test_odd_rows(spark):
    rows = [(None, "a b"), (None, "a b"), (1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "One TWO"), (5, "other words here now"), (6, "w " * 50000), (7, "w " * 50001)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("print", F.lit(1))
    kept = similar.keep_one(docs, Scratch(spark))
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 0, 1, 4, 5, 6]
    assert similar.keep_one(docs.limit(0), Scratch(spark)).count() == 0


def test_what_all_of_a_family_share_makes_no_comparisons():
    rng = np.random.default_rng(5)
    core = rng.integers(0, 1 << 60, 200, dtype=np.uint64)
    n = 1500
    template = [np.unique(np.concatenate([core[:150], rng.integers(0, 1 << 60, 50, dtype=np.uint64)])) for _ in range(n)]
    near = [np.unique(np.concatenate([rng.choice(core, 195, replace=False), rng.integers(0, 1 << 60, 6, dtype=np.uint64)])) for _ in range(n)]
    tried = []
    for sets, want in ((template, 0), (near, n - 1)):
        sizes = 0
        before = similar._in_turn

        def counting(*args):
            nonlocal sizes
            for some in before(*args):
                sizes += len(some)
                yield some

        similar._in_turn = counting
        try:
            a, _ = similar.alike(np.arange(n), sets, np.zeros(n, int), 0.8)
        finally:
            similar._in_turn = before
        assert len(a) == want
        tried.append(sizes)
    # No two of the template meet in their rarest shingles; of the alike ones each takes a comparison or few.
    assert tried[0] == 0 and tried[1] < 20 * n
