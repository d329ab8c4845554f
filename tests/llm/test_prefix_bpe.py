"""Prefix dynamic programming against the library that it must equal."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from convmill.llm import prefix_bpe, queries
from convmill.llm.chunks import chunks

SF = "/root/testdata/sf0.001"
PATTERN = public_tokenizers.PATTERN
PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = prefix_bpe.read_ranks(PATH)
ENCODER = prefix_bpe.PrefixEncoder(RANKS, PATTERN)
PLAIN = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})
PARTS = ["a", "b", "the", "ing", "'s", "é", "ß", "日本", "🙂", "1", "23", "!!", " ", "  ", "\n", "\t", " ", "▁", "́", "'", "<|endoftext|>", "\x1c", "​", "　", "zzz"]
TEXT = st.lists(st.sampled_from(PARTS), max_size=40).map("".join) | st.text(max_size=60)
DOC = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "a <|endoftext|> b  c\n d "), (4, "a <|endoftext|> b  c\n d "), (5, "x" * 30_000 + " wörd" * 20_000), (None, "the end.")]


def odd(spark):
    rows = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in ODD], DOC)
    return rows.withColumn("ids", F.lit("x")).withColumn("last", F.lit(1)).withColumn("at", F.lit(2)).withColumn("matches", F.lit(None).cast("string"))


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=5))
def test_ids_equal_the_library(texts):
    flat, counts = prefix_bpe._Words(ENCODER).ids([t.encode() for t in texts])
    want = [PLAIN.encode_ordinary(t) for t in texts]
    assert counts.tolist() == list(map(len, want)) and flat.tolist() == [i for ids in want for i in ids]
    assert [ENCODER.all_ids(ENCODER.encode(t)) for t in texts] == want
    assert all(" ".join(chunks(t)) == t for t in texts)


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def test_each_prefix_has_one_last_token(name):
    ranks = prefix_bpe.read_ranks(public_tokenizers.path(name))
    encoder = prefix_bpe.PrefixEncoder(ranks, PATTERN)
    plain = tiktoken.Encoding("plain", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
    rnd = random.Random(5)
    for _ in range(60):
        data = "".join(rnd.choices([p for p in PARTS if p.strip()], k=12)).encode()
        last = encoder.last_tokens(data)
        for end in range(1, len(data) + 1):
            assert last[end - 1] == plain._core_bpe.encode_single_piece(data[:end])[-1]
            fitting = [t for n in range(1, end + 1) if (t := ranks.get(data[end - n : end])) is not None and (n == end or encoder.may_follow(last[end - n - 1], t))]
            assert fitting == [last[end - 1]]


@settings(max_examples=300, deadline=None)
@given(TEXT, st.integers(0, 60), st.integers(0, 9), TEXT)
def test_edits_and_appends_equal_the_new_text(text, at, removed, inserted):
    before = ENCODER.encode(text)
    at = min(at, len(text))
    for after, want in ((ENCODER.edit(before, at, removed, inserted), text[:at] + inserted + text[at + removed :]), (ENCODER.append(before, inserted), text + inserted)):
        whole = ENCODER.encode(want)
        assert after.matches == whole.matches and list(map(list, after.last)) == list(map(list, whole.last))
        assert ENCODER.all_ids(after) == PLAIN.encode_ordinary(want)


def test_an_edit_looks_at_its_neighbourhood_only():
    rnd = random.Random(3)
    before = ENCODER.encode("".join(rnd.choices("abcdefgh", k=50_000)))
    seen, find = [], ENCODER.find

    class Counting:
        def iter(self, *args):
            for hit in find.iter(*args):
                seen.append(hit)
                yield hit

    ENCODER.find = Counting()
    try:
        after = ENCODER.edit(before, 25_000, 3, "xyz")
    finally:
        ENCODER.find = find
    assert len(seen) < 3_000 and ENCODER.all_ids(after) == PLAIN.encode_ordinary(after.text)


def digests(text):
    ids = PLAIN.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_query_equals_the_library(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op11_prefix_bpe(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == digests(texts[r.doc_id])


def test_odd_rows(spark):
    got = prefix_bpe.round_trip(odd(spark), PATH, PATTERN).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted((str(i), *digests(t)) for i, t in ODD)
    assert prefix_bpe.round_trip(odd(spark).limit(0), PATH, PATTERN).collect() == []
    ids = prefix_bpe.encoded(odd(spark), PATH, PATTERN)
    assert sorted((str(r.doc_id), r.ids) for r in ids.collect()) == sorted((str(i), PLAIN.encode_ordinary(t or "")) for i, t in ODD)
    back = prefix_bpe.decoded(ids.withColumn("data", F.lit(1)), PATH, PATTERN).collect()
    assert sorted((str(r.doc_id), bytes(r.data)) for r in back) == sorted((str(i), (t or "").encode()) for i, t in ODD)


def test_small_caches_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(prefix_bpe, "CACHE_WORDS", 3)
    monkeypatch.setattr(prefix_bpe, "CACHE_PAIRS", 2)
    encoder = prefix_bpe.PrefixEncoder(RANKS, PATTERN)
    words = prefix_bpe._Words(encoder)
    for text in ("one two three four five.", "six two eight", "one two three four five."):
        assert words.ids([text.encode(), b"", text.encode()])[0].tolist() == PLAIN.encode_ordinary(text) * 2


def test_stored_prefixes_take_edits(spark):
    docs = odd(spark).where("doc_id IS NULL OR doc_id <> 5")
    state = prefix_bpe.prefixes(docs, PATH, PATTERN)
    edits = spark.createDataFrame([(2, None, None, "new text", 1), (3, 1, 5, "x", 2), (4, 3, 2, "öö", 3), (1, -4, 9, None, 4), (99, 0, 0, "gone", 5), (None, 0, 0, "no", 6)], "doc_id long, at int, removed int, inserted string, ids int")
    got = prefix_bpe.edited(state, edits, PATH, PATTERN).collect()
    want = [(2, "new text"), (3, " x"), *[(4, "a <ööndoftext|> b  c\n d ")] * 2, (1, "")]
    assert sorted((r.doc_id, "".join(r.matches), r.ids) for r in got) == sorted((i, t, PLAIN.encode_ordinary(t)) for i, t in want)
    again = prefix_bpe.edited(prefix_bpe.edited(state, edits.limit(1), PATH, PATTERN), edits.limit(1), PATH, PATTERN).collect()
    assert [r.ids for r in again] == [PLAIN.encode_ordinary("new textnew text")]
