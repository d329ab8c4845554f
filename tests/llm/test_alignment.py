"""Alignment against token loops over whole texts, each encoded as a whole."""

import hashlib
import random
from collections import defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from convmill.llm import alignment, queries
from convmill.llm.common import Scratch

SF = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TOKENS_A, TOKENS_B = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
TOKENS_A.encode_special_tokens = True
DOC = "doc_id long, text string, lang string, source string, n_chars long"
PARTS = ["a", "the", "ing", "'s", "é", "ß", "日本", "🙂", "12", "!!", " ", "  ", "\n", "\t", " ", "▁", "́", "<|endoftext|>", "<s>", "\x1c", "​", "　", "\0"]


def byte_of_char():
    known, n = {}, 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174:
            known[chr(b)] = b
        else:
            known[chr(256 + n)], n = b, n + 1
    return known


BYTE = byte_of_char()


def token_bytes(text):
    a, b = TOKENS_A.encode(" " + text, add_special_tokens=False).ids, TOKENS_B.encode(text)
    bytes_a = [bytes(BYTE[c] for c in TOKENS_A.id_to_token(i)) for i in a]
    pieces = map(TOKENS_B.id_to_piece, b)
    bytes_b = [bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode() for p in pieces]
    return a, b, bytes_a, bytes_b


def plain_groups(text):
    """Groups and links of one text by walking through its tokens."""
    if not text:
        return [], [], 0, 0
    a, b, bytes_a, bytes_b = token_bytes(text)
    if not (b"".join(bytes_a) == b"".join(bytes_b) == b" " + text.encode()):
        return [], [], 0, 0
    spans = []
    for tokens in (bytes_a, bytes_b):
        at, own = 0, []
        for t in tokens:
            own.append((at, at + len(t)))
            at += len(t)
        spans.append(own)
    cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
    groups, start = [], 0
    for c in cuts:
        groups.append(([i for i, (s, e) in zip(a, spans[0]) if start <= s and e <= c], [i for i, (s, e) in zip(b, spans[1]) if start <= s and e <= c]))
        start = c
    links, j = [], 0
    for i, (s, e) in zip(a, spans[0]):
        while spans[1][j][1] <= s:
            j += 1
        k = j
        while k < len(b) and spans[1][k][0] < e:
            links.append((i, b[k]))
            k += 1
    return groups, links, len(a), len(b)


def plain(rows):
    found = [(i, *plain_groups(t)) for i, t in rows]
    counts = defaultdict(int)
    for _, _, links, _, _ in found:
        for pair in set(links):
            counts[pair] += 1
    most = defaultdict(int)
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    out = []
    for i, groups, links, n_a, n_b in found:
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((i, n_a, n_b, len(groups), len(links), sum(counts[x] == most[x[0]] for x in links), sum(counts[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if n_a else ""))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def random_rows():
    rnd = random.Random(11)
    return [(k, "".join(rnd.choices(PARTS, k=rnd.randint(0, 30)))) for k in range(400)]


@pytest.mark.parametrize("head", [alignment.HEAD, 0, 40])
def test_equals_walking_through_tokens(spark, head):
    rows = random_rows() + [(None, None), (1, "twice "), (1, "twice "), (7, "a ▁ b"), (8, " " * 40 + "x"), (9, "x" * 3000 + " y" * 3000)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOC).repartition(3).withColumn("pairs", F.lit("x")).withColumn("row", F.lit(1)).withColumn("n", F.lit(None).cast("string"))
    assert got(alignment.align(docs, A, B, Scratch(spark), head=head)) == plain(rows)


def test_query_equals_walking_through_tokens(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    df = queries.op12_alignment(spark, SF)
    assert df.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert got(df) == plain(rows)


def test_small_caches_change_nothing(monkeypatch):
    monkeypatch.setattr(alignment, "CACHE_CHUNKS", 5)
    words = alignment._Chunks(alignment.Vocabularies(A, B))
    assert words.vocabularies.apart
    texts = [t for _, t in random_rows()[:60]]
    for k in range(0, 60, 4):
        some = texts[k : k + 4]
        found = alignment._aligned(words, [t.encode() for t in some])
        assert found.groups() == [plain_groups(t)[0] for t in some]
        assert found.n_links.tolist() == [len(plain_groups(t)[1]) for t in some]


def test_groups_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "Hello wörld\n", "en", "s", 0), (2, None, "en", "s", 0)], DOC)
    rows = {r.doc_id: [(g.a, g.b) for g in r.groups] for r in alignment.grouped(docs, A, B).collect()}
    assert rows == {1: plain_groups("Hello wörld\n")[0], 2: []}
    assert alignment.align(docs.limit(0), A, B, Scratch(spark)).collect() == []
    assert got(alignment.align(docs.where("doc_id = 2"), A, B, Scratch(spark))) == [(2, 0, 0, 0, 0, 0, 0, "")]


def test_head_is_bounded(spark):
    counts = spark.range(1000).select((F.col("id") % 50 + 1).alias("n"))
    least = alignment.head_count(counts, 100)
    assert 0 < counts.where(F.col("n") >= least).count() <= 100
    assert alignment.head_count(counts, 1000) == 1 and alignment.head_count(counts, 5) == 2**62
