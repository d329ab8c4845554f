import math
import re
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from convmill.llm import mixing, packing, queries, url_filter
from convmill.llm.common import Scratch, running

SF = "/root/testdata/sf0.001"
VOCAB = public_tokenizers.path("word_bpe_49k.json")
DOC = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [(1, None, None, None, None), (2, "", "en", "b", 0), (3, "  \t\n", "en", "b", 4), (4, "a b\u00a0c A\u0301 it's IT'S. we'll,\u3000x 12. x.., . , ,. É. <|ENDOFTEXT|> <|endoftext|>", "en", "é", 9), (4, "a b\u00a0c A\u0301 it's IT'S. we'll,\u3000x 12. x.., . , ,. É. <|ENDOFTEXT|> <|endoftext|>", "en", "é", 9), (5, "wörd " * 9000, "de", "b", 1), (None, "the end.", "en", "z", 3), (7, "IT'S. we'll, x.., . , ,. A\u0301. É, don't. a.b. 3.", "en", "z", 3)]


def odd(spark):
    return spark.createDataFrame(ODD, DOC).withColumn("rank", F.lit("x")).withColumn("target", F.lit(1)).withColumn("length", F.lit(None).cast("string"))


def test_running_equals_plain_order(spark):
    df = spark.range(500).select(F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("p"), "id", (F.col("id") % 7).alias("v"))
    rows = running(df, ["p"], ["id"], "v", "before", buckets=5).collect()
    for p in {r.p for r in rows}:
        own = sorted((r.before, r.before + r.v) for r in rows if r.p == p)
        assert own[0][0] == 0 and own[-1][1] == sum(r.v for r in rows if r.p == p)
        assert all(a[1] == b[0] for a, b in zip(own, own[1:]))


@pytest.mark.parametrize("n", [1, 2047, 2048, 2049, 4095, 10000])
def test_cuts_cover_in_powers_of_two(n):
    got = packing.cuts(n)
    assert [s for s, _ in got] == [sum(x for _, x in got[:i]) for i in range(len(got))]
    assert sum(x for _, x in got) == n and all(x & (x - 1) == 0 and x <= 2048 for _, x in got)


def packed_equals(rows, texts):
    tok, want = Tokenizer.from_file(VOCAB), defaultdict(list)
    for doc_id, text in texts:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 1]
        for s, n in packing.cuts(len(ids)):
            want[doc_id].append((s, n, zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[s : s + n])), len(ids)))
    got = defaultdict(list)
    for r in rows:
        got[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert sorted(r.sequence_id for r in rows) == list(range(len(rows))) and {r.offset for r in rows} <= {0}
    by_length = sorted((r.sequence_id, -r.length) for r in rows)
    assert [x for _, x in by_length] == sorted(x for _, x in by_length)


def test_packing_equals_whole_text_encoding(spark):
    texts = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    packed_equals(queries.op8_packing(spark, SF).collect(), [(r.doc_id, r.text) for r in texts])


def test_letters_of_latin_1_go_to_the_model_alike():
    letters = [chr(c) for c in range(0xC0, 0x250) if chr(c).isalpha()]
    words = letters + [f"x{a}y{b}" for a in letters[:70] for b in ("e", "Z", "ß")] + ["STRASSE", "naïve", "ÆSOP", "e\u0301", "İ", "ǅ", "µm", "x\u00d7y", "ﬁn", "Σας"]
    text = " ".join(words)
    encoder, tok = packing.WordEncoder(VOCAB), Tokenizer.from_file(VOCAB)
    assert next(encoder.encode([text.encode()])) == b"".join(i.to_bytes(4, "little") for i in tok.encode(text, add_special_tokens=False).ids)


def test_packing_odd_rows_and_empty(spark):
    packed_equals(packing.pack(odd(spark), VOCAB, Scratch(spark)).collect(), [r[:2] for r in ODD])
    assert packing.pack(odd(spark).limit(0), VOCAB, Scratch(spark)).count() == 0


def waterfill(sizes, share=1.5):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    capped, budget = set(), share * sum(sizes.values())
    while True:
        free = [s for s in names if s not in capped]
        left = budget - sum(2 * sizes[s] for s in capped)
        got = {s: 2.0 * sizes[s] if s in capped else left * w[s] / sum(w[x] for x in free) for s in names}
        over = {s for s in free if got[s] > 2 * sizes[s]}
        if not over:
            return got
        capped |= over


def mixed_is_right(rows, texts):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = defaultdict(int)
    for _, t, s in texts:
        sizes[s] += size(t)
    want = waterfill(sizes)
    assert sorted((r.doc_id or 0, r.size) for r in rows) == sorted((i or 0, size(t)) for i, t, _ in texts)
    taken = defaultdict(int)
    for r in rows:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source], abs_tol=1e-6)
        assert 0 <= r.taken <= 2 * r.size
        assert (r.position is None) == (r.taken == 0) and 0 <= (r.position or 0) <= 1
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 1


def test_mixing_meets_targets(spark):
    rows = queries.op9_mixing(spark, SF).collect()
    texts = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    mixed_is_right(rows, texts)
    assert rows == queries.op9_mixing(spark, SF).collect()
    assert [r.position for r in rows if r.taken] == sorted(r.position for r in rows if r.taken)


def test_mixing_odd_rows_and_empty(spark):
    s = Scratch(spark)
    mixed_is_right(mixing.per_document(mixing.mix(odd(spark), s), s).collect(), [(r[0], r[1], r[3]) for r in ODD])
    assert mixing.per_document(mixing.mix(odd(spark).limit(0), s), s).count() == 0


def test_schedule_inverse(spark):
    for k, knots in enumerate(mixing.SCHEDULES):
        def integral(t):
            out = 0.0
            for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
                u = min(max(t - t0, 0), t1 - t0)
                out += w0 * u + (w1 - w0) / (t1 - t0) * u * u / 2
            return out
        got = spark.range(101).select((F.col("id") / 100).alias("x")).select("x", mixing.time_at(F.col("x"), F.element_at(mixing._knots(mixing.SCHEDULES), k + 1)).alias("t")).collect()
        assert all(math.isclose(integral(r.t), r.x * integral(1.0), abs_tol=1e-9) for r in got)


def brute_rule(url, rules):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1]) if m else ""
    path = m[2] if m else ""
    fit = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fit)[1:] if fit else (None, "allow")))


def test_url_rules_equal_brute_force(spark):
    rules = [("com", "/", "allow"), ("a.com", "/x", "block"), ("a.com", "/x/y/", "allow"), ("b.c.net", "/", "block"), ("net", "/q", "block")] + [(f"h{i}.org", "/", "block") for i in range(300)]
    urls = [None, "", "a.com/x", "http://A.com/x?y=://b/c", "http://z.a.com/xy", "http://aa.com/x", "https://a.com/x/y/z#f", "ftp://B.C.NET/", "http://c.net/qq", "http://net", "://h7.org/x", "http://\u0130.h8.org/\n", "http://h9.org", "x://y://h9.org/"] + ["http://hot.com/x"] * 500
    pages = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()}
    assert got == {i: brute_rule(u, rules) for i, u in enumerate(urls)}
    none = url_filter.judge(pages, spark.createDataFrame([], "host string, path string, verdict string"))
    assert {r.verdict for r in none.collect()} == {"allow"} and none.count() == len(urls)
    assert url_filter.judge(pages.limit(0), spark.createDataFrame(rules, "host string, path string, verdict string")).count() == 0


def test_mixed_rows_of_equal_ids_keep_their_columns(spark):
    rows = [(1, "a b", "x", "en", {"k": 1}), (1, "a b", "x", "de", {"k": 2}), (2, "c d e", "y", "fr", {}), (2, "c d e", "y", "fr", {}), (None, "f g", None, "es", {}), (3, None, "y", "fr", {})]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, position string, d map<string,int>")
    got = mixing.mixed_documents(docs, Scratch(spark))
    assert got.columns == docs.columns
    counts = {}
    for r in got.collect():
        counts[r.doc_id, r.position] = counts.get((r.doc_id, r.position), 0) + 1
    assert {(1, "en"), (1, "de"), (2, "fr")} <= counts.keys() and (3, "fr") not in counts
    words = {(i, p): len(t.split()) for i, t, _, p, _ in rows if t}
    takes = mixing.mix(docs, Scratch(spark)).selectExpr("explode(filter(takes, t -> t.words * 2 >= size)) AS t").count()
    assert sum(counts.values()) == takes and counts.keys() <= words.keys()
    assert sorted(map(str, got.collect())) == sorted(map(str, mixing.mixed_documents(docs.repartition(3), Scratch(spark)).collect()))
