import hashlib
import random
import struct
import zlib

from pyspark.sql import functions as F

from convmill.llm import fingerprints as fp
from convmill.llm import media, queries

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, fingerprint string, media string"
ODD = [(None, None), (None, "x"), (1, ""), (2, "aé😀" * 5), (2, "aé😀" * 5), (2, "b"), (3, "word " * 60000), (9, "end"), (10, "\0 zero")]


def odd(spark):
    return spark.createDataFrame([(*r, "en", "mine", None) for r in ODD], DOC)


def test_prefix_hash_spans_and_extensions():
    rng = random.Random(3)
    s = "".join(rng.choice("ab😀") for _ in range(300))
    t = s[:120] + "Z" + s[120:]
    a, b = fp.PrefixHash(s), fp.PrefixHash(t)
    for _ in range(300):
        i, j = rng.randrange(300), rng.randrange(301)
        n = rng.randrange(0, min(300 - i, 301 - j) + 1)
        assert a.same(i, b, j, n) == (s[i : i + n] == t[j : j + n])
        k = 0
        while i + k < 300 and j + k < 301 and s[i + k] == t[j + k]:
            k += 1
        assert a.extension(i, b, j) == k


def test_blocks_do_not_change_hashes(monkeypatch):
    text = "".join(chr(97 + i * i % 26) for i in range(5000))
    want = fp.fingerprint(text)
    value = sum((ord(c) + 1) * pow(fp.BASES[0], i, fp.P) for i, c in enumerate(text)) % fp.P
    assert want.split(":")[1][:8] == f"{value:08x}"
    fp.powers.cache_clear()
    monkeypatch.setattr(fp, "BLOCK", 64)
    assert fp.fingerprint(text) == want
    fp.powers.cache_clear()


class Plain(fp.PrefixHash):
    """The same by comparing code points."""

    def same(self, i, other, j, n):
        return bool((self.codes[i : i + n] == other.codes[j : j + n]).all())


def plain_likeness(x, y):
    a, b = fp.Fingerprint(x), fp.Fingerprint(y)
    a.hash, b.hash = Plain(x), Plain(y)
    return a.likeness(b)


def test_extensions_to_the_left():
    rng = random.Random(5)
    s = "".join(rng.choice("ab") for _ in range(200))
    a, b = fp.PrefixHash(s), fp.PrefixHash("Q" + s[40:])
    for _ in range(200):
        i, j = rng.randrange(201), rng.randrange(162)
        k = 0
        while k < min(i, j) and s[i - k - 1] == ("Q" + s[40:])[j - k - 1]:
            k += 1
        assert a.extension_left(i, b, j) == k and a.extension_left(i, b, j, 3) == min(k, 3)


def test_likeness_counts_shared_passages_at_any_offset():
    rng = random.Random(1)
    words = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(n))
    a, b, c = words(300), words(300), words(60)
    near = lambda x, y: fp.Fingerprint(x).likeness(fp.Fingerprint(y))
    assert near(a, a) == near("", "") == 1.0 and near(a, "") == 0.0 and near("qqqq", "zzzz") == 0.0
    assert near(a, "x" + a) > 0.99 and near("x" + a + "y", "z" + a + "w") > 0.99
    assert near(a, a[: len(a) // 2] + "!" + a[len(a) // 2 :]) > 0.99
    assert near(a, b) < 0.1 and len(c) / (len(a) + len(c)) - 0.02 < near(a[:500] + c + a[500:], b[:900] + c + b[900:]) < 0.35
    assert 0.9 < near(a[700:] + a[:700], a) <= 1
    # What occurs once in one text is shared once.
    assert near("word " * 400, "word " * 100) <= 0.26
    assert fp.estimate(fp.fingerprint(a), fp.fingerprint("x" + a)) > 0.9 and fp.estimate(fp.fingerprint(a), fp.fingerprint(b)) < 0.1
    for n in (1, 5, 40, 2500):
        spans = fp.Fingerprint(a[:n])
        assert spans.ends[-1] == min(n, len(a)) and (n < 100 or 10 < len(a[:n]) / len(spans.spans) < 100)


def brute(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    return {(i, hashlib.sha256((t[: len(t) - len(t) // 2] + rows[(k + 1) % len(rows)][1][: len(t) // 2]).encode()).hexdigest()) for k, (i, t) in enumerate(rows)}


def test_fingerprint_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = queries.op3_fingerprints(spark, SF).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {(r.doc_id, r.edited_sha256) for r in rows} == brute(texts.items()) and len(rows) == len(texts)
    after = {i: texts[j] for i, j in zip(sorted(texts), [*sorted(texts)[1:], min(texts)])}
    for r in rows:
        own, following = texts[r.doc_id], after[r.doc_id]
        edited = own[: len(own) - len(own) // 2] + following[: len(own) // 2]
        assert r.fingerprint == fp.fingerprint(own) and r.n_chars == len(own) and r.edited_fingerprint == fp.fingerprint(edited)
        assert r.near_next == plain_likeness(own, following) and r.near_edited == plain_likeness(own, edited)
        assert 0 <= r.near_next <= 1 and (len(own) - len(own) // 2) / max(1, len(own)) - 1e-3 <= r.near_edited <= 1


def test_fingerprint_odd_rows(spark):
    rows = fp.compare(odd(spark)).collect()
    assert sorted((r.doc_id or 0, r.n_chars) for r in rows) == sorted((i or 0, len(t or "")) for i, t in ODD)
    unique = [r for r in ODD if r[0] not in (2, None)]
    one = fp.compare(spark.createDataFrame(unique, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.edited_sha256) for r in one} == brute(unique)
    lone = fp.compare(odd(spark).where("doc_id = 9")).collect()
    assert [r.near_next for r in lone] == [1.0]
    assert fp.compare(odd(spark).limit(0)).count() == 0


def png(n=3):
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", n, n, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(bytes(n * n + n))) + chunk(b"IEND", b"")


GIF = b"GIF89a\x01\0\x01\0\x80\0\0\0\0\0\xff\xff\xff,\0\0\0\0\x01\0\x01\0\0\x02\x02D\x01\0;"
JPEG = b"\xff\xd8\xff\xe0\0\x04ab\xff\xda\0\x03ZxxBMxx\xff\0y\xff\xd9"
BMP = b"BM" + struct.pack("<IIIIiiHHIIiiII", 62, 0, 54, 40, 2, 1, 1, 24, 0, 8, 0, 0, 0, 0) + bytes(8)
PDF = b"%PDF-1.4\nbody\n%%EOF"


def test_sniffing_confirms_corrects_and_carves(spark):
    cases = [(k, m + b"tail", "text/plain") for k, m in (("image/png", png()), ("image/gif", GIF), ("image/jpeg", JPEG), ("image/bmp", BMP), ("application/pdf", PDF), ("audio/wav", media.as_wav(b"abc")))]
    df = spark.createDataFrame([(k, bytearray(m), d) for k, m, d in cases] + [("right", bytearray(GIF), "image/gif"), ("cut", bytearray(png()[:-5]), "image/png"), ("none", None, "x"), ("empty", bytearray(), None), ("inside", bytearray(b"text " + png() + b"BM no" + GIF), "application/octet-stream")], "name string, media binary, declared_type string")
    got = {r.name: r for r in media.sniff(df).collect()}
    for k, m, _ in cases:
        assert (got[k].detected_type, got[k].corrected, got[k].true_length) == (k, True, len(m) - 4), k
    assert got["right"].corrected is False and got["cut"].detected_type is None and got["cut"].media_type == "image/png"
    assert got["none"].media_type == "x" and got["empty"].detected_type is None
    assert [(c.type, c.offset, c.length) for c in got["inside"].carved] == [("image/png", 5, len(png())), ("image/gif", 5 + len(png()) + 5, len(GIF))]


def check_media(rows, texts):
    assert len(rows) == len(texts)
    want = {}
    for i, t in texts:
        b = (t or "").encode()
        p = b + b"\xff" * ((-len(b)) % 576 if b else 576)
        want[hashlib.sha256(p).hexdigest()] = (len(b), len(p), zlib.crc32(p[-32:]), len(p) + 44)
    for r in rows:
        assert want[r.payload_sha256] == (r.n_bytes, r.payload_bytes, r.tail_crc32, r.media_bytes)
        assert "type=audio/wav;corrected=1" in r.feature


def test_media_query_round_trip(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check_media(queries.op4_media(spark, SF).collect(), texts)


def test_media_odd_rows(spark):
    run = lambda d: media.digest(media.sniff(media.stored(d)))
    check_media(run(odd(spark)).collect(), ODD)
    assert run(odd(spark).limit(0)).count() == 0
    assert run(odd(spark).withColumn("doc_id", F.lit(None).cast("long"))).count() == len(ODD)


def test_one_pass_equals_the_three_operators(spark):
    rows = lambda df: sorted(map(str, df.collect()))
    for docs in (odd(spark), spark.read.parquet(f"{SF}/documents.parquet")):
        assert rows(media.stored_digest(docs)) == rows(media.digest(media.sniff(media.stored(docs))))


def test_many_signatures_without_an_end_take_linear_time():
    import time

    began = time.time()
    assert media.sniffed(b"%PDF-1.4 " * 300_000, None, media.automaton())["carved"] == []
    assert time.time() - began < 20
