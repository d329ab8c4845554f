"""Packing by power-of-two decomposition.

A document's ids, with an end id, are cut into full sequences and, of the rest, one piece per
set bit of its length. Pieces of equal length share a bucket and each is a sequence of its own,
so no sequence crosses documents and none has padding.

Defined results. Null or empty text: one piece, the end id alone. Empty table: empty result. Repeated
rows: each gets pieces and sequences of its own. Very long texts: cut like any other, one
document's ids in memory at a time. Extra columns are dropped.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, arrow_batches, running

MAX_LENGTH = 2048
END_ID = 1
#: Words whose ids a worker keeps; beyond that it starts anew. A cache only: results don't depend on it.
CACHE_WORDS = 500_000
#: Letters that lower-case one by one and have no decomposed form to mind: a-z and those of Latin-1.
_LETTERS = re.compile("[a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
#: The characters that stand for bytes in byte-level vocabularies: printable ones for themselves, the others from 256 on, in order.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_FORMS = {b: 256 + i for i, b in enumerate(x for x in range(256) if x not in _PRINTABLE)}
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def cuts(total: int, longest: int = MAX_LENGTH) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``total`` ids: full ones, then the set bits of the rest, high to low."""
    out, start = [], 0
    while total - start >= longest:
        out.append((start, longest))
        start += longest
    rest = total - start
    for bit in range(rest.bit_length() - 1, -1, -1):
        if rest >> bit & 1:
            out.append((start, 1 << bit))
            start += 1 << bit
    return out


class WordEncoder:
    """Ids of texts as little-endian 32-bit bytes, one white-space-free chunk at a time.

    The vocabulary's pre-tokenizer never joins characters across white space, its normalizer
    lower-cases and otherwise changes characters within a chunk only, so a text's ids are those
    of its lower-cased chunks in turn. A full stop or comma after an ASCII letter is a token run of its own, so
    such a chunk is its stem and that mark. Only stems not met lately are encoded. A text that may spell a special token is encoded as it stands.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}

    def _learn(self, chunks: list[bytes]) -> None:
        """Chunks of Latin letters alone are one token run of known form and go to the vocabulary's model directly; others take the whole way."""
        known, model, others = self.known, self.tokenizer.model, []
        for c in chunks:
            text = c.decode("utf-8", "replace")
            if _LETTERS.fullmatch(text):
                form = text if text.isascii() else text.lower().encode().decode("latin-1").translate(_FORMS)
                known[c] = array("I", [t.id for t in model.tokenize(form)]).tobytes()
            else:
                others.append((c, text))
        for i in range(0, len(others), 4096):
            some = others[i : i + 4096]
            # One encoding of many chunks, told apart by their offsets: far less overhead than one call each.
            starts, at = [], 0
            for _, t in some:
                starts.append(at)
                at += len(t) + 1
            enc = self.tokenizer.encode(" ".join(t for _, t in some), add_special_tokens=False)
            ids = np.array(enc.ids, "<u4")
            cut = np.searchsorted(np.array([a for a, _ in enc.offsets], np.int64), starts)
            packed, cut = ids.tobytes(), [*(4 * cut).tolist(), 4 * len(ids)]
            known.update(zip((c for c, _ in some), [packed[a:b] for a, b in zip(cut, cut[1:])]))

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        for text in texts:
            if b"<|" in text:
                yield np.array(self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids, "<u4").tobytes()
                continue
            known, words = self.known, text.lower().split()
            missing = set(words).difference(known)
            if len(known) + len(missing) > CACHE_WORDS:
                known.clear()
                missing = set(words)
            if missing:
                marked = [w for w in missing if w[-1] in b".," and 97 <= w[-2:][0] <= 122]
                stems = missing.difference(marked).union([w[:-1] for w in marked], (b".", b",")).difference(known)
                self._learn(list(stems))
                known.update([(w, known[w[:-1]] + known[w[-1:]]) for w in marked])
            yield b"".join(map(known.__getitem__, words))


def pieces(docs: DataFrame, vocabulary: str, longest: int = MAX_LENGTH, end_id: int = END_ID) -> DataFrame:
    end = end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(vocabulary)
        for batch in batches:
            rows: dict[str, list] = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")}
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode([x or b"" for x in batch.column(1).to_pylist()])):
                ids += end
                total = len(ids) // 4
                for start, length in cuts(total, longest):
                    for k, v in zip(rows, (doc_id, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), total)):
                        rows[k].append(v)
            yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in rows.items()})

    arrow_batches(docs.sparkSession)
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(cut, PIECES)


def pack(docs: DataFrame, vocabulary: str, scratch: Scratch) -> DataFrame:
    """One row per piece, with its sequence: buckets by length in turn, gapless ids within and across them."""
    cut = scratch.put(pieces(docs, vocabulary))
    longest_first = Window.orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    # At most 12 rows: one per power of two.
    base = cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).select("length", F.coalesce(F.sum("n").over(longest_first), F.lit(0)).alias("base"))
    ranked = running(cut.withColumn("one", F.lit(1).cast("long")), ["length"], ["doc_id", "start", "ids_crc32"], "one", "rank")
    return ranked.join(F.broadcast(base), "length").select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("base") + F.col("rank")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
