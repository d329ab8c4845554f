"""Token arrays: cut, masked, padded by batch, and labelled from the response on. Built-in functions throughout."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import fresh
from ..functions.text import characters, let, words

IGNORED = -100


class Tokenizer(Protocol):
    pad: int

    def ids(self, text: Column) -> Column: ...


class CharacterTokenizer:
    """Code points modulo 255; padding is 0."""

    pad = 0

    def ids(self, text: Column) -> Column:
        return F.transform(characters(text), lambda c: F.ascii(c) % 255)


class WordTokenizer:
    """Words by hash, from 1 on; padding is 0."""

    pad = 0

    def __init__(self, size: int = 1 << 20) -> None:
        self.size = size

    def ids(self, text: Column) -> Column:
        return F.transform(words(text), lambda w: (F.pmod(F.xxhash64(w), F.lit(self.size - 1)) + 1).cast("int"))


class VocabularyTokenizer:
    """Any encoder of texts, made once a worker by ``make``; batches travel by Arrow."""

    def __init__(self, make, pad: int = 0) -> None:
        self.pad = pad

        def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            encoder = make()
            for texts in batches:
                yield texts.fillna("").map(encoder)

        self._encode = F.pandas_udf(encode, "array<int>")

    def ids(self, text: Column) -> Column:
        return self._encode(text)


class SubwordTokenizer:
    """A vocabulary file whose pre-tokenizer never joins across white space: a text's ids are those of its words in turn.

    Texts travel in Arrow batches and a worker encodes each distinct word once, so frequent words cost a look-up, and none is shuffled.
    """

    #: Words that a worker keeps before it starts anew. Results don't depend on it.
    words_most = 200_000
    #: Texts that are split, and words that are encoded, at a time.
    texts_most, block = 256, 4096

    def __init__(self, path: str, pad: int = 0) -> None:
        self.path, self.pad = path, pad

    @classmethod
    def padded_by(cls, path: str, end: str, pad: str | None = None) -> SubwordTokenizer:
        """With the id of ``pad`` for padding or, where the vocabulary has none of that name, that of the ``end`` token."""
        from tokenizers import Tokenizer

        vocabulary = Tokenizer.from_file(path)
        ids = [i for i in (pad and vocabulary.token_to_id(pad), vocabulary.token_to_id(end)) if i is not None]
        if not ids:
            raise ValueError(f"the vocabulary has neither {pad} nor {end}")
        return cls(path, ids[0])

    def _over(self, batches: Iterator[pd.Series], of, use) -> Iterator[pd.Series]:
        """``use`` of what ``of`` keeps of each word's ids, text by text."""
        from tokenizers import Tokenizer

        tokenizer, known = Tokenizer.from_file(self.path), {}
        for texts in batches:
            out = []
            for at in range(0, len(texts), self.texts_most):
                # White space of ASCII only: the rest is left to the vocabulary's own rules.
                split = [t.encode().split() if t else [] for t in texts.iloc[at : at + self.texts_most]]
                distinct = {w for ws in split for w in ws}
                new = list(distinct.difference(known))
                if len(known) + len(new) > self.words_most:
                    known.clear()
                    new = list(distinct)
                for k in range(0, len(new), self.block):
                    some = new[k : k + self.block]
                    known.update(zip(some, (of(e.ids) for e in tokenizer.encode_batch_fast([w.decode() for w in some], add_special_tokens=False))))
                out += [use(map(known.__getitem__, ws)) for ws in split]
            yield pd.Series(out, dtype=object)

    def ids(self, text: Column) -> Column:
        def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            return self._over(batches, tuple, lambda found: list(chain.from_iterable(found)))

        return F.pandas_udf(encode, "array<int>")(text)

    def count(self, text: Column) -> Column:
        """How many ids a text has; none for null."""

        def number(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            return self._over(batches, len, sum)

        return F.pandas_udf(number, "bigint")(text)


def cut(ids: Column, most: int, pad: int = 0) -> Column:
    """The first ``most`` ids; one padding id for an empty text."""
    some = F.slice(ids, 1, most)
    return F.when(F.size(some) == 0, F.array(F.lit(pad))).otherwise(some)


def mask_of(ids: Column, pad: int = 0) -> Column:
    return F.transform(ids, lambda x: F.when(x == pad, 0).otherwise(1))


def mended(mask: Column, ids: Column, pad: int = 0) -> Column:
    """A mask as long as the ids: derived where missing, else cut or filled up with ones."""
    more = F.greatest(F.size(ids) - F.size(mask), F.lit(0))
    return F.when(mask.isNull(), mask_of(ids, pad)).otherwise(F.slice(F.concat(mask, F.array_repeat(F.lit(1), more)), F.lit(1), F.size(ids)))


def padded(ids: Column, length: Column, pad: int = 0) -> Column:
    return F.concat(ids, F.array_repeat(F.lit(pad), F.greatest(length - F.size(ids), F.lit(0))))


def response_start(ids: Column, template: list[int]) -> Column:
    """Position from 0 just after the first occurrence of the template; the length if there is none. Only where the template's first id stands is the rest compared."""
    n, k = F.size(ids), len(template)
    tpl = F.array(*map(F.lit, template))
    at = F.filter(F.transform(ids, lambda x, i: F.when((x == template[0]) & (i <= n - k), i)), lambda i: i.isNotNull())
    hits = F.filter(at, lambda i: F.slice(ids, i + 1, F.lit(k)) == tpl)
    return F.coalesce(F.get(hits, F.lit(0)) + k, n)


def labels(ids: Column, template: list[int], pad: int = 0) -> Column:
    """The ids from the response on; before it, and for padding, IGNORED."""
    # The start is found once a row; inside the lambda it would be for every id.
    marked = lambda start: F.transform(ids, lambda x, i: F.when((i < start) | (x == pad), F.lit(IGNORED)).otherwise(x))
    return let(response_start(ids, template), marked)


def collate(rows: DataFrame, batch: str, template: list[int], pad: int = 0) -> DataFrame:
    """input_ids, attention_mask and labels of equal length within each batch; rows without ids are left out, and a batch of nothing else ends the job with its name."""
    if not template:
        raise ValueError("the response template needs at least one id")
    n, = fresh(rows, "n", also=["attention_mask", "labels"])
    size = F.greatest(F.coalesce(F.size("input_ids"), F.lit(0)), F.lit(0))
    # The check is part of the filter over the same window that finds the batch's length, so it takes no pass of its own.
    empty = F.raise_error(F.concat(F.lit("no row has ids in batch "), F.coalesce(F.col(batch).cast("string"), F.lit("null")))).cast("boolean")
    kept = rows.withColumn(n, F.max(size).over(Window.partitionBy(batch))).where(F.when(F.col(n) == 0, empty).otherwise(size > 0))
    mask = mended(F.col("attention_mask"), F.col("input_ids"), pad) if "attention_mask" in rows.columns else mask_of(F.col("input_ids"), pad)
    wide = kept.withColumn("attention_mask", mask).withColumns({"input_ids": padded(F.col("input_ids"), F.col(n), pad), "attention_mask": padded(F.col("attention_mask"), F.col(n), 0)})
    return wide.withColumn("labels", labels(F.col("input_ids"), template, pad)).drop(n)


def tokenize(df: DataFrame, tokenizer: Tokenizer, column: str = "text", most: int = 2048) -> DataFrame:
    ids = cut(tokenizer.ids(F.coalesce(F.col(column), F.lit(""))), most, tokenizer.pad)
    return df.withColumn("input_ids", ids).withColumn("attention_mask", F.transform("input_ids", lambda _: F.lit(1)))
