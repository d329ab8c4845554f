"""Seeded draws: every random choice is the md5 of a seed, a row key and a purpose, so results depend neither on partitioning nor on the run."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def digest(seed: str, *key: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(seed), *(k.cast("string") for k in key)))


def draw(seed: str, *key: Column) -> Column:
    """A number from 0 to 2^32 - 1."""
    return F.conv(F.substring(digest(seed, *key), 1, 8), 16, 10).cast("bigint")


def index(n: int | Column, seed: str, *key: Column) -> Column:
    """A number from 0 to n - 1."""
    return draw(seed, *key) % n


def choice(pool: Column, seed: str, *key: Column) -> Column:
    return F.element_at(pool, (index(F.size(pool), seed, *key) + 1).cast("int"))


def gate(percent: int, seed: str, *key: Column) -> Column:
    """True with this probability."""
    return index(100, seed, *key) < percent


def weighted(labels: dict[str, int], seed: str, *key: Column) -> Column:
    """A label by integer weights; those of weight 0 are never drawn."""
    at, total, out = index(sum(labels.values()), seed, *key), 0, None
    for label, weight in labels.items():
        total += weight
        if weight:
            out = F.when(at < total, F.lit(label)) if out is None else out.when(at < total, F.lit(label))
    return out


def shuffled(pool: Column, seed: str, *key: Column) -> Column:
    """The pool's items in a drawn order; its first k are a sample without replacement."""
    marked = F.transform(pool, lambda x, i: F.struct(digest(seed, *key, i).alias("h"), i.alias("i"), x.alias("x")))
    return F.transform(F.array_sort(marked), lambda s: s["x"])


def strings(values: list[str]) -> Column:
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")
