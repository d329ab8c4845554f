"""Distributions and diversity of texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import draw as D
from ..functions.text import words
from .curate import ranked

PAIRS_MOST = 10_000


def distribution(df: DataFrame, *fields: str, missing: str | None = None) -> DataFrame:
    """field, value, n for each of the fields, in one pass of grouping sets; null values are left out, or counted as ``missing``."""
    sets = df.select(*(F.coalesce(F.col(f).cast("string"), F.lit(missing)).alias(f) if missing is not None else F.col(f).cast("string").alias(f) for f in fields))
    grouped = sets.groupingSets([[F.col(f)] for f in fields], *(F.col(f) for f in fields)).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("_g"))
    one = [F.when(F.col("_g") == ((1 << len(fields)) - 1) ^ (1 << (len(fields) - 1 - i)), F.struct(F.lit(f).alias("field"), F.col(f).alias("value"))) for i, f in enumerate(fields)]
    return grouped.select(F.coalesce(*one).alias("_v"), "n").select("_v.field", "_v.value", "n").where("value IS NOT NULL")


def jaccard(a: Column, b: Column) -> Column:
    """Likeness of the word sets; null if both are empty."""
    x, y = F.array_distinct(words(a)), F.array_distinct(words(b))
    return F.try_divide(F.size(F.array_intersect(x, y)).cast("double"), F.size(F.array_union(x, y)).cast("double"))


def drawn_pairs(df: DataFrame, field: str, key: list[str], most: int = PAIRS_MOST, seed: str = "pairs") -> DataFrame:
    """draw, a, b: min(n(n-1)/2, ``most``) pairs of different rows; indices are drawn and met by equal rank, never all against all."""
    numbered = ranked(df.select(*key, F.col(field).alias("_text")), key, f"{seed}-rows", "_rank").select("_rank", "_text")
    n = df.count()
    count = min(n * (n - 1) // 2, most)
    i = D.index(max(n, 1), f"{seed}-a", F.col("id"))
    j = D.index(max(n - 1, 1), f"{seed}-b", F.col("id"))
    drawn = df.sparkSession.range(count).select(F.col("id").alias("draw"), (i + 1).alias("_i"), (F.when(j >= i, j + 1).otherwise(j) + 1).alias("_j"))
    left = drawn.join(numbered.select(F.col("_rank").alias("_i"), F.col("_text").alias("a")), "_i")
    return left.join(numbered.select(F.col("_rank").alias("_j"), F.col("_text").alias("b")), "_j").select("draw", "a", "b")


def diversity(df: DataFrame, field: str, key: list[str], threshold: float = 0.7, most: int = PAIRS_MOST, keep_empty: bool = False, seed: str = "pairs") -> DataFrame:
    """One row: field, unique_ratio, avg_jaccard, is_diverse (below the threshold).

    Empty values are left out, and then nothing left means not diverse; with ``keep_empty`` they count, pairs of two empty texts
    are left out of the mean, and nothing at all means diverse.
    """
    rows = df.where(F.col(field).isNotNull()) if keep_empty else df.where(F.coalesce(F.col(field), F.lit("")) != "")
    unique = rows.agg(F.count_distinct(field).alias("u"), F.count(field).alias("n"))
    like = jaccard(F.col("a"), F.col("b"))
    pairs = drawn_pairs(rows, field, key, most, seed).agg(F.avg(like if keep_empty else F.coalesce(like, F.lit(0.0))).alias("j"))
    # Two tables of one row each.
    both = unique.join(F.broadcast(pairs), F.lit(True))
    mean = F.coalesce("j", F.lit(0.0))
    return both.select(F.lit(field).alias("field"), F.coalesce(F.try_divide(F.col("u").cast("double"), F.col("n").cast("double")), F.lit(0.0)).alias("unique_ratio"), mean.alias("avg_jaccard"), F.when(F.col("n") == 0, F.lit(keep_empty)).otherwise(mean < threshold).alias("is_diverse"))


def diversity_report(df: DataFrame, fields: list[str], key: list[str], **options) -> DataFrame:
    out = None
    for f in fields:
        row = diversity(df, f, key, **options)
        out = row if out is None else out.unionByName(row)
    return out
