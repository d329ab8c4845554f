"""Dedup, sampling, splits and review flags that don't depend on partitioning.

Exact sizes need ranks over all rows. Ranks by a drawn digest are found without a single task holding all rows: digests are
dealt into prefix buckets, bucket counts give offsets, and a window ranks within one bucket only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import draw as D
from ..functions.names import fresh

#: Leading hex digits of a digest that make a bucket.
DIGITS = 3


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row for each combination of ``keys`` (null differs from empty): the first by ``order``, of ties the first by all columns as JSON.

    Keys are compared by a SHA-256 of their JSON form, so the aggregation shuffles digests and order columns only, and a hot key is
    reduced before the shuffle.
    """
    own, mine, theirs, first, whole = fresh(df, "d", "mine", "digest", "first", "row")
    digest = F.sha2(F.to_json(F.struct(*keys)), 256)
    least = F.min(order[0]) if len(order) == 1 else F.min(F.struct(*order))
    firsts = df.select(digest.alias(theirs), *order).groupBy(theirs).agg(least.alias(first))
    kept = df.withColumns({own: digest, mine: F.col(order[0]) if len(order) == 1 else F.struct(*order)})
    kept = kept.join(firsts, (F.col(own) == F.col(theirs)) & F.col(mine).eqNullSafe(F.col(first)), "left_semi")
    # Ties, equal rows among them, are reduced before any shuffle, so often repeated ones never meet.
    row = F.struct(*(F.col(f"`{c}`") for c in df.columns))
    return kept.groupBy(own).agg(F.min_by(row, F.to_json(row)).alias(whole)).select(f"{whole}.*")


def ranked(df: DataFrame, key: list[str], seed: str, out: str = "rank") -> DataFrame:
    """``out``: 1 to n in the order of md5(seed, key), then the key itself. ``df`` is read twice."""
    hashed, bucket, off = fresh(df, "h", "b", "off", also=[out])
    marked = df.withColumn(hashed, D.digest(seed, *map(F.col, key))).withColumn(bucket, F.left(hashed, F.lit(DIGITS)))
    before = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = marked.groupBy(bucket).agg(F.count(F.lit(1)).alias("n")).select(bucket, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(off))
    # At most 4,096 rows of offsets.
    return marked.join(F.broadcast(offsets), bucket).withColumn(out, F.col(off) + F.row_number().over(Window.partitionBy(bucket).orderBy(hashed, *key))).drop(hashed, bucket, off)


def sample(df: DataFrame, n: int, key: list[str], seed: str = "sample") -> DataFrame:
    """``n`` rows without replacement, or all if there are fewer."""
    if n < 0:
        raise ValueError("a sample has 0 rows or more")
    rank, = fresh(df, "rank", also=["split", "review", "draw"])
    return ranked(df, key, seed, rank).where(F.col(rank) <= n).drop(rank)


def sample_with_replacement(df: DataFrame, n: int, key: list[str], seed: str = "resample") -> DataFrame:
    """``n`` rows, each drawn from all: column ``draw`` is 0 to n - 1; empty if there is nothing to draw from."""
    rank, = fresh(df, "rank", also=["split", "review", "draw"])
    numbered = ranked(df, key, f"{seed}-rows", rank)
    total = df.count()
    drawn = df.sparkSession.range(n if total else 0).select(F.col("id").alias("draw"), (D.index(max(total, 1), seed, F.col("id")) + 1).alias(rank))
    return drawn.join(numbered, rank).drop(rank)


def split(df: DataFrame, share: float, key: list[str], seed: str = "split", guard: bool = True) -> DataFrame:
    """``split``: exactly ceil(share * n) rows are ``validation``, the rest ``train``; with ``guard`` fewer than two rows are all ``train``."""
    if not 0 <= share <= 1:
        raise ValueError("the validation share lies between 0 and 1")
    n = df.count()
    held = 0 if guard and n < 2 else -int(-n * share // 1)
    rank, = fresh(df, "rank", also=["split", "review", "draw"])
    return ranked(df, key, seed, rank).withColumn("split", F.when(F.col(rank) <= held, "validation").otherwise("train")).drop(rank)


def flag_for_review(df: DataFrame, share: float, key: list[str], column: str, edit: Column, seed: str = "review") -> DataFrame:
    """``review``: max(1, floor(share * n)) drawn rows, in which ``column`` becomes ``edit``; none for a share of 0."""
    if not 0 <= share <= 1:
        raise ValueError("the review share lies between 0 and 1")
    n = df.count()
    count = max(1, int(n * share)) if n and share > 0 else 0
    rank, = fresh(df, "rank", also=["split", "review", "draw"])
    flagged = ranked(df, key, seed, rank).withColumn("review", F.col(rank) <= count).drop(rank)
    return flagged.withColumn(column, F.when(F.col("review"), edit).otherwise(F.col(column)))


def length_bucketed(df: DataFrame, ids: str, parts: int) -> DataFrame:
    """Rows of like length together: ranges of the length over the partitions, sorted within."""
    return df.repartitionByRange(parts, F.size(ids)).sortWithinPartitions(F.size(ids))


def batched(df: DataFrame, ids: str, key: list[str], budget: int, step: int = 8, seed: str = "batch") -> DataFrame:
    """``df`` plus batch_id (from 0, without gaps): rows of like length together, as many as fit ``budget`` ids when padded to a multiple of ``step``.

    Batches ascend in length and are the same however the table is dealt: among equal lengths rows stand by md5(seed, key). Ranks come from the
    counts of each length and digest prefix, so no task holds a length's rows, however many. Null and empty ids count as one id; a row
    longer than the budget is a batch of its own. An empty table gives an empty one.
    """
    if budget < 1 or step < 1:
        raise ValueError("the budget and the step are 1 or more")
    n, wide, hashed, prefix, rank, first = fresh(df, "n", "wide", "hashed", "prefix", "rank", "first", also=["batch_id"])
    length = F.greatest(F.coalesce(F.size(ids), F.lit(1)), F.lit(1))
    padded = F.ceil(length / step) * step
    per = F.greatest(F.floor(F.lit(budget) / F.col(wide)), F.lit(1))
    marked = df.withColumns({n: length, wide: padded.cast("bigint"), hashed: D.digest(seed, *map(F.col, key))}).withColumn(prefix, F.left(hashed, F.lit(DIGITS)))
    counts = marked.groupBy(wide, n, prefix).agg(F.count(F.lit(1)).alias("rows"))
    before = lambda *parts: Window.partitionBy(*parts).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(wide, n, prefix, F.coalesce(F.sum("rows").over(before(wide).orderBy(n, prefix)), F.lit(0)).alias(rank))
    # One row for each padded length.
    widths = counts.groupBy(wide).agg(F.sum("rows").alias("rows")).select(wide, F.coalesce(F.sum(F.ceil(F.col("rows") / per)).over(before().orderBy(wide)), F.lit(0)).alias(first))
    inside = Window.partitionBy(n, prefix).orderBy(hashed, *key)
    placed = marked.join(offsets.drop(wide), [n, prefix]).withColumn(rank, F.col(rank) + F.row_number().over(inside) - 1)
    out = placed.join(F.broadcast(widths), wide).withColumn("batch_id", (F.col(first) + F.floor(F.col(rank) / per)).cast("bigint"))
    return out.drop(n, wide, hashed, prefix, rank, first)


def has_fields(fields: list[str]) -> Column:
    out = F.lit(True)
    for f in fields:
        out = out & F.col(f).isNotNull()
    return out


def drop_blank(df: DataFrame, column: str = "text", name: str | None = None) -> DataFrame:
    """Without rows whose text is null or white space; with ``name``, counts are observed under it as kept and dropped."""
    from ..functions.text import stripped

    blank = F.coalesce(stripped(F.col(column)) == "", F.lit(True))
    if name:
        df = df.observe(name, F.count(F.when(~blank, 1)).alias("kept"), F.count(F.when(blank, 1)).alias("dropped"))
    return df.where(~blank)
