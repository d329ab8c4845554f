"""Mixing sources to target weights along a time-varying curriculum.

Each source gets a token target by weight. Its weight over training time is piecewise linear
(``SCHEDULES``); the integral of that schedule, scaled to the target, is the source's cumulative
demand. The source's documents, in a keyed order, fill that demand one pass after another; the
inverse of the demand at a document's middle is its training position in [0, 1], by which
``training_order`` range-sorts.

Defined results. Null text: size 0, taken 0. A null source is a source of its own, ranked last. Empty
table: empty result. Repeated rows: each is a document of its own; ties in the keyed order are
between rows equal in id, size and text hash. A source without words: target 0. The document at
the end of a source's target is taken in part. Extra columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, hot_keys, running, salted_join

#: Weights of the sources in turn, by code point of their names.
WEIGHTS = (5, 2, 1)
SHARE_OF_ALL = 1.5
MAX_PASSES = 2
#: Weight schedules of the sources in turn: (time, weight) knots from 0 to 1; fading, even, rising.
SCHEDULES = (
    ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.25), (0.75, 1.0), (1.0, 2.0)),
)


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE_OF_ALL, most: float = MAX_PASSES) -> DataFrame:
    """source, source_size -> also rank, target.

    Targets are proportional to weight and stop at ``most`` times the source's size; the excess
    is reshared by weight until none is above. That ends at one level L with target
    min(most * size, L * weight): in order of size / weight, a source is capped while the level
    left to it and those after it reaches its cap. One slim row per source.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    ranked = sizes.withColumn("rank", F.row_number().over(by_name) - 1)
    ranked = ranked.withColumn("w", F.element_at(F.array(*(F.lit(float(x)) for x in weights)), (F.col("rank") % len(weights) + 1).cast("int"))).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    everything = Window.partitionBy()
    ascending = Window.orderBy(F.col("cap") / F.col("w"), "rank")
    before = ascending.rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranked.withColumns({"budget": F.sum("source_size").over(everything) * F.lit(float(share)), "all_w": F.sum("w").over(everything), "cap_before": F.coalesce(F.sum("cap").over(before), F.lit(0.0)), "w_before": F.coalesce(F.sum("w").over(before), F.lit(0.0))})
    ranked = ranked.withColumn("capped", F.col("cap") / F.col("w") <= (F.col("budget") - F.col("cap_before")) / (F.col("all_w") - F.col("w_before")))
    level = (F.col("budget") - F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0.0)).over(everything)) / F.nullif(F.sum(F.when(F.col("capped"), 0.0).otherwise(F.col("w"))).over(everything), F.lit(0.0))
    return ranked.withColumn("target", F.when(F.col("capped"), F.col("cap")).otherwise(level * F.col("w"))).select("source", "source_size", "rank", "target")


def _knots(schedules: tuple) -> Column:
    """Per schedule: segments with start time, start weight, slope, width, integral before; and the whole integral."""
    out = []
    for knots in schedules:
        segments, total = [], 0.0
        for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
            segments.append(F.struct(F.lit(t0).alias("t"), F.lit(w0).alias("w"), F.lit((w1 - w0) / (t1 - t0)).alias("slope"), F.lit(t1 - t0).alias("width"), F.lit(total).alias("before")))
            total += (w0 + w1) / 2 * (t1 - t0)
        out.append(F.struct(F.array(*segments).alias("segments"), F.lit(total).alias("total")))
    return F.array(*out)


def time_at(share: Column, schedule: Column) -> Column:
    """The time at which a schedule has met ``share`` (0 to 1) of its whole integral.

    Within a segment the integral is w u + slope u^2 / 2; its root is taken in the form that has no cancellation.
    """
    y = share * schedule["total"]
    reached = F.filter(schedule["segments"], lambda s: s["before"] <= y)
    segment = F.element_at(reached, -1)
    rest = y - segment["before"]
    root = F.sqrt(F.greatest(segment["w"] * segment["w"] + 2.0 * segment["slope"] * rest, F.lit(0.0)))
    step = F.coalesce(F.try_divide(2.0 * rest, segment["w"] + root), F.lit(0.0))
    return segment["t"] + F.least(step, segment["width"])


def mix(docs: DataFrame, scratch: Scratch, weights: tuple = WEIGHTS, share: float = SHARE_OF_ALL, schedules: tuple = SCHEDULES, seed: int = 17, row_key: Column | None = None) -> DataFrame:
    """doc_id, source, text_key, order_key, row_key, size, source_size, target, and takes: array of (pass, words, position).

    ``row_key`` tells rows apart that are equal in id and text; without it their order is open, and nothing here shows it.
    """
    slim = docs.select("doc_id", "source", F.md5("text").alias("text_key"), words_in(F.col("text")).alias("size"), (F.lit("") if row_key is None else row_key).alias("row_key"))
    slim = scratch.put(slim.withColumn("order_key", F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("doc_id").cast("string"), "text_key"))))
    goals = targets(slim.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share).withColumnRenamed("source", "goal_source")
    # Buckets are the leading hex digits of the order key, so the order is that of the key itself.
    placed = running(slim, ["source"], ["order_key", "doc_id", "size", "row_key"], "size", "before", bucket=F.left("order_key", F.lit(2)))
    # One row per source and bucket is what the source-level values are attached to by shuffle; the hot source is dealt over 64 copies of its row.
    dealt = goals.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(63))))
    placed = placed.withColumn("salt", F.pmod(F.xxhash64("order_key"), F.lit(64)).cast("int"))
    both = placed.join(dealt, placed["source"].eqNullSafe(dealt["goal_source"]) & (placed["salt"] == dealt["salt"])).drop(dealt["salt"])
    schedule = F.element_at(_knots(schedules), (F.col("rank") % len(schedules) + 1).cast("int"))
    limit = F.floor("target")
    def take(k: int) -> Column:
        start = F.col("before") + F.lit(k) * F.col("source_size")
        words = F.greatest(F.least(limit - start, F.col("size")), F.lit(0)).cast("long")
        return F.struct(F.lit(k).alias("pass"), words.alias("words"), time_at(F.least(F.coalesce(F.try_divide(start + words / 2, F.col("target")), F.lit(0.0)), F.lit(1.0)), schedule).alias("position"))
    takes = F.filter(F.array(*(take(k) for k in range(MAX_PASSES))), lambda t: t["words"] > 0)
    return both.select("doc_id", "source", "text_key", "order_key", "row_key", "size", "source_size", "target", takes.alias("takes"))


def range_sorted(df: DataFrame, scratch: Scratch, *by: str) -> DataFrame:
    """Sorted through the files: ranges of ``by`` over the partitions, each sorted. The input is written first, since range bounds take a pass of their own."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return scratch.put(df).repartitionByRange(parts, *by).sortWithinPartitions(*by)


def training_order(mixed: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per document and pass, range-sorted by training position."""
    flat = mixed.select("doc_id", "source", "text_key", "order_key", F.explode("takes").alias("t")).select("doc_id", "source", "text_key", "order_key", "t.*")
    return range_sorted(flat, scratch, "position", "order_key", "pass")


def per_document(mixed: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per document, by first position; those not taken follow in keyed order, with a null position."""
    first = F.get(F.col("takes"), 0)["position"]
    rest = 1.0 + F.pmod(F.xxhash64("order_key"), F.lit(1 << 30)) / float(1 << 30)
    flat = mixed.select("doc_id", "source", "size", "source_size", "target", F.aggregate("takes", F.lit(0).cast("long"), lambda a, t: a + t["words"]).alias("taken"), F.size("takes").cast("long").alias("passes"), first.alias("position"), F.coalesce(first, rest).alias("place"))
    return range_sorted(flat, scratch, "place").drop("place")


def mixed_documents(docs: DataFrame, scratch: Scratch, weights: tuple = WEIGHTS, share: float = SHARE_OF_ALL, schedules: tuple = SCHEDULES, seed: int = 17) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, range-sorted by training position.

    Whole documents: a pass that takes less than half of one leaves it out. Each row is a document of its own: rows that are equal
    in all columns are attached to what the mix takes of all of them, rows equal only in id and text are told apart by their other columns. Only the
    slim table is sorted and summed; the texts move twice, to meet it and to their range. Null text, no words: such a row is never taken.
    Extra columns of any name and type are kept.
    """
    every = [F.col(f"`{c}`") for c in docs.columns]
    others = [c for c in docs.columns if c != "text"]
    # All columns but the text as JSON, and the text's digest: rows with one key are equal.
    row_key = F.md5(F.concat_ws("|", F.coalesce(F.md5("text"), F.lit("null")), F.to_json(F.struct(*(F.col(f"`{c}`") for c in others)))))
    taken = mix(docs, scratch, weights, share, schedules, seed, row_key).select("row_key", "order_key", F.explode("takes").alias("t"), "size").where(F.col("t.words") * 2 >= F.col("size"))
    places = scratch.put(taken.select("row_key", F.col("t.position").alias("position"), "order_key", F.col("t.pass").alias("pass")))
    once = docs.select(row_key.alias("row_key"), F.struct(*every).alias("d")).groupBy("row_key").agg(F.any_value("d").alias("d"))
    # A row that is repeated very often is dealt over salts; there are HOT_SHARE such rows at most.
    hot = scratch.put(hot_keys(places, "row_key"))
    flat = places.join(F.broadcast(hot), "row_key", "left_anti").join(once, "row_key")
    if not hot.isEmpty():
        flat = flat.unionByName(salted_join(places.join(F.broadcast(hot), "row_key", "left_semi"), once.join(F.broadcast(hot), "row_key", "left_semi"), "row_key", ["position", "pass"], "inner", hot))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = ("position", "order_key", "pass")
    return flat.repartitionByRange(parts, *by).sortWithinPartitions(*by).select(*(F.col(f"d.`{c}`").alias(c) for c in docs.columns))
