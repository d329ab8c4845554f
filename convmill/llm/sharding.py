"""Balanced label propagation: documents linked by an equal key move towards their neighbours' shard, under capacity quotas.

Linked documents start where a keyed order puts them. In each round a join of every document with its key's weight
by shard gives it the shard where most of its neighbours are. Moves that gain neighbours are accepted, in a keyed order: between two
shards as many bytes as want to go the other way, so that full shards exchange, and beyond that up to the room that each shard's quota leaves. So the
weight of uncut links only grows, and the rounds end when two in turn move nothing. Documents without a link then even the shards out: the few large ones each to the emptiest shard, the rest by running size into what room is left.

A key's documents are never gathered: weights are summed by key and shard first, the join deals hot keys over salts,
and quotas are met by distributed running sums. A group larger than a shard fills one and stays spread over others.

Defined results. Law: ``bytes``; sizes are even to within the largest document of those that hold under
1 / FINE of all bytes, where documents without a link are enough to even out what exchanges leave: a document for each two shards at most. Null text: size 1, CRC 0, linked with empty texts. Null doc_id: a document like any other. Repeated rows:
each gets a slot. Empty table: empty result. Fewer documents than shards: some shards stay empty. Extra columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, running, salted_join

SHARDS = 8
#: Documents over 1/FINE of all bytes are placed one by one: fewer than FINE of them, whatever the input.
FINE = 4000
SEED = 11


def _at(values: list[int], index: Column) -> Column:
    return F.element_at(F.array(*(F.lit(v).cast("long") for v in values)), index + 1)


def _loads(df: DataFrame, shards: int) -> list[int]:
    got = {r["shard"]: r["b"] for r in df.groupBy("shard").agg(F.sum("size").alias("b")).collect()}
    return [got.get(s, 0) for s in range(shards)]


def _below(bounds: list[int], value: Column) -> Column:
    """How many bounds are at or below the value."""
    return F.size(F.filter(F.array(*(F.lit(b).cast("long") for b in bounds)), lambda b: b <= value)) if bounds else F.lit(0)


def _limits(flow: dict[tuple[int, int], int], loads: list[int], quota: int) -> dict[tuple[int, int], int]:
    """Bytes that may go from one shard to another: what comes back, and a share of the room; less where the target is beyond its quota."""
    out = {}
    for target, load in enumerate(loads):
        coming = {s: f for (s, t), f in flow.items() if t == target}
        even = {s: min(f, flow.get((target, s), 0)) for s, f in coming.items()}
        more, room = sum(coming.values()) - sum(even.values()), quota - load
        for s, f in coming.items():
            extra = min(f - even[s], room * (f - even[s]) // more) if room > 0 and more else 0
            owed = -(room * f // sum(coming.values())) if room < 0 else 0
            out[s, target] = max(0, even[s] + extra - owed)
    return out


def propagate(linked: DataFrame, shards: int, quota: int, scratch: Scratch) -> DataFrame:
    """``linked`` (doc_id, size, link, order_key, shard, ...) with shards moved towards neighbours, until none gains.

    Beyond ``quota`` a shard is filled only by what exchanges with other shards leave, a document for each of them, and takes that much less in the next round.
    """
    idle, turn = 0, 0
    while idle < 2:
        loads, turn = _loads(linked, shards), turn + 1
        weights = linked.groupBy("link", "shard").agg(F.sum("size").alias("b"))
        # In turn all shards are wanted, which full ones can answer by exchange only, and those with room, where what a full one refuses gathers.
        # Which of equal shards is wanted changes by turn, so that what is refused one way may go the other.
        top = F.struct("b", F.xxhash64(F.lit(turn), "link", "shard"), "shard")
        if turn % 2 == 0:
            top = F.when(_at([max(0, quota - b) for b in loads], F.col("shard")) > 0, top)
        wanted = weights.groupBy("link").agg(F.max(top).alias("top"), F.map_from_entries(F.collect_list(F.struct("shard", "b"))).alias("by_shard")).where(F.size("by_shard") > 1)
        asked = salted_join(linked, wanted, "link", ["order_key"], "left")
        # Equal weights: the key's top shard wins, and the sum of squared weights still grows.
        gains = F.coalesce(F.col("top.b") >= F.try_element_at("by_shard", F.col("shard")), F.lit(False))
        asked = scratch.put(asked.withColumn("want", F.when(gains, F.col("top.shard")).otherwise(F.col("shard"))).drop("top", "by_shard"))
        moving = asked.where("want <> shard")
        flow = {(r["shard"], r["want"]): r["b"] for r in moving.groupBy("shard", "want").agg(F.sum("size").alias("b")).collect()}
        limit = _limits(flow, loads, quota)
        allowed = _at([limit.get((s, t), 0) for s in range(shards) for t in range(shards)], F.col("shard") * shards + F.col("want"))
        movers = running(moving, ["shard", "want"], ["order_key", "doc_id", "size"], "size", "before", buckets=64)
        moved = scratch.put(movers.withColumn("accepted", F.col("before") + F.col("size") <= allowed))
        count = moved.where("accepted").count()
        after = asked.where("want = shard").drop("want").unionByName(moved.withColumn("shard", F.when(F.col("accepted"), F.col("want")).otherwise(F.col("shard"))).drop("want", "before", "accepted"))
        idle = 0 if count else idle + 1
        if count:
            linked = scratch.put(after.select(*linked.columns))
    return linked


def _place_large(large: DataFrame, room: list[int]) -> DataFrame:
    """Each of the (fewer than FINE) large documents, by falling size, to the shard with the most room left; one fold over their array."""
    columns = large.columns
    items = F.sort_array(F.collect_list(F.struct((-F.col("size")).alias("_falling"), F.col("order_key").alias("_key"), *columns)))

    def place(s: Column, x: Column) -> Column:
        best = F.array_position(s["room"], F.array_max(s["room"])).cast("int")
        return F.struct(F.transform(s["room"], lambda v, i: F.when(i == best - 1, v - x["size"]).otherwise(v)).alias("room"), F.concat(s["picks"], F.array(best - 1)).alias("picks"))

    start = F.struct(F.array(*(F.lit(v).cast("long") for v in room)).alias("room"), F.array().cast("array<int>").alias("picks"))
    folded = large.agg(items.alias("items")).select("items", F.aggregate("items", start, place, lambda s: s["picks"]).alias("picks"))
    return folded.select(F.explode(F.arrays_zip("items", "picks")).alias("z")).select(*(F.col(f"z.items.{c}").alias(c) for c in columns), F.col("z.picks").alias("shard"))


def assign(docs: DataFrame, scratch: Scratch, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """doc_id, size, text_crc32, link, shard, slot of every document; links are equal texts."""
    text = F.coalesce("text", F.lit(""))
    slim = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("link"))
    slim = scratch.put(slim.withColumn("order_key", F.xxhash64(F.lit(seed), "doc_id", "link")))
    groups = slim.groupBy("link").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    marked = scratch.put(salted_join(slim, groups, "link", ["order_key"], "left"))
    total = marked.agg(F.sum("size")).first()[0] or 0
    quota = -(-total // shards)

    begun = running(marked.where("members IS NOT NULL"), [], ["order_key", "doc_id", "size"], "size", "before").drop("members")
    all_linked = marked.where("members IS NOT NULL").agg(F.sum("size")).first()[0] or 0
    start = F.floor(F.col("before") * shards / F.lit(max(1, all_linked))).cast("int")
    linked = scratch.put(begun.withColumn("shard", F.least(start, F.lit(shards - 1))).drop("before"))
    linked = propagate(linked, shards, quota, scratch)

    alone = marked.where("members IS NULL").drop("members")
    room = [quota - b for b in _loads(linked, shards)]
    large = scratch.put(_place_large(alone.where(F.col("size") * FINE > total), room))
    room = [max(0, r - b) for r, b in zip(room, _loads(large, shards))]
    small = running(alone.where(F.col("size") * FINE <= total), [], ["order_key", "doc_id", "size"], "size", "before")
    # What room is left differs from the small documents' bytes by rounding and by large documents beyond it; it is scaled to them.
    rest = alone.where(F.col("size") * FINE <= total).agg(F.sum("size")).first()[0] or 0
    bounds = [sum(room[: i + 1]) * rest // max(1, sum(room)) for i in range(shards - 1)] if sum(room) else [rest * (i + 1) // shards for i in range(shards - 1)]
    small = small.withColumn("shard", _below(bounds, F.col("before") + F.floor(F.col("size") / 2))).drop("before")

    placed = scratch.put(linked.unionByName(large).unionByName(small).withColumn("one", F.lit(1).cast("long")))
    return running(placed, ["shard"], ["order_key", "doc_id", "size"], "one", "slot").drop("one", "order_key")
