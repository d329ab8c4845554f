"""Shared plumbing: durable intermediates, distributed prefix sums, joins that survive a hot key."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A key is hot when it holds over 1/HOT_SHARE of all rows, so at most HOT_SHARE keys are: the bound that makes the hot list safe to broadcast.
HOT_SHARE = 2048
#: Pieces into which the rows of a hot key are dealt.
SALTS = 64
#: Rows that one bucket of a running sum holds, about.
BUCKET_ROWS = 200_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor sees; a temporary one only where the cluster names none."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="convmill-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


class Scratch:
    """Intermediate tables as Parquet in the shared folder: their lineage is cut, and a lost executor loses none.

    ``drop`` removes one that nothing reads any more; ``put`` under a name used before does not
    remove the older table, since plans may still read it.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.root = f"{shared_dir(spark)}/convmill-{uuid.uuid4().hex}"
        self._count = 0
        atexit.register(self.close)

    def _delete(self, path: str) -> None:
        jvm_path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        jvm_path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(jvm_path, True)

    def close(self) -> None:
        """Removes all tables; done at the end of the driver's process, if its context is still there."""
        atexit.unregister(self.close)
        if self.spark.sparkContext._jsc is not None:
            with contextlib.suppress(Exception):
                self._delete(self.root)

    def put(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{self._count}"
        self._count += 1
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        """Removes the table behind a frame that ``put`` gave; other frames have none."""
        if "_scratch_path" in vars(df):
            self._delete(vars(df).pop("_scratch_path"))


def fresh(df: DataFrame, *names: str, also: Sequence[str] = ()) -> list[str]:
    """Names for internal columns that no column of ``df``, and none of ``also``, has in any case."""
    taken = {c.lower() for c in (*df.columns, *also)}
    out = []
    for name in names:
        while f"_{name}" in taken:
            name += "_"
        taken.add(f"_{name}")
        out.append(f"_{name}")
    return out


def arrow_batches(spark: SparkSession, rows: int = 512, mb: int = 16) -> None:
    """Bounds what one Arrow batch of whole texts may hold, by rows and by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{mb}m")


def running(df: DataFrame, parts: Sequence[str], order: Sequence[str], value: str, out: str, buckets: int | None = None, bucket: Column | None = None) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows before this one, in each of ``parts``.

    The order is by ``bucket``, a hash of ``order`` unless given, then by ``order`` itself. No task holds all rows of a part:
    each part is dealt into ``buckets`` by that hash (256, or one for each BUCKET_ROWS rows if those are more), bucket sums (parts x buckets rows) give the
    offsets, and a window runs within one bucket only. ``df`` is read twice, so it should be a
    written table. Null parts count as a part of their own.
    """
    if bucket is None and buckets is None:
        buckets = max(256, df.count() // BUCKET_ROWS)
    keyed = df.withColumn("_b", F.pmod(F.xxhash64(*order), F.lit(buckets)) if bucket is None else bucket)
    for i, p in enumerate(parts):
        keyed = keyed.withColumn(f"_p{i}", F.coalesce(F.xxhash64(p), F.lit(0)) if dict(df.dtypes)[p] == "string" else F.coalesce(F.col(p).cast("long"), F.lit(-1)))
        keyed = keyed.withColumn(f"_n{i}", F.col(p).isNull())
    keys = [k for i in range(len(parts)) for k in (f"_p{i}", f"_n{i}")]
    sums = keyed.groupBy(*keys, "_b").agg(F.sum(value).alias("_s"))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*keys, "_b", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy(*keys, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        keyed.join(offsets, [*keys, "_b"])
        .withColumn(out, F.col("_off") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .drop(*keys, "_b", "_off")
    )


def hot_keys(df: DataFrame, key: str, share: int = HOT_SHARE) -> DataFrame:
    """Keys with over 1/share of the rows: at most ``share`` of them, whatever the input."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    return counts.join(F.broadcast(total), F.col("_n") * share > F.col("_total")).where("_n > 1").select(key)


def salted_join(left: DataFrame, right: DataFrame, key: str, spread: Sequence[str], how: str = "left", hot: DataFrame | None = None) -> DataFrame:
    """``left`` joined to ``right``, which has one row a key; hot keys of ``left`` are dealt over SALTS pieces.

    The hot list is bounded by HOT_SHARE rows and is the only thing broadcast.
    """
    is_hot, salt = fresh(left, "hot", "salt", also=right.columns)
    hot = (hot_keys(left, key) if hot is None else hot).select(F.col(key), F.lit(True).alias(is_hot))
    salted = left.join(F.broadcast(hot), key, "left").withColumn(salt, F.when(F.col(is_hot), F.pmod(F.xxhash64(*spread), F.lit(SALTS))).otherwise(F.lit(0).cast("long"))).drop(is_hot)
    copies = F.when(F.col(is_hot), F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
    dealt = right.join(F.broadcast(hot), key, "left").withColumn(salt, F.explode(copies)).drop(is_hot)
    return salted.join(dealt, [key, salt], how).drop(salt)
