"""JSON lines: read as text, parsed by expression, with a reason for every line that is left out.

One parser serves all dialects. ``chat``: an object whose ``messages`` is a list. ``object``: any object. ``any``: any value.
``strict`` is ``any`` but fails on the first malformed line. ``legacy`` is ``any`` but counts a blank line as malformed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import stripped
from ..schema import BLANK, INTENT, MALFORMED, MESSAGES, NO_MESSAGES, NOT_OBJECT

DIALECTS = ("chat", "object", "any", "strict", "legacy")
TEXT_MOST = 1 << 20


def reason(line: Column, dialect: str = "chat") -> Column:
    """Why the dialect leaves a line out; null if it doesn't."""
    if dialect not in DIALECTS:
        raise ValueError(f"a dialect is one of {', '.join(DIALECTS)}")
    value = F.try_parse_json(line)
    kind = F.schema_of_variant(value)
    out = F.when(stripped(line) == "", F.lit(MALFORMED if dialect == "legacy" else BLANK))
    if dialect != "strict":
        out = out.when(value.isNull(), F.lit(MALFORMED))
    if dialect in ("chat", "object"):
        out = out.when(~kind.startswith("OBJECT"), F.lit(NOT_OBJECT))
    if dialect == "chat":
        out = out.when(F.try_variant_get(value, "$.messages", "array<variant>").isNull(), F.lit(NO_MESSAGES))
    return out


def parsed(lines: DataFrame, dialect: str = "chat", column: str = "value") -> DataFrame:
    """``lines`` plus record (VARIANT), record_kind (chat, intent or other), messages, and reject_reason; no line is lost."""
    line = F.col(column)
    record = F.parse_json(line) if dialect == "strict" else F.try_parse_json(line)
    if dialect == "strict":
        record = F.when(stripped(line) != "", record)
    out = lines.withColumns({"record": record, "reject_reason": reason(line, dialect)})
    messages = F.try_variant_get("record", "$.messages", MESSAGES)
    kind = F.when(F.try_variant_get("record", "$.messages", "array<variant>").isNotNull(), "chat").when(F.try_variant_get("record", "$.application_prompt", "string").isNotNull(), "intent").otherwise("other")
    return out.withColumns({"messages": messages, "record_kind": kind})


def kept(lines: DataFrame, dialect: str = "chat", column: str = "value", name: str | None = None) -> DataFrame:
    """The lines that the dialect takes; with ``name``, counts of loaded and left-out lines are observed under it."""
    out = parsed(lines, dialect, column)
    if name:
        out = out.observe(name, F.count(F.lit(1)).alias("loaded"), F.count("reject_reason").alias("left_out"))
    # Asking for the record makes a strict read fail even where no column of it is used.
    return out.where("reject_reason IS NULL AND record IS NOT NULL").drop("reject_reason") if dialect == "strict" else out.where("reject_reason IS NULL").drop("reject_reason")


def intents(records: DataFrame) -> DataFrame:
    """The fields of intent records as columns; a field that is absent or of another type is null."""
    return records.select("*", *(F.try_variant_get("record", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in INTENT.fields))


def lines(spark: SparkSession, path: str) -> DataFrame:
    """value and file of every line; a missing path is an error when it is read."""
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))


def numbered(spark: SparkSession, path: str) -> DataFrame:
    """value, file and line (from 1) of every line, without one task a file.

    Files are read in blocks. Within a block lines keep their order; the lines of the blocks before it, counted first, are added.
    """
    at, block = "at", "block"
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias(block), F.monotonically_increasing_id().alias(at))
    before = Window.partitionBy("file").orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    counted = raw.groupBy("file", block).agg(F.count(F.lit(1)).alias("lines"), F.min(at).alias("first"))
    # One row a block of a file.
    offsets = counted.select("file", block, "first", F.coalesce(F.sum("lines").over(before), F.lit(0)).alias("before"))
    return raw.join(offsets, ["file", block]).select("value", "file", (F.col(at) - F.col("first") + F.col("before") + 1).alias("line"))


def report(spark: SparkSession, path: str, dialect: str = "chat") -> DataFrame:
    """file, line and reason of every line that the dialect leaves out. In ``strict`` a malformed line is reported rather than ending the job."""
    out = numbered(spark, path).withColumn("reason", reason(F.col("value"), "any" if dialect == "strict" else dialect))
    return out.where("reason IS NOT NULL").select("file", "line", "reason")


def load(spark: SparkSession, path: str, dialect: str = "chat") -> DataFrame:
    return kept(lines(spark, path), dialect)


def load_splits(spark: SparkSession, paths: dict[str, str], dialect: str = "any") -> DataFrame:
    """Several files as one table with a ``split`` column."""
    out = None
    for split, path in paths.items():
        part = load(spark, path, dialect).withColumn("split", F.lit(split))
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no paths given")
    return out


def whole_texts(spark: SparkSession, path: str, most: int = TEXT_MOST, allowed: list[str] | None = None) -> DataFrame:
    """path and text of files up to ``most`` bytes, from allowed folders only; larger ones are listed without a text."""
    if allowed is not None and not any(path == a or path.startswith(a.rstrip("/") + "/") for a in allowed) or ".." in path.split("/"):
        raise ValueError("the path is outside the allowed folders")
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", "length", F.when(F.col("length") <= most, F.col("content").cast("string")).alias("text"))
