"""python -m convmill {records,pairs,variants} --config FILE, or --input FILE --output DIR with options."""

from __future__ import annotations

import argparse
import sys
from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .functions import vocab as V
from .operators.messages import first_of
from .operators.variants import valid, variants
from .plans import config as C
from .plans import pipelines
from .sources import jsonl, sinks


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="convmill", description=__doc__)
    out.add_argument("task", choices=("records", "pairs", "variants"))
    out.add_argument("--config")
    for name, kind in (("input", str), ("output", str), ("dialect", str), ("factor", int), ("share", float), ("sample", int), ("review", float), ("seed", str)):
        out.add_argument(f"--{name}", type=kind)
    return out


def run(spark: SparkSession, task: str, config: C.Config) -> None:
    d = C.check_paths(spark, config.checked()).data
    chats = jsonl.load(spark, d.input, "chat").select(F.md5("value").alias("conv_id"), "messages")
    if task == "pairs":
        sinks.save(pipelines.pairs_of_chats(chats), d.output)
    elif task == "variants":
        made = variants(chats, d.factor, V.TOOLS, seed=d.seed)
        sinks.save(made.where(valid(F.col("messages"))), d.output)
    else:
        pairs = chats.select("conv_id", first_of(F.col("messages"), "user").alias("prompt"), first_of(F.col("messages"), "assistant").alias("response"))
        records = pipelines.intent_records(pairs, dialect=replace(pipelines.DIALECTS[d.dialect], factor=d.factor, seed=d.seed))
        sinks.save_splits(pipelines.curated(records, d.share, d.sample, d.review, seed=d.seed), d.output)


def main(args: list[str] | None = None) -> int:
    given = vars(parser().parse_args(args))
    task, path = given.pop("task"), given.pop("config")
    config = C.load(path) if path else C.Config()
    for name, value in given.items():
        if value is not None:
            setattr(config.data, name, value)
    run(SparkSession.builder.getOrCreate(), task, config)
    return 0


if __name__ == "__main__":
    sys.exit(main())
