"""Python functions over records, where columns can't say it: batches by Arrow, a declared schema, and a table of the rows that raised.

One pass writes what each row gave; results and failures are read from that table, so a function runs once a row whatever is read of it.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType, _parse_datatype_string

from ..functions.durable import written

#: Rows a batch holds, at most.
ROWS = 1024


def _run(df: DataFrame, f: Callable[[dict], object], out: StructType, rows: int, names: list[str]) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(out)
    made, raised, record = names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct(list(arrow))
        for whole in batches:
            for at in range(0, whole.num_rows, rows):
                batch = whole.slice(at, rows)
                results, errors, shown = [], [], []
                for row in batch.to_pylist():
                    result, error = None, None
                    try:
                        result = f(dict(row))
                        if result is not None:
                            # A value that the schema can't hold is the row's failure, not the batch's.
                            pa.array([result], kind)
                    except Exception as e:
                        result, error = None, f"{type(e).__name__}: {e}"
                    results.append(result)
                    errors.append(error)
                    shown.append(None if error is None else json.dumps(row, default=str, ensure_ascii=False))
                yield pa.RecordBatch.from_arrays([pa.array(results, kind), pa.array(errors, pa.string()), pa.array(shown, pa.string())], names=names)

    schema = StructType().add(made, out).add(raised, "string").add(record, "string")
    return written(df.mapInArrow(run, schema))


def mapped(df: DataFrame, f: Callable[[dict], dict | None], schema: str, rows: int = ROWS) -> tuple[DataFrame, DataFrame]:
    """What ``f`` makes of each row (a dict by column; null leaves the row out), and error and record (JSON) of the rows for which it raised or gave what ``schema`` can't hold. Fields that ``f`` leaves out are null."""
    out = _parse_datatype_string(schema)
    table = _run(df, f, out, rows, ["made", "error", "record"])
    return table.where("made IS NOT NULL").select("made.*"), table.where("error IS NOT NULL").select("error", "record")


def filtered(df: DataFrame, f: Callable[[dict], bool], rows: int = ROWS) -> tuple[DataFrame, DataFrame]:
    """The rows of which ``f`` is true, whole, and the table of those for which it raised."""
    kept = df.schema
    table = _run(df, lambda row: row if f(dict(row)) else None, kept, rows, ["made", "error", "record"])
    return table.where("made IS NOT NULL").select("made.*"), table.where("error IS NOT NULL").select("error", "record")
