"""File sinks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# The default format stops at milliseconds.
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX"


def _nested_as_json(table: DataFrame) -> DataFrame:
    """CSV holds no arrays, maps or structs: store them as JSON text."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return table.select(
        *[
            F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
            for f in table.schema.fields
        ]
    )


def write_csv(table: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header, nested columns as JSON text. Quotes double, as readers expect.

    Texts keep their outer white space, which Spark would trim by default.
    """
    writer = _nested_as_json(table).write.mode(mode).option("timestampFormat", TIME_FORMAT)
    spaces = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    writer.options(**spaces).option("escape", '"').csv(path, header=True)


def write_json_lines(table: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One object per line; NULL fields are written, too."""
    writer = table.write.mode(mode).option("timestampFormat", TIME_FORMAT)
    writer.option("ignoreNullFields", False).json(path)


def write_json_array(table: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON array per part file, NULL fields included; no part is held as a whole."""
    options = {"timestampFormat": TIME_FORMAT, "ignoreNullFields": "false"}

    def bracketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = "["
        for batch in batches:
            rows = []
            for row in batch.column(0).to_pylist():
                rows.append(before + row)
                before = ","
            yield pa.RecordBatch.from_pydict({"value": pa.array(rows, pa.string())})
        yield pa.RecordBatch.from_pydict({"value": ["[]" if before == "[" else "]"]})

    rows = table.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in table.columns]), options).alias("value"))
    rows.mapInArrow(bracketed, "value string").write.mode(mode).text(path)


def save_output(events: DataFrame, path: str, name: str = "parsed_logs") -> None:
    """Events as CSV and as JSON lines, side by side."""
    write_csv(events, f"{path}/{name}.csv")
    write_json_lines(events, f"{path}/{name}.json")
