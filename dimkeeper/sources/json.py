"""Load flat JSON records under an explicit schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from dimkeeper.functions.columns import as_date, typed_null
from dimkeeper.sources.arrays import array_records


def load_json(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str,
    dates: Sequence[str] = (),
    rename: Mapping[str, str] | None = None,
    add: Mapping[str, DataType | str] | None = None,
    array: bool = False,
    strict_dates: bool = False,
) -> DataFrame:
    """Read records, then cast, rename and add columns.

    A field missing in a record is null; a record that is no JSON or does not fit the
    schema is an error. ``dates`` are read as text and cast: text that is no date becomes
    null, or an error with ``strict_dates``. ``add`` appends null columns of a given type.

    One record per line is the default. ``array=True`` reads files that hold one JSON array of
    objects each; large ones are read in blocks by many tasks, in two passes.
    """
    if array:
        record = F.from_json("value", schema, {"mode": "FAILFAST"}).alias("record")
        frame = array_records(spark, path).select(record).select("record.*")
    else:
        frame = spark.read.schema(schema).json(path, mode="FAILFAST")
    renamed = rename or {}
    columns = [
        (as_date(c, strict_dates) if c in dates else F.col(c)).alias(renamed.get(c, c))
        for c in frame.columns
    ]
    added = [typed_null(kind).alias(name) for name, kind in (add or {}).items()]
    return frame.select(*columns, *added)
