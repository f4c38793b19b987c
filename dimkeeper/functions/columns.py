"""Small column expressions and schema alignment. All of it stays on the JVM side."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def typed_null(data_type: DataType | str) -> Column:
    """A null literal with a definite type, so unions need no widening."""
    return F.lit(None).cast(data_type)


def as_date(column: Column | str, strict: bool = False) -> Column:
    """Turn a string into a date; text that is no date becomes null, or an error with ``strict``."""
    column = F.col(column) if isinstance(column, str) else column
    return column.cast("date") if strict else column.try_cast("date")


def quoted(name: str) -> str:
    """A name as it has to stand in expressions, whatever characters it has."""
    return f"`{name.replace('`', '``')}`"


def column(name: str, side: str | None = None) -> Column:
    """The column of that very name, of the aliased side of a join if one is given."""
    return F.col(quoted(name) if side is None else f"{side}.{quoted(name)}")


def columns(names: Sequence[str], side: str | None = None) -> list[Column]:
    return [column(c, side) for c in names]


def fresh(name: str, *frames: DataFrame) -> str:
    """``name``, made longer until none of the frames has such a column."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def has_key(on: Sequence[str]) -> Column:
    """True where every key column holds a value, so the row is able to match another one."""
    return reduce(lambda a, b: a & b, [column(c).isNotNull() for c in on])


def with_key(df: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.where(has_key(on))


def without_key(df: DataFrame, on: Sequence[str]) -> DataFrame | None:
    """Rows with a null in the key, or None where the schema rules them out."""
    if not any(df.schema[c].nullable for c in on):
        return None
    return df.where(~has_key(on))


def resolve_names(df: DataFrame, names: Sequence[str]) -> list[str]:
    """Find columns ignoring case, as Spark SQL does, and return them as ``df`` spells them."""
    known = {c.lower(): c for c in df.columns}
    missing = [n for n in names if n.lower() not in known]
    if missing:
        raise ValueError(f"columns {missing} are not among {df.columns}")
    return [known[n.lower()] for n in names]


def align_names(df: DataFrame, like: DataFrame) -> DataFrame:
    """Spell the columns of ``df`` the way ``like`` spells them."""
    known = {c.lower(): c for c in like.columns}
    return df.toDF(*[known.get(c.lower(), c) for c in df.columns])


def cast_like(df: DataFrame, like: DataFrame) -> DataFrame:
    """Cast the columns both frames have to the types of ``like``.

    The cast sits on the update side, so a key join never casts the large table.
    """
    wanted = {f.name: f.dataType for f in like.schema}
    return df.select(
        *[
            column(f.name).cast(wanted[f.name]).alias(f.name)
            if f.name in wanted and wanted[f.name] != f.dataType
            else column(f.name)
            for f in df.schema
        ]
    )
