"""Column and schema helpers shared by the operators."""

from dimkeeper.functions.columns import (
    align_names,
    as_date,
    cast_like,
    resolve_names,
    typed_null,
    without_key,
    with_key,
)

__all__ = [
    "align_names",
    "as_date",
    "cast_like",
    "resolve_names",
    "typed_null",
    "with_key",
    "without_key",
]
