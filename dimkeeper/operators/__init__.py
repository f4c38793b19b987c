"""The operators: a general merge and the four kinds of slowly changing dimension."""

from dimkeeper.operators import type1, type3
from dimkeeper.operators.keys import batch_keys
from dimkeeper.operators.merge import (
    AmbiguousMatchError,
    SchemaMismatchError,
    ambiguous_keys,
    merge,
)
from dimkeeper.operators.type2 import History
from dimkeeper.operators.type4 import ChangeLog

__all__ = [
    "AmbiguousMatchError",
    "ChangeLog",
    "History",
    "SchemaMismatchError",
    "ambiguous_keys",
    "batch_keys",
    "merge",
    "type1",
    "type3",
]
