"""Operators on documents whose other columns may have any name."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame

#: The columns that operators read.
READ = ("doc_id", "text")


def any_names(*added: str) -> Callable[[Callable[..., DataFrame]], Callable[..., DataFrame]]:
    """Keep the columns of the first argument apart from an operator's own.

    Inside the operator all but doc_id and text go by their place; outside they have their names again.
    Columns that the operator adds are named in ``added`` and replace those of the same name.
    """

    def wrap(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @wraps(operator)
        def run(docs: DataFrame, *args, **options) -> DataFrame:
            names = [c for c in docs.columns if c not in added]
            inside = [c if c in READ else f"column{i}" for i, c in enumerate(names)]
            docs = docs.select(*[docs[f"`{c.replace('`', '``')}`"] for c in names]).toDF(*inside)
            out = operator(docs, *args, **options)
            outside = dict(zip(inside, names, strict=True))
            return out.toDF(*[outside.get(c, c) for c in out.columns])

        return run

    return wrap
