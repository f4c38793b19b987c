"""Publish a new state of a table under a stable name.

Spark cannot overwrite a parquet table with a query over itself. The new state is written
beside the old one, then the view with the table's name is pointed at it. Readers see the
old state or the new one, never a mixture, and the old files stay for those still reading.
There is one writer per table: nothing here detects a second one.

A state with partitions may also be published in part. Then only the partitions that changed are
written, and the view keeps reading the others from the folders of earlier snapshots.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from dimkeeper.functions.columns import align_names, cast_like, column, columns, quoted, resolve_names, with_key
from dimkeeper.plans.batch import profile_batch

#: Fixed value: the folder Spark writes rows with a null (or empty) partition value to.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
#: Partitions entered in the catalog with one statement.
PARTITIONS_AT_ONCE = 200


def clustered(df: DataFrame, by: Sequence[str], partition_by: Sequence[str] = ()) -> DataFrame:
    """Rows dealt out by ranges of ``by`` and sorted, within partitions if there are any.

    Files written from it hold one range each, so a filter on these columns skips most files by
    the statistics parquet keeps.
    """
    order = columns(resolve_names(df, [*partition_by, *by]))
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def publish(
    df: DataFrame,
    name: str,
    folder: str,
    snapshot: str | None = None,
    temporary: bool = False,
    partition_by: list[str] | None = None,
    cluster_by: Sequence[str] = (),
) -> DataFrame:
    """Write ``df`` to ``folder/snap=<snapshot>``, point view ``name`` there, return its rows.

    ``snapshot`` defaults to a fresh name. A name already in use is refused, since readers
    may depend on its files. With ``cluster_by`` the files are sorted by ranges of these columns.
    """
    spark = df.sparkSession
    partition_by = resolve_names(df, partition_by or [])
    path = _write(df, folder, snapshot, partition_by, cluster_by)
    if partition_by:
        _point(spark, name, df.schema, path, partition_by, _folders(spark, [path], df.schema, partition_by), temporary)
    elif temporary:
        stored = spark.read.schema(df.schema).parquet(path)
        stored.select(*columns(df.columns)).createOrReplaceTempView(name)
    else:
        _create_view(spark, name, df.schema, f"parquet.{quoted(_root(spark, path, df.schema))}")
    return spark.table(name)


def touched_partitions(
    table: DataFrame, updates: DataFrame, on: str | Sequence[str], partition_by: Sequence[str], limit: int | None = None
) -> DataFrame:
    """The partitions an upsert changes: those of the rows it hits, and those its rows belong to."""
    on = resolve_names(table, [on] if isinstance(on, str) else on)
    partition_by = resolve_names(table, partition_by)
    updates = cast_like(align_names(updates, table), table)
    keys = profile_batch(updates, on, limit).keys(updates, on)
    hit = with_key(table, on).join(keys, on, "left_semi").select(*columns(partition_by))
    return hit.unionByName(updates.select(*columns(partition_by))).distinct()


def publish_touched(
    state: DataFrame,
    touched: DataFrame,
    name: str,
    folder: str,
    snapshot: str | None = None,
    temporary: bool = False,
    cluster_by: Sequence[str] = (),
) -> DataFrame:
    """Publish ``state`` under ``name``, writing only the partitions that ``touched`` lists.

    The columns of ``touched`` are those the published table is partitioned by. All rows of other
    partitions must be as they are in the table. Of ``state`` only the rows of touched partitions
    are computed: where it comes from the table by joins and unions, the condition reaches the scan.
    A partition that has no row in ``state`` disappears. The values of touched partitions go through
    the driver, which holds the table's list of partitions in any case. If nothing is touched,
    nothing is written. The new state must have the columns of the table.
    """
    spark = state.sparkSession
    stored = spark.table(name)
    state = cast_like(align_names(state, stored), stored).select(*columns(stored.columns))
    partition_by = resolve_names(stored, touched.columns)
    there = _folders(spark, stored.inputFiles(), stored.schema, partition_by)
    values = [_value(column(c)).alias(f"v{i}") for i, c in enumerate(touched.columns)]
    wanted = {tuple(r) for r in touched.select(*values).distinct().collect()}
    if not wanted:
        return stored
    path = _write(state.where(_among(partition_by, wanted)), folder, snapshot, partition_by, cluster_by)
    kept = {spec: place for spec, place in there.items() if spec not in wanted}
    written = _folders(spark, [path], stored.schema, partition_by)
    _point(spark, name, stored.schema, path, partition_by, kept | written, temporary)
    return spark.table(name)


def upsert_touched(
    name: str,
    updates: DataFrame,
    on: str | Sequence[str],
    folder: str,
    partition_by: Sequence[str],
    upsert: Callable[[DataFrame, DataFrame, str | Sequence[str]], DataFrame],
    **options,
) -> DataFrame:
    """Upsert a batch into the published table ``name``; only changed partitions are read whole and written.

    ``upsert`` computes the new state from table, batch and key, such as ``type1.upsert`` or ``merge``.
    ``options`` go to :func:`publish_touched`. The batch is read several times; stage a costly one.
    """
    table = updates.sparkSession.table(name)
    touched = touched_partitions(table, updates, on, partition_by)
    return publish_touched(upsert(table, updates, on), touched, name, folder, **options)


def _write(
    df: DataFrame, folder: str, snapshot: str | None, partition_by: Sequence[str], cluster_by: Sequence[str]
) -> str:
    path = f"{folder.rstrip('/')}/snap={snapshot or uuid.uuid4().hex}"
    if cluster_by:
        df = clustered(df, cluster_by, partition_by)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def _value(value: Column) -> Column:
    """A partition value as the name of its folder tells it."""
    text = value.cast("string")
    return F.when(text != "", text).otherwise(F.lit(NO_VALUE))


def _among(partition_by: Sequence[str], wanted: Iterable[tuple[str, ...]]) -> Column:
    """True for rows of the partitions given."""
    if len(partition_by) == 1:
        return _value(column(partition_by[0])).isin([v for (v,) in wanted])
    # The lengths keep apart values that hold the separator.
    own = [F.concat_ws(":", F.length(_value(column(c))).cast("string"), _value(column(c))) for c in partition_by]
    return F.concat_ws("/", *own).isin(["/".join(f"{len(v)}:{v}" for v in spec) for spec in wanted])


def _folders(
    spark: SparkSession, places: Sequence[str], schema: StructType, partition_by: Sequence[str]
) -> dict[tuple[str, ...], str]:
    """Where each partition lies, by its values as text. ``places`` are folders or files."""
    files = places
    if len(places) == 1 and "/part-" not in places[0]:
        files = spark.read.schema(schema).parquet(*places).inputFiles()
    found = {}
    for place in {f.rsplit("/", 1)[0] for f in files}:
        # File names come as addresses, and Spark escapes values in the names of folders.
        parts = [unquote(x) for x in place.split("/")[-len(partition_by) :]]
        named = [x.split("=", 1)[0] for x in parts]
        if [unquote(x).lower() for x in named] != [c.lower() for c in partition_by]:
            raise ValueError(f"{unquote(place)} is no partition by {list(partition_by)}")
        found[tuple(unquote(x.split("=", 1)[1]) for x in parts)] = unquote(place)
    return found


def _root(spark: SparkSession, path: str, schema: StructType) -> str:
    """The whole address of a folder, since the catalog completes relative ones in its own way."""
    files = spark.read.schema(schema).parquet(path).inputFiles()
    if not files:
        return path
    snap = path.rsplit("/", 1)[1]
    parts = [unquote(x) for x in files[0].split("/")]
    return "/".join(parts[: len(parts) - parts[::-1].index(snap)])


def _point(
    spark: SparkSession,
    name: str,
    schema: StructType,
    path: str,
    partition_by: Sequence[str],
    folders: dict[tuple[str, ...], str],
    temporary: bool,
) -> None:
    """Let view ``name`` read the given partitions, wherever they lie."""
    if temporary:
        _point_temporary(spark, name, schema, path, folders)
        return
    by_name = {f.name: f for f in schema}
    rest = [f for f in schema if f.name not in partition_by]
    source = f"{_last_part(name)}_{uuid.uuid4().hex}"
    source = quoted(source) if "." not in name else f"{name.rsplit('.', 1)[0]}.{quoted(source)}"
    fields = ", ".join(_declared(f) for f in [*rest, *(by_name[c] for c in partition_by)])
    spark.sql(
        f"CREATE TABLE {source} ({fields}) USING parquet PARTITIONED BY ({', '.join(map(quoted, partition_by))}) "
        f"LOCATION {_text(_root(spark, path, schema))}"
    )
    clauses = []
    for spec, place in sorted(folders.items()):
        named = zip(partition_by, spec, strict=True)
        pairs = ", ".join(f"{quoted(c)} = {'NULL' if v == NO_VALUE else _text(v)}" for c, v in named)
        clauses.append(f"PARTITION ({pairs}) LOCATION {_text(place)}")
    for at in range(0, len(clauses), PARTITIONS_AT_ONCE):
        spark.sql(f"ALTER TABLE {source} ADD {' '.join(clauses[at : at + PARTITIONS_AT_ONCE])}")
    _create_view(spark, name, schema, source)


def _point_temporary(
    spark: SparkSession, name: str, schema: StructType, path: str, folders: dict[tuple[str, ...], str]
) -> None:
    roots = {p.rsplit("/", len(next(iter(folders))))[0] for p in folders.values()}
    if len(roots) < 2:
        # All partitions lie in one snapshot.
        base = next(iter(roots), path)
    else:
        base = next(iter(roots)).rsplit("/", 1)[0]
        if "snap" in {c.lower() for c in schema.names}:
            raise ValueError("a column named snap hides the folders of several snapshots")
        if any(r.rsplit("/", 1)[0] != base for r in roots):
            raise ValueError(f"the snapshots of a temporary view must lie in one folder, not in {sorted(roots)}")
    reader = spark.read.schema(schema).option("basePath", base)
    reader.parquet(*(sorted(folders.values()) or [path])).select(*columns(schema.names)).createOrReplaceTempView(name)


def _last_part(name: str) -> str:
    return name.rsplit(".", 1)[-1].strip("`")


def _declared(field: StructField) -> str:
    return f"{quoted(field.name)} {field.dataType.simpleString()}"


def _text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _create_view(spark: SparkSession, name: str, schema: StructType, source: str) -> None:
    # Partition columns would come last, with types guessed from the folders' names.
    named = ", ".join(
        f"CAST({quoted(f.name)} AS {f.dataType.simpleString()}) AS {quoted(f.name)}" for f in schema
    )
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {named} FROM {source}")
