"""Sources and sinks."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from acctmart.sources.contract import COLUMNS, UNREAD


def load_tables(
    spark: SparkSession,
    base: str | None = None,
    names: Iterable[str] | None = None,
    *,
    fmt: str = "parquet",
    overrides: Mapping[str, str | DataFrame] | None = None,
    options: Mapping[str, object] | None = None,
    schemas: Mapping[str, str | StructType] | None = None,
    formats: Mapping[str, str] | None = None,
    table_options: Mapping[str, Mapping[str, object]] | None = None,
) -> dict[str, DataFrame]:
    """Lazy frames by table name.

    Tables are files ``{base}/{name}.{fmt}``, or tables of the current database
    if ``base`` is None. An override may be a frame, a path (it contains ``/``), or a table
    name such as ``other_db.name`` for a table that lives in another database. ``formats`` and ``table_options``
    hold the format and further reader options of single tables, where they aren't those of all.
    """
    overrides = dict(overrides or {})
    names = list(names) if names is not None else [*COLUMNS, *UNREAD]
    schemas = dict(schemas or {})

    unknown = sorted({*(formats or {}), *(table_options or {}), *schemas} - set(names))
    if unknown:
        raise ValueError(f"options for tables that are not read: {unknown}")

    def format_of(name: str) -> str:
        return (formats or {}).get(name, fmt)

    def files(name: str, path: str) -> DataFrame:
        own = {**dict(options or {}), **dict((table_options or {}).get(name, {}))}
        reader = spark.read.format(format_of(name)).options(**own)
        return (reader.schema(schemas[name]) if name in schemas else reader).load(path)

    def one(name: str) -> DataFrame:
        source = overrides.get(name)
        if isinstance(source, DataFrame):
            return source
        if source is None and base is None:
            return spark.table(f"`{name}`")
        if source is None:
            return files(name, f"{base}/{name}.{format_of(name)}")
        return files(name, source) if "/" in source else spark.table(source)

    return {name: one(name) for name in names}


def save_bucketed(
    df: DataFrame,
    table: str,
    keys: str | list[str],
    buckets: int,
    fmt: str = "parquet",
    mode: str = "errorifexists",
) -> None:
    """Store a table bucketed and sorted on its key, for joins on it without a shuffle.

    Pays off for tables that many extracts read and in which no key holds many rows: all rows
    of a key share a bucket. All tables of a join chain need the same number of buckets.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    (
        df.repartition(buckets, *keys)
        .write.format(fmt)
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .mode(mode)
        .saveAsTable(table)
    )


def write_extract(
    df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists", **options
) -> None:
    """Write a result; the files in name order hold the rows in order."""
    df.write.format(fmt).mode(mode).options(**options).save(path)
