"""Table sinks that never leave an empty target behind.

The new rows are written under a new name and to a new directory first.  Only then
do the names change: the old table steps aside, the new one takes its name, and the old
entry goes.  A job that fails half-way leaves the old table in place, and a job may read
the table it replaces.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _parts(table: str) -> list[str]:
    return [p.strip("`") for p in table.split(".")]


def _quoted(table: str) -> str:
    return ".".join(f"`{p}`" for p in _parts(table))


def _sibling(table: str, suffix: str) -> str:
    *above, name = _parts(table)
    return ".".join([*above, f"{name}{suffix}"])


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _version(table: str, root: str) -> str:
    """A new directory for the table's rows; the names sort by age."""
    return f"{root.rstrip('/')}/{table}/version={time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def _describe(spark: SparkSession, table: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE EXTENDED {_quoted(table)}").collect()
    start = next((i for i, r in enumerate(rows) if r["col_name"] == "# Detailed Table Information"), len(rows))
    return {r["col_name"]: r["data_type"] for r in rows[start:]}


def _partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(_quoted(table)) if c.isPartition]


def _take_place(spark: SparkSession, new: str, table: str) -> None:
    """Give ``new`` the name of ``table``; the entry that had it goes, and comes back if that fails."""
    old = _sibling(table, f"__old_{uuid.uuid4().hex[:8]}")
    exists = spark.catalog.tableExists(_quoted(table))
    if exists:
        spark.sql(f"ALTER TABLE {_quoted(table)} RENAME TO {_quoted(old)}")
    try:
        spark.sql(f"ALTER TABLE {_quoted(new)} RENAME TO {_quoted(table)}")
    except Exception:
        if exists:
            spark.sql(f"ALTER TABLE {_quoted(old)} RENAME TO {_quoted(table)}")
        raise
    if exists:
        spark.sql(f"DROP TABLE {_quoted(old)}")
    spark.catalog.refreshTable(_quoted(table))


def drop_old_versions(spark: SparkSession, table: str, root: str, keep: int) -> None:
    """Delete all but the ``keep`` newest directories of the table's rows, and never the one in use."""
    jvm = spark._jvm
    top = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{table}")
    store = top.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(top):
        return
    used = _describe(spark, table).get("Location", "").rstrip("/").rpartition("/")[2]
    versions = sorted(s.getPath().getName() for s in store.listStatus(top) if s.getPath().getName().startswith("version="))
    for name in versions[: max(0, len(versions) - keep)]:
        if name != used:
            store.delete(jvm.org.apache.hadoop.fs.Path(top, name), True)


def _after(spark: SparkSession, table: str, root: str, keep_versions: int | None) -> None:
    if keep_versions is not None:
        drop_old_versions(spark, table, root, max(1, keep_versions))


def write_replace(
    df: DataFrame, table: str, root: str, partition_by: list[str] | None = None, keep_versions: int | None = None
) -> None:
    """Replace a table, definition and rows.

    The new table keeps the old one's format, and its partitioning as far as the columns
    are still there, unless ``partition_by`` gives another.  A managed table becomes an
    external one under ``root``, and its files go.  ``keep_versions`` deletes all but
    that many directories of rows afterwards.
    """
    spark = df.sparkSession
    exists = spark.catalog.tableExists(_quoted(table))
    provider = _describe(spark, table).get("Provider", "parquet") if exists else "parquet"
    if partition_by is None:
        partition_by = [c for c in _partition_columns(spark, table) if c in df.columns] if exists else []
    new = _sibling(table, f"__new_{uuid.uuid4().hex[:8]}")
    writer = df.write.format(provider).option("path", _version(table, root))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(_quoted(new))
    _take_place(spark, new, table)
    _after(spark, table, root, keep_versions)


def write_truncate_append(df: DataFrame, table: str, root: str, keep_versions: int | None = None) -> None:
    """Reload a table, keeping its definition: columns go by name and are cast to its types.

    Format, partitioning, comments and properties stay.
    """
    spark = df.sparkSession
    target = spark.table(_quoted(table)).schema
    missing = [f.name for f in target if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns of {table} are absent: {missing}")
    rows = df.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in target])
    new, known = _sibling(table, f"__new_{uuid.uuid4().hex[:8]}"), _describe(spark, table)
    spark.sql(f"CREATE TABLE {_quoted(new)} LIKE {_quoted(table)} LOCATION {_text(_version(table, root))}")
    try:
        if known.get("Comment"):
            spark.sql(f"COMMENT ON TABLE {_quoted(new)} IS {_text(known['Comment'])}")
        properties = [(r["key"], r["value"]) for r in spark.sql(f"SHOW TBLPROPERTIES {_quoted(table)}").collect()]
        if properties:
            spark.sql(f"ALTER TABLE {_quoted(new)} SET TBLPROPERTIES ({', '.join(f'{_text(k)} = {_text(v)}' for k, v in properties)})")
        rows.write.insertInto(_quoted(new))
    except Exception:
        spark.sql(f"DROP TABLE {_quoted(new)}")
        raise
    _take_place(spark, new, table)
    _after(spark, table, root, keep_versions)


def publish_snapshot(df: DataFrame, table: str, root: str, keep_versions: int | None = None) -> None:
    """Make the table hold exactly these rows."""
    write_replace(df, table, root, keep_versions=keep_versions)


def append_to(df: DataFrame, table: str) -> None:
    """Add rows to a table, by column name."""
    spark = df.sparkSession
    columns = spark.table(_quoted(table)).columns
    df.select(*[F.col(f"`{c}`") for c in columns]).write.mode("append").insertInto(_quoted(table))


def write_jdbc(df: DataFrame, options: dict[str, str], keep_definition: bool = True) -> None:
    """Reload a database table; ``truncate`` keeps its definition."""
    df.write.format("jdbc").options(**options).option("truncate", keep_definition).mode("overwrite").save()
