"""Where results go: report tables by name, materialized results, views.

Tables live in the session's catalog; ``path`` names their data folder where
the warehouse's own should not be used. Rows are matched to an existing table
by column name, and a frame whose columns differ is refused.

A replacement is written beside the table's data, in a folder of its own, and
becomes the table by one change of its location in the catalog. Until then
readers see the old rows, and a job that fails leaves them; a frame that reads
its own target can be stored. The folder replaced last is kept for readers that
are still at it; the one before that is deleted.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Table properties that name the folder in use and the one replaced last.
CURRENT, PREVIOUS = "packlift.current", "packlift.previous"


def _describe(spark: SparkSession, name: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    return {r["col_name"]: r["data_type"] for r in rows}


def _property(spark: SparkSession, name: str, key: str) -> str | None:
    value = spark.sql(f"SHOW TBLPROPERTIES {name} ('{key}')").first()["value"]
    return None if "does not have property" in value else value


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _matched(df: DataFrame, name: str) -> DataFrame:
    columns = df.sparkSession.table(name).columns
    if sorted(columns) != sorted(df.columns):
        raise ValueError(f"columns of {name} are {columns}, not {df.columns}")
    return df.select(*[f"`{c}`" for c in columns])


def _create(df: DataFrame, name: str, path: str | None) -> None:
    writer = df.write.format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def append_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Append to a report table, created on first use (re-running adds the rows again)."""
    if df.sparkSession.catalog.tableExists(name):
        _matched(df, name).write.insertInto(name)
    else:
        _create(df, name, path)


def overwrite_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Replace a report table's contents (truncate, then load) in one step.

    The new rows are written to a folder of their own first; the table's
    location is switched to it only when all of them are there.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        _create(df, name, path)
        return
    rows = _matched(df, name)
    # The files hold the table's types, so a narrower frame is widened and an unfit one fails here.
    rows = rows.selectExpr(*[f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`"
                             for f in spark.table(name).schema.fields])
    location = _describe(spark, name)["Location"]
    own, before = (_property(spark, name, key) for key in (CURRENT, PREVIOUS))
    base = location.rsplit("/", 1)[0] if own == location else location.rstrip("/") + "-versions"
    target = f"{base}/{uuid.uuid4().hex}"
    try:
        rows.write.parquet(target)
    except Exception:
        _delete(spark, target)
        raise
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{target}'")
    # What the table replaced last goes only now; the folder just replaced stays for its readers.
    previous = f", '{PREVIOUS}' = '{location}'"
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{CURRENT}' = '{_describe(spark, name)['Location']}'{previous})")
    spark.catalog.refreshTable(name)
    if before:
        _delete(spark, before)


def materialize(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Store a result as a table and read it back: the stored copy serves later
    reads and cuts the lineage (recovery after a lost executor restarts from the
    files, not from the sales scan)."""
    overwrite_table(df, name, path)
    return df.sparkSession.table(name)


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Create or replace a (session) view; readers see the query, re-run."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def read_view(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
