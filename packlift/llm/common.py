"""Helpers shared by the training-data operators.

Conventions of every operator in this subpackage:

* a null text counts as the empty text, unless the operator's docstring says
  otherwise; null ids and repeated rows are kept as rows of their own;
* an operator selects the columns it needs before adding its own, so extra or
  clashing columns of the input cannot disturb it; functions that keep the
  input's columns name their working columns through ``fresh``;
* intermediate tables go to the shared folder the session names in
  ``spark.checkpoint.dir`` (``stored``), so a lost executor costs a re-read.
"""

from __future__ import annotations

import ctypes
import gc
import hashlib
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from packlift.session import ensure_checkpoint_dir

SLICE_CHARS = 4_000_000   # characters of text handed to a task function at a time, unless one text alone has more
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def fresh(df: DataFrame, *stems: str) -> list[str]:
    """Column names that do not occur in ``df`` (compared without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for stem in stems:
        name, i = f"_{stem}", 0
        while name.lower() in taken:
            i += 1
            name = f"_{stem}_{i}"
        taken.add(name.lower())
        out.append(name)
    return out


def stored(df: DataFrame, name: str, batch_rows: int | None = None, codec: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()``; as Parquet it is compact, and Spark
    knows its size when it plans a join. ``batch_rows`` bounds the Arrow batches
    of this one job, for task functions over rows that hold whole texts; ``codec``
    names another Parquet compression than the session's.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/packlift-llm/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(ARROW_ROWS)
    if batch_rows:
        spark.conf.set(ARROW_ROWS, str(min(batch_rows, int(before)) if int(before) > 0 else batch_rows))
    try:
        df.write.parquet(path, compression=codec)
    finally:
        spark.conf.set(ARROW_ROWS, before)
    return spark.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Return what a task no longer needs to the system: a reused Python worker
    would otherwise hold the memory of its largest task while others run."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # the GNU C library's
    if trim:
        trim(0)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs now: it does so when the
    driver's collector finds their owners gone, which a quiet driver may not do for half an hour."""
    spark.sparkContext._jvm.System.gc()


def slices(texts: list, most: int = SLICE_CHARS) -> Iterator[list[str]]:
    """``texts`` in consecutive lists of bounded size, null as the empty text."""
    part, size = [], 0
    for t in texts:
        t = t or ""
        if part and size + len(t) > most:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t)
    if part:
        yield part


def rows_udf(make: Callable[[], Callable[[list], list[tuple]]], schema: str):
    """A struct-valued pandas UDF over one string column.

    ``make`` builds, once per task, a function from a list of texts to a list
    of tuples in the order of ``schema``. Texts are handed over in slices, so a
    batch of long texts is not doubled in memory.
    """
    names = [f.name for f in StructType.fromDDL(schema)]

    @F.pandas_udf(schema)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        work = make()
        for texts in batches:
            out = []
            for part in slices(texts.tolist()):
                out += work(part)
            yield pd.DataFrame.from_records(out, columns=names)
        work = texts = part = out = None
        give_back()

    return run


def hex_digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
