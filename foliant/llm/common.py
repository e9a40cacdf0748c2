"""Staged tables and reading helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import sys
import tempfile
import types
import uuid
import weakref
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Removes the shuffle files of a query when it ends.
_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_OWN: dict[str, str] = {}
_FILES: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def workspace(spark: SparkSession) -> str:
    """The shared folder for staged tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only a session inside one
    JVM may do without; it gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return _OWN.setdefault(spark.sparkContext.applicationId, "file://" + tempfile.mkdtemp(prefix="run-"))


def new_path(spark: SparkSession, name: str) -> str:
    return f"{workspace(spark)}/foliant-{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def _released(spark: SparkSession) -> Iterator[None]:
    """What is run inside removes its shuffle files as soon as it is done; the session's own setting holds again after."""
    before = spark.conf.get(_RELEASE, None)
    spark.conf.set(_RELEASE, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_RELEASE)
        else:
            spark.conf.set(_RELEASE, before)


def staged(df: DataFrame, name: str) -> DataFrame:
    """The table, computed once and written to the shared folder.

    This cuts lineage: a lost executor costs the tasks that read its part again,
    not the work before.  So nothing reads the shuffles behind it again, and their files go
    at once; Spark by itself keeps them until the driver happens to collect its garbage.
    """
    path = new_path(df.sparkSession, name)
    with _released(df.sparkSession):
        df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _FILES[table] = path
    return table


def discard(*tables: DataFrame) -> None:
    """Removes the files of tables that ``staged`` gave and that nothing reads any more."""
    for table in tables:
        session = table.sparkSession
        path = session._jvm.org.apache.hadoop.fs.Path(_FILES.pop(table))
        path.getFileSystem(session._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def mapped(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    return df.mapInArrow(function, schema)


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    """A record batch from arrays or lists, one per field."""
    arrays = [
        c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def whole_text(text: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def text_rows(docs: DataFrame, key: str, text: str, *more: str | Column) -> DataFrame:
    """Key, text without nulls, and further columns; all other columns are left out."""
    return docs.select(F.col(key).cast("long").alias("doc_id"), whole_text(text).alias("text"), *more)


def at_least(df: DataFrame, key: str | Column) -> DataFrame:
    """Rows dealt to all cores; for narrow tables ahead of costly work on few files."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, key)


def crc_of_id(doc_id: Column) -> Column:
    """crc32 of the id written as text, the basis of all held-out splits."""
    return F.crc32(doc_id.cast("string").cast("binary"))


def per_process(name: str, make: Callable[[], object]) -> object:
    """A value that a Python worker keeps from task to task, such as a loaded model."""
    kept = sys.modules.setdefault("_foliant_kept", types.ModuleType("_foliant_kept")).__dict__
    if name not in kept:
        kept[name] = make()
    return kept[name]
