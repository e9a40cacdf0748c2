"""Tables written to the shared folder and read back, to fix rows or cut lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from .session import shared_folder


def staged(df: DataFrame, name: str) -> DataFrame:
    """The table, computed once and written to the shared folder of the session."""
    path = f"{shared_folder(df.sparkSession)}/foliant-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
