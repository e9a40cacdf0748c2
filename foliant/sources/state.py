"""JSON state of earlier runs; empty typed tables when there is none."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas


def read_json(spark: SparkSession, path: str, schema: str, lines: bool = True) -> DataFrame:
    try:
        return spark.read.schema(schema).option("multiLine", not lines).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def stored_videos(spark: SparkSession, path: str) -> DataFrame:
    return read_json(spark, path, schemas.VIDEOS)


def visited_urls(spark: SparkSession, path: str) -> DataFrame:
    """URLs of the blog state, one per row."""
    state = read_json(spark, path, schemas.BLOG_STATE, lines=False)
    return state.select(F.explode("scraped_urls").alias("url"))
