"""Checks on stored vectors."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: length of a stored embedding.
DIMENSIONS = 1536


def dimensions(vector: Column, kind: T.DataType) -> Column:
    """Length of a vector held as an array or as bracketed text; -1 for other types."""
    if isinstance(kind, T.ArrayType):
        return F.size(vector)
    if isinstance(kind, T.StringType):
        return F.size(F.split(vector, ","))
    return F.lit(-1)
