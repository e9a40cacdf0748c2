"""Expressions that are made once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

def of_name(function: Callable[[Column], Column], name: str) -> Column:
    """The function's expression over a column by its name, made once as long as the JVM lives.

    Expressions of pages and markdown have thousands of parts, each made by a call to the JVM.
    """
    jvm = SparkContext._gateway
    if jvm is None:
        return function(F.col(name))
    # Kept with the JVM and not in this module, which travels with tasks.
    made = jvm.__dict__.setdefault("_foliant_made", {})
    key = (function, name)
    if key not in made:
        made[key] = function(F.col(name))
    return made[key]
