"""The order in which archived files count: files of a folder before its sub-folders, names without regard to case."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def walk_order(relative: Column) -> Column:
    """A sortable struct for a path with '/' between its parts; paths that differ in case only go by themselves."""
    parts = F.split(F.translate(relative, "\\", "/"), "/", -1)
    step = lambda folder: lambda name: F.struct(F.lit(folder).alias("folder"), F.lower(name).alias("name"))
    # No lambda function reads the parts: they would be split anew for each of them.
    steps = F.concat(F.transform(F.slice(parts, 1, F.size(parts) - 1), step(1)), F.transform(F.slice(parts, -1, 1), step(0)))
    return F.struct(steps.alias("steps"), relative.alias("path"))
