"""Order-aware reductions. Every row carries an order column; nothing depends on how rows are partitioned."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce as reduce_columns

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.functions.once import once
from sedimenta.session import cut_lineage


def first_wins(rows: DataFrame, key: Sequence[str] | str, order: Sequence[str]) -> DataFrame:
    """The first row of each key by order. min_by of the whole row has partial aggregation, so a hot key is met before the shuffle."""
    keys = [key] if isinstance(key, str) else list(key)
    best = rows.groupBy(*keys).agg(F.min_by(F.struct(*rows.columns), F.struct(*order)).alias("_row"))
    return best.select("_row.*")


def first_filled(value: Column, order: Column) -> Column:
    """Aggregate: the first value that is not empty."""
    return F.min(F.when(value != "", F.struct(order.alias("o"), value.alias("v"))))["v"]


def last_filled(value: Column, order: Column) -> Column:
    """Aggregate: the last value that is not empty. Empty ones have no order, and a null order never wins."""
    return F.max_by(F.when(value != "", value), F.when(value != "", order))


def with_date_bounds(rows: DataFrame, key: str, iso: str, raw: str, order: str) -> DataFrame:
    """(key, first_seen_at, first_seen_at_raw, last_seen_at, last_seen_at_raw) over rows with a date."""
    dated = rows.filter(F.col(iso).isNotNull()).groupBy(key, iso).agg(F.min(F.struct(F.col(order).alias("o"), F.col(raw).alias("r"))).alias("w"))
    return dated.groupBy(key).agg(
        F.min(iso).alias("first_seen_at"),
        F.min_by(F.col("w.r"), F.col(iso)).alias("first_seen_at_raw"),
        F.max(iso).alias("last_seen_at"),
        F.max_by(F.col("w.r"), F.col(iso)).alias("last_seen_at_raw"),
    )


def _ranged(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """rows in ranges of (key, order), numbered in _range: a key with very many rows is in several, one after another.

    Written, so that a row keeps its range. Ranges are found by reading all rows first; dealt before, both times they are read
    from a shuffle and not made twice (the generator keeps Catalyst from dropping the first of two shuffles).
    """
    spark = rows.sparkSession
    rows = once(rows.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)), {key[0]: F.col(key[0])})
    return cut_lineage(rows.repartitionByRange(*key, *order).withColumn("_range", F.spark_partition_id()))


def _with_carried(rows: DataFrame, told: DataFrame, key: Sequence[str]) -> DataFrame:
    """rows with what told (key, _range, ...) says of their range; keys may be null."""
    names = [f"_told_{i}" for i in range(len(key))]
    told = told.select(*(F.col(k).alias(n) for k, n in zip(key, names, strict=True)), F.col("_range").alias("_of"), *(c for c in told.columns if c not in (*key, "_range")))
    same = reduce_columns(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(key, names, strict=True)])
    return rows.join(told, same & (F.col("_range") == F.col("_of"))).drop(*names, "_of")


def with_running_last(rows: DataFrame, columns: dict[str, Column | str], key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """rows with a column for each of columns (by new name): the last value that was not empty, up to and with this row, in its key.

    Windows hold no more than a range of rows; what earlier ranges of a key left is carried over, a row for each range.
    """
    rows = rows.withColumns({f"_{n}": F.nullif(F.col(c) if isinstance(c, str) else c, F.lit("")) for n, c in columns.items()})
    rows = _ranged(rows, key, order)
    here = Window.partitionBy("_range", *key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    at = F.struct(*order)
    left = rows.groupBy(*key, "_range").agg(*(F.max_by(f"_{n}", F.when(F.col(f"_{n}").isNotNull(), at)).alias(f"_left_{n}") for n in columns))
    carried = left.select(*key, "_range", *(F.last(f"_left_{n}", ignorenulls=True).over(before).alias(f"_before_{n}") for n in columns))
    rows = rows.withColumns({f"_{n}": F.last(f"_{n}", ignorenulls=True).over(here) for n in columns})
    out = _with_carried(rows, carried, key).withColumns({n: F.coalesce(f"_{n}", f"_before_{n}") for n in columns})
    return out.drop("_range", *(f"_{n}" for n in columns), *(f"_before_{n}" for n in columns))


def with_ordinal(rows: DataFrame, key: Sequence[str], order: Sequence[str], name: str = "n") -> DataFrame:
    """rows with 1 for the first row of a key by order, 2 for the second. Windows hold no more than a range of rows."""
    rows = _ranged(rows, key, order)
    before = Window.partitionBy(*key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(*key, "_range").agg(F.count("*").alias("_rows"))
    carried = counts.select(*key, "_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_earlier"))
    rows = rows.withColumn("_own", F.row_number().over(Window.partitionBy("_range", *key).orderBy(*order)))
    return _with_carried(rows, carried, key).withColumn(name, (F.col("_earlier") + F.col("_own")).cast("int")).drop("_range", "_own", "_earlier")


def _firsts(rows: DataFrame, key: str, order: Sequence[Column | str], name: str) -> DataFrame:
    """rows with whether they are the first of their key by order; of rows that agree in key and order, one is.

    The first is found with partial aggregation, and met in a join, whose hot keys adaptive execution splits. Rows are
    written with a number, so that ties are broken in the same way on both sides of the join.
    """
    rows = cut_lineage(rows.withColumn("_at", F.struct(*order, F.monotonically_increasing_id().alias("_row"))))
    first = rows.groupBy(key).agg(F.min("_at").alias("_first")).withColumnRenamed(key, "_first_key")
    return rows.join(first, F.col(key).eqNullSafe(F.col("_first_key")), "left").withColumn(name, F.col("_at") == F.col("_first")).drop("_at", "_first", "_first_key")


def mark_duplicates(rows: DataFrame, key: str, order: Sequence[str], name: str = "is_duplicate") -> DataFrame:
    """Whether a row is the second or a later one of its key; rows with a null key never are."""
    return _firsts(rows, key, order, name).withColumn(name, F.col(key).isNotNull() & ~F.col(name))


def mark_best(rows: DataFrame, key: str, rank: Sequence[Column | str], name: str = "is_canonical") -> DataFrame:
    """Whether a row is the best of its key by rank; rows with a null key never are."""
    return _firsts(rows, key, rank, name).withColumn(name, F.col(key).isNotNull() & F.col(name))


def unique_names(rows: DataFrame, folder: str, name: str, order: Sequence[str], out: str = "unique_name") -> DataFrame:
    """Names made unique in their folder, whatever the case: the second of a name is stem__collision_2.ext."""
    rows = with_ordinal(rows.withColumn("_name_key", F.lower(F.concat_ws("/", folder, name))), ["_name_key"], order, "_n").drop("_name_key")
    split = r"(?s)\A(.+)(\.[^.]+)\z"
    has = F.col(name).rlike(split)
    stem = F.when(has, F.regexp_extract(name, split, 1)).otherwise(F.col(name))
    ext = F.when(has, F.regexp_extract(name, split, 2)).otherwise("")
    return rows.withColumn(out, F.when(F.col("_n") == 1, F.col(name)).otherwise(F.concat(stem, F.lit("__collision_"), F.col("_n"), ext))).withColumn("collided", F.col("_n") > 1).drop("_n")
