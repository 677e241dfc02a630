"""Exact duplicates by progressive refinement (operator 2), in DataFrame functions only.

Three levels, each looking only at what the last one could not tell apart:

1. by length: a text whose normalised length no other text has is unique;
2. by length and a hash of the first PREFIX characters: a text alone with its pair is unique;
3. by length, prefix hash and SHA-256 of the whole normalised text, for texts of groups that are left.

The groups that survive a level are handed to the next one as a bitmap, a broadcast of rows of 4 KiB. It has
BITS_A_GROUP bits for each group, and from ROWS (1 MiB) to MOST_ROWS (64 MiB) rows. A bit that two groups share only
sends a text to the next level, where it is compared exactly, so the result does not depend on the bitmap; with more
than some 10**8 groups more and more texts that have no copy get a SHA-256 too, which costs time and a narrow row
each, nothing else. No text is ever shuffled: groups are counted with partial aggregation, the narrow rows of texts
that are left are written once, and the join that gives each its group is a plain sort-merge join, whose hot keys
adaptive execution can split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.session import cut_lineage

PREFIX = 64
ROWS, MOST_ROWS, BITS_A_GROUP = 256, 16384, 16
#: Any run of two or more white-space characters, or one that is not a space; a lone space stays as it is.
_RUNS = r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]"
_BITS = 32768


def normalised(text: Column) -> Column:
    """Each run of ASCII white space becomes one space; null becomes empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _RUNS, " ")


def rows_for(groups: int) -> int:
    """Rows of a bitmap for so many groups: a power of two, for as few other sizes of plans as can be."""
    wanted = ROWS
    while wanted < MOST_ROWS and wanted * _BITS < groups * BITS_A_GROUP:
        wanted *= 2
    return wanted


def _bit(rows: int, *keys: str) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(rows * _BITS))


def bitmap(groups: DataFrame, rows: int, *keys: str) -> DataFrame:
    """At most rows rows (slot, words), words being _BITS / 32 numbers of 32 bits each."""
    at = groups.select(_bit(rows, *keys).alias("at"))
    slots = at.groupBy((F.col("at") / _BITS).cast("int").alias("slot")).agg(F.bitmap_construct_agg(F.pmod("at", F.lit(_BITS))).alias("bits"))
    four = lambda k: F.conv(F.hex(F.substring("bits", 4 * k + 1, F.lit(4))), 16, 10).cast("long")
    return slots.select("slot", F.transform(F.sequence(F.lit(0), F.lit(_BITS // 32 - 1)), four).alias("words"))


def marked(table: DataFrame, bits: DataFrame, rows: int, name: str, *keys: str) -> DataFrame:
    """table with a boolean column: whether the bit of the row's keys is set in a bitmap of that many rows."""
    table = table.withColumn("_at", _bit(rows, *keys)).withColumn("_slot", (F.col("_at") / _BITS).cast("int"))
    table = table.join(F.broadcast(bits.withColumnRenamed("slot", "_slot")), "_slot", "left")
    inside = F.pmod("_at", F.lit(_BITS))
    # The first of a word's four bytes is its highest.
    place = F.pmod(inside, F.lit(32)).bitwiseXOR(F.lit(24)).cast("int")
    hit = F.getbit(F.get("words", (inside / 32).cast("int")), place) == 1
    return table.withColumn(name, F.coalesce(hit, F.lit(False))).drop("_at", "_slot", "words")


def without(docs: DataFrame, gone: DataFrame, *keys: Column) -> DataFrame:
    """The rows of docs, all columns as they are, whose keys are not those of a row of gone (key_0, key_1, ...; no nulls).

    Only rows whose bit is set, those that go and a few others, are shuffled.
    """
    names = [f"_key_{k}" for k in range(len(keys))]
    gone = cut_lineage(gone.toDF(*names).distinct())
    rows = rows_for(gone.count())
    tagged = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), *(k.alias(n) for k, n in zip(keys, names, strict=True)))
    tagged = marked(tagged, cut_lineage(bitmap(gone, rows, *names)), rows, "_maybe", *names)
    left = tagged.filter("_maybe").join(gone, names, "left_anti")
    return tagged.filter("not _maybe").select("_row.*").union(left.select("_row.*"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """(doc_id, keep_id, group_size, kept) and the columns of carry, a row for each row of docs.

    Null texts count as empty; empty texts are equal to each other and to nothing else (a text of white space only
    normalises to one space). keep_id is the smallest id among equal texts, nulls aside; null if all are null.
    Repeated rows are rows of their own: each counts in group_size, and every row with the smallest id is kept. In a
    group without any id, none can be told from another: all are kept. Columns named in carry pass through; others
    are not read, so they may have any name.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"), *(F.col(c).alias(f"_carry_{i}") for i, c in enumerate(carry)))
    base = base.withColumn("_norm", normalised(F.col("_text"))).withColumn("_len", F.length("_norm")).withColumn("_head", F.xxhash64(F.substring("_norm", 1, PREFIX)))

    by_length = cut_lineage(base.groupBy("_len", "_head").agg(F.count("*").alias("n")))
    several = by_length.groupBy("_len").agg(F.sum("n").alias("n")).filter("n > 1")
    rows = rows_for(several.count())
    again = cut_lineage(marked(by_length, bitmap(several, rows, "_len"), rows, "_again", "_len").filter("_again and n > 1"))
    rows = rows_for(again.count())
    heads = cut_lineage(bitmap(again, rows, "_len", "_head"))

    carried = [f"_carry_{i}" for i in range(len(carry))]
    hashed = marked(base, heads, rows, "_maybe", "_len", "_head").withColumn("_full", F.when(F.col("_maybe"), F.sha2(F.col("_norm"), 256)))
    key = ["_len", "_head", "_full"]
    # Written, so that texts are read no more, and the join below has a shuffle on both sides, which adaptive execution needs to split a hot group.
    narrow = cut_lineage(hashed.select("doc_id", "_maybe", *key, *carried))
    groups = cut_lineage(narrow.filter("_maybe").groupBy(*key).agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")).filter("group_size > 1"))

    out = [F.col(f).alias(c) for f, c in zip(carried, carry, strict=True)]
    alone = narrow.filter("not _maybe").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), *out)
    met = narrow.filter("_maybe").join(groups, key, "left")
    size, keep = F.coalesce("group_size", F.lit(1).cast("long")), F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    met = met.select("doc_id", keep.alias("keep_id"), size.alias("group_size"), F.col("doc_id").eqNullSafe(keep).alias("kept"), *out)
    return alone.union(met)
