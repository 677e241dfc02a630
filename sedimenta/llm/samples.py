"""Labelled training rows: a bounded sample, from the fold that may be learnt from."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm import vectext
from sedimenta.session import cut_lineage

#: Rows of each label at most, and what their texts may cost together (a byte costs 1, a line LINE_COST more, for that is what features take); every text is scored whole.
ROWS_PER_LABEL, MOST_COST, LINE_COST = 1500, 16 << 20, 100


def held_out(doc_id: Column | str) -> Column:
    """Whether a row's label may not be learnt from: crc32 of the id as text, modulo 3, is 1 (false for a null id)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows_per_label: int = ROWS_PER_LABEL, most_cost: int = MOST_COST) -> tuple[pa.Table, list[int]]:
    """((text, label) of at most 2 * rows_per_label rows, number of rows of either label that might be learnt from).

    Rows are taken by a hash of their id, so the choice does not depend on partitions: of labels whose document is
    there, rows_per_label at most, and of those in order all that fit what is left of most_cost (so that only a text
    of nearly most_cost is never learnt from). A null label is no label, a null text is none to learn from. Where an
    id is repeated, its smallest text and label are taken.
    """
    open_rows = labels.select("doc_id", F.col(label).cast("int").alias("label")).filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).filter(~held_out("doc_id"))
    seen = {r.label: r.n for r in open_rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("text is not null")
    cost = F.octet_length("text") + LINE_COST * (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))))
    there = texts.select("doc_id", cost.cast("long").alias("cost")).join(open_rows.groupBy("doc_id").agg(F.min("label").alias("label")), "doc_id")
    there = cut_lineage(there.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("cost").alias("cost")))
    picked = []
    for k in (0, 1):
        left = most_cost
        for r in there.filter(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows_per_label).collect():
            if r.cost <= left:
                left -= r.cost
                picked.append((r.doc_id, k))
    # The limit bounds what is broadcast.
    chosen = F.broadcast(docs.sparkSession.createDataFrame(picked, "doc_id long, label int"))
    rows = texts.join(chosen, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("label").alias("label"))
    return rows.select("text", "label", "doc_id").toArrow().sort_by("doc_id").select(["text", "label"]), [seen.get(0, 0), seen.get(1, 0)]


def row_filter(scores: Callable[[pa.Array], np.ndarray], at: int, keep: Callable[[np.ndarray], np.ndarray]):
    """A mapInArrow function that keeps the rows whose text, in column number at, has a score that keep accepts."""

    def run(batches):
        vectext.release()
        for batch in batches:
            for start, stop in vectext.blocks(batch.column(at)):
                part = batch.slice(start, stop - start)
                yield part.filter(pa.array(keep(scores(part.column(at)))))

    return vectext.frugal(run)
