"""Best-fit packing by length-histogram planning (operator 9).

Pieces of documents are counted by length (at most LIMIT distinct lengths, so the histogram has a fixed bound), and
best-fit decreasing runs over those counts: bins with the same space left form one group, and a step puts one piece
of a length into each bin of the group that fits best. The plan is a list of runs (length, first rank, count, first
bin, offset); its size follows the number of distinct lengths, not of documents. Each piece then takes the slot of
its rank among the pieces of its length.

Ranks come from windows over (length, salt), salt being a hash of the piece, plus the number of pieces of that length
with smaller salts; a length that a third of all pieces share is spread over SALTS groups.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm import bpe
from sedimenta.session import cut_lineage

LIMIT = 4096
SALTS = 1024


def plan(histogram: dict[int, int], limit: int = LIMIT) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, count, first bin, offset) of best-fit decreasing over a histogram.

    Pieces rank..rank + count of a length go to bins bin..bin + count, one each, at that offset.
    """
    runs: list[tuple[int, int, int, int, int]] = []
    spaces: list[int] = []  # the spaces left of open groups, sorted
    groups: dict[int, list[tuple[int, int]]] = {}  # space: ranges (first bin, bins)
    bins = 0

    def put(space: int, first: int, count: int) -> None:
        if space:
            if space not in groups:
                groups[space] = []
                bisect.insort(spaces, space)
            groups[space].append((first, count))

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            k = bisect.bisect_left(spaces, length)
            if k == len(spaces):
                # No open bin fits: open bins for all that is left, each taking as many as fit, one layer at a time.
                layers = limit // length
                count = -(-left // layers)
                put(limit, bins, count)
                bins += count
                continue
            space = spaces[k]
            first, count = groups[space].pop()
            if not groups[space]:
                del groups[space]
                spaces.pop(k)
            taken = min(count, left)
            if taken < count:
                put(space, first + taken, count - taken)
            runs.append((length, rank, taken, first, limit - space))
            put(space - length, first, taken)
            rank, left = rank + taken, left - taken
    return runs


def _placer(runs: list[tuple[int, int, int, int, int]]):
    table = np.array(sorted(runs), np.int64).reshape(-1, 5)

    def run(batches):
        for batch in batches:
            length, rank = (np.asarray(batch.column(k)).astype(np.int64) for k in (3, 5))
            # Runs are sorted by (length, first rank): the last one at or before (length, rank) is the piece's.
            low = np.searchsorted(table[:, 0], length, "left")
            high = np.searchsorted(table[:, 0], length, "right")
            while True:
                open_ = high - low > 1
                if not open_.any():
                    break
                middle = (low + high) // 2
                after = open_ & (table[np.minimum(middle, len(table) - 1), 1] <= rank)
                low, high = np.where(after, middle, low), np.where(open_ & ~after, middle, high)
            at = table[low] if len(length) else table[:0]
            place = [pa.array(at[:, 3] + rank - at[:, 1], pa.int64()), pa.array(at[:, 4], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], *place], [*batch.schema.names[:5], "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, end_id: int = 1, path: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), a row for each piece of each row of docs.

    A document is its tokens and end_id; one longer than limit is cut into pieces of limit tokens, of which the last
    may be shorter. Null counts as empty: a piece of end_id alone. Repeated rows are documents of their own, each
    with its own place. Pieces of equal length are told apart by a hash of (doc_id, piece), then by those; between rows
    that agree in all of these the order is arbitrary, which changes nothing but which copy has which place. An empty
    table gives no rows. Further columns of docs are not read.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    pieces = cut_lineage(texts.mapInArrow(bpe.piece_maker(path or bpe.tokenizer_path(), limit, end_id), "doc_id long, piece int, start long, length long, ids_crc32 long"))
    pieces = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(SALTS)))

    counts = cut_lineage(pieces.groupBy("length", "salt").agg(F.count("*").alias("n")))
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most limit rows
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("length", "salt").orderBy("doc_id", "piece")
    ranked = pieces.withColumn("inside", F.row_number().over(inside) - 1).join(firsts, ["length", "salt"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("inside")).alias("rank"))
    return ranked.mapInArrow(_placer(plan(histogram, limit)), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
