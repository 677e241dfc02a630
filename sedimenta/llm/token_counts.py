"""Token counts from an exact length histogram (operator 10).

Documents are encoded once and aggregated by their number of tokens; the histogram is the only thing that later steps
read. Sums over all longer (and all shorter) lengths then answer totals, quantiles and truncated totals for every
context limit. The sums are taken within blocks of BLOCK lengths, and over blocks, so that no task holds all lengths.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm import bpe
from sedimenta.session import cut_lineage

BLOCK = 256
QUANTILES = (0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 1.0)


def length_histogram(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(n_tokens, n_docs). Null counts as empty, of 0 tokens; every row counts, repeated ones too."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    counted = texts.mapInArrow(bpe.token_counter(path or bpe.tokenizer_path()), "doc_id long, n_tokens long")
    return counted.groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def context_limits(histogram: DataFrame) -> DataFrame:
    """For every distinct length as a context limit: (context_limit, n_docs, docs_within, docs_over, tokens_within, tokens_truncated,
    tokens_total, tokens_lost, share_within).

    n_docs have just that length; docs_within have at most it, with tokens_within tokens; docs_over have more.
    tokens_truncated is the sum of min(length, limit) over all documents, tokens_lost what that cuts from
    tokens_total. share_within is docs_within over all documents, so that the q-quantile of length is the smallest
    limit with share_within >= q. Limits between two lengths have the values of quantity() below. An empty histogram
    gives no rows.
    """
    rows = cut_lineage(histogram.select("n_tokens", "n_docs", (F.col("n_tokens") * F.col("n_docs")).alias("tokens"), (F.col("n_tokens") / BLOCK).cast("long").alias("block")))
    blocks = rows.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    # A row for each block of lengths: the longest document's tokens over BLOCK, at most.
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("d").over(earlier), F.lit(0)).alias("d_before"),
        F.coalesce(F.sum("t").over(earlier), F.lit(0)).alias("t_before"),
        F.sum("d").over(everything).alias("d_all"),
        F.sum("t").over(everything).alias("t_all"),
    )
    upto = Window.partitionBy("block").orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("d_in", F.sum("n_docs").over(upto)).withColumn("t_in", F.sum("tokens").over(upto)).join(blocks, "block")
    rows = rows.withColumn("docs_within", F.col("d_before") + F.col("d_in")).withColumn("tokens_within", F.col("t_before") + F.col("t_in"))
    rows = rows.withColumn("docs_over", F.col("d_all") - F.col("docs_within")).withColumn("tokens_truncated", F.col("tokens_within") + F.col("docs_over") * F.col("n_tokens"))
    return rows.select(
        F.col("n_tokens").alias("context_limit"),
        "n_docs",
        "docs_within",
        "docs_over",
        "tokens_within",
        "tokens_truncated",
        F.col("t_all").alias("tokens_total"),
        (F.col("t_all") - F.col("tokens_truncated")).alias("tokens_lost"),
        (F.col("docs_within") / F.col("d_all")).alias("share_within"),
    )


def quantiles(limits: DataFrame, shares: tuple[float, ...] = QUANTILES) -> DataFrame:
    """(share, n_tokens): the smallest length that at least that share of documents does not exceed."""
    return limits.agg(*(F.min(F.when(F.col("share_within") >= q, F.col("context_limit"))).alias(str(q)) for q in shares)).select(
        F.explode(F.array(*(F.struct(F.lit(q).alias("share"), F.col(f"`{q}`").alias("n_tokens")) for q in shares))).alias("x")
    ).select("x.*")


def quantity(limits: DataFrame, context: int) -> DataFrame:
    """One row for any limit, a length of the corpus or not: (context, docs_within, tokens_truncated)."""
    total = F.max("tokens_total") - F.coalesce(F.max(F.when(F.col("context_limit") <= context, F.col("tokens_within"))), F.lit(0))
    within = F.coalesce(F.max(F.when(F.col("context_limit") <= context, F.col("docs_within"))), F.lit(0))
    over = F.sum(F.when(F.col("context_limit") > context, F.col("n_docs")))
    tokens = F.max("tokens_total") - total + F.coalesce(over, F.lit(0)) * context
    return limits.agg(within.alias("docs_within"), tokens.alias("tokens_truncated")).select(F.lit(context).alias("context"), "*")
