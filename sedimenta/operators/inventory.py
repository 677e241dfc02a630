"""The inventory of raw archives: what each file is, what it is called, which are kept, which are the best captures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.functions import classify, text
from sedimenta.operators.reduce import mark_best, mark_duplicates, unique_names


def inventory(files: DataFrame) -> DataFrame:
    """Entries of files (source_key, source_ord, relative, path, length, content).

    Order is that of sources, then of relative paths. Files whose content can't be read have status 'error' and their
    error in errors; all others have none. The hash is only computed for files that are kept.
    """
    name = F.element_at(F.split("relative", "/", -1), -1)
    rows = files.withColumn("ord", F.struct("source_ord", "relative")).withColumn("original_filename", name).withColumn("decoded_filename", text.decode_filename(name))
    base, query = text.split_name(F.col("decoded_filename"))
    rows = rows.withColumn("base", base).withColumn("pairs", text.query_pairs(query))
    rows = rows.withColumn("nature", classify.file_nature(F.col("base"))).withColumn("guess", classify.engine_and_type(F.col("base"), F.col("pairs")))
    rows = rows.withColumn("worth", classify.relevance(F.col("nature"), F.col("guess.page_type"))).withColumn("ids", classify.detected_ids(F.col("pairs")))
    rows = rows.withColumn("kept_name", classify.preserved_name(F.col("base"), F.col("pairs"), F.col("nature")))
    rows = rows.withColumn("folder", classify.bucket_dir(F.col("source_key"), F.col("guess.engine"), F.col("nature"), F.col("guess.page_type")))
    kept = F.col("worth.materialize")
    rows = rows.withColumn("sha256", F.when(kept, F.sha2("content", 256))).withColumn("failed", F.col("content").isNull()).drop("content")
    return _finished(rows)


def _finished(rows: DataFrame) -> DataFrame:
    kept = F.col("worth.materialize")
    # Only kept files take names; others get places of their own, so that no window holds them all.
    rows = rows.withColumn("name", F.col("kept_name.name")).withColumn("place", F.when(kept, F.col("folder")).otherwise(F.concat(F.lit("\x00"), "source_key", F.lit("/"), "relative")))
    rows = unique_names(rows, "place", "name", ["ord"])
    rows = rows.withColumn("collided", F.col("collided") & kept).withColumn("unique_name", F.when(kept, F.col("unique_name")))
    rows = rows.withColumn("dup_key", F.coalesce("sha256", F.concat(F.lit("\x00"), "source_key", F.lit("/"), "relative")))
    rows = mark_duplicates(rows, "dup_key", ["ord"], "is_physical_duplicate")
    guess = {k: F.col(f"guess.{k}") for k in ("engine", "page_type", "confidence")}
    rows = rows.withColumn("warnings", classify.warning_codes(guess["confidence"], guess["engine"], guess["page_type"], F.col("nature"), kept, F.col("collided")))
    rows = rows.withColumn("logical_group_key", classify.group_key(guess["engine"], guess["page_type"], F.col("ids")))
    rows = rows.withColumn("rank", classify.rank_key(F.col("is_physical_duplicate"), guess["confidence"], F.size("warnings"), F.col("unique_name")))
    rows = rows.withColumn("group", F.coalesce("logical_group_key", F.concat(F.lit("\x00"), "source_key", F.lit("/"), "relative")))
    rows = mark_best(rows, "group", ["rank", "ord"], "best").withColumn("best", F.col("best") & F.col("logical_group_key").isNotNull())
    none = F.array().cast("array<struct<code:string,message:string>>")
    errors = F.when(F.col("failed"), F.array(F.struct(F.lit("file_processing_failed").alias("code"), F.lit("the content could not be read").alias("message")))).otherwise(none)
    flags = F.col("kept_name.flags").withField("collision_suffix_added", F.col("collided"))
    return rows.select(
        "source_key", F.lit("file").alias("entry_type"), F.col("relative").alias("original_relative_path"), F.col("path").alias("original_absolute_path"), "original_filename", "decoded_filename",
        F.when(kept, F.concat_ws("/", "folder", "unique_name")).alias("normalized_relative_path"), F.col("unique_name").alias("normalized_filename"),
        guess["engine"].alias("engine_family"), guess["page_type"].alias("page_type_guess"), guess["confidence"].alias("classification_confidence"), F.col("nature").alias("file_nature"),
        F.col("worth.relevance").alias("relevance_preliminary"), kept.alias("should_materialize_normalized"), F.col("worth.reason").alias("materialization_reason"),
        F.col("ids").alias("detected_ids"), flags.alias("normalization"), F.col("length").alias("size_bytes"), "sha256",
        F.when(F.col("sha256").isNotNull(), F.concat(F.lit("sha256:"), "sha256")).alias("physical_duplicate_group"), "is_physical_duplicate", "logical_group_key",
        F.col("best").alias("canonical_candidate_preliminary"),
        F.when(F.col("failed"), "error").otherwise(classify.status(guess["confidence"], F.col("nature"), guess["page_type"], kept)).alias("status"), "warnings", errors.alias("errors"),
    )


def summary(entries: DataFrame) -> DataFrame:
    """One row of counters."""
    kept, topic = F.col("should_materialize_normalized"), F.col("logical_group_key").contains(":topic:") | F.col("logical_group_key").contains(":viewtopic:")
    return entries.agg(
        F.count("*").alias("files_scanned"),
        F.count_if(kept).alias("files_materialized"),
        F.count_if(~kept).alias("files_not_materialized"),
        F.count_if("is_physical_duplicate").alias("physical_duplicate_files"),
        F.count_if(F.col("file_nature") == "unknown").alias("unknown_files"),
        F.coalesce(F.sum(F.size("warnings")), F.lit(0)).alias("warnings"),
        F.count_if(F.col("status") == "error").alias("errors"),
        F.countDistinct("logical_group_key").alias("logical_groups"),
        F.countDistinct(F.when(topic, F.col("logical_group_key"))).alias("topic_groups"),
        F.countDistinct(F.when(F.col("is_physical_duplicate"), F.col("physical_duplicate_group"))).alias("physical_duplicate_groups"),
    )


def exceptions(entries: DataFrame, stage: str = "prepare") -> DataFrame:
    """A row for each error of an entry: when and in which stage it was found, of which file, why, and the exception's class and message."""
    found = entries.filter(F.size("errors") > 0).select("source_key", "original_relative_path", F.explode("errors").alias("e"))
    return found.select(F.current_timestamp().alias("timestamp"), F.lit(stage).alias("stage"), "source_key", "original_relative_path", F.col("e.code").alias("reason"), F.concat(F.lit("OSError: "), "e.message").alias("exception"))
