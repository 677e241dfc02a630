"""Archived files as tables: inventories, ordered pages, decoded text."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.functions import classify, udfs
from sedimenta.functions.ordering import walk_order

KINDS = ["asp_topic", "asp_post", "asp_profile", "asp_members", "phpbb_viewtopic", "phpbb_profile", "phpbb_memberlist"]

# Fixed value: what makes a page suspect of a wrong encoding; it finds every page with a question, too.
MOJIBAKE = r"F\?|P\?|Usu\?|Endere\?|Localiza\?|\?\?|\? "


def parse_kinds(value: str | None) -> list[str]:
    """Kinds from a list with commas or blanks between them, in lower case; all if there is none."""
    return [k.lower() for k in (value or "").replace(",", " ").split()] or list(KINDS)


def relative_path(path: Column, root: str) -> Column:
    """A path below root, with '/' between its parts; a scheme and doubled slashes before root don't count."""
    plain = root.split("://")[-1].split(":", 1)[-1].strip("/")
    return F.regexp_replace(path, rf"\A(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?/*\Q{plain}\E/*", "")


def read_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """(path, modificationTime, length, content) of all files below root; a root that is missing is an error. Spark passes over names that begin with '_' or '.'."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return (reader.option("pathGlobFilter", glob) if glob else reader).load(root)


def inventory_sources(spark: SparkSession, roots: dict[str, str]) -> DataFrame:
    """Files of several sources, with source_key, source_ord (the order of roots) and relative."""
    parts = [
        read_files(spark, root).select(F.lit(key).alias("source_key"), F.lit(i).alias("source_ord"), relative_path(F.col("path"), root).alias("relative"), "path", "length", "content")
        for i, (key, root) in enumerate(roots.items())
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def folders(files: DataFrame, by: str = "source_key") -> DataFrame:
    """(by, folder): every folder that holds a file, at any depth."""
    parts = F.split("relative", "/", -1)
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    return files.filter(F.size(parts) > 1).select(by, F.explode(prefixes).alias("folder")).distinct()


def directories(files: DataFrame, roots: dict[str, str]) -> DataFrame:
    """Every folder of the sources as an entry: those that hold files, and below local roots those that hold nothing."""
    spark = files.sparkSession
    told = folders(files)
    bare = [(key, name) for key, root in roots.items() if os.path.isdir(root) for name in empty_folders(root)]
    if bare:  # from a walk on the driver, as file readers don't see them; folders that hold only empty ones come with them
        above = [(key, "/".join(name.split("/")[:n])) for key, name in bare for n in range(1, name.count("/") + 2)]
        told = told.union(spark.createDataFrame(above, "source_key string, folder string")).distinct()
    root = F.element_at(F.create_map(*(F.lit(x) for pair in roots.items() for x in pair)), F.col("source_key"))
    return told.select(
        "source_key", F.lit("directory").alias("entry_type"), F.col("folder").alias("relative_path"), F.concat_ws("/", root, "folder").alias("absolute_path"), F.regexp_replace("folder", r"/?[^/]*\z", "").alias("parent_relative_path"),
        F.lit("scanned").alias("status"), F.array().cast("array<string>").alias("warnings"), F.array().cast("array<struct<code:string,message:string>>").alias("errors"),
    )


def empty_folders(root: str) -> list[str]:
    """Folders without any entry, which file readers can't see; for local roots."""
    return sorted(os.path.relpath(d, root).replace(os.sep, "/") for d, names, files in os.walk(root) if not names and not files and d != root)


def charset_hint(content: Column) -> Column:
    """The charset that the first 4096 bytes of a page name, in an XML declaration or else anywhere; empty if none."""
    head = F.decode(F.substring(content, 1, 4096), "ISO-8859-1")
    declared = F.regexp_extract(head, r"(?is)<\?xml\b[^>]*encoding=[\"']([^\"']+)", 1)
    named = F.regexp_extract(head, r"(?is)charset\s*=\s*[\"']?([a-zA-Z0-9._-]+)", 1)
    return F.lower(F.when(declared != "", declared).otherwise(named))


def html_paths(files: DataFrame, kinds: list[str] | None = None, limit: int = 0) -> DataFrame:
    """files with rel, kind, domain, ord, of HTML pages of the given kinds; only the first limit of them in walk order if there is a limit.

    Only paths are looked at: which pages count is known before their bytes are.
    """
    pages = files.filter(F.lower("rel").endswith(".html")).withColumn("kind", classify.page_kind(F.concat(F.lit("/"), "rel"))).filter(F.col("kind").isin(kinds or KINDS))
    pages = pages.withColumn("ord", walk_order(F.col("rel")))
    if limit:
        chosen = pages.select("rel", "ord").orderBy("ord").limit(limit).select("rel")
        pages = pages.join(chosen, "rel", "left_semi")
    return pages


def read_pages(spark: SparkSession, root: str, kinds: list[str] | None = None, limit: int = 0, mode: str = "hint", repair: bool = False) -> DataFrame:
    """Decoded pages below a normalised tree: (rel, kind, domain, ord, html, decoder, charset, repaired, mojibake, error). A page that can't be decoded has an error and no html."""
    files = read_files(spark, root, "*.[hH][tT][mM][lL]")
    files = files.withColumn("rel", relative_path(F.col("path"), root))
    whole = F.when(F.contains(F.lower("path"), F.lit("/normalized/")), F.col("path")).otherwise(F.concat(F.lit("normalized/"), "rel"))
    pages = html_paths(files.withColumn("domain", classify.logical_domain(whole)), kinds, limit)
    return decode_pages(pages, mode, repair)


def decode_pages(pages: DataFrame, mode: str = "hint", repair: bool = False) -> DataFrame:
    hinted = pages.withColumn("charset", charset_hint(F.col("content")))
    decoded = hinted.withColumn("d", udfs.decoder(mode)(F.col("content"), F.col("charset")))
    html = F.when(F.col("d.text").isNotNull(), udfs.repair_mojibake(F.coalesce("d.text", F.lit("")))) if repair else F.col("d.text")
    rows = decoded.withColumn("html", html)
    changed = F.coalesce(F.col("html") != F.col("d.text"), F.lit(False))
    return rows.select("rel", "kind", "domain", "ord", "html", F.col("d.decoder").alias("decoder"), "charset", changed.alias("repaired"), F.coalesce(F.col("html").rlike(MOJIBAKE), F.lit(False)).alias("mojibake"), F.col("d.error").alias("error"))


def usable(pages: DataFrame) -> DataFrame:
    """Pages for the parsers."""
    return pages.filter("error is null").select("rel", "kind", "domain", "ord", "html")
