"""Line dedup by distinct-site spread.

Each distinct line (by 64-bit hash) has a HyperLogLog sketch of the sites it stands on; sketches merge by aggregation,
first within a task, so a line on every page costs a row a task.  Lines whose estimate is near the threshold
get an exact distinct count; only then is a line called boilerplate and taken out of all documents but the one with the
smallest doc_id, so that no text vanishes from the corpus.  All of it runs in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shared import written
from . import textbuf as tb

#: Sites on which a line is boilerplate.
MIN_SITES = 10
#: Sketches have 2**LG_K registers (standard error about 1.04 / 2**(LG_K / 2)).
LG_K = 12
#: Estimates within this share of the threshold are counted exactly: some ten standard errors.
MARGIN = 0.2


def site_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, site, line): the distinct hashes of the lines of each row that are not blank; a null source is a site of its own."""
    trimmed = F.transform(F.split("text", "\n"), lambda x: F.trim(x))
    hashes = F.array_distinct(F.transform(F.filter(trimmed, lambda x: x != ""), lambda x: F.xxhash64(x)))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col("source").cast("string"), F.lit(""))).alias("site"), F.explode(hashes).alias("line"))


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES, margin: float = MARGIN) -> DataFrame:
    """(line, first): lines on at least `min_sites` sites, and the smallest doc_id that has them."""
    spread = lines.groupBy("line").agg(F.hll_sketch_agg("site", F.lit(LG_K)).alias("sketch"), F.min("doc_id").alias("first"))
    near = F.hll_sketch_estimate("sketch")
    many = written(spread.select("line", "first", near.alias("sites")).where(F.col("sites") >= min_sites * (1 - margin)), "spread")
    unsure = many.where(F.col("sites") <= min_sites * (1 + margin))
    exact = lines.join(unsure.select("line"), "line", "left_semi").select("line", "site").distinct().groupBy("line").agg(F.count("*").alias("sites")).where(F.col("sites") >= min_sites)
    sure = many.where(F.col("sites") > min_sites * (1 + margin))
    return sure.select("line", "first").union(unsure.select("line", "first").join(exact.select("line"), "line", "left_semi"))


def _hits(docs: DataFrame, min_sites: int) -> DataFrame:
    lines = written(site_lines(docs), "lines")
    found = lines.join(boilerplate(lines, min_sites), "line").where("doc_id != first")
    return found.groupBy("doc_id").agg(F.collect_set("line").alias("_gone"))


def _kept(text: Column, gone: Column) -> Column:
    """The lines of a text but those whose hash is in `gone`; all where that is null."""
    return F.filter(F.split(text, "\n"), lambda x: (F.trim(x) == "") | ~F.coalesce(F.array_contains(gone, F.xxhash64(F.trim(x))), F.lit(False)))


def dedup(docs: DataFrame, min_sites: int = MIN_SITES, digest: bool = False) -> DataFrame:
    """(doc_id, n_lines, n_removed, text) for each row of docs, without its boilerplate lines.

    Lines are split at newlines and compared without spaces around them; blank lines stay.  A null text has no lines and an
    empty result; rows with a null doc_id count for the spread and stay whole; rows that share a doc_id are one document.
    With digest, text is the SHA-256 of the text in hex.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(_hits(docs, min_sites), "doc_id", "left")
    rows = base.select("doc_id", F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long").alias("n_lines"), F.when(F.col("text").isNotNull(), _kept(F.col("text"), F.col("_gone"))).alias("kept"))
    text = F.coalesce(F.array_join("kept", "\n"), F.lit(""))
    n_lines = F.greatest("n_lines", F.lit(0))  # the size of null is -1 by some settings
    return rows.select("doc_id", n_lines.alias("n_lines"), F.when(F.col("kept").isNull(), 0).otherwise(n_lines - F.size("kept")).cast("long").alias("n_removed"), (F.sha2(text.cast("binary"), 256) if digest else text).alias("text"))


def clean(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """The rows of docs with boilerplate lines taken out of text, and n_chars counted anew.

    Rows that had lines taken out and have no word left go: all their lines stay in another document.
    """
    names = docs.columns
    key, gone = tb.fresh("_doc", names), tb.fresh("_gone", names)
    hits = _hits(docs, min_sites).select(F.col("doc_id").alias(key), F.col("_gone").alias(gone))
    rows = docs.join(hits, docs.doc_id == hits[key], "left").drop(key)
    cut = F.col(gone).isNotNull() & F.col("text").isNotNull()
    rows = rows.withColumn("text", F.when(cut, F.array_join(_kept(F.col("text"), F.col(gone)), "\n")).otherwise(F.col("text")))
    rows = rows.where(~cut | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in names:
        rows = rows.withColumn("n_chars", F.when(cut, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return rows.select(names)


def op2_line_spread(spark, sf_dir: str) -> DataFrame:
    """dedup() of all documents, the texts as digests."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return dedup(docs, digest=True).withColumnRenamed("text", "kept_sha256")


OP2_SQL = """
WITH lines AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents
), spread AS (
  SELECT trim(line, ' ') AS key, count(DISTINCT coalesce(source, '')) AS sites, min(doc_id) AS first FROM lines WHERE trim(line, ' ') <> '' GROUP BY 1
), judged AS (
  SELECT l.*, coalesce(s.sites >= 10 AND l.doc_id <> s.first, false) AS gone FROM lines l LEFT JOIN spread s ON trim(l.line, ' ') = s.key
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
