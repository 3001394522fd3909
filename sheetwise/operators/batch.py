"""Batches of files: what is left to do, and what was done."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import file_stem, percent

ENDING = "_v04.json"


def pending_files(files: DataFrame, outputs: DataFrame) -> DataFrame:
    """Files (column path) without an output <stem>_v04.json in `outputs` (column path)."""
    stems = outputs.where(F.col("path").endswith(ENDING)).select(F.regexp_replace(F.regexp_extract("path", r"([^/]*)$", 1), f"{ENDING}$", "").alias("_stem")).distinct()
    return files.withColumn("_stem", file_stem(F.col("path"))).join(stems, "_stem", "left_anti").drop("_stem")


def batch_summary(results: DataFrame) -> DataFrame:
    """total, success, failed, skipped and success_rate over file results (column status)."""
    out = results.agg(F.count("*").alias("total"), *[F.count_if(F.col("status") == s).alias(s) for s in ("success", "failed", "skipped")])
    return out.withColumn("success_rate", F.col("success") / F.greatest(F.col("total") - F.col("skipped"), F.lit(1)))


def batch_report(results: DataFrame, seconds: float, generated: str, extractor: str = "sheetwise") -> DataFrame:
    """Lines (ord, line) of the Markdown report; sort by ord when writing. Columns: file, status, confidence, output, error."""
    # fixed values: headings and shapes of the report's lines
    spark = results.sparkSession
    lines = lambda first, texts: spark.createDataFrame([(first, str(i).zfill(4), x) for i, x in enumerate(texts)], "part int, ord string, line string")
    head = lines(0, ["# Batch Processing Report", "", f"**Generated:** {generated}", f"**Duration:** {seconds:.1f} seconds", "", "## Summary", "", "| Metric | Value |", "|--------|-------|"])
    cells = F.array(
        *[F.concat(F.lit(f"| {label} | "), F.col(c).cast("string"), F.lit(" |")) for label, c in (("Total Files", "total"), ("Success", "success"), ("Failed", "failed"), ("Skipped", "skipped"))],
        F.concat(F.lit("| Success Rate | "), percent(F.col("success_rate"), 1), F.lit(" |")),
    )
    summary = batch_summary(results).select(F.posexplode(cells).alias("i", "line")).select(F.lit(1).alias("part"), F.col("i").cast("string").alias("ord"), "line")
    done = results.where("status = 'success'").select(F.lit(3).alias("part"), F.col("file").alias("ord"), F.concat(F.lit("| "), "file", F.lit(" | "), percent(F.col("confidence")), F.lit(" | "), "output", F.lit(" |")).alias("line"))
    bad = results.where("status = 'failed'").select(F.lit(5).alias("part"), F.col("file").alias("ord"), F.concat(F.lit("| "), "file", F.lit(" | "), "error", F.lit(" |")).alias("line"))
    between = lines(2, ["", "## Successful Extractions", "", "| File | Confidence | Output |", "|------|------------|--------|"])
    errors = lines(4, ["", "## Errors", "", "| File | Error |", "|------|-------|"]).withColumn("any", F.lit(1)).join(results.where("status = 'failed'").limit(1).select(F.lit(1).alias("any")), "any", "left_semi").drop("any")
    foot = lines(6, ["", "---", f"*Generated by {extractor}*"])
    every = head
    for part in (summary, between, done, errors, bad, foot):
        every = every.unionByName(part)
    return every.select(F.struct("part", "ord").alias("ord"), "line")


def accuracy(cells: DataFrame, matched: str = "matched") -> DataFrame:
    """Share of matching cells, rows (all cells match) and tables (all rows match) over compared cells."""
    rows = cells.groupBy("doc_id", "row_idx").agg(F.count_if(F.col(matched)).alias("hit"), F.count("*").alias("n"))
    tables = rows.groupBy("doc_id").agg(F.sum("hit").alias("hit"), F.sum("n").alias("n"), F.count_if(F.col("hit") == F.col("n")).alias("row_hit"), F.count("*").alias("rows"))
    return tables.agg((F.sum("hit") / F.sum("n")).alias("cell_accuracy"), (F.sum("row_hit") / F.sum("rows")).alias("row_accuracy"), F.avg((F.col("hit") == F.col("n")).cast("double")).alias("table_accuracy"))
