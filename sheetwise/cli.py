"""Command line: extract, batch, scan, verify, export, stats.

python -m sheetwise.cli batch IN OUT --parser package.module:function [--second package.module:function] [--csv]

A parser yields the pages of a file's bytes as dicts (text, tables, width, height). With a second one (a
reader of other means, such as a model behind a parser) every table is read twice and verified; a table
that one of them alone finds stands on its own, as all do without a second parser. All tables of a file
are kept, one row each; the parameters of a file come from all of them, in the order of pages.
"""

import argparse
import importlib
import sys
import time
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.text import file_stem
from .operators import batch, params, rules, verify
from .sources import files

TABLE = "struct<table_id: string, title: string, headers: array<string>, rows: array<map<string,string>>, confidence: double, extraction_method: string>"


def session() -> SparkSession:
    return SparkSession.builder.appName("sheetwise").config("spark.sql.session.timeZone", "UTC").config("spark.sql.mapKeyDedupPolicy", "LAST_WIN").getOrCreate()


def load(name: str):
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def tables_of(pages: DataFrame, name: str) -> DataFrame:
    tables = rules.extract_page_tables(pages)
    return tables.select("doc_id", "page_num", "table_idx", F.struct("table_id", "title", "headers", "rows", "confidence", "extraction_method").alias(name))


def process(found: DataFrame, parse, second=None, keep=lambda df, name: df) -> DataFrame:
    """Results of files, one row for each table (doc_id, page_num, table_idx) and one for each file without any; `error` where a file failed.

    `keep` may write a table and return the written one, so that files are parsed once.
    """
    pages = keep(files.read_pages(found, parse), "pages")
    errors = pages.groupBy("doc_id").agg(F.first("error", ignorenulls=True).alias("error"))
    tables = tables_of(pages, "vision")
    if second is None:
        pairs = tables.withColumn("rule", F.lit(None).cast(TABLE))
    else:
        both = tables_of(keep(files.read_pages(found, second), "second"), "seen").join(tables.withColumnRenamed("vision", "read"), ["doc_id", "page_num", "table_idx"], "full")
        pairs = both.select("doc_id", "page_num", "table_idx", F.coalesce("seen", "read").alias("vision"), F.when(F.col("seen").isNotNull(), F.col("read")).alias("rule"))
    return verify.verify_tables(pairs).join(errors, "doc_id", "full")


def of_documents(results: DataFrame) -> DataFrame:
    """One row for each file: its worst confidence, its first table's confidence, method and id, and the first error."""
    first = F.struct("page_num", "table_idx", F.col("vision.confidence").alias("confidence"), F.col("vision.extraction_method").alias("method"), F.col("vision.table_id").alias("table_id"))
    docs = results.groupBy("doc_id").agg(F.min("confidence").alias("confidence"), F.min(F.when(F.col("vision").isNotNull(), first)).alias("t"), F.first("error", ignorenulls=True).alias("error"))
    return docs.select("doc_id", F.col("doc_id").alias("source_file"), "confidence", F.col("t.confidence").alias("table_confidence"), F.col("t.method").alias("method"), F.when(F.col("t").isNotNull(), F.array("t.table_id")).alias("table_ids"), "error")


def numbers_of(results: DataFrame) -> DataFrame:
    return params.long_parameters(results.where("vision IS NOT NULL"), order=("page_num", "table_idx"))


def importer_of(results: DataFrame) -> DataFrame:
    docs = of_documents(results).where("table_ids IS NOT NULL")
    wide = params.parameter_maps(numbers_of(results)).join(docs.select("doc_id", "source_file", "confidence"), "doc_id", "right")
    none = F.lit(None).cast("string")
    return params.importer_rows(wide.withColumns({"params": F.coalesce("params", F.create_map().cast("map<string,double>")), "mpn": none, "manufacturer": none}))


def wide_of(results: DataFrame) -> DataFrame | None:
    """The wide table of all parameters; None without a document that has one."""
    told = numbers_of(results).join(of_documents(results).select("doc_id", "source_file", "confidence"), "doc_id").withColumn("status", F.lit("success"))
    names = params.parameter_names(told)
    return params.wide_rows(told, names) if names else None


def documents_of(results: DataFrame) -> DataFrame:
    """One document for each table that was verified, as `documents_out` gives it."""
    return params.documents_out(results.withColumn("doc_id", F.concat(file_stem(F.col("doc_id")), F.format_string("_p%d_%d", "page_num", "table_idx"))))


def kept_under(spark: SparkSession, out: str):
    """Writes tables to a folder of this run below the output."""
    folder = f"{out}/work/{uuid.uuid4().hex}"

    def keep(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    return keep


def scan(spark: SparkSession, source: str, out: str, parse, pattern: str = "*.pdf") -> None:
    """One JSON document for each file: what its pages hold by rules alone."""
    pages = kept_under(spark, out)(files.read_pages(files.list_files(spark, source, pattern), parse), "pages")
    files.write_documents(files.page_documents(pages, rules.extract_page_tables(pages)), f"{out}/documents")


def run_batch(spark: SparkSession, source: str, out: str, parse, pattern: str = "*.pdf", csv: bool = False, second=None) -> DataFrame:
    """Files without an output yet; writes results, report and, if asked, the importer CSV. Returns the summary."""
    began = time.monotonic()
    every = files.list_files(spark, source, pattern)
    try:
        done = spark.read.parquet(f"{out}/results").select(F.concat(file_stem("doc_id"), F.lit(batch.ENDING)).alias("path")).distinct()
    except Exception as e:  # no earlier run
        if "PATH_NOT_FOUND" not in str(e):
            raise
        done = spark.createDataFrame([], "path string")
    todo = batch.pending_files(every, done)
    process(todo, parse, second, kept_under(spark, out)).write.mode("append").parquet(f"{out}/results")
    written = spark.read.parquet(f"{out}/results")
    docs = of_documents(written)
    status = F.when(F.col("error").isNotNull() | F.col("table_ids").isNull(), "failed").otherwise("success")
    now = docs.join(todo.select(F.col("path").alias("doc_id")), "doc_id", "left_semi").select(F.col("doc_id").alias("file"), status.alias("status"), "confidence", F.lit(out).alias("output"), F.coalesce("error", F.lit("no table")).alias("error"))
    skipped = every.join(now.select(F.col("file").alias("path")), "path", "left_anti").select(F.col("path").alias("file"), F.lit("skipped").alias("status"), F.lit(None).cast("double").alias("confidence"), F.lit(out).alias("output"), F.lit("").alias("error"))
    both = now.unionByName(skipped)
    files.write_report(batch.batch_report(both, time.monotonic() - began, datetime.now().isoformat()), f"{out}/report")
    if csv:
        files.write_csv(importer_of(written), f"{out}/for_import_script")
    return batch.batch_summary(both)


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="sheetwise")
    commands = p.add_subparsers(dest="command", required=True)
    for name in ("extract", "batch", "scan"):
        c = commands.add_parser(name)
        c.add_argument("source")
        c.add_argument("out")
        c.add_argument("--parser", required=True)
        c.add_argument("--second")
        c.add_argument("--pattern", default="*.pdf")
        c.add_argument("--csv", action="store_true")
    for name in ("verify", "stats"):
        commands.add_parser(name).add_argument("out")
    c = commands.add_parser("export")
    c.add_argument("out")
    c.add_argument("target")
    c.add_argument("--format", choices=["csv", "wide", "review", "documents"], default="csv")
    a = p.parse_args(args)
    spark = session()
    if a.command == "scan":
        scan(spark, a.source, a.out, load(a.parser), a.pattern)
        return 0
    if a.command in ("extract", "batch"):
        summary = run_batch(spark, a.source, a.out, load(a.parser), a.pattern, a.csv, load(a.second) if a.second else None).first()
        print(", ".join(f"{k} {v}" for k, v in summary.asDict().items()))
        return int(summary["failed"] > 0)
    results = spark.read.parquet(f"{a.out}/results").where("vision IS NOT NULL")
    if a.command == "verify":
        rows = results.select("doc_id", "vision.table_id", "status", "confidence", "resolution_method", F.size("conflicts").alias("conflict_count"))
        print(*rows.columns, sep="\t")
        for r in rows.toLocalIterator():
            print(*r, sep="\t")
    elif a.command == "stats":
        print(", ".join(f"{k} {v}" for k, v in verify.verifier_stats(results).first().asDict().items()))
    elif a.format == "documents":
        files.write_documents(documents_of(results), a.target, name=F.col("doc_id"))
    elif a.format == "wide":
        wide = wide_of(results)
        if wide is not None:
            files.write_csv(wide, a.target)
    elif a.format == "review":
        files.write_json(params.review_records(of_documents(results).drop("error").join(params.listed_parameters(numbers_of(results)), "doc_id", "left")), a.target)
    else:
        files.write_csv(importer_of(results), a.target)
    return 0


if __name__ == "__main__":
    sys.exit(main())
