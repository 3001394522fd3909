"""Rule extraction: from grids of cells to tables of named rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.naming import first_case, table_title
from ..functions.text import clean_cell, strip
from .verify import bound, once

# fixed values: header patterns in the order they are tried, and the standard headers
HEADERS = [("param", "Parameter"), ("symbol", "Symbol"), ("test.*cond|condition", "Test_Conditions"), ("^min", "Min"), ("^typ", "Typ"), ("^max", "Max"), ("unit", "Unit"), ("desc", "Description")]
STANDARD = ("Parameter", "Min", "Typ", "Max", "Unit")
STANDARD_CONFIDENCE, OTHER_CONFIDENCE, FALLBACK = 0.9, 0.6, 0.7


def _meets(text: Column, pattern: str) -> Column:
    """Whether a pattern is found; plain words are looked for as such."""
    if pattern.isalpha():
        return text.contains(pattern)
    return text.startswith(pattern[1:]) if pattern[0] == "^" and pattern[1:].isalpha() else text.rlike(pattern)


def normal_header(cell: Column) -> Column:
    named = lambda low: first_case([(_meets(low, p), F.lit(n)) for p, n in HEADERS], F.when(F.coalesce(cell, F.lit("")) == "", "Unknown").otherwise(cell))
    return bound(F.lower(strip(F.coalesce(cell, F.lit("")))), named)


def has_standard_headers(headers: Column) -> Column:
    return F.size(F.array_intersect(headers, F.array(*[F.lit(s) for s in STANDARD]))) >= 3


def last_wins(entries: Column) -> Column:
    """A map from entries (k, v), the last of equal keys winning, whatever the session does with duplicates."""

    def kept(found: Column) -> Column:
        return bound(F.transform(found, lambda e: e["k"]), lambda keys: F.filter(found, lambda e, i: ~F.coalesce(F.array_contains(F.slice(keys, i + 2, F.size(keys)), e["k"]), F.lit(False))))

    return F.map_from_entries(bound(entries, kept))


def row_map(headers: Column, row: Column) -> Column:
    """Cells by header; cells beyond the headers are named by their column."""
    entries = F.transform(row, lambda c, i: F.struct(F.coalesce(F.get(headers, i), F.concat(F.lit("col_"), i.cast("string"))).alias("k"), clean_cell(c).alias("v")))
    return last_wins(entries)


def tables_from_grids(grids: DataFrame) -> DataFrame:
    """Tables from doc_id, page_num, table_idx, text and grid (array of rows of cells; row 0 names the columns).

    Grids of fewer than two rows give none; rows whose cells are all null or empty are left out, while
    a cell of blanks keeps its row. Confidence is 0.9 with three standard headers, else 0.6.
    """
    headers = F.transform(F.col("grid")[0], normal_header)
    filled = F.filter(F.slice("grid", F.lit(2), F.size("grid")), lambda r: F.exists(r, lambda c: F.coalesce(c, F.lit("")) != ""))
    out = once(grids.where(F.size("grid") >= 2), "headers", headers)
    return out.select(
        "doc_id", F.format_string("table_p%d_%d", "page_num", "table_idx").alias("table_id"), "page_num", "table_idx", table_title(F.coalesce("text", F.lit("")), F.col("table_idx")).alias("title"), "headers",
        F.transform(filled, lambda r: row_map(F.col("headers"), r)).alias("rows"), F.when(has_standard_headers(F.col("headers")), STANDARD_CONFIDENCE).otherwise(OTHER_CONFIDENCE).alias("confidence"),
        F.lit("rule_based").alias("extraction_method"), F.col("grid").alias("raw_data"),
    )


def grids_of_pages(pages: DataFrame) -> DataFrame:
    """One row for each grid of a page (doc_id, page_num, text, tables)."""
    return pages.select("doc_id", "page_num", "text", F.posexplode("tables").alias("table_idx", "grid"))


def pages_for_fallback(pages: DataFrame, tables: DataFrame) -> DataFrame:
    """Pages without a table, or with none of confidence 0.7 or more: those a model is asked about."""
    best = tables.groupBy("doc_id", "page_num").agg(F.max("confidence").alias("best"))
    return pages.join(best, ["doc_id", "page_num"], "left").where(F.coalesce("best", F.lit(0.0)) < FALLBACK).drop("best")


def extract_page_tables(pages: DataFrame, ask=None) -> DataFrame:
    """Rule tables of the pages, and those that `ask` (pages -> tables) finds on pages where rules do badly."""
    tables = tables_from_grids(grids_of_pages(pages))
    if ask is None:
        return tables
    return tables.unionByName(ask(pages_for_fallback(pages, tables)), allowMissingColumns=True)
