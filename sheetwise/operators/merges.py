"""Merged cells of grids: detection from blanks and widths, and resolution.

Blanks after a category word count as one merged cell; a lone missing value may be taken for one, as
documented in the README.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip
from .verify import bound, once

MERGES = "array<struct<row: int, col_start: int, col_end: int, content: string, merge_type: string, confidence: double>>"
# fixed values
CATEGORY = r"^(input|output|power|thermal|timing|electrical)|characteristics$|^(absolute|recommended|operating)|conditions$|^(dc|ac)\s"
HEADER_CONFIDENCE, ROW_CONFIDENCE, WIDTH_CONFIDENCE, FALLBACK, WIDE, MOST = 0.85, 0.70, 0.90, 0.60, 1.5, 4


def is_category(text: Column) -> Column:
    """Whether a cell names a category: a known phrase, or over four fifths letters."""
    bare = strip(F.coalesce(text, F.lit("")))
    share = F.regexp_count(bare, F.lit(r"\p{L}")) / F.length(bare)
    return F.when(bare == "", F.lit(False)).otherwise(F.lower(bare).rlike(CATEGORY) | (share > 0.8))


def _blank(c: Column) -> Column:
    return strip(F.coalesce(c, F.lit(""))) == ""


def spans(row: Column) -> Column:
    """For each filled cell: its column, its text and how many columns it spans with the blanks after it."""
    found = F.filter(F.transform(row, lambda c, i: F.struct(i.alias("col"), c.alias("cell"))), lambda x: ~_blank(x["cell"]))
    width = lambda filled: lambda x, i: F.coalesce(F.get(filled, i + 1)["col"], F.size(row)) - x["col"]
    return bound(found, lambda filled: F.transform(filled, lambda x, i: F.struct(x["col"].alias("col"), x["cell"].alias("cell"), width(filled)(x, i).alias("span"))))


def _merge(row: Column, col: Column, end: Column, content: Column, confidence: float) -> Column:
    return F.struct(row.cast("int").alias("row"), col.cast("int").alias("col_start"), end.cast("int").alias("col_end"), content.alias("content"), F.lit("horizontal").alias("merge_type"), F.lit(confidence).alias("confidence"))


def header_merges(found: Column) -> Column:
    """Merges of row 0, where it has fewer filled cells than row 1; `found` has the spans of each row."""
    wide = F.filter(found[0], lambda x: x["span"] > 1)
    return F.when(F.size(found[0]) < F.size(found[1]), F.transform(wide, lambda x: _merge(F.lit(0), x["col"], x["col"] + x["span"] - 1, strip(x["cell"]), HEADER_CONFIDENCE))).otherwise(F.array().cast(MERGES))


def row_merges(found: Column) -> Column:
    """Spans of two to four columns of any row that start with a category; `found` has the spans of each row."""
    one = lambda r, i: F.transform(F.filter(r, lambda x: (x["span"] > 1) & (x["span"] <= MOST) & is_category(x["cell"])), lambda x: _merge(i, x["col"], x["col"] + x["span"] - 1, strip(x["cell"]), ROW_CONFIDENCE))
    return F.flatten(F.transform(found, one))


def column_widths(positions: Column) -> Column:
    """Upper median of the widths of each column; 0 without any."""
    columns = F.sequence(F.lit(0), F.greatest(F.lit(0), F.array_max(F.transform(positions, lambda r: F.size(r))) - 1))

    def median(c: Column) -> Column:
        cells = F.filter(F.transform(positions, lambda r: F.get(r, c)), lambda p: p.isNotNull())
        widths = F.array_sort(F.transform(cells, lambda p: p["x1"] - p["x0"]))
        return bound(widths, lambda w: F.coalesce(F.get(w, F.floor(F.size(w) / 2).cast("int")), F.lit(0.0)))

    return F.transform(columns, median)


def width_merges(grid: Column, positions: Column) -> Column:
    """Cells at least twice as wide as their column's median."""

    def one(r: Column, i: Column, widths: Column) -> Column:
        cells = F.transform(r, lambda p, c: F.struct(c.alias("c"), (p["x1"] - p["x0"]).alias("w"), F.coalesce(F.get(widths, c), F.lit(0.0)).alias("m")))
        wide = F.filter(cells, lambda x: (x["m"] > 0) & (x["w"] > WIDE * x["m"]) & (F.floor(x["w"] / x["m"]) > 1))
        return F.transform(wide, lambda x: _merge(i, x["c"], x["c"] + F.floor(x["w"] / x["m"]) - 1, strip(F.coalesce(F.get(F.get(grid, i), x["c"]), F.lit(""))), WIDTH_CONFIDENCE))

    return F.coalesce(bound(column_widths(positions), lambda w: F.flatten(F.transform(positions, lambda r, i: one(r, i, w)))), F.array().cast(MERGES))


def best_merges(found: Column) -> Column:
    """One for each row and first column, the most confident and of these the first; in the order the keys were met."""
    entries = F.transform(found, lambda m, i: F.struct(m["row"].alias("row"), m["col_start"].alias("col"), (-m["confidence"]).alias("less"), i.alias("at"), m.alias("m")))

    def heads(ranked: Column) -> Column:
        new = lambda e, i: (i == 0) | (F.get(ranked, i - 1)["row"] != e["row"]) | (F.get(ranked, i - 1)["col"] != e["col"])
        return F.filter(ranked, lambda e, i: F.coalesce(new(e, i), F.lit(True)))

    # in order of keys and of their first places: the same keys one after another
    places = F.transform(entries, lambda e: F.struct(e["row"].alias("row"), e["col"].alias("col"), e["at"].alias("at")))
    pairs = F.zip_with(bound(F.array_sort(places), heads), bound(F.array_sort(entries), heads), lambda first, best: F.struct(first["at"].alias("at"), best["m"].alias("m")))
    return F.transform(F.array_sort(pairs), lambda p: p["m"])


def detect_merges(grids: DataFrame, positions: str | None = None) -> DataFrame:
    """Adds merges, merge_confidence (mean, 1 without any) and needs_vision to grids; grids of fewer than two rows have none."""
    grid = F.col("grid")
    spread = once(grids, "_spans", F.when(F.size(grid) >= 2, F.transform(grid, spans)))
    parts = [header_merges(F.col("_spans")), row_merges(F.col("_spans"))] + ([width_merges(grid, F.col(positions))] if positions else [])
    found = once(spread, "_found", F.when(F.size(grid) >= 2, F.concat(*parts)).otherwise(F.array().cast(MERGES)))
    out = once(found, "merges", best_merges(F.col("_found"))).drop("_found", "_spans")
    confidence = merge_confidence(F.col("merges"))
    return out.withColumn("merge_confidence", confidence).withColumn("needs_vision", F.col("merge_confidence") < FALLBACK)


def merge_confidence(merges: Column) -> Column:
    """Mean confidence, 1 without a merge."""
    return F.when(F.size(merges) > 0, F.aggregate(merges, F.lit(0.0), lambda a, m: a + m["confidence"]) / F.size(merges)).otherwise(1.0)


def enhance_tables(grids: DataFrame, positions: str | None = None) -> DataFrame:
    """doc_id, resolved_headers, resolved_rows, merge_confidence and needs_vision of grids: detection and resolution together."""
    return resolve_merges(detect_merges(grids, positions)).select("doc_id", "resolved_headers", "resolved_rows", "merge_confidence", "needs_vision")


def resolve_merges(detected: DataFrame) -> DataFrame:
    """Adds resolved_headers and resolved_rows: a blank header in a merge of row 0 takes its text, and so does every cell in a merge of its row; cells beyond the headers go, the last of equal headers wins."""
    from .rules import last_wins

    grid, merges = F.col("grid"), F.col("merges")
    inside = lambda row, col: F.filter(merges, lambda m: (m["row"] == row) & (m["col_start"] <= col) & (col <= m["col_end"]))
    headers = F.transform(grid[0], lambda h, i: F.when(_blank(h), F.coalesce(F.get(inside(F.lit(0), i), F.lit(0))["content"], h, F.lit(""))).otherwise(h))
    out = detected.withColumn("resolved_headers", F.when(F.size(grid) > 0, headers).otherwise(F.array().cast("array<string>")))
    known = F.col("resolved_headers")

    def row(r: Column, i: Column) -> Column:
        cells = F.transform(F.slice(r, F.lit(1), F.size(known)), lambda c, k: F.struct(F.get(known, k).alias("k"), F.coalesce(F.get(inside(i + 1, k), F.lit(0))["content"], strip(F.coalesce(c, F.lit("")))).alias("v")))
        return last_wins(cells)

    rest = F.slice(grid, F.lit(2), F.greatest(F.size(grid) - 1, F.lit(0)))
    return out.withColumn("resolved_rows", F.transform(rest, row))
