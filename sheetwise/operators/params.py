"""Parameters of verified tables, and the shapes they are exported in."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.naming import category, maker_of_part, part_of_file, review_name, review_part, source_reference, verification_methods
from ..functions.text import parse_float, percent
from .rules import last_wins
from .verify import bound, once

KINDS = ("Min", "Typ", "Max")
REVIEW_THRESHOLD, WIDEST = 0.95, 10_000
# fixed values: columns of the importer and the parameters behind them
IMPORTER = {
    "Vin_min": "input_voltage_range_min", "Vin_max": "input_voltage_range_max", "Vout_min": "output_voltage_min", "Vout_max": "output_voltage_max", "Iout_max": "output_current_max", "Iq_typ": "quiescent_current_typ",
    "Efficiency_typ": "efficiency_typ", "Frequency_typ": "switching_frequency_typ",
}


def long_parameters(tables: DataFrame, rows: str = "merged_rows", carry: list[str] | None = None, order: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, name, base, kind, num, unit and the document's columns in `carry`: the numeric cells of each table, last row wins per name and kind; unit is the last non-empty one of the name.

    One aggregation by document and name, over rows that are computed once. Tables of the same document stand in the
    order of the columns `order`. A row without a parameter
    name makes names without a first part. A table with a null name has no parameters at all and
    shows in `failed_parameters`.
    """
    carry = carry or []
    cells = _cells(tables, rows, [*carry, *[c for c in order if c not in carry]])
    place = F.struct(*order, "row_idx")
    last = lambda value, there: F.max_by(value, F.when(there, F.col("place")))
    numbers = {k: parse_float(F.col(k)) for k in KINDS}
    read = cells.select("doc_id", *carry, "base", place.alias("place"), "Unit", *[n.alias(k) for k, n in numbers.items()])
    folded = read.groupBy("doc_id", "base", *carry).agg(*[last(F.col(k), F.col(k).isNotNull()).alias(k.lower()) for k in KINDS], last(F.col("Unit"), F.col("Unit") != "").alias("unit"))
    kinds = F.array(*[F.struct(F.lit(k.lower()).alias("kind"), F.col(k.lower()).alias("num")) for k in KINDS])
    each = folded.select("doc_id", *carry, "base", "unit", F.explode(F.filter(kinds, lambda x: x["num"].isNotNull())).alias("x"))
    return each.select("doc_id", F.concat_ws("_", "base", "x.kind").alias("name"), "base", "x.kind", "x.num", "unit", *carry)


def _broken(rows: str) -> Column:
    return F.exists(F.col(rows), lambda r: F.map_contains_key(r, F.lit("Parameter")) & F.try_element_at(r, F.lit("Parameter")).isNull())


def failed_parameters(tables: DataFrame, rows: str = "merged_rows") -> DataFrame:
    """Documents whose parameters can't be named."""
    return tables.where(_broken(rows)).select("doc_id", F.lit("failed").alias("status"))


def _cells(tables: DataFrame, rows: str, carry: list[str] | None = None) -> DataFrame:
    get = lambda k: F.coalesce(F.try_element_at(F.col("r"), F.lit(k)), F.lit(""))
    read = once(tables.select("doc_id", *(carry or []), rows), "_rows", F.col(rows))
    cells = read.select("doc_id", *(carry or []), F.posexplode(F.when(~_broken("_rows"), F.col("_rows"))).alias("row_idx", "r"))
    return cells.select("doc_id", *(carry or []), "row_idx", F.replace(F.lower(get("Parameter")), F.lit(" "), F.lit("_")).alias("base"), *[get(k).alias(k) for k in (*KINDS, "Unit")])


def parameter_maps(params: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """doc_id, the map of its numeric parameters, and the document's columns in `carry`."""
    return params.groupBy("doc_id", *(carry or [])).agg(F.map_from_entries(F.collect_list(F.struct("name", "num"))).alias("params"))


def wide_parameters(params: DataFrame, names: list[str] | None = None, carry: list[str] | None = None) -> DataFrame:
    """A column for each parameter name, sorted by code point; names come from one distinct pass unless they are given."""
    names = names if names is not None else parameter_names(params)
    return params.groupBy("doc_id", *(carry or [])).pivot("name", names).agg(F.first("num"))


def parameter_names(params: DataFrame) -> list[str]:
    """All parameter names, sorted; they are the columns of a table, so the driver holds them (over 10,000 are an error)."""
    names = [r["name"] for r in params.select("name").distinct().limit(WIDEST + 1).collect()]
    if len(names) > WIDEST:
        raise ValueError(f"more than {WIDEST} parameter names make no wide table")
    return sorted(names)


def wide_rows(params: DataFrame, names: list[str] | None = None) -> DataFrame:
    """The rows of the wide CSV: source_file, confidence and status (columns of `params`, carried), then all parameters, sorted; missing values are empty."""
    wide = wide_parameters(params, names, ["source_file", "confidence", "status"])
    return wide.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in wide.columns if c != "doc_id"])


def importer_rows(documents: DataFrame, extractor: str = "sheetwise") -> DataFrame:
    """The 16 importer columns from doc_id, params (map), source_file, mpn, manufacturer and confidence; missing values are empty, and the note names the extractor."""
    text = lambda name: F.coalesce(F.try_element_at(F.col("params"), F.lit(name)).cast("string"), F.lit(""))
    note = F.concat(F.lit(f"Extracted by {extractor} (confidence: "), percent(F.coalesce("confidence", F.lit(0.0))), F.lit(")"))
    columns = {"MPN": part_of_file(F.col("mpn"), F.col("source_file")), "Manufacturer": F.coalesce("manufacturer", F.lit("")), "Category": category(F.col("params")), "Description": F.lit("")}
    columns |= {c: text(p) for c, p in list(IMPORTER.items())}
    columns |= {"Package": F.lit(""), "Status": F.lit("Active"), "Datasheet_URL": F.lit(""), "Notes": note}
    return documents.select(*[c.alias(n) for n, c in columns.items()])


def _reviewed(name: Column, value: Column, unit: Column) -> dict[str, Column]:
    """The review columns of a parameter whose document has table_confidence, confidence, method and table_ids."""
    confidence = F.coalesce("table_confidence", "confidence", F.lit(0.9))
    return {
        "param": review_name(name), "value": value, "unit": F.coalesce(unit, F.lit("")), "confidence": confidence,
        "source": source_reference(F.col("table_ids")), "verified_by": verification_methods(F.col("method")), "needs_review": confidence < REVIEW_THRESHOLD,
    }


def review_parameters(params: DataFrame) -> DataFrame:
    """One row for each parameter with a value: review name, unit, confidence, source, methods and whether it needs review.

    `params` are long parameters that carry table_confidence, confidence, method and table_ids of their document.
    """
    return params.select("doc_id", *[c.alias(n) for n, c in _reviewed(F.col("name"), F.col("num"), F.col("unit")).items()])


def listed_parameters(params: DataFrame) -> DataFrame:
    """doc_id and its long parameters as an array of (name, num, unit), by name."""
    return params.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("name", "num", "unit"))).alias("parameters"))


def review_records(documents: DataFrame) -> DataFrame:
    """One review record for each document (those without parameters too); `documents` has doc_id, source_file, table_confidence, confidence, method, table_ids and parameters (an array of name, num, unit). No row leaves its place."""

    def entry(p: Column) -> Column:
        told = _reviewed(p["name"], p["num"], p["unit"])
        return F.struct(told.pop("param").alias("k"), F.struct(*[c.alias(n) for n, c in told.items()]).alias("v"))

    mpn = review_part(F.col("source_file"))
    stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return documents.select("doc_id", mpn.alias("mpn"), maker_of_part(mpn).alias("manufacturer"), "source_file", stamp.alias("extracted_at"), last_wins(F.transform("parameters", entry)).alias("params"))


def parameter_list(rows: Column) -> Column:
    """The parameters of one table as an array of (name, num, unit), by name: what `long_parameters` has in rows, without leaving the row."""
    get = lambda r, k: F.coalesce(F.try_element_at(r, F.lit(k)), F.lit(""))
    base = lambda r: F.replace(F.lower(get(r, "Parameter")), F.lit(" "), F.lit("_"))
    each = lambda r, i: F.array(*[F.struct(base(r).alias("base"), F.lit(k.lower()).alias("kind"), i.alias("i"), parse_float(get(r, k)).alias("num")) for k in KINDS])
    numbers = F.array_sort(F.filter(F.flatten(F.transform(rows, each)), lambda x: x["num"].isNotNull()))
    last = lambda s: F.filter(s, lambda x, i: F.coalesce((F.get(s, i + 1)["base"] != x["base"]) | (F.get(s, i + 1)["kind"] != x["kind"]), F.lit(True)))
    units = F.filter(F.transform(rows, lambda r: F.struct(base(r).alias("base"), get(r, "Unit").alias("unit"))), lambda x: x["unit"] != "")
    named = lambda u: F.transform(bound(numbers, last), lambda x: F.struct(F.concat_ws("_", x["base"], x["kind"]).alias("name"), x["num"].alias("num"), F.element_at(F.filter(F.concat(F.array(F.struct(x["base"].alias("base"), F.lit(None).cast("string").alias("unit"))), u), lambda y: y["base"] == x["base"]), -1)["unit"].alias("unit")))
    return F.array_sort(bound(units, named))


def documents_out(verified: DataFrame, conflicts: bool = True, raw: bool = False) -> DataFrame:
    """The document results: verification block, the table, parameters (null where they can't be named), and if asked for conflicts and the raw extractions. No row leaves its place."""
    shown = F.transform("conflicts", lambda c: F.struct(*[c[n].alias(n) for n in ("field", "vision_value", "rule_value", "severity", "resolution", "resolved_value")]))
    return once(verified, "_rows", F.col("merged_rows")).select(
        "doc_id", F.struct("status", F.bround("confidence", 3).alias("confidence"), "resolution_method", F.size("conflicts").alias("conflict_count")).alias("verification"),
        F.array(F.struct("vision.table_id", "vision.title", "vision.headers", F.col("_rows").alias("rows"))).alias("tables"), F.when(~_broken("_rows"), parameter_list(F.col("_rows"))).alias("parameters"),
        *([F.when(F.size("conflicts") > 0, shown).alias("conflicts")] if conflicts else []), *([F.struct("vision", "rule").alias("raw")] if raw else []),
    )


def best_per_key(df: DataFrame, keys: list[str], by: str, first: str) -> DataFrame:
    """Keeps the row with the greatest `by` for each key, the earliest `first` on ties."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(by), F.asc(first)))).where("_n = 1").drop("_n")
