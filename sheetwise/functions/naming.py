"""Names found in page text, file names and parameter keys: first pattern of a list that is met."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import file_stem

# fixed values: patterns and prefixes, tried in this order
PART_PATTERNS = [r"LMR\d+[A-Z]*", r"TPS\d+[A-Z]*", r"LM\d+[A-Z]*"]
MAKERS_IN_TEXT = {"texas instruments": "Texas Instruments", "analog devices": "Analog Devices", "onsemi": "onsemi"}
MAKER_PREFIXES = {
    "LM": "Texas Instruments", "TPS": "Texas Instruments", "LMR": "Texas Instruments", "MAX": "Analog Devices", "AD": "Analog Devices", "LT": "Analog Devices",
    "LTC": "Analog Devices", "MCP": "Microchip", "PIC": "Microchip", "STM": "STMicroelectronics", "NCP": "onsemi", "MC": "onsemi", "ISL": "Renesas", "IR": "Infineon",
    "INA": "Texas Instruments", "OPA": "Texas Instruments",
}
TITLES = ["Electrical Characteristics", "Absolute Maximum Ratings", "Recommended Operating Conditions", "Thermal Information", "Pin Functions", "Device Comparison"]
DIAGRAMS = {"block diagram": "block_diagram", "functional diagram": "block_diagram", "typical application": "typical_app", "application circuit": "typical_app", "pin configuration": "pinout", "package": "pinout"}
REVIEW_NAMES = {
    "input_voltage_range_min": "v_in_min", "input_voltage_range_max": "v_in_max", "output_voltage_min": "v_out_min", "output_voltage_max": "v_out_max", "output_current_max": "i_out_max", "quiescent_current_typ": "i_q",
    "quiescent_current_max": "i_q_max", "switching_frequency_typ": "fsw", "switching_frequency_min": "fsw_min", "switching_frequency_max": "fsw_max", "efficiency_typ": "efficiency",
}


def first_case(pairs: list[tuple[Column, Column]], otherwise: Column) -> Column:
    return reduce(lambda rest, pair: F.when(pair[0], pair[1]).otherwise(rest), reversed(pairs), otherwise)


def part_in_text(text: Column) -> Column:
    found = [F.nullif(F.regexp_extract(text, p, 0), F.lit("")) for p in PART_PATTERNS]
    return F.coalesce(*found, F.lit("Unknown"))


def maker_in_text(text: Column) -> Column:
    return first_case([(F.lower(text).contains(k), F.lit(v)) for k, v in MAKERS_IN_TEXT.items()], F.lit("Unknown"))


def maker_of_part(part: Column) -> Column:
    """First prefix that fits, in the order of the list."""
    return first_case([(F.upper(part).startswith(k), F.lit(v)) for k, v in MAKER_PREFIXES.items()], F.lit(""))


def table_title(text: Column, index: Column) -> Column:
    """Title-cased first heading of the list that the page has; else a number."""
    found = [F.nullif(F.regexp_extract(text, "(?iU)" + t.replace(" ", r"\s*"), 0), F.lit("")) for t in TITLES]
    return F.coalesce(F.initcap(F.coalesce(*found)), F.concat(F.lit("Table "), (index + 1).cast("string")))


def diagram_type(text: Column) -> Column:
    return first_case([(F.lower(text).rlike(k.replace(" ", r"\s*")), F.lit(v)) for k, v in DIAGRAMS.items()], F.lit(None).cast("string"))


def part_of_file(mpn: Column, source: Column) -> Column:
    """Export name: the part number of the metadata, else the file stem without the known endings, in upper case."""
    stem = file_stem(source)
    for ending in ("_v04", "_extracted", "_datasheet"):
        stem = F.replace(stem, F.lit(ending), F.lit(""))
    return F.coalesce(mpn, F.upper(stem), F.lit(""))


def review_part(source: Column) -> Column:
    stem = F.upper(file_stem(source))
    return F.when(F.coalesce(source, F.lit("")) == "", "UNKNOWN").otherwise(stem)


def review_name(name: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in REVIEW_NAMES.items() for x in pair])
    return F.coalesce(F.try_element_at(known, name), name)


def verification_methods(method: Column) -> Column:
    low = F.lower(F.coalesce(method, F.lit("")))
    hits = F.array(F.when(low.contains("vision"), F.lit("vision")), F.when(low.contains("double") | low.contains("verified"), F.lit("pdfplumber")), F.when(low.contains("rule"), F.lit("rule_based")))
    kept = F.filter(hits, lambda x: x.isNotNull())
    return F.when(F.size(kept) > 0, kept).otherwise(F.array(F.lit("unknown")))


def source_reference(table_ids: Column) -> Column:
    """Where a parameter comes from: the first table of page 1."""
    return F.when(F.size(table_ids) > 0, F.concat(F.lit("page_1_"), F.coalesce(F.get(table_ids, F.lit(0)), F.lit("table_1")))).otherwise("unknown")


def category(params: Column) -> Column:
    """Kind of part from a map of numeric parameters."""
    has = lambda k: F.map_contains_key(params, F.lit(k))
    return F.when(has("switching_frequency_typ"), "Buck Converter").when(has("efficiency_typ"), "DC-DC Converter").when(F.try_element_at(params, F.lit("quiescent_current_typ")) < 100, "LDO").otherwise("Unknown")
