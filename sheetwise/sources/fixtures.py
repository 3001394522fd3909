"""Small extractions that need no file, and pairs of extractions derived from the star-schema tables."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TABLE = "struct<table_id: string, title: string, headers: array<string>, rows: array<map<string,string>>, confidence: double, extraction_method: string>"
# fixed values: the demo table, and dollars of a mocked call
MOCK_COST = 0.002
HEADERS = ["Parameter", "Test Condition", "Min", "Typ", "Max", "Unit"]
DEMO = [
    ("Input Voltage Range", "", "4.2", "", "36", "V"),
    ("Quiescent Current", "VFB = 1.1V", "", "25", "40", "µA"),
    ("Output Current", "Continuous", "", "", "3", "A"),
    ("Switching Frequency", "", "360", "400", "440", "kHz"),
    ("Efficiency", "VIN=12V, VOUT=5V, IOUT=2A", "", "92", "", "%"),
]


def _demo(name: str, rows: list, confidence: float, table_id: Column) -> Column:
    cells = lambda r: F.create_map(*[F.lit(x) for pair in zip(HEADERS, r, strict=True) for x in pair])
    return F.struct(table_id.alias("table_id"), F.lit("Electrical Characteristics").alias("title"), F.array(*map(F.lit, HEADERS)).alias("headers"), F.array(*map(cells, rows)).alias("rows"), F.lit(confidence).alias("confidence"), F.lit(name).alias("extraction_method"))


def demo_tables(number: Column) -> tuple[Column, Column]:
    """The five-row table as both extractors give it: they differ in a unit's spelling, a number's and the table's name."""
    other = [list(r) for r in DEMO]
    other[1][5], other[2][4] = "uA", "3.0"
    named = lambda x: F.concat(F.lit(f"{x}_table_"), number.cast("string"))
    return _demo("vision", DEMO, 0.95, named("vision")), _demo("rule", other, 0.85, named("rule"))


def demo_pair(spark: SparkSession) -> DataFrame:
    vision, rule = demo_tables(F.lit(1))
    return spark.range(1).select(F.lit("demo").alias("doc_id"), vision.alias("vision"), rule.alias("rule"))


def mock_readings(files: DataFrame) -> DataFrame:
    """The demo table for each file (path) as both extractors give it: the first one's tables are numbered by calls, in the order of the files."""
    calls = files.select(F.col("path").alias("doc_id"), F.row_number().over(Window.orderBy("path")).alias("call"))
    vision, rule = demo_tables(F.col("call"))
    return calls.select("doc_id", vision.alias("vision"), rule.alias("rule"), F.lit(MOCK_COST).alias("cost_usd"))


def prototype_table(spark: SparkSession) -> DataFrame:
    """The prototype's table of two rows."""
    heads = ["Parameter", "Test Conditions", "Min", "Typ", "Max", "Unit"]
    rows = [("VIN_UVLO", "Rising", "3.8", "4.1", "4.4", "V"), ("I_Q", "Non-switching", "-", "25", "40", "uA")]
    return spark.createDataFrame([(5, "Electrical Characteristics", heads, [dict(zip(heads, r, strict=True)) for r in rows], [50.0, 200.0, 550.0, 400.0], 0.95)], "page_num int, title string, headers array<string>, rows array<map<string,string>>, bbox array<double>, confidence double")


def prototype_graph(spark: SparkSession) -> DataFrame:
    """The prototype's edges."""
    return spark.createDataFrame([("VIN", "UVLO_Comparator"), ("UVLO_Comparator", "Enable_Logic"), ("Feedback_Pin", "Error_Amp")], "source string, target string")


# how the pairs are derived: names by part type, units by part, and what the second extraction gets wrong by part
NAMES = {"LARGE": "Switching Frequency", "PROMO": "VIN Range", "ECONOMY": "Quiescent Current", "MEDIUM": "Output Current", "SMALL": "Load Regulation"}
UNITS = ["µA", "V", "mA", "kHz", "%"]
OTHER_UNITS = ["uA", "volt", "milliamp", "khz", "%"]


def _pick(values: list[str], by: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (by % len(values) + 1).cast("int"))


def line_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each line of an order: the cells of both extractions, still without a position."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    parts = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_type", "p_retailprice")
    joined = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    k, doc = F.col("l_partkey") % 8, F.col("l_orderkey")
    name = F.lit("Thermal Resistance")
    for kind, label in NAMES.items():
        name = F.when(F.col("p_type").startswith(kind), label).otherwise(name)
    money = lambda c: F.col(c).cast("decimal(18,2)")
    text = lambda c: money(c).cast("string")
    times = lambda c, f: (money(c) * F.lit(f).cast("decimal(6,3)")).cast("string")
    whole = doc % 50 == 0
    unit = _pick(UNITS, F.col("l_partkey"))
    return joined.select(
        doc.alias("doc_id"), "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", name.alias("parameter"), text("l_quantity").alias("v_min"), text("l_extendedprice").alias("v_typ"), text("p_retailprice").alias("v_max"), unit.alias("v_unit"),
        F.when(whole, times("l_quantity", "1.5")).otherwise(text("l_quantity")).alias("r_min"),
        F.when(whole, times("l_extendedprice", "1.5")).when(k == 2, times("l_extendedprice", "1.005")).when(k == 3, times("l_extendedprice", "1.07")).when(k == 4, times("l_extendedprice", "1.2")).otherwise(text("l_extendedprice")).alias("r_typ"),
        F.when(whole, times("p_retailprice", "1.5")).when(k == 5, "").otherwise(text("p_retailprice")).alias("r_max"),
        F.when(k == 6, "").when(k == 1, _pick(OTHER_UNITS, F.col("l_partkey"))).otherwise(unit).alias("r_unit"),
    )


def extraction_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, vision, rule: every order as a table read twice. One exchange, by order, for the join and the rows."""
    cells = line_cells(spark, sf_dir)
    ordered = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "parameter", "v_min", "v_typ", "v_max", "v_unit", "r_min", "r_typ", "r_max", "r_unit")))
    docs = cells.groupBy("doc_id").agg(ordered.alias("x"))
    doc = F.col("doc_id")
    row = lambda s: lambda r: F.create_map(F.lit("Parameter"), r["parameter"], F.lit("Min"), r[f"{s}_min"], F.lit("Typ"), r[f"{s}_typ"], F.lit("Max"), r[f"{s}_max"], F.lit("Unit"), r[f"{s}_unit"])
    names = ["Parameter", "Min", "Typ", "Max", "Unit"]
    headers = F.array(*map(F.lit, names))
    kept = F.slice("x", F.lit(1), F.when(doc % 7 == 3, F.size("x") - 1).otherwise(F.size("x")))

    def table(name: str, rows: Column, heads: Column, confidence: float) -> Column:
        label = F.when(doc % 2 == 0, "table").otherwise(f"{name}_table")
        return F.struct(F.concat(label, F.lit("_"), doc.cast("string")).alias("table_id"), F.lit("Electrical Characteristics").alias("title"), heads.alias("headers"), rows.alias("rows"), F.lit(confidence).alias("confidence"), F.lit(name).alias("extraction_method"))

    other = F.when(doc % 11 == 0, F.array(*map(F.lit, [*names[:1], "Test_Conditions", *names[1:]]))).otherwise(headers)
    rule = F.when(doc % 31 != 5, table("rule", F.transform(kept, row("r")), other, 0.85))
    return docs.select("doc_id", table("vision", F.transform("x", row("v")), headers, 0.95).alias("vision"), rule.alias("rule"))
