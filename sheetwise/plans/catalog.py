"""The registered queries over the star-schema tables, and the SQL of each.

Orders stand for datasheets: `sources.fixtures` derives two extractions of a table from the lines of
each order, so that every operator has rows at every scale. Results are flat columns.
"""

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import naming, text, units
from ..operators import batch, merges, model, params, rules, verify
from ..sources import fixtures
from . import sql

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(oracle: str):
    """Registers a query of (spark, sf_dir) under its name, with its SQL."""

    def register(f):
        @wraps(f)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet"), spark, sf_dir)

        QUERIES[f.__name__], SQL[f.__name__] = run, oracle
        return run

    return register


def queries() -> dict:
    from . import extraction  # registers its own

    return dict(extraction.QUERIES)


def oracle_sql() -> dict[str, str]:
    from . import extraction

    return dict(extraction.SQL)


def _pairs(spark, sf_dir):
    return fixtures.extraction_pairs(spark, sf_dir)


def _verified(spark, sf_dir):
    return verify.verify_tables(_pairs(spark, sf_dir))


def _conflicts(spark, sf_dir):
    return verify.exploded_conflicts(_verified(spark, sf_dir))


def _params(spark, sf_dir):
    return params.long_parameters(_verified(spark, sf_dir))


def _compared(spark, sf_dir):
    return verify.matched_cells(verify.paired_cells(_pairs(spark, sf_dir)))


# comparators -------------------------------------------------------------------------------------


@query(f"SELECT p_partkey, {sql.number('s')} AS num FROM (SELECT p_partkey, CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) || {sql.pick(['V', ' mA', '', ' e', '-5'], 'p_partkey')} AS s FROM part)")
def num_extract(t, spark, sf_dir):
    cell = F.concat(F.col("p_retailprice").cast("decimal(18,2)").cast("string"), fixtures._pick(["V", " mA", "", " e", "-5"], F.col("p_partkey")))
    return t("part").select("p_partkey", text.number_in(cell).alias("num"))


@query(f"WITH {sql.CELLS} SELECT key, count(*) AS n, count(*) FILTER (coalesce((nv = 0 AND nr = 0) OR {sql.gap('nv', 'nr')} <= 0.01, false)) AS matches FROM cells GROUP BY key")
def num_match(t, spark, sf_dir):
    cells = verify.paired_cells(_pairs(spark, sf_dir))
    return cells.groupBy("key").agg(F.count("*").alias("n"), F.count_if(text.numbers_match(F.col("vision_value"), F.col("rule_value"))).alias("matches"))


_SPELLED = [s for names in units.SPELLINGS.values() for s in names[:2]] + ["??", "furlong"]


@query(f"SELECT p_partkey, s AS spelled, {sql.unit('s')} AS unit FROM (SELECT p_partkey, ' ' || {sql.pick(_SPELLED, 'p_partkey')} || ' ' AS s FROM part)")
def unit_normalize(t, spark, sf_dir):
    spelled = F.concat(F.lit(" "), fixtures._pick(_SPELLED, F.col("p_partkey")), F.lit(" "))
    return t("part").select("p_partkey", spelled.alias("spelled"), units.normal_unit(spelled).alias("unit"))


@query(f"SELECT p_partkey, {sql.text('a')} = {sql.text('b')} AS matched, {sql.text('a')} AS normal FROM (SELECT p_partkey, upper(p_name) || ';  ' || p_brand || '!' AS a, p_name || CASE WHEN p_partkey % 3 = 0 THEN ' x' ELSE ' ' END || p_brand AS b FROM part)")
def text_match(t, spark, sf_dir):
    a = F.concat(F.upper("p_name"), F.lit(";  "), F.col("p_brand"), F.lit("!"))
    b = F.concat(F.col("p_name"), F.when(F.col("p_partkey") % 3 == 0, " x").otherwise(" "), F.col("p_brand"))
    return t("part").select("p_partkey", text.texts_match(a, b).alias("matched"), text.normal_text(a).alias("normal"))


@query(f"WITH {sql.CELLS} SELECT doc_id, count(*) AS cells, count(DISTINCT row_idx) AS n_rows FROM pc GROUP BY doc_id")
def cells_zip_join(t, spark, sf_dir):
    return verify.paired_cells(_pairs(spark, sf_dir)).groupBy("doc_id").agg(F.count("*").alias("cells"), F.countDistinct("row_idx").alias("n_rows"))


@query(f"WITH {sql.CELLS} SELECT doc_id, row_idx, key, matched FROM cmp")
def cell_match(t, spark, sf_dir):
    return _compared(spark, sf_dir).select("doc_id", F.col("row_idx").cast("long").alias("row_idx"), "key", "matched")


# conflicts and verdicts --------------------------------------------------------------------------


# odd documents have table names that differ only in their first word: one low conflict, always last
_WITH_IDS = sql.CONFLICTS.replace("conflicts AS (SELECT", "conflicts AS (SELECT", 1).replace(
    "WHERE doc_id % 11 = 0 AND doc_id % 31 <> 5),",
    "WHERE doc_id % 11 = 0 AND doc_id % 31 <> 5\n  UNION ALL SELECT doc_id, 2000000, 'table_id', 'table_id', 'vision_table_' || doc_id, 'rule_table_' || doc_id, 'low', 'text' FROM docs WHERE doc_id % 2 = 1 AND doc_id % 31 <> 5 AND NOT "
    + f"coalesce({sql.number(chr(39) + 'vision_table_' + chr(39) + ' || doc_id')} = {sql.number(chr(39) + 'rule_table_' + chr(39) + ' || doc_id')}, false)),",
)


@query(f"WITH {_WITH_IDS}, t AS (SELECT doc_id, field, vision_value, rule_value, severity, conflict_type, resolution FROM conflicts) SELECT *, CASE WHEN resolution = 'rule_wins' THEN rule_value ELSE vision_value END AS resolved_value FROM t")
def conflict_list(t, spark, sf_dir):
    return _conflicts(spark, sf_dir).select("doc_id", "field", "vision_value", "rule_value", "severity", "conflict_type", "resolution", "resolved_value")


for _name, _column in (("conflict_type_counts", "conflict_type"), ("severity_counts", "severity"), ("arbiter_winners", "resolution")):

    def _counts(t, spark, sf_dir, column=_column):
        return _conflicts(spark, sf_dir).groupBy(column).agg(F.count("*").alias("n"))

    _counts.__name__ = _name
    query(f"WITH {_WITH_IDS} SELECT {_column}, count(*) AS n FROM conflicts GROUP BY ALL")(_counts)


@query(f"WITH {_WITH_IDS} SELECT doc_id, round(confidence, 3) AS confidence, n_conflicts FROM verdicts")
def confidence(t, spark, sf_dir):
    return _verified(spark, sf_dir).select("doc_id", F.round("confidence", 3).alias("confidence"), F.size("conflicts").cast("long").alias("n_conflicts"))


@query(f"WITH {_WITH_IDS} SELECT doc_id, status, resolution_method, round(confidence, 3) AS confidence FROM verdicts")
def verify_status(t, spark, sf_dir):
    return _verified(spark, sf_dir).select("doc_id", "status", "resolution_method", F.round("confidence", 3).alias("confidence"))


@query(f"WITH {_WITH_IDS} SELECT count(*) AS total_verifications, count(*) FILTER (status = 'verified') AS verified, count(*) FILTER (status = 'conflict') AS conflict, count(*) FILTER (status = 'needs_review') AS needs_review, CAST(sum(n_conflicts) AS BIGINT) AS total_conflicts_found, CAST(sum(n_conflicts) AS BIGINT) AS conflicts_resolved FROM verdicts")
def status_summary(t, spark, sf_dir):
    return verify.verifier_stats(_verified(spark, sf_dir))


@query(f"WITH {_WITH_IDS} SELECT doc_id, n_conflicts FROM verdicts WHERE status = 'needs_review'")
def review_queue(t, spark, sf_dir):
    return verify.review_queue(_verified(spark, sf_dir)).select("doc_id", F.size("conflicts").cast("long").alias("n_conflicts"))


@query(f"WITH {sql.CONFLICTS} SELECT doc_id, vision_value, rule_value FROM conflicts WHERE field = 'headers'")
def header_conflicts(t, spark, sf_dir):
    return _conflicts(spark, sf_dir).where("field = 'headers'").select("doc_id", "vision_value", "rule_value")


@query(f"WITH {sql.CONFLICTS} SELECT doc_id, confidence FROM verdicts WHERE resolution_method = 'vision_only'")
def vision_only(t, spark, sf_dir):
    return _verified(spark, sf_dir).where("resolution_method = 'vision_only'").select("doc_id", "confidence")


@query(f"WITH {sql.PARAMS} SELECT doc_id, row_idx, v_min AS min, v_typ AS typ, v_max AS max, m_unit AS unit FROM mu")
def merged_units(t, spark, sf_dir):
    rows = _verified(spark, sf_dir).select("doc_id", F.posexplode("merged_rows").alias("row_idx", "r"))
    return rows.select("doc_id", F.col("row_idx").cast("long").alias("row_idx"), *[F.try_element_at("r", F.lit(k)).alias(k.lower()) for k in ("Min", "Typ", "Max", "Unit")])


@query(f"WITH {sql.CELLS}, r AS (SELECT doc_id, row_idx, count(*) FILTER (matched) AS hit, count(*) AS n FROM cmp GROUP BY ALL), d AS (SELECT doc_id, sum(hit) AS hit, sum(n) AS n, count(*) FILTER (hit = n) AS row_hit, count(*) AS rows FROM r GROUP BY doc_id) SELECT round(sum(hit) / sum(n), 6) AS cell_accuracy, round(sum(row_hit) / sum(rows), 6) AS row_accuracy, round(avg(CASE WHEN hit = n THEN 1.0 ELSE 0.0 END), 6) AS table_accuracy FROM d")
def accuracy_cells(t, spark, sf_dir):
    out = batch.accuracy(_compared(spark, sf_dir))
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


# parameters and exports --------------------------------------------------------------------------


@query(f"WITH {sql.PARAMS} SELECT doc_id, name, num, unit FROM params")
def params_long(t, spark, sf_dir):
    return _params(spark, sf_dir).select("doc_id", "name", "num", "unit")


@query(f"WITH {sql.PARAMS}, c AS (SELECT doc_id, base, kind, count(*) AS rows FROM nums GROUP BY ALL) SELECT doc_id, name, num, rows FROM params JOIN c USING (doc_id, base, kind) WHERE rows > 1")
def params_last_wins(t, spark, sf_dir):
    verified = _verified(spark, sf_dir)
    counted = verified.withColumn("sizes", F.transform("merged_rows", lambda r: F.replace(F.lower(F.coalesce(F.try_element_at(r, F.lit("Parameter")), F.lit(""))), F.lit(" "), F.lit("_"))))
    found = params.long_parameters(counted, carry=["sizes"])
    rows = F.size(F.filter("sizes", lambda b: b == F.col("base"))).cast("long")
    return found.withColumn("rows", rows).where("rows > 1").select("doc_id", "name", "num", "rows")


_NAMES = sorted(f"{b.lower().replace(' ', '_')}_{k}" for b in [*fixtures.NAMES.values(), "Thermal Resistance"] for k in ("min", "typ", "max"))


@query(f"WITH {sql.PARAMS} SELECT doc_id, {', '.join(f'max(num) FILTER (name = {sql.quoted(n)}) AS {n}' for n in _NAMES)} FROM params GROUP BY doc_id")
def params_wide(t, spark, sf_dir):
    return params.wide_parameters(_params(spark, sf_dir), _NAMES)


_CATEGORY = "CASE WHEN bool_or(name = 'switching_frequency_typ') THEN 'Buck Converter' WHEN bool_or(name = 'efficiency_typ') THEN 'DC-DC Converter' WHEN max(num) FILTER (name = 'quiescent_current_typ') < 2000 THEN 'LDO' ELSE 'Unknown' END"


@query(f"WITH {sql.PARAMS} SELECT doc_id, {_CATEGORY.replace('< 2000', '< 100')} AS category FROM params GROUP BY doc_id")
def category(t, spark, sf_dir):
    return params.parameter_maps(_params(spark, sf_dir)).select("doc_id", naming.category(F.col("params")).alias("category"))


TEXTS = ["MPN", "Manufacturer", "Category", "Description", "Package", "Status", "Datasheet_URL", "Notes"]
_PARAMS_AND_IDS = f"{_WITH_IDS}, {sql.PARAMS.split(',' + chr(10) + 'mu AS', 1)[1].join(['mu AS', ''])}"
_IMPORTED = f"""WITH {_PARAMS_AND_IDS},
w AS (SELECT doc_id, {_CATEGORY.replace("< 2000", "< 100")} AS category, max(num) FILTER (name = 'input_voltage_range_min') AS vin_min, max(num) FILTER (name = 'input_voltage_range_max') AS vin_max,
  max(num) FILTER (name = 'output_voltage_min') AS vout_min, max(num) FILTER (name = 'output_voltage_max') AS vout_max, max(num) FILTER (name = 'output_current_max') AS iout_max, max(num) FILTER (name = 'quiescent_current_typ') AS iq_typ,
  max(num) FILTER (name = 'efficiency_typ') AS efficiency_typ, max(num) FILTER (name = 'switching_frequency_typ') AS frequency_typ FROM params GROUP BY doc_id),
imported AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'LMR' || doc_id ELSE 'TPS' || doc_id END AS mpn, CASE WHEN doc_id % 2 = 0 THEN 'onsemi' ELSE '' END AS manufacturer, w.*,
  'Extracted by sheetwise (confidence: ' || printf('%d', CAST(round_even(round(confidence, 3) * 100, 0) AS INT)) || '%)' AS notes FROM w JOIN verdicts USING (doc_id))"""
_NUMBERS = {"Vin_min": "vin_min", "Vin_max": "vin_max", "Vout_min": "vout_min", "Vout_max": "vout_max", "Iout_max": "iout_max", "Iq_typ": "iq_typ", "Efficiency_typ": "efficiency_typ", "Frequency_typ": "frequency_typ"}


def _imported(spark, sf_dir):
    verified = _verified(spark, sf_dir).withColumn("confidence", F.round("confidence", 3))
    docs = params.parameter_maps(params.long_parameters(verified, carry=["confidence"]), ["confidence"])
    source = F.concat(F.lit("/in/tps"), F.col("doc_id").cast("string"), F.lit("_datasheet_v04.pdf"))
    mpn = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("LMR"), F.col("doc_id").cast("string")))
    maker = F.when(F.col("doc_id") % 2 == 0, F.lit("onsemi"))
    return params.importer_rows(docs.withColumns({"source_file": source, "mpn": mpn, "manufacturer": maker}))


@query(f"{_IMPORTED} SELECT mpn AS MPN, manufacturer AS Manufacturer, category AS Category, '' AS Description, {', '.join(f'round({c}, 6) AS {n}' for n, c in _NUMBERS.items())}, '' AS Package, 'Active' AS Status, '' AS Datasheet_URL, notes AS Notes FROM imported")
def importer_rows(t, spark, sf_dir):
    out = _imported(spark, sf_dir)
    return out.select(*[F.col(c) if c in TEXTS else F.expr(f"round(try_cast({c} AS DOUBLE), 6)").alias(c) for c in out.columns])


_FILES = ["_v04.pdf", "_extracted.pdf", "_datasheet.v2.pdf", ".pdf", ""]


@query(f"SELECT p_partkey, upper(replace(replace(replace(regexp_replace(f, '\\.[^.]*$', ''), '_v04', ''), '_extracted', ''), '_datasheet', '')) AS mpn, upper(regexp_replace(f, '\\.[^.]*$', '')) AS review_mpn FROM (SELECT p_partkey, 'lmr' || p_partkey || {sql.pick(_FILES, 'p_partkey')} AS f FROM part)")
def mpn_from_name(t, spark, sf_dir):
    source = F.concat(F.lit("/data/lmr"), F.col("p_partkey").cast("string"), fixtures._pick(_FILES, F.col("p_partkey")))
    return t("part").select("p_partkey", naming.part_of_file(F.lit(None).cast("string"), source).alias("mpn"), naming.review_part(source).alias("review_mpn"))


_METHODS = ["double_verified_vision", "rule_based", "Vision_only", "verified by rule", ""]
_SHOWN = ["vision,pdfplumber", "rule_based", "vision", "pdfplumber,rule_based", "unknown"]
_RENAMED = " ".join(f"WHEN {sql.quoted(k)} THEN {sql.quoted(v)}" for k, v in naming.REVIEW_NAMES.items())


@query(f"""WITH {_PARAMS_AND_IDS}, told AS (SELECT *, coalesce(CASE WHEN doc_id % 4 = 1 THEN 0.97 WHEN doc_id % 4 <> 0 THEN 0.95 END, CASE WHEN doc_id % 12 <> 0 THEN round(confidence, 3) END, 0.9)::DOUBLE AS conf FROM params JOIN verdicts USING (doc_id))
SELECT doc_id, CASE name {_RENAMED} ELSE name END AS param, num AS value, coalesce(unit, '') AS unit, conf AS confidence, {sql.pick(_SHOWN, "doc_id")} AS verified_by, conf < 0.95::DOUBLE AS needs_review,
  CASE doc_id % 5 WHEN 4 THEN 'unknown' WHEN 3 THEN 'page_1_table_1' ELSE 'page_1_' || CASE WHEN doc_id % 2 = 0 THEN 'table_' ELSE 'vision_table_' END || doc_id END AS source FROM told""")
def review_params(t, spark, sf_dir):
    doc = F.col("doc_id")
    method = F.element_at(F.array(*map(F.lit, _METHODS)), (doc % len(_METHODS) + 1).cast("int"))
    ids = F.when(doc % 5 == 4, F.array().cast("array<string>")).when(doc % 5 == 3, F.array(F.lit(None).cast("string"))).otherwise(F.array("vision.table_id"))
    own = F.when(doc % 4 == 0, F.lit(None).cast("double")).when(doc % 4 == 1, F.lit(0.97)).otherwise(F.col("vision.confidence"))
    told = {"table_confidence": own, "confidence": F.when(doc % 12 != 0, F.round("confidence", 3)), "method": method, "table_ids": ids}
    found = params.long_parameters(_verified(spark, sf_dir).withColumns(told), carry=list(told))
    return params.review_parameters(found).withColumn("verified_by", F.array_join("verified_by", ","))


_PARTS = ["LMR", "TPS", "MAX", "MCP", "MC", "xtc", "ina", "STM", "LTC", "PIC"]


@query(f"SELECT p_partkey, {sql.maker('m')} AS manufacturer FROM (SELECT p_partkey, {sql.pick(_PARTS, 'p_partkey')} || p_partkey AS m FROM part)")
def manufacturer_prefix(t, spark, sf_dir):
    return t("part").select("p_partkey", naming.maker_of_part(F.concat(fixtures._pick(_PARTS, F.col("p_partkey")), F.col("p_partkey").cast("string"))).alias("manufacturer"))


# rule extraction ---------------------------------------------------------------------------------

_HEADS = ["Parameter", "PARAM name", "Symbol", "Test Conditions", "Conditions", "Min.", "Typical", "MAX value", "Units", "Description", "", "Note"]
_HEADER_SQL = "CASE " + " ".join(f"WHEN regexp_matches(lower(trim({{0}})), {sql.quoted(p)}) THEN {sql.quoted(n)}" for p, n in rules.HEADERS) + " WHEN {0} = '' THEN 'Unknown' ELSE {0} END"


@query(f"SELECT p_partkey, {_HEADER_SQL.format('h')} AS header FROM (SELECT p_partkey, {sql.pick(_HEADS, 'p_partkey')} AS h FROM part)")
def header_normalize(t, spark, sf_dir):
    return t("part").select("p_partkey", rules.normal_header(fixtures._pick(_HEADS, F.col("p_partkey"))).alias("header"))


@query("SELECT p_partkey, trim(regexp_replace('  ' || replace(p_name, ' ', chr(10) || '  ') || chr(9), '\\s+', ' ', 'g')) AS cell FROM part")
def clean_cell(t, spark, sf_dir):
    return t("part").select("p_partkey", text.clean_cell(F.concat(F.lit("  "), F.replace("p_name", F.lit(" "), F.lit("\n  ")), F.lit("\t"))).alias("cell"))


@query(f"SELECT o_orderkey, len(list_distinct(list_filter([{_HEADER_SQL.format('a')}, {_HEADER_SQL.format('b')}, {_HEADER_SQL.format('c')}, {_HEADER_SQL.format('d')}], lambda x: x IN ('Parameter', 'Min', 'Typ', 'Max', 'Unit')))) >= 3 AS standard FROM (SELECT o_orderkey, {sql.pick(_HEADS, 'o_orderkey')} AS a, {sql.pick(_HEADS, '(o_orderkey + 5)')} AS b, {sql.pick(_HEADS, '(o_orderkey * 7)')} AS c, {sql.pick(_HEADS, '(o_orderkey + 8)')} AS d FROM orders)")
def standard_headers(t, spark, sf_dir):
    k = F.col("o_orderkey")
    heads = F.array(*[rules.normal_header(fixtures._pick(_HEADS, by)) for by in (k, k + 5, k * 7, k + 8)])
    return t("orders").select("o_orderkey", rules.has_standard_headers(heads).alias("standard"))


_PHRASES = ["see ELECTRICAL characteristics", "Pin functions and thermal information", "absolute  maximum", "Device Comparison table", "functional diagram", "typical application; package", "nothing", "PACKAGE pin configuration"]


def _page(by):
    return F.concat_ws(" ", F.col("p_name"), fixtures._pick(_PHRASES, by), F.col("p_brand"))


_PAGE_SQL = f"(SELECT p_partkey, p_name || ' ' || {sql.pick(_PHRASES, 'p_partkey')} || ' ' || p_brand AS s FROM part)"


@query("SELECT p_partkey, CASE " + " ".join(f"WHEN regexp_matches(lower(s), {sql.quoted(x.lower().replace(' ', chr(92) + 's*'))}) THEN {sql.quoted(x)}" for x in naming.TITLES) + f" ELSE 'Table ' || (p_partkey % 4 + 1) END AS title FROM {_PAGE_SQL}")
def title_detect(t, spark, sf_dir):
    return t("part").select("p_partkey", naming.table_title(_page(F.col("p_partkey")), F.col("p_partkey") % 4).alias("title"))


@query("SELECT p_partkey, CASE " + " ".join(f"WHEN regexp_matches(lower(s), {sql.quoted(k.replace(' ', chr(92) + 's*'))}) THEN {sql.quoted(v)}" for k, v in naming.DIAGRAMS.items()) + f" END AS diagram FROM {_PAGE_SQL}")
def diagram_type(t, spark, sf_dir):
    return t("part").select("p_partkey", naming.diagram_type(_page(F.col("p_partkey"))).alias("diagram"))


_MPNS = ["the LM317 and LMR", "TPS54A of 2020, LM5", "LMR51430XDDC TPS1", "lm317", "none", "LM74HC"]


@query(f"SELECT p_partkey, coalesce({', '.join(f'nullif(regexp_extract(s, {sql.quoted(p)}), {sql.quoted(str())})' for p in naming.PART_PATTERNS)}, 'Unknown') AS mpn FROM (SELECT p_partkey, p_name || ' ' || {sql.pick(_MPNS, 'p_partkey')} AS s FROM part)")
def mpn_from_text(t, spark, sf_dir):
    return t("part").select("p_partkey", naming.part_in_text(F.concat_ws(" ", F.col("p_name"), fixtures._pick(_MPNS, F.col("p_partkey")))).alias("mpn"))


_MAKERS = ["by ONSEMI", "Texas Instruments Inc", "analog devices, onsemi", "unknown"]


@query("SELECT n_nationkey, CASE " + " ".join(f"WHEN contains(lower(s), {sql.quoted(k)}) THEN {sql.quoted(v)}" for k, v in naming.MAKERS_IN_TEXT.items()) + f" ELSE 'Unknown' END AS manufacturer FROM (SELECT n_nationkey, n_name || ' ' || {sql.pick(_MAKERS, 'n_nationkey')} AS s FROM nation)")
def manufacturer_text(t, spark, sf_dir):
    return t("nation").select("n_nationkey", naming.maker_in_text(F.concat_ws(" ", F.col("n_name"), fixtures._pick(_MAKERS, F.col("n_nationkey")))).alias("manufacturer"))


# merged cells ------------------------------------------------------------------------------------

_GRID_CELLS = ["Output Voltage", "", "", "DC gain", "3.3", " ", "Rth (max)", "12 V"]


def _grids(t):
    k = F.col("p_partkey")
    row = lambda a: F.array(*[fixtures._pick(_GRID_CELLS, F.floor(k / (i + a)) + k * i) for i in range(1, 6)])
    return t("part").select(k.alias("doc_id"), F.array(row(1), row(2), row(3)).alias("grid"))


_GRID_SQL = f"""g AS (SELECT p_partkey AS doc_id, a - 1 AS row, i - 1 AS col, {sql.pick(_GRID_CELLS, "(p_partkey // (i + a) + p_partkey * i)")} AS cell FROM part, range(1, 4) r(a), range(1, 6) c(i)),
f AS (SELECT *, coalesce(lead(col) OVER (PARTITION BY doc_id, row ORDER BY col), 5) - col AS span FROM g WHERE trim(cell) <> ''),
cat AS (SELECT *, regexp_matches(lower(trim(cell)), {sql.quoted(merges.CATEGORY)}) OR len(regexp_extract_all(trim(cell), '[A-Za-z]')) / len(trim(cell)) > 0.8 AS category FROM f),
cnt AS (SELECT doc_id, count(*) FILTER (row = 0) AS h, count(*) FILTER (row = 1) AS d FROM f GROUP BY doc_id),
found AS (SELECT doc_id, row, col, span, trim(cell) AS content, 0.85 AS confidence, 0 AS ord FROM cat JOIN cnt USING (doc_id) WHERE row = 0 AND h < d AND span > 1
  UNION ALL SELECT doc_id, row, col, span, trim(cell), 0.70, 1 FROM cat WHERE span > 1 AND span <= 4 AND category)"""


@query(f"WITH {_GRID_SQL} SELECT DISTINCT ON (doc_id, row, col) doc_id, row, col AS col_start, col + span - 1 AS col_end, content, confidence FROM found ORDER BY doc_id, row, col, confidence DESC, ord")
def merge_dedup(t, spark, sf_dir):
    found = merges.detect_merges(_grids(t)).select("doc_id", F.explode("merges").alias("m"))
    return found.select("doc_id", *[F.col(f"m.{c}").cast("long").alias(c) for c in ("row", "col_start", "col_end")], "m.content", "m.confidence")


@query(f"WITH {_GRID_SQL} SELECT doc_id, row, col, span FROM f WHERE span > 1")
def span_detect(t, spark, sf_dir):
    rows = _grids(t).select("doc_id", F.posexplode("grid").alias("row", "r")).select("doc_id", F.col("row").cast("long").alias("row"), F.explode(merges.spans(F.col("r"))).alias("s"))
    return rows.where("s.span > 1").select("doc_id", "row", F.col("s.col").cast("long").alias("col"), F.col("s.span").cast("long").alias("span"))


@query(f"WITH {_GRID_SQL} SELECT cell, any_value(category) AS category, count(*) AS n FROM cat GROUP BY cell")
def category_header(t, spark, sf_dir):
    cells = _grids(t).select(F.explode(F.flatten("grid")).alias("cell")).where("trim(cell) <> ''")
    return cells.groupBy("cell").agg(F.first(merges.is_category(F.col("cell"))).alias("category"), F.count("*").alias("n"))


@query("SELECT doc_id, width, round(confidence, 6) AS confidence FROM (SELECT l_suppkey AS doc_id, list_sort(list(CAST(l_quantity AS DOUBLE)))[count(*) // 2 + 1] AS width, 1.0 AS confidence FROM lineitem GROUP BY l_suppkey)")
def col_upper_median(t, spark, sf_dir):
    one = F.struct(F.lit(0.0).alias("x0"), F.col("l_quantity").cast("double").alias("x1"))
    rows = t("lineitem").groupBy(F.col("l_suppkey").alias("doc_id")).agg(F.collect_list(F.array(one)).alias("positions"))
    return rows.select("doc_id", merges.column_widths(F.col("positions"))[0].alias("width"), F.lit(1.0).alias("confidence"))


# batches and models ------------------------------------------------------------------------------


@query("SELECT p_partkey FROM part WHERE p_partkey % 3 <> 0")
def batch_anti_join(t, spark, sf_dir):
    path = lambda ending: F.concat(F.lit("/x/part-"), F.col("p_partkey").cast("string"), F.lit(ending)).alias("path")
    done = t("part").where("p_partkey % 3 = 0").select(path("_v04.json"))
    return batch.pending_files(t("part").select("p_partkey", path(".pdf")), done).select("p_partkey")


@query("SELECT count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS success, count(*) FILTER (o_orderstatus = 'O') AS failed, count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) AS skipped, round(count(*) FILTER (o_orderstatus = 'F') / greatest(count(*) - count(*) FILTER (o_orderstatus NOT IN ('F', 'O')), 1), 6) AS success_rate FROM orders")
def batch_summary(t, spark, sf_dir):
    status = F.when(F.col("o_orderstatus") == "F", "success").when(F.col("o_orderstatus") == "O", "failed").otherwise("skipped")
    return batch.batch_summary(t("orders").select(status.alias("status"))).withColumn("success_rate", F.round("success_rate", 6))


@query("SELECT event_id, round(user_id / 1000 * CASE WHEN event_id % 3 = 0 THEN 0.005::DOUBLE ELSE 0.00015::DOUBLE END + event_id / 1000 * CASE WHEN event_id % 3 = 0 THEN 0.015::DOUBLE ELSE 0.0006::DOUBLE END, 9) AS cost FROM events")
def token_cost(t, spark, sf_dir):
    name = F.when(F.col("event_id") % 3 == 0, "gpt-4o").when(F.col("event_id") % 3 == 1, "gpt-4o-mini").otherwise("unheard of")
    return t("events").select("event_id", F.round(model.token_cost(name, F.col("user_id"), F.col("event_id")), 9).alias("cost"))


@query("SELECT event_id, user_id, before < 2000 AS sent, CASE WHEN before >= 2000 THEN 'Budget exceeded: $' || printf('%.2f', before::DOUBLE) || ' >= $2000.00' END AS error FROM (SELECT event_id, user_id, coalesce(sum(event_id % 7) OVER (ORDER BY user_id, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM events)")
def budget_waves(t, spark, sf_dir):
    requests = t("events").select("event_id", "user_id", (F.col("event_id") % 7).alias("estimated_cost"))
    return model.within_budget(requests, 2000.0, order="event_id", waves="user_id").select("event_id", "user_id", "sent", "error")


@query("SELECT event_id, CASE WHEN event_id % 3 = 2 THEN NULL ELSE CAST(event_id AS VARCHAR) END AS answer FROM events")
def json_answers(t, spark, sf_dir):
    body = F.concat(F.lit('{"a": "'), F.col("event_id").cast("string"), F.lit('"}'))
    content = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("Here:\n```json\n"), body, F.lit("\n``` done"))).when(F.col("event_id") % 3 == 1, body).otherwise(F.lit("sorry, {no"))
    return t("events").select("event_id", F.try_element_at(model.json_answer(content, "map<string,string>"), F.lit("a")).alias("answer"))
