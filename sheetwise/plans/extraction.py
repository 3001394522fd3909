"""Registered queries over page scans, rule tables, merged cells, exports and the model boundary, and the SQL of each.

Parts stand for pages: four of them make a document, and what is on a page follows from the part's key.
"""

from pyspark.sql import functions as F

from ..functions import text
from ..operators import batch, merges, model, params, rules, verify
from ..sources import files, fixtures
from . import catalog, sql
from .catalog import QUERIES, SQL, _pairs, _verified, query

__all__ = ["QUERIES", "SQL"]

_pick = fixtures._pick


def _key():
    return F.col("p_partkey")


def _joined(cells):
    """A map as text: key=value, sorted by key."""
    return F.array_join(F.sort_array(F.transform(F.map_entries(cells), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), "|")


# page scans --------------------------------------------------------------------------------------


def _dealt(table):
    """A table dealt to all cores if it has a MB or more: a scan makes a part or two of some MB, however many rows they hold and however much each of them takes."""
    size = int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return table if size < 1 << 20 else table.repartition(table.sparkSession.sparkContext.defaultParallelism)


def _files(t):
    """Three pages in a file, the texts between form feeds."""
    content = F.concat_ws("\f", "p_name", "p_type", "p_brand").cast("binary")
    return _dealt(t("part")).select(F.concat(F.lit("/in/"), _key().cast("string"), F.lit(".pdf")).alias("path"), content.alias("content"))


def _parse(content: bytes):
    for n, page in enumerate(content.decode().split("\f")):
        if n == 2 and page.endswith("1"):
            raise ValueError("unreadable page")
        yield {"text": page, "tables": [[[page]]], "width": 612.0, "height": 792.0}


@query("""SELECT '/in/' || p_partkey || '.pdf' AS doc_id, page_num, CASE WHEN page_num = 1 THEN p_name WHEN page_num = 2 THEN p_type WHEN p_brand LIKE '%1' THEN '' ELSE p_brand END AS text,
  CASE WHEN page_num = 3 AND p_brand LIKE '%1' THEN 'ValueError: unreadable page' END AS error FROM part, range(1, 4) r(page_num)""")
def page_scan(t, spark, sf_dir):
    return files.read_pages(_files(t), _parse).select("doc_id", F.col("page_num").cast("long").alias("page_num"), "text", "error")


@query("SELECT '/in/' || p_partkey || '.pdf' AS doc_id, n AS page_num, printf('page_%03d.png', n) AS name, strlen(CASE n WHEN 1 THEN p_name ELSE p_brand END) AS bytes, least(strlen(CASE n WHEN 1 THEN p_name ELSE p_brand END) - 2, 4) AS cropped FROM part, (VALUES (1), (3)) r(n)")
def page_images(t, spark, sf_dir):
    def render(content: bytes, page: int, dpi: int):
        return None if page == 2 else (content.split(b"\f")[page - 1], dpi, dpi)

    images = files.render_pages(_files(t), render, count=lambda content: content.count(b"\f") + 1)
    boxed = images.withColumn("bbox", F.struct(F.lit(2).alias("x0"), F.lit(0).alias("y0"), F.lit(6).alias("x1"), F.lit(1).alias("y1")))
    cut = files.crop_images(boxed, lambda image, box: image[int(box[0]) : int(box[2])])
    return cut.select("doc_id", F.col("page_num").cast("long").alias("page_num"), text.page_file(F.col("page_num")).alias("name"), F.octet_length("image").cast("long").alias("bytes"), F.octet_length("cropped").cast("long").alias("cropped"))


_STANDARD = [["Parameter", "Min", "Max"], ["VIN", "1", "2"]]
_ODD = [["Name", "Value"], ["a", "b"]]
_TABLES = [[], [_STANDARD], [_ODD], [_ODD, _STANDARD], [[["x"]]]]


def _pages(t):
    grid = lambda g: F.array(*[F.array(*map(F.lit, r)) for r in g])
    none = F.array().cast("array<array<array<string>>>")
    kinds = [F.array(*map(grid, tables)) if tables else none for tables in _TABLES]
    tables = F.element_at(F.array(*kinds), (_key() % 5 + 1).cast("int"))
    words = F.concat_ws(" ", "p_name", _pick(catalog._MPNS, _key()), _pick(catalog._MAKERS, _key()), _pick(catalog._PHRASES, _key()))
    doc = F.concat(F.lit("d"), F.floor(_key() / 4).cast("string"))
    return t("part").select(doc.alias("doc_id"), (_key() % 4 + 1).cast("int").alias("page_num"), words.alias("text"), tables.alias("tables"), F.lit(None).cast("string").alias("error"))


_PAGES = f"pages_ AS (SELECT 'd' || (p_partkey // 4) AS doc_id, p_partkey % 4 + 1 AS page_num, p_partkey % 5 AS kind, p_name || ' ' || {sql.pick(catalog._MPNS, 'p_partkey')} || ' ' || {sql.pick(catalog._MAKERS, 'p_partkey')} || ' ' || {sql.pick(catalog._PHRASES, 'p_partkey')} AS s FROM part)"
_TABLES_SQL = f"""{_PAGES}, tables_ AS (SELECT doc_id, page_num, s, unnest(CASE kind WHEN 1 THEN [{{'i': 0, 'c': 0.9}}] WHEN 2 THEN [{{'i': 0, 'c': 0.6}}] WHEN 3 THEN [{{'i': 0, 'c': 0.6}}, {{'i': 1, 'c': 0.9}}] ELSE [] END, recursive := true) FROM pages_)"""


@query(f"WITH {_TABLES_SQL} SELECT doc_id, page_num, 'table_p' || page_num || '_' || i AS table_id, c::DOUBLE AS confidence, 'rule_based' AS method FROM tables_ UNION ALL SELECT doc_id, page_num, 'asked_' || page_num, 0.95, 'vision' FROM pages_ WHERE kind IN (0, 2, 4)")
def page_tables(t, spark, sf_dir):
    def ask(pages):
        return pages.select("doc_id", F.concat(F.lit("asked_"), "page_num").alias("table_id"), "page_num", F.lit(0.95).alias("confidence"), F.lit("vision").alias("extraction_method"))

    found = rules.extract_page_tables(_pages(t), ask)
    return found.select("doc_id", F.col("page_num").cast("long").alias("page_num"), "table_id", "confidence", F.col("extraction_method").alias("method"))


@query(f"WITH {_PAGES} SELECT doc_id, page_num FROM pages_ WHERE kind IN (0, 2, 4)")
def fallback_pages(t, spark, sf_dir):
    pages = _pages(t)
    return rules.pages_for_fallback(pages, rules.extract_page_tables(pages)).select("doc_id", F.col("page_num").cast("long").alias("page_num"))


@query(f"WITH {_TABLES_SQL} SELECT doc_id, page_num, 'table_' || page_num || '_' || i AS region_id, 50.0::DOUBLE AS x0, 100.0::DOUBLE + 200 * i AS y0, 550.0::DOUBLE AS x1, 300.0::DOUBLE + 200 * i AS y1 FROM tables_")
def table_regions(t, spark, sf_dir):
    return files.table_regions(_pages(t)).select("doc_id", F.col("page_num").cast("long").alias("page_num"), "region_id", "bbox.*")


@query(f"""WITH {_PAGES}, d AS (SELECT doc_id, page_num, CASE WHEN contains(lower(s), 'functional diagram') THEN 'block_diagram' WHEN contains(lower(s), 'typical application') THEN 'typical_app' WHEN contains(lower(s), 'package') THEN 'pinout' END AS diagram_type FROM pages_)
SELECT *, false AS extracted FROM d WHERE diagram_type IS NOT NULL""")
def diagram_pages(t, spark, sf_dir):
    pages = _pages(t)
    found = files.extract_diagrams(pages).select("doc_id", "page_num", F.lit(True).alias("found"))
    named = files.diagram_pages(pages).join(found, ["doc_id", "page_num"], "left")
    return named.select("doc_id", F.col("page_num").cast("long").alias("page_num"), "diagram_type", F.coalesce("found", F.lit(False)).alias("extracted"))


@query(f"""WITH {_TABLES_SQL}, n AS (SELECT doc_id, count(*) AS pages FROM pages_ GROUP BY doc_id), k AS (SELECT doc_id, count(*) AS n_tables, arg_min('table_p' || page_num || '_' || i, page_num * 10 + i) AS first_table FROM tables_ GROUP BY doc_id)
SELECT doc_id, pages AS total_pages, coalesce(nullif(regexp_extract(s, 'LMR[0-9]+[A-Z]*'), ''), nullif(regexp_extract(s, 'TPS[0-9]+[A-Z]*'), ''), nullif(regexp_extract(s, 'LM[0-9]+[A-Z]*'), ''), 'Unknown') AS mpn,
  CASE WHEN contains(lower(s), 'texas instruments') THEN 'Texas Instruments' WHEN contains(lower(s), 'analog devices') THEN 'Analog Devices' WHEN contains(lower(s), 'onsemi') THEN 'onsemi' ELSE 'Unknown' END AS manufacturer, coalesce(n_tables, 0) AS n_tables, first_table, 0 AS n_diagrams
FROM n LEFT JOIN k USING (doc_id) LEFT JOIN (SELECT doc_id, s FROM pages_ WHERE page_num = 1) USING (doc_id)""")
def page_documents(t, spark, sf_dir):
    pages = _pages(t)
    made = files.json_text(files.page_documents(pages, rules.extract_page_tables(pages)))
    known = "metadata struct<mpn: string, manufacturer: string, total_pages: long>, tables array<struct<table_id: string>>, diagrams array<struct<diagram_id: string>>"
    read = made.select("doc_id", F.from_json("json", known).alias("j"))
    size = lambda c: F.size(F.coalesce(F.col(c), F.array())).cast("long")
    return read.select("doc_id", "j.metadata.*", size("j.tables.table_id").alias("n_tables"), F.get(F.col("j.tables"), F.lit(0))["table_id"].alias("first_table"), size("j.diagrams.diagram_id").alias("n_diagrams"))


@query("SELECT 'prototype' AS extractor, 'in.pdf' AS source, 5 AS page_num, 'Electrical Characteristics' AS title, 2 AS rows, 'uA' AS last_unit, 'VIN>UVLO_Comparator|UVLO_Comparator>Enable_Logic|Feedback_Pin>Error_Amp' AS edges")
def prototype_document(t, spark, sf_dir):
    made = files.prototype_documents(fixtures.prototype_table(spark), fixtures.prototype_graph(spark).coalesce(1), "in.pdf")
    one = F.get(F.col("tables"), F.lit(0))
    edges = F.array_join(F.transform("diagrams", lambda e: F.concat(e["source"], F.lit(">"), e["target"])), "|")
    return made.select("metadata.extractor", "metadata.source", one["page_num"].cast("long").alias("page_num"), one["title"].alias("title"), F.size(one["rows"]).cast("long").alias("rows"), F.try_element_at(one["rows"], F.lit(2))["Unit"].alias("last_unit"), edges.alias("edges"))


@query("SELECT path AS doc_id, 'vision_table_' || row_number() OVER (ORDER BY path) AS table_id, 'verified' AS status, 0.99::DOUBLE AS confidence, 'auto_resolved' AS method, 'table_id' AS fields, 0.002::DOUBLE AS cost, 9 AS numbers, 5 AS units, 'µA' AS iq_unit FROM (SELECT '/in/' || p_partkey || '.pdf' AS path FROM part)")
def demo_readings(t, spark, sf_dir):
    read = fixtures.mock_readings(_files(t))
    done = params.documents_out(verify.verify_tables(read)).join(read.select("doc_id", "cost_usd"), "doc_id")
    units = F.array_distinct(F.transform("parameters", lambda p: F.struct(F.regexp_replace(p["name"], "_[a-z]+$", ""), p["unit"])))
    iq = F.get(F.filter("parameters", lambda p: p["name"] == "quiescent_current_typ"), F.lit(0))["unit"]
    return done.select(
        "doc_id", F.get(F.col("tables"), F.lit(0))["table_id"].alias("table_id"), "verification.status", F.col("verification.confidence"), F.col("verification.resolution_method").alias("method"), F.array_join("conflicts.field", ",").alias("fields"),
        F.col("cost_usd").alias("cost"), F.size("parameters").cast("long").alias("numbers"), F.size(units).cast("long").alias("units"), iq.alias("iq_unit"),
    )


# rule tables -------------------------------------------------------------------------------------


def _rule_grids(t):
    # a cell at a time in loops: spelled out, the grid is more code than Java compiles
    five, extra = F.array(*map(F.lit, range(1, 6))), F.when(_key() % 5 == 0, F.array(F.lit("extra"))).otherwise(F.array().cast("array<string>"))
    head = F.transform(five, lambda i: _pick(catalog._HEADS, _key() + i * 3))

    def row(a):
        return F.concat(F.transform(five, lambda i: F.when((a == 2) & (_key() % 4 == 0), "").otherwise(_pick(catalog._GRID_CELLS, _key() + i * a))), extra)

    rows = F.transform(F.when(_key() % 7 == 0, F.array().cast("array<int>")).otherwise(F.array(*map(F.lit, range(1, 4)))), row)
    grid = F.concat(F.array(head), rows)
    return _dealt(t("part")).select(_key().alias("doc_id"), F.lit(1).alias("page_num"), (_key() % 3).cast("int").alias("table_idx"), catalog._page(_key()).alias("text"), grid.alias("grid"))


@query(f"""WITH h AS (SELECT p_partkey AS k, i - 1 AS col, {sql.pick(catalog._HEADS, "(p_partkey + i * 3)")} AS raw FROM part, range(1, 6) c(i)),
hn AS (SELECT k, col, {catalog._HEADER_SQL.format("raw")} AS header FROM h),
conf AS (SELECT k, CASE WHEN count(DISTINCT header) FILTER (header IN ('Parameter', 'Min', 'Typ', 'Max', 'Unit')) >= 3 THEN 0.9 ELSE 0.6 END AS confidence FROM hn GROUP BY k),
g AS (SELECT p_partkey AS k, a, i - 1 AS col, CASE WHEN i = 6 THEN 'extra' WHEN a = 2 AND p_partkey % 4 = 0 THEN '' ELSE {sql.pick(catalog._GRID_CELLS, "(p_partkey + i * a)")} END AS cell FROM part, range(1, 4) r(a), range(1, 7) c(i) WHERE i < 6 OR p_partkey % 5 = 0),
kept AS (SELECT k, a, row_number() OVER (PARTITION BY k ORDER BY a) - 1 AS row_idx FROM g GROUP BY k, a HAVING bool_or(cell <> '')),
e AS (SELECT g.k, a, coalesce(header, 'col_' || g.col) AS key, arg_max(trim(regexp_replace(cell, '\\s+', ' ', 'g')), g.col) AS v FROM g LEFT JOIN hn ON g.k = hn.k AND g.col = hn.col GROUP BY g.k, a, coalesce(header, 'col_' || g.col))
SELECT k AS doc_id, 'table_p1_' || (k % 3) AS table_id, confidence::DOUBLE AS confidence, row_idx, string_agg(key || '=' || v, '|' ORDER BY key || '=' || v) AS cells
FROM e JOIN kept USING (k, a) JOIN conf USING (k) WHERE k % 7 <> 0 GROUP BY ALL""")
def rule_rows(t, spark, sf_dir):
    tables = verify.once(rules.tables_from_grids(_rule_grids(t)).select("doc_id", "table_id", "confidence", "rows"), "found", F.col("rows"))
    rows = tables.select("doc_id", "table_id", "confidence", F.posexplode("found").alias("row_idx", "r"))
    return rows.select("doc_id", "table_id", "confidence", F.col("row_idx").cast("long").alias("row_idx"), _joined(F.col("r")).alias("cells"))


# merged cells ------------------------------------------------------------------------------------

_BEST = f"{catalog._GRID_SQL}, best AS (SELECT DISTINCT ON (doc_id, row, col) * FROM found ORDER BY doc_id, row, col, confidence DESC, ord), mean AS (SELECT doc_id, avg(confidence) AS c FROM best GROUP BY doc_id)"
_MEAN = "coalesce(round(c, 6), 1.0)::DOUBLE AS confidence, coalesce(c, 1.0) < 0.6 AS needs_vision"


@query(f"WITH {_BEST} SELECT p_partkey AS doc_id, {_MEAN} FROM part LEFT JOIN mean ON doc_id = p_partkey")
def merge_confidence(t, spark, sf_dir):
    return merges.detect_merges(catalog._grids(t)).select("doc_id", F.round("merge_confidence", 6).alias("confidence"), "needs_vision")


@query(f"""WITH {_BEST},
filled AS (SELECT g.doc_id, g.row, g.col, g.cell, content FROM g LEFT JOIN best b ON b.doc_id = g.doc_id AND b.row = g.row AND g.col BETWEEN b.col AND b.col + b.span - 1),
heads AS (SELECT doc_id, col, CASE WHEN trim(cell) = '' THEN coalesce(content, cell) ELSE cell END AS header FROM filled WHERE row = 0),
cells AS (SELECT doc_id, f.row, header, arg_max(coalesce(content, trim(cell)), col) AS v FROM filled f JOIN heads USING (doc_id, col) WHERE f.row > 0 GROUP BY ALL),
named AS (SELECT doc_id, string_agg(header, '|' ORDER BY col) AS headers FROM heads GROUP BY doc_id),
mapped AS (SELECT doc_id, row, string_agg(header || '=' || v, '|' ORDER BY header || '=' || v) AS cells FROM cells GROUP BY ALL)
SELECT doc_id, headers, row, cells, {_MEAN} FROM mapped JOIN named USING (doc_id) LEFT JOIN mean USING (doc_id)""")
def merge_resolve(t, spark, sf_dir):
    made = merges.enhance_tables(catalog._grids(t))
    rows = made.select("doc_id", F.array_join("resolved_headers", "|").alias("headers"), F.posexplode("resolved_rows").alias("row", "r"), "merge_confidence", "needs_vision")
    return rows.select("doc_id", "headers", (F.col("row") + 1).cast("long").alias("row"), _joined(F.col("r")).alias("cells"), F.round("merge_confidence", 6).alias("confidence"), "needs_vision")


@query(f"""WITH w AS (SELECT p_partkey AS k, a, i, 10.0::DOUBLE + (p_partkey * (i + a)) % 5 * 9 AS w, {sql.pick(catalog._GRID_CELLS, "(p_partkey + i * a)")} AS cell FROM part, range(1, 4) r(a), range(1, 5) c(i)),
m AS (SELECT k, i, list_sort(list(w))[2] AS m FROM w GROUP BY k, i)
SELECT k AS doc_id, a - 1 AS row, i - 1 AS col_start, i - 2 + CAST(floor(w / m) AS BIGINT) AS col_end, trim(cell) AS content, 0.9::DOUBLE AS confidence FROM w JOIN m USING (k, i) WHERE w > 1.5 * m AND floor(w / m) > 1""")
def width_spans(t, spark, sf_dir):
    span = lambda a, i: F.struct(F.lit(i * 100.0).alias("x0"), (F.lit(i * 100.0) + 10 + (_key() * (i + a)) % 5 * 9).alias("x1"))
    rows = range(1, 4), range(1, 5)
    grids = t("part").select(_key().alias("doc_id"), F.array(*[F.array(*[_pick(catalog._GRID_CELLS, _key() + i * a) for i in rows[1]]) for a in rows[0]]).alias("grid"), F.array(*[F.array(*[span(a, i) for i in rows[1]]) for a in rows[0]]).alias("positions"))
    found = grids.select("doc_id", F.explode(merges.width_merges(F.col("grid"), F.col("positions"))).alias("m"))
    return found.select("doc_id", *[F.col(f"m.{c}").cast("long").alias(c) for c in ("row", "col_start", "col_end")], "m.content", "m.confidence")


# verification, other ways ------------------------------------------------------------------------


@query(f"WITH {catalog._WITH_IDS} SELECT doc_id, field, vision_value, rule_value, severity FROM conflicts WHERE field IN ('title', 'table_id')")
def metadata_conflicts(t, spark, sf_dir):
    return catalog._conflicts(spark, sf_dir).where("field IN ('title', 'table_id')").select("doc_id", "field", "vision_value", "rule_value", "severity")


@query(f"WITH {catalog._WITH_IDS} SELECT arbiter, arbiter || '_wins' AS resolution, count(*) AS n, count(*) FILTER (arbiter = 'rule' OR vision_value = rule_value) AS with_rule FROM conflicts, (VALUES ('vision'), ('rule')) a(arbiter) GROUP BY arbiter")
def constant_arbiters(t, spark, sf_dir):
    def counted(name: str):
        found = verify.exploded_conflicts(verify.verifier(name)(_pairs(spark, sf_dir)))
        return found.groupBy("resolution").agg(F.count("*").alias("n"), F.count_if(F.col("resolved_value") == F.col("rule_value")).alias("with_rule")).withColumn("arbiter", F.lit(name))

    return counted("vision").unionByName(counted("rule"))


@query(f"WITH {catalog._WITH_IDS} SELECT doc_id, status, round(confidence, 3) AS confidence FROM verdicts")
def quick_verify(t, spark, sf_dir):
    pairs = _pairs(spark, sf_dir)
    second = pairs.where("rule IS NOT NULL").select("doc_id", F.col("rule").alias("table"))
    return verify.quick_verify(pairs.select("doc_id", F.col("vision").alias("table")), second).withColumn("confidence", F.round("confidence", 3))


@query("SELECT o_orderkey AS doc_id, 'failed' AS status FROM orders WHERE o_orderkey % 13 = 0")
def failed_params(t, spark, sf_dir):
    name = F.when(F.col("o_orderkey") % 13 != 0, F.col("o_orderpriority"))
    rows = F.array(F.create_map(F.lit("Parameter"), F.lit("VIN"), F.lit("Min"), F.lit("1")), F.create_map(F.lit("Parameter"), name, F.lit("Min"), F.lit("2")))
    return params.failed_parameters(t("orders").select(F.col("o_orderkey").alias("doc_id"), rows.alias("merged_rows")))


# exports -----------------------------------------------------------------------------------------


@query(f"""WITH {catalog._PARAMS_AND_IDS}, n AS (SELECT doc_id, count(*) AS parameters, string_agg(name || '=' || coalesce(unit, ''), '|' ORDER BY name) AS units FROM params GROUP BY doc_id), r AS (SELECT doc_id, count(*) AS rows FROM li GROUP BY doc_id)
SELECT doc_id, status, round_even(confidence, 3) AS confidence, resolution_method, n_conflicts AS conflict_count, rows, coalesce(parameters, 0) AS parameters, coalesce(units, '') AS units, n_conflicts > 0 AS has_conflicts FROM verdicts JOIN r USING (doc_id) LEFT JOIN n USING (doc_id)""")
def document_results(t, spark, sf_dir):
    made = files.json_text(params.documents_out(_verified(spark, sf_dir)))
    known = "verification struct<status: string, confidence: double, resolution_method: string, conflict_count: long>, tables array<struct<rows: array<map<string,string>>>>, parameters array<struct<name: string, unit: string>>, conflicts array<struct<field: string>>"
    read = made.select("doc_id", F.from_json("json", known).alias("j"))
    units = F.array_join(F.transform("j.parameters", lambda p: F.concat(p["name"], F.lit("="), F.coalesce(p["unit"], F.lit("")))), "|")
    return read.select("doc_id", "j.verification.*", F.size(F.get(F.col("j.tables"), F.lit(0))["rows"]).cast("long").alias("rows"), F.size("j.parameters").cast("long").alias("parameters"), units.alias("units"), F.col("j.conflicts").isNotNull().alias("has_conflicts"))


@query(f"WITH {catalog._PARAMS_AND_IDS} SELECT '/in/' || doc_id || '.pdf' AS source_file, any_value(CAST(round(confidence, 3)::DOUBLE AS VARCHAR)) AS confidence, any_value(status) AS status, {', '.join(f'coalesce(CAST(max(num) FILTER (name = {sql.quoted(n)}) AS VARCHAR), {sql.quoted(str())}) AS {n}' for n in catalog._NAMES)} FROM params JOIN verdicts USING (doc_id) GROUP BY doc_id")
def wide_csv(t, spark, sf_dir):
    source = F.concat(F.lit("/in/"), F.col("doc_id").cast("string"), F.lit(".pdf"))
    told = _verified(spark, sf_dir).withColumns({"source_file": source, "confidence": F.round("confidence", 3)})
    return params.wide_rows(params.long_parameters(told, carry=["source_file", "confidence", "status"]))


@query(f"{catalog._IMPORTED} SELECT mpn, mpn || ',' || manufacturer || ',' || category || ',,' || {' || '.join(f'''coalesce(CAST({c} AS VARCHAR), '') || ',' ''' for c in catalog._NUMBERS.values())} || ',Active,,' || notes AS line FROM imported")
def importer_csv(t, spark, sf_dir):
    rows = catalog._imported(spark, sf_dir)
    return rows.select(F.col("MPN").alias("mpn"), F.to_csv(F.struct(*rows.columns), {"emptyValue": ""}).alias("line"))


@query(f"""WITH {catalog._PARAMS_AND_IDS}, n AS (SELECT doc_id, count(*) AS n_params, string_agg(CASE name {catalog._RENAMED} ELSE name END, '|' ORDER BY CASE name {catalog._RENAMED} ELSE name END) AS names FROM params GROUP BY doc_id)
SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'LMR' || doc_id WHEN doc_id % 3 = 0 THEN 'MCP' || doc_id ELSE 'UNKNOWN' END AS mpn, CASE WHEN doc_id % 2 = 0 THEN 'Texas Instruments' WHEN doc_id % 3 = 0 THEN 'Microchip' ELSE '' END AS manufacturer, coalesce(n_params, 0) AS n_params, coalesce(names, '') AS names FROM verdicts LEFT JOIN n USING (doc_id)""")
def review_records(t, spark, sf_dir):
    doc = F.col("doc_id")
    source = F.when(doc % 2 == 0, F.concat(F.lit("/in/lmr"), doc.cast("string"), F.lit(".pdf"))).when(doc % 3 == 0, F.concat(F.lit("mcp"), doc.cast("string"), F.lit(".pdf"))).otherwise("")
    docs = verify.once(_verified(spark, sf_dir), "rows", F.col("merged_rows")).select(
        "doc_id", source.alias("source_file"), F.col("vision.confidence").alias("table_confidence"), "confidence", F.lit("double_verified_vision").alias("method"), F.array("vision.table_id").alias("table_ids"),
        params.parameter_list(F.col("rows")).alias("parameters"),
    )
    out = params.review_records(docs)
    names = F.array_sort(F.map_keys(F.coalesce("params", F.create_map().cast(dict(out.dtypes)["params"]))))
    return out.select("doc_id", "mpn", "manufacturer", F.size(names).cast("long").alias("n_params"), F.array_join(names, "|").alias("names"))


@query("""WITH r AS (SELECT '/in/' || o_orderkey || '.pdf' AS file, CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'failed' ELSE 'skipped' END AS status, o_orderkey % 100 / 100.0::DOUBLE AS confidence FROM orders),
s AS (SELECT count(*) AS total, count(*) FILTER (status = 'success') AS success, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'skipped') AS skipped FROM r)
SELECT 0 AS part, unnest(['# Batch Processing Report', '', '**Generated:** today', '**Duration:** 1.5 seconds', '', '## Summary', '', '| Metric | Value |', '|--------|-------|']) AS line
UNION ALL SELECT 1, unnest(['| Total Files | ' || total || ' |', '| Success | ' || success || ' |', '| Failed | ' || failed || ' |', '| Skipped | ' || skipped || ' |', '| Success Rate | ' || printf('%.1f', round_even(success / greatest(total - skipped, 1) * 100, 1)) || '% |']) FROM s
UNION ALL SELECT 2, unnest(['', '## Successful Extractions', '', '| File | Confidence | Output |', '|------|------------|--------|'])
UNION ALL SELECT 3, '| ' || file || ' | ' || CAST(round_even(confidence * 100, 0) AS INT) || '% | /out |' FROM r WHERE status = 'success'
UNION ALL SELECT 4, unnest(['', '## Errors', '', '| File | Error |', '|------|-------|']) WHERE (SELECT failed FROM s) > 0
UNION ALL SELECT 5, '| ' || file || ' | no table |' FROM r WHERE status = 'failed'
UNION ALL SELECT 6, unnest(['', '---', '*Generated by sheetwise*'])""")
def batch_report(t, spark, sf_dir):
    status = F.when(F.col("o_orderstatus") == "F", "success").when(F.col("o_orderstatus") == "O", "failed").otherwise("skipped")
    key = F.col("o_orderkey")
    results = t("orders").select(F.concat(F.lit("/in/"), key.cast("string"), F.lit(".pdf")).alias("file"), status.alias("status"), (key % 100 / 100).alias("confidence"), F.lit("/out").alias("output"), F.lit("no table").alias("error"))
    return batch.batch_report(results, 1.5, "today").select(F.col("ord.part").cast("long").alias("part"), "line")


# the model boundary ------------------------------------------------------------------------------


class _Flaky(model.MockClient):
    """Refuses prompts that tell it to."""

    def __call__(self, prompt: str, image: str) -> dict:
        if "refuse" in prompt:
            raise RuntimeError("refused")
        return super().__call__(prompt, image)


@query("""SELECT CAST(p_partkey AS VARCHAR) AS request_id, p_partkey % 9 <> 0 AS success, CASE WHEN p_partkey % 9 = 0 THEN 3 ELSE 1 END AS attempts, CASE WHEN p_partkey % 9 = 0 THEN 'RuntimeError: refused' END AS error,
  CASE WHEN p_partkey % 9 <> 0 AND p_partkey % 4 = 0 THEN 2 END AS rows, CASE WHEN p_partkey % 9 <> 0 AND p_partkey % 4 IN (1, 2) THEN 2 END AS nodes, CASE WHEN p_partkey % 9 <> 0 AND p_partkey % 4 = 3 THEN 'Read the application circuit of this image. Answer in JSON with circuit_type, main_ic, components (r' END AS echo FROM part""")
def model_answers(t, spark, sf_dir):
    kinds = list(model.PROMPTS)
    prompt = F.concat(_pick([model.PROMPTS[k][0] for k in kinds], _key()), F.when(_key() % 9 == 0, " Please refuse.").otherwise(""))
    requests = t("part").select(_key().cast("string").alias("request_id"), prompt.alias("prompt"), F.col("p_name").cast("binary").alias("image"))
    answers = model.ask_model(requests, _Flaky, wait=lambda n: 0.0)
    size = lambda schema, field: F.when(F.size(model.json_answer(F.col("content"), schema)[field]) > 0, F.size(model.json_answer(F.col("content"), schema)[field])).cast("long")
    return answers.select("request_id", "success", F.col("attempts").cast("long").alias("attempts"), "error", size(model.TABLE_SCHEMA, "rows").alias("rows"), size(model.GRAPH_SCHEMA, "nodes").alias("nodes"), F.when(F.try_parse_json("content").isNull(), F.col("content")).alias("echo"))


@query("SELECT round(coalesce(sum(value) FILTER (event_id % 4 <> 0), 0), 2) AS total_cost FROM events")
def model_spend(t, spark, sf_dir):
    answers = t("events").select((F.col("event_id") % 4 != 0).alias("success"), F.col("value").alias("cost_usd"))
    return model.spend(answers).select(F.round("total_cost", 2).alias("total_cost"))


@query("SELECT event_id, base64(encode(props)) AS image FROM events")
def image_texts(t, spark, sf_dir):
    return t("events").select("event_id", model.image_text(F.col("props").cast("binary")).alias("image"))
