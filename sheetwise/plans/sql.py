"""SQL pieces of the oracles: the derived extraction pairs and the comparison rules, for DuckDB."""

from ..functions.naming import MAKER_PREFIXES
from ..functions.units import lookup
from ..operators.verify import CRITICAL
from ..sources.fixtures import NAMES, OTHER_UNITS, UNITS


def quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def pick(values: list[str], by: str) -> str:
    return f"[{', '.join(map(quoted, values))}][{by} % {len(values)} + 1]"


def number(x: str) -> str:
    kept = f"regexp_replace({x}, '[^0-9.\\-+eE]', '', 'g')"
    return f"(CASE WHEN regexp_matches({kept}, '[0-9]') THEN try_cast({kept} AS DOUBLE) END)"


def unit(x: str) -> str:
    known = " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in lookup().items())
    return f"(CASE lower(trim({x})) {known} ELSE trim({x}) END)"


def text(x: str) -> str:
    return f"regexp_replace(regexp_replace(lower(trim({x})), '\\s+', ' ', 'g'), '[.,;:!?]', '', 'g')"


def gap(a: str, b: str) -> str:
    return f"(CASE WHEN greatest(abs({a}), abs({b})) > 0 THEN abs({a} - {b}) / greatest(abs({a}), abs({b})) END)"


def maker(x: str) -> str:
    return "CASE " + " ".join(f"WHEN starts_with(upper({x}), {quoted(k)}) THEN {quoted(v)}" for k, v in MAKER_PREFIXES.items()) + " ELSE '' END"


_CRITICAL = "(" + " OR ".join(f"contains({{0}}, {quoted(c)})" for c in CRITICAL) + ")"
_TIMES = "CAST(CAST({0} AS DECIMAL(18,2)) * CAST({1} AS DECIMAL(6,3)) AS VARCHAR)"
_TEXT = "CAST(CAST({0} AS DECIMAL(18,2)) AS VARCHAR)"

#: doc_id, row_idx, n rows, the cells of both extractions.
LINES = f"""
j AS (SELECT * FROM lineitem JOIN part ON l_partkey = p_partkey),
li AS (
  SELECT l_orderkey AS doc_id, row_number() OVER w - 1 AS row_idx, count(*) OVER (PARTITION BY l_orderkey) AS n,
    CASE {" ".join(f"WHEN starts_with(p_type, {quoted(k)}) THEN {quoted(v)}" for k, v in NAMES.items())} ELSE 'Thermal Resistance' END AS parameter,
    {_TEXT.format("l_quantity")} AS v_min, {_TEXT.format("l_extendedprice")} AS v_typ, {_TEXT.format("p_retailprice")} AS v_max, {pick(UNITS, "l_partkey")} AS v_unit,
    CASE WHEN l_orderkey % 50 = 0 THEN {_TIMES.format("l_quantity", "1.5")} ELSE {_TEXT.format("l_quantity")} END AS r_min,
    CASE WHEN l_orderkey % 50 = 0 THEN {_TIMES.format("l_extendedprice", "1.5")} WHEN l_partkey % 8 = 2 THEN {_TIMES.format("l_extendedprice", "1.005")} WHEN l_partkey % 8 = 3 THEN {_TIMES.format("l_extendedprice", "1.07")}
         WHEN l_partkey % 8 = 4 THEN {_TIMES.format("l_extendedprice", "1.2")} ELSE {_TEXT.format("l_extendedprice")} END AS r_typ,
    CASE WHEN l_orderkey % 50 = 0 THEN {_TIMES.format("p_retailprice", "1.5")} WHEN l_partkey % 8 = 5 THEN '' ELSE {_TEXT.format("p_retailprice")} END AS r_max,
    CASE WHEN l_partkey % 8 = 6 THEN '' WHEN l_partkey % 8 = 1 THEN {pick(OTHER_UNITS, "l_partkey")} ELSE {pick(UNITS, "l_partkey")} END AS r_unit
  FROM j WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice))"""

CELLS = f"""{LINES},
pc AS (SELECT doc_id, row_idx, parameter, unnest([
    {{'key': 'Parameter', 'v': parameter, 'r': parameter}}, {{'key': 'Min', 'v': v_min, 'r': r_min}}, {{'key': 'Typ', 'v': v_typ, 'r': r_typ}},
    {{'key': 'Max', 'v': v_max, 'r': r_max}}, {{'key': 'Unit', 'v': v_unit, 'r': r_unit}}], recursive := true)
  FROM li WHERE doc_id % 31 <> 5 AND NOT (doc_id % 7 = 3 AND row_idx = n - 1)),
cells AS (SELECT *, {number("v")} AS nv, {number("r")} AS nr FROM pc),
cmp AS (SELECT *, CASE WHEN v = r THEN true WHEN v = '' OR r = '' THEN false
    WHEN coalesce((nv = 0 AND nr = 0) OR {gap("nv", "nr")} <= 0.01, false) THEN true
    ELSE {unit("v")} = {unit("r")} OR {text("v")} = {text("r")} END AS matched FROM cells)"""

CONFLICTS = f"""{CELLS},
docs AS (SELECT DISTINCT doc_id FROM li),
raw AS (
  SELECT doc_id, row_idx, key, 'row[' || row_idx || '].' || key AS field, v AS vision_value, r AS rule_value,
    CASE WHEN {_CRITICAL.format("lower(key)")} OR {_CRITICAL.format("lower(parameter)")} THEN 'critical' WHEN {gap("nv", "nr")} > 0.1 THEN 'high' WHEN {gap("nv", "nr")} > 0.05 THEN 'medium' ELSE 'low' END AS severity,
    CASE WHEN contains(lower(key), 'unit') THEN 'unit' WHEN nv IS NOT NULL THEN 'numeric' ELSE 'text' END AS conflict_type
  FROM cmp WHERE NOT matched
  UNION ALL SELECT doc_id, 1000000, 'headers', 'headers', '[''Parameter'', ''Min'', ''Typ'', ''Max'', ''Unit'']', '[''Parameter'', ''Test_Conditions'', ''Min'', ''Typ'', ''Max'', ''Unit'']', 'medium', 'structure' FROM docs WHERE doc_id % 11 = 0 AND doc_id % 31 <> 5),
conflicts AS (SELECT *, CASE WHEN conflict_type = 'unit' THEN 'rule_wins' ELSE 'vision_wins' END AS resolution,
    CASE severity WHEN 'low' THEN 0.02 * 0.5::DOUBLE WHEN 'medium' THEN 0.05 * 0.5::DOUBLE WHEN 'high' THEN 0.10 * 0.5::DOUBLE ELSE 0.20 * 0.5::DOUBLE END AS penalty,
    severity = 'critical' AND coalesce({gap(number("vision_value"), number("rule_value"))} > 0.1, false) AS large FROM raw),
folded AS (SELECT doc_id, count(*) AS n_conflicts, greatest(0.0, least(1.0, list_reduce(list_prepend(1.0::DOUBLE, list(penalty::DOUBLE ORDER BY row_idx, key)), lambda a, x: a - x))) AS conf, bool_or(large) AS large FROM conflicts GROUP BY doc_id),
verdicts AS (SELECT doc_id, coalesce(n_conflicts, 0) AS n_conflicts,
    CASE WHEN doc_id % 31 = 5 THEN 0.85 ELSE coalesce(conf, 1.0) END AS confidence,
    CASE WHEN doc_id % 31 = 5 OR n_conflicts IS NULL THEN 'verified' WHEN large THEN 'needs_review' WHEN conf < 0.6 THEN 'conflict' ELSE 'verified' END AS status,
    CASE WHEN doc_id % 31 = 5 THEN 'vision_only' WHEN n_conflicts IS NULL THEN 'perfect_match' WHEN large THEN 'manual_required' WHEN conf < 0.6 THEN 'low_confidence' ELSE 'auto_resolved' END AS resolution_method
  FROM docs LEFT JOIN folded USING (doc_id))"""

#: Parameters of the merged tables: units are the rules' where both extractions stand and differ.
PARAMS = f"""{LINES},
mu AS (SELECT *, CASE WHEN doc_id % 31 = 5 OR (doc_id % 7 = 3 AND row_idx = n - 1) OR (r_unit <> '' AND {unit("v_unit")} = {unit("r_unit")}) THEN v_unit ELSE r_unit END AS m_unit, replace(lower(parameter), ' ', '_') AS base FROM li),
nums AS (SELECT doc_id, row_idx, base, unnest([{{'kind': 'min', 'num': try_cast(v_min AS DOUBLE)}}, {{'kind': 'typ', 'num': try_cast(v_typ AS DOUBLE)}}, {{'kind': 'max', 'num': try_cast(v_max AS DOUBLE)}}], recursive := true) FROM mu),
units AS (SELECT doc_id, base, arg_max(m_unit, row_idx) AS unit FROM mu WHERE m_unit <> '' GROUP BY doc_id, base),
params AS (SELECT doc_id, base || '_' || kind AS name, base, kind, arg_max(num, row_idx) AS num, any_value(unit) AS unit FROM nums LEFT JOIN units USING (doc_id, base) GROUP BY doc_id, base, kind)"""
