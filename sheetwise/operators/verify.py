"""Cell by cell verification of two extractions of the same table.

Everything stays in one row per pair: rows are zipped by position, keys of a row united, conflicts
classified, resolved and folded with array functions, so a verdict needs no exchange.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import close, number_in, numbers_match, relative_difference, texts_match
from ..functions.units import units_match

# fixed values
CRITICAL = ("vin", "vout", "iout", "iq", "efficiency", "vin_min", "vin_max", "vout_min", "vout_max", "iout_max", "power", "frequency")
PENALTY = {"low": 0.02, "medium": 0.05, "high": 0.10, "critical": 0.20}
TOLERANCE, THRESHOLD, LARGE, NOTABLE, VISION_ONLY = 0.01, 0.60, 0.10, 0.05, 0.85

CONFLICT = "array<struct<field: string, vision_value: string, rule_value: string, severity: string, conflict_type: string, resolution: string, resolved_value: string, row_idx: int, key: string>>"

Arbiter = Callable[[Column, Column, Column], Column]


def smart_arbiter(kind: Column, vision: Column, rule: Column) -> Column:
    """Rules win units, vision everything else."""
    return F.when(kind == "unit", "rule_wins").otherwise("vision_wins")


def vision_arbiter(kind: Column, vision: Column, rule: Column) -> Column:
    return F.lit("vision_wins")


def rule_arbiter(kind: Column, vision: Column, rule: Column) -> Column:
    return F.lit("rule_wins")


#: Named strategies; add to them to plug in others.
ARBITERS: dict[str, Arbiter] = {"smart": smart_arbiter, "vision": vision_arbiter, "rule": rule_arbiter}
COMPARATORS: dict[str, Callable[[Column, Column], Column]] = {"numeric": numbers_match, "unit": units_match, "text": texts_match}


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, also where the optimizer moves it into a lambda's loop."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column that is computed once a row: filters and projections above it don't copy its expression, as a generator stands between."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def cell(row: Column, key: Column) -> Column:
    """The text of a cell: empty where the key is missing, None for a null under a key."""
    return F.coalesce(F.try_element_at(row, key), F.when(F.map_contains_key(row, key), "None").otherwise(""))


def cells_match(a: Column, b: Column, tolerance: float = TOLERANCE) -> Column:
    """Equal as empty cells, numbers, units or texts, tried for every column alike."""
    return F.when(a == b, True).when((a == "") | (b == ""), False).when(numbers_match(a, b, tolerance), True).otherwise(units_match(a, b) | texts_match(a, b))


def conflict_type(key: Column, vision: Column) -> Column:
    return F.when(F.contains(F.lower(key), F.lit("unit")), "unit").when(number_in(vision).isNotNull(), "numeric").otherwise("text")


def _level(key: Column, x: Column, y: Column, parameter: Column, critical) -> Column:
    named = "|".join(f"\\Q{c}\\E" for c in critical or CRITICAL)
    short = F.regexp_extract(F.lower(key), r"([^.]*)$", 1)
    gap = relative_difference(x, y)
    return F.when(short.rlike(named) | F.lower(parameter).rlike(named), "critical").when(gap > LARGE, "high").when(gap > NOTABLE, "medium").otherwise("low")


def severity(key: Column, vision: Column, rule: Column, parameter: Column, critical=CRITICAL) -> Column:
    """Critical by name of the column (after its last dot) or of the row's parameter; else by relative difference."""
    return _level(key, number_in(vision), number_in(rule), parameter, critical)


def fold_confidence(penalties: Column) -> Column:
    """1 less the penalties one after another, in their order, within 0 and 1."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.aggregate(penalties, F.lit(1.0), lambda acc, x: acc - x)))


def penalty(level: Column) -> Column:
    """Of a resolved conflict: half of its severity's."""
    out = F.lit(PENALTY["low"] * 0.5)
    for name in ("medium", "high", "critical"):
        out = F.when(level == name, F.lit(PENALTY[name] * 0.5)).otherwise(out)
    return out


def _conflict(field: Column, vision: Column, rule: Column, level: Column, kind: Column, arbiter: Arbiter, row_idx: Column, key: Column) -> Column:
    winner = arbiter(kind, vision, rule)
    value = F.when(winner == "rule_wins", rule).otherwise(vision)
    parts = {"field": field, "vision_value": vision, "rule_value": rule, "severity": level, "conflict_type": kind, "resolution": winner, "resolved_value": value, "row_idx": row_idx.cast("int"), "key": key}
    return F.struct(*[c.alias(n) for n, c in parts.items()])


def cell_conflicts(vision: Column, rule: Column, tolerance: float = TOLERANCE, critical=CRITICAL, arbiter: Arbiter = smart_arbiter) -> Column:
    """Conflicts of two arrays of row maps, matched by position; surplus rows of the longer one are not compared."""
    n = F.least(F.size(vision), F.size(rule))
    pairs = F.zip_with(F.slice(vision, F.lit(1), n), F.slice(rule, F.lit(1), n), lambda v, r: F.struct(v.alias("v"), r.alias("r")))

    def of_row(pair: Column, i: Column) -> Column:
        keys = F.array_sort(F.array_union(F.map_keys(pair["v"]), F.map_keys(pair["r"])))
        cells = F.transform(keys, lambda k: F.struct(k.alias("k"), cell(pair["v"], k).alias("v"), cell(pair["r"], k).alias("r")))
        # most cells are equal; of the others each number is read once
        read = F.transform(F.filter(cells, lambda c: c["v"] != c["r"]), lambda c: F.struct(c["k"].alias("k"), c["v"].alias("v"), c["r"].alias("r"), number_in(c["v"]).alias("x"), number_in(c["r"]).alias("y")))
        same = lambda c: F.when((c["v"] == "") | (c["r"] == ""), False).when(close(c["x"], c["y"], tolerance), True).otherwise(units_match(c["v"], c["r"]) | texts_match(c["v"], c["r"]))

        def one(c: Column) -> Column:
            field = F.concat(F.lit("row["), i.cast("string"), F.lit("]."), c["k"])
            kind = F.when(F.contains(F.lower(c["k"]), F.lit("unit")), "unit").when(c["x"].isNotNull(), "numeric").otherwise("text")
            return _conflict(field, c["v"], c["r"], _level(c["k"], c["x"], c["y"], cell(pair["v"], F.lit("Parameter")), critical), kind, arbiter, i, c["k"])

        return F.transform(F.filter(read, lambda c: ~same(c)), one)

    return F.flatten(F.transform(pairs, of_row))


def header_conflicts(vision: Column, rule: Column, arbiter: Arbiter = smart_arbiter) -> Column:
    shown = lambda h: F.concat(F.lit("['"), F.array_join(h, "', '"), F.lit("']"))
    one = _conflict(F.lit("headers"), shown(vision), shown(rule), F.lit("medium"), F.lit("structure"), arbiter, F.lit(None), F.lit("headers"))
    return F.when(vision != rule, F.array(one)).otherwise(F.array().cast(CONFLICT))


def metadata_conflicts(vision: Column, rule: Column, tolerance: float = TOLERANCE, arbiter: Arbiter = smart_arbiter) -> Column:
    fields = []
    for name in ("title", "table_id"):
        v, r = F.coalesce(vision[name], F.lit("")), F.coalesce(rule[name], F.lit(""))
        differs = (v != "") & (r != "") & ~cells_match(v, r, tolerance)
        fields.append(F.when(differs, _conflict(F.lit(name), v, r, F.lit("low"), F.lit("text"), arbiter, F.lit(None), F.lit(name))))
    return F.filter(F.array(*fields), lambda c: c.isNotNull())


def verify_tables(pairs: DataFrame, tolerance: float = TOLERANCE, threshold: float = THRESHOLD, critical=CRITICAL, arbiter: str | Arbiter = "smart") -> DataFrame:
    """Adds conflicts, confidence, status, resolution_method and merged_rows to pairs with `vision` and `rule` tables.

    Both are structs with table_id, title, headers and rows (array of string maps); a null rule table
    is accepted as it is. Rows of `merged_rows` are those of vision with the resolutions applied.
    """
    arbiter = ARBITERS[arbiter] if isinstance(arbiter, str) else arbiter
    vision, rule = F.col("vision"), F.col("rule")
    none = F.array().cast(CONFLICT)
    every = F.concat(
        cell_conflicts(vision["rows"], rule["rows"], tolerance, critical, arbiter).cast(CONFLICT),
        header_conflicts(vision["headers"], rule["headers"], arbiter).cast(CONFLICT),
        metadata_conflicts(vision, rule, tolerance, arbiter).cast(CONFLICT),
    )
    out = once(pairs, "conflicts", F.coalesce(F.when(rule.isNotNull(), every), none))
    conflicts = F.col("conflicts")
    numbers = lambda c: F.struct(number_in(c["vision_value"]).alias("x"), number_in(c["rule_value"]).alias("y"))
    far = lambda n: F.coalesce(relative_difference(n["x"], n["y"]) > LARGE, F.lit(False))
    large = F.exists(F.transform(F.filter(conflicts, lambda c: c["severity"] == "critical"), numbers), far)
    out = out.withColumn("_raw", F.when(rule.isNull(), F.lit(VISION_ONLY)).otherwise(fold_confidence(F.transform(conflicts, lambda c: penalty(c["severity"]))))).withColumn("_large", large)
    raw = F.col("_raw")
    clean = rule.isNull() | (F.size(conflicts) == 0)
    status = F.when(clean, "verified").when(F.col("_large"), "needs_review").when(raw < threshold, "conflict").otherwise("verified")
    method = F.when(rule.isNull(), "vision_only").when(F.size(conflicts) == 0, "perfect_match").when(F.col("_large"), "manual_required").when(raw < threshold, "low_confidence").otherwise("auto_resolved")

    def merged(row: Column, mine: Column) -> Column:
        fresh = F.map_from_entries(F.transform(mine, lambda c: F.struct(c["key"].alias("key"), c["resolved_value"].alias("value"))))
        apply = lambda f: F.map_concat(F.map_filter(row, lambda k, _: ~F.map_contains_key(f, k)), f)
        return F.when(F.size(mine) > 0, bound(fresh, apply)).otherwise(row)

    def merged_rows(found: Column) -> Column:
        return F.transform(vision["rows"], lambda row, i: bound(F.filter(found, lambda c: c["row_idx"] == i), lambda mine: merged(row, mine)))

    return out.withColumns({"confidence": raw, "status": status, "resolution_method": method, "merged_rows": merged_rows(conflicts)}).drop("_raw", "_large")


def exploded_conflicts(verified: DataFrame) -> DataFrame:
    """One row for each conflict, in its order (`ord`)."""
    return verified.select("doc_id", F.posexplode("conflicts").alias("ord", "c")).select("doc_id", "ord", "c.*")


def paired_cells(pairs: DataFrame) -> DataFrame:
    """One row for each compared cell: doc_id, row_idx, key, vision_value, rule_value, parameter."""
    n = F.least(F.size("vision.rows"), F.size("rule.rows"))
    rows = F.zip_with(F.slice("vision.rows", F.lit(1), n), F.slice("rule.rows", F.lit(1), n), lambda v, r: F.struct(v.alias("v"), r.alias("r")))
    out = pairs.where("rule IS NOT NULL").select("doc_id", F.posexplode(rows).alias("row_idx", "p"))
    out = out.select("doc_id", "row_idx", "p", F.explode(F.array_union(F.map_keys("p.v"), F.map_keys("p.r"))).alias("key"))
    return out.select("doc_id", "row_idx", "key", cell(F.col("p.v"), F.col("key")).alias("vision_value"), cell(F.col("p.r"), F.col("key")).alias("rule_value"), cell(F.col("p.v"), F.lit("Parameter")).alias("parameter"))


def matched_cells(cells: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """Adds `matched` to rows of vision_value and rule_value, with each number read once and only where the texts differ."""
    a, b, x, y = (F.col(c) for c in ("vision_value", "rule_value", "_x", "_y"))
    ask = (a != b) & (a != "") & (b != "")
    read = cells.withColumns({"_x": F.when(ask, number_in(a)), "_y": F.when(ask, number_in(b))})
    matched = F.when(a == b, True).when((a == "") | (b == ""), False).when(close(x, y, tolerance), True).otherwise(units_match(a, b) | texts_match(a, b))
    return read.withColumn("matched", matched).drop("_x", "_y")


def verifier(arbiter: str | Arbiter = "smart", **settings) -> Callable[[DataFrame], DataFrame]:
    """A verification with its settings, to be applied to pairs of tables."""
    return lambda pairs: verify_tables(pairs, arbiter=arbiter, **settings)


def quick_verify(vision: DataFrame, rule: DataFrame | None = None) -> DataFrame:
    """Status and confidence of tables (doc_id and the struct `table`) read once or twice; a document without a second reading stands on its own."""
    if rule is None:
        kind = vision.schema["table"].dataType.simpleString()
        pairs = vision.select("doc_id", F.col("table").alias("vision"), F.lit(None).cast(kind).alias("rule"))
    else:
        pairs = vision.select("doc_id", F.col("table").alias("vision")).join(rule.select("doc_id", F.col("table").alias("rule")), "doc_id", "left")
    return verify_tables(pairs).select("doc_id", "status", "confidence")


def verifier_stats(verified: DataFrame) -> DataFrame:
    """Counters over a result table."""
    count = lambda s: F.count_if(F.col("status") == s)
    return verified.agg(
        F.count("*").alias("total_verifications"), count("verified").alias("verified"), count("conflict").alias("conflict"), count("needs_review").alias("needs_review"),
        F.sum(F.size("conflicts")).alias("total_conflicts_found"), F.sum(F.size(F.filter("conflicts", lambda c: c["resolution"].isNotNull()))).alias("conflicts_resolved"),
    )


def review_queue(verified: DataFrame) -> DataFrame:
    """Tables that wait for a person; those in conflict alone are not queued."""
    return verified.where("status = 'needs_review'")
