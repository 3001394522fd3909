"""The queries of this subpackage and their SQL."""

import importlib

#: Module and function of each query.
QUERIES = {
    "op1_licenses": "licenses",
    "op2_repetition": "repetition",
    "op3_mix_pivotal": "mixing",
    "op4_lm_difference": "lm",
    "op5_pack_curve": "packing",
    "op6_jaccard": "jaccard",
    "op7_ogg": "ogg",
    "op8_warc": "warc",
    "op9_passages": "substrings",
    "op10_language": "language",
}


def _late(module: str, name: str):
    def query(spark, sf_dir: str):
        return getattr(importlib.import_module(f"{__package__}.{module}"), name)(spark, sf_dir)

    query.__name__ = name
    return query


def queries() -> dict:
    return {name: _late(module, name) for name, module in QUERIES.items()}


#: Module and constant of each SQL.
SQL = {"op1_licenses": ("licenses", "OP1_SQL"), "op8_warc": ("warc", "OP8_SQL")}


def oracle_sql() -> dict[str, str]:
    return {name: getattr(importlib.import_module(f"{__package__}.{module}"), constant) for name, (module, constant) in SQL.items()}
