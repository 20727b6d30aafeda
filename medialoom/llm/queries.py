"""Queries of the training-data operators and, where SQL can express them, their twins."""

from __future__ import annotations

from importlib import import_module

#: Query name -> (module, function); modules load when a query is first used.
_NAMED = {
    "op1_quality_rules": ("quality", "op1"),
    "op2_recurrent_lm": ("recurrent_lm", "op2"),
    "op3_license_scan": ("licenses", "op3"),
    "op4_simhash_near_dedup": ("simhash", "op4"),
    "op5_warc_archive": ("warc", "op5"),
    "op6_piece_fst": ("piece_fst", "op6"),
    "op7_decontamination": ("decontaminate", "op7"),
    "op8_token_counts": ("token_counts", "op8"),
    "op9_substring_dedup": ("substring", "op9"),
    "op10_chat_formatting": ("chat", "op10"),
}


def _late(module: str, function: str):
    def run(spark, sf_dir):
        return getattr(import_module(f"medialoom.llm.{module}"), function)(spark, sf_dir)

    return run


QUERIES = {name: _late(*where) for name, where in _NAMED.items()}


def oracles() -> dict[str, str]:
    out = {}
    for name, (module, _) in _NAMED.items():
        sql = getattr(import_module(f"medialoom.llm.{module}"), "ORACLE_SQL", None)
        if sql:
            out[name] = sql
    return out
