"""The queries of this subpackage and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from freshet.llm import bpe, content_sort, decontaminate, language_id, licenses, lm_score, minhash, records, sharding, webarchive

MODULES = (sharding, licenses, decontaminate, bpe, records, minhash, language_id, content_sort, webarchive, lm_score)


def queries() -> dict[str, Callable]:
    return {name: f for m in MODULES for name, f in vars(m).items() if name.startswith("op") and name[2:3].isdigit() and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in getattr(m, "ORACLE_SQL", {}).items()}
