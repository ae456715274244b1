"""Registry of oracle SQL strings, keyed like the Spark queries."""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLE_SQL[name] = sql


from oracle import o_clean, o_quality, o_rules, o_ml, o_advise  # noqa: E402,F401
