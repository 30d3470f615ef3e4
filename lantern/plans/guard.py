"""What a statement is, and what it may not do, told from Catalyst's unresolved plan."""

from __future__ import annotations

import json
import re
from typing import Any

from pyspark.errors import PySparkException

from lantern.errors import LanternError
from lantern.params import tokens

KINDS = {"SELECT": "query", "WITH": "query", "VALUES": "query", "(": "query", "FROM": "query", "INSERT": "insert", "UPDATE": "update", "DELETE": "delete", "CREATE": "create", "DROP": "drop"}
RANKS = {"row_number", "rank", "dense_rank"}
MOST_JOINS = 3


def kind(sql: str) -> str:
    for k, text, _ in tokens(sql):
        if k == "comment" or text.isspace():
            continue
        return KINDS.get(text.upper(), "other")
    raise LanternError("E5", "empty statement")


def parse(spark, sql: str):
    """Catalyst's plan of the text; E5 if it can't be parsed."""
    try:
        return spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    except Exception as e:
        raise LanternError("E5", cause=e) from e


def _nodes(x: Any):
    if isinstance(x, dict):
        if "class" in x:
            yield x
        for v in x.values():
            yield from _nodes(v)
    elif isinstance(x, list):
        for v in x:
            yield from _nodes(v)


def _name(node: dict) -> str:
    return node["class"].rsplit(".", 1)[-1]


def check(plan, profile: str = "extended") -> None:
    """strict: E2 for what lies beyond the documented subset. extended: everything Spark runs."""
    if profile != "strict":
        return
    nodes = list(_nodes(json.loads(plan.toJSON())))
    joins = [n for n in nodes if _name(n) == "Join"]
    for n in joins:
        how = json.dumps(n.get("joinType"))
        if not re.search(r"Inner|LeftOuter", how) or "Natural" in how or "Using" in how:
            raise LanternError("E2", "JOIN")
        on = n.get("condition")
        if not on:
            raise LanternError("E2", "JOIN_ON")
        parts = {_name(x) for x in _nodes(on)}
        if not parts <= {"EqualTo", "And", "UnresolvedAttribute"}:
            raise LanternError("E2", "JOIN_ON")
    if len(joins) > MOST_JOINS:
        raise LanternError("E2", "JOIN_DEPTH")
    names = [_name(n) for n in nodes]
    if "Distinct" in names and "Union" in names:
        raise LanternError("E2", "UNION DISTINCT")
    if {"Intersect", "Except", "MergeIntoTable"} & set(names):
        raise LanternError("E2", "STATEMENT")
    windows = [n for n in nodes if _name(n) in ("UnresolvedWindowExpression", "WindowExpression")]
    if windows:
        if joins or "Aggregate" in names:
            raise LanternError("E2", "WINDOW_FUNCTION")
        text = plan.toString().lower()
        called = {m for m in re.findall(r"'?([a-z_]+)\([^()]*\)\s*windowspecdefinition", text)}
        if called - RANKS:
            raise LanternError("E2", "WINDOW_FUNCTION")


def always(spark, where: str, args: dict) -> bool:
    """Whether a condition holds whatever the row, as TRUE or 1 = 1 do: it names no column and is true."""
    names = {_name(n) for n in _nodes(json.loads(parse(spark, f"SELECT ({where})").toJSON()))}
    if any(n.startswith("UnresolvedAttribute") or "Subquery" in n or n in ("Exists", "ListQuery") for n in names):
        return False
    try:
        return bool(spark.sql(f"SELECT coalesce(CAST(({where}) AS BOOLEAN), false)", args=args).first()[0])
    except PySparkException:
        return False


def of_analysis(e: Exception) -> LanternError:
    """Spark's error as one of ours."""
    text = str(e)
    if "UNBOUND_SQL_PARAMETER" in text:
        return LanternError("E4", cause=e)
    if "PARSE_SYNTAX_ERROR" in text:
        return LanternError("E5", cause=e)
    condition = re.search(r"\[([A-Z_.]+)\]", text)
    return LanternError("E2", condition[1] if condition else text.splitlines()[0][:200], e)
