"""SQL text templates and small rule expressions as columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelog.functions.patterns import _as_column


def bind_sql(template: str, data: Column | str = "Data") -> Column:
    """``${name}`` filled from a text map, in one pass; names without a value stay as they are."""
    if "${Database}" not in template:
        raise ValueError("SQL without '${Database}' is not allowed")
    values = _as_column(data)
    parts = []
    for literal, name in re.findall(r"((?:(?!\$\{\w+\}).)+)|\$\{(\w+)\}", template, re.S):
        parts.append(F.lit(literal) if literal else F.coalesce(values[name], F.lit("${" + name + "}")))
    return F.concat(*parts)


def timestamp_text(ts: Column | str) -> Column:
    """Timestamp to the millisecond, trailing zeros cut but for one."""
    text = F.date_format(_as_column(ts), "yyyy-MM-dd HH:mm:ss.SSS")
    return F.regexp_replace(text, r"(\.\d+?)0+$", "$1")


def check_query_template(template: str) -> str:
    for name in ("$ts_start", "$database"):
        if name not in (template or ""):
            raise ValueError(f"{name!r} is required in the query template")
    return template


def render_query(template: str, database: Column | str, ts_start: Column | str, ts_end: Column | str) -> Column:
    """Template with ``$database``, ``$ts_start`` and ``$ts_end`` replaced, in this order; an open end stays unreplaced."""
    text = F.lit(check_query_template(template))
    text = F.replace(text, F.lit("$database"), _as_column(database))
    text = F.replace(text, F.lit("$ts_start"), timestamp_text(ts_start))
    return F.replace(text, F.lit("$ts_end"), F.coalesce(timestamp_text(ts_end), F.lit("$ts_end")))


# Signs of rule expressions and what they are in SQL.
SIGNS = {"&&": "AND", "||": "OR", "==": "=", "+": "||"}


def text_literal(text: str | None) -> str:
    """A text as it stands in SQL; ``${`` is written so that no setting is put in its place."""
    if text is None:
        return "cast(null as string)"
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'").replace("${", "\\u0024{") + "'"


def bound_sql_text(template: str, data: str = "Data") -> str:
    """What ``bind_sql`` makes, as the text of a SQL expression."""
    if "${Database}" not in template:
        raise ValueError("SQL without '${Database}' is not allowed")
    parts = []
    for literal, name in re.findall(r"((?:(?!\$\{\w+\}).)+)|\$\{(\w+)\}", template, re.S):
        value = f"coalesce({data}[{text_literal(name)}], {text_literal('${' + name + '}')})"
        parts.append(text_literal(literal) if literal else value)
    return f"concat({', '.join(parts)})"


def evaluate(expression: str, data: str = "Data") -> Column:
    """Rule expression over a text map: ``#x`` is the value of ``x``, ``+`` joins texts."""
    return F.expr(expression_text(expression, data))


def expression_text(expression: str, data: str = "Data") -> str:
    """A rule expression as the text of a SQL expression."""
    sql = []
    for quoted, null_test, name, sign, other in re.findall(
        r"('[^']*'|\"[^\"]*\")|([!=]=\s*null\b)|#(\w+)|(&&|\|\||==|\+)|(.)", expression, re.S
    ):
        if quoted:
            sql.append(quoted)
        elif null_test:
            sql.append(" IS NULL" if null_test[0] == "=" else " IS NOT NULL")
        elif name:
            sql.append(f"{data}['{name}']")
        else:
            sql.append(f" {SIGNS[sign]} " if sign else other)
    return "".join(sql)


def bound_value(value: str, data: str = "Data") -> Column:
    """Value of a bind or map: a field name, or an expression if it has a ``#``."""
    return evaluate(value, data) if "#" in value else F.col(data)[value]


def bound_value_text(value: str, data: str = "Data") -> str:
    """What ``bound_value`` makes, as the text of a SQL expression."""
    return expression_text(value, data) if "#" in value else f"{data}[{text_literal(value)}]"
