"""Topics and declarative rules.

Routes and rules are configuration: a few lines known before the job starts. They
are compiled to column expressions, so routing reads each event once and moves none.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions import templates
from tidelog.functions.patterns import all_of, any_of, discard_all, include_list, names_in
from tidelog.functions.templates import bind_sql, bound_value, evaluate

Routes = Sequence[tuple[str, str]]


def route_topic(routes: Routes, database: str = "Database", table: str = "Table") -> Column:
    """Topic of the first route whose include list passes; null if none does."""
    if not routes:
        return F.lit(None).cast("string")
    return F.coalesce(*[F.when(include_list(p, database, table), F.lit(topic)) for topic, p in routes])


def fan_out_topics(df: DataFrame, routes: Routes, database: str = "Database", table: str = "Table") -> DataFrame:
    """One row per topic whose include list passes."""
    topics = [F.when(include_list(p, database, table), F.lit(topic)) for topic, p in routes]
    return df.withColumn("topic", F.explode(F.array_compact(F.array(*topics))))


def drop_unrouted(df: DataFrame, topic: str = "topic") -> DataFrame:
    return df.filter(F.col(topic).isNotNull())


@dataclass(frozen=True)
class Transform:
    """Binds, a process of some kind, and maps."""

    kind: str | None = None
    process: str | None = None
    binds: tuple[tuple[str, str], ...] = ()
    maps: tuple[tuple[str, str], ...] = ()


@dataclass(frozen=True)
class Rule:
    """What to do with the events of a scope: every ``(test, transform)`` that holds, or else ``otherwise``."""

    database: str
    table: str
    type: str
    branches: tuple[tuple[str | None, Transform], ...] = ()
    otherwise: Transform | None = None


@dataclass
class Lookup:
    """Source of a ``resultset`` transform: its rows with ``on`` = {event data name: source column}."""

    source: DataFrame
    on: dict[str, str] = field(default_factory=dict)


def rule_matches(rules: Sequence[Rule]) -> list[Column]:
    """One predicate per rule over Database, Table and Type.

    A database named by any rule is served by its own rules only; ``*`` is for the others.
    """
    named = sorted({r.database for r in rules if r.database != "*"})
    db, table, kind = F.col("Database"), F.col("Table"), F.col("Type")
    return [
        all_of(
            ~names_in(db, named) if r.database == "*" else db == r.database,
            table == r.table,
            *([] if r.type == "*" else [kind == r.type]),
        )
        for r in rules
    ]


def route_rules(events: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per event and matching rule, with ``rule_no`` in rule order."""
    numbers = [F.when(match, F.lit(i)) for i, match in enumerate(rule_matches(rules))]
    return events.withColumn("rule_no", F.explode(F.array_compact(F.array(*numbers))))


def unsubscribed(events: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Events that no rule matches."""
    return events.filter(~any_of(*[F.coalesce(m, discard_all()) for m in rule_matches(rules)]))


def bind(df: DataFrame, name: str, value: str, when: Column | None = None, data: str = "Data") -> DataFrame:
    """``Data[name]`` set to a field's copy or an expression's value."""
    others = F.map_filter(data, lambda k, _: k != name)
    bound = F.map_concat(others, F.create_map(F.lit(name), bound_value(value, data)))
    return df.withColumn(data, bound if when is None else F.when(when, bound).otherwise(F.col(data)))


def map_output(
    df: DataFrame, maps: Sequence[tuple[str, str]], when: Column | None = None, data: str = "Data"
) -> DataFrame:
    """``Result`` made of the named values, unless there is one already, or rows of a look-up are to be it."""
    if not maps:
        return df
    if "Asked" in df.columns:
        free = F.col("Asked").isNull()
        when = free if when is None else free & when
    made = F.map_from_arrays(
        F.array(*[F.lit(name) for name, _ in dict(maps).items()]),
        F.array(*[bound_value(value, data) for value in dict(maps).values()]),
    )
    return df.withColumn("Result", F.coalesce("Result", made if when is None else F.when(when, made)))


def transform_kind(
    df: DataFrame, kind: str | None, process: str | None, when: Column | None = None, rule_no: int = 0, data: str = "Data"
) -> DataFrame:
    """``map`` does nothing, ``sql`` hands the text on as ``Transformer``, other kinds evaluate it as an expression.

    ``resultset`` leaves its bound SQL text in ``BoundSql``, and in ``Asked`` what the query was asked with: rule,
    text and the data as they are now, whatever later binds make of them. ``flows.apply_rule_set`` does the queries as joins.
    """
    if kind is None or kind == "map":
        return df
    if kind == "sql":
        name, value = "Transformer", F.lit(process)
    elif kind == "resultset":
        name, value = "BoundSql", bind_sql(process)
        if "Asked" in df.columns:
            ask = F.array(F.struct(F.lit(rule_no).alias("rule_no"), value.alias("sql"), F.col(data).alias("data")))
            more = F.concat(F.coalesce("Asked", F.array().cast(ASKED)), ask.cast(ASKED))
            df = df.withColumn("Asked", more if when is None else F.when(when, more).otherwise(F.col("Asked")))
    elif process:
        name, value = "Evaluated", evaluate(process).cast("string")
    else:
        return df
    return df.withColumn(name, value if when is None else F.when(when, value).otherwise(F.col(name)))


STATE = ("Result", "Transformer", "BoundSql", "Evaluated", "Asked")

CASES = 32  # steps of a fold that are told apart one by one

ASKED = "array<struct<rule_no:int,sql:string,data:map<string,string>>>"


def _with_state(df: DataFrame) -> DataFrame:
    kinds = {"Result": "map<string,string>", "Asked": ASKED}
    return df.withColumns(
        {c: F.lit(None).cast(kinds.get(c, "string")) for c in STATE if c not in df.columns}
    )


def _apply(df: DataFrame, t: Transform, when: Column, rule_no: int) -> DataFrame:
    for name, value in t.binds:
        df = bind(df, name, value, when)
    df = transform_kind(df, t.kind, t.process, when, rule_no)
    return map_output(df, t.maps, when)


def apply_if_else(df: DataFrame, rule: Rule, when: Column | None = None, rule_no: int = 0) -> DataFrame:
    """Branches of a rule in order, each on the data the earlier ones left; ``otherwise`` if no test held."""
    df = _with_state(df)
    scope = F.lit(True) if when is None else F.coalesce(when, F.lit(False))
    flags = []
    for i, (test, transform) in enumerate(rule.branches):
        holds = F.coalesce(evaluate(test).cast("boolean"), F.lit(False)) if test else F.lit(True)
        flags.append(f"_ran{i}")
        df = _apply(df.withColumn(flags[-1], scope & holds), transform, F.col(flags[-1]), rule_no)
    if rule.otherwise is not None:
        none_ran = reduce(lambda a, b: a & b, [~F.col(f) for f in flags], scope)
        df = _apply(df.withColumn("_else", none_ran), rule.otherwise, F.col("_else"), rule_no).drop("_else")
    return df.drop(*flags)


class _Steps:
    """Rules as numbered steps of one fold: what each step sets a field of the state ``s`` to."""

    def __init__(self) -> None:
        self.sets: dict[str, list[tuple[int, str]]] = {}
        self.count = 0

    def add(self, **fields: str) -> int:
        for name, value in fields.items():
            self.sets.setdefault(name, []).append((self.count, value))
        self.count += 1
        return self.count - 1

    def transform(self, t: Transform, rule_no: int) -> list[int]:
        """One step for each bind, so that later ones see what it left, one for the process and one for the maps."""
        made = []
        for name, value in t.binds:
            key = templates.text_literal(name)
            bound = f"map({key}, cast({templates.bound_value_text(value, 's.Data')} as string))"
            made.append(self.add(Data=f"if(s.on, map_concat(map_filter(s.Data, (k, v) -> k != {key}), {bound}), s.Data)"))
        if t.kind == "sql":
            made.append(self.add(Transformer=f"if(s.on, {templates.text_literal(t.process)}, s.Transformer)"))
        elif t.kind == "resultset":
            sql = templates.bound_sql_text(t.process, "s.Data")
            ask = f"cast(array(named_struct('rule_no', {rule_no}, 'sql', {sql}, 'data', s.Data)) as {ASKED})"
            asked = f"if(s.on, concat(coalesce(s.Asked, cast(array() as {ASKED})), {ask}), s.Asked)"
            made.append(self.add(BoundSql=f"if(s.on, {sql}, s.BoundSql)", Asked=asked))
        elif t.kind not in (None, "map") and t.process:
            value = f"cast({templates.expression_text(t.process, 's.Data')} as string)"
            made.append(self.add(Evaluated=f"if(s.on, {value}, s.Evaluated)"))
        if t.maps:
            names = ", ".join(templates.text_literal(name) for name in dict(t.maps))
            values = ", ".join(f"cast({templates.bound_value_text(v, 's.Data')} as string)" for v in dict(t.maps).values())
            mapped = f"if(s.on and s.Asked is null, map_from_arrays(array({names}), array({values})), null)"
            made.append(self.add(Result=f"coalesce(s.Result, {mapped})"))
        return made

    def rule(self, rule: Rule, rule_no: int) -> list[int]:
        """``on``: does the branch run; ``ran``: did any branch of the rule before this one."""
        made = []
        for i, (test, transform) in enumerate(rule.branches):
            holds = f"coalesce(cast(({templates.expression_text(test, 's.Data')}) as boolean), false)" if test else "true"
            made.append(self.add(on=holds, ran="s.ran or s.on" if i else "false"))
            made += self.transform(transform, rule_no)
        if rule.otherwise is not None:
            made.append(self.add(on="not (s.ran or s.on)" if rule.branches else "true"))
            made += self.transform(rule.otherwise, rule_no)
        return made

    def fold(self, steps: str) -> str:
        fields = ("Data", *STATE)
        start = ", ".join(f"'{f}', {f}" for f in fields) + ", 'on', false, 'ran', false"
        after = []
        for f in (*fields, "on", "ran"):
            # found in two stages, so that a step costs no comparison with all others
            parts = [list(part) for _, part in groupby(self.sets.get(f, []), lambda step: step[0] // CASES)]
            cases = [(p[0][0] // CASES, " ".join(f"when {n} then {value}" for n, value in p)) for p in parts]
            choice = " ".join(f"when {part} then case i {inner} else s.{f} end" for part, inner in cases)
            after.append(f"'{f}', " + (f"case i div {CASES} {choice} else s.{f} end" if choice else f"s.{f}"))
        return f"aggregate({steps}, named_struct({start}), (s, i) -> named_struct({', '.join(after)}))"


def apply_rules(events: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Every matching rule applied to its events, in rule order, on one pass over the events.

    The result is that of ``apply_if_else`` for one rule after the other. The rules become one fold over the steps of
    those that match an event: one expression that grows with the rules, and an event costs the steps of its own rules.
    """
    df, steps = _with_state(events), _Steps()
    numbers = [steps.rule(rule, i) for i, rule in enumerate(rules)]
    mine = [F.when(match, F.array(*map(F.lit, n))) for match, n in zip(rule_matches(rules), numbers) if n]
    if not mine:
        return df
    taken = df.withColumn("_steps", F.flatten(F.array_compact(F.array(*mine))))
    kept = [c for c in df.columns if c not in ("Data", *STATE)]
    folded = taken.select(*(F.col(f"`{c}`") for c in kept), F.expr(steps.fold("_steps")).alias("_state"))
    return folded.select(*(F.col(f"`{c}`") if c in kept else F.col("_state")[c].alias(c) for c in df.columns))
