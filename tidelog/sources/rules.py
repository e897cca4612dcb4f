"""Rule documents (XML) to rule rows and to compiled rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators.routing import Rule, Transform

_ITEM = "array<struct<_name:string,_value:string>>"
_TRANSFORM = f"struct<_type:string,_process:string,bind:{_ITEM},map:{_ITEM}>"
EVENT = (
    "_database string, _table string, _type string, "
    f"`if` array<struct<_test:string,transform:{_TRANSFORM}>>, `else` struct<transform:{_TRANSFORM}>"
)


def _branches() -> Column:
    """All branches of an event in order; ``else`` comes last and has no test."""
    branch = "array<struct<kind:string,test:string,transform:" + _TRANSFORM + ">>"
    ifs = F.transform(
        F.coalesce(F.col("if"), F.array()),
        lambda b: F.struct(F.lit("if").alias("kind"), b["_test"].alias("test"), b["transform"].alias("transform")),
    ).cast(branch)
    otherwise = F.when(
        F.col("else").isNotNull(),
        F.array(
            F.struct(
                F.lit("else").alias("kind"), F.lit(None).cast("string").alias("test"), F.col("else.transform").alias("transform")
            )
        ),
    ).otherwise(F.array())
    return F.concat(ifs, otherwise.cast(branch))


def _items() -> Column:
    item = "array<struct<item:string,name:string,value:string>>"

    def named(kind: str) -> Column:
        return F.transform(
            F.coalesce(F.col(f"branch.transform.{kind}"), F.array()),
            lambda i: F.struct(F.lit(kind).alias("item"), i["_name"].alias("name"), i["_value"].alias("value")),
        ).cast(item)

    return F.concat(named("bind"), named("map"))


def flatten_rules(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per (event, branch, item) of parsed event elements; what lies directly under an event is not read."""
    branches = events.select(
        *keep,
        F.col("_database").alias("database"),
        F.col("_table").alias("table"),
        F.col("_type").alias("type"),
        F.posexplode_outer(_branches()).alias("branch_no", "branch"),
    )
    return branches.select(
        *keep,
        "database",
        "table",
        "type",
        "branch_no",
        F.col("branch.kind").alias("branch"),
        F.col("branch.test").alias("test"),
        F.col("branch.transform._type").alias("transform_type"),
        F.col("branch.transform._process").alias("process"),
        F.posexplode_outer(_items()).alias("item_no", "_item"),
    ).select("*", "_item.item", "_item.name", "_item.value").drop("_item")


def rules_table(spark: SparkSession, path: str) -> DataFrame:
    """Rule rows of XML documents at ``path``, numbered by ``event_no`` in reading order."""
    events = spark.read.format("xml").option("rowTag", "event").schema(EVENT).load(path)
    return flatten_rules(events.withColumn("event_no", F.monotonically_increasing_id()), ["event_no"])


def parse_rules(df: DataFrame, xml: str, keep: Sequence[str]) -> DataFrame:
    """Rule rows of event elements held as text in a column."""
    parsed = df.select(*keep, F.from_xml(xml, EVENT).alias("_e"))
    return flatten_rules(parsed.select(*keep, "_e.*"), keep)


def compile_rules(rows: DataFrame) -> list[Rule]:
    """Rules for the routing operators out of a rule table; rules are configuration and few."""
    events: dict[int, dict] = {}
    for r in sorted(rows.collect(), key=lambda r: (r.event_no, r.branch_no or 0, r.item_no or 0)):
        event = events.setdefault(r.event_no, {"scope": (r.database, r.table, r.type), "branches": {}})
        if r.branch_no is None:
            continue
        branch = event["branches"].setdefault(
            r.branch_no,
            {"kind": r.branch, "test": r.test, "type": r.transform_type, "process": r.process, "bind": [], "map": []},
        )
        if r.item is not None:
            branch[r.item].append((r.name, r.value))
    rules = []
    for event in events.values():
        made = [
            (b, Transform(b["type"], b["process"], tuple(b["bind"]), tuple(b["map"])))
            for _, b in sorted(event["branches"].items())
        ]
        rules.append(
            Rule(
                *event["scope"],
                branches=tuple((b["test"], t) for b, t in made if b["kind"] == "if"),
                otherwise=next((t for b, t in made if b["kind"] == "else"), None),
            )
        )
    return rules
