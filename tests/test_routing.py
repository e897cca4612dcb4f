import random
import time

from pyspark.sql import functions as F
import pytest

from tidelog.functions import templates
from tidelog.operators import routing
from tidelog.operators.routing import Lookup, Rule, Transform
from tidelog.plans import flows
from tidelog.sources import rules as documents

ROUTES = [
    ("people", "shop1.person%,shop%.person,main.%"),
    ("trades", "east.%,west.%"),
    ("rest", "%.%"),
]


def test_first_route_wins(spark):
    pairs = [("shop1", "person_old"), ("shop9", "person"), ("main", "x"), ("east", "person"), ("west", "y"), ("other", "z")]
    df = spark.createDataFrame(pairs, "Database string, Table string")
    got = [r[0] for r in df.select(routing.route_topic(ROUTES)).collect()]
    assert got == ["people"] * 3 + ["trades"] * 2 + ["rest"]
    few = df.withColumn("topic", routing.route_topic(ROUTES[:2]))
    assert routing.drop_unrouted(few).count() == 5
    every = routing.fan_out_topics(df, ROUTES).groupBy("Database").count().collect()
    assert {r.Database: r["count"] for r in every} == {"shop1": 2, "shop9": 2, "main": 2, "east": 2, "west": 2, "other": 1}


XML = """<root>
  <event database="ledger" table="account" type="INSERT">
    <if test="#state=='open' &amp;&amp; #owner!=null">
      <transform type="map"><map name="key" value="#owner+'/'+#number"/></transform>
    </if>
    <if test="#state=='frozen'">
      <transform><bind name="note" value="'check '+#number"/><bind name="kept" value="state"/></transform>
    </if>
    <else><transform type="expr" process="#number+'!'"/></else>
  </event>
  <event database="*" table="account" type="*"><else><transform type="sql" process="audit.any"/></else></event>
  <event database="*" table="session" type="DELETE">
    <transform type="map"><map name="lost" value="number"/></transform>
    <if><transform type="resultset" process="select * from ${Database}.s where n = ${number}"/></if>
  </event>
</root>"""


@pytest.fixture(scope="module")
def rules(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("rules") / "rules.xml"
    path.write_text(XML)
    return documents.compile_rules(documents.rules_table(spark, str(path)))


def test_rules_from_a_document(rules):
    assert [(r.database, r.table, r.type, len(r.branches)) for r in rules] == [
        ("ledger", "account", "INSERT", 2), ("*", "account", "*", 0), ("*", "session", "DELETE", 1),
    ]
    assert rules[0].branches[1][1].binds == (("note", "'check '+#number"), ("kept", "state"))
    assert rules[0].otherwise.kind == "expr" and rules[1].otherwise.process == "audit.any"
    # a transform right under the event is not read
    assert rules[2].otherwise is None and rules[2].branches[0][1].maps == ()


def events(spark):
    def row(pos, db, table, kind, **data):
        return (pos, kind, db, table, data)

    return spark.createDataFrame(
        [
            row(1, "ledger", "account", "INSERT", number="7", state="open", owner="ann"),
            row(2, "ledger", "account", "INSERT", number="8", state="open", owner=None),
            row(3, "ledger", "account", "INSERT", number="9", state="frozen", owner="bo"),
            row(4, "ledger", "account", "DELETE", number="9"),
            row(5, "archive", "account", "DELETE", number="1"),
            row(6, "archive", "session", "DELETE", number="2", Database="archive"),
            row(7, "archive", "session", "delete", number="3"),
        ],
        "pos int, Type string, Database string, Table string, Data map<string,string>",
    )


def test_rules_applied(spark, rules):
    done = {r.pos: r for r in routing.apply_rules(events(spark), rules).collect()}
    assert done[1].Result == {"key": "ann/7"} and done[1].Evaluated is None
    assert done[2].Result is None and done[2].Evaluated == "8!"
    assert done[3].Data["note"] == "check 9" and done[3].Data["kept"] == "frozen" and done[3].Evaluated is None
    assert done[4].Transformer is None and done[5].Transformer == "audit.any"
    assert done[6].BoundSql == "select * from archive.s where n = 2" and done[7].BoundSql is None


def test_a_named_database_shadows_the_wildcard(spark, rules):
    matched = {(r.pos, r.rule_no) for r in routing.route_rules(events(spark), rules).collect()}
    assert matched == {(1, 0), (2, 0), (3, 0), (5, 1), (6, 2)}
    assert {r.pos for r in routing.unsubscribed(events(spark), rules).collect()} == {4, 7}


def test_first_result_stays_and_later_branches_see_binds(spark):
    rule = Rule(
        "*", "account", "*",
        branches=(
            ("#number=='7'", Transform(binds=(("x", "#number+'!'"),), maps=(("a", "x"),))),
            (None, Transform(binds=(("y", "#x+'?'"),), maps=(("a", "y"), ("b", "number")))),
        ),
        otherwise=Transform("sql", "never"),
    )
    done = {r.pos: r for r in routing.apply_if_else(events(spark), rule).collect()}
    assert done[1].Result == {"a": "7!"} and done[1].Data["y"] == "7!?"
    assert done[2].Result == {"a": None, "b": "8"} and done[2].Transformer is None


def test_lookups_are_asked_where_their_transform_ran(spark):
    rules = [
        Rule("*", "account", "*", branches=(("#state=='open'", Transform("resultset", "select * from ${Database}.c where id = ${number}", maps=(("_id", "number"),))), (None, Transform(binds=(("number", "#number+'0'"),))))),
        Rule("*", "account", "*", branches=(("#state=='frozen' || #number=='90'", Transform("resultset", "select * from ${Database}.o where owner = ${owner}")),)),
    ]
    first = spark.createDataFrame([(7, "seven"), (7, "seven"), (9, "nine"), (70, "seventy")], "cid int, name string")
    second = spark.createDataFrame([("bo", 1)], "who string, n int")
    for lookups in ({0: Lookup(first, {"number": "cid"}), 1: Lookup(second, {"owner": "who"})}, {1: Lookup(second, {"owner": "who"}), 0: Lookup(first, {"number": "cid"})}):
        done = flows.apply_rule_set(events(spark).where("Database = 'ledger'"), rules, lookups).collect()
        got = sorted((r.pos, r.rule_no, r.AskedSql, r.ResultRow) for r in done)
        seven = (1, 0, "select * from ${Database}.c where id = 7", '{"cid":7,"name":"seven"}')
        assert got == [
            seven, seven, (2, 0, "select * from ${Database}.c where id = 8", None),
            (3, 1, "select * from ${Database}.o where owner = bo", '{"who":"bo","n":1}'),
            (4, 1, "select * from ${Database}.o where owner = ${owner}", None),
        ]
        assert {r.Data["number"] for r in done if r.pos == 1} == {"70"}
        assert {r.Result for r in done if r.pos < 3} == {None}  # the rows found are the result, no map is
    asked_nothing = flows.apply_rule_set(events(spark).where("Table = 'session'"), rules)
    assert {(r.pos, r.rule_no, r.ResultRow) for r in asked_nothing.collect()} == {(6, None, None), (7, None, None)}


def test_templates(spark):
    with pytest.raises(ValueError):
        templates.bind_sql("select 1")
    for text in ("select $ts_start", "select $database", None):
        with pytest.raises(ValueError):
            templates.check_query_template(text)
    df = spark.createDataFrame([({"Database": "d", "a": "${b}", "b": "x"},)], "Data map<string,string>")
    assert df.select(templates.bind_sql("${Database}.${a}.${c}.$x")).first()[0] == "d.${b}.${c}.$x"
    at = F.lit("2016-08-18 12:01:02.120").cast("timestamp")
    sql = templates.render_query("$database '$ts_start' '$ts_end'", F.lit("d"), at, F.lit("2016-08-18 12:01:02").cast("timestamp"))
    assert df.select(sql).first()[0] == "d '2016-08-18 12:01:02.12' '2016-08-18 12:01:02.0'"
    open_end = templates.render_query("$database > '$ts_start'", F.lit("d"), at, F.lit(None).cast("timestamp"))
    assert df.select(open_end).first()[0] == "d > '2016-08-18 12:01:02.12'"
    assert df.select(templates.evaluate("#a!=null && #b=='x' && '#a == null' != #b")).first()[0] is True


def random_rule(draw):
    def transform():
        kind = draw.choice([None, "map", "sql", "resultset", "expr"])
        process = {"sql": "audit.it's", "resultset": "select '\\\\d' from ${Database}.t where n = ${number} and x = ${none}", "expr": "#state+'!'"}
        binds = [(draw.choice(["note", "state", "it's"]), draw.choice(["number", "#state+'/'+#number", "#note", "'x'+#owner", "none"])) for _ in range(draw.randrange(4))]
        maps = [(draw.choice(["a", "b"]), draw.choice(["note", "#state+#number", "it's"])) for _ in range(draw.randrange(3))]
        return Transform(kind, process.get(kind), tuple(binds), tuple(maps))

    tests = [None, "#state=='open'", "#note==null", "#note!=null && #state=='open'", "#owner=='x' || #number=='1'"]
    branches = tuple((draw.choice(tests), transform()) for _ in range(draw.randrange(4)))
    scope = draw.choice(["*", "ledger", "other"]), draw.choice(["account", "session"]), draw.choice(["*", "INSERT"])
    return Rule(*scope, branches, transform() if draw.randrange(2) else None)


def random_events(spark, draw):
    values = lambda: {k: draw.choice(["open", "1", "x", None]) for k in ("state", "owner", "number", "note") if draw.randrange(4)}
    rows = [(i, draw.choice(["ledger", "other", "third", None]), draw.choice(["account", "session"]), draw.choice(["INSERT", "DELETE"]), values() if i else None) for i in range(60)]
    return spark.createDataFrame(rows, "pos int, Database string, Table string, Type string, Data map<string,string>")


def test_all_rules_at_once_do_what_each_does_after_the_other(spark):
    draw = random.Random(8)
    for _ in range(6):
        rules = [random_rule(draw) for _ in range(draw.randrange(1, 5))]
        df = random_events(spark, draw)
        slow = routing._with_state(df).withColumns({f"_m{i}": m for i, m in enumerate(routing.rule_matches(rules))})
        for i, rule in enumerate(rules):
            slow = routing.apply_if_else(slow, rule, F.col(f"_m{i}"), i)
        fast = routing.apply_rules(df, rules)
        assert fast.columns == slow.drop(*[f"_m{i}" for i in range(len(rules))]).columns
        plain = lambda d: {r.pos: r.asDict(True) for r in d.select(*fast.columns).collect()}
        assert plain(fast) == plain(slow), rules


def test_many_rules_are_planned_quickly(spark):
    draw = random.Random(9)
    rules = [random_rule(draw) for _ in range(200)]
    start = time.monotonic()
    done = routing.apply_rules(random_events(spark, draw), rules)
    done._jdf.queryExecution().executedPlan()
    assert time.monotonic() - start < 10
    assert done.count() == 60
    assert routing.apply_rules(random_events(spark, draw), []).count() == 60
