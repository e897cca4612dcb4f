"""Declarative rules and SQL templates."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check, notices, over, table, with_changelog
from tidelog.functions import templates
from tidelog.operators import routing
from tidelog.operators.routing import Lookup, Rule, Transform
from tidelog.plans import flows
from tidelog.sources import rules as documents

SCOPES = [
    Rule("*", "click", "*"),
    Rule("*", "view", "INSERT"),
    Rule("db1", "click", "UPDATE"),
    Rule("db1", "purchase", "*"),
    Rule("*", "click", "DELETE"),
    Rule("shop", "signup", "delete"),
]

MATCHED = (
    "select pos, 0 as rule_no from changelog where db not in ('db1', 'shop') and tbl = 'click' "
    "union all select pos, 1 from changelog where db not in ('db1', 'shop') and tbl = 'view' and type = 'INSERT' "
    "union all select pos, 2 from changelog where db = 'db1' and tbl = 'click' and type = 'UPDATE' "
    "union all select pos, 3 from changelog where db = 'db1' and tbl = 'purchase' "
    "union all select pos, 4 from changelog where db not in ('db1', 'shop') and tbl = 'click' and type = 'DELETE'"
)


@check("e6_route_rules", with_changelog(MATCHED))
def route_rules(spark, d):
    return routing.route_rules(notices(spark, d), SCOPES).select("pos", "rule_no")


@check(
    "e7_unsubscribed",
    with_changelog(f"select pos, db, tbl from changelog where pos not in (select pos from ({MATCHED}))"),
)
def unsubscribed(spark, d):
    rest = routing.unsubscribed(notices(spark, d), SCOPES)
    return rest.select("pos", F.col("Database").alias("db"), F.col("Table").alias("tbl"))


def full_events(spark, d):
    """Full-mode events: images hold the user, the shop, sometimes a nick and the database."""
    return notices(spark, d).select(
        "pos",
        "Type",
        "Database",
        "Table",
        F.create_map(
            F.lit("Database"),
            F.col("Database"),
            F.lit("user"),
            F.col("user_id").cast("string"),
            F.lit("shop"),
            F.concat(F.lit("s"), (F.col("user_id") % 7).cast("string")),
            F.lit("nick"),
            F.when(F.col("pos") % 3 != 0, F.concat(F.lit("n"), (F.col("pos") % 10).cast("string"))),
        ).alias("Data"),
    )


IMAGE = "concat('s', user_id % 7) as shop, case when pos % 3 <> 0 then concat('n', pos % 10) end as nick, cast(user_id as varchar) as usr"

BRANCHES = Rule(
    "*",
    "click",
    "*",
    branches=(
        ("#nick==null", Transform("map", binds=(("nick", "'guest-'+#user"), ("path", "#user+'?'")), maps=(("_id", "#shop+#nick"),))),
        ("#shop=='s1' && #nick!=null", Transform(binds=(("path", "#nick+'!'"),), maps=(("_id", "path"), ("who", "user")))),
        ("#shop=='s2' || #shop=='s1'", Transform(binds=(("path", "#path+'+'"),), maps=(("_id", "'late'+#shop"),))),
    ),
    otherwise=Transform("sql", "select * from t", binds=(("path", "#shop+'-else'"),)),
)


@check(
    "r4_if_else",
    with_changelog(
        "select pos, nick2 as nick, case when b3 and (b1 or b2) then concat(path, '+') when b3 then null else path end as path, "
        "case when b1 then concat(shop, nick2) when b2 then path when b3 then concat('late', shop) end as _id, "
        "case when b2 and not b1 then usr end as who, case when not (b1 or b2 or b3) then 'select * from t' end as transformer from ("
        "select *, case when b2 then concat(nick2, '!') when b1 then concat(usr, '?') when not b3 then concat(shop, '-else') end as path from ("
        "select *, nick is null as b1, shop = 's1' as b2, shop in ('s1', 's2') as b3, coalesce(nick, concat('guest-', usr)) as nick2 "
        f"from (select pos, {IMAGE} from changelog)))"
    ),
)
def if_else(spark, d):
    done = routing.apply_if_else(full_events(spark, d), BRANCHES)
    return done.select(
        "pos",
        F.col("Data")["nick"].alias("nick"),
        F.col("Data")["path"].alias("path"),
        F.col("Result")["_id"].alias("_id"),
        F.col("Result")["who"].alias("who"),
        F.col("Transformer").alias("transformer"),
    )


@check(
    "r5_bind",
    with_changelog(f"select pos, usr as copied, concat(shop, '/', usr) as joined, concat(shop, '/', usr, usr) as later from (select pos, {IMAGE} from changelog)"),
)
def bind(spark, d):
    df = full_events(spark, d)
    for name, value in (("copied", "user"), ("joined", "#shop+'/'+#copied"), ("later", "#joined+#user")):
        df = routing.bind(df, name, value)
    return df.select("pos", *[F.col("Data")[c].alias(c) for c in ("copied", "joined", "later")])


@check(
    "r6_map_output",
    with_changelog(
        f"select pos, case when pos % 2 = 0 then usr else concat(usr, shop) end as _id, case when pos % 2 = 0 then null else nick end as nick "
        f"from (select pos, {IMAGE} from changelog)"
    ),
)
def map_output(spark, d):
    df = full_events(spark, d).withColumn(
        "Result", F.when(F.col("pos") % 2 == 0, F.create_map(F.lit("_id"), F.col("Data")["user"]))
    )
    mapped = routing.map_output(df, [("_id", "#user+#shop"), ("nick", "nick")])
    return mapped.select("pos", F.col("Result")["_id"].alias("_id"), F.col("Result")["nick"].alias("nick"))


KINDS = [
    Rule("*", "click", "*", branches=((None, Transform("sql", "customer.select")),)),
    Rule("*", "view", "*", branches=((None, Transform("resultset", "select * from ${Database}.c where id = ${user}")),)),
    Rule("*", "signup", "*", branches=((None, Transform("map", maps=(("_id", "user"),))),)),
    Rule("*", "error", "*", branches=((None, Transform("expr", "#user+'?'")),)),
]


@check(
    "r7_transform_kinds",
    with_changelog(
        "select pos, case when tbl = 'click' then 'customer.select' end as transformer, case when tbl = 'view' then "
        "concat('select * from ', db, '.c where id = ', user_id) end as bound_sql, case when tbl = 'signup' then cast(user_id as varchar) end as _id, "
        "case when tbl = 'error' then concat(user_id, '?') end as evaluated from changelog"
    ),
)
def transform_kinds(spark, d):
    done = routing.apply_rules(full_events(spark, d), KINDS)
    return done.select(
        "pos",
        F.col("Transformer").alias("transformer"),
        F.col("BoundSql").alias("bound_sql"),
        F.col("Result")["_id"].alias("_id"),
        F.col("Evaluated").alias("evaluated"),
    )


@check(
    "r8_bind_sql",
    with_changelog(
        f"select pos, concat('select ', usr, ' from ', db, '.t where n = ', coalesce(nick, '${{nick}}'), ' and x = ${{gone}}') as sql_text "
        f"from (select pos, db, {IMAGE} from changelog)"
    ),
)
def bind_sql(spark, d):
    text = templates.bind_sql("select ${user} from ${Database}.t where n = ${nick} and x = ${gone}")
    return full_events(spark, d).select("pos", text.alias("sql_text"))


@check(
    "r9_expressions",
    with_changelog(
        f"select pos, nick is null as no_nick, concat(shop, usr, 'a+b#c') as joined, shop = 's1' and nick is not null or shop = 's2' as test "
        f"from (select pos, {IMAGE} from changelog)"
    ),
)
def expressions(spark, d):
    return full_events(spark, d).select(
        "pos",
        templates.evaluate("#nick==null").alias("no_nick"),
        templates.evaluate("#shop+#user+'a+b#c'").alias("joined"),
        templates.evaluate("#shop=='s1' && #nick!=null || #shop=='s2'").alias("test"),
    )


RULE_TEXTS = (
    "select c_custkey, concat('<event database=\"', case when c_custkey % 4 = 0 then '*' else concat('db', c_nationkey) end, "
    "'\" table=\"', c_mktsegment, '\" type=\"update\"><if test=\"#id==', c_custkey, '\"><transform type=\"map\">"
    "<bind name=\"nick\" value=\"#id+1\"/><map name=\"_id\" value=\"shop\"/></transform></if>', "
    "case when c_custkey % 2 = 0 then '<if><transform process=\"p.sql\" type=\"sql\"/></if>' else '' end, "
    "case when c_custkey % 3 = 0 then '<else><transform><map name=\"a\" value=\"b\"/><map name=\"c\" value=\"d\"/></transform></else>' else '' end, "
    "'<transform type=\"lost\"><map name=\"x\" value=\"y\"/></transform></event>') as xml from {customer}"
)

_SCOPE = "c_custkey, case when c_custkey % 4 = 0 then '*' else concat('db', c_nationkey) end as database, c_mktsegment as \"table\", 'update' as type"
_N_IF = "(1 + case when c_custkey % 2 = 0 then 1 else 0 end)"


@check(
    "r3_rules_table",
    f"select {_SCOPE}, 0 as branch_no, 'if' as branch, concat('#id==', c_custkey) as test, 'map' as transform_type, cast(null as varchar) as process, "
    "0 as item_no, 'bind' as item, 'nick' as name, '#id+1' as value from customer "
    f"union all select {_SCOPE}, 0, 'if', concat('#id==', c_custkey), 'map', null, 1, 'map', '_id', 'shop' from customer "
    f"union all select {_SCOPE}, 1, 'if', null, 'sql', 'p.sql', null, null, null, null from customer where c_custkey % 2 = 0 "
    f"union all select {_SCOPE}, {_N_IF}, 'else', null, null, null, 0, 'map', 'a', 'b' from customer where c_custkey % 3 = 0 "
    f"union all select {_SCOPE}, {_N_IF}, 'else', null, null, null, 1, 'map', 'c', 'd' from customer where c_custkey % 3 = 0",
)
def rules_table(spark, d):
    """One rule document per customer, read into rule rows."""
    return documents.parse_rules(over(spark, d, RULE_TEXTS, "customer"), "xml", ["c_custkey"])


@check(
    "rules_with_lookup",
    with_changelog(
        "select pos, case when db = 'db1' and tbl = 'click' then case when c.c_custkey is null then '[]' else concat('[{\"c_custkey\":', "
        "c.c_custkey, ',\"c_mktsegment\":\"', c.c_mktsegment, '\"}]') end end as rows_found, "
        "case when db <> 'db1' and tbl = 'click' then cast(user_id as varchar) end as _id "
        "from changelog left join customer c on c.c_custkey = user_id"
    ),
)
def rules_with_lookup(spark, d):
    """A wildcard rule that maps, shadowed for one database by a rule that looks customers up."""
    rules = [
        Rule("*", "click", "*", branches=((None, Transform("map", maps=(("_id", "user"),))),)),
        Rule("db1", "click", "*", branches=((None, Transform("resultset", "select * from ${Database}.customer where c_custkey = ${user}")),)),
    ]
    customers = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    done = flows.apply_rule_set(full_events(spark, d), rules, {1: Lookup(customers, {"user": "c_custkey"})})
    rows = F.when(F.col("rule_no").isNotNull(), F.concat(F.lit("["), F.coalesce("ResultRow", F.lit("")), F.lit("]")))
    return done.select("pos", rows.alias("rows_found"), F.col("Result")["_id"].alias("_id"))


@check(
    "rules_with_two_lookups",
    with_changelog(
        f"with_image as (select pos, db, tbl, user_id, {IMAGE} from changelog), "
        "asks as (select pos, 0 as rule_no, concat('select * from ', db, '.orders where o_custkey = ', usr) as asked_sql, user_id from with_image "
        "where tbl = 'click' and shop in ('s1', 's4') union all select pos, 1, concat('select * from ', db, '.customer where c_custkey = ', usr, case when shop in ('s1', 's4') then '0' else '' end), "
        "case when shop in ('s1', 's4') then user_id * 10 else user_id end from with_image where tbl = 'click' and nick is null) "
        "select e.pos, a.rule_no, a.asked_sql, case when a.rule_no = 0 then o.o_orderstatus else c.c_mktsegment end as found, "
        "case when e.tbl = 'click' and e.shop in ('s1', 's4') then concat(e.usr, '?') else e.usr end as usr, "
        "case when e.tbl = 'click' and a.rule_no is null then concat(e.shop, '!') end as _id "
        "from with_image e left join asks a on a.pos = e.pos left join orders o on a.rule_no = 0 and o.o_custkey = a.user_id "
        "left join customer c on a.rule_no = 1 and c.c_custkey = a.user_id "
    ).replace(") with_image as", "), with_image as"),
)
def rules_with_two_lookups(spark, d):
    """Two rules whose tests differ look up different tables; a later bind changes the key, and a key owns many rows, some of them equal."""
    rules = [
        Rule("*", "click", "*", branches=((None, Transform(binds=(("key", "user"),))), ("#shop=='s1' || #shop=='s4'", Transform("resultset", "select * from ${Database}.orders where o_custkey = ${key}", binds=(), maps=(("_id", "user"),))), ("#shop=='s1' || #shop=='s4'", Transform(binds=(("key", "#key+'0'"), ("user", "#user+'?'")))))),
        Rule("*", "click", "*", branches=(("#nick==null", Transform("resultset", "select * from ${Database}.customer where c_custkey = ${key}")), (None, Transform("map", maps=(("_id", "#shop+'!'"),))))),
    ]
    orders = table(spark, d, "orders").select("o_custkey", "o_orderstatus")
    customers = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    done = flows.apply_rule_set(full_events(spark, d), rules, {0: Lookup(orders, {"key": "o_custkey"}), 1: Lookup(customers, {"key": "c_custkey"})})
    found = F.from_json("ResultRow", "o_orderstatus string, c_mktsegment string")
    return done.select(
        "pos",
        "rule_no",
        F.col("AskedSql").alias("asked_sql"),
        F.coalesce(found["o_orderstatus"], found["c_mktsegment"]).alias("found"),
        F.col("Data")["user"].alias("usr"),
        F.col("Result")["_id"].alias("_id"),
    )
