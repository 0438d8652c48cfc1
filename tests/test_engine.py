"""The document engine: SQL counterparts of its queries, versions, store and rules."""

import duckdb
import pytest
from pyspark.sql import functions as F

from lexloom import plans
from lexloom.operators import dq, runs, silver
from lexloom.tables import TableStore


def norm(v):
    if isinstance(v, float):
        return f"{v:.9g}"
    return float(v) if hasattr(v, "quantize") else v


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(plans.SQL))
def test_query_equals_sql(spark, sf, duck, name):
    df = plans.QUERIES[name](spark, sf)
    r = duck.execute(plans.SQL[name])
    cols = [d[0] for d in r.description]
    assert sorted(df.columns) == sorted(cols)
    want = sorted(repr([norm(x) for x in row]) for row in r.fetchall())
    assert sorted(repr([norm(x) for x in row]) for row in df.select(*cols).collect()) == want


DOC = b"""<r:regulation xmlns:r="urn:r" xmlns:x="urn:x"><title>Harbour</title><content>
<part><num>2</num><text>Care</text><division><num>1</num><text>Safety</text>
<section><marginalnote>Drills</marginalnote><num>13</num><text>A drill is held <link x:href="/legislation/a_01">once a month</link>.</text><hnote>[en. 2022]</hnote></section>
<section><marginalnote>Access</marginalnote><num>12</num><subsection><num>1</num><text>Repealed. [2001]</text></subsection><subsection><num>2</num><text>A person must</text><paragraph><num>a</num><text>give access</text></paragraph></subsection></section>
</division></part><section><marginalnote>Not in force</marginalnote><num>15</num><text>[Not in force.]</text></section>
<section><marginalnote>Repealed</marginalnote><num>30-31</num><hnote>[rep. 2001]</hnote></section>
<conseqhead><section><num>99</num></section></conseqhead>
<schedule><scheduletitle>Schedule A</scheduletitle><section><num>1</num><table><tgroup><thead><trow><entry>Item</entry><entry>Persons</entry></trow></thead><tbody><trow><entry>1</entry><entry>1 to 10</entry></trow></tbody></tgroup></table></section></schedule>
</content></r:regulation>"""


def test_store_conforms_and_merges(spark, tmp_path):
    store = TableStore(spark, f"file://{tmp_path}/lake")
    assert store.read("ops.watermarks").count() == 0
    runs.set_mark(store, "s", "x", "1", "r")
    runs.set_mark(store, "s", "x", "2", "r")
    assert runs.mark(store, "s", "x") == "2" and store.read("ops.watermarks").count() == 1
    with pytest.raises(ValueError, match="not in catalog"):
        store.append("ops.watermarks", store.read("ops.watermarks").selectExpr("*", "1 extra"))
    with pytest.raises(ValueError, match="missing"):
        store.append("ops.watermarks", store.read("ops.watermarks").drop("scope"))
    with pytest.raises(KeyError):
        store.read("ops.none")
    assert "ops_watermarks" in store.views()


def test_a_text_that_returns_takes_its_old_id(spark):
    row = lambda h, cur: ("u" + h, "s", "r", h, cur)
    df = spark.createDataFrame([row("A", False), row("B", True)], "unit_id string, source_id string, unit_ref string, text_hash string, is_current boolean").selectExpr("*", "current_timestamp() valid_from", "cast(null as timestamp) valid_to")
    new = spark.createDataFrame([("uA", "s", "r", "A")], "unit_id string, source_id string, unit_ref string, text_hash string")
    merged = silver.scd2(df, new, ["source_id", "unit_ref"], F.current_timestamp())
    after = silver.apply_merge(df, merged, ["unit_id"]).collect()
    assert {(r.unit_id, r.is_current) for r in after} == {("uA", True), ("uB", False)}


def test_rules_on_an_empty_table(spark):
    none = spark.createDataFrame([], "a int")
    out = {r.rule_id: r.passed for r in dq.check_rules(none, [dq.Rule("lo", "ratio_min", threshold=1.0, expression="a > 0"), dq.Rule("hi", "ratio_max", threshold=0.1, expression="a > 0"), dq.Rule("u", "unique", "a")]).collect()}
    assert out == {"lo": True, "hi": False, "u": True}
