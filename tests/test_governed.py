import datetime as dt
import random

import pytest
from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import functions as F

from opsframe.operators import guarded, observe, review
from opsframe.sources.tables import Source

HOUR = dt.timedelta(hours=1)
START = dt.datetime(2100, 1, 1)


def brute_force(rows, max_iterations, timeout, as_of):
    """The fold, one item at a time, one row after the other."""
    out = {}
    for item in {r[0] for r in rows}:
        mine = sorted(r[1:] for r in rows if r[0] == item and r[1] <= as_of)
        if not mine:
            continue
        deadline, asked, state = mine[0][0] + timeout, 0, None
        for ts, _, decision in mine:
            if ts > deadline:
                break
            if decision in ("approve", "reject"):
                state = "approved" if decision == "approve" else "rejected"
            elif decision == "changes":
                asked += 1
                state = "exhausted" if asked > max_iterations else None
            if state:
                out[item] = (state, ts)
                break
        if not state:
            out[item] = ("timed_out", deadline) if as_of > deadline else ("pending", None)
    return out


@pytest.mark.parametrize("max_iterations", [0, 1, 3])
def test_review_against_brute_force_with_a_hot_item(spark, max_iterations):
    chooser = random.Random(max_iterations)
    words = ["changes", "changes", "changes", "view", "approve", "reject", None]
    rows = [
        (
            "hot" if chooser.random() < 0.4 else f"i{chooser.randint(0, 60)}",
            START + dt.timedelta(minutes=chooser.randint(0, 240)),
            seq,
            chooser.choice(words),
        )
        for seq in range(600)
    ]
    frame = spark.createDataFrame(rows, "item string, ts timestamp_ntz, seq long, decision string").repartition(5)
    for as_of in (START + 2 * HOUR, START + 9 * HOUR):
        states = review.review_state(frame, max_iterations=max_iterations, timeout=HOUR, as_of=as_of)
        got = {r.item: (r.state, r.decided_at) for r in states.collect()}
        assert got == brute_force(rows, max_iterations, HOUR, as_of)


def test_review_states_one_by_one(spark):
    def minutes(n):
        return START + dt.timedelta(minutes=n)

    rows = [
        ("approved", minutes(0), 1, "view"), ("approved", minutes(60), 2, "approve"), ("approved", minutes(60), 3, "reject"),
        ("late", minutes(0), 4, "view"), ("late", minutes(61), 5, "approve"),
        ("exhausted", minutes(0), 6, "changes"), ("exhausted", minutes(1), 7, "changes"), ("exhausted", minutes(2), 8, "approve"),
        ("at the limit", minutes(0), 9, "changes"), ("at the limit", minutes(2), 10, "reject"),
        ("open", minutes(100), 11, "changes"),
        ("later", minutes(500), 12, "approve"),
    ]
    frame = spark.createDataFrame(rows, "item string, ts timestamp, seq long, decision string")
    states = review.review_state(frame, max_iterations=1, timeout=HOUR, as_of=minutes(120))
    assert {r.item: r.state for r in states.collect()} == {
        "approved": "approved",
        "late": "timed_out",
        "exhausted": "exhausted",
        "at the limit": "rejected",
        "open": "pending",
    }
    proposals = spark.createDataFrame([("approved", 1), ("approved", 2), ("late", 3), (None, 4)], "name string, n int")
    assert [r.n for r in review.approved_only(proposals, states, ("name", "item")).collect()] == [1, 2]


@pytest.fixture(scope="module")
def orders(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("guard") / "orders")
    spark.range(100).select("id", (F.col("id") % 3).alias("kind")).write.parquet(path)
    return Source("orders", path)


def test_guarded_runs_a_query_and_caps_it(spark, orders):
    got = guarded.guarded_sql(spark, [orders], "WITH t AS (SELECT * FROM orders) SELECT id FROM t -- all", 7)
    assert got.count() == 7
    total = guarded.guarded_sql(spark, [orders], "SELECT kind, count(*) AS n FROM orders GROUP BY kind", 50)
    assert dict(total.collect()) == {0: 34, 1: 33, 2: 33}
    listed = guarded.guarded_sql(spark, [orders], "SELECT transform(array(id), x -> x + 1)[0] AS y FROM orders WHERE id = 1", 5)
    assert listed.collect() == [(2,)]


HOSTILE = [
    "DROP VIEW orders",
    "INSERT INTO orders VALUES (1, 2)",
    "CREATE TABLE t AS SELECT 1",
    "SET spark.sql.runSQLOnFiles=true",
    "SELECT 1; SELECT 2",
    "SELECT 1 /*",
    "SELECT * FROM parquet.`{path}`",
    "SELECT * FROM hidden",
    "SELECT * FROM global_temp.shared",
    "SELECT * FROM orders JOIN stored ON true",
    "SELECT * FROM default.stored",
    "SELECT * FROM `default` . stored",
    "SELECT * FROM spark_catalog.default.stored",
    "SELECT reflect('java.lang.System', 'getProperty', 'user.home')",
    "SELECT `java_method`('java.lang.System', 'getProperty', 'user.home')",
    "SELECT try_reflect('java.lang.System', 'getProperty', 'user.home')",
    "SELECT IDENTIFIER('ref' || 'lect')('java.lang.System', 'getProperty', 'user.home')",
    "SELECT * FROM IDENTIFIER /* gap */ ('def' || 'ault.stored')",
    "SELECT TRANSFORM(id) USING 'cat' AS (x string) FROM orders",
    "SELECT TRANSFORM(id) USING /* gap */ 'cat' AS (x string) FROM orders",
    "SELECT '--', transform(id) using -- gap\n \"cat\" as (x string) FROM orders",
    "SELECT TRANSFORM(id) USING /* a /* nested */ gap */ 'cat' AS (x string) FROM orders",
    "SELECT TRANSFORM(id) USING -- continued \\\n gap\n 'cat' AS (x string) FROM orders",
    "SELECT * FROM default/* gap */.stored",
    "FROM orders INSERT OVERWRITE DIRECTORY '{path}_out' USING parquet SELECT *",
    "SELECT * FROM text.`/etc/hostname`",
    "SELECT missing_column FROM orders",
    "SELECT * FROM orders WHERE id IN (SELECT id FROM stored)",
    "SELECT (SELECT max(id) FROM hidden) AS x FROM orders",
    "SELECT (SELECT max(id) FROM global_temp.shared) AS x FROM orders",
    "WITH orders AS (SELECT * FROM stored) SELECT * FROM orders",
    "SELECT * FROM orders WHERE EXISTS (SELECT 1 FROM stored s WHERE s.id = orders.id)",
    "SELECT * FROM orders, LATERAL (SELECT * FROM stored)",
    "SELECT * FROM stored_view",
    "SELECT sql_function(id) AS x FROM orders",
    "SELECT java_function(id) AS x FROM orders",
    "SELECT array_agg(java_method('java.lang.System', 'getProperty', 'user.home')) AS x FROM orders",
    "SELECT transform(array(1), x -> reflect('java.lang.System', 'getProperty', 'user.home')) AS x",
    "VALUES (reflect('java.lang.System', 'getProperty', 'user.home'))",
    "SELECT * FROM explode(array(java_method('java.lang.System', 'getProperty', 'user.home')))",
    "SHOW TABLES",
    "BEGIN SELECT 1; END",
    "SELECT IDENTIFIER('id') FROM orders",
]

HARMLESS = [
    ("SELECT count(*) AS n FROM orders WHERE 'default' <> cast(kind AS string)", 100),
    ("SELECT count(*) AS n FROM orders -- from default.stored reflect(", 100),
    ("SELECT count(*) AS n FROM orders /* spark_catalog TRANSFORM(id) USING 'cat' */", 100),
    ("SELECT count(DISTINCT stored) AS n FROM (SELECT kind AS stored, 'java_method' AS hidden FROM orders)", 3),
    ("SELECT max(`identifier`) AS n FROM (SELECT id AS `identifier`, 'global_temp' AS using FROM orders)", 99),
    ("WITH stored AS (SELECT id FROM orders WHERE id < 5) SELECT count(*) AS n FROM stored", 5),
    ("SELECT count(*) AS n FROM ORDERS o WHERE EXISTS (SELECT 1 FROM orders p WHERE p.id = o.id + 90)", 10),
    ("SELECT (SELECT max(id) FROM orders) + count(*) AS n FROM range(3) JOIN (VALUES (1)) AS v(x)", 102),
    ("SELECT count(*) AS n FROM orders, LATERAL explode(array(1, 2))", 200),
    ("SELECT max(length(url_encode(concat('map', 'reduce', kind)))) AS n FROM orders", 10),
    ("SELECT max(size(regexp_extract_all('a1b2', '[0-9]', 0)) + try_divide(1, kind)) AS n FROM orders", 3.0),
    ("SELECT count(*) AS n FROM orders PIVOT (count(id) FOR kind IN (0, 1))", 1),
    ("SELECT max(rank) AS n FROM (SELECT row_number() OVER (ORDER BY id) AS rank FROM orders)", 100),
]


@pytest.mark.parametrize("sql", HOSTILE)
def test_guarded_refuses(spark, orders, sql):
    spark.range(1).createOrReplaceTempView("hidden")
    spark.range(1).createOrReplaceGlobalTempView("shared")
    spark.range(1).write.mode("overwrite").saveAsTable("stored")
    spark.sql("CREATE OR REPLACE VIEW stored_view AS SELECT * FROM stored")
    spark.sql("CREATE OR REPLACE FUNCTION sql_function(x BIGINT) RETURNS BIGINT RETURN x + (SELECT max(id) FROM stored)")
    with pytest.raises((ValueError, AnalysisException, ParseException)):
        guarded.guarded_sql(spark, [orders], sql.replace("{path}", orders.uri), 50).collect()
    assert spark.conf.get("spark.sql.runSQLOnFiles") == "true"


@pytest.mark.parametrize("sql, n", HARMLESS)
def test_guarded_reads_plans_not_words(spark, orders, sql, n):
    spark.range(1).write.mode("overwrite").saveAsTable("stored")
    assert guarded.guarded_sql(spark, [orders], sql).first().n == n


def test_guarded_lists_no_catalog(spark, orders, monkeypatch):
    """However many tables the catalog has, none of them is looked at."""
    from pyspark.sql.catalog import Catalog

    for name in ("listTables", "listDatabases", "listCatalogs", "listFunctions"):
        monkeypatch.setattr(Catalog, name, lambda *_, **__: pytest.fail("listed"))
    assert guarded.guarded_sql(spark, [orders], "SELECT * FROM orders").count() == 100


def test_guarded_check_takes_linear_time(spark):
    with pytest.raises(ValueError):
        guarded.check_sql("SELECT TRANSFORM(x) USING " + "/**/" * 5000 + "'cat'")


def test_guarded_brackets_stay_under_the_cap(spark, orders):
    union = "SELECT id FROM orders) UNION ALL (SELECT id FROM orders"
    assert guarded.guarded_sql(spark, [orders], union, 7).count() == 7
    with pytest.raises((AnalysisException, ParseException)):
        guarded.guarded_sql(spark, [orders], "SELECT id FROM orders) LIMIT 90 --", 7).collect()


def test_observed_counts_without_changing_the_result(spark, caplog):
    frame = spark.range(100)
    watched, seen = observe.observed(frame, "step", {"n": F.count(F.lit(1)), "top": F.max("id")})
    assert watched.collect() == frame.collect()
    assert seen.get == {"n": 100, "top": 99}
    with caplog.at_level("INFO"):
        result, step = observe.run_observed(frame.filter("id < 5"), "small", lambda df: df.count())
    assert (result, step.name, step.metrics) == (5, "small", {"n_rows": 5}) and step.seconds > 0
    assert "small" in caplog.text
