from pyspark.sql import functions as F

from telestrata.operators import checks
from tests.conftest import event


def verdicts(result):
    return {(r.check, r.layer): (r.status, r.observed) for r in result.collect()}


def test_every_rule_kind_can_pass_and_fail(spark):
    good = spark.createDataFrame(
        [("a", 1.0, "x", 2), ("b", 3.0, "y", 1)], "k string, v double, c string, n bigint"
    ).withColumn("flag", F.col("v") > 2)
    bad = good.unionByName(good.where("k = 'a'").withColumn("v", F.lit(None).cast("double")))
    tables = {"good": good, "bad": bad}
    rules = [
        checks.row_count("good", exactly=2),
        checks.row_count("bad", exactly=2),
        checks.not_more_rows("good", than="bad"),
        checks.not_more_rows("bad", than="good"),
        checks.unique("good", ("k",)),
        checks.unique("bad", ("k",)),
        *checks.no_nulls("good", ("v", "c")),
        *checks.no_nulls("bad", ("v",)),
        checks.in_range("good", "v", 0, 3),
        checks.in_range("bad", "v", 2, 3),
        checks.in_set("good", "c", ("x", "y")),
        checks.in_set("bad", "c", ("x",)),
        *checks.has_columns("good", good, ("k",)),
        *checks.has_columns("bad", bad, ("zz",)),
        *checks.lacks_columns("good", good, ("zz",)),
        *checks.lacks_columns("bad", bad, ("k",)),
        checks.reconciles("good", "n", with_rows_of="bad"),
        checks.reconciles("bad", "n", with_rows_of="good"),
        checks.covers("good", "k", of="bad"),
        checks.covers("bad", "v", of="bad"),
        checks.rate_between("good", "flag", 0.4, 0.6),
        checks.rate_between("bad", "flag", 0.4, 0.6),
        checks.spread_over("good", "v", 1.5),
        checks.spread_over("bad", "v", 5.0),
        checks.distinct_over("good", "k", 1),
        checks.distinct_over("bad", "k", 2),
    ]
    got = verdicts(checks.run_checks(tables, rules))
    assert len(got) == len(rules)
    failed = {key for key, (status, _) in got.items() if status == "fail"}
    assert failed == {
        ("row_count", "bad"),
        ("not_more_rows", "bad"),
        ("unique(k)", "bad"),
        ("no_nulls(v)", "bad"),
        ("in_range(v)", "bad"),
        ("in_set(c)", "bad"),
        ("has_column(zz)", "bad"),
        ("lacks_column(k)", "bad"),
        ("reconciles(n)", "bad"),
        ("rate_between(flag)", "bad"),
        ("spread(v)", "bad"),
        ("distinct(k)", "bad"),
    }
    assert got[("unique(k)", "bad")] == ("fail", 1.0)
    assert got[("no_nulls(v)", "bad")][1] == 1.0
    assert got[("not_more_rows", "bad")][1] == 1.0


def test_an_empty_table_fails_a_rate_check_and_does_not_error(spark):
    empty = spark.createDataFrame([], "flag boolean, v double")
    rules = [
        checks.rate_between("t", "flag", 0, 1),
        checks.spread_over("t", "v", 0),
        checks.row_count("t"),
    ]
    statuses = [r.status for r in checks.run_checks({"t": empty}, rules).collect()]
    assert statuses == ["fail", "fail", "fail"]


def test_all_measures_of_a_table_share_one_scan(frame):
    df = frame(event(), event(1))
    rules = [*checks.no_nulls("t", df.columns[:6]), checks.in_range("t", "humidity", 0, 100), checks.row_count("t")]
    plan = checks.run_checks({"t": df}, rules)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1
