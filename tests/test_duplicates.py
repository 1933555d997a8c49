from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from landflow.operators import classify
from landflow.operators import duplicates as D
from landflow.operators import rules as R
from tests.conftest import rows


def counted(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def skewed(spark):
    """One row makes up a third of all rows; values include nulls."""
    hot = spark.range(1000).select(F.lit("hot").alias("a"), F.lit(None).cast("int").alias("b"))
    rest = spark.range(2000).select(
        F.concat(F.lit("k"), (F.col("id") % 700).cast("string")), (F.col("id") % 3).cast("int")
    )
    return hot.unionAll(rest)


def test_surplus_equals_builtin_difference_for_any_piece(skewed):
    expected = counted(skewed.exceptAll(skewed.distinct()))
    for piece in (1, 7, 100, 100_000):
        assert counted(D.surplus_duplicates(skewed, piece)) == expected


def test_hot_group_is_spread_over_tasks(skewed):
    # ten pieces of one hundred copies leave the single task that counted them
    copies = D.surplus_duplicates(skewed, 100).filter("a = 'hot'")
    assert copies.select(F.spark_partition_id()).distinct().count() > 1


def test_minus_all_equals_builtin(skewed):
    right = skewed.filter("b = 1 or a = 'hot'").limit(500)
    right = right.sparkSession.createDataFrame(right.collect(), right.schema)
    assert counted(D.minus_all(skewed, right, 50)) == counted(skewed.exceptAll(right))
    assert D.minus_all(skewed, skewed).count() == 0


@pytest.mark.parametrize("policy", list(D.DuplicatePolicy))
def test_policies_lose_nothing_but_dropped_copies(skewed, policy):
    kept, rejected = D.row_duplicate_policy(skewed, policy)
    total = kept.count() + rejected.count()
    if policy is D.DuplicatePolicy.DROP:
        assert total == skewed.distinct().count()
    else:
        assert total == skewed.count()
    if policy is D.DuplicatePolicy.REJECT:
        assert kept.count() == skewed.distinct().count()
        assert rejected.select("reject_reason").distinct().collect()[0][0] == D.REJECT_REASON


def test_priority_dedup_is_deterministic(spark):
    data = [("k", "BACKLOG", i) for i in range(50)] + [("k", "REV", 7), ("k", "REV", 3), (None, "REV", 1), (None, "X", 0)]
    df = spark.createDataFrame(data, "key string, kind string, n int")
    for parts in (1, 8):
        got = D.priority_dedup(
            df.repartition(parts), ["key"], [F.when(F.col("kind") == "REV", 1).otherwise(2)]
        )
        assert rows(got) == [(None, "REV", 1), ("k", "REV", 3)]


def test_priority_dedup_keeps_one_row_per_key_before_the_shuffle(spark, skewed):
    plan = D.priority_dedup(skewed, ["a"], [])._jdf.queryExecution().toString()
    before_shuffle = plan[plan.rindex("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_duplicate_count(skewed):
    surplus, groups = D.duplicate_count(skewed).collect()[0]
    expected = counted(skewed)
    assert surplus == sum(n - 1 for n in expected.values())
    assert groups == sum(n > 1 for n in expected.values())
    assert tuple(D.duplicate_count(skewed.limit(0)).collect()[0]) == (0, 0)


def test_rules_gather_every_reason_once(spark):
    df = spark.createDataFrame(
        [("1", "a", "2024-01-01"), ("x", " ", "2024-13-01"), (None, None, ""), ("2", "b", None)],
        "i string, n string, d string",
    )
    rules = [R.integer_rule("i"), R.notnull_rule("n"), R.date_rule("d", "yyyy-MM-dd")]
    checked = R.apply_rules(df, rules)
    assert rows(R.passed(checked)) == rows(R.passing(df, rules)) == [("1", "a", "2024-01-01"), ("2", "b", None)]
    reasons = {r.i: r.reject_reason for r in R.failed(checked).collect()}
    assert reasons == {
        "x": ["d_date_format_incorrect", "i_integer_format_incorrect", "n_null_check_failed"],
        None: ["i_integer_format_incorrect", "n_null_check_failed"],
    }
    counts = R.step_counts(checked).collect()[0]
    assert counts.landing_count == counts.raw_count + counts.reject_count == 4
    assert R.file_verdict(R.step_counts(checked)).collect()[0].executionstatus == "Failed"
    empty = R.file_verdict(R.step_counts(checked.limit(0))).collect()[0]
    assert (empty.executionstatus, empty.errormessage) == ("Empty", "Full File Rejected as we have zero records")


def test_reject_summary_stays_small_for_a_hot_record(spark):
    hot = spark.range(5000).select(F.lit("x").alias("v"))
    rejects = R.union_rejects(R.apply_rules(hot, [R.integer_rule("v"), R.date_rule("v", "yyyy-MM-dd")]))
    only = R.reject_summary(rejects).collect()
    assert len(only) == 1 and only[0].occurrences == [5000, 5000]
    assert only[0].reject_reason == ["v_date_format_incorrect", "v_integer_format_incorrect"]


def test_order_classes_are_exclusive_and_reconcile(spark):
    df = spark.createDataFrame(
        [("ZOR", "4RN"), ("ZCR", "4RN"), ("ZDR", "106"), ("ZDR", "313"), ("ZXX", None), (None, "1")],
        "t string, r string",
    )
    for region in ("APJ", "ams", "EMEA"):
        got = df.withColumn("order_class", classify.order_class(region, F.col("t"), F.col("r")))
        counts = classify.class_reconcile(got).collect()[0]
        left = classify.unclassified_rows(got)
        assert counts.actual_count + counts.return_count + left.count() == counts.raw_count
        assert counted(left) == counted(classify.unclassified_by_difference(got))
    emea = df.select(classify.order_class("EMEA", F.col("t"), F.col("r"))).collect()
    assert [r[0] for r in emea] == ["actual", "unclassified", "actual", "unclassified", "unclassified", "unclassified"]


def test_unlike_records_with_one_fingerprint_are_told_apart(skewed, monkeypatch):
    """Every record has the same fingerprint here: the content decides, as it does where hashes collide."""
    expected, right = counted(skewed.exceptAll(skewed.distinct())), skewed.filter("b = 1")
    minus = counted(skewed.exceptAll(right))
    monkeypatch.setattr(D, "fingerprint", lambda names: [F.lit(1).alias("_f1"), F.lit(2).alias("_f2")])
    assert counted(D.surplus_duplicates(skewed)) == expected
    assert counted(D.minus_all(skewed, right)) == minus


def test_nulls_are_part_of_a_fingerprint(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", None), ("", None), (None, None), (None, "")], "x string, y string")
    assert df.select(*D.fingerprint(df.columns)).distinct().count() == 5
    assert counted(D.surplus_duplicates(df)) == {("a", None): 1}


def test_only_fingerprints_of_all_rows_are_shuffled(spark):
    """Wide rows are shuffled once, after the fingerprints have picked them; kept and rejected rows share a count."""
    # dealt out anew: of a range Spark knows that equal rows are together already
    wide = spark.range(1000).repartition(4).select(*[(F.col("id") % 500 * k).alias(f"c{k}") for k in range(1, 40)])
    plan = D.surplus_duplicates(wide)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan
    kept, rejected = D.row_duplicate_policy(wide, D.DuplicatePolicy.REJECT)
    both = kept.unionByName(rejected.drop("reject_reason", "rejected_column"))
    both.collect()
    assert both._jdf.queryExecution().executedPlan().toString().count("ReusedExchange") >= 1
