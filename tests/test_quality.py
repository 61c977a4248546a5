import pytest
from pyspark.sql import Observation

from millrace.operators import quality as ops
from millrace.specs import Rules, SpecError

LEVELS = {
    "expect": {"a": "x > 1"},
    "expect_all": {"replaced": "false"},
    "expect_or_drop": {"b": "x > 2"},
    "expect_all_or_fail": {"c": "x IS NULL OR x < 100"},
    "expect_or_quarantine": {"d": "x = 3"},
}


@pytest.fixture
def df(spark):
    return spark.createDataFrame([(1,), (2,), (3,), (4,), (None,)], "x int")


def values(frame):
    return sorted((r.x for r in frame.collect()), key=str)


def test_short_level_replaces_the_all_level():
    rules = Rules.from_levels(LEVELS)
    assert rules.warn == {"a": "x > 1"} and rules.fail == {"c": "x IS NULL OR x < 100"}
    assert [level for level, _, _ in rules.by_level()] == ["warn", "fail", "drop", "quarantine"]
    with pytest.raises(SpecError):
        Rules.from_levels({"expect_or_explode": {}})


def test_warn_counts_and_keeps(df):
    watch = Observation()
    assert len(values(ops.expect(df, {"a": "x > 1", "b": "x > 3"}, watch))) == 5
    assert watch.get == {"rows_seen": 5, "a": 2, "b": 4}


def test_stack_and_quarantine(df):
    rules = Rules.from_levels(LEVELS)
    assert values(ops.apply_rules(df, rules)) == [3, 4]
    # a row can be in both tables
    assert values(ops.quarantine_rows(df, rules)) == [3]


def test_split_puts_each_row_in_one_table(df):
    rules = Rules(quarantine={"good": "x > 2"}, split=True)
    main, bad = ops.apply_rules(df, rules), ops.quarantine_rows(df, rules)
    assert values(main) == [3, 4] and values(bad) == [1, 2, None]


def test_fail_names_the_rule_even_if_the_column_is_unused(df):
    checked = ops.expect_or_fail(df, {"small": "x < 4"})
    with pytest.raises(Exception, match="rule small failed"):
        checked.selectExpr("1 AS one").collect()


def test_null_breaks_fail_rules(df):
    with pytest.raises(Exception, match="rule known failed"):
        ops.expect_or_fail(df, {"known": "x < 100"}).count()


def test_report(df):
    rules = Rules.from_levels(LEVELS)
    lines = {(r.level, r.rule): (r.rows_seen, r.rows_failed) for r in ops.report(df, rules).collect()}
    assert lines == {("warn", "a"): (5, 2), ("fail", "c"): (5, 0), ("drop", "b"): (5, 3), ("quarantine", "d"): (5, 4)}
