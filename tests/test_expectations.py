"""Rules, actions, quarantine and the audit log."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lookback import DataQualityError, Expectation, apply_expectations, schemas
from lookback.functions.scalar import to_units
from lookback.operators import audit
from lookback.operators.expectations import (
    TableConstraints,
    audit_frame,
    constraint_audit,
    evaluate,
    expect,
    expect_all_or_drop,
    expect_or_drop,
    expect_or_fail,
    keep_valid,
    key_duplicates,
    quarantined,
    report,
)
from lookback.operators.publish import append_rows, load
from lookback.plans import rules

USER = Expectation("user", "user_id IS NOT NULL", "fail")
CATEGORY = Expectation("category", "value_prop IS NOT NULL", "drop")
TOTAL = Expectation("total", "total >= 0", "warn")
AT = dt.datetime(2024, 1, 1, 12, tzinfo=dt.timezone.utc)


@pytest.fixture
def faulty(spark):
    return spark.createDataFrame(
        [
            (31, "transport", 7.25),
            (32, "transport", -0.75),
            (None, "prepaid", 2.5),
            (34, None, 0.0),
            (35, "prepaid", 40.0),
        ],
        "user_id long, value_prop string, total double",
    )


def test_counts_per_rule_and_total(faulty):
    assert evaluate(faulty, [USER, CATEGORY, TOTAL]) == (
        {"user": 1, "category": 1, "total": 1},
        5,
    )


def test_drop_keeps_the_valid_rows(spark, faulty):
    drop = Expectation("total", "total >= 0", "drop")
    kept = apply_expectations(spark, faulty, [drop], "silver", "pays")
    assert kept.count() == 4 and kept.where("total < 0").count() == 0


def test_fail_raises(spark, faulty):
    with pytest.raises(DataQualityError, match="user on 1 rows"):
        apply_expectations(spark, faulty, [USER], "silver", "pays")


def test_warn_keeps_all_rows(spark, faulty):
    assert apply_expectations(spark, faulty, [TOTAL], "silver", "pays").count() == 5


def test_clean_rows_pass(spark, faulty):
    clean = faulty.where("user_id = 31")
    assert apply_expectations(spark, clean, [USER], "silver", "pays").count() == 1


def test_unknown_action_is_rejected():
    with pytest.raises(ValueError):
        Expectation("x", "true", "explode")


def test_duplicate_names_are_rejected(faulty):
    with pytest.raises(ValueError, match="duplicate"):
        evaluate(faulty, [USER, USER])


def test_null_predicate_is_a_violation_everywhere(spark):
    df = spark.createDataFrame([(None,), (1.0,), (-1.0,)], "total double")
    rule = [Expectation("total", "total >= 0", "drop")]
    assert evaluate(df, rule) == ({"total": 2}, 3)
    assert keep_valid(df, rule).count() == 1
    assert quarantined(df, rule).count() == 2


def test_kept_and_quarantined_rows_make_up_the_input(faulty):
    drops = [CATEGORY, Expectation("total", "total >= 0", "drop"), USER]
    whole = keep_valid(faulty, drops).unionByName(
        quarantined(faulty, drops, AT).drop("_quarantined_at")
    )
    assert sorted(map(str, whole.collect())) == sorted(map(str, faulty.collect()))


def test_quarantine_without_drop_rules_is_empty_but_typed(faulty):
    out = quarantined(faulty, [USER])
    assert out.count() == 0 and out.columns[-1] == "_quarantined_at"


def test_empty_input_passes_with_rate_zero(spark, faulty):
    (row,) = audit_frame(faulty.limit(0), [TOTAL], "silver", "pays", "r", AT).collect()
    assert (row.total_rows, row.failed_rows, row.failure_rate, row.passed) == (0, 0, 0.0, True)
    assert evaluate(faulty.limit(0), [TOTAL]) == ({"total": 0}, 0)


def test_report_puts_what_blocks_first(faulty):
    fine = Expectation("fine", "true", "fail")
    rows = report(audit_frame(faulty, [TOTAL, fine, USER, CATEGORY], "silver", "pays", "r", AT))
    found = [(r.severity, r.expectation, r.bad_pct) for r in rows.collect()]
    assert found == [
        ("blocking", "user", 20.0),
        ("removed", "category", 20.0),
        ("noted", "total", 20.0),
        ("fine", "fine", 0.0),
    ]


def test_error_carries_the_violations(spark, faulty):
    with pytest.raises(DataQualityError) as caught:
        apply_expectations(spark, faulty, [USER, TOTAL], "silver", "pays")
    assert caught.value.table == "pays" and caught.value.violations == {"user": 1}


def test_nan_amounts_are_violations(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "total double")
    (rule,) = [r for r in rules.payment_rules() if r.name == "total_non_negative"]
    assert evaluate(df, [rule])[0] == {"total_non_negative": 1}
    (row,) = df.where("isnan(total)").select(to_units("total", 2).alias("u")).collect()
    assert row.u is None


def test_missing_category_can_be_kept():
    (rule,) = [r for r in rules.payment_rules(null_category="warn") if r.name == "value_prop_not_null"]
    assert rule.action == "warn"


def test_constraints_check_the_key_too(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, None)], "a int, b int")
    made = TableConstraints(["a"], {"positive": "a > 0"}, ["a", "b"])
    rows = {r.expectation: r.failed_rows for r in constraint_audit(df, made, "gold", "t", "r").collect()}
    assert rows == {"a_not_null": 0, "b_not_null": 1, "positive": 0, "pk_unique": 1}


def test_audit_row_has_the_declared_schema(faulty):
    df = audit_frame(faulty, [USER, TOTAL], "silver", "pays", "r", AT)
    assert df.columns == schemas.AUDIT.names
    assert [f.dataType for f in df.schema] == [f.dataType for f in schemas.AUDIT]
    assert {(r.expectation, r.failure_rate, r.passed) for r in df.collect()} == {
        ("user", 0.2, False),
        ("total", 0.2, False),
    }


def test_audit_is_logged_before_fail_raises(spark, faulty, folder):
    log = f"{folder}/log"
    with pytest.raises(DataQualityError):
        apply_expectations(
            spark, faulty, [USER, TOTAL], "silver", "pays", log, "run-1", AT
        )
    rows = load(spark, log).collect()
    assert {(r.run_id, r.table_name, r.expectation) for r in rows} == {
        ("run-1", "pays", "user"),
        ("run-1", "pays", "total"),
    }
    assert len({r.checked_at for r in rows}) == 1


def test_key_check_counts_null_parts(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, 2), (None, 2)], "a int, b int")
    (row,) = key_duplicates(df, ["a", "b"], "gold", "t", "r", AT).collect()
    assert (row.total_rows, row.failed_rows, row.passed) == (4, 1, False)
    (row,) = key_duplicates(df.limit(0), ["a", "b"], "gold", "t", "r", AT).collect()
    assert (row.total_rows, row.passed) == (0, True)


def test_primary_key_violation_stops_the_job(spark):
    df = spark.createDataFrame([(1,), (1,)], "a int")
    with pytest.raises(DataQualityError, match="pk_unique on 1 rows"):
        apply_expectations(spark, df, [], "gold", "t", primary_key=["a"])


def test_constraints_become_fail_rules():
    made = TableConstraints(["a"], {"c": "x IN (0, 1)"}, ["a", "b"]).expectations()
    assert [(e.name, e.action) for e in made] == [
        ("a_not_null", "fail"),
        ("b_not_null", "fail"),
        ("c", "fail"),
    ]


def test_declared_rules_carry_their_action():
    made = [
        *expect("a", "1"),
        *expect_or_drop("b", "1"),
        *expect_or_fail("c", "1"),
        *expect_all_or_drop({"d": "1", "e": "1"}),
    ]
    assert [e.action for e in made] == ["warn", "drop", "fail", "drop", "drop"]


def test_rule_catalogue_sizes_and_clock(spark):
    assert len(rules.event_rules()) == 6 and len(rules.feature_rules()) == 6
    late = spark.createDataFrame([(dt.date(2024, 1, 2), 1, "point", 11)], schemas.EVENTS)
    failed, _ = evaluate(late, rules.event_rules(dt.date(2024, 1, 1)))
    assert {n for n, c in failed.items() if c} == {"day_not_future", "position_in_range"}
    actions = {r.name: r.action for r in rules.event_rules(strict=True, null_user="drop")}
    assert actions["user_id_not_null"] == "drop"
    assert actions["value_prop_known"] == actions["position_in_range"] == "drop"


def log_rows(spark, rows):
    """(run, time offset, rule, action, failed) of 100 rows each."""
    return spark.createDataFrame(
        [
            (
                run, "gold", "t", rule, "c", action, 100, failed, failed / 100, failed == 0,
                AT + dt.timedelta(hours=hours),
            )
            for run, hours, rule, action, failed in rows
        ],
        schemas.AUDIT,
    )


def test_latest_takes_the_newest_row_per_rule(spark):
    # The older run has the larger id.
    log = log_rows(
        spark, [("z", 0, "a", "fail", 5), ("b", 1, "a", "fail", 0), ("z", 0, "only", "warn", 3)]
    )
    got = {r.expectation: r for r in audit.dq_latest(log).collect()}
    assert got["a"].passed and got["only"].failure_pct == 3.0
    assert {r.run_id for r in audit.latest_run(log).collect()} == {"b"}


def test_gate_speaks_for_the_newest_run_only(spark):
    log = log_rows(spark, [("z", 0, "a", "fail", 5), ("b", 1, "a", "fail", 0)])
    assert [r.dq_gate for r in audit.dq_gate(log).collect()] == ["DQ OK"]
    audit.require_no_breach(log)
    worse = log.unionByName(log_rows(spark, [("c", 2, "a", "fail", 1)]))
    with pytest.raises(Exception, match="gate closed by t\\.\\w+"):
        audit.dq_gate(worse).collect()
    with pytest.raises(DataQualityError):
        audit.require_no_breach(worse)


def test_gate_ignores_violated_warnings(spark):
    log = log_rows(spark, [("a", 0, "w", "warn", 50)])
    assert audit.dq_gate(log).first().dq_gate == "DQ OK"


def test_trend_has_one_point_per_run_and_table(spark):
    log = log_rows(
        spark,
        [("b", 1, "x", "warn", 3), ("a", 0, "x", "warn", 1), ("a", 0, "y", "warn", 2)],
    )
    assert [r.avg_failure_pct for r in audit.dq_trend(log).collect()] == [1.5, 3.0]


def test_alert_thresholds_are_exclusive(spark):
    def triggered(rows):
        latest = audit.dq_latest(log_rows(spark, rows))
        return {r.alert: r.triggered for r in audit.dq_alerts(latest).collect()}

    assert triggered([("a", 0, "x", "warn", 1)]) == {
        "dq_critical_failures": False,
        "dq_failure_rate": False,
    }
    assert triggered([("a", 0, "x", "fail", 2)]) == {
        "dq_critical_failures": True,
        "dq_failure_rate": True,
    }
    empty = audit.dq_alerts(audit.dq_latest(log_rows(spark, []))).collect()
    assert not any(r.triggered for r in empty)


def test_audit_by_group_gives_one_run_per_value(spark, faulty):
    runs = audit_frame(
        faulty, [TOTAL], "silver", "pays", F.coalesce("value_prop", F.lit("none")), AT,
        by="value_prop",
    )
    assert {(r.run_id, r.total_rows, r.failed_rows) for r in runs.collect()} == {
        ("transport", 2, 1),
        ("prepaid", 2, 0),
        ("none", 1, 0),
    }


def test_log_appends_keep_order_free_history(spark, folder):
    log = f"{folder}/log"
    for run in ("a", "b"):
        append_rows(spark, log_rows(spark, [(run, 0, "x", "warn", 1)]).collect(), schemas.AUDIT, log)
    assert load(spark, log).schema.names == schemas.AUDIT.names
    assert {r.run_id for r in load(spark, log).collect()} == {"a", "b"}
