"""Feature semantics: window bounds, label, sets and bags, NULL keys, empty input."""

import datetime as dt
import random
from collections import Counter

import pytest

from lookback import compute_features, schemas
from lookback.operators.pit import FORMS, EventSource, Metric, pit_features, typed_events
from lookback.plans.features import compute_features_sql, features_from_log

D = dt.date(2020, 11, 30)


def days_before(n):
    return D - dt.timedelta(days=n)


def frames(spark, prints, taps=(), pays=()):
    return (
        spark.createDataFrame(list(prints), schemas.EVENTS),
        spark.createDataFrame(list(taps), schemas.EVENTS),
        spark.createDataFrame(list(pays), schemas.PAYMENTS),
    )


def rows(df):
    return [r.asDict() for r in df.drop("_computed_at").collect()]


@pytest.mark.parametrize("form", FORMS)
def test_window_includes_day_1_and_21_but_not_0_and_22(spark, form):
    prints = [(days_before(n), 41, "transport", 2) for n in (0, 1, 2, 21, 22, 23)]
    df = compute_features(
        *frames(
            spark,
            prints,
            [(D, 41, "transport", 7), (days_before(21), 41, "transport", 2), (days_before(22), 41, "transport", 2)],
            [(days_before(n), 41, "transport", 2.0**n) for n in (0, 1, 8, 21, 22)],
        ),
        form=form,
    )
    got = {r["day"]: r for r in rows(df)}[D]
    assert (got["views_3w"], got["taps_3w"], got["pays_3w"]) == (3, 1, 3)
    assert got["amount_3w"] == 2 + 256 + 2097152
    assert got["clicked"] == 1


@pytest.mark.parametrize("form", FORMS)
def test_click_elsewhere_and_same_day_payment_count_for_nothing(spark, form):
    taps = [(D, 41, "send_money", 2), (D, 42, "transport", 2), (days_before(1), 41, "transport", 2)]
    df = compute_features(
        *frames(spark, [(D, 41, "transport", 2)], taps, [(D, 41, "transport", 3.75)]), form=form
    )
    (got,) = rows(df)
    assert got["clicked"] == 0 and got["taps_3w"] == 1
    assert got["amount_3w"] == 0.0 and got["pays_3w"] == 0


@pytest.mark.parametrize("form", FORMS)
def test_ratios_and_history_as_a_bag(spark, form):
    past = days_before(17)
    df = compute_features(
        *frames(
            spark,
            [(D, 8, "link_cobro", 1), *[(past, 8, "link_cobro", 3)] * 4],
            [(past, 8, "link_cobro", 3)],
            [(past, 8, "link_cobro", 12.5), (past, 8, "link_cobro", 12.5), (days_before(2), 8, "link_cobro", 2.0)],
        ),
        form=form,
    )
    got = {r["day"]: r for r in rows(df)}[D]
    assert got["views_3w"] == 4 and got["taps_3w"] == 1 and got["ctr_3w"] == 0.25
    assert got["pays_3w"] == 3 and got["avg_ticket_3w"] == 9.0


def test_one_log_equals_three_tables(spark):
    """With NULLs in any part of the key, copies, and amounts that fit no unit."""
    rng = random.Random(12)
    some = lambda *values: rng.choice([*values, *values, None])
    events = [
        (some(*map(days_before, range(30))), some(1, 2, 3), some("point", "prepaid"), some(0, 1), rng.choice(["print", "tap", "pay"]))
        for _ in range(500)
    ]
    events += events[:100]
    log = spark.createDataFrame(
        [(d, u, v, p if t != "pay" else None, t, some(1.25, 1e300, float("nan"), 7.5) if t == "pay" else None) for d, u, v, p, t in events],
        "ev_day date, user_id long, value_prop string, position int, etype string, amount double",
    )
    named = log.withColumnRenamed("ev_day", "day")
    prints, taps = (named.where(f"etype = '{t}'").select(*schemas.EVENT_KEY).distinct() for t in ("print", "tap"))
    pays = named.where("etype = 'pay'").withColumnRenamed("amount", "total").select(*schemas.PAYMENTS.names)
    want = compute_features(prints, taps, pays, last_day=D, amount_scale=2).drop("_computed_at")
    got = features_from_log(log, D, amount_scale=2).drop("_computed_at")
    assert got.columns == want.columns
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect())) and want.count() > 20
    assert features_from_log(log.limit(0), D).count() == 0


def test_only_the_serving_week_is_served(spark):
    prints = [(D, 1, "point", 0), (days_before(6), 3, "point", 0), (days_before(7), 2, "point", 0)]
    df = compute_features(*frames(spark, prints))
    assert {r["user_id"] for r in rows(df)} == {1, 3}


def test_window_lengths_are_parameters(spark):
    prints = [(days_before(n), 1, "point", 0) for n in range(10)]
    df = compute_features(*frames(spark, prints), feature_window_days=3, serving_window_days=2)
    assert {(r["day"], r["views_3w"]) for r in rows(df)} == {(D, 3), (days_before(1), 3)}


def test_positions_are_rows_of_their_own_with_equal_features(spark):
    prints = [(D, 1, "point", 0), (D, 1, "point", 1), (D, 1, "point", 1)]
    prints.append((days_before(2), 1, "point", 5))
    got = [r for r in rows(compute_features(*frames(spark, prints))) if r["day"] == D]
    assert sorted(r["position"] for r in got) == [0, 1]
    assert {r["views_3w"] for r in got} == {1}


def test_click_rate_may_exceed_one(spark):
    past = days_before(1)
    df = compute_features(
        *frames(
            spark,
            [(D, 1, "point", 0), (past, 1, "point", 0)],
            [(past, 1, "point", p) for p in range(3)],
        )
    )
    assert {r["day"]: r["ctr_3w"] for r in rows(df)}[D] == 3.0


@pytest.mark.parametrize("form", FORMS)
def test_null_keys_match_nothing(spark, form):
    past = days_before(1)
    prints = [(d, u, v, 0) for d in (D, past) for u, v in ((None, "point"), (1, None))]
    df = compute_features(*frames(spark, prints, prints, [(past, None, "point", 9.0)]), form=form)
    got = rows(df)
    assert len(got) == 4
    assert all(r["views_3w"] == r["taps_3w"] == r["pays_3w"] == r["clicked"] == 0 for r in got)
    assert all(None not in (r["amount_3w"], r["ctr_3w"], r["avg_ticket_3w"]) for r in got)


def test_payment_without_amount_counts_but_adds_nothing(spark):
    df = compute_features(
        *frames(spark, [(D, 1, "point", 0)], pays=[(days_before(1), 1, "point", None)])
    )
    (got,) = rows(df)
    assert got["pays_3w"] == 1 and got["amount_3w"] == 0.0


@pytest.mark.parametrize("form", FORMS)
def test_empty_input_gives_the_empty_table(spark, form):
    df = compute_features(*frames(spark, []), form=form)
    assert df.columns == schemas.FEATURES.names
    assert [f.dataType for f in df.schema] == [f.dataType for f in schemas.FEATURES]
    assert df.count() == 0


def test_unknown_form_is_rejected(spark):
    with pytest.raises(ValueError):
        compute_features(*frames(spark, [(D, 1, "point", 0)]), form="cartesian")


def brute_force(prints, taps, pays, scale):
    """The definition, row by row."""
    known = [r[0] for r in prints if r[0]]
    first = max(known) - dt.timedelta(days=6)
    out = Counter()
    for day, user, prop, pos in {r for r in prints if r[0] and r[0] >= first}:
        lo, hi = day - dt.timedelta(days=21), day - dt.timedelta(days=1)

        def past(events):
            return [
                e
                for e in events
                if None not in (e[0], user, prop)
                and e[1] == user
                and e[2] == prop
                and lo <= e[0] <= hi
            ]

        amounts = [round(e[3] * 10**scale) for e in past(pays) if e[3] is not None]
        clicked = any(
            (t[0], t[1], t[2]) == (day, user, prop) and None not in (user, prop) for t in taps
        )
        views, clicks, paid = len(past(prints)), len(past(taps)), len(past(pays))
        amount = sum(amounts) / 10**scale
        out[
            (
                day, user, prop, pos, int(clicked), views, clicks, paid, amount,
                clicks / views if views else 0.0,
                amount / paid if paid else 0.0,
            )
        ] += 1
    return out


def random_tables(seed):
    """Few entities, one of them holding a third of all rows; NULLs and copies."""
    rng = random.Random(seed)

    def key():
        if rng.random() < 0.33:
            return 1, "point"
        return rng.choice([1, 2, 3, None]), rng.choice(["point", "prepaid", None])

    def day():
        return None if rng.random() < 0.02 else days_before(rng.randrange(35))

    def event():
        return (day(), *key(), rng.choice([0, 1, 2, None]))

    prints = [event() for _ in range(150)]
    prints += rng.choices(prints, k=30)
    taps = [event() for _ in range(60)]
    pays = [(day(), *key(), rng.choice([None, round(rng.uniform(0, 200), 2)])) for _ in range(80)]
    return prints, taps, pays


@pytest.mark.parametrize("seed", range(4))
def test_every_form_equals_the_definition(spark, seed):
    tables = random_tables(seed)
    want = brute_force(*tables, scale=2)
    for form in FORMS:
        df = compute_features(*frames(spark, *tables), amount_scale=2, form=form)
        got = Counter(tuple(r) for r in df.drop("_computed_at").collect())
        assert got == want, form


def test_sql_form_equals_the_dataframe_form(spark):
    prints, taps, pays = random_tables(9)
    tables = frames(spark, prints, taps, pays)
    last = max(r[0] for r in prints if r[0])

    def rounded(df):
        return Counter(
            tuple(round(v, 6) if isinstance(v, float) else v for v in r)
            for r in df.drop("_computed_at").collect()
        )

    assert rounded(compute_features_sql(*tables, last)) == rounded(compute_features(*tables))


@pytest.mark.parametrize("form", FORMS)
def test_spine_outside_the_history(spark, form):
    spine = spark.createDataFrame(
        [(D, "a", 7), (D, "b", 8), (days_before(40), "a", 9)], "at date, who string, tag int"
    )
    log = spark.createDataFrame(
        [(days_before(2), "a", 1.5), (days_before(3), "a", 2.0), (D, "a", 50.0)],
        "day date, who string, v double",
    )
    df = pit_features(
        spine,
        typed_events([EventSource(log, "x", amount="v")], ["who"]),
        keys=["who"],
        metrics=[Metric("n", "x"), Metric("v", "x", total=True)],
        day="at",
        lookback=2,
        form=form,
    )
    assert {(r.tag, r.n, r.v) for r in df.collect()} == {(7, 1, 1.5), (8, 0, 0.0), (9, 0, 0.0)}


def test_gap_moves_the_end_of_the_window(spark):
    log = spark.createDataFrame(
        [(days_before(n), "a", 1.0) for n in range(6)], "day date, who string, v double"
    )
    events = typed_events([EventSource(log, "x")], ["who"])
    for form in FORMS:
        df = pit_features(
            log.where("day = DATE'2020-11-30'").drop("v"),
            events,
            ["who"],
            [Metric("n", "x")],
            lookback=4,
            gap=3,
            form=form,
        )
        assert [r.n for r in df.collect()] == [2], form
