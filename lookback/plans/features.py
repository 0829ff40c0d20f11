"""The click feature table: serving-week impressions with three weeks of history."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from lookback import schemas
from lookback.functions.scalar import now, safe_ratio
from lookback.operators.conform import distinct_on
from lookback.operators.pit import (
    EventSource,
    Label,
    Metric,
    last_day_of,
    pit_features,
    pit_from_log,
    serving_days,
    typed_events,
)

LABEL = Label("clicked", "tap")


def feature_metrics(amount_scale: int | None = None) -> list[Metric]:
    return [
        Metric("views_3w", "print"),
        Metric("taps_3w", "tap"),
        Metric("pays_3w", "pay"),
        Metric("amount_3w", "pay", total=True, scale=amount_scale),
    ]


def event_stream(prints: DataFrame, taps: DataFrame, pays: DataFrame) -> DataFrame:
    return typed_events(
        [
            EventSource(prints, "print"),
            EventSource(taps, "tap"),
            EventSource(pays, "pay", amount="total"),
        ],
        schemas.ENTITY,
    )


def with_ratios(features: DataFrame) -> DataFrame:
    return features.withColumns(
        {
            "ctr_3w": safe_ratio("taps_3w", "views_3w"),
            "avg_ticket_3w": safe_ratio("amount_3w", "pays_3w"),
        }
    )


def compute_features(
    prints: DataFrame,
    taps: DataFrame,
    pays: DataFrame,
    feature_window_days: int = 21,
    serving_window_days: int = 7,
    last_day: dt.date | None = None,
    amount_scale: int | None = None,
    form: str = "window",
    clock: dt.datetime | None = None,
    distinct_prints: bool = False,
) -> DataFrame:
    """Features of the impressions of the last ``serving_window_days`` days.

    ``last_day`` is the latest impression day; without it a small job looks it up.
    The impressions served are distinct; the history counts as it is given.
    ``distinct_prints`` says that ``prints`` is a set already, which saves a shuffle.
    """
    # No impressions: any day selects none of them.
    last = last_day or last_day_of(prints) or dt.date(1970, 1, 1)
    days = serving_days(last, serving_window_days)
    spine = prints.select(*schemas.EVENT_KEY)
    if not distinct_prints:
        spine = distinct_on(spine, schemas.EVENT_KEY)
    features = pit_features(
        spine,
        event_stream(prints, taps, pays),
        keys=schemas.ENTITY,
        metrics=feature_metrics(amount_scale),
        labels=[LABEL],
        lookback=feature_window_days,
        days=days,
        spine_in_events=True,
        form=form,
    )
    return (
        with_ratios(features)
        .withColumn("_computed_at", now(clock))
        .select(*schemas.FEATURES.names)
    )


def features_from_log(
    log: DataFrame,
    last_day: dt.date,
    feature_window_days: int = 21,
    serving_window_days: int = 7,
    amount_scale: int | None = None,
    clock: dt.datetime | None = None,
) -> DataFrame:
    """``compute_features`` over one log of all events (``ev_day``, ``etype``, ``user_id``,
    ``value_prop``, ``position``, ``amount``), which is read once. Impressions and clicks
    are sets there, payments a bag."""
    features = pit_from_log(
        log,
        keys=schemas.ENTITY,
        detail=["position"],
        spine_type="print",
        metrics=feature_metrics(amount_scale),
        labels=[LABEL],
        days=serving_days(last_day, serving_window_days),
        sets=("print", "tap"),
        lookback=feature_window_days,
    )
    return (
        with_ratios(features)
        .withColumn("_computed_at", now(clock))
        .select(*schemas.FEATURES.names)
    )


# The feature query as Spark SQL, for callers that work in SQL. Every source is rolled up
# to one row per entity and day by itself; the histories are frames over the union of
# those rows. Amounts are summed as DECIMAL or as doubles, as ``money`` says.
_FEATURES_SQL = """
WITH seen AS (
  SELECT user_id, value_prop, day, count(*) AS n FROM {prints} GROUP BY ALL
),
tapped AS (
  SELECT user_id, value_prop, day, count(*) AS n FROM {taps} GROUP BY ALL
),
paid AS (
  SELECT user_id, value_prop, day, count(*) AS n, sum(CAST(total AS {money})) AS spent
  FROM {pays} GROUP BY ALL
),
history AS (
  SELECT user_id, value_prop, day, sum(v) OVER past AS views_3w, sum(t) OVER past AS taps_3w,
    sum(p) OVER past AS pays_3w, sum(m) OVER past AS amount_3w, t > 0 AS tap_today
  FROM (
    SELECT user_id, value_prop, day, sum(v) AS v, sum(t) AS t, sum(p) AS p, sum(m) AS m
    FROM (
      SELECT user_id, value_prop, day, n AS v, 0L AS t, 0L AS p, NULL AS m FROM seen
      UNION ALL SELECT user_id, value_prop, day, 0L, n, 0L, NULL FROM tapped
      UNION ALL SELECT user_id, value_prop, day, 0L, 0L, n, spent FROM paid
    )
    WHERE user_id IS NOT NULL AND value_prop IS NOT NULL
      AND day >= date_sub(:first_day, :lookback) AND day <= :last_day
    GROUP BY user_id, value_prop, day
  )
  WINDOW past AS (PARTITION BY user_id, value_prop ORDER BY unix_date(day)
                  RANGE BETWEEN :lookback PRECEDING AND 1 PRECEDING)
),
served AS (
  SELECT day, user_id, value_prop, position FROM {prints}
  WHERE day >= :first_day AND day <= :last_day GROUP BY ALL
)
SELECT day, user_id, value_prop, position, CAST(ifnull(tap_today, false) AS INT) AS clicked,
  ifnull(views_3w, 0L) AS views_3w, ifnull(taps_3w, 0L) AS taps_3w, ifnull(pays_3w, 0L) AS pays_3w,
  ifnull(CAST(amount_3w AS DOUBLE), 0D) AS amount_3w,
  ifnull(try_divide(taps_3w, views_3w), 0D) AS ctr_3w,
  ifnull(try_divide(CAST(amount_3w AS DOUBLE), pays_3w), 0D) AS avg_ticket_3w,
  current_timestamp() AS _computed_at
FROM served LEFT JOIN history USING (day, user_id, value_prop)
"""


def compute_features_sql(
    prints: DataFrame,
    taps: DataFrame,
    pays: DataFrame,
    last_day: dt.date | None = None,
    feature_window_days: int = 21,
    serving_window_days: int = 7,
    amount_scale: int | None = None,
) -> DataFrame:
    """``compute_features`` in SQL, with the same defaults; amounts finer than
    ``amount_scale`` are rounded, and without it sums are plain doubles."""
    last = last_day or last_day_of(prints) or dt.date(1970, 1, 1)
    first, last = serving_days(last, serving_window_days)
    money = "DOUBLE" if amount_scale is None else f"DECIMAL(18, {amount_scale})"
    return prints.sparkSession.sql(
        _FEATURES_SQL.replace("{money}", money),
        args={"first_day": first, "last_day": last, "lookback": feature_window_days},
        prints=prints,
        taps=taps,
        pays=pays,
    )
