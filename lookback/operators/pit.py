"""Point-in-time features: what an entity did in the days before each spine row.

The work is ordered so that hot entities shrink before anything is moved:

1. Events are cut to the days the spine can see, with literal bounds.
2. ``daily_rollup`` groups them to one row per entity and day. Partial aggregation
   collapses a hot entity inside each map task, so the shuffle carries at most one
   row per entity, day and task, however many events there were.
3. ``rolled`` sums the days before each day. The default form is a RANGE frame; an
   entity has at most one row per calendar day there, which bounds every window
   partition by the length of the history and not by the number of events.
4. The spine looks its entity and day up. Both sides of that join sit directly on a
   shuffle, the shape in which AQE can split a skewed spine partition.

``form="join"`` and ``form="binned"`` replace step 3 by band joins over the daily
rows. They give the same rows and suit spines that are tiny beside the history.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lookback.functions.predicates import days_between, not_null
from lookback.functions.scalar import from_units, to_units, zero_if_null
from lookback.operators.bandjoin import band_join

FORMS = ("window", "join", "binned")


@dataclass(frozen=True)
class EventSource:
    """A table of one event type; ``amount`` names its value column, if it has one."""

    df: DataFrame
    event_type: str
    day: str = "day"
    amount: str | None = None


@dataclass(frozen=True)
class Metric:
    """Count of an event type, or the sum of its amounts.

    ``scale`` sums in whole units of 10**-scale: exact and the same for every plan.
    """

    name: str
    event_type: str
    total: bool = False
    scale: int | None = None

    def per_day(self) -> Column:
        hit = F.col("etype") == self.event_type
        if not self.total:
            return F.count_if(hit).alias(self.name)
        amount = F.col("amount") if self.scale is None else to_units("amount", self.scale)
        return F.sum(F.when(hit, amount)).alias(self.name)

    def final(self) -> Column:
        if not self.total:
            return zero_if_null(self.name).alias(self.name)
        value = F.col(self.name) if self.scale is None else from_units(self.name, self.scale)
        return zero_if_null(value, 0.0).alias(self.name)


@dataclass(frozen=True)
class Label:
    """1 where the spine row's own day has an event of this type, else 0."""

    name: str
    event_type: str

    def per_day(self) -> Column:
        return F.max((F.col("etype") == self.event_type).cast("int")).alias(self.name)

    def final(self) -> Column:
        return zero_if_null(self.name).alias(self.name)


def typed_events(sources: Sequence[EventSource], keys: Sequence[str]) -> DataFrame:
    """Several event tables as one stream of (keys, ev_day, etype, amount)."""
    parts = [
        s.df.select(
            *keys,
            F.col(s.day).alias("ev_day"),
            F.lit(s.event_type).alias("etype"),
            (F.col(s.amount) if s.amount else F.lit(0.0)).cast("double").alias("amount"),
        )
        for s in sources
    ]
    return reduce(DataFrame.unionByName, parts)


def serving_days(last_day: dt.date, days: int) -> tuple[dt.date, dt.date]:
    """First and last of the ``days`` days that end at ``last_day``."""
    return last_day - dt.timedelta(days=days - 1), last_day


def last_day_of(df: DataFrame, day: str = "day") -> dt.date | None:
    """Latest day present: one small job over one column, so that later filters are
    literals, which prune partitions and reach the scan."""
    return df.agg(F.max(day)).first()[0]


def daily_rollup(
    events: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[Metric],
    labels: Sequence[Label] = (),
) -> DataFrame:
    """One row per entity and day. Events without a full key can match no spine row."""
    return (
        events.where(not_null([*keys, "ev_day"]))
        .groupBy(*keys, "ev_day")
        .agg(*[m.per_day() for m in (*metrics, *labels)])
    )


def rolled(
    daily: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[Metric],
    labels: Sequence[Label],
    lookback: int,
    gap: int,
) -> DataFrame:
    """Metrics over days [day - lookback, day - gap] beside the labels of the day."""
    frame = (
        Window.partitionBy(*keys)
        .orderBy(F.unix_date("ev_day"))
        .rangeBetween(-lookback, -gap)
    )
    return daily.select(
        *keys,
        F.col("ev_day"),
        *[F.sum(m.name).over(frame).alias(m.name) for m in metrics],
        *[F.col(x.name) for x in labels],
    )


def _rolled_by_join(
    spine_days: DataFrame,
    daily: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[Metric],
    labels: Sequence[Label],
    lookback: int,
    gap: int,
    bin_days: int | None,
) -> DataFrame:
    """Same rows as ``rolled`` on the spine's days: a band join of at most one history
    row per day in the window, then a sum. The day itself joins too, for its labels."""
    left = spine_days.withColumns(
        {
            "_lo": F.unix_date("ev_day") - lookback,
            "_hi": F.unix_date("ev_day") - (0 if labels else gap),
            "_at": F.unix_date("ev_day"),
        }
    )
    right = daily.withColumn("_ev", F.unix_date("ev_day")).drop("ev_day")
    pairs = band_join(left, right, "_lo", "_hi", "_ev", keys=keys, bin_width=bin_days)
    past = F.col("_ev") <= F.col("_at") - gap
    today = F.col("_ev") == F.col("_at")
    sums = [
        *[F.sum(F.when(past, F.col(m.name))).alias(m.name) for m in metrics],
        *[F.max(F.when(today, F.col(x.name))).alias(x.name) for x in labels],
    ]
    if bin_days is None:
        return pairs.groupBy(*keys, "ev_day").agg(*sums)
    # Grouped as one struct: otherwise the lookup of the spine would take over this
    # partitioning and no longer sit on a shuffle of its own.
    key = F.struct(*keys, "ev_day").alias("_key")
    return pairs.groupBy(key).agg(*sums).select("_key.*", *[m.name for m in (*metrics, *labels)])


def pit_features(
    spine: DataFrame,
    events: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[Metric],
    labels: Sequence[Label] = (),
    day: str = "day",
    lookback: int = 21,
    gap: int = 1,
    days: tuple[dt.date, dt.date] | None = None,
    spine_in_events: bool = False,
    form: str = "window",
    bin_days: int = 30,
) -> DataFrame:
    """Spine rows with metrics over days [day - lookback, day - gap] of their entity.

    ``events`` is a stream from ``typed_events``. ``days`` are the first and last day
    of the spine, if known; the history is then cut to what those days can see. Set
    ``spine_in_events`` when every spine row's entity and day also occur in ``events``;
    otherwise the days of the spine are added as empty history. Every spine row comes
    out once, with zeros where it has no history or lacks a part of its key.
    """
    if form not in FORMS:
        raise ValueError(f"unknown form {form!r}, expected one of {FORMS}")
    if days:
        first, last = days
        spine = spine.where(days_between(day, first, last))
        events = events.where(
            days_between("ev_day", first - dt.timedelta(days=lookback), last)
        )
    if form != "window" or not spine_in_events:
        # Other types matter only where they are what brings in the spine's days.
        used = {m.event_type for m in (*metrics, *labels)}
        events = events.where(F.col("etype").isin(sorted(used)))
    columns = spine.columns
    spine_days = spine.select(*keys, F.col(day).alias("ev_day"))

    if form == "window":
        if not spine_in_events:
            empty = spine_days.withColumns(
                {
                    "etype": F.lit(None).cast("string"),
                    "amount": F.lit(None).cast("double"),
                }
            )
            events = events.unionByName(empty)
        daily = daily_rollup(events, keys, metrics, labels)
        lookup = rolled(daily, keys, metrics, labels, lookback, gap)
        if days:
            lookup = lookup.where(days_between("ev_day", *days))
    else:
        daily = daily_rollup(events, keys, metrics, labels)
        lookup = _rolled_by_join(
            spine_days.where(not_null([*keys, "ev_day"])).distinct(),
            daily,
            keys,
            metrics,
            labels,
            lookback,
            gap,
            bin_days if form == "binned" else None,
        )
    lookup = lookup.withColumnRenamed("ev_day", day)
    return spine.join(lookup, on=[*keys, day], how="left").select(
        *columns, *[m.final() for m in (*metrics, *labels)]
    )


def pit_from_log(
    log: DataFrame,
    keys: Sequence[str],
    detail: Sequence[str],
    spine_type: str,
    metrics: Sequence[Metric],
    labels: Sequence[Label],
    days: tuple[dt.date, dt.date],
    sets: Sequence[str] = (),
    day: str = "day",
    lookback: int = 21,
    gap: int = 1,
) -> DataFrame:
    """``pit_features`` where one log holds the spine and its history, read once.

    ``log`` has ``keys``, ``ev_day``, ``etype``, ``amount`` and the ``detail`` columns. The
    spine are the different events (by keys, day and detail) of ``spine_type`` on ``days``.
    Events of the ``sets`` types count once however often they occur.

    All events are grouped once, by everything but their amount. The spine and the rollup
    both start from that grouping; what tells their rows apart is an aggregate of it, which
    Spark cannot push below the grouping, and both mention the same aggregates. So the two
    branches stay equal down to the scan and share its exchange. For the same reason the
    lookup compares keys null-safe: it infers no filters, and holds no NULL keys to match.
    """
    first, last = days
    base = log.where(days_between("ev_day", first - dt.timedelta(days=lookback), last))
    totals = [m for m in metrics if m.total]
    value = {m.name: F.col("amount") if m.scale is None else to_units("amount", m.scale) for m in totals}
    serves = (F.col("etype") == spine_type) & days_between("ev_day", first, last)
    grouped = base.groupBy(*keys, "ev_day", "etype", *detail).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(F.when(F.col("etype") == m.event_type, value[m.name])).alias(f"_{m.name}") for m in totals],
        F.bool_or(serves).alias("_serves"),
        F.bool_and(not_null([*keys, "ev_day"])).alias("_keyed"),
    )
    names = ["_n", *(f"_{m.name}" for m in totals), "_serves", "_keyed"]
    # Always true: it only mentions every aggregate.
    same = F.size(F.array(*[F.col(c).cast("double") for c in names])) > 0
    once = F.when(F.col("etype").isin(list(sets)), F.lit(1)).otherwise(F.col("_n")) if sets else F.col("_n")

    def per_day(m: Metric) -> Column:
        hit = F.col("etype") == m.event_type
        if m.total:
            return F.sum(F.when(hit, F.col(f"_{m.name}"))).alias(m.name)
        return F.sum(F.when(hit, once).otherwise(0)).alias(m.name)

    daily = (
        grouped.where(F.col("_keyed") & same)
        .groupBy(*keys, "ev_day")
        .agg(*[per_day(m) for m in metrics], *[x.per_day() for x in labels])
    )
    lookup = rolled(daily, keys, metrics, labels, lookback, gap).where(days_between("ev_day", first, last))
    lookup = lookup.select(*[F.col(c).alias(f"_k_{c}") for c in (*keys, "ev_day")], *[x.name for x in (*metrics, *labels)])
    spine = grouped.where(F.col("_serves") & same).select(*keys, F.col("ev_day").alias(day), *detail)
    met = reduce(lambda a, b: a & b, [spine[c].eqNullSafe(lookup[f"_k_{c}"]) for c in keys], spine[day].eqNullSafe(lookup["_k_ev_day"]))
    return spine.join(lookup, met, "left").select(
        *spine.columns, *[m.final() for m in (*metrics, *labels)]
    )
