"""Interval operators: month pieces, census, validity ranges, lookups in time and overlaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import model
from ..functions import calendar_columns, sql_round
from ..session import staged
from .keys import dense_key
from .quality import first_per_key, holds


def day(value: str | Column) -> Column:
    """A day given as ISO text or as an expression (a scalar subquery, for example)."""
    return F.to_date(F.lit(value)) if isinstance(value, str) else value


def calendar(one_row: DataFrame, first: str | Column, last: str | Column) -> DataFrame:
    """One row per day with its calendar attributes; ``one_row`` is any single-row frame."""
    bounds = one_row.select(day(first).alias("_a"), day(last).alias("_b"))
    days = F.when(F.col("_a") <= F.col("_b"), F.sequence("_a", "_b"))
    return bounds.select(F.explode(days).alias("_d")).select(*calendar_columns(F.col("_d")))


def analysis_window(snapshots: DataFrame, month: str) -> DataFrame:
    """First snapshot month to the last day of the latest one, as a single row."""
    start, end = model.DEFAULT_WINDOW
    return snapshots.agg(
        F.coalesce(F.min(month), day(start)).alias("window_start"),
        F.coalesce(F.last_day(F.max(month)), day(end)).alias("window_end"),
    )


def window_bounds(window: DataFrame) -> tuple[Column, Column]:
    """The window's two dates as scalar subqueries: no driver round trip and no cross join."""
    return window.select("window_start").scalar(), window.select("window_end").scalar()


def explode_months(df: DataFrame, first: str, last: str) -> DataFrame:
    """One row per calendar month touched by [first, last]; reversed or NULL spans give none."""
    month = F.trunc(first, "MM")
    span = (F.year(last) - F.year(first)) * 12 + F.month(last) - F.month(first)
    steps = F.when(span >= 0, F.sequence(F.lit(0), span))
    return df.withColumn("_step", F.explode(steps)).withColumn("month_start", F.add_months(month, F.col("_step"))).drop(
        "_step"
    )


def clip_stays(stays: DataFrame, start: str | Column, end: str | Column) -> DataFrame:
    """Stays cut to the window as closed day ranges [first_day, last_day].

    A day counts when admit <= day < discharge, so the discharge day itself never does.
    Stays without an admit date or without a day in the window are left out.
    """
    return (
        stays.withColumns({"_ws": day(start), "_we": day(end)})
        .withColumn("first_day", F.greatest("admit_date", "_ws"))
        .withColumn("last_day", F.least(F.coalesce(F.date_sub("discharge_date", 1), "_we"), "_we"))
        .filter(F.col("admit_date").isNotNull() & (F.col("first_day") <= F.col("last_day")))
        .drop("_ws", "_we")
    )


def monthly_census(
    stays: DataFrame, start: str | Column, end: str | Column, by: Sequence[str] = ("community_id",)
) -> DataFrame:
    """Resident-days per month and group.

    A stay contributes two marks, its first day and the day after its last, however long it
    is. They are added up per group and day (combined map-side), summed in time, and the
    spans of constant census between marks are cut at month ends. Only the marks of a stay
    are shuffled, and a group's window holds at most one row per day of the calendar.
    """
    marks = F.array(
        F.struct(F.col("first_day").alias("_from"), F.lit(1).alias("_n")),
        F.struct(F.date_add("last_day", 1).alias("_from"), F.lit(-1).alias("_n")),
    )
    daily = (
        clip_stays(stays, start, end).select(*by, F.inline(marks)).groupBy(*by, "_from").agg(F.sum("_n").alias("_n"))
    )
    in_time = Window.partitionBy(*by).orderBy("_from")
    spans = (
        daily.withColumn("_held", F.sum("_n").over(in_time.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_to", F.date_sub(F.lead("_from").over(in_time), 1))
        .filter("_held > 0")
    )
    days = F.datediff(F.least("_to", F.last_day("month_start")), F.greatest("_from", "month_start")) + 1
    return (
        explode_months(spans, "_from", "_to")
        .groupBy("month_start", *by)
        .agg(F.sum(F.col("_held") * days).alias("resident_days"))
    )


def stay_days(stays: DataFrame, start: str | Column, end: str | Column) -> DataFrame:
    """Total resident-days of the window in closed form, one row.

    Written on its own, not with :func:`clip_stays`, as checks hold the daily fact against it.
    """
    after = F.date_add(day(end), 1)
    until = F.least(F.coalesce(F.col("discharge_date"), after), after)
    days = F.greatest(F.datediff(until, F.greatest(F.col("admit_date"), day(start))), F.lit(0))
    inside = stays.filter(F.col("admit_date").isNotNull()).withColumn("_days", days).filter("_days > 0")
    return inside.agg(F.sum("_days").alias("resident_days"))


def anew(df: DataFrame, key: str) -> DataFrame:
    """``df`` dealt by ``key`` once more, though it lies so already: what sorts it next then runs in tasks of
    its own, which don't hold the sorts of the steps before as well. (Named once, the key would be the same
    partitioning, and Spark would leave the shuffle out.)"""
    return df.repartition(F.col(key), F.col(key))


def census_segments(
    stays: DataFrame, ranges: DataFrame, start: str | Column, end: str | Column
) -> DataFrame:
    """Stays cut into [seg_start, seg_end] pieces of constant care level; gaps keep a NULL level.

    The lookup runs once per (stay, range) instead of once per day. A resident's ranges are
    bounded by days times levels, so the per-resident window stays small.
    """
    stay = clip_stays(stays, start, end).select("resident_id", "community_id", "first_day", "last_day")
    level = ranges.filter(
        F.col("effective_from").isNotNull()
        & (F.col("effective_to").isNull() | (F.col("effective_to") >= F.col("effective_from")))
    ).select(
        F.col("resident_id").alias("_rid"), "care_level_key", "care_level", "effective_from", "effective_to"
    )
    covered = (F.col("effective_from") <= F.col("last_day")) & (
        F.col("effective_to").isNull() | (F.col("effective_to") >= F.col("first_day"))
    )
    joined = (
        stay.join(level, (F.col("resident_id") == F.col("_rid")) & covered, "left")
        .withColumn("_f", F.when(F.col("_rid").isNotNull(), F.greatest("effective_from", "first_day")))
        .withColumn("_t", F.when(F.col("_rid").isNotNull(), F.least(F.coalesce("effective_to", "last_day"), "last_day")))
    )
    joined = anew(joined.drop("_rid", "effective_from", "effective_to"), "resident_id")
    in_order = Window.partitionBy("resident_id").orderBy("_f", "_t", "care_level_key")
    seen = F.max("_t").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    last = F.lead(F.lit(1)).over(in_order).isNull()
    joined = joined.withColumn("_seen", seen).withColumn("_last", last)

    def piece(a: Column, b: Column, key: Column, name: Column) -> Column:
        return F.struct(
            a.alias("seg_start"), b.alias("seg_end"), key.alias("care_level_key"), name.alias("care_level")
        )

    no_key, no_level = F.lit(None).cast("bigint"), F.lit(None).cast("string")
    pieces = F.array(
        piece(
            F.coalesce(F.date_add("_seen", 1), F.col("first_day")),
            F.coalesce(F.date_sub("_f", 1), F.col("last_day")),
            no_key,
            no_level,
        ),
        piece(F.col("_f"), F.col("_t"), F.col("care_level_key"), F.col("care_level")),
        piece(
            F.when(F.col("_last"), F.date_add(F.greatest("_t", "_seen"), 1)), F.col("last_day"), no_key, no_level
        ),
    )
    kept = F.filter(pieces, lambda p: p["seg_start"] <= p["seg_end"])
    return joined.select("resident_id", "community_id", F.explode(kept).alias("p")).select(
        "resident_id", "community_id", "p.*"
    )


def census_days(segments: DataFrame) -> DataFrame:
    """One row per resident and day in census."""
    return segments.select(
        F.explode(F.sequence("seg_start", "seg_end")).alias("date_key"),
        "resident_id",
        "community_id",
        "care_level_key",
        "care_level",
    )


def segment_days() -> Column:
    return F.datediff("seg_end", "seg_start") + 1


def level_ranges(history: DataFrame, residents: DataFrame) -> DataFrame:
    """Validity ranges of care levels (type 2 history), without a surrogate key.

    A resident's events are its recorded changes, the level held since admission when the
    first change names a previous level, or, without any history, the snapshot level since
    admission. A range ends the day before the next event, the last one at the discharge.
    History and residents are each shuffled once, by resident. The cleaned history has at most
    one row per resident, day and level, which bounds the per-resident windows.
    """
    by_date = Window.partitionBy("resident_id").orderBy(
        F.col("change_date").asc_nulls_last(), "new_level", "previous_level", "reason"
    )
    changes = history.select("resident_id", "change_date", "previous_level", "new_level", "reason").withColumn(
        "_nth", F.row_number().over(by_date)
    )
    # NOT IN semantics: one history row without a resident rules out every "no history" range
    unknown_keys = history.agg(F.coalesce(F.bool_or(F.col("resident_id").isNull()), F.lit(False)))
    known = residents.select("resident_id", "admit_date", "discharge_date", "care_level")
    both = known.join(changes, "resident_id", "left").withColumn("_blocked", unknown_keys.scalar())

    def event(since: Column, level: Column, why: Column) -> Column:
        return F.struct(since.alias("effective_from"), level.alias("care_level"), why.alias("change_reason"))

    events = F.array(
        F.when(
            F.col("new_level").isNotNull() & F.col("change_date").isNotNull(),
            event(F.col("change_date"), F.col("new_level"), F.col("reason")),
        ),
        F.when(
            (F.col("_nth") == 1)
            & F.col("previous_level").isNotNull()
            & (F.col("admit_date") < F.col("change_date")),
            event(F.col("admit_date"), F.col("previous_level"), F.lit(model.REASON_ANCHOR)),
        ),
        F.when(
            F.col("_nth").isNull() & ~F.col("_blocked") & F.col("care_level").isNotNull(),
            event(F.col("admit_date"), F.col("care_level"), F.lit(model.REASON_NO_HISTORY)),
        ),
    )
    raised = F.explode(F.filter(events, lambda e: e.isNotNull()))
    in_time = Window.partitionBy("resident_id").orderBy(
        F.col("effective_from").asc_nulls_last(), "care_level", "change_reason"
    )
    return (
        anew(both.select("resident_id", "discharge_date", raised.alias("e")).select("resident_id", "discharge_date", "e.*"), "resident_id")
        .withColumn("_next", F.lead("effective_from").over(in_time))
        .select(
            "resident_id",
            "care_level",
            "effective_from",
            F.coalesce(F.date_sub("_next", 1), F.col("discharge_date")).alias("effective_to"),
            F.col("_next").isNull().alias("is_current"),
            "change_reason",
        )
    )


def scd2(history: DataFrame, residents: DataFrame) -> DataFrame:
    """The care-level dimension: validity ranges under a dense surrogate key."""
    order = ["resident_id", "effective_from", "care_level", "change_reason"]
    return dense_key(level_ranges(history, residents), order, "care_level_key")


def as_of(facts: DataFrame, ranges: DataFrame, key: str, on: Column, take: Sequence[str]) -> DataFrame:
    """Left lookup of the range valid on a date: equal key, closed validity range.

    The equal key keeps this a hash or sort-merge join with a residual range test. A key that
    holds a large share of the facts is cut on the fact side by the adaptive skew split; where
    only counts are needed, count per key and day before calling this. Facts of a key meet all its
    ranges: for keys with very many of both use :func:`as_of_sorted`.
    """
    scd = ranges.select(
        F.col("resident_id").alias("_rid"),
        F.col("effective_from").alias("_from"),
        F.col("effective_to").alias("_to"),
        *take,
    )
    valid = (on >= F.col("_from")) & (F.col("_to").isNull() | (on <= F.col("_to")))
    return facts.join(scd, (F.col(key) == F.col("_rid")) & valid, "left").drop("_rid", "_from", "_to")


def earlier_max(df: DataFrame, key: str, order: Sequence[Column], value: Column, name: str) -> DataFrame:
    """``df`` with the largest ``value`` among the rows of the same key that come before a row in
    ``order`` (which must tell rows apart); NULL keys are left out.

    Rows are dealt by ranges of (key, order), so a key with most of the rows spreads over many tasks. Each
    task finds the maxima within its range; what a key has reached at the end of a range is carried into
    the next ones. Only one row per range passes through one task.
    """
    placed = df.filter(F.col(key).isNotNull()).withColumn("_value", value)
    placed = placed.repartitionByRange(F.col(key).asc(), *order).withColumn("_part", F.spark_partition_id())
    placed = staged(placed, "in-order")
    inside = Window.partitionBy("_part", key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("_part").agg(F.max(F.struct(F.col(key).alias("key"), F.col("_value").alias("value"))).alias("last"))
    upto = Window.partitionBy("last.key").orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)
    reached = parts.select("_part", "last.key", F.max("last.value").over(upto).alias("value"))
    # a key that began in an earlier range is the last key of the range just before
    before = Window.orderBy("_part")
    entered = reached.select("_part", F.lag(F.struct("key", "value")).over(before).alias("_entered"))
    carried = F.when(F.col("_entered.key") == F.col(key), F.col("_entered.value"))
    found = placed.withColumn("_inside", F.max("_value").over(inside)).join(entered, "_part")
    return found.withColumn(name, F.greatest("_inside", carried)).drop("_part", "_value", "_inside", "_entered")


def as_of_sorted(facts: DataFrame, ranges: DataFrame, key: str, on: Column, take: Sequence[str]) -> DataFrame:
    """As :func:`as_of`, for ranges of a key that don't overlap, as those of a type 2 history.

    Facts and the beginnings of ranges are put in one order, and each fact takes the last beginning
    before it (see :func:`earlier_max`); no fact meets more than one range, however many a key has.
    Reversed ranges hold no day and are left out. Facts without key or date keep NULLs.
    """
    held = ranges.filter("effective_to is null or effective_to >= effective_from").filter("effective_from is not null")
    dated = facts.withColumn("_on", on)
    usable = F.col(key).isNotNull() & F.col("_on").isNotNull()
    starts = held.select(
        F.col(key).alias("_k"), F.col("effective_from").alias("_d"), F.lit(0).alias("_kind"), F.lit(0).cast("bigint").alias("_tie"),
        F.struct(F.col("effective_from").alias("_from"), F.col("effective_to").alias("_to"), *take).alias("_held"),
    )
    row = F.struct(*facts.columns)
    asked = dated.filter(usable).select(
        F.col(key).alias("_k"), F.col("_on").alias("_d"), F.lit(1).alias("_kind"), F.xxhash64(*facts.columns).alias("_tie"), row.alias("_row")
    )
    both = starts.unionByName(asked, allowMissingColumns=True)
    found = earlier_max(both, "_k", [F.col("_d").asc(), F.col("_kind").asc(), F.col("_tie").asc()], F.col("_held"), "_last").filter("_kind = 1")
    valid = F.col("_last._to").isNull() | (F.col("_d") <= F.col("_last._to"))
    looked_up = found.select("_row.*", *[F.when(valid, F.col(f"_last.{c}")).alias(c) for c in take])
    return looked_up.unionByName(dated.filter(~usable).drop("_on"), allowMissingColumns=True)


def prorate(leases: DataFrame, start: str | Column, end: str | Column) -> DataFrame:
    """Monthly revenue per lease: rate times active days over days in the month.

    The months are whole calendar months, even where the window starts or ends inside one.
    """
    bounded = (
        leases.filter(F.col("monthly_rate").isNotNull() & F.col("move_in_date").isNotNull())
        .withColumns({"_ws": F.trunc(day(start), "MM"), "_we": F.last_day(day(end))})
        .filter(
            (F.col("move_in_date") <= F.col("_we"))
            & (F.col("move_out_date").isNull() | (F.col("move_out_date") > F.col("_ws")))
        )
        .withColumn("_first", F.greatest("move_in_date", "_ws"))
        .withColumn("_last", F.least(F.coalesce(F.date_sub("move_out_date", 1), "_we"), "_we"))
    )
    pieces = explode_months(bounded, "_first", "_last").withColumn("_me", F.last_day("month_start"))
    upto = F.least(F.coalesce(F.date_sub("move_out_date", 1), F.col("_me")), F.col("_me"))
    return (
        pieces.withColumn("active_days", F.datediff(upto, F.greatest("move_in_date", "month_start")) + 1)
        .withColumn("days_in_month", F.day("_me"))
        .withColumn(
            "revenue",
            sql_round(F.col("monthly_rate").cast("double") * F.col("active_days") / F.col("days_in_month"), 2),
        )
        .select(
            "month_start",
            "lease_id",
            "resident_id",
            "unit_id",
            "community_id",
            "active_days",
            "days_in_month",
            "monthly_rate",
            "revenue",
        )
    )


def steepest_rise(
    snaps: DataFrame, key: str, month: str, score: str, within_days: int = 90, at_least: float = 2
) -> DataFrame:
    """Per key, the largest score rise between two snapshots at most ``within_days`` apart.

    For each later snapshot the best partner is the lowest score in the preceding days, so a
    range frame finds it without building pairs. Snapshots are unique per key and month.
    """
    recent = Window.partitionBy(key).orderBy(F.unix_date(month)).rangeBetween(-within_days, -1)
    low = F.min(F.struct(F.col(score).alias("s"), F.col(month).alias("m"))).over(recent)
    rises = (
        snaps.filter(F.col(score).isNotNull())
        .withColumn("_low", low)
        .select(
            key,
            F.col("_low.m").alias("from_month"),
            F.col("_low.s").alias("from_acuity"),
            F.col(month).alias("to_month"),
            F.col(score).alias("to_acuity"),
            (F.col(score) - F.col("_low.s")).alias("acuity_increase"),
        )
        .filter(F.col("acuity_increase") >= at_least)
    )
    return first_per_key(rises, [key], [F.desc("acuity_increase"), F.asc("to_month"), F.asc("from_month")])


def overlap_pairs(
    df: DataFrame, key: str, start: str, end: str, closed: bool = False, may_reverse: bool = True
) -> DataFrame:
    """Number of overlapping interval pairs per key, for keys that have any.

    Ranges are half-open [start, end), or closed [start, end]; an open end reaches far ahead.
    Instead of pairing intervals, starts and ends are counted per key and day (combined
    map-side, so a hot key shrinks to one row per day) and swept in time: an interval overlaps
    those still open when it starts. Empty intervals overlap those open around their day.
    Reversed intervals (end before start), which only defects produce, overlap exactly the
    intervals that contain them, see :func:`containers`; ``may_reverse=False`` skips that part where
    they are excluded.
    """
    tail = F.coalesce(F.col(end), day(model.OPEN_END))
    spans = df.select(
        F.col(key), F.col(start).alias("_s"), (F.date_add(tail, 1) if closed else tail).alias("_e")
    ).filter(F.col(key).isNotNull() & F.col("_s").isNotNull())

    def mark(at: Column, starts: int, ends: int, points: int) -> Column:
        return F.struct(
            at.alias("_d"), F.lit(starts).alias("_in"), F.lit(ends).alias("_out"), F.lit(points).alias("_pt")
        )

    marks = F.when(
        F.col("_s") < F.col("_e"), F.array(mark(F.col("_s"), 1, 0, 0), mark(F.col("_e"), 0, 1, 0))
    ).when(F.col("_s") == F.col("_e"), F.array(mark(F.col("_s"), 0, 0, 1)))
    daily = (
        spans.select(key, F.inline(marks))
        .groupBy(key, "_d")
        .agg(F.sum("_in").alias("_in"), F.sum("_out").alias("_out"), F.sum("_pt").alias("_pt"))
    )
    earlier = Window.partitionBy(key).orderBy("_d").rowsBetween(Window.unboundedPreceding, -1)
    still_open = F.coalesce(F.sum(F.col("_in") - F.col("_out")).over(earlier), F.lit(0)) - F.col("_out")
    # in whole numbers: doubles would lose pairs from 2^53 on
    met = (F.col("_in") + F.col("_pt")) * F.col("_open") + F.call_function("div", F.col("_in") * (F.col("_in") - 1), F.lit(2))
    pairs = daily.withColumn("_open", still_open).select(key, met.alias("pairs"))
    if may_reverse:
        pairs = pairs.unionByName(containers(spans, key))
    return pairs.groupBy(key).agg(F.sum("pairs").alias("pairs")).filter("pairs > 0")


def overlap_witnesses(df: DataFrame, key: str, id: str, start: str, end: str, closed: bool = False) -> DataFrame:
    """(key, id, witness): every interval that overlaps one which begins no later, with the one of those
    that ends last (of equal ends the largest ``id``).

    Intervals are put in order by start, end and id, and the latest end so far is carried along (see
    :func:`earlier_max`), so nothing is paired. An overlap between any two intervals makes the later of
    them one of these rows. Open ends reach far ahead; empty and reversed intervals take no part.
    """
    tail = F.coalesce(F.col(end), day(model.OPEN_END))
    spans = df.select(F.col(key), F.col(id), F.col(start).alias("_s"), (F.date_add(tail, 1) if closed else tail).alias("_e")).filter("_s < _e")
    order = [F.col(c).asc() for c in ("_s", "_e", id)]
    latest = F.struct(F.col("_e").alias("e"), F.col(id).alias("id"))
    found = earlier_max(spans, key, order, latest, "_latest").filter(F.col("_latest.e") > F.col("_s"))
    return found.select(key, id, F.col("_latest.id").alias("witness"))


def repeated_days(segments: DataFrame, key: str = "resident_id") -> DataFrame:
    """(key, days): how many days two or more of a key's closed segments [seg_start, seg_end] share, for
    keys that have any. Days are not laid out: a segment shares with the ones before it the days up to
    their latest end, and what it shares that earlier ones already did counts once."""
    in_order = Window.partitionBy(key).orderBy("seg_start", "seg_end").rowsBetween(Window.unboundedPreceding, -1)
    latest = F.max("seg_end").over(in_order)
    shared = segments.withColumn("_latest", latest).withColumn("_upto", F.when(F.col("_latest").isNotNull(), F.least("_latest", "seg_end")))
    counted = F.coalesce(F.date_add(F.max("_upto").over(in_order), 1), F.col("seg_start"))
    days = F.datediff("_upto", F.greatest("seg_start", counted)) + 1
    return shared.withColumn("_days", days).filter("_days > 0").groupBy(key).agg(F.sum("_days").alias("days"))


# days are numbered from here within so many bits (some eleven thousand years)
FIRST_DAY, DAY_BITS = "0001-01-01", 22


def containers(spans: DataFrame, key: str) -> DataFrame:
    """(key, pairs): how often an interval [_s, _e) of a key contains a reversed one (_e before _s).

    Intervals are not paired. Each stands, by its start, in one block of days of every size 1, 2, 4, ...;
    the days before a reversed interval's end are a handful of such blocks. Within a block, intervals
    and reversed ones are counted per day and swept from the latest end down, so a task sees no more
    rows than there are days, however many rows the key has. Only keys with reversed rows are looked at.
    """
    number = lambda c: F.datediff(F.col(c), F.to_date(F.lit(FIRST_DAY)))
    days = spans.select(F.col(key).alias("_k"), number("_s").alias("_from"), number("_e").alias("_to"))
    turned = days.filter("_to < _from").groupBy("_k", "_from", "_to").agg(F.count(F.lit(1)).alias("_n"))
    proper = days.filter("_from < _to").join(turned.select("_k").distinct(), "_k", "left_semi")
    sizes = F.explode(F.sequence(F.lit(0), F.lit(DAY_BITS - 1)))
    around = proper.select("_k", "_to", "_from", sizes.alias("_size")).select(
        "_k", "_size", F.expr("shiftright(_from, _size)").alias("_block"), F.col("_to").alias("_d"), F.lit(1).alias("_in"), F.lit(0).alias("_ask")
    )
    inner = turned.select("_k", "_from", "_to", "_n", sizes.alias("_size")).filter("shiftright(_to, _size) % 2 = 1").select(
        "_k", "_size", F.expr("shiftright(_to, _size) - 1").alias("_block"), F.col("_from").alias("_d"), F.lit(0).alias("_in"), F.col("_n").alias("_ask")
    )
    daily = around.unionByName(inner).groupBy("_k", "_size", "_block", "_d").agg(F.sum("_in").alias("_in"), F.sum("_ask").alias("_ask"))
    later = Window.partitionBy("_k", "_size", "_block").orderBy(F.desc("_d")).rowsBetween(Window.unboundedPreceding, -1)
    met = daily.withColumn("_open", F.coalesce(F.sum("_in").over(later), F.lit(0)))
    return met.groupBy(F.col("_k").alias(key)).agg(F.sum(F.col("_ask") * F.col("_open")).cast("bigint").alias("pairs"))


def multiple_current(ranges: DataFrame) -> DataFrame:
    """Residents with more than one current range."""
    return (
        ranges.filter(holds(F.col("is_current")))
        .groupBy("resident_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )


def since_months(anchor: Column, months: int) -> Column:
    """The day ``months`` before the anchor, clamped to the month's end."""
    return F.add_months(anchor, -months)

