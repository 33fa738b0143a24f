"""Row-quality operators: deduplication, reject splits, field repair and the quarantine log."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import raw_json
from ..model import QUARANTINE_COLUMNS

LOAD_ORDER = ("_source_file", "_row_seq")


def holds(predicate: Column) -> Column:
    """A predicate that is never NULL: unknown counts as false on both sides of a split."""
    return F.coalesce(predicate, F.lit(False))


def once_per_row(df: DataFrame, **values: Column) -> DataFrame:
    """``df`` with ``values`` as further columns, each computed once per row.

    A filter on plain columns is moved below them, with what they stand for written out, and computed,
    wherever the filter names them; one on the fields of a generated row stays above.
    """
    return df.select("*", F.inline(F.array(F.struct(*[v.alias(n) for n, v in values.items()]))))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key under ``order``.

    The rank filter lets Spark cut every map task's output to ``n`` rows per key before the
    shuffle, so a key that holds a third of the table still sends only ``n`` rows per task.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).filter(F.col("_rank") <= n).drop("_rank")


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str] = LOAD_ORDER) -> DataFrame:
    """One row per key: the last one in load order."""
    return first_per_key(df, keys, [F.col(c).desc_nulls_last() for c in order])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] = LOAD_ORDER) -> DataFrame:
    """One row per key: the first one in load order."""
    return first_per_key(df, keys, [F.col(c).asc_nulls_last() for c in order])


def semi_join_null_safe(df: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose keys occur in ``wanted``, with NULL keys matching each other."""
    renamed = wanted.select(*[F.col(k).alias(f"_w{i}") for i, k in enumerate(keys)])
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_w{i}")) for i, k in enumerate(keys)])
    return df.join(renamed, match, "left_semi")


def duplicate_members(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every member of a key group with more than one row.

    Counts are combined map-side and joined back, so a hot group is never held by one task;
    the join itself is open to the adaptive skew split.
    """
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return semi_join_null_safe(df, repeated, keys)


def version_counts(df: DataFrame, keys: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """Rows and distinct payload versions per key; NULL payload fields take part in the comparison."""
    versions = df.groupBy(*keys, F.struct(*payload).alias("_version")).agg(F.count(F.lit(1)).alias("_n"))
    return versions.groupBy(*keys).agg(
        F.sum("_n").alias("copies"), F.count(F.lit(1)).alias("versions")
    )


def conflicting_keys(df: DataFrame, keys: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """Keys whose rows disagree on the payload: the smallest and largest version differ."""
    version = F.struct(*payload)
    return (
        df.groupBy(*keys)
        .agg(F.min(version).alias("_low"), F.max(version).alias("_high"))
        .filter(~F.col("_low").eqNullSafe(F.col("_high")))
        .select(*keys)
    )


def evidence(df: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """One row per record: its key and its ``fields`` as JSON text, whole. Nothing is gathered per
    key, so a key with very many records costs no task more than others."""
    return df.select(key, raw_json(*fields).alias("raw_value"))


def most_frequent(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """The most frequent value per key, the smallest on ties, NULLs ignored."""
    tally = df.filter(F.col(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("_n"))
    return tally.groupBy(key).agg(F.min_by(value, F.struct(-F.col("_n"), F.col(value))).alias(name))


def contested_winners(
    df: DataFrame, entity: str, period: str, value: str, order: Sequence[str] = LOAD_ORDER
) -> DataFrame:
    """For each (entity, period) with several rows, the order columns of the row to keep.

    The row whose ``value`` equals the entity's most frequent value wins, else the first one.
    Everything after the first grouping works on per-value counts, so copies of one row
    collapse before they are shuffled; the counts are shuffled once more, by entity, for all the rest.
    """
    place = F.struct(*order)
    tally = df.filter(F.col(entity).isNotNull()).groupBy(entity, period, value).agg(
        F.count(F.lit(1)).alias("_n"), F.min(place).alias("_first")
    )
    per_value, per_entity = Window.partitionBy(entity, value), Window.partitionBy(entity)
    usual = F.min(F.when(F.col(value).isNotNull(), F.struct((-F.col("_m")).alias("m"), F.col(value).alias("v")))).over(per_entity)["v"]
    differs = ~holds(F.col(value) == F.col("_usual"))
    return (
        tally.repartition(F.col(entity))
        .withColumn("_m", F.sum("_n").over(per_value))
        .withColumn("_usual", usual)
        .groupBy(entity, period)
        .agg(F.min(F.struct(differs.alias("differs"), F.col("_first"))).alias("_best"), F.sum("_n").alias("_rows"))
        .filter("_rows > 1")
        .select(entity, period, F.col("_best._first").alias("_winner"))
    )


def reject_reason(rules: Sequence[tuple[Column, str | Column]]) -> Column:
    """The reason of the first rule that holds, or NULL for an acceptable row."""
    return F.coalesce(
        *[F.when(holds(bad), F.lit(reason) if isinstance(reason, str) else reason) for bad, reason in rules]
    )


def split_rejects(df: DataFrame, rules) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): rejected rows carry the reason in ``_reason``."""
    judged = df.withColumn("_reason", reject_reason(rules))
    return judged.filter("_reason is null").drop("_reason"), judged.filter("_reason is not null")


def repair_field(df: DataFrame, field: str, bad: Column) -> DataFrame:
    """NULL the bad values of one field, keep the row, and flag the repair in ``_repaired``."""
    return df.withColumn("_repaired", holds(bad)).withColumn(
        field, F.when(~F.col("_repaired"), F.col(field))
    )


@dataclass(frozen=True)
class Finding:
    """One kind of quarantine entry a cleaner can raise for a row."""

    when: Column
    reason: Column | str
    action: str
    raw: Sequence


def quarantine_log(df: DataFrame, table: str, key: str, findings: Sequence[Finding]) -> DataFrame:
    """All findings of all rows in one pass over ``df``. A row's findings are told by their numbers first;
    reasons and raw values are put together for those found, and only where they are read."""
    n = range(len(findings))
    if len(findings) == 1:
        found = df.filter(holds(findings[0].when)).withColumn("_finding", F.lit(0))
    else:
        raised = F.array_compact(F.array(*[F.when(holds(f.when), F.lit(i)) for i, f in zip(n, findings)]))
        found = df.withColumn("_finding", F.explode(raised))

    def of_finding(values: Sequence[Column]) -> Column:
        chosen = F.lit(None)
        for i in reversed(n):
            chosen = F.when(F.col("_finding") == i, values[i]).otherwise(chosen)
        return chosen

    return found.select(
        F.lit(table).alias("source_table"),
        F.coalesce(F.col(key).cast("string"), F.lit("None")).alias("business_key"),
        of_finding([F.lit(f.reason) if isinstance(f.reason, str) else f.reason for f in findings]).alias("reason"),
        of_finding([F.lit(f.action) for f in findings]).alias("action_taken"),
        of_finding([raw_json(*f.raw) for f in findings]).alias("raw_value"),
        F.current_timestamp().alias("quarantined_at"),
    )


def quarantine_rows(df: DataFrame, table: str) -> DataFrame:
    """Shape ready-made entries (business_key, reason, action_taken, raw_value) as quarantine rows."""
    return df.select(
        F.lit(table).alias("source_table"),
        F.col("business_key").cast("string").alias("business_key"),
        "reason",
        "action_taken",
        "raw_value",
        F.current_timestamp().alias("quarantined_at"),
    )


def collect_quarantine(logs: Sequence[DataFrame]) -> DataFrame:
    """The union of every cleaner's log."""
    return reduce(lambda a, b: a.unionByName(b), [log.select(*QUARANTINE_COLUMNS) for log in logs])


def quarantine_summary(log: DataFrame) -> DataFrame:
    """Entries per table, reason and action."""
    return log.groupBy("source_table", "reason", "action_taken").agg(
        F.count(F.lit(1)).alias("rows_affected")
    )
