"""Grouped operators: shares, distinct members, running totals, histograms.

Every aggregate here is decomposable (sum, count, min, max, HLL sketch) or
is preceded by a de-duplicating ``groupBy``, so Spark runs a partial
aggregate before the shuffle and a hot group never ships its raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.functions.scalars import bucket_index, bucket_label, percent


def share_by(df: DataFrame, group: str | Sequence[str], flag: str, *,
             pct: str = "percentage", total: str = "numMeasurements",
             ones: str = "congestionMeasurements") -> DataFrame:
    """Per group: rows, rows with ``flag == 1``, and their share in percent."""
    groups = [group] if isinstance(group, str) else list(group)
    agg = df.groupBy(*groups).agg(
        F.count(F.lit(1)).alias(total),
        F.count_if(F.col(flag) == 1).alias(ones),
    )
    return agg.select(*groups, percent(ones, total).alias(pct), total, ones)


def distinct_pairs(df: DataFrame, group: str, member: str) -> DataFrame:
    """Distinct (group, member) pairs; partial de-duplication before the shuffle."""
    return df.select(group, member).distinct()


def distinct_count(df: DataFrame, group: str, member: str, *, out: str,
                   exact: bool = True, rsd: float = 0.05) -> DataFrame:
    """Distinct members per group, exact (two-level aggregate) or HLL++."""
    if exact:
        # count(member): a NULL member is not a member (as in count(DISTINCT ...)).
        return distinct_pairs(df, group, member).groupBy(group).agg(F.count(member).alias(out))
    return df.groupBy(group).agg(F.approx_count_distinct(member, rsd).alias(out))


def distinct_members(df: DataFrame, group: str, member: str, *, out: str = "members",
                     count: str | None = "n_members", as_text: bool = True) -> DataFrame:
    """Per group: the sorted distinct members (text "a,b,c" or an array).

    The list is built from de-duplicated pairs, so its length is the group's
    number of distinct members, never its number of rows.
    """
    pairs = distinct_pairs(df, group, member)
    members = F.array_sort(F.collect_list(member))
    cols = [(F.array_join(members, ",") if as_text else members).alias(out)]
    if count:
        cols.append(F.count(member).alias(count))
    return pairs.groupBy(group).agg(*cols)


def running_total(df: DataFrame, key: str, value: str, *, out: str = "total") -> DataFrame:
    """Total of ``value`` per key (the state a running total converges to)."""
    return df.groupBy(key).agg(F.sum(value).alias(out))


def bucket_histogram(df: DataFrame, value: str, size: float, *, count: str = "n") -> DataFrame:
    """Fixed-width histogram: (bucket, bucket_range ``lo_hi``, count)."""
    return (df.groupBy(bucket_index(value, size).alias("bucket"))
            .agg(F.count(F.lit(1)).alias(count))
            .select("bucket", bucket_label("bucket", size).alias("bucket_range"), count))
