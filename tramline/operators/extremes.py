"""Group extremes with their owners, and the busiest group(s) with ties.

Both find a per-group (or global) extreme with a decomposable aggregate,
then join the extreme back to recover who holds it. No unpartitioned
window and no ``orderBy().collect()``: the only single-row step is the
global maximum, which is one row by construction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.operators.grouped import distinct_pairs

def extremes_with_owners(df: DataFrame, group: str, entity: str, measure: str, *,
                         min_out: str = "min_value", max_out: str = "max_value",
                         min_owner: str = "min_owner", max_owner: str = "max_owner") -> DataFrame:
    """Per group: min and max of ``measure`` and the entity having each, every
    holder of the one beside every holder of the other (``extreme_owners`` is
    the same without that product).

    Ties are kept: a group with ``a`` min-owners and ``b`` max-owners yields
    ``a * b`` rows (every min-owner paired with every max-owner) — that
    product is the defined result, and only the holders of an extreme take
    part in the final join, never the group's other rows. Equality is exact,
    so round the measure first when it is a computed double.
    """
    extremes = df.groupBy(group).agg(F.min(measure).alias(min_out), F.max(measure).alias(max_out))
    tagged = df.select(group, entity, measure).join(extremes, on=group)
    mins = (tagged.where(F.col(measure) == F.col(min_out))
            .select(group, min_out, max_out, F.col(entity).alias(min_owner)))
    maxs = (tagged.where(F.col(measure) == F.col(max_out))
            .select(group, F.col(entity).alias(max_owner)))
    return mins.join(maxs, on=group).select(group, min_out, max_out, min_owner, max_owner)


def extreme_owners(df: DataFrame, group: str, entity: str, measure: str) -> DataFrame:
    """Per group, the holders of its extremes in rows: (group, which, value,
    owner), ``which`` being "min" or "max". Ties give a row each, so the output
    never exceeds two rows per input row."""
    extremes = df.groupBy(group).agg(F.min(measure).alias("__min"), F.max(measure).alias("__max"))
    tagged = df.select(group, entity, measure).join(extremes, on=group)
    which = F.filter(F.array(F.when(F.col(measure) == F.col("__min"), "min"),
                             F.when(F.col(measure) == F.col("__max"), "max")),
                     lambda x: x.isNotNull())
    return tagged.select(group, F.explode(which).alias("which"), F.col(measure).alias("value"),
                         F.col(entity).alias("owner")).distinct()


def busiest_with_ties(df: DataFrame, group: str, member: str, *,
                      members_out: str = "members", count_out: str = "n_members",
                      as_text: bool = True) -> DataFrame:
    """The group(s) with the most distinct members, all ties kept, each with
    its sorted member list (text "a,b" or an array) and the member count.
    """
    pairs = distinct_pairs(df, group, member)
    listed = F.array_sort(F.collect_list(member))
    per_group = pairs.groupBy(group).agg(
        F.count(member).alias(count_out),
        (F.array_join(listed, ",") if as_text else listed).alias(members_out))
    # The maximum is one row; joining on the aggregate's own output keeps the
    # subtree below the exchange identical in both branches, so Spark reuses
    # the shuffle instead of recomputing the pairs.
    top = per_group.agg(F.max(count_out).alias(count_out))
    return per_group.join(F.broadcast(top), on=count_out).select(group, members_out, count_out)
