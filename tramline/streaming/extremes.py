"""Extremes of running averages: per group, who has the lowest and the highest.

An average moves both ways, so a minimum may have to be taken back: the station
that held it rises, or one more reading makes another the lowest. A plain
streaming ``min`` cannot do that. Here the averages themselves are state, in two
steps:

1. keyed state for (group, bucket of entities): total and count of each entity.
   A trigger adds its readings and tells the bucket's lowest and highest average
   with all holders. A bucket has ``1 / buckets`` of the entities, whatever the
   number of readings is, so neither its state nor a call grows with the stream.
2. a table of one row per (group, bucket), carried from epoch to epoch: a new
   row of a bucket replaces its old one, which retracts what it said. The
   group's extremes are those of its buckets, told whole after every epoch.

After each epoch the result equals the batch operator over all readings so far.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Decimal

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tramline.session import fresh_dir
from tramline.streaming.reorder import STORE
from tramline.streaming.runner import EPOCH, await_end, carried, epochs

_BUCKET = "bucket"
STATE = "entities array<string>, totals array<double>, counts array<long>"


def rounded(total: float, count: int, digits: int) -> float:
    """``round(avg, digits)`` as Spark has it: half up, of the shortest decimal."""
    exact = Decimal(repr(total / count))
    return float(exact.quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


def bucket_averages(names: list[str], digits: int) -> StatefulProcessor:
    """Averages of a bucket's entities. A local class, which goes to Spark's
    workers by value."""

    class BucketAverages(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.known = handle.getValueState("known", STATE)

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues
                            ) -> Iterator[pd.DataFrame]:
            held: dict = {}
            if self.known.exists():
                for entity, total, count in zip(*self.known.get()):
                    held[entity] = (total, count)
            for batch in rows:
                added = batch.dropna(subset=["value"]).groupby("entity", dropna=False)["value"]
                for entity, total, count in zip(added.groups, added.sum(), added.count()):
                    entity = None if pd.isna(entity) else entity
                    before = held.get(entity, (0.0, 0))
                    held[entity] = (before[0] + float(total), before[1] + int(count))
            self.known.update((list(held), [t for t, _ in held.values()],
                               [n for _, n in held.values()]))
            rated = [(rounded(t, n, digits), e) for e, (t, n) in held.items() if n]
            if rated:
                low, high = min(r[0] for r in rated), max(r[0] for r in rated)
                yield pd.DataFrame([(*key, sum(n for _, n in held.values()),
                                     low, [e for v, e in rated if v == low],
                                     high, [e for v, e in rated if v == high])], columns=names)

        def close(self) -> None:
            pass

    return BucketAverages()


def bucket_extremes(stream: DataFrame, group: str, entity: str, measure: str, *,
                    digits: int = 2, buckets: int = 64) -> DataFrame:
    """(group, bucket, readings, low, low_owners, high, high_owners) of every bucket
    that a trigger touched, after so many readings of it. Owners are texts."""
    kind = stream.schema[group].dataType
    out = T.StructType([T.StructField(group, kind), T.StructField(_BUCKET, T.IntegerType()),
                        T.StructField("readings", T.LongType()),
                        T.StructField("low", T.DoubleType()),
                        T.StructField("low_owners", T.ArrayType(T.StringType())),
                        T.StructField("high", T.DoubleType()),
                        T.StructField("high_owners", T.ArrayType(T.StringType()))])
    rows = stream.select(group, F.pmod(F.xxhash64(entity), F.lit(buckets)).cast("int").alias(_BUCKET),
                         F.col(entity).cast("string").alias("entity"),
                         F.col(measure).cast("double").alias("value"))
    return rows.groupBy(group, _BUCKET).transformWithStateInPandas(
        bucket_averages(out.fieldNames(), digits), out, "update", "none")


def extremes_step(group: str, entity_type: str):
    """A step for ``runner.carried`` over ``bucket_extremes``: the newest row of
    each bucket is kept, and the table ``extremes`` has, for every group so far,
    (group, which, value, owner), a row for each holder."""
    def step(batch: DataFrame, carry: DataFrame | None) -> dict:
        # A key may be handed over in parts (a NULL key is): the last part has all.
        rest = [c for c in batch.columns if c not in (group, _BUCKET)]
        batch = batch.groupBy(group, _BUCKET).agg(
            *[F.max_by(c, "readings").alias(c) for c in rest])
        if carry is not None:
            same = carry[group].eqNullSafe(batch[group]) & (carry[_BUCKET] == batch[_BUCKET])
            batch = batch.unionByName(carry.join(batch, same, "left_anti"))

        def extremes(written: dict[str, DataFrame]) -> DataFrame:
            rows = written["carry"]
            ends = rows.groupBy(group).agg(F.min("low").alias("__low"), F.max("high").alias("__high"))
            both = rows.join(ends.withColumnRenamed(group, "__group"),
                             F.col(group).eqNullSafe(F.col("__group")))
            told = F.array(
                F.when(F.col("low") == F.col("__low"), F.struct(
                    F.lit("min").alias("which"), F.col("low").alias("value"),
                    F.col("low_owners").alias("owners"))),
                F.when(F.col("high") == F.col("__high"), F.struct(
                    F.lit("max").alias("which"), F.col("high").alias("value"),
                    F.col("high_owners").alias("owners"))))
            held = both.select(group, F.explode(F.array_compact(told)).alias("t")).select(
                group, "t.which", "t.value", F.explode("t.owners").alias("owner"))
            return held.withColumn("owner", F.col("owner").cast(entity_type))

        return {"carry": batch, "extremes": extremes}

    return step


def start_extremes(stream: DataFrame, group: str, entity: str, measure: str, *, sink: str,
                   checkpoint: str, digits: int = 2, buckets: int = 64,
                   processing_time: str | None = None) -> StreamingQuery:
    step = extremes_step(group, stream.schema[entity].dataType.simpleString())
    return carried(bucket_extremes(stream, group, entity, measure, digits=digits, buckets=buckets),
                   step, sink=sink, checkpoint=checkpoint, processing_time=processing_time,
                   conf=STORE, mode="update")


def run_extremes(stream: DataFrame, group: str, entity: str, measure: str, *, label: str,
                 sink: str | None = None, checkpoint: str | None = None, **how) -> str:
    """Drain the stream; returns the sink."""
    spark = stream.sparkSession
    sink = sink or fresh_dir(spark, f"{label}-sink")
    checkpoint = checkpoint or fresh_dir(spark, f"{label}-ckpt")
    await_end(start_extremes(stream, group, entity, measure, sink=sink, checkpoint=checkpoint,
                             **how))
    return sink


def extremes_after(spark: SparkSession, sink: str, epoch: int | None = None) -> DataFrame:
    """The extremes told by an epoch, by default the last (only it is read)."""
    epoch = epochs(spark, f"{sink}/extremes")[-1] if epoch is None else epoch
    return spark.read.parquet(f"{sink}/extremes/{EPOCH}={epoch}")


def side_by_side(extremes: DataFrame, group: str) -> DataFrame:
    """(group, min_value, max_value, min_owner, max_owner), every holder of the
    one beside every holder of the other, as the batch operator tells them."""
    def of(which: str) -> DataFrame:
        return extremes.where(F.col("which") == which).select(
            group, F.col("value").alias(f"{which}_value"), F.col("owner").alias(f"{which}_owner"))
    return of("min").join(of("max"), group).select(
        group, "min_value", "max_value", "min_owner", "max_owner")
