"""Ordered work per key that survives one key holding a large share of all rows.

Running maxima, moving averages and cool-downs need the rows of a sensor in arrival
order.  A plain ``Window.partitionBy(sensor)`` puts all of them into one task, so a
busy fixed sensor would decide the run time of the whole job.  Here the rows of such
*hot* keys are range-partitioned on (key, order) into *slices* of bounded size; every
operator then works per (key, slice) and receives the state left behind by the earlier
slices as a *carry*.

A key is hot if it has more rows than an even share of the shuffle tasks (and more than
``max_rows``).  Fewer keys than tasks can exceed an even share, and they are cut into at
most two slices per task together, so all carries together are a small table no matter
how much data there is.  Without a hot key, the price is one map-side-combined count.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from isodose.session import durable_dir, parallelism

SLICE = "_slice"
WHOLE = -1
MAX_ROWS = 2_000_000


@dataclass(frozen=True)
class Sliced:
    """Rows with a slice number, plus the hot rows on their own (None if no key is hot)."""

    rows: DataFrame
    hot: DataFrame | None
    keys: tuple[str, ...]
    order: tuple[str, ...]

    @property
    def group(self) -> list[str]:
        return [*self.keys, SLICE]

    def window(self) -> WindowSpec:
        """Rows of one key and slice in arrival order."""
        return Window.partitionBy(*self.group).orderBy(*self.order)

    def before(self) -> WindowSpec:
        """All rows of the slice that came before the current one."""
        return self.window().rowsBetween(Window.unboundedPreceding, -1)

    def with_carry(self, carry: DataFrame | None, **types: str) -> DataFrame:
        """Rows with the carry columns of their slice, null where nothing came before.

        ``carry`` has one row per (hot key, slice), which :func:`slice_hot_keys` bounds
        by two per shuffle task, so it is safe to broadcast.
        """
        if carry is None:
            return self.rows.withColumns(
                {name: F.lit(None).cast(kind) for name, kind in types.items()}
            )
        return self.rows.join(F.broadcast(carry), self.group, "left")


def slice_hot_keys(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], max_rows: int = MAX_ROWS
) -> Sliced:
    """Assign every row to a slice; see the module text.

    ``order`` must identify a row within its key, or equal rows may be cut either way.
    With no keys the whole table is one sequence.
    """
    spark = df.sparkSession
    keys, order = tuple(keys), tuple(order)
    tasks = parallelism(spark)
    # Kept while the busy keys are looked up, so the rows behind the counts are read once.
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).persist()
    try:
        total, largest = counts.agg(F.sum("_n"), F.max("_n")).first()
        bound = max(max_rows, math.ceil((total or 0) / tasks))
        if (largest or 0) <= bound:
            return Sliced(df.withColumn(SLICE, F.lit(WHOLE)), None, keys, order)
        # At most `tasks` rows: more keys than that cannot each exceed an even share.
        busy = counts.filter(F.col("_n") > bound).collect()
    finally:
        counts.unpersist()

    durable_dir(spark)
    hot_rows = sum(row["_n"] for row in busy)
    if keys:
        schema = T.StructType([df.schema[key] for key in keys])
        names = F.broadcast(spark.createDataFrame([tuple(row)[:-1] for row in busy], schema))
        # Set aside before range partitioning, which reads its input twice.
        hot = df.join(names, list(keys), "left_semi").checkpoint()
        cold = df.join(names, list(keys), "left_anti").withColumn(SLICE, F.lit(WHOLE))
    else:
        hot, cold = df, None
    # Range partitioning samples its bounds anew in every job.  The checkpoint pins the
    # slice of each row, so that carries and rows always agree, also after a lost executor.
    hot = (
        hot.repartitionByRange(math.ceil(hot_rows / bound), *keys, *order)
        .withColumn(SLICE, F.spark_partition_id())
        .checkpoint()
    )
    rows = hot if cold is None else cold.unionByName(hot)
    return Sliced(rows, hot, keys, order)


def slice_totals(sliced: Sliced, **aggregates: Column) -> DataFrame | None:
    """One row per hot (key, slice) with the given aggregates."""
    if sliced.hot is None:
        return None
    return sliced.hot.groupBy(*sliced.group).agg(
        *[column.alias(name) for name, column in aggregates.items()]
    )


def across(sliced: Sliced, first: int, last: int) -> WindowSpec:
    """Window over the slices of a key relative to the current one."""
    return Window.partitionBy(*sliced.keys).orderBy(SLICE).rowsBetween(first, last)


def neighbour(sliced: Sliced, column: str, name: str, step: int = -1) -> DataFrame:
    """Add the value of ``column`` in the previous (-1) or next (+1) row of the key."""
    inside = F.lag(column, -step).over(sliced.window())
    carry = None
    if sliced.hot is not None:
        position = F.struct(*sliced.order)
        edge = F.max_by(column, position) if step < 0 else F.min_by(column, position)
        carry = slice_totals(sliced, _edge=edge).select(
            *sliced.group, F.lag("_edge", -step).over(
                Window.partitionBy(*sliced.keys).orderBy(SLICE)
            ).alias("_carry")
        )
    kind = sliced.rows.schema[column].dataType.simpleString()
    rows = sliced.with_carry(carry, _carry=kind)
    edge_row = F.row_number().over(
        sliced.window() if step < 0
        else Window.partitionBy(*sliced.group).orderBy(*[F.desc(name) for name in sliced.order])
    ) == 1
    value = inside if carry is None else F.when(edge_row, F.col("_carry")).otherwise(inside)
    return rows.withColumn(name, value).drop("_carry")


def fold_sorted(
    sliced: Sliced,
    rows: DataFrame,
    step: Callable[[pa.RecordBatch, np.ndarray, object], tuple[pa.RecordBatch, object]],
    schema: T.StructType,
) -> DataFrame:
    """Run ``step`` over Arrow batches of rows sorted by (key, slice, order).

    ``step(batch, starts, state)`` gets a mask of the rows that begin a new (key, slice)
    and the state it returned for the previous batch.  Memory is one batch: no key and
    no slice is ever held as a whole.
    """
    group = sliced.group

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            starts, last = _group_starts(batch, group, last)
            out, state = step(batch, starts, state)
            yield out

    return (
        rows.repartition(*group).sortWithinPartitions(*group, *sliced.order).mapInArrow(run, schema)
    )


def _group_starts(
    batch: pa.RecordBatch, group: Sequence[str], last: tuple | None
) -> tuple[np.ndarray, tuple]:
    """Mask of rows whose group differs from the row before; also the last row's group."""
    size = batch.num_rows
    starts = np.zeros(size, dtype=bool)
    columns = [batch.column(batch.schema.get_field_index(name)) for name in group]
    for column in columns:
        differs = pc.not_equal(column.slice(1), column.slice(0, size - 1))
        starts[1:] |= differs.fill_null(True).to_numpy(zero_copy_only=False)
    starts[0] = last != tuple(column[0].as_py() for column in columns)
    return starts, tuple(column[size - 1].as_py() for column in columns)


def column_list(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def summarise_slices(
    sliced: Sliced,
    rows: DataFrame,
    columns: Sequence[str],
    make: Callable[[], object],
    fields: str,
) -> DataFrame:
    """One row per (key, slice) from a pass over its rows in order.

    ``make()`` gives a fresh object with ``add(*values)`` and ``result() -> dict``; it should
    stay small, since the rows are only streamed past it.  ``fields`` names its results.
    """
    group = sliced.group
    schema = T.StructType([*(rows.schema[name] for name in group), *_schema(fields)])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, summary = None, None
        for batch in batches:
            done = []
            names = zip(*[column_list(batch, name) for name in group])
            values = zip(*[column_list(batch, name) for name in columns])
            for name, value in zip(names, values):
                if name != current:
                    if summary is not None:
                        done.append(dict(zip(group, current)) | summary.result())
                    current, summary = name, make()
                summary.add(*value)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=arrow)
        if summary is not None:
            last = dict(zip(group, current)) | summary.result()
            yield pa.RecordBatch.from_pylist([last], schema=arrow)

    needed = dict.fromkeys([*group, *sliced.order, *columns])
    return (
        rows.select(*needed)
        .repartition(*group)
        .sortWithinPartitions(*group, *sliced.order)
        .mapInArrow(run, schema)
    )


def chain_slices(
    sliced: Sliced, summaries: DataFrame, follow: Callable[[list[dict]], list[dict]], fields: str
) -> DataFrame:
    """One row per (key, slice) from the key's slice summaries in order.

    There are at most two summaries per shuffle task over all keys together (see
    :func:`slice_hot_keys`), so one call sees a short list.
    """
    group = sliced.group
    key_fields = [summaries.schema[name] for name in group]
    schema = T.StructType([*key_fields, *_schema(fields)])
    arrow = to_arrow_schema(schema)

    def chain(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda row: row[SLICE])
        named = [{name: row[name] for name in group} for row in rows]
        out = [name | values for name, values in zip(named, follow(rows))]
        return pa.Table.from_pylist(out, schema=arrow)

    return summaries.groupBy(*sliced.keys).applyInArrow(chain, schema)


def _schema(fields: str) -> list[T.StructField]:
    return list(T._parse_datatype_string(fields).fields)
