"""Ordered running sums that never put a whole group into one task.

AUC, average precision, the KS statistic, exact quantiles and exact stratified ranks all need
"running total of X in order of Y within a group". A window ``partitionBy(group).orderBy(y)``
sends each group to a single task. Here the sums have two levels:

1. One range partitioning on (group, order, ties): a partition holds many small groups or a piece of
   a large one, so its size follows the number of rows and not that of any group. Each partition is
   read in order, once, and adds up its own rows by group.
2. A group that goes on from an earlier partition is the first of its partition, so there is at most
   one such row a partition. Its total from the partitions before is found in the small table of
   totals by (group, partition) and joined back.

The ordered rows are written once to the shared folder. No bounds, groups or totals reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.session import write_once


def _codes(column: pa.Array) -> np.ndarray:
    """Numbers that are equal where the values are; null is a value."""
    return column.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)


def _sums_by_run(values: np.ndarray, starts: np.ndarray, carry) -> np.ndarray:
    """Running sums that begin anew at every start; the first run goes on from ``carry``."""
    if values.dtype.kind == "f":  # each run by itself, so that no other run's size costs digits
        out = np.concatenate([np.cumsum(part) for part in np.split(values, starts[1:])])
        out[:starts[1] if len(starts) > 1 else None] += carry
        return out
    out = np.cumsum(values)
    before = out[starts] - values[starts]
    before[0] -= carry
    return out - np.repeat(before, np.diff(np.append(starts, len(values))))


def _local_sums(group_cols: list[str], value_cols: list[str], names: list[str]):
    """Adds the running sums of one ordered partition, batch by batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carry = None, [0] * len(value_cols)
        for batch in batches:
            if not batch.num_rows:
                continue
            new = np.zeros(batch.num_rows, bool)
            for c in group_cols:
                codes = _codes(batch.column(c))
                new[1:] |= codes[1:] != codes[:-1]
            first, end = ([batch.column(c)[i].as_py() for c in group_cols] for i in (0, batch.num_rows - 1))
            if first != last:
                carry = [0] * len(value_cols)
            last = end
            new[0] = True
            starts = np.flatnonzero(new)
            sums = [_sums_by_run(pc.fill_null(batch.column(c), 0).to_numpy(zero_copy_only=False), starts, x) for c, x in zip(value_cols, carry)]
            carry = [s[-1] for s in sums]
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, sums)], [*batch.schema.names, *names])
    return run


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that the frame does not have yet, one for each of ``names``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def running_sums(df: DataFrame, group_cols: list[str], order_col: str,
                 value_cols: list[str], *, descending: bool = False,
                 tie_cols: tuple[str, ...] = (), prefix: str = "cum_",
                 partitions: int | None = None) -> DataFrame:
    """Add ``{prefix}{v}``: inclusive running sum of ``v`` ordered by
    ``order_col`` (then ``tie_cols``) within ``group_cols``.

    Rows that tie on the order columns are summed in an arbitrary but
    fixed order; collapse ties first (``groupBy(group, order).sum``) when
    they must be counted together, as every caller here does. A null group is
    a group; a null value counts as zero. ``partitions`` is left to Spark's
    settings unless given.
    """
    group_cols, value_cols = list(group_cols), list(value_cols)
    order, part = fresh(df, "__o", "__p")
    key = F.col(order_col).cast("double")
    x = df.withColumn(order, -key if descending else key)
    fields = {f.name: f.dataType for f in x.schema.fields}
    whole = [c for c in value_cols if isinstance(fields[c], T.IntegralType)]
    x = x.select(*[F.col(c).cast("long" if c in whole else "double").alias(c) if c in value_cols else F.col(c) for c in x.columns])
    by = [*group_cols, order, *tie_cols]
    x = x.repartitionByRange(*([partitions] if partitions else []), *by).sortWithinPartitions(*by)
    local = [f"__l_{i}" for i in range(len(value_cols))]
    x = x.withColumn(part, F.spark_partition_id())
    schema = T.StructType(list(x.schema.fields) + [T.StructField(n, T.LongType() if v in whole else T.DoubleType()) for n, v in zip(local, value_cols)])
    written = write_once(x.mapInArrow(_local_sums(group_cols, value_cols, local), schema), "ordered")

    totals = written.groupBy(*group_cols, part).agg(*[F.sum(v).alias(f"__t_{i}") for i, v in enumerate(value_cols)])
    earlier = Window.partitionBy(*group_cols).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(F.col(part).alias("__q"), *[F.col(c).alias(f"__g_{i}") for i, c in enumerate(group_cols)],
                           *[F.sum(f"__t_{i}").over(earlier).alias(f"__b_{i}") for i in range(len(value_cols))],
                           F.row_number().over(Window.partitionBy(*group_cols).orderBy(part)).alias("__nth"))
    before = before.where("__nth > 1").drop("__nth")  # at most one row a partition
    same = F.col(part) == F.col("__q")
    for i, c in enumerate(group_cols):
        same = same & F.col(c).eqNullSafe(F.col(f"__g_{i}"))
    out = written.join(F.broadcast(before), same, "left")
    return out.select(*df.columns, *[(F.col(n) + F.coalesce(F.col(f"__b_{i}"), F.lit(0))).alias(f"{prefix}{v}")
                                     for i, (n, v) in enumerate(zip(local, value_cols))])
