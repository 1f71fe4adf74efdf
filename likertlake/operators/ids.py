"""Dense surrogate ids without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from likertlake.session import Workspace
from likertlake.sources.loads import LoadFolder

_POSITION_MASK = (1 << 33) - 1


def dense_id(
    df: DataFrame,
    order_by: Sequence[str],
    work: Workspace,
    partitions: int,
    name: str = "id_respondente",
    unique: bool = True,
) -> DataFrame:
    """Number rows 1..N in the order of ``order_by``, as ``row_number`` would.

    The rows are range-partitioned on sampled bounds (even parts for any spread of
    a unique key), sorted inside each part and written with their part and
    position. The written positions are then shifted by the row counts of the
    earlier parts. That count table has at most ``partitions`` rows, which bounds
    both its running sum and its broadcast.

    ``order_by`` should identify a row. Where it may not, ``unique=False`` settles
    ties by reading order, so that a key shared by many rows still spreads over
    several parts.
    """
    keys, source = list(order_by), df
    if not unique:
        source = df.withColumn("_tie", F.monotonically_increasing_id())
        keys.append("_tie")
    ranged = (
        source.repartitionByRange(partitions, *keys)
        .sortWithinPartitions(*keys)
        .select(
            *df.columns,
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_MASK)).alias("_pos"),
        )
    )
    placed = work.cut(ranged, "ranged")
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return placed.join(F.broadcast(offsets), "_part").select(
        (F.col("_before") + F.col("_pos") + 1).alias(name), *df.columns
    )


class IdMap:
    """Dense ids that a key keeps for good, stored load by load below ``root``.

    Each load adds the keys that no earlier one has seen, numbered without gaps after the
    highest id so far. Ids are 1..N at any time, and one given out never changes. A load that is run
    again gives the same ids, since its own earlier result is not taken for known and is replaced as a whole:
    what a killed run has left is of no account. Loads are to be run one after the other, in order.
    Null keys are keys like any other.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], name: str = "id_respondente") -> None:
        self.stored, self.keys, self.name = LoadFolder(spark, root), list(keys), name

    def known(self, before: int | None = None) -> DataFrame | None:
        """Keys with their ids, of the loads below ``before`` (all); None if there are none."""
        return self.stored.read(before)

    def _matches(self, left: str, right: str) -> Column:
        return reduce(and_, (F.col(f"{left}.`{k}`").eqNullSafe(F.col(f"{right}.`{k}`")) for k in self.keys))

    def add(self, rows: DataFrame, load: int, work: Workspace, partitions: int) -> DataFrame:
        """Give ids to the new keys of ``rows``; the map of this load: keys, id.

        The new ones are numbered in the order of the keys. Both sides of the search for them are reduced to
        their keys; neither is gathered anywhere.
        """
        if later := [n for n in self.stored.loads() if n > load]:
            raise ValueError(f"load {load} cannot follow load {later[-1]}")
        new = rows.select(*[F.col(f"`{k}`") for k in self.keys]).distinct()
        old, top = self.known(load), 0
        if old is not None:
            new = new.alias("n").join(old.alias("o"), self._matches("n", "o"), "left_anti")
            top = old.agg(F.max(self.name)).first()[0] or 0
        space = work.inner("ids")
        try:
            # Sampling for ranges reads its input twice; written, the join is made once.
            numbered = dense_id(space.cut(new, "new"), self.keys, space, partitions, self.name)
            return self.stored.write(load, numbered.select(*self.keys, (F.col(self.name) + F.lit(top)).alias(self.name)))
        finally:
            space.drop()

    def assign(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the id of their key in front; one whose key is in no load has null."""
        known = self.known()
        columns = [c for c in rows.columns if c != self.name]
        if known is None:
            return rows.select(F.lit(None).cast("bigint").alias(self.name), *[F.col(f"`{c}`") for c in columns])
        joined = rows.alias("r").join(known.alias("k"), self._matches("r", "k"), "left")
        return joined.select(F.col(f"k.`{self.name}`"), *[F.col(f"r.`{c}`") for c in columns])
