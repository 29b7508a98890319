"""Row numbering per entity (``row_number() over (partition by k order by t)``)
that stays balanced when one entity owns a large share of the rows.

A plain window puts every row of an entity into one task.  With one user or
device holding a third of a 100 TB table that task never finishes.  So the
rows of each entity are first counted (an aggregate combined map-side, one
small job): entities up to ``hot_rows`` rows are numbered by a window (each
task then sorts groups of bounded size); the few hot entities above it go
through a range-based numbering whose per-task work is bounded whatever the
skew:

1. Identical rows get consecutive numbers and are interchangeable, so they are
   merged into one row with a count (``_copies``).  The aggregate combines
   map-side, so a hot group of copies shrinks before the shuffle.  A caller
   that already knows multiplicities (a join fan-out, say) passes them as
   ``weight`` and never materialises the copies.
2. Counts above ``chunk_rows`` are cut into chunks, so no single row later
   expands into an unbounded run and the chunks of one row can be spread.
3. The rows are range-partitioned on the full order (key, order columns,
   every other column, chunk) and sorted in their partitions.  Sampled range bounds split a hot key over as
   many partitions as its size needs.
4. Each row expands into its copies (at most ``chunk_rows``), which then lie in the full order, so
   ``monotonically_increasing_id`` is their position in the partition: no second shuffle.  This is
   checkpointed, so that the counts below and the output see one and the same assignment.
5. A key's rows begin in one partition and go on in the next ones.  Per partition and key there is one count (at most hot
   keys + partitions of them); chained in partition order they give what each key has before each partition,
   which is broadcast back and added.

The hot entities are the largest ``MAX_HOT_KEYS`` (broadcast to split the input); with more of them the others
stay with the window, each at most 1/``MAX_HOT_KEYS`` of the rows.  Ties in the order columns are broken by all
remaining columns, the negative zero before the positive one, so the result is deterministic and survives task retries;
``rn`` is a long (a hot key can pass 2^31 rows at the target scale).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonelake.functions.columns import group_keeping_zeros, key_struct, total_order
from zonelake.operators.projection import as_list
from zonelake.operators.skew import HotKeys, find_hot_keys, split_hot
from zonelake.session import checkpoint_dir, materialize, shuffle_partitions

CHUNK_ROWS = 1 << 16


def number_rows(
    df: DataFrame,
    by: str | Sequence[str],
    order_by: str | Sequence[str],
    *,
    name: str = "rn",
    weight: str | None = None,
    distinct_input: bool = False,
    partitions: int | None = None,
    chunk_rows: int = CHUNK_ROWS,
    hot_rows: int | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Append ``name``: 1, 2, ... per ``by`` group in ``order_by`` order.

    ``weight`` names a column holding how many copies each row stands for
    (rows with weight 0 or null vanish); it is not part of the output.
    ``distinct_input=True`` skips merging equal rows on the range path when
    the caller guarantees that no two rows are equal.

    Runs one small job eagerly (the per-entity counts), and when hot
    entities exist, the range path's checkpoint job.  The input is read
    twice (counts, numbering).  A caller that has already found
    the hot entities (``skew.find_hot_keys`` on the same keys and counts)
    passes them as ``hot`` and no count is run here.
    """
    by = as_list(by)
    order_by = as_list(order_by)
    if not by:
        raise ValueError("number_rows needs at least one partition column")
    data = [c for c in df.columns if c != weight]
    missing = [c for c in by + order_by if c not in data]
    if missing:
        raise ValueError(f"unknown columns {missing}; frame has {data}")
    if name in data:
        raise ValueError(f"output column {name!r} already exists")
    copies = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    df = df.select(*data, copies.alias("_copies")).filter(F.col("_copies") > 0)

    if hot is None:
        hot = find_hot_keys(df, by, weight=F.col("_copies"), threshold=hot_rows)
    if hot.frame is None:
        return _windowed(df, data, by, order_by, name)
    cold_rows, hot_rows_df = split_hot(df, hot, by)
    cold = _windowed(cold_rows, data, by, order_by, name)
    warm = _ranged(hot_rows_df, data, by, order_by, name, distinct_input, partitions, chunk_rows)
    return cold.unionByName(warm)


def _windowed(df: DataFrame, data: list[str], by: list[str], order_by: list[str], name: str) -> DataFrame:
    """Numbering of entities of bounded size: one window per entity, the
    running sum of the copies giving each row its last number."""
    ties = [c for c in data if c not in by and c not in order_by]
    running = (
        Window.partitionBy(*by)
        .orderBy(*total_order(df, order_by + ties))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    hi = F.sum("_copies").over(running)
    numbered = df.withColumn("_hi", hi)
    lo = F.col("_hi") - F.col("_copies") + 1
    return numbered.select(*[F.col(c) for c in data], F.explode(F.sequence(lo, F.col("_hi"))).alias(name))


def sums_before(
    df: DataFrame, by: str | Sequence[str], order_by: str | Sequence[str], weight: str, *, name: str, hot: HotKeys | None = None, partitions: int | None = None
) -> DataFrame:
    """Append ``name``: the sum of ``weight`` over the rows of the same ``by`` group that come before, in the order of ``order_by`` and then
    of all other columns.  What a product of two such tables is numbered by, without making or moving its rows.

    As in ``number_rows`` a window does it for groups of bounded size.  Hot groups (by rows; found here when not given) are cut by
    ranges of the full order, summed per range and, in a second window, within it.
    """
    by, order_by = as_list(by), as_list(order_by)
    order = order_by + [c for c in df.columns if c not in by and c not in order_by and c != weight]
    hot = find_hot_keys(df, by) if hot is None else hot

    def summed(rows: DataFrame, groups: list[str]) -> DataFrame:
        running = Window.partitionBy(*groups).orderBy(*total_order(rows, order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return rows.withColumn(name, F.sum(weight).over(running) - F.col(weight))

    if hot.frame is None:
        return summed(df, by)
    cold, warm = split_hot(df, hot, by)
    full = total_order(warm, by + order)
    ranged = warm.repartitionByRange(partitions or shuffle_partitions(df.sparkSession), *full).withColumn("_part", F.spark_partition_id())
    ranged = materialize(ranged)  # one and the same assignment for the sums per range and those within
    earlier = Window.partitionBy("_c_key").orderBy("_c_part").rowsBetween(Window.unboundedPreceding, -1)
    cells = ranged.groupBy(F.col("_part").alias("_c_part"), key_struct(by).alias("_c_key")).agg(F.sum(weight).alias("_n"))
    cells = cells.withColumn("_earlier", F.coalesce(F.sum("_n").over(earlier), F.lit(0).cast("long"))).drop("_n")
    same = (F.col("_part") == F.col("_c_part")) & key_struct(by).eqNullSafe(F.col("_c_key"))
    warm = summed(ranged, ["_part", *by]).join(F.broadcast(cells), same, "inner").withColumn(name, F.col(name) + F.col("_earlier"))
    return summed(cold, by).unionByName(warm.select(*df.columns, name))


def numbered_copies(df: DataFrame, data: list[str], before: Column, copies: Column, name: str, most: int, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``data`` as often as ``copies`` says, with ``name``: before + 1, before + 2, ...  No row has more than ``most`` copies; beyond
    ``chunk_rows`` they are made in chunks, so that no row makes an unbounded array."""
    df = df.select(*data, (before + 1).alias("_lo"), (before + copies).alias("_hi"))
    if most > chunk_rows:
        df = df.select(*data, F.explode(F.sequence("_lo", "_hi", F.lit(chunk_rows).cast("long"))).alias("_lo"), "_hi")
        df = df.withColumn("_hi", F.least("_hi", F.col("_lo") + (chunk_rows - 1)))
    return df.select(*data, F.explode(F.sequence("_lo", "_hi")).alias(name))


def _ranged(
    df: DataFrame,
    data: list[str],
    by: list[str],
    order_by: list[str],
    name: str,
    distinct_input: bool,
    partitions: int | None,
    chunk_rows: int,
) -> DataFrame:
    """Numbering that splits hot entities over range partitions (steps 1-5); runs its checkpoint job eagerly."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    ties = [c for c in data if c not in by and c not in order_by]

    # 1-2. merged copies, cut into bounded chunks
    bag = df if distinct_input else group_keeping_zeros(df, data, F.sum("_copies").alias("_copies"))
    last_chunk = F.floor((F.col("_copies") - 1) / F.lit(chunk_rows))
    bag = bag.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), last_chunk)))
    bag = bag.withColumn(
        "_copies", F.least(F.lit(chunk_rows).cast("long"), F.col("_copies") - F.col("_chunk") * chunk_rows)
    )

    # 3-4. the full order over range partitions, copies as rows, positions
    full = total_order(bag, by + order_by + ties + ["_chunk"])
    ranged = bag.repartitionByRange(partitions or shuffle_partitions(spark), *full).sortWithinPartitions(*full)
    ranged = ranged.select(*data, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("_copy"))
    ranged = ranged.select(*data, F.monotonically_increasing_id().alias("_at")).checkpoint(eager=True)
    ranged = ranged.withColumn("_part", F.shiftright("_at", 33))

    # 5. what each key has before each partition
    counts = ranged.groupBy("_part", key_struct(by).alias("_key")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = (
        F.sum("_n").over(Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    )
    cells = counts.withColumn("_before", F.coalesce(before, F.lit(0).cast("long"))).select(
        F.col("_part").alias("_c_part"), F.col("_key").alias("_c_key"), (F.col("_before") + 1 - F.col("_first")).alias("_shift")
    )
    same = (F.col("_part") == F.col("_c_part")) & key_struct(by).eqNullSafe(F.col("_c_key"))
    numbered = ranged.join(F.broadcast(cells), same, "inner")
    return numbered.select(*[F.col(c) for c in data], (F.col("_at") + F.col("_shift")).alias(name))
