"""The joins of the refinement: consent gating, customers with readings,
device readings with their owner, and time fusion of the two sensor feeds.

Multiplicities are carried as a count column wherever the original job only
multiplied rows (a reading joined to each device of its owner, a device
reading paired with every equal accelerometer reading).  The copies are made
once, at the very end, by ``number_rows``; the shuffles in between move one
row per distinct tuple.  Join strategies are left to the planner: the small
side is broadcast when its measured size is under the session threshold
(checked again at runtime by AQE), otherwise the join is a sort-merge join
whose skewed partitions AQE splits.  Where the planner cannot split a skewed
join (the consent gate, whose gate side is already partitioned by its
aggregate), hot keys are split off explicitly (``operators.skew``).
"""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonelake.functions.columns import group_keeping_zeros
from zonelake.operators.numbering import CHUNK_ROWS, numbered_copies, sums_before
from zonelake.session import materialize_counted, shuffle_partitions
from zonelake.operators import skew
from zonelake.operators.skew import HotKeys, collect_hot, find_hot_keys, split_hot

# The columns of a pair in the order of its number: those of the device reading, then those of the tuple.
PAIR = ["email", "sensorreadingtime", "serialnumber", "distancefromobject", "x", "y", "z"]
# A join that makes many pairs is dealt over at most so many times the session's shuffle partitions.
TASKS_BY_PAIRS = 16
# Gate tables up to this many keys and bytes of keys are broadcast; both are
# taken before the join is planned.
BROADCAST_KEYS, BROADCAST_BYTES = 1_000_000, 64 << 20
# Beyond them a bitmap of the gate's key hashes is broadcast: so many bits for each key, at most FILTER_BITS (32 MB), in pages of
# PAGE_BITS (what one bitmap of Spark holds).  Past half as many keys as bits it would let most rows through and is left out.
BITS_PER_KEY, FILTER_BITS, PAGE_BITS = 16, 1 << 28, 1 << 15


def broadcast_keys(spark) -> int:
    """``spark.zonelake.broadcastKeys``, or ``BROADCAST_KEYS``."""
    return skew.bound(spark, "broadcastKeys", BROADCAST_KEYS)


def key_bytes(*keys: str) -> Column:
    """Bytes that a broadcast row of the longest of these keys takes, roughly."""
    sizes = [F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)).cast("long") for k in keys]
    return (F.greatest(*sizes) if len(sizes) > 1 else sizes[0]) + 16


def gate_matches(gate_rows: DataFrame, gate_key: str, at_most: tuple[int, int] | None = None) -> tuple[DataFrame, bool, int]:
    """The gate's per-key table (``_gate_key``, ``_matches``), whether it may be broadcast, and its keys.  ``at_most`` states the gate's
    measured (rows, bytes of keys), where it is stored: if these may be broadcast, so may its keys.  Otherwise the table is materialised
    once and measured while it is written."""
    per_key = _matches(gate_rows, gate_key)
    fits = lambda keys, size: keys <= broadcast_keys(gate_rows.sparkSession) and size <= BROADCAST_BYTES
    if at_most and fits(*at_most):
        return per_key, True, at_most[0]
    table, keys, size = materialize_counted(per_key, key_bytes("_gate_key"))
    return table, fits(keys, size), keys


def _matches(gate_rows: DataFrame, gate_key: str) -> DataFrame:
    """One row per gate key with the number of gate rows holding it."""
    return (
        gate_rows.where(F.col(gate_key).isNotNull())
        .groupBy(F.col(gate_key).alias("_gate_key"))
        .agg(F.count(F.lit(1)).alias("_matches"))
    )


def gate_hot_keys(
    rows: DataFrame,
    row_key: str,
    gate_rows: DataFrame | None = None,
    gate_key: str | None = None,
    threshold: int | None = None,
    *,
    matches: DataFrame | None = None,
) -> HotKeys:
    """Keys whose gated output (rows x matching gate rows) exceeds
    ``threshold``: one detection serving both the gate join and a numbering
    by the same key.  Joins two per-key count tables, never the rows.  The
    gate side is ``gate_rows``/``gate_key`` or a ``gate_matches`` table."""
    if matches is None:
        matches = _matches(gate_rows, gate_key)
    per_key = rows.where(F.col(row_key).isNotNull()).groupBy(row_key).agg(F.count(F.lit(1)).alias("_r"))
    out = per_key.join(matches, F.col(row_key) == F.col("_gate_key"), "inner").withColumn("_n", F.col("_r") * F.col("_matches"))
    limit = skew.hot_threshold(threshold, rows.sparkSession)
    return collect_hot(out.where(F.col("_n") > F.lit(limit)), [row_key], "_n")


def gate(
    rows: DataFrame,
    gate_rows: DataFrame,
    row_key: str,
    gate_key: str,
    *,
    weight: str | None = None,
    hot: HotKeys | None = None,
    matches: tuple[DataFrame, bool, int] | None = None,
) -> DataFrame:
    """Rows of ``rows`` whose ``row_key`` equals a ``gate_key`` of ``gate_rows``.

    Inner-join semantics projected on ``rows``: a row appears once per
    matching gate row (a reading of a user with two devices appears twice).
    With ``weight`` the row appears once and the match count is put in that
    column instead.  The gate side is first reduced to one row per key (an
    aggregate combined map-side), so it never fans out inside the shuffle.
    Null keys never match.

    Strategy: with at most ``BROADCAST_KEYS`` gate keys in ``BROADCAST_BYTES``, the
    per-key table is broadcast and ``rows`` is not shuffled.  Otherwise rows whose key
    cannot be a gate key are dropped by a broadcast bitmap of key hashes (``may_match``) before anything is shuffled; the
    keys of the other rows over ``HOT_ROWS`` (``hot``, found here when not given)
    join a broadcast of just their matches, and the remaining rows, whose
    keys are all of bounded size, take a shuffled join.  ``matches`` passes
    a ``gate_matches`` result computed by the caller.
    """
    matches, small, keys = matches if matches is not None else gate_matches(gate_rows, gate_key)
    cond = F.col(row_key) == F.col("_gate_key")
    if small:
        return _gated(rows.join(F.broadcast(matches), cond, "inner"), rows.columns, weight)
    rows = may_match(rows, row_key, matches, "_gate_key", keys)
    if hot is None:
        hot = find_hot_keys(rows.where(F.col(row_key).isNotNull()), [row_key])
    if hot.frame is None:
        joined = rows.join(matches, cond, "inner")
    else:
        cold_rows, hot_rows = split_hot(rows, hot, [row_key])
        _, hot_matches = split_hot(matches, hot, ["_gate_key"])  # one row per hot key
        joined = cold_rows.join(matches, cond, "inner").unionByName(
            hot_rows.join(F.broadcast(hot_matches), cond, "inner")
        )
    return _gated(joined, rows.columns, weight)


def may_match(rows: DataFrame, row_key: str, table: DataFrame, key: str, keys: int) -> DataFrame:
    """The rows whose key may be one of the ``keys`` keys of ``table``: all that are, and about one of BITS_PER_KEY others.

    A Bloom filter with one hash, in Spark's own bitmaps: a page of PAGE_BITS bits per row, broadcast (its size is fixed by
    ``keys`` and FILTER_BITS) and probed by a join on the page.  Rows pass unfiltered where the two keys differ in type (their
    hashes would too) or where the bitmap would be too full.
    """
    if 2 * keys > FILTER_BITS or rows.schema[row_key].dataType != table.schema[key].dataType:
        return rows
    bits = min(FILTER_BITS, max(PAGE_BITS, 1 << (BITS_PER_KEY * keys).bit_length()))

    def spot(column: Column) -> tuple[Column, Column]:
        at = F.pmod(F.xxhash64(column), F.lit(bits))
        return F.floor(at / PAGE_BITS).cast("int"), (at % PAGE_BITS).cast("int")

    page, bit = spot(F.col(key))
    bitmap = table.select(page.alias("_page"), bit.alias("_bit")).groupBy("_page").agg(F.bitmap_construct_agg(F.col("_bit")).alias("_bits"))
    page, bit = spot(F.col(row_key))
    byte = F.conv(F.hex(F.substring(F.col("_bits"), F.floor(bit / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    is_set = F.floor(byte / F.pow(F.lit(2), bit % 8)) % 2 == 1
    return rows.join(F.broadcast(bitmap), page == F.col("_page"), "inner").where(is_set).select(*rows.columns)


def _gated(joined: DataFrame, columns: list[str], weight: str | None) -> DataFrame:
    if weight is not None:
        return joined.select(*[F.col(c) for c in columns], F.col("_matches").alias(weight))
    # in chunks, so that no row makes an unbounded array
    chunks = joined.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_matches") - 1) / F.lit(CHUNK_ROWS)))))
    left = F.least(F.lit(CHUNK_ROWS).cast("long"), F.col("_matches") - F.col("_chunk") * CHUNK_ROWS)
    copies = F.explode(F.array_repeat(F.lit(1), left.cast("int")))
    return chunks.select(*[F.col(c) for c in columns], copies.alias("_copy")).drop("_copy")


def customers_with_readings(
    customers: DataFrame,
    readings: DataFrame,
    customer_key: str = "email",
    reading_key: str = "user",
) -> DataFrame:
    """Customers that own at least one reading (left semi-join).

    The original job inner-joined readings to customers and let the keyed
    writer collapse the fan-out; the semi-join gives the same customers
    without producing one row per reading.  The reading side is reduced to
    its distinct keys first, combined map-side, so a user with a huge share
    of the readings costs one row per input task.  The planner broadcasts them if their measured size allows.
    """
    users = readings.select(F.col(reading_key).alias("_reader")).where(F.col("_reader").isNotNull()).distinct()
    return customers.join(users, F.col(customer_key) == F.col("_reader"), "left_semi")


def device_readings_with_owner(steps: DataFrame, owners: DataFrame) -> DataFrame:
    """Distinct device readings with the owner's email and registration date.

    Both sides are reduced to distinct tuples before the join on
    ``serialnumber`` (map-side combined, which also removes repeated readings
    of a device); the join of two distinct sets on a shared key, projected on
    all columns, is itself distinct, so no distinct is needed after it.
    """
    device = steps.select("sensorreadingtime", "serialnumber", "distancefromobject").distinct()
    owner = owners.select("serialnumber", "email", "registrationdate").distinct()
    return device.join(owner, "serialnumber", "inner").select(
        "sensorreadingtime", "serialnumber", "distancefromobject", "email", "registrationdate"
    )


def fuse_on_time(
    devices: DataFrame,
    accel: DataFrame,
    *,
    same_user: bool = False,
    weight: str = "_w",
    accel_weight: str | None = None,
    persist: bool = False,
) -> DataFrame:
    """Pair device readings with accelerometer readings of the same time.

    The original feature table joins on time alone: a reading of another user
    at the same instant is paired with the device too (``same_user=True``
    also requires ``email == user``).  Returns distinct feature tuples with
    their multiplicity in ``weight``.
    Accelerometer rows count once each, or ``accel_weight`` times.

    The accelerometer side is first reduced to distinct tuples with a count
    (combined map-side; the two zeros of a coordinate stay apart).  The join is many-to-many, so one busy instant makes
    devices x tuples pairs in the task that holds it, a size AQE cannot see
    (it measures inputs).  Per-instant pair counts are therefore taken first;
    the largest instants over ``HOT_ROWS`` pairs are dealt over a grid: their device rows get one of ``a`` numbers and are
    repeated for each of ``b``, the tuples the other way round, with a and b such that a cell makes about ``HOT_ROWS`` pairs
    and either side is repeated about as often as the square root of the cells.

    ``persist`` keeps the two inputs, which are read twice, in executor memory and disk instead of the checkpoint folder
    (the original job's choice); the caller unpersists them by ``spark.catalog.clearCache()``.
    """
    devices, acc, weight = _stored_inputs(devices, accel, same_user, weight, accel_weight, persist)[:3]
    return _fused(devices, acc, same_user, [*PAIR, weight], *_pair_counts(devices, acc, weight)[::2])


def _stored_inputs(
    devices: DataFrame, accel: DataFrame, same_user: bool, weight: str, accel_weight: str | None, persist: bool
) -> tuple[DataFrame, DataFrame, str, int, int]:
    """The two inputs of the fusion, stored: the device readings, the accelerometer tuples with their copies in ``weight``; and the
    rows of each."""
    keys = ["timestamp", "x", "y", "z"] + (["user"] if same_user else [])
    copies = F.sum(accel_weight) if accel_weight else F.count(F.lit(1))
    acc = group_keeping_zeros(accel, keys, copies.cast("long").alias(weight))
    if persist:
        devices, acc = devices.persist(StorageLevel.MEMORY_AND_DISK), acc.persist(StorageLevel.MEMORY_AND_DISK)
        return devices, acc, weight, devices.count(), acc.count()
    acc, tuples, _ = materialize_counted(acc, F.lit(0))
    devices, readings, _ = materialize_counted(devices, F.lit(0))
    return devices, acc, weight, readings, tuples


def _pair_counts(devices: DataFrame, acc: DataFrame, weight: str) -> tuple[int, int, DataFrame | None]:
    """(pairs, their copies) of all instants, from two tables of counts, and the busy instants: where the pairs are within the bound of
    one task, no instant needs counting."""
    n = devices.groupBy("sensorreadingtime").agg(F.count(F.lit(1)).alias("_n"))
    m = acc.groupBy("timestamp").agg(F.count(F.lit(1)).alias("_m"), F.sum(weight).alias("_w"))
    wide = lambda c: F.coalesce(F.sum(F.col("_n").cast("decimal(38,0)") * F.col(c)), F.lit(0))
    got = n.join(m, F.col("sensorreadingtime") == F.col("timestamp")).agg(wide("_m").alias("rows"), wide("_w").alias("copies")).first()
    many = int(got["rows"]) > skew.hot_threshold(None, devices.sparkSession)
    return int(got["rows"]), int(got["copies"]), _busy_instants(devices, acc) if many else None


def _fused(devices: DataFrame, acc: DataFrame, same_user: bool, out: list[str], rows: int, busy: DataFrame | None) -> DataFrame:
    """The ``rows`` pairs (over all users), ``out`` of their columns.  The planner sizes the tasks of a join by its inputs; where the
    pairs are more than one task's bound, the join is dealt over so many tasks that a task makes about ``HOT_ROWS`` of them."""
    limit = skew.hot_threshold(None, devices.sparkSession)
    least = shuffle_partitions(devices.sparkSession)
    tasks = min(max(least, -(-rows // max(limit, 1))), TASKS_BY_PAIRS * least)

    def pairs(dev: DataFrame, tuples: DataFrame, *cell: str) -> DataFrame:
        left, right = ["sensorreadingtime", *cell], ["timestamp", *(c.replace("_d_", "_t_") for c in cell)]
        if same_user:
            left, right = [*left, "email"], [*right, "user"]
        if rows > limit:
            dev, tuples = dev.repartition(tasks, *left), tuples.repartition(tasks, *right)
        cond = reduce(lambda a, b: a & b, [F.col(a) == F.col(b) for a, b in zip(left, right)])
        return dev.join(tuples, cond, "inner").select(*out)

    if busy is None:
        return pairs(devices, acc)
    instants = F.broadcast(busy)  # _busy_t, _a, _b; at most MAX_HOT_KEYS rows
    cold = pairs(
        devices.join(instants, F.col("sensorreadingtime") == F.col("_busy_t"), "left_anti"),
        acc.join(instants, F.col("timestamp") == F.col("_busy_t"), "left_anti"),
    )

    def dealt(side: DataFrame, key: str, own: str, other: str, mark: str) -> DataFrame:
        hot_rows = side.join(instants, F.col(key) == F.col("_busy_t"), "inner")
        one = F.pmod(F.xxhash64(*[F.col(c) for c in side.columns]), F.col(own))
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1))
        return hot_rows.withColumn(f"{mark}{own}", one).withColumn(f"{mark}{other}", every).drop("_busy_t", "_a", "_b")

    dev_hot = dealt(devices, "sensorreadingtime", "_a", "_b", "_d")
    acc_hot = dealt(acc, "timestamp", "_b", "_a", "_t")
    return cold.unionByName(pairs(dev_hot, acc_hot, "_d_a", "_d_b"))


def _busy_instants(devices: DataFrame, acc: DataFrame) -> DataFrame | None:
    """The largest instants whose pairs exceed ``HOT_ROWS``, with the grid ``_a`` (of the devices) x ``_b`` (of the tuples); None
    if there are none.  With s device rows and t tuples in a cell, s * t is the limit, and s its root unless a side is shorter."""
    limit = float(skew.hot_threshold(None, devices.sparkSession))
    n = devices.where(F.col("sensorreadingtime").isNotNull()).groupBy("sensorreadingtime").agg(
        F.count(F.lit(1)).alias("_n")
    )
    m = acc.groupBy("timestamp").agg(F.count(F.lit(1)).alias("_m"))
    per = n.join(m, F.col("sensorreadingtime") == F.col("timestamp"), "inner").withColumn("_pairs", F.col("_n") * F.col("_m"))
    s = F.least(F.col("_n").cast("double"), F.greatest(F.lit(max(limit, 1.0) ** 0.5), F.lit(limit) / F.col("_m")))
    busy = per.where(F.col("_pairs") > F.lit(limit)).select(
        F.col("sensorreadingtime").alias("_busy_t"),
        F.ceil(F.col("_n") / s).cast("long").alias("_a"),
        F.greatest(F.lit(1), F.least(F.col("_m"), F.ceil(F.col("_m") * s / F.lit(max(limit, 1.0))))).cast("long").alias("_b"),
        "_pairs",
    )
    return collect_hot(busy, ["_busy_t"], "_pairs", "_a", "_b").frame


def ml_features(
    devices: DataFrame, accel: DataFrame, *, same_user: bool = False, accel_weight: str | None = None, persist: bool = False
) -> DataFrame:
    """Feature rows numbered per email in time order (one row per pair).

    The pairs are many times their inputs (devices x readings of every instant), so they are neither moved nor sorted: a pair's
    first number follows from its two rows.  Before it come all pairs of the email's earlier device readings, whose number is the
    sum of their instants' copies, and its own reading's pairs with the tuples before.  Both sums run over the inputs
    (``sums_before``); the join then adds them and makes the copies in place.
    """
    devices, acc, _, readings, tuples = _stored_inputs(devices, accel, same_user, "_w", accel_weight, persist)
    rows, copies, busy = _pair_counts(devices, acc, "_w")
    spark, at, user = devices.sparkSession, ["timestamp"], F.lit(True)
    if same_user:
        at, user = [*at, "user"], F.col("email") == F.col("user")
    # equal device readings (of two registrations) are one row, so that equal pairs get neighbouring numbers
    dev = group_keeping_zeros(devices, PAIR[:4], F.count(F.lit(1)).alias("_c"))
    per_time = acc.groupBy(*at).agg(F.sum("_w").alias("_m"))
    dev = dev.join(per_time, (F.col("sensorreadingtime") == F.col("timestamp")) & user, "inner").select(*PAIR[:4], "_c", (F.col("_c") * F.col("_m")).alias("_m"))
    dev = sums_before(dev, "email", PAIR[1:4], "_m", name="_before", hot=skew.no_hot_keys(["email"], readings, spark))
    acc = sums_before(acc, at, PAIR[4:], "_w", name="_within", hot=skew.no_hot_keys(at, tuples, spark))
    fused = _fused(dev, acc, same_user, [*PAIR, "_c", "_w", "_before", "_within"], rows, busy)
    return numbered_copies(fused, PAIR, F.col("_before") + F.col("_c") * F.col("_within"), F.col("_c") * F.col("_w"), "rn", copies)
