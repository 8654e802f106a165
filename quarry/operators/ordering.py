"""Distributed global ordering: positions, running totals and chronological splits.

A total order over a large table is computed without a single-partition
window.  Rows are range-partitioned on the full sort key (made unique by a
tie-break, so one order value holding a third of all rows is still spread over
many partitions), sorted inside each partition and numbered locally.  A tiny
table of per-partition counts - one row per partition, bounded by the
partition count we choose - turns local numbers into global positions.

Range bounds come from a sample whose seed depends on the plan, so two
separate exchanges may cut the key space differently.  The range-partitioned
frame is therefore materialised once (``persist`` by default; ``checkpoint``
writes it to the shared ``spark.checkpoint.dir``) and both the per-partition
counts and the numbered rows read that one copy.  A lost cached block is
rebuilt from the same shuffle dependency, hence with the same bounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType
from pyspark import StorageLevel

from quarry.session import ensure_checkpoint_dir


_PID = "_q_pid"
_MID = "_q_mid"
# Last tie-break: the input row id, so the range key is unique and even a
# key repeated on a third of all rows is cut across partitions.
_ROW = "_q_rowid"


def _sort_keys(cols, descending: bool) -> list[Column]:
    """Names get the default direction; Column sort orders are kept as given."""
    keys = []
    for c in cols:
        if isinstance(c, str):
            keys.append(F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_first())
        else:
            keys.append(c)
    return keys


def _ranged(df: DataFrame, keys: list[Column], num_partitions: int | None,
            materialize: str = "persist") -> DataFrame:
    """Range-partition and sort; without an explicit count AQE may coalesce adjacent
    partitions to the data's size (order is kept, ids are read after the exchange)."""
    parted = (df.repartitionByRange(num_partitions, *keys) if num_partitions
              else df.repartitionByRange(*keys))
    ranged = (parted
                .sortWithinPartitions(*keys)
                .withColumn(_PID, F.spark_partition_id())
                .withColumn(_MID, F.monotonically_increasing_id()))
    if materialize == "checkpoint":
        ensure_checkpoint_dir(df.sparkSession)
        return ranged.checkpoint(eager=True)
    ranged = ranged.persist(StorageLevel.MEMORY_AND_DISK)
    _MATERIALISED.append(ranged)
    return ranged


_MATERIALISED: list[DataFrame] = []


def release_ranked() -> int:
    """Unpersist every range-partitioned frame kept by the ordering operators.

    Call once the results built on them have been written; returns how many
    frames were released.
    """
    n = len(_MATERIALISED)
    while _MATERIALISED:
        _MATERIALISED.pop().unpersist()
    return n


def _partition_offsets(ranged: DataFrame) -> DataFrame:
    """One row per range partition: first local id, row count, rows of earlier partitions.

    The window runs over at most ``num_partitions`` rows.
    """
    per_part = ranged.groupBy(_PID).agg(F.min(_MID).alias("_q_mid0"), F.count(F.lit(1)).alias("_q_cnt"))
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    return per_part.withColumn("_q_off", F.coalesce(F.sum("_q_cnt").over(before), F.lit(0))) \
        .withColumn("_q_ntot", F.sum("_q_cnt").over(Window.partitionBy()))


def global_rank(df: DataFrame, order_cols, tie_break=(), rank_col: str = "_rank",
                total_col: str | None = None, descending: bool = False,
                num_partitions: int | None = None, materialize: str = "persist") -> DataFrame:
    """Append the 1-based position of each row in the order ``order_cols, tie_break``.

    Equals ``row_number() over (order by order_cols, tie_break)`` when the
    combined key is unique.  ``total_col`` optionally carries the row count.
    """
    keys = _sort_keys(list(order_cols) + list(tie_break), descending) + [F.col(_ROW)]
    ranged = _ranged(df.withColumn(_ROW, F.monotonically_increasing_id()), keys,
                     num_partitions, materialize)
    offsets = _partition_offsets(ranged)
    out = (ranged.join(F.broadcast(offsets), _PID)
                 .withColumn(rank_col, F.col("_q_off") + (F.col(_MID) - F.col("_q_mid0")) + 1))
    if total_col:
        out = out.withColumn(total_col, F.col("_q_ntot"))
    return out.drop(_PID, _MID, _ROW, "_q_mid0", "_q_cnt", "_q_off", "_q_ntot")


# ---------------------------------------------------------------- explicit ranges

def _text_bracket(rows: DataFrame, key: str, k: int, parts: int = 256) -> tuple[DataFrame, int, list]:
    """The rows between two splitters of ``key`` that hold position ``k``, the position among them, and, where
    they have one value of the key, that value in a list."""
    cuts = splitters(rows, [key], parts)
    counts = {r["at"]: r["n"] for r in rows.groupBy(range_id(rows, [key], cuts).alias("at"))
              .agg(F.count(F.lit(1)).alias("n")).collect()}  # at most ``parts`` rows
    at, below = 0, 0
    while below + counts.get(at, 0) < k:
        below += counts.get(at, 0)
        at += 1
    c = F.col(f"`{key}`")
    low = cuts[at - 1][0] if at else None
    edge = c.isNull() if low is None else c.eqNullSafe(F.lit(low))
    inside = rows if at == 0 else rows.filter(edge | (c > F.lit(low)) if low is not None else F.lit(True))
    if at < len(cuts) and cuts[at][0] is not None:
        inside = inside.filter(c.isNull() | (c < F.lit(cuts[at][0])))
    equal = rows.filter(edge).count()  # the splitter itself may hold most of the range
    if k - below <= equal:
        return rows.filter(edge), k - below, [low]
    return inside.filter(~edge & c.isNotNull()), k - below - equal, []


def splitters(df: DataFrame, keys: list[str], parts: int, per_part: int = 64, seed: int = 11) -> list[tuple]:
    """At most ``parts - 1`` key tuples, ascending (nulls first), that cut the rows into about equal ranges.

    They come from a sample of about ``per_part`` rows a range and only decide the balance: what is done
    with the ranges has the same result for any cuts.
    """
    narrow = df.select(*[F.col(f"`{k}`") for k in keys])
    n = narrow.count()
    if parts < 2 or not n:
        return []
    sample = narrow.sample(False, min(1.0, per_part * parts / n), seed).collect()
    order = lambda r: tuple((v is not None, v) if v is not None else (False,) for v in r)
    rows = sorted({tuple(r) for r in sample}, key=order) if len(sample) < 2 * parts else \
        sorted((tuple(r) for r in sample), key=order)
    picked = [rows[len(rows) * i // parts] for i in range(1, parts)] if rows else []
    return [x for i, x in enumerate(picked) if i == 0 or x != picked[i - 1]]


def range_id(df: DataFrame, keys: list[str], cuts: list[tuple]) -> Column:
    """Number of ``cuts`` at or below a row's key: its range, by binary search in one expression. A pure
    function of the row, so any two scans deal the rows alike."""
    if not cuts:
        return F.lit(0)
    kinds = [df.schema[k].dataType for k in keys]
    table = F.array(*[F.struct(*[F.lit(v).cast(t).alias(f"k{i}") for i, (v, t) in enumerate(zip(c, kinds))])
                      for c in cuts])
    row = F.struct(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)])

    def halve(span: Column, _: Column) -> Column:
        middle = F.floor((span["lo"] + span["hi"]) / 2).cast("int")
        open_ = span["lo"] < span["hi"]
        above = F.coalesce(F.get(table, middle) <= row, F.lit(False))
        return F.struct(F.when(open_ & above, middle + 1).otherwise(span["lo"]).alias("lo"),
                        F.when(open_ & ~above, middle).otherwise(span["hi"]).alias("hi"))

    start = F.struct(F.lit(0).alias("lo"), F.lit(len(cuts)).alias("hi"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(len(cuts).bit_length())), start, halve,
                       lambda span: span["lo"])


def _in_ranges(df: DataFrame, keys: list[str], parts: int | None) -> tuple[DataFrame, int]:
    """``df`` with the id of its range in ``_PID``, and the number of ranges."""
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    cuts = splitters(df, keys, parts)
    return df.withColumn(_PID, range_id(df, keys, cuts)), len(cuts) + 1


def running_totals(df: DataFrame, order_cols, sums: dict[str, Column], tie_break=(),
                   descending: bool = False, num_partitions: int | None = None,
                   with_grand_totals: bool = True) -> DataFrame:
    """Inclusive running sums of ``sums`` in the global order of columns, plus grand totals.

    Rows are dealt once, by explicit ranges of the key; a window runs inside each range, and the totals of
    earlier ranges (one row a range, combined map-side from the input) are added. Columns ``<name>`` hold the
    running sums and ``<name>_total`` the totals over the whole table. Rows with equal keys need a tie-break to have an
    order of their own; without one they share a range.
    """
    keys = [*order_cols, *tie_break]
    for name, expr in sums.items():
        df = df.withColumn(f"_q_v_{name}", expr.cast("double"))
    placed, ranges = _in_ranges(df, keys, num_partitions)
    if descending:
        placed = placed.withColumn(_PID, F.lit(ranges - 1) - F.col(_PID))
    per = placed.groupBy(_PID).agg(*[F.sum(f"_q_v_{name}").alias(f"_q_tot_{name}") for name in sums])
    earlier = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    every = Window.partitionBy()
    offsets = per.select(_PID, *[F.coalesce(F.sum(f"_q_tot_{name}").over(earlier), F.lit(0.0))
                                 .alias(f"_q_off_{name}") for name in sums],
                         *[F.sum(f"_q_tot_{name}").over(every).alias(f"_q_all_{name}") for name in sums])
    within = Window.partitionBy(_PID).orderBy(*_sort_keys(keys, descending)) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = placed.repartitionById(ranges, F.col(_PID))
    for name in sums:
        out = out.withColumn(name, F.sum(f"_q_v_{name}").over(within))
    out = out.join(F.broadcast(offsets), _PID)  # at most ``num_partitions`` rows
    for name in sums:
        out = out.withColumn(name, F.coalesce(name, F.lit(0.0)) + F.col(f"_q_off_{name}"))
        if with_grand_totals:
            out = out.withColumn(f"{name}_total", F.col(f"_q_all_{name}"))
    return out.drop(*[c for c in out.columns if c.startswith("_q_")])


def first_difference(df: DataFrame, col: str, order_cols, partition_cols=(), out: str | None = None,
                     num_partitions: int | None = None) -> DataFrame:
    """``col`` minus its value in the row before, in the order of ``order_cols`` within ``partition_cols``.

    Rows are dealt once, by explicit ranges of (partition, order); differences are taken inside each
    range, and the first row of a range takes the last value of the nearest range before it that has
    rows. Those boundary rows, one a range, are found by an aggregate that combines map-side, so one group that holds
    all rows is spread like any other. Order columns should be unique in a group; ties are taken by value.
    """
    groups, keys = list(partition_cols), [*partition_cols, *order_cols]
    placed, ranges = _in_ranges(df, keys, num_partitions)
    last = F.max(F.struct(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)],
                          F.col(f"`{col}`").alias("v"))).alias("last")
    boundary = {r[_PID]: r["last"] for r in placed.groupBy(_PID).agg(last).collect()}  # one row a range
    before, found = [], None
    for i in range(ranges):
        if found is not None:
            before.append((i, *found))
        found = boundary.get(i, found)
    schema = StructType([StructField("_q_at", IntegerType()),
                         *[StructField(f"_q_b{i}", df.schema[k].dataType) for i, k in enumerate(keys)],
                         StructField("_q_bv", df.schema[col].dataType)])
    ends = df.sparkSession.createDataFrame(before, schema)
    order = Window.partitionBy(_PID).orderBy(*_sort_keys([*keys, col], False))
    row = F.struct(*[F.col(f"`{k}`").alias(f"g{i}") for i, k in enumerate(groups)], F.col(f"`{col}`").alias("v"))
    inner = placed.repartitionById(ranges, F.col(_PID)).withColumn("_q_prev", F.lag(row).over(order))
    joined = inner.join(F.broadcast(ends), F.col(_PID) == F.col("_q_at"), "left")
    same_inside, same_across = F.lit(True), F.lit(True)
    for i, k in enumerate(groups):
        same_inside &= F.col(f"_q_prev.g{i}").eqNullSafe(F.col(f"`{k}`"))
        same_across &= F.col(f"_q_b{i}").eqNullSafe(F.col(f"`{k}`"))
    previous = F.when(F.col("_q_prev").isNotNull(), F.when(same_inside, F.col("_q_prev.v"))) \
        .when(F.col("_q_at").isNotNull(), F.when(same_across, F.col("_q_bv")))
    joined = joined.withColumn(out or f"{col}_diff", F.col(f"`{col}`") - previous)
    return joined.drop(*[c for c in joined.columns if c.startswith("_q_")])


# ---------------------------------------------------------------- cumulative sums by value

_LEVELS = (48, 24, 0)  # 16, 24 and 24 bits of a 64-bit key


def cumulate_by_key(df: DataFrame, key: Column, sums: list[str], group_cols=(), descending: bool = False,
                    prefix: str = "upto_") -> DataFrame:
    """Running sums of ``sums`` over the rows whose 64-bit ``key`` is at or before a row's, per group, and
    grand totals (``all_<name>``).

    A radix tree instead of a sort: totals by the first 16 bits and by the next 24 of the key, each
    accumulated among the children of one parent only, are added to the accumulation inside a
    40-bit prefix. A window group has at most 2**16 and 2**24 rows at the upper levels; at the lowest, 2**24 different
    keys (rows of one key are one row if ``df`` has been grouped by it). Nothing is sampled or kept.
    """
    gs = list(group_cols)
    mask = (1 << 24) - 1
    rows = df.withColumn("_q_key", key)
    rows = rows.withColumns({
        "_q_p1": F.shiftright("_q_key", _LEVELS[0]).cast("int"),
        "_q_p2": F.shiftright("_q_key", _LEVELS[1]).bitwiseAND(F.lit(mask)).cast("int"),
        "_q_p3": F.col("_q_key").bitwiseAND(F.lit(mask)).cast("int")})
    way = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0))

    second = rows.groupBy(*gs, "_q_p1", "_q_p2").agg(*[F.sum(n).alias(f"_q_s_{n}") for n in sums])
    first = second.groupBy(*gs, "_q_p1").agg(*[F.sum(f"_q_s_{n}").alias(f"_q_s_{n}") for n in sums])
    top = Window.partitionBy(*gs)
    first = first.select(
        *gs, "_q_p1", *[zero(F.sum(f"_q_s_{n}").over(before(top.orderBy(way("_q_p1"))))).alias(f"_q_a_{n}")
                        for n in sums], *[F.sum(f"_q_s_{n}").over(top).alias(f"all_{n}") for n in sums])
    middle = Window.partitionBy(*gs, "_q_p1").orderBy(way("_q_p2"))
    second = second.select(*gs, "_q_p1", "_q_p2",
                           *[zero(F.sum(f"_q_s_{n}").over(before(middle))).alias(f"_q_b_{n}") for n in sums])
    offsets = second.join(first, [*gs, "_q_p1"]).select(
        *gs, "_q_p1", "_q_p2", *[(F.col(f"_q_a_{n}") + F.col(f"_q_b_{n}")).alias(f"_q_off_{n}") for n in sums],
        *[f"all_{n}" for n in sums])
    inner = Window.partitionBy(*gs, "_q_p1", "_q_p2").orderBy(way("_q_p3"))
    rows = rows.withColumns({f"{prefix}{n}": F.sum(n).over(inner) for n in sums})
    out = rows.join(offsets, [*gs, "_q_p1", "_q_p2"])
    out = out.withColumns({f"{prefix}{n}": F.col(f"{prefix}{n}") + F.col(f"_q_off_{n}") for n in sums})
    return out.drop("_q_key", "_q_p1", "_q_p2", "_q_p3", *[f"_q_off_{n}" for n in sums])


def split_labels(rank: Column, total: Column, train: float = 0.70, val: float = 0.15,
                 names=("train", "val", "test")) -> Column:
    """Positional 70/15/15 labels; cut points are ``int(n*train)`` and ``int(n*(train+val))``.

    Fractions are combined in Python floats first, so the cut equals the
    one Python computes (``int(90*0.7)`` is 62).
    """
    train_frac = float(train)
    val_frac = float(train) + float(val)
    train_end = F.floor(total.cast("double") * F.lit(train_frac))
    val_end = F.floor(total.cast("double") * F.lit(val_frac))
    return (F.when(rank <= train_end, F.lit(names[0]))
             .when(rank <= val_end, F.lit(names[1]))
             .otherwise(F.lit(names[2])))


def chronological_split(df: DataFrame, date_col: str, tie_break=(), train: float = 0.70,
                        val: float = 0.15, split_col: str = "split",
                        rank_col: str | None = None, num_partitions: int | None = None,
                        materialize: str = "checkpoint") -> DataFrame:
    """Label each row train/val/test by its position in (date, tie-break) order.

    The two cut positions are found by bracketing and every row is labelled by comparing its key
    with the two boundary keys; rows are ranked (and moved) only where positions are asked for, or
    where equal keys lie across a cut.

    Rows with the same date are ordered by ``tie_break``; the reference leaves
    that order unspecified, so a key is required for reproducible cuts.
    """
    if date_col not in df.columns:
        raise KeyError(f"order column '{date_col}' not found; Spark has no implicit row order")
    keys = [date_col, *tie_break]
    if rank_col is None and all(isinstance(k, str) for k in keys):
        labelled = _split_by_boundaries(df, keys, train, val, split_col)
        if labelled is not None:
            return labelled
    rk = rank_col or "_q_rank"
    ranked = global_rank(df, [date_col], tie_break, rank_col=rk, total_col="_q_total",
                         num_partitions=num_partitions, materialize=materialize)
    out = ranked.withColumn(split_col, split_labels(F.col(rk), F.col("_q_total"), train, val))
    out = out.drop("_q_total")
    return out if rank_col else out.drop(rk)


def _split_by_boundaries(df: DataFrame, keys: list[str], train: float, val: float,
                         split_col: str) -> DataFrame | None:
    """Labels from the keys at the two cut positions: a scan and a comparison, no row moves.

    None if rows with one and the same key would fall on both sides of a cut (they have no order
    of their own), which is counted exactly.
    """
    narrow = df.select(*keys)
    n = narrow.count()
    cuts = [int(n * float(train)), int(n * (float(train) + float(val)))]
    bounds = [key_at(narrow, keys, k) if 0 < k < n else None for k in cuts]
    if any(b is None and 0 < k < n for b, k in zip(bounds, cuts)):
        return None
    row = F.struct(*keys)
    upto = [F.lit(k >= n) if b is None else
            row <= F.struct(*[F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(keys, b)])
            for b, k in zip(bounds, cuts)]
    held = narrow.agg(*[F.count_if(u).alias(f"c{i}") for i, u in enumerate(upto)]).first()
    if [held["c0"], held["c1"]] != [min(k, n) for k in cuts]:
        return None
    names = ("train", "val", "test")
    return df.withColumn(split_col, F.when(upto[0], names[0]).when(upto[1], names[1]).otherwise(names[2]))


def key_at(df: DataFrame, keys: list[str], position: int, small: int = 20_000,
           accuracy: int = 10_000) -> tuple | None:
    """The key tuple at a 1-based position in ascending order, nulls first.

    Approximate percentiles of the first key bracket the position, one pass counts the rows below and
    inside, and the bracket is narrowed until it holds few rows, of which the top rows are
    taken; a bracket that is one value fixes that key and goes on with the next. Keys without percentiles
    (text) are bracketed by sampled splitters and exact counts of the rows between them.
    """
    fixed: list = []
    rows, k = df, position
    while True:
        n = rows.count()
        rest = keys[len(fixed):]
        if n <= small or not rest:
            order = [F.col(c).asc_nulls_first() for c in rest]
            found = (rows.orderBy(*order) if order else rows).offset(k - 1).limit(1).collect()
            return tuple(fixed) + tuple(found[0][c] for c in rest)
        key = rest[0]
        if df.schema[key].dataType.typeName() not in (
                "byte", "short", "integer", "long", "float", "double", "decimal", "date", "timestamp",
                "timestamp_ntz"):
            rows, k, value = _text_bracket(rows, key, k)
            fixed += value
            continue
        nulls = rows.filter(F.col(key).isNull()).count()
        if k <= nulls:
            rows = rows.filter(F.col(key).isNull())
            fixed.append(None)
            continue
        at, width = (k - nulls) / max(1, n - nulls), 3.0 / accuracy
        lo, hi = rows.agg(F.percentile_approx(
            key, [max(0.0, at - width), min(1.0, at + width)], accuracy)).first()[0]
        c = F.col(key)
        below, inside = rows.agg(F.count_if(c.isNull() | (c < F.lit(lo))),
                                 F.count_if((c >= F.lit(lo)) & (c <= F.lit(hi)))).first()
        if not below < k <= below + inside:
            return None
        if lo == hi:
            rows, fixed = rows.filter(c == F.lit(lo)), [*fixed, lo]
        elif inside < n:
            rows = rows.filter((c >= F.lit(lo)) & (c <= F.lit(hi)))
        else:  # few values: the bracket is all rows; split it at its lower edge
            upto = below + rows.filter(c == F.lit(lo)).count()
            if k <= upto:
                rows, fixed = rows.filter(c == F.lit(lo)), [*fixed, lo]
            else:
                rows, below = rows.filter(c > F.lit(lo)), upto
        k -= below
