"""Permutation feature importance as one distributed job.

Rows get a position by the MD5 of their key and the seed. For every (feature, repeat) the row at a position
receives the feature's value of the row whose MD5 of key, seed, feature and repeat has that rank. One shuffle deals
rows and donors (digest, variant, value) by ranges of ranks, a fixed number a row, so wide rows cross the
network once, and each task ranks and matches one range's columns. All variants and the unchanged rows are scored where the rows lie by ONE
``transform``, and the metric per variant is a grouped aggregate that combines map-side.
importance = baseline score - permuted score.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from quarry.operators import modeling as mdl
from quarry.operators.profile import hash_sample
from quarry.operators.stats import importance_row
from quarry.session import batches_by_rows, ensure_checkpoint_dir

IMPORTANCE_SCHEMA = ("feature string, importance double, stddev double, p_value double, n int, "
                     "p99_high double, p99_low double")


def _grouped_score(df: DataFrame, t: mdl.Tournament, group_cols, pred: str) -> DataFrame:
    """Score per group with the tournament's metric: R^2, binary F1 or weighted F1.

    For classification the per-group confusion counts (groups x classes^2
    rows) are small; F1 follows from them on the driver.
    """
    y = F.col(t.spec.target)
    if t.kind == "regression":
        yc = y.cast("double")
        res = yc - F.col(pred)
        sse, sst = F.sum(res * res), F.var_pop(yc) * F.count(yc)
        score = F.when(sst == 0, F.when(sse == 0, 1.0).otherwise(0.0)).otherwise(1 - sse / sst)
        return df.groupBy(*group_cols).agg(score.alias("score"))
    conf = (df.groupBy(*group_cols, y.cast("string").alias("_y"), F.col(pred).alias("_yhat"))
              .count().collect())
    cells: dict = {}
    for r in conf:
        cells.setdefault(tuple(r[g] for g in group_cols), []).append(
            (r["_y"], r["_yhat"], r["count"]))
    rows = [(*k, float(mdl._f1_from_confusion(v, t.kind, t.labels))) for k, v in cells.items()]
    schema = ", ".join([f"{g} {dict(df.dtypes)[g]}" for g in group_cols] + ["score double"])
    return df.sparkSession.createDataFrame(rows, schema)


def hash_rank(df: DataFrame, digest: str, out: str, group_cols=()) -> DataFrame:
    """Append the 1-based position of each row of a group in the order of an MD5 text.

    Digests are uniform, so their first four digits deal the rows of any group into 65,536 like buckets: windows run inside
    buckets, and offsets come from the buckets' counts (65,536 rows a group at most). No range is sampled.
    """
    gs = list(group_cols)
    parted = df.withColumn("_q_b", F.substring(digest, 1, 4))
    counts = parted.groupBy(*gs, "_q_b").agg(F.count(F.lit(1)).alias("_q_n"))
    before = Window.partitionBy(*gs).orderBy("_q_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*gs, "_q_b", F.coalesce(F.sum("_q_n").over(before), F.lit(0)).alias("_q_o"))
    inside = Window.partitionBy(*gs, "_q_b").orderBy(digest)
    return parted.withColumn(out, F.row_number().over(inside)).join(offsets, [*gs, "_q_b"]) \
        .withColumn(out, F.col(out) + F.col("_q_o")).drop("_q_b", "_q_o")


def key_text(key_cols) -> Column:
    """The key of a row as text; a null part is an empty text."""
    return F.concat_ws("|", *[F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("")) for k in key_cols])


#: Rows of one unit of ranks over all variants, and ranges of digests over all variants.
UNIT_ROWS = 1_000_000
DIGEST_RANGES = 1 << 20
#: Digits of a digest that order the rows: 60 bits, a long.
HEX = 15


def permuted_variants(df: DataFrame, key_cols, features, n_repeats: int, seed: int) -> DataFrame:
    """Every row once as it is (``_q_f`` -1) and once a (feature ``_q_f``, repeat ``_q_r``), with that feature's
    value from the row that the permutation names. ``key_cols`` should be unique; rows of equal keys have the order of
    their values.

    Ranks are cut into units of equal length. Counts by the first digits of the digests say which ranks a range of
    digests has, so a row and the donors of its unit are dealt to the unit at once (a range that lies in
    two units goes to both), ranked there and matched by rank.
    """
    features, own = list(features), list(df.columns)
    variants = len(features) * n_repeats
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    n = df.count()
    units = max(1, least, n * (variants + 1) // UNIT_ROWS)
    # ranges of digests: sixteen a unit, as far as DIGEST_RANGES allows
    digits = next(d for d in (4, 3, 2) if d == 2 or (variants + 1) << (4 * d) <= DIGEST_RANGES and 1 << (4 * d) < 256 * units)
    units = min((1 << (4 * digits)) // 16, units)
    whole = F.col("_q_s") < 0
    places = F.array(*[F.struct(F.lit(i).alias("s"), F.lit(f"|{i // n_repeats}|{i % n_repeats}" if i >= 0 else "").alias("name"))
                       for i in range(-1, variants)])
    digest = lambda first, n: F.coalesce(F.conv(F.substring("_q_d", first, n), 16, 10).cast("long"), F.lit(0))

    def slots(rows: DataFrame) -> DataFrame:
        """A row itself (-1) and as the donor of every variant, with the digest that ranks it."""
        keyed = rows.withColumn("_q_k", F.concat_ws("|", key_text(key_cols), F.lit(str(seed)))).withColumn("_q_e", F.explode(places))
        return keyed.withColumns({"_q_s": F.col("_q_e.s"), "_q_d": F.md5(F.concat("_q_k", "_q_e.name").cast("binary"))}) \
            .drop("_q_k", "_q_e")

    ensure_checkpoint_dir(df.sparkSession)
    counts = slots(df).groupBy("_q_s", digest(1, digits).cast("int").alias("_q_b")).agg(F.count(F.lit(1)).alias("_q_n")).checkpoint()
    per = max(1, -(-n // units))  # ranks a unit
    before = Window.partitionBy("_q_s").orderBy("_q_b").rowsBetween(Window.unboundedPreceding, -1)
    ranges = counts.select("_q_s", "_q_b", "_q_n", F.coalesce(F.sum("_q_n").over(before), F.lit(0)).alias("_q_o"))
    unit = lambda at: F.floor(at / F.lit(per)).cast("int")
    of_unit = Window.partitionBy("_q_s", "_q_u")
    parts = ranges.withColumn("_q_u", F.explode(F.sequence(unit(F.col("_q_o")), unit(F.col("_q_o") + F.col("_q_n") - 1)))) \
        .select("_q_s", "_q_b", "_q_u", (F.col("_q_b") - F.min("_q_b").over(of_unit)).alias("_q_k"),
                (F.min("_q_o").over(of_unit) - F.col("_q_u") * F.lit(per)).alias("_q_o")).checkpoint()
    # a row's order in its unit: the range of digests, counted from the unit's first, and as many digits as fit in
    rest = HEX - digits
    more = min(rest, (63 - (parts.agg(F.max("_q_k")).first()[0] or 0).bit_length()) // 4)
    starts = {(r["_q_u"], r["_q_s"]): r["_q_o"] for r in parts.select("_q_u", "_q_s", "_q_o").distinct().collect()}  # units x variants

    # a donor has its value in the feature's own column and nothing in the others
    of_donor = [functools.reduce(lambda a, b: a | b, [
        F.col("_q_s").between(i * n_repeats, (i + 1) * n_repeats - 1) for i, f in enumerate(features) if f == c], whole) for c in own]
    dealt = slots(df.withColumn("_q_t", F.xxhash64(*[F.col(f"`{c}`") for c in own]))).withColumn("_q_x", digest(1, HEX)).drop("_q_d")
    dealt = dealt.withColumns({c: F.when(told, F.col(f"`{c}`")) for c, told in zip([*own, "_q_t"], [*of_donor, whole], strict=True)})
    # parts: DIGEST_RANGES rows, with those in two units twice
    low = F.shiftright(F.col("_q_x").bitwiseAND((1 << (4 * rest)) - 1), 4 * (rest - more))
    dealt = dealt.withColumn("_q_b", F.shiftright("_q_x", 4 * rest).cast("int")) \
        .join(F.broadcast(parts.drop("_q_o")), ["_q_s", "_q_b"]) \
        .withColumn("_q_h", F.shiftleft(F.col("_q_k").cast("long"), 4 * more).bitwiseOR(low)) \
        .select(*[F.col(f"`{c}`") for c in own], "_q_t", "_q_s", "_q_h", "_q_u") \
        .repartitionById(units, F.col("_q_u"))  # what differs between rows is side by side, which compresses better
    schema = StructType([StructField(f.name, f.dataType) for f in df.schema] + [
        StructField("_q_f", IntegerType()), StructField("_q_r", IntegerType())])
    return dealt.mapInArrow(_matcher(own, features, n_repeats, starts, per), schema)


def _matcher(own: list[str], features: list[str], n_repeats: int, starts: dict, per: int):
    """Of one unit's rows and donors the variants: both in the order of their digests, the ranks of the unit, value for value."""
    def match(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def ties(values):
            """Keys that sort as Spark does: nulls first, NaN last."""
            values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
            known = np.asarray(values.is_valid())
            if pa.types.is_floating(values.type):
                v = values.to_numpy(zero_copy_only=False)
                nan = known & np.isnan(v)
                return [np.where(known & ~nan, v, 0.0), nan, known]
            place = np.empty(len(values), np.int64)
            place[np.asarray(pc.sort_indices(values.cast(pa.int8()) if pa.types.is_boolean(values.type) else values,
                                             null_placement="at_start"))] = np.arange(len(values))
            return [place]  # equal values need no order

        def ranked(unit, slot, h, values):
            """Positions of the unit's ranks, in order."""
            order = np.argsort(h, kind="stable")
            same = np.flatnonzero(h[order[1:]] == h[order[:-1]])
            if len(same):
                at = np.union1d(same, same + 1)
                some = order[at]
                order[at] = some[np.lexsort([*ties(values.take(pa.array(some))), h[some]])]
            first = starts[unit, slot]
            return order[max(0, -first):max(0, per - first)]

        rows, donors = {}, {}
        for batch in batches:
            slots, units = batch.column("_q_s").to_numpy(), batch.column("_q_u").to_numpy()
            for unit in np.unique(units).tolist():
                mine = units == unit
                here = batch.filter(pa.array(mine & (slots < 0)))
                if here.num_rows:
                    rows.setdefault(unit, []).append(here)
                for i, c in enumerate(features):
                    which = mine & (slots >= i * n_repeats) & (slots < (i + 1) * n_repeats)
                    if which.any():
                        where = pa.array(which)
                        donors.setdefault((unit, i), []).append((slots[which], batch.column("_q_h").filter(where).to_numpy(),
                                                                 batch.column(c).filter(where)))

        def named(columns, n, f, r):
            columns = [*columns, pa.array(np.full(n, f, np.int32)), pa.array(np.full(n, r, np.int32))]
            return pa.Table.from_arrays(columns, [*own, "_q_f", "_q_r"]).to_batches(max_chunksize=1 << 14)

        for unit, found in rows.items():
            table = pa.Table.from_batches(found)
            order = ranked(unit, -1, table["_q_h"].to_numpy(), table["_q_t"])
            columns = table.select(own).take(pa.array(order)).combine_chunks().columns
            yield from named(columns, len(order), -1, 0)
            for i, c in enumerate(features):
                parts = donors.pop((unit, i))
                slots, h = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
                values = pa.chunked_array([p[2] for p in parts]).combine_chunks()
                for r in range(n_repeats):
                    at = np.flatnonzero(slots == i * n_repeats + r)
                    held = values.take(pa.array(at))
                    given = held.take(pa.array(ranked(unit, i * n_repeats + r, h[at], held)))
                    yield from named([given if name == c else column for name, column in zip(own, columns, strict=True)], len(order), i, r)
    return match


def importance_by_variant(df: DataFrame, key_cols, features, score: Callable[[DataFrame], DataFrame],
                          n_repeats: int = 5, seed: int = 42) -> DataFrame:
    """Importance table of any predictor: ``score`` takes the variants and returns (_q_f, _q_r, score)."""
    features = list(features)
    with batches_by_rows(df.sparkSession):
        scores = score(permuted_variants(df, key_cols, features, n_repeats, seed)).collect()  # a row a variant
    base = next((r["score"] for r in scores if r["_q_f"] < 0), None)
    rows = []
    for i, name in enumerate(features):
        drops = [base - r["score"] for r in scores if r["_q_f"] == i]
        if not drops:
            continue
        mean = sum(drops) / len(drops)
        spread = (sum((d - mean) ** 2 for d in drops) / (len(drops) - 1)) ** 0.5 if len(drops) > 1 else None
        p, hi, lo = importance_row(mean, spread, len(drops))
        rows.append((name, float(mean), spread, p, len(drops), hi, lo))
    rows.sort(key=lambda x: -x[1])
    return df.sparkSession.createDataFrame(rows, IMPORTANCE_SCHEMA)


def r2_by_variant(target: str, prediction: Column) -> Callable[[DataFrame], DataFrame]:
    """R^2 of a prediction column per variant; rows without a label or a prediction do not count."""
    def score(variants: DataFrame) -> DataFrame:
        y = F.col(f"`{target}`").cast("double")
        known = variants.withColumns({"_q_y": y, "_q_p": prediction}).filter(
            F.col("_q_y").isNotNull() & F.col("_q_p").isNotNull())
        error = F.col("_q_y") - F.col("_q_p")
        sst = F.var_pop("_q_y") * F.count("_q_y")
        value = F.when(sst == 0, F.when(F.sum(error * error) == 0, 1.0).otherwise(0.0)) \
            .otherwise(1 - F.sum(error * error) / sst)
        return known.groupBy("_q_f", "_q_r").agg(value.alias("score"))
    return score


def permutation_importance(df: DataFrame, t: mdl.Tournament, key_cols, features=None,
                           n_repeats: int = 5, sample_rows: int | None = None, seed: int = 42,
                           model: str | None = None) -> DataFrame:
    """Importance table: feature, importance, stddev, p_value, n, p99_high, p99_low.

    Every row and every feature by default (cost = features x repeats x rows); ``sample_rows`` asks for
    a reproducible sample.
    """
    features = list(features or (t.spec.numeric + t.spec.categorical + t.spec.dates))
    rows = hash_sample(df, key_cols, sample_rows, seed) if sample_rows else df
    return importance_by_variant(
        rows, key_cols, features,
        lambda variants: _grouped_score(mdl.predict(variants, t, model, "_q_pred"), t, ["_q_f", "_q_r"], "_q_pred"),
        n_repeats, seed)
