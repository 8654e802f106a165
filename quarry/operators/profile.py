"""Distribution profiling.

Statistics over many columns are fused: one aggregate computes the moments of every column, one sketch a column
brackets all quantiles and one counting pass makes them exact.  Long ("tidy") outputs keep schemas fixed
whatever the input width.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.constants import TOP_OUTLIER_COLUMNS, TOP_TARGET_CORR
from quarry.functions.numeric import ordered_bits
from quarry.operators.columns import bounded_distinct
from quarry.operators.ordering import cumulate_by_key
from quarry.operators.quality import nan_as_null, null_counts
from quarry.session import ensure_checkpoint_dir


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _missing_free(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c)


def to_long(df: DataFrame, cols, id_cols=(), name_col: str = "column_name",
            value_col: str = "value", cast: str = "double", drop_missing: bool = True
            ) -> DataFrame:
    """Unpivot ``cols`` into (id_cols..., column_name, value); all values cast to ``cast``."""
    base = df.select(*[_q(c) for c in id_cols],
                     *[_q(c).cast(cast).alias(c) for c in cols])
    long = base.unpivot(list(id_cols), list(cols), name_col, value_col)
    if drop_missing:
        cond = F.col(value_col).isNotNull()
        if cast in ("double", "float"):
            cond = cond & ~F.isnan(F.col(value_col))
        long = long.filter(cond)
    return long


# ---------------------------------------------------------------- quantiles

SKETCH_K = 4096
#: Rank error that a KLL sketch of this k exceeds once in a hundred, and how many of them a bracket takes each way.
SKETCH_ERROR = 2.296 / SKETCH_K ** 0.9021
BRACKET = 4 * SKETCH_ERROR
#: A table of numbers per group is sent whole to every task up to this many groups.
SENT_GROUPS = 10_000


def _sent_if_few(per_group: DataFrame, stored: DataFrame, rows: int = 1) -> DataFrame:
    """``per_group`` to be broadcast where ``stored``, a frame in the checkpoint folder with ``rows`` rows a group, has few
    groups. Without the hint a stored frame counts as large as what it was made from, and the rows
    that it is joined to would be dealt and sorted by the few groups."""
    return F.broadcast(per_group) if stored.limit(SENT_GROUPS * rows + 1).count() <= SENT_GROUPS * rows else per_group


def value_sketches(long: DataFrame, group_cols=("column_name",), value_col="value") -> DataFrame:
    """One mergeable KLL sketch a group: (group_cols..., sketch).

    Written to the checkpoint folder, so that all callers that ask for quantiles of these groups share
    one pass; a group's sketch has some 90 kB at most, whatever its size.
    """
    ensure_checkpoint_dir(long.sparkSession)
    return long.groupBy(*group_cols).agg(
        F.expr(f"kll_sketch_agg_double(cast(`{value_col}` as double), {SKETCH_K})").alias("sketch")).checkpoint()


def quantiles_long(long: DataFrame, probs, group_cols=("column_name",), value_col="value",
                   exact: bool = True, method: str = "bracket", sketches: DataFrame | None = None) -> DataFrame:
    """Quantiles of ``value_col`` per group, linear interpolation.

    Output: group_cols..., prob, quantile.  The exact mode equals numpy's
    ``linear`` method and DuckDB's ``quantile_cont``: with ``h = (n-1)p`` the
    result is ``v[floor h] + (h - floor h)(v[ceil h] - v[floor h])``.

    Exact values come from brackets: the group's sketch gives values around each target rank, and one
    pass counts the rows by value inside the brackets; all others are counted at the bracket's edge below
    them, map-side, so few rows shuffle. Cumulative counts by value (a radix tree, no sort of the whole)
    then name the values at the ranks. A rank that falls outside its bracket has no value; then every value
    is counted instead (``method="rank"`` does so at once). ``exact=False`` returns the sketch's quantiles.
    ``sketches``: those of ``value_sketches`` for the same rows and groups. The result is in the checkpoint folder; nothing is cached.
    """
    gkeys = list(group_cols)
    probs = [float(p) for p in probs]
    rows = long.select(*gkeys, F.col(value_col).cast("double").alias("_q_v"))
    if exact and method != "bracket":
        return _quantiles_by_counts(rows, probs, gkeys, None)
    if sketches is None:
        sketches = value_sketches(long, gkeys, value_col)
    at = lambda p: F.expr(f"kll_sketch_get_quantile_double(sketch, {min(1.0, max(0.0, p))!r}D)")
    if not exact:
        return sketches.select(*gkeys, F.explode(F.array(*[
            F.struct(F.lit(p).alias("prob"), at(p).alias("quantile")) for p in probs])).alias("_q_x")) \
            .select(*gkeys, "_q_x.*")
    edges = sketches.select(*gkeys, *[at(p + way * BRACKET).alias(f"_q_{side}{i}") for i, p in enumerate(probs)
                                      for side, way in (("lo", -1), ("hi", 1))])
    edges = edges.select("*", *[ordered_bits(n).alias(f"{n}b") for n in edges.columns[len(gkeys):]])
    found = _quantiles_by_counts(rows, probs, gkeys, _sent_if_few(edges, sketches) if gkeys else edges)
    if found.filter(F.col("quantile").isNull()).limit(1).count():
        return _quantiles_by_counts(rows, probs, gkeys, None)
    return found


def _quantiles_by_counts(rows: DataFrame, probs: list[float], gkeys: list[str],
                         edges: DataFrame | None) -> DataFrame:
    """Quantiles from cumulative counts by value. With ``edges`` (_q_lo<i>, _q_hi<i> per group), a value outside all
    of them is counted right behind the greatest edge below it (the next double, which no bracket holds)."""
    v, bits = F.col("_q_v"), ordered_bits("_q_v")
    if edges is None:
        keyed = rows.select(*gkeys, bits.alias("_q_at"), v.alias("_q_x"))
    else:
        names = [f"_q_{side}{i}" for i in range(len(probs)) for side in ("lo", "hi")]
        if gkeys:
            rows, of = rows.join(edges, gkeys), F.col
        else:  # one row of numbers
            one = edges.first()
            of = lambda n: F.lit(one[n])
        inside = functools.reduce(Column.__or__, [
            (v >= of(f"_q_lo{i}")) & (v <= of(f"_q_hi{i}")) for i in range(len(probs))])
        snapped = F.coalesce(F.greatest(*[F.when(v >= of(n), of(f"{n}b")) for n in names]) + 1, F.lit(-(1 << 63)))
        keyed = rows.select(*gkeys, F.when(inside, bits).otherwise(snapped).alias("_q_at"),
                            F.when(inside, v).alias("_q_x"))
    counts = keyed.groupBy(*gkeys, "_q_at").agg(F.count(F.lit(1)).alias("_q_n"), F.max("_q_x").alias("_q_x"))
    counted = cumulate_by_key(counts, F.col("_q_at"), ["_q_n"], gkeys)
    upto, total = F.col("upto__q_n"), F.col("all__q_n")
    at = {p: (total - 1).cast("double") * F.lit(p) for p in probs}
    held = lambda r: F.max(F.when((upto - F.col("_q_n") <= r) & (r < upto), F.col("_q_x")))
    picked = counted.groupBy(*gkeys).agg(
        F.max(total).alias("_q_total"), *[held(F.floor(at[p])).alias(f"_q_below{i}") for i, p in enumerate(probs)],
        *[held(F.ceil(at[p])).alias(f"_q_above{i}") for i, p in enumerate(probs)])
    h = {p: (F.col("_q_total") - 1).cast("double") * F.lit(p) for p in probs}
    each = [F.struct(F.lit(p).alias("prob"), (F.col(f"_q_below{i}") + (h[p] - F.floor(h[p])) * (
        F.col(f"_q_above{i}") - F.col(f"_q_below{i}"))).alias("quantile")) for i, p in enumerate(probs)]
    return picked.select(*gkeys, F.explode(F.array(*each)).alias("_q_p")).select(
        *gkeys, "_q_p.prob", "_q_p.quantile").checkpoint()


def quantiles(df: DataFrame, cols, probs, group_cols=(), exact: bool = True,
              sketches: DataFrame | None = None) -> DataFrame:
    """Quantiles of several numeric columns: (group_cols..., column_name, prob, quantile)."""
    long = to_long(df, cols, id_cols=group_cols)
    return quantiles_long(long, probs, list(group_cols) + ["column_name"], exact=exact, sketches=sketches)


def column_sketches(df: DataFrame, cols) -> DataFrame:
    """Sketches of numeric columns for ``quantiles``, ``moments`` and ``iqr_outliers`` to share."""
    return value_sketches(to_long(df, cols))


# ---------------------------------------------------------------- moments

def _clean(c: str) -> Column:
    v = _q(c).cast("double")
    return F.when(_missing_free(v), v)


def _sql_name(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def _sql_clean(c: str) -> str:
    v = f"CAST({_sql_name(c)} AS DOUBLE)"
    return f"CASE WHEN {v} IS NOT NULL AND NOT isnan({v}) THEN {v} END"


def moments(df: DataFrame, cols, with_median: bool = True, exact_median: bool = True,
            digits: int | None = 4, sketches: DataFrame | None = None) -> DataFrame:
    """Per column: n, mean, sample std, median, skewness, kurtosis, high-skew flag.

    Two aggregate passes over all columns at once: counts, means and min/max,
    then centered power sums (plain sums keep whole-stage codegen tight; the
    central-moment aggregates are several times slower).  Skewness/kurtosis
    follow pandas' bias correction, 0.0 for a constant column (min = max,
    exact), and are rounded to ``digits`` like the reference table.
    Expressions are written as SQL text: one JVM call per expression keeps the
    driver-side plan building cheap for wide tables.
    """
    cols = list(cols)
    clean = [_sql_clean(c) for c in cols]
    first = df.agg(*[F.expr(f"count({x})").alias(f"n{i}") for i, x in enumerate(clean)],
                   *[F.expr(f"avg({x})").alias(f"m{i}") for i, x in enumerate(clean)],
                   *[F.expr(f"min({x}) = max({x})").alias(f"k{i}")
                     for i, x in enumerate(clean)]).first()
    sums = []
    for i, x in enumerate(clean):
        mean = first[f"m{i}"] if first[f"m{i}"] is not None else 0.0
        d = f"(({x}) - CAST('{mean!r}' AS DOUBLE))"
        sums += [F.expr(f"sum({d} * {d})").alias(f"s2_{i}"),
                 F.expr(f"sum({d} * {d} * {d})").alias(f"s3_{i}"),
                 F.expr(f"sum({d} * {d} * {d} * {d})").alias(f"s4_{i}")]
    second = df.agg(*sums)
    rnd = (lambda e: f"round({e}, {digits})") if digits is not None else (lambda e: e)
    structs = []
    for i, c in enumerate(cols):
        n_int = int(first[f"n{i}"])
        n = f"CAST({n_int} AS DOUBLE)"
        const = "true" if first[f"k{i}"] else "false"
        mean = first[f"m{i}"]
        s2, s3, s4 = f"s2_{i}", f"s3_{i}", f"s4_{i}"
        g1 = f"try_divide(sqrt({n}) * {s3}, pow({s2}, 1.5))"
        g2 = f"(try_divide({n} * {s4}, {s2} * {s2}) - 3.0)"
        skew = (f"CASE WHEN {n} < 3 THEN CAST(NULL AS DOUBLE) WHEN {const} THEN 0.0 "
                f"ELSE coalesce({g1} * sqrt({n} * ({n} - 1)) / ({n} - 2), 0.0) END")
        kurt = (f"CASE WHEN {n} < 4 THEN CAST(NULL AS DOUBLE) WHEN {const} THEN 0.0 "
                f"ELSE coalesce((({n} + 1) * {g2} + 6) * ({n} - 1) / "
                f"(({n} - 2) * ({n} - 3)), 0.0) END")
        mean_sql = "CAST(NULL AS DOUBLE)" if mean is None else f"CAST('{mean!r}' AS DOUBLE)"
        structs.append(
            f"named_struct('column_name', {c!r}, 'n', CAST({n_int} AS BIGINT), "
            f"'mean', {mean_sql}, "
            f"'std', CASE WHEN {n} > 1 THEN sqrt({s2} / ({n} - 1)) END, "
            f"'skewness', {rnd(skew)}, 'kurtosis', {rnd(kurt)})")
    out = second.select(F.expr(f"inline(array({', '.join(structs)}))"))
    out = out.withColumn("is_high_skew", F.expr("coalesce(abs(skewness) > 1, false)"))
    if with_median:
        med = quantiles(df, cols, [0.5], exact=exact_median, sketches=sketches).select(
            "column_name", F.col("quantile").alias("median"))
        out = out.join(F.broadcast(med), "column_name", "left")
    return out


# ---------------------------------------------------------------- outliers / boxes

def iqr_bounds(q1: Column, q3: Column, k: float = 1.5) -> tuple[Column, Column]:
    iqr = q3 - q1
    return q1 - F.lit(k) * iqr, q3 + F.lit(k) * iqr


def iqr_outliers(df: DataFrame, cols, exact: bool = True, k: float = 1.5,
                 sketches: DataFrame | None = None) -> DataFrame:
    """Per column: q1, q3, iqr, fences and count strictly outside them.

    Fences (two numbers per column) are joined back to the long values and counted in one grouped aggregate.
    """
    long = to_long(df, cols)
    q = quantiles_long(long, [0.25, 0.75], exact=exact, sketches=sketches)
    fences = (q.groupBy("column_name")
               .agg(F.max(F.when(F.col("prob") == 0.25, F.col("quantile"))).alias("q1"),
                    F.max(F.when(F.col("prob") == 0.75, F.col("quantile"))).alias("q3")))
    lo, hi = iqr_bounds(F.col("q1"), F.col("q3"), k)
    fences = fences.select("column_name", "q1", "q3", (F.col("q3") - F.col("q1")).alias("iqr"),
                           lo.alias("lower_fence"), hi.alias("upper_fence"))
    counted = long.join(F.broadcast(fences.select("column_name", "lower_fence", "upper_fence")),
                        "column_name").groupBy("column_name").agg(
        F.count_if((F.col("value") < F.col("lower_fence")) |
                   (F.col("value") > F.col("upper_fence"))).alias("n_outliers"))
    return fences.join(counted, "column_name", "left").select(
        "column_name", "q1", "q3", "iqr", "lower_fence", "upper_fence",
        F.coalesce("n_outliers", F.lit(0)).alias("n_outliers"))


def top_outlier_columns(outliers: DataFrame, k: int = 20) -> DataFrame:
    """Columns with outliers, most first, top ``k`` (A12 chart data)."""
    return outliers.filter(F.col("n_outliers") > 0).orderBy(
        F.desc("n_outliers"), "column_name").limit(k)


def box_stats(df: DataFrame, value_col: str, group_cols=(), exact: bool = True,
              k: float = 1.5) -> DataFrame:
    """Five-number box data per group (A15, A20): never collects group values.

    Output: group_cols..., n, min, q1, median, q3, lower_whisker,
    upper_whisker, n_outliers.  Whiskers are the most extreme values inside
    the 1.5 IQR fences, as in matplotlib's box plot.
    """
    gcols = list(group_cols)
    v = _q(value_col).cast("double")
    long = df.select(*[_q(c) for c in gcols], v.alias("value")).filter(_missing_free(F.col("value")))
    names = {0.25: "q1", 0.5: "median", 0.75: "q3"}
    q = quantiles_long(long, list(names), group_cols=gcols, exact=exact)
    five = q.groupBy(*gcols).agg(
        *[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(name) for p, name in names.items()])
    lo, hi = iqr_bounds(F.col("q1"), F.col("q3"), k)
    five = five.withColumns({"_q_lo": lo, "_q_hi": hi})
    if gcols:
        joined, of = long.join(_sent_if_few(five, q, len(names)), gcols), F.col
    else:  # five numbers
        one = five.first()
        joined, of = long, lambda n: F.lit(one[n]).cast("double")
    val = F.col("value")
    inside_lo, inside_hi = val >= of("_q_lo"), val <= of("_q_hi")
    out = joined.groupBy(*gcols).agg(
        F.count(F.lit(1)).alias("n"), F.min(val).alias("min"), F.max(val).alias("max"),
        *[F.first(of(name)).alias(name) for name in names.values()],
        F.min(F.when(inside_lo, val)).alias("lower_whisker"),
        F.max(F.when(inside_hi, val)).alias("upper_whisker"),
        F.count_if(~(inside_lo & inside_hi)).alias("n_outliers"))
    return out.filter("n > 0")


# ---------------------------------------------------------------- counts

def top_k_per_group(df: DataFrame, group_cols, order_cols, k: int, rank_col: str = "rank"
                    ) -> DataFrame:
    """Rows ranked 1..k inside each group.

    Catalyst plans the ``row_number() <= k`` filter as a partial
    ``WindowGroupLimit`` before the shuffle, so a hot group sends at most k
    rows per map task.
    """
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


TRACKED = 10_000  # items a frequent-items sketch follows
#: The sketch's stated error as a share of the rows: 3.5 by its table size, the power of two above TRACKED / 0.75.
FREQUENT_ERROR = 3.5 / (1 << math.ceil(math.log2(TRACKED / 0.75)))


def value_counts(df: DataFrame, cols, k: int = 15) -> DataFrame:
    """(column_name, value, n, rank): top ``k`` values per column, nulls excluded.

    Ties in count are ordered by value so the cut at ``k`` is deterministic.

    A frequent-items sketch a column names 4 k candidates; one pass counts these exactly, so only
    candidates shuffle. That is the result where it can be proved: the candidates hold all rows, or the k-th count is
    above what any other value can have (the least estimate among the candidates, and twice the sketch's error,
    which covers values it has dropped). Columns without a proof, such as keys, are counted in full.
    """
    cols, most = list(cols), 4 * k
    ensure_checkpoint_dir(df.sparkSession)
    long = to_long(df, cols, cast="string")
    order = [F.desc("n"), F.asc("value")]
    sketched = long.groupBy("column_name").agg(
        F.expr(f"approx_top_k(value, {most}, {TRACKED})").alias("top"), F.count(F.lit(1)).alias("rows")).checkpoint()
    named = sketched.select("column_name", F.inline("top")).select("column_name", F.col("item").alias("value"))
    counts = long.join(F.broadcast(named), ["column_name", "value"]).groupBy("column_name", "value").agg(
        F.count(F.lit(1)).alias("n")).checkpoint()  # 4 k rows a column at most
    best = {r["column_name"]: r for r in counts.groupBy("column_name").agg(
        F.sum("n").alias("held"), F.sort_array(F.collect_list("n"), asc=False).alias("counts")).collect()}
    proven = []
    for r in sketched.collect():  # one row a column
        found = best.get(r["column_name"])
        others = max(2 * FREQUENT_ERROR * r["rows"], r["top"][-1]["count"] if len(r["top"]) >= most else 0)
        if found and (found["held"] == r["rows"] or len(found["counts"]) >= k and found["counts"][k - 1] > others):
            proven.append(r["column_name"])
    full = [c for c in cols if c not in proven]
    out = top_k_per_group(counts.filter(F.col("column_name").isin(proven)), ["column_name"], order, k)
    if not full:
        return out
    every = to_long(df, full, cast="string").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    return out.unionByName(top_k_per_group(every, ["column_name"], order, k))


def class_counts(df: DataFrame, target: str) -> DataFrame:
    """(class_value, n, n_classes) for a classification target, nulls excluded."""
    counts = (nan_as_null(df).filter(_q(target).isNotNull())
                .groupBy(_q(target).cast("string").alias("class_value"))
                .agg(F.count(F.lit(1)).alias("n")))
    return counts.withColumn("n_classes", F.lit(counts.count()))


def crosstab_norm(df: DataFrame, row_col: str, col_col: str, max_columns: int = 15) -> DataFrame | None:
    """Row-normalised cross-tab in long form: (row_value, col_value, n, share).

    Every row value is listed with every column value, absent pairs with 0.  Rows with
    a null in either column are left out, as in ``pandas.crosstab``.  None if there are more than
    ``max_columns`` column values (a target of that many classes has no cross-tab); they are the grid's
    columns, so they are read first, and row values stay rows.
    """
    both = df.filter(_q(row_col).isNotNull() & _q(col_col).isNotNull())
    if bounded_distinct(both, col_col, max_columns + 1) > max_columns:
        return None
    values = sorted(r[0] for r in both.select(_q(col_col).cast("string")).distinct().collect())
    pairs = both.groupBy(_q(row_col).cast("string").alias("row_value"),
                         _q(col_col).cast("string").alias("col_value")).agg(F.count(F.lit(1)).alias("n"))
    rows = pairs.groupBy("row_value").agg(
        F.map_from_entries(F.collect_list(F.struct("col_value", "n"))).alias("_q_n"),
        F.sum("n").alias("_q_row_n"))
    cells = rows.select("row_value", "_q_row_n", "_q_n", F.explode(
        F.array(*[F.lit(v) for v in values]).cast("array<string>")).alias("col_value"))
    n = F.coalesce(F.try_element_at("_q_n", F.col("col_value")), F.lit(0)).cast("long")
    return cells.select("row_value", "col_value", n.alias("n"), (n / F.col("_q_row_n")).alias("share"))


# ---------------------------------------------------------------- correlation

def _pearson(df: DataFrame, pairs: list[tuple[str, str]], names=("column_a", "column_b")) -> DataFrame:
    """(names[0], names[1], corr) of each pair over the rows where both are present (pairwise-complete, as
    pandas does), in two passes of plain sums whatever is missing.

    The first gives counts and means. The second sums products of values centred by them, with 0 for a missing
    value, and, only for columns that miss some, the same masked by the other column: pair counts, sums and
    squares. A column that is constant on a pair's rows (min = max, exactly) has no correlation.
    """
    cols = list(dict.fromkeys(c for p in pairs for c in p))
    at = {c: i for i, c in enumerate(cols)}
    # SQL text: one JVM call per expression keeps plan building cheap for wide tables
    clean = [_sql_clean(c) for c in cols]
    first = df.agg(F.count(F.lit(1)).alias("n"), *[F.expr(f"count({x})").alias(f"n{i}") for i, x in enumerate(clean)],
                   *[F.expr(f"avg({x})").alias(f"m{i}") for i, x in enumerate(clean)],
                   *[F.expr(f"min({x}) = max({x})").alias(f"k{i}") for i, x in enumerate(clean)]).first()
    partial = [first[f"n{i}"] != first["n"] for i in range(len(cols))]
    mean = [first[f"m{i}"] if first[f"m{i}"] is not None else 0.0 for i in range(len(cols))]
    base = df.select(
        *[F.expr(f"coalesce({x} - CAST('{mean[i]!r}' AS DOUBLE), 0D)").alias(f"z{i}") for i, x in enumerate(clean)],
        *[F.expr(f"CASE WHEN {x} IS NOT NULL THEN 1D ELSE 0D END").alias(f"u{i}")
          for i, x in enumerate(clean) if partial[i]])
    sums: dict[str, str] = {}

    def total(name: str, expr: str) -> str:
        sums.setdefault(name, expr)
        return name

    def own(i: int, j: int) -> tuple[str, str, str]:
        """Sum, sum of squares and constancy of column i on the rows that have column j."""
        if partial[j]:
            return (total(f"s{i}_{j}", f"sum(z{i} * u{j})"), total(f"q{i}_{j}", f"sum(z{i} * z{i} * u{j})"),
                    total(f"k{i}_{j}", "min(CASE WHEN {0} THEN z{1} END) = max(CASE WHEN {0} THEN z{1} END)".format(
                        f"u{j} = 1" + (f" AND u{i} = 1" if partial[i] else ""), i)))
        return (total(f"s{i}", f"sum(z{i})"), total(f"q{i}", f"sum(z{i} * z{i})"),
                "true" if first[f"k{i}"] else "false")

    structs = []
    for a, b in pairs:
        i, j = at[a], at[b]
        cross = total(f"p{min(i, j)}_{max(i, j)}", f"sum(z{i} * z{j})")
        n = (total(f"n{min(i, j)}_{max(i, j)}", f"sum(u{i} * u{j})") if partial[i] and partial[j] else
             f"CAST({min(first[f'n{i}'], first[f'n{j}'])} AS DOUBLE)")
        (si, qi, ki), (sj, qj, kj) = own(i, j), own(j, i)
        corr = (f"CASE WHEN coalesce({ki}, true) OR coalesce({kj}, true) THEN CAST(NULL AS DOUBLE) ELSE "
                f"try_divide({cross} - try_divide({si} * {sj}, {n}), sqrt(greatest({qi} - try_divide({si} * {si}, {n}), 0D)) "
                f"* sqrt(greatest({qj} - try_divide({sj} * {sj}, {n}), 0D))) END")
        structs.append(f"named_struct('{names[0]}', {a!r}, '{names[1]}', {b!r}, 'corr', {corr})")
    found = base.agg(*[F.expr(e).alias(n) for n, e in sums.items()])
    return found.select(F.expr(f"inline(array({', '.join(structs)}))"))


def corr_pairs(df: DataFrame, cols) -> DataFrame:
    """Strict lower triangle of the Pearson matrix: (column_a, column_b, corr).

    ``column_a`` comes later in ``cols`` than ``column_b``.
    """
    cols = list(cols)
    if len(cols) < 2:
        raise ValueError("correlation needs at least two numeric columns")
    return _pearson(df, [(cols[i], cols[j]) for i in range(len(cols)) for j in range(i)])


def target_corr(df: DataFrame, features, target: str, k: int = 8) -> DataFrame:
    """Feature-target correlations, top ``k`` by absolute value."""
    allc = _pearson(df, [(c, target) for c in features], ("feature", "_q_target")).drop("_q_target")
    allc = allc.withColumn("abs_corr", F.abs("corr"))
    w = Window.orderBy(F.desc_nulls_last("abs_corr"), F.asc("feature"))  # one row a feature
    return allc.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


# ---------------------------------------------------------------- histograms

def value_range(df: DataFrame, col: str) -> tuple[float | None, float | None]:
    v = _q(col).cast("double")
    row = df.agg(F.min(F.when(_missing_free(v), v)).alias("lo"),
                 F.max(F.when(_missing_free(v), v)).alias("hi")).first()
    return row["lo"], row["hi"]


def bin_index(v: Column, lo: float, hi: float, bins: int) -> Column:
    """1-based equal-width bin; the maximum falls in the last bin (closed edge)."""
    width = hi - lo
    raw = F.floor((v - F.lit(lo)) * F.lit(float(bins)) / F.lit(width)) + 1
    return F.least(raw, F.lit(bins)).cast("int")


def histogram(df: DataFrame, col: str, bins: int = 50, value_range_=None) -> DataFrame:
    """Equal-width histogram: (bin, bin_lo, bin_hi, n), every bin listed.

    A constant column is widened to value +- 0.5 like numpy.
    """
    lo, hi = value_range_ if value_range_ else value_range(df, col)
    spark = df.sparkSession
    if lo is None:
        return spark.createDataFrame([], "bin int, bin_lo double, bin_hi double, n bigint")
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    v = _q(col).cast("double")
    counts = (df.filter(_missing_free(v)).groupBy(bin_index(v, lo, hi, bins).alias("bin"))
                .agg(F.count(F.lit(1)).alias("n")))
    step = (F.lit(hi) - F.lit(lo)) / F.lit(float(bins))
    every = spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    counts = every.join(counts, "bin", "left").fillna(0, ["n"])
    return counts.select("bin",
                         (F.lit(lo) + (F.col("bin") - 1) * step).alias("bin_lo"),
                         (F.lit(lo) + F.col("bin") * step).alias("bin_hi"), "n")


def scatter_bins(df: DataFrame, x: str, y: str, nx: int = 20, ny: int = 20) -> DataFrame:
    """2-D binned counts of (x, y): (bin_x, bin_y, n) - scatter data at any size."""
    xlo, xhi = value_range(df, x)
    ylo, yhi = value_range(df, y)
    if xlo == xhi:
        xlo, xhi = xlo - 0.5, xhi + 0.5
    if ylo == yhi:
        ylo, yhi = ylo - 0.5, yhi + 0.5
    vx, vy = _q(x).cast("double"), _q(y).cast("double")
    return (df.filter(_missing_free(vx) & _missing_free(vy))
              .groupBy(bin_index(vx, xlo, xhi, nx).alias("bin_x"),
                       bin_index(vy, ylo, yhi, ny).alias("bin_y"))
              .agg(F.count(F.lit(1)).alias("n")))


def fit_range(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Perfect-fit line range: min and max over both columns."""
    return df.agg(F.least(F.min(actual), F.min(predicted)).alias("range_min"),
                  F.greatest(F.max(actual), F.max(predicted)).alias("range_max"))


# ---------------------------------------------------------------- dashboard aggregates

def kpi(df: DataFrame, value: str) -> DataFrame:
    """count / avg / max / min of one value."""
    v = _q(value)
    df = nan_as_null(df)
    return df.agg(F.count(v).alias("n"), F.avg(v).alias("avg_value"),
                  F.max(v).alias("max_value"), F.min(v).alias("min_value"))


def trend(df: DataFrame, date_col: str, value: str, grain: str = "month") -> DataFrame:
    """Average, total and count of ``value`` per year (and month)."""
    d = _q(date_col)
    df = nan_as_null(df)
    keys = [F.year(d).alias("year")]
    if grain == "month":
        keys.append(F.month(d).alias("month"))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                                 F.avg(_q(value)).alias("avg_value"),
                                 F.sum(_q(value)).alias("total_value"))


def group_avg(df: DataFrame, key: str, value: str) -> DataFrame:
    """Average of ``value`` per ``key`` with counts."""
    return nan_as_null(df).groupBy(_q(key).alias(key)).agg(F.count(F.lit(1)).alias("n"),
                                             F.avg(_q(value)).alias("avg_value"))


def band_avg(df: DataFrame, col: str, edges, value: str) -> DataFrame:
    """Average of ``value`` per band of ``col`` given ascending ``edges``.

    Band i covers ``[edges[i-1], edges[i])``; band 0 is below the first edge
    and band len(edges) at or above the last.
    """
    c = _q(col).cast("double")
    df = nan_as_null(df)
    band = F.lit(0)
    for e in edges:
        band = band + F.when(c >= F.lit(float(e)), 1).otherwise(0)
    return (df.filter(c.isNotNull()).groupBy(band.alias("band"))
              .agg(F.count(F.lit(1)).alias("n"), F.avg(_q(value)).alias("avg_value")))


# ---------------------------------------------------------------- sampling

def hash_sample(df: DataFrame, key_cols, n: int, seed: int = 42, oversample: float = 1.5,
                digest: str = "xxhash64") -> DataFrame:
    """Reproducible sample of ``n`` rows: the smallest ``xxhash64(keys, seed)``, or ``md5(keys|seed)`` as
    text with ``digest="md5"``, which other engines can repeat (A25).

    A plain ``orderBy(h).limit(n)`` would funnel n rows from every partition
    into one task.  The 64-bit hash is uniform, so rows below a threshold
    chosen for about ``oversample * n`` survivors are kept first; if fewer
    than n survive the threshold doubles.  The n smallest hashes always lie
    below any threshold that keeps at least n rows, so the result equals the
    plain top-n.  The whole table is returned when it has <= n rows.
    """
    if digest == "md5":
        h = F.md5(F.concat_ws("|", *[F.coalesce(_q(c).cast("string"), F.lit("")) for c in key_cols],
                              F.lit(str(seed))).cast("binary"))
    else:
        h = F.xxhash64(*[_q(c) for c in key_cols], F.lit(seed))
    hashed = df.withColumn("_q_h", h)
    total = df.count()
    if total <= n:
        return df
    frac = oversample * n / total
    cand = hashed
    while frac < 1.0:
        place = int(frac * 2 ** 64)
        trial = hashed.filter(F.col("_q_h") < F.lit(f"{place:016x}" if digest == "md5" else place - 2 ** 63))
        if trial.count() >= n:
            cand = trial
            break
        frac *= 2
    return cand.orderBy("_q_h", *key_cols).limit(n).drop("_q_h")


def histograms(df: DataFrame, cols, bins: int = 40) -> DataFrame:
    """Equal-width histograms of several columns in one pass: (column_name, bin, bin_lo, bin_hi, n).

    One aggregate finds every column's range (a few numbers per column to the
    driver); the values are then unpivoted, binned and counted in one grouped
    aggregation.  Constant columns are widened by 0.5 on each side.
    """
    cols = list(cols)
    row = df.agg(*[F.min(_clean(c)).alias(f"lo{i}") for i, c in enumerate(cols)],
                 *[F.max(_clean(c)).alias(f"hi{i}") for i, c in enumerate(cols)]).first()
    ranges = {}
    for i, c in enumerate(cols):
        lo, hi = row[f"lo{i}"], row[f"hi{i}"]
        if lo is None:
            continue
        ranges[c] = (lo - 0.5, hi + 0.5) if lo == hi else (lo, hi)
    if not ranges:
        return df.sparkSession.createDataFrame(
            [], "column_name string, bin int, bin_lo double, bin_hi double, n bigint")
    long = to_long(df, list(ranges))
    lo_map = F.create_map(*[x for c, (lo, _) in ranges.items() for x in (F.lit(c), F.lit(lo))])
    hi_map = F.create_map(*[x for c, (_, hi) in ranges.items() for x in (F.lit(c), F.lit(hi))])
    lo, hi = F.element_at(lo_map, F.col("column_name")), F.element_at(hi_map, F.col("column_name"))
    b = F.least(F.floor((F.col("value") - lo) * F.lit(float(bins)) / (hi - lo)) + 1,
                F.lit(bins)).cast("int")
    counts = long.groupBy("column_name", b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.createDataFrame([(c,) for c in ranges], "column_name string").withColumn(
        "bin", F.explode(F.sequence(F.lit(1), F.lit(bins))))
    counts = every.join(counts, ["column_name", "bin"], "left").fillna(0, ["n"])
    step = (hi - lo) / F.lit(float(bins))
    return counts.select("column_name", "bin", (lo + (F.col("bin") - 1) * step).alias("bin_lo"),
                         (lo + F.col("bin") * step).alias("bin_hi"), "n")


def chart_tables(df: DataFrame, target: str, kind: str, numeric, categorical,
                 low_cardinality, outliers: DataFrame | None = None) -> dict[str, DataFrame]:
    """The data behind each profile chart, for all columns given (L4); callers choose which.

    missing counts, target distribution (50 bins / class counts), numeric features (40 bins),
    correlation matrix, columns with most outliers, categorical columns (top 15 values), top-8 target
    correlations and these features against the target (20 x 20 bins), low-cardinality columns
    against the target (box data for regression, row-normalised cross-tabs for classification with
    at most 15 classes).
    """
    out: dict[str, DataFrame] = {}
    df = nan_as_null(df)
    out["missing_counts"] = null_counts(df)
    if outliers is not None:
        out["top_outliers"] = top_outlier_columns(outliers, TOP_OUTLIER_COLUMNS)
    if kind == "regression":
        out["target_histogram"] = histogram(df, target, 50)
        out["target_box"] = box_stats(df, target)
    else:
        out["class_counts"] = class_counts(df, target)
    feats = [c for c in numeric if c != target]
    if feats:
        out["feature_histograms"] = histograms(df, feats, 40)
        if kind == "regression":
            out["target_corr"] = target_corr(df, feats, target, TOP_TARGET_CORR).checkpoint()
            top = [r["feature"] for r in out["target_corr"].orderBy("rank").collect() if r["corr"] is not None]
            if top:
                out["feature_vs_target"] = functools.reduce(DataFrame.unionByName, [
                    scatter_bins(df, c, target).select(F.lit(c).alias("feature"), "*") for c in top])
    both = [*feats, *([target] if kind == "regression" else [])]
    if len(both) > 1:
        out["correlation"] = corr_pairs(df, both)
    if categorical:
        out["value_counts"] = value_counts(df, list(categorical), 15)
    frames = []
    for c in low_cardinality:
        if kind == "regression":
            frames.append(box_stats(df, target, [c]).select(
                F.lit(c).alias("column_name"), F.col(c).cast("string").alias("group_value"),
                *[x for x in ("n", "min", "max", "q1", "median", "q3", "lower_whisker",
                              "upper_whisker", "n_outliers")]))
        elif (table := crosstab_norm(df, c, target)) is not None:
            frames.append(table.select(F.lit(c).alias("column_name"), "*"))
    if frames:
        merged = frames[0]
        for f in frames[1:]:
            merged = merged.unionByName(f)
        out["category_vs_target"] = merged
    return out
