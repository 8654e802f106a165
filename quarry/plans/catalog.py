"""Registered queries: each operator family run over the fixture tables.

``QUERIES[name](spark, sf_dir)`` returns a lazy DataFrame; ``ORACLE[name]``
is the same result in DuckDB SQL over views of the same parquet files.
Computed columns carry the same alias on both sides; doubles are rounded
identically on both sides so that summation order cannot change a digit.

Fixture notes: the tables have no nulls or duplicates where the operators
need some, so missing values are injected by expression (``nullif``) and
duplicates by a narrow projection - identically in the query and in its SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import calendar as cal
from quarry.operators import columns as colops
from quarry.operators import profile as prof
from quarry.operators import quality as qual
from quarry.operators.ordering import chronological_split, first_difference
from quarry.sources.tables import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return table(spark, sf, name)


def _r(col, digits: int):
    return F.round(F.col(col) if isinstance(col, str) else col, digits)


LINEITEM_NUMERIC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                    "l_extendedprice", "l_discount", "l_tax"]


# --------------------------------------------------------------- split (entry query)

@register("chronological_split", """
WITH r AS (
  SELECT o_orderdate, o_totalprice,
         row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rk,
         count(*) OVER () AS n
  FROM orders)
SELECT CASE WHEN rk <= floor(n * CAST(0.7 AS DOUBLE)) THEN 'train'
            WHEN rk <= floor(n * CAST(0.85 AS DOUBLE)) THEN 'val' ELSE 'test' END AS split,
       count(*) AS n_rows, min(o_orderdate) AS first_date, max(o_orderdate) AS last_date,
       round(avg(o_totalprice), 2) AS avg_totalprice
FROM r GROUP BY 1
""")
def q_chronological_split(spark, sf):
    orders = _t(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    split = chronological_split(orders, "o_orderdate", ["o_orderkey"])
    return split.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("o_orderdate").alias("first_date"),
        F.max("o_orderdate").alias("last_date"),
        _r(F.avg("o_totalprice"), 2).alias("avg_totalprice"))


# --------------------------------------------------------------- quality

_QUALITY_FIXTURE_SQL = """
SELECT l_returnflag, l_linestatus, l_quantity, nullif(l_discount, CAST(0 AS DOUBLE)) AS l_discount,
       l_tax, CAST(NULL AS DOUBLE) AS l_unused FROM lineitem"""


def _quality_fixture(spark, sf):
    li = _t(spark, sf, "lineitem")
    return li.select("l_returnflag", "l_linestatus", "l_quantity",
                     F.nullif(F.col("l_discount"), F.lit(0.0)).alias("l_discount"), "l_tax",
                     F.lit(None).cast("double").alias("l_unused"))


_QCOLS = ["l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_tax", "l_unused"]


@register("quality_summary", f"""
WITH f AS ({_QUALITY_FIXTURE_SQL}),
agg AS (
  SELECT count(*) AS n_rows,
         {' + '.join(f"count_if({c} IS NULL)" for c in _QCOLS)} AS n_missing,
         concat_ws(',', {', '.join(f"CASE WHEN min({c}) IS NOT DISTINCT FROM max({c}) THEN '{c}' END" for c in _QCOLS)}) AS constant_columns,
         {' + '.join(f"CASE WHEN min({c}) IS NOT DISTINCT FROM max({c}) THEN 1 ELSE 0 END" for c in _QCOLS)} AS n_constant_columns
  FROM f),
d AS (SELECT count(*) AS n_distinct FROM (SELECT DISTINCT * FROM f))
SELECT n_rows, CAST({len(_QCOLS)} AS INTEGER) AS n_columns, n_rows - n_distinct AS n_duplicate_rows,
       CAST(n_missing AS BIGINT) AS n_missing,
       round(CAST(100 AS DOUBLE) * n_missing / (n_rows * {len(_QCOLS)}), 2) AS missing_pct,
       constant_columns, CAST(n_constant_columns AS INTEGER) AS n_constant_columns
FROM agg, d
""")
def q_quality_summary(spark, sf):
    s = qual.quality_summary(_quality_fixture(spark, sf))
    return s.select("n_rows", "n_columns", "n_duplicate_rows", "n_missing", "missing_pct",
                    F.array_join("constant_columns", ",").alias("constant_columns"),
                    F.size("constant_columns").alias("n_constant_columns"))


_NULL_FIXTURE_SQL = """
SELECT c_custkey, c_name, nullif(c_nationkey, 0) AS c_nationkey,
       CASE WHEN c_acctbal < 0 THEN CAST('NaN' AS DOUBLE) ELSE c_acctbal END AS c_acctbal,
       nullif(c_mktsegment, 'BUILDING') AS c_mktsegment FROM customer"""


def _null_fixture(spark, sf):
    c = _t(spark, sf, "customer")
    return c.select("c_custkey", "c_name", F.nullif("c_nationkey", F.lit(0)).alias("c_nationkey"),
                    F.when(F.col("c_acctbal") < 0, F.lit(float("nan")))
                     .otherwise(F.col("c_acctbal")).alias("c_acctbal"),
                    F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment"))


@register("null_counts", f"""
WITH f AS ({_NULL_FIXTURE_SQL}),
u AS (
  SELECT 'c_custkey' AS column_name, count_if(c_custkey IS NULL) AS n_missing FROM f
  UNION ALL SELECT 'c_name', count_if(c_name IS NULL) FROM f
  UNION ALL SELECT 'c_nationkey', count_if(c_nationkey IS NULL) FROM f
  UNION ALL SELECT 'c_acctbal', count_if(c_acctbal IS NULL OR isnan(c_acctbal)) FROM f
  UNION ALL SELECT 'c_mktsegment', count_if(c_mktsegment IS NULL) FROM f)
SELECT column_name, CAST(n_missing AS BIGINT) AS n_missing FROM u WHERE n_missing > 0
""")
def q_null_counts(spark, sf):
    return qual.null_counts(_null_fixture(spark, sf))


@register("dedup_rows", """
SELECT DISTINCT l_returnflag, l_linestatus, l_quantity FROM lineitem
""")
def q_dedup_rows(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    return qual.deduplicate(li)


@register("drop_null_target", """
SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice, nullif(p_size, 1) AS target
FROM part WHERE nullif(p_size, 1) IS NOT NULL
""")
def q_drop_null_target(spark, sf):
    p = _t(spark, sf, "part").withColumn("target", F.nullif("p_size", F.lit(1)))
    return qual.drop_null_target(p, "target")


# --------------------------------------------------------------- column roles

_ROLE_SPECS = {
    "part": ("p_partkey", [("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"),
                           ("p_type", "string"), ("p_size", "int"), ("p_retailprice", "double")]),
    "customer": ("c_custkey", [("c_custkey", "bigint"), ("c_name", "string"),
                               ("c_nationkey", "int"), ("c_acctbal", "double"),
                               ("c_mktsegment", "string")]),
}


def _roles_sql() -> str:
    parts = []
    for tname, (order_key, cols) in _ROLE_SPECS.items():
        for cname, dtype in cols:
            integral = dtype in ("bigint", "int")
            kind = "numeric" if dtype in ("bigint", "int", "double") else "categorical"
            is_id = (f"(count(DISTINCT {cname}) = count(*))" if dtype == "string" else "false")
            is_seq = (f"(count({cname}) = count(*) AND count(DISTINCT {cname}) = count(*) "
                      f"AND min({cname} - rn) = max({cname} - rn))" if integral else "false")
            low = (f"(count(DISTINCT {cname}) <= 15)" if kind == "categorical" else "false")
            parts.append(
                f"SELECT '{tname}' AS table_name, '{cname}' AS column_name, '{dtype}' AS data_type, "
                f"'{kind}' AS kind, (min({cname}) IS NOT DISTINCT FROM max({cname})) AS is_constant, "
                f"{is_id} AS is_id, {is_seq} AS is_sequence, {low} AS is_low_cardinality "
                f"FROM (SELECT *, row_number() OVER (ORDER BY {order_key}) AS rn FROM {tname})")
    return "\nUNION ALL\n".join(parts)


@register("column_roles", _roles_sql())
def q_column_roles(spark, sf):
    frames = []
    for tname, (order_key, _cols) in _ROLE_SPECS.items():
        df = _t(spark, sf, tname)
        roles = colops.column_roles(df, None, [order_key])
        frames.append(colops.roles_frame(df, roles, tname))
    return frames[0].unionByName(frames[1])


_PT_SPECS = [("part", "p_size", True), ("part", "p_brand", False), ("labels", "quality", True),
             ("labels", "toxic", True)]


def _problem_type_sql() -> str:
    parts = []
    for tname, col, numeric in _PT_SPECS:
        k = f"count(DISTINCT {col})"
        reg = f"({'true' if numeric else 'false'} AND {k} > 15)"
        parts.append(
            f"SELECT '{tname}' AS table_name, '{col}' AS target, least({k}, 16) AS n_distinct_capped, "
            f"CASE WHEN {reg} THEN 'regression' ELSE 'classification' END AS problem_type, "
            f"CASE WHEN {reg} THEN 'regression' WHEN {k} = 2 THEN 'binary' ELSE 'multiclass' END "
            f"AS fine_problem_type FROM {tname}")
    return "\nUNION ALL\n".join(parts)


@register("problem_type", _problem_type_sql())
def q_problem_type(spark, sf):
    frames = [colops.problem_type_frame(_t(spark, sf, tname), col)
              .select(F.lit(tname).alias("table_name"), "*")
              for tname, col, _ in _PT_SPECS]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# --------------------------------------------------------------- calendar

@register("calendar_features", """
SELECT o_orderkey, CAST(year(d) AS INTEGER) AS Year, CAST(month(d) AS INTEGER) AS Month,
       CAST(quarter(d) AS INTEGER) AS Quarter, CAST(isodow(d) - 1 AS INTEGER) AS Day_of_Week,
       CAST(CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS Weekend
FROM (SELECT o_orderkey, try_cast(CAST(o_orderdate AS VARCHAR) AS TIMESTAMP) AS d FROM orders)
WHERE d IS NOT NULL
""")
def q_calendar_features(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey",
                                       F.col("o_orderdate").cast("string").alias("o_orderdate"))
    out = cal.add_calendar_features(o, "o_orderdate")
    return out.drop("o_orderdate")


@register("calendar_flags", """
SELECT o_orderkey, dayname(o_orderdate) AS Day_of_Week,
       CASE WHEN isodow(o_orderdate) IN (5, 6) THEN 'Yes' ELSE 'No' END AS Weekend,
       CASE WHEN month(o_orderdate) IN (5, 6, 7, 12) THEN 'Yes' ELSE 'No' END AS Peak_Season
FROM orders
""")
def q_calendar_flags(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return cal.add_form_flags(o, "o_orderdate").drop("o_orderdate")


# --------------------------------------------------------------- moments / quantiles

def _moments_sql() -> str:
    parts = []
    for c in LINEITEM_NUMERIC:
        parts.append(
            f"SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 6) AS mean, "
            f"round(stddev_samp({c}), 6) AS std, "
            f"round(coalesce(skewness({c}), CAST(0 AS DOUBLE)), 4) AS skewness, "
            f"round(coalesce(kurtosis({c}), CAST(0 AS DOUBLE)), 4) AS kurtosis, "
            f"round(quantile_cont({c}, 0.5), 6) AS median FROM lineitem")
    body = "\nUNION ALL\n".join(parts)
    return f"SELECT *, abs(skewness) > 1 AS is_high_skew FROM ({body})"


@register("moments", _moments_sql())
def q_moments(spark, sf):
    li = _t(spark, sf, "lineitem")
    m = prof.moments(li, LINEITEM_NUMERIC)
    return m.select("column_name", "n", _r("mean", 6).alias("mean"), _r("std", 6).alias("std"),
                    "skewness", "kurtosis", _r("median", 6).alias("median"), "is_high_skew")


def _iqr_sql(tname: str, col: str) -> str:
    return f"""SELECT '{tname}' AS table_name, '{col}' AS column_name, round(q1, 6) AS q1,
       round(q3, 6) AS q3, round(q3 - q1, 6) AS iqr, round(q1 - 1.5 * (q3 - q1), 6) AS lower_fence,
       round(q3 + 1.5 * (q3 - q1), 6) AS upper_fence,
       (SELECT count(*) FROM {tname} WHERE {col} < q1 - 1.5 * (q3 - q1)
                                      OR {col} > q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM (SELECT quantile_cont({col}, 0.25) AS q1, quantile_cont({col}, 0.75) AS q3 FROM {tname})"""


@register("iqr_outliers", _iqr_sql("events", "value") + "\nUNION ALL\n"
          + _iqr_sql("part", "p_retailprice"))
def q_iqr_outliers(spark, sf):
    frames = []
    for tname, col in (("events", "value"), ("part", "p_retailprice")):
        o = prof.iqr_outliers(_t(spark, sf, tname), [col])
        frames.append(o.select(F.lit(tname).alias("table_name"), "column_name",
                               *[_r(c, 6).alias(c) for c in
                                 ("q1", "q3", "iqr", "lower_fence", "upper_fence")],
                               "n_outliers"))
    return frames[0].unionByName(frames[1])


# --------------------------------------------------------------- counts

def _vc_sql(tname: str, col: str) -> str:
    return f"""SELECT '{tname}' AS table_name, '{col}' AS column_name, CAST({col} AS VARCHAR) AS value,
       count(*) AS n FROM {tname} WHERE {col} IS NOT NULL GROUP BY {col}"""


@register("value_counts_top", f"""
SELECT *, CAST(row_number() OVER (PARTITION BY table_name, column_name ORDER BY n DESC, value)
          AS INTEGER) AS rank
FROM ({_vc_sql('orders', 'o_orderstatus')} UNION ALL {_vc_sql('orders', 'o_orderpriority')}
      UNION ALL {_vc_sql('customer', 'c_mktsegment')})
QUALIFY rank <= 15
""")
def q_value_counts_top(spark, sf):
    a = prof.value_counts(_t(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])
    b = prof.value_counts(_t(spark, sf, "customer"), ["c_mktsegment"])
    return (a.select(F.lit("orders").alias("table_name"), "*")
             .unionByName(b.select(F.lit("customer").alias("table_name"), "*")))


@register("class_balance", """
SELECT target, class_value, n, count(*) OVER (PARTITION BY target) AS n_classes FROM (
  SELECT 'quality' AS target, CAST(quality AS VARCHAR) AS class_value, count(*) AS n
  FROM labels WHERE quality IS NOT NULL GROUP BY quality
  UNION ALL
  SELECT 'toxic', CAST(toxic AS VARCHAR), count(*) FROM labels WHERE toxic IS NOT NULL GROUP BY toxic)
""")
def q_class_balance(spark, sf):
    lab = _t(spark, sf, "labels")
    return (prof.class_counts(lab, "quality").select(F.lit("quality").alias("target"), "*")
            .unionByName(prof.class_counts(lab, "toxic").select(F.lit("toxic").alias("target"), "*")))


def _box_sql(tname: str, gcol: str, vcol: str) -> str:
    return f"""SELECT '{tname}' AS table_name, CAST(d.{gcol} AS VARCHAR) AS group_value,
       count(*) AS n, round(min({vcol}), 6) AS min, round(max({vcol}), 6) AS max,
       round(any_value(q1), 6) AS q1, round(any_value(med), 6) AS median, round(any_value(q3), 6) AS q3,
       round(min({vcol}) FILTER (WHERE {vcol} >= q1 - 1.5 * (q3 - q1)), 6) AS lower_whisker,
       round(max({vcol}) FILTER (WHERE {vcol} <= q3 + 1.5 * (q3 - q1)), 6) AS upper_whisker,
       count(*) FILTER (WHERE {vcol} < q1 - 1.5 * (q3 - q1) OR {vcol} > q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM {tname} d JOIN (SELECT {gcol}, quantile_cont({vcol}, 0.25) AS q1, quantile_cont({vcol}, 0.5) AS med,
                            quantile_cont({vcol}, 0.75) AS q3 FROM {tname} GROUP BY {gcol}) q
  ON d.{gcol} = q.{gcol}
GROUP BY d.{gcol}"""


@register("box_stats", _box_sql("events", "event_type", "value") + "\nUNION ALL\n"
          + _box_sql("lineitem", "l_returnflag", "l_extendedprice"))
def q_box_stats(spark, sf):
    frames = []
    for tname, g, v in (("events", "event_type", "value"),
                        ("lineitem", "l_returnflag", "l_extendedprice")):
        b = prof.box_stats(_t(spark, sf, tname), v, [g])
        frames.append(b.select(F.lit(tname).alias("table_name"),
                               F.col(g).cast("string").alias("group_value"), "n",
                               *[_r(c, 6).alias(c) for c in ("min", "max", "q1", "median", "q3",
                                                            "lower_whisker", "upper_whisker")],
                               "n_outliers"))
    return frames[0].unionByName(frames[1])


@register("crosstab_norm", """
WITH p AS (SELECT o_orderpriority AS row_value, o_orderstatus AS col_value, count(*) AS n
           FROM orders WHERE o_orderpriority IS NOT NULL AND o_orderstatus IS NOT NULL GROUP BY 1, 2)
SELECT row_value, col_value, coalesce(n, 0) AS n,
       round(coalesce(n, 0) / sum(n) OVER (PARTITION BY row_value), 6) AS share
FROM (SELECT DISTINCT row_value FROM p) CROSS JOIN (SELECT DISTINCT col_value FROM p)
LEFT JOIN p USING (row_value, col_value)
""")
def q_crosstab_norm(spark, sf):
    ct = prof.crosstab_norm(_t(spark, sf, "orders"), "o_orderpriority", "o_orderstatus")
    return ct.withColumn("share", _r("share", 6))


# --------------------------------------------------------------- correlation

def _corr_sql_expr(a: str, b: str) -> str:
    return f"round(corr({a}, {b}), 6)"


@register("corr_matrix", "\nUNION ALL\n".join(
    f"SELECT '{LINEITEM_NUMERIC[i]}' AS column_a, '{LINEITEM_NUMERIC[j]}' AS column_b, "
    f"{_corr_sql_expr(LINEITEM_NUMERIC[i], LINEITEM_NUMERIC[j])} AS corr FROM lineitem"
    for i in range(len(LINEITEM_NUMERIC)) for j in range(i)))
def q_corr_matrix(spark, sf):
    c = prof.corr_pairs(_t(spark, sf, "lineitem"), LINEITEM_NUMERIC)
    return c.withColumn("corr", _r("corr", 6))


_TC_FEATURES = [c for c in LINEITEM_NUMERIC if c != "l_extendedprice"]


@register("target_corr_top8", f"""
SELECT feature, round(corr, 6) AS corr, round(abs(corr), 6) AS abs_corr,
       CAST(row_number() OVER (ORDER BY abs(corr) DESC NULLS LAST, feature) AS INTEGER) AS rank
FROM ({' UNION ALL '.join(f"SELECT '{c}' AS feature, corr({c}, l_extendedprice) AS corr FROM lineitem" for c in _TC_FEATURES)})
QUALIFY rank <= 8
""")
def q_target_corr_top8(spark, sf):
    t = prof.target_corr(_t(spark, sf, "lineitem"), _TC_FEATURES, "l_extendedprice", k=8)
    return t.select("feature", _r("corr", 6).alias("corr"), _r("abs_corr", 6).alias("abs_corr"),
                    "rank")


# --------------------------------------------------------------- histograms

def _hist_sql(tname: str, col: str, bins: int, where: str = "") -> str:
    return f"""WITH r AS (SELECT CASE WHEN min({col}) = max({col}) THEN min({col}) - 0.5 ELSE min({col}) END AS lo,
                  CASE WHEN min({col}) = max({col}) THEN max({col}) + 0.5 ELSE max({col}) END AS hi
           FROM {tname} {where}),
b AS (SELECT CAST(least(floor(({col} - lo) * CAST({bins} AS DOUBLE) / (hi - lo)) + 1, {bins}) AS INTEGER) AS bin,
             count(*) AS n, any_value(lo) AS lo, any_value(hi) AS hi
      FROM {tname}, r {where} {'AND' if where else 'WHERE'} {col} IS NOT NULL GROUP BY 1)
SELECT bin, round(lo + (bin - 1) * ((hi - lo) / CAST({bins} AS DOUBLE)), 6) AS bin_lo,
       round(lo + bin * ((hi - lo) / CAST({bins} AS DOUBLE)), 6) AS bin_hi, coalesce(n, 0) AS n
FROM r, (SELECT CAST(unnest(range(1, {bins} + 1)) AS INTEGER) AS bin)
LEFT JOIN (SELECT bin, n FROM b) USING (bin)"""


@register("histogram", _hist_sql("events", "value", 50))
def q_histogram(spark, sf):
    h = prof.histogram(_t(spark, sf, "events"), "value", bins=50)
    return h.select("bin", _r("bin_lo", 6).alias("bin_lo"), _r("bin_hi", 6).alias("bin_hi"), "n")


@register("scatter_bins", """
WITH r AS (SELECT min(l_quantity) AS xlo, max(l_quantity) AS xhi,
                  min(l_extendedprice) AS ylo, max(l_extendedprice) AS yhi FROM lineitem)
SELECT CAST(least(floor((l_quantity - xlo) * CAST(20 AS DOUBLE) / (xhi - xlo)) + 1, 20) AS INTEGER) AS bin_x,
       CAST(least(floor((l_extendedprice - ylo) * CAST(20 AS DOUBLE) / (yhi - ylo)) + 1, 20) AS INTEGER) AS bin_y,
       count(*) AS n
FROM lineitem, r WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL GROUP BY 1, 2
""")
def q_scatter_bins(spark, sf):
    return prof.scatter_bins(_t(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", 20, 20)


# --------------------------------------------------------------- dashboard aggregates

@register("trend_monthly", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       count(*) AS n, round(avg(o_totalprice), 2) AS avg_value, round(sum(o_totalprice), 2) AS total_value
FROM orders GROUP BY 1, 2
""")
def q_trend_monthly(spark, sf):
    t = prof.trend(_t(spark, sf, "orders"), "o_orderdate", "o_totalprice", "month")
    return t.select("year", "month", "n", _r("avg_value", 2).alias("avg_value"),
                    _r("total_value", 2).alias("total_value"))


@register("group_avg", """
SELECT c_mktsegment, count(*) AS n, round(avg(o_totalprice), 2) AS avg_value
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment
""")
def q_group_avg(spark, sf):
    o = _t(spark, sf, "orders").select("o_custkey", "o_totalprice")
    c = _t(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    joined = o.join(c, o.o_custkey == c.c_custkey)
    g = prof.group_avg(joined, "c_mktsegment", "o_totalprice")
    return g.withColumn("avg_value", _r("avg_value", 2))


@register("kpi", """
SELECT count(o_totalprice) AS n, round(avg(o_totalprice), 2) AS avg_value,
       max(o_totalprice) AS max_value, min(o_totalprice) AS min_value FROM orders
""")
def q_kpi(spark, sf):
    k = prof.kpi(_t(spark, sf, "orders"), "o_totalprice")
    return k.withColumn("avg_value", _r("avg_value", 2))


_BANDS = [0.02, 0.04, 0.06, 0.08]


@register("band_avg", f"""
SELECT CAST({' + '.join(f"CASE WHEN l_discount >= {e} THEN 1 ELSE 0 END" for e in _BANDS)} AS INTEGER) AS band,
       count(*) AS n, round(avg(l_extendedprice), 2) AS avg_value
FROM lineitem WHERE l_discount IS NOT NULL GROUP BY 1
""")
def q_band_avg(spark, sf):
    b = prof.band_avg(_t(spark, sf, "lineitem"), "l_discount", _BANDS, "l_extendedprice")
    return b.select(F.col("band").cast("int").alias("band"), "n",
                    _r("avg_value", 2).alias("avg_value"))


@register("hash_sample")
def q_hash_sample(spark, sf):
    """Seeded 2,000-row sample (the reference's importance subsample); rows-only check."""
    return prof.hash_sample(_t(spark, sf, "orders"), ["o_orderkey"], 2000, seed=42)


# --------------------------------------------------------------- lookups and features

from quarry.operators import curves as crv  # noqa: E402
from quarry.operators import features as feat  # noqa: E402
from quarry.operators import metrics as met  # noqa: E402


@register("dim_lookup", """
SELECT c_custkey, c_nationkey + 5 AS nation_key,
       coalesce(n.n_name, 'unknown-' || CAST(c_nationkey + 5 AS VARCHAR)) AS nation_name,
       n.n_regionkey AS region_key
FROM customer LEFT JOIN nation n ON c_nationkey + 5 = n.n_nationkey
""")
def q_dim_lookup(spark, sf):
    key = F.col("c_nationkey") + 5
    c = _t(spark, sf, "customer").select(
        "c_custkey", key.alias("nation_key"),
        F.concat(F.lit("unknown-"), key.cast("string")).alias("nation_name"))
    n = _t(spark, sf, "nation")
    from quarry.operators.joins import dim_lookup
    return dim_lookup(c, n, "nation_key", dim_key="n_nationkey",
                      attrs={"n_name": "nation_name", "n_regionkey": "region_key"})


@register("feature_completion", """
SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, o.o_totalprice,
       CAST(year(o_orderdate) AS INTEGER) AS Year, CAST(month(o_orderdate) AS INTEGER) AS Month,
       CAST(quarter(o_orderdate) AS INTEGER) AS Quarter, dayname(o_orderdate) AS Day_of_Week,
       CASE WHEN isodow(o_orderdate) IN (5, 6) THEN 'Yes' ELSE 'No' END AS Weekend,
       CASE WHEN month(o_orderdate) IN (5, 6, 7, 12) THEN 'Yes' ELSE 'No' END AS Peak_Season,
       coalesce(c.c_mktsegment, 'UNKNOWN') AS segment, c.c_nationkey AS nation_key,
       CAST(greatest(1, floor(o_totalprice / 20)) AS BIGINT) AS n_units,
       CAST(24.0 AS DOUBLE) AS lighting_hours
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
""")
def q_feature_completion(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    c = _t(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    out = feat.complete_features(
        o, "o_orderdate", dim=c, key="o_custkey", dim_key="c_custkey",
        dim_attrs={"c_mktsegment": "segment", "c_nationkey": "nation_key"},
        ratio_source="o_totalprice", ratio_target="n_units", ratio_divisor=20,
        constants={"lighting_hours": 24.0}, defaults={"segment": ("UNKNOWN", "string")})
    return out


_COERCE_FIXTURE_SQL = """
SELECT event_id,
       CASE WHEN event_type = 'error' THEN 'bad' WHEN event_type = 'purchase' THEN 'NaN'
            ELSE CAST(value AS VARCHAR) END AS units,
       CASE WHEN event_type = 'error' THEN 'bad' WHEN event_type = 'purchase' THEN 'NaN'
            ELSE CAST(value AS VARCHAR) END AS amount,
       '  ' || event_type || chr(9) AS type_text,
       CASE WHEN event_type = 'view' THEN NULL ELSE props END AS props_text
FROM events"""


@register("coerce_batch", f"""
WITH f AS ({_COERCE_FIXTURE_SQL}),
x AS (SELECT *, try_cast(units AS DOUBLE) AS u, try_cast(amount AS DOUBLE) AS a FROM f)
SELECT event_id,
       CAST(trunc(coalesce(CASE WHEN isnan(u) THEN NULL ELSE u END, CAST(0 AS DOUBLE))) AS BIGINT) AS units,
       CASE WHEN isnan(a) THEN NULL ELSE a END AS amount,
       coalesce(regexp_replace(type_text, '^\\s+|\\s+$', '', 'g'), 'nan') AS type_text,
       coalesce(regexp_replace(props_text, '^\\s+|\\s+$', '', 'g'), 'nan') AS props_text
FROM x
""")
def q_coerce_batch(spark, sf):
    ev = _t(spark, sf, "events")
    text = (F.when(F.col("event_type") == "error", F.lit("bad"))
             .when(F.col("event_type") == "purchase", F.lit("NaN"))
             .otherwise(F.col("value").cast("string")))
    raw = ev.select("event_id", text.alias("units"), text.alias("amount"),
                    F.concat(F.lit("  "), F.col("event_type"), F.lit("\t")).alias("type_text"),
                    F.when(F.col("event_type") == "view", F.lit(None).cast("string"))
                     .otherwise(F.col("props")).alias("props_text"))
    return feat.coerce_batch(raw, int_cols=["units"], float_cols=["amount"])


_DOMAIN_RANGES = {"l_quantity": (1, 50), "l_discount": (0.0, 0.1), "l_tax": (0.0, 0.08),
                  "l_extendedprice": (900.0, 50000.0)}
_DOMAIN_CATS = {"l_returnflag": ["A", "N", "R"], "l_linestatus": ["F", "O"]}


def _domain_sql() -> str:
    conds = {c: f"coalesce({c} BETWEEN {lo} AND {hi}, false)" for c, (lo, hi) in _DOMAIN_RANGES.items()}
    conds.update({c: f"coalesce({c} IN ({', '.join(repr(v) for v in vals)}), false)"
                  for c, vals in _DOMAIN_CATS.items()})
    parts = [f"SELECT '{c}' AS rule, count_if(NOT {cond}) AS n_invalid FROM lineitem"
             for c, cond in conds.items()]
    parts.append(f"SELECT 'all', count_if(NOT ({' AND '.join(conds.values())})) FROM lineitem")
    return "\nUNION ALL\n".join(parts)


@register("domain_check", _domain_sql())
def q_domain_check(spark, sf):
    return feat.domain_check(_t(spark, sf, "lineitem"), _DOMAIN_RANGES, _DOMAIN_CATS)


_SEARCH_TERM = "  Customer#0000001(2|5) "


@register("search_filter", """
SELECT c_acctbal, c_custkey, c_name, c_nationkey, c_mktsegment FROM customer
WHERE coalesce(regexp_matches(lower(c_name), 'customer#0000001(2|5)'), false)
""")
def q_search_filter(spark, sf):
    hits = feat.search(_t(spark, sf, "customer"), "c_name", _SEARCH_TERM)
    return feat.reorder(hits, ["c_acctbal", "c_custkey", "c_name"]).orderBy(F.desc("c_acctbal"))


@register("point_lookup", """
SELECT *, concat_ws(' — ', CAST(o_custkey AS VARCHAR), CAST(o_orderdate AS VARCHAR)) AS display_label
FROM orders WHERE o_custkey = 769 AND o_orderdate = TIMESTAMP '1997-05-28 00:00:00'
ORDER BY o_orderkey LIMIT 1
""")
def q_point_lookup(spark, sf):
    return feat.point_lookup(_t(spark, sf, "orders"), "o_custkey", 769, "o_orderdate",
                             "1997-05-28 00:00:00", ["o_orderkey"])


# --------------------------------------------------------------- regression metrics

_PRED_SQL = "l_quantity * CAST(1200 AS DOUBLE) + CAST(500 AS DOUBLE)"


def _pred(df):
    return df.withColumn("prediction", F.col("l_quantity") * 1200.0 + 500.0)


def _metric_round_spark(m):
    digits = {"rmse": 6, "mae": 6, "mse": 2, "r2": 9, "explained_variance": 9, "mape": 6,
              "adjusted_r2": 9}
    return m.select(*[(_r(c, digits[c]).alias(c) if c in digits else F.col(c)) for c in m.columns])


def _regression_sql(y: str, p: str, src: str, k: int | None) -> str:
    adj = (f", round(CASE WHEN n - {k} - 1 > 0 THEN 1 - (1 - r2) * (n - 1) / (n - {k} - 1) END, 9)"
           f" AS adjusted_r2" if k is not None else "")
    return f"""
WITH d AS (SELECT {y} AS y, {p} AS p FROM {src}),
a AS (SELECT count(*) AS n, sum((y - p) * (y - p)) AS sse, sum(abs(y - p)) AS sae,
             var_pop(y) * count(y) AS sst, var_pop(y - p) AS vres, var_pop(y) AS vy,
             avg(abs(y - p) / y) FILTER (WHERE abs(y) > 1e-6) AS mape FROM d),
b AS (SELECT *, CASE WHEN sst = 0 THEN (CASE WHEN sse = 0 THEN 1.0 ELSE 0.0 END) ELSE 1 - sse / sst END AS r2,
             CASE WHEN vy = 0 THEN (CASE WHEN vres = 0 THEN 1.0 ELSE 0.0 END) ELSE 1 - vres / vy END AS ev
      FROM a)
SELECT n, round(sqrt(sse / n), 6) AS rmse, round(sae / n, 6) AS mae, round(sse / n, 2) AS mse,
       round(r2, 9) AS r2, round(ev, 9) AS explained_variance, round(mape * 100, 6) AS mape{adj}
FROM b"""


@register("regression_metrics", _regression_sql("l_extendedprice", _PRED_SQL, "lineitem", 7))
def q_regression_metrics(spark, sf):
    li = _pred(_t(spark, sf, "lineitem"))
    return _metric_round_spark(met.regression_metrics(li, "l_extendedprice", "prediction",
                                                      n_features=7))


@register("circular_metrics", """
WITH d AS (SELECT value AS y, value * CAST(0.9 AS DOUBLE) + CAST(3 AS DOUBLE) AS p,
                  CAST(hour(ts) * 60 + minute(ts) AS DOUBLE) AS base FROM events),
w AS (SELECT y, p, ((base + y) % 1440 + 1440) % 1440 AS t, ((base + p) % 1440 + 1440) % 1440 AS q,
             ((y - p + 720) % 1440 + 1440) % 1440 - 720 AS dd FROM d),
a AS (SELECT count(*) AS n, sum((y - p) * (y - p)) AS sse, sum(abs(y - p)) AS sae,
             sum((t - q) * (t - q)) AS wsse, var_pop(t) * count(t) AS wsst,
             var_pop(t - q) AS wvres, var_pop(t) AS wvy,
             avg(abs(dd) / t) FILTER (WHERE t > 1e-6) AS mape FROM w)
SELECT n, round(sqrt(sse / n), 6) AS rmse, round(sae / n, 6) AS mae, round(sse / n, 2) AS mse,
       round(CASE WHEN wsst = 0 THEN (CASE WHEN wsse = 0 THEN 1.0 ELSE 0.0 END) ELSE 1 - wsse / wsst END, 9) AS r2,
       round(CASE WHEN wvy = 0 THEN (CASE WHEN wvres = 0 THEN 1.0 ELSE 0.0 END) ELSE 1 - wvres / wvy END, 9) AS explained_variance,
       round(mape * 100, 6) AS mape
FROM a
""")
def q_circular_metrics(spark, sf):
    ev = _t(spark, sf, "events")
    d = ev.select(F.col("value").alias("y"), (F.col("value") * 0.9 + 3.0).alias("p"),
                  (F.hour("ts") * 60 + F.minute("ts")).alias("base"))
    return _metric_round_spark(met.circular_metrics(d, "y", "p", "base"))


@register("residual_histogram", _hist_sql(
    f"(SELECT l_extendedprice - ({_PRED_SQL}) AS residual FROM lineitem)", "residual", 60))
def q_residual_histogram(spark, sf):
    li = met.residuals(_pred(_t(spark, sf, "lineitem")), "l_extendedprice", "prediction")
    h = prof.histogram(li, "residual", bins=60)
    return h.select("bin", _r("bin_lo", 6).alias("bin_lo"), _r("bin_hi", 6).alias("bin_hi"), "n")


# --------------------------------------------------------------- classification

_CLS_SRC_SQL = """(SELECT l.quality AS y, CASE WHEN d.n_chars > 2000 THEN 1 ELSE 0 END AS p,
        CAST(d.n_chars AS DOUBLE) AS s
 FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


def _cls_frame(spark, sf):
    lab = _t(spark, sf, "labels").select("doc_id", F.col("quality").alias("y"))
    docs = _t(spark, sf, "documents").select("doc_id", "n_chars")
    j = docs.join(lab, "doc_id")
    return j.select("y", F.when(F.col("n_chars") > 2000, 1).otherwise(0).alias("p"),
                    F.col("n_chars").cast("double").alias("s"))


@register("confusion", f"""
SELECT CAST(y AS VARCHAR) AS label, CAST(p AS VARCHAR) AS prediction, count(*) AS n
FROM {_CLS_SRC_SQL} GROUP BY 1, 2
""")
def q_confusion(spark, sf):
    return met.confusion(_cls_frame(spark, sf), "y", "p")


_PER_CLASS_SQL = f"""
c AS (SELECT CAST(y AS VARCHAR) AS label, CAST(p AS VARCHAR) AS prediction, count(*) AS n
      FROM {_CLS_SRC_SQL} GROUP BY 1, 2),
k AS (SELECT label AS class_label FROM c UNION SELECT prediction FROM c),
pc AS (SELECT class_label,
              coalesce((SELECT sum(n) FROM c WHERE label = class_label), 0) AS support,
              coalesce((SELECT sum(n) FROM c WHERE prediction = class_label), 0) AS predicted,
              coalesce((SELECT sum(n) FROM c WHERE label = class_label AND prediction = class_label), 0) AS tp
       FROM k),
pr AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
              CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM pc),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
                     ELSE 0.0 END AS f1 FROM pr)"""


@register("classification_metrics", f"""
WITH {_PER_CLASS_SQL}
SELECT CAST(sum(support) AS BIGINT) AS n, round(sum(tp) / sum(support), 9) AS accuracy,
       round(sum(precision * support) / sum(support), 9) AS precision,
       round(sum(recall * support) / sum(support), 9) AS recall,
       round(sum(f1 * support) / sum(support), 9) AS f1_score
FROM f
""")
def q_classification_metrics(spark, sf):
    m = met.classification_metrics(_cls_frame(spark, sf), "y", "p")
    return m.select(F.col("n").cast("long").alias("n"),
                    *[_r(c, 9).alias(c) for c in ("accuracy", "precision", "recall", "f1_score")])


@register("classification_report", f"""
WITH {_PER_CLASS_SQL}
SELECT class_label AS row_label, round(precision, 9) AS precision, round(recall, 9) AS recall,
       round(f1, 9) AS f1, CAST(support AS BIGINT) AS support FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 9), CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'macro avg', round(avg(precision), 9), round(avg(recall), 9), round(avg(f1), 9),
                 CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 9),
                 round(sum(recall * support) / sum(support), 9),
                 round(sum(f1 * support) / sum(support), 9), CAST(sum(support) AS BIGINT) FROM f
""")
def q_classification_report(spark, sf):
    r = met.classification_report(_cls_frame(spark, sf), "y", "p")
    return r.select("row_label", *[_r(c, 9).alias(c) for c in ("precision", "recall", "f1")],
                    F.col("support").cast("long").alias("support"))


_CUM_SQL = f"""
d AS {_CLS_SRC_SQL},
c AS (SELECT s AS score, sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS pos,
             sum(CASE WHEN y = 1 THEN 0 ELSE 1 END) AS neg
      FROM d WHERE y IS NOT NULL AND s IS NOT NULL GROUP BY s),
cum AS (SELECT score, CAST(pos AS DOUBLE) AS pos, CAST(neg AS DOUBLE) AS neg,
               CAST(sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS tps,
               CAST(sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS fps,
               CAST(sum(pos) OVER () AS DOUBLE) AS P, CAST(sum(neg) OVER () AS DOUBLE) AS N FROM c)"""


@register("roc_curve", f"""
WITH {_CUM_SQL}
SELECT score AS threshold, CAST(tps AS BIGINT) AS tps, CAST(fps AS BIGINT) AS fps,
       round(tps / P, 9) AS tpr, round(fps / N, 9) AS fpr FROM cum
UNION ALL SELECT NULL, 0, 0, 0.0, 0.0
""")
def q_roc_curve(spark, sf):
    r = crv.roc_curve(_cls_frame(spark, sf), "y", "s")
    return r.select("threshold", "tps", "fps", _r("tpr", 9).alias("tpr"), _r("fpr", 9).alias("fpr"))


@register("roc_auc", f"""
WITH {_CUM_SQL}
SELECT round(sum(pos * ((N - fps) + neg / 2.0)) / (any_value(P) * any_value(N)), 9) AS auc FROM cum
""")
def q_roc_auc(spark, sf):
    return crv.auc(_cls_frame(spark, sf), "y", "s").select(_r("auc", 9).alias("auc"))


@register("pr_curve", f"""
WITH {_CUM_SQL}
SELECT score AS threshold, round(tps / (tps + fps), 9) AS precision, round(tps / P, 9) AS recall FROM cum
UNION ALL SELECT NULL, 1.0, 0.0
""")
def q_pr_curve(spark, sf):
    r = crv.pr_curve(_cls_frame(spark, sf), "y", "s")
    return r.select("threshold", _r("precision", 9).alias("precision"),
                    _r("recall", 9).alias("recall"))


@register("average_precision", f"""
WITH {_CUM_SQL}
SELECT round(sum(pos * tps / (tps + fps)) / any_value(P), 9) AS average_precision FROM cum
""")
def q_average_precision(spark, sf):
    ap = crv.average_precision(_cls_frame(spark, sf), "y", "s")
    return ap.select(_r("average_precision", 9).alias("average_precision"))


_OVR_SCORES_SQL = {"F": "o_totalprice", "O": "CAST(year(o_orderdate) AS DOUBLE)",
                   "P": "CAST(o_custkey AS DOUBLE)"}


@register("auc_ovr", f"""
WITH e AS ({' UNION ALL '.join(f"SELECT '{k}' AS class_label, CASE WHEN o_orderstatus = '{k}' THEN 1 ELSE 0 END AS y, {v} AS s FROM orders" for k, v in _OVR_SCORES_SQL.items())}),
c AS (SELECT class_label, s AS score, CAST(sum(y) AS DOUBLE) AS pos, CAST(sum(1 - y) AS DOUBLE) AS neg
      FROM e WHERE s IS NOT NULL GROUP BY 1, 2),
cum AS (SELECT *, sum(neg) OVER (PARTITION BY class_label ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fps,
               sum(pos) OVER (PARTITION BY class_label) AS P, sum(neg) OVER (PARTITION BY class_label) AS N
        FROM c),
per AS (SELECT class_label, any_value(P) AS n_pos, any_value(N) AS n_neg,
               sum(pos * ((N - fps) + neg / 2.0)) / (any_value(P) * any_value(N)) AS auc
        FROM cum GROUP BY 1)
SELECT class_label, CAST(n_pos AS BIGINT) AS n_pos, round(n_pos / sum(n_pos + n_neg) OVER (), 9) AS prevalence,
       round(auc, 9) AS auc, round(sum(auc * n_pos) OVER () / sum(n_pos) OVER (), 9) AS weighted_auc
FROM per
""")
def q_auc_ovr(spark, sf):
    o = _t(spark, sf, "orders")
    scores = {"F": F.col("o_totalprice"), "O": F.year("o_orderdate").cast("double"),
              "P": F.col("o_custkey").cast("double")}
    a = crv.auc_one_vs_rest(o, "o_orderstatus", scores)
    return a.select("class_label", "n_pos", *[_r(c, 9).alias(c) for c in
                                              ("prevalence", "auc", "weighted_auc")])


# --------------------------------------------------------------- modelling (rows-only checks)

from quarry.operators import importance as imp  # noqa: E402
from quarry.operators import modeling as mdl  # noqa: E402
from quarry.plans import training as trn  # noqa: E402


@register("tournament")
def q_tournament(spark, sf):
    """Leaderboard of the bagged Spark ML pool + weighted ensemble on lineitem."""
    return mdl.leaderboard_frame(spark, trn.lineitem_tournament(spark, sf))


@register("ensemble_weights")
def q_ensemble_weights(spark, sf):
    """Greedy ensemble weights of three fixed predictors from one Gram pass."""
    li = _t(spark, sf, "lineitem").select(
        (F.col("l_extendedprice") + 1e8).alias("l_extendedprice"),  # an offset that dwarfs the spread
        (F.col("l_quantity") * 1000.0 + 1e8).alias("p_low"),
        (F.col("l_quantity") * 1400.0 + 200.0 + 1e8).alias("p_mid"),
        (F.col("l_quantity") * 1800.0 - 300.0 + 1e8).alias("p_high"))
    w, score = mdl.ensemble_from_predictions(li, "l_extendedprice", ["p_low", "p_mid", "p_high"])
    rows = [(k, float(v), float(score)) for k, v in w.items()]
    return spark.createDataFrame(rows, "member string, weight double, ensemble_r2 double")


def _scored_test(spark, sf):
    split, _ = trn.lineitem_splits(spark, sf)
    test = split.filter(F.col("split") == "test").drop("split")
    t = trn.lineitem_tournament(spark, sf)
    from quarry.plans.scoring import score_batch
    return score_batch(test, t, trn.LINEITEM_TARGET, keys=trn.LINEITEM_KEYS)


@register("batch_score")
def q_batch_score(spark, sf):
    """Test split scored by the best model, predictions rounded half-even."""
    return _scored_test(spark, sf)


@register("batch_summary")
def q_batch_summary(spark, sf):
    """count / mean / max / min of the scored batch."""
    from quarry.plans.scoring import batch_summary
    return batch_summary(_scored_test(spark, sf), f"Predicted_{trn.LINEITEM_TARGET}")


@register("class_probability")
def q_class_probability(spark, sf):
    """Per-class probabilities on the document test split, sorted class order."""
    t, split = trn.document_tournament(spark, sf)
    test = split.filter(F.col("split") == "test").drop("split")
    return mdl.predict_proba(test, t).select("doc_id", "quality",
                                             *[f"prob_{lbl}" for lbl in t.labels])


@register("perm_importance")
def q_perm_importance(spark, sf):
    """Permutation importance on a 2,000-row seeded sample of the test split."""
    split, _ = trn.lineitem_splits(spark, sf)
    test = split.filter(F.col("split") == "test").drop("split")
    t = trn.lineitem_tournament(spark, sf)
    return imp.permutation_importance(test, t, trn.LINEITEM_KEYS, n_repeats=5)


# --------------------------------------------------------------- more SQL-checked operators

@register("feature_histograms", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, * FROM ({_hist_sql('lineitem', c, 40)})"
    for c in LINEITEM_NUMERIC))
def q_feature_histograms(spark, sf):
    """40-bin histograms of every numeric lineitem column in one pass."""
    h = prof.histograms(_t(spark, sf, "lineitem"), LINEITEM_NUMERIC, 40)
    return h.select("column_name", "bin", _r("bin_lo", 6).alias("bin_lo"),
                    _r("bin_hi", 6).alias("bin_hi"), "n")


@register("total_missing", f"""
WITH f AS ({_NULL_FIXTURE_SQL})
SELECT CAST(count_if(c_custkey IS NULL) + count_if(c_name IS NULL) + count_if(c_nationkey IS NULL)
            + count_if(c_acctbal IS NULL OR isnan(c_acctbal)) + count_if(c_mktsegment IS NULL)
            AS BIGINT) AS n_missing FROM f
""")
def q_total_missing(spark, sf):
    """Missing cells of a whole table."""
    return qual.total_missing(_null_fixture(spark, sf))


@register("label_lookup", """
SELECT o_orderkey, o_orderstatus,
       CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 END AS class_index
FROM orders
""")
def q_label_lookup(spark, sf):
    """Class label to index with unknown labels NULL (F17, J2); 'P' is not in the label list."""
    from quarry.functions.numeric import label_index
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return o.withColumn("class_index", label_index("o_orderstatus", ["F", "O"]))


@register("fit_range", f"""
SELECT least(min(l_extendedprice), min({_PRED_SQL})) AS range_min,
       greatest(max(l_extendedprice), max({_PRED_SQL})) AS range_max FROM lineitem
""")
def q_fit_range(spark, sf):
    """Perfect-fit line range over actual and predicted values."""
    return prof.fit_range(_pred(_t(spark, sf, "lineitem")), "l_extendedprice", "prediction")


@register("ingestion_summary", """
WITH r AS (SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rk,
                  count(*) OVER () AS n FROM orders),
s AS (SELECT CASE WHEN rk <= floor(n * CAST(0.7 AS DOUBLE)) THEN 'train'
                  WHEN rk <= floor(n * CAST(0.85 AS DOUBLE)) THEN 'val' ELSE 'test' END AS split FROM r)
SELECT 'o_totalprice' AS target_column, 'regression' AS problem_type,
       (SELECT count(*) FROM orders) AS total_rows_raw,
       (SELECT count(*) FROM orders) - (SELECT count(*) FROM (SELECT DISTINCT * FROM orders)) AS duplicate_rows_dropped,
       CAST(0 AS BIGINT) AS total_missing_values,
       (SELECT count(*) FROM s WHERE split = 'train') AS train_rows,
       (SELECT count(*) FROM s WHERE split = 'val') AS val_rows,
       (SELECT count(*) FROM s WHERE split = 'test') AS test_rows,
       CAST(6 AS INTEGER) AS n_columns
""")
def q_ingestion_summary(spark, sf):
    """Stage-1 report on orders: quality before de-dup, then the chronological split."""
    from quarry.plans.stages import ingest
    rep = ingest(_t(spark, sf, "orders"), "o_totalprice", "o_orderdate", ["o_orderkey"]).report
    return rep.select("target_column", "problem_type", "total_rows_raw", "duplicate_rows_dropped",
                      "total_missing_values", "train_rows", "val_rows", "test_rows", "n_columns")


@register("eda_summary", """
WITH r AS (SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rk,
                  count(*) OVER () AS n FROM orders),
t AS (SELECT * FROM r WHERE rk <= floor(n * CAST(0.7 AS DOUBLE))),
q AS (SELECT quantile_cont(o_orderkey, 0.25) AS k1, quantile_cont(o_orderkey, 0.75) AS k3,
             quantile_cont(o_custkey, 0.25) AS c1, quantile_cont(o_custkey, 0.75) AS c3 FROM t)
SELECT count(*) AS n_rows, CAST(2 AS INTEGER) AS n_numeric_features,
       CAST(2 AS INTEGER) AS n_categorical_features,
       (SELECT count(*) FROM t, q WHERE o_orderkey < k1 - 1.5 * (k3 - k1) OR o_orderkey > k3 + 1.5 * (k3 - k1))
     + (SELECT count(*) FROM t, q WHERE o_custkey < c1 - 1.5 * (c3 - c1) OR o_custkey > c3 + 1.5 * (c3 - c1))
       AS total_outliers_iqr,
       round(avg(o_totalprice), 6) AS target_mean, round(stddev_samp(o_totalprice), 6) AS target_std,
       round(quantile_cont(o_totalprice, 0.5), 6) AS target_median,
       round(skewness(o_totalprice), 6) AS target_skew
FROM t
""")
def q_eda_summary(spark, sf):
    """Stage-2 report on the orders training split."""
    from quarry.plans.stages import profile_train
    orders = _t(spark, sf, "orders")
    train = chronological_split(orders, "o_orderdate", ["o_orderkey"]).filter("split = 'train'")
    rep = profile_train(train.drop("split"), "o_totalprice", with_charts=False).report
    st = F.col("target_stats")
    return rep.select("n_rows", "n_numeric_features", "n_categorical_features",
                      "total_outliers_iqr",
                      *[_r(st[k], 6).alias(k) for k in ("target_mean", "target_std",
                                                         "target_median", "target_skew")])


_BLEND = {"p_low": "l_quantity * CAST(1000 AS DOUBLE)",
          "p_mid": "l_quantity * CAST(1400 AS DOUBLE) + CAST(200 AS DOUBLE)",
          "p_high": "l_quantity * CAST(1800 AS DOUBLE) - CAST(300 AS DOUBLE)"}
_BLEND_W = {"p_low": 0.5, "p_mid": 0.3, "p_high": 0.2}


@register("ensemble_blend_r2", f"""
WITH d AS (SELECT l_extendedprice + 1e8 AS y,
                  {' + '.join(f"CAST({w} AS DOUBLE) * ({_BLEND[k]} + 1e8)" for k, w in _BLEND_W.items())} AS p
           FROM lineitem),
a AS (SELECT sum((y - p) * (y - p)) AS sse, var_pop(y) * count(y) AS sst FROM d)
SELECT round(1 - sse / sst, 6) AS r2 FROM a
""")
def q_ensemble_blend_r2(spark, sf):
    """R^2 of a fixed blend from the one-pass Gram statistics (the T6 search's only data pass)."""
    li = _t(spark, sf, "lineitem").select(
        (F.col("l_extendedprice") + 1e8).alias("l_extendedprice"),  # an offset that dwarfs the spread
        (F.col("l_quantity") * 1000.0 + 1e8).alias("p_low"),
        (F.col("l_quantity") * 1400.0 + 200.0 + 1e8).alias("p_mid"),
        (F.col("l_quantity") * 1800.0 - 300.0 + 1e8).alias("p_high"))
    names = list(_BLEND_W)
    g = mdl.gram_stats(li, "l_extendedprice", names)
    r2 = mdl.r2_from_gram(g, [_BLEND_W[k] for k in names])
    # one-row result built from the aggregate; rounded like the SQL
    return spark.createDataFrame([(round(r2, 6),)], "r2 double")


@register("bounded_read", """
SELECT * FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 10000
""")
def q_bounded_read(spark, sf):
    """First 10,000 records in date order (S3: the reference's bounded sample read)."""
    from quarry.sources.delimited import bounded_read
    return bounded_read(_t(spark, sf, "orders"), ["o_orderdate", "o_orderkey"], 10_000)


@register("drop_empty_columns", f"""
SELECT l_returnflag, l_linestatus, l_quantity, l_discount, l_tax FROM ({_QUALITY_FIXTURE_SQL})
""")
def q_drop_empty_columns(spark, sf):
    """Fully-null columns removed (P5): the injected all-null column disappears."""
    return qual.drop_empty_columns(_quality_fixture(spark, sf))


@register("preview", """
SELECT * FROM lineitem ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate LIMIT 5
""")
def q_preview(spark, sf):
    """Head of a table in a stated order."""
    from quarry.operators.features import preview
    return preview(_t(spark, sf, "lineitem"),
                   ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"], 5)


# --------------------------------------------------------------- inputs with odd cells, and the rest of the curves

@register("quality_summary_nan", f"""
WITH f AS (SELECT l_returnflag, nullif(l_discount, CAST(0 AS DOUBLE)) AS l_discount,
                  CAST(NULL AS DOUBLE) AS l_unused FROM lineitem),
d AS (SELECT count(*) AS n_distinct FROM (SELECT DISTINCT * FROM f))
SELECT count(*) AS n_rows, count(*) - any_value(n_distinct) AS n_duplicate_rows,
       CAST(count_if(l_discount IS NULL) + count(*) AS BIGINT) AS n_missing, 'l_unused' AS constant_columns
FROM f, d
""")
def q_quality_summary_nan(spark, sf):
    """NaN counts as missing, and rows that differ in NaN and NULL alone are duplicates."""
    nan = F.lit(float("nan"))
    df = _t(spark, sf, "lineitem").select(
        "l_returnflag",
        F.when(F.col("l_discount") != 0, F.col("l_discount"))
         .when(F.col("l_linenumber") % 2 == 0, nan).alias("l_discount"),
        F.when(F.col("l_linenumber") % 2 == 0, nan).alias("l_unused"))
    s = qual.quality_summary(df)
    return s.select("n_rows", "n_duplicate_rows", "n_missing",
                    F.array_join("constant_columns", ",").alias("constant_columns"))


@register("drop_empty_columns_nan", "SELECT l_returnflag, l_tax FROM lineitem")
def q_drop_empty_columns_nan(spark, sf):
    """A column of NaN alone is empty (P5)."""
    return qual.drop_empty_columns(_t(spark, sf, "lineitem").select(
        "l_returnflag", "l_tax", F.lit(float("nan")).alias("l_unused")))


@register("regression_metrics_missing", _regression_sql(
    "l_extendedprice", _PRED_SQL, "(SELECT * FROM lineitem WHERE l_quantity <> 7 AND l_tax <> 0.05)", 7))
def q_regression_metrics_missing(spark, sf):
    """Rows without a label or prediction (NULL or NaN) enter no term and not n (M1, M5)."""
    li = _pred(_t(spark, sf, "lineitem")).withColumns({
        "prediction": F.when(F.col("l_quantity") != 7, F.col("prediction")),
        "l_extendedprice": F.when(F.col("l_tax") == 0.05, F.lit(float("nan")))
                            .otherwise(F.col("l_extendedprice"))})
    return _metric_round_spark(met.regression_metrics(li, "l_extendedprice", "prediction",
                                                      n_features=7))


@register("corr_constant", """
SELECT 'tenth' AS column_a, 'l_quantity' AS column_b, CAST(NULL AS DOUBLE) AS corr
UNION ALL SELECT 'l_tax', 'l_quantity', round(corr(l_tax, l_quantity), 6) FROM lineitem
UNION ALL SELECT 'l_tax', 'tenth', NULL
""")
def q_corr_constant(spark, sf):
    """A constant column has no correlation."""
    c = prof.corr_pairs(_t(spark, sf, "lineitem").withColumn("tenth", F.lit(0.1)),
                        ["l_quantity", "tenth", "l_tax"])
    return c.withColumn("corr", _r("corr", 6))


@register("coerce_odd_cells", """
SELECT event_id,
       CASE event_type WHEN 'click' THEN 7 WHEN 'error' THEN CAST(trunc(value) AS BIGINT) ELSE 0 END AS units,
       CASE event_type WHEN 'click' THEN CAST(7 AS DOUBLE) WHEN 'view' THEN CAST('1e30' AS DOUBLE)
            WHEN 'error' THEN value END AS amount,
       CASE event_type WHEN 'click' THEN '7' WHEN 'view' THEN '1e30' WHEN 'error' THEN 'x' ELSE '1d' END AS note
FROM events
""")
def q_coerce_odd_cells(spark, sf):
    """Numbers beyond 64 bits, type suffixes and blanks beyond ASCII in uploaded cells."""
    kind = F.col("event_type")
    cell = (F.when(kind == "click", " 7　").when(kind == "view", "1e30")
             .when(kind == "error", F.col("value").cast("string")).otherwise("1d"))
    note = F.when(kind == "error", " x ").otherwise(cell)
    raw = _t(spark, sf, "events").select("event_id", cell.alias("units"), cell.alias("amount"),
                                         note.alias("note"))
    return feat.coerce_batch(raw, int_cols=["units"], float_cols=["amount"])


@register("roc_auc_one_class", "SELECT CAST(NULL AS DOUBLE) AS auc")
def q_roc_auc_one_class(spark, sf):
    """A split that holds one class has no AUC, and raises no error (M7)."""
    return crv.auc(_cls_frame(spark, sf).filter("y = 1"), "y", "s").select("auc")


_OVR_CUM_SQL = f"""
e AS ({' UNION ALL '.join(f"SELECT '{k}' AS class_label, CASE WHEN o_orderstatus = '{k}' THEN 1 ELSE 0 END AS y, {v} AS s FROM orders" for k, v in _OVR_SCORES_SQL.items())}),
c AS (SELECT class_label, s AS score, CAST(sum(y) AS DOUBLE) AS pos, CAST(sum(1 - y) AS DOUBLE) AS neg
      FROM e WHERE s IS NOT NULL GROUP BY 1, 2),
cum AS (SELECT class_label, score, sum(pos) OVER w AS tps, sum(neg) OVER w AS fps,
               sum(pos) OVER (PARTITION BY class_label) AS P, sum(neg) OVER (PARTITION BY class_label) AS N
        FROM c WINDOW w AS (PARTITION BY class_label ORDER BY score DESC ROWS UNBOUNDED PRECEDING))"""


def _ovr_scores():
    return {"F": F.col("o_totalprice"), "O": F.year("o_orderdate").cast("double"),
            "P": F.col("o_custkey").cast("double")}


@register("roc_by_class", f"""
WITH {_OVR_CUM_SQL}
SELECT class_label, score AS threshold, round(tps / P, 9) AS tpr, round(fps / N, 9) AS fpr FROM cum
""")
def q_roc_by_class(spark, sf):
    r = crv.roc_curves_by_class(_t(spark, sf, "orders"), "o_orderstatus", _ovr_scores())
    return r.select("class_label", "threshold", _r("tpr", 9).alias("tpr"), _r("fpr", 9).alias("fpr"))


@register("pr_by_class", f"""
WITH {_OVR_CUM_SQL}
SELECT class_label, score AS threshold, round(tps / (tps + fps), 9) AS precision, round(tps / P, 9) AS recall
FROM cum
UNION ALL SELECT DISTINCT class_label, NULL, 1.0, 0.0 FROM cum
""")
def q_pr_by_class(spark, sf):
    """Precision-recall points of every class, each with its end point (M9)."""
    r = crv.pr_curves_by_class(_t(spark, sf, "orders"), "o_orderstatus", _ovr_scores())
    return r.select("class_label", "threshold", _r("precision", 9).alias("precision"),
                    _r("recall", 9).alias("recall"))


@register("box_all", """
WITH q AS (SELECT quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.5) AS median,
                  quantile_cont(o_totalprice, 0.75) AS q3 FROM orders),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT count(*) AS n, min(o_totalprice) AS min, max(o_totalprice) AS max, round(any_value(q1), 6) AS q1,
       round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3,
       min(o_totalprice) FILTER (WHERE o_totalprice >= lo) AS lower_whisker,
       max(o_totalprice) FILTER (WHERE o_totalprice <= hi) AS upper_whisker,
       count_if(o_totalprice < lo OR o_totalprice > hi) AS n_outliers
FROM orders, f
""")
def q_box_all(spark, sf):
    """Five-number box data without groups."""
    b = prof.box_stats(_t(spark, sf, "orders"), "o_totalprice")
    return b.withColumns({c: _r(c, 6) for c in ("q1", "median", "q3")})


@register("trend_yearly", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n, round(avg(o_totalprice), 2) AS avg_value,
       round(sum(o_totalprice), 2) AS total_value
FROM orders GROUP BY 1
""")
def q_trend_yearly(spark, sf):
    t = prof.trend(_t(spark, sf, "orders"), "o_orderdate", "o_totalprice", "year")
    return t.select("year", "n", _r("avg_value", 2).alias("avg_value"),
                    _r("total_value", 2).alias("total_value"))


_SPLIT_SQL = """
r AS (SELECT l_quantity AS x, l_extendedprice AS y, count(*) OVER () AS n,
             row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rk
      FROM lineitem),
s AS (SELECT *, CASE WHEN rk <= floor(n * CAST(0.7 AS DOUBLE)) THEN 'train'
                     WHEN rk <= floor(n * CAST(0.85 AS DOUBLE)) THEN 'val' ELSE 'test' END AS split FROM r)"""


@register("linear_test_metrics", f"""
WITH {_SPLIT_SQL},
m AS (SELECT regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM s WHERE split = 'train'),
d AS (SELECT y, a * x + b AS p FROM s, m WHERE split = 'test')
SELECT count(*) AS n, round(sqrt(avg((y - p) * (y - p))), 3) AS rmse, round(avg(abs(y - p)), 3) AS mae,
       round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2
FROM d
""")
def q_linear_test_metrics(spark, sf):
    """Split, fit on train, score the test split: with one feature the linear member is least squares
    (T1, T3, T8, M1)."""
    split = chronological_split(_t(spark, sf, "lineitem"), "l_shipdate", trn.LINEITEM_KEYS).select(
        "l_quantity", trn.LINEITEM_TARGET, "split", "l_orderkey")
    part = {k: split.filter(F.col("split") == k).drop("split") for k in ("train", "val", "test")}
    pool = {"linear": mdl.model_pool("regression")["linear"]}
    t = mdl.run_tournament(part["train"], part["val"], trn.LINEITEM_TARGET, "regression", ["l_orderkey"],
                           folds=1, pool=pool, exclude=("l_orderkey",))
    scored = mdl.predict(part["test"], t, model="linear", out_col="p")
    m = met.regression_metrics(scored, trn.LINEITEM_TARGET, "p")
    return m.select("n", _r("rmse", 3).alias("rmse"), _r("mae", 3).alias("mae"), _r("r2", 6).alias("r2"))


@register("lower_strip", """
SELECT event_id, lower(event_type) AS kind FROM events
""")
def q_lower_strip(spark, sf):
    """Text lower-cased and stripped of any white space, beyond ASCII too."""
    from quarry.functions.coerce import lower_strip
    padded = F.concat(F.lit("\u00a0 \t"), F.initcap("event_type"), F.lit(" \u3000"))
    return _t(spark, sf, "events").select("event_id", lower_strip(padded).alias("kind"))


# --------------------------------------------------------------- differences

@register("first_difference", """
SELECT event_id, value - lag(value) OVER (ORDER BY ts, event_id) AS value_diff FROM events
""")
def q_first_difference(spark, sf):
    events = _t(spark, sf, "events").select("event_id", "ts", "value")
    return first_difference(events, "value", ["ts", "event_id"]).select("event_id", "value_diff")


@register("first_difference_by_group", """
SELECT o_orderkey, o_totalprice - lag(o_totalprice) OVER (
         PARTITION BY o_orderstatus, o_orderpriority ORDER BY o_orderdate, o_orderkey) AS change
FROM orders
""")
def q_first_difference_by_group(spark, sf):
    orders = _t(spark, sf, "orders")
    return first_difference(orders, "o_totalprice", ["o_orderdate", "o_orderkey"],
                            ["o_orderstatus", "o_orderpriority"], out="change").select("o_orderkey", "change")


# --------------------------------------------------------------- permutation importance of a formula

_IMPORTANCE_FEATURES = ["l_quantity", "l_discount", "l_linenumber"]
_IMPORTANCE_PRED = "1500 * {0} - 20000 * {1} + 10 * {2}"


def _importance_sql(repeats: int = 3) -> str:
    key = ("concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR), "
           "CAST(l_suppkey AS VARCHAR))")
    parts = ["SELECT -1 AS f, 0 AS r, l_extendedprice AS y, "
             + _IMPORTANCE_PRED.format(*_IMPORTANCE_FEATURES) + " AS p FROM placed"]
    for f, name in enumerate(_IMPORTANCE_FEATURES):
        own = [f"d.{c}" if c == name else f"b.{c}" for c in _IMPORTANCE_FEATURES]
        parts += [f"""SELECT {f}, {r}, b.l_extendedprice, {_IMPORTANCE_PRED.format(*own)} FROM placed b JOIN (
  SELECT {name}, row_number() OVER (ORDER BY md5(k || '|42|{f}|{r}')) AS i FROM keyed) d USING (i)"""
                  for r in range(repeats)]
    return f"""
WITH keyed AS (SELECT *, {key} AS k FROM lineitem),
placed AS (SELECT *, row_number() OVER (ORDER BY md5(k || '|42')) AS i FROM keyed),
v AS ({" UNION ALL ".join(parts)}),
s AS (SELECT f, r, 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y)) AS score FROM v GROUP BY f, r),
d AS (SELECT s.f, b.score - s.score AS fall FROM s, (SELECT score FROM s WHERE f = -1) b WHERE s.f >= 0)
SELECT CASE f {" ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(_IMPORTANCE_FEATURES))} END AS feature,
       round(avg(fall), 8) AS importance, round(stddev_samp(fall), 8) AS stddev, CAST(count(*) AS INTEGER) AS n
FROM d GROUP BY f"""


@register("importance_of_formula", _importance_sql())
def q_importance_of_formula(spark, sf):
    """Permutation importance of a closed-form predictor on all of lineitem."""
    rows = _t(spark, sf, "lineitem").select(*trn.LINEITEM_KEYS, "l_quantity", "l_discount", "l_extendedprice")
    formula = F.expr(_IMPORTANCE_PRED.format(*_IMPORTANCE_FEATURES))
    table_ = imp.importance_by_variant(rows, trn.LINEITEM_KEYS, _IMPORTANCE_FEATURES,
                                       imp.r2_by_variant("l_extendedprice", formula), n_repeats=3)
    return table_.select("feature", _r("importance", 8).alias("importance"), _r("stddev", 8).alias("stddev"), "n")


# --------------------------------------------------------------- correlation where values are missing

_GAPS = {"l_quantity": "nullif(l_quantity, 7)", "l_discount": "nullif(l_discount, 0.05)", "l_tax": "l_tax",
         "l_extendedprice": "CASE WHEN l_linenumber = 3 THEN CAST('NaN' AS DOUBLE) ELSE l_extendedprice END",
         "fixed": "CASE WHEN l_quantity = 7 THEN 1D ELSE 0D END"}
_GAP_PAIRS = [(a, b) for i, a in enumerate(_GAPS) for b in list(_GAPS)[:i]]


def _gaps_sql() -> str:
    cols = ", ".join(f"nullif({e.replace('1D', '1.0::DOUBLE').replace('0D', '0.0::DOUBLE')}, "
                     f"CAST('NaN' AS DOUBLE)) AS {c}" for c, e in _GAPS.items())
    one = ("SELECT '{0}' AS column_a, '{1}' AS column_b, round(CASE WHEN min({0}) = max({0}) OR min({1}) = max({1}) THEN NULL "
           "ELSE corr({0}, {1}) END, 6) AS corr FROM g WHERE {0} IS NOT NULL AND {1} IS NOT NULL")
    return f"WITH g AS (SELECT {cols} FROM lineitem)\n" + "\nUNION ALL\n".join(one.format(a, b) for a, b in _GAP_PAIRS)


@register("corr_with_gaps", _gaps_sql())
def q_corr_with_gaps(spark, sf):
    rows = _t(spark, sf, "lineitem").select(*[F.expr(e).alias(c) for c, e in _GAPS.items()])
    return prof.corr_pairs(rows, list(_GAPS)).withColumn("corr", _r("corr", 6))


# --------------------------------------------------------------- top values of wide columns

def _top_sql(tname: str, col: str, expr: str, k: int) -> str:
    return (f"SELECT '{col}' AS column_name, value, n, CAST(rank AS INTEGER) AS rank FROM (SELECT value, count(*) AS n, "
            f"row_number() OVER (ORDER BY count(*) DESC, value) AS rank FROM (SELECT {expr} AS value FROM {tname}) "
            f"WHERE value IS NOT NULL GROUP BY value) WHERE rank <= {k}")


_WIDE = {"word": "CASE WHEN l_linenumber <= 2 THEN 'often ' || CAST(l_linenumber AS STRING) ELSE CAST(l_partkey AS STRING) END",
         "l_suppkey": "CAST(l_suppkey AS STRING)", "l_comment_key": "CAST(l_orderkey * 10 + l_linenumber AS STRING)"}


@register("value_counts_wide", "\nUNION ALL\n".join(
    _top_sql("lineitem", c, e.replace("STRING", "VARCHAR"), 2 if c == "word" else 5) for c, e in _WIDE.items()))
def q_value_counts_wide(spark, sf):
    """Two values far above thousands of others (proved by the sketch), a narrow key, and a column of near-unique values."""
    rows = _t(spark, sf, "lineitem").select(*[F.expr(e).alias(c) for c, e in _WIDE.items()])
    return prof.value_counts(rows, ["word"], 2).unionByName(prof.value_counts(rows, ["l_suppkey", "l_comment_key"], 5))


# --------------------------------------------------------------- modelling against SQL

def _md5_number(text: str) -> str:
    """The first 32 bits of an MD5 text as a number."""
    return " + ".join(f"(instr('0123456789abcdef', substr(md5({text}), {i + 1}, 1)) - 1) * {16 ** (7 - i)}" for i in range(8))


_BAGGED_SQL = f"""
r AS (SELECT l_orderkey, l_linenumber, l_quantity AS x, l_extendedprice AS y, count(*) OVER () AS n,
             row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rk,
             ({_md5_number("concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), '42')")}) % 3 AS f
      FROM lineitem),
s AS (SELECT *, CASE WHEN rk <= floor(n * CAST(0.7 AS DOUBLE)) THEN 'train'
                     WHEN rk <= floor(n * CAST(0.85 AS DOUBLE)) THEN 'val' ELSE 'test' END AS split FROM r),
m AS (SELECT j, regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM s, (VALUES (0), (1), (2)) v(j)
      WHERE split = 'train' AND f <> j GROUP BY j),
bag AS (SELECT avg(a) AS a, avg(b) AS b FROM m),
p AS (SELECT split, x, y, a * x + b AS p FROM s, bag)"""


def _bagged(spark, sf):
    """Split, three folds by the digest of the key, least squares on each fold's complement."""
    key = ("bagged_linear", spark.sparkContext.applicationId, sf)
    if key not in trn._CACHE:
        split = chronological_split(_t(spark, sf, "lineitem"), "l_shipdate", trn.LINEITEM_KEYS).select(
            "l_quantity", trn.LINEITEM_TARGET, "split", "l_orderkey", "l_linenumber")
        part = {k: split.filter(F.col("split") == k).drop("split") for k in ("train", "val", "test")}
        pool = {"linear": mdl.model_pool("regression")["linear"]}
        t = mdl.run_tournament(part["train"], part["val"], trn.LINEITEM_TARGET, "regression",
                               ["l_orderkey", "l_linenumber"], folds=3, pool=pool, exclude=("l_orderkey", "l_linenumber"))
        trn._CACHE[key] = (t, part["test"])
    return trn._CACHE[key]


@register("bagged_linear", f"""
WITH {_BAGGED_SQL}
SELECT count(*) AS n, round(sqrt(avg((y - p) * (y - p))), 3) AS rmse, round(avg(abs(y - p)), 3) AS mae,
       round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2
FROM p WHERE split = 'test'
""")
def q_bagged_linear(spark, sf):
    """Test metrics of the bagged linear member."""
    t, test = _bagged(spark, sf)
    scored = mdl.predict(test, t, model="linear", out_col="p")
    m = met.regression_metrics(scored, trn.LINEITEM_TARGET, "p")
    return m.select("n", _r("rmse", 3).alias("rmse"), _r("mae", 3).alias("mae"), _r("r2", 6).alias("r2"))


@register("bagged_leaderboard", f"""
WITH {_BAGGED_SQL},
v AS (SELECT round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS score FROM p WHERE split = 'val')
SELECT 'linear_bag' AS model, score AS score_val, 'r2' AS eval_metric, CAST(1 AS INTEGER) AS stack_level,
       CAST(1 AS INTEGER) AS fit_order FROM v
UNION ALL SELECT 'weighted_ensemble', score, 'r2', CAST(2 AS INTEGER), CAST(2 AS INTEGER) FROM v
""")
def q_bagged_leaderboard(spark, sf):
    """The leaderboard of one bagged member and its ensemble, without times."""
    t, _ = _bagged(spark, sf)
    return mdl.leaderboard_frame(spark, t).select("model", _r("score_val", 6).alias("score_val"), "eval_metric",
                                                  "stack_level", "fit_order")


@register("bagged_batch", f"""
WITH {_BAGGED_SQL},
q AS (SELECT round_even(p, 0) AS p FROM p WHERE split = 'test')
SELECT count(*) AS n_rows, round(avg(p), 3) AS avg_prediction, max(p) AS max_prediction, min(p) AS min_prediction FROM q
""")
def q_bagged_batch(spark, sf):
    """The test rows as a scored batch, rounded half-even, and its summary."""
    from quarry.plans.scoring import batch_summary, score_batch
    t, test = _bagged(spark, sf)
    scored = score_batch(test, t, trn.LINEITEM_TARGET, keys=["l_orderkey", "l_linenumber"], digits=0, sort=False)
    out = batch_summary(scored, f"Predicted_{trn.LINEITEM_TARGET}")
    return out.withColumn("avg_prediction", _r("avg_prediction", 3))


@register("target_statistics", f"""
WITH b AS (SELECT o_orderkey, o_custkey AS v, o_totalprice AS y,
                  ({_md5_number("concat_ws('|', CAST(o_orderkey AS VARCHAR), '42')")}) % 3 AS f FROM orders),
c AS (SELECT v, f, count(*) AS n, sum(y) AS s FROM b GROUP BY v, f),
w AS (SELECT v, sum(n) AS n, sum(s) AS s FROM c GROUP BY v),
t AS (SELECT f, count(*) AS n, sum(y) AS s FROM b GROUP BY f),
a AS (SELECT t.f, ((SELECT sum(y) FROM b) - t.s) / ((SELECT count(*) FROM b) - t.n) AS prior FROM t)
SELECT o_orderkey, round((w.s - c.s + 10 * prior) / (w.n - c.n + 10), 4) AS customer_value
FROM b JOIN c USING (v, f) JOIN w USING (v) JOIN a USING (f)
""")
def q_target_statistics(spark, sf):
    """Out-of-fold smoothed means of the target by a wide categorical."""
    from quarry.operators import encoding
    rows = _t(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("customer"), "o_totalprice")
    rows = rows.withColumn("fold", mdl.fold_of(["o_orderkey"], 3, 42))
    _, out = encoding.learn(rows, ["customer"], [F.col("o_totalprice")], "fold")
    return out.select("o_orderkey", _r("_ts_customer", 4).alias("customer_value"))


@register("hash_sample_md5", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '|42') LIMIT 2000
""")
def q_hash_sample_md5(spark, sf):
    """The reproducible sample by a digest that other engines have too."""
    return prof.hash_sample(_t(spark, sf, "orders"), ["o_orderkey"], 2000, seed=42, digest="md5").select(
        "o_orderkey", "o_totalprice")


# --------------------------------------------------------------- delimited text with line breaks in quotes

@register("csv_spanning_lines", """
SELECT doc_id, length(text) AS chars, md5(text) AS digest, n_chars FROM documents WHERE trim(text) <> ''
""")
def q_csv_spanning_lines(spark, sf):
    """All documents written as delimited text, whose quoted fields span lines, and read back by the sniffing reader."""
    import uuid
    from quarry.session import ensure_checkpoint_dir
    from quarry.sources.delimited import read_delimited
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/quarry-{uuid.uuid4().hex}/documents.csv"
    docs = _t(spark, sf, "documents").select("doc_id", "text", "n_chars").filter("trim(text) <> ''")
    docs.write.option("header", True).option("quoteAll", True).option("escape", '"') \
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(folder)
    return read_delimited(spark, folder).select("doc_id", F.length("text").alias("chars"), F.md5(
        F.col("text").cast("binary")).alias("digest"), "n_chars")
