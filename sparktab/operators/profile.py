"""Column profiling.

The profile is built from two shuffles for any number of columns:

* one wide ``agg`` of the numeric moments (mean, sample std, min, max, skew, kurtosis) -
  a single-row partial aggregate per task, no distinct aggregates;
* one ``groupBy(column, value).count()`` over the unpivoted table, which yields null counts,
  exact distinct counts and top values for every column at once, with map-side combine.

Quantiles are exact (linear interpolation, as pandas) by selection: sketches bracket the ranks, and only
the few values inside the brackets are counted one by one (see :func:`quantiles`).  ``exact=False`` returns
``percentile_approx`` sketches themselves.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pyspark import StorageLevel

from sparktab.functions.scalar import is_float, present
from sparktab.operators.joins import attach, checked_small
from sparktab.operators.ordering import global_index, prefix_sum

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
STRINGY = (T.StringType, T.BooleanType)

# Groups whose sizes may be read on the driver to build the rank requests locally.
MAX_LOCAL_GROUPS = 10_000

# Brackets reach so far to both sides of a quantile's probability; a sketch is right to 1 / accuracy.
SKETCH_ACCURACY = 10_000
MARGIN = 3 / SKETCH_ACCURACY

# Distinct values per group that one window task may sort; above it ranks come from the
# distributed index (range partitioning + blocked prefix sums).
MAX_WINDOW_ROWS = 2_000_000


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC) and f.name not in exclude]


def string_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, STRINGY) and f.name not in exclude]


def _is_missing(df: DataFrame, c: str):
    dt = df.schema[c].dataType
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return F.col(c).isNull() | F.isnan(c)
    return F.col(c).isNull()


def value_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(column, value, cnt) for every column; the null value carries the missing count."""
    cols = cols or df.columns
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"),
                               F.when(_is_missing(df, c), F.lit(None)).otherwise(F.col(c).cast("string")).alias("value"))
                      for c in cols])
    return df.select(F.inline(pairs)).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("cnt"))


def column_stats(df: DataFrame, cols: list[str] | None = None, exact: bool = True) -> DataFrame:
    """(column, dtype, n_rows, null_count, null_pct, n_unique) per column.

    ``exact`` counts distinct values through one ``groupBy(column, value)``; ``exact=False`` uses
    HyperLogLog++ sketches in a single aggregate (no shuffle of values) for the widest tables.
    """
    cols = cols or df.columns
    if exact:
        vc = value_counts(df, cols)
        st = vc.groupBy("column_name").agg(
            F.sum("cnt").alias("n_rows"),
            F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("cnt"))), F.lit(0)).alias("null_count"),
            F.count("value").alias("n_unique"))
    else:
        one = df.agg(F.count(F.lit(1)).alias("_n"),
                     *[F.count_if(_is_missing(df, c)).alias(f"_m{i}") for i, c in enumerate(cols)],
                     *[F.approx_count_distinct(F.when(~_is_missing(df, c), F.col(c))).alias(f"_d{i}")
                       for i, c in enumerate(cols)])
        st = one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col("_n").alias("n_rows"),
                                                    F.col(f"_m{i}").alias("null_count"), F.col(f"_d{i}").alias("n_unique"))
                                           for i, c in enumerate(cols)])))
    types = df.sparkSession.createDataFrame([(c, df.schema[c].dataType.simpleString()) for c in cols],
                                            "column_name string, dtype string")
    return (st.join(F.broadcast(types), "column_name")  # one row per column
              .select("column_name", "dtype", "n_rows", "null_count",
                      F.round(F.lit(100.0) * F.col("null_count") / F.greatest(F.col("n_rows"), F.lit(1)), 2)
                      .alias("null_pct"), "n_unique"))


def top_values(df: DataFrame, cols: list[str] | None = None, k: int = 5) -> DataFrame:
    """(column, rank, value, cnt) - k most frequent non-null values, ties by value ascending.

    The rank filter becomes a ``WindowGroupLimit`` that keeps k rows per column inside each task
    before the final window, so high-cardinality columns never meet in one task.
    """
    cols = cols or string_columns(df)
    vc = value_counts(df, cols).where(F.col("value").isNotNull())
    w = Window.partitionBy("column_name").orderBy(F.col("cnt").desc(), F.col("value").asc())
    return vc.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _bounds(probs) -> list[float]:
    """Probabilities of the lower, then the upper ends of the brackets around ``probs``."""
    return [max(0.0, p - MARGIN) for p in probs] + [min(1.0, p + MARGIN) for p in probs]


def _sketch(x: Column, probs) -> Column:
    return F.percentile_approx(x, _bounds(probs), SKETCH_ACCURACY)


def _cell(x: Column, ends: list[Column]) -> tuple[Column, Column]:
    """(place, value) of ``x`` among the brackets: inside a bracket the value itself, outside none.  The
    place counts the ends that ``x`` has passed, so what shares one lies between the same brackets."""
    m = len(ends) // 2
    place = sum([(x >= e).cast("int") for e in ends[:m]] + [(x > e).cast("int") for e in ends[m:]])
    inside = F.lit(False)
    for lo, hi in zip(ends[:m], ends[m:]):
        inside = inside | x.between(lo, hi)
    return place, F.when(inside, x)


def quantiles(df: DataFrame, cols: list[str], probs=(0.25, 0.5, 0.75), exact: bool = True, ends: dict | None = None) -> DataFrame:
    """(column_name, prob, value): linear-interpolated quantiles of the non-null values of ``cols``.

    Exact ones by selection, in two scans for all columns: the first takes sketches (``ends``, where a caller has
    them already), which bracket each rank; the second counts the values inside the brackets one by one,
    and those between them together.  No other value is shuffled or sorted."""
    x = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in cols}
    if not exact:
        long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), x[c].alias("v")) for c in cols])))
        return grouped_quantiles(long, ["column_name"], "v", probs, exact)
    if ends is None:
        row = df.agg(*[_sketch(x[c], probs).alias(f"q{i}") for i, c in enumerate(cols)]).first()
        ends = {c: row[f"q{i}"] for i, c in enumerate(cols)}
    known = [c for c in cols if ends[c] is not None]    # others have no values
    if not known:
        return df.sparkSession.createDataFrame([], "column_name string, prob double, value double")

    def cell(c):
        place, value = _cell(x[c], [F.lit(float(e)) for e in ends[c]])
        return F.struct(F.lit(c).alias("column_name"), place.alias("place"), value.alias("inside"), x[c].alias("v"))
    cells = df.select(F.inline(F.array(*map(cell, known)))).where("v IS NOT NULL")
    return _by_rank(cells, ["column_name"], probs,
                    lambda: df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), x[c].alias("v")) for c in known])))
                    .where("v IS NOT NULL"))


def grouped_quantiles(long: DataFrame, group_cols: list[str], value_col: str, probs=(0.5,),
                      exact: bool = True) -> DataFrame:
    """(group..., prob, value) quantiles per group of a long table (numpy/pandas 'linear' rule)."""
    long = long.select(*group_cols, F.col(value_col).cast("double").alias("v")).where(
        F.col("v").isNotNull() & ~F.isnan("v"))
    if not exact:
        pa = long.groupBy(*group_cols).agg(F.percentile_approx("v", list(probs), 100000).alias("q"))
        return pa.select(*group_cols, F.posexplode("q")).select(
            *group_cols, F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("pos") + 1).alias("prob"),
            F.col("col").alias("value"))
    ends = long.groupBy(*group_cols).agg(_sketch(F.col("v"), probs).alias("_q"))
    ends, small = checked_small(ends)
    named = ends.select(*[F.col(g).alias(f"_b_{g}") for g in group_cols], "_q")
    same = [F.col(g).eqNullSafe(F.col(f"_b_{g}")) for g in group_cols]
    placed = long.join(F.broadcast(named) if small else named, same)
    place, value = _cell(F.col("v"), [F.col("_q")[i] for i in range(2 * len(probs))])
    return _by_rank(placed.select(*group_cols, place.alias("place"), value.alias("inside"), "v"), group_cols, probs, lambda: long)


def _by_rank(cells: DataFrame, group_cols: list[str], probs, whole) -> DataFrame:
    """Quantiles from ``(group..., place, inside, v)``.  What lies between brackets is one row at its least
    value; should a rank fall on such a row of several values, all values of ``whole()`` are ranked instead."""
    vc = (cells.groupBy(*group_cols, "place", "inside").agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("v"))
          .select(*group_cols, "v", "c", (F.col("inside").isNull() & (F.col("c") > 1)).alias("blurred")).persist(StorageLevel.MEMORY_AND_DISK))
    picked = _picked(vc, group_cols, probs)
    if not picked.where("blurred").isEmpty():
        vc.unpersist()
        vc = (whole().groupBy(*group_cols, "v").agg(F.count(F.lit(1)).alias("c")).withColumn("blurred", F.lit(False))
              .persist(StorageLevel.MEMORY_AND_DISK))
        picked = _picked(vc, group_cols, probs)
    ends = picked.groupBy(*group_cols, "prob").agg(
        F.max(F.when(F.col("i") == F.floor("h"), F.col("v"))).alias("lo"),
        F.max(F.when(F.col("i") == F.ceil("h"), F.col("v"))).alias("hi"), F.first("h").alias("h"))
    # equal ends stand for themselves: infinite ones have no difference
    value = F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(F.col("lo") + (F.col("h") - F.floor("h")) * (F.col("hi") - F.col("lo")))
    return ends.select(*group_cols, "prob", value.alias("value"))


def _picked(vc: DataFrame, group_cols: list[str], probs) -> DataFrame:
    """The rows of ``(group..., v, c)`` that hold the ranks that ``probs`` ask for, with ``prob, h, i``."""
    st = vc.groupBy(*group_cols).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("m"))
    few = st.limit(MAX_LOCAL_GROUPS + 1).collect()  # one row per group, read only when few
    if len(few) <= MAX_LOCAL_GROUPS:
        # the rank requests are built from the collected group sizes: no further jobs
        widest = max([r["m"] for r in few], default=0)
        req = []
        for r in few:
            for p in probs:
                h = (r["n"] - 1) * float(p)
                for i in sorted({math.floor(h), math.ceil(h)}):
                    req.append((*[r[g] for g in group_cols], float(p), float(h), int(i)))
        schema = T.StructType([st.schema[g] for g in group_cols] + [
            T.StructField("prob", T.DoubleType()), T.StructField("h", T.DoubleType()), T.StructField("i", T.LongType())])
        need, small = vc.sparkSession.createDataFrame(req, schema), True  # <= groups x probs x 2 rows
    else:
        st, _ = checked_small(st)
        widest = st.agg(F.max("m")).first()[0] or 0
        need = st.select(*group_cols, F.inline(F.array(*[
            F.struct(F.lit(float(p)).alias("prob"), ((F.col("n") - 1) * F.lit(float(p))).alias("h")) for p in probs])))
        need = need.select(*group_cols, "prob", "h", F.explode(F.array_distinct(F.array(
            F.floor("h").cast("bigint"), F.ceil("h").cast("bigint")))).alias("i"))
        need, small = checked_small(need)  # groups x probs x 2 rows
    if widest <= MAX_WINDOW_ROWS:
        # proven bound: no group has more rows than one task sorts comfortably
        w = Window.partitionBy(*group_cols).orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
        cum = vc.withColumn("cum", F.sum("c").over(w))
    else:
        pos = global_index(vc, ["v"], "pos", group_cols=group_cols)
        cum = prefix_sum(pos, "pos", "c", "cum", group_cols)  # value v holds ranks [cum - c, cum - 1]
    nd = need.select(*[F.col(g).alias(f"_n_{g}") for g in group_cols], "prob", "h", "i")
    cond = F.lit(True)
    for g in group_cols:
        cond = cond & F.col(g).eqNullSafe(F.col(f"_n_{g}"))
    cond = cond & (F.col("cum") - F.col("c") <= F.col("i")) & (F.col("i") < F.col("cum"))
    return cum.join(F.broadcast(nd) if small else nd, cond, "inner")


def numeric_describe(df: DataFrame, cols: list[str] | None = None, exact: bool = True,
                     digits: int = 6) -> DataFrame:
    """(column, count, mean, std, min, p25, p50, p75, max, skew, kurt), pandas semantics.

    ``skew`` is the bias-corrected G1 and ``kurt`` the bias-corrected excess G2; Spark's
    ``skewness``/``kurtosis`` are the biased g1/g2 and are corrected in closed form.
    """
    cols = cols or numeric_columns(df)
    aggs = []
    for c in cols:
        x = F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
        aggs += [F.count(x).alias(f"{c}__n"), F.avg(x).alias(f"{c}__mean"), F.stddev_samp(x).alias(f"{c}__std"),
                 F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max"), F.skewness(x).alias(f"{c}__g1"),
                 F.kurtosis(x).alias(f"{c}__g2")]
    probs = (0.25, 0.5, 0.75)
    if exact:   # the sketches that bracket the quantiles come with the moments, in one scan
        for c in cols:
            aggs.append(_sketch(F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")), probs).alias(f"{c}__q"))
    wide = df.agg(*aggs)
    ends = None
    if exact:
        row = wide.first()
        ends = {c: row[f"{c}__q"] for c in cols}
        wide = df.sparkSession.createDataFrame([row], wide.schema)
    stats = ["n", "mean", "std", "min", "max", "g1", "g2"]
    long = wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"{c}__{s}").cast("double").alias(s) for s in stats]) for c in cols])))
    n = F.col("n")
    g1 = F.col("g1") * F.sqrt(n * (n - 1)) / (n - 2)
    g2 = ((n + 1) * F.col("g2") + 6) * (n - 1) / ((n - 2) * (n - 3))
    long = long.select("column_name", n.cast("bigint").alias("count"), "mean", "std", "min", "max",
                       F.when(n > 2, g1).alias("skew"), F.when(n > 3, g2).alias("kurt"))
    q = quantiles(df, cols, probs, exact, ends)
    qw = q.groupBy("column_name").agg(*[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(nm)
                                   for p, nm in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))])
    out = long.join(qw, "column_name", "left")
    r = lambda c: F.round(c, digits).alias(c)
    return out.select("column_name", "count", r("mean"), r("std"), r("min"), r("p25"), r("p50"), r("p75"),
                      r("max"), r("skew"), r("kurt"))


def constant_and_high_cardinality(df: DataFrame, max_card: int = 50) -> DataFrame:
    """(column, n_unique_with_null, is_constant, is_high_card) per column."""
    st = column_stats(df)
    nu = F.col("n_unique") + F.when(F.col("null_count") > 0, 1).otherwise(0)
    return st.select("column_name", nu.alias("n_unique_with_null"), (nu <= 1).alias("is_constant"),
                     (F.col("dtype").isin("string") & (F.col("n_unique") > max_card)).alias("is_high_card"))


def schema_diff(left: DataFrame, right: DataFrame, names=("train", "test")) -> DataFrame:
    """(column, side) for columns present on one side only.  The schemas tell; no row is read."""
    rows = [(c, f"{names[0]}_only") for c in left.columns if c not in right.columns]
    rows += [(c, f"{names[1]}_only") for c in right.columns if c not in left.columns]
    return left.sparkSession.createDataFrame(rows, "column_name string, side string")


def row_text(df: DataFrame, cols: list[str]) -> Column:
    """Lossless text of a row: JSON with times to the microsecond (nulls are absent fields).  Of ``df``'s float
    columns, -0.0 reads as 0.0 and NaN as null: such rows are duplicates."""
    micros = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

    def cell(c):
        return (present(df, c) + F.lit(0.0)).alias(c) if is_float(df, c) else F.col(c)
    return F.to_json(F.struct(*map(cell, cols)), {"timestampNTZFormat": micros, "timestampFormat": micros + "XXX"})


def duplicate_rows(df: DataFrame, cols: list[str] | None = None, by: list[str] | None = None) -> DataFrame:
    """Rows equal (nulls equal) to an earlier row, per ``by`` group: (by..., n_rows, n_duplicates).

    Rows are grouped on a SHA-256 digest plus length of the canonical JSON of their columns, so the
    shuffle carries 40 bytes per row instead of whole texts.
    """
    cols = cols or df.columns
    by = by or []
    canon = row_text(df, cols)
    g = (df.select(*by, F.sha2(canon, 256).alias("_h"), F.length(canon).alias("_l"))
           .groupBy(*by, "_h", "_l").agg(F.count(F.lit(1)).alias("_c")))
    return g.groupBy(*by).agg(F.sum("_c").alias("n_rows"), F.sum(F.col("_c") - 1).alias("n_duplicates"))


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(column_name, dtype, n_rows, null_count, null_pct) from one aggregate; no cell value is shuffled."""
    cols = cols or df.columns
    one = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(_is_missing(df, c)).alias(f"_m{i}") for i, c in enumerate(cols)])
    st = one.select("_n", F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(df.schema[c].dataType.simpleString()).alias("dtype"),
                                                      F.col(f"_m{i}").alias("null_count")) for i, c in enumerate(cols)])))
    return st.select("column_name", "dtype", F.col("_n").alias("n_rows"), "null_count", _percent("null_count", "_n").alias("null_pct"))


def _percent(part: str, whole: str) -> Column:
    return F.round(F.lit(100.0) * F.col(part) / F.greatest(F.col(whole), F.lit(1)), 2)


def missing_summary(df: DataFrame) -> DataFrame:
    """Columns with missing values, with dtype and percentage."""
    return null_counts(df).where(F.col("null_pct") > 0).select("column_name", "dtype", "null_count", "null_pct")


def dtype_histogram(df: DataFrame) -> DataFrame:
    """Number of columns per type (from the schema)."""
    rows = [(f.dataType.simpleString(),) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "dtype string").groupBy("dtype").agg(F.count(F.lit(1)).alias("n_columns"))


def profile(df: DataFrame, exact: bool = True) -> dict[str, DataFrame]:
    """The full profile as long tables - shape/columns (P1-P4), numeric describe (P5-P8),
    top values (P9), constant / high-cardinality flags (P10-P11), duplicates (P13), dtypes (P2),
    and an in-memory size estimate in MB (sum of row JSON lengths)."""
    size = df.agg((F.sum(F.octet_length(F.to_json(F.struct(*[F.col(c) for c in df.columns])))) / 1024.0 ** 2)
                  .alias("memory_mb"), F.count(F.lit(1)).alias("n_rows"))
    return {"columns": column_stats(df), "numeric": numeric_describe(df, exact=exact), "top_values": top_values(df),
            "flags": constant_and_high_cardinality(df), "duplicates": duplicate_rows(df), "dtypes": dtype_histogram(df),
            "shape": size.withColumn("n_cols", F.lit(len(df.columns)))}
