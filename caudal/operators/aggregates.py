"""Group aggregates, statistics, concentration, nesting and summaries.

Null group keys are dropped where the sources drop them (keyed()); sums of
nothing are 0. All but quantiles are plain aggregates: partial in each task, then by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .quantiles import with_quantiles


def keyed(df: DataFrame, keys: list[str]):
    return df.dropna("any", subset=keys).groupBy(*keys)


def sum0(c: str | Column) -> Column:
    return F.coalesce(F.sum(c), F.lit(0))


def facts_by_period(df: DataFrame, keys: list[str], facts: list[str], provenance: list[str], order: str) -> DataFrame:
    """AG1: sums by key, with the first provenance that is not null in row order."""
    first = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in provenance]
    return keyed(df, keys).agg(*(sum0(c).alias(c) for c in facts), *first)


def fact_columns(df: DataFrame, *words: str) -> list[str]:
    """AG2: numeric columns whose name holds one of the words."""
    return [n for n, t in df.dtypes if any(w in n for w in words) and (t in ("double", "float", "bigint", "int") or t.startswith("decimal"))]


def sum_and_count(df: DataFrame, key: str, value: str) -> DataFrame:
    """AG4."""
    return keyed(df, [key]).agg(sum0(value).alias(f"{value}_total"), F.count("*").alias("n"))


def reconciles(df: DataFrame, rolled: DataFrame, value: str) -> bool:
    """AG4: whether the roll-up's total is the rows' total (two numbers reach the driver)."""
    a = df.agg(sum0(value)).first()[0]
    b = rolled.agg(sum0(f"{value}_total")).first()[0]
    return abs(a - b) <= 1e-6 * max(1.0, abs(a))


def describe_by(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """AG5, AG16 and AG17: count, sum, mean, median, least and greatest."""
    out = keyed(df, keys).agg(F.count(value).alias("n"), sum0(value).alias("total"), F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"))
    return with_quantiles(out, df.dropna("any", subset=keys), keys, value, {"median": 0.5}).select(*keys, "n", "total", "mean", "median", "min", "max")


def moments(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """AG15: with bias-corrected skewness and kurtosis, quartiles and the coefficient of variation; null where too few values are."""
    g = keyed(df, keys) if keys else df.groupBy()
    n = F.col("n")
    out = g.agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.var_samp(value).alias("variance"), F.stddev_samp(value).alias("std"),
        F.skewness(value).alias("_g1"), F.kurtosis(value).alias("_g2"), F.min(value).alias("min"), F.max(value).alias("max"),
    )
    out = with_quantiles(out, df.dropna("any", subset=keys) if keys else df, keys, value, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    skew = F.when(n > 2, F.col("_g1") * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0)))
    kurt = F.when(n > 3, (n - 1) / F.nullif((n - 2) * (n - 3), F.lit(0)) * ((n + 1) * F.col("_g2") + 6))
    return out.withColumns({"skewness": skew, "kurtosis": kurt, "cv_pct": F.try_divide(F.col("std") * 100, F.col("mean")), "iqr": F.col("q3") - F.col("q1")}).drop("_g1", "_g2")


def distribution(df: DataFrame, key: str, value: str | None = None) -> DataFrame:
    """AG8 and AG9: rows (and sums of value) by class, with percent of all."""
    g = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"), *([sum0(value).alias("total")] if value else []))
    w = W.partitionBy()  # over the classes, which are few
    return g.withColumns({"pct": 100 * F.col("n") / F.sum("n").over(w)} | ({"total_pct": F.try_divide(100 * F.col("total"), F.sum("total").over(w))} if value else {}))


def category_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """AG10 and AG46: values of several columns counted in one pass; blanks as 'SIN DATO'."""
    texts = [F.coalesce(F.nullif(F.trim(F.col(c).cast("string")), F.lit("")), F.lit("SIN DATO")).alias(c) for c in columns]
    return df.select(*texts).unpivot([], columns, "field", "value").groupBy("field", "value").agg(F.count("*").alias("n"))


def distinct_counts(df: DataFrame, columns: list[str], keys: list[str] | None = None) -> DataFrame:
    """AG11, exact."""
    return df.groupBy(*(keys or [])).agg(*(F.count_distinct(c).alias(c) for c in columns))


def weekly_mean(df: DataFrame, date: str, *values: str) -> DataFrame:
    """AG12: by calendar year and ISO week, as the reports pair them."""
    return df.groupBy(F.year(date).alias("year"), F.weekofyear(date).alias("week")).agg(*(F.avg(v).alias(v) for v in values))


def monthly(df: DataFrame, date: str, value: str) -> DataFrame:
    """AG13."""
    return df.where(F.col(date).isNotNull()).groupBy(F.date_trunc("month", date).cast("date").alias("month")).agg(sum0(value).alias("total"), F.count("*").alias("n"))


def monthly_dense(df: DataFrame, date: str, value: str) -> DataFrame:
    """AG14: every month from the first to the last, empty ones with 0."""
    m = monthly(df, date, value)
    months = m.agg(F.min("month").alias("a"), F.max("month").alias("b")).where("a is not null").select(F.explode(F.expr("sequence(a, b, interval 1 month)")).alias("month"))
    return months.join(m, "month", "left").select("month", F.coalesce("total", F.lit(0.0)).alias("total"), F.coalesce("n", F.lit(0)).alias("n"))


def hhi(df: DataFrame, key: str, value: str | None = None) -> DataFrame:
    """AG18 (by value) and AG19 (by count): one row with the index, its band and the number of holders."""
    g = df.where(F.col(key).isNotNull()).groupBy(key).agg((sum0(value) if value else F.count("*")).alias("v"))
    s = g.agg(F.sum(F.pow(F.col("v").cast("double"), F.lit(2))).alias("s2"), F.sum("v").cast("double").alias("s"), F.count("*").alias("holders"))
    index = F.try_divide(F.col("s2") * 10000, F.col("s") * F.col("s"))
    return s.select(index.alias("hhi"), F.when(index < 1500, "low").when(index <= 2500, "moderate").otherwise("high").alias("band"), "holders")


def weighted_mean(value: str, weight: str) -> Column:
    """AG20: weighted by positive weights, or the plain mean if there are none."""
    ok = F.col(value).isNotNull() & (F.col(weight) > 0)
    return F.coalesce(F.try_divide(F.sum(F.when(ok, F.col(value) * F.col(weight))), F.sum(F.when(ok, F.col(weight)))), F.avg(value))


def nested(df: DataFrame, keys: list[str], children: list[str], name: str, order: str, **summary: Column) -> DataFrame:
    """AG21, AG22, AG23 and AG24: for each key the array of its child structs in order, and summaries.

    The rows of one key end in one row, so this is for keys of bounded fan-out (contracts of a project); see README.
    """
    rows = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("_o"), F.struct(*children).alias("_c")))), lambda x: x["_c"])
    return keyed(df, keys).agg(F.count("*").alias("n"), *(c.alias(n) for n, c in summary.items()), rows.alias(name))


def first_by(column: str, order: str) -> Column:
    """First value that is not null, in row order."""
    return F.min_by(column, F.when(F.col(column).isNotNull(), F.col(order)))


def fullest(column: str, order: str) -> Column:
    """AG25: the longest text of a group, the earliest of equal length; blanks do not count."""
    ok = F.nullif(F.trim(F.col(column)), F.lit("")).isNotNull()
    return F.max_by(column, F.when(ok, F.struct(F.length(column), -F.col(order))))


def consolidated_point(lat: str, lon: str, order: str, box: tuple[float, float, float, float]) -> Column:
    """AG26: struct(lat, lon): the means, to 8 digits, if they are in the box, else the first pair that is; null if none is."""
    a, b = F.bround(F.avg(lat), 8), F.bround(F.avg(lon), 8)
    inside = F.col(lat).between(box[0], box[1]) & F.col(lon).between(box[2], box[3])
    first = F.min_by(F.struct(F.col(lat).alias("lat"), F.col(lon).alias("lon")), F.when(inside, F.col(order)))
    return F.when(a.between(box[0], box[1]) & b.between(box[2], box[3]), F.struct(a.alias("lat"), b.alias("lon"))).otherwise(first)


def first_point_per_key(df: DataFrame, key: str, lat: str, lon: str, order: str, box) -> DataFrame:
    """AG27 and AG28: each row with its key's first valid pair."""
    inside = F.col(lat).between(box[0], box[1]) & F.col(lon).between(box[2], box[3])
    first = keyed(df, [key]).agg(F.min_by(F.struct(F.col(lat).alias("lat"), F.col(lon).alias("lon")), F.when(inside, F.col(order))).alias("_p"))
    return df.drop(lat, lon).join(first, key, "left").withColumns({lat: F.col("_p.lat"), lon: F.col("_p.lon")}).drop("_p")


def coverage(df: DataFrame, columns: list[str]) -> DataFrame:
    """AG29, AG37 and AG45: one row for each column: values, share of all rows in percent, different values."""
    agg = df.agg(F.count("*").alias("rows"), *(F.count(F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))).alias(f"n_{c}") for c in columns), *(F.count_distinct(c).alias(f"d_{c}") for c in columns))
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(f"n_{c}").alias("n"), F.col(f"d_{c}").alias("distinct_values")) for c in columns)))
    return agg.select("rows", each.alias("x")).select("x.field", "rows", "x.n", F.coalesce(F.try_divide(100 * F.col("x.n"), F.col("rows")), F.lit(0.0)).alias("pct"), "x.distinct_values")


def verdict(pct: Column) -> Column:
    """AG30."""
    return F.when(pct >= 95, "EXCELENTE").when(pct >= 85, "BUENO").when(pct >= 70, "ACEPTABLE").when(pct >= 50, "REGULAR").otherwise("DEFICIENTE")


def priority(pct: Column) -> Column:
    """AG30: what to mend first."""
    return F.when(pct < 50, "ALTA").when(pct < 85, "MEDIA").otherwise("BAJA")


def sum_if(condition: Column, value: str) -> Column:
    """AG31."""
    return F.coalesce(F.sum(F.when(condition, F.col(value))), F.lit(0.0))


def executive_panel(contracts: DataFrame, payments: DataFrame, reports: DataFrame) -> DataFrame:
    """AG33 and JN23: one row of indicators. contracts(value, state), payments(value, date), reports(physical, financial)."""
    c = contracts.agg(sum0("value").alias("committed"), F.count("*").alias("contracts"), F.count_if(F.col("state") == "active").alias("active"), F.count_if(F.col("state") == "success").alias("done"))
    p = payments.agg(sum0("value").alias("disbursed"), F.count_distinct(F.date_trunc("month", "date")).alias("months"))
    r = reports.agg(F.avg("physical").alias("physical"), F.avg("financial").alias("financial"))
    one = c.crossJoin(F.broadcast(p)).crossJoin(F.broadcast(r))  # one row each
    return one.select(
        "committed", "disbursed", F.try_divide(100 * F.col("disbursed"), F.col("committed")).alias("pct_executed"), F.try_divide(100 * F.col("done"), F.col("contracts")).alias("success_rate"),
        F.col("active").alias("active_contracts"), F.col("physical").alias("avg_physical"), F.col("financial").alias("avg_financial"), F.try_divide(F.col("physical"), F.col("financial")).alias("efficiency"),
        F.try_divide(F.col("disbursed"), F.col("months")).alias("velocity"), (F.col("committed") - F.col("disbursed")).alias("balance"),
    )


def cost_performance(df: DataFrame, physical: str, financial: str) -> DataFrame:
    """AG34: one row: mean and median of physical over financial progress."""
    df = df.select(F.try_divide(F.col(physical), F.col(financial)).alias("_cpi"))
    cpi = F.col("_cpi")
    out = df.agg(F.avg(cpi).alias("cpi_mean"), F.count_if(cpi < 1).alias("behind"), F.count(cpi).alias("n"))
    return with_quantiles(out, df, [], "_cpi", {"cpi_median": 0.5})


def estimate_at_completion(budget: Column, cpi: Column) -> dict[str, Column]:
    """AG34: EAC and VAC."""
    eac = F.try_divide(budget, cpi)
    return {"eac": eac, "vac": budget - eac}


def bucket_counts(df: DataFrame, value: str, bounds: list[float], labels: list[str]) -> DataFrame:
    """AG35: rows by bucket [bounds[i], bounds[i+1]), empty buckets too. The buckets are literals."""
    which = F.lit(None).cast("int")
    for i in range(len(labels) - 1, -1, -1):
        which = F.when((F.col(value) >= bounds[i]) & (F.col(value) < bounds[i + 1]), i).otherwise(which)
    counted = df.select(which.alias("i")).where("i is not null").groupBy("i").count()
    names = df.sparkSession.createDataFrame(list(enumerate(labels)), "i int, bucket string")
    return F.broadcast(names).join(counted, "i", "left").select("i", "bucket", F.coalesce("count", F.lit(0)).alias("n"))


def catalog_coverage(df: DataFrame, column: str, catalog: DataFrame, key: str) -> DataFrame:
    """AG39 and SO4: one row: different values, how many are in the catalog, percent."""
    v = df.where(F.col(column).isNotNull()).select(F.col(column).alias("_v")).distinct()
    hit = v.join(catalog.select(F.col(key).alias("_v")).distinct().withColumn("_in", F.lit(1)), "_v", "left")
    return hit.agg(F.count("*").alias("n"), F.count("_in").alias("known")).withColumn("pct", F.coalesce(F.try_divide(100 * F.col("known"), F.col("n")), F.lit(0.0)))


def missing_by(df: DataFrame, key: str, missing: Column) -> DataFrame:
    """AG40 and AG36: rows and missing ones by key, with percent."""
    return df.groupBy(F.coalesce(key, F.lit("SIN DATO")).alias(key)).agg(F.count("*").alias("n"), F.count_if(missing).alias("missing")).withColumn("pct", 100 * F.col("missing") / F.col("n"))


def grouping_key(*columns: str) -> Column:
    """AG43: digest of the trimmed lower-case fields."""
    return F.md5(F.concat_ws("|", *(F.lower(F.trim(F.coalesce(F.col(c).cast("string"), F.lit("")))) for c in columns)).cast("binary"))


def compare_groupings(df: DataFrame, simple: str, other: str) -> DataFrame:
    """AG44: one row: groups by either key and the reduction in percent."""
    return df.agg(F.count("*").alias("rows"), F.count_distinct(simple).alias("simple_groups"), F.count_distinct(other).alias("other_groups")).withColumn("reduction_pct", F.coalesce(F.try_divide(100 * (F.col("simple_groups") - F.col("other_groups")), F.col("simple_groups")), F.lit(0.0)))


def cross_counts(df: DataFrame, key: str, state: str) -> DataFrame:
    """AG48: rows by key and state, with the state's percent inside the key."""
    g = df.groupBy(key, state).agg(F.count("*").alias("n"))
    return g.join(df.groupBy(key).agg(F.count("*").alias("key_total")), key).withColumn("pct", 100 * F.col("n") / F.col("key_total"))


def rollup(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """AG41 (an extension): sums and counts at every level."""
    return df.rollup(*keys).agg(sum0(value).alias("total"), F.count("*").alias("n"), F.grouping_id().alias("level"))


def correction_audit(df: DataFrame, match: str, before: str, after: str) -> DataFrame:
    """AG38: rows and the sum of differences by kind of match."""
    return df.groupBy(match).agg(F.count("*").alias("n"), sum0(F.col(after) - F.col(before)).alias("difference"))


def zero_progress(df: DataFrame, state: str, progress: str) -> DataFrame:
    """AG47: rows by state and progress as written, and whether that is a spelling of zero."""
    s = F.lower(F.trim(F.col(progress).cast("string")))
    zero = F.coalesce(s.isin("cero", "") | (s.rlike(r"^0+([.,]0+)?\s*%?$")), F.lit(False))
    return df.groupBy(state, progress).agg(F.count("*").alias("n")).withColumn("is_zero", zero)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """AG42: the different values that are not blank."""
    return df.select(F.trim(F.col(column).cast("string")).alias(column)).where(F.coalesce(F.col(column), F.lit("")) != "").distinct()
