"""Time series, windows, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import relational as R
from ..operators import windows as W
from . import cents, query, real

_MONTHLY = "with m as (select cast(date_trunc('month', o_orderdate) as date) as month, cast(sum(cast(o_totalprice as decimal(18,2))) as double) total, count(*) n from orders group by 1)"


def months_of(t):
    m = A.monthly(t("orders").withColumn("v", cents("o_totalprice")), "o_orderdate", "v")
    return m.withColumn("total", F.col("total").cast("double"))


@query(_MONTHLY + " select * from m")
def monthly_series(t):
    return months_of(t)


@query("with e as (select cast(date_trunc('month', o_orderdate) as date) as month, cast(sum(cast(o_totalprice as decimal(18,2))) as double) total, count(*) n from orders where o_orderpriority = '1-URGENT' and o_totalprice > 300000 group by 1), c as (select cast(unnest(generate_series((select min(month) from e), (select max(month) from e), interval 1 month)) as date) as month) select month, coalesce(total, 0) total, coalesce(n, 0) n from c left join e using (month)")
def monthly_dense(t):
    rows = t("orders").where("o_orderpriority = '1-URGENT' and o_totalprice > 300000").withColumn("v", cents("o_totalprice").cast("double"))
    return A.monthly_dense(rows, "o_orderdate", "v").withColumn("total", F.round("total", 2))


@query("with w as (select cast(year(ts) as int) as year, cast(weekofyear(ts) as int) as week, avg(value) v from events group by 1, 2), r as (select *, sum(v) over (order by year, week rows unbounded preceding) c from w) select year, week, round(v, 6) as value, round(c, 4) running, round(100 * c / max(c) over (), 4) pct_of_max from r")
def weekly_progress_cum(t):
    w = A.weekly_mean(t("events"), "ts", "value")
    w = W.of_maximum(W.running_total(w, "value", ["year", "week"]), "running")
    return w.select("year", "week", real(F.col("value"), 6).alias("value"), real(F.col("running")).alias("running"), real(F.col("pct_of_max")).alias("pct_of_max"))


@query(_MONTHLY + " select month, total, round(sum(total) over (order by month rows unbounded preceding), 2) running from m")
def running_total(t):
    return W.running_total(months_of(t), "total", ["month"]).select("month", "total", real(F.col("running"), 2).alias("running"))


@query("select o_custkey, o_orderkey, o_totalprice, cast(sum(cast(o_totalprice as decimal(18,2))) over (partition by o_custkey order by o_orderdate, o_orderkey rows unbounded preceding) as double) running from orders")
def running_by_group(t):
    r = W.running_total(t("orders").withColumn("v", cents("o_totalprice")), "v", ["o_orderdate", "o_orderkey"], ["o_custkey"])
    return r.select("o_custkey", "o_orderkey", "o_totalprice", F.col("running").cast("double").alias("running"))


@query("with g as (select c_nationkey, cast(sum(cast(o_totalprice as decimal(18,2))) as double) v from orders join customer on o_custkey = c_custkey group by 1), r as (select *, row_number() over (order by v desc, c_nationkey) as rank, 100 * sum(v) over (order by v desc, c_nationkey rows unbounded preceding) / sum(v) over () c from g) select c_nationkey, v, rank, round(c, 4) cum_pct, coalesce(lag(c) over (order by rank), 0) < 80 as vital from r")
def pareto_80(t):
    g = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).groupBy("c_nationkey").agg(F.sum(cents("o_totalprice")).cast("double").alias("v"))
    return W.pareto(g, "v", "c_nationkey").withColumn("cum_pct", real(F.col("cum_pct"))).withColumn("rank", F.col("rank").cast("bigint"))


@query("select user_id, event_id, event_type, value from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) r from events) where r = 1")
def latest_snapshot(t):
    e = t("events").select("user_id", "event_id", "event_type", "value", F.struct("ts", "event_id").alias("_o"))
    return R.keep_last(e, ["user_id"], "_o").drop("_o")


@query("select user_id, max_by(event_type, event_id) filter (event_type <> 'view') last_type, max_by(value, event_id) filter (value is not null) last_value from events group by 1")
def last_non_null(t):
    e = t("events").withColumn("last_type", F.when(F.col("event_type") != "view", F.col("event_type"))).withColumn("last_value", F.col("value"))
    return W.last_values(e, ["user_id"], "event_id", "last_type", "last_value")


@query("select o_custkey, o_orderkey, concat('UNP-', o_custkey, '-INT-', row_number() over (partition by o_custkey order by o_orderkey)) child_id from orders")
def group_sequence(t):
    s = W.sequence(t("orders"), ["o_custkey"], ["o_orderkey"])
    return s.select("o_custkey", "o_orderkey", F.concat(F.lit("UNP-"), F.col("o_custkey").cast("string"), F.lit("-INT-"), F.col("seq").cast("string")).alias("child_id"))


@query("select o_orderkey, dense_rank() over (order by o_orderpriority, o_orderstatus) group_id from orders")
def group_id(t):
    return W.group_ids(t("orders").select("o_orderkey", "o_orderpriority", "o_orderstatus"), ["o_orderpriority", "o_orderstatus"]).select("o_orderkey", F.col("group_id").cast("bigint").alias("group_id"))


@query("select o_orderkey, 1000 + row_number() over (order by o_orderdate, o_orderkey) upid from orders")
def surrogate_keys(t):
    return W.global_ids(t("orders").select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], "upid", 1000).select("o_orderkey", F.col("upid").cast("bigint").alias("upid"))


@query(_MONTHLY + " select month, case when count(total) over w = 3 then round(avg(total) over w, 2) end moving from m window w as (order by month rows between 1 preceding and 1 following)")
def moving_average(t):
    m = months_of(t)
    return W.moving_average(m, "total", "month", 30).select("month", real(F.col("moving"), 2).alias("moving"))


@query(_MONTHLY + " select month, round(100 * total / sum(total) over (), 6) share_pct from m")
def share_of_total(t):
    return W.share_of_total(months_of(t), "total").select("month", real(F.col("share_pct"), 6).alias("share_pct"))


@query(_MONTHLY + ", s as (select avg(total) a, stddev_samp(total) d from m) select month, total, round(a, 2) mean, round(a + 2 * d, 2) upper, round(a - 2 * d, 2) lower, total > a + 2 * d or total < a - 2 * d out_of_band from m, s")
def control_band(t):
    b = W.control_band(months_of(t), "total")
    return b.select("month", "total", *(real(F.col(c), 2).alias(c) for c in ("mean", "upper", "lower")), "out_of_band")


@query(_MONTHLY + ", x as (select total y, row_number() over (order by month) x from m) select round(regr_slope(y, x), 2) slope, round(regr_intercept(y, x), 2) intercept from x")
def trend(t):
    x = W.sequence(months_of(t), [], ["month"], "x")
    return W.linear_trend(x, "x", "total").select(real(F.col("slope"), 2).alias("slope"), real(F.col("intercept"), 2).alias("intercept"))


@query("select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 10")
def top_k(t):
    return R.top_k(t("orders").select("o_orderkey", "o_totalprice"), 10, F.col("o_totalprice").desc(), F.col("o_orderkey"))


@query("select o_orderkey, o_totalprice from orders order by o_totalprice, o_orderkey limit 10")
def bottom_k(t):
    return R.top_k(t("orders").select("o_orderkey", "o_totalprice"), 10, F.col("o_totalprice"), F.col("o_orderkey"))


@query("select o_custkey, o_orderkey, o_totalprice from (select *, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) r from orders) where r <= 3")
def top_k_per_group(t):
    return R.top_k_per_group(t("orders").select("o_custkey", "o_orderkey", "o_totalprice"), 3, ["o_custkey"], F.col("o_totalprice").desc(), F.col("o_orderkey"))


@query("with u as (select o_orderkey k, o_custkey c, o_totalprice v, 1 src from orders union all select o_orderkey, o_custkey, o_totalprice + 1, 2 from orders where o_orderkey % 3 = 0) select k, c, v, src from (select *, row_number() over (partition by k order by src desc) r from u) where r = 1")
def union_dedup_last(t):
    o = t("orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"), F.col("o_totalprice").alias("v"))
    both = R.union_all(o.withColumn("src", F.lit(1)), o.where("k % 3 = 0").withColumn("v", F.col("v") + 1).withColumn("src", F.lit(2)))
    return R.keep_last(both.withColumn("_o", F.col("src")), ["k"], "_o").drop("_o")


@query("select distinct o_custkey as c_custkey from orders where o_custkey not in (select o_custkey from orders where o_orderstatus = 'F')")
def set_diff(t):
    """SO3: customers of whose orders none is finished."""
    o = t("orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderstatus")
    return R.missing_from(o.select("c_custkey").distinct(), o.where("o_orderstatus = 'F'"), "c_custkey")


@query("select 'contrato' tipo_instrumento, count(*) n from orders union all select 'pago', count(*) from lineitem")
def tagged_union(t):
    return R.tagged({"contrato": t("orders").select(F.col("o_orderkey").alias("k")), "pago": t("lineitem").select(F.col("l_orderkey").alias("k"))}).groupBy("tipo_instrumento").agg(F.count("*").alias("n"))


@query("select doc_id, count(*) over (partition by text) > 1 is_duplicate from documents")
def dup_flag(t):
    return W.duplicate_flag(t("documents").select("doc_id", F.xxhash64("text").alias("h")), ["h"]).select("doc_id", "is_duplicate")


@query(_MONTHLY + ", d as (select month, total, total - lag(total) over (order by month) c, lag(total) over (order by month) p from m) select month, round(c, 2) as change, case when p is null then null else round(c / p * 100, 2) end change_pct, case when c is null then 'neutral' when c > 0 then 'improved' when c < 0 then 'worsened' else 'stable' end trend from d")
def change_vs_previous(t):
    return W.versus_previous(months_of(t), "total", "month").select("month", real(F.col("comparison.change"), 2).alias("change"), real(F.col("comparison.change_pct"), 2).alias("change_pct"), "comparison.trend")


@query("with s as (select user_id, ts, event_id, case when lag(ts) over w is null or ts - lag(ts) over w > interval 30 minute then 1 else 0 end fresh from events window w as (partition by user_id order by ts, event_id)), g as (select *, sum(fresh) over (partition by user_id order by ts, event_id rows unbounded preceding) s from s) select user_id, min(ts) as start, max(ts) as last_ts, count(*) n from g group by user_id, s")
def sessionised_events(t):
    s = t("events").groupBy("user_id", F.session_window(F.col("ts").cast("timestamp"), "30 minutes 1 microsecond").alias("w")).agg(F.min("ts").alias("start"), F.max("ts").alias("last_ts"), F.count("*").alias("n"))
    return s.select("user_id", "start", "last_ts", "n")


@query("select time_bucket(interval 1 day, ts) as start, event_type, count(*) n, round(sum(value), 2) total from events group by 1, 2")
def event_windows(t):
    from ..streaming.changes import windowed

    w = windowed(t("events").withColumn("ts", F.col("ts").cast("timestamp")), "ts", "1 day", "1 hour", "event_type", n=F.count("*"), total=F.sum("value"))
    return w.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", real(F.col("total"), 2).alias("total"))
