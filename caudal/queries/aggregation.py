"""Aggregates, roll-ups, statistics and concentration."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numbers, status
from ..operators import aggregates as A
from ..operators import relational as R
from . import cents, query, real


def performance_of(t):
    """AG6, JN2, SF46, SF47: payments by contract against the contract's value."""
    pay = t("lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n_payments"), F.sum(cents("l_extendedprice")).alias("paid"), F.avg("l_extendedprice").alias("avg_payment"), F.stddev("l_extendedprice").alias("std_payment"))
    c = t("orders").join(pay, F.col("o_orderkey") == F.col("l_orderkey"))
    pct = numbers.execution("o_totalprice", F.col("paid").cast("double"))["pct_executed"]
    return c.select("o_orderkey", "o_custkey", "o_orderstatus", "n_payments", F.col("paid").cast("double").alias("paid"), real(F.col("avg_payment"), 6).alias("avg_payment"), real(F.col("std_payment"), 4).alias("std_payment"), F.col("o_totalprice").alias("value"), pct.alias("pct"))


_PERFORMANCE = """
with pay as (select l_orderkey, count(*) n_payments, sum(cast(l_extendedprice as decimal(18,2))) paid, avg(l_extendedprice) a, stddev_samp(l_extendedprice) s from lineitem group by 1),
perf as (select o_orderkey, o_custkey, o_orderstatus, n_payments, cast(paid as double) paid, round(a, 6) avg_payment, round(s, 4) std_payment, o_totalprice as value, cast(paid as double) * 100 / nullif(o_totalprice, 0) pct from orders join pay on o_orderkey = l_orderkey)
"""


@query(_PERFORMANCE + "select o_orderkey, n_payments, paid, avg_payment, std_payment, value, round(pct, 4) pct_executed, round(value - paid, 2) balance, case when pct >= 80 then 'Excelente' when pct >= 50 then 'Bueno' when pct >= 20 then 'Regular' else 'Bajo' end performance, case when pct > 100 then 'Sobre-ejecutado' when pct = 100 then 'Completo' when pct >= 80 then 'Alto' when pct >= 50 then 'Medio' when pct >= 20 then 'Bajo' else 'Muy bajo' end execution from perf")
def contract_performance(t):
    p = performance_of(t)
    return p.select("o_orderkey", "n_payments", "paid", "avg_payment", "std_payment", "value", real(F.col("pct")).alias("pct_executed"), real(F.col("value") - F.col("paid"), 2).alias("balance"), status.performance("pct").alias("performance"), status.execution_kind("pct").alias("execution"))


@query(_PERFORMANCE + "select n_name as organism, count(*) contracts, round(cast(sum(cast(value as decimal(18,2))) as double), 2) committed, round(cast(sum(cast(paid as decimal(18,2))) as double), 2) disbursed, round(avg(pct), 4) avg_pct from perf join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by 1")
def org_rollup(t):
    c = performance_of(t).join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(t("nation")), F.col("c_nationkey") == F.col("n_nationkey"))  # nation has 25 rows at any scale
    return c.groupBy(F.col("n_name").alias("organism")).agg(F.count("*").alias("contracts"), real(F.sum(cents("value")), 2).alias("committed"), real(F.sum(cents("paid")), 2).alias("disbursed"), real(F.avg("pct")).alias("avg_pct"))


@query("select l_suppkey as bpin, last_day(cast(l_shipdate as date)) as period, cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as ppto, cast(sum(cast(l_quantity as decimal(18,2))) as double) as pagos, min(l_orderkey * 10 + l_linenumber) as first_row from lineitem where l_extendedprice <> 0 or l_quantity <> 0 group by 1, 2")
def budget_by_key_period(t):
    rows = R.any_nonzero(["l_extendedprice", "l_quantity"])(t("lineitem")).select(F.col("l_suppkey").alias("bpin"), F.last_day("l_shipdate").alias("period"), cents("l_extendedprice").alias("ppto"), cents("l_quantity").alias("pagos"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("first_row"))
    return A.facts_by_period(rows, ["bpin", "period"], ["ppto", "pagos"], ["first_row"], "first_row").withColumns({"ppto": F.col("ppto").cast("double"), "pagos": F.col("pagos").cast("double")})


@query("select o_custkey, o_orderkey, o_orderstatus, o_totalprice from (select *, row_number() over (partition by o_custkey order by o_orderkey) r from orders) where r = 1")
def dimension_first(t):
    return R.keep_first(t("orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", F.col("o_orderkey").alias("_row_id")), ["o_custkey"], "_row_id").drop("_row_id")


@query("select o_custkey, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as payable, count(*) as n from orders group by 1")
def payable_sum_count(t):
    return A.sum_and_count(t("orders").select("o_custkey", cents("o_totalprice").alias("payable")), "o_custkey", "payable").select("o_custkey", F.col("payable_total").cast("double").alias("payable"), "n")


@query("select n_name, count(*) n, cast(sum(cast(o_totalprice as decimal(18,2))) as double) total, round(avg(o_totalprice), 4) mean, round(median(o_totalprice), 4) median, min(o_totalprice) min, max(o_totalprice) max from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by 1")
def organism_stats(t):
    df = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(t("nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    g = A.describe_by(df.withColumn("exact", cents("o_totalprice")), ["n_name"], "o_totalprice").drop("total")
    total = A.keyed(df, ["n_name"]).agg(F.sum(cents("o_totalprice")).cast("double").alias("total"))
    return g.join(total, "n_name").select("n_name", "n", "total", real(F.col("mean")).alias("mean"), real(F.col("median")).alias("median"), "min", "max")


@query("select o_orderstatus, count(*) n, cast(sum(cast(o_totalprice as decimal(18,2))) as double) total, round(100.0 * count(*) / sum(count(*)) over (), 4) pct from orders group by 1")
def class_distribution(t):
    return A.distribution(t("orders").withColumn("v", cents("o_totalprice")), "o_orderstatus", "v").select("o_orderstatus", "n", F.col("total").cast("double").alias("total"), real(F.col("pct")).alias("pct"))


@query("select 'o_orderstatus' field, o_orderstatus as value, count(*) n from orders group by 2 union all select 'o_orderpriority', o_orderpriority, count(*) from orders group by 2")
def category_counts(t):
    return A.category_counts(t("orders"), ["o_orderstatus", "o_orderpriority"])


@query("select l_returnflag, count(distinct l_suppkey) l_suppkey, count(distinct l_partkey) l_partkey from lineitem group by 1")
def distinct_counts(t):
    return A.distinct_counts(t("lineitem"), ["l_suppkey", "l_partkey"], ["l_returnflag"])


@query("select o_orderstatus, count(*) n, round(avg(o_totalprice), 2) mean, round(stddev_samp(o_totalprice), 2) std, round(skewness(o_totalprice), 4) skewness, round(kurtosis(o_totalprice), 4) kurtosis, round(quantile_cont(o_totalprice, 0.25), 2) q1, round(quantile_cont(o_totalprice, 0.75), 2) q3, round(100 * stddev_samp(o_totalprice) / avg(o_totalprice), 4) cv_pct from orders group by 1")
def moments(t):
    m = A.moments(t("orders"), ["o_orderstatus"], "o_totalprice")
    return m.select("o_orderstatus", "n", *(real(F.col(c), d).alias(c) for c, d in (("mean", 2), ("std", 2), ("skewness", 4), ("kurtosis", 4), ("q1", 2), ("q3", 2), ("cv_pct", 4))))


_HHI = "with g as (select c_nationkey k, {v} v from orders join customer on o_custkey = c_custkey group by 1), h as (select sum(power(100.0 * v / (select sum(v) from g), 2)) hhi, count(*) holders from g) select round(hhi, 4) hhi, case when hhi < 1500 then 'low' when hhi <= 2500 then 'moderate' else 'high' end band, holders from h"


def _hhi(t, value):
    df = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    return A.hhi(df, "c_nationkey", value).select(real(F.col("hhi")).alias("hhi"), "band", "holders")


@query(_HHI.format(v="sum(o_totalprice)"))
def hhi_value(t):
    return _hhi(t, "o_totalprice")


@query(_HHI.format(v="count(*)"))
def hhi_count(t):
    return _hhi(t, None)


@query("select l_suppkey, round(coalesce(sum(case when l_extendedprice > 0 then l_discount * l_extendedprice end) / nullif(sum(case when l_extendedprice > 0 and l_discount is not null then l_extendedprice end), 0), avg(l_discount)), 6) progress from lineitem group by 1")
def weighted_progress(t):
    return t("lineitem").groupBy("l_suppkey").agg(real(A.weighted_mean("l_discount", "l_extendedprice"), 6).alias("progress"))


@query("select o_custkey, o_orderkey, o_orderstatus, o_totalprice, row_number() over (partition by o_custkey order by o_orderkey) as position, count(*) over (partition by o_custkey) as n from orders")
def nested_rollup(t):
    n = A.nested(t("orders"), ["o_custkey"], ["o_orderkey", "o_orderstatus", "o_totalprice"], "orders", "o_orderkey")
    return n.select("o_custkey", "n", F.posexplode("orders").alias("p", "o")).select("o_custkey", "o.*", (F.col("p") + 1).cast("bigint").alias("position"), "n")


@query("select p_brand, p_name as fullest from (select p_brand, p_name, row_number() over (partition by p_brand order by length(p_name) desc, p_partkey) r from part where trim(p_name) <> '') where r = 1")
def longest_value(t):
    return t("part").groupBy("p_brand").agg(A.fullest("p_name", "p_partkey").alias("fullest"))


@query("with b(i, lo, hi, bucket) as (values (0, 0, 10, '0-9'), (1, 10, 20, '10-19'), (2, 20, 40, '20-39'), (3, 40, 1000, '40+'), (4, 1000, 2000, 'none')) select i, bucket, count(l_orderkey) n from b left join lineitem on l_quantity >= lo and l_quantity < hi group by 1, 2")
def bucket_distribution(t):
    return A.bucket_counts(t("lineitem"), "l_quantity", [0, 10, 20, 40, 1000, 2000], ["0-9", "10-19", "20-39", "40+", "none"])


@query("""with c as (select sum(cast(o_totalprice as decimal(18,2))) committed, count(*) contracts, count(*) filter (o_orderstatus = 'O') active, count(*) filter (o_orderstatus = 'F') done from orders),
p as (select sum(cast(l_extendedprice as decimal(18,2))) disbursed, count(distinct date_trunc('month', l_shipdate)) n_months from lineitem), r as (select avg(l_discount * 1000) physical, avg(l_tax * 1000) financial from lineitem)
select cast(committed as double) committed, cast(disbursed as double) disbursed, round(100 * cast(disbursed as double) / cast(committed as double), 4) pct_executed, round(100.0 * done / contracts, 4) success_rate, active active_contracts, round(physical, 4) avg_physical, round(financial, 4) avg_financial, round(physical / financial, 4) efficiency, round(cast(disbursed as double) / n_months, 2) velocity, cast(committed - disbursed as double) balance from c, p, r""")
def kpi_panel(t):
    contracts = t("orders").select(cents("o_totalprice").alias("value"), F.when(F.col("o_orderstatus") == "O", "active").when(F.col("o_orderstatus") == "F", "success").alias("state"))
    payments = t("lineitem").select(cents("l_extendedprice").alias("value"), F.col("l_shipdate").alias("date"))
    reports = t("lineitem").select((F.col("l_discount") * 1000).alias("physical"), (F.col("l_tax") * 1000).alias("financial"))
    k = A.executive_panel(contracts, payments, reports)
    d = {"pct_executed": 4, "success_rate": 4, "avg_physical": 4, "avg_financial": 4, "efficiency": 4, "velocity": 2, "committed": 2, "disbursed": 2, "balance": 2}
    return k.select(*(real(F.col(c), d[c]).alias(c) if c in d else F.col(c) for c in k.columns))


@query("select round(avg(l_discount / nullif(l_tax, 0)), 6) cpi_mean, round(median(l_discount / nullif(l_tax, 0)), 6) cpi_median, count(*) filter (l_discount / nullif(l_tax, 0) < 1) behind, count(l_discount / nullif(l_tax, 0)) n from lineitem")
def cpi_stats(t):
    c = A.cost_performance(t("lineitem"), "l_discount", "l_tax")
    return c.select(real(F.col("cpi_mean"), 6).alias("cpi_mean"), real(F.col("cpi_median"), 6).alias("cpi_median"), "behind", "n")


@query("select o_orderpriority, cast(sum(case when o_totalprice > 150000 then cast(o_totalprice as decimal(18,2)) else 0 end) as double) at_risk from orders group by 1")
def risk_totals(t):
    return t("orders").withColumn("v", cents("o_totalprice")).groupBy("o_orderpriority").agg(A.sum_if(F.col("o_totalprice") > 150000, "v").cast("double").alias("at_risk"))


@query("select o_orderpriority as key, o_orderstatus as state, count(*) n, sum(count(*)) over (partition by o_orderpriority) key_total, round(100.0 * count(*) / sum(count(*)) over (partition by o_orderpriority), 4) pct from orders group by 1, 2")
def status_within_group(t):
    c = A.cross_counts(t("orders").select(F.col("o_orderpriority").alias("key"), F.col("o_orderstatus").alias("state")), "key", "state")
    return c.select("key", "state", "n", "key_total", real(F.col("pct")).alias("pct"))


@query("select o_orderpriority, o_orderstatus, cast(sum(cast(o_totalprice as decimal(18,2))) as double) total, count(*) n, cast(grouping(o_orderpriority, o_orderstatus) as bigint) as level from orders group by rollup (o_orderpriority, o_orderstatus)")
def rollup_levels(t):
    r = A.rollup(t("orders").withColumn("v", cents("o_totalprice")), ["o_orderpriority", "o_orderstatus"], "v")
    return r.select("o_orderpriority", "o_orderstatus", F.col("total").cast("double").alias("total"), "n", F.col("level").cast("bigint").alias("level"))


@query("with v as (select distinct p_brand from part), k as (select distinct p_brand from part where p_size < 3) select count(*) n, count(k.p_brand) known, round(100.0 * count(k.p_brand) / count(*), 4) pct from v left join k using (p_brand)")
def catalog_coverage(t):
    return A.catalog_coverage(t("part"), "p_brand", t("part").where("p_size < 3"), "p_brand").select("n", "known", real(F.col("pct")).alias("pct"))


@query("select 'p_name' field, count(*) as \"rows\", count(nullif(trim(p_name), '')) n, round(100.0 * count(nullif(trim(p_name), '')) / count(*), 4) pct, count(distinct p_name) distinct_values from part union all select 'p_brand', count(*), count(nullif(trim(p_brand), '')), round(100.0 * count(nullif(trim(p_brand), '')) / count(*), 4), count(distinct p_brand) from part")
def field_coverage(t):
    return A.coverage(t("part"), ["p_name", "p_brand"]).select("field", "rows", "n", real(F.col("pct")).alias("pct"), "distinct_values")


@query("select o_orderpriority, count(*) n, count(*) filter (o_totalprice < 50000) missing, round(100.0 * count(*) filter (o_totalprice < 50000) / count(*), 4) pct from orders group by 1")
def missing_by_group(t):
    return A.missing_by(t("orders"), "o_orderpriority", F.col("o_totalprice") < 50000).withColumn("pct", real(F.col("pct")))


@query("select count(*) as \"rows\", count(distinct o_custkey) simple_groups, count(distinct o_orderpriority) other_groups, round(100.0 * (count(distinct o_custkey) - count(distinct o_orderpriority)) / count(distinct o_custkey), 4) reduction_pct from orders")
def grouping_comparison(t):
    return A.compare_groupings(t("orders"), "o_custkey", "o_orderpriority").withColumn("reduction_pct", real(F.col("reduction_pct")))


@query("select o_custkey, o_orderstatus as value, count(*) as n from orders group by 1, 2")
def counts_map(t):
    from ..functions.nested import counts_map as cm

    return cm(t("orders"), "o_orderstatus", "o_custkey").select("o_custkey", F.explode("counts").alias("value", "n"))


@query("select p_brand, o.avg_progress, round(v.m, 8) lat from (select p_brand, round(avg(p_retailprice), 2) avg_progress from part group by 1) o join (select p_brand, avg(3.3 + (p_partkey % 300) / 1000.0) m from part group by 1) v using (p_brand)")
def point_consolidation(t):
    """AG26."""
    df = t("part").withColumns({"lat": 3.3 + (F.col("p_partkey") % 300) / 1000.0, "lon": F.lit(-76.5)})
    p = A.consolidated_point("lat", "lon", "p_partkey", (2.0, 5.0, -78.0, -75.0))
    return df.groupBy("p_brand").agg(real(F.avg("p_retailprice"), 2).alias("avg_progress"), p.alias("p")).select("p_brand", "avg_progress", F.round("p.lat", 8).alias("lat"))


