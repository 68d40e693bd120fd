"""Joins, reconciliation, change capture and quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cdc as C
from ..operators import joins as J
from ..operators import quality as Q
from . import query, real


@query("select o_orderkey, o_custkey, c_name, c_mktsegment from orders left join customer on o_custkey = c_custkey")
def left_lookup(t):
    o = t("orders").select("o_orderkey", F.col("o_custkey").alias("k"))
    return J.attach(o, t("customer").select(F.col("c_custkey").alias("k"), "c_name", "c_mktsegment"), "k").withColumnRenamed("k", "o_custkey")


@query("select l_orderkey, l_linenumber, o_orderstatus from lineitem join orders on cast(l_orderkey as varchar) = cast(o_orderkey as varchar)")
def text_key_join(t):
    return J.match_as_text(t("lineitem").select("l_orderkey", "l_linenumber"), t("orders").select("o_orderkey", "o_orderstatus"), "l_orderkey", "o_orderkey").select("l_orderkey", "l_linenumber", "o_orderstatus")


@query("with m as (select o_custkey, o_orderpriority from (select *, row_number() over (partition by o_custkey order by o_orderkey desc) r from orders) where r = 1) select c_custkey, o_orderpriority as last_priority from customer left join m on c_custkey = o_custkey")
def lookup_last_wins(t):
    m = t("orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderpriority", "o_orderkey")
    return J.lookup(t("customer").select("c_custkey"), m, "c_custkey", "o_orderpriority", "last_priority", "o_orderkey")


@query("with m as (select o_custkey, o_orderpriority from (select *, row_number() over (partition by o_custkey order by o_orderkey) r from orders) where r = 1) select c_custkey, o_orderpriority as first_priority from customer left join m on c_custkey = o_custkey")
def lookup_first_wins(t):
    m = t("orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderpriority", "o_orderkey")
    return J.lookup(t("customer").select("c_custkey"), m, "c_custkey", "o_orderpriority", "first_priority", "o_orderkey", last=False)


@query("select o_orderkey, c_nationkey, n_name from orders left join customer on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey")
def two_hop(t):
    first = t("customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return J.two_hops(t("orders").select("o_orderkey", "o_custkey"), first, t("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name"), "o_custkey", "c_nationkey").select("o_orderkey", "c_nationkey", "n_name")


@query("select c_custkey, coalesce(case when c_custkey % 2 = 0 then c_mktsegment end, s.s_name, n_name) as name from customer left join (select * from supplier where s_suppkey % 3 = 0) s on c_custkey = s_suppkey left join nation on c_nationkey = n_nationkey")
def cascade_lookup(t):
    c = t("customer").select("c_custkey", F.col("c_nationkey").cast("bigint").alias("nk"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("name"))
    s = t("supplier").where("s_suppkey % 3 = 0").select("s_suppkey", "s_name")
    n = t("nation").select(F.col("n_nationkey").cast("bigint").alias("nk2"), "n_name")
    # Each map is looked up by its own key of the row.
    return J.cascade(J.cascade(c, [(s.withColumnRenamed("s_suppkey", "c_custkey"), "c_custkey", "s_name")], "name"), [(n.withColumnRenamed("nk2", "nk"), "nk", "n_name")], "name").select("c_custkey", "name")


@query("select c_custkey, c_name from customer where c_custkey in (select o_custkey from orders where o_totalprice > 400000)")
def semi_orders(t):
    big = t("orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return J.semi(t("customer").select("c_custkey", "c_name"), big, "c_custkey")


@query("select k, side from (select c_custkey k, 'left' side from customer where c_custkey not in (select o_custkey from orders where o_orderkey % 5 = 0) union all select distinct o_custkey, 'right' from orders where o_orderkey % 5 = 0 and o_custkey not in (select c_custkey from customer))")
def reconciliation(t):
    return J.reconcile(t("customer").select(F.col("c_custkey").alias("k")), t("orders").where("o_orderkey % 5 = 0").select(F.col("o_custkey").alias("k")).distinct(), "k")


@query("select distinct s_suppkey, c_custkey from supplier join customer on s_suppkey = c_custkey or substr(s_name, 10) = substr(c_name, 10)")
def any_key_join(t):
    s, c = t("supplier"), t("customer")
    tail = lambda x: F.concat(F.lit("n"), F.expr(f"substr({x}, 10)"))
    key = lambda x: F.concat(F.lit("k"), F.col(x).cast("string"))
    return J.any_key(s, c, [key("s_suppkey"), tail("s_name")], [key("c_custkey"), tail("c_name")], "s_suppkey", "c_custkey")


@query("""with d as (select distinct doc_id, w from (select doc_id, unnest(regexp_split_to_array(lower(text), '\\s+')) w from documents) where length(w) >= 5),
b as (select distinct item_id, w from (select item_id, unnest(regexp_split_to_array(lower(text), '\\s+')) w from benchmark) where length(w) >= 5),
h as (select doc_id, item_id, count(*) hits from d join b using (w) group by 1, 2 having count(*) >= 2)
select doc_id, item_id, hits from (select *, row_number() over (partition by doc_id order by hits desc, item_id) r from h) where r = 1""")
def keyword_overlap(t):
    return J.keyword_overlap(t("documents"), t("benchmark"), "doc_id", "text", "item_id", "text")


@query("select o_orderkey, (o_orderkey % 4 = 0) was_corrected, case when o_orderkey % 4 = 0 then 5.0 end difference, round(case when o_orderkey % 4 = 0 then o_totalprice + 5 else o_totalprice end, 2) as value from orders")
def amount_correction(t):
    o = t("orders").select("o_orderkey", F.col("o_totalprice").alias("value"))
    master = o.select("o_orderkey", F.when(F.col("o_orderkey") % 4 == 0, F.col("value") + 5).otherwise(F.col("value") + 0.5).alias("m"))
    c = J.corrected_amount(o, master, "o_orderkey", "value", "m")
    return c.select("o_orderkey", "was_corrected", real(F.col("difference"), 2).alias("difference"), real(F.col("value"), 2).alias("value"))


def _versions(t):
    old = t("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice").where("o_orderkey % 7 <> 0")
    new = t("orders").select("o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 5 == 0, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"), "o_totalprice")
    return old, new


@query("select o_orderkey, case when o_orderkey % 7 = 0 then 'NEW' when o_orderkey % 5 = 0 and o_orderstatus <> 'X' then 'MODIFIED' else 'UNCHANGED' end as change from orders")
def cdc_classify(t):
    old, new = _versions(t)
    return C.classify(new, old, "o_orderkey").select("o_orderkey", "change")


@query("select o_orderkey, 'o_orderstatus' field, o_orderstatus old_value, 'X' new_value from orders where o_orderkey % 7 <> 0 and o_orderkey % 5 = 0")
def cdc_changelog(t):
    old, new = _versions(t)
    return C.changelog(old, new, "o_orderkey", ["o_orderstatus", "o_totalprice"])


@query("select o_orderkey, case when o_orderkey % 5 = 0 then 'X' else o_orderstatus end o_orderstatus from orders")
def cdc_upsert(t):
    old, new = _versions(t)
    return C.upsert(old, C.changed(C.classify(new, old, "o_orderkey")).drop("change"), "o_orderkey").select("o_orderkey", "o_orderstatus")


@query("select o_orderkey, case when o_orderkey % 5 = 0 then null else o_orderstatus end as stored, coalesce(case when o_orderkey % 5 = 0 then null else o_orderstatus end, 'Z') merged from orders")
def cdc_merge_fields(t):
    base = t("orders")
    new = base.select("o_orderkey", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderstatus")).alias("s"))
    merged = C.merge_fields(base.select("o_orderkey", F.lit("Z").alias("s")), new, "o_orderkey")
    return merged.join(new.withColumnRenamed("s", "stored"), "o_orderkey").select("o_orderkey", "stored", F.col("s").alias("merged"))


def _records(t):
    """Records with planted violations: quantity as budget, tax as progress."""
    li = t("lineitem").select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("upid"),
        F.col("l_returnflag").alias("nombre_centro_gestor"),
        F.when(F.col("l_quantity") > 45, None).otherwise(F.when(F.col("l_linestatus") == "O", "En ejecución").otherwise("Terminado")).alias("estado"),
        F.when(F.col("l_quantity") < 3, "").otherwise(F.lit("Obra nueva")).alias("tipo_intervencion"),
        (F.col("l_quantity") - 5).alias("presupuesto_base"),
        F.lit(2024).alias("ano"),
        F.bround(F.col("l_discount") * 1100, 0).alias("avance_obra"),
    )
    return li


_ISSUES = """with r as (select concat_ws('-', l_orderkey, l_linenumber) upid, l_returnflag centre, case when l_quantity > 45 then null when l_linestatus = 'O' then 'En ejecución' else 'Terminado' end estado, case when l_quantity < 3 then '' else 'Obra nueva' end tipo, l_quantity - 5 budget, round_even(l_discount * 1100, 0) p from lineitem),
i as (select upid, centre, 'CO001' rule_id, 'completeness' dimension, 'HIGH' severity, 'intervencion.estado' field_name from r where estado is null
union all select upid, centre, 'CO001', 'completeness', 'HIGH', 'intervencion.tipo_intervencion' from r where tipo = ''
union all select upid, centre, 'LC001', 'logical_consistency', 'HIGH', 'presupuesto_base' from r where budget <= 0
union all select upid, centre, 'LC002', 'logical_consistency', 'MEDIUM', 'avance_obra' from r where p not between 0 and 100
union all select upid, centre, 'LC003', 'logical_consistency', 'MEDIUM', 'estado/avance_obra' from r where estado = 'Terminado' and p <> 0 and p < 100)
"""


def _found(t):
    return Q.issues(_records(t), Q.work_rules(), ["upid", "nombre_centro_gestor"], "intervencion")


@query(_ISSUES + "select upid, rule_id, dimension, severity, field_name from i")
def qc_issues(t):
    return _found(t).select("upid", "rule_id", "dimension", "severity", "field_name")


@query(_ISSUES + ", w as (select upid, max(case severity when 'HIGH' then 0.7 else 0.3 end) p from i group by 1) select (select count(*) from r) total_records, (select count(*) from w) records_affected, (select count(*) from i) total_issues, (select count(*) from i where severity = 'HIGH') high, (select count(*) from i where severity = 'MEDIUM') medium, round((1 - (select sum(p) from w) / (select count(*) from r)) * 100, 2) quality_score, case when (1 - (select sum(p) from w) / (select count(*) from r)) * 100 >= 90 then 'EXCELENTE' when (1 - (select sum(p) from w) / (select count(*) from r)) * 100 >= 75 then 'BUENA' when (1 - (select sum(p) from w) / (select count(*) from r)) * 100 >= 60 then 'ACEPTABLE' when (1 - (select sum(p) from w) / (select count(*) from r)) * 100 >= 40 then 'REGULAR' else 'DEFICIENTE' end quality_rating")
def qc_scores(t):
    s = Q.statistics(_found(t), _records(t))
    return s.select("total_records", "records_affected", "total_issues", "high", "medium", real(F.col("quality_score"), 2).alias("quality_score"), "quality_rating")


@query(_ISSUES + "select rule_id, severity, count(*) n from i group by 1, 2")
def qc_by_rule(t):
    return Q.counts_by(_found(t), "rule_id", "severity")


@query(_ISSUES + "select upid, count(*) total_issues, case when bool_or(severity = 'HIGH') then 'HIGH' else 'MEDIUM' end max_severity, case when bool_or(severity = 'HIGH') then case when count(*) >= 10 then 'P1' else 'P2' end when count(*) >= 15 then 'P2' else 'P3' end priority from i group by 1")
def qc_record_report(t):
    return Q.record_report(_found(t)).select("upid", "total_issues", "max_severity", "priority")


@query(_ISSUES + ", t as (select centre, count(*) total_records from r group by 1), b as (select centre, count(distinct upid) with_issues, count(*) total_issues, count(*) filter (severity = 'HIGH') h, count(*) filter (severity = 'MEDIUM') m from i group by 1), s as (select *, 100.0 * with_issues / total_records e, greatest(0, 100 - (5 * h + 2 * m) / (total_records * 10.0) * 100) q from t join b using (centre)) select centre, total_records, with_issues, total_issues, round(e, 4) error_rate, round(q, 4) quality_score, case when q >= 90 and e < 10 then 'EXCELLENT' when q >= 75 and e < 20 then 'GOOD' when q >= 60 and e < 35 then 'FAIR' when q >= 40 then 'POOR' else 'CRITICAL' end as status from s")
def qc_by_group(t):
    r = Q.centre_report(_found(t), _records(t))
    return r.select("centre", "total_records", "with_issues", "total_issues", real(F.col("error_rate")).alias("error_rate"), real(F.col("quality_score")).alias("quality_score"), "status")


@query(_ISSUES + "select centre, field_name, n from (select *, row_number() over (partition by centre order by n desc, field_name) k from (select centre, field_name, count(*) n from i group by 1, 2)) where k <= 3")
def qc_top_fields(t):
    return Q.top_fields(_found(t), 3).select(F.col("nombre_centro_gestor").alias("centre"), "field_name", "n")
