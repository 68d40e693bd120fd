"""Cleaning functions over texts made from table columns, and nested values."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, nested, numbers, status, text
from . import query, real

#: One text for each order, in six spellings of money, by key.
_MONEY_SQL = "select o_orderkey, case o_orderkey % 6 when 0 then replace(format('{:,}', cast(floor(o_totalprice) as bigint)), ',', '.') when 1 then '$' || format('{:,}', cast(floor(o_totalprice) as bigint)) || '.50' when 2 then ' ' || cast(cast(floor(o_totalprice) as bigint) as varchar) || ',5' when 3 then '-' || cast(cast(floor(o_totalprice) as bigint) as varchar) when 4 then 'COP ' || format('{:,}', cast(floor(o_totalprice) as bigint)) else '-' end s from orders"


def _money_texts(t):
    n = F.floor("o_totalprice").cast("bigint")
    grouped = F.format_number(n, 0)
    k = F.col("o_orderkey") % 6
    s = F.when(k == 0, F.replace(grouped, F.lit(","), F.lit("."))).when(k == 1, F.concat(F.lit("$"), grouped, F.lit(".50"))).when(k == 2, F.concat(F.lit(" "), n.cast("string"), F.lit(",5"))).when(k == 3, F.concat(F.lit("-"), n.cast("string"))).when(k == 4, F.concat(F.lit("COP "), grouped)).otherwise("-")
    return t("orders").select("o_orderkey", s.alias("s"), n.alias("n"))


@query(f"with m as ({_MONEY_SQL}) select o_orderkey, case o_orderkey % 6 when 1 then floor(o_totalprice) + 0.5 when 2 then floor(o_totalprice) + 0.5 when 5 then 0.0 else floor(o_totalprice) end as money from orders join m using (o_orderkey)")
def money_parse(t):
    return _money_texts(t).select("o_orderkey", numbers.money("s").alias("money"))


@query("select o_orderkey, case o_orderkey % 6 when 1 then cast(floor(o_totalprice) as bigint) * 100 + 50 when 2 then cast(floor(o_totalprice) as bigint) * 10 + 5 when 5 then null else cast(floor(o_totalprice) as bigint) end as digits from orders")
def money_digits(t):
    return _money_texts(t).select("o_orderkey", numbers.digits_only("s").alias("digits"))


@query("select l_orderkey, l_linenumber, case l_linenumber % 4 when 0 then 0.0 when 1 then least(100.0, round(l_quantity * 3, 2)) when 2 then 0.0 else round(l_quantity, 2) + 0.5 end progress from lineitem")
def progress_parse(t):
    k, q = F.col("l_linenumber") % 4, F.col("l_quantity")
    s = F.when(k == 0, "cero").when(k == 1, F.concat((q * 3).cast("string"), F.lit(" %"))).when(k == 2, F.concat(F.lit("-"), q.cast("string"))).otherwise(F.concat(F.lit("("), q.cast("bigint").cast("string"), F.lit(",5)")))
    return t("lineitem").select("l_orderkey", "l_linenumber", numbers.progress(s).alias("progress"))


@query("select p_partkey, array_to_string(list_transform(string_split(lower(p_name), ' '), lambda w, i: case when i > 1 and w in ('de', 'la', 'y') then w else upper(w[1]) || substr(w, 2) end), ' ') as title from part")
def title_case(t):
    return t("part").select("p_partkey", text.title_es("p_name").alias("title"))


@query("select doc_id, replace(strip_accents(upper(trim(regexp_replace(text, '[ \\t\\n\\r\\f\\v]+', ' ', 'g')))), 'ẞ', 'SS') as plain from documents")
def accent_strip(t):
    """Over all documents; the two engines write a capital ß otherwise."""
    return t("documents").select("doc_id", text.plain_upper("text").alias("plain"))


@query("select s_suppkey, case s_suppkey % 3 when 0 then 'COMUNA ' || case when s_suppkey < 10 then lpad(cast(s_suppkey as varchar), 2, '0') else cast(s_suppkey as varchar) end when 1 then 'Corregimiento ' || cast(s_suppkey as varchar) else null end district from supplier")
def comuna_pad(t):
    k = F.col("s_suppkey")
    s = F.when(k % 3 == 0, F.concat(F.lit("comuna "), k.cast("string"))).when(k % 3 == 1, F.concat(F.lit("Corregimiento "), k.cast("string"))).otherwise("")
    return t("supplier").select("s_suppkey", text.district(s).alias("district"))


@query("select o_orderkey, case o_orderkey % 5 when 4 then null else cast(o_orderdate as date) end as day from orders where year(o_orderdate) between 1990 and 2030")
def date_parse(t):
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 5
    serial = F.when(F.datediff(d, F.lit("1899-12-30").cast("date")) >= 40000, F.datediff(d, F.lit("1899-12-30").cast("date")).cast("string")).otherwise(F.date_format(d, "yyyy-MM-dd"))
    s = F.when(k == 0, F.date_format(d, "dd/MM/yyyy")).when(k == 1, F.date_format(d, "yyyy/MM/dd")).when(k == 2, serial).when(k == 3, F.concat(F.lit(" "), F.date_format(d, "dd-MM-yyyy"))).otherwise("pendiente")
    return t("orders").where("year(o_orderdate) between 1990 and 2030").select("o_orderkey", dates.date_search(s).alias("day"))


@query("select l_orderkey, l_linenumber, case when l_quantity > 48 then 'Suspendido' when round(l_discount * 1000) = 0 then 'En alistamiento' when round(l_discount * 1000) >= 100 then 'Terminado' else 'En ejecución' end estado from lineitem")
def status_rules(t):
    s = F.when(F.col("l_quantity") > 48, "SUSPENDIDO").when(F.col("l_linenumber") % 2 == 0, "").otherwise("obra en proceso")
    return t("lineitem").select("l_orderkey", "l_linenumber", status.status(s, F.round(F.col("l_discount") * 1000)).alias("estado"))


@query("select l_orderkey, l_linenumber, case when l_returnflag in ('A', 'N') and l_linestatus = 'O' then 'Frente activo' when l_returnflag in ('A', 'N') then 'Inactivo' else 'No aplica' end front from lineitem")
def active_front(t):
    kind = F.when(F.col("l_returnflag") == "R", "Otra").otherwise("Obra vial")
    state = F.when(F.col("l_linestatus") == "O", "En ejecución").otherwise("Suspendido")
    return t("lineitem").select("l_orderkey", "l_linenumber", status.active_front(kind, F.lit(None).cast("string"), F.lit("Obra nueva"), state).alias("front"))


@query("select p_partkey, i - 1 as position, w as reference from (select p_partkey, unnest(string_split(p_name, ' ')) w, generate_subscripts(string_split(p_name, ' '), 1) i from part) where w <> ''")
def ref_explode(t):
    df = t("part").select("p_partkey", F.concat(F.regexp_replace("p_name", " ", " , "), F.lit(",")).alias("refs"))
    return nested.explode_references(df, "refs", "p_partkey").withColumn("position", F.col("position").cast("bigint"))


@query("select p_partkey, case p_partkey % 4 when 0 then ['a' || p_partkey, 'b'] when 1 then ['x' || p_partkey, 'y'] when 2 then ['http://h/a,b'] else null end as refs, coalesce(len(case p_partkey % 4 when 0 then ['a', 'b'] when 1 then ['x', 'y'] when 2 then ['h'] else null end), 0) as n from part".replace(" as refs,", "[1] as first,"))
def reference_lists(t):
    k, p = F.col("p_partkey") % 4, F.col("p_partkey").cast("string")
    s = F.when(k == 0, F.concat(F.lit('["a'), p, F.lit('", " b "]'))).when(k == 1, F.concat(F.lit("x"), p, F.lit(", y,"))).when(k == 2, "http://h/a,b").otherwise("nan")
    r = nested.references(s)
    return t("part").select("p_partkey", r[0].alias("first"), F.coalesce(F.size(r), F.lit(0)).cast("bigint").alias("n"))


@query("select event_id, json_extract_string(props, '$.k') as k, props is not null as has_props from events")
def json_props(t):
    return t("events").select("event_id", F.get_json_object("props", "$.k").alias("k"), F.col("props").isNotNull().alias("has_props"))


@query("select o_orderkey, '$' || replace(format('{:,}', cast(round_even(o_totalprice, 0) as bigint)), ',', '.') as pesos from orders")
def peso_text(t):
    return t("orders").select("o_orderkey", numbers.peso_text(F.bround("o_totalprice", 0)).alias("pesos"))


@query("select l_orderkey, l_linenumber, round(l_discount * 1000 - l_tax * 1000, 4) delta, round(l_extendedprice * (1 - l_discount * 1000 / 100), 5) pending, round(l_discount * 1000 - l_tax * 1000, 6) < -15 critical from lineitem")
def gap_metrics(t):
    g = status.gap(F.round(F.col("l_discount") * 1000, 6), F.round(F.col("l_tax") * 1000, 6), "l_extendedprice", F.lit(False))
    return t("lineitem").select("l_orderkey", "l_linenumber", real(g["delta"]).alias("delta"), real(g["pending"], 5).alias("pending"), g["critical"].alias("critical"))


@query("select p_partkey, 'BP' || p_partkey as code, case when p_partkey % 2 = 0 then p_partkey end as bpin_num from part")
def code_cleaning(t):
    k = F.col("p_partkey")
    raw = F.when(k % 2 == 0, k.cast("string")).otherwise(F.concat(F.lit(" bp"), k.cast("string")))
    return t("part").select("p_partkey", text.budget_code(raw).alias("code"), numbers.bpin(raw)["bpin_num"].alias("bpin_num"))
