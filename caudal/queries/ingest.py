"""Sources, plans from files, change streams and coordinate systems: written, read, and compared with SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import projections
from ..operators import relational as R
from ..plans import process_index, units
from ..sources import documents, files, sinks
from ..streaming import changes
from . import query, real
from .plans import _folder

# --- change streams -----------------------------------------------------------------

_STATES = "with a as (select 'u' || o_orderkey as upid, o_orderstatus estado, o_orderkey k from orders), b as (select upid, case when k % 5 = 0 then 'X' else estado end estado, k from a where k % 3 <> 0)"


@query(_STATES + " select upid, 'NEW' kind, null estado_anterior, estado estado_nuevo from a union all select a.upid, 'UPDATE', a.estado, b.estado from a join b using (upid) where a.estado <> b.estado")
def status_notifications(t):
    """ST1, ST3, NJ12: two rounds of writes, read as a stream by runs that go on from a checkpoint; some units are deleted in between, without a word."""
    k = F.col("o_orderkey")
    o = t("orders").select(F.concat(F.lit("u"), k.cast("string")).alias("upid"), F.col("o_orderstatus").alias("estado"), k.alias("k"))
    path, spark = _folder(o, "stream"), o.sparkSession
    side = lambda name, estado: F.format_string('"%s":{"fields":{"upid":{"stringValue":"%s"},"estado":{"stringValue":"%s"}}}', F.lit(name), "upid", estado)
    later = F.when(F.col("k") % 5 == 0, "X").otherwise(F.col("estado"))
    rounds = [
        o.select(F.concat(F.lit('{"data":{'), side("value", F.col("estado")), F.lit("}}")).alias("value"), F.lit("2024-01-01").cast("timestamp").alias("ts")),
        o.select(F.concat(F.lit('{"data":{'), F.when(F.col("k") % 3 == 0, side("oldValue", F.col("estado"))).otherwise(side("value", later)), F.lit("}}")).alias("value"), F.lit("2024-01-02").cast("timestamp").alias("ts")),
    ]
    for r in rounds:
        r.write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(r.schema).parquet(f"{path}/in")
        changes.run_once(changes.status_changes(changes.event_values(stream)), lambda df, _: df.write.mode("append").parquet(f"{path}/out"), f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/out")


@query("select distinct o_custkey from orders")
def first_contracts(t):
    """ST2, ST3: the first contract of each customer, once, over two runs of a stream."""
    o = t("orders").select("o_custkey", F.lit("2024-01-01").cast("timestamp").alias("ts"))
    path, spark = _folder(o, "first"), o.sparkSession
    for part in (o.where("o_custkey % 2 = 0"), o):
        part.write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(o.schema).parquet(f"{path}/in")
        changes.run_once(changes.first_seen(stream, "o_custkey", "ts"), lambda df, _: df.select("o_custkey").write.mode("append").parquet(f"{path}/out"), f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/out")


# --- sources -----------------------------------------------------------------------


@query("select c_custkey from customer where contains(lower(c_name || ' ' || c_mktsegment), 'build') or contains(lower(c_mktsegment), 'house')")
def text_found(t):
    """SRC28: rows of which any cell holds one of two texts."""
    c = t("customer").select("c_custkey", "c_name", "c_mktsegment")
    return files.find_text(c, "BUILD").union(files.find_text(c, "house")).select("c_custkey").distinct()


@query("select 'nombre_organismo' as organisation_column, s_suppkey, cast(s_suppkey as bigint) * 1000 as monto from supplier where s_suppkey % 4 <> 0")
def amounts_sheet(t):
    """SRC24, SRC26, SRC27: the organisation's column found, rows without a reference left out, amounts typed."""
    k = F.col("s_suppkey")
    s = t("supplier").select(k, F.concat(F.lit(" Secretaría "), k.cast("string")).alias("nombre_organismo"), F.lit("x").alias("otro"), F.concat(F.lit("$ "), F.replace(F.format_number(k * 1000, 0), F.lit(","), F.lit("."))).alias("monto"), F.when(k % 4 == 0, " ").otherwise("CD-1").alias("referencia"))
    name = files.organisation_column(s.select("nombre_organismo", "otro"))
    return files.typed_amounts(files.valid_references(s, "referencia"), ["monto"]).select(F.lit(name).alias("organisation_column"), "s_suppkey", F.col("monto").cast("bigint").alias("monto"))


@query("select o_orderkey, o_orderstatus from orders order by o_orderkey desc limit 1")
def latest_document(t):
    """SRC30."""
    return files.latest_row(t("orders").select("o_orderkey", "o_orderstatus"), "o_orderkey")


@query("select list_sort(list(distinct c_mktsegment)) segments, list_sort(list(distinct cast(c_nationkey as varchar))) nations from customer")
def column_values(t):
    """SRC21: the different values of each column."""
    return files.unique_values(t("customer").select(F.col("c_mktsegment").alias("segments"), F.col("c_nationkey").alias("nations")))


@query("select s_suppkey, 3.4 + s_suppkey / 10000.0 as lat, -76.5 as lon from supplier")
def points_from_table(t):
    """SRC22: coordinate columns found by name, decimal commas read."""
    s = t("supplier").select("s_suppkey", F.replace((3.4 + F.col("s_suppkey") / 10000.0).cast("string"), F.lit("."), F.lit(",")).alias("COORD_Y (norte)"), F.lit("-76,5").alias("Longitud"))
    p = files.points_table(s)
    return p.select("s_suppkey", "lat", "lon")


@query("select s_suppkey, s_name, 'Point' as kind from supplier")
def flat_collection(t):
    """SRC14, SRC17: a GeoJSON file as a flat table."""
    s = t("supplier").select("s_suppkey", "s_name", F.lit(3.4).alias("lat"), F.lit(-76.5).alias("lon"))
    path = _folder(s, "flat")
    documents.write_collection(s, path)
    flat = files.flat_features(files.read_geojson(s.sparkSession, f"{path}/features.geojson"))
    return flat.select(F.col("s_suppkey").cast("bigint").alias("s_suppkey"), "s_name", F.col("geometry.type").alias("kind"))


@query("select 'orders' as collection, count(*) n from orders union all select 'customer', count(*) from customer union all select 'pagos', 0 union all select 'noted', 1")
def collections_loaded(t):
    """SRC20: several collections at once; one that is missing is empty and noted."""
    o = t("orders")
    spark, path = o.sparkSession, _folder(o, "collections")
    o.select("o_orderkey").write.json(f"{path}/orders", compression="gzip")
    t("customer").select("c_custkey").write.parquet(f"{path}/customer")
    errors = []
    tables = files.load_collections(spark, path, {"orders": "o_orderkey long", "customer": "c_custkey long", "pagos": "id long"}, errors)
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(n).alias("collection"), "n") for n, df in tables.items()]
    return R.union_all(*counts, spark.range(1).select(F.lit("noted").alias("collection"), F.lit(len(errors)).cast("bigint").alias("n")))


@query("select 'CRITICAL' as severity, count(*) n, 'ok' as run from orders where o_orderstatus = 'F' union all select 'log', 2, 'ok'")
def reports_written(t):
    """SNK13, SNK22: critical issues as CSV, and two runs in the log."""
    found = t("orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "CRITICAL").otherwise("LOW").alias("severity"))
    spark, path = found.sparkSession, _folder(found, "reports")
    sinks.write_critical(found, f"{path}/critical")
    for i in range(2):
        sinks.log_run(spark, f"{path}/log", "units", i, True, "a", "b")
    critical = spark.read.option("header", True).csv(f"{path}/critical").groupBy("severity").agg(F.count("*").alias("n"))
    log = spark.read.json(f"{path}/log").where("ok").agg(F.count("*").alias("n")).select(F.lit("log").alias("severity"), "n")
    return critical.unionByName(log).withColumn("run", F.lit("ok"))


# --- plans from files ----------------------------------------------------------------


@query(
    """with p as (select s_suppkey k, s_suppkey % 50 bp, 2024000 + s_suppkey % 40 bpin, case when s_suppkey % 6 <> 0 then 'Centro ' || s_suppkey % 7 end centre from supplier),
centres as (select cast(bpin as varchar) bpin, arg_min(centre, k) centre from p where centre is not null group by 1), codes as (select bp, cast(arg_max(bpin, k) as varchar) bpin from p group by 1),
i as (select c_custkey, cast(c_custkey % 60 as varchar) bp, case when c_custkey % 3 = 0 then '2024' || lpad(cast(c_custkey % 45 as varchar), 3, '0') end own, c_custkey % 4 + 0 as n from customer)
select c_custkey, 'BP' || i.bp bp, coalesce(own, codes.bpin) bpin, centres.centre nombre_centro_gestor, case when n = 0 then 0 when n = 1 then 1 else 2 end::bigint processes from i left join codes on codes.bp = cast(i.bp as bigint) left join centres on centres.bpin = coalesce(own, codes.bpin)"""
)
def process_index_plan(t):
    """SRC25, NJ1, JN4 to JN7: the index sheet with project, centre and lists of references."""
    k, c = F.col("s_suppkey"), F.col("c_custkey")
    projects = t("supplier").select(k.alias("_row_id"), F.concat(F.lit("BP"), (k % 50).cast("string")).alias("bp"), (2024000 + k % 40).alias("bpin"), F.when(k % 6 != 0, F.concat(F.lit("Centro "), (k % 7).cast("string"))).alias("nombre_centro_gestor"))
    index = t("customer").select(c, (c % 60).cast("string").alias("bp"), F.when(c % 3 == 0, F.concat(F.lit("2024"), F.lpad((c % 45).cast("string"), 3, "0"), F.lit(".0"))).otherwise(" ").alias("bpin"), F.lit("7").alias("id_paa"), F.when(c % 4 == 1, "a").when(c % 4 > 1, "a, b,,").alias("referencia_proceso"), F.lit(None).cast("string").alias("referencia_contrato"))
    out = process_index.transform(index, projects)
    return out.select("c_custkey", "bp", "bpin", "nombre_centro_gestor", F.greatest(F.size("referencia_proceso"), F.lit(0)).cast("bigint").alias("processes"))


@query("select s_suppkey, 'Obra ' || s_suppkey as nombre_up, row_number() over (order by 'Obra ' || s_suppkey, cast(s_suppkey as varchar)) as _row_id from supplier")
def units_extracted(t):
    """SRC29: the records of a folder's files, numbered and kept."""
    s = t("supplier").coalesce(1).select(F.concat(F.lit("Obra "), F.col("s_suppkey").cast("string")).alias("NOMBRE UP"), F.col("s_suppkey").alias("id"))
    path = _folder(s, "extract")
    s.write.option("header", True).csv(f"{path}/in")
    rows = units.extract(s.sparkSession, f"{path}/in", f"{path}/kept")
    name = next(c for c in rows.columns if c.lower().startswith("nombre"))
    return rows.select(F.col("id").cast("bigint").alias("s_suppkey"), F.col(name).alias("nombre_up"), F.col("_row_id").cast("bigint").alias("_row_id"))


# --- coordinate systems ----------------------------------------------------------------


@query("select c_custkey, code, round(3.0 + (c_custkey % 100) / 50.0, 6) lat, round(-77.5 + (c_custkey % 90) / 30.0, 6) lon from customer, (select unnest([3115, 3116, 9377, 32618, 3857, 21897]) code)")
def coordinate_systems(t):
    """GE10: places through six systems and back."""
    c = t("customer").select("c_custkey", (3.0 + F.col("c_custkey") % 100 / 50.0).alias("a"), (-77.5 + F.col("c_custkey") % 90 / 30.0).alias("b"))
    back = [projections.to_degrees(projections.from_degrees(c, "a", "b", code), "x", "y", code).select("c_custkey", F.lit(code).alias("code"), real(F.col("lat"), 6).alias("lat"), real(F.col("lon"), 6).alias("lon")) for code in (3115, 3116, 9377, 32618, 3857, 21897)]
    return R.union_all(*back)
