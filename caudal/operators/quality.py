"""Data-quality rules, scores and reports.

Rules are data: an id, a condition of violation and what to report. A rule set
turns each record into an array of issues, exploded once, so any number of rules
is one pass without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.coords import BOX_LIVE, BOX_RULES
from ..functions.numbers import number
from ..functions.status import DONE, PREPARING, STATES
from ..functions.text import valid_url
from .relational import SEVERITIES, severity_rank, top_k_per_group
from .spatial import ring_problem
from .windows import change

CRITICAL, HIGH, MEDIUM, LOW, INFO = SEVERITIES


@dataclass(frozen=True)
class Rule:
    """UD7."""

    id: str
    dimension: str
    severity: str
    field: str
    violated: Column | None
    current: Column


def blank(c: str) -> Column:
    return F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")


def _text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def unit_rules(equipment: list[str]) -> list[Rule]:
    """QD1 to QD4: over units (upid, nombre_up, direccion, tipo_equipamiento, clase_up, geometry, intervenciones)."""
    lon, lat = F.col("geometry.coordinates")[0], F.col("geometry.coordinates")[1]
    placed = ~blank("direccion") & lon.isNotNull() & lat.isNotNull()
    a, b, c, d = BOX_LIVE
    inverted = lon.between(a, b) & lat.between(c, d)
    where = F.concat(F.lit("["), _text(lon), F.lit(", "), _text(lat), F.lit("]"))
    return [
        *(Rule("CO001", "completeness", CRITICAL, f"unidad.{f}", blank(f), F.lit(None).cast("string")) for f in ("upid", "nombre_up", "direccion", "tipo_equipamiento", "clase_up")),
        Rule("PA002", "positional_accuracy", CRITICAL, "geometry", placed & inverted, where),
        Rule("PA001", "positional_accuracy", HIGH, "geometry", placed & ~inverted & ~(lon.between(c, d) & lat.between(a, b)), where),
        Rule("CO002", "completeness", MEDIUM, "geometry", ~blank("direccion") & (F.col("geometry").isNull() | (F.size(F.col("geometry.coordinates")) == 0)), F.lit("NULL")),
        Rule("TA008", "thematic_accuracy", LOW, "tipo_equipamiento", ~blank("tipo_equipamiento") & ~F.col("tipo_equipamiento").isin(*equipment), _text("tipo_equipamiento")),
        Rule("LC009", "logical_consistency", HIGH, "intervenciones", F.col("intervenciones").isNull() | (F.size("intervenciones") == 0), F.lit("[]")),
        Rule("LC010", "logical_consistency", CRITICAL, "intervenciones", F.exists("intervenciones", lambda x: x.isNull()), F.lit("null")),
    ]


def work_rules() -> list[Rule]:
    """QD5 and QD6: over works (estado, tipo_intervencion, presupuesto_base, ano, avance_obra)."""
    budget, progress = number(_text("presupuesto_base")), number(_text("avance_obra"))
    return [
        *(Rule("CO001", "completeness", HIGH, f"intervencion.{f}", blank(f), F.lit(None).cast("string")) for f in ("estado", "tipo_intervencion", "presupuesto_base", "ano")),
        Rule("TA001", "thematic_accuracy", MEDIUM, "estado", ~blank("estado") & ~F.col("estado").isin(*STATES), _text("estado")),
        Rule("LC001", "logical_consistency", HIGH, "presupuesto_base", budget <= 0, _text(budget)),
        Rule("LC002", "logical_consistency", MEDIUM, "avance_obra", ~progress.between(0, 100), _text(progress)),
        Rule("LC003", "logical_consistency", MEDIUM, "estado/avance_obra", (F.col("estado") == DONE) & (progress != 0) & (progress < 100), F.concat_ws(" / ", F.col("estado"), F.concat(_text(progress), F.lit("%")))),
    ]


def strict_rules(catalogs: dict[str, list[str]], today: Column, ring: str | None = None) -> list[Rule]:
    """The declared rules that the live path never calls, as an optional set over flat records; LC008, PA002 and TA010 are declared but never reported. ring: a column with a polygon's outer ring, for LC006."""
    p, state = number(_text("avance_obra")), F.lower(F.trim("estado"))
    start, end = F.col("fecha_inicio").try_cast("date"), F.col("fecha_fin").try_cast("date")
    begun = state.isin("en ejecución", "terminado")
    lon, lat = F.col("lon"), F.col("lat")
    mismatch = (
        F.when(state == "inaugurado", p != 100)
        .when(p == 0, state != PREPARING.lower())
        .when(p == 100, ~state.isin("terminado", "inaugurado"))
        .when((p > 0) & (p < 100), state.isin(PREPARING.lower(), "terminado"))
    )
    no_catalog = lambda c: ~blank(c) & ~F.col(c).isin(*catalogs.get(c, []))
    null = F.lit(None).cast("string")
    days = F.datediff(end, start)
    return [
        Rule("LC001", "logical_consistency", CRITICAL, "estado", mismatch, F.concat_ws(" / ", "estado", _text(p))),
        Rule("LC002", "logical_consistency", CRITICAL, "avance_obra", ~p.between(0, 100), _text(p)),
        Rule("LC003", "logical_consistency", CRITICAL, "avance_obra", ~blank("avance_obra") & p.isNull(), _text("avance_obra")),
        Rule("LC004", "logical_consistency", HIGH, "presupuesto_base", ~blank("presupuesto_base") & F.coalesce(number(_text("presupuesto_base")) < 0, F.lit(True)), _text("presupuesto_base")),
        Rule("LC005", "logical_consistency", HIGH, "cantidad", ~blank("cantidad") & F.coalesce(number(_text("cantidad")) <= 0, F.lit(True)), _text("cantidad")),
        *([Rule("LC006", "logical_consistency", HIGH, "geometry", None, ring_problem(F.col(ring)))] if ring else []),
        Rule("LC007", "logical_consistency", HIGH, "ano", ~blank("ano") & ~F.coalesce(number(_text("ano")).between(2020, 2030), F.lit(False)), _text("ano")),
        *(Rule("CO001", "completeness", CRITICAL, f, blank(f), null) for f in ("nombre_up", "estado", "clase_up", "tipo_intervencion", "tipo_equipamiento", "nombre_centro_gestor", "comuna_corregimiento", "barrio_vereda")),
        Rule("CO002", "completeness", HIGH, "geometry", ~blank("direccion") & (lat.isNull() | lon.isNull()), null),
        Rule("CO003", "completeness", CRITICAL, "identificador", blank("upid") & blank("bpin") & blank("identificador"), null),
        Rule("CO004", "completeness", MEDIUM, "fechas", begun & (blank("fecha_inicio") | blank("fecha_fin")), null),
        Rule("CO005", "completeness", MEDIUM, "referencias", begun & blank("referencia_contrato") & blank("referencia_proceso"), null),
        Rule("CO006", "completeness", HIGH, "direccion", blank("direccion"), null),
        Rule("PA001", "positional_accuracy", HIGH, "geometry", ~(lat.between(*BOX_RULES[:2]) & lon.between(*BOX_RULES[2:])), F.concat_ws(",", _text(lon), _text(lat))),
        Rule("PA003", "positional_accuracy", HIGH, "geometry", ((lat == 0) & (lon == 0)) | (F.abs(lon) > 180) | (F.abs(lat) > 90), F.concat_ws(",", _text(lon), _text(lat))),
        Rule("PA004", "positional_accuracy", MEDIUM, "comuna_corregimiento_val", F.col("comuna_corregimiento_val") == "ERROR", _text("comuna_corregimiento_val")),
        Rule("PA005", "positional_accuracy", MEDIUM, "barrio_vereda_val", F.col("barrio_vereda_val") == "ERROR", _text("barrio_vereda_val")),
        *(Rule(i, "thematic_accuracy", s, c, no_catalog(c), _text(c)) for i, s, c in (("TA001", CRITICAL, "estado"), ("TA002", HIGH, "tipo_intervencion"), ("TA003", MEDIUM, "plataforma"), ("TA004", MEDIUM, "unidad"), ("TA007", HIGH, "clase_up"), ("TA008", MEDIUM, "tipo_equipamiento"), ("TA009", HIGH, "fuente_financiacion"))),
        Rule("TA005", "thematic_accuracy", LOW, "url_proceso", ~blank("url_proceso") & ~valid_url("url_proceso"), _text("url_proceso")),
        Rule("TA006", "thematic_accuracy", HIGH, "comuna_corregimiento_val", F.col("comuna_corregimiento_val").isin("REVISAR", "ERROR"), _text("comuna_corregimiento_val")),
        Rule("TQ001", "temporal_quality", CRITICAL, "fechas", start >= end, F.concat_ws(" / ", _text(start), _text(end))),
        Rule("TQ002", "temporal_quality", HIGH, "fecha_inicio", ~blank("fecha_inicio") & start.isNull(), _text("fecha_inicio")),
        Rule("TQ002", "temporal_quality", HIGH, "fecha_fin", ~blank("fecha_fin") & end.isNull(), _text("fecha_fin")),
        Rule("TQ003", "temporal_quality", MEDIUM, "fecha_inicio", (F.year(start) < 2015) | (F.year(start) > F.year(today) + 5), _text(start)),
        Rule("TQ003", "temporal_quality", MEDIUM, "fecha_fin", (F.year(end) < 2015) | (F.year(end) > F.year(today) + 10), _text(end)),
        Rule("TQ004", "temporal_quality", MEDIUM, "fecha_fin", (state == "terminado") & (end > today), _text(end)),
        Rule("TQ005", "temporal_quality", LOW, "fechas", (days > 1825) | (days < 1), _text(days)),
    ]


def issues(df: DataFrame, rules: list[Rule], keys: list[str], level: str = "registro") -> DataFrame:
    """A row for each violation: the keys, rule_id, dimension, severity, field_name, current_value and level. A null condition is no violation; a rule without a condition is violated where it has a current value."""

    def issue(r: Rule, value: Column) -> Column:
        return F.struct(F.lit(r.id).alias("rule_id"), F.lit(r.dimension).alias("dimension"), F.lit(r.severity).alias("severity"), F.lit(r.field).alias("field_name"), value.alias("current_value"))

    def found(r: Rule) -> Column:
        if r.violated is not None:
            return F.when(F.coalesce(r.violated, F.lit(False)), issue(r, r.current))
        return F.get(F.transform(F.array(r.current), lambda v: F.when(v.isNotNull(), issue(r, v))), F.lit(0))  # the value is computed once

    each = F.array(*map(found, rules))
    return df.select(*keys, F.explode(F.filter(each, lambda x: x.isNotNull())).alias("x")).select(*keys, "x.*", F.lit(level).alias("level"))


def validate_units(units: DataFrame, equipment: list[str]) -> DataFrame:
    """QD1 to QD6 over nested units; works without an id are named by their position."""
    top = issues(units, unit_rules(equipment), ["upid", "nombre_centro_gestor"], "unidad").withColumn("intervencion_id", F.lit(None).cast("string"))
    works = units.select("upid", "nombre_centro_gestor", F.posexplode("intervenciones").alias("i", "w")).where(F.col("w").isNotNull()).select("upid", "nombre_centro_gestor", "i", "w.*")
    works = works.withColumn("intervencion_id", F.coalesce("intervencion_id", F.concat(F.col("upid"), F.lit("-INT"), F.col("i").cast("string"))))
    return top.unionByName(issues(works, work_rules(), ["upid", "nombre_centro_gestor", "intervencion_id"], "intervencion"))


def _weight(c: Column, *weights: float) -> Column:
    out = F.lit(0.0)
    for s, w in zip(SEVERITIES, weights, strict=True):
        out = F.when(c == s, w).otherwise(out)
    return out


def worst(c: str = "severity") -> Column:
    return F.element_at(F.array(*(F.lit(s) for s in SEVERITIES)), (F.min(severity_rank(c)) + 1).cast("int"))


def statistics(found: DataFrame, total: DataFrame, key: str = "upid") -> DataFrame:
    """QD7: one row of counts, score and rating; total: the validated records."""
    per = found.where(F.col(key).isNotNull()).groupBy(key).agg(worst().alias("worst"))
    affected = per.agg(F.count("*").alias("records_affected"), F.coalesce(F.sum(_weight(F.col("worst"), 1.0, 0.7, 0.3, 0.1, 0.0)), F.lit(0.0)).alias("_penalty"))
    counts = found.agg(F.count("*").alias("total_issues"), *(F.count_if(F.col("severity") == s).alias(s.lower()) for s in SEVERITIES))
    one = total.agg(F.count("*").alias("total_records")).crossJoin(F.broadcast(affected)).crossJoin(F.broadcast(counts))  # one row each
    score = F.when(F.col("total_records") > 0, F.bround(F.greatest(F.lit(0.0), (1 - F.col("_penalty") / F.col("total_records")) * 100), 2)).otherwise(F.lit(100.0))
    one = one.withColumn("quality_score", score)
    s = F.col("quality_score")
    return one.withColumns({"quality_rating": F.when(s >= 90, "EXCELENTE").when(s >= 75, "BUENA").when(s >= 60, "ACEPTABLE").when(s >= 40, "REGULAR").otherwise("DEFICIENTE"), "records_affected_pct": F.coalesce(F.try_divide(100 * F.col("records_affected"), F.col("total_records")), F.lit(0.0)), "actionable_issues": F.col("critical") + F.col("high")}).drop("_penalty")


def counts_by(found: DataFrame, *columns: str) -> DataFrame:
    """QD7: issues by severity, dimension, rule or field."""
    return found.groupBy(*columns).agg(F.count("*").alias("n"))


def fix_priority(severity: Column, n: Column) -> Column:
    """QD8."""
    return F.when((severity == CRITICAL) & (n >= 5), "P0").when((severity == CRITICAL) | ((severity == HIGH) & (n >= 10)), "P1").when((severity == HIGH) | ((severity == MEDIUM) & (n >= 15)), "P2").otherwise("P3")


def record_report(found: DataFrame, key: str = "upid") -> DataFrame:
    """QD8: for each record its worst severity, counts, fields and priority."""
    r = found.groupBy(key).agg(F.count("*").alias("total_issues"), worst().alias("max_severity"), *(F.count_if(F.col("severity") == s).alias(s.lower()) for s in SEVERITIES), F.array_sort(F.collect_set("field_name")).alias("affected_fields"))
    return r.withColumn("priority", fix_priority(F.col("max_severity"), F.col("total_issues")))


def centre_report(found: DataFrame, records: DataFrame, centre: str = "nombre_centro_gestor", key: str = "upid") -> DataFrame:
    """QD9: for each centre error rate, penalty score, status and whether it needs attention; a null centre is 'Sin centro gestor'."""
    name = F.coalesce(F.nullif(F.trim(F.col(centre)), F.lit("")), F.lit("Sin centro gestor"))
    totals = records.groupBy(name.alias("centre")).agg(F.count("*").alias("total_records"))
    bad = found.groupBy(name.alias("centre")).agg(F.count_distinct(key).alias("with_issues"), F.count("*").alias("total_issues"), *(F.count_if(F.col("severity") == s).alias(s.lower()) for s in SEVERITIES))
    r = totals.join(bad, "centre", "left").na.fill(0)
    penalty = sum((F.col(s.lower()) * w for s, w in zip(SEVERITIES, (10, 5, 2, 1, 0), strict=True)), F.lit(0))
    r = r.withColumns({"error_rate": 100 * F.col("with_issues") / F.col("total_records"), "quality_score": F.greatest(F.lit(0.0), 100 - penalty / (F.col("total_records") * 10) * 100)})
    q, e = F.col("quality_score"), F.col("error_rate")
    status = F.when((q >= 90) & (e < 10), "EXCELLENT").when((q >= 75) & (e < 20), "GOOD").when((q >= 60) & (e < 35), "FAIR").when(q >= 40, "POOR").otherwise("CRITICAL")
    return r.withColumn("status", status).withColumn("requires_attention", F.col("status").isin("POOR", "CRITICAL") | (F.col("critical") > 0))


def top_fields(found: DataFrame, k: int = 10, centre: str = "nombre_centro_gestor") -> DataFrame:
    """TK3: the fields with most issues in each centre."""
    return top_k_per_group(found.groupBy(centre, "field_name").agg(F.count("*").alias("n")), k, [centre], F.col("n").desc(), F.col("field_name"))


def affected_sample(found: DataFrame, centre: str = "nombre_centro_gestor", key: str = "upid", k: int = 100) -> DataFrame:
    """TK5: the first k affected ids of each centre, by id; k is what the report shows."""
    ids = top_k_per_group(found.select(centre, key).distinct(), k, [centre], F.col(key))
    return ids.groupBy(centre).agg(F.array_sort(F.collect_list(key)).alias("affected"))


def system_status(score: Column) -> Column:
    """QD10."""
    return F.when(score >= 90, "EXCELLENT").when(score >= 75, "GOOD").when(score >= 60, "ACCEPTABLE").when(score >= 40, "NEEDS_IMPROVEMENT").otherwise("CRITICAL")


def summary_report(found: DataFrame, records: DataFrame) -> DataFrame:
    """QD10: the statistics with the system's status, the centres that need attention and recommendations."""
    s = statistics(found, records).withColumn("system_status", system_status(F.col("quality_score")))
    centres = centre_report(found, records).agg(F.count("*").alias("centres"), F.count_if("requires_attention").alias("centres_require_attention"))
    some = F.array(F.when(F.col("critical") > 0, "fix critical issues first"), F.when(F.col("records_affected_pct") > 50, "review the capture process"), F.when(F.col("centres_require_attention") > 0, "support the centres that need attention"))
    return s.crossJoin(F.broadcast(centres)).withColumn("recommendations", F.filter(some, lambda x: x.isNotNull()))  # one row


def compare_runs(current: DataFrame, previous: DataFrame) -> DataFrame:
    """QD11: one row of changes between two summaries (one row each; without a previous one everything is neutral)."""
    better = {"quality_score": True, "total_issues": False, "records_affected": False, "total_records": True}
    prev = previous.select(*(F.col(c).alias(f"_p_{c}") for c in better))
    return current.join(prev, F.lit(True), "left").select(*(change(F.col(c), F.col(f"_p_{c}"), up).alias(c) for c, up in better.items()))


def checks(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """QD14: one row: whether each condition holds for all rows."""
    return df.agg(*(F.coalesce(F.bool_and(F.coalesce(c, F.lit(False))), F.lit(True)).alias(n) for n, c in conditions.items()))
