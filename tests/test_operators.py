"""DataFrame operators, plans, sources and sinks on small tables."""

import json
import random
from datetime import datetime
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import functions as F

from caudal.operators import aggregates as A
from caudal.operators import cdc, fuzzy, joins, quality, spatial
from caudal.operators import relational as R
from caudal.operators import windows as W
from caudal.plans import budget, contracts, units
from caudal.sources import files, paged, sinks
from caudal.streaming import changes


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_null_semantics(spark):
    df = spark.createDataFrame([(1, None, 1), (1, None, 2), (None, 5.0, 3), (2, 4.0, 4)], "k int, v double, o int")
    assert rows(A.facts_by_period(df, ["k"], ["v"], ["o"], "o"), "k") == [(1, 0.0, 1), (2, 4.0, 4)]
    assert rows(R.keep_first(df, ["k"], "o"), "o") == [(1, None, 1), (None, 5.0, 3), (2, 4.0, 4)]
    assert rows(R.keep_last(df, ["k"], "o"), "o") == [(1, None, 2), (None, 5.0, 3), (2, 4.0, 4)]
    assert df.where(R.not_in("k", 1)).count() == 2
    assert rows(W.last_values(df, ["k"], "o", "v"), "k") == [(None, 5.0), (1, None), (2, 4.0)]
    assert rows(W.duplicate_flag(df, ["k"]).select("o", "is_duplicate"), "o") == [(1, True), (2, True), (3, False), (4, False)]
    assert [r.group_id for r in W.group_ids(df, ["k"]).orderBy("o").collect()] == [1, 1, 3, 2]


def test_relational(spark):
    df = spark.createDataFrame([(1, "Obra Vial", None), (2, "servicio", "x"), (3, None, None)], "id int, t string, u string")
    assert R.without_words(["t"], ["servicio"])(df).count() == 2
    assert [r.id for r in R.few_nulls(0.5)(df).collect()] == [1, 2]
    assert R.fixed_schema({"id": "bigint", "zz": "double"})(df).columns == ["id", "zz"]
    assert R.without_last(df, 1, "id").count() == 2
    assert R.compose(lambda d: d.withColumn("a", F.col("b") + 1), lambda d: d.withColumn("b", F.lit(1)))(df).first().a == 2
    assert {r.tipo_instrumento for r in R.tagged({"a": df, "b": df.drop("u")}).collect()} == {"a", "b"}
    assert rows(R.rename_present({"t": "id", "u": "w"})(df).select("w", "t").limit(1)) == [(None, "Obra Vial")]


def test_statistics_match_pandas(spark):
    rng = random.Random(1)
    v = [rng.expovariate(1) for _ in range(50)]
    got = A.moments(spark.createDataFrame([(x,) for x in v], "v double"), [], "v").first()
    s = pd.Series(v)
    for k, want in {"skewness": s.skew(), "kurtosis": s.kurt(), "std": s.std(), "q1": s.quantile(0.25), "median": s.median()}.items():
        assert abs(got[k] - want) < 1e-9, k
    few = A.moments(spark.createDataFrame([(1.0,), (2.0,)], "v double"), [], "v").first()
    assert few.skewness is None and few.kurtosis is None


def test_trends(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i * i - 3 * i + 1) for i in range(10)], "x double, y double")
    q = W.quadratic_trend(df, "x", "y").first()
    assert all(abs(a - b) < 1e-8 for a, b in zip((q.a, q.b, q.c), (2, -3, 1), strict=True))
    m = W.moving_average(df, "y", "x", 10)
    assert [r.moving is None for r in m.orderBy("x").collect()] == [True] + [False] * 8 + [True]
    ids = W.global_ids(df.repartition(3), ["x"], "id", 100)
    assert [r.id for r in ids.orderBy("x").collect()] == list(range(101, 111))


def test_global_ids_over_ranges_that_are_read_with_other_columns(spark):
    df = spark.range(40_000).select("id", F.sha2(F.col("id").cast("string"), 512).alias("t"))
    r = W.global_ids(df, ["id"], "n").agg(F.max("t"), F.count("*").alias("rows"), F.count_if(F.col("n") != F.col("id") + 1).alias("wrong")).first()
    assert (r.rows, r.wrong) == (40_000, 0)


def test_pareto_and_hhi(spark):
    df = spark.createDataFrame([("a", 50.0), ("b", 30.0), ("c", 20.0)], "k string, v double")
    assert [r.vital for r in W.pareto(df, "v", "k").orderBy("rank").collect()] == [True, True, False]
    h = A.hhi(df, "k", "v").first()
    assert (h.hhi, h.band, h.holders) == (3800.0, "high", 3)


def test_cdc(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (3, "c", 3.0)], "id int, s string, v double")
    new = spark.createDataFrame([(1, "a", 1.000000001), (2, "b", 2.0), (4, "d", 4.0), (None, "e", 0.0)], "id int, s string, v double")
    c = cdc.classify(new, old, "id")
    assert rows(c.select("id", "change"), F.col("id").asc_nulls_last()) == [(1, "UNCHANGED"), (2, "MODIFIED"), (4, "NEW"), (None, "NEW")]
    assert rows(cdc.changelog(old, new, "id", ["v"]).where("id = 2")) == [(2, "v", None, "2.0")]
    assert rows(cdc.merge_fields(old, new.where("id = 2").withColumn("s", F.lit(None).cast("string")), "id").where("id = 2")) == [(2, "b", 2.0)]
    assert rows(cdc.upsert(old, new, "id").select("id"), F.col("id").asc_nulls_last()) == [(1,), (2,), (3,), (4,), (None,)]
    assert tuple(cdc.verify(new, old, "id").first()) == (4, 3, 2)


def test_joins(spark):
    a = spark.createDataFrame([(1, "building a new school"), (2, "road repair"), (3, None)], "i int, t string")
    b = spark.createDataFrame([(10, "school building programme"), (11, "building school yard"), (12, "repair")], "j int, t string")
    assert rows(joins.keyword_overlap(a, b, "i", "t", "j", "t")) == [(1, 10, 2)]
    assert sorted(rows(joins.reconcile(a.select("i"), spark.createDataFrame([(1,), (9,)], "i int"), "i"))) == [(2, "left"), (3, "left"), (9, "right")]
    m = [(spark.createDataFrame([(1, "x")], "k int, v string"), "k", "v"), (spark.createDataFrame([(1, "y"), (2, "z")], "k int, v string"), "k", "v")]
    assert rows(joins.cascade(spark.createDataFrame([(1,), (2,), (3,)], "k int"), m, "name"), "k") == [(1, "x"), (2, "z"), (3, None)]


def inside(x, y, rings):
    odd = False
    for r in rings:
        for (x1, y1), (x2, y2) in zip(r, r[1:], strict=False):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
    return odd


def test_polygons(spark):
    hole = [[[0.0, 0.0], [0.1, 0.0], [0.1, 0.1], [0.0, 0.1], [0.0, 0.0]], [[0.04, 0.04], [0.06, 0.04], [0.06, 0.06], [0.04, 0.06], [0.04, 0.04]]]
    concave = [[[0.1, 0.0], [0.2, 0.0], [0.2, 0.1], [0.15, 0.03], [0.1, 0.1], [0.1, 0.0]]]
    polygons = spark.createDataFrame([("a", hole), ("b", concave)], "name string, rings array<array<array<double>>>")
    rng = random.Random(7)
    pts = [(i, rng.uniform(-0.02, 0.22), rng.uniform(-0.02, 0.12)) for i in range(300)] + [(300, None, 0.05), (301, 0.05, 0.05)]
    got = {r.k: r.in_name for r in spatial.points_in_polygons(spark.createDataFrame(pts, "k int, x double, y double"), polygons, "x", "y", "k").collect()}
    for k, x, y in pts:
        want = None if x is None else "a" if inside(x, y, hole) else "b" if inside(x, y, concave) else None
        assert got[k] == want
    lines = spark.createDataFrame([(1, [[-0.01, 0.05], [0.3, 0.05]]), (2, [[0.05, 0.05], [0.051, 0.05]]), (3, [[0.15, 0.02]]), (4, [])], "k int, l array<array<double>>")
    assert sorted(rows(spatial.lines_in_polygons(lines, polygons, "l", "k"))) == [(1, "a"), (1, "b"), (3, "b")]
    bow = spark.createDataFrame([([[0.0, 0.0], [1.0, 1.0], [1.0, 0.0], [0.0, 1.0], [0.0, 0.0]],), (hole[0],), ([[0.0, 0.0], [1.0, 0.0], [0.0, 1.0], [2.0, 2.0]],)], "r array<array<double>>")
    assert [r[0] for r in bow.select(spatial.ring_problem(F.col("r"))).collect()] == ["self-intersection", None, "not closed"]


def test_proximity_clusters(spark):
    pts = [(1, 3.4, -76.5), (2, 3.4003, -76.5), (3, 3.4006, -76.5), (4, 3.5, -76.5), (5, None, -76.5), (6, 3.4, -76.5)]
    df = spark.createDataFrame([(*p, f"n{p[0] % 2}", None if p[0] == 3 else "d") for p in pts], "k long, lat double, lon double, a string, b string")
    c = spatial.proximity_clusters(df, "k", "lat", "lon", 40.0)
    assert rows(c.select("k", "cluster_geo"), "k") == [(1, 1), (2, 1), (3, 1), (4, 4), (5, None), (6, 1)]
    assert rows(spatial.split_clusters(c, "k", "a", "b").select("k", "part"), "k") == [(1, 0), (2, 1), (3, 0), (4, 0), (5, None), (6, 1)]


def test_similarity():
    assert fuzzy.ratio("abcd", "abed") == 75.0 and fuzzy.ratio("", "") == 100.0
    assert fuzzy.token_set("a b", "b a c") == 100.0 and fuzzy.token_set("a", "") == 0.0
    rng = random.Random(2)

    def lcs(a, b):
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        return t[-1][-1]

    for _ in range(200):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randrange(12))) for _ in range(2))
        assert fuzzy.common_subsequence(a, b) == lcs(a, b)


def test_fuzzy_clusters(spark):
    data = [(1, "Parque del Perro", "sede a", "CR 1"), (2, "Parque del Pero", "sede a", "CR 1"), (3, "Escuela Norte", "x", "CL 9"), (4, "Escuela Norte", "x", "CL 9")]
    df = spark.createDataFrame(data, "k long, n string, d string, p string")
    for mode in ("exact", "connected"):
        c = {r.k: r.cluster_fuzzy for r in fuzzy.fuzzy_clusters(df, "k", "n", "d", "p", mode=mode).collect()}
        assert c[1] == c[2] and c[3] == c[4] and c[1] != c[3]
    m = fuzzy.match_catalog(spark.createDataFrame([("construcion",), ("Salud",), ("zzz",), (None,)], "v string"), "v", ["Construcción", "SALUD"], "std")
    assert dict(rows(m)) == {"construcion": "Construcción", "Salud": "SALUD", "zzz": None, None: None}


def test_fuzzy_pairs_without_a_common_word(spark):
    texts = ["colegio", "colegios", "parque central", "parques centrales", "centrales parques", "cold widget", "old ring", "red bolt", "bolt rod", "a a a b", "b aa", "plaza", "x"]
    rng = random.Random(3)
    texts += sorted({" ".join("".join(rng.choice("abcde") for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(1, 3))) for _ in range(40)})
    df = spark.createDataFrame(list(enumerate(texts)), "k long, t string")
    for least in (0.0, 30.0, 60.0, 85.0):
        want = {(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if fuzzy.similarity(texts[i], texts[j]) >= least}
        got = [(r.a, r.b) for r in fuzzy.fuzzy_pairs(df, "k", "t", least).collect()]
        assert len(got) == len(want) and set(got) == want
    assert any(not set(texts[i].split()) & set(texts[j].split()) for i, j in want)
    want = {(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if 0.8 < SequenceMatcher(None, texts[i], texts[j]).ratio() < 1}
    assert want and {(r.a, r.b) for r in fuzzy.potential_duplicates(df, "k", "t").collect()} == want


def test_fuzzy_clusters_without_a_common_word(spark):
    data = [(1, "colegio", "sur", "CR 1"), (2, "colegios", "surs", "CR 1"), (3, "museo", "x", None), (4, "museo", "x", None), (5, "", "", "y"), (6, "", "", "y")]
    df = spark.createDataFrame(data, "k long, n string, d string, p string")
    c = {mode: {r.k: r.cluster_fuzzy for r in fuzzy.fuzzy_clusters(df, "k", "n", "d", "p", mode=mode).collect()} for mode in ("exact", "connected")}
    assert c == {"exact": {1: 0, 2: 0, 3: 1, 4: 1, 5: 2, 6: 3}, "connected": {1: 1, 2: 1, 3: 3, 4: 3, 5: 5, 6: 6}}


def raw_units(spark):
    base = {"nombre_up": "ips norte", "nombre_up_detalle": "sede 1", "direccion": "calle 1", "clase_up": None, "tipo_equipamiento": None, "nombre_centro_gestor": "Obras", "comuna_corregimiento": "comuna 7", "barrio_vereda": "b", "tipo_intervencion": "Obra nueva", "estado": "", "bpin": "2.024.760", "referencia_contrato": "a, b", "ano": "2025", "fecha_inicio": "15/01/2025"}
    data = [base | {"_row_id": 1, "lat": "3,45", "lon": "76.53", "presupuesto_base": "1.000.000", "avance_obra": "50%"}, base | {"_row_id": 2, "lat": "3.45", "lon": "-76.53", "presupuesto_base": "$3,000,000", "avance_obra": "cero"}, base | {"_row_id": 3, "lat": None, "lon": None, "nombre_up": "Parque", "presupuesto_base": "-", "avance_obra": "100"}]
    return spark.createDataFrame(pd.DataFrame(data).astype(object).where(lambda d: d.notna(), None).astype({"_row_id": "int64"}), schema=", ".join(f"{c} {'long' if c == '_row_id' else 'string'}" for c in pd.DataFrame(data).columns))


def test_units_plan(spark):
    u, found = units.run(raw_units(spark), ["IPS"])
    got = {r.upid: r for r in u.collect()}
    assert len(got) == 2
    r = next(x for x in got.values() if x.n_intervenciones == 2)
    assert r.nombre_up == "IPS Norte" and r.tipo_equipamiento == "IPS" and r.clase_up == "Obras equipamientos" and r.presupuesto_base == 4_000_000 and r.avance_obra == 12.5 and r.comuna_corregimiento == "COMUNA 07"
    assert [w.estado for w in r.intervenciones] == ["En ejecución", "En alistamiento"] and [w.intervencion_id[-3:] for w in r.intervenciones] == ["-01", "-02"] and r.geometry.coordinates == [-76.53, 3.45]
    assert {(i.rule_id, i.field_name) for i in found.collect()} >= {("LC001", "presupuesto_base"), ("CO002", "geometry")}
    assert units.to_rows(u).count() == 3


def test_quality_of_units(spark):
    one = spark.createDataFrame([("U1", "n", "calle", "X", None, None, [-76.5, 3.4], [("Raro", "t", 0.0, 2024, 150.0, None)]), ("U2", "", "calle", "IPS", "c", "c1", [3.4, -76.5], []), ("U3", "n", "calle", "IPS", "c", "c1", None, [("Terminado", "t", 5.0, 2024, 50.0, "w")])], "upid string, nombre_up string, direccion string, tipo_equipamiento string, clase_up string, nombre_centro_gestor string, xy array<double>, intervenciones array<struct<estado:string,tipo_intervencion:string,presupuesto_base:double,ano:int,avance_obra:double,intervencion_id:string>>")
    u = one.withColumn("geometry", F.when(F.col("xy").isNotNull(), F.struct(F.lit("Point").alias("type"), F.col("xy").alias("coordinates"))))
    found = quality.validate_units(u, ["IPS"])
    got = {(r.upid, r.rule_id) for r in found.collect()}
    assert got == {("U1", "CO001"), ("U1", "TA008"), ("U1", "TA001"), ("U1", "LC001"), ("U1", "LC002"), ("U2", "CO001"), ("U2", "PA002"), ("U2", "LC009"), ("U3", "CO002"), ("U3", "LC003")}
    s = quality.statistics(found, u).first()
    assert s.quality_score == round((1 - (1 + 1 + 0.3) / 3) * 100, 2) and s.quality_rating == "DEFICIENTE"
    assert quality.summary_report(found, u).first().system_status == "CRITICAL"
    assert {r.centre for r in quality.centre_report(found, u).collect()} == {"Sin centro gestor", "c1"}
    assert {r.upid: r.priority for r in quality.record_report(found).collect()}["U3"] == "P3"
    assert quality.compare_runs(quality.statistics(found, u), quality.statistics(found, u)).first().quality_score.trend == "stable"


def test_strict_rules(spark):
    cols = ["nombre_up", "estado", "clase_up", "tipo_intervencion", "tipo_equipamiento", "nombre_centro_gestor", "comuna_corregimiento", "barrio_vereda", "direccion", "upid", "bpin", "identificador", "fecha_inicio", "fecha_fin", "referencia_contrato", "referencia_proceso", "comuna_corregimiento_val", "barrio_vereda_val", "plataforma", "unidad", "fuente_financiacion", "url_proceso", "avance_obra", "presupuesto_base", "cantidad", "ano"]
    ok = dict.fromkeys(cols, "x") | {"estado": "Terminado", "avance_obra": "100", "presupuesto_base": "5", "cantidad": "1", "ano": "2024", "fecha_inicio": "2023-01-01", "fecha_fin": "2024-01-01", "url_proceso": "https://a.b/c"}
    bad = ok | {"avance_obra": "40", "presupuesto_base": "-1", "ano": "1990", "fecha_fin": "2022-01-01", "url_proceso": "nope", "direccion": ""}
    df = spark.createDataFrame([tuple(r[c] for c in cols) for r in (ok, bad)], ", ".join(f"{c} string" for c in cols)).withColumns({"lat": F.lit(3.4), "lon": F.lit(-76.5), "id": F.when(F.col("ano") == "2024", "ok").otherwise("bad")})
    catalogs = {c: ["x", "Terminado"] for c in ("estado", "tipo_intervencion", "plataforma", "unidad", "clase_up", "tipo_equipamiento", "fuente_financiacion")}
    got = quality.issues(df, quality.strict_rules(catalogs, F.lit("2025-01-01").cast("date")), ["id"]).collect()
    assert {r.rule_id for r in got if r.id == "ok"} == set()
    assert {r.rule_id for r in got if r.id == "bad"} == {"LC001", "LC004", "LC007", "TQ001", "TQ005", "TA005", "CO006"}


def test_budget_plan(spark):
    df = spark.createDataFrame([(1, "1", "BP1", "p", "10", "5", "enero", 2024), (2, "1", "BP1", "q", "20", "0", "enero", 2024), (3, "2", None, None, "0", "0", "enero", 2024), (4, None, "BP9", "z", "7", "7", "enero", 2024)], "_row_id long, bpin string, bp string, nombre_proyecto string, ppto_inicial string, pagos string, dataframe_origen string, anio int")
    p = budget.prepared(df)
    assert rows(budget.movements(p).select("bpin", "ppto_inicial")) == [(1, 30)]
    assert rows(budget.execution(p).select("bpin", F.col("periodo_corte").cast("string"), "pagos")) == [(1, "2024-01-31", 5)]
    assert rows(budget.dimension(p).select("bpin", "nombre_proyecto"), "bpin") == [(1, "p"), (2, None)]


def test_contract_plan(spark):
    c = spark.createDataFrame([(1, " C - 1 ", "$ 1,000", "05/06/2024", "77", "Obra", "activo", "P1"), (2, "C-2", "5", None, "No Definido", "Obra", "activo", None), (3, "C-3", "5", None, "78", "Prestación de servicios", "activo", None)], "_row_id long, referencia_contrato string, valor_contrato string, fecha_firma string, bpin string, tipo_contrato string, estado_contrato string, proceso_compra string")
    clean = contracts.clean_contracts(c)
    assert rows(clean.select("referencia_contrato", "valor_contrato", "fecha_firma", "bpin")) == [("C-1", 1000, "2024-06-05", 77)]
    assert contracts.by_project(clean).first().contratos[0].referencia_contrato == "C-1"
    r = spark.createDataFrame([("C-1", 1, 30.0, 20.0, False), ("C-1", 2, 40.0, 60.0, False)], "referencia_contrato string, fecha_reporte int, avance_fisico double, avance_financiero double, alertas_es_alerta boolean")
    g = contracts.gap_report(clean, r).first()
    assert (g.delta, g.pending, g.critical) == (-20.0, 600.0, True)


def test_sources_and_sinks(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    (d / "enero_2024.csv").write_text("BPIN,Valor\n1,10\n2,20\n", encoding="utf-8")
    (d / "marzo_2023.csv").write_bytes("BPIN,Organismo\n3,Secretaría\n".encode("latin-1"))
    (d / "notes.bin").write_bytes(b"\x00")
    df = files.scan_folder(spark, str(d))
    assert rows(df.select("bpin", "valor", "organismo", "_mes_asociado", "_vigencia_asociada"), "bpin") == [("1", "10", None, "enero", "2024"), ("2", "20", None, "enero", "2024"), ("3", None, "Secretaría", "marzo", "2023")]
    assert files.since_year(df, 2024).count() == 2
    (tmp_path / "h.csv").write_text("Informe,,\n,,\nBPIN,Nombre Proyecto,Valor\n1,x,5\n", encoding="utf-8")
    assert rows(files.read_with_header_search(spark, str(tmp_path / "h.csv"))) == [("1", "x", "5")]
    geo = spark.createDataFrame([(1, "a", 3.4, -76.5), (2, None, None, None)], "id int, n string, lat double, lon double")
    sinks.write_geojson(geo, str(tmp_path / "geo"))
    out = sorted((json.loads(r.value) for r in spark.read.text(str(tmp_path / "geo")).collect()), key=lambda f: f["properties"]["id"])
    assert out[0]["geometry"] == {"type": "Point", "coordinates": [-76.5, 3.4]} and out[1]["geometry"] is None
    (tmp_path / "f.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": out}), encoding="utf-8")
    assert files.flat_features(files.read_geojson(spark, str(tmp_path / "f.geojson"))).count() == 2
    sinks.write_by_key(geo.na.fill("z"), str(tmp_path / "by"), "n", "lat")
    assert spark.read.option("header", True).csv(str(tmp_path / "by")).count() == 2
    assert sinks.short_names(["nombre_centro_gestor", "nombre_centro"]) == {"nombre_centro_gestor": "nombre_cen", "nombre_centro": "nombre_c_1"}
    assert files.find_text(geo, "A").count() == 1


def fetch(offset, limit, filters):
    return [{"id": i, "name": f"n{i % 3}"} for i in range(offset, offset + limit)]


def test_paged_source(spark):
    reader = paged.PagedReader(spark.createDataFrame([], "id int, name string").schema, {"fetcher": f"{__name__}:fetch", "total": "25", "page": "10"})
    parts = reader.partitions()
    assert [(p.offset, p.limit) for p in parts] == [(0, 10), (10, 10), (20, 5)]
    assert [r for p in parts for r in reader.read(p)] == [(i, f"n{i % 3}") for i in range(25)]


def test_status_changes_logic():
    out, previous, seen = changes.changes_of(None, False, [("a", False), ("a", False), ("b", False), (None, True), ("c", False)])
    assert out == [("NEW", None, "a"), ("UPDATE", "a", "b"), ("NEW", None, "c")] and previous == "c" and seen


def test_status_stream(spark, tmp_path):
    ts = datetime(2024, 1, 1)
    batches = [[("u1", "a", False, ts), ("u2", "x", False, ts)], [("u1", "b", False, ts), ("u2", "x", False, ts), ("u3", "n", False, ts)]]
    for i, b in enumerate(batches):
        spark.createDataFrame(b, "upid string, estado string, deleted boolean, ts timestamp").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("upid string, estado string, deleted boolean, ts timestamp").parquet(str(tmp_path / "in"))
        changes.run_once(changes.status_changes(stream), lambda df, _: df.write.mode("append").parquet(str(tmp_path / "out")), str(tmp_path / "cp"))
    got = sorted(rows(spark.read.parquet(str(tmp_path / "out"))), key=str)
    assert got == sorted([("u1", "NEW", None, "a"), ("u2", "NEW", None, "x"), ("u1", "UPDATE", "a", "b"), ("u3", "NEW", None, "n")], key=str)


def test_status_stream_keeps_units_by_buckets(spark, tmp_path):
    at = lambda s: datetime(2024, 1, 1, 0, 0, s)
    many = [(f"u{i}", "a", False, at(0)) for i in range(200)]
    batches = [[*many, ("u1", "c", False, at(2)), ("u1", "b", False, at(1)), ("u2", None, True, at(1))], [("u2", "d", False, at(3)), ("u3", None, False, at(3)), ("u4", None, True, at(3)), ("u5", "a", False, at(3)), (None, "n", False, at(3))], [("u4", "a", False, at(4)), ("u3", "e", False, at(4)), (None, "m", False, at(4))]]
    for b in batches:
        df = spark.createDataFrame(b, "upid string, estado string, deleted boolean, ts timestamp")
        df.write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
        query = changes.run_once(changes.status_changes(stream, buckets=4), lambda df, _: df.write.mode("append").parquet(str(tmp_path / "out")), str(tmp_path / "cp"))
        assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 5
    got = sorted(rows(spark.read.parquet(str(tmp_path / "out"))), key=str)
    more = [("u1", "UPDATE", "a", "b"), ("u1", "UPDATE", "b", "c"), ("u2", "NEW", None, "d"), ("u3", "UPDATE", "a", None), (None, "NEW", None, "n"), ("u4", "NEW", None, "a"), ("u3", "UPDATE", None, "e"), (None, "UPDATE", "n", "m")]
    assert got == sorted([*((u, "NEW", None, "a") for u, *_ in many), *more], key=str)


def test_event_values(spark):
    e = {"data": {"value": {"fields": {"upid": {"stringValue": "u"}, "estado": {"stringValue": "e"}}}}}
    gone = {"data": {"oldValue": {"fields": {"upid": {"stringValue": "u"}}}}}
    df = spark.createDataFrame([(json.dumps(e), datetime(2024, 1, 1)), (json.dumps(gone), datetime(2024, 1, 1))], "value string, ts timestamp")
    assert [tuple(r)[:3] for r in changes.event_values(df).collect()] == [("u", "e", False), ("u", None, True)]


def test_upserts_follow_one_another(spark, tmp_path):
    from caudal.sources import sinks

    path = str(tmp_path / "t")
    write = lambda *rows: sinks.write_upsert(spark.createDataFrame(rows, "k long, v string"), path, "k", identity="id")
    assert write((1, "a"), (2, "b")) == 1
    assert write((2, "c"), (3, "d")) == 2
    (tmp_path / "t" / "data" / "abc" / "_bucket=1").mkdir(parents=True)  # of a run that was never finished
    assert sorted(map(tuple, sinks.read_current(spark, path).select("k", "v", "id").collect())) == [(1, "a", 1), (2, "c", 2), (3, "d", 3)]
    assert write((4, "e")) == 3 and len(list((tmp_path / "t" / "_manifests").glob("*.json"))) == 2
    assert sinks.read_current(spark, path).count() == 4


def test_scan_tells_encodings_and_headers(spark, tmp_path):
    from caudal.sources import files

    for name, encoding, text in (("a 2024.csv", "utf-8", "Región\nBogotá\n"), ("b 2024.csv", "latin-1", "Región\nCúcuta\n"), ("c 2024.csv", "cp1252", "Región\nPasto “viejo”\n"), ("d 2024.csv", "utf-8", "Otra,Región\n1,Ñame\n"), ("e 2024.csv", "utf-8", "﻿Región\nQuibdó\n")):
        (tmp_path / name).write_bytes(text.encode(encoding))
    got = files.scan_folder(spark, str(tmp_path))
    assert sorted(r.region for r in got.collect()) == ["Bogotá", "Cúcuta", "Pasto “viejo”", "Quibdó", "Ñame"]


def test_steps_are_logged():
    from caudal.operators.relational import logged

    said = []

    class Frame:
        columns = ["a", "b"]

    logged("x", said.append)(lambda d: d)(Frame())
    assert said[0].startswith("x: 2 columns")


def _workbook(sheets):
    import io
    import zipfile
    from xml.sax.saxutils import escape

    out, shared = io.BytesIO(), []
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", '<workbook xmlns="m" xmlns:r="r"><sheets>' + "".join(f'<sheet name="{n}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(sheets, 1)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", "<R>" + "".join(f'<Relationship Id="rId{i}" Target="worksheets/s{i}.xml"/>' for i in range(1, len(sheets) + 1)) + "</R>")
        for i, rows_ in enumerate(sheets.values(), 1):
            body = ""
            for r, row in enumerate(rows_, 1):
                body += f'<row r="{r}">'
                for c, v in enumerate(row):
                    if isinstance(v, str):
                        shared.append(v)
                        body += f'<c r="{chr(65 + c)}{r}" t="s"><v>{len(shared) - 1}</v></c>'
                    elif v is not None:
                        body += f'<c r="{chr(65 + c)}{r}"><v>{v}</v></c>'
                body += "</row>"
            z.writestr(f"xl/worksheets/s{i}.xml", f'<worksheet xmlns="m"><sheetData>{body}</sheetData></worksheet>')
        z.writestr("xl/sharedStrings.xml", '<sst xmlns="m">' + "".join(f"<si><t>{escape(v)}</t></si>" for v in shared) + "</sst>")
    return out.getvalue()


def test_workbooks(spark, tmp_path):
    from caudal.sources import archives

    sheets = {"Notas": [["nada"], [1]], "DEFINITIVO": [["Informe & más"], [None, None], ["BPIN", "Nombre Proyecto", "Valor"], [2024, "Colegio ñ", 10.5], [None, None, None], [2025, None, 7]]}
    for n in ("a", "b"):
        (tmp_path / f"{n}.xlsx").write_bytes(_workbook(sheets))
    got = archives.read_sheet(spark, str(tmp_path), "DEFINITIVO")
    assert got.columns == ["_archivo_origen", "_fila", "bpin", "nombre_proyecto", "valor"]
    assert rows(got, "_archivo_origen", "_fila") == [(f"{n}.xlsx", r, *v) for n in ("a", "b") for r, v in ((4, ("2024", "Colegio ñ", "10.5")), (6, ("2025", None, "7")))]
    assert rows(archives.read_sheet(spark, str(tmp_path)), "_archivo_origen", "_fila") == rows(got, "_archivo_origen", "_fila")


def test_kmz_and_shape_files(spark, tmp_path):
    import io
    import struct
    import zipfile

    from caudal.sources import archives

    kml = '<kml xmlns="k"><Document><Placemark><name>A</name><Point><coordinates>-76.5,3.4,0</coordinates></Point></Placemark><Placemark><name>B</name><LineString><coordinates>0,0 1,1</coordinates></LineString></Placemark></Document></kml>'
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        z.writestr("doc.kml", kml)
    (tmp_path / "a.kmz").write_bytes(packed.getvalue())
    assert rows(archives.read_kmz(spark, str(tmp_path)).select("name", "kind", "coordinates"), "name") == [("A", "Point", [[-76.5, 3.4]]), ("B", "LineString", [[0.0, 0.0], [1.0, 1.0]])]
    point = struct.pack("<i2d", 1, -76.5, 3.4)
    ring = [(0, 0), (1, 0), (1, 1), (0, 0)]
    polygon = struct.pack("<i4d2i", 5, 0, 0, 1, 1, 1, 4) + struct.pack("<i", 0) + b"".join(struct.pack("<2d", *p) for p in ring)
    body = b"".join(struct.pack(">ii", i, len(x) // 2) + x for i, x in enumerate((point, polygon), 1))
    (tmp_path / "s.shp").write_bytes(b"\0" * 100 + body)
    assert rows(archives.read_shapes(spark, str(tmp_path)).select("name", "kind", "coordinates"), "name") == [("1", "Point", [[-76.5, 3.4]]), ("2", "Polygon", [[float(x), float(y)] for x, y in ring])]


def test_match_cascade_matches_brute_force(spark):
    rng = random.Random(3)
    name = lambda: None if rng.random() < 0.05 else "".join(rng.choice("aábcde ") for _ in range(rng.randint(0, 9)))
    side = lambda n: [(i, rng.choice([None, "", f"Calle {rng.randint(1, 40)}"]), name(), rng.randint(1, 4)) for i in range(n)]
    left, right = side(60), [*side(60), (60, None, "solo", 9)]
    left.append((60, None, "otro", 9))
    a = spark.createDataFrame(left, "k long, address string, name string, area int")
    b = spark.createDataFrame(right, "o long, address string, name string, area int")
    upper = lambda x: " ".join((x or "").replace("á", "a").upper().split())
    only = {z: [o for o, _, _, y in right if y == z] for z in range(10)}
    for cutoff in (0.0, 0.5, 0.85):
        want = []
        for k, ad, na, z in left:
            for o, bd, nb, y in right:
                x = (upper(na), upper(nb))
                kinds = [ad and ad == bd, x[0] and x[0] == x[1], z == y and any(x) and SequenceMatcher(None, *x).ratio() > cutoff, only[z] == [o]]
                want += [(k, i, o) for i, yes in enumerate(kinds) if yes]
        best = {}
        for k, i, o in sorted(want):
            best.setdefault(k, (o, i))
        got = fuzzy.match_cascade(a, b, "k", "o", "address", "name", ["area"], cutoff)
        assert rows(got, "k") == sorted((k, *v) for k, v in best.items())
        assert best[60] == (60, 3 if cutoff else 2)
