"""Works status, derived categories and performance classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import col, number, swap, without

PREPARING, RUNNING, DONE, SUSPENDED, OPENED = "En alistamiento", "En ejecución", "Terminado", "Suspendido", "Inaugurado"
STATES = (PREPARING, RUNNING, DONE, SUSPENDED, OPENED)
#: Parts of words that tell the state (fixed values).
SIGNS = ((PREPARING, ("socializaci", "alistamiento", "planeaci", "preparaci", "por iniciar")), (RUNNING, ("ejecuci", "proceso", "construcci", "desarrollo")), (DONE, ("finalizado", "terminado", "completado", "concluido", "entregado", "liquidaci")))


def progress_number(c: Column | str) -> Column:
    s = F.trim(col(c).cast("string"))
    return number(without(swap(swap(s, ",", "."), "cero", "0"), "[()]"))


def by_progress(p: Column) -> Column:
    return F.when(p == 0, PREPARING).when(p >= 100, DONE).when((p > 0) & (p < 100), RUNNING)


def by_words(c: Column | str) -> Column:
    s = F.lower(F.trim(col(c)))
    out = F.lit(None).cast("string")
    for state, signs in reversed(SIGNS):
        hit = s.contains(signs[0])
        for x in signs[1:]:
            hit = hit | s.contains(x)
        out = F.when(hit, state).otherwise(out)
    return out


def status(state: Column | str, progress: Column | str) -> Column:
    """SF18: suspended and opened stay; otherwise progress decides, then words; a blank state without readable progress is being prepared, another unknown one is running.

    Progress below 0 leaves the decision to the words, and counts as running for a blank state.
    """
    s, p = F.trim(col(state)), progress_number(progress)
    blank = s.isNull() | (s == "")
    kept = F.initcap(F.lower(s))
    return (
        F.when(blank, F.when(p.isNull(), PREPARING).otherwise(F.coalesce(by_progress(p), F.lit(RUNNING))))
        .when(F.lower(s).isin("suspendido", "inaugurado"), kept)
        .otherwise(F.coalesce(by_progress(p), by_words(s), F.lit(RUNNING)))
    )


def status_three(state: Column | str, progress: Column | str) -> Column:
    """SF19: the loaders' variant: three states only, progress first."""
    return F.coalesce(by_progress(progress_number(progress)), by_words(state), F.lit(RUNNING))


def status_words(state: Column | str) -> Column:
    """SF19: the mass update's variant: words only; what they don't tell stays."""
    return F.coalesce(by_words(state), col(state))


def status_exact(state: Column | str, progress: Column | str) -> Column:
    """SF20: only progress 0, 1 to 99 and 100 override; between 0 and 1, and between 99 and 100, nothing changes."""
    p = col(progress)
    return F.when(p == 0, PREPARING).when(p == 100, DONE).when(p.between(1, 99), RUNNING).otherwise(col(state))


ACTIVE_CLASSES = ("Obras equipamientos", "Obra vial", "Espacio Público")
NOT_EQUIPMENT = ("Vivienda mejoramiento", "Vivienda nueva", "Adquisición de predios", "Señalización vial")
NOT_WORKS = ("Mantenimiento", "Estudios y diseños", "Transferencia directa")


def active_front(kind: Column | str, equipment: Column | str, works: Column | str, state: Column | str) -> Column:
    """SF21: a null equipment or works type is not excluded."""
    no = F.lit(False)
    base = F.coalesce(col(kind).isin(*ACTIVE_CLASSES), no) & ~F.coalesce(col(equipment).isin(*NOT_EQUIPMENT), no) & ~F.coalesce(col(works).isin(*NOT_WORKS), no)
    return F.when(base & (col(state) == RUNNING), "Frente activo").when(base & (col(state) == SUSPENDED), "Inactivo").otherwise("No aplica")


def infer_categories(name: Column | str, centre: Column | str, kind: Column | str, equipment: Column | str) -> dict[str, Column]:
    """SF22: health posts by name, then by department, where the categories are missing."""
    no_kind = col(kind).isNull() | (col(kind) == "")
    no_equipment = col(equipment).isNull() | (col(equipment) == "")
    by_name = F.coalesce(F.upper(col(name)).contains("IPS"), F.lit(False)) & no_equipment
    by_centre = F.coalesce(col(centre) == "Secretaría de Salud Pública", F.lit(False)) & no_kind & ~by_name
    return {"clase_up": F.when((by_name & no_kind) | by_centre, "Obras equipamientos").otherwise(col(kind)), "tipo_equipamiento": F.when(by_name | (by_centre & no_equipment), "IPS").otherwise(col(equipment))}


def performance(pct: Column | str) -> Column:
    """SF47."""
    p = col(pct)
    return F.when(p >= 80, "Excelente").when(p >= 50, "Bueno").when(p >= 20, "Regular").otherwise("Bajo")


def execution_kind(pct: Column | str) -> Column:
    """SF47."""
    p = col(pct)
    return F.when(p > 100, "Sobre-ejecutado").when(p == 100, "Completo").when(p >= 80, "Alto").when(p >= 50, "Medio").when(p >= 20, "Bajo").otherwise("Muy bajo")


def gap(physical: Column | str, financial: Column | str, value: Column | str, alert: Column | str) -> dict[str, Column]:
    """SF48: physical less financial progress, value still pending, and whether that is critical."""
    delta = col(physical) - col(financial)
    return {"delta": delta, "pending": col(value) * (1 - col(physical) / 100), "critical": F.coalesce(col(alert), F.lit(False)) | F.coalesce(delta < -15, F.lit(False))}


def deviates(a: Column | str, b: Column | str, most: float = 15.0) -> Column:
    """SF49."""
    return F.abs(col(a) - col(b)) > most


