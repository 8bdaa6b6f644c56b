"""Bands, colours, states and dates of data."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import half_even

# Bands of the occupation coefficient (upper limit, label, colour).
OCCUPATION_BANDS = (
    (0.02, "< 2 %", "#ffffcc"),
    (0.05, "2 – 5 %", "#c7e9b4"),
    (0.10, "5 – 10 %", "#7fcdbb"),
    (0.20, "10 – 20 %", "#41b6c4"),
    (0.30, "20 – 30 %", "#2c7fb8"),
)
OCCUPATION_TOP = ("≥ 30 %", "#253494")
OCCUPATION_NONE = ("sin edificios", "#d9d9d9")

# Colour of a region by the first two digits of its code.
REGION_COLOURS = {
    "15": "#8dd3c7", "01": "#ffffb3", "02": "#bebada", "03": "#fb8072", "04": "#80b1d3", "05": "#fdb462",
    "13": "#b3de69", "06": "#fccde5", "07": "#d9d9d9", "16": "#bc80bd", "08": "#ccebc5", "09": "#ffed6f",
    "14": "#a6cee3", "10": "#fdbf6f", "11": "#cab2d6", "12": "#b2df8a",
}
REGION_OTHER = "#e0e0e0"


def _band(coefficient: Column, count: Column, pick: int) -> Column:
    expr = F.when(count == 0, F.lit(OCCUPATION_NONE[pick]))
    for limit, *texts in OCCUPATION_BANDS:
        expr = expr.when(coefficient < limit, F.lit(texts[pick]))
    return expr.otherwise(F.lit(OCCUPATION_TOP[pick]))


def occupation_label(coefficient: Column, count: Column) -> Column:
    return _band(coefficient, count, 0)


def occupation_colour(coefficient: Column, count: Column) -> Column:
    return _band(coefficient, count, 1)


def volume_state(index: Column) -> Column:
    return (F.when(index.isNull() | F.isnan(index), "sin_dato").when(index < 0.8, "holgura")
            .when(index <= 1.0, "al_limite").otherwise("excede"))


def region_colour(code: Column) -> Column:
    entries = [F.lit(v) for pair in REGION_COLOURS.items() for v in pair]
    return F.coalesce(F.try_element_at(F.create_map(*entries), code), F.lit(REGION_OTHER))


def semester_index(period: Column) -> Column:
    """'2026-1' → 4052: a difference of two indexes counts semesters."""
    index = F.substring(period, 1, 4).cast("int") * 2 + F.substring(period, 6, 1).cast("int") - 1
    return F.when(period.rlike(r"^20\d{2}-[12]$"), index)


def semester_text(period: Column) -> Column:
    half = F.when(F.endswith(period, F.lit("1")), "primer").otherwise("segundo")
    return F.concat(half, F.lit(" semestre de "), F.substring(period, 1, 4))


def current_semester(today: Column) -> Column:
    return F.concat_ws("-", F.year(today).cast("string"), F.when(F.month(today) <= 6, "1").otherwise("2"))


def data_date(period: Column, comuna_period: Column, today: Column, has_data: Column) -> Column:
    """How old the register data of a parcel is: struct with period, lag, state and notice."""
    own = F.nullif(period, F.lit(""))
    common = F.nullif(comuna_period, F.lit(""))
    inferred = has_data & own.isNull() & common.isNotNull()
    used = F.when(inferred, common).otherwise(own)
    now = current_semester(today)
    lag = semester_index(now) - semester_index(F.coalesce(used, common))
    late = F.coalesce(lag, F.lit(0)) > 0
    none_text = F.concat(
        F.lit("Sin datos del SII para este polígono: no tiene fecha propia, y un predio creado después del respaldo no aparece o figura sin datos."),
        F.when(common.isNotNull(), F.concat(F.lit(" El respaldo de la comuna es del "), semester_text(common), F.lit("."))).otherwise(""))
    late_text = F.concat(
        F.lit("Dato del "), semester_text(used), F.lit(": "), lag.cast("string"), F.lit(" semestre"),
        F.when(lag > 1, "s").otherwise(""), F.lit(" de diferencia con el semestre en curso ("), semester_text(now), F.lit(")."))
    today_text = F.concat(F.lit("Dato del "), semester_text(used), F.lit(", el semestre en curso."))
    notice = F.when(used.isNull(), none_text).when(late, late_text).otherwise(today_text)
    notice = F.concat(notice, F.when(inferred, " El periodo del predio no se lee en el respaldo; se usa el de la comuna.").otherwise(""))
    state = F.when(used.isNull(), "sin_dato").when(late, "atrasado").otherwise("al_dia")
    return F.struct(used.alias("periodo_sii"), inferred.alias("periodo_inferido"), common.alias("periodo_respaldo_comuna"),
                    now.alias("semestre_actual"), lag.alias("atraso_semestres"), state.alias("estado"), notice.alias("aviso"))


def estimated_height(height: Column, floors: Column, reference: float) -> Column:
    value = F.coalesce(F.nanvl(height, F.lit(None)), F.nanvl(floors, F.lit(None)) * reference, F.lit(reference))
    return value


def height_source(height: Column, floors: Column) -> Column:
    return (F.when(F.nanvl(height, F.lit(None)).isNotNull(), "overture_height")
            .when(F.nanvl(floors, F.lit(None)).isNotNull(), "overture_num_floors").otherwise("estimado"))


def zoom_tolerance(zoom: Column) -> Column:
    """Simplification tolerance in degrees; none from zoom 16 on."""
    return F.when(zoom.isNull() | (zoom >= 16), F.lit(0.0)).otherwise(F.lit(1.2e-5) * F.pow(F.lit(2.0), 15 - zoom))


def finite(value: Column) -> Column:
    """NaN and infinities become null (they are no JSON values)."""
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def hex_channel(colour: Column, channel: int) -> Column:
    return F.conv(F.substring(colour, 2 + 2 * channel, 2), 16, 10).cast("double")


def ramp_colour(value: Column, ramp: list[tuple[float, str]], step: bool = False) -> Column:
    """struct(r, g, b, a) of a value on a colour ramp; null is transparent.

    ``step``: the colour of the last entry not above the value, transparent below the first.
    Otherwise linear between entries and clamped at both ends.
    """
    stops = [(float(v), [int(c[i:i + 2], 16) for i in (1, 3, 5)]) for v, c in ramp]

    def channel(k: int) -> Column:
        first = stops[0]
        if step:
            expr = F.lit(float(first[1][k]))
            for stop, rgb in stops:
                expr = F.when(value >= stop, float(rgb[k])).otherwise(expr)
            return expr
        expr = F.when(value <= first[0], float(first[1][k]))
        for (v0, c0), (v1, c1) in zip(stops, stops[1:]):
            expr = expr.when(value <= v1, F.lit(float(c0[k])) + (value - v0) / (v1 - v0) * (c1[k] - c0[k]))
        return expr.otherwise(float(stops[-1][1][k]))

    visible = value.isNotNull() & ((value >= stops[0][0]) if step else F.lit(True))
    base = [F.when(value.isNull(), float(stops[0][1][k])).otherwise(channel(k)) for k in range(3)]
    return F.struct(*[half_even(c, 0).cast("int").alias(n) for c, n in zip(base, "rgb")],
                    F.when(visible, 255).otherwise(0).alias("a"))
