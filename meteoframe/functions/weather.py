"""Grades, code labels, alerts, discomfort index and outdoor score.

Every rule is a ``when`` chain or arithmetic on columns, so the optimizer can
fold and push it like any built-in expression.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meteoframe import constants as K
from meteoframe.functions.numeric import clamp, safe_double
from meteoframe.functions.text import _c


def dust_grade(pm10_text) -> Column:
    """PM10 grade from the unrounded numeric value; bad or missing -> unknown."""
    v = safe_double(pm10_text)
    expr = None
    for bound, label in K.DUST_GRADE_BOUNDS:
        expr = F.when(v <= bound, label) if expr is None else expr.when(v <= bound, label)
    last = K.DUST_GRADE_BOUNDS[-1][0]
    return expr.when(v > last, K.DUST_GRADE_ABOVE).otherwise(K.DUST_GRADE_UNKNOWN)


def _label_map(mapping: dict) -> Column:
    items = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def sky_label(c) -> Column:
    """'1'..'4' -> label; unknown codes and null pass through unchanged."""
    col = _c(c)
    return F.coalesce(_label_map(K.SKY_LABELS)[col], col)


def pty_label(c) -> Column:
    """Compared as numbers ('0' and '0.0' are equal); others pass through."""
    col = _c(c)
    labels = _label_map({float(k): v for k, v in K.PTY_LABELS.items()})
    return F.coalesce(labels[safe_double(col)], col)


def strong_wind_alert(wsd) -> Column:
    return F.when(_c(wsd) >= K.STRONG_WIND_MIN, "Yes").otherwise("No")


def discomfort_index(temp, humidity) -> Column:
    t, h = _c(temp), _c(humidity)
    return (F.lit(K.DI_T) * t + F.lit(K.DI_H) * h * (F.lit(K.DI_T2) * t - F.lit(K.DI_C0))
            + F.lit(K.DI_C1))


def discomfort_alert(di) -> Column:
    """>= 80 very high, >= 75 high, otherwise (null included) normal."""
    d = _c(di)
    return (F.when(d >= K.DISCOMFORT_VERY_HIGH[0], K.DISCOMFORT_VERY_HIGH[1])
            .when(d >= K.DISCOMFORT_HIGH[0], K.DISCOMFORT_HIGH[1])
            .otherwise(K.DISCOMFORT_NORMAL))


def outdoor_score(temp, humidity, rain, wind, ground) -> Column:
    """Weekly outdoor score, 0..100.

    Start 100; discomfort >= 80: -40, >= 75: -20, <= 60: +10; rain > 10: -40,
    > 0: -20; wind > 10: -30, > 5: -15; ground > 35 or < 5: -20 (null ground
    skipped); then clamp.  A null temperature, humidity, rain or wind gives a
    null score (the scalar rule cannot be evaluated).
    """
    di = discomfort_index(temp, humidity)
    r, w, g = _c(rain), _c(wind), _c(ground)
    muggy = F.when(di >= 80, -40).when(di >= 75, -20).when(di <= 60, 10).otherwise(0)
    wet = F.when(r > 10, -40).when(r > 0, -20).otherwise(0)
    windy = F.when(w > 10, -30).when(w > 5, -15).otherwise(0)
    harsh = F.when((g > 35) | (g < 5), -20).otherwise(0)  # a null ground matches neither
    ok = _c(temp).isNotNull() & _c(humidity).isNotNull() & r.isNotNull() & w.isNotNull()
    return F.when(ok, clamp(F.lit(100) + muggy + wet + windy + harsh)).cast("int")
