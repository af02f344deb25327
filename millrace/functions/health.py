"""Health-risk features as column expressions."""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Col = str | Column

# Bin edges and labels.
AGE_BINS = [0, 30, 40, 50, 60, 70, 100]
AGE_LABELS = ["<30", "30-40", "40-50", "50-60", "60-70", "70+"]
AGE_GROUP_BINS = [0, 40, 55, 70, 100]
AGE_GROUP_LABELS = ["young", "middle_aged", "senior", "elderly"]
BMI_BINS = [0, 18.5, 25, 30, 35, 100]
BMI_LABELS = ["underweight", "normal", "overweight", "obese_1", "obese_2"]
BMI_CATEGORY_BINS = [0, 18.5, 25, 30, 100]
BMI_CATEGORY_LABELS = ["underweight", "normal", "overweight", "obese"]
CHOLESTEROL_BINS = [0, 200, 240, 1000]
CHOLESTEROL_LABELS = ["normal", "borderline", "high"]
SMOKING_BINS = [-1, 0, 10, 20, 100]
SMOKING_LABELS = ["non_smoker", "light", "moderate", "heavy"]
# Upper limits and scores of the step functions.
AGE_SCORE = ([35, 45, 55, 65], [0, 2, 4, 6, 8])
CHOLESTEROL_SCORE = ([200, 240], [0, 1, 2])
PRESSURE_SCORE = ([120, 140, 160], [0, 1, 2, 3])
BMI_SCORE = ([25, 30, 35], [0, 1, 2, 3])
AGE_RISK = ([45, 65], ["low", "medium", "high"])
RISK_LEVEL = ([0.3, 0.7], ["Low", "Medium", "High"])


def _c(value: Col) -> Column:
    return F.col(value) if isinstance(value, str) else value


def cut(value: Col, bins: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins (lo, hi]; NULL outside."""
    v = _c(value)
    out = None
    for lo, hi, label in zip(bins, bins[1:], labels):
        hit = (v > lo) & (v <= hi)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out


def step(value: Col, limits: Sequence[float], results: Sequence, null_as_last: bool = False) -> Column:
    """Left-closed steps: the first limit above the value decides.

    NULL stays NULL unless ``null_as_last`` sends it to the last step.
    """
    v = _c(value)
    out = F.when(v < limits[0], F.lit(results[0]))
    for limit, result in zip(limits[1:], results[1:]):
        out = out.when(v < limit, F.lit(result))
    out = out.otherwise(F.lit(results[-1]))
    return out if null_as_last else F.when(v.isNotNull(), out)


def bmi(weight_kg: Col, height_cm: Col) -> Column:
    metres = _c(height_cm) / 100
    return F.try_divide(_c(weight_kg), metres * metres)


def pulse_pressure(systolic: Col, diastolic: Col) -> Column:
    return _c(systolic) - _c(diastolic)


def mean_arterial_pressure(systolic: Col, diastolic: Col) -> Column:
    return _c(diastolic) + pulse_pressure(systolic, diastolic) / 3


def pressure_ratio(systolic: Col, diastolic: Col, offset: int = 1) -> Column:
    """Systolic over diastolic plus ``offset``; 0 gives the plain ratio."""
    return F.try_divide(_c(systolic), _c(diastolic) + offset)


def hypertension_stage(systolic: Col, diastolic: Col) -> Column:
    s, d = _c(systolic), _c(diastolic)
    return (
        F.when(s.isNull() | d.isNull(), "unknown")
        .when((s < 120) & (d < 80), "normal")
        .when((s < 130) & (d < 80), "elevated")
        .when((s < 140) | (d < 90), "stage1")
        .otherwise("stage2")
    )


def smoking_features(cigs_per_day: Col, age: Col) -> dict[str, Column]:
    """Intensity band, smoker flag and pack-years since age 18."""
    c, years = _c(cigs_per_day), F.greatest(F.lit(0), _c(age) - 18)
    return {
        "smoking_intensity": cut(c, SMOKING_BINS, SMOKING_LABELS),
        "is_smoker": F.coalesce((c > 0).cast("int"), F.lit(0)),
        "pack_years": F.when(c > 0, c / 20 * years).otherwise(F.lit(0.0)),
    }


def risk_factor_count(*flags: Col) -> Column:
    """Row sum; NULL flags add nothing."""
    return sum((F.coalesce(_c(f), F.lit(0)) for f in flags[1:]), F.coalesce(_c(flags[0]), F.lit(0)))


def composite_risk_score(age: Col, cholesterol: Col, systolic: Col) -> Column:
    return step(age, *AGE_SCORE) + step(cholesterol, *CHOLESTEROL_SCORE) + step(systolic, *PRESSURE_SCORE)


def metabolic_score(bmi_value: Col, glucose: Col, systolic: Col) -> Column:
    """How many of the three conditions hold."""
    conditions = (_c(bmi_value) >= 30, _c(glucose) >= 100, _c(systolic) >= 130)
    return sum((F.coalesce(c.cast("int"), F.lit(0)) for c in conditions[1:]),
               F.coalesce(conditions[0].cast("int"), F.lit(0)))


def risk_level(probability: Col) -> Column:
    return step(probability, *RISK_LEVEL)


def risk_contributions(
    age: Col, systolic: Col, smoking: Col, activity: Col, cholesterol: Col, glucose: Col
) -> dict[str, Column]:
    """Share of each risk area, 0 to 100."""

    def clamp(v: Column) -> Column:
        return F.least(F.lit(100), F.greatest(F.lit(0), v))

    return {
        "age_part": clamp((_c(age) - 30) * 2),
        "pressure_part": clamp((_c(systolic) - 120) * 2),
        "lifestyle_part": _c(smoking) * 30 + (1 - _c(activity)) * 20,
        "marker_part": (_c(cholesterol) - 1) * 25 + (_c(glucose) - 1) * 25,
    }


def polynomial_terms(columns: Sequence[str]) -> dict[str, Column]:
    """Squares and pairwise products, named ``poly_a^2`` and ``poly_a b``."""
    return {
        f"poly_{a}^2" if a == b else f"poly_{a} {b}": F.col(a) * F.col(b)
        for a, b in itertools.combinations_with_replacement(columns, 2)
    }
