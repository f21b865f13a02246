"""Value-level clinical arithmetic: bands, unit conversion, imputation."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Bands:
    """Cut points with one label per band; ``closed[i]`` says which band contains cut i.

    ``"left"``: the band above the cut (v >= cut); ``"right"``: the band below it.
    """

    cuts: tuple[float, ...]
    labels: tuple[int, ...]
    closed: tuple[str, ...]

    def __post_init__(self):
        if len(self.labels) != len(self.cuts) + 1 or len(self.closed) != len(self.cuts):
            raise ValueError("need one label per band and one closed side per cut")

    @staticmethod
    def of(cuts, labels, closed: str | tuple[str, ...] = "left", scale: float = 1.0) -> Bands:
        sides = (closed,) * len(cuts) if isinstance(closed, str) else tuple(closed)
        return Bands(tuple(c * scale for c in cuts), tuple(labels), sides)

    def label(self, value: str) -> Column:
        """Label of a value, given as SQL text; null and NaN stay null."""
        return F.expr(self.label_sql(value))

    def label_sql(self, value: str) -> str:
        below = " ".join(
            f"WHEN {value} {'<' if side == 'left' else '<='} {float(cut)!r}D THEN {label}"
            for cut, side, label in zip(self.cuts, self.closed, self.labels)
        )
        return (
            f"CASE WHEN {value} IS NULL OR isnan(CAST({value} AS DOUBLE)) THEN NULL "
            f"{below} ELSE {self.labels[-1]} END"
        )


def relative_change(value: Column, base: Column) -> Column:
    """(value - base) / base; null for a zero or missing base."""
    return F.try_divide(value - base, base)


def row_max(*cols: Column, missing: str = "skip") -> Column:
    """Row-wise maximum; ``missing`` is "skip" (ignore nulls) or "propagate" (any null wins)."""
    if missing == "skip":
        return F.greatest(*cols)
    if missing != "propagate":
        raise ValueError("missing must be 'skip' or 'propagate'")
    any_null = reduce(lambda a, b: a | b, [c.isNull() for c in cols])
    return F.when(~any_null, F.greatest(*cols))


# Conversion factors.
CREATININE_UMOL_PER_MG_DL = 88.42
HB_MMOL_PER_G_DL = 0.6206
KG_PER_LB = 0.45359237
KG_PER_OZ = 0.0283495231
KG_PER_OUNCE_ROUNDED = 0.0283495

# Weight in kg assumed by sex, and otherwise.
WEIGHT_MALE = 80.0
WEIGHT_FEMALE = 65.0
WEIGHT_OTHER = 72.5


def normalise_by_unit_text(value: Column, unit: Column, measure: str, scaled_counts: str) -> Column:
    """Bring a measurement to mg/dL, g/dL, K/uL or mL by its written unit.

    ``scaled_counts`` is the pattern of "/ul" units that already carry a power of ten.
    """
    u = F.lower(F.trim(F.coalesce(unit.cast("string"), F.lit(""))))
    if measure == "creatinine":
        return (
            F.when(u.contains("umol"), value / CREATININE_UMOL_PER_MG_DL)
            .when(u.contains("mg/l"), value / 10.0)
            .otherwise(value)
        )
    if measure in ("platelets", "wbc"):
        per_cell = u.contains("cell") | (u.contains("/ul") & ~u.rlike(scaled_counts))
        return F.when(per_cell, value / 1000.0).otherwise(value)
    if measure == "hb":
        return (
            F.when(u.contains("mmol"), value / HB_MMOL_PER_G_DL)
            .when(u.contains("g/l"), value / 10.0)
            .otherwise(value)
        )
    if measure == "urine":
        return F.when(u.contains("l") & ~u.contains("ml"), value * 1000.0).otherwise(value)
    return value


def normalise_by_unit_id(value: Column, unit: Column, divisors: dict[int, float]) -> Column:
    """Divide by unit id; a unit that is not listed gives null, so the row can be dropped."""
    chain = None
    for unit_id, divisor in divisors.items():
        scaled = value if divisor == 1 else value / divisor
        chain = F.when(unit == unit_id, scaled) if chain is None else chain.when(unit == unit_id, scaled)
    return chain if chain is not None else value


def mass_in_kg(value: Column, unit: Column, factors: dict) -> Column:
    """Mass in kg; units that are not listed are taken as kg."""
    chain = None
    for name, factor in factors.items():
        hit = unit == name
        chain = F.when(hit, value * factor) if chain is None else chain.when(hit, value * factor)
    return value if chain is None else chain.otherwise(value)


def impute_weight(weight: Column, is_male: Column, is_female: Column, positive: bool = True) -> Column:
    """Weight by sex where missing; non-positive weights get the general default."""
    filled = F.coalesce(
        weight,
        F.when(is_male, F.lit(WEIGHT_MALE)),
        F.when(is_female, F.lit(WEIGHT_FEMALE)),
        F.lit(WEIGHT_OTHER),
    )
    return F.when(filled <= 0, F.lit(WEIGHT_OTHER)).otherwise(filled) if positive else filled
