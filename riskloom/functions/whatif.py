"""What-if perturbations: shift a whole table the way live data may shift."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.constants import ADMISSION_TYPES
from riskloom.functions.expressions import hash_uniform, round_half_up

logger = logging.getLogger(__name__)

# fixed values: size of each perturbation
AGE_SHIFT = 10
SCALE_FACTOR = 1.3
PULSE_FACTOR, PRESSURE_FACTOR, SATURATION_DROP = 1.15, 1.1, 3
ADMISSION_SHARES = [0.7, 0.2, 0.1]


def draw_category(keys: list, values: list[str], shares: list[float]) -> Column:
    """A category drawn by a repeatable uniform against cumulative shares."""
    draw, chain, edge = hash_uniform(keys), F, 0.0
    for value, share in zip(values[:-1], shares[:-1]):
        edge += share
        chain = chain.when(draw < F.lit(edge), F.lit(value))
    return chain.otherwise(F.lit(values[-1]))


def _scaled_int(name: str, factor: float, ceiling: int) -> Column:
    product = F.floor(F.col(name).cast("double") * F.lit(factor)).cast("int")
    return F.when(F.col(name).isNotNull(), F.least(F.lit(ceiling), product))


def _changes(kind: str, id_col: str) -> dict[str, Column] | None:
    if kind == "age_shift":
        return {"age": F.when(F.col("age").isNotNull(), F.least(F.col("age") + AGE_SHIFT, F.lit(100)))}
    if kind == "vital_degradation":
        spo2 = F.col("oxygen_saturation")
        return {
            "heart_rate": _scaled_int("heart_rate", PULSE_FACTOR, 180),
            "systolic_bp": _scaled_int("systolic_bp", PRESSURE_FACTOR, 220),
            "oxygen_saturation": F.when(
                spo2.isNotNull(), F.greatest(spo2 - F.lit(float(SATURATION_DROP)), F.lit(70.0))
            ),
        }
    if kind == "feature_scale":
        return {
            "glucose_level": round_half_up(F.col("glucose_level") * F.lit(SCALE_FACTOR), 1),
            "creatinine": round_half_up(F.col("creatinine") * F.lit(SCALE_FACTOR), 2),
        }
    if kind == "distribution_shift":
        return {"admission_type": draw_category([id_col], ADMISSION_TYPES, ADMISSION_SHARES)}
    return None


def perturb(df: DataFrame, kind: str, when: Column | None = None, id_col: str = "encounter_id") -> DataFrame:
    """Apply one perturbation to all rows, or to those where ``when`` is true.

    An unknown kind leaves the rows as they are and logs a warning.
    """
    changes = _changes(kind, id_col)
    if changes is None:
        logger.warning("unknown perturbation %r: rows left unchanged", kind)
        return df
    if when is not None:
        changes = {n: F.when(when, c).otherwise(F.col(n)) for n, c in changes.items()}
    return df.withColumns(changes)
