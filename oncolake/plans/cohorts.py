"""Which patients form the early and the late arm of a disease."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Arm:
    """Patients of one arm: a list of stages, or a pattern found anywhere in the stage."""

    stages: tuple[str, ...] = ()
    pattern: str | None = None

    def holds(self, stage: Column) -> Column:
        if self.pattern is not None:
            return stage.rlike(self.pattern)
        return stage.isin(*self.stages)

    @property
    def is_empty(self) -> bool:
        return self.pattern is None and not self.stages


@dataclass(frozen=True)
class CohortSpec:
    """One disease with its two arms and the ratios beyond which a gene counts as changed."""

    disease: str
    early: Arm = Arm()
    late: Arm = Arm()
    high: float = 2.0
    low: float = 0.5

    @property
    def is_placeholder(self) -> bool:
        return self.early.is_empty or self.late.is_empty


def stages(*names: str) -> Arm:
    return Arm(tuple(f"Stage {name}" for name in names))


def like(pattern: str) -> Arm:
    return Arm(pattern=pattern)


# Diseases, stages and thresholds of the reports. Both Colon arms are
# unanchored patterns, so its early arm holds the patients of its late arm as well.
COHORTS = (
    CohortSpec("Bladder", stages("II"), stages("III")),
    CohortSpec("Breast", stages("I", "IA", "IB"), stages("II", "IIA", "IIB")),
    CohortSpec("Colon", like("Stage II"), like("Stage III")),
    CohortSpec("Esophagus", stages("IIA"), stages("IIB")),
    CohortSpec("Extremities"),
    CohortSpec("Head and Neck", stages("II"), stages("III")),
    CohortSpec("Kidney", stages("II"), stages("III")),
    CohortSpec("Liver", stages("I"), stages("II")),
    CohortSpec("Lung", stages("IA"), stages("IB")),
    CohortSpec("Other  Specify"),
    CohortSpec("Pancreas", stages("IIA"), stages("IIB")),
    CohortSpec("Rectum"),
    CohortSpec("Stomach", stages("IIIA"), stages("IIIB"), high=3.0),
    CohortSpec("Thyroid", stages("II"), stages("III")),
    CohortSpec("Trunk"),
)


def _any(conditions: Iterable[Column]) -> Column:
    return reduce(or_, conditions, F.lit(False))


def arm_patients(patients: DataFrame, disease: str, arm: Arm) -> DataFrame:
    """Case ids of one arm of one disease."""
    return patients.filter(
        (F.col("disease_type") == disease) & arm.holds(F.col("disease_stage"))
    ).select("case_id")


def arm_rows(patients: DataFrame, specs: Iterable[CohortSpec]) -> DataFrame:
    """(case_id, disease_type, early, late) of every patient row that is in an arm."""
    specs = [s for s in specs if not s.is_placeholder]
    disease, stage = F.col("disease_type"), F.col("disease_stage")
    early = _any((disease == s.disease) & s.early.holds(stage) for s in specs)
    late = _any((disease == s.disease) & s.late.holds(stage) for s in specs)
    return patients.filter(disease.isin(*[s.disease for s in specs]) & (early | late)).select(
        "case_id", "disease_type", early.alias("early"), late.alias("late")
    )


def cohort_members(patients: DataFrame, specs: Iterable[CohortSpec]) -> DataFrame:
    """(case_id, disease_type, early, late), one row per case and disease with an arm.

    A case may be in both arms. Repeated patient rows fold into one, so that joining the
    measures with this table keeps the counts of an IN test.
    """
    return (
        arm_rows(patients, specs)
        .groupBy("case_id", "disease_type")
        .agg(F.bool_or("early").alias("early"), F.bool_or("late").alias("late"))
    )


def is_changed(specs: Iterable[CohortSpec], disease: Column, ratio: Column) -> Column:
    """Whether a ratio lies outside the thresholds of its disease."""
    return _any(
        (disease == s.disease) & ((ratio > s.high) | (ratio < s.low)) for s in specs
    )
