"""Clinical enrichment: report fields per case, and the keyed update of the patient table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oncolake.functions.reports import CLINICAL_FIELDS, WELL_FORMED, report_fields
from oncolake.plans.joins import lookup_join

CLINICAL = tuple(f.column for f in CLINICAL_FIELDS)


def parse_reports(documents: DataFrame) -> DataFrame:
    """(filepath, well_formed, a column per field) of report texts (filepath, value).

    Each text is parsed once, where it is read: only the few short fields go on.
    """
    parsed = documents.select("filepath", report_fields(F.col("value")).alias("_report"))
    return parsed.select("filepath", "_report.*")


def listed_reports(
    parsed: DataFrame, paths: DataFrame, broadcast: bool | None = None
) -> DataFrame:
    """Parsed reports of listed files, with their case id."""
    return lookup_join(parsed, paths, ["filepath"], broadcast=broadcast)


def malformed_reports(listed: DataFrame) -> DataFrame:
    """Listed reports that are no XML document."""
    return listed.filter(~F.col(WELL_FORMED)).select("case_id", "filepath")


def extract_clinical(listed: DataFrame, on_error: str = "fail") -> DataFrame:
    """(case_id, filepath, disease_stage, disease_type, gender) of each listed report.

    A report that is no XML fails the job, or with on_error='quarantine' is left out; it is
    then found in `malformed_reports`.
    """
    if on_error not in ("fail", "quarantine"):
        raise ValueError(f"unknown on_error: {on_error}")
    if on_error == "quarantine":
        good = listed.filter(WELL_FORMED)
        return good.select("case_id", "filepath", *CLINICAL)
    broken = F.raise_error(F.concat(F.lit("no XML document: "), F.col("filepath")))
    checked = F.when(F.col(WELL_FORMED), F.col("filepath")).otherwise(broken)
    return listed.select("case_id", checked.alias("filepath"), *CLINICAL)


def _element(path: str) -> Column:
    return F.col(".".join(f"`{name}`" for name in path.split("/")))._VALUE


# Elements of a patient as the reports name them, by column.
PATIENT_ELEMENTS = {
    "disease_stage": "shared_stage:stage_event/shared_stage:pathologic_stage",
    "disease_type": "clin_shared:tumor_tissue_site",
    "gender": "shared:gender",
}


def patient_schema() -> str:
    """The nested columns that `clinical_from_elements` needs, as a schema to read them with."""
    columns = []
    for path in PATIENT_ELEMENTS.values():
        kind = "struct<_VALUE: string>"
        first, *inner = path.split("/")
        for name in reversed(inner):
            kind = f"struct<`{name}`: {kind}>"
        columns.append(f"`{first}` {kind}")
    return ", ".join(columns)


def clinical_from_elements(rows: DataFrame) -> DataFrame:
    """The same fields from patient elements read as nested rows (filepath, patient columns)."""
    return rows.select(
        "filepath", *(_element(path).alias(c) for c, path in PATIENT_ELEMENTS.items())
    )


def latest_per_case(clinical: DataFrame) -> DataFrame:
    """One record per case: that of the largest path. Fields that are null stay null."""
    return (
        clinical.groupBy("case_id")
        .agg(F.max_by(F.struct(*CLINICAL), "filepath").alias("_record"))
        .select("case_id", "_record.*")
    )


def update_patients(patients: DataFrame, clinical: DataFrame) -> DataFrame:
    """Patients with the clinical fields of their latest record.

    A record overwrites all three fields, also with null; patients without one keep theirs,
    and records of unknown cases add nothing. The result is a new version of the table, to be
    written next to the old one. Both sides have a row per case, so neither is a lookup: they
    are joined as they are, and adaptive execution copies one that turns out small.
    """
    records = latest_per_case(clinical).select(
        "case_id",
        F.lit(True).alias("_matched"),
        *(F.col(c).alias(f"_new_{c}") for c in CLINICAL),
    )
    updated = lookup_join(patients, records, ["case_id"], "left", broadcast=False)
    return updated.select(
        *(
            F.when(F.col("_matched"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
            if c in CLINICAL
            else F.col(c)
            for c in patients.columns
        )
    )
