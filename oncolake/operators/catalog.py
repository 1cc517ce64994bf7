"""File catalog: which file belongs to which patient, and which table lists it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oncolake.functions.text import file_path, folder_pattern, glue
from oncolake.plans.joins import lookup_join

# The table that lists the files of each format, the table of all others, the
# format that is left out, and the mark of a normalised expression file.
FORMAT_TABLES = {"BCR XML": "xml_list", "TXT": "txt_list"}
OTHER_TABLE = "unknowns"
EXCLUDED_FORMAT = "XLSX"
EXPRESSION_MARK = "-UQ.txt"


def without_excluded(metadata: DataFrame) -> DataFrame:
    """Drop the excluded format. A file of unknown format fails the comparison as well."""
    return metadata.filter(F.col("data_format") != EXCLUDED_FORMAT)


def build_index(manifest: DataFrame, metadata: DataFrame, each_case: bool = False) -> DataFrame:
    """One row per file known to both inputs, joined on file name.

    `metadata` holds nested cases; the ids of several cases in one file are glued together, and
    are then no patient's id. With `each_case` such a file has a row for every case instead,
    with that case's ids. A file without cases has empty ids either way.
    Both sides grow with the archive, so neither is broadcast by hint. A file name that many
    rows share makes a hot partition, which adaptive execution cuts on either side.
    """
    known = without_excluded(metadata)
    if each_case:
        known = known.select("file_name", "data_format", F.explode_outer("cases").alias("case"))
        project, case = F.array("case.project.project_id"), F.array("case.case_id")
    else:
        project, case = F.col("cases.project.project_id"), F.col("cases.case_id")
    known = known.select(
        "file_name",
        "data_format",
        glue(project).alias("project_id"),
        glue(case).alias("case_id"),
    )
    return manifest.join(known, F.col("filename") == F.col("file_name"), "inner").select(
        "path", "filename", "data_format", "project_id", "case_id"
    )


def list_table(data_format: Column) -> Column:
    """Name of the table that lists files of a format."""
    table = F.lit(OTHER_TABLE)
    for name, target in FORMAT_TABLES.items():
        table = F.when(data_format == name, F.lit(target)).otherwise(table)
    return table


def route(index: DataFrame, table: str) -> DataFrame:
    """Index rows that belong into one list table."""
    data_format = F.col("data_format")
    if table == OTHER_TABLE:
        return index.filter(~data_format.isin(*FORMAT_TABLES))
    formats = [name for name, target in FORMAT_TABLES.items() if target == table]
    if not formats:
        raise ValueError(f"no format is listed in table {table}")
    return index.filter(data_format.isin(*formats))


def with_list_table(index: DataFrame) -> DataFrame:
    """Add the list table of each row, to write all lists in one partitioned job."""
    return index.withColumn("list_table", list_table(F.col("data_format")))


def distinct_patients(index: DataFrame) -> DataFrame:
    return index.select("case_id", "project_id").distinct()


def new_patients(index: DataFrame) -> DataFrame:
    """Distinct patients as rows of the patient table, clinical fields still unknown."""
    unknown = F.lit(None).cast("string")
    return distinct_patients(index).select(
        "case_id",
        "project_id",
        unknown.alias("disease_type"),
        unknown.alias("disease_stage"),
        unknown.alias("gender"),
    )


def repeated_cases(patients: DataFrame) -> DataFrame:
    """Cases with more than one patient row: the check that a unique key would make."""
    return (
        patients.groupBy("case_id")
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter(F.col("rows") > 1)
    )


def file_paths(files: DataFrame) -> DataFrame:
    """(case_id, filepath) of a list table."""
    return files.select("case_id", file_path(F.col("path"), F.col("filename")).alias("filepath"))


def under_part(paths: DataFrame, under: str) -> DataFrame:
    """Listed files in the folders that a file pattern names; all if it is empty.

    A row without a path belongs to no part, and is kept when there are no parts.
    """
    return paths.filter(F.col("filepath").rlike(folder_pattern(under))) if under else paths


def expression_files(paths: DataFrame) -> DataFrame:
    """Listed files whose path carries the mark of a normalised expression file."""
    return paths.filter(F.col("filepath").contains(EXPRESSION_MARK))


def missing_files(paths: DataFrame, present: DataFrame) -> DataFrame:
    """Listed files that are not among the `filepath`s present.

    Both sides have a row per file: they are joined as they are.
    """
    stored = present.select("filepath").distinct()
    return lookup_join(paths, stored, ["filepath"], "left_anti", broadcast=False)


def require_none(missing: DataFrame) -> None:
    """Stop a job whose listed files are not all there. Ten of them are named."""
    named = [r.filepath or "a row without a path" for r in missing.limit(10).collect()]
    if named:
        raise FileNotFoundError("listed but missing: " + ", ".join(named))


def require_files(paths: DataFrame, present: DataFrame) -> None:
    """Stop a job whose listed files are not all there. Files without content are not."""
    require_none(missing_files(paths, present))


def first_files(paths: DataFrame, n: int = 100) -> DataFrame:
    """A trial run's share of the list: the first n files by path."""
    return paths.orderBy("filepath", "case_id").limit(n)
