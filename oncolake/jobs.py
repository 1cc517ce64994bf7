"""The jobs, from input files to report tables below one base folder.

    python -m oncolake.jobs catalog    BASE --metadata FILE --manifest FILE
    python -m oncolake.jobs clinical   BASE --root DIR [--under PART] [--on-error quarantine]
    python -m oncolake.jobs expression BASE --root DIR [--under PART] [--on-missing record]
    python -m oncolake.jobs genome     BASE --root DIR [--layout embl]
    python -m oncolake.jobs layout     BASE --buckets N
    python -m oncolake.jobs reports    BASE [--buckets N]

Every job reads what earlier jobs wrote and can be run again. An archive may come in batches: a
second catalog batch adds the patients that it lists first, and a clinical part changes the slices
of the patient table that its cases are in. Measures have summaries for each batch (`moments`),
from which the reports follow without another scan of them (`reports --from-moments`).
"""

from __future__ import annotations

import argparse
import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oncolake import schemas
from oncolake.operators import catalog, clinical, expression, genome, moments, patients
from oncolake.operators.cohort import gene_rows
from oncolake.operators.reports import save_reports, save_reports_of_means
from oncolake.plans.joins import fits_broadcast
from oncolake.session import build_session
from oncolake.sources import contents, files
from oncolake.sources.tables import load_bucketed, load_table, save_bucketed, save_table


def _lists(spark: SparkSession, base: str) -> DataFrame:
    schema = f"{schemas.FILE_LIST}, batch string, list_table string"
    return load_table(spark, f"{base}/lists", schema=schema).drop("batch")


_REPEATED = "case_id string, rows bigint"


def _refresh_patients(spark: SparkSession, base: str, named: list[int]) -> None:
    """The named slices of the patient table and of what is counted in it; then the counts of all
    slices as the tables that are read."""
    target = f"{base}/patient_info"
    patients.refresh(spark, f"{base}/new_patients", f"{base}/clinical", target, named)
    stored = load_table(spark, target, schema=f"{schemas.PATIENT_INFO}, slice int")
    counts, repeats = f"{base}/patient_counts", f"{base}/patient_repeats"
    for path, kinds, count in (
        (counts, schemas.PROJECT_SUMMARY, patients.slice_counts),
        (repeats, _REPEATED, patients.slice_repeats),
    ):
        patients.create(spark, path, kinds)
        if named:
            patients.save_slices(count(patients.some(stored, named)), path)
    every = load_table(spark, counts, schema=f"{schemas.PROJECT_SUMMARY}, slice int")
    save_table(patients.summary_of(every), f"{base}/project_summary", mode="overwrite")
    every = load_table(spark, repeats, schema=f"{_REPEATED}, slice int").drop("slice")
    save_table(every, f"{base}/repeated_cases", mode="overwrite")


def _list(spark: SparkSession, base: str, table: str) -> DataFrame:
    """One list table; only its partition is read."""
    lists = _lists(spark, base)
    return lists.filter(F.col("list_table") == table).drop("list_table")


def run_catalog(
    spark: SparkSession,
    base: str,
    metadata: str,
    manifest: str,
    multi_line: bool = True,
    each_case: bool = False,
    batch: str = "",
) -> None:
    """File lists of one batch, and the patients that it lists first. The join of both inputs
    runs once.

    To run a batch again replaces its lists and adds no patient twice; patients are never
    withdrawn. The slices of the patient table that the batch names follow.
    """
    index = catalog.build_index(
        files.read_manifest(spark, manifest),
        files.read_metadata(spark, metadata, multi_line),
        each_case,
    )
    own = f"{base}/lists/batch={_batch(batch)}"
    save_table(
        catalog.with_list_table(index), own, mode="overwrite", partition_by=["list_table"]
    )
    listed = load_table(spark, own, schema=f"{schemas.FILE_LIST}, list_table string")
    new = f"{base}/staged_patients/batch={_batch(batch)}"
    save_table(catalog.new_patients(listed), new, mode="overwrite")
    staged = load_table(spark, new, schema=schemas.PATIENT_INFO)
    named = patients.named_slices(staged)
    patients.append_patients(staged, f"{base}/new_patients", named)
    _refresh_patients(spark, base, named)


def _batch(under: str) -> str:
    return quote(under, safe="") or "everything"


def run_clinical(
    spark: SparkSession,
    base: str,
    root: str,
    on_error: str = "fail",
    under: str = "",
    glob: str = "*.xml",
) -> None:
    """Clinical records of the reports under one part of the archive, as one batch; the slices
    of the patient table that it names, with the records of all batches, and the summary.

    A listed report that is missing or malformed stops the job before any table but its own
    staged one is touched. With on_error='quarantine' both kinds are written to tables of their
    own, and the rest goes on. To run a part again replaces its batch; parts must not overlap.
    """
    batch = _batch(under)
    paths = catalog.under_part(catalog.file_paths(_list(spark, base, "xml_list")), under)
    parsed = clinical.parse_reports(files.read_documents(spark, root, glob, under))
    # The archive is read here and nowhere else: what is missing or malformed is told from it.
    staged = f"{base}/staged_reports/batch={batch}"
    save_table(clinical.listed_reports(parsed, paths), staged, mode="overwrite")
    listed = load_table(spark, staged)
    missing = catalog.missing_files(paths, listed)
    if on_error == "fail":
        catalog.require_none(missing)
    records = clinical.extract_clinical(listed, on_error)
    named = patients.save_records(records, f"{base}/clinical", batch)
    if on_error == "quarantine":
        save_table(missing, f"{base}/missing_reports/batch={batch}", mode="overwrite")
        malformed = clinical.malformed_reports(listed)
        save_table(malformed, f"{base}/malformed_reports/batch={batch}", mode="overwrite")
    _refresh_patients(spark, base, named)


def run_expression(
    spark: SparkSession,
    base: str,
    root: str,
    under: str = "",
    on_missing: str = "fail",
    glob: str = files.EXPRESSION_FILES,
    check_gzip: bool = False,
    by_content: bool = False,
) -> None:
    """Measures of the files under one part of the archive, as one batch of the table.

    Listed files that are not there are written to a table of their own; they stop the job
    before any other table is touched, or with on_missing='record' the rest goes on. To run a
    part again replaces its batch; parts must not overlap. `check_gzip` is for archives with
    damaged files; set `spark.sql.files.ignoreCorruptFiles` along with it. `by_content` is for
    archives whose names do not tell which files are packed.
    """
    if on_missing not in ("fail", "record"):
        raise ValueError(f"unknown on_missing: {on_missing}")
    if check_gzip and by_content:
        raise ValueError("damaged files can be left out only where names tell how files are packed")
    batch = _batch(under)
    listed = catalog.expression_files(catalog.file_paths(_list(spark, base, "txt_list")))
    # Only the list rows of the part: the smaller the part, the sooner its list can be copied.
    paths = catalog.under_part(listed, under)
    present = files.list_files(spark, root, glob, under)
    missing = f"{base}/missing_files/batch={batch}"
    save_table(catalog.missing_files(paths, present), missing, mode="overwrite")
    if on_missing == "fail":
        catalog.require_none(load_table(spark, missing))
    # The text is read once, into this table.
    staged = f"{base}/staged_lines/batch={batch}"
    read = contents.read_lines if by_content else files.read_lines
    lines = read(spark, root, glob, under)
    save_table(expression.stage_lines(lines), staged, mode="overwrite")
    stage = load_table(spark, staged)
    rejected = expression.rejected_files(stage)
    if check_gzip:
        damaged = files.damaged_gzip_files(spark, root, "*.gz", under)
        rejected = rejected.unionByName(damaged.withColumn("bad_lines", F.lit(None)))
    rejections = f"{base}/rejected_files/batch={batch}"
    save_table(rejected, rejections, mode="overwrite")
    rows = expression.ingest_expression(stage, paths, load_table(spark, rejections))
    save_table(
        expression.clustered(rows), f"{base}/gene_expr_table/batch={batch}", mode="overwrite"
    )
    # The cases of a batch and its run tell later whether its summary still holds.
    stored = load_table(spark, f"{base}/gene_expr_table/batch={batch}", schema=schemas.GENE_EXPR)
    none = spark.createDataFrame([(None,)], "case_id string")
    cases = stored.select("case_id").unionByName(none).distinct()
    save_table(
        cases.withColumn("run", F.lit(uuid.uuid4().hex)),
        f"{base}/measured_cases/batch={batch}",
        mode="overwrite",
    )


BY_CASE = {"schema": schemas.GENE_EXPR, "key": "case_id", "sort_by": "gene_id"}


def run_layout(spark: SparkSession, base: str, buckets: int) -> None:
    """All batches of measures once more, dealt to buckets by case.

    Reports then join them with a cohort of any size where they are. Worth it once the cohort is
    too large to be copied; below that, the batches clustered by gene serve as they are.
    """
    measures = load_table(spark, f"{base}/gene_expr_table", schema=schemas.GENE_EXPR)
    save_bucketed(
        measures.drop("batch"),
        "gene_expr_by_case",
        f"{base}/gene_expr_by_case",
        BY_CASE["key"],
        buckets,
        BY_CASE["sort_by"],
    )


def run_genome(
    spark: SparkSession,
    base: str,
    root: str,
    layout: str = "genbank",
    glob: str = files.GENOME_FILES,
) -> None:
    """The gene reference, and the genes that were left out or occur twice."""
    records = contents.read_genome_records(spark, root, layout, glob)
    save_table(genome.parse_genes(records), f"{base}/parsed_genes", mode="overwrite")
    parsed = load_table(spark, f"{base}/parsed_genes")
    save_table(genome.gene_reference(parsed), f"{base}/hs_genome", mode="overwrite")
    save_table(genome.rejected_genes(parsed), f"{base}/rejected_genes", mode="overwrite")
    save_table(genome.repeated_genes(parsed), f"{base}/repeated_genes", mode="overwrite")


def run_moments(spark: SparkSession, base: str) -> None:
    """Summaries of the measures for each batch, disease and gene.

    A batch is summed up when it is new, or when its cases have come to other arms since; the
    measures of other batches are not read.
    """
    measures, cases, known = (
        load_table(spark, f"{base}/{name}", schema=schema)
        for name, schema in (
            ("gene_expr_table", f"{schemas.GENE_EXPR}, batch string"),
            ("measured_cases", "case_id string, run string, batch string"),
            ("patient_info", schemas.PATIENT_INFO),
        )
    )
    moments.update(spark, measures, cases, known, f"{base}/moments", f"{base}/moment_members")


def run_reports(
    spark: SparkSession, base: str, buckets: int = 0, from_moments: bool = False
) -> None:
    """All report tables; with `buckets`, from the measures that `run_layout` dealt to as many;
    `from_moments`, from what `run_moments` has summed up, with the test of the difference."""
    genome_table = load_table(spark, f"{base}/hs_genome")
    if from_moments:
        merged = moments.merge(moments.load(spark, f"{base}/moments"))
        save_table(merged, f"{base}/merged_moments", mode="overwrite")
        merged = load_table(spark, f"{base}/merged_moments")
        small = fits_broadcast(gene_rows(genome_table))
        save_reports_of_means(moments.means(merged), genome_table, base, small)
        save_table(
            moments.difference(merged),
            f"{base}/expression_difference",
            mode="overwrite",
            partition_by=["disease_type"],
        )
        return
    if buckets:
        measures = load_bucketed(
            spark,
            "gene_expr_by_case",
            f"{base}/gene_expr_by_case",
            buckets=buckets,
            **BY_CASE,
        )
    else:
        measures = load_table(spark, f"{base}/gene_expr_table", schema=schemas.GENE_EXPR)
        measures = measures.drop("batch")
    save_reports(measures, load_table(spark, f"{base}/patient_info"), genome_table, base)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="oncolake.jobs")
    jobs = parser.add_subparsers(dest="job", required=True)
    arguments = {
        "catalog": ["--metadata", "--manifest"],
        "clinical": ["--root"],
        "expression": ["--root"],
        "genome": ["--root"],
        "layout": [],
        "moments": [],
        "reports": [],
    }
    for name, required in arguments.items():
        job = jobs.add_parser(name)
        job.add_argument("base")
        for option in required:
            job.add_argument(option, required=True)
    jobs.choices["catalog"].add_argument("--json-lines", dest="multi_line", action="store_false")
    jobs.choices["catalog"].add_argument("--each-case", action="store_true")
    jobs.choices["catalog"].add_argument("--batch", default="")
    jobs.choices["clinical"].add_argument(
        "--on-error", choices=["fail", "quarantine"], default="fail"
    )
    for name in ("clinical", "expression"):
        jobs.choices[name].add_argument("--under", default="")
    jobs.choices["expression"].add_argument(
        "--on-missing", choices=["fail", "record"], default="fail"
    )
    jobs.choices["layout"].add_argument("--buckets", type=int, required=True)
    jobs.choices["reports"].add_argument("--buckets", type=int, default=0)
    jobs.choices["reports"].add_argument("--from-moments", action="store_true")
    jobs.choices["expression"].add_argument("--check-gzip", action="store_true")
    jobs.choices["expression"].add_argument("--by-content", action="store_true")
    jobs.choices["genome"].add_argument(
        "--layout", choices=sorted(files.GENE_LINE), default="genbank"
    )
    options = vars(parser.parse_args(argv))
    run = {
        "catalog": run_catalog,
        "clinical": run_clinical,
        "expression": run_expression,
        "genome": run_genome,
        "layout": run_layout,
        "moments": run_moments,
        "reports": run_reports,
    }[options.pop("job")]
    run(build_session(f"oncolake-{run.__name__}"), **options)


if __name__ == "__main__":
    main()
