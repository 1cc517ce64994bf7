"""One query per operator, over the given tables. Each takes (spark, sf_dir)."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oncolake import schemas
from oncolake.functions import text
from oncolake.operators import catalog, clinical, cohort, genome, moments, patients, serving
from oncolake.operators import expression as ingest
from oncolake.operators.reports import save_ranked, save_reports, stored_top
from oncolake.plans.cohorts import CohortSpec, arm_rows, like, stages
from oncolake.plans.joins import fit_broadcast
from oncolake.sources import contents, files, tables
from workload import standins as s

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RANKED = "BUILDING"
STAGED = "filepath string, gene_id string, gene_expr double, bad boolean"
# Prefixes of the patient elements, declared for the files that are written with them.
_PREFIXES = {"brca", *re.findall(r"(\w+):", " ".join(clinical.PATIENT_ELEMENTS.values()))}
# Some 350 bytes each.
ELEMENTS_PER_FILE = 100_000
PATIENT_NAMESPACES = " ".join(f'xmlns:{p}="urn:{p}"' for p in sorted(_PREFIXES))


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _means(
    spark: SparkSession, sf: str, specs=s.SPECS, broadcast: bool | None = None
) -> DataFrame:
    return cohort.stage_means(s.expression(spark, sf), s.patients(spark, sf), specs, broadcast)


def _lookups(spark: SparkSession, sf: str, specs=s.SPECS) -> list[bool]:
    """Whether the cohort and the gene reference can be copied, measured together."""
    members = arm_rows(s.patients(spark, sf), specs)
    return fit_broadcast(members, cohort.gene_rows(s.genome(spark, sf)))


def _index(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.build_index(s.manifest(spark, sf), s.metadata(spark, sf))


# --- cohort reports ---------------------------------------------------------------------


@query
def fold_change_ranked(spark, sf):
    return cohort.fold_change_ranked(
        s.expression(spark, sf), s.patients(spark, sf), s.genome(spark, sf), s.spec_of(RANKED)
    )


@query
def fold_change_all(spark, sf):
    few, small = _lookups(spark, sf)
    return cohort.fold_change(_means(spark, sf, broadcast=few), s.genome(spark, sf), small)


@query
def fold_change_placeholder(spark, sf):
    """A disease that is in the data, but has no stages to compare, gives no rows."""
    specs = [CohortSpec("MACHINERY"), s.spec_of("FURNITURE")]
    return cohort.fold_change(_means(spark, sf, specs), s.genome(spark, sf))


@query
def expression_changed(spark, sf):
    few, small = _lookups(spark, sf)
    means = _means(spark, sf, broadcast=few)
    return cohort.expression_changed(means, s.genome(spark, sf), s.SPECS, small)


@query
def expression_scatter(spark, sf):
    return cohort.expression_scatter(expression_changed(spark, sf))


@query
def cohort_mean(spark, sf):
    early = s.spec_of(RANKED).early
    return cohort.cohort_mean(s.expression(spark, sf), s.patients(spark, sf), RANKED, early)


@query
def cohort_semi_join(spark, sf):
    cases = cohort.arm_patients(s.patients(spark, sf), RANKED, s.spec_of(RANKED).late)
    return cohort.lookup_join(s.expression(spark, sf), cases, ["case_id"], "left_semi")


@query
def cohort_in_list(spark, sf):
    arm = stages("I", "IA", "IB")
    return cohort.arm_patients(s.patients(spark, sf), RANKED, arm)


@query
def cohort_regex(spark, sf):
    return cohort.arm_patients(s.patients(spark, sf), "AUTOMOBILE", like("Stage II"))


@query
def gene_reference_left_join(spark, sf):
    genes = s.table(spark, sf, "part").select(F.col("p_partkey").alias("gene_id"))
    return cohort.with_reference(genes, s.genome(spark, sf))


@query
def gene_annotation(spark, sf):
    return cohort.with_label(gene_reference_left_join(spark, sf)).select("gene_id", "annotation")


@query
def top_increased(spark, sf):
    means = _means(spark, sf, [s.spec_of(RANKED)])
    return cohort.top_changed(means, s.genome(spark, sf))


@query
def top_decreased(spark, sf):
    means = _means(spark, sf, [s.spec_of(RANKED)])
    return cohort.top_changed(means, s.genome(spark, sf), increased=False)


@query
def top_increased_all(spark, sf):
    return cohort.top_changed(_means(spark, sf), s.genome(spark, sf))


@query
def top_decreased_all(spark, sf):
    return cohort.top_changed(_means(spark, sf), s.genome(spark, sf), increased=False)


@query
def reports_stored(spark, sf):
    """All report tables written, then the most increased genes read from one partition."""
    base = tables.scratch_path(spark, "reports")
    save_reports(
        s.expression(spark, sf), s.patients(spark, sf), s.genome(spark, sf), base, s.SPECS
    )
    stored = tables.load_table(spark, f"{base}/fold_change_ranked")
    return cohort.top_of_one(stored.filter(F.col("disease_type") == RANKED))


@query
def reports_both_ends(spark, sf):
    """The most increased and the most decreased genes of a disease, each from the file at that end
    of its stored ranking."""
    base = tables.scratch_path(spark, "ranked")
    means = _means(spark, sf, s.SPECS)
    save_ranked(cohort.fold_change(means, s.genome(spark, sf)), base, rows_per_file=100)
    first, last = (stored_top(spark, base, RANKED, increased=up) for up in (True, False))
    return first.withColumn("end", F.lit("first")).unionByName(last.withColumn("end", F.lit("last")))


# --- patients, summaries and menus --------------------------------------------------------


@query
def project_summary(spark, sf):
    return serving.project_summary(s.patients(spark, sf))


@query
def stage_counts(spark, sf):
    return serving.stage_counts(s.patients(spark, sf), RANKED)


@query
def gender_counts(spark, sf):
    return serving.gender_counts(s.patients(spark, sf), RANKED)


@query
def disease_list(spark, sf):
    return serving.disease_list(project_summary(spark, sf))


@query
def disease_menu(spark, sf):
    return serving.disease_menu(project_summary(spark, sf))


@query
def disease_slug(spark, sf):
    name = F.concat_ws(" ", "disease_type", F.lit("and"), "disease_stage")
    return s.patients(spark, sf).select("case_id", text.compact_name(name).alias("slug"))


@query
def stage_eligibility(spark, sf):
    return serving.stage_eligibility(s.patients(spark, sf))


@query
def analysis_menu(spark, sf):
    menu = serving.analysis_menu(s.patients(spark, sf), variant_diseases=[RANKED])
    return menu.select("disease_type", F.to_json("analyses").alias("analyses"))


@query
def patients_by_disease(spark, sf):
    return serving.select_patients(s.patients(spark, sf), disease=RANKED)


@query
def patients_by_stage(spark, sf):
    return serving.select_patients(s.patients(spark, sf), stage="Stage I")


@query
def patients_by_disease_stage(spark, sf):
    return serving.select_patients(s.patients(spark, sf), RANKED, "Stage I")


@query
def patients_json(spark, sf):
    return serving.as_json(s.patients(spark, sf))


# --- file catalog ---------------------------------------------------------------------------


@query
def src_json_nested(spark, sf):
    events = s.table(spark, sf, "events")
    return events.select("event_id", F.from_json("props", "k bigint").k.alias("k"))


@query
def nested_ids_concat(spark, sf):
    """Two nested cases per line; every seventh line has none."""

    def case(case_id, project_id):
        project = F.struct(F.col(project_id).alias("project_id"))
        return F.struct(F.col(case_id).cast("string").alias("case_id"), project.alias("project"))

    cases = F.array(case("l_partkey", "l_returnflag"), case("l_suppkey", "l_linestatus"))
    nested = s.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") != 7, cases).alias("cases")
    )
    return nested.select(
        "l_orderkey",
        "l_linenumber",
        text.glue(F.col("cases.case_id")).alias("case_id"),
        text.glue(F.col("cases.project.project_id")).alias("project_id"),
    )


@query
def catalog_not_xlsx(spark, sf):
    return catalog.without_excluded(s.metadata(spark, sf)).select("file_name", "data_format")


@query
def catalog_join(spark, sf):
    return _index(spark, sf)


@query
def catalog_files(spark, sf):
    """The catalog from its own inputs: nested JSON and a tab-separated manifest."""
    base = tables.scratch_path(spark, "catalog")
    tables.save_table(s.metadata(spark, sf), f"{base}/metadata", "json")
    listed = s.manifest(spark, sf).select(
        F.col("path").alias("id"), "filename", F.lit('"0"').alias("md5"), F.lit("1").alias("size")
    )
    tables.save_table(listed, f"{base}/manifest", "csv", sep="\t", header="true", quote="")
    index = catalog.build_index(
        files.read_manifest(spark, f"{base}/manifest"),
        files.read_metadata(spark, f"{base}/metadata", multi_line=False),
    )
    lists = f"{base}/lists"
    tables.save_table(catalog.with_list_table(index), lists, partition_by=["list_table"])
    return tables.load_table(spark, lists)


@query
def catalog_files_multi_line(spark, sf):
    """The catalog from metadata in files of one array each, spread over several lines."""
    base = tables.scratch_path(spark, "catalog-arrays")
    block = F.floor(F.regexp_extract("file_name", "f([0-9]+)", 1).cast("bigint") / 4096)
    arrays = (
        s.metadata(spark, sf)
        .groupBy(block.alias("block"))
        .agg(F.collect_list(F.struct("file_name", "data_format", "cases")).alias("files"))
        .select("block", F.to_json("files", {"pretty": "true"}).alias("value"))
    )
    tables.save_table(arrays, base, "text", partition_by=["block"])
    # The files have about a megabyte each, so they are cut more finely than large ones.
    entries = files.read_metadata(spark, base, cut_bytes=256 * 1024)
    return catalog.build_index(s.manifest(spark, sf), entries)


@query
def catalog_each_case(spark, sf):
    """Files of two cases, here a customer and the next one, with a row for each."""
    metadata = s.metadata(spark, sf)
    case = F.col("cases")[0]
    other = F.struct(
        (case.case_id.cast("bigint") + 1).cast("string").alias("case_id"),
        case.project.alias("project"),
    )
    two = metadata.withColumn("cases", F.array(case, other))
    return catalog.build_index(s.manifest(spark, sf), two, each_case=True)


@query
def catalog_route_xml(spark, sf):
    return catalog.route(_index(spark, sf), "xml_list")


@query
def catalog_route_txt(spark, sf):
    return catalog.route(_index(spark, sf), "txt_list")


@query
def catalog_unknown(spark, sf):
    return catalog.route(_index(spark, sf), "unknowns")


@query
def patients_distinct(spark, sf):
    return catalog.distinct_patients(_index(spark, sf))


@query
def repeated_cases(spark, sf):
    """Cases whose files name several projects: here, customers with orders of two statuses."""
    orders = s.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("case_id"), F.col("o_orderstatus").alias("project_id")
    )
    return catalog.repeated_cases(catalog.distinct_patients(orders))


@query
def empty_table_schema(spark, sf):
    """The patient table created empty from its declared schema, then appended to."""
    path = tables.scratch_path(spark, "patients")
    tables.create_table(spark, "patient_info", path)
    tables.save_table(catalog.new_patients(_index(spark, sf)), path, mode="append")
    return tables.load_table(spark, path)


@query
def file_list_paths(spark, sf):
    return catalog.file_paths(_index(spark, sf))


@query
def filter_contains(spark, sf):
    return catalog.expression_files(catalog.file_paths(_index(spark, sf)))


@query
def missing_files_anti(spark, sf):
    listed = catalog.file_paths(_index(spark, sf))
    stored = s.table(spark, sf, "orders").filter(F.col("o_orderpriority") != "1-URGENT")
    present = stored.select(s.order_path(F.col("o_orderkey")).alias("filepath"))
    return catalog.missing_files(listed, present)


@query
def sample_limit(spark, sf):
    return catalog.first_files(s.order_files(spark, sf), 100)


# --- sources and sinks --------------------------------------------------------------------


@query
def src_table_load(spark, sf):
    orders = tables.load_table(spark, f"{sf}/orders.parquet", "parquet")
    return orders.select("o_orderkey", "o_custkey", "o_orderstatus")


@query
def save_modes(spark, sf):
    """One table per mode, written twice; how many rows of each disease are there after."""
    base = tables.scratch_path(spark, "modes")
    rows = s.patients(spark, sf)
    counted = None
    for mode in ("append", "ignore", "overwrite"):
        tables.save_table(rows, f"{base}/{mode}", mode="error")
        tables.save_table(rows, f"{base}/{mode}", mode=mode)
        stored = tables.load_table(spark, f"{base}/{mode}").withColumn("mode", F.lit(mode))
        counted = stored if counted is None else counted.unionByName(stored)
    return counted.groupBy("mode", "disease_type").agg(F.count(F.lit(1)).alias("rows"))


# --- expression ingest --------------------------------------------------------------------


@query
def gene_id_strip_version(spark, sf):
    versioned = F.concat_ws(".", F.col("p_partkey").cast("string"), F.col("p_size").cast("string"))
    return s.table(spark, sf, "part").select(
        "p_partkey", text.strip_version(versioned).alias("gene_id")
    )


@query
def parse_double(spark, sf):
    """Quantities in spellings that are numbers, and in some that are none."""
    number = F.col("l_quantity").cast("int").cast("string")
    spelled = (
        F.when(F.col("l_linenumber") == 1, F.concat(number, F.lit("d")))
        .when(F.col("l_linenumber") == 2, F.concat(F.lit(" +"), number, F.lit(".5 ")))
        .when(F.col("l_linenumber") == 3, F.concat(number, F.lit("_0")))
        .when(F.col("l_linenumber") == 4, F.concat(number, F.lit("e1")))
        .when(F.col("l_linenumber") == 5, F.concat(number, F.lit("._5")))
        .when(F.col("l_linenumber") == 6, F.lit(""))
        .otherwise(F.concat(F.lit("-."), number))
    )
    return s.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", text.parse_double(spelled).alias("measure")
    )


@query
def expr_positive(spark, sf):
    value = F.when(F.col("l_linenumber") == 7, F.lit(float("nan"))).otherwise(
        F.col("l_quantity") - 25
    )
    rows = s.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", value.alias("v"))
    return rows.filter(text.is_positive(F.col("v")))


def _staged(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """The text is read once, into a staged table."""
    path = tables.scratch_path(spark, "staged-lines")
    tables.save_table(ingest.stage_lines(lines), path)
    return tables.load_table(spark, path, schema=STAGED)


@query
def expr_ingest(spark, sf):
    staged = _staged(spark, s.expression_lines(spark, sf))
    return ingest.ingest_expression(staged, catalog.expression_files(s.order_files(spark, sf)))


@query
def expr_rejected(spark, sf):
    return ingest.rejected_files(ingest.stage_lines(s.expression_lines(spark, sf)))


@query
def expr_missing(spark, sf):
    """Listed expression files that are not in the archive: here, those of urgent orders."""
    listed = catalog.expression_files(s.order_files(spark, sf))
    stored = s.table(spark, sf, "orders").withColumn(
        "path", s.order_path(F.col("o_orderkey"))
    )
    gone = F.concat(F.col("path"), F.lit(".gone"))
    urgent = F.col("o_orderpriority") == "1-URGENT"
    present = stored.select(F.when(urgent, gone).otherwise(F.col("path")).alias("filepath"))
    return catalog.missing_files(listed, present)


@query
def expr_ingest_files(spark, sf):
    """Ingest from compressed text files; the file list is made by listing the folder."""
    root = tables.scratch_path(spark, "expression")
    lines = s.measures(spark, sf).select(
        F.concat_ws("\t", F.concat("gene_id", F.lit(".1")), "gene_expr").alias("value"),
        (F.col("case_id") % 4).alias("ward"),
    )
    tables.save_table(lines, root, "text", partition_by=["ward"], compression="gzip")
    present = files.list_files(spark, root, "*.txt.gz")
    paths = present.select(
        F.regexp_extract("filepath", "ward=([0-9]+)/", 1).alias("case_id"), "filepath"
    )
    staged = _staged(spark, files.read_lines(spark, root, "*.txt.gz"))
    clustered = ingest.clustered(ingest.ingest_expression(staged, paths))
    stored = f"{root}-table"
    tables.save_table(clustered, stored)
    return tables.load_table(spark, stored)


@query
def expr_ingest_by_content(spark, sf):
    """Ingest from an archive whose names do not tell how files are packed: what is a gzip file
    by its contents is taken, as the content type of an object store would have it."""
    root = files.resolved(spark, tables.scratch_path(spark, "contents"))
    lines = s.measures(spark, sf).select(
        F.concat_ws("\t", F.concat("gene_id", F.lit(".1")), "gene_expr").alias("value"),
        (F.col("case_id") % 4).alias("ward"),
    )
    for ward, (extension, packed) in enumerate(
        [("txt.gz", True), ("txt", True), ("txt.gz", False), ("txt", False)]
    ):
        s.pack_lines(lines.filter(F.col("ward") == ward), f"{root}/{ward}", extension, packed)
    paths = contents.gzip_files(spark, root).select(
        F.substring_index("filepath", "/", 1).alias("case_id"), "filepath"
    )
    staged = _staged(spark, contents.read_lines(spark, root))
    return ingest.ingest_expression(staged, paths)


# --- clinical enrichment ------------------------------------------------------------------


@query
def clinical_xml_extract(spark, sf):
    parsed = clinical.parse_reports(s.reports(spark, sf))
    return clinical.extract_clinical(clinical.listed_reports(parsed, s.report_files(spark, sf)))


@query
def clinical_quarantine(spark, sf):
    """Reports among web pages: the pages, left open at their end, are no XML documents."""
    pages = s.table(spark, sf, "pages").select(
        F.col("url").alias("filepath"), F.concat(F.lit("<r>"), F.col("html")).alias("value")
    )
    parsed = clinical.parse_reports(s.reports(spark, sf).unionByName(pages))
    listed = parsed.withColumn("case_id", F.col("filepath"))
    return clinical.extract_clinical(listed, on_error="quarantine")


@query
def clinical_xml_files(spark, sf):
    """Reports written as files, one for each report, and read back as whole documents."""
    root = files.resolved(spark, tables.scratch_path(spark, "reports-as-files"))
    s.write_documents(s.reports(spark, sf), root)
    parsed = clinical.parse_reports(contents.read_documents(spark, root, "*.txt"))
    report = F.regexp_extract("filepath", "([^/]+)[.]txt$", 1)
    listed = parsed.select(report.alias("case_id"), "*")
    return clinical.extract_clinical(listed).drop("filepath")


@query
def clinical_xml_struct(spark, sf):
    """Patient elements written as XML and read back as nested rows by their tag."""
    root = tables.scratch_path(spark, "elements")

    def element(column, cde):
        return F.struct(F.lit(cde).alias("_cde"), F.coalesce(column, F.lit("none")).alias("_VALUE"))

    rows = s.patients(spark, sf).select(
        element("disease_type", "1").alias("clin_shared:tumor_tissue_site"),
        element("gender", "2").alias("shared:gender"),
        F.struct(element("disease_stage", "3").alias("shared_stage:pathologic_stage")).alias(
            "shared_stage:stage_event"
        ),
    )
    tag = "brca:patient"
    # Prefixed names are no plain names, which is what the writer would check.
    layout = {"rowTag": tag, "rootTag": f"brca:bcr {PATIENT_NAMESPACES}", "validateName": "false"}
    # A file is read by one task, so that files are of bounded size, whatever the table's are.
    layout["maxRecordsPerFile"] = str(ELEMENTS_PER_FILE)
    tables.save_table(rows.hint("rebalance"), root, "xml", **layout)
    read = files.read_elements(spark, root, tag, clinical.patient_schema())
    return (
        clinical.clinical_from_elements(read)
        .groupBy("disease_type", "disease_stage", "gender")
        .agg(F.count(F.lit(1)).alias("patients"))
    )


@query
def patient_update(spark, sf):
    """The records are written first, so that the reports are parsed once."""
    records = tables.scratch_path(spark, "clinical")
    tables.save_table(clinical_xml_extract(spark, sf), records)
    return clinical.update_patients(s.patients(spark, sf), tables.load_table(spark, records))


def _schema(rows: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)


@query
def patients_by_batch(spark, sf):
    """The index in two batches, the first one twice: each adds the patients not listed so far."""
    root = tables.scratch_path(spark, "patients-by-batch")
    tables.save_table(_index(spark, sf), f"{root}/index")
    index = tables.load_table(spark, f"{root}/index")
    for batch in (0, 1, 0):
        rows = catalog.new_patients(index.filter(F.col("path").cast("long") % 2 == batch))
        named = patients.named_slices(rows)
        patients.append_patients(rows, f"{root}/patients", named)
    schema = f"{schemas.PATIENT_INFO}, slice int"
    return tables.load_table(spark, f"{root}/patients", schema=schema).drop("slice")


@query
def patient_update_by_batch(spark, sf):
    """The records in two batches, the first one twice: each refreshes the slices it names."""
    root = tables.scratch_path(spark, "update-by-batch")
    listed, records, target = (f"{root}/{name}" for name in ("listed", "records", "target"))
    known = s.patients(spark, sf)
    tables.save_table(clinical_xml_extract(spark, sf), f"{root}/extracted")
    extracted = tables.load_table(spark, f"{root}/extracted")
    kinds = {"schema": _schema(known), "record_schema": _schema(extracted)}
    named = patients.named_slices(known)
    patients.append_patients(known, listed, named, kinds["schema"])
    patients.refresh(spark, listed, records, target, named, **kinds)
    for batch in (0, 1, 0):
        own = extracted.filter(F.crc32(F.col("filepath").cast("binary")) % 2 == batch)
        named = patients.save_records(own, records, str(batch), kinds["record_schema"])
        patients.refresh(spark, listed, records, target, named, **kinds)
    schema = f"{kinds['schema']}, slice int"
    return tables.load_table(spark, target, schema=schema).drop("slice")


# --- summaries that can be merged ---------------------------------------------------------


def _merged(spark: SparkSession, sf: str) -> DataFrame:
    """Measures in two batches, summed up one after the other, and merged."""
    root = tables.scratch_path(spark, "moments")
    batch = ((F.col("case_id") + F.col("gene_id")) % 2).cast("string")
    tables.save_table(
        s.expression(spark, sf).withColumn("batch", batch),
        f"{root}/measures",
        partition_by=["batch"],
    )
    kinds = "case_id bigint, gene_id bigint, gene_expr double, batch string"
    measures = tables.load_table(spark, f"{root}/measures", schema=kinds)
    # Asked for several times in each update, as the table that a job would have of them.
    tables.save_table(measures.select("case_id", "batch").distinct(), f"{root}/cases")
    cases = tables.load_table(spark, f"{root}/cases", schema="case_id bigint, batch string").select(
        "case_id", F.lit("first").alias("run"), "batch"
    )
    for some in (cases.filter(F.col("batch") == "0"), cases):
        moments.update(
            spark,
            measures,
            some,
            s.patients(spark, sf),
            f"{root}/moments",
            f"{root}/members",
            s.SPECS,
        )
    return moments.merge(moments.load(spark, f"{root}/moments", "bigint"))


@query
def fold_change_by_batch(spark, sf):
    """The fold changes of all diseases, from the summaries of two batches."""
    genome_rows = s.genome(spark, sf)
    (small,) = fit_broadcast(cohort.gene_rows(genome_rows))
    return cohort.fold_change(moments.means(_merged(spark, sf)), genome_rows, small)


@query
def expression_difference(spark, sf):
    """Welch's test of both arms, gene by gene; to six places, which any summation order gives."""
    found = moments.difference(_merged(spark, sf))
    return found.select(
        "disease_type",
        "gene_id",
        "early_n",
        "late_n",
        *(F.round(c, 6).alias(c) for c in ("t", "df", "p_value")),
    )


# --- reference genome ---------------------------------------------------------------------


@query
def regex_extract(spark, sf):
    word = text.regex_extract(F.col("text"), "([a-z]+) of ")
    return s.table(spark, sf, "documents").select("doc_id", word.alias("word"))


@query
def regex_extract_groups(spark, sf):
    words = text.regex_extract_groups(F.col("text"), "([a-z]+) of ([a-z]+)", 2)
    return s.table(spark, sf, "documents").select(
        "doc_id",
        F.size(words).alias("groups"),
        F.get(words, F.lit(0)).alias("before"),
        F.get(words, F.lit(1)).alias("after"),
    )


def _parsed(spark: SparkSession, sf: str) -> DataFrame:
    return genome.parse_genes(s.genome_records(spark, sf))


@query
def genome_blocks(spark, sf):
    return genome.gene_blocks(s.genome_records(spark, sf)).select("file_name", "location")


@query
def genome_qualifiers(spark, sf):
    return _parsed(spark, sf).select("full_id", "id", "name", "info")


@query
def genome_strand(spark, sf):
    return _parsed(spark, sf).select("full_id", "strand")


@query
def genome_position(spark, sf):
    return _parsed(spark, sf).select("full_id", "pos_start", "pos_end")


@query
def genome_chromosome(spark, sf):
    return _parsed(spark, sf).select("full_id", "chromosome")


@query
def genome_rejected(spark, sf):
    return genome.rejected_genes(_parsed(spark, sf)).select("full_id", "chromosome")


@query
def genome_reference(spark, sf):
    return genome.gene_reference(_parsed(spark, sf))


@query
def genome_stored(spark, sf):
    """The gene reference stored as its table, and read back."""
    path = tables.scratch_path(spark, "hs-genome")
    tables.create_table(spark, "hs_genome", path)
    tables.save_table(genome.gene_reference(_parsed(spark, sf)), path, mode="append")
    return tables.load_table(spark, path, schema=schemas.GENE_REFERENCE)


@query
def genome_counts(spark, sf):
    return genome.genes_per_chromosome(genome.gene_reference(_parsed(spark, sf)))


@query
def genome_total(spark, sf):
    return genome.gene_count(genome.gene_reference(_parsed(spark, sf)))


@query
def genome_repeated(spark, sf):
    """Genes told apart by name only: those whose shared id would be rejected as a key."""
    named = _parsed(spark, sf).withColumn("full_id", F.col("name"))
    return genome.repeated_genes(named)


def _as_named_files(spark: SparkSession, root: str, column: str) -> str:
    """Text files written in folders by a file name, moved to files of that name."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    named = f"{root}-named"
    for folder in store.globStatus(path(f"{root}/{column}=*")):
        name = folder.getPath().getName().split("=", 1)[1]
        for i, part in enumerate(store.globStatus(path(f"{folder.getPath()}/part-*"))):
            store.mkdirs(path(f"{named}/{i}"))
            store.rename(part.getPath(), path(f"{named}/{i}/{name}"))
    return named


@query
def genome_files(spark, sf):
    """Gene records written as compressed flat files, one for each chromosome, and cut again by
    the reader."""
    root = tables.scratch_path(spark, "genome")
    lines = s.genome_records(spark, sf).select(
        "file_name", F.concat(F.lit("HEADER\n     gene "), F.col("value")).alias("value")
    )
    tables.save_table(
        lines.repartition("file_name"), root, "text", partition_by=["file_name"], compression="gzip"
    )
    records = files.read_genome_records(spark, _as_named_files(spark, root, "file_name"))
    return genome.gene_reference(genome.parse_genes(records))


@query
def genome_streamed(spark, sf):
    """The same, of files that hold a sequence behind every entry, which is passed over."""
    root = tables.scratch_path(spark, "genome")
    sequence = F.concat(F.lit("\nORIGIN\n        1 "), F.repeat(F.lit("acgt gene "), 100), F.lit("\n//"))
    lines = s.genome_records(spark, sf).select(
        "file_name",
        F.concat(F.lit("HEADER\n     gene "), F.col("value"), sequence).alias("value"),
    )
    tables.save_table(
        lines.repartition("file_name"), root, "text", partition_by=["file_name"], compression="gzip"
    )
    records = contents.read_genome_records(spark, _as_named_files(spark, root, "file_name"))
    return genome.gene_reference(genome.parse_genes(records))
