"""Declared schemas: inputs are never inferred, tables are created from these."""

# Column names and types shared with existing inputs and tables.
METADATA = (
    "file_name string, data_format string, "
    "cases array<struct<case_id: string, project: struct<project_id: string>>>"
)
MANIFEST = ("id", "filename")
FILE_LIST = "path string, filename string, data_format string, project_id string, case_id string"
PATIENT_INFO = (
    "case_id string, project_id string, disease_type string, disease_stage string, gender string"
)
CLINICAL = (
    "case_id string, filepath string, disease_stage string, disease_type string, gender string"
)
GENE_EXPR = "case_id string, gene_id string, gene_expr double"
GENE_REFERENCE = (
    "full_id string, id string, name string, chromosome string, strand string, "
    "pos_start int, pos_end int, info string"
)
PROJECT_SUMMARY = "disease_type string, project_id string, sample_counts bigint"
FOLD_CHANGE_RANKED = (
    "disease_type string, gene_id string, gene_name string, fold_change double, "
    "chromosome string, info string"
)
EXPRESSION_CHANGED = (
    "disease_type string, gene_id string, early_avg_expr double, late_avg_expr double, "
    "gene_name string, chromosome string, info string"
)

TABLES = {
    "xml_list": FILE_LIST,
    "txt_list": FILE_LIST,
    "unknowns": FILE_LIST,
    "patient_info": PATIENT_INFO,
    "gene_expr_table": GENE_EXPR,
    "hs_genome": GENE_REFERENCE,
    "project_summary": PROJECT_SUMMARY,
    "fold_change_ranked": FOLD_CHANGE_RANKED,
    "expression_changed": EXPRESSION_CHANGED,
}
