"""The same results in plain SQL, written apart from the queries.

The cohort reports are stated here with one scan per arm and a join of both, disease by
disease.
"""

from __future__ import annotations

PATIENTS = """patient_info AS (
  SELECT c_custkey AS case_id, c_nationkey AS project_id,
         CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_mktsegment END AS disease_type,
         CASE c_custkey % 11
              WHEN 0 THEN 'Stage I' WHEN 1 THEN 'Stage IA' WHEN 2 THEN 'Stage IB'
              WHEN 3 THEN 'Stage II' WHEN 4 THEN 'Stage IIA' WHEN 5 THEN 'Stage IIB'
              WHEN 6 THEN 'Stage III' WHEN 7 THEN 'Stage IIIA' WHEN 8 THEN 'Stage IIIB'
              WHEN 9 THEN 'N/A' ELSE NULL END AS disease_stage,
         CASE c_custkey % 3 WHEN 0 THEN 'FEMALE' WHEN 1 THEN 'MALE' ELSE NULL END AS gender
  FROM customer)"""

EXPRESSION = """gene_expr_table AS (
  SELECT o_custkey AS case_id, l_partkey AS gene_id, l_quantity - 1 AS gene_expr
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE l_quantity - 1 > 0)"""

GENOME = """genome AS (
  SELECT p_partkey AS id, p_name AS name, p_brand AS chromosome,
         p_type || ' [Source:' || p_brand || ']' AS info
  FROM part WHERE p_partkey % 7 <> 0
  UNION ALL
  SELECT p_partkey, p_name, p_brand, p_type
  FROM part WHERE p_partkey % 7 <> 0 AND p_partkey % 10 = 0)"""

INDEX = """manifest AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS path,
         'f' || CAST(o_orderkey AS VARCHAR)
             || CASE WHEN o_orderkey % 2 = 0 THEN '.FPKM-UQ.txt.gz' ELSE '.xml' END AS filename
  FROM orders WHERE o_orderkey % 19 <> 0),
renamed AS (
  SELECT CASE WHEN o_orderkey % 23 = 0 THEN 'described-f' ELSE 'f' END
             || CAST(o_orderkey AS VARCHAR)
             || CASE WHEN o_orderkey % 2 = 0 THEN '.FPKM-UQ.txt.gz' ELSE '.xml' END AS file_name,
         CASE WHEN o_orderkey % 17 = 0 THEN NULL
              ELSE CASE o_orderkey % 4 WHEN 0 THEN 'BCR XML' WHEN 1 THEN 'TXT'
                                       WHEN 2 THEN 'XLSX' ELSE 'VCF' END
         END AS data_format
  FROM orders JOIN customer ON o_custkey = c_custkey),
meta AS (
  SELECT 'f' || CAST(o_orderkey AS VARCHAR)
             || CASE WHEN o_orderkey % 2 = 0 THEN '.FPKM-UQ.txt.gz' ELSE '.xml' END AS file_name,
         CASE WHEN o_orderkey % 17 = 0 THEN NULL
              ELSE CASE o_orderkey % 4 WHEN 0 THEN 'BCR XML' WHEN 1 THEN 'TXT'
                                       WHEN 2 THEN 'XLSX' ELSE 'VCF' END
         END AS data_format,
         CAST(o_custkey AS VARCHAR) AS case_id, CAST(c_nationkey AS VARCHAR) AS project_id
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 23 <> 0),
idx AS (
  SELECT path, filename, data_format, project_id, case_id
  FROM manifest JOIN meta ON filename = file_name WHERE data_format <> 'XLSX')"""

# disease, early arm, late arm, upper threshold
ARMS = [
    (
        "BUILDING",
        "disease_stage IN ('Stage I', 'Stage IA', 'Stage IB')",
        "disease_stage IN ('Stage II', 'Stage IIA', 'Stage IIB')",
        2.0,
    ),
    (
        "AUTOMOBILE",
        "regexp_matches(disease_stage, 'Stage II')",
        "regexp_matches(disease_stage, 'Stage III')",
        2.0,
    ),
    ("FURNITURE", "disease_stage = 'Stage IIA'", "disease_stage = 'Stage IIB'", 2.0),
    ("HOUSEHOLD", "disease_stage = 'Stage IIIA'", "disease_stage = 'Stage IIIB'", 3.0),
    ("MACHINERY", "disease_stage = 'Stage I'", "disease_stage = 'Stage II'", 2.0),
]


def _arm(disease: str, condition: str) -> str:
    return f"""(SELECT gene_id, AVG(gene_expr) AS avg_expr FROM gene_expr_table x
      WHERE EXISTS (SELECT 1 FROM patient_info p
                    WHERE p.case_id = x.case_id AND p.disease_type = '{disease}' AND {condition})
      GROUP BY gene_id)"""


def _means(diseases: list[str] | None = None) -> str:
    blocks = [
        f"""SELECT '{disease}' AS disease_type, e.gene_id, e.avg_expr AS early_avg_expr,
           l.avg_expr AS late_avg_expr, l.avg_expr / e.avg_expr AS fold_change,
           CAST({high} AS DOUBLE) AS high
    FROM {_arm(disease, early)} e JOIN {_arm(disease, late)} l ON e.gene_id = l.gene_id"""
        for disease, early, late, high in ARMS
        if diseases is None or disease in diseases
    ]
    return "means AS (" + "\n  UNION ALL\n  ".join(blocks) + ")"


def _report(select: str, diseases: list[str] | None = None, where: str = "TRUE") -> str:
    return (
        f"WITH {PATIENTS},\n{EXPRESSION},\n{GENOME},\n{_means(diseases)}\n"
        f"SELECT {select} FROM means LEFT JOIN genome ON gene_id = id WHERE {where}"
    )


def _spread(disease: str, condition: str) -> str:
    return f"""(SELECT gene_id, COUNT(*) AS n, AVG(gene_expr) AS m, VAR_SAMP(gene_expr) AS v
      FROM gene_expr_table x
      WHERE EXISTS (SELECT 1 FROM patient_info p
                    WHERE p.case_id = x.case_id AND p.disease_type = '{disease}' AND {condition})
      GROUP BY gene_id)"""


def _difference() -> str:
    """Welch's test. The p-value is the tail of Student's density over its half, both by
    quadrature: steps of u in y = exp(pi/2 sinh(u)), the distance from where the tail begins."""
    blocks = "\n  UNION ALL\n  ".join(
        f"""SELECT '{disease}' AS disease_type, e.gene_id, e.n AS early_n, l.n AS late_n,
           e.m AS em, l.m AS lm, e.v / e.n AS ev, l.v / l.n AS lv
    FROM {_spread(disease, early)} e JOIN {_spread(disease, late)} l ON e.gene_id = l.gene_id"""
        for disease, early, late, _ in ARMS
    )
    return f"""WITH {PATIENTS},\n{EXPRESSION},
  arms AS ({blocks}),
  tests AS (
    SELECT *, row_number() OVER () AS r,
           CASE WHEN ev + lv > 0 THEN (lm - em) / sqrt(ev + lv) END AS t,
           CASE WHEN ev + lv > 0
                THEN (ev + lv) ** 2 / (ev ** 2 / (early_n - 1) + lv ** 2 / (late_n - 1)) END AS df
    FROM arms),
  steps AS (SELECT k / 64.0 AS u FROM range(-288, 289) s(k)),
  nodes AS (
    SELECT exp(pi() / 2 * (exp(u) - exp(-u)) / 2) AS y, (exp(u) + exp(-u)) / 2 AS w FROM steps),
  tails AS (
    SELECT r, sum(w * y * exp(-(df + 1) / 2 * ln(1 + (abs(t) + y) ** 2 / df))) AS tail,
           sum(w * y * exp(-(df + 1) / 2 * ln(1 + y ** 2 / df))) AS half
    FROM tests, nodes WHERE t IS NOT NULL GROUP BY r)
  SELECT disease_type, gene_id, early_n, late_n, round(t, 6) AS t, round(df, 6) AS df,
         round(tail / half, 6) AS p_value
  FROM tests LEFT JOIN tails USING (r)"""


RANKED_COLUMNS = "disease_type, gene_id, name AS gene_name, fold_change, chromosome, info"
RANKED_NAMES = "disease_type, gene_id, gene_name, fold_change, chromosome, info"
CHANGED = "fold_change > high OR fold_change < 0.5"


def _top(direction: str, diseases: list[str] | None = None) -> str:
    order = (
        "fold_change DESC, gene_id, name, chromosome, info"
        if direction == "increased"
        else "fold_change, gene_id DESC, name DESC, chromosome DESC, info DESC"
    )
    rank = f"CAST(row_number() OVER (PARTITION BY disease_type ORDER BY {order}) AS INTEGER)"
    inner = _report(f"{RANKED_COLUMNS}, {rank} AS rank", diseases)
    return f"SELECT * FROM ({inner}) WHERE rank <= 10"


def _patients(select: str, rest: str = "") -> str:
    return f"WITH {PATIENTS} SELECT {select} FROM patient_info {rest}"


def _index(select: str, rest: str = "") -> str:
    return f"WITH {INDEX} SELECT {select} FROM idx {rest}"


ORDER_PATH = (
    "CAST(o_orderkey AS VARCHAR) || '/f' || CAST(o_orderkey AS VARCHAR)"
    " || CASE WHEN o_orderkey % 2 = 0 THEN '.FPKM-UQ.txt.gz' ELSE '.xml' END"
)

# The text a report yields, by the customer it describes.
REPORTS = """reports AS (
  SELECT c_custkey AS report, 'r' || CAST(c_custkey AS VARCHAR) AS filepath,
         CASE WHEN c_custkey % 7 = 0 THEN 'N/A'
              ELSE 'Stage ' || CAST(c_nationkey AS VARCHAR) END AS disease_stage,
         c_mktsegment AS disease_type,
         CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 'FEMALE' END AS gender
  FROM customer)"""
CLINICAL = f"""{REPORTS},
listed AS (
  SELECT c_custkey AS case_id, c_custkey AS report FROM customer
  WHERE c_custkey % 3 = 0 OR c_custkey % 11 <> 0
  UNION ALL
  SELECT c_custkey, c_custkey - 1 FROM customer WHERE c_custkey % 3 = 0),
clinical AS (
  SELECT case_id, filepath, disease_stage, disease_type, gender
  FROM listed JOIN reports USING (report))"""

# Gene records by the part they were made from. p_size 49 is MT, 50 is no chromosome.
GENES = """genes AS (
  SELECT 'G' || CAST(p_partkey AS VARCHAR) || '.3' AS full_id,
         'G' || CAST(p_partkey AS VARCHAR) AS id, p_name AS name,
         CASE p_size WHEN 49 THEN 'chromosome.MT' WHEN 50 THEN 'Non-chromosomal'
                     ELSE 'chromosome.' || CAST(p_size AS VARCHAR) END AS chromosome,
         CASE WHEN p_size = 49 THEN NULL WHEN p_partkey % 2 = 0 THEN '-' ELSE '+' END AS strand,
         CASE WHEN p_size = 50 THEN -1 WHEN p_partkey % 9 <> 0
              THEN CAST(p_partkey AS INTEGER) END AS pos_start,
         CASE WHEN p_size = 50 THEN -1 WHEN p_partkey % 9 <> 0
              THEN CAST(p_partkey + 100 AS INTEGER) END AS pos_end,
         p_type || ' [Source:' || p_brand || ']' AS info
  FROM part)"""


def _genes(select: str, rest: str = "") -> str:
    return f"WITH {GENES} SELECT {select} FROM genes {rest}"


LINES = """files AS (
  SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS case_id FROM orders WHERE o_orderkey % 2 = 0),
bad AS (
  SELECT DISTINCT l_orderkey FROM lineitem WHERE l_orderkey % 50 = 0 AND l_linenumber = 1)"""

ORACLES = {
    # cohort reports
    "fold_change_ranked": _report(RANKED_COLUMNS, ["BUILDING"]),
    "fold_change_all": _report(RANKED_COLUMNS),
    "fold_change_placeholder": _report(RANKED_COLUMNS, ["FURNITURE"]),
    "expression_changed": _report(
        "disease_type, gene_id, early_avg_expr, late_avg_expr, name AS gene_name, chromosome, info",
        where=CHANGED,
    ),
    "expression_scatter": _report(
        "disease_type, early_avg_expr, late_avg_expr, name AS gene_name", where=CHANGED
    ),
    "cohort_mean": f"WITH {PATIENTS},\n{EXPRESSION} SELECT gene_id, avg_expr FROM "
    + _arm("BUILDING", ARMS[0][1]),
    "cohort_semi_join": f"""WITH {PATIENTS},\n{EXPRESSION}
        SELECT case_id, gene_id, gene_expr FROM gene_expr_table
        WHERE case_id IN (SELECT case_id FROM patient_info
                          WHERE disease_type = 'BUILDING' AND {ARMS[0][2]})""",
    "cohort_in_list": _patients(
        "case_id", f"WHERE disease_type = 'BUILDING' AND {ARMS[0][1]}"
    ),
    "cohort_regex": _patients("case_id", f"WHERE disease_type = 'AUTOMOBILE' AND {ARMS[1][1]}"),
    "gene_reference_left_join": f"""WITH {GENOME}
        SELECT p_partkey AS gene_id, name AS gene_name, chromosome, info
        FROM part LEFT JOIN genome ON p_partkey = id""",
    "gene_annotation": f"""WITH {GENOME}
        SELECT p_partkey AS gene_id, name || '<br />' || split_part(info, '[', 1) AS annotation
        FROM part LEFT JOIN genome ON p_partkey = id""",
    "top_increased": _top("increased", ["BUILDING"]),
    "top_decreased": _top("decreased", ["BUILDING"]),
    "top_increased_all": _top("increased"),
    "top_decreased_all": _top("decreased"),
    "reports_stored": _report(RANKED_COLUMNS, ["BUILDING"])
    + " ORDER BY fold_change DESC, gene_id, gene_name, chromosome, info LIMIT 10",
    "reports_both_ends": " UNION ALL ".join(
        f"SELECT {RANKED_NAMES}, '{end}' AS \"end\" FROM ({_top(direction, ['BUILDING'])})"
        for end, direction in (("first", "increased"), ("last", "decreased"))
    ),
    # patients, summaries and menus
    "project_summary": _patients(
        "disease_type, project_id, COUNT(*) AS sample_counts", "GROUP BY ALL"
    ),
    "stage_counts": _patients(
        "disease_stage, COUNT(*) AS counts", "WHERE disease_type = 'BUILDING' GROUP BY ALL"
    ),
    "gender_counts": _patients(
        "gender, COUNT(*) AS counts", "WHERE disease_type = 'BUILDING' GROUP BY ALL"
    ),
    "disease_list": _patients("DISTINCT disease_type", "WHERE disease_type IS NOT NULL"),
    "disease_menu": f"""WITH {PATIENTS}
        SELECT '' AS label, '' AS value UNION ALL
        SELECT DISTINCT disease_type, disease_type FROM patient_info
        WHERE disease_type IS NOT NULL""",
    "disease_slug": _patients(
        "case_id, replace(concat_ws(' ', disease_type, 'and', disease_stage), ' ', '') AS slug"
    ),
    "stage_eligibility": _patients(
        """disease_type,
        COUNT(DISTINCT disease_stage) FILTER (regexp_matches(disease_stage, 'Stage'))
            AS stage_count,
        COUNT(DISTINCT disease_stage) FILTER (regexp_matches(disease_stage, 'Stage')) > 1
            AS eligible""",
        "WHERE disease_type IS NOT NULL GROUP BY disease_type",
    ),
    "analysis_menu": _patients(
        """disease_type, '[{"label":"Clinical report","value":"clinical"}'
        || CASE WHEN COUNT(DISTINCT disease_stage)
                     FILTER (regexp_matches(disease_stage, 'Stage')) > 1
                THEN ',{"label":"Gene expression analysis","value":"geneexpr"}' ELSE '' END
        || CASE WHEN disease_type = 'BUILDING'
                THEN ',{"label":"SNP analysis","value":"snp"}' ELSE '' END || ']' AS analyses""",
        "WHERE disease_type IS NOT NULL GROUP BY disease_type",
    ),
    "patients_by_disease": _patients("*", "WHERE disease_type = 'BUILDING'"),
    "patients_by_stage": _patients("*", "WHERE disease_stage = 'Stage I'"),
    "patients_by_disease_stage": _patients(
        "*", "WHERE disease_type = 'BUILDING' AND disease_stage = 'Stage I'"
    ),
    "patients_json": _patients(
        """CAST(to_json({'case_id': case_id, 'project_id': project_id,
        'disease_type': disease_type, 'disease_stage': disease_stage, 'gender': gender})
        AS VARCHAR) AS output"""
    ),
    # file catalog
    "src_json_nested": """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k
        FROM events""",
    "nested_ids_concat": """SELECT l_orderkey, l_linenumber,
        CASE WHEN l_linenumber = 7 THEN ''
             ELSE CAST(l_partkey AS VARCHAR) || CAST(l_suppkey AS VARCHAR) END AS case_id,
        CASE WHEN l_linenumber = 7 THEN '' ELSE l_returnflag || l_linestatus END AS project_id
        FROM lineitem""",
    "catalog_not_xlsx": f"""WITH {INDEX}
        SELECT file_name, data_format FROM renamed WHERE data_format <> 'XLSX'""",
    "catalog_join": _index("*"),
    "catalog_files": _index(
        """*, CASE data_format WHEN 'BCR XML' THEN 'xml_list' WHEN 'TXT' THEN 'txt_list'
        ELSE 'unknowns' END AS list_table"""
    ),
    "catalog_files_multi_line": _index("*"),
    "catalog_each_case": f"""WITH {INDEX}
        SELECT path, filename, data_format, project_id, case_id FROM idx UNION ALL
        SELECT path, filename, data_format, project_id,
               CAST(CAST(case_id AS BIGINT) + 1 AS VARCHAR) FROM idx""",
    "catalog_route_xml": _index("*", "WHERE data_format = 'BCR XML'"),
    "catalog_route_txt": _index("*", "WHERE data_format = 'TXT'"),
    "catalog_unknown": _index("*", "WHERE data_format NOT IN ('BCR XML', 'TXT')"),
    "patients_distinct": _index("DISTINCT case_id, project_id"),
    "repeated_cases": """SELECT o_custkey AS case_id, COUNT(DISTINCT o_orderstatus) AS "rows"
        FROM orders GROUP BY o_custkey HAVING COUNT(DISTINCT o_orderstatus) > 1""",
    "empty_table_schema": _index(
        """DISTINCT case_id, project_id, CAST(NULL AS VARCHAR) AS disease_type,
        CAST(NULL AS VARCHAR) AS disease_stage, CAST(NULL AS VARCHAR) AS gender"""
    ),
    "file_list_paths": _index("case_id, path || '/' || filename AS filepath"),
    "filter_contains": _index(
        "case_id, path || '/' || filename AS filepath",
        "WHERE contains(path || '/' || filename, '-UQ.txt')",
    ),
    "missing_files_anti": _index(
        "case_id, path || '/' || filename AS filepath",
        f"""WHERE path || '/' || filename NOT IN (
            SELECT {ORDER_PATH} FROM orders WHERE o_orderpriority <> '1-URGENT')""",
    ),
    "sample_limit": f"""SELECT CAST(o_custkey AS VARCHAR) AS case_id, {ORDER_PATH} AS filepath
        FROM orders ORDER BY filepath, case_id LIMIT 100""",
    # sources and sinks
    "src_table_load": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders",
    "save_modes": f"""WITH {PATIENTS},
        modes AS (SELECT * FROM (VALUES ('append', 2), ('ignore', 1), ('overwrite', 1))
                  AS m(mode, times))
        SELECT mode, disease_type, COUNT(*) * ANY_VALUE(times) AS "rows"
        FROM patient_info, modes GROUP BY mode, disease_type""",
    # expression ingest
    "gene_id_strip_version": "SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS gene_id FROM part",
    "parse_double": """SELECT l_orderkey, l_linenumber, CASE l_linenumber
        WHEN 2 THEN l_quantity + 0.5 WHEN 3 THEN l_quantity * 10 WHEN 4 THEN l_quantity * 10
        WHEN 7 THEN CAST('-.' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS DOUBLE)
        END AS measure FROM lineitem""",
    "expr_positive": """SELECT l_orderkey, l_partkey, l_quantity - 25 AS v FROM lineitem
        WHERE l_quantity > 25 AND l_linenumber <> 7""",
    "expr_ingest": f"""WITH {LINES}
        SELECT case_id, CAST(l_partkey AS VARCHAR) AS gene_id, l_quantity - 1 AS gene_expr
        FROM lineitem JOIN files ON l_orderkey = o_orderkey
        WHERE l_quantity > 1 AND l_orderkey NOT IN (SELECT l_orderkey FROM bad)""",
    "expr_rejected": f"""SELECT {ORDER_PATH} AS filepath, COUNT(*) AS bad_lines
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE o_orderkey % 50 = 0 AND l_linenumber = 1 GROUP BY o_orderkey""",
    "expr_missing": f"""SELECT CAST(o_custkey AS VARCHAR) AS case_id, {ORDER_PATH} AS filepath
        FROM orders WHERE o_orderkey % 2 = 0 AND o_orderpriority = '1-URGENT'""",
    "expr_ingest_files": f"""WITH {EXPRESSION}
        SELECT CAST(case_id % 4 AS VARCHAR) AS case_id, CAST(gene_id AS VARCHAR) AS gene_id,
               gene_expr FROM gene_expr_table""",
    "expr_ingest_by_content": f"""WITH {EXPRESSION}
        SELECT CAST(case_id % 4 AS VARCHAR) AS case_id, CAST(gene_id AS VARCHAR) AS gene_id,
               gene_expr FROM gene_expr_table WHERE case_id % 4 < 2""",
    # clinical enrichment
    "clinical_xml_extract": f"WITH {CLINICAL} SELECT * FROM clinical",
    "clinical_quarantine": f"""WITH {REPORTS}
        SELECT filepath AS case_id, filepath, disease_stage, disease_type, gender FROM reports""",
    "clinical_xml_files": f"""WITH {REPORTS}
        SELECT filepath AS case_id, disease_stage, disease_type, gender FROM reports""",
    "clinical_xml_struct": _patients(
        """COALESCE(disease_type, 'none') AS disease_type,
        COALESCE(disease_stage, 'none') AS disease_stage, COALESCE(gender, 'none') AS gender,
        COUNT(*) AS patients""",
        "GROUP BY 1, 2, 3",
    ),
    "patient_update": f"""WITH {PATIENTS},\n{CLINICAL},
        latest AS (SELECT * FROM clinical
                   QUALIFY row_number() OVER (PARTITION BY case_id ORDER BY filepath DESC) = 1)
        SELECT p.case_id, p.project_id,
               CASE WHEN l.case_id IS NULL THEN p.disease_type ELSE l.disease_type END
                   AS disease_type,
               CASE WHEN l.case_id IS NULL THEN p.disease_stage ELSE l.disease_stage END
                   AS disease_stage,
               CASE WHEN l.case_id IS NULL THEN p.gender ELSE l.gender END AS gender
        FROM patient_info p LEFT JOIN latest l ON p.case_id = l.case_id""",
    "patients_by_batch": _index(
        """DISTINCT case_id, project_id, CAST(NULL AS VARCHAR) AS disease_type,
        CAST(NULL AS VARCHAR) AS disease_stage, CAST(NULL AS VARCHAR) AS gender"""
    ),
    # summaries that can be merged
    "fold_change_by_batch": _report(RANKED_COLUMNS),
    "expression_difference": _difference(),
    # reference genome
    "regex_extract": """SELECT doc_id, regexp_extract(text, '(?i)([a-z]+) of ', 1) AS word
        FROM documents""",
    "regex_extract_groups": """SELECT doc_id,
        CASE WHEN found THEN 2 ELSE 0 END AS groups,
        CASE WHEN found THEN regexp_extract(text, '(?i)([a-z]+) of ([a-z]+)', 1) END AS before,
        CASE WHEN found THEN regexp_extract(text, '(?i)([a-z]+) of ([a-z]+)', 2) END AS after
        FROM (SELECT doc_id, text, regexp_matches(text, '(?i)([a-z]+) of ([a-z]+)') AS found
              FROM documents)""",
    "genome_blocks": """SELECT
        CASE p_size WHEN 49 THEN 'Species.B1.1.chromosome.MT.dat.gz'
                    WHEN 50 THEN 'Species.B1.1.nonchromosomal.dat.gz'
             ELSE 'Species.B1.1.chromosome.' || CAST(p_size AS VARCHAR) || '.dat.gz' END
             AS file_name,
        CASE WHEN p_partkey % 2 = 0 THEN 'complement(' ELSE '' END
        || CASE WHEN p_partkey % 9 = 0 THEN '<1..>20'
                ELSE CAST(p_partkey AS VARCHAR) || '..' || CAST(p_partkey + 100 AS VARCHAR) END
        || CASE WHEN p_partkey % 2 = 0 THEN ')' ELSE '' END AS location FROM part""",
    "genome_qualifiers": _genes("full_id, id, name, info"),
    "genome_strand": _genes("full_id, strand"),
    "genome_position": _genes("full_id, pos_start, pos_end"),
    "genome_chromosome": _genes("full_id, chromosome"),
    "genome_rejected": _genes("full_id, chromosome", "WHERE pos_start IS NULL"),
    "genome_reference": _genes("*", "WHERE pos_start IS NOT NULL"),
    "genome_stored": _genes("*", "WHERE pos_start IS NOT NULL"),
    "genome_counts": _genes(
        "chromosome, COUNT(*) AS genes", "WHERE pos_start IS NOT NULL GROUP BY chromosome"
    ),
    "genome_total": _genes("COUNT(*) AS genes", "WHERE pos_start IS NOT NULL"),
    "genome_repeated": _genes(
        'name AS full_id, COUNT(*) AS "rows"',
        "WHERE pos_start IS NOT NULL GROUP BY name HAVING COUNT(*) > 1",
    ),
    "genome_files": _genes("*", "WHERE pos_start IS NOT NULL"),
    "genome_streamed": _genes("*", "WHERE pos_start IS NOT NULL"),
}

ORACLES["patient_update_by_batch"] = ORACLES["patient_update"]
