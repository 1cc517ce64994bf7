from __future__ import annotations

from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from oncolake import schemas
from oncolake.operators import catalog, clinical
from oncolake.sources import files

# The namespaces of the reports.
STAGE = "http://tcga.nci/bcr/xml/clinical/shared/stage/2.7"
SITE = "http://tcga.nci/bcr/xml/clinical/shared/2.7"
GENDER = "http://tcga.nci/bcr/xml/shared/2.7"


def report(body, st="st", si="si", g="g", gender=GENDER):
    return (
        f'<?xml version="1.0"?><root xmlns:{st}="{STAGE}" xmlns:{si}="{SITE}" '
        f'xmlns:{g}="{gender}">{body}</root>'
    )


FULL = (
    "<admin/><patient><st:event><st:pathologic_stage x='1'>Stage IIA</st:pathologic_stage>"
    "</st:event><si:tumor_tissue_site>Breast &amp; more</si:tumor_tissue_site>"
    "<g:gender>FEMALE</g:gender></patient>"
)
REPORTS = {
    "complete.xml": (report(FULL), ("Stage IIA", "Breast & more", "FEMALE")),
    "no_stage.xml": (
        report(
            "<p><si:tumor_tissue_site>Colon</si:tumor_tissue_site><g:gender>MALE</g:gender></p>"
        ),
        ("N/A", "Colon", "MALE"),
    ),
    "empty_gender.xml": (
        report("<p><si:tumor_tissue_site>Colon</si:tumor_tissue_site><g:gender/></p>"),
        ("N/A", "Colon", None),
    ),
    "other_prefix.xml": (
        report(
            FULL.replace("st:", "a:").replace("si:", "b:").replace("g:", "c:"), "a", "b", "c"
        ),
        ("Stage IIA", "Breast & more", "FEMALE"),
    ),
    "stage_below_root.xml": (
        report("<st:pathologic_stage>Stage I</st:pathologic_stage><g:gender>MALE</g:gender>"),
        ("N/A", "N/A", "MALE"),
    ),
    "other_version.xml": (
        report("<p><g:gender>MALE</g:gender></p>", gender="http://tcga.nci/bcr/xml/shared/2.5"),
        ("N/A", "N/A", "N/A"),
    ),
    "first_of_two.xml": (
        report("<p><g:gender>MALE</g:gender><g:gender>FEMALE</g:gender></p>"),
        ("N/A", "N/A", "MALE"),
    ),
    "no_fields.xml": ("<root/>", ("N/A", "N/A", "N/A")),
}
MALFORMED = {
    "cut.xml": "<root><p>",
    "two_roots.xml": "<root/><root/>",
    "junk_after.xml": "<root/>junk",
    "unbound_prefix.xml": "<root><g:gender>MALE</g:gender></root>",
    "no_xml.xml": "hello",
}


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    root = tmp_path_factory.mktemp("reports")
    for name, (content, _) in REPORTS.items():
        (root / name).write_text(content)
    return root


def listing(spark, names):
    return spark.createDataFrame([(f"c-{n}", n) for n in names], "case_id string, filepath string")


@pytest.mark.parametrize("broadcast", [True, False])
def test_fields(spark, root, broadcast):
    parsed = clinical.parse_reports(files.read_documents(spark, str(root)))
    listed = clinical.listed_reports(parsed, listing(spark, REPORTS), broadcast)
    for mode in ("fail", "quarantine"):
        rows = clinical.extract_clinical(listed, mode).collect()
        got = {r.filepath: (r.disease_stage, r.disease_type, r.gender) for r in rows}
        assert got == {name: want for name, (_, want) in REPORTS.items()}
        assert all(r.case_id == f"c-{r.filepath}" for r in rows)


def test_byte_order_mark(spark, tmp_path):
    (tmp_path / "a.xml").write_text("\ufeff" + report(FULL))
    parsed = clinical.parse_reports(files.read_documents(spark, str(tmp_path)))
    listed = clinical.listed_reports(parsed, listing(spark, ["a.xml"]))
    assert clinical.extract_clinical(listed).first().gender == "FEMALE"


def test_only_listed_reports_are_parsed(spark, tmp_path):
    (tmp_path / "a.xml").write_text(report(FULL))
    (tmp_path / "unlisted.xml").write_text("<broken")
    documents = clinical.parse_reports(files.read_documents(spark, str(tmp_path)))
    listed = clinical.listed_reports(documents, listing(spark, ["a.xml", "gone.xml"]))
    assert clinical.extract_clinical(listed).count() == 1


@pytest.mark.parametrize("name", sorted(MALFORMED))
def test_malformed_fails_or_is_set_aside(spark, tmp_path, name):
    (tmp_path / "good.xml").write_text(report(FULL))
    (tmp_path / name).write_text(MALFORMED[name])
    documents = clinical.parse_reports(files.read_documents(spark, str(tmp_path)))
    listed = clinical.listed_reports(documents, listing(spark, ["good.xml", name]))
    rows = clinical.extract_clinical(listed, "quarantine").collect()
    assert [(r.filepath, r.gender) for r in rows] == [("good.xml", "FEMALE")]
    assert [r.filepath for r in clinical.malformed_reports(listed).collect()] == [name]
    with pytest.raises(Exception, match=f"no XML document: {name}"):
        clinical.extract_clinical(listed).collect()


def test_empty_text_is_no_report(spark):
    rows = spark.createDataFrame([("f", ""), ("g", None)], "filepath string, value string")
    listed = clinical.parse_reports(rows).withColumn("case_id", F.lit("c"))
    assert clinical.extract_clinical(listed, "quarantine").isEmpty()
    assert clinical.malformed_reports(listed).count() == 2
    with pytest.raises(Exception, match="no XML document"):
        clinical.extract_clinical(listed).collect()


HEAD = f'xmlns:s="{GENDER}" xmlns:o="urn:o"'
VALUES = {
    "foreign_first": f"<r {HEAD}><p><o:gender>XX</o:gender><s:gender>MALE</s:gender></p></r>",
    "foreign_only": f"<r {HEAD}><p><o:gender>XX</o:gender></p></r>",
    "comment_before": f"<r {HEAD}><p><s:gender><!--c-->MALE</s:gender></p></r>",
    "comment_inside": f"<r {HEAD}><p><s:gender>MA<!--c-->LE</s:gender></p></r>",
    "instruction": f"<r {HEAD}><p><s:gender>MA<?x y?>LE</s:gender></p></r>",
    "cdata": f"<r {HEAD}><p><s:gender>M<![CDATA[A&]]>LE</s:gender></p></r>",
    "child": f"<r {HEAD}><p><s:gender>MA<b/>LE</s:gender></p></r>",
    "blank": f"<r {HEAD}><p><s:gender> </s:gender></p></r>",
    "default_namespace": f'<r><p xmlns="{GENDER}"><gender>MALE</gender></p></r>',
    "declared_below": f'<r><p><x:gender xmlns:x="{GENDER}">MALE</x:gender></p></r>',
    "declared_twice": f'<r {HEAD} xmlns:t="{GENDER}"><p><t:gender>A</t:gender><s:gender>B</s:gender></p></r>',
    "rebound": f'<r {HEAD}><p xmlns:s="urn:z"><s:gender>XX</s:gender></p><s:gender>MALE</s:gender></r>',
    "stage_order": f'<r xmlns:t="{STAGE}"><a><b><t:pathologic_stage>inner</t:pathologic_stage></b>'
    "<t:pathologic_stage>outer</t:pathologic_stage></a></r>",
}


@pytest.mark.parametrize("mode", ["fail", "quarantine"])
def test_values_are_those_of_elementtree(spark, mode):
    rows = spark.createDataFrame(list(VALUES.items()), "filepath string, value string")
    listed = clinical.parse_reports(rows).withColumn("case_id", F.lit("c"))
    got = {r.filepath: r for r in clinical.extract_clinical(listed, mode).collect()}
    wanted = {
        "disease_stage": f".//*/{{{STAGE}}}pathologic_stage",
        "disease_type": f".//{{{SITE}}}tumor_tissue_site",
        "gender": f".//{{{GENDER}}}gender",
    }
    for name, text in VALUES.items():
        for column, path in wanted.items():
            element = ElementTree.fromstring(text).find(path)
            want = "N/A" if element is None else element.text
            assert got[name][column] == want, (name, column)
    assert got["foreign_first"].gender == got["comment_inside"].gender == "MALE"
    assert got["foreign_only"].gender == "N/A"


def test_empty_files_count_as_missing(spark, tmp_path):
    """The readers pass over files without content."""
    (tmp_path / "a.xml").write_text("")
    present = files.list_files(spark, str(tmp_path), "*.xml")
    with pytest.raises(FileNotFoundError):
        catalog.require_files(listing(spark, ["a.xml"]), present)


def test_unknown_error_mode(spark, root):
    with pytest.raises(ValueError):
        clinical.extract_clinical(
            clinical.parse_reports(files.read_documents(spark, str(root))), "skip"
        )


def test_update(spark):
    patients = spark.createDataFrame(
        [
            ("c1", "P", "old", "old", "old"),
            ("c2", "P", "old", "old", "old"),
            ("c3", "P", None, None, None),
            ("c1", "Q", None, None, None),
            (None, "P", "old", "old", "old"),
        ],
        schemas.PATIENT_INFO,
    )
    records = spark.createDataFrame(
        [
            ("c1", "f/1", "Stage I", "A", "MALE"),
            ("c1", "f/3", "N/A", "B", None),
            ("c1", "f/2", "Stage II", "C", "MALE"),
            ("c3", "f/4", "Stage III", None, "FEMALE"),
            ("unknown", "f/5", "Stage I", "A", "MALE"),
            (None, "f/6", "Stage I", "A", "MALE"),
        ],
        "case_id string, filepath string, disease_stage string, disease_type string, gender string",
    )
    updated = clinical.update_patients(patients, records)
    assert updated.columns == patients.columns
    assert sorted(map(tuple, updated.collect()), key=repr) == sorted(
        [
            ("c1", "P", "B", "N/A", None),
            ("c1", "Q", "B", "N/A", None),
            ("c2", "P", "old", "old", "old"),
            ("c3", "P", None, "Stage III", "FEMALE"),
            (None, "P", "old", "old", "old"),
        ],
        key=repr,
    )


def test_elements_by_tag(spark, tmp_path):
    schema = clinical.patient_schema()
    head = (
        '<b:bcr xmlns:b="u:b" xmlns:brca="u:brca" xmlns:shared="u:s" '
        'xmlns:clin_shared="u:c" xmlns:shared_stage="u:t"><b:admin/>'
    )
    patient = (
        '<brca:patient><clin_shared:tumor_tissue_site n="1">Breast'
        "</clin_shared:tumor_tissue_site><shared:gender>FEMALE</shared:gender>{}</brca:patient>"
    )
    stage = (
        "<shared_stage:stage_event><shared_stage:pathologic_stage>Stage I"
        "</shared_stage:pathologic_stage></shared_stage:stage_event>"
    )
    (tmp_path / "a.xml").write_text(head + patient.format(stage) + "</b:bcr>")
    (tmp_path / "b.xml").write_text(head + patient.format("") + "</b:bcr>")
    rows = files.read_elements(spark, str(tmp_path), "brca:patient", schema, "*.xml")
    got = clinical.clinical_from_elements(rows).collect()
    assert sorted(map(tuple, got), key=repr) == [
        ("a.xml", "Stage I", "Breast", "FEMALE"),
        ("b.xml", None, "Breast", "FEMALE"),
    ]


def test_element_files_are_of_bounded_size(spark, tmp_path, monkeypatch):
    """A file of elements is one task's work, so a larger table makes more files."""
    from workload import queries

    monkeypatch.setattr(queries, "ELEMENTS_PER_FILE", 40)
    monkeypatch.setattr(queries.tables, "scratch_path", lambda _, label: str(tmp_path / label))
    found = queries.clinical_xml_struct(spark, "/root/testdata/sf0.001").collect()
    counts = [f.read_text().count("<brca:patient>") for f in (tmp_path / "elements").glob("part-*")]
    assert sum(counts) == sum(r.patients for r in found) == 150
    assert max(counts) <= 40
