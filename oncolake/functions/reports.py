"""Fields of a namespaced XML report.

A report is parsed once, by a namespace-aware parser over Arrow batches: XPath in the JVM knows
no namespaces, stops a job at a document that is no XML, and splits a text at a comment.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ABSENT = "N/A"
WELL_FORMED = "well_formed"


@dataclass(frozen=True)
class ReportField:
    """An element by name and namespace, at any depth below the root; `nested` asks for a
    parent that is not the root."""

    column: str
    name: str
    namespace: str
    nested: bool = False

    @property
    def path(self) -> str:
        return f"{'.//*/' if self.nested else './/'}{{{self.namespace}}}{self.name}"


# Element names and namespaces of the clinical reports.
CLINICAL_FIELDS = (
    ReportField(
        "disease_stage",
        "pathologic_stage",
        "http://tcga.nci/bcr/xml/clinical/shared/stage/2.7",
        nested=True,
    ),
    ReportField(
        "disease_type", "tumor_tissue_site", "http://tcga.nci/bcr/xml/clinical/shared/2.7"
    ),
    ReportField("gender", "gender", "http://tcga.nci/bcr/xml/shared/2.7"),
)


def _read(text: str | None, fields: tuple[ReportField, ...]) -> tuple:
    """Whether a text is one XML document, and the text of each field."""
    try:
        root = ElementTree.fromstring(text or "")
    except (ElementTree.ParseError, ValueError):
        return (False, *(None for _ in fields))
    found = (root.find(field.path) for field in fields)
    return (True, *(ABSENT if e is None else e.text for e in found))


def report_fields(
    document: Column, fields: tuple[ReportField, ...] = CLINICAL_FIELDS
) -> Column:
    """struct(well_formed, a text per field): 'N/A' where the element is absent, null where it
    is empty, or where the document is no XML.

    A field is the first element of its name and namespace, whatever its prefix; its text is
    what stands before its first child, comments aside.
    """
    schema = T.StructType([T.StructField(WELL_FORMED, T.BooleanType())])
    for field in fields:
        schema = schema.add(field.column, T.StringType())

    @F.pandas_udf(schema)
    def parse(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = [_read(text, fields) for text in texts]
            yield pd.DataFrame(rows, columns=schema.names)

    return parse(document)
