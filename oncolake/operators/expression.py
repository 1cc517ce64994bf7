"""Expression ingest: lines of two-column text files to (case_id, gene_id, gene_expr).

A file is taken whole or not at all: one value that is no number, or one line that is no
valid text, rejects it. The text is read once, into a staged table that has the measures and the
bad lines of every file; what follows works on that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oncolake.functions.text import (
    is_number_field,
    is_positive,
    number_of_field,
    strip_version,
    unquote,
)
from oncolake.plans.joins import lookup_join


def _has_two_fields() -> Column:
    return F.contains("value", F.lit("\t"))


def _gene_field() -> Column:
    return F.substring_index("value", "\t", 1)


def _measure_field() -> Column:
    return F.substring_index(F.substring_index("value", "\t", 2), "\t", -1)


def _is_bad() -> Column:
    """Whether a line rejects its file. A single field is passed over, whatever it holds."""
    return ~F.is_valid_utf8("value") | (_has_two_fields() & ~is_number_field(_measure_field()))


def stage_lines(lines: DataFrame) -> DataFrame:
    """(filepath, gene_id, gene_expr, bad) of the lines that matter: the positive measures, and
    the bad lines, whatever they hold. Lines are (filepath, value)."""
    bad = F.coalesce(_is_bad(), F.lit(False))
    measure = F.when(_has_two_fields(), number_of_field(_measure_field()))
    # An empty id is stored as null.
    gene = F.nullif(strip_version(unquote(_gene_field())), F.lit(""))
    # The cheap test stands first: the pattern of a number is then matched once for a line.
    return lines.filter(F.coalesce(is_positive(measure), F.lit(False)) | bad).select(
        "filepath", gene.alias("gene_id"), measure.alias("gene_expr"), bad.alias("bad")
    )


def rejected_files(staged: DataFrame) -> DataFrame:
    """Files with at least one unreadable line, and how many such lines they have."""
    return staged.filter("bad").groupBy("filepath").agg(F.count(F.lit(1)).alias("bad_lines"))


def accepted_files(paths: DataFrame, rejected: DataFrame) -> DataFrame:
    """Listed files that are not among the rejected ones.

    Both sides hold one row per file, so they are joined as they are; adaptive execution copies
    the smaller if it turns out small.
    """
    bad = rejected.select("filepath").distinct()
    return lookup_join(paths, bad, ["filepath"], "left_anti", broadcast=False)


def ingest_expression(
    staged: DataFrame,
    paths: DataFrame,
    rejected: DataFrame | None = None,
    broadcast: bool | None = None,
) -> DataFrame:
    """Positive measures of all accepted files, for each case the file is listed for.

    `staged` is what `stage_lines` gave, stored: it is read twice unless `rejected` names the
    files to leave out, and that must cover `rejected_files(staged)`. The measures are not
    shuffled while the file list is small enough to copy. A larger one is joined as it is: the
    rows of a file are bounded by the file.
    """
    measures = staged.filter(~F.col("bad")).drop("bad")
    accepted = accepted_files(paths, rejected_files(staged) if rejected is None else rejected)
    joined = lookup_join(measures, accepted, ["filepath"], broadcast=broadcast)
    return joined.select("case_id", "gene_id", "gene_expr")


def clustered(expression: DataFrame) -> DataFrame:
    """Lay rows out by gene, so that file statistics let a reader skip other genes.

    Rows are rebalanced rather than repartitioned: a gene that holds too many rows for one
    task is cut into several files, and small ones share a file.
    """
    return expression.hint("rebalance", "gene_id").sortWithinPartitions("gene_id", "case_id")
