"""Reference genome: gene records of annotated flat files to one row per gene."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oncolake.functions.text import regex_extract, strip_version
from oncolake.sources.files import SECTIONS

# The name part that holds the chromosome, the value where it is absent, the
# position of a gene on none, and the qualifiers of a gene.
CHROMOSOME = r"\.([a-z]+\.[0-9a-z]+)\.dat\.gz$"
NO_CHROMOSOME = "Non-chromosomal"
NO_POSITION = -1
STRANDLESS = "MT"
POSITION = r"([0-9]+)\.\.([0-9]+)"
GENE_ID = r'(?i)/gene="?([A-Z0-9.]+)'
GENE_NAME = r'/locus_tag="([^"]+)"'
GENE_NOTE = r'/note="([^"]*)"'

# The next feature key, at its fixed column, ends a block.
NEXT_FEATURE = r"\n(?:  |FT)   \S+ "
COLUMNS = (
    "full_id", "id", "name", "chromosome", "strand", "pos_start", "pos_end", "info",
)


def gene_blocks(records: DataFrame) -> DataFrame:
    """(file_name, location, block): the location line and qualifiers of each gene.

    A record is the text after the gene key. What stands before the first gene of a file is
    no block: it does not start with a blank, as what follows a key does. Annotations are cut off
    by plain search before any pattern sees the text: a record may hold a whole sequence.
    """
    annotations = reduce(
        lambda text, section: F.substring_index(text, section, 1), SECTIONS, F.col("value")
    )
    block = F.get(F.split(annotations, NEXT_FEATURE, 2), F.lit(0))
    one_line = F.regexp_replace(block, r"\r?\n(?:FT)?\s+", " ")
    return records.filter(F.startswith("value", F.lit(" "))).select(
        "file_name",
        F.regexp_extract(block, r"^ +(\S[^\r\n]*)", 1).alias("location"),
        one_line.alias("block"),
    )


def chromosome_of(file_name: Column) -> Column:
    """`chromosome.14` of a file name, or empty text."""
    return regex_extract(file_name, CHROMOSOME)


def strand_of(chromosome: Column, location: Column) -> Column:
    """Minus on the complement, else plus; mitochondrial genes have none."""
    return F.when(
        ~chromosome.contains(STRANDLESS),
        F.when(location.rlike("(?i)complement"), F.lit("-")).otherwise(F.lit("+")),
    )


def position_of(chromosome: Column, location: Column, end: bool) -> Column:
    """First position pair of a location; -1 off the chromosomes; null where there is none."""
    pair = F.regexp_extract(location, POSITION, 2 if end else 1)
    return F.when(chromosome == "", F.lit(NO_POSITION)).otherwise(pair.try_cast("int"))


def _qualifier(pattern: str) -> Column:
    return F.nullif(F.regexp_extract("block", pattern, 1), F.lit(""))


def parse_genes(records: DataFrame) -> DataFrame:
    """All gene blocks as reference rows, also those without id or position."""
    chromosome = F.col("_chromosome")
    full_id = F.col("full_id")
    return (
        gene_blocks(records)
        .withColumn("_chromosome", chromosome_of(F.col("file_name")))
        .withColumn("full_id", _qualifier(GENE_ID))
        .select(
            "full_id",
            strip_version(full_id).alias("id"),
            _qualifier(GENE_NAME).alias("name"),
            F.when(chromosome == "", F.lit(NO_CHROMOSOME)).otherwise(chromosome).alias(
                "chromosome"
            ),
            strand_of(chromosome, F.col("location")).alias("strand"),
            position_of(chromosome, F.col("location"), end=False).alias("pos_start"),
            position_of(chromosome, F.col("location"), end=True).alias("pos_end"),
            F.regexp_extract("block", GENE_NOTE, 1).alias("info"),
        )
    )


def _is_located() -> Column:
    return (
        F.col("full_id").isNotNull()
        & F.col("pos_start").isNotNull()
        & F.col("pos_end").isNotNull()
    )


def rejected_genes(parsed: DataFrame) -> DataFrame:
    """Blocks without id or position."""
    return parsed.filter(~_is_located())


def gene_reference(parsed: DataFrame) -> DataFrame:
    """The reference table: located genes, one row per full id, the first by position.

    Unlocated genes are passed over by the aggregate, not by a filter below it, which would
    have every pattern searched once more for each condition.
    """
    first = ["chromosome", "pos_start", "pos_end"]
    row = F.struct(*first, *(c for c in COLUMNS if c not in ("full_id", *first)))
    return (
        parsed.groupBy("full_id")
        .agg(F.min(F.when(_is_located(), row)).alias("_first"))
        .filter(F.col("_first").isNotNull())
        .select("full_id", "_first.*")
        .select(*COLUMNS)
    )


def repeated_genes(parsed: DataFrame) -> DataFrame:
    """Full ids that occur more than once among located genes."""
    return (
        parsed.filter(_is_located())
        .groupBy("full_id")
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter(F.col("rows") > 1)
    )


def genes_per_chromosome(genome: DataFrame) -> DataFrame:
    return genome.groupBy("chromosome").agg(F.count(F.lit(1)).alias("genes"))


def gene_count(genome: DataFrame) -> DataFrame:
    return genome.agg(F.count(F.lit(1)).alias("genes"))
