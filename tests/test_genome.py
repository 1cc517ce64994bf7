from __future__ import annotations

import gzip
import re
import tracemalloc

import pyarrow as pa
import pytest

from oncolake.operators import genome
from oncolake.sources import contents, files

PAD = " " * 21


def genbank(*blocks, tail="ORIGIN\n        1 acgtacgtac gtacgtacgt\n//\n"):
    head = "LOCUS       X 100 bp\nFEATURES             Location/Qualifiers\n"
    source = "     source          1..100\n" + PAD + '/organism="Species"\n'
    return head + source + "".join(blocks) + tail


def feature(key, location, *qualifiers):
    return f"     {key:<16}{location}\n" + "".join(f"{PAD}{q}\n" for q in qualifiers)


def gene(location, full_id, name=None, note=None):
    qualifiers = [f"/gene={full_id}"] if full_id else []
    if name:
        qualifiers.append(f'/locus_tag="{name}"')
    if note:
        qualifiers += note if isinstance(note, list) else [f'/note="{note}"']
    return feature("gene", location, *qualifiers)


def embl(text):
    """The same features in the other layout."""
    lines = []
    for line in text.splitlines():
        if line.startswith("     "):
            lines.append("FT" + line[2:])
        else:
            lines.append({"ORIGIN": "XX\nSQ   Sequence 20 BP;"}.get(line, line))
    return "ID   X\n" + "\n".join(lines) + "\n"


CHROMOSOME = genbank(
    gene("5..20", "G1.2", "ONE", "first gene [Source:S;Acc:1]"),
    feature("mRNA", "join(5..9,12..20)", "/gene=other", '/note="not mine"'),
    gene(
        "complement(30..40)",
        "G2.1",
        "TWO",
        ['/note="wrapped over', "lines like this", 'one [Source:S]"'],
    ),
    feature("5'UTR", "1..2", '/note="nor this"'),
    gene("<50..>60", "G3.1", "NO-POSITION"),
    gene("70..80", None, "NO-ID"),
    gene("complement(join(AC1.1:90..95,1..3))", "G4.1"),
    gene('100..110', '"G5.1"', "QUOTED"),
    gene("120..130", "G6.1", "LAST", "ends the file"),
)
MT = genbank(gene("7..9", "M1.1", "MT-A"))
LOOSE = genbank(gene("3..4", "L1.1", "LA"), tail="ORIGIN\n        1 ac\n//\n") + genbank(
    gene("complement(join(A:5..6))", "L2.1", "LB"), gene("9..9", "G1.2", "AGAIN")
)
NAMES = {
    "Species.B1.9.chromosome.14.dat.gz": CHROMOSOME,
    "Species.B1.9.chromosome.MT.dat.gz": MT,
    "Species.B1.9.nonchromosomal.dat.gz": LOOSE,
}
WANT = {
    "G1.2": ("G1", "AGAIN", "Non-chromosomal", "+", -1, -1, ""),
    "G2.1": ("G2", "TWO", "chromosome.14", "-", 30, 40,
             "wrapped over lines like this one [Source:S]"),
    "G4.1": ("G4", None, "chromosome.14", "-", 90, 95, ""),
    "G5.1": ("G5", "QUOTED", "chromosome.14", "+", 100, 110, ""),
    "G6.1": ("G6", "LAST", "chromosome.14", "+", 120, 130, "ends the file"),
    "M1.1": ("M1", "MT-A", "chromosome.MT", None, 7, 9, ""),
    "L1.1": ("L1", "LA", "Non-chromosomal", "+", -1, -1, ""),
    "L2.1": ("L2", "LB", "Non-chromosomal", "-", -1, -1, ""),
}


@pytest.fixture(params=["genbank", "embl"])
def parsed(request, spark, tmp_path):
    for name, text in NAMES.items():
        text = text if request.param == "genbank" else embl(text)
        (tmp_path / name).write_bytes(gzip.compress(text.encode()))
    (tmp_path / "notes.gz").write_bytes(gzip.compress(b"\n     gene            1..2\n"))
    return genome.parse_genes(files.read_genome_records(spark, str(tmp_path), request.param))


def test_reference(parsed):
    rows = genome.gene_reference(parsed).collect()
    assert {r.full_id: tuple(r)[1:] for r in rows} == WANT
    assert len(rows) == len(WANT)


def test_rejected_and_repeated(parsed):
    rejected = genome.rejected_genes(parsed).collect()
    assert sorted((r.full_id or "", r.name) for r in rejected) == [
        ("", "NO-ID"),
        ("G3.1", "NO-POSITION"),
    ]
    assert list(map(tuple, genome.repeated_genes(parsed).collect())) == [("G1.2", 2)]


def test_counts(parsed):
    reference = genome.gene_reference(parsed)
    counts = {r.chromosome: r.genes for r in genome.genes_per_chromosome(reference).collect()}
    assert counts == {"chromosome.14": 4, "chromosome.MT": 1, "Non-chromosomal": 3}
    assert genome.gene_count(reference).first().genes == 8


def test_plain_files_are_split(spark, tmp_path):
    """A record that spans the border of two splits is read once and whole."""
    blocks = [gene(f"{i}..{i + 9}", f"G{i}.1", f"N{i}", f"note {i}") for i in range(1, 3001)]
    (tmp_path / "S.1.chromosome.1.dat").write_text(genbank(*blocks))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        records = files.read_genome_records(spark, str(tmp_path), "genbank", "*.dat")
        assert records.rdd.getNumPartitions() > 5
        parsed = genome.parse_genes(records)
        got = {(r.full_id, r.name, r.info) for r in parsed.collect()}
        assert got == {(f"G{i}.1", f"N{i}", f"note {i}") for i in range(1, 3001)}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_file_list(spark, tmp_path):
    for name in ("a/x.dat.gz", "b/y.txt"):
        (tmp_path / name).parent.mkdir()
        (tmp_path / name).write_bytes(b"1234")
    listed = files.list_files(spark, str(tmp_path), "*.gz").collect()
    assert [(r.filepath, r.length) for r in listed] == [("a/x.dat.gz", 4)]


@pytest.mark.parametrize("layout", ["genbank", "embl"])
def test_streamed_records_are_those_of_the_plain_reader(spark, tmp_path, layout):
    for name, text in {**NAMES, "Species.B1.9.chromosome.3.dat.gz": "no gene\n"}.items():
        text = embl(text) if layout == "embl" else text
        (tmp_path / name).write_bytes(gzip.compress(text.encode()))
    both = [
        genome.parse_genes(reader(spark, str(tmp_path), layout)).collect()
        for reader in (files.read_genome_records, contents.read_genome_records)
    ]
    assert sorted(both[0], key=repr) == sorted(both[1], key=repr)
    assert both[0]
    values = contents.read_genome_records(spark, str(tmp_path), layout).select("value").collect()
    assert not any("acgt" in r.value or "//" in r.value for r in values)


@pytest.mark.parametrize("piece", [1, 2, 5, 11, 1000])
def test_records_at_ends_of_pieces(monkeypatch, piece):
    monkeypatch.setattr(contents, "_PIECE", piece)
    mark, ends = files.GENE_LINE["genbank"], files.SECTIONS
    for text in [*NAMES.values(), "", mark, mark + mark, "\n//" + mark + "a\n//b", "\n     gene"]:
        want = []
        for record in text.split(mark)[1:]:
            want.append(re.split("|".join(map(re.escape, ends)), record)[0].encode())
        stream = pa.BufferReader(text.encode())
        got = list(contents._records(stream, mark.encode(), [e.encode() for e in ends]))
        assert got == want


class Chromosome:
    """A stream of a gene and a sequence of a gigabyte."""

    def __init__(self):
        self.parts = 1024
        self.line = b"        1 " + b"acgtacgtac " * 6 + b"\n"

    def read(self, size):
        self.parts -= 1
        if self.parts == 1023:
            return b"HEAD\n     gene 1..2\n /gene=G1\nORIGIN\n"
        return (self.line * (size // len(self.line) + 1))[:size] if self.parts >= 0 else b""


def test_a_gigabyte_of_sequence_is_not_held():
    tracemalloc.start()
    try:
        ends = [e.encode() for e in files.SECTIONS]
        got = list(contents._records(Chromosome(), files.GENE_LINE["genbank"].encode(), ends))
        _, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert got == [b"1..2\n /gene=G1"]
    assert peak < 16 * 1024 * 1024
