"""Near copies against all pairs of five-word shingles."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from oncolake.llm import near_copies
from oncolake.llm.near_copies import deduplicate

SF = "/root/testdata/sf0.1"


def shingles(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\r\x0b\x0c":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4)))


def similar(a, b):
    return a == b or len(a & b) >= 0.8 * len(a | b)


def near_pairs(sets):
    """All pairs of distinct sets of similarity 0.8 or more. Two such sets share one of the
    rarest shingles of each, of which a fifth is enough."""
    known = {s: i for i, s in reversed(sets.items())}
    rare = Counter(g for s in known for g in s)
    lists, found = defaultdict(list), []
    for s, i in known.items():
        first = sorted(s, key=lambda g: (rare[g], g))[: len(s) - math.ceil(0.8 * len(s)) + 1]
        for other in {j for g in first for j in lists[g]}:
            if similar(sets[other], s):
                found.append((other, i))
        for g in first:
            lists[g].append(i)
    for i, s in sets.items():
        if known[s] != i:
            found.append((i, known[s]))
    return found


def brute(rows):
    """The smallest id of each component; `rows` are (id, text) of distinct ids."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in near_pairs(sets):
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {find(i) for i in sets}


def ids(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {r.doc_id for r in deduplicate(docs).collect()}


def words(rng, count, vocabulary=2000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(count)]


def test_given_documents(spark):
    """All pairs of sf0.1 are found, and nothing else goes."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = brute(rows)
    got = {r.doc_id for r in deduplicate(docs).collect()}
    assert got == want
    exact = len({t for _, t in rows})
    assert len(want) < exact - 30


def edited(rng, text, share):
    """A copy with words replaced, left out and put in, so that some of its shingles change."""
    out = list(text)
    for _ in range(max(1, int(share * len(text)))):
        k = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[k] = f"new{rng.randrange(10**6)}"
        elif kind == 1:
            del out[k]
        else:
            out.insert(k, f"new{rng.randrange(10**6)}")
    return out


def test_edited_copies(spark):
    """Scattered edits, and passages put before, behind and inside; recall of the pairs."""
    rng = random.Random(5)
    rows, n = [], 0
    for _ in range(300):
        text = words(rng, rng.randrange(40, 400))
        rows.append((n, " ".join(text)))
        kind = rng.randrange(3)
        if kind == 0:
            copy = edited(rng, text, 0.015)
        elif kind == 1:
            copy = text + words(rng, len(text) // 6)
        else:
            at = rng.randrange(len(text))
            copy = text[:at] + words(rng, len(text) // 8) + text[at:]
        rows.append((n + 1, " ".join(copy).upper()))
        n += 2
    want = brute(rows)
    got = ids(spark, rows)
    assert want <= got, "a document without a near copy is gone"
    gone = {i for i, _ in rows} - want
    assert len(gone) > 200
    assert len(gone - got) >= 0.95 * len(gone)


@pytest.mark.parametrize("group", [20_000, 40])
def test_group_of_copies_of_one_text(spark, monkeypatch, group):
    """Copies that are near the first text but not all near each other, under one entry in one
    task and dealt to pairs of blocks."""
    monkeypatch.setattr(near_copies, "GROUP", group)
    rng = random.Random(6)
    first = words(rng, 200)
    rows = [(0, " ".join(first))]
    rows += [(k, " ".join(edited(rng, first, 0.012))) for k in range(1, 150)]
    rows += [(1000 + k, " ".join(words(rng, 100))) for k in range(50)]
    assert ids(spark, rows) == brute(rows) == {0, *range(1000, 1050)}


def test_links_reach_the_middle_one():
    rng = np.random.default_rng(2)
    middle = rng.integers(-(2**63), 2**63 - 1)
    sketches = [middle]
    for _ in range(60):
        flips = rng.choice(64, 12, replace=False)
        sketches.append(np.int64(middle ^ sum(np.int64(1) << np.int64(f) for f in flips)))
    found = near_copies.links_of(np.array(sketches), np.arange(61))
    assert sum(link[1:] == (0, 60) for link in found) == 60


def test_fingerprint_in_slices(monkeypatch):
    text = [w.encode() for w in words(random.Random(1), 500)]
    whole = near_copies.fingerprint(text)
    monkeypatch.setattr(near_copies, "SLICE", 7)
    assert near_copies.fingerprint(text) == whole
    assert len(whole) == near_copies.PLACES + 8


def test_entries_share_no_place_within_a_shuffle():
    found = near_copies.places()
    assert found.shape == (near_copies.ENTRIES, near_copies.MATCHES)
    per = near_copies.PLACES // near_copies.MATCHES
    assert all(len(set(found[k : k + per].ravel())) == found[k : k + per].size
               for k in range(0, near_copies.ENTRIES, per))


def test_odd_rows(spark):
    """Null, empty and blank texts are copies of each other; so are equal words, however few."""
    long = " ".join(words(random.Random(3), 200_000))
    # Three distinct shingles, of which the other text has one more.
    few = "very long text " * 100_000
    rows = [
        (1, None), (2, ""), (3, " \n"), (4, "one"), (5, "ONE\n"), (6, "one two"), (7, "ünit"),
        (8, "ÜNIT"), (9, long), (10, long + " end"), (11, "one two three four five six"),
        (12, few), (13, few + "end"), (14, few.upper()),
    ]
    assert ids(spark, rows) == {1, 4, 6, 7, 8, 9, 11, 12, 13}


def test_repeated_ids_clashing_names_and_no_id(spark):
    columns = "doc_id long, text string, node string, __key int, hash int, u int"
    copy = "a copy of the text that stands there"
    rows = [
        (9, "other words in this one here", "x", 1, 2, 3),
        (9, copy, "x", 1, 2, 3),
        (3, copy, "y", 1, 2, 3),
        (3, copy, "x", 1, 2, 3),
        (None, copy, "x", 1, 2, 3),
        (None, copy, "x", 1, 2, 3),
    ]
    for order in (rows, rows[::-1]):
        got = deduplicate(spark.createDataFrame(order, columns).repartition(3)).collect()
        assert sorted(map(tuple, got), key=repr) == sorted(
            [(3, copy, "x", 1, 2, 3), rows[0], rows[4], rows[5]], key=repr
        )


def test_empty_table(spark):
    assert ids(spark, []) == set()


def test_near_pairs_that_neither_middle_nor_nearest_links(spark):
    """Two pairs of close copies that are near copies of each other, under an entry whose middle is
    another text: each one's nearest is its close copy."""
    rng = random.Random(9)
    a = words(rng, 200)
    d = a[18:] + words(rng, 18)
    texts = [words(rng, 150), a, a[:-1] + ["last"], d, d[:-1] + ["end"]]
    sketches = np.array([0, 0xFF, 0x1FF, 0xFF0000, 0x1FF0000])
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)]
    assert brute(rows) == {0, 1}
    found = near_copies.links_of(sketches, np.arange(5))
    assert not {(u, v) for u, v, _ in found} & {(u, v) for u in (1, 2) for v in (3, 4)}
    batch = pa.RecordBatch.from_arrays(
        [pa.array([7] * 5), pa.array(sketches), pa.array(range(5))], ["entry", "sketch", "node"]
    )
    out = [tuple(r.values()) for b in near_copies._meet([batch]) for r in b.to_pylist()]
    met = spark.createDataFrame(out, near_copies._FOUND)
    nodes = spark.createDataFrame(rows, "node long, text string")
    links = near_copies.candidates(met)
    held = near_copies.verified(links, near_copies.near_members(met), nodes)
    roots = {r.node: r.root for r in near_copies.components(held).collect()}
    assert set(roots) == {1, 2, 3, 4} and len(set(roots.values())) == 1


def test_crowd_of_near_texts_that_are_not_similar(spark, monkeypatch):
    """Copies with too many edits, all near each other by their sketches: what is verified at last
    grows with the texts, not with their pairs."""
    rng = random.Random(12)
    first = words(rng, 200)
    rows = [(k, " ".join(edited(rng, first, 0.035))) for k in range(300)]
    rows += [(1000, " ".join(first)), (1001, " ".join([*first[:-1], "last"]))]
    looked = []
    plain = near_copies._similar

    def counted(links, sets):
        met = sets.select("node").withColumnRenamed("node", "u")
        looked.append(links.join(met, "u").count())
        return plain(links, sets)

    monkeypatch.setattr(near_copies, "_similar", counted)
    assert ids(spark, rows) == brute(rows)
    assert len(brute(rows)) > 250
    assert looked[-1] < len(rows)


def test_similar_texts_that_share_no_entry(spark):
    """Each has a near text under an entry of its own."""
    rng = random.Random(13)
    a = words(rng, 200)
    texts = [a, [*a[:-1], "last"], words(rng, 200), words(rng, 200)]
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)]
    assert brute(rows) == {0, 2, 3}
    found = [(0, 2, 1, None), (0, 2, 0, None), (1, 3, 1, None), (1, 3, 0, None)]
    met = spark.createDataFrame(found, near_copies._FOUND)
    nodes = spark.createDataFrame(rows, "node long, text string")
    links, members = near_copies.candidates(met), near_copies.near_members(met)
    held = near_copies.verified(links, members, nodes)
    assert {tuple(sorted(r)) for r in held.collect()} == {(0, 1)}


def test_join_of_sets_is_exact(spark):
    """All similar pairs between groups, of sets from a few common words to many rare ones."""
    rng = random.Random(14)
    texts = []
    for _ in range(60):
        text = words(rng, rng.choice([3, 8, 30, 120, 1500]), rng.choice([2, 50, 2000]))
        texts += [text, edited(rng, text, 0.01), edited(rng, text, 0.03), text[: len(text) * 7 // 8]]
    distinct = sorted({" ".join(t) for t in texts if t})
    rows = list(enumerate(distinct))
    nodes = spark.createDataFrame(rows, "node long, text string")
    sets = nodes.mapInArrow(near_copies._sets, near_copies._SETS)
    want = {tuple(sorted(p)) for p in near_pairs({i: shingles(t) for i, t in rows})}
    joined = sorted(want)[::3]
    held = spark.createDataFrame(joined, "u long, v long")
    root = {r.node: r.root for r in near_copies.components(held).collect()}
    apart = {(u, v) for u, v in want if root.get(u, u) != root.get(v, v)}
    got = near_copies.near_between_groups(sets, held)
    found = {tuple(r) for r in near_copies._similar(got, sets).collect()}
    assert len(apart) > 20
    # Sets that are equal though their words are not are one in `near_pairs`.
    assert apart <= found
    assert all(similar(shingles(distinct[u]), shingles(distinct[v])) for u, v in found)
