"""The trie against plain dictionaries of prefixes."""

from __future__ import annotations

import random
import zlib
from hashlib import sha256

import pytest

from oncolake.llm import prefix_trie
from oncolake.llm.queries import ORACLES, op13_prefix_trie

SF = "/root/testdata/sf0.01"
COLUMNS = [
    "conv_id",
    "depth",
    "parent_conv_id",
    "n_convs",
    "n_children",
    "n_leaves",
    "saved_tokens",
    "ends_sha256",
]


def rebuilt(rows):
    """The contract's conversations, from rows (conv_id, turn, role, text)."""

    def key(row):
        role, text = row[2] or "", row[3] or ""
        digest = sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
        return (row[1] is not None, row[1] or 0, digest)

    own = {}
    for row in sorted((r for r in rows if r[0] is not None), key=key):
        own.setdefault(row[0], []).append((row[2] or "", row[3] or ""))
    heads = {c: zlib.crc32(str(c).encode()) % 6 for c in own}
    return {c: own.get(c - c % 100, [])[: heads[c]] + own[c][heads[c] :] for c in own}


def plain(convs):
    members, ends = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    out = []
    for node, held in members.items():
        below = [v for v in members if v[: len(node)] == node]
        children = [v for v in below if len(v) == len(node) + 1]
        parents = {v[:-1] for v in members if v}
        out.append(
            (
                min(held),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(held),
                len(children),
                sum(v not in parents for v in below),
                sum((len(members[v]) - 1) * len(v[-1][1]) for v in below if v),
                sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


def result(spark, tmp_path, rows):
    schema = "conv_id long, turn long, role string, text string, place int, digest string"
    data = [(*r, 3, "x") for r in rows]
    spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/conversations.parquet")
    found = op13_prefix_trie(spark, str(tmp_path))
    assert found.columns == COLUMNS
    return sorted((tuple(r) for r in found.collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_random_conversations(spark, tmp_path, seed):
    """Few different turns, so that conversations share prefixes of all lengths."""
    rng = random.Random(seed)
    rows = []
    for c in range(0, 420, rng.choice([1, 7, 20])):
        for t in range(rng.choice([0, 1, 2, 4, 5, 8, 9, 13])):
            rows.append((c, t, rng.choice("ua"), rng.choice(["", "a", "bb", "ü€"])))
    rng.shuffle(rows)
    assert result(spark, tmp_path, rows) == plain(rebuilt(rows))


def test_nulls_ties_and_long_texts(spark, tmp_path):
    rows = [
        (None, 0, "user", "no conversation"),
        (100, None, None, None),
        (100, 0, "user", None),
        (100, 0, "user", ""),
        (100, 0, "user", "tie"),
        (101, 5, "user", "a" * 1_000_000),
        (101, 5, "user", "a" * 1_000_000),
        (155, 1, None, "without a role"),
        (-7, 1, "user", "below zero"),
        (205, 0, "user", "base is missing"),
        *((300 + c, t, "user", "same") for c in range(60) for t in range(9)),
        *((700 + c, t, "user", f"{c if t else 0}") for c in range(60) for t in range(9)),
    ]
    # -7 - (-7 % 100) is 0 in SQL, whose remainder has the sign of the dividend, and has no turns.
    want = rebuilt([r for r in rows if r[0] != -7])
    head = zlib.crc32(b"-7") % 6
    want[-7] = [("user", "below zero")][head:]
    assert result(spark, tmp_path, rows) == plain(want)


def test_role_and_text_do_not_run_together(spark, tmp_path):
    rows = [(200, 0, "ab", "c"), (300, 0, "a", "bc")]
    assert len(result(spark, tmp_path, rows)) == len(plain(rebuilt(rows)))


def test_long_shared_conversations(spark):
    """More rounds and blocks than the given tables need."""
    convs = {c: [("u", f"{t}" if t < 30 + c % 7 else f"{c}-{t}") for t in range(45)] for c in range(9)}
    rows = [
        (c, t, sha256(repr(turn).encode()).hexdigest(), len(turn[1]))
        for c, turns in convs.items()
        for t, turn in enumerate(turns)
    ]
    given = spark.createDataFrame(rows, "conv long, place int, digest string, chars long")
    found = prefix_trie.trie(given)
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain(convs)


def test_ids_of_many_ranges(spark):
    """All end at one node, whose ids lie in several ranges, below zero too."""
    ids = [-5000, -1, 0, 1, 4095, 4096, 10_000, 1 << 40]
    given = spark.createDataFrame(
        [(c, 0, "d", 3) for c in ids], "conv long, place int, digest string, chars long"
    )
    found = {r.depth: r for r in prefix_trie.trie(given).collect()}
    want = sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    assert found[1].ends_sha256 == want
    assert (found[0].saved_tokens, found[0].n_leaves, found[1].n_convs) == (21, 1, 8)


def test_empty_table(spark, tmp_path):
    assert result(spark, tmp_path, []) == []


def test_matches_sql(spark, duck):
    got = op13_prefix_trie(spark, SF)
    want = duck.execute(ORACLES["op13_prefix_trie"])
    assert got.columns == [c[0] for c in want.description] == COLUMNS
    rows = sorted((tuple(r) for r in got.collect()), key=str)
    assert rows == sorted(want.fetchall(), key=str)
    assert any(r[3] > 1 and r[1] > 1 for r in rows)
