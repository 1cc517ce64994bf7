"""One query for each corpus operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oncolake.llm import (
    ann,
    bpe,
    decontaminate,
    language,
    merkle,
    packing,
    pii,
    prefix_trie,
    quality,
    secrets,
    simhash,
    token_counts,
    warc,
)
from oncolake.llm.shared import scratch, table, written

Query = Callable[[SparkSession, str], DataFrame]


def op1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector, among all vectors."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.nearest(vectors, vectors.filter(F.col("vec_id") % 20 == 0), k=20)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and the component that near fingerprints make."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        simhash.hex_of(F.col("fp")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record, written to archives and read back with payloads verified."""
    path = scratch(spark, "warc")
    warc.write(warc.page_records(table(spark, sf_dir, "pages"), "2024-01-01T00:00:00Z"), path)
    return warc.read(spark, path, payload="verify").select(
        warc.page_ids("record_id").alias("page_id"),
        "payload_bytes",
        F.regexp_replace("payload_digest", "^sha1:", "").alias("payload_digest"),
        "record_type",
        warc.page_ids("refers_to").alias("refers_to"),
    )


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the bytes they decode to, as digests."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = table(spark, sf_dir, "documents")
    return bpe.digest(docs, path, public_tokenizers.PATTERN, stable_input=True)


#: Stands in for a key that a deployment reads from its own store.
PSEUDONYM_KEY = "not-a-secret"


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with pseudonyms in place, and how many values of each kind they replace."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = pii.pseudonymize(docs, PSEUDONYM_KEY, counts="replaced")
    return done.select(
        "doc_id", "text", *(F.col("replaced")[k].alias(f"n_{k}") for k in pii.KINDS)
    )


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 40 shards of nearly equal size."""
    return packing.shard(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside passages of the benchmark."""
    found = decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return decontaminate.digest(found)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and whether they pass 1,024."""
    return token_counts.count_tokens(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.PATTERN,
    )


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, by the fixed patterns and the Markov models."""
    docs = table(spark, sf_dir, "documents")
    ratios = secrets.train(secrets.labelled_sample(docs))
    return secrets.digest(secrets.scan(docs, ratios))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three of four folds."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", language.held_out())
    sample = language.labelled_sample(docs.filter(~F.col("held_out")))
    return language.predict_language(docs, sample, keep=("held_out",))


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from the labels of two of three folds."""
    held_out = quality.held_out(F.col("doc_id"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(~held_out)
    scored = quality.scores(docs, quality.train(docs.filter(~held_out), labels))
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the manifest, with some documents changed after it was made."""
    docs = table(spark, sf_dir, "documents")
    fields = ("doc_id", "source", "lang", "n_chars", "text")
    own = {name: F.col(name) for name in fields}
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    # One more than the largest long does not fit a long.
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    met = own | {"n_chars": F.when(changed, more).otherwise(F.col("n_chars").cast("string"))}
    records = docs.select(
        "doc_id",
        F.col("lang").alias("group"),
        merkle.record_digest(*own.values()).alias("digest"),
        merkle.record_digest(*met.values()).alias("claim"),
    )
    return merkle.proofs(merkle.manifest(records, "doc_id")).select(
        F.col("id").cast("long").alias("doc_id"),
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        merkle.proof_digest(F.col("proof")).alias("proof_sha256"),
        "folded_root",
        "verified",
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, whose first turns are those of every hundredth one."""
    rows = written(prefix_trie.turns(table(spark, sf_dir, "conversations")), "turns")
    base = F.col("conv") - F.col("conv") % 100
    head = F.crc32(F.col("conv").cast("string").cast("binary")) % 6
    return prefix_trie.trie(prefix_trie.with_shared_heads(rows, base, head))


QUERIES: dict[str, Query] = {
    "op1_nearest": op1_nearest,
    "op2_simhash": op2_simhash,
    "op3_warc": op3_warc,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_pii": op5_pii,
    "op6_sharding": op6_sharding,
    "op7_decontamination": op7_decontamination,
    "op8_token_counts": op8_token_counts,
    "op9_secrets": op9_secrets,
    "op10_language_id": op10_language_id,
    "op11_quality": op11_quality,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_prefix_trie": op13_prefix_trie,
}

_WORDS = (
    "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

# Base32 by groups of 20 bits: five hexadecimal digits are four of base32.
_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
    f"CAST((CAST('0x' || substr(h, {5 * k + 1}, 5) AS BIGINT) >> {shift}) & 31 AS INTEGER) + 1, 1)"
    for k in range(8)
    for shift in (15, 10, 5, 0)
)

# The 256 remainders of CRC-32, from their rule.
_CRC_TABLE = """
        crc_steps AS (
            SELECT i, i AS v, 0 AS k FROM range(256) s(i)
            UNION ALL
            SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1
            FROM crc_steps WHERE k < 8
        ),
        crc_table AS (SELECT list(v ORDER BY i) AS t FROM crc_steps WHERE k = 8)"""


def _crc32(column: str) -> str:
    """Unsigned CRC-32 of a column's decimal text, in a query that joins crc_table."""
    codes = f"list_transform(string_split({column}::VARCHAR, ''), lambda c: ascii(c)::BIGINT)"
    step = "lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, {codes}), {step}))"


def _record(n_chars: str) -> str:
    fields = ("doc_id", "source", "lang", n_chars, "text")
    parts = (f"coalesce(strlen({f}::VARCHAR) || ':' || {f}::VARCHAR, '-')" for f in fields)
    return f"sha256({' || '.join(parts)})"


def _trees(name: str, leaves: str) -> str:
    """Nodes (g, k, i, h) of the trees g over (g, i, h), level by level up to the roots."""
    return f"""
        {name} AS (
            SELECT g, 0 AS k, i, h FROM {leaves}
            UNION ALL
            SELECT g, k + 1, i // 2, sha256(string_agg(h, '' ORDER BY i))
            FROM (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM {name}) WHERE n > 1
            GROUP BY g, k, i // 2
        )"""


def _beside(trees: str, leaves: str, key: str, first: int) -> str:
    """What stands beside the way of each leaf, by level, counted from `first`."""
    return f"""
            SELECT l.{key}, p.k + {first} AS k,
                   {{'s': CASE WHEN b.h IS NULL THEN '' WHEN b.i < p.i THEN '<' ELSE '>' END,
                     'h': coalesce(b.h, '')}} AS beside
            FROM {leaves} l JOIN {trees} p ON p.g = l.g AND p.i = l.i >> p.k
            JOIN (SELECT g, max(k) AS top FROM {trees} GROUP BY g) m ON m.g = l.g AND p.k < m.top
            LEFT JOIN {trees} b ON b.g = p.g AND b.k = p.k AND b.i = xor(p.i, 1)"""


ORACLES: dict[str, str] = {
    "op3_warc": f"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
        k AS (SELECT body, max(page_id) AS first FROM p GROUP BY body),
        d AS (
            SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS h,
                   CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
            FROM p JOIN k USING (body)
        )
        SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
               CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
               refers_to
        FROM d
    """,
    "op7_decontamination": f"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS}, []) AS w FROM documents
        ),
        b AS (
            SELECT item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL
        ),
        n AS (SELECT item_id, w, least(len(w), 10) AS k FROM b WHERE len(w) > 0),
        grams AS (
            SELECT DISTINCT item_id, k, array_to_string(w[i : i + k - 1], ' ') AS g
            FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM n)
        ),
        places AS (
            SELECT r, k, i, array_to_string(w[i : i + k - 1], ' ') AS g
            FROM (
                SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i
                FROM d, (SELECT DISTINCT k FROM grams) WHERE len(w) >= k
            )
        ),
        hits AS (SELECT r, i, k, item_id FROM places JOIN grams USING (k, g)),
        covered AS (
            SELECT r, count(DISTINCT place) AS n
            FROM (SELECT r, unnest(range(i, i + k)) AS place FROM hits) GROUP BY r
        ),
        items AS (
            SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS listed
            FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY r
        )
        SELECT doc_id, len(w) AS n_words, coalesce(covered.n, 0) AS n_hit,
               coalesce(items.n, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
               covered.n IS NOT NULL AS contaminated
        FROM d LEFT JOIN covered USING (r) LEFT JOIN items USING (r)
    """,
    "op12_merkle_manifest": f"""
        WITH RECURSIVE {_CRC_TABLE},
        records AS (
            SELECT row_number() OVER () AS r, doc_id, coalesce('=' || lang, '-') AS g,
                   {_record("n_chars")} AS h,
                   CASE WHEN {_crc32("doc_id")} % 7 = 0
                        THEN {_record("(n_chars::HUGEINT + 1)")} END AS changed
            FROM documents, crc_table
        ),
        leaves AS (
            SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS i
            FROM records
        ),
        {_trees("nodes", "leaves")},
        subroots AS (SELECT g, arg_max(h, k) AS h FROM nodes GROUP BY g),
        heads AS (
            SELECT '*' AS g, g AS name, h, row_number() OVER (ORDER BY g) - 1 AS i FROM subroots
        ),
        {_trees("upper", "heads")},
        upper_ways AS ({_beside("upper", "heads", "name", 1000)}),
        beside AS (
            {_beside("nodes", "leaves", "r", 0)}
            UNION ALL
            SELECT r, k, beside FROM leaves JOIN upper_ways ON name = g
        ),
        ways AS (SELECT r, list(beside ORDER BY k) AS way FROM beside GROUP BY r),
        proved AS (
            SELECT doc_id, l.h AS leaf, s.h AS subroot, (SELECT arg_max(h, k) FROM upper) AS root,
                   coalesce(way, []) AS way, coalesce(changed, l.h) AS claim
            FROM leaves l JOIN subroots s USING (g) LEFT JOIN ways USING (r)
        ),
        folded AS (
            SELECT *, list_reduce(
                list_prepend({{'s': '', 'h': claim}}, way),
                lambda a, b: {{'s': '', 'h': sha256(CASE b.s WHEN '<' THEN b.h || a.h
                                                   WHEN '>' THEN a.h || b.h ELSE a.h END)}}
            ).h AS folded_root
            FROM proved
        )
        SELECT doc_id, leaf, subroot, root,
               sha256(array_to_string(list_transform(way, lambda w: w.h), '')) AS proof_sha256,
               folded_root, folded_root = root AS verified
        FROM folded
    """,
    "op13_prefix_trie": f"""
        WITH RECURSIVE {_CRC_TABLE},
        own AS (
            SELECT conv_id AS c, list({{'d': d, 'n': n}} ORDER BY turn NULLS FIRST, d) AS turns
            FROM (
                SELECT conv_id, turn, length(coalesce(text, '')) AS n,
                       sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '')
                              || coalesce(text, '')) AS d
                FROM conversations WHERE conv_id IS NOT NULL
            ) GROUP BY conv_id
        ),
        heads AS (SELECT c, c - c % 100 AS base, {_crc32("c")} % 6 AS h FROM own, crc_table),
        rebuilt AS (
            SELECT o.c, list_concat(coalesce(b.turns[1:h], []), o.turns[h + 1:]) AS turns
            FROM own o JOIN heads USING (c) LEFT JOIN own b ON b.c = base
        ),
        paths AS (
            SELECT c, len(turns) AS size, unnest(range(len(turns) + 1)) AS depth, turns
            FROM rebuilt
        ),
        named AS (
            SELECT c, depth, depth = size AS ends, turns[depth].n AS chars,
                   array_to_string(list_transform(turns[1:depth], lambda t: t.d), '') AS name
            FROM paths
        ),
        nodes AS (
            SELECT name, depth, min(c) AS conv_id, count(*) AS n, any_value(chars) AS chars,
                   string_agg(c, ',' ORDER BY c) FILTER (WHERE ends) AS ids
            FROM named GROUP BY name, depth
        ),
        linked AS (
            SELECT v.*, p.conv_id AS parent_conv_id, p.name AS parent
            FROM nodes v LEFT JOIN nodes p
            ON p.depth = v.depth - 1 AND p.name = v.name[1 : 64 * (v.depth - 1)]
        ),
        children AS (SELECT parent, count(*) AS n FROM linked WHERE depth > 0 GROUP BY parent),
        sums AS (
            SELECT u.name, sum((v.n - 1) * coalesce(v.chars, 0)) AS saved,
                   count(*) FILTER (WHERE k.n IS NULL) AS leaves
            FROM nodes u JOIN nodes v ON v.depth >= u.depth AND v.name[1 : 64 * u.depth] = u.name
            LEFT JOIN children k ON k.parent = v.name
            GROUP BY u.name
        )
        SELECT l.conv_id, l.depth, parent_conv_id, l.n AS n_convs,
               coalesce(k.n, 0) AS n_children, leaves AS n_leaves,
               saved::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
        FROM linked l JOIN sums USING (name) LEFT JOIN children k ON k.parent = l.name
    """,
}
