"""The queries of this subpackage and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..plans.registry import Entry, Tables
from . import bpe, exact, merkle, pfair, pii, repeats, rules, setsketch, toxicity, trie, vectors, warc, wavelet
from .common import Scratch

ENTRIES: dict[str, Entry] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Callable[[Tables], DataFrame]):
        ENTRIES[name] = Entry(name, (), lambda spark, d: fn(Tables(spark, d)), sql)
        return fn

    return add


def crc_mod(name: str, n: int):
    return F.crc32(F.col(name).cast("string").cast("binary")) % n


@query("op1_embedding_near_dedup")
def op1(t: Tables) -> DataFrame:
    return vectors.mark_near(t.embeddings)


@query("op2_exact_dedup", """
    WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, text_sha256
    FROM d WINDOW g AS (PARTITION BY text_sha256)""")
def op2(t: Tables) -> DataFrame:
    return exact.mark_copies(t.documents)


@query("op3_byte_bpe")
def op3(t: Tables) -> DataFrame:
    import public_tokenizers as vocabularies

    ranks = vocabularies.path("byte_bpe_50k.tiktoken")
    coded = bpe.encode(t.documents.select("doc_id", "text"), ranks, vocabularies.PATTERN).drop("text")
    coded = coded.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"))
    back = bpe.decode(coded, ranks)
    return back.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op4_warc", """
    WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
    q AS (SELECT page_id, octet_length(payload) AS payload_bytes, unhex(sha1(payload)) AS h, min(page_id) OVER (PARTITION BY payload) AS first FROM p),
    d AS (SELECT page_id, payload_bytes, first, CAST(h AS BIT)::VARCHAR AS bits FROM q)
    SELECT page_id, payload_bytes,
           list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               1 + list_aggregate(list_transform(range(5), lambda j: CAST(substr(bits, CAST(1 + 5 * i + j AS BIGINT), 1) AS INTEGER) * CAST(2 ** (4 - j) AS INTEGER)), 'sum')::INTEGER, 1)),
               'string_agg', '') AS payload_digest,
           CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
    FROM d""")
def op4(t: Tables) -> DataFrame:
    scratch = Scratch(t.spark, "warc")
    manifest = warc.write(t.pages, f"{scratch.base}/archive", scratch)
    return warc.read(t.spark, manifest, payload=False).drop("url")


@query("op5_pii")
def op5(t: Tables) -> DataFrame:
    docs = t.documents.select("doc_id", "text")
    found = pii.find(docs, pii.fit(docs, Scratch(t.spark, "pii")))

    def count(i):
        return F.size(F.filter("base", lambda s: s["rank"] == i)).cast("long")

    return found.select("doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(pii.KINDS)], F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans"))


@query("op6_setsketch_near_dedup")
def op6(t: Tables) -> DataFrame:
    return setsketch.mark_near(t.documents)


#: Target weights of the mix: the large source is held back, a few are preferred, the others count 2 each.
WEIGHTS = {"src0": 4, "src1": 6, "src2": 6, "src3": 3, "src4": 3} | {f"src{i}": 2 for i in range(5, 20)}


@query("op7_mix_sources")
def op7(t: Tables) -> DataFrame:
    placed = pfair.schedule(t.documents.select("doc_id", "source"), WEIGHTS)
    return placed.select(F.col("id").alias("doc_id"), "source", "block", "phase", "slot", "release", "deadline", "position")


@query("op8_quality_rules")
def op8(t: Tables) -> DataFrame:
    held = crc_mod("doc_id", 4) == 2
    model = rules.fit(t.documents, t.labels, allowed=crc_mod("id", 4) != 2)
    scored = rules.score(t.documents.select("doc_id", held.alias("held_out"), "text"), model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op9_substring_dedup")
def op9(t: Tables) -> DataFrame:
    return repeats.cut_repeats(t.documents, text=False).drop("repeats")


@query("op10_toxicity")
def op10(t: Tables) -> DataFrame:
    held = crc_mod("doc_id", 5) == 0
    model = toxicity.fit(t.documents, t.labels, allowed=crc_mod("id", 5) != 0)
    scored = toxicity.score(t.documents.select("doc_id", held.alias("held_out"), "text"), model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op11_wavelet_tokens")
def op11(t: Tables) -> DataFrame:
    import public_tokenizers as vocabularies

    scratch = Scratch(t.spark, "wavelet")
    manifest = wavelet.write(t.documents, f"{scratch.base}/shards", scratch, vocabularies.path("byte_bpe_50k.json"), vocabularies.PATTERN, end_id=2)
    return wavelet.read(t.spark, manifest, ids=False)


def document_leaves(docs: DataFrame) -> DataFrame:
    """Leaves of the Merkle manifest: (grp, id, leaf, tampered); a tampered row's n_chars is one more."""
    own = [merkle.field(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    more = F.coalesce(F.concat(F.octet_length((F.col("n_chars") + 1).cast("string")).cast("string"), F.lit(":"), (F.col("n_chars") + 1).cast("string")), F.lit("-"))
    tampered = F.when(crc_mod("doc_id", 7) == 0, merkle.leaf_hash(*own[:3], more, own[4]))
    return docs.select(F.col("lang").cast("string").alias("grp"), F.col("doc_id").cast("long").alias("id"), merkle.leaf_hash(*own).alias("leaf"), tampered.alias("tampered"))


@query("op12_merkle_manifest", """
    WITH RECURSIVE d AS (
        SELECT doc_id, lang, coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-')
               || coalesce(octet_length(encode(lang)) || ':' || lang, '-') AS head, n_chars, coalesce(octet_length(encode(text)) || ':' || text, '-') AS tail FROM documents),
    leaves AS (
        SELECT doc_id, lang, sha256(head || coalesce(length(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
               sha256(head || coalesce(length(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') || tail) AS tampered FROM d),
    placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM leaves),
    sub(lang, h, k, digest, n) AS (
        SELECT lang, 0, i, leaf, n FROM placed
        UNION ALL
        SELECT lang, h + 1, k // 2, sha256(string_agg(digest, '' ORDER BY k)), (any_value(n) + 1) // 2 FROM sub WHERE n > 1 GROUP BY lang, h, k // 2),
    subroots AS (SELECT lang, h AS height, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS j, count(*) OVER () AS m FROM sub WHERE n = 1),
    top(h, k, digest, m) AS (
        SELECT 0, j, subroot, m FROM subroots
        UNION ALL
        SELECT h + 1, k // 2, sha256(string_agg(digest, '' ORDER BY k)), (any_value(m) + 1) // 2 FROM top WHERE m > 1 GROUP BY h, k // 2),
    crc_rows AS (
        SELECT doc_id, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(length(CAST(doc_id AS VARCHAR))), lambda p: CAST(ascii(substr(CAST(doc_id AS VARCHAR), CAST(p + 1 AS BIGINT), 1)) AS BIGINT))),
               lambda a, b: list_reduce(list_prepend(xor(a, b), [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]), lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS crc FROM documents),
    crcs AS (SELECT DISTINCT doc_id, xor(crc, CAST(4294967295 AS BIGINT)) AS crc FROM crc_rows),
    steps AS (
        SELECT p.lang, p.i, s.h AS level, s.digest, s.k % 2 = 0 AS is_left FROM placed p JOIN subroots r ON p.lang IS NOT DISTINCT FROM r.lang
        JOIN sub s ON s.lang IS NOT DISTINCT FROM p.lang AND s.h < r.height AND s.k = xor(p.i >> s.h, 1)
        UNION ALL
        SELECT p.lang, p.i, r.height + t.h, t.digest, t.k % 2 = 0 FROM placed p JOIN subroots r ON p.lang IS NOT DISTINCT FROM r.lang
        JOIN top t ON t.m > 1 AND t.k = xor(r.j >> t.h, 1)),
    depth AS (SELECT r.*, r.height + (SELECT max(h) FROM top) AS levels FROM subroots r),
    proofs AS (SELECT lang, i, string_agg(digest, '' ORDER BY level) AS proof, map(list(level ORDER BY level), list(digest ORDER BY level)) AS at, map(list(level ORDER BY level), list(is_left ORDER BY level)) AS side FROM steps GROUP BY lang, i),
    folds(lang, i, level, levels, digest) AS (
        SELECT p.lang, p.i, 0, r.levels, CASE WHEN c.crc % 7 = 0 THEN p.tampered ELSE p.leaf END FROM placed p JOIN depth r ON p.lang IS NOT DISTINCT FROM r.lang LEFT JOIN crcs c ON c.doc_id = p.doc_id
        UNION ALL
        SELECT f.lang, f.i, f.level + 1, f.levels, sha256(CASE WHEN s.digest IS NULL THEN f.digest WHEN s.is_left THEN s.digest || f.digest ELSE f.digest || s.digest END)
        FROM folds f LEFT JOIN steps s ON s.lang IS NOT DISTINCT FROM f.lang AND s.i = f.i AND s.level = f.level WHERE f.level < f.levels)
    SELECT p.doc_id, p.leaf, r.subroot, t.digest AS root, sha256(coalesce(q.proof, '')) AS proof_sha256, f.digest AS folded_root, f.digest = t.digest AS verified
    FROM placed p JOIN depth r ON p.lang IS NOT DISTINCT FROM r.lang JOIN top t ON t.m = 1
    LEFT JOIN proofs q ON q.lang IS NOT DISTINCT FROM p.lang AND q.i = p.i
    JOIN folds f ON f.lang IS NOT DISTINCT FROM p.lang AND f.i = p.i AND f.level = f.levels""")
def op12(t: Tables) -> DataFrame:
    proved = merkle.prove(document_leaves(t.documents), Scratch(t.spark, "merkle"))
    return proved.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@query("op13_conversation_trie", """
    WITH o AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos, coalesce(role, '') AS role, coalesce(text, '') AS text
               FROM conversations WHERE conv_id IS NOT NULL),
    ids AS (SELECT DISTINCT c, CAST(c AS VARCHAR) AS s FROM o),
    crcs AS (SELECT c, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(length(s)), lambda p: CAST(ascii(substr(s, CAST(p + 1 AS BIGINT), 1)) AS BIGINT))),
                   lambda a, b: list_reduce(list_prepend(xor(a, b), [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]), lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)),
                   CAST(4294967295 AS BIGINT)) % 4 AS h FROM ids),
    turns AS (SELECT k.c, 0 AS part, o.pos, o.role, o.text FROM crcs k JOIN o ON o.c = k.c - k.c % 20 AND o.pos < k.h
              UNION ALL SELECT k.c, 1, o.pos, o.role, o.text FROM crcs k JOIN o ON o.c = k.c AND o.pos >= k.h),
    marked AS (SELECT c, part, pos, sha256(length(role) || ':' || role || text) AS id, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM turns),
    seqs AS (SELECT k.c, coalesce(list(m.id ORDER BY part, pos) FILTER (m.id IS NOT NULL), []) AS seq, coalesce(list(m.words ORDER BY part, pos) FILTER (m.id IS NOT NULL), []) AS w
             FROM crcs k LEFT JOIN marked m ON m.c = k.c GROUP BY k.c),
    prefixes AS (SELECT c, d, seq[1:d] AS p, len(seq) = d AS is_end, CASE WHEN d = 0 THEN 0 ELSE w[d] END AS last FROM seqs, unnest(range(len(seq) + 1)) AS u(d)),
    nodes AS (SELECT p, any_value(d) AS depth, min(c) AS conv_id, count(*) AS n_convs, any_value(last) AS last,
                     sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (is_end), '')) AS ends_sha256 FROM prefixes GROUP BY p),
    kids AS (SELECT p[1:depth - 1] AS p, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
    up AS (SELECT p[1:a] AS p, sum((n_convs - 1) * last) AS saved, count(*) FILTER (NOT EXISTS (SELECT 1 FROM kids k WHERE k.p = nodes.p)) AS leaves FROM nodes, unnest(range(depth + 1)) AS u(a) GROUP BY 1)
    SELECT n.conv_id, n.depth, CASE WHEN n.depth > 0 THEN q.conv_id END AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children, CAST(up.leaves AS BIGINT) AS n_leaves,
           CAST(up.saved AS BIGINT) AS saved_tokens, n.ends_sha256
    FROM nodes n JOIN up ON up.p = n.p LEFT JOIN kids k ON k.p = n.p LEFT JOIN nodes q ON n.depth > 0 AND q.p = n.p[1:n.depth - 1]""")
def op13(t: Tables) -> DataFrame:
    return trie.conversation_trie(t.conversations, Scratch(t.spark, "trie"))
