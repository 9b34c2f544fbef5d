"""The registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidescore.llm import (
    bpe_automaton,
    collocations,
    hilbert_search,
    merkle_manifest,
    packing,
    quality,
    rotated_codes,
    sentence_pieces,
    simhash,
    substring_dedup,
    toxicity,
    url_rules,
    warc_archive,
)
from tidescore.llm.bpe_text import default_path
from tidescore.session import scratch_path

#: Fixed values of the URL query: (verdict, host, path).
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "verdict string, host string, path string")
    return url_rules.judge(table(spark, sf_dir, "pages"), rules)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc_archive.write_archive(table(spark, sf_dir, "pages"), path)
    return warc_archive.read_records(spark, path).select(
        F.col("record_key").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def op1_hilbert_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_search.search(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove_duplicates(docs, window=35).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("text"), 256).alias("kept_sha256"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), folds=5, held_fold=0)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), folds=3, held_fold=1)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=3)


def op5_rotated_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotated_codes.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.95)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe_automaton.encode(table(spark, sf_dir, "documents"), default_path())
    return bpe_automaton.decode(encoded, default_path()).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("text"), 256).alias("decoded_sha256"),
    )


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), default_path(), size=1024, end_id=2)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collocations.best(collocations.mine(table(spark, sf_dir, "documents")), per_lang=2000)
    return found.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sentence_pieces.default_path()
    encoded = sentence_pieces.encode(table(spark, sf_dir, "documents"), path)
    return sentence_pieces.decode(encoded, path).select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text"), 256).alias("decoded_sha256"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), scratch_path(spark, "manifest")
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    changed = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, lowered).otherwise(F.col("text"))
    merkle_manifest.write_manifest(
        docs, path, ["doc_id", "source", "lang", "n_chars", "text"], presented={"text": changed})
    return merkle_manifest.audit(spark, path).withColumnRenamed("id", "doc_id")


def merkle_sql(leaf_steps: int = 6, top_steps: int = 3) -> str:
    """The manifest with every step of the trees written out: enough for 16**6 rows a source and 16**3 sources."""
    field = lambda c: f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
    head = " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [f"""
crc_table AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) AS c FROM range(256) r(i))),
docs AS (SELECT doc_id, coalesce(':' || source, '-') AS tree, {head} AS head, text, xor(4294967295::BIGINT,
    list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS crc FROM documents, crc_table),
leaves AS (SELECT row_number() OVER () AS rid, doc_id, tree, sha256(head || {field('text')}) AS leaf,
    sha256(head || CASE WHEN crc % 5 = 0 THEN {field(lowered)} ELSE {field('text')} END) AS shown FROM docs),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p FROM leaves),
n0 AS (SELECT tree, p, leaf AS d FROM placed),
f0 AS (SELECT rid, doc_id, leaf, tree, p, shown AS folded, '' AS proof FROM placed)"""]

    def step(k: int) -> None:
        """Siblings of every node, the next nodes, and the rows' paths, one step up; a lone node stays."""
        w = f"(PARTITION BY tree, p // 16 ORDER BY p ROWS BETWEEN "
        parts.append(f"""
s{k} AS (SELECT tree, p, d, count(*) OVER (PARTITION BY tree) = 1 AS alone,
    coalesce(string_agg(d, '') OVER {w}UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS x,
    coalesce(string_agg(d, '') OVER {w}1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS y FROM n{k}),
n{k + 1} AS (SELECT tree, p // 16 AS p, CASE WHEN any_value(alone) THEN any_value(d) ELSE sha256(string_agg(d, '' ORDER BY p)) END AS d
    FROM s{k} GROUP BY tree, p // 16),
f{k + 1} AS (SELECT rid, doc_id, leaf, f.tree, f.p // 16 AS p, CASE WHEN alone THEN folded ELSE sha256(x || folded || y) END AS folded,
    proof || x || y AS proof{', subroot' if k > leaf_steps else ''} FROM f{k} f JOIN s{k} s ON f.tree = s.tree AND f.p = s.p)""")

    for k in range(leaf_steps):
        step(k)
    # The trees' roots become the leaves of the one top tree.
    parts.append(f"""
roots AS (SELECT tree, d, row_number() OVER (ORDER BY tree) - 1 AS p FROM n{leaf_steps}),
n{leaf_steps + 1} AS (SELECT '' AS tree, p, d FROM roots),
f{leaf_steps + 1} AS (SELECT rid, doc_id, leaf, '' AS tree, r.p, folded, proof, d AS subroot FROM f{leaf_steps} f JOIN roots r ON f.tree = r.tree)""")
    for k in range(leaf_steps + 1, leaf_steps + 1 + top_steps):
        step(k)
    end = leaf_steps + 1 + top_steps
    return "WITH" + ",".join(parts) + f"""
SELECT doc_id, leaf, subroot, d AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = d AS verified
FROM f{end} JOIN n{end} USING (tree, p)
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_hilbert_search": op1_hilbert_search,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_simhash": op4_simhash,
    "op5_rotated_codes": op5_rotated_codes,
    "op6_bpe": op6_bpe,
    "op7_url_filters": op7_url_filters,
    "op8_warc": op8_warc,
    "op9_packing": op9_packing,
    "op10_quality": op10_quality,
    "op11_collocations": op11_collocations,
    "op12_sentencepiece": op12_sentencepiece,
    "op13_merkle_manifest": op13_merkle_manifest,
}

CHECKS: dict[str, str] = {
    "op11_collocations": """
WITH w AS (SELECT row_number() OVER () AS rid, coalesce(lang, 'und') AS lang, regexp_split_to_array(regexp_replace(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\\x0A-\\x0D]', ' ' || chr(10) || ' ', 'g'), '[ \\t]+') AS ws FROM documents),
flat AS (SELECT rid, lang, unnest(list_filter(ws, lambda x: x <> '')) AS word, generate_subscripts(list_filter(ws, lambda x: x <> ''), 1) AS pos FROM w),
occ AS (SELECT * FROM flat WHERE word <> chr(10)),
grams AS (SELECT lang, word AS w1, lead(word, 1) OVER o AS w2, lead(word, 2) OVER o AS w3, lead(word, 3) OVER o AS w4,
    pos, lead(pos, 1) OVER o AS a2, lead(pos, 2) OVER o AS a3, lead(pos, 3) OVER o AS a4 FROM occ WINDOW o AS (PARTITION BY rid ORDER BY pos)),
f AS (SELECT lang, ws, count(*) AS f FROM (
    SELECT lang, [w1] AS ws FROM grams
    UNION ALL SELECT lang, [w1, w2] FROM grams WHERE a2 = pos + 1
    UNION ALL SELECT lang, [w1, w2, w3] FROM grams WHERE a3 = pos + 2
    UNION ALL SELECT lang, [w1, w2, w3, w4] FROM grams WHERE a4 = pos + 3) GROUP BY lang, ws HAVING count(*) >= 30),
totals AS (SELECT lang, count(*) AS n FROM occ GROUP BY lang),
cand AS (SELECT * FROM f WHERE len(ws) > 1),
parts AS (SELECT lang, ws, f, unnest(range(1, len(ws))) AS k FROM cand),
cuts AS (SELECT p.lang, p.ws, p.f AS a, k, x.f AS l, y.f AS r, (2000000::HUGEINT * p.f) // (x.f + y.f) AS score
    FROM parts p JOIN f x ON x.lang = p.lang AND x.ws = p.ws[1 : k] JOIN f y ON y.lang = p.lang AND y.ws = p.ws[k + 1 :]
    QUALIFY row_number() OVER (PARTITION BY p.lang, p.ws ORDER BY score, k) = 1),
starts AS (SELECT lang, ws, f, unnest(range(1, len(ws))) AS i FROM cand),
inner_parts AS (SELECT lang, ws, f, i, unnest(range(i + 1, len(ws) + 1)) AS j FROM starts),
dropped AS (SELECT DISTINCT c.lang, c.ws FROM cand c JOIN inner_parts o
    ON o.lang = c.lang AND o.ws[o.i : o.j] = c.ws AND len(o.ws) > len(c.ws) AND 100 * o.f >= 80 * c.f)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(ws, ' ')) AS rank,
    array_to_string(ws, ' ') AS phrase, a, l, r, n, score::BIGINT AS score
FROM cuts ANTI JOIN dropped USING (lang, ws) JOIN totals USING (lang) QUALIFY rank <= 2000
""",
    "op13_merkle_manifest": merkle_sql(),
    "op2_substring_dedup": """
WITH w AS (SELECT row_number() OVER () AS rid, doc_id,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
starts AS (SELECT rid, ws, unnest(range(1, len(ws) - 33)) AS i FROM w),
copies AS (SELECT rid, i FROM starts QUALIFY count(*) OVER (PARTITION BY array_to_string(ws[i : i + 34], ' ')) > 1),
gone AS (SELECT DISTINCT rid, unnest(range(i, i + 35)) AS j FROM copies),
words AS (SELECT rid, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS j FROM w),
kept AS (SELECT rid, string_agg(word, ' ' ORDER BY j) AS kept FROM words ANTI JOIN gone USING (rid, j) GROUP BY rid),
lost AS (SELECT rid, count(*) AS n FROM gone GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(lost.n, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (rid) LEFT JOIN lost USING (rid)
""",
    "op5_rotated_codes": """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
    WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
    ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least ON vec_id = least.a LEFT JOIN counts ON vec_id = counts.a
""",
    "op7_url_filters": """
WITH rules(verdict, rhost, rpath) AS (VALUES """ + ", ".join(str(r) for r in URL_RULES) + """),
after AS (SELECT page_id, row_number() OVER () AS rid,
    CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS a FROM pages),
parts AS (SELECT page_id, rid,
    translate(regexp_extract(a, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(a, '^[^/?#]*([^?#]*)', 1) AS path FROM after),
fits AS (SELECT rid, rhost || rpath AS rule, verdict FROM parts JOIN rules
    ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
    QUALIFY row_number() OVER (PARTITION BY rid ORDER BY length(rhost || rpath) DESC, length(rhost) DESC) = 1)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN fits USING (rid)
""",
    "op8_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
h AS (SELECT page_id, body, sha1(body) AS x, max(page_id) OVER (PARTITION BY body) AS holder FROM p)
SELECT page_id, strlen(body)::BIGINT AS payload_bytes,
    array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + (((('0x' || substr(x, (5 * (i // 4) + 1)::BIGINT, 5))::INTEGER >> (5 * (3 - i % 4))::INTEGER) & 31)), 1)), '')
        AS payload_digest,
    CASE WHEN page_id IS NOT DISTINCT FROM holder THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id IS DISTINCT FROM holder THEN holder END AS refers_to
FROM h
""",
}
