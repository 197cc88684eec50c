"""Registered queries of the operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetdoc.llm import decontaminate, embedding_dedup, hard_negatives, jaccard_join, language_id, merkle, mixing, passages, pii, suffix_dedup, token_counts, url_filter, warc

OVER_TOKENS = 2048


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id", "source", mixing.word_count().alias("size"), mixing.shuffle_key().alias("key"),
    )
    return mixing.mix(docs).select(
        "doc_id", "size", F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"),
        (F.col("size") * F.col("mix_copies")).alias("taken"),
    )


OP1_SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
         CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS size,
         md5(concat_ws('|', 'mix', CAST(doc_id AS VARCHAR), text)) AS key
  FROM documents
), per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank
  FROM sized GROUP BY source
), weighted AS (
  SELECT *, [5, 2, 1][1 + (rank - 1) % 3] AS weight, CAST(sum(source_size) OVER () AS BIGINT) AS total,
         3 * source_size AS cap
  FROM per
), filled AS (
  SELECT *, cap / weight AS fill,
         (total - coalesce(CAST(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0))
         / CAST(sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS lv
  FROM weighted
), levelled AS (
  SELECT *, max(lv) OVER () AS level FROM filled
), queued AS (
  SELECT s.doc_id, s.size, s.key, l.*,
         CAST(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key) AS BIGINT) AS done
  FROM sized s JOIN levelled l ON s.source IS NOT DISTINCT FROM l.source
), copies AS (
  SELECT *, CAST(sum(size) OVER (ORDER BY (done + e * source_size) / weight, rank, key) AS BIGINT) AS running
  FROM queued CROSS JOIN (VALUES (0), (1), (2)) AS epochs(e)
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size,
       CASE WHEN fill <= level THEN CAST(cap AS DOUBLE) ELSE level * weight END AS target,
       CAST(sum(CASE WHEN running <= total THEN size ELSE 0 END) AS BIGINT) AS taken
FROM copies GROUP BY doc_id, size, key, source_size, cap, fill, level, weight
"""


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))
    return counted.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens", (F.col("n_tokens") > OVER_TOKENS).alias("over_limit"),
    )


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_join.similar_components(docs, k=4, num=85, den=100)


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') END AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, list_slice(w, p, p + least(4, len(w)) - 1) AS shingle
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - least(4, len(w)) + 1)) AS p FROM d WHERE len(w) > 0) t
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), pair AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2
), link AS (
  SELECT x, y FROM pair JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * o >= 85 * (nx.n + ny.n - o)
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM n
  UNION
  SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x
), component AS (
  SELECT x, min(y) AS least FROM reach GROUP BY x
)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(component.least, d.doc_id) AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN component ON component.x = d.doc_id
"""

OP9_SQL = """
WITH h AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS hx FROM documents
), spot AS (
  SELECT doc_id, hx, unnest(generate_series(0, CAST(length(hx) / 2 AS BIGINT) - 50)) AS p FROM h WHERE length(hx) >= 100
), piece AS (
  SELECT doc_id, p, md5(substring(hx, 2 * p + 1, 100)) AS s FROM spot
), least AS (
  SELECT s, min(doc_id) AS first FROM piece GROUP BY s
), hit AS (
  SELECT doc_id, p, max(p) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
  FROM piece JOIN least USING (s) WHERE first < doc_id
), run AS (
  SELECT doc_id, p, sum(CASE WHEN before IS NULL OR p > before + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS r FROM hit
), span AS (
  SELECT doc_id, r, min(p) AS a, max(p) + 50 AS b FROM run GROUP BY doc_id, r
), gap AS (
  SELECT doc_id, coalesce(lag(b) OVER w, 0) AS a, a AS b FROM span WINDOW w AS (PARTITION BY doc_id ORDER BY a)
  UNION ALL SELECT doc_id, max(b), NULL FROM span GROUP BY doc_id
), kept AS (
  SELECT gap.doc_id, string_agg(CASE WHEN b IS NULL THEN substring(hx, 2 * a + 1) ELSE substring(hx, 2 * a + 1, 2 * (b - a)) END, '' ORDER BY a) AS hx
  FROM gap JOIN h ON h.doc_id = gap.doc_id GROUP BY gap.doc_id
), total AS (
  SELECT doc_id, sum(b - a) AS n, count(*) AS c FROM span GROUP BY doc_id
)
SELECT h.doc_id, CAST(length(h.hx) / 2 AS BIGINT) AS n_bytes, CAST(coalesce(total.n, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(total.c, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept.hx, h.hx))) AS kept_sha256
FROM h LEFT JOIN total ON total.doc_id = h.doc_id LEFT JOIN kept ON kept.doc_id = h.doc_id
"""

OP10_SQL = rf"""
WITH d AS (
  SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') END AS w FROM documents
), i AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL
), win AS (
  SELECT DISTINCT item_id, k, list_slice(w, p, p + k - 1) AS words
  FROM (SELECT item_id, w, least(13, len(w)) AS k, unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) AS p FROM i WHERE len(w) > 0) t
), pos AS (
  SELECT doc_id, k, p, list_slice(w, p, p + k - 1) AS words
  FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS p FROM d CROSS JOIN (SELECT DISTINCT k FROM win) ks WHERE len(w) >= k) t
), found AS (
  SELECT pos.doc_id, pos.k, pos.p, win.item_id FROM pos JOIN win ON pos.k = win.k AND pos.words = win.words
), hit AS (
  SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(generate_series(p, p + k - 1)) AS q FROM found) t GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM found WHERE item_id IS NOT NULL) t GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(items.names, '')) AS items_sha256,
       coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id
"""

URL_RULES = [
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
    ("allow", "com/fr/"), ("block", "com/de/"),
]


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "score")


def op5_fuzzy_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_personal_data(docs, pii.train(docs))
    base = F.filter("pii", lambda s: s["kind"].isin(*pii.KINDS))

    def count(kind: str):
        return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, pii.KINDS), F.sha2(pii.joined(base), 256).alias("base_sha256"),
        pii.joined(F.col("pii")).alias("spans"),
    )


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.train(docs.where(language_id.fold() != 0))
    return language_id.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", (language_id.fold() == 0).alias("held_out"),
        F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"),
    )


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = suffix_dedup.remove_repeats(docs)
    lengths = F.aggregate("repeats.removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return cut.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), lengths.alias("n_removed"),
        F.size("repeats.removed").cast("long").alias("n_spans"), F.sha2("repeats.kept", 256).alias("kept_sha256"),
    )


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_benchmark(docs, _table(spark, sf_dir, "benchmark"))
    names = F.array_join(F.array_sort(F.transform("benchmark_hits.items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id", F.col("benchmark_hits.n_words").alias("n_words"), F.col("benchmark_hits.n_hit").alias("n_hit"),
        F.size("benchmark_hits.items").cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"),
        decontaminate.is_contaminated().alias("contaminated"),
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    text = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = {"text": F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, text)}
    return merkle.prove(merkle.build(docs, changed=tampered)).select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def _op11_sql(levels: int = 8) -> str:
    """Trees of up to 16 ** levels leaves; each level is one query."""
    def field(c: str) -> str:
        return f"coalesce(CAST(octet_length(encode(CAST({c} AS VARCHAR))) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"

    def hashed(text: str) -> str:
        return "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars")) + f" || {field(text)})"

    def tree(name: str) -> list[str]:
        """Levels {name}1.. over {name}0 (tree, pos, n, d), and {name}top: the last node of each tree."""
        ups = [
            f"{name}{k} AS (SELECT tree, pos // 16 AS pos, (n + 15) // 16 AS n, sha256(string_agg(d, '' ORDER BY pos)) AS d "
            f"FROM {name}{k - 1} WHERE n > 1 GROUP BY tree, pos // 16, n)" for k in range(1, levels + 1)
        ]
        last = " UNION ALL ".join(f"SELECT tree, d FROM {name}{k} WHERE n = 1" for k in range(levels + 1))
        return [*ups, f"{name}top AS ({last})"]

    def fold(out: str, start: str, name: str) -> list[str]:
        """Fold (id, tree, at, d, proof) of ``start`` through the levels of ``name`` into ``out``."""
        ctes, before = [], start
        for k in range(levels):
            ctes.append(
                f"{out}{k} AS (SELECT f.id, f.tree, f.at // 16 AS at, CASE WHEN any_value(s.n) > 1 THEN "
                f"sha256(string_agg(CASE WHEN s.pos = f.at THEN f.d ELSE s.d END, '' ORDER BY s.pos)) ELSE any_value(f.d) END AS d, "
                f"any_value(f.proof) || CASE WHEN any_value(s.n) > 1 THEN coalesce(string_agg(s.d, '' ORDER BY s.pos) FILTER (WHERE s.pos <> f.at), '') ELSE '' END AS proof "
                f"FROM {before} f LEFT JOIN {name}{k} s ON s.tree = f.tree AND s.pos // 16 = f.at // 16 GROUP BY f.id, f.tree, f.at)")
            before = f"{out}{k}"
        return ctes

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    crc = (f"xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))), "
           f"lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda v, i: xor(v >> 1, 3988292384 * (v & 1)))))")
    last = levels - 1
    ctes = [
        f"rows AS (SELECT row_number() OVER () AS id, doc_id, coalesce('=' || source, '') AS tree, {hashed('text')} AS leaf, "
        f"CASE WHEN {crc} % 5 = 0 AND text IS NOT NULL THEN {hashed(lower)} END AS other FROM documents)",
        "placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM rows)",
        "g0 AS (SELECT tree, pos, n, leaf AS d FROM placed)", *tree("g"),
        "t0 AS (SELECT 'all' AS tree, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, count(*) OVER () AS n, d, tree AS name FROM gtop)", *tree("t"),
        "start AS (SELECT id, tree, pos AS at, coalesce(other, leaf) AS d, '' AS proof FROM placed)", *fold("f", "start", "g"),
        f"mid AS (SELECT f{last}.id, 'all' AS tree, t0.pos AS at, f{last}.d, f{last}.proof FROM f{last} JOIN t0 ON t0.name = f{last}.tree)", *fold("u", "mid", "t"),
    ]
    return ("WITH " + ",\n".join(ctes) + f"""
SELECT p.doc_id, p.leaf, gtop.d AS subroot, ttop.d AS root, sha256(u{last}.proof) AS proof_sha256, u{last}.d AS folded_root, u{last}.d = ttop.d AS verified
FROM placed p JOIN gtop ON gtop.tree = p.tree CROSS JOIN ttop JOIN u{last} ON u{last}.id = p.id""")


def op12_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    kind = pages.schema["page_id"].dataType
    return warc.read_archives(warc.write_archives(pages)).select(
        F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))


OP12_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, row_number() OVER () AS r FROM pages
), ranked AS (
  SELECT page_id, sha1(html) AS hx, octet_length(encode(html)) AS n,
         row_number() OVER (PARTITION BY html ORDER BY page_id NULLS LAST, r) AS k,
         first_value(page_id) OVER (PARTITION BY html ORDER BY page_id NULLS LAST, r) AS first
  FROM p
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST((CAST('0x' || substr(hx, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31 AS BIGINT) + 1, 1)), '') AS payload_digest,
       CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN k > 1 THEN first END AS refers_to
FROM ranked
"""


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(hard_negatives.prepare(table, label), F.col("id") % 50 == 0)


OP13_SQL = """
WITH r AS (
  SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.id AS anchor_id, b.id AS other, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM r a JOIN r b ON len(a.v) = len(b.v) AND len(a.v) > 0 AND a.id <> b.id WHERE a.id % 50 = 0
), pos AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other AS negative_id, positive_score, score AS negative_score
FROM pos JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)
QUALIFY row_number() OVER w <= 3
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_source_mixing": op1_source_mixing,
    "op2_token_counts": op2_token_counts,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_url_filter": op4_url_filter,
    "op5_fuzzy_passages": op5_fuzzy_passages,
    "op6_personal_data": op6_personal_data,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_language_id": op8_language_id,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_warc_archives": op12_warc_archives,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE: dict[str, str] = {
    "op1_source_mixing": OP1_SQL,
    "op3_jaccard_join": OP3_SQL,
    "op9_suffix_dedup": OP9_SQL,
    "op10_benchmark_decontamination": OP10_SQL,
    "op11_merkle_manifest": _op11_sql(),
    "op12_warc_archives": OP12_SQL,
    "op13_hard_negatives": OP13_SQL,
}
