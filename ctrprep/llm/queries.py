"""One query per operator, over whole tables with production parameters, and SQL where it can express the result."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ctrprep.llm import bpe, conversations, decontaminate, embeddings, language, minhash, negatives, pii, quality, secrets, substrings, toxicity, warc
from ctrprep.sources.scratch import shared_folder


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))


def op2_secrets(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return secrets.span_report(secrets.find_secrets(docs), tuple(r.kind for r in secrets.BASE_RULES))


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.find_passages(docs, table(spark, folder, "benchmark"))
    return decontaminate.report(decontaminate.judged(found))


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, folder, "labels"))
    return toxicity.report(quality.score(docs, model), 0.3)


def op5_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return secrets.span_report(pii.find_personal_data(docs), pii.KINDS, base_only=True)


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, folder, "labels"))
    return toxicity.report(toxicity.score(docs, model), 0.5)


def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    archive = f"{shared_folder(spark)}/ctrprep-{spark.sparkContext.applicationId}/archive-{uuid.uuid4().hex}"
    warc.write_archive(table(spark, folder, "pages").select("page_id", "url", "html"), archive)
    return warc.read_archive(spark, archive).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return bpe.digests(bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json")))


def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return substrings.digests(substrings.remove_repeats(docs))


def op10_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, folder, "embeddings").select("vec_id", "embedding"))


def op11_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    aside = language.held_out(F.col("doc_id"))
    model = language.train(docs.where(F.col("doc_id").isNotNull() & ~aside))
    return language.predict(docs, model).select("doc_id", aside.alias("held_out"), "lang_pred", "score")


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0, moved)


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    damaged = conversations.damage(table(spark, folder, "conversations"))
    return conversations.repair(damaged, copies="__copies")


QUERIES = {
    f.__name__: f
    for f in (
        op1_minhash_dedup,
        op2_secrets,
        op3_decontamination,
        op4_quality,
        op5_personal_data,
        op6_toxicity,
        op7_warc,
        op8_bpe,
        op9_substring_dedup,
        op10_embedding_dedup,
        op11_language,
        op12_hard_negatives,
        op13_conversation_repair,
    )
}

_FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES = {
    "op1_minhash_dedup": rf"""
WITH RECURSIVE doc AS (
    SELECT doc_id, coalesce(regexp_extract_all({_FOLD.format('text')}, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), shingle AS (
    SELECT DISTINCT doc_id, array_to_string(list_slice(w, k, k + 3), ' ') AS s
    FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 3))) AS k FROM doc WHERE len(w) > 0)
), size AS (
    SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), link AS (
    SELECT a, b FROM common JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM doc
    UNION
    SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b
), component AS (
    SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM doc d LEFT JOIN size USING (doc_id) JOIN component USING (doc_id)
""",
    "op7_warc": """
WITH page AS (
    SELECT page_id, coalesce(html, '') AS body, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages
), digest AS (
    SELECT page_id, payload_bytes, sha256(body) AS payload_digest, min(page_id) OVER (PARTITION BY body) AS first FROM page
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 100 AND first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND first < page_id THEN first END AS refers_to
FROM digest
""",
    "op10_embedding_dedup": """
WITH RECURSIVE vec AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
), usable AS (
    SELECT vec_id, v, sqrt(list_inner_product(v, v)) AS size FROM vec
    WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0
), link AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_inner_product(a.v, b.v) / (a.size * b.size) >= 0.95
), reach AS (
    SELECT vec_id AS a, vec_id AS b FROM vec
    UNION
    SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b
), component AS (
    SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
), counted AS (
    SELECT a AS vec_id, count(DISTINCT b) AS n FROM link GROUP BY a
)
SELECT v.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, v.vec_id = component_id AS kept
FROM vec v LEFT JOIN counted USING (vec_id) JOIN component USING (vec_id)
""",
    "op3_decontamination": rf"""
WITH item AS (
    SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_FOLD.format('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), span AS (
    SELECT item, array_to_string(list_slice(w, k, k + least(13, len(w)) - 1), ' ') AS words, least(13, len(w)) AS size
    FROM item, generate_series(1, len(w) - least(13, len(w)) + 1) AS s(k) WHERE len(w) > 0
), doc AS (
    SELECT doc_id, coalesce(regexp_extract_all({_FOLD.format('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
), place AS (
    SELECT doc_id, k, size, array_to_string(list_slice(w, k, k + size - 1), ' ') AS words
    FROM doc, (SELECT DISTINCT size FROM span), generate_series(1, len(w) - size + 1) AS s(k)
), hit AS (
    SELECT doc_id, k, p.size, item FROM place p JOIN span s ON p.words = s.words AND p.size = s.size
), word AS (
    SELECT doc_id, count(DISTINCT i) AS n_hit FROM hit, generate_series(k, k + size - 1) AS s(i) GROUP BY doc_id
), listed AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM doc d LEFT JOIN word USING (doc_id) LEFT JOIN listed USING (doc_id)
""",
    "op9_substring_dedup": r"""
WITH doc AS (
    SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), place AS (
    SELECT doc_id, k, array_to_string(list_slice(w, k, k + 49), ' ') AS words FROM doc, generate_series(1, len(w) - 49) AS s(k)
), first AS (
    SELECT words, min(doc_id) AS first_doc FROM place GROUP BY words
), cut AS (
    SELECT DISTINCT doc_id, i FROM place JOIN first USING (words), generate_series(k, k + 49) AS s(i) WHERE first_doc < doc_id
), each AS (
    SELECT d.doc_id, s.i, d.w[s.i] AS word, c.i IS NOT NULL AS gone
    FROM (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS i FROM doc) s JOIN doc d USING (doc_id) LEFT JOIN cut c ON c.doc_id = s.doc_id AND c.i = s.i
), kept AS (
    SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS body FROM each GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (doc_id)
""",
    # The bits of crc32 one by one; then all paths of a conversation row by row, of which the least of each state goes on.
    "op13_conversation_repair": r"""
WITH RECURSIVE source AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
    FROM conversations
), summed AS (
    SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(name, ''), lambda c: CAST(ascii(c) AS BIGINT))),
        lambda x, y: list_reduce([xor(x, y), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END))) % 20 AS fault
    FROM source
), damaged AS (
    SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
           CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy
    FROM summed WHERE fault <> 0
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged
), faulty AS (
    SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
           NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS cut,
           lag(role) OVER (PARTITION BY conv_id ORDER BY i) AS before
    FROM placed
), marked AS (
    SELECT conv_id, turn, role, text, i, blank OR again AS gone, cut, blank, NOT blank AND again AS again, NOT blank AND NOT again AND cut AS truncated,
           i > 1 AND left(before, 1) || left(role, 1) NOT IN ('su', 'ua', 'au') AS illegal
    FROM faulty
), step AS (
    SELECT * FROM (VALUES (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')) AS t(state, next, role)
), insertion AS (
    SELECT state, state AS at, 0 AS n, '' AS word, CAST([] AS VARCHAR[]) AS added FROM step
    UNION ALL
    SELECT i.state, s.next, n + 1, word || 'I', list_append(added, s.role || ':') FROM insertion i JOIN step s ON s.state = i.at WHERE n < 3
), edit AS (
    SELECT state, state AS next, 2 AS cost, 'D' AS word, CAST([] AS VARCHAR[]) AS added, NULL AS role, 'D' AS kind FROM step
    UNION ALL
    SELECT i.state, s.next, 5 * n + 1, word || 'R', added, s.role, 'R' FROM insertion i JOIN step s ON s.state = i.at
    UNION ALL
    SELECT i.state, s.next, 5 * n, word || 'K', added, left(s.role, 1), 'K' FROM insertion i JOIN step s ON s.state = i.at
    UNION ALL
    SELECT 0, 1, 0, 'K', CAST([] AS VARCHAR[]), 's', 'K'
), path AS (
    SELECT conv_id, CAST(0 AS BIGINT) AS i, 0 AS state, {'cost': CAST(0 AS BIGINT), 'audit': '', 'body': CAST([] AS VARCHAR[])} AS best FROM (SELECT DISTINCT conv_id FROM conversations)
    UNION ALL
    SELECT p.conv_id, p.i + 1, e.next, min({'cost': p.best.cost + e.cost + CASE WHEN m.cut AND e.kind <> 'D' THEN 5 ELSE 0 END, 'audit': p.best.audit || e.word,
        'body': list_concat(p.best.body, e.added, CASE e.kind WHEN 'D' THEN CAST([] AS VARCHAR[]) WHEN 'K' THEN [m.role || ':' || m.text] ELSE [e.role || ':' || m.text] END)})
    FROM path p JOIN marked m ON m.conv_id IS NOT DISTINCT FROM p.conv_id AND m.i = p.i + 1
    JOIN edit e ON e.state = p.state AND (e.kind = 'D' OR NOT m.gone AND (e.kind = 'R' OR e.role = left(m.role, 1)))
    GROUP BY p.conv_id, p.i, e.next
), finish AS (
    SELECT * FROM (VALUES (0, ''), (1, 'II'), (2, 'I'), (3, '')) AS t(state, word)
), size AS (
    SELECT conv_id, max(i) AS n FROM path GROUP BY conv_id
), result AS (
    SELECT p.conv_id, min({'cost': p.best.cost + 5 * length(f.word), 'audit': p.best.audit || f.word,
        'body': list_concat(p.best.body, CASE f.word WHEN 'II' THEN ['user:', 'assistant:'] WHEN 'I' THEN ['assistant:'] ELSE CAST([] AS VARCHAR[]) END)}) AS best
    FROM path p JOIN size s ON s.conv_id IS NOT DISTINCT FROM p.conv_id AND s.n = p.i JOIN finish f ON f.state = p.state GROUP BY p.conv_id
), counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank, count_if(again) AS duplicate,
           count_if(truncated) AS truncated, count_if(illegal) AS illegal
    FROM marked GROUP BY conv_id
)
SELECT r.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
       CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(best.cost AS BIGINT) AS cost,
       best.audit AS audit, sha256(array_to_string(best.body, chr(10))) AS repaired_sha256
FROM result r LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM r.conv_id
""",
    "op12_hard_negatives": """
WITH vec AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS q
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), product AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
    FROM vec a JOIN vec b ON a.vec_id % 100 = 0 AND a.vec_id IS DISTINCT FROM b.vec_id AND len(a.q) = len(b.q)
), positive AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM product WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positive p JOIN product n ON n.anchor_id = p.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
""",
}
