"""Registered queries of the operators and their SQL, by name."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.sources.tables import read_table

WORD_VOCABULARY = "word_bpe_49k.json"
BYTE_VOCABULARY = "byte_bpe_50k.json"


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file; every machine has it."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_bpe(spark, sf_dir):
    from riskframe.llm.bpe import build_lexicon, encode
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = build_lexicon(docs, vocabulary(BYTE_VOCABULARY))
    coded = encode(docs, vocabulary(BYTE_VOCABULARY), lexicon, out_col="token_ids", decoded_col="decoded")
    return coded.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def op2_language_id(spark, sf_dir):
    from riskframe.llm import language_id as L
    docs = read_table(spark, sf_dir, "documents")
    fold = L.held_out(F.col("doc_id"))
    model = L.train(docs.where(~fold).select("text", "lang"))
    return L.predict(docs.select("doc_id", fold.alias("held_out"), "text"), model).drop("text")


def op3_warc(spark, sf_dir):
    from riskframe.llm import warc as W
    pages = read_table(spark, sf_dir, "pages")
    index = W.build_index(W.write_archive(pages, min_payload=0))
    records = W.read_records(W.lookup(index, pages.select("url")), payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_token_store(spark, sf_dir):
    from riskframe.llm.token_store import read_token_shards, write_token_shards
    shards = write_token_shards(read_table(spark, sf_dir, "documents"), vocabulary(WORD_VOCABULARY), end_id=1)
    return read_token_shards(shards).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_license_scan(spark, sf_dir):
    from riskframe.llm.license_scan import license_scan
    found = license_scan(read_table(spark, sf_dir, "documents").select("doc_id", "text"))

    def joined(*columns):
        return F.array_join(F.array_sort(F.array_distinct(F.concat(*columns))), ",")

    n_base = F.size("phrases").cast("long")
    return found.select("doc_id", "n_words", n_base.alias("n_base"), F.array_min("phrases.start").alias("first_word"),
                        F.array_max("phrases.start").alias("last_word"), joined("phrases.label").alias("base_labels"),
                        joined("phrases.label", "blocks.label").alias("labels"),
                        F.when(n_base > 0, 1.0).otherwise(F.coalesce(F.array_max("blocks.containment"), F.lit(0.0))).alias("score"))


def op6_exact_dedup(spark, sf_dir):
    from riskframe.llm.exact_dedup import exact_dedup
    return exact_dedup(read_table(spark, sf_dir, "documents"))


def op7_decontamination(spark, sf_dir):
    from riskframe.llm.decontaminate import find_contamination
    found = find_contamination(read_table(spark, sf_dir, "documents").select("doc_id", "text"), read_table(spark, sf_dir, "benchmark"), matches=False)
    ids = F.array_sort(F.col("items").cast("array<string>"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op8_html_extract(spark, sf_dir):
    from riskframe.llm.html_extract import extract_main_text
    found = extract_main_text(read_table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op9_near_dedup(spark, sf_dir):
    from riskframe.llm.near_dedup import near_dedup
    return near_dedup(read_table(spark, sf_dir, "documents"))


def op10_language_model(spark, sf_dir):
    from riskframe.llm import language_model as M
    held = M.held_out(F.col("doc_id"))
    scored = M.score_texts(read_table(spark, sf_dir, "documents"), ~held)
    return scored.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")


def op11_filter_audit(spark, sf_dir):
    from riskframe.llm.filter_audit import audit_documents
    return audit_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op12_hard_negatives(spark, sf_dir):
    from riskframe.llm.hard_negatives import mine_hard_negatives
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = read_table(spark, sf_dir, "embeddings").select("vec_id", noisy.alias("label"), "embedding")
    return mine_hard_negatives(rows, "vec_id", "label", "embedding", lambda i: i % 100 == 0, scale=256.0, positives=5, negatives=5, low=80, high=100)


def op13_packing(spark, sf_dir):
    from riskframe.llm.packing import pack
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack(docs, vocabulary(BYTE_VOCABULARY), end_id=1, size=2048, with_ids=False)


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_language_id": op2_language_id,
    "op3_warc": op3_warc,
    "op4_token_store": op4_token_store,
    "op5_license_scan": op5_license_scan,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_decontamination": op7_decontamination,
    "op8_html_extract": op8_html_extract,
    "op9_near_dedup": op9_near_dedup,
    "op10_language_model": op10_language_model,
    "op11_filter_audit": op11_filter_audit,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_packing": op13_packing,
}

ORACLE_SQL = {
    "op3_warc": r"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
             f AS (SELECT body, min(page_id) AS first FROM p GROUP BY body),
             h AS (SELECT page_id, strlen(body) AS n, sha1(body) AS hex, first FROM p JOIN f USING (body))
        SELECT page_id, n::BIGINT AS payload_bytes,
               array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + ((('0x' || substr(hex, 5 * (i // 4)::INT + 1, 5))::BIGINT >> (5 * (3 - i % 4))::INT) & 31)::INT, 1)), '') AS payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM h""",
    "op6_exact_dedup": r"""
        WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS cp,
                          regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
             k AS (SELECT norm, first(doc_id ORDER BY cp DESC, doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY norm)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
        FROM n JOIN k USING (norm)""",
    "op7_decontamination": r"""
        WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
             bw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
             win AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g, w[i] AS first
                     FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM bw WHERE len(w) > 0)),
             word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM dw),
             pos AS (SELECT doc_id, x, i, string_agg(x, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS g FROM word),
             hit AS (SELECT DISTINCT doc_id, i, n, item_id FROM pos JOIN win ON win.n = 10 AND win.g = pos.g
                     UNION SELECT DISTINCT doc_id, i, n, item_id FROM pos JOIN win ON win.n < 10 AND win.first = pos.x AND starts_with(pos.g || ' ', win.g || ' ')),
             words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hit) GROUP BY doc_id),
             items AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
                       FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM hit) GROUP BY doc_id)
        SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM dw d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op11_filter_audit": r"""
        WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
             w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS first FROM d),
             l AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id),
             f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
                          (CASE WHEN len(w) < 200 THEN 'A' ELSE '' END) || (CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END)
                          || (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 2 * length(t) THEN 'C' ELSE '' END)
                          || (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END)
                          || (CASE WHEN doc_id > first THEN 'E' ELSE '' END) AS fails
                   FROM w LEFT JOIN l USING (doc_id)),
             c AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY part, fails),
             x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
             o AS (SELECT a.x || b.x || c.x || d.x || e.x AS o FROM x a, x b, x c, x d, x e
                   WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
             s AS (SELECT part, o, step, substr(o, step, 1) AS f, fails, n, good, toxic,
                          list_min(list_filter(range(1, 6), lambda i: contains(fails, substr(o, i, 1)))) AS gone
                   FROM c, o, (SELECT unnest(range(1, 6)) AS step)),
             g AS (SELECT part, o AS filter_order, step, f, sum(n) FILTER (gone IS NULL OR gone > step) AS kept, sum(n) FILTER (gone = step) AS removed,
                          sum(n) FILTER (contains(fails, f) AND gone < step) AS redundant, sum(n) FILTER (fails = f) AS unique_fails,
                          sum(good) FILTER (gone = step) AS good_lost, sum(toxic) FILTER (gone = step) AS toxic_lost
                   FROM s GROUP BY part, o, step, f)
        SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
               coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost,
               coalesce(toxic_lost, 0)::BIGINT AS toxic_lost, coalesce(sum(removed) OVER (PARTITION BY part, f), 0)::BIGINT AS shapley
        FROM g""",
    "op12_hard_negatives": r"""
        WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
                   WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
                   FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
             p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
                   QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
        SELECT anchor_id, positive_id, row_number() OVER w AS rank, other_id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
        WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)
        QUALIFY row_number() OVER w <= 5""",
}
