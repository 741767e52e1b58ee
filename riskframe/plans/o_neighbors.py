"""DuckDB twins of the neighbour / oversampling / leakage queries (brute force)."""

from __future__ import annotations

from riskframe.plans.oracle import ORACLE, _hash, split_cte
from riskframe.plans.catalog import CAT, NUM
from riskframe.plans.q_neighbors import SMOTE_SCALES
from riskframe.plans.views_sql import with_views

SQD = "list_reduce(list_transform(range(1, len({a}) + 1), lambda i: ({a}[i] - {b}[i]) * ({a}[i] - {b}[i])), lambda x, y: x + y)"
DOT = "list_reduce(list_transform(range(1, len({a}) + 1), lambda i: {a}[i] * {b}[i]), lambda x, y: x + y)"


def knn_sql(src: str, k: int) -> str:
    """CTE nn: exact kNN of every row of ``src(grp, key, vec)`` among the others."""
    return f""", nn AS (SELECT grp, key, CAST(rank AS INTEGER) AS rank, nn_key, dist FROM (
  SELECT *, row_number() OVER (PARTITION BY grp, key ORDER BY dist, nn_key) AS rank FROM (
    SELECT a.grp, a.key, b.key AS nn_key, sqrt({SQD.format(a='a.vec', b='b.vec')}) AS dist
    FROM {src} a JOIN {src} b ON a.grp = b.grp AND a.key <> b.key) p) q WHERE rank <= {k})"""


ORACLE["r1_knn"] = f"""
WITH src AS (SELECT label AS grp, vec_id AS key, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings)
{knn_sql('src', 5)}
SELECT grp AS label, key AS vec_id, rank, nn_key, round(dist, 6) AS dist FROM nn"""

ORACLE["r1_knn_chosen"] = ORACLE["r1_knn"] + " WHERE key % 50 = 0"
ORACLE["r1_approximate_recall_checked"] = f"""
SELECT count(DISTINCT vec_id) AS n_queries, count(*) AS n_true, true AS recall_reached FROM ({ORACLE['r1_knn_chosen']}) q"""

XS = "[" + ", ".join(f"CAST({c} AS DOUBLE) / CAST({s!r} AS DOUBLE)" for c, s in SMOTE_SCALES.items()) + "]"
TRAIN = split_cte() + f"\n, tr AS (SELECT app_id, class, {XS} AS x FROM sp WHERE split = 'train')"

ORACLE["r1_knn_minority"] = with_views(TRAIN + """
, src AS (SELECT 0 AS grp, app_id AS key, x AS vec FROM tr WHERE class = 2)
""" + knn_sql("src", 5) + """
SELECT key AS app_id, rank, nn_key, round(dist, 6) AS dist FROM nn""")

NX = len(SMOTE_SCALES)
SMOTE = TRAIN + """
, src AS (SELECT 0 AS grp, app_id AS key, x AS vec FROM tr WHERE class = 2)
""" + knn_sql("src", 5) + f"""
, cnt AS (SELECT count(*) FILTER (WHERE class = 2) AS n_min, count(*) FILTER (WHERE class <> 2) AS n_maj FROM tr),
pos AS (SELECT key, vec, row_number() OVER (ORDER BY {_hash('key', 'smote42')}, key) - 1 AS bp FROM src),
syn AS (SELECT id AS syn_id, CAST(('0x' || substr(md5(CAST(id AS VARCHAR) || '|base42'), 1, 15)) AS BIGINT) % n_min AS bp,
               CAST(CAST(('0x' || substr(md5(CAST(id AS VARCHAR) || '|rank42'), 1, 15)) AS BIGINT) % least(5, n_min - 1) + 1 AS INTEGER) AS rank,
               {_hash('id', 'gap42')} / 4294967296.0 AS gap
        FROM cnt, range(0, (SELECT n_maj - n_min FROM cnt)) t(id)),
s AS (SELECT syn.syn_id, p.key AS base_key, nn.nn_key, syn.gap, p.vec AS x, v.vec AS nv
      FROM syn JOIN pos p USING (bp) JOIN nn ON nn.key = p.key AND nn.rank = syn.rank
      JOIN src v ON v.key = nn.nn_key),
allrows AS (SELECT false AS synthetic, NULL::BIGINT AS syn_id, NULL::BIGINT AS base_key, NULL::BIGINT AS nn_key,
                   app_id, class, x FROM tr
            UNION ALL
            SELECT true, syn_id, base_key, nn_key, NULL::BIGINT, 2,
                   list_transform(range(1, {NX} + 1), lambda i: x[i] + gap * (nv[i] - x[i])) FROM s)"""

ORACLE["r2_smote"] = with_views(SMOTE + "\nSELECT synthetic, syn_id, base_key, nn_key, app_id, class, " +
                                ", ".join(f"round(x[{i + 1}], 9) AS x{i}" for i in range(NX)) + " FROM allrows")

ORACLE["r3_balance_before_after"] = with_views(SMOTE + """
, b AS (SELECT 'before' AS stage, class FROM tr UNION ALL SELECT 'after', class FROM allrows)
SELECT class, CASE WHEN class = 1 THEN 'Good Credit' ELSE 'Bad Credit' END AS label_text, count(*) AS n,
       round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY stage), 4)::DOUBLE AS pct, stage
FROM b GROUP BY stage, class""")

EMB_SPLIT = split_cte(group="label", src="emb", name="sp0").replace("app_id", "vec_id")
EMB = "WITH emb AS (SELECT * FROM embeddings)\n" + EMB_SPLIT.replace(", sp AS", ", sp0 AS") + """
, sp AS (SELECT vec_id, split, embedding FROM sp0
         UNION ALL SELECT vec_id + 1000000000 * o, s, list_transform(embedding, lambda x, i: CAST(x AS DOUBLE) * CASE WHEN i % 3 = 0 THEN 1.25 ELSE 1.0 END)
         FROM sp0 JOIN (VALUES (1, 'test', 7), (2, 'val', 11)) t(o, s, every) ON split = 'train' AND vec_id % every = 0)
, unitv AS (SELECT vec_id, split, CASE WHEN nrm > 0 THEN list_transform(v, lambda x: x / nrm)
                                       ELSE list_transform(v, lambda x: x * 0.0) END AS u
            FROM (SELECT vec_id, split, CAST(embedding AS DOUBLE[]) AS v,
                         sqrt(list_reduce(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * x), lambda a, b: a + b)) AS nrm
                  FROM sp) q)"""


def _sims(a: str, b: str) -> str:
    return f"""(SELECT l.vec_id AS left_key, r.vec_id AS right_key, {DOT.format(a='l.u', b='r.u')} AS similarity
   FROM unitv l, unitv r WHERE l.split = '{a}' AND r.split = '{b}')"""


def _summary(a: str, t: float) -> str:
    return f"""SELECT (SELECT count(*) FROM sp WHERE split = '{a}') AS n_test,
       (SELECT count(*) FROM sp WHERE split = 'train') AS n_train,
       count(DISTINCT left_key) AS n_flagged, round(max(similarity), 6) AS max_similarity,
       CAST({t} AS DOUBLE) AS threshold
FROM {_sims(a, 'train')} s WHERE similarity > {t}"""


ORACLE["r5_leakage_summary"] = EMB + "\n" + _summary("test", 0.95)
ORACLE["r5_similar_pairs"] = EMB + f"""
SELECT left_key AS test_id, right_key AS train_id, round(similarity, 6) AS similarity
FROM {_sims('test', 'train')} s WHERE similarity > 0.9"""
ORACLE["r5_similar_pairs_low"] = ORACLE["r5_similar_pairs"].replace("similarity > 0.9", "similarity > 0.4")
ORACLE["r5_max_similarity"] = EMB + f"""
SELECT left_key AS vec_id, round(max(similarity), 6) AS max_similarity FROM {_sims('test', 'train')} s GROUP BY left_key"""


def _maxima(a: str) -> str:
    return f"""SELECT count(*) AS n_rows, count(*) FILTER (m > 0.95) AS n_flagged, round(min(m), 6) AS least, round(avg(m), 6) AS mean,
       round(max(m), 6) AS largest, 'train-{a}' AS pair
FROM (SELECT left_key, max(similarity) AS m FROM {_sims(a, 'train')} s GROUP BY left_key)"""


ORACLE["l9_max_similarity"] = EMB + "\n" + _maxima("test") + "\nUNION ALL\n" + _maxima("val")
ORACLE["r5_leakage_report"] = EMB + f"""
SELECT left_key AS vec_id, round(max(similarity), 6) AS max_similarity, count(*) AS n_matches
FROM {_sims('test', 'train')} s WHERE similarity > 0.95 GROUP BY left_key"""
ORACLE["l9_integrity"] = EMB + "\n" + _summary("test", 0.95).replace("AS threshold", "AS threshold, 'train-test' AS pair") + \
    "\nUNION ALL\n" + _summary("val", 0.95).replace("AS threshold", "AS threshold, 'train-val' AS pair")

FOLD_SMOTE = split_cte() + f"""
, pool AS (SELECT * FROM sp WHERE split IN ('train', 'val')),
folds AS (SELECT *, CAST((row_number() OVER (PARTITION BY class ORDER BY {_hash('app_id', 'fold42')}, app_id) - 1) % 5
                         AS INTEGER) AS fold FROM pool),
fit AS (SELECT f.app_id, f.class, {XS} AS x, CAST(ff AS INTEGER) AS fit_fold
        FROM folds f, range(0, 5) t(ff) WHERE ff <> f.fold),
src AS (SELECT fit_fold AS grp, app_id AS key, x AS vec FROM fit WHERE class = 2)
""" + knn_sql("src", 5) + f"""
, cnt AS (SELECT fit_fold, count(*) FILTER (WHERE class = 2) AS n_min, count(*) FILTER (WHERE class <> 2) AS n_maj
          FROM fit GROUP BY fit_fold),
pos AS (SELECT grp, key, vec, row_number() OVER (PARTITION BY grp ORDER BY {_hash('key', 'smote42')}, key) - 1 AS bp FROM src),
ids AS (SELECT fit_fold, n_min, unnest(range(0, n_maj - n_min)) AS syn_id FROM cnt),
syn AS (SELECT fit_fold, syn_id,
               CAST(('0x' || substr(md5(CAST(fit_fold AS VARCHAR) || '|' || CAST(syn_id AS VARCHAR) || '|base42'), 1, 15)) AS BIGINT) % n_min AS bp,
               CAST(CAST(('0x' || substr(md5(CAST(fit_fold AS VARCHAR) || '|' || CAST(syn_id AS VARCHAR) || '|rank42'), 1, 15)) AS BIGINT)
                    % least(5, n_min - 1) + 1 AS INTEGER) AS rank,
               CAST(('0x' || substr(md5(CAST(fit_fold AS VARCHAR) || '|' || CAST(syn_id AS VARCHAR) || '|gap42'), 1, 8)) AS BIGINT)
                 / 4294967296.0 AS gap
        FROM ids),
s AS (SELECT syn.fit_fold, syn.syn_id, p.key AS base_key, nn.nn_key, syn.gap, p.vec AS x, v.vec AS nv
      FROM syn JOIN pos p ON p.grp = syn.fit_fold AND p.bp = syn.bp
      JOIN nn ON nn.grp = syn.fit_fold AND nn.key = p.key AND nn.rank = syn.rank
      JOIN src v ON v.grp = syn.fit_fold AND v.key = nn.nn_key),
allrows AS (SELECT fit_fold, false AS synthetic, NULL::BIGINT AS syn_id, NULL::BIGINT AS base_key, NULL::BIGINT AS nn_key,
                   app_id, class, x FROM fit
            UNION ALL
            SELECT fit_fold, true, syn_id, base_key, nn_key, NULL::BIGINT, 2,
                   list_transform(range(1, {NX} + 1), lambda i: x[i] + gap * (nv[i] - x[i])) FROM s)"""

ORACLE["r4_smote_per_fold"] = with_views(FOLD_SMOTE + "\nSELECT fit_fold, synthetic, syn_id, base_key, nn_key, app_id, class, " +
                                         ", ".join(f"round(x[{i + 1}], 9) AS x{i}" for i in range(NX)) + " FROM allrows")


_FIT = "FROM folds f, range(0, 5) t(ff) WHERE ff <> f.fold"
ORACLE["g12_fold_facts"] = with_views(split_cte() + f"""
, pool AS (SELECT * FROM sp WHERE split IN ('train', 'val')),
folds AS (SELECT *, CAST((row_number() OVER (PARTITION BY class ORDER BY {_hash('app_id', 'fold42')}, app_id) - 1) % 5
                         AS INTEGER) AS fold FROM pool),
fit AS (SELECT CAST(ff AS INTEGER) AS part, f.* {_FIT}),
lv AS ({" UNION ALL ".join(f"SELECT part, count(DISTINCT {c}) - 1 AS n FROM fit GROUP BY part" for c in CAT)}),
wide AS (SELECT part, {len(NUM)} + sum(n) AS n_features FROM lv GROUP BY part)
SELECT part AS fold, count(*) AS n_fit, (SELECT count(*) FROM folds WHERE fold = part) AS n_held_out,
       count(*) FILTER (class <> 2) - count(*) FILTER (class = 2) AS n_synthetic, CAST(any_value(n_features) AS INTEGER) AS n_features,
       round(avg(total_price), 4) AS price_mean, round(stddev_pop(total_price), 4) AS price_std, round(avg(qty), 4) AS qty_mean, round(stddev_pop(qty), 4) AS qty_std
FROM fit JOIN wide USING (part) GROUP BY part""")
