"""DuckDB twins of the named queries (same columns, same rounding).

The SQL is assembled from shared common table expressions: the rating
stand-in, validation, keep-last merge, split, biases and the alternating
least-squares chain at the reference's constants.  A half step sums the normal
equations of every entity, eliminates them column by column (they are
symmetric and positive definite, so no pivoting is needed) and substitutes
back, each a projection over plain columns.
"""

from __future__ import annotations

import re
from functools import lru_cache

from rankfold import config

REG = config.REG
SHRINK = 10
RANK = config.RANK
ITERS = config.ITERATIONS

_VALID = ("user_id IS NOT NULL AND item_id IS NOT NULL AND rating IS NOT NULL "
          "AND NOT isnan(rating) AND rating >= 0.5 AND rating <= 5.0")

BASE = {
    "raw": """SELECT o_custkey AS user_id, l_partkey AS item_id,
        CAST(ceil(l_quantity / 5) AS DOUBLE) / 2 AS rating, l_shipdate AS ts,
        l_orderkey * 100 + l_linenumber AS seq
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "src": f"""SELECT user_id, item_id, rating, ts, seq,
        CASE WHEN year(ts) < 2000 THEN 'base' ELSE 'feedback' END AS source,
        CASE WHEN year(ts) < 2000 THEN 0 ELSE 1 END AS priority
      FROM raw WHERE {_VALID}""",
    "merged": """SELECT user_id, item_id, rating, ts, seq, source FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, item_id
          ORDER BY priority DESC, ts DESC, seq DESC, rating DESC) AS rn FROM src)
      WHERE rn = 1""",
    "fbmerged": """SELECT user_id, item_id, rating, ts, seq FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, item_id
          ORDER BY ts DESC, seq DESC, rating DESC) AS rn FROM src WHERE source = 'feedback')
      WHERE rn = 1""",
    "ev": """SELECT event_id, CAST(user_id AS BIGINT) AS user_id,
        CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
        CAST(ceil(value / 20) AS DOUBLE) / 2 AS rating, ts FROM events""",
    "evalid": f"SELECT * FROM ev WHERE {_VALID}",
    "live": """SELECT user_id, item_id, rating, seq FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, item_id
          ORDER BY ts DESC, seq DESC, rating DESC) AS rn FROM (
          SELECT user_id, item_id, rating, ts, seq FROM merged
          UNION ALL SELECT user_id, item_id, rating, ts, event_id FROM evalid))
      WHERE rn = 1""",
    "movies": """SELECT p_partkey AS item_id, p_name AS title,
        concat_ws('|', p_type, p_brand) AS genres FROM part""",
    "mstats": """SELECT item_id, avg(rating) AS avg_rating, count(*) AS rating_count
      FROM merged GROUP BY item_id""",
    "cat": """SELECT m.item_id, m.title, string_split(m.genres, '|') AS genres,
        coalesce(s.avg_rating, 0.0) AS avg_rating,
        CAST(coalesce(s.rating_count, 0) AS BIGINT) AS rating_count
      FROM movies m LEFT JOIN mstats s USING (item_id)""",
    "vec": """SELECT vec_id AS item_id, CAST(embedding AS DOUBLE[]) AS f FROM embeddings""",
}


def _similar(vectors: str) -> str:
    return f"""SELECT item_id, similar_id, cosine, CAST(row_number() OVER (
          PARTITION BY item_id ORDER BY cosine DESC, similar_id) AS INTEGER) AS rank
      FROM (SELECT a.item_id, b.item_id AS similar_id,
              round(list_dot_product(a.f, b.f) / (sqrt(list_dot_product(a.f, a.f))
                * sqrt(list_dot_product(b.f, b.f)) + 1e-9), 9) AS cosine
            FROM {vectors} a JOIN {vectors} b ON a.item_id <> b.item_id)
      QUALIFY rank <= 5"""


def _solved(rows: str) -> str:
    """``step, id, n, f1..`` that solve the normal equations of every ``me`` of ``rows``
    (``step, me, y, f1..``)."""
    r = range(1, RANK + 1)
    sums = [f"sum(f{i} * f{j})" + (f" + {REG} * count(*)" if i == j else "")
            + f" AS a{i}_{j}" for i in r for j in r if i <= j]
    sums += [f"sum(f{i} * y) AS c{i}" for i in r]
    q = f"SELECT step, me, count(*) AS n, {', '.join(sums)} FROM ({rows}) GROUP BY step, me"
    for k in r[:-1]:
        cols = [f"a{i}_{j}" for i in r for j in r if i <= min(j, k)]
        cols += [f"c{i}" for i in r if i <= k]
        cols += [f"a{i}_{j} - a{k}_{i} * a{k}_{j} / a{k}_{k} AS a{i}_{j}"
                 for i in r for j in r if k < i <= j]
        cols += [f"c{i} - a{k}_{i} * c{k} / a{k}_{k} AS c{i}" for i in r if i > k]
        q = f"SELECT step, me, n, {', '.join(cols)} FROM ({q})"
    for k in reversed(r):
        known = "".join(f" - a{k}_{j} * x{j}" for j in r if j > k)
        q = f"SELECT *, (c{k}{known}) / a{k}_{k} AS x{k} FROM ({q})"
    return f"SELECT step, me, n, {', '.join(f'x{k} AS f{k}' for k in r)} FROM ({q})"


def _training(prefix: str, iters: int) -> str:
    """All half steps as one recursive table: step 0 are the items' start factors, odd steps
    users, even ones items, each from the step before."""
    f = ", ".join(f"f{k}" for k in range(1, RANK + 1))
    rows = f"""SELECT m.step + 1 AS step, e.me, e.y, {f} FROM {prefix}als{iters} m
        JOIN {prefix}edges e ON e.other = m.me AND e.side = m.step % 2
        WHERE m.step < {2 * iters}"""
    return (f"SELECT CAST(0 AS BIGINT) AS step, item_id AS me, CAST(0 AS BIGINT) AS n, {_start()} "
            f"FROM {prefix}ib UNION ALL {_solved(rows)}")


def _start() -> str:
    return ", ".join(f"{'cos' if k % 2 else 'sin'}(CAST(item_id AS DOUBLE) * {(17 + 6 * k) / 10}"
                     f" + {(3 + 6 * k) / 10}) * 0.1 AS f{k + 1}" for k in range(RANK))


_LIST = "[" + ", ".join(f"f{k}" for k in range(1, RANK + 1)) + "] AS f"


def _model_ctes(prefix: str, ratings: str, iters: int = ITERS) -> dict:
    """Split, biases, residuals and the ALS chain over ``ratings``."""
    p = prefix
    c = {
        f"{p}split": f"""SELECT *, (((user_id * 31 + item_id * 17 + 7) % 10) + 10) % 10 < 1
            AS is_holdout FROM {ratings}""",
        f"{p}train": f"SELECT user_id, item_id, rating FROM {p}split WHERE NOT is_holdout",
        f"{p}hold": f"SELECT user_id, item_id, rating FROM {p}split WHERE is_holdout",
        f"{p}mu": f"SELECT avg(rating) AS mu, count(*) AS n_train FROM {p}train",
        f"{p}ub": f"""SELECT user_id, sum(rating - (SELECT mu FROM {p}mu)) / (count(*) + {SHRINK})
            AS b_u, count(*) AS n FROM {p}train GROUP BY user_id""",
        f"{p}ib": f"""SELECT t.item_id, sum(t.rating - (SELECT mu FROM {p}mu)
              - coalesce(u.b_u, 0.0)) / (count(*) + {SHRINK}) AS b_i, count(*) AS n
            FROM {p}train t LEFT JOIN {p}ub u USING (user_id) GROUP BY t.item_id""",
        f"{p}res": f"""SELECT t.user_id, t.item_id, t.rating, u.b_u, i.b_i,
              t.rating - (SELECT mu FROM {p}mu) - u.b_u - i.b_i AS y
            FROM {p}train t JOIN {p}ub u USING (user_id) JOIN {p}ib i USING (item_id)""",
        f"{p}edges": f"""SELECT 0 AS side, user_id AS me, item_id AS other, y FROM {p}res
            UNION ALL SELECT 1, item_id, user_id, y FROM {p}res""",
        f"{p}q0": f"SELECT item_id, {_LIST} FROM (SELECT item_id, {_start()} FROM {p}ib)",
    }
    for n in {1, iters}:
        c[f"{p}als{n}"] = _training(p, n)
        c[f"{p}p{n}"] = f"SELECT me AS user_id, n, {_LIST} FROM {p}als{n} WHERE step = {2 * n - 1}"
        c[f"{p}q{n}"] = f"SELECT me AS item_id, n, {_LIST} FROM {p}als{n} WHERE step = {2 * n}"
    c[f"{p}ufac"] = f"""SELECT u.user_id, u.b_u AS bias, u.n, p.f FROM {p}ub u
        JOIN {p}p{iters} p USING (user_id)"""
    c[f"{p}ifac"] = f"""SELECT i.item_id, i.b_i AS bias, i.n, q.f FROM {p}ib i
        JOIN {p}q{iters} q USING (item_id)"""
    c[f"{p}evalsum"] = f"""SELECT count(e) AS n_eval, count(*) - count(e) AS n_skipped,
          sqrt(avg(e * e)) AS rmse, avg(abs(e)) AS mae FROM (
          SELECT CASE WHEN u.user_id IS NOT NULL AND i.item_id IS NOT NULL THEN
            h.rating - greatest(0.5, least(5.0, 0.0 + (SELECT mu FROM {p}mu) + u.bias + i.bias
              + (list_dot_product(u.f, i.f)))) END AS e
          FROM {p}hold h LEFT JOIN {p}ufac u USING (user_id) LEFT JOIN {p}ifac i USING (item_id))"""
    return c


MODEL = _model_ctes("", "merged")
FBMODEL = _model_ctes("fb_", "fbmerged")

_ALL = {**BASE, **MODEL, **FBMODEL, "vecsim": _similar("vec"), "sim": _similar("ifac"),
        "fb_sim": _similar("fb_ifac")}


def _names(text: str) -> list[str]:
    words = set(re.findall(r"\w+", text))
    return [n for n in _ALL if n in words]


@lru_cache(None)
def _needs(name: str) -> tuple[str, ...]:
    return tuple(n for n in _names(_ALL[name]) if n != name)


def _deps(name: str, seen: list) -> None:
    if name not in seen:
        for other in _needs(name):
            _deps(other, seen)
        seen.append(name)


def sql(final: str) -> str:
    order: list = []
    for name in _names(final):
        _deps(name, order)
    if not order:
        return final
    final = re.sub(r"^WITH ", ", ", final)  # tables of its own go on the list
    kept = ("res", "fac", "edges", "merged", "cat")
    trained = [n for n in order if re.search(r"als\d+$", n)]
    kind = {n: " AS MATERIALIZED " for n in order if n.endswith(kept)}
    return (f"WITH {'RECURSIVE ' if trained else ''}"
            + ",\n".join(f"{n}{kind.get(n, ' AS ')}({_ALL[n]})" for n in order) + "\n" + final)


def _hist() -> str:
    k = range(1, RANK + 1)
    dot = " + ".join(f"p.f{i} * q.f{i}" for i in k)
    square = " + ".join(f"p.f{i} * p.f{i} + q.f{i} * q.f{i}" for i in k)
    return f"""SELECT CAST(q.step // 2 AS INTEGER) AS iteration,
          round(sqrt(avg(pow(r.rating - greatest(0.5, least(5.0,
            (SELECT mu FROM mu) + r.b_u + r.b_i + ({dot}))), 2))), 6) AS train_rmse,
          round(sum(pow(r.y - ({dot}), 2) + {REG} * ({square})), 4) AS objective
        FROM res r JOIN als{ITERS} p ON p.me = r.user_id AND p.step % 2 = 1
          JOIN als{ITERS} q ON q.me = r.item_id AND q.step = p.step + 1
        GROUP BY q.step"""


def _factors(alias: str = "f") -> str:
    return (f"round({alias}[1], 6) AS f1, round({alias}[2], 6) AS f2, "
            f"round(list_sum({alias}), 6) AS f_sum")


_SCORE = """((list_dot_product(u.f, i.f)) + i.bias) + ((SELECT mu FROM mu) + u.bias)"""

@lru_cache(None)
def oracle_sql() -> dict[str, str]:
    return {
    "ratings_valid": sql(f"SELECT user_id, item_id, rating, seq FROM raw WHERE {_VALID}"),
    "rating_rejects": sql("""SELECT event_id, user_id, item_id, rating,
        CASE WHEN user_id IS NULL THEN 'null_user' WHEN item_id IS NULL THEN 'null_item'
             WHEN rating IS NULL OR isnan(rating) THEN 'missing_rating'
             WHEN rating < 0.5 THEN 'below_range' ELSE 'above_range' END AS reason
        FROM ev WHERE NOT (""" + _VALID + ") OR user_id IS NULL OR item_id IS NULL "
                          "OR rating IS NULL"),
    "ratings_merged": sql("SELECT user_id, item_id, rating, seq, source FROM merged"),
    "ratings_feedback_only": sql("SELECT user_id, item_id, rating, seq FROM fbmerged"),
    "ratings_documents": sql("SELECT user_id, item_id, rating, ts, seq FROM fbmerged"),
    "documents_user": sql(
        "SELECT user_id, item_id, rating, ts, seq FROM fbmerged WHERE user_id = 7"),
    "ratings_profile": sql("""SELECT count(*) AS n_ratings, count(DISTINCT user_id) AS n_users,
        count(DISTINCT item_id) AS n_items, round(avg(rating), 6) AS mean_rating FROM merged"""),
    "train_val_split": sql("SELECT user_id, item_id, rating, is_holdout FROM split"),
    "id_index": sql("""SELECT 'user' AS kind, user_id AS raw_id,
          CAST(row_number() OVER (ORDER BY user_id) - 1 AS INTEGER) AS idx
        FROM (SELECT DISTINCT user_id FROM train)
        UNION ALL
        SELECT 'item' AS kind, item_id AS raw_id,
          CAST(row_number() OVER (ORDER BY item_id) - 1 AS INTEGER) AS idx
        FROM (SELECT DISTINCT item_id FROM train)"""),
    "user_history": sql("""SELECT user_id, count(*) AS n_ratings,
        round(avg(rating), 6) AS mean_rating, min(rating) AS min_rating,
        max(rating) AS max_rating, count(*) FILTER (WHERE source = 'base') AS n_base,
        count(*) FILTER (WHERE source = 'feedback') AS n_feedback
        FROM merged GROUP BY user_id"""),
    "global_mean": sql("SELECT round(mu, 6) AS mu, n_train FROM mu"),
    "user_bias": sql("SELECT user_id, round(b_u, 6) AS bias, n FROM ub"),
    "item_bias": sql("SELECT item_id, round(b_i, 6) AS bias, n FROM ib"),
    "residuals": sql("SELECT user_id, item_id, rating, round(y, 6) AS y FROM res"),
    "normal_equations": sql("SELECT user_id, count(*) AS n, " + ", ".join(
        f"round(sum(x.f[{i}] * x.f[{j}]), 6) AS xtx_{i}{j}" for i, j in ((1, 1), (1, 2), (2, 2)))
        + ", round(" + " + ".join(f"sum(x.f[{i}] * x.f[{j}])" for i in range(1, RANK + 1)
                                  for j in range(i, RANK + 1)) + ", 6) AS xtx_sum"
        + ", round(sum(x.f[1] * r.y), 6) AS xty_1, round(sum(list_sum(x.f) * r.y), 6) AS xty_sum"
        + " FROM res r JOIN q0 x USING (item_id) GROUP BY user_id"),
    "als_user_half_step": sql(f"SELECT user_id, n, {_factors()} FROM p1"),
    "als_item_half_step": sql(f"SELECT item_id, n, {_factors()} FROM q1"),
    "half_step_unregularised": sql(f"""SELECT user_id, n, n < {RANK} AS deficient,
        true AS solved FROM ub"""),
    "interaction_lists": sql(" UNION ALL ".join(f"""SELECT '{s}' AS side, {me} AS id,
        CAST((k - 1) // {config.LIST_ROWS} AS BIGINT) AS chunk, least({config.LIST_ROWS},
          c - (k - 1) // {config.LIST_ROWS} * {config.LIST_ROWS}) AS n,
        CAST((k - 1) % {config.LIST_ROWS} AS BIGINT) AS place, {other} AS other, rating
        FROM (SELECT *, row_number() OVER (PARTITION BY {me} ORDER BY {other}) AS k,
                count(*) OVER (PARTITION BY {me}) AS c FROM merged)""" for s, me, other in (
                    ("user", "user_id", "item_id"), ("item", "item_id", "user_id")))),
    "als_fit": sql(f"""SELECT item_id, round(b_i, 6) AS bias, n, CAST({RANK} AS INTEGER) AS rank,
        true AS solved FROM ib"""),
    "als_training_history": sql(_hist()),
    "model_reload": sql(f"""SELECT item_id, round(bias, 6) AS bias, n, {_factors()}
        FROM ifac"""),
    "predict_pairs": sql("""SELECT h.user_id, h.item_id, round(raw, 6) AS raw,
        round(greatest(0.5, least(5.0, raw)), 6) AS predicted FROM (
          SELECT h.user_id, h.item_id, (SELECT mu FROM fb_mu) + coalesce(u.bias, 0.0)
            + coalesce(i.bias, 0.0) + coalesce(list_dot_product(u.f, i.f), 0.0) AS raw
          FROM hold h LEFT JOIN fb_ufac u USING (user_id)
            LEFT JOIN fb_ifac i USING (item_id)) h"""),
    "eval_summary": sql("""SELECT n_eval, n_skipped, round(rmse, 6) AS rmse,
        round(mae, 6) AS mae FROM evalsum"""),
    "prediction_errors": sql("""SELECT user_id, item_id, actual, round(pred, 4) AS predicted,
        round(abs(actual - pred), 4) AS error FROM (
          SELECT h.user_id, h.item_id, h.rating AS actual, greatest(0.5, least(5.0,
            0.0 + (SELECT mu FROM mu) + u.bias + i.bias + (list_dot_product(u.f, i.f)))) AS pred
          FROM hold h JOIN ufac u USING (user_id) JOIN ifac i USING (item_id))"""),
    "recommend_personalized": sql(f"""SELECT user_id, rank, item_id, round(score, 6) AS score,
        round(greatest(0.5, least(5.0, score)), 6) AS predicted FROM (
          SELECT user_id, item_id, score, CAST(row_number() OVER (PARTITION BY user_id
            ORDER BY score DESC, item_id) AS INTEGER) AS rank FROM (
            SELECT u.user_id, i.item_id, round({_SCORE}, 9) AS score
            FROM ufac u JOIN ifac i ON TRUE
            WHERE NOT EXISTS (SELECT 1 FROM merged s WHERE s.user_id = u.user_id
                                AND s.item_id = i.item_id)))
        WHERE rank <= 10"""),
    "recommend_routed": sql(f"""SELECT user_id, 'personalized' AS source, rank, item_id, title
        FROM (SELECT user_id, item_id, CAST(row_number() OVER (PARTITION BY user_id
            ORDER BY score DESC, item_id) AS INTEGER) AS rank FROM (
            SELECT u.user_id, i.item_id, round({_SCORE.replace('FROM mu', 'FROM fb_mu')}, 9) AS score
            FROM fb_ufac u JOIN fb_ifac i ON TRUE
            WHERE u.user_id IN (SELECT user_id FROM merged UNION SELECT c_custkey FROM customer)
              AND NOT EXISTS (SELECT 1 FROM merged s WHERE s.user_id = u.user_id
                                AND s.item_id = i.item_id)))
          JOIN movies USING (item_id) WHERE rank <= 10
        UNION ALL
        SELECT a.user_id, 'cold_start' AS source, p.rank, p.item_id, p.title
        FROM (SELECT user_id FROM merged UNION SELECT c_custkey FROM customer) a
        JOIN (SELECT CAST(row_number() OVER (ORDER BY avg_rating DESC, rating_count DESC,
                item_id) AS INTEGER) AS rank, item_id, title FROM cat
              ORDER BY avg_rating DESC, rating_count DESC, item_id LIMIT 10) p ON TRUE
        WHERE a.user_id NOT IN (SELECT user_id FROM fb_ufac)"""),
    "similar_items": sql("""SELECT item_id, rank, similar_id, round(cosine, 6) AS cosine
        FROM sim"""),
    "similar_vectors": sql("""SELECT item_id, rank, similar_id, round(cosine, 6) AS cosine
        FROM vecsim"""),
    "recommend_cold_start": sql("""SELECT CAST(row_number() OVER (ORDER BY avg_rating DESC,
          rating_count DESC, item_id) AS INTEGER) AS rank, item_id, title,
          round(avg_rating, 6) AS avg_rating, rating_count
        FROM cat ORDER BY avg_rating DESC, rating_count DESC, item_id LIMIT 10"""),
    "movie_stats": sql("""SELECT item_id, round(avg_rating, 6) AS avg_rating, rating_count
        FROM mstats"""),
    "catalogue": sql("""SELECT c.item_id, c.title, array_to_string(c.genres, ', ') AS genres_text,
        CAST(len(c.genres) AS INTEGER) AS n_genres, round(c.avg_rating, 6) AS avg_rating,
        c.rating_count, (i.item_id IS NOT NULL) AS has_model
        FROM cat c LEFT JOIN fb_ib i USING (item_id)"""),
    "user_dim": sql("""SELECT a.user_id, 'user_' || CAST(a.user_id AS VARCHAR) AS username,
        (u.user_id IS NOT NULL) AS has_model, false AS is_new FROM (
          SELECT user_id FROM merged UNION SELECT c_custkey FROM customer
          UNION SELECT user_id FROM fb_ub) a LEFT JOIN fb_ub u USING (user_id)"""),
    "catalogue_page": sql("""SELECT item_id, title, round(avg_rating, 6) AS avg_rating,
        rating_count FROM cat ORDER BY item_id LIMIT 20 OFFSET 40"""),
    "catalogue_card": sql("""SELECT item_id, title,
        array_to_string(genres[1:3], ' · ') AS genre_label,
        round(avg_rating, 1) AS avg_label, round(avg_rating, 2) AS avg_rating_2,
        rating_count FROM cat"""),
    "my_ratings": sql("""SELECT r.user_id, r.item_id, c.title, r.rating AS user_rating,
        round(c.avg_rating, 6) AS avg_rating, c.rating_count
        FROM merged r JOIN cat c USING (item_id)"""),
    "movie_detail": sql("""SELECT c.item_id, c.title, s.rank, s.similar_id,
        c2.title AS similar_title, round(s.cosine, 6) AS cosine
        FROM cat c LEFT JOIN (fb_sim s JOIN cat c2 ON c2.item_id = s.similar_id)
          ON s.item_id = c.item_id"""),
    "movie_detail_nested": sql("""WITH r AS (SELECT item_id, title,
          round(avg_rating, 6) AS avg_rating, rating_count FROM cat),
        l AS (SELECT s.item_id, list({'rank': s.rank, 'item_id': r.item_id, 'title': r.title,
            'avg_rating': r.avg_rating, 'rating_count': r.rating_count,
            'cosine': round(s.cosine, 6)} ORDER BY s.rank) AS l
          FROM fb_sim s JOIN r ON r.item_id = s.similar_id GROUP BY s.item_id)
        SELECT r.item_id, CAST(to_json({'movie': {'item_id': r.item_id, 'title': r.title,
            'avg_rating': r.avg_rating, 'rating_count': r.rating_count},
            'similar': coalesce(l, [])}) AS VARCHAR) AS answer,
          CAST(coalesce(len(l), 0) AS INTEGER) AS n_similar
        FROM r LEFT JOIN l USING (item_id)"""),
    "catalogue_after": sql("""SELECT item_id, title, round(avg_rating, 6) AS avg_rating,
        rating_count FROM cat WHERE item_id > 59 ORDER BY item_id LIMIT 20"""),
    "movie_lookup": sql("""SELECT item_id, title, round(avg_rating, 6) AS avg_rating,
        rating_count FROM cat WHERE item_id = 42"""),
    "my_ratings_user": sql("""SELECT r.user_id, r.item_id, c.title, r.rating AS user_rating,
        round(c.avg_rating, 6) AS avg_rating, c.rating_count
        FROM merged r JOIN cat c USING (item_id) WHERE r.user_id = 7"""),
    "rating_upsert": sql("""SELECT m.item_id, m.title, round(avg(s.rating), 6) AS avg_rating,
          count(*) AS rating_count
        FROM live s JOIN movies m USING (item_id)
        WHERE s.item_id IN (SELECT item_id FROM evalid)
        GROUP BY m.item_id, m.title"""),
    "ratings_snapshot_stream": sql("SELECT user_id, item_id, rating, seq FROM live"),
    "movie_stats_stream": sql("""SELECT item_id, round(avg(rating), 6) AS avg_rating,
        count(*) AS rating_count FROM live GROUP BY item_id"""),
    "popular_stream": sql("""SELECT CAST(row_number() OVER (ORDER BY a DESC, rating_count DESC,
          item_id) AS INTEGER) AS rank, item_id, title, round(a, 6) AS avg_rating, rating_count
        FROM (SELECT item_id, avg(rating) AS a, count(*) AS rating_count FROM live
              GROUP BY item_id) JOIN movies USING (item_id)
        ORDER BY a DESC, rating_count DESC, item_id LIMIT 10"""),
    "retrain": sql("""SELECT v.version, v.n_train, v.n_eval, v.n_skipped,
        round(v.rmse, 6) AS new_rmse, round(v.mae, 6) AS new_mae,
        v.version = 'all' OR p.promote AS promote, (SELECT n_train FROM mu) AS saved_n_train,
        CASE WHEN p.promote THEN 'feedback' ELSE 'all' END AS current
        FROM (SELECT 'all' AS version, (SELECT n_train FROM mu) AS n_train, * FROM evalsum
              UNION ALL SELECT 'feedback', (SELECT n_train FROM fb_mu), * FROM fb_evalsum) v,
          (SELECT f.rmse <= o.rmse AND f.mae <= o.mae AS promote
           FROM fb_evalsum f, (SELECT sqrt(avg(e * e)) AS rmse, avg(abs(e)) AS mae FROM (
             SELECT CASE WHEN u.user_id IS NOT NULL AND i.item_id IS NOT NULL THEN
               h.rating - greatest(0.5, least(5.0, 0.0 + (SELECT mu FROM mu) + u.bias + i.bias
                 + (list_dot_product(u.f, i.f)))) END AS e
             FROM fb_hold h LEFT JOIN ufac u USING (user_id)
               LEFT JOIN ifac i USING (item_id))) o) p"""),
    "retrain_eval": sql("""SELECT n_eval, n_skipped, round(rmse, 6) AS rmse,
        round(mae, 6) AS mae FROM fb_evalsum"""),
    "promote_decision": sql("""SELECT round(o.rmse, 6) AS old_rmse, round(f.rmse, 6) AS new_rmse,
        round(o.mae, 6) AS old_mae, round(f.mae, 6) AS new_mae,
        (f.rmse <= o.rmse + 0.0 AND f.mae <= o.mae + 0.0) AS promote
        FROM evalsum o, (SELECT count(e) AS n_eval, sqrt(avg(e * e)) AS rmse, avg(abs(e)) AS mae
          FROM (SELECT CASE WHEN u.user_id IS NOT NULL AND i.item_id IS NOT NULL THEN
            h.rating - greatest(0.5, least(5.0, 0.0 + (SELECT mu FROM fb_mu) + u.bias + i.bias
              + (list_dot_product(u.f, i.f)))) END AS e
            FROM hold h LEFT JOIN fb_ufac u USING (user_id) LEFT JOIN fb_ifac i USING (item_id))) f"""),
    "retrain_due": sql("""SELECT count(*) AS n_new, count(*) >= 1000 AS retrain FROM merged
        WHERE ts > (SELECT max(ts) FROM raw WHERE year(ts) < 2000)"""),
}
