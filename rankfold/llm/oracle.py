"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

from rankfold.llm import licences, mixing, negatives, quality, shards

# A word is a run of characters other than these six.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _pareto_mix() -> str:
    weights = "[" + ", ".join(f"{w}.0" for w in mixing.WEIGHTS) + "]"
    return f"""
    WITH d AS (SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size FROM documents),
    s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
            {weights}[((row_number() OVER (ORDER BY source NULLS LAST) - 1)
              % {len(mixing.WEIGHTS)}) + 1] AS w
          FROM d GROUP BY source),
    c AS (SELECT *, {mixing.MAX_REPEATS}.0 * source_size AS cap, sum(source_size) OVER () AS total,
            sum(w) OVER () AS all_w FROM s),
    r AS (SELECT *, (total - coalesce(sum(cap) OVER k, 0)) / (all_w - coalesce(sum(w) OVER k, 0))
              AS unit FROM c
          WINDOW k AS (ORDER BY cap / w, source NULLS LAST
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    u AS (SELECT unit FROM r WHERE cap / w > unit ORDER BY cap / w, source NULLS LAST LIMIT 1),
    t AS (SELECT source, source_size, least(cap, w * (SELECT unit FROM u)) AS target FROM c),
    e AS (SELECT d.doc_id, d.source, d.size, t.source_size, t.target,
            least(coalesce(t.target / nullif(CAST(t.source_size AS DOUBLE), 0), 0.0),
                  {mixing.MAX_REPEATS}.0) AS e,
            (CAST(('0x' || substr(md5('{mixing.SEED}:' || d.doc_id), 1, 13)) AS BIGINT) + 0.5)
              / CAST({2 ** 52} AS DOUBLE) AS v
          FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
    p AS (SELECT *, CAST(floor(e) AS BIGINT) AS whole, e - floor(e) AS p FROM e),
    q AS (SELECT *, CASE WHEN p > 0 THEN (v / (1 - v)) / (p / (1 - p)) END AS odds FROM p),
    k AS (SELECT *, odds / (1 + odds) AS q,
            target - sum(size * whole) OVER (PARTITION BY source) AS missing FROM q),
    x AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source, q IS NULL ORDER BY q, doc_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM k),
    y AS (SELECT *, whole + CASE WHEN q IS NOT NULL AND before < missing
              AND before + size / 2 <= missing THEN 1 ELSE 0 END AS copies FROM x)
    SELECT doc_id, size, source_size, round(target, 6) AS target,
      CAST(copies * size AS BIGINT) AS taken, source, CAST(copies AS BIGINT) AS copies FROM y"""


def _quality_rules() -> str:
    risk, delta, grid = quality.RISK, quality.DELTA, quality.GRID
    steps = ", ".join(f"('{r}', {i}, {float(c)})" for r, cs in grid.items()
                      for i, c in enumerate(cs))
    score = " ".join(f"WHEN '{r}' THEN {r}" for r in grid)
    ok = " AND ".join(f"coalesce({r} <= (SELECT cut FROM cuts WHERE cuts.lang IS NOT DISTINCT "
                      f"FROM m.lang AND rule = '{r}'), true)" for r in grid)
    return rf"""
    WITH w AS (SELECT doc_id, lang, coalesce(text, '') AS text, {_WORDS} AS ws FROM documents),
    tri AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
            FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
    rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (
              SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM (
                SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM tri) WHERE c > 1)
            GROUP BY doc_id),
    lines AS (SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT l) AS dup FROM (
                SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM w)
              WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
    m0 AS (SELECT w.doc_id, w.lang, CAST(len(ws) AS BIGINT) AS n_words,
             CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(text, '{quality.SYMBOLS}')) AS BIGINT) AS n_symbols,
             CAST(coalesce(l.dup, 0) AS BIGINT) AS n_dup_lines, coalesce(l.n, 0) AS n_lines,
             CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
           FROM w LEFT JOIN lines l USING (doc_id) LEFT JOIN rep r USING (doc_id)),
    m AS (SELECT *, coalesce(n_symbols / nullif(word_chars, 0), 0.0) AS symbol_ratio,
            coalesce(n_dup_lines / nullif(n_lines, 0), 0.0) AS dup_line_ratio,
            coalesce(n_repeat_words / nullif(n_words, 0), 0.0) AS repeat_ratio,
            coalesce(word_chars / nullif(n_words, 0), 0.0) AS word_length,
            n_words < {quality.MIN_WORDS}
              OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed
          FROM m0),
    good AS (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL
             GROUP BY doc_id HAVING max(quality) = 1),
    held AS (SELECT m.* FROM m JOIN good USING (doc_id)),
    walk AS (SELECT lang, rule, i, cut, n, k, CASE WHEN k > n * {risk} THEN 1.0 ELSE (
                 SELECT sum(exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1)
                   + j * ln({risk}) + (n - j) * ln(1 - {risk})))
                 FROM unnest(range(0, k + 1)) t(j)) END AS p
             FROM (SELECT lang, rule, i, cut, count(*) AS n,
                     count(*) FILTER (WHERE CASE rule {score} END > cut) AS k
                   FROM held, (VALUES {steps}) g(rule, i, cut) GROUP BY lang, rule, i, cut)),
    tested AS (SELECT *, p <= {delta} / ((SELECT count(*) FROM (
                 SELECT DISTINCT lang FROM held)) * {len(grid)}) AS passed FROM walk),
    cuts AS (SELECT a.lang, a.rule, arg_max(a.cut, a.i) AS cut FROM tested a WHERE NOT EXISTS (
               SELECT 1 FROM tested b WHERE b.lang IS NOT DISTINCT FROM a.lang
                 AND b.rule = a.rule AND b.i <= a.i AND NOT b.passed) GROUP BY a.lang, a.rule)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
      NOT base_failed AND {ok} AS kept FROM m"""


def _licence_scan() -> str:
    rows = ", ".join("('{}', '{}')".format(n, t.replace("'", "''"))
                     for n, ts in licences.TEMPLATES.items() for t in ts)
    words = r"string_split(trim(regexp_replace(lower({}), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ')"
    return rf"""
    WITH t AS (SELECT licence, k, list_distinct([ws[i] || ' ' || ws[i + 1]
                 FOR i IN range(1, len(ws))]) AS g FROM (
               SELECT licence, row_number() OVER () AS k, {words.format('txt')} AS ws
               FROM (VALUES {rows}) v(licence, txt))),
    u0 AS (SELECT doc_id, unnest(list_distinct(list_concat([coalesce(text, '')],
             regexp_split_to_array(coalesce(text, ''), '\n[ \t\r]*\n\s*'),
             string_split(coalesce(text, ''), chr(10))))) AS u FROM documents),
    u AS (SELECT doc_id, u, list_distinct([ws[i] || ' ' || ws[i + 1]
            FOR i IN range(1, len(ws))]) AS g FROM (
          SELECT doc_id, u, {words.format('u')} AS ws FROM u0) WHERE len(ws) > 1),
    h AS (SELECT doc_id, u, licence, max(2.0 * len(list_intersect(u.g, t.g))
            / (len(u.g) + len(t.g))) AS dice
          FROM u JOIN t ON len(u.g) BETWEEN 0.6 * len(t.g) AND 1.6 * len(t.g)
          GROUP BY doc_id, u, licence),
    b AS (SELECT doc_id, count(DISTINCT u) AS n_units,
            min({{'s': -dice, 'l': licence}}) AS b
          FROM h WHERE dice >= {licences.THRESHOLD} GROUP BY doc_id)
    SELECT doc_id, CAST(coalesce(n_units, 0) AS BIGINT) AS n_units, b.l AS licence,
      -b.s AS dice FROM documents LEFT JOIN b USING (doc_id)"""


def _feistel_shards() -> str:
    m, step, mod, seed = shards.MULTIPLIER, shards.STEP, shards.MODULUS, shards.SEED
    poly = 0xEDB88320

    def mix(x, j):
        y = f"(({x} * {m} + {(j + 1) * step + seed}) % {mod})"
        return y, f"((xor({{y}} >> 15, {{y}}) * {m} + {seed}) % {mod})"

    def passes(source, col):
        """Sub-selects for one pass of the network over ``col``."""
        q = (f"SELECT *, CAST({col} // b AS BIGINT) AS l, CAST({col} % b AS BIGINT) AS r "
             f"FROM {source}")
        for j in range(shards.ROUNDS):
            one, other, size = ("l", "r", "a") if j % 2 == 0 else ("r", "l", "b")
            y, z = mix(other, j)
            q = f"SELECT *, {y} AS y FROM ({q})"
            q = f"SELECT *, {z.format(y='y')} AS z FROM ({q})"
            q = (f"SELECT * EXCLUDE (y, z) REPLACE (({one} + xor(z >> 13, z)) % {size} AS {one}) "
                 f"FROM ({q})")
        return f"SELECT * EXCLUDE (l, r) REPLACE (l * b + r AS {col}) FROM ({q})"
    table = "SELECT i, i AS c FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS i)"
    for _ in range(8):  # the table of CRC-32, bit by bit
        table = (f"SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, {poly}) ELSE c >> 1 END AS c "
                 f"FROM ({table})")
    return f"""
    WITH RECURSIVE tab AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM ({table})),
    d AS (SELECT doc_id, coalesce(text, '') AS text, octet_length(encode(coalesce(text, '')))
            AS n_bytes FROM documents),
    s AS (SELECT doc_id, CAST(n_bytes + 8 AS BIGINT) AS size,
            xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
              [CAST(('0x' || h[2 * i - 1:2 * i]) AS BIGINT) FOR i IN range(1, n_bytes + 1)]),
              LAMBDA c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])),
              4294967295) AS text_crc32
          FROM (SELECT *, hex(encode(text)) AS h, (SELECT t FROM tab) AS t FROM d)),
    n AS (SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1
            AS row_number, count(*) OVER () AS n FROM s),
    ab0 AS (SELECT *, CAST(floor(sqrt(n - 1)) AS BIGINT) + 1 AS a FROM n),
    ab AS (SELECT *, CAST(ceil(n / a) AS BIGINT) AS b, row_number AS p FROM ab0),
    walk AS ({passes('ab', 'p')}
      UNION ALL
      {passes('(SELECT * FROM walk WHERE p >= n)', 'p')})
    SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(p % {shards.SHARDS} AS INTEGER) AS shard,
      CAST(p // {shards.SHARDS} AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard,
      CAST(row_number AS BIGINT) AS row_number FROM walk WHERE p < n"""


def _shared_lists() -> str:
    n = negatives
    return f"""
    WITH v AS MATERIALIZED (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, LAMBDA x: floor({n.UNIT} * CAST(x AS DOUBLE))) AS x
      FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, LAMBDA x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS MATERIALIZED (
      SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
        CAST(list_inner_product(a.x, c.x) AS BIGINT) AS score
      FROM v a JOIN v c ON a.vec_id % {n.EVERY} = 0 AND a.vec_id <> c.vec_id),
    p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id)
            <= {n.POSITIVES}),
    r AS (SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score,
            score AS negative_score, row_number() OVER (
              PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
          FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same
            AND {n.SHARE} * positive_score <= 100 * score AND score <= positive_score)
    SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score,
      negative_score FROM r WHERE rank <= {n.NEGATIVES}"""


ORACLE_SQL: dict[str, str] = {
    "op3_pareto_mix": _pareto_mix(),
    "op6_quality_rules": _quality_rules(),
    "op8_licence_scan": _licence_scan(),
    "op10_feistel_shards": _feistel_shards(),
    "op11_shared_lists": _shared_lists(),
}
