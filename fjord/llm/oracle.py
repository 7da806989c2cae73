"""DuckDB SQL with the results of the registered queries, where SQL can express them."""

from __future__ import annotations

ORACLE: dict[str, str] = {
    "op6_nearest": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        p AS (
            SELECT q.vec_id AS query_id, v.vec_id, list_dot_product(q.e, v.e) AS score
            FROM v AS q JOIN v ON NOT (q.vec_id = v.vec_id AND q.e = v.e)
            WHERE q.vec_id % 20 = 0),
        r AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
        SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20""",
    "op8_exact_dedup": """
        WITH t AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                     'abcdefghijklmnopqrstuvwxyz') AS n
            FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(n) AS text_sha256
        FROM t WINDOW w AS (PARTITION BY n)""",
}


def _fill_sql(name: str, values: str, total: str, within: str = "''", rounds: int = 12) -> list[str]:
    """A total dealt by share in a chain of rounds: values below their share are filled first."""
    steps = [f"{name}_0 AS MATERIALIZED (SELECT *, {within} AS within, {total} AS total, false AS taken FROM ({values}))"]
    level = ("(total - coalesce(sum(have) FILTER (taken) OVER w, 0)) / nullif(sum(share) FILTER (NOT taken) OVER w, 0)")
    for i in range(rounds):
        steps.append(f"""{name}_{i + 1} AS MATERIALIZED (
            SELECT * EXCLUDE (level) REPLACE (taken OR share > 0 AND coalesce(level * share >= have, false) AS taken)
            FROM (SELECT *, {level} AS level FROM {name}_{i} WINDOW w AS (PARTITION BY within)))""")
    steps.append(f"""{name} AS MATERIALIZED (
        SELECT *, CASE WHEN taken THEN have ELSE coalesce({level} * share, 0) END AS target
        FROM {name}_{rounds} WINDOW w AS (PARTITION BY within))""")
    return steps


def _mixing_sql(sweeps: int = 70, fraction: float = 0.7, temper: float = 0.7, seed: str = "mix") -> str:
    """Keywords from unnested words, targets filled in rounds, the raking as a chain of windows."""
    steps = [f"""d AS MATERIALIZED (
        SELECT row_number() OVER () AS u, doc_id, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang,
               len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\r]+')) AS tokens,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[a-z]{{4,}}') AS words,
               ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, ''))) || ':{seed}'), 1, 13))::BIGINT
                   / {1 << 52}::DOUBLE AS r
        FROM documents)""",
             """kw AS MATERIALIZED (
        SELECT lang, word, df FROM (SELECT lang, word, count(*) AS df FROM (SELECT lang, unnest(list_distinct(words)) AS word FROM d) GROUP BY ALL)
        JOIN (SELECT lang, count(*) AS docs FROM d GROUP BY lang) USING (lang)
        WHERE 100 * df >= docs AND 5 * df <= docs QUALIFY row_number() OVER (PARTITION BY lang ORDER BY df DESC, word) <= 4)""",
             """used AS (
        SELECT u, word FROM (SELECT u, lang, word, df, count(*) AS n FROM (SELECT u, lang, unnest(words) AS word FROM d)
                             JOIN kw USING (lang, word) GROUP BY ALL)
        QUALIFY row_number() OVER (PARTITION BY u ORDER BY n DESC, df, word) = 1)""",
             """rows_ AS MATERIALIZED (
        SELECT d.*, CASE WHEN tokens = 0 THEN 'empty' ELSE coalesce(word, 'other') END AS topic FROM d LEFT JOIN used USING (u))""",
             "cells AS MATERIALIZED (SELECT source, lang, topic, sum(tokens)::DOUBLE AS n FROM rows_ GROUP BY ALL)",
             f"budget AS MATERIALIZED (SELECT sum(n) * {fraction} AS b FROM cells)"]
    value = lambda by, more="": (f"SELECT {by}, sum(n) AS have, CASE WHEN sum(n) > 0 THEN pow(sum(n), {temper}) ELSE 0 END AS share"  # noqa: E731
                                 f"{more} FROM cells GROUP BY {by}")
    steps += _fill_sql("g_source", value("source"), "(SELECT b FROM budget)")
    steps += _fill_sql("g_lang", value("lang"), "(SELECT b FROM budget)")
    steps += _fill_sql("g_topic", f"SELECT * FROM ({value('lang, topic')}) JOIN (SELECT lang, target AS goal FROM g_lang) USING (lang)",
                       "goal", "lang")
    steps.append(f"""r0 AS MATERIALIZED (
        SELECT c.source, c.lang, c.topic, c.n, c.n * {fraction} AS y, s.taken OR l.taken OR t.taken AS shut,
               s.target AS t_source, l.target AS t_lang, t.target AS t_topic
        FROM cells AS c JOIN g_source AS s USING (source) JOIN g_lang AS l USING (lang)
             JOIN g_topic AS t ON t.lang = c.lang AND t.topic = c.topic)""")
    last = "r0"
    for i in range(sweeps):
        for c, by in (("source", "source"), ("lang", "lang"), ("topic", "lang, topic")):
            name = f"r{i}_{c}"
            steps.append(f"""{name} AS MATERIALIZED (
            SELECT * EXCLUDE (a, o) REPLACE (y * CASE WHEN o > 0 AND t_{c} > a THEN (t_{c} - a) / o WHEN a + o > 0 THEN t_{c} / (a + o) ELSE 0 END AS y)
            FROM (SELECT *, sum(CASE WHEN shut OR y >= n THEN n ELSE 0 END) OVER w AS a,
                         sum(CASE WHEN shut OR y >= n THEN 0 ELSE y END) OVER w AS o
                  FROM {last} WINDOW w AS (PARTITION BY {by})))""")
            last = name
    p = "CASE WHEN n = 0 THEN 1.0 WHEN shut OR y >= n THEN 1.0 ELSE y / n END"
    return "WITH " + ",\n".join(steps) + f"""
        SELECT doc_id, source, lang, topic, tokens, round(CASE WHEN n > 0 THEN {p} / {fraction} ELSE 1.0 END, 6) AS weight,
               round({p}, 6) AS probability, r < {p} AS selected
        FROM rows_ JOIN {last} USING (source, lang, topic)"""


ORACLE["op9_mixing"] = _mixing_sql()


def _secrets_sql() -> str:
    """Spans from the pieces between matches; the 40-character runs are cut out whole, as there is no look-around."""
    given = r"""["']?\x20*[:=]\x20*["']?"""
    patterns = {
        "assign": f"(?i:password|passwd|secret|token|api_?key){given}([A-Za-z0-9+/_.=-]+)",
        "access": "AKIA[A-Z0-9]{12,}", "hex": "[0-9a-f]{32,}",
        "id": f"(?i:user(?:_?name)?|login|client_?id|account(?:_?id)?|access_?key_?id){given}[A-Za-z0-9_.@+-]{{3,}}",
        "blob": "[A-Za-z0-9+/]{40,}=?",
        "endpoint": r"""(?i:https?|ftps?|jdbc:[a-z0-9]+|amqps?|rediss?|mongodb|s3)://[^\t\n\x0B\f\r "'<>]+""",
        "blank": r"\n[\x20\t\r]*\n"}
    hits = []
    for kind, pattern in patterns.items():
        p = "'" + pattern.replace("'", "''") + "'"
        value = f"regexp_extract_all(t, {p}, 1)[i]" if kind == "assign" else "''"
        hits.append(f"""SELECT u, '{kind}' AS kind, i, length(string_split_regex(t, {p})[i]) AS gap,
            regexp_extract_all(t, {p})[i] AS m, {value} AS v
            FROM (SELECT u, t, unnest(range(1, len(regexp_extract_all(t, {p})) + 1)) AS i FROM d)""")
    union = " UNION ALL ".join(hits)
    nearby = lambda kinds: (
        f"coalesce(a - max(z) FILTER (kind IN ({kinds}) AND NOT inside) OVER up_to <= 200, false)"
        f" OR coalesce(min(a) FILTER (kind IN ({kinds}) AND NOT inside) OVER onward - z <= 200, false)")
    return f"""
        WITH d AS MATERIALIZED (SELECT row_number() OVER () AS u, doc_id, coalesce(text, '') AS t FROM documents),
        hits AS ({union}),
        placed AS (
            SELECT u, sum(gap + length(m)) OVER w - length(m) AS a, sum(gap + length(m)) OVER w AS z,
                   CASE WHEN kind = 'assign' AND length(v) < 8 OR kind = 'blob' THEN 'secret' ELSE kind END AS kind,
                   kind <> 'blob' OR length(m) = 40 AND m NOT LIKE '%=' AND regexp_matches(m, '[0-9]')
                       AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[A-Z]') AS good
            FROM hits WINDOW w AS (PARTITION BY u, kind ORDER BY i)),
        scoped AS (
            SELECT *, kind IN ('assign', 'access', 'hex') AS strong,
                   sum(CASE WHEN kind = 'blank' THEN 1 ELSE 0 END) OVER w AS scope,
                   max(CASE WHEN kind IN ('assign', 'access', 'hex') THEN z END) OVER w AS covered
            FROM placed WHERE good WINDOW w AS (PARTITION BY u ORDER BY a, z DESC ROWS UNBOUNDED PRECEDING)),
        free AS (SELECT *, NOT strong AND coalesce(covered, 0) > a AS inside FROM scoped WHERE kind <> 'blank'),
        near AS (
            SELECT *, {nearby("'access', 'id'")} AS who, {nearby("'assign', 'hex', 'secret'")} AS what
            FROM free WINDOW up_to AS (PARTITION BY u, scope ORDER BY a RANGE UNBOUNDED PRECEDING),
                             onward AS (PARTITION BY u, scope ORDER BY a RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
        told AS (
            SELECT u, kind, strong, a, list_position(['assign', 'access', 'hex', 'id', 'secret', 'endpoint'], kind) AS rank,
                   kind || ':' || CAST(a AS VARCHAR) || ':' || CAST(z AS VARCHAR) AS span
            FROM near WHERE strong OR NOT inside AND CASE kind WHEN 'id' THEN what WHEN 'secret' THEN who ELSE who AND what END)
        SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
               count(*) FILTER (kind = 'hex') AS n_hex,
               sha256(coalesce(string_agg(span, ',' ORDER BY a, rank) FILTER (strong), '')) AS base_sha256,
               coalesce(string_agg(span, ',' ORDER BY a, rank), '') AS spans
        FROM d LEFT JOIN told USING (u) GROUP BY d.u, doc_id"""


ORACLE["op2_secrets"] = _secrets_sql()


def _verdict_sql(rounds: int = 160, damping: float = 0.85, least: float = 0.01, share: float = 0.75) -> str:
    """Rules by length, then the walks as a chain of joins, long enough for scores to stand still (0.85 ** 160 = 5e-12)."""
    rules = [("block", "example.org", "/en/1"), ("block", "example.org", "/es/"), ("allow", "com", "/fr/"),
             ("block", "com", "/de/"), ("allow", "org", "/")]  # longest first
    fits = lambda h, p: f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
    pick = lambda n: "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{(v, h + p)[n]}'" for v, h, p in rules) + " END"
    low = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    link = r"""(?i)<a\\s[^>]*?href\\s*=\\s*["'']?\\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"''\\s<>]+)""".replace("\\\\", "\\")
    steps = [f"""p AS (
            SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), {low}) AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM (SELECT page_id, html, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
                  FROM pages)),
        judged AS MATERIALIZED (SELECT *, {pick(0)} AS ruled, {pick(1)} AS rule FROM p),
        restart AS MATERIALIZED (
            SELECT * FROM (
                SELECT host, 0 AS kind, {1 - damping} * avg(CASE WHEN ruled = 'allow' THEN 1.0 ELSE 0.0 END) AS v
                FROM judged WHERE host <> '' GROUP BY host
                UNION ALL
                SELECT host, 1, {1 - damping} * avg(CASE WHEN ruled = 'block' THEN 1.0 ELSE 0.0 END)
                FROM judged WHERE host <> '' GROUP BY host)
            WHERE v > 0),
        edges AS (
            SELECT host AS src, dst, count(*) AS n
            FROM (SELECT host, unnest(list_distinct(list_transform(regexp_extract_all(html, '{link}', 1),
                                                                   lambda h: translate(h, {low})))) AS dst
                  FROM judged WHERE host <> '')
            WHERE dst <> host GROUP BY ALL),
        walk AS MATERIALIZED (
            SELECT kind, a, b, n / sum(n) OVER (PARTITION BY kind, a) AS w
            FROM (SELECT 0 AS kind, src AS a, dst AS b, n FROM edges UNION ALL SELECT 1, dst, src, n FROM edges)),
        r0 AS (SELECT * FROM restart)"""]
    for i in range(rounds):
        steps.append(f"""r{i + 1} AS MATERIALIZED (
            SELECT host, kind, sum(v) AS v
            FROM (SELECT b AS host, kind, v * w * {damping} AS v
                  FROM walk JOIN (SELECT host AS a, kind, v FROM r{i}) USING (kind, a)
                  UNION ALL SELECT host, kind, v FROM restart)
            GROUP BY host, kind)""")
    return "WITH " + ",\n".join(steps) + f""",
        score AS (SELECT host, coalesce(sum(v) FILTER (kind = 0), 0.0) AS trust, coalesce(sum(v) FILTER (kind = 1), 0.0) AS distrust
                  FROM r{rounds} GROUP BY host)
        SELECT page_id, j.host, path, rule,
               coalesce(ruled, CASE WHEN distrust >= {least} AND distrust > {share} * (trust + distrust) THEN 'block' ELSE 'allow' END)
                   AS verdict,
               round(coalesce(trust, 0.0), 6) AS trust, round(coalesce(distrust, 0.0), 6) AS distrust
        FROM judged AS j LEFT JOIN score USING (host)"""


ORACLE["op4_url_verdicts"] = _verdict_sql()


def _host_rules_sql(limit: float = 0.5, margin: float = 2.0) -> str:
    """Measures from unnested words and lines, then moments of the hosts' failures per rule."""
    word, blanks = r"[^\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]"
    rules = ["n_words < 10", "100 * n_repeat_words > 20 * n_words", "100 * n_dup_lines > 30 * n_lines",
             "100 * n_symbols > 10 * n_words", "word_chars < 3 * n_words OR word_chars > 12 * n_words"]
    fails = " UNION ALL ".join(
        f"SELECT host, {i} AS rule, count(*)::DOUBLE AS n, count(*) FILTER ({r})::DOUBLE AS k FROM m GROUP BY host"
        for i, r in enumerate(rules))
    return f"""
        WITH d AS MATERIALIZED (
            SELECT row_number() OVER () AS u, doc_id, coalesce(source, '(none)') AS host, coalesce(text, '') AS t FROM documents),
        w AS MATERIALIZED (
            SELECT u, i, words[i] AS word, array_to_string(words[i:i + 4], ' ') AS run, i + 4 <= len(words) AS whole
            FROM (SELECT u, words, unnest(range(1, len(words) + 1)) AS i
                  FROM (SELECT u, regexp_extract_all(t, '{word}') AS words FROM d))),
        marked AS (SELECT *, whole AND count(*) OVER (PARTITION BY u, run, whole) > 1 AS twice FROM w),
        covered AS (SELECT u, length(word) AS chars, bool_or(twice) OVER (
                        PARTITION BY u ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS hit FROM marked),
        by_word AS (SELECT u, count(*) AS n_words, sum(chars)::BIGINT AS word_chars, count(*) FILTER (hit) AS n_repeat_words
                    FROM covered GROUP BY u),
        lines AS (SELECT u, unnest(string_split(t, chr(10))) AS line FROM d),
        by_line AS (SELECT u, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
                    FROM lines WHERE regexp_matches(line, '{blanks}') GROUP BY u),
        m AS MATERIALIZED (
            SELECT doc_id, host, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
                   len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
                   coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines
            FROM d LEFT JOIN by_word USING (u) LEFT JOIN by_line USING (u)),
        fails AS MATERIALIZED ({fails}),
        moments AS (SELECT rule, sum(n) AS total, count(*) AS hosts, sum(k) / sum(n) AS mean, sum(k * k / n) AS squares,
                           sum(n * n) AS sizes FROM fails GROUP BY rule),
        spread AS (SELECT rule, mean, (squares - total * mean * mean) / nullif(mean * (1 - mean), 0) - (hosts - 1) AS between_hosts,
                          total - sizes / total - (hosts - 1) AS room, total FROM moments),
        alike AS (SELECT rule, mean, least(greatest(coalesce(
                      CASE WHEN room > 1e-9 * total THEN between_hosts / room END, 0), 1e-6), 1 - 1e-6) AS c FROM spread),
        rates AS (SELECT host, n, (1 - c) / c AS s, (mean * (1 - c) / c + k) / ((1 - c) / c + n) AS rate
                  FROM fails JOIN alike USING (rule)),
        hosts AS (SELECT host, max(rate) AS host_rate,
                         bool_or(rate - {margin} * sqrt(rate * (1 - rate) / (s + n + 1)) > {limit}) AS host_failed
                  FROM rates GROUP BY host)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {rules[0]} OR {rules[1]} AS base_failed,
               NOT ({rules[0]} OR {rules[1]}) AND NOT host_failed AS kept, host, round(host_rate, 9) AS host_rate
        FROM m JOIN hosts USING (host)"""


ORACLE["op11_host_rules"] = _host_rules_sql()

ORACLE["op12_hard_negatives"] = """
    WITH v AS MATERIALIZED (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    p AS MATERIALIZED (
        SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.e, b.e)::BIGINT AS score
        FROM v AS a JOIN v AS b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
    positive AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM p WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT anchor_id, positive_id,
           (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
           vec_id AS negative_id, positive_score, score AS negative_score
    FROM positive JOIN p USING (anchor_id)
    WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    QUALIFY rank <= 10"""
