"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations


def _url_sql(depth: int = 7) -> str:
    steps = []
    for d in range(1, depth + 1):
        z = "(g / l - (ag - g) / (al - l))"
        steps.append(f"""
        b{d} AS (SELECT host, template, shape[{d}] AS s, sum(l) AS l, sum(g) AS g, sum(n) AS n FROM t{d - 1}
                 WHERE shape[{d}] IS NOT NULL GROUP BY ALL),
        k{d} AS (SELECT *, count(*) OVER w AS fan, sum(n) OVER w AS an, sum(l) OVER w AS al, sum(g) OVER w AS ag
                 FROM b{d} WINDOW w AS (PARTITION BY host, template)),
        m{d} AS (SELECT host, template, s, CASE WHEN fan > 8 AND an < 4 * fan THEN '*'
                 WHEN fan > 1 AND (l = 0 OR l = al OR ag = 0 OR ag = al
                     OR power({z}, 2) / ((ag / al) * (1 - ag / al) * (1 / l + 1 / (al - l))) < 1.96 * 1.96) THEN '~' ELSE s END AS new FROM k{d}),
        t{d} AS (SELECT t.host, t.shape, t.n, t.l, t.g, t.template || coalesce('/' || m.new, '') AS template FROM t{d - 1} t
                 LEFT JOIN m{d} m ON t.host = m.host AND t.template = m.template AND t.shape[{d}] = m.s)""")
    fits = lambda h, p: f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
    return rf"""
        WITH labelled AS (
            SELECT substr(regexp_replace(trim(substr(text, 1, 160)), '\s+', ' ', 'g'), 1, 40) AS start, (avg(quality) >= 0.5)::INT AS good
            FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL GROUP BY 1 HAVING length(start) = 40
        ), titles AS (
            SELECT page_id, url, replace(replace(replace(replace(replace(regexp_extract(html, '<title>([^<]*)', 1), '&lt;', '<'),
                   '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&amp;', '&') AS title FROM pages
        ), cut AS (
            SELECT page_id, good, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
            FROM titles LEFT JOIN labelled ON start = substr(regexp_replace(trim(title), '\s+', ' ', 'g'), 1, 40)
        ), page AS (
            SELECT page_id, good, lower(regexp_extract(rest, '^[^/?#]*')) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
        ), shaped AS (
            SELECT *, string_split(regexp_replace(path, '[0-9]+', '<n>', 'g'), '/')[2:] AS all_shape FROM page
        ), s AS (
            SELECT *, CASE WHEN len(all_shape) > 6 THEN list_append(all_shape[1:6], '**') ELSE all_shape END AS shape FROM shaped
        ), t0 AS (
            SELECT host, shape, '' AS template, count(*) AS n, count(good)::DOUBLE AS l, coalesce(sum(good), 0)::DOUBLE AS g FROM s GROUP BY ALL
        ), {', '.join(steps)}, corpus AS (SELECT coalesce(sum(g) / nullif(sum(l), 0), 1) AS p FROM t{depth}
        ), hosts AS (SELECT host, (sum(g) + 10 * any_value(p)) / (sum(l) + 10) AS prior FROM t{depth}, corpus GROUP BY host
        ), judged AS (SELECT host, template, (sum(g) + 10 * any_value(prior)) / (sum(l) + 10) AS purity FROM t{depth} JOIN hosts USING (host) GROUP BY ALL)
        SELECT page_id, host, path,
               CASE WHEN {fits('example.net', '/en/')} THEN 'example.net/en/' WHEN {fits('example.com', '/de/')} THEN 'example.com/de/'
                    WHEN {fits('org', '/fr/')} THEN 'org/fr/' WHEN {fits('net', '/')} THEN 'net/' END AS rule,
               CASE WHEN {fits('example.net', '/en/')} THEN 'allow' WHEN {fits('example.com', '/de/')} THEN 'block'
                    WHEN {fits('org', '/fr/')} THEN 'allow' WHEN {fits('net', '/')} THEN 'block'
                    WHEN purity < 0.5 THEN 'block' ELSE 'allow' END AS verdict, template, round(purity, 6) AS purity
        FROM s JOIN t{depth} USING (host, shape) JOIN judged USING (host, template)
    """


def _mixing_sql(sweeps: int = 30) -> str:
    steps, last = [], "start"
    for k in range(sweeps):
        for dim, target in (("source", "ts"), ("lang", "tl"), ("topic", "tt")):
            steps.append(f"f{k}{dim} AS (SELECT * EXCLUDE w, w * {target} / sum(w) OVER (PARTITION BY {dim}) AS w FROM {last})")
            last = f"f{k}{dim}"
    return rf"""
        WITH d AS (
            SELECT doc_id, source AS s0, lang AS l0, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang,
                   CASE WHEN regexp_matches(text, '(?i)licen[cs]e|copyright|all rights reserved') THEN 'license'
                        WHEN regexp_matches(text, '[^\s@]@[^\s@]+\.[a-z]|\d{{3}}[ -]\d{{3,4}}') THEN 'contact'
                        WHEN regexp_matches(text, '[#*$%&|<>]{{3}}') THEN 'markup'
                        WHEN regexp_matches(text, '!!') THEN 'shouting' ELSE 'prose' END AS topic,
                   greatest(1, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)) AS tokens,
                   ('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT / 281474976710656.0::DOUBLE AS draw
            FROM documents
        ), c AS (SELECT source, lang, topic, sum(tokens)::DOUBLE AS t FROM d GROUP BY ALL
        ), m AS (
            SELECT *, power(sum(t) OVER (PARTITION BY source), 0.9) AS ps, power(sum(t) OVER (PARTITION BY lang), 0.9) AS pl,
                   power(sum(t) OVER (PARTITION BY topic), 0.95) AS pt FROM c
        ), start AS (
            SELECT *, t AS w, ps / (SELECT sum(p) FROM (SELECT DISTINCT source, ps AS p FROM m)) AS ts,
                   pl / (SELECT sum(p) FROM (SELECT DISTINCT lang, pl AS p FROM m)) AS tl,
                   pt / (SELECT sum(p) FROM (SELECT DISTINCT topic, pt AS p FROM m)) AS tt FROM m
        ), {', '.join(steps)}, p AS (SELECT source, lang, topic, w / t / max(w / t) OVER () AS prob FROM {last})
        SELECT doc_id, s0 AS source, l0 AS lang, d.topic, tokens, round(prob, 6) AS prob, draw < prob AS kept
        FROM d JOIN p ON d.source = p.source AND d.lang = p.lang AND d.topic = p.topic
    """


def _merkle_sql(leaf_levels: int = 8, group_levels: int = 4) -> str:
    """Runs of 8 nodes, level by level, for up to 8**8 documents a language and 8**4 languages."""
    steps, folds = [], []

    def climb(name: str, levels: int, group: str) -> None:
        for k in range(levels):
            steps.append(f"""
        {name}{k + 1} AS (SELECT {group}, i // 8 AS i, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE any_value(h) END AS h,
                 (any_value(n) + 7) // 8 AS n FROM {name}{k} GROUP BY {group}, i // 8)""")

    def fold(name: str, levels: int, group: str, at: str) -> None:
        for k in range(levels):
            step = 8 ** k
            folds.append(f"""
        f{len(folds) + 1} AS (SELECT f.* EXCLUDE (sides, folded), sides || coalesce(lft, '') || coalesce(rgt, '') AS sides,
                 CASE WHEN any_n > 1 THEN sha256(coalesce(lft, '') || folded || coalesce(rgt, '')) ELSE folded END AS folded
               FROM f{len(folds)} f, LATERAL (SELECT max(n) AS any_n, string_agg(h, '' ORDER BY i) FILTER (i < {at} // {step}) AS lft,
                    string_agg(h, '' ORDER BY i) FILTER (i > {at} // {step}) AS rgt
                    FROM {name}{k} x WHERE x.{group} = f.{group} AND x.i // 8 = {at} // {8 * step}))""")

    climb("t", leaf_levels, "g")
    top = len(steps)
    climb("u", group_levels, "one")
    leaf_steps, group_steps = steps[:top], steps[top:]
    fold("t", leaf_levels, "g", "i0")
    fold("u", group_levels, "one", "j0")
    field = lambda c: f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
    head = " || ".join(map(field, ("doc_id", "source", "lang", "n_chars")))
    return rf"""
        WITH d AS (
            SELECT doc_id, coalesce('=' || lang, '') AS g, sha256({head} || {field("text")}) AS leaf,
                   sha256({head} || {field("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) AS lowered,
                   xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c:
                       [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])), lambda a, x:
                       CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295) AS crc
            FROM documents
        ), t0 AS (
            SELECT g, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, leaf AS h, count(*) OVER (PARTITION BY g) AS n FROM d
        ), {','.join(leaf_steps)}, u0 AS (
            SELECT 1 AS one, row_number() OVER (ORDER BY encode(g)) - 1 AS i, h, count(*) OVER () AS n, g FROM t{leaf_levels}
        ), {','.join(group_steps)}, f0 AS (
            SELECT d.doc_id, d.g, d.leaf, row_number() OVER (PARTITION BY d.g ORDER BY d.doc_id NULLS FIRST, d.leaf) - 1 AS i0, u.i AS j0, 1 AS one,
                   u.h AS subroot, CASE WHEN d.crc % 3 = 0 THEN lowered ELSE leaf END AS folded, '' AS sides
            FROM d JOIN u0 u USING (g)
        ), {','.join(folds)}
        SELECT doc_id, leaf, subroot, r.h AS root, sha256(sides) AS proof_sha256, folded AS folded_root, folded = r.h AS verified
        FROM f{len(folds)}, u{group_levels} r
    """


ORACLE: dict[str, str] = {
    "op13_decontamination": r"""
        WITH cut AS (
            SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
            UNION ALL
            SELECT 'i', item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
        ), items AS (
            SELECT id AS item, least(len(ws), 10) AS n, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i, ws FROM cut WHERE kind = 'i' AND len(ws) > 0
        ), windows AS (SELECT DISTINCT item, n, array_to_string(ws[i:i + n - 1], ' ') AS win FROM items
        ), places AS (
            SELECT id AS doc_id, n, unnest(range(1, len(ws) - n + 2)) AS i, ws FROM cut, (SELECT DISTINCT n FROM windows) WHERE kind = 'd' AND len(ws) >= n
        ), found AS (
            SELECT doc_id, item, p.n, p.i FROM (SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS win FROM places) p JOIN windows USING (n, win)
        ), hit AS (SELECT doc_id, count(DISTINCT w) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS w FROM found) GROUP BY doc_id
        ), whose AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
                     FROM (SELECT DISTINCT doc_id, item::VARCHAR AS item FROM found) GROUP BY doc_id)
        SELECT id AS doc_id, coalesce(len(ws), 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM cut LEFT JOIN hit ON id = hit.doc_id LEFT JOIN whose ON id = whose.doc_id WHERE kind = 'd'
    """,
    "op12_merkle_manifest": _merkle_sql(),
    "op2_url_filter": _url_sql(),
    "op8_mixing": _mixing_sql(),
    # every repeated run of 50 words is a union of shortest stretches with 50 words from or up to a line
    "op7_line_dedup": r"""
        WITH split AS (
            SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS p
            FROM documents
        ), full_lines AS (
            SELECT doc_id, p, line, row_number() OVER w AS i, coalesce(lead(p) OVER w, 1000000000) AS nxt,
                   sum(len(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))) OVER w AS till,
                   len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words
            FROM split WHERE regexp_matches(line, '[^\x20\x09-\x0D]') WINDOW w AS (PARTITION BY doc_id ORDER BY p)
        ), stretches AS (
            SELECT a.doc_id, a.i, min(b.i) AS e FROM full_lines a JOIN full_lines b ON a.doc_id = b.doc_id AND b.i >= a.i
                AND b.till - a.till + a.words >= 50 GROUP BY ALL
            UNION
            SELECT a.doc_id, max(b.i), a.i FROM full_lines a JOIN full_lines b ON a.doc_id = b.doc_id AND b.i <= a.i
                AND a.till - b.till + b.words >= 50 GROUP BY a.doc_id, a.i
        ), content AS (
            SELECT s.doc_id, s.i, s.e, string_agg(l.line, chr(10) ORDER BY l.i) AS lines
            FROM stretches s JOIN full_lines l ON l.doc_id = s.doc_id AND l.i BETWEEN s.i AND s.e GROUP BY ALL
        ), later AS (
            SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lines ORDER BY doc_id, i) AS nth FROM content) WHERE nth > 1
        ), gone AS (
            SELECT DISTINCT l.doc_id, l.p, l.nxt FROM later r JOIN full_lines l ON l.doc_id = r.doc_id AND l.i BETWEEN r.i AND r.e
        ), kept AS (
            SELECT s.doc_id, string_agg(s.line, chr(10) ORDER BY s.p) AS text FROM split s
            WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = s.doc_id AND s.p >= g.p AND s.p < g.nxt) GROUP BY s.doc_id
        )
        SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text,
               (SELECT count(*) FROM gone g WHERE g.doc_id = d.doc_id) AS n_removed
        FROM documents d LEFT JOIN kept k USING (doc_id)
    """,
}
