"""SQL counterparts of the operators that SQL can express, over the same tables."""

from __future__ import annotations

_OP4 = """
WITH RECURSIVE vectors AS (
    SELECT vec_id, row_number() OVER () AS n,
           CASE WHEN len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
                 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
                THEN CAST(embedding AS DOUBLE[]) END AS v
    FROM embeddings),
links AS (
    SELECT a.n AS a, b.n AS b FROM vectors a JOIN vectors b
    ON a.n <> b.n AND len(a.v) = len(b.v)
    WHERE CASE WHEN len(a.v) = len(b.v) THEN list_cosine_similarity(a.v, b.v) END >= 0.9),
reached AS (
    SELECT n AS a, n AS b FROM vectors
    UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a)
SELECT o.vec_id, (SELECT count(*) FROM links WHERE a = o.n) AS n_links,
       min(t.vec_id) AS component_id, o.vec_id = min(t.vec_id) AS kept
FROM vectors o JOIN reached r ON o.n = r.a JOIN vectors t ON r.b = t.n
GROUP BY o.n, o.vec_id
"""

_OP7 = r"""
WITH sized AS (
    SELECT doc_id, source,
           len(regexp_extract_all(coalesce("text", ''), '[^\x20\x09-\x0D]+')) AS size,
           CAST('0x' || substr(md5(concat_ws(':', '2024', coalesce(CAST(doc_id AS VARCHAR), '-'),
                                             coalesce("text", '-'))), 1, 15) AS BIGINT) AS draw
    FROM documents),
sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           CAST([5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight
    FROM sized GROUP BY source),
-- Sources in the order in which a rising level reaches their caps.
filling AS (
    SELECT *, 2.0 * source_size AS cap, 2.0 * source_size / weight AS full_at,
           (1.5 * sum(source_size) OVER () - coalesce(sum(2.0 * source_size) OVER before, 0))
           / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
    FROM sources
    WINDOW before AS (ORDER BY 2.0 * source_size / weight, source
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
water AS (
    SELECT coalesce((SELECT level FROM filling WHERE full_at >= level
                     ORDER BY full_at, source LIMIT 1), 1e300) AS level),
aimed AS (
    SELECT source, source_size, least(cap, weight * water.level) AS target,
           CASE WHEN source_size > 0
                THEN floor(least(cap, weight * water.level) / source_size) ELSE 0 END AS whole
    FROM filling, water),
drawn AS (
    SELECT source, draw, sum(size) AS size, max(size) AS each, count(*) AS alike
    FROM sized GROUP BY source, draw),
running AS (
    SELECT d.*, target - whole * source_size AS missing,
           sum(d.size) OVER (PARTITION BY d.source ORDER BY d.draw) AS through
    FROM drawn d JOIN aimed a ON d.source IS NOT DISTINCT FROM a.source),
gaps AS (
    SELECT source, coalesce(max(draw) FILTER (through <= missing), -1) AS last_draw,
           any_value(missing) - coalesce(max(through) FILTER (through <= missing), 0) AS gap
    FROM running WHERE missing > 0 GROUP BY source),
-- Of the rows alike that come next, as many as fit, and one more row that fills the rest best.
following AS (
    SELECT g.source, min(r.draw) AS next_draw, floor(any_value(gap) / arg_min(each, r.draw)) AS fitting,
           any_value(gap) - floor(any_value(gap) / arg_min(each, r.draw)) * arg_min(each, r.draw) AS rest
    FROM running r JOIN gaps g ON r.source IS NOT DISTINCT FROM g.source
    WHERE r.draw > last_draw AND each > 0 GROUP BY g.source),
more AS (
    SELECT f.source, arg_min(r.draw, (abs(each - rest), r.draw)) AS draw
    FROM running r JOIN gaps g ON r.source IS NOT DISTINCT FROM g.source
    JOIN following f ON r.source IS NOT DISTINCT FROM f.source
    WHERE r.draw > last_draw AND each > 0 AND abs(each - rest) < rest GROUP BY f.source),
picked AS (
    SELECT source, draw, sum(n) AS n FROM (
        SELECT source, next_draw AS draw, fitting AS n FROM following
        UNION ALL SELECT source, draw, 1 FROM more) GROUP BY source, draw),
placed AS (SELECT *, row_number() OVER (PARTITION BY source, draw) AS number FROM sized)
SELECT s.doc_id, s.size, a.source_size, a.target,
       CAST(s.size * (whole + CAST(coalesce(s.draw <= last_draw, false)
                                   OR coalesce(number <= p.n, false) AS INT)) AS BIGINT) AS taken
FROM placed s JOIN aimed a ON s.source IS NOT DISTINCT FROM a.source
LEFT JOIN gaps g ON s.source IS NOT DISTINCT FROM g.source
LEFT JOIN picked p ON s.source IS NOT DISTINCT FROM p.source AND s.draw = p.draw
"""


def _found(kind: str, pattern: str, group: int, keeps: str, table: str = "texts") -> str:
    """Matches of a pattern in a table's texts, with their places from what stands between them."""
    return f"""
        SELECT n, '{kind}' AS kind, start, start + length(hit) AS "end", value
        FROM (SELECT n, hits[i] AS hit, vals[i] AS value,
                     CAST(list_sum(list_transform(gaps[1:i], lambda g: length(g)))
                          + coalesce(list_sum(list_transform(hits[1:i - 1], lambda h: length(h))), 0)
                          AS BIGINT) AS start
              FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i
                    FROM (SELECT n, string_split_regex("text", '{pattern}') AS gaps,
                                 regexp_extract_all("text", '{pattern}') AS hits,
                                 regexp_extract_all("text", '{pattern}', {group}) AS vals
                          FROM {table} WHERE regexp_matches("text", '{pattern}'))))
        WHERE {keeps}"""


_ASSIGN = (
    r"""(?:(?i)(?:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
)
_RANDOM = "len(list_distinct(string_split(value, ''''))) >= 8".replace("''''", "''")

_OP8 = f"""
WITH texts AS (
    SELECT row_number() OVER () AS n, doc_id, source, lang, coalesce("text", '') AS "text"
    FROM documents),
known AS (
    {_found("assign", _ASSIGN, 1, "length(value) >= 8")}
    UNION ALL {_found("access", "AKIA[A-Z0-9]+", 0, "length(value) >= 16")}
    UNION ALL {_found("hex", "[0-9a-f]{32,}", 0, "true")}),
loose AS (
    {_found("random", "[A-Za-z0-9+/_=-]{20,}", 0, "regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]') AND " + _RANDOM)}),
spans AS (
    SELECT * FROM known
    UNION ALL
    SELECT * FROM loose l WHERE NOT EXISTS (
        SELECT 1 FROM known k WHERE k.n = l.n AND k.start < l."end" AND l.start < k."end")),
carried AS (
    SELECT value, count(DISTINCT coalesce('+' || source, '')) AS owners,
           count(DISTINCT [source, lang]) AS repositories
    FROM spans JOIN texts USING (n) GROUP BY value),
judged AS (
    SELECT s.* EXCLUDE (value), value, list_position(['assign', 'access', 'hex', 'random'], kind) AS place,
           owners < 3 AND NOT (owners = 2 AND repositories >= 4) AND ({_RANDOM} OR kind <> 'assign') AS live,
           owners, repositories
    FROM spans s JOIN carried USING (value)
    WHERE kind <> 'random' OR owners = 1),
listed AS (
    SELECT n, count(*) FILTER (kind = 'assign') AS n_assign,
           count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
           string_agg(kind || ':' || start || ':' || "end", ',' ORDER BY start, place)
               FILTER (kind <> 'random') AS base,
           string_agg(kind || ':' || start || ':' || "end", ',' ORDER BY start, place) AS spans,
           count(*) FILTER (live) AS n_live,
           string_agg(owners, ',' ORDER BY start, place) AS owners,
           string_agg(repositories, ',' ORDER BY start, place) AS repositories
    FROM judged GROUP BY n)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live,
       coalesce(owners, '') AS owners, coalesce(repositories, '') AS repositories
FROM texts LEFT JOIN listed USING (n)
"""


_DIGITS = "regexp_replace(value, '[^0-9]', '', 'g')"
_LUHN = f"""list_sum(list_transform(range(1, length({_DIGITS}) + 1),
    lambda i: CASE WHEN i % 2 = 1 THEN CAST(reverse({_DIGITS})[i] AS INT)
              ELSE CAST(reverse({_DIGITS})[i] AS INT) * 2 % 10 + CAST(reverse({_DIGITS})[i] AS INT) * 2 // 10
              END)) % 10 = 0"""
_TERM = r"\p{L}[\p{L}\p{N}]{2,}"

_OP1 = f"""
WITH texts AS (
    SELECT row_number() OVER () AS n, doc_id, coalesce("text", '') AS "text" FROM documents),
base AS (
    {_found("email", "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)+", 0, "true")}
    UNION ALL {_found("ip", "[0-9]+(?:[.][0-9]+)(?:[.][0-9]+)(?:[.][0-9]+)", 0,
        "len(list_filter(string_split(value, '.'), lambda p: length(ltrim(p, '0')) > 3 OR CAST(p AS HUGEINT) > 255)) = 0")}
    UNION ALL {_found("card", "[0-9](?:[ -]?[0-9])+", 0, f"length({_DIGITS}) BETWEEN 13 AND 19 AND {_LUHN}")}
    UNION ALL {_found("phone", "[+][0-9][ ().0-9-]+[0-9]", 0, f"length({_DIGITS}) BETWEEN 9 AND 15")}),
levelled AS (
    SELECT n, kind, lower(value) AS own, unnest(range(0, 4)) AS level, unnest([
        lower(value),
        CASE kind WHEN 'email' THEN regexp_extract(lower(value), '[^@]+$')
                  WHEN 'ip' THEN regexp_extract(value, '^[0-9]+[.][0-9]+')
                  WHEN 'card' THEN left({_DIGITS}, 6) ELSE left({_DIGITS}, 4) END,
        CASE kind WHEN 'email' THEN regexp_extract(lower(value), '[^.]+$')
                  WHEN 'ip' THEN regexp_extract(value, '^[0-9]+')
                  WHEN 'card' THEN left({_DIGITS}, 1) ELSE left({_DIGITS}, 2) END,
        '']) AS class
    FROM base),
total AS (SELECT CAST(count(*) AS DOUBLE) AS total FROM texts),
entity_docs AS (
    SELECT kind, level, class, count(DISTINCT n) AS entity_docs FROM levelled, total
    GROUP BY ALL HAVING count(DISTINCT n) >= 3 AND count(DISTINCT n) < any_value(total)),
-- The narrowest class that enough documents have.
held AS (
    SELECT DISTINCT n, kind, level, class, entity_docs FROM (
        SELECT *, min(level) OVER (PARTITION BY n, kind, own) AS first
        FROM levelled JOIN entity_docs USING (kind, level, class))
    WHERE level = first),
covered AS (
    SELECT n, list(DISTINCT {{'start': start, 'end': "end"}}) AS places FROM base GROUP BY n),
blanked AS (
    SELECT n, array_to_string(list_transform(string_split("text", ''), lambda c, i: CASE
               WHEN len(list_filter(places, lambda p: p."start" < i AND i <= p."end")) > 0 THEN ' '
               ELSE c END), '') AS "text"
    FROM covered JOIN texts USING (n)),
terms AS (
    {_found("term", _TERM, 0, "true", "blanked")}),
words AS (SELECT DISTINCT n, lower(value) AS word FROM terms),
pairs AS (
    SELECT kind, level, class, entity_docs, word, count(*) AS together
    FROM held JOIN words USING (n) GROUP BY ALL HAVING count(*) >= 3),
word_docs AS (
    SELECT word, count(DISTINCT n) AS word_docs
    FROM (SELECT n, unnest(regexp_extract_all(lower("text"), '{_TERM}')) AS word FROM texts)
    GROUP BY word),
disclosing AS (
    SELECT kind, level, class, word FROM pairs JOIN word_docs USING (word), total
    WHERE log2(together * total / (word_docs * entity_docs)) / log2(total / entity_docs) >= 0.75),
judged AS (
    SELECT DISTINCT n, word FROM held JOIN disclosing USING (kind, level, class) JOIN words USING (n, word)),
spans AS (
    SELECT n, kind, start, "end" FROM base
    UNION ALL
    SELECT terms.n, 'term', start, "end" FROM terms JOIN judged ON judged.n = terms.n AND word = lower(value)),
placed AS (
    SELECT *, kind || ':' || start || ':' || "end" AS shown,
           list_position(['email', 'ip', 'card', 'phone', 'term'], kind) AS place FROM spans),
listed AS (
    SELECT n, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
           count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
           count(*) FILTER (kind = 'term') AS n_term,
           string_agg(shown, ',' ORDER BY place, start) FILTER (kind <> 'term') AS base,
           string_agg(shown, ',' ORDER BY place, start) AS spans
    FROM placed GROUP BY n)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip,
       coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_term, 0) AS n_term
FROM texts LEFT JOIN listed USING (n)
"""


# A checksum's register takes in a byte, then shifts eight times.
_CRC32 = """xor(4294967295, list_reduce(
    flatten([[4294967295]] || list_transform(range(1, length({text}) + 1),
        lambda i: [ascii(({text})[i]), -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda crc, step: CASE WHEN step < 0 THEN xor(crc >> 1, (crc & 1) * 3988292384) ELSE xor(crc, step) END))"""

_OP12 = rf"""
WITH turns AS (
    SELECT conv_id, {{'role': coalesce(role, ''), 'text': coalesce("text", '')}} AS said,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(
               length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce("text", ''))) AS place
    FROM conversations WHERE conv_id IS NOT NULL),
told AS (SELECT conv_id, list(said ORDER BY place) AS said FROM turns GROUP BY conv_id),
convs AS (
    SELECT *, {_CRC32.format(text="CAST(conv_id AS VARCHAR)")} % 4 AS h FROM told),
rebuilt AS (
    SELECT c.conv_id, coalesce(b.said[1:c.h], []) || c.said[c.h + 1:] AS path
    FROM convs c LEFT JOIN told b ON b.conv_id = c.conv_id - c.conv_id % 20),
members AS (
    SELECT conv_id, len(path) = d AS ends, d AS depth, path[1:d] AS prefix
    FROM (SELECT *, unnest(range(0, len(path) + 1)) AS d FROM rebuilt)),
nodes AS (
    SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), ''))
               AS ends_sha256
    FROM members GROUP BY depth, prefix),
children AS (
    SELECT depth - 1 AS depth, prefix[1:depth - 1] AS prefix, count(*) AS n_children
    FROM nodes WHERE depth > 0 GROUP BY ALL),
valued AS (
    SELECT n.*, coalesce(n_children, 0) AS n_children,
           CASE WHEN depth = 0 THEN 0 ELSE
               (n_convs - 1) * len(regexp_extract_all(prefix[depth].text, '[^ 	-
]+')) END AS saved
    FROM nodes n LEFT JOIN children USING (depth, prefix)),
below AS (
    SELECT k AS depth, prefix[1:k] AS prefix, count(*) FILTER (n_children = 0) AS n_leaves,
           CAST(sum(saved) AS BIGINT) AS saved_tokens
    FROM (SELECT *, unnest(range(0, depth + 1)) AS k FROM valued) GROUP BY k, prefix[1:k])
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, n_leaves, saved_tokens,
       v.ends_sha256
FROM valued v JOIN below USING (depth, prefix)
LEFT JOIN nodes p ON p.depth = v.depth - 1 AND p.prefix = v.prefix[1:v.depth - 1]
"""

_TERMS = r"""regexp_extract_all(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

_OP13 = f"""
WITH docs AS (
    SELECT row_number() OVER () AS d, doc_id, {_TERMS} AS terms FROM documents),
sized AS (SELECT d, doc_id, len(terms) AS n FROM docs WHERE len(terms) > 0),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sized),
held AS (
    SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(terms) AS term FROM docs) GROUP BY d, term),
weighed AS (
    SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM held, total GROUP BY term, docs),
asked AS (
    SELECT i, item_id, term, count(*) AS times
    FROM (SELECT i, item_id, unnest(terms) AS term
          FROM (SELECT row_number() OVER () AS i, item_id, {_TERMS} AS terms FROM benchmark))
    GROUP BY i, item_id, term),
scored AS (
    SELECT i, item_id, d, doc_id, CAST(sum(
        times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // total.terms)))) AS BIGINT) AS score
    FROM asked JOIN weighed USING (term) JOIN held USING (term) JOIN sized USING (d), total
    GROUP BY i, item_id, d, doc_id),
ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS INT) AS rank
    FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_pii": _OP1,
        "op4_embedding_dedup": _OP4,
        "op7_mixing": _OP7,
        "op8_secrets": _OP8,
        "op12_prefix_trie": _OP12,
        "op13_lexical_search": _OP13,
    }
