"""DuckDB SQL of the operators that SQL can express, over the whole tables."""

from __future__ import annotations

EXACT_DEDUP = """
    WITH t AS (SELECT doc_id, sha256(translate(coalesce(text, ''),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS s
               FROM documents)
    SELECT doc_id, max(doc_id) OVER (PARTITION BY s) AS keep_id,
           count(*) OVER (PARTITION BY s) AS group_size,
           doc_id = max(doc_id) OVER (PARTITION BY s) AS kept,
           s AS text_sha256
    FROM t"""


def crc32(text: str) -> str:
    """crc32 of an ASCII text: every ninth step takes in a byte, the others shift."""
    return f"""xor(list_reduce(range(0, 9 * length({text})), lambda c, i:
        CASE WHEN i % 9 = 0 THEN xor(c, ascii(substr({text}, (i // 9 + 1)::BIGINT, 1))::BIGINT)
             WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, 4294967295::BIGINT), 4294967295)"""


def _leaf(text: str) -> str:
    values = ["doc_id", "source", "lang", "n_chars", text]
    parts = [f"coalesce(strlen({v}::VARCHAR) || ':' || {v}, '-')" for v in values]
    return f"sha256({' || '.join(parts)})"


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Levels of eight nodes by a recursive query, for the trees of the langs and that of the
#: subroots (tree -1); then every leaf climbs with its siblings.
MERKLE = f"""
    WITH RECURSIVE d AS (
        SELECT doc_id, lang, {_leaf('text')} AS leaf, {_leaf(_LOWER)} AS other,
               {crc32("coalesce(doc_id::VARCHAR, '')")} % 3 = 0 AS hit
        FROM documents),
    langs AS (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, count(*) OVER () AS trees
              FROM (SELECT DISTINCT lang FROM documents)),
    leaves AS (SELECT d.*, tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
                      count(*) OVER (PARTITION BY tree) AS n
               FROM d JOIN langs ON d.lang IS NOT DISTINCT FROM langs.lang),
    low(tree, level, place, n, h) AS (
        SELECT tree, 0, place, n, leaf FROM leaves
        UNION ALL
        SELECT tree, level + 1, place // 8, any_value((n + 7) // 8), sha256(string_agg(h, '' ORDER BY place))
        FROM low WHERE n > 1 GROUP BY tree, level, place // 8),
    high(tree, level, place, n, h) AS (
        SELECT -1, 0, tree, (SELECT any_value(trees) FROM langs), h FROM low WHERE n = 1
        UNION ALL
        SELECT -1, level + 1, place // 8, any_value((n + 7) // 8), sha256(string_agg(h, '' ORDER BY place))
        FROM high WHERE n > 1 GROUP BY level, place // 8),
    nodes AS (SELECT * FROM low UNION ALL SELECT * FROM high),
    climb(id, tree, level, place, folded, siblings) AS (
        SELECT row_number() OVER () AS id, tree, 0, place, CASE WHEN hit THEN other ELSE leaf END, '' FROM leaves
        UNION ALL
        (WITH up AS (
            SELECT c.id, c.tree, c.level, c.place, c.folded, c.siblings, any_value(n.n) AS n,
                   coalesce(string_agg(n.h, '' ORDER BY n.place) FILTER (WHERE n.place < c.place), '') AS l,
                   coalesce(string_agg(n.h, '' ORDER BY n.place) FILTER (WHERE n.place > c.place), '') AS r
            FROM climb c JOIN nodes n ON n.tree = c.tree AND n.level = c.level AND n.place // 8 = c.place // 8
            GROUP BY ALL)
         SELECT id, CASE WHEN n > 1 THEN tree ELSE -1 END, CASE WHEN n > 1 THEN level + 1 ELSE 0 END,
                CASE WHEN n > 1 THEN place // 8 ELSE tree END,
                CASE WHEN n > 1 THEN sha256(l || folded || r) ELSE folded END, siblings || l || r
         FROM up WHERE n > 1 OR tree <> -1)),
    root AS (SELECT h FROM high WHERE n = 1),
    ends AS (SELECT id, folded, siblings FROM climb
             WHERE tree = -1 AND level = (SELECT max(level) FROM high) AND place = 0),
    named AS (SELECT row_number() OVER () AS id, * FROM leaves)
    SELECT doc_id, leaf, subroots.h AS subroot, root.h AS root, sha256(siblings) AS proof_sha256,
           folded AS folded_root, folded = root.h AS verified
    FROM named JOIN ends USING (id) JOIN (SELECT tree, h FROM low WHERE n = 1) subroots USING (tree), root"""

TOPK = """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
               WHERE embedding IS NOT NULL
                 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
          FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id IS DISTINCT FROM q.vec_id AND len(c.e) = len(q.e))
    SELECT query_id, rank::INTEGER AS rank, vec_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
    WHERE rank <= 10"""

#: Cheapest edits from the end of each conversation: after it, the cost and the edits by
#: state ('0' nothing yet, or the last role's initial); a row's ways are its inserts and edit.
REPAIR = f"""
    WITH RECURSIVE d AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
    k AS (SELECT *, {crc32('key')} % 20 AS k FROM d),
    e AS (SELECT conv_id, turn, CASE k WHEN 4 THEN 'user' ELSE role END AS role,
                 CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
          FROM k, (VALUES (0), (1)) AS c(copy) WHERE k <> 0 AND (copy = 0 OR k = 3)),
    r AS (SELECT *, row_number() OVER w AS i, lag(role) OVER w AS before,
                 rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body
          FROM e WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
    f AS (SELECT *, left(role, 1) AS s,
                 CASE WHEN body = '' THEN 'blank'
                      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                      WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
          FROM r),
    ins(x, w, c, z) AS (VALUES ('0', '', 0, '0'), ('0', 'I', 5, 'u'), ('0', 'II', 10, 'a'),
        ('s', '', 0, 's'), ('s', 'I', 5, 'u'), ('s', 'II', 10, 'a'), ('u', '', 0, 'u'), ('u', 'I', 5, 'a'),
        ('a', '', 0, 'a'), ('a', 'I', 5, 'u')),
    nxt(z, y) AS (VALUES ('0', 'u'), ('s', 'u'), ('a', 'u'), ('u', 'a')),
    way AS (SELECT x, w || 'D' AS w, c + 2 AS c, z AS y, 'D' AS edit, NULL AS need FROM ins
            UNION ALL SELECT x, w || 'K', c, y, 'K', y FROM ins JOIN nxt USING (z)
            UNION ALL SELECT x, w || 'K', c, 's', 'K', 's' FROM ins WHERE z = '0'
            UNION ALL SELECT x, w || 'R', c + 1, y, 'R', NULL FROM ins JOIN nxt USING (z)),
    convs AS (SELECT conv_id, max(i) AS n FROM f GROUP BY conv_id),
    b(conv_id, i, x, best) AS (
        SELECT conv_id, n + 1, x, {{'c': c, 'a': a}} FROM convs,
               (VALUES ('0', 0, ''), ('s', 10, 'II'), ('u', 5, 'I'), ('a', 0, '')) AS t(x, c, a)
        UNION ALL
        SELECT f.conv_id, f.i, way.x,
               min({{'c': b.best.c + way.c + CASE WHEN fault = 'truncated' AND edit <> 'D' THEN 5 ELSE 0 END,
                    'a': way.w || b.best.a}})
        FROM b JOIN f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.i = b.i - 1
               JOIN way ON way.y = b.x AND (edit = 'D' OR fault NOT IN ('blank', 'duplicate'))
                       AND (need IS NULL OR need = f.s)
        GROUP BY f.conv_id, f.i, way.x),
    audits AS (SELECT conv_id, best.c AS cost, best.a AS audit FROM b WHERE i = 1 AND x = '0'),
    letters AS (SELECT conv_id, p, audit[p] AS l FROM audits, LATERAL (SELECT unnest(range(1, length(audit) + 1)) AS p)),
    spots AS (SELECT *, count(*) FILTER (WHERE l <> 'I') OVER w AS i, count(*) FILTER (WHERE l <> 'D') OVER w AS o
              FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY p)),
    placed AS (SELECT spots.*, role, text, s,
                      max(CASE WHEN o = 1 AND l = 'K' AND s = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY spots.conv_id) AS sys
               FROM spots LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM spots.conv_id AND f.i = spots.i),
    lines AS (SELECT conv_id, p,
                     CASE l WHEN 'K' THEN role ELSE CASE WHEN (o - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END END
                     || ':' || CASE l WHEN 'I' THEN '' ELSE text END AS line
              FROM placed WHERE l <> 'D'),
    shas AS (SELECT conv_id, sha256(string_agg(line, chr(10) ORDER BY p)) AS sha FROM lines GROUP BY conv_id),
    counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                      count(*) FILTER (WHERE fault = 'blank') AS blank,
                      count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
                      count(*) FILTER (WHERE fault = 'truncated') AS truncated,
                      count(*) FILTER (WHERE i > 1 AND left(before, 1) || s NOT IN ('su', 'ua', 'au')) AS illegal
               FROM f GROUP BY conv_id)
    SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
           coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
           coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit,
           coalesce(sha, sha256('')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) o
    LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM o.conv_id
    LEFT JOIN audits ON audits.conv_id IS NOT DISTINCT FROM o.conv_id
    LEFT JOIN shas ON shas.conv_id IS NOT DISTINCT FROM o.conv_id"""
