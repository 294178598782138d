"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from corpusmill.llm import mixing

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACED = r"'[^\x20\x09-\x0D]+'"


def decontamination(window: int = 13) -> str:
    words = (
        f"coalesce(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), "
        r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"
    )
    return f"""
    WITH d AS (SELECT doc_id, row_number() OVER () AS r, {words} AS w FROM documents),
    b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {words} AS w FROM benchmark),
    k AS (
      SELECT DISTINCT item, least(len(w), {window}) AS k,
             array_to_string(w[i + 1 : i + least(len(w), {window})], ' ') AS s
      FROM b, unnest(range(greatest(len(w) - {window} + 1, 1))) AS t(i) WHERE len(w) > 0),
    l AS (SELECT DISTINCT k FROM k),
    g AS (
      SELECT r, k, i, array_to_string(w[i + 1 : i + k], ' ') AS s
      FROM d, l, unnest(range(greatest(len(w) - k + 1, 0))) AS t(i)),
    h AS (SELECT g.r, g.i, g.k, k.item FROM g JOIN k ON g.k = k.k AND g.s = k.s),
    p AS (SELECT r, count(DISTINCT i + j) AS n_hit FROM h, unnest(range(k)) AS t(j) GROUP BY r),
    m AS (SELECT r, list_sort(list_distinct(list(item))) AS items FROM h GROUP BY r)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(items), 0) AS n_items,
           sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM d LEFT JOIN p USING (r) LEFT JOIN m USING (r)"""


def mixed() -> str:
    """The rows of ``mixing.mix`` with the query's emphasis: targets by water filling, rates
    by level, Pareto ranks, the cut where the taken words are nearest to the target."""
    kinds = ", ".join(str(w) for w in mixing.WEIGHTS)
    cap, share = mixing.CAP, mixing.SHARE
    return f"""
    WITH z AS (
      SELECT doc_id, source, len(coalesce(regexp_extract_all(text, {_SPACED}), [])) AS size,
        (CAST(('0x' || substring(md5(concat_ws('|', '{mixing.SEED}', coalesce(CAST(doc_id AS VARCHAR), '?'),
          coalesce(source, '?'), md5(coalesce(text, '')))), 1, 13)) AS UBIGINT) + 0.5) / 4503599627370496.0 AS u
      FROM documents),
    y AS (SELECT *, CAST(round(log2(log2(size + 2)) * 8) AS INT) AS level FROM z),
    s AS (SELECT source, sum(size) AS source_size FROM y GROUP BY source),
    w AS (SELECT *, ([{kinds}])[(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1] AS w,
                 source_size * {cap} AS most FROM s),
    v AS (SELECT *, (sum(source_size) OVER () * {share} - coalesce(sum(most) OVER b, 0)) /
                    (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS lv FROM w
          WINDOW b AS (ORDER BY most / w, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    t AS (SELECT source, source_size,
                 CASE WHEN most <= w * lv OR max(lv) FILTER (most > w * lv) OVER () IS NULL THEN most
                      ELSE w * max(lv) FILTER (most > w * lv) OVER () END AS target FROM v),
    l AS (SELECT source, level, sum(size) AS words, power(2.0, level / 8.0) AS x FROM y GROUP BY source, level),
    c AS (SELECT l.source, x, (target - {cap} * coalesce(sum(words) OVER a, 0)) / nullif(sum(words * x) OVER b, 0) AS c
          FROM l JOIN t ON l.source IS NOT DISTINCT FROM t.source
          WINDOW a AS (PARTITION BY l.source ORDER BY level DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                 b AS (PARTITION BY l.source ORDER BY level DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
    r AS (SELECT source, greatest(0, coalesce(max(c) FILTER (c * x <= {cap} * (1 + 1e-12)), 0)) AS rate FROM c GROUP BY source),
    e AS (SELECT y.*, source_size, target, least({cap}, rate * power(2.0, level / 8.0)) AS e
          FROM y JOIN t ON y.source IS NOT DISTINCT FROM t.source JOIN r ON y.source IS NOT DISTINCT FROM r.source),
    f AS (SELECT *, floor(e) AS whole, CASE WHEN e > floor(e)
                 THEN ln(u / (1 - u)) - ln((e - floor(e)) / (1 - (e - floor(e)))) END AS q FROM e),
    g AS (SELECT source, q, sum(size) AS words FROM f WHERE q IS NOT NULL GROUP BY source, q),
    n AS (SELECT source, any_value(target) - sum(whole * size) AS wanted FROM f GROUP BY source),
    h AS (SELECT g.source, g.q, words, wanted, sum(words) OVER (PARTITION BY g.source ORDER BY g.q) AS upto
          FROM g JOIN n ON g.source IS NOT DISTINCT FROM n.source),
    k AS (SELECT source, max(q) AS last FROM h
          WHERE upto - words < wanted AND abs(upto - wanted) <= abs(upto - words - wanted) GROUP BY source)
    SELECT doc_id, size, source_size, target,
           CAST(size * (whole + CASE WHEN q <= last THEN 1 ELSE 0 END) AS BIGINT) AS taken
    FROM f LEFT JOIN k ON f.source IS NOT DISTINCT FROM k.source"""


def _covered(length: int) -> str:
    """c: words covered by windows that occur elsewhere; ``later``: by one that occurs earlier."""
    return f"""
    WITH d AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id NULLS FIRST) AS r,
                      coalesce(regexp_extract_all(text, {_SPACED}), []) AS w FROM documents),
    g AS (SELECT r, i, md5(array_to_string(w[i + 1 : i + {length}], ' ')) AS s
          FROM d, unnest(range(greatest(len(w) - {length} + 1, 0))) AS t(i)),
    h AS (SELECT r, i, count(*) OVER (PARTITION BY s) AS n, row_number() OVER (PARTITION BY s ORDER BY r, i) > 1 AS later FROM g),
    c AS (SELECT r, i + j AS p, max(later) AS later FROM h, unnest(range({length})) AS t(j) WHERE n > 1 GROUP BY r, i + j)"""


def removed_words(length: int) -> str:
    """All copies removed."""
    return _covered(length) + """,
    k AS (SELECT r, count(*) AS n_removed FROM c GROUP BY r),
    x AS (SELECT d.r, string_agg(w[p + 1], ' ' ORDER BY p) AS kept
          FROM d, unnest(range(len(w))) AS t(p) LEFT JOIN (SELECT r AS cr, p AS cp FROM c) ON cr = d.r AND cp = p
          WHERE cp IS NULL GROUP BY d.r)
    SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM d LEFT JOIN k USING (r) LEFT JOIN x USING (r)"""


def repeat_spans(length: int) -> str:
    """Maximal repeats of every copy, with the words that later copies lose."""
    return _covered(length) + """,
    s AS (SELECT r, p, later, p - row_number() OVER (PARTITION BY r ORDER BY p) AS island FROM c)
    SELECT any_value(doc_id) AS doc_id, any_value(len(w)) AS n_words, min(p) AS start, count(*) AS length,
           count(*) FILTER (later) AS n_removed
    FROM s JOIN d USING (r) GROUP BY r, island"""


def line_runs() -> str:
    """Lines with a word covered by two consecutive ones that occur earlier (min_lines = 2), or
    of ten words or more that occur earlier (min_words = 10)."""
    return r"""
    WITH d AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id NULLS FIRST) AS r, text, string_split(text, chr(10)) AS ls FROM documents),
    a AS (SELECT r, unnest(ls) AS l, generate_subscripts(ls, 1) AS i FROM d),
    b AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY i) AS p FROM a WHERE regexp_matches(l, '[^ 	-
]')),
    c AS (SELECT r, p, l, lead(l) OVER (PARTITION BY r ORDER BY p) AS m FROM b),
    e AS (SELECT r, p, row_number() OVER (PARTITION BY l, m ORDER BY r, p) > 1 AS later FROM c WHERE m IS NOT NULL),
    g AS (SELECT r, p, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) >= 10
                       AND row_number() OVER (PARTITION BY l ORDER BY r, p) > 1 AS later FROM b),
    f AS (SELECT r, p + j AS p FROM e, unnest([0, 1]) AS t(j) WHERE later UNION SELECT r, p FROM g WHERE later),
    k AS (SELECT a.r, count(b.p) AS n_lines, count(f.p) AS n_removed,
                 string_agg(a.l, chr(10) ORDER BY a.i) FILTER (f.p IS NULL) AS kept
          FROM a LEFT JOIN b ON a.r = b.r AND a.i = b.i LEFT JOIN f ON f.r = b.r AND f.p = b.p GROUP BY a.r)
    SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
           CASE WHEN text IS NOT NULL THEN sha256(coalesce(kept, '')) END AS kept_sha256
    FROM d LEFT JOIN k USING (r)"""


def repaired_conversations() -> str:
    """Damage by CRC-32, faults, and the edits by a shortest-path walk over (row, state) that
    keeps the cheapest, ASCII-least audit as a text."""
    flip = "CASE WHEN x < 0 THEN a ELSE xor(a, x) END"
    bits = "[ord(c), -1, -1, -1, -1, -1, -1, -1]"
    return rf"""
    WITH RECURSIVE src AS (
      SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
    crc AS (
      SELECT k, xor(4294967295, list_reduce(
               [CAST(4294967295 AS BIGINT)] || CAST(flatten(list_transform(string_split(k, ''), lambda c: {bits})) AS BIGINT[]),
               lambda a, x: xor(({flip}) >> 1, CAST(3988292384 AS BIGINT) * (({flip}) & 1)))) % 20 AS f
      FROM (SELECT DISTINCT k FROM src)),
    dm AS (
      SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
             CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
      FROM src JOIN crc USING (k), unnest(range(CASE WHEN f = 3 THEN 2 ELSE 1 END)) AS t(i) WHERE f <> 0),
    nm AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           sha256(length(role) || ':' || role || ':' || text)) AS p FROM dm),
    fl AS (
      SELECT *, NOT regexp_matches(text, '[^ 	-
]') AS blank,
             row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 AS seen, left(role, 1) AS c,
             lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY p) || left(role, 1) AS pair,
             regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) NOT IN ('.', '!', '?') AS cut FROM nm),
    kd AS (SELECT *, CASE WHEN blank OR seen THEN 2 WHEN cut THEN 1 ELSE 0 END AS kind FROM fl),
    ins(s, w, said, m) AS (VALUES (0, '', '', 0), (1, '', '', 1), (2, '', '', 2), (3, '', '', 3),
      (0, 'I', 'user:' || chr(10), 2), (1, 'I', 'user:' || chr(10), 2),
      (2, 'I', 'assistant:' || chr(10), 3), (3, 'I', 'user:' || chr(10), 2)),
    way(m, letter, c, t) AS (VALUES (0, 'D', '', 0), (1, 'D', '', 1), (2, 'D', '', 2), (3, 'D', '', 3),
      (0, 'K', 's', 1), (0, 'K', 'u', 2), (1, 'K', 'u', 2), (3, 'K', 'u', 2), (2, 'K', 'a', 3),
      (0, 'R', '', 2), (1, 'R', '', 2), (3, 'R', '', 2), (2, 'R', '', 3)),
    st AS (
      SELECT conv_id, CAST(0 AS BIGINT) AS p, 0 AS s, CAST(0 AS BIGINT) AS cost, '' AS audit, '' AS fixed
      FROM (SELECT DISTINCT conv_id FROM dm)
      UNION ALL
      SELECT conv_id, p, t, cost, audit, fixed FROM (
        SELECT st.conv_id, kd.p, way.t, st.audit || ins.w || way.letter AS audit,
               st.cost + 3 * length(ins.w) + CASE letter WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END
                 + CASE WHEN letter <> 'D' AND kind = 1 THEN 3 ELSE 0 END AS cost,
               st.fixed || ins.said || CASE letter WHEN 'D' THEN '' ELSE
                 CASE WHEN letter = 'K' THEN role WHEN way.t = 2 THEN 'user' ELSE 'assistant' END || ':' || text || chr(10) END AS fixed
        FROM st JOIN kd ON kd.conv_id IS NOT DISTINCT FROM st.conv_id AND kd.p = st.p + 1
        JOIN ins ON ins.s = st.s JOIN way ON way.m = ins.m
        WHERE letter = 'D' OR (kind < 2 AND (letter = 'R' OR way.c = kd.c)))
      QUALIFY row_number() OVER (PARTITION BY conv_id, t ORDER BY cost, audit) = 1),
    cnt AS (
      SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, max(p) AS n,
             count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND seen) AS duplicate,
             count(*) FILTER (kind = 1) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
      FROM kd GROUP BY conv_id),
    fin(s, w, said) AS (VALUES (0, '', ''), (3, '', ''), (2, 'I', 'assistant:' || chr(10)),
      (1, 'II', 'user:' || chr(10) || 'assistant:' || chr(10))),
    best AS (
      SELECT st.conv_id, cost + 3 * length(w) AS cost, audit || w AS audit, fixed || said AS fixed
      FROM st JOIN cnt ON cnt.conv_id IS NOT DISTINCT FROM st.conv_id AND st.p = cnt.n JOIN fin ON fin.s = st.s
      QUALIFY row_number() OVER (PARTITION BY st.conv_id ORDER BY cost + 3 * length(w), audit || w) = 1),
    ids AS (SELECT DISTINCT conv_id FROM conversations)
    SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
           coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
           coalesce(audit, '') AS audit, sha256(coalesce(left(fixed, greatest(length(fixed) - 1, 0)), '')) AS repaired_sha256
    FROM ids LEFT JOIN cnt ON cnt.conv_id IS NOT DISTINCT FROM ids.conv_id
    LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM ids.conv_id"""


ORACLES: dict[str, str] = {
    "op1_decontamination": decontamination(),
    "op4_mixing": mixed(),
    "op5_suffix_dedup": repeat_spans(50),
    "op6_substring_dedup": removed_words(35),
    "op8_line_dedup": line_runs(),
    "op11_conversation_repair": repaired_conversations(),
}
