"""DuckDB SQL of the queries that SQL can express (small tables only: it compares
all pairs and closes links recursively)."""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"


def _reach(ids: str, links: str) -> str:
    """(id, component) over the links (a, b) of all ``ids``."""
    return f"""both_ways AS (SELECT a, b FROM {links} UNION SELECT b, a FROM {links}),
        reach AS (
            SELECT id, id AS spot FROM {ids}
            UNION SELECT reach.id, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.spot),
        component AS (SELECT id, min(spot) AS component_id FROM reach GROUP BY id)"""


ORACLE_SQL: dict[str, str] = {
    "op4_embedding_lsh": f"""
        WITH RECURSIVE vector AS (
            SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
        usable AS (
            SELECT id, v FROM vector
            WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(v, lambda x: x <> 0)) > 0),
        link AS (
            SELECT p.id AS a, q.id AS b FROM usable p JOIN usable q ON p.id < q.id AND len(p.v) = len(q.v)
            WHERE list_dot_product(p.v, q.v) >= 0.9 * sqrt(list_dot_product(p.v, p.v) * list_dot_product(q.v, q.v))),
        {_reach('vector', 'link')}
        SELECT c.id AS vec_id, (SELECT count(*) FROM both_ways WHERE a = c.id) AS n_links, component_id,
               c.id = component_id AS kept
        FROM component c""",
    "op5_warc": """
        WITH facts AS (
            SELECT page_id, sha1(encode(coalesce(html, ''))) AS digest,
                   octet_length(encode(coalesce(html, ''))) AS size
            FROM pages),
        many AS (
            SELECT digest, size, max(page_id) AS response FROM facts
            WHERE size >= 1000 GROUP BY digest, size HAVING count(*) > 1)
        SELECT f.page_id, CAST(f.size AS BIGINT) AS payload_bytes, f.digest AS payload_digest,
               CASE WHEN m.response IS NULL OR m.response = f.page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN m.response <> f.page_id THEN m.response END AS refers_to
        FROM facts f LEFT JOIN many m ON f.digest = m.digest AND f.size = m.size""",
    "op7_minhash_forest": f"""
        WITH RECURSIVE worded AS (
            SELECT doc_id AS id,
                   {_WORDS.format(text=f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')")} AS w
            FROM documents),
        shingled AS (
            SELECT id, list_distinct(CASE WHEN len(w) BETWEEN 1 AND 3 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i : i + 3], ' ')) END) AS s
            FROM worded),
        single AS (SELECT id, len(s) AS n, unnest(s) AS g FROM shingled),
        link AS (
            SELECT p.id AS a, q.id AS b FROM single p JOIN single q ON p.g = q.g AND p.id < q.id
            GROUP BY p.id, q.id, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))),
        {_reach('worded', 'link')}
        SELECT c.id AS doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, c.id = component_id AS kept
        FROM component c JOIN shingled USING (id)""",
    "op8_doubling_repeats": f"""
        WITH worded AS (
            SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
        windows AS (
            SELECT doc_id, i, md5(array_to_string(w[i : i + 34], ' ')) AS h
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM worded)),
        gone AS (
            SELECT doc_id, list(DISTINCT p) AS places FROM (
                SELECT doc_id, unnest(range(i, i + 35)) AS p FROM windows
                WHERE h IN (SELECT h FROM windows GROUP BY h HAVING count(*) > 1))
            GROUP BY doc_id),
        kept AS (
            SELECT w.doc_id, w.w, coalesce(len(places), 0) AS n,
                   CASE WHEN places IS NULL THEN w.w
                        ELSE list_transform(list_filter(range(1, len(w.w) + 1), lambda i: NOT list_contains(places, i)), lambda i: w.w[i]) END AS k
            FROM worded w LEFT JOIN gone g ON w.doc_id = g.doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(n AS BIGINT) AS n_removed,
               sha256(array_to_string(k, ' ')) AS kept_sha256
        FROM kept""",
}


def _crc32(text: str) -> str:
    """crc32 of an ASCII text: a bit of each byte at a time."""
    bits = f"flatten(list_transform(string_split({text}, ''), lambda x: [CAST(ascii(x) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))"
    step = "xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {bits}), lambda c, b: {step}), 4294967295)"


_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_FAR = 1000000000  # the cost of a state that cannot be reached


def _best(*ways: str) -> str:
    return f"list_min([{', '.join(ways)}])"


def _edit(state: str, cost, letter: str, line: str | None = None) -> str:
    """``state`` (c cost, a audit, t text) after an edit that leaves ``line``."""
    text = f"{state}.t" if line is None else f"{state}.t || chr(10) || {line}"
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {text}}}"


def _only(condition: str, edit: str) -> str:
    """The edit where ``condition`` holds, else a state out of reach."""
    return f"CASE WHEN {condition} THEN {edit} ELSE {{'c': {_FAR}, 'a': '', 't': ''}} END"


# states of s?(ua)+: z nothing, s after a system turn, u after a user turn, p after a pair
_PAIR = {"u": "p", "p": "u"}
_NEW = {"u": "'user:'", "p": "'assistant:'"}
_INSERTED = f"""z, s,
    {_best('u', *(_edit(x, 5, 'I', _NEW['u']) for x in ('z', 's', 'p')))} AS u,
    {_best('p', _edit('u', 5, 'I', _NEW['p']),
           *(f"{{'c': {x}.c + 10, 'a': {x}.a || 'II', 't': {x}.t || chr(10) || 'user:' || chr(10) || 'assistant:'}}" for x in ('z', 's')))} AS p"""


def _moved(into: str) -> str:
    """Into state u or p on a row: by its own role or by a new one, or the row goes."""
    initial, role = {"u": ("u", "user"), "p": ("a", "assistant")}[into]
    ways = [_edit(into, 2, "D")]
    for x in ("z", "s", "p") if into == "u" else ("u",):
        ways.append(_only(f"stays AND initial = '{initial}'", _edit(x, "extra", "K", "role || ':' || text")))
        ways.append(_only("stays", _edit(x, "1 + extra", "R", f"'{role}:' || text")))
    return _best(*ways)


ORACLE_SQL["op12_role_repair"] = f"""
    WITH RECURSIVE given AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind
        FROM conversations),
    damaged AS (
        SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
               CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
        FROM (SELECT *, unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) FROM given) WHERE kind <> 0),
    numbered AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, nth) AS i,
               rtrim(text, {_WHITE}) AS body, left(role, 1) AS initial
        FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS nth FROM damaged)),
    ordered AS (
        SELECT *, fault NOT IN ('blank', 'duplicate') AS stays, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS extra,
               lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS earlier
        FROM (SELECT *, CASE WHEN body = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                             WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM numbered)),
    parse AS (
        SELECT conv_id, 0 AS pos, {{'c': 0, 'a': '', 't': ''}} AS z, {{'c': {_FAR}, 'a': '', 't': ''}} AS s,
               {{'c': {_FAR}, 'a': '', 't': ''}} AS u, {{'c': {_FAR}, 'a': '', 't': ''}} AS p
        FROM (SELECT DISTINCT conv_id FROM conversations)
        UNION ALL
        SELECT q.conv_id, pos + 1, {_edit('z', 2, 'D')},
               {_best(_edit('s', 2, 'D'), _only("stays AND initial = 's'", _edit('z', 'extra', 'K', "role || ':' || text")))},
               {_moved('u')}, {_moved('p')}
        FROM (SELECT conv_id, pos, {_INSERTED} FROM parse) q JOIN ordered r ON r.conv_id IS NOT DISTINCT FROM q.conv_id AND r.i = pos + 1),
    last_state AS (
        SELECT conv_id, {_best('z', 'p')} AS e
        FROM (SELECT conv_id, {_INSERTED} FROM
              (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY pos DESC) AS back FROM parse) WHERE back = 1)),
    counted AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
               count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
               count(*) FILTER (fault = 'truncated') AS truncated,
               count(*) FILTER (earlier IS NOT NULL AND earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal
        FROM ordered GROUP BY conv_id)
    SELECT l.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
           coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(e.c AS BIGINT) AS cost, e.a AS audit,
           sha256(substr(e.t, 2)) AS repaired_sha256
    FROM last_state l LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM l.conv_id"""

ORACLE_SQL["op13_prefix_trie"] = f"""
    WITH clean AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k
        FROM conversations WHERE conv_id IS NOT NULL),
    ids AS (
        SELECT conv_id, conv_id - conv_id % 5 AS base, {_crc32("CAST(conv_id AS VARCHAR)")} % 9 AS h
        FROM (SELECT DISTINCT conv_id FROM clean)),
    whole AS (
        SELECT i.conv_id, 0 AS part, k, role, text FROM ids i JOIN clean c ON c.conv_id = base AND k <= h
        UNION ALL SELECT i.conv_id, 1, k, role, text FROM ids i JOIN clean c ON c.conv_id = i.conv_id AND k > h),
    placed AS (
        SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, k) AS d,
               octet_length(encode(text)) AS size, length(role) || ':' || role || text AS step
        FROM whole),
    paths AS (
        SELECT conv_id, 0 AS d, 0 AS size, 'root' AS path FROM ids
        UNION ALL
        SELECT conv_id, d, size, md5(string_agg(md5(step), '' ORDER BY d) OVER (PARTITION BY conv_id ORDER BY d)) FROM placed),
    joined AS (
        SELECT *, lag(path) OVER (PARTITION BY conv_id ORDER BY d) AS above, max(d) OVER (PARTITION BY conv_id) AS deepest FROM paths),
    node AS (
        SELECT path, d AS depth, min(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, max(size) AS size,
               sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (d = deepest), '')) AS ends_sha256
        FROM joined GROUP BY path, d),
    children AS (SELECT above AS path, count(*) AS n FROM node WHERE above IS NOT NULL GROUP BY above),
    leaf AS (SELECT n.path FROM node n ANTI JOIN children c ON c.path = n.path),
    below AS (
        SELECT a.path, count(l.path) AS n_leaves, sum((n.n_convs - 1) * n.size) AS saved
        FROM node n JOIN joined j ON j.conv_id = n.conv_id AND j.d <= n.depth JOIN node a ON a.path = j.path
             LEFT JOIN leaf l ON l.path = n.path
        GROUP BY a.path)
    SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children,
           b.n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, n.ends_sha256
    FROM node n JOIN below b USING (path) LEFT JOIN children c USING (path) LEFT JOIN node p ON p.path = n.above"""
