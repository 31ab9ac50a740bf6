"""DuckDB SQL for the queries that SQL can express."""

OP7 = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT DISTINCT doc_id, unnest(
        CASE WHEN len(w) >= 2
             THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])
             WHEN len(w) = 1 THEN w ELSE [] END) AS s
    FROM words
), sizes AS (
    SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), links AS (
    SELECT x.doc_id AS a, y.doc_id AS b
    FROM sets x
    JOIN sets y ON x.s = y.s AND x.doc_id < y.doc_id
    JOIN sizes p ON p.doc_id = x.doc_id
    JOIN sizes q ON q.doc_id = y.doc_id
    WHERE 100 * least(p.n, q.n) >= 80 * greatest(p.n, q.n)
    GROUP BY x.doc_id, y.doc_id, p.n, q.n
    HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))
), edges AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
    SELECT doc_id, doc_id AS r FROM documents
    UNION
    SELECT edges.b, reach.r FROM reach JOIN edges ON edges.a = reach.doc_id
), found AS (
    SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id,
       d.doc_id = component_id AS kept
FROM documents d JOIN found USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""

OP2 = """
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n
    FROM pages
), records AS (
    SELECT page_id, n, sha256(html) AS payload_digest,
           CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY html) ELSE page_id END AS first
    FROM payloads
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM records
"""

OP4 = """
WITH hashed AS (
    SELECT doc_id, CAST('0x' || md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, ''))[1:15]
                        AS BIGINT) AS h,
           CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS bytes
    FROM documents
), nodes AS (
    SELECT depth, h >> (60 - depth) AS prefix, sum(bytes) AS total
    FROM hashed, (SELECT unnest(range(0, 61)) AS depth)
    GROUP BY ALL
), firsts AS (
    SELECT doc_id, h, bytes, min(depth) AS depth, max_by(total, -depth) AS total
    FROM hashed, nodes
    WHERE prefix = h >> (60 - depth) AND total <= 1048576
    GROUP BY doc_id, h, bytes
)
SELECT doc_id, right('0' || h::BIT::VARCHAR, 60)[1:depth] AS shard, CAST(depth AS INTEGER) AS depth,
       bytes, CAST(total AS BIGINT) AS shard_bytes
FROM firsts
"""

OP13 = """
WITH split AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
    FROM documents
), keyed AS (
    SELECT doc_id, line, place, translate(
        trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM split
), frequent AS (
    SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (f.key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN frequent f ON k.key = f.key
GROUP BY doc_id
"""


def _add(candidate: str, cost: str, edit: str) -> str:
    """A candidate is its cost in eight digits and then its edits, so the least string is the best."""
    return (
        f"(lpad(CAST(CAST({candidate}[1:8] AS BIGINT) + {cost} AS VARCHAR), 8, '0')"
        f" || {candidate}[9:] || {edit})"
    )


def _inserted(names: tuple[str, str, str, str]) -> str:
    """States after the insertions that may come next: none, system, user, assistant."""
    none, system, user, assistant = names
    waiting = f"least({user}, {_add(f'least({none}, {system}, {assistant})', '2', chr(39) + 'I' + chr(39))})"
    done = f"least({assistant}, {_add(waiting, '2', chr(39) + 'I' + chr(39))})"
    return f"{none} AS n, {system} AS s, {waiting} AS u, {done} AS a"


_DROP = {state: _add(f"c.{state}", "3", "'D'") for state in "nsua"}
_KEEP = {
    symbol: f"CASE WHEN NOT r.must_go THEN {_add(source, cost, edit)} END"
    for symbol, source, cost, edit in (
        ("u", "least(c.n, c.s, c.a)", "r.cut + CASE WHEN r.initial = 'u' THEN 0 ELSE 2 END",
         "CASE WHEN r.initial = 'u' THEN 'K' ELSE 'R' END"),
        ("a", "c.u", "r.cut + CASE WHEN r.initial = 'a' THEN 0 ELSE 2 END",
         "CASE WHEN r.initial = 'a' THEN 'K' ELSE 'R' END"),
    )
}
_SYSTEM = f"CASE WHEN r.initial = 's' AND NOT r.must_go THEN {_add('c.n', 'r.cut', chr(39) + 'K' + chr(39))} END"

OP12 = rf"""
WITH RECURSIVE crc_table AS MATERIALIZED (
    SELECT list_transform(range(256), lambda x: list_reduce(
        [x, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: xor(a >> 1, 3988292384 * (a & 1)))) AS t
), kinds AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           xor(4294967295, list_reduce(
               list_prepend(4294967295::BIGINT, list_transform(string_split(
                   coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
                   lambda c: CAST(ord(c) AS BIGINT))),
               lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8))) % 20 AS kind
    FROM conversations, crc_table
), damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
           unnest(CASE kind WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM kinds WHERE kind <> 0
), placed AS (
    SELECT conv_id, turn, role, text, left(role, 1) AS initial, row_number() OVER (
        PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS place
    FROM damaged
), faults AS (
    SELECT *, CASE
        WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank'
        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'duplicate'
        WHEN NOT regexp_matches(text, '[.!?][ 	-
]*\z') THEN 'truncated'
        ELSE '' END AS fault,
        lag(initial) OVER (PARTITION BY conv_id ORDER BY place) || initial AS pair
    FROM placed
), marked AS (
    SELECT *, fault IN ('blank', 'duplicate') AS must_go, CAST(fault = 'truncated' AS BIGINT) AS cut FROM faults
), counts AS (
    SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM marked GROUP BY conv_id
), states AS (
    SELECT conv_id, CAST(0 AS BIGINT) AS place, {_inserted(("n", "s", "u", "a"))}
    FROM (SELECT conv_id, '00000000' AS n, CAST(NULL AS VARCHAR) AS s, CAST(NULL AS VARCHAR) AS u,
                 CAST(NULL AS VARCHAR) AS a FROM counts)
    UNION ALL
    SELECT conv_id, place, {_inserted(("n", "s", "u", "a"))}
    FROM (
        SELECT r.conv_id, r.place, {_DROP["n"]} AS n, least({_DROP["s"]}, {_SYSTEM}) AS s,
               least({_DROP["u"]}, {_KEEP["u"]}) AS u, least({_DROP["a"]}, {_KEEP["a"]}) AS a
        FROM states c JOIN marked r ON r.conv_id = c.conv_id AND r.place = c.place + 1
    )
), best AS (
    SELECT s.conv_id, CAST(least(s.n, s.a)[1:8] AS BIGINT) AS cost, least(s.n, s.a)[9:] AS audit
    FROM states s JOIN counts c ON c.conv_id = s.conv_id AND c.n = s.place
), edits AS (
    SELECT conv_id, unnest(string_split(audit, '')) AS edit,
           generate_subscripts(string_split(audit, ''), 1) AS step
    FROM best WHERE audit <> ''
), numbered AS (
    SELECT *, count(*) FILTER (edit <> 'I') OVER w AS place, count(*) FILTER (edit <> 'D') OVER w AS symbol
    FROM edits WINDOW w AS (PARTITION BY conv_id ORDER BY step)
), turns AS (
    SELECT e.conv_id, e.step, e.edit, e.symbol, r.role, r.text,
           max(CAST(e.symbol = 1 AND e.edit = 'K' AND r.initial = 's' AS BIGINT))
               OVER (PARTITION BY e.conv_id) AS shift
    FROM numbered e LEFT JOIN marked r ON r.conv_id = e.conv_id AND r.place = e.place AND e.edit <> 'I'
    WHERE e.edit <> 'D'
), repaired AS (
    SELECT conv_id, string_agg(
        CASE WHEN edit = 'K' THEN role WHEN (symbol - shift) % 2 = 1 THEN 'user' ELSE 'assistant' END
            || ':' || coalesce(text, ''), chr(10) ORDER BY step) AS text
    FROM turns GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(r.text, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts USING (conv_id) LEFT JOIN best USING (conv_id) LEFT JOIN repaired r USING (conv_id)
"""

OP5 = """
WITH docs AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h,
           CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n
    FROM documents
), strings AS (
    SELECT doc_id, unnest(range(n - 99)) AS i, h FROM docs WHERE n >= 100
), hashed AS (
    SELECT doc_id, i, md5_number(substr(h, 2 * i + 1, 200)) AS g FROM strings
), repeated AS (
    SELECT doc_id, i FROM hashed QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1
), steps AS (
    SELECT doc_id, i, CAST(i > 100 + lag(i, 1, -101) OVER (PARTITION BY doc_id ORDER BY i) AS INTEGER) AS opens
    FROM repeated
), islands AS (
    SELECT doc_id, i, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS island FROM steps
), removed AS (
    SELECT doc_id, min(i) AS low, max(i) + 100 AS high FROM islands GROUP BY doc_id, island
), gaps AS (
    SELECT doc_id, lag(high, 1, 0) OVER (PARTITION BY doc_id ORDER BY low) AS from_byte, low AS to_byte FROM removed
    UNION ALL SELECT doc_id, max(high), NULL FROM removed GROUP BY doc_id
), kept AS (
    SELECT doc_id, string_agg(substr(h, 2 * from_byte + 1, 2 * (coalesce(to_byte, n) - from_byte)), ''
                              ORDER BY from_byte) AS h
    FROM gaps JOIN docs USING (doc_id) GROUP BY doc_id
), counted AS (
    SELECT doc_id, sum(high - low) AS n_removed, count(*) AS n_spans FROM removed GROUP BY doc_id
)
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(k.h, d.h))) AS kept_sha256
FROM docs d LEFT JOIN counted USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""

OP8 = r"""
WITH RECURSIVE placed AS MATERIALIZED (
    SELECT doc_id, coalesce('=' || source, 'null') AS key,
           CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS tokens,
           md5(concat_ws(':', coalesce(CAST(doc_id AS VARCHAR), ''), coalesce(text, ''))) AS place
    FROM documents
), sources AS MATERIALIZED (
    SELECT key, CAST(sum(tokens) AS BIGINT) AS tokens FROM placed GROUP BY key
), shares AS MATERIALIZED (
    SELECT tokens / (SELECT sum(tokens) FROM sources) AS share FROM sources WHERE tokens > 0
), halved AS (
    SELECT CAST(0 AS DOUBLE) AS low, CAST(1 AS DOUBLE) AS high, 0 AS n
    UNION ALL
    SELECT CASE WHEN most <= 2 * (1 + 1e-12) THEN low ELSE (low + high) / 2 END,
           CASE WHEN most <= 2 * (1 + 1e-12) THEN (low + high) / 2 ELSE high END, n + 1
    FROM (
        SELECT low, high, n, max(pow(share, (low + high) / 2) / share) / sum(pow(share, (low + high) / 2)) AS most
        FROM halved, shares WHERE n < 32 GROUP BY low, high, n
    )
), chosen AS (
    SELECT CASE WHEN (SELECT max(1 / share) / count(*) FROM shares) <= 2 * (1 + 1e-12) THEN 0 ELSE high END AS alpha
    FROM halved WHERE n = 32
), powers AS (
    SELECT key, tokens, CASE WHEN tokens > 0
        THEN pow(tokens / (SELECT sum(tokens) FROM sources), (SELECT alpha FROM chosen)) ELSE 0 END AS w
    FROM sources
), planned AS (
    SELECT key, tokens AS all_tokens, CAST(least(
        floor((SELECT sum(tokens) FROM sources) * w / (SELECT sum(w) FROM powers) * (1 + 1e-12) + 1e-6),
        floor(tokens * 2.0)) AS BIGINT) AS budget,
        greatest(1, CAST(ceil(tokens / 1048576) AS BIGINT)) AS blocks
    FROM powers
), plan AS (
    SELECT *, CASE WHEN all_tokens > 0 THEN budget // all_tokens ELSE 0 END AS whole FROM planned
), bucketed AS MATERIALIZED (
    SELECT p.*, CAST('0x' || place[1:8] AS BIGINT) % blocks AS bucket FROM placed p JOIN plan USING (key)
), totals AS (
    SELECT key, bucket, CAST(sum(tokens) AS BIGINT) AS size FROM bucketed GROUP BY key, bucket
), passes AS (
    SELECT *, unnest(range(0, whole + 1)) AS pass FROM totals JOIN plan USING (key)
), ordered AS (
    SELECT *, CAST(row_number() OVER w - 1 AS INTEGER) AS block, CAST(sum(size) OVER w - size AS BIGINT) AS ahead
    FROM passes
    WINDOW w AS (PARTITION BY key, pass ORDER BY md5(concat_ws(':', pass, bucket)), bucket)
), roomed AS (
    SELECT key, bucket, pass, block, pass * all_tokens + ahead AS before,
           CASE WHEN pass = whole AND budget - whole * all_tokens - ahead < size
                THEN greatest(budget - whole * all_tokens - ahead, 0) END AS room
    FROM ordered
), sums AS (
    SELECT key, bucket, pass, room, md5(concat_ws(':', pass, place)) AS turn,
           sum(tokens) OVER (PARTITION BY key, bucket, pass ORDER BY md5(concat_ws(':', pass, place))) AS used
    FROM bucketed JOIN roomed USING (key, bucket) WHERE tokens > 0 AND room > 0
), cuts AS (
    SELECT key, bucket, pass, max(turn) AS cut FROM sums WHERE used <= room GROUP BY key, bucket, pass
)
SELECT doc_id, key AS source, tokens, CAST(pass AS INTEGER) AS pass, block, CAST(before AS BIGINT) AS before
FROM bucketed JOIN roomed USING (key, bucket) LEFT JOIN cuts USING (key, bucket, pass)
WHERE CASE WHEN tokens = 0 THEN pass = 0
           ELSE room IS NULL OR coalesce(md5(concat_ws(':', pass, place)) <= cut, false) END
"""

ORACLES = {
    "op2_warc_members": OP2,
    "op8_source_mixing": OP8,
    "op4_hash_shards": OP4,
    "op5_repeated_substrings": OP5,
    "op7_near_duplicates": OP7,
    "op12_conversation_repair": OP12,
    "op13_line_dedup": OP13,
}
