"""DuckDB SQL of the operators' queries that SQL can express."""

from __future__ import annotations

from obslake.llm import conversations as conv
from obslake.llm import sharding, spelling
from obslake.llm.urls import RULES

_RULES = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in RULES)

# DuckDB has no CRC-32: a table of 256 steps by its rule, then one step a byte.
_CRC_TABLE = """crc(t) AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(9), lambda c, k:
    CASE WHEN k = 0 THEN i WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i))
)"""


def _crc32(text: str) -> str:
    """CRC-32 of the UTF-8 bytes of a SQL string; ``crc`` must be in FROM."""
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT)"
    return (f"xor(list_reduce({octets}, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), "
            "4294967295::BIGINT)")


def _network(source: str) -> str:
    """``source`` (x, v, a, b) with ``v`` sent through the Feistel network once."""
    sql = f"SELECT x, a, b, n, v % a AS l, v // a AS r FROM ({source})"
    for k in range(1, sharding.ROUNDS + 1):
        own, other, size = ("l", "r", "a") if k % 2 else ("r", "l", "b")
        mixed = f"('0x' || substr(md5('0:{k}:' || {other}), 1, 15))::BIGINT"
        changed = f"({own} + {mixed} % {size}) % {size} AS {own}"
        sql = f"SELECT x, a, b, n, {changed}, {other} FROM ({sql})"
    return f"SELECT x, l + r * a AS v, a, b, n FROM ({sql})"


_SHARDS = 40
_LOWER = f"translate(coalesce(text, ''), '{spelling.UPPER}', '{spelling.LOWER}')"


def _viterbi() -> str:
    """One step of the search: the best (cost, edits, lines) of each state after row ``k``."""
    names = {conv.START: "st", conv.SYSTEM: "sy", conv.USER: "us", conv.ASSISTANT: "an"}

    def then(state: int, cost: str, edit: str, line: str | None) -> str:
        v = names[state]
        lines = f"v.{v}.o" if line is None else f"list_append(v.{v}.o, {line})"
        return f"{{'c': v.{v}.c + {cost}, 'e': v.{v}.e || '{edit}', 'o': {lines}}}"

    never = "{'c': 1000000000::BIGINT, 'e': '', 'o': []::VARCHAR[]}"
    columns = []
    for state, name in names.items():
        offers = [then(state, str(conv.DELETE), "D", None)]
        for initial, moves in conv.KEPT.items():
            for before, after in moves:
                if after == state:
                    kept = then(before, f"{conv.TRUNCATED} * tr", "K", "role || ':' || text")
                    offers.append(f"CASE WHEN NOT go AND left(role, 1) = '{initial}' THEN {kept} ELSE {never} END")
        for before, after in conv.INSERTED:
            if after == state:
                moved = then(before, f"{conv.REROLE} + {conv.TRUNCATED} * tr", "R", f"'{conv.ROLE_OF[after]}:' || text")
                offers.append(f"CASE WHEN NOT go THEN {moved} ELSE {never} END")
        columns.append(f"list_min([{', '.join(offers)}]) AS {name}")
    step = f"SELECT v.conv, v.k + 1 AS k, {', '.join(columns)} FROM search v JOIN numbered r ON r.conv = v.conv AND r.k = v.k + 1"
    return _inserted(step)


def _inserted(source: str) -> str:
    def insert(state: str, role: str) -> str:
        return f"{{'c': {state}.c + {conv.INSERT}, 'e': {state}.e || 'I', 'o': list_append({state}.o, '{role}:')}}"

    users = ", ".join(insert(s, "user") for s in ("st", "sy", "an"))
    return (f"SELECT conv, k, st, sy, us, list_min([an, {insert('us', 'assistant')}]) AS an FROM ("
            f"SELECT conv, k, st, sy, list_min([us, {users}]) AS us, an FROM ({source}))")


_NONE = "{'c': 1000000::BIGINT, 'e': '', 'o': []::VARCHAR[]}"
_REPAIR = f"""
WITH RECURSIVE {_CRC_TABLE},
marked AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind
  FROM conversations, crc
),
hurt AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM marked WHERE kind <> 0
),
convs AS (SELECT conv_id, row_number() OVER () AS conv FROM (SELECT DISTINCT conv_id FROM conversations)),
placed AS (
  SELECT conv, turn, role, text, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text) AS k
  FROM hurt JOIN convs ON hurt.conv_id IS NOT DISTINCT FROM convs.conv_id
),
faults AS (
  SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
         row_number() OVER (PARTITION BY conv, role, text ORDER BY k) > 1 AS seen,
         NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\\z') AS open,
         lag(left(role, 1)) OVER (PARTITION BY conv ORDER BY k) || left(role, 1) AS step
  FROM placed
),
numbered AS (SELECT *, blank OR seen AS go, (open AND NOT blank AND NOT seen)::INT AS tr FROM faults),
search AS (
  {_inserted(f"SELECT conv, 0::BIGINT AS k, {{'c': 0::BIGINT, 'e': '', 'o': []::VARCHAR[]}} AS st, {_NONE} AS sy, {_NONE} AS us, {_NONE} AS an FROM convs")}
  UNION ALL
  {_viterbi()}
),
ends AS (
  SELECT conv, list_min([st, an]) AS won FROM search
  WHERE (conv, k) IN (SELECT conv, max(k) FROM search GROUP BY conv)
),
counts AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, sum(blank::INT) AS blank,
         sum((seen AND NOT blank)::INT) AS duplicate, sum(tr) AS truncated,
         sum((step IS NOT NULL AND step NOT IN ('su', 'ua', 'au'))::INT) AS illegal
  FROM numbered GROUP BY conv
)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, won.c AS cost, won.e AS audit,
       sha256(array_to_string(won.o, chr(10))) AS repaired_sha256
FROM convs JOIN ends USING (conv) LEFT JOIN counts USING (conv)
"""

_SHARDING = f"""
WITH RECURSIVE {_CRC_TABLE},
sized AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + {sharding.ROW_BYTES} AS size,
         {_crc32("coalesce(text, '')")} AS text_crc32
  FROM documents, crc
),
numbered AS (
  SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS row_number,
         count(*) OVER () AS n
  FROM sized
),
domain AS (SELECT n, a, greatest(1, (n + a - 1) // a) AS b
           FROM (SELECT n, ceil(sqrt(n))::BIGINT AS a FROM (SELECT count(*) AS n FROM documents))),
walk AS (
  {_network("SELECT row_number AS x, row_number AS v, a, b, domain.n FROM numbered, domain")}
  UNION ALL
  {_network("SELECT x, v, a, b, n FROM walk WHERE v >= n")}
)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'rows' AS law, (v % {_SHARDS})::INT AS shard,
       (v // {_SHARDS})::BIGINT AS slot, NULL::INT AS grown_shard, row_number::BIGINT AS row_number
FROM numbered JOIN walk ON x = row_number AND v < walk.n
"""

_SPELLING = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT coalesce(doc_id::VARCHAR, 'null') AS id,
         unnest(regexp_extract_all({_LOWER}, '{spelling.LETTERS}{{{spelling.LEAST_LETTERS},}}')) AS run
  FROM documents
),
hashed AS (SELECT run, count, {_crc32("id || ':' || run")} AS h
           FROM (SELECT id, run, count(*) AS count FROM runs GROUP BY id, run), crc),
words AS (
  SELECT word, sum(count)::BIGINT AS n FROM (
    SELECT count, CASE WHEN h % {spelling.DAMAGE_MOD} = 0
      THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= {spelling.LEAST_LETTERS} GROUP BY word HAVING sum(count) >= {spelling.LEAST_COUNT}
),
cuts AS (SELECT DISTINCT word, n, i, left(word, i) || substr(word, i + 2) AS cut
         FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT DISTINCT x.word AS word, y.word AS other, y.n AS other_n
  FROM cuts x JOIN cuts y ON x.i = y.i AND x.cut = y.cut AND x.word <> y.word
  UNION SELECT x.word, y.word, y.n FROM cuts x JOIN words y ON x.cut = y.word
  UNION SELECT y.word, x.word, x.n FROM cuts x JOIN words y ON x.cut = y.word
),
best AS (
  SELECT word, count(*) AS n_near, min({{'m': -other_n, 'w': other}}) AS b FROM near GROUP BY word
),
found AS (
  SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.m >= {spelling.RATIO} * n THEN b.w END AS form,
         CASE WHEN -b.m >= {spelling.RATIO} * n THEN -b.m END AS form_n
  FROM words LEFT JOIN best ON best.word = words.word
),
chase AS (
  SELECT word, word AS root, form AS next FROM found
  UNION ALL
  SELECT c.word, f.word, f.form FROM chase c JOIN found f ON f.word = c.next
)
SELECT found.word, form, root, n, n_near::BIGINT AS n_near, form_n::BIGINT AS form_n
FROM found JOIN chase ON chase.word = found.word AND chase.next IS NULL
"""

# Base32 of a SHA-1: 20 bits (five hex digits) are four characters.
_WARC = """
WITH sized AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(encode(coalesce(html, ''))) AS hex FROM pages
),
digests AS (
  SELECT page_id, octet_length(encode(html)) AS payload_bytes, array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((('0x' || substr(hex, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1, 1)), '') AS payload_digest
  FROM sized
),
led AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS leader FROM digests)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN page_id = leader THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> leader THEN leader END AS refers_to, TRUE AS intact
FROM led
"""

ORACLE_SQL: dict[str, str] = {
    "op2_warc": _WARC,
    "op11_conversation_repair": _REPAIR,
    "op12_sharding": _SHARDING,
    "op13_spelling_variants": _SPELLING,
    "op8_url_filters": f"""
WITH rules(rh, rp, verdict) AS (VALUES {_RULES}),
rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r
  FROM pages
),
parts AS (
  SELECT page_id,
         translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
),
fits AS (
  SELECT host, path, rh || rp AS rule, verdict,
         row_number() OVER (PARTITION BY host, path
                            ORDER BY length(rh) + length(rp) DESC, length(rh) DESC, verdict = 'block' DESC) AS k
  FROM (SELECT DISTINCT host, path FROM parts)
  JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f ON f.host = p.host AND f.path = p.path AND f.k = 1
""",
}
