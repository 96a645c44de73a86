"""SQL twins of the queries that SQL can express, run by DuckDB on the same tables."""

from __future__ import annotations

from cestero.llm import sharding, spelling


def _nibbles() -> list[int]:
    """CRC-32 of each half byte."""
    table = []
    for value in range(16):
        for _ in range(4):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    return table


def crc32(text: str) -> str:
    """CRC-32 of a text's bytes: a table step for each hexadecimal digit, the low one of a byte first."""
    hexadecimal = f"hex(encode({text}))"
    digits = f"string_split(regexp_replace({hexadecimal}, '(.)(.)', '\\2\\1', 'g'), '')"
    values = f"list_transform({digits}, lambda x: CAST(strpos('0123456789ABCDEF', x) - 1 AS BIGINT))"
    step = f"lambda c, b: xor(c >> 4, ({_nibbles()})[(xor(c, b) & 15) + 1])"
    return (
        f"CASE WHEN {hexadecimal} = '' THEN 0::BIGINT "
        f"ELSE xor(list_reduce({values}, {step}, 4294967295), 4294967295) END"
    )


_STATES = """
    closure(p, q, cost, audit) AS (VALUES
        (0, 0, 0, ''), (0, 2, 2, 'I'), (0, 3, 4, 'II'), (1, 1, 0, ''), (1, 2, 2, 'I'), (1, 3, 4, 'II'),
        (2, 2, 0, ''), (2, 3, 2, 'I'), (3, 3, 0, ''), (3, 2, 2, 'I')),
    said(initial, p, q) AS (VALUES ('s', 0, 1), ('u', 0, 2), ('u', 1, 2), ('u', 3, 2), ('a', 2, 3))
"""

OP11 = f"""
WITH RECURSIVE {_STATES},
source AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        {crc32("concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' '))")}
            % 20 AS fault
    FROM conversations),
hurt AS (
    SELECT conv_id, turn, CASE fault WHEN 4 THEN 'user' ELSE role END AS role,
        CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
        unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
    FROM source),
listed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i,
        regexp_replace(text, '[\\x20\\x09-\\x0D]+$', '') AS trimmed
    FROM hurt),
faults AS (
    SELECT conv_id, turn, i, role, text, left(role, 1) AS initial,
        lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
        CASE WHEN trimmed = '' THEN 'blank'
             WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
             WHEN right(trimmed, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
    FROM listed),
edits AS (
    SELECT conv_id, i, p, q, cost + CASE WHEN fault = 'truncated' AND op <> 'D' THEN 1 ELSE 0 END AS cost, op
    FROM faults, (
        SELECT initial AS kept, p, q, 0 AS cost, 'K' AS op FROM said
        UNION ALL SELECT DISTINCT NULL, p, q, 2, 'R' FROM said WHERE initial IN ('u', 'a')
        UNION ALL SELECT NULL, p, p, 3, 'D' FROM range(4) r(p)) options
    WHERE (op = 'D' OR fault NOT IN ('blank', 'duplicate')) AND (kept IS NULL OR kept = initial)),
steps AS (
    SELECT conv_id, i, e.p, c.q, min(struct_pack(cost := e.cost + c.cost, audit := e.op || c.audit)) AS best
    FROM edits e JOIN closure c ON e.q = c.p GROUP BY ALL),
paths AS (
    SELECT conv_id, 0::BIGINT AS i, q, struct_pack(cost := cost::INTEGER, audit := audit) AS best
    FROM (SELECT DISTINCT conv_id FROM conversations), closure WHERE p = 0
    UNION ALL
    SELECT s.conv_id, s.i, s.q, min(struct_pack(
        cost := (w.best.cost + s.best.cost)::INTEGER, audit := w.best.audit || s.best.audit)) AS best
    FROM paths w JOIN steps s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.i = w.i + 1 AND s.p = w.q
    GROUP BY s.conv_id, s.i, s.q),
sums AS (
    SELECT conv_id, count(*) AS rows,
        coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM faults GROUP BY conv_id),
repaired AS (
    SELECT c.conv_id, min(p.best) AS best, any_value(s) AS s
    FROM (SELECT DISTINCT conv_id FROM conversations) c
    LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM c.conv_id
    JOIN paths p ON p.conv_id IS NOT DISTINCT FROM c.conv_id AND p.i = coalesce(s.rows, 0) AND p.q IN (0, 3)
    GROUP BY c.conv_id),
letters AS (
    SELECT conv_id, unnest(string_split(best.audit, '')) AS op, generate_subscripts(string_split(best.audit, ''), 1) AS pos
    FROM repaired WHERE best.audit <> ''),
placed AS (
    SELECT *, count(*) FILTER (op <> 'I') OVER (PARTITION BY conv_id ORDER BY pos) AS i FROM letters),
kept AS (
    SELECT l.conv_id, l.op, l.pos, f.role, f.text, row_number() OVER (PARTITION BY l.conv_id ORDER BY l.pos) AS k,
        first_value(l.op = 'K' AND f.initial = 's') OVER (PARTITION BY l.conv_id ORDER BY l.pos) AS system
    FROM placed l LEFT JOIN faults f
        ON f.conv_id IS NOT DISTINCT FROM l.conv_id AND f.i = l.i AND l.op <> 'I'
    WHERE l.op <> 'D'),
lines AS (
    SELECT conv_id, string_agg(concat(
        CASE WHEN op = 'K' THEN role WHEN (k - system::INTEGER) % 2 = 1 THEN 'user' ELSE 'assistant' END,
        ':', CASE WHEN op = 'I' THEN '' ELSE text END), chr(10) ORDER BY pos) AS text
    FROM kept GROUP BY conv_id)
SELECT r.conv_id, coalesce(s.gaps, 0)::BIGINT AS gaps, coalesce(s.blank, 0)::BIGINT AS blank,
    coalesce(s.duplicate, 0)::BIGINT AS duplicate, coalesce(s.truncated, 0)::BIGINT AS truncated,
    coalesce(s.illegal, 0)::BIGINT AS illegal, best.cost::BIGINT AS cost, best.audit AS audit,
    sha256(coalesce(l.text, '')) AS repaired_sha256
FROM repaired r LEFT JOIN lines l ON l.conv_id IS NOT DISTINCT FROM r.conv_id
"""

OP12 = f"""
WITH RECURSIVE found AS (
    SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
lowered AS (
    SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
    FROM found WHERE length(run) >= {spelling.LENGTH} GROUP BY ALL),
hashed AS (
    SELECT run, n, {crc32("concat(coalesce(CAST(doc_id AS VARCHAR), ''), ':', run)")} AS h FROM lowered),
slipped AS (
    SELECT n, CASE WHEN h % {spelling.SLIP} = 0
        THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
    FROM hashed),
words AS (
    SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE length(word) >= {spelling.LENGTH}
    GROUP BY word HAVING sum(n) >= {spelling.OCCURRENCES}),
holes AS (
    SELECT DISTINCT word, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b, n, length(word) AS size, i
    FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
    SELECT x.word, y.word AS near, y.n FROM holes x JOIN holes y
        ON x.a = y.a AND x.b = y.b AND x.i = y.i AND x.size = y.size AND x.word <> y.word
    UNION
    SELECT x.word, y.word, y.n FROM holes x JOIN words y ON x.a || x.b = y.word
    UNION
    SELECT y.word, x.word, x.n FROM holes x JOIN words y ON x.a || x.b = y.word),
best AS (
    SELECT word, count(*) AS n_near, min(struct_pack(less := -n, near := near)) AS best FROM near GROUP BY word),
formed AS (
    SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
        CASE WHEN -best.less >= {spelling.TIMES} * w.n THEN best.near END AS form,
        CASE WHEN -best.less >= {spelling.TIMES} * w.n THEN -best.less END AS form_n
    FROM words w LEFT JOIN best b ON b.word = w.word),
chain AS (
    SELECT word, word AS root, 0 AS depth FROM formed
    UNION ALL
    SELECT c.word, f.form, depth + 1 FROM chain c JOIN formed f ON f.word = c.root WHERE f.form IS NOT NULL),
last AS (SELECT word, arg_max(root, depth) AS root FROM chain GROUP BY word)
SELECT word, form, root, n, n_near, form_n::BIGINT AS form_n FROM formed JOIN last USING (word)
"""


def _draws(tree: sharding.Tree) -> str:
    """The tree's children as rows: level, parent, node, name, weight, shard."""
    nodes = tree.children()
    level, rows = {0: 0}, []
    for parent, children in enumerate(nodes):
        for node, name, weight in children:
            level[node] = level[parent] + 1
            shard = name.removeprefix("shard ") if name.startswith("shard ") else -1
            rows.append(f"({level[node]}, {parent}, {node}, '{name}', {weight}, {shard})")
    return "(VALUES " + ", ".join(rows) + ") t(level, parent, node, name, weight, shard)"


def _descent(name: str, tree: sharding.Tree) -> str:
    """Tables ``<name>1`` to ``<name>3`` of each id's nodes by level."""
    steps = [f"{name}0 AS (SELECT DISTINCT coalesce(CAST(doc_id AS VARCHAR), '') AS key, 0 AS node FROM documents)"]
    for k in range(1, len(sharding.LEVELS) + 1):
        draw = (
            "-ln((('0x' || substr(md5(key || '/' || name), 1, 13))::BIGINT + 0.5) / 4503599627370496) / weight"
        )
        steps.append(f"""{name}{k} AS (
            SELECT key, arg_min(t.node, {draw}) AS node, arg_min(t.shard, {draw})::INTEGER AS shard
            FROM {name}{k - 1} w JOIN {_draws(tree)} ON t.parent = w.node GROUP BY key)""")
    return ",\n".join(steps)


_PLANNED = sharding.layout(sharding.SHARDS)

OP13 = f"""
WITH {_descent("own", _PLANNED)},
{_descent("more", sharding.grown(_PLANNED))},
placed AS (
    SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS key,
        strlen(coalesce(text, '')) + {sharding.OVERHEAD} AS size, {crc32("coalesce(text, '')")} AS text_crc32
    FROM documents)
SELECT doc_id, size::BIGINT AS size, text_crc32, '{sharding.LAW}' AS law, own3.shard AS shard,
    row_number() OVER (PARTITION BY own3.shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot,
    more3.shard AS grown_shard
FROM placed JOIN own3 USING (key) JOIN more3 USING (key)
"""

ORACLE_SQL = {"op11_repair": OP11, "op12_spelling": OP12, "op13_sharding": OP13}
