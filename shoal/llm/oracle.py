"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

from shoal.llm.license import HOLDERS, LISTED, SPDX, TRIGGER, known_sentences, rule_table

SQL: dict[str, str] = {}

_NORM = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL["op6_exact_dedup"] = f"""
WITH d AS (SELECT doc_id, {_NORM} AS t FROM documents)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY t) AS kept,
       sha256(t) AS text_sha256
FROM d
"""

# Escapes: backslash first, then # and < (written l; : in the role).
_ESC = r"replace(replace(replace({0}, '\', '\\'), '#', '\#'), '<', '\l')"
SQL["op3_chat_format"] = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
                       FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(4 + length(replace({_ESC.format('role')}, ':', '\:')) + 2
                + length({_ESC.format('text')}) + 8) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""


def _mixing(entropy: float, halvings: int, block_tokens: int, least: int, most: int, token: str, seed: int = 1) -> str:
    power = "pow(p, (lo + hi) / 2)"
    return rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce('=' || source, '') AS src,
         md5('{seed}/' || coalesce(CAST(doc_id AS VARCHAR), 'text ' || md5(coalesce(text, '')))) AS digest,
         len(regexp_extract_all(coalesce(text, ''), '{token}')) AS n
  FROM documents),
e AS (SELECT src, digest, sum(n) AS n FROM d GROUP BY src, digest),
totals AS (SELECT src, sum(n)::BIGINT AS n_tokens FROM e GROUP BY src),
whole AS (SELECT coalesce(sum(n_tokens), 0)::BIGINT AS total FROM totals),
p AS (SELECT src, n_tokens, n_tokens::DOUBLE / total AS p FROM totals, whole WHERE n_tokens > 0),
target AS (SELECT {entropy}::DOUBLE * ln(count(*)) AS goal, -sum(p * ln(p)) AS natural_h FROM p),
bis(step, lo, hi) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT step + 1, CASE WHEN h >= goal THEN (lo + hi) / 2 ELSE lo END, CASE WHEN h >= goal THEN hi ELSE (lo + hi) / 2 END
  FROM (SELECT step, lo, hi, (SELECT ln(sum({power})) - sum({power} * ((lo + hi) / 2) * ln(p)) / sum({power}) FROM p) AS h
        FROM bis WHERE step < {halvings}), target),
a AS (SELECT CASE WHEN natural_h >= goal THEN 1.0::DOUBLE ELSE (SELECT lo FROM bis WHERE step = {halvings}) END AS a FROM target),
w AS (SELECT src, n_tokens, pow(p, a) AS power, sum(pow(p, a)) OVER () AS z FROM p, a),
s AS (
  SELECT t.src, t.n_tokens, coalesce(w.power / w.z, 0) AS weight,
         coalesce(floor(total::DOUBLE * w.power / w.z + 0.5)::BIGINT, 0) AS goal
  FROM totals t CROSS JOIN whole LEFT JOIN w ON w.src = t.src),
src AS (
  SELECT *, CASE WHEN n_tokens = 0 THEN 1 ELSE goal // n_tokens END AS passes,
         CASE WHEN n_tokens = 0 THEN 0 ELSE goal % n_tokens END AS rest FROM s),
n AS (SELECT least(greatest((total + {block_tokens} - 1) // {block_tokens}, {least}), {most}) AS n_blocks FROM whole),
eb AS (SELECT e.*, CAST('0x' || substr(digest, 1, 8) AS BIGINT) % n_blocks AS block FROM e, n),
b AS (
  SELECT src, block, n, sum(n) OVER (PARTITION BY src ORDER BY md5('{seed}/' || src || '/' || block), block
                                     ROWS UNBOUNDED PRECEDING) AS upto
  FROM (SELECT src, block, sum(n) AS n FROM eb GROUP BY src, block)),
bb AS (SELECT b.src, block, upto <= rest AND rest > 0 AS taken, rest - upto + n AS room,
              upto > rest AND upto - n < rest AS border FROM b JOIN src ON src.src = b.src),
inside AS (
  SELECT eb.src, digest, room, sum(eb.n) OVER (PARTITION BY eb.src, eb.block ORDER BY digest ROWS UNBOUNDED PRECEDING) AS upto
  FROM eb JOIN bb ON bb.src = eb.src AND bb.block = eb.block WHERE border)
SELECT d.doc_id, d.source, bb.block, round(src.weight, 6) AS weight,
       CAST(passes + taken::INT + (CASE WHEN i.digest IS NULL THEN 0 ELSE 1 END) AS BIGINT) AS copies
FROM d JOIN src ON src.src = d.src
JOIN eb ON eb.src = d.src AND eb.digest = d.digest
JOIN bb ON bb.src = eb.src AND bb.block = eb.block
LEFT JOIN (SELECT src, digest FROM inside WHERE upto <= room) i ON i.src = d.src AND i.digest = d.digest
"""


SQL["op8_temperature_mixing"] = _mixing(0.95, 28, 1 << 20, 16, 1 << 20, r"[^ \t\n\r\f]+")


def _licences() -> str:
    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    table = sorted(known_sentences().items())
    known = "MAP {" + ", ".join(f"{quoted(s)}: {quoted(i)}" for s, i in table) + "}"
    norm = "trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'))"

    def named(s: str) -> str:
        return ("coalesce(k[" + s + "], CASE " + " ".join(f"WHEN regexp_matches({s}, {quoted(p)}) THEN {quoted(i)}" for p, i in HOLDERS)
                + " END)")

    def by(phrase: str) -> str:
        return f"lambda y: k['{phrase} ' || regexp_replace({norm.format('y')}, ' (?:only|or later)$', '')]"

    # tag values and lists of licences, split at a mark that stands in no text
    tag = f"regexp_replace(regexp_extract(x, {quoted(SPDX)}, 1), '[()\\s]+', ' ', 'g')"
    tags = f"string_split(regexp_replace({tag}, '(?i) (?:or|and|with) ', chr(1), 'g'), chr(1))"
    listed = f"regexp_extract({norm.format('x')}, {quoted(LISTED)}, 1)"
    lists = f"string_split(regexp_replace({listed}, ' (?:or|and) (?:the |a )?', chr(1), 'g'), chr(1))"
    line = (f"CASE WHEN {named(norm.format('x'))} IS NOT NULL THEN [{named(norm.format('x'))}] "
            f"WHEN {tag} <> '' THEN list_transform({tags}, {by('spdx license identifier')}) "
            f"WHEN {listed} <> '' THEN list_transform({lists}, {by('licensed under')}) ELSE [] END")
    steps, last = [], "r0"
    for k, (pattern, ident) in enumerate(rule_table(), start=1):
        hit = f"regexp_matches(seq, {quoted(pattern)})"
        steps.append(f"r{k} AS (SELECT doc_id, ids, CASE WHEN {hit} THEN regexp_replace(seq, {quoted(pattern)}, ',', 'g') ELSE seq END AS seq, "
                     f"CASE WHEN {hit} AND NOT list_contains(found, {quoted(ident)}) THEN list_append(found, {quoted(ident)}) ELSE found END AS found "
                     f"FROM {last})")
        last = f"r{k}"
    return rf"""
WITH known AS MATERIALIZED (SELECT {known} AS k),
t AS (
  SELECT doc_id, list_filter(string_split(regexp_replace(regexp_replace(coalesce(text, ''), '(?i)(spdx-license-identifier):[ \t]+', '\1 ', 'g'), '([.!?;:])\s+|\n[ \t\r]*\n', '\1' || chr(1), 'g'), chr(1)),
                             lambda s: regexp_matches(lower(s), {quoted(TRIGGER)})) AS sentences
  FROM documents),
i AS (
  SELECT doc_id, list_filter(flatten(list_transform(sentences, lambda s:
           CASE WHEN {named(norm.format('s'))} IS NOT NULL THEN [{named(norm.format('s'))}]
                ELSE flatten(list_transform(string_split(s, chr(10)), lambda x: {line})) END)), lambda x: x IS NOT NULL) AS ids
  FROM t, known),
r0 AS MATERIALIZED (SELECT doc_id, ids, ',' || array_to_string(ids, ',') || ',' AS seq, CAST([] AS VARCHAR[]) AS found FROM i),
{", ".join(steps)}
SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_known, coalesce(array_to_string(ids, ','), '') AS identifiers,
       coalesce(array_to_string(found, ','), '') AS licenses,
       CAST(len(list_filter(string_split(seq, ','), lambda x: x <> '')) AS BIGINT) AS unmatched
FROM {last}
"""


SQL["op5_license_scan"] = _licences()

# Conversations as lists of turns; every prefix of a rebuilt one is a node's path.  Turns are ordered by the digest that names
# them where turn numbers tie.  CRC-32 (reflected, polynomial 0xEDB88320) bit by bit over the id's digits.
SQL["op13_prefix_trie"] = """
WITH t AS (
  SELECT conv_id, {'known': turn IS NOT NULL, 'turn': turn,
                   'name': substr(sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32),
                   'turn_of': {'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS t
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list_transform(list_sort(list(t)), lambda x: x.turn_of) AS own FROM t GROUP BY conv_id),
h AS (
  SELECT conv_id, own, conv_id - conv_id % 5 AS head_of,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
               lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                 lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295::BIGINT) % 9 AS h
  FROM c),
r AS (SELECT h.conv_id, coalesce(p.own[1:h.h], []) || h.own[h.h + 1:] AS turns FROM h LEFT JOIN c p ON p.conv_id = h.head_of),
m AS (SELECT conv_id, len(turns) AS n, d, turns[1:d] AS path FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM r)),
n AS (
  SELECT path, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         CASE WHEN d = 0 THEN 0 ELSE count(*) - 1 END * CASE WHEN d = 0 THEN 0 ELSE strlen(path[d].text) END AS own_saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256
  FROM m GROUP BY path, d),
k AS (SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
a AS (
  SELECT path[1:e] AS path, sum(own_saved) AS saved_tokens, sum(leaf) AS n_leaves
  FROM (SELECT n.path, own_saved, CASE WHEN n_children IS NULL THEN 1 ELSE 0 END AS leaf, unnest(range(depth + 1)) AS e
        FROM n LEFT JOIN k ON k.path = n.path) GROUP BY 1)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children,
       n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM n JOIN a ON a.path = n.path LEFT JOIN k ON k.path = n.path
LEFT JOIN n p ON n.depth > 0 AND p.path = n.path[1:n.depth - 1]
"""
