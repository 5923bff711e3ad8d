"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

from propense.llm.lines import LOWER, MIN_CHARS, MIN_DOCUMENTS, UPPER
from propense.llm.manifest import WIDTH

LINE_DEDUP = f"""
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
places AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM docs),
keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key
    FROM places
),
again AS (
    SELECT key, min(doc_id) AS smallest FROM keyed WHERE length(key) >= {MIN_CHARS}
    GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCUMENTS}
),
judged AS (SELECT k.*, a.key IS NOT NULL AND k.doc_id <> a.smallest AS dropped FROM keyed k LEFT JOIN again a USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


def _step(nodes: str, paths: str, k: int) -> str:
    """From the nodes and paths of one level to those of the next; a lone node stays as it is."""
    return f"""
{nodes}_runs{k} AS MATERIALIZED (
    SELECT grp, place // {WIDTH} AS run, any_value(total) AS total, list(node ORDER BY place) AS nodes
    FROM {nodes}{k} GROUP BY ALL
),
{nodes}{k + 1} AS MATERIALIZED (
    SELECT grp, run AS place, (total + {WIDTH - 1}) // {WIDTH} AS total,
        CASE WHEN total = 1 THEN nodes[1] ELSE sha256(array_to_string(nodes, '')) END AS node
    FROM {nodes}_runs{k}
),
{paths}_sides{k} AS MATERIALIZED (
    SELECT p.*, total, array_to_string(nodes[1:place % {WIDTH}], '') AS before,
        array_to_string(nodes[place % {WIDTH} + 2:], '') AS after
    FROM {paths}{k} p JOIN {nodes}_runs{k} r ON p.grp IS NOT DISTINCT FROM r.grp AND p.place // {WIDTH} = r.run
),
{paths}{k + 1} AS MATERIALIZED (
    SELECT * EXCLUDE (place, node, proof, total, before, after), place // {WIDTH} AS place, proof || before || after AS proof,
        CASE WHEN total = 1 THEN node ELSE sha256(before || node || after) END AS node
    FROM {paths}_sides{k}
),"""


def merkle_manifest(levels: int = 5, upper_levels: int = 3) -> str:
    """Trees of up to 16^levels leaves a source, and 16^upper_levels sources."""
    field = lambda c: f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
    leaf = lambda text: f"sha256({' || '.join(map(field, ('doc_id', 'source', 'lang', 'n_chars', text)))})"
    byte = "list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT)"
    bits = "list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: xor(x >> 1, (x & 1) * 3988292384))"
    crc = f"xor(list_reduce(list_prepend(4294967295::BIGINT, {byte}), lambda c, b: {bits}), 4294967295::BIGINT)"
    lowered = f"translate(text, '{UPPER}', '{LOWER}')"
    lower = "".join(_step("n", "p", k) for k in range(levels))
    upper = "".join(_step("u", "q", k) for k in range(upper_levels))
    return f"""
WITH leaves AS MATERIALIZED (
    SELECT doc_id, source AS grp, {leaf("text")} AS leaf,
        CASE WHEN {crc} % 5 = 0 THEN {leaf(lowered)} ELSE {leaf("text")} END AS moved,
        row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS place, count(*) OVER (PARTITION BY source) AS total
    FROM documents
),
n0 AS (SELECT grp, place, total, leaf AS node FROM leaves),
p0 AS (SELECT doc_id, grp, leaf, place, moved AS node, '' AS proof FROM leaves),
{lower}
groups AS MATERIALIZED (
    SELECT grp AS source, node, row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS place, count(*) OVER () AS total FROM n{levels}
),
u0 AS (SELECT 0 AS grp, place, total, node FROM groups),
q0 AS (
    SELECT doc_id, leaf, g.node AS subroot, 0 AS grp, g.place AS place, p.node AS node, proof
    FROM p{levels} p JOIN groups g ON p.grp IS NOT DISTINCT FROM g.source
),
{upper}
top AS (SELECT node AS root FROM u{upper_levels})
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, node AS folded_root, node = root AS verified
FROM q{upper_levels} CROSS JOIN top
"""
