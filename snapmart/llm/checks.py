"""DuckDB SQL of the dealt operators that SQL can express, written without their methods."""

from __future__ import annotations

# Unsigned number of the eight hexadecimal digits that start at a position of `digest`.
_DRAW = (
    "list_reduce(list_transform(string_split(substr(digest, {at}, 8), ''),"
    " lambda c: strpos('0123456789abcdef', c)::BIGINT - 1), lambda a, b: a * 16 + b)"
)

FILL_IN_MIDDLE = f"""
WITH given AS (
    SELECT doc_id, coalesce(text, '') AS body,
           sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS digest
    FROM documents
),
cut AS (
    SELECT *, regexp_extract_all(body, '[A-Za-z]+|[^A-Za-z]') AS tokens,
           {_DRAW.format(at=1)} AS h1, {_DRAW.format(at=9)} AS h2,
           {_DRAW.format(at=17)} AS h3, {_DRAW.format(at=25)} AS h4
    FROM given
),
formed AS (
    SELECT *, len(tokens) AS n,
           least(h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)) AS one,
           greatest(h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)) AS two,
           CASE WHEN body = '' OR contains(body, '<P>') OR contains(body, '<S>')
                     OR contains(body, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM cut
),
parts AS (
    SELECT *, array_to_string(tokens[1:one], '') AS prefix,
           array_to_string(tokens[one + 1:two], '') AS middle,
           array_to_string(tokens[two + 1:n], '') AS suffix
    FROM formed
)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN body
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(body) AS restored_sha256
FROM parts
"""



def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({value}::VARCHAR) || ':' || {value}::VARCHAR END"


def _leaf(n_chars: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', n_chars, 'text')))})"


# CRC-32 of the decimal doc_id, bit by bit.
_CRC = (
    "xor(list_reduce(list_prepend(4294967295::BIGINT,"
    " list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), lambda r, b:"
    " list_reduce([xor(r, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z:"
    " xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END))), 4294967295)"
)


def _tree(name: str, leaves: str) -> str:
    """All nodes of the trees over rows of (g, pos, digest, n); n nodes at the level."""
    return f"""{name}(g, level, pos, digest, n) AS (
    SELECT g, 0, pos, digest, n FROM {leaves}
    UNION ALL
    SELECT g, level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (n + 1) // 2
    FROM {name} WHERE n > 1 GROUP BY g, level, pos // 2, n
)"""


MERKLE_MANIFEST = f"""
WITH RECURSIVE hashed AS (
    SELECT doc_id, coalesce('+' || lang, '') AS g, {_leaf("n_chars")} AS digest,
           CASE WHEN n_chars IS NOT NULL AND {_CRC} % 7 = 0 THEN {_leaf("(n_chars + 1)")} END AS changed
    FROM documents
),
leaves AS (
    SELECT *, row_number() OVER (ORDER BY g, doc_id NULLS FIRST, digest) AS id,
           row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos,
           count(*) OVER (PARTITION BY g) AS n
    FROM hashed
),
{_tree("low", "leaves")},
subroots AS (
    SELECT '' AS g, g AS sub, digest, level AS height,
           row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n
    FROM low WHERE n = 1
),
{_tree("high", "subroots")},
steps AS (
    SELECT l.id, o.level AS k, (l.pos >> o.level) % 2 AS place, s.digest AS other
    FROM leaves l JOIN low o ON o.g = l.g AND o.pos = l.pos >> o.level AND o.n > 1
    LEFT JOIN low s ON s.g = l.g AND s.level = o.level AND s.pos = xor(l.pos >> o.level, 1)
    UNION ALL
    SELECT l.id, r.height + o.level, (r.pos >> o.level) % 2, s.digest
    FROM leaves l JOIN subroots r ON r.sub = l.g
    JOIN high o ON o.pos = r.pos >> o.level AND o.n > 1
    LEFT JOIN high s ON s.level = o.level AND s.pos = xor(r.pos >> o.level, 1)
),
folds(id, k, node) AS (
    SELECT id, 0, coalesce(changed, digest) FROM leaves
    UNION ALL
    SELECT f.id, f.k + 1, sha256(CASE WHEN s.other IS NULL THEN node
                                      WHEN s.place = 1 THEN s.other || node ELSE node || s.other END)
    FROM folds f JOIN steps s ON s.id = f.id AND s.k = f.k
),
proofs AS (
    SELECT id, coalesce(string_agg(other, '' ORDER BY k), '') AS proof FROM steps GROUP BY id
)
SELECT l.doc_id, l.digest AS leaf, r.digest AS subroot, t.digest AS root,
       sha256(coalesce(p.proof, '')) AS proof_sha256, f.folded_root,
       f.folded_root = t.digest AS verified
FROM leaves l JOIN subroots r ON r.sub = l.g
JOIN (SELECT digest FROM high WHERE n = 1) t ON true
LEFT JOIN proofs p ON p.id = l.id
JOIN (SELECT id, arg_max(node, k) AS folded_root FROM folds GROUP BY id) f ON f.id = l.id
"""

CHECKS: dict[str, str] = {
    "op11_fill_in_middle": FILL_IN_MIDDLE,
    "op12_merkle_manifest": MERKLE_MANIFEST,
}
