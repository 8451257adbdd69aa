"""SQL over the driver's tables for the queries that SQL can express.

Tokenizers, hash rings, trained models and spans have no counterpart there; those queries are tested by brute force.
"""

from __future__ import annotations

_LOWER = "translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Equal payloads are read off the texts themselves. Base32 takes five bits a sign, so four signs for five hex digits.
_WARC = r"""
    WITH payloads AS (SELECT page_id, COALESCE(html, '') AS html, sha1(COALESCE(html, '')) AS hex FROM pages),
    latest AS (SELECT html, max(page_id) AS page_id FROM payloads GROUP BY html)
    SELECT p.page_id, CAST(strlen(p.html) AS BIGINT) AS payload_bytes,
           list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               1 + CAST((CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS BIGINT),
               1)), 'string_agg', '') AS payload_digest,
           CASE WHEN p.page_id = l.page_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN p.page_id <> l.page_id THEN l.page_id END AS refers_to
    FROM payloads p JOIN latest l USING (html)"""

# All windows of the documents, of each length that a window of the benchmark has.
_CONTAMINATION = rf"""
    WITH words AS (
        SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
    items AS (
        SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
    sought AS (
        SELECT DISTINCT item_id, width, array_to_string(words[pos:pos + width - 1], ' ') AS phrase
        FROM (SELECT *, unnest(range(1, len(words) - width + 2)) AS pos
              FROM (SELECT *, least(len(words), 10) AS width FROM items WHERE len(words) > 0))),
    found AS (
        SELECT doc_id, pos, width, item_id
        FROM (SELECT doc_id, pos, width, array_to_string(words[pos:pos + width - 1], ' ') AS phrase
              FROM (SELECT doc_id, words, width, unnest(range(1, len(words) - width + 2)) AS pos
                    FROM words, (SELECT DISTINCT width FROM sought) WHERE len(words) >= width))
        JOIN sought USING (width, phrase)),
    hit AS (
        SELECT doc_id, count(DISTINCT place) AS n_hit
        FROM (SELECT doc_id, unnest(range(pos, pos + width)) AS place FROM found) GROUP BY doc_id),
    named AS (
        SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM found) GROUP BY doc_id)
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, COALESCE(n_hit, 0) AS n_hit, COALESCE(n_items, 0) AS n_items,
           sha256(COALESCE(names, '')) AS items_sha256, COALESCE(n_hit, 0) > 0 AS contaminated
    FROM words LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)"""


def _components(nodes: str, node: str, links: str) -> str:
    """Common tables that end in ``least``: the smallest node that each node reaches by links (a, b)."""
    return f"""
    edges AS (SELECT a, b FROM {links} UNION ALL SELECT b, a FROM {links}),
    reached AS (
        SELECT {node} AS node, {node} AS root FROM {nodes}
        UNION
        SELECT b, root FROM reached JOIN edges ON a = node),
    least AS (SELECT node, min(root) AS component_id FROM reached GROUP BY node)"""


_COSINES = f"""
    WITH RECURSIVE vectors AS (
        SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
    usable AS (
        SELECT *, sqrt(list_dot_product(v, v)) AS length FROM vectors
        WHERE v IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(v, lambda x: x <> 0)) > 0),
    links AS (
        SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y ON x.vec_id < y.vec_id AND len(x.v) = len(y.v)
        WHERE list_dot_product(x.v, y.v) / (x.length * y.length) >= 0.9),
    {_components('embeddings', 'vec_id', 'links')},
    counts AS (SELECT a AS node, count(*) AS n FROM edges GROUP BY a)
    SELECT node AS vec_id, COALESCE(n, 0) AS n_links, component_id, node = component_id AS kept
    FROM least LEFT JOIN counts USING (node)"""

_NEAR = rf"""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS words FROM documents),
    shingled AS (
        SELECT doc_id, list_distinct(list_transform(
            range(1, greatest(len(words) - 3, least(len(words), 1) + 1)),
            lambda i: array_to_string(words[i:i + 4], ' '))) AS shingles
        FROM words),
    flat AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM shingled),
    shared AS (
        SELECT x.doc_id AS a, y.doc_id AS b, x.n + y.n AS n, count(*) AS common
        FROM flat x JOIN flat y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY ALL),
    links AS (SELECT a, b FROM shared WHERE 100 * common >= 75 * (n - common)),
    {_components('documents', 'doc_id', 'links')}
    SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
    FROM shingled JOIN least ON node = doc_id"""

def _each(parts: str, of: str, depth: int = 1) -> str:
    """``of`` each x of a list, or of the lists in it."""
    inner = of if depth == 1 else _each("x", of, depth - 1)
    return f"list_transform({parts}, lambda x: {inner})"


def _joined(of: str) -> str:
    return f"sha256(array_to_string({of}, ''))"


_ESCAPED = "text"
for _code, _letter in zip((28, 29, 30, 31), "abcd", strict=True):
    _ESCAPED = f"replace({_ESCAPED}, chr({_code}), chr(28) || '{_letter}')"

_SHORT = "array_to_string(list_transform(x, lambda y: left(y, {width})), '{between}')"

# Trees of the texts, of the edited texts and of the next texts; then the first branches that differ, level by level.
_MERKLE = rf"""
    WITH own AS (SELECT doc_id, COALESCE(text, '') AS text FROM documents),
    followed AS (
        SELECT doc_id, text, length(text) AS n, COALESCE(lead(text) OVER w, first_value(text) OVER w) AS next
        FROM own WINDOW w AS (ORDER BY doc_id DESC)),
    three AS (
        SELECT doc_id, 'own' AS kind, text FROM followed
        UNION ALL SELECT doc_id, 'edited', left(text, n - n // 2) || left(next, n // 2) FROM followed
        UNION ALL SELECT doc_id, 'next', next FROM followed),
    cut AS (
        SELECT doc_id, kind, text, regexp_replace(regexp_replace(regexp_replace(regexp_replace({_ESCAPED},
            '(\n[\t\n\f\r ]*\n)', '\1' || chr(29), 'g'), '(\n)(#{{1,6}} )', '\1' || chr(29) || '\2', 'g'),
            '(\n)([^\n\x1D])', '\1' || chr(30) || '\2', 'g'),
            '([.!?;:,st][\t\n\f\r ])([^\t\n\f\r \x1D\x1E])', '\1' || chr(31) || '\2', 'g') AS cut
        FROM three),
    parts AS (
        SELECT *, {_each("string_split(cut, chr(29))", "string_split(x, chr(30))")} AS parts FROM cut),
    leaved AS (
        SELECT *, {_each("parts", _each("string_split(x, chr(31))", "sha256(x)"), 2)} AS leaves,
               {_each("parts", "length(translate(x, chr(28) || chr(31), ''))", 2)} AS lengths
        FROM parts),
    branched AS (SELECT *, {_each("leaves", _joined("x"), 2)} AS paragraphs FROM leaved),
    sectioned AS (SELECT *, {_each("paragraphs", _joined("x"))} AS sections FROM branched),
    trees AS (
        SELECT *, list_distinct(flatten(flatten(leaves))) AS phrases, {_joined("sections")}
               || '/' || array_to_string({_each("sections", "left(x, 16)")}, ';')
               || '/' || array_to_string({_each("paragraphs", _SHORT.format(width=16, between=","))}, ';')
               || '/' || array_to_string(list_transform(leaves, lambda z: array_to_string(
                   {_each("z", _SHORT.format(width=8, between=""))}, ',')), ';') AS fingerprint
        FROM sectioned),
    compared AS (
        SELECT t.doc_id, length(t.text) AS n_chars, sha256(e.text) AS edited_sha256, t.fingerprint,
               e.fingerprint AS edited_fingerprint,
               len(list_intersect(t.phrases, e.phrases)) / greatest(len(t.phrases), len(e.phrases)) AS near_edited,
               len(list_intersect(t.phrases, f.phrases)) / greatest(len(t.phrases), len(f.phrases)) AS near_next,
               t.paragraphs AS before, e.paragraphs AS after, e.lengths AS lengths,
               list_position(list_transform(range(1, 1 + greatest(len(t.sections), len(e.sections))),
                   lambda i: t.sections[i] IS NOT DISTINCT FROM e.sections[i]), false) AS section
        FROM trees t JOIN trees e ON e.doc_id = t.doc_id AND e.kind = 'edited'
        JOIN trees f ON f.doc_id = t.doc_id AND f.kind = 'next' WHERE t.kind = 'own'),
    located AS (
        SELECT *, list_position(list_transform(
                   range(1, 1 + greatest(COALESCE(len(before[section]), 0), COALESCE(len(after[section]), 0))),
                   lambda i: before[section][i] IS NOT DISTINCT FROM after[section][i]), false) AS paragraph
        FROM compared)
    SELECT doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
           CAST(section - 1 AS INTEGER) AS edit_section, CAST(paragraph - 1 AS INTEGER) AS edit_paragraph,
           CASE WHEN section IS NOT NULL THEN CAST(COALESCE(list_sum(flatten(lengths[1:section - 1])), 0)
               + COALESCE(list_sum(lengths[section][1:paragraph - 1]), 0) AS BIGINT) END AS edit_start
    FROM located"""

# CRC-32 bit by bit over the decimal digits, which are single bytes.
_HEAD = """(xor(list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
        lambda state, byte: list_reduce(range(8), lambda value, i: CASE WHEN value & 1 = 1
            THEN xor(value >> 1, 3988292384) ELSE value >> 1 END, xor(state, byte)), 4294967295), 4294967295) % 6)"""

_TRIE = f"""
    WITH turns AS (
        SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
        WHERE conv_id IS NOT NULL),
    own AS (
        SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST,
                             left(sha256(length(role) || ':' || role || text), 32)) AS turns
        FROM turns GROUP BY conv_id),
    heads AS (SELECT *, {_HEAD} AS h FROM own),
    rebuilt AS (
        SELECT x.conv_id, list_concat(COALESCE(base.turns, [])[1:x.h], x.turns[x.h + 1:]) AS path
        FROM heads x LEFT JOIN own base ON base.conv_id = x.conv_id - x.conv_id % 100),
    passed AS (SELECT conv_id, len(path) AS length, unnest(list_transform(range(len(path) + 1), lambda d: path[1:d])) AS node
               FROM rebuilt),
    nodes AS (
        SELECT node, min(conv_id) AS conv_id, count(*) AS n_convs, len(node) AS depth,
               sha256(COALESCE(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (length = len(node)), '')) AS ends_sha256
        FROM passed GROUP BY node),
    children AS (SELECT node[1:depth - 1] AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
    counted AS (
        SELECT nodes.*, COALESCE(n, 0) AS n_children,
               CASE WHEN depth > 0 THEN (n_convs - 1) * length(node[depth].text) ELSE 0 END AS saved
        FROM nodes LEFT JOIN children USING (node)),
    subtrees AS (
        SELECT top AS node, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
        FROM (SELECT n_children, saved, unnest(list_transform(range(depth + 1), lambda d: node[1:d])) AS top FROM counted)
        GROUP BY top)
    SELECT x.conv_id, x.depth, above.conv_id AS parent_conv_id, x.n_convs, x.n_children, n_leaves, saved_tokens,
           x.ends_sha256
    FROM counted x JOIN subtrees USING (node)
    LEFT JOIN nodes above ON x.depth > 0 AND above.node = x.node[1:x.depth - 1]"""

ORACLES: dict[str, str] = {
    "op2_warc": _WARC,
    "op7_contamination": _CONTAMINATION,
    "op9_cover_tree": _COSINES,
    "op10_near_duplicates": _NEAR,
    "op11_merkle": _MERKLE,
    "op13_prefix_trie": _TRIE,
}
