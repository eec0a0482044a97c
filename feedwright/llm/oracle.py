"""DuckDB SQL for the operators' results where SQL can express them."""

from feedwright.llm.licenses import PERCENT, TEMPLATES

ORACLE: dict[str, str] = {}

ORACLE["op7_exact_dedup"] = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(norm) AS text_sha256
FROM (SELECT doc_id,
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
      FROM documents)
WINDOW same AS (PARTITION BY norm)
"""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# A window is looked for as text between spaces, as words never hold a space.
ORACLE["op4_decontamination"] = rf"""
WITH d AS (
    SELECT doc_id, list_filter(regexp_split_to_array({_LOWER.format("coalesce(text, '')")},
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
    FROM documents),
b AS (
    SELECT CAST(item_id AS VARCHAR) AS item, list_filter(regexp_split_to_array({_LOWER.format("text")},
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
    FROM benchmark WHERE text IS NOT NULL),
windows AS (
    SELECT DISTINCT item, len(w[i:i + 9]) AS n, array_to_string(w[i:i + 9], ' ') AS t
    FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS r(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
    SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS t
    FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS r(i)),
found AS (SELECT doc_id, i, n, item FROM places JOIN windows USING (n, t)),
hit AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit
        FROM (SELECT DISTINCT doc_id, i, n FROM found), unnest(range(0, n)) AS r(k) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item) AS n_items,
                 sha256(string_agg(DISTINCT item, ',' ORDER BY item)) AS sha
          FROM found GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(sha, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLE["op8_minmax_near_dedup"] = rf"""
WITH RECURSIVE d AS (
    SELECT doc_id, list_filter(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[\x20\x09-\x0D]+'),
           lambda w: w <> '') AS w
    FROM documents),
s AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS t
    FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS r(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
pairs AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
    FROM s x JOIN s y ON x.t = y.t AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (
    SELECT a, b FROM pairs JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
    WHERE 100 * shared >= 75 * (na.size + nb.size - shared)),
reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents
    UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other)
SELECT d.doc_id, coalesce(n.size, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM d LEFT JOIN n USING (doc_id)
JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id)
"""

ORACLE["op5_substring_dedup"] = r"""
WITH d AS (
    SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents),
windows AS (
    SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS t
    FROM d, unnest(range(1, len(w) - 48)) AS r(i)),
owners AS (SELECT t, min(doc_id) AS owner FROM windows GROUP BY t),
gone AS (
    SELECT DISTINCT doc_id, i + k AS p
    FROM windows JOIN owners USING (t), unnest(range(0, 50)) AS r(k) WHERE doc_id > owner),
places AS (SELECT doc_id, p, w[p] AS word FROM d, unnest(range(1, len(w) + 1)) AS r(p)),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t
    FROM places ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
removed AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN removed USING (doc_id)
"""

_NOTICES = ", ".join("('{}', '{}')".format(*(x.replace("'", "''") for x in t)) for t in TEMPLATES.items())
_ALNUM = "list_filter(regexp_split_to_array({}, '[^a-z0-9]+'), lambda w: w <> '')"

ORACLE["op9_license_scan"] = f"""
WITH t AS (SELECT license, {_ALNUM.format(_LOWER.format("text"))} AS w FROM (VALUES {_NOTICES}) v(license, text)),
ts AS (SELECT DISTINCT license, array_to_string(w[i:i + 4], ' ') AS s
       FROM t, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS r(i)),
tn AS (SELECT license, count(*) AS n, CAST(pow(2, ceil(log2(count(*)))) AS BIGINT) AS size FROM ts GROUP BY license),
d AS (SELECT DISTINCT doc_id, {_ALNUM.format(_LOWER.format("text"))} AS w FROM documents WHERE text IS NOT NULL),
ds AS (SELECT doc_id, i - 1 AS i, array_to_string(w[i:i + 4], ' ') AS s
       FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS r(i) WHERE len(w) > 0),
windows AS (
    SELECT doc_id, license, n, i // size - back AS k, count(DISTINCT s) AS shared
    FROM ds JOIN ts USING (s) JOIN tn USING (license), (VALUES (0), (1)) b(back)
    WHERE i // size >= back GROUP BY doc_id, license, n, k)
SELECT doc_id, license, CAST(max(shared) AS INTEGER) AS n_shared, CAST(any_value(n) AS INTEGER) AS n_template
FROM windows WHERE 100 * shared >= {PERCENT} * n GROUP BY doc_id, license
"""


def _crc(text: str) -> str:
    """crc32 of an ASCII text, bit by bit."""
    bits = "lambda r, k: xor(r >> 1, (r & 1) * 3988292384::UBIGINT)"
    bytes_ = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::UBIGINT)"
    step = f"lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)::UBIGINT[]), {bits})"
    return f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {bytes_}), {step}), 4294967295::UBIGINT)"


def _leaf(*fields: str) -> str:
    one = "CASE WHEN ({0}) IS NULL THEN '-' ELSE strlen(({0})::VARCHAR) || ':' || ({0})::VARCHAR END"
    return "sha256(" + " || ".join(one.format(f) for f in fields) + ")"


_MORE = f"n_chars + CASE WHEN {_crc('doc_id::VARCHAR')} % 7 = 0 THEN 1 ELSE 0 END"
# The two ways up are the same: a pair of neighbours becomes one node, a single one is hashed alone.
_UP = "level + 1, tree, i // 2, (n + 1) // 2, sha256(h || coalesce(other, ''))"
_FOLD = """level + 1, w.tree, w.i // 2, (w.n + 1) // 2,
    sha256(CASE WHEN s.h IS NULL THEN w.h WHEN w.i % 2 = 0 THEN w.h || s.h ELSE s.h || w.h END),
    held || coalesce(s.h, '')"""

ORACLE["op12_merkle_manifest"] = f"""
WITH RECURSIVE d AS (
    SELECT doc_id, coalesce('+' || lang, '') AS tree,
           {_leaf("doc_id", "source", "lang", "n_chars", "text")} AS leaf,
           {_leaf("doc_id", "source", "lang", _MORE, "text")} AS claim
    FROM documents),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
           count(*) OVER (PARTITION BY tree) AS n
    FROM d),
trees AS (
    SELECT 0 AS level, tree, i, n, leaf AS h FROM placed
    UNION ALL
    SELECT {_UP} FROM (SELECT *, lead(h) OVER (PARTITION BY tree ORDER BY i) AS other FROM trees WHERE n > 1)
    WHERE i % 2 = 0),
tops AS (SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n
         FROM trees WHERE n = 1),
crown AS (
    SELECT 0 AS level, 'crown' AS tree, i, n, subroot AS h FROM tops
    UNION ALL
    SELECT {_UP} FROM (SELECT *, lead(h) OVER (ORDER BY i) AS other FROM crown WHERE n > 1) WHERE i % 2 = 0),
walk AS (
    SELECT doc_id, leaf, tree AS own, 0 AS level, tree, i, n, claim AS h, '' AS held FROM placed
    UNION ALL
    SELECT doc_id, leaf, own, w.{_FOLD}
    FROM walk w LEFT JOIN trees s ON s.tree = w.tree AND s.level = w.level AND s.i = xor(w.i, 1) WHERE w.n > 1),
climb AS (
    SELECT doc_id, leaf, own, subroot, 0 AS level, 'crown' AS tree, tops.i, tops.n, h, held
    FROM walk JOIN tops ON tops.tree = own WHERE walk.n = 1
    UNION ALL
    SELECT doc_id, leaf, own, subroot, w.{_FOLD}
    FROM climb w LEFT JOIN crown s ON s.level = w.level AND s.i = xor(w.i, 1) WHERE w.n > 1)
SELECT doc_id, leaf, subroot, r.h AS root, sha256(held) AS proof_sha256, climb.h AS folded_root, climb.h = r.h AS verified
FROM climb, (SELECT h FROM crown WHERE n = 1) r WHERE climb.n = 1
"""

_WORDS = r"len(list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> ''))"

ORACLE["op13_prefix_trie"] = f"""
WITH t AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, turn FROM conversations WHERE conv_id IS NOT NULL),
turns AS (
    SELECT conv_id, sha256(strlen(role) || ':' || role || text) AS sha, {_WORDS} AS words,
           row_number() OVER (PARTITION BY conv_id
                              ORDER BY turn NULLS FIRST, sha256(strlen(role) || ':' || role || text)) - 1 AS p
    FROM t),
convs AS (SELECT DISTINCT conv_id, {_crc("conv_id::VARCHAR")} % 4 AS h FROM turns),
given AS (
    SELECT c.conv_id, b.p, b.sha, b.words FROM convs c JOIN turns b ON b.conv_id = c.conv_id - c.conv_id % 20 AND b.p < c.h),
rebuilt AS (
    SELECT conv_id, 0 AS own, p, sha, words FROM given
    UNION ALL SELECT conv_id, 1, p, sha, words FROM turns JOIN convs USING (conv_id) WHERE p >= h),
lists AS (
    SELECT conv_id, list(sha ORDER BY own, p) AS shas, list(words ORDER BY own, p) AS words FROM rebuilt GROUP BY conv_id),
whole AS (
    SELECT conv_id, coalesce(shas, []) AS shas, words FROM convs LEFT JOIN lists USING (conv_id)),
steps AS (
    SELECT conv_id, d AS depth, array_to_string(shas[:d], ',') AS node, array_to_string(shas[:d - 1], ',') AS parent,
           CASE WHEN d > 0 THEN words[d] ELSE 0 END AS words, d = len(shas) AS ends
    FROM whole, unnest(range(0, len(shas) + 1)) AS r(d)),
nodes AS (
    SELECT depth, node, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
    FROM steps GROUP BY depth, node),
kids AS (SELECT depth - 1 AS depth, parent AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
valued AS (
    SELECT nodes.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * words AS saved
    FROM nodes LEFT JOIN kids USING (depth, node)),
below AS (
    -- A node lies below all prefixes of its smallest conversation.
    SELECT s.depth, s.node, sum(v.saved) AS saved_tokens, count(*) FILTER (v.n_children = 0) AS n_leaves
    FROM valued v JOIN steps s ON s.conv_id = v.conv_id AND s.depth <= v.depth GROUP BY s.depth, s.node)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, b.n_leaves,
       CAST(b.saved_tokens AS BIGINT) AS saved_tokens, v.ends_sha256
FROM valued v JOIN below b USING (depth, node)
LEFT JOIN nodes p ON v.depth > 0 AND p.depth = v.depth - 1 AND p.node = v.parent
"""
