"""DuckDB SQL of the registered queries whose rows SQL can state.

The url rules and listed words are written out anew: the statements share
nothing with the Spark code. Near-duplicate statements compare all pairs and
reach components by recursion, which suits the tables they are checked on.
"""

from __future__ import annotations

_URLS = r"""
    WITH split AS (
        SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'),
                                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
        FROM (SELECT page_id, CASE WHEN instr(url, '://') > 0
                                   THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
              FROM pages) x),
    rules(host, path, action) AS (
        VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
               ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
    listed AS (
        SELECT DISTINCT host FROM split
        WHERE regexp_matches(host, '(^|[.-])(ads|adult|bets|casino|malware|phishing|pills|porn|spam|warez)([.-]|$)')),
    ruled AS (
        SELECT s.page_id, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
               arg_max(r.action, length(r.host || r.path)) AS action
        FROM split s JOIN rules r ON (s.host = r.host OR suffix(s.host, '.' || r.host))
                                     AND starts_with(s.path, r.path)
        GROUP BY s.page_id),
    blocked AS (
        SELECT DISTINCT s.page_id FROM split s JOIN listed b
            ON (s.host = b.host OR suffix(s.host, '.' || b.host)) AND starts_with(s.path, '/'))
    SELECT s.page_id, s.host, s.path, r.rule,
           CASE WHEN r.page_id IS NOT NULL THEN r.action
                WHEN b.page_id IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
    FROM split s LEFT JOIN ruled r ON s.page_id = r.page_id
         LEFT JOIN blocked b ON s.page_id = b.page_id"""

_REACH = """
    reach(node, other) AS (
        SELECT a, b FROM links
        UNION
        SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a),
    least AS (SELECT node, min(other) AS first FROM reach GROUP BY node)"""

_VECTORS = f"""
    WITH RECURSIVE usable AS (
        SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v
        FROM embeddings
        WHERE label IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    links(a, b) AS (
        SELECT x.vec_id, y.vec_id FROM usable x JOIN usable y
            ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
        WHERE list_cosine_similarity(x.v, y.v) >= 0.93),
    {_REACH},
    degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
    SELECT e.vec_id, coalesce(d.n, 0) AS n_links,
           least(e.vec_id, coalesce(c.first, e.vec_id)) AS component_id,
           e.vec_id = least(e.vec_id, coalesce(c.first, e.vec_id)) AS kept
    FROM embeddings e LEFT JOIN degree d ON e.vec_id = d.a LEFT JOIN least c ON e.vec_id = c.node"""

_COPIES = rf"""
    WITH RECURSIVE worded AS (
        SELECT doc_id, regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
        FROM documents),
    sets AS (
        SELECT DISTINCT doc_id, s FROM (
            SELECT doc_id, unnest(list_transform(
                range(1, greatest(len(w) - 3, 1) + 1),
                lambda i: array_to_string(list_slice(w, i, i + 3), ' '))) AS s
            FROM worded WHERE len(w) > 0) x),
    sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
    pairs AS (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
        FROM sets x JOIN sets y ON x.s = y.s AND x.doc_id <> y.doc_id
        GROUP BY x.doc_id, y.doc_id),
    links(a, b) AS (
        SELECT p.a, p.b FROM pairs p JOIN sizes x ON p.a = x.doc_id JOIN sizes y ON p.b = y.doc_id
        WHERE 100 * p.c >= 80 * (x.n + y.n - p.c)),
    {_REACH}
    SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles,
           least(d.doc_id, coalesce(c.first, d.doc_id)) AS component_id,
           d.doc_id = least(d.doc_id, coalesce(c.first, d.doc_id)) AS kept
    FROM documents d LEFT JOIN sizes z ON d.doc_id = z.doc_id
         LEFT JOIN least c ON d.doc_id = c.node"""

_NEGATIVES = """
    WITH usable AS (
        SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
        SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
               CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
        FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
        WHERE a.vec_id % 50 = 0),
    positive AS (
        SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
    SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
    FROM (SELECT p.*, s.id AS negative_id, s.score AS negative_score,
                 row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.id) AS rank
          FROM positive p JOIN scored s USING (anchor_id)
          WHERE NOT s.same AND 50 * positive_score <= 100 * s.score
                AND 100 * s.score <= 95 * positive_score) x
    WHERE rank <= 3"""


def _counted(column: str) -> str:
    text = f"CAST({column} AS VARCHAR)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _leaf(text: str) -> str:
    columns = ("doc_id", "source", "lang", "n_chars", text)
    return f"sha256({' || '.join(map(_counted, columns))})"


_CRC = """xor(4294967295, list_reduce(
    [4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
    lambda crc, byte: list_reduce([xor(crc, byte)] || CAST(range(8) AS BIGINT[]),
                                  lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))))"""


def _levels(name: str, leaves: str) -> str:
    """Nodes (tree, lvl, rank, d, n) from the leaves up, n nodes in a level."""
    return f"""
    {name} AS (
        SELECT tree, 0 AS lvl, rank, d, n FROM {leaves}
        UNION ALL
        SELECT tree, lvl + 1, rank // 3, sha256(string_agg(d, '' ORDER BY rank)), (n + 2) // 3
        FROM {name} WHERE n > 1 GROUP BY tree, lvl, rank // 3, n)"""


_MANIFEST = f"""
    WITH RECURSIVE docs AS (
        SELECT row_number() OVER () AS id, doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
               {_leaf("text")} AS leaf,
               CASE WHEN {_CRC} & 1 = 0 THEN {_leaf("replace(text, chr(10), '')")}
                    ELSE {_leaf("text")} END AS seen
        FROM documents),
    leaves AS (
        SELECT id, tree, leaf AS d, count(*) OVER (PARTITION BY tree) AS n,
               row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank
        FROM docs),
    {_levels("nodes", "leaves")},
    subroots AS (
        SELECT -1 AS tree, tree AS rank, d, lvl, count(*) OVER () AS n FROM nodes WHERE n = 1),
    {_levels("upper", "subroots")},
    every AS (SELECT * FROM nodes UNION ALL SELECT * FROM upper),
    heights AS (SELECT tree, max(lvl) AS height FROM every GROUP BY tree),
    steps AS (
        SELECT x.tree, x.lvl, x.rank,
               coalesce(string_agg(y.d, '' ORDER BY y.rank) FILTER (y.rank < x.rank), '') AS l,
               coalesce(string_agg(y.d, '' ORDER BY y.rank) FILTER (y.rank > x.rank), '') AS r
        FROM every x JOIN every y ON x.tree = y.tree AND x.lvl = y.lvl AND x.rank // 3 = y.rank // 3
        WHERE x.n > 1 GROUP BY x.tree, x.lvl, x.rank),
    jumps AS (
        SELECT s.*, CASE WHEN s.lvl + 1 < h.height OR s.tree = -1 THEN s.tree ELSE -1 END AS up_tree,
               CASE WHEN s.lvl + 1 < h.height OR s.tree = -1 THEN s.lvl + 1 ELSE 0 END AS up_lvl,
               CASE WHEN s.lvl + 1 < h.height OR s.tree = -1 THEN s.rank // 3 ELSE s.tree END AS up_rank
        FROM steps s JOIN heights h ON s.tree = h.tree),
    walk AS (
        SELECT d.id, 0 AS step, CASE WHEN h.height = 0 THEN -1 ELSE d.tree END AS tree, 0 AS lvl,
               CASE WHEN h.height = 0 THEN d.tree ELSE l.rank END AS rank, d.seen AS node, '' AS proof
        FROM docs d JOIN leaves l ON d.id = l.id JOIN heights h ON h.tree = d.tree
        UNION ALL
        SELECT w.id, w.step + 1, j.up_tree, j.up_lvl, j.up_rank,
               sha256(j.l || w.node || j.r), w.proof || j.l || j.r
        FROM walk w JOIN jumps j ON w.tree = j.tree AND w.lvl = j.lvl AND w.rank = j.rank),
    ends AS (SELECT id, arg_max(node, step) AS node, arg_max(proof, step) AS proof FROM walk GROUP BY id),
    root AS (SELECT d FROM upper WHERE n = 1)
    SELECT d.doc_id, d.leaf, s.d AS subroot, root.d AS root, sha256(e.proof) AS proof_sha256,
           e.node AS folded_root, e.node = root.d AS verified
    FROM docs d JOIN ends e ON d.id = e.id JOIN subroots s ON s.rank = d.tree, root"""

STATEMENTS = {
    "op12_hard_negatives": _NEGATIVES,
    "op13_merkle_manifest": _MANIFEST,
    "op3_url_filters": _URLS,
    "op4_embedding_near_dedup": _VECTORS,
    "op8_minhash_near_dedup": _COPIES,
}
