"""DuckDB SQL that gives the rows of the text queries that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: str) -> str:
    """Words of a text: runs of digits, letters and characters outside ASCII, A to Z in lower case."""
    return rf"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def reached(nodes: str, links: str) -> str:
    """Tables `walk` and `component` (node, component): the smallest node that links (a, b), both ways, lead to."""
    return f"""walk AS (SELECT node, node AS seen FROM {nodes} UNION SELECT walk.node, l.b FROM walk JOIN {links} l ON l.a = walk.seen),
        component AS (SELECT node, MIN(seen) AS component FROM walk GROUP BY node)"""


VECTORS = f"""WITH RECURSIVE good AS (
        SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    links AS (SELECT p.vec_id AS a, q.vec_id AS b FROM good p JOIN good q ON p.label = q.label AND p.vec_id <> q.vec_id AND len(p.v) = len(q.v)
        WHERE list_cosine_similarity(p.v, q.v) >= 0.93::DOUBLE),
    nodes AS (SELECT vec_id AS node FROM embeddings), {reached('nodes', 'links')}
    SELECT vec_id, (SELECT COUNT(*) FROM links WHERE a = vec_id) AS n_links, component AS component_id, vec_id = component AS kept
    FROM embeddings JOIN component ON node = vec_id"""

NEAR_DUPLICATES = f"""WITH RECURSIVE worded AS (SELECT doc_id, {words('text')} AS w FROM documents),
    shingled AS (SELECT DISTINCT doc_id, array_to_string(w[p : p + 4], ' ') AS s FROM worded, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(p) WHERE len(w) > 0),
    sizes AS (SELECT doc_id, COUNT(*) AS n, md5(string_agg(s, chr(10) ORDER BY s)) AS key FROM shingled GROUP BY doc_id),
    classes AS (SELECT key, MIN(doc_id) AS class_id, COUNT(*) AS copies, ANY_VALUE(n) AS n FROM sizes GROUP BY key),
    held AS (SELECT class_id, s FROM shingled JOIN classes ON class_id = doc_id),
    shared AS (SELECT p.class_id AS a, q.class_id AS b, COUNT(*) AS c FROM held p JOIN held q ON p.s = q.s AND p.class_id <> q.class_id GROUP BY 1, 2),
    links AS (SELECT a, b, y.copies FROM shared JOIN classes x ON x.class_id = a JOIN classes y ON y.class_id = b WHERE c >= 0.8::DOUBLE * (x.n + y.n - c)),
    nodes AS (SELECT class_id AS node FROM classes), {reached('nodes', 'links')},
    linked AS (SELECT a, SUM(copies) AS n FROM links GROUP BY a)
    SELECT d.doc_id, COALESCE(k.class_id, d.doc_id) AS copy_id, COALESCE(component, d.doc_id) AS class_id,
        CAST(COALESCE(linked.n, 0) + COALESCE(k.copies - 1, 0) AS BIGINT) AS n_links
    FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN classes k USING (key) LEFT JOIN component ON node = k.class_id LEFT JOIN linked ON linked.a = k.class_id"""

CONTAMINATION = f"""WITH worded AS (SELECT doc_id, {words('text')} AS w FROM documents),
    items AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {words('text')} AS w FROM benchmark WHERE item_id IS NOT NULL),
    windows AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[p : p + least(len(w), 10) - 1], ' ') AS s
        FROM items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(p) WHERE len(w) > 0),
    places AS (SELECT doc_id, k, p, array_to_string(w[p : p + k - 1], ' ') AS s
        FROM worded, (SELECT DISTINCT k FROM windows) AS sizes, unnest(range(1, len(w) - k + 2)) AS t(p)),
    found AS (SELECT doc_id, item_id, p, k FROM places JOIN windows USING (k, s)),
    hit AS (SELECT doc_id, COUNT(DISTINCT x) AS n_hit FROM found, unnest(range(p, p + k)) AS t(x) GROUP BY doc_id),
    named AS (SELECT doc_id, COUNT(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, COALESCE(n_hit, 0) AS n_hit, COALESCE(n_items, 0) AS n_items,
        sha256(COALESCE(ids, '')) AS items_sha256, COALESCE(n_hit, 0) > 0 AS contaminated
    FROM worded LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)"""

REPEATS = """WITH raw AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
    windows AS (SELECT doc_id, p, hash(b[p : p + 49]) AS s FROM raw, unnest(range(1, octet_length(b) - 48)) AS t(p)),
    firsts AS (SELECT s, MIN(doc_id) AS low FROM windows GROUP BY s HAVING MIN(doc_id) < MAX(doc_id)),
    gone AS (SELECT doc_id, p FROM windows JOIN firsts USING (s) WHERE doc_id > low),
    marked AS (SELECT doc_id, p, p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS step FROM gone),
    numbered AS (SELECT doc_id, p, SUM(CASE WHEN step <= 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM marked),
    spans AS (SELECT doc_id, run, MIN(p) AS low, MAX(p) + 49 AS high FROM numbered GROUP BY doc_id, run),
    kept AS (SELECT doc_id, coalesce(lag(high) OVER w, 0) + 1 AS a, low - 1 AS z, high, lead(low) OVER w IS NULL AS last
        FROM spans WINDOW w AS (PARTITION BY doc_id ORDER BY low)),
    pieces AS (SELECT doc_id, a, z FROM kept UNION ALL SELECT doc_id, high + 1, octet_length(b) FROM kept JOIN raw USING (doc_id) WHERE last),
    joined AS (SELECT doc_id, string_agg(CASE WHEN a <= z THEN hex(b[a : z]) ELSE '' END, '' ORDER BY a) AS left_over FROM pieces JOIN raw USING (doc_id) GROUP BY doc_id),
    sums AS (SELECT doc_id, SUM(high - low + 1) AS n_removed, COUNT(*) AS n_spans FROM spans GROUP BY doc_id)
    SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, CAST(COALESCE(n_removed, 0) AS BIGINT) AS n_removed, COALESCE(n_spans, 0) AS n_spans,
        sha256(CASE WHEN left_over IS NULL THEN b ELSE unhex(left_over) END) AS kept_sha256
    FROM raw LEFT JOIN joined USING (doc_id) LEFT JOIN sums USING (doc_id)"""

RUNS = r"""WITH numbered AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
        xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
            lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END)), 4294967295::BIGINT) AS h FROM documents),
    placed AS (SELECT doc_id, w, h, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM numbered),
    stepped AS (SELECT doc_id, w, n, a, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM placed),
    texts AS (SELECT doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) END AS w FROM stepped),
    sixes AS (SELECT doc_id, i, hash(array_to_string(w[i + 1 : i + 6], ' ')) AS s FROM texts, unnest(range(0, n - 5)) AS t(i)),
    pairs AS (SELECT x.doc_id, x.i, y.i - x.i AS d FROM sixes x JOIN sixes y ON x.doc_id = y.doc_id AND x.s = y.s AND x.i < y.i),
    islands AS (SELECT doc_id, d, i, i - row_number() OVER (PARTITION BY doc_id, d ORDER BY i) AS island FROM pairs),
    stretches AS (SELECT doc_id, d, MIN(i) AS start, COUNT(*) + 5 AS shared FROM islands GROUP BY doc_id, d, island),
    runs AS (SELECT doc_id, start, shared + d AS length, MIN(d) AS period FROM stretches WHERE d <= shared AND shared + d >= 12 GROUP BY doc_id, start, shared + d),
    longest AS (SELECT doc_id, start, length, period FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) = 1),
    listed AS (SELECT doc_id, COUNT(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS list FROM runs GROUP BY doc_id),
    gone AS (SELECT DISTINCT doc_id, x FROM runs, unnest(range(start + period, start + length)) AS t(x)),
    words AS (SELECT doc_id, i, w[i + 1] AS word FROM texts, unnest(range(0, n)) AS t(i)),
    kept AS (SELECT words.doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM words LEFT JOIN gone ON gone.doc_id = words.doc_id AND x = i WHERE x IS NULL GROUP BY words.doc_id)
    SELECT texts.doc_id, COALESCE(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
        sha256(COALESCE(list, '')) AS runs_sha256, sha256(COALESCE(kept.text, '')) AS collapsed_sha256
    FROM texts LEFT JOIN listed ON listed.doc_id = texts.doc_id LEFT JOIN longest ON longest.doc_id = texts.doc_id LEFT JOIN kept ON kept.doc_id = texts.doc_id"""

ORACLE_SQL = {
    "op2_suffix_dedup": REPEATS,
    "op4_pivot_near_dedup": VECTORS,
    "op5_jaccard_join": NEAR_DUPLICATES,
    "op6_decontamination": CONTAMINATION,
    "op13_periodic_runs": RUNS,
}
