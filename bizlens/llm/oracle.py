"""DuckDB SQL of the registered queries, over the whole of the same tables.
Where SQL would have to learn or hash what cannot be said in it, there is none."""


def near_duplicates(percent: int, more: str = "") -> str:
    """Documents linked from ``percent`` on, by all pairs that share a shingle."""
    return NEAR.replace("{percent}", str(percent)).replace("{more}", more)


REPEATS = r"""
    WITH
    texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, strlen(coalesce(text, '')) AS n FROM documents),
    strings AS (SELECT doc_id, pos, substr(x, 2 * pos + 1, 100) AS s FROM (SELECT doc_id, x, unnest(range(n - 49)) AS pos FROM texts WHERE n >= 50) t),
    firsts AS (SELECT s, min(doc_id) AS first FROM strings GROUP BY s),
    covered AS (SELECT doc_id, pos FROM strings JOIN firsts USING (s) WHERE first < doc_id),
    spans AS (  -- strings that overlap or touch are one run
        SELECT doc_id, min(pos) AS a, max(pos) + 50 AS b
        FROM (SELECT doc_id, pos, count(*) FILTER (gap) OVER (PARTITION BY doc_id ORDER BY pos) AS run
              FROM (SELECT doc_id, pos, coalesce(pos > lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) + 50, true) AS gap FROM covered) g) r
        GROUP BY doc_id, run),
    kept AS (
        SELECT t.doc_id, n, x, list({'a': a, 'b': b} ORDER BY a) FILTER (a IS NOT NULL) AS s
        FROM texts t LEFT JOIN spans ON spans.doc_id = t.doc_id GROUP BY t.doc_id, n, x)
    SELECT doc_id, n AS n_bytes, CAST(coalesce(list_sum(list_transform(s, lambda v: v.b - v.a)), 0) AS BIGINT) AS n_removed,
           CAST(coalesce(len(s), 0) AS BIGINT) AS n_spans,
           sha256(unhex(if(s IS NULL, x, array_to_string(list_transform(range(1, len(s) + 2), lambda i:
               substr(x, if(i = 1, 0, 2 * s[i - 1].b) + 1, if(i > len(s), 2 * n, 2 * s[i].a) - if(i = 1, 0, 2 * s[i - 1].b))), '')))) AS kept_sha256
    FROM kept"""

NEAR = r"""
    WITH RECURSIVE
    words AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x20\x09-\x0D]+') AS w
        FROM documents),
    sets AS (
        SELECT doc_id, list_distinct(if(len(w) < 5, if(len(w) = 0, [], [array_to_string(w, ' ')]),
                                        list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))) AS s
        FROM words),
    shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
    links AS (
        SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id <> b.doc_id
        GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
    reached AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a)
    SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id{more}
    FROM sets LEFT JOIN (SELECT a, min(b) AS m FROM reached GROUP BY a) f ON f.a = doc_id"""

MANIFEST = r"""
    WITH RECURSIVE
    crc AS (  -- bit by bit over the digits
        SELECT doc_id, xor(list_reduce(
                   list_prepend(4294967295, list_transform(range(1, length(s) + 1), lambda i: CAST(ascii(substr(s, i, 1)) AS BIGINT))),
                   lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
                                            lambda v, k: if(v % 2 = 1, xor(v // 2, 3988292384), v // 2))), 4294967295) AS crc
        FROM (SELECT DISTINCT doc_id, CAST(doc_id AS VARCHAR) AS s FROM documents WHERE doc_id IS NOT NULL) ids),
    leaves AS (
        SELECT doc_id, lang, leaf, tampered, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
               count(*) OVER (PARTITION BY lang) AS n
        FROM (SELECT doc_id, lang, sha256(front || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                     if(crc.crc % 3 = 0, sha256(front || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')), leaf) AS tampered
              FROM (SELECT *, array_to_string(list_transform([CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR)],
                                                             lambda v: coalesce(strlen(v) || ':' || v, '-')), '') AS front
                    FROM documents) d LEFT JOIN crc USING (doc_id)) f),
    nodes AS (
        SELECT lang, 0 AS level, pos, n, leaf AS h FROM leaves
        UNION ALL
        SELECT lang, level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos))
        FROM nodes WHERE n > 1 GROUP BY lang, level, n, pos // 8),
    subroots AS (
        SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
        FROM nodes WHERE n = 1),
    tops AS (
        SELECT 0 AS level, pos, n, subroot AS h FROM subroots
        UNION ALL
        SELECT level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos))
        FROM tops WHERE n > 1 GROUP BY level, n, pos // 8),
    steps AS (  -- per node of a tree and level, what flanks it there
        SELECT a.lang, 0 AS tree, a.level, a.pos,
               {'l': coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), ''),
                'r': coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '')} AS s
        FROM nodes a JOIN nodes b ON a.lang IS NOT DISTINCT FROM b.lang AND a.level = b.level AND a.pos // 8 = b.pos // 8
        WHERE a.n > 1 GROUP BY a.lang, a.level, a.pos
        UNION ALL
        SELECT NULL, 1, a.level, a.pos,
               {'l': coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), ''),
                'r': coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '')}
        FROM tops a JOIN tops b ON a.level = b.level AND a.pos // 8 = b.pos // 8
        WHERE a.n > 1 GROUP BY a.level, a.pos),
    proofs AS (
        SELECT l.doc_id, l.leaf, l.tampered, l.pos, t.subroot, (SELECT h FROM tops WHERE n = 1) AS root,
               coalesce(list(s.s ORDER BY s.tree, s.level) FILTER (s.s IS NOT NULL), []) AS path
        FROM leaves l JOIN subroots t ON l.lang IS NOT DISTINCT FROM t.lang
        LEFT JOIN steps s ON (s.tree = 0 AND s.lang IS NOT DISTINCT FROM l.lang AND s.pos = l.pos // CAST(8 ** s.level AS BIGINT))
                          OR (s.tree = 1 AND s.pos = t.pos // CAST(8 ** s.level AS BIGINT))
        GROUP BY l.doc_id, l.leaf, l.tampered, l.lang, l.pos, t.subroot)
    SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda s: s.l || s.r), '')) AS proof_sha256,
           list_reduce(list_prepend({'l': tampered, 'r': ''}, path),
                       lambda a, s: {'l': sha256(s.l || a.l || s.r), 'r': ''}).l AS folded_root,
           folded_root = root AS verified
    FROM proofs"""

RESAMPLING = r"""
    WITH
    texts AS (
        SELECT 0 AS side, row_number() OVER () AS r, doc_id, text FROM documents
        UNION ALL SELECT 1, row_number() OVER (), NULL, text FROM benchmark),
    words AS (
        SELECT side, r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM texts),
    features AS (
        SELECT side, r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
                                           list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS f
        FROM words),
    table_of_bytes AS (  -- what a crc becomes byte by byte
        SELECT list(list_reduce(list_prepend(b, range(8)), lambda v, k: if(v % 2 = 1, xor(v // 2, 3988292384), v // 2)) ORDER BY b) AS t
        FROM range(256) x(b)),
    codes AS (
        SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, len(x) // 2), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT))),
                                  lambda a, b: xor(a // 256, t[xor(a, b) % 256 + 1])), 4294967295) % 10000 AS bucket
        FROM (SELECT DISTINCT f, hex(encode(f)) AS x FROM features) d, table_of_bytes),
    uses AS (SELECT side, r, bucket, count(*) AS n FROM features JOIN codes USING (f) GROUP BY ALL),
    buckets AS (
        SELECT bucket, coalesce(sum(n) FILTER (side = 0), 0) AS s, coalesce(sum(n) FILTER (side = 1), 0) AS t FROM uses GROUP BY bucket),
    totals AS (SELECT coalesce(sum(s), 0) AS s, coalesce(sum(t), 0) AS t FROM buckets),
    gains AS (
        SELECT bucket, CAST(floor(1000 * ln((CAST(b.t AS DOUBLE) + 1) * (a.s + 10000) / ((CAST(b.s AS DOUBLE) + 1) * (a.t + 10000)))) AS BIGINT) AS gain
        FROM buckets b, totals a),
    weights AS (SELECT r, sum(n) AS n, sum(n * gain) AS weight FROM uses JOIN gains USING (bucket) WHERE side = 0 GROUP BY r),
    scores AS (
        SELECT w.doc_id, len(w.w) AS n_words, CAST(coalesce(x.n, 0) AS BIGINT) AS n_features, CAST(coalesce(x.weight, 0) AS BIGINT) AS weight,
               CAST(coalesce(x.weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || coalesce(CAST(w.doc_id AS VARCHAR), '')), 1, 8) AS BIGINT)
                                                                   + 0.5) / 4294967296.0))) AS BIGINT) AS score
        FROM words w LEFT JOIN weights x ON x.r = w.r WHERE w.side = 0),
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place,
               count(*) FILTER (n_words >= 20) OVER () AS many FROM scores)
    SELECT doc_id, n_features, weight, score, if(n_words >= 20 AND place <= 5 * many // 100, place, NULL) AS rank FROM placed"""

EXACT = """
    WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id = max(doc_id) OVER g AS kept, text_sha256
    FROM d WINDOW g AS (PARTITION BY text_sha256)"""

SQL = {
    "op2_suffix_dedup": REPEATS,
    "op3_minhash": near_duplicates(85, ", doc_id = least(doc_id, coalesce(m, doc_id)) AS kept"),
    "op4_exact_dedup": EXACT,
    "op11_merkle_manifest": MANIFEST,
    "op12_importance_resampling": RESAMPLING,
    "op13_ngram_jaccard_join": near_duplicates(80),
}
