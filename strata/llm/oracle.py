"""SQL twins (DuckDB) of the text operators' queries."""

from __future__ import annotations

from strata.llm import quality, secrets, urls

ASCII_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINE_DEDUP = f"""
WITH split AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lines AS (
    SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM split
), keyed AS (
    SELECT *, {ASCII_LOWER.format(f"trim(line, {BLANKS})")} AS key FROM lines
), repeated AS (
    SELECT key, max(doc_id) AS kept FROM keyed WHERE length(key) >= 40
    GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
    SELECT k.doc_id, k.pos, k.line, r.kept IS NOT NULL AND r.kept <> k.doc_id AS dropped
    FROM keyed k LEFT JOIN repeated r ON k.key = r.key
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE dropped)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE worded AS MATERIALIZED (
    SELECT doc_id, regexp_extract_all({ASCII_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), sets AS MATERIALIZED (
    SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []
        WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE [array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)] END) AS s
    FROM worded
), classes AS MATERIALIZED (
    SELECT min(doc_id) AS node, len(s) AS n, s FROM (SELECT doc_id, list_sort(s) AS s FROM sets WHERE len(s) > 0) GROUP BY s
), items AS MATERIALIZED (
    SELECT node, n, unnest(s) AS item FROM classes
), links AS MATERIALIZED (
    SELECT x.node AS a, y.node AS b FROM items x JOIN items y ON x.item = y.item AND x.node <> y.node
    GROUP BY x.node, y.node, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
), reached AS (
    SELECT node AS a, node AS b FROM classes
    UNION
    SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
), labels AS (
    SELECT a AS node, min(b) AS component_id FROM reached GROUP BY a
), members AS (
    SELECT s.doc_id, l.component_id FROM sets s JOIN classes c ON list_sort(s.s) = c.s JOIN labels l ON l.node = c.node
)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, coalesce(m.component_id, s.doc_id) AS component_id,
       coalesce(m.component_id, s.doc_id) = s.doc_id AS kept
FROM sets s LEFT JOIN members m ON s.doc_id = m.doc_id
"""


def _term(term: str) -> str:
    return f"regexp_matches(lower_url, '(^|[^a-z0-9]){term}([^a-z0-9]|$)')::INTEGER"


URL_FILTER = f"""
WITH split AS (
    SELECT page_id, {ASCII_LOWER.format("coalesce(url, '')")} AS lower_url,
           CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), parts AS (
    SELECT page_id, lower_url, {ASCII_LOWER.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
           regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
    FROM split
), ruled AS (
    SELECT *,
        CASE WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
             WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
             WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
             WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
             WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule,
        {" + ".join(_term(t) for t, w in urls.VOCABULARY.items() if w >= urls.THRESHOLD)} AS n_strict,
        {" + ".join(_term(t) for t, w in urls.VOCABULARY.items() if w < urls.THRESHOLD)} AS n_soft
    FROM parts
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN n_strict > 0 OR n_soft >= {urls.THRESHOLD} THEN 'block' ELSE 'allow' END AS verdict,
       n_strict::BIGINT AS n_strict, n_soft::BIGINT AS n_soft
FROM ruled
"""


def _secret_spans(kind: str, pattern: str) -> str:
    """Spans of a pattern, from the pieces between its matches."""
    quoted = pattern.replace("'", "''")
    rank = secrets.KINDS.index(kind)
    return f"""
    SELECT doc_id, {rank} AS rank, '{kind}' AS kind, value, first - length(value) AS first, first AS last FROM (
        SELECT doc_id, m AS value,
               sum(length(piece) + length(m)) OVER (PARTITION BY doc_id ORDER BY k) AS first
        FROM (
            SELECT doc_id, unnest(ms) AS m, unnest(ps[:len(ms)]) AS piece, generate_subscripts(ms, 1) AS k
            FROM (SELECT doc_id, regexp_extract_all(text, '{quoted}') AS ms, regexp_split_to_array(text, '{quoted}') AS ps FROM docs)
        )
    )"""


_SETTINGS = secrets.SecretSettings()
_ASSIGN = secrets.ASSIGN.replace("'", "''")
_BASE = secrets.BASE.replace("'", "''")

SECRETS = f"""
WITH docs AS MATERIALIZED (
    SELECT doc_id, coalesce(text, '') AS text FROM documents
), base AS MATERIALIZED (
    SELECT * FROM ({_secret_spans("assign", secrets.ASSIGN)})
    WHERE length(regexp_extract(value, '{_ASSIGN}', 2)) >= {secrets.LEAST_VALUE}
    UNION ALL {_secret_spans("access", secrets.ACCESS)}
    UNION ALL {_secret_spans("hex", secrets.HEX)}
), samples AS (
    SELECT true AS is_random, CASE WHEN kind = 'assign' THEN regexp_extract(value, '{_ASSIGN}', 2) ELSE value END AS token FROM base
    UNION ALL SELECT false, unnest(list_filter(regexp_extract_all(regexp_replace(text, '{_BASE}', ' ', 'g'), '{secrets.IDENTIFIER}'), lambda t: length(t) <= {secrets.LONGEST_LEARNED})) FROM docs
), pairs AS MATERIALIZED (
    SELECT is_random, pair[1] AS a, pair[2] AS b, count(*) AS n
    FROM (SELECT is_random, unnest([substr(' ' || token, i, 2) FOR i IN range(1, length(token) + 1)]) AS pair FROM samples)
    GROUP BY ALL
), befores AS MATERIALIZED (
    SELECT is_random, a, sum(n) AS n FROM pairs GROUP BY ALL
), tokens AS MATERIALIZED (
    SELECT * FROM ({_secret_spans("random", secrets.TOKEN)})
), free AS (
    SELECT * FROM tokens t WHERE NOT EXISTS (
        SELECT 1 FROM base b WHERE b.doc_id = t.doc_id AND b.first < t.last AND b.last > t.first)
), steps AS (
    SELECT doc_id, first, unnest([substr(' ' || value, i, 2) FOR i IN range(1, length(value) + 1)]) AS pair FROM free
), scored AS (
    SELECT s.doc_id, s.first, sum(round(1000 * ln(
        ((coalesce(r.n, 0) + {_SETTINGS.smoothing}) / (coalesce(rb.n, 0) + {_SETTINGS.smoothing * _SETTINGS.symbols}))
        / ((coalesce(o.n, 0) + {_SETTINGS.smoothing}) / (coalesce(ob.n, 0) + {_SETTINGS.smoothing * _SETTINGS.symbols}))))) AS ratio
    FROM steps s
    LEFT JOIN pairs r ON r.is_random AND r.a = s.pair[1] AND r.b = s.pair[2]
    LEFT JOIN pairs o ON NOT o.is_random AND o.a = s.pair[1] AND o.b = s.pair[2]
    LEFT JOIN befores rb ON rb.is_random AND rb.a = s.pair[1]
    LEFT JOIN befores ob ON NOT ob.is_random AND ob.a = s.pair[1]
    GROUP BY s.doc_id, s.first
), spans AS (
    SELECT doc_id, rank, kind, first, last FROM base
    UNION ALL
    SELECT f.doc_id, f.rank, f.kind, f.first, f.last FROM free f JOIN scored s ON s.doc_id = f.doc_id AND s.first = f.first
    WHERE s.ratio >= {_SETTINGS.least_ratio} AND (SELECT count(DISTINCT is_random) FROM pairs) = 2
)
SELECT d.doc_id,
       count(*) FILTER (WHERE kind = 'assign') AS n_assign,
       count(*) FILTER (WHERE kind = 'access') AS n_access,
       count(*) FILTER (WHERE kind = 'hex') AS n_hex,
       sha256(coalesce(string_agg(kind || ':' || first::BIGINT || ':' || last::BIGINT, ',' ORDER BY first, rank) FILTER (WHERE kind <> 'random'), '')) AS base_sha256,
       coalesce(string_agg(kind || ':' || first::BIGINT || ':' || last::BIGINT, ',' ORDER BY first, rank), '') AS spans
FROM docs d LEFT JOIN spans s ON s.doc_id = d.doc_id GROUP BY d.doc_id
"""

_Q = quality.QualitySettings()


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


QUALITY = f"""
WITH docs AS MATERIALIZED (
    SELECT doc_id, coalesce(text, '') AS text FROM documents
), worded AS MATERIALIZED (
    SELECT doc_id, text, regexp_extract_all(text, {_quoted(quality.WORDS)}) AS w FROM docs
), windows AS (
    SELECT doc_id, unnest([w[i:i + 2] FOR i IN range(1, len(w) - 1)]) AS g, unnest(range(1, len(w) - 1)) AS i FROM worded WHERE len(w) >= 3
), twice AS (
    SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows) WHERE n > 1
), covered AS (
    SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id
), lines AS MATERIALIZED (
    SELECT doc_id, line, len(regexp_extract_all(line, {_quoted(quality.WORDS)})) AS n,
           length(line) - length(regexp_replace(line, {_quoted(quality.MARKS)}, '', 'g')) AS marks,
           length(line) - length(regexp_replace(line, {_quoted(quality.BARS)}, '', 'g')) AS bars
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs)
    WHERE regexp_matches(line, {_quoted(quality.WORDS)})
), judged AS (
    SELECT *, marks > length(line) * {_Q.most_marks}
        OR (n >= {_Q.least_words} AND NOT regexp_matches(line, {_quoted(quality.END_MARK)}) AND NOT regexp_matches(line, {_quoted(quality.HEADING)}))
        OR (n <= {_Q.menu_words} AND regexp_matches(line, {_quoted(quality.NAVIGATION)}))
        OR (bars >= 2 AND bars * {_Q.words_a_bar} >= n)
        OR regexp_matches(line, {_quoted(quality.BOILERPLATE)}) AS fails
    FROM lines
), by_doc AS (
    SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines,
           coalesce(sum(length(regexp_replace(line, '[\\x20\\x09-\\x0D]+', '', 'g'))) FILTER (WHERE NOT fails), 0) AS left_chars
    FROM judged GROUP BY doc_id
), counted AS (
    SELECT w.doc_id, len(w.w)::BIGINT AS n_words, length(array_to_string(w.w, ''))::BIGINT AS word_chars,
           (length(w.text) - length(regexp_replace(w.text, {_quoted(quality.SYMBOLS)}, '', 'g')))::BIGINT AS n_symbols,
           coalesce(b.n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(c.n_repeat_words, 0)::BIGINT AS n_repeat_words,
           coalesce(b.left_chars, 0) AS left_chars
    FROM worded w LEFT JOIN by_doc b ON b.doc_id = w.doc_id LEFT JOIN covered c ON c.doc_id = w.doc_id
), failed AS (
    SELECT *, n_words < {_Q.fewest_words} OR 100 * n_repeat_words > {_Q.most_repeated} * n_words AS base_failed,
           CASE WHEN word_chars > 0 THEN 1 - left_chars::DOUBLE / word_chars ELSE 0 END AS lost
    FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND lost <= {_Q.most_lost} AS kept
FROM failed
"""

# CRC-32 in SQL: the 256 entries by their rule (eight halvings with the reversed polynomial), then a fold over bytes.
CRC_TABLE = """
crc_table AS MATERIALIZED (
    SELECT list(entry ORDER BY b) AS entries FROM (
        SELECT b, list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) AS entry
        FROM (SELECT unnest(range(256)) AS b)
    )
)"""


def _crc32(bytes_list: str) -> str:
    """Unsigned CRC-32 of a list of byte values (BIGINT); ``crc_table`` must be in FROM."""
    step = "lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce({bytes_list}, {step}, 4294967295::BIGINT), 4294967295)"


def _bytes(text: str) -> str:
    digits = f"hex(encode({text}))"
    return f"[('0x' || {digits}[2 * i - 1:2 * i])::BIGINT FOR i IN range(1, len({digits}) // 2 + 1)]"


IMPORTANCE = f"""
WITH {CRC_TABLE}, words AS MATERIALIZED (
    SELECT 0 AS target, doc_id AS id, unnest(regexp_extract_all({ASCII_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w
    FROM documents
    UNION ALL
    SELECT 1, item_id, unnest(regexp_extract_all({ASCII_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'))
    FROM benchmark
), different AS MATERIALIZED (
    SELECT w, {_bytes("w")} AS b FROM (SELECT DISTINCT w FROM words)
), hashed AS MATERIALIZED (
    SELECT w, {_crc32("b")} % 10000 AS bucket FROM different, crc_table
), counted AS MATERIALIZED (
    SELECT bucket, count(*) FILTER (WHERE target = 0) AS s, count(*) FILTER (WHERE target = 1) AS t
    FROM words JOIN hashed USING (w) GROUP BY bucket
), totals AS (
    SELECT coalesce(sum(s), 0)::DOUBLE AS all_s, coalesce(sum(t), 0)::DOUBLE AS all_t FROM counted
), gains AS MATERIALIZED (
    SELECT bucket, floor(1000 * ln((t + 1.0::DOUBLE) * (all_s + 10000) / ((s + 1.0::DOUBLE) * (all_t + 10000))))::BIGINT AS gain
    FROM counted, totals
), weights AS (
    SELECT id AS doc_id, count(*)::BIGINT AS n, sum(gain)::BIGINT AS weight
    FROM words JOIN hashed USING (w) JOIN gains USING (bucket) WHERE target = 0 GROUP BY id
), scored AS MATERIALIZED (
    SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
    FROM documents LEFT JOIN weights USING (doc_id)
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
           count(*) OVER (PARTITION BY n_features >= 20) AS eligible
    FROM scored
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= 20 AND place <= 10 * eligible // 100 THEN place END AS rank
FROM placed
"""


def _value(column: str) -> str:
    text = f"CAST({column} AS VARCHAR)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _merkle(tree: str, levels: int) -> str:
    """CTEs of a forest from ``{tree}0`` (k, i, h): its levels, each node with its siblings left and right."""
    parts = []
    for level in range(levels):
        below = f"{tree}{level}"
        parts.append(
            f"""{below}s AS MATERIALIZED (
    SELECT x.k, x.i, x.h, max(x.n) AS n, coalesce(string_agg(y.h, '' ORDER BY y.i) FILTER (WHERE y.i < x.i), '') AS l,
           coalesce(string_agg(y.h, '' ORDER BY y.i) FILTER (WHERE y.i > x.i), '') AS r
    FROM (SELECT *, count(*) OVER (PARTITION BY k) AS n FROM {below}) x
    JOIN {below} y ON x.k IS NOT DISTINCT FROM y.k AND x.i // 16 = y.i // 16
    GROUP BY x.k, x.i, x.h
), {tree}{level + 1} AS MATERIALIZED (
    SELECT k, i // 16 AS i, CASE WHEN max(n) = 1 THEN max(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h
    FROM {below}s GROUP BY k, i // 16
)"""
        )
    return ", ".join(parts)


# Levels of the SQL twin: keys of up to 16 ** 5 rows, up to 16 ** 3 keys.
LEAF_LEVELS, KEY_LEVELS = 5, 3


def _manifest() -> str:
    tampered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    others = "||".join(_value(c) for c in ("doc_id", "source", "lang", "n_chars"))
    joins, proof, folded = "", [], "changed"
    for tree, levels, key, place in (("a", LEAF_LEVELS, "d.source", "d.i"), ("b", KEY_LEVELS, "0", "d.key_place")):
        for level in range(levels):
            s = f"{tree}{level}s"
            joins += f"\nJOIN {s} ON {s}.k IS NOT DISTINCT FROM {key} AND {s}.i = {place} // {16**level}"
            proof.append(f"CASE WHEN {s}.n > 1 THEN {s}.l || {s}.r ELSE '' END")
            folded = f"CASE WHEN {s}.n > 1 THEN sha256({s}.l || {folded} || {s}.r) ELSE {folded} END"
    return f"""
WITH {CRC_TABLE}, leaves AS MATERIALIZED (
    SELECT doc_id, source, sha256({others} || {_value("text")}) AS leaf,
           CASE WHEN {_crc32(_bytes("CAST(doc_id AS VARCHAR)"))} % 5 = 0 THEN sha256({others} || {_value(tampered)}) END AS tampered,
           row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS i
    FROM documents, crc_table
), a0 AS (SELECT source AS k, i, leaf AS h FROM leaves), {_merkle("a", LEAF_LEVELS)},
keys AS MATERIALIZED (
    SELECT k AS source, h AS subroot, row_number() OVER (ORDER BY encode(k) NULLS FIRST) - 1 AS key_place FROM a{LEAF_LEVELS}
), b0 AS (SELECT 0 AS k, key_place AS i, subroot AS h FROM keys), {_merkle("b", KEY_LEVELS)},
d AS (
    SELECT leaves.*, subroot, key_place, coalesce(tampered, leaf) AS changed
    FROM leaves JOIN keys ON leaves.source IS NOT DISTINCT FROM keys.source
), folded AS (
    SELECT doc_id, leaf, subroot, b{KEY_LEVELS}.h AS root, sha256({" || ".join(proof)}) AS proof_sha256, {folded} AS folded_root
    FROM d {joins}
    JOIN b{KEY_LEVELS} ON true
)
SELECT *, folded_root = root AS verified FROM folded
"""


MANIFEST = _manifest()
