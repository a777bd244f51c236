"""The corpus queries in DuckDB SQL, where SQL can express them.

Without SQL, and compared with brute force in tests/llm: op2 and the pipeline (a tokenizer),
op4 (trained trees), op7 (a parser), op8 (hash bands), op11 (a tokenizer).
"""

from __future__ import annotations

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ITEM_WORDS = (
    f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'),"
    r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
SPACE_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
LOWERED = f"translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')"

OP1 = f"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item, {ITEM_WORDS} AS w FROM benchmark),
placed AS (SELECT item, w, least(len(w), 13) AS n, unnest(range(len(w) - least(len(w), 13) + 1)) AS i
  FROM items WHERE len(w) > 0),
grams AS (SELECT DISTINCT item, n, array_to_string(w[i + 1:i + n], ' ') AS gram FROM placed),
docs AS (SELECT row_number() OVER () AS uid, doc_id, {ITEM_WORDS} AS w FROM documents),
windows AS (SELECT uid, w, n, unnest(range(len(w) - n + 1)) AS i
  FROM docs JOIN (SELECT DISTINCT n FROM grams) ON len(w) >= n),
hits AS (SELECT uid, x.n, i, item
  FROM (SELECT uid, n, i, array_to_string(w[i + 1:i + n], ' ') AS gram FROM windows) x
  JOIN grams g ON x.n = g.n AND x.gram = g.gram),
covered AS (SELECT uid, count(DISTINCT p) AS n_hit FROM (SELECT uid, unnest(range(i, i + n)) AS p FROM hits) GROUP BY uid),
named AS (SELECT uid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY uid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN covered USING (uid) LEFT JOIN named USING (uid)
"""

OP3 = f"""
WITH RECURSIVE docs AS (SELECT doc_id, {SPACE_WORDS.format(LOWERED)} AS w FROM documents),
sets AS (SELECT DISTINCT doc_id, array_to_string(w[i + 1:i + 5], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 4, 1))) AS i FROM docs WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
  FROM sets x JOIN sets y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common c JOIN sizes p ON c.a = p.doc_id JOIN sizes q ON c.b = q.doc_id
  WHERE 100 * c.n >= 80 * (p.n + q.n - c.n)),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least_of AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(b, d.doc_id)) AS component_id
FROM docs d LEFT JOIN sizes USING (doc_id) LEFT JOIN least_of ON d.doc_id = a
"""

_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
OP5 = f"""
WITH docs AS (SELECT row_number() OVER () AS uid, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
placed AS (SELECT uid, doc_id, i, parts[i + 1] AS line,
    translate(trim(parts[i + 1], {_SPACES}), '{UPPER}', '{UPPER.lower()}') AS k
  FROM (SELECT uid, doc_id, parts, unnest(range(len(parts))) AS i FROM docs)),
hot AS (SELECT k FROM placed WHERE k <> '' GROUP BY k HAVING count(DISTINCT uid) >= 10)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(h.k) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (h.k IS NULL), '')) AS kept_sha256
FROM placed p LEFT JOIN hot h ON p.k = h.k GROUP BY uid
"""
OP6 = """
WITH records AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, coalesce(html, '') AS payload,
  sha1(coalesce(html, '')) AS digest FROM pages),
keepers AS (SELECT payload, max(page_id) AS keeper FROM records WHERE n >= 1000 GROUP BY payload)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN keeper IS NOT NULL AND page_id IS DISTINCT FROM keeper THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM keeper THEN keeper END AS refers_to
FROM records LEFT JOIN keepers USING (payload)
"""

# As mixing.py: u from md5, key u ** (1 / quality), whole epochs first, then down the keys.
OP9 = f"""
WITH docs AS (SELECT row_number() OVER () AS uid, doc_id, source, coalesce(text, '') AS t,
    CAST(len({SPACE_WORDS.format("coalesce(text, '')")}) AS BIGINT) AS size FROM documents),
keyed AS (SELECT *, power(
    (CAST(CAST('0x' || substr(md5('17|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(t)), 1, 13) AS BIGINT) AS DOUBLE) + 0.5)
      / 4503599627370496.0::DOUBLE,
    1 / round(0.5 + 1.5 / (1 + abs(length(t) / greatest(size, 1)::DOUBLE - 7) / 4), 6)) AS k FROM docs),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source),
weighted AS (SELECT *, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS w, 3 * source_size AS most FROM sources),
ranked AS (SELECT *, most / w AS ratio, row_number() OVER (ORDER BY most / w, source) AS k, sum(source_size) OVER () AS total, sum(w) OVER () AS all_w,
    coalesce(sum(most) OVER before, 0) AS full_size, coalesce(sum(w) OVER before, 0) AS full_w
  FROM weighted WINDOW before AS (ORDER BY most / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT arg_min((CAST(total AS DOUBLE) - full_size) / (all_w - full_w), k) AS v FROM ranked
  WHERE (CAST(total AS DOUBLE) - full_size) / (all_w - full_w) <= ratio),
targets AS (SELECT source, source_size, least(w * coalesce(v, 0), CAST(most AS DOUBLE)) AS target FROM weighted, level),
plans AS (SELECT *, CASE WHEN source_size > 0 THEN least(3, CAST(floor(target / source_size) AS BIGINT)) ELSE 0 END AS epochs FROM targets),
summed AS (SELECT uid, doc_id, size, source_size, target, epochs, target - epochs * source_size AS rest,
    sum(size) OVER (PARTITION BY x.source ORDER BY k DESC, doc_id DESC NULLS LAST) AS through,
    sum(size) OVER (PARTITION BY x.source, k, doc_id) AS own
  FROM keyed x JOIN plans p ON x.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
  CAST(size * (epochs + CASE WHEN rest > 0 AND through - own / 2 <= rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM summed
"""

OP10 = f"""
WITH docs AS (SELECT row_number() OVER () AS uid, doc_id, source, coalesce(text, '') AS t,
    {SPACE_WORDS.format("coalesce(text, '')")} AS w,
    [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS lines FROM documents),
windows AS (SELECT uid, i, array_to_string(w[i + 1:i + 3], ' ') AS g
  FROM (SELECT uid, w, unnest(range(len(w) - 2)) AS i FROM docs WHERE len(w) > 2)),
twice AS (SELECT uid, i FROM (SELECT uid, i, count(*) OVER (PARTITION BY uid, g) AS n FROM windows) WHERE n > 1),
covered AS (SELECT uid, count(DISTINCT p) AS n FROM (SELECT uid, unnest(range(i, i + 3)) AS p FROM twice) GROUP BY uid),
measured AS (SELECT doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, len(lines) AS n_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM docs LEFT JOIN covered USING (uid)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    n_words > 0 AND (word_chars < 2.0 * n_words OR word_chars > 14.0 * n_words OR 100 * n_symbols > 10 * n_words
      OR 100 * n_dup_lines > 30 * n_lines OR 100 * n_repeat_words > 30 * n_words) AS fine_failed FROM measured),
hosts AS (SELECT source, count(*) AS n, count(*) FILTER (base_failed OR fine_failed) AS bad FROM judged GROUP BY source),
moments AS (SELECT count(*) AS k, CAST(sum(bad) AS DOUBLE) AS f, CAST(sum(n) AS DOUBLE) AS d,
    sum(CAST(bad AS DOUBLE) * bad / n) AS fd, sum(CAST(n AS DOUBLE) * n) AS dd FROM hosts),
shares AS (SELECT f / d AS m, CASE WHEN f > 0 AND f < d AND d - dd / d - (k - 1) > 1e-9
    THEN ((fd - f * f / d) / (f / d * (1 - f / d)) - (k - 1)) / (d - dd / d - (k - 1)) ELSE 0 END AS share FROM moments),
prior AS (SELECT m, CASE WHEN share <= 0 THEN 1e6 ELSE least(greatest(1 / share - 1, 1e-6), 1e6) END AS s FROM shares),
verdicts AS (SELECT source, round((bad + m * s) / (n + s), 9) AS rate FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR rate > 0.9 OR (rate > 0.5 AND fine_failed)) AS kept
FROM judged j JOIN verdicts v ON j.source IS NOT DISTINCT FROM v.source
"""



def _lloyd() -> str:
    """All rounds of op12, one after the other; every number is an integer below 2 ** 53."""
    nearest = """SELECT p.pos, p.uid, any_value(p.x) AS x,
        min(struct_pack(d := list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c), entry := b.entry)) AS best
      FROM parts p JOIN {book} b ON p.pos = b.pos GROUP BY p.pos, p.uid"""
    steps, book = [], "c0"
    for i in range(1, 5):
        steps.append(f"a{i} AS MATERIALIZED ({nearest.format(book=book)})")
        steps.append(
            f"m{i} AS (SELECT pos, entry, list(v ORDER BY i) AS c FROM (SELECT pos, best.entry AS entry, i, floor(sum(x[i]) / count(*)) AS v"
            f" FROM (SELECT pos, best, x, unnest(range(1, len(x) + 1)) AS i FROM a{i}) GROUP BY pos, best.entry, i) GROUP BY pos, entry)"
        )
        steps.append(f"c{i} AS MATERIALIZED (SELECT b.pos, b.entry, coalesce(m.c, b.c) AS c FROM {book} b LEFT JOIN m{i} m ON b.pos = m.pos AND b.entry = m.entry)")
        book = f"c{i}"
    return ",\n".join([*steps, f"a5 AS MATERIALIZED ({nearest.format(book=book)})"])


OP12 = f"""
WITH kept AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS uid, vec_id, label,
    [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings WHERE len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
parts AS MATERIALIZED (SELECT uid, pos, v[pos * len(v) // 4 + 1:(pos + 1) * len(v) // 4] AS x FROM (SELECT uid, v, unnest(range(4)) AS pos FROM kept)),
c0 AS (SELECT pos, uid AS entry, x AS c FROM parts WHERE uid < 256),
{_lloyd()},
coded AS (SELECT uid, string_agg(format('{{:02x}}', best.entry), '' ORDER BY pos) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM a5 GROUP BY uid),
books AS (SELECT sha256(string_agg(CAST(CAST(v AS BIGINT) AS VARCHAR), ',' ORDER BY pos, entry, i)) AS codebooks_sha256
  FROM (SELECT pos, entry, unnest(c) AS v, unnest(range(len(c))) AS i FROM c4))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (uid), books
"""


def _field(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE octet_length(encode(CAST({column} AS VARCHAR))) || ':' || CAST({column} AS VARCHAR) END"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(map(_field, ['doc_id', 'source', 'lang', 'n_chars', text]))})"


#: crc32 of a string of ASCII letters, bit by bit
_CRC32 = (
    "xor(list_reduce(list_prepend(4294967295::UBIGINT, [CAST(ascii(x) AS UBIGINT) FOR x IN string_split(CAST(doc_id AS VARCHAR), '')]),"
    " lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0::UBIGINT FOR b IN range(8)]),"
    " lambda c, bit: xor(c >> 1, (c & 1) * 3988292384::UBIGINT))), 4294967295::UBIGINT)"
)
_SIDES = """SELECT x.tree, x.k, x.i, coalesce(string_agg(y.h, '' ORDER BY y.i) FILTER (y.i < x.i), '') AS l,
    coalesce(string_agg(y.h, '' ORDER BY y.i) FILTER (y.i > x.i), '') AS r
  FROM {0} x JOIN {0} y ON x.tree = y.tree AND x.k = y.k AND x.i // 8 = y.i // 8 WHERE x.n > 1 GROUP BY x.tree, x.k, x.i"""
_ROLL = "SELECT k + 1, tree, i // 8, string_agg(h, '' ORDER BY i), (n + 7) // 8 FROM {0} WHERE n > 1 GROUP BY k, tree, i // 8, n"
OP13 = f"""
WITH RECURSIVE altered AS (SELECT *, coalesce({_CRC32} % 3 = 0, false) AS hit, translate(text, '{UPPER}', '{UPPER.lower()}') AS lowered FROM documents),
leaves AS (SELECT doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, {_leaf("text")} AS leaf,
    CASE WHEN hit AND text IS NOT NULL THEN {_leaf("lowered")} END AS altered_leaf,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, {_leaf("text")}) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM altered),
nodes(k, tree, i, h, n) AS (SELECT 0, tree, i, leaf, n FROM leaves
  UNION ALL SELECT k, tree, i, sha256(h), n FROM ({_ROLL.format("nodes")}) AS x(k, tree, i, h, n)),
subroots AS (SELECT tree, h FROM nodes WHERE n = 1),
tops(k, tree, i, h, n) AS (SELECT 0, 0::BIGINT, tree, h, count(*) OVER () FROM subroots
  UNION ALL SELECT k, tree, i, sha256(h), n FROM ({_ROLL.format("tops")}) AS x(k, tree, i, h, n)),
low AS ({_SIDES.format("nodes")}),
high AS ({_SIDES.format("tops")}),
placed AS (SELECT row_number() OVER () AS uid, * FROM leaves),
steps AS (SELECT uid, s.k, l, r FROM placed p JOIN low s ON p.tree = s.tree AND s.i = p.i // CAST(power(8, s.k) AS BIGINT)
  UNION ALL SELECT uid, 100 + s.k, l, r FROM placed p JOIN high s ON s.i = p.tree // CAST(power(8, s.k) AS BIGINT)),
proofs AS (SELECT uid, string_agg(l || r, '' ORDER BY k) AS siblings, list(l || '#' || r ORDER BY k) AS path FROM steps GROUP BY uid),
folded AS (SELECT p.*, coalesce(siblings, '') AS siblings, list_reduce(list_prepend(coalesce(altered_leaf, leaf), coalesce(path, [])),
    lambda h, s: sha256(split_part(s, '#', 1) || h || split_part(s, '#', 2))) AS folded_root
  FROM placed p LEFT JOIN proofs USING (uid))
SELECT doc_id, leaf, s.h AS subroot, t.h AS root, sha256(siblings) AS proof_sha256, folded_root, folded_root = t.h AS verified
FROM folded f JOIN subroots s ON f.tree = s.tree, (SELECT h FROM tops WHERE n = 1) t
"""

ORACLES = {
    "op1_decontaminate": OP1,
    "op3_jaccard_join": OP3,
    "op5_line_dedup": OP5,
    "op6_warc": OP6,
    "op9_mix_sources": OP9,
    "op10_quality_rules": OP10,
    "op12_vector_codes": OP12,
    "op13_merkle_manifest": OP13,
}
