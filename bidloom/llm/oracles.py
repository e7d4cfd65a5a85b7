"""DuckDB SQL of the registered queries."""

from __future__ import annotations

from bidloom.llm import licenses, secrets

# The table of the half-byte CRC-32 is built from its polynomial; the text is folded nibble by nibble, low one first.
_CRC_TABLE = """steps(i, bit, c) AS (
  SELECT range, 0, range FROM range(16)
  UNION ALL
  SELECT i, bit + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE bit < 4
), crc_table AS (SELECT list(c ORDER BY i) AS entries FROM steps WHERE bit = 4)"""


def _crc(text: str) -> str:
    """CRC-32 of a text's UTF-8; `entries` is that of crc_table."""
    return f"""xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(
      CASE WHEN {text} = '' THEN [] ELSE string_split(regexp_replace(hex(encode({text})), '(.)(.)', '\\2\\1', 'g'), '') END,
      lambda d: CAST('0x' || d AS BIGINT))),
    lambda crc, n: xor(crc >> 4, entries[(xor(crc, n) & 15) + 1])))"""


RENDEZVOUS_SHARDS = f"""
WITH RECURSIVE {_CRC_TABLE},
docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, coalesce(CAST(doc_id AS VARCHAR), 'null') AS key
  FROM documents
), crc AS (
  SELECT r, {_crc('text')} AS text_crc32
  FROM docs, crc_table
), scores AS (
  SELECT r, shard, ln((CAST('0x' || substr(md5(key || '#' || shard), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0) AS score
  FROM docs, (SELECT CAST(range AS INTEGER) AS shard FROM range(41))
), chosen AS (
  SELECT r, arg_max(shard, (score, -shard)) FILTER (shard < 40) AS shard, arg_max(shard, (score, -shard)) AS grown_shard
  FROM scores GROUP BY r
)
SELECT doc_id, CAST(strlen(text) + 16 AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY md5(key), doc_id NULLS FIRST, strlen(text), text_crc32) - 1 AS slot,
       grown_shard
FROM docs JOIN crc USING (r) JOIN chosen USING (r)
"""

WARC_ROUND_TRIP = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex, strlen(coalesce(html, '')) AS n FROM pages
), g AS (SELECT *, max(page_id) OVER (PARTITION BY hex, n) AS newest FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 +
         ((CAST('0x' || substr(hex, CAST(1 + 10 * (i // 8) AS INTEGER), 10) AS BIGINT) >> CAST(35 - 5 * (i % 8) AS INTEGER)) & 31)
         AS INTEGER), 1)), '') AS payload_digest,
       CASE WHEN page_id < newest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < newest THEN newest END AS refers_to,
       CAST(CASE WHEN page_id < newest THEN 1 ELSE greatest(1, ceil(length(html) / 8192.0)) END AS INTEGER) AS chunks
FROM g
"""


def _tree(depth: int) -> str:
    """One level of the splitting tree: the tickets of every node are ranked and cut."""
    return f"""
t{depth + 1} AS (
  SELECT source, ticket, CASE WHEN goes_left THEN first ELSE first + width // 2 END AS first,
         CASE WHEN goes_left THEN width // 2 ELSE width - width // 2 END AS width
  FROM (SELECT *, row_number() OVER (PARTITION BY first ORDER BY md5('mix#{depth}#' || coalesce(source, 'null') || '#' || ticket),
                                     source NULLS FIRST, ticket)
                  <= floor(count(*) OVER (PARTITION BY first) * (width // 2) / width) AS goes_left FROM t{depth})
),"""


MIX_SOURCES = f"""
WITH RECURSIVE items AS (
  SELECT source, doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size, count(*) AS repeats,
         row_number() OVER () AS item,
         md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || '#' || coalesce(source, 'null') || '#' || coalesce(text, 'null')) AS row_md5
  FROM documents GROUP BY source, doc_id, text
), per_source AS (
  SELECT source, CAST(sum(size * repeats) AS BIGINT) AS source_size, count(*) AS documents FROM items GROUP BY source
), weighed AS (
  SELECT *, CAST([5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS DOUBLE) AS weight
  FROM per_source
), leveled AS (
  SELECT *, source_size / weight AS mark, source_size * 2.0 AS most,
         (sum(source_size) OVER () * 1.5 - coalesce(sum(source_size * 2.0) OVER earlier, 0.0))
         / (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0.0)) AS level
  FROM weighed
  WINDOW earlier AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size, documents,
         least(most, coalesce((SELECT arg_min(level, mark) FROM leveled WHERE level * weight <= most), 'infinity'::DOUBLE) * weight) AS target
  FROM leveled
), states AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS passes,
         target - (CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END) * source_size AS part,
         greatest(CAST(ceil(documents / 256.0) AS BIGINT), 1) AS blocks
  FROM targets
), placed AS (
  SELECT i.*, s.* EXCLUDE (source), md5('mix#' || coalesce(CAST(doc_id AS VARCHAR), 'null') || '#' || size || '#' || row_md5) AS ord,
         CAST('0x' || substr(md5('mix#' || coalesce(CAST(doc_id AS VARCHAR), 'null') || '#' || size || '#' || row_md5), 1, 13) AS BIGINT)
         % blocks AS block
  FROM items i JOIN states s ON i.source IS NOT DISTINCT FROM s.source
), sums AS (
  SELECT source, block, any_value(part) AS part, sum(size * repeats) AS words,
         coalesce(sum(sum(size * repeats)) OVER (PARTITION BY source ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM placed GROUP BY source, block
), last AS (
  SELECT source, min(block) AS last_block, arg_min(before, block) AS last_before
  FROM sums WHERE before < part AND before + words >= part GROUP BY source
), edges AS (
  SELECT s.*, coalesce(last_block, -1) AS last_block, part - coalesce(last_before, 0) AS room
  FROM states s LEFT JOIN last l ON s.source IS NOT DISTINCT FROM l.source
), t0 AS (
  SELECT source, unnest(range(1, passes * blocks + last_block + 2)) AS ticket, 0 AS first, 8 AS width FROM edges
),{_tree(0)}{_tree(1)}{_tree(2)}
counts AS (SELECT source, first AS shard, count(*) AS n FROM t3 GROUP BY source, first),
starts AS (
  SELECT source, list(shard ORDER BY shard) AS shards, list(start ORDER BY shard) AS starts FROM (
    SELECT *, coalesce(sum(n) OVER (PARTITION BY source ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
    FROM counts) GROUP BY source
), queue AS (
  SELECT p.source, item, size, repeats, room, row_number() OVER (PARTITION BY p.source ORDER BY ord, doc_id) AS n
  FROM placed p JOIN edges e ON p.source IS NOT DISTINCT FROM e.source AND p.block = e.last_block
), filled(source, n, item, room, got) AS (
  SELECT source, CAST(0 AS BIGINT), CAST(-1 AS BIGINT), room, CAST(0 AS BIGINT) FROM queue WHERE n = 1
  UNION ALL
  SELECT q.source, q.n, q.item,
         f.room - q.size * CASE WHEN q.size = 0 THEN q.repeats ELSE least(q.repeats, CAST(floor(f.room / q.size) AS BIGINT)) END,
         CASE WHEN q.size = 0 THEN q.repeats ELSE least(q.repeats, CAST(floor(f.room / q.size) AS BIGINT)) END
  FROM filled f JOIN queue q ON q.source IS NOT DISTINCT FROM f.source AND q.n = f.n + 1
), drawn AS (
  SELECT p.source, p.doc_id, p.size, p.source_size, p.target, p.blocks, p.block, p.passes + CASE WHEN p.block < e.last_block THEN 1
         WHEN p.block = e.last_block AND u.r <= f.got THEN 1 ELSE 0 END AS draws
  FROM placed p JOIN edges e ON p.source IS NOT DISTINCT FROM e.source
  LEFT JOIN filled f ON f.item = p.item, LATERAL (SELECT unnest(range(1, p.repeats + 1)) AS r) u
)
SELECT doc_id, size, source_size, target, CAST(size * draws AS BIGINT) AS taken,
       coalesce(array_to_string(list_transform(range(draws), lambda k:
         shards[len(list_filter(starts, lambda s: s <= k * blocks + block))]), ','), '') AS shards
FROM drawn d LEFT JOIN starts s ON d.source IS NOT DISTINCT FROM s.source
"""


def _words(text: str) -> str:
    return "[" + ", ".join(f"'{w}'" for w in licenses.split_words(text)) + "]"


_TEMPLATES = ", ".join(
    f"({i}, '{t.label}', {str(t.exact).lower()}, {_words(t.text)})" for i, t in enumerate(licenses.TEMPLATES))

LICENSE_SCAN = f"""
WITH templates(template, label, exact, words) AS (VALUES {_TEMPLATES}),
docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{licenses.UPPER}', '{licenses.LOWER}'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM documents
), blocks AS (
  SELECT r, words[k * {licenses.STEP} + 1 : k * {licenses.STEP} + {licenses.BLOCK}] AS words
  FROM (SELECT r, words, unnest(range((len(words) - 1) // {licenses.STEP} + 1)) AS k FROM docs WHERE len(words) > 0)
), alike AS (
  SELECT r, label, len(list_intersect(list_distinct(b.words), list_distinct(t.words))) / len(list_distinct(t.words)) AS score
  FROM blocks b, templates t WHERE NOT exact
), places AS (
  SELECT r, label, i FROM (
    SELECT r, label, t.words AS phrase, d.words, unnest(range(1, len(d.words) - len(t.words) + 2)) AS i
    FROM docs d, templates t WHERE exact AND list_has_all(d.words, t.words)
  ) WHERE words[i : i + len(phrase) - 1] = phrase
), found AS (
  SELECT r, label, score, NULL AS place FROM alike WHERE score >= {licenses.THRESHOLD}
  UNION ALL SELECT r, label, 1.0, i - 1 FROM places
)
SELECT doc_id, CAST(len(any_value(words)) AS BIGINT) AS n_words, count(place) AS n_base,
       CAST(min(place) AS BIGINT) AS first_word, CAST(max(place) AS BIGINT) AS last_word,
       coalesce(string_agg(DISTINCT CASE WHEN place IS NOT NULL THEN label END, ',' ORDER BY CASE WHEN place IS NOT NULL THEN label END), '') AS base_labels,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels,
       CAST(coalesce(max(score), 0.0) AS DOUBLE) AS score
FROM docs LEFT JOIN found USING (r) GROUP BY r, doc_id
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _located(kind: str, rank: int, pattern: str) -> str:
    """Matches of a pattern with their positions, from the lengths of the pieces between them."""
    return f"""
  SELECT r, '{kind}' AS kind, {rank} AS rank, found[i] AS value,
         list_sum(list_transform(pieces[1:i], lambda p: length(p))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda f: length(f))), 0) AS start
  FROM (SELECT r, found, string_split_regex(text, {_quoted(pattern)}) AS pieces, unnest(range(1, len(found) + 1)) AS i
        FROM (SELECT *, regexp_extract_all(text, {_quoted(pattern)}) AS found FROM docs) WHERE len(found) > 0)"""


_HARMLESS = " OR ".join(
    f"regexp_matches(value, {_quoted(p)})" for p in secrets.ALLOWED if "\\1" not in p) + (
    " OR length(replace(lower(value), lower(value[1]), '')) = 0")
_CLASSES = " ".join(
    f"WHEN regexp_matches(value, {_quoted(shape)}) THEN CASE WHEN entropy >= {least} THEN '{name}' END"
    for name, shape, least in secrets.CLASSES)
_RANKS = " ".join(f"WHEN '{c[0]}' THEN {i + 3}" for i, c in enumerate(secrets.CLASSES))
_BITS = f"""list_max(list_transform(range(1, length(value) - {secrets.WINDOW - 2}), lambda i:
    list_sum(list_transform(map_values(list_histogram(string_split(substr(value, CAST(i AS INTEGER), {secrets.WINDOW}), ''))),
      lambda c: -(c / {secrets.WINDOW}.0) * log2(c / {secrets.WINDOW}.0)))))"""

SECRET_SCAN = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
base AS ({_located("assign", 0, secrets.ASSIGN)}
  UNION ALL {_located("access", 1, secrets.ACCESS)}
  UNION ALL {_located("hex", 2, secrets.HEX)}
), kept AS (
  SELECT r, kind, rank, start, start + length(value) AS stop FROM base
  WHERE kind <> 'assign' OR length(regexp_extract(value, {_quoted(secrets.ASSIGN)}, 2)) >= {secrets.ASSIGN_LEAST}
), measured AS (
  SELECT *, {_BITS} AS entropy FROM ({_located("candidate", 9, secrets.CANDIDATE)})
), classed AS (
  SELECT r, start, start + length(value) AS stop, CASE WHEN {_HARMLESS} THEN NULL {_CLASSES} END AS kind FROM measured
), every AS (
  SELECT *, true AS base FROM kept
  UNION ALL SELECT r, kind, CASE kind {_RANKS} END, start, stop, false FROM classed WHERE kind IS NOT NULL
), joined AS (
  SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY start, rank) FILTER (base) AS base,
         string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY start, rank) AS spans
  FROM every GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN joined USING (r)
"""


def _best(*states: str) -> str:
    """The smallest (cost, edits); structs compare field by field."""
    return f"list_min([{', '.join(states)}])"


def _edit(state: str, cost: str, edit: str) -> str:
    return f"{{'c': CAST({state}.c + {cost} AS BIGINT), 'a': {state}.a || '{edit}'}}"


_STAY = "(CASE WHEN r.go THEN 1000000000 WHEN r.cut THEN 5 ELSE 0 END)"


def _kept(state: str, role: str) -> str:
    return _edit(state, f"{_STAY} + (CASE WHEN r.initial = '{role}' THEN 0 ELSE 1000000000 END)", "K")


def _reroled(state: str) -> str:
    return _edit(state, f"{_STAY} + 1", "R")


# States of the grammar: v0 empty, v1 after s, v2 after u, v3 after a; a state that cannot be has a huge cost.
_INSERTED = f"""
  SELECT conv, i, v0, v1, v2, {_best("v3", _edit("v2", "5", "I"))} AS v3
  FROM (SELECT conv, i, v0, v1, {_best("v2", _edit("v0", "5", "I"), _edit("v1", "5", "I"), _edit("v3", "5", "I"))} AS v2, v3
        FROM (%s))"""
_START = """SELECT conv, 0 AS i, {'c': CAST(0 AS BIGINT), 'a': ''} AS v0, {'c': CAST(1000000000 AS BIGINT), 'a': ''} AS v1,
  {'c': CAST(1000000000 AS BIGINT), 'a': ''} AS v2, {'c': CAST(1000000000 AS BIGINT), 'a': ''} AS v3 FROM convs"""
_STEP = f"""SELECT conv, i + 1 AS i, {_edit("v0", "2", "D")} AS v0,
  {_best(_edit("v1", "2", "D"), _kept("v0", "s"))} AS v1,
  {_best(_edit("v2", "2", "D"), *(_kept(v, "u") for v in ("v0", "v1", "v3")), *(map(_reroled, ("v0", "v1", "v3"))))} AS v2,
  {_best(_edit("v3", "2", "D"), _kept("v2", "a"), _reroled("v2"))} AS v3
  FROM (SELECT dp.*, g.rows[dp.i + 1] AS r FROM dp JOIN grouped g USING (conv) WHERE dp.i < g.n)"""

REPAIR_CONVERSATIONS = f"""
WITH RECURSIVE {_CRC_TABLE},
given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), 'null') AS conv,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
  FROM conversations
), hit AS (SELECT given.*, {_crc('key')} % 20 AS kind FROM given, crc_table),
convs AS (SELECT conv, any_value(conv_id) AS conv_id FROM given GROUP BY conv),
copies AS (
  SELECT conv, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM hit WHERE kind <> 0
), numbered AS (
  SELECT conv, turn, role, text, substr(role, 1, 1) AS initial,
         row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text) AS i,
         regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last
  FROM copies
), met AS (SELECT *, i > min(i) OVER (PARTITION BY conv, role, text) AS seen FROM numbered),
faults AS (
  SELECT *, last = '' AS blank, last <> '' AND seen AS dup, last NOT IN ('', '.', '!', '?') AND NOT seen AS cut,
         lag(initial) OVER (PARTITION BY conv ORDER BY i) || initial AS pair
  FROM met
), grouped AS (
  SELECT conv, count(*) AS n, list({{'initial': initial, 'go': blank OR dup, 'cut': cut}} ORDER BY i) AS rows,
         coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (dup) AS dup, count(*) FILTER (cut) AS cut,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv
), dp AS (
  {_INSERTED % _START}
  UNION ALL
  {_INSERTED % _STEP}
), best AS (
  SELECT dp.conv, {_best("v0", "v3")} AS b FROM dp LEFT JOIN grouped g USING (conv) WHERE dp.i = coalesce(g.n, 0)
), edits AS (
  SELECT conv, b.a AS audit, unnest(string_split(b.a, '')) AS e, unnest(range(1, length(b.a) + 1)) AS pos FROM best
  WHERE b.a <> ''
), placed AS (
  SELECT conv, e, pos, count(*) FILTER (e <> 'I') OVER (PARTITION BY conv ORDER BY pos) AS i FROM edits
), spoken AS (
  SELECT p.conv, p.pos, p.e, f.initial, f.role, CASE WHEN p.e = 'I' THEN '' ELSE f.text END AS text,
         count(*) FILTER (NOT (p.e = 'K' AND f.initial = 's')) OVER (PARTITION BY p.conv ORDER BY p.pos) AS speaker
  FROM placed p LEFT JOIN faults f ON f.conv = p.conv AND f.i = p.i WHERE p.e <> 'D'
), texts AS (
  SELECT conv, string_agg(CASE WHEN e = 'K' THEN role WHEN speaker % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text,
                          chr(10) ORDER BY pos) AS repaired
  FROM spoken GROUP BY conv
)
SELECT c.conv_id, CAST(coalesce(g.gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(g.blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(g.dup, 0) AS BIGINT) AS duplicate, CAST(coalesce(g.cut, 0) AS BIGINT) AS truncated,
       CAST(coalesce(g.illegal, 0) AS BIGINT) AS illegal, b.b.c AS cost, b.b.a AS audit,
       sha256(coalesce(t.repaired, '')) AS repaired_sha256
FROM convs c JOIN best b USING (conv) LEFT JOIN grouped g USING (conv) LEFT JOIN texts t USING (conv)
"""

SPELLING_VARIANTS = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), 'null') AS doc, unnest(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents
), counted AS (SELECT doc, run, count(*) AS c, doc || ':' || run AS key FROM runs WHERE length(run) >= 6 GROUP BY doc, run),
hashed AS (SELECT run, c, {_crc('key')} AS h FROM counted, crc_table),
words AS (
  SELECT word, sum(c) AS n
  FROM (SELECT c, CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END
               AS word FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5
), cut AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM words a JOIN cut b ON a.word = b.rest
  UNION SELECT b.word, a.word, a.n FROM words a JOIN cut b ON a.word = b.rest
), best AS (
  SELECT word, count(*) AS n_near, min({{'less': -other_n, 'form': other}}) AS b FROM near GROUP BY word
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.less >= 5 * w.n THEN b.form END AS form,
         CASE WHEN -b.less >= 5 * w.n THEN -b.less END AS form_n
  FROM words w LEFT JOIN best USING (word)
), walk AS (
  SELECT word, word AS at FROM forms
  UNION ALL
  SELECT walk.word, f.form FROM walk JOIN forms f ON f.word = walk.at WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, r.root, CAST(f.n AS BIGINT) AS n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n
FROM forms f JOIN (
  SELECT walk.word, walk.at AS root FROM walk JOIN forms e ON e.word = walk.at WHERE e.form IS NULL) r USING (word)
"""
