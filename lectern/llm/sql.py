"""The SQL that the registered queries are checked against."""

from __future__ import annotations

# white space of the contracts, inside a regular expression class and as characters
_SPACE = r"\x20\x09-\x0D"
_TRIMMED = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _lower(text: str) -> str:
    """A-Z only."""
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(text: str) -> str:
    return f"list_filter(string_split_regex(coalesce({text}, ''), '[{_SPACE}]+'), lambda w: w <> '')"


QUALITY = f"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS text, {_words("text")} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda v: regexp_matches(v, '[^{_SPACE}]')) AS lines
  FROM documents
), windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 3)) AS i, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) AS g
  FROM split
), twice AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY doc_id
), measured AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines)::BIGINT AS n_lines,
         length(regexp_replace(text, '\\P{{L}}+', '', 'g')) AS n_letters,
         length(regexp_replace(text, '[^A-Z]+', '', 'g')) AS n_capitals,
         len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_echoes,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM split LEFT JOIN covered USING (doc_id)
), book AS (
  SELECT *, (n_words < 10)::BIGINT + 2 * (100 * n_repeat_words > 20 * n_words)::BIGINT
    + 4 * (2 * n_dup_lines > n_lines)::BIGINT + 8 * (10 * n_symbols > n_words)::BIGINT
    + 16 * (word_chars < 2 * n_words)::BIGINT + 32 * (word_chars > 25 * n_words)::BIGINT
    + 64 * (2 * n_letters < word_chars)::BIGINT + 128 * (10 * n_capitals > 6 * n_letters)::BIGINT + 256 * (100 * n_echoes > 30 * n_words)::BIGINT AS fail_bits
  FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, fail_bits & 3 <> 0 AS base_failed,
       fail_bits = 0 AS kept, fail_bits, CASE WHEN bit_count(fail_bits) = 1 THEN fail_bits ELSE 0 END AS sole_bit
FROM book
"""

# CRC-32 of the UTF-8 bytes: the table of the reversed polynomial, then a fold over the bytes
_CRC_TABLE = """crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
)"""


def _crc(text: str) -> str:
    digit = lambda c: f"(instr('0123456789ABCDEF', {c}) - 1)"
    byte = f"lambda h: 16 * {digit('h[1]')} + {digit('h[2]')}"
    codes = f"list_transform(regexp_extract_all(hex(encode(coalesce({text}, ''))), '..'), {byte})"
    step = "lambda c, b: xor(c >> 8, (SELECT t FROM crc_table)[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), {step}), 4294967295)"


SHARDS = f"""
WITH {_CRC_TABLE}, rows AS (
  SELECT doc_id, source, coalesce(strlen(text), 0) + 16 AS size, {_crc("text").replace("(SELECT t FROM crc_table)", "t")} AS text_crc32,
         ('0x' || substr(md5(doc_id::VARCHAR || ':17'), 1, 12))::BIGINT AS h
  FROM documents, crc_table
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY h, doc_id, text_crc32, size) AS r,
         count(*) OVER (PARTITION BY source) AS n_of, count(*) OVER () AS n
  FROM rows
), placed AS (
  SELECT *, row_number() OVER (ORDER BY (2 * r - 1) / (2 * n_of), coalesce('=' || source, ''), r) - 1 AS p FROM ranked
), cut AS (
  SELECT *, p * 40 // n AS shard FROM placed
)
SELECT doc_id, source, size, text_crc32, 'rows' AS law, shard::INTEGER AS shard, p - (shard * n + 39) // 40 AS slot,
       NULL::INTEGER AS grown_shard
FROM cut
"""

LINES = f"""
WITH split AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents
), keyed AS (
  SELECT *, trim({_lower("line")}, {_TRIMMED}) AS k FROM split
), repeated AS (
  SELECT k, max(doc_id) AS largest FROM keyed WHERE length(k) >= 20
  GROUP BY k HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT keyed.*, coalesce(largest <> doc_id, false) AS dropped FROM keyed LEFT JOIN repeated USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE split AS (
  SELECT doc_id, {_words(_lower("text"))} AS w FROM documents
), shingled AS (
  SELECT doc_id, CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) END AS s
  FROM split
), sized AS (
  SELECT doc_id, len(s)::BIGINT AS n_shingles, s FROM shingled
), texts AS (
  SELECT min(doc_id) AS rep, list_sort(s) AS s, any_value(n_shingles) AS n FROM sized WHERE n_shingles > 0 GROUP BY list_sort(s)
), singles AS (
  SELECT rep, n, md5(unnest(s)) AS shingle FROM texts
), pairs AS (
  SELECT a.rep AS a, b.rep AS b FROM singles a JOIN singles b ON a.shingle = b.shingle AND a.rep < b.rep
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), edges AS (
  SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs
), reach AS (
  SELECT rep AS node, rep AS seen FROM texts
  UNION
  SELECT reach.node, edges.b FROM reach JOIN edges ON reach.seen = edges.a
), labels AS (
  SELECT node, min(seen) AS label FROM reach GROUP BY node
), classes AS (
  SELECT sized.doc_id, n_shingles, coalesce(label, sized.doc_id) AS component_id
  FROM sized LEFT JOIN texts ON list_sort(sized.s) = texts.s LEFT JOIN labels ON labels.node = texts.rep
)
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM classes
"""

DIVERGENCE = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_lower("coalesce(text, '')")} AS text
  FROM documents
), words AS (
  SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs
), cells AS (
  SELECT lang, source, term, count(*) AS n FROM words GROUP BY ALL
), kept AS (
  SELECT lang, term, count(*) AS cl FROM words GROUP BY ALL HAVING count(DISTINCT r) >= 30
), langs AS (
  SELECT lang, count(*) AS v, sum(cl) AS total FROM kept GROUP BY lang
), counts AS (
  SELECT g.lang, g.source, term, coalesce(n, 0) AS n, cl, v, total, sum(coalesce(n, 0)) OVER (PARTITION BY g.lang, g.source) AS own
  FROM (SELECT DISTINCT lang, source FROM docs) g JOIN kept USING (lang) JOIN langs USING (lang) LEFT JOIN cells USING (lang, source, term)
), shares AS (
  SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 5)) // (own + 5 * v) AS p,
         1 + (1000000000::HUGEINT * (cl + 5)) // (total + 5 * v) AS q
  FROM counts
), apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
  FROM (SELECT DISTINCT lang, source FROM docs) a JOIN (SELECT DISTINCT lang, source FROM docs) b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source
), parts AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts
) WHERE part = 'pair' OR rank <= 50
"""
