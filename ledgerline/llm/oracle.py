"""DuckDB SQL of the operators that SQL can express, written from their contracts rather than from the Spark code."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The 16 values of the CRC-32 step of four bits (polynomial 0xEDB88320).
_CRC = []
for _i in range(16):
    _c = _i
    for _ in range(4):
        _c = (_c >> 1) ^ 0xEDB88320 if _c & 1 else _c >> 1
    _CRC.append(_c)


def _crc32(text: str) -> str:
    """crc32 of a text's UTF-8 bytes, four bits at a time, the low ones of each byte first."""
    nibbles = (f"list_transform(range(0, strlen({text}) * 2), lambda i: "
               f"instr('0123456789ABCDEF', substr(hex(encode({text})), i + 1 + (CASE WHEN i % 2 = 0 THEN 1 ELSE -1 END), 1)) - 1)")
    table = "[" + ", ".join(map(str, _CRC)) + "]"
    step = f"xor(c >> 4, {table}[(xor(c, n) & 15) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {nibbles}), lambda c, n: {step}), 4294967295::BIGINT)"


OP11 = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
counted AS (
  SELECT concat(coalesce(doc_id::VARCHAR, ''), ':') AS head, translate(run, '{_UPPER}', '{_LOWER}') AS run, count(*) AS n
  FROM runs GROUP BY ALL),
hashed AS (SELECT run, n, head || run AS full_text FROM counted),
slipped AS (SELECT run, n, {_crc32("full_text")} AS h FROM hashed),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n
    FROM slipped)
  GROUP BY word HAVING length(word) >= 5 AND sum(n) >= 3),
-- Words one edit apart share the word itself or the word without one code point.
less AS (
  SELECT word, word AS key FROM words
  UNION SELECT word, unnest(list_transform(range(1, length(word) + 1), lambda i: substr(word, 1, i - 1) || substr(word, i + 1))) FROM words),
maybe AS (SELECT DISTINCT a.word AS a, b.word AS b FROM less a JOIN less b USING (key) WHERE a.word <> b.word),
-- Of unlike length, the shorter one is the shared key; of equal length, one code point differs.
near AS (
  SELECT a, b FROM maybe WHERE length(a) <> length(b)
    OR len(list_filter(range(1, length(a) + 1), lambda i: substr(a, i, 1) <> substr(b, i, 1))) = 1),
best AS (
  SELECT a AS word, count(*) AS n_near, arg_min(b, (-w.n, b)) AS b, max(w.n) AS form_n
  FROM near JOIN words w ON w.word = near.b GROUP BY a),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN form_n >= 2 * w.n THEN b END AS form,
    CASE WHEN form_n >= 2 * w.n THEN form_n END AS form_n
  FROM words w LEFT JOIN best USING (word)),
walk AS (
  SELECT word, word AS at FROM forms
  UNION ALL SELECT walk.word, forms.form FROM walk JOIN forms ON forms.word = walk.at WHERE forms.form IS NOT NULL),
ends AS (SELECT walk.word, walk.at AS root FROM walk JOIN forms ON forms.word = walk.at WHERE forms.form IS NULL)
SELECT word, form, root, n, n_near, form_n::BIGINT AS form_n FROM forms JOIN ends USING (word)
"""

_TERMS = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP12 = f"""
WITH docs AS (SELECT row_number() OVER () AS d, doc_id, {_TERMS} AS w FROM documents),
items AS (SELECT item_id, {_TERMS} AS w FROM benchmark WHERE item_id IS NOT NULL),
wins AS (
  SELECT DISTINCT item_id, unnest(list_transform(range(0, greatest(len(w) - 10, 0) + 1), lambda i: list_slice(w, i + 1, i + 10))) AS win
  FROM items WHERE len(w) > 0),
sizes AS (SELECT DISTINCT len(win) AS size FROM wins),
grams AS (
  SELECT d, size, unnest(range(0, len(w) - size + 1)) AS i, w FROM docs, sizes WHERE len(w) >= size),
found AS (
  SELECT d, i, size, item_id, win FROM grams JOIN wins ON len(win) = size AND array_to_string(list_slice(w, i + 1, i + size), ' ') = array_to_string(win, ' ')),
covered AS (SELECT d, count(DISTINCT p) AS n_hit FROM (SELECT d, unnest(range(i, i + size)) AS p FROM found) GROUP BY d),
named AS (
  SELECT d, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT d, item_id::VARCHAR AS item_id FROM found) GROUP BY d),
places AS (SELECT d, unnest(w) AS term, unnest(range(0, len(w))) AS p FROM docs),
term_counts AS (SELECT term, count(*) AS n FROM places GROUP BY term),
rarest AS (
  SELECT item_id, win, arg_min(term, coalesce(n, 0)) AS term
  FROM (SELECT item_id, win, unnest(win) AS term FROM wins) LEFT JOIN term_counts USING (term) GROUP BY item_id, win),
around AS (
  SELECT DISTINCT d, item_id, win, s FROM (
    SELECT d, item_id, win, unnest(range(greatest(p - 19, 0), p + 1)) AS s FROM rarest JOIN places USING (term))),
close AS (
  SELECT DISTINCT d, item_id FROM around JOIN docs USING (d) WHERE list_has_all(list_slice(w, s + 1, s + 20), win)),
near AS (
  SELECT d, count(*) AS n_near FROM close c
  WHERE NOT EXISTS (SELECT 1 FROM found f WHERE f.d = c.d AND f.item_id = c.item_id) GROUP BY d)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0)::BIGINT AS n_near_items
FROM docs LEFT JOIN covered USING (d) LEFT JOIN named USING (d) LEFT JOIN near USING (d)
"""

OP13 = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
cut AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]'), lambda x: x <> '') AS w FROM pieces),
grams AS (
  SELECT lang, size, unnest(list_transform(range(0, len(w) - size + 1), lambda i: array_to_string(list_slice(w, i + 1, i + size), ' '))) AS phrase
  FROM cut, range(1, 6) AS t(size) WHERE len(w) >= size),
f AS (SELECT lang, phrase, size, count(*) AS f FROM grams GROUP BY ALL),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
cand AS (SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= 100),
inside AS (
  SELECT lang, a AS longer, array_to_string(list_slice(w, i + 1, i + m), ' ') AS phrase
  FROM (SELECT lang, a, w, m, unnest(range(0, size - m + 1)) AS i FROM cand, range(2, 5) AS t(m) WHERE m < size)),
dropped AS (SELECT DISTINCT c.lang, c.phrase FROM cand c JOIN inside i USING (lang, phrase) WHERE 100 * longer >= 100 * a),
cuts AS (
  SELECT lang, phrase, a, k, array_to_string(list_slice(w, 1, k), ' ') AS head, array_to_string(list_slice(w, k + 1, size), ' ') AS tail
  FROM (SELECT *, unnest(range(1, size)) AS k FROM cand ANTI JOIN dropped USING (lang, phrase))),
scored AS (
  SELECT c.lang, c.phrase, a, k, l.f AS l, r.f AS r, n, ((1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = head JOIN f r ON r.lang = c.lang AND r.phrase = tail
  JOIN total t ON t.lang = c.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best QUALIFY rank <= 2000
"""

ORACLE = {
    "op11_spelling_variant_grouping": OP11,
    "op12_benchmark_decontamination": OP12,
    "op13_phrase_collocation_mining": OP13,
}
