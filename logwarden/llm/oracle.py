"""DuckDB SQL of the training-data queries that SQL can express."""

#: op8: cosines of all pairs of a query and a candidate, in doubles. Vectors are
#: scaled by their largest component first, so squares neither vanish nor overflow.
NEAREST = """
WITH finite AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding::DOUBLE[], lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding::DOUBLE[], lambda x: x <> 0)) > 0),
scaled AS (
  SELECT vec_id, v, list_max(list_transform(v, lambda x: abs(x))) AS top FROM finite),
units AS (
  SELECT vec_id, list_transform(v, lambda x: x / power(2.0::DOUBLE, floor(log2(top)))) AS v FROM scaled),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))
         / (sqrt(list_sum(list_transform(c.v, lambda x: x * x))) * sqrt(list_sum(list_transform(q.v, lambda x: x * x)))) AS score
  FROM units q JOIN units c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)),
ranked AS (
  SELECT query_id, vec_id, score,
         CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

#: op11: the checksum is worked out bit by bit; near words share a word with one
#: code point left out or blanked.
VARIANTS = """
WITH RECURSIVE runs AS (
  SELECT doc_id, run, count(*) AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\u00C0-\u00FF]+')) AS run
        FROM documents)
  WHERE length(run) >= 6 GROUP BY doc_id, run),
spelled AS (
  SELECT *, list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''), lambda c: ord(c)) AS points
  FROM runs),
coded AS (
  SELECT *, flatten(list_transform(points, lambda p: CASE WHEN p < 128 THEN [p::BIGINT]
            ELSE [192 + (p >> 6)::BIGINT, 128 + (p & 63)::BIGINT] END)) AS bytes FROM spelled),
hashed AS (
  SELECT doc_id, run, times, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda c, b:
         list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) AS h
  FROM coded),
damaged AS (
  SELECT times, CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
                ELSE run END AS word FROM hashed),
words AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM damaged WHERE length(word) >= 6
  GROUP BY word HAVING sum(times) >= 5),
places AS (SELECT word, unnest(range(1, length(word) + 1)) AS p FROM words),
shorter AS (SELECT DISTINCT word, substr(word, 1, p - 1) || substr(word, p + 1) AS less FROM places),
blanked AS (SELECT word, p, substr(word, 1, p - 1) || substr(word, p + 1) AS less FROM places),
near AS (
  SELECT a.word, b.word AS other FROM blanked a JOIN blanked b ON a.less = b.less AND a.p = b.p AND a.word <> b.word
  UNION SELECT s.word, w.word FROM shorter s JOIN words w ON s.less = w.word
  UNION SELECT w.word, s.word FROM shorter s JOIN words w ON s.less = w.word),
counted AS (
  SELECT near.word, count(*) AS n_near, min({'less': -w.n, 'other': w.word}) AS top
  FROM near JOIN words w ON near.other = w.word GROUP BY near.word),
formed AS (
  SELECT words.word, n, coalesce(n_near, 0) AS n_near,
         CASE WHEN -top.less >= 5 * n THEN top.other END AS form,
         CASE WHEN -top.less >= 5 * n THEN CAST(-top.less AS BIGINT) END AS form_n
  FROM words LEFT JOIN counted ON words.word = counted.word),
led AS (
  SELECT word, word AS root, form AS next FROM formed
  UNION ALL
  SELECT led.word, f.word, f.form FROM led JOIN formed f ON led.next = f.word)
SELECT formed.word, form, led.root, n, n_near, form_n
FROM formed JOIN led ON formed.word = led.word AND led.next IS NULL
"""

_LEXICAL = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
            "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")

#: op12: every window of every document as text, joined with the items' windows.
CONTAMINATION = f"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS r, {_LEXICAL} AS w FROM documents),
items AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_LEXICAL} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS length, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS gram
  FROM items, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS t(i) WHERE len(w) > 0),
lengths AS (SELECT DISTINCT length FROM windows),
spots AS (
  SELECT r, i, length, array_to_string(w[i:i + length - 1], ' ') AS gram
  FROM docs, lengths, unnest(range(1, greatest(len(w) - length + 1, 0) + 1)) AS t(i)),
hits AS (SELECT r, i, spots.length, item FROM spots JOIN windows ON spots.gram = windows.gram AND spots.length = windows.length),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + length)) AS t(p) GROUP BY r),
found AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM hits GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered ON docs.r = covered.r LEFT JOIN found ON docs.r = found.r
"""

#: op13: every document that holds a term is scored in full.
SEARCH = f"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS r, {_LEXICAL} AS w FROM documents),
asked AS (SELECT DISTINCT item_id, coalesce(text, '') AS text FROM benchmark),
items AS (SELECT item_id, row_number() OVER () AS q, {_LEXICAL} AS w FROM asked),
wanted AS (SELECT q, term, count(*) AS times FROM (SELECT q, unnest(w) AS term FROM items) GROUP BY q, term),
corpus AS (SELECT count(*) FILTER (WHERE len(w) > 0) AS docs, CAST(sum(len(w)) AS BIGINT) AS total FROM docs),
held AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM docs)
  WHERE term IN (SELECT term FROM wanted) GROUP BY r, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln(((2 * docs + 2)::DOUBLE) / ((2 * count(*) + 1)::DOUBLE))) AS BIGINT) AS w
  FROM held, corpus GROUP BY term, docs),
worth AS (
  SELECT held.r, held.term,
         weights.w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * len(docs.w) * corpus.docs) // corpus.total)))) AS points
  FROM held JOIN weights ON held.term = weights.term JOIN docs ON held.r = docs.r, corpus),
scored AS (
  SELECT q, r, CAST(sum(times * points) AS BIGINT) AS score
  FROM worth JOIN wanted ON worth.term = wanted.term GROUP BY q, r),
ranked AS (
  SELECT q, docs.doc_id, score,
         CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, docs.doc_id) AS INTEGER) AS rank
  FROM scored JOIN docs ON scored.r = docs.r WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked JOIN items ON ranked.q = items.q WHERE rank <= 10
"""

ORACLE_SQL = {
    "op8_nearest_neighbours": NEAREST,
    "op11_spelling_variants": VARIANTS,
    "op12_decontamination": CONTAMINATION,
    "op13_ranked_search": SEARCH,
}
