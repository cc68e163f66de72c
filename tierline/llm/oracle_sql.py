"""SQL for queries of this subpackage, written apart from them and by plainer ways."""

from tierline.llm.license_scan import PHRASES, TEMPLATES

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LEXICAL_SEARCH = f"""
WITH asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER.format('text')},
         '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM benchmark),
held AS (
  SELECT doc_id, unnest(regexp_extract_all({_LOWER.format('text')},
         '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM documents),
sizes AS (SELECT doc_id, count(*) AS n FROM held GROUP BY doc_id),
corpus AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
tfs AS (SELECT doc_id, term, count(*) AS tf FROM held GROUP BY doc_id, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * any_value(docs) + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w
  FROM tfs, corpus GROUP BY term),
scores AS (
  SELECT a.item_id, t.doc_id,
         CAST(sum(w.w * ((1000000000 * t.tf) // (1000 * t.tf + 8 * (10 + (90 * s.n * c.docs) // c.terms)))) AS BIGINT) AS score
  FROM asked a JOIN tfs t USING (term) JOIN weights w USING (term) JOIN sizes s USING (doc_id), corpus c
  GROUP BY a.item_id, t.doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
       doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 10
"""


def _listed(texts) -> str:
    return "[" + ", ".join("'" + text.replace("'", "''") + "'" for text in texts) + "]"


def _license_scan() -> str:
    templates = ", ".join(
        f"({n}, '{label}', '{text.replace(chr(39), chr(39) * 2)}')" for n, (label, text) in enumerate(TEMPLATES)
    )
    places = []
    for phrase, label in PHRASES.items():
        words = phrase.split()
        same = " AND ".join(f"words[i + {n}] = '{word}'" for n, word in enumerate(words, 1))
        places.append(
            f"SELECT doc_id, i, '{label}' AS label FROM (SELECT doc_id, words, unnest(range(len(words))) AS i"
            f" FROM worded WHERE list_contains(words, '{words[0]}')) WHERE {same}"
        )
    word = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
    return f"""
WITH worded AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{word}') AS words FROM documents),
places AS ({" UNION ALL ".join(places)}),
base AS (
  SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
         list(DISTINCT label) AS labels
  FROM places GROUP BY doc_id),
template AS (
  SELECT t, label, list_distinct(words) AS held, s
  FROM (SELECT t, label, regexp_extract_all(lower(text), '{word}') AS words FROM (VALUES {templates}) AS v(t, label, text)),
       (VALUES (8), (16), (32), (64)) AS z(s)
  QUALIFY s = min(s) FILTER (s >= len(words)) OVER (PARTITION BY t)),
block AS (
  SELECT doc_id, s, b, list_distinct(words[b * s + 1 : b * s + 2 * s]) AS held
  FROM (SELECT doc_id, words, s, unnest(range((len(words) + s - 1) // s)) AS b
        FROM worded, (SELECT DISTINCT s FROM template))),
match AS (
  SELECT * FROM (
    SELECT doc_id, k.s, b, t, label, list_intersect(t.held, k.held) AS shared, len(t.held) AS size
    FROM block k JOIN template t ON k.s = t.s)
  WHERE len(shared) >= 0.9 * size - 1e-9),
strong AS (
  SELECT * FROM match m WHERE NOT EXISTS (
    FROM match o WHERE o.doc_id = m.doc_id AND o.s = m.s AND abs(o.b - m.b) <= 1 AND list_has_all(o.shared, m.shared)
      AND (len(o.shared) > len(m.shared) OR o.size < m.size))),
found AS (
  SELECT doc_id, list(DISTINCT label) AS labels, max(len(shared) / size) AS share FROM strong GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w.words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(found.labels, [])))), ',') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0)::DOUBLE END AS score
FROM worded w LEFT JOIN base USING (doc_id) LEFT JOIN found USING (doc_id)
"""


LICENSE_SCAN = _license_scan()

# CRC-32 by bytes; the table is made from its polynomial.
SPELLING_VARIANTS = r"""
WITH steps AS (
  SELECT list(list_reduce([n] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
              ORDER BY n) AS crcs
  FROM range(256) AS r(n)),
runs AS (
  SELECT doc_id, run, count(*) AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all(
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run
        FROM documents)
  WHERE length(run) >= 7 GROUP BY ALL),
coded AS (
  SELECT run, times, length(run) AS size, xor(4294967295, list_reduce(
           [4294967295] || [CAST('0x' || h AS BIGINT) FOR h IN regexp_extract_all(hex(encode(doc_id || ':' || run)), '..')],
           lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1]))) AS h
  FROM runs, steps),
words AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n
  FROM (SELECT times, CASE WHEN h % 31 = 0 THEN left(run, CAST(h % size AS BIGINT)) || substr(run, CAST(h % size AS BIGINT) + 2) ELSE run END AS word
        FROM coded)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
cut AS (
  SELECT DISTINCT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest, substr(word, i, 1) AS letter
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n
  FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.letter <> b.letter
  UNION SELECT c.word, w.word, w.n FROM cut c JOIN words w ON c.rest = w.word
  UNION SELECT w.word, c.word, c.n FROM cut c JOIN words w ON c.rest = w.word),
best AS (
  SELECT word, count(*) AS n_near, arg_min(other, (-other_n, encode(other))) AS other, max(other_n) AS other_n
  FROM near GROUP BY word),
judged AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN other_n >= 10 * n THEN other END AS form, CASE WHEN other_n >= 10 * n THEN other_n END AS form_n
  FROM words w LEFT JOIN best USING (word)),
follow AS (
  WITH RECURSIVE chain AS (
    SELECT word, word AS root FROM judged
    UNION ALL SELECT c.word, j.form FROM chain c JOIN judged j ON j.word = c.root WHERE j.form IS NOT NULL)
  SELECT chain.word, arg_max(chain.root, j.n) AS root FROM chain JOIN judged j ON j.word = chain.root GROUP BY chain.word)
SELECT j.word, form, root, n, n_near, form_n FROM judged j JOIN follow f ON f.word = j.word
"""
