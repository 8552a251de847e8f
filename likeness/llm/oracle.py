"""The same results in DuckDB SQL, for the operators that SQL can express."""

from __future__ import annotations

OP1 = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 34], ' ') AS said
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS i FROM docs)
), repeated AS (
  SELECT said FROM windows GROUP BY said HAVING count(*) > 1
), covered AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS place
  FROM windows SEMI JOIN repeated USING (said)
), placed AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1)::BIGINT AS place FROM docs
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text
  FROM placed ANTI JOIN covered USING (doc_id, place) GROUP BY doc_id
), removed AS (
  SELECT doc_id, count(*) AS n FROM covered GROUP BY doc_id
)
SELECT doc_id, len(words) AS n_words, coalesce(n, 0) AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id) LEFT JOIN removed USING (doc_id)
"""

OP3 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
  SELECT *,
    regexp_replace(text, '([<\[])(\\*)(s>|/s>|/t>|INST:|INST\]|/INST\])', '\1\2\\\3', 'g') AS held,
    lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), ''
    ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
    FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(held) + CASE WHEN before = role THEN length('</t>')
    ELSE length('<s>[INST:' || role || ']</s>') END)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""

OP4 = r"""
WITH sized AS (
  SELECT doc_id, source, md5('mix-1:' || coalesce(doc_id::VARCHAR, '')) AS place,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, 3 * sum(size)::BIGINT AS cap,
    (row_number() OVER (ORDER BY source NULLS LAST) - 1) AS rank FROM sized GROUP BY source
), weighed AS (
  SELECT *, (rank % 3 + 1)::BIGINT AS weight FROM sources
), levels AS (
  SELECT *, ((SELECT sum(source_size) FROM weighed)
      - coalesce(sum(cap) OVER before, 0))::DOUBLE
    / ((SELECT sum(weight) FROM weighed) - coalesce(sum(weight) OVER before, 0)) AS level
  FROM weighed
  WINDOW before AS (ORDER BY cap / weight, rank
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size, coalesce(least(cap::DOUBLE,
    (SELECT level FROM levels WHERE level * weight <= cap ORDER BY cap / weight, rank LIMIT 1)
      * weight), 0.0) AS target
  FROM levels
), placed AS (
  SELECT s.*, source_size, target, sum(size) OVER (PARTITION BY s.source
    ORDER BY place, doc_id, size ROWS UNBOUNDED PRECEDING)::BIGINT AS upto
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), line AS (
  SELECT doc_id, place, size, sum(size) OVER (
    ORDER BY (n * source_size + upto)::DOUBLE / target, place, doc_id, size
    ROWS UNBOUNDED PRECEDING)::BIGINT AS line
  FROM placed, range(3) AS passes(n) WHERE size > 0
), picked AS (
  SELECT doc_id, count(*) AS n FROM line
  WHERE line <= (SELECT sum(size) FROM sized) GROUP BY doc_id
)
SELECT p.doc_id, size, source_size, target, (size * coalesce(n, 0))::BIGINT AS taken
FROM placed p LEFT JOIN picked k ON p.doc_id = k.doc_id
"""

OP10 = """
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = max(doc_id) OVER w AS kept, sha256(text) AS text_sha256
FROM texts WINDOW w AS (PARTITION BY text)
"""

OP13 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), placed AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words
), grams AS (
  SELECT lang, 1 AS k, w[i] AS phrase FROM placed
  UNION ALL SELECT lang, 2, w[i] || ' ' || w[i + 1] FROM placed WHERE i + 1 <= len(w)
  UNION ALL SELECT lang, 3, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FROM placed WHERE i + 2 <= len(w)
), f AS (
  SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY lang, k, phrase
), totals AS (
  SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang
), cand AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k >= 2 AND f >= 10
), cuts AS (
  SELECT lang, phrase, a, cut, array_to_string(ws[1:cut], ' ') AS lp, array_to_string(ws[cut + 1:], ' ') AS rp
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM cand)
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.cut, fl.f AS l, fr.f AS r,
    (1000000::HUGEINT * c.a * c.a) // (fl.f::HUGEINT * fr.f) AS score
  FROM cuts c JOIN f fl ON fl.lang = c.lang AND fl.phrase = c.lp
  JOIN f fr ON fr.lang = c.lang AND fr.phrase = c.rp
), best AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS pick FROM scored
  ) WHERE pick = 1
), inside AS (
  SELECT lang, array_to_string(ws[1:2], ' ') AS phrase, a AS outer_a FROM cand WHERE k = 3
  UNION ALL SELECT lang, array_to_string(ws[2:3], ' '), a FROM cand WHERE k = 3
), kept AS (
  SELECT * FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM inside i WHERE i.lang = b.lang AND i.phrase = b.phrase AND 100 * i.outer_a >= 50 * b.a)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase ASC) AS rank
  FROM kept
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r,
  n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLE: dict[str, str] = {
    "op1_substring_dedup": OP1,
    "op3_chat_formatting": OP3,
    "op4_mixing": OP4,
    "op10_exact_dedup": OP10,
    "op13_collocations": OP13,
}
