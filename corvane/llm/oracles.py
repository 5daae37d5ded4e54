"""SQL that states the results of the queries another engine can express."""

from __future__ import annotations

from corvane.llm import collocations, mixing, quality_rules

WORD = r"'[^\x20\x09-\x0D]+'"
SPACE_RUN = r"'[\x20\x09-\x0D]+'"

QUALITY_RULES = rf"""
WITH d AS (SELECT doc_id, coalesce('=' || source, '') AS host, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT doc_id, host, text, regexp_extract_all(text, {WORD}) AS ws,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, {WORD})) AS bare
  FROM d),
spans AS (
  SELECT doc_id, i, array_to_string(ws[i : i + 7], ' ') AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM spans) WHERE c > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + j) AS n FROM again, (SELECT unnest(range(0, 8)) AS j) GROUP BY doc_id),
lines AS (
  SELECT doc_id, host, text, lower(trim(regexp_replace(line, {SPACE_RUN}, ' ', 'g'))) AS norm
  FROM (SELECT doc_id, host, text, unnest(bare) AS line FROM w)),
hosts AS (SELECT host, count(DISTINCT text) AS docs FROM d GROUP BY host),
common AS (
  SELECT host, norm, first_doc
  FROM (SELECT host, norm, count(DISTINCT text) AS n, min(doc_id) AS first_doc FROM lines GROUP BY host, norm)
  JOIN hosts USING (host)
  WHERE n > {quality_rules.MIN_DOCS} AND n > docs * CAST({quality_rules.SHARE} AS DOUBLE)),
gone AS (
  SELECT doc_id, CAST(sum(len(string_split(norm, ' '))) AS BIGINT) AS n
  FROM lines JOIN common USING (host, norm) WHERE doc_id <> first_doc GROUP BY doc_id),
m AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(bare) - len(list_distinct(bare)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words, coalesce(gone.n, 0) AS removed_words
  FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN gone USING (doc_id)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND NOT n_words - removed_words < CAST({quality_rules.LEFT} AS DOUBLE) * n_words AS kept FROM f
"""

MIXING = rf"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), {WORD})) AS BIGINT) AS size,
         substr(md5('{mixing.SEED}/' || coalesce(CAST(doc_id AS VARCHAR), '-')), 1, 15) AS draw
  FROM documents),
sums AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
src AS (
  SELECT source, source_size, {mixing.EPOCHS} * source_size AS cap,
         {list(mixing.WEIGHTS)}[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1] AS weight
  FROM sums),
goal AS (SELECT CAST({mixing.TOTAL} AS DOUBLE) * sum(source_size) AS words, sum(weight) AS weight FROM src),
r AS (SELECT cap, weight, row_number() OVER (ORDER BY cap / weight, source) AS k FROM src),
steps AS (
  SELECT 0 AS k, 0 AS cap, 0 AS weight
  UNION ALL SELECT k, sum(cap) OVER (ORDER BY k), sum(weight) OVER (ORDER BY k) FROM r),
levels AS (
  SELECT s.k, (goal.words - s.cap) / (goal.weight - s.weight) AS level, n.cap / n.weight AS upper
  FROM steps s JOIN r n ON n.k = s.k + 1, goal),
best AS (SELECT min_by(level, k) AS level FROM levels WHERE upper > level),
want AS (
  SELECT source, source_size, CASE WHEN cap <= level * weight THEN CAST(cap AS DOUBLE) ELSE level * weight END AS target
  FROM src, best),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM want),
laid AS (
  SELECT doc_id, size, source_size, target, whole, CAST(round(target - whole * source_size) AS BIGINT) AS rest,
         CAST(coalesce(sum(size) OVER (
           PARTITION BY sized.source ORDER BY draw, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
  FROM sized JOIN plan ON sized.source IS NOT DISTINCT FROM plan.source)
SELECT doc_id, size, source_size, target, CAST(whole * size + least(greatest(rest - before, 0), size) AS BIGINT) AS taken FROM laid
"""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

COLLOCATIONS = rf"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
n AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (
  SELECT lang, k, array_to_string(ws[i : i + k - 1], ' ') AS phrase
  FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, (SELECT unnest(range(1, {collocations.ORDER + 1})) AS k)
        WHERE len(ws) >= k)),
f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY lang, k, phrase HAVING count(*) >= {collocations.LEAST}),
cuts AS (
  SELECT lang, k, phrase, a, cut, array_to_string(string_split(phrase, ' ')[1 : cut], ' ') AS one,
         array_to_string(string_split(phrase, ' ')[cut + 1 :], ' ') AS two
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM f WHERE k > 1)),
s AS (
  SELECT c.lang, c.phrase, c.a, x.a AS l, y.a AS r, n.n,
         CAST(CAST(1000 AS HUGEINT) * c.a * n.n // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score, cut
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = one JOIN f y ON y.lang = c.lang AND y.phrase = two JOIN n ON n.lang = c.lang),
low AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
kept AS (
  SELECT * FROM low WHERE NOT EXISTS (
    SELECT 1 FROM (
      SELECT lang, a, array_to_string(string_split(phrase, ' ')[i : i + m - 1], ' ') AS held
      FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM f WHERE k > 2))) z
    WHERE z.lang = low.lang AND z.held = low.phrase AND 100 * z.a >= 100 * low.a))
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
WHERE rank <= {collocations.MOST}
"""

FILL_IN_MIDDLE = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex
  FROM documents),
h AS (
  SELECT *, [CAST('0x' || hex[8 * i + 1 : 8 * i + 8] AS BIGINT) FOR i IN range(0, 4)] AS h FROM d),
f AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS low, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS high,
         CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
              WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM h)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN low END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN high - low END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
              WHEN 'psm' THEN '<P>' || substr(text, 1, low) || '<S>' || substr(text, high + 1) || '<M>' || substr(text, low + 1, high - low)
              ELSE '<S>' || substr(text, high + 1) || '<P>' || substr(text, 1, low) || '<M>' || substr(text, low + 1, high - low) END
       ) AS output_sha256, sha256(text) AS restored_sha256
FROM f
"""


def token_rollup(words_and_marks: str, spoken: str) -> str:
    count = lambda pattern: f"CAST(len(regexp_extract_all(coalesce(text, ''), '{pattern}')) AS BIGINT)"
    return f"""
WITH kept AS (
  SELECT * FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = d.doc_id AND toxic = 1)),
counted AS (
  SELECT source, lang, CASE WHEN lang = 'en' THEN 'words-1' ELSE 'words-2' END AS tokenizer,
         CASE WHEN lang = 'en' THEN {count(spoken)} ELSE {count(words_and_marks)} END AS n
  FROM kept)
SELECT source, lang, tokenizer, count(*) AS docs, CAST(sum(n) AS BIGINT) AS tokens FROM counted GROUP BY source, lang, tokenizer
"""
