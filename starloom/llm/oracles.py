"""DuckDB SQL for the queries that SQL can express, over whole tables."""

from __future__ import annotations

from starloom.llm import line_dedup, quality_rules, secret_scan, spelling

SPACE = r"[ \t\n\x0b\f\r]"


def quality_sql() -> str:
    return rf"""
WITH texts AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
parts AS (
  SELECT *, list_filter(regexp_split_to_array(text, '{SPACE}+'), lambda x: x <> '') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0b\f\r]')) AS lines
  FROM texts),
windows AS (
  SELECT row, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS key
  FROM (SELECT row, words, unnest(range(1, len(words) - 1)) AS i FROM parts)),
often AS (
  SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, key) AS n FROM windows) WHERE n > 1),
repeated AS (
  SELECT row, count(DISTINCT i + k) AS n FROM often, (SELECT unnest([0, 1, 2]) AS k) GROUP BY row),
measured AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, len(array_to_string(words, ''))::BIGINT AS word_chars,
    len(regexp_replace(text, '[^{quality_rules.SYMBOLS}]', '', 'g'))::BIGINT AS n_symbols, len(lines) AS n_lines,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM parts LEFT JOIN repeated USING (row)),
failed AS (
  SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > 3 * n_words THEN 4 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words THEN 8 ELSE 0 END
    + CASE WHEN word_chars > 15 * n_words THEN 16 ELSE 0 END
    + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 32 ELSE 0 END)::BIGINT AS failed
  FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  failed & 3 <> 0 AS base_failed, failed = 0 AS kept, failed
FROM failed
"""


def secret_sql() -> str:
    columns, spans = [], []
    for i, rule in enumerate(secret_scan.RULES):
        pattern = rule.pattern.replace("'", "''")
        columns.append(
            f"regexp_extract_all(text, '{pattern}', 0) AS found{i}, "
            f"regexp_extract_all(text, '{pattern}', {rule.group}) AS group{i}, "
            f"regexp_split_to_array(text, '{pattern}') AS gaps{i}"
        )
        spans.append(
            f"list_transform(list_filter(range(1, len(found{i}) + 1), lambda k: len(group{i}[k]) >= {rule.at_least}), lambda k: "
            f"{{'start': coalesce(list_sum(list_transform(gaps{i}[1:k], lambda x: len(x))), 0)::INT"
            f" + coalesce(list_sum(list_transform(found{i}[1:k - 1], lambda x: len(x))), 0)::INT, 'rank': {i}, "
            f"'stop': coalesce(list_sum(list_transform(gaps{i}[1:k], lambda x: len(x))), 0)::INT"
            f" + coalesce(list_sum(list_transform(found{i}[1:k], lambda x: len(x))), 0)::INT, 'kind': '{rule.kind}'}})"
        )
    shown = "array_to_string(list_transform({}, lambda s: s.kind || ':' || s.start || ':' || s.stop), ',')"
    base = "list_filter(spans, lambda s: s.rank < 3)"
    counts = ", ".join(
        f"len(list_filter(spans, lambda s: s.kind = '{k}'))::BIGINT AS n_{k}" for k in secret_scan.BASE_KINDS
    )
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
found AS (SELECT doc_id, {", ".join(columns)} FROM texts),
placed AS (SELECT doc_id, list_sort(flatten([{", ".join(spans)}])) AS spans FROM found)
SELECT doc_id, {counts}, sha256({shown.format(base)}) AS base_sha256, {shown.format("spans")} AS spans FROM placed
"""


def line_sql() -> str:
    piece = line_dedup.PIECE
    return rf"""
WITH texts AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
pieces AS (
  SELECT row, doc_id, unnest(regexp_extract_all(text, '{piece}')) AS piece,
    generate_subscripts(regexp_extract_all(text, '{piece}'), 1) AS no
  FROM texts),
placed AS (
  SELECT *, (sum(len(piece)) OVER (PARTITION BY row ORDER BY no) - len(piece))::BIGINT AS start,
    trim(regexp_replace(translate(piece, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{SPACE}+', ' ', 'g')) AS unit
  FROM pieces WHERE piece <> ''),
weighed AS (
  SELECT *, greatest(len(string_split(unit, ' ')), len(replace(unit, ' ', '')) // {line_dedup.CHARS_A_WORD}) AS weight,
    unit <> '' AND row_number() OVER (PARTITION BY unit ORDER BY doc_id, no) > 1 AS later
  FROM placed),
grouped AS (SELECT *, count(*) FILTER (NOT later) OVER (PARTITION BY row ORDER BY no) AS run FROM weighed),
judged AS (
  SELECT *, later AND coalesce(sum(weight) FILTER (later) OVER (PARTITION BY row, run), 0) >= {line_dedup.LEAST_WEIGHT} AS removed
  FROM grouped),
runs AS (
  SELECT row, run, count(*) AS n, min(start) AS start, max(start + len(piece)) AS stop FROM judged WHERE removed GROUP BY row, run),
spans AS (
  SELECT row, sum(n)::BIGINT AS n, sum(stop - start)::BIGINT AS chars, string_agg(start || ':' || stop, ',' ORDER BY start) AS spans
  FROM runs GROUP BY row),
kept AS (SELECT row, string_agg(piece, '' ORDER BY no) FILTER (NOT removed) AS text FROM judged GROUP BY row)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_removed, coalesce(chars, 0)::BIGINT AS n_removed_chars,
  coalesce(spans, '') AS spans, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM texts LEFT JOIN spans USING (row) LEFT JOIN kept USING (row)
"""


def spelling_sql() -> str:
    return rf"""
WITH RECURSIVE crc AS (
  SELECT list(v ORDER BY i) AS tab FROM (
    SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)),
      lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v
    FROM (SELECT unnest(range(256)) AS i))),
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents),
counted AS (
  SELECT run, coalesce(doc_id::VARCHAR, '') || ':' || run AS key, count(*) AS n
  FROM runs WHERE length(run) >= {spelling.LEAST_CHARS} GROUP BY doc_id, run),
hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, strlen(key) + 1),
      lambda i: ('0x' || substr(hex(encode(key)), (2 * i - 1)::BIGINT, 2))::BIGINT)),
    lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295) AS h
  FROM counted, crc),
slipped AS (
  SELECT CASE WHEN h % {spelling.SLIP} = 0
    THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run) + 2)::BIGINT) ELSE run END AS word, n
  FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE length(word) >= {spelling.LEAST_CHARS} GROUP BY word HAVING sum(n) >= {spelling.LEAST_COUNT}),
cut AS (
  SELECT DISTINCT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n
  FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT c.word, c.n, w.word, w.n FROM cut c JOIN words w ON c.rest = w.word
  UNION SELECT w.word, w.n, c.word, c.n FROM cut c JOIN words w ON c.rest = w.word),
best AS (
  SELECT word, count(*) AS n_near, max(near_n) AS most, arg_min(near, {{'n': -near_n, 'w': encode(near)}}) AS near
  FROM pairs GROUP BY word),
judged AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= {spelling.RATIO} * n THEN near END AS form,
    CASE WHEN most >= {spelling.RATIO} * n THEN most END AS form_n
  FROM words LEFT JOIN best USING (word)),
chain AS (
  SELECT word, form AS root, 1 AS hop FROM judged WHERE form IS NOT NULL
  UNION ALL
  SELECT c.word, j.form, hop + 1 FROM chain c JOIN judged j ON c.root = j.word WHERE j.form IS NOT NULL),
roots AS (SELECT word, arg_max(root, hop) AS root FROM chain GROUP BY word)
SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM judged LEFT JOIN roots USING (word)
"""


def negatives_sql() -> str:
    return """
WITH rows AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS vector
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.id AS anchor_id, c.id AS id, a.label = c.label AS same,
    list_inner_product(a.vector, c.vector)::BIGINT AS score
  FROM rows a, rows c WHERE a.id % 50 = 0 AND a.id <> c.id),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id,
  (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id))::INT AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""


SQL = {
    "op1_quality_rules": quality_sql(),
    "op2_secret_scan": secret_sql(),
    "op4_line_dedup": line_sql(),
    "op11_spelling_variants": spelling_sql(),
    "op12_hard_negatives": negatives_sql(),
}
