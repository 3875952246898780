"""DuckDB SQL for the operators that SQL can express, written apart from the Spark code.

Not expressible: op1 (random draws), op2, op5 and op13 (trained models), op6 and op9 (a tokenizer), op10 (XXH64
with a seed), op11 (CRC-32, and every period of every text); these are tested against brute force, round trips and held-out accuracy in ``tests/llm``.
"""

#: Words of a text, as a list.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP3 = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""

OP4 = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
starts AS (SELECT doc_id, unnest(range(1, len(w) - 33)) AS p FROM d WHERE len(w) >= 35),
windows AS (SELECT doc_id, p, md5(array_to_string(w[p : p + 34], ' ')) AS h FROM starts JOIN d USING (doc_id)),
again AS (SELECT doc_id, p FROM (SELECT *, count(*) OVER (PARTITION BY h) AS k FROM windows) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, p + o AS i FROM again, (SELECT unnest(range(0, 35)) AS o)),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t
         FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP7 = r"""
WITH all_lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                          generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
real AS (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS w, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k
         FROM all_lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
near AS (SELECT doc_id, k, w, line, lead(line) OVER o AS line_1, lead(line, 2) OVER o AS line_2, lead(w) OVER o AS w_1,
                lag(w) OVER o AS w_0, lag(w, 2) OVER o AS w_00, count(*) OVER d AS n_lines, sum(w) OVER d AS n_words
         FROM real WINDOW o AS (PARTITION BY doc_id ORDER BY k), d AS (PARTITION BY doc_id)),
onward AS (SELECT doc_id, k, CASE WHEN w >= 8 THEN 1 WHEN w + w_1 >= 8 THEN 2 WHEN line_2 IS NOT NULL THEN 3 END AS n FROM near),
back AS (SELECT doc_id, k, CASE WHEN w >= 8 THEN 1 WHEN w + w_0 >= 8 THEN 2 WHEN w_00 IS NOT NULL THEN 3 END AS n FROM near),
runs AS (SELECT doc_id, k, n, false AS short FROM onward WHERE n IS NOT NULL
         UNION SELECT doc_id, k - n + 1, n, false FROM back WHERE n IS NOT NULL
         UNION SELECT doc_id, 1, n_lines, true FROM near WHERE n_lines < 3 AND n_words < 8),
texts AS (SELECT r.*, concat_ws(chr(10), line, CASE WHEN n > 1 THEN line_1 END, CASE WHEN n > 2 THEN line_2 END) AS t
          FROM runs r JOIN near USING (doc_id, k)),
later AS (SELECT doc_id, k, n FROM (SELECT *, row_number() OVER (PARTITION BY short, t ORDER BY doc_id, k) AS r FROM texts)
          WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, k + o AS k FROM later, (SELECT unnest([0, 1, 2]) AS o) WHERE o < n),
marked AS (SELECT l.doc_id, l.i, l.line, r.k, g.k IS NOT NULL AS cut
           FROM all_lines l LEFT JOIN real r ON l.doc_id = r.doc_id AND l.i = r.i
           LEFT JOIN gone g ON r.doc_id = g.doc_id AND r.k = g.k)
SELECT doc_id, count(k) AS n_lines, count(*) FILTER (cut) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT cut), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP8 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
lines AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS dup FROM
          (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
windows AS (SELECT doc_id, p, array_to_string(w[p : p + 7], ' ') AS t
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS p FROM d WHERE len(w) >= 8)),
again AS (SELECT doc_id, p FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, t) AS k FROM windows) WHERE k > 1),
repeats AS (SELECT doc_id, count(DISTINCT p + o) AS n FROM again, (SELECT unnest(range(0, 8)) AS o) GROUP BY doc_id),
m AS (SELECT doc_id, len(w)::BIGINT AS n_words, len(array_to_string(w, ''))::BIGINT AS word_chars,
             len(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(dup, 0)::BIGINT AS n_dup_lines,
             coalesce(n, 0)::BIGINT AS n_repeat_words, len(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper,
             len(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS n_letters
      FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id)),
j AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_symbols > 20 * n_words OR (n_lines >= 4 AND 100 * n_dup_lines > 50 * n_lines)
            OR (n_words >= 20 AND (word_chars < 2 * n_words OR word_chars > 25 * n_words))
            OR (n_letters >= 50 AND 100 * n_upper > 60 * n_letters)) AS kept
FROM j
"""

OP12 = rf"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad
      FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
d AS (SELECT part, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad, len(w) < 200 AS a,
             100 * len(list_distinct(w)) < 50 * len(w) AS b,
             100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * len(text) AS c, regexp_matches(text, '[#$%&*|]') AS d,
             coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS e
      FROM t LEFT JOIN l USING (doc_id)),
m AS (SELECT part, (CASE WHEN a THEN 'A' ELSE '' END) || (CASE WHEN b THEN 'B' ELSE '' END) || (CASE WHEN c THEN 'C' ELSE '' END)
             || (CASE WHEN d THEN 'D' ELSE '' END) || (CASE WHEN e THEN 'E' ELSE '' END) AS fails,
             count(*) AS n, sum(good) AS good, sum(bad) AS bad FROM d GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (SELECT p.f || q.f || r.f || s.f || u.f AS filter_order FROM x p, x q, x r, x s, x u
           WHERE len(list_distinct([p.f, q.f, r.f, s.f, u.f])) = 5),
steps AS (SELECT filter_order, step, filter_order[step] AS f, filter_order[1:step - 1] AS earlier
          FROM orders, (SELECT unnest(range(1, 6)) AS step)),
j AS (SELECT part, filter_order, step, f, n, good, bad, contains(fails, f) AS failed, fails = f AS alone,
             translate(fails, earlier, '') <> fails AS gone FROM m, steps),
r AS (SELECT part, filter_order, step, f, coalesce(sum(n) FILTER (NOT gone AND NOT failed), 0)::BIGINT AS kept,
             coalesce(sum(n) FILTER (NOT gone AND failed), 0)::BIGINT AS removed,
             coalesce(sum(n) FILTER (gone AND failed), 0)::BIGINT AS redundant,
             coalesce(sum(n) FILTER (alone), 0)::BIGINT AS unique_fails,
             coalesce(sum(good) FILTER (NOT gone AND failed), 0)::BIGINT AS good_lost,
             coalesce(sum(bad) FILTER (NOT gone AND failed), 0)::BIGINT AS toxic_lost
      FROM j GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM r
"""

SQL = {"op3_exact_dedup": OP3, "op4_substring_dedup": OP4, "op7_line_dedup": OP7, "op8_rule_ledger": OP8,
       "op12_potential_audit": OP12}
