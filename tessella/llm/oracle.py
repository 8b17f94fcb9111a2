"""DuckDB statements with the same rows as the queries that SQL can express."""

from __future__ import annotations

from tessella.llm import decontaminate, quality, suffixes

_BLANK = "[\\x20\\x09-\\x0D]+"


def _first_level(value: str, rule: str) -> str:
    top, step = quality.RULES[rule]
    return f"CASE WHEN {value} > {top - step * (quality.LEVELS - 1)} THEN greatest(1, CAST(floor(({top} - {value}) / CAST({step} AS DOUBLE)) AS INTEGER) + 2) ELSE {quality.LEVELS + 1} END"


OP1 = f"""
    WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS stratum FROM documents),
    w AS (SELECT *, list_filter(regexp_split_to_array(text, '{_BLANK}'), lambda x: x <> '') AS words,
                 list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM t),
    windows AS (SELECT rid, i, array_to_string(words[i:i + 7], ' ') AS gram FROM (SELECT rid, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 9)),
    twice AS (SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, gram) > 1),
    repeats AS (SELECT rid, sum(d) AS n FROM (SELECT rid, least(8, coalesce(i - lag(i) OVER (PARTITION BY rid ORDER BY i), 8)) AS d FROM twice) GROUP BY rid),
    f AS (SELECT w.rid, doc_id, stratum, CAST(len(words) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '{_BLANK}', '', 'g')) AS BIGINT) AS word_chars,
                 CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols, CAST(length(regexp_replace(text, '[^A-Z]+', '', 'g')) AS BIGINT) AS n_upper,
                 CAST(length(regexp_replace(text, '[^!?]+', '', 'g')) AS BIGINT) AS n_shout, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, len(lines) AS n_lines,
                 CAST(coalesce(repeats.n, 0) AS BIGINT) AS n_repeat_words FROM w LEFT JOIN repeats USING (rid)),
    s AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, CASE WHEN word_chars > 0 THEN n_symbols * 1000 // word_chars ELSE 0 END AS symbols,
                 CASE WHEN word_chars > 0 THEN n_upper * 1000 // word_chars ELSE 0 END AS uppers, CASE WHEN word_chars > 0 THEN n_shout * 1000 // word_chars ELSE 0 END AS shouts,
                 CASE WHEN n_lines > 0 THEN n_dup_lines * 1000 // n_lines ELSE 0 END AS dups FROM f),
    j AS (SELECT *, CAST(least({_first_level("symbols", "symbol_share")}, {_first_level("uppers", "upper_share")}, {_first_level("shouts", "shout_share")}, {_first_level("dups", "dup_line_share")}) AS INTEGER) AS reject_level FROM s),
    marks AS (SELECT doc_id, min(quality) = 1 AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
    seen AS (SELECT stratum, reject_level, good FROM j JOIN marks USING (doc_id) WHERE NOT base_failed),
    tried AS (SELECT stratum, level, count(*) FILTER (WHERE good) AS n, count(*) FILTER (WHERE good AND reject_level <= level) AS k, count(*) FILTER (WHERE NOT good AND reject_level <= level) AS bad
              FROM seen, range(1, {quality.LEVELS + 1}) AS l(level) GROUP BY stratum, level),
    tested AS (SELECT *, CASE WHEN n = 0 OR k >= n * {quality.ALPHA} THEN 1
                      ELSE list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({quality.ALPHA}) + (n - i) * ln(1 - {quality.ALPHA})))) END AS p FROM tried),
    held AS (SELECT *, max(CAST(p > {quality.DELTA} / (SELECT count(DISTINCT stratum) FROM seen) AS INTEGER)) OVER (PARTITION BY stratum ORDER BY level) AS failed FROM tested),
    best AS (SELECT stratum, arg_min(level, (k * {quality.GOOD_COST} - bad, level)) AS level FROM held WHERE failed = 0 GROUP BY stratum)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND reject_level > coalesce(level, 0) AS kept, reject_level, stratum, CAST(coalesce(level, 0) AS INTEGER) AS cutoff_level
    FROM j LEFT JOIN best USING (stratum)
"""

_WORDS = "list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"

OP7 = f"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS words FROM documents),
    b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS words FROM benchmark WHERE item_id IS NOT NULL),
    windows AS (SELECT DISTINCT item, size, array_to_string(words[i:i + size - 1], ' ') AS gram FROM (SELECT item, words, least(len(words), {decontaminate.WINDOW}) AS size, unnest(range(1, greatest(len(words) - {decontaminate.WINDOW - 1}, 1) + 1)) AS i FROM b WHERE len(words) > 0)),
    places AS (SELECT rid, size, i, array_to_string(words[i:i + size - 1], ' ') AS gram FROM (SELECT rid, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM d, (SELECT DISTINCT size FROM windows) WHERE len(words) >= size)),
    hits AS (SELECT rid, i, size, item FROM places JOIN windows USING (size, gram)),
    covered AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + size)) AS p FROM hits) GROUP BY rid),
    items AS (SELECT rid, list_sort(list_distinct(list(item))) AS items FROM hits GROUP BY rid)
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_hit, CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
           sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
    FROM d LEFT JOIN covered USING (rid) LEFT JOIN items USING (rid)
"""

OP3 = f"""
    WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{_BLANK}'), lambda x: x <> '') AS words FROM documents),
    windows AS (SELECT doc_id, i, md5(array_to_string(words[i + 1:i + {suffixes.MIN_WORDS}], ' ')) AS gram FROM (SELECT doc_id, words, unnest(range(0, len(words) - {suffixes.MIN_WORDS - 1})) AS i FROM d WHERE len(words) >= {suffixes.MIN_WORDS})),
    shared AS (SELECT gram FROM windows GROUP BY gram HAVING min(doc_id) <> max(doc_id)),
    hits AS (SELECT DISTINCT doc_id, i FROM windows SEMI JOIN shared USING (gram)),
    marked AS (SELECT *, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + {suffixes.MIN_WORDS} THEN 0 ELSE 1 END AS new FROM hits),
    runs AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked)
    SELECT doc_id, CAST(min(i) AS INTEGER) AS start, CAST(max(i) + {suffixes.MIN_WORDS} AS INTEGER) AS "end", CAST(max(i) + {suffixes.MIN_WORDS} - min(i) AS INTEGER) AS n_words FROM runs GROUP BY doc_id, run
"""

OP2 = """
    WITH c AS (SELECT conv_id, CAST(turn AS BIGINT) AS turn, role, text FROM conversations),
    calls AS (SELECT conv_id, turn, text, 'call_' || CASE WHEN conv_id % 5 = 1 THEN turn % 4 ELSE turn END AS call_id, CASE WHEN conv_id % 11 = 4 THEN NULL WHEN turn % 4 >= 2 THEN 'follow_up' ELSE 'answer' END AS name
              FROM c WHERE role = 'user' AND NOT (conv_id % 11 <> 4 AND conv_id % 7 = 2 AND turn IN (2, 3))),
    replies AS (SELECT conv_id, turn, text, CASE WHEN conv_id % 13 = 5 AND turn >= 4 THEN turn - 3 WHEN conv_id % 17 = 6 THEN turn + 1 ELSE turn - 1 END AS t FROM c WHERE role = 'assistant'),
    results AS (SELECT conv_id, turn, text, 'call_' || CASE WHEN conv_id % 5 = 1 THEN t % 4 ELSE t END AS call_id FROM replies),
    both_kinds AS (SELECT conv_id, call_id, turn, 1 AS one, text, name FROM calls UNION ALL SELECT conv_id, call_id, turn, 0, text, NULL FROM results),
    counted AS (SELECT *, CAST(sum(one) OVER (PARTITION BY conv_id, call_id ORDER BY turn) AS BIGINT) AS occurrence, max(one) OVER (PARTITION BY conv_id, call_id) AS any_call FROM both_kinds),
    first AS (SELECT conv_id, call_id, occurrence, min(turn) AS result_turn, arg_min(text, turn) AS content, count(*) AS n_results FROM counted WHERE one = 0 AND occurrence > 0 GROUP BY ALL),
    ready AS (SELECT k.*, k.turn < 2 AND k.conv_id % 10 = 3 AND d.turn IS NOT NULL AS waits FROM counted k LEFT JOIN calls d ON d.conv_id = k.conv_id AND d.turn = k.turn + 2 WHERE k.one = 1),
    placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY CASE WHEN waits THEN turn + 2 ELSE turn END, waits, turn) - 1 AS position FROM ready),
    checked AS (SELECT p.*, f.result_turn, f.content, f.n_results, CASE WHEN name IS NULL THEN '$: unknown tool' WHEN length(text) < 1 THEN '$.prompt: too short' WHEN name = 'follow_up' AND length(text) > 200 THEN '$.prompt: too long' ELSE '' END AS errors
                FROM placed p LEFT JOIN first f USING (conv_id, call_id, occurrence))
    SELECT conv_id, call_id, occurrence, CASE WHEN n_results IS NULL THEN 'unanswered' ELSE 'linked' END AS status, name, turn, CAST(0 AS INTEGER) AS place, result_turn, CAST(position AS BIGINT) AS position, false AS cyclic,
           coalesce(n_results, 0) AS n_results, CAST(1 AS BIGINT) AS copies, errors = '' AS valid, errors,
           '{"arguments":{"prompt":' || CAST(to_json(text) AS VARCHAR) || ',"turn":' || turn || '},"id":"' || call_id || '","name":' || coalesce('"' || name || '"', 'null') || ',"result":' || coalesce(CAST(to_json(content) AS VARCHAR), 'null') || '}' AS canonical
    FROM checked
    UNION ALL
    SELECT conv_id, call_id, k.occurrence, CASE WHEN any_call = 0 THEN 'orphan' WHEN k.occurrence = 0 THEN 'early' ELSE 'repeated' END, NULL, turn, 0, turn, NULL, false, 0, 1, NULL, NULL,
           '{"arguments":null,"id":"' || call_id || '","name":null,"result":' || CAST(to_json(text) AS VARCHAR) || '}'
    FROM counted k LEFT JOIN first f USING (conv_id, call_id, occurrence) WHERE one = 0 AND (f.result_turn IS NULL OR turn <> f.result_turn)
"""
