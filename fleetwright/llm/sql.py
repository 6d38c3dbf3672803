"""SQL equivalents of the corpus queries that SQL can express."""

ORACLE: dict[str, str] = {}

ORACLE["op8_quality_rules"] = r"""
WITH words AS (
    SELECT doc_id, coalesce(text, '') AS body,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda line: regexp_matches(line, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
), windows AS (
    SELECT *, list_transform(range(1, greatest(len(w) - 3, 1)),
                             lambda i: array_to_string(w[i:i + 4], ' ')) AS g
    FROM words
), counted AS (
    SELECT *, map_entries(list_histogram(g)) AS h FROM windows
), starts AS (
    SELECT *, map_from_entries(list_filter(h, lambda e: e.value > 1)) AS again FROM counted
), found AS (
    SELECT *, list_filter(range(1, len(g) + 1), lambda i: map_contains(again, g[i])) AS s FROM starts
), measured AS (
    SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
           length(regexp_replace(body, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
           len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
           coalesce(list_sum(list_transform(range(1, len(s)), lambda k: least(5, s[k + 1] - s[k]))), 0)
               + CASE WHEN len(s) > 0 THEN 5 ELSE 0 END AS n_repeat_words
    FROM found
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
       n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words
            OR 100 * n_symbols > 30 * n_words OR 100 * n_dup_lines > 30 * n_lines
            OR word_chars < 2 * n_words OR word_chars > 12 * n_words) AS kept
FROM measured
"""

ORACLE["op12_lexical"] = r"""
WITH words AS (
    SELECT doc_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents
), wanted AS (
    SELECT item_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), asked AS (
    SELECT item_id, term, count(*) AS times FROM wanted GROUP BY ALL
), lengths AS (
    SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id
), corpus AS (
    SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM lengths
), held AS (
    SELECT doc_id, term, count(*) AS tf FROM words
    WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term
), weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM held CROSS JOIN corpus GROUP BY term
), norms AS (
    SELECT doc_id, 75 + (25 * n * docs) // total AS m FROM lengths CROSS JOIN corpus
), scored AS (
    SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
    FROM asked JOIN held USING (term) JOIN weights USING (term) JOIN norms USING (doc_id)
    GROUP BY item_id, doc_id
), ranked AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place, doc_id, score
    FROM scored WHERE score > 0
)
SELECT item_id, place::INTEGER AS rank, doc_id, score FROM ranked WHERE place <= 20
"""
