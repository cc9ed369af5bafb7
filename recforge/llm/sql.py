"""SQL for the queries that SQL can express, over the whole table.

The quality query's verdict doesn't depend on the order of its rules, so all of
it is plain arithmetic on words and lines; the archives' rows follow from payloads
and page ids; the audit runs every order of its filters on counts by failed
filters.  The others need a tokenizer, XXH64,
a trained model, tiling or checksums, or every 200-byte window; tests hold
them against brute force.
"""

ORACLE = {
    "op3_quality": r"""
WITH docs AS (
    SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
), words AS (
    SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs
), grams AS (
    SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
    FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM words)
), repeats AS (
    SELECT rid, count(DISTINCT i + k) AS n
    FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM grams), (SELECT unnest([0, 1, 2]) AS k)
    WHERE c > 1 GROUP BY rid
), lines AS (
    SELECT rid, count(*) AS n, count(*) - count(DISTINCT l) AS dup
    FROM (SELECT rid, unnest(string_split(text, chr(10))) AS l FROM docs)
    WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY rid
), measured AS (
    SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
           coalesce(l.dup, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
           coalesce(l.n, 0) AS n_lines,
           len(list_filter(w, lambda x: regexp_matches(x, '[^\x00-\x40\x5B-\x60\x7B-\x7F]'))) AS n_lettered
    FROM docs d JOIN words USING (rid) LEFT JOIN lines l USING (rid) LEFT JOIN repeats r USING (rid)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 100 * n_symbols > 30 * n_words
            OR 100 * n_dup_lines > 30 * n_lines OR word_chars < 2 * n_words OR word_chars > 20 * n_words
            OR 2 * n_lettered < n_words) AS kept
FROM measured
""",
    "op12_warc": """
WITH ranked AS (
    SELECT page_id, coalesce(html, '') AS h, row_number() OVER same AS n, first_value(page_id) OVER same AS last_id
    FROM pages WINDOW same AS (PARTITION BY coalesce(html, '') ORDER BY page_id DESC NULLS LAST, url DESC NULLS LAST)
), judged AS (
    SELECT *, strlen(h) >= 1000 AND n > 1 AS again FROM ranked
)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN last_id END AS refers_to
FROM judged
""",
    "op13_audit": r"""
WITH docs AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), marks AS (
    SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), judged AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
           (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
           + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text))::INT
           + 8 * regexp_matches(text, '[#$%&*|]')::INT
           + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)::INT AS fails
    FROM docs LEFT JOIN marks USING (doc_id)
), counted AS (
    SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM judged GROUP BY part, fails
), letters AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l, unnest([1, 2, 4, 8, 16]) AS bit
), orders AS (
    SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31
), steps AS (
    SELECT filter_order, step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
    FROM (SELECT *, unnest([1, 2, 3, 4, 5]) AS step FROM orders)
), figures AS (
    SELECT part, filter_order, step, own,
           coalesce(sum(n) FILTER (fails & (before | own) = 0), 0)::BIGINT AS kept,
           coalesce(sum(n) FILTER (fails & before = 0 AND fails & own > 0), 0)::BIGINT AS removed,
           coalesce(sum(n) FILTER (fails & before > 0 AND fails & own > 0), 0)::BIGINT AS redundant,
           coalesce(sum(n) FILTER (fails = own), 0)::BIGINT AS unique_fails,
           coalesce(sum(good) FILTER (fails & before = 0 AND fails & own > 0), 0)::BIGINT AS good_lost,
           coalesce(sum(toxic) FILTER (fails & before = 0 AND fails & own > 0), 0)::BIGINT AS toxic_lost
    FROM counted, steps GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM figures
""",
}
