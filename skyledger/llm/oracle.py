"""SQL for the queries that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce({column}, ''), '[^\x20\x09-\x0D]+')"


def _words(column: str) -> str:
    return _WORDS.format(column=column)


OP3 = f"""
WITH d AS (SELECT doc_id, {_words("text")} AS w FROM documents),
word AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d),
win AS (
    SELECT doc_id, unnest(generate_series(1, len(w) - 49)) AS pos, w FROM d WHERE len(w) >= 50
),
hashed AS (SELECT doc_id, pos, list_slice(w, pos, pos + 49) AS seq FROM win),
least_id AS (SELECT doc_id, pos, min(doc_id) OVER (PARTITION BY seq) AS first_id FROM hashed),
gone AS (
    SELECT DISTINCT doc_id, unnest(generate_series(pos, pos + 49)) AS pos FROM least_id WHERE first_id < doc_id
),
marked AS (
    SELECT word.doc_id, word.word, word.pos, gone.pos IS NOT NULL AS removed
    FROM word LEFT JOIN gone ON gone.doc_id = word.doc_id AND gone.pos = word.pos
),
cut AS (
    SELECT doc_id, count(*) AS n_words, count(*) FILTER (removed) AS n_removed,
        coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (NOT removed), '') AS kept
    FROM marked GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
    sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN cut ON cut.doc_id = d.doc_id
"""


OP1 = rf"""
WITH RECURSIVE d AS (
    SELECT doc_id, {_words("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents
),
shingle AS (
    SELECT DISTINCT doc_id, seq FROM (
        SELECT doc_id, list_slice(w, pos, pos + 3) AS seq
        FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 3, 1))) AS pos FROM d WHERE len(w) > 0)
    )
),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
    FROM shingle a JOIN shingle b ON a.seq = b.seq AND a.doc_id < b.doc_id GROUP BY ALL
),
link AS (
    SELECT x, y FROM common JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y
    WHERE 100 * common.n >= 85 * (p.n + q.n - common.n)
),
both_ways AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM d
    UNION
    SELECT reach.doc_id, both_ways.y FROM reach JOIN both_ways ON both_ways.x = reach.other
)
SELECT d.doc_id, coalesce(size.n, 0) AS n_shingles, c.component_id
FROM d LEFT JOIN size ON size.doc_id = d.doc_id
JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) c ON c.doc_id = d.doc_id
"""

OP4 = """
WITH parts AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
),
cut AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
    FROM parts
),
rules(action, rule_host, rule_path) AS (
    VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
),
hit AS (
    SELECT page_id, rule_host || rule_path AS rule, action,
        row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC) AS place
    FROM cut JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT cut.page_id, host, path, rule, coalesce(action, 'allow') AS verdict
FROM cut LEFT JOIN hit ON hit.page_id = cut.page_id AND place = 1
"""

# Every maximal repeat of ten words or more is a chain of windows of ten words that occur twice,
# so their union covers the same words; one of more than 100 words holds a repeated window of 101.
_TWICE = """
    SELECT doc_id, pos FROM (
        SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, hash(list_slice(w, pos, pos + {width} - 1))) AS times
        FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - {width} + 1)) AS pos FROM {table} WHERE len(w) >= {width})
    ) WHERE times > 1
"""
_COVERED = "SELECT doc_id, count(DISTINCT pos + k) AS n FROM {table}, range({width}) AS r(k) GROUP BY doc_id"

OP7 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_words("text")} AS w FROM documents),
three AS ({_TWICE.format(width=3, table="d")}),
ten AS ({_TWICE.format(width=10, table="d")}),
looped AS (SELECT * FROM d WHERE doc_id IN (SELECT doc_id FROM ten GROUP BY doc_id HAVING count(*) >= 92)),
long AS (SELECT DISTINCT doc_id FROM ({_TWICE.format(width=101, table="looped")})),
repeat_words AS ({_COVERED.format(table="three", width=3)}),
covered AS ({_COVERED.format(table="ten", width=10)}),
line AS (
    SELECT doc_id, count(*) - count(DISTINCT line) AS n
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
),
base AS (
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        coalesce(line.n, 0) AS n_dup_lines, coalesce(repeat_words.n, 0) AS n_repeat_words,
        coalesce(covered.n, 0) AS n_covered, long.doc_id IS NOT NULL AS too_long
    FROM d LEFT JOIN line USING (doc_id) LEFT JOIN repeat_words USING (doc_id) LEFT JOIN covered USING (doc_id) LEFT JOIN long USING (doc_id)
),
failed AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND 10 * n_covered <= 3 * n_words AND NOT too_long AS kept
FROM failed
"""

ORACLE_SQL: dict[str, str] = {"op1_ngram_jaccard_join": OP1, "op3_substring_dedup": OP3, "op4_url_filters": OP4, "op7_quality_rules": OP7}

ORACLE_SQL["op12_phrase_collocations"] = """
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
        unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents
), worded AS (
    SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM pieces
), grams AS (
    SELECT lang, unnest(words) AS phrase, 1 AS size FROM worded
    UNION ALL SELECT lang, unnest(list_transform(range(1, len(words)), lambda k: words[k] || ' ' || words[k + 1])), 2 FROM worded
    UNION ALL SELECT lang, unnest(list_transform(range(1, len(words) - 1), lambda k: words[k] || ' ' || words[k + 1] || ' ' || words[k + 2])), 3 FROM worded
), counts AS MATERIALIZED (
    SELECT lang, size, phrase, lang || chr(10) || phrase AS name, count(*) AS f FROM grams GROUP BY ALL
), totals AS (
    SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE size = 1 GROUP BY lang
), candidates AS MATERIALIZED (
    SELECT *, string_split(phrase, ' ') AS words, lang || chr(10) AS start FROM counts WHERE size > 1 AND f >= 10
), halves AS (
    SELECT lang, phrase, f AS a, 1 AS k, start || words[1] AS head, start || array_to_string(words[2:], ' ') AS tail FROM candidates
    UNION ALL SELECT lang, phrase, f, 2, start || words[1] || ' ' || words[2], start || words[3] FROM candidates WHERE size = 3
), cuts AS (
    SELECT h.lang, h.phrase, a, k, x.f AS l, y.f AS r, (1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS score
    FROM halves h JOIN counts x ON x.name = h.head JOIN counts y ON y.name = h.tail
), lowest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), around AS (
    SELECT lang, phrase, max(f) AS f FROM (
        SELECT lang, words[1] || ' ' || words[2] AS phrase, f FROM candidates WHERE size = 3
        UNION ALL SELECT lang, words[2] || ' ' || words[3], f FROM candidates WHERE size = 3
    ) GROUP BY lang, phrase
), named AS (
    SELECT lang, phrase, a, l, r, score::BIGINT AS score FROM lowest LEFT JOIN around USING (lang, phrase) WHERE f IS NULL OR 100 * f < 50 * a
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM named
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


def _vector_codes(rounds: int = 4, entries: int = 256) -> str:
    """Whole numbers below 2**21 have exact distances in doubles."""
    with_nearest = """, near{r} AS MATERIALIZED (
    SELECT row, part, min({{'d': v2 - 2 * list_dot_product(v, c) + c2, 'e': entry}}) AS best
    FROM cut JOIN (SELECT *, list_dot_product(c, c) AS c2 FROM book{r}) USING (part) GROUP BY row, part
)"""
    with_book = """, book{n} AS MATERIALIZED (
    SELECT part, entry, coalesce(next.c, old.c) AS c FROM book{r} old LEFT JOIN (
        SELECT part, entry, list(((total - ((total % n) + n) % n) // n)::DOUBLE ORDER BY place) AS c FROM (
            SELECT part, entry, place, sum(x)::BIGINT AS total, count(*) AS n FROM (
                SELECT part, best.e AS entry, unnest(v)::BIGINT AS x, generate_subscripts(v, 1) AS place FROM near{r} JOIN cut USING (row, part)
            ) GROUP BY ALL
        ) GROUP BY part, entry
    ) next USING (part, entry)
)"""
    chain = "".join(with_nearest.format(r=r) + with_book.format(r=r, n=r + 1) for r in range(rounds)) + with_nearest.format(r=rounds)
    return f"""
WITH kept AS (
    SELECT vec_id, label, row_number() OVER (ORDER BY vec_id, embedding) AS row, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v, len(embedding) // 4 AS width
    FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), sliced AS (
    SELECT row, part, list_slice(v, part * width + 1, part * width + width)::DOUBLE[] AS v FROM kept, range(4) AS parts(part)
), cut AS MATERIALIZED (
    SELECT *, list_dot_product(v, v) AS v2 FROM sliced
), book0 AS MATERIALIZED (
    SELECT part, row - 1 AS entry, v AS c FROM cut WHERE row <= {entries}
){chain}, coded AS (
    SELECT row, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error FROM near{rounds} GROUP BY row
), flat AS (
    SELECT part, entry, unnest(c)::BIGINT AS x, generate_subscripts(c, 1) AS place FROM book{rounds}
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
    (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, place)) FROM flat) AS codebooks_sha256
FROM coded JOIN kept USING (row)
"""


ORACLE_SQL["op13_vector_codes"] = _vector_codes()
