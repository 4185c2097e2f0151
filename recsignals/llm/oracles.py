"""DuckDB statements for the registered queries that SQL can express, written from the contracts."""

from __future__ import annotations

from recsignals.llm import op07_quality

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def url_filter(rules: list[tuple[str, str, str]], default: str) -> str:
    values = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in rules)
    return f"""
WITH cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, {_LOWER.format("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
rules(rule_host, rule_path, ruling) AS (VALUES {values}),
fit AS (SELECT page_id, rule_host || rule_path AS rule, ruling FROM parts JOIN rules
        ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)),
best AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(ruling, length(rule)) AS ruling FROM fit GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(ruling, '{default}') AS verdict FROM parts LEFT JOIN best USING (page_id)"""


DECONTAMINATE = rf"""
WITH bench AS (SELECT item_id, regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
wanted AS (SELECT item_id, least(len(w), 10) AS m, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS win
           FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM bench WHERE len(w) > 0)),
doc AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
have AS (SELECT doc_id, m, i, array_to_string(w[i : i + m - 1], ' ') AS win
         FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM doc, (SELECT DISTINCT m FROM wanted) WHERE len(w) >= m)),
hit AS (SELECT h.doc_id, h.i, h.m, b.item_id FROM have h JOIN wanted b ON h.m = b.m AND h.win = b.win),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(c.n, 0) AS n_hit, coalesce(i.n, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, c.n IS NOT NULL AS contaminated
FROM doc LEFT JOIN covered c USING (doc_id) LEFT JOIN items i USING (doc_id)"""


def _divergence(counts: list[str], total: str, shares: list[float]) -> str:
    terms = []
    for c, q in zip(counts, shares):
        p = f"(({c}) / CAST({total} AS DOUBLE))"
        terms.append(f"CASE WHEN ({c}) > 0 THEN 0.5 * {p} * log2(2 * {p} / ({p} + {q})) ELSE 0 END + 0.5 * {q} * log2(2 * {q} / ({p} + {q}))")
    return " + ".join(terms)


def quality(max_chars=0.025, max_words=op07_quality.NO_COMMON_WORD / 2, min_words_chars=10, min_words_words=60, short=0.3, short_words=25 * op07_quality.NO_COMMON_WORD) -> str:
    known = sorted({w for words in op07_quality.COMMON_WORDS.values() for w in words})
    counts = ", ".join(f"len(list_filter(lw, lambda x: x = '{w}')) AS \"c_{w}\"" for w in known)
    left = lambda chars: f"strlen(regexp_replace(t, '[^{chars}]+', '', 'g'))"
    classes = ["word_chars - up - marks", "up", "length(t) - word_chars", "marks - n_symbols", "n_symbols"]
    words = []
    for own in op07_quality.COMMON_WORDS.values():
        cols = [f'"c_{w}"' for w in own]
        words.append(_divergence([*cols, f"n_words - {' - '.join(cols)}"], "n_words", [*op07_quality.RANK_SHARES, 1 - sum(op07_quality.RANK_SHARES)]))
    return rf"""
WITH split AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i : i + 4], ' ') AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM split WHERE len(w) >= 5)),
twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
repeats AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY doc_id),
base AS (SELECT doc_id, t, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    {left('#*$%&|<>')} AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
    {left('A-Z')} AS up, {left(r'!-/:-@\[-`{-~')} AS marks, list_transform(w, lambda x: lower(x)) AS lw
  FROM split LEFT JOIN repeats r USING (doc_id)),
told AS (SELECT *, {counts}, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce((n_words >= {min_words_chars} AND {_divergence(classes, 'length(t)', op07_quality.CHAR_CLASSES)} > {max_chars} + {short} / n_words)
    OR (n_words >= {min_words_words} AND least({', '.join(words)}) > {max_words} + {short_words} / n_words), FALSE) AS kept
FROM told"""


JACCARD = rf"""
WITH RECURSIVE doc AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, array_to_string(w[i : i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM doc WHERE len(w) >= 5)
    UNION ALL SELECT doc_id, array_to_string(w, ' ') AS g FROM doc WHERE len(w) BETWEEN 1 AND 4)),
size AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT pair.a, pair.b FROM pair JOIN size x ON x.doc_id = pair.a JOIN size y ON y.doc_id = pair.b WHERE 100 * k >= 75 * (x.n + y.n - k)),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a)
SELECT doc_id, coalesce(size.n, 0) AS n_shingles, least(doc_id, coalesce(m.low, doc_id)) AS component_id
FROM doc LEFT JOIN size USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY a) m USING (doc_id)"""


def phrases(least=100, top=2000) -> str:
    texts = ", ".join(f"array_to_string(w[i : i + {k - 1}], ' ')" for k in range(1, 6))
    return rf"""
WITH piece AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
words AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM piece),
gram AS (SELECT lang, k, [{texts}][k] AS phrase FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, range(1, 6) AS t(k) WHERE len(w) >= k)),
f AS (SELECT lang, phrase, any_value(k) AS k, count(*) AS a FROM gram GROUP BY lang, phrase HAVING count(*) >= {least}),
total AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang),
cand AS (SELECT lang, phrase, k, a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2),
inner_part AS (SELECT lang, a, array_to_string(w[i : i + m - 1], ' ') AS phrase
    FROM (SELECT lang, a, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM cand, range(2, 5) AS t(m) WHERE m < k)),
kept AS (SELECT * FROM cand c WHERE NOT EXISTS (SELECT 1 FROM inner_part p WHERE p.lang = c.lang AND p.phrase = c.phrase AND 100 * p.a >= 100 * c.a)),
cut AS (SELECT c.lang, c.phrase, c.a, j, x.a AS l, y.a AS r, CAST(total.n AS HUGEINT) AS n
    FROM (SELECT *, unnest(range(1, k)) AS j FROM kept) c JOIN total USING (lang)
    JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : j], ' ') JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[j + 1 : c.k], ' ')),
scored AS (SELECT lang, phrase, a, l, r, n, 1000 * CAST(a AS HUGEINT) * n // (CAST(l AS HUGEINT) * r) AS score, j FROM cut),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM weakest) WHERE rank <= {top}"""


def vector_codes(parts=8, entries=16, rounds=6) -> str:
    """Every round is two steps: the nearest entry of each part, then each entry's mean, rounded down."""
    steps = []
    for r in range(1, rounds + 2):
        steps.append(f"""
near{r} AS MATERIALIZED (SELECT rid, part, any_value(x) AS x, min(struct_pack(d := list_sum([(x[i] - c[i]) * (x[i] - c[i]) FOR i IN range(1, len(x) + 1)]), e := e)) AS b
    FROM p JOIN book{r - 1} USING (part) GROUP BY rid, part)""")
        if r <= rounds:
            steps.append(f"""
sums{r} AS MATERIALIZED (SELECT part, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM (
    SELECT part, b.e AS e, i, sum(x[i]) AS s, count(*) AS n FROM (SELECT part, b, x, unnest(range(1, len(x) + 1)) AS i FROM near{r}) GROUP BY ALL) GROUP BY part, e),
book{r} AS MATERIALIZED (SELECT o.part, o.e, coalesce(s.c, o.c) AS c FROM book{r - 1} o LEFT JOIN sums{r} s ON s.part = o.part AND s.e = o.e)""")
    return f"""
WITH q AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, label, [CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT rid, part, v[part * (len(v) // {parts}) + 1 : (part + 1) * (len(v) // {parts})] AS x FROM q, range({parts}) AS t(part)),
seed AS (SELECT rid, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM q QUALIFY e < {entries}),
book0 AS MATERIALIZED (SELECT part, e, x AS c FROM p JOIN seed USING (rid)),{",".join(steps)},
code AS (SELECT rid, string_agg(lower(lpad(to_hex(b.e), 2, '0')), '' ORDER BY part) AS code, sum(b.d) AS error FROM near{rounds + 1} GROUP BY rid),
whole AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, e)) AS h FROM book{rounds}),
labelled AS (SELECT label, sum(error) AS total FROM q JOIN code USING (rid) GROUP BY label)
SELECT vec_id, code, CAST(error AS BIGINT) AS error, CAST(total AS BIGINT) AS label_error, h AS codebooks_sha256
FROM q JOIN code USING (rid) JOIN labelled l ON l.label IS NOT DISTINCT FROM q.label, whole"""
