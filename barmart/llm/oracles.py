"""The same results as SQL, for the operators that SQL can express; words are found with one pattern throughout."""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

JACCARD = rf"""
WITH RECURSIVE docs AS (
    SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS s
    FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM docs WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
    JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, x.n, y.n
    HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, r.component_id
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) r USING (doc_id)
"""

TOP_K = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
    SELECT vec_id, unnest(v) AS x, unnest(generate_series(1, len(v))) AS i FROM v
), scores AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
    FROM parts q JOIN parts c ON q.i = c.i AND q.vec_id <> c.vec_id
    WHERE q.vec_id % 50 = 0 GROUP BY ALL
)
SELECT query_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id, score FROM scores
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER best <= 5
"""

MIX = rf"""
WITH sized AS (
    SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size FROM documents
), sources AS (
    SELECT source, sum(size) AS s, row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS sid FROM sized GROUP BY source
), weighed AS (
    SELECT *, CASE sid % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM sources
), running AS (
    SELECT *, sum(s) OVER () AS total,
        coalesce(sum(3 * s) OVER earlier, 0) AS spent,
        sum(w) OVER () - coalesce(sum(w) OVER earlier, 0) AS open
    FROM weighed
    WINDOW earlier AS (ORDER BY s / w, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), stopped AS (
    SELECT *, (total - spent) * w > 3 * s * open AS stops FROM running
), first_free AS (
    SELECT spent, open FROM stopped WHERE NOT stops ORDER BY spent, open LIMIT 1
), targets AS (
    SELECT source, sid % 3 * 0.5::DOUBLE - 0.5::DOUBLE AS slope, CAST(s AS BIGINT) AS s, CASE WHEN stops THEN CAST(3 * s AS DOUBLE)
        ELSE CAST(w * (total - (SELECT spent FROM first_free)) AS DOUBLE) / CAST((SELECT open FROM first_free) AS DOUBLE)
        END AS target
    FROM stopped
), placed AS (
    SELECT d.doc_id, d.size, t.s, t.target, t.slope, CAST(floor(t.target + 0.5) AS BIGINT) AS want,
        coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(CAST(d.doc_id AS VARCHAR)), d.doc_id, d.size
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), mixed AS (
    SELECT *, CAST(CASE WHEN s = 0 THEN 0
        ELSE want // s * size + greatest(0, least(want - want // s * s - before, size)) END AS BIGINT) AS taken
    FROM placed
), timed AS (
    SELECT *, CASE WHEN taken > 0 THEN least((CAST(before AS DOUBLE) + CAST(size AS DOUBLE) / 2) / target, 1) END AS y FROM mixed
)
SELECT doc_id, size, s AS source_size, target, taken, CASE WHEN slope = 0 THEN y
    ELSE (sqrt((1 - slope) * (1 - slope) + 4 * slope * y) - (1 - slope)) / (2 * slope) END AS position
FROM timed
"""

REPEATS = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents
), windows AS (
    SELECT r, i, sha256(array_to_string(w[i:i + 34], ' ')) AS h
    FROM (SELECT r, w, unnest(generate_series(1, len(w) - 34)) AS i FROM docs WHERE len(w) >= 35)
), twice AS (
    SELECT h FROM windows GROUP BY h HAVING count(*) > 1
), gone AS (
    SELECT DISTINCT r, i + k AS i FROM (SELECT r, i FROM windows SEMI JOIN twice USING (h)), generate_series(0, 34) AS g(k)
), words AS (
    SELECT r, unnest(w) AS word, unnest(generate_series(1, len(w))) AS i FROM docs
), kept AS (
    SELECT r, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n FROM words ANTI JOIN gone USING (r, i) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
"""

_UPPER, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = "'(?s)^.*?://([^/?#]*)([^?#]*)'"


def _order(k: int, order: int) -> str:
    """One level of the Witten-Bell mixture: contexts of k characters."""
    mix = ", ".join(
        f"CASE WHEN coalesce(n{c}, 0) > 0 THEN (coalesce({c}, 0) + t{c} * p{c}) / (n{c} + t{c}) ELSE p{c} END AS p{c}" for c in "ar"
    )
    return f"""own{k} AS (
    SELECT right(g, {k + 1}) AS tail, sum(a) AS a, sum(r) AS r FROM counts GROUP BY 1
), context{k} AS (
    SELECT left(tail, {k}) AS context, sum(a) AS na, sum(r) AS nr, count(*) FILTER (a > 0) AS ta, count(*) FILTER (r > 0) AS tr
    FROM own{k} GROUP BY 1
), mixed{k} AS (
    SELECT w.g, {mix}
    FROM {f"mixed{k - 1}" if k else "evenly"} w LEFT JOIN own{k} o ON o.tail = right(w.g, {k + 1})
    LEFT JOIN context{k} c ON c.context = substr(w.g, {order - k + 1}, {k})
), """


def _grams(order: int) -> str:
    return f"substr(repeat(chr(2), {order}) || text || chr(3), unnest(generate_series(1, length(text) + 1)), {order + 1})"


URLS = f"""
WITH parsed AS (
    SELECT page_id, translate(coalesce(regexp_extract(url, {_URL}, 1), ''), '{_UPPER}', '{_LOW}') AS host,
        coalesce(regexp_extract(url, {_URL}, 2), '') AS path, coalesce(url, '') AS url,
        coalesce(regexp_extract(url, '(?s)^(.*?://)', 1), '') AS scheme
    FROM pages
), ruled AS (
    SELECT *, CASE WHEN scheme = '' THEN url ELSE scheme || host || substr(url, length(scheme) + length(host) + 1) END AS text, CASE
        WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
        WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
        WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
        WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
    FROM parsed
), known AS (
    SELECT text, rule IN ('example.net/en/', 'org/fr/') AS accepted, count(*) AS n, substr(md5(text), 1, 1) < '3' AS held
    FROM ruled WHERE rule IS NOT NULL GROUP BY ALL
), texts AS (
    SELECT text FROM ruled WHERE rule IS NULL UNION SELECT text FROM known WHERE held
), counts AS (
    SELECT g, coalesce(sum(n) FILTER (accepted), 0) AS a, coalesce(sum(n) FILTER (NOT accepted), 0) AS r
    FROM (SELECT accepted, n, {_grams(4)} AS g FROM known WHERE NOT held) GROUP BY g
), cut AS (
    SELECT text, {_grams(4)} AS g FROM texts
), evenly AS (
    SELECT DISTINCT g, CAST(1.0 / 256 AS DOUBLE) AS pa, CAST(1.0 / 256 AS DOUBLE) AS pr FROM cut
), {"".join(_order(k, 4) for k in range(5))}scores AS (
    SELECT text, CAST(floor(CAST(sum(ratio) AS DOUBLE) / count(*)) AS BIGINT) AS score
    FROM cut JOIN (SELECT g, CAST(round((ln(pa) - ln(pr)) * 1000000) AS BIGINT) AS ratio FROM mixed4) USING (g) GROUP BY text
), steps AS (
    SELECT greatest(-512, least(512, floor(score * 64 / 1000000))) AS step, accepted, n FROM known JOIN scores USING (text) WHERE held
), tried AS (
    SELECT t, (SELECT sum(n) FROM steps WHERE accepted) AS good, (SELECT sum(n) FROM steps WHERE NOT accepted) AS bad,
        (SELECT coalesce(sum(n), 0) FROM steps WHERE accepted AND step < t) AS low_good,
        (SELECT coalesce(sum(n), 0) FROM steps WHERE NOT accepted AND step < t) AS low_bad
    FROM generate_series(-512, 512) AS s(t)
), best AS (
    SELECT t FROM tried
    WHERE good > 0 AND bad > 0 QUALIFY rank() OVER (ORDER BY low_good * bad + (bad - low_bad) * good) = 1
), chosen AS (
    SELECT coalesce(max(floor(t * 1000000 / 64)), 0) AS threshold
    FROM (SELECT t, row_number() OVER (ORDER BY t) - 1 AS place, count(*) OVER () AS many FROM best) WHERE place = many // 2
)
SELECT page_id, host, path, rule, CASE rule WHEN 'net/' THEN 'block' WHEN 'example.com/de/' THEN 'block'
    WHEN 'example.net/en/' THEN 'allow' WHEN 'org/fr/' THEN 'allow'
    ELSE CASE WHEN score < (SELECT threshold FROM chosen) THEN 'block' ELSE 'allow' END END AS verdict
FROM ruled LEFT JOIN scores USING (text)
"""

_DIMS = range(4)


def _squared() -> str:
    """Squared distance of z* from mean m* and Cholesky factor l**: forward substitution."""
    solved: list[str] = []
    for i in _DIMS:
        value = f"z{i} - m{i}" + "".join(f" - l{i}{j} * ({solved[j]})" for j in range(i))
        solved.append(f"({value}) / l{i}{i}")
    return " + ".join(f"({y}) * ({y})" for y in solved)


def _concentrate(step: int, floors: tuple[float, ...]) -> str:
    """One step: the closest three quarters of each group, their moments, and the factor of their covariance."""
    sums = ", ".join(
        [f"sum(CAST(z{i} AS DOUBLE)) AS s{i}" for i in _DIMS]
        + [f"sum(CAST(z{i} * z{j} AS DOUBLE)) AS p{i}{j}" for i in _DIMS for j in range(i + 1)]
    )
    levels, source = [], f"moments{step}"
    for i in _DIMS:
        for j in range(i + 1):
            value = f"p{i}{j} / n - m{i} * m{j}" + "".join(f" - l{i}{k} * l{j}{k}" for k in range(j))
            value = f"sqrt(greatest({value}, 0) + {(floors[i] * 1024) ** 2!r}::DOUBLE)" if i == j else f"({value}) / l{j}{j}"
            levels.append(f"factor{step}_{i}{j} AS (SELECT *, {value} AS l{i}{j} FROM {source})")
            source = f"factor{step}_{i}{j}"
    return f"""binned{step} AS (
    SELECT *, CAST(floor(ln(1 + {_squared()}) * 64) AS BIGINT) AS bin FROM placed JOIN estimate{step} USING (key)
), edges{step} AS (
    SELECT key, start, quantile_cont(bin, 0.75) AS edge FROM binned{step} GROUP BY key, start
), sums{step} AS (
    SELECT key, start, count(*) AS n, {sums} FROM binned{step} JOIN edges{step} USING (key, start) WHERE bin <= edge
    GROUP BY key, start
), moments{step} AS (
    SELECT *, {", ".join(f"s{i} / n AS m{i}" for i in _DIMS)} FROM sums{step}
), {", ".join(levels)}, estimate{step + 1} AS MATERIALIZED (SELECT {_ESTIMATE} FROM {source}), """


_STEPS = 6
_ESTIMATE = ", ".join(["key", "start", *(f"m{i}" for i in _DIMS), *(f"l{i}{j}" for i in _DIMS for j in range(i + 1))])
_FLOORS = (0.08, 0.25, 0.15, 0.15)
_START = ", ".join(
    [f"quantile_cont(z{i}, [0.25, 0.5, 0.75])[start + 1] AS m{i}" for i in _DIMS]
    + [
        f"greatest((quantile_cont(z{i}, 0.75) - quantile_cont(z{i}, 0.25)) / 1.349::DOUBLE, {_FLOORS[i] * 1024!r}::DOUBLE) AS l{i}{j}"
        if i == j
        else f"CAST(0 AS DOUBLE) AS l{i}{j}"
        for i in _DIMS
        for j in range(i + 1)
    ]
)

QUALITY = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce('+' || lang, '-') AS lang,
        coalesce('+' || lang, '-') || chr(1) || coalesce('+' || source, '-') AS own, coalesce(text, '') AS text,
        {_WORDS} AS w
    FROM documents
), windows AS (
    SELECT r, i, w[i:i + 2] AS k FROM (SELECT r, w, unnest(generate_series(1, len(w) - 2)) AS i FROM docs WHERE len(w) > 2)
), again AS (
    SELECT r, count(DISTINCT i + j) AS n FROM (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, k) > 1),
        generate_series(0, 2) AS s(j) GROUP BY r
), counted AS (
    SELECT r, doc_id, lang, own, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ 	-
]')) AS lines,
        CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
    FROM docs LEFT JOIN again USING (r)
), statistics AS (
    SELECT * EXCLUDE (lines), CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, len(lines) AS n_lines,
        n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
    FROM counted
), vectors AS (
    SELECT *, CAST(round(ln(greatest(word_chars, 1) / greatest(n_words, 1)) * 1024) AS BIGINT) AS z0,
        CAST(round(ln(1 + 100 * n_symbols / greatest(word_chars, 1)) * 1024) AS BIGINT) AS z1,
        CAST(round(n_dup_lines / greatest(n_lines, 1) * 1024) AS BIGINT) AS z2,
        CAST(round(n_repeat_words / greatest(n_words, 1) * 1024) AS BIGINT) AS z3
    FROM statistics
), sizes AS (
    SELECT own, CASE WHEN count(*) >= 50 THEN own ELSE lang END AS key, count(*) AS n FROM vectors WHERE NOT base_failed GROUP BY own, lang
), keys AS (
    SELECT own, CASE WHEN sum(n) OVER (PARTITION BY key) >= 50 THEN key ELSE '*' END AS key FROM sizes
), placed AS MATERIALIZED (
    SELECT key, z0, z1, z2, z3 FROM vectors JOIN keys USING (own) WHERE NOT base_failed
), estimate0 AS (
    SELECT key, start, {_START} FROM placed, (SELECT unnest([0, 1, 2]) AS start) GROUP BY key, start
), {"".join(_concentrate(k, _FLOORS) for k in range(_STEPS))}best AS (
    SELECT * FROM estimate{_STEPS} QUALIFY row_number() OVER (PARTITION BY key ORDER BY l00 * l11 * l22 * l33, start) = 1
), halves AS (
    SELECT key, greatest(1, (exp(quantile_cont(CAST(floor(ln(1 + {_squared()}) * 64) AS BIGINT), 0.5) / 64) - 1) / 3.357::DOUBLE)
        * 28.47::DOUBLE AS cutoff
    FROM placed JOIN best USING (key) GROUP BY key
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND NOT coalesce({_squared()} > cutoff, FALSE) AS kept
FROM vectors LEFT JOIN (SELECT * FROM keys JOIN best USING (key) JOIN halves USING (key)) USING (own)
"""

#: CRC-32 (polynomial 3988292384, reflected) of a text of characters below U+0800, byte by byte.
_CRC = """crc AS (
    SELECT list_transform(range(256), lambda i: list_reduce(range(8),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS steps
)"""


def _crc32(text: str) -> str:
    letters = f"list_transform(string_split({text}, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [192 + (unicode(c)::BIGINT >> 6), 128 + (unicode(c)::BIGINT & 63)] END)"
    turned = f"list_reduce(flatten({letters}), lambda a, b: xor(a >> 8, steps[1 + (xor(a, b) & 255)]), 4294967295)"
    return f"xor({turned}, 4294967295)"


SPELLING = rf"""
WITH RECURSIVE {_CRC}, runs AS (
    SELECT doc_id, run, count(*) AS n FROM (
        SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents
    ) GROUP BY doc_id, run
), checked AS (
    SELECT run, n, {_crc32("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM runs, crc
), words AS (
    SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
        CAST(sum(n) AS BIGINT) AS n
    FROM checked GROUP BY word HAVING length(word) >= 5 AND sum(n) >= 3
), cut AS (
    SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
    FROM (SELECT word, unnest(generate_series(1, length(word))) AS i FROM words)
), near AS (
    SELECT a.word, b.word AS other FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT a.word, b.word FROM cut a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, a.word FROM cut a JOIN words b ON a.rest = b.word
), best AS (
    SELECT near.word, count(*) OVER (PARTITION BY near.word) AS n_near, other, o.n AS other_n
    FROM near JOIN words o ON o.word = other
    QUALIFY row_number() OVER (PARTITION BY near.word ORDER BY o.n DESC, other) = 1
), judged AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near,
        CASE WHEN other_n >= 2 * n THEN other END AS form, CASE WHEN other_n >= 2 * n THEN other_n END AS form_n
    FROM words LEFT JOIN best USING (word)
), walk AS (
    SELECT word, word AS seen FROM words
    UNION ALL SELECT walk.word, form FROM walk JOIN judged ON judged.word = seen WHERE form IS NOT NULL
)
SELECT j.word, j.n, j.n_near, j.form, j.form_n, seen AS root
FROM judged j JOIN walk ON walk.word = j.word JOIN judged last ON last.word = seen AND last.form IS NULL
"""

TRIE = rf"""
WITH {_CRC}, turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id
        ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT conv_id, conv_id - conv_id % 20 AS base, {_crc32("CAST(conv_id AS VARCHAR)")} % 4 AS h
    FROM (SELECT DISTINCT conv_id FROM turns), crc
), based AS (
    SELECT c.*, least(h, (SELECT count(*) FROM turns WHERE turns.conv_id = c.base)) AS taken FROM convs c
), rebuilt AS (
    SELECT c.conv_id, place AS pos, role, text FROM based c JOIN turns t ON t.conv_id = c.base AND place <= taken
    UNION ALL SELECT c.conv_id, place - h + taken, role, text FROM based c JOIN turns t ON t.conv_id = c.conv_id AND place > h
), sequences AS (
    SELECT c.conv_id, coalesce(list({{'role': role, 'text': text}} ORDER BY pos) FILTER (pos IS NOT NULL), []) AS turns
    FROM based c LEFT JOIN rebuilt r ON r.conv_id = c.conv_id GROUP BY c.conv_id
), members AS (
    SELECT conv_id, len(turns) AS total, d AS depth, turns[1:d] AS path FROM sequences, unnest(range(0, len(turns) + 1)) AS u(d)
), nodes AS (
    SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (total = depth), '')) AS ends_sha256
    FROM members GROUP BY path, depth
), children AS (
    SELECT path[1:depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL
), valued AS (
    SELECT nodes.*, coalesce(n, 0) AS n_children, CASE WHEN depth = 0 THEN 0
        ELSE (n_convs - 1) * len(regexp_extract_all(path[depth].text, '[^\x20\x09-\x0D]+')) END AS own
    FROM nodes LEFT JOIN children USING (path)
), subtrees AS (
    SELECT path[1:d] AS path, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum(own) AS BIGINT) AS saved_tokens
    FROM valued, unnest(range(0, depth + 1)) AS u(d) GROUP BY ALL
)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, n_leaves, saved_tokens, v.ends_sha256
FROM valued v JOIN subtrees USING (path) LEFT JOIN nodes p ON v.depth > 0 AND p.path = v.path[1:v.depth - 1]
"""

#: The one layout of the given pages: the text is in the article element, its blocks are h1 and p.
EXTRACTED = r"""
WITH articles AS (
    SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*?)</article>', 1, 's') AS article FROM pages
), blocks AS (
    SELECT page_id, url, list_transform(string_split_regex(article, '</?(?:p|h1)>'),
        lambda b: replace(replace(replace(replace(replace(regexp_replace(b, '<[^>]*>', ' ', 'g'),
            '&lt;', '<'), '&gt;', '>'), '&quot;', chr(34)), '&#x27;', chr(39)), '&amp;', '&')) AS blocks
    FROM articles
), texts AS (
    SELECT page_id, url, array_to_string(list_filter(list_transform(blocks, lambda b: trim(regexp_replace(b, '\s+', ' ', 'g'))),
        lambda b: b <> ''), chr(10)) AS text FROM blocks
)
SELECT page_id, url, text, length(text) AS n_chars FROM texts
"""

ORACLES: dict[str, str] = {
    "op1_jaccard_join": JACCARD,
    "op2_topk_search": TOP_K,
    "op3_curriculum_mix": MIX,
    "op4_url_filter": URLS,
    "op5_quality_rules": QUALITY,
    "op7_substring_dedup": REPEATS,
    "op11_spelling_variants": SPELLING,
    "op12_html_extraction": EXTRACTED,
    "op13_prefix_trie": TRIE,
}
