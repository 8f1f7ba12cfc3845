"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from . import collocations, hamming_topk, mixing, spelling_variants, unit_dedup, url_filter

WORDS = r"[^\x20\x09-\x0D]+"

TOPK = f"""
WITH c AS (SELECT vec_id id, (list_sum(list_transform(range(64), lambda k: CASE WHEN embedding[k + 1] > 0 AND NOT isnan(embedding[k + 1]) THEN CASE WHEN k = 63 THEN -(1::HUGEINT << 63) ELSE 1::HUGEINT << k::INT END ELSE 0::HUGEINT END)))::BIGINT code
  FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL)
SELECT q.id query_id, row_number() OVER (PARTITION BY q.id, q.code ORDER BY bit_count(xor(q.code, c.code)), c.code, c.id)::INT AS "rank", c.id neighbour_id, bit_count(xor(q.code, c.code))::INT distance
FROM c q JOIN c ON q.id <> c.id WHERE q.id % {hamming_topk.QUERY_EVERY} = 0 QUALIFY "rank" <= {hamming_topk.K}
"""

REPEATS = f"""
WITH u AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{unit_dedup.UNIT}') us FROM documents),
p AS (SELECT doc_id, unnest(us) unit, generate_subscripts(us, 1) - 1 AS unit_no FROM u),
o AS (SELECT doc_id, unit_no, length(unit) size, sum(length(unit)) OVER (PARTITION BY doc_id ORDER BY unit_no) upto, list_filter(string_split_regex(lower(unit), '{unit_dedup.SPACE}+'), lambda x: x <> '') w FROM p),
k AS (SELECT doc_id, unit_no, upto - size AS begins, upto, len(w) n_words, array_to_string(w, ' ') plain, sum((len(w) >= {unit_dedup.SENTENCE})::INT) OVER (PARTITION BY doc_id ORDER BY unit_no) seq, count(*) OVER (PARTITION BY doc_id) n_units FROM o WHERE len(w) > 0),
f AS (SELECT plain, min(doc_id) kept FROM k GROUP BY plain HAVING count(*) > 1),
g AS (SELECT k.*, kept, min(unit_no) OVER (PARTITION BY doc_id, plain) first_no FROM k JOIN f USING (plain)),
i AS (SELECT *, seq - sum((n_words >= {unit_dedup.SENTENCE})::INT) OVER (PARTITION BY doc_id ORDER BY unit_no) run FROM g WHERE doc_id <> kept OR unit_no <> first_no)
SELECT doc_id, unit_no::INT unit_no, begins::INT AS "start", upto::INT AS "end", n_words::INT n_words, kept kept_doc_id, (sum(CASE WHEN n_words >= {unit_dedup.SENTENCE} THEN n_words ELSE 0 END) OVER (PARTITION BY doc_id, run))::BIGINT run_words, count(*) OVER (PARTITION BY doc_id) = n_units AS whole FROM i
"""
PASSAGES = f"SELECT * FROM ({REPEATS}) WHERE whole OR run_words >= {unit_dedup.PASSAGE}"

JACCARD = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORDS}') w FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) g FROM w),
n AS (SELECT doc_id, count(*) n FROM s GROUP BY doc_id),
b AS (SELECT x.doc_id a, y.doc_id b, count(*) k FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM b JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 90 * (p.n + q.n - k)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, coalesce(n.n, 0) n_shingles, least(d.doc_id, min(r.b)) component_id FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN r ON r.a = d.doc_id GROUP BY d.doc_id, n.n
"""

ORDER = "most / weight, source IS NULL, source"
MIX = f"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORDS}')), 0) size, substr(md5(coalesce(doc_id::VARCHAR, '')), 1, {mixing.DIGITS * mixing.LEVELS}) place FROM documents),
s AS (SELECT source, sum(size)::BIGINT source_size FROM d GROUP BY source),
w AS (SELECT *, ([5, 2, 1]::DOUBLE[])[(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1] weight, (source_size * {mixing.MOST})::DOUBLE most FROM s),
l AS (SELECT *, ((SELECT sum(source_size) FROM s)::DOUBLE - coalesce(sum(most) OVER (ORDER BY {ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (ORDER BY {ORDER} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) lev FROM w),
t AS (SELECT source, source_size, least(most, max(lev) OVER () * weight) target FROM l),
g AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END copies, target - CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END * source_size budget FROM t),
c AS (SELECT source, place, sum(size) tokens, sum(sum(size)) OVER (PARTITION BY source ORDER BY place) upto FROM d GROUP BY source, place),
e AS (SELECT c.source, arg_min(c.place, c.place) last, arg_min(upto - budget <= budget - (upto - tokens), c.place) take FROM c JOIN g ON g.source IS NOT DISTINCT FROM c.source WHERE upto > budget GROUP BY c.source)
SELECT doc_id, size::BIGINT size, source_size, target, (size * (copies + CASE WHEN place < last OR place = last AND take THEN 1 ELSE 0 END))::BIGINT taken
FROM d JOIN g ON g.source IS NOT DISTINCT FROM d.source LEFT JOIN e ON e.source IS NOT DISTINCT FROM d.source
"""

RULED = f"""
WITH u AS (SELECT page_id, CASE WHEN contains(coalesce(url, ''), '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host, regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) path FROM u),
r AS (SELECT * FROM (VALUES {", ".join(f"('{n}', '{v}')" for n, v in url_filter.RULES)}) t (rule, label)),
f AS (SELECT page_id, host, path, rule, label FROM p LEFT JOIN r ON (host = split_part(rule, '/', 1) OR suffix(host, '.' || split_part(rule, '/', 1))) AND starts_with(path, substr(rule, strpos(rule, '/'))))
SELECT page_id, host, path, rule, label FROM f QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC NULLS LAST) = 1
"""

COUNTED = f"""
WITH w AS (SELECT doc_id, coalesce(text, '') body, regexp_extract_all(coalesce(text, ''), '{WORDS}') w FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(w) - 1)) k, w FROM w),
h AS (SELECT doc_id, k, count(*) OVER (PARTITION BY doc_id, w[k], w[k + 1], w[k + 2]) n FROM g),
x AS (SELECT doc_id, count(DISTINCT e) n FROM (SELECT doc_id, unnest([k, k + 1, k + 2]) e FROM h WHERE n > 1) GROUP BY doc_id),
l AS (SELECT doc_id, len(z) - len(list_distinct(z)) n FROM (SELECT doc_id, list_filter(string_split(body, chr(10)), lambda y: regexp_matches(y, '{WORDS}')) z FROM w)),
c AS (SELECT w.doc_id, len(w)::BIGINT n_words, coalesce(list_sum(list_transform(w, lambda y: length(y))), 0)::BIGINT word_chars, length(regexp_replace(body, '[^#*$%&|<>]', '', 'g'))::BIGINT n_symbols, l.n::BIGINT n_dup_lines, coalesce(x.n, 0)::BIGINT n_repeat_words FROM w JOIN l USING (doc_id) LEFT JOIN x USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words base_failed FROM c
"""

FOUND = """
SELECT doc_id, len(list_filter(regexp_extract_all(coalesce(text, ''), '(?i:password|passwd|secret|token|api_?key)["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1), lambda x: length(x) >= 6))::BIGINT n_assign,
len(list_filter(regexp_extract_all(coalesce(text, ''), 'AKIA[A-Z0-9]+'), lambda x: length(x) >= 20))::BIGINT n_access, len(list_filter(regexp_extract_all(coalesce(text, ''), '[0-9a-f]+'), lambda x: length(x) >= 24))::BIGINT n_hex FROM documents
"""

#: CRC-32 is linear: each byte adds a value that its distance from the end decides, and so does the initial state.
CRC = """
bits AS (SELECT b, b::BIGINT c, 0 k FROM range(256) t(b) UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
zero AS (SELECT b, c FROM bits WHERE k = 8),
far AS (SELECT 0 k, b, c FROM zero UNION ALL SELECT far.k + 1, far.b, xor(far.c >> 8, zero.c) FROM far JOIN zero ON zero.b = far.c & 255 WHERE far.k < (SELECT max(strlen(m)) FROM said)),
begun AS (SELECT 0 k, 4294967295 c UNION ALL SELECT k + 1, xor(begun.c >> 8, zero.c) FROM begun JOIN zero ON zero.b = begun.c & 255 WHERE k < (SELECT max(strlen(m)) FROM said)),
bytes AS (SELECT m, strlen(m) - 1 - i k, ('0x' || substr(hex(m), 2 * i + 1, 2))::INT b FROM (SELECT m, unnest(range(strlen(m))) i FROM said)),
sums AS (SELECT m, bit_xor(c) c FROM bytes JOIN far USING (k, b) GROUP BY m),
crcs AS (SELECT m, xor(xor(sums.c, begun.c), 4294967295) h FROM sums JOIN begun ON begun.k = strlen(m))
"""
VARIANTS = f"""
WITH RECURSIVE runs AS (SELECT coalesce(doc_id::VARCHAR, '') d, unnest(regexp_extract_all(translate(coalesce(text, ''), '{spelling_variants.UPPER}', '{spelling_variants.LOWER}'), '{spelling_variants.RUN}')) run FROM documents),
each AS (SELECT d || ':' || run m, run, count(*) n FROM runs WHERE length(run) >= {spelling_variants.LEAST_LENGTH} GROUP BY ALL),
said AS (SELECT m FROM each),{CRC},
kept AS (SELECT CASE WHEN h % {spelling_variants.LOSS} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END word, n FROM each JOIN crcs USING (m)),
w AS (SELECT word, sum(n)::BIGINT n FROM kept WHERE length(word) >= {spelling_variants.LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {spelling_variants.LEAST_COUNT}),
cut AS (SELECT word, p, substr(word, 1, p) || substr(word, p + 2) rest FROM (SELECT word, unnest(range(length(word))) p FROM w)),
pairs AS (SELECT x.word a, y.word b FROM cut x JOIN cut y ON x.p = y.p AND x.rest = y.rest AND x.word <> y.word UNION SELECT cut.word, w.word FROM cut JOIN w ON w.word = rest UNION SELECT w.word, cut.word FROM cut JOIN w ON w.word = rest),
best AS (SELECT a word, count(*) n_near, max(y.n) most, arg_min(b, (-y.n, encode(b))) form FROM pairs JOIN w y ON y.word = b GROUP BY a),
forms AS (SELECT w.word, n, coalesce(n_near, 0) n_near, CASE WHEN most >= {spelling_variants.TIMES} * n THEN form END form, CASE WHEN most >= {spelling_variants.TIMES} * n THEN most END form_n FROM w LEFT JOIN best ON best.word = w.word),
chain AS (SELECT word, word root FROM forms UNION ALL SELECT chain.word, form FROM chain JOIN forms ON forms.word = chain.root WHERE form IS NOT NULL)
SELECT f.word, form, root, n, n_near, form_n FROM forms f JOIN (SELECT chain.word, root FROM chain JOIN forms ON forms.word = chain.root WHERE form IS NULL) r ON r.word = f.word
"""

PHRASES = f"""
WITH p AS (SELECT coalesce(lang, '{collocations.NO_LANG}') lang, unnest(string_split_regex(translate(coalesce(text, ''), '{spelling_variants.UPPER}', '{spelling_variants.LOWER}'), '[.,;:!?\\x0A-\\x0D]')) p FROM documents),
w AS (SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') w FROM p),
n AS (SELECT lang, sum(len(w))::BIGINT n FROM w GROUP BY lang),
k AS (SELECT lang, w, unnest(range(1, {collocations.LONGEST} + 1)) k FROM w),
g AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) i FROM k WHERE len(w) >= k),
f AS (SELECT lang, k size, array_to_string(w[i : i + k - 1], ' ') phrase, count(*)::BIGINT f FROM g GROUP BY ALL HAVING count(*) >= {collocations.LEAST}),
c AS (SELECT lang, size, phrase, f a, string_split(phrase, ' ') w FROM f WHERE size > 1),
cut AS (SELECT *, unnest(range(1, size)) k FROM c),
s AS (SELECT cut.lang, cut.phrase, a, cut.k k, x.f l, y.f r, n, ((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f))::BIGINT score FROM cut JOIN n USING (lang) JOIN f x ON x.lang = cut.lang AND x.phrase = array_to_string(w[1 : cut.k], ' ') JOIN f y ON y.lang = cut.lang AND y.phrase = array_to_string(w[cut.k + 1 : cut.size], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
m AS (SELECT *, unnest(range(2, size)) m FROM c),
u AS (SELECT lang, a, w, m, unnest(range(1, size - m + 2)) i FROM m),
o AS (SELECT lang, array_to_string(w[i : i + m - 1], ' ') phrase, max(a) longer FROM u GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS "rank", phrase, a, l, r, n, score FROM b LEFT JOIN o USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < {collocations.PERCENT} * a QUALIFY "rank" <= {collocations.TOP}
"""

SQL = {"op13_collocations": PHRASES, "op11_spelling_variants": VARIANTS, "op6_url_filters_rules": RULED, "op7_quality_rules_base": COUNTED, "op9_secret_scan_base": FOUND, "op1_exact_topk": TOPK, "op2_substring_dedup": PASSAGES, "op2_substring_repeats": REPEATS, "op3_ngram_jaccard_join": JACCARD, "op4_mixing": MIX}
