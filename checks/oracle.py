"""Independent SQL for the registered queries, run by DuckDB on the same tables.

Each statement is written from the definition of the operator, not from the
Spark plan: plain windows, lists and group-bys over whole tables.
"""

from __future__ import annotations

from lexloom.operators.prompts import SYSTEM_PROMPT
from lexloom.vocab import LENGTHS, LEVELS, STOPWORDS

BL = r"\t-\r\x{1c}-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
STOP = "(" + ", ".join(f"'{w}'" for w in STOPWORDS) + ")"

E = r"""
t AS (SELECT *, regexp_extract_all(lower(text), '[a-z]+(?:''[a-z]+)?') AS tok FROM documents),
e AS (SELECT doc_id, doc_id // 5 AS bundle_id, text, lang AS language_level, source AS genre,
  concat('m', doc_id % 3) AS model,
  CASE WHEN doc_id % 3 = 0 THEN 'local_new' ELSE 'hf_published' END AS origin,
  list_concat(list_transform(range(0, doc_id % 4 + 1), lambda i: concat('c', (doc_id*31 + i*i*17 + i*7) % 211)),
    CASE WHEN len(tok) >= 4 THEN [concat(tok[3], '_', tok[4]), concat(tok[2], '_zzq')] ELSE [] END) AS labels,
  list_transform(range(0, 8 + doc_id % 8), lambda i: concat('c', (doc_id*31 + (i+3)*(i+3)*17 + (i+3)*7) % 257)) AS not_labels,
  tok
  FROM t)"""

# Label instances and counts.
LI = E + """,
li AS (SELECT doc_id, origin, text, unnest(labels) AS label, true AS is_pos FROM e
  UNION ALL SELECT doc_id, origin, text, unnest(not_labels), false FROM e),
lc AS (SELECT label, count(*) FILTER (is_pos) AS n_pos, count(*) FILTER (NOT is_pos) AS n_neg FROM li GROUP BY label)"""


def literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def merged(source: str, name: str, where: str = "true", model: str = "array_to_string(list_sort(list(DISTINCT model)), '|')") -> str:
    """CTEs that merge rows of `source` by text into `name`."""
    return f"""
{name}_l AS (SELECT text, label, bool_or(p) AS p FROM (
    SELECT text, unnest(labels) AS label, true AS p FROM {source} WHERE {where}
    UNION ALL SELECT text, unnest(not_labels), false FROM {source} WHERE {where}) GROUP BY ALL),
{name}_a AS (SELECT text, list_sort(list(label) FILTER (p)) AS labels, list_sort(list(label) FILTER (NOT p)) AS not_labels
    FROM {name}_l GROUP BY text),
{name}_m AS (SELECT text, {model} AS model FROM {source} WHERE {where} GROUP BY text),
{name} AS (SELECT text, coalesce(labels, []) AS labels, coalesce(not_labels, []) AS not_labels, model
    FROM {name}_m LEFT JOIN {name}_a USING (text))"""


def held(source: str, name: str) -> str:
    return f"""
{name}_v AS (SELECT DISTINCT unnest(labels) AS label FROM {source}),
{name} AS (SELECT label FROM {name}_v ORDER BY md5(concat('42|', label)), label
    LIMIT (SELECT floor(count(*) * 0.02)::BIGINT FROM {name}_v))"""


def routed(source: str, heldout: str, name: str) -> str:
    return f"""
{name} AS (SELECT *, CASE WHEN list_has_any(labels, (SELECT coalesce(list(label), []) FROM {heldout})) THEN 'test'
    WHEN list_has_any(not_labels, (SELECT coalesce(list(label), []) FROM {heldout})) THEN 'dropped' ELSE 'train' END AS split
    FROM {source})"""


M = E + "," + merged("e", "m")
SPLIT = M + "," + held("m", "h") + "," + routed("m", "h", "r") + ",\ns AS (SELECT * FROM r WHERE split <> 'dropped')"


def roles_by_split(source: str, name: str = "f") -> str:
    return f"""
{name} AS (SELECT label, bool_or(split='train' AND p) AS train_pos, bool_or(split='train' AND NOT p) AS train_neg,
    bool_or(split='test' AND p) AS test_pos, bool_or(split='test' AND NOT p) AS test_neg FROM (
    SELECT split, unnest(labels) AS label, true AS p FROM {source}
    UNION ALL SELECT split, unnest(not_labels), false FROM {source}) GROUP BY label)"""


SEEN = SPLIT + "," + roles_by_split("s") + """,
b AS (SELECT *, CASE WHEN train_pos AND train_neg THEN 'positive and negative' WHEN train_pos THEN 'positive only'
    WHEN train_neg THEN 'negative only' ELSE 'never' END AS seen_in_train FROM f),
g AS (SELECT x AS seen_in_train, count(label) FILTER (test_pos) AS as_positive, count(label) FILTER (test_neg) AS as_negative
    FROM (SELECT unnest(['positive and negative', 'positive only', 'negative only', 'never']) AS x)
    LEFT JOIN b ON b.seen_in_train = x GROUP BY x)"""

INC = (
    E + "," + merged("e", "o", "doc_id % 10 < 8") + "," + held("o", "h") + "," + routed("o", "h", "ro")
    + ",\nx AS (SELECT * FROM ro WHERE split <> 'dropped')," + roles_by_split("x")
    + ",\nk AS (SELECT label FROM f WHERE test_pos AND NOT train_pos AND NOT train_neg),"
    + merged("e", "n", "(doc_id % 10 >= 8 OR doc_id % 50 = 0)") + "," + routed("n", "k", "rn")
    + """,
d AS (SELECT * FROM rn WHERE NOT EXISTS (SELECT 1 FROM x WHERE x.text = rn.text AND x.split = rn.split))"""
)

# Replies by number of the bundle.
B = E + """,
bundle AS (SELECT bundle_id, min_by(genre, doc_id) AS genre, min_by(language_level, doc_id) AS language_level, count(*) AS members,
    bundle_id % 7 = 0 AS no_reply, bundle_id % 7 <> 0 AND (bundle_id % 11 = 0 OR bundle_id % 13 <> 0 AND bundle_id % 17 = 0) AS malformed,
    bundle_id % 7 <> 0 AND bundle_id % 11 <> 0 AND bundle_id % 13 = 0 AS hollow,
    bundle_id % 7 <> 0 AND bundle_id % 11 <> 0 AND bundle_id % 13 <> 0 AND bundle_id % 17 <> 0 AS usable
    FROM e GROUP BY bundle_id),
x AS (SELECT b.bundle_id, b.genre, b.language_level, doc_id, text,
    list_filter(labels, lambda l: NOT list_contains(not_labels, l)) AS labels,
    list_filter(not_labels, lambda l: NOT list_contains(labels, l)) AS not_labels
    FROM e JOIN bundle b USING (bundle_id) WHERE b.usable)"""

# Words.
W = E + """,
tk AS (SELECT doc_id, genre, origin, unnest(tok) AS word FROM e),
wc AS (SELECT origin, word, count(*) AS n FROM tk GROUP BY ALL)"""

SENT = "greatest(len(regexp_extract_all(text, '[.!?]+')), 1)"
WORDS = f"len(regexp_extract_all(text, '[^{BL}]+'))"
ENRICH = E + f""",
en AS (SELECT doc_id, origin, genre, len(labels) AS n_pos, len(not_labels) AS n_neg, {WORDS} AS text_words,
    len(text) AS text_chars, {SENT} AS n_sentences, len(labels) + len(not_labels) AS n_all_labels,
    list_concat(labels, not_labels) AS all_labels, text FROM e)"""
NUM = ("n_pos", "n_neg", "text_words", "text_chars", "n_sentences", "n_all_labels")


def long_form(source: str, cols, by: str = "origin") -> str:
    return " UNION ALL ".join(f"SELECT {by}, '{c}' AS metric, {c}::DOUBLE AS v FROM {source}" for c in cols)


# Syllables word by word, as defined.
Q = E + f""",
w AS (SELECT doc_id, unnest(regexp_extract_all(text, '[^{BL}]+')) AS w FROM e),
sy AS (SELECT doc_id, count(*) AS words, sum(len(w)) AS in_words, sum(CASE WHEN len(lower(w)) <= 3 THEN 1 ELSE
    greatest(1, len(regexp_extract_all(regexp_replace(lower(w), '(es|ed|e)$', ''), '[aeiouy]+'))) END) AS syllables FROM w GROUP BY doc_id),
q0 AS (SELECT e.doc_id, e.origin, e.genre, coalesce(words, 0) AS words, coalesce(in_words, 0) AS in_words, coalesce(syllables, 0) AS syllables,
    {SENT} AS sents, greatest(len(text), 1) AS chars,
    len(regexp_extract_all(text, '[.,;:!?()\\[\\]{{}}"''/-]')) AS punct,
    len(regexp_extract_all(text, '\\p{{Lu}}')) AS upper, len(regexp_extract_all(text, '\\p{{Nd}}')) AS digits,
    len(regexp_extract_all(text, '\\p{{L}}')) AS letters FROM e LEFT JOIN sy USING (doc_id)),
q AS (SELECT doc_id, origin, genre,
    CASE WHEN words > 0 THEN in_words / words ELSE 0.0 END::DOUBLE AS avg_word_len,
    punct / chars AS punct_ratio, upper / chars AS upper_ratio, digits / chars AS digit_ratio,
    CASE WHEN words > 0 THEN 0.39::DOUBLE * (words / sents) + 11.8::DOUBLE * (syllables / words) - 15.59::DOUBLE ELSE 0.0 END::DOUBLE AS flesch_kincaid,
    CASE WHEN words > 0 THEN 0.0588::DOUBLE * (letters / words * 100) - 0.296::DOUBLE * (sents / words * 100) - 15.8::DOUBLE ELSE 0.0 END::DOUBLE AS coleman_liau
    FROM q0)""".replace("\\\\", "\\")
QUAL = ("avg_word_len", "punct_ratio", "upper_ratio", "digit_ratio", "flesch_kincaid", "coleman_liau")

G = """,
gt AS (SELECT DISTINCT source AS genre, regexp_extract(source, '(\\d+)', 1)::INT AS number FROM documents),
gn AS (SELECT genre, number > 14 AS is_new, CASE WHEN number % 7 <> 3 THEN concat('cat', number % 3) END AS category, number AS position, concat('About ', genre) AS description FROM gt)""".replace("\\\\", "\\")

# Overlap of each label instance with its text, by both rules.
OV = E + f""",
tw AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS tw FROM e),
oi AS (SELECT doc_id, unnest(labels) AS label, true AS is_pos FROM e UNION ALL SELECT doc_id, unnest(not_labels), false FROM e),
ow AS (SELECT doc_id, label, is_pos, tw, regexp_extract_all(lower(label), '[a-z0-9]+') AS cw,
    regexp_extract_all(lower(label), '[^{BL}_-]+') AS sw FROM oi JOIN tw USING (doc_id)),
ov AS (SELECT doc_id, label, is_pos,
    CASE WHEN len(cw) = 0 THEN 0.0 ELSE len(list_filter(cw, lambda x: list_contains(tw, x))) / len(cw) END::DOUBLE AS score,
    CASE WHEN len(sw) = 0 THEN 0.0 ELSE len(list_filter(sw, lambda x: list_contains(tw, x))) / len(sw) END::DOUBLE AS split_score
    FROM ow),
bw AS (SELECT doc_id, tw, list_slice(regexp_extract_all(lower(text), '[a-z]+'), 1, 3) AS fw FROM e JOIN tw USING (doc_id)),
bs AS (SELECT CASE WHEN len(fw) = 0 THEN 0.0 ELSE len(list_filter(fw, lambda x: list_contains(tw, x))) / len(fw) END::DOUBLE AS score FROM bw),
dv AS (SELECT 'labels' AS source, count(*) AS instances, avg(split_score) AS mean_overlap,
    100.0::DOUBLE * count(*) FILTER (split_score >= 0.8) / count(*) AS shallow_pct FROM ov WHERE is_pos
    UNION ALL SELECT 'baseline', count(*), avg(score), 100.0::DOUBLE * count(*) FILTER (score >= 0.8) / count(*) FROM bs)"""

PLAIN = rf"[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}{BL}]"
FIT = f""",
lt AS (SELECT doc_id, len(regexp_extract_all(replace(label, '_', ' '), '{PLAIN}')) AS n FROM (
    SELECT doc_id, unnest(list_concat(labels, not_labels)) AS label FROM e)),
lsum AS (SELECT doc_id, count(*) AS k, sum(n) AS n FROM lt GROUP BY doc_id),
xt AS (SELECT doc_id, len(regexp_extract_all(text, '{PLAIN}')) AS n FROM e),
sq AS (SELECT doc_id, 2 + xt.n + coalesce(k, 0) + coalesce(lsum.n, 0) AS n FROM xt LEFT JOIN lsum USING (doc_id)),
ft AS (SELECT 'text' AS series, n, n < 20 AS bad FROM xt UNION ALL SELECT 'label', n, n > 32 FROM lt
    UNION ALL SELECT 'sequence', n::BIGINT, n > 512 FROM sq)"""


def articles_cut(seed: int = 42) -> str:
    return f"""
p0 AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda p: regexp_matches(p, '[^{BL}]')) AS p,
    cast('0x' || substr(md5(concat('{seed}|paragraph|', doc_id)), 1, 8) AS BIGINT) AS draw FROM documents),
pw AS (SELECT doc_id, array_to_string(CASE WHEN len(p) < 5 THEN p ELSE
    list_slice(p, draw % (len(p) - 4) + 1, draw % (len(p) - 4) + 5) END, chr(10)) AS text FROM p0)"""


def draw(salt: str, n: str) -> str:
    return f"cast('0x' || substr(md5(concat('42|{salt}|', doc_id)), 1, 8) AS BIGINT) % {n}"


def values(name: str, rows: list[str], text: str) -> str:
    body = ", ".join(f"({i}, '{r}', '{text.format(r)}')" for i, r in enumerate(rows))
    return f"{name} AS (SELECT * FROM (VALUES {body}) v(i, label, instruction))"


COND = (
    "WITH dummy AS (SELECT 1)" + G + "," + articles_cut() + ",\n" + values("lens", LENGTHS, "Each text must be {}.") + ",\n"
    + values("levs", LEVELS, "Write at CEFR level {}.")
    + f""",
gx AS (SELECT *, row_number() OVER (ORDER BY position) - 1 AS i FROM gn),
cond AS (SELECT doc_id AS article_id, pw.text, gx.genre AS genre_name, gx.description AS genre_description,
    lens.label AS length_label, lens.instruction AS length_instruction, levs.label AS level_label, levs.instruction AS level_instruction
    FROM pw JOIN gx ON gx.i = {draw('genre', '(SELECT count(*) FROM gx)')}
    JOIN lens ON lens.i = {draw('length', '5')} JOIN levs ON levs.i = {draw('level', '5')}),
pr AS (SELECT article_id, genre_name AS genre, level_label AS language_level,
    substr('<genre>' || chr(10) || genre_name || ': ' || genre_description || chr(10) || chr(10) || '</genre>' || chr(10) || chr(10)
    || '<length>' || length_label || ': ' || length_instruction || '</length>' || chr(10) || chr(10)
    || '<language_level>' || level_label || ': ' || level_instruction || '</language_level>' || chr(10) || chr(10)
    || '<wikipedia_excerpt>' || chr(10) || 'Title ' || article_id || chr(10) || chr(10) || text || chr(10) || '</wikipedia_excerpt>', 1, 6144) AS content FROM cond)"""
)


def ngram_ctes(n: int, stop: bool, where: str = "true", by: str = "'x'", name: str = "ng") -> str:
    """Counts of n-grams over the stream of all texts in doc_id order."""
    keep = f"AND word NOT IN {STOP}" if stop else ""
    window = f"OVER (PARTITION BY grp ORDER BY doc_id, i)"
    parts = " || ' ' || ".join(["word"] + [f"lead(word, {k}) {window}" for k in range(1, n)])
    return f"""
{name}_p AS (SELECT doc_id, {by} AS grp, unnest(tok) AS word, generate_subscripts(tok, 1) AS i, genre FROM e WHERE {where}),
{name}_g AS (SELECT grp, {parts} AS ngram FROM {name}_p WHERE true {keep}),
{name} AS (SELECT grp, ngram, count(*) AS n FROM {name}_g WHERE ngram IS NOT NULL GROUP BY ALL)"""


def within_ctes(n: int) -> str:
    window = "OVER (PARTITION BY doc_id ORDER BY i)"
    parts = " || ' ' || ".join(["word"] + [f"lead(word, {k}) {window}" for k in range(1, n)])
    return f"""
ng_p AS (SELECT doc_id, unnest(tok) AS word, generate_subscripts(tok, 1) AS i FROM e),
ng_g AS (SELECT {parts} AS ngram FROM ng_p WHERE word NOT IN {STOP}),
ng AS (SELECT ngram, count(*) AS n FROM ng_g WHERE ngram IS NOT NULL GROUP BY ALL)"""


def richness(by: str) -> str:
    return f"""
wq AS (SELECT {by}, word, count(*) AS n FROM tk GROUP BY ALL),
rs AS (SELECT {by}, sum(n)::DOUBLE AS t, count(*)::DOUBLE AS v, count(*) FILTER (n = 1)::DOUBLE AS v1, sum(n::DOUBLE * n) AS m2 FROM wq GROUP BY 1),
tx AS (SELECT {by}, count(*) AS n_texts FROM e GROUP BY 1),
rich AS (SELECT tx.{by}, n_texts, coalesce(t, 0)::BIGINT AS tokens, coalesce(v, 0)::BIGINT AS types,
    CASE WHEN t > 1 THEN 10000 * (m2 - t) / (t * t) ELSE 0.0 END::DOUBLE AS yules_k,
    CASE WHEN t > 0 THEN pow(t, pow(v, -0.172::DOUBLE)) ELSE 0.0 END::DOUBLE AS brunets_w,
    CASE WHEN v1 < v THEN 100 * ln(t) / (1 - v1 / v) ELSE 0.0 END::DOUBLE AS honores_h,
    CASE WHEN t > 0 THEN v / t ELSE 0.0 END::DOUBLE AS ttr FROM tx LEFT JOIN rs USING ({by}))"""


def segments(stop: bool) -> str:
    keep = f"AND word NOT IN {STOP}" if stop else ""
    return f"""
ms_p AS (SELECT doc_id, origin, unnest(tok) AS word, generate_subscripts(tok, 1) AS i FROM e),
ms_o AS (SELECT origin, word, (row_number() OVER (PARTITION BY origin ORDER BY doc_id, i) - 1) // 1000 AS seg FROM ms_p WHERE true {keep}),
ms_s AS (SELECT origin, seg, count(*) AS size, count(DISTINCT word) AS types FROM ms_o GROUP BY ALL)
SELECT origin, count(*) FILTER (size = 1000) AS segments,
    round(coalesce(avg(types / size) FILTER (size = 1000), max(types / size)), 6) AS msttr FROM ms_s GROUP BY origin"""


DESCRIBE = """count(*) AS count, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, round(min(v), 6) AS min,
    round(quantile_cont(v, 0.25), 6) AS p25, round(quantile_cont(v, 0.5), 6) AS p50, round(quantile_cont(v, 0.75), 6) AS p75, round(max(v), 6) AS max"""

# Distribution functions by joining every distinct value to the counts below it.
KS = """
ab AS (SELECT metric, v, count(*) FILTER (origin = 'local_new') AS a, count(*) FILTER (origin = 'hf_published') AS b FROM lf GROUP BY ALL),
cum AS (SELECT metric, v, a, b, sum(a) OVER (PARTITION BY metric ORDER BY v)::DOUBLE AS ca, sum(b) OVER (PARTITION BY metric ORDER BY v)::DOUBLE AS cb,
    sum(a) OVER (PARTITION BY metric)::DOUBLE AS na, sum(b) OVER (PARTITION BY metric)::DOUBLE AS nb FROM ab)"""
KS_SELECT = """
SELECT metric, round(d, 6) AS ks_stat, round(p, 6) AS ks_p, p < 0.05 AS significant FROM (
    SELECT metric, d, CASE WHEN x2 < 0.04 THEN 1.0 ELSE greatest(0.0, least(1.0,
        list_sum(list_transform(range(1, 101), lambda k: (CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END)::DOUBLE * exp(-2.0::DOUBLE * k * k * x2))))) END::DOUBLE AS p
    FROM (SELECT metric, d, d * d * (na * nb / (na + nb)) AS x2 FROM (
        SELECT metric, max(abs(ca / na - cb / nb)) AS d, max(na) AS na, max(nb) AS nb FROM cum GROUP BY metric)))"""


def hist(source: str, col: str, bins: int, by: str | None = None) -> str:
    """Bins by comparing each value with the edges."""
    b = by or "'x'"
    out = f"{by}, " if by else ""
    return f"""
hv AS (SELECT {b} AS grp, {col}::DOUBLE AS v FROM {source}),
hr AS (SELECT grp, CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END::DOUBLE AS lo,
    CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END::DOUBLE AS hi, count(*) AS total FROM hv GROUP BY grp),
hb AS (SELECT grp, lo, hi, total, (hi - lo) / {bins} AS width, unnest(range(0, {bins})) AS bin FROM hr),
hc AS (SELECT grp, least(floor((v - lo) / ((hi - lo) / {bins})), {bins - 1})::BIGINT AS bin, count(*) AS n FROM hv JOIN hr USING (grp) GROUP BY ALL)
SELECT {"hb.grp AS " + by + "," if by else ""} bin, round(lo + bin * width, 6) AS left_edge, round(lo + (bin + 1) * width, 6) AS right_edge,
    coalesce(n, 0)::BIGINT AS n, round(coalesce(n, 0) / total / width, 6) AS density FROM hb LEFT JOIN hc USING (grp, bin)"""


JOINED = "array_to_string(labels, '|') AS labels, array_to_string(not_labels, '|') AS not_labels"
PCT = "CASE WHEN {1} > 0 THEN round(100.0::DOUBLE * {0} / {1}, 6) ELSE 0.0 END::DOUBLE"

ROLES = """count(*) AS n_labels, count(*) FILTER (n_pos > 0 AND n_neg > 0) AS both, count(*) FILTER (n_neg = 0) AS only_pos,
    count(*) FILTER (n_pos = 0) AS only_neg, round(100.0::DOUBLE * count(*) FILTER (n_pos > 0 AND n_neg > 0) / count(*), 6) AS both_pct,
    round(100.0::DOUBLE * count(*) FILTER (n_neg = 0) / count(*), 6) AS only_pos_pct,
    round(100.0::DOUBLE * count(*) FILTER (n_pos = 0) / count(*), 6) AS only_neg_pct"""

FIRST_MODEL = merged("e", "m", model="min(model)")

ORACLE: dict[str, str] = {
    "read_articles": "SELECT doc_id AS article_id, concat('Title ', doc_id) AS title, md5(text) AS text FROM documents",
    "read_examples": f"""WITH {E} SELECT 's' AS source, genre, language_level, md5(text) AS text, array_to_string(labels, '|') AS labels,
        CASE WHEN doc_id % 10 = 0 THEN '' ELSE array_to_string(not_labels, '|') END AS not_labels, concat('model=', model) AS model FROM e""",
    "write_examples": f"WITH {E} SELECT 's' AS source, genre, language_level, md5(text) AS text, {JOINED} FROM e",
    "write_dataset": f"WITH {SPLIT} SELECT split, md5(text) AS text, {JOINED}, model FROM s",
    "read_published": f"WITH {SPLIT} SELECT md5(text) AS text, {JOINED}, model FROM s WHERE split = 'test'",
    "write_dataset_train_only": f"WITH {E},{FIRST_MODEL} SELECT md5(text) AS text, {JOINED}, model, 'train' AS split FROM m",
    "ordered_sample": """SELECT doc_id AS article_id FROM documents ORDER BY md5(concat('42|', doc_id)), doc_id
        LIMIT (SELECT count(*) // 4 FROM documents) OFFSET (SELECT count(*) // 10 FROM documents)""",
    "sample_rows": "SELECT doc_id AS article_id, concat('Title ', doc_id) AS title FROM documents ORDER BY md5(concat('42|', doc_id)), doc_id LIMIT 300",
    "resume_plan": """WITH c AS (SELECT count(*) AS n, count(*) FILTER (doc_id % 3 = 0) AS w FROM documents),
        o AS (SELECT doc_id, row_number() OVER (ORDER BY md5(concat('42|', doc_id)), doc_id) - 1 AS pos FROM documents)
        SELECT doc_id AS article_id FROM o, c WHERE pos >= 7 + ceil(w / 5) AND pos < 7 + ceil(w / 5) + ceil((2 * n - w) / 5)""",
    "resume_plan_exact": """WITH c AS (SELECT count(*) AS n, count(*) FILTER (doc_id % 3 = 0) AS w FROM documents),
        o AS (SELECT doc_id, row_number() OVER (ORDER BY md5(concat('42|', doc_id)), doc_id) - 1 AS pos FROM documents WHERE doc_id % 3 <> 0)
        SELECT doc_id AS article_id FROM o, c WHERE pos < ceil((2 * n - w) / 5)""",
    "paragraph_window": f"WITH {articles_cut()} SELECT doc_id AS article_id, concat('Title ', doc_id) AS title, md5(text) AS text FROM pw",
    "assign_conditions": f"{COND} SELECT article_id, genre_name, length_label, level_label FROM cond",
    "build_prompts": f"""{COND} SELECT article_id, genre, language_level, 2::BIGINT AS n_messages, 'user' AS role, len(content) AS n_chars,
        md5(content) AS content, md5({literal(SYSTEM_PROMPT)}) AS system FROM pr""",
    "complete": f"""{COND} SELECT article_id, CASE WHEN len(content) % 5 = 0 OR len(content) % 7 = 0 THEN NULL
        ELSE concat('sized:64:', len(content)) END AS response FROM pr""",
    "parse_responses": f"""WITH {B}, jt AS (SELECT bundle_id, string_agg(text, '|' ORDER BY doc_id) AS texts FROM e GROUP BY bundle_id)
        SELECT bundle_id, usable OR hollow AS parsed, CASE WHEN usable THEN members ELSE 0 END AS n_examples,
        md5(CASE WHEN usable THEN texts ELSE '' END) AS texts FROM bundle JOIN jt USING (bundle_id)""",
    "validate_bundles": f"WITH {B} SELECT bundle_id, usable AS is_valid FROM bundle",
    "expand_bundles": f"""WITH {B} SELECT bundle_id, genre, language_level, doc_id % 5 AS example_no, md5(text) AS text, {JOINED},
        'wikipedia' AS source FROM x WHERE len(labels) > 0 AND len(not_labels) > 0""",
    "generation_counters": f"""WITH {B} SELECT count(*) AS bundles, count(*) FILTER (no_reply) AS no_reply, count(*) FILTER (malformed) AS malformed,
        count(*) FILTER (hollow) AS invalid, count(*) FILTER (NOT usable) AS failed_bundles, count(*) FILTER (usable) AS usable_bundles,
        (SELECT count(*) FROM x WHERE len(labels) > 0 AND len(not_labels) > 0) AS examples FROM bundle""",
    "bundle_compliance": f"""WITH {B},
        bl AS (SELECT bundle_id, doc_id, unnest(labels) AS label, true AS p FROM e UNION ALL SELECT bundle_id, doc_id, unnest(not_labels), false FROM e),
        pl AS (SELECT bundle_id, label, bool_or(p) AS pos, bool_or(NOT p) AS neg, count(DISTINCT doc_id) AS docs FROM bl GROUP BY ALL),
        pb AS (SELECT bundle_id, count(*) AS shared, bool_and(pos AND neg AND docs > 1) AS cross_role FROM pl GROUP BY bundle_id),
        pt AS (SELECT bundle_id, count(*) AS texts, bool_and(len(labels) BETWEEN 1 AND 5) AS positive_counts,
            bool_and(len(not_labels) BETWEEN 8 AND 15) AS negative_counts FROM e GROUP BY bundle_id)
        SELECT bundle_id, texts = 5 AS five_texts, shared = 15 AS fifteen_shared, positive_counts, negative_counts, true AS labels_shared, cross_role,
            texts = 5 AND shared = 15 AND positive_counts AND negative_counts AND cross_role AS compliant
        FROM bundle JOIN pb USING (bundle_id) JOIN pt USING (bundle_id) WHERE usable""",
    "merge_by_text": f"WITH {M} SELECT md5(text) AS text, {JOINED}, model FROM m",
    "merge_by_text_first_model": f"WITH {E},{FIRST_MODEL} SELECT md5(text) AS text, {JOINED}, model FROM m",
    "label_vocabulary": f"""WITH {LI} SELECT count(*) FILTER (n_pos > 0) AS unique_pos, count(*) FILTER (n_neg > 0) AS unique_neg,
        count(*) AS unique_all, count(*) FILTER (n_pos > 0 AND n_neg > 0) AS unique_both FROM lc""",
    "choose_heldout": f"WITH {E},{held('e', 'h')} SELECT label FROM h",
    "strict_split": f"WITH {SPLIT} SELECT md5(text) AS text, split FROM s",
    "strict_split_unmerged": f"WITH {E},{held('e', 'h')},{routed('e', 'h', 'r')} SELECT doc_id, split FROM r",
    "leak_check": f"""WITH {SPLIT},{roles_by_split('s')} SELECT (SELECT count(*) FROM s WHERE split = 'train') AS train_rows,
        (SELECT count(*) FROM s WHERE split = 'test') AS test_rows, (SELECT count(*) FROM h) AS heldout_labels,
        (SELECT count(*) FROM h JOIN f USING (label) WHERE train_pos OR train_neg) AS leaked_labels""",
    "reconstruct_heldout": f"WITH {SPLIT},{roles_by_split('s')} SELECT label FROM f WHERE test_pos AND NOT train_pos AND NOT train_neg",
    "route_increment": f"WITH {INC} SELECT md5(text) AS text, split FROM rn",
    "route_counts": f"WITH {INC} SELECT split, count(*) AS n FROM rn GROUP BY split",
    "dedupe_against": f"WITH {INC} SELECT md5(text) AS text, split FROM d",
    "dedupe_skipped": f"""WITH {INC} SELECT split, count(*) FILTER (NOT seen) AS added, count(*) FILTER (seen) AS skipped FROM (
        SELECT rn.split, EXISTS (SELECT 1 FROM x WHERE x.text = rn.text AND x.split = rn.split) AS seen FROM rn) GROUP BY split""",
    "append_increment": f"""WITH {INC} SELECT md5(text) AS text, split, array_to_string(labels, '|') AS labels, model FROM x
        UNION ALL SELECT md5(text), split, array_to_string(labels, '|'), model FROM d WHERE split <> 'dropped'""",
    "increment_growth": f"""WITH {INC} SELECT split, count(*) FILTER (old) AS before, count(*) AS after FROM (
        SELECT split, true AS old FROM x UNION ALL SELECT split, false FROM d WHERE split <> 'dropped') GROUP BY split""",
    "seen_in_train_buckets": f"WITH {SEEN} SELECT seen_in_train, as_positive, as_negative, as_positive + as_negative AS total FROM g",
    "seen_in_train_ratios": f"""WITH {SEEN} SELECT seen_in_train, round(100.0::DOUBLE * as_positive / s, 1) AS as_positive_pct,
        round(100.0::DOUBLE * as_negative / s, 1) AS as_negative_pct, round(100.0::DOUBLE * (as_positive + as_negative) / s, 1) AS total_pct
        FROM g, (SELECT sum(as_positive + as_negative) AS s FROM g)""",
    "enrich": f"WITH {ENRICH} SELECT doc_id, {', '.join(NUM)}, array_to_string(all_labels, '|') AS all_labels FROM en",
    "corpus_health": f"""WITH {E} SELECT count(*) AS rows, count(*) FILTER (text IS NULL) AS null_text,
        count(*) FILTER (NOT regexp_matches(text, '[^{BL}]')) AS blank_text, count(*) FILTER (len(labels) = 0) AS no_positive,
        count(*) FILTER (len(not_labels) = 0) AS no_negative, count(*) - count(DISTINCT text) AS duplicate_texts,
        round(100.0::DOUBLE * (count(*) - count(DISTINCT text)) / count(*), 6) AS duplicate_pct FROM e""",
    "describe": f"WITH {ENRICH}, lf AS ({long_form('en', NUM)}) SELECT metric, {DESCRIBE} FROM lf GROUP BY metric",
    "describe_by_origin": f"WITH {ENRICH}, lf AS ({long_form('en', NUM)}) SELECT origin, metric, {DESCRIBE} FROM lf GROUP BY ALL",
    "describe_quality": f"WITH {Q}, lf AS ({long_form('q', QUAL)}) SELECT origin, metric, {DESCRIBE} FROM lf GROUP BY ALL",
    "describe_keys": f"""WITH k AS (SELECT l_returnflag, l_orderkey + 1000000000 AS "order", l_orderkey + 1000000000 AS order_int, l_linenumber AS line FROM lineitem),
        lf AS ({long_form('k', ('"order"', 'order_int', 'line'), 'l_returnflag')})
        SELECT l_returnflag, trim(metric, '"') AS metric, {DESCRIBE} FROM lf GROUP BY ALL""",
    "short_texts": f"""WITH {ENRICH} SELECT count(*) AS rows, count(*) FILTER (text_words < 10) AS short,
        round(100.0::DOUBLE * count(*) FILTER (text_words < 10) / count(*), 6) AS short_pct FROM en""",
    "label_counts": f"WITH {LI} SELECT label, n_pos, n_neg FROM lc",
    "label_roles": f"WITH {LI} SELECT {ROLES} FROM lc",
    "label_roles_frequent": f"WITH {LI} SELECT {ROLES} FROM lc WHERE n_pos + n_neg >= 2",
    "label_roles_by_origin": f"""WITH {LI}, lo AS (SELECT origin, label, count(*) FILTER (is_pos) AS n_pos, count(*) FILTER (NOT is_pos) AS n_neg
        FROM li GROUP BY ALL) SELECT origin, {ROLES} FROM lo GROUP BY origin""",
    "label_reuse": f"""WITH {LI}, x AS (SELECT n_pos + n_neg AS n FROM lc) SELECT count(*) AS n_labels, sum(n)::BIGINT AS instances,
        count(*) FILTER (n = 1) AS singletons, count(*) FILTER (n >= 2) AS reused_2, count(*) FILTER (n >= 5) AS reused_5,
        round(sum(n) / count(*), 6) AS mean_appearances, round(100.0::DOUBLE * count(*) FILTER (n = 1) / count(*), 6) AS singletons_pct,
        round(100.0::DOUBLE * count(*) FILTER (n >= 2) / count(*), 6) AS reused_2_pct,
        round(100.0::DOUBLE * count(*) FILTER (n >= 5) / count(*), 6) AS reused_5_pct FROM x""",
    "reuse_histogram": f"WITH {LI} SELECT least(n_pos + n_neg, 20) AS appearances, count(*) AS n_labels FROM lc GROUP BY 1",
    "cross_role_balance": f"WITH {LI} SELECT least(n_pos, n_neg) AS balance, count(*) AS n_labels FROM lc WHERE n_pos > 0 AND n_neg > 0 GROUP BY 1",
    "top_balanced_labels": f"""WITH {LI} SELECT label, n_pos, n_neg, least(n_pos, n_neg) AS balance FROM lc WHERE n_pos > 0 AND n_neg > 0
        ORDER BY balance DESC, label LIMIT 10""",
    "top_labels": f"WITH {LI} SELECT label, n_pos + n_neg AS n FROM lc ORDER BY n DESC, label LIMIT 15",
    "top_positive_labels": f"WITH {LI} SELECT label, n_pos AS n FROM lc WHERE n_pos > 0 ORDER BY n DESC, label LIMIT 50",
    "label_word_lengths": f"WITH {LI} SELECT len(regexp_extract_all(replace(label, '_', ' '), '[^{BL}]+')) AS n_words, count(*) AS n FROM li GROUP BY 1",
    "long_labels": f"""WITH {LI}, x AS (SELECT len(regexp_extract_all(replace(label, '_', ' '), '[^{BL}]+')) AS k FROM li)
        SELECT count(*) AS instances, count(*) FILTER (k > 1) AS long_labels, round(100.0::DOUBLE * count(*) FILTER (k > 1) / count(*), 6) AS long_pct FROM x""",
    "label_balance": f"""WITH {E} SELECT count(*) AS rows, round(avg(len(labels)), 6) AS mean_pos, round(stddev_samp(len(labels)), 6) AS std_pos,
        round(avg(len(not_labels)), 6) AS mean_neg, round(stddev_samp(len(not_labels)), 6) AS std_neg FROM e""",
    "rank_frequency_labels": f"""WITH {LI}, x AS (SELECT n_pos + n_neg AS n, row_number() OVER (ORDER BY n_pos + n_neg DESC) AS r FROM lc)
        SELECT n AS frequency, min(r) AS first_rank, max(r) AS last_rank FROM x GROUP BY n""",
    "rank_frequency_words": f"""WITH {W}, x AS (SELECT origin, n, row_number() OVER (PARTITION BY origin ORDER BY n DESC) AS r FROM wc)
        SELECT origin, n AS frequency, min(r) AS first_rank, max(r) AS last_rank FROM x GROUP BY ALL""",
    "histogram_words": f"WITH {ENRICH},{hist('en', 'text_words', 60)}",
    "histogram_by_origin": f"WITH {ENRICH},{hist('en', 'text_chars', 60, 'origin')}",
    "histogram_overlap": f"WITH {OV}, ro AS (SELECT doc_id, avg(score) AS o FROM ov GROUP BY doc_id),{hist('ro', 'o', 40)}",
    "integer_histogram": f"WITH {E} SELECT origin, len(labels) AS value, count(*) AS n FROM e GROUP BY ALL",
    "value_counts_model": f"WITH {E} SELECT model, count(*) AS n FROM e GROUP BY model",
    "value_counts_genre": "SELECT source AS genre, count(*) AS n FROM documents GROUP BY source",
    "label_diversity": f"""WITH {LI}, c AS (SELECT origin, label, count(*) AS n FROM li GROUP BY ALL),
        r AS (SELECT *, row_number() OVER (PARTITION BY origin ORDER BY n) AS i, sum(n) OVER (PARTITION BY origin)::DOUBLE AS t FROM c)
        SELECT origin, count(*) AS types, max(t)::BIGINT AS instances, round(-sum(n / t * log2(n / t + 1e-15)), 6) AS shannon,
            round(1 - sum(n::DOUBLE * (n - 1)) / (max(t) * (max(t) - 1)), 6) AS simpson,
            round((2 * sum(i::DOUBLE * n) - (count(*) + 1) * max(t)) / (count(*) * max(t)), 6) AS gini FROM r GROUP BY origin""",
    "genre_distribution": f"""WITH {E}{G}, c AS (SELECT genre, count(*) AS n FROM e GROUP BY genre) SELECT genre, n, is_new,
        (SELECT round(avg(n), 6) FROM c) AS mean_per_genre,
        (SELECT round(100.0::DOUBLE * sum(n) FILTER (is_new) / sum(n), 6) FROM c JOIN gn USING (genre)) AS new_pct FROM c JOIN gn USING (genre)""",
    "genre_entropy": f"""WITH {E}, c AS (SELECT genre, count(*) / (SELECT count(*) FROM e) AS p FROM e GROUP BY genre)
        SELECT count(*) AS genres, round(-sum(p * log2(p)), 6) AS entropy, round(log2(count(*)), 6) AS max_entropy,
            round(100 * -sum(p * log2(p)) / log2(count(*)), 6) AS uniform_pct FROM c""",
    "label_overlap": f"WITH {OV} SELECT doc_id, label, is_pos, round(score, 6) AS score FROM ov",
    "label_overlap_split_rule": f"WITH {OV} SELECT doc_id, label, is_pos, round(split_score, 6) AS score FROM ov",
    "row_overlap": f"""WITH {OV} SELECT e.doc_id, round(coalesce(avg(score) FILTER (is_pos), 0), 6) AS pos_overlap,
        round(coalesce(avg(score) FILTER (NOT is_pos), 0), 6) AS neg_overlap, round(coalesce(avg(score), 0), 6) AS all_overlap
        FROM e LEFT JOIN ov USING (doc_id) GROUP BY e.doc_id""",
    "overlap_summary": f"""WITH {OV} SELECT count(*) AS instances, round(avg(score), 6) AS mean_overlap, count(*) FILTER (score >= 0.8) AS shallow,
        round(100.0::DOUBLE * count(*) FILTER (score >= 0.8) / count(*), 6) AS shallow_pct, count(*) FILTER (score = 0) AS inferential,
        round(100.0::DOUBLE * count(*) FILTER (score = 0) / count(*), 6) AS inferential_pct FROM ov""",
    "shallowest_rows": f"""WITH {OV}, ro AS (SELECT doc_id, avg(score) AS o FROM ov WHERE is_pos GROUP BY doc_id)
        SELECT doc_id, md5(text) AS text, array_to_string(labels, '|') AS labels, round(coalesce(o, 0), 6) AS pos_overlap
        FROM e LEFT JOIN ro USING (doc_id) ORDER BY coalesce(o, 0) DESC, doc_id LIMIT 5""",
    "depth_vs_baseline": f"WITH {OV} SELECT source, instances, round(mean_overlap, 6) AS mean_overlap, round(shallow_pct, 6) AS shallow_pct FROM dv",
    "token_fit": f"""WITH {E}{FIT} SELECT series, count(*) AS n, count(*) FILTER (bad) AS out_of_bounds,
        round(100.0::DOUBLE * count(*) FILTER (bad) / count(*), 6) AS out_pct, round(avg(n), 6) AS mean, round(quantile_cont(n, 0.5), 6)::DOUBLE AS p50,
        round(quantile_cont(n, 0.95), 6)::DOUBLE AS p95, max(n)::BIGINT AS max FROM ft GROUP BY series""",
    "quality_scorecard": f"""WITH {OV},
        lc AS (SELECT label, count(*) FILTER (is_pos) AS n_pos, count(*) FILTER (NOT is_pos) AS n_neg FROM oi GROUP BY label){FIT},
        m AS (
        SELECT 'health' AS section, 'examples' AS metric, count(*)::DOUBLE AS value, NULL::BOOLEAN AS passed FROM e
        UNION ALL SELECT 'health', 'duplicate_share', v, v < 0.02 FROM (SELECT (count(*) - count(DISTINCT text)) / count(*) AS v FROM e)
        UNION ALL SELECT 'health', 'short_share', v, v < 0.01 FROM (SELECT count(*) FILTER ({WORDS} < 10) / count(*) AS v FROM e)
        UNION ALL SELECT 'labels', 'mean_positive', v, v >= 2 FROM (SELECT avg(len(labels)) AS v FROM e)
        UNION ALL SELECT 'labels', 'mean_negative', v, v >= 2 FROM (SELECT avg(len(not_labels)) AS v FROM e)
        UNION ALL SELECT 'labels', 'vocabulary', v, v > 5000 FROM (SELECT count(*) AS v FROM lc)
        UNION ALL SELECT 'reuse', 'mean_appearances', v, v >= 2.5 FROM (SELECT avg(n_pos + n_neg) AS v FROM lc)
        UNION ALL SELECT 'reuse', 'singleton_share', v, v < 0.3 FROM (SELECT count(*) FILTER (n_pos + n_neg = 1) / count(*) AS v FROM lc)
        UNION ALL SELECT 'reuse', 'both_roles_share', v, v >= 0.3 FROM (SELECT count(*) FILTER (n_pos > 0 AND n_neg > 0) / count(*) AS v FROM lc)
        UNION ALL SELECT 'reuse', 'only_positive_share', v, v < 0.4 FROM (SELECT count(*) FILTER (n_neg = 0) / count(*) AS v FROM lc)
        UNION ALL SELECT 'reuse', 'only_negative_share', v, v < 0.4 FROM (SELECT count(*) FILTER (n_pos = 0) / count(*) AS v FROM lc)
        UNION ALL SELECT 'depth', 'mean_overlap', v, v < 0.4 FROM (SELECT avg(score) AS v FROM ov)
        UNION ALL SELECT 'depth', 'shallow_share', v, v < 0.1 FROM (SELECT count(*) FILTER (score >= 0.8) / count(*) AS v FROM ov)
        UNION ALL SELECT 'fit', 'long_span_share', v, v < 0.01 FROM (SELECT count(*) FILTER (bad) / count(*) AS v FROM ft WHERE series = 'label')
        UNION ALL SELECT 'fit', 'long_sequence_share', v, v < 0.05 FROM (SELECT count(*) FILTER (bad) / count(*) AS v FROM ft WHERE series = 'sequence'))
        SELECT section, metric, round(value, 6) AS value,
            CASE WHEN passed IS NULL THEN 'info' WHEN passed THEN 'pass' ELSE 'fail' END AS status FROM m""",
    "summary_table": f"""WITH {OV},
        lc AS (SELECT label, count(*) FILTER (is_pos) AS n_pos, count(*) FILTER (NOT is_pos) AS n_neg FROM oi GROUP BY label),
        u AS (SELECT count(*) AS examples, avg(len(labels)) AS mean_positive, stddev_samp(len(labels)) AS std_positive,
            avg(len(not_labels)) AS mean_negative, stddev_samp(len(not_labels)) AS std_negative FROM e),
        l AS (SELECT count(*) FILTER (n_pos > 0) AS positive_vocabulary, count(*) AS vocabulary, count(*) FILTER (n_pos > 0 AND n_neg > 0) AS both_roles,
            count(*) FILTER (n_neg = 0) AS only_positive, count(*) FILTER (n_pos = 0) AS only_negative,
            count(*) FILTER (n_pos + n_neg >= 2) AS frequent_labels, count(*) FILTER (n_pos + n_neg >= 2 AND n_pos > 0 AND n_neg > 0) AS frequent_both_roles FROM lc),
        r AS (SELECT 'examples' AS metric, examples::DOUBLE AS value FROM u UNION ALL SELECT 'mean_positive', mean_positive FROM u
        UNION ALL SELECT 'std_positive', std_positive FROM u UNION ALL SELECT 'mean_negative', mean_negative FROM u
        UNION ALL SELECT 'std_negative', std_negative FROM u UNION ALL SELECT 'positive_vocabulary', positive_vocabulary FROM l
        UNION ALL SELECT 'vocabulary', vocabulary FROM l UNION ALL SELECT 'both_roles', both_roles FROM l
        UNION ALL SELECT 'both_roles_pct', 100.0 * both_roles / vocabulary FROM l UNION ALL SELECT 'only_positive', only_positive FROM l
        UNION ALL SELECT 'only_positive_pct', 100.0 * only_positive / vocabulary FROM l UNION ALL SELECT 'only_negative', only_negative FROM l
        UNION ALL SELECT 'only_negative_pct', 100.0 * only_negative / vocabulary FROM l UNION ALL SELECT 'frequent_labels', frequent_labels FROM l
        UNION ALL SELECT 'frequent_both_roles', frequent_both_roles FROM l
        UNION ALL SELECT 'frequent_both_roles_pct', 100.0 * frequent_both_roles / frequent_labels FROM l
        UNION ALL SELECT concat('overlap_', source), mean_overlap FROM dv UNION ALL SELECT concat('shallow_pct_', source), shallow_pct FROM dv)
        SELECT metric, round(value::DOUBLE, 6) AS value FROM r""",
    "tokenize": f"WITH {E} SELECT doc_id, len(tok) AS n_tokens, md5(coalesce(array_to_string(tok, ' '), '')) AS tokens FROM e",
    "word_counts": f"WITH {W} SELECT origin, word, n FROM wc",
    "word_counts_content": f"WITH {W} SELECT origin, word, n FROM wc WHERE word NOT IN {STOP}",
    "token_stats": f"""WITH {W} SELECT origin, sum(n)::BIGINT AS tokens, count(*) AS types,
        coalesce(sum(n) FILTER (word NOT IN {STOP}), 0)::BIGINT AS content_tokens, count(*) FILTER (word NOT IN {STOP}) AS content_types,
        count(*) FILTER (n = 1) AS hapaxes FROM wc GROUP BY origin""",
    "top_words": f"""WITH {W} SELECT origin, word, n, row_number() OVER (PARTITION BY origin ORDER BY n DESC, word) AS rank FROM wc
        WHERE word NOT IN {STOP} QUALIFY rank <= 30""",
    "top_words_many": f"""WITH {W} SELECT origin, word, n, row_number() OVER (PARTITION BY origin ORDER BY n DESC, word) AS rank FROM wc
        QUALIFY rank <= 5000""",
    "ttr": f"""WITH {W} SELECT origin, round(count(*) / sum(n), 6) AS ttr,
        round(count(*) FILTER (word NOT IN {STOP}) / sum(n) FILTER (word NOT IN {STOP}), 6) AS ttr_content FROM wc GROUP BY origin""",
    "msttr": f"WITH {E},{segments(False)}",
    "msttr_content": f"WITH {E},{segments(True)}",
    "hapax_ratio": f"""WITH {W} SELECT origin, count(*) AS types, count(*) FILTER (n = 1) AS hapaxes,
        round(count(*) FILTER (n = 1) / count(*), 6) AS hapax_ratio FROM wc GROUP BY origin""",
    "text_ttr": f"WITH {E} SELECT doc_id, CASE WHEN len(tok) > 0 THEN round(len(list_distinct(tok)) / len(tok), 6) ELSE 0.0 END::DOUBLE AS text_ttr FROM e",
    "ttr_by_group": f"""WITH {W}, x AS (SELECT genre, count(DISTINCT word) / count(*) AS ttr FROM tk GROUP BY genre)
        (SELECT genre, round(ttr, 6) AS ttr, 'top' AS "end" FROM x ORDER BY x.ttr DESC, genre LIMIT 5) UNION ALL
        (SELECT genre, round(ttr, 6), 'bottom' FROM x ORDER BY x.ttr, genre LIMIT 5)""",
    "text_quality": f"WITH {Q} SELECT doc_id, {', '.join(f'round({c}, 6) AS {c}' for c in QUAL[:4])} FROM q",
    "flesch_kincaid": f"WITH {Q} SELECT doc_id, round(flesch_kincaid, 6) AS flesch_kincaid FROM q",
    "coleman_liau": f"WITH {Q} SELECT doc_id, round(coleman_liau, 6) AS coleman_liau FROM q",
    "quality_by_genre": f"""WITH {Q}{G} SELECT genre, round(avg(flesch_kincaid), 6) AS flesch_kincaid, round(avg(coleman_liau), 6) AS coleman_liau,
        round(avg(avg_word_len), 6) AS avg_word_len, is_new FROM q JOIN gn USING (genre) GROUP BY genre, is_new""",
    "quality_by_new_flag": f"WITH {Q}{G} SELECT is_new, count(*) AS n, round(avg(flesch_kincaid), 6) AS flesch_kincaid FROM q JOIN gn USING (genre) GROUP BY is_new",
    "bigrams": f"WITH {E},{within_ctes(2)} SELECT ngram, n FROM ng",
    "top_bigrams_across_texts": f"""WITH {E},{ngram_ctes(2, True, by='origin')} SELECT grp AS origin, ngram, n,
        row_number() OVER (PARTITION BY grp ORDER BY n DESC, ngram) AS rank FROM ng QUALIFY rank <= 20""",
    "trigrams_across_texts": f"WITH {E},{ngram_ctes(3, False, by='origin')} SELECT grp AS origin, ngram, n FROM ng",
    "top_trigrams": f"WITH {E},{within_ctes(3)} SELECT ngram, n FROM ng ORDER BY n DESC, ngram LIMIT 20",
    "ngram_overlap": f"""WITH {E},{ngram_ctes(2, True, by='origin')},
        a AS (SELECT ngram FROM ng WHERE grp = 'local_new' ORDER BY n DESC, ngram LIMIT 5000),
        b AS (SELECT ngram FROM ng WHERE grp = 'hf_published' ORDER BY n DESC, ngram LIMIT 5000)
        SELECT (SELECT count(*) FROM a JOIN b USING (ngram)) AS shared, (SELECT count(*) FROM a ANTI JOIN b USING (ngram)) AS left_only,
            (SELECT count(*) FROM b ANTI JOIN a USING (ngram)) AS right_only,
            round(100.0::DOUBLE * (SELECT count(*) FROM a JOIN b USING (ngram)) / 5000, 6) AS shared_pct""",
    "new_genre_bigrams": f"""WITH {E}{G},{ngram_ctes(2, True, where='genre IN (SELECT genre FROM gn WHERE is_new)')}
        SELECT ngram, n FROM ng ORDER BY n DESC, ngram LIMIT 15""",
    "lexical_richness": f"""WITH {W},{richness('origin')} SELECT origin, n_texts, tokens, types, round(yules_k, 6) AS yules_k,
        round(brunets_w, 6) AS brunets_w, round(honores_h, 6) AS honores_h, round(ttr, 6) AS ttr FROM rich""",
    "lexical_richness_by_genre": f"""WITH {W}{G},{richness('genre')} SELECT genre, n_texts, tokens, types, round(yules_k, 6) AS yules_k,
        round(brunets_w, 6) AS brunets_w, round(honores_h, 6) AS honores_h, round(ttr, 6) AS ttr, is_new FROM rich JOIN gn USING (genre)""",
    "five_numbers": f"""WITH {W}{G},{richness('genre')}, rn AS (SELECT * FROM rich JOIN gn USING (genre)),
        lf AS ({long_form('rn', ('yules_k', 'brunets_w', 'honores_h'), 'is_new')})
        SELECT is_new, metric, round(min(v), 6) AS min, round(quantile_cont(v, 0.25), 6) AS p25, round(quantile_cont(v, 0.5), 6) AS p50,
            round(quantile_cont(v, 0.75), 6) AS p75, round(max(v), 6) AS max FROM lf GROUP BY ALL""",
    "category_words": f"""WITH {W}{G}, c AS (SELECT category, word, count(*) AS n FROM tk JOIN gn USING (genre) WHERE word NOT IN {STOP} GROUP BY ALL),
        r AS (SELECT *, n / max(n) OVER (PARTITION BY category) AS scaled FROM c
            QUALIFY row_number() OVER (PARTITION BY category ORDER BY n DESC, word) <= 15)
        SELECT w.word, k.category, round(coalesce(scaled, 0), 6) AS scaled FROM (SELECT DISTINCT word FROM r) w
        CROSS JOIN (SELECT DISTINCT category FROM gn) k LEFT JOIN r ON r.word = w.word AND r.category IS NOT DISTINCT FROM k.category""",
    "compare_means": f"""WITH {ENRICH}, lf AS ({long_form('en', NUM)}) SELECT metric, round(avg(v) FILTER (origin = 'local_new'), 6) AS mean_left,
        round(avg(v) FILTER (origin = 'hf_published'), 6) AS mean_right,
        round(avg(v) FILTER (origin = 'local_new') - avg(v) FILTER (origin = 'hf_published'), 6) AS difference FROM lf GROUP BY metric""",
    "ks_two_sample": f"WITH {ENRICH}, lf AS ({long_form('en', NUM)}),{KS}{KS_SELECT}",
    "ks_two_sample_quality": f"WITH {Q}, lf AS ({long_form('q', QUAL)}),{KS}{KS_SELECT}",
    "mann_whitney": f"""WITH {ENRICH}, lf AS ({long_form('en', NUM)}),
        rk AS (SELECT metric, origin, v, rank() OVER w + (count(*) OVER (PARTITION BY metric, v) - 1) / 2 AS r FROM lf WINDOW w AS (PARTITION BY metric ORDER BY v)),
        ti AS (SELECT metric, sum(t * t * t - t) AS ties FROM (SELECT metric, count(*)::DOUBLE AS t FROM lf GROUP BY metric, v) GROUP BY metric),
        u AS (SELECT metric, count(*) FILTER (origin = 'local_new')::DOUBLE AS na, count(*) FILTER (origin = 'hf_published')::DOUBLE AS nb,
            sum(r) FILTER (origin = 'local_new') AS ra FROM rk GROUP BY metric),
        z AS (SELECT metric, ra - na * (na + 1) / 2 AS u, greatest(abs(ra - na * (na + 1) / 2 - na * nb / 2) - 0.5, 0)
            / sqrt(na * nb / 12 * ((na + nb + 1) - ties / ((na + nb) * (na + nb - 1)))) AS z FROM u JOIN ti USING (metric))
        SELECT metric, round(u, 6) AS u_stat, round(least(1.0::DOUBLE, 2 / sqrt(2 * pi()) * 0.002 * exp(-z * z / 2) * (
            list_sum(list_transform(range(0, 6000), lambda i: exp(-(z * (i + 0.5) * 0.002 + pow((i + 0.5) * 0.002, 2) / 2)))))), 6) AS mw_p FROM z""",
    "stream_expand": f"""WITH {B} SELECT 'wikipedia' AS source, genre, language_level, md5(text) AS text, {JOINED}
        FROM x WHERE len(labels) > 0 AND len(not_labels) > 0""",
    "stream_increment_replayed": f"WITH {INC} SELECT md5(text) AS text, split, {JOINED}, model FROM d WHERE split <> 'dropped'",
    "stream_increment": f"WITH {INC} SELECT md5(text) AS text, split, {JOINED}, model FROM d WHERE split <> 'dropped'",
}
