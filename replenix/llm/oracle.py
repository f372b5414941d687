"""The same results as independent SQL (DuckDB dialect), where SQL can express them."""

from __future__ import annotations

from replenix.llm.quality import CHAR_CLASSES, COMMON_WORDS, SYMBOLS, Limits

_SPACE = r"[\x20\x09-\x0D]+"
_NO_SPACE = r"[^\x20\x09-\x0D]"


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def op8_sql(limits: Limits = Limits()) -> str:
    def kept_chars(cls: str) -> str:
        return f"length(regexp_replace(t, {_quote('[^' + cls + ']+')}, '', 'g'))"

    classes = ", ".join(kept_chars(c) for c in CHAR_CLASSES.values())
    other = f"length(regexp_replace(t, {_quote('[' + ''.join(CHAR_CLASSES.values()) + ']+')}, '', 'g'))"
    bins = " ".join(
        f"when '{k}' then [" + ", ".join(f"len([x for x in ws if x = '{w}'])" for w in ws)
        + ", len([x for x in ws if x not in (" + ", ".join(f"'{w}'" for w in ws) + ")])]"
        for k, ws in COMMON_WORDS.items())
    n_char, n_word = len(CHAR_CLASSES) + 1, 1 + len(COMMON_WORDS["en"])
    char_means = "[" + ", ".join(f"avg(cb[{i}] / n_chars)" for i in range(1, n_char + 1)) + "] AS rc"
    word_means = "[" + ", ".join(f"avg(wb[{i}] / n_words)" for i in range(1, n_word + 1)) + "] AS rw"

    def distance(bins_: str, total: str, ref: str, n: int) -> str:
        terms = []
        for i in range(1, n + 1):
            p, q = f"({bins_}[{i}] / {total})", f"{ref}[{i}]"
            terms.append(f"case when {p} > 0 then {p} * log2(2 * {p} / ({p} + {q})) else 0 end / 2"
                         f" + case when {q} > 0 then {q} * log2(2 * {q} / ({p} + {q})) else 0 end / 2")
        return f"sqrt(greatest(0, {' + '.join(terms)}))"

    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, lang, t, length(t) AS n_chars,
        [x for x in string_split_regex(t, '{_SPACE}') if x <> ''] AS ws,
        [x for x in string_split(t, chr(10)) if regexp_matches(x, '{_NO_SPACE}')] AS ls
      FROM d),
m AS (SELECT rid, doc_id, lang, ws, n_chars, len(ws) AS n_words,
        length(regexp_replace(t, '{_SPACE}', '', 'g')) AS word_chars,
        {kept_chars(SYMBOLS)} AS n_symbols,
        len(ls) - len(list_distinct(ls)) AS n_dup_lines,
        [{classes}, {other}] AS cb
      FROM w),
win AS (SELECT rid, i, list_slice(ws, i, i + 4) AS five
        FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM m)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, five) AS c FROM win) WHERE c > 1),
rep AS (SELECT rid, count(DISTINCT i + o) AS n_repeat_words
        FROM twice, (SELECT unnest(range(0, 5)) AS o) GROUP BY rid),
crefs AS (SELECT lang AS ref, {char_means} FROM m
          WHERE lang IS NOT NULL AND n_words >= {limits.words_guard} AND n_chars >= {limits.chars_guard}
          GROUP BY lang ORDER BY count(*) DESC, lang LIMIT {limits.languages}),
bins AS (SELECT k.lang AS ref, m.* EXCLUDE (lang), m.lang, case k.lang {bins} end AS wb
         FROM m, (SELECT unnest([{', '.join(f"'{k}'" for k in COMMON_WORDS)}]) AS lang) k
         WHERE k.lang IN (SELECT ref FROM crefs)),
wrefs AS (SELECT lang AS ref, {word_means} FROM bins
          WHERE ref = lang AND n_words >= {limits.words_guard} AND n_chars >= {limits.chars_guard} GROUP BY lang),
cdist AS (SELECT rid, min(d) AS cd, min(struct_pack(d := d, ref := ref)).ref AS near
          FROM (SELECT rid, ref, {distance('cb', 'n_chars', 'rc', n_char)} AS d
                FROM m JOIN crefs ON lang = ref OR lang IS NULL WHERE n_words > 0) c GROUP BY rid),
wdist AS (SELECT rid, min({distance('wb', 'n_words', 'rw', n_word)}) AS wd
          FROM bins JOIN wrefs USING (ref) LEFT JOIN cdist USING (rid)
          WHERE n_words > 0 AND (lang = ref OR lang IS NULL AND near IN (SELECT ref FROM wrefs)) GROUP BY rid),
v AS (SELECT m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
        n_words < {limits.min_words} OR 100 * coalesce(n_repeat_words, 0) > {limits.max_repeat_percent} * n_words
          AS base_failed,
        case when n_chars >= {limits.chars_guard} then cd end AS cd,
        case when n_words >= {limits.words_guard} then wd end AS wd
      FROM m LEFT JOIN rep USING (rid) LEFT JOIN cdist USING (rid) LEFT JOIN wdist USING (rid))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND coalesce(cd, 0) <= {limits.max_char_distance}
         AND coalesce(wd, 0) <= {limits.max_word_distance}
         AND coalesce(cd + wd, 0) <= {limits.max_distance_sum} AS kept
FROM v"""


def op11_sql() -> str:
    return """
WITH v AS (SELECT row_number() OVER () AS rid, vec_id, [floor(256 * x::DOUBLE)::BIGINT for x in embedding] AS e
           FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.rid, q.vec_id AS query_id, c.vec_id, c.rid AS other,
             coalesce(list_sum([p[1] * p[2] for p in list_zip(q.e, c.e)]), 0)::BIGINT AS score
      FROM v q JOIN v c ON len(q.e) = len(c.e) AND q.rid <> c.rid WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id, other) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5"""


def op12_sql() -> str:
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    term = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({lowered}, '{term}') AS ts
           FROM documents WHERE text IS NOT NULL),
i AS (SELECT row_number() OVER () AS iid, item_id, regexp_extract_all({lowered}, '{term}') AS ts
      FROM benchmark WHERE text IS NOT NULL),
it AS (SELECT iid, t, count(*) AS times FROM (SELECT iid, unnest(ts) AS t FROM i) GROUP BY iid, t),
p AS (SELECT rid, t, count(*) AS tf FROM (SELECT rid, unnest(ts) AS t FROM d)
      WHERE t IN (SELECT t FROM it) GROUP BY rid, t),
c AS (SELECT count(*)::BIGINT AS n_docs, sum(len(ts))::BIGINT AS n_terms FROM d WHERE len(ts) > 0),
w AS (SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, c GROUP BY t, n_docs),
m AS (SELECT rid, doc_id, 25 + (75 * len(ts) * n_docs) // n_terms AS m FROM d, c WHERE len(ts) > 0),
s AS (SELECT iid, rid, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM it JOIN p USING (t) JOIN w USING (t) JOIN m USING (rid) GROUP BY iid, rid, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST, rid) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r JOIN i USING (iid) WHERE rank <= 10"""


def oracle_sql() -> dict[str, str]:
    return {"op8_quality_rules": op8_sql(), "op11_topk_search": op11_sql(), "op12_ranked_search": op12_sql()}
