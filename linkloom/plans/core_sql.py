"""SQL of the core queries for DuckDB, built from shared pieces; written from the operators' definitions."""

from __future__ import annotations

WHITE = r"[\s\p{Z}]"
# Fixed values, written here again so that an error in the engine's own lists shows.
LEGAL_FORMS = (
    r"\b(corp|corporation|inc|incorporated|ltd|limited|pvt|private|llc|llp|co|company|enterprise|enterprises|service|services"
    r"|solution|solutions|group|technologies|tech|sarl|sas|gmbh|ag|plc)\b"
)
ADDRESS_WORDS = dict(
    pair.split("=") for pair in (
        "rd=road st=street ave=avenue blvd=boulevard hwy=highway apt=apartment ste=suite fl=floor nr=near opp=opposite bldg=building "
        "dist=district ctr=center intl=international no=number"
    ).split()
)
COMMON_FIRST_WORDS = (
    "the", "a", "an", "new", "old", "national", "global", "international", "american", "general", "united", "first", "best", "top", "prime",
    "great", "good", "super", "mega", "metro", "city", "state", "central", "north", "south", "east", "west", "royal", "golden", "blue",
    "green", "red", "white", "black", "star", "sun", "sky", "land", "home", "world", "modern", "standard", "professional", "premium",
    "elite", "alpha", "omega", "apex", "delta", "sigma", "shri", "sri", "m", "s", "r", "k",
)
COMMON = ", ".join(f"'{w}'" for w in COMMON_FIRST_WORDS)


def fold(x: str) -> str:
    return f"regexp_replace(strip_accents({x}), '[^\\x00-\\x7F]', '', 'g')"


def sub(x: str, pattern: str, by: str) -> str:
    return f"regexp_replace({x}, '{pattern}', '{by}', 'g')"


def words_only(x: str) -> str:
    return f"trim({sub(sub(x, r'[^\w\s]', ' '), r'\s+', ' ')})"


def clean_name(x: str) -> str:
    return words_only(sub(sub(f"lower({fold(x)})", "&", " and "), LEGAL_FORMS, " "))


def clean_addr(x: str) -> str:
    out = f"lower({fold(x)})"
    for a, b in ADDRESS_WORDS.items():
        out = sub(out, rf"\b{a}\b", b)
    return words_only(out)


def postal(x: str) -> str:
    return rf"regexp_extract({x}, '(?:^|[^\p{{L}}\p{{N}}_])(\d{{5,6}})(?:$|[^\p{{L}}\p{{N}}_])', 1)"


def country(x: str) -> str:
    return f"lower({sub(x, f'^{WHITE}+|{WHITE}+$', '')})"


def toks(x: str) -> str:
    return rf"list_filter(regexp_split_to_array({x}, '\s+'), lambda w: w <> '')"


def nums(x: str) -> str:
    return rf"regexp_extract_all({x}, '\d+')"


def soundex(w: str) -> str:
    def code(letters: str) -> str:
        x = f"substr({letters}, 1, 1) || replace(replace(substr({letters}, 2), 'h', ''), 'w', '')"
        x = f"translate({x}, 'abcdefghijklmnopqrstuvwxyz', '01230120022455012623010202')"
        for d in "0123456":
            x = sub(x, f"{d}+", d)
        return f"substr(replace(substr({x}, 2), '0', ''), 1, 3)"

    letters = sub(f"lower({w})", "[^a-z]", "")
    return (
        f"CASE WHEN {w} = '' THEN '' WHEN regexp_matches({w}, '^[a-zA-Z]') THEN rpad(upper(substr({w}, 1, 1)) || {code(letters)}, 4, '0') "
        f"ELSE rpad(substr({w}, 1, 1) || {code(f"('a' || {letters})")}, 4, '0') END"
    )


def grams(x: str, n: int) -> str:
    return f"list_transform(range(1, greatest(length({x}) - {n - 2}, 1)), lambda i: substr({x}, i, {n}))"


def raw(*numbers: int) -> str:
    return " UNION ALL ".join(
        f"SELECT coalesce(entity_id, '') AS entity_id, coalesce(business_name, '') AS business_name, coalesce(business_address, '') AS business_address, "
        f"coalesce(country, '') AS country, seen_at, loaded_at, substr(coalesce(entity_id, ''), 1, 2) AS source FROM source{i}"
        for i in numbers
    )


FIRST = "row_number() OVER (PARTITION BY entity_id ORDER BY loaded_at NULLS FIRST, seen_at NULLS FIRST, business_name, business_address, country) = 1"
NORMAL = f"{clean_name('business_name')} AS clean_name, {clean_addr('business_address')} AS clean_addr, {postal('business_address')} AS postal"


def norm(name: str, *numbers: int) -> str:
    """A CTE of deduplicated, normalized records."""
    return f"{name} AS MATERIALIZED (SELECT *, {NORMAL} FROM (SELECT * FROM ({raw(*numbers)}) QUALIFY {FIRST}))"


LR = f"{norm('l', 1)}, {norm('r', 2, 3)}"
NAME3 = grams("replace(clean_name, ' ', '')", 3)
COUNTS = f"counts AS MATERIALIZED (SELECT gram, count(*) AS cnt FROM (SELECT unnest({NAME3}) AS gram FROM r) GROUP BY 1)"


def keys(name: str, rows: str) -> str:
    """CTEs of all keys of a side, wide ({name}_w) and long ({name}_k)."""
    return f"""{name}_g AS (SELECT entity_id, unnest({NAME3}) AS gram, unnest(range(length(replace(clean_name, ' ', '')) - 2)) AS pos FROM {rows} WHERE length(replace(clean_name, ' ', '')) >= 3),
{name}_m AS (SELECT entity_id, arg_min(g.gram, coalesce(cnt, 0) * 100000 + pos) AS rarest FROM {name}_g g LEFT JOIN counts USING (gram) GROUP BY 1),
{name}_f AS (SELECT x.*, {country('country')} AS country_lc, coalesce({toks('clean_name')}[1], '') AS first_word,
  array_to_string(list_sort({toks('clean_name')}[1:2]), '') AS sorted_2word, array_to_string(list_sort({nums('clean_addr')}), '') AS sorted_nums,
  coalesce(rarest, '') AS rarest_3gram FROM {rows} x LEFT JOIN {name}_m USING (entity_id)),
{name}_w AS MATERIALIZED (SELECT *, {soundex('first_word')} AS soundex FROM {name}_f),
{name}_k AS MATERIALIZED (SELECT * FROM (
  SELECT entity_id, country_lc, 'first_word' AS kind, first_word AS key FROM {name}_w WHERE first_word NOT IN ({COMMON})
  UNION ALL SELECT entity_id, country_lc, 'postal', postal FROM {name}_w
  UNION ALL SELECT entity_id, country_lc, 'sorted_2word', sorted_2word FROM {name}_w WHERE sorted_2word NOT IN ({COMMON})
  UNION ALL SELECT entity_id, country_lc, 'sorted_nums', sorted_nums FROM {name}_w
  UNION ALL SELECT entity_id, country_lc, 'soundex', soundex FROM {name}_w WHERE first_word NOT IN ({COMMON})
  UNION ALL SELECT entity_id, country_lc, 'rarest_3gram', rarest_3gram FROM {name}_w) WHERE key <> '')"""


BOTH = f"{LR}, {COUNTS}, {keys('a', 'l')}, {keys('b', 'r')}"


def block(cap: int, kind: str | None = None, left: str = "a_k") -> str:
    which = f"kind = '{kind}'" if kind else "true"
    return f"""SELECT DISTINCT x.entity_id AS source1_entity_id, y.entity_id AS candidate_entity_id FROM {left} x JOIN b_k y USING (kind, country_lc, key)
JOIN (SELECT kind, country_lc, key FROM b_k WHERE {which} GROUP BY 1, 2, 3 HAVING count(*) <= {cap}) v USING (kind, country_lc, key)"""


def strip(x: str) -> str:
    return sub(x, f"^{WHITE}+|{WHITE}+$", "")


def parsed(c: str) -> str:
    return f"CASE WHEN lower({strip(c)}) = 'nan' THEN []::VARCHAR[] ELSE list_filter(list_transform(string_split(coalesce({c}, ''), ','), lambda x: {strip('x')}), lambda x: x <> '') END"


def exploded(source: str) -> str:
    return f"SELECT DISTINCT source1_entity_id, unnest({parsed('matched_entity_ids')}) AS candidate_entity_id FROM {source}"


def jac(a: str, b: str, empty: str = "0.0") -> str:
    """Of distinct lists."""
    u = f"len(list_distinct(list_concat({a}, {b})))"
    return f"CASE WHEN {u} > 0 THEN len(list_intersect({a}, {b})) / {u} ELSE {empty} END"


PAIRS = f"pairs AS (SELECT * FROM ({exploded('train_matches')} UNION {exploded('matching_results')}) WHERE source1_entity_id IS NOT NULL)"


def attributes(pairs: str) -> str:
    cols = ", ".join(f"coalesce({s}.{c}, '') AS {k}{i}" for i, s in ((1, "l"), (2, "r")) for c, k in (("clean_name", "name"), ("clean_addr", "addr"), ("postal", "postal"), ("country", "country")))
    return f"""att AS MATERIALIZED (SELECT p.source1_entity_id, p.candidate_entity_id, {cols} FROM {pairs} p
LEFT JOIN l ON l.entity_id = p.source1_entity_id LEFT JOIN r ON r.entity_id = p.candidate_entity_id),
att2 AS MATERIALIZED (SELECT *, {toks('name1')} AS t1, {toks('name2')} AS t2, list_distinct({toks('name1')}) AS u1, list_distinct({toks('name2')}) AS u2,
 list_distinct({toks('addr1')}) AS s1, list_distinct({toks('addr2')}) AS s2, list_distinct({nums('addr1')}) AS d1, list_distinct({nums('addr2')}) AS d2,
 list_distinct({grams('name1', 2)}) AS g1, list_distinct({grams('name2', 2)}) AS g2,
 coalesce({toks('name1')}[1], '') AS w1, coalesce({toks('name2')}[1], '') AS w2,
 greatest(length(name1), length(name2)) AS longest, least(length(name1), length(name2)) AS shortest FROM att)"""


def lcs(a: str, b: str) -> str:
    """Length of the longest common subsequence: rows of the usual table, folded over the letters of a; cells are texts, since a fold keeps its type."""
    cell = f"CASE WHEN substr({b}, j[1]::INT, 1) = ch[1] THEN (row[j[1]::INT]::INT + 1)::VARCHAR ELSE greatest(row[j[1]::INT + 1]::INT, acc[j[1]::INT]::INT)::VARCHAR END"
    row = f"list_reduce(list_transform(range(1, length({b}) + 1), lambda j: [j::VARCHAR]), lambda acc, j: list_append(acc, {cell}), ['0'])"
    return f"list_reduce(list_transform(list_filter(string_split({a}, ''), lambda c: c <> ''), lambda c: [c]), lambda row, ch: {row}, list_resize(['0'], length({b}) + 1, '0'))[-1]::INT"


def indel(a: str, b: str) -> str:
    return f"CASE WHEN length({a}) + length({b}) = 0 THEN 1.0 WHEN length({a}) = 0 OR length({b}) = 0 THEN 0.0 ELSE 2.0 * {lcs(a, b)} / (length({a}) + length({b})) END"


def sorted_text(t: str) -> str:
    return f"array_to_string(list_sort({t}), ' ')"


def set_parts(x: str, y: str) -> str:
    """Texts of the common tokens (base), and of these with either side's own (wx, wy)."""
    own = lambda a, b: f"list_filter({a}, lambda w: NOT list_contains({b}, w))"
    both = f"list_intersect({x}, {y})"
    join = lambda a, b: f"trim({sorted_text(both)} || ' ' || {sorted_text(own(a, b))})"
    return f"{x} AS x, {y} AS y, {sorted_text(both)} AS base, {join(x, y)} AS wx, {join(y, x)} AS wy, len({both}) AS nb, len({own(x, y)}) AS nx, len({own(y, x)}) AS ny"


TOKEN_SET = f"""CASE WHEN len(x) = 0 OR len(y) = 0 THEN 0.0 WHEN nb > 0 AND (nx = 0 OR ny = 0) THEN 1.0
 WHEN nb = 0 THEN {indel('wx', 'wy')} ELSE greatest({indel('wx', 'wy')}, {indel('base', 'wx')}, {indel('base', 'wy')}) END"""

FILLED = "len(u1) > 0 AND len(u2) > 0"
BOTH_N = "len(list_intersect(u1, u2))"
POSTAL_MATCH = "CASE WHEN postal1 = '' OR postal2 = '' THEN 0.5 WHEN postal1 = postal2 THEN 1.0 ELSE 0.0 END"
FEATURE_SQL = {
    "name_jaccard": jac("u1", "u2"),
    "name_first_word": "CASE WHEN w1 <> '' AND w1 = w2 THEN 1.0 ELSE 0.0 END",
    "name_len_diff": "CASE WHEN longest > 0 THEN (longest - shortest) / longest ELSE 0.0 END",
    "name_soundex": f"CASE WHEN w1 <> '' AND {soundex('w1')} = {soundex('w2')} THEN 1.0 ELSE 0.0 END",
    "addr_jaccard": jac("s1", "s2"),
    "postal_match": POSTAL_MATCH,
    "country_match": f"CASE WHEN {country('country1')} = {country('country2')} THEN 1.0 ELSE 0.0 END",
    "digit_jaccard": jac("d1", "d2", "1.0"),
    "name_jaro_winkler": "CASE WHEN name1 = '' OR name2 = '' THEN 0.0 ELSE jaro_winkler_similarity(name1, name2) END",
    "addr_jaro_winkler": "CASE WHEN addr1 = '' OR addr2 = '' THEN 0.0 ELSE jaro_winkler_similarity(addr1, addr2) END",
    "name_fuzz": indel("name1", "name2"),
    "addr_fuzz": indel("addr1", "addr2"),
    "name_contains": f"CASE WHEN {FILLED} AND {BOTH_N} = least(len(u1), len(u2)) THEN 1.0 ELSE 0.0 END",
    "name_sorted_tokens_exact": f"CASE WHEN {FILLED} AND {BOTH_N} = len(u1) AND {BOTH_N} = len(u2) THEN 1.0 ELSE 0.0 END",
    "name_prefix_match": "CASE WHEN longest > 0 THEN coalesce(list_min(list_filter(range(1, shortest + 1), lambda i: substr(name1, i, 1) <> substr(name2, i, 1))) - 1, shortest) / longest ELSE 0.0 END",
    "name_char_jaccard": jac("g1", "g2"),
    "name_token_overlap_ratio": f"CASE WHEN {FILLED} THEN {BOTH_N} / least(len(u1), len(u2)) ELSE 0.0 END",
    "name_length_ratio": "CASE WHEN longest > 0 THEN shortest / longest ELSE 0.0 END",
    "addr_digit_exact": "CASE WHEN len(list_intersect(d1, d2)) = len(d1) AND len(d1) = len(d2) THEN 1.0 ELSE 0.0 END",
    "num_token_diff": "CASE WHEN greatest(len(t1), len(t2)) > 0 THEN abs(len(t1) - len(t2)) / greatest(len(t1), len(t2)) ELSE 0.0 END",
}

WITH_SETS = {
    "name_token_sort": (f"{sorted_text('t1')} AS wx, {sorted_text('t2')} AS wy", indel("wx", "wy")),
    "name_token_set": (set_parts("u1", "u2"), TOKEN_SET),
    "addr_token_set": (set_parts("s1", "s2"), TOKEN_SET),
}

LABELLED = "a_t AS (SELECT * FROM a_k WHERE entity_id IN (SELECT source1_entity_id FROM train_matches))"
TRUE = f"truth AS (SELECT source1_entity_id, matched_entity_ids FROM train_matches), links AS ({exploded('train_matches')})"
THRESHOLD, MARGIN = 0.6, 0.1


def proxy(left: str) -> str:
    return f"""{BOTH}, {LABELLED}, {TRUE}, bp AS MATERIALIZED ({block(800, left=left)}), {attributes('bp')},
scored AS MATERIALIZED (SELECT source1_entity_id, candidate_entity_id, round(({jac('u1', 'u2')} + {jac('s1', 's2')} + {POSTAL_MATCH}) / 3, 6) AS prob FROM att2)"""


PROXY, PROXY_T = proxy("a_k"), proxy("a_t")


def stats(threshold: str = str(THRESHOLD)) -> str:
    return f"""(SELECT *, top_score - second_score AS margin FROM (SELECT source1_entity_id, max(prob) AS top_score, count(*) AS n_candidates,
 count(*) FILTER (prob >= {threshold}) AS n_above, coalesce(list_reverse_sort(list(prob))[2], 0.0) AS second_score FROM scored GROUP BY 1))"""


def accepted(threshold: float = THRESHOLD, margin: float = MARGIN) -> str:
    return f"""accepted AS MATERIALIZED (SELECT s.* FROM scored s JOIN {stats(str(threshold))} t USING (source1_entity_id)
WHERE prob >= {threshold} AND NOT (n_above = 1 AND margin < {margin} AND top_score < {threshold} + 0.05))"""


def collapse(pairs: str, every: str, out: str = "matched_entity_ids") -> str:
    return f"""SELECT e.source1_entity_id, coalesce(x.ids, '') AS {out} FROM {every} e LEFT JOIN
(SELECT source1_entity_id, string_agg(DISTINCT candidate_entity_id, ',' ORDER BY candidate_entity_id) AS ids FROM {pairs} GROUP BY 1) x USING (source1_entity_id)"""


def decided(threshold: float = THRESHOLD, margin: float = MARGIN) -> str:
    return f"{PROXY_T}, {accepted(threshold, margin)}, pred AS MATERIALIZED ({collapse('accepted', '(SELECT source1_entity_id FROM train_matches)')})"


def rates(hits: str, pred: str, true: str) -> str:
    return f"""CASE WHEN {pred} = 0 THEN 1.0 WHEN {true} = 0 THEN 0.0 ELSE {hits} / {pred} END AS p,
CASE WHEN {true} = 0 THEN 1.0 WHEN {pred} = 0 THEN 0.0 ELSE {hits} / {true} END AS r"""


FB = "CASE WHEN 0.25 * p + r > 0 THEN 1.25 * p * r / (0.25 * p + r) ELSE 0.0 END"


def scores(threshold: float = THRESHOLD, margin: float = MARGIN) -> str:
    return f"""{decided(threshold, margin)}, ent AS (SELECT *, {FB} AS f FROM (SELECT t.source1_entity_id, len(x) AS actual, {rates('len(list_intersect(x, y))', 'len(y)', 'len(x)')}
FROM (SELECT source1_entity_id, list_distinct({parsed('matched_entity_ids')}) AS x FROM truth) t
LEFT JOIN (SELECT source1_entity_id, list_distinct({parsed('matched_entity_ids')}) AS y FROM pred) p USING (source1_entity_id)))"""


SCORES = scores()
MACRO = "round(avg(p), 6) AS macro_precision, round(avg(r), 6) AS macro_recall, round(avg(f), 6) AS macro_f05"
SWEEP = f"""{PROXY_T}, grid AS (SELECT t.v / 100 AS threshold, m.v / 100 AS margin_min, (t.v - 50) // 2 * 5 + m.v // 5 AS cell FROM (SELECT unnest(range(50, 99, 2)) AS v) t, (SELECT unnest(range(0, 21, 5)) AS v) m),
st AS ({stats('0')}),
cells AS (SELECT t.source1_entity_id, cell, threshold, margin_min, len(list_distinct({parsed('matched_entity_ids')})) AS actual,
 count(s.prob) FILTER (s.prob >= threshold) AS n, count(k.source1_entity_id) FILTER (s.prob >= threshold) AS hits,
 any_value(st.margin) AS mg, any_value(st.top_score) AS top
 FROM truth t CROSS JOIN grid LEFT JOIN scored s USING (source1_entity_id) LEFT JOIN links k ON k.source1_entity_id = s.source1_entity_id AND k.candidate_entity_id = s.candidate_entity_id
 LEFT JOIN st ON st.source1_entity_id = t.source1_entity_id GROUP BY ALL),
kept AS (SELECT *, CASE WHEN margin_min > 0 AND n = 1 AND mg < margin_min AND top < threshold + 0.05 THEN 0 ELSE 1 END AS k FROM cells),
sweep AS (SELECT cell, threshold, margin_min, avg(p) AS macro_precision, avg(r) AS macro_recall, avg({FB}) AS macro_f05 FROM
 (SELECT cell, threshold, margin_min, {rates('hits * k', 'n * k', 'actual')} FROM kept) GROUP BY 1, 2, 3)"""

WHOLE = "clean_name || ' ' || clean_addr || ' ' || postal"


def word_grams(x: str) -> str:
    inner = "list_transform(range(1, length(' ' || w || ' ') - n + 2), lambda i: substr(' ' || w || ' ', i, n))"
    return f"flatten(list_transform({toks(f'lower({x})')}, lambda w: flatten(list_transform(range(2, least(4, length(w) + 2) + 1), lambda n: {inner}))))"


def rgrams(name: str, rows: str) -> str:
    return f"{name} AS MATERIALIZED (SELECT country, entity_id, gram, count(*) AS tf FROM (SELECT country, entity_id, unnest({word_grams(WHOLE)}) AS gram FROM {rows} WHERE country <> '') GROUP BY 1, 2, 3)"


def weights(cap: int) -> str:
    return f"""weights AS MATERIALIZED (SELECT country, gram, df, ctf, ln((1 + n) / (1 + df)) + 1 AS idf FROM
 (SELECT country, gram, count(*) AS df, CAST(sum(tf) AS BIGINT) AS ctf FROM rg GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY country ORDER BY ctf DESC, gram) <= {cap})
 JOIN (SELECT country, count(*) AS n FROM r WHERE country <> '' GROUP BY 1) USING (country))"""


def vectors(name: str, g: str) -> str:
    return f"{name} AS MATERIALIZED (SELECT country, entity_id, gram, x / sqrt(sum(x * x) OVER (PARTITION BY country, entity_id)) AS w FROM (SELECT g.*, (1 + ln(tf)) * idf AS x FROM {g} g JOIN weights USING (country, gram)))"


NEAR = f"""{rgrams('lg', 'l')}, {rgrams('rg', 'r')}, {weights(30000)}, {vectors('lv', 'lg')}, {vectors('rv', 'rg')},
near AS MATERIALIZED (SELECT * FROM (SELECT a.entity_id AS source1_entity_id, b.entity_id AS candidate_entity_id, round(sum(a.w * b.w), 6) AS sim FROM lv a JOIN rv b USING (country, gram) GROUP BY 1, 2)
WHERE sim > 0 QUALIFY row_number() OVER (PARTITION BY source1_entity_id ORDER BY sim DESC, candidate_entity_id) <= 25)"""


def order(c: str) -> str:
    return f"md5('42:' || {c})"


ONE = "(SELECT DISTINCT coalesce(entity_id, '') AS source1_entity_id FROM source1)"
REC23 = f"rec AS (SELECT * FROM ({raw(2, 3)}) QUALIFY {FIRST})"
POS = f"pos AS (SELECT DISTINCT candidate_entity_id AS entity_id FROM ({exploded('train_matches')}))"
PARTS = "CASE WHEN coalesce(matched_entity_ids, '') = '' THEN []::VARCHAR[] ELSE string_split(matched_entity_ids, ',') END"

SQL = {
    "scan_records": f"SELECT entity_id, business_name, business_address, country, source FROM ({raw(1, 2, 3)})",
    "union_sources": f"SELECT source, count(*) AS n FROM ({raw(2, 3)}) GROUP BY 1",
    "split_by_prefix": f"SELECT entity_id, business_name FROM ({raw(1, 2, 3)}) WHERE entity_id LIKE 'S2-%'",
    "dedupe_first": f"WITH {REC23} SELECT entity_id, business_name, business_address, country FROM rec",
    "ascii_fold": f"SELECT entity_id, {fold('business_name')} AS folded FROM ({raw(1, 2, 3)})",
    "normalize_records": f"SELECT entity_id, {NORMAL} FROM ({raw(1, 2, 3)})",
    "clean_name": f"SELECT entity_id, {clean_name('business_name')} AS clean_name FROM ({raw(1, 2, 3)})",
    "clean_addr": f"SELECT entity_id, {clean_addr('business_address')} AS clean_addr FROM ({raw(1, 2, 3)})",
    "extract_postal": f"SELECT entity_id, {postal('business_address')} AS postal FROM ({raw(1, 2, 3)})",
    "country_key": f"SELECT entity_id, {country('country')} AS country_lc FROM ({raw(1, 2, 3)})",
    "distinct_countries": f"SELECT DISTINCT country FROM ({raw(1, 2, 3)}) WHERE country <> ''",
    **{q: f"WITH {BOTH} SELECT entity_id, {c} FROM a_w UNION ALL SELECT entity_id, {c} FROM b_w" for q, c in (("first_word",) * 2, ("sorted_2word",) * 2, ("sorted_nums",) * 2, ("soundex_key", "soundex"), ("rarest_3gram",) * 2)},
    "stopword_filter": f"SELECT * FROM (SELECT entity_id, coalesce({toks(clean_name('business_name'))}[1], '') AS first_word FROM ({raw(1, 2, 3)})) WHERE first_word NOT IN ({COMMON}) AND first_word <> ''",
    "gram_counts": f"WITH {norm('r', 2, 3)}, {COUNTS} SELECT * FROM counts",
    "block_sizes": f"WITH {BOTH} SELECT kind, country_lc, key, count(*) AS n FROM b_k GROUP BY 1, 2, 3",
    "block_valid_keys": f"WITH {BOTH} SELECT kind, country_lc, key FROM b_k GROUP BY 1, 2, 3 HAVING count(*) <= 800",
    **{f"block_{k}": f"WITH {BOTH} {block(800, k)}" for k in ("first_word", "postal", "sorted_2word", "sorted_nums", "soundex", "rarest_3gram")},
    "exact_blocks": f"WITH {BOTH} {block(800)}",
    "collapse_ids": f"WITH {BOTH}, p AS ({block(800, 'first_word')}) {collapse('p', ONE)}",
    "complete_left_join": f"WITH p AS ({exploded('matching_results')}) {collapse('p', ONE)}",
    "in_input_order": f"""WITH p AS ({exploded('matching_results')}), m AS ({collapse('p', ONE)}),
o AS (SELECT entity_id AS source1_entity_id, min(row(loaded_at, entity_id)) AS arrived FROM source1 WHERE loaded_at IS NOT NULL GROUP BY 1)
SELECT source1_entity_id, matched_entity_ids, row_number() OVER (ORDER BY arrived, source1_entity_id) AS place FROM m JOIN o USING (source1_entity_id)""",
    "pair_cap": f"WITH {BOTH} {block(800, 'postal')} ORDER BY 1, 2 LIMIT 500",
    "char_grams": f"WITH {norm('x', 1, 2, 3)}, {rgrams('g', 'x')} SELECT * FROM g",
    "tfidf_vocab": f"WITH {norm('r', 2, 3)}, {rgrams('rg', 'r')}, {weights(5000)} SELECT country, gram, df, ctf, round(idf, 6) AS idf FROM weights",
    "tfidf_weights": f"WITH {norm('r', 2, 3)}, {rgrams('rg', 'r')}, {weights(30000)}, {vectors('rv', 'rg')} SELECT country, entity_id, gram, round(w, 6) AS w FROM rv",
    "tfidf_topk": f"WITH {LR}, {NEAR} SELECT * FROM near",
    "candidate_pairs": f"WITH {BOTH}, {NEAR} SELECT source1_entity_id, candidate_entity_id FROM near UNION {block(800)}",
    "pair_attributes": f"WITH {LR}, {PAIRS}, {attributes('pairs')} SELECT * FROM att",
    **{f"feat_{k}": f"WITH {LR}, {PAIRS}, {attributes('pairs')} SELECT source1_entity_id, candidate_entity_id, round(CAST({v} AS DOUBLE), 6) AS {k} FROM att2" for k, v in FEATURE_SQL.items()},
    **{f"feat_{k}": f"WITH {LR}, {PAIRS}, {attributes('pairs')}, parts AS (SELECT *, {parts} FROM att2) SELECT source1_entity_id, candidate_entity_id, round(CAST({v} AS DOUBLE), 6) AS {k} FROM parts" for k, (parts, v) in WITH_SETS.items()},
    "feature_backfill": f"WITH {LR}, {PAIRS}, {attributes('pairs')} SELECT source1_entity_id, candidate_entity_id, round({jac('u1', 'u2')}, 6) AS name_jaccard, 0.0 AS name_fuzz FROM att2",
    "label_pairs": f"WITH {BOTH}, {LABELLED}, {TRUE}, bp AS ({block(800, left='a_t')}) SELECT bp.*, CASE WHEN links.source1_entity_id IS NULL THEN 0 ELSE 1 END AS label FROM bp LEFT JOIN links USING (source1_entity_id, candidate_entity_id)",
    "class_balance": f"WITH {BOTH}, {LABELLED}, {TRUE}, bp AS ({block(800, left='a_t')}), c AS (SELECT count(links.source1_entity_id) AS pos, count(*) - count(links.source1_entity_id) AS neg FROM bp LEFT JOIN links USING (source1_entity_id, candidate_entity_id)) SELECT pos, neg, round(neg / greatest(pos, 1), 6) AS scale_pos_weight FROM c",
    "positives_by_country": f"WITH {REC23}, {POS} SELECT country, count(*) AS n FROM rec JOIN pos USING (entity_id) GROUP BY 1",
    "semi_positive": f"WITH {REC23}, {POS} SELECT entity_id FROM rec SEMI JOIN pos USING (entity_id)",
    "anti_negative": f"WITH {REC23}, {POS} SELECT entity_id FROM rec ANTI JOIN pos USING (entity_id)",
    "candidate_pool": f"""WITH {REC23}, {POS}, p AS (SELECT rec.* FROM rec SEMI JOIN pos USING (entity_id)), used AS (SELECT country, count(*) AS u FROM p GROUP BY 1),
neg AS (SELECT rec.*, row_number() OVER (PARTITION BY country ORDER BY {order('entity_id')}, entity_id) AS n FROM rec ANTI JOIN pos USING (entity_id))
SELECT entity_id, true AS positive FROM p UNION ALL SELECT entity_id, false FROM neg LEFT JOIN used USING (country) WHERE n <= 300 - coalesce(u, 0)""",
    "sample_source1": f"SELECT entity_id FROM (SELECT DISTINCT coalesce(entity_id, '') AS entity_id FROM source1) ORDER BY {order('entity_id')}, entity_id LIMIT 100",
    "entity_split": f"SELECT source1_entity_id, CAST('0x' || substr({order('source1_entity_id')}, 1, 8) AS BIGINT) / 4294967296.0 < 0.2 AS held_out FROM train_matches",
    "entity_stats": f"WITH {PROXY} SELECT source1_entity_id, round(top_score, 6) AS top_score, n_candidates, n_above, round(second_score, 6) AS second_score, round(margin, 6) AS margin FROM {stats()}",
    "second_best": f"WITH {PROXY} SELECT source1_entity_id, second_score FROM {stats()}",
    "threshold_filter": f"WITH {PROXY} SELECT * FROM scored WHERE prob >= {THRESHOLD}",
    "singleton_reject": f"WITH {PROXY}, {accepted()} SELECT * FROM accepted",
    "decide_matches": f"WITH {PROXY}, {accepted()} {collapse('accepted', ONE)}",
    "match_totals": "SELECT count(*) FILTER (trim(coalesce(matched_entity_ids, '')) <> '') AS matched, count(*) FILTER (trim(coalesce(matched_entity_ids, '')) = '') AS unmatched FROM matching_results",
    "parse_id_list": f"SELECT source1_entity_id, matched_entity_ids, array_to_string({parsed('matched_entity_ids')}, '|') AS parsed FROM matching_results",
    "f_beta": f"WITH {SCORES} SELECT source1_entity_id, round(p, 6) AS p, round(r, 6) AS r, round(f, 6) AS f FROM ent",
    "macro_f05": f"WITH {SCORES} SELECT {MACRO} FROM ent",
    **{q: f"WITH {x} SELECT {MACRO}, count(*) AS n_entities, count(*) FILTER (actual = 0) AS n_singletons, count(*) FILTER (actual > 0) AS n_with_matches FROM ent" for q, x in (("macro_f05_counts", SCORES), ("score_at_threshold", scores(0.7, 0.05)))},
    "threshold_sweep": f"WITH {SWEEP} SELECT cell, threshold, margin_min, round(macro_precision, 6) AS macro_precision, round(macro_recall, 6) AS macro_recall, round(macro_f05, 6) AS macro_f05 FROM sweep",
    "sweep_best": f"WITH {SWEEP} SELECT threshold, margin_min, round(macro_f05, 6) AS macro_f05 FROM sweep ORDER BY round(macro_f05, 9) DESC, cell LIMIT 1",
    "read_ids": f"SELECT DISTINCT entity_id FROM ({raw(1, 2, 3)})",
    "check_missing": f"SELECT o.source1_entity_id FROM {ONE} o ANTI JOIN matching_results m USING (source1_entity_id)",
    "check_extra": f"SELECT DISTINCT source1_entity_id FROM matching_results m ANTI JOIN {ONE} o USING (source1_entity_id)",
    "check_unknown_ids": f"SELECT source1_entity_id, candidate_entity_id AS entity_id FROM ({exploded('matching_results')}) x WHERE NOT EXISTS (SELECT 1 FROM ({raw(2, 3)}) k WHERE k.entity_id = x.candidate_entity_id)",
    "check_subset": f"WITH {BOTH}, {TRUE}, bp AS ({block(800)}) SELECT DISTINCT source1_entity_id FROM links ANTI JOIN bp USING (source1_entity_id, candidate_entity_id)",
    "check_duplicates": "SELECT source1_entity_id, count(*) AS n FROM matching_results GROUP BY 1 HAVING count(*) > 1",
    "check_intra_dupes": f"SELECT source1_entity_id, matched_entity_ids FROM matching_results WHERE len({PARTS}) > len(list_distinct({PARTS}))",
    "check_prefix": f"""SELECT * FROM (SELECT source1_entity_id, len(list_filter({PARTS}, lambda x: starts_with(x, 'S1-'))) AS s1_ids,
 len(list_filter({PARTS}, lambda x: NOT (starts_with(x, 'S1-') OR starts_with(x, 'S2-') OR starts_with(x, 'S3-')))) AS other_ids FROM matching_results) WHERE s1_ids > 0 OR other_ids > 0""",
    "check_examples": f"""WITH m AS (SELECT o.source1_entity_id AS id FROM {ONE} o ANTI JOIN matching_results r USING (source1_entity_id))
SELECT count(*) AS n_ids, (SELECT string_agg(id, ', ' ORDER BY id) FROM (SELECT id FROM m ORDER BY id LIMIT 5)) AS examples FROM m""",
}
