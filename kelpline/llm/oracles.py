"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from kelpline.llm import mixing, pii, quality_rules, secrets, url_filter


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _found(pattern: str, text: str = "t") -> str:
    """A list of structs of the matches: start, end, value."""
    gaps, values = f"string_split_regex({text}, {_q(pattern)})", f"regexp_extract_all({text}, {_q(pattern)})"
    length = lambda x: f"coalesce(list_sum(list_transform({x}, lambda s: length(s))), 0)"
    start = f"{length(f'list_slice({gaps}, 1, i)')} + {length(f'list_slice({values}, 1, i - 1)')}"
    return f"list_transform(range(1, len({values}) + 1), lambda i: {{'start': ({start})::BIGINT, 'value': ({values})[i]}})"


_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
_SECRETS = {
    "assign": (_ASSIGN, r"length(regexp_replace(f.value, '^[^:=]*[:=]\x20*[\"'']?', '')) >= 12"),
    "access": (r"AKIA[A-Z0-9]+", "length(f.value) >= 18"),
    "hex": (r"[0-9a-f]{16,}", "length(f.value) >= 16"),
    "pem": (secrets.RULES[3][2], "true"),
    "token": (r"\b" + secrets.RULES[4][2].removeprefix("(?<![A-Za-z0-9_])"), "true"),
}
_IP_PART = "0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_DIGITS = "regexp_replace(f.value, '[^0-9]', '', 'g')"
_LUHN = f"""list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda k: (CASE WHEN k % 2 = 1 THEN ascii(reverse({_DIGITS})[k]) - 48
  WHEN ascii(reverse({_DIGITS})[k]) - 48 > 4 THEN 2 * (ascii(reverse({_DIGITS})[k]) - 48) - 9 ELSE 2 * (ascii(reverse({_DIGITS})[k]) - 48) END))) % 10 = 0"""
_PLAIN = "replace(f.value, ' ', '')"
_MOD97 = f"""list_reduce(list_prepend(0, list_transform(range(1, length({_PLAIN}) + 1), lambda k: ascii((substr({_PLAIN}, 5) || substr({_PLAIN}, 1, 4))[k])::INTEGER)),
  lambda a, c: CASE WHEN c < 58 THEN (a * 10 + c - 48) % 97 ELSE (a * 100 + c - 55) % 97 END) = 1"""
_BEFORE = f"lower(substr(t, greatest(f.start - {pii.BEFORE} + 1, 1)::BIGINT, least(f.start, {pii.BEFORE})::BIGINT))"
_PII = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
    "ip": (r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", f"regexp_full_match(f.value, {_q(_IP_PART + r'(\.' + _IP_PART + '){3}')})"),
    "card": (r"[0-9](?:[\x20-]?[0-9])+", f"length({_DIGITS}) BETWEEN 16 AND 19 AND {_LUHN}"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 8 AND 15"),
    "iban": (pii.PATTERNS["iban"], f"{_MOD97} AND round({pii.SCORES['iban']} + CASE WHEN regexp_matches({_BEFORE}, {_q(pii.CONTEXT['iban'])}) THEN 0.1 ELSE 0 END - CASE WHEN regexp_matches({_BEFORE}, {_q(pii.AGAINST)}) THEN 0.4 ELSE 0 END, 2) >= {pii.LEAST_SCORE}"),
}


def _spans(patterns: dict, base: tuple, order: str, more: str = "") -> str:
    union = "\nUNION ALL ".join(
        f"SELECT rid, {_q(kind)} AS kind, {i} AS place, f.start AS s, (f.start + length(f.value))::BIGINT AS e FROM (SELECT rid, t, unnest({_found(p)}) AS f FROM d WHERE regexp_matches(t, {_q(p)})) WHERE {ok}"
        for i, (kind, (p, ok)) in enumerate(patterns.items())
    )
    one = "concat_ws(':', kind, s::VARCHAR, e::VARCHAR)"
    counts = ", ".join(f"coalesce(count(kind) FILTER (kind = {_q(k)}), 0)::BIGINT AS n_{k}" for k in base)
    bases = ", ".join(_q(k) for k in base)
    return f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents), found AS ({union})
SELECT any_value(doc_id) AS doc_id, {counts}, sha256(coalesce(string_agg({one}, ',' ORDER BY {order}) FILTER (kind IN ({bases})), '')) AS base_sha256,
  coalesce(string_agg({one}, ',' ORDER BY {order}) FILTER (kind IS NOT NULL), '') AS spans{more} FROM d LEFT JOIN found USING (rid) GROUP BY rid"""


def _hex(what: str, key: str) -> str:
    return f"('0x' || substr(md5(concat_ws(':', '{mixing.SEED}', '{what}', {key})), 1, 13))::BIGINT"


_MIX = f"""WITH sizes AS (SELECT source, sum(length(coalesce(text, '')))::DOUBLE AS chars FROM documents GROUP BY source),
w AS (SELECT source, chars, CASE WHEN chars > 0 THEN pow(chars, {mixing.ALPHA}) ELSE 0 END AS w FROM sizes),
r AS (SELECT source, CASE WHEN chars > 0 THEN w / (SELECT sum(w) FROM w) * (SELECT sum(chars) FROM w) / chars ELSE 1.0 END AS rate FROM w),
k AS (SELECT source, rate, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 40)::BIGINT + 1)) AS k FROM r WHERE rate > 0),
p AS (SELECT source, k, exp(-rate + sum(CASE WHEN k = 0 THEN 0 ELSE ln(rate) - ln(k) END) OVER (PARTITION BY source ORDER BY k)) AS p FROM k),
c AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM p),
steps AS (SELECT source, list(c ORDER BY k) AS steps FROM c GROUP BY source),
n AS (SELECT doc_id, d.source, text, len(list_filter(steps, lambda x: x <= {_hex("count", "coalesce(doc_id::VARCHAR, '')")}::DOUBLE / {16**13}.0))::BIGINT AS n_copies
  FROM documents d JOIN steps s ON d.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, source, text, n_copies, copy, {_hex("place", "concat_ws(':', coalesce(doc_id::VARCHAR, ''), copy::VARCHAR)")} AS place
FROM (SELECT *, unnest(range(1, n_copies + 1)) AS copy FROM n WHERE n_copies > 0)"""


def _urls() -> str:
    rules = [(what, text, *text.partition("/")) for what, text in sorted(url_filter.RULES, key=lambda r: -len(r[1]))]
    fits = lambda own, start: f"(host = {_q(own)} OR ends_with(host, {_q('.' + own)})) AND starts_with(path, {_q(start)})"
    rule = " ".join(f"WHEN {fits(own, slash + start)} THEN {_q(text)}" for _, text, own, slash, start in rules)
    verdict = " ".join(f"WHEN {fits(own, slash + start)} THEN {_q(what)}" for what, _, own, slash, start in rules)
    has = lambda term: f"regexp_matches(u, '(^|[^0-9a-z]){term}([^0-9a-z]|$)')"
    strict = " OR ".join(map(has, url_filter.STRICT))
    soft = " + ".join(f"{has(t)}::INT" for t in url_filter.SOFT)
    az = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    return f"""WITH a AS (SELECT page_id, translate(coalesce(url, ''), {az}) AS u, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, u, translate(regexp_extract(rest, '^[^/?#]*'), {az}) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a)
SELECT page_id, host, path, CASE {rule} END AS rule, CASE {verdict} WHEN {strict} OR {soft} >= {url_filter.LEAST_SOFT} THEN 'block' ELSE 'allow' END AS verdict FROM b"""


_WHITE = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_RULES = f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
m AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
g AS (SELECT *, list_filter(lines, lambda x: regexp_matches(right(trim(x, {_WHITE}), 1), {_q(quality_rules.RULES.ends)}) AND NOT regexp_matches(trim(x, {_WHITE}), {_q(quality_rules.RULES.navigation)})
  AND NOT ({' OR '.join(f"contains(lower(x), {_q(p)})" for p in quality_rules.RULES.boilerplate)})) AS good FROM m),
tri AS (SELECT rid, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1), lambda k: w[k] || ' ' || w[k + 1] || ' ' || w[k + 2])) AS x FROM g WHERE len(w) >= 4),
h AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, x) AS n FROM tri),
cov AS (SELECT rid, least(3, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i) - i, 3)) AS c FROM h WHERE n > 1),
rep AS (SELECT rid, sum(c)::BIGINT AS n_repeat_words FROM cov GROUP BY rid),
c AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
  (length(t) - length(translate(t, {_q(quality_rules.SYMBOLS)}, '')))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
  coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, length(regexp_replace(array_to_string(good, chr(10)), '[\\x20\\x09-\\x0D]+', '', 'g')) AS left_chars
  FROM g LEFT JOIN rep USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * left_chars >= {quality_rules.LEAST_LEFT} * word_chars AS kept FROM c"""

ORACLES = {
    "op5_poisson_mix": _MIX,
    "op6_secret_ledger": _spans(_SECRETS, ("assign", "access", "hex"), "s, place"),
    "op7_url_filter": _urls(),
    "op9_pii": _spans(_PII, pii.BASE, "place, s", ", count(kind) > 0 AS has_pii"),
    "op10_quality_rules": _RULES,
}
