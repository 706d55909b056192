"""DuckDB SQL that needs recursion: of the Merkle manifest, the conversation repair and the joined embeddings."""

from __future__ import annotations

#: CRC-32 of an ASCII text, bit by bit; 3988292384 is the reversed polynomial.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length({0}) + 1), lambda i: ascii(substr({0}, i, 1))::BIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), [1::BIGINT, 2, 3, 4, 5, 6, 7, 8]), lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""


def crc32(text: str) -> str:
    return _CRC.format(f"({text})")


_FIELD = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "{n_chars}", "text")) + ")"

MERKLE = f"""WITH RECURSIVE d AS (SELECT doc_id, lang, coalesce({crc32("doc_id::VARCHAR")} % 7 = 0, false) AS bad, {_LEAF.format(n_chars="n_chars")} AS leaf, {_LEAF.format(n_chars="(n_chars + 1)")} AS other FROM documents),
l AS (SELECT doc_id, lang, leaf, CASE WHEN bad THEN other ELSE leaf END AS now, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM d),
t(lang, up, i, n, h) AS (SELECT lang, 0, i, n, leaf FROM l UNION ALL
  SELECT lang, max(up) + 1, i // 2, max((n + 1) // 2), sha256(string_agg(h, '' ORDER BY i)) FROM t WHERE n > 1 GROUP BY lang, i // 2),
s AS (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM t WHERE n = 1),
g(up, i, n, h) AS (SELECT 0, i, n, h FROM s UNION ALL SELECT max(up) + 1, i // 2, max((n + 1) // 2), sha256(string_agg(h, '' ORDER BY i)) FROM g WHERE n > 1 GROUP BY i // 2),
p(doc_id, leaf, lang, up, i, n, now, sib) AS (SELECT doc_id, leaf, lang, 0, i, n, now, '' FROM l UNION ALL
  SELECT p.doc_id, p.leaf, p.lang, p.up + 1, p.i // 2, (p.n + 1) // 2, sha256(CASE WHEN p.i % 2 = 0 THEN p.now || coalesce(t.h, '') ELSE t.h || p.now END), p.sib || coalesce(t.h, '')
  FROM p LEFT JOIN t ON p.lang IS NOT DISTINCT FROM t.lang AND p.up = t.up AND t.i = xor(p.i, 1) WHERE p.n > 1),
q(doc_id, leaf, subroot, up, i, n, now, sib) AS (SELECT doc_id, leaf, s.h, 0, s.i, s.n, now, sib FROM p JOIN s ON p.lang IS NOT DISTINCT FROM s.lang WHERE p.n = 1 UNION ALL
  SELECT q.doc_id, q.leaf, q.subroot, q.up + 1, q.i // 2, (q.n + 1) // 2, sha256(CASE WHEN q.i % 2 = 0 THEN q.now || coalesce(g.h, '') ELSE g.h || q.now END), q.sib || coalesce(g.h, '')
  FROM q LEFT JOIN g ON q.up = g.up AND g.i = xor(q.i, 1) WHERE q.n > 1)
SELECT doc_id, leaf, subroot, (SELECT h FROM g WHERE n = 1) AS root, sha256(sib) AS proof_sha256, now AS folded_root, now = (SELECT h FROM g WHERE n = 1) AS verified FROM q WHERE n = 1"""

EMBEDDINGS = """WITH RECURSIVE v AS (SELECT row_number() OVER () AS rid, vec_id, embedding::DOUBLE[] AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.rid AS a, b.rid AS b FROM ok a JOIN ok b ON a.rid <> b.rid AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
r(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, links.b FROM r JOIN links ON r.b = links.a),
c AS (SELECT a, min(vec_id) AS least FROM r JOIN v ON v.rid = r.b GROUP BY a),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, coalesce(least(least, vec_id), vec_id) AS component_id, coalesce(least(least, vec_id), vec_id) IS NOT DISTINCT FROM vec_id AS kept
FROM v LEFT JOIN n ON n.a = v.rid LEFT JOIN c ON c.a = v.rid"""

_NAME = "coalesce({0}::VARCHAR, ' ')"
#: Forward: the least cost and then the least audit of each state after each row; inserts before a row, then the row's own edit.
CONVERSATIONS = f"""WITH RECURSIVE h AS (SELECT conv_id, turn, {_NAME.format("role")} AS role, {_NAME.format("text")} AS text, {crc32(_NAME.format("conv_id") + " || ':' || " + _NAME.format("turn"))} % 20 AS k FROM conversations),
r AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role, CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text FROM h, range(1, 3) c(copy) WHERE k <> 0 AND (copy = 1 OR k = 3)),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM r),
b AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS seen, regexp_replace(text, '[\\x20\\x09-\\x0D]+$', '') AS rest FROM p),
f AS (SELECT *, CASE WHEN rest = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN right(rest, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault, lead(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS then_ FROM b),
n AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
  count(*) FILTER (then_ IS NOT NULL AND left(role, 1) || then_ NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM f GROUP BY conv_id),
ins(s, t, c, x, o) AS (VALUES (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''), (0, 2, 3, 'I', chr(10) || 'user:'), (0, 3, 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), (1, 2, 3, 'I', chr(10) || 'user:'),
  (1, 3, 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), (2, 3, 3, 'I', chr(10) || 'assistant:'), (3, 2, 3, 'I', chr(10) || 'user:')),
e(s, x, need, c, t, role) AS (VALUES (0, 'K', 's', 0, 1, NULL), (0, 'K', 'u', 0, 2, NULL), (1, 'K', 'u', 0, 2, NULL), (2, 'K', 'a', 0, 3, NULL), (3, 'K', 'u', 0, 2, NULL), (0, 'R', NULL, 3, 2, 'user'), (1, 'R', NULL, 3, 2, 'user'),
  (2, 'R', NULL, 3, 3, 'assistant'), (3, 'R', NULL, 3, 2, 'user'), (0, 'D', NULL, 4, 0, NULL), (1, 'D', NULL, 4, 1, NULL), (2, 'D', NULL, 4, 2, NULL), (3, 'D', NULL, 4, 3, NULL)),
dp(conv_id, i, s, c, x, o) AS (SELECT DISTINCT conv_id, 0::BIGINT, 0, 0::BIGINT, '', '' FROM n UNION ALL
  SELECT dp.conv_id, dp.i + 1, e.t, dp.c + ins.c + e.c + CASE WHEN e.x <> 'D' AND fault = 'truncated' THEN 3 ELSE 0 END AS cost, dp.x || ins.x || e.x AS audit,
    dp.o || ins.o || CASE WHEN e.x = 'D' THEN '' ELSE chr(10) || coalesce(e.role, f.role) || ':' || f.text END
  FROM dp JOIN f ON dp.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = dp.i + 1 JOIN ins ON ins.s = dp.s JOIN e ON e.s = ins.t AND (e.need IS NULL OR e.need = left(f.role, 1)) AND (e.x = 'D' OR fault NOT IN ('blank', 'duplicate'))
  QUALIFY row_number() OVER (PARTITION BY dp.conv_id, e.t ORDER BY cost, audit) = 1),
z AS (SELECT dp.conv_id, dp.c + ins.c AS cost, dp.x || ins.x AS audit, dp.o || ins.o AS o FROM dp JOIN n ON dp.conv_id IS NOT DISTINCT FROM n.conv_id AND dp.i = n.n JOIN ins ON ins.s = dp.s AND ins.t IN (0, 3)
  QUALIFY row_number() OVER (PARTITION BY dp.conv_id ORDER BY cost, audit) = 1)
SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0)::BIGINT AS cost,
  coalesce(audit, '') AS audit, sha256(substr(coalesce(o, ''), 2)) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN n ON a.conv_id IS NOT DISTINCT FROM n.conv_id LEFT JOIN z ON a.conv_id IS NOT DISTINCT FROM z.conv_id"""

ORACLES = {"op11_conversation_repair": CONVERSATIONS, "op12_ego_join": EMBEDDINGS, "op13_merkle_manifest": MERKLE}
