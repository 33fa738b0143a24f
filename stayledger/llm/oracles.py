"""SQL for the queries that SQL can express, for DuckDB."""

from __future__ import annotations

from . import chat, decontaminate, fim, licenses, urls
from .queries import URL_RULES

SQL: dict[str, str] = {}

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{urls.UPPER}', '{urls.LOWER}'), '{WORD}')"


def texts(values) -> str:
    return ", ".join("('" + "', '".join(v.replace("'", "''") for v in row) + "')" for row in values)


SQL["op1_preferences"] = f"""
WITH t AS (
  SELECT conv_id, turn, min({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}) AS said
  FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY conv_id, turn
), l AS (
  SELECT conv_id, max(turn) AS last FROM t WHERE said.role = '{chat.ASSISTANT}' GROUP BY conv_id
), reply AS (
  SELECT conv_id, said.text AS text FROM t JOIN l USING (conv_id) WHERE turn = last
), c AS (
  SELECT conv_id AS p, turn, said FROM t JOIN l USING (conv_id) WHERE turn <= last
), r AS (
  SELECT conv_id AS p, turn, said FROM t JOIN l USING (conv_id) WHERE turn < last
  UNION ALL
  SELECT l.conv_id, last, {{'role': '{chat.ASSISTANT}', 'text': coalesce(reply.text, '')}}
  FROM l LEFT JOIN reply ON reply.conv_id = xor(l.conv_id, 1::BIGINT)
), pairs AS (
  SELECT coalesce(c.p, r.p) AS p, coalesce(c.turn, r.turn) AS turn, c.said AS cs, r.said AS rs,
         c.p IS NOT NULL AND r.p IS NOT NULL AND c.said.role = r.said.role AND c.said.text = r.said.text AS same
  FROM c FULL JOIN r ON c.p = r.p AND c.turn = r.turn
), fork AS (
  SELECT p, min(turn) FILTER (NOT same) AS forked FROM pairs GROUP BY p
), parts AS (
  SELECT p, turn, 'prompt' AS part, cs AS said FROM pairs JOIN fork USING (p) WHERE forked IS NULL OR turn < forked
  UNION ALL
  SELECT p, turn, 'chosen', cs FROM pairs JOIN fork USING (p) WHERE turn >= forked AND cs IS NOT NULL
  UNION ALL
  SELECT p, turn, 'rejected', rs FROM pairs JOIN fork USING (p) WHERE turn >= forked AND rs IS NOT NULL
), shown AS (
  SELECT p, part, turn, said.role AS role, '<|' || said.role || '|>' || chr(10) || said.text || '<|end|>' || chr(10) AS segment FROM parts
), placed AS (
  SELECT *, CAST(sum(length(segment)) OVER (PARTITION BY p, part ORDER BY turn) AS BIGINT) AS e FROM shown
)
SELECT p AS pair_id, part, turn, role, segment, e - length(segment) AS start, e AS "end",
       CASE WHEN part <> 'prompt' AND role = '{chat.ASSISTANT}' THEN e - length(segment) + length(role) + 5 END AS learn_from,
       CASE WHEN part <> 'prompt' AND role = '{chat.ASSISTANT}' THEN e END AS learn_to
FROM placed
"""

_PHRASES = [(label, phrase.split()) for phrase, label in licenses.PHRASES.items()]
_STARTS = " UNION ALL ".join(
    f"SELECT r, '{label}' AS label, i FROM d, unnest(range(1, len(w) + 1)) AS t(i) WHERE "
    + " AND ".join(f"w[i + {k}] = '{word}'" for k, word in enumerate(parts))
    for label, parts in _PHRASES
)
SQL["op4_licenses"] = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {words("text")} AS w FROM documents
), hits AS (
  {_STARTS}
), base AS (
  SELECT r, count(*) AS n, min(i) - 1 AS lo, max(i) - 1 AS hi, list_sort(list_distinct(list(label))) AS labels FROM hits GROUP BY r
), t AS (
  SELECT DISTINCT name, array_to_string(w[j : j + 2], ' ') AS run
  FROM (SELECT name, {words("body")} AS w FROM (VALUES {texts(sorted(licenses.TEMPLATES.items()))}) AS v(name, body)), unnest(range(1, len(w) - 1)) AS y(j)
), sizes AS (
  SELECT name, count(*) AS n, ceil({licenses.CONTAINMENT} * count(*) - 1e-9) AS need FROM t GROUP BY name
), blocks AS (
  SELECT r, i, array_to_string(w[j : j + 2], ' ') AS run
  FROM d, unnest(range(1, greatest(len(w) - {licenses.BLOCK_WORDS - licenses.BLOCK_STEP}, 1) + 1, {licenses.BLOCK_STEP})) AS x(i),
       unnest(range(i, least(i + {licenses.BLOCK_WORDS - 2}, len(w) - 1))) AS y(j)
), shared AS (
  SELECT r, i, name, count(*) AS n FROM (SELECT DISTINCT r, i, run FROM blocks) JOIN t USING (run) GROUP BY r, i, name
), found AS (
  SELECT r, list_distinct(list(name)) AS names, max(shared.n / sizes.n) AS share
  FROM shared JOIN sizes USING (name) WHERE shared.n >= need GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(base.n, 0) AS BIGINT) AS n_base,
       CAST(lo AS BIGINT) AS first_word, CAST(hi AS BIGINT) AS last_word,
       coalesce(array_to_string(base.labels, ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(names, [])))), ','), '') AS labels,
       CASE WHEN base.n > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score
FROM d LEFT JOIN base USING (r) LEFT JOIN found USING (r)
"""

_LENGTH = f"least({decontaminate.WINDOW}, len(w))"
SQL["op7_decontamination"] = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {words("text")} AS w FROM documents
), b AS (
  SELECT item_id, {words("text")} AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, {_LENGTH} AS l, array_to_string(w[i : i + {_LENGTH} - 1], ' ') AS p
  FROM b, unnest(range(1, len(w) - {_LENGTH} + 2)) AS x(i) WHERE len(w) > 0
), lengths AS (
  SELECT DISTINCT l FROM windows
), places AS (
  SELECT r, i, l, array_to_string(w[i : i + l - 1], ' ') AS p FROM d, lengths, unnest(range(1, len(w) - l + 2)) AS x(i) WHERE len(w) >= l
), hits AS (
  SELECT r, i, l, item_id FROM places JOIN windows USING (l, p)
), hit AS (
  SELECT r, count(DISTINCT place) AS n FROM hits, unnest(range(i, i + l)) AS x(place) GROUP BY r
), items AS (
  SELECT r, count(DISTINCT item_id) AS n, array_to_string(list_sort(list_distinct(list(item_id::VARCHAR))), ',') AS ids FROM hits GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""

SQL["op8_topk"] = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

_RULES = texts([(r.verdict, r.host, r.path) for r in URL_RULES])


def _decoded(text: str) -> str:
    """Without escapes of letters, digits and ``-._~``; A-Z lower-cased."""
    code = "chr(CAST('0x' || substr(t, 2) AS INTEGER))"
    one = f"CASE WHEN len(t) = 3 AND t[1] = '%' AND regexp_full_match({code}, '[A-Za-z0-9._~-]') THEN {code} ELSE t END"
    parts = f"regexp_extract_all({text}, '%[2-7][0-9A-Fa-f]|%|[^%]')"
    return f"translate(array_to_string(list_transform({parts}, lambda t: {one}), ''), '{urls.UPPER}', '{urls.LOWER}')"


SQL["op10_urls"] = f"""
WITH u AS (
  SELECT row_number() OVER () AS r, page_id,
         CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT r, page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{urls.UPPER}', '{urls.LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path FROM u
), rules AS (
  SELECT verdict, rhost, rpath, rhost || rpath AS rule FROM (VALUES {_RULES}) AS v(verdict, rhost, rpath)
), fits AS (
  SELECT r, rule, verdict, row_number() OVER (PARTITION BY r ORDER BY length(rule) DESC, rule) AS place
  FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
), decoded AS (
  SELECT *, {_decoded("host")} AS h, {_decoded("path")} AS p FROM parts
), plain AS (
  SELECT r, page_id, host, path, p, regexp_replace(regexp_replace(regexp_replace(h, '^[\\s\\S]*@', ''), ':[0-9]*$', ''), '[.]+$', '') AS h FROM decoded
), globs AS (
  SELECT *, CASE
    WHEN contains(h, 'spam') THEN CASE WHEN p = '' THEN '*spam*' ELSE '*spam*/**' END
    WHEN contains(h, 'cheap-pills') THEN CASE WHEN p = '' THEN '*cheap-pills*' ELSE '*cheap-pills*/**' END
    WHEN contains(h, 'casino') THEN CASE WHEN p = '' THEN '*casino*' ELSE '*casino*/**' END
    WHEN ends_with(p, '.exe') THEN '*/**.exe'
    WHEN ends_with(p, '.zip') THEN '*/**.zip' END AS matched
  FROM plain
)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN matched IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
       coalesce(rule, matched) AS evidence
FROM globs LEFT JOIN (SELECT * FROM fits WHERE place = 1) USING (r)
"""

_TERMS = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
_FLOOR = "CAST(((p - q) * (p - q)) // (p + q) AS BIGINT)"


def _share(count: str, total: str, size: str) -> str:
    return f"1 + (1000000000::HUGEINT * ({count} + 2)) // ({total} + 2 * {size})"


SQL["op11_divergence"] = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), '{urls.UPPER}', '{urls.LOWER}'), '{_TERMS}') AS w FROM documents
), t AS (
  SELECT r, lang, source, unnest(w) AS term FROM d
), kept AS (
  SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 10
), sizes AS (
  SELECT lang, count(*)::HUGEINT AS v, sum(n) AS total FROM kept GROUP BY lang
), held AS (
  SELECT lang, source, term, count(*)::HUGEINT AS n FROM t JOIN kept USING (lang, term) GROUP BY lang, source, term
), grp AS (
  SELECT lang, source, coalesce(sum(held.n), 0) AS total FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN held USING (lang, source) GROUP BY lang, source
), dense AS (
  SELECT g.lang, g.source, k.term, coalesce(h.n, 0) AS n, {_share("coalesce(h.n, 0)", "g.total", "s.v")} AS p,
         {_share("k.n", "s.total", "s.v")} AS q
  FROM grp AS g JOIN kept AS k USING (lang) JOIN sizes AS s USING (lang) LEFT JOIN held AS h ON h.lang = g.lang AND h.source = g.source AND h.term = k.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum({_FLOOR.replace("q", "b.p").replace("(p", "(a.p")}) AS value
  FROM dense AS a JOIN dense AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
), parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM grp AS a JOIN grp AS b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, {_FLOOR} FROM dense WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM parts
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""

_HEAD = "array_to_string(w[1 : {}], '')"
_DRAW = "CAST('0x' || substr(h, {}, 8) AS BIGINT)"
SQL["op13_fim"] = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS w
  FROM documents
), e AS (
  SELECT *, len(w) AS n, {_DRAW.format(1)} % (len(w) + 1) AS a, {_DRAW.format(9)} % (len(w) + 1) AS b,
         {_DRAW.format(17)} % 100 AS c, {_DRAW.format(25)} % 100 AS k FROM d
), f AS (
  SELECT *, length({_HEAD.format("least(a, b)")}) AS x, length({_HEAD.format("greatest(a, b)")}) AS y,
         CASE WHEN t = '' OR contains(t, '{fim.PREFIX}') OR contains(t, '{fim.SUFFIX}') OR contains(t, '{fim.MIDDLE}') OR c >= 50 THEN 'plain'
              WHEN k < 80 THEN 'spm' ELSE 'psm' END AS form FROM e
), g AS (
  SELECT *, substr(t, 1, x) AS pre, substr(t, x + 1, y - x) AS mid, substr(t, y + 1) AS suf FROM f
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(x AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(y - x AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '{fim.PREFIX}' || pre || '{fim.SUFFIX}' || suf || '{fim.MIDDLE}' || mid
                   ELSE '{fim.SUFFIX}' || suf || '{fim.PREFIX}' || pre || '{fim.MIDDLE}' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM g
"""
