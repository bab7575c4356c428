"""SQL counterparts of the registered queries, for DuckDB."""

from __future__ import annotations

from hydrosignal.llm import licences, shard_tree
from hydrosignal.llm.catalog import SHARDS, URL_RULES

_LINKS_TO_COMPONENTS = """
reach(id, other) AS (
  SELECT a, b FROM links UNION SELECT b, a FROM links
  UNION
  SELECT r.id, l.other FROM reach r JOIN (SELECT a AS id, b AS other FROM links UNION ALL SELECT b, a FROM links) l ON r.other = l.id
),
least AS (SELECT id, min(other) AS other FROM reach GROUP BY id)
"""

OP1 = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
),
good AS (
  SELECT *, sqrt(list_dot_product(e, e)) AS norm FROM v
  WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM good x JOIN good y ON x.label = y.label AND x.vec_id < y.vec_id
  WHERE list_dot_product(x.e, y.e) / (x.norm * y.norm) >= 0.93
),
{_LINKS_TO_COMPONENTS},
counts AS (SELECT id, count(*) AS n FROM (SELECT a AS id FROM links UNION ALL SELECT b FROM links) GROUP BY id)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(other, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(other, vec_id)) AS kept
FROM embeddings LEFT JOIN least ON least.id = vec_id LEFT JOIN counts ON counts.id = vec_id
"""


def _draw(node: str, weight: float) -> str:
    digits = shard_tree.HASH_HEX
    u = f"(('0x' || substr(md5(k || '|{node}'), 1, {digits}))::BIGINT::DOUBLE + 1.0) / {float(16**digits + 1)!r}"
    return f"-ln({u}) / {float(weight)!r}"


def _pick(children: list[tuple[str, float]], level: str) -> str:
    if len(children) == 1:
        return f"'{children[0][0]}'"
    drawn = ", ".join(f"{{'d': {_draw(f'{level}:{n}', w)}, 'n': '{n}'}}" for n, w in children)
    return f"list_min([{drawn}]).n"


def _placed(source: str, prefix: str, leaves: list[shard_tree.Leaf]) -> str:
    weights = shard_tree._weights
    regions = dict.fromkeys(x.region for x in leaves)
    racks = dict.fromkeys(x.rack for x in leaves)
    region = _pick(weights(leaves, lambda x: x.region), "region")
    rack = " ".join(
        f"WHEN '{r}' THEN {_pick(weights([x for x in leaves if x.region == r], lambda x: x.rack), 'rack')}" for r in regions
    )
    shard = " ".join(
        f"WHEN '{r}' THEN {_pick(weights([x for x in leaves if x.rack == r], lambda x: str(x.shard)), 'shard')}" for r in racks
    )
    return (
        f"SELECT *, (CASE {prefix}rack {shard} END)::INTEGER AS {prefix}shard FROM ("
        f"SELECT *, CASE {prefix}region {rack} END AS {prefix}rack FROM ("
        f"SELECT *, {region} AS {prefix}region FROM {source}))"
    )


OP2 = f"""
WITH codes AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT range::BIGINT AS i FROM range(256)))
),
base AS (
  SELECT doc_id, coalesce(doc_id::VARCHAR, 'null') AS k, coalesce(strlen(text), 0)::BIGINT + 1 AS size,
    xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM documents, codes
),
now AS ({_placed("base", "", shard_tree.tree(SHARDS))}),
grown AS ({_placed("now", "grown_", shard_tree.tree(SHARDS + 1))})
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY substr(md5(k), 1, {shard_tree.SLICE_HEX}), doc_id) - 1 AS slot,
  grown_shard, region, rack
FROM grown
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _op4() -> str:
    known = ", ".join(f"{_quoted(k)}: {v}" for k, v in licences._known().items())
    cut = licences.SENTENCE_END

    def ids(text: str) -> str:
        marked = f"string_split(regexp_replace({text}, '{cut}', '\\1' || chr(10), 'g'), chr(10))"
        clean = f"trim(regexp_replace(s, '{licences.NOT_WORD}', ' ', 'g'))"
        return f"list_filter(list_transform({marked}, lambda s: known[{clean}]), lambda x: x IS NOT NULL)"

    def row(of: str) -> str:
        return f"',' || array_to_string(list_transform({of}, lambda x: x::VARCHAR || ','), ',')"

    steps, source, names = [], "found", []
    for i, (name, sequence) in enumerate(licences.RULES):
        pattern = "," + ",,".join(map(str, sequence)) + ","
        longer = len(sequence) > 1 or any(len(s) > 1 and sequence[0] in s for _, s in licences.RULES[i:])
        left = f"replace(rest, '{pattern}', ',0,')" if longer else "rest"
        steps.append(
            f"s{i} AS (SELECT * EXCLUDE (rest), CASE WHEN contains(rest, '{pattern}') THEN '{name}' END AS m{i}, {left} AS rest FROM {source})"
        )
        source = f"s{i}"
        names.append(f"m{i}")
    first_of = "list_filter([" + ", ".join(names) + "], lambda x: x IS NOT NULL)"
    unique = f"list_filter({first_of}, lambda x, i: list_position({first_of}, x) = i)"
    wrapped = "regexp_replace(regexp_replace(low, '\\n[ \\t\\r\\f]*\\n', '. ' || chr(10), 'g'), '[\\n\\r]', ' ', 'g')"
    return f"""
WITH known AS (SELECT MAP {{{known}}} AS known),
low AS (SELECT doc_id, CASE WHEN regexp_matches(lower(text), '{licences.KEYWORDS}') THEN lower(text) ELSE '' END AS low FROM documents),
cuts AS (SELECT doc_id, {ids(wrapped)} AS a, {ids("low")} AS b FROM low, known),
found AS (SELECT doc_id, a, b, {row("a")} || '|' || {row("b")} AS rest FROM cuts),
{", ".join(steps)}
SELECT doc_id, coalesce(array_to_string(list_sort(list_distinct(list_concat(a, b))), ' '), '') AS sentence_ids,
  coalesce(array_to_string({unique}, ' '), '') AS licences, ({unique})[1] AS licence
FROM {source}
"""


_RULES = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)
OP7 = f"""
WITH parts AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
),
rules AS (SELECT * FROM (VALUES {_RULES}) AS r(verdict, rhost, rpath)),
hosts AS (
  SELECT h.host, h.path, arg_max(r.rhost || r.rpath, length(r.rhost) * 100000 + length(r.rpath)) AS rule,
    arg_max(r.verdict, length(r.rhost) * 100000 + length(r.rpath)) AS verdict
  FROM (SELECT DISTINCT host, path FROM parts) h
  JOIN rules r ON (h.host = r.rhost OR ends_with(h.host, '.' || r.rhost)) AND starts_with(h.path, r.rpath)
  GROUP BY h.host, h.path
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN hosts USING (host, path)
"""

OP9 = """
WITH bytes AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
digests AS (SELECT page_id, strlen(body)::BIGINT AS payload_bytes, sha1(body) AS d FROM bytes),
coded AS (
  SELECT *, array_to_string(list_transform(range(0, 8), lambda g: array_to_string(list_transform([15, 10, 5, 0],
    lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(d, 5 * g::INTEGER + 1, 5))::BIGINT >> s) & 31) + 1)::INTEGER, 1)), '')), '') AS payload_digest
  FROM digests
),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS first FROM coded)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to, TRUE AS digest_ok
FROM firsts
"""

OP10 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
),
s AS (
  SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
  FROM w
),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
links AS (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, x.n AS na, y.n AS nb, count(*) AS k FROM e x JOIN e y ON x.x = y.x AND x.doc_id < y.doc_id
    GROUP BY ALL)
  WHERE 100 * k >= 75 * (na + nb - k)
),
{_LINKS_TO_COMPONENTS}
SELECT doc_id, len(s)::BIGINT AS n_shingles, least(doc_id, coalesce(other, doc_id)) AS component_id
FROM s LEFT JOIN least ON least.id = doc_id
"""

OP11 = """
WITH codes AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT range::BIGINT AS i FROM range(256)))
),
own AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos,
    coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
),
ids AS (
  SELECT c, n, c - c % 5 AS base, xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(c::VARCHAR)), '..'), lambda x: ('0x' || x)::BIGINT)),
      lambda r, b: xor(r >> 8, t[(xor(r, b) & 255) + 1])), 4294967295) % 9 AS h
  FROM (SELECT c, count(*) AS n FROM own GROUP BY c), codes
),
steps AS (
  SELECT i.c, o.pos AS d, role, text FROM ids i JOIN own o ON o.c = i.base AND o.pos < i.h
  UNION ALL
  SELECT i.c, least(i.h, coalesce(b.n, 0)) + o.pos - i.h, role, text
  FROM ids i JOIN own o ON o.c = i.c AND o.pos >= i.h LEFT JOIN ids b ON b.c = i.base
),
seqs AS (
  SELECT c, list(md5(md5(role) || md5(text)) ORDER BY d) AS s, list(strlen(text)::BIGINT ORDER BY d) AS b FROM steps GROUP BY c
),
members AS (
  SELECT c, d, array_to_string(s[1:d], ',') AS k, CASE WHEN d > 0 THEN b[d] ELSE 0 END AS bytes, len(s) = d AS ends
  FROM (SELECT *, unnest(generate_series(0, len(s))) AS d FROM (SELECT ids.c, coalesce(s, []) AS s, coalesce(b, []) AS b FROM ids LEFT JOIN seqs USING (c)))
),
nodes AS (
  SELECT d, k, min(c) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes, count(*) FILTER (WHERE ends) AS n_ends,
    string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends) AS e, substr(k, 1, greatest(33 * d - 34, 0)) AS above
  FROM members GROUP BY d, k
),
below AS (
  SELECT j AS d, substr(k, 1, greatest(33 * j - 1, 0)) AS k, count(*) FILTER (WHERE n_ends = n_convs) AS n_leaves, sum((n_convs - 1) * bytes) AS saved
  FROM (SELECT *, unnest(generate_series(0, d)) AS j FROM nodes) GROUP BY 1, 2
)
SELECT n.conv_id, n.d::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, count(c.conv_id) AS n_children, any_value(n_leaves) AS n_leaves,
  any_value(b.saved)::BIGINT AS saved_tokens, sha256(coalesce(any_value(n.e), '')) AS ends_sha256
FROM nodes n JOIN below b ON b.d = n.d AND b.k = n.k LEFT JOIN nodes p ON p.d = n.d - 1 AND p.k = n.above
LEFT JOIN nodes c ON c.d = n.d + 1 AND c.above = n.k
GROUP BY n.d, n.k, n.conv_id, n.n_convs, p.conv_id
"""

OP12 = """
WITH good AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.vec_id AS anchor_id, g.vec_id AS id, a.label = g.label AS same, list_dot_product(a.v, g.v)::BIGINT AS score
  FROM good a JOIN good g ON a.vec_id % 100 = 0 AND a.vec_id <> g.vec_id
),
near AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT near.anchor_id, positive_id, (row_number() OVER (PARTITION BY near.anchor_id, positive_id ORDER BY score DESC, id))::INTEGER AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM near JOIN scored s ON s.anchor_id = near.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

SQL = {
    "op1_embedding_links": OP1,
    "op2_shard_documents": OP2,
    "op4_licence_scan": _op4(),
    "op7_url_verdicts": OP7,
    "op9_warc_round_trip": OP9,
    "op10_shingle_components": OP10,
    "op11_prefix_trie": OP11,
    "op12_hard_negatives": OP12,
}
