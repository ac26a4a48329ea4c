"""DuckDB SQL for the rows of the queries that SQL can express."""

from __future__ import annotations

OP1 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), f AS (
  SELECT *, replace(replace(replace(text, '\', '\\'), '### ', '#\## '), '</turn>', '<\/turn>') AS body,
    CASE role WHEN 'system' THEN '### System: ' WHEN 'user' THEN '### User: ' WHEN 'assistant' THEN '### Assistant: '
      ELSE '### Other(' || lower(hex(encode(role))) || '): ' END AS mark,
    lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC NULLS LAST, role DESC, text DESC) AS back
  FROM t
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(mark || body || '</turn>' || chr(10)))::BIGINT AS formatted_chars,
  bool_and(CASE WHEN before IS NULL THEN role IN ('system', 'user') WHEN before = 'system' THEN role = 'user'
    WHEN before = 'user' THEN role = 'assistant' WHEN before = 'assistant' THEN role = 'user' ELSE false END)
    AND bool_and(back > 1 OR role IN ('assistant', 'user')) AS valid
FROM f GROUP BY conv_id
"""

OP2 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e,
    label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS ok
  FROM embeddings
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE a.ok AND b.ok AND list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.98
), r(a, b) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a
)
SELECT v.vec_id, (SELECT count(*) FROM l WHERE l.a = v.vec_id)::BIGINT AS n_links, min(r.b)::BIGINT AS component_id,
  v.vec_id = min(r.b) AS kept
FROM v JOIN r ON r.a = v.vec_id GROUP BY v.vec_id
"""

OP4 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body) AS n, sha256(body) AS digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first, count(*) OVER (PARTITION BY digest) AS copies FROM d)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN n >= 100 AND copies > 1 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND copies > 1 AND page_id <> first THEN first END AS refers_to
FROM f
"""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP7 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 80 * (x.n + y.n - o)),
r(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.b)::BIGINT AS component_id
FROM documents d JOIN r ON r.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id
"""


#: Levels of the tree that the SQL of op6 spells out; what lies deeper is taken as it is.
LEVELS = 6


def _op6() -> str:
    """The templates level by level, as ``url_filter.templates`` makes them."""
    from .url_filter import PRIOR, REJECT, THIN, VARIABLE, WIDE, Z

    form = "CASE " + " ".join(f"WHEN regexp_matches(SEGMENT, '{p}') THEN '{w}'" for p, w in VARIABLE) + " ELSE SEGMENT END"
    levels = [f"l{i}" for i in range(LEVELS)]
    seg = [form.replace("SEGMENT", f"coalesce(p[{i + 1}], '')") for i in range(LEVELS)]
    keys = ", ".join(levels)
    rules = "CASE WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1' WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/' WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/' WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/' WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END"
    parts = [
        "u AS (SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '" + UPPER + "', '" + LOWER + "') AS host, coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages)",
        "g AS (SELECT doc_id AS page_id, max((toxic = 1 OR quality = 0)::INT) AS bad FROM labels GROUP BY 1)",
        f"q AS (SELECT u.*, bad, {rules} AS rule, list_filter(string_split(path, '/'), lambda s: s <> '') AS p FROM u LEFT JOIN g ON g.page_id = u.page_id)",
        "b AS (SELECT page_id, host, path, rule, bad, " + ", ".join(f"{x} AS {name}" for x, name in zip(seg, levels, strict=True)) + " FROM q)",
        f"t0 AS (SELECT host, {keys}, '' AS template, count(*) AS n, count(bad) AS lab, coalesce(sum(bad), 0) AS bad FROM b GROUP BY host, {keys})",
    ]
    for i, name in enumerate(levels):
        p = "(nb::DOUBLE / nl)"
        like = f"(bl = 0 OR nl = 0 OR abs(bb::DOUBLE / bl - {p}) <= {Z} * sqrt({p} * (1 - {p}) / bl))"
        parts += [
            f"r{i} AS (SELECT host, template, {name}, sum(n) AS bn, sum(lab) AS bl, sum(bad) AS bb FROM t{i} GROUP BY 1, 2, 3)",
            f"n{i} AS (SELECT host, template, count(*) AS nk, sum(bn) AS nn, sum(bl) AS nl, sum(bb) AS nb FROM r{i} WHERE {name} <> '' GROUP BY 1, 2)",
            f"m{i} AS (SELECT r.host, r.template, r.{name}, r.template || CASE WHEN r.{name} = '' THEN '' WHEN nk > 1 AND ((nk >= {WIDE} AND nn <= {THIN} * nk) OR {like}) THEN '/*' ELSE '/' || r.{name} END AS next FROM r{i} r LEFT JOIN n{i} n ON n.host = r.host AND n.template = r.template)",
            f"t{i + 1} AS (SELECT t.host, {', '.join('t.' + k for k in levels)}, m.next AS template, t.n, t.lab, t.bad FROM t{i} t JOIN m{i} m ON m.host = t.host AND m.template = t.template AND m.{name} = t.{name})",
        ]
    parts += [
        f"e AS (SELECT host, template, (sum(bad) + {PRIOR} * coalesce((SELECT sum(bad)::DOUBLE / nullif(sum(lab), 0) FROM t0), 0)) / (sum(lab) + {PRIOR}) AS share FROM t{LEVELS} GROUP BY 1, 2)",
        f"v AS (SELECT t.host, {', '.join('t.' + k for k in levels)}, CASE WHEN share >= {REJECT} THEN 'block' ELSE 'allow' END AS method FROM t{LEVELS} t JOIN e ON e.host = t.host AND e.template = t.template)",
    ]
    said = "CASE rule WHEN 'org/' THEN 'allow' WHEN 'com/fr/' THEN 'allow' WHEN 'example.org/es/' THEN 'block' WHEN 'example.org/en/1' THEN 'block' WHEN 'com/de/' THEN 'block' ELSE method END"
    on = " AND ".join(f"v.{k} = b.{k}" for k in ["host", *levels])
    return "WITH " + ", ".join(parts) + f" SELECT page_id, b.host, path, rule, {said} AS verdict FROM b JOIN v ON {on}"


def _op3() -> str:
    """The tree as tables of nodes; CRC-32 by its table of 256 remainders."""
    from .sharding import balanced_tree, grow

    def nodes(tree: list) -> tuple[str, str, str]:
        regions, racks = {}, {}
        for s in tree:
            regions[s.region] = regions.get(s.region, 0) + s.weight
            racks[s.region, s.rack] = racks.get((s.region, s.rack), 0) + s.weight
        return (
            ", ".join(f"('', '{r}', {w})" for r, w in regions.items()),
            ", ".join(f"('{r}', '{k}', {w})" for (r, k), w in racks.items()),
            ", ".join(f"('{s.rack}', 's{s.shard}', {s.weight})" for s in tree),
        )

    draw = "-ln((('0x' || substr(md5(key || ':' || c.name), 1, 13))::BIGINT + 0.5) / 4503599627370496.0) / c.w"
    pick = lambda table, parent: f"(SELECT arg_min(c.name, {draw}) FROM {table} c WHERE c.parent = {parent})"
    parts = [
        "k AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)",
        "h AS (SELECT doc_id, text, string_split_regex(regexp_replace(hex(encode(text)), '(..)', '\\1 ', 'g'), ' ') AS b FROM documents)",
        "y AS (SELECT doc_id, text, list_transform(list_filter(b, lambda x: x <> ''), lambda x: ('0x' || x)::BIGINT) AS b FROM h)",
        "d AS (SELECT doc_id, coalesce(doc_id::VARCHAR, '') AS key, (coalesce(octet_length(encode(text)), 0) + 16)::BIGINT AS size, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, t[xor(c, x) % 256 + 1])), 4294967295)::BIGINT AS text_crc32 FROM y, k)",
    ]
    tree, last = balanced_tree(40), "d"
    for name, t in (("a", tree), ("b", grow(tree))):
        for level, rows in zip(("region", "rack", "leaf"), nodes(t), strict=True):
            parts.append(f"{name}{level}(parent, name, w) AS (VALUES {rows})")
        parts.append(f"{name}1 AS (SELECT *, {pick(name + 'region', repr(''))} AS {name}r FROM {last})")
        parts.append(f"{name}2 AS (SELECT *, {pick(name + 'rack', name + 'r')} AS {name}k FROM {name}1)")
        parts.append(f"{name}3 AS (SELECT *, {pick(name + 'leaf', name + 'k')} AS {name}s FROM {name}2)")
        last = f"{name}3"
    parts.append("z AS (SELECT doc_id, size, text_crc32, substr(a_s, 2)::INT AS shard, substr(b_s, 2)::INT AS grown_shard, ('0x' || substr(md5(concat_ws(':', doc_id, text_crc32, size)), 1, 2))::INT % 64 AS cell FROM (SELECT *, \"as\" AS a_s, bs AS b_s FROM b3))")
    slot = "row_number() OVER (PARTITION BY shard ORDER BY cell, doc_id NULLS FIRST, text_crc32 NULLS FIRST, size) - 1"
    return "WITH " + ", ".join(parts) + f" SELECT doc_id, size, text_crc32, 'key' AS law, shard, {slot} AS slot, grown_shard FROM z"


ORACLE_SQL = {"op1_chat_formatting": OP1, "op2_embedding_dedup": OP2, "op3_sharding": _op3(), "op4_warc": OP4, "op6_url_filter": _op6(), "op7_jaccard_join": OP7}
