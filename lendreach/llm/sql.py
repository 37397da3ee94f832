"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from lendreach.llm.sharding import Tree

def _draw(key: str, nodes: dict[str, float]) -> str:
    """The name of the node with the least weighted draw."""
    costs = ", ".join(f"{{'cost': -ln((('0x' || substr(md5({key} || '|{n}'), 1, 13))::BIGINT::DOUBLE + 0.5) "
                      f"/ 4503599627370496.0) / {float(w)!r}::DOUBLE, 'i': {i}, 'node': '{n}'}}"
                      for i, (n, w) in enumerate(nodes.items()) if w > 0)
    return f"list_min([{costs}]).node"


def _place(tree: Tree, prefix: str) -> str:
    """Three nested selects over ``keyed``: region, rack, shard."""
    racks = {g: {k: sum(s.values()) for k, s in ks.items()} for g, ks in tree.items()}
    at = lambda column, draws: "CASE " + " ".join(
        f"WHEN {column} = '{n}' THEN {d}" for n, d in draws.items()) + " END"
    region = _draw("k", {g: sum(ks.values()) for g, ks in racks.items()})
    rack = at("region", {g: _draw("k", ks) for g, ks in racks.items()})
    shard = at("rack", {k: _draw("k", {f"{k}/{s}": w for s, w in ss.items()})
                        for ks in tree.values() for k, ss in ks.items()})
    return (f"{prefix} AS (SELECT *, split_part({shard}, '/', -1)::INT AS {prefix}_shard FROM "
            f"(SELECT *, {rack} AS rack FROM (SELECT *, {region} AS region FROM keyed)))")


def sharding(tree: Tree, grown: Tree) -> str:
    """CRC-32 is folded byte by byte over a table that is itself made by rule."""
    return f"""WITH crc AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
    lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
  bytes AS (SELECT doc_id, regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS b FROM documents),
  keyed AS (SELECT d.doc_id, coalesce(d.doc_id::VARCHAR, 'null') AS k, len(b)::BIGINT + 1 AS size,
    xor(list_reduce(list_prepend(4294967295, list_transform(b, lambda x: ('0x' || x)::BIGINT)),
      lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295)::BIGINT AS text_crc32
    FROM bytes d, crc),
  {_place(tree, 'here')},
  {_place(grown, 'next')}
SELECT h.doc_id, h.size, h.text_crc32, 'key' AS law, here_shard AS shard,
  row_number() OVER (PARTITION BY here_shard ORDER BY substr(md5(h.k), 1, 3), h.doc_id) - 1 AS slot,
  next_shard AS grown_shard, h.region, h.rack
FROM here h JOIN next n ON h.doc_id = n.doc_id"""


def top_inner(every: int, k: int, scale: int = 1024) -> str:
    return f"""WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS e
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % {every} = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, rank::INT AS rank, vec_id, score FROM
  (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= {k}"""


def warc() -> str:
    """Base32 of a SHA-1, four letters from every five hexadecimal digits."""
    letters = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((n >> {}) & 31)::INT + 1, 1)"
    four = " || ".join(letters.format(b) for b in (15, 10, 5, 0))
    return f"""WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS raw FROM pages),
  h AS (SELECT page_id, octet_length(raw)::BIGINT AS payload_bytes, sha1(raw) AS hex FROM p),
  d AS (SELECT page_id, payload_bytes, list_aggregate(list_transform(list_transform(range(8),
    lambda i: ('0x' || substr(hex, (i * 5 + 1)::INT, 5))::BIGINT), lambda n: {four}), 'string_agg', '') AS payload_digest FROM h)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = max(page_id) OVER w THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = max(page_id) OVER w THEN NULL ELSE max(page_id) OVER w END AS refers_to
FROM d WINDOW w AS (PARTITION BY payload_digest)"""


def jaccard(words: int, num: int, den: int) -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), '{upper}', '{lower}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS l FROM documents),
  s AS (SELECT doc_id, list_distinct(list_transform(range(1, greatest(len(l) - {words - 1}, least(len(l), 1)) + 1),
    lambda i: array_to_string(l[i:i + {words - 1}], ' '))) AS s FROM w),
  e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
  c AS (SELECT a.doc_id AS x, b.doc_id AS y, a.n + b.n AS total, count(*) AS shared
    FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
  links AS (SELECT x, y FROM c WHERE {den} * shared >= {num} * (total - shared)),
  near AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
  reach AS (SELECT doc_id, doc_id AS r FROM documents UNION
    SELECT reach.doc_id, near.y FROM reach JOIN near ON reach.r = near.x)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(r) AS component_id
FROM s JOIN reach USING (doc_id) GROUP BY s.doc_id, s.s"""


def negatives(every: int, positives: int, most: int, scale: int = 256) -> str:
    return f"""WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS e FROM embeddings WHERE label IS NOT NULL
    AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.e, c.e)::BIGINT AS score
    FROM v a JOIN v c ON a.vec_id % {every} = 0 AND a.vec_id <> c.vec_id),
  p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {positives})
SELECT anchor_id, positive_id, (row_number() OVER w)::INT AS rank, vec_id AS negative_id, positive_score,
  score AS negative_score FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= {most}"""


def chats(control: str) -> str:
    """Template: <turn ROLE>TEXT</turn> and a line feed; a backslash goes before what could be read as control."""
    body = "replace(replace(replace(text, '\\', '\\\\'), '</turn', '\\</turn'), '<turn', '\\<turn')"
    head = "length(role) + length(role) - length(translate(role, '\\<>', ''))"
    return f"""WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '{control}' UNION ALL SELECT -7, 1, 'assistant', '{control}')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn)) AS loss_sha256,
  sum({len('<turn >') + len('</turn>') + 1} + {head} + length({body}))::BIGINT AS formatted_chars
FROM t GROUP BY conv_id"""
