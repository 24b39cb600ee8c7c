"""DuckDB SQL for the corpus operators that SQL can express."""

from __future__ import annotations

_DRAW = "((('0x' || md5(doc_id::VARCHAR || ':' || {s})[1:13])::BIGINT)::DOUBLE + 0.5) / 4503599627370496.0"


def _shard(n: int) -> str:
    return f"list_sort(list_transform(range({n}), lambda s: {{'score': -1.0 / ln({_DRAW.format(s='s')}), 'shard': -s}}), 'DESC')[1].shard * -1"


OP7 = f"""
WITH t0 AS (SELECT range AS i, range AS c FROM range(256)),
step AS (SELECT i, list_reduce(range(8), lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, c) AS c FROM t0),
tab AS (SELECT list(c ORDER BY i) AS crc FROM step),
rows AS (
    SELECT doc_id, coalesce(text, '') AS body, octet_length(encode(coalesce(text, '')))::BIGINT + 1 AS size,
           ({_shard(8)})::INTEGER AS shard, ({_shard(9)})::INTEGER AS grown_shard
    FROM documents),
crcs AS (
    SELECT *, xor(list_reduce(list_transform(regexp_extract_all(hex(encode(body)), '..'), lambda h: ('0x' || h)::BIGINT),
                              lambda c, b: xor(c // 256, tab.crc[xor(c & 255, b) + 1]), 4294967295::BIGINT), 4294967295)::BIGINT AS text_crc32
    FROM rows, tab)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY md5(doc_id::VARCHAR), doc_id, text_crc32, size) - 1 AS slot, grown_shard
FROM crcs
"""


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP4 = f"""
WITH item AS (SELECT item_id::VARCHAR AS item, {_WORDS} AS w FROM benchmark),
sized AS (SELECT item, w, least(len(w), 10) AS n FROM item WHERE len(w) > 0),
item_starts AS (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM sized),
win AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS words FROM item_starts),
doc AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
doc_starts AS (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, (SELECT DISTINCT n FROM win)),
hit AS (SELECT d.rid, d.i, d.n, win.item FROM (SELECT rid, i, n, array_to_string(w[i:i + n - 1], ' ') AS words FROM doc_starts) d JOIN win USING (n, words)),
hit_words AS (SELECT rid, count(DISTINCT j) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS j FROM hit) GROUP BY rid),
hit_items AS (SELECT rid, list_sort(list(DISTINCT item) FILTER (item IS NOT NULL)) AS items FROM hit GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM doc LEFT JOIN hit_words USING (rid) LEFT JOIN hit_items USING (rid)
"""

_KEYWORDS = "[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]"
_PREFIX = rf"(?:{_KEYWORDS})[\"'']?\x20*[:=]\x20*[\"'']?"


_VALUE = "[A-Za-z0-9+/_.=-]+"

# Each step searches what is left of the text after the match before it.
OP9 = f"""
WITH RECURSIVE doc AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS body FROM documents),
matched AS (
    SELECT rid, rank, body AS rest, 0::BIGINT AS done, 0::BIGINT AS start, '' AS hit, '' AS value FROM doc, (VALUES (0), (1), (2)) r(rank)
    UNION ALL
    SELECT rid, rank, substr(rest, strpos(rest, m) + length(m)), done + strpos(rest, m) - 1 + length(m), done + strpos(rest, m) - 1, m,
           CASE rank WHEN 0 THEN regexp_extract(rest, '{_PREFIX}({_VALUE})', 1) ELSE m END
    FROM (SELECT *, CASE rank WHEN 0 THEN regexp_extract(rest, '{_PREFIX}{_VALUE}') WHEN 1 THEN regexp_extract(rest, 'AKIA[A-Z0-9]+') ELSE regexp_extract(rest, '[0-9a-f]+') END AS m FROM matched)
    WHERE m <> ''),
found AS (
    SELECT rid, rank, ['assign', 'access', 'hex'][rank + 1] AS kind, start, start + length(hit) AS stop FROM matched
    WHERE hit <> '' AND length(value) >= [12, 18, 16][rank + 1]),
listed AS (
    SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
           string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans
    FROM found GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM doc LEFT JOIN listed USING (rid)
"""

# Every pair of lengths in every round; of equal solutions the fewest buckets, then the smallest place of the cut.
OP5 = r"""
WITH RECURSIVE doc AS (SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) + 1 AS n FROM documents),
pieces AS (SELECT doc_id, p::INTEGER AS piece, (p * 2048)::BIGINT AS first_token, least(n - p * 2048, 2048)::INTEGER AS n_tokens FROM (SELECT doc_id, n, unnest(range((n - 1) // 2048 + 1)) AS p FROM doc)),
histogram AS (SELECT n_tokens AS size, count(*) AS c, row_number() OVER (ORDER BY n_tokens) AS j FROM pieces GROUP BY n_tokens),
summed AS (SELECT j, size, (sum(c) OVER (ORDER BY j))::BIGINT AS n, (sum(c * size) OVER (ORDER BY j))::BIGINT AS tokens FROM histogram),
rounds(k, j, m) AS (
    SELECT 1, j, {'cost': size * n - tokens, 'i': 0::BIGINT} FROM summed
    UNION ALL
    SELECT r.k + 1, b.j, min({'cost': r.m.cost + b.size * (b.n - a.n) - (b.tokens - a.tokens), 'i': a.j})
    FROM rounds r JOIN summed a ON a.j = r.j JOIN summed b ON b.j > a.j WHERE r.k < 16 GROUP BY r.k, b.j),
best AS (SELECT k, j, m.i AS i FROM rounds WHERE j = (SELECT max(j) FROM summed) ORDER BY m.cost, k LIMIT 1),
chosen(k, j, i) AS (SELECT k, j, i FROM best UNION ALL SELECT r.k, r.j, r.m.i FROM chosen c JOIN rounds r ON r.k = c.k - 1 AND r.j = c.i),
buckets AS (SELECT (row_number() OVER (ORDER BY size) - 1)::INTEGER AS bucket, size::INTEGER AS boundary, coalesce(lag(size) OVER (ORDER BY size), 0) AS above FROM chosen JOIN summed USING (j)),
placed AS (
    SELECT p.*, bucket, boundary, row_number() OVER (PARTITION BY bucket ORDER BY md5(doc_id::VARCHAR || ':' || piece::VARCHAR), doc_id, piece, n_tokens) - 1 AS place, greatest(1, 65536 // boundary) AS n_rows
    FROM pieces p JOIN buckets ON n_tokens > above AND n_tokens <= boundary)
SELECT doc_id, piece, first_token, n_tokens, bucket, boundary, (place // n_rows)::BIGINT AS batch, (place % n_rows)::INTEGER AS row FROM placed
"""

# Texts as hex digits, two for each byte.
OP1 = """
WITH doc AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, '')))::BIGINT AS n FROM documents),
win AS (SELECT rid, doc_id, s, md5(substr(h, 2 * s + 1, 200)) AS w FROM (SELECT rid, doc_id, h, unnest(range(n - 99)) AS s FROM doc)),
again AS (SELECT rid, s FROM (SELECT rid, s, row_number() OVER (PARTITION BY w ORDER BY doc_id, rid, s) AS k FROM win) WHERE k > 1),
begun AS (SELECT rid, s, (s > coalesce(lag(s) OVER (PARTITION BY rid ORDER BY s), -101) + 100)::BIGINT AS new FROM again),
numbered AS (SELECT rid, s, sum(new) OVER (PARTITION BY rid ORDER BY s) AS run FROM begun),
span AS (SELECT rid, min(s) AS start, max(s) + 100 AS stop FROM numbered GROUP BY rid, run),
gap AS (SELECT rid, start, stop, coalesce(lag(stop) OVER (PARTITION BY rid ORDER BY start), 0) AS before FROM span),
cut AS (
    SELECT rid, count(*) AS n_spans, sum(stop - start) AS n_removed, max(stop) AS last, string_agg(substr(h, 2 * before + 1, 2 * (start - before)), '' ORDER BY start) AS kept
    FROM gap JOIN doc USING (rid) GROUP BY rid)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM doc LEFT JOIN cut USING (rid)
"""

OP2 = """
WITH RECURSIVE
sized AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
good AS (
    SELECT vec_id, e FROM sized
    WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND coalesce(list_sum(list_transform(e, lambda x: x * x)), 0) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a, good b WHERE a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT vec_id, (SELECT count(*) FROM link WHERE a = vec_id)::BIGINT AS n_links,
       least(vec_id, coalesce((SELECT min(b) FROM reach WHERE a = vec_id), vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce((SELECT min(b) FROM reach WHERE a = vec_id), vec_id)) AS kept
FROM embeddings
"""

ORACLES: dict[str, str] = {"op1_substrings": OP1, "op2_embeddings": OP2, "op4_decontamination": OP4, "op5_packing": OP5, "op7_sharding": OP7, "op9_secrets": OP9}
