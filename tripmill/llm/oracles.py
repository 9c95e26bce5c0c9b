"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from tripmill.llm import mixing, queries, sharding, warc

CRC_POLYNOMIAL = 0xEDB88320


def feistel() -> str:
    """Cycle walking as a recursive query; each round is a nested select on the two halves."""
    steps = sharding.Permutation(1, queries.SEED).keys
    mixed = "xor(right_half, {k}::UBIGINT)"
    body = "SELECT row_number, x >> half AS left_half, x & ((1::UBIGINT << half) - 1) AS right_half FROM {src}, shape"
    for key in steps:
        body = f"""SELECT row_number, right_half AS left_half,
            xor(left_half, xor(m, m >> 16) & ((1::UBIGINT << half) - 1)) AS right_half
          FROM (SELECT *, (xor(m2, m2 >> 13) * 3266489909) & 4294967295 AS m
          FROM (SELECT *, (xor(m1, m1 >> 16) * 2246822507) & 4294967295 AS m2
          FROM (SELECT *, {mixed.format(k=key)} AS m1 FROM ({body}))), shape)"""
    once = f"SELECT row_number, (left_half << half) | right_half AS x FROM ({body}), shape"
    return f"""
    WITH RECURSIVE shape AS (
      SELECT count(*)::UBIGINT AS n,
             greatest(1, ceil(ceil(log2(greatest(count(*), 1))) / 2))::INTEGER AS half
      FROM documents
    ), bits AS (
      SELECT list(CASE WHEN b8 IS NULL THEN 0 ELSE b8 END ORDER BY i) AS crc_table FROM (
        SELECT i, list_reduce(list_concat([i::BIGINT], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
          lambda c, s: CASE WHEN c & 1 = 1 THEN xor({CRC_POLYNOMIAL}, c >> 1) ELSE c >> 1 END) AS b8
        FROM range(256) AS r(i))
    ), numbered AS (
      SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size,
             xor(4294967295, list_reduce(
               list_concat([4294967295], list_transform(
                 regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT)),
               lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1]))) AS text_crc32,
             row_number() OVER (ORDER BY doc_id) - 1 AS row_number
      FROM documents, bits
    ), walk AS (
      {once.format(src="(SELECT row_number, row_number::UBIGINT AS x FROM numbered)")}
      UNION ALL
      {once.format(src="(SELECT row_number, x FROM walk, shape WHERE x >= n)")}
    )
    SELECT doc_id, size, text_crc32, 'rows' AS law, (x % {queries.SHARDS})::INTEGER AS shard,
           (x // {queries.SHARDS})::BIGINT AS slot, NULL::INTEGER AS grown_shard
    FROM numbered JOIN walk USING (row_number), shape WHERE x < n
    """


def splitting_tree() -> str:
    """Blocks of taken words, and the shard that draws each: per level, buckets of sources and then sources
    give the blocks with the smallest hashes to the left half."""
    seed, levels, per_shard = queries.SEED, mixing.LEVELS, mixing.BLOCKS_PER_SHARD
    # The operator's own seed of the tree is that of the mix.
    steps = []
    for i in range(levels):
        steps.append(f"""
    bucket_left{i} AS (
      SELECT node, bucket, count(*) FILTER (WHERE place <= total // 2) AS take FROM (
        SELECT node, bucket, sum(1) OVER (PARTITION BY node) AS total,
               row_number() OVER (PARTITION BY node ORDER BY md5('{seed}|' || node || '|' || bucket || '|' || i), bucket) AS place
        FROM (SELECT node, bucket, unnest(range(1, sum(n)::BIGINT + 1)) AS i FROM nodes{i} GROUP BY node, bucket)
      ) GROUP BY node, bucket
    ), key_left{i} AS (
      SELECT node, key, count(*) FILTER (WHERE place <= take) AS n FROM (
        SELECT u.node, key, take,
               row_number() OVER (PARTITION BY u.node, u.bucket ORDER BY md5('{seed}|' || u.node || '|' || key || '|' || i), key) AS place
        FROM (SELECT node, bucket, key, unnest(range(1, n + 1)) AS i FROM nodes{i}) u
        JOIN bucket_left{i} b ON b.node = u.node AND b.bucket = u.bucket
      ) GROUP BY node, key
    ), nodes{i + 1} AS (
      SELECT 2 * s.node + side AS node, bucket, s.key, CASE WHEN side = 0 THEN coalesce(l.n, 0) ELSE s.n - coalesce(l.n, 0) END AS n
      FROM nodes{i} s LEFT JOIN key_left{i} l ON l.node = s.node AND l.key = s.key, range(2) AS r(side)
    )""")
    return rf"""
    whole_mix AS (
      SELECT greatest(1, (sum(size)::BIGINT + {(per_shard << levels) - 1}) // {per_shard << levels}) AS width FROM copies
    ), blocked AS (
      SELECT c.*, start_at // width AS block FROM copies c, whole_mix
    ), blocks AS (
      SELECT key, block, row_number() OVER (PARTITION BY key ORDER BY md5('{seed}|' || key || '|' || block), block) - 1 AS place
      FROM (SELECT DISTINCT key, block FROM blocked)
    ), quotas AS (
      SELECT key, count(*) AS n, (SELECT count(DISTINCT key) FROM blocks) AS sources FROM blocks GROUP BY key
    ), nodes0 AS (
      SELECT 1 AS node, ('0x' || md5(key)[1:8])::BIGINT % (floor(sqrt(sources - 1))::BIGINT + 1) AS bucket, key, n FROM quotas
    ), {",".join(steps)}, shares AS (
      SELECT node - {1 << levels} AS shard, key, n,
             coalesce(sum(n) OVER (PARTITION BY key ORDER BY node ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first
      FROM nodes{levels}
    ), dealt AS (
      SELECT doc_id, string_agg(shard || ':' || size, ' ' ORDER BY copy) AS shards
      FROM blocked c JOIN blocks b ON b.key = c.key AND b.block = c.block
      JOIN shares s ON s.key = b.key AND b.place >= s.first AND b.place < s.first + s.n
      GROUP BY doc_id
    )"""


def mixed_sources() -> str:
    return rf"""
    WITH RECURSIVE docs AS (
      SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
             md5('{queries.SEED}|' || doc_id) AS pick
      FROM documents
    ), ranked AS (
      SELECT source, sum(size)::BIGINT AS source_size,
             [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight,
             3.0::DOUBLE * sum(size)::DOUBLE AS most
      FROM docs GROUP BY source
    ), rounds AS (
      SELECT 0 AS i, sum(source_size)::DOUBLE AS share, sum(weight)::DOUBLE AS by_weight FROM ranked
      UNION ALL
      SELECT i + 1, (SELECT sum(source_size) FROM ranked)
               - coalesce((SELECT sum(most) FROM ranked WHERE most < weight * share / by_weight), 0),
             (SELECT sum(weight) FROM ranked WHERE NOT most < weight * share / by_weight)
      FROM rounds WHERE i < 50
    ), goals AS (
      SELECT source, source_size, least(most, weight * share / by_weight) AS target
      FROM ranked, (SELECT * FROM rounds ORDER BY i DESC LIMIT 1)
    ), plan AS (
      SELECT *, floor(target / source_size)::BIGINT AS passes,
             target - floor(target / source_size) * source_size AS rest
      FROM goals WHERE source_size > 0
    ), placed AS (
      SELECT d.*, passes, rest,
             sum(size) OVER (PARTITION BY d.source ORDER BY pick, size) AS after_it
      FROM docs d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source WHERE size > 0
    ), gaps AS (
      SELECT source, rest - coalesce(max(after_it) FILTER (WHERE after_it <= rest), 0) AS gap
      FROM placed GROUP BY source, rest
    ), extras AS (
      SELECT arg_min(doc_id, (abs(size - gap), pick)) AS extra
      FROM placed p JOIN gaps g ON p.source IS NOT DISTINCT FROM g.source
      WHERE after_it > rest AND abs(size - gap) < gap GROUP BY p.source
    ), keyed AS (
      SELECT p.*, coalesce('+' || p.source, '-') AS key, source_size FROM placed p
      JOIN goals g ON p.source IS NOT DISTINCT FROM g.source
    ), copies AS (
      SELECT doc_id, key, size, c AS copy, c * source_size + after_it - size AS start_at FROM keyed, unnest(range(passes)) AS r(c)
      UNION ALL
      SELECT doc_id, key, size, passes, passes * source_size + after_it - size FROM keyed WHERE after_it <= rest
      UNION ALL
      SELECT doc_id, key, size, passes, passes * source_size + (rest - gap)::BIGINT
      FROM keyed k JOIN gaps g ON k.source IS NOT DISTINCT FROM g.source WHERE doc_id IN (SELECT extra FROM extras)
    ), {splitting_tree()}
    SELECT d.doc_id, d.size::BIGINT AS size, source_size, target,
           coalesce(d.size * (passes + (after_it <= rest)::BIGINT
             + (d.doc_id IN (SELECT extra FROM extras))::BIGINT), 0)::BIGINT AS taken, coalesce(shards, '') AS shards
    FROM docs d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source
    LEFT JOIN placed p ON p.doc_id = d.doc_id LEFT JOIN dealt t ON t.doc_id = d.doc_id
    """


def ngram_jaccard() -> str:
    """All pairs that share a shingle, and the smallest id that links reach."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
    WITH RECURSIVE worded AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'),
                                        '[^\x20\x09-\x0D]+') AS ws FROM documents
    ), sets AS (
      SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
        ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS shingles
      FROM worded
    ), members AS (
      SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets
    ), links AS (
      SELECT a.doc_id AS u, b.doc_id AS v
      FROM members a JOIN members b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
    ), reached AS (
      SELECT doc_id, doc_id AS other FROM sets
      UNION SELECT r.doc_id, l.v FROM reached r JOIN links l ON l.u = r.other
    )
    SELECT s.doc_id, len(shingles)::BIGINT AS n_shingles, min(other) AS component_id
    FROM sets s JOIN reached r ON r.doc_id = s.doc_id GROUP BY s.doc_id, shingles
    """


def clusters() -> str:
    """Every distance of every round; centroids are lists of integers."""
    k, rounds, seed, width = (queries.CLUSTERING[n] for n in ("k", "rounds", "seed", "width"))

    def assigned(i: int) -> str:
        apart = f"list_sum(list_transform(range(1, {width + 1}), lambda d: (v[d] - p[d]) * (v[d] - p[d])))::BIGINT"
        return f"""assigned{i} AS MATERIALIZED (
      SELECT rid, any_value(vec_id) AS vec_id, any_value(v) AS v, arg_min(c, (apart, c)) AS c, min(apart) AS distance
      FROM (SELECT rid, vec_id, v, c, {apart} AS apart FROM vectors, centroids{i}) GROUP BY rid
    )"""

    def centroids(i: int) -> str:
        return f"""centroids{i} AS MATERIALIZED (
      SELECT c, coalesce(moved.p, centroids{i - 1}.p) AS p
      FROM centroids{i - 1} LEFT JOIN (
        SELECT c, list(whole ORDER BY d) AS p FROM (
          SELECT c, d, ((s - ((s % n) + n) % n) // n)::BIGINT AS whole FROM (
            SELECT c, d, sum(v[d])::BIGINT AS s, count(*) AS n FROM assigned{i - 1}, range(1, {width + 1}) AS r(d) GROUP BY c, d)
        ) GROUP BY c) AS moved USING (c)
    )"""

    steps = ",".join(step for i in range(1, rounds + 1) for step in (centroids(i), assigned(i)))
    return f"""
    WITH vectors AS MATERIALIZED (
      SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
      FROM embeddings
      WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {width}
    ), centroids0 AS MATERIALIZED (
      SELECT row_number() OVER (ORDER BY h, v)::INTEGER - 1 AS c, v AS p
      FROM (SELECT sha256('{seed}:' || vec_id) AS h, v FROM vectors ORDER BY h, v LIMIT {k})
    ), {assigned(0)}, {steps}
    SELECT vec_id, c::INTEGER AS cluster, distance, sum(distance) OVER (PARTITION BY c)::BIGINT AS cluster_inertia,
           sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(p, ',')) AS centroid_sha256
    FROM assigned{rounds} JOIN centroids{rounds} USING (c)
    """


def prefix_trie() -> str:
    """Every prefix as a list of turns, and every pair of a prefix and one that starts with it."""
    return f"""
    WITH bits AS (
      SELECT list(b8 ORDER BY i) AS crc_table FROM (
        SELECT i, list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
          lambda c, s: CASE WHEN c & 1 = 1 THEN xor({CRC_POLYNOMIAL}, c >> 1) ELSE c >> 1 END) AS b8
        FROM range(256) AS r(i))
    ), own AS (
      SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS d,
             {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS said
      FROM conversations WHERE conv_id IS NOT NULL
    ), convs AS (
      SELECT DISTINCT conv_id, xor(4294967295, list_reduce(
               list_concat([4294967295], list_transform(regexp_extract_all(hex(encode(conv_id::VARCHAR)), '..'),
                 lambda h: ('0x' || h)::BIGINT)),
               lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1]))) % {queries.SHARED_TURNS + 1} AS h
      FROM own, bits
    ), rebuilt AS (
      SELECT c.conv_id, o.d, o.said FROM convs c
      JOIN own o ON o.conv_id = c.conv_id - c.conv_id % {queries.CONVERSATION_GROUP} AND o.d <= h
      UNION ALL
      SELECT c.conv_id, o.d, o.said FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.d > h
    ), paths AS (
      SELECT conv_id, coalesce(list(said ORDER BY d) FILTER (WHERE d IS NOT NULL), []) AS path
      FROM convs LEFT JOIN rebuilt USING (conv_id) GROUP BY conv_id
    ), members AS (
      SELECT conv_id, d, path[1:d] AS prefix, len(path) = d AS ends FROM paths, unnest(range(len(path) + 1)) AS r(d)
    ), nodes AS (
      SELECT prefix, d, min(conv_id) AS conv_id, count(*) AS n_convs,
             sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256,
             CASE WHEN d > 0 THEN (count(*) - 1) * length(prefix[d].text) ELSE 0 END AS saved
      FROM members GROUP BY prefix, d
    ), childless AS (
      SELECT n.*, c.n_children FROM nodes n LEFT JOIN (
        SELECT prefix[1:d - 1] AS prefix, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1) c USING (prefix)
    ), subtrees AS (
      SELECT prefix[1:up] AS prefix, sum(CASE WHEN n_children IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved_tokens
      FROM childless, unnest(range(d + 1)) AS r(up) GROUP BY 1
    )
    SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n.n_children, 0)::BIGINT AS n_children,
           n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
    FROM childless n JOIN subtrees USING (prefix) LEFT JOIN nodes p ON n.d > 0 AND p.prefix = n.prefix[1:n.d - 1]
    """


def warc_records() -> str:
    return f"""
    WITH sized AS (
      SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
    ), firsts AS (
      SELECT payload_digest, min(page_id) AS first_id FROM sized
      WHERE payload_bytes >= {warc.LEAST_PAYLOAD} GROUP BY payload_digest HAVING count(*) > 1
    )
    SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
           CASE WHEN first_id IS NULL OR page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> first_id THEN first_id END AS refers_to
    FROM sized LEFT JOIN firsts USING (payload_digest)
    """


def llm_oracles() -> dict[str, str]:
    return {
        "op1_feistel_shards": feistel(),
        "op2_mix_sources": mixed_sources(),
        "op8_ngram_jaccard": ngram_jaccard(),
        "op11_va_clusters": clusters(),
        "op12_zfast_trie": prefix_trie(),
        "op13_warc": warc_records(),
    }
