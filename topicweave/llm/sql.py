"""DuckDB SQL that must agree with the queries."""

from topicweave.llm.licenses import PHRASES, TEMPLATES, plain_words

SQL: dict[str, str] = {}

SQL["op7_exact_dedup"] = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
  FROM documents
), g AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY body)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
FROM t JOIN g USING (body)
"""


def _draw(key: str, name: str, weight: float) -> str:
    return f"-ln((('0x' || substr(md5({key} || '/{name}'), 1, 13))::BIGINT + 0.5) / {2**52}.0) / {weight}"


def _sharding(shards: int, column: str) -> str:
    """Each row with its smallest draw among regions, racks and shards in turn."""
    key = "coalesce(doc_id::VARCHAR, '')"
    full = [(f"region{r}", {f"rack{k}": [8 * r + 4 * k + i for i in range(4)] for k in range(2)}) for r in range(3)]
    extra = [(f"single{s}", {"rack0": [s]}) for s in range(24, shards)]
    tree = full + extra

    def first(choices: list[tuple[str, float, str]]) -> str:
        low = "least(" + ", ".join(_draw(key, n, w) for n, w, _ in choices) + ")"
        if len(choices) == 1:
            return choices[0][2]
        cases = " ".join(f"WHEN {_draw(key, n, w)} = {low} THEN {v}" for n, w, v in choices)
        return f"CASE {cases} END"

    region = first([(r, float(sum(map(len, racks.values()))), f"'{r}'") for r, racks in tree])
    rack = "CASE region " + " ".join(
        f"WHEN '{r}' THEN " + first([(f"{r}/{k}", float(len(v)), f"'{r}/{k}'") for k, v in racks.items()]) for r, racks in tree
    ) + " END"
    shard = "CASE rack " + " ".join(
        f"WHEN '{r}/{k}' THEN " + first([(f"{r}/{k}/{s}", 1.0, str(s)) for s in v]) for r, racks in tree for k, v in racks.items()
    ) + " END"
    return f"""SELECT doc_id, text, {shard}::INTEGER AS {column} FROM (
      SELECT *, {rack} AS rack FROM (SELECT doc_id, text, {region} AS region FROM documents))"""


# the cyclic redundancy check of 32 bits, byte by byte, with its table computed from the polynomial
SQL["op1_sharding"] = f"""
WITH RECURSIVE bits AS (
  SELECT i AS byte, i::BIGINT AS c, 0 AS n FROM range(256) r(i)
  UNION ALL
  SELECT byte, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n + 1 FROM bits WHERE n < 8
), tab AS (SELECT list(c ORDER BY byte) AS t FROM bits WHERE n = 8),
now AS ({_sharding(24, 'shard')}), later AS ({_sharding(25, 'grown_shard')}),
d AS (SELECT now.doc_id, coalesce(now.text, '') AS body, shard, grown_shard FROM now JOIN later USING (doc_id)),
texts AS (SELECT DISTINCT body, hex(encode(body)) AS h FROM d),
chars AS (
  SELECT body, list_transform(range(0, (length(h) / 2)::BIGINT), lambda k: ('0x' || substr(h, (2 * k + 1)::BIGINT, 2))::BIGINT) AS b
  FROM texts
), crcs AS (
  SELECT body, xor(list_reduce(list_prepend(4294967295::BIGINT, b),
      lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) AS text_crc32
  FROM chars, tab
)
SELECT doc_id, (octet_length(encode(body)) + 8)::BIGINT AS size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY
         ('0x' || substr(md5(concat_ws('|', doc_id, text_crc32, octet_length(encode(body)) + 8)), 1, 13))::BIGINT
           % greatest(16, (SELECT count(*) FROM documents) // 10000), doc_id, text_crc32) - 1 AS slot, grown_shard
FROM d JOIN crcs USING (body)
"""

# all pairs and their transitive closure
SQL["op9_embeddings"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), p AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), r AS (SELECT a, b FROM p UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a),
n AS (SELECT a, count(*) AS n_links FROM p GROUP BY a), c AS (SELECT a, min(b) AS least_id FROM r GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(least(vec_id, least_id), vec_id) AS component_id,
  vec_id = coalesce(least(vec_id, least_id), vec_id) AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN c ON c.a = vec_id
"""


def _means(rounds: int, k: int, dims: int) -> str:
    """Rounds of assignment to the nearest of all centroids and exact means, one after the other."""
    near = """SELECT vec_id, h, v, arg_min(c.cluster, (list_sum(list_transform(range(1, {n}), lambda i: (v[i] - c.m[i]) * (v[i] - c.m[i]))), c.cluster)) AS cluster
      FROM v, c{r} c GROUP BY vec_id, h, v"""
    parts = [
        f"""c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY h, v) - 1)::INTEGER AS cluster, v AS m
          FROM v ORDER BY h, v LIMIT {k})"""
    ]
    for r in range(rounds):
        parts.append(f"a{r} AS MATERIALIZED ({near.format(n=dims + 1, r=r)})")
        parts.append(f"""c{r + 1} AS MATERIALIZED (
          SELECT cluster, coalesce(new, m) AS m FROM c{r} LEFT JOIN (
            SELECT cluster, list(mean ORDER BY i) AS new FROM (
              SELECT cluster, i, ((sum(x) - (((sum(x) % count(*)) + count(*)) % count(*))) // count(*))::HUGEINT AS mean
              FROM (SELECT cluster, unnest(v) AS x, unnest(range({dims})) AS i FROM a{r}) GROUP BY cluster, i
            ) GROUP BY cluster) USING (cluster))""")
    parts.append(f"last AS MATERIALIZED ({near.format(n=dims + 1, r=rounds)})")
    return ",\n".join(parts)


SQL["op11_centroids"] = f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, sha256('3:' || coalesce(vec_id::VARCHAR, '')) AS h, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::HUGEINT) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), {_means(10, 8, 64)},
d AS (SELECT vec_id, l.cluster, list_sum(list_transform(range(1, 65), lambda i: (v[i] - m[i]) * (v[i] - m[i])))::BIGINT AS distance, m
      FROM last l JOIN c10 USING (cluster))
SELECT vec_id, cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
  sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
FROM d
"""

_LICENSE_WORDS = ", ".join(
    f"({i}, '{label}', {phrase}, {plain_words(text)!r}, {max(len(plain_words(t)) for _, t in PHRASES + TEMPLATES)})"
    for i, (label, text, phrase) in enumerate([(*p, True) for p in PHRASES] + [(*t, False) for t in TEMPLATES])
)

# every block of every text against every template
SQL["op12_licenses"] = f"""
WITH t(number, label, phrase, words, stride) AS (VALUES {_LICENSE_WORDS}),
d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
), p AS (SELECT row, unnest(w) AS word, unnest(range(len(w))) AS place FROM d),
b AS (
  SELECT row, number, place // stride - k AS block, word FROM p JOIN t ON list_contains(t.words, word), range(2) r(k) WHERE place // stride - k >= 0
), shares AS (
  SELECT row, number, max(share) AS share FROM (
    SELECT row, number, block, count(DISTINCT word) / len(list_distinct(any_value(words))) AS share
    FROM b JOIN t USING (number) WHERE NOT phrase GROUP BY row, number, block
  ) WHERE share >= 0.8 - 1e-9 GROUP BY row, number
), found AS (SELECT row, list(DISTINCT label) AS labels, max(share) AS share FROM shares JOIN t USING (number) GROUP BY row),
places AS (SELECT row, label, place FROM p JOIN t ON phrase AND word = words[1] JOIN d USING (row) WHERE w[place + 1 : place + len(words)] = words),
base AS (SELECT row, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, list(DISTINCT label) AS base FROM places GROUP BY row)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(array_to_string(list_sort(base), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(base, labels))), ','), '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(share, 0.0) END::DOUBLE AS score
FROM d LEFT JOIN base USING (row) LEFT JOIN found USING (row)
"""

# near words share what is left when one letter is taken from one or both
SQL["op13_variants"] = """
WITH RECURSIVE bits AS (
  SELECT i AS byte, i::BIGINT AS c, 0 AS n FROM range(256) r(i)
  UNION ALL
  SELECT byte, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n + 1 FROM bits WHERE n < 8
), tab AS (SELECT list(c ORDER BY byte) AS t FROM bits WHERE n = 8),
runs AS (
  SELECT doc_id, run, count(*) AS rows FROM (
    SELECT coalesce(doc_id::VARCHAR, '') AS doc_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\\x{C0}-\\x{FF}]+')) AS run
    FROM documents) WHERE length(run) >= 5 GROUP BY ALL
), bytes AS (SELECT doc_id, run, rows, hex(encode(doc_id || ':' || run)) AS h FROM runs),
sums AS (
  SELECT run, rows, xor(list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(range(0, (length(h) / 2)::BIGINT), lambda k: ('0x' || substr(h, (2 * k + 1)::BIGINT, 2))::BIGINT)),
      lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) AS h
  FROM bytes, tab
), w AS MATERIALIZED (
  SELECT word, sum(rows)::BIGINT AS n FROM (
    SELECT rows, CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run) + 2)::BIGINT) ELSE run END AS word
    FROM sums) WHERE length(word) >= 5 GROUP BY word HAVING sum(rows) >= 3
), less AS MATERIALIZED (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM w)
), near AS MATERIALIZED (
  SELECT DISTINCT a.word, b.word AS other, b.n FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN w b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN w b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, max(n) AS most FROM near GROUP BY word
), chosen AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 2 * w.n THEN most END AS form_n,
    CASE WHEN most >= 2 * w.n THEN (SELECT min(other) FROM near WHERE near.word = w.word AND near.n = most) END AS form
  FROM w LEFT JOIN best ON best.word = w.word
), chain AS (
  SELECT word, word AS root, 0 AS steps FROM chosen
  UNION ALL SELECT chain.word, form, steps + 1 FROM chain JOIN chosen ON chosen.word = root WHERE form IS NOT NULL
), ends AS (SELECT word, arg_max(root, steps) AS root FROM chain GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM chosen JOIN ends USING (word)
"""
