"""SQL over the same tables, one statement per query that SQL can state."""

from __future__ import annotations

from catalog.inputs import STOPWORDS
from topicweave.operators.quality import HDBSCAN_GRID

SPACE = (
    r"[\t\n\x0b\f\r \x1c-\x1f\x{85}\x{A0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)


def words(text: str) -> str:
    return f"list_filter(regexp_split_to_array(coalesce({text}, ''), '{SPACE}'), lambda w: w <> '')"


def cte(**parts: str) -> str:
    return "WITH " + ", ".join(f"{name} AS ({body})" for name, body in parts.items()) + " "


def cte_recursive(**parts: str) -> str:
    return cte(**parts).replace("WITH", "WITH RECURSIVE", 1)


MASKED = """SELECT d.doc_id, CASE WHEN l.toxic = 1 THEN '' WHEN l.quality = 0 THEN NULL ELSE d.text END AS text,
    l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)"""
TOPICS = """SELECT d.doc_id, CASE WHEN l.toxic = 1 THEN -1 ELSE CAST(substr(d.source, 4) AS INTEGER) END AS topic
    FROM documents d LEFT JOIN labels l USING (doc_id)"""
LABELS = "SELECT vec_id AS doc_id, CASE WHEN label = 9 THEN -1 ELSE label END AS topic FROM embeddings"
VECTORS = "SELECT vec_id AS doc_id, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings"
TOKENS = f"SELECT doc_id, list_filter({words('text')}, lambda w: len(w) >= 2) AS tokens FROM documents"
COUNTS = """SELECT topic, word, count(*) AS n
    FROM (SELECT t.topic, lower(unnest(k.tokens)) AS word FROM tok k JOIN topics t USING (doc_id)) GROUP BY ALL"""
VOCAB = """SELECT topic, word, n FROM (SELECT *, count(*) OVER (PARTITION BY word) AS df FROM counts)
    WHERE df >= 5 AND df <= 0.95 * (SELECT count(DISTINCT topic) FROM counts)"""
SCORES = """SELECT v.topic, v.word, v.n, CAST(v.n AS DOUBLE) / t.total AS tf,
        ln(1 + a.mean / w.f) AS idf, CAST(v.n AS DOUBLE) / t.total * ln(1 + a.mean / w.f) AS score
    FROM vocab v
    JOIN (SELECT topic, CAST(sum(n) AS DOUBLE) AS total FROM vocab GROUP BY topic) t USING (topic)
    JOIN (SELECT word, CAST(sum(n) AS DOUBLE) AS f FROM vocab GROUP BY word) w USING (word)
    CROSS JOIN (SELECT floor(avg(s)) AS mean FROM (SELECT sum(n) AS s FROM vocab GROUP BY topic)) a"""
TOP = """SELECT * FROM (SELECT topic, word, score,
    row_number() OVER (PARTITION BY topic ORDER BY score DESC, word) AS rank FROM scores) WHERE rank <= 10"""
SCORING = {"tok": TOKENS, "topics": TOPICS, "counts": COUNTS, "vocab": VOCAB, "scores": SCORES}
TOPPED = {**SCORING, "topped": TOP}

PAIRS = f"""SELECT doc_id, list_transform({words('text')}, lambda w: struct_pack(form := w, tag := CASE
        WHEN regexp_matches(w, '^[A-Z]') THEN 'NNP' WHEN regexp_matches(w, 's$') THEN 'XSN'
        WHEN len(w) <= 2 THEN 'XPN' WHEN regexp_matches(w, '[aiou]$') THEN 'JKB'
        WHEN regexp_matches(w, '^[a-e]') THEN 'SL' ELSE 'NNG' END)) AS pairs FROM documents"""


def piece(code: str) -> str:
    return rf"\x1f[^\x1e]*\x1e{code}"


def encoded(cases: str) -> str:
    return (
        "array_to_string(list_transform(pairs, lambda p: chr(31) || p.form || chr(30) || "
        f"(CASE {cases} END)), '')"
    )


NOUN_GROUPS = "|".join(
    (piece("P") + piece("N") + piece("S"), piece("P") + piece("N"), piece("N") + piece("S"), piece("[NPSL]"))
)
LETTERS = "WHEN p.tag IN ('NNG', 'NNP') THEN 'N' WHEN p.tag = 'XPN' THEN 'P' WHEN p.tag = 'XSN' THEN 'S' WHEN p.tag = 'SL' THEN 'L' ELSE 'O'"


def knn(k: int, dist: str) -> dict[str, str]:
    return {
        "v": VECTORS,
        "near": f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY dist, dst) AS rank FROM (
            SELECT a.doc_id AS src, b.doc_id AS dst, {dist}(a.vec, b.vec) AS dist
            FROM v a JOIN v b ON a.doc_id <> b.doc_id)) WHERE rank <= {k}""",
    }


FUZZY = {
    **knn(14, "list_cosine_distance"),
    "lists": """SELECT src, list(dist ORDER BY rank) AS d, coalesce(min(dist) FILTER (dist > 0), 0.0) AS rho
        FROM near GROUP BY src""",
    # bisection for sigma, 64 steps
    "fitted": """SELECT src, rho, d, list_reduce(range(64), lambda s, i: CASE
            WHEN s.done OR abs(list_sum(list_transform(d, lambda x: exp(-greatest(x - rho, 0) / s.mid))) - log2(15)) < 1e-5
              THEN struct_pack(low := s.low, high := s.high, mid := s.mid, done := true)
            WHEN list_sum(list_transform(d, lambda x: exp(-greatest(x - rho, 0) / s.mid))) > log2(15)
              THEN struct_pack(low := s.low, high := s.mid, mid := (s.low + s.mid) / 2, done := false)
            WHEN s.high > 1e300
              THEN struct_pack(low := s.mid, high := s.high, mid := s.mid * 2, done := false)
            ELSE struct_pack(low := s.mid, high := s.high, mid := (s.mid + s.high) / 2, done := false) END,
          struct_pack(low := 0.0::DOUBLE, high := 1e308::DOUBLE, mid := 1.0::DOUBLE, done := false)).mid AS mid FROM lists""",
    "sig": """SELECT src, rho, greatest(mid, 1e-3 * CASE WHEN rho > 0 THEN list_sum(d) / (len(d) + 1)
        ELSE (SELECT avg(dist) * 14 / 15 FROM near) END) AS sigma FROM fitted""",
    "strength": """SELECT n.src, n.dst, s.rho, s.sigma, exp(-greatest(n.dist - s.rho, 0) / s.sigma) AS strength
        FROM near n JOIN sig s USING (src)""",
}

LABELINGS = """SELECT doc_id, unnest([0, 1, 2]) AS trial_id, unnest([CAST(substr(d.source, 4) AS INTEGER),
      l.topic, CASE d.lang WHEN 'en' THEN 0 WHEN 'fr' THEN 1 WHEN 'de' THEN 2 ELSE -1 END]) AS topic
    FROM documents d JOIN lab l USING (doc_id)"""
EUCLID = "sqrt(list_sum(list_transform(list_zip(a.vec, b.vec), lambda p: (p[1] - p[2]) ^ 2)))"
SILHOUETTE = {
    # distances once for all labelings
    "dist": f"SELECT a.doc_id AS x, b.doc_id AS y, {EUCLID} AS d FROM v a JOIN v b ON a.doc_id <> b.doc_id",
    "clustered": "SELECT * FROM named WHERE topic <> -1",
    "sums": """SELECT p.trial_id, p.doc_id, p.topic, q.topic AS other, sum(d) AS total, count(*) AS n
        FROM clustered p JOIN dist ON p.doc_id = x JOIN clustered q ON q.doc_id = y AND q.trial_id = p.trial_id
        GROUP BY ALL""",
    "ab": """SELECT trial_id, doc_id, max(total / n) FILTER (topic = other) AS a,
        min(total / n) FILTER (topic <> other) AS b FROM sums GROUP BY ALL""",
    "sil": """SELECT trial_id, avg(CASE WHEN a IS NULL OR b IS NULL OR greatest(a, b) = 0 THEN 0.0
        ELSE (b - a) / greatest(a, b) END) AS silhouette FROM ab GROUP BY trial_id""",
}

# words of the embedded documents under three labelings, min_df = 1
MEASURED = {
    "lab": LABELS,
    "v": VECTORS,
    "named": LABELINGS,
    **SILHOUETTE,
    "tok": TOKENS + " WHERE doc_id IN (SELECT vec_id FROM embeddings)",
    "counts": """SELECT trial_id, topic, word, count(*) AS n FROM (SELECT n.trial_id, n.topic, lower(unnest(k.tokens)) AS word
        FROM tok k JOIN named n USING (doc_id)) GROUP BY ALL""",
    "vocab": """SELECT c.* FROM (SELECT *, count(*) OVER (PARTITION BY trial_id, word) AS df FROM counts) c
        JOIN (SELECT trial_id, count(DISTINCT topic) AS units FROM counts GROUP BY trial_id) u USING (trial_id)
        WHERE c.df >= 1 AND c.df <= 0.95 * u.units""",
    "totals": "SELECT trial_id, topic, CAST(sum(n) AS DOUBLE) AS total FROM vocab GROUP BY ALL",
    "means": "SELECT trial_id, floor(avg(total)) AS mean FROM totals GROUP BY trial_id",
    "scores": """SELECT x.trial_id, x.topic, x.word, CAST(x.n AS DOUBLE) / t.total
          * ln(1 + m.mean / sum(x.n) OVER (PARTITION BY x.trial_id, x.word)) AS score
        FROM vocab x JOIN totals t USING (trial_id, topic) JOIN means m USING (trial_id)""",
    "topped": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY trial_id, topic ORDER BY score DESC, word) AS rank
        FROM scores) WHERE rank <= 10""",
    "div": """SELECT trial_id, count(DISTINCT word) FILTER (topic <> -1) / CAST(count(word) FILTER (topic <> -1) AS DOUBLE)
        AS diversity FROM topped GROUP BY trial_id""",
    "sets": "SELECT doc_id, unnest(list_distinct(tokens)) AS word FROM tok WHERE len(tokens) > 0",
    "ndocs": "SELECT count(*) AS n FROM tok WHERE len(tokens) > 0",
    "wdf": "SELECT word, count(*) AS d FROM sets GROUP BY word",
    "tw": "SELECT trial_id, topic, rank, word FROM topped WHERE topic <> -1",
    "co": """SELECT a.word AS w1, b.word AS w2, count(*) AS d12 FROM (SELECT * FROM sets WHERE word IN (SELECT word FROM tw)) a
        JOIN (SELECT * FROM sets WHERE word IN (SELECT word FROM tw)) b ON a.doc_id = b.doc_id AND a.word <> b.word GROUP BY ALL""",
    "pmi": """SELECT p.trial_id, p.topic, avg(ln((coalesce(c.d12, 0) + 1) / (x.d * CAST(y.d AS DOUBLE) / (SELECT n FROM ndocs) + 1))) AS c
        FROM tw p JOIN tw q ON p.trial_id = q.trial_id AND p.topic = q.topic AND p.rank < q.rank
        JOIN wdf x ON x.word = p.word JOIN wdf y ON y.word = q.word
        LEFT JOIN co c ON c.w1 = p.word AND c.w2 = q.word GROUP BY ALL""",
    "coh": "SELECT trial_id, avg(c) AS coherence FROM pmi GROUP BY trial_id",
    "nc": """SELECT trial_id, count(DISTINCT topic) FILTER (topic <> -1) AS n_clusters,
        avg(CASE WHEN topic = -1 THEN 1.0 ELSE 0.0 END) AS noise_ratio FROM named GROUP BY trial_id""",
    "metrics": """SELECT *, 0.25 * greatest(silhouette, 0) + 0.20 * (1 - noise_ratio) + 0.25 * diversity
          + 0.15 * least(coherence / 5, 1) + 0.15 * CASE WHEN n_clusters BETWEEN 8 AND 15 THEN 1.0
          WHEN n_clusters >= 4 AND n_clusters <= 22.5 THEN 0.7 ELSE 0.3 END AS composite
        FROM nc JOIN sil USING (trial_id) JOIN div USING (trial_id) JOIN coh USING (trial_id)""",
}
RANKED = "ORDER BY round(composite, 4) DESC, trial_id"

CENTER = """SELECT {key}, list(m ORDER BY pos) AS vec FROM (SELECT {key}, pos, avg(x) AS m FROM
    (SELECT {key}, unnest(vec) AS x, generate_subscripts(vec, 1) AS pos FROM {rows}) GROUP BY ALL) GROUP BY {key}"""
WORD_VECTORS = {
    **SCORING,
    "candidates": TOP.replace("rank <= 10", "rank <= 30"),
    "v": VECTORS,
    "held": """SELECT s.word, v.vec FROM (SELECT doc_id, unnest(list_distinct(list_transform(tokens, lambda w: lower(w)))) AS word FROM tok) s
        JOIN v USING (doc_id) WHERE s.word IN (SELECT word FROM candidates)""",
    "wv": CENTER.format(key="word", rows="held"),
    "placed": "SELECT topic, vec FROM topics JOIN v USING (doc_id)",
    "tv": CENTER.format(key="topic", rows="placed"),
    "keybert": """SELECT * FROM (SELECT topic, word, score, row_number() OVER (PARTITION BY topic ORDER BY score DESC, word) AS rank
        FROM (SELECT c.topic, c.word, round(list_cosine_similarity(wv.vec, tv.vec), 9) AS score
        FROM candidates c JOIN wv USING (word) JOIN tv USING (topic))) WHERE rank <= 10""",
}

def mmr(first: str, n: int) -> dict[str, str]:
    """Greedy choice of ten words from the first ``n`` of a ranking, 0.3 diversity."""
    return {
        "cand": f"SELECT topic, rank, word, wv.vec FROM ({first}) JOIN wv USING (word) WHERE rank <= {n}",
        "rel": "SELECT c.topic, c.rank, c.word, round(list_cosine_similarity(c.vec, tv.vec), 9) AS rel FROM cand c JOIN tv USING (topic)",
        "likeness": """SELECT a.topic, a.word AS w1, b.word AS w2, round(list_cosine_similarity(a.vec, b.vec), 9) AS sim
          FROM cand a JOIN cand b ON a.topic = b.topic AND a.word <> b.word""",
        "chosen": """SELECT topic, [arg_min(word, struct_pack(a := -rel, b := rank))] AS picked FROM rel GROUP BY topic
          UNION ALL
          SELECT topic, list_append(any_value(picked), arg_min(word, struct_pack(a := -gain, b := rank))) FROM (
            SELECT p.topic, r.word, any_value(p.picked) AS picked, any_value(r.rank) AS rank,
              0.7 * any_value(r.rel) - 0.3 * max(s.sim) AS gain
            FROM chosen p JOIN rel r ON r.topic = p.topic AND NOT list_contains(p.picked, r.word)
            JOIN likeness s ON s.topic = p.topic AND s.w1 = r.word AND list_contains(p.picked, s.w2)
            WHERE len(p.picked) < 10 GROUP BY p.topic, r.word) GROUP BY topic""",
        "longest": "SELECT topic, arg_max(picked, len(picked)) AS picked FROM chosen GROUP BY topic",
        "listed": "SELECT topic, unnest(picked) AS word, generate_subscripts(picked, 1) AS rank FROM longest",
    }


MMR_RESULT = "SELECT l.topic, l.rank, l.word, round(r.rel, 6) AS score FROM listed l JOIN rel r ON r.topic = l.topic AND r.word = l.word"

# Kruskal: edges in order, one label per vector
KRUSKAL = {
    **knn(15, "list_distance"),
    "core": "SELECT src AS id, dist AS core FROM near WHERE rank = 5",
    "edges": """SELECT DISTINCT least(src, dst) AS src, greatest(src, dst) AS dst, greatest(a.core, b.core, dist) AS w
      FROM near JOIN core a ON a.id = src JOIN core b ON b.id = dst""",
    "ordered": "SELECT list(struct_pack(src := src, dst := dst, w := w) ORDER BY w, src, dst) AS es FROM edges",
    "start": """SELECT es, struct_pack(lab := (SELECT list(doc_id ORDER BY doc_id) FROM v), picked := list_filter(es, lambda e: false)) AS s
      FROM ordered""",
    "done": """SELECT list_reduce(es, lambda a, e: CASE WHEN a.lab[e.src + 1] = a.lab[e.dst + 1] THEN a ELSE struct_pack(
        lab := list_transform(a.lab, lambda l: CASE WHEN l = a.lab[e.dst + 1] THEN a.lab[e.src + 1] ELSE l END),
        picked := list_append(a.picked, e)) END, s) AS r FROM start""",
    "tree": "SELECT unnest(r.picked) AS e FROM done",
}

REPS = {
    "dw": "SELECT doc_id, topic, lower(unnest(tokens)) AS word FROM tok JOIN topics USING (doc_id)",
    "dwc": "SELECT doc_id, topic, word, count(*) AS k FROM dw GROUP BY ALL",
    "tn": "SELECT topic, sqrt(sum(score * score)) AS tnorm FROM scores GROUP BY topic",
    "sims": """SELECT topic, doc_id, dot / (dnorm * tnorm) AS similarity FROM (SELECT d.topic, d.doc_id,
          sum(k * idf * score) AS dot, sqrt(sum(k * idf * k * idf)) AS dnorm
        FROM dwc d JOIN scores s ON d.topic = s.topic AND d.word = s.word GROUP BY ALL) JOIN tn USING (topic)
        WHERE dnorm > 0 AND tnorm > 0""",
    "reps": """SELECT *, row_number() OVER (PARTITION BY topic ORDER BY round(similarity, 9) DESC, doc_id) AS rank FROM sims""",
}

BIGRAMS = f"""SELECT DISTINCT w[i] || w[i + 1] AS term FROM (SELECT w, unnest(range(1, len(w))) AS i
    FROM (SELECT {words('text')} AS w FROM benchmark))"""

SQL: dict[str, str] = {
    "read_corpus_csv": cte(m=MASKED) + "SELECT doc_id, nullif(text, '') AS text, quality, toxic FROM m",
    "read_vectors": cte(v=VECTORS) + "SELECT doc_id, len(vec) AS dim, round(list_sum(vec), 6) AS total FROM v",
    "latest_artifact": cte(t=TOPICS)
    + "SELECT 'second' AS timestamp, count(*) AS n_documents, count(DISTINCT topic) FILTER (topic <> -1) AS n_topics, count(*) FILTER (topic = -1) AS n_outliers FROM t",
    "check_alignment": cte(
        v="SELECT vec_id AS id, count(*) AS nv FROM (SELECT vec_id FROM embeddings UNION ALL SELECT vec_id FROM embeddings WHERE vec_id % 5 = 0) GROUP BY 1",
        c="SELECT doc_id AS id, count(*) AS nc FROM documents GROUP BY 1",
    )
    + """SELECT CAST(coalesce(sum(nv) FILTER (nc IS NULL), 0) AS BIGINT) AS vectors_only, CAST(coalesce(sum(nc) FILTER (nv IS NULL), 0) AS BIGINT) AS documents_only,
      count(*) FILTER (nv > 1) AS vectors_repeated, count(*) FILTER (nc > 1) AS documents_repeated FROM v FULL OUTER JOIN c USING (id)""",
    "read_word_list": f"SELECT DISTINCT word FROM (SELECT unnest({words('text')}) AS word FROM benchmark) WHERE word NOT LIKE '#%'",
    "read_user_dict": "SELECT p_brand AS term, CASE WHEN p_partkey = p_size THEN 'NNP' ELSE 'NNG' END AS tag, count(*) AS n FROM part GROUP BY ALL",
    "write_vectors": "SELECT d.doc_id, len(d.text) AS n_chars, len(e.embedding) AS dim FROM documents d JOIN embeddings e ON d.doc_id = e.vec_id",
    "embedding_info": "SELECT max(len(embedding)) AS embedding_dim, count(*) AS n_documents, CAST(2500 AS BIGINT) AS max_chars, true AS normalize_embeddings FROM embeddings",
    "write_tuning_results": cte(**MEASURED)
    + f"SELECT trial_id, n_clusters, round(noise_ratio, 4) AS noise_ratio, round(diversity, 4) AS diversity, round(composite, 4) AS composite FROM metrics {RANKED}",
    "tuned_config": cte(**MEASURED)
    + f"SELECT CAST(trial_id + 10 AS BIGINT) AS n_neighbors, n_clusters AS min_cluster_size, 'eom' AS cluster_method FROM metrics {RANKED} LIMIT 1",
    "write_topic_info": cte(**TOPPED)
    + """SELECT t.topic, t.n AS count, concat_ws('_', CAST(t.topic AS VARCHAR), w.first) AS name
      FROM (SELECT topic, count(*) AS n FROM topics GROUP BY topic) t LEFT JOIN
      (SELECT topic, string_agg(word, '_' ORDER BY rank) FILTER (rank <= 4) AS first FROM topped GROUP BY topic) w USING (topic)""",
    "write_doc_topics": cte(topics=TOPICS) + "SELECT doc_id, text, lang, topic FROM documents JOIN topics USING (doc_id)",
    "write_run_summary": cte(t=TOPICS)
    + """SELECT 'r' AS timestamp, count(*) AS n_documents, count(DISTINCT topic) FILTER (topic <> -1) AS n_topics,
      count(*) FILTER (topic = -1) AS n_outliers, round(avg(CASE WHEN topic = -1 THEN 100.0 ELSE 0 END), 1) AS pct_outliers,
      'whitespace' AS tokenizer FROM t""",
    "topic_model_tables": cte(**TOPPED)
    + """SELECT topic, n_docs, n_words FROM (SELECT topic, count(*) AS n_docs FROM topics GROUP BY topic)
      JOIN (SELECT topic, count(*) AS n_words FROM topped GROUP BY topic) USING (topic)""",
    "filter_verified": "SELECT doc_id, lang, quality, toxic FROM documents JOIN labels USING (doc_id) WHERE quality = 1",
    "drop_empty_text": cte(m=MASKED) + "SELECT doc_id, text FROM m WHERE len(text) > 0",
    "truncate_text": "SELECT doc_id, substr(text, 1, 2500) AS text_for_embed FROM documents",
    "fill_missing_text": cte(m=MASKED) + "SELECT doc_id, coalesce(text, '') AS text FROM m",
    "with_doc_id": "SELECT row_number() OVER (ORDER BY md5(lang || chr(31) || text)) - 1 AS doc_id, lang, text FROM documents",
    "missing_text_report": cte(m=MASKED)
    + """SELECT count(*) AS n_rows, count(*) FILTER (quality IN (0, 1)) AS n_verified,
      count(*) FILTER (quality IN (0, 1) AND len(text) > 0) AS n_with_text,
      count(*) FILTER (quality IN (0, 1) AND (text IS NULL OR len(text) = 0)) AS n_empty FROM m""",
    "tokenize_whitespace": f"""SELECT doc_id, array_to_string(t, ' ') AS document, len(t) AS n_tokens FROM (
      SELECT doc_id, list_filter({words('text')}, lambda w: len(w) >= 3 AND NOT list_contains({STOPWORDS!r}, w)) AS t FROM documents)""",
    "tokenize_none": f"SELECT doc_id, array_to_string({words('text')}, ' ') AS document, len({words('text')}) AS n_tokens FROM documents",
    "filter_tokens": cte(tok=TOKENS)
    + f"SELECT doc_id, array_to_string(list_filter(tokens, lambda w: len(w) >= 4 AND NOT list_contains({STOPWORDS!r}, w)), ' ') AS document FROM tok",
    "join_tokens": f"SELECT conv_id, turn, array_to_string(list_filter({words('text')}, lambda w: len(w) >= 2), ' ') AS document FROM conversations",
    "doc_word_sets": cte(tok=TOKENS)
    + """SELECT doc_id, array_to_string(list_sort(list_distinct(t)), ' ') AS words FROM (
      SELECT doc_id, list_filter(tokens, lambda w: len(w) >= 9) AS t FROM tok) WHERE len(t) > 0""",
    "tokenize_user": "SELECT doc_id, len(string_split(text, ',')) AS n_tokens FROM documents",
    "extract_nouns": cte(p=PAIRS, g=f"SELECT doc_id, regexp_extract_all({encoded(LETTERS)}, '{NOUN_GROUPS}') AS g FROM p")
    + r"""SELECT doc_id, array_to_string(t, ' ') AS document, len(t) AS n_tokens FROM (SELECT doc_id, list_filter(
      list_transform(g, lambda x: regexp_replace(x, '\x1f|\x1e[NPSL]', '', 'g')), lambda w: len(w) >= 2 AND w <> 'Thst') AS t FROM g)""",
    "combine_nominals": cte(
        p=PAIRS,
        g=f"""SELECT doc_id, regexp_extract_all({encoded("WHEN p.tag = 'NNP' THEN 'P' WHEN p.tag = 'NNG' THEN 'G' ELSE 'O'")},
          '(?:{piece('[GP]')})+|{piece('O')}') AS g FROM p""",
    )
    + r"""SELECT doc_id, array_to_string(list_transform(g, lambda x: regexp_replace(x, '\x1f|\x1e.', '', 'g')), ' ') AS forms,
      len(g) AS n_pairs, len(list_filter(g, lambda x: contains(x, chr(30) || 'P'))) AS n_proper FROM g""",
    "register_dictionary": """SELECT lang AS domain, 'np' AS kind, min(doc_id) AS pos, source AS term FROM documents WHERE lang <> 'en' GROUP BY ALL
      UNION ALL SELECT 'en', 'np', min(p_partkey), p_brand FROM part GROUP BY p_brand
      UNION ALL SELECT 'en', 'cp', min(n_nationkey), n_name FROM nation GROUP BY n_name""",
    "list_dictionary_domains": "SELECT DISTINCT lang AS domain FROM documents",
    # the longest term at each place, then greedily from left to right
    "apply_dictionary": cte_recursive(
        terms=BIGRAMS,
        lists=f"SELECT doc_id, {words('text')} AS w FROM documents",
        w="SELECT doc_id, unnest(w) AS form, generate_subscripts(w, 1) AS i FROM lists",
        nxt="SELECT *, lead(form) OVER (PARTITION BY doc_id ORDER BY i) AS after FROM w",
        begins="SELECT term, left(term, k) AS b FROM (SELECT term, unnest(range(1, len(term) + 1)) AS k FROM terms)",
        cand="SELECT n.doc_id, n.i, b.term FROM nxt n JOIN begins b ON b.b = n.form || n.after",
        spans="""SELECT c.doc_id, c.i, unnest(list_filter(range(2, len(c.term) + 1),
          lambda n: array_to_string(l.w[c.i : c.i + n - 1], '') = c.term)) AS n FROM cand c JOIN lists l USING (doc_id)""",
        hits="SELECT doc_id, i, max(n) AS n FROM spans GROUP BY ALL",
        picked="""SELECT doc_id, min(i) AS i, arg_min(n, i) AS n FROM hits GROUP BY doc_id UNION ALL
          SELECT h.doc_id, min(h.i), arg_min(h.n, h.i) FROM picked p JOIN hits h ON h.doc_id = p.doc_id AND h.i >= p.i + p.n GROUP BY h.doc_id""",
        inner_="SELECT doc_id, unnest(range(i + 1, i + n)) AS i FROM picked",
        carets=f"""SELECT DISTINCT word FROM (SELECT unnest({words('text')}) AS word FROM benchmark)
          WHERE len(word) >= 8 AND NOT contains(word, '^')""",
        outp="""SELECT n.doc_id, n.i, CASE WHEN p.i IS NOT NULL THEN array_to_string(l.w[n.i : n.i + p.n - 1], '')
            WHEN c.word IS NOT NULL THEN left(form, 4) || ' ' || substr(form, 5) ELSE form END AS form, q.i AS swallowed,
            p.i IS NULL AND c.word IS NOT NULL AS is_split
          FROM nxt n JOIN lists l USING (doc_id) LEFT JOIN picked p ON n.doc_id = p.doc_id AND n.i = p.i
          LEFT JOIN inner_ q ON n.doc_id = q.doc_id AND n.i = q.i LEFT JOIN carets c ON c.word = n.form""",
        agg="""SELECT doc_id, count(*) AS n_before,
            count(*) FILTER (swallowed IS NULL) + count(*) FILTER (swallowed IS NULL AND is_split) AS n_after,
          string_agg(form, ' ' ORDER BY i) FILTER (swallowed IS NULL) AS forms FROM outp GROUP BY doc_id""",
    )
    + "SELECT doc_id, coalesce(n_before, 0) AS n_before, coalesce(n_after, 0) AS n_after, coalesce(forms, '') AS forms FROM documents LEFT JOIN agg USING (doc_id)",
    "embed_corpus": """SELECT row_number() OVER (ORDER BY md5(text || chr(31) || coalesce(lang, chr(0)) || chr(31)
          || coalesce(source, chr(0)) || chr(31) || coalesce(n_chars::VARCHAR, chr(0)) || chr(31) || quality || chr(31)
          || coalesce(toxic::VARCHAR, chr(0)) || chr(31) || left(text, 2500))) - 1 AS doc_id, lang, CAST(64 AS INTEGER) AS dim
        FROM documents JOIN labels USING (doc_id) WHERE quality = 1 AND text <> ''""",
    "hash_documents": cte(
        w=f"SELECT doc_id, unnest({words('text')}) AS w FROM documents",
        s="""SELECT doc_id, CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % 64 AS slot,
          sum(CASE WHEN CAST('0x' || substr(md5(w), 9, 1) AS BIGINT) % 2 = 1 THEN -1 ELSE 1 END) AS x FROM w GROUP BY ALL""",
        n="SELECT doc_id, sqrt(sum(x * x)) AS norm FROM s GROUP BY doc_id",
    )
    + "SELECT doc_id, slot, round(x / norm, 6) AS x FROM s JOIN n USING (doc_id) WHERE x <> 0",
    "encode_documents": """SELECT doc_id, len(t) AS n_chars, len(t) - len(replace(t, ' ', '')) AS n_spaces,
      len(t) - len(replace(t, chr(10), '')) AS n_lines, len(t) - len(replace(t, 'e', '')) AS n_e
      FROM (SELECT doc_id, substr(text, 1, 2500) AS t FROM documents)""",
    "l2_normalize": cte(v=VECTORS)
    + """SELECT doc_id, CAST(generate_subscripts(vec, 1) - 1 AS BIGINT) AS pos, round(unnest(vec) / norm, 6) AS x
      FROM (SELECT *, sqrt(list_sum(list_transform(vec, lambda x: x * x))) AS norm FROM v)""",
    "knn_cosine": cte(**knn(15, "list_cosine_distance")) + "SELECT src, dst, rank, round(dist, 6) AS dist FROM near",
    "knn_euclidean": cte(**knn(10, "list_distance")) + "SELECT src, dst, rank, round(dist, 6) AS dist FROM near",
    "fuzzy_strengths": cte(**FUZZY)
    + "SELECT src, dst, round(rho, 6) AS rho, round(sigma, 4) AS sigma, round(strength, 4) AS strength FROM strength",
    "fuzzy_graph": cte(**FUZZY)
    + """SELECT least(src, dst) AS src, greatest(src, dst) AS dst,
      round(CASE WHEN count(*) > 1 THEN max(strength) + min(strength) - max(strength) * min(strength) ELSE max(strength) END, 4) AS w
      FROM strength GROUP BY 1, 2""",
    "core_distance": cte(**knn(5, "list_distance")) + "SELECT src AS id, round(dist, 6) AS core FROM near WHERE rank = 5",
    "core_distances_of_grid": cte(**knn(max(HDBSCAN_GRID["min_samples"]), "list_distance"))
    + "SELECT CAST(rank AS INTEGER) AS run, src AS id, round(dist, 6) AS core FROM near WHERE rank IN (10, 15, 20)",
    "mutual_reachability": cte(**knn(15, "list_distance"), core="SELECT src AS id, dist AS core FROM near WHERE rank = 5")
    + """SELECT DISTINCT least(src, dst) AS src, greatest(src, dst) AS dst, round(greatest(a.core, b.core, dist), 6) AS w
      FROM near JOIN core a ON a.id = src JOIN core b ON b.id = dst""",
    "minimum_spanning_forest": cte(**KRUSKAL) + "SELECT e.src AS src, e.dst AS dst, round(e.w, 6) AS w FROM tree",
    "reduce_topics": cte(
        lab=LABELS,
        v=VECTORS,
        rows="SELECT topic, vec FROM lab JOIN v USING (doc_id) WHERE topic <> -1",
        c=CENTER.format(key="topic", rows="rows"),
        nearest="SELECT a.topic AS keep, b.topic AS gone FROM c a JOIN c b ON a.topic < b.topic ORDER BY round(list_cosine_distance(a.vec, b.vec), 12), 1, 2 LIMIT 1",
        merged="SELECT doc_id, CASE WHEN topic = (SELECT gone FROM nearest) THEN (SELECT keep FROM nearest) ELSE topic END AS topic FROM lab",
        s="SELECT topic, row_number() OVER (ORDER BY count(*) DESC, min(doc_id)) - 1 AS new FROM merged WHERE topic <> -1 GROUP BY topic",
    )
    + "SELECT m.doc_id, CAST(coalesce(s.new, -1) AS INTEGER) AS topic FROM merged m LEFT JOIN s USING (topic)",
    # the closest pair of groups by mean distance, merged again and again
    "reduce_topics_to_four": "WITH RECURSIVE"
    + cte(
        lab=LABELS,
        v=VECTORS,
        rows="SELECT topic, vec FROM lab JOIN v USING (doc_id) WHERE topic <> -1",
        c=CENTER.format(key="topic", rows="rows"),
        pd="SELECT a.topic AS a, b.topic AS b, round(list_cosine_distance(a.vec, b.vec), 12) AS d FROM c a JOIN c b ON a.topic <> b.topic",
        m="SELECT 0 AS step, topic, topic AS root FROM c UNION ALL "
        "SELECT m.step + 1, m.topic, CASE WHEN m.root = x.pair.b THEN x.pair.a ELSE m.root END FROM m, ("
        "SELECT arg_min({'a': ra, 'b': rb}, (d, ra, rb)) AS pair FROM ("
        "SELECT p.root AS ra, q.root AS rb, round(avg(d), 12) AS d FROM m p JOIN m q ON p.root < q.root "
        "JOIN pd ON pd.a = p.topic AND pd.b = q.topic GROUP BY 1, 2)) x WHERE m.step < (SELECT count(*) FROM c) - 4",
        ends="SELECT topic, root FROM m WHERE step = (SELECT max(step) FROM m)",
        merged="SELECT doc_id, coalesce(root, -1) AS topic FROM lab LEFT JOIN ends USING (topic)",
        s="SELECT topic, row_number() OVER (ORDER BY count(*) DESC, min(doc_id)) - 1 AS new FROM merged WHERE topic <> -1 GROUP BY topic",
    ).removeprefix("WITH")
    + "SELECT m.doc_id, CAST(coalesce(s.new, -1) AS INTEGER) AS topic FROM merged m LEFT JOIN s USING (topic)",
    "assign_topics": cte(t=TOPICS, s="SELECT topic, row_number() OVER (ORDER BY count(*) DESC, min(doc_id)) - 1 AS new FROM t WHERE topic <> -1 GROUP BY topic")
    + "SELECT t.doc_id, CAST(coalesce(s.new, -1) AS INTEGER) AS topic FROM t LEFT JOIN s USING (topic)",
    "cluster_counts": cte(lab=LABELS, named=LABELINGS)
    + "SELECT trial_id, count(DISTINCT topic) FILTER (topic <> -1) AS n_clusters FROM named GROUP BY trial_id",
    "noise_ratio": cte(lab=LABELS, named=LABELINGS)
    + "SELECT trial_id, round(avg(CASE WHEN topic = -1 THEN 1.0 ELSE 0 END), 6) AS noise_ratio FROM named GROUP BY trial_id",
    "silhouette": cte(v=VECTORS, lab=LABELS, named="SELECT 1 AS trial_id, * FROM lab", **SILHOUETTE)
    + "SELECT round(silhouette, 6) AS silhouette FROM sil",
    "silhouette_of_trials": cte(v=VECTORS, lab=LABELS, named=LABELINGS, **SILHOUETTE)
    + "SELECT trial_id, round(silhouette, 6) AS silhouette FROM sil",
    "topic_term_counts": cte(tok=TOKENS, topics=TOPICS) + COUNTS,
    "filter_vocabulary": cte(tok=TOKENS, topics=TOPICS, counts=COUNTS) + VOCAB,
    "filter_vocabulary_by_document": cte(
        tok=TOKENS, topics=TOPICS, counts=COUNTS,
        ddf="SELECT word, count(*) AS df FROM (SELECT unnest(list_distinct(list_transform(tokens, lambda w: lower(w)))) AS word FROM tok) GROUP BY word",
    )
    + "SELECT topic, word, n FROM counts JOIN ddf USING (word) WHERE df >= 0.01 * (SELECT count(*) FROM tok) AND df <= 0.5 * (SELECT count(*) FROM tok)",
    "ctfidf": cte(**SCORING) + "SELECT topic, word, n, round(tf, 6) AS tf, round(idf, 6) AS idf, round(score, 6) AS score FROM scores",
    "top_words": cte(**TOPPED) + "SELECT topic, rank, word, round(score, 6) AS score FROM topped",
    "representative_docs": cte(**SCORING, **REPS)
    + "SELECT topic, rank, doc_id, round(similarity, 6) AS similarity FROM reps WHERE rank <= 3",
    "keybert_words": cte(**WORD_VECTORS) + "SELECT topic, rank, word, round(score, 6) AS score FROM keybert",
    "represent_parallel": cte(**WORD_VECTORS)
    + """SELECT topic, 'Main' AS aspect, rank, word, round(score, 6) AS score FROM candidates WHERE rank <= 10
      UNION ALL SELECT topic, 'KeyBERT', rank, word, round(score, 6) FROM keybert
      UNION ALL SELECT * FROM (SELECT topic, 'Longest', row_number() OVER (PARTITION BY topic ORDER BY len(word) DESC, word) AS rank,
        word, CAST(len(word) AS DOUBLE) FROM candidates) WHERE rank <= 5""",
    "mmr_words": cte_recursive(**WORD_VECTORS, **mmr("SELECT * FROM candidates", 30)) + MMR_RESULT,
    "represent_chained": cte_recursive(
        **WORD_VECTORS,
        twenty=WORD_VECTORS["keybert"].replace("rank <= 10", "rank <= 20"),
        **mmr("SELECT * FROM twenty", 30),
    )
    + MMR_RESULT,
    "label_prompts": cte(**TOPPED, **REPS)
    + """SELECT k.topic, coalesce(d.docs, '') || 'Words: ' || k.words AS prompt FROM
      (SELECT topic, string_agg(word, ', ' ORDER BY rank) AS words FROM topped WHERE topic <> -1 GROUP BY topic) k LEFT JOIN
      (SELECT topic, string_agg('- ' || text || chr(10), '' ORDER BY rank) AS docs FROM reps JOIN documents USING (doc_id)
       WHERE rank <= 4 GROUP BY topic) d USING (topic)""",
    "topic_info": cte(**TOPPED)
    + """SELECT t.topic, t.n, concat_ws('_', CAST(t.topic AS VARCHAR), w.first) AS name, w.words
      FROM (SELECT topic, count(*) AS n FROM topics GROUP BY topic) t LEFT JOIN
      (SELECT topic, string_agg(word, ' ' ORDER BY rank) AS words,
        string_agg(word, '_' ORDER BY rank) FILTER (rank <= 4) AS first FROM topped GROUP BY topic) w USING (topic)""",
    "topic_info_preview": cte(topics=TOPICS) + "SELECT topic, count(*) AS n FROM topics GROUP BY topic ORDER BY topic LIMIT 10",
    "doc_topics_table": cte(topics=TOPICS) + "SELECT d.*, t.topic FROM documents d JOIN topics t USING (doc_id)",
    "run_summary": cte(t=TOPICS)
    + """SELECT count(*) AS n_documents, count(DISTINCT topic) FILTER (topic <> -1) AS n_topics,
      count(*) FILTER (topic = -1) AS n_outliers, round(avg(CASE WHEN topic = -1 THEN 100.0 ELSE 0 END), 1) AS pct_outliers FROM t""",
    "topic_diversity": cte(**TOPPED)
    + "SELECT round(count(DISTINCT word) / CAST(count(*) AS DOUBLE), 6) AS diversity FROM topped WHERE topic <> -1",
    "topic_diversity_aspects": cte(**TOPPED)
    + "SELECT round(count(DISTINCT word) / CAST(count(*) AS DOUBLE), 6) AS diversity FROM topped WHERE topic <> -1",
    "topic_coherence": cte(
        **TOPPED,
        **{k: MEASURED[k] for k in ("sets", "ndocs", "wdf")},
        tw="SELECT 0 AS trial_id, topic, rank, word FROM topped WHERE topic <> -1",
        **{k: MEASURED[k] for k in ("co", "pmi", "coh")},
    )
    + "SELECT round(coherence, 6) AS coherence FROM coh",
    "trial_metrics": cte(**MEASURED)
    + "SELECT trial_id, n_clusters, " + ", ".join(f"round({m}, 6) AS {m}" for m in ("noise_ratio", "silhouette", "diversity", "coherence")) + " FROM metrics",
    "composite_score": cte(**MEASURED) + "SELECT trial_id, round(composite, 6) AS composite FROM metrics",
    "rank_trials": cte(**MEASURED)
    + f"SELECT trial_id, n_clusters, round(noise_ratio, 4) AS noise_ratio, round(diversity, 4) AS diversity, round(composite, 4) AS composite FROM metrics {RANKED}",
    "best_trial": cte(**MEASURED)
    + f"SELECT trial_id, n_clusters, round(composite, 4) AS composite FROM metrics {RANKED} LIMIT 1",
}
