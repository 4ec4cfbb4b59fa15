"""Independent DuckDB SQL for every registered query.

The oracle is written *densely* and per the model's formulas (topics x
documents, per-term division by the length norm), so it shares neither the
sparse rewrite nor the zero fill of the Spark plans. Tokenizing uses the
same patterns (RE2 and Java regex agree on these classes).
"""

from __future__ import annotations

from quire.functions.text import BLANK_CLASS, FULLWIDTH_MARKS, WORD_PATTERN

K = 100  # ranked documents per topic in the registered queries
FB = 5   # feedback documents

CTRL = "chr(10) || chr(13) || chr(9)"


def _clean(expr: str, marks: str = FULLWIDTH_MARKS) -> str:
    return f"translate(translate({expr}, '{marks}', ''), {CTRL}, '')"


def _seq(expr: str, profile: str) -> str:
    """Item list of a text expression, as the Spark profile builds it."""
    if profile == "word":
        return f"regexp_extract_all(lower(coalesce({expr}, '')), '{WORD_PATTERN}')"
    cleaned = _clean("coalesce(" + expr + ", '')")
    folded = f"regexp_replace({cleaned}, '{BLANK_CLASS}', ' ', 'g')"
    return f"list_filter(string_split({folded}, ''), lambda x: x <> '')"


def gram_ctes(profile: str, prefix: str, src: str, id_expr: str, text_expr: str,
              field_expr: str = "'0'") -> str:
    """CTEs ``{p}seq(id, field, s)`` and ``{p}gram(id, field, n, t1, t2)``."""
    p = prefix
    return f"""
{p}seq AS (SELECT {id_expr} AS id, {field_expr} AS field, {_seq(text_expr, profile)} AS s FROM {src}),
{p}pos AS (SELECT id, field, s, unnest(range(1, len(s) + 1)) AS i FROM {p}seq),
{p}gram AS (
  SELECT id, field, 1 AS n, s[i] AS t1, '' AS t2 FROM {p}pos WHERE s[i] <> ' '
  UNION ALL
  SELECT id, field, 2 AS n, s[i] AS t1, s[i + 1] AS t2 FROM {p}pos
  WHERE i < len(s) AND s[i] <> ' ' AND s[i + 1] <> ' ')"""


def index_ctes(profile: str) -> str:
    """Document side: dgram, post(n,t1,t2,doc_id,tf), dfs(n,t1,t2,df),
    dlen(doc_id, dl), corpus(n_docs, avgdl)."""
    return gram_ctes(profile, "d", "documents", "doc_id", "text") + """,
post AS (SELECT n, t1, t2, id AS doc_id, count(*) AS tf FROM dgram GROUP BY n, t1, t2, id),
dfs AS (SELECT n, t1, t2, count(*) AS df FROM post GROUP BY n, t1, t2),
dlen AS (SELECT d.doc_id, coalesce(u.dl, 0) AS dl FROM documents d
         LEFT JOIN (SELECT doc_id, sum(tf)::BIGINT AS dl FROM post WHERE n = 1 GROUP BY doc_id) u
         ON d.doc_id = u.doc_id),
corpus AS (SELECT count(*) AS n_docs, CASE WHEN count(*) > 0 THEN sum(dl)::BIGINT // count(*) END AS avgdl
           FROM dlen)"""


def topic_ctes(profile: str, src: str = "benchmark", id_expr: str = "item_id",
               text_expr: str = "text", field_expr: str = "'0'",
               ids_sql: str = "SELECT DISTINCT item_id AS topic_id FROM benchmark") -> str:
    """Topic side: qgram, qtf(topic_id,n,t1,t2,qtf), qdfs(n,t1,t2,qdf), qc(q), tids."""
    return gram_ctes(profile, "q", src, id_expr, text_expr, field_expr) + f""",
tids AS ({ids_sql}),
qtf AS (SELECT id AS topic_id, n, t1, t2, count(*) AS qtf FROM qgram GROUP BY id, n, t1, t2),
qdfs AS (SELECT n, t1, t2, count(*) AS qdf FROM qtf GROUP BY n, t1, t2),
qc AS (SELECT count(*) AS q FROM tids)"""


def dense_vsm_sql(profile: str = "word", k: int = K, feedback: bool = False,
                  topics: str | None = None, index: str | None = None) -> str:
    """Dense reference formula: every topic x every document."""
    tctes = topics or topic_ctes(profile)
    ictes = index or index_ctes(profile)
    per_term = """
    (qtf.qtf / (0.3 + 0.7 * dlen.dl / corpus.avgdl)) * log2(qc.q / qdfs.qdf)
  * (post.tf / (0.3 + 0.7 * dlen.dl / corpus.avgdl)) * log2(corpus.n_docs / dfs.df)"""
    terms = f"""
mt AS (
  SELECT qtf.topic_id, post.doc_id, post.n, post.t1, post.t2, {per_term} AS w
  FROM qtf JOIN post ON qtf.n = post.n AND qtf.t1 = post.t1 AND qtf.t2 = post.t2
  JOIN qdfs ON qtf.n = qdfs.n AND qtf.t1 = qdfs.t1 AND qtf.t2 = qdfs.t2
  JOIN dfs ON qtf.n = dfs.n AND qtf.t1 = dfs.t1 AND qtf.t2 = dfs.t2
  JOIN dlen ON post.doc_id = dlen.doc_id CROSS JOIN qc CROSS JOIN corpus)"""
    dense = """
dense AS (
  SELECT t.topic_id, d.doc_id,
         round(coalesce(0.2::DOUBLE * sum(CASE WHEN mt.n = 1 THEN mt.w ELSE 0 END)
                      + 0.8::DOUBLE * sum(CASE WHEN mt.n = 2 THEN mt.w ELSE 0 END), 0), 6) AS score
  FROM tids t CROSS JOIN documents d
  LEFT JOIN mt ON mt.topic_id = t.topic_id AND mt.doc_id = d.doc_id
  GROUP BY t.topic_id, d.doc_id),
ranked AS (
  SELECT topic_id, doc_id, score,
         row_number() OVER (PARTITION BY topic_id ORDER BY score DESC, doc_id) AS rank
  FROM dense)"""
    if not feedback:
        return f"WITH {ictes},{tctes},{terms},{dense}\n" \
               f"SELECT topic_id, doc_id, score, rank::INTEGER AS rank FROM ranked WHERE rank <= {k}"
    fb = f"""
fbt AS (
  SELECT DISTINCT mt.topic_id, mt.n, mt.t1, mt.t2 FROM mt
  JOIN ranked r ON r.topic_id = mt.topic_id AND r.doc_id = mt.doc_id AND r.rank <= {FB}),
mt2 AS (
  SELECT mt.topic_id, mt.doc_id, mt.n,
         mt.w * CASE WHEN fbt.topic_id IS NULL THEN 1.0 ELSE 2.0 END AS w
  FROM mt LEFT JOIN fbt ON fbt.topic_id = mt.topic_id AND fbt.n = mt.n
                       AND fbt.t1 = mt.t1 AND fbt.t2 = mt.t2),
dense2 AS (
  SELECT t.topic_id, d.doc_id,
         round(coalesce(0.2::DOUBLE * sum(CASE WHEN mt2.n = 1 THEN mt2.w ELSE 0 END)
                      + 0.8::DOUBLE * sum(CASE WHEN mt2.n = 2 THEN mt2.w ELSE 0 END), 0), 6) AS score
  FROM tids t CROSS JOIN documents d
  LEFT JOIN mt2 ON mt2.topic_id = t.topic_id AND mt2.doc_id = d.doc_id
  GROUP BY t.topic_id, d.doc_id),
ranked2 AS (
  SELECT topic_id, doc_id, score,
         row_number() OVER (PARTITION BY topic_id ORDER BY score DESC, doc_id) AS rank
  FROM dense2)"""
    return f"WITH {ictes},{tctes},{terms},{dense},{fb}\n" \
           f"SELECT topic_id, doc_id, score, rank::INTEGER AS rank FROM ranked2 WHERE rank <= {k}"
