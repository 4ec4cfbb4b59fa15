"""Oracle SQL (DuckDB) per registered query key.

Written independently of the Spark plans: per-term formulas of the model,
dense topics x documents for rankings, plain GROUP BYs for the index.
"""

from __future__ import annotations

from quire.functions.text import BLANK_CLASS, FULLWIDTH_MARKS, WORD_PATTERN
from quire.plans import oracle as O
from quire.plans.queries import K, LATIN_CONCEPT_DELIMITER, TOPK_K

CTRL = O.CTRL
IDX = O.index_ctes("word")
TOP = O.topic_ctes("word")
CONV = O.topic_ctes("word", src="conversations", id_expr="conv_id",
                    field_expr="CAST(turn AS VARCHAR)",
                    ids_sql="SELECT DISTINCT conv_id AS topic_id FROM conversations")
MATCH_KEYS = "qtf.n = post.n AND qtf.t1 = post.t1 AND qtf.t2 = post.t2"


def _ranked(scores: str, k: int) -> str:
    """Top ``k`` of all documents per topic by ``scores(topic_id, doc_id, score)``,
    0 where there is none."""
    return f"""SELECT topic_id, doc_id, score, rank::INTEGER AS rank FROM (
  SELECT t.topic_id, d.doc_id, coalesce(sc.score, 0) AS score,
         row_number() OVER (PARTITION BY t.topic_id ORDER BY coalesce(sc.score, 0) DESC, d.doc_id) AS rank
  FROM tids t CROSS JOIN documents d LEFT JOIN ({scores}) sc ON sc.topic_id = t.topic_id AND sc.doc_id = d.doc_id)
WHERE rank <= {k}"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


# per matched (topic, term, document): the model's W5 * W6, unmixed
MT = """
mt AS (
  SELECT qtf.topic_id, post.doc_id, post.n, post.t1, post.t2, qtf.qtf, post.tf, qdfs.qdf, dfs.df, dlen.dl,
         (qtf.qtf / (0.3 + 0.7 * dlen.dl / corpus.avgdl)) * log2(qc.q / qdfs.qdf)
       * (post.tf / (0.3 + 0.7 * dlen.dl / corpus.avgdl)) * log2(corpus.n_docs / dfs.df) AS w
  FROM qtf JOIN post ON qtf.n = post.n AND qtf.t1 = post.t1 AND qtf.t2 = post.t2
  JOIN qdfs ON qtf.n = qdfs.n AND qtf.t1 = qdfs.t1 AND qtf.t2 = qdfs.t2
  JOIN dfs ON qtf.n = dfs.n AND qtf.t1 = dfs.t1 AND qtf.t2 = dfs.t2
  JOIN dlen ON post.doc_id = dlen.doc_id CROSS JOIN qc CROSS JOIN corpus)"""

FUSED = "0.2::DOUBLE * sum(CASE WHEN n = 1 THEN w ELSE 0 END) + 0.8::DOUBLE * sum(CASE WHEN n = 2 THEN w ELSE 0 END)"

# first pass top 5 (dense) and the feedback terms
FBT = """
dense AS (
  SELECT t.topic_id, d.doc_id,
         round(coalesce(0.2::DOUBLE * sum(CASE WHEN mt.n = 1 THEN mt.w ELSE 0 END)
                      + 0.8::DOUBLE * sum(CASE WHEN mt.n = 2 THEN mt.w ELSE 0 END), 0), 6) AS score
  FROM tids t CROSS JOIN documents d
  LEFT JOIN mt ON mt.topic_id = t.topic_id AND mt.doc_id = d.doc_id
  GROUP BY t.topic_id, d.doc_id),
ranked AS (
  SELECT topic_id, doc_id, score,
         row_number() OVER (PARTITION BY topic_id ORDER BY score DESC, doc_id) AS rank FROM dense),
fbt AS (
  SELECT DISTINCT mt.topic_id, mt.n, mt.t1, mt.t2 FROM mt
  JOIN ranked r ON r.topic_id = mt.topic_id AND r.doc_id = mt.doc_id AND r.rank <= 5)"""


def _dense_rank(k: int) -> str:
    return _with(IDX, TOP, MT, FBT) + \
        f"SELECT topic_id, doc_id, score, rank::INTEGER AS rank FROM ranked WHERE rank <= {k}"


# legacy: sum over query terms (with repeats) of tf * idf^2, truncated unigram idf
LEGACY = """
lt AS (
  SELECT qtf.topic_id, post.doc_id,
         CASE WHEN post.n = 1 THEN 0.8::DOUBLE * qtf.qtf * post.tf * pow(log2((corpus.n_docs // dfs.df)::DOUBLE), 2)
              ELSE 0.2::DOUBLE * qtf.qtf * post.tf * pow(log2(corpus.n_docs / dfs.df), 2) END AS w
  FROM qtf JOIN post ON qtf.n = post.n AND qtf.t1 = post.t1 AND qtf.t2 = post.t2
  JOIN dfs ON qtf.n = dfs.n AND qtf.t1 = dfs.t1 AND qtf.t2 = dfs.t2 CROSS JOIN corpus)"""

VOCAB = """
vocab AS (SELECT t1 AS term, row_number() OVER (ORDER BY t1) AS term_id FROM dfs WHERE n = 1 AND df >= 2),
btok AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '""" + WORD_PATTERN + """') AS s FROM benchmark),
bpos AS (SELECT item_id, s, unnest(range(0, len(s))) AS pos FROM btok),
lk AS (SELECT bpos.item_id, bpos.pos, coalesce(vocab.term_id, 0) AS term_id
       FROM bpos LEFT JOIN vocab ON vocab.term = bpos.s[bpos.pos + 1])"""

def _id_ctes(p: str, src: str, id_col: str) -> str:
    """{p}post(id, n, t1, t2, tf) over vocabulary ids; unknown words break bigrams."""
    return f"""
{p}tok AS (SELECT {id_col} AS id, regexp_extract_all(lower(coalesce(text, '')), '{WORD_PATTERN}') AS s FROM {src}),
{p}at AS (SELECT id, s, unnest(range(1, len(s) + 1)) AS i FROM {p}tok),
{p}id AS (SELECT a.id, a.i, coalesce(v.term_id, 0) AS t, coalesce(w.term_id, 0) AS u
          FROM {p}at a LEFT JOIN vocab v ON v.term = a.s[a.i] LEFT JOIN vocab w ON w.term = a.s[a.i + 1]),
{p}post AS (SELECT id, n, t1, t2, count(*) AS tf FROM (
  SELECT id, 1 AS n, t AS t1, -1 AS t2 FROM {p}id WHERE t > 0
  UNION ALL SELECT id, 2, t, u FROM {p}id WHERE t > 0 AND u > 0) GROUP BY id, n, t1, t2)"""


ID_INDEX = f"""vw AS (SELECT doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '{WORD_PATTERN}')) AS term FROM documents),
vocab AS (SELECT term, row_number() OVER (ORDER BY term) AS term_id
          FROM (SELECT term FROM vw GROUP BY term HAVING count(DISTINCT doc_id) >= 2)),""" + _id_ctes("d", "documents", "doc_id") + """,
post AS (SELECT n, t1, t2, id AS doc_id, tf FROM dpost),
dfs AS (SELECT n, t1, t2, count(*) AS df FROM post GROUP BY n, t1, t2),
dlen AS (SELECT d.doc_id, coalesce(u.dl, 0) AS dl FROM documents d
         LEFT JOIN (SELECT doc_id, sum(tf)::BIGINT AS dl FROM post WHERE n = 1 GROUP BY doc_id) u ON d.doc_id = u.doc_id),
corpus AS (SELECT count(*) AS n_docs, sum(dl)::BIGINT // count(*) AS avgdl FROM dlen)"""

ID_TOPICS = _id_ctes("q", "benchmark", "item_id") + """,
tids AS (SELECT DISTINCT item_id AS topic_id FROM benchmark),
qtf AS (SELECT id AS topic_id, n, t1, t2, tf AS qtf FROM qpost),
qdfs AS (SELECT n, t1, t2, count(*) AS qdf FROM qtf GROUP BY n, t1, t2),
qc AS (SELECT count(*) AS q FROM tids)"""


def _marked(expr: str) -> str:
    """The six marks put after words, as the query's stand-in input does."""
    for mark, letter in zip(FULLWIDTH_MARKS, "aeinst"):
        expr = f"replace({expr}, '{letter} ', '{letter}{mark} ')"
    return expr


NRM = """
nrm AS (
  SELECT post.doc_id, post.n, sqrt(sum(pow(post.tf * log2((corpus.n_docs // dfs.df)::DOUBLE), 2))) AS l2
  FROM post JOIN dfs ON post.n = dfs.n AND post.t1 = dfs.t1 AND post.t2 = dfs.t2 CROSS JOIN corpus
  GROUP BY post.doc_id, post.n)"""


def _doc_norm(n: int) -> str:
    return _with(IDX, NRM) + f"""SELECT d.doc_id, round(coalesce(nrm.l2, 0), 6) AS l2
FROM dlen d LEFT JOIN nrm ON nrm.doc_id = d.doc_id AND nrm.n = {n}"""


def _clean(expr: str) -> str:
    return f"translate(translate({expr}, '{FULLWIDTH_MARKS}', ''), {CTRL}, '')"


def _decode(expr: str) -> str:
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "''"), ("&amp;", "&")):
        expr = f"replace({expr}, '{ent}', '{ch}')"
    return expr


REAL_LEN = f"""
WITH b AS (
  SELECT page_id, html,
         regexp_replace(regexp_replace(html, '(?is)<script\\b[^>]*>.*?</script>', '', 'g'),
                        '(?is)<style\\b[^>]*>.*?</style>', '', 'g') AS body
  FROM pages),
pieces AS (SELECT page_id, unnest(string_split_regex(body, '(?i)<p\\b')[2:]) AS piece FROM b),
paras AS (
  SELECT page_id, {_decode("regexp_replace(regexp_extract(piece, '(?is)^[^>]*>(.*?)</p>', 1), '<[^>]*>', '', 'g')")} AS p
  FROM pieces WHERE strpos(lower(piece), '</p>') > 0),
tl AS (SELECT page_id, sum(length({_clean('p')}))::BIGINT AS text_len FROM paras GROUP BY page_id),
tt AS (
  SELECT page_id, CASE WHEN regexp_matches(html, '(?is)<title\\b[^>]*>.*?</title>')
         THEN length({_clean(_decode("regexp_replace(regexp_extract(html, '(?is)<title\\b[^>]*>(.*?)</title>', 1), '<[^>]*>', '', 'g')"))})
         ELSE 0 END::BIGINT AS title_len
  FROM pages)
SELECT tt.page_id, tt.title_len, coalesce(tl.text_len, 0)::BIGINT AS text_len,
       (tt.title_len + coalesce(tl.text_len, 0))::BIGINT AS doc_len
FROM tt LEFT JOIN tl ON tl.page_id = tt.page_id"""

CONCEPTS = O.topic_ctes(
    "word",
    src=f"(SELECT item_id, unnest(string_split(translate(text, {CTRL}, ''), '{LATIN_CONCEPT_DELIMITER}')) AS c, "
        f"unnest(range(1, len(string_split(translate(text, {CTRL}, ''), '{LATIN_CONCEPT_DELIMITER}')) + 1)) AS k "
        f"FROM benchmark) cs",
    id_expr="item_id", text_expr="c", field_expr="CAST(k AS VARCHAR)")

LABEL = _with(IDX, TOP, MT, FBT) + f"""
SELECT right(regexp_replace(lpad(CAST(r.topic_id AS VARCHAR), 3, '0'), '^{BLANK_CLASS}+|{BLANK_CLASS}+$', '', 'g'), 3) AS topic_no,
       r.rank::INTEGER AS rank,
       lower(string_split(concat_ws('/', d.source, CAST(d.doc_id AS VARCHAR)), '/')[-1]) AS doc_key
FROM ranked r JOIN documents d ON d.doc_id = r.doc_id WHERE r.rank <= {K}"""


JUDGED = "SELECT DISTINCT b.item_id AS topic_id, d.doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text)"
CUTOFF = 10

ORACLES: dict[str, str] = {
    "strip_control": f"SELECT doc_id, translate(text, {CTRL}, '') AS clean FROM documents",
    "strip_punct": f"SELECT doc_id, translate({_marked('text')}, '{FULLWIDTH_MARKS}', '') AS clean FROM documents",
    "char_unigrams": """SELECT item_id, c AS term, count(*) AS tf
FROM (SELECT item_id, unnest(string_split(text, '')) AS c FROM benchmark) WHERE c <> '' GROUP BY item_id, c""",
    "char_bigrams": """WITH s AS (SELECT item_id, list_filter(string_split(text, ''), lambda x: x <> '') AS s FROM benchmark),
p AS (SELECT item_id, s, unnest(range(1, len(s))) AS i FROM s)
SELECT item_id, s[i] AS t1, s[i + 1] AS t2, count(*) AS tf FROM p GROUP BY item_id, s[i], s[i + 1]""",
    "vocab_lookup": _with(IDX, VOCAB) + "SELECT item_id, pos::INTEGER AS pos, term_id::INTEGER AS term_id FROM lk",
    "vocab_unigrams": _with(IDX, VOCAB) + "SELECT item_id, pos::INTEGER AS pos, term_id::INTEGER AS term_id FROM lk WHERE term_id > 0",
    "vocab_bigrams": _with(IDX, VOCAB) + """SELECT a.item_id, a.pos::INTEGER AS pos, a.term_id::INTEGER AS t1, b.term_id::INTEGER AS t2
FROM lk a JOIN lk b ON a.item_id = b.item_id AND b.pos = a.pos + 1 WHERE a.term_id > 0 AND b.term_id > 0""",
    "topic_fields": _with(CONV) + "SELECT id AS topic_id, field, n, t1, t2, count(*) AS tf FROM qgram GROUP BY id, field, n, t1, t2",
    "concept_split": _with(CONCEPTS) + "SELECT topic_id, n, t1, t2, qtf AS tf FROM qtf",
    "topic_bag": _with(CONV) + "SELECT topic_id, n, t1, t2, qtf FROM qtf",
    "topic_number": f"SELECT page_id, right(regexp_replace(url, '^{BLANK_CLASS}+|{BLANK_CLASS}+$', '', 'g'), 3) AS topic_no FROM pages",
    "doc_key": "SELECT page_id, lower(string_split(url, '/')[-1]) AS doc_key FROM pages",
    "real_doc_len": REAL_LEN,
    "postings_unigram": _with(IDX) + "SELECT t1, doc_id, tf FROM post WHERE n = 1",
    "postings_bigram": _with(IDX) + "SELECT t1, t2, doc_id, tf FROM post WHERE n = 2",
    "doc_freq": _with(IDX) + "SELECT n, t1, t2, df FROM dfs",
    "doc_length": _with(IDX) + "SELECT doc_id, dl FROM dlen",
    "avg_doc_length": _with(IDX) + "SELECT avgdl FROM corpus",
    "doc_count": _with(IDX) + "SELECT n_docs FROM corpus",
    "bigram_vocab": _with(IDX) + "SELECT DISTINCT t1, t2 FROM post WHERE n = 2",
    "doc_norm_unigram": _doc_norm(1),
    "doc_norm_bigram": _doc_norm(2),
    "topic_tf": _with(TOP) + "SELECT topic_id, n, t1, t2, qtf FROM qtf",
    "topic_doc_freq": _with(TOP) + "SELECT n, t1, t2, qdf FROM qdfs",
    "topic_count": _with(TOP) + "SELECT q AS n_topics FROM qc",
    "idf": _with(IDX) + "SELECT n, t1, t2, round(log2(corpus.n_docs / df), 6) AS idf FROM dfs CROSS JOIN corpus",
    "idf_truncated": _with(IDX) + "SELECT n, t1, t2, round(log2((corpus.n_docs // df)::DOUBLE), 6) AS idf FROM dfs CROSS JOIN corpus",
    "tfidf": _with(IDX) + """SELECT post.n, post.t1, post.t2, post.doc_id, round(post.tf * log2(corpus.n_docs / dfs.df), 6) AS tfidf
FROM post JOIN dfs ON post.n = dfs.n AND post.t1 = dfs.t1 AND post.t2 = dfs.t2 CROSS JOIN corpus""",
    "length_norm": _with(IDX) + "SELECT doc_id, round(0.3 + 0.7 * dl / corpus.avgdl, 6) AS norm FROM dlen CROSS JOIN corpus",
    "topic_weight": _with(IDX, TOP, MT) + """SELECT mt.topic_id, mt.n, mt.t1, mt.t2, mt.doc_id,
       round(mt.qtf / (0.3 + 0.7 * mt.dl / corpus.avgdl) * log2(qc.q / mt.qdf), 6) AS weight
FROM mt CROSS JOIN corpus CROSS JOIN qc""",
    "doc_weight": _with(IDX) + """SELECT post.n, post.t1, post.t2, post.doc_id,
       round(post.tf / (0.3 + 0.7 * dlen.dl / corpus.avgdl) * log2(corpus.n_docs / dfs.df), 6) AS weight
FROM post JOIN dfs ON post.n = dfs.n AND post.t1 = dfs.t1 AND post.t2 = dfs.t2
JOIN dlen ON dlen.doc_id = post.doc_id CROSS JOIN corpus""",
    "match_unigram": _with(IDX, TOP) + f"""SELECT qtf.topic_id, qtf.t1, post.doc_id, qtf.qtf, post.tf
FROM qtf JOIN post ON {MATCH_KEYS} WHERE qtf.n = 1""",
    "match_bigram": _with(IDX, TOP) + f"""SELECT qtf.topic_id, qtf.t1, qtf.t2, post.doc_id, qtf.qtf, post.tf
FROM qtf JOIN post ON {MATCH_KEYS} WHERE qtf.n = 2""",
    "score_unigram": _with(IDX, TOP, MT) + _ranked("SELECT topic_id, doc_id, round(sum(w), 6) AS score FROM mt WHERE n = 1 GROUP BY topic_id, doc_id", TOPK_K),
    "score_bigram": _with(IDX, TOP, MT) + _ranked("SELECT topic_id, doc_id, round(sum(w), 6) AS score FROM mt WHERE n = 2 GROUP BY topic_id, doc_id", TOPK_K),
    "score_fused": _with(IDX, TOP, MT) + _ranked(f"SELECT topic_id, doc_id, round({FUSED}, 6) AS score FROM mt GROUP BY topic_id, doc_id", K),
    "topk": _dense_rank(TOPK_K),
    "feedback_docs": _dense_rank(5),
    "feedback_terms_unigram": _with(IDX, TOP, MT, FBT) + "SELECT topic_id, t1 FROM fbt WHERE n = 1",
    "feedback_terms_bigram": _with(IDX, TOP, MT, FBT) + "SELECT topic_id, t1, t2 FROM fbt WHERE n = 2",
    "score_feedback": _with(IDX, TOP, MT, FBT) + _ranked(f"""SELECT topic_id, doc_id, round({FUSED}, 6) AS score FROM (
  SELECT mt.topic_id, mt.doc_id, mt.n, mt.w * CASE WHEN fbt.topic_id IS NULL THEN 1.0 ELSE 2.0 END AS w
  FROM mt LEFT JOIN fbt ON fbt.topic_id = mt.topic_id AND fbt.n = mt.n AND fbt.t1 = mt.t1 AND fbt.t2 = mt.t2)
GROUP BY topic_id, doc_id""", K),
    "search": O.dense_vsm_sql("word", K),
    "search_feedback": O.dense_vsm_sql("word", K, feedback=True),
    "search_char": O.dense_vsm_sql("char", K, topics=O.topic_ctes("char")),
    "search_conversations": O.dense_vsm_sql("word", K, topics=CONV),
    "search_vocab_ids": O.dense_vsm_sql(k=K, index=ID_INDEX, topics=ID_TOPICS),
    "search_legacy": _with(IDX, TOP, LEGACY) + f"""SELECT topic_id, doc_id, score, rank::INTEGER AS rank FROM (
  SELECT topic_id, doc_id, score, row_number() OVER (PARTITION BY topic_id ORDER BY score DESC, doc_id) AS rank
  FROM (SELECT t.topic_id, d.doc_id, round(coalesce(sum(lt.w), 0), 6) AS score
        FROM tids t CROSS JOIN documents d LEFT JOIN lt ON lt.topic_id = t.topic_id AND lt.doc_id = d.doc_id
        GROUP BY t.topic_id, d.doc_id)) WHERE rank <= {K}""",
    "score_legacy": _with(IDX, TOP, LEGACY) + _ranked("SELECT topic_id, doc_id, round(sum(w), 6) AS score FROM lt GROUP BY topic_id, doc_id", TOPK_K),
    "cosine_unigram": _with(IDX, TOP, NRM) + f"""SELECT topic_id, doc_id, score, rank::INTEGER AS rank FROM (
SELECT *, row_number() OVER (PARTITION BY topic_id ORDER BY score DESC, doc_id) AS rank FROM (
SELECT s.topic_id, s.doc_id, round(s.num / nrm.l2, 6) AS score FROM (
  SELECT qtf.topic_id, post.doc_id,
         sum(qtf.qtf * log2((corpus.n_docs // dfs.df)::DOUBLE) * post.tf * log2((corpus.n_docs // dfs.df)::DOUBLE)) AS num
  FROM qtf JOIN post ON qtf.n = post.n AND qtf.t1 = post.t1 AND qtf.t2 = post.t2
  JOIN dfs ON qtf.n = dfs.n AND qtf.t1 = dfs.t1 AND qtf.t2 = dfs.t2 CROSS JOIN corpus
  WHERE qtf.n = 1 GROUP BY qtf.topic_id, post.doc_id) s
JOIN nrm ON nrm.doc_id = s.doc_id AND nrm.n = 1 WHERE nrm.l2 > 0)) WHERE rank <= {K}""",
    "label_run": LABEL,
    "judgments": JUDGED,
    "eval_map": f"""WITH run AS ({O.dense_vsm_sql("word", K)}), judged AS ({JUDGED}),
each AS (SELECT j.topic_id, count(*) AS relevant, count(*) FILTER (r.rank <= {CUTOFF}) AS found,
           coalesce(sum((SELECT count(*) FROM run o JOIN judged p ON o.topic_id = p.topic_id AND o.doc_id = p.doc_id
                         WHERE o.topic_id = r.topic_id AND o.rank <= r.rank) / r.rank::DOUBLE), 0) / count(*) AS ap
         FROM judged j LEFT JOIN run r ON r.topic_id = j.topic_id AND r.doc_id = j.doc_id GROUP BY j.topic_id)
SELECT topic_id, relevant, found, round(found / {CUTOFF}, 6) AS precision, round(found / relevant, 6) AS recall,
       round(ap, 6) AS average_precision, round(avg(ap) OVER (), 6) AS mean_average_precision FROM each""",
}

# ---- file formats: what reading back must give -------------------------------

NUMBERED = "row_number() OVER (ORDER BY doc_id) - 1"
RUN_LINES = f"""WITH run AS ({ORACLES["search"]}),
lines AS (SELECT lpad(r.topic_id::VARCHAR, 3, '0') AS topic_no, r.doc_id::VARCHAR AS doc_key, row_number() OVER (ORDER BY r.topic_id, r.rank) - 1 AS line FROM run r)
"""

ORACLES |= {
    "read_vocab": f"WITH {ID_INDEX} SELECT term, term_id::INTEGER AS term_id FROM vocab",
    "read_file_list": f"SELECT {NUMBERED} AS doc_id, concat_ws('/', source, doc_id::VARCHAR) AS path FROM documents",
    "read_doc_lengths": f"SELECT {NUMBERED} AS doc_id, n_chars::INTEGER AS doc_len FROM documents",
    "read_inverted_file": f"WITH {ID_INDEX}, {ID_TOPICS} SELECT n::INTEGER AS n, t1::INTEGER AS t1, t2::INTEGER AS t2, topic_id AS doc_id, qtf AS tf, "
                          "count(*) OVER (PARTITION BY n, t1, t2) AS df FROM qtf",
    "read_topics": """SELECT row_number() OVER (ORDER BY item_id) - 1 AS topic_pos, right(lpad(item_id::VARCHAR, 3, '0'), 3) AS topic_no,
       length(regexp_replace(text, '[\r\n]+', ' ', 'g')) AS title_len, item_id::VARCHAR AS question FROM benchmark""",
    "read_doc_xml": """SELECT doc_id, len(string_split(text, chr(10)))::INTEGER AS n_paragraphs,
       sum_chars AS n_chars FROM (SELECT doc_id, text, length(translate(text, chr(10) || chr(13) || chr(9), '')) AS sum_chars FROM documents)""",
    "read_qrels": f"SELECT lpad(topic_id::VARCHAR, 3, '0') AS topic_no, doc_id::VARCHAR AS doc_key FROM ({JUDGED})",
    "read_topic_terms": f"WITH {ID_INDEX}, {ID_TOPICS} SELECT dense_rank() OVER (ORDER BY topic_id) - 1 AS topic_id, n::INTEGER AS n, t1::INTEGER AS t1, "
                        "t2::INTEGER AS t2, qtf FROM qtf",
    "write_run": RUN_LINES + "SELECT 2 * line AS at, topic_no AS token FROM lines UNION ALL SELECT 2 * line + 1, doc_key FROM lines",
    "label_rank_file": ORACLES["label_run"],
    "doc_path": "SELECT doc_id, '/data/coll/' || concat_ws('/', source, doc_id::VARCHAR) AS path FROM documents",
    "search_saved_index": ORACLES["search"],
}
