"""DuckDB statements giving the same results as the registered queries.

Shared with the engine are fixed values only: the word pattern, the stop words, the weights and
constants of the formulas, and the thresholds of the queries whose feature a threshold is. Rounding
to three places is written out anew, by the same rule.
"""

from __future__ import annotations

from trawl.functions.scoring import BM25_K1, FALLBACK_CORPUS_SIZE, SearchWeights
from trawl.functions.text import STOPWORDS, WORD_PATTERN


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_STOP = ", ".join(_quoted(word) for word in sorted(STOPWORDS))
_PATTERN = _quoted(WORD_PATTERN)
_WEIGHTS = SearchWeights()

_COMMON = """
titles AS (
  SELECT doc_id AS id, split_part(split_part(text, chr(10), 1), '.', 1) AS title, text, lang
  FROM documents),
pairs AS (
  SELECT l_orderkey % (SELECT count(*) FROM documents) AS src,
         l_partkey % (SELECT CAST(floor(count(*) * 1.1) AS BIGINT) FROM documents) AS dst
  FROM lineitem),
links AS (
  SELECT src, dst, coalesce(title, 'missing page') AS text
  FROM pairs LEFT JOIN titles ON id = dst),
edges AS (SELECT DISTINCT src, dst FROM links),
vertices AS (SELECT src AS id FROM edges UNION SELECT dst FROM edges),
queries AS (SELECT item_id AS query_id, text AS query FROM benchmark),
qrels AS (
  SELECT DISTINCT user_id % (SELECT count(*) FROM benchmark) AS query_id,
         event_id % (SELECT count(*) FROM documents) AS doc_id
  FROM events WHERE event_type = 'click'),
query_words AS (
  SELECT query_id, unnest(words) AS term, generate_subscripts(words, 1) AS qpos
  FROM (SELECT query_id, regexp_extract_all(lower(query), PATTERN) AS words FROM queries)),
query_terms AS (
  SELECT query_id, term, count(*) AS uses, min(qpos) AS qpos
  FROM query_words WHERE term NOT IN (STOP) GROUP BY ALL)
""".replace("PATTERN", _PATTERN).replace("STOP", _STOP)


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join([_COMMON.strip(), *ctes]) + "\n"


def _frequencies(name: str, table: str, doc_id: str, column: str) -> str:
    return f"""{name} AS (
  SELECT term, doc_id, count(*) AS tf
  FROM (SELECT {doc_id} AS doc_id, unnest(regexp_extract_all(lower({column}), {_PATTERN})) AS term
        FROM {table})
  WHERE term NOT IN ({_STOP}) GROUP BY ALL)"""


def _numbered(name: str, frequencies: str, min_df: int) -> str:
    return f"""{name} AS (
  SELECT term, doc_id, tf,
         row_number() OVER (PARTITION BY term ORDER BY doc_id) AS posting_no,
         count(*) OVER (PARTITION BY term) AS df,
         CAST(sum(tf) OVER (PARTITION BY term) AS BIGINT) AS term_total
  FROM {frequencies} QUALIFY count(*) OVER (PARTITION BY term) > {min_df})"""


def _index(field: str, min_df: int = 0) -> str:
    source = {
        "body": ("titles", "id", "text"),
        "title": ("titles", "id", "title"),
        "anchor": ("links", "dst", "text"),
    }[field]
    name = f"{field}_tf"
    return _frequencies(name, *source) + ",\n" + _numbered(field, name, min_df)


def _rank_steps(iterations: int = 6) -> str:
    steps = ["""degrees AS (SELECT src, count(*) AS out_degree FROM edges GROUP BY src),
rank_0 AS (SELECT id, 1.0::DOUBLE AS rank FROM vertices)"""]
    for i in range(1, iterations + 1):
        steps.append(f"""rank_{i} AS (
  SELECT id, 0.15 + 0.85 * coalesce(received, 0) AS rank
  FROM vertices LEFT JOIN (
    SELECT dst, sum(rank / out_degree) AS received
    FROM edges JOIN degrees USING (src) JOIN rank_{i - 1} ON rank_{i - 1}.id = src
    GROUP BY dst) ON dst = id)""")
    steps.append(f"""pagerank AS (
  SELECT id, rank * (SELECT count(*) / sum(rank) FROM rank_{iterations}) AS pagerank
  FROM rank_{iterations})""")
    return ",\n".join(steps)


def _points(field: str, stage: int, points: str) -> str:
    return f"""SELECT query_id, doc_id, {points} AS points, {stage} AS stage, qpos
  FROM query_terms JOIN {field} USING (term)"""


def _ranking(name: str, points: str, boost: str = "0.0", limit: int | None = None) -> str:
    cut = f"WHERE rank <= {limit}" if limit else ""
    return f"""{name}_points AS ({points}),
{name}_sums AS (
  SELECT query_id, doc_id, sum(points) AS score, min(stage * 1000000 + qpos) AS first_met
  FROM {name}_points GROUP BY ALL),
{name}_scores AS (
  SELECT s.query_id, s.doc_id, s.score + {boost} AS score, first_met
  FROM {name}_sums s LEFT JOIN ranks r ON r.id = s.doc_id),
{name}_ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY query_id ORDER BY round(score, 9) DESC, first_met, doc_id) AS rank
  FROM {name}_scores),
{name} AS (
  SELECT query_id, rank, doc_id,
         CASE WHEN t.id IS NULL THEN 'N/A' ELSE t.title END AS title, score
  FROM {name}_ranked LEFT JOIN titles t ON t.id = doc_id {cut})"""


_NO_RANKS = "ranks AS (SELECT 0::BIGINT AS id, 0.0::DOUBLE AS pagerank WHERE false)"

_IDF = "ln(1 + ((SELECT count(*) FROM pagerank) - df + 0.5) / (df + 0.5))"
_SATURATION = f"(tf * ({BM25_K1}::DOUBLE + 1) / (tf + {BM25_K1}::DOUBLE))"


def _fused() -> list[str]:
    points = " UNION ALL ".join(
        [
            _points("title", 0, f"uses * {_WEIGHTS.title}::DOUBLE"),
            _points("anchor", 1, f"uses * tf * {_WEIGHTS.anchor}::DOUBLE"),
            _points("body", 2, f"uses * {_IDF} * {_SATURATION} * {_WEIGHTS.body}::DOUBLE"),
        ]
    )
    boost = (
        f"{_WEIGHTS.pagerank}::DOUBLE * "
        "CASE WHEN r.pagerank > 0 THEN log10(r.pagerank + 1) ELSE 0 END"
    )
    return [
        _rank_steps(),
        "ranks AS (SELECT * FROM pagerank)",
        _index("title"),
        _index("anchor"),
        _index("body"),
        _ranking("results", points, boost, limit=100),
    ]


_RESULT_COLUMNS = "query_id, rank, doc_id, title, round(score, 6) AS score"


def _log(page_id: str = "user_id::VARCHAR", views: str = "floor(value)::BIGINT::VARCHAR") -> str:
    return f"""log AS (
  SELECT event_id AS line_no, string_split(concat_ws(' ',
    CASE WHEN event_type IN ('view', 'click') THEN 'en.wikipedia' ELSE 'de.wikipedia' END,
    concat('Page_', user_id),
    CASE WHEN json_extract_string(props, '$.k') = '9' THEN 'null' ELSE {page_id} END,
    'desktop', {views}), ' ') AS f
  FROM events),
parsed AS (
  SELECT line_no, try_cast(f[3] AS BIGINT) AS id, try_cast(f[5] AS BIGINT) AS views
  FROM log WHERE len(f) >= 5 AND f[1] = 'en.wikipedia' AND f[3] <> 'null'),
valid AS (SELECT * FROM parsed WHERE id IN (SELECT id FROM titles) AND views IS NOT NULL),
pageviews AS (SELECT id, arg_max(views, line_no) AS views FROM valid GROUP BY id)"""


_LOG = _log()
_LONG_LOG = _log("'00' || user_id", "'9' || lpad(floor(value)::BIGINT::VARCHAR, 18, '0')")

_ASKED = """asked AS (
  SELECT o_orderkey AS request_id,
         unnest([o_orderkey::VARCHAR, o_custkey::VARCHAR, o_orderstatus]) AS doc_id,
         generate_subscripts([1, 2, 3], 1) - 1 AS pos
  FROM orders)"""

def _marked(deepest: int, judged: str = "qrels") -> str:
    return f"""top AS (
  SELECT query_id, doc_id, rank, q.doc_id IS NOT NULL AS hit
  FROM (SELECT query_id, doc_id::VARCHAR AS doc_id, rank FROM results WHERE rank <= {deepest}) r
  LEFT JOIN (SELECT query_id, doc_id::VARCHAR AS doc_id FROM {judged}) q USING (query_id, doc_id)),
running AS (
  SELECT *, sum(hit::INT) OVER (
    PARTITION BY query_id ORDER BY rank ROWS UNBOUNDED PRECEDING) / rank AS running
  FROM top),
relevant AS (SELECT query_id, count(*) AS n_relevant FROM {judged} GROUP BY query_id)"""


_MARKED = _marked(40)
_STRING_QRELS = """string_qrels AS (
  SELECT query_id, unnest([doc_id::VARCHAR, 'doc-' || doc_id]) AS doc_id FROM qrels)"""
_ODD_QUERIES = """odd_queries AS (
  SELECT query_id * 4 + generate_subscripts(forms, 1) - 1 AS query_id, unnest(forms) AS query
  FROM (SELECT query_id, ['', 'the of which', 'qqqunknown', query || ' ' || query] AS forms
        FROM queries))"""


def _round_exact(value: str) -> str:
    """Rounding to three places by the exact binary value, ties to even."""
    high, floor = f"(({value})::FLOAT)::DOUBLE", f"floor(({value}) * 1000)"
    beyond = f"(({high} * 2000 - (2 * {floor} + 1)) + (({value}) - {high}) * 2000)"
    up = f"CASE WHEN {beyond} > 0 THEN 1 WHEN {beyond} < 0 THEN 0 ELSE {floor} % 2 END"
    return f"(({floor} + {up}) / 1000.0::DOUBLE)"


def _fixed(first: int, second: int, f1: int) -> str:
    hits = ",\n         ".join(
        f"count(DISTINCT CASE WHEN hit AND rank <= {k} THEN doc_id END) AS h{k}"
        for k in (first, second, f1)
    )
    return f"""counts AS (
  SELECT query_id, {hits}
  FROM running GROUP BY query_id),
ratios AS (
  SELECT query_id, query, coalesce(h{first}, 0) / {first}::DOUBLE AS p{first},
         coalesce(h{second}, 0) / {second}::DOUBLE AS p{second},
         coalesce(h{f1}, 0) / {f1}::DOUBLE AS deep,
         CASE WHEN n_relevant > 0 THEN coalesce(h{f1}, 0)::DOUBLE / n_relevant ELSE 0 END AS found
  FROM queries LEFT JOIN relevant USING (query_id) LEFT JOIN counts USING (query_id)),
measured AS (
  SELECT *, CASE WHEN deep + found > 0 THEN 2 * deep * found / (deep + found) ELSE 0 END AS f1_{f1}
  FROM ratios),
metrics AS (
  SELECT query_id, query, p{first}, p{second}, f1_{f1},
         CASE WHEN p{first} + f1_{f1} > 0
              THEN 2 * p{first} * f1_{f1} / (p{first} + f1_{f1}) ELSE 0 END AS quality
  FROM measured)"""


def _listed(first: int, second: int, f1: int, ap: int) -> str:
    cuts = (first, second, f1)
    counts = ",\n         ".join(
        f"sum(CASE WHEN hit AND rank <= {k} THEN 1 ELSE 0 END) AS h{k}, "
        f"sum(CASE WHEN rank <= {k} THEN 1 ELSE 0 END) AS n{k}"
        for k in cuts
    )
    ratios = ",\n         ".join(
        f"CASE WHEN n{k} > 0 THEN h{k}::DOUBLE / n{k} ELSE 0::DOUBLE END AS p{k}" for k in cuts
    )
    rounded = ", ".join(f"{_round_exact(f'p{k}')} AS p{k}" for k in cuts)
    return f"""counts AS (
  SELECT query_id, {counts},
         avg(CASE WHEN hit AND rank <= {ap} THEN running END) AS mean_precision
  FROM running GROUP BY query_id),
ratios AS (
  SELECT query_id, query, {ratios},
         CASE WHEN n_relevant > 0 THEN coalesce(h{f1}, 0)::DOUBLE / n_relevant
              ELSE 1::DOUBLE END AS r{f1},
         coalesce(mean_precision, 0::DOUBLE) AS ap{ap}
  FROM queries LEFT JOIN relevant USING (query_id) LEFT JOIN counts USING (query_id)),
rounded AS (
  SELECT query_id, query, {rounded}, {_round_exact(f"r{f1}")} AS r{f1},
         {_round_exact(f"ap{ap}")} AS ap{ap}
  FROM ratios),
combined AS (
  SELECT *, CASE WHEN p{f1} > 0 AND r{f1} > 0
                 THEN 2.0::DOUBLE / (1.0::DOUBLE / p{f1} + 1.0::DOUBLE / r{f1})
                 ELSE 0::DOUBLE END AS f1_raw FROM rounded),
with_f1 AS (SELECT *, {_round_exact("f1_raw")} AS f1_{f1} FROM combined),
with_quality AS (
  SELECT *, CASE WHEN p{first} > 0 AND f1_{f1} > 0
                 THEN 2.0::DOUBLE / (1.0::DOUBLE / p{first} + 1.0::DOUBLE / f1_{f1})
                 ELSE 0::DOUBLE END AS q_raw FROM with_f1),
metrics AS (
  SELECT query_id, query, p{first}, p{second}, r{f1}, f1_{f1}, ap{ap},
         {_round_exact("q_raw")} AS quality
  FROM with_quality)"""


_FIXED = _fixed(5, 10, 30)
_LIST = _listed(5, 10, 30, 40)


def statements(
    min_df: int, body_min_df: int, max_postings: int, block_size: int
) -> dict[str, str]:
    """One statement per registered query; the arguments are those the queries use."""
    posting = "SELECT term, doc_id, tf, posting_no, df, term_total FROM "
    tfidf = _points("body", 0, f"uses * tf * log10({FALLBACK_CORPUS_SIZE}::DOUBLE / df)")
    titled = [_NO_RANKS, _index("title")]
    by_title = _ranking("results", _points("title", 0, "uses"))
    anchored = [_NO_RANKS, _index("anchor")]
    by_anchor = _ranking("results", _points("anchor", 0, "uses"))
    body = [_NO_RANKS, _index("body")]
    by_tfidf = _ranking("results", tfidf, limit=100)
    fused = _fused()
    whole = _with(_index("body")) + posting + "body"
    thinned = _with(_index("body", min_df)) + posting + "body"
    fixed_columns = ["p5", "p10", "f1_30", "quality"]
    list_columns = ["p5", "p10", "r30", "f1_30", "ap40", "quality"]

    odd = (
        _with(*body, by_tfidf).replace(
            f"lower(query), {_PATTERN}) AS words FROM queries",
            f"lower(query), {_PATTERN}) AS words FROM odd_queries",
        ).replace("query_words AS (", _ODD_QUERIES + ",\nquery_words AS (")
        + f"SELECT {_RESULT_COLUMNS} FROM results"
    )

    def rounded(columns: list[str]) -> str:
        return ", ".join(f"round({c}, 6) AS {c}" for c in columns)

    def averages(columns: list[str]) -> str:
        return ", ".join(f"round(avg({c}), 6) AS avg_{c}" for c in columns)

    found = {
        "tokenize_documents": f"""
WITH words AS (
  SELECT doc_id, unnest(w) AS term, generate_subscripts(w, 1) AS pos
  FROM (SELECT doc_id, regexp_extract_all(lower(text), {_PATTERN}) AS w FROM documents)),
kept AS (SELECT * FROM words WHERE term NOT IN ({_STOP}))
SELECT d.doc_id, count(term) AS n_tokens,
       md5(coalesce(string_agg(term, ' ' ORDER BY pos), '')) AS tokens_md5
FROM documents d LEFT JOIN kept USING (doc_id) GROUP BY d.doc_id""",
        "tf_postings_body": _with(_index("body")) + "SELECT term, doc_id, tf FROM body_tf",
        "term_stats_body": _with(_index("body"))
        + "SELECT term, count(*) AS df, sum(tf)::BIGINT AS term_total FROM body_tf GROUP BY term",
        "postings_body": _with(_index("body", body_min_df)) + posting + "body",
        "postings_body_min_df": thinned,
        "postings_title": _with(_index("title")) + posting + "title",
        "postings_anchor": _with(_index("anchor")) + posting + "anchor",
        "posting_lookup": _with(_index("body"))
        + f"""SELECT term, doc_id, tf, posting_no FROM body
WHERE term IN (SELECT term FROM query_terms) AND posting_no <= {max_postings}""",
        "posting_lookup_all": _with(_index("body"))
        + """SELECT term, doc_id, tf, posting_no FROM body
WHERE term IN (SELECT term FROM query_terms)""",
        "posting_lists": _with(_index("body"))
        + f"""SELECT term, (posting_no - 1) // {block_size} AS block_no,
       string_agg(doc_id || ':' || tf, ' ' ORDER BY doc_id) AS postings
FROM body GROUP BY ALL""",
        "index_merge": whole,
        "index_merge_min_df": thinned,
        "index_add": whole,
        "index_add_min_df": thinned,
        "search": _with(*fused) + f"SELECT {_RESULT_COLUMNS} FROM results",
        "search_body": _with(*body, by_tfidf) + f"SELECT {_RESULT_COLUMNS} FROM results",
        "search_title": _with(*titled, by_title)
        + "SELECT query_id, rank, doc_id, title, score::BIGINT AS score FROM results",
        "search_anchor": _with(*anchored, by_anchor)
        + "SELECT query_id, rank, doc_id::VARCHAR AS id, title FROM results",
        "search_odd_queries": odd,
        "link_edges": _with() + "SELECT src, dst FROM edges",
        "link_vertices": _with()
        + """SELECT id, count(src) AS out_degree
FROM vertices LEFT JOIN edges ON src = id GROUP BY id""",
        "pagerank6": _with(_rank_steps()) + "SELECT id, round(pagerank, 6) AS pagerank FROM pagerank",
        "pageviews_last": _with(_LOG) + "SELECT id, views FROM pageviews",
        "pageviews_long_numbers": _with(_LONG_LOG) + "SELECT id, views FROM pageviews",
        "pageviews_sum": _with(_LOG) + "SELECT id, sum(views)::BIGINT AS views FROM valid GROUP BY id",
        "titles_last": """
SELECT conv_id AS id, arg_max(split_part(split_part(text, chr(10), 1), '.', 1), turn) AS title
FROM conversations GROUP BY conv_id""",
        "lookup_pagerank": _with(_rank_steps(), _ASKED)
        + """SELECT request_id, pos, doc_id, round(coalesce(pagerank, 0), 6) AS pagerank
FROM asked LEFT JOIN pagerank ON id = try_cast(doc_id AS BIGINT)""",
        "lookup_pageviews": _with(_LOG, _ASKED)
        + """SELECT request_id, pos, doc_id, coalesce(views, 0) AS views
FROM asked LEFT JOIN pageviews ON id = try_cast(doc_id AS BIGINT)""",
        "enrich_results": _with(*fused, _LOG)
        + f"""SELECT {_RESULT_COLUMNS}, round(coalesce(p.pagerank, 0), 6) AS pagerank,
       coalesce(v.views, 0) AS views
FROM results LEFT JOIN pagerank p ON p.id = doc_id LEFT JOIN pageviews v ON v.id = doc_id""",
        "metrics_fixed": _with(*fused, _MARKED, _FIXED)
        + f"SELECT query_id, query, {rounded(fixed_columns)} FROM metrics",
        "metrics_list": _with(*body, by_tfidf, _MARKED, _LIST)
        + f"SELECT query_id, query, {rounded(list_columns)} FROM metrics",
        "metrics_fixed_other_cuts": _with(*body, by_tfidf, _marked(15), _fixed(2, 7, 15))
        + f"SELECT query_id, query, {rounded(['p2', 'p7', 'f1_15', 'quality'])} FROM metrics",
        "metrics_list_other_cuts": _with(
            *body, by_tfidf, _STRING_QRELS, _marked(15, "string_qrels"), _listed(2, 7, 15, 9)
        )
        + f"SELECT query_id, query, {rounded(['p2', 'p7', 'r15', 'f1_15', 'ap9', 'quality'])} "
        "FROM metrics",
        "metrics_summary_fixed": _with(*body, by_tfidf, _MARKED, _FIXED)
        + f"SELECT count(*) AS n_queries, {averages(fixed_columns)} FROM metrics",
        "metrics_summary_list": _with(*fused, _MARKED, _LIST)
        + f"SELECT count(*) AS n_queries, {averages(list_columns)} FROM metrics",
        "preview_documents": """
WITH shown AS (SELECT doc_id, lang, source, n_chars FROM documents)
(SELECT 'first' AS part, * FROM shown ORDER BY doc_id LIMIT 3)
UNION ALL
(SELECT 'random' AS part, * FROM shown
 ORDER BY md5('0:{"doc_id":' || doc_id || '}') LIMIT 5)""",
        "display_query": """
SELECT conv_id, turn,
       CASE WHEN length(text) > 27 THEN substring(text, 1, 27) || '..' ELSE text END AS shown
FROM conversations""",
    }
    same = {
        "index_stored": "index_merge",
        "index_add_stored": "index_merge",
        "index_add_stored_min_df": "index_merge_min_df",
        "index_merge_stored": "index_merge",
        "index_compacted": "index_merge",
        "term_stats_stored": "term_stats_body",
        "posting_lookup_stored": "posting_lookup",
        "search_stored": "search",
        "search_pruned": "search",
        "search_body_pruned": "search_body",
        "pageviews_two_logs": "pageviews_last",
    }
    return found | {name: found[other] for name, other in same.items()}
