"""DuckDB SQL for every catalogue query: the expected answer computed straight from the given
tables (pre-registered views), without the library. Literal cells are not parsed here: the
expected lists come from the part names the literals were built from.
"""

from __future__ import annotations

from goldmart.constants import GOLD_COLUMNS


def r(expr: str, digits: int = 2) -> str:
    """Half-even rounding on the binary value, as ``rint_round`` does; -0.0 becomes 0.0."""
    s = f"{10 ** digits}::DOUBLE"
    return f"(round_even(({expr}) * {s}, 0) / {s} + 0.0)"


LINE_ORDER_SQL = "l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity"
Q = "CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)"
QD = "CAST(CAST(l_quantity AS BIGINT) AS DOUBLE)"

GOLD_CTES = f"""
li_first AS (
  SELECT l_orderkey, l_partkey FROM (
    SELECT l_orderkey, l_partkey,
      row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER_SQL}) AS rn
    FROM lineitem) t
  WHERE rn = 1
),
la AS (
  SELECT l_orderkey,
    sum(round_even(l_extendedprice * (1 - l_discount) * 100::DOUBLE, 0)) / 100::DOUBLE AS budget,
    CAST(count(*) AS DOUBLE) AS vote_count,
    round_even(4::DOUBLE * sum(round_even(l_discount * 100::DOUBLE, 0)) / count(*), 0) / 4::DOUBLE AS vote_average,
    round_even(sum(l_tax) * 100::DOUBLE, 0) / 100::DOUBLE AS popularity,
    max(l_shipdate) AS last_ship
  FROM lineitem GROUP BY l_orderkey
),
mv AS (
  SELECT o.o_orderkey AS id, o.o_orderstatus AS title, o.o_orderpriority AS primary_genre,
    nullif(la.budget, 0) AS budget, nullif(o.o_totalprice, 0) AS revenue,
    la.vote_average, la.vote_count, la.popularity,
    CAST(date_diff('day', CAST(o.o_orderdate AS DATE), CAST(la.last_ship AS DATE)) AS DOUBLE) AS runtime,
    o.o_orderdate, o.o_orderstatus
  FROM orders o LEFT JOIN la ON la.l_orderkey = o.o_orderkey
),
dr AS (
  SELECT f.l_orderkey AS id, c.c_name AS director
  FROM li_first f JOIN orders o ON o.o_orderkey = f.l_orderkey
  LEFT JOIN customer c ON c.c_custkey = o.o_custkey
  WHERE f.l_partkey % 5 <> 0 AND (f.l_partkey % 7 = 3 OR f.l_partkey % 11 <> 4)
    AND c.c_name IS NOT NULL AND c.c_name <> ''
),
kw AS (
  SELECT f.l_orderkey AS id,
    CASE WHEN f.l_partkey % 17 = 0 OR (f.l_partkey % 13 <> 5 AND f.l_partkey % 19 = 7) THEN NULL
         ELSE p.p_name END AS kw_text
  FROM li_first f LEFT JOIN part p ON p.p_partkey = f.l_partkey
),
ra AS (
  SELECT l_orderkey AS id,
    {r("avg(CAST(1 + l_orderkey % 10 AS DOUBLE) * 0.5::DOUBLE)")} AS user_rating_avg,
    count(*) AS user_rating_count
  FROM lineitem WHERE l_partkey % 23 <> 0 GROUP BY l_orderkey
),
gold AS (
  SELECT mv.id, mv.title, mv.primary_genre, mv.primary_genre AS genres_list, dr.director,
    split_part(kw.kw_text, ' ', 1) AS primary_keyword,
    coalesce(replace(kw.kw_text, ' ', '|'), '') AS keywords_list,
    CAST(CASE WHEN kw.kw_text IS NULL THEN 0 ELSE 2 END AS BIGINT) AS keyword_count,
    mv.budget, mv.revenue, mv.revenue - mv.budget AS profit,
    CASE WHEN mv.budget > 0 AND mv.revenue IS NOT NULL
         THEN {r("(mv.revenue - mv.budget) / mv.budget * 100::DOUBLE")} END AS roi,
    mv.vote_average, mv.vote_count, ra.user_rating_avg, ra.user_rating_count, mv.popularity, mv.runtime,
    'en' AS original_language, strftime(mv.o_orderdate, '%Y-%m-%d') AS release_date,
    CAST(year(mv.o_orderdate) AS INTEGER) AS release_year,
    CAST(floor(year(mv.o_orderdate) / 10) * 10 AS INTEGER) AS decade,
    CASE WHEN mv.o_orderstatus = 'F' THEN 1 ELSE 0 END AS has_collection,
    'order ' || CAST(mv.id AS VARCHAR) AS overview, mv.o_orderstatus AS status
  FROM mv LEFT JOIN dr ON dr.id = mv.id LEFT JOIN kw ON kw.id = mv.id LEFT JOIN ra ON ra.id = mv.id
  WHERE mv.runtime > 0
),
kw_rows AS (
  SELECT id, revenue, roi, vote_average, user_rating_avg, unnest(string_split(keywords_list, '|')) AS keyword
  FROM gold WHERE keywords_list <> ''
)"""


def with_gold(select: str) -> str:
    return f"WITH {GOLD_CTES}\n{select}"


# ----------------------------------------------------------------------------- marts
REVENUE_BY_GENRE = f"""SELECT primary_genre, {r("sum(revenue) / 1e9")} AS receita_total_bi,
  {r("avg(revenue) / 1e6")} AS receita_media_mi, count(id) AS qtd_filmes
FROM gold WHERE revenue IS NOT NULL AND primary_genre IS NOT NULL GROUP BY primary_genre"""

TOP_DIRECTORS = f"""SELECT director, {r("sum(revenue) / 1e9")} AS receita_total_bi,
  {r("avg(vote_average)")} AS nota_metadata_media, {r("avg(user_rating_avg)")} AS nota_usuarios_media,
  count(id) AS qtd_filmes
FROM gold WHERE revenue IS NOT NULL AND director IS NOT NULL GROUP BY director HAVING count(id) >= 6"""

BY_DECADE = f"""SELECT decade, count(id) AS qtd_filmes, {r("avg(vote_average)")} AS nota_metadata_media,
  {r("avg(user_rating_avg)")} AS nota_usuarios_media, {r("avg(runtime)")} AS duracao_media
FROM gold WHERE decade IS NOT NULL GROUP BY decade"""

TOP_KEYWORDS = f"""SELECT keyword, count(id) AS qtd_filmes, {r("avg(revenue) / 1e6")} AS receita_media_mi,
  {r("avg(user_rating_avg)")} AS nota_usuarios_media
FROM kw_rows GROUP BY keyword HAVING count(id) >= 10"""


def group_summary(key: str, minimum: int, source: str = "gold") -> str:
    return f"""SELECT {key}, count(id) AS qtd_filmes, {r("sum(revenue) / 1e9")} AS receita_total_bi,
  {r("avg(revenue) / 1e6")} AS receita_media_mi, {r("median(revenue) / 1e6")} AS receita_mediana_mi,
  {r("sum(round_even(roi * 100::DOUBLE, 0)) / nullif(count(roi) * 100::DOUBLE, 0)")} AS roi_medio, {r("avg(vote_average)")} AS nota_metadata_media,
  {r("avg(user_rating_avg)")} AS nota_usuarios_media
FROM {source} WHERE {key} IS NOT NULL AND revenue IS NOT NULL GROUP BY {key} HAVING count(id) >= {minimum}"""


FEATURES = ["budget", "popularity", "vote_average", "vote_count", "user_rating_avg", "runtime"]
TARGETS = ["revenue", "roi"]
CORRELATION = "\nUNION ALL\n".join(
    f"""SELECT '{t}' AS target, '{f}' AS feature,
  {r(f"covar_samp({f}, {t}) / nullif(stddev_samp({f}) * stddev_samp({t}), 0)", 4)} AS correlation,
  count(*) AS sample_size
FROM gold WHERE {f} IS NOT NULL AND {t} IS NOT NULL"""
    for t in TARGETS for f in FEATURES
)

_TOP_COLS = f"""title, release_year, primary_genre, director, {r("revenue")} AS revenue, {r("budget")} AS budget,
  {r("profit")} AS profit, {r("roi")} AS roi, {r("vote_average")} AS vote_average,
  {r("user_rating_avg")} AS user_rating_avg, vote_count, user_rating_count"""
TOP_BY_REVENUE = f"""SELECT {_TOP_COLS} FROM gold
WHERE revenue IS NOT NULL AND coalesce(vote_count, 0) >= 4 ORDER BY revenue DESC, id ASC LIMIT 20"""
TOP_BY_ROI = f"""SELECT {_TOP_COLS} FROM gold
WHERE revenue IS NOT NULL AND coalesce(vote_count, 0) >= 4 AND roi IS NOT NULL AND budget IS NOT NULL
  AND budget >= 100000 ORDER BY roi DESC, id ASC LIMIT 20"""

TABLES = {
    "receita_por_genero": REVENUE_BY_GENRE,
    "top_diretores": TOP_DIRECTORS,
    "filmes_por_decada": BY_DECADE,
    "top_palavras_chave": TOP_KEYWORDS,
    "correlacoes_sucesso": CORRELATION,
    "top_filmes_receita": TOP_BY_REVENUE,
    "top_filmes_roi": TOP_BY_ROI,
    "resumo_sucesso_por_genero": group_summary("primary_genre", 20),
    "resumo_sucesso_por_diretor": group_summary("director", 6),
    "resumo_sucesso_por_decada": group_summary("decade", 20),
    "resumo_sucesso_por_palavra_chave": group_summary("keyword", 10, "kw_rows"),
}

# ----------------------------------------------------------------------------- dirty inputs
VALID_ID = ("(l_orderkey % 7 <> 0 AND l_orderkey % 11 <> 0 AND "
            "(l_orderkey % 13 = 0 OR (l_orderkey % 17 <> 0 AND l_orderkey % 19 <> 0)))")
KEPT = "(l_partkey % 6 NOT IN (0, 4) AND l_linenumber % 4 IN (1, 3) AND l_suppkey % 6 >= 4)"
TITLE = "CASE l_linenumber % 4 WHEN 1 THEN l_returnflag || '-' || l_linestatus WHEN 3 THEN l_returnflag END"
BUDGET = f"CASE l_partkey % 5 WHEN 1 THEN 1000::DOUBLE WHEN 2 THEN {QD} END"
REVENUE = f"CASE WHEN l_suppkey % 4 = 0 THEN NULL ELSE {QD} * 100::DOUBLE END"

CLEAN_CTE = f"""clean AS (
  SELECT * FROM (
    SELECT l.*, row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER_SQL}) AS rn
    FROM lineitem l WHERE {VALID_ID}) t
  WHERE rn = 1 AND {KEPT}
)"""

CLEAN_IDS_KEEP_FIRST = f"""WITH {CLEAN_CTE}
SELECT l_orderkey AS id, {TITLE} AS title, false AS adult, {BUDGET} AS budget, {REVENUE} AS revenue,
  {QD} + 0.5::DOUBLE AS runtime, {QD} AS vote_count, l_linestatus AS status
FROM clean"""

CLEAN_COUNTERS = f"""SELECT count(*) AS linhas_brutas, count(*) FILTER (WHERE NOT v) AS ids_invalidos,
  count(*) FILTER (WHERE v) - count(DISTINCT CASE WHEN v THEN l_orderkey END) AS ids_duplicados
FROM (SELECT l_orderkey, {VALID_ID} AS v FROM lineitem) t"""

COERCE_NUMERIC = f"""SELECT l_orderkey, l_linenumber, l_partkey,
  CASE l_partkey % 8 WHEN 0 THEN '1e3' WHEN 1 THEN ' ' || {Q} || ' ' WHEN 2 THEN {Q} || 'd'
    WHEN 3 THEN '+' || {Q} WHEN 4 THEN {Q} || '.7' WHEN 5 THEN '-' || {Q} || '.25'
    WHEN 6 THEN '0x10' ELSE 'nan' END AS texto,
  CASE l_partkey % 8 WHEN 0 THEN 1000::DOUBLE WHEN 1 THEN {QD} WHEN 3 THEN {QD}
    WHEN 4 THEN CAST({Q} || '.7' AS DOUBLE) WHEN 5 THEN -CAST({Q} || '.25' AS DOUBLE) END AS numero,
  CASE l_partkey % 8 WHEN 0 THEN 1000 WHEN 1 THEN CAST(l_quantity AS BIGINT) WHEN 3 THEN CAST(l_quantity AS BIGINT)
    WHEN 4 THEN CAST(l_quantity AS BIGINT) WHEN 5 THEN -CAST(l_quantity AS BIGINT) END::BIGINT AS inteiro
FROM lineitem"""

CLEAN_ENTITIES = f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  (l_partkey % 6 IN (0, 4)) AS adulto, {TITLE} AS titulo, {BUDGET} AS orcamento, {KEPT} AS mantido
FROM lineitem"""

NA_TOKENS = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_linenumber IN (1, 2, 3, 6) THEN NULL WHEN l_linenumber = 4 THEN ' NA'
       WHEN l_linenumber = 5 THEN 'na' ELSE l_returnflag END AS texto
FROM lineitem"""

_RAW_NULLS = {
    "id": "count(*) FILTER (WHERE l_orderkey % 7 <> 0 AND l_orderkey % 11 = 0)",
    "title": "count(*) FILTER (WHERE l_linenumber % 4 = 2)",
    "adult": "count(*) FILTER (WHERE l_partkey % 6 = 2)",
    "budget": "count(*) FILTER (WHERE l_partkey % 5 = 4)",
    "revenue": "0",
    "runtime": "count(*) FILTER (WHERE l_suppkey % 6 = 2)",
    "belongs_to_collection": "count(*) FILTER (WHERE l_linenumber % 3 <> 0)",
    "popularity": "count(*)",
    "overview": "count(*)",
}
_CLEAN_NULLS = {
    "id": "0",
    "title": "0",
    "adult": "0",
    "budget": "count(*) FILTER (WHERE l_partkey % 5 IN (0, 3, 4))",
    "revenue": "count(*) FILTER (WHERE l_suppkey % 4 = 0)",
    "runtime": "0",
    "belongs_to_collection": "count(*) FILTER (WHERE l_linenumber % 3 <> 0)",
    "popularity": "count(*)",
    "overview": "count(*)",
}
NULL_PROFILE = (
    f"WITH {CLEAN_CTE},\n"
    "raw_n AS (SELECT " + ", ".join(f"CAST({v} AS BIGINT) AS {k}" for k, v in _RAW_NULLS.items()) + " FROM lineitem),\n"
    "clean_n AS (SELECT " + ", ".join(f"CAST({v} AS BIGINT) AS {k}" for k, v in _CLEAN_NULLS.items()) + " FROM clean)\n"
    "SELECT * FROM (\n"
    + "\nUNION ALL\n".join(f"SELECT '{k}' AS coluna, raw_n.{k} AS raw, clean_n.{k} AS clean FROM raw_n, clean_n" for k in _RAW_NULLS)
    + "\n) t WHERE raw > 0 OR clean > 0"
)

# ----------------------------------------------------------------------------- literals
_WORDS = "(SELECT p_partkey, split_part(p_name, ' ', 1) AS w1, split_part(p_name, ' ', 2) AS w2 FROM part) p"
PARSE_NAMES = f"""SELECT p_partkey, CAST(p_partkey % 12 AS INTEGER) AS variante,
  CASE p_partkey % 12 WHEN 0 THEN w1 || '|' || w2 WHEN 1 THEN w1 || '''s|' || w2 WHEN 3 THEN w1 || '|' || w2
    WHEN 6 THEN w2 WHEN 8 THEN w1 WHEN 9 THEN w1 || '|' || w1
    WHEN 10 THEN w1 || ''': None, ' || w2 WHEN 11 THEN w1 || ''': None}}' ELSE '' END AS nomes,
  CAST(CASE WHEN p_partkey % 12 IN (0, 1, 3, 9) THEN 2 WHEN p_partkey % 12 IN (6, 8, 10, 11) THEN 1 ELSE 0 END AS INTEGER) AS qtd_nomes,
  (p_partkey % 12 IN (2, 7)) AS malformada
FROM {_WORDS}"""

MALFORMED_COUNT = """SELECT CAST(p_partkey % 12 AS INTEGER) AS variante, count(*) AS linhas,
  count(*) FILTER (WHERE p_partkey % 12 IN (2, 7)) AS malformadas
FROM part GROUP BY 1"""

FIRST_MATCHING_MEMBER = with_gold("SELECT id, director FROM dr")
KEYWORD_TABLE = with_gold("""SELECT id, coalesce(replace(kw_text, ' ', '|'), '') AS keywords_list,
  split_part(kw_text, ' ', 1) AS primary_keyword,
  CAST(CASE WHEN kw_text IS NULL THEN 0 ELSE 2 END AS BIGINT) AS keyword_count FROM kw""")
RATING_BRIDGE = f"""SELECT l_orderkey AS id, {r("avg(l_quantity)")} AS user_rating_avg, count(*) AS user_rating_count
FROM lineitem WHERE l_partkey % 23 <> 0 GROUP BY l_orderkey"""
GOLD_DATASET = with_gold("SELECT " + ", ".join(GOLD_COLUMNS) + " FROM gold")

# ----------------------------------------------------------------------------- profile
SOURCE_SUMMARY = """SELECT 'movies' AS dataset, 'movies_metadata.csv' AS arquivo, count(*) AS linhas, CAST(15 AS BIGINT) AS colunas FROM orders
UNION ALL SELECT 'credits', 'credits.csv', count(*), 8 FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
UNION ALL SELECT 'keywords', 'keywords.csv', count(*), 8 FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey
UNION ALL SELECT 'links', 'links.csv', 2 * count(*), 2 FROM (SELECT DISTINCT l_orderkey * 2 + l_linenumber % 2, l_orderkey FROM lineitem) t
UNION ALL SELECT 'ratings', 'ratings_small.csv', count(*), 4 FROM lineitem"""

NUMERIC_GOLD = ["id", "keyword_count", "budget", "revenue", "profit", "roi", "vote_average", "vote_count",
                "user_rating_avg", "user_rating_count", "popularity", "runtime", "release_year", "decade",
                "has_collection"]
DESCRIBE_NUMERIC = with_gold("\nUNION ALL\n".join(
    f"""SELECT '{c}' AS coluna, count({c}) AS count, {r(f"avg(CAST({c} AS DOUBLE))", 6)} AS mean,
  {r(f"stddev_samp(CAST({c} AS DOUBLE))", 6)} AS std, {r(f"min(CAST({c} AS DOUBLE))", 6)} AS min,
  {r(f"quantile_cont(CAST({c} AS DOUBLE), 0.25)", 6)} AS p25, {r(f"quantile_cont(CAST({c} AS DOUBLE), 0.5)", 6)} AS p50,
  {r(f"quantile_cont(CAST({c} AS DOUBLE), 0.75)", 6)} AS p75, {r(f"max(CAST({c} AS DOUBLE))", 6)} AS max FROM gold"""
    for c in NUMERIC_GOLD
))

STAGE_COUNTERS = with_gold("""SELECT 'fontes' AS etapa, 'quantidade_arquivos' AS indicador, CAST(5 AS BIGINT) AS valor
UNION ALL SELECT 'ingestao', 'dataset_lidos', 5
UNION ALL SELECT 'transformacao', 'dataset_gold_colunas', 25
UNION ALL SELECT 'ingestao', 'total_linhas_brutas',
  (SELECT count(*) FROM orders) + 3 * (SELECT count(*) FROM lineitem)
  + 2 * (SELECT count(*) FROM (SELECT DISTINCT l_orderkey * 2 + l_linenumber % 2, l_orderkey FROM lineitem) t)
UNION ALL SELECT 'transformacao', 'movies_linhas_brutas', (SELECT count(*) FROM orders)
UNION ALL SELECT 'transformacao', 'movies_linhas_apos_limpeza', (SELECT count(*) FROM mv WHERE runtime > 0)
UNION ALL SELECT 'transformacao', 'diretores_extraidos', (SELECT count(*) FROM dr)
UNION ALL SELECT 'transformacao', 'filmes_com_palavras_chave', (SELECT count(*) FROM kw WHERE kw_text IS NOT NULL)
UNION ALL SELECT 'transformacao', 'filmes_com_ratings', (SELECT count(*) FROM ra)
UNION ALL SELECT 'transformacao', 'dataset_gold_linhas', (SELECT count(*) FROM gold)""")

TABLE_ROW_COUNTS = with_gold("\nUNION ALL\n".join(
    f"SELECT '{name}' AS tabela, count(*) AS linhas FROM ({sql}) t" for name, sql in TABLES.items()
))

HIGHLIGHTS = with_gold(f"""SELECT
  (SELECT primary_genre FROM ({REVENUE_BY_GENRE}) a ORDER BY receita_total_bi DESC, primary_genre LIMIT 1) AS genero_lider_receita,
  (SELECT director FROM ({TOP_DIRECTORS}) b ORDER BY receita_total_bi DESC, director LIMIT 1) AS diretor_lider_receita,
  (SELECT CAST(decade AS INTEGER) FROM ({BY_DECADE}) c ORDER BY qtd_filmes DESC, decade LIMIT 1) AS decada_com_mais_filmes""")


def _text(expr: str, kind: str) -> str:
    if kind == "double":
        return f"CASE WHEN {expr} IS NULL THEN NULL ELSE printf('%.4f', round_even({expr} * 10000::DOUBLE, 0) / 10000::DOUBLE) END"
    return f"CAST({expr} AS VARCHAR)"


_RAW_FIELDS = [
    ("id", "CAST(o.o_orderkey AS VARCHAR)", "text"), ("title", "o.o_orderstatus", "text"), ("adult", "'False'", "text"),
    ("budget", "la.budget", "double"), ("revenue", "o.o_totalprice", "double"),
    ("runtime", "CAST(date_diff('day', CAST(o.o_orderdate AS DATE), CAST(la.last_ship AS DATE)) AS DOUBLE)", "double"),
    ("genres", "'[{''id'': ' || CAST(length(o.o_orderpriority) AS VARCHAR) || ', ''name'': ''' || o.o_orderpriority || '''}]'", "text"),
    ("belongs_to_collection", "CASE WHEN o.o_orderstatus = 'F' THEN 'Colecao' END", "text"),
    ("vote_average", "la.vote_average", "double"), ("vote_count", "la.vote_count", "double"),
    ("popularity", "la.popularity", "double"), ("original_language", "'en'", "text"),
    ("release_date", "strftime(o.o_orderdate, '%Y-%m-%d')", "text"),
    ("overview", "'order ' || CAST(o.o_orderkey AS VARCHAR)", "text"), ("status", "o.o_orderstatus", "text"),
]
_GOLD_DOUBLES = {"budget", "revenue", "profit", "roi", "vote_average", "vote_count", "user_rating_avg", "popularity", "runtime"}
RAW_VS_GOLD = with_gold(
    """, pick AS (
  SELECT coalesce(min(id) FILTER (WHERE director IS NOT NULL AND primary_keyword IS NOT NULL
                                   AND user_rating_avg IS NOT NULL), min(id)) AS id FROM gold
),
raw_row AS (
  SELECT """ + ", ".join(f"{_text(e, k)} AS {n}" for n, e, k in _RAW_FIELDS) + """
  FROM orders o LEFT JOIN la ON la.l_orderkey = o.o_orderkey WHERE o.o_orderkey = (SELECT id FROM pick)
),
gold_row AS (
  SELECT """ + ", ".join(
        f"{_text(c, 'double' if c in _GOLD_DOUBLES else 'text')} AS {c}"
        if c not in ("genres_list", "keywords_list") else f"replace({c}, '|', ', ') AS {c}"
        for c in GOLD_COLUMNS
    ) + """
  FROM gold WHERE id = (SELECT id FROM pick)
),
raw_long AS (""" + "\nUNION ALL ".join(f"SELECT '{n}' AS campo, {n} AS raw FROM raw_row" for n, _, _ in _RAW_FIELDS) + """),
gold_long AS (""" + "\nUNION ALL ".join(f"SELECT '{c}' AS campo, {c} AS gold FROM gold_row" for c in GOLD_COLUMNS) + """)
SELECT coalesce(r.campo, g.campo) AS campo, r.raw, g.gold FROM raw_long r FULL OUTER JOIN gold_long g ON r.campo = g.campo"""
)

# ----------------------------------------------------------------------------- feeds
FEED_GENRE_BARS = with_gold(f"SELECT primary_genre, receita_total_bi FROM ({REVENUE_BY_GENRE}) t")
FEED_DECADE_DUAL = with_gold(f"SELECT CAST(decade AS VARCHAR) AS decada, qtd_filmes, nota_usuarios_media FROM ({BY_DECADE}) t")
_FEED_ROWS = "FROM gold WHERE budget IS NOT NULL AND revenue IS NOT NULL AND budget > 100000 AND revenue > 100000"
FEED_COST_REVENUE = with_gold(f"""SELECT {r("budget / 1e6", 6)} AS orcamento_mi, {r("revenue / 1e6", 6)} AS receita_mi,
  {r("vote_average", 6)} AS vote_average {_FEED_ROWS}""")
FEED_COST_REVENUE_MAX = with_gold(f"SELECT greatest(max(budget), max(revenue)) / 1e6 AS max_mi {_FEED_ROWS}")
FEED_COST_REVENUE_BINNED = with_gold(f""", rows_ AS (SELECT budget, revenue, vote_average {_FEED_ROWS}),
top AS (SELECT greatest(max(budget), max(revenue)) AS m FROM rows_)
SELECT CAST(least(floor(budget / m * 20::DOUBLE), 19) AS INTEGER) AS faixa_orcamento,
  CAST(least(floor(revenue / m * 20::DOUBLE), 19) AS INTEGER) AS faixa_receita,
  count(*) AS qtd_filmes, {r("avg(vote_average)", 4)} AS nota_media, {r("max(m) / 20000000::DOUBLE", 6)} AS largura_mi
FROM rows_, top GROUP BY 1, 2""")
FEED_CORR_MATRIX = with_gold(f"""SELECT feature, max(correlation) FILTER (WHERE target = 'revenue') AS revenue,
  max(correlation) FILTER (WHERE target = 'roi') AS roi FROM ({CORRELATION}) t GROUP BY feature""")


# The gold column types of the contract (Spark type names).
GOLD_TYPES = {
    "id": "bigint", "title": "string", "primary_genre": "string", "genres_list": "array<string>",
    "director": "string", "primary_keyword": "string", "keywords_list": "array<string>",
    "keyword_count": "bigint", "budget": "double", "revenue": "double", "profit": "double", "roi": "double",
    "vote_average": "double", "vote_count": "double", "user_rating_avg": "double",
    "user_rating_count": "bigint", "popularity": "double", "runtime": "double",
    "original_language": "string", "release_date": "string", "release_year": "int", "decade": "int",
    "has_collection": "int", "overview": "string", "status": "string",
}
GOLD_DTYPES = with_gold("\nUNION ALL\n".join(
    f"SELECT {i} AS posicao, '{c}' AS coluna, '{GOLD_TYPES[c]}' AS tipo, count({c}) AS nao_nulos FROM gold"
    for i, c in enumerate(GOLD_COLUMNS)
))

RAW_VS_CLEAN_SHAPE = f"""WITH {CLEAN_CTE}
SELECT 'raw' AS dataset, count(*) AS linhas, CAST(21 AS BIGINT) AS colunas FROM lineitem
UNION ALL SELECT 'clean', count(*), 21 FROM clean"""

GOLD_PREVIEW = with_gold("SELECT " + ", ".join(GOLD_COLUMNS) + " FROM gold ORDER BY id LIMIT 5")


DIRTY_DATES = with_gold("""SELECT id,
  CASE id % 10 WHEN 0 THEN '1995-01-05' WHEN 7 THEN '2000-12-31' WHEN 8 THEN release_date WHEN 9 THEN release_date END AS release_date,
  CAST(CASE id % 10 WHEN 0 THEN 1995 WHEN 7 THEN 2000 WHEN 8 THEN release_year WHEN 9 THEN release_year END AS INTEGER) AS release_year,
  CAST(CASE id % 10 WHEN 0 THEN 1990 WHEN 7 THEN 2000 WHEN 8 THEN decade WHEN 9 THEN decade END AS INTEGER) AS decade,
  CASE (id % 10) % 4 WHEN 1 THEN 1 WHEN 3 THEN has_collection ELSE 0 END AS has_collection FROM gold""")

_OK = "CAST(l_orderkey AS VARCHAR)"
# the raw title ('NA' where the line number leaves 2), then quotes, commas and line ends by part key
_RAW_TITLE = """CASE l_linenumber % 4 WHEN 0 THEN '   ' WHEN 1 THEN '  ' || l_returnflag || '-' || l_linestatus || chr(9)
    WHEN 3 THEN chr(160) || l_returnflag || chr(160) WHEN 2 THEN 'NA' END"""
_QUOTED_TITLE = f"""CASE l_partkey % 5 WHEN 0 THEN '"' || {_RAW_TITLE} || '"' WHEN 1 THEN {_RAW_TITLE} || ', the' || chr(10) || 'second ""line"' || chr(10)
    WHEN 2 THEN chr(10) || chr(10) || ',"",' || {_RAW_TITLE} WHEN 3 THEN {_RAW_TITLE} || '" disk' ELSE nullif({_RAW_TITLE}, 'NA') END"""
CSV_INGEST = f"""SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_orderkey % 7 = 0 THEN 'x' || {_OK} WHEN l_orderkey % 11 = 0 THEN NULL WHEN l_orderkey % 13 = 0 THEN '000' || {_OK}
    WHEN l_orderkey % 17 = 0 THEN ' ' || {_OK} WHEN l_orderkey % 19 = 0 THEN {_OK} || '.0' ELSE {_OK} END AS id,
  {_QUOTED_TITLE} AS title,
  CASE l_partkey % 6 WHEN 0 THEN ' TRUE ' WHEN 1 THEN 'False' WHEN 3 THEN 'junk' WHEN 4 THEN 'true' WHEN 5 THEN 'FALSE' END AS adult,
  CASE l_partkey % 5 WHEN 0 THEN '0' WHEN 1 THEN '1e3' WHEN 2 THEN ' ' || {Q} || ' ' WHEN 3 THEN {Q} || 'd' END AS budget,
  CASE WHEN l_suppkey % 4 = 0 THEN '0' ELSE {Q} || '00' END AS revenue,
  CASE l_suppkey % 6 WHEN 0 THEN '0' WHEN 1 THEN '-1' WHEN 2 THEN NULL WHEN 3 THEN 'abc' ELSE {Q} || '.5' END AS runtime,
  CASE WHEN l_linenumber % 3 = 0 THEN ' ' END AS belongs_to_collection, NULL::VARCHAR AS overview
FROM lineitem"""

def _nearest(whole: str, units: str) -> str:
    """The double nearest to a positive HUGEINT times 2^-units: 53 bits are kept, the rest rounds half to even."""
    bits = f"greatest(len(list_filter(range(126), lambda j: {whole} >= (1::HUGEINT << j::INT))) - 53, 0)::INT"
    kept, half = f"({whole} >> {bits})", f"(1::HUGEINT << greatest({bits} - 1, 0))"
    rest = f"({whole} - ({kept} << {bits}))"
    up = f"CASE WHEN {bits} > 0 AND ({rest} > {half} OR ({rest} = {half} AND {kept} % 2 = 1)) THEN 1 ELSE 0 END"
    return f"({kept} + {up})::DOUBLE * pow(2.0::DOUBLE, {bits} - {units})"


# Charged amounts lie below 2^17 and above 2^-2, so they are whole numbers of 2^-56; a mean keeps one more bit that tells of a remainder.
EXACT_SUMS = f"""WITH x AS (SELECT l_suppkey, (l_extendedprice * (1.0::DOUBLE - l_discount) * (1.0::DOUBLE + l_tax) * 72057594037927936::DOUBLE)::HUGEINT AS u FROM lineitem),
s AS (SELECT l_suppkey, count(*) AS linhas, sum(u) AS u FROM x GROUP BY l_suppkey),
t AS (SELECT l_suppkey, linhas, u, (u // linhas) * 2 + CASE WHEN u % linhas > 0 THEN 1 ELSE 0 END AS m FROM s)
SELECT l_suppkey, linhas, {_nearest('u', '56')} AS total, {_nearest('m', '57')} AS media FROM t"""

_SUMMARY = "qtd_filmes receita_total_bi* receita_media_mi* receita_mediana_mi* roi_medio* nota_metadata_media* nota_usuarios_media*"
_TOP = "title release_year primary_genre director revenue* budget* profit* roi* vote_average* user_rating_avg* vote_count* user_rating_count"
# columns of the analytic tables; * marks doubles
_TABLE_COLUMNS = {
    "receita_por_genero": "primary_genre receita_total_bi* receita_media_mi* qtd_filmes",
    "top_diretores": "director receita_total_bi* nota_metadata_media* nota_usuarios_media* qtd_filmes",
    "filmes_por_decada": "decade qtd_filmes nota_metadata_media* nota_usuarios_media* duracao_media*",
    "top_palavras_chave": "keyword qtd_filmes receita_media_mi* nota_usuarios_media*",
    "correlacoes_sucesso": "target feature correlation* sample_size", "top_filmes_receita": _TOP, "top_filmes_roi": _TOP,
    "resumo_sucesso_por_genero": f"primary_genre {_SUMMARY}", "resumo_sucesso_por_diretor": f"director {_SUMMARY}",
    "resumo_sucesso_por_decada": f"decade {_SUMMARY}", "resumo_sucesso_por_palavra_chave": f"keyword {_SUMMARY}",
}


def _table_values(name: str, sql: str) -> str:
    columns = _TABLE_COLUMNS[name].split()
    line = "target || '|' || feature" if name == "correlacoes_sucesso" else f"{columns[0]}::VARCHAR"
    text = lambda c: f"round_even({c[:-1]} * 10000::DOUBLE, 0)::BIGINT::VARCHAR" if c.endswith("*") else f"{c}::VARCHAR"
    values = ", ".join(f"{{'coluna': '{c.rstrip('*')}', 'valor': {text(c)}}}" for c in columns)
    return f"SELECT '{name}' AS tabela, linha, v.coluna AS coluna, v.valor AS valor FROM (SELECT {line} AS linha, unnest([{values}]) AS v FROM ({sql}) t)"


TABLE_CSVS = with_gold("\nUNION ALL\n".join(_table_values(name, sql) for name, sql in TABLES.items()))
OUTPUT_MANIFEST = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS arquivo, true AS preenchido" for name in ["filmes_processados.csv", "filmes_processados_parquet", *[f"{t}.csv" for t in TABLES]]
)
PIPELINE_COUNTERS = STAGE_COUNTERS + """
UNION ALL SELECT 'malformadas', 'credits.crew', (SELECT count(*) FROM lineitem WHERE l_partkey % 5 <> 0 AND l_partkey % 7 <> 3 AND l_partkey % 11 = 4)
UNION ALL SELECT 'malformadas', 'keywords.keywords', (SELECT count(*) FROM lineitem WHERE l_partkey % 17 = 0)
UNION ALL SELECT 'malformadas', 'movies.genres', 0"""


SQL: dict[str, str] = {
    "na_tokens_to_null": NA_TOKENS,
    "source_summary": SOURCE_SUMMARY,
    "clean_ids_keep_first": CLEAN_IDS_KEEP_FIRST,
    "clean_counters": CLEAN_COUNTERS,
    "coerce_numeric": COERCE_NUMERIC,
    "clean_entities": CLEAN_ENTITIES,
    "parse_names": PARSE_NAMES,
    "malformed_count": MALFORMED_COUNT,
    "first_matching_member": FIRST_MATCHING_MEMBER,
    "keyword_table": KEYWORD_TABLE,
    "rating_bridge": RATING_BRIDGE,
    "exact_sums": EXACT_SUMS,
    "gold_dataset": GOLD_DATASET,
    "revenue_by_genre": with_gold(REVENUE_BY_GENRE),
    "top_directors": with_gold(TOP_DIRECTORS),
    "by_decade": with_gold(BY_DECADE),
    "top_keywords": with_gold(TOP_KEYWORDS),
    "group_summary_by_genre": with_gold(TABLES["resumo_sucesso_por_genero"]),
    "group_summary_by_director": with_gold(TABLES["resumo_sucesso_por_diretor"]),
    "group_summary_by_decade": with_gold(TABLES["resumo_sucesso_por_decada"]),
    "group_summary_by_keyword": with_gold(TABLES["resumo_sucesso_por_palavra_chave"]),
    "correlation_grid": with_gold(CORRELATION),
    "top_by_revenue": with_gold(TOP_BY_REVENUE),
    "top_by_roi": with_gold(TOP_BY_ROI),
    "null_profile": NULL_PROFILE,
    "describe_numeric": DESCRIBE_NUMERIC,
    "stage_counters": STAGE_COUNTERS,
    "table_row_counts": TABLE_ROW_COUNTS,
    "raw_vs_gold_record": RAW_VS_GOLD,
    "highlights": HIGHLIGHTS,
    "feed_genre_bars": FEED_GENRE_BARS,
    "feed_decade_dual": FEED_DECADE_DUAL,
    "feed_cost_revenue": FEED_COST_REVENUE,
    "feed_cost_revenue_max": FEED_COST_REVENUE_MAX,
    "feed_cost_revenue_binned": FEED_COST_REVENUE_BINNED,
    "feed_corr_matrix": FEED_CORR_MATRIX,
    "parquet_roundtrip": GOLD_DATASET,
    "raw_vs_clean_shape": RAW_VS_CLEAN_SHAPE,
    "gold_preview": GOLD_PREVIEW,
    "record_by_id": with_gold("SELECT " + ", ".join(GOLD_COLUMNS) + " FROM gold WHERE id = (SELECT max(id) FROM gold)"),
    "gold_dtypes": GOLD_DTYPES,
    "dirty_dates": DIRTY_DATES,
    "csv_ingest": CSV_INGEST,
    "csv_roundtrip": GOLD_DATASET,
    "table_csvs": TABLE_CSVS,
    "output_manifest": OUTPUT_MANIFEST,
    "pipeline_counters": PIPELINE_COUNTERS,
}
