"""Fixed values of the catalogue contract (file names, required columns, thresholds)."""

# Logical dataset -> raw file name.
REQUIRED_RAW_FILES = {
    "movies": "movies_metadata.csv",
    "credits": "credits.csv",
    "keywords": "keywords.csv",
    "links": "links.csv",
    "ratings": "ratings_small.csv",
}

# Required columns per dataset (extra columns are allowed).
REQUIRED_COLUMNS = {
    "movies": {
        "id", "title", "adult", "budget", "revenue", "runtime", "genres", "belongs_to_collection",
        "vote_average", "vote_count", "popularity", "original_language", "release_date",
        "overview", "status",
    },
    "credits": {"id", "crew"},
    "keywords": {"id", "keywords"},
    "links": {"movieId", "tmdbId"},
    "ratings": {"userId", "movieId", "rating", "timestamp"},
}

# Measures coerced to numbers, ranking sizes and minimum group sizes.
NUMERIC_MOVIE_COLUMNS = ["budget", "revenue", "runtime", "vote_average", "vote_count", "popularity"]
TOP_FILM_LIMIT = 20
TOP_FILM_MIN_VOTE_COUNT = 100
TOP_FILM_MIN_BUDGET = 1_000_000
MIN_DIRECTOR_FILMS = 3
MIN_KEYWORD_FILMS = 10
MIN_GENRE_FILMS = 20
MIN_DECADE_FILMS = 20
FEED_MIN_REVENUE = 100_000

# Gold columns, in contract order.
GOLD_COLUMNS = [
    "id", "title", "primary_genre", "genres_list", "director", "primary_keyword", "keywords_list",
    "keyword_count", "budget", "revenue", "profit", "roi", "vote_average", "vote_count",
    "user_rating_avg", "user_rating_count", "popularity", "runtime", "original_language",
    "release_date", "release_year", "decade", "has_collection", "overview", "status",
]

# Columns that bronze landing adds to the columns of the source.
BRONZE_COLUMNS = ("_corrupt", "_pos", "_long")

# Columns of the two film rankings, and those of them that are rounded.
TOP_FILM_COLUMNS = [
    "title", "release_year", "primary_genre", "director", "revenue", "budget", "profit", "roi",
    "vote_average", "user_rating_avg", "vote_count", "user_rating_count",
]
TOP_FILM_ROUNDED = ["revenue", "budget", "profit", "roi", "vote_average", "user_rating_avg"]

# Correlation features and targets, in report order.
CORRELATION_FEATURES = ["budget", "popularity", "vote_average", "vote_count", "user_rating_avg", "runtime"]
CORRELATION_TARGETS = ["revenue", "roi"]

# Analytic table names.
TABLE_NAMES = [
    "receita_por_genero", "top_diretores", "filmes_por_decada", "top_palavras_chave",
    "correlacoes_sucesso", "top_filmes_receita", "top_filmes_roi", "resumo_sucesso_por_genero",
    "resumo_sucesso_por_diretor", "resumo_sucesso_por_decada", "resumo_sucesso_por_palavra_chave",
]
