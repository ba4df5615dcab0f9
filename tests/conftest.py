import csv
import os
import sys
import tempfile
import warnings

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from goldmart.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", "goldmart-tests", {"spark.sql.shuffle.partitions": "8"})
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


MOVIE_COLUMNS = [
    "id", "title", "adult", "budget", "revenue", "runtime", "genres", "belongs_to_collection",
    "vote_average", "vote_count", "popularity", "original_language", "release_date", "overview", "status",
]


def _movie(**kw):
    base = {
        "title": "Movie", "adult": "False", "budget": "100", "revenue": "250", "runtime": "90",
        "genres": "[{'id': 18, 'name': 'Drama'}]", "belongs_to_collection": "", "vote_average": "6.5",
        "vote_count": "150", "popularity": "3.2", "original_language": "en", "release_date": "1995-10-30",
        "overview": "plain", "status": "Released",
    }
    base.update(kw)
    return base


# Hand-written movies with every kind of dirt (expected effects in FIXTURES.md section 1).
MOVIES = [
    _movie(id="1", title="Toy Story", budget="100", revenue="250", genres="[{'id': 16, 'name': 'Animation'}, {'id': 35, 'name': 'Comedy'}]",
           belongs_to_collection="Toy Story Collection", overview='Woody says "hi"\nand leaves', release_date="1999-12-31"),
    _movie(id="1997-08-20", title="Bad id"),
    _movie(id="12.0", title="Float id"),
    _movie(id=" 12", title="Spaced id"),
    _movie(id="", title="Empty id"),
    _movie(id="007", title="Bond", budget="1e3", revenue="0", release_date="1995-1-5", genres="[{'id': 28, 'name': 'Action'}]"),
    _movie(id="5", title="Five adult", adult=" TRUE "),
    _movie(id="5", title="Five clean", adult="False"),
    _movie(id="6", title="Six A", adult="", budget="-5", revenue="300", release_date="2000-01-01"),
    _movie(id="6", title="Six B"),
    _movie(id="8", title="Eight", adult="junk", budget=" 12 ", revenue="12d", release_date="1995"),
    _movie(id="9", title="   ", runtime="100"),
    _movie(id="10", title="NA"),
    _movie(id="11", title="Zero runtime", runtime="0"),
    _movie(id="13", title="Negative runtime", runtime="-1"),
    _movie(id="14", title="Empty runtime", runtime=""),
    _movie(id="15", title="Text runtime", runtime="abc"),
    _movie(id="16", title="Bad date", release_date="1995-02-30", budget="nan", genres="[{'id': 1, 'name': 'Drama'},]"),
    _movie(id="17", title="Old date", release_date="1600-01-01", genres="{'id': 1, 'name': 'x'}"),
    _movie(id="18", title="  Padded  ", budget="0", revenue="500", genres="", release_date="2001-07-04", belongs_to_collection="  "),
    _movie(id="19", title="Lost", adult="False", genres="[]", vote_count="N/A"),
]

CREDITS = [
    {"id": "1", "crew": "[{'job': 'Producer', 'name': 'P'}, {'job': 'Director', 'name': 'John Lasseter'}]"},
    {"id": "7", "crew": "[{'job': 'Director', 'name': 'Terence Young', 'profile_path': None}]"},
    {"id": "8", "crew": "[{'job': 'Producer', 'name': 'Nobody'}]"},
    {"id": "8", "crew": "[{'job': 'Director', 'name': 'Late Director'}]"},
    {"id": "6", "crew": "[{'job': 'Director', 'name': ''}, {'job': 'Director', 'name': 'Second D'}]"},
    {"id": "16", "crew": "[{'job': 'Director', 'name': 'Broken'"},
    {"id": "18", "crew": "[{'job': 'director', 'name': 'lower'}]"},
    {"id": "x", "crew": "[{'job': 'Director', 'name': 'Nobody'}]"},
    {"id": "12.7", "crew": "[{'job': 'Director', 'name': 'Trunc'}]"},
]

KEYWORDS = [
    {"id": "1", "keywords": "[{'id': 931, 'name': 'jealousy'}, {'id': 4290, 'name': 'toy'}, {'id': 4290, 'name': 'toy'}]"},
    {"id": "7", "keywords": "[{'id': 1, 'name': 'spy'}]"},
    {"id": "6", "keywords": "[]"},
    {"id": "6", "keywords": "[{'id': 2, 'name': 'late'}]"},
    {"id": "8", "keywords": "[{'id': 3, 'name': \"Joe's\"}]"},
    {"id": "18", "keywords": "not a literal ]"},
]

LINKS = [
    {"movieId": "100", "tmdbId": "1"},
    {"movieId": "101", "tmdbId": "1"},
    {"movieId": "200", "tmdbId": "7"},
    {"movieId": "200", "tmdbId": "999"},
    {"movieId": "300", "tmdbId": ""},
]

RATINGS = [
    {"userId": "1", "movieId": "100", "rating": "4", "timestamp": "1"},
    {"userId": "2", "movieId": "100", "rating": "5", "timestamp": "2"},
    {"userId": "", "movieId": "101", "rating": "3", "timestamp": "3"},
    {"userId": "3", "movieId": "101", "rating": "", "timestamp": "4"},
    {"userId": "4", "movieId": "200", "rating": "2.5", "timestamp": "5"},
    {"userId": "5", "movieId": "300", "rating": "1", "timestamp": "6"},
]


def write_csv(path, rows, columns):
    with open(path, "w", newline="", encoding="utf-8") as fh:
        w = csv.DictWriter(fh, fieldnames=columns, quoting=csv.QUOTE_MINIMAL)
        w.writeheader()
        for r in rows:
            w.writerow({c: r.get(c, "") for c in columns})


@pytest.fixture()
def raw_dir(tmp_dir):
    d = os.path.join(tmp_dir, "raw")
    os.makedirs(d)
    write_csv(os.path.join(d, "movies_metadata.csv"), MOVIES, MOVIE_COLUMNS)
    write_csv(os.path.join(d, "credits.csv"), CREDITS, ["id", "crew"])
    write_csv(os.path.join(d, "keywords.csv"), KEYWORDS, ["id", "keywords"])
    write_csv(os.path.join(d, "links.csv"), LINKS, ["movieId", "tmdbId"])
    write_csv(os.path.join(d, "ratings_small.csv"), RATINGS, ["userId", "movieId", "rating", "timestamp"])
    return d


@pytest.fixture(autouse=True)
def _quiet_warnings():
    with warnings.catch_warnings():
        warnings.simplefilter("ignore", ResourceWarning)
        yield
