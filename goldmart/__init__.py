"""goldmart: catalogue analytics as Spark DataFrame operators.

The stage functions, one per pipeline step, each a lazy DataFrame transform:
``load_raw_datasets`` -> ``clean_movies`` -> ``build_directors`` / ``build_keywords`` /
``build_movie_ratings`` -> ``build_gold_dataset`` -> ``build_aggregations`` -> ``save_outputs`` /
``chart_feeds``; ``run`` chains them from a folder of raw CSVs.
"""

from goldmart.operators.clean import clean_counters, clean_movies
from goldmart.operators.gold import build_gold_dataset
from goldmart.operators.marts import build_aggregations
from goldmart.operators.silver import build_directors, build_keywords, build_movie_ratings
from goldmart.plans.pipeline import chart_feeds, run, run_frames, save_chart_feeds, save_outputs
from goldmart.sources.bronze import load_raw_datasets

__all__ = [
    "build_aggregations", "build_directors", "build_gold_dataset", "build_keywords",
    "build_movie_ratings", "chart_feeds", "clean_counters", "clean_movies", "load_raw_datasets", "run",
    "run_frames", "save_chart_feeds", "save_outputs",
]
