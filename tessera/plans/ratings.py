"""Rating / category analytics (composites C9-C17) as reusable DataFrame functions.

Written for a ``ratings(user, item, rating, timestamp)`` fact table and an
``items(item, title, tags)`` dimension; every column is a parameter.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.buckets import activity_class, half_year, rating_category
from tessera.functions.numeric import as_col, round_half_up
from tessera.functions.temporal import epoch_to_date, month_of, year_of
from tessera.functions.text import explode_tokens
from tessera.operators.aggregates import distinct_count, group_agg, group_count, share_of_total
from tessera.operators.ranking import top_k

# The genre allow-list of the movie ratings job.
MOVIE_GENRES = ["Action", "Adventure", "Animation", "Children", "Comedy", "Crime", "Documentary",
                "Drama", "Fantasy", "Film-Noir", "Horror", "Musical", "Mystery", "Romance", "Sci-Fi",
                "Thriller", "War", "Western"]


def distinct_raters(ratings: DataFrame, user: str = "userId", approx: bool = False) -> DataFrame:
    """Number of distinct users (exact, or HLL++ when ``approx``)."""
    return distinct_count(ratings, user, "distinct_users", approx=approx)


def with_epoch_date(ratings: DataFrame, epoch_col: str = "timestamp", name: str = "date") -> DataFrame:
    """Epoch seconds -> DATE column, in date order."""
    return ratings.withColumn(name, epoch_to_date(epoch_col)).orderBy(name, epoch_col)


def category_distribution(ratings: DataFrame, rating, count_name: str = "count",
                          pct_name: str = "percentage") -> DataFrame:
    """C11: rows per rating category with percent of all rows, largest first."""
    labelled = ratings.withColumn("rating_category", rating_category(as_col(rating)))
    counts = group_count(labelled, "rating_category", count_name)
    return share_of_total(counts, count_name, pct_name).orderBy(F.col(count_name).desc(), "rating_category")


def half_year_counts(ratings: DataFrame, ts, count_name: str = "rating_count") -> DataFrame:
    """Rows per Early/Late Year (month 1-6 vs the rest), largest first."""
    labelled = ratings.withColumn("time_of_year", half_year(month_of(as_col(ts))))
    return group_count(labelled, "time_of_year", count_name).orderBy(F.col(count_name).desc())


def token_popularity(facts: DataFrame, items: DataFrame, fact_key: str, item_key: str, text_col: str,
                     allow: Sequence[str], sep_regex: str = r"\|", by: Mapping[str, Column] | None = None,
                     token_name: str = "genre", count_name: str = "rating_count") -> DataFrame:
    """Fact rows per allowed token of the joined item's text (e.g. genre).

    ``by`` adds grouping columns computed on the fact rows (name -> Column),
    e.g. ``{"year": F.year("ts")}`` for ratings by time and genre.

    Plan, chosen for scale: (1) the fact table is pre-aggregated to one row per
    (item, *by) -- a partial hash aggregate, so a hot item is combined map-side;
    (2) the item side is exploded and filtered by the allow-list before the
    join; (3) the small per-item counts are joined to the tokens and summed.
    Same result as join -> explode -> filter -> count, without shuffling the raw
    fact rows.
    """
    by = dict(by or {})
    per_item = (facts.groupBy(F.col(fact_key).alias("__item"), *[c.alias(n) for n, c in by.items()])
                .agg(F.count(F.lit(1)).alias("__n")))
    tokens = (items.select(F.col(item_key).alias("__item"), explode_tokens(text_col, sep_regex).alias(token_name))
              .filter(F.col(token_name).isin(list(allow))))
    joined = per_item.join(tokens, "__item")
    return (joined.groupBy(*by.keys(), token_name)
            .agg(F.sum("__n").alias(count_name)))


def yearly_share(ratings: DataFrame, ts, count_name: str = "total_ratings",
                 pct_name: str = "percentage_of_total") -> DataFrame:
    """Rows per year with percent of all rows, in year order."""
    counts = group_count(ratings.withColumn("year", year_of(as_col(ts))), "year", count_name)
    return share_of_total(counts, count_name, pct_name).orderBy("year")


def top_rated(ratings: DataFrame, items: DataFrame, key: str, rating: str, title: str,
              min_support: int = 100, k: int = 10, digits: int = 2) -> DataFrame:
    """The k best-rated items with at least ``min_support`` ratings.

    Aggregate first (one row per item), filter on support, then join the item
    titles -- the join sees only qualifying items.  Order: rounded average desc,
    count desc, then item key as a unique tie-break.
    """
    stats = group_agg(ratings, key, {"avg_rating": F.avg(rating), "num_ratings": F.count(F.lit(1))})
    qualified = stats.filter(F.col("num_ratings") >= F.lit(min_support))
    named = qualified.join(items.select(key, title), key)
    shaped = named.select(key, F.col(title).alias("title"),
                          round_half_up("avg_rating", digits).alias("average_rating"), "num_ratings")
    return top_k(shaped, k, ["-average_rating", "-num_ratings"], [key])


def user_activity(ratings: DataFrame, user: str, threshold: int = 50,
                  count_name: str = "rating_count") -> DataFrame:
    """C17: ratings per user with a Frequent/Infrequent label."""
    return group_count(ratings, user, count_name).withColumn("user_type", activity_class(count_name, threshold))


def user_type_distribution(activity: DataFrame) -> DataFrame:
    """Users per activity class (aggregate of an aggregate)."""
    return group_count(activity, "user_type", "user_count")


def top_users(activity: DataFrame, user: str, k: int = 10, count_name: str = "rating_count") -> DataFrame:
    """C17: the k most active users (ties by user key)."""
    return top_k(activity, k, [f"-{count_name}"], [user])
