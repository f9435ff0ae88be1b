"""Feature preparation: indicators, filling, scaling, products and the two matrices."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import AS_OF_YEAR, model_set, query, refined_ratings, rounded, view
from cinestrata.functions.tables import with_features
from cinestrata.functions import modelset
from cinestrata.operators import columns, encoding, ordering, scaling
from cinestrata.plans import assembly
from cinestrata.session import materialised

_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
_FIRST_GENRES = ("Drama", "Comedy", "Action", "Sci-Fi", "Music", "Musical")
_GENRES = _FIRST_GENRES + ("Romance", "War", "Thriller", "Crime")


@query("onehot", "select movie_id, " + ", ".join(
    f"case when content_rating = '{p}' then 1 else 0 end as \"content_{p}\""
    for p in _PRIORITIES) + " from t_movies")
def onehot(spark, sf):
    movies = view(spark, sf, "t_movies").select("movie_id", "content_rating")
    coded = encoding.one_hot(movies, "content_rating", "content",
                             encoding.categories(movies, "content_rating"))
    return coded.drop("content_rating")


@query("onehot_drop_first", "select movie_id, " + ", ".join(
    f"case when content_rating = '{p}' then 1 else 0 end as \"content_{p}\""
    for p in _PRIORITIES[1:]) + " from t_movies")
def onehot_drop_first(spark, sf):
    movies = view(spark, sf, "t_movies").select("movie_id", "content_rating")
    coded = encoding.one_hot(movies, "content_rating", "content",
                             encoding.categories(movies, "content_rating"), drop_first=True)
    return coded.drop("content_rating")


@query("genre_dummies_top10", "select tconst, " + ", ".join(
    f"case when primary_genre = '{g}' then 1 else 0 end as \"genre_{g}\""
    for g in _FIRST_GENRES) + " from model_set")
def genre_dummies_top10(spark, sf):
    coded = encoding.genre_dummies(model_set(spark, sf))
    return coded.select("tconst", *[c for c in coded.columns if c.startswith("genre_")])


@query("decade_dummies", "select tconst, " + ", ".join(
    f"case when cast(floor(startYear / 10) * 10 as int) = {d} then 1 else 0 end as decade_{d}"
    for d in range(1970, 2030, 10)) + " from t_basics")
def decade_dummies(spark, sf):
    coded = encoding.decade_dummies(view(spark, sf, "t_basics"))
    return coded.select("tconst", *[c for c in coded.columns if c.startswith("decade_")])


@query("align_features", """
select tconst, round(cast(numVotes as double), 6) as numVotes,
       cast(0 as double) as runtimeMinutes, round(log_votes, 6) as log_votes,
       cast(is_popular as double) as is_popular, cast(0 as double) as has_Drama
from r_ratings""")
def align_features(spark, sf):
    return rounded(columns.align_features(
        refined_ratings(spark, sf),
        ["numVotes", "runtimeMinutes", "log_votes", "is_popular", "has_Drama"], keep=["tconst"]))


_MOVIE_BUCKET = ("select *, cast(('0x' || substr(md5(cast(movie_id as varchar)), 1, 8)) as bigint)"
                 " % 100 as bucket from t_movies")


@query("impute_mean", f"""
with m as ({_MOVIE_BUCKET})
select movie_id, round(coalesce(budget, (select avg(budget) from m where bucket >= 25)), 2)
         as budget,
       round(coalesce(duration, (select avg(duration) from m where bucket >= 25)), 6) as duration
from m where bucket < 25""")
def impute_mean(spark, sf):
    movies = view(spark, sf, "t_movies").select("movie_id", "budget", "duration")
    train, test = ordering.split(movies, "movie_id", 25)
    filled = scaling.impute_mean(train, test, ["budget", "duration"])
    return rounded(filled.withColumn("budget", F.round("budget", 2)))


@query("standard_scale", """
with s as (select avg(runtimeMinutes) as rm, stddev_pop(runtimeMinutes) as rs,
                  avg(startYear) as ym, stddev_pop(startYear) as ys
           from bucketed where bucket >= 33)
select tconst, round((runtimeMinutes - rm) / rs, 6) as runtimeMinutes,
       round((startYear - ym) / ys, 6) as startYear
from bucketed, s where bucket < 33""")
def standard_scale(spark, sf):
    movies = model_set(spark, sf).select("tconst", "runtimeMinutes", "startYear")
    train, test = ordering.split(movies, "tconst", 33)
    return rounded(scaling.standardize(train, test, ["runtimeMinutes", "startYear"]))


def _sql_products(names, degree, powers):
    from itertools import combinations, combinations_with_replacement
    pick = combinations_with_replacement if powers else combinations
    return ", ".join(
        " * ".join(f"cast({n} as double)" for n in t) + f" as \"{'*'.join(t)}\""
        for d in range(1, degree + 1) for t in pick(names, d))


@query("poly_expand", "select tconst, " + _sql_products(
    ("startYear", "runtimeMinutes"), 3, True) + " from model_set")
def poly_expand(spark, sf):
    return scaling.poly_expand(model_set(spark, sf), ["startYear", "runtimeMinutes"], 3,
                               keep=["tconst"])


_CROSSED = ("startYear", "runtimeMinutes", "numVotes", "movie_age")


@query("poly_interactions", f"""
select tconst, {_sql_products(_CROSSED, 3, False)}
from (select *, {AS_OF_YEAR} - startYear as movie_age from model_set) x""")
def poly_interactions(spark, sf):
    aged = with_features(model_set(spark, sf), {"movie_age": modelset.movie_age(AS_OF_YEAR)})
    return scaling.poly_interactions(aged, list(_CROSSED), 3, keep=["tconst"])


def _double(expr, name):
    return f"round(cast(coalesce({expr}, 0) as double), 6) as \"{name}\""


_DURATIONS = (("short", "runtimeMinutes <= 90"),
              ("standard", "runtimeMinutes > 90 and runtimeMinutes <= 120"),
              ("long", "runtimeMinutes > 120 and runtimeMinutes <= 180"),
              ("epic", "runtimeMinutes > 180 and runtimeMinutes <= 300"))
_NORMALIZED = ("(runtimeMinutes - (select min(runtimeMinutes) from {t})) / cast((select "
               "max(runtimeMinutes) - min(runtimeMinutes) from {t}) as double)")


def _case(condition):
    return f"case when {condition} then 1 else 0 end"


@query("assemble_features_v1", "select tconst, averageRating, " + ", ".join(
    [_double("startYear", "startYear"), _double("runtimeMinutes", "runtimeMinutes"),
     _double(f"{AS_OF_YEAR} - startYear", "movie_age"),
     _double(_NORMALIZED.format(t="model_set"), "runtime_normalized")]
    + [_double(_case(cond), f"duration_{d}") for d, cond in _DURATIONS]
    + [_double(_case(f"primary_genre = '{g}'"), f"genre_{g}") for g in _FIRST_GENRES])
       + " from model_set")
def assemble_features_v1(spark, sf):
    return rounded(assembly.assemble_v1(model_set(spark, sf), AS_OF_YEAR)[0])


def _has(g):
    return f"contains(lower(genres), '{g.lower()}')"


_AGE = f"({AS_OF_YEAR} - m.startYear)"
_V2 = [
    ("startYear", "m.startYear"), ("runtimeMinutes", "runtimeMinutes"), ("movie_age", _AGE),
    ("runtime_normalized", _NORMALIZED.format(t="train")), ("numVotes", "numVotes"),
    ("year_movie_count", "year_movie_count"), ("genre_avg_votes", "genre_avg_votes"),
    ("genre_avg_rating", "genre_avg_rating"),
    ("num_genres", "len(string_split(genres, ','))"),
    ("movie_age_squared", f"pow({_AGE}, 2)"), ("movie_age_log", f"ln(1 + {_AGE})"),
    ("is_recent", _case(f"{_AGE} <= 5")), ("is_classic", _case(f"{_AGE} >= 30")),
    ("runtime_squared", "pow(runtimeMinutes, 2)"), ("runtime_log", "ln(1 + runtimeMinutes)"),
    ("votes_per_age", f"cast(numVotes as double) / nullif({_AGE} + 1, 0)"),
    *[(f"has_{g.replace('-', '_')}", _case(_has(g))) for g in _GENRES],
    ("era_Blockbuster_Era", _case("m.startYear < 2000")),
    ("era_Digital_Era", _case("m.startYear >= 2000 and m.startYear < 2010")),
    ("era_Streaming_Era", _case("m.startYear >= 2010")),
    *[(f"decade_{d}", _case(f"floor(m.startYear / 10) * 10 = {d}")) for d in range(1980, 2030, 10)],
    ("runtime_x_action", f"case when {_has('Action')} then runtimeMinutes else 0 end"),
    ("runtime_x_drama", f"case when {_has('Drama')} then runtimeMinutes else 0 end"),
    ("runtime_x_comedy", f"case when {_has('Comedy')} then runtimeMinutes else 0 end"),
    ("year_x_action", f"case when {_has('Action')} then m.startYear else 0 end"),
    ("year_x_scifi", f"case when {_has('Sci-Fi')} then m.startYear else 0 end"),
]


@query("feature_select_v2", f"""
with train as (select * from bucketed where bucket >= 33),
years as (select startYear, count(*) as year_movie_count from train group by startYear),
stats as (select primary_genre, avg(numVotes) as genre_avg_votes,
                 avg(averageRating) as genre_avg_rating from train group by primary_genre)
select m.tconst, m.averageRating, {', '.join(_double(e, n) for n, e in _V2)}
from model_set m left join years y on m.startYear = y.startYear
left join stats s on m.primary_genre = s.primary_genre""")
def feature_select_v2(spark, sf):
    movies = materialised(model_set(spark, sf), "model_set")
    train, _ = ordering.split(movies, "tconst", 33)
    return rounded(assembly.assemble_v2(movies, AS_OF_YEAR, fit_on=train)[0])
