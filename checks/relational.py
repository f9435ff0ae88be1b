"""Reports, joins, aggregates, windows, top-n, samples and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import (
    RUN_TS, model_set, query, refined_ratings, rounded, trusted, view)
from cinestrata.functions import modelset
from cinestrata.functions.tables import with_features
from cinestrata.operators import aggregates, lookup, ordering, scaling
from cinestrata.operators.quantiles import exact_quantiles
from cinestrata.plans import assembly, people, reports


@query("top_movies", """
select b.tconst, b.primaryTitle, r.averageRating, r.numVotes, b.startYear
from c_ratings r join c_basics b on r.tconst = b.tconst
where b.titleType = 'movie' and r.numVotes >= 5000 and r.averageRating >= 8.5
order by r.numVotes desc, b.tconst limit 10""")
def top_movies_report(spark, sf):
    # The test tables never reach the default of 50,000 votes.
    return reports.top_movies(trusted(spark, sf, "ratings"), trusted(spark, sf, "basics"),
                              min_votes=5000)


@query("movies_by_category", """
select rating_category, count(*) as total_movies, round(avg(averageRating), 6) as avg_rating,
       round(avg(numVotes), 6) as avg_votes, max(averageRating) as max_rating,
       min(averageRating) as min_rating
from r_ratings where averageRating is not null and numVotes >= 10 group by rating_category""")
def movies_by_category(spark, sf):
    return rounded(reports.movies_by_category(refined_ratings(spark, sf)))


@query("sample_ratings", f"""
select tconst, averageRating, numVotes, round(log_votes, 6) as log_votes, rating_category,
       is_popular, timestamp '{RUN_TS}' as ingestion_timestamp
from r_ratings where averageRating >= 7.0 and numVotes >= 1000
order by numVotes desc, tconst limit 100""")
def sample_ratings(spark, sf):
    return rounded(reports.sample_ratings(refined_ratings(spark, sf)))


@query("ml_opportunities", """
select tconst, averageRating, numVotes, round(log_votes, 6) as log_votes, rating_category,
       round(averageRating / log_votes, 4) as opportunity_ratio,
       case when averageRating >= 8 and is_popular = 0 then 'HIGH'
            when averageRating >= 7 and is_popular = 0 then 'MEDIUM' else 'LOW' end
         as opportunity_level
from r_ratings where averageRating >= 6.5 and numVotes >= 50 and numVotes <= 10000
order by opportunity_ratio desc, tconst limit 50""")
def ml_opportunities(spark, sf):
    return rounded(reports.opportunities(refined_ratings(spark, sf)))


_TRAINING = """
select tconst, averageRating as target_rating, numVotes, round(log_votes, 6) as log_votes,
       round(rating_normalized, 6) as rating_normalized,
       case rating_category when 'poor' then 1 when 'fair' then 2 when 'good' then 3
            when 'very_good' then 4 when 'excellent' then 5 else 0 end as rating_category_encoded,
       is_popular, 2025 as ingestion_year, 9 as ingestion_month
from r_ratings where numVotes >= 10 and averageRating between 1 and 10
order by md5(tconst), tconst limit {n}"""


@query("ml_training_data", _TRAINING.format(n=100_000))
def ml_training_data(spark, sf):
    return rounded(reports.training_extract(refined_ratings(spark, sf)))


# --- joins ----------------------------------------------------------------------------

@query("model_set", """
select tconst, averageRating, numVotes, titleType, primaryTitle, isAdult, startYear, endYear,
       runtimeMinutes, genres from model_set""")
def model_set_query(spark, sf):
    return model_set(spark, sf)


@query("group_stat_lookup", """
select tconst, m.primary_genre, round(genre_avg_votes, 6) as genre_avg_votes,
       round(genre_avg_rating, 6) as genre_avg_rating
from model_set m left join (
  select primary_genre, avg(numVotes) as genre_avg_votes, avg(averageRating) as genre_avg_rating
  from model_set group by primary_genre) g on m.primary_genre = g.primary_genre""")
def group_stat_lookup(spark, sf):
    return rounded(assembly.with_genre_stats(model_set(spark, sf)).select(
        "tconst", "primary_genre", "genre_avg_votes", "genre_avg_rating"))


_FAME = """
select c.directors, avg(r.averageRating) as director_avg_rating,
       sum(r.numVotes) as director_total_votes
from t_crew c join c_ratings r on c.tconst = r.tconst
where c.directors is not null group by c.directors"""


@query("director_fame", f"""
select m.tconst, c.directors, round(f.director_avg_rating, 6) as director_avg_rating,
       cast(f.director_total_votes as bigint) as director_total_votes
from model_set m left join t_crew c on m.tconst = c.tconst
left join ({_FAME}) f on c.directors = f.directors""")
def director_fame(spark, sf):
    movies = people.with_director_fame(
        model_set(spark, sf), trusted(spark, sf, "crew"), trusted(spark, sf, "ratings"))
    return rounded(movies.select(
        "tconst", "directors", "director_avg_rating", "director_total_votes"))


@query("director_fame_exploded", """
select director, count(*) as titles, round(avg(averageRating), 6) as director_avg_rating,
       cast(sum(numVotes) as bigint) as director_total_votes
from (select unnest(string_split(c.directors, ',')) as director, r.averageRating, r.numVotes
      from t_crew c join c_ratings r on c.tconst = r.tconst) x group by director""")
def director_fame_exploded(spark, sf):
    return rounded(people.director_fame_exploded(
        trusted(spark, sf, "crew"), trusted(spark, sf, "ratings")))


@query("star_power", """
with top as (select tconst, nconst from t_principals where ordering <= 3),
fame as (select t.nconst, avg(r.averageRating) as fame
         from top t join c_ratings r on t.tconst = r.tconst group by t.nconst)
select t.tconst, round(avg(f.fame), 8) as avg_actor_fame, round(max(f.fame), 8) as max_actor_fame,
       round(min(f.fame), 8) as min_actor_fame
from top t join fame f on t.nconst = f.nconst group by t.tconst""")
def star_power(spark, sf):
    return rounded(people.star_power(
        trusted(spark, sf, "principals"), trusted(spark, sf, "ratings")), 8)


_IDS = [f"tt{i:07d}" for i in (1, 3, 7, 12, 25, 33, 48, 57, 61, 99, 120, 131)]


@query("bulk_lookup", f"""
select * from c_ratings where tconst in ({', '.join(f"'{i}'" for i in _IDS[:10])})""")
def bulk_lookup(spark, sf):
    return lookup.lookup(trusted(spark, sf, "ratings"), _IDS, limit=10)


@query("point_lookup", f"select * from c_ratings where tconst = '{_IDS[3]}'")
def point_lookup(spark, sf):
    return lookup.lookup(trusted(spark, sf, "ratings"), [_IDS[3]])


# --- aggregates -----------------------------------------------------------------------

@query("value_counts", """
select category as value, count(*) as n from t_principals where category is not null
group by category""")
def value_counts(spark, sf):
    return aggregates.value_counts(trusted(spark, sf, "principals"), "category")


@query("decade_distribution", """
select cast(floor(startYear / 10) * 10 as int) as value, count(*) as n
from t_basics where startYear is not null group by 1 order by 1 desc limit 10""")
def decade_distribution(spark, sf):
    return aggregates.last_keys(view(spark, sf, "t_basics"), modelset.decade(), 10)


@query("vote_quantile", """
select 0.5::double as prob, round(quantile_cont(numVotes, 0.5), 6) as value from c_ratings
union all select 0.8::double, round(quantile_cont(numVotes, 0.8), 6) from c_ratings
union all select 0.99::double, round(quantile_cont(numVotes, 0.99), 6) from c_ratings""")
def vote_quantile(spark, sf):
    return rounded(exact_quantiles(trusted(spark, sf, "ratings"), "numVotes", [0.5, 0.8, 0.99]))


@query("top_genres", """
select trim(token) as token, count(*) as n
from (select unnest(string_split(genres, ',')) as token from t_basics where genres is not null) x
group by 1 order by n desc, token limit 10""")
def top_genres(spark, sf):
    return aggregates.top_tokens(view(spark, sf, "t_basics"), "genres", 10)


_FLAGGED = ("Drama", "Comedy", "Action", "Music", "Musical", "War")


@query("flag_counts", " union all ".join(f"""
select 'has_{g}' as flag, cast(sum(f) as bigint) as positives,
       round(sum(f) * 100.0 / count(*), 6) as pct
from (select case when contains(lower(coalesce(genres, '')), '{g.lower()}') then 1 else 0 end
      as f from t_basics) x""" for g in _FLAGGED))
def flag_counts(spark, sf):
    flags = modelset.genre_flags(_FLAGGED)
    return rounded(aggregates.flag_counts(
        with_features(view(spark, sf, "t_basics"), flags), list(flags)))


_BASICS = ("tconst", "titleType", "primaryTitle", "isAdult", "startYear", "endYear",
           "runtimeMinutes", "genres")


@query("null_counts", " union all ".join(
    f"select '{c}' as \"column\", count(*) - count({c}) as nulls from t_basics" for c in _BASICS))
def null_counts(spark, sf):
    return aggregates.null_counts(view(spark, sf, "t_basics"))


@query("distinct_genres", """
select count(distinct trim(token)) as distinct_tokens
from (select unnest(string_split(genres, ',')) as token from t_basics) x""")
def distinct_genres(spark, sf):
    return aggregates.distinct_tokens(view(spark, sf, "t_basics"), "genres")


# --- windows, top-n, samples, splits ----------------------------------------------------

@query("minmax_scale", """
select tconst, round((runtimeMinutes - (select min(runtimeMinutes) from model_set))
  / cast((select max(runtimeMinutes) - min(runtimeMinutes) from model_set) as double), 6)
  as runtime_normalized from model_set""")
def minmax_scale(spark, sf):
    return rounded(scaling.minmax(model_set(spark, sf), "runtimeMinutes", "runtime_normalized")
                   .select("tconst", "runtime_normalized"))


@query("year_movie_count", """
select tconst, startYear, case when startYear is not null then
  count(*) over (partition by startYear) end as year_movie_count from t_basics""")
def year_movie_count(spark, sf):
    return lookup.with_group_count(
        view(spark, sf, "t_basics"), "startYear", "year_movie_count").select(
        "tconst", "startYear", "year_movie_count")


@query("sample_n", "select * from model_set order by md5('42' || tconst), tconst limit 300"
       .replace("*", "tconst, averageRating, numVotes"))
def sample_n(spark, sf):
    return ordering.sample_n(model_set(spark, sf).select(
        "tconst", "averageRating", "numVotes"), 300, "tconst", seed="42")


@query("sample_30000", """
select l_orderkey, tconst, nconst, ordering from (
  select l_orderkey, tconst, nconst, cast(ordering as int) as ordering,
         cast(l_orderkey as varchar) || '/' || tconst || '/' || coalesce(cast(ordering as varchar), '')
           || '/' || nconst as row_id
  from t_principals) x order by md5('42' || row_id), row_id limit 30000""")
def sample_30000(spark, sf):
    rows = trusted(spark, sf, "principals").select(
        "l_orderkey", "tconst", "nconst", "ordering",
        F.concat_ws("/", F.col("l_orderkey").cast("string"), "tconst",
                    F.coalesce(F.col("ordering").cast("string"), F.lit("")),
                    "nconst").alias("row_id"))
    return ordering.sample_n(rows, 30_000, "row_id", seed="42").drop("row_id")


@query("head_n", "select * from c_ratings order by tconst limit 5000")
def head_n(spark, sf):
    return ordering.head_n(trusted(spark, sf, "ratings"), 5000, "tconst")


@query("train_test_split", """
select tconst, case when bucket < 33 then 'test' else 'train' end as part from bucketed""")
def train_test_split(spark, sf):
    train, test = ordering.split(model_set(spark, sf), "tconst", 33)
    return (train.select("tconst", F.lit("train").alias("part"))
            .unionByName(test.select("tconst", F.lit("test").alias("part"))))
