"""Scalar feature columns of every table."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import AS_OF_YEAR, model_set, query, refined_ratings, rounded, trusted, view
from cinestrata.functions import modelset, tables
from cinestrata.functions.lists import mentions
from cinestrata.functions.tables import with_features
from cinestrata.operators.aggregates import top_names
from cinestrata.operators.quantiles import approx_quantile


def _only(df, keys, features):
    """The keys and the feature columns."""
    return rounded(with_features(df, features).select(*keys, *features))


# --- ratings --------------------------------------------------------------------------

@query("log_votes", "select tconst, round(ln(1 + numVotes), 6) as log_votes from c_ratings")
def log_votes(spark, sf):
    features = tables.ratings()
    return _only(trusted(spark, sf, "ratings"), ["tconst"], {"log_votes": features["log_votes"]})


@query("rating_normalized",
       "select tconst, round((averageRating - 1) / 9, 6) as rating_normalized from c_ratings")
def rating_normalized(spark, sf):
    features = tables.ratings()
    return _only(trusted(spark, sf, "ratings"), ["tconst"],
                 {"rating_normalized": features["rating_normalized"]})


# Over the uncleaned ratings, so that NULLs and out-of-range values are compared too.
@query("rating_category", """
select tconst,
       case when averageRating <= 4 then 'poor' when averageRating <= 6 then 'fair'
            when averageRating <= 7 then 'good' when averageRating <= 8 then 'very_good'
            else 'excellent' end as rating_category,
       case when averageRating > 0 and averageRating <= 4 then 'poor'
            when averageRating > 4 and averageRating <= 6 then 'fair'
            when averageRating > 6 and averageRating <= 7 then 'good'
            when averageRating > 7 and averageRating <= 8 then 'very_good'
            when averageRating > 8 and averageRating <= 10 then 'excellent' end as binned
from t_ratings""")
def rating_category(spark, sf):
    rating = F.col("averageRating")
    return view(spark, sf, "t_ratings").select(
        "tconst", tables.RATING_CATEGORY.label(rating).alias("rating_category"),
        tables.RATING_CATEGORY_BINNED.label(rating).alias("binned"))


@query("is_popular", "select tconst, numVotes, is_popular from r_ratings")
def is_popular(spark, sf):
    return refined_ratings(spark, sf).select("tconst", "numVotes", "is_popular")


# --- basics ---------------------------------------------------------------------------

@query("basics_flags", """
select tconst, cast(length(primaryTitle) as int) as title_length,
       case when runtimeMinutes is not null then 1 else 0 end as has_runtime,
       case when endYear is not null then 1 else 0 end as has_end_year,
       isAdult as is_adult from c_basics""")
def basics_flags(spark, sf):
    wanted = ("title_length", "has_runtime", "has_end_year", "is_adult")
    features = tables.basics()
    return _only(trusted(spark, sf, "basics"), ["tconst"], {n: features[n] for n in wanted})


@query("decade_label", """
select tconst, startYear, case when startYear is null then 'unknown'
  when startYear < 1950 then 'classic' when startYear < 1980 then 'golden_age'
  when startYear < 2000 then 'modern' else 'contemporary' end as decade from c_basics""")
def decade_label(spark, sf):
    return _only(trusted(spark, sf, "basics"), ["tconst", "startYear"],
                 {"decade": tables.basics()["decade"]})


@query("runtime_category", """
select tconst, runtimeMinutes, case when runtimeMinutes is null then 'unknown'
  when runtimeMinutes <= 30 then 'short' when runtimeMinutes <= 90 then 'standard'
  when runtimeMinutes <= 150 then 'long' else 'epic' end as runtime_category from c_basics""")
def runtime_category(spark, sf):
    return _only(trusted(spark, sf, "basics"), ["tconst", "runtimeMinutes"],
                 {"runtime_category": tables.basics()["runtime_category"]})


@query("film_age", f"""
select tconst, coalesce({AS_OF_YEAR} - startYear, 0) as film_age from t_basics""")
def film_age(spark, sf):
    return _only(view(spark, sf, "t_basics"), ["tconst"],
                 {"film_age": tables.basics_compact(AS_OF_YEAR)["film_age"]})


@query("genre_count", """
select tconst, cast(case when genres is null or genres = '' then 0
  else len(string_split(genres, ',')) end as int) as genre_count from t_basics""")
def genre_count(spark, sf):
    return _only(view(spark, sf, "t_basics"), ["tconst"],
                 {"genre_count": tables.basics_compact(AS_OF_YEAR)["genre_count"]})


@query("type_onehot", "select tconst, " + ", ".join(
    f"case when titleType = '{t}' then 1 else 0 end as \"type_{t}\""
    for t in ("movie", "tvSeries", "short", "tvMovie", "documentary")) + " from t_basics")
def type_onehot(spark, sf):
    return _only(view(spark, sf, "t_basics"), ["tconst"], tables.title_type_flags())


_GENRES = ("Drama", "Comedy", "Action", "Sci-Fi", "Music", "Musical", "Romance", "War",
           "Thriller", "Crime")


@query("top_genre_flags", "select tconst, " + ", ".join(
    f"case when contains(coalesce(genres, ''), '{g}') then 1 else 0 end as \"genre_{g.lower()}\""
    for g in _GENRES) + " from t_basics")
def top_genre_flags(spark, sf):
    basics = view(spark, sf, "t_basics")
    names = top_names(basics, "genres", 10, as_list=True)
    return _only(basics, ["tconst"], {f"genre_{g.lower()}": mentions("genres", g) for g in names})


@query("decade_numeric", """
select tconst, cast(floor(startYear / 10) * 10 as int) as decade from t_basics""")
def decade_numeric(spark, sf):
    return view(spark, sf, "t_basics").select("tconst", modelset.decade().alias("decade"))


@query("duration_category", """
select tconst, runtimeMinutes, case when runtimeMinutes <= 0 then null
  when runtimeMinutes <= 90 then 'short' when runtimeMinutes <= 120 then 'standard'
  when runtimeMinutes <= 180 then 'long' when runtimeMinutes <= 300 then 'epic' end
  as duration_category from t_basics""")
def duration_category(spark, sf):
    return view(spark, sf, "t_basics").select(
        "tconst", "runtimeMinutes", modelset.duration_category().alias("duration_category"))


@query("primary_genre", """
select tconst, case when genres is null or genres = '\\N' then 'Unknown'
  else trim(split_part(genres, ',', 1)) end as primary_genre from t_basics""")
def primary_genre(spark, sf):
    return view(spark, sf, "t_basics").select(
        "tconst", modelset.primary_genre().alias("primary_genre"))


@query("age_features", f"""
select tconst, {AS_OF_YEAR} - startYear as movie_age,
       cast(pow({AS_OF_YEAR} - startYear, 2) as double) as movie_age_squared,
       round(ln(1 + {AS_OF_YEAR} - startYear), 6) as movie_age_log,
       case when {AS_OF_YEAR} - startYear <= 5 then 1 else 0 end as is_recent,
       case when {AS_OF_YEAR} - startYear >= 30 then 1 else 0 end as is_classic
from t_basics""")
def age_features(spark, sf):
    return _only(view(spark, sf, "t_basics"), ["tconst"], modelset.ages(AS_OF_YEAR))


@query("cinema_era", """
select tconst, case when startYear < 1960 then 'Golden_Age' when startYear < 1980
  then 'New_Hollywood' when startYear < 2000 then 'Blockbuster_Era'
  when startYear < 2010 then 'Digital_Era' else 'Streaming_Era' end as cinema_era
from t_basics""")
def cinema_era(spark, sf):
    return view(spark, sf, "t_basics").select("tconst", modelset.cinema_era().alias("cinema_era"))


def _sql_has(genre):
    return f"contains(lower(coalesce(genres, '')), '{genre.lower()}')"


@query("interactions", f"""
select tconst,
  case when {_sql_has('Action')} then runtimeMinutes else 0 end as runtime_x_action,
  case when {_sql_has('Drama')} then runtimeMinutes else 0 end as runtime_x_drama,
  case when {_sql_has('Comedy')} then runtimeMinutes else 0 end as runtime_x_comedy,
  case when {_sql_has('Action')} then startYear else 0 end as year_x_action,
  case when {_sql_has('Sci-Fi')} then startYear else 0 end as year_x_scifi,
  cast(pow(runtimeMinutes, 2) as double) as runtime_squared,
  round(ln(1 + runtimeMinutes), 6) as runtime_log,
  round(cast(numVotes as double) / nullif({AS_OF_YEAR} - startYear + 1, 0), 6) as votes_per_age
from model_set""")
def interactions(spark, sf):
    movies = model_set(spark, sf)
    flagged = with_features(movies, modelset.genre_flags(top_names(
        movies, "genres", 15, as_list=True)))
    return _only(flagged, ["tconst"], modelset.interactions(flagged.columns, AS_OF_YEAR))


@query("genre_flags_topn", "select tconst, " + ", ".join(
    f"case when {_sql_has(g)} then 1 else 0 end as \"has_{g.replace('-', '_')}\""
    for g in _GENRES) + ", cast(len(string_split(genres, ',')) as int) as num_genres "
    "from model_set")
def genre_flags_topn(spark, sf):
    movies = model_set(spark, sf)
    flags = modelset.genre_flags(top_names(movies, "genres", 15, as_list=True))
    return _only(movies, ["tconst"], {**flags, "num_genres": modelset.num_genres()})


@query("genre_flags_token", "select tconst, " + ", ".join(
    f"case when list_contains(string_split(lower(coalesce(genres, '')), ','), '{g.lower()}') "
    f"then 1 else 0 end as \"has_{g.replace('-', '_')}\"" for g in _GENRES) + " from t_basics")
def genre_flags_token(spark, sf):
    basics = view(spark, sf, "t_basics")
    names = top_names(basics, "genres", 15, as_list=True)
    return _only(basics, ["tconst"], modelset.genre_flags(names, whole_items=True))


@query("genre_flags_fixed", "select tconst, " + ", ".join(
    f"case when {_sql_has(g)} then 1 else 0 end as \"has_{g}\""
    for g in modelset.COMMON_GENRES) + " from t_basics")
def genre_flags_fixed(spark, sf):
    return _only(view(spark, sf, "t_basics"), ["tconst"],
                 modelset.genre_flags(modelset.COMMON_GENRES, clean_names=False))


@query("rating_quality", """
select tconst, case when averageRating <= 0 then null when averageRating <= 5 then 'Baixo (1-5)'
  when averageRating <= 7 then 'Médio (5-7)' when averageRating <= 10 then 'Alto (7-10)' end
  as rating_quality from t_ratings""")
def rating_quality(spark, sf):
    return view(spark, sf, "t_ratings").select(
        "tconst", modelset.rating_quality().alias("rating_quality"))


@query("proposed_flags", f"""
select r.tconst, case when averageRating >= 7 then 1 else 0 end as is_good,
       cast(pow(startYear, 2) as double) as year_squared,
       case when startYear between 2008 and 2010 then 1 else 0 end as recession_period,
       case when startYear > 2015 then 1 else 0 end as streaming_era,
       case when {_sql_has('Horror')} and runtimeMinutes < 90 then 1 else 0 end as horror_x_short
from t_ratings r join t_basics b on r.tconst = b.tconst""")
def proposed_flags(spark, sf):
    joined = view(spark, sf, "t_ratings").join(view(spark, sf, "t_basics"), "tconst")
    return _only(joined, ["tconst"], modelset.proposed_flags())


# --- crew, principals, akas, episode, names, generic ----------------------------------

def _sql_size(name):
    return (f"cast(case when {name} is not null then len(string_split({name}, ',')) "
            f"else 0 end as int)")


@query("crew_features", f"""
select *, case when total_crew_size = 0 then 'no_crew' when total_crew_size <= 2
  then 'small_crew' when total_crew_size <= 5 then 'medium_crew' else 'large_crew' end
  as crew_category
from (select tconst, {_sql_size('directors')} as num_directors, {_sql_size('writers')}
        as num_writers,
      case when directors is not null then 1 else 0 end as has_director,
      case when writers is not null then 1 else 0 end as has_writer,
      {_sql_size('directors')} + {_sql_size('writers')} as total_crew_size
      from t_crew) x""")
def crew_features(spark, sf):
    return _only(trusted(spark, sf, "crew"), ["tconst"], tables.crew())


def _sql_kept(name):
    return (f"cast(case when {name} is null or {name} = '' then 0 else len([x for x in "
            f"string_split({name}, ',') if trim(x) <> '\\N']) end as int)")


@query("crew_counts_filtered", f"""
select tconst, {_sql_kept('directors')} as director_count, {_sql_kept('writers')} as writer_count
from (select tconst, coalesce(directors, '\\N') as directors,
        case when writers is null then '' else writers || ',\\N' end as writers from t_crew) x""")
def crew_counts_filtered(spark, sf):
    # The sentinel inside the lists is what this variant is about.
    raw = view(spark, sf, "t_crew").select(
        "tconst", F.coalesce("directors", F.lit("\\N")).alias("directors"),
        F.when(F.col("writers").isNull(), "").otherwise(
            F.concat("writers", F.lit(",\\N"))).alias("writers"))
    return _only(raw, ["tconst"], tables.crew_filtered())


_PRINCIPAL = ["l_orderkey", "tconst", "nconst", "ordering"]


@query("principals_features", """
select l_orderkey, tconst, nconst, cast(ordering as int) as ordering,
  case when ordering = 1 then 'lead' when ordering <= 3 then 'main_cast'
       when ordering <= 10 then 'supporting' else 'minor' end as billing_position,
  cast(category in ('actor', 'actress') as int) as is_actor,
  cast(category = 'director' as int) as is_director,
  cast(category = 'producer' as int) as is_producer,
  case when characters is not null then 1 else 0 end as has_character,
  case when job is not null then 1 else 0 end as has_job,
  cast(ordering <= 5 as int) as is_main_cast,
  case when category in ('actor', 'actress') then 'acting' when category = 'director'
       then 'directing' when category = 'producer' then 'producing' when category = 'writer'
       then 'writing' when category = 'composer' then 'music' else 'other' end as role_category
from t_principals""")
def principals_features(spark, sf):
    return _only(trusted(spark, sf, "principals"), _PRINCIPAL, tables.principals())


@query("principals_onehot", """
select l_orderkey, tconst, nconst, cast(ordering as int) as ordering,
  case when ordering <= 3 then 1 else 0 end as is_lead_actor, """ + ", ".join(
    f"case when category = '{c}' then 1 else 0 end as is_{c}"
    for c in tables.PRINCIPAL_CATEGORIES) + " from t_principals")
def principals_onehot(spark, sf):
    return _only(trusted(spark, sf, "principals"), _PRINCIPAL, tables.principals_onehot())


@query("akas_features", """
select l_orderkey, titleId, ordering, cast(length(title) as int) as title_length,
  case when region is not null then 1 else 0 end as has_region,
  case when language is not null then 1 else 0 end as has_language,
  cast(isOriginalTitle = '1' as int) as is_original_title,
  case when attributes is not null then 1 else 0 end as has_attributes,
  case when ordering = 1 then 'primary' when ordering <= 3 then 'secondary'
       else 'alternative' end as title_priority
from t_akas where trim(title) <> ''""")
def akas_features(spark, sf):
    return _only(trusted(spark, sf, "akas"), ["l_orderkey", "titleId", "ordering"], tables.akas())


@query("episode_features", """
select tconst, case when seasonNumber is not null then 1 else 0 end as has_season_number,
  case when episodeNumber is not null then 1 else 0 end as has_episode_number,
  case when seasonNumber is null then 'unknown' when seasonNumber = 1 then 'first_season'
       when seasonNumber <= 3 then 'early_seasons' when seasonNumber <= 7 then 'mid_seasons'
       else 'later_seasons' end as season_category,
  case when episodeNumber is null then 'unknown' when episodeNumber = 1 then 'pilot'
       when episodeNumber <= 5 then 'early_episode' when episodeNumber <= 10 then 'mid_episode'
       else 'later_episode' end as episode_category,
  case when episodeNumber is null then 'unknown' when episodeNumber <= 3 then 'beginning'
       when episodeNumber >= 20 then 'ending' else 'middle' end as episode_position
from t_episode where trim(parentTconst) <> ''""")
def episode_features(spark, sf):
    return _only(trusted(spark, sf, "episode"), ["tconst"], tables.episode())


@query("names_features", f"""
select nconst, case when deathYear is null then 1 else 0 end as is_alive,
  case when birthYear is not null then 1 else 0 end as has_birth_year,
  case when deathYear is null then {AS_OF_YEAR} - birthYear end as approximate_age,
  deathYear - birthYear as career_span,
  cast(length(primaryName) as int) as name_length,
  {_sql_size('primaryProfession')} as num_professions,
  {_sql_size('knownForTitles')} as num_known_titles,
  case when primaryProfession like '%actor%' or primaryProfession like '%actress%'
       then 1 else 0 end as is_actor,
  case when primaryProfession like '%director%' then 1 else 0 end as is_director,
  case when primaryProfession like '%writer%' then 1 else 0 end as is_writer,
  case {_sql_size('knownForTitles')} when 0 then 'unknown' when 1 then 'emerging'
       when 2 then 'established' when 3 then 'established' else 'celebrity' end as fame_category,
  case when birthYear is null then 'unknown' when birthYear < 1930 then 'classic_era'
       when birthYear < 1950 then 'golden_age' when birthYear < 1970 then 'new_hollywood'
       when birthYear < 1990 then 'modern_era' else 'contemporary' end as generation
from t_names where primaryName is not null and trim(primaryName) <> ''""")
def names_features(spark, sf):
    return _only(trusted(spark, sf, "names"), ["nconst"], tables.names(AS_OF_YEAR))


@query("names_role_tokens", """
select nconst, """ + ", ".join(
    f"case when {' or '.join(f'''list_contains(string_split(primaryProfession, ','), '{r}')''' for r in roles)} "
    f"then 1 else 0 end as {name}" for name, roles in (
        ("is_actor", ("actor", "actress")), ("is_director", ("director",)),
        ("is_writer", ("writer",)))) + " from t_names where primaryName is not null")
def names_role_tokens(spark, sf):
    return _only(trusted(spark, sf, "names"), ["nconst"], tables.names_role_items())


_EPISODE = ("tconst", "parentTconst", "seasonNumber", "episodeNumber")


@query("completeness_score", "select tconst, " + " + ".join(
    f"case when {c} is not null then 1 else 0 end" for c in _EPISODE)
    + " as completeness_score from t_episode")
def completeness_score(spark, sf):
    episodes = view(spark, sf, "t_episode")
    return _only(episodes, ["tconst"], {
        "completeness_score": tables.generic(episodes.columns)["completeness_score"]})


@query("primary_key_length", """
select tconst, cast(length(tconst) as int) as primary_key_length from t_episode""")
def primary_key_length(spark, sf):
    episodes = view(spark, sf, "t_episode")
    return _only(episodes, ["tconst"], {
        "primary_key_length": tables.generic(episodes.columns)["primary_key_length"]})
