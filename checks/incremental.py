"""Arriving files: each is processed once, and routed to its table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from checks.registry import AS_OF_YEAR, ORACLES, RUN_TS, query, rounded, view
from checks.features import _GENRES, _sql_kept, _sql_size
from cinestrata.functions import tables
from cinestrata.operators.ordering import bucket
from cinestrata.plans.layers import RunConfig, run_table, run_tables
from cinestrata.schema import BATCH_COLUMN, TABLES
from cinestrata.session import workspace
from cinestrata.sources import readers
from cinestrata.streaming import incremental


def raw_columns(df, name):
    """The view's columns in the raw table's order; a column the view lacks is NULL."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c)
                       for c in TABLES[name].columns])


def _arrive(df, name, raw_dir, label):
    readers.write_raw_tsv(raw_columns(df, name), f"{raw_dir}/{label}/{TABLES[name].file_name}")


@query("incremental_ingest", "select * from c_ratings")
def incremental_ingest(spark, sf):
    root = workspace(spark, "stream")
    ratings = view(spark, sf, "t_ratings")
    first = bucket("tconst") < 50

    def ingest():
        return incremental.ingest_incremental(
            spark, f"{root}/raw", "ratings", f"{root}/out", f"{root}/checkpoint")

    _arrive(ratings.where(first), "ratings", f"{root}/raw", "day1")
    ingest()
    if ingest() != 0:
        raise AssertionError("a second run read files again")
    _arrive(ratings.where(~first), "ratings", f"{root}/raw", "day2")
    ingest()
    return spark.read.parquet(f"{root}/out")


_ROUTED = ("ratings", "basics", "crew", "principals", "akas", "episode", "names")


@query("route_file_type", " union all ".join(
    f"select '{t}' as file_type, count(*) as n from t_{t}" for t in _ROUTED))
def route_file_type(spark, sf):
    root = workspace(spark, "arrivals")
    for name in _ROUTED:
        _arrive(view(spark, sf, f"t_{name}"), name, root, "day1")
    rows = (spark.read.schema("line string").option("header", True).option("sep", "\n")
            .option("quote", "").option("recursiveFileLookup", True).csv(root))
    return (rows.select(incremental.file_type(F.col("_metadata.file_path")).alias("file_type"))
            .groupBy("file_type").agg(F.count(F.lit(1)).alias("n")))


_CREW = f"""
select tconst, directors, writers, d as num_directors, w as num_writers,
       case when directors is null then 0 else 1 end as has_director,
       case when writers is null then 0 else 1 end as has_writer, d + w as total_crew_size,
       case when d + w = 0 then 'no_crew' when d + w <= 2 then 'small_crew'
            when d + w <= 5 then 'medium_crew' else 'large_crew' end as crew_category
from (select *, {_sql_size('directors')} as d, {_sql_size('writers')} as w from t_crew) x"""


@query("incremental_medallion", f"""
with crew as ({_CREW})
select 'crew' as source, tconst, directors, writers, num_directors, num_writers, has_director,
       has_writer, total_crew_size, crew_category, null::double as averageRating,
       null::int as numVotes, null::double as log_votes, null::double as rating_normalized,
       null as rating_category, null::int as is_popular,
       2025 as ingestion_year, 9 as ingestion_month, 28 as ingestion_day from crew
union all
select 'ratings', tconst, null, null, null, null, null, null, null, null, averageRating, numVotes,
       round(log_votes, 6), round(rating_normalized, 6), rating_category, is_popular, 2025, 9, 28
from r_ratings""")
def incremental_medallion(spark, sf):
    """A batch run of a part of both tables, then three batches of the rest in the same layers."""
    root = workspace(spark, "stream")
    cfg = RunConfig(root, RUN_TS, AS_OF_YEAR)
    frames = {name: view(spark, sf, f"t_{name}") for name in ("crew", "ratings")}
    for i in range(4):
        for name, rows in frames.items():
            _arrive(rows.where(bucket("tconst", 4) == i), name, f"{root}/raw", f"day{i}")
    for name in frames:
        run_table(spark, name, cfg, f"{root}/raw/day0/{TABLES[name].file_name}")
    for i in (1, 2, 3):
        for name in frames:
            incremental.incremental_medallion(
                spark, f"{root}/raw", name, cfg, f"{root}/checkpoint-{name}",
                layout=f"day[123]/{TABLES[name].file_name}")
    parts = [readers.read_layer(spark, cfg.path("refined", name)).drop(
        "ingestion_timestamp", BATCH_COLUMN).withColumn("source", F.lit(name)) for name in frames]
    return rounded(parts[0].unionByName(parts[1], allowMissingColumns=True))


@query("catalog_after_run", """
select tconst, averageRating, numVotes, rating_category, is_popular, 28 as ingestion_day
from r_ratings""")
def catalog_after_run(spark, sf):
    root = workspace(spark, "layers")
    cfg = RunConfig(root, RUN_TS, AS_OF_YEAR, database="cinestrata_" + root[-12:])
    _arrive(view(spark, sf, "t_ratings"), "ratings", f"{root}/raw", "day1")
    run_table(spark, "ratings", cfg, f"{root}/raw/day1/{TABLES['ratings'].file_name}")
    return spark.table(f"{cfg.database}.ratings_refined").select(
        "tconst", "averageRating", "numVotes", "rating_category", "is_popular", "ingestion_day")


@query("layer_run_extended", f"""
with g as (
  select tconst, titleType, startYear, runtimeMinutes, genres from c_basics),
crew as (select tconst, directors, writers from t_crew)
select 'basics' as source, tconst, coalesce(2024 - startYear, 0) as a,
       case when runtimeMinutes is null then 0 else 1 end as b,
       cast(case when genres is null or genres = '' then 0
                 else length(genres) - length(replace(genres, ',', '')) + 1 end as int) as c,
       case when coalesce(titleType, '') = 'movie' then 1 else 0 end as d,
       case when contains(coalesce(genres, ''), 'Drama') then 1 else 0 end as e from g
union all
select 'crew', tconst, {_sql_kept('directors')}, {_sql_kept('writers')}, 0, 0, 0 from crew""")
def layer_run_extended(spark, sf):
    """Titles and crew in the second variant of their features."""
    root = workspace(spark, "layers")
    cfg = RunConfig(root, RUN_TS, AS_OF_YEAR, feature_variant="extended")
    picked = {"basics": ("film_age", "has_runtime", "genre_count", "type_movie", "genre_drama"),
              "crew": ("director_count", "writer_count")}
    parts = []
    for name, columns in picked.items():
        _arrive(view(spark, sf, f"t_{name}"), name, f"{root}/raw", "day1")
        run_table(spark, name, cfg, f"{root}/raw/day1/{TABLES[name].file_name}")
        refined = readers.read_layer(spark, cfg.path("refined", name))
        values = [F.col(c).cast("int") for c in columns] + [F.lit(0)] * (5 - len(columns))
        parts.append(refined.select(F.lit(name).alias("source"), "tconst", *[
            v.alias(n) for v, n in zip(values, "abcde")]))
    return parts[0].unionByName(parts[1])


# Every feature of the second variants, by other queries' SQL.
_EXTENDED = {
    "basics": (f"select tconst, film_age, f.has_runtime, genre_count, t.* exclude (tconst), "
               f"g.* exclude (tconst) from ({ORACLES['film_age']}) a join "
               f"({ORACLES['basics_flags']}) f using (tconst) join ({ORACLES['genre_count']}) c "
               f"using (tconst) join ({ORACLES['type_onehot']}) t using (tconst) "
               f"join ({ORACLES['top_genre_flags']}) g using (tconst) join c_basics using (tconst)",
               ["tconst", "film_age", "has_runtime", "genre_count",
                *[f"type_{t}" for t in tables.TITLE_TYPES], *[f"genre_{g.lower()}" for g in _GENRES]]),
    "principals": (f"select * from ({ORACLES['principals_onehot']})",
                   ["tconst", "nconst", "ordering", "is_lead_actor",
                    *[f"is_{c}" for c in tables.PRINCIPAL_CATEGORIES]]),
}


# Rows that a task groups by their features' text.
_GROUPED_ROWS = 200_000


def _text_of(columns):
    return ", ".join(f"coalesce(cast(\"{c}\" as varchar), '~')" for c in columns)


@query("layer_run_extended_all", " union all ".join(
    f"select '{t}' as \"table\", concat_ws('|', {_text_of(c)}) as features, count(*) as n "
    f"from ({q}) x group by all" for t, (q, c) in _EXTENDED.items()))
def layer_run_extended_all(spark, sf):
    """All features of titles and principals in the second variant, from a layer run."""
    root = workspace(spark, "layers")
    cfg = RunConfig(root, RUN_TS, AS_OF_YEAR, feature_variant="extended")
    parts = []
    for name, (_, columns) in _EXTENDED.items():
        _arrive(view(spark, sf, f"t_{name}"), name, f"{root}/raw", "day1")
        run_table(spark, name, cfg, f"{root}/raw/day1/{TABLES[name].file_name}")
        refined = readers.read_layer(spark, cfg.path("refined", name))
        text = F.concat_ws("|", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("~"))
                                  for c in columns])
        # Nearly all texts differ: dealt by text first, a task counts about so many rows at every
        # size, and not those of a scan task, which grow with the files it is given.
        tasks = refined.count() // _GROUPED_ROWS + 1
        counts = refined.select(text.alias("features")).repartition(tasks, "features").groupBy(
            "features").agg(F.count(F.lit(1)).alias("n"))
        parts.append(counts.select(F.lit(name).alias("table"), "features", "n"))
    return parts[0].unionByName(parts[1])


@query("force_refresh", """
select tconst, numVotes, rating_category, is_popular, true as first_run, false as second_run,
       true as forced_run from r_ratings""")
def force_refresh(spark, sf):
    root = workspace(spark, "layers")
    cfg = RunConfig(root, RUN_TS, AS_OF_YEAR)
    _arrive(view(spark, sf, "t_ratings"), "ratings", f"{root}/raw", "day1")
    raw = f"{root}/raw/day1/{TABLES['ratings'].file_name}"
    ran = [run_table(spark, "ratings", cfg, raw, force=f) for f in (False, False, True)]
    refined = readers.read_layer(spark, cfg.path("refined", "ratings"))
    return refined.select("tconst", "numVotes", "rating_category", "is_popular",
                          *[F.lit(r).alias(n) for r, n in
                            zip(ran, ("first_run", "second_run", "forced_run"))])


_LAYER_ROWS = {
    "ratings": "c_ratings",
    "basics": "c_basics",
    "crew": "t_crew",
    "principals": "t_principals",
    "akas": "t_akas where trim(title) <> ''",
    "episode": "t_episode where trim(parentTconst) <> ''",
    "names": "t_names where primaryName is not null",
}


# SQL of each table's features by other queries, and the columns compared here; no doubles.
_FEATURES = {
    "ratings": ("select * from r_ratings", "tconst numVotes rating_category is_popular"),
    "basics": (f"select f.* from ({ORACLES['basics_flags']}) f join c_basics using (tconst)",
               "tconst title_length has_runtime has_end_year is_adult"),
    "crew": (ORACLES["crew_features"], "tconst num_directors num_writers has_director has_writer "
             "total_crew_size crew_category"),
    "principals": (ORACLES["principals_features"],
                   "tconst nconst ordering billing_position is_actor is_director is_producer "
                   "has_character has_job is_main_cast role_category"),
    "akas": (ORACLES["akas_features"], "titleId ordering title_length has_region has_language "
             "is_original_title has_attributes title_priority"),
    "episode": (ORACLES["episode_features"], "tconst has_season_number has_episode_number "
                "season_category episode_category episode_position"),
    "names": (ORACLES["names_features"],
              "nconst is_alive has_birth_year approximate_age career_span name_length "
              "num_professions num_known_titles is_actor is_director is_writer fame_category "
              "generation"),
}


def _compared(name: str) -> list[str]:
    """The key and the integer and text features of a table, in order."""
    return _FEATURES[name][1].split()


def _sql_digest(name: str) -> str:
    values = ", ".join(f"coalesce(cast({c} as varchar), '~')" for c in _compared(name))
    return (f"select '{name}' as \"table\", count(*) as rows, cast(sum(cast('0x' || substr(md5("
            f"concat_ws('|', {values})), 1, 8) as bigint)) as bigint) as digest "
            f"from ({_FEATURES[name][0]}) f")


@query("layer_run_all_tables", " union all ".join(_sql_digest(t) for t in _FEATURES))
def layer_run_all_tables(spark, sf):
    """Rows of each refined table and a digest of all its keys and features."""
    root = workspace(spark, "layers")
    cfg = RunConfig(root, RUN_TS, AS_OF_YEAR)
    parts = []
    paths = {name: f"{root}/raw/day1/{TABLES[name].file_name}" for name in _LAYER_ROWS}
    for name in paths:
        _arrive(view(spark, sf, f"t_{name}"), name, f"{root}/raw", "day1")
    run_tables(spark, cfg, paths)
    for name in paths:
        refined = readers.read_layer(spark, cfg.path("refined", name))
        text = F.concat_ws("|", *[
            F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in _compared(name)])
        number = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
        parts.append(refined.agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows"),
                                 F.sum(number).alias("digest")))
    return reduce(DataFrame.unionByName, parts)
