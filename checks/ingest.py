"""Sources, sinks, catalog and cleaning."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from checks.registry import RUN_TS, query, rounded, trusted, view
from cinestrata.operators import cleaning, columns, lookup
from cinestrata.schema import NULL_TOKEN, TABLES
from cinestrata.session import workspace
from cinestrata.plans.layers import RunConfig, run_table
from cinestrata.sources import audit, catalog, footers, readers, reconcile, sinks
from pyspark.sql import types as T


def _text_schema(df):
    return T.StructType([T.StructField(c, T.StringType()) for c in df.columns])


def _staged(spark, sf, name):
    """The view written in the raw layout; its folder and schema."""
    df = view(spark, sf, f"t_{name}")
    path = f"{workspace(spark, 'raw')}/{TABLES[name].file_name}"
    readers.write_raw_tsv(df, path)
    return path, _text_schema(df)


_BASICS = ("tconst", "titleType", "primaryTitle", "isAdult", "startYear", "endYear",
           "runtimeMinutes", "genres")


@query("raw_tsv_scan", "select " + ", ".join(
    f"coalesce(cast({c} as varchar), '\\N') as {c}" for c in _BASICS) + " from t_basics")
def raw_tsv_scan(spark, sf):
    path, schema = _staged(spark, sf, "basics")
    return readers.read_raw_tsv(spark, path, schema)


@query("null_sentinel", "select " + ", ".join(
    f"cast({c} as varchar) as {c}" for c in _BASICS) + " from t_basics")
def null_sentinel(spark, sf):
    path, schema = _staged(spark, sf, "basics")
    return readers.null_sentinel(readers.read_raw_tsv(spark, path, schema))


@query("typed_cast", """
select tconst, primaryTitle, try_cast(primaryTitle as int) as primaryTitle_int,
       startYear, runtimeMinutes, cast(isAdult as double) as isAdult from t_basics""")
def typed_cast(spark, sf):
    path, schema = _staged(spark, sf, "basics")
    text = readers.read_raw_tsv(spark, path, schema, null_token=NULL_TOKEN)
    doubled = text.select("tconst", "primaryTitle", F.col("primaryTitle").alias("primaryTitle_int"),
                          "startYear", "runtimeMinutes", "isAdult")
    return readers.cast_columns(doubled, {
        "primaryTitle_int": "int", "startYear": "int", "runtimeMinutes": "int",
        "isAdult": "double"})


@query("ingestion_metadata", f"""
select *, timestamp '{RUN_TS}' as ingestion_timestamp, 2025 as ingestion_year,
       9 as ingestion_month, 28 as ingestion_day, date '2025-09-28' as ingestion_date
from t_ratings""")
def ingestion_metadata(spark, sf):
    return sinks.add_ingestion_metadata(view(spark, sf, "t_ratings"), RUN_TS, with_date=True)


@query("partitioned_sink", """
select tconst, averageRating, numVotes, 2025 as ingestion_year, 9 as ingestion_month,
       d as ingestion_day
from c_ratings, (select 28 as d union all select 29) days""")
def partitioned_sink(spark, sf):
    path = workspace(spark, "layer")
    clean = trusted(spark, sf, "ratings")
    # The second date is written twice: the rerun must replace it and spare the first.
    for run in (RUN_TS, "2025-09-29 06:00:00", "2025-09-29 18:00:00"):
        sinks.write_layer(sinks.add_ingestion_metadata(clean, run), path)
    return readers.read_layer(spark, path).drop("ingestion_timestamp")


@query("date_layout_sink", """
select tconst, averageRating, numVotes, 2025 as year, 9 as month, 28 as day from c_ratings""")
def date_layout_sink(spark, sf):
    path = workspace(spark, "layer")
    clean = sinks.add_ingestion_metadata(trusted(spark, sf, "ratings"), RUN_TS)
    sinks.write_layer(clean, path, layout="ymd")
    return readers.read_layer(spark, path).drop("ingestion_timestamp")


@query("layer_scan", """
select tconst, startYear from c_basics where startYear >= 2000""")
def layer_scan(spark, sf):
    path = workspace(spark, "layer")
    sinks.write_layer(
        sinks.add_ingestion_metadata(trusted(spark, sf, "basics"), RUN_TS), path)
    layer = readers.read_layer(spark, path)
    return layer.where((F.col("ingestion_day") == 28) & (F.col("startYear") >= 2000)).select(
        "tconst", "startYear")


@query("csv_scan", """
select movie_id, movie_title, round(budget, 4) as budget, duration, content_rating,
       round(gross, 4) as gross, title_year, imdb_score from t_movies""")
def csv_scan(spark, sf):
    movies = view(spark, sf, "t_movies")
    path = workspace(spark, "csv")
    movies.write.option("header", True).option("escape", '"').csv(path)
    back = readers.read_csv(spark, path, movies.schema)
    return back.withColumns({c: F.round(c, 4) for c in ("budget", "gross")})


def _registered(spark, path, label):
    name = f"{label}_{path.rsplit('-', 1)[1]}"
    schema = readers.read_layer(spark, path).schema
    return catalog.register_table(spark, "cinestrata_checks", name, schema, path)


@query("catalog_table", """
select rating_category, count(*) as n, cast(sum(numVotes) as bigint) as votes
from r_ratings group by rating_category""")
def catalog_table(spark, sf):
    from checks.registry import refined_ratings

    path = workspace(spark, "layer")
    sinks.write_layer(refined_ratings(spark, sf), path)
    full = _registered(spark, path, "ratings_refined")
    catalog.repair_table(spark, full)
    return spark.sql(f"select rating_category, count(*) as n, sum(numVotes) as votes "
                     f"from {full} group by rating_category")


@query("repair_partitions", """
select d as ingestion_day, count(*) as n
from c_ratings, (select 28 as d union all select 29) days group by d""")
def repair_partitions(spark, sf):
    path = workspace(spark, "layer")
    clean = trusted(spark, sf, "ratings")
    sinks.write_layer(sinks.add_ingestion_metadata(clean, RUN_TS), path)
    full = _registered(spark, path, "ratings_trusted")
    sinks.write_layer(sinks.add_ingestion_metadata(clean, "2025-09-29 06:00:00"), path)
    return (catalog.repair_table(spark, full).groupBy("ingestion_day")
            .agg(F.count(F.lit(1)).alias("n")))


@query("schema_merge", """
select tconst, averageRating, null as numVotes, 1 as wave from c_ratings
union all select tconst, averageRating, numVotes, 2 as wave from c_ratings""")
def schema_merge(spark, sf):
    path = workspace(spark, "drift")
    clean = trusted(spark, sf, "ratings")
    clean.drop("numVotes").write.parquet(f"{path}/wave=1")
    clean.write.parquet(f"{path}/wave=2")
    return readers.read_layer(spark, path, merge_schema=True)


@query("layer_audit", """
select 'ratings' as "table", 'trusted' as layer, count(*) as rows, true as ok from c_ratings
union all select 'ratings', 'refined', count(*), true from r_ratings
union all select 'crew', 'trusted', count(*), true from t_crew
union all select 'crew', 'refined', 0, false""")
def layer_audit(spark, sf):
    from checks.registry import refined_ratings

    root = workspace(spark, "audit")
    paths = {(t, layer): f"{root}/{layer}/{t}" for t in ("ratings", "crew")
             for layer in ("trusted", "refined")}
    trusted(spark, sf, "ratings").write.parquet(paths["ratings", "trusted"])
    refined_ratings(spark, sf).write.parquet(paths["ratings", "refined"])
    trusted(spark, sf, "crew").write.parquet(paths["crew", "trusted"])
    # The number of files depends on the machine, so it is tested elsewhere.
    return audit.audit_layers(spark, paths).drop("files")


_PROFILED = ("averageRating", "numVotes", "startYear", "runtimeMinutes")


@query("dataset_profile", " union all ".join(f"""
select '{c}' as "column", count(*) as rows, count({c}) as filled,
       round(cast(min({c}) as double), 4) as min, round(cast(max({c}) as double), 4) as max,
       round(avg({c}), 4) as mean, round(cast(sum({c}) as double), 4) as sum from model_set"""
                                            for c in _PROFILED))
def dataset_profile(spark, sf):
    from checks.registry import model_set

    return rounded(audit.profile(model_set(spark, sf), list(_PROFILED)), 4)


@query("row_reduction", """
select (select count(*) from c_ratings) as rows_before,
       (select count(*) from c_ratings where numVotes >= 100) as rows_after,
       3 as columns,
       round(((select count(*) from c_ratings)
        - (select count(*) from c_ratings where numVotes >= 100)) * 100.0
        / (select count(*) from c_ratings), 4) as reduction_pct""")
def row_reduction(spark, sf):
    clean = trusted(spark, sf, "ratings")
    return rounded(audit.reduction(clean, cleaning.filter_rated(clean)), 4)


# --- cleaning -------------------------------------------------------------------------

def _clean(name, oracle):
    @query(f"clean_{name}", oracle)
    def job(spark, sf):
        return trusted(spark, sf, name)

    return job


_clean("ratings", "select * from c_ratings")
_clean("basics", "select * from c_basics")
_clean("crew", "select * from t_crew where tconst is not null and trim(tconst) <> ''")
_clean("principals", """
select l_orderkey, tconst, cast(ordering as int) as ordering, nconst, category, job, characters
from t_principals
where tconst is not null and nconst is not null and trim(tconst) <> '' and trim(nconst) <> ''""")
_clean("akas", """
select * from t_akas where titleId is not null and title is not null
  and trim(titleId) <> '' and trim(title) <> ''""")
_clean("episode", """
select * from t_episode where tconst is not null and parentTconst is not null
  and trim(tconst) <> '' and trim(parentTconst) <> ''""")
_clean("names", """
select * from t_names where nconst is not null and primaryName is not null
  and trim(nconst) <> '' and trim(primaryName) <> ''""")


@query("clean_basics_strict", """
select * from t_basics where isAdult = 0 and (startYear >= 1900 or startYear is null)""")
def clean_basics_strict(spark, sf):
    return cleaning.clean_basics(view(spark, sf, "t_basics"), strict=True)


@query("clean_generic", """
select parentTconst, tconst, seasonNumber, episodeNumber from t_episode
where parentTconst is not null and trim(parentTconst) <> ''""")
def clean_generic(spark, sf):
    return cleaning.clean_generic(view(spark, sf, "t_episode").select(
        "parentTconst", "tconst", "seasonNumber", "episodeNumber"))


@query("drop_all_null", """
select seasonNumber, episodeNumber from t_episode
where seasonNumber is not null or episodeNumber is not null""")
def drop_all_null(spark, sf):
    return cleaning.drop_all_null(
        view(spark, sf, "t_episode").select("seasonNumber", "episodeNumber"))


_MOVIES = ("movie_id, movie_title, round(budget, 4) as budget, duration, content_rating, "
           "round(gross, 4) as gross, title_year, imdb_score")


@query("drop_any_null", f"""
select {_MOVIES} from t_movies
where budget is not null and duration is not null and content_rating is not null""")
def drop_any_null(spark, sf):
    kept = cleaning.drop_any_null(view(spark, sf, "t_movies"))
    return kept.withColumns({c: F.round(c, 4) for c in ("budget", "gross")})


@query("filter_rated", "select * from c_ratings where numVotes >= 100")
def filter_rated(spark, sf):
    return cleaning.filter_rated(trusted(spark, sf, "ratings"))


@query("filter_movies", """
select * from c_basics where titleType = 'movie' and startYear between 1980 and 2023
  and runtimeMinutes between 60 and 300 and genres is not null and genres <> '\\N'""")
def filter_movies(spark, sf):
    return cleaning.filter_movies(trusted(spark, sf, "basics"))


@query("drop_leakage_columns", """
select movie_title, round(budget, 4) as budget, duration, content_rating, title_year, imdb_score
from t_movies""")
def drop_leakage_columns(spark, sf):
    kept = columns.drop_columns(view(spark, sf, "t_movies"), ["movie_id", "gross"])
    return kept.withColumn("budget", F.round("budget", 4))


@query("drop_by_pattern", """
select nconst, birthYear, deathYear, primaryProfession, name_likes from (
  select *, length(primaryName) as name_likes from t_names) x""".replace(
    "length(primaryName)", "cast(length(primaryName) as int)"))
def drop_by_pattern(spark, sf):
    named = view(spark, sf, "t_names").withColumn("name_likes", F.length("primaryName"))
    return columns.drop_columns_matching(
        named, include=("Name", "name", "known", "link", "index"), keep=("likes",))


@query("select_numeric", """
select movie_id, round(budget, 4) as budget, duration, round(gross, 4) as gross, title_year,
       imdb_score from t_movies""")
def select_numeric(spark, sf):
    return columns.select_numeric(view(spark, sf, "t_movies")).withColumns(
        {c: F.round(c, 4) for c in ("budget", "gross")})


@query("fill_zero", """
select tconst, coalesce(startYear, 0) as startYear, coalesce(runtimeMinutes, 0) as runtimeMinutes,
       endYear from t_basics""")
def fill_zero(spark, sf):
    basics = view(spark, sf, "t_basics").select("tconst", "startYear", "runtimeMinutes", "endYear")
    return columns.fill_zero(basics, ["startYear", "runtimeMinutes"])


@query("fill_na_string", """
select movie_id, coalesce(content_rating, 'na') as content_rating, duration from t_movies""")
def fill_na_string(spark, sf):
    return columns.fill_na_string(
        view(spark, sf, "t_movies").select("movie_id", "content_rating", "duration"))


@query("reconciled_types", """
select l_orderkey, l_linenumber, cast(l_quantity as double) as amount,
       case when l_orderkey % 3 = 2 then l_returnflag end as flag, cast(l_orderkey % 3 as int) as part
from lineitem""")
def reconciled_types(spark, sf):
    """Three loads of one table whose amount was written as int, long and double, read as one."""
    path = workspace(spark, "loads")
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    keys = ["l_orderkey", "l_linenumber"]
    for part, kind in enumerate(("int", "long", "double")):
        more = ["l_returnflag as flag"] if part == 2 else []
        rows = lines.where(F.col("l_orderkey") % 3 == part)
        rows.selectExpr(*keys, f"cast(l_quantity as {kind}) as amount", *more).write.parquet(
            f"{path}/part={part}")
    return reconcile.read_reconciled(spark, path)


_FOOTED = ("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice")


@query("footer_profile", " union all ".join(
    f"select '{c}' as \"column\", count(*) as rows, count({c}) as filled, min({c})::double as min, "
    f"max({c})::double as max from lineitem" for c in _FOOTED))
def footer_profile(spark, sf):
    """Ranges of a table's columns from its footers alone."""
    return footers.footer_profile(spark, f"{sf}/lineitem.parquet", _FOOTED)


@query("bloom_lookup", """
select o_orderkey, o_custkey from (select *, 'o' || md5(cast(o_orderkey as varchar)) as id from orders)
where o_orderkey % 1500 = 7""")
def bloom_lookup(spark, sf):
    """Orders looked up by scattered text ids in a table with Bloom filters."""
    orders = spark.read.parquet(f"{sf}/orders.parquet").select(
        F.concat(F.lit("o"), F.md5(F.col("o_orderkey").cast("string"))).alias("id"),
        "o_orderkey", "o_custkey")
    path = workspace(spark, "bloom")
    sinks.write_lookup(orders, path, "id", rows_per_file=2000)
    wanted = [r["id"] for r in orders.where("o_orderkey % 1500 = 7").select("id").collect()]
    return lookup.lookup(spark.read.parquet(path), wanted, "id").drop("id")


@query("concurrent_runs", """
select tconst, numVotes, is_popular, 1 as runs from r_ratings""")
def concurrent_runs(spark, sf):
    """Four runs of one date at a time: one of them writes."""
    root = workspace(spark, "layers")
    cfg = RunConfig(root, RUN_TS, 2024)
    path = f"{root}/raw/{TABLES['ratings'].file_name}"
    readers.write_raw_tsv(view(spark, sf, "t_ratings"), path)
    with ThreadPoolExecutor(4) as pool:
        ran = [pool.submit(run_table, spark, "ratings", cfg, path) for _ in range(4)]
        runs = sum(r.result() for r in ran)
    return readers.read_layer(spark, cfg.path("refined", "ratings")).select(
        "tconst", "numVotes", "is_popular", F.lit(runs).alias("runs"))
