"""The list of checked queries: a Spark job each, with its SQL counterpart if there is one."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from checks.views import VIEWS, load, view_sql
from cinestrata.operators import cleaning
from cinestrata.plans.reports import refine_ratings
from cinestrata.plans.assembly import build_model_set
from cinestrata.sources.sinks import add_ingestion_metadata

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

RUN_TS = "2025-09-28 12:00:00"
AS_OF_YEAR = 2024

# Steps shared by several oracle queries, on top of the views.
STEPS = {
    "c_ratings": """
select tconst, averageRating, cast(numVotes as int) as numVotes from t_ratings
where averageRating >= 1 and averageRating <= 10 and numVotes >= 5""",
    "r_ratings": """
select tconst, averageRating, numVotes, ln(1 + numVotes) as log_votes,
       (averageRating - 1) / 9 as rating_normalized,
       case when averageRating <= 4 then 'poor' when averageRating <= 6 then 'fair'
            when averageRating <= 7 then 'good' when averageRating <= 8 then 'very_good'
            else 'excellent' end as rating_category,
       case when numVotes >= (select quantile_cont(numVotes, 0.8) from c_ratings)
            then 1 else 0 end as is_popular
from c_ratings""",
    "c_basics": """
select * from t_basics
where tconst is not null and titleType is not null and primaryTitle is not null""",
    "model_set": """
select r.tconst, r.averageRating, r.numVotes, b.titleType, b.primaryTitle, b.isAdult,
       b.startYear, b.endYear, b.runtimeMinutes, b.genres,
       trim(split_part(b.genres, ',', 1)) as primary_genre
from c_ratings r join c_basics b on r.tconst = b.tconst
where r.numVotes >= 100 and b.titleType = 'movie' and b.startYear between 1980 and 2023
  and b.runtimeMinutes between 60 and 300 and b.genres is not null and b.genres <> '\\N'""",
    "bucketed": """
select *, cast(('0x' || substr(md5(tconst), 1, 8)) as bigint) % 100 as bucket from model_set""",
    "genre_fit": """
select primary_genre, avg(averageRating) as genre_mean from bucketed
where bucket >= 33 group by primary_genre""",
    "scored": """
select t.tconst, t.primaryTitle, t.genres, t.numVotes, t.startYear, t.runtimeMinutes,
       t.averageRating as actual_rating,
       coalesce(g.genre_mean, (select avg(averageRating) from bucketed where bucket >= 33))
         as predicted_rating
from bucketed t left join genre_fit g on t.primary_genre = g.primary_genre
where t.bucket < 33""",
}


def _with_steps(body: str) -> str:
    """``body`` preceded by the views and steps it needs, in order."""
    known = {**{n: view_sql(n) for n in VIEWS}, **{n: s.strip() for n, s in STEPS.items()}}
    needed: set[str] = set()
    pending = [body]
    while pending:
        text = pending.pop()
        for name in known:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                pending.append(known[name])
    ctes = ",\n".join(f"{n} as (\n{known[n]}\n)" for n in known if n in needed)
    body = body.strip()
    recursive = "recursive " if body.lower().startswith("with recursive ") else ""
    if body.lower().startswith("with "):
        rest = body[len("with ") + len(recursive):]
        return f"with {recursive}{ctes},\n{rest}" if ctes else body
    return f"with {ctes}\n{body}" if ctes else body


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a Spark job under its name, with the SQL it must agree with."""
    def add(job: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = job
        if oracle is not None:
            ORACLES[name] = _with_steps(oracle)
        return job

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, because engines add them up in different orders; no negative zero."""
    return df.select(*[
        (F.round(F.col(f"`{f.name}`"), digits) + F.lit(0.0)).alias(f.name)
        if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
        for f in df.schema])


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load(spark, sf_dir, name)


def trusted(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view cleaned as its table."""
    return cleaning.CLEANERS[name](view(spark, sf_dir, f"t_{name}"))


def refined_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refine_ratings(add_ingestion_metadata(trusted(spark, sf_dir, "ratings"), RUN_TS))


def model_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_model_set(trusted(spark, sf_dir, "ratings"), trusted(spark, sf_dir, "basics"))
