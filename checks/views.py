"""Test inputs with the shapes of the seven logical tables, as SQL over the given tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

SOURCE_TABLES = ("part", "lineitem", "orders", "customer", "supplier")

VIEWS = {
    "t_basics": """
select 'tt' || lpad(cast(p_partkey as string), 7, '0') as tconst,
       case p_partkey % 4 when 1 then 'tvSeries' when 2 then 'short' else 'movie' end as titleType,
       p_name as primaryTitle,
       case when p_partkey % 50 = 0 then 1 else 0 end as isAdult,
       case when p_partkey % 17 = 0 then null else cast(1890 + (p_partkey * 37) % 134 as int) end as startYear,
       case when p_partkey % 9 = 0 then cast(1895 + (p_partkey * 37) % 134 as int) end as endYear,
       case when p_partkey % 13 = 0 then null else cast(p_size * 6 as int) end as runtimeMinutes,
       case when p_partkey % 11 = 0 then null else
         (case p_type when 'ECONOMY' then 'Drama' when 'STANDARD' then 'Comedy' when 'PROMO' then 'Action'
                      when 'SMALL' then 'Sci-Fi' when 'MEDIUM' then 'Music' else 'Musical' end)
         || (case p_size % 4 when 0 then ',Romance' when 1 then ',War' when 2 then ',Thriller,Crime' else '' end)
       end as genres
from part
""",
    "t_ratings": """
select 'tt' || lpad(cast(p.p_partkey as string), 7, '0') as tconst,
       cast((p.p_partkey * 7919) % 101 as double) / 10.0 as averageRating,
       case when p.p_partkey % 23 = 0 then cast(p.p_partkey % 7 as bigint)
            else q.qty * (1 + p.p_partkey % 20) end as numVotes
from part p
left join (select l_partkey, cast(sum(l_quantity) as bigint) as qty from lineitem group by l_partkey) q
  on p.p_partkey = q.l_partkey
""",
    "t_crew": """
select 'tt' || lpad(cast(p_partkey as string), 7, '0') as tconst,
       case p_partkey % 4 when 0 then null
            when 1 then 'nm' || cast(p_partkey % 100 as string)
            else 'nm' || cast(p_partkey % 100 as string) || ',nm' || cast((p_partkey + 7) % 100 as string) end as directors,
       case p_partkey % 3 when 0 then null
            when 1 then 'nm' || cast(p_partkey % 90 as string)
            else 'nm' || cast(p_partkey % 90 as string) || ',nm' || cast((p_partkey + 3) % 90 as string)
                 || ',nm' || cast((p_partkey + 5) % 90 as string) || ',nm' || cast((p_partkey + 11) % 90 as string) end as writers
from part
""",
    "t_principals": """
select l_orderkey, 'tt' || lpad(cast(l_partkey as string), 7, '0') as tconst,
       case when l_orderkey % 19 = 0 then null else l_linenumber * 2 - 1 end as ordering,
       'nm' || cast(l_suppkey as string) as nconst,
       case (l_suppkey + l_linenumber) % 8 when 0 then 'actor' when 1 then 'actress' when 2 then 'director'
            when 3 then 'producer' when 4 then 'writer' when 5 then 'composer' when 6 then 'editor' end as category,
       case when l_suppkey % 3 = 0 then 'lead ' || l_returnflag end as job,
       case when l_suppkey % 2 = 0 then '["' || l_linestatus || '"]' end as characters
from lineitem
""",
    "t_akas": """
select l_orderkey, 'tt' || lpad(cast(l_partkey as string), 7, '0') as titleId, l_linenumber as ordering,
       case when l_suppkey % 29 = 0 then '  ' else 'Title ' || cast(l_suppkey as string) end as title,
       case l_suppkey % 3 when 0 then null when 1 then 'BR' else 'US' end as region,
       case l_suppkey % 4 when 0 then 'pt' when 1 then 'en' end as language,
       case when l_linenumber = 1 then 'original' end as types,
       case when l_suppkey % 5 = 0 then 'literal title' end as attributes,
       case when l_orderkey % 23 = 0 then null when l_linenumber = 1 then '1' else '0' end as isOriginalTitle
from lineitem
""",
    "t_episode": """
select 'tt' || lpad(cast(o_orderkey as string), 7, '0') as tconst,
       case when o_orderkey % 31 = 0 then '' else 'tt' || lpad(cast(o_custkey as string), 7, '0') end as parentTconst,
       case when o_orderkey % 10 = 0 then null else cast(1 + (o_orderkey % 9) as int) end as seasonNumber,
       case when o_orderkey % 7 = 0 then null else cast(1 + (o_orderkey % 24) as int) end as episodeNumber
from orders
""",
    "t_names": """
select 'nm' || cast(c_custkey as string) as nconst,
       case when c_custkey % 41 = 0 then null else c_name end as primaryName,
       case when c_custkey % 8 = 0 then null else cast(1905 + (c_custkey * 31) % 100 as int) end as birthYear,
       case when c_custkey % 5 = 0 then cast(1960 + (c_custkey * 13) % 60 as int) end as deathYear,
       case c_custkey % 6 when 0 then null when 1 then 'actor' when 2 then 'actress,writer' when 3 then 'director,producer'
            when 4 then 'assistant_director' else 'writer,director,actor' end as primaryProfession,
       case c_custkey % 5 when 0 then null when 1 then 'tt1' when 2 then 'tt1,tt2' when 3 then 'tt1,tt2,tt3' else 'tt1,tt2,tt3,tt4' end as knownForTitles
from customer
""",
    "t_movies": """
select o_orderkey as movie_id, 'Movie ' || cast(o_orderkey as string) as movie_title,
       case when o_orderkey % 12 = 0 then null else o_totalprice * 100 end as budget,
       case when o_orderkey % 15 = 0 then null else cast(60 + o_orderkey % 120 as double) end as duration,
       case when o_orderkey % 18 = 0 then null else o_orderpriority end as content_rating,
       o_totalprice * 3 as gross,
       cast(year(o_orderdate) as int) as title_year,
       cast((o_orderkey * 7919) % 91 as double) / 10.0 + 1.0 as imdb_score
from orders
""",
}


def view_sql(name: str) -> str:
    return VIEWS[name].strip()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a DataFrame over the parquet tables of ``sf_dir``."""
    text = view_sql(name)
    used = [t for t in SOURCE_TABLES if re.search(rf"\bfrom {t}\b", text)]
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used}
    for t in used:
        text = re.sub(rf"\bfrom {t}\b", f"from {{{t}}}", text)
    return spark.sql(text, **tables)
