"""Arriving data: rejected rows, late batches, sketches of batches, ranks of residuals."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.incremental import _arrive
from checks.models import P, Y, _R, _scored
from checks.registry import AS_OF_YEAR, RUN_TS, query, rounded, trusted, view
from cinestrata.operators import sketches
from cinestrata.operators.ordering import bucket
from cinestrata.operators.ranks import normal_cdf
from cinestrata.plans import evaluation
from cinestrata.plans.layers import RunConfig, run_table
from cinestrata.schema import NULL_TOKEN, TABLES
from cinestrata.session import materialised, workspace
from cinestrata.sources import quarantine, readers
from cinestrata.streaming import incremental

_KEY = "cast(substr(tconst, 3) as int)"
# Some rows are broken on purpose: a cell is missing, votes are no number, the key is missing.
_BROKEN = f"""
select *, {_KEY} % 2 + 1 as day, case when {_KEY} % 97 = 0 then 'cells: 2 of 3'
    when {_KEY} % 83 = 0 then 'no key: tconst'
    when {_KEY} % 89 = 0 then 'not int: numVotes' end as reason
from t_ratings"""


def _broken_files(spark, sf, root, folder=""):
    """Two days of raw files of ratings, some of whose lines are no rows."""
    rows = view(spark, sf, "t_ratings").withColumn("k", F.expr(_KEY))

    def cell(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(NULL_TOKEN))

    key = F.when((F.col("k") % 83 == 0) & (F.col("k") % 97 != 0), F.lit(NULL_TOKEN)).otherwise(
        cell("tconst"))
    votes = F.when(F.col("k") % 89 == 0, F.lit("many")).otherwise(cell("numVotes"))
    line = F.when(F.col("k") % 97 == 0, F.concat_ws("\t", cell("tconst"), cell("averageRating"))
                  ).otherwise(F.concat_ws("\t", key, cell("averageRating"), votes))
    name = "\t".join(TABLES["ratings"].columns)
    lines = rows.select((F.col("k") % 2 + 1).alias("day"), line.alias(name))
    for day in (1, 2):
        (lines.where(F.col("day") == day).select(F.col(f"`{name}`")).repartition(2).write
         .option("header", True).option("sep", "\x01").option("quote", "").option(
             "compression", "gzip").csv(f"{root}/raw/day{day}/{folder}"))


@query("quarantine_counts", f"""
with b as ({_BROKEN})
select 'day' || day as day, 'read' as what, count(*) as n from b group by day
union all select 'day' || day, 'good', count(*) from b where reason is null group by day
union all select 'day' || day, reason, count(*) from b where reason is not null group by all""")
def quarantine_counts(spark, sf):
    """Rows read and good by day, and rejected ones by day and reason."""
    root = workspace(spark, "quarantine")
    _broken_files(spark, sf, root)
    quarantine.ingest_checked(spark, f"{root}/raw", "ratings", root)
    day = F.regexp_extract("file", "/(day[0-9]+)/", 1).alias("day")
    files = spark.read.parquet(f"{root}/counts")
    sums = files.groupBy(day).agg(F.sum("read").alias("read"), F.sum("good").alias("good"))
    split = sums.select("day", F.expr("stack(2, 'read', read, 'good', good) as (what, n)"))
    why = quarantine.read_rejects(spark, root).groupBy(day, F.col("reason").alias("what")).agg(
        F.count(F.lit(1)).alias("n"))
    return split.unionByName(why)


@query("quarantine_stream", f"""
with b as ({_BROKEN})
select tconst, averageRating, cast(numVotes as int) as numVotes, null as reason from b
where reason is null and averageRating >= 1 and averageRating <= 10 and numVotes >= 5
union all select case when reason like 'no key%' then null else tconst end, averageRating, null, reason
from b where reason is not null""")
def quarantine_stream(spark, sf):
    """Cleaned good rows and, beside them, the rejected ones, from a stream of one file a batch."""
    root = workspace(spark, "quarantine")
    _broken_files(spark, sf, root)
    quarantine.ingest_checked_stream(spark, f"{root}/raw", "ratings", root, files_per_batch=1)
    good = spark.read.parquet(f"{root}/rows").select(
        "tconst", "averageRating", "numVotes", F.lit(None).cast("string").alias("reason"))
    cells = F.split("text", "\t")
    return good.unionByName(quarantine.read_rejects(spark, root).select(
        F.nullif(cells[0], F.lit(NULL_TOKEN)).alias("tconst"),
        F.expr("try_cast(split(text, '\\t')[1] as double)").alias("averageRating"),
        F.lit(None).cast("int").alias("numVotes"), "reason"))


@query("late_batch", "select tconst, numVotes, rating_category, is_popular from r_ratings")
def late_batch(spark, sf):
    """A run of most ratings and a late batch of one in a hundred: the same as one run."""
    root = workspace(spark, "late")
    cfg = RunConfig(root, RUN_TS, AS_OF_YEAR)
    rows = view(spark, sf, "t_ratings")
    late = bucket("tconst") == 0
    _arrive(rows.where(~late), "ratings", f"{root}/raw", "day1")
    _arrive(rows.where(late), "ratings", f"{root}/raw", "day2")
    file = TABLES["ratings"].file_name
    run_table(spark, "ratings", cfg, f"{root}/raw/day1/{file}")
    incremental.incremental_medallion(spark, f"{root}/raw", "ratings", cfg, f"{root}/checkpoint",
                                      layout=f"day2/{file}")
    return readers.read_layer(spark, cfg.path("refined", "ratings")).select(
        "tconst", "numVotes", "rating_category", "is_popular")


@query("approx_vote_threshold", """
select count(*) as n, 4 as batches, true as within_error, true as whole_within_error
from c_ratings""")
def approx_vote_threshold(spark, sf):
    """The popularity threshold from sketches of four batches, and from one of all rows.

    Both estimates must lie within the sketch's error of the wanted rank among all votes.
    """
    rows = materialised(trusted(spark, sf, "ratings").select("tconst", "numVotes"), "votes")
    store = sketches.SketchStore(spark, f"{workspace(spark, 'sketch')}/votes", "numVotes")
    for i in range(4):
        store.add(rows.where(bucket("tconst", 4) == i), f"b{i}")
    merged, share = store.quantile(0.8), 0.8
    whole = sketches.quantiles(sketches.sketched(rows, "numVotes"), [share]).first()["value"]
    votes, error = F.col("numVotes"), sketches.rank_error()

    def near(estimate):
        """The ranks of the estimate's value reach into the error around the share."""
        return ((F.avg((votes < estimate).cast("double")) <= share + error)
                & (F.avg((votes <= estimate).cast("double")) >= share - error))

    batches = store.batches().agg(F.count(F.lit(1)).cast("int")).scalar()
    return rows.agg(F.count("numVotes").alias("n"), near(merged).alias("within_error"),
                    near(whole).alias("whole_within_error")).withColumn("batches", batches)


@query("ks_normality", f"""
with s as (select count(*) as n, avg(r) as m, stddev_samp(r) as sd from {_R}),
v as (select r, count(*) as c from {_R} group by r),
e as (select r, c, sum(c) over (order by r) as upto from v),
p as (select *, {normal_cdf('((r - m) / sd)')} as p from e, s),
d as (select any_value(n) as n, max(greatest(upto / n::double - p, p - (upto - c) / n::double)) as d
      from p),
l as (select *, (sqrt(n) + 0.12 + 0.11 / sqrt(n)) * d as l from d)
select n, round(d, 9) as statistic, round(case when l < 0.2 then 1.0 else least(1.0, greatest(0.0,
  list_sum(list_transform(range(1, 101), lambda k:
    2 * case when k % 2 = 1 then 1.0 else -1.0 end * exp(-2.0 * k * k * l * l))))) end, 6) as p_value
from l""")
def ks_normality(spark, sf):
    found = evaluation.ks_test(_scored(spark, sf), Y, P)
    return rounded(found, 9).withColumn("p_value", F.round("p_value", 6))


@query("layers_with_rejects", f"""
with b as ({_BROKEN}),
good as (select * from b where reason is null and averageRating >= 1 and averageRating <= 10
         and numVotes >= 5)
select tconst, cast(numVotes as int) as numVotes, case when numVotes >=
    (select quantile_cont(numVotes, 0.8) from good) then 1 else 0 end as is_popular,
  null as reason, cast(0 as bigint) as n from good
union all select null, null, null, reason, count(*) from b where reason is not null group by reason""")
def layers_with_rejects(spark, sf):
    """A batch run of the first day and a stream of the second: refined rows and the rejects' reasons."""
    root = workspace(spark, "layers")
    cfg = RunConfig(root, RUN_TS, AS_OF_YEAR, keep_rejects=True)
    file = TABLES["ratings"].file_name
    _broken_files(spark, sf, f"{root}/given", file)
    run_table(spark, "ratings", cfg, f"{root}/given/raw/day1/{file}")
    incremental.incremental_medallion(spark, f"{root}/given/raw", "ratings", cfg,
                                      f"{root}/checkpoint", layout=f"day2/{file}")
    rows = readers.read_layer(spark, cfg.path("refined", "ratings")).select(
        "tconst", "numVotes", "is_popular", F.lit(None).cast("string").alias("reason"),
        F.lit(0).cast("long").alias("n"))
    why = spark.read.parquet(cfg.path("rejects", "ratings")).groupBy("reason").agg(
        F.count(F.lit(1)).alias("n"))
    none = F.lit(None)
    return rows.unionByName(why.select(
        none.cast("string").alias("tconst"), none.cast("int").alias("numVotes"),
        none.cast("int").alias("is_popular"), "reason", "n"))
