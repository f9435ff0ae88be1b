"""Models, evaluation and scoring.

Linear models of whole matrices and larger trees are in their own modules.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import (
    AS_OF_YEAR, model_set, query, refined_ratings, rounded, view)
from cinestrata.functions import modelset
from cinestrata.operators import ordering, scaling
from cinestrata.plans import assembly, evaluation, models, scoring
from cinestrata.session import materialised, workspace

Y, P = "actual_rating", "predicted_rating"
LABEL = assembly.LABEL


def _with_genre(spark, sf):
    movies = model_set(spark, sf).withColumn("primary_genre", modelset.primary_genre())
    return materialised(movies, "model_set")


def _parts(spark, sf):
    return ordering.split(_with_genre(spark, sf), "tconst", 33)


def _scored(spark, sf):
    """The test part with the first genre's training mean as its prediction.

    Predictions are rounded, so that later comparisons see the same numbers in both engines.
    """
    train, test = _parts(spark, sf)
    predicted = models.fit_group_mean(train, "primary_genre").transform(test)
    return materialised(predicted.select(
        "tconst", "primaryTitle", "genres", "numVotes", "startYear", "runtimeMinutes",
        F.col(LABEL).alias(Y), F.round("prediction", 6).alias(P)), "scored")


_S = ("(select tconst, primaryTitle, genres, numVotes, startYear, runtimeMinutes, actual_rating, "
      "round(predicted_rating, 6) as predicted_rating from scored) s")
_R = f"(select *, actual_rating - predicted_rating as r from {_S}) r"


@query("genre_mean_predictor", f"select * from {_S}")
def genre_mean_predictor(spark, sf):
    return _scored(spark, sf)


# --- linear models ----------------------------------------------------------------------

def _two_features(spark, sf):
    train, _ = _parts(spark, sf)
    train = train.select("tconst", LABEL, "runtimeMinutes", "startYear")
    return scaling.standardize(train, train, ["runtimeMinutes", "startYear"])


_SUMS = """
with t as (select averageRating as y,
             (runtimeMinutes - avg(runtimeMinutes) over ()) / stddev_pop(runtimeMinutes) over ()
               as a,
             (startYear - avg(startYear) over ()) / stddev_pop(startYear) over () as b
           from bucketed where bucket >= 33),
s as (select count(*) as n, covar_pop(a, y) as ca, covar_pop(b, y) as cb, covar_pop(a, b) as r,
             avg(y) as m from t)"""


@query("linreg_fit", """
select 'runtimeMinutes' as feature, round(regr_slope(averageRating, runtimeMinutes), 6)
  as coefficient from bucketed where bucket >= 33
union all select '(intercept)', round(regr_intercept(averageRating, runtimeMinutes), 6)
from bucketed where bucket >= 33""")
def linreg_fit(spark, sf):
    train, _ = _parts(spark, sf)
    return rounded(models.coefficients(spark, models.fit_linear(train, ["runtimeMinutes"])))


@query("ridge_fit", _SUMS + """
select 'runtimeMinutes' as feature,
  round(n * ((n + 1) * ca - n * r * cb) / (pow(n + 1, 2) - pow(n * r, 2)), 4) as coefficient from s
union all select 'startYear',
  round(n * ((n + 1) * cb - n * r * ca) / (pow(n + 1, 2) - pow(n * r, 2)), 4) from s
union all select '(intercept)', round(m, 4) from s""")
def ridge_fit(spark, sf):
    model = models.fit_ridge(_two_features(spark, sf), ["runtimeMinutes", "startYear"])
    return rounded(models.coefficients(spark, model), 4)


# Every active set and sign pattern has a closed form; the least objective among those
# that agree with their own signs is the lasso solution.
_LASSO = _SUMS + """,
signs as (select sa, sb from (values (-1), (0), (1)) x(sa), (values (-1), (0), (1)) z(sb)),
cand as (select *, 0.01 as alpha,
  case when sa = 0 then 0 when sb = 0 then ca - 0.01 * sa
       else ((ca - 0.01 * sa) - r * (cb - 0.01 * sb)) / (1 - r * r) end as wa,
  case when sb = 0 then 0 when sa = 0 then cb - 0.01 * sb
       else ((cb - 0.01 * sb) - r * (ca - 0.01 * sa)) / (1 - r * r) end as wb
  from s, signs),
best as (select * from cand where sign(wa) = sa and sign(wb) = sb
  order by (wa * wa + wb * wb) / 2 + r * wa * wb - ca * wa - cb * wb
           + 0.01 * (abs(wa) + abs(wb)) limit 1)"""


@query("lasso_fit", _LASSO + """
select 'runtimeMinutes' as feature, round(wa, 3) + 0.0 as coefficient from best
union all select 'startYear', round(wb, 3) + 0.0 from best
union all select '(intercept)', round(m, 3) + 0.0 from best""")
def lasso_fit(spark, sf):
    model = models.fit_lasso(_two_features(spark, sf), ["runtimeMinutes", "startYear"])
    return rounded(models.coefficients(spark, model), 3)


@query("lasso_selected", _LASSO + """
select 'runtimeMinutes' as feature, round(wa, 3) as coefficient from best where wa <> 0
union all select 'startYear', round(wb, 3) from best where wb <> 0""")
def lasso_selected(spark, sf):
    model = models.fit_lasso(_two_features(spark, sf), ["runtimeMinutes", "startYear"])
    return rounded(models.selected_features(spark, model), 3)


# --- whole feature matrices ---------------------------------------------------------------

def _matrix(spark, sf, version=2):
    """(train, test, features); statistics come from the training part."""
    movies = materialised(model_set(spark, sf), "model_set")
    fit_on, _ = ordering.split(movies, "tconst", 33)
    build = assembly.assemble_v2 if version == 2 else assembly.assemble_v1
    matrix, names = build(movies, AS_OF_YEAR, fit_on=fit_on)
    train, test = ordering.split(materialised(matrix, "matrix"), "tconst", 33)
    return train, test, names


def _test_metrics(model, test):
    return evaluation.metrics(model.transform(test), LABEL, "prediction")


def _stump_oracle(trees: int) -> str:
    """A tree of one split on the decade, by all splits; the second tree fits what is left."""
    steps, total, rate = [], "0.0", "1.0"
    for i in range(trees):
        y = f"2 * (y - ({total}))" if i else "y"
        source = "t" if i == 0 else f"(select * from t, s{i - 1})"
        if i == 2:
            raise ValueError("written for two trees")
        steps.append(f"""
g{i} as (select x, count(*) as n, sum({y}) as s from {source} t group by x),
c{i} as (select x, sum(n) over (order by x) as nl, sum(s) over (order by x) as sl,
               sum(n) over () as n, sum(s) over () as s from g{i}),
s{i} as (select x as cut{i}, sl / nl as left{i}, (s - sl) / (n - nl) as right{i} from c{i}
       where nl < n order by sl * sl / nl + (s - sl) * (s - sl) / (n - nl) desc, x limit 1)""")
        total += f" + {rate} * case when x <= cut{i} then left{i} else right{i} end"
        rate = "0.1"
    return (f"with d as (select tconst, bucket, floor(startYear / 10) * 10 as x, "
            f"averageRating as y from bucketed), t as (select * from d where bucket >= 33),"
            f"{','.join(steps)} select tconst, round({total}, 6) as prediction "
            f"from d{''.join(f', s{i}' for i in range(trees))} where bucket < 33")


def _stump_parts(spark, sf):
    rows = model_set(spark, sf).select("tconst", LABEL, modelset.decade().alias("decade"))
    return ordering.split(materialised(rows, "decades"), "tconst", 33)


@query("rf_stump", _stump_oracle(1))
def rf_stump(spark, sf):
    train, test = _stump_parts(spark, sf)
    model = models.fit_forest(train, ["decade"], trees=1, max_depth=1, bootstrap=False)
    return rounded(model.transform(test).select("tconst", "prediction"))


@query("gbt_stumps", _stump_oracle(2))
def gbt_stumps(spark, sf):
    train, test = _stump_parts(spark, sf)
    model = models.fit_gbt(train, ["decade"], trees=2, depth=1, subsample=1.0)
    return rounded(model.transform(test).select("tconst", "prediction"))


@query("model_roundtrip", """
select count(*) as rows, cast(0 as bigint) as changed, 39 as n_features
from bucketed where bucket < 33""")
def model_roundtrip(spark, sf):
    train, test, names = _matrix(spark, sf)
    fitted = models.fit_forest_regularised(train, names)
    path = workspace(spark, "model")
    models.save_model(spark, fitted, path, {"features": names, "metrics": {"r2_cv": 0.4}})
    loaded, info = models.load_model(spark, path)
    # Scored by both models one after the other: loading must change no prediction.
    before = fitted.transform(test).select("*", F.col("prediction").alias("before")).drop(
        "features", "prediction")
    return loaded.transform(before).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("before") != F.col("prediction")).alias("changed"),
        F.lit(len(info["features"])).alias("n_features"))


# --- ensembles, folds, comparison -----------------------------------------------------------

_MEANS = """
with train as (select * from bucketed where bucket >= 33),
o as (select avg(averageRating) as m from train),
g as (select primary_genre, avg(averageRating) as m from train group by primary_genre),
y as (select startYear, avg(averageRating) as m from train group by startYear),
p as (select t.tconst, t.averageRating, coalesce(g.m, o.m) as pg, coalesce(y.m, o.m) as py,
             o.m as po
      from bucketed t cross join o left join g on t.primary_genre = g.primary_genre
      left join y on t.startYear = y.startYear where t.bucket < 33)"""


def _three(train):
    return [models.fit_group_mean(train, "primary_genre"),
            models.fit_group_mean(train, "startYear"), models.fit_mean(train)]


@query("ensemble_mean", _MEANS + " select tconst, round((pg + py) / 2, 6) as prediction from p")
def ensemble_mean(spark, sf):
    train, test = _parts(spark, sf)
    mixed = models.ensemble(test, _three(train)[:2])
    return rounded(mixed.select("tconst", "prediction"))


@query("ensemble_weighted",
       _MEANS + " select tconst, round((2 * pg + 2 * py + po) / 5, 6) as prediction from p")
def ensemble_weighted(spark, sf):
    train, test = _parts(spark, sf)
    mixed = models.ensemble(test, _three(train), [2, 2, 1])
    return rounded(mixed.select("tconst", "prediction"))


def _sql_metrics(p):
    return (f"1 - avg(pow(averageRating - {p}, 2)) / var_pop(averageRating) as r2, "
            f"sqrt(avg(pow(averageRating - {p}, 2))) as rmse, "
            f"avg(abs(averageRating - {p})) as mae")


@query("model_comparison", _MEANS + f""",
a as (select 'genre' as model, {_sql_metrics('pg')} from p
      union all select 'year', {_sql_metrics('py')} from p
      union all select 'overall', {_sql_metrics('po')} from p),
b as (select r2 as base from a where model = 'genre')
select model, round(r2, 6) as r2, round(rmse, 6) as rmse, round(mae, 6) as mae,
       round(r2 - base, 6) as gain, round((r2 - base) / base * 100, 4) as improvement_pct,
       case when model = (select model from a order by round(r2, 9) desc, model desc limit 1)
            then 1 else 0 end as is_best
from a, b""")
def model_comparison(spark, sf):
    train, test = _parts(spark, sf)
    named = dict(zip(("genre", "year", "overall"), _three(train)))
    table = evaluation.compare_models(
        {n: _test_metrics(m, test) for n, m in named.items()}, baseline="genre")
    return rounded(table.withColumn("improvement_pct", F.round("improvement_pct", 4)))


@query("kfold_scores", """
with f as (select averageRating as y,
             cast(('0x' || substr(md5(tconst), 1, 8)) as bigint) % 5 as fold from model_set),
s as (select i.fold, 1 - avg(pow(f.y - i.m, 2)) / nullif(var_pop(f.y), 0) as r2
      from (select k.fold, avg(f.y) as m from f join (select distinct fold from f) k
            on f.fold <> k.fold group by k.fold) i
      join f on f.fold = i.fold group by i.fold)
select count(r2) as folds, round(avg(r2), 6) as mean_r2, round(stddev_pop(r2), 6) as std_r2,
       round(min(r2), 6) as min_r2, round(max(r2), 6) as max_r2 from s""")
def kfold_scores(spark, sf):
    return rounded(models.kfold(model_set(spark, sf), models.fit_mean, 5))


@query("kfold_scores_linear", """
with f as (select averageRating as y, runtimeMinutes as x,
             cast(('0x' || substr(md5(tconst), 1, 8)) as bigint) % 3 as fold from model_set),
m as (select k.fold, regr_slope(f.y, f.x) as a, regr_intercept(f.y, f.x) as b
      from f join (select distinct fold from f) k on f.fold <> k.fold group by k.fold),
s as (select 1 - avg(pow(f.y - a * f.x - b, 2)) / var_pop(f.y) as r2
      from f join m on f.fold = m.fold group by f.fold)
select count(r2) as folds, round(avg(r2), 6) as mean_r2, round(stddev_pop(r2), 6) as std_r2,
       round(min(r2), 6) as min_r2, round(max(r2), 6) as max_r2 from s""")
def kfold_scores_linear(spark, sf):
    movies = materialised(model_set(spark, sf), "model_set")
    return rounded(models.kfold(
        movies, lambda part: models.fit_linear(part, ["runtimeMinutes"]), 3))


@query("kfold_scores_ensemble", """
with f as (select averageRating as y, runtimeMinutes as x,
             cast(('0x' || substr(md5(tconst), 1, 8)) as bigint) % 3 as fold from model_set),
m as (select k.fold, regr_slope(f.y, f.x) as a, regr_intercept(f.y, f.x) as b, avg(f.y) as c
      from f join (select distinct fold from f) k on f.fold <> k.fold group by k.fold),
s as (select 1 - avg(pow(f.y - (3 * (a * f.x + b) + c) / 4, 2)) / var_pop(f.y) as r2
      from f join m on f.fold = m.fold group by f.fold)
select count(r2) as folds, round(avg(r2), 6) as mean_r2, round(stddev_pop(r2), 6) as std_r2,
       round(min(r2), 6) as min_r2, round(max(r2), 6) as max_r2 from s""")
def kfold_scores_ensemble(spark, sf):
    """A weighted ensemble of a regression and the mean, fitted anew in each fold."""
    def fit(part):
        return models.combined([models.fit_linear(part, ["runtimeMinutes"]),
                                models.fit_mean(part)], [3, 1])

    return rounded(models.kfold(model_set(spark, sf), fit, 3))


# --- evaluation -----------------------------------------------------------------------------

@query("regression_metrics", f"""
select count(*) as n, round(1 - avg(r * r) / var_pop(actual_rating), 6) as r2,
       round(avg(r * r), 6) as mse, round(sqrt(avg(r * r)), 6) as rmse,
       round(avg(abs(r)), 6) as mae from {_R}""")
def regression_metrics(spark, sf):
    return rounded(evaluation.metrics(_scored(spark, sf), Y, P))


@query("median_abs_error",
       f"select round(quantile_cont(abs(r), 0.5), 6) as median_abs_error from {_R}")
def median_abs_error(spark, sf):
    return rounded(evaluation.median_abs_error(_scored(spark, sf), Y, P))


@query("error_bands", f"""
select round(avg(case when abs(r) <= 0.5 then 1.0 else 0.0 end) * 100, 6) as within_half_pct,
       round(avg(case when abs(r) <= 1.0 then 1.0 else 0.0 end) * 100, 6) as within_one_pct,
       round(avg(-r), 6) as mean_error, round(max(abs(r)), 6) as max_abs_error from {_R}""")
def error_bands(spark, sf):
    return rounded(evaluation.error_bands(_scored(spark, sf), Y, P))


@query("overfit_verdict", """
with p as (select b.bucket < 33 as test, averageRating as y, coalesce(g.genre_mean, (
             select avg(averageRating) from bucketed where bucket >= 33)) as p
           from bucketed b left join genre_fit g on b.primary_genre = g.primary_genre),
m as (select (select 1 - avg(pow(y - p, 2)) / var_pop(y) from p where not test) as r2_train,
             (select 1 - avg(pow(y - p, 2)) / var_pop(y) from p where test) as r2_test)
select round(r2_train, 6) as r2_train, round(r2_test, 6) as r2_test,
       round(abs(r2_train - r2_test), 6) as gap,
       case when abs(r2_train - r2_test) > 0.1 then 'overfitting'
            when r2_train < 0.3 and r2_test < 0.3 then 'underfitting' else 'balanced' end
         as verdict,
       case when abs(r2_train - r2_test) < 0.05 then 'none'
            when abs(r2_train - r2_test) < 0.10 then 'slight' else 'strong' end as overfit_level
from m""")
def overfit_verdict(spark, sf):
    train, test = _parts(spark, sf)
    model = models.fit_group_mean(train, "primary_genre")
    return rounded(evaluation.overfit_verdict(
        _test_metrics(model, train), _test_metrics(model, test)))


@query("residual_stats", f"""
with z as (select r, avg(r) over () as m, stddev_pop(r) over () as s from {_R})
select round(avg(r), 6) + 0.0 as mean, round(quantile_cont(r, 0.5), 6) as median,
       round(stddev_samp(r), 6) as std, round(avg(pow((r - m) / s, 3)), 6) as skew,
       round(avg(pow((r - m) / s, 4)) - 3, 6) as kurtosis,
       round(min(r), 6) as min, round(max(r), 6) as max from z""")
def residual_stats(spark, sf):
    return rounded(evaluation.residual_stats(_scored(spark, sf), Y, P))


@query("residual_outliers", f"""
with z as (select abs(r) as r, stddev_samp(r) over () as s from {_R})
select count(*) filter (r > 2 * s) as beyond_2_sd, count(*) filter (r > 3 * s) as beyond_3_sd,
       round(avg(case when r <= s then 1.0 else 0.0 end) * 100, 6) as within_1_sd_pct from z""")
def residual_outliers(spark, sf):
    return rounded(evaluation.residual_outliers(_scored(spark, sf), Y, P))


@query("scale_location", f"""
select round(regr_slope(abs(r), predicted_rating), 5) as slope,
       round(regr_intercept(abs(r), predicted_rating), 5) as intercept from {_R}""")
def scale_location(spark, sf):
    return rounded(evaluation.scale_location(_scored(spark, sf), Y, P), 5)


@query("residual_histogram", f"""
with z as (select r from {_R}),
s as (select min(r) as lo, max(r) as hi, count(r) as n, avg(r) as m, stddev_samp(r) as sd,
             (max(r) - min(r)) / 50 as w from z),
h as (select cast(least(floor((r - lo) / w), 49) as int) as bin, count(*) as c
      from z, s group by 1)
select b.bin, round(lo + w * b.bin, 6) + 0.0 as lower, coalesce(h.c, 0) as count,
       round(coalesce(h.c, 0) / (n * w), 6) as density,
       round(exp(-pow((lo + w * (b.bin + 0.5) - m) / sd, 2) / 2) / (sd * sqrt(2 * pi())), 6)
         as normal_density
from (select cast(range as int) as bin from range(50)) b cross join s
left join h on b.bin = h.bin""")
def residual_histogram(spark, sf):
    return rounded(evaluation.residual_histogram(_scored(spark, sf), Y, P))


@query("residual_boxplot", f"""
with z as (select r from {_R}),
q as (select quantile_cont(r, 0.25) as q1, quantile_cont(r, 0.5) as med,
             quantile_cont(r, 0.75) as q3 from z),
b as (select *, q1 - (q3 - q1) * 1.5 as low, q3 + (q3 - q1) * 1.5 as high from q)
select round(any_value(q1), 6) as q1, round(any_value(med), 6) as median,
       round(any_value(q3), 6) as q3,
       round(min(r) filter (r between low and high), 6) as whisker_low,
       round(max(r) filter (r between low and high), 6) as whisker_high,
       count(*) filter (r < low or r > high) as outliers from z, b""")
def residual_boxplot(spark, sf):
    return rounded(evaluation.residual_boxplot(_scored(spark, sf), Y, P))


def _qq_oracle():
    from statistics import NormalDist
    probs = evaluation.qq_probabilities(99)
    rows = ", ".join(f"({p!r}::double, {NormalDist().inv_cdf(p)!r}::double)" for p in probs)
    return (f"select round(prob, 6) as prob, round(theoretical, 6) + 0.0 as theoretical, "
            f"round((select quantile_cont(r, {[*probs]!r}) from {_R})[i], 6) as sample "
            f"from (select row_number() over (order by prob) as i, * "
            f"from (values {rows}) v(prob, theoretical)) x")


@query("qq_points", _qq_oracle())
def qq_points(spark, sf):
    return rounded(evaluation.qq_points(_scored(spark, sf), Y, P))


_PAIRED = ("averageRating", "numVotes", "startYear", "runtimeMinutes")


@query("correlation_matrix", " union all ".join(
    f"select '{a}' as a, '{b}' as b, round(corr({a}, {b}), 6) as corr from model_set"
    for i, a in enumerate(_PAIRED) for b in _PAIRED[i + 1:]))
def correlation_matrix(spark, sf):
    return rounded(evaluation.correlations(model_set(spark, sf), list(_PAIRED)))


# --- scoring ----------------------------------------------------------------------------------

@query("gap_summary", f"""
select round(avg(g), 6) as mean_gap, count(*) filter (g > 0) as positive,
       count(*) filter (g < 0) as negative, round(avg(g) filter (g > 0), 6) as mean_positive,
       round(avg(g) filter (g < 0), 6) as mean_negative
from (select predicted_rating - actual_rating as g from {_S}) x""")
def gap_summary(spark, sf):
    return rounded(scoring.gap_summary(_scored(spark, sf)))


_UNDER = f"""(select *, predicted_rating - actual_rating as rating_diff from {_S}
where predicted_rating - actual_rating > 0.5 and actual_rating < 7.0 and numVotes >= 500) u"""


@query("undervalued", f"""
select tconst, primaryTitle, startYear, runtimeMinutes, genres, numVotes, actual_rating,
       predicted_rating, round(rating_diff, 6) as rating_diff from {_UNDER}""")
def undervalued(spark, sf):
    return rounded(scoring.undervalued(_scored(spark, sf)))


@query("undervalued_genres", f"""
select trim(split_part(genres, ',', 1)) as genre, count(*) as n,
       (select round(avg(rating_diff), 6) from {_UNDER}) as avg_rating_diff,
       (select round(avg(actual_rating), 6) from {_UNDER}) as avg_actual_rating,
       (select round(avg(predicted_rating), 6) from {_UNDER}) as avg_predicted_rating
from {_UNDER} group by 1 order by n desc, genre limit 5""")
def undervalued_genres(spark, sf):
    return rounded(scoring.undervalued_summary(_scored(spark, sf)))


def _budget(best):
    order = "asc" if best else "desc"
    oracle = f"""
with p as (select movie_id, movie_title, budget, avg(imdb_score) over (
             partition by coalesce(content_rating, 'na')) as score_previsto from t_movies)
select movie_id, movie_title, round(budget, 4) as budget,
       round(score_previsto, 6) as score_previsto,
       round(budget / 1000000 / score_previsto, 6) as ratio
from p where budget is not null order by budget / 1000000 / score_previsto {order}, movie_id
limit 10"""

    @query("budget_ratio_best" if best else "budget_ratio_worst", oracle)
    def job(spark, sf):
        movies = view(spark, sf, "t_movies").fillna("na", subset=["content_rating"])
        model = models.fit_group_mean(movies, "content_rating", "imdb_score")
        predicted = model.transform(movies).withColumnRenamed("prediction", "score_previsto")
        top = scoring.budget_ratio(predicted, best=best)
        return rounded(top.withColumn("budget", F.round("budget", 4)))

    return job


_budget(True)
_budget(False)


@query("confidence", f"""
select tconst, predicted_rating, round(least(0.41 * case when predicted_rating between 4 and 8
  then 1.1 else 0.9 end, 0.95)::double, 3) as confidence from {_S}""")
def confidence(spark, sf):
    return _scored(spark, sf).select(
        "tconst", P, scoring.confidence(F.col(P), 0.41).alias("confidence"))


@query("business_opportunity", f"""
select tconst, case when ok then round(averageRating / log_votes * 100, 2) else 0 end as score,
       case when not ok then 'LOW' when averageRating / log_votes * 100 > 1.5 then 'HIGH'
            else 'MEDIUM' end as level,
       case when ok then '{scoring.REASON_YES}' else '{scoring.REASON_NO}' end as reason
from (select *, averageRating >= 7 and is_popular = 0 as ok from r_ratings) x""")
def business_opportunity(spark, sf):
    refined = refined_ratings(spark, sf)
    chance = scoring.opportunity(F.col(LABEL), F.col("log_votes"), F.col("is_popular"))
    return refined.select("tconst", chance.alias("o")).select(
        "tconst", "o.score", "o.level", "o.reason")


_BATCH_FEATURES = ["numVotes", "log_votes", "is_popular", "cat_excellent", "pop_1", "has_Drama"]


@query("score_batch", f"""
with t as (select *, case when rating_category = 'excellent' then 1 else 0 end as e,
             numVotes % 97 = 0 as bad,
             cast(('0x' || substr(md5(tconst), 1, 8)) as bigint) % 100 as bucket from r_ratings),
m as (select e, avg(averageRating) as p from t where bucket >= 33 group by e),
p as (select t.tconst, t.bad, m.p, t.log_votes, t.is_popular,
             m.p >= 7 and t.is_popular = 0 as ok from t join m on t.e = m.e)
select tconst, case when not bad then round(p, 2) end as predicted_rating,
  case when not bad then round(0.41 * case when p between 4 and 8 then 1.1 else 0.9 end, 3)::double
    end as confidence,
  case when not bad then case when p <= 4 then 'poor' when p <= 6 then 'fair' when p <= 7
    then 'good' when p <= 8 then 'very_good' else 'excellent' end end as rating_category,
  case when not bad then case when ok then round(p / log_votes * 100, 2) else 0 end end
    as opportunity_score,
  case when not bad then case when ok then 'HIGH' else 'LOW' end end as opportunity_level,
  case when not bad then case when ok then '{scoring.REASON_YES}' else '{scoring.REASON_NO}' end
    end as opportunity_reason,
  case when bad then 'not a number: numVotes' end as error
from p""")
def score_batch(spark, sf):
    refined = materialised(refined_ratings(spark, sf), "refined")
    train, _ = ordering.split(refined, "tconst", 33)
    coded = train.withColumn("cat_excellent",
                             (F.col("rating_category") == "excellent").cast("double"))
    model = models.fit_group_mean(coded, "cat_excellent")
    # Some vote counts are made unreadable: those rows must come back with an error.
    votes = F.when(F.col("numVotes") % 97 == 0, "n/a").otherwise(F.col("numVotes").cast("string"))
    return scoring.score(refined.withColumn("numVotes", votes), model, 0.41, _BATCH_FEATURES)


@query("score_requests", f"""
with t as (select *, numVotes % 97 = 0 as bad,
             cast(('0x' || substr(md5(tconst), 1, 8)) as bigint) % 100 as bucket from r_ratings),
m as (select regr_slope(averageRating, log_votes) as a, regr_intercept(averageRating, log_votes)
        as b from t where bucket >= 33),
p as (select t.*, a * log_votes + b as p from t, m),
o as (select *, p >= 7 and is_popular = 0 as ok from p)
select tconst, case when not bad then round(p, 2) end as predicted_rating,
  case when not bad then round(least(0.25 * case when p between 4 and 8 then 1.1 else 0.9 end,
    0.95)::double, 3) end as confidence,
  case when not bad then case when p <= 4 then 'poor' when p <= 6 then 'fair' when p <= 7
    then 'good' when p <= 8 then 'very_good' else 'excellent' end end as rating_category,
  case when not bad then case when ok then round(p / log_votes * 100, 2) else 0 end end
    as opportunity_score,
  case when not bad then case when not ok then 'LOW' when p / log_votes * 100 > 1.5 then 'HIGH'
    else 'MEDIUM' end end as opportunity_level,
  case when not bad then case when ok then '{scoring.REASON_YES}' else '{scoring.REASON_NO}' end
    end as opportunity_reason,
  case when bad then 'not a number: log_votes' end as error, bad as has_record,
  '2025-09-28 12:00:00' as model_timestamp
from o""")
def score_requests(spark, sf):
    """JSON requests, some of them broken, scored by a fitted, saved and loaded regression."""
    refined = materialised(refined_ratings(spark, sf), "refined")
    train, _ = ordering.split(refined, "tconst", 33)
    path = workspace(spark, "model")
    models.save_model(spark, models.fit_linear(train, ["log_votes"]), path, {
        "features": ["log_votes"], "metrics": {"r2_cv": 0.25}, "timestamp": "2025-09-28 12:00:00"})
    votes = F.when(F.col("numVotes") % 97 == 0, "n/a").otherwise(F.col("log_votes").cast("string"))
    movie = F.struct("numVotes", votes.alias("log_votes"), "rating_normalized", "rating_category",
                     "is_popular")
    as_json = refined.select(
        "tconst", F.to_json(F.struct(F.array(movie).alias("movies"))).alias("body"))
    scored = scoring.score_saved(scoring.requests(as_json, "body"), path)
    return scored.withColumn("has_record", F.col("record").isNotNull()).drop("record")
