"""Every bucket boundary and every NULL, on rows written by hand."""

import pytest
from pyspark.sql import functions as F

from cinestrata.functions import lists, modelset, tables
from cinestrata.functions.tables import with_features

NEXT = 1  # one step above a closed edge


@pytest.mark.parametrize("bands, expected", [
    (tables.RATING_CATEGORY, {1: "poor", 4: "poor", 5: "fair", 6: "fair", 7: "good",
                              8: "very_good", 9: "excellent", None: "excellent"}),
    (tables.RATING_CATEGORY_BINNED, {0: None, 4: "poor", 6: "fair", 7: "good", 8: "very_good",
                                     10: "excellent", 11: None, None: None}),
    (tables.DECADE_LABEL, {1949: "classic", 1950: "golden_age", 1979: "golden_age",
                           1980: "modern", 1999: "modern", 2000: "contemporary",
                           None: "unknown"}),
    (tables.RUNTIME_CATEGORY, {30: "short", 31: "standard", 90: "standard", 91: "long",
                               150: "long", 151: "epic", None: "unknown"}),
    (tables.CREW_CATEGORY, {0: "no_crew", 1: "small_crew", 2: "small_crew", 3: "medium_crew",
                            5: "medium_crew", 6: "large_crew"}),
    (tables.BILLING_POSITION, {1: "lead", 2: "main_cast", 3: "main_cast", 4: "supporting",
                               10: "supporting", 11: "minor", None: "minor"}),
    (tables.TITLE_PRIORITY, {1: "primary", 2: "secondary", 3: "secondary", 4: "alternative",
                             None: "alternative"}),
    (tables.SEASON_CATEGORY, {0: "early_seasons", 1: "first_season", 3: "early_seasons",
                              4: "mid_seasons", 7: "mid_seasons", 8: "later_seasons",
                              None: "unknown"}),
    (tables.EPISODE_CATEGORY, {1: "pilot", 2: "early_episode", 5: "early_episode",
                               6: "mid_episode", 10: "mid_episode", 11: "later_episode",
                               None: "unknown"}),
    (tables.EPISODE_POSITION, {1: "beginning", 3: "beginning", 4: "middle", 19: "middle",
                               20: "ending", None: "unknown"}),
    (tables.FAME_CATEGORY, {0: "unknown", 1: "emerging", 2: "established", 3: "established",
                            4: "celebrity"}),
    (tables.GENERATION, {1929: "classic_era", 1930: "golden_age", 1950: "new_hollywood",
                         1970: "modern_era", 1990: "contemporary", None: "unknown"}),
    (modelset.DURATION_CATEGORY, {0: None, 90: "short", 91: "standard", 120: "standard",
                                  180: "long", 300: "epic", 301: None, None: None}),
    (modelset.CINEMA_ERA, {1959: "Golden_Age", 1960: "New_Hollywood", 1980: "Blockbuster_Era",
                           2000: "Digital_Era", 2010: "Streaming_Era", None: "Streaming_Era"}),
    (modelset.RATING_QUALITY, {0: None, 5: "Baixo (1-5)", 7: "Médio (5-7)", 10: "Alto (7-10)",
                               None: None}),
])
def test_bands(spark, bands, expected):
    df = spark.createDataFrame([(k,) for k in expected], "v int")
    got = {r["v"]: r["label"] for r in df.select("v", bands.label(F.col("v")).alias("label"))
           .collect()}
    assert got == expected


def test_lists(spark):
    df = spark.createDataFrame(
        [("a,b",), ("a, b ,\\N",), ("\\N",), ("",), (None,)], "genres string")
    rows = df.select(
        lists.list_size("genres").alias("size"),
        lists.list_size("genres", empty_is_zero=True).alias("zero"),
        lists.list_size_without("genres").alias("without"),
        lists.first_item("genres").alias("first"),
        lists.items("genres").alias("items")).collect()
    assert [tuple(r) for r in rows] == [
        (2, 2, 2, "a", ["a", "b"]),
        (3, 3, 2, "a", ["a", "b", "\\N"]),
        (1, 1, 0, "Unknown", []),
        (1, 0, 0, "", []),
        (0, 0, 0, "Unknown", [])]


def test_substring_and_item_flags(spark):
    df = spark.createDataFrame([("Drama,Musical",), ("Music",), (None,)], "genres string")
    by_text = modelset.genre_flags(["Music"])
    by_item = modelset.genre_flags(["Music"], whole_items=True)
    assert [r[0] for r in df.select(by_text["has_Music"]).collect()] == [1, 1, 0]
    assert [r[0] for r in df.select(by_item["has_Music"]).collect()] == [0, 1, 0]


def test_flag_names():
    assert list(modelset.genre_flags(["Sci-Fi", "Film Noir"])) == ["has_Sci_Fi", "has_Film_Noir"]
    assert "has_Sci-Fi" in modelset.genre_flags(modelset.COMMON_GENRES, clean_names=False)


def test_principals_nulls(spark):
    df = spark.createDataFrame([("t", None, "n", None, None, None)],
                               "tconst string, ordering int, nconst string, category string, "
                               "job string, characters string")
    row = with_features(df, tables.principals()).first()
    assert (row["is_actor"], row["is_main_cast"], row["role_category"]) == (None, None, "other")
    row = with_features(df, tables.principals_onehot()).first()
    assert (row["is_actor"], row["is_lead_actor"]) == (0, 0)


def test_names(spark):
    schema = ("nconst string, primaryName string, birthYear int, deathYear int, "
              "primaryProfession string, knownForTitles string")
    df = spark.createDataFrame([
        ("n1", "Ann", 1950, None, "assistant_director", "t1"),
        ("n2", "Bo", 1920, 1990, "actress", None),
        ("n3", "Cy", None, None, None, "t1,t2,t3,t4")], schema)
    a, b, c = with_features(df, tables.names(2024)).orderBy("nconst").collect()
    assert (a["approximate_age"], a["career_span"], a["is_director"]) == (74, None, 1)
    assert (b["approximate_age"], b["career_span"], b["is_actor"]) == (None, 70, 1)
    assert (c["is_writer"], c["fame_category"], c["generation"]) == (0, "celebrity", "unknown")
    assert with_features(df, tables.names_role_items()).first()["is_director"] == 0


def test_votes_per_age_before_release(spark):
    df = spark.createDataFrame([(2025, 100, 90)], "startYear int, numVotes int, runtimeMinutes int")
    row = with_features(df, modelset.interactions(df.columns, 2024)).first()
    assert row["votes_per_age"] is None and row["runtime_x_action"] == 0


def test_missing_flag_and_extra_columns(spark):
    from cinestrata.operators.columns import align_features, drop_columns_matching

    df = spark.createDataFrame([("t", 1, None, 5)], "tconst string, a int, b int, extra int")
    row = align_features(df, ["b", "a", "c"], keep=["tconst"]).first()
    assert row.asDict() == {"tconst": "t", "b": 0.0, "a": 1.0, "c": 0.0}
    wide = spark.createDataFrame([(1, 2, 3, 4)],
                                 "actor_name int, actor_name_likes int, movie_link int, year int")
    assert drop_columns_matching(wide).columns == ["actor_name_likes", "year"]
