"""The seven logical tables: file names, raw columns, keys and typed columns."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

NULL_TOKEN = "\\N"

RUN_COLUMNS = ("ingestion_timestamp", "ingestion_year", "ingestion_month", "ingestion_day")
PARTITION_COLUMNS = ("ingestion_year", "ingestion_month", "ingestion_day")
# Below the run date, layers are partitioned by what wrote the rows: a batch run or a stream's batch.
BATCH_COLUMN = "ingestion_batch"
BATCH_RUN = "run"


@dataclass(frozen=True)
class TableSpec:
    """What must be known about one table to read, type and clean it."""

    name: str
    file_name: str
    columns: tuple[str, ...]
    keys: tuple[str, ...]
    required: tuple[str, ...] = ()
    types: dict[str, str] = field(default_factory=dict)

    @property
    def raw_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])


# The public dump's file names and columns.
TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        TableSpec(
            "ratings", "title.ratings.tsv.gz",
            ("tconst", "averageRating", "numVotes"),
            keys=("tconst",),
            types={"averageRating": "double", "numVotes": "int"},
        ),
        TableSpec(
            "basics", "title.basics.tsv.gz",
            ("tconst", "titleType", "primaryTitle", "originalTitle", "isAdult",
             "startYear", "endYear", "runtimeMinutes", "genres"),
            keys=("tconst",),
            required=("tconst", "titleType", "primaryTitle"),
            types={"startYear": "int", "endYear": "int", "runtimeMinutes": "int"},
        ),
        TableSpec(
            "crew", "title.crew.tsv.gz",
            ("tconst", "directors", "writers"),
            keys=("tconst",), required=("tconst",),
        ),
        TableSpec(
            "principals", "title.principals.tsv.gz",
            ("tconst", "ordering", "nconst", "category", "job", "characters"),
            keys=("tconst", "ordering"), required=("tconst", "nconst"),
            types={"ordering": "int"},
        ),
        TableSpec(
            "akas", "title.akas.tsv.gz",
            ("titleId", "ordering", "title", "region", "language", "types",
             "attributes", "isOriginalTitle"),
            keys=("titleId", "ordering"), required=("titleId", "title"),
            types={"ordering": "int"},
        ),
        TableSpec(
            "episode", "title.episode.tsv.gz",
            ("tconst", "parentTconst", "seasonNumber", "episodeNumber"),
            keys=("tconst",), required=("tconst", "parentTconst"),
            types={"seasonNumber": "int", "episodeNumber": "int"},
        ),
        TableSpec(
            "names", "name.basics.tsv.gz",
            ("nconst", "primaryName", "birthYear", "deathYear",
             "primaryProfession", "knownForTitles"),
            keys=("nconst",), required=("nconst", "primaryName"),
            types={"birthYear": "int", "deathYear": "int"},
        ),
    )
}


def table(name: str) -> TableSpec:
    """Look a table up by name, failing with the names that exist."""
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}; known: {', '.join(TABLES)}")
    return TABLES[name]


# The scoring request's record layout.
SCORING_REQUEST = T.StructType([
    T.StructField("movies", T.ArrayType(T.StructType([
        T.StructField("numVotes", T.StringType()),
        T.StructField("log_votes", T.StringType()),
        T.StructField("rating_normalized", T.StringType()),
        T.StructField("rating_category", T.StringType()),
        T.StructField("is_popular", T.StringType()),
    ]))),
])
