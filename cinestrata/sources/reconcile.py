"""Files of one table whose columns differ in name or type, read as one."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cinestrata.sources.catalog import _quoted, register_table

# From narrow to wide; what is not here must be the same type everywhere.
_WIDER = ("tinyint", "smallint", "int", "bigint", "double")


def wider(a: T.DataType, b: T.DataType, column: str = "") -> T.DataType:
    """The type that holds both: integers grow to long and double, float to double, date to timestamp.

    Whole numbers beyond 2⁵³ lose digits as doubles. Other pairs of types are an error.
    """
    if a == b:
        return a
    names = {a.simpleString(), b.simpleString()}
    if names <= {*_WIDER, "float"}:
        if "float" in names:
            return T.DoubleType()
        return max((a, b), key=lambda t: _WIDER.index(t.simpleString()))
    if names == {"date", "timestamp"}:
        return T.TimestampType()
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    raise ValueError(f"column {column}: {a.simpleString()} and {b.simpleString()} have no common type")


def united(schemas: Sequence[T.StructType]) -> T.StructType:
    """All columns of the schemas in the order of their first appearance, in their widest types."""
    types: dict[str, T.DataType] = {}
    for schema in schemas:
        for f in schema:
            types[f.name] = wider(types[f.name], f.dataType, f.name) if f.name in types \
                else f.dataType
    return T.StructType([T.StructField(n, t) for n, t in types.items()])


def _merged(spark: SparkSession, files: list[str], base: str) -> T.StructType | None:
    """The schema that a job over the files' footers merges; None if their types differ."""
    try:
        return (spark.read.option("mergeSchema", True).option("basePath", base)
                .parquet(*files).schema)
    except (PySparkException, Py4JJavaError) as err:
        if "MERGE" not in str(err).upper():
            raise
        return None


def schema_runs(spark: SparkSession, path: str) -> list[tuple[list[str], T.StructType]]:
    """The files below a path in order, cut where the types change, with each run's schema.

    Types change a few times in a table's life and files are ordered by their date folders, so
    halving finds the changes with few jobs over the footers; a footer is never read on the
    driver.
    """
    files = sorted(spark.read.schema("_ int").option("recursiveFileLookup", True)
                   .parquet(path).inputFiles())
    return _runs(spark, files, path) if files else []


def _runs(spark: SparkSession, files: list[str],
          base: str) -> list[tuple[list[str], T.StructType]]:
    schema = _merged(spark, files, base)
    if schema is not None:
        return [(files, schema)]
    if len(files) == 1:
        raise ValueError(f"unreadable schema in {files[0]}")
    half = len(files) // 2
    left, right = _runs(spark, files[:half], base), _runs(spark, files[half:], base)
    # The cut may have fallen within a run.
    if left[-1][1] == right[0][1]:
        return left[:-1] + [(left[-1][0] + right[0][0], left[-1][1])] + right[1:]
    return left + right


def read_reconciled(spark: SparkSession, path: str) -> DataFrame:
    """All files below a path with all their columns, each in the widest of its types.

    Every run of files is read in its own types, which the parquet scan knows, and cast; a
    filter on a column that needs no cast reaches the scan.
    """
    runs = schema_runs(spark, path)
    if not runs:
        raise ValueError(f"no files in {path}")
    schema = united([s for _, s in runs])
    parts = []
    for files, own in runs:
        have = {f.name: f.dataType for f in own}
        df = spark.read.schema(own).option("basePath", path).parquet(*files)
        parts.append(df.select(*[
            (F.lit(None).cast(f.dataType) if f.name not in have else F.col(_quoted(f.name))
             if have[f.name] == f.dataType else F.col(_quoted(f.name)).cast(f.dataType))
            .alias(f.name) for f in schema]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def reconcile_table(spark: SparkSession, database: str, name: str, path: str,
                    partitions: tuple[str, ...]) -> list[str]:
    """Give the catalog table over ``path`` all columns in their widest types; those that changed.

    The table is external: it is registered anew over the same files. A parquet scan widens
    integers and floats by itself but not longs to doubles, which only :func:`read_reconciled`
    does; such a column is an error here.
    """
    runs = schema_runs(spark, path)
    schema = united([s for _, s in runs])
    for _, own in runs:
        for f in own:
            if f.dataType == T.LongType() and schema[f.name].dataType == T.DoubleType():
                raise ValueError(f"column {f.name}: files with long must be rewritten as double")
    full = f"{_quoted(database)}.{_quoted(name)}"
    before = {}
    if spark.catalog.tableExists(full):
        before = {f.name: f.dataType for f in spark.table(full).schema}
        spark.sql(f"DROP TABLE {full}")
    plain = [f for f in schema if f.name not in partitions]
    keys = [schema[p] for p in partitions]
    register_table(spark, database, name, T.StructType(plain + keys), path, partitions)
    if partitions:
        spark.sql(f"MSCK REPAIR TABLE {full}")
    return [f.name for f in schema if before.get(f.name) != f.dataType]
