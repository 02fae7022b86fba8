"""Scans of raw and curated data. Schemas are always explicit, so no scan reads data to infer types."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonepulse import schemas as S
from zonepulse.functions.text import is_blank
from zonepulse.functions.timeparts import from_epoch_micros

_QUOTED = {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}


def select_typed(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Named columns cast to the wanted types; a column the source lacks becomes a typed null."""
    present = {f.name: f.dataType for f in df.schema.fields}

    def one(name: str, kind: str) -> Column:
        if name not in present:
            return F.lit(None).cast(kind).alias(name)
        c = F.col(name)
        if present[name].simpleString() == kind:
            return c  # without a cast, later filters can reach the scan
        if isinstance(present[name], (T.FloatType, T.DoubleType)) and kind in ("int", "bigint"):
            # a whole number stored as floating point is still that number
            return F.when(c == F.floor(c), c).try_cast(kind).alias(name)
        return c.try_cast(kind).alias(name)

    return df.select(*[one(name, kind) for name, kind in columns.items()])


def _same_layout(spark: SparkSession, files: Sequence[str], columns: Sequence[str]) -> list[tuple[DataFrame, list[str]]]:
    """The files in groups that store the named columns alike: a scan of each group, and its files.

    Spark merges the footers of many files in one job, in tasks. Where types differ it cannot, and the files are halved: sorted by
    name, files of one layout lie together, so a few layouts cost a few jobs for each border between them, not one for a file.
    """
    def merged(some: Sequence[str]) -> list[tuple[DataFrame, list[str]]]:
        try:
            return [(spark.read.option("mergeSchema", True).parquet(*some), list(some))]
        except (PySparkException, Py4JJavaError) as error:
            if len(some) == 1 or "CANNOT_MERGE" not in str(error):
                raise
        half = len(some) // 2
        return merged(some[:half]) + merged(some[half:])

    groups: dict[tuple, tuple[DataFrame, list[str]]] = {}
    for scan, some in merged(files):
        stored = dict(scan.dtypes)
        key = tuple(stored.get(c) for c in columns)
        known = groups.get(key)
        groups[key] = (scan, some) if known is None else (spark.read.schema(known[0].select(*[c for c in columns if c in stored]).schema).parquet(*known[1], *some), known[1] + some)
    return [groups[k] for k in sorted(groups, key=str)]


def read_trips(spark: SparkSession, path: str, kind: str, recursive: bool = False) -> DataFrame:
    """Raw taxi parquet of one kind. Times keep their stored type (timestamp or epoch microseconds).

    Files may lack columns (null there only) and may store numbers in any numeric type. Where files also
    differ in the type of a time, all times become zone-less timestamps.
    """
    layout = S.TRIP_LAYOUTS[kind]
    raw = spark.read.option("recursiveFileLookup", recursive).parquet(path)
    times = (layout.pickup, layout.dropoff)
    parts = [scan for scan, _ in _same_layout(spark, sorted(unquote(f) for f in raw.inputFiles()), layout.columns)]
    stored = [dict(part.dtypes) for part in parts]
    wanted = {layout.distance: "double", layout.pickup_zone: "int", layout.dropoff_zone: "int"}
    for t in times:
        kinds = {s[t] for s in stored if t in s}
        wanted[t] = kinds.pop() if len(kinds) == 1 else "timestamp_ntz"
    if layout.passengers:
        wanted[layout.passengers] = "double"
    for i, part in enumerate(parts):
        for t in times:
            if stored[i].get(t) == "bigint" and wanted[t] == "timestamp_ntz":
                parts[i] = parts[i].withColumn(t, from_epoch_micros(F.col(t)))
    typed = [select_typed(part, {name: wanted[name] for name in layout.columns}) for part in parts]
    return reduce(DataFrame.unionByName, typed)


def read_lines(spark: SparkSession, path: str, header_prefix: str | None = None, recursive: bool = False) -> DataFrame:
    """Text lines without blank lines and header lines (recognised by prefix, any case)."""
    lines = spark.read.option("recursiveFileLookup", recursive).text(path).filter(~is_blank(F.col("value")))
    if header_prefix:
        lines = lines.filter(~F.lower(F.ltrim("value")).startswith(header_prefix.lower()))
    return lines


def split_line(line: Column, keep_trailing: bool = True) -> Column:
    """Pieces between commas, quotes not looked at. Optionally drops empty pieces at the end."""
    return F.split(line if keep_trailing else F.regexp_replace(line, ",+$", ""), ",", -1)


def read_delimited(
    spark: SparkSession,
    path: str,
    header_prefix: str | None = None,
    keep_trailing: bool = True,
    recursive: bool = False,
) -> DataFrame:
    """Lines with their comma pieces: columns ``line`` and ``fields`` (array)."""
    lines = read_lines(spark, path, header_prefix, recursive)
    return lines.select(F.col("value").alias("line"), split_line(F.col("value"), keep_trailing).alias("fields"))


def quoted_field_count(line: Column) -> Column:
    """Number of fields when commas inside quotes do not separate."""
    bare = F.regexp_replace(line, r'"[^"]*("|$)', "")
    return (F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1).cast("int")


def parse_quoted(lines: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``value`` lines parsed as quoted CSV: the named columns, ``n_fields`` and the ``line`` itself."""
    schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    parsed = lines.select(
        F.col("value").alias("line"),
        quoted_field_count(F.col("value")).alias("n_fields"),
        F.from_csv(F.col("value"), F.lit(schema.simpleString()[7:-1].replace(":", " ")), _QUOTED).alias("row"),
    )
    # the generator keeps later filters from repeating the parse for every column they use
    return parsed.select("line", "n_fields", F.inline(F.array("row")))


def read_quoted(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    header_prefix: str | None = None,
    recursive: bool = False,
) -> DataFrame:
    """Quote-aware CSV lines; short rows give nulls, and ``n_fields`` tells how many fields there were."""
    return parse_quoted(read_lines(spark, path, header_prefix, recursive), columns)


def read_json_trips(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """JSON lines of cleaned trips; times are epoch microseconds."""
    layout = S.TRIP_LAYOUTS[kind]
    kinds = {
        layout.pickup: "bigint", layout.dropoff: "bigint", layout.distance: "double",
        layout.pickup_zone: "int", layout.dropoff_zone: "int", "taxi_type": "string",
    }
    if layout.passengers:
        kinds[layout.passengers] = "int"
    return spark.read.schema(S.struct_of(kinds)).json(path)


def read_csv(
    spark: SparkSession, path: str, columns: Sequence[str], header: bool = True, recursive: bool = False
) -> DataFrame:
    """CSV with all columns as text, with or without a header line."""
    schema = S.struct_of({name: "string" for name in columns})
    options = {**_QUOTED, "header": header, "recursiveFileLookup": recursive}
    return spark.read.options(**options).schema(schema).csv(path)


def read_curated(spark: SparkSession, path: str, table: str | None = None, fmt: str = "orc") -> DataFrame:
    """Table partitioned by year and month; the folder names give the partition columns.

    With ``table`` (a name in ``schemas.CURATED``) the schema is given, so no file footer is opened to
    learn it.
    """
    reader = spark.read.format(fmt)
    if table:
        reader = reader.schema(S.struct_of({**S.CURATED[table], "year": "int", "month": "int"}))
    return reader.load(path)
