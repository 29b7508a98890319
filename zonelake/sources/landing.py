"""Landing zone: JSON-lines files, read with a declared schema.

The raw feeds are JSON lines, one directory per feed (the customer feed may
be a single file).  Reads use a declared schema: inference would cost a full
pass over the files and types whole-number doubles as longs.  Spark's JSON source matches
keys by their exact case and gives nulls without a word for others, so the declared
names are first reconciled with the spelling of the files (``key_spellings``: the first
records of every split).  Where each field has one spelling, the JSON source
parses each line once, reads the wanted keys only and takes pushed filters; where spellings are
mixed, every line is parsed into a map and its keys are compared in lower case.  Malformed lines are kept with every field null
and the raw text in the corrupt column when it is requested; the consent filter and the inner joins drop
them, ``landing_stats`` counts them.  Text fields hold numbers and nested values as they stand in the file; a line that is an
array of objects gives a row for each (the map gives one empty row).  Keys of one record that differ only in case are an error.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Mapping, Sequence
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT_COLUMN = "_corrupt_record"
#: records at the begin of every split whose keys are looked at
KEY_RECORDS = 1000

# a line's keys in lower case with their values as text; null for a malformed line
_KEYS = "transform_keys(from_json(value, 'map<string,string>'), (k, v) -> lower(k))"


def _field(f: T.StructField) -> str:
    """SQL for a declared field of the parsed line; a value that does not fit its type is null."""
    return f"try_cast(element_at(_line, '{f.name.lower()}') AS {f.dataType.simpleString()}) AS `{f.name}`"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``value`` (raw text) and ``_line`` (parsed) of every line that is not blank, with the file's metadata."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.select("value", F.expr(_KEYS).alias("_line"), F.col("_metadata.file_path").alias("_file"))


def typed_lines(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared fields of raw JSON lines (column ``value``), a batch or a stream."""
    parsed = lines.where(F.trim("value") != "").select(F.expr(_KEYS).alias("_line"))
    return parsed.select(*[F.expr(_field(f)) for f in schema.fields])


def _keys(names: frozenset[str]):
    """The keys of the first records of a split that are one of ``names`` but for their case."""

    def run(rows: Iterable) -> Iterator[str]:
        found: set[str] = set()
        for row in islice(rows, KEY_RECORDS):
            try:
                line = json.loads(row[0])
            except ValueError:
                continue
            if isinstance(line, dict):
                found.update(k for k in line if k.lower() in names)
        return iter(found)

    return run


def key_spellings(spark: SparkSession, path: str, schema: T.StructType) -> dict[str, list[str]]:
    """How the files spell each declared field (none: not among the first ``KEY_RECORDS`` records of any split).

    Every split of every file is opened and read no further than these records, so files of several writers are all
    seen.  A file that changes its spelling later on needs ``exact_keys`` in ``read_landing``.
    """
    names = frozenset(f.name.lower() for f in schema.fields)
    # the one imperative step: a scan that stops early in every split
    found = spark.read.text(path).rdd.mapPartitions(_keys(names)).distinct().collect()  # spellings of declared names only
    return {f.name: sorted(k for k in found if k.lower() == f.name.lower()) for f in schema.fields}


def _one_spelling(schema: T.StructType, spellings: Mapping[str, Sequence[str]]) -> dict[str, str] | None:
    """The key of each field if the files agree on it; a field that was not seen keeps its declared name."""
    if any(len(s) > 1 for s in spellings.values()):
        return None
    return {f.name: (list(spellings.get(f.name, ())) or [f.name])[0] for f in schema.fields}


def _typed(f: T.StructField, key: str) -> str:
    """SQL for a declared field of the JSON source, read as text; a value that does not fit its type is null.  A filter on the
    field implies one on the text, which is what the scan is given."""
    return f"try_cast(`{key}` AS {f.dataType.simpleString()}) AS `{f.name}`"


def read_landing(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    *,
    keep_corrupt: bool = False,
    corrupt_column: str = CORRUPT_COLUMN,
    required: Sequence[str] = (),
    exact_keys: bool = False,
) -> DataFrame:
    """Read a JSON-lines file or directory (any URI scheme Hadoop knows).

    Without ``schema`` the schema is inferred from the data.  ``required`` names fields that some record must have; a
    feed with records of which none has such a key is refused (in a good feed this looks at the first
    records only).  ``exact_keys`` compares the keys of every record in lower case, at the price of a map per line and without
    pushed filters.  Failures (a missing path, an unreadable schema, clashing keys, a missing key) are raised as
    ``RuntimeError`` naming the path.
    """
    try:
        if schema is None:
            reader = spark.read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_column)
            df = reader.json(path)
            df.schema  # noqa: B018 - resolve now so a bad path fails here
            return df
        fields = T.StructType([f for f in schema.fields if f.name != corrupt_column])
        seen = {} if exact_keys else key_spellings(spark, path, fields)
        lines = _lines(spark, path)
        lines.schema  # noqa: B018
        for name in required:
            if any(seen.get(f.name) for f in fields.fields if f.name.lower() == name.lower()):
                continue
            if lines.where(F.expr(f"map_contains_key(_line, '{name.lower()}')")).isEmpty() and not lines.isEmpty():
                raise ValueError(f"no record has the key {name}")
        keys = None if exact_keys else _one_spelling(fields, seen)
        if keys is None:
            wanted = [F.expr(_field(f)) for f in fields.fields]
            if keep_corrupt:
                wanted.append(F.when(F.col("_line").isNull(), F.col("value")).alias(corrupt_column))
            return lines.select(*wanted)
        texts = T.StructType([T.StructField(keys[f.name], T.StringType()) for f in fields.fields])
        wanted = [F.expr(_typed(f, keys[f.name])) for f in fields.fields]
        if keep_corrupt:
            texts = texts.add(corrupt_column, T.StringType())
            wanted.append(F.col(corrupt_column))
        reader = spark.read.schema(texts).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_column)
        return reader.json(path).select(*wanted)
    except Exception as exc:  # noqa: BLE001 - re-raised with the path
        raise RuntimeError(f"failed to read landing data at {path}: {exc}") from exc


def infer_landing_schema(spark: SparkSession, path: str, sampling_ratio: float = 1.0) -> T.StructType:
    """Schema discovered from the files (the crawler's job), optionally from
    a sample of the lines."""
    try:
        return spark.read.option("samplingRatio", sampling_ratio).json(path).schema
    except Exception as exc:  # noqa: BLE001
        raise RuntimeError(f"failed to infer a schema at {path}: {exc}") from exc


def register_landing(
    spark: SparkSession,
    database: str,
    table: str,
    schema: T.StructType,
    path: str,
) -> DataFrame:
    """Catalog a landing feed as a typed view over the files at ``path`` and return it; keys are matched as in
    ``read_landing`` (files that come later in another spelling need a new registration).  Re-registering replaces the
    entries, never the files."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    lines = f"`{database}`.`{table}__lines`"
    spark.sql(f"DROP TABLE IF EXISTS {lines}")
    keys = _one_spelling(schema, key_spellings(spark, path, schema))
    if keys is None:
        spark.sql(f"CREATE TABLE {lines} (value STRING) USING text LOCATION '{path}'")
        fields, source = ", ".join(_field(f) for f in schema.fields), f"(SELECT {_KEYS} AS _line FROM {lines} WHERE trim(value) <> '')"
    else:
        texts = ", ".join(f"`{keys[f.name]}` STRING" for f in schema.fields)
        spark.sql(f"CREATE TABLE {lines} ({texts}) USING json LOCATION '{path}'")
        fields, source = ", ".join(_typed(f, keys[f.name]) for f in schema.fields), lines
    spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{table}` AS SELECT {fields} FROM {source}")
    return spark.table(f"{database}.{table}")


def landing_stats(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Table statistics of a landing feed, one row: records, objects (files, empty ones too),
    total bytes, mean record size and malformed records (lines that are no JSON object, or without any declared field).

    Rows are counted per file first (combined map-side), so the result needs
    one shuffle of one row per file and task.
    """
    known = " OR ".join(f"element_at(_line, '{f.name.lower()}') IS NOT NULL" for f in schema.fields)
    rows = _lines(spark, path).select("_file", F.expr(f"NOT coalesce({known}, false)").cast("long").alias("_bad"))
    counted = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_rows"), F.sum("_bad").alias("_bad"))
    objects = spark.read.format("binaryFile").load(path).select(F.col("path").alias("_file"), F.lit(0).alias("_rows"), F.lit(0).alias("_bad"), F.col("length").alias("_size"))
    both = counted.withColumn("_size", F.lit(None).cast("long")).unionByName(objects)
    return both.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).cast("long").alias("records"),
        F.count("_size").alias("objects"),
        F.coalesce(F.sum("_size"), F.lit(0)).cast("long").alias("size_bytes"),
        F.try_divide(F.sum("_size"), F.sum("_rows")).alias("mean_record_bytes"),
        F.coalesce(F.sum("_bad"), F.lit(0)).cast("long").alias("malformed"),
    )
