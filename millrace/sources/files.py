"""Incremental and batch file scans, file metadata columns, rescued data."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.schemas import resolve_schema
from millrace.session import write_text

# Reader options that describe the incremental file source itself.
OPTION_PREFIX = "cloudFiles."
FORMAT_OPTION = "cloudFiles.format"
INFER_OPTION = "cloudFiles.inferColumnTypes"
RESCUE_OPTION = "cloudFiles.rescuedDataColumn"
# Entries of a file-metadata request.
SELECT_ENTRY = "select_metadata_cols"
INCLUDE_ENTRY = "include_autoloader_metadata_column"
NAME_ENTRY = "autoloader_metadata_col_name"
# Fixed value: the name a kept file-metadata struct takes when none is given.
DEFAULT_METADATA_NAME = "source_metadata"


def split_options(options: Mapping[str, str], default_format: str = "json"):
    """(format, plain reader options, rescued column or None, infer types)."""
    given = {k.lower(): v for k, v in options.items()}
    file_format = given.get(FORMAT_OPTION.lower(), default_format)
    plain = {k: v for k, v in options.items() if not k.lower().startswith(OPTION_PREFIX.lower())}
    infer = str(given.get(INFER_OPTION.lower(), "false")).lower() == "true"
    return file_format, plain, given.get(RESCUE_OPTION.lower()), infer


def infer_schema(spark: SparkSession, path: str, file_format: str, options: Mapping[str, str], infer: bool):
    """The schema found in the files by one batch read. A stream then keeps to it."""
    reader = spark.read.format(file_format).options(**options)
    if infer and file_format == "csv":
        reader = reader.option("inferSchema", "true")
    return reader.load(path).schema


def pinned_schema(spark: SparkSession, place: str | None, find: Callable[[], T.StructType]) -> T.StructType:
    """The schema kept at a place; the first time the one that is found, which is kept then."""
    if place is None:
        return find()
    try:
        return T.StructType.fromJson(json.loads(spark.read.text(place, wholetext=True).first()["value"]))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    schema = find()
    write_text(spark, schema.json(), place)
    return schema


def file_scan(
    spark: SparkSession,
    path: str,
    options: Mapping[str, str] | None = None,
    schema=None,
    streaming: bool = True,
    file_format: str | None = None,
    metadata: Mapping | None = None,
    pinned: str | None = None,
) -> DataFrame:
    """Files below a path; as a stream each file is read once (its checkpoint remembers).

    Without a schema the files are looked at, and what is found is kept at ``pinned``, if that is given, so that later runs read
    what the first one read. With a rescued-data column, JSON and CSV
    fields that the schema does not know or cannot hold are kept as JSON text in that column.
    """
    found, plain, rescue, infer = split_options(options or {}, file_format or "json")
    file_format = file_format or found
    schema = resolve_schema(spark, schema, path) or pinned_schema(
        spark, pinned, lambda: infer_schema(spark, path, file_format, plain, infer)
    )
    if rescue:
        schema = T.StructType([f for f in schema.fields if f.name != rescue])
    reader = spark.readStream if streaming else spark.read
    if rescue and file_format == "json":
        raw = json_records(reader, path, plain, metadata is not None)
        df = rescue_json(raw, schema, rescue, metadata is not None, _parse_options(plain))
    elif rescue and file_format == "csv":
        raw = reader.format("csv").options(**plain, **_CSV_RAW).schema(_raw_csv_schema(schema)).load(path)
        df = rescue_csv(raw, schema, rescue, metadata is not None, _parse_options(plain))
    else:
        df = reader.format(file_format).options(**plain).schema(schema).load(path)
    return add_file_metadata(df, metadata) if metadata is not None else df


def add_file_metadata(df: DataFrame, request: Mapping) -> DataFrame:
    """Columns from the file metadata.

    ``SELECT_ENTRY`` maps new columns to fields such as ``_metadata.file_name``. With
    ``INCLUDE_ENTRY`` true the whole struct stays, renamed to ``NAME_ENTRY``; else it does not
    appear.
    """
    chosen = dict(request.get(SELECT_ENTRY) or {})
    include = str(request.get(INCLUDE_ENTRY, "false")).lower() == "true"
    if "_metadata" in df.columns:
        df = df.select(*[c for c in df.columns if c != "_metadata"], "_metadata")
    else:
        df = df.selectExpr("*", "_metadata")
    df = df.withColumns({name: F.col(field) for name, field in chosen.items()})
    if not include:
        return df.drop("_metadata")
    return df.withColumnRenamed("_metadata", request.get(NAME_ENTRY, DEFAULT_METADATA_NAME))


def _text_options(options: Mapping[str, str]) -> dict[str, str]:
    """Options of the file source that hold for any format."""
    general = {
        "maxfilespertrigger",
        "maxbytespertrigger",
        "pathglobfilter",
        "recursivefilelookup",
        "modifiedafter",
        "modifiedbefore",
        "latestfirst",
        "maxfileage",
        "cleansource",
        "sourcearchivedir",
    }
    return {k: v for k, v in options.items() if k.lower() in general}


def _parse_options(options: Mapping[str, str]) -> dict[str, str]:
    """Options that say how a field's text is read, such as time formats."""
    general = _text_options(options)
    return {k: v for k, v in options.items() if k not in general and k.lower() not in _RECORD_OPTIONS}


# Options of the JSON reader that say where records lie, and the names of the one encoding that text is read in.
_RECORD_OPTIONS = ("multiline", "encoding", "charset", "linesep")
_UTF8 = ("utf-8", "utf8")


def json_records(reader, path: str, options: Mapping[str, str], keep_metadata: bool = False) -> DataFrame:
    """The text of each JSON record below a path (``value``), and ``_metadata`` if wanted.

    Records are lines, or with ``multiLine`` whole files, of which an array gives a record per element, as the JSON reader has
    it. ``lineSep`` holds for lines, ``encoding`` for whole files; lines in another encoding than UTF-8 are refused.
    """
    given = {k.lower(): v for k, v in options.items()}
    general = _text_options(options)
    encoding = str(given.get("encoding", given.get("charset", "UTF-8")))
    extra = [F.col("_metadata")] if keep_metadata else []
    if str(given.get("multiline", "false")).lower() != "true":
        if encoding.lower() not in _UTF8:
            raise ValueError(f"JSON lines in {encoding} cannot be rescued; read them with multiLine, or in UTF-8")
        if "linesep" in given:
            general["lineSep"] = given["linesep"]
        return reader.format("text").options(**general).load(path).select("value", *extra)
    if encoding.lower() in _UTF8:
        whole = reader.format("text").options(**general, wholetext="true").load(path).select("value", *extra)
    else:
        whole = reader.format("binaryFile").options(**general).load(path)
        whole = whole.select(F.decode("content", encoding).alias("value"), *extra)
    parts = F.from_json("value", T.ArrayType(T.StringType()), _parse_options(options))
    # what is no array, or no JSON, is one record
    return whole.select(F.explode(F.coalesce(parts, F.array("value"))).alias("value"), *[c for c in whole.columns if c != "value"])


def _raw_map(text: Column, options: Mapping[str, str] | None = None) -> Column:
    """The fields of a JSON object with their raw text."""
    return F.from_json(text, T.MapType(T.StringType(), T.StringType()), dict(options or {}))


def _given(value: Column) -> Column:
    """Whether a VARIANT is there and not null."""
    return value.isNotNull() & ~F.is_variant_null(value)


def _damaged(raw: Column, value: Column, kind: T.DataType) -> Column:
    """Whether a nested value lost something of its VARIANT: a field that is unknown or does not fit, at any depth."""
    if isinstance(kind, T.StructType):
        fields = F.try_variant_get(raw, "$", "map<string, variant>")
        known = F.array(*[F.lit(f.name) for f in kind.fields]).cast("array<string>")
        bad = F.exists(F.map_entries(fields), lambda e: _given(e["value"]) & ~F.array_contains(known, e["key"]))
        for f in kind.fields:
            inner = F.try_element_at(fields, F.lit(f.name))
            bad = bad | (_given(inner) & (value[f.name].isNull() | _damaged(inner, value[f.name], f.dataType)))
        return F.coalesce(bad, F.lit(False))
    if isinstance(kind, T.ArrayType):
        parts = F.try_variant_get(raw, "$", "array<variant>")
        pairs = F.zip_with(parts, value, lambda p, v: _given(p) & (v.isNull() | _damaged(p, v, kind.elementType)))
        return F.coalesce(F.exists(pairs, lambda bad: bad), F.lit(False))
    return F.lit(False)


_BAD = "__bad"


def rescue_json(
    raw: DataFrame, schema: T.StructType, rescue: str, keep_metadata: bool = False, options: Mapping[str, str] | None = None
) -> DataFrame:
    """JSON records in ``value`` to typed columns and a rescued column.

    Rescued are fields the schema lacks and fields whose value, or a part of it at any depth, does not fit their type, with
    their raw text; a record that is no JSON object at all is rescued whole. NULL when clean. ``options`` are those of the
    JSON reader. A record is parsed once into the schema, which also tells whether all of it fitted, and its keys are listed; where the
    schema has nested columns it is also parsed once into a VARIANT, in which unknown nested fields are looked for. Only
    records that are not clean are looked at by field.
    """
    extra = [F.col("_metadata")] if keep_metadata else []
    options = dict(options or {})
    named = {k.lower(): v for k, v in options.items()}.get("columnnameofcorruptrecord")
    marker = next((f.name for f in schema.fields if f.name == named and isinstance(f.dataType, T.StringType)), _BAD)
    if marker == _BAD:
        options = {k: v for k, v in options.items() if k.lower() != "columnnameofcorruptrecord"} | {"columnNameOfCorruptRecord": _BAD}
    full = schema if marker != _BAD else T.StructType([*schema.fields, T.StructField(_BAD, T.StringType())])
    fields = [f for f in schema.fields if f.name != marker]
    nested = [f for f in fields if isinstance(f.dataType, (T.StructType, T.ArrayType))]
    parsed = raw.where(F.col("value").rlike(r"\S")).select(
        F.from_json("value", full, options).alias("__p"),
        F.json_object_keys("value").alias("__k"),
        *([F.try_parse_json("value").alias("__v")] if nested else []),
        F.col("value"),
        *extra,
    )
    known = F.array(*[F.lit(f.name) for f in fields]).cast("array<string>")
    harmed = {
        f.name: _damaged(F.try_variant_get("__v", f"$[{json.dumps(f.name)}]", "variant"), F.col("__p")[f.name], f.dataType) for f in nested
    }
    clean = F.col("__p")[marker].isNull() & F.col("__k").isNotNull() & (F.size(F.array_except("__k", known)) == 0)
    for bad in harmed.values():
        clean = clean & ~bad
    parsed = parsed.withColumn("__m", F.when(~F.coalesce(clean, F.lit(False)), _raw_map(F.col("value"), options)))
    parsed = parsed.withColumn("__clean", F.coalesce(clean, F.lit(False)))
    lost = F.filter(
        F.array(*[F.when(F.col("__p")[f.name].isNull() | harmed.get(f.name, F.lit(False)), F.lit(f.name)) for f in fields]),
        lambda name: name.isNotNull(),
    )
    rescued = F.map_filter(
        "__m",
        lambda name, text: text.isNotNull() & (~F.array_contains(known, name) | F.array_contains(lost, name)),
    )
    column = (
        F.when(F.col("__clean"), F.lit(None).cast("string"))
        .when(F.col("__m").isNull(), F.to_json(F.struct(F.col("value").alias("_line"))))
        .when(F.size(rescued) > 0, F.to_json(rescued))
    )
    return parsed.select(*[F.col("__p")[f.name].alias(f.name) for f in schema.fields], column.alias(rescue), *extra)


_RAW_LINE = "__raw_line"
_CSV_RAW = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _RAW_LINE}


def _raw_csv_schema(schema: T.StructType) -> T.StructType:
    return T.StructType(
        [T.StructField(f.name, T.StringType()) for f in schema.fields]
        + [T.StructField(_RAW_LINE, T.StringType())]
    )


def rescue_csv(
    raw: DataFrame, schema: T.StructType, rescue: str, keep_metadata: bool = False, options: Mapping[str, str] | None = None
) -> DataFrame:
    """CSV fields read as text to typed columns and a rescued column.

    Rescued are fields whose text does not fit their type, and the whole line (as ``_line``)
    where the number of fields is wrong. NULL when clean. The reader's formats for times and dates hold.
    """
    extra = [F.col("_metadata")] if keep_metadata else []
    formats = {k.lower(): v for k, v in (options or {}).items()}

    def typed(f: T.StructField) -> Column:
        if isinstance(f.dataType, T.TimestampType) and "timestampformat" in formats:
            return F.try_to_timestamp(F.col(f.name), F.lit(formats["timestampformat"]))
        if isinstance(f.dataType, T.TimestampNTZType) and "timestampntzformat" in formats:
            return F.try_to_timestamp(F.col(f.name), F.lit(formats["timestampntzformat"])).cast(f.dataType)
        if isinstance(f.dataType, T.DateType) and "dateformat" in formats:
            return F.try_to_timestamp(F.col(f.name), F.lit(formats["dateformat"])).cast(f.dataType)
        return F.col(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name).try_cast(f.dataType)

    parts = [
        F.when(F.col(f.name).isNotNull() & typed(f).isNull(), F.col(f.name)).alias(f.name)
        for f in schema.fields
    ]
    # to_json leaves NULL fields out, so an empty object means a clean row
    packed = F.to_json(F.struct(*parts, F.col(_RAW_LINE).alias("_line")))
    return raw.select(
        *[typed(f).alias(f.name) for f in schema.fields],
        F.when(packed != "{}", packed).alias(rescue),
        *extra,
    )
