"""Bronze file sources: JSON / CSV snapshots read incrementally or in batch, with lineage.

* ``infer_once`` infers a schema from the files once and persists it (as schema JSON
  text next to the data) so the stream always starts from the same schema.
* ``read_snapshots`` / ``stream_snapshots`` read a landing folder in batch or as a
  file stream (only new files are picked up; progress lives in the checkpoint).
* ``with_lineage`` adds ``_ingestion_timestamp`` and ``_source_file``.
* ``evolve_union`` is schema evolution between runs: new fields become columns,
  older rows carry NULL.
* ``rescue`` keeps fields and values that do not fit the schema in ``_rescued_data``; JSON snapshots read
  with a schema have that column too (``rescue_records``).
"""

from __future__ import annotations

import csv
import json
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldleaf.sources.nested import merge_types, union_evolved

# Lineage column names, Spark's name for broken records, and the season pattern.
LINEAGE_TS = "_ingestion_timestamp"
LINEAGE_FILE = "_source_file"
CORRUPT = "_corrupt_record"
SEASON_PATTERN = r"(\d{4}-\d{2})"


def _reader(spark: SparkSession, fmt: str, multiline: bool, options: dict | None, stream: bool):
    from goldleaf.sources.landing import JSON_TIME_OPTIONS

    r = spark.readStream if stream else spark.read
    r = r.format(fmt)
    if fmt == "json":
        r = r.options(**JSON_TIME_OPTIONS)
    if fmt == "json" and multiline:
        r = r.option("multiLine", True)
    if fmt == "csv":
        r = r.option("header", True)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r


def infer_schema(spark: SparkSession, path: str, fmt: str = "json", multiline: bool = False,
                 options: dict | None = None) -> T.StructType:
    """Batch inference over the files currently present (types inferred, CSV too)."""
    opts = dict(options or {})
    if fmt == "csv":
        opts.setdefault("inferSchema", True)
    found = _reader(spark, fmt, multiline, opts, stream=False).load(path).schema
    # a broken record is no field: it goes to the rescue column
    return T.StructType([f for f in found.fields if fmt != "json" or f.name != CORRUPT])


def infer_once(spark: SparkSession, path: str, schema_location: str, fmt: str = "json",
               multiline: bool = False, options: dict | None = None) -> T.StructType:
    """The persisted schema at ``schema_location``, inferring and saving it on first use."""
    try:
        text = spark.read.text(schema_location).first()
        if text is not None:
            return T.StructType.fromJson(json.loads(text[0]))
    except AnalysisException:
        pass
    schema = infer_schema(spark, path, fmt, multiline, options)
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(schema_location)
    return schema


def _rescues(fmt: str, schema: T.StructType | None, options: dict) -> bool:
    """JSON under a schema is read as text and rescued, unless the caller asks for another mode or encoding of Spark's reader."""
    given = {k.lower(): v for k, v in options.items()}
    return (fmt == "json" and schema is not None and str(given.get("mode", "PERMISSIVE")).upper() == "PERMISSIVE"
            and not given.keys() & {"encoding", "charset"})


def _texts(r, multiline: bool, options: dict):
    r = r.format("text").option("wholetext", multiline)
    for k, v in options.items():
        r = r.option(k, v)
    return r


def read_snapshots(spark: SparkSession, path: str, fmt: str = "json", schema: T.StructType | None = None,
                   multiline: bool = False, options: dict | None = None) -> DataFrame:
    """Batch read of a landing folder (all files, any depth).

    JSON with a schema gets a last column ``_rescued_data`` (see ``rescue_records``).
    """
    opts = {"recursiveFileLookup": True, **(options or {})}
    if _rescues(fmt, schema, opts):
        return rescue_records(_texts(spark.read, multiline, opts).load(path), "value", schema, opts)
    if schema is None and fmt == "csv":
        opts.setdefault("inferSchema", True)
    r = _reader(spark, fmt, multiline, opts, stream=False)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def stream_snapshots(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json",
                     multiline: bool = False, max_files: int | None = None, options: dict | None = None) -> DataFrame:
    """Incremental file source: each trigger reads only files not seen before.

    JSON gets a last column ``_rescued_data`` (see ``rescue_records``).
    """
    opts = {"recursiveFileLookup": True, **(options or {})}
    if max_files:
        opts["maxFilesPerTrigger"] = max_files
    if _rescues(fmt, schema, opts):
        return rescue_records(_texts(spark.readStream, multiline, opts).load(path), "value", schema, opts)
    return _reader(spark, fmt, multiline, opts, stream=True).schema(schema).load(path)


def evolve_schema(spark: SparkSession, path: str, schema_location: str, fmt: str = "json",
                  multiline: bool = False, options: dict | None = None) -> T.StructType:
    """The persisted schema widened by the fields of the files now present, saved under a new version.

    Run it before a stream starts: new fields become columns at the end, or nested fields at the end of their struct at any depth (see
    ``nested.merge_types``); known ones keep their type (values that do not fit are for ``rescue``). Rows read earlier have NULL in later columns when the table is read with this schema. Versions are folders ``v=<n>``, so an
    interrupted save leaves the last whole one in force.
    """
    try:
        found = spark.read.text(schema_location).orderBy(F.desc("v")).first()
    except AnalysisException:
        found = None
    known = T.StructType.fromJson(json.loads(found["value"])) if found else T.StructType([])
    now = infer_schema(spark, path, fmt, multiline, {"recursiveFileLookup": True, **(options or {})})
    merged = merge_types(known, now)
    if merged != known:
        version = (found["v"] if found else 0) + 1
        spark.createDataFrame([(merged.json(),)], "value string").coalesce(1).write.mode("overwrite").text(
            f"{schema_location.rstrip('/')}/v={version}")
    return merged


def _header_names(line: str) -> list[str]:
    """Column names of a CSV header; the second ``x`` is called ``x__2``, so a repeated name loses no values."""
    names, seen = [], set()
    for name in next(csv.reader([line.removeprefix("\ufeff")]), []):
        free, n = name, 1
        while free.lower() in seen:
            n += 1
            free = f"{name}__{n}"
        seen.add(free.lower())
        names.append(free)
    return names


def read_csv_by_name(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV files with headers, their columns matched by name, every value as text, with lineage.

    Files are grouped by their header line, wherever they lie, each group is read with its own header, and the groups are united by
    name, absent columns NULL. A header may repeat a name (see ``_header_names``) but not span lines. A line with more or fewer values than the header is kept whole
    in ``_corrupt_record``. With a ``schema`` the result is projected onto it by ``rescue_columns``: nothing is lost, values and columns that do not fit are kept
    as JSON. Finding the headers reads the files once more; the plan grows with the number of different headers, not of files or folders.
    """
    lines = (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").text(path)
             .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
             .where("start = 0").withColumn("at", F.monotonically_increasing_id()))
    headers = lines.groupBy("file").agg(F.min_by("value", "at").alias("header"))
    united = None
    for found in headers.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("header").collect():
        fields = T.StructType([T.StructField(n, T.StringType()) for n in [*_header_names(found["header"]), CORRUPT]])
        one = with_lineage(spark.read.option("header", True).option("columnNameOfCorruptRecord", CORRUPT).schema(fields)
                           .csv([unquote(f) for f in found["files"]]))
        united = one if united is None else united.unionByName(one, allowMissingColumns=True)
    if united is None:
        raise FileNotFoundError(f"no CSV files under {path}")
    return united if schema is None else rescue_columns(united, schema)


def with_lineage(df: DataFrame) -> DataFrame:
    """Add the ingestion instant (one value per micro-batch / query) and the source file path."""
    return df.withColumn(LINEAGE_TS, F.current_timestamp()).withColumn(LINEAGE_FILE, F.col("_metadata.file_path"))


def season_from_path(df: DataFrame, path_col: str = LINEAGE_FILE, pattern: str = SEASON_PATTERN,
                     out: str = "season") -> DataFrame:
    """Season label from the file path (group 1 of ``pattern``); no match gives ''."""
    return df.withColumn(out, F.regexp_extract(F.col(path_col), pattern, 1))


def evolve_union(older: DataFrame, newer: DataFrame) -> DataFrame:
    """Union by name where fields new in either side, at any depth, become fields (NULL on the other side)."""
    return union_evolved(older, newer)


def _repeats(text: Column) -> Column:
    """Whether JSON text is an object in which a key stands twice (which no map can hold)."""
    keys = F.json_object_keys(text)
    return F.coalesce(F.size(keys) > F.size(F.array_distinct(keys)), F.lit(False))


def _entries(text: Column) -> Column:
    """The fields of a JSON object as a map of texts; NULL for other text and for an object that repeats a key."""
    return F.from_json(F.when(~_repeats(text), text), "map<string,string>")


def rescue(df: DataFrame, raw_col: str, schema: T.StructType, out: str = "_rescued_data") -> DataFrame:
    """Parse JSON text ``raw_col`` against ``schema`` without losing anything.

    Every schema field is read from the text and cast with ``try_cast``; fields that are not
    in the schema, and values whose cast fails, are kept as a JSON object in ``out``
    (NULL when nothing was rescued). Text that is not a JSON object, and an object that repeats a key, go to ``out`` as they are, under NULLs.
    The schema itself never changes.
    """
    m, raw = F.col("__m"), F.col(raw_col)
    typed = [m[f.name].try_cast(f.dataType).alias(f.name) for f in schema.fields]

    def unread(k: Column, v: Column) -> Column:
        known = F.lit(False)
        for f in schema.fields:
            known = known | ((k == F.lit(f.name)) & (v.isNull() | v.try_cast(f.dataType).isNotNull()))
        return ~known

    leftover = F.map_filter(m, unread)
    rescued = F.when(raw.isNotNull() & m.isNull(), raw).when(F.size(leftover) > 0, F.to_json(leftover))
    keep = [c for c in df.columns if c != raw_col]
    return df.withColumn("__m", _entries(raw)).select(*keep, *typed, rescued.alias(out))


def _outside(text: Column, dt: T.DataType) -> Column:
    """Whether JSON text of type ``dt`` holds a field, at any depth, that the type does not have."""
    if isinstance(dt, T.StructType):
        m = _entries(text)
        found = F.exists(F.map_keys(m), lambda k: ~k.isin(*dt.names)) if dt.names else F.size(m) > 0
        found = _repeats(text) | F.coalesce(found, F.lit(False))
        for f in dt.fields:
            if isinstance(f.dataType, _NESTED):
                found = found | _outside(m[f.name], f.dataType)
    elif isinstance(dt, T.ArrayType) and isinstance(dt.elementType, _NESTED):
        found = F.exists(F.from_json(text, "array<string>"), lambda x: _outside(x, dt.elementType))
    elif isinstance(dt, T.MapType) and isinstance(dt.valueType, _NESTED):
        found = _repeats(text) | F.exists(F.map_values(_entries(text)), lambda x: _outside(x, dt.valueType))
    else:
        return F.lit(False)
    return F.coalesce(found, F.lit(False))


_NESTED = (T.StructType, T.ArrayType, T.MapType)


def rescue_records(df: DataFrame, raw_col: str, schema: T.StructType, options: dict | None = None,
                   out: str = "_rescued_data") -> DataFrame:
    """Rows of JSON text ``raw_col`` as Spark's JSON reader gives them, without losing anything.

    Blank texts give no row, an array at the root one row per element. ``out`` (NULL when nothing was rescued) holds, as a JSON object of their text,
    fields outside the schema, values that do not fit their type, and nested fields with such a field or value inside, each
    whole; a text that is no JSON object is kept as it is, under NULLs, and so is an object that repeats a key, next to the fields that could be read.
    """
    from goldleaf.sources.landing import JSON_TIME_OPTIONS

    raw = F.col(raw_col)
    items = F.when(F.ltrim(raw).startswith("["), F.from_json(raw, "array<string>"))
    rows = df.where(raw.rlike("[^\\s]")).withColumn("__r", F.explode(F.coalesce(items, F.array(raw))))
    fields = T.StructType([*schema.fields, T.StructField("__bad", T.StringType())])
    opts = {**JSON_TIME_OPTIONS, **{k: str(v) for k, v in (options or {}).items()}, "columnNameOfCorruptRecord": "__bad"}
    rows = rows.withColumn("__p", F.from_json("__r", fields, opts)).withColumn("__m", _entries(F.col("__r")))
    bad = F.col("__p")["__bad"].isNotNull()
    kept = F.col("__m")
    known = [f.name for f in schema.fields]
    extra = F.map_filter(kept, lambda k, v: ~k.isin(*known)) if known else kept
    entries = []
    for f in schema.fields:
        value = kept[f.name]
        misfit = (bad | _outside(value, f.dataType)) if isinstance(f.dataType, _NESTED) else F.col("__p")[f.name].isNull()
        entries.append(F.struct(F.lit(f.name).alias("k"), F.when(misfit, value).alias("v")))
    misfits = F.map_filter(F.map_from_entries(F.array(*entries)), lambda k, v: v.isNotNull()) if entries else F.create_map().cast("map<string,string>")
    leftover = F.map_concat(misfits, extra)
    rescued = F.when(kept.isNull(), F.col("__r")).when(F.size(leftover) > 0, F.to_json(leftover))
    keep = [c for c in df.columns if c != raw_col]
    return rows.select(*keep, *[F.col("__p")[f.name].alias(f.name) for f in schema.fields], rescued.alias(out))


def rescue_columns(df: DataFrame, schema: T.StructType, out: str = "_rescued_data",
                   keep: tuple[str, ...] = (LINEAGE_TS, LINEAGE_FILE)) -> DataFrame:
    """Rescue for flat sources (CSV with a header): project ``df`` onto ``schema``.

    Schema columns are cast with ``try_cast`` (missing ones become typed NULLs); columns that
    are not in the schema, and values whose cast fails, go to ``out`` as a JSON object of
    their text (NULL when nothing was rescued). ``keep`` columns pass through unchanged.
    """
    present = set(df.columns)
    typed = [(F.col(f.name).try_cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
             for f in schema.fields]
    entries = []
    for f in schema.fields:
        if f.name in present:
            bad = F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()
            entries.append(F.when(bad, F.col(f.name).cast("string")).alias(f.name))
    entries += [F.col(c).cast("string").alias(c) for c in df.columns if c not in schema.names and c not in keep]
    # NULL fields are left out, so a row that fits is an empty object
    rescued = F.nullif(F.to_json(F.struct(*entries), {"ignoreNullFields": "true"}), F.lit("{}")) if entries else F.lit(None).cast("string")
    return df.select(*typed, *[F.col(c) for c in keep if c in present], rescued.alias(out))
