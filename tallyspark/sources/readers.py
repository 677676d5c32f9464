"""Typed source readers and landing (raw file -> declared schema -> parquet).

Every read binds an explicit schema (no inference). Landing keeps only the declared columns
(extra raw columns such as ``currency`` are pruned before the scan reads them), casts to the
declared types, and stamps ``ingested_at`` with one value per load when the raw data has none.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import params as P
from .. import schemas as S

DECLARED = {P.SRC_CUSTOMERS: S.SRC_CUSTOMERS, P.SRC_BILLING: S.SRC_BILLING,
            P.SRC_SESSIONS: S.SRC_SESSIONS}

# a doubled quote in a quoted field is a quote
CSV_OPTIONS = {"header": "true", "nullValue": "", "mode": "FAILFAST", "quote": '"', "escape": '"',
               "enforceSchema": "false",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType, **options: str) -> DataFrame:
    """Header CSV with a bound schema. A value that does not fit, or a file whose header differs, is an
    error; with ``mode=PERMISSIVE`` the value becomes NULL (add a ``_corrupt_record`` string field to the
    schema to keep the raw line). ``multiLine=true`` for line breaks in quoted fields."""
    return spark.read.options(**{**CSV_OPTIONS, **options}).schema(schema).csv(path)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None,
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """Relational source. With a numeric ``partition_column`` and bounds the read is split into
    ``num_partitions`` parallel range queries; filters on the result are pushed into SQL."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                  .option("numPartitions", str(num_partitions or 1)))
    return reader.load()


def read_source(spark: SparkSession, name: str, location: str, fmt: str = "parquet",
                **options: str) -> DataFrame:
    """Read one raw source in its declared schema from csv / parquet / jdbc (``location`` is
    then the table name and ``options`` the connection settings)."""
    schema = DECLARED[name]
    if fmt == "csv":
        raw_schema = T.StructType([f for f in schema.fields if f.name != "ingested_at"])
        return read_csv(spark, location, raw_schema, **options)
    if fmt == "parquet":
        return spark.read.parquet(location)
    if fmt == "jdbc":
        url = options.pop("url")
        return read_jdbc(spark, url, location, options)
    raise ValueError(f"unknown source format {fmt!r}")


def _conform_exprs(raw: DataFrame, name: str, load_time: dt.datetime | None) -> list:
    out = []
    for f in DECLARED[name].fields:
        if f.name in raw.columns:
            c = F.col(f.name)
            if isinstance(f.dataType, T.DecimalType):
                # NaN cannot become a decimal: NULL it first (a float source may carry NaN).
                c = F.when(F.isnan(c.cast("double")), F.lit(None)).otherwise(c)
            out.append(c.cast(f.dataType).alias(f.name))
        elif f.name == "ingested_at":
            ts = (F.lit(load_time.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
                  if load_time else F.current_timestamp().cast("timestamp_ntz"))
            out.append(ts.alias("ingested_at"))
        else:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
    return out


def conform(raw: DataFrame, name: str, load_time: dt.datetime | None = None) -> DataFrame:
    """Project a raw frame onto the declared schema of ``name`` (drop extras, cast, stamp)."""
    return raw.select(*_conform_exprs(raw, name, load_time))


CORRUPT = "_corrupt_record"


def headers(spark: SparkSession, location: str) -> dict[str, list[str]]:
    """First line -> the files that begin with it. Files are listed by Spark; of each only the first line is read, through the
    file system, some at a time. Files without a line are left out."""
    from concurrent.futures import ThreadPoolExecutor

    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def first_line(file: str) -> str | None:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
        stream = path.getFileSystem(conf).open(path)
        try:
            codec = codecs.getCodec(path)
            if codec is not None:
                stream = codec.createInputStream(stream)
            reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
            return reader.readLine()
        finally:
            stream.close()
    files = spark.read.text(location).inputFiles()
    out: dict[str, list[str]] = {}
    with ThreadPoolExecutor(16) as pool:
        for file, line in zip(files, pool.map(first_line, files)):
            if line is not None:
                out.setdefault(line.removeprefix("\ufeff"), []).append(file)
    return out


def _land_csv(spark: SparkSession, name: str, files: list[str], keep_corrupt: bool, options: dict[str, str]) -> DataFrame:
    """Files that share a header, read under its names and order."""
    header = spark.read.options(**{**CSV_OPTIONS, **options}).csv(files[0]).columns
    wanted = {f.name: f.dataType for f in DECLARED[name].fields}
    fields = [T.StructField(c, T.StringType(), True) for c in header]
    if keep_corrupt:
        fields.append(T.StructField(CORRUPT, T.StringType(), True))
        options = {"mode": "PERMISSIVE", "enforceSchema": "true", **options, "columnNameOfCorruptRecord": CORRUPT}
    text = read_csv(spark, files, T.StructType(fields), **options)
    given = {c: F.when(~F.col(c).isin(*P.MISSING_TOKENS), F.col(c)) for c in header}
    typed = [c for c in header if c in wanted and not isinstance(wanted[c], T.StringType)]
    kept = [c for c in header if c in wanted]
    if not keep_corrupt:
        return text.select(*(given[c].cast(wanted[c]).alias(c) for c in kept))
    bad = reduce(Column.__or__, (given[c].isNotNull() & given[c].try_cast(wanted[c]).isNull() for c in typed),
                 F.lit(False))
    line = F.coalesce(F.col(CORRUPT), F.when(bad, F.to_csv(F.struct(*header))))
    # the empty part of a column of the file: Spark refuses queries of the corrupt record alone
    line = F.concat(line, F.substring(F.coalesce(F.col(header[0]), F.lit("")), 1, 0))
    return text.select(*(given[c].try_cast(wanted[c]).alias(c) for c in kept), line.alias(CORRUPT))


def land(spark: SparkSession, name: str, location: str, fmt: str = "csv",
         load_time: dt.datetime | None = None, keep_corrupt: bool = False,
         **options: str) -> DataFrame:
    """Raw source -> declared table (to be written with ``sinks.overwrite``).

    CSV columns are bound by name, file by file: files of a folder may order their columns differently or lack some. Fields
    are read as text; those of ``P.MISSING_TOKENS`` are NULL, the others are cast. A value that does not
    fit its declared type is an error. With ``keep_corrupt`` it loads as NULL and the line is kept in
    ``_corrupt_record`` (NULL for good lines) so the caller can quarantine or count malformed input (``run_pipeline`` does both).
    """
    if fmt == "csv":
        parts = [_land_csv(spark, name, files, keep_corrupt, dict(options)) for _, files in sorted(headers(spark, location).items())]
        raw = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts \
            else spark.createDataFrame([], DECLARED[name])
    else:
        raw = read_source(spark, name, location, fmt, **options)
    extra = [F.col(CORRUPT)] if keep_corrupt and CORRUPT in raw.columns else []
    return raw.select(*_conform_exprs(raw, name, load_time), *extra)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CREATE TABLE IF NOT EXISTS for readers: a missing table reads as empty, typed. Any other error
    of the path stays one."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def source_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table from one aggregate over the tagged union of all tables (an empty
    table reports 0)."""
    tagged = [df.select(F.lit(name).alias("table_name")) for name, df in tables.items()]
    counts = (reduce(DataFrame.unionByName, tagged).groupBy("table_name")
              .agg(F.count(F.lit(1)).alias("row_count")))
    spark = next(iter(tables.values())).sparkSession
    names = spark.createDataFrame([(n,) for n in tables], "table_name string")
    return (names.join(counts, "table_name", "left")
            .select("table_name", F.coalesce("row_count", F.lit(0)).alias("row_count")))
