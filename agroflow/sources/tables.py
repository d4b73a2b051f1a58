"""Readers and writers of the job's tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agroflow import schemas
from agroflow.sources.workspace import fresh_path


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing floats are NaN in many sources; make them NULL so comparisons and sums skip them."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({c: F.nanvl(F.col(f"`{c}`"), F.lit(None)) for c in floats}) if floats else df


_INTEGERS = ("tinyint", "smallint", "int", "bigint")
#: Types tried in this order for columns without a declared one.
INFERRED_TYPES = ("bigint", "double", "date", "timestamp", "boolean")


# What stands for a missing value in text sources.
MISSING_MARKERS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "n/a",
    "nan", "null",
)


class MalformedValues(ValueError):
    """A text source has rows that are not as declared; ``rejected`` is the path of a table of these rows."""

    def __init__(self, message: str, rejected: str):
        super().__init__(message)
        self.rejected = rejected


class SchemaConflict(ValueError):
    """Files of one table have columns that no stated rule unites."""


#: What all values of a type look like, as do a few texts that are none.
_BLANK = r"[\x00-\x20\x7f]*"
_LOOKS = {
    **dict.fromkeys(_INTEGERS, rf"^{_BLANK}[+-]?[0-9]+(\.0*)?{_BLANK}$"),
    **dict.fromkeys(("float", "double"), rf"(?i)^{_BLANK}[+-]?([0-9.][0-9.+\-xa-fp]*|inf(inity)?|nan){_BLANK}$"),
    "boolean": rf"(?i)^{_BLANK}(t|true|y|yes|1|f|false|n|no|0){_BLANK}$",
}


def _parsed(column: str, kind: str) -> Column:
    """The text as a value of the type, NULL if it is not one."""
    text = F.trim(F.col(f"`{column}`"))
    if kind in _INTEGERS:
        # Whole numbers are also written with a decimal point where a column has gaps.
        number = F.when(text.rlike(r"^[+-]?[0-9]+\.0*$"), F.substring_index(text, ".", 1)).otherwise(text)
        return number.try_cast(kind)
    if kind == "date":
        # Midnight may be spelled out.
        return F.when(text.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([T ]00:00(:00(\.0+)?)?)?$"), text.try_cast("date"))
    if kind == "timestamp":
        return F.when(text.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"), text.try_cast("timestamp"))
    return text.try_cast(kind)


#: Columns of the table of rejected rows.
REJECTED = ("file", "text", "reason")


def _tried(column: str, kind: str) -> Column:
    """As :func:`_parsed`, for columns that may hold any text: Spark raises and catches an exception for each failed
    cast, so only texts that look like a value of the type are cast."""
    value = _parsed(column, kind)
    return F.when(F.trim(F.col(f"`{column}`")).rlike(_LOOKS[kind]), value) if kind in _LOOKS else value


def read_csv(
    spark: SparkSession,
    path: str,
    types: dict[str, str],
    missing: Sequence[str] = MISSING_MARKERS,
    tolerate: float = 0.0,
    rejected_path: str | None = None,
) -> DataFrame:
    """Header CSV with declared types by column name; the others get the narrowest type that all their values fit.

    ``missing`` lists what stands for NULL. A row with a value that is not of its declared type, or with another
    number of fields than the header, is rejected: it goes to a table (file, text, reason) at ``rejected_path``, or in
    the shared folder. If more than the share ``tolerate`` of the rows is rejected, :class:`MalformedValues` names the
    counts and that table; otherwise the other rows are returned. One pass over the text counts all this and tries
    the types of undeclared columns; only if rows are rejected, a second one writes them. A column without any value
    is text.
    """
    names = spark.read.option("header", True).csv(path).columns
    spoilt = "fields"
    while spoilt in names:
        spoilt += "_"
    ddl = ", ".join(f"`{name}` string" for name in [*names, spoilt])
    reader = spark.read.schema(ddl).option("header", True).option("enforceSchema", False).option("columnPruning", False)
    raw = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", spoilt).csv(path)
    whole = F.col(f"`{spoilt}`").isNull()
    text = raw.withColumns({n: F.when(F.trim(f"`{n}`").isin(list(missing)), F.lit(None)).otherwise(F.col(f"`{n}`")) for n in names})
    tried = {(n, k) for n in names for k in ([types[n]] if n in types else INFERRED_TYPES) if k != "string"}
    order = sorted(tried)
    wrong = {(n, k): F.col(f"`{n}`").isNotNull() & (_parsed if n in types else _tried)(n, k).isNull() for n, k in order}
    declared = [(n, k) for n, k in order if n in types]
    good = whole
    for pair in declared:
        good &= ~wrong[pair]
    # Each test is made once for a row and its outcome kept as a column: the counts below name them many times.
    places = {p: i for i, p in enumerate(order)}
    tests = text.select(
        whole.alias("whole"), *[F.col(f"`{n}`").isNotNull().alias(f"has_{i}") for i, n in enumerate(names)], *[wrong[p].alias(f"wrong_{i}") for p, i in places.items()]
    )
    fits_all = F.col("whole")
    for pair in declared:
        fits_all &= ~F.col(f"wrong_{places[pair]}")
    judged = tests.withColumn("good", fits_all)
    # Types of undeclared columns are those of the rows that stay.
    bad = [F.count_if(F.col(f"wrong_{i}") & F.col("whole" if p in declared else "good")).alias(f"bad_{i}") for p, i in places.items()]
    present = [F.count_if(F.col("good") & F.col(f"has_{i}")).alias(f"present_{i}") for i in range(len(names))]
    counts = judged.agg(F.count(F.lit(1)).alias("rows"), F.count_if("good").alias("good"), F.count_if(~F.col("whole")).alias("spoilt"), *bad, *present).first()
    failed = {pair: counts[f"bad_{i}"] for i, pair in enumerate(order)}
    if counts["good"] < counts["rows"]:
        reasons = {f"{n} ({k})": failed[n, k] for n, k in declared if failed[n, k]} | ({"number of fields": counts["spoilt"]} if counts["spoilt"] else {})
        target = rejected_path or fresh_path(spark, "rejected-rows")
        told = F.concat_ws(", ", F.when(~whole, "number of fields"), *[F.when(whole & wrong[n, k], f"{n} ({k})") for n, k in declared])
        line = F.coalesce(F.col(f"`{spoilt}`"), F.to_csv(F.struct(*[f"`{n}`" for n in names])))
        rows = text.select(F.col("_metadata.file_path").alias("file"), line.alias("text"), told.alias("reason"), good.alias("good"))
        rows.where("not good").drop("good").write.mode("overwrite").parquet(target)
        if counts["rows"] - counts["good"] > tolerate * counts["rows"]:
            raise MalformedValues(
                f"{counts['rows'] - counts['good']} of {counts['rows']} rows of {path} are rejected, by reason: {reasons}; all of them are in {target}", target
            )
    chosen = dict(types)
    for i, n in enumerate(names):
        if n not in types:
            fits = [k for k in INFERRED_TYPES if counts[f"present_{i}"] and not failed[n, k]]
            chosen[n] = fits[0] if fits else "string"
    kept = text.where(good) if counts["good"] < counts["rows"] else text
    typed = kept.select(*[
        (F.col(f"`{n}`") if chosen[n] == "string" else _parsed(n, chosen[n])).alias(n) for n in names
    ])
    return nan_to_null(typed)


def read_climate(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    return read_csv(spark, path, {**schemas.CLIMATE_TYPES, "id": id_type})


def read_climate_classes(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    df = read_csv(spark, path, {**schemas.CLASS_TYPES, "id": id_type})
    return df.withColumnsRenamed({name: name.lower().replace(" ", "_") for name in schemas.CLASS_TYPES})


def read_prec_days(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.PREC_DAYS_TYPES)


#: Types in the order in which they widen; families do not mix.
_FAMILIES = ((*_INTEGERS, "float", "double"), ("date", "timestamp_ntz"), ("date", "timestamp"))


def common_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type that holds the values of both: whole numbers widen to the wider one and, beside a decimal fraction, to
    double; a date widens to a timestamp; a column without values (void) takes the other's type. Else none."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    names = a.simpleString(), b.simpleString()
    if isinstance(a, T.DecimalType) or isinstance(b, T.DecimalType):
        # Decimals keep their digits only among themselves.
        if not (isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType)):
            return None
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else None
    for family in _FAMILIES:
        if names[0] in family and names[1] in family:
            wider = max(names, key=family.index)
            # A float has fewer digits than an int.
            return T.DoubleType() if wider == "float" and set(names) & {"int", "bigint"} else T.DataType.fromDDL(wider)
    return None


def common_schema(schemas_: Sequence[T.StructType]) -> T.StructType:
    """Columns of all schemas by name, in the order in which they first occur; a conflict is an error that names it.

    As elsewhere in Spark, upper and lower case make no difference; the first spelling counts.
    """
    found: dict[str, T.StructField] = {}
    for schema in schemas_:
        for f in schema.fields:
            key = f.name.lower()
            if key not in found:
                found[key] = T.StructField(f.name, f.dataType)
                continue
            known = found[key]
            kind = common_type(known.dataType, f.dataType)
            if kind is None:
                raise SchemaConflict(
                    f"column {known.name} ({known.dataType.simpleString()}) and column {f.name} ({f.dataType.simpleString()}) cannot be one"
                )
            found[key] = T.StructField(known.name, kind)
    return T.StructType(list(found.values()))


def _alike(spark: SparkSession, paths: Sequence[str], base: str | None = None) -> list[DataFrame]:
    """The files as few tables whose own files agree in their types; Spark reads the files' footers in parallel.

    Files that differ are cut in halves until each part agrees, so there are about as many reads as changes of a type.
    """
    reader = spark.read.option("mergeSchema", True)
    if base is not None:
        reader = reader.option("basePath", base)
    try:
        return [reader.parquet(*paths)]
    except Exception as error:
        if "CANNOT_MERGE_SCHEMA" not in str(error):
            raise
        if len(paths) > 1:
            half = len(paths) // 2
            return [*_alike(spark, paths[:half], base), *_alike(spark, paths[half:], base)]
        # The path is a folder of files that differ; partition columns come from the folders below it.
        files = sorted(spark.read.parquet(paths[0]).inputFiles())
        if len(files) < 2:
            raise
        half = len(files) // 2
        return [*_alike(spark, files[:half], paths[0]), *_alike(spark, files[half:], paths[0])]


def read_parquet(spark: SparkSession, *paths: str, where: Column | None = None) -> DataFrame:
    """One or many Parquet files or folders as one table.

    Columns are united by name: one that some files lack is NULL in their rows, types widen as :func:`common_type`
    says, and anything else raises :class:`SchemaConflict`. ``where`` is tested on the stored values, so it reaches
    the scan, and again after NaN became NULL, so that NaN passes no comparison.
    """
    parts = _alike(spark, paths)
    schema = common_schema([p.schema for p in parts])
    df = None
    for part in parts:
        there = {f.name.lower(): f.dataType for f in part.schema.fields}
        columns = [
            F.col(f"`{f.name}`") if there.get(f.name.lower()) == f.dataType
            else (F.col(f"`{f.name}`") if f.name.lower() in there else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
        read = part.select(*columns)
        df = read if df is None else df.unionByName(read)
    if where is None:
        return nan_to_null(df)
    return nan_to_null(df.where(where)).where(where)


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: tuple[str, ...] = (),
    max_records_per_file: int | None = None,
) -> None:
    writer = df.write.mode("overwrite")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def csv_to_parquet(spark: SparkSession, source: str, target: str, types: dict[str, str] | None = None) -> None:
    """Convert a header CSV to Parquet; columns without a declared type keep the one their values have."""
    df = read_csv(spark, source, types or schemas.OUTPUT_TYPES)
    write_parquet(df, target)
