"""Read a file set as a DataFrame.

The format name of a transfer (``avrofile``, ``orcfile``, ``textfile`` or any
Spark format name) picks the reader.  Types come from the files (ORC, Parquet),
from an Avro schema, or, for delimited text, from the target: every field is
read as text and converted later, so a bad value becomes a reject, not a null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..operators.names import col
from ..workspace import exists
from . import drift
from .records import addressed_lines, read_records

# The transfer's format names and their Spark readers.
FORMAT_ALIASES = {"avrofile": "avro", "orcfile": "orc", "textfile": "csv", "parquetfile": "parquet"}
MALFORMED_COLUMN = "_malformed_line"
# Where a source row was read, on request: its file, the split of it, and a mark that rises row by row in the split.
ADDRESS_COLUMN = "_source_address"
OWN_COLUMNS = (MALFORMED_COLUMN, ADDRESS_COLUMN)
# Reader options that concern single lines; any other makes the CSV reader read the file.
LINE_OPTIONS = {"sep", "delimiter", "quote", "escape", "chartoescapequoteescaping", "nullvalue", "emptyvalue",
                "ignoreleadingwhitespace", "ignoretrailingwhitespace", "multiline", "maxcolumns", "maxcharspercolumn"}

# Text written and read by this library: nothing trimmed, quotes doubled, line
# breaks escaped, binary values in base64, and micro-second timestamps, so that
# a value survives a round trip exactly.
TEXT_OPTIONS = {
    "header": "false",
    "quote": '"',
    "escape": '"',
    # quotes are only ever doubled; the default ("\0") would make the parser
    # swallow NUL characters that stand next to a quote inside a value
    "charToEscapeQuoteEscaping": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSSXXX",  # an instant carries its offset
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "dateFormat": "yyyy-MM-dd",
    # records end with "\n"; a fixed separator stops the parser from guessing it
    # from a file's first line break, which may be a "\r\n" inside a value
    "lineSep": "\n",
}


def spark_format(file_format: str | None) -> str:
    name = (file_format or "avrofile").lower()
    return FORMAT_ALIASES.get(name, name)


# A character that would end or blur a text line is written as DLE and a letter
# (DLE, "data link escape", announces that the next character means another), so
# that every record is one line and a large file is read by many tasks.
ESCAPE = "\x10"
NULL_MARK = ESCAPE + "z"
# An empty file of this name lies beside text files that this library wrote.
ESCAPED_MARK = "_tablemover_escapes"
ESCAPED = (("\n", "n"), ("\r", "r"), ("\x00", "0"), (ESCAPE, "e"))


def escape_text(c: Column) -> Column:
    """``c`` without line breaks and NULs."""
    out = F.replace(c, F.lit(ESCAPE), F.lit(ESCAPE + "e"))
    for char, letter in ESCAPED[:-1]:
        out = F.replace(out, F.lit(char), F.lit(ESCAPE + letter))
    return F.when(c.rlike("[\\x00\\n\\r\\x10]"), out).otherwise(c)


def unescape_text(c: Column) -> Column:
    """Undo ``escape_text``.  After escaping, every DLE is followed by its letter, so replacing the pairs one
    kind after the other, DLE's own last, cannot meet a pair that was not written."""
    out = c
    for char, letter in ESCAPED:
        out = F.replace(out, F.lit(ESCAPE + letter), F.lit(char))
    return F.when(c == NULL_MARK, F.lit(None)).when(F.contains(c, F.lit(ESCAPE)), out).otherwise(c)


def text_read_options(separator: str | None, *, multiline: bool = False) -> dict[str, str]:
    """Options of a CSV read of text: one line per record unless ``multiline`` is asked for, for foreign files
    whose quoted values hold line breaks; it reads each file in one task."""
    opts = dict(TEXT_OPTIONS)
    opts["sep"] = separator or ","
    opts["multiLine"] = "true" if multiline else "false"
    # Written text marks NULL by an empty field and an empty string by "".  On
    # read, an empty field takes this sentinel, which alone maps to NULL, so an
    # empty string stays an empty string.  (Written text holds no NUL; a foreign
    # value of exactly one NUL character reads as NULL.)
    opts["nullValue"] = "\u0000"
    return opts


def line_options(separator: str | None, options: dict | None = None) -> dict[str, str]:
    """Options by which one line is parsed: this library's own, then the caller's.  A caller's escape character
    also escapes itself, unless told otherwise."""
    own = {k.lower(): k for k in TEXT_OPTIONS} | {"sep": "sep", "delimiter": "sep"}
    given = {own.get(k.lower(), k): str(v) for k, v in (options or {}).items()}
    opts = text_read_options(separator)
    if "escape" in given or "quote" in given:
        opts["escape"] = given.get("escape", opts["escape"])
        opts["charToEscapeQuoteEscaping"] = opts["escape"]
    return opts | given


def _unclosed_quote(line: Column, opts: dict[str, str]) -> Column:
    """A field of the line begins with a quote, and the quotes that are not escaped do not pair: the value goes on
    in a line that cannot be told, so neither is a record."""
    quote, escape, sep = opts["quote"], opts["escape"], opts["sep"]
    if not quote:
        return F.lit(False)
    own = line
    if escape and escape != quote:
        for pair in (escape + escape, escape + quote):
            own = F.replace(own, F.lit(pair), F.lit(""))
    quotes = F.char_length(own) - F.char_length(F.replace(own, F.lit(quote), F.lit("")))
    return (quotes % 2 == 1) & (line.startswith(quote) | line.contains(sep + quote))


def escaped_by_us(spark: SparkSession, path: str) -> bool:
    """Whether this library wrote the text files in the folder, and so escaped line breaks in their values."""
    return exists(spark, f"{path.rstrip('/')}/{ESCAPED_MARK}")


def read_delimited(spark: SparkSession, path: str, columns: list[str] | T.StructType,
                   separator: str | None = None, *, multiline: bool = False,
                   options: dict | None = None, escaped: bool | None = None,
                   addresses: bool = False) -> DataFrame:
    """Delimited text, every field as a string, plus the raw line of any
    malformed record in ``_malformed_line`` (R1 routes those aside).

    Lines are read as text and parsed one by one, so a file splits anywhere, and
    a line whose quote is not closed is malformed.  With ``multiLine`` lines are
    joined to records, still in parallel (sources/records.py).  Options that concern
    whole files (``header``, ``encoding``, ...) go to the CSV reader.

    ``escaped`` tells whether line breaks in values are written as this library
    writes them; by default the mark that it leaves beside its files does.

    A line is parsed once: the record comes out of a generator, through which no
    filter or projection passes, so that none repeats the parsing."""
    names = columns.fieldNames() if isinstance(columns, T.StructType) else list(columns)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names]
                          + [T.StructField(MALFORMED_COLUMN, T.StringType())])
    opts = line_options(separator, options)
    opts.update({"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED_COLUMN})
    if multiline:
        opts["multiLine"] = "true"
    whole_files = bool({k.lower() for k in options or {}} - LINE_OPTIONS)
    if opts["multiLine"].lower() == "true" and opts["quote"] and not whole_files and not addresses:
        record = F.from_csv("record", schema.toDDL(), {k: v for k, v in opts.items() if k not in ("header", "lineSep")})
        # A record whose quote is still open where its file ends is malformed.
        record = F.when(F.col("closed"), record).otherwise(
            F.struct(*[F.lit(None).cast("string").alias(n) for n in names], F.col("record").alias(MALFORMED_COLUMN)))
        parsed = read_records(spark, path, opts["quote"], opts["escape"]).select(F.explode(F.array(record)).alias("r")).select("r.*")
    elif opts["multiLine"].lower() == "true" or whole_files:
        if addresses:
            raise ValueError("Line numbers are told only of text that is read line by line.")
        parsed = spark.read.schema(schema).options(**opts).csv(path)
    else:
        # The mark is taken before any line is left out.
        where = [F.col("a").alias(ADDRESS_COLUMN)] if addresses else []
        lines = addressed_lines(spark, path).select("value", *where)
        lines = lines.where("value <> ''")  # an empty line is no record
        broken = _unclosed_quote(F.col("value"), opts)
        opts = {k: v for k, v in opts.items() if k not in ("header", "lineSep", "multiLine")}
        record = F.when(~broken, F.from_csv("value", schema.toDDL(), opts)).otherwise(
            F.struct(*[F.lit(None).cast("string").alias(n) for n in names], F.col("value").alias(MALFORMED_COLUMN)))
        parsed = lines.select(*[ADDRESS_COLUMN] * addresses, F.explode(F.array(record)).alias("r")).select("r.*", *[ADDRESS_COLUMN] * addresses)
    if escaped is None:
        escaped = escaped_by_us(spark, path)
    if not escaped:
        return parsed
    return parsed.select(*[unescape_text(col(n)).alias(n) for n in names], MALFORMED_COLUMN, *[ADDRESS_COLUMN] * addresses)


def line_bases(spark: SparkSession, path: str) -> DataFrame:
    """(b_file, b_split, first, before) of every split of text files: its first line's mark and the number of lines
    of the file before it.  One count per split and a running sum over the splits of each file; the scan is split
    as that of ``read_delimited`` is, so that their marks agree."""
    lines = addressed_lines(spark, path).select("a")
    counted = lines.groupBy(F.col("a.file").alias("b_file"), F.col("a.split").alias("b_split")).agg(
        F.min("a.mark").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("b_file").orderBy("b_split").rowsBetween(Window.unboundedPreceding, -1)
    return counted.select("b_file", "b_split", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))


def read_json_lines(spark: SparkSession, path: str, target: T.StructType, *,
                    options: dict | None = None) -> DataFrame:
    """JSON lines under the target's columns: flat fields as text (R1 converts
    them), nested fields in their own type, and the raw text of a malformed
    line in ``_malformed_line``, so that no bad line loads as a row of nulls."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    schema = T.StructType([T.StructField(f.name, f.dataType if isinstance(f.dataType, nested)
                                         else T.StringType()) for f in target.fields]
                          + [T.StructField(MALFORMED_COLUMN, T.StringType())])
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED_COLUMN}
    opts.update(options or {})
    return spark.read.schema(schema).options(**opts).json(path)


def avro_available(spark: SparkSession) -> bool:
    """Whether the ``avro`` data source resolves (the module is external)."""
    try:
        spark.read.format("avro").schema("a int").load("/nonexistent/tablemover-avro-probe")
    except Exception as exc:  # a missing path is fine; a missing source is not
        return "Failed to find data source" not in str(exc)
    return True


def read_avro_schema_file(spark: SparkSession, schema_path: str) -> str:
    """The schema file is one small text; read it through Spark's file system."""
    return spark.read.text(schema_path, wholetext=True).first()[0]


def read_avro(spark: SparkSession, path: str, *, schema_inline: str | None = None,
              schema_path: str | None = None, options: dict | None = None) -> DataFrame:
    """Avro files under a schema given inline or by path (exactly one)."""
    if bool(schema_inline) == bool(schema_path):
        raise ValueError("Give exactly one of an inline Avro schema and an Avro schema path.")
    if not avro_available(spark):
        raise RuntimeError(
            "Reading Avro needs Spark's Avro module on the class path "
            "(spark-submit --packages org.apache.spark:spark-avro_2.13:<spark version>).")
    schema = schema_inline or read_avro_schema_file(spark, schema_path)
    return spark.read.format("avro").option("avroSchema", schema).options(**(options or {})).load(path)


def read_files(spark: SparkSession, path: str, file_format: str | None, *,
               columns: list[str] | T.StructType | None = None, separator: str | None = None,
               avro_schema_inline: str | None = None, avro_schema_path: str | None = None,
               options: dict | None = None, addresses: bool = False) -> DataFrame:
    """S1/S2/S3 by format name.  ``addresses`` tells of each row where it was read (text and Parquet).  The option
    ``driftingSchemas`` reads files of several schemas under the widest of their types (sources/drift.py)."""
    fmt = spark_format(file_format)
    if addresses and fmt not in ("csv", "parquet"):
        raise ValueError(f"Rows of {fmt} files have no address.")
    if fmt == "avro":
        return read_avro(spark, path, schema_inline=avro_schema_inline,
                         schema_path=avro_schema_path, options=options)
    if fmt == "csv":
        if columns is None:
            raise ValueError("Delimited text needs the target's column names.")
        return read_delimited(spark, path, columns, separator, options=options, addresses=addresses)
    if fmt == "json" and isinstance(columns, T.StructType):
        return read_json_lines(spark, path, columns, options=options)
    drifting = {k for k in options or {} if k.lower() == drift.OPTION and str(options[k]).lower() == "true"}
    if drifting and not addresses:
        return drift.read_drifting(spark, path, fmt, {k: v for k, v in options.items() if k not in drifting})
    rows = spark.read.format(fmt).options(**(options or {})).load(path)
    if addresses:  # a row's number in its file is its mark
        rows = rows.select("*", F.struct(F.col("_metadata.file_path").alias("file"), F.lit(0).cast("long").alias("split"),
                                         F.col("_metadata.row_index").alias("mark")).alias(ADDRESS_COLUMN))
    return rows
