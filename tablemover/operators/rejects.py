"""Set aside the rows a target would refuse, before the write.

* R1 ``conversion_split`` - rows whose values do not fit the target's types
  (or whose text line is malformed) go to the first error table.
* R2 ``duplicate_split`` - of all rows sharing a key, one stays (the least by
  the other columns, so the choice does not depend on partitioning); the rest go
  to the second error table.
* R3 ``prepare_reject_tables`` - drop leftovers of an earlier run.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.files import ADDRESS_COLUMN, MALFORMED_COLUMN, OWN_COLUMNS
from ..spec import TableName
from ..workspace import new_run_dir, stage
from .names import col, cols, same_keys
from .reconcile import Digest, digest_columns, digest_from
from .spread import in_tasks

REASON_COLUMN = "reject_reason"
# On request: the values that did not fit, and where their row was read.
VALUES_COLUMN, FILE_COLUMN, LINE_COLUMN = "reject_values", "reject_file", "reject_line"
_NESTED = (T.StructType, T.ArrayType, T.MapType)


# Ranges of the integral types a value may be narrowed into.
_INTEGRAL_RANGE = {T.ByteType: (-(2 ** 7), 2 ** 7 - 1), T.ShortType: (-(2 ** 15), 2 ** 15 - 1),
                   T.IntegerType: (-(2 ** 31), 2 ** 31 - 1), T.LongType: (-(2 ** 63), 2 ** 63 - 1)}


def _decimals_fit(src, value, scale: int):
    """Whether a text's number has no digit but zeros beyond ``scale`` decimals."""
    plain = src.rlike(rf"^[^.eE]*(\.\d{{0,{scale}}}0*)?\s*$")
    return plain | (src.rlike("[eE]") & (value.cast("double") == src.try_cast("double")))


def _magnitude_fits(src, value):
    """Whether a text's float is not beyond the type: infinity fits only its own name, and zero only zeros."""
    infinite = F.abs(value) == F.lit(float("inf"))
    return F.when(infinite, src.rlike(r"(?i)^\s*[+-]?inf")).when(value == 0, ~src.rlike(r"^[^eE]*[1-9]")).otherwise(True)


def _moment_fits(src, local: bool):
    """Whether a text's moment has a date of its own, no digit but zeros beyond micro-seconds, and, for a type
    without a zone, no zone."""
    fits = ~src.rlike(r"\.\d{6}\d*[1-9]") & ~src.rlike(r"^\s*T?\d{1,2}:")
    return fits & ~src.rlike(r":.*[A-Za-z+-]") if local else fits


def _has_map(t) -> bool:
    return isinstance(t, T.MapType) or (isinstance(t, T.ArrayType) and _has_map(t.elementType)) or (
        isinstance(t, T.StructType) and any(_has_map(f.dataType) for f in t.fields))


def _converted(src, src_type, dst_type, encoded: bool):
    """Value in the target type, or null when it does not fit.

    A value fits only if nothing is lost: cast back, it is the value it came
    from.  Text fits if it spells a value of the type, for a decimal or a date
    without digits or a time of day beyond it; a text of a float or double takes
    the nearest value, as such numbers are always written, but not infinity or
    zero for a number beyond the type; a moment keeps all its digits and its zone.  ``encoded`` text
    spells binary values in base64.

    Narrowing a number into a smaller integer is a range test, which stays in
    generated code; ``try_cast`` would raise and catch one exception per value
    that overflows (about 5 times slower when many do).
    """
    bounds = _INTEGRAL_RANGE.get(type(dst_type))
    if bounds and isinstance(src_type, T.NumericType):
        lo, hi = bounds
        if isinstance(src_type, T.IntegralType):
            return F.when(src.between(lo, hi), src.cast(dst_type))
        number = Decimal if isinstance(src_type, T.DecimalType) else float
        inside = (src >= F.lit(number(lo))) & (src < F.lit(number(hi + 1)))
        value = F.when(inside, src.cast(dst_type))
    elif bounds and isinstance(src_type, T.StringType):
        # By way of a long, so that a number beyond the type is no exception either.
        number = src.try_cast("long")
        return F.when(number.between(*bounds), number.cast(dst_type))
    elif isinstance(src_type, T.StringType) and isinstance(dst_type, T.BinaryType) and encoded:
        return F.try_to_binary(src, F.lit("base64"))
    else:
        value = src.try_cast(dst_type)
    if isinstance(src_type, T.StringType):
        if isinstance(dst_type, T.DecimalType):
            return F.when(_decimals_fit(src, value, dst_type.scale), value)
        if isinstance(dst_type, T.DateType):
            return F.when(value.cast("timestamp_ntz") == src.try_cast("timestamp_ntz"), value)
        if isinstance(dst_type, (T.FloatType, T.DoubleType)):
            return F.when(_magnitude_fits(src, value), value)
        if isinstance(dst_type, (T.TimestampType, T.TimestampNTZType)):
            return F.when(_moment_fits(src, isinstance(dst_type, T.TimestampNTZType)), value)
        if not isinstance(dst_type, T.BinaryType):
            return value
    if _has_map(src_type) or _has_map(dst_type):  # maps cannot be compared
        return value
    return F.when(value.try_cast(src_type) == src, value)


def _fit(df: DataFrame, target: T.StructType, limits: dict[str, int] | None = None):
    """Per target field: (converted value, does-not-fit flag)."""
    by_lower = {c.lower(): c for c in df.columns}
    limit_of = {k.lower(): v for k, v in (limits or {}).items()}
    encoded = MALFORMED_COLUMN in df.columns  # read from text
    out = []
    for f in target.fields:
        src_name = by_lower.get(f.name.lower())
        if src_name is None:
            out.append((f.name, F.lit(None).cast(f.dataType), F.lit(not f.nullable)))
            continue
        src_type = df.schema[src_name].dataType
        src = col(src_name)
        if src_type == f.dataType:
            value = src
        elif isinstance(src_type, T.NullType):
            value = F.lit(None).cast(f.dataType)
        elif isinstance(src_type, _NESTED) and not isinstance(f.dataType, _NESTED):
            raise ValueError(f"Column {src_name} is nested ({src_type.simpleString()}) but the "
                             f"target column is flat; turn it to text first with to_json.")
        else:
            value = _converted(src, src_type, f.dataType, encoded)
        bad = src.isNotNull() & value.isNull()
        if not f.nullable:
            bad = bad | src.isNull()
        limit = limit_of.get(f.name.lower())
        if limit is not None:  # trailing spaces may be cut to fit, as the write does
            bad = bad | (F.length(F.rtrim(value.cast("string"))) > limit)
        out.append((f.name, value, bad))
    return out


def _judged(df: DataFrame, target: T.StructType, limits: dict[str, int] | None):
    """(converted columns, reason): the reason is empty where all fit."""
    fits = _fit(df, target, limits)
    reasons = [F.when(bad, F.lit(name)) for name, _, bad in fits]
    if MALFORMED_COLUMN in df.columns:
        reasons = [F.when(col(MALFORMED_COLUMN).isNotNull(), F.lit(MALFORMED_COLUMN))] + reasons
    return [value.alias(name) for name, value, _ in fits], F.concat_ws(",", *reasons)


def conversion_split(df: DataFrame, target: T.StructType, limits: dict[str, int] | None = None
                     ) -> tuple[DataFrame, DataFrame]:
    """(rows converted to ``target``, rejected source rows + ``reject_reason``).

    ``reject_reason`` lists the target columns that did not fit, comma-separated,
    or names the malformed-line column for text that did not parse.  ``limits``
    are the declared lengths of CHAR/VARCHAR columns.
    """
    values, reason = _judged(df, target, limits)
    good = df.where(reason == "").select(*values)
    rejects = df.where(reason != "").select(*cols(df.columns), reason.alias(REASON_COLUMN))
    return good, rejects


def with_addresses(rejects: DataFrame, target: T.StructType, limits: dict[str, int] | None, bases: DataFrame | None) -> DataFrame:
    """Conversion rejects with the values that did not fit, as (column, value as text), and the file and number of
    their line (of their row, for Parquet), instead of the address they were read with.  ``bases`` are
    ``line_bases``, None where marks are numbers already."""
    source = rejects.drop(REASON_COLUMN)
    bad = [F.when(bad, F.struct(F.lit(name).alias("column"), col(by).cast("string").alias("value")))
           for (name, _, bad), by in ((f, _source_of(source, f[0])) for f in _fit(source, target, limits)) if by]
    if MALFORMED_COLUMN in rejects.columns:
        raw = F.struct(F.lit(MALFORMED_COLUMN).alias("column"), col(MALFORMED_COLUMN).alias("value"))
        bad = [F.when(col(MALFORMED_COLUMN).isNotNull(), raw), *[F.when(col(MALFORMED_COLUMN).isNull(), b) for b in bad]]
    at = col(ADDRESS_COLUMN)
    told = rejects.withColumns({VALUES_COLUMN: F.array_compact(F.array(*bad)), FILE_COLUMN: at["file"]})
    if bases is None:
        out = told.withColumn(LINE_COLUMN, at["mark"] + 1)
    else:
        out = told.join(bases, (at["file"] == F.col("b_file")) & (at["split"] == F.col("b_split")), "left").withColumn(
            LINE_COLUMN, F.col("before") + at["mark"] - F.col("first") + 1)
    kept = [c for c in rejects.columns if c != ADDRESS_COLUMN]
    return out.select(*cols(kept), VALUES_COLUMN, FILE_COLUMN, LINE_COLUMN)


def _source_of(df: DataFrame, name: str) -> str | None:
    return next((c for c in df.columns if c.lower() == name.lower()), None)


def staged_conversion(df: DataFrame, target: T.StructType, limits: dict[str, int] | None, folder: str,
                      prove: bool = False) -> dict[str, Digest]:
    """``conversion_split`` in one pass over the source: every row is written to ``folder`` once, under the
    target's types or, if it does not fit, as it came; ``converted_sides`` reads both sides.  What comes later
    reads columns of that, so the source is neither read nor converted again, and may change.  With ``prove`` the
    same pass returns the digests of the source, of its rejected rows and of the converted ones."""
    values, reason = _judged(df, target, limits)
    # A column that is NULL throughout has a type that files cannot hold.
    own = [col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, T.NullType) else col(f.name) for f in df.schema.fields]
    judged = df.select(F.struct(*own).alias("source"), F.struct(*values).alias("row"), reason.alias(REASON_COLUMN))
    # Out of a generator, so that nothing above repeats the conversion.
    judged = judged.select(F.inline(F.array(F.struct("source", "row", REASON_COLUMN))))
    fits = F.col(REASON_COLUMN) == ""
    digests = {}
    if prove:
        seen = Observation()
        source_schema, row_schema = judged.schema["source"].dataType, judged.schema["row"].dataType
        own = [c for c in source_schema.fieldNames() if c != ADDRESS_COLUMN]
        judged = judged.observe(seen, *digest_columns(source_schema, "source", columns=own, of="source"),
                                *digest_columns(source_schema, "rejected", ~fits, columns=own, of="source"), *digest_columns(row_schema, "converted", fits, of="row"))
    stage(judged.select(F.when(fits, F.col("row")).alias("row"), F.when(~fits, F.col("source")).alias("source"), REASON_COLUMN, _place()), folder)
    if prove:
        digests = {n: digest_from(seen.get, n) for n in ("source", "rejected", "converted")}
    return digests


def converted_rows(spark, folder: str) -> tuple[DataFrame, DataFrame]:
    """(staged rows that fit the target, rejected source rows + ``reject_reason``) of a staged conversion."""
    both = in_tasks(spark.read.parquet(folder))
    fits = F.col(REASON_COLUMN) == ""
    source = both.schema["source"].dataType.fieldNames()
    return both.where(fits).select("row", PLACE), both.where(~fits).select(*[F.col("source").getField(c).alias(c) for c in source], REASON_COLUMN)


def converted_sides(spark, folder: str) -> tuple[DataFrame, DataFrame]:
    """(rows converted to the target, rejected source rows + ``reject_reason``) of a staged conversion."""
    rows, rejects = converted_rows(spark, folder)
    return plain(rows), rejects


def matched_columns(df: DataFrame, target: T.StructType, mapping: dict[str, str] | None = None,
                    allow_unmatched: bool = False) -> DataFrame:
    """``df`` under the target's column names.  Without a ``mapping`` (target column -> source column, which
    says all that is loaded) the names must be the same, letter case aside; a difference is an error that
    names both sides unless ``allow_unmatched``, which drops the one and fills the other with NULL."""
    own = [c for c in df.columns if c not in OWN_COLUMNS]
    if mapping:
        by_lower = {c.lower(): c for c in own}
        wrong = [f"{t} <- {s}" for t, s in mapping.items()
                 if s.lower() not in by_lower or t.lower() not in {f.lower() for f in target.fieldNames()}]
        if wrong:
            raise ValueError(f"The column mapping names unknown columns: {wrong}; the source has {own}, "
                             f"the target {target.fieldNames()}.")
        more = [col(c) for c in OWN_COLUMNS if c in df.columns]
        return df.select(*[col(by_lower[s.lower()]).alias(t) for t, s in mapping.items()], *more)
    theirs, ours = {f.lower() for f in target.fieldNames()}, {c.lower() for c in own}
    extra = [c for c in own if c.lower() not in theirs]
    missing = [f for f in target.fieldNames() if f.lower() not in ours]
    if (extra or missing) and not allow_unmatched:
        raise ValueError(f"Source and target columns differ: only in the source {extra}, only in the target "
                         f"{missing}; give a column mapping or allow unmatched columns.")
    return df


def _orderable(value, data_type) -> list:
    """Columns that order the values of a column totally: -0.0 and 0.0 apart, maps by their JSON text."""
    if _has_map(data_type):
        return [F.to_json(F.struct(value.alias("v")))]
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return [value, value.cast("string")]
    return [value]


# Staged rows are (row, place): the columns, and a number of the row's own that is staged with it and rises row by row
# in a file.  No place is hot, whatever the rows hold.
PLACE = "place"
# Sets of places are marks, (word, bits) with a bit for each of 64 places; a block is 512 words, 4 KB.
WORD_BITS, BLOCK_BITS = 6, 15
# Blocks up to which marks are broadcast (64 MB, half a billion rows); beyond, rows are shuffled to them.
MOST_BLOCKS = 16384
# Types whose least value a hash aggregate finds without sorting rows.
_FIXED_WIDTH = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def _place():
    return F.monotonically_increasing_id().alias(PLACE)


def staged_rows(df: DataFrame, folder: str) -> DataFrame:
    """Stage ``df`` as (row, place)."""
    return in_tasks(stage(df.select(F.struct(*cols(df.columns)).alias("row"), _place()), folder))


def plain(rows: DataFrame) -> DataFrame:
    """The columns of staged rows."""
    return rows.select(*[F.col("row").getField(c).alias(c) for c in rows.schema["row"].dataType.fieldNames()])


def marks_of(places: DataFrame) -> DataFrame:
    """Marks of the places that come an odd number of times."""
    bit = F.expr(f"shiftleft(1L, cast({PLACE} & 63 AS int))")
    return places.groupBy(F.shiftright(PLACE, WORD_BITS).alias("word")).agg(F.bit_xor(bit).alias("bits")).where("bits <> 0")


def _marked(rows: DataFrame, marks: DataFrame, marked: bool) -> DataFrame:
    """Staged rows whose place the staged ``marks`` have, or have not."""
    low = BLOCK_BITS - WORD_BITS
    words = marks.select(F.shiftright("word", low).alias("block"), F.col("word").bitwiseAND((1 << low) - 1).alias("at"), "bits")
    blocks = words.select("block").distinct()
    # Every word of a block, so that one is found by its place in the array.
    blank = blocks.select("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit((1 << low) - 1).cast("long"))).alias("at"), F.lit(0).cast("long").alias("bits"))
    full = words.unionByName(blank).groupBy("block", "at").agg(F.bit_or("bits").alias("bits")).groupBy("block").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("at", "bits"))), lambda w: w["bits"]).alias("words"))
    if blocks.count() <= MOST_BLOCKS:
        full = F.broadcast(full)
    met = rows.withColumn("block", F.shiftright(PLACE, BLOCK_BITS)).join(full, "block", "inner" if marked else "left")
    word = F.get("words", F.shiftright(PLACE, WORD_BITS).bitwiseAND((1 << low) - 1).cast("int"))
    hit = F.coalesce(F.call_function("shiftright", word, F.col(PLACE).bitwiseAND(63).cast("int")).bitwiseAND(1) == 1, F.lit(False))
    return met.where(hit if marked else ~hit).select("row", PLACE)


def _named_keys(rows: DataFrame, key: list[str]) -> list[str]:
    """Names for the key columns that nothing else here has."""
    return [f"k{i}" for i in range(len(key))]


def _keyed(rows: DataFrame, key: list[str], *more) -> DataFrame:
    return rows.select(*[F.col("row").getField(c).alias(n) for c, n in zip(key, _named_keys(rows, key))], PLACE, *more)


def repeated_rows(rows: DataFrame, key: list[str], folder: str) -> DataFrame | None:
    """Marks of all rows of repeated keys but the least by the other columns, None if no key repeats.
    ``rows`` are staged.

    Keys are counted by a partial aggregate, whose shuffle carries keys and not rows; for a first other column
    of fixed width it finds the least value too.  A second shuffle finds the rows of repeated keys, by key, first
    other column and place.  Only rows that share the least are compared as a whole."""
    k = _named_keys(rows, key)
    schema = rows.schema["row"].dataType
    order = [c for c in schema.fieldNames() if c not in key]
    first = order[0] if order and isinstance(schema[order[0]].dataType, _FIXED_WIDTH) else None
    own = [F.col("row").getField(first).alias("first")] if first else []
    more = [F.min("first").alias("lo"), F.bool_or(F.col("first").isNull()).alias("gap")] if first else []
    keyed = _keyed(rows, key, *own)
    repeated = stage(keyed.groupBy(*k).agg(F.count(F.lit(1)).alias("n"), *more).where("n > 1").drop("n"), f"{folder}/repeated")
    if repeated.isEmpty():
        return None
    same = same_keys([F.col(n) for n in k], [F.col(f"r_{n}") for n in k])
    repeated = repeated.select(*[F.col(n).alias(f"r_{n}") for n in k], *[n for n in ("lo", "gap") if more])
    # NULL is least, and equals no value
    least = F.when(F.col("gap"), F.col("first").isNull()).otherwise(F.col("first") == F.col("lo")) if first else F.lit(True)
    again = stage(keyed.join(repeated, same).select(*k, PLACE, least.alias("least")), f"{folder}/again")
    low = again.where("least")
    tied = stage(low.groupBy(*k).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*[F.col(n).alias(f"r_{n}") for n in k]), f"{folder}/tied")
    out = again.where("NOT least").select(PLACE)
    if not tied.isEmpty():
        equal = low.join(tied, same, "left_semi").select(PLACE)
        compared = _marked(rows, stage(marks_of(equal), f"{folder}/equal"), True)
        rank = [o for c in [*order, *key] for o in _orderable(F.col("row").getField(c), schema[c].dataType)]  # 0.0 and -0.0 are one key
        ranked = _keyed(compared, key, F.struct(*[o.alias(f"o{i}") for i, o in enumerate(rank)]).alias("rank"))
        stays = ranked.groupBy(*k).agg(F.min(F.struct("rank", PLACE)).alias("least")).select(f"least.{PLACE}")
        out = out.unionByName(equal).unionByName(stays)  # one that is there twice is not marked
    return marks_of(out)


def held_rows(rows: DataFrame, key: list[str], held: DataFrame) -> DataFrame:
    """Marks of the rows whose key ``held`` has, under the same names.  NULL equals NULL.  ``rows`` are staged."""
    k = _named_keys(rows, key)
    theirs = held.select(*[col(c).alias(f"t_{n}") for c, n in zip(key, k)])
    return marks_of(_keyed(rows, key).join(theirs, same_keys([F.col(n) for n in k], [F.col(f"t_{n}") for n in k]), "left_semi").select(PLACE))


def key_range(rows: DataFrame, column: str) -> tuple | None:
    """(least, greatest, whether there are NULLs) of an orderable column; None if all are NULL or it has no range."""
    if not isinstance(rows.schema[column].dataType, (*_FIXED_WIDTH, T.StringType)):
        return None
    r = rows.agg(F.min(col(column)).alias("lo"), F.max(col(column)).alias("hi"), F.bool_or(col(column).isNull()).alias("gap")).first()
    return None if r["lo"] is None else (r["lo"], r["hi"], bool(r["gap"]))


def in_range(held: DataFrame, column: str, bounds: tuple | None) -> DataFrame:
    """``held`` cut to a range of ``key_range``."""
    if bounds is None:
        return held
    lo, hi, gap = bounds
    inside = col(column).between(F.lit(lo), F.lit(hi))
    return held.where(inside | col(column).isNull() if gap else inside)


def stage_out(out: DataFrame | None, folder: str) -> None:
    """Stage marks of rows that go, beside those staged before; no row is marked twice."""
    if out is not None:
        out.write.mode("append").parquet(folder)


def split_rows(rows: DataFrame, out: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """(staged rows that stay, those of the staged marks ``out``).  Where these are none, or all, nothing is
    joined; else the marks are broadcast, so that rows stay where they are read."""
    n = 0 if out is None else out.agg(F.sum(F.bit_count("bits"))).first()[0] or 0
    if n == 0:
        return rows, rows.limit(0)
    if n == rows.count():
        return rows.limit(0), rows
    return _marked(rows, out, False), _marked(rows, out, True)


def without_rows(rows: DataFrame, out: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """The columns of ``split_rows``."""
    stays, goes = split_rows(rows, out)
    return plain(stays), plain(goes)


def checked_key(df: DataFrame, key_columns) -> list[str]:
    """The key columns under their own spelling."""
    by_lower = {c.lower(): c for c in df.columns}
    missing = [k for k in key_columns if k.lower() not in by_lower]
    if missing:
        raise ValueError(f"Key columns {missing} are not in the rows.")
    key = [by_lower[k.lower()] for k in key_columns]
    unfit = [k for k in key if _has_map(df.schema[k].dataType)]
    if unfit:
        raise ValueError(f"Key columns {unfit} hold maps, which cannot be compared.")
    return key


def duplicate_split(df: DataFrame, key_columns, *, folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(one row per key, all other rows).

    The row that stays is the least by the other columns.  NULL in a key equals
    NULL: rows without a key value are duplicates of one another.  Rows come out
    as they went in, to the bit.

    The rows are staged once in ``folder``, each with a number of its own.  The
    numbers of the rows that go are found by keys and staged as marks, 64 rows to a
    word, by which the rows are parted without a shuffle."""
    key = checked_key(df, key_columns)
    folder = folder or new_run_dir(df.sparkSession, "duplicates")
    rows = staged_rows(df, f"{folder}/rows")
    again = repeated_rows(rows, key, folder)
    return without_rows(rows, None if again is None else stage(again, f"{folder}/out"))


def prepare_reject_tables(warehouse, tables: tuple[TableName, ...], *, drop: bool) -> list[str]:
    """Drop ``_ERR_1`` then ``_ERR_2`` when asked; return what was dropped.

    Without ``drop`` a leftover table is an error: new rejects must not mix
    with an earlier run's.
    """
    dropped = []
    for table in tables:
        if warehouse.exists(table):
            if not drop:
                raise ValueError(f"Error table {table.qualified()} exists from an earlier run; "
                                 "drop it or allow dropping error tables.")
            warehouse.drop(table)
            dropped.append(table.qualified())
    return dropped
