"""Lenient typed casts for raw feed text, and schema conformance.

Raw feeds are read with every field as a string; these casts then type them
without ever failing a job (ANSI mode aborts on one bad ``cast``):

* boolean: ``true/false``, ``1/0`` and ``1.0/0.0`` (feeds write flags as numbers)
* date: ISO text, or epoch milliseconds of whole UTC days (pandas' JSON date format)
* int: ``1234`` or ``1234.0`` (a float column with gaps)
* double, timestamp: plain ``try_cast``

A ``try_cast`` of text to a number or flag raises and catches an error inside Spark for each text that is none, which
costs far more than the cast; so text is cast only where a pattern, never narrower than the cast, lets it through.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _try_cast(c: Column, type_name: str) -> Column:
    return c.try_cast(type_name)


# what the casts themselves trim, and the texts that they may take between
_EDGE = r"[\x00-\x20\x7f]*"
_EXPONENT = r"(e[+-]?[0-9]+)?[df]?"
FLAG_TEXT = rf"(?i)^{_EDGE}(t|true|y|yes|1|f|false|n|no|0){_EDGE}$"
WHOLE_TEXT = rf"^{_EDGE}[+-]?[0-9]+{_EDGE}$"
NUMBER_TEXT = (rf"(?i)^{_EDGE}[+-]?([0-9]+\.?[0-9]*{_EXPONENT}|\.[0-9]+{_EXPONENT}|0x[0-9a-f]*\.?[0-9a-f]*p[+-]?[0-9]+[df]?"
               rf"|nan|inf|infinity){_EDGE}$")


def _matching(c: Column, pattern: str, type_name: str) -> Column:
    return F.when(c.rlike(pattern), _try_cast(c, type_name))


def lenient_double(c: Column) -> Column:
    return _matching(c, NUMBER_TEXT, "double")


def lenient_bool(c: Column) -> Column:
    """``true/false``, ``1/0``, and ``1.0/0.0`` (a flag column with gaps)."""
    s = F.trim(c)
    number = lenient_double(s)
    return F.coalesce(_matching(s, FLAG_TEXT, "boolean"), F.when(number == 1, True).when(number == 0, False))


EPOCH_DAY = "1970-01-01"
MILLIS_PER_DAY = 86_400_000


def lenient_date(c: Column) -> Column:
    """ISO date text, or epoch milliseconds of a UTC midnight (pandas' JSON
    dates); the day count is taken in UTC, whatever the session zone.  Any
    other integer, such as ``20240101``, is no date."""
    s = F.trim(c)
    millis = _matching(s, WHOLE_TEXT, "bigint")
    days = F.when(millis % MILLIS_PER_DAY == 0, F.floor(millis / F.lit(MILLIS_PER_DAY)).try_cast("int"))
    return F.when(millis.isNull(), _try_cast(s, "date")).otherwise(
        F.date_add(F.lit(EPOCH_DAY).cast("date"), days))


def _lenient_whole(c: Column, type_name: str) -> Column:
    s = F.trim(c)
    d = lenient_double(s)
    whole = F.when(d == F.floor(d), _try_cast(d, type_name))
    return F.coalesce(_matching(s, WHOLE_TEXT, type_name), whole)


def lenient_int(c: Column) -> Column:
    return _lenient_whole(c, "int")


def lenient_bigint(c: Column) -> Column:
    return _lenient_whole(c, "bigint")


def lenient_cast(c: Column, dtype: T.DataType) -> Column:
    """Cast a string column to ``dtype`` without raising."""
    if isinstance(dtype, T.StringType):
        return c
    if isinstance(dtype, T.BooleanType):
        return lenient_bool(c)
    if isinstance(dtype, T.DateType):
        return lenient_date(c)
    if isinstance(dtype, T.IntegerType):
        return lenient_int(c)
    if isinstance(dtype, T.LongType):
        return lenient_bigint(c)
    if isinstance(dtype, T.DoubleType):
        return lenient_double(c)
    return _try_cast(c, dtype.simpleString())


def type_strings(df: DataFrame, schema: T.StructType, keep: tuple[str, ...] = (), failed: str | None = None) -> DataFrame:
    """Project string columns named like ``schema`` to its types.

    Names are compared without case; of columns that differ only by case the
    first counts.  Fields missing from ``df`` become typed NULLs; ``keep`` names extra
    columns carried through unchanged (lineage, corrupt-record text).  ``failed`` names a
    ``map<string,string>`` column that keeps the text of every field that has one but no value of its
    type, by field; NULL for rows without any.
    """
    cols, texts = [], []
    present = set(df.columns)
    by_name = {c.lower(): c for c in reversed(df.columns)}
    for f in schema.fields:
        if f.name.lower() in by_name:
            text = df[f"`{by_name[f.name.lower()]}`"]
            cols.append(lenient_cast(text, f.dataType).alias(f.name))
            if not isinstance(f.dataType, T.StringType):
                texts.append((f.name, f"_text_{f.name}", text))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    kept = [F.col(f"`{k}`") for k in keep if k in present]
    if not failed:
        return df.select(*cols, *kept)
    # values are cast once, in a projection of their own; only a row with a bad field makes a map
    typed = df.select(*cols, *kept, *[text.alias(name) for _, name, text in texts])
    lost = {n: F.col(f"`{name}`").isNotNull() & F.col(f"`{n}`").isNull() for n, name, _ in texts}
    entries = F.array_compact(F.array(*[F.when(bad, F.struct(F.lit(n).alias("key"), F.col(f"`_text_{n}`").alias("value")))
                                        for n, bad in lost.items()]))
    bad_fields = F.when(reduce(or_, lost.values()), F.map_from_entries(entries)) if lost else F.lit(None).cast("map<string,string>")
    return typed.select(*[F.col(f"`{f.name}`") for f in schema.fields], bad_fields.alias(failed), *kept)


def conform(df: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Give an already-typed frame exactly ``schema``'s columns, in order.

    Present columns are cast to the declared type (lenient for strings),
    missing ones are added as typed NULLs.
    """
    cols = []
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    for f in schema.fields:
        if f.name not in types:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif types[f.name] == f.dataType:
            cols.append(F.col(f"`{f.name}`"))
        elif isinstance(types[f.name], T.StringType):
            cols.append(lenient_cast(F.col(f"`{f.name}`"), f.dataType).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`").try_cast(f.dataType.simpleString()).alias(f.name))
    cols += [F.col(f"`{k}`") for k in keep if k in types]
    return df.select(*cols)


def string_schema(names: list[str], corrupt: str | None = "_corrupt_record") -> T.StructType:
    fields = [T.StructField(n, T.StringType(), True) for n in names]
    if corrupt:
        fields.append(T.StructField(corrupt, T.StringType(), True))
    return T.StructType(fields)
