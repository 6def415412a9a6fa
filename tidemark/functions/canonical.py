"""Canonical JSON text and content hashes, computed without leaving the JVM.

The canonical form is JSON with sorted keys, no spaces, explicit nulls and
everything outside printable ASCII written as ``\\uXXXX`` with lower-case digits.
Numbers keep the distinction between ``2`` and ``2.0``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# printable ASCII without quote and backslash, from end to end: far faster than a search for
# anything else, which tries the class anew at every character
_PLAIN = r"\A[ !#-\[\]-~]*+\z"


def _needs_escape(col: Column) -> Column:
    return ~col.rlike(_PLAIN)


def json_text(col: Column) -> Column:
    """A JSON string literal in ASCII."""
    # Rare path: split the UTF-16 form into 4-digit units and escape each one.
    units = F.regexp_extract_all(
        F.lower(F.hex(F.encode(col, "UTF-16BE"))), F.lit("([0-9a-f]{4})"), F.lit(1)
    )
    short = {"0022": '\\"', "005c": "\\\\", "000a": "\\n", "000d": "\\r", "0009": "\\t",
             "0008": "\\b", "000c": "\\f"}

    def unit(u: Column) -> Column:
        chain = None
        for code, text in short.items():
            chain = (F if chain is None else chain).when(u == code, F.lit(text))
        printable = u.between("0020", "007e")
        chain = chain.when(printable, F.char(F.conv(u, 16, 10).cast("bigint")))
        return chain.otherwise(F.concat(F.lit("\\u"), u))

    escaped = F.array_join(F.transform(units, unit), "")
    return _quoted(F.when(_needs_escape(col), escaped).otherwise(col))


def json_number(col: Column) -> Column:
    """A double as JSON: positional from 1e-4 up to 1e16, exponent form beyond."""
    text = col.cast("string")
    parts = F.regexp_extract
    pattern = r"^(-?)(\d)\.(\d+)E(-?\d+)$"
    sign, lead, tail = (parts(text, pattern, i) for i in (1, 2, 3))
    digits = F.concat(lead, F.regexp_replace(tail, "^0$", ""))
    exponent = parts(text, pattern, 4).try_cast("int")
    count = F.length(digits)
    # right-padded with zeros up to the decimal point, e.g. 1.5E7 -> 15000000.0
    padded = F.rpad(digits, F.greatest(exponent + 1, count), "0")
    large = F.concat(
        F.substring(padded, F.lit(1), exponent + 1),
        F.lit("."),
        F.coalesce(F.nullif(F.substring(padded, exponent + 2, count), F.lit("")), F.lit("0")),
    )
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), digits)
    mantissa = F.concat(
        lead, F.when(count > 1, F.concat(F.lit("."), F.substring(digits, 2, 400))).otherwise("")
    )
    power = F.concat(
        F.lit("e"), F.when(exponent < 0, "-").otherwise("+"),
        F.lpad(F.abs(exponent).cast("string"), F.greatest(F.lit(2), F.length(F.abs(exponent).cast("string"))), "0"),
    )
    rewritten = F.concat(
        sign,
        F.when(exponent.between(0, 15), large)
        .when(exponent.between(-4, -1), small)
        .otherwise(F.concat(mantissa, power)),
    )
    return F.when(F.isnan(col), "NaN").when(text.contains("E"), rewritten).otherwise(text)


def _quoted(col: Column) -> Column:
    """A JSON string literal of a text that needs no escape."""
    return F.concat(F.lit('"'), col, F.lit('"'))


def _json_value(col: Column, dtype: T.DataType, text: Callable[[Column], Column]) -> Column:
    if isinstance(dtype, T.StringType):
        value = text(col)
    elif isinstance(dtype, (T.DoubleType, T.FloatType)):
        value = json_number(col.cast("double"))
    elif isinstance(dtype, (T.IntegralType, T.BooleanType)):
        value = col.cast("string")
    elif isinstance(dtype, T.StructType) and dtype.names == ["kind", "text"]:
        # a sheet cell: numbers and booleans already hold their JSON text
        value = F.when(col["kind"] == "s", text(col["text"])).otherwise(col["text"])
    elif isinstance(dtype, T.MapType):
        entries = F.transform(
            F.array_sort(F.map_keys(col)),
            lambda key: F.concat(
                text(key), F.lit(":"), _json_value(F.element_at(col, key), dtype.valueType, text)
            ),
        )
        value = F.concat(F.lit("{"), F.array_join(entries, ","), F.lit("}"))
    else:  # dates, timestamps, decimals: their text
        value = _quoted(col.cast("string"))
    return F.coalesce(value, F.lit("null"))


def canonical_json(df: DataFrame, values: Mapping[str, Column] | list[str]) -> Column:
    """Canonical JSON object of the given columns, keys in sorted order.

    ``values`` is a list of column names or a mapping of JSON key to Column.
    Records without a character that needs an escape, nearly all of them, are
    recognised with one test per record and joined by plain concatenation.
    """
    if not isinstance(values, Mapping):
        values = {name: F.col(name) for name in values}
    names = sorted(values)
    types = {f.name: f.dataType for f in df.select(*[values[n].alias(n) for n in names]).schema}
    texts = {n for n in names if isinstance(types[n], T.StringType)}
    maps = [n for n in names if isinstance(types[n], T.MapType)]
    keys = {n: F.lit(f'"{n}":') for n in names}

    simple = {n: _json_value(values[n], types[n], _quoted) for n in names}
    plain = [F.concat(keys[n], simple[n]) for n in names]
    # The other path encodes all texts in one pass over an array, which keeps the plan small.
    none = F.lit(None).cast("string")
    raw = F.array(
        *[F.struct(keys[n].alias("key"), (values[n] if n in texts else none).alias("text")) for n in names]
    )
    exact = {n: _json_value(values[n], types[n], json_text) for n in maps}
    done = F.array(*[none if n in texts else exact.get(n, simple[n]) for n in names])
    escaped = F.zip_with(
        raw, done, lambda r, d: F.concat(r["key"], F.coalesce(d, json_text(r["text"]), F.lit("null")))
    )
    seen = [values[n] for n in sorted(texts)] + [values[n].cast("string") for n in maps]
    body = F.when(_needs_escape(F.concat_ws("", *seen)), F.array_join(escaped, ",")).otherwise(
        F.concat_ws(",", *plain)
    )
    return F.concat(F.lit("{"), body, F.lit("}"))


def content_hash(df: DataFrame, values: Mapping[str, Column] | list[str]) -> Column:
    """SHA-256 (hex) of the canonical JSON."""
    return F.sha2(canonical_json(df, values), 256)
