"""General column functions: safe arithmetic, strings, hashes, dates, weather."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

Col = str | Column


def _c(value: Col) -> Column:
    return F.col(value) if isinstance(value, str) else value


# --- metrics ---------------------------------------------------------------


def ratio(numerator: Col, denominator: Col) -> Column:
    """Quotient, NULL for a zero denominator."""
    return F.try_divide(_c(numerator), _c(denominator))


def percentage(value: Col, total: Col) -> Column:
    return F.try_divide(_c(value), _c(total)) * 100


def difference(left: Col, right: Col) -> Column:
    return _c(left) - _c(right)


def safe_divide(numerator: Col, denominator: Col, default: float = 0.0) -> Column:
    """Quotient, or ``default`` for a zero denominator."""
    n, d = _c(numerator), _c(denominator)
    return F.when(d == 0, F.lit(default)).otherwise(F.try_divide(n, d))


# --- strings ---------------------------------------------------------------

# Fixed value: address pattern.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"


def valid_email(value: Col) -> Column:
    return F.coalesce(_c(value).rlike(EMAIL_PATTERN), F.lit(False))


def matches_prefix(value: Col, pattern: str) -> Column:
    """Does the value, as text, match the pattern from its start? NULL reads ``nan``."""
    return F.coalesce(_c(value).cast("string"), F.lit("nan")).rlike(f"^(?:{pattern})")


def truncate(value: Col, max_length: int, suffix: str = "...") -> Column:
    v = _c(value)
    cut = F.concat(F.substring(v, 1, max_length - len(suffix)), F.lit(suffix))
    return F.when(F.length(v) <= max_length, v).otherwise(cut)


# Characters a file name may not hold, and its longest length.
UNSAFE_CHARS = '<>:"/\\|?*'
MAX_NAME = 255


def sanitize_name(value: Col) -> Column:
    """Safe file name: bad characters become ``_``, the extension survives a cut."""
    clean = F.translate(_c(value), UNSAFE_CHARS, "_" * len(UNSAFE_CHARS))
    clean = F.regexp_replace(clean, r"^[. ]+|[. ]+$", "")
    ext = F.regexp_extract(clean, r"[^.](\.[^.]*)$", 1)
    stem = F.substring(clean, F.lit(1), F.lit(MAX_NAME) - F.length(ext))
    return F.when(F.length(clean) <= MAX_NAME, clean).otherwise(F.concat(stem, ext))


def file_extension(value: Col) -> Column:
    """Extension without its dot; empty for none and for dot files."""
    name = F.regexp_extract(_c(value), r"([^/]*)$", 1)
    return F.regexp_extract(name, r"[^.].*\.([^.]*)$|^\.*[^.]\.([^.]*)$", 1)


def human_bytes(value: Col) -> Column:
    """Size with a unit, in steps of 1024, two decimals."""
    v = _c(value).cast("double")
    out = F.format_string("%.2f PB", v / 1024.0**5)
    for power, unit in reversed(list(enumerate(("B", "KB", "MB", "GB", "TB")))):
        out = F.when(v < 1024.0 ** (power + 1), F.format_string(f"%.2f {unit}", v / 1024.0**power)).otherwise(out)
    return F.when(v.isNotNull(), out)


def connection_parts(value: Col) -> Column:
    """Struct of scheme, user, password, host, port, database and parameters."""
    v = _c(value)
    user_info = F.try_parse_url(v, F.lit("USERINFO"))
    port = F.regexp_extract(F.try_parse_url(v, F.lit("AUTHORITY")), r":(\d+)$", 1)
    query = F.try_parse_url(v, F.lit("QUERY"))
    return F.struct(
        F.try_parse_url(v, F.lit("PROTOCOL")).alias("scheme"),
        F.split_part(user_info, F.lit(":"), F.lit(1)).alias("user"),
        F.nullif(F.split_part(user_info, F.lit(":"), F.lit(2)), F.lit("")).alias("password"),
        F.try_parse_url(v, F.lit("HOST")).alias("host"),
        F.nullif(port, F.lit("")).try_cast("int").alias("port"),
        F.ltrim(F.try_parse_url(v, F.lit("PATH")), F.lit("/")).alias("database"),
        F.coalesce(
            F.str_to_map(query, F.lit("&"), F.lit("=")), F.create_map().cast("map<string,string>")
        ).alias("params"),
    )


def safe_json(value: Col, schema: str, default: Column | None = None) -> Column:
    """Parsed JSON, or ``default`` when the text is not valid JSON."""
    ok = F.try_parse_json(_c(value)).isNotNull()
    parsed = F.when(ok, F.from_json(_c(value), schema))
    return parsed if default is None else F.coalesce(parsed, default)


def ensure_list(value: Col, dtype: T.DataType | str) -> Column:
    """A list stays as it is, a scalar is wrapped, NULL gives an empty list.

    ``dtype`` is the type of the value, as a plan's columns must have a type of their own.
    """
    v = _c(value)
    kind = T._parse_datatype_string(dtype) if isinstance(dtype, str) else dtype
    if isinstance(kind, T.ArrayType):
        return F.coalesce(v, F.array().cast(kind))
    return F.when(v.isNotNull(), F.array(v)).otherwise(F.array().cast(T.ArrayType(kind)))


def content_hash(value: Col, algorithm: str = "md5") -> Column:
    """Hex digest of text or file content."""
    digests = {
        "md5": lambda v: F.md5(v),
        "sha1": lambda v: F.sha1(v),
        "sha256": lambda v: F.sha2(v, 256),
        "sha512": lambda v: F.sha2(v, 512),
    }
    if algorithm not in digests:
        raise ValueError(f"no digest named {algorithm}; known are {sorted(digests)}")
    return digests[algorithm](_c(value).cast("binary"))


def stable_bucket(key: Sequence[Col] | Col, buckets: int) -> Column:
    """Bucket 0..buckets-1 from the digest of a key; the same in any engine."""
    parts = [key] if isinstance(key, (str, Column)) else list(key)
    text = F.concat_ws("|", *[_c(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long") % buckets


# --- dates -----------------------------------------------------------------


def standard_date(value: Col, fmt: str = "yyyy-MM-dd", source: str | None = None) -> Column:
    """Date text in one format; NULL when it does not parse."""
    v = _c(value)
    ts = F.try_to_timestamp(v, F.lit(source)) if source else F.try_to_timestamp(v)
    return F.date_format(ts, fmt)


# --- weather ---------------------------------------------------------------


def heat_index(temp: Col, humidity: Col) -> Column:
    t, h = _c(temp), _c(humidity)
    return F.when(t < 27, t).otherwise(F.round(t + 0.5 * (h + t - 30), 1))


def wind_chill(temp: Col, wind_speed: Col) -> Column:
    # Wind-chill coefficients.
    base, by_temp, by_wind, by_both, exponent = 13.12, 0.6215, -11.37, 0.3965, 0.16
    t, v = _c(temp), F.pow(_c(wind_speed), F.lit(exponent))
    chill = F.round(base + by_temp * t + by_wind * v + by_both * t * v, 1)
    return F.when((t > 10) | (_c(wind_speed) < 4.8), t).otherwise(chill)


# --- money -----------------------------------------------------------------


def transaction_amounts(quantity: Col, unit_price: Col, discount: Col, tax_rate: float = 0.08) -> dict[str, Column]:
    """Total, tax and final amount of a purchase, each to the cent."""
    gross = _c(unit_price) * _c(quantity)
    total, tax = F.round(gross, 2), F.round(gross * tax_rate, 2)
    return {
        "total_amount": total,
        "tax": tax,
        "final_amount": F.round(total - _c(discount) + tax, 2),
    }
