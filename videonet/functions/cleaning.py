"""Column expressions that clean one raw crawl record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the record format.
FIELD_COUNT = 9
MAX_RELATED = 50
MAX_AGE_DAYS = 10000
FIRST_UPLOAD_DAY = "2005-02-15"
UNKNOWN = "unknown"

# Unicode white space plus the four ASCII separators, which count as blank too.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
_INTEGER = r"^[+-]?\d+(_\d+)*$"
_FLOAT = (
    r"(?i)^[+-]?((\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)(e[+-]?\d+(_\d+)*)?"
    r"|nan|inf|infinity)$"
)
_LONG_MAX = 9223372036854775807


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def split_line(line: Column) -> Column:
    """Fields of a line. The whole line is stripped first, so outer tabs vanish."""
    return F.split(strip(line), "\t", -1)


def is_video_id(text: Column) -> Column:
    return F.coalesce(text.rlike(r"^[\p{L}\p{N}_-]{11}$"), F.lit(False))


def to_long(text: Column) -> Column:
    """Integer value or 0. Values beyond 64 bits become the nearest 64-bit value.

    The plain cast, which ignores blanks itself, settles nearly all values; only where
    it fails the text is stripped and the pattern tried.
    """
    bare = strip(text)
    grouped = F.replace(bare, F.lit("_"), F.lit("")).try_cast("bigint")
    too_big = F.when(bare.startswith("-"), F.lit(-_LONG_MAX)).otherwise(F.lit(_LONG_MAX))
    rare = F.when(bare.rlike(_INTEGER), F.coalesce(grouped, too_big))
    stripped = F.when(bare != text, bare.try_cast("bigint"))
    return F.coalesce(text.try_cast("bigint"), stripped, rare, F.lit(0).cast("bigint"))


def to_double(text: Column) -> Column:
    """Floating value or 0; letters need the full pattern, as casts take more than it does."""
    bare = strip(text)
    grouped = F.replace(bare, F.lit("_"), F.lit("")).try_cast("double")
    rare = F.when(bare.rlike(_FLOAT), grouped)
    plain = F.coalesce(text.try_cast("double"), F.when(bare != text, bare.try_cast("double")))
    return F.coalesce(F.when(text.rlike("[A-Za-z_]"), rare).otherwise(plain), F.lit(0.0))


def at_least_zero(number: Column) -> Column:
    return F.greatest(F.lit(0), number)


def clamp_rate(rate: Column) -> Column:
    """Into [0, 5]; NaN counts as 5."""
    return F.greatest(F.lit(0.0), F.least(F.lit(5.0), rate))


def normalize_category(category: Column) -> Column:
    name = F.replace(F.lower(strip(category)), F.lit("&"), F.lit("and"))
    name = F.replace(name, F.lit(" "), F.lit("_"))
    return F.when(category.isNull() | (category == ""), F.lit(UNKNOWN)).otherwise(name)


def default_uploader(uploader: Column) -> Column:
    return F.when(uploader.isNull() | (uploader == ""), F.lit(UNKNOWN)).otherwise(strip(uploader))


def age_to_date(age_days: Column) -> Column:
    """Upload day of a video whose age counts days since the first upload day."""
    return F.date_add(F.lit(FIRST_UPLOAD_DAY).cast("date"), age_days.cast("int"))


def clean_related(fields: Column) -> Column:
    """Valid ids after the fixed fields, in order, at most MAX_RELATED."""
    tail = F.slice(fields, F.lit(FIELD_COUNT + 1), F.greatest(F.size(fields), F.lit(1)))
    return F.slice(F.filter(F.transform(tail, strip), is_video_id), 1, MAX_RELATED)


def malformed_reason(fields: Column) -> Column:
    """Name of the first broken rule, or null for a good record."""
    # `get` instead of an index: short records have no such field.
    age = to_long(F.get(fields, F.lit(2)))
    length = to_long(F.get(fields, F.lit(4)))
    return (
        F.when(F.size(fields) < FIELD_COUNT, F.lit("insufficient_fields"))
        .when(~is_video_id(strip(F.get(fields, F.lit(0)))), F.lit("invalid_video_id"))
        .when((age < 0) | (age > MAX_AGE_DAYS), F.lit("invalid_age"))
        .when(length <= 0, F.lit("invalid_length"))
    )


def is_integer(text: Column) -> Column:
    return F.coalesce(strip(text).rlike(_INTEGER), F.lit(False))
