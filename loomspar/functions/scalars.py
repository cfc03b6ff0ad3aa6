"""Names, predicates and typed casts as column expressions, so that Catalyst sees them.

Casts give a value, and null where the input isn't valid for the type; callers keep both sides to tell the cases apart.
The session's time zone is taken to be UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

C = Column | str


def col(c: C) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Text and names.


def strip(c: C) -> Column:
    """Without white space at both ends, by Unicode's notion of it."""
    return F.regexp_replace(col(c), r"(?U)^[\s\uFEFF]+|[\s\uFEFF]+$", "")


def strip_invisible(c: C) -> Column:
    """Without zero-width marks; no-break spaces become spaces (as under NFKC)."""
    return F.regexp_replace(F.translate(col(c), "\u00a0", " "), r"[\u200B-\u200D\uFEFF]", "")


def normal_name(c: C) -> Column:
    """A field name as it is compared: lower case, without white space, underscores, hyphens and slashes."""
    return F.regexp_replace(F.lower(col(c)), r"[\s_\-/]", "")


def preview_name(c: C) -> Column:
    """As previews compare names: slashes stay."""
    return F.regexp_replace(F.lower(col(c)), r"[\s_\-]", "")


def line_ending(c: C) -> Column:
    c = col(c)
    return F.when(c.contains("\r\n"), "CRLF").when(c.contains("\r"), "CR").otherwise("LF")


def double_backslashes(c: C, fmt: str) -> Column:
    return col(c) if fmt == "csv" else F.replace(col(c), F.lit("\\"), F.lit("\\\\"))


def escape_search(c: C) -> Column:
    return F.replace(F.replace(col(c), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))


# Predicates.


def is_blank(c: C) -> Column:
    return col(c).isNull() | (col(c) == "")


def is_meta_field(c: C) -> Column:
    return normal_name(c).isin("project", "issuetype", "type")


def is_record_key(c: C) -> Column:
    return F.coalesce(col(c).rlike(r"(?i)^[A-Z]+-[0-9]+$"), F.lit(False))


def looks_like_project_key(c: C) -> Column:
    return F.coalesce(strip(c).rlike(r"^[A-Z][A-Z0-9]{0,10}$"), F.lit(False))


def is_subtask_type(c: C) -> Column:
    low = F.lower(col(c))
    return F.coalesce((low == "sub task") | low.contains("sub-task") | low.contains("subtask"), F.lit(False))


def is_email(c: C) -> Column:
    return F.coalesce(col(c).rlike(r"^[^\s@]+@[^\s@]+\.[^\s@]+$"), F.lit(False))


# Casts.


def to_number(c: C) -> Column:
    """A double from text: decimal with exponent, or 0x, 0b, 0o integers; blank and Infinity are not numbers; -0 is 0."""
    t = strip(c)
    decimal = F.when(t.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), F.try_cast(t, "double")) if hasattr(F, "try_cast") else F.when(t.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), t.try_cast("double"))
    based = F.lit(None).cast("double")
    for mark, digits, base in (("x", "0-9a-fA-F", 16), ("b", "01", 2), ("o", "0-7", 8)):
        based = F.when(t.rlike(f"^0[{mark}{mark.upper()}][{digits}]+$"), F.conv(F.substring(t, 3, 64), base, 10).try_cast("double")).otherwise(based)
    n = F.coalesce(decimal, based)
    return F.when(n.isin(float("inf"), float("-inf")), None).when(n == 0, F.lit(0.0)).otherwise(n)


def serial_date(c: C) -> Column:
    """A spreadsheet's day number as a date: day 1 is 1900-01-01, and the day 60 that never was counts as 1900-03-01."""
    n = col(c)
    days = F.floor(n) - F.when(n <= 60, 1).otherwise(2)
    return F.when(n > 0, F.date_add(F.lit("1900-01-01").cast("date"), days.cast("int")))


def day_text(c: C) -> Column:
    """yyyy-MM-dd of a date; years of five digits and more bear no sign."""
    return F.ltrim(F.date_format(col(c), "yyyy-MM-dd"), F.lit("+"))


def iso_date(c: C) -> Column:
    """yyyy-MM-dd of a date or date-time text; null if its UTC date isn't the written one."""
    t = strip(c)
    written = F.substring(t, 1, 10)
    plain = F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(t, "yyyy-MM-dd"))
    moment = F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}T"), t.try_cast("timestamp").cast("date"))
    date = F.date_format(F.coalesce(plain, moment), "yyyy-MM-dd")
    return F.when(date == written, date)


def _stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'+0000'")


def epoch_datetime(c: C) -> Column:
    """A number below 1e10 counts seconds, else milliseconds."""
    n = col(c).cast("double")
    return _stamp(F.timestamp_millis(F.floor(F.when(F.abs(n) < 1e10, n * 1000).otherwise(n)).cast("long")))


def iso_datetime(c: C) -> Column:
    """Date, minute, second or fraction of a second, with Z or an offset, else UTC. Days that don't exist are null."""
    t = strip(c)
    shape = t.rlike(r"^\d{4}-\d{2}-\d{2}(T\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?$")
    seconds = F.regexp_replace(t, r"^(.{10}T\d{2}:\d{2})(?=$|[Z+-])", "$1:00")
    zoned = F.regexp_replace(F.regexp_replace(seconds, r"([+-]\d{2})(\d{2})$", "$1:$2"), r"(T[0-9:.]+)$", "$1Z")
    full = F.when(F.length(t) == 10, t).otherwise(zoned)
    return F.when(shape, _stamp(full.try_cast("timestamp")))


def duration_text(c: C) -> Column:
    """Seconds as weeks of five days of eight hours, days, hours and minutes; a rest below a minute is dropped."""
    n = F.floor(col(c)).cast("long")
    minute, hour, day, week = 60, 3600, 8 * 3600, 5 * 8 * 3600
    part = lambda value, unit: F.when(value > 0, F.concat(value.cast("string"), F.lit(unit)))
    whole = lambda x, y: F.floor(x / y).cast("long")
    parts = [part(whole(n, week), "w"), part(whole(n % week, day), "d"), part(whole(n % day, hour), "h"), part(whole(n % hour, minute), "m")]
    text = F.concat_ws(" ", *parts)
    return F.when(n >= 0, F.when(text == "", "0m").otherwise(text))


def duration_value(c: C) -> Column:
    """A duration's text: units as they are ("1w 2d"), or one number with a unit's name ("2 hours")."""
    t = strip(c)
    number, unit = F.regexp_extract(t, r"^(\d+)\s*([A-Za-z]+)$", 1), F.lower(F.regexp_extract(t, r"^(\d+)\s*([A-Za-z]+)$", 2))
    short = F.when(unit.isin("w", "week", "weeks"), "w").when(unit.isin("d", "day", "days"), "d").when(unit.isin("h", "hr", "hrs", "hour", "hours"), "h").when(unit.isin("m", "min", "mins", "minute", "minutes"), "m")
    return F.when(t.rlike(r"^\d+[wdhm](\s+\d+[wdhm])*$"), t).when(short.isNotNull(), F.concat(number, short))


def split_list(c: C) -> Column:
    """Trimmed, non-blank items of a comma list; '' is an empty list."""
    return F.filter(F.transform(F.split(col(c), ","), strip), lambda x: x != "")


#: Delimiters between a parent and a child, in the order in which they are tried.
CASCADE_DELIMITERS = ("->", ",", "/", ">", "|")


def split_cascade(c: C) -> Column:
    """struct(parent, child): by the first delimiter with text on both sides; without one, child only."""
    t = strip(c)
    single = lambda x: F.regexp_replace(x, r"\s+", " ")
    out = F.struct(F.lit(None).cast("string").alias("parent"), single(t).alias("child"))
    for d in reversed(CASCADE_DELIMITERS):
        pattern = rf"(?s)^(.+?)\s*{''.join(chr(92) + x for x in d)}\s*(.+)$"
        out = F.when(t.rlike(pattern), F.struct(single(strip(F.regexp_extract(t, pattern, 1))).alias("parent"), single(strip(F.regexp_extract(t, pattern, 2))).alias("child"))).otherwise(out)
    return out


def marker(job: C, millis: C) -> Column:
    """A label that names a job: safe characters only, 255 at most, shortened in the job's id."""
    head, tail = F.lit("bulk-job-"), F.concat(F.lit("-"), col(millis).cast("string"))
    safe = F.regexp_replace(col(job), r"[^A-Za-z0-9\-_]", "-")
    return F.concat(head, F.left(safe, F.lit(255) - F.length(head) - F.length(tail)), tail)


def with_marker(labels: C, mark: C) -> Column:
    own = F.coalesce(col(labels), F.array().cast("array<string>"))
    return F.when(F.array_contains(own, col(mark)), own).otherwise(F.array_append(own, col(mark)))


def has_marker(labels: C, mark: C) -> Column:
    return F.coalesce(F.array_contains(col(labels), col(mark)), F.lit(False))


# Shapes of JSON texts.


def _member(c: C, name: str) -> Column:
    return F.get_json_object(col(c), f"$.{name}")


def is_id_only(c: C) -> Column:
    """An object with an id in text, and neither a key nor a name."""
    has_text_id = F.coalesce(F.schema_of_variant(F.try_variant_get(F.try_parse_json(col(c)), "$.id", "variant")) == "STRING", F.lit(False))
    return has_text_id & _member(c, "key").isNull() & _member(c, "name").isNull()


def is_error_response(c: C) -> Column:
    """An object that lists messages, or errors by field."""
    keys = F.coalesce(F.json_object_keys(col(c)), F.array().cast("array<string>"))
    return F.arrays_overlap(keys, F.array(F.lit("errorMessages"), F.lit("errors")))


def search_date(c: C) -> Column:
    """A time as searches spell it; texts pass."""
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyy-MM-dd HH:mm")


# Messages of failed writes.


def field_error_code(c: C) -> Column:
    low = F.lower(col(c))
    any_of = lambda *words: F.lit(False) if not words else low.rlike("|".join(words))
    return F.when(any_of("required"), "REQUIRED_FIELD").when(any_of("not valid", "invalid", "does not exist", "not allowed"), "INVALID_VALUE").when(any_of("permission", "not authorized"), "PERMISSION_DENIED").when(any_of("not found"), "NOT_FOUND").otherwise("INVALID_VALUE")


def global_error_code(c: C) -> Column:
    low = F.lower(col(c))
    return F.when(low.contains("required"), "REQUIRED_FIELD").when(low.rlike("permission|forbidden"), "PERMISSION_DENIED").when(low.contains("not found"), "NOT_FOUND").when(low.contains("ambiguous"), "AMBIGUOUS").when(low.rlike("server error|internal"), "SERVER_ERROR").otherwise("INVALID_VALUE")


def status_error_code(status: C) -> Column:
    s = col(status)
    return F.when(s == 401, "AUTHENTICATION_ERROR").when(s == 403, "PERMISSION_DENIED").when(s == 404, "NOT_FOUND").when(s >= 500, "SERVER_ERROR").when(s == 400, "VALIDATION_ERROR")
