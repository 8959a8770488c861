"""Column functions over log text. All of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logtide.functions import patterns as P


def clean_utf8(value: Column) -> Column:
    """Drop undecodable bytes; valid text passes untouched."""
    repaired = F.replace(F.make_valid_utf8(value), F.lit("�"), F.lit(""))
    return F.when(F.is_valid_utf8(value), value).otherwise(repaired)


def strip(value: Column) -> Column:
    """Remove every kind of whitespace at both ends (`trim` knows spaces only)."""
    return F.btrim(value, F.lit(P.SPACE_CHARACTERS))


def line_format(line: Column) -> Column:
    """access, syslog, windows, generic or fallback; the first match wins."""
    return (
        F.when(line.rlike(P.ACCESS_LINE), "access")
        .when(line.rlike(P.SYSLOG_HEAD), "syslog")
        .when(line.rlike(P.WINDOWS_LINE), "windows")
        .when(line.rlike(P.GENERIC_LINE), "generic")
        .otherwise("fallback")
    )


# The captures below are '' where a format has no such part. They stay apart from
# the expressions using them: `nullif` and `coalesce` would run a pattern twice.


def time_text(line: Column, fmt: Column) -> Column:
    return (
        F.when(fmt == "access", F.regexp_extract(line, P.ACCESS_LINE, 2))
        .when(fmt == "syslog", F.regexp_extract(line, P.SYSLOG_HEAD, 1))
        .when(fmt == "windows", F.regexp_extract(line, P.WINDOWS_LINE, 1))
        .when(fmt == "generic", F.regexp_extract(line, P.GENERIC_LINE, 1))
        .otherwise(F.regexp_extract(line, P.ANY_ISO_TIME, 1))
    )


def message_text(line: Column, fmt: Column) -> Column:
    return (
        F.when(fmt == "syslog", F.regexp_extract(line, P.SYSLOG_LINE, 4))
        .when(fmt == "windows", F.regexp_extract(line, P.WINDOWS_LINE, 4))
        .when(fmt == "generic", F.regexp_extract(line, P.GENERIC_LINE, 3))
        .otherwise("")
    )


def level_text(line: Column, fmt: Column) -> Column:
    return (
        F.when(fmt == "windows", F.regexp_extract(line, P.WINDOWS_LINE, 2))
        .when(fmt == "generic", F.regexp_extract(line, P.GENERIC_LINE, 2))
        .when(fmt == "fallback", F.regexp_extract(line, P.ANY_LEVEL, 1))
        .otherwise("")
    )


def service_name(line: Column, fmt: Column) -> Column:
    return (
        F.when(fmt == "syslog", F.regexp_extract(line, P.SYSLOG_HEAD, 3))
        .when(fmt == "windows", F.regexp_extract(line, P.WINDOWS_LINE, 3))
        .otherwise("")
    )


def syslog_host(line: Column, fmt: Column) -> Column:
    return F.when(fmt == "syslog", F.regexp_extract(line, P.SYSLOG_HEAD, 2))


def normal_level(text: Column) -> Column:
    """Map a level word to its common name; INFO where there is none."""
    pairs = [F.lit(part) for pair in P.LEVELS.items() for part in pair]
    known = F.try_element_at(F.create_map(*pairs), F.lower(text))
    return F.when(text == "", "INFO").otherwise(F.coalesce(known, F.upper(text)))


def _month_number(name: Column) -> Column:
    numbers = dict(P.EXTRA_MONTH_NAMES)
    for number, month in enumerate(P.MONTHS, start=1):
        numbers[month] = number
        numbers[month[:3]] = number
    pairs = [F.lit(str(part)) for pair in numbers.items() for part in pair]
    known = F.try_element_at(F.create_map(*pairs), F.lower(name))
    return F.coalesce(known, F.when(name.rlike(r"^\d{1,2}$"), name))


def time_shape(text: Column) -> Column:
    """access, iso or syslog; NULL for text of no known shape."""
    slashed = text.contains("/") & text.contains(":")
    return (
        F.when(slashed, F.when(text.rlike(P.ACCESS_CLOCK), "access"))
        .when(text.rlike(P.ISO_CLOCK), F.when(~text.startswith("0000"), "iso"))
        .when(text.rlike(P.SYSLOG_CLOCK), "syslog")
    )


def time_parts(text: Column, shape: Column) -> Column:
    """Access and syslog times cut at their separators, ISO times as date and clock."""
    iso = F.array(F.substring(text, 1, 10), F.regexp_extract(text, P.ISO_SECONDS, 1))
    return F.when(shape == "iso", iso).when(
        shape.isNotNull(), F.split(text, P.CLOCK_SEPARATORS)
    )


def wall_clock(parts: Column, shape: Column, default_year: int | None = None) -> Column:
    """The time as written, read as UTC; NULL where it is no real time.

    Syslog carries no year, so `default_year` supplies it (the current year when
    not given). Written zone offsets are left to `offset_minutes`.
    """
    year = F.lit(str(default_year)) if default_year else F.year(F.current_date()).cast("string")

    def part(index: int) -> Column:
        return F.get(parts, F.lit(index))

    def date_and_time(y: Column, m: Column, d: Column, clock: int) -> Column:
        date = F.concat(y, F.lit("-"), _month_number(m), F.lit("-"), d, F.lit(" "))
        time = F.concat(part(clock), F.lit(":"), part(clock + 1), F.lit(":"), part(clock + 2))
        return F.concat(date, time)

    text = (
        F.when(shape == "iso", F.concat(part(0), F.lit(" "), part(1)))
        .when(shape == "syslog", date_and_time(year, part(0), part(1), 2))
        .when(shape == "access", date_and_time(part(2), part(1), part(0), 3))
    )
    return F.concat(text, F.lit("Z")).try_cast("timestamp")


def offset_text(text: Column, shape: Column) -> Column:
    """Written zone offset of an ISO time, '' where there is none."""
    return F.when(shape == "iso", F.regexp_extract(text, P.ISO_OFFSET, 1)).otherwise("")


def offset_minutes(offset: Column) -> Column:
    """Minutes east of UTC; NULL for a day and more, which is no valid zone."""
    sign = F.when(offset.startswith("-"), -1).otherwise(1)
    minutes = F.substring(offset, 2, 2).try_cast("int") * 60 + F.right(
        offset, F.lit(2)
    ).try_cast("int")
    return F.when(offset == "", 0).when(minutes < 24 * 60, sign * minutes)


def ipv4_hits(text: Column) -> Column:
    """Every IPv4-shaped word, valid or not, in order."""
    return F.regexp_extract_all(text, F.lit(P.IPV4), F.lit(0))


def is_valid_ipv4(text: Column) -> Column:
    return F.coalesce(text.rlike(P.VALID_IPV4), F.lit(False))


def port_number(message: Column) -> Column:
    """The first port; of the two ways to write one, the other capture is ''."""
    found = F.concat(F.regexp_extract(message, P.PORT, 1), F.regexp_extract(message, P.PORT, 2))
    return found.try_cast("bigint")


def spaced_words(message: Column) -> Column:
    """Lower-cased words, each between single spaces."""
    words = F.regexp_replace(F.lower(message), P.NON_WORDS, " ")
    return F.concat(F.lit(" "), words, F.lit(" "))


def tag_names(words: Column) -> Column:
    """Comma-joined names of the tags that have a word in `spaced_words`."""
    hits = []
    for tag, tag_words in P.TAG_WORDS.items():
        present = F.lit(False)
        for word in tag_words:
            present = present | words.contains(f" {word} ")
        hits.append(F.when(present, tag))
    return F.concat_ws(",", *hits)


def as_tag_list(names: Column) -> Column:
    return F.when(names == "", F.array().cast("array<string>")).otherwise(F.split(names, ","))


def has_phrase(message: Column, phrase: str) -> Column:
    """Case-insensitive containment; NULL counts as absent."""
    return F.coalesce(F.lower(message).contains(phrase), F.lit(False))


def tokens(message: Column) -> Column:
    """Lower-cased words; the basis of token entropy."""
    return F.regexp_extract_all(F.lower(message), F.lit(P.TOKEN), F.lit(0))


def time_of_day(ts: Column) -> Column:
    """Time as text, with a fraction only where there is one."""
    whole = F.date_format(ts, "HH:mm:ss")
    exact = F.date_format(ts, "HH:mm:ss.SSSSSS")
    return F.when(F.unix_micros(ts) % 1_000_000 == 0, whole).otherwise(exact)
