"""Scalar functions as Column expressions; everything here stays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config

# strings


def fix_department(code: Column, changes: dict[str, str] = config.SUBJECT_CHANGES) -> Column:
    """The code with its subject renamed; a code without a blank stays as it is."""
    dep = department(code)
    new = F.coalesce(*[F.when(dep == old, F.lit(to)) for old, to in changes.items()], dep)
    return F.when(F.contains(code, F.lit(" ")), F.concat(new, F.substr(code, F.length(dep) + 1))).otherwise(code)


def department(code: Column) -> Column:
    return F.substring_index(code, " ", 1)


def subject(code: Column) -> Column:
    return F.get(F.split(code, " "), F.lit(0))


def number(code: Column) -> Column:
    return F.get(F.split(code, " "), F.lit(1))


def is_discussion(section: Column, code: Column) -> Column:
    return ~section.rlike("^[0-9]+$") | code.endswith("D")


def is_summer(season: Column) -> Column:
    return season.endswith("2")


def normalize_question(text: Column) -> Column:
    """Question text without notices, markup and known variants, so that one code has one text."""
    text = F.replace(text, F.lit(config.NOTICE), F.lit(""))
    for pattern, to in config.QUESTION_MARKUP:
        text = F.regexp_replace(text, pattern, to)
    for old, new in config.QUESTION_WORDINGS:
        text = F.replace(text, F.lit(old), F.lit(new))
    text = F.regexp_replace(text, config.QUESTION_NAMES, "")
    for old, new in config.QUESTION_ENDS:
        text = F.replace(text, F.lit(old), F.lit(new))
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def merge_question_texts(texts: Column) -> Column:
    """Of a code's distinct texts: none, the only one, or of two the longer if the other begins or ends it."""
    texts = F.array_sort(F.array_distinct(F.filter(texts, lambda t: t != "")))
    a, b = F.get(texts, F.lit(0)), F.get(texts, F.lit(1))
    short, long = F.when(F.length(a) > F.length(b), b).otherwise(a), F.when(F.length(a) > F.length(b), a).otherwise(b)
    return F.when(F.size(texts) == 0, F.array(F.lit(""))).when((F.size(texts) == 2) & (long.endswith(short) | long.startswith(short)), F.array(long)).otherwise(texts)


def question_tags(text: Column, code: Column, narrative: Column) -> Column:
    """All tags whose conditions a question meets; more than one is an error to report."""
    t = F.lower(text)
    has = lambda *words: [F.contains(t, F.lit(w)) for w in words]
    (instructor, recommend, skills) = has("instructor", "recommend", "skills")
    recommends = code.isin(config.RECOMMENDATIONS)
    rules = {
        "Available resources": has("resources")[0],
        "Engagement": has("engagement")[0],
        "Feedback": has("feedback")[0] & ~code.isin(config.NO_FEEDBACK),
        "Intellectual challenge": has("intellectual challenge")[0],
        "Major": has("major")[0],
        "Organization": has("organize")[0],
        "Professor": t.rlike("rating|assessment|evaluate") & instructor & ~recommends,
        "Overall": has("overall assessment")[0] & ~instructor & ~narrative,
        "Recommend": recommend & ~recommends,
        "Skills": skills & ~code.isin(config.NO_SKILLS),
        "Strengths/weaknesses": has("strengths and weaknesses")[0] & has("course")[0] & ~has("teaching assistant")[0] & ~instructor,
        "Summary": has("summarize")[0] & ~recommend,
        "Workload": has("workload")[0] & ~narrative,
    }
    return F.array_compact(F.array(*[F.when(rule, F.lit(tag)) for tag, rule in rules.items()]))


def parse_location(location: Column) -> Column:
    """Struct (code, room, building_name, error) of `CODE`, `CODE ROOM`, `CODE - NAME` and `CODE ROOM - NAME ROOM`."""
    head = F.substring_index(location, " - ", 1)
    rest = F.when(head != location, F.substr(location, F.length(head) + 4))
    code = F.substring_index(head, " ", 1)
    room = F.when(head != code, F.substr(head, F.length(code) + 2))
    tail = F.concat(F.lit(" "), room)
    long = F.when(rest.endswith(tail), F.substr(rest, F.lit(1), F.length(rest) - F.length(tail))).otherwise(rest)
    name = F.nullif(F.when(room.isNull(), rest).otherwise(long), code)
    blank = lambda c: F.when(~c.isin("", "TBA"), c)
    bad = (room.isNotNull() & rest.isNotNull() & ~rest.endswith(room)) | blank(code).isNull()
    return F.struct(blank(code).alias("code"), blank(room).alias("room"), blank(name).alias("building_name"), F.when(bad, F.concat(F.lit("Unexpected location format: "), location)).alias("error"))


def is_missing_location(location: Column) -> Column:
    return location.isNull() | location.isin("", "TBA", "TBA TBA")


def credits(credit_html: Column, hours: Column) -> Column:
    """Hours if given, else the number before the credit notice, else one."""
    ends = credit_html.endswith(config.CREDIT_SUFFIXES[0]) | credit_html.endswith(config.CREDIT_SUFFIXES[1])
    from_notice = F.when(ends, F.substr(credit_html, F.lit(1), F.length(credit_html) - config.CREDIT_SUFFIX_LENGTH).try_cast("double"))
    given = F.coalesce(hours, F.lit("")) != ""
    return F.coalesce(F.when(given, hours.try_cast("double")).otherwise(from_notice), F.lit(1.0))


def section(raw: Column) -> Column:
    stripped = F.regexp_replace(raw, "^0+", "")
    return F.when(F.coalesce(stripped, F.lit("")) == "", F.lit("0")).otherwise(stripped)


def status(code: Column) -> Column:
    return F.coalesce(*[F.when(code == k, F.lit(v)) for k, v in config.STATUSES.items()], F.lit("ACTIVE"))


def codes_found(html: Column, names: dict[str, str]) -> Column:
    """Sorted abbreviations of the names that occur in the text."""
    return F.array_sort(F.array_compact(F.array(*[F.when(F.contains(html, F.lit(k)), F.lit(v)) for k, v in names.items()])))


def any_phrase(phrases: list[str], *texts: Column) -> Column:
    found = [F.contains(F.coalesce(t, F.lit("")), F.lit(p)) for t in texts for p in dict.fromkeys(phrases)]
    out = found[0]
    for f in found[1:]:
        out = out | f
    return out


def is_first_year_seminar(code: Column, description: Column, requirements: Column) -> Column:
    return F.coalesce(code.startswith(config.FIRST_YEAR_CODE), F.lit(False)) | any_phrase(config.FIRST_YEAR_PHRASES, description, requirements)


def is_sophomore_seminar(title: Column, description: Column, requirements: Column) -> Column:
    return any_phrase(config.SOPHOMORE_PHRASES, title, description, requirements)


def is_college_seminar(subject_: Column, codes: list[str] = config.COLLEGE_SEMINARS) -> Column:
    return subject_.isin(codes)


def clean_note(text: Column) -> Column:
    return F.replace(text, F.lit("  "), F.lit(" "))


def without_returns(text: Column) -> Column:
    return F.replace(text, F.lit("\r"), F.lit(""))


def right_strip(text: Column) -> Column:
    return F.regexp_replace(text, r"\s+$", "")


def hide_course_codes(text: Column) -> Column:
    return F.regexp_replace(text, config.COURSE_CODES, "this course")


def cache_key(name: Column, email: Column) -> Column:
    """`name <email>`, or the name alone without an email."""
    return F.when(F.coalesce(email, F.lit("")) != "", F.concat(name, F.lit(" <"), email, F.lit(">"))).otherwise(name)


def resource_link(html: Column, title: str) -> Column:
    """Target of the first link with the given text, null if there is none."""
    found = F.regexp_extract(html, f'href="([^"]*)"[^>]*>{title}</a>', 0)
    return F.when(found != "", F.regexp_extract(html, f'href="([^"]*)"[^>]*>{title}</a>', 1))


def null_if_empty(text: Column) -> Column:
    return F.when(text != "", text)


# dates, times, bits


def season_of(date: Column) -> Column:
    """Season code of a date: year and 01 (January to May), 02 (June, July) or 03."""
    month = F.month(date)
    return F.concat(F.year(date).cast("string"), F.when(month <= 5, "01").when(month <= 7, "02").otherwise("03"))


def term(season: Column) -> Column:
    last = F.right(season, F.lit(1))
    return F.when(last == "1", "spring").when(last == "2", "summer").when(last == "3", "fall")


def year(season: Column) -> Column:
    return F.substring(season, 1, 4).cast("int")


def day_mask(letters: Column) -> Column:
    """Weekday letters as bits, Sunday 1 to Saturday 64."""
    patterns = {"Su": "Su", "M": "M", "T": "T(?!h)", "W": "W", "Th": "Th", "F": "F", "Sa": "Sa"}
    total = F.lit(0)
    for day, pattern in patterns.items():
        total = total + F.when(letters.rlike(pattern), config.DAYS[day]).otherwise(0)
    return F.when(letters == "M-F", config.WEEKDAYS_MASK).otherwise(total)


def day_letters(mask: Column) -> Column:
    """Bits as weekday letters; Monday to Friday is a range."""
    each = F.array_join(F.array_compact(F.array(*[F.when(mask.bitwiseAND(F.lit(bit)) != 0, F.lit(day)) for day, bit in config.DAYS.items()])), "")
    return F.when(mask.bitwiseAND(F.lit(127)) == config.WEEKDAYS_MASK, "M–F").otherwise(each)


def clock(time: Column) -> Column:
    """Twelve-hour text such as `1:30pm` as `13:30`, hours without a leading zero."""
    half = F.right(time, F.lit(2))
    body = F.replace(time, F.lit(";"), F.lit(""))
    body = F.substr(body, F.lit(1), F.length(body) - 2)
    hour = F.substring_index(body, ":", 1).cast("int")
    minute = F.when(F.contains(body, F.lit(":")), F.get(F.split(body, ":"), F.lit(1))).otherwise("00")
    hour = F.when((half == "am") & (hour == 12), 0).when((half == "pm") & hour.between(1, 11), hour + 12).otherwise(hour)
    return F.concat(hour.cast("string"), F.lit(":"), minute)


def undelimited_clock(time: Column) -> Column:
    return F.concat(F.substr(time, F.lit(1), F.length(time) - 2), F.lit(":"), F.right(time, F.lit(2)))


def weekday_bit(day: Column) -> Column:
    """Bit of a weekday counted from Monday as 0."""
    return F.call_function("shiftleft", F.lit(1), F.pmod(day.cast("int") + 1, F.lit(7)))


def split_meeting(text: Column) -> Column:
    """Struct (days, time, location) of a meeting's text."""
    parts = F.split(text, " in ")
    sessions, location = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    words, own = F.split(sessions, " "), F.split(text, " ")
    placed, spaced = F.contains(text, F.lit(" in ")), F.contains(sessions, F.lit(" "))
    days = F.when(placed & spaced, F.get(words, F.lit(0))).when(placed, "HTBA").when(F.contains(text, F.lit(" ")), F.get(own, F.lit(0))).otherwise(text)
    time = F.when(placed & spaced, F.get(words, F.lit(1))).when(placed, "").when(F.contains(text, F.lit(" ")), F.get(own, F.lit(1))).otherwise("")
    return F.struct(days.alias("days"), time.alias("time"), F.when(placed, location).otherwise("").alias("location"))


# ids and arrays


def course_id(season: Column, crns: Column) -> Column:
    return (season.cast("bigint") - 200000) * 100000 + F.array_min(crns)


def listing_id(season: Column, crn: Column) -> Column:
    return (season.cast("bigint") - 200000) * 100000 + crn


def int_set(texts: Column) -> Column:
    return F.array_distinct(F.transform(texts, lambda x: x.cast("int")))


def crn_bundle(crn: Column, others: Column, primary: Column) -> Column:
    """Struct (crns, primary): the own number before the others; a primary outside of them is dropped."""
    every = F.concat(F.array(crn), others)
    return F.struct(every.alias("crns"), F.when(F.array_contains(every, primary), primary).alias("primary_crn"))
