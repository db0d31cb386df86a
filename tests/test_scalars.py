import pytest
from pyspark.sql import functions as F

from corvine import config
from corvine.functions import html as H
from corvine.functions import scalars as S
from corvine.functions import text as X


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize("letters,mask", [("M-F", 62), ("MWF", 42), ("TTh", 20), ("Th", 16), ("Su", 1), ("Sa", 64), ("T", 4)])
def test_day_mask(spark, letters, mask):
    assert one(spark, S.day_mask(F.lit(letters))) == mask == H._mask(letters)


@pytest.mark.parametrize("mask,letters", [(62, "M–F"), (42, "MWF"), (20, "TTh"), (126, "MTWThFSa"), (0, "")])
def test_day_letters(spark, mask, letters):
    assert one(spark, S.day_letters(F.lit(mask))) == letters


@pytest.mark.parametrize("text,clock", [("9am", "9:00"), ("1:30pm", "13:30"), ("12pm", "12:00"), ("12:15am", "0:15"), ("11:05;am", "11:05")])
def test_clock(spark, text, clock):
    assert one(spark, S.clock(F.lit(text))) == clock == H._clock(text)


def test_undelimited_clock_and_weekday(spark):
    assert [one(spark, S.undelimited_clock(F.lit(t))) for t in ("1430", "900")] == ["14:30", "9:00"]
    assert [one(spark, S.weekday_bit(F.lit(d))) for d in (0, 6)] == [2, 1]


@pytest.mark.parametrize("text,parts", [("MW 1pm-2:15pm in WLH 201", ("MW", "1pm-2:15pm", "WLH 201")), ("HTBA in WLH 201", ("HTBA", "", "WLH 201")), ("MW 1pm-2pm", ("MW", "1pm-2pm", "")), ("HTBA", ("HTBA", "", ""))])
def test_split_meeting(spark, text, parts):
    assert tuple(one(spark, S.split_meeting(F.lit(text)))) == parts == H._split(text)


@pytest.mark.parametrize("html,hours,credits", [("any", "1.5", 1.5), ("1.5" + config.CREDIT_SUFFIXES[1], "", 1.5), ("x", "", 1.0), ("x", "many", 1.0)])
def test_credits(spark, html, hours, credits):
    assert one(spark, S.credits(F.lit(html), F.lit(hours))) == credits


@pytest.mark.parametrize("raw,section", [("01", "1"), ("", "0"), (None, "0"), ("000", "0"), ("10A", "10A")])
def test_section(spark, raw, section):
    assert one(spark, S.section(F.lit(raw).cast("string"))) == section


@pytest.mark.parametrize(
    "text,code,room,name",
    [
        ("WLH", "WLH", None, None),
        ("WLH 201", "WLH", "201", None),
        ("WLH - Harkness Hall", "WLH", None, "Harkness Hall"),
        ("WLH 201 - Harkness Hall 201", "WLH", "201", "Harkness Hall"),
        ("WLH TBA", "WLH", None, None),
        ("WLH - WLH", "WLH", None, None),
        ("WLH 201 - WLH 201", "WLH", "201", None),
    ],
)
def test_location(spark, text, code, room, name):
    got = one(spark, S.parse_location(F.lit(text)))
    assert (got.code, got.room, got.building_name, got.error) == (code, room, name, None)


@pytest.mark.parametrize("text", ["WLH 201 - Harkness Hall 5", "TBA 12", " - x"])
def test_bad_location(spark, text):
    assert one(spark, S.parse_location(F.lit(text))).error is not None


def test_ids_and_seasons(spark):
    assert one(spark, S.course_id(F.lit("202403"), F.array(F.lit(10005), F.lit(10001)))) == 240310001
    assert one(spark, S.listing_id(F.lit("202403"), F.lit(10005))) == 240310005
    assert [(one(spark, S.term(F.lit(s))), one(spark, S.year(F.lit(s)))) for s in ("202401", "202402", "202403")] == [("spring", 2024), ("summer", 2024), ("fall", 2024)]


def test_departments(spark):
    assert [one(spark, S.fix_department(F.lit(c))) for c in ("STAT 238", "CPSC 201", "STAT")] == ["S&DS 238", "CPSC 201", "STAT"]


@pytest.mark.parametrize(
    "text,code,narrative,tags",
    [
        ("What is your overall assessment of this course?", "YC401", False, ["Overall"]),
        ("What is your overall assessment of this course?", "YC401", True, []),
        ("I would recommend this instructor; rating", "DR113", True, []),
        ("feedback on speaking skills", "DR464", True, []),
        ("workload and skills", "X1", False, ["Skills", "Workload"]),
    ],
)
def test_tags(spark, text, code, narrative, tags):
    assert one(spark, S.question_tags(F.lit(text), F.lit(code), F.lit(narrative))) == tags


@pytest.mark.parametrize("texts,merged", [([], [""]), (["", "a"], ["a"]), (["Ratings", "Why? Ratings"], ["Why? Ratings"]), (["ab", "abc"], ["abc"]), (["ab", "cd"], ["ab", "cd"]), (["a", "b", "ab"], ["a", "ab", "b"])])
def test_question_texts(spark, texts, merged):
    assert one(spark, S.merge_question_texts(F.array(*map(F.lit, texts)).cast("array<string>"))) == merged


def test_question_normalise(spark):
    assert one(spark, S.normalize_question(F.lit(f" <p>Rate\n the professor's  course or module for ?</p> {config.NOTICE}Comments:"))) == "Rate the professor(s)'s course or workshop?"


@pytest.mark.parametrize("a,b,want", [("abc", "xxabcxx", 0.0), ("", "abc", -1), ("abcd", "wxyz", -1), ("abcd", "zzabxdzz", 0.25), (None, "a", -1), ("  ", "a", -1)])
def test_text_distance(a, b, want):
    assert X.text_distance(a, b) == want == X.text_distance(b, a)


def test_infix_distance_equals_dynamic_programming():
    import random

    r = random.Random(4)
    for _ in range(1500):
        p, t = ("".join(r.choice("abc") for _ in range(r.randint(1, n))) for n in (14, 25))
        row = [0] * (len(t) + 1)
        for i, ch in enumerate(p, 1):
            new = [i]
            for j, c in enumerate(t, 1):
                new.append(min(row[j - 1] + (ch != c), row[j] + 1, new[-1] + 1))
            row = new
        assert X.infix_distance(p, t, 99) == min(row)


def test_accents_and_mojibake():
    assert X.fold_accents("Zoë Núñez Ångström") == "Zoe Nunez Angstrom"
    assert X.repair("cafÃ© “x” â€“") == 'café "x" –'


def test_flags(spark):
    code, text, none = F.lit("DRST 001"), F.lit("Priority to freshmen"), F.lit(None).cast("string")
    assert one(spark, S.is_first_year_seminar(code, none, none)) is True
    assert one(spark, S.is_first_year_seminar(F.lit("A 1"), text, none)) is True
    assert one(spark, S.is_first_year_seminar(F.lit("A 1"), none, none)) is False
    assert one(spark, S.is_sophomore_seminar(F.lit("Sophomore Seminar"), none, none)) is True
    assert one(spark, S.codes_found(F.lit("a>Sciences</a> Writing"), config.AREAS)) == ["Sc"]
