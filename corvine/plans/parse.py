"""Raw course details to parsed course records; rows that cannot be parsed go to a rejects table.

A course without number, title or code is rejected, and one whose meetings or clocks are malformed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import html as H
from ..functions import scalars as S
from ..operators.linkage import primary_crn
from ..sources.spool import Spool


def parse_courses(raw: DataFrame, season: str, second: DataFrame | None = None, first_year: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Parsed courses and rejects (crn, code, error). `second` (crn, subjectNumber, sectionNumber, primXLst) gives
    primary listings, `first_year` (crn) the seminars that the search service names."""
    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    whole = F.col("code").isNotNull() & F.contains("code", F.lit(" ")) & F.col("crn").isNotNull() & F.col("title").isNotNull()
    missing = F.when(~F.coalesce(whole, F.lit(False)), F.lit("course without number, title or code"))
    spool = Spool(raw.sparkSession, "parse")
    read = raw.withColumn("_m", H.meetings_of(empty("meeting_html"), F.col("allInGroup"))).withColumn("_error", F.coalesce(missing, "_m.error"))
    read = spool.keep(read.withColumn("_m", F.col("_m.meetings")), "read")
    rejects = read.where("_error is not null").select("crn", "code", F.col("_error").alias("error"))
    df = read.where("_error is null").drop("_error")
    df = df.withColumn("_d", H.description_of(empty("description"))).withColumn("_p", H.instructors_of(empty("instructordetail_html")))
    df = df.withColumn("_x", H.cross_listings_of(empty("xlist")))
    if second is not None:
        rows = second.select("crn", F.col("subjectNumber").alias("code"), F.col("sectionNumber").alias("section"), F.col("primXLst").alias("primary_code"))
        df = df.join(primary_crn(rows).withColumnRenamed("primary", "_primary"), "crn", "left")
    else:
        df = df.withColumn("_primary", F.lit(None).cast("string"))
    if first_year is not None:
        df = df.join(first_year.select("crn").distinct().withColumn("_fy", F.lit(True)), "crn", "left")
    else:
        df = df.withColumn("_fy", F.lit(False))
    df = df.withColumn("_crns", S.crn_bundle(F.col("crn"), F.col("_x"), F.col("_primary")))
    needs, text = F.col("_d.requirements"), F.col("_d.description")
    out = df.select(
        F.lit(season).alias("season_code"), needs.alias("requirements"), text.alias("description"), S.without_returns(F.col("title")).alias("title"), F.col("col").alias("school"),
        S.credits(empty("credit_html"), empty("hours")).alias("credits"), S.status(F.col("stat")).alias("extra_info"), F.col("_p.name").alias("professors"), F.col("_p.email").alias("professor_emails"),
        "crn", F.col("_crns.crns").alias("crns"), F.col("_crns.primary_crn").alias("primary_crn"), F.col("code").alias("course_code"), S.subject(F.col("code")).alias("subject"),
        S.number(F.col("code")).alias("number"), F.regexp_replace("section", "^0+", "").alias("section"), F.col("_m").alias("meetings"), S.codes_found(empty("yc_attrs"), config.SKILLS).alias("skills"),
        S.codes_found(empty("yc_attrs"), config.AREAS).alias("areas"), H.link_texts_of(empty("ci_attrs")).alias("flags"), S.null_if_empty(H.note_of(empty("regnotes"))).alias("regnotes"),
        S.null_if_empty(H.note_of(empty("rp_attr"))).alias("rp_attr"), S.null_if_empty(H.note_of(empty("clssnotes"))).alias("classnotes"), S.null_if_empty(F.col("final_exam")).alias("final_exam"),
        S.resource_link(empty("resources"), "HOMEPAGE").alias("course_home_url"), S.resource_link(empty("resources"), "SYLLABUS").alias("syllabus_url"),
        (F.coalesce("_fy", F.lit(False)) | S.is_first_year_seminar(F.col("code"), text, needs)).alias("fysem"), S.is_sophomore_seminar(F.col("title"), text, needs).alias("sysem"),
        S.is_college_seminar(S.subject(F.col("code"))).alias("colsem"),
    )
    return out, rejects
