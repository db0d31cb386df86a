"""Evaluations to tables: statistics, questions, narratives, ratings and summaries; prompts for summaries."""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import checks, tables
from ..operators.metrics import compute_narratives, compute_questions
from ..operators.running import running_count
from ..sources.crawl import RateLimited
from ..sources.spool import Spool


def match(evals: DataFrame, listings: DataFrame) -> DataFrame:
    """Evaluations of known listings with their course; others are left out. A listing that is there more than once
    stands for the smallest of its courses."""
    known = listings.groupBy(F.col("season_code").alias("season"), F.col("crn").cast("int").alias("_crn")).agg(F.min("course_id").alias("course_id"))
    return evals.withColumn("_crn", F.expr("try_cast(crn as int)")).join(known, ["season", "_crn"]).drop("_crn")


def questions_by_code(questions: DataFrame, ordinal: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One row per question code, the most recent season's (of its rows the first), with the code's merged text; the
    codes whose texts diverge; the codes used for both kinds."""
    questions = questions.withColumn("question_text", S.normalize_question(F.col("question_text")))
    texts = questions.groupBy("question_code").agg(S.merge_question_texts(F.collect_set("question_text")).alias("texts"))
    latest = F.struct(F.col("season").alias("s"), (-F.col(ordinal)).alias("o"))
    row = F.max_by(F.struct("is_narrative", "options"), latest)
    out = questions.groupBy("question_code").agg(row.alias("_r")).join(texts, "question_code")
    out = out.select("question_code", "_r.is_narrative", F.element_at("texts", 1).alias("question_text"), "_r.options")
    return out, checks.diverging_texts(texts), checks.mixed_questions(questions)


def import_evaluations(evals: DataFrame, listings: DataFrame, summaries: DataFrame | None = None) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Tables and violations, from evaluations (crn, season, enrolled, responses, ratings, narratives, extras,
    _ordinal). First rows win; comments need more than two characters."""
    rows = match(evals, listings)
    statistics = tables.keep_first(rows.select("course_id", "enrolled", "responses", "extras", "_ordinal"), ["course_id"], "_ordinal").drop("_ordinal")
    place = lambda *p: F.struct("_ordinal", *p)
    each = rows.select("season", "course_id", "_ordinal", F.posexplode("ratings").alias("_p", "r"))
    each = each.select("season", "course_id", "_ordinal", "_p", "r.question_code", "r.question_text", "r.options", F.col("r.data").alias("rating"))
    ratings = each.groupBy("course_id", "question_code").agg(F.min_by("rating", place("_p")).alias("rating"), F.min(place("_p")).alias("_s"))
    told = rows.select("season", "course_id", "_ordinal", F.posexplode("narratives").alias("_p", "n"))
    told = told.select("season", "course_id", "_ordinal", "_p", "n.question_code", "n.question_text", "n.comments")
    said = told.select("course_id", "question_code", "_ordinal", "_p", F.posexplode("comments").alias("_c", "comment"))
    said = said.where(F.col("comment").isNotNull() & (F.length("comment") > 2))
    said = said.groupBy("course_id", "question_code", "comment").agg(F.min(place("_p", "_c")).alias("_s"))
    said = said.withColumn("response_number", tables.numbered(["course_id", "question_code"], "_s").cast("int"))
    asked = each.select("season", "_ordinal", "question_code", "question_text", "options", F.lit(False).alias("is_narrative"))
    asked = asked.unionByName(told.select("season", "_ordinal", "question_code", "question_text", F.lit(None).cast("array<string>").alias("options"), F.lit(True).alias("is_narrative")))
    questions, diverging, mixed = questions_by_code(asked, "_ordinal")
    questions, several = compute_questions(questions)
    # stable ids: a hash of the key orders as well as the input does and needs no global sort
    out = {
        "evaluation_statistics": statistics,
        "evaluation_questions": questions,
        "evaluation_ratings": ratings.select(F.xxhash64("course_id", "question_code").alias("id"), "course_id", "question_code", "rating"),
        "evaluation_narratives": compute_narratives(said.select(F.xxhash64("course_id", "question_code", "comment").alias("id"), "course_id", "question_code", "response_number", "comment")),
    }
    if summaries is not None:
        out["evaluation_narrative_summaries"] = import_summaries(summaries, listings)
    return out, {"question texts agree": diverging, "questions are of one kind": mixed, "questions have one tag": several}


def import_summaries(summaries: DataFrame, listings: DataFrame) -> DataFrame:
    """(course_id, question_code, summary) of known listings; numbers that are none are skipped; the first row wins."""
    rows = match(summaries, listings).select("course_id", "_ordinal", F.posexplode("narrative_summaries").alias("_p", "s"))
    return rows.groupBy("course_id", F.col("s.question_code").alias("question_code")).agg(F.min_by(F.col("s.summary"), F.struct("_ordinal", "_p")).alias("summary"))


# summaries

SYSTEM = "Summarise student comments on one course question in two to four objective sentences, in the third person, without quoting."


def summary_prompt(question: Column, comments: Column) -> Column:
    return F.concat(F.lit("Evaluation question: "), question, F.lit("\n\nStudent comments ("), F.size(comments).cast("string"), F.lit(" total):\n"), F.array_join(comments, "\n---\n"))


def prompts(evals: DataFrame, done: DataFrame | None = None, least: int = 3, most_courses: int | None = None) -> DataFrame:
    """(season, crn, question_code, question_text, prompt) of questions with enough comments that have no summary in
    `done`; of each season those of the first `most_courses` courses with such questions, by number."""
    each = evals.select("season", "crn", F.explode("narratives").alias("n")).select("season", "crn", "n.*")
    each = each.where(F.size("comments") >= least)
    if done is not None:
        known = done.select("season", "crn", F.explode("narrative_summaries.question_code").alias("question_code"))
        each = each.join(known, ["season", "crn", "question_code"], "left_anti")
    if most_courses is not None:
        # of a season's courses some are picked: first numbers from ranges of the distinct ones, not from a window
        spool = Spool(evals.sparkSession, "prompts")
        first = running_count(each.select("season", "crn").distinct(), ["season"], ["crn"], "_n", spool).where(F.col("_n") < most_courses)
        each = each.join(first.drop("_n"), ["season", "crn"], "left_semi")
    return each.select("season", "crn", "question_code", "question_text", summary_prompt(F.col("question_text"), F.col("comments")).alias("prompt"))


class CallLedger:
    """Answers by the digest of what was asked, a file each in a folder that all executors share. An answer is written
    under another name and moved, so that it is there whole or not at all."""

    def __init__(self, uri: str):
        from pyarrow import fs

        self.fs, self.at = fs.FileSystem.from_uri(uri if "://" in uri else "file://" + os.path.abspath(uri))
        self.fs.create_dir(self.at, recursive=True)

    def ask(self, messages: list[dict], complete: Callable[[list[dict]], str]) -> str:
        from pyarrow import fs

        digest = hashlib.sha256(json.dumps(messages, sort_keys=True).encode()).hexdigest()
        at = f"{self.at}/{digest}"
        if self.fs.get_file_info(at).type == fs.FileType.File:
            with self.fs.open_input_stream(at) as f:
                return f.read().decode()
        text = complete(messages)
        own = f"{at}.{uuid.uuid4().hex}"
        with self.fs.open_output_stream(own) as f:
            f.write(text.encode())
        self.fs.move(own, at)
        return text


def summarize(asked: DataFrame, complete: Callable[[list[dict]], str], in_flight: int = 10, ledger: str | None = None) -> DataFrame:
    """(season, crn, question_code, question_text, summary, error) of one call of `complete(messages)` a prompt, by
    `in_flight` tasks at most. With a ledger a call is made only if its answer is not there yet. A call that is put
    off (`RateLimited`) after its own retries gives an error; any other exception fails the job."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        calls = CallLedger(ledger) if ledger else None
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                messages = [{"role": "system", "content": SYSTEM}, {"role": "user", "content": r.prompt}]
                text = error = None
                try:
                    text = calls.ask(messages, complete) if calls else complete(messages)
                except RateLimited as e:
                    error = repr(e)
                out.append((r.season, r.crn, r.question_code, r.question_text, text, error))
            yield pd.DataFrame(out, columns=["season", "crn", "question_code", "question_text", "summary", "error"])

    return asked.repartition(in_flight, "season", "crn").mapInPandas(run, "season string, crn string, question_code string, question_text string, summary string, error string")


def with_summaries(before: DataFrame, made: DataFrame) -> DataFrame:
    """(season, crn, narrative_summaries): what each course had, and what was made for it."""
    one = F.struct("question_code", "question_text", "summary")
    had = before.select("season", "crn", F.explode("narrative_summaries").alias("s"))
    each = had.unionByName(made.select("season", "crn", one.alias("s")))
    some = each.groupBy("season", "crn").agg(F.array_sort(F.collect_list("s")).alias("narrative_summaries"))
    empty = before.where(F.size("narrative_summaries") == 0).select("season", "crn", "narrative_summaries").join(made.select("season", "crn"), ["season", "crn"], "left_anti")
    return some.unionByName(empty)
