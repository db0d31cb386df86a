"""Table comparison, incremental merge and the changelog."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .. import config
from ..functions import scalars as S
from ..sources.spool import Spool
from . import tables


def _on(keys: list[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"o.`{k}`").eqNullSafe(F.col(f"n.`{k}`"))
    return out


def table_diff(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """One row per changed key: the keys, op (added, deleted, changed) and the sorted names of changed columns."""
    shared = sorted(c for c in new.columns if c in old.columns and c not in keys)
    both = old.withColumn("_o", F.lit(True)).alias("o").join(new.withColumn("_n", F.lit(True)).alias("n"), _on(keys), "full_outer")
    changed = F.array_compact(F.array(*[F.when(~F.col(f"o.`{c}`").eqNullSafe(F.col(f"n.`{c}`")), F.lit(c)) for c in shared])) if shared else F.array().cast("array<string>")
    is_old, is_new = F.col("o._o").isNotNull(), F.col("n._n").isNotNull()
    op = F.when(~is_old, "added").when(~is_new, "deleted").when(F.size(changed) > 0, "changed")
    pick = [F.coalesce(F.col(f"n.`{k}`"), F.col(f"o.`{k}`")).alias(k) for k in keys]
    return both.select(*pick, op.alias("op"), F.when(is_old & is_new, changed).otherwise(F.array().cast("array<string>")).alias("columns_changed")).where("op is not null")


#: Key ranges of a table whose digests are compared.
RANGES = 256


def key_range(keys: list[str], ranges: int = RANGES) -> Column:
    """The range of a row, by its key's hash: about as many rows in each, wherever keys lie."""
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(ranges)).cast("int")


def range_digests(df: DataFrame, keys: list[str], columns: list[str] | None = None, ranges: int = RANGES) -> DataFrame:
    """(range, n, digest): rows of a key range, and the sum of the hashes of their columns, in whatever order they lie.
    At most one row a range."""
    columns = sorted(set(columns or df.columns) - set(keys))
    whole = F.xxhash64(*[F.col(f"`{k}`") for k in keys], *[F.col(f"`{c}`") for c in columns]).cast("decimal(20,0)")
    return df.groupBy(key_range(keys, ranges).alias("range")).agg(F.count("*").alias("n"), F.sum(whole).alias("digest"))


def differing_ranges(old: DataFrame, new: DataFrame) -> list[int]:
    """Ranges whose digests differ, of which there are at most as many as ranges."""
    both = old.alias("o").join(new.alias("n"), "range", "full_outer")
    same = F.col("o.n").eqNullSafe(F.col("n.n")) & F.col("o.digest").eqNullSafe(F.col("n.digest"))
    return sorted(r.range for r in both.where(~same).select("range").collect())


def digest_diff(old: DataFrame, new: DataFrame, keys: list[str], digests: DataFrame | None = None, ranges: int = RANGES) -> tuple[DataFrame, list[int]]:
    """`table_diff` of the key ranges whose digests differ, and these ranges; rows of all others are not compared.
    `digests` may hold those of `old` over the columns that it shares with `new`; a table that was stored in the order
    of its ranges is then read in those ranges only."""
    shared = [c for c in new.columns if c in old.columns]
    had = range_digests(old, keys, shared, ranges) if digests is None else digests
    some = differing_ranges(had, range_digests(new, keys, shared, ranges))
    if not some:
        return old.sparkSession.createDataFrame([], table_diff(old, new, keys).schema), some
    own = lambda df: df.where(key_range(keys, ranges).isin(some))
    return table_diff(own(old), own(new), keys), some


def schema_violations(old: DataFrame, new: DataFrame) -> list[str]:
    """Columns that one version lacks, and columns of another type, audit columns and types of nulls aside."""
    a, b = ({f.name: f.dataType.simpleString() for f in df.schema if f.name not in config.AUDIT_COLUMNS} for df in (old, new))
    out = [f"column {c} is only in the {side} version" for side, x, y in (("old", a, b), ("new", b, a)) for c in x if c not in y]
    return out + [f"column {c} was {a[c]} and is {b[c]}" for c in a if c in b and a[c] != b[c] and "void" not in (a[c], b[c])]


def diff_summary(diffs: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, d in diffs.items():
        one = d.groupBy("op").agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "op", "n")
        out = one if out is None else out.unionByName(one)
    return out


def merge(old: DataFrame, new: DataFrame, keys: list[str], computed: list[str], now: Column, keep_deleted: bool = False) -> DataFrame:
    """The next version of a table with audit columns time_added and last_updated.

    New rows get `now` in both; a changed row's last_updated moves only if some column that is not computed
    changed; rows that are gone are dropped unless `keep_deleted`.
    """
    columns = [c for c in new.columns if c not in config.AUDIT_COLUMNS]
    both = old.withColumn("_o", F.lit(True)).alias("o").join(new.withColumn("_n", F.lit(True)).alias("n"), _on(keys), "full_outer")
    own = [c for c in columns if c in old.columns and c not in keys and c not in computed]
    touched = F.lit(False)
    for c in own:
        touched = touched | ~F.col(f"o.`{c}`").eqNullSafe(F.col(f"n.`{c}`"))
    is_old, is_new = F.col("o._o").isNotNull(), F.col("n._n").isNotNull()
    old_of = lambda c: F.col(f"o.`{c}`") if c in old.columns else F.lit(None)
    out = [F.when(is_new, F.col(f"n.`{c}`")).otherwise(old_of(c)).alias(c) for c in columns]
    out.append(F.when(is_old, old_of("time_added")).otherwise(now).alias("time_added"))
    out.append(F.when(~is_old | (is_new & touched), now).otherwise(old_of("last_updated")).alias("last_updated"))
    return (both if keep_deleted else both.where(is_new)).select(*out)


def touch_parents(parent: DataFrame, key: str, changed: DataFrame, now: Column) -> DataFrame:
    """Parents of changed junction rows get a new last_updated."""
    some = changed.select(F.col(key).alias("_k")).distinct().withColumn("_hit", F.lit(True))
    return parent.join(some, F.col(key) == F.col("_k"), "left").withColumn("last_updated", F.when(F.col("_hit"), now).otherwise(F.col("last_updated"))).drop("_k", "_hit")


def merge_all(old: dict[str, DataFrame], new: dict[str, DataFrame], now: Column, diffs: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """The next version of all tables, parents first. Meetings keep changed courses' rows whole. `diffs` are changes
    that are known already."""
    out: dict[str, DataFrame] = {}
    for name in config.LOAD_ORDER:
        if name == "course_meetings" or name not in new:
            continue
        out[name] = merge(old[name], new[name], config.PRIMARY_KEYS[name], config.COMPUTED_COLUMNS.get(name, []), now, name in config.KEPT_ON_DELETE)
    for name, key in config.JUNCTIONS.items():
        if name in out:
            changed = (diffs or {}).get(name)
            changed = table_diff(old[name], new[name], config.PRIMARY_KEYS[name]) if changed is None else changed
            out["courses"] = touch_parents(out["courses"], key, changed, now)
    return out


# places and meetings


def upsert_ids(new: DataFrame, old: DataFrame, keys: list[str], ident: str) -> DataFrame:
    """Rows of `new` with the id of the null-safely equal old row, or the next free ids in key order."""
    known = old.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(ident).alias("_id"))
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    out = new.join(known, on, "left").drop(*[f"_{k}" for k in keys])
    top = old.agg(F.coalesce(F.max(ident), F.lit(0)).alias("_top"))
    fresh = tables.ordered(out.where("_id is null").select(*keys).distinct(), keys, "_at", Spool(new.sparkSession, "upsert"))
    fresh = tables.row_ids(fresh, "_at", "_rank").crossJoin(F.broadcast(top))  # one row
    fresh = fresh.select(*[F.col(k).alias(f"_{k}") for k in keys], (F.col("_top") + 1 + F.col("_rank")).alias("_new"))
    return out.join(fresh, on, "left").withColumn(ident, F.coalesce("_id", "_new")).drop("_id", "_new", *[f"_{k}" for k in keys])


def resolve_locations(meetings: DataFrame, locations: DataFrame) -> DataFrame:
    """Meetings with location_id by building code and room, a missing room being a value of its own."""
    places = locations.select(F.col("building_code").alias("_b"), F.col("room").alias("_r"), F.col("location_id").alias("_id"))
    out = meetings.drop("location_id").join(places, F.col("_building_code").eqNullSafe(F.col("_b")) & F.col("_room").eqNullSafe(F.col("_r")), "left")
    return out.withColumn("location_id", F.when(F.col("_building_code").isNotNull(), F.col("_id"))).drop("_b", "_r", "_id", "_building_code", "_room")


def dedup_meetings(meetings: DataFrame) -> DataFrame:
    """One row per course, time and place; without a place only where no placed row has that course and time."""
    key = ["course_id", "start_time", "end_time"]
    placed = meetings.where("location_id is not null").groupBy(*key, "location_id").agg(F.min("days_of_week").alias("days_of_week"))
    loose = meetings.where("location_id is null").groupBy(*key).agg(F.min("days_of_week").alias("days_of_week")).join(placed, key, "left_anti")
    return placed.unionByName(loose.withColumn("location_id", F.lit(None).cast(placed.schema["location_id"].dataType)))


def changed_meeting_courses(old: DataFrame, new: DataFrame) -> DataFrame:
    """Courses whose meeting sets differ; any old meeting without a place counts as a change."""
    row = F.struct("start_time", "end_time", "days_of_week", "location_id")
    of = lambda df, c: df.groupBy("course_id").agg(F.array_sort(F.collect_list(row)).alias(c))
    loose = old.groupBy("course_id").agg(F.bool_or(F.col("location_id").isNull()).alias("_loose"))
    both = of(old, "_old").join(of(new, "_new"), "course_id", "full_outer").join(loose, "course_id", "left")
    return both.where(~F.col("_old").eqNullSafe(F.col("_new")) | F.coalesce("_loose", F.lit(False))).select("course_id")


def sync_meetings(old: DataFrame, new: DataFrame) -> DataFrame:
    """Changed courses take all their new meetings, the others keep the old ones."""
    changed = changed_meeting_courses(old, new)
    return old.join(changed, "course_id", "left_anti").unionByName(dedup_meetings(new.join(changed, "course_id", "left_semi")).select(*old.columns))


def freeze_locations(old: DataFrame, new: DataFrame) -> DataFrame:
    """New meetings that carry the old places on: the k-th meeting of a course and time gets the k-th smallest."""
    key = ["course_id", "start_time", "end_time"]
    a = new.drop("location_id").withColumn("_k", F.row_number().over(W.partitionBy(*key).orderBy("days_of_week")))
    b = old.where("location_id is not null").select(*key, "location_id").distinct().withColumn("_k", F.row_number().over(W.partitionBy(*key).orderBy("location_id")))
    return a.join(b, [*key, "_k"], "left").drop("_k")


def cascade_delete(buildings_gone: DataFrame, locations: DataFrame, meetings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Locations and meetings left when buildings (code) go: their locations go, and the meetings held there."""
    gone = locations.join(buildings_gone, locations.building_code == buildings_gone.code, "left_semi").select("location_id")
    return locations.join(gone, "location_id", "left_anti"), meetings.join(gone, "location_id", "left_anti")


# changelog


def text_of(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("N/A"))


def change_lines(old: DataFrame, new: DataFrame, keys: list[str], computed: list[str], who: Callable[[str], Column]) -> DataFrame:
    """(section, line) of a table: additions, removals, and updates with old and new values of its own columns.
    `who(alias)` names a row of the aliased side."""
    shared = sorted(c for c in new.columns if c in old.columns and c not in keys and c not in computed)
    both = old.withColumn("_o", F.lit(True)).alias("o").join(new.withColumn("_n", F.lit(True)).alias("n"), _on(keys), "full_outer")
    is_old, is_new = F.col("o._o").isNotNull(), F.col("n._n").isNotNull()
    each = [F.when(~F.col(f"o.`{c}`").eqNullSafe(F.col(f"n.`{c}`")), F.concat(F.lit(f"\n  - {c}: "), text_of(F.col(f"o.`{c}`")), F.lit(" → "), text_of(F.col(f"n.`{c}`")))) for c in shared]
    updates = F.array_compact(F.array(*each)) if each else F.array().cast("array<string>")
    section = F.when(~is_old, "Additions").when(~is_new, "Removals").when(F.size(updates) > 0, "Updates")
    body = F.when(is_old & is_new, F.array_join(updates, "")).otherwise("")
    return both.select(section.alias("section"), F.concat(F.lit("- "), F.when(is_new, who("n")).otherwise(who("o")), body).alias("line")).where("section is not null")


def listing_links(listings: DataFrame, link: str = "{season}-{crn}") -> DataFrame:
    """(course_id, links): the course's listings as Markdown links, in listing order."""
    before, after = link.split("{season}")
    between, end = after.split("{crn}")
    one = F.concat(F.lit("["), "course_code", F.lit(" "), F.coalesce("section", F.lit("")), F.lit(f"]({before}"), "season_code", F.lit(between), F.col("crn").cast("string"), F.lit(f"{end})"))
    rows = listings.select("course_id", F.struct("listing_id", one.alias("text")).alias("r"))
    return rows.groupBy("course_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["text"]), " / ").alias("links"))


def cross_listing_notes(diff: DataFrame, listings: DataFrame, others: DataFrame, op: str) -> DataFrame:
    """(course_id, note) for added or deleted courses of which listings exist on the other side."""
    some = listings.join(diff.where(F.col("op") == op).select("course_id"), "course_id", "left_semi").join(others.select("listing_id"), "listing_id", "left_semi")
    codes = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("listing_id", "course_code"))), lambda r: r["course_code"]), ", ")
    what = "split" if op == "added" else "merge"
    g = some.groupBy("course_id").agg(codes.alias("codes"), F.count("*").alias("n"))
    return g.select("course_id", F.concat(F.lit("\n  - Note: "), "codes", F.when(F.col("n") == 1, " exists").otherwise(" exist"), F.lit(f"; this is probably due to a cross-listing {what}")).alias("note"))


def junction_lines(old: DataFrame, new: DataFrame, names: DataFrame, key: str, name: str, title: str, courses: DataFrame) -> DataFrame:
    """(course_id, line) for courses of both versions whose linked names differ."""
    joined = lambda df, c: df.join(names, key, "left").groupBy("course_id").agg(F.array_join(F.array_sort(F.collect_list(F.coalesce(name, F.lit("N/A")))), ", ").alias(c))
    both = joined(old, "_old").join(joined(new, "_new"), "course_id", "full_outer").join(courses.select("course_id"), "course_id", "left_semi")
    return both.where(~F.col("_old").eqNullSafe(F.col("_new"))).select("course_id", F.concat(F.lit(f"\n  - {title}: "), text_of(F.col("_old")), F.lit(" → "), text_of(F.col("_new"))).alias("line"))


def text_lines(old: DataFrame, new: DataFrame, title: str, courses: DataFrame) -> DataFrame:
    """(course_id, line) for courses of both versions whose texts (course_id, text) differ."""
    both = old.select("course_id", F.col("text").alias("_old")).join(new.select("course_id", F.col("text").alias("_new")), "course_id", "full_outer").join(courses.select("course_id"), "course_id", "left_semi")
    return both.where(~F.col("_old").eqNullSafe(F.col("_new"))).select("course_id", F.concat(F.lit(f"\n  - {title}: "), text_of(F.col("_old")), F.lit(" → "), text_of(F.col("_new"))).alias("line"))


def meeting_text(meetings: DataFrame, locations: DataFrame) -> DataFrame:
    """(course_id, text): days, times and place of each meeting, joined."""
    places = locations.select("location_id", F.concat_ws(" ", "building_code", "room").alias("place"))
    rows = meetings.join(places, "location_id", "left")
    one = F.concat(S.day_letters(F.col("days_of_week")), F.lit(" "), "start_time", F.lit("–"), "end_time", F.lit(" "), F.coalesce("place", F.lit("")))
    return rows.groupBy("course_id").agg(F.array_join(F.array_sort(F.collect_list(one)), ", ").alias("text"))


def summary_lines(diffs: dict[str, DataFrame]) -> list[str]:
    names = {"added": "Added", "deleted": "Removed", "changed": "Updated"}
    found: dict[str, dict[str, int]] = {}
    for r in diff_summary(diffs).collect():  # three counts a table
        found.setdefault(r.table_name, {})[r.op] = r.n
    out = []
    for t in diffs:
        if t in found:
            out.append(f"- {t}")
            out += [f"  - {label}: {found[t][op]}" for op, label in names.items() if op in found[t]]
    return out
