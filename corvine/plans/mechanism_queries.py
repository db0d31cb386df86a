"""Registered queries of the library's mechanisms: incremental components, range digests, ledgers, a served source, SQL
functions. Each reads the driver's tables and is compared with SQL over the same tables."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import functions as F

from .. import sql
from ..operators import diff, graph
from ..sources import io, served
from ..sources.spool import Spool
from .catalog_queries import ORACLE, QUERIES
from .queries import _HIST, _OFF, offerings, query, t

__all__ = ["ORACLE", "QUERIES"]


@query("""with p as (select p_partkey as node, p_brand || '/' || cast(case when p_partkey % 100 = 7 then p_size % 50 + 1 else p_size end as varchar) || '/' || p_type as k from part)
select node, min(node) over (partition by k) as root from p""")
def components_after_edits(spark, d):
    """Components of parts of one brand, size and type after one part of a hundred changed its size: only components
    with such a part are contracted again."""
    p = t(spark, d, "part").select(F.col("p_partkey").alias("node"), "p_brand", "p_size", "p_type")
    spool = Spool(spark, "edits")
    edited = p.withColumn("p_size", F.when(F.col("node") % 100 == 7, F.col("p_size") % 50 + 1).otherwise(F.col("p_size")))
    stars = lambda x: graph.star_edges(x, "node", ["p_brand", "p_size", "p_type"], broadcast=False)
    edges, new = spool.keep(stars(p), "edges"), spool.keep(stars(edited), "new")
    known = spool.keep(graph.labels(p.select("node"), edges, spool, broadcast=False), "known")
    without = lambda x, y: x.join(y.hint("merge"), ["a", "b"], "left_anti")
    found, _, _ = graph.updated_labels(known, edges, without(new, edges), without(edges, new), spool)
    return found


_CHANGED = "select o_orderkey, o_custkey, case when o_orderkey % 97 = 3 then 'X' else o_orderstatus end as status, o_totalprice from orders where o_orderkey % 89 <> 5 union all select o_orderkey + 100000000, o_custkey, o_orderstatus, o_totalprice from orders where o_orderkey % 101 = 9"


@query(f"""with o as (select o_orderkey, o_custkey, o_orderstatus as status, o_totalprice from orders), n as ({_CHANGED})
select coalesce(n.o_orderkey, o.o_orderkey) as o_orderkey, case when o.o_orderkey is null then 'added' when n.o_orderkey is null then 'deleted' else 'changed' end as op,
case when o.o_orderkey is not null and n.o_orderkey is not null then 'status' else '' end as columns_changed
from o full join n on o.o_orderkey = n.o_orderkey where o.o_orderkey is null or n.o_orderkey is null or o.status is distinct from n.status""")
def table_diff_by_digests(spark, d):
    """Two versions of the orders: key ranges whose digests are equal are not compared."""
    o = t(spark, d, "orders").select("o_orderkey", "o_custkey", F.col("o_orderstatus").alias("status"), "o_totalprice")
    k = F.col("o_orderkey")
    new = o.where(k % 89 != 5).withColumn("status", F.when(k % 97 == 3, "X").otherwise(F.col("status")))
    new = new.unionByName(o.where(k % 101 == 9).withColumn("o_orderkey", k + 100000000))
    found, _ = diff.digest_diff(o, new, ["o_orderkey"], ranges=1024)
    return found.select("o_orderkey", "op", F.array_join("columns_changed", ",").alias("columns_changed"))


@query("select '20200' || cast(p_size % 5 as varchar) as season, sum(p_partkey) as total, count(*) as n from part where p_size % 5 in (1, 3) or p_size % 5 = 0 group by 1")
def changed_landing_seasons(spark, d):
    """Seasons land as files, two are landed again with one part more or less, one is new: the ledger tells which are to
    be read, and only these are."""
    at = Spool(spark, "landed").path("raw")
    p = t(spark, d, "part").select(F.concat(F.lit("20200"), (F.col("p_size") % 5).cast("string")).alias("season"), "p_partkey")
    for k in (1, 2, 3, 4):
        io.write_json(p.where(F.col("season") == f"20200{k}").where(F.col("p_partkey") != F.lit(k)).select("p_partkey"), f"{at}/20200{k}.json", ["p_partkey"])
    empty = io.read_ledger(spark, f"{at}-ledger")
    io.write_ledger(io.landed_now(spark, [at], empty), f"{at}-ledger")
    for k in (0, 1, 3):
        io.write_json(p.where(F.col("season") == f"20200{k}").select("p_partkey"), f"{at}/20200{k}.json", ["p_partkey"])
    ledger = io.read_ledger(spark, f"{at}-ledger")
    changed = sorted(io.changed_seasons(io.landed_now(spark, [at], ledger), ledger))
    out = None
    for season in changed:  # a few
        one = io.read_json(spark, f"{at}/{season}.json", "p_partkey long").select(F.col("_season").alias("season"), "p_partkey")
        out = one if out is None else out.unionByName(one)
    return out.groupBy("season").agg(F.sum("p_partkey").alias("total"), F.count("*").alias("n"))


@query("""select '20240' || cast(page_id % 4 as varchar) as season, 'S' || cast(page_id % 3 as varchar) as school, page_id, cast(length(html) as bigint) as size from pages where page_id % 4 in (1, 3) and page_id % 3 = 2 and length(html) > 100""")
def served_pages(spark, d):
    """Pages of a service, asked by season and school; the rest of the filter is Spark's."""
    at = f"{d}/pages.parquet"

    def fetch(asked: dict) -> Iterator[dict]:
        """A service that answers from the table, some rows at a time."""
        import pyarrow.compute as pc
        import pyarrow.dataset as ds
        import pyarrow.parquet as pq

        for part in ds.dataset(at).get_fragments():
            with part.open() as f:
                for rows in pq.ParquetFile(f, buffer_size=1 << 20).iter_batches(256, columns=["page_id", "html"], use_threads=False):
                    for page_id, size in zip(rows["page_id"].to_pylist(), pc.utf8_length(rows["html"]).to_pylist(), strict=True):
                        season, school = f"20240{page_id % 4}", f"S{page_id % 3}"
                        if season == asked["season"] and asked.get("school") in (None, school):
                            yield {"page_id": page_id, "size": size, "school": school}

    source = served.course_source(fetch, "season string, school string, page_id long, size long", "served_pages")
    return served.load(spark, source, ["202400", "202401", "202402", "202403"]).where("season in ('202401', '202403') and school = 'S2' and size > 100")


# the SQL surface


@query(f"""with {_OFF}, l as (select l_orderkey, min(l_linenumber) as c from lineitem group by 1)
select off.course_id as oid, case right(season_code, 1) when '1' then 'spring' when '2' then 'summer' else 'fall' end as term, cast(substr(season_code, 1, 4) as integer) as year,
(cast(season_code as bigint) - 200000) * 100000 + c as course_id, (cast(season_code as bigint) - 200000) * 100000 + off.course_id % 100000 as listing_id, right(season_code, 1) = '2' as summer
from off join l on l_orderkey = off.course_id""")
def sql_course_ids(spark, d):
    sql.register(spark)
    t(spark, d, "orders").createOrReplaceTempView("corvine_orders")
    t(spark, d, "lineitem").createOrReplaceTempView("corvine_lineitem")
    return spark.sql("""
        with l as (select l_orderkey, collect_set(cast(l_linenumber as bigint)) as crns from corvine_lineitem group by l_orderkey),
        o as (select o_orderkey, season_of(cast(o_orderdate as date)) as season from corvine_orders)
        select o_orderkey as oid, season_term(season) as term, season_year(season) as year, course_id(season, crns) as course_id,
               listing_id(season, o_orderkey % 100000) as listing_id, is_summer(season) as summer
        from o join l on l_orderkey = o_orderkey""")


@query("select event_type, user_id, event_id, value from (select *, row_number() over (partition by event_type, user_id order by event_id) as rn from events) where rn = 1")
def sql_first_rows(spark, d):
    sql.register(spark)
    t(spark, d, "events").select("event_type", "user_id", "event_id", "value").createOrReplaceTempView("corvine_events")
    return spark.sql("select * from first_rows(table(corvine_events) partition by (event_type, user_id) order by event_id)")


@query(f"with {_HIST} select course_id, last_offered_course_id, last_enrollment_course_id from hist")
def sql_history(spark, d):
    sql.register(spark)
    offerings(spark, d).select("grp", "season_code", "course_id", "enrolled").createOrReplaceTempView("corvine_offerings")
    return spark.sql("""
        select course_id, last_offered_course_id, last_enrollment_course_id
        from history(table(corvine_offerings) partition by grp order by (season_code, course_id), 'season_code', 'course_id', 'enrolled')""")
