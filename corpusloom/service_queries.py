"""Queries over listings, scalars, rankings and queues, each beside DuckDB SQL written on its own."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .operators import evaluation, records
from .operators import listings as L
from .tables import load

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLE[f.__name__] = f, sql
        return f

    return add


# Sources and listings -------------------------------------------------------

@query("""with refs as (select doc_id, source, row_number() over (partition by source order by md5(concat('ref:', cast(doc_id as varchar(20)))), doc_id) as k from documents)
  select r.source, cast(r.k as bigint) as k, d.doc_id, d.n_chars from refs r join documents d on d.doc_id = r.doc_id where r.k <= 6""")
def pool_materialise(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    refs = L.pooled_rows(docs, "source", "doc_id", 6, "ref")
    return refs.join(docs.select("doc_id", "n_chars"), "doc_id").select("source", F.col("k").cast("long").alias("k"), "doc_id", "n_chars")


@query("""with wanted as (select source, doc_id from documents where source is not null), have as (select doc_id from documents where n_chars > 60),
  m as (select w.source, count(*) as wanted, sum(case when h.doc_id is null then 1 else 0 end) as missing from wanted w left join have h on h.doc_id = w.doc_id group by w.source)
  select source, cast(wanted as bigint) as wanted, cast(missing as bigint) as missing, missing = 0 as usable from m""")
def cache_complete(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    return L.completeness(docs.where("source is not null").select("source", "doc_id"), docs.where("n_chars > 60"), "source", "doc_id")


@query("""with have as (select l_partkey, sum(l_quantity) as got from lineitem where l_linestatus = 'F' group by l_partkey)
  select p_brand, case when h.l_partkey is null then 'pending' when h.got < 300 then 'failed' else 'cached' end as status, count(*) as n, cast(sum(p_size) as bigint) as total
  from part left join have h on h.l_partkey = p_partkey group by 1, 2""")
def download_status(spark, sf_dir):
    have = load(spark, sf_dir, "lineitem").where("l_linestatus = 'F'").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.sum("l_quantity").alias("got"))
    out = L.download_status(load(spark, sf_dir, "part"), have, "p_partkey", "got", 300)
    return out.groupBy("p_brand", "status").agg(F.count("*").alias("n"), F.sum("p_size").alias("total"))


@query("""with there as (select l_orderkey, count(*) as n from lineitem where l_returnflag <> 'A' group by l_orderkey), want as (select l_orderkey as k, count(*) as n from lineitem group by l_orderkey)
  select w.k, w.n from want w left join there t on t.l_orderkey = w.k and t.n = w.n where t.l_orderkey is null""")
def skip_mirrored(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem").withColumn("k", F.col("l_orderkey"))
    sizes = lambda df: df.groupBy("k").agg(F.count("*").alias("n"))
    return L.not_mirrored(sizes(li), sizes(li.where("l_returnflag <> 'A'")), "k", "n")


@query("""with t as (select max(ts) as now from events), r as (select user_id, event_type, max(ts) as last from events group by user_id, event_type)
  select user_id, event_type, date_sub('second', last, now) as age_s, date_sub('second', last, now) > 86400 as purge from r cross join t""")
def stale_runs(spark, sf_dir):
    return L.last_seen(load(spark, sf_dir, "events"), ["user_id", "event_type"], "ts").withColumn("purge", F.col("age_s") > 86400)


@query("""select s_nationkey as grp, count(*) as cached, 12 - count(*) as missing from supplier where s_acctbal > 0 group by s_nationkey having count(*) < 12""")
def prefetch_need(spark, sf_dir):
    return L.needing(load(spark, sf_dir, "supplier").where("s_acctbal > 0").withColumnRenamed("s_nationkey", "grp"), "grp", 12)


# Scalars --------------------------------------------------------------------

@query("""select event_id, cast(xor(event_id, (2654435761 * ((event_id % 3) + 1)) % 4294967296) as bigint) as seed from events""")
def seed_mix(spark, sf_dir):
    return load(spark, sf_dir, "events").select("event_id", L.seed_mix(F.col("event_id"), F.col("event_id") % 3).alias("seed"))


@query("""select event_id, round(case when event_id < 500 then event_id / 500e0 when event_id < 8000 then 1e0 else greatest(0e0, 1e0 - (event_id - 8000) / 2000e0) end, 6) as factor from events""")
def schedule_curve(spark, sf_dir):
    return load(spark, sf_dir, "events").select("event_id", F.round(L.schedule(F.col("event_id"), 500, 8000, 10000), 6).alias("factor"))


@query("""with g as (select l_suppkey, max(case when l_returnflag = 'N' then l_discount end) as good, min(case when l_returnflag = 'R' then l_discount + l_tax end) as bad from lineitem group by l_suppkey)
  select l_suppkey, round(case when good < bad then greatest((good + bad) / 2, 2 * good) else -1.0 end, 6) as threshold from g where good is not null and bad is not null""")
def threshold_suggest(spark, sf_dir):
    g = load(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        F.max(F.when(F.col("l_returnflag") == "N", F.col("l_discount"))).alias("good"), F.min(F.when(F.col("l_returnflag") == "R", F.col("l_discount") + F.col("l_tax"))).alias("bad")
    ).where("good is not null and bad is not null")
    return g.select("l_suppkey", F.round(F.coalesce(L.suggested_threshold(F.col("good"), F.col("bad")), F.lit(-1.0)), 6).alias("threshold"))


@query("""with b as (select user_id, floor((row_number() over (partition by user_id order by ts, event_id) - 1) / 8.0) as batch, value from events),
  m as (select user_id, batch, avg(value) as mean, sum(value) as total, count(*) as n from b group by user_id, batch)
  select user_id, round(avg(mean), 10) as mean_of_batches, round(sum(total) / sum(n), 10) as mean_of_rows from m group by user_id""")
def batch_means(spark, sf_dir):
    out = L.batch_means(load(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], "value", 8)
    return out.select("user_id", *(F.round(c, 10).alias(c) for c in ("mean_of_batches", "mean_of_rows")))


# Rankings and chains --------------------------------------------------------

@query("""with r as (select o_custkey, o_orderkey, o_orderdate, o_totalprice, max(o_totalprice) over (partition by o_custkey order by o_orderdate, o_orderkey rows between unbounded preceding and 1 preceding) as before from orders)
  select o_custkey, o_orderkey, round(greatest(coalesce(before, o_totalprice), o_totalprice), 6) as best, before is null or o_totalprice > before as improved from r""")
def best_so_far(spark, sf_dir):
    out = L.best_so_far(load(spark, sf_dir, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"], "o_totalprice")
    return out.select("o_custkey", "o_orderkey", F.round("best", 6).alias("best"), "improved")


@query("""with r as (select c_nationkey, c_custkey, row_number() over (partition by c_nationkey order by c_acctbal desc, c_custkey) as k from customer where c_acctbal >= 1000) select c_nationkey, c_custkey, cast(k as bigint) as k from r where k <= 3""")
def top_filtered(spark, sf_dir):
    c = load(spark, sf_dir, "customer").where("c_acctbal >= 1000")
    return L.top_each(c, "c_nationkey", [F.col("c_acctbal").desc(), F.col("c_custkey")], 3).select("c_nationkey", "c_custkey", F.col("k").cast("long").alias("k"))


@query("""with c as (select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as reign from orders)
  select o_custkey, o_orderkey, cast(case when reign >= 3 then reign + 1 else reign end as bigint) as reign from c union all select o_custkey, -1, cast(3 as bigint) from c where reign = 3""")
def chain_splice(spark, sf_dir):
    place = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))
    chain = load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", place.cast("long").alias("reign"))
    new = chain.select("o_custkey").distinct().select("o_custkey", F.lit(-1).cast("long").alias("o_orderkey"), F.lit(3).cast("long").alias("reign"))
    return L.spliced(chain, "o_custkey", "reign", 3, new)


@query("""with r as (select o_custkey, md5(cast(o_orderkey as varchar(20))) as digest, o_orderstatus, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as k from orders)
  select o_custkey, case when o_orderstatus = 'P' then '' else digest end as digest from r where k = 1""")
def last_digest(spark, sf_dir):
    rows = load(spark, sf_dir, "orders").withColumn("digest", F.md5(F.col("o_orderkey").cast("string").cast("binary")))
    last = records.latest(rows, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")], ["digest", "o_orderstatus"])
    return last.select("o_custkey", F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("digest")).alias("digest"))


@query("""with h as (select user_id, event_id, md5(event_type) as d, lag(md5(event_type)) over (partition by user_id order by ts, event_id) as before from events)
  select user_id, cast(sum(case when before is null or before <> d then 1 else 0 end) as bigint) as sent, cast(sum(case when before = d then 1 else 0 end) as bigint) as kept_back from h group by user_id""")
def change_suppression(spark, sf_dir):
    return L.sent(load(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], F.md5(F.col("event_type").cast("binary")))


@query("""with p as (select user_id, event_id, event_type, ts, case when event_type = lag(event_type) over (partition by user_id order by ts, event_id) then 0 else 1 end as fresh from events),
  r as (select *, sum(fresh) over (partition by user_id order by ts, event_id rows between unbounded preceding and current row) as phase from p)
  select user_id, cast(phase as bigint) as phase, min(event_type) as event_type, date_sub('second', min(ts), max(ts)) as elapsed_s, count(*) as n from r group by user_id, phase""")
def phase_elapsed(spark, sf_dir):
    return L.phases(load(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], "ts", "event_type")


@query("""with t as (select max(ts) as now from events), f as (select user_id, max(ts) as failed from events where event_type = 'error' group by user_id), s as (select distinct user_id from events where event_type = 'purchase')
  select f.user_id, date_sub('second', f.failed, t.now) < 360000 as cooling, s.user_id is not null as seen from f cross join t left join s on s.user_id = f.user_id""")
def failure_cooldown(spark, sf_dir):
    ev = load(spark, sf_dir, "events")
    now = ev.agg(F.max("ts").alias("now"))
    failed = ev.where("event_type = 'error'").groupBy("user_id").agg(F.max("ts").alias("failed")).crossJoin(F.broadcast(now))  # one row
    seen = ev.where("event_type = 'purchase'").select(F.col("user_id").alias("s")).distinct()
    cooling = F.timestamp_diff("SECOND", F.col("failed"), F.col("now")) < 360000
    return failed.join(seen, F.col("user_id") == F.col("s"), "left").select("user_id", cooling.alias("cooling"), F.col("s").isNotNull().alias("seen"))


@query("""with r as (select event_type, user_id, count(*) as n, row_number() over (partition by event_type order by count(*) desc, user_id) as k from events group by event_type, user_id) select event_type, user_id, n, cast(k as bigint) as k from r where k <= 3""")
def dashboard_top(spark, sf_dir):
    n = load(spark, sf_dir, "events").groupBy("event_type", "user_id").agg(F.count("*").alias("n"))
    return L.top_each(n, "event_type", [F.col("n").desc(), F.col("user_id")], 3).select("event_type", "user_id", "n", F.col("k").cast("long").alias("k"))


# Draws and allocations ------------------------------------------------------

@query("""select o_orderkey, cast(case when a + b <= 50000 then a else 50000 - floor(50000 * b / (a + b)) end as bigint) as public, cast(case when a + b <= 50000 then b else floor(50000 * b / (a + b)) end as bigint) as private
  from (select o_orderkey, floor(o_totalprice / 2.0) as a, floor(o_totalprice / 4.0) as b from orders) x""")
def capped_counts(spark, sf_dir):
    a, b = F.floor(F.col("o_totalprice") / 2), F.floor(F.col("o_totalprice") / 4)
    public, private = L.capped(a, b, 50000)
    return load(spark, sf_dir, "orders").select("o_orderkey", public.cast("long").alias("public"), private.cast("long").alias("private"))


@query("""with f as (select p_partkey, row_number() over (order by p_partkey) - 1 as ord, count(*) over () as n from part) select p_partkey from f where ((ord - 7) % n + n) % n < 40""")
def wrap_slice(spark, sf_dir):
    return L.wrap_slice(load(spark, sf_dir, "part"), "p_partkey", 7, 40).select("p_partkey")


@query("""with f as (select s_suppkey, row_number() over (partition by s_nationkey order by s_suppkey) - 1 as i, s_nationkey from supplier) select s_suppkey, s_nationkey, cast(i % 2 as bigint) as pair from f""")
def round_robin(spark, sf_dir):
    i = F.row_number().over(Window.partitionBy("s_nationkey").orderBy("s_suppkey")) - 1
    return load(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", (i % 2).cast("long").alias("pair"))


@query("""with b as (select source, count(*) as n from documents group by source), c as (select source, sum(n) over (order by source) - n as lo, sum(n) over (order by source) as hi, sum(n) over () as total from b)
  select l.l_orderkey, l.l_linenumber, c.source, cast(l.l_orderkey % c.total - c.lo as bigint) as local from lineitem l join c on l.l_orderkey % c.total >= c.lo and l.l_orderkey % c.total < c.hi""")
def range_lookup(spark, sf_dir):
    sizes = load(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n"))
    return L.local_rows(load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), "l_orderkey", sizes, "source", "n")


@query("""with a as (select l_partkey as k from lineitem where l_returnflag = 'R'), b as (select l_partkey as k from lineitem where l_returnflag = 'A'), i as (select k from a intersect select k from b)
  select count(*) as overlap, count(*) = 0 as disjoint from i""")
def overlap_check(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    return L.overlap(li.where("l_returnflag = 'R'").select("l_partkey"), li.where("l_returnflag = 'A'").select("l_partkey"))


@query("""with m as (select l_suppkey, avg(l_discount) - 0.04 as mu, avg(l_tax) - 0.035 as lcb, count(*) as n, min(l_quantity) < 1 as warned from lineitem group by l_suppkey)
  select l_suppkey, case when warned then 'DO_NOT_SUBMIT' when lcb <= 0.0025 then 'DO_NOT_SUBMIT' when n < 500 then 'PROMISING_NEEDS_MORE_EVAL' when lcb >= 0.0035 and mu >= 0.0075 then 'READY_TO_UPLOAD' else 'READY_TO_MERGE' end as decision from m""")
def submit_decision(spark, sf_dir):
    m = load(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        (F.avg("l_discount") - 0.04).alias("mu"), (F.avg("l_tax") - 0.035).alias("lcb"), F.count("*").alias("n"), (F.min("l_quantity") < 1).alias("warned")
    )
    return m.select("l_suppkey", evaluation.decision("lcb", "mu", "n", "warned", least_n=500).alias("decision"))


@query("""with q as (select o_orderkey, o_custkey, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as k, count(*) over (partition by o_custkey) as n from orders where o_orderstatus = 'P')
  select o_custkey, o_orderkey, concat('eval-', lpad(cast(k as varchar(20)), 4, '0')) as challenge, n - k as behind from q""")
def reindexed_queue(spark, sf_dir):
    out = L.numbered_queue(load(spark, sf_dir, "orders").where("o_orderstatus = 'P'"), "o_custkey", ["o_orderdate", "o_orderkey"])
    return out.select("o_custkey", "o_orderkey", "challenge", "behind")
