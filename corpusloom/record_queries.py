"""Queries over records, events and tensors: what an evaluation service keeps and asks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .operators import records
from .operators.quantiles import quantiles
from .queries import r6
from .tables import load

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLE[f.__name__] = f, sql
        return f

    return add


# Events ---------------------------------------------------------------------

@query("""with g as (select event_id, user_id, date_sub('second', lag(ts) over (partition by user_id order by ts, event_id), ts) as gap from events)
  select event_id, user_id, coalesce(gap, -1)::bigint as gap_s, case when gap >= 86400 then 'timeout' when gap >= 21600 then 'warn' else 'active' end as state from g""")
def idle_gaps(spark, sf_dir):
    out = records.idle_gaps(load(spark, sf_dir, "events"), "user_id", "ts", 21600, 86400, "event_id")
    return out.select("event_id", "user_id", F.coalesce("gap_s", F.lit(-1)).cast("long").alias("gap_s"), "state")


@query("""select user_id, event_type, arg_max(event_id, (ts, event_id)) as event_id, arg_max(round(value, 6), (ts, event_id)) as value, count(*)::bigint as n from events group by all""")
def event_state(spark, sf_dir):
    ev = load(spark, sf_dir, "events")
    return ev.groupBy("user_id", "event_type").agg(
        F.max_by("event_id", F.struct("ts", "event_id")).alias("event_id"), F.max_by(F.round("value", 6), F.struct("ts", "event_id")).alias("value"), F.count("*").alias("n")
    )


@query("""select user_id, arg_min(event_id, (ts, event_id)) as event_id, arg_min(event_type, (ts, event_id)) as event_type from events group by user_id""")
def admit_once(spark, sf_dir):
    return records.first_seen(load(spark, sf_dir, "events"), ["user_id"], [F.col("ts"), F.col("event_id")], ["event_id", "event_type"])


@query("""with o as (select user_id, event_id, ts, case when event_type = 'error' then 'error' else 'ok' end as kind from events),
  m as (select *, case when kind is distinct from lag(kind) over w then 1 else 0 end as new from o window w as (partition by user_id order by ts, event_id)),
  r as (select *, sum(new) over (partition by user_id order by ts, event_id) as run from m),
  c as (select user_id, run, kind, count(*) as n from r group by all)
  select user_id, count(*)::bigint as error_runs, max(n)::bigint as longest, count_if(n >= 3)::bigint as restarts from c where kind = 'error' group by user_id""")
def error_runs(spark, sf_dir):
    ev = load(spark, sf_dir, "events").withColumn("kind", F.when(F.col("event_type") == "error", "error").otherwise("ok"))
    r = records.runs(ev, "user_id", ["ts", "event_id"], "kind").where("kind = 'error'")
    return r.groupBy("user_id").agg(F.count("*").alias("error_runs"), F.max("n").alias("longest"), F.count_if(F.col("n") >= 3).alias("restarts"))


@query("""select event_id, user_id, round(avg(value) over w, 9) as mu_so_far, count(*) over w as n_so_far from events
  window w as (partition by user_id order by ts, event_id rows between unbounded preceding and current row)""")
def running_mean(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    ev = load(spark, sf_dir, "events")
    return ev.select("event_id", "user_id", F.round(F.avg("value").over(w), 9).alias("mu_so_far"), F.count("*").over(w).alias("n_so_far"))


@query("""select event_type, (extract(hour from ts))::bigint as hour, round(arg_max(value, (ts, event_id)), 6) as last_value from events group by all""")
def last_per_stage(spark, sf_dir):
    ev = load(spark, sf_dir, "events").withColumn("hour", F.hour("ts").cast("long"))
    return ev.groupBy("event_type", "hour").agg(F.round(F.max_by("value", F.struct("ts", "event_id")), 6).alias("last_value"))


@query("""with r as (select user_id, value, row_number() over (partition by user_id order by ts, event_id) as a, row_number() over (partition by user_id order by ts desc, event_id desc) as z from events)
  select user_id, round(avg(value) filter (where z <= 5) - avg(value) filter (where a <= 5), 6) as drift, round(max(value) - min(value), 6) as spread from r group by user_id""")
def drift(spark, sf_dir):
    a = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    z = F.row_number().over(Window.partitionBy("user_id").orderBy(F.col("ts").desc(), F.col("event_id").desc()))
    ev = load(spark, sf_dir, "events").select("user_id", "value", a.alias("a"), z.alias("z"))
    late, early = F.avg(F.when(F.col("z") <= 5, F.col("value"))), F.avg(F.when(F.col("a") <= 5, F.col("value")))
    return ev.groupBy("user_id").agg(F.round(late - early, 6).alias("drift"), F.round(F.max("value") - F.min("value"), 6).alias("spread"))


@query("""select event_type, count(*)::bigint as n, round(quantile_cont(value, 0.5), 6) as p50, round(quantile_cont(value, 0.95), 6) as p95, round(max(value), 6) as top,
  quantile_cont(value, 0.5) >= 40 as enough, max(value) <= 1000 as bounded, quantile_cont(value, 0.5) >= 40 and max(value) <= 1000 as overall from events group by event_type""")
def pass_fail(spark, sf_dir):
    ev = load(spark, sf_dir, "events")
    top = ev.groupBy("event_type").agg(F.count("*").alias("n"), F.max("value").alias("top"))
    q = quantiles(ev, F.col("value"), [0.5, 0.95], ["event_type"]).select("event_type", F.col("q")[0].alias("p50"), F.col("q")[1].alias("p95"))
    out = top.join(q, "event_type")
    enough, bounded = F.col("p50") >= 40, F.col("top") <= 1000
    return out.select("event_type", "n", r6("p50"), r6("p95"), r6("top"), enough.alias("enough"), bounded.alias("bounded"), (enough & bounded).alias("overall"))


@query("""select event_type, coalesce(json_extract_string(props, '$.k'), '') as k, count(*)::bigint as n from events group by all""")
def log_tally(spark, sf_dir):
    ev = load(spark, sf_dir, "events").select("event_type", F.coalesce(F.get_json_object("props", "$.k"), F.lit("")).alias("k"))
    return ev.groupBy("event_type", "k").agg(F.count("*").alias("n"))


# Histories ------------------------------------------------------------------

@query("""select o_custkey, o_orderkey, row_number() over w as reign, coalesce(lag(o_orderkey) over w, -1) as previous from orders where o_orderstatus = 'F' window w as (partition by o_custkey order by o_orderdate, o_orderkey)""")
def reign_history(spark, sf_dir):
    out = records.reigns(load(spark, sf_dir, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"], F.col("o_orderstatus") == "F", "o_orderkey")
    return out.select("o_custkey", "o_orderkey", F.col("reign").cast("long").alias("reign"), F.coalesce("previous", F.lit(-1)).cast("long").alias("previous"))


@query("""with r as (select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as z from orders qualify z <= 16),
  w as (select *, exp(0.25 * -(z - 1)) as w from r) select o_custkey, o_orderkey, round(w / sum(w) over (partition by o_custkey), 6) as weight from w""")
def holder_weights(spark, sf_dir):
    z = F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.col("o_orderdate").desc(), F.col("o_orderkey").desc()))
    rows = load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", z.alias("z")).where("z <= 16").withColumn("w", F.exp(-0.25 * (F.col("z") - 1)))
    return rows.select("o_custkey", "o_orderkey", F.round(F.col("w") / F.sum("w").over(Window.partitionBy("o_custkey")), 6).alias("weight"))


@query("""with l as (select n_nationkey as nation, c_custkey as holder, max(o_orderdate) as last from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey where c_acctbal > 0 group by all),
  r as (select *, row_number() over (partition by nation order by last desc, holder) as z from l qualify z <= 5) select nation, holder, round(1.0 / count(*) over (partition by nation), 6) as share from r""")
def rolling_payout(spark, sf_dir):
    who = load(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("holder"), F.col("c_nationkey").alias("nation"))
    last = load(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("holder")).agg(F.max("o_orderdate").alias("last")).join(who, "holder")
    z = F.row_number().over(Window.partitionBy("nation").orderBy(F.col("last").desc(), "holder"))
    top = last.withColumn("z", z).where("z <= 5")
    return top.select("nation", "holder", F.round(1.0 / F.count("*").over(Window.partitionBy("nation")), 6).alias("share"))


@query("""with s as (select o_custkey, list(o_totalprice order by o_orderdate, o_orderkey) as xs from orders group by o_custkey)
  select o_custkey, round(0.001 * list_reduce(xs, lambda a, x: a + (x - a) * 2.0 / 11.0), 6) as floor_ from s""")
def ema_floor(spark, sf_dir):
    xs = F.transform(F.sort_array(F.collect_list(F.struct("o_orderdate", "o_orderkey", "o_totalprice"))), lambda r: r["o_totalprice"])
    per = load(spark, sf_dir, "orders").groupBy("o_custkey").agg(xs.alias("xs"))
    ema = F.aggregate(F.slice("xs", 2, 1_000_000_000), F.element_at("xs", 1), lambda a, x: a + (x - a) * 2.0 / 11.0)
    return per.select("o_custkey", F.round(0.001 * ema, 6).alias("floor_"))


@query("""with s as (select l_suppkey, l_quantity as size, l_returnflag = 'A' as safe, sum(l_quantity) over (partition by l_suppkey) as total,
  coalesce(sum(case when l_returnflag <> 'A' then l_quantity else 0 end) over (partition by l_suppkey order by l_shipdate, l_orderkey, l_linenumber rows between unbounded preceding and 1 preceding), 0) as freed from lineitem),
  e as (select *, not safe and total >= 5000 and total - freed >= 3500 as gone from s)
  select l_suppkey, count_if(gone)::bigint as evicted, round(coalesce(sum(size) filter (where not gone), 0), 6) as left_ from e group by l_suppkey""")
def cache_evictions(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    f = records.evictions(li, "l_suppkey", "l_quantity", ["l_shipdate", "l_orderkey", "l_linenumber"], F.lit(5000.0), 0.7, F.col("l_returnflag") == "A")
    return f.groupBy("l_suppkey").agg(F.count_if("evict").alias("evicted"), F.round(F.coalesce(F.sum(F.when(~F.col("evict"), F.col("l_quantity"))), F.lit(0.0)), 6).alias("left_"))


@query("""select o_orderkey, o_custkey from orders qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) > 5""")
def keep_newest(spark, sf_dir):
    z = F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.col("o_orderdate").desc(), F.col("o_orderkey").desc()))
    return load(spark, sf_dir, "orders").withColumn("z", z).where("z > 5").select("o_orderkey", "o_custkey")


@query("""with now as (select max(o_orderdate) as t from orders), r as (select o_orderkey, o_custkey, o_orderdate, o_orderstatus <> 'O' as done from orders),
  aged as (select r.*, done and o_orderdate < t - interval 1500 day as old from r, now),
  n as (select o_custkey, count(*) filter (where not old) - 6 as excess from aged group by o_custkey),
  f as (select o_orderkey, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as k, o_custkey from aged where done and not old)
  select o_orderkey, o_custkey from aged where not old and o_orderkey not in (select o_orderkey from f join n using (o_custkey) where k <= excess)""")
def prune_records(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    now = o.agg(F.max("o_orderdate").alias("t"))
    dated = o.crossJoin(F.broadcast(now))  # one row
    out = records.pruned(dated, "o_custkey", F.col("o_orderstatus") != "O", "o_orderdate", "o_orderkey", F.expr("t - interval 1500 days"), 6)
    return out.where(~F.col("drop")).select("o_orderkey", "o_custkey")


@query("""select l_partkey, arg_max(l_suppkey, (l_quantity, l_extendedprice, -l_discount, -l_orderkey, -l_linenumber)) as best, count(*)::bigint as n from lineitem group by l_partkey""")
def best_candidate(spark, sf_dir):
    key = F.struct("l_quantity", "l_extendedprice", -F.col("l_discount"), -F.col("l_orderkey"), -F.col("l_linenumber"))
    return load(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.max_by("l_suppkey", key).alias("best"), F.count("*").alias("n"))


@query("""with s as (select l_orderkey, 'r' || l_quantity::int || ':a' || (2 * l_quantity::int) || ':lr' || l_linenumber || 'e-' || (3 + l_linenumber % 3) as spec, l_extendedprice as lcb, l_discount as mu, l_linenumber as ln from lineitem),
  p as (select *, regexp_extract(spec, 'r(\\d+):', 1)::bigint as r, regexp_extract(spec, ':a(\\d+)', 1)::bigint as a, regexp_extract(spec, ':lr([0-9.e-]+)', 1) as lr from s)
  select l_orderkey, r, a, lr, row_number() over (partition by l_orderkey order by lcb desc, mu desc, ln) as place from p""".replace("\\\\", "\\"))
def sweep_rank(spark, sf_dir):
    q, n = F.col("l_quantity").cast("int"), F.col("l_linenumber")
    spec = F.concat(F.lit("r"), q, F.lit(":a"), 2 * q, F.lit(":lr"), n, F.lit("e-"), 3 + n % 3)
    rows = load(spark, sf_dir, "lineitem").select("l_orderkey", spec.alias("spec"), "l_extendedprice", "l_discount", "l_linenumber")
    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(F.col("l_extendedprice").desc(), F.col("l_discount").desc(), "l_linenumber"))
    return rows.select(
        "l_orderkey", F.regexp_extract("spec", r"r(\d+):", 1).cast("long").alias("r"), F.regexp_extract("spec", r":a(\d+)", 1).cast("long").alias("a"),
        F.regexp_extract("spec", r":lr([0-9.e-]+)", 1).alias("lr"), place.cast("long").alias("place"),
    )


#: What the error events are said to have meant, by turns; the last one comes with a cancelled task.
MESSAGES = ("prefetch exceeded budget", "eval server error: oom", "Connection reset by peer", "HTTP 503", "request timed out", "bad config", "")


@query("""with e as (select case event_id % 7 when 0 then 'prefetch exceeded budget' when 1 then 'eval server error: oom' when 2 then 'Connection reset by peer' when 3 then 'HTTP 503' when 4 then 'request timed out'
    when 5 then 'bad config' else '' end as msg, event_id % 7 = 6 as stopped from events where event_type = 'error'),
  m(marker, ord) as (values ('internal error', 1), ('stream idle', 2), ('watchdog timeout', 3), ('timed out', 4), ('timeout', 5), ('server disconnected', 6), ('connection reset', 7), ('503', 17), ('502', 18), ('504', 19)),
  d as (select distinct msg, stopped from e), f as (select msg, arg_min(marker, ord) as marker from d join m on contains(lower(msg), marker) group by msg),
  c as (select d.msg, d.stopped, case when d.stopped then 'validator_cancelled' when lower(d.msg) like '%prefetch%' and lower(d.msg) like '%exceeded%' then 'prefetch_exhausted'
    when lower(d.msg) like 'eval server error%' then 'eval_server_reported' else coalesce(f.marker, '') end as marker from d left join f using (msg))
  select c.msg, c.marker, c.marker not in ('', 'prefetch_exhausted', 'eval_server_reported') as transient, count(*)::bigint as n from e join c using (msg, stopped) group by all""")
def classify_errors(spark, sf_dir):
    kind = (F.col("event_id") % 7 + 1).cast("int")
    msg = F.element_at(F.array(*(F.lit(m) for m in MESSAGES)), kind)
    rows = load(spark, sf_dir, "events").where("event_type = 'error'").select(msg.alias("msg"), (kind == 7).alias("stopped"))
    transient, marker = records.classify_error(F.col("msg"), F.col("stopped"))
    return rows.select("msg", marker.alias("marker"), transient.alias("transient")).groupBy("msg", "marker", "transient").agg(F.count("*").alias("n"))


@query("""with c as (select l_orderkey, l_linenumber as ord, 'k' || l_linenumber as name, l_returnflag as v from lineitem where l_linenumber <> 3),
  k as (select l_orderkey, l_linenumber as ord, 'k' || l_linenumber as name, case when l_linenumber % 2 = 0 then l_linestatus else l_returnflag end as v from lineitem where l_linenumber <> 4),
  j as (select coalesce(c.l_orderkey, k.l_orderkey) as l_orderkey, coalesce(c.name, k.name) as name, c.v as a, k.v as b, c.ord is not null as ca, k.ord is not null as cb from c full join k on c.l_orderkey = k.l_orderkey and c.name = k.name)
  select l_orderkey, min(name) as first_mismatch, count(*)::bigint as mismatches from j where a is distinct from b or ca <> cb group by l_orderkey""")
def config_lock(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem").withColumn("name", F.concat(F.lit("k"), "l_linenumber"))
    king = li.where("l_linenumber <> 3").select("l_orderkey", "name", F.col("l_returnflag").alias("v"))
    other = li.where("l_linenumber <> 4").select("l_orderkey", "name", F.when(F.col("l_linenumber") % 2 == 0, F.col("l_linestatus")).otherwise(F.col("l_returnflag")).alias("v"))
    return records.lock_violations(king, other, "l_orderkey", "name", "v", F.col("name"))


@query("""with recursive e as (select o_orderkey as node, (o_orderkey * 7 + 3) // 11 as parent from orders), s as (select o_orderkey as node from orders where o_orderpriority = '1-URGENT'),
  w as (select node as start, node, 0 as depth, [node] as path from s union all select w.start, e.parent, w.depth + 1, list_append(w.path, e.parent) from w join e on e.node = w.node where w.depth < 6 and not list_contains(w.path, e.parent))
  select start, max(depth)::bigint as depth, arg_max(node, depth) as last from w group by start""")
def ancestor_walk(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("node"), "o_orderpriority")
    edges = o.select("node", F.expr("(node * 7 + 3) div 11").alias("parent"))
    out = records.ancestors(spark, edges, o.where("o_orderpriority = '1-URGENT'").select("node"), 6)
    return out.groupBy("start").agg(F.max("depth").cast("long").alias("depth"), F.max_by("node", "depth").alias("last"))


@query("""with u as (select o_custkey, max(o_orderkey) as uid from orders where o_orderstatus = 'O' group by 1)
  select c_custkey, coalesce(uid, -1) as uid, n_name as nation, r_name as region, coalesce(n, 0)::bigint as history from customer left join u on o_custkey = c_custkey
  join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey left join (select o_custkey as k, count(*) as n from orders group by 1) on k = c_custkey""")
def dimension_refresh(spark, sf_dir):
    orders = load(spark, sf_dir, "orders")
    uid = orders.groupBy("o_custkey").agg(F.max(F.when(F.col("o_orderstatus") == "O", F.col("o_orderkey"))).alias("uid"), F.count("*").alias("n"))
    place = load(spark, sf_dir, "nation").join(load(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    out = load(spark, sf_dir, "customer").join(uid, F.col("c_custkey") == F.col("o_custkey"), "left").join(place, F.col("c_nationkey") == F.col("n_nationkey"))
    return out.select("c_custkey", F.coalesce("uid", F.lit(-1)).alias("uid"), F.col("n_name").alias("nation"), F.col("r_name").alias("region"), F.coalesce("n", F.lit(0)).alias("history"))


@query("""select kind, key, round(coalesce(value, 0.0), 6) as value, reason from (select 'verdict' as kind, o_orderkey as key, o_totalprice as value, '' as reason from orders where o_orderstatus = 'F'
  union all select 'failure', event_id, null, event_type from events where event_type = 'error')""")
def union_history(spark, sf_dir):
    v = load(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.lit("verdict").alias("kind"), F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("value"))
    f = load(spark, sf_dir, "events").where("event_type = 'error'").select(F.lit("failure").alias("kind"), F.col("event_id").alias("key"), F.col("event_type").alias("reason"))
    both = v.unionByName(f, allowMissingColumns=True)
    return both.select("kind", "key", F.round(F.coalesce("value", F.lit(0.0)), 6).alias("value"), F.coalesce("reason", F.lit("")).alias("reason"))


@query("""select lower(p_brand) as brand, arg_min(p_partkey, p_partkey) as first_key, count(*)::bigint as n from part group by 1""")
def ordered_distinct(spark, sf_dir):
    return load(spark, sf_dir, "part").groupBy(F.lower("p_brand").alias("brand")).agg(F.min("p_partkey").alias("first_key"), F.count("*").alias("n"))


@query("""with x as (select o_orderkey, o_totalprice as size from orders), y as (select l_orderkey, sum(l_extendedprice) as size from lineitem where l_linenumber > 1 group by 1)
  select status, count(*)::bigint as n from (select case when y.l_orderkey is null then 'missing' when abs(y.size - x.size) > 1000 then 'wrong_size' else 'ok' end as status from x left join y on l_orderkey = o_orderkey) group by status""")
def size_verify(spark, sf_dir):
    there = load(spark, sf_dir, "lineitem").where("l_linenumber > 1").groupBy("l_orderkey").agg(F.sum("l_extendedprice").alias("got"))
    j = load(spark, sf_dir, "orders").join(there, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    status = F.when(F.col("l_orderkey").isNull(), "missing").when(F.abs(F.col("got") - F.col("o_totalprice")) > 1000, "wrong_size").otherwise("ok")
    return j.groupBy(status.alias("status")).agg(F.count("*").alias("n"))


@query("""with d as (select source, length(text) as size, doc_id from documents), m as (select source, list_sort(list(size))[(count(*) // 2)::int + 1] as median from d group by source)
  select doc_id, size < 0.25 * median as truncated from d join m using (source)""")
def truncated_shards(spark, sf_dir):
    d = load(spark, sf_dir, "documents").select("doc_id", "source", F.length("text").alias("size"))
    return d.join(records.upper_medians(d, "source", "size"), "source").select("doc_id", (F.col("size") < 0.25 * F.col("median")).alias("truncated"))


@query("""select host, count(*)::bigint as files, sum(length(html))::bigint as size, max(page_id)::bigint as newest from (select *, regexp_extract(url, '://([^/?#]+)', 1) as host from pages) group by host""")
def host_listing(spark, sf_dir):
    p = load(spark, sf_dir, "pages").withColumn("host", F.regexp_extract("url", r"://([^/?#]+)", 1))
    return p.groupBy("host").agg(F.count("*").alias("files"), F.sum(F.length("html")).alias("size"), F.max("page_id").alias("newest"))


# Tensors --------------------------------------------------------------------

@query("""with x as (select vec_id, label, unnest(embedding)::double as g from embeddings)
  select coalesce(label, -1)::int as grp, round(sqrt(sum(g * g)), 4) as norm, count(*)::bigint as numel from x group by rollup (label)""")
def group_norms(spark, sf_dir):
    x = load(spark, sf_dir, "embeddings").select("label", F.aggregate("embedding", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double")).alias("sq"), F.size("embedding").alias("n"))
    out = x.rollup("label").agg(F.sqrt(F.sum("sq")).alias("norm"), F.sum("n").alias("numel"))
    return out.select(F.coalesce("label", F.lit(-1)).alias("grp"), F.round("norm", 4).alias("norm"), "numel")


@query("""with x as (select label, round(unnest(embedding)::double, 1) as v from embeddings), c as (select label, v, count(*) as n from x group by all)
  select label, round(max(n) / sum(n), 6) as share from c group by label""")
def mode_share(spark, sf_dir):
    c = load(spark, sf_dir, "embeddings").select("label", F.explode("embedding").alias("v")).groupBy("label", F.round(F.col("v").cast("double"), 1).alias("v")).agg(F.count("*").alias("n"))
    return c.groupBy("label").agg(F.round(F.max("n") / F.sum("n"), 6).alias("share"))


@query("""with x as (select label, unnest(embedding)::double as v, generate_subscripts(embedding, 1) as pos from embeddings) select label, pos::int as pos, round(avg(v), 5) as mean from x group by label, pos""")
def adapter_mean(spark, sf_dir):
    x = load(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("pos", "v"))
    return x.groupBy("label", (F.col("pos") + 1).alias("pos")).agg(F.round(F.avg(F.col("v").cast("double")), 5).alias("mean"))


@query("""with x as (select label, vec_id, sqrt(list_sum(list_transform(embedding, lambda g: g::double * g::double))) as norm from embeddings), m as (select quantile_cont(norm, 0.95) as cap from x)
  select label, round(max(norm), 4) as worst, case when count_if(not isfinite(norm)) > 0 then 'not_finite' when max(norm) > any_value(cap) * 1.05 then 'norm_exceeded' else 'ok' end as gate from x, m group by label""")
def probe_gate(spark, sf_dir):
    x = load(spark, sf_dir, "embeddings").select("label", F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))).alias("norm"))
    cap = quantiles(x, F.col("norm"), [0.95]).select(F.col("q")[0].alias("cap"))
    bad = F.count_if(F.isnan("norm") | (F.abs("norm") == float("inf")))
    out = x.crossJoin(F.broadcast(cap)).groupBy("label").agg(F.max("norm").alias("w"), bad.alias("bad"), F.any_value("cap").alias("cap"))  # one row
    gate = F.when(F.col("bad") > 0, "not_finite").when(F.col("w") > F.col("cap") * 1.05, "norm_exceeded").otherwise("ok")
    return out.select("label", F.round("w", 4).alias("worst"), gate.alias("gate"))
