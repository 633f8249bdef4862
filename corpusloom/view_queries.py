"""Queries of views and of adapters, each beside DuckDB SQL with the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from .operators import evaluation, sampling, views
from .operators.scoring import UnigramScorer, adapted_counts
from .operators.token_tables import word_counts_by
from .queries import TOK, bucketed, documents, r6
from .queries import BUCKETED as BUCKETED_SQL
from .tables import load, written

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLE[f.__name__] = f, sql
        return f

    return add


@query("""select o_custkey, o_orderkey, substr(md5(o_orderkey::varchar), 1, 16) || '...' as hotkey, o_orderstatus as verdict, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc)::bigint as place from orders qualify place <= 5""")
def recent_verdicts(spark, sf_dir):
    """The five latest verdicts of each key, with keys made short."""
    rows = load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", F.col("o_orderstatus").alias("verdict"), views.short_key(F.md5(F.col("o_orderkey").cast("string").cast("binary"))).alias("hotkey"))
    out = views.recent(rows, "o_custkey", [F.desc("o_orderdate"), F.desc("o_orderkey")])
    return out.select("o_custkey", "o_orderkey", "hotkey", "verdict", F.col("place").cast("long").alias("place"))


@query("""with p as (select round(avg(p_retailprice), 2) / 1000 as price from part), e as (select s_suppkey, case when s_suppkey % 7 <> 0 then s_acctbal / 1000 end as b from supplier)
  select s_suppkey, round(coalesce(b, 0) * 300, 6) as per_hour, round(coalesce(b, 0) * 300 * price, 8) as chain_per_hour, round(coalesce(b, 0) * 300 * price * 250, 8) as money_per_hour from e, p""")
def payout_projection(spark, sf_dir):
    """What each key earns an hour, at the market's price."""
    price = load(spark, sf_dir, "part").agg((F.round(F.avg("p_retailprice"), 2) / 1000).alias("price"))
    rows = load(spark, sf_dir, "supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 7 != 0, F.col("s_acctbal") / 1000).alias("b")).crossJoin(F.broadcast(price))  # one row
    return views.payouts(rows, "b", F.col("price"), F.lit(250)).drop("b", "price")


@query("""with s as (select l_orderkey, 'task_' || l_linenumber as task, case when l_returnflag <> 'A' then l_discount * 10 end as score from lineitem)
  select l_orderkey, count(*)::bigint as n_tasks, round(avg(score), 6) as mean, string_agg(task || '=' || printf('%.4f', score), ' ' order by task || '=' || printf('%.4f', score)) as scores from s where score is not null group by l_orderkey""")
def bench_rows(spark, sf_dir):
    """One row for each run of a benchmark, with its scores and their mean."""
    score = F.when(F.col("l_returnflag") != "A", F.col("l_discount") * 10)
    rows = load(spark, sf_dir, "lineitem").select("l_orderkey", F.concat(F.lit("task_"), "l_linenumber").alias("task"), score.alias("score"))
    return views.bench_row(rows, "l_orderkey", "task", "score")


@query(rf"""with {BUCKETED_SQL}, c as (select source, bucket, count(*) as n from bucketed where source is not null group by all)
  select source, '# Run ' || source || chr(10) || chr(10) || '## Curriculum' || chr(10) || string_agg('- ' || bucket || ': ' || n, chr(10) order by n desc, bucket) as report from c group by source""")
def run_reports(spark, sf_dir):
    """The bucket counts of each source as a Markdown report."""
    counts = bucketed(spark, sf_dir).where("source is not null").groupBy("source", "bucket").agg(F.count("*").alias("n"))
    return views.run_report(counts, "source", "bucket", "n")


@query("""with c as (select user_id, count_if(event_type = 'purchase') as done, count(*) as total, count_if(event_type = 'error') as failed from events group by user_id)
  select user_id, done || '/' || total || ' (' || round(100.0 * done / total)::int || '%)' || case when failed > 0 then ', failed ' || failed else '' end as status from c""")
def status_texts(spark, sf_dir):
    """How far each key's work has come, as a line of text."""
    n = load(spark, sf_dir, "events").groupBy("user_id").agg(F.count_if(F.col("event_type") == "purchase").alias("done"), F.count("*").alias("total"), F.count_if(F.col("event_type") == "error").alias("failed"))
    return n.select("user_id", views.status_text(F.col("done"), F.col("total"), F.col("failed")).alias("status"))


@query(rf"""with {TOK}, full_ as (select * from tok where len(ids) > 0), hold as (select *, row_number() over (order by md5('ad:' || doc_id), doc_id) - 1 as pos from full_ qualify pos < 120), rest as (select * from full_ where doc_id not in (select doc_id from hold)),
  base as (select t, count(*)::double as c from (select unnest(ids) as t from rest where lang = 'en') group by t), ad as (select t, count(*)::double as c from (select unnest(ids) as t from rest where lang = 'de') group by t),
  both_ as (select coalesce(base.t, ad.t) as t, coalesce(base.c, 0) + 2 * coalesce(ad.c, 0) as c from base full join ad on base.t = ad.t), bt as (select sum(c) as total, count(*) as types from base), at_ as (select sum(c) as total, count(*) as types from both_),
  hk as (select pos, t, count(*) as k from (select pos, unnest(ids) as t from hold) group by all),
  l as (select pos, sum(k * -ln((coalesce(base.c, 0) + 1) / (bt.total + bt.types))) / sum(k) as king, sum(k * -ln((coalesce(both_.c, 0) + 1) / (at_.total + at_.types))) / sum(k) as chall from hk left join base on base.t = hk.t left join both_ on both_.t = hk.t, bt, at_ group by pos)
  select pos::bigint as pos, round(king, 6) as king_loss, round(chall, 6) as challenger_loss, round(king - chall, 6) as diff from l""")
def adapter_evaluation(spark, sf_dir):
    """A model against itself with an adapter (counts of other texts, doubled) on one holdout; the base is scored once and shared."""
    docs = documents(spark, sf_dir, "lang")
    hold = written(sampling.take(docs, 120, "ad", "doc_id").withColumn("pos", F.col("rk").cast("long") - 1))
    rest = docs.join(hold.select("doc_id"), "doc_id", "left_anti")
    every = written(word_counts_by(rest.where("lang in ('en', 'de')"), "lang", "ids"))
    counts = lambda lang: every.where(F.col("lang") == lang).select("tok", "c")
    base = counts("en")
    king = UnigramScorer.of_counts(base).score(hold, "pos", "ids")
    challenger = UnigramScorer.of_counts(adapted_counts(base, counts("de"), 2.0)).score(hold, "pos", "ids")
    out = evaluation.paired_differences(king, challenger, "pos")
    return out.select("pos", r6("king_loss"), r6("challenger_loss"), r6("diff"))
