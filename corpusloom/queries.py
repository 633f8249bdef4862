"""Registered queries over the tables, each with DuckDB SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import text as T
from .functions.hashing import short_sha
from .functions.tokens import WORD, ngram_repeat_ratio, repeat_ratio, tokens, unique_ratio
from .operators import curriculum, evaluation, packing, sampling, screening
from .operators.scoring import BigramScorer, UnigramScorer
from .operators.token_tables import word_counts_by
from .tables import kept, load, spread, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

LENGTH, SHARD_ROWS, TRAIN_SHARDS = 128, 16, 8
END = "<end>"


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLE[f.__name__] = f, sql
        return f

    return add


def r6(name: str):
    return F.round(F.col(name).cast("double"), 6).alias(name)


def documents(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """Documents with tokens: doc_id, source, ids and what else is asked for."""
    docs = spread(load(spark, sf_dir, "documents").select("doc_id", "source", "text", *extra)).where(F.col("text").rlike(WORD))
    return docs.select("doc_id", "source", *extra, tokens(F.col("text")).alias("ids"))


def texts(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """As ``documents``, with the text itself for ids: scorers split it in their tasks, and no lists of words are made on the way."""
    docs = spread(load(spark, sf_dir, "documents").select("doc_id", "source", "text", *extra)).where(F.col("text").rlike(WORD))
    return docs.select("doc_id", "source", *extra, F.col("text").alias("ids"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents: a narrow table that is made once for the files as they are and read for cuts, buckets and draws."""
    return kept(spark, "scores", f"{sf_dir}/documents.parquet", lambda: curriculum.scored_rows(texts(spark, sf_dir), "doc_id"))


def bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curriculum.assign_buckets(scored(spark, sf_dir))


TOK = r"""tok as (select doc_id, source, lang, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ids from documents)"""
SCORED = TOK + r""",
p as (select doc_id, unnest(ids) as t, generate_subscripts(ids, 1) as i from tok),
cnt as (select t, count(*) as c from p group by t), tot as (select sum(c) as total, count(*) as types from cnt),
loss as (select doc_id, sum(k * -ln((c + 1) / (total + types))) / sum(k) as loss, sum(k)::bigint as n_pos
  from (select doc_id, t, count(*) as k from p group by all) join cnt using (t), tot group by doc_id),
lagged as (select doc_id, i, t, lag(t) over w as a, lag(t, 2) over w as b, lag(t, 3) over w as c3 from p window w as (partition by doc_id order by i)),
rep as (select doc_id, count(distinct t) / count(*) as unique_r,
  case when count(*) > 1 then count(*) filter (where t = a) / (count(*) - 1) else 0.0 end as rep_r,
  case when count(*) > 3 then 1 - count(distinct concat_ws(chr(10), c3, b, a, t)) filter (where i > 3) / (count(*) - 3) else 0.0 end as rep_ng4
  from lagged group by doc_id),
scored as (select tok.doc_id, source, loss, unique_r, rep_r, rep_ng4 from tok join loss using (doc_id) join rep using (doc_id))"""
CUTS = SCORED + ", cuts as (select quantile_cont(loss, 0.5) as p50, quantile_cont(loss, 0.85) as p85 from scored)"
BUCKETED = CUTS + r""",
bucketed as (select scored.*, case when rep_r > 0.2 or rep_ng4 > 0.5 or unique_r < 0.05 then 'suspicious'
  when loss >= p85 then 'hard' when loss >= 0.8 * p50 then 'general' else 'easy' end as bucket from scored, cuts)"""


# Text quality ---------------------------------------------------------------

STRIP = r"regexp_replace(coalesce(text, ''), '^[\x09-\x0D\x20]+|[\x09-\x0D\x20]+$', '', 'g')"
MEASURES = rf"""m as (select doc_id, source, coalesce(text, '') as raw, {STRIP} as s from documents),
q as (select doc_id, source, raw, s, length(s) as n,
  length(regexp_replace(s, '[^\p{{L}}]', '', 'g')) / greatest(1, length(s)) as alpha,
  list_sum(list_transform(regexp_extract_all(s, '(?i)https?://[^\s]{{15,}}|www\.[^\s]{{10,}}'), lambda x: length(x))) as url_chars,
  len(regexp_extract_all(s, '{T.NAVIGATION}')) as nav from m),
ch as (select doc_id, unnest(string_split(s, '')) as c, generate_subscripts(string_split(s, ''), 1) as i from q),
adj as (select doc_id, count(*) filter (where c = l) / greatest(1, count(*) - 1) as repeats from
  (select doc_id, c, lag(c) over (partition by doc_id order by i) as l from ch) group by doc_id)"""


@query(rf"""with {MEASURES} select q.doc_id, round(alpha, 6) as alpha_ratio, round(coalesce(repeats, 0.0), 6) as repeat_ratio,
  round(coalesce(url_chars, 0) / greatest(1, n), 6) as url_ratio, nav::int as nav_hits from q left join adj using (doc_id)""")
def text_stats(spark, sf_dir):
    s = spread(load(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", T.stripped(F.coalesce("text", F.lit(""))).alias("s"))
    s = s.select(
        "doc_id", T.alpha_ratio(F.col("s")).alias("alpha_ratio"), T.adjacent_repeat_ratio(F.col("s")).alias("repeat_ratio"),
        T.url_ratio(F.col("s")).alias("url_ratio"), T.navigation_hits(F.col("s")).alias("nav_hits"),
    )
    return s.select("doc_id", r6("alpha_ratio"), r6("repeat_ratio"), r6("url_ratio"), "nav_hits")


RULES = T.QualityRules(least_alpha=0.56, most_repeat=0.20)


@query(rf"""with {MEASURES}, r as (select q.source, case when raw = '' then 'empty' when n < 200 then 'too_short' when alpha < 0.56 then 'low_alpha_ratio'
  when repeats > 0.20 then 'high_repeat_ratio' when coalesce(url_chars, 0) / greatest(1, n) > 0.10 then 'high_url_density'
  when nav > 5 then 'navigation_boilerplate' else 'accepted' end as reason from q left join adj using (doc_id))
  select source, reason, count(*)::bigint as n, round(count(*) / sum(count(*)) over (partition by source), 6) as share from r group by source, reason""")
def quality_reject_counts(spark, sf_dir):
    docs = spread(load(spark, sf_dir, "documents").select("source", "text")).select("source", F.coalesce(T.reject_reason(F.col("text"), RULES), F.lit("accepted")).alias("reason"))
    n = docs.groupBy("source", "reason").agg(F.count("*").alias("n"))
    return n.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("source")), 6))


@query(rf"with {SCORED} select doc_id, round(unique_r, 6) as unique_r, round(rep_r, 6) as rep_r, round(rep_ng4, 6) as rep_ng4 from rep")
def token_repetition(spark, sf_dir):
    ids = F.col("ids")
    rows = documents(spark, sf_dir).select(
        "doc_id", unique_ratio(ids).alias("unique_r"), repeat_ratio(ids).alias("rep_r"), ngram_repeat_ratio(ids).alias("rep_ng4")
    )
    return rows.select("doc_id", r6("unique_r"), r6("rep_r"), r6("rep_ng4"))


# Packing --------------------------------------------------------------------

def packed(spark, sf_dir, stream=[]):
    docs = documents(spark, sf_dir).withColumn("ids", F.concat("ids", F.array(F.lit(END))))
    return packing.pack_windows(docs, LENGTH, "doc_id", "ids", stream)


PACK = r"""with {tok}, d as (select doc_id, source, list_append(ids, '<end>') as ids from tok where len(ids) > 0),
t as (select doc_id, source, unnest(ids) as t, generate_subscripts(ids, 1) as i from d),
pos as (select {by} t, row_number() over ({part} order by doc_id, i) - 1 as pos from t),
win as (select {by} pos // 128 as window_id, string_agg(t, ' ' order by pos) as body, count(*) as n from pos group by all having count(*) = 128)"""


@query(PACK.format(tok=TOK, by="", part="") + " select window_id::bigint as window_id, md5(body) as digest from win")
def packed_windows(spark, sf_dir):
    return packed(spark, sf_dir).select("window_id", F.md5(F.array_join("ids", " ").cast("binary")).alias("digest"))


@query(PACK.format(tok=TOK, by="source,", part="partition by source") + " select source, window_id::bigint as window_id, md5(body) as digest from win")
def packed_windows_per_source(spark, sf_dir):
    return packed(spark, sf_dir, ["source"]).select("source", "window_id", F.md5(F.array_join("ids", " ").cast("binary")).alias("digest"))


@query(PACK.format(tok=TOK, by="", part="") + r""" select (window_id // 16)::bigint as shard, case when window_id // 16 < 8 then 'train' else 'eval' end as split,
  count(*)::bigint as rows, sum(n)::bigint as n_tokens, (4 * sum(n))::bigint as size_bytes, sha256(string_agg(md5(body), chr(10) order by window_id)) as sha256
  from win group by 1, 2""")
def shard_manifest(spark, sf_dir):
    sharded = packing.assign_shards(packed(spark, sf_dir), SHARD_ROWS, TRAIN_SHARDS)
    return packing.manifest(sharded, F.md5(F.array_join("ids", " ").cast("binary")))


@query(r"""with s as (select doc_id, n_chars as size, sum(n_chars) over (order by doc_id) - n_chars as off from documents where n_chars > 0),
  x as (select *, unnest(range((off // 65536)::bigint, ((off + size - 1) // 65536)::bigint + 1)) as shard from s)
  select doc_id, shard::bigint as shard, greatest(shard * 65536 - off, 0)::bigint as "begin", least((shard + 1) * 65536 - off, size)::bigint as "end" from x""")
def reshard_offsets(spark, sf_dir):
    return packing.reshard(load(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id", "n_chars", 65536)


@query(r"""with d as (select distinct l_suppkey, l_orderkey from lineitem),
  g as (select *, case when l_orderkey - lag(l_orderkey) over (partition by l_suppkey order by l_orderkey) > 64 then 1 else 0 end as new from d),
  i as (select *, sum(new) over (partition by l_suppkey order by l_orderkey) as island from g)
  select l_suppkey, min(l_orderkey)::bigint as low, max(l_orderkey)::bigint as high, count(*)::bigint as n from i group by l_suppkey, island""")
def range_coalesce(spark, sf_dir):
    return packing.coalesce_ranges(load(spark, sf_dir, "lineitem"), "l_suppkey", "l_orderkey", 64)


@query(r"""select page_id, host, section, row_number() over (order by prio, section, host, page_id)::int as place from (
  select page_id, regexp_extract(url, '://([^/?#]+)', 1) as host, regexp_extract(url, '://[^/?#]+/([^/?#]+)', 1) as section,
  coalesce(list_position(['en', 'de'], regexp_extract(url, '://[^/?#]+/([^/?#]+)', 1)), 99) as prio from pages) order by place limit 200""")
def config_priority(spark, sf_dir):
    section = F.regexp_extract("url", r"://[^/?#]+/([^/?#]+)", 1)
    rows = load(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", r"://([^/?#]+)", 1).alias("host"), section.alias("section"))
    prio = F.array_position(F.array(F.lit("en"), F.lit("de")), F.col("section"))
    rows = rows.withColumn("prio", F.when(prio == 0, 99).otherwise(prio))
    keys = ["prio", "section", "host", "page_id"]
    top = rows.orderBy(*keys).limit(200)  # the first files of a listing
    return top.withColumn("place", F.row_number().over(Window.orderBy(*keys))).drop("prio")


# Scores and curricula -------------------------------------------------------

@query(rf"with {SCORED} select doc_id, round(loss, 6) as loss, n_pos from loss")
def unigram_loss(spark, sf_dir):
    docs = texts(spark, sf_dir)
    return UnigramScorer(docs, "ids").score(docs, "doc_id", "ids").select("doc_id", r6("loss"), "n_pos")


@query(rf"""with {TOK}, p as (select doc_id, unnest(ids) as t, generate_subscripts(ids, 1) as i from tok),
  g as (select doc_id, lag(t) over (partition by doc_id order by i) as a, t as b, i from p), gg as (select * from g where i > 1),
  c as (select a, b, count(*) as c from gg group by all), ca as (select a, sum(c) as ca from c group by a), v as (select count(distinct t) as v from p)
  select doc_id, round(avg(-ln((c + 1) / (ca + v))), 6) as loss, count(*)::bigint as n_pos from gg join c using (a, b) join ca using (a), v group by doc_id""")
def bigram_loss(spark, sf_dir):
    docs = texts(spark, sf_dir)
    return BigramScorer(docs, "ids").score(docs, "doc_id", "ids").select("doc_id", r6("loss"), "n_pos")


@query(rf"""with {SCORED} select source, count(*)::bigint as n, round(min(loss), 6) as min, round(max(loss), 6) as max, round(avg(loss), 6) as mean, round(stddev_pop(loss), 6) as std,
  {', '.join(f'round(quantile_cont(loss, {k / 100}), 6) as p{k}' for k in (10, 25, 50, 75, 85, 90))} from scored group by source""")
def loss_summary(spark, sf_dir):
    out = curriculum.loss_summary(scored(spark, sf_dir), "source")
    return out.select("source", "n", *(r6(c) for c in out.columns if c not in ("source", "n")))


@query(rf"""with {BUCKETED} select source, count_if(bucket = 'general')::bigint as general, count_if(bucket = 'hard')::bigint as hard, count_if(bucket = 'easy')::bigint as easy,
  count_if(bucket = 'suspicious')::bigint as suspicious, count(*)::bigint as n, round(coalesce(avg(loss) filter (where bucket <> 'suspicious'), -1), 6) as clean_loss from bucketed group by source""")
def loss_bucket_counts(spark, sf_dir):
    out = curriculum.bucket_counts(bucketed(spark, sf_dir), "source")
    return out.withColumn("clean_loss", F.round(F.coalesce("clean_loss", F.lit(-1.0)), 6))


def _split_sql(by: str, seed: str, val: int, train: int, key: str = "doc_id") -> str:
    part = f"partition by {by}" if by else ""
    tail = f"partition by {by}, bucket" if by else "partition by bucket"
    g, h = int(train * 0.6), int(train * 0.3)
    return rf"""clean as (select *, row_number() over ({part} order by md5('{seed}:val:' || {key}), {key}) as v from bucketed where bucket <> 'suspicious'),
pool as (select *, row_number() over ({tail} order by md5('{seed}:train:' || {key}), {key}) as t from clean where v > {val}),
chosen as (select doc_id, source, bucket, 'val' as split from clean where v <= {val} union all
  select doc_id, source, bucket, 'train' from pool where t <= case bucket when 'general' then {g} when 'hard' then {h} else {train - g - h} end)"""


@query(rf"with {BUCKETED}, {_split_sql('', 'c', 400, 2000)} select doc_id, bucket, split from chosen")
def curriculum_split(spark, sf_dir):
    return curriculum.split_curriculum(bucketed(spark, sf_dir), ["doc_id"], [], "c", 400, 2000).select("doc_id", "bucket", "split")


@query(rf"with {BUCKETED}, {_split_sql('source', 'm', 5, 20)} select doc_id, source, bucket, split from chosen")
def curriculum_mixture(spark, sf_dir):
    return curriculum.split_curriculum(bucketed(spark, sf_dir), ["doc_id"], ["source"], "m", 5, 20).select("doc_id", "source", "bucket", "split")


@query(rf"""with {BUCKETED}, {_split_sql('source', 'm', 5, 20)}
  select coalesce(split, '(all)') as split, coalesce(bucket, '(all)') as bucket, count(*)::bigint as n from chosen group by cube (split, bucket)""")
def curriculum_cube(spark, sf_dir):
    rows = curriculum_mixture(spark, sf_dir)
    return rows.cube("split", "bucket").agg(F.count("*").alias("n")).select(
        F.coalesce("split", F.lit("(all)")).alias("split"), F.coalesce("bucket", F.lit("(all)")).alias("bucket"), "n"
    )


@query(rf"""with {BUCKETED}, s as (select *, row_number() over (partition by source order by md5('d:' || doc_id), doc_id) as r from bucketed),
  k as (select *, row_number() over (partition by source order by r) as r2 from s where r <= 40 and bucket <> 'suspicious')
  select doc_id, source, case when r2 <= 3 then 'val' else 'train' end as split from k where r2 <= 10""")
def direct_sample(spark, sf_dir):
    rows = sampling.take_each(bucketed(spark, sf_dir), 40, "d", ["source"], "doc_id").where("bucket <> 'suspicious'")
    again = F.row_number().over(Window.partitionBy("source").orderBy("rk"))
    return rows.withColumn("r2", again).where("r2 <= 10").select("doc_id", "source", F.when(F.col("r2") <= 3, "val").otherwise("train").alias("split"))


# Samples and mixtures -------------------------------------------------------

@query(r"""with s as (select doc_id, row_number() over (order by md5('g:' || doc_id), doc_id) as rk from documents)
  select rk::int as rk, doc_id, (select sha256(string_agg(doc_id::varchar, chr(10) order by rk)) from s where rk <= 100) as digest from s where rk <= 100""")
def global_sample(spark, sf_dir):
    top = sampling.take(load(spark, sf_dir, "documents").select("doc_id"), 100, "g", "doc_id")
    listed = F.array_sort(F.collect_list(F.struct("rk", F.col("doc_id").cast("string").alias("d"))))
    digest = top.agg(F.sha2(F.array_join(F.transform(listed, lambda x: x["d"]), "\n"), 256).alias("digest"))
    return top.crossJoin(F.broadcast(digest)).select("rk", "doc_id", "digest")  # one row


@query(r"""with r as (select doc_id, source, row_number() over (partition by source order by md5('p:' || doc_id), doc_id) as rk from documents)
  select source, doc_id, rk::int as rk from r where rk <= 4""")
def shard_pool(spark, sf_dir):
    return sampling.take_each(load(spark, sf_dir, "documents").select("source", "doc_id"), 4, "p", ["source"], "doc_id")


U60 = "(('0x' || substr(md5({0}), 1, 15))::bigint / 1152921504606846976.0)"


@query(rf"""with w as (select source, sum(n_chars) as weight from documents group by source), s as (select source, weight / sum(weight) over () as weight from w),
  i as (select source, sum(weight) over (order by source rows between unbounded preceding and current row) as hi, row_number() over (order by source desc) as z from s),
  j as (select source, coalesce(lag(hi) over (order by source), 0) as lo, case when z = 1 then 2.0 else hi end as hi from i),
  d as (select l_orderkey * 8 + l_linenumber as draw, {U60.format("'w:' || (l_orderkey * 8 + l_linenumber)")} as u from lineitem)
  select source, count(*)::bigint as draws from d join j on u >= lo and u < hi group by source""")
def weighted_draws(spark, sf_dir):
    weights = load(spark, sf_dir, "documents").groupBy("source").agg(F.sum("n_chars").cast("double").alias("weight"))
    draws = load(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("draw"))
    return sampling.weighted_draws(draws, weights, "w", "source").groupBy("source").agg(F.count("*").alias("draws"))


KINDS = [("train", 1000), ("val", 97), ("probe", 11), ("micro", 0)]


@query(r"""with w as (select source, count(*) / sum(count(*)) over () as weight from documents group by source),
  k(kind, total) as (values ('train', 1000), ('val', 97), ('probe', 11), ('micro', 0)),
  a as (select kind, total, source, weight, count(*) over (partition by kind) as k from k, w),
  b as (select *, case when total >= k then 1 else 0 end as m from a), c as (select *, weight * (total - k * m) as raw from b),
  e as (select *, m + floor(raw) as base from c),
  f as (select *, row_number() over (partition by kind order by round(raw, 9) - floor(raw) desc, source) as rk, total - sum(base) over (partition by kind) as rest from e)
  select kind, source, (base + case when rk <= rest then 1 else 0 end)::bigint as alloc from f""")
def allocation(spark, sf_dir):
    w = sampling.normalised(load(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").cast("double").alias("weight")))
    kinds = spark.createDataFrame(KINDS, "kind string, total long")
    return sampling.largest_remainder(w.crossJoin(F.broadcast(kinds)), ["kind"], "source").select("kind", "source", "alloc")


@query(r"""with w as (select source, count(*) as size, sum(n_chars) / sum(sum(n_chars)) over () as weight from documents group by source),
  z as (select *, row_number() over (order by source desc) as z from w),
  c as (select *, case when z = 1 then size else least(greatest(1, round_even(300 * weight, 0)), size) end as cap from z),
  u as (select *, coalesce(sum(cap) over (order by source rows between unbounded preceding and 1 preceding), 0) as used from c)
  select source, least(cap, greatest(0, 300 - used))::bigint as pick from u""")
def mixture_subsample(spark, sf_dir):
    s = load(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("size"), F.sum("n_chars").cast("double").alias("weight"))
    return sampling.proportional_take(sampling.normalised(s), "source", 300).select("source", "pick")


# Screening ------------------------------------------------------------------

def screened(spark, sf_dir):
    shards = load(spark, sf_dir, "documents").groupBy("source").agg(F.floor(F.sum("n_chars") / 8192).alias("shards_cached"))
    return screening.trainability(bucketed(spark, sf_dir), "source", shards, 60)


SCREENED = BUCKETED + r""",
sh as (select source, sum(n_chars) // 8192 as shards_cached from documents group by source),
a as (select source, count_if(bucket = 'general') as general, count_if(bucket = 'hard') as hard, count_if(bucket = 'easy') as easy, count_if(bucket = 'suspicious') as suspicious, count(*) as n_scored,
  quantile_cont(case when bucket <> 'suspicious' then loss end, 0.5) as p50, quantile_cont(case when bucket <> 'suspicious' then loss end, 0.85) as p85 from bucketed group by source),
b as (select *, general + hard + easy as clean_n, coalesce(hard / nullif(general + hard + easy, 0), 0.0) as hard_frac, coalesce(p85 - p50, 0.0) as spread, suspicious / n_scored as susp_frac,
  hard <= 18 as hard_saturated from a left join sh using (source)),
c as (select *, least(60, clean_n, 36 + least(18, hard) + least(6, easy)) as achievable,
  0.35 * least(1.0, hard_frac / 0.15) + 0.25 * least(1.0, spread / 0.5) + 0.20 * case when shards_cached > 0 then least(1.0, shards_cached / 12.0) else 0.2 end
  + 0.10 * least(1.0, clean_n / 1500.0) + 0.10 * greatest(0.0, 1.0 - 5.0 * susp_frac) as score from b)"""


@query(rf"""with {SCREENED} select source, n_scored::bigint as n_scored, clean_n::bigint as clean_n, round(hard_frac, 6) as hard_frac, round(spread, 6) as spread, round(susp_frac, 6) as susp_frac,
  hard_saturated, achievable::bigint as achievable, round(score, 6) as score,
  concat_ws(',', case when shards_cached < 4 then 'low_shard_cache' end, case when hard_saturated then 'hard_saturated' end, case when achievable < 51 then 'train_undersized' end,
    case when susp_frac > 0.05 then 'suspicious_frac' end, case when clean_n < 200 then 'small_scored_pool' end) as issues from c""")
def trainability(spark, sf_dir):
    out = screened(spark, sf_dir)
    return out.select("source", "n_scored", "clean_n", r6("hard_frac"), r6("spread"), r6("susp_frac"), "hard_saturated", F.col("achievable").cast("long").alias("achievable"), r6("score"), "issues")


@query(rf"""with {SCREENED}, m as (select source, clean_n, least(0.3, hard_frac * 0.9) as most, hard_frac from c),
  h as (select source, clean_n, case when most < 0.05 then least(0.3, hard_frac) else most end as hard from m),
  g as (select source, clean_n, hard, (0.6 / 0.7) * (1 - hard) as general from h)
  select source, round(case when clean_n > 0 then general else 0.6 end, 6) as general, round(case when clean_n > 0 then hard else 0.3 end, 6) as hard,
  round(case when clean_n > 0 then 1 - hard - general else 0.1 end, 6) as easy from g""")
def suggest_mix(spark, sf_dir):
    mix = screening.suggested_mix(F.col("hard_frac"), F.col("clean_n") > 0)
    return screened(spark, sf_dir).select("source", *(F.round(c, 6).alias(k) for k, c in mix.items()))


@query(rf"""with {SCREENED}, q as (select source, avg(quality) as quality from documents join labels using (doc_id) group by source),
  w as (select source, coalesce(quality, 0.5) as quality, greatest(0.05, score) as s from c left join q using (source)),
  x as (select source, 0.5 * quality / sum(quality) over () + 0.5 * s / sum(s) over () as b from w),
  y as (select source, greatest(0.03, b / sum(b) over ()) as f from x) select source, round(f / sum(f) over (), 6) as suggested from y""")
def suggest_weights(spark, sf_dir):
    labels = load(spark, sf_dir, "labels").select("doc_id", "quality")
    quality = load(spark, sf_dir, "documents").select("doc_id", "source").join(labels, "doc_id").groupBy("source").agg(F.avg("quality").alias("quality"))
    rows = screened(spark, sf_dir).join(quality, "source", "left").select("source", "score", F.coalesce("quality", F.lit(0.5)).alias("weight"))
    return screening.suggested_weights(sampling.normalised(rows), "source").select("source", r6("suggested"))


# Paired evaluation ----------------------------------------------------------

#: The reference's sizes; a table with fewer than two holdouts of English texts keeps half of them to fit on.
HOLDOUT, REPLICATES, ALPHA, DELTA, LEAST_N = 2000, 10_000, 0.01, 0.0025, 3000


def duel(spark, sf_dir):
    """The holdout's differences, computed once: the king is fitted on all texts outside it, the challenger on its English ones.

    The holdout has at most ``HOLDOUT`` rows of numbers, which the queries read several times.
    """
    docs = documents(spark, sf_dir, "lang")
    english = load(spark, sf_dir, "documents").where("lang = 'en'").where(F.col("text").rlike(WORD)).count()
    holdout = written(sampling.take(docs.where("lang = 'en'"), min(HOLDOUT, english // 2), "h", "doc_id").withColumn("pos", F.col("rk").cast("long") - 1))
    rest = docs.join(holdout.select("doc_id"), "doc_id", "left_anti")
    counts = word_counts_by(rest, "lang", "ids").groupBy("tok").agg(F.sum("c").alias("all"), F.sum(F.when(F.col("lang") == "en", F.col("c")).otherwise(0)).alias("en"))
    counts = written(counts)
    king = UnigramScorer.of_counts(counts.select("tok", F.col("all").alias("c"))).score(holdout, "doc_id", "ids")
    challenger = UnigramScorer.of_counts(counts.where("en > 0").select("tok", F.col("en").alias("c"))).score(holdout, "doc_id", "ids")
    out = evaluation.paired_differences(king, challenger, "doc_id").join(holdout.select("doc_id", "pos", "source"), "doc_id")
    return spark.createDataFrame(out.toArrow())


DUEL = TOK + r""",
full_ as (select * from tok where len(ids) > 0),
hold as (select *, row_number() over (order by md5('h:' || doc_id), doc_id) - 1 as pos from full_ where lang = 'en' qualify pos < least(2000, count(*) over () // 2)),
rest as (select * from full_ where doc_id not in (select doc_id from hold)),
hp as (select doc_id, unnest(ids) as t from hold), hk as (select doc_id, t, count(*) as k from hp group by all),
kc as (select t, count(*) as c from (select unnest(ids) as t from rest) group by t), kt as (select sum(c) as total, count(*) as types from kc),
cc as (select t, count(*) as c from (select unnest(ids) as t from rest where lang = 'en') group by t), ct as (select sum(c) as total, count(*) as types from cc),
kl as (select doc_id, sum(k * -ln((coalesce(c, 0) + 1) / (total + types))) / sum(k) as king_loss from hk left join kc using (t), kt group by doc_id),
cl as (select doc_id, sum(k * -ln((coalesce(c, 0) + 1) / (total + types))) / sum(k) as challenger_loss from hk left join cc using (t), ct group by doc_id),
diffs as (select doc_id, pos, source, king_loss, challenger_loss, king_loss - challenger_loss as diff from kl join cl using (doc_id) join hold using (doc_id))"""
MEANS = r""",
nn as (select count(*) as n from diffs), slots as (select r.range as replicate, s.range as slot, n from range(10000) r, nn, range(0, (select n from nn)) s),
picks as (select replicate, ('0x' || substr(md5('b:' || replicate || ':' || slot), 1, 15))::bigint % n as pick from slots),
means as (select replicate, avg(diff) as mean from picks join diffs on pick = pos group by replicate)"""


@query(rf"with {DUEL} select doc_id, round(king_loss, 6) as king_loss, round(challenger_loss, 6) as challenger_loss, round(diff, 6) as diff from diffs")
def paired_diffs(spark, sf_dir):
    return duel(spark, sf_dir).select("doc_id", r6("king_loss"), r6("challenger_loss"), r6("diff"))


@query(rf"with {DUEL}{MEANS} select replicate, round(mean, 6) as mean from means")
def bootstrap_means(spark, sf_dir):
    return evaluation.bootstrap_means(spark, duel(spark, sf_dir), "pos", REPLICATES, "b").select("replicate", r6("mean"))


@query(rf"""with {DUEL}{MEANS}, l as (select coalesce(quantile_cont(mean, 0.01), 0.0) as lcb from means),
  p as (select count(*)::bigint as n, avg(diff) as mu_hat, avg(king_loss) as k, avg(challenger_loss) as c from diffs)
  select n, round(mu_hat, 6) as mu_hat, round(lcb, 6) as lcb, round(k, 6) as avg_king_loss, round(c, 6) as avg_challenger_loss, lcb > 0.0025 as accepted,
  case when lcb <= 0.0025 then 'DO_NOT_SUBMIT' when n < 3000 then 'PROMISING_NEEDS_MORE_EVAL' when lcb >= 0.0035 and mu_hat >= 0.0075 then 'READY_TO_UPLOAD' else 'READY_TO_MERGE' end as decision from p, l""")
def duel_verdict(spark, sf_dir):
    d = duel(spark, sf_dir)
    v = evaluation.verdict(d, evaluation.bootstrap_means(spark, d, "pos", REPLICATES, "b"), ALPHA, DELTA).withColumn("warned", F.lit(False))
    return v.select("n", r6("mu_hat"), r6("lcb"), r6("avg_king_loss"), r6("avg_challenger_loss"), "accepted", evaluation.decision("lcb", "mu_hat", "n", "warned", least_n=LEAST_N).alias("decision"))


BY_SOURCE = r""",
at_ as (select *, row_number() over (partition by source order by pos) - 1 as at, count(*) over (partition by source) as ns from diffs),
ss as (select distinct source, ns from at_), sl as (select source, ns, r.range as replicate, unnest(range(0, ns)) as slot from ss, range(10000) r),
sp as (select source, replicate, ('0x' || substr(md5('sb:' || source || ':' || replicate || ':' || slot), 1, 15))::bigint % ns as at from sl),
sm as (select sp.source, replicate, avg(diff) as mean from sp join at_ on sp.source = at_.source and sp.at = at_.at group by all),
sl2 as (select source, quantile_cont(mean, 0.01) as lcb from sm group by source),
sv as (select source, count(*) as n, avg(diff) as mu_hat, any_value(lcb) as lcb, source like '%a%' as guarded from diffs join sl2 using (source) group by source),
verdicts as (select *, lcb > 0.0025 as accepted, guarded and (mu_hat < -0.001 or lcb < -0.001) as regressed from sv)"""


def by_source(spark, d):
    return evaluation.source_verdicts(spark, d, REPLICATES, "sb", ALPHA, DELTA, F.col("source").contains("a"))


WEIGHTED = r""",
w as (select source, count(*) / sum(count(*)) over () as weight from documents group by source),
x as (select pos, diff, weight, weight / sum(weight) over () as p from diffs join w using (source)),
y as (select pos, diff, sum(p) over (order by pos) as hi, row_number() over (order by pos desc) as z from x),
i as (select diff, case when z = 1 then 2.0 else hi end as hi, coalesce(lag(hi) over (order by pos), 0.0) as lo from y),
wn as (select count(*) as n from diffs), s as (select r.range as replicate, s.range as slot from range(10000) r, range(0, (select n from wn)) s),
u as (select replicate, """ + U60.format("'wb:' || replicate || ':' || slot") + r""" as u from s),
wmeans as (select replicate, avg(diff) as mean from u join i on u >= lo and u < hi group by replicate)"""


def weighted(spark, sf_dir, d):
    """The differences with the weight of their source, summing to 1, and the means of weighted replicates."""
    weights = sampling.normalised(load(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").cast("double").alias("weight")))
    d = sampling.normalised(d.join(weights, "source"))
    w = Window.orderBy("pos")  # a holdout of a fixed number of rows
    hi = F.sum("weight").over(w.rowsBetween(Window.unboundedPreceding, 0))
    i = d.withColumn("hi", F.when(F.row_number().over(Window.orderBy(F.col("pos").desc())) == 1, F.lit(2.0)).otherwise(hi))
    i = i.withColumn("lo", F.coalesce(F.lag("hi").over(w), F.lit(0.0))).select("diff", "lo", "hi")
    return d, evaluation.weighted_bootstrap_means(spark, i, REPLICATES, "wb")


@query(rf"with {DUEL}{WEIGHTED} select replicate, round(mean, 6) as mean from wmeans")
def weighted_bootstrap(spark, sf_dir):
    return weighted(spark, sf_dir, duel(spark, sf_dir))[1].select("replicate", r6("mean"))


@query(rf"""with {DUEL}{WEIGHTED}{BY_SOURCE}, l as (select quantile_cont(mean, 0.01) as lcb from wmeans), m as (select count(*) as n, sum(p * diff) as mu from x),
  r as (select coalesce(string_agg(source, ',' order by source) filter (where regressed), '') as warned from verdicts)
  select n::bigint as n_eval, round(mu, 6) as mixture_mu, round(lcb, 6) as mixture_lcb, lcb > 0.0025 and mu >= 0.001 as accepted,
  concat_ws(',', case when lcb <= 0.0025 then 'lcb' end, case when mu < 0.001 then 'mu_hat' end, nullif(warned, '')) as reasons from m, l, r""")
def mixture_evaluation(spark, sf_dir):
    d = duel(spark, sf_dir)
    w, means = weighted(spark, sf_dir, d)
    out = evaluation.pooled_verdict(w, means, by_source(spark, d), ALPHA, DELTA, 0.001)
    return out.select("n_eval", r6("mixture_mu"), r6("mixture_lcb"), "accepted", "reasons")


@query(rf"""with {DUEL} select count(*)::bigint as n, count(*) filter (where pos < 50)::bigint as n_public, round(coalesce(avg(diff) filter (where pos < 50), 0), 6) as mu_public,
  round(coalesce(avg(diff) filter (where pos >= 50), 0), 6) as mu_private, round(coalesce(avg(diff), 0), 6) as mu_hat from diffs""")
def component_means(spark, sf_dir):
    out = evaluation.component_means(duel(spark, sf_dir), "pos", 50)
    return out.select("n", "n_public", r6("mu_public"), r6("mu_private"), r6("mu_hat"))


@query(rf"""with {DUEL}{MEANS}, l as (select quantile_cont(mean, 0.01) as lcb from means), m as (select count(*) as n, count(*) filter (where pos < 50) as n_public, avg(diff) as mu, avg(diff) filter (where pos < 50) as a,
  avg(diff) filter (where pos >= 50) as b, sha256(string_agg(doc_id::varchar, chr(10) order by pos)) as digest, sum(king_loss) as k, sum(challenger_loss) as c from diffs)
  select digest as index_digest, n::bigint as n, n_public::bigint as n_public, (n - n_public)::bigint as n_private, round(mu, 6) as mu_hat, round(coalesce(a, 0), 6) as mu_public, round(coalesce(b, 0), 6) as mu_private,
  round(lcb, 6) as lcb, round(k / n, 6) as avg_king_loss, round(c / n, 6) as avg_challenger_loss, lcb > 0.0025 as accepted, 10000::bigint as n_bootstrap, 0.01::double as alpha, 0.0025::double as delta from m, l""")
def evaluation_record(spark, sf_dir):
    """The audit record of an evaluation: what was drawn, the parts, the verdict and its settings."""
    d = duel(spark, sf_dir)
    listed = F.sort_array(F.collect_list(F.struct("pos", F.col("doc_id").cast("string").alias("d"))))
    digest = d.agg(F.sha2(F.array_join(F.transform(listed, lambda x: x["d"]), "\n"), 256).alias("index_digest"))
    v = evaluation.verdict(d, evaluation.bootstrap_means(spark, d, "pos", REPLICATES, "b"), ALPHA, DELTA)
    parts = evaluation.component_means(d, "pos", 50).select("n_public", "mu_public", "mu_private")
    out = v.crossJoin(F.broadcast(parts)).crossJoin(F.broadcast(digest))  # one row each
    return out.select(
        "index_digest", "n", "n_public", (F.col("n") - F.col("n_public")).alias("n_private"), r6("mu_hat"), r6("mu_public"), r6("mu_private"), r6("lcb"), r6("avg_king_loss"),
        r6("avg_challenger_loss"), "accepted", F.lit(REPLICATES).cast("long").alias("n_bootstrap"), F.lit(ALPHA).alias("alpha"), F.lit(DELTA).alias("delta"),
    )


@query(rf"with {DUEL}{BY_SOURCE} select source, n::bigint as n, round(mu_hat, 6) as mu_hat, round(lcb, 6) as lcb, guarded, accepted, regressed from verdicts")
def regression_guard(spark, sf_dir):
    return by_source(spark, duel(spark, sf_dir)).select("source", "n", r6("mu_hat"), r6("lcb"), "guarded", "accepted", "regressed")


@query(r"""select doc_id, substr(sha256(coalesce(text, '')), 1, 16) as content_key, case when length(text) >= 2000 then 'large' else 'small' end as size_class from documents""")
def content_keys(spark, sf_dir):
    return load(spark, sf_dir, "documents").select(
        "doc_id", short_sha(F.coalesce("text", F.lit("")), 16).alias("content_key"), F.when(F.length("text") >= 2000, "large").otherwise("small").alias("size_class")
    )
