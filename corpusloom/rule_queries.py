"""Queries of the decision rules, each beside DuckDB SQL with the same rows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .functions import parsing as P
from .operators import curriculum, evaluation, records, rules, sampling, shards, sweeps
from .operators.packing import running_offset
from .operators.quantiles import exclusive_quantiles
from .operators.token_tables import word_counts_by
from .queries import ALPHA, BUCKETED, CUTS, SCREENED, TOK, bucketed, documents, r6, scored, screened
from .tables import load, written

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLE[f.__name__] = f, sql
        return f

    return add


def pick(k, *values):
    return F.element_at(F.array(*(F.lit(v) for v in values)), (F.pmod(k, F.lit(len(values))) + 1).cast("int"))


# Parameters and probes ------------------------------------------------------

#: Names of parameters, with the class that each rule gives them.
NAMES = (
    ("model.embed_tokens.weight", "embed", "embed"), ("lm_head.weight", "lm_head", "lm_head"), ("model.layers.3.input_layernorm.weight", "norm", "norm"),
    ("model.layers.3.self_attn.q_proj.weight", "attn", "attn"), ("model.layers.3.self_attn.q_norm.weight", "norm", "attn"), ("model.layers.3.mlp.experts.7.up_proj.weight", "ffn", "moe_experts"),
    ("model.layers.3.mlp.gate.weight", "ffn", "moe_router"), ("model.layers.3.mlp.down_proj.weight", "ffn", "mlp_dense"), ("blocks.1.memory.w_alpha", "memory", "other"),
    ("blocks.1.router.bias", "moe_router", "other"), ("blocks.1.experts_w12", "moe_routed", "other"), ("blocks.1.shared_experts.w", "moe_shared", "other"),
    ("blocks.1.w_down_proj", "moe_dcca", "mlp_dense"), ("blocks.1.max_vio", "moe_smebu", "other"), ("blocks.1.injection_gate", "looped_inject", "other"), ("blocks.1.head.bias", "bias", "other"),
)
LISTED = "values " + ", ".join(f"({k}, '{n}', '{g}', '{s}')" for k, (n, g, s) in enumerate(NAMES))


def parameters(spark, sf_dir):
    return load(spark, sf_dir, "part").select("p_partkey", "p_size", pick(F.col("p_partkey"), *(n for n, _, _ in NAMES)).alias("name"))


@query(f"""select p_partkey, g as gradient_class, s as size_class from part join ({LISTED}) n(k, name, g, s) on k = p_partkey % {len(NAMES)}""")
def parameter_classes(spark, sf_dir):
    return parameters(spark, sf_dir).select("p_partkey", rules.gradient_class(F.col("name")).alias("gradient_class"), rules.size_class(F.col("name")).alias("size_class"))


@query(f"""with p as (select s as class, name, p_size as n from part join ({LISTED}) n(k, name, g, s) on k = p_partkey % {len(NAMES)} where s <> 'lm_head')
  select coalesce(class, '(all)') as class, sum(n)::bigint as total, sum(case when class = 'moe_experts' then n * 8 // 128 else n end)::bigint as active from p group by rollup (class)""")
def parameter_counts(spark, sf_dir):
    return rules.parameter_counts(parameters(spark, sf_dir), "name", "p_size", 8, 128, tied=True)


@query("""select o_custkey, count(*)::bigint as n, count_if(o_orderkey % 3 = 1)::bigint as wrong, round(max(o_totalprice), 6) as peak from orders group by o_custkey""")
def dtype_counts(spark, sf_dir):
    """Parameters of a model that are not of the wanted type, and the most memory that a poll has seen."""
    dtype = pick(F.col("o_orderkey"), "bf16", "fp32", "bf16")
    return load(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.count_if(dtype != "bf16").alias("wrong"), F.round(F.max("o_totalprice"), 6).alias("peak"))


@query("""select l_partkey, count(*)::bigint as n_seeds, round(coalesce(min(l_tax) filter (where l_linenumber <> 2), -1), 6) as min_loss, round(coalesce(max(l_tax) filter (where l_linenumber <> 2), -1), 6) as max_loss,
  round(max(l_quantity), 6) as max_norm, round(coalesce(max(case when l_linenumber = 3 then l_discount else greatest(l_discount, l_quantity / 10) end), -1), 6) as max_group_norm from lineitem group by l_partkey""")
def probe_summary(spark, sf_dir):
    """Probes over seeds; losses and group norms that are no numbers do not count."""
    nan = F.lit(float("nan"))
    li = load(spark, sf_dir, "lineitem").select(
        "l_partkey", F.when(F.col("l_linenumber") == 2, nan).otherwise(F.col("l_tax")).alias("loss"), F.col("l_quantity").alias("norm"),
        F.create_map(F.lit("attn"), F.col("l_discount"), F.lit("ffn"), F.when(F.col("l_linenumber") == 3, float("inf")).otherwise(F.col("l_quantity") / 10)).alias("groups"),
    )
    out = rules.probe_summary(li, "l_partkey", "loss", "norm", "groups")
    return out.select("l_partkey", "n_seeds", *(F.round(F.coalesce(c, F.lit(-1.0)), 6).alias(c) for c in ("min_loss", "max_loss", "max_norm", "max_group_norm")))


@query("""with g as (select l_partkey, 'attn' as grp, l_discount as v from lineitem union all select l_partkey, 'ffn', l_quantity / 10 from lineitem where l_linenumber <> 3) select l_partkey, grp, round(max(v), 6) as norm from g group by all""")
def probe_groups(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem").select("l_partkey", F.create_map(F.lit("attn"), F.col("l_discount"), F.lit("ffn"), F.when(F.col("l_linenumber") == 3, float("inf")).otherwise(F.col("l_quantity") / 10)).alias("groups"))
    return rules.group_maxima(li, "l_partkey", "groups").select("l_partkey", F.col("group").alias("grp"), F.round("norm", 6).alias("norm"))


@query("""with x as (select label, vec_id, sqrt(list_sum(list_transform(embedding, lambda g: g::double * g::double))) * 100 as norm from embeddings), s as (select label, sqrt(sum(norm * norm)) as whole, max(norm) as worst, count_if(vec_id % 211 = 7) as bad from x group by label)
  select label, case when bad > 0 then 'not_finite' when whole > 700 then 'norm_exceeded' when worst > 100.00001 then 'group_norm_exceeded' else 'ok' end as gate from s""")
def fixed_gates(spark, sf_dir):
    """The gates at fixed caps: finite, then the overall norm, then the worst group's."""
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))) * 100
    x = load(spark, sf_dir, "embeddings").select("label", F.when(F.col("vec_id") % 211 == 7, float("inf")).otherwise(norm).alias("norm"))
    bad = F.bool_or(F.abs("norm") == float("inf"))
    out = x.groupBy("label").agg(F.sqrt(F.sum(F.col("norm") * F.col("norm"))).alias("whole"), F.max("norm").alias("worst"), bad.alias("bad"))
    return out.select("label", rules.gate_reason(~F.col("bad"), F.col("whole"), F.col("worst"), 700.0, 100.00001).alias("gate"))


@query("""select label, case when count_if(vec_id % 97 = 3) > 0 then -1 else round(max(list_max(list_transform(embedding, lambda g: abs(g::double)))), 6) end as peak from embeddings group by label""")
def norm_peaks(spark, sf_dir):
    x = load(spark, sf_dir, "embeddings").select("label", F.explode("embedding").alias("v"), "vec_id")
    x = x.select("label", F.when(F.col("vec_id") % 97 == 3, float("nan")).otherwise(F.col("v").cast("double")).alias("v"))
    out = rules.norm_peak(x, "label", "v")
    return out.select("label", F.when(F.isnan("peak"), -1.0).otherwise(F.round("peak", 6)).alias("peak"))


@query("""select l_orderkey, 'checkpoint-' || (l_linenumber % 3 * 100) as checkpoint, round(min(l_tax), 6) as best_loss from lineitem where l_returnflag <> 'A' group by all""")
def checkpoint_losses(spark, sf_dir):
    """The least evaluation loss that the log has of each checkpoint; steps without one are left out."""
    loss = F.when(F.col("l_returnflag") != "A", F.col("l_tax"))
    name = F.concat(F.lit("checkpoint-"), F.col("l_linenumber") % 3 * 100)
    return load(spark, sf_dir, "lineitem").select("l_orderkey", name.alias("checkpoint"), loss.alias("loss")).where("loss is not null").groupBy("l_orderkey", "checkpoint").agg(F.round(F.min("loss"), 6).alias("best_loss"))


@query("""with s as (select l_suppkey, list_sort(list(l_extendedprice)) as v from lineitem group by l_suppkey), j as (select l_suppkey, v, len(v) as n, least(greatest(19 * (len(v) + 1) // 20, 1), len(v) - 1) as j from s)
  select l_suppkey, round(case when n = 1 then v[1] else (v[j] * (20 - (19 * (n + 1) - j * 20)) + v[j + 1] * (19 * (n + 1) - j * 20)) / 20 end, 4) as p95, round(v[n], 4) as top from j""")
def latency_quantiles(spark, sf_dir):
    """The 95th percentile by the exclusive method, and the largest."""
    rows = load(spark, sf_dir, "lineitem").select("l_suppkey", "l_extendedprice")
    top = rows.groupBy("l_suppkey").agg(F.round(F.max("l_extendedprice"), 4).alias("top"))
    return exclusive_quantiles(rows, F.col("l_extendedprice"), 19, 20, ["l_suppkey"]).join(top, "l_suppkey").select("l_suppkey", F.round("q", 4).alias("p95"), "top")


# Hygiene --------------------------------------------------------------------

FILES = """f as (select l_orderkey as repo, l_linenumber as n, l_returnflag as g, (l_extendedprice * 2000000)::bigint as size, l_linenumber = 1 and l_discount > 0.08 as am,
  case l_linenumber when 1 then 'config.json' when 2 then case l_returnflag when 'A' then 'model.safetensors' when 'N' then 'model-00001-of-00002.safetensors' else 'weights.safetensors' end
    when 3 then case l_returnflag when 'N' then 'model.safetensors.index.json' else 'tokenizer.json' end when 4 then 'tokenizer_config.json' when 5 then case l_returnflag when 'R' then 'modeling.py' else 'README.md' end
    when 6 then 'model-00002-of-00002.safetensors' else 'notes.txt' end as name from lineitem)"""


def repo_files(spark, sf_dir):
    """Each order's lines as the files of a repository."""
    n, g = F.col("l_linenumber"), F.col("l_returnflag")
    name = (
        F.when(n == 1, "config.json").when(n == 2, F.when(g == "A", "model.safetensors").when(g == "N", "model-00001-of-00002.safetensors").otherwise("weights.safetensors"))
        .when(n == 3, F.when(g == "N", "model.safetensors.index.json").otherwise("tokenizer.json")).when(n == 4, "tokenizer_config.json")
        .when(n == 5, F.when(g == "R", "modeling.py").otherwise("README.md")).when(n == 6, "model-00002-of-00002.safetensors").otherwise("notes.txt")
    )
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("repo"), name.alias("name"), F.round(F.col("l_extendedprice") * 2000000).cast("long").alias("size"), ((n == 1) & (F.col("l_discount") > 0.08)).alias("auto_map")
    )


@query(f"""with {FILES}, r as (select repo, bool_or(am) as am, bool_or(n = 5 and g = 'R') as py, bool_or(n in (2, 6)) as st, bool_or(n = 2 and g = 'A') as one, bool_or(n = 3 and g = 'N') as ix, bool_or(n = 6 or (n = 2 and g = 'N')) as sh,
  coalesce(sum(size) filter (where n in (2, 6)), 0) as bytes from f group by repo)
  select repo, case when am then 'auto_map' when py then 'py_files' when not st then 'no_safetensors' when not one and sh and not ix then 'missing_index' when not one and not (sh and ix) then 'not_canonical' when bytes > 100000000000 then 'oversized' else 'ok' end as reason from r""")
def repo_hygiene(spark, sf_dir):
    return rules.layout_reason(repo_files(spark, sf_dir), "repo", "name", "size", "auto_map", 100_000_000_000)


@query(f"""with {FILES}, r as (select repo, bool_or(n = 1) as c, bool_or(n = 4 or (n = 3 and g <> 'N')) as t, bool_or(n = 6 or (n = 2 and g <> 'R') or (n = 3 and g = 'N')) as w, bool_or(n = 5 and g = 'R') as py, bool_or(am) as am from f group by repo)
  select repo, concat_ws(',', case when not c then 'missing_config' end, case when not t then 'missing_tokenizer' end, case when not w then 'missing_weights' end, case when py then 'py_files' end, case when am then 'auto_map' end) as issues from r""")
def submission_issues(spark, sf_dir):
    return rules.submission_issues(repo_files(spark, sf_dir), "repo", "name", "auto_map")


@query(f"""with {FILES}, w as (select distinct l_orderkey as repo from lineitem), want as (select repo, x.name from w, (values ('config.json'), ('tokenizer_config.json'), ('generation.json')) x(name))
  select want.repo, coalesce(sum(size), 0)::bigint as size, count(size)::bigint as found from want left join f on f.repo = want.repo and f.name = want.name group by want.repo""")
def named_sizes(spark, sf_dir):
    """Size of the files named, of which missing ones count nothing."""
    files = repo_files(spark, sf_dir)
    want = files.select("repo").distinct().withColumn("name", F.explode(F.array(*(F.lit(x) for x in ("config.json", "tokenizer_config.json", "generation.json")))))
    out = want.join(files.select("repo", "name", "size"), ["repo", "name"], "left").groupBy("repo")
    return out.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("size"), F.count("size").alias("found"))


SETTINGS = ("vocab_size", "hidden_size", "rope_theta", "tie_word_embeddings", "head_dim", "use_cache", "pad_token_id")
SETTING_SQL = "(case l_linenumber " + " ".join(f"when {k} then '{n}'" for k, n in enumerate(SETTINGS, 1)) + " end)"


def _settings(spark, sf_dir):
    name = F.element_at(F.array(*(F.lit(n) for n in SETTINGS)), F.col("l_linenumber"))
    rows = load(spark, sf_dir, "lineitem").select("l_orderkey", name.alias("name"), F.col("l_returnflag").alias("a"), F.when(F.col("l_quantity") > 20, F.col("l_linestatus")).otherwise(F.col("l_returnflag")).alias("b"), "l_discount")
    return rows.select("l_orderkey", "name", F.when(F.col("l_discount") > 0.01, F.col("a")).alias("a"), F.when(F.col("l_discount") < 0.09, F.col("b")).alias("b"))


@query(f"""with a as (select l_orderkey, {SETTING_SQL} as name, l_returnflag as a from lineitem where l_discount > 0.01), b as (select l_orderkey, {SETTING_SQL} as name, case when l_quantity > 20 then l_linestatus else l_returnflag end as b from lineitem where l_discount < 0.09)
  select l_orderkey, arg_min(name, list_position(['vocab_size', 'hidden_size', 'head_dim', 'tie_word_embeddings', 'rope_theta'], name)) as first_mismatch from a join b using (l_orderkey, name)
  where a <> b and name in ('vocab_size', 'hidden_size', 'head_dim', 'tie_word_embeddings', 'rope_theta') group by l_orderkey""")
def lenient_lock(spark, sf_dir):
    """Settings compared only where both sides have them, in the order of the lock list."""
    rows = _settings(spark, sf_dir)
    sides = (rows.select("l_orderkey", "name", F.col(c).alias("v")) for c in "ab")
    return rules.lenient_mismatch(*sides, "l_orderkey", "name", "v", ("vocab_size", "hidden_size", "head_dim", "tie_word_embeddings", "rope_theta"))


@query(f"""with s as (select l_orderkey, {SETTING_SQL} as name, case when l_discount > 0.01 then l_returnflag end as a, case when l_discount < 0.09 then case when l_quantity > 20 then l_linestatus else l_returnflag end end as b from lineitem),
  m as (select * from s where a is distinct from b), g as (select l_orderkey, coalesce(string_agg(name, ',' order by name) filter (where name in ('vocab_size', 'hidden_size', 'head_dim')), '') as refused, coalesce(string_agg(name, ',' order by name) filter (where name not in ('vocab_size', 'hidden_size', 'head_dim')), '') as p from m group by l_orderkey)
  select l_orderkey, refused, case when refused = '' then p else '' end as patched from g""")
def patch_plans(spark, sf_dir):
    rows = _settings(spark, sf_dir).where(~F.col("a").eqNullSafe(F.col("b")))
    return rules.patch_plan(rows, "l_orderkey", "name")


@query("""with t as (select max(ts) as now from events) select user_id, max(case when event_type = 'error' then ts end) is not null and date_sub('second', coalesce(max(case when event_type = 'error' then ts end), max(now)), max(now)) < 300000 as cooling,
  coalesce(max(case when event_type = 'error' then ts end)::varchar, '') <> '' as failed from events, t group by user_id""")
def store_cooldown(spark, sf_dir):
    """Whether a store is left alone because its last failure is too recent."""
    ev = load(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    now = ev.agg(F.max("ts").alias("now"))
    last = ev.groupBy("user_id").agg(F.max(F.when(F.col("event_type") == "error", F.col("ts"))).alias("f")).crossJoin(F.broadcast(now))  # one row
    cooling = F.coalesce(F.timestamp_diff("SECOND", F.col("f"), F.col("now")) < 300000, F.lit(False))
    return last.select("user_id", cooling.alias("cooling"), F.col("f").isNotNull().alias("failed"))


@query("""select p_partkey, p_name, round(p_size / 1024.0, 2) as mib, p_retailprice < 1000 as disk_low from part where p_name like '%ring%' or p_name like '%small%'""")
def process_table(spark, sf_dir):
    """Processes whose name has a keyword, their memory in MiB, and whether the disk runs low."""
    p = load(spark, sf_dir, "part").where(F.col("p_name").contains("ring") | F.col("p_name").contains("small"))
    return p.select("p_partkey", "p_name", F.round(F.col("p_size") / 1024.0, 2).alias("mib"), (F.col("p_retailprice") < 1000).alias("disk_low"))


# Buckets and curricula ------------------------------------------------------

@query(rf"""with {BUCKETED} select bucket, round(avg(loss), 6) as mean_loss, count(*)::bigint as n from bucketed group by bucket""")
def bucket_means(spark, sf_dir):
    return bucketed(spark, sf_dir).groupBy("bucket").agg(F.round(F.avg("loss"), 6).alias("mean_loss"), F.count("*").alias("n"))


@query(rf"""with {BUCKETED}, k as (select doc_id, case when doc_id % 5 = 0 then 'easy' else bucket end as bucket from bucketed) select bucket, count(*)::bigint as n, sum(doc_id)::bigint as ids from k group by bucket""")
def kept_buckets(spark, sf_dir):
    """Buckets that rows already have stay."""
    had = F.when(F.col("doc_id") % 5 == 0, "easy").when(F.col("doc_id") % 5 == 1, "")
    out = curriculum.assign_buckets(scored(spark, sf_dir).withColumn("bucket", had))
    return out.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("doc_id").alias("ids"))


@query(rf"""with {CUTS}, b as (select doc_id, case when rep_r > 0.2 or rep_ng4 > 0.5 or unique_r < 0.05 then 'suspicious' when loss >= p85 then 'hard' when loss >= 0.8 * p50 and loss <= p85 then 'general' else 'easy' end as bucket from scored, cuts),
  v as (select doc_id, row_number() over (order by md5('old:val:' || doc_id), doc_id) as r from b where bucket <> 'suspicious'), t as (select b.*, row_number() over (partition by bucket order by md5('old:train:' || b.doc_id), b.doc_id) as r from b join v using (doc_id) where v.r > 50)
  select doc_id, bucket, 'val' as split from b join v using (doc_id) where v.r <= 50 union all select doc_id, bucket, 'train' from t where r <= case bucket when 'general' then 140 when 'hard' then 40 else 20 end""")
def older_curriculum(spark, sf_dir):
    """The older buckets and shares of 0.7, 0.2 and 0.1."""
    rows = curriculum.older_buckets(scored(spark, sf_dir))
    return curriculum.split_curriculum(rows, ["doc_id"], [], "old", 50, 200, 0.7, 0.2, 0.1).select("doc_id", "bucket", "split")


@query(rf"""with {SCREENED}, r as (select source, score, score < 0.35 or shards_cached < 4 as blocked, hard_saturated as saturated from c),
  srep as (select string_agg(source, ',' order by score desc, source) as ranking, coalesce(string_agg(source, ',' order by score desc, source) filter (where blocked), '') as blockers, coalesce(string_agg(source, ',' order by score desc, source) filter (where saturated), '') as saturated from r)
  select ranking, blockers, saturated, concat_ws(' ', 'best:' || split_part(ranking, ',', 1), case when blockers <> '' then 'prefetch:' || blockers end, case when saturated <> '' then 'more_shards:' || saturated end) as advice from srep""")
def screening_report(spark, sf_dir):
    return rules.screening_report(screened(spark, sf_dir).where("source is not null"), "source")


# Tuning rounds --------------------------------------------------------------

def _results(spark, sf_dir):
    """A result of a sweep for each order: specs, scores and phases of all kinds."""
    k = F.col("o_orderkey")
    spec = F.concat(F.lit("r"), pick(k, 64, 32, 16), F.lit(":a"), 64 + k % 3, F.lit(":lr"), (k % 8 + 1).cast("string"), F.lit("e-5:d0:e"), pick(k, "0.5", "0.8", "1.2"))
    return load(spark, sf_dir, "orders").select("o_orderkey", F.when(k % 29 != 5, P.parse_spec(spec)).alias("p"), F.when(k % 17 != 3, (k % 21 - 10) / 2000.0).alias("mu"), ((k % 13 - 6) / 1000.0).alias("lcb"), pick(k, "micro", "confirm", "strong", "other").alias("phase"))


RESULTS = """r as (select o_orderkey, case when o_orderkey % 29 <> 5 then [64, 32, 16][o_orderkey % 3 + 1] end as r, 64 + o_orderkey % 3 as a, (o_orderkey % 8 + 1) * 1e-5 as lr, [0.5, 0.8, 1.2][o_orderkey % 3 + 1]::double as e, case when o_orderkey % 17 <> 3 then (o_orderkey % 21 - 10) / 2000.0 end as mu, (o_orderkey % 13 - 6) / 1000.0 as lcb,
  ['micro', 'confirm', 'strong', 'other'][o_orderkey % 4 + 1] as phase from orders)"""


@query(f"""with {RESULTS}, b as (select *, 'r' || r || ':a' || a || ':lr' || printf('%g', lr) || ':d0:e' as base, greatest(e, case when mu > 0 then 0.8 else 0.5 end) as ce from r where r is not null)
  select o_orderkey, coalesce(phase in ('confirm', 'strong') and mu >= 0.004 and lcb >= 0.003, false) as ready, mu is null or mu = 0 or mu < -0.002 as skip, base || printf('%g', ce) as confirm,
  case when ce < 1.5 then base || printf('%g', least(ce * 1.2, 1.5)) else '' end as second, base || printf('%g', greatest(e, 1.0)) as strong from b""")
def production_config(spark, sf_dir):
    """Whether a result is good enough for production, whether to confirm it, and the specs to do it with."""
    rows = _results(spark, sf_dir)
    skip, confirm, second, strong = rules.confirm_plan(F.col("p"), F.col("mu"))
    ready = rules.production_ready(F.col("phase"), F.col("mu"), F.col("lcb"))
    return rows.where("p is not null").select("o_orderkey", ready.alias("ready"), skip.alias("skip"), confirm.alias("confirm"), F.coalesce(second, F.lit("")).alias("second"), strong.alias("strong"))


@query(f"""with {RESULTS}, m(kind, k, f, e) as (values ('low', 1, 0.6, 0.5), ('low', 2, 0.8, 0.5), ('low', 3, 1.0, 0.5), ('near', 1, 0.85, 0.5), ('near', 2, 0.85, 0.8), ('near', 3, 1.0, 0.5), ('near', 4, 1.0, 0.8), ('near', 5, 1.15, 0.5), ('near', 6, 1.15, 0.8),
    ('good', 1, 0.9, 0.8), ('good', 2, 0.9, 1.0), ('good', 3, 1.0, 0.8), ('good', 4, 1.0, 1.0), ('good', 5, 1.1, 0.8), ('good', 6, 1.1, 1.0)),
  q as (select *, coalesce(mu, 0) = 0 or mu < -0.001 as low from r where r is not null),
  x as (select o_orderkey, 0 as k, r, a, lr, e from q union all select o_orderkey, k, r, a, lr * f, m.e from q join m on kind = case when low then 'low' when mu < 0 then 'near' else 'good' end
    union all select o_orderkey, 7, case r when 64 then 32 else 64 end, 64, lr, 0.5 from q where low and r in (32, 64) union all select o_orderkey, 8, 64, 128, lr * 0.8, 0.5 from q where low and r = 64),
  seed(k, spec) as (values (1, 'r64:a64:lr5e-5:d0.0:e0.5'), (2, 'r64:a128:lr5e-5:d0.0:e0.5'), (3, 'r32:a64:lr5e-5:d0.0:e0.5'), (4, 'r64:a64:lr8e-5:d0.0:e0.5'), (5, 'r64:a64:lr3e-5:d0.0:e0.5')),
  s as (select o_orderkey, k, 'r' || r || ':a' || a || ':lr' || printf('%g', lr) || ':d0:e' || printf('%g', e) as spec from x union all select o_orderkey, k, spec from r, seed where r is null), f as (select o_orderkey, spec, min(k) as k from s group by all), n as (select *, row_number() over (partition by o_orderkey order by k) as z from f)
  select o_orderkey, string_agg(spec, ' ' order by z) as specs from n where z <= 4 group by o_orderkey""")
def next_candidates(spark, sf_dir):
    """At most four different specs to try next: around the best so far, or the seeds of a first round."""
    # A column of its own, so that the candidates are not made again for each comparison.
    rows = _results(spark, sf_dir).withColumn("c", rules.candidate_specs(F.col("p"), F.col("mu")))
    return rows.select("o_orderkey", F.array_join(rules.distinct_specs(F.col("c"), 4), " ").alias("specs"))


@query("""select o_orderkey, case when o_orderkey % 2 = 0 then 'arg/' || o_orderkey when o_orderkey % 3 = 0 then 'file/' || o_custkey else '' end as repo from orders""")
def resolved_refs(spark, sf_dir):
    """The model to submit: arguments win over the verdict file."""
    arg = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("arg/"), "o_orderkey"))
    file = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("file/"), "o_custkey"))
    return load(spark, sf_dir, "orders").select("o_orderkey", F.coalesce(arg, file, F.lit("")).alias("repo"))


@query("""with r as (select l_orderkey, l_linenumber, case when l_returnflag = 'A' then -999 else l_extendedprice end as a, case when l_linestatus = 'F' then -999 else l_discount end as b, case when l_linenumber = 2 then 999 else l_tax end as c from lineitem)
  select l_orderkey, l_linenumber, row_number() over (partition by l_orderkey order by a desc, b desc, c, l_linenumber)::bigint as place from r""")
def ranked_results(spark, sf_dir):
    """Results by bound, mean and loss, where missing ones rank last."""
    lcb, mu = F.when(F.col("l_returnflag") != "A", F.col("l_extendedprice")), F.when(F.col("l_linestatus") != "F", F.col("l_discount"))
    loss = F.when(F.col("l_linenumber") != 2, F.col("l_tax"))
    keys = [F.coalesce(lcb, F.lit(-999.0)).desc(), F.coalesce(mu, F.lit(-999.0)).desc(), F.coalesce(loss, F.lit(999.0)), "l_linenumber"]
    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*keys))
    return load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", place.cast("long").alias("place"))


@query("""select l_orderkey, coalesce(max(case when l_returnflag = 'R' then 'best_adapter' end), 'checkpoint-' || max(l_linenumber * 100)) as path from lineitem group by l_orderkey""")
def checkpoint_pick(spark, sf_dir):
    """The best adapter where there is one, else the checkpoint of the highest step."""
    best = F.when(F.col("l_returnflag") == "R", "best_adapter")
    rows = load(spark, sf_dir, "lineitem").select("l_orderkey", best.alias("best"), F.concat(F.lit("checkpoint-"), F.col("l_linenumber") * 100).alias("path"))
    step = F.regexp_extract("path", r"checkpoint-(\d+)", 1).cast("long")
    return rows.groupBy("l_orderkey").agg(F.coalesce(F.max("best"), F.max_by("path", step)).alias("path"))


# Admission, queues, histories -----------------------------------------------

@query("""with seen as (select user_id from events where event_type = 'purchase' and event_id % 50 = 0), done as (select 'r' || (event_id // 3) as repo from events where event_type = 'error'), c as (select user_id, event_id, 'r' || (event_id // 3) as repo, ts from events where event_type = 'click')
  select user_id, arg_max(event_id, (ts, event_id)) as event_id from c where user_id not in (select user_id from seen) group by user_id having arg_max(repo, (ts, event_id)) not in (select repo from done)""")
def admissions(spark, sf_dir):
    """The latest reveal of keys that were not seen, unless its repository is finished."""
    ev = load(spark, sf_dir, "events").withColumn("repo", F.concat(F.lit("r"), F.floor(F.col("event_id") / 3)))
    last = records.latest(ev.where("event_type = 'click'"), ["user_id"], [F.col("ts"), F.col("event_id")], ["event_id", "repo"])
    fresh = shards.not_yet(last, ev.where("event_type = 'purchase' and event_id % 50 = 0"), "user_id")
    return shards.not_yet(fresh, ev.where("event_type = 'error'"), "repo").select("user_id", "event_id")


@query("""with q as (select o_custkey, o_orderkey, o_orderkey % 20 as repo, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as ord, o_orderkey % 5 as retry from orders), f as (select o_custkey, o_orderkey, repo, retry + 1 as retry from q where ord = 1),
  k as (select o_custkey, o_orderkey, retry, -1 as ord from f where retry <= 3 union all select q.o_custkey, q.o_orderkey, q.retry, q.ord from q join f using (o_custkey) where q.ord > 1 and q.repo <> f.repo)
  select o_custkey, o_orderkey, retry::bigint as retry, row_number() over (partition by o_custkey order by ord)::bigint as place from k""")
def requeue_front(spark, sf_dir):
    """Queues after the first entry of each has failed for a passing reason."""
    at = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))
    q = load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", (F.col("o_orderkey") % 20).alias("repo"), (F.col("o_orderkey") % 5).alias("retry"), at.cast("long").alias("ord"))
    out = rules.requeued(q.where("ord > 1"), q.where("ord = 1"), "o_custkey", "ord", "repo", 3)
    return out.select("o_custkey", "o_orderkey", "retry", F.col("place").cast("long").alias("place"))


@query("""select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by fresh desc, o_orderdate desc, o_orderkey desc)::bigint as place from (select *, o_orderstatus = 'P' as fresh from orders) qualify place <= 6""")
def history_trim(spark, sf_dir):
    """New rows before the old ones, and of all the first six."""
    new = F.when(F.col("o_orderstatus") == "P", 0).otherwise(1)
    w = Window.partitionBy("o_custkey").orderBy(new, F.col("o_orderdate").desc(), F.col("o_orderkey").desc())
    return load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.row_number().over(w).alias("place")).where("place <= 6").withColumn("place", F.col("place").cast("long"))


@query("""select o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) as first_key from orders where md5(o_orderkey::varchar) like 'a%' group by o_custkey""")
def first_with_prefix(spark, sf_dir):
    """The first commit whose hash starts as asked."""
    rows = load(spark, sf_dir, "orders").where(F.md5(F.col("o_orderkey").cast("string").cast("binary")).startswith("a"))
    return rows.groupBy("o_custkey").agg(F.min_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("first_key"))


@query("""select o.o_orderkey, coalesce(l.n, 0)::bigint as duels, coalesce(l.top, -1) as top from orders o left join (select l_orderkey, count(*) as n, round(max(l_extendedprice), 6) as top from lineitem group by l_orderkey) l on l_orderkey = o_orderkey where o.o_orderstatus = 'F'""")
def history_rows(spark, sf_dir):
    """Events of a history with the dashboard's row of the same challenge."""
    rows = load(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.round(F.max("l_extendedprice"), 6).alias("top"))
    h = load(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    return h.join(rows, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", F.coalesce("n", F.lit(0)).alias("duels"), F.coalesce("top", F.lit(-1.0)).alias("top"))


@query("""with recursive o as (select o_orderkey as node, (o_orderkey * 7 + 3) // 11 as parent, o_totalprice > 150000 as good from orders), w as (select node as start, node, 0 as depth, [node] as path from o union all select w.start, o.parent, w.depth + 1, list_append(w.path, o.parent) from w join o on o.node = w.node where w.depth < 6 and not list_contains(w.path, o.parent))
  select start, coalesce(arg_min(w.node, depth) filter (where depth > 0 and good), -1) as ancestor from w left join o on o.node = w.node group by start""")
def passing_ancestor(spark, sf_dir):
    """The nearest ancestor that passes, or the seed (-1) where none does."""
    o = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("node"), (F.col("o_totalprice") > 150000).alias("good"))
    edges = o.select("node", F.expr("(node * 7 + 3) div 11").alias("parent"))
    chain = records.ancestors(spark, edges, o.select("node"), 6).join(o.select("node", "good"), "node", "left")
    hit = (F.col("depth") > 0) & F.coalesce("good", F.lit(False))
    return chain.groupBy("start").agg(F.coalesce(F.min_by("node", F.when(hit, F.col("depth"))), F.lit(-1)).alias("ancestor"))


@query("""select doc_id, 'public' as component, row_number() over (order by md5('pub:' || doc_id), doc_id)::bigint as pos from documents qualify pos <= 60
  union all select doc_id, 'private', 60 + row_number() over (order by md5('priv:' || doc_id), doc_id) as pos from documents where source is not null qualify pos <= 100""")
def holdout_union(spark, sf_dir):
    """A public and a private holdout, one after the other, with what each row is."""
    from .operators.sampling import take

    docs = load(spark, sf_dir, "documents").select("doc_id", "source")
    a = take(docs.select("doc_id"), 60, "pub", "doc_id").select("doc_id", F.lit("public").alias("component"), F.col("rk").cast("long").alias("pos"))
    b = take(docs.where("source is not null").select("doc_id"), 40, "priv", "doc_id").select("doc_id", F.lit("private").alias("component"), (F.col("rk") + 60).cast("long").alias("pos"))
    return a.unionByName(b)


@query("""select user_id, event_type, count_if(event_id % 2 = 0)::bigint as before, count_if(event_id % 2 = 0) = 0 as added from events group by user_id, event_type""")
def seen_pairs(spark, sf_dir):
    """Pairs of the history (even events) and of the latest run (odd ones): how often they were seen before, and which the run adds."""
    ev = load(spark, sf_dir, "events").select("user_id", "event_type", (F.col("event_id") % 2 == 0).alias("old"))
    seen = ev.groupBy("user_id", "event_type").agg(F.count_if("old").alias("before"))
    return seen.withColumn("added", F.col("before") == 0)


@query("""with s as (select s_suppkey, s_name, s_acctbal, row_number() over (order by s_suppkey) - 1 as uid, count(*) over () as n from supplier)
  select uid::int as uid, s_name as key, case when uid < n // 2 then s_acctbal else 0.0 end as emission, case when uid < n - 3 and s_suppkey % 5 > 0 then 'c' || s_suppkey else '' end as owner from s""")
def zipped_dimension(spark, sf_dir):
    """Three parallel lists of unequal length as one table, zipped by position."""
    numbered = running_offset(load(spark, sf_dir, "supplier").withColumn("one", F.lit(1).cast("long")), "s_suppkey", "one", out="uid")
    n = numbered.agg(F.count("*").alias("n"))
    rows = numbered.crossJoin(F.broadcast(n))  # one row
    owner = F.when(F.col("s_suppkey") % 5 > 0, F.concat(F.lit("c"), "s_suppkey")).otherwise("")
    uid = F.col("uid").cast("int").alias("uid")
    zipped = rules.zipped_dimension(
        rows.select(uid, F.col("s_name").alias("value")), rows.where(F.col("uid") < F.floor(F.col("n") / 2)).select(uid, F.col("s_acctbal").alias("value")),
        rows.where(F.col("uid") < F.col("n") - 3).select(uid, owner.alias("value")),
    )
    return zipped.select("uid", "key", "emission", F.coalesce("owner", F.lit("")).alias("owner"))


@query("""with g as (select event_id, user_id, date_sub('millisecond', lag(ts) over (partition by user_id order by ts, event_id), ts) as ms from events) select event_id, user_id, ms > 600000 as alert from g where ms > 60000""")
def slow_ticks(spark, sf_dir):
    """Ticks that took more than a minute, with an alert for more than ten."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    ev = load(spark, sf_dir, "events").withColumn("ms", F.timestamp_diff("MILLISECOND", F.lag("ts").over(w), F.col("ts")))
    return ev.where("ms > 60000").select("event_id", "user_id", (F.col("ms") > 600000).alias("alert"))


@query("""with l as (select user_id, ts, event_id, case when event_id % 4 = 0 then 'probe ok=True' when event_id % 4 = 1 then 'probe ok=False reason=' || event_type else 'heartbeat' end as line from events),
  r as (select user_id, case when line like '%ok=True%' then 'ok' else regexp_extract(line, 'reason=(\\w+)', 1) end as what, row_number() over (partition by user_id order by ts desc, event_id desc) as z from l where line like 'probe%')
  select user_id, what, count(*)::bigint as n, count_if(z <= 10)::bigint as in_last_10 from r group by all""".replace("\\\\", "\\"))
def probe_log(spark, sf_dir):
    """Log lines of one pattern counted by outcome, overall and among the last ten."""
    k = F.col("event_id") % 4
    line = F.when(k == 0, "probe ok=True").when(k == 1, F.concat(F.lit("probe ok=False reason="), "event_type")).otherwise("heartbeat")
    rows = load(spark, sf_dir, "events").select("user_id", "ts", "event_id", line.alias("line")).where(F.col("line").rlike("^probe"))
    what = F.when(F.col("line").contains("ok=True"), "ok").otherwise(F.regexp_extract("line", r"reason=(\w+)", 1))
    z = F.row_number().over(Window.partitionBy("user_id").orderBy(F.col("ts").desc(), F.col("event_id").desc()))
    return rows.select("user_id", what.alias("what"), z.alias("z")).groupBy("user_id", "what").agg(F.count("*").alias("n"), F.count_if(F.col("z") <= 10).alias("in_last_10"))


# Sweeps of models -----------------------------------------------------------

def _config_counts(docs, hold):
    """Token counts and totals of the models: one of each language, and one (``all``) of all, without the holdout."""
    rest = docs.join(hold.select("doc_id"), "doc_id", "left_anti")
    counts = written(word_counts_by(rest, "lang", "ids"))
    counts = counts.where("lang is not null").select(F.col("lang").alias("config"), "tok", "c").unionByName(counts.groupBy("tok").agg(F.sum("c").alias("c")).withColumn("config", F.lit("all")))
    return counts, counts.groupBy("config").agg(F.sum("c").alias("total"), F.count("*").alias("types"))


def _config_losses(hold, counts, totals):
    """(config, pos, loss) of the holdout's texts under each model of ``totals``."""
    per = hold.select("pos", F.explode("ids").alias("tok")).groupBy("pos", "tok").agg(F.count("*").alias("k"))  # a holdout
    each = per.crossJoin(F.broadcast(totals)).join(counts, ["config", "tok"], "left")  # a row for each configuration
    nll = -F.log((F.coalesce("c", F.lit(0)) + 1) / (F.col("total") + F.col("types")))
    return each.groupBy("config", "pos").agg((F.sum(F.col("k") * nll) / F.sum("k")).alias("loss"))


@query(rf"""with {TOK}, full_ as (select * from tok where len(ids) > 0), hold as (select *, row_number() over (order by md5('sw:' || doc_id), doc_id) - 1 as pos from full_ qualify pos < 100), rest as (select * from full_ where doc_id not in (select doc_id from hold)),
  cfg as (select 'all' as config union all select distinct lang from rest where lang is not null), cc as (select config, t, count(*) as c from (select config, unnest(ids) as t from rest join cfg on config = 'all' or config = lang) group by all),
  ct as (select config, sum(c) as total, count(*) as types from cc group by config), hk as (select doc_id, t, count(*) as k from (select doc_id, unnest(ids) as t from hold) group by all),
  loss as (select ct.config, doc_id, sum(k * -ln((coalesce(c, 0) + 1) / (total + types))) / sum(k) as loss from hk cross join ct left join cc on cc.config = ct.config and cc.t = hk.t group by all),
  d as (select l.config, hold.pos, king.loss - l.loss as diff, l.loss from loss l join loss king on king.doc_id = l.doc_id and king.config = 'all' join hold on hold.doc_id = l.doc_id where l.config <> 'all'),
  sl as (select config, r.range as replicate, s.range as slot from (select distinct config from d) c, range(1000) r, range(100) s),
  mm as (select sl.config, replicate, avg(diff) as mean from sl join d on d.config = sl.config and d.pos = ('0x' || substr(md5('sw:' || sl.config || ':' || replicate || ':' || slot), 1, 15))::bigint % 100 group by all),
  b as (select config, quantile_cont(mean, 0.01) as lcb from mm group by config), p as (select config, avg(diff) as mu, avg(loss) as loss from d group by config)
  select config, round(mu, 6) as mu_hat, round(lcb, 6) as lcb, round(loss, 6) as eval_loss, row_number() over (order by lcb desc, mu desc, loss, config)::bigint as place from p join b using (config)""")
def config_sweep(spark, sf_dir):
    """Every configuration (here a model for each language) against the king on one holdout, ranked."""
    from .operators.sampling import take

    docs = documents(spark, sf_dir, "lang")
    hold = written(take(docs, 100, "sw", "doc_id").withColumn("pos", F.col("rk").cast("long") - 1))
    loss = _config_losses(hold, *_config_counts(docs, hold))
    king = loss.where("config = 'all'").select("pos", F.col("loss").alias("king"))
    d = spark.createDataFrame(loss.where("config <> 'all'").join(king, "pos").select("config", "pos", "loss", (F.col("king") - F.col("loss")).alias("diff")).toArrow())  # 100 rows for each configuration
    means = evaluation.bootstrap_means(spark, d, "pos", 1000, "sw", ["config"])
    out = d.groupBy("config").agg(F.avg("diff").alias("mu"), F.avg("loss").alias("eval_loss")).join(means.groupBy("config").agg(F.percentile("mean", F.lit(ALPHA)).alias("lcb")), "config")
    place = F.row_number().over(Window.orderBy(F.col("lcb").desc(), F.col("mu").desc(), "eval_loss", "config"))  # configurations
    return out.select("config", F.round("mu", 6).alias("mu_hat"), r6("lcb"), r6("eval_loss"), place.cast("long").alias("place"))


def _bounds_sql(name: str, source: str, seed: str) -> str:
    return f"""{name}_n as (select config, count(*) as n from {source} group by config), {name}_s as (select config, n, r.range as replicate, unnest(range(0, n)) as slot from {name}_n, range(400) r),
  {name}_m as (select s.config, replicate, avg(diff) as mean from {name}_s s join {source} d on d.config = s.config and d.pos = ('0x' || substr(md5('{seed}:' || s.config || ':' || replicate || ':' || slot), 1, 15))::bigint % n group by all),
  {name} as (select config, n, mu, loss, low, high from (select config, quantile_cont(mean, 0.05) as low, quantile_cont(mean, 0.95) as high from {name}_m group by config) join (select config, count(*) as n, avg(diff) as mu, avg(loss) as loss from {source} group by config) using (config))"""


@query(rf"""with {TOK}, full_ as (select * from tok where len(ids) > 0), hold as (select *, row_number() over (order by md5('two:' || doc_id), doc_id) - 1 as pos from full_ qualify pos < 160), rest as (select * from full_ where doc_id not in (select doc_id from hold)),
  cfg as (select 'all' as config union all select distinct lang from rest where lang is not null), cc as (select config, t, count(*) as c from (select config, unnest(ids) as t from rest join cfg on config = 'all' or config = lang) group by all),
  ct as (select config, sum(c) as total, count(*) as types from cc group by config), hk as (select pos, t, count(*) as k from (select pos, unnest(ids) as t from hold) group by all),
  loss as (select ct.config, pos, sum(k * -ln((coalesce(c, 0) + 1) / (total + types))) / sum(k) as loss from hk cross join ct left join cc on cc.config = ct.config and cc.t = hk.t group by all),
  d as (select l.config, l.pos, king.loss - l.loss as diff, l.loss from loss l join loss king on king.pos = l.pos and king.config = 'all' where l.config <> 'all'),
  early as (select * from d where pos < 32), {_bounds_sql("micro", "early", "two:micro")},
  going as (select config from micro where high >= (select max(low) from micro)), late as (select d.* from d join going using (config)), {_bounds_sql("whole", "late", "two:full")},
  u as (select *, 'micro' as phase from micro union all select *, 'full' from whole)
  select config, phase, n::bigint as n, round(mu, 6) as mu_hat, round(low, 6) as lcb, round(high, 6) as ucb, round(loss, 6) as eval_loss, row_number() over (partition by phase order by low desc, mu desc, loss, config)::bigint as place from u""")
def two_phase_sweep(spark, sf_dir):
    """All configurations on 32 texts of the holdout, then those that can still win on all 160, the first losses used again."""
    docs = documents(spark, sf_dir, "lang")
    hold = written(sampling.take(docs, 160, "two", "doc_id").withColumn("pos", F.col("rk").cast("long") - 1))
    counts, totals = (written(x) for x in _config_counts(docs, hold))

    def score(configs, low, high):
        some = totals.join(configs.unionByName(spark.createDataFrame([("all",)], "config string")), "config", "left_semi")
        loss = written(_config_losses(hold.where((F.col("pos") >= low) & (F.col("pos") < high)), counts, some))
        king = loss.where("config = 'all'").select("pos", F.col("loss").alias("king"))
        return loss.where("config <> 'all'").join(king, "pos").select("config", "pos", "loss", (F.col("king") - F.col("loss")).alias("diff"))

    out = sweeps.two_phase_sweep(totals.where("config <> 'all'").select("config"), score, hold.count(), 400, "two", 0.05, 32)
    return out.select("config", "phase", "n", r6("mu").alias("mu_hat"), r6("low").alias("lcb"), r6("high").alias("ucb"), r6("loss").alias("eval_loss"), "place")
