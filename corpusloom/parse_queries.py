"""Queries of the parsers; their SQL twins give the values the texts were made of, without parsing."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .functions import parsing as P
from .functions.hashing import number
from .operators.digests import listed_sha256
from .tables import load, written

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLE[f.__name__] = f, sql
        return f

    return add


def s(text: str):
    return F.lit(text)


# Sweep specs ----------------------------------------------------------------

def specs(spark, sf_dir):
    """A spec for each line: rank, alpha and rate always, the other parts on some lines only."""
    q, n = F.col("l_quantity").cast("int"), F.col("l_linenumber")
    text = F.concat(
        s("r"), q, s(":a"), 2 * q, s(":lr"), n, s("e-"), 3 + n % 3,
        F.when(n % 2 == 0, F.concat(s(":d0.0"), n)).otherwise(""), F.when(n % 3 == 0, F.concat(s(":e"), n, s(".5"))).otherwise(""),
    )
    return load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.when(n == 7, "r1:broken").otherwise(text).alias("spec"))


PARTS = """select l_orderkey, l_linenumber, l_quantity::int as r, 2 * l_quantity::int as a, (l_linenumber || 'e-' || (3 + l_linenumber % 3))::double as lr,
  case when l_linenumber % 2 = 0 then l_linenumber / 100.0 else 0 end::double as dropout, case when l_linenumber % 3 = 0 then l_linenumber + 0.5 else 0.5 end::double as epochs from lineitem"""


@query(f"""select l_orderkey, l_linenumber, case when l_linenumber < 7 then r else -1 end as r, case when l_linenumber < 7 then a else -1 end as a, round(case when l_linenumber < 7 then lr else -1 end, 9) as lr,
  case when l_linenumber < 7 then dropout else -1 end as dropout, case when l_linenumber < 7 then epochs else -1 end as epochs from ({PARTS})""")
def sweep_specs(spark, sf_dir):
    rows = specs(spark, sf_dir).withColumn("p", P.parse_spec(F.col("spec")))
    part = lambda c: F.coalesce(F.col(f"p.{c}"), F.lit(-1))
    return rows.select("l_orderkey", "l_linenumber", part("r").alias("r"), part("a").alias("a"), F.round(part("lr"), 9).alias("lr"), part("dropout").alias("dropout"), part("epochs").alias("epochs"))


@query(f"""select l_orderkey, l_linenumber, 'r' || r || ':a' || a || ':lr' || printf('%g', lr) || ':d' || printf('%g', dropout) || ':e' || printf('%g', epochs) as spec from ({PARTS}) where l_linenumber < 7""")
def formatted_specs(spark, sf_dir):
    rows = specs(spark, sf_dir).withColumn("p", P.parse_spec(F.col("spec"))).where("p is not null")
    return rows.select("l_orderkey", "l_linenumber", P.format_spec(*(F.col(f"p.{c}") for c in ("r", "a", "lr", "dropout", "epochs"))).alias("spec"))


@query(f"""select l_orderkey, l_linenumber, case when l_linenumber in (3, 7) then 64 else r end as r, case when l_linenumber in (3, 7) then 64 else a end as a,
  round(case when l_linenumber in (3, 7) then 5e-5 else lr end, 9) as lr from ({PARTS})""")
def configurations(spark, sf_dir):
    """Columns on line 1, a broken label on line 3, no text on line 7, labels on lines 2 and 5, specs on the others."""
    rows = specs(spark, sf_dir).withColumn("n", F.col("l_linenumber"))
    own = F.when(F.col("n") == 1, P.parse_spec(F.col("spec")))
    text = F.when(F.col("n").isin(2, 5), F.replace("spec", s(":"), s("_"))).when(F.col("n") == 3, "no_label").when(F.col("n") == 7, "").otherwise(F.col("spec"))
    rows = rows.withColumn("p", P.configuration(own, text))
    return rows.select("l_orderkey", "l_linenumber", F.col("p.r").alias("r"), F.col("p.a").alias("a"), F.round("p.lr", 9).alias("lr"))


# Settings and keys ----------------------------------------------------------

@query("""select p_partkey, case when p_size % 5 > 0 then p_brand else '' end as name, case when p_size % 5 > 0 then p_size / 100.0 else -1.0 end::double as weight,
  case when p_size % 5 in (1, 2) then round(p_size / 10.0, 6) else -1 end::double as general, p_size % 5 in (1, 2) as three from part""")
def settings(spark, sf_dir):
    """``brand = weight`` settings and bucket mixes, some of them broken."""
    size = F.col("p_size")
    weight = F.when(size % 5 == 0, F.concat(s("="), size)).otherwise(F.concat(s(" "), "p_brand", s(" = "), size / 100.0))
    mix = F.when(size % 5 == 0, "x").when(size % 5 < 3, F.concat("p_brand", s("="), size / 10.0, s(": 0.2 :0.1"))).otherwise(F.concat("p_brand", s("=0.5:z:"), size))
    name, value = P.setting(weight)
    shares = P.bucket_mix(mix)[1]
    rows = load(spark, sf_dir, "part").select("p_partkey", F.coalesce(name, s("")).alias("name"), F.coalesce(value.try_cast("double"), F.lit(-1.0)).alias("weight"), shares.alias("m"))
    return rows.select("p_partkey", "name", "weight", F.coalesce(F.round(F.col("m")[0], 6), F.lit(-1.0)).alias("general"), F.col("m").isNotNull().alias("three"))


@query("""select page_id, case when page_id % 9 = 0 then 'https://store.example/root' else regexp_extract(url, '^(https?://[^/?#]+)', 1) || '/pool' end as base,
  case when page_id % 4 = 0 then url else regexp_extract(url, '^(https?://[^/?#]+)', 1) || '/pool/k' || page_id end as address, 'mirror/data/' || case when page_id % 3 = 0 then 'other/' else '' end || 'f' || page_id || '.parquet' as dest from pages""")
def addresses(spark, sf_dir):
    host = F.regexp_extract("url", "^(https?://[^/?#]+)", 1)
    manifest = F.when(F.col("page_id") % 9 == 0, "no address").otherwise(F.concat(host, s("/pool/dataset/v2/manifest.json?x=1")))
    key = F.when(F.col("page_id") % 4 == 0, F.concat(s(" "), "url")).otherwise(F.concat(s("/k"), "page_id"))
    path = F.concat(F.when(F.col("page_id") % 3 == 0, "other/").otherwise("raw/en/"), s("f"), "page_id", s(".parquet"))
    return load(spark, sf_dir, "pages").select(
        "page_id", P.url_base(manifest, "https://store.example/root").alias("base"), P.url_join(F.concat(host, s("/pool/")), key).alias("address"),
        P.destination(s("mirror/data/"), s("raw/en"), path).alias("dest"),
    )


def _reveals(spark, sf_dir):
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    hotkey = F.substring(F.translate(F.sha2(cust.cast("string"), 256), "0", "z"), 1, 48)
    digest = F.concat(s("sha256:"), F.sha2(key.cast("string"), 256))
    repo = F.when(key % 11 == 0, "bad name/x").otherwise(F.concat(s("team-"), cust % 10, s("/m"), key))
    return load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", hotkey.alias("hotkey"), digest.alias("digest"), repo.alias("repo"))


@query("""select o_orderkey, o_orderkey % 11 <> 0 as valid, case when o_orderkey % 11 = 0 then '' else 'v4|team-' || (o_custkey % 10) || '/m' || o_orderkey || '|sha256:' || sha256(o_orderkey::varchar) || '|' || substr(translate(sha256(o_custkey::varchar), '0', 'z'), 1, 48) end as v4,
  case when o_orderkey % 11 = 0 or o_orderkey % 5 = 0 then '' else sha256(o_custkey::varchar) end as king from orders""")
def reveals(spark, sf_dir):
    """Built as v4 and as v3, and the v3 read back; every fifth king's digest is malformed."""
    rows = _reveals(spark, sf_dir).withColumn("king", F.when(F.col("o_orderkey") % 5 == 0, "md5:1").otherwise(F.concat(s("sha256:"), F.sha2(F.col("o_custkey").cast("string"), 256))))
    c = {x: F.col(x) for x in ("repo", "digest", "hotkey", "king")}
    rows = rows.withColumn("v4", P.build_reveal(c["repo"], c["digest"], c["hotkey"])).withColumn("v3", P.parse_reveal(P.build_reveal(c["repo"], c["digest"], c["hotkey"], c["king"]), "v3"))
    return rows.select("o_orderkey", P.valid_reference(c["repo"], c["digest"]).alias("valid"), F.coalesce("v4", s("")).alias("v4"), F.coalesce(F.substring("v3.king", 8, 64), s("")).alias("king"))


@query("""with p as (select o_custkey, o_orderkey, o_orderdate, 'team-' || (o_custkey % 10) || '/m' || o_orderkey as repo, 'sha256:' || sha256(o_orderkey::varchar) as digest from orders where o_orderkey % 7 <> 0 and o_orderkey % 11 <> 0)
  select o_custkey, arg_max(repo, (o_orderdate, o_orderkey)) as repo, arg_max(digest, (o_orderdate, o_orderkey)) as digest, count(*)::bigint as valid from p group by o_custkey""")
def latest_reveal(spark, sf_dir):
    """The last well-formed v4 reveal of each key; every seventh payload is of the older version."""
    rows = _reveals(spark, sf_dir)
    text = F.concat_ws("|", F.when(F.col("o_orderkey") % 7 == 0, "v3").otherwise("v4"), "repo", "digest", "hotkey")
    good = rows.withColumn("p", P.parse_reveal(text)).where("p is not null")
    by = F.struct("o_orderdate", "o_orderkey")
    return good.groupBy("o_custkey").agg(F.max_by("p.repo", by).alias("repo"), F.max_by("p.digest", by).alias("digest"), F.count("*").alias("valid"))


@query("""select doc_id, md5(case when doc_id % 3 = 0 then 'v4|' || doc_id else regexp_replace(coalesce(text, ''), '[^a-zA-Z ]', '', 'g') end) as text_md5 from documents""")
def commitments(spark, sf_dir):
    """Whole texts behind lengths of one, two and four bytes, as characters or as hex digits, and read back."""
    plain = F.regexp_replace(F.coalesce("text", s("")), "[^a-zA-Z ]", "")
    rows = load(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 3 == 0, F.concat(s("v4|"), "doc_id")).otherwise(plain).alias("t"))
    n = F.length("t")
    short = F.concat(F.char(4 * n), "t")
    two = F.concat(s("0x"), F.lpad(F.hex((4 * n + 1) % 256), 2, "0"), F.lpad(F.hex(F.floor((4 * n + 1) / 256)), 2, "0"), F.hex(F.col("t").cast("binary")))
    byte = lambda k: F.lpad(F.hex(F.pmod(F.floor((4 * n + 2) / 256**k), F.lit(256))), 2, "0")
    four = F.concat(s("0X"), *(byte(k) for k in range(4)), F.hex(F.col("t").cast("binary")))
    payload = F.when((F.col("doc_id") % 3 == 0) & (n > 0), short).when((F.col("doc_id") % 3 == 1) & (n < 1 << 14), two).otherwise(four)
    return rows.select("doc_id", F.md5(P.commitment_text(payload).cast("binary")).alias("text_md5"))


# Digests --------------------------------------------------------------------

@query("""with k as (select source, doc_id, 'shard-' || lpad((doc_id % 97)::varchar, 3, '0') || '/' || doc_id as key, sha256(coalesce(text, '')) as d from documents where source is not null)
  select source, sha256(string_agg(d, chr(10) order by d)) as set_digest, substr(sha256('{"shards": [' || string_agg('"' || key || '"', ', ' order by key) || '], "version": "v3"}'), 1, 16) as manifest_hash,
  substr(sha256(string_agg(key, chr(10) order by doc_id) || chr(10) || 'v3'), 1, 16) as ordered_hash from k group by source""")
def manifest_digests(spark, sf_dir):
    """Digest of a set of files, hash of a manifest's sorted keys and version, and the variant in listed order."""
    key = F.concat(s("shard-"), F.lpad((F.col("doc_id") % 97).cast("string"), 3, "0"), s("/"), "doc_id")
    rows = load(spark, sf_dir, "documents").where("source is not null").select("source", "doc_id", key.alias("key"), F.sha2(F.coalesce("text", s("")), 256).alias("d"))
    rows = written(rows)
    files = listed_sha256(rows, "source", ["d"], F.col("d"), "\n").select("source", F.col("sha256").alias("set_digest"))
    keys = listed_sha256(rows, "source", ["key"], F.concat(s('"'), "key", s('"')), ", ", '{"shards": [', '], "version": "v3"}')
    listed = listed_sha256(rows, "source", ["doc_id"], F.col("key"), "\n", tail="\nv3")
    short = lambda df, name: df.select("source", F.substring("sha256", 1, 16).alias(name))
    return files.join(short(keys, "manifest_hash"), "source").join(short(listed, "ordered_hash"), "source")


@query("""with w as (select source as name, count(*) as weight from documents where source is not null group by source) select substr(sha256('[' || string_agg('{"name": "' || name || '", "weight": ' || weight || '}', ', ' order by name) || ']'), 1, 16) as mix_hash, count(*)::bigint as n from w""")
def mix_hash(spark, sf_dir):
    """The hash of a mixture's settings in canonical order."""
    w = load(spark, sf_dir, "documents").where("source is not null").groupBy(F.col("source").alias("name")).agg(F.count("*").alias("weight"))
    one = F.concat(s('{"name": "'), "name", s('", "weight": '), "weight", s("}"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("name", one.alias("x")))), lambda v: v["x"])
    return w.agg(F.substring(F.sha2(F.concat(s("["), F.array_join(listed, ", "), s("]")), 256), 1, 16).alias("mix_hash"), F.count("*").alias("n"))


@query("""select regexp_extract(url, '://([^/?#]+)', 1) as host, substr(sha256(string_agg(sha256(substr(coalesce(html, ''), 1, 65536)), '' order by url, page_id)), 1, 24) as digest, count(*)::bigint as files from pages group by 1""")
def folder_digests(spark, sf_dir):
    """One digest for the files of a folder, in order of their names, each by its first 64 KiB."""
    rows = load(spark, sf_dir, "pages").select(F.regexp_extract("url", "://([^/?#]+)", 1).alias("host"), "url", "page_id", F.sha2(F.substring(F.coalesce("html", s("")), 1, 65536), 256).alias("d"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("url", "page_id", "d"))), lambda x: x["d"])
    return rows.groupBy("host").agg(F.substring(F.sha2(F.array_join(listed, ""), 256), 1, 24).alias("digest"), F.count("*").alias("files"))


@query("""select o_orderkey, tag, ('0x' || substr(md5(tag || ':' || o_orderkey || ':' || o_custkey), 1, 15))::bigint as seed, (('0x' || substr(md5(tag || ':' || o_orderkey || ':' || o_custkey), 1, 15))::bigint % 97)::bigint as shard
  from orders, (values ('public'), ('private'), ('bootstrap')) t(tag)""")
def derived_seeds(spark, sf_dir):
    """A seed for each purpose from a block and a key, and the shard it chooses."""
    rows = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.explode(F.array(s("public"), s("private"), s("bootstrap"))).alias("tag"))
    seed = number(F.md5(F.concat_ws(":", "tag", "o_orderkey", "o_custkey").cast("binary")))
    return rows.select("o_orderkey", "tag", seed.alias("seed"), F.pmod(seed, F.lit(97)).alias("shard"))


# Results, logs, sizes -------------------------------------------------------

@query("""with e as (select event_id, value, case event_type when 'click' then 'mmlu' when 'error' then 'piqa' when 'purchase' then 'arc_easy' else 'other' end as task, event_id % 6 as k from events)
  select event_id, task, round(case k when 0 then value when 1 then value + 1 when 2 then case when task in ('piqa', 'arc_easy') then value + 3 else value + 2 end
    when 3 then case when task in ('piqa', 'arc_easy') then -1 else value + 4 end when 4 then value + 5 else -1 end, 6) as score from e""")
def task_scores(spark, sf_dir):
    """The metric that counts of results in newer, older and partial forms."""
    k, v = F.col("event_id") % 6, F.col("value")
    t = F.col("event_type")
    task = F.when(t == "click", "mmlu").when(t == "error", "piqa").when(t == "purchase", "arc_easy").otherwise("other")
    m = P.task_metric(task)
    none = F.create_map().cast("map<string,double>")
    node = (
        F.when(k == 0, F.map_from_arrays(F.array(F.concat(m, s(",none")), m), F.array(v, v + 9))).when(k == 1, F.create_map(m, v + 1))
        .when(k == 2, F.create_map(s("acc,none"), v + 2, s("acc_norm,none"), v + 3)).when(k == 3, F.create_map(s("acc"), v + 4, s("f1"), v))
        .when(k == 4, F.create_map(s("f1"), v, s("acc,strict"), v + 5)).otherwise(none)
    )
    return load(spark, sf_dir, "events").select("event_id", task.alias("task"), F.round(F.coalesce(P.primary_metric(node, m), F.lit(-1.0)), 6).alias("score"))


@query("""with e as (select user_id, event_id, ts, event_id % 8 as k, round(value, 3) as v from events), l as (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as z from e qualify z <= 40)
  select user_id, coalesce(max(event_id) filter (where k = 0 and (ts, event_id) = m0), -1)::bigint as eval_done, coalesce(any_value('c' || event_id) filter (where k in (1, 2) and (ts, event_id) = m12), '') as config,
  coalesce(max(event_id) filter (where k in (3, 4) and (ts, event_id) = m34), -1)::bigint as scoring, coalesce(max(event_id) filter (where k = 5 and (ts, event_id) = m5), -1)::bigint as step, coalesce(max(v) filter (where k = 6 and (ts, event_id) = m6), -1) as loss
  from (select *, max((ts, event_id)) filter (where k = 0) over w as m0, max((ts, event_id)) filter (where k in (1, 2)) over w as m12, max((ts, event_id)) filter (where k in (3, 4)) over w as m34,
    max((ts, event_id)) filter (where k = 5) over w as m5, max((ts, event_id)) filter (where k = 6) over w as m6 from l window w as (partition by user_id)) group by user_id""")
def log_progress(spark, sf_dir):
    """What the last 40 lines of each log tell, by the last line of each kind."""
    e, k, v = F.col("event_id"), F.col("event_id") % 8, F.round("value", 3).cast("string")
    line = (
        F.when(k == 0, F.concat(s("x eval "), e, s("/99999 | mu_hat=-1e-3"))).when(k == 1, F.concat(s("Micro-Screen: c"), e, s(" now")))
        .when(k == 2, F.concat(s("=== lora sweep: c"), e)).when(k == 3, F.concat(s("mixture scoring web: n="), e))
        .when(k == 4, F.concat(s("mixture scoring web "), e, s("/9 (1.5%)"))).when(k == 5, F.concat(s(" 12%|## [ "), e, s("/77 left")))
        .when(k == 6, F.concat(s("{'loss': '"), v, s("', 'grad': 1, 'epoch': '0.5'}"))).otherwise("nothing to see")
    )
    z = F.row_number().over(Window.partitionBy("user_id").orderBy(F.col("ts").desc(), F.col("event_id").desc()))
    tail = load(spark, sf_dir, "events").select("user_id", "event_id", "ts", line.alias("line"), z.alias("z")).where("z <= 40")
    at = F.struct("ts", "event_id")

    def last(value):
        return F.max_by(value, F.when(value.isNotNull(), at))

    part = lambda name, g: P.log_part(F.col("line"), name, g)
    out = tail.groupBy("user_id").agg(
        last(part("eval", 1)).alias("eval_done"), last(F.coalesce(part("micro", 1), part("sweep", 1))).alias("config"),
        last(F.coalesce(part("score_batch", 2), part("scoring", 2))).alias("scoring"), last(part("train_step", 2)).alias("step"), last(part("loss", 1)).alias("loss"),
    )
    n = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(-1)).alias(c)
    return out.select("user_id", n("eval_done"), F.coalesce("config", s("")).alias("config"), n("scoring"), n("step"), F.coalesce(F.col("loss").cast("double"), F.lit(-1.0)).alias("loss"))


@query("""with b as (select doc_id, n_chars * 4 * (doc_id + 1) as n from documents), u as (select doc_id, n, case when n < 1024 then 0 when n < 1048576 then 1 when n < 1073741824 then 2 when n < 1099511627776 then 3 else 4 end as u from b)
  select doc_id, printf('%.2f ', round_even(n / power(1024, u), 2)) || ['B', 'KiB', 'MiB', 'GiB', 'TiB'][u + 1] as size, round(case when n % 7 > 0 then n / 1048576.0 / (n % 7) else 0 end, 6) as mib_s,
  case when n % 9999 < 60 then (n % 9999) || 's' when n % 9999 < 3600 then (n % 9999 // 60) || 'm ' || (n % 9999 % 60) || 's' else (n % 9999 // 3600) || 'h ' || (n % 9999 % 3600 // 60) || 'm' end as lasted from u""")
def humanised_sizes(spark, sf_dir):
    """Sizes from bytes to terabytes, rates and durations as people read them."""
    n = F.col("n_chars") * 4 * (F.col("doc_id") + 1)
    return load(spark, sf_dir, "documents").select(
        "doc_id", P.file_size_text(n).alias("size"), F.round(P.rate_mib(n, n % 7), 6).alias("mib_s"), P.duration_text(n % 9999).alias("lasted")
    )


@query("""with r as (select 'runs/' || event_type || '/' || user_id || '-' || strftime(ts, '%Y%m%dT%H%M%SZ') || '/' as prefix, date_trunc('second', ts) as ts, event_id, user_id from events), n as (select max(date_trunc('second', ts)) as now from events)
  select case when event_id % 10 = 0 then 'runs/' || user_id || '/broken' else prefix end as prefix, count(*)::bigint as files,
  case when event_id % 10 = 0 then 'skip' when ts < now - interval 24 hour then 'purge' else 'keep' end as action from r, n group by all""")
def run_prefixes(spark, sf_dir):
    """Run folders with their time, which decides whether they are purged; folders without one are skipped."""
    name = F.when(F.col("event_id") % 10 == 0, F.concat(s("runs/"), "user_id", s("/broken"))).otherwise(
        F.concat(s("runs/"), "event_type", s("/"), "user_id", s("-"), F.date_format("ts", "yyyyMMdd'T'HHmmss'Z'"), s("/")))
    rows = load(spark, sf_dir, "events").select(name.alias("prefix"), F.date_trunc("second", F.col("ts").cast("timestamp")).alias("ts"))
    now = rows.agg(F.max("ts").alias("now"))
    at = P.run_time(F.col("prefix"))
    action = F.when(at.isNull(), "skip").when(at < F.expr("now - interval 24 hours"), "purge").otherwise("keep")
    return rows.crossJoin(F.broadcast(now)).withColumn("action", action).groupBy("prefix", "action").agg(F.count("*").alias("files"))  # one row


@query("""with n as (select max(date_trunc('second', ts)) as now from events) select event_id, case when event_id % 5 = 0 then -1 else date_sub('second', date_trunc('second', ts), now) end::bigint as age_s from events, n""")
def stamp_ages(spark, sf_dir):
    text = F.when(F.col("event_id") % 5 == 0, "yesterday").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    rows = load(spark, sf_dir, "events").select("event_id", text.alias("t"), F.col("ts").cast("timestamp").alias("ts"))
    now = rows.agg(F.date_trunc("second", F.max("ts")).alias("now"))
    return rows.crossJoin(F.broadcast(now)).select("event_id", F.coalesce(P.age_seconds(F.col("t"), F.col("now")), F.lit(-1)).cast("long").alias("age_s"))  # one row


@query("""select s_suppkey, round((s_acctbal / 1e4) * (s_acctbal / 1e4), 6) as price, round(s_acctbal * 1e6 / 1e9 * case when s_nationkey > 2 then s_nationkey / (s_nationkey + 10.0 + 5.0) else 0.5 end, 6) as miners from supplier""")
def emission_prices(spark, sf_dir):
    n = F.col("s_nationkey").cast("double")
    server = F.when(n > 2, n)
    price, amount = P.emission_value(F.col("s_acctbal") / 1e4, F.col("s_acctbal") * 1e6, server, F.lit(10.0), F.lit(5.0))
    return load(spark, sf_dir, "supplier").select("s_suppkey", F.round(price, 6).alias("price"), F.round(amount, 6).alias("miners"))


# Modes and names ------------------------------------------------------------

@query("""with t as (select c_custkey, c_custkey % 4 as tk, c_custkey % 3 as ak, c_custkey % 5 as rk, c_acctbal < 0 as here from customer)
  select c_custkey, tk in (1, 2) and ak < 2 as clash, case rk when 0 then 'pretokenized' when 1 then 'raw' when 2 then 'mixture' else case when here then 'pretokenized' when tk in (1, 2) and ak < 2 then 'raw' else 'pretokenized' end end as mode from t""")
def dataset_modes(spark, sf_dir):
    pick = lambda k, *xs: F.element_at(F.array(*(F.lit(x) for x in xs)), (F.col("c_custkey") % k + 1).cast("int"))
    clash = P.tokenizer_clash(pick(4, "Own-gemma", "Gemma-7b", "other/x", "third"), pick(3, "ThirdForCausalLM", "OwnLM", "FourthForCausalLM"), "own", ("third", "own"), ("gemma", "other"))
    requested = pick(5, "local", "remote", "mixture", "auto", "auto")
    return load(spark, sf_dir, "customer").select("c_custkey", clash.alias("clash"), P.dataset_mode(requested, F.col("c_acctbal") < 0, clash).alias("mode"))


@query("""select c_custkey, c_custkey % 3 < 2 as server_ok, c_custkey % 3 = 0 as client_ok, case c_custkey % 4 when 0 then 'skipped' when 1 then 'unknown' when 2 then 'match' else 'mismatch' end as chain from customer""")
def naming_rules(spark, sf_dir):
    """Whether repositories carry the owner's prefix, by the server's rule and the client's, and whether the chain's name fits."""
    k = F.col("c_custkey")
    prefix = F.concat(s("Ab"), F.lpad(k.cast("string"), 12, "7"))
    head = F.substring(prefix, 1, 8)
    repo = F.when(k % 3 == 0, F.concat(s("me/x-"), head)).when(k % 3 == 1, F.concat(F.upper(head), s("/model"))).otherwise("me/model")
    expected = F.when(k % 4 == 0, " ").otherwise(" main")
    found = F.when(k % 4 == 1, F.lit(None)).when(k % 4 == 2, "main ").otherwise("test")
    return load(spark, sf_dir, "customer").select(
        "c_custkey", P.prefix_in_repo(repo, prefix, False).alias("server_ok"), P.prefix_in_repo(repo, prefix, True).alias("client_ok"), P.chain_match(expected, found).alias("chain")
    )


@query("""select o_orderkey, 'r64:a' || (o_custkey % 5 + 1) || ':lr' || printf('%g', lr * 1e-5) || ':d0:e' || printf('%g', e) as spec from orders, (values (3.0), (4.5), (5.0)) l(lr), (values (0.5), (1.0)) x(e)""")
def spec_grid(spark, sf_dir):
    """Every combination of learning rates and epochs around a configuration."""
    rows = load(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 5 + 1).alias("a"), F.explode(F.array(F.lit(3e-5), F.lit(4.5e-5), F.lit(5e-5))).alias("lr"))
    rows = rows.select("*", F.explode(F.array(F.lit(0.5), F.lit(1.0))).alias("e"))
    return rows.select("o_orderkey", P.format_spec(F.lit(64), F.col("a"), F.col("lr"), F.lit(0.0), F.col("e")).alias("spec"))
