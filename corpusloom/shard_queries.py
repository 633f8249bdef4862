"""Queries over shards, listings, manifests and packing, each beside DuckDB SQL with the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions.text import QualityRules, reject_reason
from .functions.tokens import tokens
from .operators import mixing_buffer, packing, sampling, shards
from .queries import PACK, TOK, U60, documents, packed
from .tables import load, spread

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLE[f.__name__] = f, sql
        return f

    return add


def digest(ids="ids"):
    return F.md5(F.array_join(ids, " ").cast("binary"))


# Scans and checks -----------------------------------------------------------

@query("""select p.page_id, r.range::bigint as "begin", least(r.range + 4096, n)::bigint - 1 as "end" from (select page_id, length(html) as n from pages where length(html) > 0) p, lateral (select unnest(range(0, n, 4096)) as range) r""")
def chunk_ranges(spark, sf_dir):
    files = load(spark, sf_dir, "pages").select("page_id", F.length("html").cast("long").alias("size"))
    return shards.chunk_ranges(files, "size", 4096).select("page_id", "begin", "end")


@query("""select doc_id, length(text) as n, md5(text) as text_md5 from documents where text is not null and text <> ''""")
def text_scan(spark, sf_dir):
    """The first text column of a table, without null and empty texts."""
    from .sources.token_shards import read_texts

    return read_texts(spark, f"{sf_dir}/documents.parquet", "text", ["doc_id"]).select("doc_id", F.length("text").cast("long").alias("n"), F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query(rf"""with {TOK}, n as (select doc_id, source, len(ids) as n, ids from tok) select source, count(*) filter (where n >= 64)::bigint as kept, count(*) filter (where n < 64)::bigint as skipped,
  coalesce(sum(length(array_to_string(ids[1:64], ' '))) filter (where n >= 64), 0)::bigint as chars from n group by source""")
def token_rows(spark, sf_dir):
    """Rows cut to 64 tokens, shorter ones dropped and counted."""
    rows = load(spark, sf_dir, "documents").select("source", "doc_id", tokens(F.col("text")).alias("ids"))
    kept = shards.token_rows(rows, "ids", 64).groupBy("source").agg(F.count("*").alias("kept"), F.sum(F.length(F.array_join("ids", " "))).alias("chars"))
    seen = load(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n"))
    out = seen.join(kept, seen["source"].eqNullSafe(kept["source"]), "left").select(seen["source"], "n", F.coalesce("kept", F.lit(0)).alias("kept"), F.coalesce("chars", F.lit(0)).alias("chars"))
    return out.select("source", "kept", (F.col("n") - F.col("kept")).alias("skipped"), "chars")


@query(rf"""with {TOK}, w as (select doc_id, unnest(ids) as t, generate_subscripts(ids, 1) as i from tok), f as (select doc_id, (i - 1) // 32 as win, ('0x' || substr(md5(t), 1, 8))::bigint % 30000 as id from w),
  g as (select doc_id, win, count(*) as n, max(id) as top from f group by doc_id, win) select doc_id, coalesce(win, 0)::bigint as win, coalesce(case when coalesce(n, 0) <> 32 then 'length' when top >= 29990 then 'vocabulary' end, '') as error from documents left join g using (doc_id)""")
def window_checks(spark, sf_dir):
    """Every window of a text: too short, as a last one may be, or with a token beyond the vocabulary; a text without tokens is one short window."""
    word = lambda t: F.pmod(F.conv(F.substring(F.md5(t.cast("binary")), 1, 8), 16, 10).cast("long"), F.lit(30000))
    rows = spread(load(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", F.transform(tokens(F.col("text")), word).alias("ids"))
    last = F.greatest(F.ceil(F.size("ids") / 32) - 1, F.lit(0).cast("long"))
    rows = rows.withColumn("win", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    window = F.slice("ids", (F.col("win") * 32 + 1).cast("int"), F.lit(32))
    return rows.select("doc_id", "win", F.coalesce(shards.window_errors(window, 32, 29990), F.lit("")).alias("error"))


@query(rf"""with {TOK}, n as (select doc_id, ids, len(ids) // 100 as k from tok where len(ids) >= 100), x as (select doc_id, ids, unnest(range(0, k)) as w from n) select doc_id, w::bigint as window_idx, md5(array_to_string(ids[w * 100 + 1 : w * 100 + 100], ' ')) as digest from x""")
def window_slices(spark, sf_dir):
    """All whole windows of each flat token array."""
    rows = documents(spark, sf_dir).withColumn("n", shards.window_count(F.col("ids"), 100)).where("n > 0")
    rows = rows.withColumn("w", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    return rows.select("doc_id", F.col("w").alias("window_idx"), digest(shards.window_slice(F.col("ids"), F.col("w"), 100)).alias("digest"))


@query("""select page_id, case when page_id % 3 = 0 then '/abs/' || page_id else 'mnt/m' || (page_id % 7) || '/shards/' || page_id end as path from pages""")
def resolved_paths(spark, sf_dir):
    key = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("/abs/"), "page_id")).otherwise(F.concat(F.lit("shards/"), "page_id"))
    return load(spark, sf_dir, "pages").select("page_id", shards.resolved(key, F.concat(F.lit("mnt/m"), F.col("page_id") % 7, F.lit("/"))).alias("path"))


ENTRIES = """e as (select l_suppkey, l_orderkey * 8 + l_linenumber as pos, case when l_returnflag = 'A' and l_suppkey % 2 = 0 then 'train_shards' when l_returnflag = 'R' then 'eval_shards' when l_returnflag = 'A' then 'none' else 'shards' end as field,
  case when l_linenumber = 1 then '' else 'k' || (l_partkey % 50) end as key from lineitem)"""


@query(f"""with {ENTRIES}, p as (select *, row_number() over (partition by l_suppkey, field order by pos, key) - 1 as place from e where field <> 'none'),
  t as (select l_suppkey, key, min(place) as place, 0 as r from p where field = 'train_shards' and place between 3 and 22 and key <> '' group by all),
  v as (select l_suppkey, key, min(place) as place, 1 as r from p where field = 'eval_shards' and key <> '' group by all), a as (select l_suppkey, key, min(place) as place, 2 as r from p where field = 'shards' and place between 3 and 22 and key <> '' group by all),
  o as (select * from v union all select * from a where (l_suppkey, key) not in (select l_suppkey, key from v)),
  f as (select * from t union all select * from o where l_suppkey not in (select l_suppkey from t)) select l_suppkey, key, row_number() over (partition by l_suppkey order by r, place)::int as ord from f""")
def shard_selection(spark, sf_dir):
    """Which shards to fetch of train, eval and joint lists."""
    flag, odd = F.col("l_returnflag"), F.col("l_suppkey") % 2
    field = F.when((flag == "A") & (odd == 0), "train_shards").when(flag == "R", "eval_shards").when(flag == "A", "none").otherwise("shards")
    key = F.when(F.col("l_linenumber") == 1, "").otherwise(F.concat(F.lit(" k"), F.col("l_partkey") % 50))
    e = load(spark, sf_dir, "lineitem").select("l_suppkey", (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("pos"), field.alias("field"), key.alias("key")).where("field <> 'none'")
    return shards.selected_keys(e, "l_suppkey", "field", "pos", "key", 3, 20)


@query("""select doc_id, doc_id::int as shard, ((n_chars - 128) // 4 - case when n_chars < 128 and (n_chars - 128) % 4 <> 0 then 1 else 0 end)::bigint as n_tokens from documents where doc_id % 6 > 0""")
def existing_shards(spark, sf_dir):
    key = F.when(F.col("doc_id") % 6 == 0, F.concat(F.lit("v1/other_"), "doc_id")).otherwise(F.concat(F.lit("v1/shards/shard_"), F.lpad(F.col("doc_id").cast("string"), 8, "0"), F.lit(".npy")))
    return shards.existing_shards(load(spark, sf_dir, "documents").withColumn("key", key), "key", "n_chars").select("doc_id", "shard", "n_tokens")


@query("""with f as (select regexp_extract(url, '://([^/?#]+)', 1) as host, page_id || case when page_id % 3 = 0 then '.txt' else '.Parquet' end as name from pages), r as (select *, row_number() over (partition by host order by name) as place from f where lower(name) like '%.parquet')
  select host, name, place::int as place from r where place <= 5""")
def extension_listing(spark, sf_dir):
    name = F.concat(F.col("page_id").cast("string"), F.when(F.col("page_id") % 3 == 0, ".txt").otherwise(".Parquet"))
    rows = load(spark, sf_dir, "pages").select(F.regexp_extract("url", "://([^/?#]+)", 1).alias("host"), name.alias("name"))
    return shards.latest_files(rows, "host", "name", ".parquet", 5)


@query("""select event_type, count(*)::bigint as objects, date_sub('second', date_trunc('second', min(ts)), date_trunc('second', max(ts)))::bigint as spread_s, min(md5(event_id::varchar)) as first_etag from events group by event_type""")
def pinned_listing(spark, sf_dir):
    """Objects of a prefix with how far apart they were modified, and the least of their tags."""
    rows = load(spark, sf_dir, "events").select("event_type", F.date_trunc("second", F.col("ts").cast("timestamp")).alias("ts"), F.md5(F.col("event_id").cast("string").cast("binary")).alias("etag"))
    return rows.groupBy("event_type").agg(F.count("*").alias("objects"), (F.unix_timestamp(F.max("ts")) - F.unix_timestamp(F.min("ts"))).alias("spread_s"), F.min("etag").alias("first_etag"))


@query("""select o_orderkey, substr(sha256(case when o_orderkey % 4 = 0 then 'tok' || (o_custkey % 3) else 'm' || o_orderkey end), 1, 16) as digest, o_orderkey % 4 = 0 as fallback from orders""")
def manifest_digest(spark, sf_dir):
    """The digest of a manifest, or of the tokenizer's name where there is none."""
    manifest = F.when(F.col("o_orderkey") % 4 != 0, F.concat(F.lit("m"), "o_orderkey"))
    text = F.coalesce(manifest, F.concat(F.lit("tok"), F.col("o_custkey") % 3))
    return load(spark, sf_dir, "orders").select("o_orderkey", F.substring(F.sha2(text, 256), 1, 16).alias("digest"), manifest.isNull().alias("fallback"))


LISTED = """select l_suppkey, l_orderkey * 8 + l_linenumber as shard, case when l_returnflag = 'R' then 'eval' else 'train' end as split, l_partkey % 90 as expected,
  case when l_discount < 0.01 then null else floor(l_extendedprice)::bigint end as size, case when l_tax > 0.07 then l_partkey % 90 + 1 else l_partkey % 90 end as rows, case when l_quantity < 2 then 1024 else 2048 end as length, case when l_shipdate < '1993-01-01' then 'int64' else 'uint32' end as dtype from lineitem"""


@query(f"""with s as ({LISTED}), e as (select *, case when size is null then 'missing' when size < 1024 then 'unreadable' when length <> 2048 then 'length' when expected > 0 and rows <> expected then 'rows' when dtype <> 'uint32' then 'dtype' end as error from s)
  select l_suppkey, count(*)::bigint as shards, count_if(split = 'train')::bigint as train_shards, count_if(split = 'eval')::bigint as eval_shards, count_if(error is null)::bigint as ok, count_if(error is not null)::bigint as failed,
  sum(expected)::bigint as total_rows, (sum(expected) * 2048)::bigint as total_tokens, coalesce(sum(size), 0)::bigint as total_bytes, sha256(coalesce(string_agg(shard || ':' || split || ':' || error, ',' order by shard || ':' || split || ':' || error) filter (where error is not null), '')) as errors,
  concat_ws(',', case when count_if(split = 'train') = 0 then 'no_train_shards' end, case when count_if(split = 'eval') = 0 then 'no_eval_shards' end) as warnings, count_if(error is not null) = 0 as passed from e group by l_suppkey""")
def manifest_report(spark, sf_dir):
    """Totals of each supplier's manifest, and which of its shards do not hold what it says."""
    li = load(spark, sf_dir, "lineitem")
    rows = li.select(
        "l_suppkey", (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("shard"), F.when(F.col("l_returnflag") == "R", "eval").otherwise("train").alias("split"), (F.col("l_partkey") % 90).alias("expected"),
        F.when(F.col("l_discount") >= 0.01, F.floor("l_extendedprice")).alias("size"), (F.col("l_partkey") % 90 + F.when(F.col("l_tax") > 0.07, 1).otherwise(0)).alias("rows"),
        F.when(F.col("l_quantity") < 2, 1024).otherwise(2048).alias("length"), F.when(F.col("l_shipdate") < "1993-01-01", "int64").otherwise("uint32").alias("dtype"),
    )
    return shards.manifest_report(rows, "l_suppkey", 2048).withColumn("errors", F.sha2("errors", 256))


# Packing --------------------------------------------------------------------

NO_END = PACK.replace("list_append(ids, '<end>') as ids from tok", "ids from tok")


@query(NO_END.format(tok=TOK, by="source,", part="partition by source") + r""", o as (select source, doc_id, len(ids) as n, sum(len(ids)) over (partition by source order by doc_id) - len(ids) as off from d),
  c as (select source, count_if((off + n) // 128 > off // 128) as samples from o group by source), k as (select source, count(*) as windows, sha256(string_agg(md5(body), '' order by window_id)) as digest from win group by source)
  select c.source, coalesce(windows, 0)::bigint as windows, c.samples::bigint as samples, coalesce(digest, '') as digest from c left join k on c.source is not distinct from k.source""")
def packed_without_end(spark, sf_dir):
    """Windows that never cross a source, without end tokens, and how many texts completed one."""
    docs = documents(spark, sf_dir)
    win = packing.pack_windows(docs, 128, "doc_id", "ids", ["source"]).select("source", "window_id", digest().alias("d"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("window_id", "d"))), lambda x: x["d"])
    win = win.groupBy("source").agg(F.count("*").alias("windows"), F.sha2(F.array_join(listed, ""), 256).alias("digest"))
    done = shards.completing(docs.select("source", "doc_id", F.size("ids").cast("long").alias("n")), "doc_id", "n", 128, ["source"])
    done = done.groupBy("source").agg(F.count_if("completes").alias("samples"))
    return done.join(win, done["source"].eqNullSafe(win["source"]), "left").select(done["source"], F.coalesce("windows", F.lit(0)).alias("windows"), "samples", F.coalesce("digest", F.lit("")).alias("digest"))


@query(PACK.format(tok=TOK, by="", part="") + " select window_id::bigint as window_id, md5(body) as digest, (select count(*) from win) < 500 as underfilled from win where window_id < 500")
def packed_until(spark, sf_dir):
    """The first 500 windows, and whether the corpus is too small for them."""
    return shards.first_windows(packed(spark, sf_dir), "window_id", 500).select("window_id", digest().alias("digest"), "underfilled")


@query(PACK.format(tok=TOK, by="", part="") + ", s as (select window_id // 100 as shard, count(*) as rows from win group by 1) select shard::bigint as shard, case when shard < 2 then 'train' else 'eval' end as split, rows::bigint as rows from s where rows = 100")
def full_shards(spark, sf_dir):
    """Full shards only; the tail is dropped."""
    return packing.assign_shards(packed(spark, sf_dir), 100, 2, full_only=True).groupBy("shard", "split").agg(F.count("*").alias("rows"))


@query("""with s as (select doc_id, n_chars as size, sum(n_chars) over (order by doc_id) - n_chars as off from documents where n_chars > 0), b as (select doc_id, size, least(greatest(3 * 65536 - off, 0), size) as b from s)
  select doc_id, b::bigint as "begin", case when b >= size then 'done' when b > 0 then 'partial' else 'fresh' end as status from b""")
def resume_offsets(spark, sf_dir):
    """Where to go on after three full shards."""
    out = shards.resume_offsets(load(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id", "n_chars", 65536, 3)
    return out.select("doc_id", F.col("begin").cast("long").alias("begin"), "status")


@query(PACK.format(tok=TOK, by="", part="") + " select window_id::bigint as window_id, (window_id // 64 * 64 + row_number() over (partition by window_id // 64 order by md5('mix:' || window_id), window_id) - 1)::bigint as place from win")
def mixed_windows(spark, sf_dir):
    """The order of windows after a mixing buffer of 64."""
    return shards.mixed_order(packed(spark, sf_dir).select("window_id"), "window_id", 64, "mix")


@query("""with recursive d as (select doc_id, row_number() over (order by doc_id) - 1 as k from documents where doc_id is not null),
  run as (select 0::bigint as done, (select coalesce(list(doc_id order by k), []::bigint[]) from d where k < 10000) as held, null::bigint as gone
    union all select done + 1, list_concat(list_concat(held[1:j], [x]), held[j + 2:]), held[j + 1]
    from (select run.done, held, d.doc_id as x, (('0x' || substr(md5('stream:' || run.done), 1, 15))::bigint % 10000)::bigint as j from run join d on d.k = 10000 + run.done)),
  last as (select done, unnest(held) as doc_id from run where done = (select max(done) from run))
  select gone as doc_id, (done - 1)::bigint as place from run where gone is not null
  union all select doc_id, (done + row_number() over (order by ('0x' || substr(md5('stream:end:' || doc_id), 1, 15))::bigint, doc_id) - 1)::bigint from last""")
def stream_shuffle(spark, sf_dir):
    """The order of documents after a shuffle buffer of 10,000 rows, each new one taking the place of a random one."""
    return mixing_buffer.streamed_order(load(spark, sf_dir, "documents"), "doc_id", "stream")


@query(r"""with d as (select source, trim(coalesce(text, '')) as t, coalesce(text, '') as raw, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as n from documents)
  select count(*)::bigint as seen, count_if(raw = '')::bigint as empty, count_if(raw <> '' and n = 0)::bigint as empty_tokenization, count_if(n > 0 and n < 30)::bigint as too_few, count_if(n >= 30)::bigint as kept,
  round(count_if(n < 30) / count(*), 6) as reject_rate, round(sum(case when n >= 30 then n else 0 end) / nullif(count_if(n >= 30), 0), 6) as tokens_per_doc from d""")
def ingest_report(spark, sf_dir):
    """Counts of an ingest: what was rejected before and after tokenizing, and tokens a text."""
    n = F.size(tokens(F.col("text")))
    raw = F.coalesce("text", F.lit(""))
    rows = load(spark, sf_dir, "documents").select(raw.alias("raw"), n.alias("n"))
    kept = F.col("n") >= 30
    return rows.agg(
        F.count("*").alias("seen"), F.count_if(F.col("raw") == "").alias("empty"), F.count_if((F.col("raw") != "") & (F.col("n") == 0)).alias("empty_tokenization"),
        F.count_if((F.col("n") > 0) & ~kept).alias("too_few"), F.count_if(kept).alias("kept"), F.round(F.count_if(~kept) / F.count("*"), 6).alias("reject_rate"),
        F.round(F.try_divide(F.sum(F.when(kept, F.col("n")).otherwise(0)), F.count_if(kept)), 6).alias("tokens_per_doc"),
    )


@query(r"""with s as (select doc_id, regexp_replace(coalesce(text, ''), '^[\x09-\x0D\x20]+|[\x09-\x0D\x20]+$', '', 'g') as t from documents) select case when length(t) < 200 then 'too_short' when length(t) > 1500 then 'too_long' else 'kept' end as reason, count(*)::bigint as n from s where t <> '' group by 1""")
def long_texts(spark, sf_dir):
    """The length rules alone, with an upper limit."""
    rules = QualityRules(most_chars=1500, least_alpha=0.0, most_repeat=0, most_url=0, most_navigation=0)
    docs = load(spark, sf_dir, "documents").where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return docs.groupBy(F.coalesce(reject_reason(F.col("text"), rules), F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


# Pools and draws ------------------------------------------------------------

@query("""select doc_id, array_to_string(list_transform(range(8), lambda i: (('0x' || substr(md5('syn:' || doc_id || ':' || i), 1, 15))::bigint % 50000)::varchar), ' ') as ids from documents""")
def synthetic_tokens(spark, sf_dir):
    """Uniform made-up tokens for each row."""
    return shards.uniform_tokens(load(spark, sf_dir, "documents"), "doc_id", 8, 50000, "syn").select("doc_id", F.array_join("ids", " ").alias("ids"))


@query("""with f as (select regexp_extract(url, '://([^/?#]+)', 1) as host, max(page_id) as page_id, count(*) as rows from pages group by 1), r as (select *, row_number() over (order by md5('file:' || host), host) as rk from f) select host, rows::bigint as rows, rk::int as rk from r where rk <= 10""")
def file_choice(spark, sf_dir):
    """Ten files of a listing by seed."""
    files = load(spark, sf_dir, "pages").groupBy(F.regexp_extract("url", "://([^/?#]+)", 1).alias("host")).agg(F.count("*").alias("rows"))
    return sampling.take(files, 10, "file", "host")


@query(rf"""with {TOK}, h as (select doc_id, ids, row_number() over (order by md5('pool:' || doc_id), doc_id) as rk from tok where len(ids) > 0 and source is not null), d as (select rk, list_append(ids, '<end>') as ids from h where rk <= 100),
  t as (select rk, unnest(ids) as t, generate_subscripts(ids, 1) as i from d), pos as (select t, row_number() over (order by rk, i) - 1 as pos from t), win as (select pos // 128 as w, string_agg(t, ' ' order by pos) as body from pos group by 1 having count(*) = 128)
  select w::bigint as window_id, md5(body) as digest from win""")
def private_pool(spark, sf_dir):
    """A seeded sample of the rows of all files, packed in the order drawn."""
    docs = documents(spark, sf_dir).where("source is not null")
    top = sampling.take(docs, 100, "pool", "doc_id").withColumn("ids", F.concat("ids", F.array(F.lit("<end>"))))
    return packing.pack_windows(top, 128, "rk", "ids").select("window_id", digest().alias("digest"))


REFS = f"""w as (select source as name, sum(n_chars) as weight from documents where source is not null group by 1), n as (select name, weight / sum(weight) over () as weight from w),
  i as (select name, sum(weight) over (order by name rows between unbounded preceding and current row) as hi, row_number() over (order by name desc) as z from n), j as (select name, coalesce(lag(hi) over (order by name), 0) as lo, case when z = 1 then 2.0 else hi end as hi from i),
  p as (select source as name, doc_id as shard, n_chars + 1 as rows, row_number() over (partition by source order by md5('pool:' || doc_id), doc_id) - 1 as k from documents where source is not null qualify k < 6),
  s as (select name, count(*) as shards from p group by name)"""


@query(f"""with {REFS}, d as (select o_orderkey as draw, {U60.format("'mr:' || o_orderkey")} as u from orders), x as (select draw, name from d join j on u >= lo and u < hi),
  k as (select draw, x.name, ('0x' || substr(md5('mr:shard:' || draw), 1, 15))::bigint % shards as k from x join s using (name))
  select draw, k.name, p.shard, (('0x' || substr(md5('mr:row:' || draw), 1, 15))::bigint % p.rows)::bigint as row_idx from k join p on p.name = k.name and p.k = k.k""")
def mixture_refs(spark, sf_dir):
    """For each draw a source by weight, a shard of its pool and a row, with replacement."""
    docs = load(spark, sf_dir, "documents").where("source is not null")
    weights = docs.groupBy(F.col("source").alias("name")).agg(F.sum("n_chars").cast("double").alias("weight"))
    pool = sampling.take_each(docs.select(F.col("source").alias("name"), F.col("doc_id").alias("shard"), (F.col("n_chars") + 1).alias("rows")), 6, "pool", ["name"], "shard").withColumn("k", F.col("rk").cast("long") - 1)
    draws = sampling.weighted_draws(load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("draw")), weights, "mr", "name").select("draw", "name")
    return shards.mixture_refs(draws, pool, "mr").select("draw", "name", "shard", "row_idx")


@query(f"""with {REFS}, d as (select name, i.range as i, name || ':' || i.range as draw from s, range(20) i), k as (select draw, d.name, i, ('0x' || substr(md5('dr:shard:' || draw), 1, 15))::bigint % shards as k from d join s using (name))
  select k.name, k.i::int as i, p.shard, (('0x' || substr(md5('dr:row:' || draw), 1, 15))::bigint % p.rows)::bigint as row_idx from k join p on p.name = k.name and p.k = k.k""")
def source_refs(spark, sf_dir):
    """Twenty references of each source, with replacement."""
    docs = load(spark, sf_dir, "documents").where("source is not null")
    pool = sampling.take_each(docs.select(F.col("source").alias("name"), F.col("doc_id").alias("shard"), (F.col("n_chars") + 1).alias("rows")), 6, "pool", ["name"], "shard").withColumn("k", F.col("rk").cast("long") - 1)
    draws = pool.select("name").distinct().withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(19)))).withColumn("draw", F.concat_ws(":", "name", "i"))
    return shards.mixture_refs(draws, pool, "dr").select("name", "i", "shard", "row_idx")


@query("""with h as (select source, doc_id, row_number() over (partition by source order by md5('p:' || doc_id), doc_id) as rk from documents) select h.source, h.doc_id, h.rk::int as rk, labels.doc_id is not null as cached from h left join (select distinct doc_id from labels) labels using (doc_id) where rk <= 8""")
def prefetch_keys(spark, sf_dir):
    """Shards to prefetch by the rule that training draws its pool by, and which are cached."""
    pool = sampling.take_each(load(spark, sf_dir, "documents").select("source", "doc_id"), 8, "p", ["source"], "doc_id")
    have = load(spark, sf_dir, "labels").select(F.col("doc_id").alias("have")).distinct()
    return pool.join(have, pool["doc_id"] == have["have"], "left").select("source", "doc_id", "rk", F.col("have").isNotNull().alias("cached"))


@query("""select source, count(*)::bigint as manifest, count(l.doc_id)::bigint as cached from documents d left join (select distinct doc_id from labels) l on l.doc_id = d.doc_id group by source""")
def shard_cache_counts(spark, sf_dir):
    have = load(spark, sf_dir, "labels").select(F.col("doc_id").alias("have")).distinct()
    docs = load(spark, sf_dir, "documents").select("source", "doc_id")
    return docs.join(have, docs["doc_id"] == have["have"], "left").groupBy("source").agg(F.count("*").alias("manifest"), F.count("have").alias("cached"))


@query("""select doc_id, source from documents where doc_id in (select doc_id from labels)""")
def cached_only(spark, sf_dir):
    return load(spark, sf_dir, "documents").select("doc_id", "source").join(load(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")


@query("""select doc_id, source from documents d where not exists (select 1 from labels l where l.doc_id = d.doc_id)""")
def pending_files(spark, sf_dir):
    """Files that no finished run has taken."""
    return shards.not_yet(load(spark, sf_dir, "documents").select("doc_id", "source"), load(spark, sf_dir, "labels"), "doc_id")


@query("""with f as (select doc_id, source, row_number() over (order by source) as ord from (select any_value(doc_id) as doc_id, source from documents where source is not null group by source)), k as (select page_id, case when page_id % 3 = 0 then 'k' || (page_id % 40) when page_id % 3 = 1 then 'http://x/' || (select max(source) from documents) || '/' || page_id else 'lost' end as key from pages),
  l as (select 'k' || (doc_id % 30) as key, min(source) as owner from documents where source is not null group by 1)
  select page_id, coalesce(l.owner, case when key like 'http%' then (select min(source) from f where contains(key, source)) end, 'first') as owner from k left join l using (key)""")
def key_owners(spark, sf_dir):
    """The source that a shard belongs to: by lists, else by name, else the first."""
    docs = load(spark, sf_dir, "documents").where("source is not null")
    top = docs.agg(F.max("source").alias("top"))
    k = F.col("page_id") % 3
    key = F.when(k == 0, F.concat(F.lit("k"), F.col("page_id") % 40)).when(k == 1, F.concat(F.lit("http://x/"), "top", F.lit("/"), "page_id")).otherwise("lost")
    pages = load(spark, sf_dir, "pages").crossJoin(F.broadcast(top)).select("page_id", key.alias("key"))  # one row
    lists = docs.select(F.concat(F.lit("k"), F.col("doc_id") % 30).alias("key"), F.col("source").alias("name"), F.col("source").alias("ord"))
    names = docs.select(F.col("source").alias("name"), F.col("source").alias("ord")).distinct()
    return shards.owners(pages, "key", lists, names, F.lit("first")).select("page_id", "owner")


def _partitions(spark, sf_dir):
    files = load(spark, sf_dir, "pages").groupBy(F.regexp_extract("url", "://([^/?#]+)", 1).alias("host")).agg(F.sum(F.length("html")).cast("long").alias("size"))
    return shards.balanced(files, "size", "host", 4)


@query("""with recursive f as (select regexp_extract(url, '://([^/?#]+)', 1) as host, sum(length(html)) as size from pages group by 1), r as (select host, size, row_number() over (order by size desc, host) as k from f),
  g as (select 0::bigint as k, ''::varchar as host, 0::bigint as size, [0, 0, 0, 0]::bigint[] as t, 0 as part union all
    select r.k, r.host, r.size::bigint, list_transform([1, 2, 3, 4], lambda i: case when i = list_position(g.t, list_min(g.t)) then g.t[i] + r.size else g.t[i] end)::bigint[], (list_position(g.t, list_min(g.t)) - 1)::int from g join r on r.k = g.k + 1)
  select host, size, part::int as part from g where k > 0""")
def balanced_parts(spark, sf_dir):
    """Files in four parts of nearly equal size."""
    return _partitions(spark, sf_dir)
