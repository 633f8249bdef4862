"""Queries over array shards, index samples, caches and checkpoint headers, each beside DuckDB SQL with the same rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import byte_pairs
from .jobs.score_cache import ScoreCache, version_of
from .operators import curriculum, evaluation, hash_tree, packing, permutation, rules, sampling
from .operators import mixing_buffer as mixing_buffers
from .operators.scoring import UnigramScorer
from .queries import END, LENGTH, PACK, SCORED, SHARD_ROWS, TOK, TRAIN_SHARDS, documents, packed, r6, texts
from .sources import array_files, tensor_headers
from .tables import load, shared_folder, written

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLE[f.__name__] = f, sql
        return f

    return add


# Array shards ---------------------------------------------------------------

def token_ids(ids):
    """Numbers of 28 bits for words."""
    return F.transform(ids, lambda t: F.conv(F.substring(F.md5(t.cast("binary")), 1, 7), 16, 10).cast("int"))


def written_shards(spark: SparkSession, sf_dir: str) -> str:
    """The packed windows of the corpus as array files in the shared folder; their address."""
    path = f"{shared_folder(spark)}/arrays-{uuid.uuid4().hex}"
    windows = packed(spark, sf_dir).withColumn("ids", token_ids(F.col("ids")))
    array_files.write_arrays(packing.assign_shards(windows, SHARD_ROWS, TRAIN_SHARDS), path, LENGTH)
    return path


def short_key(column: str = "shard_key"):
    return F.regexp_extract(column, "[^/]+/[^/]+$", 0)


def digest(ids: str = "input_ids"):
    return F.md5(F.array_join(F.col(ids).cast("array<string>"), " ").cast("binary"))


ARRAYS = PACK.format(tok=TOK, by="", part="") + r""", arrays as (
  select pos // 128 as window_id, md5(string_agg(('0x' || substr(md5(t), 1, 7))::int::varchar, ' ' order by pos)) as digest from pos group by 1 having count(*) = 128
), rows as (
  select printf(case when window_id // 16 < 8 then 'train/shard_%06d.npy' else 'eval/holdout_%06d.npy' end, window_id // 16) as shard_key, (window_id % 16)::bigint as row_idx, window_id, digest from arrays)"""


@query(ARRAYS + " select shard_key, row_idx, digest from rows")
def array_shards(spark, sf_dir):
    """Packed windows written as array shards in two phases and read back in ranges of rows."""
    path = written_shards(spark, sf_dir)
    return array_files.read_arrays(spark, path).select(short_key().alias("shard_key"), "row_idx", digest().alias("digest"))


@query(ARRAYS + " select shard_key, row_idx, digest from rows where row_idx between 5 and 9")
def array_row_range(spark, sf_dir):
    """A range of rows of every shard; the condition is pushed into the plan, so that other rows are not read."""
    path = written_shards(spark, sf_dir)
    rows = array_files.read_arrays(spark, path).where("row_idx between 5 and 9")
    return rows.select(short_key().alias("shard_key"), "row_idx", digest().alias("digest"))


@query(ARRAYS + " select shard_key as key, split_part(shard_key, '/', 1) as split, count(*)::bigint as rows, (128 * count(*))::bigint as n_tokens, null::varchar as error from rows group by all")
def array_manifest(spark, sf_dir):
    """The manifest that the sink commits, each shard verified against header, size and digest."""
    path = written_shards(spark, sf_dir)
    entries = array_files.manifest_entries(spark, path).select("s.key", "s.rows", F.col("s.num_tokens").alias("n_tokens"))
    return entries.join(array_files.verify_arrays(spark, path, LENGTH), "key").select("key", "split", "rows", "n_tokens", "error")


# Samples by index -----------------------------------------------------------

def walk_sql(total: str, n: str, seed: str) -> str:
    """Draws and indices by the permutation's rounds; ``total`` and ``n`` are scalar subqueries."""
    h = "('0x' || substr(md5('{seed}:' || (k % 6) || ':' || {half}), 1, 15))::bigint"
    even, odd = h.format(seed=seed, half="r"), h.format(seed=seed, half="l")
    return f"""size as (select ({total})::bigint as total), ab as (select total, ceil(sqrt(total))::bigint as a from size),
sides as (select total, a, ((total + a - 1) // a)::bigint as b from ab),
walk as (
  select i as draw, 0 as k, i // b as l, i % b as r, a, b, total from sides, (select unnest(range(({n})::bigint)) as i)
  union all
  select draw, (k % 6) + 1, case when k % 2 = 0 then (l + {even}) % a else l end, case when k % 2 = 1 then (r + {odd}) % b else r end, a, b, total
  from walk where k < 6 or l * b + r >= total
), sample as (select draw::bigint as draw, (l * b + r)::bigint as index from walk where k = 6 and l * b + r < total)"""


@query(f"""with recursive n as (select source, count(*) as n from documents where source is not null group by source),
{walk_sql("(select sum(n) from n)", "(select sum(n) // 10 from n)", "keyed")},
p as (select source, sum(n) over (order by source) - n as first, n from n)
select draw, index, source, (index - first)::bigint as row_idx from sample join p on index >= first and index < first + n""")
def keyed_sample(spark, sf_dir):
    """A tenth of all rows by index, without replacement, from the counts of the sources alone."""
    counts = load(spark, sf_dir, "documents").where("source is not null").groupBy("source").agg(F.count("*").alias("n"))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    drawn = permutation.sample_indices(spark, total // 10, total, "keyed")
    return permutation.locate(drawn, counts, "source", "n").select("draw", "index", "source", "row_idx")


def manifest_counts(spark: SparkSession, path: str) -> DataFrame:
    return array_files.manifest_entries(spark, path).select(F.col("s.key").alias("shard_key"), F.col("s.rows").cast("long").alias("n"))


@query(ARRAYS.replace("with ", "with recursive ", 1) + f""", n as (select shard_key, count(*) as n from rows group by 1),
{walk_sql("(select sum(n) from n)", "(select sum(n) // 8 from n)", "rows")},
p as (select shard_key, sum(n) over (order by shard_key) - n as first, n from n),
hit as (select draw, shard_key, (index - first)::bigint as row_idx from sample join p on index >= first and index < first + n)
select draw, shard_key, row_idx, digest from hit join rows using (shard_key, row_idx)""")
def sampled_shard_rows(spark, sf_dir):
    """An eighth of the windows of a sharded corpus, drawn by index from the manifest's counts and fetched by ranged reads."""
    path = written_shards(spark, sf_dir)
    counts = manifest_counts(spark, path)
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    drawn = permutation.locate(permutation.sample_indices(spark, total // 8, total, "rows"), counts, "shard_key", "n")
    rows = array_files.fetch_rows(drawn.select("shard_key", "row_idx"), path)
    return drawn.join(rows, ["shard_key", "row_idx"]).select("draw", "shard_key", "row_idx", digest().alias("digest"))


# Score cache ----------------------------------------------------------------

@query(rf"""with {SCORED}, s as (select source, count(*)::bigint as n_rows, round(avg(loss), 6) as mean_loss from scored where source is not null group by source)
select source, case when md5(source) < '8' then 'kept' else 'scored' end as second_run, n_rows, mean_loss from s""")
def score_cache(spark, sf_dir):
    """Sources as shards: some are scored first, then all are asked for; only the missing ones are scored by the second run."""
    rows = texts(spark, sf_dir).withColumnRenamed("source", "shard_key")
    scorer = UnigramScorer(rows, "ids")  # one model for all runs
    cache = ScoreCache(spark, f"{shared_folder(spark)}/scores-{uuid.uuid4().hex}", version_of("unigram", 1), lambda r: curriculum.scored_rows(r, "doc_id", scorer=scorer))
    shards = written(load(spark, sf_dir, "documents").select(F.col("source").alias("shard_key")).distinct())  # without reading texts; asked for four times
    cache.update(shards.where(F.md5(F.col("shard_key").cast("binary")) < "8"), rows)
    second = cache.update(shards, rows).select("shard_key", F.lit("scored").alias("run"))
    losses = cache.read(shards).groupBy("shard_key").agg(F.count("*").alias("n_rows"), F.round(F.avg("loss"), 6).alias("mean_loss"))
    return losses.join(second, "shard_key", "left").select(F.col("shard_key").alias("source"), F.coalesce("run", F.lit("kept")).alias("second_run"), "n_rows", "mean_loss")


# Checkpoints ----------------------------------------------------------------

#: Parameters of a model with stacked experts, and the class of each.
PARAMETERS = (
    ("model.embed_tokens.weight", "embed"), ("lm_head.weight", "lm_head"), ("layers.0.moe.experts_w12", "moe_experts_routed"), ("layers.0.moe.shared_experts.w", "moe_experts_shared"),
    ("layers.0.moe.w_down_proj", "moe_dcca"), ("layers.0.moe.router.weight", "moe_router"), ("layers.0.memory.keys", "latent_memory"), ("layers.0.ffn.gate.weight", "ffn_dense"),
    ("layers.0.attn.wq", "attn"), ("layers.0.ln1.weight", "norm"), ("rotary_emb.inv_freq", "rope"), ("head.bias", "other"),
)
LISTED_PARAMETERS = "values " + ", ".join(f"({k}, '{n}', '{c}')" for k, (n, c) in enumerate(PARAMETERS))
TENSORS = f"""t as (select lower(replace(p_brand, '#', '')) as model, format('{{}}/model-{{:05d}}-of-00003.safetensors', lower(replace(p_brand, '#', '')), p_partkey % 3 + 1) as file,
  format('p{{:09d}}.{{}}', p_partkey, n) as tensor, c as class, case when p_partkey % 5 = 0 then 'F32' else 'BF16' end as dtype, case when p_partkey % 5 = 0 then 4 else 2 end as width, p_size::bigint as d
  from part join ({LISTED_PARAMETERS}) x(k, n, c) on k = p_partkey % {len(PARAMETERS)})"""


def checkpoints(spark: SparkSession, sf_dir: str) -> str:
    """Each brand as a model whose tensors are its parts, in three files of real headers; their address."""
    name = F.element_at(F.array(*(F.lit(n) for n, _ in PARAMETERS)), (F.col("p_partkey") % len(PARAMETERS) + 1).cast("int"))
    parts = load(spark, sf_dir, "part").select(
        F.format_string("%s/model-%05d-of-00003.safetensors", F.lower(F.replace("p_brand", F.lit("#"), F.lit(""))), F.col("p_partkey") % 3 + 1).alias("file"),
        F.format_string("p%09d.%s", "p_partkey", name).alias("tensor"), F.when(F.col("p_partkey") % 5 == 0, "F32").otherwise("BF16").alias("dtype"),
        F.array(F.col("p_size").cast("long"), F.lit(8).cast("long")).alias("shape"),
    )
    path = f"{shared_folder(spark)}/checkpoints-{uuid.uuid4().hex}"
    written(tensor_headers.write_headers(parts, path))
    return path


@query(f"""with {TENSORS} select file, tensor, dtype, 8 * d as numel, (sum(8 * d * width) over w - 8 * d * width)::bigint as data_begin, (8 * d * width)::bigint as bytes from t window w as (partition by file order by tensor)""")
def checkpoint_tensors(spark, sf_dir):
    """Tensors with type, size and place in the data, from the headers of checkpoint files."""
    rows = tensor_headers.read_tensors(spark, checkpoints(spark, sf_dir))
    first = rows.groupBy("file").agg(F.min("begin").alias("data"))
    rows = rows.where("error is null").join(first, "file")
    return rows.select(short_key("file").alias("file"), "tensor", "dtype", "numel", (F.col("begin") - F.col("data")).alias("data_begin"), (F.col("end") - F.col("begin")).alias("bytes"))


@query(f"""with {TENSORS} select model, count(*)::bigint as n_float, count_if(dtype <> 'BF16')::bigint as n_other from t group by model""")
def checkpoint_types(spark, sf_dir):
    """Floating tensors of each model that are not of the wanted type."""
    out = tensor_headers.type_counts(tensor_headers.read_tensors(spark, checkpoints(spark, sf_dir)))
    return out.select(F.substring_index("model", "/", -1).alias("model"), "n_float", "n_other")


@query(f"""with {TENSORS}, e as (select *, row_number() over (partition by model, class = 'embed' order by tensor) as k from t where class <> 'lm_head'),
  p as (select model, class, 8 * d as n, case when class = 'moe_experts_routed' then 16 else 8 * d end as a from e where class <> 'embed' or k = 1)
  select model, coalesce(class, '(all)') as class, sum(n)::bigint as total, sum(a)::bigint as active from p group by grouping sets ((model, class), (model))""")
def checkpoint_parameters(spark, sf_dir):
    """Total and active parameters by class of a model with stacked experts, head and embedding tied, two experts active."""
    rows = tensor_headers.read_tensors(spark, checkpoints(spark, sf_dir)).withColumn("model", F.substring_index(tensor_headers.model_of(F.col("file")), "/", -1))
    out = rules.stacked_counts(rows, "tensor", "shape", 2, True, "model")
    return out


LEAF = 1000


@query(f"""with recursive d as (select doc_id, encode(coalesce(text, '')) as raw from documents), n as (select *, octet_length(raw) as size, greatest(1, (octet_length(raw) + {LEAF - 1}) // {LEAF}) as leaves from d),
  l as (select doc_id, unnest(range(0, leaves)) as k from n), h as (select doc_id, l.k, unhex(sha256('\\x00'::blob || raw[l.k * {LEAF} + 1:(l.k + 1) * {LEAF}])) as digest from l join n using (doc_id)),
  top as (select doc_id, case when count(*) = 1 then any_value(digest) else unhex(sha256('\\x01'::blob || unhex(string_agg(hex(digest), '' order by k)))) end as digest from h group by doc_id)
  select doc_id, size::bigint as size, leaves::bigint as n_leaves, lower(sha256('\\x02'::blob || unhex(lpad(to_hex(size), 16, '0')) || digest)) as root from n join top using (doc_id)""")
def tree_digests(spark, sf_dir):
    """Digests of whole texts by trees of hashes over fixed chunks, the same whatever tasks hash them."""
    return hash_tree.row_digests(load(spark, sf_dir, "documents"), "doc_id", "text", LEAF)


# Mixing buffers -------------------------------------------------------------

@query("""with recursive d as (select doc_id, row_number() over (order by doc_id) as k, count(*) over () as n from documents where doc_id is not null),
run as (select 0 as drain, [doc_id for doc_id in (select list(doc_id order by k) from d where k <= 64)] as held, []::bigint[] as gone, 0::bigint as before
  union all
  select drain + 1,
    list_concat(list_filter(held, lambda x: not list_contains(picks, x)), coalesce((select list(doc_id order by k) from d where k > 64 + drain * 32 and k <= 64 + (drain + 1) * 32), []::bigint[])),
    list_reverse(list_filter(held, lambda x: list_contains(picks, x))), before + len(gone)
  from (select *, list_transform(list_sort(list_transform(held, lambda x: {'h': ('0x' || substr(md5('buffer:' || drain || ':' || x), 1, 15))::bigint, 'id': x}))[1:32], lambda s: s.id) as picks from run where len(held) = 64)),
out as (select before + len(gone) as done, gone, before, held, drain from run),
emitted as (select unnest(gone) as doc_id, before + generate_subscripts(gone, 1) - 1 as place from out),
rest as (select unnest(held) as doc_id, done + generate_subscripts(held, 1) - 1 as place from out where drain = (select max(drain) from out))
select doc_id, place::bigint as place from emitted union all select doc_id, place::bigint from rest""".replace("[doc_id for doc_id in (select list(doc_id order by k) from d where k <= 64)]", "(select list(doc_id order by k) from d where k <= 64)"))
def mixing_buffer(spark, sf_dir):
    """The order of documents after a buffer of 64 that drains half of itself whenever it is full."""
    return mixing_buffers.drained_order(load(spark, sf_dir, "documents"), "doc_id", 64, "buffer")


@query(PACK.format(tok="""order_ as ({order}), """ + TOK.replace("from documents", "from documents") , by="", part="").replace("{order}", ORACLE["mixing_buffer"]).replace("order by doc_id, i", "order by place, i")
       .replace("select doc_id, source, list_append(ids, '<end>') as ids from tok where len(ids) > 0", "select place, doc_id, source, list_append(ids, '<end>') as ids from tok join order_ using (doc_id) where len(ids) > 0")
       .replace("select doc_id, source, unnest(ids) as t", "select place, doc_id, source, unnest(ids) as t").replace("with order_", "with recursive order_", 1)
       + " select window_id::bigint as window_id, md5(body) as digest from win")
def mixed_packing(spark, sf_dir):
    """Windows packed in the order that the mixing buffer gives; rows spread over several windows' distance, no token is lost."""
    placed = mixing_buffers.drained_order(load(spark, sf_dir, "documents"), "doc_id", 64, "buffer")
    docs = documents(spark, sf_dir).withColumn("ids", F.concat("ids", F.array(F.lit(END)))).join(placed, "doc_id")
    return packing.pack_windows(docs, LENGTH, "place", "ids").select("window_id", F.md5(F.array_join("ids", " ").cast("binary")).alias("digest"))


# Byte pairs -----------------------------------------------------------------

#: A small vocabulary: merges in the order of their ranks.
MERGES = [("t", "h"), ("th", "e"), ("i", "n"), ("e", "r"), ("a", "n"), ("o", "n"), ("r", "e"), (" ", "the"), ("in", "g"), ("an", "d"), ("t", "i"), ("ti", "on"), (" ", "o"), ("s", "t"), ("e", "n"), (" ", "and"), ("l", "y")]
MODEL_VOCABULARY = 268


def _merged_sql(cell: str) -> str:
    """The merges as replacements in a text of cells, each a token between bars."""
    hexed = lambda t: t.encode().hex().upper()
    for a, b in MERGES:
        cell = f"replace({cell}, '|{hexed(a)}||{hexed(b)}|', '|{hexed(a + b)}|')"
    return cell


CELLS = r"regexp_replace(hex(encode(piece)), '(..)', '|\1|', 'g')"
TOKEN_IDS = "values " + ", ".join([f"('{k:02X}', {k})" for k in range(256)] + [f"('{(a + b).encode().hex().upper()}', {256 + k})" for k, (a, b) in enumerate(MERGES)])


@query(rf"""with ids(cell, id) as ({TOKEN_IDS}), p as (select doc_id, unnest(regexp_extract_all(coalesce(text, ''), '\x20?[^\x20\x09-\x0D]+|[\x20\x09-\x0D]')) as piece, generate_subscripts(regexp_extract_all(coalesce(text, ''), '\x20?[^\x20\x09-\x0D]+|[\x20\x09-\x0D]'), 1) as k from documents),
  c as (select piece, {_merged_sql(CELLS)} as cells from (select distinct piece from p)),
  t as (select piece, unnest(string_split(trim(cells, '|'), '||')) as cell, generate_subscripts(string_split(trim(cells, '|'), '||'), 1) as i from c),
  j as (select doc_id, k, i, id from p join t using (piece) join ids using (cell)),
  d as (select doc_id, count(*)::bigint as n_tokens, md5(string_agg(id::varchar, ' ' order by k, i)) as digest, max(id) as top from j group by doc_id)
  select documents.doc_id, coalesce(n_tokens, 0) as n_tokens, coalesce(digest, md5('')) as digest, case when n_tokens is null then 'empty_tokenization' when top >= {MODEL_VOCABULARY} then 'out_of_vocab' else 'accepted' end as reason from documents left join d using (doc_id)""")
def byte_pair_tokens(spark, sf_dir):
    """Whole texts as byte-pair tokens, and whether they fit a model of fewer tokens."""
    rows = byte_pairs.encoded(load(spark, sf_dir, "documents").select("doc_id", "text"), "text", byte_pairs.from_pieces(MERGES))
    reason = F.coalesce(byte_pairs.vocabulary_reason(F.col("ids"), MODEL_VOCABULARY), F.lit("accepted"))
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), digest("ids").alias("digest"), reason.alias("reason"))


# Evaluation with two pools --------------------------------------------------

PUBLIC, POOL_ROWS, BOOTSTRAPS = 80, 100, 1000


@query(PACK.format(tok=TOK, by="", part="").replace("with tok", "with recursive tok", 1) + f""", n as (select count(*) as n from win),
{walk_sql("(select n from n)", f"(select least(n, {PUBLIC}) from n)", "public")},
pub as (select draw as p, index from sample),
hp as (select doc_id, ids, row_number() over (order by md5('pool:' || doc_id), doc_id) as rk from tok where len(ids) > 0 and source is not null qualify rk <= {POOL_ROWS}),
pt as (select rk, unnest(list_append(ids, '<end>')) as t, generate_subscripts(list_append(ids, '<end>'), 1) as i from hp), pp as (select t, row_number() over (order by rk, i) - 1 as p from pt),
priv as (select p // 128 as w, t from pp qualify count(*) over (partition by p // 128) = 128),
ht as (select p as pos, t from pub join pos on pos.pos // 128 = index union all select w + (select count(*) from pub), t from priv),
kc as (select t, count(*) as c from (select unnest(ids) as t from tok where lang = 'en') group by t), kt as (select sum(c) as total, count(*) as types from kc),
cc as (select t, count(*) as c from (select unnest(ids) as t from tok) group by t), ct as (select sum(c) as total, count(*) as types from cc),
k as (select pos, avg(-ln((coalesce(c, 0) + 1) / (total + types))) as king from ht left join kc using (t), kt group by pos), c as (select pos, avg(-ln((coalesce(c, 0) + 1) / (total + types))) as chall from ht left join cc using (t), ct group by pos),
dif as (select pos, king, chall, king - chall as diff from k join c using (pos)), m as (select count(*) as n from dif), np as (select count(*) as n_public from pub),
b as (select r.range as replicate, avg(diff) as mean from range({BOOTSTRAPS}) r, m, (select unnest(range(0, (select n from m))) as slot) s join dif on dif.pos = ('0x' || substr(md5('boot:' || r.range || ':' || s.slot), 1, 15))::bigint % (select n from m) group by 1)
select m.n::bigint as n, n_public::bigint as n_public, (m.n - n_public)::bigint as n_private, round((select avg(diff) from dif), 6) as mu_hat, round((select avg(diff) from dif where pos < n_public), 6) as mu_public, round((select avg(diff) from dif where pos >= n_public), 6) as mu_private,
  round((select quantile_cont(mean, 0.01) from b), 6) as lcb, round((select avg(king) from dif), 6) as avg_king_loss, round((select avg(chall) from dif), 6) as avg_challenger_loss, (select quantile_cont(mean, 0.01) from b) > 0.0025 as accepted,
  (select sha256(string_agg(index::varchar, chr(10) order by p)) from pub) as public_indices_digest, (select sha256(string_agg(doc_id::varchar, chr(10) order by rk)) from hp) as private_pool_digest
from m, np""")
def two_pool_evaluation(spark, sf_dir):
    """Two models on a public part, drawn by index from the packed corpus, and a private part, packed from a pool of its own."""
    docs = documents(spark, sf_dir, "lang")
    windows = written(packed(spark, sf_dir))
    drawn = written(permutation.sample_indices(spark, PUBLIC, windows.count(), "public"))
    public = windows.join(F.broadcast(drawn), F.col("window_id") == F.col("index")).select(F.col("draw").alias("at"), "ids")  # at most PUBLIC rows
    pool = written(sampling.take(docs.where("source is not null"), POOL_ROWS, "pool", "doc_id").withColumn("ids", F.concat("ids", F.array(F.lit(END)))))
    private = packing.pack_windows(pool, LENGTH, "rk", "ids").select(F.col("window_id").alias("at"), "ids")
    holdout, n_public = evaluation.two_part_holdout(public, private, "at")
    holdout = written(holdout)
    losses = lambda model: model.score(holdout, "pos", "ids")
    king, challenger = losses(UnigramScorer(docs.where("lang = 'en'"), "ids")), losses(UnigramScorer(docs, "ids"))
    diffs = written(evaluation.paired_differences(king, challenger, "pos"))
    out = evaluation.audit_record(spark, diffs, n_public, BOOTSTRAPS, "boot", 0.01, 0.0025)
    listed = lambda df, at, of, name: df.agg(F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(at, F.col(of).cast("string").alias("d")))), lambda x: x["d"]), "\n"), 256).alias(name))
    out = out.crossJoin(F.broadcast(listed(drawn, "draw", "index", "public_indices_digest"))).crossJoin(F.broadcast(listed(pool, "rk", "doc_id", "private_pool_digest")))  # one row each
    rounded = [r6(c) for c in ("mu_hat", "mu_public", "mu_private", "lcb", "avg_king_loss", "avg_challenger_loss")]
    return out.select("n", "n_public", "n_private", *rounded, "accepted", "public_indices_digest", "private_pool_digest")
