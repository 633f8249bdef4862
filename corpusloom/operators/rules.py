"""Decision rules: hygiene of submissions, probes and their gates, tuning rounds, reports and queues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import parsing as P

# Parts of parameter names, looked for in this order; the first class with a part in the name counts.
GRADIENT_CLASSES = (
    ("lm_head", ("lm_head",)),
    ("embed", ("embed_tokens", "wte", "embeddings")),
    ("norm", ("norm", "layernorm", "rmsnorm", ".ln1.", ".ln2.", ".ln1_out.", ".ln2_out.", ".embed_norm.")),
    ("memory", (".memory.", "summary_proj", "summary_query", "compress_z", "w_qkv_mem", "eta_channels", "w_eta", "c_to_hidden", "w_alpha")),
    ("moe_router", ("router", "router_weights")),
    ("moe_routed", ("experts_w12", "experts_w3")),
    ("moe_shared", ("shared_experts",)),
    ("moe_dcca", ("w_down_proj", "w_up_proj")),
    ("moe_smebu", ("moe_bias", "moe_momentum", "max_vio", "expert_bias")),
    ("looped_inject", ("injection_gate",)),
    ("attn", ("q_proj", "k_proj", "v_proj", "o_proj", "q_norm", "k_norm", "wq.", "wk.", "wv.", "wo.", "self_attn", "attention", "g_proj", "f_proj", "a_proj", "b_proj", ".attn.")),
    ("ffn", ("gate_proj", "up_proj", "down_proj", "mlp", "ffn", "fc1", "fc2", "feed_forward", ".w1.", ".w2.", ".w3.", "ffn.gate", "ffn.up", "ffn.down")),
)
SIZE_CLASSES = (
    ("embed", ("embed_tokens",)),
    ("lm_head", ("lm_head",)),
    ("moe_experts", (".experts.",)),
    ("moe_router", (".mlp.gate.weight",)),
    ("attn", ("q_proj", "k_proj", "v_proj", "o_proj", "q_norm", "k_norm", "self_attn")),
    ("mlp_dense", ("gate_proj", "up_proj", "down_proj")),
    ("norm", ("norm",)),
)
BLOCK_CLASSES = (
    ("embed", ("embed_tokens",)),
    ("lm_head", ("lm_head",)),
    ("moe_experts_routed", ("experts_w12", "experts_w3")),
    ("moe_experts_shared", ("shared_experts",)),
    ("moe_dcca", ("w_down_proj", "w_up_proj")),
    ("moe_router", ("router",)),
    ("moe_smebu_buffers", ("moe_bias", "moe_momentum", "max_vio")),
    ("latent_memory", (".memory.",)),
    ("ffn_dense", ("ffn.gate", "ffn.up", "ffn.down")),
    ("attn", ("attn.", "_proj")),
    ("norm", ("norm", "ln1", "ln2")),
    ("rope", ("rotary_emb",)),
    ("injection", ("injection_gate",)),
)
#: Parts of the names of tensors that hold all experts of a layer, one in each row.
STACKED = ("experts_w12", "experts_w3")
#: Endings that name a class by themselves: the first before all parts but the head's, the second after all of them.
EMBEDDING_END, BIAS_END = ".embedding.weight", ".bias"


def _first_class(name: Column, classes) -> Column:
    case = F
    for label, parts in classes:
        hit = F.lit(False)
        for p in parts:
            hit = hit | name.contains(p)
        case = case.when(hit, label)
    return case


def gradient_class(name: Column) -> Column:
    """The coarse class of a parameter, for norms of gradients by class."""
    n = F.lower(name)
    case = F.when(n.contains("lm_head"), "lm_head").when(n.endswith(EMBEDDING_END), "embed")
    return F.coalesce(case, _first_class(n, GRADIENT_CLASSES), F.when(n.endswith(BIAS_END), "bias").otherwise("other"))


def size_class(name: Column) -> Column:
    """The class of a parameter, for counts of total and active parameters."""
    return _first_class(F.lower(name), SIZE_CLASSES).otherwise("other")


def parameter_counts(parameters: DataFrame, name: str, numel: str, top_k: int, experts: int, tied: bool) -> DataFrame:
    """(class, total, active) and a row ``(all)``: of an expert's parameters ``top_k / experts`` are active.

    With tied embeddings the head does not count.
    """
    rows = parameters.where(~F.col(name).contains("lm_head")) if tied else parameters
    active = F.when(F.col(name).contains(".experts."), F.floor(F.col(numel) * top_k / experts)).otherwise(F.col(numel))
    rows = rows.select(size_class(F.col(name)).alias("class"), F.col(numel).alias("n"), active.alias("a"))
    out = rows.rollup("class").agg(F.sum("n").alias("total"), F.sum("a").alias("active"))
    return out.select(F.coalesce("class", F.lit("(all)")).alias("class"), "total", "active")


def block_class(name: Column) -> Column:
    """The class of a parameter of a model whose experts are stacked."""
    return _first_class(F.lower(name), BLOCK_CLASSES).otherwise("other")


def stacked_counts(tensors: DataFrame, name: str, shape: str, top_k: int, tied: bool, *by: str) -> DataFrame:
    """(*by, class, total, active) and a row ``(all)`` of tensors by their shapes: of stacked experts ``top_k`` are active.

    With tied embeddings the head does not count, and of several embeddings only
    the first by name does.
    """
    n = F.aggregate(shape, F.lit(1).cast("long"), lambda x, d: x * d)
    stacked = F.col(name).contains(STACKED[0]) | F.col(name).contains(STACKED[1])
    rows = tensors.select(*by, F.col(name).alias("_name"), block_class(F.col(name)).alias("class"), n.alias("n"), F.when(stacked, F.floor(n / F.col(shape)[0]) * top_k).otherwise(n).alias("a"))
    if tied:
        first = rows.where(F.col("_name").contains("embed_tokens")).groupBy(*by).agg(F.min("_name").alias("_first"))
        rows = rows.where(~F.col("_name").contains("lm_head"))
        rows = (rows.join(first, list(by), "left") if by else rows.crossJoin(F.broadcast(first))).where(~F.col("_name").contains("embed_tokens") | (F.col("_name") == F.col("_first")))
    return rows.groupingSets([[*map(F.col, by), F.col("class")], [*map(F.col, by)]], *by, "class").agg(F.sum("n").alias("total"), F.sum("a").alias("active")).select(
        *by, F.coalesce("class", F.lit("(all)")).alias("class"), "total", "active"
    )


# Hygiene --------------------------------------------------------------------

# Fixed value: the names of a model's numbered files.
SHARD_FILE = r"^model-\d{5}-of-\d{5}\.safetensors$"


def layout_reason(files: DataFrame, repo: str, name: str, size: str, auto_map: str, most_bytes: int) -> DataFrame:
    """(repo, reason): the first rule that a repository's files break, or ``ok``."""
    f = F.col(name)
    has = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    tensor = f.endswith(".safetensors")
    per = files.groupBy(repo).agg(
        has(F.col(auto_map)).alias("map"), has(f.endswith(".py")).alias("py"), has(tensor).alias("any"), has(f == "model.safetensors").alias("single"),
        has(f == "model.safetensors.index.json").alias("index"), has(f.rlike(SHARD_FILE)).alias("shards"), F.coalesce(F.sum(F.when(tensor, F.col(size))), F.lit(0)).alias("bytes"),
    )
    c = {k: F.col(k) for k in ("map", "py", "any", "single", "index", "shards")}
    whole = c["single"] | (c["index"] & c["shards"])
    reason = (
        F.when(c["map"], "auto_map").when(c["py"], "py_files").when(~c["any"], "no_safetensors").when(~whole & c["shards"] & ~c["index"], "missing_index")
        .when(~whole, "not_canonical").when(F.col("bytes") > most_bytes, "oversized").otherwise("ok")
    )
    return per.select(repo, reason.alias("reason"))


def submission_issues(files: DataFrame, repo: str, name: str, auto_map: str) -> DataFrame:
    """(repo, issues): every rule that a merged model's folder breaks, in a fixed order."""
    f = F.col(name)
    has = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    weights = (f == "model.safetensors") | (f == "model.safetensors.index.json") | f.rlike(r"^model-.*-of-.*\.safetensors$")
    per = files.groupBy(repo).agg(
        has(f == "config.json").alias("config"), has(f.isin("tokenizer.json", "tokenizer_config.json")).alias("tokenizer"), has(weights).alias("weights"),
        has(f.endswith(".py")).alias("py"), has((f == "config.json") & F.col(auto_map)).alias("map"),
    )
    issues = F.concat_ws(
        ",", F.when(~F.col("config"), "missing_config"), F.when(~F.col("tokenizer"), "missing_tokenizer"), F.when(~F.col("weights"), "missing_weights"),
        F.when(F.col("py"), "py_files"), F.when(F.col("map"), "auto_map"),
    )
    return per.select(repo, issues.alias("issues"))


def lenient_mismatch(left: DataFrame, right: DataFrame, key: str, name: str, value: str, locked: tuple[str, ...]) -> DataFrame:
    """(key, first_mismatch) over the locked settings that both sides have and that differ; the first in the order of the list."""
    a = left.where(F.col(value).isNotNull()).select(key, name, F.col(value).alias("_a"))
    b = right.where(F.col(value).isNotNull()).select(key, name, F.col(value).alias("_b"))
    place = F.array_position(F.array(*map(F.lit, locked)), F.col(name))
    return a.join(b, [key, name]).where(F.col(name).isin(*locked) & (F.col("_a") != F.col("_b"))).groupBy(key).agg(F.min_by(name, place).alias("first_mismatch"))


# Settings that the weights decide, so that they cannot be patched.
WEIGHT_BOUND = (
    "vocab_size", "hidden_size", "num_hidden_layers", "num_attention_heads", "num_key_value_heads", "head_dim", "intermediate_size", "model_type",
)


def patch_plan(mismatches: DataFrame, key: str, name: str) -> DataFrame:
    """(key, refused, patched): settings that differ, by whether they can be patched; any refused one stops all patches."""
    bound = F.col(name).isin(*WEIGHT_BOUND)
    listed = lambda c: F.array_join(F.array_sort(F.collect_list(F.when(c, F.col(name)))), ",")
    out = mismatches.groupBy(key).agg(listed(bound).alias("refused"), listed(~bound).alias("_p"))
    return out.select(key, "refused", F.when(F.col("refused") == "", F.col("_p")).otherwise("").alias("patched"))


# Probes ---------------------------------------------------------------------

def _finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))


def probe_summary(seeds: DataFrame, key: str, loss: str, norm: str, groups: str) -> DataFrame:
    """One row for each model over its seeds: least and greatest finite loss, greatest finite norm, and the greatest group norm."""
    good = lambda c: F.when(_finite(F.col(c)), F.col(c))
    top = F.array_max(F.filter(F.map_values(groups), _finite))
    return seeds.groupBy(key).agg(
        F.count("*").alias("n_seeds"), F.min(good(loss)).alias("min_loss"), F.max(good(loss)).alias("max_loss"), F.max(good(norm)).alias("max_norm"), F.max(top).alias("max_group_norm"),
    )


def group_maxima(seeds: DataFrame, key: str, groups: str) -> DataFrame:
    """(key, group, norm): the greatest finite norm of each parameter group over the seeds."""
    each = seeds.select(key, F.explode(groups).alias("group", "norm"))
    return each.where(_finite(F.col("norm"))).groupBy(key, "group").agg(F.max("norm").alias("norm"))


def gate_reason(finite: Column, overall: Column, worst_group: Column, cap: float = 500.0, group_cap: float = 500.0) -> Column:
    """The first gate that a probe fails, or ``ok``."""
    return F.when(~finite, "not_finite").when(overall > cap, "norm_exceeded").when(worst_group > group_cap, "group_norm_exceeded").otherwise("ok")


def norm_peak(rows: DataFrame, key: str, weight: str) -> DataFrame:
    """(key, peak): the largest absolute weight, NaN if one is no finite number."""
    bad = F.bool_or(~_finite(F.col(weight)))
    return rows.groupBy(key).agg(F.when(bad, F.lit(float("nan"))).otherwise(F.max(F.abs(weight))).alias("peak"))


# Tuning ---------------------------------------------------------------------

# Targets of a production run, and phases that count for it.
CROWN_MU, CROWN_LCB, PHASES = 0.004, 0.003, ("confirm", "strong")


def production_ready(phase: Column, mu: Column, lcb: Column) -> Column:
    return F.coalesce(phase.isin(*PHASES) & (mu >= CROWN_MU) & (lcb >= CROWN_LCB), F.lit(False))


# The specs of a first round, and the means that stand for a missing one.
SEED_SPECS = ("r64:a64:lr5e-5:d0.0:e0.5", "r64:a128:lr5e-5:d0.0:e0.5", "r32:a64:lr5e-5:d0.0:e0.5", "r64:a64:lr8e-5:d0.0:e0.5", "r64:a64:lr3e-5:d0.0:e0.5")
NO_MEAN, NO_RESULT = -1.0, -999.0
# Below these means the rates go down, or are varied widely; around it they are varied closely.
LOW_MU, NEAR_MU = -0.001, 0.0
LOW_RATES, LOW_EPOCHS = (0.6, 0.8, 1.0), (0.5,)
NEAR_RATES, NEAR_EPOCHS = (0.85, 1.0, 1.15), (0.5, 0.8)
GOOD_RATES, GOOD_EPOCHS = (0.9, 1.0, 1.1), (0.8, 1.0)


def known_mean(mu: Column, missing: float) -> Column:
    """A mean that is missing, or exactly 0, which counts as missing."""
    return F.coalesce(F.nullif(mu, F.lit(0.0)), F.lit(missing))


def candidate_specs(p: Column, mu: Column) -> Column:
    """Specs to try next around a configuration (a struct as of parse_spec), by how good it was, repeats included.

    Without a configuration, as in a first round, the seeds; a missing mean
    counts as the worst.
    """
    mu = known_mean(mu, NO_MEAN)

    def spec(lr, e, r=None, a=None):
        return F.struct(
            (p["r"] if r is None else F.lit(r)).alias("r"), (p["a"] if a is None else F.lit(a)).alias("a"), (p["lr"] * lr).alias("lr"),
            p["dropout"].alias("dropout"), (p["epochs"] if e is None else F.lit(e)).alias("epochs"),
        )

    own = F.array(spec(1.0, None))
    none = F.filter(own, lambda s: F.lit(False))
    change = (
        F.when(p["r"] == 64, F.array(spec(1.0, 0.5, 32, 64), spec(0.8, 0.5, 64, 128)))
        .when(p["r"] == 32, F.array(spec(1.0, 0.5, 64, 64))).otherwise(none)
    )
    around = lambda lrs, es: F.array(*(spec(lr, e) for lr in lrs for e in es))
    more = (
        F.when(mu < LOW_MU, F.concat(around(LOW_RATES, LOW_EPOCHS), change)).when(mu < NEAR_MU, around(NEAR_RATES, NEAR_EPOCHS))
        .otherwise(around(GOOD_RATES, GOOD_EPOCHS))
    )
    made = F.transform(F.concat(own, more), lambda s: P.format_spec(s["r"], s["a"], s["lr"], s["dropout"], s["epochs"]))
    return F.when(p.isNull(), F.array(*map(F.lit, SEED_SPECS))).otherwise(made)


def distinct_specs(specs: Column, most: int) -> Column:
    """The first ``most`` different specs, whatever their case."""
    clean = F.filter(F.transform(specs, lambda s: F.trim(s)), lambda s: s != "")
    fresh = F.filter(clean, lambda s, i: F.array_position(F.transform(clean, lambda x: F.lower(x)), F.lower(s)) == i + 1)
    return F.slice(fresh, 1, most)


def confirm_plan(p: Column, mu: Column, least_mu: float = -0.002) -> tuple[Column, Column, Column, Column]:
    """(skip, confirm spec, second confirm spec, strong spec) of the best of a micro screen.

    The second trains a fifth longer, up to 1.5 epochs, and is null where that
    makes no other spec.  A missing mean is skipped.
    """
    spec = lambda e: P.format_spec(p["r"], p["a"], p["lr"], p["dropout"], e)
    epochs = F.greatest(p["epochs"], F.when(known_mean(mu, NO_MEAN) >= 0, 0.8).otherwise(0.5))
    first, second = spec(epochs), spec(F.least(epochs * 1.2, F.lit(1.5)))
    return known_mean(mu, NO_RESULT) < least_mu, first, F.when(second != first, second), spec(F.greatest(p["epochs"], F.lit(1.0)))


# Reports and queues ---------------------------------------------------------

def screening_report(analyses: DataFrame, source: str) -> DataFrame:
    """One row over the few sources: ranking by score, blockers, saturated sources, and what to do."""
    blocked = (F.col("score") < 0.35) | F.col("issues").contains("low_shard_cache")
    row = F.struct((-F.col("score")).alias("_by"), F.col(source).alias("name"), blocked.alias("blocked"), F.col("hard_saturated").alias("full"))
    listed = F.array_sort(F.collect_list(row))
    names = lambda xs: F.array_join(F.transform(xs, lambda x: x["name"]), ",")
    out = analyses.agg(listed.alias("l")).select(
        names(F.col("l")).alias("ranking"), names(F.filter("l", lambda x: x["blocked"])).alias("blockers"), names(F.filter("l", lambda x: x["full"])).alias("saturated"),
    )
    best = F.concat(F.lit("best:"), F.split_part("ranking", F.lit(","), F.lit(1)))
    advice = F.concat_ws(" ", best, F.when(F.col("blockers") != "", F.concat(F.lit("prefetch:"), "blockers")), F.when(F.col("saturated") != "", F.concat(F.lit("more_shards:"), "saturated")))
    return out.withColumn("advice", F.when(F.col("ranking") == "", "none_scored").otherwise(advice))


def requeued(queue: DataFrame, failed: DataFrame, group: str, order: str, repo: str, most: int) -> DataFrame:
    """The queue after transient failures: a failed entry goes to the front with one more retry, others of its repository go.

    Entries beyond ``most`` retries do not come back.  ``queue`` and ``failed``
    have the same columns, with ``retry``; ``failed`` has one row for each group.
    """
    front = failed.withColumn("retry", F.col("retry") + 1).where(F.col("retry") <= most).withColumn(order, F.lit(-1).cast("long"))
    same = failed.select(F.col(group).alias("_group"), F.col(repo).alias("_repo"))
    rest = queue.join(same, queue[group].eqNullSafe(same["_group"]) & queue[repo].eqNullSafe(same["_repo"]), "left_anti")
    both = front.unionByName(rest)
    return both.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy(order)))


def zipped_dimension(keys: DataFrame, emissions: DataFrame, owners: DataFrame) -> DataFrame:
    """(uid, key, emission, owner) of three parallel lists, each as (uid, value) rows by position.

    Short lists are padded with 0 and null, empty owners are null, positions
    beyond the keys are dropped.
    """
    k = keys.where("value is not null").withColumnRenamed("value", "key")
    e, o = emissions.withColumnRenamed("value", "emission"), owners.select("uid", F.nullif("value", F.lit("")).alias("owner"))
    return k.join(e, "uid", "left").join(o, "uid", "left").select("uid", "key", F.coalesce("emission", F.lit(0.0)).alias("emission"), "owner")
