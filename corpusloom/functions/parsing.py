"""Parsers and formatters of the small texts that jobs exchange: sweep specs, settings, reveals, keys, log lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The form of a sweep spec, what its optional parts default to, and the spec to start from.
SPEC = r"(?i)^r(\d+):a(\d+):lr([\de.\-+]+)(?::d([\de.\-+]+))?(?::e([\de.\-+]+))?$"
DROPOUT, EPOCHS = 0.0, 0.5
SEED_SPECS = (
    "r64:a64:lr5e-5:d0.0:e0.5", "r64:a128:lr5e-5:d0.0:e0.5", "r32:a64:lr5e-5:d0.0:e0.5",
    "r64:a64:lr8e-5:d0.0:e0.5", "r64:a64:lr3e-5:d0.0:e0.5",
)


def _group(text: Column, pattern: str, k: int) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, k), F.lit(""))


def parse_spec(spec: Column) -> Column:
    """A struct (r, a, lr, dropout, epochs); the last two parts may be missing; null for anything else."""
    s = F.trim(spec)
    return F.when(
        s.rlike(SPEC),
        F.struct(
            _group(s, SPEC, 1).cast("int").alias("r"), _group(s, SPEC, 2).cast("int").alias("a"), _group(s, SPEC, 3).try_cast("double").alias("lr"),
            F.coalesce(_group(s, SPEC, 4).try_cast("double"), F.lit(DROPOUT)).alias("dropout"),
            F.coalesce(_group(s, SPEC, 5).try_cast("double"), F.lit(EPOCHS)).alias("epochs"),
        ),
    )


def general(x: Column) -> Column:
    """A number with up to six digits, without trailing zeros, in powers of ten where it is very small or large."""
    shown = F.format_string("%.5e", x)
    power = F.regexp_extract(shown, r"e([+-]\d+)$", 1).cast("int")
    mantissa = F.regexp_replace(F.regexp_extract(shown, r"^(.*)e", 1), r"\.?0+$", "")
    sign = F.when(power < 0, "-").otherwise("+")
    far = F.concat(mantissa, F.lit("e"), sign, F.lpad(F.abs(power).cast("string"), 2, "0"))
    near = F.regexp_replace(shown.cast("double").cast("decimal(38,12)").cast("string"), r"\.?0+$", "")
    return F.when(x == 0, "0").when((power < -4) | (power >= 6), far).otherwise(near)


def format_spec(r: Column, a: Column, lr: Column, dropout: Column, epochs: Column) -> Column:
    return F.concat(F.lit("r"), r, F.lit(":a"), a, F.lit(":lr"), general(lr), F.lit(":d"), general(dropout), F.lit(":e"), general(epochs))


def configuration(columns: Column, text: Column) -> Column:
    """The spec of a result row: its own columns (a struct, null if missing), else its text with ``:`` or ``_``, else the seed."""
    label = F.trim(F.coalesce(text, F.lit("")))
    seed = parse_spec(F.lit(SEED_SPECS[0]))
    by_label = F.coalesce(parse_spec(F.replace(label, F.lit("_"), F.lit(":"))), seed)
    return F.when(columns.isNotNull(), columns).when(label == "", seed).when(label.contains("_") & ~label.contains(":"), by_label).otherwise(parse_spec(label))


def setting(text: Column) -> tuple[Column, Column]:
    """(name, value) of ``name=value``, both trimmed; null without a sign or a part."""
    at = F.instr(text, "=")
    name, value = F.trim(F.substring(text, F.lit(1), at - 1)), F.trim(F.substring(text, at + 1, F.length(text)))
    good = (at > 0) & (name != "") & (value != "")
    return F.when(good, name), F.when(good, value)


def bucket_mix(text: Column) -> tuple[Column, Column]:
    """(name, array of three shares) of ``name=g:h:e``; null shares if there are not three numbers."""
    name, value = setting(text)
    parts = F.transform(F.split(value, ":"), lambda x: F.trim(x).try_cast("double"))
    return name, F.when((F.size(parts) == 3) & ~F.exists(parts, lambda x: x.isNull()), parts)


def url_base(url: Column, default: str) -> Column:
    """Scheme, host and what stands before ``/dataset/``."""
    found = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]+)([^?#]*)", 1)
    host = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]+)([^?#]*)", 2)
    path = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]+)([^?#]*)", 3)
    head = F.regexp_replace(F.split_part(path, F.lit("/dataset/"), F.lit(1)), "/+$", "")
    return F.when((found != "") & (host != ""), F.concat(found, F.lit("://"), host, head)).otherwise(default)


def url_join(base: Column, key: Column) -> Column:
    """The key below the base; a key that is a URL stays."""
    k = F.trim(key)
    return F.when(k.rlike("^https?://"), k).otherwise(F.concat(F.regexp_replace(base, "/+$", ""), F.lit("/"), F.regexp_replace(k, "^/+", "")))


def destination(prefix: Column, source_prefix: Column, path: Column) -> Column:
    """The path below a new prefix, without the old one."""
    rest = F.when(F.startswith(path, source_prefix), F.regexp_replace(F.substring(path, F.length(source_prefix) + 1, F.length(path)), "^/+", "")).otherwise(path)
    return F.concat(F.regexp_replace(prefix, "/+$", ""), F.lit("/"), rest)


# What references to models look like.
REPO = r"^[a-zA-Z0-9][a-zA-Z0-9._-]*/[a-zA-Z0-9][a-zA-Z0-9._/-]*$"
DIGEST = r"^(sha256:[0-9a-f]{64}|hf:[0-9a-f]{40})$"
HOTKEY = r"^[1-9A-HJ-NP-Za-km-z]{47,48}$"


def valid_reference(repo: Column, digest: Column) -> Column:
    return F.coalesce(F.trim(repo).rlike(REPO) & F.trim(digest).rlike(DIGEST), F.lit(False))


def build_reveal(repo: Column, digest: Column, hotkey: Column, king: Column | None = None) -> Column:
    """``v4|repo|digest|hotkey``, or ``v3|king|repo|digest|hotkey`` with a king's digest; null if a part is malformed."""
    key = F.trim(hotkey)
    good = valid_reference(repo, digest) & F.coalesce(key.rlike(HOTKEY), F.lit(False))
    parts = [F.lit("v4")] if king is None else [F.lit("v3"), F.trim(king)]
    if king is not None:
        good = good & F.coalesce(F.trim(king).rlike(DIGEST), F.lit(False))
    return F.when(good, F.concat_ws("|", *parts, F.trim(repo), F.trim(digest), key))


def parse_reveal(payload: Column, version: str = "v4") -> Column:
    """A struct of king, repo, digest and hotkey of a reveal of the given version; null if malformed. A v4 has no king."""
    p = F.transform(F.split(F.trim(payload), r"\|"), lambda x: F.trim(x))
    at = 1 if version == "v4" else 2
    king = F.lit(None).cast("string") if version == "v4" else F.get(p, F.lit(1))
    repo, digest, hotkey = F.get(p, F.lit(at)), F.get(p, F.lit(at + 1)), F.get(p, F.lit(at + 2))
    good = (F.size(p) == at + 3) & (F.get(p, F.lit(0)) == version) & valid_reference(repo, digest) & hotkey.rlike(HOTKEY)
    if version != "v4":
        good = good & king.rlike(DIGEST)
    return F.when(good, F.struct(king.alias("king"), repo.alias("repo"), digest.alias("digest"), hotkey.alias("hotkey")))


def commitment_text(payload: Column) -> Column:
    """The text of a length-prefixed payload, given as 0x and hex digits or as one character for each byte.

    The lowest two bits of the first byte say whether the length takes one, two
    or four bytes.  Bytes that are no UTF-8 are left out; empty payloads are null.
    """
    raw = F.when(payload.rlike("^0[xX]"), F.unhex(F.substring(payload, F.lit(3), F.length(payload)))).otherwise(F.encode(payload, "ISO-8859-1"))
    mode = F.conv(F.hex(F.substring(raw, 1, 1)), 16, 10).cast("int").bitwiseAND(F.lit(3))
    skip = F.when(mode == 0, 1).when(mode == 1, 2).otherwise(4)
    text = F.make_valid_utf8(F.substring(raw, skip + 1, F.octet_length(raw)).cast("string"))
    return F.when(F.octet_length(raw) > 0, F.replace(text, F.lit("�"), F.lit("")))


# The metric that counts for a task, where it is not ``acc``.
TASK_METRIC = {
    "arc_challenge": "acc_norm", "arc_easy": "acc_norm", "piqa": "acc_norm", "openbookqa": "acc_norm", "hellaswag": "acc_norm",
    "winogrande": "acc", "mmlu": "acc",
}


def task_metric(task: Column) -> Column:
    pairs = [F.lit(x) for kv in TASK_METRIC.items() for x in kv]
    return F.coalesce(F.create_map(*pairs)[task], F.lit("acc"))


def primary_metric(node: Column, metric: Column) -> Column:
    """The metric of a task's map of numbers: ``m,none``, then ``m``, then ``m,flexible-extract``, then any ``acc,…``."""
    other = F.map_values(F.map_filter(node, lambda k, v: F.startswith(k, F.lit("acc,")) & v.isNotNull()))
    return F.coalesce(node[F.concat(metric, F.lit(",none"))], node[metric], node[F.concat(metric, F.lit(",flexible-extract"))], F.get(other, F.lit(0)))


# What a log line may tell, by the name of what it tells; groups are the parts.
LOG_PATTERNS = {
    "eval": r"eval\s+(\d+)/(\d+)\s*\|\s*mu_hat=([-\d.eE+]+)",
    "micro": r"(?i)micro-screen[:\s]+([^\s:]+)",
    "sweep": r"(?i)=== LoRA sweep:\s*(\S+)",
    "scoring": r"(?i)mixture scoring (\S+):\s*n=(\d+)",
    "score_batch": r"mixture scoring (\S+)\s+(\d+)/(\d+)\s*\(([\d.]+)%\)",
    "train_step": r"(\d+)%\|.*?\[.*?(\d+)/(\d+)",
    "loss": r"'loss':\s*'([\d.]+)'.*'epoch':\s*'([\d.]+)'",
}


def log_part(line: Column, name: str, group: int) -> Column:
    return _group(line, LOG_PATTERNS[name], group)


def file_size_text(n: Column) -> Column:
    """Bytes with two digits after the point in the largest unit below 1,024 of the next; halves go to even."""
    units = ["B", "KiB", "MiB", "GiB", "TiB"]
    out = None
    for k, unit in enumerate(units):
        text = F.format_string("%.2f " + unit, F.bround(n / float(1 << 10 * k), 2))
        test = n < 1 << 10 * (k + 1)
        out = F.when(test, text) if out is None else out.when(test, text) if k + 1 < len(units) else out.otherwise(text)
    return out


def duration_text(seconds: Column) -> Column:
    s = seconds.cast("long")
    minutes = F.concat(F.floor(s / 60), F.lit("m "), s % 60, F.lit("s"))
    return F.when(s < 60, F.concat(s, F.lit("s"))).when(s < 3600, minutes).otherwise(F.concat(F.floor(s / 3600), F.lit("h "), F.floor(s % 3600 / 60), F.lit("m")))


def rate_mib(n_bytes: Column, seconds: Column) -> Column:
    """MiB a second; 0 where no time has passed."""
    return F.when(seconds > 0, n_bytes / float(1 << 20) / seconds).otherwise(0.0)


def run_time(prefix: Column) -> Column:
    """The time of a run folder named like ``name-20240131T235959Z/``; null if there is none."""
    return F.try_to_timestamp(_group(prefix, r"(\d{8}T\d{6}Z)/?$", 1), F.lit("yyyyMMdd'T'HHmmss'Z'"))


def age_seconds(text: Column, now: Column) -> Column:
    """Seconds since an ISO time, not below 0; null if it cannot be read."""
    age = F.unix_timestamp(now) - F.unix_timestamp(F.try_to_timestamp(text))
    return F.when(age < 0, 0).otherwise(age)


def emission_value(sqrt_price: Column, gross_nano: Column, server: Column, validator: Column, owner: Column) -> tuple[Column, Column]:
    """(price, miners' amount a block): the price is a square; a missing or empty split counts as one half."""
    total = server + validator + owner
    share = F.when(F.coalesce(total > 0, F.lit(False)), server / total).otherwise(0.5)
    return sqrt_price * sqrt_price, F.coalesce(gross_nano, F.lit(0.0)) / 1e9 * share


def tokenizer_clash(tokenizer: Column, architecture: Column, own: str, bound: tuple[str, ...], foreign: tuple[str, ...]) -> Column:
    """Whether shards of a foreign family's tokenizer meet an architecture that is bound to its own.

    Families are recognised by parts of names, in any case; shards of the family
    ``own`` go with every architecture.
    """
    t, a = F.lower(F.coalesce(tokenizer, F.lit(""))), F.lower(F.coalesce(architecture, F.lit("")))
    has = lambda c, parts: F.array_contains(F.transform(F.array(*(F.lit(p) for p in parts)), lambda p: c.contains(p)), True)
    return ~t.contains(own) & has(a, bound) & has(t, foreign)


def dataset_mode(requested: Column, local_manifest: Column, clash: Column) -> Column:
    """``local`` and ``remote`` are other names; ``auto`` takes local shards, then what the tokenizer allows."""
    named = F.when(requested == "local", "pretokenized").when(requested == "remote", "raw").otherwise(requested)
    return F.when(named != "auto", named).when(local_manifest, "pretokenized").when(clash, "raw").otherwise("pretokenized")


def prefix_in_repo(repo: Column, prefix: Column, strict: bool) -> Column:
    """Whether the first eight characters of a key stand in the repository: in its last part as written, or anywhere in any case."""
    p = F.substring(F.trim(F.coalesce(prefix, F.lit(""))), 1, 8)
    if strict:
        return (p == "") | F.element_at(F.split(repo, "/"), -1).contains(p)
    return (p == "") | F.lower(repo).contains(F.lower(p))


def chain_match(expected: Column, found: Column) -> Column:
    """``skipped`` without an expectation, ``unknown`` without an answer, else ``match`` or ``mismatch``."""
    e, f = F.trim(F.coalesce(expected, F.lit(""))), F.trim(F.coalesce(found, F.lit("")))
    return F.when(e == "", "skipped").when(f == "", "unknown").when(e == f, "match").otherwise("mismatch")
