"""Headers of checkpoint files, counts and issues that follow from them, and digests by trees of hashes."""

import hashlib
import json
import random
import struct

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import hash_tree, rules
from corpusloom.sources import tensor_headers as H


def put(path, tensors, cut=0, metadata=True):
    head, at = ({"__metadata__": {"format": "pt"}} if metadata else {}), 0
    for name, dtype, shape in tensors:
        n = H.WIDTHS[dtype]
        for d in shape:
            n *= d
        head[name] = {"dtype": dtype, "shape": shape, "data_offsets": [at, at + n]}
        at += n
    raw = json.dumps(head).encode()
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes((struct.pack("<Q", len(raw)) + raw + bytes(at))[: -cut or None])
    return 8 + len(raw)


def test_headers(spark, tmp_path):
    data = put(tmp_path / "m1" / "a.safetensors", [("w", "BF16", [3, 5]), ("b", "F32", []), ("none", "I64", [0, 4])])
    put(tmp_path / "m1" / "b.safetensors", [("x", "F16", [7])], cut=3)
    (tmp_path / "m2").mkdir()
    (tmp_path / "m2" / "c.safetensors").write_bytes(b"1234567")
    (tmp_path / "m2" / "d.safetensors").write_bytes(struct.pack("<Q", 10**6) + b"{}")
    (tmp_path / "m2" / "e.safetensors").write_bytes(struct.pack("<Q", 4) + b"nope")
    (tmp_path / "m2" / "f.safetensors").write_bytes(struct.pack("<Q", 2) + b"{}")
    (tmp_path / "m2" / "g.txt").write_bytes(b"not a tensor")
    rows = {(r.file[-15:], r.tensor): r for r in H.read_tensors(spark, str(tmp_path)).collect()}
    w = next(r for r in rows.values() if r.tensor == "w")
    assert (w.dtype, w.shape, w.numel, w.begin, w.end, w.error) == ("BF16", [3, 5], 15, data, data + 30, None)
    got = {(r.file.rsplit("/", 1)[1], r.tensor): (r.numel, r.error) for r in rows.values()}
    assert got["a.safetensors", "b"] == (1, None) and got["a.safetensors", "none"] == (0, None) and got["b.safetensors", "x"] == (7, "beyond the file")
    broken = {k[0]: v[1] for k, v in got.items() if k[1] is None}
    assert set(broken) == {"c.safetensors", "d.safetensors", "e.safetensors"} and all(e.startswith("unreadable") for e in broken.values())
    counts = {r.model.rsplit("/", 1)[1]: (r.n_float, r.n_other) for r in H.type_counts(H.read_tensors(spark, str(tmp_path))).collect()}
    assert counts == {"m1": (3, 2)}


def test_a_large_file_is_not_read(spark, tmp_path):
    head = json.dumps({"w": {"dtype": "BF16", "shape": [1 << 20, 1 << 14], "data_offsets": [0, 1 << 35]}}).encode()
    with (tmp_path / "big.safetensors").open("wb") as f:
        f.write(struct.pack("<Q", len(head)) + head)
        f.truncate(8 + len(head) + (1 << 35))
    r = H.read_tensors(spark, str(tmp_path)).first()
    assert (r.numel, r.error, r.end - r.begin) == (1 << 34, None, 1 << 35)


def test_weight_issues(spark, tmp_path):
    for k, n in enumerate([400, 440, 90, 500]):
        put(tmp_path / "whole" / f"model-{k}.safetensors", [("w", "U8", [n])], metadata=False)
    names = {f"t{k}": f"model-{k % 5}.safetensors" for k in range(10)}
    (tmp_path / "whole" / H.INDEX).write_text(json.dumps({"weight_map": names}))
    put(tmp_path / "small" / H.SINGLE, [("w", "U8", [10])])
    put(tmp_path / "large" / H.SINGLE, [("w", "U8", [1_200_000])])
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / H.INDEX).write_text("no json")
    (tmp_path / "gone").mkdir()
    (tmp_path / "gone" / H.INDEX).write_text(json.dumps({"weight_map": {"a": "x.safetensors"}}))
    got = {(r.model.rsplit("/", 1)[1], r.file): r.issue for r in H.weight_issues(spark, str(tmp_path)).collect()}
    want = {("whole", f"model-{k}.safetensors"): None for k in (0, 1, 3)}
    want |= {("whole", "model-4.safetensors"): "missing", ("small", H.SINGLE): "truncated", ("large", H.SINGLE): None}
    sizes = {k: (tmp_path / "whole" / f"model-{k}.safetensors").stat().st_size for k in range(4)}
    want["whole", "model-2.safetensors"] = "truncated" if sizes[2] < 0.25 * sorted(sizes.values())[2] else None
    assert got == want


def test_written_files_are_read_back(spark, tmp_path):
    rows = [(f"m{k % 2}/s{k % 3}.safetensors", f"t{k:02d}", ["BF16", "F32"][k % 2], [k, 3]) for k in range(20)]
    sizes = {r.file: r.size for r in H.write_headers(spark.createDataFrame(rows, "file string, tensor string, dtype string, shape array<int>"), str(tmp_path)).collect()}
    got = H.read_tensors(spark, str(tmp_path)).collect()
    assert {(r.file.removeprefix(f"{tmp_path}/"), r.tensor, r.dtype, tuple(r.shape), r.size) for r in got} == {(f, t, d, tuple(s), sizes[f]) for f, t, d, s in rows}
    assert all(r.error is None for r in got)


# Parameter names and their class in a model with stacked experts.
STACKED_NAMES = {
    "model.embed_tokens.weight": "embed", "lm_head.weight": "lm_head", "layers.0.moe.experts_w12": "moe_experts_routed", "layers.0.moe.experts_w3": "moe_experts_routed",
    "layers.0.moe.shared_experts.0.w": "moe_experts_shared", "layers.0.moe.w_down_proj": "moe_dcca", "layers.0.moe.router.weight": "moe_router", "layers.0.moe.moe_bias": "moe_smebu_buffers",
    "layers.0.memory.W_alpha": "latent_memory", "layers.0.C_to_hidden": "other", "layers.0.ffn.gate.weight": "ffn_dense", "layers.0.attn.wq": "attn", "layers.0.g_proj": "attn",
    "layers.0.ln1.weight": "norm", "rotary_emb.inv_freq": "rope", "injection_gate": "injection", "bias": "other",
}


def test_third_classifier_and_counts(spark):
    rows = [(k % 2, n, [8, 4, 3] if "experts_w" in n else [5, 2]) for k in range(2) for n in STACKED_NAMES] + [(0, "model.embed_tokens.zweight", [100])]
    df = spark.createDataFrame(rows, "m int, name string, shape array<int>")
    got = {r.name: r.c for r in df.select("name", rules.block_class(F.col("name")).alias("c")).collect()}
    assert {k: got[k] for k in STACKED_NAMES} == STACKED_NAMES
    for tied in (False, True):
        out = {(r.m, r["class"]): (r.total, r.active) for r in rules.stacked_counts(df, "name", "shape", 2, tied, "m").collect()}
        n = 15 - tied
        assert out[0, "moe_experts_routed"] == (192, 48) and out[1, "(all)"] == (10 * n + 192, 10 * n + 48)
        assert out[0, "embed"][0] == (10 if tied else 110) and ((0, "lm_head") in out) is not tied


def tree(raw, leaf, fan):
    level = [hashlib.sha256(b"\0" + raw[k : k + leaf]).digest() for k in range(0, max(1, len(raw)), leaf)]
    while len(level) > 1:
        level = [hashlib.sha256(b"\1" + b"".join(level[k : k + fan])).digest() for k in range(0, len(level), fan)]
    return hashlib.sha256(b"\2" + len(raw).to_bytes(8, "big") + level[0]).hexdigest()


@pytest.mark.parametrize("fan, partitions", [(1024, 1), (4, 3), (2, 7)])
def test_tree_digests(spark, tmp_path, monkeypatch, fan, partitions):
    """The same root whatever the split, from files as from rows."""
    monkeypatch.setattr(hash_tree, "FAN", fan)
    rng = random.Random(5)
    contents = {f"f{k}": rng.randbytes(n) for k, n in enumerate([0, 1, 15, 16, 17, 64, 65, 1000, 4097])}
    for name, raw in contents.items():
        (tmp_path / name).write_bytes(raw)

    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = {r.file.rsplit("/", 1)[1]: (r.root, r.size, r.n_leaves) for r in hash_tree.file_digests(spark, str(tmp_path), leaf=16).collect()}
        rows = spark.createDataFrame([(k, bytearray(v)) for k, v in contents.items()], "key string, raw binary")
        same = {r.key: (r.root, r.size, r.n_leaves) for r in hash_tree.row_digests(rows, "key", "raw", leaf=16).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got == same == {k: (tree(v, 16, fan), len(v), max(1, -(-len(v) // 16))) for k, v in contents.items()}
