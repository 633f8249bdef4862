"""Tensors of checkpoints from the headers of their ``safetensors`` files, and what follows from them.

A file begins with the length of a JSON header, 8 bytes, and the header with
type, shape and byte range of each tensor; the data behind it are never read.
"""

from __future__ import annotations

import json
import math
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from ..operators.records import upper_medians
from .array_files import store_of

# Fixed values of the format: bytes of each type, the types of floating numbers, and a limit to headers.
WIDTHS = {"F64": 8, "F32": 4, "F16": 2, "BF16": 2, "F8_E4M3": 1, "F8_E5M2": 1, "I64": 8, "I32": 4, "I16": 2, "I8": 1, "U64": 8, "U32": 4, "U16": 2, "U8": 1, "BOOL": 1}
FLOATS = ("F64", "F32", "F16", "BF16", "F8_E4M3", "F8_E5M2")
LONGEST = 100_000_000
# Names of an index and of a single file, the least size of a single file, the least share of the median shard.
INDEX, SINGLE, LEAST_SINGLE, LEAST_SHARE = "model.safetensors.index.json", "model.safetensors", 1_000_000, 0.25

SCHEMA = "file string, size long, tensor string, dtype string, shape array<long>, numel long, begin long, end long, error string"


def header_of(raw: bytes, size: int) -> tuple[int, int]:
    """(length of the header, begin of the data) from the first 8 bytes."""
    if len(raw) < 8:
        raise ValueError("no header length")
    n = struct.unpack("<Q", raw)[0]
    if n > min(LONGEST, max(0, size - 8)):
        raise ValueError("header longer than the file")
    return n, 8 + n


def tensors_of(store: fs.FileSystem, path: str, size: int) -> Iterator[tuple]:
    """A row for each tensor; one row with an error for a file that cannot be understood."""
    try:
        with store.open_input_file(path) as f:
            n, data = header_of(f.read_at(8, 0), size)
            head = json.loads(f.read_at(n, 8))
        rows = []
        for name, t in head.items():
            if name == "__metadata__":
                continue
            low, high = t["data_offsets"]
            numel = math.prod(t["shape"])
            error = None
            if t["dtype"] not in WIDTHS:
                error = "unknown type"
            elif high - low != numel * WIDTHS[t["dtype"]]:
                error = "range and shape differ"
            elif data + high > size:
                error = "beyond the file"
            rows.append((path, size, name, t["dtype"], t["shape"], numel, data + low, data + high, error))
    except (ValueError, KeyError, TypeError, AttributeError, UnicodeDecodeError) as e:
        rows = [(path, size, None, None, None, None, None, None, f"unreadable: {e}"[:200])]
    yield from rows


class Files(InputPartition):
    def __init__(self, files: list[tuple[str, int]]):
        super().__init__(files)
        self.files = files


class HeaderReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.per_task = options["path"], int(options.get("files_per_task", 16))

    def partitions(self) -> list[InputPartition]:
        store, path = store_of(self.path.rstrip("/"))
        info = store.get_file_info(path)
        found = [info] if info.is_file else store.get_file_info(fs.FileSelector(path, recursive=True))
        files = sorted((f.path, f.size) for f in found if f.is_file and f.path.endswith(".safetensors"))
        return [Files(files[k : k + self.per_task]) for k in range(0, len(files), self.per_task)]

    def read(self, partition: Files | None) -> Iterator[pa.RecordBatch]:
        store, _ = store_of(self.path)
        kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.int64(), pa.string()]
        for path, size in partition.files if partition else ():
            rows = list(tensors_of(store, path, size))
            for low in range(0, len(rows), 8192):
                part = rows[low : low + 8192]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in part], t) for k, t in enumerate(kinds)], [x.split()[0] for x in SCHEMA.split(", ")])


class TensorHeaders(DataSource):
    """Format ``tensor_headers``: options path, files_per_task."""

    @classmethod
    def name(cls) -> str:
        return "tensor_headers"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return HeaderReader(self.options)


def read_tensors(spark: SparkSession, path: str) -> DataFrame:
    """A row for each tensor of the ``.safetensors`` files at or below a path, with the absolute byte range.

    ``error`` says what is wrong with a tensor; a file whose header cannot be read
    is one row with a null tensor.  A file without tensors has no row.
    """
    spark.dataSource.register(TensorHeaders)
    return spark.read.format("tensor_headers").load(path)


def model_of(file: Column) -> Column:
    """The folder a file lies in."""
    return F.regexp_replace(file, "/[^/]+$", "")


def type_counts(tensors: DataFrame, wanted: str = "BF16") -> DataFrame:
    """(model, n_float, n_other): floating tensors of a model, and those of another type than the wanted one."""
    floats = tensors.where(F.col("dtype").isin(*FLOATS))
    return floats.groupBy(model_of(F.col("file")).alias("model")).agg(F.count("*").alias("n_float"), F.count_if(F.col("dtype") != wanted).alias("n_other"))


def weight_issues(spark: SparkSession, path: str) -> DataFrame:
    """(model, file, size, issue) for every model folder with an index or a single file below a path.

    With an index: shards that it names and that are not there are ``missing``
    (size null), those below a quarter of the upper median of the shards there
    ``truncated``.  Without one, a single file of less than a megabyte is
    ``truncated``.  Sound files have a null issue; an index that is no JSON or
    names no shard has no row.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    files = listed.where(F.col("path").endswith(".safetensors")).select(model_of(F.col("path")).alias("model"), F.substring_index("path", "/", -1).alias("file"), F.col("length").alias("size"))
    raw = spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", INDEX).text(path).select("value", F.col("_metadata.file_path").alias("at"))
    named = raw.select(model_of(F.col("at")).alias("model"), F.from_json("value", "weight_map map<string, string>").alias("j"))
    wanted = named.select("model", F.explode(F.array_distinct(F.map_values("j.weight_map"))).alias("file"))
    shards = wanted.join(files, ["model", "file"], "left")
    medians = upper_medians(shards.where("size is not null"), "model", "size")
    shards = shards.join(medians, "model", "left").select(
        "model", "file", "size", F.when(F.col("size").isNull(), "missing").when(F.col("size") < LEAST_SHARE * F.col("median"), "truncated").alias("issue"), F.col("median").isNotNull().alias("any")
    ).where("any").drop("any")  # an index none of whose shards is there says nothing
    single = files.where(F.col("file") == SINGLE).join(named.select("model").distinct(), "model", "left_anti")
    return shards.unionByName(single.withColumn("issue", F.when(F.col("size") < LEAST_SINGLE, "truncated")))


def write_headers(tensors: DataFrame, path: str) -> DataFrame:
    """Writes (file, tensor, dtype, shape) as ``.safetensors`` files of zeros below a path; (file, size).

    One task writes one file at a time and keeps only its header.
    """

    def write(t: pa.Table) -> pa.Table:
        store, base = store_of(path)
        rows = sorted(zip(t.column("tensor").to_pylist(), t.column("dtype").to_pylist(), t.column("shape").to_pylist()))
        head, at = {}, 0
        for name, dtype, shape in rows:
            n = math.prod(shape) * WIDTHS[dtype]
            head[name] = {"dtype": dtype, "shape": shape, "data_offsets": [at, at + n]}
            at += n
        raw = json.dumps(head).encode()
        raw += b" " * (-len(raw) % 8)
        full = f"{base}/{t.column('file')[0].as_py()}"
        store.create_dir(full.rsplit("/", 1)[0])
        with store.open_output_stream(full) as f:
            f.write(struct.pack("<Q", len(raw)) + raw)
            for low in range(0, at, 1 << 20):
                f.write(bytes(min(1 << 20, at - low)))
        return pa.table({"file": [t.column("file")[0].as_py()], "size": pa.array([8 + len(raw) + at], pa.int64())})

    return tensors.select("file", "tensor", "dtype", "shape").groupBy("file").applyInArrow(write, "file string, size long")
