"""Token arrays in ``.npy`` files as a Spark data source: ranged reads, and a sink in two phases.

Reading.  Partitions are planned from the headers alone: a file of any size is cut
into ranges of rows of about ``partition_bytes``, so a shard of several gigabytes
is read by several tasks, and each reads only its bytes; many small files share
tasks, so that their number grows with the bytes.  Of many small files the driver
holds names and sizes alone; tasks read their headers.  Filters on ``shard_key``
and ``row_idx`` reach the plan: files and rows outside them are never read.

Writing.  Every task writes its shards under a temporary name of the job, and name,
shape, size and SHA-256 of each to a list beside them, of which it tells the driver.
Only when all tasks are done are files renamed and then the manifest replaced; when
one fails, the temporary folder goes and what was there stays.  An attempt that is
run twice leaves one shard, since only the files of committed attempts are renamed.
Lists are merged as streams, so the driver holds no entry of a manifest for long.
"""

from __future__ import annotations

import ast
import hashlib
import heapq
import io
import json
import os
import struct
import uuid
from array import array
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan,
    LessThanOrEqual, WriterCommitMessage,
)
from pyspark.sql.types import StructType

# Fixed values of the format.
MAGIC = b"\x93NUMPY"
#: Bytes that hold the header of any token array.
HEAD = 1024
#: Kinds of token ids that are read, and the one that is written.
KINDS = {"<u4": 4, "<u2": 2, "<i4": 4, "<i8": 8}
WRITTEN = "<u4"
#: How splits' files begin, and the manifest's version.
PREFIXES = {"train": "shard", "eval": "holdout"}
VERSION = "local-v3"

SCHEMA = "shard_key string, row_idx long, input_ids array<int>"
TARGET = "split string, shard long, row_idx long, shard_rows long, input_ids array<int>"


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or address, and the path in it."""
    if "://" in path or path.startswith("file:"):
        if path.startswith("file:") and not path.startswith("file://"):
            path = "file://" + path.removeprefix("file:")
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def array_header(raw: bytes) -> tuple[str, tuple[int, ...], int]:
    """(kind, shape, offset of the data); the header is read as a literal, never evaluated."""
    if raw[:6] != MAGIC:
        raise ValueError("not an array file")
    size, begin = (struct.unpack_from("<H", raw, 8)[0], 10) if raw[6] == 1 else (struct.unpack_from("<I", raw, 8)[0], 12)
    head = ast.literal_eval(raw[begin : begin + size].decode("latin-1").strip())
    if head["fortran_order"]:
        raise ValueError("arrays must be in row order")
    return head["descr"], tuple(head["shape"]), begin + size


def header_bytes(kind: str, shape: tuple[int, ...]) -> bytes:
    """A header of version 1, padded so that data begin at a multiple of 64."""
    text = f"{{'descr': '{kind}', 'fortran_order': False, 'shape': {shape!r}, }}"
    text += " " * (-(len(MAGIC) + 4 + len(text) + 1) % 64) + "\n"
    return MAGIC + b"\x01\x00" + struct.pack("<H", len(text)) + text.encode("latin-1")


@dataclass(frozen=True)
class ArrayFile:
    """What a header tells: ``rows`` of ``length`` tokens; a flat array's tail is dropped."""

    key: str
    kind: str
    begin: int
    rows: int
    length: int
    size: int

    @classmethod
    def of(cls, store: fs.FileSystem, path: str, size: int, length: int | None, kinds: Iterable[str] = (WRITTEN,)) -> ArrayFile:
        with store.open_input_file(path) as f:
            return cls.opened(f, path, size, length, kinds)

    @classmethod
    def opened(cls, f: pa.NativeFile, path: str, size: int, length: int | None, kinds: Iterable[str] = (WRITTEN,)) -> ArrayFile:
        kind, shape, begin = array_header(f.read_at(min(size, HEAD), 0))
        if kind not in kinds:
            raise ValueError(f"{path}: tokens must be one of {sorted(kinds)}, not {kind}")
        if len(shape) not in (1, 2):
            raise ValueError(f"{path}: a shard has one or two dimensions")
        if len(shape) == 1 and not length:
            raise ValueError(f"{path}: a flat array needs the option length")
        if begin + int(np.prod(shape)) * KINDS[kind] > size:
            raise ValueError(f"{path}: shorter than its header says")
        rows, width = (shape[0] // length, length) if len(shape) == 1 else shape
        return cls(path, kind, begin, rows, width, size)

    def read(self, f: pa.NativeFile, low: int, high: int) -> np.ndarray:
        """Rows low to high, the last not included, by one ranged read."""
        width = self.length * KINDS[self.kind]
        raw = f.read_at((high - low) * width, self.begin + low * width)
        rows = np.frombuffer(raw, self.kind).reshape(high - low, self.length)
        if rows.size and (rows.max() > 2**31 - 1 or rows.min() < 0):
            raise ValueError(f"{self.key}: a token is no 31-bit number")
        return rows.astype(np.int32)


def inside(store: fs.FileSystem, folder: str) -> Iterator[tuple[str, int | None]]:
    """(name, size) of what is in a folder; a folder has no size.  A local one is read entry by entry; other stores give their listing whole."""
    if isinstance(store, fs.LocalFileSystem):
        with os.scandir(folder) as found:
            for x in found:
                if x.is_dir() or x.is_file():
                    yield x.name, None if x.is_dir() else x.stat().st_size
    else:
        for f in store.get_file_info(fs.FileSelector(folder)):
            yield f.base_name, f.size if f.is_file else None


def listed(store: fs.FileSystem, path: str) -> Iterator[tuple[str, list[str], np.ndarray]]:
    """(folder with its last ``/``, names, sizes) of the array files at or below a path, by name; those under names that begin with ``_`` or ``.`` are left out."""
    info = store.get_file_info(path)
    if info.type == fs.FileType.File:
        yield info.path.removesuffix(info.base_name), [info.base_name], np.array([info.size])
        return
    names, sizes, below = [], array("q"), []
    for name, size in inside(store, path):
        if name[:1] in "_.":
            continue
        if size is None:
            below.append(name)
        elif name.endswith(".npy"):
            names.append(name)
            sizes.append(size)
    order = np.argsort(np.array(names, object), kind="stable")
    folder = f"{path.rstrip('/')}/"
    yield folder, [names[k] for k in order], np.array(sizes, np.int64)[order]
    for name in sorted(below):
        yield from listed(store, folder + name)


@dataclass
class Rows(InputPartition):
    file: ArrayFile
    low: int
    high: int

    def __post_init__(self) -> None:
        super().__init__((self.file.key, self.low))


@dataclass
class ManyRows(InputPartition):
    """Ranges of several files that one task reads."""

    parts: list[Rows]

    def __post_init__(self) -> None:
        super().__init__((self.parts[0].file.key, self.parts[0].low))


@dataclass
class ManyFiles(InputPartition):
    """Whole small files that one task reads, headers and all: (folder with its last ``/``, names joined by ``/``, sizes)."""

    parts: list[tuple[str, str, np.ndarray]]

    def __post_init__(self) -> None:
        folder, names, _ = self.parts[0]
        super().__init__((folder, names.partition("/")[0]))


#: As many ranges or files as this have tasks of their own; opening a file counts as so many bytes.
SINGLE, OPENING = 256, 64 << 10


def shared_out(folders: list[tuple[str, list[str], np.ndarray]], most: int) -> list[InputPartition]:
    """Files of folders, in order, put together up to about ``most`` bytes."""
    out: list[list[tuple[str, str, np.ndarray]]] = []
    held = 0
    for folder, names, sizes in folders:
        upto, low = np.cumsum(sizes + OPENING), 0
        while low < len(names):
            before = int(upto[low - 1]) if low else 0
            high = int(np.searchsorted(upto, before + most - held, "right"))
            if not out or high <= low and held:
                out.append([])
                held = 0
                continue
            high = max(low + 1, high)
            out[-1].append((folder, "/".join(names[low:high]), sizes[low:high].copy()))
            held += int(upto[high - 1]) - before
            low = high
    return [ManyFiles(p) for p in out]


def grouped(parts: list[Rows], most: int) -> list[InputPartition]:
    """Ranges, in order, put together up to about ``most`` bytes; a few stay alone."""
    if len(parts) <= SINGLE:
        return list(parts)
    out: list[list[Rows]] = []
    held = most
    for p in parts:
        cost = (p.high - p.low) * p.file.length * KINDS[p.file.kind] + OPENING
        if held + cost > most:
            out.append([])
            held = 0
        out[-1].append(p)
        held += cost
    return [p[0] if len(p) == 1 else ManyRows(p) for p in out]


def batch_of(key: str, first: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
    n, width = rows.shape
    ids = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * np.int32(width)), pa.array(rows.ravel()))
    return pa.RecordBatch.from_arrays([pa.array([key] * n), pa.array(first), ids], ["shard_key", "row_idx", "input_ids"])


class ArrayReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"]
        self.length = int(options["length"]) if "length" in options else None
        self.partition_bytes = int(options.get("partition_bytes", 64 << 20))
        self.batch_bytes = int(options.get("batch_bytes", 4 << 20))
        self.kinds = [k.strip() for k in options.get("kinds", WRITTEN).split(",")]
        self.keys: set[str] | None = None
        self.low, self.high = 0, 2**63 - 1
        self.only: set[int] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if not self._push(f):
                yield f

    def _push(self, f: Filter) -> bool:
        column = getattr(f, "attribute", None)
        if column == ("shard_key",) and isinstance(f, (EqualTo, In)):
            keys = {f.value}.copy() if isinstance(f, EqualTo) else set(f.value)
            self.keys = keys if self.keys is None else self.keys & keys
        elif column == ("row_idx",) and isinstance(f, (EqualTo, In)):
            only = {f.value} if isinstance(f, EqualTo) else set(f.value)
            self.only = only if self.only is None else self.only & only
        elif column == ("row_idx",) and isinstance(f, (GreaterThan, GreaterThanOrEqual)):
            self.low = max(self.low, f.value + isinstance(f, GreaterThan))
        elif column == ("row_idx",) and isinstance(f, (LessThan, LessThanOrEqual)):
            self.high = min(self.high, f.value + isinstance(f, LessThanOrEqual))
        else:
            return False
        return True

    def partitions(self) -> list[InputPartition]:
        store, path = store_of(self.path)
        folders = []
        for folder, names, sizes in listed(store, path):
            if self.keys is not None:
                at = [k for k, name in enumerate(names) if folder + name in self.keys]
                names, sizes = [names[k] for k in at], sizes[at]
            folders.append((folder, names, sizes))
        few = sum(len(names) for _, names, _ in folders) <= SINGLE
        small: list[tuple[str, list[str], np.ndarray]] = []
        cut: list[tuple[str, int]] = []
        for folder, names, sizes in folders:
            whole = np.zeros(len(names), bool) if few else sizes <= self.partition_bytes
            small.append((folder, [names[k] for k in np.flatnonzero(whole)], sizes[whole]))
            cut += [(folder + names[k], int(sizes[k])) for k in np.flatnonzero(~whole)]
        with ThreadPoolExecutor(16) as pool:  # waits for headers
            files = list(pool.map(lambda f: ArrayFile.of(store, *f, self.length, self.kinds), cut))
        return shared_out(small, self.partition_bytes) + grouped([part for file in files for part in self._ranges(file)], self.partition_bytes)

    def _ranges(self, file: ArrayFile) -> list[Rows]:
        step = max(1, self.partition_bytes // max(1, file.length * KINDS[file.kind]))
        low, high = max(0, self.low), min(file.rows, self.high)
        if self.only is not None:
            # One range for rows that lie near each other.
            wanted = sorted(x for x in self.only if low <= x < high)
            return [Rows(file, a, b + 1) for a, b in joined(wanted, GAP, step)]
        return [Rows(file, at, min(at + step, high)) for at in range(low, high, step)]

    def read(self, partition: Rows | ManyRows | ManyFiles | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no file or no row is left
            return
        store, _ = store_of(self.path)
        if isinstance(partition, ManyFiles):
            for folder, names, sizes in partition.parts:
                for name, size in zip(names.split("/"), sizes.tolist()):
                    with store.open_input_file(folder + name) as f:
                        for part in self._ranges(ArrayFile.opened(f, folder + name, size, self.length, self.kinds)):
                            yield from self._read(f, part)
            return
        for part in partition.parts if isinstance(partition, ManyRows) else [partition]:
            with store.open_input_file(part.file.key) as f:
                yield from self._read(f, part)

    def _read(self, f: pa.NativeFile, partition: Rows) -> Iterator[pa.RecordBatch]:
        file = partition.file
        step = max(1, self.batch_bytes // max(1, file.length * KINDS[file.kind]))
        for low in range(partition.low, partition.high, step):
            rows = file.read(f, low, min(low + step, partition.high))
            at = np.arange(low, low + len(rows))
            if self.only is not None:
                keep = np.isin(at, list(self.only))
                at, rows = at[keep], rows[keep]
            yield batch_of(file.key, at, rows)


#: Rows nearer than this are fetched by one read.
GAP = 64


def joined(wanted: list[int], gap: int, most: int) -> list[tuple[int, int]]:
    """Ascending numbers as ranges (first, last): joined within ``gap``, at most ``most`` long."""
    out: list[list[int]] = []
    for x in wanted:
        if out and x - out[-1][1] <= gap and x - out[-1][0] < most:
            out[-1][1] = x
        else:
            out.append([x, x])
    return [(a, b) for a, b in out]


@dataclass
class Shards(WriterCommitMessage):
    """What one task wrote: the names of its lists."""

    lists: list[str] = field(default_factory=list)


#: Entries of one list, and files that are renamed or deleted in one go, at most.
LISTED = 1 << 12


def place(entry: dict) -> tuple[bool, str, int]:
    """The manifest's order: train first."""
    return entry["split"] != "train", entry["split"], entry["shard"]


def key_of(split: str, shard: int) -> str:
    return f"{split}/{PREFIXES.get(split, split)}_{shard:06d}.npy"


class Lists:
    """Entries with the temporary names of their files, null for what was there before, written in lists that are each in the manifest's order."""

    def __init__(self, store: fs.FileSystem, folder: str) -> None:
        self.store, self.folder = store, folder
        self.names: list[str] = []
        self.held: list[tuple[str | None, dict]] = []

    def add(self, name: str | None, entry: dict) -> None:
        self.held.append((name, entry))
        if len(self.held) >= LISTED:
            self.end()

    def end(self) -> list[str]:
        if self.held:
            self.names.append(f"{self.folder}/{uuid.uuid4().hex}.jsonl")
            with self.store.open_output_stream(self.names[-1]) as f:
                for x in sorted(self.held, key=lambda x: place(x[1])):
                    f.write(json.dumps(x).encode() + b"\n")
            self.held = []
        return self.names


def read_list(store: fs.FileSystem, name: str) -> Iterator[tuple[str | None, dict]]:
    with io.BufferedReader(store.open_input_stream(name), 1 << 15) as f:
        for line in f:
            yield json.loads(line)


def by_place(store: fs.FileSystem, names: list[str]) -> Iterator[tuple[list[tuple[str, dict]], list[dict]]]:
    """For each split and shard, in the manifest's order, what lists tell of it: new files with their entries, and entries that were there before."""
    for _, same in groupby(heapq.merge(*(read_list(store, n) for n in names), key=lambda x: place(x[1])), lambda x: place(x[1])):
        same = list(same)
        yield [x for x in same if x[0] is not None], [e for name, e in same if name is None]


def in_turn(pool: ThreadPoolExecutor, f: Callable, items: Iterable) -> None:
    """``f`` of each item, a stretch of them at a time."""
    it = iter(items)
    while some := list(islice(it, LISTED)):
        list(pool.map(f, some))


class ArrayWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], overwrite: bool) -> None:
        self.path, self.overwrite = options["path"].rstrip("/"), overwrite
        self.length = int(options["length"])
        self.job = f"_temporary/{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        """Rows come by split and shard, in order; a shard's header needs its number of rows in advance."""
        store, path = store_of(self.path)
        folder = f"{path}/{self.job}"
        store.create_dir(folder)
        done = Lists(store, folder)
        now: tuple | None = None
        sink = digest = None
        n = 0
        try:
            for batch in iterator:
                split, shard, row, total = (batch.column(c).to_pylist() for c in ("split", "shard", "row_idx", "shard_rows"))
                ids = batch.column("input_ids")
                width = np.diff(ids.offsets.to_numpy())
                if len(width) and (width != self.length).any():
                    raise ValueError(f"rows must have {self.length} tokens")
                tokens = ids.flatten().to_numpy().astype(WRITTEN).reshape(-1, self.length)
                for k, key in enumerate(zip(split, shard, total)):
                    if key != now:
                        if now is not None:
                            done.add(*self._close(sink, digest, name, now, n))
                        now, n, name = key, 0, f"{folder}/{uuid.uuid4().hex}.npy"
                        sink, digest = store.open_output_stream(name), hashlib.sha256()
                        head = header_bytes(WRITTEN, (key[2], self.length))
                        sink.write(head)
                        digest.update(head)
                    if row[k] != n:
                        raise ValueError(f"shard {now[:2]}: row {row[k]} where row {n} comes next")
                    raw = tokens[k].tobytes()
                    sink.write(raw)
                    digest.update(raw)
                    n += 1
            if now is not None:
                done.add(*self._close(sink, digest, name, now, n))
                sink = None
        finally:
            if sink is not None and not sink.closed:
                sink.close()
        return Shards(done.end())

    def _close(self, sink: pa.NativeFile, digest, name: str, key: tuple, n: int) -> tuple[str, dict]:
        sink.close()
        split, shard, total = key
        if n != total:
            raise ValueError(f"shard {key[:2]} has {n} rows where {total} were announced")
        size = len(header_bytes(WRITTEN, (total, self.length))) + 4 * n * self.length
        return name, {
            "key": key_of(split, shard), "split": split, "shard": shard, "rows": n, "num_sequences": n, "seq_len": self.length,
            "num_tokens": n * self.length, "token_count": n * self.length, "dtype": "uint32", "shape": [n, self.length], "bytes": size, "sha256": digest.hexdigest(),
        }

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, path = store_of(self.path)
        folder = f"{path}/{self.job}"
        store.create_dir(folder)
        before, odd = Lists(store, folder), set()  # keys that do not follow from split and shard
        for e in shard_entries(store, path):
            before.add(None, e)
            if e["key"] != key_of(e["split"], e["shard"]):
                odd.add(e["key"])
        lists = [n for m in messages if m is not None for n in m.lists] + before.end()
        splits, tokens, there, again = Counter(), 0, [], set()
        for new, old in by_place(store, lists):
            if len(new) > 1:
                self.abort(messages)
                raise ValueError("a shard was written by two tasks")
            for _, e in new:
                if e["key"] in odd or any(e["key"] == o["key"] for o in old):
                    there = [*there, e["key"]][:3]
                again |= {e["key"]} & odd
            for e in ([] if self.overwrite else old) + [e for _, e in new]:
                splits[e["split"]] += 1
                tokens += e["num_tokens"]
        if there and not self.overwrite:
            self.abort(messages)
            raise ValueError(f"shards are there already: {there}")
        made: set[str] = set()

        def moves() -> Iterator[tuple[str, str]]:
            for new, _ in by_place(store, lists):
                for name, e in new:
                    target = f"{path}/{e['key']}"
                    above = target.rsplit("/", 1)[0]
                    if above not in made:
                        made.add(above)
                        store.create_dir(above)
                    yield name, target

        def gone() -> Iterator[str]:
            for new, old in by_place(store, lists):
                yield from (e["key"] for e in old if e["key"] not in again and all(e["key"] != n["key"] for _, n in new))

        def delete(key: str) -> None:
            if store.get_file_info(f"{path}/{key}").is_file:
                store.delete_file(f"{path}/{key}")

        with ThreadPoolExecutor(16) as pool:
            in_turn(pool, lambda m: store.move(*m), moves())
            everything = (e for new, old in by_place(store, lists) for e in ([] if self.overwrite else old) + [e for _, e in new])
            put_manifest(store, f"{folder}/manifest.json", f"{path}/manifest.json", manifest_head(splits, tokens, self.length), everything)
            if self.overwrite:
                in_turn(pool, delete, gone())
        self._clear(store, path)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._clear(*store_of(self.path))

    def _clear(self, store: fs.FileSystem, path: str) -> None:
        if store.get_file_info(f"{path}/{self.job}").type == fs.FileType.Directory:
            store.delete_dir(f"{path}/{self.job}")
        above = f"{path}/_temporary"
        if store.get_file_info(above).type == fs.FileType.Directory and not store.get_file_info(fs.FileSelector(above)):
            store.delete_dir(above)


def put_manifest(store: fs.FileSystem, temporary: str, target: str, head: dict, entries: Iterable[dict]) -> None:
    """A manifest that is there as a whole or not at all; entries are written as they come."""
    with store.open_output_stream(temporary) as f:
        f.write(json.dumps(head, indent=1).removesuffix("\n}").encode() + b',\n "shards": [')
        some = False
        for e in entries:
            f.write((b",\n  " if some else b"\n  ") + json.dumps(e, indent=1).replace("\n", "\n  ").encode())
            some = True
        f.write(b"\n ]\n}" if some else b"]\n}")
    store.move(temporary, target)


def manifest_head(splits: Counter, tokens: int, length: int) -> dict:
    """What a manifest tells besides its entries, from the shards of each split and all tokens."""
    return {
        "version": VERSION, "seq_len": length, "dtype": "uint32", "total_shards": sum(splits.values()), "total_train_shards": splits["train"],
        "total_eval_shards": splits["eval"], "total_tokens": tokens,
    }


class Json:
    """JSON that is read piece by piece."""

    def __init__(self, f: io.TextIOBase) -> None:
        self.f, self.text, self.at, self.decode = f, "", 0, json.JSONDecoder().raw_decode

    def _more(self) -> None:
        part = self.f.read(1 << 16)
        if not part:
            raise ValueError("no whole JSON")
        self.text, self.at = self.text[self.at :] + part, 0

    def sign(self) -> str:
        """The next character that is no white space."""
        while True:
            while self.at < len(self.text) and self.text[self.at] in " \t\r\n":
                self.at += 1
            if self.at < len(self.text):
                return self.text[self.at]
            self._more()

    def passed(self, wanted: str) -> bool:
        """Whether the next sign is the wanted one, which is then passed over."""
        here = self.sign() == wanted
        self.at += here
        return here

    def value(self):
        """The next value; something follows it, so one at the end of the text may not be whole."""
        self.sign()
        while True:
            try:
                value, end = self.decode(self.text, self.at)
            except ValueError:
                end = len(self.text)
            if end < len(self.text) and self.text[end] not in ".eE":
                self.at = end
                return value
            self._more()


def shard_entries(store: fs.FileSystem, path: str) -> Iterator[dict]:
    """The entries of the manifest, one after another; none without a manifest."""
    if not store.get_file_info(f"{path}/manifest.json").is_file:
        return
    with io.TextIOWrapper(io.BufferedReader(store.open_input_stream(f"{path}/manifest.json"), 1 << 16), "utf-8") as f:
        at = Json(f)
        at.passed("{")
        found = False
        while not at.passed("}"):
            at.passed(",")
            name = at.value()
            at.passed(":")
            if name != "shards":
                at.value()
                continue
            found = at.passed("[")
            while not at.passed("]"):
                yield at.value()
                at.passed(",")
        if not found:
            raise KeyError("shards")


class TokenArrays(DataSource):
    """Format ``token_arrays``: options path, length, partition_bytes, kinds."""

    @classmethod
    def name(cls) -> str:
        return "token_arrays"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return ArrayReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return ArrayWriter(self.options, overwrite)


def registered(spark: SparkSession) -> SparkSession:
    """The session with the format, its filters pushed down."""
    spark.dataSource.register(TokenArrays)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark


def read_arrays(spark: SparkSession, path: str, length: int | None = None, **options: str | int) -> DataFrame:
    """(shard_key, row_idx, input_ids) of the array files at or below a path.

    A flat array is cut every ``length`` tokens, its tail dropped; a matrix is
    taken as it is.  No files give no rows; a file that is no token array, or is
    shorter than its header says, is an error.
    """
    reader = registered(spark).read.format("token_arrays").options(**options)
    return (reader if length is None else reader.option("length", length)).load(path)


def write_arrays(windows: DataFrame, path: str, length: int, mode: str = "append") -> None:
    """Writes (split, shard, window_id, ids) as one array file for each shard and a manifest with digests.

    Rows of a shard are in the order of window_id.  Shards are dealt over tasks;
    one task holds no more of a shard than a batch, and what Spark's windows keep
    in memory before they spill.  Rows are made and shuffled once.  An empty table
    writes an empty manifest; null tokens are an error.
    """
    whole = Window.partitionBy("split", "shard").orderBy("window_id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = windows.select("split", "shard", "window_id", "ids", F.count("*").over(whole).alias("shard_rows"), F.first("window_id").over(whole).alias("_first"))
    placed = rows.sortWithinPartitions("split", "shard", "window_id").select(
        "split", F.col("shard").cast("long").alias("shard"), (F.col("window_id") - F.col("_first")).alias("row_idx"), "shard_rows",
        F.col("ids").cast("array<int>").alias("input_ids"),
    )
    registered(windows.sparkSession)
    placed.write.format("token_arrays").option("length", length).mode(mode).save(path)


def fetch_rows(wanted: DataFrame, path: str, length: int | None = None, gap: int = GAP, most: int = 4096) -> DataFrame:
    """(shard_key, row_idx, input_ids) of the wanted (shard_key, row_idx), by ranged reads.

    Indices are sorted over ranges of (shard_key, row_idx), so the rows wanted of
    one shard may be read by many tasks; each joins what lies within ``gap`` into
    one read of at most ``most`` rows.  A row wanted twice comes once; rows that
    a shard does not have are left out.
    """
    store_path = path.rstrip("/")

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = store_of(store_path)
        name, file, f = None, None, None
        for batch in it:
            keys, at = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            starts = [k for k in range(len(keys)) if k == 0 or keys[k] != keys[k - 1]] + [len(keys)]
            for a, b in zip(starts, starts[1:]):
                if keys[a] != name:
                    if f is not None:
                        f.close()
                    name, full = keys[a], keys[a] if keys[a].startswith(base) else f"{base}/{keys[a]}"
                    file = ArrayFile.of(store, full, store.get_file_info(full).size, length, KINDS)
                    f = store.open_input_file(full)
                rows = at[a:b][(at[a:b] >= 0) & (at[a:b] < file.rows)]
                for low, high in joined(rows.tolist(), gap, most):
                    mine = rows[np.searchsorted(rows, low) : np.searchsorted(rows, high, "right")]
                    yield batch_of(name, mine, file.read(f, low, high + 1)[mine - low])
        if f is not None:
            f.close()

    distinct = wanted.select("shard_key", F.col("row_idx").cast("long").alias("row_idx")).where("shard_key is not null and row_idx is not null").distinct()
    return distinct.repartitionByRange("shard_key", "row_idx").sortWithinPartitions("shard_key", "row_idx").mapInArrow(batches, SCHEMA)


#: The fields of a manifest's entries that are read here.
ENTRY = "key string, split string, rows long, num_sequences long, num_tokens long, dtype string, bytes long, sha256 string"


def manifest_entries(spark: SparkSession, path: str) -> DataFrame:
    """(s): a struct for each entry of the manifest; none without a manifest.  Other fields are passed over as they are read."""
    store, base = store_of(path.rstrip("/"))
    if not store.get_file_info(f"{base}/manifest.json").is_file:
        return spark.createDataFrame([], f"s struct<{ENTRY}>")
    listed = spark.read.schema(f"shards array<struct<{ENTRY}>>").option("multiLine", "true").json(f"{path.rstrip('/')}/manifest.json")
    return listed.select(F.explode("shards").alias("s"))


def verify_arrays(spark: SparkSession, path: str, length: int) -> DataFrame:
    """(key, split, error) of each shard of the manifest: file missing, unreadable, dimensions, width, rows, kind, bytes or digest; null if sound.

    Digests are taken in tasks, one shard at a time; many small shards share a task.
    The manifest is read by Spark, entry by entry.
    """
    _, base = store_of(path.rstrip("/"))
    entries = manifest_entries(spark, path).select(F.to_json("s").alias("entry"))

    def check(raw: str) -> str | None:
        e = json.loads(raw)
        at, _ = store_of(path)
        full = f"{base}/{e['key']}"
        info = at.get_file_info(full)
        if not info.is_file:
            return "missing"
        with at.open_input_file(full) as f:
            try:
                kind, shape, _begin = array_header(f.read_at(min(info.size, HEAD), 0))
            except (ValueError, SyntaxError, KeyError, struct.error):
                return "unreadable"
            if len(shape) != 2:
                return f"{len(shape)} dimensions"
            if shape[1] != length:
                return f"rows of {shape[1]}"
            rows = e.get("num_sequences") or e.get("rows")
            if rows and shape[0] != rows:
                return f"{shape[0]} rows"
            if np.dtype(kind) != np.dtype(e.get("dtype", "uint32")):
                return f"tokens of {np.dtype(kind)}"
            if e.get("bytes") and info.size != e["bytes"]:
                return f"{info.size} bytes"
            if e.get("sha256"):
                digest = hashlib.sha256()
                for low in range(0, info.size, 8 << 20):
                    digest.update(f.read_at(min(8 << 20, info.size - low), low))
                if digest.hexdigest() != e["sha256"]:
                    return "digest"
        return None

    def batches(it):
        for batch in it:
            raw = batch.column(0).to_pylist()
            parsed = [json.loads(x) for x in raw]
            yield pa.RecordBatch.from_arrays(
                [pa.array([e["key"] for e in parsed], pa.string()), pa.array([e.get("split") for e in parsed], pa.string()), pa.array([check(x) for x in raw], pa.string())],
                ["key", "split", "error"],
            )

    n = entries.count()
    tasks = max(1, min(n, max(4 * spark.sparkContext.defaultParallelism, n // 1000)))
    return entries.repartition(tasks).mapInArrow(batches, "key string, split string, error string")
