"""Sorted arrays in the shared folder, memory-mapped by workers.

Tasks write one file per shard under the checkpoint folder, through pyarrow's file
systems (local mount, HDFS, object store). A reader maps a file in place when the
store is mounted; otherwise it copies the shard to local disk once, maps it and
unlinks it at once, so nothing is left behind. Names are unique per task attempt, so
a retried or speculative task never touches another's file. A mapping holds no open
file, and a table keeps a bounded number of them; columns beyond it are mapped for one
lookup at a time.
"""

from __future__ import annotations

import mmap
import tempfile
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow.fs as pafs

from pushlake.llm._util import local_path

#: Mapped columns that one table keeps in a process (Linux allows 65,530 mappings in all).
MAX_MAPS = 4096


def write_array(folder: str, name: str, values: np.ndarray) -> str:
    """Write raw little-endian values; returns the file's URI."""
    uri = f"{folder}/{name}-{uuid.uuid4().hex}"
    where = local_path(folder)
    if where is not None:
        fs, path = pafs.LocalFileSystem(), local_path(uri)
        fs.create_dir(where, recursive=True)
    else:
        fs, path = pafs.FileSystem.from_uri(uri)
        fs.create_dir(path.rpartition("/")[0], recursive=True)
    with fs.open_output_stream(path) as out:
        out.write(np.ascontiguousarray(values).view(np.uint8).data if len(values) else b"")
    return uri


def _mapped(path: str, dtype, count: int) -> np.ndarray:
    """The file's values; the mapping outlives the open file (``np.memmap`` would keep
    one open for each array)."""
    with open(path, "rb") as f:
        return np.frombuffer(mmap.mmap(f.fileno(), count * np.dtype(dtype).itemsize, access=mmap.ACCESS_READ, trackfd=False), dtype)


def map_array(uri: str, dtype, count: int) -> np.ndarray:
    if not count:
        return np.empty(0, dtype)
    path = local_path(uri)
    if path is not None:
        return _mapped(path, dtype, count)
    fs, remote = pafs.FileSystem.from_uri(uri)
    with tempfile.NamedTemporaryFile() as copy:
        with fs.open_input_stream(remote) as source:
            while block := source.read(1 << 22):
                copy.write(block)
        copy.flush()
        return _mapped(copy.name, dtype, count)  # the mapping outlives the unlinked name


@dataclass(frozen=True)
class Shard:
    """One shard: keys in [first, last], and the files of its columns."""

    base: int  # position of its first key in the whole array
    count: int
    first: int
    last: int
    files: tuple[tuple[str, str, str], ...]  # (column, dtype, uri); the keys are column "key"


class SortedArrays:
    """A key column and value columns over shards in key order, mapped on first use."""

    def __init__(self, shards: list[Shard]):
        self.shards = sorted((s for s in shards if s.count), key=lambda s: s.first)
        self._maps: dict[tuple[int, str], np.ndarray] = {}

    def _column(self, i: int, name: str) -> np.ndarray:
        column = self._maps.get((i, name))
        if column is None:
            column = self._map(i, name)
            if len(self._maps) < MAX_MAPS:
                self._maps[i, name] = column
        return column

    def _map(self, i: int, name: str) -> np.ndarray:
        kind, uri = next((k, u) for n, k, u in self.shards[i].files if n == name)
        return map_array(uri, np.dtype(kind), self.shards[i].count)

    def __getstate__(self):
        return self.shards

    def __setstate__(self, shards):
        self.shards, self._maps = shards, {}

    def find(self, keys: np.ndarray, columns: list[str]) -> dict[str, np.ndarray]:
        """Values of sorted unique uint64 ``keys``; 0 where absent. The column
        "position" is the key's place in the whole array, -1 where absent."""
        out = {c: np.full(len(keys), -1 if c == "position" else 0, np.int64) for c in columns}
        for i, shard in enumerate(self.shards):
            lo = np.searchsorted(keys, np.uint64(shard.first), "left")
            hi = np.searchsorted(keys, np.uint64(shard.last), "right")
            if lo == hi:
                continue
            table = self._column(i, "key")
            at = np.searchsorted(table, keys[lo:hi])
            hit = np.flatnonzero(table[np.minimum(at, shard.count - 1)] == keys[lo:hi])
            for c in columns:
                out[c][lo + hit] = shard.base + at[hit] if c == "position" else self._column(i, c)[at[hit]]
        return out


def write_compact(folder: str, name: str, values: np.ndarray) -> str:
    """``write_array`` in the smallest unsigned type; the file's name tells column,
    type and length."""
    small = values.astype(np.min_scalar_type(int(values.max())) if len(values) else np.uint8)
    return write_array(folder, f"{name}.{small.dtype.str[1:]}.{len(small)}", small)


def map_compact(uri: str) -> np.ndarray:
    _, kind, count = uri.rpartition("/")[2].partition("-")[0].split(".")
    return map_array(uri, np.dtype(f"<{kind}"), int(count))


def write_split(folder: str, keys: np.ndarray, **columns: np.ndarray) -> list[str]:
    """Files of one shard of ``SplitArrays``."""
    high = keys >> np.uint64(32)
    first = np.flatnonzero(np.concatenate([[True], high[1:] != high[:-1]])) if len(keys) else np.empty(0, np.int64)
    parts = {"group": high[first], "start": np.append(first, len(keys)), "low": keys & np.uint64(0xFFFFFFFF)} | columns
    return [write_compact(folder, name, x) for name, x in parts.items()]


def _within(table: np.ndarray, lo: np.ndarray, hi: np.ndarray, want: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each ``want`` in its sorted stretch [lo, hi) of ``table``, and whether
    it is there."""
    end, lo, hi = hi, lo.astype(np.int64), hi.astype(np.int64)
    open_ = np.flatnonzero(lo < hi)
    while len(open_):
        mid = (lo[open_] + hi[open_]) >> 1
        less = table[mid] < want[open_]
        lo[open_[less]] = mid[less] + 1
        hi[open_[~less]] = mid[~less]
        open_ = open_[lo[open_] < hi[open_]]
    return lo, (lo < end) & (table[np.minimum(lo, len(table) - 1)] == want)


class SplitArrays(SortedArrays):
    """Sorted 64-bit keys whose high halves are kept once, with the stretch of low
    halves of each, in the smallest types. Each key may own a sorted stretch of
    "member" values with their "times" (stretches begin at "members")."""

    def _map(self, i: int, name: str) -> np.ndarray:
        return map_compact(next(u for n, _, u in self.shards[i].files if n == name))

    def find(self, keys: np.ndarray, columns: list[str]) -> dict[str, np.ndarray]:
        out = {c: np.full(len(keys), -1 if c == "position" else 0, np.int64) for c in columns}
        for i, shard in enumerate(self.shards):
            lo = np.searchsorted(keys, np.uint64(shard.first), "left")
            hi = np.searchsorted(keys, np.uint64(shard.last), "right")
            if lo == hi:
                continue
            group, start = self._column(i, "group"), self._column(i, "start")
            high = (keys[lo:hi] >> np.uint64(32)).astype(group.dtype)  # within the shard's range
            at = np.minimum(np.searchsorted(group, high), len(group) - 1)
            known = np.flatnonzero(group[at] == high)
            at = at[known]
            place, there = _within(self._column(i, "low"), start[at], start[at + 1], keys[lo:hi][known] & np.uint64(0xFFFFFFFF))
            hit, place = lo + known[there], place[there]
            for c in columns:
                out[c][hit] = shard.base + place if c == "position" else self._column(i, c)[place]
        return out

    def coded(self, keys: np.ndarray, columns: list[str]) -> dict[str, np.ndarray]:
        """``find`` of columns that are kept once for each "code" of a shard."""
        out = {c: np.zeros(len(keys), np.int64) for c in columns}
        got = self.find(keys, ["position", "code"])
        for i, shard in enumerate(self.shards):
            mine = np.flatnonzero((got["position"] >= shard.base) & (got["position"] < shard.base + shard.count))
            for c in columns if len(mine) else ():
                out[c][mine] = self._column(i, c)[got["code"][mine]]
        return out

    def times(self, positions: np.ndarray, members: np.ndarray) -> np.ndarray:
        """Times of each member under the key at each sorted position; 0 where absent."""
        out = np.zeros(len(positions), np.int64)
        for i, shard in enumerate(self.shards):
            lo, hi = np.searchsorted(positions, [shard.base, shard.base + shard.count])
            if lo == hi:
                continue
            start, at = self._column(i, "members"), positions[lo:hi] - shard.base
            place, there = _within(self._column(i, "member"), start[at], start[at + 1], members[lo:hi])
            out[lo + np.flatnonzero(there)] = self._column(i, "times")[place[there]]
        return out
