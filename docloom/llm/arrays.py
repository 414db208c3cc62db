"""Sorted hash arrays in files of the shared folder, memory-mapped by the tasks that read them.

A file holds one shard: the hashes of a range, split into buckets by their leading bits, with 32 more bits of each hash,
and one or more value columns.  Files get their final name only when complete, and every attempt of a task writes the same
content, so retried and speculative tasks do no harm.
"""

from __future__ import annotations

import json
import os
import tempfile
import uuid

import numpy as np

_BUCKET = 64  # entries of a bucket, about


def _local(folder: str) -> str | None:
    if folder.startswith("file:"):
        return "/" + folder[5:].lstrip("/")
    return folder if "://" not in folder else None


def write_arrays(folder: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    """Write arrays one behind the other, with a header that says where each lies."""
    head, at = {}, 4096 * (1 + 200 * len(arrays) // 4096)
    first = at
    for key, a in arrays.items():
        head[key] = [a.dtype.str, at, len(a)]
        at += -(-a.nbytes // 64) * 64
    header = json.dumps(head).encode().ljust(first, b" ")
    temporary = f".{name}-{uuid.uuid4().hex}"

    def fill(out):
        out.write(header)
        for a in arrays.values():
            out.write(np.ascontiguousarray(a).tobytes())
            out.write(b"\0" * (-a.nbytes % 64))

    path = _local(folder)
    if path is not None:
        os.makedirs(path, exist_ok=True)
        with open(f"{path}/{temporary}", "wb") as out:
            fill(out)
        os.replace(f"{path}/{temporary}", f"{path}/{name}")
        return
    from pyarrow import fs

    system, base = fs.FileSystem.from_uri(folder)
    system.create_dir(base, recursive=True)
    with system.open_output_stream(f"{base}/{temporary}") as out:
        fill(out)
    system.move(f"{base}/{temporary}", f"{base}/{name}")


def open_arrays(folder: str, name: str) -> dict[str, np.ndarray]:
    """Memory-map a file.  From a store that has no local path the file is first copied to scratch space, which is freed
    when the process ends."""
    path = _local(folder)
    if path is None:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder)
        with tempfile.NamedTemporaryFile() as scratch:
            with system.open_input_stream(f"{base}/{name}") as source:
                while chunk := source.read(8 << 20):
                    scratch.write(chunk)
            scratch.flush()
            whole = np.memmap(scratch.name, np.uint8, "r")
    else:
        whole = np.memmap(f"{path}/{name}", np.uint8, "r")
    first = bytes(whole[: 1 << 12])
    head = json.loads(first[: first.rindex(b"}") + 1])
    return {k: whole[at : at + n * np.dtype(kind).itemsize].view(kind) for k, (kind, at, n) in head.items()}


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Number of the range of 2^64 / shards hashes, two at least, that holds each hash."""
    return np.minimum(hashes // np.uint64((1 << 64) // shards), np.uint64(shards - 1)).astype(np.int64)


def index(hashes: np.ndarray, shard: int, shards: int) -> dict[str, np.ndarray]:
    """Buckets and remainders of the ascending, distinct hashes of a shard."""
    bits = max(0, int(np.ceil(np.log2(max(1, len(hashes)) / _BUCKET)))) if len(hashes) else 0
    place, rest = _split(hashes, shard, shards, bits)
    starts = np.searchsorted(place, np.arange((1 << bits) + 1)).astype(np.uint32)
    return {"starts": starts, "rest": rest}


def _split(hashes: np.ndarray, shard: int, shards: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    width = (1 << 64) // shards
    offset = hashes - np.uint64(width * shard)
    span = max(1, width.bit_length()) + (1 if shards & (shards - 1) else 0)
    span = min(64, span)
    bucket = offset >> np.uint64(span - bits) if bits else np.zeros(len(offset), np.uint64)
    low = span - bits - 32
    rest = (offset >> np.uint64(low)) & np.uint64(0xFFFFFFFF) if low > 0 else offset & np.uint64(0xFFFFFFFF)
    return np.minimum(bucket, np.uint64((1 << bits) - 1)).astype(np.int64), rest.astype(np.uint32)


def find(arrays: dict[str, np.ndarray], hashes: np.ndarray, shard: int, shards: int) -> np.ndarray:
    """Position of each hash in its shard, -1 where it is absent."""
    starts, rest = arrays["starts"], arrays["rest"]
    if not len(rest) or not len(hashes):
        return np.full(len(hashes), -1, np.int64)
    place, wanted = _split(hashes, shard, shards, int(np.log2(len(starts) - 1)))
    lo, hi = starts[place].astype(np.int64), starts[place + 1].astype(np.int64)
    end = hi
    for _ in range(int(np.max(hi - lo)).bit_length()):
        middle = (lo + hi) >> 1
        below = (rest[np.minimum(middle, len(rest) - 1)] < wanted) & (lo < hi)
        hi = np.where(below, hi, middle)
        lo = np.where(below, middle + 1, lo)
    hit = (lo < end) & (rest[np.minimum(lo, len(rest) - 1)] == wanted)
    return np.where(hit, lo, -1)


class Shards:
    """All shard files of one kind, opened when first needed."""

    def __init__(self, folder: str, kind: str, shards: int):
        self.folder, self.kind, self.shards, self.open = folder, kind, shards, {}

    def rows(self, hashes: np.ndarray, columns: list[str]) -> list[np.ndarray]:
        """Values of ascending hashes, 0 where absent."""
        out = [None] * len(columns)
        edges = np.searchsorted(shard_of(hashes, self.shards), np.arange(self.shards + 1))
        for shard in np.flatnonzero(np.diff(edges)):
            a, b = edges[shard], edges[shard + 1]
            if shard not in self.open:
                self.open[shard] = open_arrays(self.folder, f"{self.kind}-{shard:06d}")
            arrays = self.open[shard]
            at = find(arrays, hashes[a:b], int(shard), self.shards)
            for i, c in enumerate(columns):
                value = arrays[c]
                if out[i] is None:
                    out[i] = np.zeros(len(hashes), np.int64)
                found = at >= 0
                got = value[at[found]].astype(np.int64)
                if f"{c}_over" in arrays and len(arrays[f"{c}_over"]):
                    big = np.flatnonzero(got == 255)
                    got[big] = arrays[f"{c}_large"][np.searchsorted(arrays[f"{c}_over"], at[found][big])].astype(np.int64)
                out[i][a:b][found] = got
        return [np.zeros(len(hashes), np.int64) if o is None else o for o in out]


def small(name: str, values: np.ndarray) -> dict[str, np.ndarray]:
    """A column mostly of small counts: one byte each, 255 standing for an entry of the overflow table."""
    over = np.flatnonzero(values >= 255)
    return {name: np.minimum(values, 255).astype(np.uint8), f"{name}_over": over.astype(np.uint32), f"{name}_large": values[over].astype(np.uint64)}
