"""Byte-range reads and copies executed on the executors.

The plan rows (object path, part, start, end) are partitioned by Spark; each
task streams its ranges through Arrow's filesystem layer in fixed blocks, so no
task holds more than one block, and nothing but digests and manifests leaves
the executors.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultlens.constants import TREE_HASH_LEAF

BLOCK = 8 * 1024 * 1024
TASK_BYTES = 4 * 1024 * 1024 * 1024   # planned bytes a task reads


def file_system(uri: str):
    """File system and path of a URI as Spark spells it (``s3a:`` is Arrow's ``s3:``)."""
    from pyarrow import fs as pafs
    if uri.startswith(("s3a:", "s3n:")):
        uri = "s3:" + uri[4:]
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:") and not uri.startswith("file://"):
        return pafs.LocalFileSystem(), uri[5:]
    return pafs.FileSystem.from_uri(uri)


def _read_range(path: str, start: int, end: int, block: int) -> Iterator[bytes]:
    fs, p = file_system(path)
    with fs.open_input_file(p) as f:
        f.seek(start)
        left = end - start + 1
        while left > 0:
            b = f.read(min(block, left))
            if not b:
                raise OSError(f"{path}: {left} bytes of the range {start}-{end} are missing")
            left -= len(b)
            yield b


class _Tree:
    """Tree hash of a stream of leaves; keeps one digest per level."""

    def __init__(self):
        self.nodes: list[tuple[int, bytes]] = []   # (level, digest), levels falling

    def add(self, leaf) -> None:
        level, digest = 0, hashlib.sha256(leaf).digest()
        while self.nodes and self.nodes[-1][0] == level:
            digest = hashlib.sha256(self.nodes.pop()[1] + digest).digest()
            level += 1
        self.nodes.append((level, digest))

    def root(self) -> str:
        digest = self.nodes[-1][1]
        for _, left in reversed(self.nodes[:-1]):   # an odd last node moves up unchanged
            digest = hashlib.sha256(left + digest).digest()
        return digest.hex()


def scan_byte_ranges(plan: DataFrame, leaf: int = TREE_HASH_LEAF, id_col: str = "aid") -> DataFrame:
    """Tree hash of each planned range: (id, part_no, digest), one row per plan row.

    Leaves are hashed and combined where they are read; a task holds one block, one
    digest per tree level and the roots of one Arrow batch of plan rows. Ranges of a power-of-two number of leaves combine to the hash
    of the whole object. A source shorter than its range is an error.
    """
    def run(batches):
        for pdf in batches:
            roots = []
            for path, start, end in zip(pdf["path"], pdf["start_byte"], pdf["end_byte"]):
                tree, seen = _Tree(), False
                for block in _read_range(path, int(start), int(end), max(leaf, (BLOCK // leaf) * leaf)):
                    mv, seen = memoryview(block), True
                    for off in range(0, len(block), leaf):
                        tree.add(mv[off:off + leaf])
                if not seen:
                    tree.add(b"")
                roots.append(tree.root())
            # One frame a batch: a frame and an Arrow batch of their own cost a small range more than its hash.
            yield pd.DataFrame({id_col: pdf[id_col], "part_no": pdf["part_no"].astype("int32"), "digest": roots})

    return plan.select(id_col, "part_no", "path", "start_byte", "end_byte").mapInPandas(
        run, f"{id_col} string, part_no int, digest string")


def copy_byte_ranges(plan: DataFrame, dest: str, id_col: str = "aid") -> DataFrame:
    """Copy each planned range to ``<dest>/<id>/part-<n>``; returns the part manifest
    (id, part_no, nbytes, etag) where the etag is the MD5 of the part, quoted. Takes
    ranged plans only: every row needs its part number and both range ends."""
    def run(batches):
        for pdf in batches:
            out = {id_col: [], "part_no": [], "nbytes": [], "etag": []}
            for aid, part, path, start, end in zip(pdf[id_col], pdf["part_no"], pdf["path"],
                                                   pdf["start_byte"], pdf["end_byte"]):
                target = f"{dest.rstrip('/')}/{aid}/part-{int(part):05d}"
                fs, p = file_system(target)
                fs.create_dir(p.rsplit("/", 1)[0], recursive=True)
                md5 = hashlib.md5()
                n = 0
                tmp = f"{p}.tmp-{uuid.uuid4().hex}"
                with fs.open_output_stream(tmp) as o:
                    for block in _read_range(path, int(start), int(end), BLOCK):
                        md5.update(block)
                        o.write(block)
                        n += len(block)
                fs.move(tmp, p)
                out[id_col].append(aid); out["part_no"].append(int(part)); out["nbytes"].append(n)
                out["etag"].append('"' + md5.hexdigest() + '"')
            yield pd.DataFrame(out).astype({"part_no": "int32", "nbytes": "int64"})

    return plan.select(id_col, "part_no", "path", "start_byte", "end_byte").mapInPandas(
        run, f"{id_col} string, part_no int, nbytes long, etag string")


def spread(plan: DataFrame, id_col: str = "aid", task_bytes: int = TASK_BYTES) -> DataFrame:
    """Spread range tasks over the cluster before the I/O step.

    A plan row is tiny but stands for up to a whole range, so the task count follows the
    planned bytes. An explicit count is not coalesced by AQE.
    """
    planned = plan.agg(F.sum(F.col("end_byte") - F.col("start_byte") + 1).alias("b"), F.count(F.lit(1)).alias("n")).first()
    cores = plan.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, -(-(planned.b or 0) // task_bytes), min(planned.n, cores))
    return plan.repartition(int(tasks), F.col(id_col), F.col("part_no"))
