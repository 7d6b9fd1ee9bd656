"""Token counts from flat, unindexed token files.

A token file is a run of fixed-width little-endian token ids; each document ends with the
end-of-document id, and nothing else marks where documents are. The scan cuts every file
into blocks, and tasks search each block for that id in one vectorised comparison. A block
knows only its own separators, so an exclusive prefix scan over the blocks of a file carries
the number of documents ended and the place of the last separator across block borders.

Writing: each task appends its documents to one file of its own, under a name no other
attempt uses, and reports it with the ids of the documents in it. That report, the manifest,
is a Spark table; files of failed attempts are in no manifest and are never read.

Defined cases: very long texts are one document, however many blocks they cover; a null or
empty text is a document of no tokens; text that spells an added
token is encoded as ordinary text, so only real ends carry the id; tokens after a file's
last separator are a document with ``ended`` false; an empty file or table has no documents;
repeated rows are documents of their own. Other columns of the input are not read.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vaultlens.llm.bpe import Bpe, Encoder, _texts, default_vocabulary, text_batches
from vaultlens.llm.common import materialize, read_table
from vaultlens.llm.files import open_fs, read_range
from vaultlens.session import scratch_dir

END = "<|endoftext|>"
BLOCK_TOKENS = 1 << 20
TASK_BYTES = 64 << 20     # token bytes a scanning task reads


def token_width(size: int) -> int:
    return 2 if size <= 1 << 16 else 4


def write_token_files(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                      end: str = END) -> DataFrame:
    """Writes the token files of ``docs`` under the shared scratch folder. Returns the manifest:
    ``file, doc_no, id``."""
    spark = docs.sparkSession
    folder = scratch_dir(spark, "tokens")
    bpe = Bpe(path)
    width, end_id = token_width(bpe.size), bpe.added[end]
    shared = spark.sparkContext.broadcast(bpe)
    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches):
        encoder = Encoder(shared.value, added=False)
        system, base = open_fs(folder)
        file, out, count = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.tokens", None, 0
        tail = np.array([end_id], dtype=f"<u{width}").tobytes()
        try:
            for b in text_batches(batches, 1):
                if out is None:
                    system.create_dir(base, recursive=True)
                    out = system.open_output_stream(f"{base}/{file}", compression=None)
                for ids in encoder.encode(_texts(b.column(1))):
                    out.write(np.frombuffer(ids, dtype="<u4").astype(f"<u{width}").tobytes() + tail)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f"{folder}/{file}"] * b.num_rows), pa.array(range(count, count + b.num_rows), type=pa.int64()),
                     b.column(0)], names=["file", "doc_no", "id"])
                count += b.num_rows
        finally:
            if out is not None:
                out.close()

    manifest = src.mapInArrow(run, f"file string, doc_no long, id {src.schema['id'].dataType.simpleString()}")
    return materialize(manifest, "tokens-manifest")


def scan_token_files(files: DataFrame, end_id: int, width: int, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``file, doc_no, first_token, n_tokens, ended`` of every document in the token files listed by
    ``files`` (file, n_bytes). ``n_tokens`` leaves out the separator."""
    spark = files.sparkSession
    total = files.agg(F.sum("n_bytes")).first()[0] or 0
    step = block_tokens * width
    plan = files.where("n_bytes > 0").select(
        "file", "n_bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_bytes") - 1) / step))).alias("block"))
    # A plan row is small but stands for a whole block: the task count follows the bytes.
    plan = plan.repartition(max(1, -(-total // TASK_BYTES), min(spark.sparkContext.defaultParallelism, -(-total // step))), "file", "block")

    def run(batches):
        for b in batches:
            for file, n_bytes, block in zip(*(c.to_pylist() for c in b.columns)):
                data = np.frombuffer(read_range(file, block * step, min(step, n_bytes - block * step)), dtype=f"<u{width}")
                ends = np.flatnonzero(data == end_id) + block * block_tokens
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file]), pa.array([block], type=pa.int64()), pa.array([len(data)], type=pa.int64()),
                     pa.array([ends], type=pa.list_(pa.int64()))], names=["file", "block", "n", "ends"])

    blocks = materialize(plan.mapInArrow(run, "file string, block long, n long, ends array<long>"), "tokens-blocks")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    brief = blocks.select("file", "block", "n", F.size("ends").cast("long").alias("k"), F.get("ends", F.size("ends") - 1).alias("last"))
    scanned = brief.select("file", "block", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("docs_before"),
                           F.coalesce(F.max("last").over(before), F.lit(-1)).alias("last_before"))
    each = blocks.join(scanned, ["file", "block"]).select("file", "docs_before", "last_before", "ends", F.posexplode("ends").alias("i", "end"))
    start = F.when(F.col("i") == 0, F.col("last_before")).otherwise(F.get("ends", F.col("i") - 1)) + 1
    ended = each.select("file", (F.col("docs_before") + F.col("i")).alias("doc_no"), start.alias("first_token"),
                        (F.col("end") - start).alias("n_tokens"), F.lit(True).alias("ended"))
    rest = brief.groupBy("file").agg(F.sum("n").alias("n"), F.sum("k").alias("k"), F.coalesce(F.max("last"), F.lit(-1)).alias("last")) \
        .where(F.col("n") > F.col("last") + 1)
    return ended.unionByName(rest.select("file", F.col("k").alias("doc_no"), (F.col("last") + 1).alias("first_token"),
                                         (F.col("n") - F.col("last") - 1).alias("n_tokens"), F.lit(False).alias("ended")))


def listed_files(spark: SparkSession, folder: str) -> DataFrame:
    """``file, n_bytes`` of the token files in a folder; their content is not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.tokens").load(folder) \
        .select(F.col("path").alias("file"), F.col("length").alias("n_bytes"))


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end: str = END) -> DataFrame:
    """Writes ``docs`` as token files and scans them: ``id, file, doc_no, first_token, n_tokens, ended``."""
    spark = docs.sparkSession
    manifest = write_token_files(docs, path, id_col, text_col, end)
    bpe = Bpe(path)
    names = manifest.select("file").distinct()
    first = names.first()
    name = F.element_at(F.split("file", "/"), -1)
    if first is None:
        return manifest.selectExpr("id", "file", "doc_no", "doc_no as first_token", "doc_no as n_tokens", "true as ended")
    files = listed_files(spark, first[0].rsplit("/", 1)[0]).join(names.select(name.alias("known")), name == F.col("known"), "left_semi")
    docs_found = scan_token_files(files, bpe.added[end], token_width(bpe.size))
    m = manifest.select(name.alias("mname"), F.col("doc_no").alias("mno"), "id")
    return docs_found.withColumn("name", name).join(m, (F.col("name") == F.col("mname")) & (F.col("doc_no") == F.col("mno"))) \
        .select("id", F.col("name").alias("file"), "doc_no", "first_token", "n_tokens", "ended")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = token_counts(read_table(spark, sf_dir, "documents"), default_vocabulary())
    return d.select(F.col("id").alias("doc_id"), "n_tokens", "first_token", "doc_no", "ended")
