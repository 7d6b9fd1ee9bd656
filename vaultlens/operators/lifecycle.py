"""Per-archive lifecycle: work gates, chunk bookkeeping, hash validation routing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultlens.constants import MAX_HASH_RETRIES


def validate_hash(computed: DataFrame, status: DataFrame, id_col: str = "aid") -> DataFrame:
    """Compare computed tree hashes with the recorded ``sha`` and route each archive.

    validated: equal; retry: different and ``rc < 3`` (rc is incremented);
    failed: different after the retries are used up.
    """
    j = status.join(computed.select(id_col, "tree_hash"), id_col)
    match = F.coalesce(F.col("tree_hash") == F.col("sha"), F.lit(False))
    route = (F.when(match, F.lit("validated"))
              .when(F.col("rc") < MAX_HASH_RETRIES, F.lit("retry"))
              .otherwise(F.lit("failed")))
    return j.withColumn("route", route)


def retry_requests(routed: DataFrame, id_col: str = "aid", clear_started: bool = True) -> DataFrame:
    """Retry rows: next retry count, cleared stage fields and the re-request message.

    The migrated code clears ``sgt`` and the chunk values but not ``psdt``, so
    the split step would skip the retry; ``clear_started=False`` keeps that.
    """
    r = routed.where(F.col("route") == "retry")
    job = F.col("jobId") if "jobId" in routed.columns else F.lit(None).cast("string")
    inner = F.to_json(F.struct(F.lit("RetryRequest").alias("Action"), job.alias("JobId"),
                               F.col(id_col).alias("ArchiveId"),
                               F.col("sz").cast("bigint").alias("ArchiveSizeInBytes")))
    # Same envelope as an original retrieval notice: {"Message": "<json text>"}.
    msg = F.to_json(F.struct(inner.alias("Message")))
    # the chunk attributes whose values the retry removes
    chunks = [chunk_list_expr(F.col("cc")).alias("clear_chunks")] if "cc" in routed.columns else []
    out = r.select(id_col, (F.col("rc") + 1).alias("rc"), F.lit(None).cast("timestamp").alias("sgt"),
                   msg.alias("message"), *chunks)
    if clear_started:
        out = out.withColumn("psdt", F.lit(None).cast("timestamp"))
    return out


def failure_totals(routed: DataFrame) -> DataFrame:
    """Bytes and count of archives that failed after their retries."""
    f = routed.where(F.col("route") == "failed")
    return f.agg(F.coalesce(F.sum("sz"), F.lit(0)).cast("bigint").alias("failed_bytes"),
                 F.count(F.lit(1)).alias("error_count"))


def latest_chunk_values(chunks: DataFrame, seq_col: str = "seq") -> DataFrame:
    """Per (archive, phase, part): the value of the latest delivery (redeliveries overwrite).

    ``max_by`` is a partial aggregate, so a hot archive is combined map-side.
    """
    return chunks.groupBy("aid", "phase", "part_no").agg(F.max_by("value", seq_col).alias("value"))


def chunk_completion(latest: DataFrame, counts: DataFrame) -> DataFrame:
    """Per (archive, phase): distinct parts recorded, complete when ``>= cc``,
    the ordered part list and the part map.

    One group holds at most one entry per part, so its size is bounded by the
    archive's chunk count.
    """
    g = latest.groupBy("aid", "phase").agg(
        F.count(F.lit(1)).alias("n_parts"),
        F.array_sort(F.collect_list(F.struct(F.col("part_no").alias("p"), F.col("value").alias("v")))).alias("_vl_l"))
    g = g.join(counts, "aid")
    return (g.withColumn("complete", F.col("n_parts") >= F.col("cc"))
             .withColumn("parts", F.array_join(F.transform("_vl_l", lambda x: F.concat(x.getField("p").cast("string"),
                                                                                      F.lit(":"), x.getField("v"))), ","))
             .withColumn("part_map", F.map_from_entries("_vl_l"))
             .withColumn("chunk_list", chunk_list_expr(F.col("cc")))
             .drop("_vl_l"))


def chunk_list_expr(cc):
    """``chunk1, chunk2, ..., chunkN`` for the N chunk attributes to clear."""
    return F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(cc, F.lit(1))),
                                    lambda i: F.concat(F.lit("chunk"), i.cast("string"))), ", ")


def work_gates(notices: DataFrame, status: DataFrame, id_col: str = "aid") -> DataFrame:
    """Route each notice by the archive's recorded progress.

    A notice for an archive with no status row yields no row (point lookup miss).
    split: skip when copying already started; copy: go straight to hashing when
    staged; hash: go straight to release when validated.
    """
    j = notices.join(status, id_col)
    return j.select(
        id_col,
        F.when(F.col("psdt").isNotNull(), "skip").otherwise("split").alias("split_action"),
        F.when(F.col("sgt").isNotNull(), "hash").otherwise("copy").alias("copy_route"),
        F.when(F.col("vdt").isNotNull(), "release").otherwise("hash").alias("hash_route"))


def latest_image(log: DataFrame, key: str, seq_col: str, fields: list[str]) -> DataFrame:
    """Current record per key from a log of whole images: the latest image wins, so a field
    it does not have is cleared."""
    return (log.groupBy(key).agg(F.max_by(F.struct(*fields), seq_col).alias("_vl_rec"))
               .select(key, "_vl_rec.*"))


def latest_state(log: DataFrame, key: str, seq_col: str, fields: list[str], written: str) -> DataFrame:
    """Current record per key from an append-only log of partial updates.

    ``written`` lists the fields an entry writes. Each field takes its value from the latest
    entry that wrote it: a field left out keeps its old value, a written null clears it.
    """
    aggs = [F.max_by(F.struct(F.col(f).alias("v")), F.when(F.array_contains(written, f), F.col(seq_col))).alias(f)
            for f in fields]
    st = log.groupBy(key).agg(*aggs)
    return st.select(key, *[F.col(f).getField("v").alias(f) for f in fields])


def chunk_rows_from_record(records: DataFrame, attrs_col: str = "attrs", id_col: str = "aid") -> DataFrame:
    """Raw status items (a map of attribute -> text) -> one row per ``chunkN`` value.

    In the raw form one attribute per chunk is reused across phases and the
    phase is known only from the value: longer than 40 characters is a tree hash
    (64 hex characters), otherwise an etag (quoted MD5, 34 characters).
    """
    ex = records.select(id_col, F.explode(F.col(attrs_col)).alias("k", "value"))
    chunks = ex.where(F.col("k").rlike("^chunk[0-9]+$"))
    return chunks.select(
        id_col,
        F.regexp_extract("k", "([0-9]+)$", 1).cast("int").alias("part_no"),
        "value",
        F.when(F.length("value") > 40, F.lit("hashed")).otherwise(F.lit("etag")).alias("kind"))
