"""Views from the driver tables onto the migration schemas.

Each view is derived by Spark from the given tables, so its size grows with
them. The DuckDB spelling of the same views is in :mod:`vaultlens.plans.oracle`.
"""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultlens.functions.sizing import chunk_count
from vaultlens.sources import ranges_io


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c):
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def inventory_ext(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inventory rows with the helper columns ``base``, ``ln``, ``ok``.

    archiveid = order-line-part-supplier; creationdate = ship date text (many ties);
    size = quantity x 256 MiB (quantity 16 lands on exactly 4 GiB); the
    description takes one of seven shapes chosen by the line number, and first lines
    take six more by the order: base64 without padding and with foreign characters,
    bytes that are not UTF-8, a JSON text with an extra brace or a second document, and
    a plain name that equals what another archive's suffixed name may be.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate",
        "l_returnflag", "l_linestatus")
    base = F.concat(F.lit("set"), (F.col("l_partkey") % 50).cast("string"),
                    F.lit("/obj"), (F.col("l_suppkey") % 10).cast("string"))
    b64 = F.base64(F.col("base").cast("binary"))
    ln = F.col("ln")
    m = F.col("ok") % 7
    odd = (F.when(m == 1, F.concat(F.lit("<m><p>!"), F.replace(b64, F.lit("="), F.lit("")), F.lit("*</p></m>")))
            .when(m == 2, F.concat(F.lit('{"Path":"'), F.col("base"), F.lit('"}}')))
            .when(m == 3, F.concat(F.lit('{"Path":"'), F.col("base"), F.lit('"} {"x":1}')))
            .when(m == 4, F.lit("<m><p>6Q==</p></m>"))
            .when(m == 5, F.concat(F.col("base"), F.lit("-1995-06-17")))
            .otherwise(F.col("base")))
    desc = (F.when(ln == 2, F.concat(F.lit("<m><v>4</v><p>"), b64, F.lit(" </p><lm>x</lm></m>")))
             .when(ln == 3, F.concat(F.lit('{"Path":"'), F.col("base"), F.lit('","UTCDateModified":"x"}')))
             .when(ln == 4, F.translate(F.col("base"), "/", "\\"))
             .when(ln == 5, F.lit("   "))
             .when(ln == 6, F.concat(F.lit('"<ArchiveMetadata>  <Path>  '), b64, F.lit('  </Path></ArchiveMetadata>"')))
             .when(ln == 7, F.lit('{"Path":"   "}'))
             .when(ln == 1, odd)
             .otherwise(F.col("base")))
    z = li.select(
        F.concat_ws("-", _s("l_orderkey"), _s("l_linenumber"), _s("l_partkey"), _s("l_suppkey")).alias("archiveid"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("creationdate"),
        (F.col("l_quantity").cast("bigint") * F.lit(268435456)).alias("size"),
        base.alias("base"),
        F.col("l_linenumber").alias("ln"),
        F.col("l_orderkey").alias("ok"),
        F.col("l_returnflag").alias("rf"),
        F.col("l_linestatus").alias("ls"),
    )
    return z.withColumn("archivedescription", desc).withColumn("sha256treehash", F.sha2(F.col("archiveid"), 256))


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five-column inventory."""
    return inventory_ext(spark, sf_dir).select(
        "archiveid", "archivedescription", "creationdate", "size", "sha256treehash")


def overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Override list for returned lines (flag R): blank, empty, null and real
    overrides by line number; open returned lines (status O) get a second value."""
    inv = inventory_ext(spark, sf_dir)
    m = F.col("ln") % 4
    first = inv.where(F.col("rf") == "R").select(
        "archiveid",
        F.when(m == 1, F.lit("   ")).when(m == 2, F.lit("")).when(m == 3, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("ovr/"), F.col("base"))).alias("override"))
    second = inv.where((F.col("rf") == "R") & (F.col("ls") == "O")).select(
        "archiveid", F.concat(F.lit("zz/"), F.col("base")).alias("override"))
    return first.unionByName(second)


def recorded_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives already requested in an earlier run: those whose order is finished ('F')."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ok"), "o_orderstatus")
    inv = inventory_ext(spark, sf_dir)
    return (inv.join(orders, "ok")
               .where(F.col("o_orderstatus") == "F")
               .select(F.col("archiveid").alias("aid"), F.col("size").alias("sz")))


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status change records derived from ``events``.

    aid = user; event type sets a stage (signup->cdt, click->sgt, view->vdt,
    purchase->cpt); error is a REMOVE. The old image holds every stage the
    archive reached strictly before this event, the new image includes it.
    """
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    stage = (F.when(F.col("event_type") == "signup", "cdt").when(F.col("event_type") == "click", "sgt")
              .when(F.col("event_type") == "view", "vdt").when(F.col("event_type") == "purchase", "cpt"))
    ev = ev.withColumn("aid", F.col("user_id").cast("string")).withColumn("stage", stage) \
           .withColumn("seq", F.struct(F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("id")))
    # First time each archive reached each stage, and its first record: partial
    # aggregates, one row per archive, joined back on the archive key.
    firsts = ev.groupBy("aid").agg(
        F.min("seq").alias("first_seq"),
        *[F.min(F.when(F.col("stage") == f, F.col("seq"))).alias(f"first_{f}") for f in ("cdt", "sgt", "vdt", "cpt")])
    j = ev.join(firsts, "aid")
    sz = (F.col("user_id") * 1000 + 1).cast("bigint")

    def image(strict: bool):
        fields = []
        for f in ("cdt", "sgt", "vdt", "cpt"):
            fs = F.col(f"first_{f}")
            reached = (fs < F.col("seq")) if strict else (fs <= F.col("seq"))
            fields.append(F.when(reached, fs.getField("ts")).alias(f))
        fields.append(sz.alias("sz"))
        return F.struct(*fields)

    name = (F.when(F.col("event_type") == "error", F.lit("REMOVE"))
             .when(F.col("first_seq") == F.col("seq"), F.lit("INSERT"))
             .otherwise(F.lit("MODIFY")))
    old = F.when(F.col("first_seq") < F.col("seq"), image(True))
    return j.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "aid",
                    name.alias("event_name"), old.alias("old"), image(False).alias("new"))


STATUS_FIELDS = ["cdt", "sgt", "vdt", "cpt", "sz"]


def status_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The new image of each change record that is not a removal; every 11th event is a retry,
    which has cleared the staged time."""
    c = changes(spark, sf_dir).where(F.col("event_name") != "REMOVE")
    return c.select("aid", F.struct("ts", "event_id").alias("seq"), *[
        (F.when(F.col("event_id") % 11 != 0, F.col("new").getField(f)) if f == "sgt" else F.col("new").getField(f)).alias(f)
        for f in STATUS_FIELDS])


RECORD_FIELDS = T.StructType([*[T.StructField(f, T.TimestampType()) for f in ("cdt", "sgt", "vdt", "cpt")],
                              T.StructField("sz", T.LongType())])


def status_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partial updates of status records: each event writes the fields of its own step only.

    A signup writes ``cdt`` and ``sz``, a view ``vdt``, a purchase ``cpt``, a click ``sgt`` (every
    11th is a retry and clears it). An error clears ``sgt``; every third removes the record.
    """
    ev = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")
    kind = F.col("event_type")
    writes = (F.when(kind == "signup", F.array(F.lit("cdt"), F.lit("sz"))).when(kind == "view", F.array(F.lit("vdt")))
               .when(kind == "purchase", F.array(F.lit("cpt"))).otherwise(F.array(F.lit("sgt"))))
    return ev.select(
        _s("user_id").alias("aid"), F.array(F.unix_micros("ts"), F.col("event_id").cast("bigint")).alias("seq"),
        writes.alias("written"), ((kind == "error") & (F.col("event_id") % 3 == 0)).alias("removed"),
        F.when(kind == "signup", F.col("ts")).alias("cdt"),
        F.when((kind == "click") & (F.col("event_id") % 11 != 0), F.col("ts")).alias("sgt"),
        F.when(kind == "view", F.col("ts")).alias("vdt"), F.when(kind == "purchase", F.col("ts")).alias("cpt"),
        F.when(kind == "signup", F.col("user_id") * 1000 + F.col("event_id")).cast("bigint").alias("sz"))


def chunk_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-chunk results as the pipeline records them, with redeliveries.

    aid = order; part = line number; the phase comes from the return flag
    (N: copy etag, R: chunk tree hash, A: release etag). Several lineitem rows
    share (order, line), so the same part is delivered more than once.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_shipdate")
    phase = (F.when(F.col("l_returnflag") == "N", "copied").when(F.col("l_returnflag") == "R", "hashed")
              .otherwise("released"))
    token = F.concat_ws("-", _s("l_orderkey"), _s("l_linenumber"), _s("l_partkey"), _s("l_suppkey"))
    value = (F.when(F.col("phase") == "hashed", F.sha2(token, 256))
              .otherwise(F.concat(F.lit('"'), F.md5(token), F.lit('"'))))
    return (li.withColumn("phase", phase)
              .select(_s("l_orderkey").alias("aid"), "phase", F.col("l_linenumber").cast("int").alias("part_no"),
                      value.alias("value"),
                      F.struct(F.col("l_shipdate").cast("timestamp").alias("ts"), token.alias("tok")).alias("seq")))


def raw_status_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status items as the key-value table holds them: a map of attribute names and texts, with one
    attribute ``chunkN`` a chunk that every phase writes again, and attributes that are no chunks."""
    latest = chunk_results(spark, sf_dir).groupBy("aid", "part_no").agg(F.max_by("value", "seq").alias("value"))
    entries = F.collect_list(F.struct(F.concat(F.lit("chunk"), "part_no").alias("k"), "value"))   # at most one a line number
    items = latest.groupBy("aid").agg(F.map_from_entries(entries).alias("chunks"))
    other = F.create_map(F.lit("fname"), F.concat(F.lit("obj/"), "aid"), F.lit("chunked"), F.lit("yes"), F.lit("chunk"), F.lit("none"))
    return items.select("aid", F.map_concat(other, "chunks").alias("attrs"))


def chunk_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunk count per archive (order): 1 + customer key mod 7."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return o.select(_s("o_orderkey").alias("aid"), (F.lit(1) + F.col("o_custkey") % 7).cast("int").alias("cc"))


def payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive bytes: the UTF-8 text of each document."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    return d.select(_s("doc_id").alias("aid"), F.encode("text", "UTF-8").alias("bytes"),
                    (F.col("n_chars") % 5).cast("int").alias("rc"))


def metric_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    return ev.select("event_id", F.col("ts").cast("timestamp").alias("ts"),
                     F.col("event_type").alias("metric"), "value")


def log_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines assembled from events: three accepted spellings of 'error',
    one that is not accepted, and the two known noise messages."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value", "props")
    word = (F.when(F.col("event_id") % 4 == 0, "error").when(F.col("event_id") % 4 == 1, "Error")
             .when(F.col("event_id") % 4 == 2, "ERROR").otherwise("eRRor"))
    lead = F.when(F.col("event_type") == "error", F.concat(word, F.lit(": "))).otherwise(F.lit("INFO "))
    tail = (F.when(F.col("value") > 45, F.lit(" ThrottlingException"))
             .when(F.col("value") < 5, F.lit(" Idle connections will be closed")).otherwise(F.lit("")))
    msg = F.concat(lead, F.col("event_type"), F.lit(" "), F.col("props"), tail)
    return ev.select("event_id", F.col("ts").cast("timestamp").alias("ts"), msg.alias("message"))


# --- fixed values: prefixes cleaned up after a migration, in listing order
LISTING_PREFIXES = ["results", "partitioned", "inventory", "filelist", "glue"]


def object_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bucket keys built from page URLs under five listing prefixes."""
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    prefixes = F.array(*[F.lit(x) for x in LISTING_PREFIXES])
    key = F.concat(F.element_at(prefixes, (F.col("page_id") % 5 + 1).cast("int")), F.lit("/"),
                   F.regexp_replace("url", "^[a-z]+://", ""))
    return p.select(key.alias("key"), F.length("url").cast("bigint").alias("size"))


def throttle_events(spark: SparkSession, sf_dir: str, parted: DataFrame) -> DataFrame:
    """Throttling errors: each ``error`` event of user u hits the archive numbered u,
    adding that archive's whole size (as a failed chunk copy does). Copies follow their
    request late: the error arrives none, one or two partitions on, and ``part`` is the
    partition whose wait finds it in the counter (none, if there is no such partition any more)."""
    ev = table(spark, sf_dir, "events").where(F.col("event_type") == "error").select("user_id", (F.col("event_id") % 3).alias("late"))
    hit = ev.join(parted.select(F.col("row_num").alias("user_id"), "part", "size"), "user_id")
    return hit.select((F.col("part") + F.col("late")).cast("bigint").alias("part"), F.col("size").alias("throttled_bytes"),
                      F.lit(1).alias("errors"))


def request_times(parted: DataFrame) -> DataFrame:
    """Seconds that each partition's own requests took: 0 to 12 a request, by partition; the slow
    ones take longer than their share of the daily quota."""
    return parted.groupBy("part").agg((F.count(F.lit(1)) * (F.col("part") % 5) * 3).cast("bigint").alias("elapsed_s"))


def destination_listing(spark: SparkSession, sf_dir: str, status: DataFrame):
    """Listings derived from order status: finished orders are already at the
    destination (plus a near-miss ``.bak`` key that a prefix listing also returns);
    pending orders have no staged copy yet."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("ok"), "o_orderstatus")
    s = status.withColumn("ok", F.substring_index("aid", "-", 1)).join(orders, "ok")
    dest = s.where(F.col("o_orderstatus") == "F").select(F.col("fname").alias("key"))
    near = s.where(F.col("o_orderstatus") == "O").select(F.concat(F.col("fname"), F.lit(".bak")).alias("key"))
    staged = s.where(F.col("o_orderstatus") != "P").select(F.col("fname").alias("key")).distinct()
    return dest.unionByName(near).distinct(), staged


def hash_status(spark: SparkSession, sf_dir: str, computed: DataFrame) -> DataFrame:
    """Recorded hashes: right for documents labelled quality 1, wrong for quality 0,
    missing for unlabelled ones; retry count from the text length."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("aid"), "quality")
    p = payload(spark, sf_dir).select("aid", F.octet_length("bytes").cast("bigint").alias("sz"), "rc")
    j = p.join(computed.select("aid", "tree_hash"), "aid").join(labels, "aid", "left")
    sha = (F.when(F.col("quality") == 1, F.col("tree_hash"))
            .when(F.col("quality") == 0, F.sha2(F.concat(F.lit("corrupt-"), F.col("aid")), 256)))
    return j.select("aid", "sz", "rc", sha.alias("sha"))


def status_light(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status rows (with the object's key) and progress timestamps set from the line's flags:
    copy started when the line status is F, staged when returned (A or R),
    validated when R."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate",
        "l_quantity")
    aid = F.concat_ws("-", _s("l_orderkey"), _s("l_linenumber"), _s("l_partkey"), _s("l_suppkey"))
    ts = F.col("l_shipdate").cast("timestamp")
    sz = F.col("l_quantity").cast("bigint") * F.lit(268435456)
    puts = li.select(aid.alias("aid"),
                     F.struct(ts.alias("ts"), F.col("l_quantity").alias("q")).alias("_vl_seq"),
                     F.struct(F.when(F.col("l_linestatus") == "F", ts).alias("psdt"),
                              F.when(F.col("l_returnflag").isin("A", "R"), ts).alias("sgt"),
                              F.when(F.col("l_returnflag") == "R", ts).alias("vdt"),
                              sz.alias("sz"), chunk_count(sz).cast("int").alias("cc")).alias("_vl_rec"))
    # A key-value table: a later put of the same key replaces the earlier one.
    return (puts.groupBy("aid").agg(F.max_by("_vl_rec", "_vl_seq").alias("_vl_rec"))
                .select("aid", F.concat(F.lit("obj/"), "aid").alias("fname"), "_vl_rec.*"))


def queue_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queue messages from events: queue = event type, sent at ts, deleted ``value``
    minutes later; every 97th is never deleted."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    sent = F.unix_micros(F.col("ts").cast("timestamp"))
    done = sent + F.round(F.col("value") * 60000000).cast("bigint")
    return ev.select(F.col("event_type").alias("queue"), sent.alias("sent_us"),
                     F.when(F.col("event_id") % 97 != 0, done).alias("done_us"))


def stage_objects(df: DataFrame, base: str, id_col: str = "aid", bytes_col: str = "bytes") -> DataFrame:
    """Write each row's bytes as the object ``<base>/<id>``; returns (id, path, size).

    Each attempt writes to its own temporary name and renames it into place, so a
    retried or speculative task never interleaves with another attempt and a
    re-run leaves the same object.
    """
    def write(batches):
        fs, root = ranges_io.file_system(base.rstrip("/"))
        folder = None   # the one written to last: most objects share theirs with the object before
        for pdf in batches:
            paths, sizes = [], []
            for aid, data in zip(pdf[id_col], pdf[bytes_col]):
                target, p = f"{base.rstrip('/')}/{aid}", f"{root}/{aid}"
                if p.rsplit("/", 1)[0] != folder:
                    folder = p.rsplit("/", 1)[0]
                    fs.create_dir(folder, recursive=True)
                tmp = f"{p}.tmp-{uuid.uuid4().hex}"
                with fs.open_output_stream(tmp) as out:
                    out.write(bytes(data))
                fs.move(tmp, p)
                paths.append(target)
                sizes.append(len(data))
            yield pd.DataFrame({id_col: pdf[id_col], "path": paths, "size": pd.Series(sizes, dtype="int64")})

    return df.select(id_col, bytes_col).mapInPandas(write, f"{id_col} string, path string, size long")
