"""Archive names: description parsing and collision-free naming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultlens.constants import UNDEFINED_PREFIX
from vaultlens.functions.text import (base64_kept, base64_text, js_trim, json_documents, json_path, parsed_name, suffix_name,
                                     xml_payload)
from vaultlens.session import ensure_checkpoint_dir, materialize


def resolve_names(df: DataFrame, id_col: str = "archiveid", desc_col: str = "archivedescription",
                  out: str = "fname", ascii7: bool = False) -> DataFrame:
    """Add the normalised name parsed from each description (native expressions only).

    Same steps as :func:`vaultlens.functions.text.normalise_name`, each a column of its own:
    a step is used by several branches of the next, and subexpression elimination does not
    reach into conditional branches.
    """
    staged = (df.withColumn("_vl_d", js_trim(F.coalesce(F.col(desc_col), F.lit(""))))
                .withColumns({"_vl_x": xml_payload("_vl_d"), "_vl_docs": json_documents("_vl_d")})
                .withColumns({"_vl_k": base64_kept("_vl_x"), "_vl_j": json_path("_vl_docs")})
                .withColumn("_vl_b", base64_text("_vl_k", ascii7))
                .withColumn("_vl_p", js_trim(F.coalesce(parsed_name("_vl_d", "_vl_x", "_vl_b", "_vl_j"), F.lit("")))))
    named = F.when(F.col("_vl_p") == "", F.concat(F.lit(UNDEFINED_PREFIX), F.col(id_col))).otherwise(F.col("_vl_p"))
    return staged.withColumn(out, F.translate(named, "\\", "/")).drop("_vl_d", "_vl_x", "_vl_docs", "_vl_k", "_vl_j", "_vl_b", "_vl_p")


def unique_names(df: DataFrame, name_col: str = "fname", order_col: str = "row_num",
                 date_col: str = "creationdate", recorded: DataFrame | None = None,
                 out: str = "fname", materialize_input: bool = True) -> DataFrame:
    """Give every archive a name not used before it in ``order_col`` order.

    Sequentially: a name already assigned (earlier in this run, or ``recorded``)
    gets ``-<creationdate>`` appended, once. Exact parallel form:

    * every row that is not the first of its base name is suffixed;
    * the first row of a base is suffixed iff the base is recorded, or it equals
      the suffixed name of an earlier row that is itself suffixed. That earlier row
      is one that always is (a seed), or another first row (a link). Links lead
      from a first row to a later one and each row has one at most, so they form
      a forest; what the seeds reach is found by pointer doubling, in as many
      rounds as the logarithm of the longest chain. Without links there is no round.

    Skew: a base shared by a third of all rows never lands in one task; the
    first row per base is a partial aggregate joined back on the unique
    (name, order) pair, and seeds, links and rounds join one row per name with one
    row per name.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    # The first-per-name aggregate and the join back both read the rows: write them
    # once, unless the input is already cheap to re-read (e.g. a materialised table).
    rows = df.withColumn("_vl_base", F.col(name_col)).withColumn("_vl_ord", F.col(order_col))
    if materialize_input:
        rows = materialize(rows, "named")
    firsts = rows.groupBy("_vl_base").agg(F.min("_vl_ord").alias("_vl_ord"))
    # Both per-name tables are written once; the rounds below read them, not the rows.
    suffixed_later = materialize(rows.join(firsts, ["_vl_base", "_vl_ord"], "left_anti")
                                 .select(suffix_name("_vl_base", date_col).alias("_vl_name"), "_vl_ord")
                                 .groupBy("_vl_name").agg(F.min("_vl_ord").alias("_vl_sord")), "names-later")
    first_rows = materialize(rows.join(firsts, ["_vl_base", "_vl_ord"], "left_semi")
                             .select("_vl_base", "_vl_ord", suffix_name("_vl_base", date_col).alias("_vl_sname")), "names-first")
    seeds = first_rows.join(suffixed_later, first_rows["_vl_base"] == suffixed_later["_vl_name"]) \
                      .where(F.col("_vl_sord") < F.col("_vl_ord")).select("_vl_base")
    if recorded is not None:
        rec = recorded.select(F.col(name_col).alias("_vl_base")).distinct()
        seeds = seeds.unionByName(first_rows.join(rec, "_vl_base", "left_semi").select("_vl_base"))
    later = first_rows.select(F.col("_vl_base").alias("_vl_to"), F.col("_vl_ord").alias("_vl_to_ord"))
    links = first_rows.join(later, F.col("_vl_sname") == F.col("_vl_to")).where(F.col("_vl_ord") < F.col("_vl_to_ord")) \
                      .select(F.col("_vl_base").alias("_vl_from"), "_vl_to")
    chosen = _reached(materialize(seeds.distinct(), "names-seeds"), materialize(links, "names-links"))
    # The rows are flagged once, through the unique (base, order) pairs of the first rows
    # that keep their name, so a hot base never funnels into one join task.
    keeps = (first_rows.join(chosen, "_vl_base", "left_anti")
                       .select("_vl_base", "_vl_ord", F.lit(True).alias("_vl_keeps")))
    res = rows.join(keeps, ["_vl_base", "_vl_ord"], "left")
    suffix = F.col("_vl_keeps").isNull()
    return (res.withColumn(out, F.when(suffix, suffix_name("_vl_base", date_col)).otherwise(F.col("_vl_base")))
               .withColumn("suffixed", suffix)
               .drop("_vl_base", "_vl_ord", "_vl_keeps"))


def _reached(seeds: DataFrame, links: DataFrame) -> DataFrame:
    """``_vl_base``: the seeds and all that links lead to from them. Round k follows 2^k links at
    once: the marks of distance below 2^k meet the links of length 2^k, then the links double."""
    marks, n = seeds, seeds.count()
    jump = links
    while not jump.isEmpty():
        far = jump.join(marks, F.col("_vl_from") == F.col("_vl_base"), "left_semi").select(F.col("_vl_to").alias("_vl_base"))
        marks = materialize(marks.unionByName(far).distinct(), "names-round")
        now = marks.count()
        if now == n:
            break
        n = now
        ahead = jump.select(F.col("_vl_from").alias("_vl_to"), F.col("_vl_to").alias("_vl_next"))
        jump = materialize(jump.join(ahead, "_vl_to").select("_vl_from", F.col("_vl_next").alias("_vl_to")), "names-links")
    return marks
