"""Exact deduplication: 128-bit content hash, then a byte comparison inside groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provgraph.llm.common import Scratch, lower_ascii, split

#: A hash that many rows share is dealt to this many parts before its texts are compared.
SALTS = 16


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", normalise=lower_ascii
) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256), one row per row of ``docs``.

    Texts are equal when ``normalise(text)`` has equal bytes; null counts as
    empty, and empty texts equal each other.  ``keep`` names the id that
    stays: ``smallest`` or ``largest``.  Rows that repeat the staying id are
    all kept (same id, same text); null ids never win against a real one, and
    a group of null ids only has keep_id null and keeps its rows.  Only the
    id and text columns are read, so extra columns of any name are harmless.
    An empty table gives an empty result.  Texts of any length are hashed and
    compared whole.

    Only hashes cross the network for all rows.  Hashes seen once are unique
    texts.  For the others the texts are fetched (a bit map of the shared
    hashes keeps almost all other texts out of the semi join's shuffle),
    dealt by hash and salt, and grouped by the text itself; grouping
    compares bytes and folds copies before the second exchange, so a group
    with a third of all rows never meets in one task.  A row finds its class
    by hash, second hash and byte length, the class's own text settling them.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is smallest or largest")
    pick = F.min if keep == "smallest" else F.max
    scratch = Scratch(docs.sparkSession, "exact-dedup")
    norm = docs.select(F.col(id_col).alias("_id"), normalise(F.coalesce(F.col(text_col), F.lit(""))).alias("_norm"))
    h128, h256, n = F.unhex(F.md5("_norm")).alias("_h"), F.unhex(F.sha2("_norm", 256)).alias("_s"), F.octet_length("_norm").alias("_n")
    meta = scratch.save(norm.select("_id", h128, h256, n))
    by_hash = scratch.save(meta.groupBy("_h").agg(F.count("*").alias("_rows")))
    salt = F.explode(F.array(*[F.lit(i) for i in range(SALTS)])).alias("_salt")
    shared = by_hash.where("_rows > 1")
    texts = norm.select("_norm", h128, F.pmod(F.xxhash64("_id"), F.lit(SALTS)).cast("int").alias("_salt"), "_id")
    texts, _ = split(texts, "_h", shared, "_h")
    same = (
        texts.join(shared.select("_h", salt), ["_h", "_salt"], "left_semi")
        .groupBy("_h", "_norm").agg(pick("_id").alias("keep_id"), F.count("*").alias("group_size"))
        .select("_h", h256, n, "keep_id", "group_size")
    )
    classes = scratch.save(same)
    out = meta.join(classes, ["_h", "_s", "_n"], "left")
    size = F.coalesce("group_size", F.lit(1)).cast("long")
    keep_id = F.when(F.col("group_size").isNull(), F.col("_id")).otherwise(F.col("keep_id"))
    return out.select(
        F.col("_id").alias(id_col),
        keep_id.alias("keep_id"),
        size.alias("group_size"),
        F.col("_id").eqNullSafe(keep_id).alias("kept"),
        F.lower(F.hex("_s")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """The rows of ``docs`` that stay, all their columns kept.

    A row goes when its id and text are marked as not kept; rows that repeat
    the staying id with an equal text all stay.  Null and empty texts equal
    each other, a null id goes where a real one stays, an empty table stays
    empty, and extra columns may have any names.  Texts of any length are
    compared whole.  Rows whose id is not among those that go are not shuffled.
    """
    gone = exact_duplicates(docs, id_col, text_col, keep).where("not kept").select(F.col(id_col).alias("_gone"), F.col("text_sha256").alias("_sha")).distinct()
    gone = Scratch(docs.sparkSession, "exact-dedup-gone").save(gone)
    some, stay = split(docs, id_col, gone, "_gone")
    sha = F.sha2(lower_ascii(F.coalesce(some[text_col], F.lit(""))), 256)
    return stay.union(some.join(gone, some[id_col].eqNullSafe(gone["_gone"]) & (sha == gone["_sha"]), "left_anti"))
