"""Exact dedup: group by a 128-bit content hash, compare bytes, keep one row.

Texts are equal when they are identical after lower-casing A-Z.  The group
key is (md5 of the normalised text, the text itself): the hash spreads the
rows, and the aggregate compares the whole text inside a hash bucket, so two
texts that collide in the hash stay two groups.  The aggregate is partial on
the map side, so a text that a third of all rows hold is reduced inside every
map task, and the shuffle carries each text about once.

Defined cases: a null text counts as empty; empty texts are one group; of
equal texts the row with the largest (or, with ``keep="smallest"``, the
smallest) id stays, and a null id loses to any other; rows that agree in id
and text are one document, returned once by :func:`decisions` and kept once by
:func:`keep_rows`; an empty table gives an empty result; columns other than id
and text are ignored by :func:`decisions` and carried by :func:`keep_rows`,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from starling.llm.common import lower_ascii, text_or_empty

_H, _T, _ROW = "__dedup_hash", "__dedup_text", "__dedup_row"


def content_hash(text: Column) -> Column:
    """The 128-bit content hash (md5 of the UTF-8 bytes)."""
    return F.unhex(F.md5(text.cast("binary")))


def _pick(keep: str):
    if keep not in ("largest", "smallest"):
        raise ValueError("keep is 'largest' or 'smallest'")
    return F.max if keep == "largest" else F.min


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """One row per distinct text: hash, sha-256, the id that stays, number of rows."""
    rows = docs.select(F.col(id_col).alias("id"), lower_ascii(text_or_empty(text_col)).alias(_T))
    rows = rows.select("id", content_hash(F.col(_T)).alias(_H), _T)
    return rows.groupBy(_H, _T).agg(_pick(keep)("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")).select(
        _H, F.unhex(F.sha2(F.col(_T).cast("binary"), 256)).alias("text_sha"), "keep_id", "group_size")


def decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256.

    Documents meet their group on (128-bit hash, sha-256), narrow rows, so a
    hash collision that the byte comparison told apart stays apart.  The join
    is between two plain exchanges: a hot group is split by the skew join.
    """
    text = lower_ascii(text_or_empty(text_col))
    rows = docs.select(F.col(id_col).alias("id"), text.alias(_T)).select(
        "id", content_hash(F.col(_T)).alias(_H), F.unhex(F.sha2(F.col(_T).cast("binary"), 256)).alias("text_sha"))
    rows = rows.groupBy("id", _H, "text_sha").agg(F.lit(1).alias("one")).drop("one")
    out = rows.join(groups(docs, id_col, text_col, keep), [_H, "text_sha"])
    return out.select(
        F.col("id").alias(id_col), "keep_id", "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("text_sha")).alias("text_sha256"))


def keep_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """The rows that stay, with all their columns: one whole row per distinct text.

    A sort-based partial aggregate reduces copies before the shuffle, so each
    distinct text travels about once and no second pass over the texts is needed.
    """
    pick = _pick(keep)
    order = F.col(id_col) if keep == "largest" else F.coalesce(
        F.col(id_col), F.lit(9223372036854775807).cast(docs.schema[id_col].dataType))
    keyed = docs.select(lower_ascii(text_or_empty(text_col)).alias(_T),
                        F.struct(order.alias("__order"), *[F.col(f"`{c}`") for c in docs.columns]).alias(_ROW))
    keyed = keyed.select(content_hash(F.col(_T)).alias(_H), _T, _ROW)
    return keyed.groupBy(_H, _T).agg(pick(_ROW).alias(_ROW)).select(
        *[F.col(_ROW).getField(c).alias(c) for c in docs.columns])
