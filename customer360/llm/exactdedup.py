"""Exact dedup by progressive refinement, with DataFrame functions only.

Texts are equal when identical after lower-casing A-Z. Each step reads more of a
text, and only of the texts that the step before could not tell apart:

1. rows are counted by byte length; a length that one row alone has settles it;
2. of the others the first ``prefix`` characters are hashed and counted with
   the length; a pair of length and hash that one row alone has settles it;
3. of the rest the whole normalised text is hashed (SHA-256), and groups are
   formed by that digest.

What survives a step is marked in a bitmap by a hash of its key; the next scan
meets it in a broadcast join and reads on only where its bit is set. The bitmap
grows with the number of survivors, up to ``MOST_BITS``. Two keys that share a
bit cost a needless read, never a wrong result: groups are formed by the full
digest alone. Texts never move; what is shuffled is a digest per survivor.

A group of any size is counted by partial aggregation, and its rows find their
group's facts by :func:`customer360.llm.skew.join_groups`.

Defined results: a NULL text counts as empty, and empty texts are equal; a
NULL doc_id is smaller than any other, and ``keep_id`` is NULL only in a group
without ids; rows that repeat both doc_id and text are one document: the
report has a row for each, all of them kept or none, and ``drop_copies`` leaves
one of them; an empty table gives no rows; other columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from customer360.llm.skew import free_name, join_groups
from customer360.plans import cut_lineage

PREFIX_CHARS = 256
#: Bits per surviving key, and the most a bitmap has (128 MB).
KEY_BITS = 16
MOST_BITS = 1 << 30
#: Bits of one stored bitmap row: fixed by the bitmap functions.
ROW_BITS = 1 << 15

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def normalised(text: Column) -> Column:
    """The text with A-Z lower-cased and nothing else; NULL counts as empty."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    # Where bytes and characters are as many, all are ASCII, and lower() changes A-Z only.
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


class _Survivors:
    """Keys held by several rows, as a bitmap that other scans are joined with."""

    def __init__(self, keys: DataFrame):
        keys = cut_lineage(keys.select("key"))
        wanted = max(ROW_BITS, KEY_BITS * keys.count())
        self.bits = min(MOST_BITS, 1 << (wanted - 1).bit_length())
        slot = self._slot(F.col("key"))
        self.table = keys.groupBy(F.bitmap_bucket_number(slot).alias("row")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))

    def _slot(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.bits)) + 1

    def mark(self, rows: DataFrame, key: Column, name: str) -> DataFrame:
        """``rows`` plus the boolean ``name``: true if the key's bit is set."""
        row, bits = free_name("bitmap_row", rows), free_name("bitmap", rows)
        slot = self._slot(key)
        table = self.table.select(F.col("row").alias(row), F.col("bits").alias(bits))
        # At most MOST_BITS / ROW_BITS rows of ROW_BITS bits.
        met = rows.join(F.broadcast(table), F.bitmap_bucket_number(slot) == F.col(row), "left")
        at = F.bitmap_bit_position(slot)
        byte = F.conv(F.hex(F.substring(F.col(bits), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        found = F.getbit(byte, (at % 8).cast("int")) == 1
        return met.withColumn(name, F.coalesce(found, F.lit(False))).drop(row, bits)


def _repeated(rows: DataFrame, *keys: str) -> DataFrame:
    """(key): a hash of each combination of ``keys`` that several rows have."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").select(F.xxhash64(*keys).alias("key"))


def surviving(docs: DataFrame, prefix: int = PREFIX_CHARS) -> tuple[DataFrame, str]:
    """``docs`` plus a boolean column, and that column's name: true for every row
    that length and prefix cannot tell from all others."""
    flag = free_name("survives", docs)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    length = F.octet_length(text).alias("length")
    head = F.xxhash64(normalised(F.substring(text, 1, prefix))).alias("head")
    lengths = _Survivors(_repeated(docs.select(length), "length"))
    started = lengths.mark(docs.select("text"), F.xxhash64(F.octet_length(text)), flag).where(F.col(flag))
    heads = _Survivors(_repeated(started.select(length, head), "length", "head"))
    first = lengths.mark(docs, F.xxhash64(F.octet_length(text)), flag)
    # A row alone of its length is not read any further.
    key = F.when(F.col(flag), F.xxhash64(F.octet_length(text), F.xxhash64(normalised(F.substring(text, 1, prefix)))))
    second = free_name("survives_too", first)
    return heads.mark(first, key, second).withColumn(flag, F.col(flag) & F.col(second)).drop(second), flag


def copy_groups(docs: DataFrame, prefix: int = PREFIX_CHARS, digest_all: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept and digest, the
    SHA-256 of the normalised text. Rows alone by length or prefix have no digest
    unless ``digest_all`` asks for it, as then every text is read to its end."""
    rows, flag = surviving(docs.select("doc_id", "text"), prefix)
    digest = F.sha2(normalised(F.col("text")), 256)
    rows = rows.select("doc_id", flag, (digest if digest_all else F.when(F.col(flag), digest)).alias("digest"))
    rows = cut_lineage(rows)
    alone = rows.where(~F.col(flag)).select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest")
    rest = rows.where(F.col(flag)).select("doc_id", "digest")
    groups = rest.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    found = join_groups(rest, groups, "digest", "group_size", rest.count())
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return alone.unionByName(found.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "digest"))


def drop_copies(docs: DataFrame, prefix: int = PREFIX_CHARS) -> DataFrame:
    """``docs`` (all columns) with one row of each group of equal texts: that of
    the largest doc_id. Rows alone by length or prefix pass without a shuffle."""
    marked, flag = surviving(docs, prefix)
    digest, keep = free_name("digest", marked), free_name("keep_id", marked)
    some = marked.where(F.col(flag)).withColumn(digest, F.sha2(normalised(F.col("text")), 256))
    keepers = some.groupBy(digest).agg(F.max("doc_id").alias(keep))
    keepers = keepers.select(F.col(digest).alias("d"), F.col(keep).alias("k")).alias("keepers")
    stay = some.join(keepers, (F.col(digest) == F.col("keepers.d")) & F.col("doc_id").eqNullSafe(F.col("keepers.k")), "left_semi")
    stay = stay.dropDuplicates([digest]).drop(digest)
    return marked.where(~F.col(flag)).unionByName(stay).drop(flag)


#: The report of ``documents`` in DuckDB SQL.
ORACLE = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
WINDOW same AS (PARTITION BY t)"""
