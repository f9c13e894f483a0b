"""Exact deduplication by two passes over a Bloom filter, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybuy.llm.common import text_of
from tallybuy.operators.joins import lookup
from tallybuy.session import write_out

#: Deleted before texts are compared.
BLANKS = r"[\x20\x09-\x0D]+"

#: One bitmap row holds so many bits (4 KB), as bitmap_construct_agg makes them.
_BITS_PER_ROW = 32768


def _cells(bits: int) -> Column:
    """The two filter cells of a digest, counted from 1."""
    return F.array(
        F.pmod(F.xxhash64("digest"), F.lit(bits)) + 1,
        F.pmod(F.xxhash64("digest", F.lit(1)), F.lit(bits)) + 1,
    )


def _repeat_filter(digests: DataFrame, bits: int) -> DataFrame:
    """First pass: bitmaps of the cells that at least two rows fall on."""
    hit = digests.select(F.explode(_cells(bits)).alias("cell")).groupBy("cell").count()
    return (
        hit.where("count > 1")
        .groupBy(F.expr("bitmap_bucket_number(cell)").alias("bucket"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(cell))").alias("bitmap"))
    )


def _is_set(bitmap: Column, cell: Column) -> Column:
    bit = F.bitmap_bit_position(cell)
    byte = F.conv(F.hex(F.substring(bitmap, (bit / 8).cast("int") + 1, F.lit(1))), 16, 10)
    mask = F.expr("shiftleft(1, cast(_bit % 8 as int))")
    return F.coalesce(byte.cast("int").bitwiseAND(mask) != 0, F.lit(False))


def _marked(digests: DataFrame, filters: DataFrame, bits: int) -> DataFrame:
    """Second pass: ``maybe`` says whether both cells of a row are set."""
    rows = digests.withColumn("_cells", _cells(bits))
    for k in (0, 1):
        cell = F.col("_cells")[k]
        bitmaps = F.broadcast(filters.select(F.col("bucket").alias("_bucket"), "bitmap"))
        rows = (
            rows.withColumn("_cell", cell)
            .withColumn("_bucket", F.bitmap_bucket_number("_cell"))
            .withColumn("_bit", F.bitmap_bit_position("_cell"))
            .join(bitmaps, "_bucket", "left")
            .withColumn(f"_set{k}", _is_set(F.col("bitmap"), F.col("_cell")))
            .drop("bitmap", "_bucket", "_bit", "_cell")
        )
    return rows.withColumn("maybe", F.col("_set0") & F.col("_set1")).drop("_cells", "_set0", "_set1")


def exact_dedup(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    bits_per_row: int = 16,
    most_bits: int = 1 << 29,
) -> DataFrame:
    """Group the texts that are equal without blanks; one row for each row of ``docs``.

    Columns: ``doc_id, keep_id, group_size, kept, text_sha256``. Of a group, the
    row with the most code points in its original text stays, then the one with
    the smallest id (null ids come last), then the first row.

    A narrow table of digests is written once. The first pass counts the rows
    that fall on each cell of a Bloom filter with two hashes and keeps the cells
    hit twice as bitmaps. The second pass probes these bitmaps: a row whose two
    cells aren't both set has no equal and passes straight through; only the
    others shuffle, for an exact grouping by SHA-256. The bitmaps are broadcast;
    ``most_bits / 8`` bytes bound their size. Past ``most_bits / bits_per_row``
    rows more unique rows go through the exact grouping, the result is the same.

    Null text counts as empty, and all empty texts are one group. Repeated rows
    are members like any others, and one of them is kept. An empty table gives no
    rows. Other columns of ``docs`` are not read.
    """
    digests = write_out(
        docs.select(
            F.col(id_column).cast("bigint").alias("doc_id"), text_of(text_column).alias("text")
        ).select(
            "doc_id",
            F.length("text").alias("points"),
            F.unhex(F.sha2(F.regexp_replace("text", BLANKS, ""), 256)).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    )
    rows = digests.count()
    bits = min(most_bits, max(_BITS_PER_ROW, 1 << (bits_per_row * max(rows, 1) - 1).bit_length()))
    filters = _repeat_filter(digests, bits)
    marked = write_out(_marked(digests, filters, bits), "marked")
    maybe = marked.where("maybe").drop("maybe")
    order = F.struct(-F.col("points"), F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))
    groups = (
        maybe.groupBy("digest")
        .agg(F.min(order).alias("first"), F.count("*").alias("group_size"))
        .select(
            "digest", "group_size", F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("keep_row")
        )
    )
    grouped = lookup(maybe, groups, ["digest"], "inner")
    alone = marked.where(~F.col("maybe")).select(
        *digests.columns, F.lit(1).cast("bigint").alias("group_size"), F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row")
    )
    return grouped.select(alone.columns).unionByName(alone).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
