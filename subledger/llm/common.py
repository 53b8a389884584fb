"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.session import scratch_path

#: Runs of bytes that are no word: everything ASCII outside 0-9 and a-z (after
#: lower-casing A-Z); every non-ASCII character belongs to a word.
NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: bytes.translate table with the same meaning: words lower-cased, the rest blank.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared scratch folder and read it
    back: the lineage ends there, a lost executor re-reads the files."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, every other character unchanged: ``lower`` would also fold
    letters outside ASCII, so it serves texts of ASCII only."""
    only_ascii = F.octet_length(text) == F.char_length(text)
    return F.when(only_ascii, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def word_array(text: Column) -> Column:
    """Words of a text in order; a null or wordless text has none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NON_WORD), "")


def held_out(doc_id: Column) -> Column:
    """The fold that no label is learnt from: crc32 of the id as text, mod 4, is 2.
    A null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def smallest_hashes(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """At most ``n`` rows: those of the smallest hashes of ``keys``, the same in
    every run. The rows are counted first and all but some 2 n of them left out
    by hash, so that the final ranking gets few rows however many there are."""
    span = 1 << 30
    mixed = F.pmod(F.xxhash64(*keys), F.lit(span))
    share = min(1.0, 2.0 * n / max(1, df.count()))
    return df.where(mixed < int(span * share) + 1).orderBy(mixed, *keys).limit(n)


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """At most ``per_class`` distinct labelled texts of each class outside the
    held-out fold, as (text, y), chosen by hash of the text, so that neither an id
    of many rows nor a text of many copies fills the sample. Rows without id, text
    or a 0/1 label are passed over; an id labelled more than once counts with its
    largest label, a text of both classes once in each."""
    one = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("y"))
    )
    texts = documents.where(F.col("text").isNotNull()).select("doc_id", "text", F.xxhash64("text").alias("h"))
    # Only ids and hashes are shuffled here.
    marked = texts.where(~held_out(F.col("doc_id"))).select("doc_id", "h").join(one, "doc_id").select("h", "y").distinct()
    known = cut(marked, "labelled-texts")
    picked = smallest_hashes(known.where("y = 0"), ["h"], per_class).unionByName(smallest_hashes(known.where("y = 1"), ["h"], per_class))
    # At most 2 * per_class rows: the bound is the parameter, so this side may be broadcast.
    return texts.select("text", "h").join(F.broadcast(picked), "h").groupBy("h", "y").agg(F.first("text").alias("text")).select("text", "y")
