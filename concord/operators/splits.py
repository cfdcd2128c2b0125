"""Frozen splits and samples by hash rank."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def digest(salt: str, c: Column) -> Column:
    """SHA-256 hex of salt, a bar and the value."""
    return F.sha2(F.concat(F.lit(salt), F.lit("|"), c.cast("string")), 256)


def hash_split(domain: DataFrame, key: str, salt: str, holdout: int, validation: int) -> DataFrame:
    """key, digest, split: ordered by digest, the first go to holdout, the next to validation, the rest to development.

    The domain (tiles) is a small table that names the units of a split; the
    rank runs over it alone.  More units wanted than there are raises.
    """
    rows = domain.select(key).filter(F.col(key).isNotNull()).distinct().withColumn("digest", digest(salt, F.col(key)))
    n = F.row_number().over(Window.orderBy("digest", key))
    enough = F.count(F.lit(1)).over(Window.partitionBy()) >= holdout + validation
    n = F.when(enough, n).otherwise(F.raise_error(F.lit(f"fewer than {holdout + validation} units to split")).cast("int"))
    split = F.when(n <= holdout, "holdout").when(n <= holdout + validation, "validation").otherwise("development")
    return rows.withColumn("split", split)


def split_digest(splits: DataFrame, key: str) -> DataFrame:
    """One row: SHA-256 over the sorted lines key=split."""
    line = F.concat(F.col(key), F.lit("="), F.col("split"))
    return splits.agg(F.sha2(F.array_join(F.array_sort(F.collect_list(line)), "\n"), 256).alias("split_digest"))


#: Samples up to this size are gathered in order; larger ones are taken by a threshold.
FEW = 10_000


def ranked_sample(df: DataFrame, ordinal: str, n: int, seed: str, few: int = FEW) -> DataFrame:
    """The n rows of the least SHA-256 (sample_hash) of seed and ordinal, ties by the ordinal; the same on every run.

    A large sample is never sorted: counts of the hashes' first four hex digits
    show in which of 65,536 bins the n-th hash lies, counts of the next four
    digits in that bin narrow it down further, and a filter takes all rows
    before it.  Of the rows in the last bin, a few unless ordinals repeat, those
    that are missing are taken in order.  Null ordinals are never sampled.
    """
    h = F.sha2(F.concat(F.lit(seed), F.lit("|"), F.col(ordinal).cast("string")), 256)
    rows = df.withColumn("sample_hash", h)
    if n <= few:
        return rows.filter(F.col("sample_hash").isNotNull()).orderBy("sample_hash", ordinal).limit(n)
    prefix, missing = "", n
    while missing > few or not prefix:
        bins = rows.filter(F.col("sample_hash").startswith(prefix)).groupBy(F.substring("sample_hash", len(prefix) + 1, 4).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
        counts = sorted(map(tuple, bins.filter("bin is not null").collect()))  # 65,536 at most
        before = 0
        for at, size in counts:
            if before + size >= missing:
                break
            before += size
        else:  # there are no more rows than that
            return rows.filter(F.col("sample_hash").isNotNull())
        prefix, missing = prefix + at, missing - before
        if size <= few or len(prefix) == 64:
            break
    edge = rows.filter(F.col("sample_hash").startswith(prefix)).orderBy("sample_hash", ordinal).limit(missing)
    return rows.filter(F.col("sample_hash") < prefix).unionByName(edge)


def sample_digest(sample: DataFrame, ordinal: str) -> DataFrame:
    """One row: SHA-256 over the sample's sorted ordinals."""
    return sample.agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.col(ordinal).cast("long"))), lambda x: x.cast("string")), "\n"), 256).alias("sample_digest"))


def modulus_sample(df: DataFrame, ordinal: str, modulus: int, rest: int) -> DataFrame:
    """Rows whose persisted ordinal leaves `rest` modulo `modulus`."""
    return df.filter(F.pmod(F.col(ordinal), F.lit(modulus)) == rest)
