"""What several operators share: tables, written intermediate results, column hygiene, edges to components."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the one the cluster names in ``spark.checkpoint.dir``.

    Without that setting, as in tests, it lies in the warehouse, which executors share as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/llm/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read again: lineage ends there, whatever executor is lost."""
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(f"`{text}`"), F.lit(""))


def text_key(text: str = "text") -> Column:
    """128 bits that stand for a text: two hashes of different inputs, as a struct of longs."""
    value = text_or_empty(text)
    return F.struct(F.xxhash64(value).alias("a"), F.xxhash64(F.lit(1), value).alias("b"))


def free_name(columns: Iterable[str], wish: str) -> str:
    """``wish``, or with underscores before it until no column is called so (names ignore case)."""
    taken = {c.lower() for c in columns}
    while wish.lower() in taken:
        wish = f"_{wish}"
    return wish


def drop_names(df: DataFrame, *names: str) -> DataFrame:
    """Without columns that an operator is about to add, whatever their case."""
    doomed = {n.lower() for n in names}
    return df.select(*(F.col(f"`{c}`") for c in df.columns if c.lower() not in doomed))


def broadcast_if_few(df: DataFrame, most_rows: int = 20_000) -> DataFrame:
    """``df`` marked for broadcasting if it has at most so many (narrow) rows; otherwise as it is, to be shuffled."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df


_held: dict[str, Callable[[], None]] = {}


def hold(owner: str, release: Callable[[], None]) -> None:
    """What ``owner`` remembers in this Python worker stays until another owner begins there.

    Workers outlive the stages of a job; without this they would keep every earlier stage's caches.
    """
    others = [_held.pop(name) for name in list(_held) if name != owner]
    for release_other in others:
        release_other()
    _held[owner] = release
    if others:
        gc.collect()


BITMAP_BITS = 1 << 20


def bitmap_test(hashes: DataFrame, hash_col: str) -> Column | None:
    """An array of a fixed number of bits, as a constant, with the bit of every hash set; None if there is no row.

    ``in_bitmap`` is then true for each of these hashes and for few others, whatever the number of rows was.
    """
    bit = F.pmod(F.col(hash_col), F.lit(BITMAP_BITS))
    words = hashes.groupBy(F.floor(bit / 64).cast("int").alias("at")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (bit % 64).cast("int"))).alias("bits")
    )
    rows = words.collect()  # at most BITMAP_BITS / 64 rows
    if not rows:
        return None
    bits = [0] * (BITMAP_BITS // 64)
    for at, value in rows:
        bits[at] = value
    return F.from_json(F.lit(str(bits)), "array<bigint>")


def in_bitmap(bitmap: Column, hashed: Column) -> Column:
    bit = F.pmod(hashed, F.lit(BITMAP_BITS))
    own = F.get(bitmap, F.floor(bit / 64).cast("int"))
    return F.call_function("shiftrightunsigned", own, (bit % 64).cast("int")).bitwiseAND(F.lit(1).cast("bigint")) == 1
