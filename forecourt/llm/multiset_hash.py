"""Document fingerprints: a homomorphic hash of the multiset of paragraphs.

A paragraph (a line that is not empty) is hashed to a wide vector: one of 768 lanes gets two 32-bit values, and a lane
of its own counts it; all others are 0. A document's fingerprint is the sum of its paragraphs' vectors, each
component modulo 2^32. Sums do not depend on order, and a paragraph is put in or taken out by adding or subtracting
its vector. Lanes that are 0 are left out, which keeps small documents small.

Lanes come in 24 levels of 32; a level gets half as many paragraphs as the one before. The lanes in which two
fingerprints differ therefore show how many paragraphs differ, few or many: levels are read from the sparsest
on until one is crowded, which the sparsest is beyond some 300 million. Likeness is 1 - differing paragraphs /
paragraphs of both.

Defined results: a null text is empty; the empty fingerprint is like itself (1) and unlike any other (0). For neighbours in
order of id, repeated rows are one document written twice: each gets a row, and the next document is the next
different one; rows with one id and different texts are ordered by hash; rows without an id come first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt.llm.common import documents, written
from forecourt.llm.spans import let

LEVELS, WIDTH = 24, 32
COUNT_LANE = LEVELS * WIDTH
CROWDED = WIDTH * 3 // 4
MODULUS = 1 << 32
VECTOR = "array<struct<lane: int, a: bigint, b: bigint>>"


def _item(paragraph: Column) -> Column:
    place, value = F.xxhash64(paragraph), F.xxhash64(F.lit(1), paragraph)
    # The zeros at the end of the place, at most LEVELS - 1.
    bits = place.bitwiseAND(F.lit((1 << (LEVELS - 1)) - 1)).bitwiseOR(F.lit(1 << (LEVELS - 1)))
    level = F.bit_count(F.bitwise_not(bits).bitwiseAND(bits - 1)).cast("int")
    lane = level * WIDTH + F.shiftright(place, 32).bitwiseAND(F.lit(WIDTH - 1)).cast("int")
    low = F.lit(MODULUS - 1)
    return F.struct(lane.alias("lane"), value.bitwiseAND(low).alias("a"), F.shiftrightunsigned(value, 32).alias("b"))


def _summed(items: Column) -> Column:
    """One entry per lane with the sums modulo 2^32, by lane, without lanes that are 0."""

    def total(own: Column, part: str) -> Column:
        return F.aggregate(own, F.lit(0).cast("bigint"), lambda s, x: (s + x[part]).bitwiseAND(F.lit(MODULUS - 1)))

    def lane(all_items: Column, number: Column) -> Column:
        own = F.filter(all_items, lambda x: x["lane"] == number)
        return let(own, lambda o: F.struct(number.alias("lane"), total(o, "a").alias("a"), total(o, "b").alias("b")))

    def vector(all_items: Column) -> Column:
        numbers = F.array_sort(F.array_distinct(F.transform(all_items, lambda x: x["lane"])))
        lanes = F.transform(numbers, lambda number: lane(all_items, number))
        return F.filter(lanes, lambda x: (x["a"] != 0) | (x["b"] != 0))

    return let(items, vector)


def fingerprint(text: Column) -> Column:
    """The vector of a text: an array of lanes in order, those of value 0 left out."""
    paragraphs = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda p: p != "")

    def vector(own: Column) -> Column:
        lanes = _summed(F.transform(own, _item))
        n = F.size(own).cast("bigint").bitwiseAND(F.lit(MODULUS - 1))
        count = F.struct(F.lit(COUNT_LANE).alias("lane"), n.alias("a"), F.lit(0).cast("bigint").alias("b"))
        return F.when(F.size(own) > 0, F.concat(lanes, F.array(count))).otherwise(F.array())

    return let(paragraphs, vector).cast(VECTOR)


def added(one: Column, other: Column) -> Column:
    """The fingerprint of the paragraphs of both."""
    return _summed(F.concat(one, other)).cast(VECTOR)


def removed(whole: Column, part: Column) -> Column:
    """The fingerprint left when the paragraphs of ``part`` are taken out."""

    def minus(x: Column) -> Column:
        low = F.lit(MODULUS - 1)
        return F.struct(x["lane"].alias("lane"), (MODULUS - x["a"]).bitwiseAND(low).alias("a"), (MODULUS - x["b"]).bitwiseAND(low).alias("b"))

    return added(whole, F.transform(part, minus))


def as_text(vector: Column) -> Column:
    """Lanes one after the other: three, eight and eight hexadecimal digits each."""

    def digits(value: Column, n: int) -> Column:
        return F.lpad(F.lower(F.hex(value)), n, "0")

    return F.array_join(F.transform(vector, lambda x: F.concat(digits(x["lane"], 3), digits(x["a"], 8), digits(x["b"], 8))), "")


def likeness(one: Column, other: Column) -> Column:
    """Estimated share of paragraphs, of both documents together, that they have in common: 1 for equal ones."""
    lanes = F.array_distinct(
        F.transform(F.concat(F.array_except(one, other), F.array_except(other, one)), lambda x: x["lane"])
    )
    # The count lane is the last entry of a vector that is not empty.
    counts = sum((F.coalesce(F.get(v, F.size(v) - 1)["a"], F.lit(0).cast("bigint")) for v in (one, other)), F.lit(0).cast("bigint"))

    def differing(changed: Column) -> Column:
        def step(acc: Column, level: Column) -> Column:
            n = F.size(F.filter(changed, lambda x: (F.floor(x / WIDTH) == level)))
            full = n > CROWDED
            # Of m paragraphs in 32 lanes, 32 * (1 - exp(-m / 32)) lanes are hit.
            more = acc["total"] + F.when(n <= 1, n.cast("double")).otherwise(-WIDTH * F.log(1 - F.least(n, F.lit(WIDTH - 1)) / WIDTH))
            first = level == LEVELS - 1
            return F.struct(
                F.when(acc["done"] | (full & ~first), acc["total"]).otherwise(more).alias("total"),
                F.when(acc["done"], acc["scale"]).when(full, F.pow(F.lit(2.0), F.when(first, level).otherwise(level + 1).cast("double"))).otherwise(F.lit(1.0)).alias("scale"),
                (acc["done"] | full).alias("done"),
            )

        zero = F.struct(F.lit(0.0).alias("total"), F.lit(1.0).alias("scale"), F.lit(False).alias("done"))
        return F.aggregate(F.sequence(F.lit(LEVELS - 1), F.lit(0), F.lit(-1)), zero, step, lambda acc: acc["total"] * acc["scale"])

    near = let(lanes, lambda changed: F.when(F.size(changed) == 0, F.lit(1.0)).otherwise(
        F.greatest(F.lit(0.0), 1 - differing(F.filter(changed, lambda x: x < COUNT_LANE)) / counts)
    ))
    return F.when(counts == 0, F.lit(1.0)).otherwise(near)


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's text and fingerprint (``vector``), with the next document's id, fingerprint and opening.

    The order is found on ids, hashes and lengths alone: sorted by range, then within ranges, then from one range to the
    next by a row per range. Texts are shuffled once by their own hash, and openings, half a document's length of its
    successor, once to the document that needs them.
    """
    value = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    identity = (F.col(f"`{id_col}`").isNull(), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")), value)
    texts = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        value.alias("text"),
        fingerprint(F.col(f"`{text_col}`")).alias("vector"),
        F.xxhash64(*identity).alias("a"),
        F.xxhash64(F.lit(1), *identity).alias("b"),
    )
    order = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.xxhash64(*identity).alias("a"),
        F.xxhash64(F.lit(1), *identity).alias("b"),
        F.floor(F.length(value) / 2).cast("int").alias("half"),
    ).dropDuplicates(["a", "b"])
    # Written, because ranges are cut by a sample: both uses below must see the same ones.
    ranged = written(order.repartitionByRange("doc_id", "a", "b").withColumn("range", F.spark_partition_id()), "order")
    place = F.struct("doc_id", "a", "b")
    inner = ranged.withColumn("next", F.lead(place).over(Window.partitionBy("range").orderBy("doc_id", "a", "b")))
    heads = ranged.groupBy("range").agg(F.min(place).alias("head"))  # a row per range
    around = Window.orderBy("range")
    opening = F.first("head").over(around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    following = heads.select("range", F.coalesce(F.lead("head").over(around), opening).alias("following"))
    links = inner.join(F.broadcast(following), "range").select(
        "a", "b", "half", F.coalesce("next", "following").alias("next")
    )

    # A lag rather than a rank: Spark would limit ranks before the shuffle, and the one shuffle of texts that
    # givers and takers share would become two.
    before = F.lag(F.lit(True)).over(Window.partitionBy("a", "b").orderBy("a", "b"))
    givers = texts.withColumn("before", before).filter("before IS NULL").drop("before")
    takers = links.select(F.col("a").alias("to_a"), F.col("b").alias("to_b"), "half", F.col("next.a").alias("a"), F.col("next.b").alias("b"))
    gifts = givers.join(takers, ["a", "b"]).select(
        F.col("to_a").alias("a"),
        F.col("to_b").alias("b"),
        F.col("doc_id").alias("next_doc_id"),
        F.col("vector").alias("next_vector"),
        F.expr("left(text, half)").alias("opening"),
    )
    return texts.join(gifts, ["a", "b"]).drop("a", "b")


def q_fingerprints(spark, sf_dir):
    """Fingerprints of every document and of its edited text, and how alike they are."""
    edited = with_next(documents(spark, sf_dir)).select(
        "doc_id",
        "next_doc_id",
        F.length("text").cast("long").alias("n_chars"),
        "vector",
        "next_vector",
        F.concat(F.expr("left(text, length(text) - cast(floor(length(text) / 2) as int))"), "opening").alias("edited"),
    )
    return edited.withColumn("edited_vector", fingerprint(F.col("edited"))).select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("vector")).alias("fingerprint"),
        as_text(F.col("edited_vector")).alias("edited_fingerprint"),
        likeness(F.col("vector"), F.col("edited_vector")).alias("near_edited"),
        likeness(F.col("vector"), F.col("next_vector")).alias("near_next"),
        "next_doc_id",
    )
