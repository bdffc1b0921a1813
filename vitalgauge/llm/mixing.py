"""Mixing sources to target weights by systematic sampling.

Each source gets a target size; each of its documents is expected as often as target / size of the
source. The expected copies are summed up along the source's documents, a random offset of the
source is added, and a document is taken once for every whole number its stretch of the sum
crosses. So the number of copies differs by less than one from what is expected, in any run of documents.

Documents lie in the order of their size class, then by a hash of the id: a sample
taken at even steps along it has the source's mix of short and long documents, so the words taken
come near the target. The sum is made of three levels (size class, slice of the hash, document), of which the
first two are combined before the shuffle; so no task ever holds a whole source. Sums are
exact decimals and the offset comes from a seed, so reruns agree however the work is split.

Everything is DataFrame operations. Defined cases: a null or empty text has size 0, so it adds no words however
often it is taken; of a source of size 0 nothing is taken; a null source is a source of its own, last in order; repeated
rows count as rows of their own, and which of two equal rows is taken more often shows in no result; a null id
hashes as empty text; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vitalgauge.llm.common import WORD, free_name, numbered
from vitalgauge.sources.shared import share

#: Expected copies are whole multiples of 1 / UNIT.
UNIT = 10**12
MOST_COPIES = 3
WEIGHTS = (1, 2, 3)
SEED = "mix"
#: Hex digits of the id's hash that tell a document's slice: 16 ** 3 slices in each size class of a source.
SLICE_DIGITS = 3


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def size_class(size: Column) -> Column:
    """Number of binary digits and the five leading ones, so that sizes in one class differ by 1/16 at most."""
    digits = F.length(F.bin(size))
    return (digits * 32 + F.expr("shiftright(size, greatest(length(bin(size)) - 5, 0))")).cast("long")


def source_targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """``source``, ``source_size`` and ``target`` from rows of ``source`` and ``size``.

    Sources in code point order, null last, weigh ``weights`` in turn and share the total size. No
    target exceeds ``most`` times its source's size; what is over goes to the others by weight, until
    none is above. That ends at one level: each target is the smaller of its bound and level x weight. In
    the order of bound / weight, the bounded sources come first, and the level follows from running sums. Here
    one row stands for each source.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(order) - 1) % len(weights)
    weighted = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), place + 1).cast("double"))
    bound = (F.col("source_size") * most).cast("double")
    everything = Window.partitionBy()
    by_ratio = Window.orderBy(bound / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything).cast("double") - F.coalesce(F.sum(bound).over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    levels = weighted.select(
        "source", "source_size", "weight", bound.alias("bound"), (left / weight_left).alias("level"),
        F.row_number().over(by_ratio).alias("place"),
    )
    # the first source that stays below its bound tells the level, for itself and all after it
    stays = F.when(F.col("level") * F.col("weight") < F.col("bound"), F.struct("place", "level"))
    open_level = F.min(stays).over(everything)["level"]
    target = F.coalesce(F.least(F.col("bound"), open_level * F.col("weight")), F.col("bound"))
    return levels.select("source", "source_size", target.alias("target"))


def expected_copies() -> Column:
    """Expected copies of each document of a source, in units, as a whole decimal."""
    rate = F.col("target") / F.col("source_size") * UNIT
    return F.when(F.col("source_size") > 0, F.floor(rate)).otherwise(0).cast("decimal(38,0)")


def seed_offset(source: Column, seed: str = SEED) -> Column:
    """A random offset below one copy, in units, that depends on the seed and the source alone."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(source, F.lit("\x00"))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("decimal(38,0)") % UNIT).cast("decimal(38,0)")


def mixed_copies(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST_COPIES,
    seed: str = SEED,
    row_column: str | None = None,
) -> DataFrame:
    """Per document: ``doc_id``, ``row``, ``source``, ``size``, ``source_size``, ``target`` and ``copies``.

    ``row`` is the document's value of ``row_column``, which must be unique and stable, or a number given here.
    """
    size = word_count(F.col("text"))
    hashed = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    sized = docs.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        size.alias("size"),
        *([F.col(row_column).alias("row")] if row_column else []),
    )
    rows = share(sized, "sizes") if row_column else numbered(sized, "sizes")[0]  # texts are read once
    rows = rows.withColumn("size_class", size_class(F.col("size"))).withColumn("hash", hashed)
    rows = rows.withColumn("slice", F.substring("hash", 1, SLICE_DIGITS))
    targets = share(source_targets(rows, weights, most), "targets")

    slices = rows.groupBy("source", "size_class", "slice").agg(F.count("*").alias("n"))
    classes = slices.groupBy("source", "size_class").agg(F.sum("n").alias("class_n"))
    earlier = Window.partitionBy("source").orderBy("size_class").rowsBetween(Window.unboundedPreceding, -1)
    classes = classes.withColumn("class_start", F.coalesce(F.sum("class_n").over(earlier), F.lit(0))).drop("class_n")
    within = Window.partitionBy("source", "size_class").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("slice_start", F.coalesce(F.sum("n").over(within), F.lit(0))).drop("n")
    starts = _join_on(slices, classes, ["source", "size_class"]).select(
        "source", "size_class", "slice", (F.col("class_start") + F.col("slice_start")).alias("start")
    )

    in_slice = Window.partitionBy("source", "size_class", "slice").orderBy("hash", "doc_id", "row")
    ranked = rows.withColumn("rank", F.row_number().over(in_slice))
    placed = _join_on(ranked, starts, ["source", "size_class", "slice"]).select(
        "doc_id", "row", "source", "size", (F.col("start") + F.col("rank")).alias("place")
    )
    known = targets.withColumn("copy_units", expected_copies()).withColumn("offset", seed_offset(F.col("source"), seed))
    expected = _join_on(placed, known, ["source"]).withColumn(
        "upto", F.col("place").cast("decimal(19,0)") * F.col("copy_units") + F.col("offset")
    )
    copies = F.expr(f"upto div {UNIT} - (upto - copy_units) div {UNIT}")
    return expected.select("doc_id", "row", "source", "size", "source_size", "target", copies.cast("long").alias("copies"))


def _join_on(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on keys of which null equals null."""
    renamed = right.withColumnsRenamed({k: f"right_{k}" for k in keys})
    match = [left[k].eqNullSafe(renamed[f"right_{k}"]) for k in keys]
    return left.join(renamed, match).drop(*(f"right_{k}" for k in keys))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix with all their columns, each as often as it is taken."""
    rows, row = numbered(docs, "mixing")
    taken = mixed_copies(rows, row_column=row, **options).filter("copies > 0")
    copies = free_name(rows, "copies")
    taken = taken.select(F.col("row").alias(row), F.col("copies").cast("int").alias(copies))
    repeated = rows.join(taken, row).withColumn(free_name(rows, "copy"), F.explode(F.array_repeat(F.lit(0), F.col(copies))))
    return repeated.select(*docs.columns)
