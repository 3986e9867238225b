"""Mending of raw lines: descriptions looked up by code, repeated lines removed with a ledger,
flags and kinds of lines that stay.

Every step adds columns that say what it did; none drops a line without naming it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.exact import count_where
from ..functions.rules import is_cancelled, is_non_product, is_stock_movement
from ..sources.schemas import RAW

#: Rules for ``deduplicated``: keep one of every repeated line, or one only of those with a quantity of at most one.
KEEP_ONE, KEEP_PLAUSIBLE = "one", "plausible"


def best_descriptions(raw: DataFrame) -> DataFrame:
    """``(stock_code, best, n_best)``: each code's most frequent description; of equally frequent ones the
    smallest in byte order."""
    counts = (
        raw.where(F.col("stock_code").isNotNull() & F.col("description").isNotNull())
        .groupBy("stock_code", "description")
        .agg(F.count("*").alias("n"))
    )
    first = F.min(F.struct((-F.col("n")).alias("minus"), "description"))
    return counts.groupBy("stock_code").agg(first.alias("first")).select(
        "stock_code", F.col("first.description").alias("best"), (-F.col("first.minus")).alias("n_best")
    )


def repaired(raw: DataFrame) -> DataFrame:
    """The raw lines with missing descriptions filled in, and ``description_source``: ``given``,
    ``code`` for a looked-up one, ``none`` where no line of the code has one.

    Only lines without description are joined, so a code with very many described lines costs nothing.
    """
    bare = raw.where(F.col("description").isNull()).drop("description")
    found = bare.join(best_descriptions(raw).drop("n_best"), "stock_code", "left").select(
        *(F.col("best").alias("description") if c == "description" else F.col(c) for c in RAW.names),
        F.when(F.col("best").isNull(), "none").otherwise("code").alias("description_source"),
    )
    given = raw.where(F.col("description").isNotNull()).select(*RAW.names, F.lit("given").alias("description_source"))
    return given.unionByName(found)


def repair_counts(mended: DataFrame) -> DataFrame:
    """Lines and codes by where their description comes from."""
    by = mended.groupBy("description_source", "stock_code").agg(F.count("*").alias("n"))
    return by.groupBy("description_source").agg(F.sum("n").alias("n_lines"), F.count("stock_code").alias("n_codes"))


def line_copies(raw: DataFrame) -> DataFrame:
    """Every different raw line once, with the number of its ``copies``. Lines are the same if all columns are, nulls
    included; copies are summed before they are shuffled."""
    return raw.groupBy(*RAW.names).agg(F.count("*").alias("copies"))


def _kept(keep: str) -> Column:
    if keep == KEEP_ONE:
        return F.lit(1).cast("long")
    if keep == KEEP_PLAUSIBLE:
        # two equal lines of several pieces each may both be real
        return F.when(F.col("quantity") > 1, F.col("copies")).otherwise(F.lit(1)).cast("long")
    raise ValueError(f"keep must be {KEEP_ONE!r} or {KEEP_PLAUSIBLE!r}")


def deduplicated(raw: DataFrame, keep: str = KEEP_ONE) -> DataFrame:
    """The lines that stay."""
    kept = line_copies(raw).withColumn("kept", _kept(keep))
    return kept.select(*RAW.names, F.explode(F.sequence(F.lit(1).cast("long"), "kept"))).select(*RAW.names)


def removal_ledger(raw: DataFrame, keep: str = KEEP_ONE) -> DataFrame:
    """One row per repeated line: its columns, copies found, kept and removed."""
    counts = line_copies(raw).where("copies > 1").withColumn("n_kept", _kept(keep))
    return counts.select(*RAW.names, "copies", "n_kept", (F.col("copies") - F.col("n_kept")).alias("n_removed"))


# Subtypes of the lines that are no product sales, by code; the first rule that holds counts.
SUBTYPES: tuple[tuple[str, str, tuple[str, ...]], ...] = (
    ("postage", "code", ("POST", "DOT", "C2")),
    ("fee", "code", ("BANK CHARGES", "AMAZONFEE", "CRUK")),
    ("adjustment", "code", ("M", "ADJUST", "D", "S")),
    ("gift_card", "prefix", ("gift_",)),
    ("test", "prefix", ("TEST",)),
)
OTHER = "other"


def subtype(rules: tuple[tuple[str, str, tuple[str, ...]], ...] = SUBTYPES) -> Column:
    """The subtype of a stock code: ordered rules as one expression."""
    code, chain = F.col("stock_code"), F
    for name, kind, values in rules:
        if kind == "code":
            test = code.isin(*values)
        elif kind == "prefix":
            test = F.lit(False)
            for value in values:
                test = test | code.startswith(value)
        else:
            raise ValueError(f"a rule compares a code or a prefix, not {kind!r}")
        chain = chain.when(test, name)
    return chain.otherwise(OTHER)


def non_product_subtypes(lines: DataFrame) -> DataFrame:
    """Lines, codes and units by subtype of the ``non_product_lines`` bucket."""
    by = lines.withColumn("subtype", subtype()).groupBy("subtype", "stock_code").agg(
        F.count("*").alias("n"), F.sum(F.col("quantity").cast("long")).alias("units")
    )
    return by.groupBy("subtype").agg(
        F.sum("n").alias("n_lines"), F.count("stock_code").alias("n_codes"), F.sum("units").alias("units")
    )


def line_flags() -> dict[str, Column]:
    """Marks of lines that are kept: no customer, a negative quantity of neither a cancellation nor a stock
    movement, a price of nothing or less; and what such a free line is: ``note`` of the staff (written in small
    letters or not at all) or ``product``."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    moved = yes(is_stock_movement())
    free = yes(F.col("price") <= 0) & ~moved
    text = F.col("description")
    note = text.isNull() | (text == F.lower(text))
    return {
        "is_anonymous": F.col("customer_id").isNull() & ~moved,
        "is_adjustment": yes(F.col("quantity") < 0) & ~yes(is_cancelled()) & ~moved,
        "is_freebie": free,
        "freebie_kind": F.when(free & note, "note").when(free, "product"),
        "is_non_product": yes(is_non_product()),
    }


def flagged(raw: DataFrame) -> DataFrame:
    """The raw lines with their marks."""
    return raw.select(*RAW.names, *(c.alias(name) for name, c in line_flags().items()))


def flag_counts(raw: DataFrame) -> DataFrame:
    """Lines by combination of marks, and their amount in thousandths."""
    amount = (F.col("quantity") * F.col("price")).cast("decimal(24,3)")
    marks = list(line_flags())
    return flagged(raw).groupBy(*marks).agg(
        F.count("*").alias("n_lines"), count_where(F.col("quantity") > 0).alias("n_positive"),
        F.sum(amount).cast("decimal(24,3)").alias("amount"),
    )
