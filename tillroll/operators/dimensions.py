"""Product families, variants and countries as dimensions.

Surrogate keys stay as they are from load to load: a new load only adds members, numbered behind
the largest key. The numbers come from sorted partitions and their sizes, so no task sees all
members. Country names are looked up in a dictionary; for names it lacks, entries within two
edits are suggested. Two names at most two edits apart have a common rest after at most two
deletions from each, so they meet on that rest, and no name is compared with all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.rules import is_variant_sku
from ..sources.scratch import materialize
from .ordered import PART, ordered_parts

UNKNOWN = "unknown"

# ISO 3166 codes by country name as retail data spell it; names that stand for no country have none.
COUNTRIES: dict[str, str | None] = {
    "ALGERIA": "DZ", "ARGENTINA": "AR", "AUSTRALIA": "AU", "AUSTRIA": "AT", "BAHRAIN": "BH", "BELGIUM": "BE",
    "BERMUDA": "BM", "BRAZIL": "BR", "CANADA": "CA", "CHANNEL ISLANDS": "GB", "CHINA": "CN", "CYPRUS": "CY",
    "CZECH REPUBLIC": "CZ", "DENMARK": "DK", "EGYPT": "EG", "EIRE": "IE", "ETHIOPIA": "ET",
    "EUROPEAN COMMUNITY": None, "FINLAND": "FI", "FRANCE": "FR", "GERMANY": "DE", "GREECE": "GR",
    "HONG KONG": "HK", "ICELAND": "IS", "INDIA": "IN", "INDONESIA": "ID", "IRAN": "IR", "IRAQ": "IQ",
    "IRELAND": "IE", "ISRAEL": "IL", "ITALY": "IT", "JAPAN": "JP", "JORDAN": "JO", "KENYA": "KE", "KOREA": "KR",
    "LEBANON": "LB", "LITHUANIA": "LT", "MALTA": "MT", "MOROCCO": "MA", "MOZAMBIQUE": "MZ", "NETHERLANDS": "NL",
    "NIGERIA": "NG", "NORWAY": "NO", "PERU": "PE", "POLAND": "PL", "PORTUGAL": "PT", "ROMANIA": "RO", "RSA": "ZA",
    "RUSSIA": "RU", "SAUDI ARABIA": "SA", "SINGAPORE": "SG", "SPAIN": "ES", "SWEDEN": "SE", "SWITZERLAND": "CH",
    "THAILAND": "TH", "UNITED ARAB EMIRATES": "AE", "UNITED KINGDOM": "GB", "UNITED STATES": "US",
    "UNSPECIFIED": None, "USA": "US", "VIETNAM": "VN", "WEST INDIES": None,
}
EDITS = 2


def product_variants(lines: DataFrame) -> DataFrame:
    """``(stock_code, family_code, variant_code, n_lines)`` of every code: five digits and a letter are a family
    and its variant, any other code is a family of its own without variant."""
    variant = is_variant_sku()
    code = F.col("stock_code")
    return (
        lines.where(code.isNotNull())
        .groupBy("stock_code")
        .agg(F.count("*").alias("n_lines"))
        .select(
            "stock_code",
            F.when(variant, F.substring(code, 1, 5)).otherwise(code).alias("family_code"),
            F.when(variant, F.substring(code, 6, 1)).alias("variant_code"),
            "n_lines",
        )
    )


def numbered(members: DataFrame, order: list[str], key: str, begin: int = 1) -> DataFrame:
    """Distinct ``members`` with numbers from ``begin`` in their order."""
    stored = materialize(ordered_parts(members, order, []), "numbered_members")
    so_far = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    # a row per partition
    offsets = stored.groupBy(PART).agg(F.count("*").alias("n")).select(
        PART, F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("offset")
    )
    place = F.row_number().over(Window.partitionBy(PART).orderBy(*order))
    return stored.withColumn("place", place).join(F.broadcast(offsets), PART).select(
        (F.col("place") + F.col("offset") + (begin - 1)).alias(key), *members.columns
    )


def extended(dimension: DataFrame | None, members: DataFrame, natural: str, key: str, load: str) -> DataFrame:
    """``(key, natural, load)``: the dimension with the members it lacks added behind its largest key.

    ``load`` names the load on the new rows. Members may repeat; null ones are left out.
    """
    wanted = members.select(natural).where(F.col(natural).isNotNull()).distinct()
    if dimension is None:
        return numbered(wanted, [natural], key).withColumn("load", F.lit(load))
    last = dimension.agg(F.max(key)).first()[0] or 0
    fresh = numbered(wanted.join(dimension, natural, "left_anti"), [natural], key, last + 1)
    return dimension.select(key, natural, "load").unionByName(fresh.withColumn("load", F.lit(load)))


def product_dimension(variants: DataFrame, families: DataFrame) -> DataFrame:
    """The variants with their family's key."""
    return variants.join(families.select("family_key", "family_code"), "family_code").select(
        "stock_code", "family_key", "family_code", "variant_code", "n_lines"
    )


def country_table(spark: SparkSession, names: dict[str, str | None] | None = None) -> DataFrame:
    rows = list((COUNTRIES if names is None else names).items())
    return spark.createDataFrame(rows, "name string, iso_code string")


def plain_name(column: Column) -> Column:
    """Upper case, single spaces."""
    return F.trim(F.regexp_replace(F.upper(column), r"\s+", " "))


def mapped_countries(lines: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``(country, iso_code, status, n_lines)`` of every spelling in the lines: ``mapped``, ``unknown`` for
    names that stand for no country and for none at all, or ``unmatched``. The dictionary is a few
    hundred rows."""
    counts = lines.groupBy("country").agg(F.count("*").alias("n_lines"))
    known = dictionary.withColumn("listed", F.lit(True))
    joined = counts.join(F.broadcast(known), plain_name(F.col("country")) == F.col("name"), "left")
    blank = F.coalesce(plain_name(F.col("country")) == "", F.lit(True))
    status = (
        F.when(blank | (F.col("listed") & F.col("iso_code").isNull()), UNKNOWN)
        .when(F.col("listed"), "mapped")
        .otherwise("unmatched")
    )
    return joined.select("country", F.coalesce("iso_code", F.when(status == UNKNOWN, UNKNOWN)).alias("iso_code"), status.alias("status"), "n_lines")


def rests(column: Column, edits: int = EDITS) -> Column:
    """The text and what is left of it after up to ``edits`` deletions."""

    def shorter(text: Column) -> Column:
        return F.transform(
            F.when(F.length(text) > 0, F.sequence(F.lit(1), F.length(text))).otherwise(F.array().cast("array<int>")),
            lambda i: F.concat(F.substring(text, F.lit(1), i - 1), F.substring(text, i + 1, F.length(text))),
        )

    found = level = F.array(column)
    for _ in range(edits):
        level = F.array_distinct(F.flatten(F.transform(level, shorter)))
        found = F.array_union(found, level)
    return found


def country_suggestions(mapped: DataFrame, dictionary: DataFrame, edits: int = EDITS) -> DataFrame:
    """``(country, suggestion, iso_code, distance, n_lines)`` of unmatched spellings with an entry within
    ``edits``: the nearest, of equally near ones the first by name."""
    unmatched = mapped.where("status = 'unmatched'").select("country", "n_lines", plain_name(F.col("country")).alias("plain"))
    asked = unmatched.withColumn("rest", F.explode(rests(F.col("plain"), edits)))
    listed = dictionary.withColumn("rest", F.explode(rests(F.col("name"), edits)))
    near = (
        asked.join(listed, "rest")
        .withColumn("distance", F.levenshtein("plain", "name"))
        .where(F.col("distance") <= edits)
    )
    best = near.groupBy("country", "n_lines").agg(F.min(F.struct("distance", "name", "iso_code")).alias("best"))
    return best.select("country", F.col("best.name").alias("suggestion"), "best.iso_code", "best.distance", "n_lines")
