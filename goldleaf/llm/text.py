"""Column expressions shared by the native text operators.

A word is a maximal run of characters other than space and the controls 9 to 13. Only A-Z are
lower-cased, so every engine agrees on the result whatever its Unicode tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE_CLASS = "[\\x20\\x09-\\x0D]"
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def words(c: Column) -> Column:
    """Array of the words of a text; empty for NULL."""
    trimmed = F.btrim(F.coalesce(c, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS + "+"))


def shingle_hashes(w: Column, k: int) -> Column:
    """Hashes of the k-word shingles of a word array, in order; fewer words give one hash of them all, none give []."""
    some = F.transform(F.sequence(F.lit(0), F.size(w) - k), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)]))
    return (F.when(F.size(w) >= k, some)
            .when(F.size(w) > 0, F.array(F.xxhash64(F.array_join(w, " "))))
            .otherwise(F.array().cast("array<bigint>")))


#: Elements that one fold may gather; folds copy what they have gathered at every step.
BLOCK = 256


def let(value: Column, body) -> Column:
    """body(value), the value computed once."""
    return F.transform(F.array(value), body)[0]


def blocks(items: Column) -> Column:
    """An array cut into arrays of at most BLOCK items; an empty one gives none."""
    return let(items, lambda a: F.when(F.size(a) > 0, F.transform(
        F.sequence(F.lit(0), F.floor((F.size(a) - 1) / BLOCK).cast("int")), lambda b: F.slice(a, b * BLOCK + 1, BLOCK))).otherwise(F.slice(F.array(a), 1, 0)))


def running(values: Column, op) -> Column:
    """Folds of a whole-number array's beginnings under an associative op: [v0, op(v0, v1), ...]. Done within blocks, then over their totals."""
    none = F.array().cast("array<int>")

    def fold(items: Column) -> Column:
        return F.aggregate(items, none, lambda acc, x: F.concat(acc, F.array(F.when(F.size(acc) == 0, x).otherwise(op(F.element_at(acc, -1), x)))))

    def joined(parts: Column) -> Column:
        totals = fold(F.transform(parts, lambda p: F.element_at(p, -1)))
        return let(totals, lambda t: F.flatten(F.transform(parts, lambda p, b: F.when(b == 0, p).otherwise(
            F.transform(p, lambda x: op(F.get(t, b - 1), x))))))

    return let(values, lambda a: F.when(F.size(a) <= BLOCK, fold(a)).otherwise(let(F.transform(blocks(a), fold), joined)))
