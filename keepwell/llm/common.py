"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keepwell.scratch import scratch, written
from keepwell.workers import ship

__all__ = ["SPACE", "Members", "fresh", "let", "scratch", "ship", "table", "text_of", "words", "written"]

#: Fixed value: white space of the word rule (blank, tab, LF, VT, FF, CR), as a Java character class.
SPACE = r"[\x20\x09-\x0D]"

#: Bits of a membership filter per key, so about one other row in 16 passes, and 64-bit words it
#: has at most: beyond 4 million keys it grows no more and passes more rows, none less.
BITS_PER_KEY, MOST_WORDS = 16, 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col) -> Column:
    """Null text counts as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """Array of the maximal runs of non-white-space."""
    return F.array_remove(F.split(text, SPACE + "+"), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row (a lambda variable),
    so that nested lambdas do not evaluate it again per element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that no column of ``df`` has (case-insensitively)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


class Members:
    """A filter over the hashes of given keys, sized by their number: no key is missed, some
    others pass. It lets rows that cannot be concerned bypass a join with all they carry.

    The filter is a table of 64-bit words, ``MOST_WORDS`` at most, so it may be broadcast
    whatever the number of keys."""

    def __init__(self, keys: DataFrame, *cols, most_words: int = MOST_WORDS):
        hashes = written(keys.select(F.xxhash64(*cols).alias("h")), "member_hashes")
        n = hashes.count()
        self.bits = min(64 * most_words, max(64, 1 << (BITS_PER_KEY * n - 1).bit_length())) if n else 64
        place = self._place(F.col("h"))
        self._words = written(hashes.select(F.shiftright(place, 6).alias("word"), self._bit(place).alias("bit"))
                              .groupBy("word").agg(F.bit_or("bit").alias("held")), "member_words")

    def _place(self, hashed: Column) -> Column:
        return F.pmod(hashed, F.lit(self.bits))

    @staticmethod
    def _bit(place: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int"))

    def split(self, df: DataFrame, *cols) -> tuple[DataFrame, DataFrame]:
        """(rows whose ``cols`` may be among the keys, rows whose are not), with the columns of ``df``."""
        marked, hit = self.mark(df, *cols)
        return marked.where(F.col(hit)).drop(hit), marked.where(~F.col(hit)).drop(hit)

    def mark(self, df: DataFrame, *cols) -> tuple[DataFrame, str]:
        """``df`` with a boolean column, whose name is returned: whether ``cols`` may be among the keys."""
        word, held, hit = fresh(df, "word", "held", "hit")
        place = self._place(F.xxhash64(*cols))
        words = F.broadcast(self._words.select(F.col("word").alias(word), F.col("held").alias(held)))
        rows = df.withColumn(word, F.shiftright(place, 6)).join(words, word, "left")
        seen = F.coalesce(F.col(held).bitwiseAND(self._bit(place)) != 0, F.lit(False))
        return rows.withColumn(hit, seen).drop(word, held), hit
