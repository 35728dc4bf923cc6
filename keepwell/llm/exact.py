"""Exact duplicates by progressive refinement (DataFrame functions only).

Three rounds, each reading more of the text for fewer rows: groups of equal byte
length, then of equal prefix hash, then of equal SHA-256 of the whole text. What a
round hands on is a filter over the groups with two rows or more, sized by their number and
bounded, so it is broadcast and no text is shuffled to find the candidates; a row that
passes by chance is sorted out by the full hash. Group tables are aggregates (combined before
the shuffle), so a group that holds a third of all rows costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwell.llm.common import Members, fresh, text_of, written

PREFIX_CHARS = 64


def _repeated(df: DataFrame, *keys: str) -> Members:
    """The key groups with several rows."""
    return Members(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1"), *keys)


def _flagged(docs: DataFrame, text: Column, prefix_chars: int) -> tuple[DataFrame, str, str]:
    """``docs`` with its byte length and a flag that is false unless length and prefix
    hash are shared with another row."""
    n_bytes, prefix = fresh(docs, "n_bytes", "prefix")
    hashed = F.xxhash64(F.substring(text, 1, prefix_chars))
    sized = docs.withColumn(n_bytes, F.octet_length(text))
    lengths = _repeated(sized.select(n_bytes), n_bytes)
    # round 2 reads the prefixes of rows whose length is shared
    live, _ = lengths.split(sized, n_bytes)
    prefixes = _repeated(live.select(F.col(n_bytes), hashed.alias(prefix)), n_bytes, prefix)
    flagged, flag = prefixes.mark(sized, n_bytes, hashed)
    return flagged, n_bytes, flag


def mark(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         prefix_chars: int = PREFIX_CHARS, digest_all: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``keep_id``, ``group_size`` (long),
    ``kept``, ``text_sha256``.

    Of equal texts the row with the largest id stays, one row exactly: repeated rows
    of that id are told apart by a row number that is written with the digests. Null
    text equals empty text; a null id ranks below all others. ``text_sha256`` is null
    for texts that the first two rounds prove unique, unless ``digest_all``. An empty
    table gives no rows. Other columns of ``docs`` are ignored.
    """
    slim = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("t"))
    flagged, n_bytes, live = _flagged(slim, F.col("t"), prefix_chars)
    full = F.sha2(F.col("t"), 256)
    marks = written(flagged.select(
        F.monotonically_increasing_id().alias("row"), "id", n_bytes, F.col(live).alias("live"),
        (full if digest_all else F.when(F.col(live), full)).alias("sha")), "digests")
    groups = written(
        marks.where("live").groupBy(n_bytes, "sha")
        .agg(F.count(F.lit(1)).alias("size"), F.max(F.struct("id", "row")).alias("keep")).where("size > 1"),
        "groups")
    alone = marks.where("not live").select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "sha")
    met = marks.where("live").join(groups, [n_bytes, "sha"], "left").select(
        "id", F.when(F.col("size").isNull(), F.col("id")).otherwise(F.col("keep.id")).alias("keep_id"),
        F.coalesce("size", F.lit(1).cast("long")).alias("group_size"),
        (F.col("size").isNull() | (F.col("row") == F.col("keep.row"))).alias("kept"), "sha")
    return alone.unionByName(met).select(
        F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """The rows of ``docs`` that stay, all columns: one row of each set of equal texts,
    that with the largest id (null text equals empty text, null ids rank lowest; of
    rows equal in text and id, any one).

    Rows whose text occurs once stay where they are: the full hash of suspects, on narrow rows,
    tells which texts really recur, and only rows with such a hash are shuffled; copies
    collapse before the shuffle."""
    text = text_of(text_col)
    flagged, n_bytes, live = _flagged(docs, text, prefix_chars)
    (sha,) = fresh(flagged, "sha")
    rows = [F.col(f"`{c}`") for c in docs.columns]
    fields = [c.alias(f"c{i}") for i, c in enumerate(rows)]
    hashed = flagged.withColumn(sha, F.when(F.col(live), F.unhex(F.sha2(text, 256))))
    again = _repeated(hashed.where(F.col(live)).select(n_bytes, sha), n_bytes, sha)
    marked, hit = again.mark(hashed, n_bytes, sha)
    copy = F.col(live) & F.col(hit)
    met = (marked.where(copy).groupBy(n_bytes, sha)
           .agg(F.max_by(F.struct(*fields), F.struct(F.col(id_col))).alias("row"))
           .select(*[F.col("row").getField(f"c{i}").alias(c) for i, c in enumerate(docs.columns)]))
    return marked.where(~copy).select(*rows).union(met)
