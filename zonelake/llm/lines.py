"""Line dedup over overlapping windows of three lines, in DataFrame functions only.

A window is three consecutive lines, named by two 64-bit hashes of its lines' hashes.  A line goes if a window that covers it
occurred earlier: in a document of smaller id, or earlier in the same one.  The covered positions of all
such windows of a document are merged and cut out at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

#: lines of a window
WINDOW = 3


def _windows(base: DataFrame) -> DataFrame:
    """(g, w, id, dig, at) of every window; ``at`` counts lines from 0."""
    lines = base.select("id", "dig", F.expr("split(text, '\\\\n')").alias("_l"))
    hashed = lines.select("id", "dig", F.expr("transform(_l, l -> xxhash64(l))").alias("_a"), F.expr("transform(_l, l -> xxhash64('other', l))").alias("_b"))
    g, w = (", ".join(f"get({name}, i + {k})" for k in range(WINDOW)) for name in ("_a", "_b"))
    each = f"transform(slice(_a, 1, greatest(size(_a) - {WINDOW - 1}, 0)), (a, i) -> struct(xxhash64({g}) AS g, xxhash64({w}) AS w, i AS at))"
    return hashed.select("id", "dig", F.inline(F.expr(each)))


def duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: dict[str, Column] | None = None) -> DataFrame:
    """(id, text, n_lines, n_removed, columns named in ``keep``) of every row, the text without later occurrences.

    Lines are what stands between line feeds, compared as they are; texts of under three lines have no window and stay.
    A text all of whose lines go becomes empty; a null text stays null (no lines).  Null ids come before all others.
    Rows of equal id and text are one document and get the same result; of rows that share an id only, windows
    at the same place don't remove each other.  An empty table gives an empty result.  Windows are compared by 128 bits of hashes of their
    lines, not letter by letter.
    """
    keep = keep or {}
    text = F.col(text_col).cast("string")
    base = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("dig"), text.alias("text"), *[c.alias(f"_k{i}") for i, c in enumerate(keep.values())])
    windows = _windows(base.filter("text IS NOT NULL").select("id", "dig", "text"))
    # combined map-side: a window in a third of all documents is one row per task before the shuffle
    place = F.struct("id", "at")
    first = materialize(windows.groupBy("g", "w").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter("first <> last").drop("last"))
    # two plain shuffles, so AQE splits the partition of a window that very many documents share
    later = windows.join(first, ["g", "w"]).filter("NOT (first.id <=> id AND first.at = at)")
    gone = later.groupBy("id", "dig").agg(F.collect_set("at").alias("starts"))  # at most one for each line of the document
    spread = F.expr(f"array_distinct(flatten(transform(starts, s -> sequence(s, s + {WINDOW - 1}))))")
    gone = gone.select(F.col("id").alias("_id"), F.col("dig").alias("_dig"), spread.alias("cut"))
    joined = base.join(gone, base["id"].eqNullSafe(gone["_id"]) & (base["dig"] == gone["_dig"]), "left")
    lines = joined.withColumn("_l", F.expr("split(text, '\\\\n')"))
    rest = F.expr("array_join(transform(array_except(sequence(0, size(_l) - 1), cut), i -> get(_l, i)), '\\n')")
    return lines.select(
        F.col("id").alias(id_col),
        F.when(F.col("cut").isNull(), F.col("text")).otherwise(rest).alias(text_col),
        F.greatest(F.size("_l"), F.lit(0)).cast("long").alias("n_lines"),
        F.greatest(F.size("cut"), F.lit(0)).cast("long").alias("n_removed"),
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)],
    )
