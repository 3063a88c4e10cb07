"""Line dedup: lines found in many documents go from every document.

Lines are exploded with their position, normalised and hashed; a hash's documents are counted, and each document is put
together again from the positions that stay. Only hashes and positions are shuffled by line; the text moves once, to meet
its document's dropped positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reqloom.llm.shared import LOWER, SPACES, UPPER

MIN_DOCUMENTS = 10
MIN_LENGTH = 1


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased."""
    return F.translate(F.trim(line, F.lit(SPACES)), UPPER, LOWER)


def drop_common_lines(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_documents: int = MIN_DOCUMENTS,
    min_length: int = MIN_LENGTH,
) -> DataFrame:
    """All columns of `docs` with the text left after dropping, and `n_lines` (before dropping) and `n_dropped`.

    A line whose key has at least `min_length` code points and occurs in at least `min_documents` documents is dropped
    from every document, all its occurrences included. Documents are told apart by `id_column`: rows that repeat an id
    count once, null ids count as one document. A null text is one empty line and comes back as empty text; so does a text
    that loses all lines. Columns of `docs` named like the two added ones are replaced. An empty table gives an empty one.

    Hashes have 128 bits (two seeds). A hot line's documents are counted by partial sums over distinct (hash, document)
    pairs, so no task gets all its rows.
    """
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    doc = F.struct(F.col(f"`{id_column}`").alias("id"), F.xxhash64(text).alias("a"), F.xxhash64(F.lit(7), text).alias("b"))
    lines = docs.select(doc.alias("doc"), F.posexplode(F.split(text, "\n")).alias("position", "line"))
    key = line_key(F.col("line"))
    hashed = lines.where(F.length(key) >= min_length).select(
        "doc", "position", F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit(7), key).alias("b")).alias("hash")
    )
    common = (
        hashed.select("hash", "doc.id")
        .distinct()
        .groupBy("hash")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= min_documents)
        .select("hash")
    )
    dropped = (
        hashed.join(common, "hash", "left_semi")
        .groupBy("doc")
        .agg(F.collect_set("position").alias("dropped"))
        .withColumnRenamed("doc", "_doc")
    )
    rest = [F.col(f"`{name}`") for name in docs.columns if name not in (text_column, "n_lines", "n_dropped")]
    whole = docs.select(*rest, text.alias("_text"), doc.alias("_key"))
    joined = whole.join(dropped, whole["_key"].eqNullSafe(dropped["_doc"]), "left")
    pieces = F.split(F.col("_text"), "\n")
    gone = F.coalesce(F.col("dropped"), F.array().cast("array<int>"))
    kept = F.array_except(F.sequence(F.lit(0), F.col("n_lines").cast("int") - 1), gone)
    again = F.array_join(F.transform(kept, lambda at: F.element_at(F.col("_pieces"), at + 1)), "\n")
    out = joined.withColumn("_pieces", pieces).withColumn("n_lines", F.size("_pieces").cast("long"))
    out = out.withColumn("n_dropped", F.size(gone).cast("long"))
    out = out.withColumn(text_column, F.when(F.col("n_dropped") == 0, F.col("_text")).otherwise(again))
    order = [name for name in docs.columns if name not in ("n_lines", "n_dropped")]
    return out.select(*[F.col(f"`{name}`") for name in order], "n_lines", "n_dropped")
