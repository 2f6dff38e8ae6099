"""Merkle trees over sections, paragraphs and pieces of text, and what two of them have in common."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadlens.llm.common import partitions, texts
from threadlens.session import written

#: Up to five words, ended early by a full stop, question or exclamation mark; every character is in one piece.
_PIECE = r"(?:[^.!?\s]+\s*){1,5}[.!?]*\s*|[.!?]+\s*|\s+"
_SHORT = 8
_BUCKET_ROWS = 20_000


def with_tree(df: DataFrame, text: str, prefix: str = "") -> DataFrame:
    """Adds root, sections, paragraphs and pieces (digests of the tree's levels), each with `prefix` before its name.

    Pieces of five words are hashed; a paragraph (line) hashes its pieces' digests, a section its paragraphs', the root
    its sections'. An empty line ends a section, and so does a paragraph whose digest ends in 0, so that an edit moves no
    section beyond its own. Equal texts have equal roots. `pieces` keeps the first eight digits of each piece's digest.
    """
    digests = F.transform(F.split(F.col(text), "\n"), lambda p: F.transform(F.regexp_extract_all(p, F.lit(_PIECE), F.lit(0)), lambda x: F.sha2(x, 256)))
    leaves, paragraphs = F.col("_leaves"), F.col(f"{prefix}paragraphs")
    marked = F.transform(paragraphs, lambda d: F.when(d == "", "|").when(d.endswith("0"), F.concat(d, F.lit("|"))).otherwise(d))
    out = df.withColumn("_leaves", digests)
    out = out.withColumn(f"{prefix}paragraphs", F.transform(leaves, lambda x: F.when(F.size(x) == 0, "").otherwise(F.sha2(F.array_join(x, ""), 256))))
    out = out.withColumn(f"{prefix}pieces", F.array_join(F.transform(F.flatten(leaves), lambda d: F.substring(d, 1, _SHORT)), "")).drop("_leaves")
    out = out.withColumn(f"{prefix}sections", F.transform(F.split(F.array_join(marked, ""), r"\|"), lambda s: F.sha2(s, 256)))
    return out.withColumn(f"{prefix}root", F.sha2(F.array_join(F.col(f"{prefix}sections"), ""), 256))


def _piece_set(pieces: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(pieces, F.lit(f".{{{_SHORT}}}"), F.lit(0)))


def likeness(a: Column, b: Column) -> Column:
    """Twice the common pieces over all pieces (distinct ones), from 0 to 1; 1 for two empty texts."""
    x, y = _piece_set(a), _piece_set(b)
    return F.when(a == b, 1.0).otherwise(2.0 * F.size(F.array_intersect(x, y)) / (F.size(x) + F.size(y)))


def edited_paragraphs(a: Column, b: Column) -> Column:
    """Positions (from 0) of the paragraphs of `a` whose digest `b` lacks."""
    return F.filter(F.transform(a, lambda d, i: F.when(~F.array_contains(b, d), i)), lambda i: i.isNotNull())


def with_next(docs: DataFrame, *carried: str) -> DataFrame:
    """Every row of `docs` (doc_id, text and `carried`) with next_text and next_<carried> of the document after it.

    The order is by doc_id, nulls first, then by a digest of the text, so that repeated ids have a defined order; the last
    row is followed by the first. Rows are shuffled once, by ranges of ids (a range holds at most so many ids as it is
    wide, and ranges are narrowed with the number of rows); the first row of each range is sent to the range before it too.
    """
    spark = docs.sparkSession
    span = docs.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n")).first()
    low, high = (0, 0) if span["low"] is None else (span["low"], span["high"])
    ranges = max(4 * partitions(spark), span["n"] // _BUCKET_ROWS)
    width = max(1, -(-(high - low + 2) // ranges))
    keyed = docs.withColumn("_key", F.coalesce(F.col("doc_id"), F.lit(low - 1))).withColumn("_range", F.expr(f"(_key - {low - 1}L) div {width}L"))
    first = keyed.groupBy("_range").agg(F.min("_key").alias("_key"))
    after = Window.orderBy("_range")
    lead_in = written(first.select("_key", F.coalesce(F.lag("_range").over(after), F.max("_range").over(Window.partitionBy())).alias("_to")), "range_starts")
    columns = ["doc_id", "text", *carried]
    borrowed = (
        keyed.join(lead_in, "_key").groupBy("_to", "_key").agg(F.min_by(F.struct(*columns), F.xxhash64("text")).alias("r"))
        .select(*[F.col(f"r.{c}") for c in columns], "_key", F.col("_to").alias("_range"), F.lit(1).alias("_borrowed"))
    )
    rows = keyed.select(*columns, "_key", "_range", F.lit(0).alias("_borrowed")).unionByName(borrowed)
    order = Window.partitionBy("_range").orderBy("_borrowed", "_key", F.xxhash64("text"))
    return rows.select(*columns, "_borrowed", *[F.lead(c).over(order).alias(f"next_{c}") for c in ("text", *carried)]).where("_borrowed = 0").drop("_borrowed")


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, with their likeness and that of the next document.

    The edited text has the last floor(n_chars / 2) code points replaced by the first as many (or all) of the next
    document. A fingerprint is the root and, after a colon, the pieces' digests. A null text counts as empty; an only
    document follows itself; an empty table gives an empty one.
    """
    own = with_tree(texts(docs), "text").select("doc_id", "text", "root", "pieces")
    half = F.expr("length(text) div 2").cast("int")
    paired = with_next(own, "root", "pieces").withColumn("edited", F.concat(F.expr("left(text, length(text) - length(text) div 2)"), F.substring(F.col("next_text"), F.lit(1), half)))
    both = with_tree(paired, "edited", "edited_")
    return both.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        F.concat_ws(":", "root", "pieces").alias("fingerprint"), F.concat_ws(":", "edited_root", "edited_pieces").alias("edited_fingerprint"),
        likeness(F.col("pieces"), F.col("edited_pieces")).alias("near_edited"), likeness(F.col("pieces"), F.col("next_pieces")).alias("near_next"),
    )
