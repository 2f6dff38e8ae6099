"""Lines that recur across documents, found as templates in a tree of fixed depth, and dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.llm.common import identity
from threadlens.session import written

_DIGITS = r"[^ ]*[0-9][^ ]*"
#: Least share of a document's text that is its own; documents that share more are near copies (0.8 alike, as in `near_dups`).
OWN = 0.2


def _masked(line: Column) -> Column:
    """The trimmed line with the tokens (between spaces) that hold a digit as <*>."""
    plain = F.trim(line)
    return F.when(plain.rlike("[0-9]"), F.regexp_replace(plain, _DIGITS, "<*>")).otherwise(plain)


def _lines(text: Column, depth: int, min_tokens: int) -> Column:
    """Each line's text, masked, leaf (digest of token count and `depth` leading tokens), and line (digest of the masked line), null where shorter."""
    masked = F.transform(F.split(text, "\n"), lambda x: F.struct(x.alias("text"), _masked(x).alias("masked")))
    counted = F.transform(masked, lambda x: F.struct(x["text"].alias("text"), x["masked"].alias("masked"), (F.length(x["masked"]) - F.length(F.replace(x["masked"], F.lit(" "), F.lit(""))) + 1).alias("n")))
    return F.transform(counted, lambda x: F.struct(
        x["text"].alias("text"), x["masked"].alias("masked"),
        F.when(x["n"] >= min_tokens, F.xxhash64(x["n"], F.substring_index(x["masked"], " ", depth))).alias("leaf"),
        F.when(x["n"] >= min_tokens, F.xxhash64(x["masked"])).alias("line"),
    ))


def with_lines(docs: DataFrame, depth: int, min_tokens: int) -> DataFrame:
    return docs.withColumn("lines", _lines(F.coalesce(F.col("text"), F.lit("")), depth, min_tokens))


def _occurrences(lines: DataFrame, *more: str) -> DataFrame:
    """Adds `seen`, the distinct lines of a document (leaf, line and `more`), and `parts`, key (leaf) and length of all that are not blank."""
    eligible = F.filter("lines", lambda x: x["leaf"].isNotNull())
    parts = F.transform(F.filter("lines", lambda x: x["masked"] != ""), lambda x: F.struct(F.coalesce(x["leaf"], F.xxhash64(x["masked"])).alias("key"), F.length(x["masked"]).alias("n")))
    seen = F.array_distinct(F.transform(eligible, lambda x: F.struct(x["leaf"].alias("leaf"), x["line"].alias("line"), *[x[m].alias(m) for m in more])))
    return lines.withColumn("seen", seen).withColumn("parts", F.array_distinct(parts))


def with_company(digested: DataFrame, min_documents: int = 3) -> DataFrame:
    """_row, seen and company, the digest that stands for what a document is about.

    It is the smallest leaf among those that fewer than `min_documents` documents have, so that a passage that recurs never
    stands for its documents. Where these lines hold less than OWN of the text, the document is a near copy of others: then
    it is the leaf that the fewest documents have among those that recur, which near copies share.
    """
    keys = F.transform("parts", lambda x: x["key"])
    common = written(digested.select(F.explode(F.array_distinct(keys)).alias("key")).groupBy("key").agg(F.count("*").alias("documents")).where(F.col("documents") >= min_documents), "common")
    held = digested.select("_row", F.explode("parts").alias("x")).select("_row", "x.*").join(common, "key").groupBy("_row").agg(F.collect_set(F.struct("documents", "key", "n")).alias("held"))
    total = lambda parts: F.aggregate(parts, F.lit(0).cast("long"), lambda a, x: a + x["n"])
    rest = F.array_except(keys, F.transform("held", lambda x: x["key"]))
    company = F.when(F.col("held").isNull(), F.array_min(keys)).when(total(F.col("parts")) - total(F.col("held")) >= OWN * total(F.col("parts")), F.array_min(rest)).otherwise(F.array_min("held")["key"])
    return digested.join(held, "_row", "left").select("_row", "seen", company.alias("company"))


def _exploded(seen: DataFrame) -> DataFrame:
    return seen.select(F.explode("seen").alias("x"), "company").select("x.*", "company")


def recurring_lines(docs: DataFrame, digested: DataFrame, depth: int = 3, min_tokens: int = 5, min_documents: int = 3, spread: float = 0.3, alike: float = 0.6) -> DataFrame:
    """`line` digests of the templates that recur in `min_documents` or more documents of different company.

    `digested` has _row, `seen` and `company` of each of `docs` (with _row), whose texts are read again only for the variants of a leaf.

    A line is parsed down a tree of fixed depth: token count, then `depth` leading tokens. Lines equal once variable fields
    are masked are one template. Within a leaf, positions where four fifths of the lines agree are constants; if at least
    `alike` of all positions are, the lines that fit the constants are one template with the other positions generalised.
    A template is dropped if its documents keep `min_documents` companies or more, and `spread` as many as documents, so
    that lines of many copies of one document do not count as recurring.
    """
    seen = written(_exploded(digested).groupBy("leaf", "line", "company").agg(F.count("*").alias("n")), "lines")
    recurs = (F.col("companies") >= min_documents) & (F.col("companies") >= spread * F.col("documents"))
    per_line = seen.groupBy("leaf", "line").agg(F.count("*").alias("companies"), F.sum("n").alias("documents"))
    exact = per_line.where(recurs).select("line")
    leaves = per_line.groupBy("leaf").agg(F.count("*").alias("variants"), F.sum("companies").alias("companies")).where(F.col("companies") >= min_documents).where("variants > 1").select("leaf")
    parsed = _occurrences(with_lines(docs.select("_row", "text"), depth, min_tokens), "masked").select("_row", F.explode("seen").alias("x")).select("_row", "x.*")
    crowded = parsed.join(written(leaves, "leaves"), "leaf").join(digested.select("_row", "company").dropDuplicates(["_row"]), "_row")
    variants = written(crowded.groupBy("leaf", "line", "company").agg(F.count("*").alias("n"), F.first("masked").alias("masked")), "variants")
    positions = variants.select("leaf", "line", "n", F.posexplode(F.split("masked", " ")).alias("at", "token"))
    votes = positions.groupBy("leaf", "at", "token").agg(F.sum("n").alias("n")).groupBy("leaf", "at").agg(F.max_by("token", F.struct("n", "token")).alias("token"), F.max("n").alias("most"), F.sum("n").alias("n"))
    templates = votes.groupBy("leaf").agg(
        F.map_from_entries(F.collect_list(F.when(F.col("most") >= 0.8 * F.col("n"), F.struct("at", "token")))).alias("constants"), F.count("*").alias("size")
    ).where(F.size("constants") >= alike * F.col("size"))
    fits = F.forall(F.map_entries("constants"), lambda c: F.get(F.col("tokens"), c["key"]) == c["value"])
    fitting = variants.join(templates, "leaf").withColumn("tokens", F.split("masked", " ")).where(fits)
    general = fitting.groupBy("leaf").agg(F.count_distinct("company").alias("companies"), F.sum("n").alias("documents")).where(recurs).select("leaf")
    return exact.union(fitting.join(general, "leaf").select("line")).distinct()


def drop_recurring_lines(docs: DataFrame, depth: int = 3, min_tokens: int = 5, min_documents: int = 3) -> DataFrame:
    """`docs` with the recurring lines cut from `text`, and n_dropped, the number of lines cut.

    All other columns stay. A document with nothing to cut keeps its text, null included; one whose lines all go keeps an
    empty text. Only digests of lines are joined with the recurring ones; then each document meets the digests it loses.
    """
    keyed = docs.withColumn("_row", identity("doc_id", "text"))
    parsed = written(_occurrences(with_lines(keyed.select("_row", "text"), depth, min_tokens)).select("_row", "seen", "parts"), "parsed")
    digested = written(with_company(parsed, min_documents), "digested")
    recurring = written(recurring_lines(keyed, digested, depth, min_tokens, min_documents), "recurring")
    lost = digested.select("_row", F.explode("seen.line").alias("line")).join(recurring, "line").groupBy("_row").agg(F.collect_set("line").alias("_lost"))
    joined = keyed.join(lost, "_row", "left")
    cut = F.col("_lost").isNotNull()
    lines = joined.withColumn("_lines", F.when(cut, _lines(F.col("text"), depth, min_tokens)))
    left = lines.withColumn("_left", F.filter("_lines", lambda x: x["line"].isNull() | ~F.array_contains("_lost", x["line"])))
    return (
        left.withColumn("n_dropped", F.when(cut, F.size("_lines") - F.size("_left")).otherwise(0).cast("long"))
        .withColumn("text", F.when(cut, F.array_join(F.transform("_left", lambda x: x["text"]), "\n")).otherwise(F.col("text")))
        .drop("_lines", "_left", "_row", "_lost")
    )
