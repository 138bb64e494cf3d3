"""Exact duplicates by content-defined chunk recipes, in DataFrame functions alone.

A text is cut where its own characters say so; a chunk's identifier is its
digest, verified: all distinct chunks of a digest are looked at, and where
there are several they get ordinals. A text is then the ordered list of its
chunks' identifiers, its recipe, and texts are equal where recipes are. Whole
texts are never shuffled: each task sends a chunk once however often it stands
in its documents, and a recipe is about a hundredth of its text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialise
from .common import join_groups
from .terms import LOWER, UPPER, lower_ascii

#: Characters of the shortest and longest chunk; only a text's last chunk may be shorter.
LEAST, MOST = 128, 2048
#: The lowest two bits of the ASCII codes of four neighbours behind which a chunk may end.
BORDER = (1, 0, 2, 1)


def border() -> str:
    """The border as a pattern: for each place a class of ASCII characters."""
    def listed(low: int) -> str:
        return "[" + "".join(f"\\x{c:02x}" for c in range(128) if c & 3 == low) + "]"

    return "".join(map(listed, BORDER))


#: As many characters as needed up to a border or the text's end; without one, the most.
CHUNK = f"(?s).{{{LEAST},{MOST}}}?(?:{border()}|\\z)|.{{1,{MOST}}}"


def chunks(text: Column) -> Column:
    """The chunks of a text in order; together they are the text."""
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def clashes(values: DataFrame) -> DataFrame | None:
    """digest, value, ordinal of all values whose (digest, value) digest is not theirs alone; None if there are none."""
    distinct = values.distinct()
    several = materialise(distinct.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest"), "clashes")
    if several.isEmpty():
        return None
    found = distinct.join(several, "digest", "left_semi")
    ordinal = F.row_number().over(Window.partitionBy("digest").orderBy("value"))  # the few values that share 64 bits
    return materialise(found.withColumn("ordinal", ordinal), "ordinals")


def recipes(docs: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """row, given, text_sha256, recipe: digests of the chunks, and the ordinals of those whose digest is not theirs alone."""
    normal = lower_ascii(F.coalesce(F.col("given.text"), F.lit("")))
    texts = docs.select("given", normal.alias("normal"))
    named = clashes(texts.select(F.explode(chunks(F.col("normal"))).alias("value")).select(digest(F.col("value")).alias("digest"), "value"))
    rows = texts.select(
        F.monotonically_increasing_id().alias("row"), F.struct("given.doc_id").alias("given"), F.sha2("normal", 256).alias("text_sha256"),
        chunks(F.col("normal")).alias("chunks"),
    )
    rows = rows.withColumn("ids", F.transform("chunks", lambda chunk: digest(chunk)))
    if named is None:
        found = rows.select("row", "given", "text_sha256", F.struct("ids").alias("recipe"))
    else:
        rows = materialise(rows, "chunks")
        each = rows.select("row", F.posexplode("chunks").alias("seq", "value")).withColumn("digest", digest(F.col("value")))
        marks = each.join(named, ["digest", "value"]).groupBy("row").agg(F.sort_array(F.collect_list(F.struct("seq", "ordinal"))).alias("marks"))
        found = rows.join(marks, "row", "left").select("row", "given", "text_sha256", F.struct("ids", "marks").alias("recipe"))
    return found


def exact_groups(docs: DataFrame, digest: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256 of the text with A-Z lower-cased.

    Texts are equal if they are so after lower-casing A-Z; null counts as
    empty. Of equal texts the row of the largest doc_id stays; of several such
    rows one. Null doc_ids come below all others; where a group has no other,
    keep_id is null. Columns other than doc_id and text are ignored; an empty
    table gives an empty table. Results do not depend on ``digest``, the
    64-bit function of a chunk or list; a bad one only costs time.
    """
    docs = docs.select(F.struct("doc_id", "text").alias("given"))
    listed = F.array_join(F.col("recipe.ids").cast("array<string>"), ",")
    rows = materialise(recipes(docs, digest).withColumn("digest", digest(listed)), "recipes")
    named = clashes(rows.select("digest", F.col("recipe").alias("value")))
    if named is None:
        rows = rows.withColumn("ordinal", F.lit(0))
    else:
        of = F.col("c.digest") == F.col("r.digest"), F.col("c.value") == F.col("r.recipe")
        rows = rows.alias("r").join(named.alias("c"), of[0] & of[1], "left").select("r.*", F.coalesce("ordinal", F.lit(0)).alias("ordinal"))
    rows = materialise(rows.select("row", "given.doc_id", "text_sha256", "digest", "ordinal"), "identified")
    groups = rows.groupBy("digest", "ordinal").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"),
        F.coalesce(F.max_by("row", "doc_id"), F.max("row")).alias("keep_row"),
    )
    joined = join_groups(rows, groups.where("group_size > 1"), ["digest", "ordinal"], "group_size")
    alone = F.col("group_size").isNull()
    return joined.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"), "text_sha256",
    )


#: The same over the table documents, for DuckDB.
ORACLE = f"""
WITH named AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS normal, row_number() OVER () AS row FROM documents),
grouped AS (SELECT *, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, row_number() OVER (PARTITION BY normal ORDER BY doc_id DESC NULLS LAST, row) AS k
            FROM named WINDOW g AS (PARTITION BY normal))
SELECT doc_id, keep_id, group_size, k = 1 AS kept, sha256(normal) AS text_sha256 FROM grouped
"""
