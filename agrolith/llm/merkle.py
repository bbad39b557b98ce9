"""Merkle fingerprints of documents, by DataFrame functions alone.

A text is a tree: its leaves are blocks of at most BLOCK code points of a paragraph (a line), blocks make the paragraph,
SECTION paragraphs make a section, sections make the root. Every digest is SHA-256 over the digests below it, each level
with its own prefix, so equal texts have equal roots and different texts different ones. Trees are compared from the top:
equal roots are equal texts; otherwise only sections whose digests differ are opened. `differing` names the paragraphs that
differ; `likeness` is the share of both texts' leaves that lie in a section of both, or, in the opened sections, are leaves
of both (Dice; a leaf that repeats within the opened sections counts once). A leaf travels as 64 bits of its digest.

Defined results: a null text counts as empty, which is one empty paragraph without blocks; two empty texts have
likeness 1, an empty and a non-empty one 0; null doc_ids come last in descending order; repeated doc_ids follow each
other in the order of their rows; a single document is its own next; an empty table gives no rows; very long texts
and lines are cut into blocks without limit; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import checkpoint_dir, read, steady

BLOCK = 64
SECTION = 8


def let(value: Column, body) -> Column:
    """body(value), with value computed once however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def digest(level: str, children: Column) -> Column:
    return F.sha2(F.concat(F.lit(level), F.concat_ws("", children)).cast("binary"), 256)


def short(digests: Column) -> Column:
    return F.transform(digests, lambda x: F.xxhash64(x))


def tree(text: Column) -> Column:
    """struct(root, sections, paragraphs, leaves): hex digests; the leaves as numbers, by section."""
    blocks = lambda line: F.regexp_extract_all(line, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    leaves = F.transform(F.split(text, "\n", -1), lambda line: F.transform(blocks(line), lambda block: F.sha2(F.concat(F.lit("b"), block).cast("binary"), 256)))

    def upper(leaves: Column) -> Column:
        firsts = F.sequence(F.lit(1), F.size(leaves), F.lit(SECTION))
        held = F.transform(firsts, lambda first: short(F.flatten(F.slice(leaves, first, F.lit(SECTION)))))
        return let(F.transform(leaves, lambda own: digest("p", own)), lambda paragraphs: whole(paragraphs, firsts, held))

    def whole(paragraphs: Column, firsts: Column, held: Column) -> Column:
        sections = F.transform(firsts, lambda first: digest("s", F.slice(paragraphs, first, F.lit(SECTION))))
        return let(sections, lambda s: F.struct(digest("r", s).alias("root"), s.alias("sections"), paragraphs.alias("paragraphs"), held.alias("leaves")))

    return let(leaves, upper)


def compact(a: Column) -> Column:
    """What likeness needs of a tree: struct(root, sections, leaves), section digests as numbers."""
    return F.struct(a["root"].alias("root"), short(a["sections"]).alias("sections"), a["leaves"].alias("leaves"))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1 from two compact trees."""

    def opened(own: Column, both: Column) -> Column:
        """struct(closed: leaves in common sections, open: distinct leaves of the others)."""
        pairs = F.arrays_zip(own["sections"].alias("s"), own["leaves"].alias("l"))
        kept = F.aggregate(F.filter(pairs, lambda p: F.array_contains(both, p["s"])), F.lit(0), lambda n, p: n + F.size(p["l"]))
        left = F.when(F.size(both) == 0, F.flatten(own["leaves"])).otherwise(F.flatten(F.transform(F.filter(pairs, lambda p: ~F.array_contains(both, p["s"])), lambda p: p["l"])))
        return F.struct(kept.alias("closed"), F.array_distinct(left).alias("open"))

    def shared(x: Column, y: Column) -> Column:
        common = x["closed"] + y["closed"] + 2 * F.size(F.array_intersect(x["open"], y["open"]))
        total = x["closed"] + y["closed"] + F.size(x["open"]) + F.size(y["open"])
        return F.when(total == 0, 0.0).otherwise(common / total)

    met = let(F.array_intersect(a["sections"], b["sections"]), lambda both: let(F.array(opened(a, both), opened(b, both)), lambda x: shared(F.get(x, F.lit(0)), F.get(x, F.lit(1)))))
    return F.when(a["root"] == b["root"], 1.0).otherwise(met)


def differing(a: Column, b: Column) -> Column:
    """Numbers (from 0) of the paragraphs at which the second tree differs from the first, section by section."""
    most = F.greatest(F.size(a["sections"]), F.size(b["sections"]))
    numbers = F.sequence(F.lit(0), most - 1)
    open_sections = F.filter(numbers, lambda s: ~F.get(a["sections"], s).eqNullSafe(F.get(b["sections"], s)))
    inside = F.flatten(F.transform(open_sections, lambda s: F.sequence(s * SECTION, s * SECTION + SECTION - 1)))
    return F.filter(inside, lambda p: ~F.get(a["paragraphs"], p).eqNullSafe(F.get(b["paragraphs"], p)))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and the tree of every row."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), tree(F.coalesce(docs["text"], F.lit(""))).alias("tree"))


def followers(ids: DataFrame) -> DataFrame:
    """(row, follows, half): which row a row follows in descending doc_id, and half that row's length.

    Rows are dealt to ranges of doc_id; within a range a window finds the next row, and each range's last row is
    followed by the first of the next range: a table with one row a range, which is what is broadcast.
    """
    spark = ids.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("row").asc()]
    ranged = ids.checkpoint().repartitionByRange(parts, *order).withColumn("range", F.spark_partition_id()).checkpoint()
    within = W.partitionBy("range").orderBy(*order)
    led = ranged.withColumn("next", F.lead("row").over(within)).withColumn("place", F.row_number().over(within))
    firsts = led.where("place = 1").select("range", F.col("row").alias("first"))
    chain = W.orderBy("range")
    firsts = firsts.select("range", F.coalesce(F.lead("first").over(chain), F.first("first").over(chain)).alias("then"))
    linked = led.join(F.broadcast(firsts), "range").select("row", F.coalesce("next", "then").alias("next"), F.floor(F.col("n_chars") / 2).cast("int").alias("half"))
    return linked.select(F.col("next").alias("row"), F.col("row").alias("follows"), "half")


def with_edits(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, text's tree, the edited text, its tree, and the next document's doc_id and tree."""
    checkpoint_dir(docs.sparkSession)
    docs = steady(docs)
    text = F.coalesce(docs["text"], F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"))
    order = followers(rows.select("row", "doc_id", F.char_length("text").alias("n_chars")))
    own = rows.join(order, "row").withColumn("tree", tree(F.col("text")))
    # half of each text at most travels to the row that it follows, with the blocks and root of its tree
    # and its doc_id, with which both sides read the same exchange of the texts
    heads = own.select(F.col("follows").alias("row"), F.col("doc_id").alias("next_id"), F.substr("text", F.lit(1), F.col("half")).alias("head"), compact(F.col("tree")).alias("next_tree"))
    paired = own.select("row", "doc_id", "text", "tree").join(heads, "row")
    n = F.char_length("text")
    edited = F.concat(F.substr("text", F.lit(1), n - F.floor(n / 2).cast("int")), F.col("head"))
    return paired.select("doc_id", n.cast("long").alias("n_chars"), "tree", edited.alias("edited"), tree(edited).alias("edited_tree"), "next_id", "next_tree")


def op7_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    edits = with_edits(read(spark, sf_dir, "documents"))
    return edits.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.col("tree.root").alias("fingerprint"),
        F.col("edited_tree.root").alias("edited_fingerprint"),
        likeness(compact(F.col("tree")), compact(F.col("edited_tree"))).alias("near_edited"),
        likeness(compact(F.col("tree")), F.col("next_tree")).alias("near_next"),
        "next_id",
        F.size(differing(F.col("tree"), F.col("edited_tree"))).alias("n_differing"),
    )
