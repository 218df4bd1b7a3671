"""Document fingerprints: bottom-k sketches of shingle hashes, in DataFrame functions only.

A sketch is the ``k`` smallest distinct 64-bit hashes of a text's word shingles, as a
sorted array. Sketches of parts merge to the sketch of the whole, and give estimates
of resemblance, containment and the number of distinct shingles.

Defined results: a null text is empty; an empty text has the empty sketch; a text of
fewer than ``width`` words has one shingle, all its words; repeated shingles count once;
two empty sketches resemble each other by 1, an empty and another one by 0. Other
columns of the input are not read, so they may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardflow.llm.common import SPACE_CLASS, successors, table, texts

K = 128
WIDTH = 5


def with_sketch(df: DataFrame, text: str, out: str, k: int = K, width: int = WIDTH) -> DataFrame:
    """``df`` with the sketch of column ``text`` in column ``out``."""
    words, hashes = f"__{out}_words", f"__{out}_hashes"
    df = df.withColumn(words, F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), SPACE_CLASS), ""))
    df = df.withColumn(hashes, F.transform(words, lambda w: F.xxhash64(w)))
    h = F.col(hashes)
    shingles = F.transform(
        F.sequence(F.lit(0), F.size(h) - width),
        lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(width)]),
    )
    whole = F.when(F.size(h) == 0, F.array().cast("array<long>")).otherwise(F.array(F.xxhash64(h)))
    every = F.when(F.size(h) >= width, shingles).otherwise(whole)
    return df.withColumn(out, bottom(every, k)).drop(words, hashes)


def bottom(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merge(left: Column, right: Column, k: int = K) -> Column:
    """The sketch of both texts' shingles together."""
    return bottom(F.concat(left, right), k)


def distinct_shingles(sketch: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    share = (F.element_at(sketch, k).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise((k - 1) / share)


def resemblance(left: Column, right: Column, k: int = K) -> Column:
    """Estimated Jaccard likeness: the share of the union's bottom-k that both have."""
    return likeness(merge(left, right, k), left, right)


def likeness(union: Column, left: Column, right: Column) -> Column:
    """Resemblance where the merged sketch is already at hand."""
    both = F.size(F.array_intersect(F.array_intersect(union, left), right))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union))


def containment(left: Column, right: Column, k: int = K) -> Column:
    """Estimated share of the left text's shingles that the right one has (1 if it has none)."""
    shared = resemblance(left, right, k) * distinct_shingles(merge(left, right, k), k)
    size = distinct_shingles(left, k)
    return F.when(F.size(left) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), shared / size))


def as_text(sketch: Column) -> Column:
    """16 hex digits for each hash, in the order of the sketch."""
    return F.array_join(F.transform(sketch, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def fingerprint_documents(docs: DataFrame, k: int = K, width: int = WIDTH) -> DataFrame:
    """Every document beside its edited text and its next document (ascending ``doc_id``).

    The edited text has the last floor(n/4) code points replaced by the first as many
    of the next document. After the last document comes the first, so a single one
    follows itself. A null id sorts first, and an id of -2^63 counts as null. Of several rows with one id, the one with the
    smallest text is the next document of those before; each is a row of the result.

    Texts are shuffled once, by id; both sides of the join read that exchange. Only the
    needed prefix and the sketch of the next document are shuffled to the one before.
    """
    lowest = F.lit(-(2**63)).cast("long")
    rows = texts(docs).select(F.coalesce("doc_id", lowest).alias("k"), "text")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    need = F.floor(F.char_length("text") / 4).alias("need")
    links = successors(rows.select("k", need).groupBy("k").agg(F.max("need").cast("int").alias("need")))
    links = links.select(F.col("next_k"), F.col("k").alias("before"), "need")

    dealt = rows.repartition(parts, "k")
    first = dealt.withColumn("place", F.row_number().over(Window.partitionBy("k").orderBy("text")))
    first = first.where("place = 1").select(F.col("k").alias("next_k"), F.col("text").alias("next_text"))
    first = with_sketch(first, "next_text", "next_sketch", k, width)
    following = first.join(links, "next_k").select(
        F.col("before").alias("k"), F.expr("substring(next_text, 1, need)").alias("next_text"), "next_sketch"
    )
    both = dealt.join(following, "k").withColumn("doc_id", F.nullif("k", lowest)).withColumn("n_chars", F.char_length("text").cast("long"))
    cut = "cast(floor(n_chars / 4) as int)"
    both = both.withColumn(
        "edited",
        F.concat(
            F.expr(f"substring(text, 1, cast(n_chars as int) - {cut})"), F.expr(f"substring(next_text, 1, {cut})")
        ),
    )
    both = with_sketch(both, "text", "sketch", k, width)
    return with_sketch(both, "edited", "edited_sketch", k, width)


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprint_documents(table(spark, sf_dir, "documents"))
    sketch, edited, following = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    found = found.withColumn("with_edited", merge(sketch, edited)).withColumn("with_next", merge(sketch, following))
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(sketch).alias("fingerprint"),
        as_text(edited).alias("edited_fingerprint"),
        likeness(F.col("with_edited"), sketch, edited).alias("near_edited"),
        likeness(F.col("with_next"), sketch, following).alias("near_next"),
        distinct_shingles(sketch).alias("distinct_shingles"),
        containment(sketch, edited).alias("in_edited"),
    )
