"""Document fingerprints by spot signatures, in DataFrame functions only.

A spot is a run of common words (articles, prepositions, forms of *to be*); its
signature hashes the last of them with the chain of the ``CHAIN`` content words
that follow, common words in between left out. Lists and tables have next to no
common words, so one content word in ``SELF_ANCHORED`` (by hash) is an anchor
too. A text's fingerprint is the set of its signatures, sorted, eight
hexadecimal digits each. Spots follow the prose, so headers and edits elsewhere
leave them as they are.

Two fingerprints are compared by Jaccard. Sets of very different length cannot
be alike: :func:`near_duplicates` deals the sets into length partitions, compares
within a partition and with the next one only, through the rarest signatures.

Defined results: a null text is the empty text; a text without a spot has one
signature of all its words, so two empty texts are alike (1.0); rows with a
null doc_id come before all others in the order of documents, rows with equal
ids in the order of a hash of the text; an empty table gives an empty result;
other columns are left aside.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Common words of four languages, the anchors of spots.
COMMON_WORDS = """
the a an of and or in on to is are was were be been that this it he she they for with as at by from not but have has
der die das den dem des ein eine und oder von zu mit sich auf für ist im nicht als auch es an bei nach wird aus
le la les un une de du des et ou en que qui pour par sur dans au aux est il elle pas ne se ce avec
el los las una y o del al por con su para como se lo no más es ser
""".split()  # fmt: skip
CHAIN = 2
SELF_ANCHORED = 4
#: Documents whose ids share this span lie together while neighbours are read.
ID_SPAN = 512
_END, _ANCHOR = "\u0001", "\u0002"


def with_signatures(df: DataFrame, text: Column, out: str) -> DataFrame:
    """Adds the sorted distinct signatures of ``text`` as an array<int> column."""
    words, runs, content = f"_{out}_words", f"_{out}_runs", f"_{out}_content"
    marked = F.transform(words, lambda w: F.when(w.isin(COMMON_WORDS), F.concat(w, F.lit(_ANCHOR)))
                         .otherwise(F.concat(w, F.lit(_END))))
    # one entry per content word: the common words right before it, then itself
    spots = F.transform(runs, lambda x, k: F.when(
        (x.contains(_ANCHOR) | (F.pmod(F.hash(x), F.lit(SELF_ANCHORED)) == 0)) & F.get(content, k + CHAIN - 1).isNotNull(),
        F.hash(F.substring_index(x, _ANCHOR, -2), *[F.get(content, k + i) for i in range(1, CHAIN)])))
    sparse = F.array_sort(F.array_distinct(F.array_compact(spots)))
    return (df.withColumn(words, F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != ""))
            .withColumn(runs, F.split(F.array_join(marked, ""), _END))
            .withColumn(content, F.transform(F.slice(runs, 1, F.greatest(F.size(runs) - 1, F.lit(0))),
                                             lambda x: F.substring_index(x, _ANCHOR, -1)))
            .withColumn(out, sparse)
            .withColumn(out, F.when(F.size(out) > 0, F.col(out))
                        .otherwise(F.array(F.hash(F.array_join(words, " ")))))
            .drop(words, runs, content))


def as_text(signatures: Column) -> Column:
    return F.array_join(F.transform(signatures, lambda s: F.right(F.concat(F.lit("0000000"), F.hex(s)), F.lit(8))), "")


def likeness(a: Column, b: Column, at_least: float = 0.0) -> Column:
    """Jaccard of two signature sets; 0 without a look if their lengths already
    keep it under ``at_least``."""
    bound = F.least(F.size(a), F.size(b)) / F.greatest(F.size(a), F.size(b))
    shared = F.size(F.array_intersect(a, b)).cast("double")
    exact = shared / (F.size(a) + F.size(b) - shared)
    return exact if at_least <= 0 else F.when(bound < at_least, F.lit(0.0)).otherwise(exact)


def _following_spans(rows: DataFrame) -> DataFrame:
    """(_span, _after): the next span that has rows (after the last: the first)."""
    spans = rows.select("_span").distinct().withColumn("_wide", F.floor(F.col("_span") / 4096))
    wide = spans.groupBy("_wide").agg(F.min("_span").alias("_first"))  # one row per 4096 spans
    order = Window.orderBy("_wide")
    ends = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    wide = wide.select("_wide", F.coalesce(F.lead("_first").over(order), F.first("_first").over(ends)).alias("_after_wide"))
    after = F.lead("_span").over(Window.partitionBy("_wide").orderBy("_span"))
    return spans.withColumn("_after", after).join(wide, "_wide").select(
        "_span", F.coalesce("_after", "_after_wide").alias("_after"))


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, _text, _own, _next_text, _next: each text and its signatures, and
    those of the row after, by ascending doc_id (after the last: the first).

    Rows lie together by spans of ids, moved once. Inside a span the row after
    comes from a window; the last row of a span, one in some hundred, is joined
    with the first row of the next span.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("_text"))
    rows = rows.withColumn("_tie", F.xxhash64("_text")).withColumn(
        "_span", F.coalesce(F.floor(F.col("doc_id") / ID_SPAN), F.lit(-(1 << 60))))
    window = Window.partitionBy("_span").orderBy("doc_id", "_tie")
    together = rows.repartition("_span")
    inside = with_signatures(together, F.col("_text"), "_own").select(
        "doc_id", "_text", "_own", F.lead("_text").over(window).alias("_next_text"), F.lead("_own").over(window).alias("_next"))
    lasts = together.withColumn("_more", F.lead("_tie").over(window)).filter("_more IS NULL")
    firsts = together.withColumn("_place", F.row_number().over(window)).filter("_place = 1").select(
        F.col("_span").alias("_after"), F.col("_text").alias("_next_text"))
    edges = lasts.join(_following_spans(rows), "_span").join(firsts, "_after").select("doc_id", "_text", "_next_text")
    edges = with_signatures(with_signatures(edges, F.col("_text"), "_own"), F.col("_next_text"), "_next")
    return inside.filter("_next_text IS NOT NULL").unionByName(edges)


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next per row."""
    rows = with_next(docs).withColumn("n_chars", F.length("_text").cast("bigint"))
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.col("_text").substr(F.lit(1), F.col("n_chars").cast("int") - cut),
                      F.col("_next_text").substr(F.lit(1), cut))
    rows = with_signatures(rows.withColumn("_edited_text", edited), F.col("_edited_text"), "_edited")
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.encode("_edited_text", "UTF-8"), 256).alias("edited_sha256"),
        as_text(F.col("_own")).alias("fingerprint"), as_text(F.col("_edited")).alias("edited_fingerprint"),
        likeness(F.col("_own"), F.col("_edited")).alias("near_edited"),
        likeness(F.col("_own"), F.col("_next")).alias("near_next"))


def length_partition(size: Column, threshold: float) -> Column:
    """Sets whose Jaccard reaches ``threshold`` are in the same partition or in adjacent ones."""
    return F.floor(F.log(size.cast("double")) / F.lit(-math.log(threshold)) + F.lit(1e-9)).cast("int")


def near_duplicates(docs: DataFrame, threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Pairs of fingerprint classes with Jaccard >= threshold, and their members.

    Returns (a, b, likeness) with a < b, class ids being the smallest doc_id of
    equal fingerprints, and (doc_id, class_id). A pair above the threshold shares
    one of each side's ``size - ceil(threshold * size) + 1`` rarest signatures,
    so only those are joined; the frequencies are counted over all classes.
    """
    rows = with_signatures(docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("_t")), F.col("_t"), "sigs")
    rows = rows.select("doc_id", "sigs", F.sha2(as_text(F.col("sigs")), 256).alias("fp"))
    classes = rows.groupBy("fp").agg(F.min("doc_id").alias("class_id"), F.any_value("sigs").alias("sigs"))
    members = rows.select("doc_id", "fp").join(classes.select("fp", "class_id"), "fp").select("doc_id", "class_id")
    classes = classes.select("class_id", "sigs", length_partition(F.size("sigs"), threshold).alias("part"))
    counts = classes.select(F.explode("sigs").alias("sig")).groupBy("sig").agg(F.count(F.lit(1)).alias("n"))
    ranked = (classes.select("class_id", "part", F.explode("sigs").alias("sig")).join(counts, "sig")
              .groupBy("class_id", "part").agg(F.sort_array(F.collect_list(F.struct("n", "sig"))).alias("s")))
    size = F.size("s")
    rare = F.slice("s", 1, size - F.ceil(size * F.lit(threshold) - F.lit(1e-9)).cast("int") + 1)
    keys = ranked.select("class_id", "part", size.alias("size"), F.explode(rare).alias("k")).select(
        "class_id", "part", "size", F.col("k.sig").alias("sig")).filter("sig IS NOT NULL")
    left = keys.select(F.col("class_id").alias("a"), F.col("size").alias("size_a"), "sig",
                       F.explode(F.array("part", F.col("part") + 1)).alias("at"), "part")
    right = keys.select(F.col("class_id").alias("b"), F.col("size").alias("size_b"), "sig", F.col("part").alias("at"))
    found = left.join(right, ["sig", "at"]).filter(
        ((F.col("part") < F.col("at")) | (F.col("a") < F.col("b")))
        & (F.least("size_a", "size_b") >= F.greatest("size_a", "size_b") * F.lit(threshold) - F.lit(1e-9)))
    found = found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    sets = classes.select("class_id", "sigs")
    pairs = (found.join(sets.toDF("a", "sigs_a"), "a").join(sets.toDF("b", "sigs_b"), "b")
             .select("a", "b", likeness(F.col("sigs_a"), F.col("sigs_b"), threshold).alias("likeness"))
             .filter(F.col("likeness") >= threshold))
    return pairs, members
