"""Document fingerprints by spot signatures, with DataFrame functions only.

The most common words of the corpus are anchors. Each anchor of a text, with
the chain of content words that follow it (anchors in between are passed over),
is a spot signature; the set of all is the text's fingerprint. Fingerprints are
partitioned by their number of signatures, since sets whose sizes differ too
much can't be alike, and compared by their Jaccard likeness.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.llm.common import partitions, table, written

TOKEN = r"[\p{L}\p{N}]+"
ANCHORS = 32
#: Documents to a bucket of neighbours in order of doc_id, and the most buckets there are.
BUCKET_ROWS = 1000
COARSE = 64
FINE_MOST = 1024
LIKENESS = 0.8


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), F.lit(0))


def anchors_of(docs: DataFrame, n: int = ANCHORS) -> list[str]:
    """The ``n`` words in most documents of ``docs`` (text), ties by the word."""
    words = docs.select(F.explode(F.array_distinct(tokens(F.col("text")))).alias("word"))
    return [r["word"] for r in words.groupBy("word").count().orderBy(F.col("count").desc(), "word").limit(n).collect()]


def with_signatures(rows: DataFrame, texts: dict[str, str], anchors: list[str]) -> DataFrame:
    """``rows`` with the sorted signature hashes (8 hex digits each) of its text columns: {text column: new column}.

    The start of a text is an anchor too, so any text with a word has a
    signature; a chain cut short by the end of the text counts as it is. The
    columns are built in steps, each used more than once by the next, so that
    each step is computed once.
    """
    is_anchor = lambda w: w.isin(*anchors) if anchors else F.lit(False)
    rows = rows.withColumns({f"__w_{o}": tokens(F.col(t)) for t, o in texts.items()})
    rows = rows.withColumns(
        {f"__c_{o}": F.filter(f"__w_{o}", lambda w: ~is_anchor(w)) for o in texts.values()}
        | {f"__a_{o}": F.filter(F.transform(f"__w_{o}", lambda w, i: F.when(is_anchor(w), i)), lambda i: i.isNotNull()) for o in texts.values()}
    )

    def signatures(o):
        words, content = F.col(f"__w_{o}"), F.col(f"__c_{o}")
        # The j-th anchor (from 0) at word i has i - j content words before it.
        spots = F.transform(f"__a_{o}", lambda i, j: F.concat_ws(" ", F.get(words, i), F.get(content, i - j), F.get(content, i - j + 1)))
        start = F.when(F.size(words) > 0, F.array(F.concat_ws(" ", F.lit("^"), F.get(content, F.lit(0)), F.get(content, F.lit(1))))).otherwise(F.array().cast("array<string>"))
        return F.sort_array(F.array_distinct(F.transform(F.concat(start, spots), lambda s: F.substring(F.md5(s), 1, 8))))

    rows = rows.withColumns({o: signatures(o) for o in texts.values()})
    return rows.drop(*[f"__{k}_{o}" for k in "wca" for o in texts.values()])


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard likeness of two signature arrays, 1 for two empty ones.

    Pruned by length: where the sizes alone keep it under ``least``, it is 0
    without a comparison.
    """
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    both = F.size(F.array_intersect(a, b))
    exact = both.cast("double") / (F.size(a) + F.size(b) - both)
    return F.when(large == 0, F.lit(1.0)).when(small < F.lit(least) * large, F.lit(0.0)).otherwise(exact)


def similar_pairs(docs: DataFrame, least: float = LIKENESS, anchors: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Membership (doc_id, class_id, class_key) and pairs (a, b, likeness, a_key, b_key) of ``docs`` (doc_id, text): fingerprints alike by ``least`` or more.

    Documents with equal fingerprints are one class, named by its smallest
    doc_id (null only if it has no other) and known by the MD5 of the
    fingerprint, so that texts under one id, or under none, stay apart. Pairs
    are of classes, a_key < b_key; those without signatures are in none. Sets of
    sizes in [least**-p, least**-(p+1)) are in partition p, and meet only p and
    p + 1. Within a partition two sets meet at a signature among the rarest ones
    of both, of which two alike sets must share one. Texts count whole; an empty
    table gives no rows; other columns are ignored.
    """
    anchors = anchors_of(docs) if anchors is None else anchors
    sets = with_signatures(docs.select("doc_id", "text"), {"text": "sigs"}, anchors).select("doc_id", F.md5(F.array_join("sigs", "").cast("binary")).alias("class_key"), "sigs")
    # Signatures travel as numbers of 4 bytes, classes under a short number of their own.
    sets = written(sets.withColumn("sigs", F.transform("sigs", lambda s: (F.conv(s, 16, 10).cast("long") - (1 << 31)).cast("int"))), "spotsigs")
    classes = written(sets.groupBy("class_key").agg(F.min("doc_id").alias("class_id"), F.first("sigs").alias("sigs")).withColumn("c", F.monotonically_increasing_id()), "spotsig-classes")
    # Written, so that joins by class shuffle both sides and can split a class of very many documents.
    members = sets.select("doc_id", F.col("class_key").alias("__k")).join(classes.select("class_key", "class_id"), F.col("__k") == F.col("class_key")).select("doc_id", "class_id", "class_key")
    sized = classes.filter(F.size("sigs") > 0).select("c", F.size("sigs").alias("n"), "sigs")
    # Rarest first: counted over all classes; a set posts only as many as it may miss, and one more. What only one
    # class has comes first of all and meets nothing, so those with others are numbered from behind it.
    known = written(sized.select(F.explode("sigs").alias("__sig")).groupBy("__sig").agg(F.count("*").alias("k")).filter("k > 1"), "spotsig-counts")
    shared = sized.select("c", "n", F.explode("sigs").alias("sig")).join(known, F.col("sig") == F.col("__sig")).drop("__sig")
    own = Window.partitionBy("c")
    shared = shared.withColumn("at", F.row_number().over(own.orderBy("k", "sig")) + F.col("n") - F.count("*").over(own))
    rare = written(shared.filter(F.col("at") <= F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1).select("c", "n", "sig"), "spotsig-prefixes")
    rare = rare.withColumn("part", F.floor(F.log(F.col("n").cast("double")) / F.lit(-math.log(least)) + 1e-9))
    other = rare.select(F.col("sig").alias("__sig"), F.col("c").alias("d"), F.col("n").alias("nd"), F.explode(F.array(F.col("part"), F.col("part") - 1)).alias("__part"), F.col("part").alias("pd"))
    near = rare.join(other, (F.col("sig") == F.col("__sig")) & (F.col("part") == F.col("__part"))).filter((F.col("c") != F.col("d")) & ((F.col("pd") > F.col("part")) | (F.col("c") < F.col("d"))))
    near = near.filter(F.least("n", "nd") >= F.greatest("n", "nd") * least - 1e-9).select(F.least("c", "d").alias("__x"), F.greatest("c", "d").alias("__y")).distinct()
    side = lambda name: classes.select(F.col("c").alias(f"__{name}"), F.struct("class_key", "class_id").alias(name), F.col("sigs").alias(f"sigs_{name}"))
    pairs = near.join(side("x"), "__x").join(side("y"), "__y").select("x", "y", likeness(F.col("sigs_x"), F.col("sigs_y"), least).alias("likeness")).filter(F.col("likeness") >= least)
    # By the order of the keys, which start the structs.
    pairs = pairs.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"), "likeness").select(F.col("x.class_id").alias("a"), F.col("y.class_id").alias("b"), "likeness", F.col("x.class_key").alias("a_key"), F.col("y.class_key").alias("b_key"))
    return members, pairs


def with_next(docs: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``docs`` (doc_id, text) dealt into buckets of neighbours by descending doc_id, with guests.

    Columns __bucket, __guest, __key, __hash are added. The guest of a bucket is
    the first row of the next one (of the first one, for the last), so that every
    row but the guest has its successor in its bucket. Null ids come last, in
    buckets of their own; rows with the same id, null ones too, are ordered by a
    hash of the text.
    """
    rows = docs.select("doc_id", "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("__key"), F.xxhash64("text").alias("__hash"))
    marks, ids = [i / COARSE for i in range(1, COARSE)], F.col("doc_id").cast("long")
    found = rows.agg(F.count("*").alias("n"), F.count(ids).alias("known"), F.min(ids).alias("low"), F.max(ids).alias("high"), F.percentile_approx(ids, marks, 10_000).alias("marks")).first()
    n = found["known"]
    fine = max(1, min(FINE_MOST, n // (COARSE * bucket_rows)))
    edges = [found["low"], *sorted(set(found["marks"]) - {found["low"]}), found["high"] + 1] if n else [0, 1]
    if n <= bucket_rows:
        edges = [edges[0], edges[-1]]
    # Ranges of equal counts, each divided evenly; both keep the order of ids. Offsets are doubles, as those of far ids exceed a BIGINT.
    bucket = None
    for i in range(len(edges) - 1, 0, -1):
        low, high = edges[i - 1], edges[i]
        inner = F.lit(0) if fine == 1 or high - low < 2 else F.least(F.floor((F.col("__key").cast("double") - float(low)) * fine / float(high - low)), F.lit(fine - 1)).cast("int")
        bucket = (i - 1) * fine + inner if bucket is None else F.when(F.col("__key") < high, (i - 1) * fine + inner).otherwise(bucket)
    # Null ids have buckets below all others, by the hash that orders them.
    nulls = max(1, min(COARSE * FINE_MOST, (found["n"] - n) // bucket_rows))
    share = F.least(F.floor((F.col("__hash").cast("double") + float(1 << 63)) * nulls / float(1 << 64)), F.lit(nulls - 1))
    bucket = F.when(F.col("doc_id").isNull(), share - nulls).otherwise(bucket)
    rows = rows.withColumn("__bucket", bucket.cast("int"))
    # At most 2 * COARSE * FINE_MOST rows of 24 bytes are broadcast.
    first = rows.groupBy("__bucket").agg(F.max(F.struct("__key", "__hash")).alias("top"))
    order = Window.orderBy("__bucket")
    guests = first.select(F.coalesce(F.lead("__bucket").over(order), F.first("__bucket").over(order)).alias("__to"), F.col("top.__key").alias("__gk"), F.col("top.__hash").alias("__gh"))
    rows = rows.join(F.broadcast(guests), (F.col("__key") == F.col("__gk")) & F.col("__hash").eqNullSafe(F.col("__gh")), "left")
    place = lambda b, g: F.struct(F.col(b).alias("__bucket"), F.lit(g).alias("__guest"))
    places = F.when(F.col("__to").isNotNull(), F.array(place("__bucket", False), place("__to", True))).otherwise(F.array(place("__bucket", False)))
    return rows.select("doc_id", "text", "__key", "__hash", F.explode(places).alias("__p")).select("doc_id", "text", "__key", "__hash", "__p.__bucket", "__p.__guest")


def neighbours(docs: DataFrame, anchors: list[str] | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row of ``docs`` (doc_id, text).

    The next document is that of the next smaller doc_id, after the last the
    first one; a lone document is its own next. The edited text is the text with
    its last floor(n_chars / 2) characters replaced by as many first ones (or
    all) of the next text. A fingerprint is its signature hashes in order, 8 hex
    digits each; texts without words, null ones too, have an empty one, and two
    empty ones are alike by 1. Other columns are ignored; an empty table gives
    no rows.
    """
    anchors = anchors_of(docs) if anchors is None else anchors
    rows = with_next(docs).withColumn("text", F.coalesce("text", F.lit("")))
    rows = rows.repartition(partitions(docs.sparkSession), "__bucket")
    rows = with_signatures(rows, {"text": "sigs"}, anchors)
    after = Window.partitionBy("__bucket").orderBy("__guest", F.col("__key").desc(), F.col("__hash").desc())
    rows = rows.withColumn("next_text", F.lead("text").over(after)).withColumn("next_sigs", F.lead("sigs").over(after)).filter(~F.col("__guest"))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), "sigs", "next_sigs", F.concat(F.substr("text", F.lit(1), n - half), F.substr("next_text", F.lit(1), half)).alias("edited"))
    rows = with_signatures(rows, {"edited": "edited_sigs"}, anchors)
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.array_join("sigs", "").alias("fingerprint"),
        F.array_join("edited_sigs", "").alias("edited_fingerprint"),
        likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
        likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"),
    )


def op2_spotsigs(spark, sf_dir: str) -> DataFrame:
    return neighbours(table(spark, sf_dir, "documents").select("doc_id", "text"))


def spotsig_pairs(spark, sf_dir: str) -> DataFrame:
    """Pairs of classes of documents whose fingerprints are alike by LIKENESS, the smaller id first, and how many documents each has."""
    members, pairs = similar_pairs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    sizes = members.groupBy("class_id").agg(F.count("*").alias("n"))
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.round("likeness", 6).alias("likeness"))
    return pairs.join(sizes.select(F.col("class_id").alias("a"), F.col("n").alias("docs_a")), "a").join(sizes.select(F.col("class_id").alias("b"), F.col("n").alias("docs_b")), "b").select("a", "b", "likeness", "docs_a", "docs_b")


OP2_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents),
a AS (SELECT list(word) AS anchors FROM (SELECT word, count(*) AS n FROM (SELECT unnest(list_distinct(w)) AS word FROM d) GROUP BY word ORDER BY n DESC, word LIMIT 32)),
e0 AS (SELECT doc_id, text, length(text) AS n, coalesce(lead(text) OVER (ORDER BY doc_id DESC), first(text) OVER (ORDER BY doc_id DESC)) AS next_text,
              coalesce(lead(doc_id) OVER (ORDER BY doc_id DESC), first(doc_id) OVER (ORDER BY doc_id DESC)) AS next_id FROM d),
e AS (SELECT doc_id, n, next_id, substr(text, 1, n - n // 2) || substr(next_text, 1, n // 2) AS edited FROM e0),
t AS (SELECT 0 AS kind, doc_id, w FROM d UNION ALL SELECT 1, doc_id, regexp_extract_all(lower(edited), '[\p{L}\p{N}]+') FROM e),
c AS (SELECT kind, doc_id, w, list_filter(w, lambda x: NOT list_contains(anchors, x)) AS content,
             list_filter(range(1, len(w) + 1), lambda i: list_contains(anchors, w[i])) AS marks FROM t, a),
s AS (SELECT kind, doc_id, CASE WHEN len(w) > 0 THEN list_sort(list_distinct(list_transform(list_concat([concat_ws(' ', '^', content[1], content[2])],
             list_transform(marks, lambda i, j: concat_ws(' ', w[i], content[i - j + 1], content[i - j + 2]))), lambda x: substr(md5(x), 1, 8)))) ELSE [] END AS sigs FROM c),
p AS (SELECT e.doc_id, e.n AS n_chars, sha256(edited) AS edited_sha256, o.sigs AS sigs, x.sigs AS edited_sigs, y.sigs AS next_sigs FROM e
      JOIN s o ON o.doc_id = e.doc_id AND o.kind = 0 JOIN s x ON x.doc_id = e.doc_id AND x.kind = 1 JOIN s y ON y.doc_id = e.next_id AND y.kind = 0),
k AS (SELECT *, len(list_intersect(sigs, edited_sigs)) AS ie, len(list_intersect(sigs, next_sigs)) AS i2 FROM p)
SELECT doc_id, CAST(n_chars AS BIGINT) AS n_chars, edited_sha256, array_to_string(sigs, '') AS fingerprint, array_to_string(edited_sigs, '') AS edited_fingerprint,
       CASE WHEN len(sigs) + len(edited_sigs) = 0 THEN 1.0::DOUBLE ELSE ie::DOUBLE / (len(sigs) + len(edited_sigs) - ie) END AS near_edited,
       CASE WHEN len(sigs) + len(next_sigs) = 0 THEN 1.0::DOUBLE ELSE i2::DOUBLE / (len(sigs) + len(next_sigs) - i2) END AS near_next
FROM k
"""

#: Every class against every other one.
PAIRS_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents),
a AS (SELECT list(word) AS anchors FROM (SELECT word, count(*) AS n FROM (SELECT unnest(list_distinct(w)) AS word FROM d) GROUP BY word ORDER BY n DESC, word LIMIT 32)),
c AS (SELECT doc_id, w, list_filter(w, lambda x: NOT list_contains(anchors, x)) AS content, list_filter(range(1, len(w) + 1), lambda i: list_contains(anchors, w[i])) AS marks FROM d, a),
s AS (SELECT doc_id, list_sort(list_distinct(list_transform(list_concat([concat_ws(' ', '^', content[1], content[2])], list_transform(marks, lambda i, j: concat_ws(' ', w[i], content[i - j + 1], content[i - j + 2]))), lambda x: substr(md5(x), 1, 8)))) AS sigs FROM c WHERE len(w) > 0),
k AS (SELECT sigs, len(sigs) AS n, min(doc_id) AS id, count(*) AS docs FROM s GROUP BY sigs),
p AS (SELECT x.id AS a, y.id AS b, x.docs AS docs_a, y.docs AS docs_b, x.n + y.n AS total, len(list_intersect(x.sigs, y.sigs)) AS i FROM k x JOIN k y ON x.id < y.id AND x.n >= 0.8 * y.n - 1 AND y.n >= 0.8 * x.n - 1)
SELECT a, b, round(i / (total - i), 6) AS likeness, docs_a, docs_b FROM p WHERE i >= 0.8 * (total - i)
"""
