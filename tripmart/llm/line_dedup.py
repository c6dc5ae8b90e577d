"""Operator 2: fuzzy line dedup by MinHash.

A line's shingles are the ``SHINGLE`` characters from each of its characters on;
a line without a whole one is its own.  Equal
lines collapse first.  Every distinct line gets ``BANDS * ROWS`` minima of its
shingle hashes, each in an order of its own; lines that agree on a whole band are compared, and a pair links when the
exact Jaccard similarity of the shingle sets is at least ``THRESHOLD``.  A
distributed union-find makes components, and the line with the smallest
(doc_id, line number, row) of each stays.

Within a band's bucket every line is compared with the bucket's most popular line,
the one whose bands are shared most often: of a family of edited copies that is the
line they were made from.  These links make components.  A line that is not similar
to its bucket's popular line then meets the lines of other components that have this
hub too, so that no link between two components of a bucket is missed, by a prefix
filter over the shingles in which line and hub differ: two lines of a hub differ in
what just one of them differs in from it, so similar ones share many of the rarest of
these.  What copies of the hub have from it takes no part, so they meet only where
they share an edit, and a pair is made once for all the shingles it shares.  At the
threshold itself the bands miss ``(1 - 0.8^3)^7`` = 0.7 % of the pairs, at 0.9 one
in 15,000.

Lines without a word are never dropped.  Null texts have no lines.  Every row has
an id of its own, by which lines are dropped: rows that repeat a doc_id or have
none lose only their own.  A null doc_id counts as the smallest.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import connected_components, numbered, stage

SHINGLE = 10
ROWS = 3
BANDS = 7
THRESHOLD = 0.8
PIECE = 32                  # places of a line whose shingles are cut from one piece
WIDE, BYTES = "UTF-32", 4   # an encoding of as many bytes for each character
AT_ONCE = 16                # shingles of a line hashed in one row
WORDS = 4                   # longs of parities that a line is told apart by
BEFORE = 4                  # places before a shared shingle that tell whether it is the first
SLACK = 1e-9                # bounds on counts stay safe from rounding


def _masks(n: int) -> list[int]:
    return [int.from_bytes(hashlib.md5(str(i).encode()).digest()[:8], "big", signed=True) for i in range(n)]


def _pieces(line: Column, size: int) -> Column:
    """Pieces of which each shingle of the line is in one, none for a line without a whole one.

    Finding a place in UTF-8 walks there from the start, so shingles are cut from
    pieces: the cost stays linear in the line.
    """
    return F.regexp_extract_all(line, F.lit(rf"(?s)(?=(.{{{size},{PIECE + size - 1}}})).{{1,{PIECE}}}"), F.lit(1))


def shingles(line: Column, size: int = SHINGLE) -> Column:
    """``size`` characters from every character on, as far as the line has them; else the line."""
    pieces = _pieces(line, size)
    found = F.flatten(F.transform(pieces, lambda p: F.transform(
        F.sequence(F.lit(1), F.length(p) - (size - 1)), lambda i: F.substring(p, i, F.lit(size)))))
    return F.when(F.size(pieces) > 0, found).otherwise(F.array(line))


def shingle_hashes(distinct: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``h1, h2, s``: a row with the hash of each of the line's ``shingles``."""
    pieces = _pieces(F.col("line"), size)
    whole = F.array("line")
    cut = distinct.select("h1", "h2", F.explode(F.when(F.size(pieces) > 0, pieces).otherwise(whole)).alias("p"))
    last = F.greatest(F.length("p") - (size - 1), F.lit(1))
    return cut.select("h1", "h2", "p", F.explode(F.sequence(F.lit(1), last)).alias("at")).select(
        "h1", "h2", F.xxhash64(F.substring(F.col("p"), F.col("at"), F.lit(size))).alias("s"))


def hash_rows(distinct: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``h1, h2, s0, s1, ..``: the hashes of ``shingle_hashes``, ``AT_ONCE`` in a row, the last row filled
    up with its piece's last one.

    A line without wide characters is one piece: its places are bytes and need no walk.
    Cutting and hashing run in generated code, and no line's shingles are held at once.
    What each piece needs is in an array, so that it is made once and not for each row.
    """
    line = F.col("line")
    whole = (F.length(line) == F.octet_length(line)) | (F.length(line) < size)
    parts = F.transform(F.when(whole, F.array(line)).otherwise(_pieces(line, size)), lambda p: F.struct(
        p.alias("p"), p.cast("binary").alias("bytes"), F.length(p).alias("n")))
    cut = distinct.select("h1", "h2", F.inline(parts)).select(
        "*", F.greatest(F.col("n") - (size - 1), F.lit(1)).alias("last"))
    first = cut.select("*", F.explode(F.sequence(F.lit(1), F.col("last"), F.lit(AT_ONCE))).alias("at"))

    def hashed(k: int) -> Column:
        at = F.least(F.col("at") + k, F.col("last"))
        return F.xxhash64(F.when(F.octet_length("bytes") == F.col("n"), F.substring(F.col("bytes"), at, F.lit(size)))
                          .otherwise(F.substring(F.col("p"), at, F.lit(size)).cast("binary")))

    return first.select("h1", "h2", *[hashed(k).alias(f"s{k}") for k in range(AT_ONCE)])


def _minimum(r: int, mask: int) -> Column:
    """Smallest hash in one of many orders: rows of a band look at different bits (a
    rotation), bands at different values of them (a mask)."""
    def order(s: Column) -> Column:
        turn = 64 // ROWS * r
        turned = F.shiftleft(s, turn).bitwiseOR(F.shiftrightunsigned(s, 64 - turn)) if turn else s
        return turned.bitwiseXOR(F.lit(mask))

    return F.min(F.least(*[order(F.col(f"s{k}")) for k in range(AT_ONCE)]))


def lines_of(rows: DataFrame) -> DataFrame:
    """``row, doc_id, line_no, line``, h1, h2 (128 bits that name the line), for lines with a word."""
    lines = rows.select("row", "doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return lines.where(F.col("line").rlike(r"\S")).withColumns(
        {"h1": F.xxhash64("line"), "h2": F.xxhash64(F.lit(1), "line")})


def sketches(lines: DataFrame, size: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """Distinct lines ``(h1, h2, line)`` and, for each, ``(h1, h2, id, bands)``.

    The distinct lines are written in buckets of (h1, h2): what groups or joins
    them by that name later needs no further exchange of texts.
    """
    distinct = _bucketed(lines.groupBy("h1", "h2").agg(F.first("line").alias("line")))
    hashes = hash_rows(distinct, size)
    masks = _masks(ROWS * BANDS)
    minima = hashes.groupBy("h1", "h2").agg(
        *[_minimum(i % ROWS, m).alias(f"m{i}") for i, m in enumerate(masks)])
    bands = F.array(*[F.xxhash64(F.lit(b), *[F.col(f"m{b * ROWS + r}") for r in range(ROWS)]) for b in range(BANDS)])
    return distinct, stage(minima.select("h1", "h2", F.monotonically_increasing_id().alias("id"),
                                         bands.alias("bands")), "line-sketches")


def _bucketed(distinct: DataFrame) -> DataFrame:
    """Write in buckets of (h1, h2) below the shared folder; the catalogue forgets the
    name at once, the frame keeps the files and their layout."""
    spark = distinct.sparkSession
    name = f"lines_{uuid.uuid4().hex[:12]}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    distinct.write.bucketBy(n, "h1", "h2").option("path", f"{ensure_checkpoint_dir(spark)}/llm/{name}").option(
        "compression", "zstd").saveAsTable(name)
    frame = spark.read.table(name)
    spark.sql(f"DROP TABLE {name}")
    return frame


def buckets(sketched: DataFrame) -> DataFrame:
    """``bucket, id, low``: members of buckets with two lines or more, and the most
    popular line of each (the member itself left out).

    Popular: the line's buckets hold the most lines in all; the smallest id decides ties.
    A bucket may hold a third of all lines: it is only ever aggregated (map-side
    combined) and joined, which adaptive execution splits.
    """
    rows = sketched.select("id", F.explode("bands").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = stage(rows.join(shared, "bucket").groupBy("id").agg(
        F.sum("n").alias("popular"), F.collect_list("bucket").alias("buckets")).select(
        "id", "popular", F.explode("buckets").alias("bucket")), "line-buckets")
    low = members.groupBy("bucket").agg(F.min(F.struct((-F.col("popular")).alias("order"), "id")).alias("low"))
    return members.join(low.select("bucket", F.col("low.id").alias("low")), "bucket").where(
        "id != low").select("bucket", "id", "low")


def line_texts(ids: DataFrame, named: DataFrame, distinct: DataFrame) -> DataFrame:
    """``id, line`` for distinct ``ids(id)``: texts travel, not the sets, which take eight bytes a character."""
    return stage(named.join(ids, "id", "left_semi").join(distinct, ["h1", "h2"]).select("id", "line"),
                 "line-texts", compression="zstd")


def hashed_shingles(line: Column, size: int) -> Column:
    """The set of the line's shingles, as hashes of their characters in ``BYTES`` bytes each:
    these are found without a walk.  The array of one has the line encoded once, not for each shingle."""
    hashes = F.transform(F.array(F.encode(line, WIDE)), lambda wide: F.transform(
        F.sequence(F.lit(1), F.greatest(F.octet_length(wide) - (BYTES * size - 1), F.lit(1)), F.lit(BYTES)),
        lambda at: F.xxhash64(F.substring(wide, at, F.lit(BYTES * size)))))
    return F.array_distinct(F.get(hashes, F.lit(0)))


def verified(pairs: DataFrame, texts: DataFrame, threshold: float, size: int = SHINGLE) -> DataFrame:
    """``id, low, similar``: exact Jaccard of the two lines' shingle sets for each pair,
    made from the texts where they meet."""
    both = pairs.join(texts, "id").join(texts.toDF("low", "low_line"), "low").select(
        "id", "low", hashed_shingles(F.col("line"), size).alias("set"),
        hashed_shingles(F.col("low_line"), size).alias("low_set"))
    shared = F.size(F.array_intersect("set", "low_set"))
    return both.select("id", "low", (shared >= F.lit(threshold) * (
        F.size("set") + F.size("low_set") - shared)).alias("similar"))


def differences(pairs: DataFrame, texts: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``id, line, unlike, n, set`` for ``pairs(line, hub, unlike)``: an id of the pair, the line's number of
    shingles and the shingles that just one of line and hub has.  Lines of different hubs share none."""
    both = pairs.join(texts.toDF("line", "text"), "line").join(texts.toDF("hub", "hub_text"), "hub").select(
        *pairs.columns, hashed_shingles(F.col("text"), size).alias("own"),
        hashed_shingles(F.col("hub_text"), size).alias("its"))
    differ = F.concat(F.array_except("own", "its"), F.array_except("its", "own"))
    return both.select(F.monotonically_increasing_id().alias("id"), "line", "unlike", F.size("own").alias("n"),
                       F.transform(differ, lambda s: F.xxhash64("hub", s)).alias("set"))


def prefixes(sets: DataFrame, threshold: float) -> DataFrame:
    """``id, n, size, s, at, before``: the shingles of each set, rarest first, that a similar line may share
    first, their places in that order, up to ``BEFORE`` shared ones before each, the line's number of
    shingles and that of its set.

    ``sets(id, set)`` holds whole lines, or with ``n, unlike`` what lines and their hub differ in: two lines of
    a hub differ from each other in what just one of them differs from the hub.  So of sets X and Y similar
    lines share ``(|X| + |Y| - (n + n') * (1 - t) / (1 + t)) / 2`` at least, hence ``|X| - n * (1 - t) / t``, and
    ``|Y| * t / (1 + t)`` if the line of X is unlike the hub.  A whole line is what it differs in from an empty hub.
    Shingles that no other set has count for the places only.
    """
    t = threshold
    if "n" not in sets.columns:
        sets = sets.select("id", "set", F.size("set").alias("n"), F.lit(False).alias("unlike"))
    size = F.size("set")
    least = F.greatest(F.when(~F.col("unlike"), size * F.lit(t / (1 + t))).otherwise(0),
                       size - F.col("n") * F.lit((1 - t) / t)) - SLACK
    each = sets.select("id", "n", size.alias("size"), F.greatest(F.ceil(least).cast("int"), F.lit(1)).alias("least"),
                       F.explode("set").alias("s"))
    often = each.groupBy("s").agg(F.count(F.lit(1)).alias("lines")).where("lines > 1")
    ordered = each.join(often, "s").groupBy("id", "n", "size", "least").agg(
        F.sort_array(F.collect_list(F.struct("lines", "s"))).alias("common"))
    single = F.col("size") - F.size("common")
    length = F.col("size") - F.col("least") + 1
    cut = ordered.withColumn("single", single).where(length > single).select(
        "id", "n", "size", "single", F.slice("common.s", F.lit(1), length - single).alias("first"))
    return cut.select("*", F.posexplode("first").alias("i", "s")).select(
        "id", "n", "size", "s", (F.col("single") + F.col("i")).alias("at"),
        F.slice("first", F.greatest(F.col("i") + 1 - BEFORE, F.lit(1)), F.least("i", F.lit(BEFORE))).alias("before"))


def parities(sets: DataFrame) -> DataFrame:
    """``id, odd``: for each of 64 ``WORDS`` bits whether an odd number of the line's
    shingles falls on it.  Two lines differ in as many shingles at least as in bits."""
    def word(k: int) -> Column:
        return F.aggregate("set", F.lit(0).cast("long"), lambda odd, s: F.when(
            F.pmod(F.shiftright(s, 6), F.lit(WORDS)) == k, odd.bitwiseXOR(F.call_function(
                "shiftleft", F.lit(1).cast("long"), s.bitwiseAND(F.lit(63)).cast("int")))).otherwise(odd))

    return sets.select("id", F.array(*[word(k) for k in range(WORDS)]).alias("odd"))


def further_pairs(places: DataFrame, threshold: float) -> DataFrame:
    """Distinct ``id, low`` (of ``line`` if there is one): lines told ``unlike`` and lines of other components
    that may reach ``threshold``; ``places`` as of ``prefixes`` with ``root``, ``unlike`` and ``odd``.

    If the first shingle that two share is at some place, only those from there on can be
    shared.  A pair is made where the two share a shingle and none of those just before: mostly once,
    not for each shingle.  Lines that differ in more parities than similar ones can differ in
    shingles are left out.
    """
    t = threshold
    line = F.col("line" if "line" in places.columns else "id")
    asked = places.where("unlike").select("s", line.alias("id"), "root", "n", "size", "at", "before", "odd")
    other = places.select("s", *[F.col(c).alias(f"low_{c}") for c in ("root", "n", "size", "at", "before", "odd")],
                          line.alias("low"))
    most = (F.col("n") + F.col("low_n")) * F.lit((1 - t) / (1 + t)) + SLACK
    twice = F.col("size") + F.col("low_size") - most
    may = (2 * (F.col("size") - F.col("at")) >= twice) & (2 * (F.col("low_size") - F.col("low_at")) >= twice)
    alike = (F.col("low_n") >= F.col("n") * t - SLACK) & (F.col("n") >= F.col("low_n") * t - SLACK)
    differ = sum((F.bit_count(F.col("odd")[k].bitwiseXOR(F.col("low_odd")[k])) for k in range(WORDS)), F.lit(0))
    first = ~F.arrays_overlap("before", "low_before")
    return asked.join(other, "s").where(
        (F.col("root") != F.col("low_root")) & alike & may & (differ <= most) & first).select(
        F.greatest("id", "low").alias("id"), F.least("id", "low").alias("low")).distinct()


def similar_lines(sketched: DataFrame, distinct: DataFrame, size: int = SHINGLE,
                  threshold: float = THRESHOLD) -> DataFrame:
    """Links ``a, b`` between ids of distinct lines: enough verified ones to connect all that are similar."""
    named = sketched.select("id", "h1", "h2")
    members = stage(buckets(sketched), "line-members")
    pairs = members.select("id", "low").distinct()
    texts = line_texts(pairs.select("id").union(pairs.select("low")).distinct(), named, distinct)
    result = stage(verified(pairs, texts, threshold, size), "line-pairs")
    roots = stage(connected_components(result.where("similar").select(
        F.col("id").alias("a"), F.col("low").alias("b"))), "line-roots")
    told = stage(members.join(result, ["id", "low"]).select("bucket", "id", "low", "similar"), "line-told")
    open_ = told.groupBy("bucket").agg(F.bool_and("similar").alias("done"), F.count(F.lit(1)).alias("others")).where(
        "not done and others > 1").select("bucket")
    left = told.join(open_, "bucket").select(
        F.col("id").alias("line"), F.col("low").alias("hub"), (~F.col("similar")).alias("unlike")).distinct()
    sets = stage(differences(left, texts, size), "line-sets")
    known = sets.select("id", "line", "unlike").join(roots.withColumnRenamed("node", "line"), "line", "left").select(
        "id", "line", "unlike", F.coalesce("root", "line").alias("root"))
    places = stage(prefixes(sets, threshold).join(known.join(parities(sets), "id"), "id"), "line-places")
    more = stage(further_pairs(places, threshold), "line-further")
    linked = stage(verified(more, texts, threshold, size).where("similar"), "line-pairs")
    return roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(linked.select("id", "low"))


def classes(docs: DataFrame, size: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, line_no, class_doc, class_line, kept`` of every line with a word: its
    class is named by the class's smallest (doc_id, line_no); of rows that share it one keeps the line."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return row_classes(rows, size, threshold).drop("row")


def row_classes(rows: DataFrame, size: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """``row`` and the columns of ``classes`` for ``rows(row, doc_id, text)``.

    Where lines stand is written without their texts, which fixes ids made on the
    way here; the texts are told apart in a pass of their own, by names only.
    """
    lines = stage(lines_of(rows).drop("line"), "line-names", compression="zstd")
    distinct, sketched = sketches(lines_of(rows), size)
    roots = connected_components(similar_lines(sketched, distinct, size, threshold))
    near = sketched.join(roots.withColumnRenamed("node", "id"), "id").select("h1", "h2", "root")
    first = lines.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "line_no", "row")).alias("first"))
    linked = first.join(near, ["h1", "h2"])
    lowest = linked.groupBy("root").agg(F.min("first").alias("low"))
    moved = linked.join(lowest, "root").select("h1", "h2", "low")
    named = first.join(moved, ["h1", "h2"], "left").select("h1", "h2", F.coalesce("low", "first").alias("low"))
    every = lines.join(named, ["h1", "h2"])
    return every.select("row", "doc_id", "line_no", F.col("low.doc_id").alias("class_doc"),
                        F.col("low.line_no").alias("class_line"),
                        ((F.col("low.row") == F.col("row")) & (F.col("low.line_no") == F.col("line_no")))
                        .alias("kept"))


def deduplicated(docs: DataFrame, size: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with the dropped lines taken out of ``text``; all rows and columns stay.

    Drops are gathered per row as line numbers (at most its own lines);
    rows without drops keep their text as it is, nulls included.
    """
    rows = numbered(docs)
    drops = row_classes(rows.select("row", "doc.doc_id", "doc.text"), size, threshold).where("not kept").groupBy("row").agg(
        F.collect_set("line_no").alias("gone"))
    joined = rows.join(drops, "row", "left")
    at = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept = F.array_join(F.transform(at, lambda i: F.get("lines", i)), "\n")
    return joined.withColumn("lines", F.split("doc.text", "\n")).withColumn(
        "kept", F.when(F.col("gone").isNull(), F.col("doc.text")).otherwise(kept)).select(
        *[F.col("kept").alias(c) if c == "text" else F.col(f"doc.`{c}`").alias(c) for c in docs.columns])
