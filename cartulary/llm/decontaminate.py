"""Benchmark decontamination over a distributed positional inverted index.  DataFrame functions only.

Test items are cut into windows of consecutive words.  Corpus-wide counts of the
test vocabulary tell the rarest terms of each window; the positional index stores
the postings of those terms (document, position).  Postings that stand within a window's
length of each other make pairs (term, term, distance); those that are some window's two
rarest terms at their offsets are the places, each held against the whole phrase.  So a
posting meets its neighbours only, however many windows its term is in.  For proximity
the rarest term's places are held against the spans around them that hold all words of
the window.

Defined cases: null or wordless texts have no words and no window; an item of fewer
words than a window is one window; a null item_id marks words but is not listed;
rows repeated whole give the same result each; empty tables give rows without hits
or no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cartulary.llm.shared import fresh, stash

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of the text after lower-casing A-Z alone; lower() serves where every character is ASCII."""
    low = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(low, GAP), "")


def count_words(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP_ANY_CASE), "")).cast("long")


def _key(docs: DataFrame) -> DataFrame:
    """Rows with a null-free key: equal rows share it, so that a repeated row isn't counted twice."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("k"), F.xxhash64("text").alias("h"), "doc_id", "text")


def windows(items: DataFrame, size: int) -> DataFrame:
    """Distinct windows, written: wid, gram array<string>, n, items (the sorted ids as strings)."""
    w = items.select(F.col("item_id").cast("string").alias("item"), words(F.coalesce("text", F.lit(""))).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    cut = w.select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i, size))).alias("gram"))
    grouped = cut.groupBy("gram").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return stash(grouped.select(F.monotonically_increasing_id().alias("wid"), "gram", F.size("gram").alias("n"), "items"), "windows")


def term_counts(docs: DataFrame, grams: DataFrame) -> DataFrame:
    """Occurrences in all documents of each word of the test items (zero if none)."""
    vocabulary = stash(grams.select(F.explode("gram").alias("term")).distinct(), "vocabulary")
    seen = docs.select(F.explode(words(F.col("text"))).alias("term")).join(vocabulary, "term").groupBy("term").count()
    return vocabulary.join(seen, "term", "left").select("term", F.coalesce("count", F.lit(0)).alias("count"))


def rarest_terms(grams: DataFrame, counts: DataFrame, terms: int) -> DataFrame:
    """Per window its ``terms`` rarest words with their offsets, written: wid, rare (array of off, term, by offset)."""
    spread = grams.select("wid", "n", F.posexplode("gram").alias("off", "term")).join(counts, "term")
    order = Window.partitionBy("wid").orderBy("count", "term", "off")
    ranked = spread.select("*", F.row_number().over(order).alias("part")).where(F.col("part") <= terms)
    return stash(ranked.groupBy("wid").agg(F.array_sort(F.collect_list(F.struct("off", "term"))).alias("rare")), "rarest")


def index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """The positional index of the given terms, written: term, k, h, pos."""
    spread = _key(docs).select("k", "h", F.posexplode(words(F.col("text"))).alias("pos", "term"))
    return stash(spread.join(terms, "term").select("term", "k", "h", "pos"), "postings")


def neighbours(postings: DataFrame, reach: int) -> DataFrame:
    """Pairs of postings of one document at most ``reach`` words apart: k, h, pos, term, other, gap."""
    one = postings.dropDuplicates(["k", "h", "pos"])  # a row that is repeated whole has its postings more than once
    w = Window.partitionBy("k", "h").orderBy("pos")
    after = F.array(*(F.lead(F.struct("pos", "term"), i).over(w) for i in range(1, reach + 1)))
    near = one.select("*", F.filter(after, lambda x: x.isNotNull()).alias("after"))
    pairs = near.select("k", "h", "pos", "term", F.explode("after").alias("x")).select("k", "h", "pos", "term", F.col("x.term").alias("other"), (F.col("x.pos") - F.col("pos")).alias("gap"))
    return pairs.where(F.col("gap") <= reach)


def places_of(postings: DataFrame, rare: DataFrame) -> DataFrame:
    """Where all rarest terms of a window stand at their offsets: k, h, wid, start."""
    x, y = F.col("rare")[0], F.col("rare")[1]
    alone = rare.where("size(rare) = 1").select("wid", x["off"].alias("off"), x["term"].alias("term"))
    found = postings.join(alone, "term")
    reach = rare.agg(F.max(F.try_element_at("rare", F.lit(2))["off"] - x["off"])).first()[0]
    if reach:
        twins = rare.where("size(rare) > 1").select("wid", x["off"].alias("off"), x["term"].alias("term"), y["term"].alias("other"), (y["off"] - x["off"]).alias("gap"))
        columns = ["k", "h", "pos", "wid", "off"]
        found = found.select(*columns).unionByName(neighbours(postings, reach).join(twins, ["term", "other", "gap"]).select(*columns))
    return found.select("k", "h", "wid", (F.col("pos") - F.col("off")).alias("start")).where("start >= 0").distinct()


def matches(docs: DataFrame, grams: DataFrame, slop: int | None = None) -> DataFrame:
    """Occurrences of the windows ``grams``, written: (k, h, start, n, wid), n the words from start on.

    ``slop`` None asks for exact phrases.  A number asks for proximity: all distinct
    words of the window, in any order, among ``n + slop`` consecutive words around its
    rarest word; ``start`` is where those words begin.
    """
    rare = rarest_terms(grams, term_counts(docs, grams), 2 if slop is None else 1)
    postings = index(docs, stash(rare.select(F.explode("rare.term").alias("term")).distinct(), "terms"))
    if slop is None:
        places = places_of(postings, rare).withColumn("pos", F.col("start"))
    else:
        one = rare.select("wid", F.col("rare")[0]["term"].alias("term"), F.col("rare")[0]["off"].alias("off"))
        places = postings.join(one, "term").select("k", "h", "wid", "pos", (F.col("pos") - F.col("off")).alias("start")).distinct()
    listed = places.join(grams.select("wid", "gram", "n"), "wid").groupBy("k", "h").agg(F.collect_list(F.struct("start", "pos", "n", "wid", "gram")).alias("places"))
    texts = _key(docs).join(stash(listed, "places"), ["k", "h"])

    def phrases(w: Column) -> Column:
        return F.filter("places", lambda c: F.slice(w, c["start"] + 1, c["n"]) == c["gram"])

    def spans(w: Column) -> Column:
        def around(c: Column) -> Column:
            first = F.greatest(c["pos"] - c["n"] - slop + 1, F.lit(0))
            held = F.filter(
                F.sequence(first, c["pos"]), lambda i: F.size(F.array_except(c["gram"], F.slice(w, i + 1, c["n"] + slop))) == 0
            )
            return F.transform(held, lambda i: F.struct(i.alias("start"), F.least(c["n"] + slop, F.size(w) - i).alias("n"), c["wid"].alias("wid")))

        return F.flatten(F.transform("places", around))

    # the one-element array binds the words, so that they are cut once a document
    found = F.flatten(F.transform(F.array(words(F.col("text"))), phrases if slop is None else spans))
    return stash(texts.select("k", "h", F.explode(found).alias("m")).select("k", "h", "m.start", "m.n", "m.wid").distinct(), "matches")


def decontaminate(docs: DataFrame, items: DataFrame, size: int = 10) -> DataFrame:
    """Per document row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, item_ids."""
    grams = windows(items, size)
    found = matches(docs, grams)
    before = Window.partitionBy("k", "h").orderBy("start", "n").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("n")
    covered = (
        found.select("k", "h", "start", end.alias("end"), F.max(end).over(before).alias("done"))
        .groupBy("k", "h")
        .agg(F.sum(F.greatest(F.col("end") - F.greatest("start", F.coalesce("done", F.lit(0))), F.lit(0))).alias("n_hit"))
    )
    listed = (
        found.select("k", "h", "wid").distinct().join(grams.select("wid", F.explode("items").alias("item")), "wid")
        .groupBy("k", "h").agg(F.array_sort(F.collect_set("item")).alias("item_ids"))
    )
    hits = stash(covered.join(listed, ["k", "h"], "left"), "hits")
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    sized = _key(docs).select("k", "h", "doc_id", count_words(F.col("text")).alias("n_words"))
    return sized.join(hits, ["k", "h"], "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        ids.alias("item_ids"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, size: int = 10) -> DataFrame:
    """``docs`` with its own columns, without documents that hold a window of a test item."""
    key = fresh(docs, "k", "h")
    bad = matches(docs, windows(items, size)).select(F.col("k").alias(key[0]), F.col("h").alias(key[1])).distinct()
    keyed = docs.select("*", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias(key[0]), F.xxhash64("text").alias(key[1]))
    return keyed.join(stash(bad, "contaminated"), key, "left_anti").drop(*key)
