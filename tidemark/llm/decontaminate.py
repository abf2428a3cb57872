"""Benchmark decontamination as a prefix-filtered join, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import cut_lineage, free_name

WINDOW = 13
SHINGLE = 3
# Windows are sent to every task only below this many bytes, which are counted; beyond it their joins shuffle.
SEND_BYTES = 32 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# One in so many words must be hit for a document to count as contaminated.
SHARE = 20


def words_of(text: str | Column) -> Column:
    """Words: runs of a-z after lower-casing A-Z, 0-9, and anything beyond ASCII; none for null."""
    lowered = F.translate(F.coalesce(text if isinstance(text, Column) else F.col(text), F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(lowered, F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), 0)


def _shingles(words: Column, size: Column | int) -> Column:
    """A shingle for every position, joined by spaces; null where fewer than `size` words are left."""
    size = F.lit(size) if isinstance(size, int) else size
    return F.transform(words, lambda w, i: F.when(i + size <= F.size(words), F.concat_ws(" ", F.slice(words, i + 1, size))))


def item_windows(benchmark: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """Distinct (item, words): all runs of `window` words, or the whole item if it has fewer, but not none. All items without id count as one."""
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), words_of(text).alias("w"))
    items = items.filter(F.size("w") > 0)
    n = F.greatest(F.size("w") - F.lit(window), F.lit(0))
    return items.select("item", F.explode(F.transform(F.sequence(F.lit(0), n), lambda i: F.slice("w", i + 1, window))).alias("words")).distinct()


def window_hits(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_id: str = "item_id",
                item_text: str = "text", window: int = WINDOW) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Occurrences (key, start, len, window_id) of item windows in documents, (window_id, item), and (key, n_words) of every document.

    Set join with a prefix filter. The tokens of a window are its shingles of three words (fewer
    if the window is shorter). A document holds a window only if it holds all its shingles, so the
    one rarest shingle is the necessary prefix: shingles are ordered by how often the documents hold
    them, and only the rarest of each window is joined. Length and position bounds follow: the
    window must fit between the document's first and last word around the place where the shingle
    was found, and the stretch of known shingles there must be as long as the window. What is left
    is compared shingle by shingle over the whole window, which is equality of all its words.
    Texts are cut into words once: shingles are rows of neighbouring words, and the first row of each
    document carries its number of words through the join.
    """
    pairs = cut_lineage(item_windows(benchmark, item_id, item_text, window).select(
        "item", "words", F.least(F.size("words"), F.lit(SHINGLE)).alias("k")), "windows")
    numbered = pairs.select("words", "k").distinct().select("words", "k", F.sha2(F.concat_ws(" ", "words"), 256).alias("window_id"))
    grams = numbered.select("window_id", "k", F.filter(_shingles(F.col("words"), F.col("k")), lambda g: g.isNotNull()).alias("grams"))
    shingle = [f"w{i}" for i in range(SHINGLE)]
    vocabulary = numbered.select("k", F.explode(F.filter(_shingles(F.col("words"), F.col("k")), lambda g: g.isNotNull())).alias("gram")).distinct()
    split = F.split("gram", " ")
    vocabulary = vocabulary.select("k", "gram", *[F.coalesce(F.get(split, F.lit(i)), F.lit("")).alias(c) for i, c in enumerate(shingle)])
    # The widest side that is sent holds all windows with all their shingles.
    bytes_of = F.octet_length(F.concat_ws(" ", "grams")) + 24 * F.size("grams")
    sizes = grams.groupBy("k").agg(F.sum(bytes_of).alias("bytes")).orderBy("k").collect()
    known = sum(r["bytes"] for r in sizes)

    def sent(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if known <= SEND_BYTES else df

    kinds = [r["k"] for r in sizes] or [SHINGLE]
    words = docs.select(F.col(key).alias("key"), words_of(text).alias("w"))
    after = F.arrays_zip(*[F.slice("w", i + 1, F.greatest(F.size("w"), F.lit(1))).alias(c) for i, c in enumerate(shingle)])
    # The number of words is taken beside the rows' array, so that no row carries all words.
    rows = words.select("key", F.size("w").cast("long").alias("n"), after.alias("rows"))
    rows = rows.select("key", "n", F.posexplode_outer("rows").alias("pos", "at")).select("key", "n", "pos", "at.*")
    # Rows of documents without words join with nothing, and apart from each other.
    lone = F.concat(F.lit("\0"), F.coalesce(F.col("key").cast("string"), F.lit("")))
    rows = rows.withColumn("w0", F.coalesce("w0", lone)).withColumn("carries", F.coalesce(F.col("pos") == 0, F.lit(True)))
    sizes_of = [F.struct(F.lit(k).alias("k"), *[(F.coalesce(F.col(c), F.lit("")) if i < k else F.lit("")).alias(c) for i, c in enumerate(shingle)],
                         (F.col("carries") & F.lit(k == kinds[0])).alias("carries")) for k in kinds]
    rows = rows.select("key", "n", "pos", (F.explode(F.array(*sizes_of)) if len(kinds) > 1 else sizes_of[0]).alias("g"))
    found = rows.select("key", "n", "pos", "g.*").join(sent(vocabulary), ["k", *shingle], "left")
    met = F.col("gram").isNotNull() & F.col("key").isNotNull()
    found = found.select("key", "n", "pos", "k", F.when(met, F.col("gram")).alias("gram"), "carries")
    found = cut_lineage(found.filter(F.col("carries") | F.col("gram").isNotNull()), "postings")
    postings, lengths_of = found.filter("gram IS NOT NULL"), found.filter("carries").select("key", F.col("n").alias("n_words"))

    counts = postings.groupBy("gram").agg(F.count("*").alias("freq"))
    places = grams.select("window_id", "k", "grams", F.posexplode("grams").alias("offset", "gram")).join(counts, "gram")
    rarest = places.groupBy("window_id").agg(
        F.min(F.struct("freq", "offset")).alias("first"), F.count("*").alias("seen"), F.first("grams").alias("grams"))
    # A window with a shingle that no document holds occurs nowhere.
    rarest = rarest.filter(F.col("seen") == F.size("grams")).select(
        "window_id", "grams", F.col("first.offset").alias("offset"),
        F.element_at("grams", F.col("first.offset") + 1).alias("gram"))

    # Stretches of consecutive known shingles; a window's shingles lie in one stretch.
    by = Window.partitionBy("key", "k").orderBy("pos")
    shortest = grams.filter(F.col("k") == SHINGLE).agg(F.min(F.size("grams"))).first()[0] or 1
    fewest = F.when(F.col("k") == SHINGLE, F.lit(shortest)).otherwise(F.lit(1))
    runs = postings.withColumn("run", F.col("pos") - F.dense_rank().over(by))
    runs = runs.groupBy("key", "k", "run").agg(F.array_sort(F.collect_set(F.struct("pos", "gram"))).alias("at"))
    runs = runs.filter(F.size("at") >= fewest).select("key", "at.pos", "at.gram")
    around = F.transform("gram", lambda g, i: F.struct(
        F.element_at("pos", i + 1).alias("pos"), g.alias("gram"),
        F.slice("gram", F.greatest(i - (window - 1), F.lit(0)) + 1, 2 * window).alias("near"),
        F.least(i, F.lit(window - 1)).alias("left")))
    spots = runs.select("key", F.explode(around).alias("s")).select("key", "s.*")
    start = F.col("left") - F.col("offset")
    fits = (start >= 0) & (start + F.size("grams") <= F.size("near"))
    same = F.slice("near", F.greatest(start, F.lit(0)) + 1, F.size("grams")) == F.col("grams")
    hits = spots.join(sent(rarest), "gram").filter(fits & same)
    hits = hits.select("key", (F.col("pos") - F.col("offset")).alias("start"), "window_id")
    lengths = numbered.select("window_id", F.size("words").alias("len"))
    hits = hits.join(sent(lengths), "window_id")
    owners = pairs.select(F.sha2(F.concat_ws(" ", "words"), 256).alias("window_id"), "item")
    return hits, owners, lengths_of


def _covered(spans: Column) -> Column:
    """Number of positions in the union of (start, stop) spans."""
    zero = F.struct(F.lit(-1).alias("upto"), F.lit(0).cast("long").alias("hit"))
    return F.aggregate(
        F.array_sort(spans), zero,
        lambda a, s: F.struct(
            F.greatest(a["upto"], s["stop"]).alias("upto"),
            (a["hit"] + F.greatest(s["stop"] - F.greatest(a["upto"], s["start"]), F.lit(0))).alias("hit")),
        lambda a: a["hit"])


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per document: (key, n_words, n_hit, n_items, items, contaminated).

    A word is hit if it lies in any occurrence of an item's window. `items` holds the ids of the
    items with an occurrence, as sorted strings. A document is contaminated if at least one word
    in SHARE is hit. Null and empty texts have no words and are never contaminated; items without
    words have no window. All items without an id count as one in `n_items` and are not listed. A
    document without a key gives a row without hits. Repeated rows each give a row, with the hits of their key.
    """
    hits, owners, every = window_hits(docs, benchmark, key, text, item_id, item_text, window)
    hits = cut_lineage(hits, "hits")
    spans = hits.groupBy("key").agg(F.collect_set(F.struct("start", (F.col("start") + F.col("len")).alias("stop"))).alias("spans"))
    spans = spans.select("key", _covered(F.col("spans")).alias("n_hit"))
    named = hits.select("key", "window_id").distinct().join(owners, "window_id").groupBy("key").agg(
        F.array_sort(F.collect_set("item")).alias("items"), F.max(F.col("item").isNull().cast("long")).alias("nameless"))
    rows = every.join(spans, "key", "left").join(named, "key", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return rows.select(
        "key", "n_words", n_hit.alias("n_hit"), (F.size(items) + F.coalesce("nameless", F.lit(0))).cast("long").alias("n_items"), items.alias("items"),
        ((n_hit > 0) & (n_hit * SHARE >= F.col("n_words"))).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """All rows and columns of `docs` but for contaminated documents; rows without a key stay."""
    hidden = free_name(docs, "contaminated_key")
    bad = contamination(docs, benchmark, key, text, item_id, item_text)
    bad = bad.filter("contaminated").select(F.col("key").alias(hidden))
    return docs.join(bad, docs[key] == bad[hidden], "left_anti")
