"""Benchmark decontamination: a prefix-filtered join of item windows with documents.

An item's windows are its runs of ``window`` words (a shorter item is one
window). Words are ordered by how often the documents hold them. A document can
only contain a window if it contains the window's rarest word, so that one-word
prefix is what the join looks for. Where it is found, its place in the window
fixes where the window would start; starts outside the document fall away
(length and positional bounds), and the rest is compared word by word.

The join works on words folded by ``lower``, which is coarser than the exact
A-Z folding, so no window is lost; the comparison is exact.

Cases: null and empty texts have no words, no hits, and are not contaminated;
items without words have no window; items with equal windows are all reported;
rows that share a document id, or have none, are each judged by their own words;
an empty benchmark leaves every document clean; other columns pass through and
input columns named like an output are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshwright.llm.common import LOWER, UPPER, let, restored, set_aside, sized, whole_text
from meshwright.session import cut

SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
OUTPUTS = ["n_words", "n_hit", "item_ids", "contaminated"]


def exact_words(text: Column) -> Column:
    """Runs of letters, digits and non-ASCII characters, A-Z lower-cased."""
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), SEPARATORS), "")


def folded(text: Column) -> Column:
    """``lower`` with one small sigma: which one ``lower`` makes depends on the neighbours, across separators too."""
    return F.replace(F.lower(text), F.lit("ς"), F.lit("σ"))


def folded_words(text: Column) -> Column:
    """The same words in the same places, folded further by ``lower``, which is much faster."""
    return F.array_remove(F.split(folded(text), SEPARATORS), "")


def item_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", window: int = 13) -> DataFrame:
    """Distinct windows: ``words`` and the ``items`` that hold them."""
    words = benchmark.select(F.col(item).cast("string").alias("item"), exact_words(whole_text(text)).alias("w"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))
    pieces = words.where((F.size("w") > 0) & F.col("item").isNotNull()).select("item", F.explode(F.transform(
        starts, lambda i: F.slice("w", i + 1, window))).alias("words"))
    return pieces.groupBy("words").agg(F.collect_set("item").alias("items"))


def indexed_windows(docs: DataFrame, windows: DataFrame, text: str = "text", broadcast_rows: int = 1_000_000) -> DataFrame:
    """Each window under its rarest word (ties: the earlier place), with that word's place."""
    lowered = windows.select("words", "items", F.transform("words", folded).alias("folded"))
    vocabulary = sized(lowered.select(F.explode("folded").alias("word")).distinct(), broadcast_rows, "vocabulary")
    seen = (docs.select(F.explode(folded_words(whole_text(text))).alias("word")).join(vocabulary, "word")
            .groupBy("word").agg(F.count("*").alias("n")))
    placed = lowered.select("words", "items", F.posexplode("folded").alias("place", "word")).join(seen, "word", "left")
    # Windows holding a word that no document has cannot occur and fall away here.
    return placed.groupBy("words").agg(
        F.first("items").alias("items"), F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "place", "word")).alias("rarest")
    ).where("rarest.n > 0").select("rarest.word", "rarest.place", "words", "items", F.size("words").alias("length"))


def find_windows(docs: DataFrame, index: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document key and hash of the text (``version``), the places where a window may occur."""
    words = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("version"), folded_words(whole_text(text)).alias("w"))
    places = words.select("key", "version", F.size("w").alias("n"), F.posexplode("w").alias("at", "word"))
    found = places.join(index, "word").withColumn("start", F.col("at") - F.col("place"))
    found = found.where((F.col("start") >= 0) & (F.col("start") + F.col("length") <= F.col("n")))
    return found.groupBy("key", "version").agg(F.collect_set(F.struct("start", "length", "words", "items")).alias("places"))


def covered_words(hits: Column) -> Column:
    """Words inside the union of (start, length) places."""
    state = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end"))
    return F.aggregate(F.array_sort(hits), state, lambda a, h: F.struct(
        (a["n"] + F.greatest(h["start"] + h["length"] - F.greatest(a["end"], h["start"]), F.lit(0))).alias("n"),
        F.greatest(a["end"], h["start"] + h["length"]).alias("end")), lambda a: a["n"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", window: int = 13,
                  share: int = 20, broadcast_rows: int = 1_000_000) -> DataFrame:
    """``docs`` with n_words, n_hit, item_ids (sorted strings) and contaminated.

    A document is contaminated if at least one word in ``share`` is hit. The
    index is broadcast only if it has at most ``broadcast_rows`` rows and a
    bounded number of bytes; beyond that the join shuffles.
    """
    windows = cut(item_windows(benchmark, text=text, window=window), "windows")
    index = sized(indexed_windows(docs, windows, text, broadcast_rows), broadcast_rows, "index")
    places = find_windows(docs, index, key, text)
    rows, inner = set_aside(docs, OUTPUTS)
    body = whole_text(inner[text])
    joined = rows.join(places, F.col(inner[key]).eqNullSafe(F.col("key")) & (F.xxhash64(inner[text]) == F.col("version")), "left")
    exact = F.when(F.col("places").isNotNull(), exact_words(body))
    hits = let(exact, lambda w: F.filter("places", lambda p: F.slice(w, p["start"] + 1, p["length"]) == p["words"]))
    measured = joined.select(*inner.values(), F.size(folded_words(body)).cast("bigint").alias("n_words"), hits.alias("__hits"))
    spans = F.transform("__hits", lambda h: F.struct(h["start"].alias("start"), h["length"].alias("length")))
    items = F.array_sort(F.array_distinct(F.flatten(F.transform("__hits", lambda h: h["items"]))))
    judged = measured.select(
        *restored(inner), "n_words", F.coalesce(covered_words(spans), F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce(items, F.array().cast("array<string>")).alias("item_ids"))
    return judged.withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))
