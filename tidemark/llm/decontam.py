"""Benchmark passages in training text, found by a broadcast hash set of test n-grams.

A window is ``n`` consecutive words of a benchmark item (all of them if it has fewer). The set has a 64-bit hash of each
window, its words and the items that have it. One scan of the documents hashes every window of theirs, of the lengths that the set
has, and looks each up once; where a hash is found the words are compared. Hashes of windows are made of those of their halves, so a scan costs a
few hashes a word.

Everything is built-in functions. The set is sent to the tasks if its bytes, which are counted, are within a bound;
beyond that Spark chooses how to join it, with the same result.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from .common import lower_ascii, stage

#: What separates words: ASCII other than digits and letters.
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same before lower-casing, and what it separates.
_RAW_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Runs of digits, a-z and all non-ASCII characters, after lower-casing A-Z; none for NULL."""
    return F.array_remove(F.split(F.coalesce(lower_ascii(text), F.lit("")), _BETWEEN), "")


def _hashes(rows: DataFrame, sizes: Iterable[int]) -> DataFrame:
    """``rows`` with ``h1``, ``h2``, ...: a hash of every window of so many words of ``w``, by its first word.

    A window's hash is made of those of its two parts, so that it costs the same whatever its length.
    """
    needed, wanted = set(), list(sizes)
    while wanted:
        size = wanted.pop()
        if size not in needed:
            needed.add(size)
            if size > 1:
                wanted += [_half(size), size - _half(size)]
    for size in sorted(needed):
        if size == 1:
            hashed = F.transform("w", lambda x: F.xxhash64(x))
        else:
            half, n = _half(size), F.greatest(F.size("w") - (size - 1), F.lit(0))
            hashed = F.zip_with(F.slice(f"h{half}", 1, n), F.slice(f"h{size - half}", half + 1, n), lambda x, y: F.xxhash64(x, y))
        rows = rows.withColumn(f"h{size}", hashed)
    return rows


def _half(size: int) -> int:
    """The largest power of two below ``size``."""
    return 1 << (size - 1).bit_length() - 1


def grams(benchmark: DataFrame, n: int = 10, id_col: str = "item_id", text_col: str = "text") -> tuple[DataFrame, list[int]]:
    """``hash, gram, items``: the hash set of windows, equal ones of several items once, and the lengths they have.

    A window is ``n`` consecutive words, or all of an item of fewer. Items without an id or words have none.
    """
    items = benchmark.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("w")).filter(F.size("w") > 0)
    items = items.withColumn("k", F.least(F.size("w"), F.lit(n)))
    lengths = sorted(r[0] for r in items.select("k").distinct().collect())  # n at most
    hashed = _hashes(items, lengths)
    mine = F.coalesce(*[F.when(F.col("k") == k, F.col(f"h{k}")) for k in lengths], F.array().cast("array<bigint>"))
    windows = hashed.select("item", "w", "k", F.posexplode(mine).alias("i", "hash"))
    known = windows.groupBy("hash", F.slice("w", F.col("i") + 1, F.col("k")).alias("gram")).agg(F.collect_set("item").alias("items"))
    return stage(known, "decontam-grams"), lengths


def _hits(docs: DataFrame, benchmark: DataFrame, n: int, id_col: str, text_col: str, item_id: str, item_text: str, broadcast_bytes: int) -> DataFrame:
    """A row per document with ``id, row, n_words, runs, found``."""
    known, lengths = grams(benchmark, n, item_id, item_text)
    words_of = F.aggregate("gram", F.lit(0).cast("bigint"), lambda total, x: total + F.octet_length(x) + 16)
    size = known.agg(F.sum(words_of + F.aggregate("items", F.lit(0).cast("bigint"), lambda total, x: total + F.octet_length(x) + 16) + 64)).first()[0] or 0
    few = size <= broadcast_bytes
    rows = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), words(F.col(text_col)).alias("w"))
    rows = _hashes(rows, lengths).withColumn("n_words", F.size("w"))
    every = F.concat(F.array().cast("array<bigint>"), *[F.col(f"h{k}") for k in lengths])
    seen = rows.select("id", "row", "n_words", "w", F.posexplode_outer(every).alias("at", "window"))
    # the windows of a length follow those of the shorter ones
    place, length, before = F.col("at"), F.lit(0), F.lit(0)
    for k in lengths:
        here = F.greatest(F.col("n_words") - (k - 1), F.lit(0))
        length = F.when((F.col("at") >= before) & (F.col("at") < before + here), k).otherwise(length)
        place = F.when(F.col("at") >= before, F.col("at") - before).otherwise(place)
        before = before + here
    if few:  # the words stay where they are and are looked at where a hash is found
        said = F.slice("w", place + 1, length)
        known = F.broadcast(known)
    else:
        seen = seen.select("id", "row", "n_words", "at", "window", F.slice("w", place + 1, length).alias("said"))
        said = F.col("said")
    met = seen.join(known, (F.col("window") == F.col("hash")) & (said == F.col("gram")), "left").select(
        "id", "row", "n_words", "at", "items", F.when(F.col("items").isNotNull(), F.struct(place.alias("start"), (place + length).alias("end"))).alias("run"))
    met = met.filter(F.col("items").isNotNull() | F.col("at").isNull() | (F.col("at") == 0))  # the first window stands for the document
    return met.groupBy("id", "row", "n_words").agg(
        F.collect_set("run").alias("runs"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("found"))


def _covered(runs: Column) -> Column:
    """Places covered by runs from start up to end, each counted once."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n"))

    def add(total: Column, run: Column) -> Column:
        fresh = F.greatest(run["end"] - F.greatest(run["start"], total["end"]), F.lit(0))
        return F.struct(F.greatest(total["end"], run["end"]).alias("end"), (total["n"] + fresh).cast("bigint").alias("n"))

    return F.aggregate(F.array_sort(runs), zero, add, lambda t: t["n"])


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", broadcast_bytes: int = 64 << 20) -> DataFrame:
    """``id_col, n_words, n_hit, n_items, items_sha256, contaminated`` of every row of ``docs``.

    ``n_hit`` counts the words inside any occurrence of a window, ``n_items`` the items that have one;
    ``items_sha256`` is of their ids, sorted as text and joined by commas. A NULL or wordless text has no
    hits, nor has any text if the benchmark is empty. Rows with the same id are judged one by one; items with the same id
    count as one item, those without an id as none. A set of windows of more than ``broadcast_bytes`` is not sent to the tasks but joined as Spark chooses.
    """
    hits = _hits(docs, benchmark, n, id_col, text_col, item_id, item_text, broadcast_bytes)
    n_hit = _covered(F.col("runs"))
    return hits.select(
        F.col("id").alias(id_col), F.col("n_words").cast("bigint").alias("n_words"), n_hit.alias("n_hit"), F.size("found").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("found")), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", id_col: str = "doc_id", text_col: str = "text", n: int = 10,
                        item_id: str = "item_id", item_text: str = "text", broadcast_bytes: int = 64 << 20) -> DataFrame:
    """``docs`` without the documents that hold a benchmark window, or (``remove='spans'``) without the words in one.

    A removed word takes the separators after it along. Columns, whatever their names, stay as they are. Documents are told apart
    by id, so rows that share an id (NULL too) go or stay together; with ``spans`` ids must be unique.
    """
    hits = _hits(docs, benchmark, n, id_col, text_col, item_id, item_text, broadcast_bytes).filter(F.size("runs") > 0)
    held = docs.select(F.struct(*docs.columns).alias("doc"), F.col(id_col).alias("own"))
    if remove == "documents":
        bad = hits.select("id").distinct()
        return held.join(bad.hint("merge"), F.col("own").eqNullSafe(F.col("id")), "left_anti").select("doc.*")  # ids grow with the documents
    text = F.col("doc")[text_col]
    units = F.regexp_extract_all(text, F.lit(f"({_RAW_WORD}(?:{_RAW_BETWEEN})?)"), F.lit(1))
    clean = F.concat(F.regexp_extract(text, f"^(?:{_RAW_BETWEEN})?", 0), F.array_join(F.filter(
        units, lambda _, i: ~F.exists("runs", lambda r: (r["start"] <= i) & (i < r["end"]))), ""))
    joined = held.join(hits.select("id", "runs"), F.col("own").eqNullSafe(F.col("id")), "left")
    new = F.when(F.col("runs").isNull(), text).otherwise(clean)
    return joined.select(*[(new if c == text_col else F.col("doc")[c]).alias(c) for c in docs.columns])
