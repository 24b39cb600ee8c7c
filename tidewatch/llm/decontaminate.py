"""Benchmark decontamination: the corpus is scanned for every word n-gram of the benchmark items.

The hashes of all benchmark windows form a set, as bits at the places they name, that goes to every task; each window of
a document is looked up in it, and the words themselves are compared where a bit is set. Neither texts nor windows are
shuffled. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import bound, cut, small, text_of

WINDOW = 10
#: Hashes of the set that goes to every task at once, and its bits for each (rounded up to a power of two): 32 MB at most. A larger set goes in blocks, with a scan for each.
SET_HASHES, HASH_BITS = 4_000_000, 32
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words: digits, lower-case ASCII letters and all characters beyond ASCII. As a class of what belongs to it the pattern is
#: matched several times faster than as a class of what doesn't.
WORD = r"[0-9a-z\x{80}-\x{10FFFF}]+"
#: The same before lower-casing.
ANY_CASE_WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else; texts of ASCII alone, the most, take the quicker way."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def words_of(text: str | Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text_of(text)), F.lit(WORD), F.lit(0))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(window, len, items): every distinct window of the items, its words joined by spaces, with the ids it occurs in. A null id is in no list of ids."""
    words = benchmark.select(F.col(id_col).cast("string").alias("item"), words_of(text_col).alias("w")).where(F.size("w") > 0)
    sized = words.withColumn("len", F.least(F.size("w"), F.lit(window)))
    starts = sized.select("item", "w", "len", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("len") + 1)).alias("i"))
    windows = starts.select("item", "len", F.array_join(F.slice("w", F.col("i"), F.col("len")), " ").alias("window"))
    return windows.groupBy("window", "len").agg(F.collect_set("item").alias("items"))


def _starts(w: Column, length: int) -> Column:
    n = F.size(w)
    return F.when(n >= length, F.sequence(F.lit(1), n - (length - 1))).otherwise(F.array().cast("array<int>"))


def window_hashes(w: Column, length: int) -> Column:
    """Hashes of all windows of ``length`` of the words w: words are hashed once, then strings of 1, 2, 4 ... words put together."""
    widths = [1 << k for k in range(length.bit_length())]

    def whole(levels: dict[int, Column]) -> Column:
        def at(i: Column) -> Column:
            pieces, before = [], 0
            for width in reversed(widths):
                if length & width:
                    pieces.append(F.get(levels[width], i + (before - 1)))
                    before += width
            return F.xxhash64(*pieces)

        return F.transform(_starts(w, length), at)

    def from_level(levels: dict[int, Column]) -> Column:
        width = max(levels)
        if 2 * width > length:
            return whole(levels)
        return bound(F.transform(levels[width], lambda x, i: F.xxhash64(x, F.get(levels[width], i + width))), lambda wider: from_level({**levels, 2 * width: wider}))

    return bound(F.transform(w, lambda x: F.xxhash64(x)), lambda each: from_level({1: each}))


def _long(n: int) -> Column:
    return F.lit(n).cast("long")


def hash_set(hashes: DataFrame, n: int) -> tuple[Column, int]:
    """Of n rows (hash): longs whose bit h is set for each hash that leaves the remainder h, as a scalar subquery, and how many bits there are."""
    bits = 64
    while bits < n * HASH_BITS:
        bits *= 2
    at = F.col("hash").bitwiseAND(_long(bits - 1))
    some = hashes.select(F.shiftright(at, 6).alias("word"), F.call_function("shiftleft", _long(1), at.bitwiseAND(_long(63)).cast("int")).alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    every = hashes.sparkSession.range(bits // 64).withColumnRenamed("id", "word").join(some, "word", "left")
    return every.agg(F.array_sort(F.collect_list(F.struct("word", F.coalesce("bits", _long(0)).alias("bits"))))["bits"].alias("bits")).scalar(), bits


def _candidates(w: Column, members: Column, bits: int, length: int) -> Column:
    """(pos, len, window) of the windows of the words w whose hash is in the set."""

    def known(h: Column) -> Column:
        at = h.bitwiseAND(_long(bits - 1))
        return F.call_function("shiftright", F.get(members, F.shiftright(at, 6).cast("int")), at.bitwiseAND(_long(63)).cast("int")).bitwiseAND(_long(1)) == 1

    def found(x: Column) -> Column:
        places = F.filter(x["at"], lambda i: known(F.get(x["hash"], i - 1)))
        return F.transform(places, lambda i: F.struct(i.alias("pos"), F.lit(length).alias("len"), F.array_join(F.slice(w, i, length), " ").alias("window")))

    def hashed(at: Column) -> Column:
        return bound(F.struct(at.alias("at"), window_hashes(w, length).alias("hash")), found)

    return bound(_starts(w, length), hashed)


def _matched(lengths: list[int], bits: int):
    def of(x: Column) -> Column:
        parts = [_candidates(x["w"], x["members"], bits, n) for n in lengths]
        return F.struct(F.size(x["w"]).cast("long").alias("n_words"), (F.concat(*parts) if len(parts) > 1 else parts[0]).alias("hits"))

    return of


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", set_hashes: int = SET_HASHES) -> DataFrame:
    """(row, doc_id, n_words, pos, len, items): every verified occurrence of a benchmark window; items are null in a row of each document without one.

    ``row`` numbers the rows of ``docs``, so that repeated ids stay apart.
    """
    windows = cut(benchmark_windows(benchmark, window), "windows")
    lengths = sorted(r["len"] for r in windows.select("len").distinct().collect())
    split = bound(F.split("window", " "), lambda w: F.array(F.lit(None).cast("long"), *[F.when(F.size(w) == n, F.get(window_hashes(w, n), F.lit(0))) for n in lengths]))
    hashes = cut(windows.select(F.array_compact(split)[0].alias("hash")).distinct(), "window-hashes")
    n_windows, n_hashes = windows.count(), hashes.count()
    keyed = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), words_of(text_col).alias("w"))
    if n_windows == 0:
        return keyed.select("row", "doc_id", F.size("w").cast("long").alias("n_words"), F.lit(None).cast("int").alias("pos"), F.lit(None).cast("int").alias("len"), F.lit(None).cast("array<string>").alias("items"))
    blocks = -(-n_hashes // set_hashes)
    out = None
    for k in range(blocks):
        members, bits = hash_set(hashes.where(F.pmod(F.xxhash64(F.lit("block"), "hash"), F.lit(blocks)) == k), -(-n_hashes // blocks))
        matched = _matched(lengths, bits)
        both = keyed.withColumn("members", members).select("row", "doc_id", bound(F.struct("w", "members"), matched).alias("x")).select("row", "doc_id", "x.n_words", "x.hits")
        met = (both.select("row", "doc_id", "n_words", F.explode_outer("hits").alias("hit")) if k == 0 else both.select("row", "doc_id", "n_words", F.explode("hits").alias("hit"))).select("row", "doc_id", "n_words", "hit.*")
        out = met if out is None else out.unionByName(met)
    # no window has a line break, so the keys of documents without one match none and spread
    out = out.withColumn("window", F.coalesce("window", F.concat(F.lit("\n"), F.col("row").cast("string"))))
    return out.join(small(windows, n_windows), ["window", "len"], "left").select("row", "doc_id", "n_words", "pos", "len", "items")


def _covered(spans: Column) -> Column:
    """Words under any of the (pos, len) spans."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    return F.aggregate(
        F.array_sort(spans),
        start,
        lambda s, x: F.struct(
            (s["n"] + F.greatest(F.lit(0), x["pos"] + x["len"] - F.greatest(x["pos"], s["end"]))).alias("n"), F.greatest(s["end"], x["pos"] + x["len"]).alias("end")
        ),
        lambda s: s["n"].cast("long"),
    )


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", set_hashes: int = SET_HASHES) -> DataFrame:
    """How each row of ``docs`` overlaps with the benchmark.

    Returns doc_id, n_words, n_hit (words in any occurrence of a window), n_items and items_sha256 (of the ids of items
    with occurring windows, sorted as strings, comma-joined), contaminated. A window is ``window`` consecutive words of
    an item, or all words of a shorter one. Null and empty texts have no words; items without words never occur, and one
    without an id counts for its words but in no list; rows that repeat a doc_id are judged each. Empty tables give no rows, or no hits. Other columns are ignored.
    """
    found = hits(docs, benchmark, window, id_col, text_col, set_hashes)
    real = F.col("items").isNotNull()
    per_row = found.groupBy("row", "doc_id", "n_words").agg(
        F.collect_set(F.when(real, F.struct("pos", "len"))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")
    )
    n_hit = _covered(F.col("spans"))
    return per_row.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", window: int = WINDOW, text_col: str = "text", set_hashes: int = SET_HASHES) -> DataFrame:
    """``docs`` without contaminated rows (``remove="documents"``), or without the hit words (``remove="spans"``).

    With "spans" a hit word disappears and what stood between words stays. Clean rows come back as they are, in all
    columns, null texts and repeated rows too; a benchmark without words leaves all. What is hit is found by text, each
    different text once, and rows are told by the digest of theirs.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove must be 'documents' or 'spans'")
    digest = F.sha2(text_of(text_col).cast("binary"), 256)
    names = docs.columns
    found = hits(docs.select(digest.alias("digest"), F.col(text_col).alias("text")), benchmark, window, "digest", "text", set_hashes).where(F.col("items").isNotNull())
    found = cut(found.groupBy(F.col("doc_id").alias("digest")).agg(F.collect_set(F.struct("pos", "len")).alias("hit")), "contaminated")
    boxed = docs.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("d"), digest.alias("digest"))
    found = small(found, found.count())
    if remove == "documents":
        return boxed.join(found, "digest", "left_anti").select("d.*")
    taken = {n.lower() for n in names}
    spans = next(f"spans_{k}" for k in range(len(taken) + 1) if f"spans_{k}" not in taken)
    hit = F.coalesce("hit", F.array().cast("array<struct<pos:int,len:int>>"))
    marked = boxed.join(found, "digest", "left").select(*[F.col(f"d.`{n}`") for n in names], hit.alias(spans))
    text = text_of(text_col)
    gone = F.array_distinct(F.flatten(F.transform(F.col(spans), lambda s: F.sequence(s["pos"], s["pos"] + s["len"] - 1))))
    words = F.regexp_extract_all(text, F.lit(ANY_CASE_WORD), F.lit(0))
    left = bound(gone, lambda g: F.transform(words, lambda x, i: F.when(F.array_contains(g, i + 1), F.lit("")).otherwise(x)))
    kept = F.zip_with(left, F.split(text, ANY_CASE_WORD, -1), lambda word, gap: F.concat(gap, F.coalesce(word, F.lit(""))))
    return marked.withColumn(text_col, F.when(F.size(spans) == 0, F.col(text_col)).otherwise(F.array_join(kept, ""))).drop(spans)
