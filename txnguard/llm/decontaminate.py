"""Benchmark decontamination by a prefix-filtered set join, in DataFrame functions only.

An item's windows are its runs of ``window`` words (a shorter item is one window).
A document contains a window only if it contains all of its shingles, so one
necessary token is enough to find it: shingles are ordered by how often they
occur in all documents, and each window is indexed by its rarest. A document's
shingles join that prefix; the shingle's place in the window gives the only place
where the window can start, which must lie within the document (positional and
length bounds); then the words themselves are compared.

The benchmark's side is broadcast while its windows hold ``broadcast_bytes`` at
most; beyond that both joins shuffle, and candidates carry places instead of words.

Cases: null texts have no words. An item without a word has no window. Items with
a null id mark words as hit but are not counted or listed. Repeated items count
by their id once. Documents are told apart by id and text, so repeated rows get
the same result each; a null document id is an id of its own. Texts of any length
are read whole. Shingles that are equally rare are taken in the order of their hashes.
Other columns are ignored; without documents there are no rows, without benchmark
items no word is hit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnguard.llm.common import materialize

# Everything but words: words are runs of digits, lower-case letters and characters from U+0080 on.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: str) -> Column:
    """The words of a text whose A-Z are lower-cased; none for null."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    ascii_only = F.octet_length(t) == F.char_length(t)  # where lower() changes A-Z alone
    lowered = F.when(ascii_only, F.lower(t)).otherwise(F.translate(t, UPPER, LOWER))
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def _shingle(w: Column, at: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(w, at + j) for j in range(size)])


def windows(benchmark: DataFrame, window: int) -> DataFrame:
    """(item_id, w) of every window of every item, w its words."""
    n = F.size("w")
    starts = F.sequence(F.lit(0), F.greatest(n - window, F.lit(0)))
    runs = F.transform(starts, lambda i: F.slice(F.col("w"), i + 1, window))
    return benchmark.select("item_id", words("text").alias("w")).where(n > 0).select("item_id", F.explode(runs).alias("w"))


def _doc_shingles(docs: DataFrame, size: int, *keep: str) -> DataFrame:
    """(keep..., words, pos, h) of every shingle of every document."""
    hashes = F.when(F.size("w") >= size, F.transform(F.sequence(F.lit(0), F.size("w") - size), lambda i: _shingle(F.col("w"), i, size)))
    rows = docs.select("doc_id", F.xxhash64("text").alias("t"), words("text").alias("w"))
    return rows.select(*keep, F.posexplode(hashes).alias("pos", "h"))


def hits(docs: DataFrame, benchmark: DataFrame, window: int = 10, shingle: int = 3, broadcast_bytes: int = 32 << 20) -> DataFrame:
    """(doc_id, t, spans, items) of every document that contains a window: the (start, length) of each
    occurrence and the ids of their items; t is the text's hash."""
    found = materialize(windows(benchmark, window), "windows")
    distinct = found.select("w").distinct().withColumn("size", F.least(F.size("w"), F.lit(shingle)))
    distinct = materialize(distinct.withColumn("id", F.concat_ws(" ", "w")), "distinct_windows")
    held = distinct.agg(F.sum(F.octet_length("id") * 2 + 64)).first()[0] or 0
    hint = F.broadcast if held <= broadcast_bytes else (lambda df: df)
    sizes = sorted(r[0] for r in distinct.select("size").distinct().collect())  # 1 to ``shingle``

    out = None
    for size in sizes:
        own = distinct.where(F.col("size") == size)
        places = F.transform(F.sequence(F.lit(0), F.size("w") - size), lambda i: F.struct(_shingle(F.col("w"), i, size).alias("h"), i.alias("offset")))
        tokens = own.select("id", "w", F.inline(places))
        known = tokens.select("h").distinct()
        times = _doc_shingles(docs, size, "doc_id").join(hint(known), "h").groupBy("h").count()
        times = materialize(times, "shingle_counts")
        # the rarest shingle of each window; ties go to the smaller hash, then to the first place
        order = F.struct(F.coalesce("count", F.lit(0)).alias("n"), "h", "offset")
        prefix = tokens.join(times, "h", "left").groupBy("id", "w").agg(F.min(order).alias("p")).where("p.n > 0").select("id", F.col("w").alias("window"), "p.h", "p.offset")
        prefix = materialize(prefix, "prefix")
        start, length = F.col("pos") - F.col("offset"), F.size("window")
        if held <= broadcast_bytes:
            rows = _doc_shingles(docs, size, "doc_id", "t", "w").join(F.broadcast(prefix), "h")
            rows = rows.where((start >= 0) & (start + length <= F.size("w"))).where(F.slice("w", start + 1, length) == F.col("window"))
            rows = rows.select("doc_id", "t", start.alias("start"), length.alias("length"), "id")
        else:
            places = _doc_shingles(docs, size, "doc_id", "t").join(prefix, "h").where(start >= 0)
            places = materialize(places.select("doc_id", "t", start.alias("start"), "id").distinct(), "candidates")
            texts = docs.select("doc_id", F.xxhash64("text").alias("t"), words("text").alias("w")).alias("d")
            windows_of = distinct.select("id", F.col("w").alias("window"))
            keyed = places.join(windows_of, "id").groupBy("doc_id", "t").agg(F.collect_list(F.struct("start", "id", "window")).alias("c")).alias("c")
            rows = texts.join(keyed, F.expr("d.doc_id <=> c.doc_id and d.t = c.t")).select("d.doc_id", "d.t", "d.w", F.explode("c.c").alias("p"))
            size_of = F.size("p.window")
            rows = rows.where(F.col("p.start") + size_of <= F.size("w")).where(F.slice("w", F.col("p.start") + 1, size_of) == F.col("p.window"))
            rows = rows.select("doc_id", "t", F.col("p.start").alias("start"), size_of.alias("length"), F.col("p.id").alias("id"))
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        kind = docs.schema["doc_id"].dataType.simpleString()
        item = benchmark.schema["item_id"].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"doc_id {kind}, t long, spans array<struct<start: int, length: int>>, items array<{item}>")
    items = found.select(F.concat_ws(" ", "w").alias("id"), "item_id").distinct()
    items = items.groupBy("id").agg(F.collect_set("item_id").alias("items"))  # as many as the benchmark has
    spans = materialize(out.distinct(), "spans").join(items, "id")
    each = spans.groupBy("doc_id", "t").agg(F.collect_set(F.struct("start", "length")).alias("spans"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    return materialize(each, "hits")


def covered(spans: str) -> Column:
    """How many places a set of (start, length) spans covers."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))

    def add(acc: Column, s: Column) -> Column:
        end = s["start"] + s["length"]
        return F.struct((acc["n"] + F.greatest(F.lit(0), end - F.greatest(s["start"], acc["end"]))).alias("n"), F.greatest(acc["end"], end).alias("end"))

    return F.aggregate(F.sort_array(spans), zero, add, lambda acc: acc["n"])


def report(docs: DataFrame, benchmark: DataFrame, window: int = 10, **options) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items (sorted as strings) and contaminated of every row."""
    found = hits(docs, benchmark, window, **options).alias("h")
    rows = docs.select("doc_id", F.xxhash64("text").alias("t"), F.size(words("text")).cast("long").alias("n_words")).alias("d")
    joined = rows.join(found, F.expr("d.doc_id <=> h.doc_id and d.t = h.t"), "left")
    ids = F.coalesce(F.sort_array(F.transform("items", lambda i: i.cast("string"))), F.array().cast("array<string>"))
    n_hit = F.coalesce(covered("spans"), F.lit(0)).cast("long")
    return joined.select("d.doc_id", "n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"), ids.alias("items"), (n_hit > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, window: int = 10, **options) -> DataFrame:
    """The rows, with their own columns, that contain no window of the benchmark."""
    found = hits(docs, benchmark, window, **options).select("doc_id", "t").alias("h")
    return docs.alias("d").join(found, F.expr("d.doc_id <=> h.doc_id and xxhash64(d.text) = h.t"), "left_anti")
