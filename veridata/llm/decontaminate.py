"""Benchmark decontamination: short test items inside long documents. DataFrame functions only.

Items are partitioned by the magnitude of their shingle count. An item's sketch is its k smallest shingle hashes (a
bottom-k MinHash sketch), with k for its partition such that a document that holds at least 80 % of the item's shingles
must hold one of the sketch: k is one more than the shingles that may be missing from the partition's largest item. So
the search finds every containing document, however long, by one equi-join of its shingle hashes with the sketches, which
hold about a fifth of the items' shingles. The search compares hashes; each pair found is then verified by the words of all
item shingles. One pass over the documents makes their shingles, another reads the texts of those that were found.

Words: lower case, split at ASCII white space. Items with fewer than five words are one shingle of their own length and
are looked for among shingles of that length. Null, empty or blank items and texts match nothing. Repeated items with the
same item_id are one item, their shingles united. Rows with a null doc_id or item_id take no part. Rows with the same
doc_id give one row per item, with the largest containment. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

N, CONTAINMENT = 5, 0.8
#: Bytes of the sketches, or of the items' shingles, that may be broadcast; beyond it the join shuffles.
BROADCAST_BYTES = 16 << 20
_SPACE = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), _SPACE), "")


def grams(words: Column, n: int) -> Column:
    """Hashes of all runs of n words, in order; empty if there are fewer words.

    The words are bound to a lambda variable: written into the inner lambda they would be split again for each run.
    """

    def of(w: Column) -> Column:
        spots = F.when(F.size(w) >= n, F.sequence(F.lit(1), F.size(w) - F.lit(n - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(spots, lambda i: F.xxhash64(*[F.element_at(w, i + F.lit(k)) for k in range(n)]))

    return F.element_at(F.transform(F.array(words), of), 1)


def told(words: Column, n: int) -> Column:
    """The runs of n words themselves, for the exact comparison."""

    def of(w: Column) -> Column:
        spots = F.when(F.size(w) >= n, F.sequence(F.lit(1), F.size(w) - F.lit(n - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(spots, lambda i: F.array_join(F.slice(w, i, n), " "))

    return F.element_at(F.transform(F.array(words), of), 1)


def _items(benchmark: DataFrame) -> DataFrame:
    """(item_id, n, size, shingle, run): n words a shingle, size shingles; the hash and the words of each."""
    split = benchmark.select(F.col("item_id").cast("long").alias("item_id"), words_of(F.col("text").cast("string")).alias("w")).where("item_id is not null and size(w) > 0")
    n = F.least(F.size("w"), F.lit(N))
    made = F.coalesce(*[F.when(n == k, F.arrays_zip(grams(F.col("w"), k).alias("shingle"), told(F.col("w"), k).alias("run"))) for k in range(N, 0, -1)])
    rows = split.select("item_id", n.alias("n"), F.explode(made).alias("e")).select("item_id", "n", "e.shingle", "e.run").distinct()
    return rows.join(rows.groupBy("item_id", "n").agg(F.count("*").alias("size")), ["item_id", "n"])


def _sketches(items: DataFrame, containment: float) -> DataFrame:
    """The k smallest shingle hashes of each item, k by the item's size partition."""
    largest = F.pow(2, F.floor(F.log2("size")) + 1) - 1
    k = (largest - F.ceil(largest * containment) + 1).cast("int")
    ranked = items.groupBy("item_id", "n", "size").agg(F.array_sort(F.collect_list("shingle")).alias("all"))  # of one item
    return ranked.select("item_id", "n", "size", F.explode(F.slice("all", F.lit(1), F.least(k, F.size("all")))).alias("shingle"))


def contained_items(docs: DataFrame, benchmark: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """doc_id, item_id, n_shared, n_item, containment of all pairs at or over the threshold."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null and text is not null")
    items = _items(benchmark)
    sketch = _sketches(items, containment)
    shape = sorted(r.n for r in sketch.select("n").distinct().collect())  # N rows at most
    if not shape:
        return spark.createDataFrame([], "doc_id long, item_id long, n_shared long, n_item long, containment double")
    own = items.groupBy("item_id", "n").agg(F.collect_list("run").alias("item"))  # of one item
    small = lambda rows, size: F.broadcast if (rows.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]) <= BROADCAST_BYTES else lambda x: x
    # one pass over the documents makes the shingles of all lengths
    made = F.element_at(F.transform(F.array(words_of(F.col("text"))), lambda w: F.struct(F.size(w).alias("n_words"), F.concat(*[grams(w, n) for n in shape]).alias("all"))), 1)
    rows = docs.select("doc_id", made.alias("m")).select("doc_id", "m.n_words", F.explode("m.all").alias("shingle"))
    room = F.col("n_words") - F.col("n") + 1 >= F.ceil(F.col("size") * containment)
    hits = rows.join(small(sketch, F.lit(32))(sketch), "shingle").where(room).select("doc_id", "item_id", "n").distinct()
    pairs = hits.join(small(items, F.octet_length("run") + 32)(own), ["item_id", "n"])
    runs = F.coalesce(*[F.when(F.col("n") == n, told(words_of(F.col("text")), n)) for n in shape])
    shared = F.size(F.array_intersect(F.col("item"), runs))
    checked = docs.join(pairs, "doc_id").select("doc_id", "item_id", shared.cast("long").alias("n_shared"), F.size("item").cast("long").alias("n_item"))
    best = checked.groupBy("doc_id", "item_id").agg(F.max("n_shared").alias("n_shared"), F.max("n_item").alias("n_item"))
    return best.withColumn("containment", F.col("n_shared") / F.col("n_item")).where(F.col("n_shared") >= F.ceil(F.col("n_item") * containment))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """The documents that hold no benchmark item; rows with a null doc_id stay."""
    bad = contained_items(docs, benchmark, containment).select("doc_id").distinct()
    return docs.join(bad, "doc_id", "left_anti").select(*docs.columns)
