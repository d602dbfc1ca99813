"""Exact Jaccard join of documents on word n-grams by vertical partitioning.

1. The global n-gram order is cut into fragments. A fragment counts in how many documents each of its n-grams stands and
   answers the blocks of documents, so each document learns which of its n-grams it shares with others, and each partial
   count is summed per document. An overlap only has shared n-grams: a document whose shared part is too small for the
   threshold links with nothing and goes no further (this drops almost all of an ordinary corpus).
2. Documents with the same n-gram set become one class. Each class puts the rarest n-grams of its set, as many as a
   partner must meet one of, into an inverted list; classes that meet in no list, directly or through others, can't link.
   What hangs together is a cluster, found by star contraction, not by listing pairs.
3. In a cluster, n-grams are cut into fragments of the same order again; partial overlaps with a document are counted
   fragment by fragment and summed per pair, and a pair is given up when what is left can't reach the threshold. The
   search walks each component from document to document and only looks among those not yet reached, so a large group of
   near copies costs its size times a few, not its square, and no link between two components is missed.
4. A cluster with more classes or n-grams than one task should hold is dealt at random into chunks, twice. What then
   stays apart from the cluster's largest component is dealt into chunks of its own, and each meets those chunks of the
   cluster that hold a class of a common list, of both sides only the classes that share a list with the other: no task
   holds more than two chunks, and where links are few, few chunks meet.

``ngram_links`` gives every link between classes: it stops at 2 and counts the overlap of each pair of a cluster's classes
that share an n-gram, chunk against chunk where a cluster has several. A group of k linked classes has up to k (k - 1) / 2
links, so its work and rows grow with the square of the largest group. ``link_counts`` does the same work, but gives one
number a class. Components and the pipeline need neither.

The order is by (magnitude of the document count, hash). N-grams are keyed by 64-bit hashes. Two n-grams of one key
that stand in different clusters only make a document a candidate; a decision could only turn on a shared key inside one
document or one pair, about 10^-7 of documents of a million n-grams.

Words: ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case. Fewer words than n: the whole sequence is one n-gram. Null, empty
and blank texts have no n-grams and are components of their own. Repeated rows, and rows that
share a doc_id, give one row each, by their own text. A null doc_id is kept as a row without links. An
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._blocks import BLOCK_BYTES, blocked, distinct, mix, through_fragments, word_keys
from ._common import drop_checkpoint, settled
from ._graph import connected_components

N, PERCENT = 5, 80
#: N-grams (32 MB of keys) and classes that one task holds of a cluster at once.
CHUNK_GRAMS, CHUNK_ROWS = 4_000_000, 256
#: Bound on the classes that are broadcast: those with over one in so many of the documents.
HOT_CLASSES = 1000
#: Parts of the n-gram order in which a pair's overlap is counted.
PAIR_FRAGMENTS = 4
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None, n: int = N) -> np.ndarray:
    """Sorted distinct 64-bit keys of a text's word n-grams."""
    w = word_keys(text)
    k = max(1, len(w) - n + 1) if len(w) else 0
    if not k:
        return w
    m = min(n, len(w))
    key = np.full(k, m, np.uint64)
    for i in range(m):
        key = key * _STEP + w[i : i + k]
    return np.unique(mix(key))


def least_overlap(a, b, percent: int = PERCENT):
    """Smallest overlap at which sets of these sizes link: 100 x >= percent (a + b - x)."""
    return -(-percent * (a + b) // (100 + percent))


def components_in(keys: list[np.ndarray], sizes: np.ndarray, percent: int, start: np.ndarray | None = None, fragments: int = PAIR_FRAGMENTS) -> np.ndarray:
    """For each document the place of the first one that links reach. ``keys``: shared n-grams, in the global order of
    ``mix``ed hashes; ``sizes``: of the whole sets. With ``start``, the documents' components so far: only documents whose
    start is not that of the most common one are walked from, links inside one start component being known."""
    g = len(keys)
    own = np.repeat(np.arange(g), [len(k) for k in keys])
    grams, col = distinct(np.concatenate(keys)) if own.size else (np.empty(0, np.uint64), np.empty(0, np.int64))
    first = np.cumsum([0, *map(len, keys)])
    cuts = np.linspace(0, len(grams), fragments + 1).astype(np.int64)
    held = np.zeros((fragments + 1, g), np.int64)  # n-grams of each document from a fragment on
    for f in range(fragments):
        held[f] = np.bincount(own[col >= cuts[f]], minlength=g)
    label = np.arange(g) if start is None else start.copy()
    members = {}
    for i, s in enumerate(label):
        members.setdefault(int(s), []).append(i)
    known = max(members, key=lambda s: len(members[s])) if start is not None and g else None
    open_ = np.ones(g, bool)

    def index():
        keep = np.flatnonzero(open_[own])
        order = keep[np.argsort(col[keep], kind="stable")]
        at = np.searchsorted(col[order], np.arange(len(grams) + 1))
        return own[order], at, int(open_.sum())

    post, at, size = index()
    seeds = [s for s in members if s != known]
    result = label.copy()
    for s in seeds:
        queue = [i for i in members[s] if open_[i]]
        if not queue:
            continue
        open_[queue] = False
        reached = list(queue)
        while queue:
            d = queue.pop()
            left = int(open_.sum())
            if not left:
                break
            if left * 2 < size:
                post, at, size = index()
            need = least_overlap(sizes[d], sizes, percent)
            overlap = np.zeros(g, np.int64)
            alive = open_.copy()
            mine = np.sort(col[first[d] : first[d + 1]])
            for f in range(fragments):
                part = mine[np.searchsorted(mine, cuts[f]) : np.searchsorted(mine, cuts[f + 1])]
                n = at[part + 1] - at[part]
                if n.sum():
                    spots = np.repeat(at[part] - np.cumsum(n) + n, n) + np.arange(n.sum())
                    overlap += np.bincount(post[spots], minlength=g)
                rest = len(mine) - np.searchsorted(mine, cuts[f + 1])
                alive &= overlap + np.minimum(rest, held[f + 1]) >= need
                if not alive.any():
                    break
            for j in np.flatnonzero(alive & (overlap >= need)):
                if open_[j]:
                    new = [i for i in members[int(label[j])] if open_[i]] if start is not None else [int(j)]
                    open_[new] = False
                    reached += new
                    queue += new
        result[reached] = min(result[i] for i in reached)
    return result


def links_in(keys: list[np.ndarray], sizes: np.ndarray, percent: int, right: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and overlap of every pair that links, each once. With ``right``, only pairs of one document outside it and
    one inside."""
    g = len(keys)
    own = np.repeat(np.arange(g), [len(k) for k in keys])
    grams, col = distinct(np.concatenate(keys)) if own.size else (np.empty(0, np.uint64), np.empty(0, np.int64))
    first = np.cumsum([0, *map(len, keys)])
    listed = np.arange(len(own)) if right is None else np.flatnonzero(right[own])
    order = listed[np.argsort(col[listed], kind="stable")]
    post, at = own[order], np.searchsorted(col[order], np.arange(len(grams) + 1))
    begin, end = at[:-1].copy(), at[1:]
    out = [[np.empty(0, np.int64)] * 3]
    for d in range(g) if right is None else np.flatnonzero(~right):
        mine = col[first[d] : first[d + 1]]
        if right is None:
            begin[mine] += 1  # lists are in the documents' order, so this passes d itself and leaves the later ones
        n = end[mine] - begin[mine]
        met = post[np.repeat(begin[mine] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        if 4 * len(met) > g:
            overlap = np.bincount(met, minlength=g)
            j = np.flatnonzero(overlap)
            overlap = overlap[j]
        else:
            j, overlap = np.unique(met, return_counts=True)
        good = overlap >= least_overlap(sizes[d], sizes[j], percent)
        out.append([np.full(int(good.sum()), d), j[good], overlap[good]])
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _gather(docs: DataFrame, n: int, percent: int, block_bytes: int) -> DataFrame:
    """(doc_id, n_shingles, digest, shared, prefix): of documents that may link, the shared n-grams and the keys of the
    inverted lists they stand in; of all others nulls."""
    rows, blocks = blocked(docs, block_bytes)

    def sets(table: pa.Table):
        each = [shingles(t.as_py(), n) for t in table["text"]]
        return np.concatenate([*each, np.empty(0, np.uint64)]), [len(x) for x in each]

    def keys_of(table: pa.Table):
        kinds, place = distinct(sets(table)[0])
        return kinds, [np.bincount(place, minlength=len(kinds))]

    def combine(keys: np.ndarray, cols: list[np.ndarray]):
        kinds, place = distinct(keys)
        total = np.bincount(place, weights=cols[0], minlength=len(kinds))
        return [np.ceil(np.log2(np.maximum(total, 1)))[place]]

    def finish(table: pa.Table, told: list[np.ndarray]) -> pa.Table:
        every, sizes = sets(table)
        magnitude = told[0][distinct(every)[1]]
        out, at = [], 0
        for d, size in zip(table["doc_id"], sizes, strict=True):
            keys, m = every[at : at + size], magnitude[at : at + size]
            at += size
            shared = keys[m > 0]
            alone = size - len(shared)
            if d.as_py() is None or not size or 100 * len(shared) < percent * size:
                out.append((d.as_py(), size, None, None, None))
                continue
            # partners share at least percent of this set: one of its first (size - that + 1) n-grams in the order
            take = size - -(-percent * size // 100) + 1 - alone
            prefix = shared[np.lexsort((shared, m[m > 0]))[:take]]
            out.append((d.as_py(), size, hashlib.blake2b(keys.tobytes(), digest_size=16).digest(), shared.tobytes(), prefix.view(np.int64)))
        cols = list(zip(*out, strict=True))
        types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
        return pa.table([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["doc_id", "n_shingles", "digest", "shared", "prefix"])

    return through_fragments(rows, blocks, keys_of, combine, finish, "doc_id long, n_shingles long, digest binary, shared binary, prefix array<long>", ["<u4"], ["u1"])


def _searched(groups: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """(doc_id, component) in each group, from rows (doc_id, n_shingles, shared, known): known, if any, is the component so far."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("doc_id")
        ids = table["doc_id"].to_numpy()
        sets = [np.frombuffer(x.as_py(), np.uint64) for x in table["shared"]]
        known = table["known"]
        start = None
        if known.null_count == 0:
            _, start = np.unique(known.to_numpy(), return_inverse=True)
            firsts = np.full(start.max() + 1, len(start))
            np.minimum.at(firsts, start, np.arange(len(start)))
            start = firsts[start]
        found = components_in(sets, table["n_shingles"].to_numpy(), percent, start)
        return pa.table({"doc_id": ids, "component": ids[found]})

    return groups.select(*keys, "doc_id", "n_shingles", "shared", "known").groupBy(*keys).applyInArrow(run, "doc_id long, component long")


def _links_in_large(large: DataFrame, percent: int, chunk_grams: int, chunk_rows: int) -> DataFrame:
    """Edges between members of clusters of several chunks: rows (cluster, chunks, doc_id, n_shingles, shared, prefix)."""
    edges = None
    for turn in range(2):
        dealt = large.withColumn("chunk", F.pmod(F.xxhash64("doc_id", F.lit(turn)), "chunks")).withColumn("known", F.lit(None).cast("long"))
        found = settled(_searched(dealt, ["cluster", "chunk"], percent).select(F.col("doc_id").alias("a"), F.col("component").alias("b")).where("a <> b"))
        edges = found if edges is None else edges.unionAll(found)
    so_far = connected_components(edges).withColumnRenamed("node", "doc_id")
    known = large.select("cluster", "doc_id").join(so_far, "doc_id", "left").select("cluster", "doc_id", F.coalesce("component", "doc_id").alias("known"))
    main = known.groupBy("cluster", "known").agg(F.count("*").alias("n")).groupBy("cluster").agg(F.max_by("known", F.struct("n", "known")).alias("main"))
    told = settled(known.join(main, "cluster").select("doc_id", "known", "main").distinct())  # the n-grams are shuffled once, by the join with this
    known = settled(large.join(told, "doc_id").withColumn("chunk", F.pmod(F.xxhash64("doc_id", F.lit(0)), "chunks")))
    apart = known.where("known <> main").withColumn("held", F.octet_length("shared"))
    size = apart.groupBy("cluster").agg(_chunks(chunk_grams, chunk_rows, "held").alias("parts"))
    apart = apart.join(size, "cluster").withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(2)), "parts"))
    # linked classes stand in a common list, so a class is sent where a class of one of its lists is
    of_part = apart.select("cluster", "part", "doc_id", F.explode("prefix").alias("gram"))
    of_chunk = known.select("cluster", "chunk", "doc_id", F.explode("prefix").alias("gram"))
    sent = of_part.join(of_chunk.select("cluster", "chunk", "gram").distinct(), ["cluster", "gram"]).select("cluster", "part", "chunk", "doc_id")
    back = of_chunk.join(of_part.select("cluster", "part", "gram").distinct(), ["cluster", "gram"]).select("cluster", "part", "chunk", "doc_id")
    met = sent.unionAll(back).distinct().join(known.select("doc_id", "n_shingles", "shared", "known"), "doc_id")
    more = _searched(met, ["cluster", "part", "chunk"], percent).select(F.col("doc_id").alias("a"), F.col("component").alias("b")).where("a <> b")
    return edges.unionAll(more)


def _chunks(chunk_grams: int, chunk_rows: int, held: str):
    """Into how many chunks a cluster's rows go; ``held``: the column of the bytes of each row's n-grams."""
    return F.greatest(F.ceil(F.sum(held) / 8 / chunk_grams), F.ceil(F.count("*") / chunk_rows), F.lit(1).cast("long"))


def _clustered(docs: DataFrame, n: int, percent: int, chunk_grams: int, block_bytes: int, chunk_rows: int = CHUNK_ROWS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(doc_id, n_shingles, digest) of all documents; (digest, class_id, n) of the classes that may link; and of those
    that meet others (cluster, doc_id, n_shingles, shared, prefix, chunks)."""
    every = settled(_gather(docs, n, percent, block_bytes))
    ids = settled(every.select("doc_id", "n_shingles", "digest"))  # what is read again below, without the n-grams
    classes = settled(ids.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("n")))
    # the n-grams are most of the bytes: they are shuffled once here, and what needs only their volume reads "held"
    maybe = every.where("digest is not null").withColumn("held", F.octet_length("shared"))
    heads = maybe.join(classes.select(F.col("class_id").alias("doc_id"), F.col("digest").alias("d")), "doc_id").where("digest = d").dropDuplicates(["doc_id", "digest"]).drop("d", "digest")
    listed = heads.select("doc_id", F.explode("prefix").alias("gram"))
    least = listed.groupBy("gram").agg(F.min("doc_id").alias("b"), F.count("*").alias("k")).where("k > 1")
    near = connected_components(listed.join(least, "gram").select(F.col("doc_id").alias("a"), "b")).select(F.col("node").alias("doc_id"), F.col("component").alias("cluster"))
    volume = heads.select("doc_id", "held").join(near, "doc_id").groupBy("cluster").agg(_chunks(chunk_grams, chunk_rows, "held").alias("chunks"))
    placed = settled(heads.drop("held").join(settled(near.join(volume, "cluster")), "doc_id"))
    drop_checkpoint(every)
    return ids, classes, placed


def ngram_components(docs: DataFrame, n: int = N, percent: int = PERCENT, chunk_grams: int = CHUNK_GRAMS, block_bytes: int = BLOCK_BYTES, chunk_rows: int = CHUNK_ROWS, hot_classes: int = HOT_CLASSES) -> DataFrame:
    """doc_id, n_shingles, class_id (smallest doc_id with the same set), component_id (smallest doc_id that links reach)."""
    ids, classes, placed = _clustered(docs, n, percent, chunk_grams, block_bytes, chunk_rows)
    small = _searched(placed.where("chunks <= 1").withColumn("known", F.lit(None).cast("long")), ["cluster"], percent).select(F.col("doc_id").alias("node"), "component")
    large = placed.where("chunks > 1")
    if not large.isEmpty():
        small = small.unionAll(connected_components(_links_in_large(large, percent, chunk_grams, chunk_rows)))
    # of rows that share a doc_id but not a set, a node has several
    small = small.groupBy("node").agg(F.min("component").alias("component"))
    told = settled(classes.join(small, classes["class_id"] == small["node"], "left").select("digest", "n", "class_id", F.coalesce("component", "class_id").alias("component_id")))
    drop_checkpoint(placed)
    return _told(ids, told, hot_classes)


def _class_links(placed: DataFrame, percent: int, counts: bool = False) -> DataFrame:
    """(a, b, n_shared) of each link between classes, a < b, from rows (cluster, doc_id, n_shingles, shared, chunks); or,
    counted in the task that finds them, (class_id, k): how many a class has there."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("doc_id")
        ids, chunk = table["doc_id"].to_numpy(), table["chunk"].to_numpy()
        x, y = table["x"][0].as_py(), table["y"][0].as_py()
        i, j, shared = links_in([np.frombuffer(k.as_py(), np.uint64) for k in table["shared"]], table["n_shingles"].to_numpy(), percent, None if x == y else chunk == y)
        a, b = np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j])
        other = a != b
        if counts:
            kinds, k = np.unique(np.concatenate([a[other], b[other]]), return_counts=True)
            return pa.table({"class_id": kinds, "k": k.astype(np.int64)})
        return pa.table({"a": a[other], "b": b[other], "n_shared": shared[other].astype(np.int64)})

    # each chunk meets itself and every other one, in one task a pair
    met = placed.withColumn("chunk", F.pmod(F.xxhash64("doc_id"), "chunks")).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    met = met.select("cluster", F.least("chunk", "other").alias("x"), F.greatest("chunk", "other").alias("y"), "chunk", "doc_id", "n_shingles", "shared")
    return met.groupBy("cluster", "x", "y").applyInArrow(run, "class_id long, k long" if counts else "a long, b long, n_shared long")


def ngram_links(docs: DataFrame, n: int = N, percent: int = PERCENT, chunk_grams: int = CHUNK_GRAMS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """a, b, n_shared: every link between the classes of different texts, by class_id, a < b, and the n-grams they share."""
    return _class_links(_clustered(docs, n, percent, chunk_grams, block_bytes)[2], percent)


def link_counts(docs: DataFrame, n: int = N, percent: int = PERCENT, chunk_grams: int = CHUNK_GRAMS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """class_id, n_links: of every class, how many other classes it links with. Rows with a null doc_id have no class."""
    ids, classes, placed = _clustered(docs, n, percent, chunk_grams, block_bytes)
    none = ids.where("digest is null and doc_id is not null").select(F.col("doc_id").alias("class_id")).unionAll(classes.select("class_id"))
    return _class_links(placed, percent, counts=True).unionAll(none.withColumn("k", F.lit(0).cast("long"))).groupBy("class_id").agg(F.sum("k").alias("n_links"))


def _told(ids: DataFrame, classes: DataFrame, hot_classes: int) -> DataFrame:
    """Each document with what its class was told: rows (digest, n, class_id, component_id), n the class's documents.

    Copies of one text all have one digest. Classes with over 1/hot_classes of the documents, of which there are fewer
    than hot_classes, are broadcast; only the rest meets by digest. Documents without a digest go straight through.
    """
    out = ["doc_id", "n_shingles", "class_id", "component_id"]
    bound = classes.agg(F.sum("n")).first()[0]
    alone = ids.where("digest is null").select("doc_id", "n_shingles", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("component_id"))
    if not bound:
        return alone
    hot = classes.where(F.col("n") * hot_classes > bound).drop("n")
    cold = classes.where(F.col("n") * hot_classes <= bound).drop("n")
    member = ids.where("digest is not null")
    of_hot = member.join(F.broadcast(hot), "digest").select(out)
    of_cold = member.join(F.broadcast(hot.select("digest")), "digest", "left_anti").join(cold, "digest").select(out)
    return alone.unionAll(of_hot).unionAll(of_cold)


def keep_one_of_each(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """The documents, of each component the one with the smallest doc_id. Rows with a null doc_id stay.

    Of rows that share a doc_id and stay, all stay: they can't be told apart by id.
    """
    gone = ngram_components(docs, n, percent).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
