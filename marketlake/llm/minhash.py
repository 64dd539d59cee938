"""MinHash near-duplicates (operator 8).

1. One pass over the texts gives each document its set of word shingles, the
   minima of many universal hash functions over it, and their band keys.
2. Documents with one and the same set form a class; its smallest id stands for it.
3. In each band bucket every document is linked to the smallest; large-star and
   small-star steps over these links give candidate clusters. All pairs that share a
   bucket are inside one cluster, and no bucket's pairs are listed.
4. Inside a cluster, links are confirmed on the full sets. A document is compared
   with all others at once, only while it may still join two groups; large
   clusters are dealt in blocks, each pair of blocks to one task.
5. The confirmed links, at most one less than the documents of a task, give the
   components, again by large-star and small-star steps.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.components import components
from marketlake.llm.text import SPACED_LOWER, Scratch, bound_batches, gram_codes, mix, odd_numbers, scan_words, written
from marketlake.operators.common import join_per_key


@dataclass(frozen=True)
class Similar:
    """Links: 100 * shared >= percent * all shingles of the two. A pair at the limit is missed
    with (1 - (percent/100) ** rows) ** bands: 1e-6 for 85 % and 44 bands of 8, 3e-5 for 80 % and 56."""

    words: int = 3
    percent: int = 85
    bands: int = 44
    rows: int = 8


BLOCK_SHINGLES = 2_000_000  # shingles of a block of a cluster (16 MB)
TASK_SHINGLES = 1_000_000  # shingles of small clusters that share a task


def shingles(texts: pa.Array, k: int) -> list[np.ndarray]:
    """The distinct k-word shingles of each text (sorted codes); of fewer words, the whole sequence as one."""
    codes, begin = scan_words(texts, SPACED_LOWER)
    grams = gram_codes(codes, k)
    out = []
    for a, b in zip(begin[:-1].tolist(), begin[1:].tolist()):
        n = b - a
        out.append(np.unique(grams[a : b - k + 1]) if n >= k else gram_codes(codes[a:b], n, seed=1000 + n) if n else codes[:0])
    return out


def minima(found: np.ndarray, count: int) -> np.ndarray:
    """The least value of ``count`` universal hashes (a * x + b mod 2^32, a odd) over a set."""
    x = (found >> np.uint64(32)).astype(np.uint32)
    a, b = odd_numbers(count, 5).astype(np.uint32)[:, None], (odd_numbers(count, 6) >> np.uint64(32)).astype(np.uint32)[:, None]
    least = np.full(count, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 512):
        np.minimum(least, (a * x[i : i + 512] + b).min(axis=1), out=least)
    return least


def band_keys(least: np.ndarray, like: Similar) -> np.ndarray:
    weights = odd_numbers(like.rows, 7)
    keys = (least.astype(np.uint64).reshape(like.bands, like.rows) * weights).sum(axis=1, dtype=np.uint64)
    return mix(keys + np.arange(1, like.bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def signatures(docs: DataFrame, like: Similar, doc_id: str, text: str) -> DataFrame:
    """doc_id, n_shingles, s1 and s2 (a 128-bit digest of the set), bands (none for an empty set)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingles(batch.column(1), like.words)
            keys = [band_keys(minima(s, like.bands * like.rows), like).view(np.int64) if len(s) else () for s in sets]
            both = [np.array([[mix(s ^ np.uint64(i)).sum(dtype=np.uint64) for s in sets] for i in (1, 2)], np.uint64).reshape(2, -1).view(np.int64)][0]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(both[0]), pa.array(both[1]), pa.array(keys, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "s1", "s2", "bands"])

    bound_batches(docs.sparkSession)
    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(doc_id, text).mapInArrow(sign, f"doc_id {kind}, n_shingles bigint, s1 bigint, s2 bigint, bands array<bigint>")


def confirm(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links (i, j) that join all sets which links at the limit or above connect; at most len(sets) - 1.

    Every set outside the group that is largest in the end has been compared with
    all others, so no link between two groups is left unseen. The first to be
    compared is the set whose shingles are the most common here: in a group of
    edited copies that is the nearest to the original, and joins them all.
    """
    n = len(sets)
    size = np.array([len(s) for s in sets])
    values, ids, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    begin = np.concatenate([[0], np.cumsum(size)[:-1]])
    group = np.arange(n)
    waiting = np.ones(n, bool)
    common = np.add.reduceat(count[ids], begin) / size
    links = []
    mark = np.zeros(len(values), bool)
    while True:
        left = waiting & (group != int(np.bincount(group, minlength=n).argmax()))
        if not left.any():
            return links
        i = int(np.flatnonzero(left)[np.argmax(common[left])])
        waiting[i] = False
        own = ids[begin[i] : begin[i] + size[i]]
        mark[own] = True
        shared = np.add.reduceat(mark[ids], begin, dtype=np.int64)
        mark[own] = False
        near = (shared * (100 + percent) >= percent * (size + size[i])) & (group != group[i])
        joined, first = np.unique(group[near], return_index=True)
        links += [(i, int(j)) for j in np.flatnonzero(near)[first]]
        group[np.isin(group, joined)] = group[i]


def confirmed_links(docs: DataFrame, clusters: DataFrame, like: Similar, doc_id: str, text: str) -> DataFrame:
    """(a, b) links between cluster members, confirmed on full sets; they connect all that links connect."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s.view(np.int64) for s in shingles(batch.column(1), like.words)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), batch.column(4), pa.array(sets, pa.list_(pa.int64()))], ["doc", "cluster", "blocks", "lot", "shingles"])

    weight = clusters.groupBy("cluster").agg(F.sum("n_shingles").alias("w")).select(
        "cluster", F.ceil(F.col("w") / BLOCK_SHINGLES).cast("int").alias("blocks"))
    total = clusters.agg(F.sum("n_shingles")).first()[0] or 0
    lots = max(1, total // TASK_SHINGLES)
    # The share of a cluster in its members' rows is unbounded, so the weights join as a written table.
    placed = clusters.join(written(weight), "cluster").select(
        F.col("node").alias(doc_id), "cluster", "blocks", F.pmod(F.xxhash64("cluster"), F.lit(lots)).alias("lot"))
    members = join_per_key(docs.select(doc_id, text), placed, doc_id, "inner")
    sets = members.select(doc_id, text, "cluster", "blocks", "lot").mapInArrow(collect, f"doc {kind}, cluster {kind}, blocks int, lot bigint, shingles array<bigint>")
    own = F.pmod(F.xxhash64("doc", "cluster"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = sets.withColumn("x", own).withColumn("y", other).select(
        "doc", "cluster", "shingles",
        F.when(F.col("blocks") == 1, F.struct(F.col("lot").alias("lot"), F.lit(-1).alias("i"), F.lit(-1).alias("j")))
        .otherwise(F.struct(F.xxhash64("cluster").alias("lot"), F.least("x", "y").alias("i"), F.greatest("x", "y").alias("j"))).alias("task"))

    def link(table: pa.Table) -> pa.Table:
        table = table.sort_by("cluster").combine_chunks()
        cluster, doc = table["cluster"], table["doc"].combine_chunks()
        lists = table["shingles"].combine_chunks()
        at, flat = np.asarray(lists.offsets), np.asarray(lists.values).view(np.uint64)
        changes = [0, *[i for i in range(1, len(cluster)) if cluster[i] != cluster[i - 1]], len(cluster)] if len(cluster) else []
        a, b = [], []
        for lo, hi in zip(changes, changes[1:]):
            if hi - lo > 1:
                for i, j in confirm([flat[at[k] : at[k + 1]] for k in range(lo, hi)], like.percent):
                    a.append(lo + i)
                    b.append(lo + j)
        return pa.table({"a": doc.take(pa.array(a, pa.int64())), "b": doc.take(pa.array(b, pa.int64()))})

    return dealt.groupBy("task.lot", "task.i", "task.j").applyInArrow(lambda t: link(t), f"a {kind}, b {kind}")


def near_duplicates(docs: DataFrame, like: Similar = Similar(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest id that links reach), kept.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lowered. A null or empty text, or one without a word,
    has no shingle and is linked with nothing. Rows of one id are one document: its links are those
    of all its rows. A null id is linked with nothing (component_id null, kept). Ties need no rule,
    as the smallest id represents. An empty table gives an empty one. Extra columns of ``docs`` are not read.
    """
    signed = written(signatures(docs, like, doc_id, text))
    with Scratch(docs.sparkSession) as steps:
        linked = signed.where("doc_id is not null and n_shingles > 0")
        same = ["s1", "s2", "n_shingles"]
        classes = steps.written(linked.groupBy(*same).agg(F.min("doc_id").alias("rep")))
        member = steps.written(linked.select("doc_id", *same).join(classes, same).select("doc_id", "rep", "n_shingles"))

        keyed = linked.join(classes.select(*same, F.col("rep").alias("doc_id")), [*same, "doc_id"], "left_semi").select(F.col("doc_id").alias("rep"), F.explode("bands").alias("key"))
        buckets = steps.written(keyed.groupBy("key").agg(F.min("rep").alias("first"), F.max("rep").alias("last")).where("first <> last").select("key", "first"))
        starred = keyed.join(buckets, "key").where("rep <> first").select("first", "rep").distinct()
        clusters = components(starred, "first", "rep").select("node", F.col("component").alias("cluster"))
        sized = steps.written(clusters.join(member.where("doc_id = rep").groupBy("doc_id").agg(F.max("n_shingles").alias("n_shingles")).withColumnRenamed("doc_id", "node"), "node"))
        links = confirmed_links(docs.where(F.col(doc_id).isNotNull()), sized, like, doc_id, text)
        # Rows of one id are one node; so are the classes that they belong to.
        repeated = member.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a <> b").select("a", "b")
        grouped = written(components(links.unionByName(repeated), "a", "b"))
        rep = written(member.groupBy("doc_id").agg(F.min("rep").alias("rep")))
    component = rep.join(grouped.withColumnRenamed("node", "rep"), "rep", "left").select("doc_id", F.coalesce("component", "rep").alias("component_id"))
    found = signed.select("doc_id", "n_shingles").join(component, "doc_id", "left")
    found = found.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
