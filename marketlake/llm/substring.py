"""Substring removal by suffix automata of reference shards (operator 6).

A window is ``width`` consecutive words. A window goes if its word sequence starts earlier too
(smaller doc_id, or the same document and an earlier start); a word goes if such a window covers it.

Streaming every document past the automaton of every shard of the corpus would be quadratic, so
the reference is cut into pieces which only meet where they can match:

1. Each window is named by the smallest hash among its ``GRAM``-word windows (its anchor); equal
   windows have equal anchors. Consecutive windows of one anchor form a piece. Anchors that are
   very frequent in the corpus are ranked last in this choice (a bounded list, found in a first pass), so
   a common line does not draw all its neighbourhoods into one shard.
2. Pieces are sent to the shard of their anchor. Of equal pieces the earliest stays as the reference,
   the windows of all others go. This is done in each task before the shuffle too, so a passage
   of a third of all documents costs a row per task.
3. Anchors with several different pieces are settled by suffix automata: the pieces' words are fetched,
   each shard streams its pieces in document order past the automaton of those before,
   and takes the matching statistics: a match of ``width`` words or more ends a repeated window.
4. The spans come back to the documents, whose words are read once more.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.text import _powers, bound_batches, fresh, gram_codes, mix, scan_words, utf8, with_fields
from marketlake.session import cut_lineage, scratch_path

GRAM = 6
FLUSH_PIECES = 400_000  # pieces a task holds before it passes them on (about 30 MB)
SHARD_PIECES = 200_000  # pieces of a shard, on average
FREQUENT = 2000  # anchors with more than one piece in so many are ranked last (so at most this many)
BROADCAST_PIECES = 1_000_000


class Pieces:
    """Pieces of a batch: document row, first word in its text, windows, anchor, digest of the words."""

    def __init__(self, texts: pa.Array, width: int, frequent: np.ndarray):
        codes, begin = scan_words(texts)
        count = np.diff(begin)
        windows = np.maximum(count - width + 1, 0)
        total = int(windows.sum())
        self.row = self.start = self.windows = np.zeros(0, np.int64)
        self.anchor = self.digest = np.zeros(0, np.uint64)
        if not total:
            return
        row = np.repeat(np.arange(len(count)), windows)
        shift = begin[:-1] - (np.cumsum(windows) - windows)
        at = np.arange(total) + np.repeat(shift, windows)  # place of each window's first word in ``codes``
        rank = gram_codes(codes, GRAM) >> np.uint64(1)
        if len(frequent):
            rank[np.isin(rank, frequent)] |= np.uint64(1 << 63)
        span = width - GRAM + 1
        # Place of the smallest gram of each window, the leftmost of equal ones: two windows that
        # share this place differ in where it lies in them, so a piece never repeats a window of its own.
        low, size = np.arange(len(rank)), 1
        while size < span:
            step = min(size, span - size)
            left, right = low[:-step], low[step:]
            low, size = np.where(rank[right] < rank[left], right, left), size + step
        low = low[at]
        new = np.ones(total, bool)
        new[1:] = (low[1:] != low[:-1]) | (row[1:] != row[:-1])
        first = np.flatnonzero(new)
        self.windows = np.diff(first, append=total)
        self.row, self.anchor = row[first], rank[low[first]] & np.uint64((1 << 63) - 1)
        place = at[first]
        self.start = place - begin[self.row]
        power, inverse = _powers(1 << max(20, len(codes).bit_length()))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * power[: len(codes)])])
        self.digest = mix((sums[place + self.windows + width - 1] - sums[place]) * inverse[place] + self.windows.astype(np.uint64))


def first_of_equal(doc: np.ndarray, start: np.ndarray, *same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of the earliest piece of each kind, places of all later ones); a repeat of the earliest itself is in neither."""
    order = np.lexsort((start, doc, *same))
    new = np.ones(len(order), bool)
    differs = np.zeros(max(len(order) - 1, 0), bool)
    for s in same:
        differs |= s[order][1:] != s[order][:-1]
    new[1:] = differs
    head = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0)) if len(order) else order
    later = ~new & ((doc[order] != doc[order][head]) | (start[order] != start[order][head]))
    return order[new], order[later]


def frequent_anchors(docs: DataFrame, width: int) -> tuple[list[int], int]:
    """(anchors of more than 1/FREQUENT of all pieces, number of pieces)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, none = [], 0, np.zeros(0, np.uint64)

        def tell(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, size
            if held and (last or size >= FLUSH_PIECES):
                anchors, n = np.unique(np.concatenate(held), return_counts=True)
                # An anchor that is rarer than this in every portion is not frequent in all.
                often = n * FREQUENT >= size
                yield pa.RecordBatch.from_arrays([pa.array([*anchors[often].astype(np.int64), None]), pa.array([*n[often].tolist(), size], pa.int64())], ["anchor", "n"])
                held, size = [], 0

        for batch in batches:
            held.append(Pieces(batch.column(0), width, none).anchor)
            size += len(held[-1])
            yield from tell(False)
        yield from tell(True)

    text = docs.columns[1]
    counted = cut_lineage(docs.select(text).mapInArrow(count, "anchor bigint, n bigint").groupBy("anchor").agg(F.sum("n").alias("n")))
    pieces = counted.where("anchor is null").agg(F.sum("n")).first()[0] or 0
    # At most FREQUENT rows, as their counts add up to no more than all pieces.
    often = counted.where(F.col("anchor").isNotNull() & (F.col("n") * FREQUENT > pieces)).select("anchor").collect()
    return sorted(r[0] for r in often), pieces


RECORD = "shard bigint, doc binary, start binary, windows binary, anchor binary, digest binary"
FACT = "doc_id bigint, start int, windows int, mask int, anchor bigint"


def settled_pieces(docs: DataFrame, width: int, frequent: list[int], shards: int) -> DataFrame:
    """FACT rows: pieces whose windows all go (mask with a bit per window), and pieces still open (mask null)."""
    listed = np.array(frequent, np.uint64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def tell(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, size
            if held and size and (last or size >= FLUSH_PIECES):
                doc, start, windows, anchor, digest = (np.concatenate(c) for c in zip(*held))
                held, size = [], 0
                keep, later = first_of_equal(doc, start, digest, anchor)
                # Pieces known to go need no meeting: they spread by document.
                at = np.concatenate([keep, later])
                to = np.concatenate([anchor[keep] % np.uint64(shards), mix(doc[later].view(np.uint64)) % np.uint64(shards)]).astype(np.int64)
                known = np.repeat([False, True], [len(keep), len(later)])
                order = np.lexsort((known, to))
                at, to, known = at[order], to[order], known[order]
                cut = np.flatnonzero(np.concatenate([[True], (to[1:] != to[:-1]) | (known[1:] != known[:-1])])).tolist()
                rows = [(int(to[a]), doc[at[a:b]].tobytes(), start[at[a:b]].astype(np.int32).tobytes(), windows[at[a:b]].astype(np.uint8).tobytes(),
                         b"" if known[a] else anchor[at[a:b]].tobytes(), b"" if known[a] else digest[at[a:b]].tobytes()) for a, b in zip(cut, [*cut[1:], len(at)])]
                for i in range(0, len(rows), 2000):
                    columns = zip(*rows[i : i + 2000])
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if j == 0 else pa.binary()) for j, c in enumerate(columns)], RECORD.replace(" bigint", "").replace(" binary", "").split(", "))

        for batch in batches:
            p = Pieces(batch.column(1), width, listed)
            doc = np.asarray(batch.column(0).cast(pa.int64()))
            held.append((doc[p.row], p.start, p.windows, p.anchor, p.digest))
            size += len(p.row)
            yield from tell(False)
        yield from tell(True)

    def settle(table: pa.Table) -> pa.Table:
        known = np.array([len(a) == 0 for a in table["anchor"].to_pylist()])
        column = (lambda name, kind, which: np.frombuffer(b"".join(x for x, k in zip(table[name].to_pylist(), known) if k == which), kind))
        doc, start, windows = (column(n, k, False) for n, k in (("doc", np.int64), ("start", np.int32), ("windows", np.uint8)))
        anchor, digest = column("anchor", np.uint64, False), column("digest", np.uint64, False)
        keep, later = first_of_equal(doc, start, digest, anchor)
        # Kept pieces are ordered by anchor; one that stands alone has no rival.
        a = anchor[keep]
        same = a[1:] == a[:-1]
        rival = np.concatenate([[False], same]) | np.concatenate([same, [False]]) if len(a) else np.zeros(0, bool)
        keep = keep[rival]
        gone = [np.concatenate([c[later], column(n, k, True)]) for c, n, k in ((doc, "doc", np.int64), (start, "start", np.int32), (windows, "windows", np.uint8))]
        full = (1 << gone[2].astype(np.int32)) - 1
        none = pa.nulls(len(keep), pa.int32())
        return pa.table({
            "doc_id": np.concatenate([gone[0], doc[keep]]), "start": np.concatenate([gone[1], start[keep]]),
            "windows": np.concatenate([gone[2], windows[keep]]).astype(np.int32), "mask": pa.chunked_array([pa.array(full, pa.int32()), none]),
            "anchor": np.concatenate([np.zeros(len(full), np.int64), anchor[keep].astype(np.int64)])})

    return docs.mapInArrow(deal, RECORD).groupBy("shard").applyInArrow(lambda t: settle(t), FACT)


class SuffixAutomaton:
    """A suffix automaton of several word sequences, extended one after the other."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def add(self, sequence: list[int]) -> None:
        nxt, link, length = self.next, self.link, self.length
        last = 0
        for c in sequence:
            p = last
            q = nxt[p].get(c)
            if q is not None and length[q] == length[p] + 1:
                last = q
                continue
            if q is None:
                cur = len(nxt)
                nxt.append({})
                length.append(length[p] + 1)
                link.append(0)
                while p >= 0 and c not in nxt[p]:
                    nxt[p][c] = cur
                    p = link[p]
                last = cur
                if p < 0:
                    continue
                q = nxt[p][c]
                if length[q] == length[p] + 1:
                    link[cur] = q
                    continue
            else:
                cur = -1
            clone = len(nxt)
            nxt.append(dict(nxt[q]))
            length.append(length[p] + 1)
            link.append(link[q])
            while p >= 0 and nxt[p].get(c) == q:
                nxt[p][c] = clone
                p = link[p]
            link[q] = clone
            if cur >= 0:
                link[cur] = clone
            else:
                last = clone

    def matches(self, sequence: list[int]) -> list[int]:
        """Matching statistics: the longest suffix that ends at each place and occurs in the automaton."""
        nxt, link, length = self.next, self.link, self.length
        state = size = 0
        out = []
        for c in sequence:
            while state and c not in nxt[state]:
                state = link[state]
                size = length[state]
            if c in nxt[state]:
                state = nxt[state][c]
                size += 1
            out.append(size)
        return out


def repeated_windows(docs: DataFrame, opened: DataFrame, width: int, shards: int) -> DataFrame:
    """(doc_id, start, mask) of open pieces with windows that start earlier elsewhere, by suffix automata per shard."""
    # Few enough pieces are broadcast; beyond the bound both sides are shuffled by document.
    listed = opened.groupBy("doc_id").agg(F.collect_list(F.struct("start", "windows", "anchor")).alias("open"))
    listed = F.broadcast(listed) if opened.count() <= BROADCAST_PIECES else listed
    own = docs.toDF("doc_id", "text").join(listed, "doc_id")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, begin = scan_words(batch.column(1))
            codes = codes.view(np.int64)
            rows = []
            for row, (doc, pieces) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())):
                for p in pieces:
                    a = int(begin[row]) + p["start"]
                    b = a + p["windows"] + width - 1
                    if b <= begin[row + 1]:
                        rows.append((p["anchor"] % shards, p["anchor"], doc, p["start"], codes[a:b]))
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["shard", "anchor", "doc_id", "start", "words"])

    def stream(table: pa.Table) -> pa.Table:
        table = table.sort_by([("anchor", "ascending"), ("doc_id", "ascending"), ("start", "ascending")]).combine_chunks()
        anchors, docs_, starts = (table[c].to_pylist() for c in ("anchor", "doc_id", "start"))
        lists = table["words"].combine_chunks()
        at, flat = lists.offsets.to_pylist(), lists.values.to_pylist()
        out, automaton, before = [], None, None
        for i, anchor in enumerate(anchors):
            words = flat[at[i] : at[i + 1]]
            if anchor != before:
                automaton, before, latest = SuffixAutomaton(), anchor, None
            if latest == (docs_[i], starts[i]):
                continue  # a repeated row
            latest = docs_[i], starts[i]
            mask = 0
            if len(automaton.next) > 1:
                for end, size in enumerate(automaton.matches(words)):
                    if size >= width:
                        mask |= 1 << (end - width + 1)
            if mask:
                out.append((docs_[i], starts[i], mask))
            if mask != (1 << (len(words) - width + 1)) - 1:
                automaton.add(words)
        doc, start, mask = zip(*out) if out else ((), (), ())
        return pa.table({"doc_id": pa.array(doc, pa.int64()), "start": pa.array(start, pa.int32()), "mask": pa.array(mask, pa.int32())})

    pieces = own.mapInArrow(fetch, "shard bigint, anchor bigint, doc_id bigint, start int, words array<bigint>")
    return pieces.groupBy("shard").applyInArrow(lambda t: stream(t), "doc_id bigint, start int, mask int")


def covered(n: int, starts: list[int], masks: list[int], width: int) -> np.ndarray:
    """Which of n words lie in one of the windows."""
    edge = np.zeros(n + 1, np.int64)
    for s, m in zip(starts, masks):
        while m:
            low = (m & -m).bit_length() - 1  # a run of windows that follow each other
            run = ((m >> low) + 1 & ~(m >> low)).bit_length() - 1
            a, b = s + low, min(s + low + run + width - 1, n)
            if a < n:
                edge[a] += 1
                edge[b] -= 1
            m &= ~(((1 << run) - 1) << low)
    return np.cumsum(edge[:n]) > 0


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 20, digests: bool = False) -> DataFrame:
    """Appends n_words, n_removed (long) and kept: the words that stay, joined by one space
    (``digests``: kept_sha256, the lowercase hex of it, in its place).

    doc_id is an integer. Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. A null or empty text has none. Rows without an
    id take no part and keep their words. Rows of one id are one document: repeated rows get the same
    result, and of different texts under one id a place that goes in one goes in all. Other columns pass through, those
    named like a result are replaced; an empty table gives an empty one. Digests of 64 bits beside a
    63-bit anchor tell pieces apart; pieces that differ are compared word by word (64-bit codes).
    """
    spark = docs.sparkSession
    bound_batches(spark)
    if not 2 * GRAM <= width <= 30 + GRAM:
        raise ValueError(f"width must be {2 * GRAM} to {30 + GRAM}")
    own = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    frequent, pieces = frequent_anchors(own, width)
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-pieces // SHARD_PIECES))
    path = scratch_path(spark, "pieces")
    settled_pieces(own, width, frequent, shards).write.parquet(path)
    facts = spark.read.parquet(path)
    more = cut_lineage(repeated_windows(own, facts.where("mask is null"), width, shards))
    spans = facts.where("mask is not null").select("doc_id", "start", "mask").unionByName(more)
    key, starts, masks = fresh("doc"), fresh("starts"), fresh("masks")
    spans = spans.groupBy("doc_id").agg(F.collect_list(F.struct("start", "mask")).alias("s")).select(F.col("doc_id").alias(key), F.col("s.start").alias(starts), F.col("s.mask").alias(masks))
    found = docs.withColumn(key, F.col(doc_id).cast("long")).join(spans, key, "left")
    result = "kept_sha256" if digests else "kept"

    def cut(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, s, m in batches:
            n, removed, kept = [], [], []
            for t, a, b in zip(utf8(texts), s.to_pylist(), m.to_pylist()):
                ws = t.split()
                n.append(len(ws))
                if a:
                    gone = covered(len(ws), a, b, width)
                    ws = [w for w, g in zip(ws, gone.tolist()) if not g]
                removed.append(n[-1] - len(ws))
                rest = b" ".join(ws)
                kept.append(hashlib.sha256(rest).hexdigest() if digests else rest.decode())
            yield pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], ["n_words", "n_removed", result])

    kept = F.arrow_udf(cut, f"struct<n_words:bigint,n_removed:bigint,{result}:string>", F.ArrowUDFType.SCALAR_ITER)(F.col(text), F.col(starts), F.col(masks))
    return with_fields(found, kept, ["n_words", "n_removed", result]).drop(key, starts, masks)
