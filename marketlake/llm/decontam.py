"""Benchmark decontamination by spaced-seed hashing (operator 4).

A fixed mask selects some positions of a window of tokens and ignores the others,
so a window still hits after substitutions at ignored places. The masked windows
of the benchmark go into a sorted hash table; the corpus streams past it, and its
masked windows are joined by hash. Around each hit the two texts are aligned
without gaps along the hit's diagonal, and a stretch is verified: enough
equal tokens, at most a fifth substituted. Short items must be met in full length;
they are found by pieces, one of which is free of the substitutions allowed.

The benchmark is dealt with in blocks of bounded size, each broadcast to one pass
over the corpus, so any number of items runs in bounded memory and no document is
shuffled. Results do not depend on the blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.text import LETTERS, bound_batches, fresh, mix, odd_numbers, scan_words

# Masks of weight 7 over 10 to 12 tokens. Between any two substitutions of a
# passage one of them fits where six tokens agree in a suitable pattern.
MASKS = ("1111111", "1110110101", "1101011011", "110100110111")
BLOCK_WORDS = 500_000  # benchmark words of one broadcast block (about 50 MB of tables at most)
LEAST_MATCH, MOST_SUBSTITUTED = 12, 0.2
SHORT = 25  # items of fewer tokens, in which substitutions can leave no mask a place, also meet by pieces in full length
EXACT = 7  # items of fewer tokens meet exactly


def substituted(n: int) -> int:
    """Tokens that may be substituted in a short item of ``n`` tokens."""
    return n // 5 if n >= EXACT else 0


def token_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the tokens (lower-cased runs without ASCII punctuation and white space) and each text's first."""
    return scan_words(pc.utf8_lower(texts.cast(pa.large_string())), LETTERS)


def masked_codes(codes: np.ndarray, mask: str, number: int) -> np.ndarray:
    n = len(codes) - len(mask) + 1
    if n <= 0:
        return codes[:0]
    out = np.full(n, np.uint64(number + 1))
    for j, m in zip((i for i, c in enumerate(mask) if c == "1"), odd_numbers(mask.count("1"), 40 + number)):
        out += codes[j : j + n] * m
    return mix(out)


class SeedTable:
    """Masked windows of some benchmark items: sorted hashes with their places."""

    def __init__(self, keys: list, texts: list[str]):
        self.keys = keys
        self.text, self.begin = token_codes(pa.array(texts, pa.large_string()))
        hashes, places = [], []
        for number, mask in enumerate(MASKS):
            h = masked_codes(self.text, mask, number)
            own = self.within(np.arange(len(h)), self.begin, len(mask))
            hashes.append(h[own])
            places.append(own)
        h, p = np.concatenate(hashes), np.concatenate(places)
        order = np.argsort(h, kind="stable")
        self.hash, self.place = h[order], p[order]
        self.filter = np.zeros(1 << 22, bool)
        self.filter[(self.hash >> np.uint64(42)).astype(np.int64)] = True
        self.short = self.short_pieces()

    def short_pieces(self) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(size, sorted hashes, their places, filter) of the short items' pieces, one more of each item than may be substituted."""
        places: dict[int, list[int]] = {}
        for first, n in zip(self.begin[:-1].tolist(), np.diff(self.begin).tolist()):
            parts = substituted(n) + 1
            for i in range(parts if 0 < n < SHORT else 0):
                places.setdefault(n * (i + 1) // parts - n * i // parts, []).append(first + n * i // parts)
        out = []
        for size, at in sorted(places.items()):
            h = masked_codes(self.text, "1" * size, 100 + size)[at]
            order = np.argsort(h, kind="stable")
            seen = np.zeros(1 << 16, bool)
            seen[(h >> np.uint64(48)).astype(np.int64)] = True
            out.append((size, h[order], np.array(at)[order], seen))
        return out

    def short_overlaps(self, codes: np.ndarray, begin: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, shift, equal tokens) of the short items found in full length, in order."""
        found = set()
        for size, hashes, places, seen in self.short:
            h = masked_codes(codes, "1" * size, 100 + size)
            at = np.flatnonzero(seen[(h >> np.uint64(48)).astype(np.int64)])
            lo, hi = np.searchsorted(hashes, h[at], "left"), np.searchsorted(hashes, h[at], "right")
            while (more := hi > lo).any():  # as often as pieces of items are equal
                at, lo, hi = at[more], lo[more], hi[more]
                shift = at - places[lo]
                item = np.searchsorted(self.begin, places[lo], "right") - 1
                first, n = self.begin[item] + shift, self.begin[item + 1] - self.begin[item]
                text = np.searchsorted(begin, at, "right") - 1
                whole = (first >= begin[text]) & (first + n <= begin[text + 1])
                shift, item, first, n, text = shift[whole], item[whole], first[whole], n[whole], text[whole]
                same = np.zeros(len(n), np.int64)
                for j in range(int(n.max(initial=0))):
                    own = np.flatnonzero(n > j)
                    same[own] += codes[first[own] + j] == self.text[first[own] - shift[own] + j]
                good = n - same <= np.where(n >= EXACT, n // 5, 0)
                found.update(zip(text[good].tolist(), item[good].tolist(), shift[good].tolist(), same[good].tolist()))
                lo = lo + 1
        yield from sorted(found)

    @staticmethod
    def within(places: np.ndarray, begin: np.ndarray, size: int) -> np.ndarray:
        """Of the windows that start at ``places``, those that end in the text they start in."""
        text = np.searchsorted(begin, places, "right") - 1
        return places[places + size <= begin[text + 1]]

    def overlaps(self, codes: np.ndarray, begin: np.ndarray) -> list[tuple[int, int, int, int, int, int]]:
        """(text, item, first token, tokens, of them equal, first item token): the best verified stretch of each text and item."""
        aligned: set[tuple[int, int, int]] = set()  # text, item, place in ``codes`` less place in the benchmark
        for number, mask in enumerate(MASKS):
            h = masked_codes(codes, mask, number)
            at = self.within(np.flatnonzero(self.filter[(h >> np.uint64(42)).astype(np.int64)]), begin, len(mask))
            lo, hi = np.searchsorted(self.hash, h[at], "left"), np.searchsorted(self.hash, h[at], "right")
            hit = hi > lo
            text = np.searchsorted(begin, at, "right") - 1
            for t, p, a, b in zip(text[hit].tolist(), at[hit].tolist(), lo[hit].tolist(), hi[hit].tolist()):
                for q in self.place[a:b].tolist():
                    aligned.add((t, int(np.searchsorted(self.begin, q, "right")) - 1, p - q))
        best: dict[tuple[int, int], tuple] = {}
        for t, item, shift, same in self.short_overlaps(codes, begin):
            start, n = int(self.begin[item]), int(self.begin[item + 1] - self.begin[item])
            if (t, item) not in best or same > best[t, item][2]:
                best[t, item] = (start + shift - int(begin[t]), n, same, 0)
        for t, item, shift in sorted(aligned):
            start = max(int(self.begin[item]), int(begin[t]) - shift)
            stop = min(int(self.begin[item + 1]), int(begin[t + 1]) - shift)
            equal = self.text[start:stop] == codes[start + shift : stop + shift]
            found = best_stretch(equal, LEAST_MATCH)
            if found and ((t, item) not in best or found[1:] > best[t, item][1:3]):
                best[t, item] = (found[0] + start + shift - int(begin[t]), found[1], found[2], found[0] + start - int(self.begin[item]))
        return [(*k, *b) for k, b in sorted(best.items())]


def best_stretch(equal: np.ndarray, least: int) -> tuple[int, int, int] | None:
    """(start, length, equal) of a stretch with ``least`` equal tokens and at most a fifth substituted, if there is one:
    the one with the most equal tokens less four times the substituted ones (Kadane) where that
    has ``least``, else the one with the most equal tokens."""
    score = np.where(equal, 1, -4)
    total = np.concatenate([[0], np.cumsum(score)])
    low = np.minimum.accumulate(total)
    end = int(np.argmax(total - low))
    start = int(np.flatnonzero(total[: end + 1] == low[end])[-1])
    if (same := int(equal[start:end].sum())) < least:
        # For each end, the first start from where at most a fifth is substituted.
        starts, sums = np.searchsorted(-low, -total, "left"), np.concatenate([[0], np.cumsum(equal)])
        end = int(np.argmax(sums - sums[starts]))
        start = int(starts[end])
        if (same := int(sums[end] - sums[start])) < least:
            return None
        start += int(np.argmax(equal[start:end]))
    return start, end - start, same


def blocks(benchmark: DataFrame, key: str, text: str, most: int) -> Iterator[list[tuple]]:
    """Items in blocks of about ``most`` words (one longer item is a block of its own), a partition at a time."""
    block, size = [], 0
    for row in benchmark.select(key, text).where(F.col(text).isNotNull()).toLocalIterator():
        n = len(row[1]) // 5
        if block and size + n > most:
            yield block
            block, size = [], 0
        block.append((row[0], row[1]))
        size += n
    if block:
        yield block


def benchmark_overlaps(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                       item_text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per (document, item) with a verified overlap:
    doc_id, item_id, start_token, n_tokens (the stretch in the document), n_equal, item_start.

    Tokens are lower-cased runs of word characters. An item of fewer than
    SHORT tokens also matches in full length with at most a fifth substituted;
    of fewer than EXACT tokens, only in full length without any. Null
    texts, on either side, give no row; a null id stays null. Of equally good
    stretches of a pair the one with the smallest diagonal is returned; repeated
    rows each give their own row. No document is shuffled or collected.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    id_type, item_type = docs.schema[doc_id].dataType.simpleString(), benchmark.schema[item_id].dataType.simpleString()
    schema = f"doc_id {id_type}, item_id {item_type}, start_token int, n_tokens int, n_equal int, item_start int"
    parts = []
    for block in blocks(benchmark, item_id, item_text, block_words):
        shared = spark.sparkContext.broadcast(block)

        def match(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            table = SeedTable(*zip(*shared.value))
            for batch in batches:
                rows = table.overlaps(*token_codes(batch.column(1)))
                if rows:
                    text, item, *rest = map(list, zip(*rows))
                    columns = [batch.column(0).take(pa.array(text)), pa.array([table.keys[i] for i in item]), *[pa.array(r, pa.int32()) for r in rest]]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "start_token", "n_tokens", "n_equal", "item_start"])

        parts.append(docs.select(doc_id, text).mapInArrow(match, schema))
    if not parts:
        return spark.createDataFrame([], schema)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def clean_documents(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                    item_text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents without any verified overlap, all columns as they are.

    Every row is judged by its own text, so null or repeated ids do no harm; a
    null or empty text is clean. One pass per block of the benchmark.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    out = docs
    for block in blocks(benchmark, item_id, item_text, block_words):
        shared = spark.sparkContext.broadcast(block)
        hit = fresh("row")

        def judge(batches: Iterator[pa.Array], shared=shared) -> Iterator[pa.Array]:
            table = SeedTable(*zip(*shared.value))
            for batch in batches:
                clean = np.ones(len(batch), bool)
                clean[[r[0] for r in table.overlaps(*token_codes(batch))]] = False
                yield pa.array(clean)

        flag = F.arrow_udf(judge, "boolean", F.ArrowUDFType.SCALAR_ITER)(F.col(text))
        out = out.withColumn(hit, flag).where(F.col(hit)).drop(hit)
    return out
