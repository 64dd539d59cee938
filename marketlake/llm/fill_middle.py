"""Fill-in-middle transformation (operator 13) by content-defined chunks.

1. A rolling hash over the last WINDOW bytes cuts each text into chunks; where a
   chunk ends depends on the bytes before only, so passages that texts share
   mostly fall into equal chunks.
2. A chunk's summary holds the token ends inside it, its code points, and
   whether its first and last byte are blank. Summaries are kept in a bounded
   memo by the chunk's bytes; a find is an equality of contents, not of hashes.
3. Summaries combine from left to right: a token also ends between two chunks
   where the left one ends in a word and the right one begins with a blank. Their
   running counts give the number of tokens and lead to the chunk of each cut;
   only this chunk is scanned for the place.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.text import batch_bytes, bound_batches, by_batch, odd_numbers, with_fields

WINDOW = 16  # bytes that the rolling hash sees
CHUNK_BITS = 10  # a chunk has 2 ** CHUNK_BITS bytes on average
LONGEST = 1 << 16  # a chunk without a cut is cut here
STEP = 1 << 20  # bytes hashed at once
MEMO_BYTES = 32 << 20  # contents that a task's memo holds; it is emptied when full

MARKERS = ("<P>", "<S>", "<M>")  # before prefix, suffix and middle
FIELDS = {"n": "bigint", "form": "string", "prefix_chars": "bigint", "middle_chars": "bigint", "output": "string"}

BLANK = np.zeros(256, bool)
BLANK[[32, *range(9, 14)]] = True


def cuts(data: np.ndarray) -> np.ndarray:
    """Places after which the rolling hash of the WINDOW bytes before them says that a chunk ends (ascending)."""
    by = int(odd_numbers(1, 13)[0]) & 0xFFFFFFFF
    out = [np.zeros(0, np.int64)]
    for begin in range(WINDOW - 1, len(data), STEP):
        part = data[begin - WINDOW + 1 : begin + STEP].astype(np.uint32)
        size, power = 1, by
        while size < WINDOW:  # part[i] covers the bytes i to i + size - 1
            part = part[:-size] * np.uint32(power) + part[size:]
            size, power = 2 * size, power * power & 0xFFFFFFFF
        part ^= part >> np.uint32(15)
        part *= np.uint32(0x2C1B3C6D)
        out.append(np.flatnonzero(part >> np.uint32(32 - CHUNK_BITS) == 0) + begin + 1)
    return np.concatenate(out)


def bounds(found: np.ndarray, begin: int, end: int) -> np.ndarray:
    """Where the chunks of the text at begin:end start, and its end; no chunk is longer than LONGEST."""
    inner = found[np.searchsorted(found, begin + WINDOW) : np.searchsorted(found, end)]
    at = np.concatenate([[begin], inner, [end]])
    wide = np.flatnonzero(np.diff(at) > LONGEST)
    if len(wide):
        more = [np.arange(at[i] + LONGEST, at[i + 1], LONGEST) for i in wide]
        at = np.sort(np.concatenate([at, *more]))
    return at


def summary(chunk: np.ndarray) -> tuple[int, int, bool, bool]:
    """(token ends inside, code points, whether the first byte is blank, whether the last one is)."""
    blank = BLANK[chunk]
    return int(np.count_nonzero(blank[1:] & ~blank[:-1])), code_points(chunk), bool(blank[0]), bool(blank[-1])


def code_points(chunk: np.ndarray) -> int:
    return int(np.count_nonzero((chunk & 0xC0) != 0x80))


class Summaries(dict):
    """The memo: contents of a chunk -> its summary."""

    held = 0

    def __missing__(self, content: bytes) -> tuple[int, int, bool, bool]:
        found = summary(np.frombuffer(content, np.uint8))
        if self.held + len(content) > MEMO_BYTES:
            self.clear()
            self.held = 0
        self[content] = found
        self.held += len(content)
        return found


class Chunked:
    """One text as chunks: ``n`` tokens, and the place of any cut between them."""

    def __init__(self, data: np.ndarray, at: np.ndarray, memo: Summaries):
        self.data, self.at = data, at
        if at[0] == at[-1]:
            self.n = 0
            return
        edges = at.tolist()
        parts = [memo[data[a:b].tobytes()] for a, b in zip(edges, edges[1:])]
        self.inner, chars, first, last = (np.array(x) for x in zip(*parts))
        # A token also ends with its chunk if a word does: before a blank, or at the end of the text.
        closing = ~last & np.append(first[1:], True)
        self.ends, self.chars = np.cumsum(self.inner + closing), np.cumsum(chars)
        self.trailing = bool(last[-1])  # blanks at the end are a token of their own
        self.n = int(self.ends[-1]) + self.trailing

    def cut(self, k: int) -> tuple[int, int]:
        """(bytes, code points) of the first ``k`` tokens."""
        if k == 0:
            return 0, 0
        if k == self.n:
            return int(self.at[-1] - self.at[0]), int(self.chars[-1])
        c = int(np.searchsorted(self.ends, k))
        begin, end = int(self.at[c]), int(self.at[c + 1])
        rest = k - (int(self.ends[c - 1]) if c else 0)
        if rest <= self.inner[c]:
            blank = BLANK[self.data[begin:end]]
            end = begin + 1 + int(np.flatnonzero(blank[1:] & ~blank[:-1])[rest - 1])
        before = int(self.chars[c - 1]) if c else 0
        return end - int(self.at[0]), before + code_points(self.data[begin:end])


def draws(seed: int, doc_id: str | None) -> list[int]:
    """Four 32-bit numbers of a document, from the SHA-256 of ``seed:doc_id`` (a null id counts as empty)."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[4 * i : 4 * i + 4], "big") for i in range(4)]


def fill_in_middle(df: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = 42, percent: int = 50, spm_percent: int = 80, markers: tuple[str, str, str] = MARKERS) -> DataFrame:
    """Appends n (tokens, long), form ('plain', 'psm', 'spm'), prefix_chars, middle_chars (long, code points), output (string).

    A token is a word with the blanks before it; blanks at the end of the text are one
    more. A document's draws depend on ``seed`` and its id alone. ``percent`` of the
    documents change form, ``spm_percent`` of these to suffix-prefix-middle order. A null
    text counts as empty; an empty text and one that contains a marker stay plain, with
    null prefix_chars and middle_chars. Rows of one id have the same draws, equal rows equal
    results; a null id draws as an empty one. Very long texts are held once, with
    about one summary per 1,000 bytes. Other columns pass through, those named like the
    results are replaced; an empty table gives an empty one. No shuffle.
    """
    bound_batches(df.sparkSession)
    p_mark, s_mark, m_mark = (m.encode() for m in markers)

    def make():
        memo = Summaries()

        def each(batch: tuple[pa.Array, pa.Array]) -> pa.Array:
            ids, (data, at) = batch[0].to_pylist(), batch_bytes(batch[1])
            found = cuts(data)
            rows = []
            for name, begin, end in zip(ids, at[:-1].tolist(), at[1:].tolist()):
                whole = data[begin:end].tobytes()
                chunked = Chunked(data, bounds(found, begin, end), memo)
                h1, h2, h3, h4 = draws(seed, name)
                if not whole or h3 % 100 >= percent or any(m in whole for m in (p_mark, s_mark, m_mark)):
                    rows.append((chunked.n, "plain", None, None, whole))
                    continue
                units = sorted((h1 % (chunked.n + 1), h2 % (chunked.n + 1)))
                (a, a_chars), (b, b_chars) = (chunked.cut(k) for k in units)
                prefix, middle, suffix = whole[:a], whole[a:b], whole[b:]
                if spm := h4 % 100 < spm_percent:
                    output = s_mark + suffix + p_mark + prefix + m_mark + middle
                else:
                    output = p_mark + prefix + s_mark + suffix + m_mark + middle
                rows.append((chunked.n, "spm" if spm else "psm", a_chars, b_chars - a_chars, output))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 5, kinds)]
            columns[-1] = columns[-1].cast(pa.string())
            return pa.StructArray.from_arrays(columns, list(FIELDS))

        return each

    kind = "struct<" + ",".join(f"{name}:{kind}" for name, kind in FIELDS.items()) + ">"
    formed = F.arrow_udf(by_batch(make), kind, F.ArrowUDFType.SCALAR_ITER)
    return with_fields(df, formed(F.col(doc_id).cast("string"), F.col(text)), list(FIELDS))


def restored(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text that ``output`` was made of, from it and its form alone."""
    p_mark, s_mark, m_mark = (F.lit(m) for m in markers)

    def between(left: Column, right: Column | None = None) -> Column:
        begin = F.instr(output, left) + F.length(left)
        return F.substring(output, begin, F.instr(output, right) - begin) if right is not None else F.substring(output, begin, F.length(output))

    psm = F.concat(between(p_mark, s_mark), between(m_mark), between(s_mark, m_mark))
    spm = F.concat(between(p_mark, m_mark), between(m_mark), between(s_mark, p_mark))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
