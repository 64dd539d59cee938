"""Byte-pair encoding by backtracking and decoding by an offset table (operator 5).

Encoding: an Aho-Corasick automaton over all tokens gives the longest token at
every position of a word. Tokens are taken greedily; a token is accepted only if
the pair with its predecessor is compatible, that is, if merging the two tokens'
text would keep the boundary between them. Otherwise the next shorter token that
starts there is tried, and when none is left the predecessor is shortened in its
turn. A position found to be a dead end is never tried again, so the work is
linear in the word's length. The result equals the exact merge order.

Decoding: all token strings lie in one byte table; an offset table gives each
identifier's place, and the identifiers' bytes are gathered with one index.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
from array import array
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.text import Memo, bound_batches, by_batch, utf8, with_fields

END = ""  # stands for the end-of-word suffix: one character, in no byte-level alphabet
DECODE_STEP = 1 << 16  # identifiers decoded at a time
CHUNKS, PIECES = 450_000, 250_000  # runs and words whose identifiers a task keeps (about 125 MB)
# The word pattern that the short cut below knows.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LATIN_END = "\u0250"


def byte_letters() -> list[str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others follow from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Codec:
    """Encoder and decoder of a tokenizers .json file (BPE with an end-of-word suffix)."""

    def __init__(self, path: str):
        import tokenizers

        spec = json.load(open(path, encoding="utf-8"))
        model, self.suffix = spec["model"], spec["model"].get("end_of_word_suffix") or ""
        mark = (lambda t: t[: -len(self.suffix)] + END if self.suffix and t.endswith(self.suffix) else t)
        self.ids = {mark(t): i for t, i in model["vocab"].items()}
        self.pairs: dict[tuple[int, int], int] = {}  # (left, right) -> rank
        self.made: dict[int, tuple[int, int, int]] = {}  # token -> (rank, left, right)
        for rank, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            left, right, whole = self.ids[mark(a)], self.ids[mark(b)], self.ids[mark(a + b)]
            self.pairs[left, right] = rank
            if whole in self.made:
                raise ValueError(f"two merges make one token: {a + b!r}")
            self.made[whole] = (rank, left, right)
        self.compatible = Memo(lambda key: self._keeps_boundary(*key))
        self.length = {i: len(t) for t, i in self.ids.items()}
        # A token that merging would never leave whole cannot appear in an encoding.
        usable = {t: i for t, i in self.ids.items() if t != END and self._whole(i)}
        self.automaton = ahocorasick.Automaton()
        for t, i in usable.items():
            self.automaton.add_word(t, i)
        self.automaton.make_automaton()
        self.shorter = {}  # token -> the longest usable token that is a proper prefix of it
        for t, i in usable.items():
            self.shorter[i] = next((usable[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in usable), None)
        self.letters = dict(enumerate(byte_letters()))
        self.library = tokenizers.Tokenizer.from_file(path)  # its normaliser and word splitter, for text outside ASCII
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.added = added
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        # Letters below LATIN_END are in normal form C and lowered one by one; after them the file's
        # pattern takes a run of punctuation as one word. Anything else goes through the library's parts.
        known = [WORDS] == [p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        self.plain = re.compile(r"([^\W\d_]+)([.,!?;:|#$%&*]*)").fullmatch if known and self.suffix and sys.byteorder == "little" else None
        self.piece = Memo(self._encode_piece, most=PIECES)
        self.chunk = Memo(self._encode_chunk, most=CHUNKS)
        names = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in added.items()}
        table = [(names.get(i, "") + " ").encode() for i in range(max(names) + 1)]
        self.table = np.frombuffer(b"".join(table), np.uint8)
        self.offset = np.cumsum([0, *map(len, table)])

    def _rank(self, token: int) -> int:
        return self.made[token][0] if token in self.made else -1

    def _keeps_boundary(self, left: int, right: int, joined: bool = False) -> bool:
        """Would exact merging of left's text followed by right's text keep the boundary?

        Undo merges from the last one backwards: the tokens that touch the
        boundary at any moment must not be a pair that merges before the next
        merge on either side happens. ``joined``: the two themselves may merge.
        """
        rank = None if joined else self.pairs.get((left, right))
        if rank is not None:
            return False
        while True:
            a, b = self._rank(left), self._rank(right)
            if a < 0 and b < 0:
                return True
            # Merges of one rank happen from the left: on a tie the right one is undone
            # first, and the pair over the boundary would come before it.
            limit, tie = (a, False) if a > b else (b, True)
            if a > b:
                left = self.made[left][2]
            else:
                right = self.made[right][1]
            rank = self.pairs.get((left, right))
            if rank is not None and (rank < limit or rank == limit and tie):
                return False

    def _whole(self, token: int) -> bool:
        """Is a token's own text merged into just this token?"""
        if token not in self.made:
            return True
        _, left, right = self.made[token]
        return self._whole(left) and self._whole(right) and self._keeps_boundary(left, right, joined=True)

    def backtrack(self, word: str) -> list[int]:
        """Identifiers of one word in the byte-level alphabet, the end mark included."""
        n, length, shorter, compatible = len(word), self.length, self.shorter, self.compatible
        longest: list[int | None] = [None] * n
        for end, token in self.automaton.iter(word):  # ends ascend, so the last token of a start is its longest
            longest[end + 1 - length[token]] = token
        dead: set[int] = set()  # from here no accepted rest was found
        tokens: list[int] = []
        pos, token, last = 0, longest[0], -1
        while pos < n:
            while token is not None:
                end = pos + length[token]
                if (last < 0 or compatible[last, token]) and end not in dead:
                    break
                token = shorter[token]
            if token is not None:
                tokens.append(token)
                pos, last = end, token
                token = longest[pos] if pos < n else None
            elif tokens:
                dead.add(pos)
                token = tokens.pop()
                pos -= length[token]
                last = tokens[-1] if tokens else -1
                token = shorter[token]
            else:
                raise ValueError(f"no encoding of {word!r}")
        return tokens

    def _encode_piece(self, piece: str) -> bytes:
        return array("I", self.backtrack(piece + END if self.suffix else piece)).tobytes()

    def _encode_chunk(self, chunk: bytes) -> bytes:
        """A run without ASCII white space: nothing of the normaliser or the word splitter reaches over its ends."""
        text = chunk.decode("utf-8", "replace")
        plain = self.plain(text) if self.plain else None
        if plain and max(text) < LATIN_END and (low := plain[1].lower()).isalpha():
            ids = self.piece[low.encode().decode("latin-1").translate(self.letters)]
            return ids + self.piece[plain[2]] if plain[2] else ids
        out = []
        for part in self.special.split(text) if self.special else [text]:
            if part in self.added:
                out.append(array("I", [self.added[part]]).tobytes())
                continue
            for piece, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(part)) if part else []:
                out.append(self.piece[piece])
        return b"".join(out)

    def forget(self) -> None:
        """Empty the memos: the worker lives on, and its next task may be another operator's."""
        for memo in (self.chunk, self.piece, self.compatible):
            memo.clear()

    def encode(self, text: bytes) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.chunk.__getitem__, text.split())), "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        """Token strings joined by a space, as the library does for a file without a decoder."""
        out = []
        for i in range(0, len(ids), DECODE_STEP):
            part = ids[i : i + DECODE_STEP].astype(np.int64)
            start, size = self.offset[part], self.offset[part + 1] - self.offset[part]
            at = np.repeat(start - np.cumsum(size) + size, size)
            out.append(self.table[at + np.arange(len(at))].tobytes())
        return b"".join(out)[:-1]


@lru_cache(maxsize=2)
def load_codec(path: str) -> Codec:
    return Codec(path)


RESULTS = {"ids": "binary", "decoded": "string", "ids_sha256": "string", "decoded_sha256": "string"}


def encode_decode(df: DataFrame, path: str, text: str = "text", results: tuple[str, ...] = ("ids", "decoded")) -> DataFrame:
    """Appends n_tokens (long) and, per text, the ``results`` asked for.

    ids: little-endian unsigned 32-bit integers (binary); decoded: their decoding (string); ids_sha256 and
    decoded_sha256: lowercase hex of these, the decoding in UTF-8. A null or empty
    text encodes to nothing and decodes to the empty string. Repeated rows are
    encoded each for itself; other columns pass through, those named like the
    results are replaced; an empty table gives an empty one. No shuffle.
    """
    bound_batches(df.sparkSession)

    def make():
        codec = load_codec(path)
        value = {
            "ids": lambda raw, d: raw, "decoded": lambda raw, d: d.decode("utf-8", "replace"),
            "ids_sha256": lambda raw, d: hashlib.sha256(raw).hexdigest(), "decoded_sha256": lambda raw, d: hashlib.sha256(d).hexdigest()}

        def each(batch: pa.Array) -> pa.Array:
            n, columns = [], [[] for _ in results]
            for t in utf8(batch):
                ids = codec.encode(t)
                decoded = codec.decode(ids) if any("decoded" in r for r in results) else b""
                raw = ids.tobytes()
                n.append(len(ids))
                for column, r in zip(columns, results):
                    column.append(value[r](raw, decoded))
            return pa.StructArray.from_arrays([pa.array(n, pa.int64()), *[pa.array(c, RESULTS[r]) for c, r in zip(columns, results)]], ["n_tokens", *results])

        each.done = codec.forget
        return each

    kind = "struct<n_tokens:bigint," + ",".join(f"{r}:{RESULTS[r]}" for r in results) + ">"
    coded = F.arrow_udf(by_batch(make), kind, F.ArrowUDFType.SCALAR_ITER)
    return with_fields(df, coded(F.col(text)), ["n_tokens", *results])
