"""Token counts by heap-and-linked-list byte-pair merging (operator 2).

The model is a SentencePiece BPE file with byte fallback and identity
normalisation. A text is prefixed with a space; spaces are the word marker. The
symbols are its characters in a doubly linked list, and a heap gives the
adjacent pair of best rank (leftmost on ties) until none can merge. The count is
the initial symbols minus the merges; a symbol left outside the vocabulary
counts as its UTF-8 bytes. No identifiers are made.

No piece holds a marker after another character or a line break (checked on the
vocabulary), so merges never cross these places and the parts between them are
counted independently, with a bounded memo. Texts without such places are merged
as a whole; nothing is cut.
"""

from __future__ import annotations

import heapq
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.text import Memo, bound_batches, by_batch, strings, with_fields


PARTS = 1_000_000  # parts of texts whose count a worker keeps (about 150 MB)


class MergeCounter:
    """Counts tokens of a piece -> rank table (lower rank merges first)."""

    def __init__(self, ranks: dict[str, float]):
        self.ranks = ranks
        inner = {c for p in ranks if len(p) > 1 for c in p}
        alone = "".join(c for c in "\n\r\t" if c not in inner)
        cut = "" if any(re.search("[^ ] ", p) for p in ranks) else " "
        stop = re.escape(cut + alone)
        pattern = (f"{cut}+[^{stop}]*|" if cut else "") + (f"[^{stop}]+|[{stop}]" if stop else "(?s:.+)")
        self.parts = re.compile(pattern).findall
        self.part = Memo(self.merge, most=PARTS)

    def merge(self, text: str) -> int:
        ranks, sym, n = self.ranks, list(text), len(text)
        prev, nxt = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(ranks[p], i, p) for i in range(n - 1) if (p := sym[i] + sym[i + 1]) in ranks]
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = nxt[i] if sym[i] else -1
            if j < 0 or sym[i] + sym[j] != pair:
                continue  # one of the two has merged meanwhile
            sym[i], sym[j] = pair, ""
            merges += 1
            nxt[i] = k = nxt[j]
            if k >= 0:
                prev[k] = i
                if (p := pair + sym[k]) in ranks:
                    heapq.heappush(heap, (ranks[p], i, p))
            if (h := prev[i]) >= 0 and (p := sym[h] + pair) in ranks:
                heapq.heappush(heap, (ranks[p], h, p))
        extra = sum(len(s.encode()) - 1 for s in sym if s and s not in ranks)
        return n - merges + extra

    def count(self, text: str) -> int:
        if not text:
            return 0
        return sum(map(self.part.__getitem__, self.parts(" " + text.replace("▁", " "))))


@lru_cache(maxsize=2)
def load_counter(path: str) -> MergeCounter:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = (i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)))
    return MergeCounter({model.id_to_piece(i).replace("▁", " "): -model.get_score(i) for i in plain})


def token_counts(df: DataFrame, model_path: str, text: str = "text", most: int = 4096) -> DataFrame:
    """Appends n_bytes (long, UTF-8), n_tokens (long), over_limit (n_tokens > ``most``).

    A null or empty text has 0 of both. Repeated rows count each for itself;
    other columns pass through, those named like the three are replaced. An
    empty table gives an empty one. No shuffle: one pass over the texts.
    """
    bound_batches(df.sparkSession)

    def make():
        count = load_counter(model_path).count

        def each(batch: pa.Array) -> pa.Array:
            texts = strings(batch)
            tokens = [count(t) for t in texts]
            return pa.StructArray.from_arrays(
                [pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(tokens, pa.int64()), pa.array([n > most for n in tokens], pa.bool_())],
                ["n_bytes", "n_tokens", "over_limit"])

        return each

    counted = F.arrow_udf(by_batch(make), "struct<n_bytes:bigint,n_tokens:bigint,over_limit:boolean>", F.ArrowUDFType.SCALAR_ITER)
    return with_fields(df, counted(F.col(text)), ["n_bytes", "n_tokens", "over_limit"])
