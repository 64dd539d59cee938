"""Weak-label quality classifier (operator 1).

Overlapping heuristic labellers vote on every document (good, bad, or nothing). Expectation-
maximisation estimates their accuracies from the votes alone, without any true label: all it
needs are the counts of the vote patterns over the whole corpus, at most 3 ** labellers rows. The
posterior of a pattern labels a bounded sample of documents, on which a hashed linear scorer is
trained; it scores every document. One model is made for quality and one for toxicity.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.host_rules import measure
from marketlake.llm.text import LETTERS, SPACED, bound_batches, by_batch, scan_words, utf8, with_fields
from marketlake.session import cut_lineage

BITS = 18  # of a feature's hash
TRAIN_ROWS = 16000  # documents the scorer is trained on, about; a sample by hash of the id
LEAST_FREQUENCY = 5  # documents of the sample in which a feature must occur to get a weight
ABSTAIN, NO, YES = 0, 1, 2

# A list of common insults; fixed values.
INSULTS = ("idiot", "moron", "imbecile", "cretin", "fool", "clown", "loser", "scum", "trash", "vermin", "lowlife", "jerk")
SLIGHTS = ("stupid", "dumb", "pathetic", "worthless", "disgusting", "filthy", "despicable", "idiotic", "moronic", "hideous")


ENGLISH = ("the", "of", "and", "to", "in", "is", "that", "it", "for", "was", "with", "as", "on", "are", "this", "you", "be")


def _codes(words: tuple[str, ...]) -> np.ndarray:
    return scan_words(pa.array([" ".join([w, w + "s", w + "es"]) for w in words]), LETTERS)[0]


def _votes(bad: np.ndarray, good: np.ndarray) -> np.ndarray:
    return np.where(bad, NO, np.where(good, YES, ABSTAIN))


def quality_votes(texts: pa.Array) -> np.ndarray:
    """A row of votes for each text; a text without words gets NO from the first labeller only."""
    words, chars, _, dups, repeats, lines, shouted, marked = measure(texts)
    raw = utf8(texts)
    bars = np.array([t.count(b" | ") for t in raw], np.int64)
    ended = np.array([len(ENDED.findall(t)) for t in raw], np.int64)
    some, never = words > 0, words < 0
    # Labellers of a defect abstain where they find none; the last three tell good from bad.
    return np.column_stack([
        _votes(words < 20, never),
        _votes(some & (repeats * 10 > words * 3), never),
        _votes(some & (marked * 10 > words), never),
        _votes(some & (shouted * 10 > words * 3), never),
        _votes(some & (dups * 10 > lines * 3), never),
        _votes(some & (bars * 10 > words), never),
        _votes(some & (ended * 5 < lines), some & (ended * 5 > lines * 3)),
        _votes(some & ((chars * 2 < words * 5) | (chars > words * 15)), some & (chars >= words * 3) & (chars <= words * 10)),
        _votes(never, (words >= 50) & (marked + shouted + bars == 0) & (repeats * 10 < words)),
    ])


def toxic_votes(texts: pa.Array) -> np.ndarray:
    """A row of votes for each text. Only English without a hit is voted clean: the word lists are English."""
    codes, begin = scan_words(pc.utf8_lower(texts.cast(pa.large_string())), LETTERS)

    def count(words: tuple[str, ...]) -> np.ndarray:
        return np.diff(np.concatenate([np.zeros(1, np.int64), np.cumsum(np.isin(codes, _codes(words)))])[begin])

    insults, slights, english = count(INSULTS), count(SLIGHTS), count(ENGLISH)
    hits, never = insults + slights, begin[1:] < 0
    return np.column_stack([_votes(never, insults > 0), _votes(never, slights > 0), _votes(never, hits > 1), _votes((hits == 0) & (english * 10 > np.diff(begin)), never)])


ENDED = re.compile(rb"[.!?][\"')]*[ \t\r]*(?:\n|$)")
# Labellers, their number, and whether abstention depends on the class.
VOTES = {"quality": (quality_votes, 9, True), "toxic": (toxic_votes, 4, False)}


def numbers(votes: np.ndarray) -> np.ndarray:
    """A row of votes as one number to the base of 3."""
    return votes @ 3 ** np.arange(votes.shape[1])[::-1]


def unnumber(pattern: int, labellers: int) -> list[int]:
    return [pattern // 3 ** (labellers - 1 - i) % 3 for i in range(labellers)]


@dataclass
class LabelModel:
    """P(vote | class) per labeller, and the share of YES."""

    prior: float
    table: np.ndarray  # labeller x class x vote

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """P(YES) of rows of votes."""
        at = np.arange(votes.shape[1])
        odds = np.log(self.prior / (1 - self.prior)) + sum(np.log(self.table[i, 1, votes[:, i]] / self.table[i, 0, votes[:, i]]) for i in at)
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))

    def accuracies(self) -> np.ndarray:
        """Of each labeller's votes other than abstentions, the share expected to be right."""
        right = self.table[:, 1, YES] * self.prior + self.table[:, 0, NO] * (1 - self.prior)
        return right / ((self.table[:, 1, YES] + self.table[:, 1, NO]) * self.prior + (self.table[:, 0, YES] + self.table[:, 0, NO]) * (1 - self.prior))


def fit_label_model(patterns: dict[int, int], labellers: int, by_class: bool, rounds: int = 200) -> LabelModel:
    """Expectation-maximisation over the counts of vote patterns, started from the share of YES among
    each pattern's votes (ties and no votes: 0.5), so that YES keeps its meaning. Counts are smoothed by one.

    ``by_class``: each labeller has its own chance of each vote, abstention included, in either
    class. Else each has one accuracy, and an abstention tells nothing: for labellers that are silent
    for reasons of their own, such as the language.
    """
    votes = np.array([unnumber(p, labellers) for p in sorted(patterns)]).reshape(-1, labellers)
    n = np.array([patterns[p] for p in sorted(patterns)], float)
    yes, no = (votes == YES).sum(1), (votes == NO).sum(1)
    p = np.where(yes + no > 0, (yes + 0.5) / (yes + no + 1), 0.5)
    told = np.ones(len(n), bool) if by_class else yes + no > 0
    model = None
    for _ in range(rounds):
        table = np.ones((labellers, 2, 3))
        for v in range(3):
            hit = votes == v
            table[:, 1, v] += (hit * (n * p)[:, None]).sum(0)
            table[:, 0, v] += (hit * (n * (1 - p))[:, None]).sum(0)
        if by_class:
            table /= table.sum(2, keepdims=True)
        else:
            right = table[:, 1, YES] + table[:, 0, NO]
            accuracy = right / (right + table[:, 1, NO] + table[:, 0, YES])
            table[:, :, ABSTAIN] = 1
            table[:, 1, YES] = table[:, 0, NO] = accuracy
            table[:, 1, NO] = table[:, 0, YES] = 1 - accuracy
        prior = ((n * p)[told].sum() + 1) / (n[told].sum() + 2)
        before, model = p, LabelModel(float(prior), table)
        p = model.posterior(votes) if len(votes) else p
        if len(p) == 0 or np.abs(p - before).max() < 1e-6:
            break
    return model


# The form of a word: letters by case, digits, punctuation as it is.
SHAPES = SPACED.copy()
for _c in range(256):
    SHAPES[_c] = 0 if SPACED[_c] == 0 else ord("0") if chr(_c).isdigit() and _c < 128 else ord("A") if 65 <= _c < 91 else ord("a") if _c >= 128 or chr(_c).isalpha() else max(_c, 1)


def features(texts: pa.Array) -> list[np.ndarray]:
    """The distinct hashed features of each text: its words, and the forms of its words."""
    lower = pc.utf8_lower(texts.cast(pa.large_string()))
    parts = []
    for array, table, salt in ((lower, LETTERS, 0), (texts, SHAPES, 0x5BD1E995)):
        codes, begin = scan_words(array, table)
        parts.append((((codes + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS), begin))
    (a, x), (b, y) = parts
    return [np.unique(np.concatenate([a[x[i] : x[i + 1]], b[y[i] : y[i + 1]]])).astype(np.int32) for i in range(len(texts))]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def scores(rows: list[np.ndarray], weights: np.ndarray, bias: float) -> np.ndarray:
    return np.array([float(_sigmoid(np.array(weights[r].sum() + bias))) for r in rows], np.float64)


def fit_scorer(rows: list[np.ndarray], target: np.ndarray, epochs: int = 6, penalty: float = 1e-4, seed: int = 3) -> tuple[np.ndarray, float]:
    """Logistic regression on soft targets by AdaGrad over single documents (each feature steps by its own history)."""
    weights, past = np.zeros(1 << BITS), np.full(1 << BITS, 1.0)
    bias, bias_past = 0.0, 1.0
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            r = rows[i]
            g = float(_sigmoid(np.array(weights[r].sum() + bias))) - target[i]
            step = g + penalty * weights[r]
            past[r] += step * step
            weights[r] -= 0.2 * step / np.sqrt(past[r])
            bias_past += g * g
            bias -= 0.2 * g / np.sqrt(bias_past)
    return weights, bias


def train(docs: DataFrame, labels: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text", train_rows: int = TRAIN_ROWS) -> dict[str, tuple[LabelModel, np.ndarray, float]]:
    """Label models from the votes on all documents; scorers from about ``train_rows`` of them.

    ``labels`` (doc_id, quality, toxic: 0 or 1), if given, is one more labeller, of human votes on some
    documents, whose accuracy is estimated like the others'. Half of the sample is
    drawn from the documents it covers. Several labels of a document count as their least value.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    names = list(VOTES)
    kind = docs.schema[doc_id].dataType.simpleString()

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(numbers(VOTES[n][0](batch.column(1))), pa.int32()) for n in names]], ["doc_id", *names])

    if labels is None:
        labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    human = labels.groupBy("doc_id").agg(*[F.min(n).alias(f"human_{n}") for n in names])
    judged = [F.coalesce(F.when(F.col(f"human_{n}") > 0, YES).when(F.col(f"human_{n}") == 0, NO), F.lit(ABSTAIN)) for n in names]
    voted = docs.select(doc_id, text).mapInArrow(vote, f"doc_id {kind}, " + ", ".join(f"{n} int" for n in names)).join(human, "doc_id", "left")
    pattern = [(F.col(n) * 3 + j).alias(n) for n, j in zip(names, judged)]
    voted = voted.select("doc_id", *pattern, (sum(judged) > 0).alias("judged"))
    # At most 3 ** labellers patterns, however many documents.
    counts = cut_lineage(voted.groupBy(*names, "judged").count()).collect()
    models = {}
    for n in names:
        patterns: dict[int, int] = {}
        for r in counts:
            patterns[r[n]] = patterns.get(r[n], 0) + r["count"]
        models[n] = fit_label_model(patterns, VOTES[n][1] + 1, VOTES[n][2])

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [pa.array(3 * numbers(VOTES[n][0](batch.column(0))), pa.int32()) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, batch.column(1), batch.column(2), pa.array(features(batch.column(0)), pa.list_(pa.int32()))], [*names, "human_quality", "human_toxic", "features"])

    covered = sum(r["count"] for r in counts if r["judged"])
    other = sum(r["count"] for r in counts if not r["judged"])
    half = train_rows // 2 if covered and other else train_rows
    lot = F.pmod(F.xxhash64(doc_id, F.xxhash64(text)), F.lit(1 << 30))
    below = (lambda n: F.lit(int(min(1.0, half / max(n, 1)) * (1 << 30))))
    drawn = docs.select(doc_id, text).where(lot < F.greatest(below(covered), below(other)))
    drawn = drawn.join(human.withColumnRenamed("doc_id", doc_id), doc_id, "left").select(text, *[F.coalesce(f"human_{n}", F.lit(-1)).cast("int").alias(f"human_{n}") for n in names], doc_id)
    drawn = drawn.where(lot < F.when(F.greatest("human_quality", "human_toxic") >= 0, below(covered)).otherwise(below(other)))
    schema = ", ".join(f"{n} int" for n in names) + ", human_quality int, human_toxic int, features array<int>"
    table = drawn.select(text, "human_quality", "human_toxic").mapInArrow(sample, schema).limit(2 * train_rows).toArrow().combine_chunks()
    rows = [np.array(f, np.int32) for f in table["features"].to_pylist()]
    order = sorted(range(len(rows)), key=lambda i: rows[i].tobytes())  # the training does not hang on the order of arrival
    rows = [rows[i] for i in order]
    frequency = np.bincount(np.concatenate([np.zeros(0, np.int32), *rows]), minlength=1 << BITS)
    rows = [r[frequency[r] >= LEAST_FREQUENCY] for r in rows]
    out = {}
    for n in names:
        said = table[f"human_{n}"].to_numpy()
        votes = np.array([unnumber(int(p) + (YES if h > 0 else NO if h == 0 else ABSTAIN), VOTES[n][1] + 1) for p, h in zip(table[n].to_pylist(), said)]).reshape(-1, VOTES[n][1] + 1)[order]
        target = models[n].posterior(votes) if len(votes) else np.zeros(0)
        use = np.flatnonzero((votes != ABSTAIN).any(axis=1)) if len(votes) else []
        out[n] = (models[n], *fit_scorer([rows[i] for i in use], target[use] if len(use) else np.zeros(0)))
    return out


def classify(docs: DataFrame, labels: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text", train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Appends quality_score and toxic_score (double, 0 to 1) and kept (quality_score >= 0.5 and toxic_score < 0.5).

    A null or empty text has no feature: it gets the scorer's bias, and is not
    kept. Repeated rows score alike, and each votes; null ids are sampled like any other;
    other columns pass through, those named like a result are replaced; an empty table gives an empty one.
    """
    trained = train(docs, labels, doc_id, text, train_rows)
    parts = {n: (w.astype(np.float32), b) for n, (_, w, b) in trained.items()}
    shared = docs.sparkSession.sparkContext.broadcast(parts)  # two models of 2 ** BITS weights

    def make():
        (qw, qb), (tw, tb) = shared.value["quality"], shared.value["toxic"]

        def each(batch: pa.Array) -> pa.Array:
            rows = features(batch)
            q, t = scores(rows, qw, qb), scores(rows, tw, tb)
            kept = (q >= 0.5) & (t < 0.5) & np.array([len(r) > 0 for r in rows], bool)
            return pa.StructArray.from_arrays([pa.array(q), pa.array(t), pa.array(kept)], ["quality_score", "toxic_score", "kept"])

        return each

    scored = F.arrow_udf(by_batch(make), "struct<quality_score:double,toxic_score:double,kept:boolean>", F.ArrowUDFType.SCALAR_ITER)
    return with_fields(docs, scored(F.col(text)), ["quality_score", "toxic_score", "kept"])
