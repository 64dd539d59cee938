"""Embedding near-duplicates (operator 12) by cross-polytope hashing.

1. Equal vectors form a class, compared once. A class is rotated pseudo-randomly
   (three rounds of random signs and a fast Hadamard transform); the coordinate of
   greatest size, with its sign, is a hash. ``functions`` hashes make a
   table's bucket, and ``tables`` tables are kept. Multiprobe: in each table a class
   also enters the ``probes`` buckets where the second or third coordinate, least behind, replaces the first.
2. Classes within half the limit's angle of a bucket's first class form a ball; all
   of a ball link with each other, so crowds of near copies become one row.
3. Balls that share a bucket are compared, in blocks of bounded size; only pairs
   that can hold a link come out. By the triangle inequality most are linked
   as a whole or not at all; the members of the others are compared one by one, in blocks too.
4. A vector's links are counted per class, ball and pair of balls, never listed. The
   pairs of balls give the components by large-star and small-star steps.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.components import components
from marketlake.llm.embeddings import all_finite, hadamard
from marketlake.llm.text import Scratch, fresh, mix, odd_numbers, written


@dataclass(frozen=True)
class Alike:
    """Links: cosine >= ``least``. A pair at the limit 0.95 in 64 dimensions shares a bucket of one
    table with probability 0.63 (measured for 3 functions and 2 probes), so 14 tables miss it with 1e-6."""

    least: float = 0.95
    tables: int = 14
    functions: int = 3
    probes: int = 2
    seed: int = 12


BLOCK = 1024  # vectors of a side that a task compares at once
TASK_ROWS = 20_000  # rows of small groups that share a task
BALL_ROUNDS = 3  # rounds in which buckets' first classes gather balls; what is left stays single
SLACK = 1e-6  # radians by which a bound must hold
CLOSE = 1e-9  # cosines this near the limit are computed anew, one pair at a time


def units(lists: pa.Array) -> list[np.ndarray]:
    """Each vector at length 1, in double precision."""
    out = []
    at = np.asarray(lists.offsets)
    flat = np.asarray(lists.values).astype(np.float64)
    for a, b in zip(at, at[1:]):
        x = flat[a:b] / np.abs(flat[a:b]).max()  # no overflow or underflow in the squares
        out.append(x / np.sqrt((x * x).sum()))
    return out


def linked(x: np.ndarray, y: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(cosines of all rows of x with all rows of y, whether they reach the limit)."""
    cosine = x @ y.T
    hit = cosine >= least
    for i, j in np.argwhere(np.abs(cosine - least) < CLOSE):
        hit[i, j] = (x[i] * y[j]).sum() >= least
    return cosine, hit


class Tables:
    """The bucket keys of vectors of one dimension."""

    def __init__(self, dimension: int, alike: Alike):
        self.alike, self.dimension = alike, dimension
        self.size = 1 << max(1, (dimension - 1).bit_length())
        count = alike.tables * alike.functions
        self.signs = np.random.default_rng([alike.seed, dimension]).choice([-1.0, 1.0], size=(count, 3, self.size))

    def hashes(self, x: np.ndarray, signs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(coordinate and sign of the three greatest by size, how far each is behind the first), three columns each."""
        for flips in signs:
            x = hadamard(x * flips) / np.sqrt(self.size)
        each, left = np.arange(len(x)), np.abs(x)
        codes, sizes = [], []
        for _ in range(3):
            top = left.argmax(axis=1)
            codes.append(2 * top + (x[each, top] < 0))
            sizes.append(left[each, top])
            left[each, top] = -1
        return np.stack(codes, 1), sizes[0][:, None] - np.stack(sizes, 1)

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        """A row of bucket keys per vector: of each table its own and its probes."""
        x = np.zeros((len(vectors), self.size))
        x[:, : self.dimension] = vectors
        most, each, out = self.alike.functions, np.arange(len(x)), []
        weights = odd_numbers(most + 2, self.alike.seed)
        for t in range(self.alike.tables):
            found = [self.hashes(x, s) for s in self.signs[t * most : (t + 1) * most]]
            codes = np.stack([c for c, _ in found], 1)  # vector, function, place
            behind = np.concatenate([b[:, 1:] for _, b in found], 1)
            entries = [codes[:, :, 0]]
            for other in np.argsort(behind, axis=1, kind="stable")[:, : self.alike.probes].T:
                probe = codes[:, :, 0].copy()
                probe[each, other // 2] = codes[each, other // 2, other % 2 + 1]
                entries.append(probe)
            base = np.uint64((t * int(weights[-1]) + self.dimension * int(weights[-2])) & 0xFFFFFFFFFFFFFFFF)
            out += [mix((e.astype(np.uint64) * weights[:most]).sum(axis=1, dtype=np.uint64) + base) for e in entries]
        return np.stack(out, 1).view(np.int64)


def bucket_keys(classes: DataFrame, alike: Alike) -> DataFrame:
    """(key, c) of classes (c, v)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[int, Tables] = {}
        for batch in batches:
            vectors = units(batch.column(1))
            keys: list = [None] * len(vectors)
            sizes = np.array([len(v) for v in vectors])
            for size in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == size)
                if size not in tables:
                    tables[size] = Tables(size, alike)
                for i, row in zip(own, tables[size].keys(np.stack([vectors[i] for i in own]))):
                    keys[i] = row
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.list_(pa.int64()))], ["c", "keys"])

    return classes.select("c", "v").mapInArrow(sign, "c bigint, keys array<bigint>").select(F.explode("keys").alias("key"), "c")


def cosine_of(x: str, y: str):
    """The cosine of two vector columns, row by row."""

    def each(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([float((u * v).sum()) if len(u) == len(v) else -1.0 for u, v in zip(units(a), units(b))], pa.float64())

    return F.arrow_udf(each, "double")(F.col(x), F.col(y))


def balls_of(members: DataFrame, classes: DataFrame, alike: Alike, steps: Scratch) -> DataFrame:
    """(c, ball, cosine) of the classes that lie in a ball, its first class (cosine 1) included."""
    within = float(np.cos(np.arccos(alike.least) / 2 - SLACK))
    vectors, found, left = classes.select("c", "v"), [], members
    for _ in range(BALL_ROUNDS):
        first = steps.written(left.groupBy("key").agg(F.min("c").alias("first"), F.max("c").alias("last")).where("first <> last").select("key", "first"))
        stars = steps.written(left.join(first, "key").where("c <> first").select("first", "c").distinct())
        sides = stars.join(vectors, "c").join(vectors.select(F.col("c").alias("first"), F.col("v").alias("w")), "first")
        near = steps.written(sides.select("first", "c", cosine_of("v", "w").alias("cosine")).where(F.col("cosine") >= within))
        if near.isEmpty():
            break
        chosen = steps.written(near.groupBy("c").agg(F.min(F.struct("first", "cosine")).alias("m")).select("c", F.col("m.first").alias("ball"), F.col("m.cosine").alias("cosine")))
        # A class that lies in another's ball does not lead one.
        led = chosen.join(chosen.select(F.col("c").alias("ball")), "ball", "left_anti").select("c", "ball", "cosine")
        leaders = led.select(F.col("ball").alias("c")).distinct().select("c", F.col("c").alias("ball"), F.lit(1.0).alias("cosine"))
        found.append(steps.written(led.unionByName(leaders)))
        left = steps.written(left.join(found[-1].select("c"), "c", "left_anti"))
    return reduce(DataFrame.unionByName, found) if found else members.limit(0).select("c", F.col("c").alias("ball"), F.lit(1.0).alias("cosine"))


def runs(column: np.ndarray) -> Iterator[tuple[int, int]]:
    """The stretches of equal values of a sorted column."""
    edges = np.flatnonzero(np.diff(column)) + 1
    yield from zip([0, *edges], [*edges, len(column)]) if len(column) else ()


def task_key(group: str, i, j, alone, lot):
    """The task of a row: small groups share a lot, a larger group has one task for each pair of blocks."""
    return F.when(alone, F.struct(lot.alias("lot"), F.lit(-1).alias("i"), F.lit(-1).alias("j"))).otherwise(
        F.struct(F.xxhash64(group).alias("lot"), i.cast("int").alias("i"), j.cast("int").alias("j")))


def ball_pairs(keyed: DataFrame, balls: DataFrame, alike: Alike, steps: Scratch) -> DataFrame:
    """(a, b, whole): pairs of balls that share a bucket and can hold a link; whole: all their vectors link.

    ``keyed``: (key, ball), distinct. ``balls``: (ball, v, reach), the angle of its farthest member.
    """
    sizes = steps.written(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("key", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"), "size"))
    lots = 1 + (sizes.agg(F.sum("size")).first()[0] or 0) // TASK_ROWS
    rows = keyed.join(sizes.drop("size"), "key").join(balls, "ball")
    own = F.pmod(F.xxhash64("ball", "key"), F.col("blocks"))
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    task = task_key("key", F.least("own", "other"), F.greatest("own", "other"), F.col("blocks") == 1, F.pmod(F.xxhash64("key"), F.lit(lots)))
    limit = float(np.arccos(alike.least))

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by([("key", "ascending"), ("ball", "ascending")]).combine_chunks()
        ball, reach = table["ball"].to_numpy(), table["reach"].to_numpy()
        vectors = units(table["v"].combine_chunks())
        a, b, whole = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, bool)]
        for begin, end in runs(table["key"].to_numpy()):
            x = np.stack(vectors[begin:end])
            for at in range(begin, end, BLOCK):
                to = min(at + BLOCK, end)
                cosine, hit = linked(x[at - begin : to - begin], x, alike.least)
                slack = reach[at:to, None] + reach[None, begin:end]
                angle = np.arccos(np.clip(cosine, -1, 1))
                can = np.where(slack == 0, hit, angle - slack <= limit + SLACK)
                i, j = np.nonzero(can & (ball[at:to, None] < ball[None, begin:end]))
                a.append(ball[at:to][i])
                b.append(ball[begin:end][j])
                whole.append(np.where(slack == 0, hit, angle + slack <= limit - SLACK)[i, j])
        return pa.table({"a": np.concatenate(a), "b": np.concatenate(b), "whole": np.concatenate(whole)})

    pairs = rows.select("key", "ball", "v", "reach", task.alias("task")).groupBy("task.lot", "task.i", "task.j").applyInArrow(lambda t: compare(t), "a bigint, b bigint, whole boolean")
    return pairs.groupBy("a", "b").agg(F.max("whole").alias("whole"))


def member_links(mixed: DataFrame, members: DataFrame, sizes: DataFrame, alike: Alike, steps: Scratch) -> DataFrame:
    """(c, got, a, b): class c of ball a links with ``got`` vectors of the ball b, for pairs of balls that link in part.

    ``mixed``: (a, b). ``members``: (ball, c, v, n). ``sizes``: (ball, classes). The ball of more classes owns a pair;
    its members are read once for all its partners.
    """
    first, second = (sizes.select(F.col("ball").alias(x), F.col("classes").alias(f"{x}s")) for x in "ab")
    sized = mixed.join(first, "a").join(second, "b")
    swap = F.col("bs") > F.col("as")
    owned = steps.written(sized.select(F.when(swap, F.col("b")).otherwise(F.col("a")).alias("owner"), F.when(swap, F.col("a")).otherwise(F.col("b")).alias("partner"), F.greatest("as", "bs").alias("own"), F.least("as", "bs").alias("theirs")))
    blocks = steps.written(owned.groupBy("owner").agg(F.ceil(F.max("own") / BLOCK).cast("int").alias("ib"), F.ceil(F.sum("theirs") / BLOCK).cast("int").alias("jb"), (F.max("own") + F.sum("theirs")).alias("rows")))
    lots = 1 + (blocks.agg(F.sum("rows")).first()[0] or 0) // TASK_ROWS
    blocks = blocks.drop("rows")
    own = members.join(blocks.withColumnRenamed("owner", "ball"), "ball").select(F.col("ball").alias("owner"), "ball", "c", "v", "n", "ib", "jb", F.pmod(F.xxhash64("c"), F.col("ib")).alias("i"), F.explode(F.sequence(F.lit(0), F.col("jb") - 1)).alias("j"))
    partners = members.join(owned.join(blocks, "owner").select("owner", F.col("partner").alias("ball"), "ib", "jb"), "ball").select("owner", "ball", "c", "v", "n", "ib", "jb", F.explode(F.sequence(F.lit(0), F.col("ib") - 1)).alias("i"), F.pmod(F.xxhash64("c"), F.col("jb")).alias("j"))
    task = task_key("owner", F.col("i"), F.col("j"), F.col("ib") * F.col("jb") == 1, F.pmod(F.xxhash64("owner"), F.lit(lots)))

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by([("owner", "ascending"), ("ball", "ascending"), ("c", "ascending")]).combine_chunks()
        owner, ball, c, n = (table[x].to_numpy() for x in ("owner", "ball", "c", "n"))
        vectors = units(table["v"].combine_chunks())
        out: dict[str, list] = {"c": [], "got": [], "a": [], "b": []}

        def add(who: np.ndarray, got: np.ndarray, a: int, b: int) -> None:
            some = np.flatnonzero(got)
            for name, column in (("c", who[some]), ("got", got[some]), ("a", np.full(len(some), a)), ("b", np.full(len(some), b))):
                out[name].append(column)

        for begin, end in runs(owner):
            places = {int(ball[begin + a]): (begin + a, begin + b) for a, b in runs(ball[begin:end])}
            lo, hi = places.pop(int(owner[begin]), (0, 0))
            if lo == hi:
                continue
            x = np.stack(vectors[lo:hi])
            for other, (p, q) in places.items():
                for at in range(p, q, BLOCK):
                    to = min(at + BLOCK, q)
                    _, hit = linked(x, np.stack(vectors[at:to]), alike.least)
                    add(c[lo:hi], hit @ n[at:to], int(owner[begin]), other)
                    add(c[at:to], n[lo:hi] @ hit, other, int(owner[begin]))
        return pa.table({k: np.concatenate(v) if v else np.zeros(0, np.int64) for k, v in out.items()})

    rows = own.unionByName(partners).select("owner", "ball", "c", "v", "n", task.alias("task"))
    return rows.groupBy("task.lot", "task.i", "task.j").applyInArrow(lambda t: compare(t), "c bigint, got bigint, a bigint, b bigint")


def near_vectors(vectors: DataFrame, alike: Alike = Alike(), vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links (long, other vectors linked directly), component_id, kept.

    Cosines are in double precision. A vector that is null, empty, all zeros, or holds nulls, NaN
    or infinities links with nothing, nor do rows without an id (component_id null, kept) or
    vectors of different lengths. component_id is the smallest id reachable by links. Rows of
    equal vectors link with each other, rows of one id too where their vectors do; each
    row counts for itself. An empty table gives an empty one; other columns are not read.
    """
    usable = F.col("id").isNotNull() & all_finite("v") & F.exists("v", lambda x: x != 0)
    rows = vectors.select(F.col(vec_id).alias("id"), F.col(vector).alias("v")).withColumn("usable", F.coalesce(usable, F.lit(False)))
    with Scratch(vectors.sparkSession) as steps:
        classes = steps.written(rows.where("usable").groupBy("v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n")).select(F.monotonically_increasing_id().alias("c"), "v", "id", "n"))
        keyed = steps.written(bucket_keys(classes, alike))
        crowded = steps.written(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("key"))
        members = steps.written(keyed.join(crowded, "key"))
        inside = steps.written(balls_of(members, classes, alike, steps))
        placed = steps.written(classes.join(inside, "c", "left").select("c", "v", "id", "n", F.coalesce("ball", "c").alias("ball"), F.coalesce("cosine", F.lit(1.0)).alias("cosine")))
        # A single class reaches 0 exactly; the angle of a ball's farthest member is never rounded below 0.
        sizes = steps.written(placed.groupBy("ball").agg(F.count(F.lit(1)).alias("classes"), F.sum("n").alias("size"), F.min("cosine").alias("far"), F.min("id").alias("id"))
                              .withColumn("reach", F.when(F.col("classes") == 1, 0.0).otherwise(F.acos(F.least("far", F.lit(1.0))) + SLACK)))
        entered = steps.written(members.join(placed.select("c", "ball"), "c").select("key", "ball").distinct())
        balls = placed.where("c = ball").select("ball", "v").join(sizes.select("ball", "reach"), "ball")
        pairs = steps.written(ball_pairs(entered, steps.written(balls), alike, steps))
        some = steps.written(member_links(pairs.where("not whole").select("a", "b"), placed.select("ball", "c", "v", "n"), sizes.select("ball", "classes"), alike, steps))
        whole = pairs.where("whole").select("a", "b")
        both = whole.unionByName(whole.select(F.col("b").alias("a"), F.col("a").alias("b")))
        by_ball = both.join(sizes.select(F.col("ball").alias("b"), "size"), "b").groupBy(F.col("a").alias("ball")).agg(F.sum("size").alias("near"))
        by_class = some.groupBy("c").agg(F.sum("got").alias("got"))
        group = components(whole.unionByName(some.select("a", "b").distinct()), "a", "b").withColumnRenamed("node", "ball")
        group = steps.written(sizes.join(group, "ball", "left").join(by_ball, "ball", "left").select("ball", "size", "id", "near", F.coalesce("component", "ball").alias("component")))
        least = steps.written(group.groupBy("component").agg(F.min("id").alias("component_id")))
        group = steps.written(group.join(least, "component").select("ball", (F.col("size") - 1 + F.coalesce("near", F.lit(0))).alias("links"), "component_id"))
        counted = placed.select("c", "v", "ball").join(group, "ball").join(steps.written(by_class), "c", "left")
        counted = written(counted.select("v", (F.col("links") + F.coalesce("got", F.lit(0))).alias("n_links"), "component_id"))
    key = fresh("v")
    alone = rows.where("not usable").select(F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    found = rows.where("usable").join(counted.withColumnRenamed("v", key), F.col("v") == F.col(key)).select(F.col("id").alias("vec_id"), "n_links", "component_id")
    return found.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
