"""Operators 11, 12 and 13 against brute force on small fixtures."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlake.llm import cross_polytope, fill_middle, queries
from marketlake.llm.cross_polytope import Alike, near_vectors
from marketlake.llm.embeddings import hadamard
from marketlake.llm.fill_middle import Chunked, Summaries, bounds, cuts, fill_in_middle, restored
from marketlake.llm.walsh_clusters import Search, cluster

NAN, INF = float("nan"), float("inf")


def test_transform_keeps_distances():
    rng = np.random.default_rng(1)
    for size in (1, 2, 8, 64):
        a, b = rng.integers(-(10**6), 10**6, (2, 20, size))
        assert ((hadamard(a) - hadamard(b)) ** 2).sum(1).tolist() == (size * ((a - b) ** 2).sum(1)).tolist()


# Operator 11


def brute_nearest(vectors, centroids):
    found = []
    for v in vectors:
        d = [sum((int(x) - int(y)) ** 2 for x, y in zip(v, c)) for c in centroids]
        found.append((d.index(min(d)), min(d)))
    return found


def brute_clusters(rows, k, rounds, seed):
    kept = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows]
    kept.sort(key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in kept[:k]]
    for _ in range(rounds):
        own = brute_nearest([v for _, v in kept], centroids)
        for c in range(len(centroids)):
            mine = [v for (_, v), (n, _) in zip(kept, own) if n == c]
            if mine:
                centroids[c] = [sum(x) // len(mine) for x in zip(*mine)]
    own = brute_nearest([v for _, v in kept], centroids)
    inertia = [sum(d for n, d in own if n == c) for c in range(len(centroids))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i is None, i, n, d, inertia[n], sum(inertia), digest[n]) for (i, _), (n, d) in zip(kept, own)), key=str)


@pytest.mark.parametrize("scale", [3, 1000, 1 << 22, 1 << 25])
def test_search_equals_brute_force(scale):
    rng = np.random.default_rng(scale)
    c = rng.integers(-scale, scale + 1, (12, 64))
    c[5] = c[3]  # a tie: the smaller number
    x = np.concatenate([c, c + rng.integers(-1, 2, c.shape), rng.integers(-scale, scale + 1, (60, 64)), (c[:4] + c[4:8]) // 2])
    number, distance = Search(c).nearest(x)
    assert list(zip(number.tolist(), distance.tolist())) == brute_nearest(x.tolist(), c.tolist())
    assert Search(c).nearest(x[:0])[0].tolist() == []


def vector_rows():
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 0.4, (9, 64))
    rows = [(i, (centres[i % 9] + rng.normal(0, 0.1, 64)).astype(np.float32).tolist()) for i in range(150)]
    rows += [(200, rows[0][1]), (201, rows[0][1]), (3, rows[3][1]), (3, rows[4][1]), (None, rows[7][1])]
    rows += [(210, [float(x) for x in range(-32, 32)]), (211, [1000.0 * (-1) ** j for j in range(64)])]
    return rows


ODD_VECTORS = [(300, None), (301, []), (302, [1.0] * 63), (303, [1.0] * 65), (304, [None] + [1.0] * 63), (305, [NAN] + [1.0] * 63), (306, [1.0] * 63 + [-INF]), (307, [3e38] * 64)]


def test_clusters_equal_brute_force(spark):
    rows = vector_rows()
    df = spark.createDataFrame([(i, v, "x") for i, v in rows + ODD_VECTORS], "vec_id long, embedding array<float>, cluster string").repartition(5)
    got = sorted(((r.vec_id is None, r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in cluster(df, 12, 4, 2).collect()), key=str)
    assert got == brute_clusters(rows, 12, 4, 2)
    few = [r for r in rows if r[0] in (0, 1)]
    got = sorted(((r.vec_id is None, r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in cluster(df.where("vec_id in (0, 1)"), 40, 2, 7).collect()), key=str)
    assert got == brute_clusters(few, 40, 2, 7) and len({r[2] for r in got}) == 2
    empty = cluster(df.where("false"))
    assert empty.count() == 0 and empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


# Operator 12


def brute_links(rows, least=0.95):
    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        x = np.array(v, np.float64)
        x = x / np.abs(x).max()
        return x / np.sqrt((x * x).sum())

    u = [None if i is None else unit(v) for i, v in rows]
    near = [[j for j in range(len(rows)) if j != k and u[j] is not None and u[k] is not None and len(u[j]) == len(u[k]) and (u[j] * u[k]).sum() >= least] for k in range(len(rows))]
    component = list(range(len(rows)))
    for k in range(len(rows)):
        seen, todo = {k}, [k]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        component[k] = min((rows[j][0] for j in seen), key=lambda i: (i is not None, i)) if rows[k][0] is not None else None
    return sorted(((i, len(n), c, i is None or c == i) for (i, _), n, c in zip(rows, near, component)), key=str)


def turned(rng, v, cosine):
    v = np.array(v, np.float64)
    v /= np.linalg.norm(v)
    w = rng.normal(size=len(v))
    w -= (w @ v) * v
    return cosine * v + np.sqrt(1 - cosine**2) * w / np.linalg.norm(w)


def crowd():
    """Single vectors, chains, tight and loose crowds around one vector, equal and scaled copies, odd vectors."""
    rng = np.random.default_rng(8)
    rows, base = [], rng.normal(size=(40, 64))
    rows += [base[i] for i in range(40)]
    chain = base[0]
    for _ in range(12):
        chain = turned(rng, chain, 0.955)
        rows.append(chain)
    rows += [turned(rng, base[1], rng.uniform(0.985, 0.9999)) for _ in range(60)]  # mostly one ball
    rows += [turned(rng, base[2], rng.uniform(0.94, 0.999)) for _ in range(60)]  # balls that link in part
    rows += [turned(rng, base[3], rng.uniform(0.93, 0.965)) for _ in range(30)]  # hardly any ball
    rows += [base[4]] * 20 + [base[4] * 3, base[4] / 7]
    ids = rng.permutation(len(rows)).tolist()
    rows = [(i, v.astype(np.float32).tolist()) for i, v in zip(ids, rows)]
    return rows + [(None, rows[0][1]), (900, None), (901, []), (902, [0.0] * 64), (903, [None, 1.0]), (904, [NAN] * 64), (905, [INF] + [1.0] * 63), (906, [1.0, 2.0]), (907, [1.0, 2.1]), (908, [5.0]), (909, [3e38] * 64), (910, [1e-30] * 64), (rows[5][0], rows[6][1])]


def as_frame(spark, rows):
    return spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, n_links int").repartition(6)


def links_of(df, **like):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in near_vectors(df, Alike(**like)).collect()), key=str)


@pytest.fixture(scope="module")
def crowd_links():
    return brute_links(crowd())


def test_links_equal_brute_force(spark, crowd_links):
    assert sum(r[1] for r in crowd_links) > 3000
    assert links_of(as_frame(spark, crowd())) == crowd_links
    assert near_vectors(as_frame(spark, crowd()).where("false")).count() == 0


def test_links_by_small_blocks_and_without_balls(spark, crowd_links, monkeypatch):
    monkeypatch.setattr(cross_polytope, "BLOCK", 7)
    monkeypatch.setattr(cross_polytope, "TASK_ROWS", 50)
    assert links_of(as_frame(spark, crowd())) == crowd_links
    monkeypatch.setattr(cross_polytope, "BALL_ROUNDS", 0)
    assert links_of(as_frame(spark, crowd())) == crowd_links


def test_crowds_of_near_copies_cost_no_pairs(spark, monkeypatch):
    """Twice the copies of one vector: twice the rows at most in what compares balls."""
    rng = np.random.default_rng(2)
    centre = rng.normal(size=64)
    pairs = []
    compare = cross_polytope.ball_pairs
    monkeypatch.setattr(cross_polytope, "ball_pairs", lambda *a: pairs.append(compare(*a).persist()) or pairs[-1])
    for count in (300, 600):
        copies = [(i, turned(rng, centre, rng.uniform(0.995, 1)).tolist()) for i in range(count)]
        found = near_vectors(spark.createDataFrame(copies, "vec_id long, embedding array<double>")).collect()
        assert {(r.n_links, r.component_id) for r in found} == {(count - 1, 0)}
        assert pairs[-1].count() < 20
        pairs[-1].unpersist()


def test_recall_of_pairs_at_the_limit():
    """A pair just above the limit shares a bucket of the default tables; at half the tables nearly always too."""
    rng = np.random.default_rng(5)
    a = rng.normal(size=(2000, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b = np.stack([turned(rng, v, 0.951) for v in a])
    tables = cross_polytope.Tables(64, Alike())
    x, y = tables.keys(a), tables.keys(b)
    met = (x[:, :, None] == y[:, None, :]).any(axis=(1, 2))
    assert met.all()


# Operator 13

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute_middle(doc_id, text, seed=42, percent=50, spm=80):
    text = text or ""
    tokens = TOKEN.findall(text)
    n, h = len(tokens), hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= percent:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (tokens[:a], tokens[a:b], tokens[b:]))
    if h4 % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def odd_texts():
    rnd = random.Random(13)
    letters = "abc éß文🙂\x85　  \n\t\r\x0b\x00<>PSM"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 80))) for _ in range(500)]
    shared = "".join(rnd.choice(letters) for _ in range(9000))
    texts += [shared, "x " + shared, shared + " y", shared[:5000] + shared, "a" * 200_000, " " * 150_000, "ab " * 60_000, "é" * 100_000 + " z"]
    return texts + [None, "", " ", "a", "<P>", "a <S> b c d", "x<M>", "< P> <", "same text", "same text"]


def test_middles_equal_brute_force(spark, monkeypatch):
    texts = odd_texts()
    rows = [(i, t, "x", "y") for i, t in enumerate(texts)] + [(None, "one two three", "x", "y"), (3, texts[3], "x", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n string, other string").repartition(3)
    out = fill_in_middle(df, percent=80).withColumn("back", restored(F.col("output"), F.col("form")))
    got = sorted(((r.doc_id, r.text, r.other, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in out.collect()), key=str)
    assert got == sorted(((i, t, "y", *brute_middle(i, t, percent=80), t or "") for i, t, _, _ in rows), key=str)
    assert {r[4] for r in got} == {"plain", "spm", "psm"}
    assert fill_in_middle(df.where("false")).count() == 0


@pytest.mark.parametrize("longest, memo", [(1 << 16, 1 << 25), (3, 40)])
def test_every_cut_of_a_text(monkeypatch, longest, memo):
    monkeypatch.setattr(fill_middle, "LONGEST", longest)
    monkeypatch.setattr(fill_middle, "MEMO_BYTES", memo)
    monkeypatch.setattr(fill_middle, "CHUNK_BITS", 3)
    summaries = Summaries()
    for text in odd_texts()[:60] + ["", " ", "a", " a", "a ", "a b  ", "a b " * 40]:
        data = np.frombuffer(f"{text}".encode(), np.uint8)
        tokens = TOKEN.findall(text)
        chunked = Chunked(data, bounds(cuts(data), 0, len(data)), summaries)
        assert chunked.n == len(tokens)
        for k in range(len(tokens) + 1):
            head = "".join(tokens[:k])
            assert chunked.cut(k) == (len(head.encode()), len(head))


def test_shared_passages_share_chunks():
    rnd = random.Random(1)
    passage = " ".join(str(rnd.random()) for _ in range(3000)).encode()
    memo = Summaries()
    sizes = []
    for text in (passage, b"other words before " + passage, b"a" * 333 + passage + b" and after"):
        data = np.frombuffer(text, np.uint8)
        Chunked(data, bounds(cuts(data), 0, len(data)), memo)
        sizes.append(len(memo))
    assert sizes[0] > 20 and sizes[-1] - sizes[0] < 8
    steps = np.frombuffer(passage * 60, np.uint8)  # over several steps of the hash
    found = cuts(steps)
    assert np.array_equal(found[: len(cuts(steps[:100_000])) - 1], cuts(steps[:100_000])[:-1])


def test_registered_queries_read_whole_tables(spark):
    folder = "/root/testdata/sf0.001"
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet").count()
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert queries.QUERIES["op12_cross_polytope"](spark, folder).count() == vectors
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = sorted(queries.QUERIES["op13_fill_middle"](spark, folder).collect())
    assert [tuple(r) for r in got] == sorted((i, n, form, p, m, sha(out), sha(t or "")) for i, t in documents for n, form, p, m, out in [brute_middle(i, t)])
