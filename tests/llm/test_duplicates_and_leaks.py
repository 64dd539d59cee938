"""Operators 1, 4, 6, 8, 9, 10 and the pipeline against brute force on small fixtures."""

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash

import corpus_pipeline
from conftest import SF_SMALL
from marketlake.llm import queries
from marketlake.llm.components import components
from marketlake.llm.decontam import SeedTable, benchmark_overlaps, clean_documents, token_codes
from marketlake.llm.fuzzy_lines import FAR_BITS, LONG, MOST_BITS, NEAR_BITS, SAMPLE, fuzzy_links, line_report, piecewise, verified, with_simhash, without_repeated_lines
from marketlake.llm.minhash import Similar, near_duplicates
from marketlake.llm.sharding import assign_shards, write_shards
from marketlake.llm.substring import SuffixAutomaton, remove_repeats
from marketlake.llm.text import SPACED, scan_words
from marketlake.llm.weak_quality import ABSTAIN, NO, YES, classify, fit_label_model, numbers

RND = random.Random(11)
WORDS = [f"wörd{i}x" for i in range(400)]


def prose(n):
    return [RND.choice(WORDS) for _ in range(n)]


def edited(words, changes):
    out = list(words)
    for i in RND.sample(range(len(out)), changes):
        out[i] = f"new{RND.randrange(10**6)}"
    return out


def corpus():
    """Originals, exact and edited copies, chains, repeated passages, odd texts, repeated and null rows."""
    base = [prose(120) for _ in range(6)]
    passage = prose(30)
    texts = [" ".join(b) for b in base] + [" ".join(base[0])] * 3
    texts += [" ".join(edited(base[i % 3], RND.randint(1, 5))) for i in range(25)]
    texts += [" ".join(prose(40) + passage + prose(40)) for _ in range(8)]
    texts += [None, "", " \n\t", "one", "one", "two words", "x y x y " * 30, "a b c d e " * 12, "ONE two THREE " * 9, "one TWO three " * 9]
    texts += ["z" * 30000, " ".join(prose(3000))]
    rows = [(i, t, "extra", 1) for i, t in enumerate(texts)]
    return rows + [rows[2]], passage


ROWS, PASSAGE = corpus()
SCHEMA = "doc_id long, text string, n_words string, component_id int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([*ROWS, (None, ROWS[0][1], "null id", 1)], SCHEMA).repartition(5)


def smallest(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def test_components_by_brute_force(spark):
    links = [(RND.randrange(80), RND.randrange(80)) for _ in range(60)] + [(200 + i, 201 + i) for i in range(20)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a int, b int"), "a", "b").collect()}
    want = smallest({x for e in links for x in e}, links)
    assert got == {n: c for n, c in want.items() if any(n in e and e[0] != e[1] for e in links)}


@pytest.mark.parametrize("like", [Similar(), Similar(words=5, percent=80, bands=56, rows=8)])
def test_near_duplicates_by_brute_force(docs, like):
    k = like.words
    sets = {}
    for i, t, *_ in ROWS:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= like.percent * len(sets[a] | sets[b])]
    want = smallest(sets, links)
    rows = near_duplicates(docs, like).collect()
    assert len(rows) == len(ROWS) + 1
    for r in rows:
        if r.doc_id is None:
            assert r.kept and r.component_id is None
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id)
    assert near_duplicates(docs.where("false"), like).count() == 0


def test_large_clusters_are_dealt_in_blocks(spark, monkeypatch):
    from marketlake.llm import minhash

    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 500)
    base = prose(150)
    rows = [(i, " ".join(base if i == 17 else edited(base, 3))) for i in range(30)]
    got = {r.component_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0}


def test_removed_windows_by_brute_force(docs):
    seen, want = set(), {}
    for i, t in sorted({(i, t) for i, t, *_ in ROWS}, key=lambda r: r[0]):
        w = (t or "").encode().split()
        gone = set()
        for a in range(len(w) - 19):
            key = tuple(w[a : a + 20])
            gone |= set(range(a, a + 20)) if key in seen else set()
            seen.add(key)
        want[i] = (len(w), len(gone), b" ".join(x for j, x in enumerate(w) if j not in gone).decode())
    rows = remove_repeats(docs).collect()
    assert len(rows) == len(ROWS) + 1
    for r in rows:
        if r.doc_id is not None:
            assert (r.n_words, r.n_removed, r.kept) == want[r.doc_id]
        else:
            assert r.n_removed == 0 and r.n_words == 120
    assert sum(n for _, n, _ in want.values()) > 300
    assert remove_repeats(docs.where("false")).count() == 0


def test_suffix_automaton_by_brute_force():
    for _ in range(60):
        texts = [[RND.randrange(3) for _ in range(RND.randint(1, 14))] for _ in range(4)]
        automaton, before = SuffixAutomaton(), []
        for t in texts:
            for end, size in enumerate(automaton.matches(t)):
                longest = max(n for n in range(end + 2) if n == 0 or any(t[end + 1 - n : end + 1] == b[i : i + n] for b in before for i in range(len(b))))
                assert size == longest
            automaton.add(t)
            before.append(t)


def test_words_are_scanned_as_split():
    texts = [None, "", " ", "a", "\x00 \x01", "a\x00", "x" * 3_000_000 + " y " + "z" * 1_500_000 + "\tq", *("".join(RND.choice("abé \n\t中\x1c\xa0") for _ in range(20)) for _ in range(200))]
    codes, begin = scan_words(pa.array(texts), SPACED)
    known = {}
    for i, t in enumerate(texts):
        ws = (t or "").encode().split()
        assert begin[i + 1] - begin[i] == len(ws)
        for w, c in zip(ws, codes[begin[i] : begin[i + 1]].tolist()):
            assert known.setdefault(w, c) == c
    assert len(set(known.values())) == len(known)


def test_decontamination_finds_substituted_passages(spark, docs):
    item = prose(30)
    other = " ".join(prose(25))
    spoiled = list(item)
    for i in (4, 11, 18, 25):
        spoiled[i] = "changed"
    rows = [(1000, " ".join(prose(50) + item + prose(50))), (1001, ", ".join(prose(20) + [w.upper() for w in spoiled] + prose(9))), (1002, " ".join(prose(50) + item[:9] + prose(50))), (None, " ".join(item)), (1004, None)]
    bench = spark.createDataFrame([(7, " ".join(item)), (8, other), (9, None), (10, "too short")], "item_id long, text string")
    texts = spark.createDataFrame(rows, "doc_id long, text string").unionByName(docs.select("doc_id", "text"))
    found = {(r.doc_id, r.item_id): r for r in benchmark_overlaps(texts, bench).collect()}
    assert set(found) == {(1000, 7), (1001, 7), (None, 7)}
    assert (found[1000, 7].start_token, found[1000, 7].n_tokens, found[1000, 7].n_equal) == (50, 30, 30)
    assert found[1001, 7].n_equal >= 18 and 5 * found[1001, 7].n_equal >= 4 * found[1001, 7].n_tokens
    small = {(r.doc_id, r.item_id) for r in benchmark_overlaps(texts, bench, block_words=5).collect()}
    assert small == set(found)  # blocks change nothing
    assert clean_documents(texts, bench).count() == texts.count() - 3
    assert benchmark_overlaps(texts, bench.where("false")).count() == 0


def test_decontamination_by_brute_force():
    rnd = random.Random(5)
    items = [" ".join(f"i{k}t{rnd.randrange(10**6)}" for _ in range(n)) for k, n in enumerate((2, 5, 7, 8, 9, 10, 10, 11, 12, 13, 14, 15, 15, 17, 20, 20, 25, 30) * 3)]
    texts = []
    for item in items:
        for changes in range(max(1, len(item.split()) // 4) + 1):
            texts.append(" ".join(prose(9) + edited(item.split(), changes) + prose(7)))
    texts.append(" ".join(items[11].split()[3:]))

    def overlap(text, item):
        for shift in range(-len(item) + 1, len(text)):
            equal = [0 <= i + shift < len(text) and text[i + shift] == w for i, w in enumerate(item)]
            inside = [i for i in range(len(item)) if 0 <= i + shift < len(text)]
            if len(item) == len(inside) and len(item) - sum(equal) <= (len(item) // 5 if len(item) >= 7 else 0):
                return True
            if any(sum(equal[a:b]) >= 12 and 5 * sum(equal[a:b]) >= 4 * (b - a) for a in inside for b in range(a + 12, inside[-1] + 2)):
                return True
        return False

    want = {(t, i) for t, text in enumerate(texts) for i, item in enumerate(items) if set(text.split()) & set(item.split()) and overlap(text.split(), item.split())}
    rows = SeedTable(list(range(len(items))), items).overlaps(*token_codes(pa.array(texts)))
    got = {r[:2] for r in rows}
    assert got <= want and len(got) >= 0.98 * len(want)
    assert {(t, i) for t, i in want if len(items[i].split()) < 15} <= got
    assert all(n <= len(items[i].split()) and 5 * same >= 4 * n for _, i, _, n, same, _ in rows)


def test_every_whole_item_in_a_document_is_found(spark):
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").toPandas()
    table = spark.read.parquet(f"{SF_SMALL}/documents.parquet").toPandas()
    norm = lambda t: " " + " ".join(re.findall(r"\w+", t.lower())) + " "
    want = {(d, i) for d, t in zip(table.doc_id, map(norm, table.text)) for i, x in zip(bench.item_id, map(norm, bench.text)) if x in t}
    got = {(r.doc_id, r.item_id) for r in queries.QUERIES["op4_decontamination"](spark, SF_SMALL).collect()}
    assert want <= got and want
    codes, begin = token_codes(pa.array(table.text))
    assert len(SeedTable(list(bench.item_id), list(bench.text)).overlaps(codes, begin)) == len(got)


def test_repeated_lines(spark):
    line = " ".join(prose(40))
    near = line[:-3] + "qqq"
    rows = [(3, f"{line}\nshort one\n{line}", "x"), (1, f"own {' '.join(prose(9))}\n{near}", "x"), (5, f"  {line.upper()}  \nshort one", "x"), (6, None, "x"), (7, "", "x"), (None, line, "x"), (8, "\n\n", "x"), (8, "\n\n", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, norm string")
    got = [(r.doc_id, r.n_lines, r.n_removed, list(r.removed)) for r in line_report(docs).collect()]
    lines = {i: (n, gone, where) for i, n, gone, where in got}
    assert len(got) == len(rows)
    # The three spellings of one line and its near copy: the first is document 1's where the SimHash links it.
    assert lines[5] == (2, 1, [0]) and lines[6] == (0, 0, []) and lines[7] == (1, 0, []) and lines[8] == (3, 0, [])
    assert lines[3] in [(3, 1, [2]), (3, 2, [0, 2])] and lines[None] == (1, 0, [])
    text = {r.doc_id: r.text for r in without_repeated_lines(docs).collect()}
    assert text[5] == "short one" and text[1] == rows[1][1] and text[6] is None and text[None] == line
    assert line_report(docs.where("false")).count() == 0


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_near_lines_by_brute_force(spark):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 9)))
    pairs = []
    for n in (5, 8, 10, 15, 20, 30, 50):
        for _ in range(12):
            line = [word() for _ in range(n)]
            copy = list(line)
            for i in rnd.sample(range(n), rnd.randint(1, max(1, n // 5))):
                copy[i] = rnd.choice([word(), copy[i] + "s", "", f"{word()} {copy[i]}"])
            pairs.append((" ".join(line), " ".join(w for w in copy if w)))
    near = [i for i, (a, b) in enumerate(pairs) if 100 * edit_distance(a, b) <= 20 * max(len(a), len(b)) and (len(b.split()) >= 5 or len(b) >= 20) and a != b]
    rows = [(2 * i + j, line) for i, pair in enumerate(pairs) for j, line in enumerate(pair)]
    gone = {r.doc_id for r in line_report(spark.createDataFrame(rows, "doc_id long, text string")).where("n_removed > 0").collect()}
    assert len(near) > 50 and len([i for i in near if 2 * i + 1 in gone]) >= 0.98 * len(near)
    assert gone <= {2 * i + 1 for i, (a, b) in enumerate(pairs) if a == b or i in near}


def test_verified_pairs_by_brute_force(spark):
    """Whatever the SimHashes say, and on short and long lines, a pair's verdict is that of its edit distance."""
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdefgh\u00e9") for _ in range(rnd.randint(2, 7)))
    texts, pairs = [], []
    for n in [6] * 12 + [25] * 12 + [LONG + 30] * 6:
        for share in (0.02, 0.15, 0.25, 0.4, 1):
            line = [word() for _ in range(n)]
            changed = rnd.sample(range(n), max(1, int(n * share)))
            copy = [(rnd.choice([word(), w + "s", "", f"{word()} {w}"]) if i in changed else w) for i, w in enumerate(line)]
            pairs += [(len(texts), len(texts) + 1, bits) for bits in (0, NEAR_BITS + 1, FAR_BITS)]
            texts += [" ".join(line), " ".join(w for w in copy if w)]
    near = {a for a, b, bits in pairs if bits == 0 and 100 * edit_distance(texts[a], texts[b]) <= 20 * max(len(texts[a]), len(texts[b]))}
    assert 30 < len(near) < len(texts) // 2 - 30
    table = spark.createDataFrame(list(enumerate(texts)), "h long, norm string")
    for bits in (0, NEAR_BITS + 1, FAR_BITS):
        asked = spark.createDataFrame([p for p in pairs if p[2] == bits], "a long, b long, bits int")
        assert {r.a for r in verified(asked, table, 80).collect()} == near


def test_distance_by_pieces_is_a_near_bound(spark):
    """Never below the edit distance unless it says that the limit is passed; within the limit for copies that lost and won words."""
    rnd = random.Random(12)
    word = lambda: "".join(rnd.choice("abcdefgh\u00e9") for _ in range(rnd.randint(2, 7)))
    texts = [("", "", True), ("", "a", False), ("ab", "ab", True), ("ab" * 200, "ab" * 190, True)]
    for n in [10] * 8 + [60] * 16 + [200] * 4:
        for share in (0, 0.05, 0.5, 1):
            line = [word() for _ in range(n)] if n < 200 else [w for _ in range(4) for w in [word()] * (n // 4)]
            changed = rnd.sample(range(n), int(n * share))
            copy = [(rnd.choice(["", f"{word()} {w}"]) if i in changed else w) for i, w in enumerate(line)]
            texts.append((" ".join(line), " ".join(w for w in copy if w), share <= 0.05))
    rows = spark.createDataFrame([(i, x, y, max(len(x), len(y)) // 5) for i, (x, y, _) in enumerate(texts)], "i long, x string, y string, most int")
    bound = {r.i: r.d for r in rows.selectExpr("i", f"{piecewise()} as d").collect()}
    for i, (x, y, near) in enumerate(texts):
        most = max(len(x), len(y)) // 5
        assert bound[i] > most if not near else edit_distance(x, y) <= bound[i] <= most
        assert bound[i] >= min(edit_distance(x, y), most + 1)


def test_lines_of_other_lengths_need_no_text(spark):
    """Of a bucket of two lines whose lengths rule the pair out, neither text is read and hashed."""
    rows = [(1, 30, [7, 8], None, False, 1), (2, 90, [7, 8], None, False, 1), (3, 50, [5, 6], None, False, 1), (4, 45, [5, 6], None, False, 1)]
    classes = spark.createDataFrame(rows, "h long, chars int, words array<long>, grams array<long>, alone boolean, n long")
    asked = []

    def texts_of(hashes):
        asked.extend(r.h for r in hashes.collect())
        return spark.createDataFrame([(i, "the same words of one line") for i in (1, 2, 3, 4)], "h long, norm string")

    assert [(r.a, r.b) for r in fuzzy_links(classes, texts_of, 80).collect()] == [(3, 4)]
    assert sorted(asked) == [3, 4]


def chained(*values, seed=42):
    """Spark's xxhash64 of strings, longs and ints, unsigned."""
    for v in values:
        data = v.encode() if isinstance(v, str) else v.to_bytes(4 if 0 <= v < 2 else 8, "little")
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed


def brute_simhash(text):
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    sample = sorted({chained(*text[i : i + 3] or [""]) for i in range(len(text) or 1)}, key=signed)[:SAMPLE]
    votes = [[chained(x, seed) for x in sample] for seed in (0, 1)]
    return tuple(signed(sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in own) > len(own))) for own in votes)


def test_simhash_of_lines(spark):
    rnd = random.Random(9)
    words = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(3, 9))) for _ in range(3000)]
    texts = ["", "a", "ab", "\u4e00\u4e8c\U0001f600x", "aaaa" * 50, " ".join(words[:400])]
    for n in (8, 15, 30, 100):
        for _ in range(40):
            line = [rnd.choice(words) for _ in range(n)]
            near = [w if i % 2 else w[:1] + "z" + w[2:] for i, w in enumerate(line)]  # a wrong letter in every second word
            texts += [" ".join(line), " ".join(near), " ".join(rnd.choice(words) for _ in range(n))]
    rows = with_simhash(spark.createDataFrame(list(enumerate(texts)), "h long, norm string")).collect()
    sims = {r.h: (r.sim.s0, r.sim.s1) for r in rows}
    assert [t for i, t in enumerate(texts) if sims[i] != brute_simhash(t)] == []
    bits = lambda i, j: sum(((x ^ y) & (1 << 64) - 1).bit_count() for x, y in zip(sims[i], sims[j]))
    first = range(6, len(texts), 3)
    assert sum(bits(i, i + 1) <= MOST_BITS for i in first) >= 0.99 * len(first)
    assert sum(bits(i, i + 2) <= MOST_BITS for i in first) <= 0.2 * len(first)


def test_lines_of_short_words_or_without_spaces(spark):
    rnd = random.Random(6)
    han = "".join(chr(rnd.randrange(0x4E00, 0x9F00)) for _ in range(60))
    lines = [("the cat sat on the mat by the old door", "the cat sat on the mat by the odd door"), ("all rights reserved.", "all rights reserved."),
             ("one\ttwo\tsix\tten\tand\tout", "one\ttwo\tsix\tten\tand\toff"), (han, han[:20] + "x" + han[21:]), ("two words", "two words")]
    rows = [(2 * i + j, line) for i, pair in enumerate(lines) for j, line in enumerate(pair)]
    gone = {r.doc_id for r in line_report(spark.createDataFrame(rows, "doc_id long, text string")).where("n_removed > 0").collect()}
    assert gone == {1, 3, 5, 7}


def test_shards_are_a_permutation(spark, scratch):
    rows = [(i if i % 7 else None, "same" if i % 3 else f"t{i}", 5) for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard int").repartition(6)
    placed = assign_shards(df, 24, seed=3, bucket_bytes=4000, text="text").collect()
    assert Counter((r.doc_id, r.text) for r in placed) == Counter((a, b) for a, b, _ in rows)
    slots = defaultdict(list)
    for r in placed:
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    order = [r.doc_id for r in sorted(placed, key=lambda r: (r.slot, r.shard)) if r.doc_id is not None]
    assert abs(np.corrcoef(order, range(len(order)))[0, 1]) < 0.2
    assert assign_shards(df.where("false"), 24, seed=3).count() == 0
    path = scratch("shards")
    write_shards(df, path, 4, seed=3, text="text")
    assert spark.read.parquet(path).groupBy("shard").count().count() == 4


def test_sharding_query_moves_the_texts(spark, monkeypatch):
    from marketlake.llm import sharding

    moved = []
    assign = sharding.assign_shards
    monkeypatch.setattr(sharding, "assign_shards", lambda df, *a: moved.append((df.columns, a[3])) or assign(df, *a))
    got = queries.QUERIES["op10_sharding"](spark, SF_SMALL).collect()
    assert moved == [(["doc_id", "text"], "text")]
    table = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in table)


def test_label_model_recovers_accuracies():
    rng = np.random.default_rng(1)
    truth = rng.random(20000) < 0.7
    real = np.array([0.95, 0.8, 0.7, 0.6])
    votes = np.where(rng.random((20000, 4)) < 0.3, ABSTAIN, np.where((rng.random((20000, 4)) < real) == truth[:, None], YES, NO))
    for by_class in (True, False):
        model = fit_label_model(dict(Counter(numbers(votes).tolist())), 4, by_class)
        assert np.abs(model.accuracies() - real).max() < 0.06
        assert ((model.posterior(votes) > 0.5) == truth).mean() > 0.85


def test_classifier_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scored = classify(docs, labels.where("doc_id < 500")).join(labels.where("doc_id >= 500"), "doc_id").toPandas()
    right = (scored.quality_score >= 0.5) == (scored.quality == 1)
    assert len(scored) > 100 and right.mean() > 0.93
    assert (scored[scored.toxic == 0].toxic_score < 0.5).mean() > 0.98
    odd = spark.createDataFrame([(1, None, "k"), (2, "", "k"), (None, "some words", "k")], "doc_id long, text string, kept string")
    assert [r.kept for r in classify(odd).orderBy("doc_id").collect()][1:] == [False, False]
    assert classify(odd.where("false")).count() == 0


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    before = docs.columns
    count = docs.count()
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, SF_SMALL).cache()
        assert docs.columns == before and 0 < docs.count() <= count, name
        count = docs.count()
        if name == "near_dedup":
            sets = {r.doc_id: {tuple(w[j : j + 5]) for j in range(len(w) - 4)} for r in docs.collect() if len(w := r.text.encode().lower().split()) >= 5}
            assert not [1 for a, b in itertools.combinations(sets.values(), 2) if 100 * len(a & b) >= 80 * len(a | b)]
    assert corpus_pipeline.encode(spark, docs, SF_SMALL).count() == count


@pytest.mark.parametrize("words, typos", [(15, 10), (30, 12)])
def test_lines_with_typing_errors_in_most_words(spark, words, typos):
    """One wrong letter in most words: some 90 % edit similarity, few words left whole."""
    rnd = random.Random(words)
    word = lambda: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(3, 10)))
    vocabulary = [word() for _ in range(3000)]
    rows = []
    for k in range(150):
        line = [rnd.choice(vocabulary) for _ in range(words)]
        copy = list(line)
        for i in rnd.sample(range(words), typos):
            at = rnd.randrange(len(copy[i]))
            copy[i] = copy[i][:at] + rnd.choice("0123456789") + copy[i][at + 1:]
        rows += [(2 * k, " ".join(line)), (2 * k + 1, " ".join(copy))]
    near = [k for k in range(150) if 100 * edit_distance(rows[2 * k][1], rows[2 * k + 1][1]) <= 20 * max(len(rows[2 * k][1]), len(rows[2 * k + 1][1]))]
    gone = {r.doc_id for r in line_report(spark.createDataFrame(rows, "doc_id long, text string")).where("n_removed > 0").collect()}
    assert len(near) > 140 and len([k for k in near if 2 * k + 1 in gone]) >= 0.95 * len(near)
