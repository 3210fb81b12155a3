"""Operators over many documents against brute force, on edges: nulls, ties, repeated rows, hot groups, empty tables."""

import collections
import math
import os
import random
import re
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidelog.llm import jaccard, language, mixing, neighbours, toxicity
from tidelog.llm._graph import components
from tidelog.sources import scratch

SF = "/root/testdata/sf0.01"
tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def brute_components(docs, n, percent):
    sets = []
    for _, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[max(find(i), find(j))] = min(find(i), find(j))
    groups = collections.defaultdict(list)
    for i, (d, _) in enumerate(docs):
        groups[find(i)].append(d)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in groups.items()}
    return sorted(((d, len(sets[i]), least[find(i)] if sets[i] else d) for i, (d, _) in enumerate(docs)), key=str)


def corpus(seed):
    r = random.Random(seed)
    docs = []
    for _ in range(40):
        base = [r.choice("abcdefghijklmnopqrstuvwxyz") * r.randint(1, 3) for _ in range(r.choice([3, 5, 20, 80, 150]))]
        for _ in range(r.choice([1, 1, 2, 5, 25])):
            w = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 4])):
                w[r.randrange(len(w))] = f"q{r.randint(0, 3)}"
            docs.append((len(docs) * 7 % 1009, r.choice([" ", "  ", "\n"]).join(w)))
    return docs + [(None, "x y z w"), (None, "x y z w"), (5000, None), (5001, ""), (5002, "  "), (5003, "x y Z w"), (None, "alone"), (5003, "x y z w")]


@pytest.mark.parametrize(("n", "percent", "short", "block"), [(4, 85, 6, 8), (5, 80, 24, 256), (1, 100, 2, 3)])
def test_jaccard(spark, monkeypatch, n, percent, short, block):
    for name, value in (("SHORT", short), ("BLOCK", block), ("SHARED_FROM", 4), ("COUNTED", 500)):
        monkeypatch.setattr(jaccard, name, value)
    docs = corpus(n)
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, size int").repartition(3)
    assert rows(jaccard.join(df, n, percent)) == brute_components(docs, n, percent)


@pytest.mark.parametrize("long", [5, 4096])
def test_jaccard_columns_of_many_entries(spark, monkeypatch, long):
    for name, value in (("SHORT", 2), ("LONG", long), ("BLOCK", 8), ("SHARED_FROM", 1 << 40)):
        monkeypatch.setattr(jaccard, name, value)
    docs = corpus(9)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert rows(jaccard.join(df, 4, 70)) == brute_components(docs, 4, 70)


def test_jaccard_texts_that_share_a_common_phrase_stay_apart(spark, monkeypatch):
    """They aren't brought together as candidates; texts that do link are."""
    found = []
    monkeypatch.setattr(jaccard, "components", lambda edges: found.append(components(edges)) or found[-1])
    monkeypatch.setattr(jaccard, "SHARED_FROM", 1 << 40)  # nothing is known as shared
    phrase = "all of these share a phrase of twenty words that is a third of each but by far too little"
    docs = [(k, f"{phrase} " + " ".join(f"w{k}x{j}" for j in range(40))) for k in range(200)]
    docs += [(1000 + k, docs[k][1] + " end") for k in range(3)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in jaccard.join(df, 4, 80).collect()}
    assert got == {k: k % 1000 for k, _ in docs}
    assert found[0].count() == 6


def test_jaccard_parity_bits_miss_no_link():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in (1, 2, 30, 127, 128, 129, 500, 2000)]
    sets += [np.unique(np.concatenate([rng.choice(s, max(1, int(len(s) * share)), replace=False), rng.integers(0, 1 << 63, int(len(s) * more)).astype(np.uint64)])) for s in sets for share in (0.5, 0.9, 1) for more in (0, 0.1, 0.3)]
    sets = sorted(sets, key=len)
    for percent in (1, 50, 80, 85, 100):
        size = np.array([len(s) for s in sets])
        root = list(range(len(sets)))
        for a, b in jaccard.may_link(size, [jaccard.parity(s) for s in sets], percent):
            root = [root[a] if x == root[b] else x for x in root]
        both = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
        links = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * both[i][j] >= percent * (size[i] + size[j] - both[i][j])]
        assert all(root[i] == root[j] for i, j in links)
        assert percent < 80 or len(set(root)) > 12  # and it keeps unlike sets apart


def test_jaccard_keeps_one_of_each(spark):
    docs = [(3, "a b c d e f", "x"), (1, "A b c d e f", "y"), (1, "A b c d e f", "y"), (None, "a b c d e f", None), (4, "g h i j k", "z"), (5, "", "e"), (6, None, None), (7, "", "e")]
    df = spark.createDataFrame(docs, "doc_id long, text string, v string")
    assert rows(jaccard.one_of_each(df, 5, 80)) == sorted([(1, "A b c d e f", "y"), (4, "g h i j k", "z"), (5, "", "e"), (6, None, None), (7, "", "e")], key=str)
    assert jaccard.one_of_each(df.limit(0), 5, 80).count() == jaccard.join(df.limit(0)).count() == 0


def test_jaccard_leaves_no_finished_tables(spark):
    """Of the tables between steps, those that the result doesn't read are deleted, but for small ones of components."""
    before = {p.parent for p in Path(scratch.root(spark).removeprefix("file:")).rglob("*.parquet")}
    df = spark.createDataFrame([(k, f"a b c d e f {k % 9}", "x") for k in range(40)], "doc_id long, text string, v string")
    assert jaccard.one_of_each(df, 5, 80).count() == 9
    left = [spark.read.parquet(str(p)).columns for p in {p.parent for p in Path(scratch.root(spark).removeprefix("file:")).rglob("*.parquet")} - before]
    assert not [c for c in left if {"grams", "gram", "overlap"} & set(c)] and sum("size" in c for c in left) <= 1


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 140)} | {200: 200, 201: 200}


def brute_targets(sizes):
    order = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, live, out = sum(sizes.values()), list(order), {}
    while live:
        w = sum(weight[s] for s in live)
        over = [s for s in live if left * weight[s] / w > 3 * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / w for s in live}
        out |= {s: 3 * sizes[s] for s in over}
        left, live = left - sum(3 * sizes[s] for s in over), [s for s in live if s not in over]
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_mixing(spark, monkeypatch, seed):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 9)
    r = random.Random(seed)
    docs = [(r.choice([k, k, None]), "w\t" * r.choice([0, 1, 1, 2, 5, 9]), r.choices(["a", "b", "é", None, "z"], [20, 2, 3, 3, r.choice([0, 1])])[0], "own") for k in range(200)]
    docs += docs[:20] + [(500, None, "a", None), (501, "", "empty", None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, target string")
    got = mixing.passes(df).collect()
    sizes, taken = collections.Counter(), collections.Counter()
    for x in got:
        sizes[x.row.source] += x.size
        taken[x.row.source] += x.size * x.passes
    want = brute_targets(sizes)
    assert len(got) == len(docs) and all(abs(x.target - want[x.row.source]) < 1e-6 and x.source_size == sizes[x.row.source] and 0 <= x.passes <= 3 for x in got)
    total = sum(sizes.values())
    assert total - 9 <= sum(taken.values()) <= total and all(abs(taken[s] - want[s]) <= 20 for s in sizes)
    assert rows(mixing.plan(df)) == rows(mixing.plan(df.repartition(5)))  # reruns agree
    assert rows(mixing.mixed(df)) == sorted((tuple(x.row) for x in got for _ in range(x.passes)), key=str)


def brute_passes(docs, most=3):
    """Rows (h, doc_id, source, size) with how often the mix takes them: all finish times put in order, cut at the budget."""
    sizes = collections.Counter()
    for _, _, source, size in docs:
        sizes[source] += size
    target, items, least = brute_targets(sizes), [], lambda d: (d is not None, d or 0)
    for rank, s in enumerate(sorted(x for x in sizes if x is not None) + [None] * (None in sizes)):
        upto = 0
        for h, d, size, i in sorted(((h, d, size, i) for i, (h, d, own, size) in enumerate(docs) if own == s), key=lambda r: (r[0], least(r[1]), r[2])):
            upto += size
            items += [(((k * sizes[s] + upto) / target[s], rank, k, h, least(d)), size, i) for k in range(most) if target[s] > 0 and size]
    taken, used = collections.Counter(), 0
    for key in sorted({x[0] for x in items}):
        own = [x for x in items if x[0] == key]
        used += sum(x[1] for x in own)
        if used > sum(sizes.values()):
            break
        taken.update(i for *_, i in own)
    return sorted(((*d[:3], d[3], taken[i]) for i, d in enumerate(docs)), key=str)


@pytest.mark.parametrize("seed", [4, 5, 6])
def test_mixing_equals_sort_and_truncate(spark, monkeypatch, seed):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 7)
    monkeypatch.setattr(mixing, "COARSE", 8)
    r = random.Random(seed)
    docs = [(r.choice([k, k, None]), "w " * r.choice([0, 1, 2, 5, 9]), r.choices(["a", "b", None, "z"], [20, 2, 3, 1])[0]) for k in range(120)] + [(900, "long " * 300, "b")]
    df = spark.createDataFrame(docs + docs[:15], "doc_id long, text string, source string")
    hashed = df.withColumn("h", F.xxhash64(F.lit(mixing.SEED), "doc_id", "text").bitwiseAND((1 << 63) - 1)).collect()
    want = brute_passes([(x.h, x.doc_id, x.source, len(x.text.split())) for x in hashed])
    got = mixing.passes(df).select(F.xxhash64(F.lit(mixing.SEED), "row.doc_id", "row.text").bitwiseAND((1 << 63) - 1).alias("h"), "row.doc_id", "row.source", "size", "passes").collect()
    assert sorted(map(tuple, got), key=str) == want


@tables
def test_mixing_equals_sort_and_truncate_on_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    hashed = df.withColumn("h", F.xxhash64(F.lit(mixing.SEED), "doc_id", "text").bitwiseAND((1 << 63) - 1)).collect()
    want = {d: n for _, d, _, _, n in brute_passes([(x.h, x.doc_id, x.source, len(re.findall(r"[^\x20\x09-\x0D]+", x.text or ""))) for x in hashed])}
    assert {x.doc_id: x.passes for x in mixing.plan(df).collect()} == want


def test_very_long_texts(spark):
    """Whole texts count, at their end too."""
    long = [(1, "the cat sat " * 60_000 + "end", "en", "a"), (2, "le chat noir " * 40_000, "fr", "b"), (3, "the cat", "en", "a"), (4, "le chat", "fr", "b"), (5, "x" * 400_000, None, "a"), (6, "plain words here " * 30_000 + "scumline", "en", "a")]
    docs = spark.createDataFrame(long, "doc_id long, text string, lang string, source string")
    assert {x.doc_id: x.size for x in mixing.plan(docs).collect()} == {d: len(t.split()) for d, t, *_ in long}
    got = {x.doc_id: x.lang_pred for x in language.predict(docs).collect()}
    assert (got[1], got[2], got[3]) == ("en", "fr", "en") and len(got) == 6
    model = toxicity.fit([(f"plain words number {k}", 0, "en") for k in range(60)] + [(f"plain scumline words {k}", 1, "en") for k in range(60)])
    assert {x.doc_id: x.predicted for x in toxicity.score(docs, model).collect()} == {1: 0, 2: 0, 3: 0, 4: 0, 5: 0, 6: 1}


def test_mixing_of_nothing(spark):
    kind = "doc_id long, text string, source string"
    assert mixing.plan(spark.createDataFrame([], kind)).count() == mixing.mixed(spark.createDataFrame([], kind)).count() == 0
    assert [(r.size, r.target, r.taken) for r in mixing.plan(spark.createDataFrame([(1, "", "a"), (2, None, None)], kind)).collect()] == [(0, 0.0, 0)] * 2


def brute_neighbours(vectors, every=50, k=5):
    ids, x = np.array([v for v, _ in vectors]), np.array([e for _, e in vectors], np.float64)
    order = np.argsort(ids)
    ids, x = ids[order], x[order]
    norm, out = np.sqrt((x * x).sum(1)), {}
    for i in np.flatnonzero(ids % every == 0):
        s = (x * x[i]).sum(1) / (norm * norm[i])
        s[i] = -9
        out[int(ids[i])] = [(int(ids[j]), float(s[j])) for j in np.argsort(-s, kind="stable")[:k] if j != i]
    return out


def test_neighbours_edges(spark):
    nan = float("nan")
    vectors = [(0, [1.0, 0.0, 2.0]), (1, [1.0, 0.0, 2.0]), (2, [0.0, 0.0, 0.0]), (3, None), (4, [nan, 1.0, 1.0]), (5, [1.0, None, 2.0]), (50, [3.0, 1.0, 2.0]), (50, [3.0, 1.0, 2.0]), (None, [1.0, 1.0, 1.0]), (7, [1.0]), (8, [-1.0, 0.5, 1.0]), (9, [1e-200, 0.0, 2e-200]), (10, [])]
    vectors += [(100, [1.0, 2.0]), (101, [2.0, 1.0]), (102, [1.0, 2.0]), (150, [5.0])]  # lengths that aren't the commonest are spaces of their own
    df = spark.createDataFrame([(v, e, 1) for v, e in vectors], "vec_id long, embedding array<double>, score int")
    got = collections.defaultdict(list)
    for r in neighbours.search(df).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id))
    # a repeated id is two queries, and either row is a candidate of the other
    assert [v for _, v in got[0]] == [1, 9, 50, 50, 8] and [k for k, _ in got[0]] == [1, 2, 3, 4, 5]
    assert got[50] == [(k, v) for k, v in enumerate([50, 0, 1, 9, 8], 1) for _ in range(2)]
    assert got[100] == [(1, 102), (2, 101)] and got[150] == [(1, 7)] and len(got) == 4
    assert neighbours.search(df.limit(0)).count() == 0 == neighbours.search(df.where("vec_id IN (2, 3)")).count()


def recall(df, vectors):
    """Share of the nearest that are found; scores, ranks and order must hold for all rows."""
    want, got = brute_neighbours(vectors), collections.defaultdict(list)
    x = {v: np.array(e, np.float64) for v, e in vectors}
    for r in neighbours.search(df).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
        a, b = x[r.query_id], x[r.vec_id]
        assert abs(r.score - a @ b / math.sqrt((a @ a) * (b @ b))) < 1e-12
    for q, w in got.items():
        w.sort()
        assert [k for k, *_ in w] == list(range(1, len(want[q]) + 1)) and w == sorted(w, key=lambda r: (-r[2], r[1])) and q not in {v for _, v, _ in w}
    assert len(got) == len(want)
    return sum(len({v for _, v, _ in got[q]} & {v for v, _ in w}) for q, w in want.items()) / sum(map(len, want.values()))


def test_neighbours_recall(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD", 300)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 8)
    monkeypatch.setattr(neighbours, "LEAST_ROWS", 64)
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((40, 32))
    x = centres[rng.integers(0, 40, 6000)] + 0.4 * rng.standard_normal((6000, 32))
    x[:2000] = centres[0] + 1e-3 * rng.standard_normal((2000, 32))  # one crowded place
    vectors = [(k, v.tolist()) for k, v in enumerate(x)]
    assert recall(spark.createDataFrame(vectors, "vec_id long, embedding array<double>"), vectors) >= 0.9


@tables
def test_neighbours_recall_on_the_table(spark, monkeypatch):
    """Cells are left out, as in large tables."""
    monkeypatch.setattr(neighbours, "LEAST_ROWS", 64)
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    assert recall(df, [(r.vec_id, list(r.embedding)) for r in df.collect()]) >= 0.9


def brute_bits(sample, lang, text):
    low = lambda t: bytes(b + 32 if 65 <= b <= 90 else b for b in t.encode())
    n = language.ORDER
    seen = [collections.defaultdict(collections.Counter) for _ in range(n + 1)]
    for own, t in sample:
        if own == lang:
            b = b"\n" * n + low(t)
            for i in range(n, len(b)):
                for k in range(n + 1):
                    seen[k][b[i - k : i]][b[i]] += 1
    b, bits = b"\n" * n + low(text), 0.0
    for i in range(n, len(b)):
        for k in range(n, -1, -1):
            c = seen[k].get(b[i - k : i])
            if c and b[i] in c:
                bits -= math.log2(c[b[i]] / (c.total() + len(c)))
                break
            if c:
                bits -= math.log2(len(c) / (c.total() + len(c)))
        else:
            bits += 8
    return bits


def test_language_code_lengths():
    sample = [("en", "the cat and the dog"), ("en", "A theme"), ("fr", "le chat et la théière"), ("de", "der Hund und die Katze, ß")]
    trees = language.fit(sample)
    for t in ("the hat", "die théière Ünd", "zzz", "中文 the", "a"):
        data, at, _ = language._joined([t, "", "x"])
        assert np.allclose(language.lengths(trees, data, at)[0], [brute_bits(sample, x, t) for x in trees.languages], atol=1e-3)


def test_language_code_lengths_however_many_strings(monkeypatch):
    monkeypatch.setattr(language, "ENTRIES", 40, raising=False)  # a cap on the tables, if there is one
    r = random.Random(5)
    sample = [(lang, "".join(r.choice(letters) for _ in range(60))) for lang, letters in (("en", "abcde "), ("fr", "cdefg "), ("el", "αβγδε ")) for _ in range(5)] + [("rare", "qxz jvk")]
    trees = language.fit(sample)
    assert all(len(t.keys) == len({(("\n" * k + x.lower()).encode()[i : i + k + 1]) for _, x in sample for i in range(len(x.encode()))}) for k, t in enumerate(trees.known))
    for t in [x for _, x in sample[::4]] + ["qxz jvk", "abc xyz αβ", "jvk abc"]:
        data, at, _ = language._joined([t])
        assert np.allclose(language.lengths(trees, data, at)[0], [brute_bits(sample, x, t) for x in trees.languages], atol=1e-3)


def test_language_learns_from_copied_and_long_texts(spark):
    few = [f"tekst nummer {k} {'abcdefgh'[k] * 9}" for k in range(8)]
    long = ["é" * 9000, "xy ñandú " * 4000]
    docs = spark.createDataFrame([("no", t) for t in few for _ in range(320)] + [("fr", t) for t in long] + [("en", "short"), ("en", long[1]), (None, "z"), ("en", None), ("en", "")], "lang string, text string")
    docs = docs.withColumn("doc_id", F.monotonically_increasing_id()).withColumn("at", F.rand(1)).repartition(4, "at")
    got = language.train(docs, F.lit(True))
    cut = lambda t: t.encode()[: language.SAMPLE_BYTES].decode(errors="ignore")
    want = language.fit([("no", t) for t in few] + [("fr", cut(t)) for t in long] + [("en", "short"), ("en", cut(long[1]))])
    assert got.languages == want.languages == ["en", "fr", "no"]
    for g, w in zip(got.known + got.leave, want.known + want.leave, strict=True):
        assert np.array_equal(g.keys, w.keys) and np.array_equal(g.bits, w.bits)


@tables
def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language.predict(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.95


def test_language_edges(spark):
    kind = "doc_id long, text string, lang string, score string"
    docs = spark.createDataFrame([(1, "the cat sat", "en", "x"), (3, "le chat noir", "fr", None), (4, None, "en", None), (5, "", None, None), (None, "123 !", "en", None), (9, "the cat", None, None)], kind)
    got = {r.doc_id: r for r in language.predict(docs).collect()}
    assert (got[4].lang_pred, got[5].lang_pred, got[None].lang_pred, got[9].lang_pred) == ("und", "und", "und", "en") and got[4].score == 0
    assert rows(language.kept(docs).select("doc_id")) == [(1,), (3,), (9,)] and language.kept(docs).columns == docs.columns
    assert language.predict(docs.limit(0)).count() == 0
    blind = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.predict(blind).collect()} == {"und"} and rows(language.kept(blind).select("doc_id")) == [(1,), (3,), (9,)]


def test_toxicity_learns(spark):
    r = random.Random(2)
    plain, bad = [f"w{k}" for k in range(300)], ["scumline", "scumlike", "scumbers", "vilegrit"]
    docs, labels = [], []
    for k in range(900):
        toxic = int(k % 5 == 0)
        words = r.choices(plain, k=r.randint(20, 60))
        if toxic:
            words[r.randrange(len(words))] = r.choice(bad)
        docs.append((k, " ".join(words), "en" if k % 2 else "fr", "x"))
        labels.append((k, 1, toxic))
    docs += [(2000, None, None, None), (2001, "", None, None), (2001, "", None, None), (None, "scumline", None, None)]
    d, lab = spark.createDataFrame(docs, "doc_id long, text string, lang string, score string"), spark.createDataFrame(labels + [(5, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.score(d, toxicity.train(d, lab)).collect()
    held = [(x.predicted, labels[x.doc_id][2]) for x in got if x.held_out and x.doc_id is not None and x.doc_id < 900]
    assert sum(p == y for p, y in held) / len(held) > 0.97
    assert all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.3) for x in got) and len(got) == len(docs)
    assert all(x.predicted == 0 for x in got if x.doc_id in (2000, 2001))
    none = toxicity.train(d, lab.where("toxic = 0"))
    assert {x.score for x in toxicity.score(d, none).collect()} == {0.0} and toxicity.score(d.limit(0), none).count() == 0


def test_toxicity_learns_from_all_labelled_texts(spark):
    """However many there are, in however many partitions, and however long: each word is counted, the three of padding too."""
    docs = [(k, f"plain words number {k} " + ("scumline" if k % 2 else "fine"), "en") for k in range(9000)]
    docs += [(20000 + k, "le mot " * 4000 + "vilegrit", "fr") for k in range(40)]
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(8)
    lab = spark.createDataFrame([(k, int(k >= 20000 or k % 2 == 1)) for k, *_ in docs], "doc_id long, toxic int")
    model = toxicity.train(d, lab, F.lit(True))
    begin = {k: toxicity.word_rows(pa.array([k], pa.large_string()))[0][0, 0] for k in ("plain", "mot")}
    share = np.exp(model.guess)
    assert abs(share[begin["plain"], 0] / (9000.1 / (9000 * 8 + 0.1 * (toxicity.BUCKETS + 1))) - 1) < 0.01
    assert abs(share[begin["mot"], 1] - 160_000 / (40 * 8004 + 0.1 * (toxicity.BUCKETS + 1))) < 1e-3
    got = {x.doc_id: x.predicted for x in toxicity.score(d, model).collect()}
    assert sum(got[k] == int(k >= 20000 or k % 2) for k in got) > 0.99 * len(got)


def small_model(rng):
    """A model of few, large numbers; float64, so that differences can be taken."""
    e = rng.standard_normal((toxicity.BUCKETS + 1, toxicity.DIM))
    e[toxicity.BUCKETS] = 0
    filters = [rng.standard_normal((w, toxicity.DIM, toxicity.FILTERS)) for w in toxicity.WIDTHS]
    return e, filters, [rng.standard_normal(toxicity.FILTERS) for _ in filters], rng.standard_normal(len(filters) * toxicity.FILTERS) * 0.3, 0.2


def brute_probability(e, filters, bias, w, b, rows):
    """One text: every filter at every place, word by word, the largest response of each, a logistic layer."""
    x, pooled = [e[i] + e[j] for i, j in rows], []
    for f, c in zip(filters, bias, strict=True):
        for k in range(toxicity.FILTERS):
            best = max(sum(float(x[p + j] @ f[j, :, k]) for j in range(len(f))) for p in range(len(x) - len(f) + 1))
            pooled.append(max(0.0, best + c[k]))
    return 1 / (1 + math.exp(-(sum(p * q for p, q in zip(pooled, w, strict=True)) + b)))


def test_toxicity_forward_equals_brute_force():
    model = small_model(np.random.default_rng(3))
    some = ["a few words here", "one", "Repeated repeated REPEATED words", "", "!!", "é中 mixed", "a " * 40]
    column = pa.array(some, pa.large_string())
    rows_, begin = toxicity.word_rows(column)
    for k, t in enumerate(some):  # words, whole and by stem, hashed one at a time
        words = re.findall(rb"[0-9a-z\x80-\xff]+", t.lower().encode())
        alone = [toxicity.word_rows(pa.array([w.decode()], pa.large_string()))[0][0].tolist() for w in words]
        assert rows_[begin[k] : begin[k + 1]].tolist() == alone + [[toxicity.BUCKETS] * 2] * max(toxicity.WIDTHS)
    own = toxicity.Scorer(toxicity.Model(*model, np.zeros((toxicity.BUCKETS + 1, 0), np.float32), np.array([0.4])))
    got, plain = own.scores(column), own.plain(rows_, begin)
    for k, t in enumerate(some):
        p = brute_probability(*model, rows_[begin[k] : begin[k + 1]])
        assert abs(p - plain[k]) < 1e-6
        want = 0.0 if not re.search(r"\w", t) else 0.3 * p / 0.4 if p < 0.4 else 0.3 + 0.7 * (p - 0.4) / 0.6
        assert abs(got[k] - want) < 1e-6
        assert abs(own.scores(pa.array([t], pa.large_string()))[0] - got[k]) < 1e-9  # the texts beside it don't matter


def test_toxicity_gradients_equal_differences():
    rng = np.random.default_rng(8)
    e, filters, bias, w, b = small_model(rng)
    rows_, begin = toxicity.word_rows(pa.array(["a few words", "more words and more", "x y", "few"], pa.large_string()))
    y, weight = np.array([1.0, 0.0, 1.0, 0.0]), np.array([1.0, 2.0, 1.0, 0.5])

    def loss():
        p = np.array([brute_probability(e, filters, bias, w, b, rows_[begin[k] : begin[k + 1]]) for k in range(4)])
        return float((weight * -(y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / 4)

    touched, g_e, g_filters, g_bias, g_w, g_b = toxicity.gradients(e, filters, bias, w, b, rows_, begin, y, weight)
    checks = [(w, k, g_w[k]) for k in range(0, len(w), 5)]
    checks += [(f, (j, d, k), g[j, d, k]) for f, g in zip(filters, g_filters, strict=True) for j in range(len(f)) for d, k in ((0, 0), (5, 3), (9, 7))]
    checks += [(c, k, g[k]) for c, g in zip(bias, g_bias, strict=True) for k in (0, 4)]
    checks += [(e, (row, d), g_e[n, d]) for n, row in enumerate(touched) if row != toxicity.BUCKETS for d in (0, 7)]
    assert np.abs([g for *_, g in checks]).max() > 1e-3
    for a, at, g in checks:
        old, step = a[at], 1e-6
        a[at] = old + step
        up = loss()
        a[at] = old - step
        down = loss()
        a[at] = old
        assert abs((up - down) / (2 * step) - g) < 1e-5, at


def test_block_links_equal_sets():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, 40)).astype(np.uint64) for _ in range(30)]
    i, j = jaccard.block_links(sets, None, 50)
    want = {(a, b) for a in range(30) for b in range(a + 1, 30) if 100 * len(np.intersect1d(sets[a], sets[b])) >= 50 * len(np.union1d(sets[a], sets[b]))}
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == want
    i, j = jaccard.block_links(sets[:10], sets[10:], 50)
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == {(a, b) for a, b in want if a < 10 <= b}


def test_slices_of_arrow_columns():
    column = pa.array(["a", None, "bc", ""]).slice(1)
    from tidelog.llm import _text

    data, at = _text.raw(_text.texts(column))
    assert data.tobytes() == b"bc" and at.tolist() == [0, 0, 2, 2]
