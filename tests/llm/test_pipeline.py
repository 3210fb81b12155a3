"""The pipeline's stages on a small corpus, each held against what its input asks for."""

import collections
import hashlib
import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_corpus_operators import brute_components, brute_targets

from tidelog.llm import mixing, personal_data

corpus_pipeline = pytest.importorskip("corpus_pipeline")

WORDS = [f"{a}{b}" for a in ("ba", "de", "fi", "go", "hu", "ja") for b in ("lo", "mi", "nu", "pa", "re", "so", "ta")]


@pytest.fixture(scope="module")
def docs(spark):
    own = lambda k: " ".join(WORDS[(k * 7 + i * (k % 5 + 1)) % len(WORDS)] + str(k) for i in range(40))
    rows = [(k, own(k), "en", "ab"[k % 2], 1) for k in range(30)]
    rows += [(100 + k, own(k), "en", "a", 1) for k in range(5)] + [(200, "12 34 !!", "en", "a", 8), (201, None, None, None, None), (202, "", "en", "b", 0), (203, own(50) + " mail joe@x.org", "en", "b", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_stages(spark, docs):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "near_duplicates", "personal_data", "mix", "encode"]
    spoken = stages["language"](spark, docs, "")
    assert {r.doc_id for r in docs.collect()} - {r.doc_id for r in spoken.collect()} == {200, 201, 202} and spoken.columns == docs.columns
    unique = stages["near_duplicates"](spark, spoken, "")
    assert sorted(r.doc_id for r in unique.collect()) == [*range(30), 203] and unique.columns == docs.columns
    clean = stages["personal_data"](spark, unique, "")
    text = {r.doc_id: (r.text, r.n_chars) for r in clean.collect()}
    assert text[203][0].endswith("mail <EMAIL>") and text[203][1] == len(text[203][0]) and text[3] == next((r.text, r.n_chars) for r in docs.collect() if r.doc_id == 3)
    assert not any(personal_data.find(t) for t, _ in text.values())
    mixed = stages["mix"](spark, clean, "").collect()
    words = {s: sum(len(r.text.split()) for r in mixed if r.source == s) for s in "ab"}
    total = sum(len(t.split()) for t, _ in text.values())
    assert abs(words["a"] - total * 5 / 7) < 90 and abs(words["b"] - total * 2 / 7) < 90
    assert stages["encode"](spark, clean, "").count() == 31


def test_empty(spark, docs):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), "").count() == 0


def test_run(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256"]


def brute_run(spark, docs):
    """The five stages over a list of (doc_id, text, source), a row at a time; only e-mail addresses are personal data here."""
    from sentencepiece import SentencePieceProcessor

    docs = [d for d in docs if d[1] and any(c.isalpha() for c in d[1])]
    groups = collections.defaultdict(list)
    for k, _, c in brute_components([(k, t) for k, (_, t, _) in enumerate(docs)], 5, 80):
        groups[c].append(docs[k])
    first = lambda d: (d[0] is None, d[0] or 0, d[1])
    docs = [min(g, key=first) for g in groups.values()]
    docs = [(d, re.sub(r"[a-z]+@[a-z.]+[a-z]", "<EMAIL>", t), s) for d, t, s in docs]
    hashed = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumn("h", F.xxhash64(F.lit(mixing.SEED), "doc_id", "text").bitwiseAND((1 << 63) - 1)).collect()
    sizes = collections.Counter()
    for r in hashed:
        sizes[r.source] += len(r.text.split())
    target, items = brute_targets(sizes), []
    for rank, s in enumerate(sorted(x for x in sizes if x is not None) + [None] * (None in sizes)):
        upto = 0
        for r in sorted((r for r in hashed if r.source == s), key=lambda r: (r.h, r.doc_id is not None, r.doc_id or 0)):
            upto += len(r.text.split())
            items += [((k * sizes[s] + upto) / target[s], rank, k, r.h, len(r.text.split()), r) for k in range(3) if target[s] > 0]
    lib, out, used = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model")), [], 0
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for *_, size, r in sorted(items, key=lambda x: x[:4]):
        used += size
        if used > sum(sizes.values()):
            break
        ids = lib.encode(r.text)
        out.append((r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(lib.decode(ids))))
    return sorted(out, key=str)


def test_run_equals_brute_force(spark, docs, tmp_path):
    own = lambda k: " ".join(WORDS[(k * 5 + i * 3) % len(WORDS)] + str(k * i % 17 + 90 * k) for i in range(20 + k))
    more = [(None, own(70), "en", "b", 1), (None, own(70), "en", "b", 1), (71, own(71), "en", None, 1), (72, own(72), None, None, 1), (72, own(72), None, None, 1), (73, own(73), "en", "z", 1), (None, None, None, "z", None), (74, "... 7", "en", "a", 5), (75, own(75) + " joe@x.org and ann@y.com", "en", "z", 1), (76, own(76)[:-1], "en", "z", 1), (77, own(76), "en", "a", 1), (None, own(78), None, "a", None)]
    whole = docs.union(spark.createDataFrame(more, docs.schema)).union(docs.where("doc_id < 4"))
    whole.write.parquet(str(tmp_path / "documents.parquet"))
    want = brute_run(spark, [tuple(r) for r in whole.select("doc_id", "text", "source").collect()])
    got = sorted((tuple(r)[:4] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()), key=str)
    times = collections.Counter(d for d, *_ in want)
    assert max(times.values()) > 1 and None in times and len(times) > 20
    assert collections.Counter(d for d, *_ in got) == times and got == want


def test_stages_on_odd_rows(spark):
    """Nulls, empty and very long texts, repeated rows and null ids, and extra columns with names that the stages use."""
    extra = ["row", "v", "u", "among", "h", "size", "passes", "finish", "part", "label", "spans", "known"]
    texts = ["one two three four five six seven", None, "", "mail joe@x.org now and then and again", "long words here " * 20_000 + "end", "7 7 7", "one two three four five six seven"]
    rows = [(d, t, lang, s, None if t is None else len(t), *[f"{c}{k}" for c in extra]) for k, (d, t, lang, s) in enumerate((d, t, lang, s) for d, lang in ((1, "en"), (None, None)) for t in texts for s in ("a", None))]
    docs = spark.createDataFrame(rows + rows[:3], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in extra))
    whole = {tuple(r) for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        got = out.collect()
        assert out.schema == docs.schema and got, name
        if name == "personal_data":
            assert len(got) == docs.count() and {tuple(r)[5:] for r in got} == {r[5:] for r in whole}
            assert all(r.text is None or "joe@" not in r.text for r in got)
        else:
            assert {tuple(r) for r in got} <= whole
        if name == "language":
            assert len(got) == sum(1 for r in docs.collect() if r.text and any(c.isalpha() for c in r.text))
        if name == "near_duplicates":
            kept = [r for r in got if r.text and r.text.split()]
            assert len(kept) == 4 and all(r.doc_id == 1 for r in kept) and len(got) == 4 + sum(1 for r in docs.collect() if not r.text)
    assert corpus_pipeline.encode(spark, docs, "").count() == docs.count()
