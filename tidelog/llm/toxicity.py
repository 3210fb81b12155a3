"""Toxicity: a convolutional text classifier in numpy.

Words (lower-cased runs of letters, digits and all beyond ASCII) are hashed to rows of an embedding table, whole and by
their first STEM bytes, and the two rows are added, so that unseen forms of a known stem are known; filters of several
widths run over the whole text, the largest response of each filter is kept, and a logistic layer scores them.
The embedding's first component starts at each row's log-odds in the training texts and is trained on with all else, by
back-propagation through the positions that won the pooling. Scores are mapped so that each language's own best
threshold, found on texts not trained on, falls on THRESHOLD; the language is guessed from the text's words alone.

Fitted on all labelled texts that aren't held out, whole ones. Counts of words are summed over all of them. Filters and
embedding are trained in EPOCHS rounds: each partition goes once over all its texts from the same model, and the results
are averaged, parameters by the texts seen, an embedding row by the texts that moved it; so the driver holds models only.
A quarter of the texts, by hash, sets the thresholds: their scores are counted in BINS steps. Null and empty texts, and all others without a word, score 0. Rows labelled twice count as toxic if any label says so; labels that
are null teach nothing. Without both labels every score is 0. Repeated rows give repeated results, an empty table an
empty one; columns beyond those named, whatever they are called, are ignored. Of equal responses of a filter the first is
trained, and of equal languages the first in order is taken. Very long texts are scored whole; memory follows the longest.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import drop, written
from ._text import BYTE_VALUES, U64, column_of, lower_ascii, raw, release, slices, span_hashes, spans, table_of, texts
from .language import held_out

BUCKETS, DIM = 1 << 15, 16
WIDTHS, FILTERS = (1, 2, 3), 8
#: Partitions that train at once; steps and range of log-odds in which scores are counted.
SHARDS, BINS, SPAN = 256, 4096, 16
EPOCHS, BATCH = 3, 32
STEM = 5
THRESHOLD = 0.3
#: Positive calibration texts that a language needs for a threshold of its own.
ENOUGH = 8
_WORD = table_of((48, 57), (97, 122), (128, 255))


class Model(NamedTuple):
    embedding: np.ndarray  # BUCKETS + 1 rows; the last is the zero padding
    filters: list[np.ndarray]  # by width: width x DIM x FILTERS
    bias: list[np.ndarray]
    weights: np.ndarray
    offset: float
    guess: np.ndarray  # log share of each word bucket by language
    thresholds: np.ndarray  # by language, the last for none


def word_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Two embedding rows for each of a text's words, each text followed by padding, and where texts begin."""
    data, at = raw(column)
    low = lower_ascii(data)
    starts, ends, doc = spans(_WORD[low], at)
    values = BYTE_VALUES[low]
    whole = span_hashes(values, starts, ends)
    # a stem is hashed apart from whole words, also where it is the whole word
    stem = span_hashes(values, starts, np.minimum(ends, starts + STEM)) ^ U64(0x5851F42D4C957F2D)
    rows = np.stack([whole % U64(BUCKETS), stem % U64(BUCKETS)], 1).astype(np.int64)
    pad = max(WIDTHS)
    begin = np.searchsorted(doc, np.arange(len(column) + 1)) + pad * np.arange(len(column) + 1)
    out = np.full((begin[-1], 2), BUCKETS, np.int64)
    out[np.arange(len(rows)) + pad * doc] = rows
    return out, begin


def _responses(values: list[np.ndarray], begin: np.ndarray, n: int) -> np.ndarray:
    """Sums of shifted rows: the response of each filter at each place. values: one array for each offset of the filter.

    Places from which the filter would reach into the next text have none.
    """
    out = values[0].copy()
    for j, v in enumerate(values[1:], 1):
        out[: n - j] += v[j:]
        out[begin[1:] - j] = -np.inf
    return out


class Scorer:
    """Scores texts with the product of embedding and filters as ready tables."""

    def __init__(self, model: Model):
        self.m = model
        self.tables = [[model.embedding @ f[j] for j in range(len(f))] for f in model.filters]

    def pooled(self, rows: np.ndarray, begin: np.ndarray) -> np.ndarray:
        parts = []
        for tables, bias in zip(self.tables, self.m.bias, strict=True):
            r = _responses([t[rows[:, 0]] + t[rows[:, 1]] for t in tables], begin, len(rows))
            parts.append(np.maximum(np.maximum.reduceat(r, begin[:-1], axis=0) + bias, 0))
        return np.concatenate(parts, 1)

    def language(self, rows: np.ndarray, begin: np.ndarray) -> np.ndarray:
        if not self.m.guess.shape[1]:
            return np.zeros(len(begin) - 1, np.int64)
        return np.add.reduceat(self.m.guess[rows[:, 0]], begin[:-1], axis=0).argmax(1)

    def plain(self, rows: np.ndarray, begin: np.ndarray) -> np.ndarray:
        z = self.pooled(rows, begin) @ self.m.weights + self.m.offset
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def scores(self, column: pa.Array) -> np.ndarray:
        if not len(column):
            return np.zeros(0)
        if not len(self.m.weights):
            return np.zeros(len(column))
        rows, begin = word_rows(column)
        p, t = self.plain(rows, begin).astype(np.float64), self.m.thresholds[self.language(rows, begin)]
        p = np.where(np.diff(begin) > max(WIDTHS), p, 0)  # padding alone
        return np.clip(np.where(p < t, THRESHOLD * p / t, THRESHOLD + (1 - THRESHOLD) * (p - t) / (1 - t)), 0, 1)


def gradients(e: np.ndarray, filters: list[np.ndarray], bias: list[np.ndarray], w: np.ndarray, b: float, rows: np.ndarray, begin: np.ndarray, y: np.ndarray, weight: np.ndarray):
    """Of the mean weighted cross-entropy of some texts: embedding rows touched and theirs, filters, biases, weights, offset."""
    doc, n = np.repeat(np.arange(len(y)), np.diff(begin)), len(rows)
    x, parts, wins = e[rows[:, 0]] + e[rows[:, 1]], [], []
    for f, c in zip(filters, bias, strict=True):
        r = _responses([x @ f[j] for j in range(len(f))], begin, n)
        top = np.maximum.reduceat(r, begin[:-1], axis=0)
        place, column = np.nonzero(r == top[doc])
        _, first = np.unique(doc[place] * FILTERS + column, return_index=True)  # of equal responses the first
        wins.append(place[first].reshape(len(y), FILTERS))
        parts.append(top + c)
    z = np.concatenate(parts, 1)
    pooled = np.maximum(z, 0)
    p = 1 / (1 + np.exp(-np.clip(pooled @ w + b, -30, 30)))
    g = ((p - y) * weight / len(y)).astype(e.dtype)
    g_z = g[:, None] * w * (z > 0)
    touched, grads, g_filters, g_bias = [], [], [], []
    for k, f in enumerate(filters):
        gk, at = g_z[:, k * FILTERS : (k + 1) * FILTERS], wins[k]
        gf = np.zeros_like(f)
        for j in range(len(f)):
            here = at + j
            gf[j] = np.einsum("nfd,nf->df", x[here], gk)
            g_x = (gk[:, :, None] * f[j].T[None]).reshape(-1, e.shape[1])
            for part in (0, 1):
                touched.append(rows[here, part].ravel())
                grads.append(g_x)
        g_filters.append(gf)
        g_bias.append(gk.sum(0))
    touched, to = np.unique(np.concatenate(touched), return_inverse=True)
    g_e = np.zeros((len(touched), e.shape[1]), e.dtype)
    np.add.at(g_e, to, np.concatenate(grads))
    g_e[touched == BUCKETS] = 0  # the padding stays zero
    return touched, g_e, g_filters, g_bias, pooled.T @ g, float(g.sum())


def empty() -> Model:
    """The model of texts without both labels."""
    return Model(np.zeros((BUCKETS + 1, DIM), np.float32), [], [], np.zeros(0), 0.0, np.zeros((BUCKETS + 1, 0), np.float32), np.ones(1))


def initial(seen: np.ndarray, docs: np.ndarray, seed: int) -> Model:
    """Where training starts: seen has the texts with each word row by label, docs the texts, of those trained on."""
    rng = np.random.default_rng(seed)
    odds = np.log((seen[1] + 0.2) / (docs[1] + 1)) - np.log((seen[0] + 0.2) / (docs[0] + 1))
    odds = np.where(seen[0] + seen[1] >= 3, np.clip(odds, -3, 3), 0)
    e = (rng.standard_normal((BUCKETS + 1, DIM)) * 0.05).astype(np.float32)
    e[:, 0] = odds / 3
    e[BUCKETS] = 0
    filters = [(rng.standard_normal((w, DIM, FILTERS)) * 0.2).astype(np.float32) for w in WIDTHS]
    for f in filters:
        f[:, 0, : FILTERS // 2] = 1.0 / len(f)
    bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
    return Model(e, filters, bias, np.full(len(WIDTHS) * FILTERS, 0.3, np.float32), -1.0, np.zeros((BUCKETS + 1, 0), np.float32), np.ones(1))


class Trainer:
    """Goes over texts in steps of BATCH from a model."""

    def __init__(self, model: Model, docs: np.ndarray):
        e, filters, bias, w = model.embedding.copy(), [f.copy() for f in model.filters], [c.copy() for c in model.bias], model.weights.copy()
        self.e, self.filters, self.bias, self.w, self.b = e, filters, bias, w, model.offset
        self.moments = [np.full(p.shape, 1e-3, np.float32) for p in (e, *filters, *bias, w)]
        self.b_moment = 1e-3
        self.weight = (docs.sum() / (2 * docs)) ** 0.5  # by label
        self.moved = np.zeros(BUCKETS + 1, np.int64)  # texts by embedding row
        self.texts = 0

    def step(self, rows: np.ndarray, begin: np.ndarray, y: np.ndarray, rate: float) -> None:
        def move(p: np.ndarray, moment: np.ndarray, g: np.ndarray, at=slice(None)) -> None:
            moment[at] = 0.95 * moment[at] + 0.05 * g * g
            p[at] -= rate * g / np.sqrt(moment[at] + 1e-8)

        touched, g_e, g_filters, g_bias, g_w, g_b = gradients(self.e, self.filters, self.bias, self.w, self.b, rows, begin, y, self.weight[y.astype(np.int64)])
        n = len(self.filters)
        move(self.e, self.moments[0], g_e, touched)
        for k in range(n):
            move(self.filters[k], self.moments[1 + k], g_filters[k])
            move(self.bias[k], self.moments[1 + n + k], g_bias[k])
        move(self.w, self.moments[-1], g_w)
        self.b_moment = 0.95 * self.b_moment + 0.05 * g_b**2
        self.b -= rate * g_b / np.sqrt(self.b_moment + 1e-8)
        self.moved[touched] += len(y)
        self.texts += len(y)

    def dense(self) -> np.ndarray:
        """All parameters but the embedding, in a row."""
        return np.concatenate([*(f.ravel() for f in self.filters), *self.bias, self.w, [self.b]]).astype(np.float64)


def of_dense(model: Model, dense: np.ndarray) -> Model:
    """model with the parameters that Trainer.dense() has put in a row."""
    sizes = [p.size for p in (*model.filters, *model.bias, model.weights)]
    *parts, w, b = np.split(dense.astype(np.float32), np.cumsum(sizes))
    n = len(model.filters)
    return model._replace(filters=[p.reshape(f.shape) for p, f in zip(parts[:n], model.filters, strict=True)], bias=parts[n:], weights=w, offset=float(b[0]))


def rate_of(epoch: int) -> float:
    return 0.01 / (1 + epoch)


def shares(counts: np.ndarray) -> np.ndarray:
    """Log share of each word bucket, by language, from its counts."""
    n = counts + 0.1
    out = np.log(n / n.sum(0)).astype(np.float32) if counts.shape[1] else np.zeros(counts.shape, np.float32)
    out[BUCKETS] = 0
    return out


def fit(sample: list[tuple[str, int, str | None]], seed: int = 7) -> Model:
    """A model from (text, toxic, language) rows that fit into memory."""
    y = np.array([t for _, t, _ in sample], np.float64)
    if not len(y) or y.min() == y.max():
        return empty()
    rng = np.random.default_rng(seed)
    parts = [word_rows(pa.array([s for s, _, _ in sample[i : i + 64]], pa.large_string())) for i in range(0, len(sample), 64)]
    rows = np.concatenate([r for r, _ in parts])
    begin = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(b) for _, b in parts]))])
    held = rng.random(len(y)) < 0.25
    for label in (0, 1):  # of each label, some to train on
        own = np.flatnonzero(y == label)
        if held[own].all():
            held[own[: max(1, len(own) // 2)]] = False
    train = np.flatnonzero(~held)
    docs = [np.unique(rows[begin[i] : begin[i + 1]]) for i in train]
    seen = np.array([np.bincount(np.concatenate([np.zeros(0, np.int64), *(d for d, k in zip(docs, train, strict=True) if y[k] == label)]), minlength=BUCKETS + 1) for label in (0, 1)])
    n = np.array([(1 - y[train]).sum(), y[train].sum()])
    trainer = Trainer(initial(seen, n, seed), n)
    for epoch in range(EPOCHS):
        order = rng.permutation(train)
        for a in range(0, len(order), BATCH):
            some = order[a : a + BATCH]
            own = np.concatenate([rows[begin[i] : begin[i + 1]] for i in some])
            starts = np.concatenate([[0], np.cumsum([begin[i + 1] - begin[i] for i in some])])
            trainer.step(own, starts, y[some], rate_of(epoch))
    languages = sorted({lang for _, _, lang in sample if lang is not None})
    counts = np.zeros((BUCKETS + 1, len(languages)))
    for k, lang in enumerate(languages):
        counts[:, k] = np.bincount(np.concatenate([rows[begin[i] : begin[i + 1], 0] for i in range(len(sample)) if sample[i][2] == lang]), minlength=BUCKETS + 1)
    scorer = Scorer(Model(trainer.e, trainer.filters, trainer.bias, trainer.w, trainer.b, shares(counts), np.full(max(1, len(languages)), 0.5)))
    p, lang = scorer.plain(rows, begin), scorer.language(rows, begin)
    overall = best_threshold(p[held], y[held])
    own = [best_threshold(p[m], y[m]) if y[m := held & (lang == k)].sum() >= ENOUGH else overall for k in range(len(languages))]
    return scorer.m._replace(thresholds=np.array(own or [overall]))


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The middle of the gap between neighbouring scores that gives the best F1; 0.5 without both labels."""
    if not y.any() or y.all():
        return 0.5
    order = np.argsort(-p, kind="stable")
    p, hits = p[order], np.cumsum(y[order])
    f1 = np.where(np.append(p[1:] != p[:-1], True), 2 * hits / (np.arange(1, len(p) + 1) + y.sum()), 0)
    k = int(f1.argmax())
    return float(np.clip((p[k] + (p[k + 1] if k + 1 < len(p) else 0)) / 2, 1e-4, 1 - 1e-4))


def best_step(counts: np.ndarray) -> float:
    """best_threshold() of scores counted by label (two rows) in BINS steps of their log-odds from -SPAN to SPAN."""
    if not counts.sum(1).all():
        return 0.5
    full = np.flatnonzero(counts.sum(0))[::-1]
    hits, picked = np.cumsum(counts[1][full]), np.cumsum(counts.sum(0)[full])
    k = int((2 * hits / (picked + hits[-1])).argmax())
    below = full[k + 1] + 1 if k + 1 < len(full) else 0
    z = (full[k] + below) / 2 * (2 * SPAN / BINS) - SPAN
    return float(np.clip(1 / (1 + np.exp(-z)), 1e-4, 1 - 1e-4))


def _counted(languages: list[str], all_train: bool):
    """Texts by label and part (kinds 2 and 3); of those trained on, texts with each word row by label (kinds 0 and 1);
    words of each bucket by language (kinds from 4 on)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((4 + len(languages), BUCKETS + 1), np.int64)
        for b in slices(batches):
            rows, begin = word_rows(texts(column_of(b, "text")))
            y, held = (column_of(b, k).to_numpy(zero_copy_only=False).astype(np.int64) for k in ("toxic", "held"))
            np.add.at(n, (2 + held, y), 1)
            doc = np.repeat(np.arange(len(y)), np.diff(begin))
            for k, lang in enumerate(languages):
                own = np.array([x == lang for x in column_of(b, "lang").to_pylist()], bool)
                n[4 + k] += np.bincount(rows[own[doc], 0], minlength=BUCKETS + 1)
            once = np.unique(np.concatenate([doc * (BUCKETS + 1) + rows[:, k] for k in (0, 1)]))
            doc, row = once // (BUCKETS + 1), once % (BUCKETS + 1)
            for label in (0, 1):
                n[label] += np.bincount(row[(y[doc] == label) & (all_train | (held[doc] == 0))], minlength=BUCKETS + 1)
        kind, row = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(row), pa.array(n[kind, row])], ["kind", "row", "n"])

    return run


def _moved(shared, docs: np.ndarray, all_train: bool, rate: float):
    """Parameters after a round over the partition's texts, times the texts they follow, DIM in a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(shared.value, docs)
        for b in slices(batches):
            y, held = (column_of(b, k).to_numpy(zero_copy_only=False).astype(np.int64) for k in ("toxic", "held"))
            own = np.flatnonzero(all_train | (held == 0))
            column = texts(column_of(b, "text"))
            for a in range(0, len(own), BATCH):
                some = own[a : a + BATCH]
                trainer.step(*word_rows(column.take(pa.array(some))), y[some].astype(np.float64), rate)
        if not trainer.texts:
            return
        row = np.flatnonzero(trainer.moved)
        dense = trainer.dense()
        dense = np.pad(dense, (0, -len(dense) % DIM)).reshape(-1, DIM) * trainer.texts
        values = np.concatenate([trainer.e[row].astype(np.float64) * trainer.moved[row, None], dense])
        n = np.concatenate([trainer.moved[row], np.full(len(dense), trainer.texts)])
        row = np.concatenate([row, BUCKETS + 1 + np.arange(len(dense))])
        yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(n), *(pa.array(v) for v in values.T)], ["row", "n", *(f"d{k}" for k in range(DIM))])

    return run


def _thresholds(shared):
    """Texts held out of training by language, label and step of their score's log-odds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        n = np.zeros((max(1, shared.value.guess.shape[1]), 2, BINS), np.int64)
        for b in slices(batches):
            y, held = (column_of(b, k).to_numpy(zero_copy_only=False).astype(np.int64) for k in ("toxic", "held"))
            rows, begin = word_rows(texts(column_of(b, "text")))
            p = scorer.plain(rows, begin).astype(np.float64).clip(1e-12, 1 - 1e-12)
            step = ((np.log(p / (1 - p)) + SPAN) * (BINS / (2 * SPAN))).clip(0, BINS - 1).astype(np.int64)
            np.add.at(n, tuple(x[held == 1] for x in (scorer.language(rows, begin), y, step)), 1)
        lang, label, step = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([*map(pa.array, (lang, label, step, n[lang, label, step]))], ["lang", "label", "step", "n"])

    return run


def train(docs: DataFrame, labels: DataFrame, learn: Column | None = None, seed: int = 7) -> Model:
    """A model of docs(doc_id, text, lang) and labels(doc_id, toxic), of labels where learn holds: not held out."""
    sc = docs.sparkSession.sparkContext
    learn = ~held_out(labels["doc_id"]) if learn is None else learn
    known = labels.where(learn & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = docs.where(F.octet_length("text") > 0).select("doc_id", "text", "lang").join(known, "doc_id")
    got = rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"), F.min("lang").alias("lang"))
    mixed = F.xxhash64(F.lit(seed), "text")
    got = got.select("text", F.col("toxic").cast("int").alias("toxic"), "lang", (F.pmod(mixed, F.lit(4)) == 0).cast("int").alias("held"))
    table = written(got.sortWithinPartitions(mixed, "text"))
    rows = table.coalesce(SHARDS)  # each round, a partition sends a model at most
    there = table.groupBy("toxic", "held", "lang").agg(F.count("*").alias("n")).collect()
    of = {(y, h): sum(r["n"] for r in there if (r["toxic"], r["held"]) == (y, h)) for y in (0, 1) for h in (0, 1)}
    if not all(of[y, 0] + of[y, 1] for y in (0, 1)):
        drop(table)
        return empty()
    all_train = not (of[0, 0] and of[1, 0])  # of each label, some to train on
    n = np.array([of[y, 0] + all_train * of[y, 1] for y in (0, 1)], np.float64)
    languages = sorted({r["lang"] for r in there if r["lang"] is not None})
    counted = rows.mapInArrow(_counted(languages, all_train), "kind long, row long, n long").groupBy("kind", "row").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((4 + len(languages), BUCKETS + 1))
    counts[counted.column("kind").to_numpy(), counted.column("row").to_numpy()] = counted.column("n").to_numpy()
    model = initial(counts[:2], n, seed)._replace(guess=shares(counts[4:].T))
    columns = [f"d{k}" for k in range(DIM)]
    for epoch in range(EPOCHS):
        shared = sc.broadcast(model)
        moved = rows.mapInArrow(_moved(shared, n, all_train, rate_of(epoch)), "row long, n long, " + ", ".join(f"{c} double" for c in columns))
        moved = moved.groupBy("row").agg(*(F.sum(c).alias(c) for c in ("n", *columns))).orderBy("row").toArrow()
        values = np.stack([moved.column(c).to_numpy() for c in columns], 1) / moved.column("n").to_numpy()[:, None]
        row = moved.column("row").to_numpy()
        inner = row <= BUCKETS
        embedding = model.embedding.copy()
        embedding[row[inner]] = values[inner]
        size = len(Trainer(model, n).dense())
        model = of_dense(model._replace(embedding=embedding), values[~inner].ravel()[:size])
        shared.unpersist()
    steps = rows.mapInArrow(_thresholds(sc.broadcast(model)), "lang long, label long, step long, n long").groupBy("lang", "label", "step").agg(F.sum("n").alias("n")).toArrow()
    scored = np.zeros((max(1, len(languages)), 2, BINS))
    scored[tuple(steps.column(c).to_numpy() for c in ("lang", "label", "step"))] = steps.column("n").to_numpy()
    overall = best_step(scored.sum(0))
    model = model._replace(thresholds=np.array([best_step(c) if c[1].sum() >= ENOUGH else overall for c in scored]))
    drop(table)
    del counted, moved, steps
    release()  # the driver goes on with other work
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of docs(doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value) if shared.value.filters else None
        for b in slices(batches):
            s = scorer.scores(texts(column_of(b, "text"))) if scorer else np.zeros(b.num_rows)
            yield pa.RecordBatch.from_arrays([column_of(b, "doc_id"), column_of(b, "held_out"), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return docs.select("doc_id", held_out(docs["doc_id"]).alias("held_out"), "text").mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")
