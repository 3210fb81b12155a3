"""Language identification by partial matching.

For each language a byte context tree of contexts of 0 to ORDER bytes is counted once and then frozen. In a context that
was seen n times with d different next bytes, a byte seen c times costs -log2(c / (n + d)) bits; any other byte costs the
escape, -log2(d / (n + d)), and what it costs in the context that is one byte shorter, down to 8 bits without context.
Unseen contexts cost nothing to leave. The language with the shortest exact code length of the whole text wins.

All trees are merged into tables from byte strings to code lengths, one column for each language, with the escapes of
shorter contexts already added, so a text is scored by table look-ups over arrays, never byte by byte. The tables hold
every string of the sample, which alone bounds them: one left out would cost more than its exact code length.

The trees are fitted on at most SAMPLE distinct labelled texts of each language, those first by hash; texts of more than
SAMPLE_BYTES only fill what shorter ones leave free, with their first SAMPLE_BYTES. Which rows may be learnt from is a
parameter. Texts that are null or have no letter are `und` with score
0. score is the winner's share of 2^-(bits), tempered by the length. Without any labelled row everything is `und`.
Repeated rows give repeated results, an empty table an empty one; A-Z count as a-z. Of equal code lengths the language first
in order wins. Very long texts are scored whole; memory follows the longest one. Other columns, whatever their names, are
ignored by predict() and stay in kept().
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._text import U64, column_of, lower_ascii, raw, release, slices, texts

ORDER = 4
SAMPLE, SAMPLE_BYTES = 300, 16_384
PARTS = 64
UND = "und"
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


class Table(NamedTuple):
    """Sorted strings of bytes, packed into numbers, and a row of bits for each (one column a language)."""

    keys: np.ndarray
    bits: np.ndarray


class Trees(NamedTuple):
    languages: list[str]
    known: list[Table]  # by context length: context and next byte, with escapes to shorter contexts added
    leave: list[Table]  # by context length: escape from the context and from all its ends


def grams(data: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """The n bytes that end at each byte, packed; before its text stand newlines."""
    out = data.astype(U64)
    where = np.arange(len(data)) - np.repeat(at[:-1], np.diff(at))
    for k in range(1, n):
        earlier = np.full(len(data), 10, U64)
        earlier[k:] = data[: max(0, len(data) - k)]
        earlier[where < k] = 10
        out |= earlier << U64(8 * k)
    return out


def _find(table: Table, keys: np.ndarray) -> np.ndarray:
    """Row of each key, or -1."""
    if not len(table.keys):
        return np.full(len(keys), -1)
    i = np.minimum(np.searchsorted(table.keys, keys), len(table.keys) - 1)
    return np.where(table.keys[i] == keys, i, -1)


def fit(rows: list[tuple[str, str]]) -> Trees:
    """Trees from (language, text) rows."""
    languages = sorted({lang for lang, _ in rows})
    column = {lang: k for k, lang in enumerate(languages)}
    data, at, _ = _joined([t for _, t in rows])
    of = np.repeat([column[lang] for lang, _ in rows], np.diff(at)) if rows else np.zeros(0, np.int64)
    full = grams(data, at, ORDER + 1)
    known, leave, shorter = [], [], None
    for k in range(ORDER + 1):
        keys, where = np.unique(full & U64((1 << 8 * (k + 1)) - 1), return_inverse=True)
        count = np.zeros((len(keys), len(languages)))
        np.add.at(count, (where, of), 1)
        # statistics of the contexts: all but the last byte
        contexts, to = np.unique(keys >> U64(8), return_inverse=True)
        n, d = np.zeros((2, len(contexts), len(languages)))
        np.add.at(n, to, count)
        np.add.at(d, to, count > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = np.where(n > 0, -np.log2(d / (n + d)), 0.0)
            own = -np.log2(count / (n + d)[to])
        if shorter is None:
            below, outer = np.full((len(keys), len(languages)), 8.0), np.zeros((len(contexts), len(languages)))
        else:
            low = keys & U64((1 << 8 * k) - 1)
            below = shorter[0].bits[np.searchsorted(shorter[0].keys, low)]
            outer = shorter[1].bits[np.searchsorted(shorter[1].keys, contexts & U64((1 << 8 * max(0, k - 1)) - 1))]
        bits = np.where(count > 0, own, escape[to] + below)
        shorter = Table(keys, bits), Table(contexts, escape + outer)
        known.append(Table(keys, bits.astype(np.float32)))
        leave.append(Table(contexts, shorter[1].bits.astype(np.float32)))
    return Trees(languages, known, leave)


def _joined(some: list[str]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    column = pa.array(some, pa.large_string())
    data, at = raw(column)
    return lower_ascii(data), at, column


def lengths(trees: Trees, data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Bits of each text by each language. data: bytes in lower case."""
    full = grams(data, at, ORDER + 1)
    bits = np.zeros((len(data), len(trees.languages)), np.float32)
    left = np.arange(len(data))
    for k in range(ORDER, -1, -1):
        keys = full[left] & U64((1 << 8 * (k + 1)) - 1)
        row = _find(trees.known[k], keys)
        hit = row >= 0
        bits[left[hit]] += trees.known[k].bits[row[hit]]
        # a string that isn't in the table leaves its context, if that was seen; what it costs below is added there
        left, keys = left[~hit], keys[~hit]
        if len(left):
            row = _find(trees.leave[k], keys >> U64(8))
            seen = row >= 0
            bits[left[seen]] += trees.leave[k].bits[row[seen]]
            if k:
                # leave holds the escapes of all shorter contexts too, and they come again at the next length
                row = _find(trees.leave[k - 1], (keys[seen] >> U64(8)) & U64((1 << 8 * (k - 1)) - 1))
                bits[left[seen]] -= trees.leave[k - 1].bits[row]
    bits[left] += 8
    out = np.zeros((len(at) - 1, len(trees.languages)))
    some = np.flatnonzero(np.diff(at) > 0)
    if len(some):
        out[some] = np.add.reduceat(bits.astype(np.float64), at[some], axis=0)
    return out


def has_letter(column: pa.Array, data: np.ndarray, at: np.ndarray) -> np.ndarray:
    count = np.concatenate([[0], np.cumsum(_LETTER[data])])
    out = np.diff(count[at]) > 0
    for i in np.flatnonzero(~out & (np.diff(at) > 0)):
        out[i] = any(c.isalpha() for c in column[int(i)].as_py())
    return out


def held_out(doc_id: Column, of: int = 4, part: int = 2) -> Column:
    """True for the part that nothing is learnt from; a null id is learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % of == part, F.lit(False))


def train(docs: DataFrame, learn: Column | None = None) -> Trees:
    """Trees from docs(doc_id, text, lang), of the rows where learn holds: by default those not held out."""
    learn = ~held_out(docs["doc_id"]) if learn is None else learn
    rows = docs.where(learn & F.col("lang").isNotNull() & (F.octet_length("text") > 0)).select("lang", F.xxhash64("text").alias("h"), (F.octet_length("text") > SAMPLE_BYTES).alias("long"), F.substring(F.col("text").cast("binary"), 1, SAMPLE_BYTES).alias("head"))
    # only hashes are ranked, each once however many copies its text has: first of each part of a language, then of the
    # language. Limits on ranks are applied in each task before a shuffle, and no task meets more than SAMPLE rows of each
    # of PARTS parts
    first = rows.select("lang", "h", "long").distinct()
    for keys in (["lang", "part"], ["lang"]):
        first = first.withColumn("part", F.pmod("h", F.lit(PARTS))).withColumn("r", F.row_number().over(Window.partitionBy(*keys).orderBy("long", "h"))).where(F.col("r") <= SAMPLE)
    rows = rows.join(F.broadcast(first.select("lang", "h", "long")), ["lang", "h", "long"]).groupBy("lang", "h", "long").agg(F.min("head").alias("head"))
    got = rows.select("lang", "head").toArrow()  # SAMPLE x SAMPLE_BYTES for each language, at most
    # a head may end inside a character
    trees = fit(sorted(zip(got.column("lang").to_pylist(), [h.decode(errors="ignore") for h in got.column("head").to_pylist()], strict=True)))
    del got
    release()  # the driver goes on with other work
    return trees


def predict(docs: DataFrame, trees: Trees | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score and bits_per_byte of every row of docs(doc_id, text, lang)."""
    shared = docs.sparkSession.sparkContext.broadcast(trees or train(docs))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            lang, score, rate = judge(shared.value, texts(column_of(b, "text")))
            yield pa.RecordBatch.from_arrays([column_of(b, "doc_id"), column_of(b, "held_out"), pa.array(lang, pa.string()), pa.array(score), pa.array(rate)], ["doc_id", "held_out", "lang_pred", "score", "bits_per_byte"])

    return docs.select("doc_id", held_out(docs["doc_id"]).alias("held_out"), "text").mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, bits_per_byte double")


def judge(trees: Trees, column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and bits for each byte of each text of a large_string column."""
    data, at = raw(column)
    bytes_of = np.diff(at)
    ok = has_letter(column, data, at)
    if not trees.languages:
        return [UND] * len(column), np.zeros(len(column)), np.zeros(len(column))
    bits = lengths(trees, lower_ascii(data), at)
    best = bits.argmin(1)
    least = bits[np.arange(len(bits)), best]
    # neighbouring bytes aren't independent evidence: long texts would all score 1
    share = np.exp2(-(bits - least[:, None]) / np.sqrt(np.maximum(bytes_of, 1))[:, None])
    score = np.where(ok, 1 / share.sum(1), 0.0)
    return [trees.languages[k] if o else UND for k, o in zip(best.tolist(), ok.tolist(), strict=True)], score, least / np.maximum(bytes_of, 1)


def kept(docs: DataFrame, trees: Trees | None = None) -> DataFrame:
    """The rows of docs whose text has a language; those that are `und` go. Columns stay as they are.

    Where docs has no labelled row nothing can be told apart, and only texts without letters go.
    """
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            column = texts(column_of(b, "text"))
            lang = judge(shared.value, column)[0] if shared.value.languages else None
            keep = [x != UND for x in lang] if lang else has_letter(column, *raw(column)).tolist()
            yield b.filter(pa.array(keep, pa.bool_()))

    shared = docs.sparkSession.sparkContext.broadcast(trees or train(docs))
    return docs.mapInArrow(run, schema)
