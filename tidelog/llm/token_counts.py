"""Token counts of a byte-level BPE without token ids.

Merges never cross pre-token borders, so the number of pieces of a pre-token is a fact about the pre-token alone:

1. One pass cuts whole texts into pre-tokens with array operations and sums their frequencies over all documents.
2. The table of distinct pre-tokens is counted, each one once in the whole corpus, by the library.
3. A second pass has the frequencies of each document's pre-tokens, joins them to the table, and sums. The COMMON most
   frequent rows of the table go to every worker, which is a bounded broadcast and the bulk of all text; what a document
   holds beyond them is joined to the table by a shuffle of those pre-tokens alone.

Pre-tokens are compared as bytes, never as hashes. Ids are never kept. Pre-tokens of more than LONG bytes, hardly ever met
twice, are counted where they stand instead of being moved, and texts with special strings, or with characters whose class
differs between Unicode versions, are counted as whole texts by the library.

Null and empty texts have 0 bytes and 0 tokens. Rows are independent: repeated rows give repeated results, an empty table
gives an empty result, other columns of the input, whatever their names, are ignored. Ties can't arise. Very long texts
are counted whole; memory follows the longest one.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._graph import most_frequent, written
from ._text import column_of, distinct, raw, slices, texts

#: Bytes up to which a pre-token goes through the table.
LONG = 64
#: Rows of the table that every worker gets, at most.
COMMON = 1 << 18
#: Distinct pre-tokens that a task holds before it hands on their frequencies.
HELD = 400_000
OTHER, LETTER, NUMBER, SPACE, UNSURE = range(5)
#: The letters after an apostrophe that the pre-token pattern takes as one piece.
SUFFIXES = ("s", "t", "re", "ve", "m", "ll", "d")


@lru_cache(1)
def classes() -> np.ndarray:
    """Class of each code point; unassigned ones are UNSURE, as Unicode versions may differ on them."""
    out = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))
        out[c] = LETTER if kind[0] == "L" else NUMBER if kind[0] == "N" else UNSURE if kind == "Cn" else OTHER
    for c in (*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000):
        out[c] = SPACE
    return out


def pre_token_starts(cp: np.ndarray, at: np.ndarray) -> np.ndarray:
    """True where a pre-token starts. cp: code points of many texts; at: their offsets, none of them empty."""
    n = len(cp)
    kind = classes()[cp]
    start = np.empty(n, bool)
    start[0] = True
    start[1:] = kind[1:] != kind[:-1]
    first = np.zeros(n + 1, bool)
    first[at] = True
    start |= first[:n]
    run_ends = np.append(start[1:], True)  # last of its run
    # the last of a run of spaces stands alone, or leads the next run when it is a blank, unless the text ends there
    led = (kind == SPACE) & run_ends & ~first[1:]
    start |= led
    blank = np.flatnonzero(led & (cp == 32))
    start[blank + 1] = False
    quote = np.flatnonzero((cp == 39) & start & run_ends & ~first[1:])
    if len(quote):
        # a quote alone in its run, followed by letters; one that a blank leads isn't a start any more
        quote = quote[kind[quote + 1] == LETTER]
        nxt, nxt2 = cp[quote + 1], np.where(quote + 2 < n, cp[np.minimum(quote + 2, n - 1)], 0)
        inner = np.where(quote + 2 < n, ~first[np.minimum(quote + 2, n)], False)
        one = np.isin(nxt, [ord(x) for x in SUFFIXES if len(x) == 1])
        two = np.zeros(len(quote), bool)
        for s in SUFFIXES:
            if len(s) == 2:
                two |= inner & (nxt == ord(s[0])) & (nxt2 == ord(s[1]))
        size = np.where(one, 1, np.where(two, 2, 0))
        quote, size = quote[size > 0], size[size > 0]
        start[quote + 1] = False
        after = quote + 1 + size
        start[after[after < n]] = True
    return start


class Cut(NamedTuple):
    """Pre-tokens of many texts: the distinct ones, which one stands where, and where each text's begin."""

    some: list[bytes]
    where: np.ndarray
    bounds: np.ndarray
    whole: dict[int, int]  # tokens of the texts that aren't cut


class Counter:
    """Cuts texts and counts tokens; one for each worker and vocabulary file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.special = [t.content for t in self.lib.get_added_tokens_decoder().values()]

    def counted(self, some: list[str]) -> list[int]:
        """Tokens of each of some texts or pre-tokens."""
        return [len(e) for e in self.lib.encode_batch_fast(some, add_special_tokens=False)]

    def cut(self, column: pa.Array) -> Cut:
        """The pre-tokens of each text of a large_string column."""
        strings = column.to_pylist()
        odd = {i for i, t in enumerate(strings) if any(x in t for x in self.special)}
        cp, at = self._points(["" if i in odd else t for i, t in enumerate(strings)])
        unsure = np.flatnonzero(classes()[cp] == UNSURE)
        if len(unsure):
            odd |= set((np.searchsorted(at, unsure, "right") - 1).tolist())
            cp, at = self._points(["" if i in odd else t for i, t in enumerate(strings)])
        whole = dict(zip(sorted(odd), self.counted([strings[i] for i in sorted(odd)]), strict=True))
        if not len(cp):
            return Cut([], np.zeros(0, np.int64), np.zeros(len(column) + 1, np.int64), whole)
        starts = np.flatnonzero(pre_token_starts(cp, np.unique(at)))
        size = np.concatenate([[0], np.cumsum(1 + (cp >= 0x80) + (cp >= 0x800) + (cp >= 0x10000))])
        some, where = distinct(np.frombuffer("".join(t for i, t in enumerate(strings) if i not in odd).encode(), np.uint8), size[np.append(starts, len(cp))])
        return Cut(some, where, np.searchsorted(starts, at), whole)

    @staticmethod
    def _points(strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Code points of texts put together, and their offsets."""
        return np.frombuffer("".join(strings).encode("utf-32-le"), np.uint32), np.concatenate([[0], np.cumsum([len(t) for t in strings], dtype=np.int64)])


@lru_cache(2)
def counter(path: str) -> Counter:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Counter(path)


def frequencies(docs: DataFrame, vocabulary: str, held: int = HELD) -> DataFrame:
    """pre_token and n, its number in all texts of docs(text), of the distinct pre-tokens up to LONG bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, total = counter(vocabulary), {}
        made = lambda: pa.RecordBatch.from_arrays([pa.array([t.decode() for t in total], pa.string()), pa.array(total.values(), pa.int64())], ["pre_token", "n"])
        for b in slices(batches):
            cut = own.cut(texts(column_of(b, "text")))
            for t, n in zip(cut.some, np.bincount(cut.where, minlength=len(cut.some)).tolist(), strict=True):
                if len(t) <= LONG:
                    total[t] = total.get(t, 0) + n
            if len(total) > held:
                yield made()
                total.clear()
        yield made()

    return docs.select("text").mapInArrow(run, "pre_token string, n long").groupBy("pre_token").agg(F.sum("n").alias("n"))


def table(docs: DataFrame, vocabulary: str) -> DataFrame:
    """pre_token, n and pieces of every distinct pre-token up to LONG bytes, each counted once; written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(vocabulary)
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(own.counted(column_of(b, "pre_token").to_pylist()), pa.int64())], ["pre_token", "n", "pieces"])

    return written(frequencies(docs, vocabulary).mapInArrow(run, "pre_token string, n long, pieces long"))


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 1024, common: int = COMMON) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > limit) of every text of docs(doc_id, text).

    vocabulary: a file of the tokenizers library, at the same place on every machine.
    """
    docs = docs.select("doc_id", "text")
    counted = table(docs, vocabulary)
    top, every = most_frequent(counted, "n", common)
    got = top.select("pre_token", "pieces").toArrow()  # `common` rows of LONG bytes, at most
    known = dict(zip((t.encode() for t in got.column("pre_token").to_pylist()), got.column("pieces").to_pylist(), strict=True))
    shared = docs.sparkSession.sparkContext.broadcast(known)
    pair = pa.list_(pa.struct([("pre_token", pa.string()), ("times", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, pieces, row = counter(vocabulary), shared.value, TaskContext.get().partitionId() << 40
        for b in slices(batches):
            column = texts(column_of(b, "text"))
            cut = own.cut(column)
            n = np.array([pieces.get(t, -1) for t in cut.some], np.int64)
            long = [k for k in np.flatnonzero(n < 0).tolist() if len(cut.some[k]) > LONG]
            n[long] = own.counted([cut.some[k].decode() for k in long])
            # the join of the table to the frequencies of each document, summed
            upto = np.concatenate([[0], np.cumsum(np.maximum(n, 0)[cut.where])])
            total = np.diff(upto[cut.bounds])
            for i, tokens in cut.whole.items():
                total[i] = tokens
            rare = [[] for _ in range(b.num_rows)]
            left = np.flatnonzero(n[cut.where] < 0)
            if len(left):
                doc = np.searchsorted(cut.bounds, left, "right") - 1
                both, times = np.unique(np.stack([doc, cut.where[left]], 1), axis=0, return_counts=True)
                for (i, k), t in zip(both.tolist(), times.tolist(), strict=True):
                    rare[i].append({"pre_token": cut.some[k].decode(), "times": t})
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(row, row + b.num_rows)), column_of(b, "doc_id"), pa.array(np.diff(raw(column)[1])), pa.array(total, pa.int64()), pa.array(rare, pair)], ["row", "doc_id", "n_bytes", "n_tokens", "rare"])
            row += b.num_rows

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = docs.mapInArrow(run, f"row long, doc_id {kind}, n_bytes long, n_tokens long, rare array<struct<pre_token:string,times:bigint>>")
    if not every:
        out = written(out)  # numbers of rows hold once they are written
        rare = out.select("row", F.explode("rare").alias("r")).select("row", "r.*")
        more = rare.join(counted, "pre_token").groupBy("row").agg(F.sum(F.col("times") * F.col("pieces")).alias("more"))
        out = out.join(more, "row", "left").withColumn("n_tokens", F.col("n_tokens") + F.coalesce("more", F.lit(0)))
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
