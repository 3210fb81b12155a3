"""Exact n-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix.

Two documents link when percent * |union| <= 100 * |intersection| of their sets of word n-grams. The steps:

1. One pass names each text's distinct n-grams and gives every distinct set a class, by a digest of 128 bits; equal sets
   are one row, with a number of its own, from here.
2. N-grams that many documents share are found (counts over all documents, summed by n-gram). They only set the order
   in which n-grams are tried, rare ones first, so any subset of them keeps the join exact.
3. Of each class, only so many first n-grams in that order are posted that no link can be missed (the rest alone can't
   reach the threshold). Columns of the incidence matrix with few entries are multiplied out, overlaps are summed for
   each pair, and pairs below the bound that follows from their sizes are discarded. Of columns with more entries the
   classes are compared by parity bits of their whole sets, a bit or more for each n-gram: two sets differ in at least as
   many n-grams as their bits do, so no link is missed, and texts that share but a common n-gram stay apart. Only columns
   of more than LONG entries are tied into one group unseen, in runs of sizes that could link.
4. Pairs left and groups give candidate components. Of each, whole texts are brought together in blocks of
   bounded size, every pair of blocks is multiplied exactly, and only links that join two components leave a block.
5. Components of those links give the result.

Documents: null and empty texts, and texts without words, have an empty set and link with nothing. Texts with fewer words
than n have their whole sequence as one n-gram. Repeated rows are copies of each other. component_id is the smallest
doc_id that is reached; where no row of a component has a doc_id it is null. An empty table gives an empty result. Very long
texts are compared whole; memory follows the longest one. Other columns, whatever their names, are ignored by join() and
stay in one_of_each(); of rows that agree in all that chooses one, any one stays, and they are alike in doc_id and text.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from ..sources.scratch import drop
from ._graph import components, most_frequent, written
from ._text import U64, chained, column_of, lower_ascii, named, raw, release, slices, spans, table_of, texts

#: Bytes between words.
GAP = table_of((9, 13), (32, 32))
#: How many n-grams the order of trial can know as shared, and from which count of documents on.
SHARED, SHARED_FROM = 1 << 19, 8
#: N-grams counted at once in a task, and the count from which a task reports one.
COUNTED, REPORTED_FROM = 3 << 21, 2
#: Entries up to which a column of the incidence matrix is multiplied out pair by pair.
SHORT = 32
#: Entries up to which the classes of a longer column are compared by parity bits; what names them in _columns().
LONG, MEMBER = 4096, -2
#: Parity bits of a set: the power of two from its size on, within these.
LEAST_BITS, MOST_BITS = 128, 1 << 15
#: Classes in a block of the exact product, and entries up to which its columns are multiplied out one by one.
BLOCK, SPARSE = 512, 24
#: Bits of the filter that spares reading the sets of classes without candidates; its size is fixed.
FILTER_BITS = 1 << 25


def ngram_sets(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The sorted names of the distinct n-grams of each text of a large_string column."""
    data, at = raw(column)
    low = lower_ascii(data)
    starts, ends, doc = spans(~GAP[low], at)
    words = named(low, starts, ends)
    first = np.searchsorted(doc, np.arange(len(column) + 1))
    grams = chained([words[k : max(k, len(words) - n + 1 + k)] for k in range(n)])
    for i in range(len(column)):
        a, b = int(first[i]), int(first[i + 1])
        if b - a >= n:
            yield np.unique(grams[a : b - n + 1])
        elif b > a:
            yield chained([np.array([b - a], U64), *(words[k : k + 1] for k in range(a, b))])
        else:
            yield np.zeros(0, U64)


def class_of(grams: np.ndarray) -> tuple[int, int]:
    """A name of a set in two signed 64-bit halves."""
    b = hashlib.blake2b(grams.tobytes(), digest_size=16).digest()
    return int.from_bytes(b[:8], "little", signed=True), int.from_bytes(b[8:], "little", signed=True)


def _halves(names: list[tuple[int, int] | None]) -> list[pa.Array]:
    return [pa.array([x and x[k] for x in names], pa.int64()) for k in (0, 1)]


def needed(size: np.ndarray | int, percent: int) -> np.ndarray | int:
    """The least overlap that a set of this size needs for any link."""
    return -(-percent * size // 100)


def parity(grams: np.ndarray) -> bytes:
    """For each residue of the names, whether the set has an odd number of them. Halves XORed are the bits of half as many."""
    m = min(max(LEAST_BITS, 1 << (len(grams) - 1).bit_length()), MOST_BITS)
    return np.packbits(np.bincount((grams & U64(m - 1)).astype(np.int64), minlength=m) & 1, bitorder="little").tobytes()


def may_link(size: np.ndarray, bits: list[bytes], percent: int) -> list[tuple[int, int]]:
    """Index pairs that connect all sets that could link by their sizes and parity bits; sizes ascend."""
    level = np.array([len(b) // 8 for b in bits])
    place = np.empty(len(bits), np.int64)
    folded: dict[tuple[int, int], np.ndarray] = {}
    for k in np.unique(level).tolist():
        own = np.flatnonzero(level == k)
        place[own] = np.arange(len(own))
        folded[k, k] = np.frombuffer(b"".join(bits[i] for i in own), "<u8").reshape(len(own), k)

    def at(k: int, j: int) -> np.ndarray:
        """The bits of the sets of level k as those of level j, which isn't above it."""
        if (k, j) not in folded:
            folded[k, j] = np.bitwise_xor.reduce(folded[k, k].reshape(-1, k // j, j), axis=1)
        return folded[k, j]

    low, high = np.searchsorted(size, -(-percent * size // 100)), np.searchsorted(size, 100 * size // percent, side="right")
    fresh, out = np.ones(len(bits), bool), []
    for start in range(len(bits)):
        reached = [start] if fresh[start] else []
        fresh[start] = False
        while reached:
            x = reached.pop()
            others = low[x] + np.flatnonzero(fresh[low[x] : high[x]])
            total = size[x] + size[others]
            most = total + 2 * (-percent * total // (100 + percent))  # n-grams that one of two linked sets lacks
            for k in np.unique(level[others]).tolist():
                own = level[others] == k
                j = min(k, int(level[x]))
                differ = np.bitwise_count(at(k, j)[place[others[own]]] ^ at(int(level[x]), j)[place[x]]).sum(1)
                found = others[own][differ <= most[own]]
                fresh[found] = False
                out += [(x, y) for y in found.tolist()]
                reached += found.tolist()
    return out


def _first_pass(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []
        held = 0

        def shared() -> pa.RecordBatch:
            nonlocal kept, held
            grams, count = np.unique(np.concatenate(kept), return_counts=True)
            grams, count = grams[count >= REPORTED_FROM], count[count >= REPORTED_FROM]
            kept, held = [], 0
            none = pa.nulls(len(grams))
            return pa.RecordBatch.from_arrays([none.cast(kind), *[none.cast(pa.int64())] * 3, pa.array(grams.view(np.int64)), pa.array(count)], names)

        names, kind = ["doc_id", "size", "v", "u", "gram", "count"], pa.int64()
        for b in slices(batches):
            kind = column_of(b, "doc_id").type
            sets = list(ngram_sets(texts(column_of(b, "text")), n))
            none = pa.nulls(b.num_rows, pa.int64())
            v = [class_of(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([column_of(b, "doc_id"), pa.array([len(s) for s in sets], pa.int64()), *_halves(v), none, none], names)
            kept += sets
            held += sum(map(len, sets))
            if held >= COUNTED:
                yield shared()
        if held:
            yield shared()

    return run


def _second_pass(n: int, percent: int, shared):
    """Name, size, the posted n-grams and the parity bits of each text's set, once where a task meets it again soon."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rank = shared.value  # sorted n-grams, and their place from the rarest on
        seen: set[tuple[int, int]] = set()
        for b in slices(batches):
            vs, sizes, posted, bits = [], [], [], []
            for s in ngram_sets(texts(column_of(b, "text")), n):
                if not len(s) or (v := class_of(s)) in seen:
                    continue
                if len(seen) < 1 << 17:
                    seen.add(v)
                bits.append(parity(s))
                if len(known):
                    i = np.minimum(np.searchsorted(known, s), len(known) - 1)
                    # those that aren't known as shared come first, by hash; equal sets give equal orders
                    s = s[np.argsort(np.where(known[i] == s, rank[i] + 1, 0), kind="stable")]
                vs.append(v)
                sizes.append(len(s))
                posted.append(s[: len(s) - needed(len(s), percent) + 1].view(np.int64))
            at = np.concatenate([[0], np.cumsum([len(p) for p in posted])]).astype(np.int32)
            flat = pa.array(np.concatenate(posted) if posted else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([*_halves(vs), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(at), flat), pa.array(bits, pa.binary())], ["v", "u", "size", "grams", "bits"])

    return run


def _columns(percent: int):
    """Products of short columns as pairs with overlap, and ties of those beyond LONG. Rows come sorted by gram, then size.

    Entries of the columns between are rows with overlap MEMBER: the class, the n-gram, the set's size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "b", "size_a", "size_b", "overlap"]

        def made(rows: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(rows[:, k]) for k in range(5)], names)

        # of a column that goes on in the next batch: its entries up to LONG; then only the run's first and last
        gram, vs, ns = None, [], []
        head = last = None
        ties: list[tuple[int, int, int, int, int]] = []

        def tie(v: int, size: int) -> None:
            nonlocal head, last
            if head is not None and percent * size <= 100 * last:
                if v != head[0]:
                    ties.append((head[0], v, head[1], size, -1))
            else:
                head = (v, size)
            last = size

        def product(vs: np.ndarray, ns: np.ndarray) -> np.ndarray:
            i, j = np.triu_indices(len(vs), 1)
            i, j = i[(ok := percent * ns[j] <= 100 * ns[i])], j[ok]
            low, high = np.where(vs[i] < vs[j], i, j), np.where(vs[i] < vs[j], j, i)
            return np.stack([vs[low], vs[high], ns[low], ns[high], np.ones(len(low), np.int64)], 1)

        def close() -> None:
            """Ends the open column."""
            nonlocal head, last, vs, ns
            if head is None and len(vs) > SHORT:
                members.append(np.stack([np.array(vs), np.full(len(vs), gram), np.array(ns), np.zeros(len(vs), np.int64), np.full(len(vs), MEMBER)], 1))
            elif head is None and len(vs) > 1:
                pairs.append(product(np.array(vs), np.array(ns)))
            head, last, vs, ns = None, None, [], []

        pairs: list[np.ndarray] = []
        members: list[np.ndarray] = []
        for b in batches:
            if not b.num_rows:
                continue
            g, v, s = (column_of(b, k).to_numpy() for k in ("gram", "c", "size"))
            cut = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1], [True]]))
            # columns of one entry matter only where they may go on in a neighbouring batch
            for k in np.unique(np.concatenate([[0], np.flatnonzero(np.diff(cut) > 1), [len(cut) - 2]])).tolist():
                x, y = int(cut[k]), int(cut[k + 1])
                if gram != g[x]:
                    close()
                    gram = g[x]
                vs += v[x:y].tolist()
                ns += s[x:y].tolist()
                if head is not None or len(vs) > LONG:
                    for one in zip(vs, ns, strict=True):
                        tie(*one)
                    vs, ns = [], []
            if ties:
                pairs.append(np.unique(np.array(ties, np.int64), axis=0))
                ties = []
            if pairs:
                rows = np.concatenate(pairs)
                distinct, inverse = np.unique(rows[:, :2], axis=0, return_inverse=True)
                inverse = inverse.reshape(-1)
                out = np.zeros((len(distinct), 5), np.int64)
                out[inverse] = rows
                overlap = np.bincount(inverse, np.maximum(rows[:, 4], 0), len(distinct)).astype(np.int64)
                tied = np.zeros(len(distinct), bool)
                tied[inverse[rows[:, 4] < 0]] = True
                out[:, 4] = np.where(tied, 1 << 40, overlap)
                pairs = []
                yield made(out)
            if members:
                yield made(np.concatenate(members))
                members = []
        close()
        if pairs or members:
            yield made(np.concatenate(pairs + members))

    return run


def _compared(percent: int):
    """Ties between the classes of each column that could link by their parity bits. Rows come sorted by gram, then size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, cs, sizes, bits = None, [], [], []

        def ties() -> np.ndarray:
            size, c = np.array(sizes, np.int64), np.array(cs, np.int64)
            return c[np.array(may_link(size, bits, percent), np.int64).reshape(-1, 2)]

        def made(rows: list[np.ndarray]) -> pa.RecordBatch:
            rows = np.concatenate(rows)
            return pa.RecordBatch.from_arrays([pa.array(rows[:, 0]), pa.array(rows[:, 1])], ["a", "b"])

        for b in batches:
            if not b.num_rows:
                continue
            g = column_of(b, "gram").to_numpy()
            cut = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1], [True]])).tolist()
            out = []
            for x, y in zip(cut[:-1], cut[1:], strict=True):
                if gram != g[x]:
                    out.append(ties())
                    gram, cs, sizes, bits = g[x], [], [], []
                cs += column_of(b, "c")[x:y].to_pylist()
                sizes += column_of(b, "size")[x:y].to_pylist()
                bits += column_of(b, "bits")[x:y].to_pylist()
            if out:
                yield made(out)
        yield made([ties()])

    return run


def _bits(names: DataFrame):
    """A filter of FILTER_BITS bits over a column of longs, for _holds(); its size is fixed."""
    bit = names.toDF("bit").select(F.col("bit").bitwiseAND(FILTER_BITS - 1).alias("bit"))
    words = bit.groupBy(F.shiftright("bit", 5).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 31 as int))")).alias("bits")).toPandas()
    out = np.zeros(FILTER_BITS >> 5, np.uint32)
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).astype(np.uint32)
    return names.sparkSession.sparkContext.broadcast(out)


def _holds(bits: np.ndarray, name: int) -> bool:
    k = name & (FILTER_BITS - 1)
    return bool(bits[k >> 5] >> np.uint32(k & 31) & np.uint32(1))


def _wanted(n: int, wanted):
    """Name and text of the rows that may stand for a class with candidates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted.value
        for b in slices(batches):
            column = texts(column_of(b, "text"))
            keep, vs = [], []
            for i, (s, d) in enumerate(zip(ngram_sets(column, n), column_of(b, "d").to_pylist(), strict=True)):
                if not len(s):
                    continue
                v = class_of(s)
                if _holds(bits, v[0] ^ d):
                    keep.append(i)
                    vs.append(v)
            yield pa.RecordBatch.from_arrays([*_halves(vs), column.take(pa.array(keep, pa.int64()))], ["v", "u", "text"])

    return run


def block_links(first: list[np.ndarray], second: list[np.ndarray] | None, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of the links between two lists of sets, or within one."""
    sets = first + (second or [])
    m, cut = len(sets), len(first)
    size = np.array([len(s) for s in sets], np.int64)
    grams, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(m), size)
    count = np.bincount(column, minlength=len(grams))
    keep = count[column] > 1
    column, row = column[keep], row[keep]
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]  # within a column, rows ascend
    grams, start, count = np.unique(column, return_index=True, return_counts=True)
    # columns of few entries are multiplied out entry by entry, columns of one length together
    overlap = np.zeros(m * m, np.float32)
    for k in np.unique(count[count <= SPARSE]).tolist():
        entries = row[start[count == k][:, None] + np.arange(k)]
        i, j = np.triu_indices(k, 1)
        step = max(1, (1 << 21) // len(i))
        for c in range(0, len(entries), step):
            overlap += np.bincount((entries[c : c + step, i] * m + entries[c : c + step, j]).ravel(), minlength=m * m)
    overlap = overlap.reshape(m, m)
    overlap += overlap.T
    # the others as dense columns
    keep = count[np.searchsorted(grams, column)] > SPARSE
    row = row[keep]
    dense, column = np.unique(column[keep], return_inverse=True)
    width = max(64, (1 << 22) // m)
    for a in range(0, len(dense), width):
        x, y = np.searchsorted(column, [a, a + width])
        part = np.zeros((m, min(width, len(dense) - a)), np.float32)
        part[row[x:y], column[x:y] - a] = 1
        overlap += part @ part.T
    o = overlap.astype(np.int64)
    link = 100 * o >= percent * (size[:, None] + size[None, :] - o)
    i, j = np.nonzero(np.triu(link, 1))
    if second is not None:
        ok = (i < cut) & (j >= cut)
        i, j = i[ok], j[ok]
    return i, j


def _blocks(n: int, percent: int):
    def run(group: pa.Table) -> pa.Table:
        # rows of one doc_id and one set are alike
        v, once = np.unique(group.column("c").to_numpy(), return_index=True)
        group = group.take(pa.array(once))
        # a row is in the first block of its pair, in the second, or in both if they are one
        own, one = group.column("own").to_pylist(), group.column("x")[0].as_py() == group.column("y")[0].as_py()
        # texts are moved, not sets: they are less than half as large, and sets are made again in no time
        sets = list(ngram_sets(texts(group.column("text").combine_chunks()), n))
        x = group.column("x")[0].as_py()
        in_first = np.array([o == x for o in own], bool)
        first, second = np.flatnonzero(in_first), None if one else np.flatnonzero(~in_first)
        rows = np.concatenate([first, second]) if second is not None else first
        root = {}

        def find(k: int) -> int:
            while root.setdefault(k, k) != k:
                root[k] = root[root[k]]
                k = root[k]
            return k

        out = []
        if len(first) and (second is None or len(second)) and len(rows) > 1:
            i, j = block_links([sets[k] for k in first], [sets[k] for k in second] if second is not None else None, percent)
            for a, b in zip(v[rows[i]].tolist(), v[rows[j]].tolist(), strict=True):
                a, b = find(a), find(b)
                if a != b:
                    root[max(a, b)] = min(a, b)
                    out.append((a, b))
        return pa.table({"a": pa.array([p[0] for p in out], pa.int64()), "b": pa.array([p[1] for p in out], pa.int64())})

    return run


def _tagged(n: int, names: list[str], shared):
    """The rows as they are, their class's name, and whether the filter of shared classes holds it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for b in slices(batches):
            v = [class_of(s) if len(s) else None for s in ngram_sets(texts(column_of(b, "text")), n)]
            among = pa.array([x is not None and _holds(bits, x[0]) for x in v], pa.bool_())
            yield pa.RecordBatch.from_arrays([*b.columns, *_halves(v), among], [*b.schema.names, *names])

    return run


def one_of_each(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """One row of docs for each component: the one with the smallest doc_id (nulls last), then the smallest text.

    Documents without words are linked with nothing, so all of them stay. Columns stay as they are, and may have any
    names; rows that are alike in doc_id and text are one. Only rows of classes that a second row shares are shuffled.
    """
    rows, classes = _classes(docs.select("doc_id", "text"), n, percent)
    total = classes.groupBy("label").agg(F.sum("n").alias("rows")).where("rows > 1")
    shared = written(classes.join(total, "label", "left_semi"))
    for done in (rows, classes):
        drop(done)
    least = F.struct(F.col("least").isNull().alias("none"), F.col("least"), F.col("v"), F.col("u"))
    stands = shared.groupBy("label").agg(F.min(least).alias("x")).select("x.least", "x.v", "x.u")
    names = []
    for name in ("v", "u", "among"):
        while name in docs.columns:
            name += "_"
        names.append(name)
    kinds = (LongType(), LongType(), BooleanType())
    tag = _tagged(n, names, _bits(shared.select("v")))
    tagged = written(docs.mapInArrow(tag, StructType([*docs.schema.fields, *map(StructField, names, kinds)])))
    v, u, among = (tagged[c] for c in names)
    alone = tagged.where(~among).select(*docs.columns)
    rows = tagged.where(among).select(F.struct(*[tagged[c] for c in docs.columns]).alias("row"), v.alias("v"), u.alias("u"))
    # a row that the filter holds by chance may be of a class of its own: it stays as it is
    rows = rows.join(shared.select("v", "u", F.lit(True).alias("known")), ["v", "u"], "left")
    chance = rows.where("known IS NULL").select("row.*")
    order = F.struct(F.col("row.text").alias("text"))
    own = rows.where("known").join(stands.withColumnsRenamed({"v": "sv", "u": "su"}), (F.col("v") == F.col("sv")) & (F.col("u") == F.col("su")) & F.col("row.doc_id").eqNullSafe(F.col("least")))
    one = own.groupBy("v", "u").agg(F.min_by("row", order).alias("row"))
    return alone.unionByName(chance).unionByName(one.select("row.*"))


def join(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles (size of its set) and component_id of every row of docs(doc_id, text)."""
    rows, classes = _classes(docs, n, percent)
    whole = classes.groupBy("label").agg(F.min("least").alias("component_id"))
    by_class = written(classes.join(whole, "label").select("v", "u", "component_id"))
    out = rows.join(by_class, ["v", "u"], "left")
    return out.select("doc_id", F.col("size").alias("n_shingles"), F.when(F.col("v").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def _classes(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, size, v, u, null without words), and classes (v, u, n rows, least doc_id, label of the component)."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    passed = written(docs.mapInArrow(_first_pass(n), f"doc_id {kind}, size long, v long, u long, gram long, count long"))
    rows = passed.where("gram IS NULL").select("doc_id", "size", "v", "u")
    common = written(passed.where("gram IS NOT NULL").groupBy("gram").agg(F.sum("count").alias("count")).where(F.col("count") >= SHARED_FROM))
    # at most SHARED rows of two longs; which of them are known only moves work, never a result
    top = most_frequent(common, "count", SHARED)[0].toPandas()
    grams, count = top["gram"].to_numpy(np.int64), top["count"].to_numpy(np.int64)
    rank = np.empty(len(grams), np.int64)
    rank[np.lexsort((-grams, count))] = np.arange(len(grams))
    grams = grams.view(U64)
    order = np.argsort(grams)
    shared = sc.broadcast((grams[order], rank[order]))
    del top, grams, count, rank, order
    release()

    posted = docs.mapInArrow(_second_pass(n, percent, shared), "v long, u long, size long, grams array<long>, bits binary")
    posted = posted.groupBy("v", "u").agg(F.first("size").alias("size"), F.first("grams").alias("grams"), F.first("bits").alias("bits"))
    posted = written(posted.withColumn("c", F.monotonically_increasing_id()))  # numbers hold once they are written
    # one row of each class gives its set: the one with the class's smallest doc_id
    own = rows.where("v IS NOT NULL").groupBy("v", "u").agg(F.count("*").alias("n"), F.min("doc_id").alias("least"))
    classes = written(own.join(posted.select("v", "u", "c", "size"), ["v", "u"]))
    entries = posted.select("c", "size", F.explode("grams").alias("gram"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pairs = written(entries.repartition(parts, "gram").sortWithinPartitions("gram", "size", "c").mapInArrow(_columns(percent), "a long, b long, size_a long, size_b long, overlap long"))
    members = pairs.where(F.col("overlap") == MEMBER).select(F.col("a").alias("c"), F.col("b").alias("gram"), F.col("size_a").alias("size"))
    members = members.join(posted.select("c", "bits"), "c").select("gram", "size", "c", "bits")
    ties = members.repartition(parts, "gram").sortWithinPartitions("gram", "size", "c").mapInArrow(_compared(percent), "a long, b long")
    least = lambda size: F.ceil(percent * F.col(size) / 100)
    # what two sets can share beyond the posted n-grams, at most, and what they must share in all
    rest = F.greatest(least("size_a"), least("size_b")) - 1
    must = F.ceil(percent * (F.col("size_a") + F.col("size_b")) / (100 + percent))
    near = pairs.where(F.col("overlap") != MEMBER).groupBy("a", "b", "size_a", "size_b").agg(F.sum("overlap").alias("overlap")).where(F.col("overlap") + rest >= must)
    candidates = written(components(near.select("a", "b").unionByName(ties)))
    for done in (common, posted, pairs):  # all that is left of them is in classes and candidates
        drop(done)

    # a large group is cut by size into bands so wide that links never reach further than the next one
    sized = candidates.join(classes.select(F.col("c").alias("node"), "size"), "node")
    group = candidates.groupBy("label").agg(F.count("*").alias("n"))
    log = F.floor(F.log("size") / (1.0001 * math.log(100 / percent))) if percent < 100 else F.col("size")
    banded = sized.join(group, "label").select("node", "label", F.when(F.col("n") > BLOCK, log).otherwise(F.lit(0)).cast("long").alias("band"))
    bands = banded.groupBy("label", "band").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    order = Window.partitionBy("label").orderBy("band").rangeBetween(1, 1)
    below = Window.partitionBy("label").orderBy("band").rangeBetween(-1, -1)
    bands = bands.withColumns({"above": F.coalesce(F.max("blocks").over(order), F.lit(0)), "below": F.coalesce(F.max("blocks").over(below), F.lit(0))})
    member = banded.join(bands, ["label", "band"]).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    member = member.join(classes.select(F.col("c").alias("node"), "v", "u", "least"), "node").drop("n", "size")
    wanted = _bits(member.select(F.col("v").bitwiseXOR(F.xxhash64("least"))))
    sets = docs.withColumn("d", F.xxhash64("doc_id")).mapInArrow(_wanted(n, wanted), "v long, u long, text string")
    sets = sets.join(member.withColumnRenamed("node", "c").drop("least"), ["v", "u"])
    block = lambda band, k: F.struct(band.alias("band"), k.cast("int").alias("k"))
    mine = block(F.col("band"), F.col("own"))
    upto = lambda n: F.slice(F.sequence(F.lit(0), F.greatest(F.col(n), F.lit(1)) - 1), F.lit(1), F.col(n))
    pair = lambda x, y: F.struct(F.least(x, y).alias("x"), F.greatest(x, y).alias("y"))
    same = F.transform(upto("blocks"), lambda k: pair(mine, block(F.col("band"), k)))
    up = F.transform(upto("above"), lambda k: pair(mine, block(F.col("band") + 1, k)))
    down = F.transform(upto("below"), lambda k: pair(mine, block(F.col("band") - 1, k)))
    dealt = sets.withColumn("p", F.explode(F.concat(same, up, down))).select("c", "label", mine.alias("own"), F.col("p.x").alias("x"), F.col("p.y").alias("y"), "text")
    links = dealt.groupBy("label", "x", "y").applyInArrow(_blocks(n, percent), "a long, b long")
    label = components(links)

    return rows, written(classes.join(label, classes.c == label.node, "left").select("v", "u", "n", "least", F.coalesce("label", "c").alias("label")))
