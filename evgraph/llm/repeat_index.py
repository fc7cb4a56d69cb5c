"""Suffix-array dedup: bytes of long passages that a document with a smaller id holds too.

Equal texts are collapsed first. In the others every window of ``LONG`` bytes is named by its smallest
hashed ``GRAM``-byte string (the anchor), and windows that follow each other with one anchor form a segment. Equal
windows lie in segments of one anchor, so anchors of a single document leave at once, equal segments collapse to the
smallest document that holds them, and the rest is dealt out by anchor. Segments move as places and hashes; the bytes
of one segment of a kind are fetched from its text, and only where its anchor has segments of other kinds. Segments are
found anew for every one of ``ROUNDS`` shares of the anchors, so that only a share of them is on disk at a time.

Every share of segments becomes a run-length index: its suffix array, the runs of its Burrows-Wheeler transform
with their starts, and, sampled at the ends of the ranges that share ``LONG`` bytes, the smallest document of
the range. Segments are streamed through the index from their last byte to their first, one step of the run-length
transform for each byte; the range met at a byte says whether a match of ``LONG`` bytes starts there in a smaller document.
Anchors with more than ``CROWD`` different segments, which no single task should hold, are counted by whole
windows instead, with the same result.

Ids are integers. Edge cases: null texts are empty; null ids come after all others and not before each other;
rows with equal ids do not remove from each other; texts shorter than ``LONG`` bytes lose nothing; the
empty table gives the empty table; further columns are left out.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from evgraph.llm.textnum import mix, powers, signed, slices
from evgraph.session import passing, written

LONG, GRAM = 50, 20
CROWD, SHARE = 2048, 16_000
ROUNDS = 2
_LAST = (1 << 63) - 1


def segments(data: np.ndarray, offsets: np.ndarray, long: int = LONG, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(row, anchor, hash, start in the row, bytes) of every segment."""
    n, none = len(data), np.zeros(0, np.int64)
    empty = none, none.astype(np.uint64), none.astype(np.uint64), none, none
    if n < long:
        return empty
    up, down = powers(n)
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], dtype=np.uint64)])
    value = mix((prefix[gram:] - prefix[:-gram]) * down[: n - gram + 1])
    span, have = long - gram + 1, 1
    while have < span:  # the smallest hash among the next ``have``
        more = min(have, span - have)
        value = np.minimum(value[: len(value) - more], value[more:])
        have += more
    room = np.repeat(offsets[1:], np.diff(offsets))[: n - long + 1]
    starts = np.flatnonzero(np.arange(n - long + 1) + long <= room)
    if not len(starts):
        return empty
    anchor = value[starts]
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(fresh)
    length = np.diff(np.append(first, len(starts)))
    if length.max() > span:  # one string again and again keeps its hash: cut such runs
        at = np.arange(len(starts)) - np.repeat(first, length)
        first = np.flatnonzero(at % span == 0)
        length = np.diff(np.append(first, len(starts)))
    size = length - 1 + long
    begin = starts[first]
    code = mix((prefix[begin + size] - prefix[begin]) * down[begin] + size.astype(np.uint64))
    row = np.searchsorted(offsets, begin, side="right") - 1
    return row, anchor[first], code, begin - offsets[row], size


class RunIndex:
    """The run-length transform of some byte strings, each of a document."""

    def __init__(self, texts: list[bytes], doc: np.ndarray, long: int = LONG):
        self.size, self.doc, self.long = np.array([len(t) for t in texts], np.int64), doc, long
        many = len(texts)
        body = np.frombuffer(b"".join(t + b"\0" for t in texts), np.uint8).astype(np.int64) + many
        ends = np.cumsum(self.size + 1) - 1
        body[ends] = np.arange(many)  # every string ends in a mark of its own
        n = len(body)
        owner = np.repeat(np.arange(many), self.size + 1)
        key, below, have, half = body, many + 256, 1, None
        while 2 * have <= min(4, long // 2) and below**2 < 1 << 62:  # the first ranks are by a few bytes at once
            key = key * below + np.roll(key, -have)
            below, have = below * below, 2 * have
        _, rank = np.unique(key, return_inverse=True)
        while True:
            if 2 * have > long and half is None:
                half, shift = rank, long - have  # ranks by ``have`` bytes; two of them cover ``long``
            if rank.max() + 1 == n:
                break
            key = rank * np.int64(n + 1) + np.roll(rank, -have)
            order = np.argsort(key)  # equal keys get one rank in any order
            step = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
            rank = np.empty(n, np.int64)
            rank[order] = step
            have *= 2
        suffix = np.empty(n, np.int64)
        suffix[rank] = np.arange(n)
        last = body[suffix - 1]
        self.run = np.flatnonzero(np.concatenate([[True], last[1:] != last[:-1]]))
        letter, length = last[self.run], np.diff(np.append(self.run, n))
        order = np.argsort(letter, kind="stable")  # runs of one letter, one after the other, are the rows it opens
        self.target = np.empty(len(order), np.int64)
        self.target[order] = np.cumsum(length[order]) - length[order]
        if half is None:  # all suffixes differ within fewer bytes
            self.edge = np.arange(n)
        else:
            far = half[(suffix + shift) % n]
            near = half[suffix]
            self.edge = np.flatnonzero(np.concatenate([[True], (near[1:] != near[:-1]) | (far[1:] != far[:-1])]))
        self.least = np.minimum.reduceat(doc[owner[suffix]], self.edge)

    def step(self, row: np.ndarray) -> np.ndarray:
        """The row of the suffix that is one byte longer."""
        run = np.searchsorted(self.run, row, side="right") - 1
        return self.target[run] + row - self.run[run]

    def matches(self) -> tuple[np.ndarray, np.ndarray]:
        """(string, start) of every ``long`` bytes that a smaller document holds too."""
        found, live = [], np.arange(len(self.size))
        row = live.copy()  # the rows of the closing marks come first, in order
        for back in range(1, int(self.size.max(initial=0)) + 1):
            more = self.size[live] >= back
            live, row = live[more], self.step(row[more])
            if back >= self.long:
                least = self.least[np.searchsorted(self.edge, row, side="right") - 1]
                hit = live[least < self.doc[live]]
                found.append(np.stack([hit, self.size[hit] - back]))
        pairs = np.concatenate([np.zeros((2, 0), np.int64), *found], axis=1)
        order = np.lexsort((pairs[1], pairs[0]))
        return pairs[0][order], pairs[1][order]


def _marks(table: pa.Table) -> pa.Table:
    """anchor, code, starts of the segments of one share that hold an earlier match."""
    doc = table.column("first").to_numpy()
    string, start = RunIndex(table.column("bytes").to_pylist(), doc).matches()
    rows, at = np.unique(string, return_index=True)
    starts = pa.ListArray.from_arrays(pa.array(np.append(at, len(start)).astype(np.int32)), pa.array(start.astype(np.int32)))
    taken = table.select(["anchor", "code"]).take(pa.array(rows))
    return pa.table({"anchor": taken.column(0), "code": taken.column(1), "starts": starts})


def with_text_key(docs: DataFrame, key: str) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{key}`").alias("key"), text.alias("text"))
    order = F.coalesce(F.col("key").cast("long"), F.lit(_LAST)).alias("doc")
    return rows.select("key", order, "text", F.xxhash64("text").alias("t1"), F.hash("text", F.length("text")).alias("t2"))


def found_segments(texts: DataFrame, turn: int, turns: int) -> DataFrame:
    """(id, doc, anchor, code, start, size) of every segment of one share of the anchors."""

    def run(batches):
        for batch in batches:
            for a, b, data, offsets in slices(batch.column(2)):
                row, anchor, code, start, size = segments(data, offsets)
                if turns > 1:
                    own = np.flatnonzero(anchor % np.uint64(turns) == turn)
                    row, anchor, code, start, size = (x[own] for x in (row, anchor, code, start, size))
                at = pa.array(row + a)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(i).take(at) for i in range(2)), pa.array(signed(anchor)), pa.array(signed(code)),
                        pa.array(start.astype(np.int32)), pa.array(size.astype(np.int32)),
                    ],
                    names=["id", "doc", "anchor", "code", "start", "size"],
                )

    return texts.select("id", "doc", "text").mapInArrow(run, "id long, doc long, anchor long, code long, start int, size int")


def shared_anchors(texts: DataFrame) -> DataFrame:
    """anchor of every anchor that several documents hold."""

    def run(batches):
        for batch in batches:
            doc = batch.column(0).to_numpy()
            for a, _, data, offsets in slices(batch.column(1)):
                row, anchor, *_ = segments(data, offsets)
                yield pa.RecordBatch.from_arrays([pa.array(signed(anchor)), pa.array(doc[row + a])], names=["anchor", "doc"])

    found = texts.select("doc", "text").mapInArrow(run, "anchor long, doc long")
    return found.groupBy("anchor").agg(F.min("doc").alias("_a"), F.max("doc").alias("_b")).where("_a < _b").select("anchor")


def early_matches(texts: DataFrame) -> DataFrame:
    """(t1, t2, ranges) of distinct texts (id, t1, t2, doc, text): struct(a, b), bytes of matches in smaller documents."""
    shared, found = written(shared_anchors(texts), "shared"), []
    for turn in range(ROUNDS):
        with passing(texts.sparkSession, keep=1):
            found.append(written(matches_of_share(texts, shared, turn, ROUNDS), "found"))
    ranges = reduce(DataFrame.unionByName, found).groupBy("id").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))
    return texts.select("id", "t1", "t2").join(ranges, "id").drop("id")


def matches_of_share(texts: DataFrame, shared: DataFrame, turn: int, turns: int) -> DataFrame:
    """(id, ranges) by the anchors of one share."""
    # merged whatever the size: which side of a join moves should not change with the table
    held = found_segments(texts, turn, turns).join(shared.hint("merge"), "anchor")
    # a segment's code; segments that differ under one anchor and one code would have to agree in both hashes
    held = written(held, "held")
    one = F.min(F.struct("id", "start", "size")).alias("one")
    distinct = written(held.groupBy("anchor", "code").agg(F.min("doc").alias("first"), one), "distinct")
    sizes = written(distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "sizes")
    crowded = sizes.where(F.col("n") > CROWD).select("anchor")
    # bytes of the segments of anchors that have several
    wanted = distinct.join(sizes.select("anchor"), "anchor", "left_semi")
    cuts = wanted.groupBy("one.id").agg(F.collect_list(F.struct("anchor", "code", "first", "one.start", "one.size")).alias("cuts"))
    bodies = texts.select("id", F.col("text").cast("binary").alias("body")).join(cuts, "id").select("body", F.explode("cuts").alias("c"))
    part = F.substring("body", F.col("c.start") + 1, F.col("c.size")).alias("bytes")
    bodies = written(bodies.select("c.anchor", "c.code", "c.first", part), "bodies")
    shares = max(1, bodies.count() // SHARE)
    calm = bodies.join(crowded, "anchor", "left_anti")
    calm = calm.withColumn("share", F.pmod(F.xxhash64("anchor"), F.lit(shares)))
    marks = calm.groupBy("share").applyInArrow(lambda t: _marks(t), "anchor long, code long, starts array<int>")
    windows = bodies.join(crowded, "anchor", "left_semi")
    places = F.explode(F.sequence(F.lit(0), F.length("bytes") - LONG)).alias("at")
    windows = windows.select("anchor", "code", "first", "bytes", places)
    windows = windows.select("anchor", "code", "first", "at", F.substring("bytes", F.col("at") + 1, F.lit(LONG)).alias("window"))
    least = windows.groupBy("window").agg(F.min("first").alias("least"))
    late = windows.join(least, "window").where(F.col("least") < F.col("first"))
    late = late.groupBy("anchor", "code").agg(F.sort_array(F.collect_list("at")).alias("starts"))
    marks = written(marks.unionByName(late), "marks")
    ends = distinct.select("anchor", "code", "first").join(marks, ["anchor", "code"], "left")
    rows = held.join(ends, ["anchor", "code"])
    whole = F.array(F.struct(F.col("start").alias("a"), (F.col("start") + F.col("size")).alias("b")))
    some = F.transform("starts", lambda i: F.struct((F.col("start") + i).alias("a"), (F.col("start") + i + LONG).alias("b")))
    rows = rows.select("id", F.when(F.col("doc") > F.col("first"), whole).otherwise(some).alias("r")).where("r is not null")
    return rows.groupBy("id").agg(F.flatten(F.collect_list("r")).alias("ranges"))


def cut(body: bytes, ranges: list[tuple[int, int]]) -> tuple[int, int, str]:
    """Bytes and runs that go, and the hash of what stays."""
    gone = np.zeros(len(body) + 1, np.int64)
    if ranges:
        a, b = np.array(ranges, np.int64).T
        np.add.at(gone, a, 1)
        np.add.at(gone, b, -1)
    out = np.cumsum(gone)[:-1] > 0
    spans = int(out[:1].sum() + (out[1:] & ~out[:-1]).sum())
    kept = np.frombuffer(body, np.uint8)[~out].tobytes()
    return int(out.sum()), spans, hashlib.sha256(kept).hexdigest()


def report(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    rows = with_text_key(docs, key)
    with passing(docs.sparkSession, keep=1):
        firsts = written(rows.groupBy("t1", "t2").agg(F.min("doc").alias("first")), "firsts")
        one = rows.where(F.octet_length("text") >= LONG).join(firsts, ["t1", "t2"]).where("doc = first")
        one = one.select("t1", "t2", "doc", "text").dropDuplicates(["t1", "t2"])
        texts = written(one.select(F.monotonically_increasing_id().alias("id"), "*"), "texts")
        ranges = written(early_matches(texts), "ranges")
        plan = written(firsts.join(ranges, ["t1", "t2"], "left"), "plan")
    size = F.octet_length("text")
    all_of_it = F.array(F.struct(F.lit(0).alias("a"), size.alias("b")))
    joined = rows.join(plan, ["t1", "t2"]).select(
        "key", "text", F.when((F.col("doc") > F.col("first")) & (size >= LONG), all_of_it).otherwise(F.col("ranges")).alias("ranges")
    )

    def run(batches):
        for batch in batches:
            sizes, found = [], []
            lists = batch.column(2)
            for i, text in enumerate(batch.column(1)):
                body = text.as_buffer().to_pybytes() if text.is_valid else b""
                r = lists[i].values
                pairs = list(zip(r.field(0).to_pylist(), r.field(1).to_pylist())) if r is not None else []
                sizes.append(len(body))
                found.append(cut(body, pairs))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(sizes, pa.int64()), pa.array([f[0] for f in found], pa.int64()),
                    pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.string()),
                ],
                names=[key, "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return joined.mapInArrow(run, f"`{key}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
