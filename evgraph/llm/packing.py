"""Packing token sequences: patterns by non-negative least squares, residuals by best fit.

Only the histogram of lengths (as many numbers as a sequence has tokens) reaches the driver. There,
patterns of few lengths that fill a sequence are enumerated over coarse lengths, their repeat
counts are fitted to the histogram by non-negative least squares and rounded down, and the
larger documents of each pattern are placed. Its smallest place and all residual documents are
filled at exact lengths by best fit, longest first. Runs of equal sequences are handled as
ranges, so the plan's size depends on the sequence length alone. Every task then looks its
pieces up in the plan by (length, rank); ranks come from counts by task and length.

Edge cases: a null or empty text is the closing id alone; a text that fills sequences exactly
gives no empty piece; equal lengths are ranked by task and place in it; repeated rows are packed
as often as they occur; the empty table gives no piece; further columns are left out.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from evgraph.llm.token_counts import tokenizer
from evgraph.session import written

CLOSING = 1
WORDS_KEPT = 1_000_000
MARK, JOINED = b"\x01", 256
_ids: dict[str, list[dict[bytes, bytes]]] = {}


class WordIds:
    """Ids of texts by a byte-level vocabulary that drops white space: every word is encoded once, ``JOINED`` new words
    as one text with a mark between them. The mark is a control character, whose id is that of its byte and so occurs
    in no other word; words that hold it are encoded by themselves. About ``WORDS_KEPT`` words are remembered: those met
    since the last turn, at half that number, and those met in the turn before, so that frequent words stay."""

    def __init__(self, path: str):
        self.path, self.turns = path, _ids.setdefault(path, [{}, {}])

    @property
    def known(self) -> dict[bytes, bytes]:
        return self.turns[0]

    def learn(self, new: list[bytes]) -> None:
        encode = tokenizer(self.path).encode_batch_fast
        plain = [w for w in new if MARK not in w]
        lines = [plain[i : i + JOINED] for i in range(0, len(plain), JOINED)]
        mark, *alone = encode([MARK.decode(), *(w.decode() for w in new if MARK in w)], add_special_tokens=False)
        if len(mark.ids) != 1:
            raise ValueError("the vocabulary has no id for a single byte")
        self.known.update(zip((w for w in new if MARK in w), (np.array(e.ids, "<u4").tobytes() for e in alone)))
        between = b" " + MARK + b" "
        for line, found in zip(lines, encode([between.join(line).decode() for line in lines], add_special_tokens=False)):
            ids = np.array(found.ids, "<u4")
            ends = np.flatnonzero(ids == mark.ids[0])
            starts = np.concatenate([[0], ends + 1]) * 4
            raw = ids.tobytes()
            ends = [*(ends * 4).tolist(), len(raw)]
            self.known.update(zip(line, (raw[a:b] for a, b in zip(starts.tolist(), ends))))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        words = [t.encode().split() if t else [] for t in texts]
        if len(self.known) > WORDS_KEPT // 2:
            self.turns[:] = {}, self.known
        known, older = self.turns
        new = set().union(*words).difference(known)
        again = new.intersection(older)
        known.update(zip(again, map(older.__getitem__, again)))
        new = list(new.difference(again))
        if new:
            self.learn(new)
        return [b"".join(map(known.__getitem__, line)) for line in words]


def pieces(docs: DataFrame, path: str, size: int, key: str) -> DataFrame:
    """One row for each piece: its place in the document, length and checksum of its ids, and the task
    that cut it with its place among the task's pieces of that length."""
    closing = np.array([CLOSING], "<u4").tobytes()

    def run(batches):
        words, part = WordIds(path), TaskContext.get().partitionId()
        seen = np.zeros(size + 1, np.int64)
        for batch in batches:
            texts = batch.column(1)
            row, piece, length, crc, nth = [], [], [], [], []
            for at in range(0, len(texts), 128):
                for i, ids in enumerate(words.encode(texts.slice(at, 128).to_pylist()), at):
                    ids += closing
                    for j, start in enumerate(range(0, len(ids), 4 * size)):
                        part_ids = ids[start : start + 4 * size]
                        n = len(part_ids) // 4
                        row.append(i)
                        piece.append(j)
                        length.append(n)
                        crc.append(zlib.crc32(part_ids))
                        nth.append(int(seen[n]))
                        seen[n] += 1
            keys = batch.column(0).take(pa.array(row, pa.int64()))
            piece = np.array(piece, np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    keys, pa.array(piece), pa.array(piece.astype(np.int64) * size), pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()), pa.array(np.full(len(row), part, np.int64)), pa.array(nth, pa.int64()),
                ],
                names=[key, "piece", "start", "length", "ids_crc32", "_part", "_nth"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, F.col("text").cast("string")).mapInArrow(
        run, f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long, _part long, _nth long"
    )


def patterns(units: int, most: int = 3) -> list[tuple[int, ...]]:
    """Every way to write ``units`` as a sum of 2 to ``most`` positive numbers, largest first."""
    found = []

    def extend(head: tuple[int, ...], rest: int) -> None:
        limit = min(rest, head[-1] if head else rest - 1)
        for n in range(limit, 0, -1):
            if n == rest and head:
                found.append((*head, n))
            elif n < rest and len(head) + 1 < most:
                extend((*head, n), rest - n)

    extend((), units)
    return found


def least_squares(a: np.ndarray, b: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """x >= 0 that minimises ``|a x - b|``, by an active set of positive entries."""
    n = a.shape[1]
    x, free = np.zeros(n), np.zeros(n, bool)
    tolerance = 1e-9 * max(1.0, np.abs(a.T @ b).max(initial=0))
    for _ in range(rounds):
        slope = a.T @ (b - a @ x)
        slope[free] = -np.inf
        if n == 0 or slope.max() <= tolerance:
            break
        free[int(np.argmax(slope))] = True
        while True:
            s = np.zeros(n)
            s[free] = np.linalg.lstsq(a[:, free], b, rcond=None)[0]
            bad = free & (s <= 1e-12)
            if not bad.any():
                x = s
                break
            step = np.min(x[bad] / np.maximum(x[bad] - s[bad], 1e-300))
            x = x + step * (s - x)
            free &= x > 1e-12
            x[~free] = 0
    return x


class Plan:
    """Placements (length, first rank, number, first sequence, offset) of all documents."""

    def __init__(self, counts: np.ndarray, size: int):
        self.size, self.left, self.used = size, counts.copy(), np.zeros(size + 1, np.int64)
        self.rows: list[tuple[int, int, int, int, int]] = []
        self.open: dict[int, list[tuple[int, int]]] = {}  # gap -> ranges (first sequence, number)
        self.gaps: list[int] = []
        self.sequences = 0

    def place(self, length: int, n: int, sequence: int, gap: int) -> None:
        self.rows.append((length, int(self.used[length]), n, sequence, self.size - gap))
        self.used[length] += n
        self.left[length] -= n
        self.leave(gap - length, sequence, n)

    def leave(self, gap: int, sequence: int, n: int) -> None:
        if gap:
            if gap not in self.open:
                self.open[gap] = []
                insort(self.gaps, gap)
            self.open[gap].append((sequence, n))

    def best_fit(self, length: int, n: int) -> None:
        """Put ``n`` documents into the smallest gaps that hold them, then into new sequences."""
        while n:
            at = bisect_left(self.gaps, length)
            if at == len(self.gaps):
                self.leave(self.size, self.sequences, n)
                self.sequences += n
                continue
            gap = self.gaps[at]
            sequence, free = self.open[gap].pop()
            if not self.open[gap]:
                del self.open[gap], self.gaps[at]
            if gap == self.size and gap >= 2 * length:  # open no more new sequences than they fill
                wanted = -(-n // (gap // length))
                if wanted < free:
                    if sequence + free == self.sequences:
                        self.sequences = sequence + wanted
                        free = wanted
            now = min(n, free)
            if now < free:
                self.leave(gap, sequence + now, free - now)
            self.place(length, now, sequence, gap)
            n -= now


def make_plan(counts: np.ndarray, size: int, units: int = 128) -> Plan:
    """``counts[l]`` documents of each length l up to ``size``."""
    plan = Plan(counts.astype(np.int64), size)
    if counts[size]:
        plan.best_fit(size, int(counts[size]))
    units = min(units, size)
    width = -(-size // units)
    coarse = -(-np.arange(size + 1) // width)  # rounded up
    histogram = np.bincount(coarse, weights=plan.left, minlength=units + 1)[: units + 1]
    ways = patterns(units)
    a = np.zeros((units + 1, len(ways)))
    for j, way in enumerate(ways):
        for u in way:
            a[u, j] += 1
    weight = np.sqrt(np.arange(units + 1) + 1.0)[:, None]  # a long document left over costs more
    repeats = np.floor(least_squares(a * weight, histogram * weight[:, 0])).astype(np.int64) if histogram.any() else np.zeros(len(ways), np.int64)
    lengths: dict[int, list[int]] = {}
    for length in range(size - 1, 0, -1):
        if plan.left[length]:
            lengths.setdefault(int(coarse[length]), []).append(length)

    def take(unit: int, n: int) -> list[tuple[int, int]]:
        """Up to ``n`` documents of a coarse length, as (length, number), longest first."""
        out = []
        for length in lengths.get(unit, ()):
            now = min(n, int(plan.left[length] - held.get(length, 0)))
            if now > 0:
                out.append((length, now))
                held[length] = held.get(length, 0) + now
                n -= now
            if not n:
                break
        return out

    for j in sorted(np.flatnonzero(repeats).tolist(), key=lambda j: ways[j], reverse=True):
        held: dict[int, int] = {}
        large = [take(u, int(repeats[j])) for u in ways[j][:-1]]
        n = min(sum(k for _, k in runs) for runs in large)
        base, plan.sequences = plan.sequences, plan.sequences + n
        # walk the runs of all places together, so that equal sequences stay one range
        at, ends = 0, [list(runs) for runs in large]
        while at < n:
            now = min([runs[0][1] for runs in ends] + [n - at])
            gap = size
            for runs in ends:
                length, k = runs[0]
                plan.rows.append((length, int(plan.used[length]), now, base + at, size - gap))
                plan.used[length] += now
                plan.left[length] -= now
                gap -= length
                runs[0] = (length, k - now)
                if k == now:
                    runs.pop(0)
            plan.leave(gap, base + at, now)
            at += now
    for length in range(size, 0, -1):
        if plan.left[length]:
            plan.best_fit(length, int(plan.left[length]))
    return plan


def pack(docs: DataFrame, path: str, size: int = 4096, key: str = "doc_id") -> DataFrame:
    """key, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    cut = written(pieces(docs, path, size, key), "pieces")
    tasks = cut.groupBy("_part", "length").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    tasks = written(tasks.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))), "ranks")
    counts = np.zeros(size + 1, np.int64)
    for length, n in tasks.groupBy("length").agg(F.sum("_n")).collect():  # at most ``size`` rows
        counts[length] = n
    plan = make_plan(counts, size)
    table = np.array(sorted(plan.rows), np.int64).reshape(-1, 5)
    shared = docs.sparkSession.sparkContext.broadcast(table)  # bounded by the sequence length

    def run(batches):
        table = shared.value
        # rank < 2**44 and length < 2**18, so that both fit one sorted number
        starts = (table[:, 0] << 44) + table[:, 1]
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "_rank"))
            line = np.searchsorted(starts, (length << 44) + rank, side="right") - 1
            sequence = table[line, 3] + rank - table[line, 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(table[line, 4])],
                names=[*batch.schema.names[:5], "sequence_id", "offset"],
            )

    kind = docs.schema[key].dataType.simpleString()
    ranked = cut.join(tasks.drop("_n"), ["_part", "length"]).select(
        key, "piece", "start", "length", "ids_crc32", (F.col("_before") + F.col("_nth")).alias("_rank")
    )
    return ranked.mapInArrow(
        run, f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
