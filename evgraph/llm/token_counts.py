"""Token counts of whole texts, huge ones by overlapping chunks spliced where both agree.

A text longer than ``chunk`` characters is encoded in chunks that overlap. Two neighbours are
spliced at a position of the overlap where (1) both encodings begin a token and (2) the text
itself proves that any encoding begins one: a space between two characters that are no white
space, for a vocabulary whose words carry their leading space; white space at all, for one
that drops it. The overlap doubles until such a position is found or the chunk holds the rest
of the text, so a text without any gap is encoded whole: slow, never wrong.

Edge cases: null and empty texts have 0 tokens and 0 bytes; the empty table gives the empty
table; repeated rows and null ids are counted like any other row; further columns are left out
of the result, which has its own names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# A space whose neighbours are no white space always opens a new word of these vocabularies,
# and no special string holds white space.
STABLE = re.compile(r"(?<=\S) (?=\S)")
CUTS = re.compile(r"(?<=\S)(?= \S)")
PIECES = 500_000
_loaded: dict[str, object] = {}
_memo: dict[str, dict[str, int]] = {}


def tokenizer(path: str):
    """One tokenizer for each worker process."""
    if path not in _loaded:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _loaded[path] = Tokenizer.from_file(path)
        _loaded[path].no_truncation()
        _loaded[path].no_padding()
    return _loaded[path]


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def splice(text: str, encode, chunk: int, overlap: int) -> Iterator[tuple[int, int]]:
    """(start, number of tokens) of consecutive pieces of a text whose tokens, side by side,
    are those of the whole text. ``encode(str)`` gives an encoding with offsets."""
    start, size = 0, len(text)
    left = encode(text[:chunk])
    left_end = min(chunk, size)
    while left_end < size:
        wide = overlap
        while True:
            begin = max(start + 1, left_end - wide)
            end = min(size, begin + chunk + wide)
            right = encode(text[begin:end])
            opens_left = {a for a, _ in left.offsets}
            opens_right = {a for a, _ in right.offsets}
            # In the left encoding a position near its end is followed by cut text, so the
            # splice must lie before the last gap; in the right one it must lie after the first.
            cut = next(
                (
                    at.start()
                    for at in STABLE.finditer(text, begin + 1, max(begin + 1, left_end - 1))
                    if at.start() - start in opens_left and at.start() - begin in opens_right
                ),
                None,
            )
            if cut is not None or begin == start + 1:
                break
            wide *= 2
        if cut is None:  # no provable boundary in reach: take more text into the left part
            left_end = min(size, left_end + max(chunk, left_end - start))
            left = encode(text[start:left_end])
            continue
        yield start, sum(a < cut - start for a, _ in left.offsets)
        kept = cut - begin
        start, left_end = cut, end
        left = _Rest(right, kept)
    yield start, len(left.offsets)


class _Rest:
    """An encoding from a position on."""

    def __init__(self, encoding, kept: int):
        self.offsets = [(a - kept, b - kept) for a, b in encoding.offsets if a >= kept]


def count_text(text: str, path: str, chunk: int, overlap: int) -> int:
    encode = tokenizer(path).encode
    pieces = splice(text, lambda part: encode(part, add_special_tokens=False), chunk, overlap)
    return sum(n for _, n in pieces)


class PieceCounts:
    """Tokens of texts of usual length: a text is cut at every provable boundary, and equal
    pieces are encoded once. At most ``PIECES`` pieces are remembered."""

    def __init__(self, path: str):
        self.path, self.known = path, _memo.setdefault(path, {})

    def fill(self, texts: list[str], counts: list[int | None]) -> None:
        """Put the count of every text whose count is missing."""
        rows = [(i, CUTS.split(t)) for i, t in enumerate(texts) if counts[i] is None]
        for at in range(0, len(rows), 256):
            some = rows[at : at + 256]
            if len(self.known) > PIECES:
                self.known.clear()
            new = list({p for _, pieces in some for p in pieces}.difference(self.known))
            found = tokenizer(self.path).encode_batch_fast(new, add_special_tokens=False)
            self.known.update(zip(new, map(len, found)))
            for i, pieces in some:
                counts[i] = sum(map(self.known.__getitem__, pieces))


def token_counts(
    docs: DataFrame, path: str, limit: int = 1024, chunk: int = 32_768, overlap: int = 512, key: str = "doc_id"
) -> DataFrame:
    """``key``, n_bytes, n_tokens, over_limit for every row of ``docs``."""

    def run(batches):
        memo = PieceCounts(path)
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column(1).to_pylist()]
            counts = [count_text(t, path, chunk, overlap) if len(t) > chunk else None for t in texts]
            memo.fill(texts, counts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array([n > limit for n in counts], pa.bool_()),
                ],
                names=[key, "n_bytes", "n_tokens", "over_limit"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, docs["text"].cast("string")).mapInArrow(
        run, f"`{key}` {kind}, n_bytes long, n_tokens long, over_limit boolean"
    )
