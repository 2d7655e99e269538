"""Token counts by heap-and-linked-list byte-pair merging.

A piece of text starts as a linked list of byte symbols. A heap holds the adjacent
pairs that the vocabulary merges, by rank and then position; the lowest is popped
again and again, its left symbol takes over the right one, and the two new
neighbouring pairs go on the heap. The token count is the number of initial symbols
minus the number of merges, so no identifiers are produced.

Spark cuts the texts into pieces with the vocabulary's own pattern; a task counts
every distinct piece of a batch once and adds the counts up per document.

A null text counts as empty: no bytes, no tokens. A special token's string inside a
text is one token, as the library has it by default. Rows don't influence each other.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telestrata.llm.common import ship

# Unicode white space, and the pattern that cuts a text into pieces.
SPACE = r"\t-\r\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
PIECES = (
    r"'s|'t|'re|'ve|'m|'ll|'d"
    r"| ?\p{L}+"
    r"| ?\p{N}+"
    rf"| ?[^{SPACE}\p{{L}}\p{{N}}]+"
    rf"|[{SPACE}]+(?![^{SPACE}])"
    rf"|[{SPACE}]+"
)
MEMO = 400_000  # distinct pieces remembered per worker


class Merges:
    """The merge ranks of a byte-level vocabulary file (``.json``)."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        letters = _byte_letters()
        self.symbols = [letters[b] for b in range(256)]
        self.specials = [t["content"] for t in spec["added_tokens"]]
        pairs = [p if isinstance(p, list) else p.split(" ") for p in spec["model"]["merges"]]
        self.ranks = {(left, right): rank for rank, (left, right) in enumerate(pairs)}
        self.memo: dict[str, int] = {}

    def count(self, piece: str) -> int:
        """Tokens of one piece."""
        n = self.memo.get(piece)
        if n is None:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            n = self.memo[piece] = self.merged(piece.encode())
        return n

    def merged(self, data: bytes) -> int:
        ranks = self.ranks
        symbol = [self.symbols[b] for b in data]
        n = len(symbol)
        heap = [
            (rank, i, symbol[i], symbol[i + 1])
            for i in range(n - 1)
            if (rank := ranks.get((symbol[i], symbol[i + 1]))) is not None
        ]
        heapify(heap)
        after = list(range(1, n + 1))  # n ends the list
        before = list(range(-1, n - 1))
        merges = 0
        while heap:
            _, i, left, right = heappop(heap)
            j = after[i]
            # A pair is stale if either symbol was merged since it was pushed.
            if symbol[i] != left or j >= n or symbol[j] != right:
                continue
            merges += 1
            symbol[i], symbol[j] = left + right, ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (rank := ranks.get((symbol[i], symbol[k]))) is not None:
                    heappush(heap, (rank, i, symbol[i], symbol[k]))
            h = before[i]
            if h >= 0 and (rank := ranks.get((symbol[h], symbol[i]))) is not None:
                heappush(heap, (rank, h, symbol[h], symbol[i]))
        return n - merges


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a vocabulary file."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


@lru_cache(maxsize=4)
def merges_of(data: bytes) -> Merges:
    return Merges(data)


def pieces(text: Column, specials: list[str]) -> Column:
    """The pieces of a text between the special strings, in order."""
    cut = lambda part: F.regexp_extract_all(part, F.lit(PIECES), F.lit(0))
    if not specials:
        return cut(text)
    quoted = "|".join("\\Q" + s + "\\E" for s in specials)
    return F.flatten(F.transform(F.split(text, quoted), cut))


def special_count(text: Column, specials: list[str]) -> Column:
    if not specials:
        return F.lit(0)
    quoted = "|".join("\\Q" + s + "\\E" for s in specials)
    return F.size(F.split(text, quoted)) - 1


def counter(shared):
    """A function on columns of pieces: the tokens of each list.

    ``shared`` is a broadcast of the vocabulary file, whose size is fixed.
    """

    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        merges = merges_of(shared.value)
        for lists in batches:
            coded = pc.dictionary_encode(lists.flatten())
            each = np.fromiter(map(merges.count, coded.dictionary.to_pylist()), np.int64)
            total = np.zeros(len(coded) + 1, np.int64)
            if len(coded):
                np.cumsum(each[coded.indices.to_numpy()], out=total[1:])
            ends = lists.offsets.to_numpy().astype(np.int64)
            ends = ends - ends[0]
            yield pa.array(total[ends[1:]] - total[ends[:-1]])

    return count


def with_token_counts(
    docs: DataFrame, vocabulary: str, text: str = "text", out: str = "n_tokens"
) -> DataFrame:
    """``docs`` with the token count of ``text`` under the file ``vocabulary``."""
    with open(vocabulary, "rb") as file:
        data = file.read()
    specials = merges_of(data).specials
    count = counter(ship(docs.sparkSession).sparkContext.broadcast(data))
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumn(out, count(pieces(whole, specials)) + special_count(whole, specials))
