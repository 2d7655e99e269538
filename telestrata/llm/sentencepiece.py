"""SentencePiece encoding and decoding by shared-prefix Viterbi.

Texts are cut into marked words (a space becomes a mark that begins its word). A task takes the
distinct words of a stretch of texts, sorts them, and extends their forward rows by one character
at a time, all words together; a prefix that neighbours share is extended once (``Rows``). Words
that are very long, or have characters that occur in pieces only, are walked one by one, like a trie, depth
first: the forward row of a word is kept up to the prefix that it shares with the next one. What
was found for those that come again is remembered, up to a bounded number of characters, and
dropped when the task ends.

The model files here are of the merging kind: a piece's score is its merge order, and the
segmentation is the one that merges lead to. It still is a path problem. A segmentation is
that result exactly if every two neighbours are the result for their own concatenation, and
each prefix has exactly one last piece that continues such a path. So the forward row holds
for each prefix its best last piece: the candidates are the vocabulary's suffixes of the prefix
(bytes where a character is unknown), and the cost of a step is 0 if it fits the piece
before it and infinite otherwise. Backtracking gives the pieces. For models with
log-probabilities as scores (unigram) the row holds the best sum of scores instead.

Defined cases: a null text counts as empty; an empty text has no pieces. Decoding gives the
text back exactly, also where it has marks, tabs or unknown characters, except that a mark
character itself comes back as a space. Rows don't influence each other's pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telestrata.llm.common import fresh, ship, slices, stretches

MARK = "▁"
NORMAL, BYTE, UNIGRAM, MERGES = 1, 6, 1, 2  # fixed values of the model format
MEMO = 150_000  # pairs of pieces that a task remembers
MEMO_CHARACTERS = 2_000_000  # of the words that a task remembers
LONG = 256  # characters; longer words are walked one by one
CHUNK = 1 << 20  # bytes of text that a task handles at once; bounds its memory
CHUNK_PIECES = 600_000  # or pieces


class Lookup:
    """Whole numbers by distinct keys that aren't negative, for many keys at once."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, (4 * len(keys)).bit_length())
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, -1, np.int32)
        left, slot = np.arange(len(keys)), self._slots(keys)
        while len(left):
            free = self.keys[slot] == -1
            self.keys[slot[free]] = keys[left[free]]
            won = self.keys[slot] == keys[left]
            self.values[slot[won]] = values[left[won]]
            left, slot = left[~won], slot[~won] + 1 & self.last

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 for a key that isn't there."""
        slot = self._slots(keys)
        held, out = self.keys[slot], self.values[slot]
        other = held != keys
        out[other] = -1
        left = np.flatnonzero(other & (held != -1))
        slot = slot[left]
        while len(left):
            slot = slot + 1 & self.last
            held = self.keys[slot]
            hit = held == keys[left]
            out[left[hit]] = self.values[slot[hit]]
            go = ~hit & (held != -1)
            left, slot = left[go], slot[go]
        return out


class Rows:
    """Forward rows of many words at once, for models of the merging kind.

    Pieces that end at a character are found in a trie of the reversed pieces. Two pieces fit if no
    merge across their border comes before the merges inside them: these are undone, the latest
    first, and the two parts at the border must never have an earlier merge of their own.
    """

    def __init__(self, model: Model):
        ids, scores = model.ids, model.scores
        size = len(model.pieces) + 1  # the last one stands for characters without a piece
        ranked = sorted({-scores[i] for p, i in ids.items() if len(p) > 1})
        rank = {score: n for n, score in enumerate(ranked, 1)}
        # Single characters come before all merges.
        self.rank = np.zeros(size, np.int32)
        self.left, self.right = np.arange(size, dtype=np.int32), np.arange(size, dtype=np.int32)
        self.length = np.ones(size, np.int32)
        self.size, self.longest = size, model.longest
        self.byte_ids, self.unknown = model.byte_ids, model.unknown
        merges: dict[int, int] = {}
        steps: dict[int, int] = {}  # by node and character
        ends: dict[int, int] = {}
        for piece, i in ids.items():
            if len(piece) > 1:
                parts = [ids.get(p) for p in model.merged(piece, whole=False)]
                for at in range(1, len(piece)):
                    a, b = ids.get(piece[:at]), ids.get(piece[at:])
                    if a is not None and b is not None:
                        merges[a * size + b] = rank[-scores[i]]
                if len(parts) != 2 or None in parts:
                    continue  # no merges lead to this piece
                self.rank[i], self.length[i] = rank[-scores[i]], len(piece)
                self.left[i], self.right[i] = parts
            node = 0
            for c in reversed(piece):
                node = steps.setdefault(node << 21 | ord(c), len(steps) + 1)
            ends[node] = i
        self.letters = sorted(p for p in ids if len(p) == 1)
        self.points = np.array([ord(c) for c in self.letters], np.uint32)
        taken, leads = np.fromiter(steps, np.int64), np.fromiter(steps.values(), np.int32)
        del steps  # every task builds these tables
        points = taken & (1 << 21) - 1
        known = np.isin(points, self.points)
        self.strange = np.unique(points[~known]).astype(np.uint32)
        keys = (taken[known] >> 21) * size + np.searchsorted(self.points, points[known])
        self.steps = Lookup(keys, leads[known])
        self.merges = Lookup(np.fromiter(merges, np.int64), np.fromiter(merges.values(), np.int32))
        self.ends = np.full(len(taken) + 1, -1, np.int32)
        self.ends[list(ends)] = list(ends.values())
        self.single = np.array([*(ids[c] for c in self.letters), size - 1], np.int32)

    def fit(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether merging ``left + right`` gives just these two pieces, pair by pair."""
        out = np.zeros(len(left), bool)
        at, before = np.arange(len(left)), np.full(len(left), np.iinfo(np.int32).max, np.int32)
        while len(at):
            across = self.merges.find(left.astype(np.int64) * self.size + right)
            a, b = self.rank[left], self.rank[right]
            fine = (across == -1) | (across >= before)
            done = (a == 0) & (b == 0)
            out[at[fine & done]] = True
            go = fine & ~done
            at, left, right, a, b = at[go], left[go], right[go], a[go], b[go]
            # Of equal ranks the left one is merged first, so the right one is undone first.
            undo = a > b
            before = np.where(undo, a, b + 1)
            left, right = np.where(undo, self.right[left], left), np.where(undo, right, self.left[right])
        return out

    def suits(self, points: np.ndarray) -> np.ndarray:
        """Whether each character has a piece of its own, or else is part of none."""
        return ~np.isin(points, self.strange)

    def encode(self, points: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Identifiers of all words one after the other, and how many each word has.

        ``points`` are the characters of distinct words in order, ``sizes`` their lengths, from 1.
        """
        code = np.searchsorted(self.points, points).astype(np.int64)
        code[np.append(self.points, 0)[code] != points] = len(self.points)
        begins = np.cumsum(sizes) - sizes
        row = np.zeros(len(points), np.int32)  # the last piece of each prefix
        alike = np.ones(len(sizes), bool)  # with the word before, so far
        alike[:1] = False
        active = np.arange(len(sizes))
        for depth in range(int(sizes.max(initial=0))):
            active = active[sizes[active] > depth]
            place = begins[active] + depth
            before = active - 1
            same = alike[active] & (sizes[before] > depth) & (code[place] == code[begins[before] + np.minimum(depth, sizes[before] - 1)])
            alike[active] = same
            row[place] = self._last(code, row, begins[active[~same]], depth)[np.cumsum(~same) - 1]
        return self._back(points, row, begins, sizes)

    def _last(self, code: np.ndarray, row: np.ndarray, begins: np.ndarray, depth: int) -> np.ndarray:
        """The last piece of the prefixes of ``depth + 1`` characters of some words."""
        place = begins + depth
        out = self.single[code[place]]
        which, node = np.arange(len(begins)), self.steps.find(code[place]).astype(np.int64)
        which, node = which[node >= 0], node[node >= 0]
        ends, pieces, lefts = [], [], []
        for length in range(2, min(depth + 1, self.longest) + 1):
            node = self.steps.find(node.astype(np.int64) * self.size + code[place[which] - length + 1])
            which, node = which[node >= 0], node[node >= 0]
            piece = self.ends[node]
            there, piece = which[piece >= 0], piece[piece >= 0]
            if length == depth + 1:
                out[there] = piece  # the whole prefix; then no other piece fits
            else:
                ends.append(there)
                pieces.append(piece)
                lefts.append(row[place[there] - length])
        if ends:
            end, piece = np.concatenate(ends), np.concatenate(pieces)
            fits = self.fit(np.concatenate(lefts), piece)
            out[end[fits]] = piece[fits]
        return out

    def _back(
        self, points: np.ndarray, row: np.ndarray, begins: np.ndarray, sizes: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """The pieces that the last pieces of the prefixes lead to."""
        counts = np.zeros(len(sizes), np.int64)
        active, end, turns = np.arange(len(sizes)), begins + sizes - 1, []
        while len(active):
            turns.append((active, end))
            counts[active] += 1
            end = end - self.length[row[end]]
            go = end >= begins[active]
            active, end = active[go], end[go]
        place, last = np.empty(int(counts.sum()), np.int64), np.cumsum(counts) - 1
        for turn, (words, end) in enumerate(turns):
            place[last[words] - turn] = end
        out = row[place]
        odd = np.flatnonzero(out == self.size - 1)
        if not len(odd):
            return out, counts
        # Characters without a piece are spelled in bytes.
        kinds, which = np.unique(points[place[odd]], return_inverse=True)
        spelled = [
            [self.byte_ids[b] for b in chr(c).encode()] if self.byte_ids else [self.unknown] for c in kinds.tolist()
        ]
        each = np.ones(len(out), np.int64)
        each[odd] = np.array([len(x) for x in spelled])[which]
        first = _begins(each)[odd]
        out = np.repeat(out, each)
        for n in range(max(map(len, spelled))):
            there = each[odd] > n
            nth = np.array([x[n] if len(x) > n else 0 for x in spelled], np.int32)
            out[first[there] + n] = nth[which[there]]
        total = np.concatenate([[0], np.cumsum(each)])
        return out, total[last + 1] - total[last + 1 - counts]


class Model:
    """Pieces and scores of a model file, and the segmentation of words."""

    def __init__(self, data: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(data)
        self.kind = proto.trainer_spec.model_type
        self.pieces = [p.piece for p in proto.pieces]
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.scores = [p.score for p in proto.pieces]
        self.byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.bytes_of = {i: b for b, i in self.byte_ids.items()}
        self.unknown = next((i for i, p in enumerate(proto.pieces) if p.type == 2), 0)
        self.longest = max(map(len, self.ids), default=1)
        # The lengths of pieces that end in each two characters, the longest first.
        lengths: dict[str, set[int]] = {}
        for piece in self.ids:
            if len(piece) > 1:
                lengths.setdefault(piece[-2:], set()).add(len(piece))
        self.lengths = {end: sorted(found, reverse=True) for end, found in lengths.items()}
        self.rows = Rows(self) if self.kind == MERGES and self.ids else None
        self.fits: dict[tuple[str, str], bool] = {}
        self.known: dict[str, list[int]] = {}
        self.known_characters = 0
        out = [bytes([self.bytes_of[i]]) if i in self.bytes_of else p.encode() for i, p in enumerate(self.pieces)]
        self.octets = pa.array([b.replace(MARK.encode(), b" ") for b in out], pa.binary())

    def forget(self) -> None:
        """Drop what was remembered, so that a reused worker doesn't keep it."""
        self.fits.clear()
        self.known.clear()
        self.known_characters = 0

    # Segmentation

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Identifiers of each of the words, which are distinct."""
        known = self.known
        new = sorted(w for w in words if w not in known)
        found = dict(zip(new, self.encode_sorted(new)))
        out = [known[w] if w in known else found[w] for w in words]
        # The words that come first are the frequent ones, so they stay.
        for word in new:
            if self.known_characters > MEMO_CHARACTERS:
                break
            known[word] = found[word]
            self.known_characters += len(word)
        return out

    def encode_sorted(self, words: list[str]) -> list[list[int]]:
        """Identifiers of each of the words, which are distinct and sorted."""
        out, before = [], ""
        # Per prefix length: where its last piece begins, and the path's score.
        begins: list[int] = [0]
        scores: list[float] = [0.0]
        for word in words:
            shared = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                shared += 1
            del begins[shared + 1 :], scores[shared + 1 :]
            self._extend(word, shared + 1, begins, scores)
            out.append(self._backtrack(word, begins))
            before = word
        return out

    def _extend(self, word: str, first: int, begins: list[int], scores: list[float]) -> None:
        """Add the forward entries of the prefixes from length ``first`` on."""
        ids, lengths, fits = self.ids, self.lengths, self.fits
        if self.kind == UNIGRAM:
            for end in range(first, len(word) + 1):
                best, start = -np.inf, end - 1
                for at in range(max(0, end - self.longest), end):
                    found = ids.get(word[at:end])
                    score = scores[at] + (self.scores[found] if found is not None else -1e4)
                    if (found is not None or at == end - 1) and score > best:
                        best, start = score, at
                begins.append(start)
                scores.append(best)
            return
        for end in range(first, len(word) + 1):
            # At most one start fits; the single character fits if no longer piece does.
            start = end - 1
            for length in lengths.get(word[end - 2 : end], ()) if end > 1 else ():
                at = end - length
                if at < 0:
                    continue
                piece = word[at:end]
                if piece in ids:
                    if at == 0:
                        start = at
                        break
                    left = word[begins[at] : at]
                    fit = fits.get((left, piece))
                    if self._fit(left, piece) if fit is None else fit:
                        start = at
                        break
            begins.append(start)
        scores.extend([0.0] * (len(begins) - len(scores)))

    def _fit(self, left: str, right: str) -> bool:
        """Whether merging ``left + right`` gives just these two pieces."""
        key = (left, right)
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) >= MEMO:
                for old in list(self.fits)[: MEMO // 2]:
                    del self.fits[old]
            known = self.fits[key] = self.merged(left + right) == [left, right]
        return known

    def merged(self, text: str, whole: bool = True) -> list[str]:
        """The pieces that merging by score, then position, leads to; not to ``text`` unless ``whole``."""
        ids, scores, part = self.ids, self.scores, list(text)
        n = len(part)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def pair(i: int, j: int):
            found = ids.get(part[i] + part[j])
            if not whole and len(part[i]) + len(part[j]) == n:
                found = None
            return None if found is None else (-scores[found], i, part[i], part[j])

        heap = [p for i in range(n - 1) if (p := pair(i, i + 1))]
        heapify(heap)
        while heap:
            _, i, left, right = heappop(heap)
            j = after[i]
            if part[i] != left or j >= n or part[j] != right:
                continue
            part[i], part[j] = left + right, ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if p := pair(i, k):
                    heappush(heap, p)
            if before[i] >= 0 and (p := pair(before[i], i)):
                heappush(heap, p)
        return [p for p in part if p]

    def _backtrack(self, word: str, begins: list[int]) -> list[int]:
        out, end, ids = [], len(word), self.ids
        while end > 0:
            start = begins[end]
            piece = word[start:end]
            found = ids.get(piece)
            if found is not None:
                out.append(found)
            elif self.byte_ids:
                out += [self.byte_ids[b] for b in reversed(piece.encode())]
            else:
                out.append(self.unknown)
            end = start
        out.reverse()
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of a sequence of identifiers."""
        parts = bytearray()
        for i in ids:
            if i in self.bytes_of:
                parts.append(self.bytes_of[i])
            else:
                parts += self.pieces[i].encode()
        text = parts.decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if text[:1] == " " else text


@lru_cache(maxsize=1)
def model_of(data: bytes) -> Model:
    return Model(data)


def marked(texts: pa.Array) -> pa.Array:
    """Texts with marks for spaces and one in front; null and empty ones are empty."""
    texts = pc.fill_null(texts, "")
    spaced = pc.replace_substring(texts, " ", MARK)
    front = pc.if_else(pc.equal(texts, ""), "", MARK)
    return pc.binary_join_element_wise(front, spaced, "")


def marked_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all marked texts, each with the marks before it, and how many each text has."""
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    octets = np.frombuffer(data or b"", np.uint8)[at[0] : at[-1]]
    at = at - at[0]
    # The three bytes of a mark; inside another character they can't begin so.
    first, second, third = MARK.encode()
    mark = np.zeros(len(octets) + 2, bool)
    mark[:-4] = (octets[:-2] == first) & (octets[1:-1] == second) & (octets[2:] == third) if len(octets) > 2 else False
    starts = mark[:-2].copy()
    after = mark[:-2]  # a mark right before ends three bytes later
    starts[3:] &= ~after[:-3]
    begins = np.zeros(len(octets) + 1, bool)
    begins[at] = True
    starts |= begins[:-1]
    places = np.flatnonzero(starts)
    ends = np.concatenate([places, [len(octets)]]).astype(np.int32)
    words = pa.StringArray.from_buffers(len(places), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(octets)))
    return words, np.diff(np.searchsorted(places, at))


def _stretches(texts: pa.Array) -> Iterator[pa.Array]:
    return stretches(texts, CHUNK)


def _segmented(model: Model, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Identifiers of distinct words, and where those of each word begin and how many they are."""
    lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    sizes, starts = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    together = np.zeros(len(words), bool)
    flat = np.empty(0, np.int32)
    if model.rows:
        order = pc.sort_indices(words).to_numpy().astype(np.int64)
        order = order[lengths[order] <= LONG]
        points = _points(words.take(order))
        strange = np.repeat(np.arange(len(order)), lengths[order])[~model.rows.suits(points)]
        suits = np.bincount(strange, minlength=len(order)) == 0
        points = points[np.repeat(suits, lengths[order])]
        order = order[suits]
        flat, sizes[order] = model.rows.encode(points, lengths[order])
        starts[order] = _begins(sizes[order])
        together[order] = True
    alone = np.flatnonzero(~together)
    found = model.encode_words(words.take(alone).to_pylist())
    sizes[alone] = np.fromiter(map(len, found), np.int64, len(found))
    starts[alone] = len(flat) + _begins(sizes[alone])
    return np.concatenate([flat, np.fromiter(chain.from_iterable(found), np.int32)]), starts, sizes


def _begins(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes) - sizes


def _points(words: pa.Array) -> np.ndarray:
    """The characters of all words, one after the other."""
    joined = pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), "")[0].as_py()
    return np.frombuffer(joined.encode("utf-32-le"), np.uint32)


def _encoded(model: Model, texts: pa.Array) -> pa.ListArray:
    """Identifiers of each text; every distinct word is segmented once."""
    words, per_text = marked_words(marked(texts))
    coded = words.dictionary_encode()
    flat, starts, sizes = _segmented(model, coded.dictionary)
    which = coded.indices.to_numpy()
    each = sizes[which]
    total = np.concatenate([[0], np.cumsum(each)]).astype(np.int64)
    # The place of every output: the start of its word plus its place in the word.
    place = np.repeat(starts[which] - total[:-1], each) + np.arange(total[-1], dtype=np.int64)
    ends = total[np.concatenate([[0], np.cumsum(per_text)])]
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat[place], pa.int32()))


def _decoded(model: Model, lists: pa.ListArray) -> pa.Array:
    """The bytes of each list of identifiers, without the space of the first mark."""
    first, last = lists.offsets[0].as_py(), lists.offsets[-1].as_py()
    octets = model.octets.take(lists.values.slice(first, last - first))
    offsets = pc.subtract(lists.offsets, lists.offsets[0])
    joined = pc.binary_join(pa.ListArray.from_arrays(offsets, octets), b"")
    return pc.if_else(pc.starts_with(joined, " "), pc.binary_replace_slice(joined, 0, 1, b""), joined)


def encoder(shared):
    """A function on texts: the identifiers of each."""

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = model_of(shared.value)
        try:
            for texts in batches:
                for part in _stretches(texts):
                    yield _encoded(model, part)
        finally:
            model.forget()

    return encode


def decoder(shared):
    """A function on columns of identifiers: the text of each row."""

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = model_of(shared.value)
        for lists in batches:
            out: list[str | None] = []
            for a, b in slices(np.diff(lists.offsets.to_numpy()), CHUNK_PIECES):
                part = lists.slice(a, b - a)
                texts = _decoded(model, part).to_pylist()
                gone = part.is_null().to_pylist()
                out += [None if n else t.decode("utf-8", "replace") for t, n in zip(texts, gone)]
            yield pa.array(out, pa.string())

    return decode


CODED = "struct<pieces:array<int>,round_trip:boolean>"


def coder(shared):
    """A function on texts: their identifiers, and whether decoding them gives the text back."""

    @F.arrow_udf(CODED)
    def code(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = model_of(shared.value)
        try:
            for texts in batches:
                for part in _stretches(texts):
                    pieces = _encoded(model, part)
                    plain = pc.replace_substring(pc.fill_null(part, ""), MARK, " ")
                    same = pc.equal(_decoded(model, pieces), plain.cast(pa.binary()))
                    yield pa.StructArray.from_arrays([pieces, same], ["pieces", "round_trip"])
        finally:
            model.forget()

    return code


def _shared(docs: DataFrame, model: str):
    """The model file, broadcast; its size is fixed."""
    with open(model, "rb") as file:
        return ship(docs.sparkSession).sparkContext.broadcast(file.read())


def with_pieces(docs: DataFrame, model: str, text: str = "text", out: str = "pieces") -> DataFrame:
    """``docs`` with the identifiers of ``text`` under the file ``model``."""
    return docs.withColumn(out, encoder(_shared(docs, model))(F.col(text)))


def with_text(docs: DataFrame, model: str, pieces: str = "pieces", out: str = "decoded") -> DataFrame:
    """``docs`` with the text of the identifiers in ``pieces``."""
    return docs.withColumn(out, decoder(_shared(docs, model))(F.col(pieces)))


def encoded(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """``docs`` with ``pieces``, their number, and whether decoding them gives the text back.

    Where ``docs`` has such a column, the new one's name gets an underscore.
    """
    pieces, number, back, both = (fresh(c, docs) for c in ("pieces", "n_pieces", "round_trip", "coded"))
    coded = docs.withColumn(both, coder(_shared(docs, model))(F.col(text)))
    return coded.select(
        *docs.columns,
        F.col(f"{both}.pieces").alias(pieces),
        F.size(f"{both}.pieces").cast("long").alias(number),
        F.col(f"{both}.round_trip").alias(back),
    )
