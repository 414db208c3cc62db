"""Benchmark decontamination by latent semantic retrieval.

1. Words of all documents are counted in ``DIMENSIONS`` hash buckets; rare buckets weigh more, the most frequent nothing.
2. A randomised singular value decomposition of TF-IDF passages gives the latent space: the tasks multiply their passages
   with a random matrix and back, and of the small summed product the driver gets directions and strengths by Nystrom's
   approximation.  It is fitted, in one pass, on the passages of all documents and on all benchmark items.
3. Items are put into length classes, and every document is read in overlapping windows of each class's length.  Windows
   with hardly a word of the class's items are left out: the share of their TF-IDF length in such words bounds their
   cosine.  The others are projected and compared with the items of the class by cosine.
4. Behind that stands an exact path over neighbouring words: of an item's n words at least ``LCS`` n, so all but k, must
   recur.  A gap in the item's text, whatever stands there instead, parts one run of its words in two, so of its n - 1 word
   pairs T = n - 2 k - 1 at least recur, hence one of the n - T rarest; of items up to ``BRIEF`` words any counts.  Each
   recurrence of such a pair is a candidate.  So no copy with up to k words dropped or replaced is missed; an addition
   elsewhere counts as half a word.
5. Candidates are checked by the longest common subsequence of item and surroundings: a document is contaminated by an
   item if the subsequence covers ``LCS`` of the item, or ``LCS_ANSWER`` of it when the surroundings also hold the item's
   answer, its last sentence or last quarter, nearly whole.

Items are taken in blocks of about ``BLOCK``, each against all documents, so what a task holds is bounded.

Defined cases: null or empty texts and items match nothing, an item without words neither; an item of one word is in every
document with that word; a match found by its word pairs alone may have any cosine; repeated documents and items each give
their rows; extra columns are ignored by the search.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import fixed, words

DIMENSIONS, RANK, EXTRA = 1 << 14, 96, 8
#: Passages multiplied at once in the fit: few, so that the words they do not share take little room.
FIT_PASSAGES = 32
#: Words of the passages of the fit, and of the shortest windows; windows double from class to class.
WINDOW, SHORTEST = 40, 4
COSINE = 0.5
#: Least share of a window's squared TF-IDF length in words of the items; the cosine with an item is at most its root.
KNOWN = 0.25
LCS, LCS_ANSWER, ANSWER = 0.7, 0.55, 0.8
BRIEF, BLOCK = 8, 2000
#: Buckets that hold more than this share of all words weigh nothing.
FREQUENT = 1 / 400
_PIECES = 256
_PAIR = np.uint64(0xC2B2AE3D27D4EB4F)
#: Bits of a word pair's hash that are looked up before the hash itself.
_SIEVE = 20


def tokens(text: str | None) -> np.ndarray:
    """Word hashes of one text."""
    out = [b.words for b in words.word_blocks(pa.array([text or ""]), parted=True)]
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(50)).astype(np.int64)


def _weights(texts: DataFrame) -> np.ndarray:
    """Weight of each bucket from its share of the words of all documents."""

    def count(batch: pa.RecordBatch, held: np.ndarray) -> None:
        for block in words.word_blocks(batch.column(0), parted=True):
            held[:DIMENSIONS] += np.bincount(_bucket(block.words), minlength=DIMENSIONS)
            held[DIMENSIONS] += len(block.bounds) - 1

    counts = fixed.summed(texts, DIMENSIONS + 1, count)
    total = max(1, int(counts[:DIMENSIONS].sum()))
    weight = np.log((total + DIMENSIONS) / (counts[:DIMENSIONS] + 1.0))
    weight[counts[:DIMENSIONS] > max(FREQUENT * total, 50)] = 0
    return weight.astype(np.float32), int(counts[DIMENSIONS])


def _passages(hashes: np.ndarray, bounds: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets, weights and starts of consecutive passages, each of unit length."""
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    passage = np.cumsum(np.concatenate([[0], (np.diff(row) != 0) | ((np.arange(1, len(row)) - bounds[row[1:]]) % WINDOW == 0)])) if len(row) else row
    at = _bucket(hashes)
    value = weight[at]
    keep = value > 0
    at, value, passage = at[keep], value[keep], passage[keep]
    if not len(at):
        return at, value, np.zeros(0, np.int64)
    starts = np.flatnonzero(np.concatenate([[True], passage[1:] != passage[:-1]]))
    norm = np.sqrt(np.add.reduceat(value * value, starts))
    return at, value / np.repeat(norm, np.diff(np.append(starts, len(at)))), starts


def _times(at: np.ndarray, value: np.ndarray, starts: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Passages times a matrix."""
    return np.add.reduceat(matrix[at] * value[:, None], starts, axis=0)


_start = words.Local()


def _random(size: int) -> np.ndarray:
    """The random matrix of the decomposition, made in each process rather than sent."""
    if size not in _start:
        _start[size] = np.random.default_rng(7).standard_normal((DIMENSIONS, size)).astype(np.float32)
    return _start[size]


def latent_space(texts: DataFrame, items: Iterable[str], weight: np.ndarray) -> np.ndarray:
    """What a word of each bucket adds to a passage: directions scaled to equal strength and weighted, DIMENSIONS by RANK."""
    size = RANK + EXTRA

    def rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
        for block in words.word_blocks(batch.column(0), parted=True):
            for lo in range(0, len(block.bounds) - 1, 256):
                bounds = block.bounds[lo : lo + 257]
                own = block.words[bounds[0] : bounds[-1]]
                found = _passages(own, bounds - bounds[0], weight)
                if len(found[2]):
                    yield found

    def back(batch: pa.RecordBatch, held: np.ndarray) -> None:
        product, start = np.zeros((DIMENSIONS, size), np.float32), _random(size)
        for at, value, starts in rows_of(batch):
            ends = np.append(starts, len(at))
            for lo in range(0, len(starts), FIT_PASSAGES):
                cut = ends[lo : lo + FIT_PASSAGES + 1]
                used, name = np.unique(at[cut[0] : cut[-1]], return_inverse=True)
                owner = np.repeat(np.arange(len(cut) - 1), np.diff(cut))
                passages = np.bincount(owner * len(used) + name, value[cut[0] : cut[-1]], (len(cut) - 1) * len(used))
                passages = passages.astype(np.float32).reshape(len(cut) - 1, len(used))
                product[used] += passages.T @ (passages @ start[used])
        held[: DIMENSIONS * size] += product.ravel()

    # the items are passages too, with the weight of many
    def batches() -> Iterator[pa.RecordBatch]:
        for some in itertools.batched(items, BLOCK):
            yield pa.record_batch([pa.array(some, pa.string())], ["text"])

    share = np.zeros(DIMENSIONS * size)
    for own in batches():
        back(own, share)
    # each task sends a matrix of a fixed size, so there are as many as the cores keep busy, however many the splits
    product = fixed.summed(texts.coalesce(2 * texts.sparkSession.sparkContext.defaultParallelism), DIMENSIONS * size, back, np.float64)
    scale = math.sqrt((np.abs(product).sum() + 1) / (np.abs(share).sum() + 1))
    product = (product + scale * share).reshape(DIMENSIONS, size)
    # Nystrom: the passages' Gram matrix from its product with the random matrix alone, shifted so that it can be inverted
    start = _random(size).astype(np.float64)
    shift = 1e-6 * np.linalg.norm(product) + 1e-12
    product += shift * start
    core = start.T @ product
    found, vectors = np.linalg.eigh((core + core.T) / 2)
    basis, values, _ = np.linalg.svd(product @ (vectors / np.sqrt(np.maximum(found, found[-1] * 1e-12))), full_matrices=False)
    basis, values = basis[:, :RANK], np.maximum(values[:RANK] ** 2 - shift, 0)
    strength = np.sqrt(np.maximum(values, values[0] * 1e-6 + 1e-12))
    space = weight[:, None] * (basis / strength)
    return (space / (np.abs(space).max() + 1e-12) * 256).astype(np.float16)


def lcs_length(positions: dict[int, int], size: int, text: list[int]) -> int:
    """Longest common subsequence by bit vectors: ``positions`` has, for each word of an item of ``size`` words, its places."""
    full = (1 << size) - 1
    state = full
    for word in text:
        match = positions.get(word)
        if match is not None:
            hit = state & match
            state = ((state + hit) | (state - hit)) & full
    return size - state.bit_count()


def _answer(text: str) -> np.ndarray:
    """Words of the last sentence, or of the last quarter of an item of one sentence."""
    parts = [p for p in re.split(r"[.?!]\s+|\n", text) if len(tokens(p)) >= 2]
    if len(parts) > 1:
        return tokens(parts[-1])
    own = tokens(text)
    return own[-max(2, len(own) // 4) :]


def window_of(size: int) -> int:
    """Window length of the class of items of ``size`` words: within a factor of root two, but for the shortest."""
    return SHORTEST << max(0, round(math.log2(size / SHORTEST)))


def _pairs(own: np.ndarray) -> np.ndarray:
    """Hashes of neighbouring words."""
    return words.mix(own[:-1] * _PAIR + own[1:])


def _telling(own: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Places of the rarest word pairs of an item, of which every copy has one."""
    n = len(own)
    lost = n - math.ceil(LCS * n - 1e-9)
    must = 1 if n <= BRIEF else max(1, n - 2 * lost - 1)
    rarity = weight[_bucket(own)]
    return np.argsort(-(rarity[:-1] + rarity[1:]), kind="stable")[: n - must]


class Items:
    """A block of items, prepared for the tasks."""

    def __init__(self, rows: list[tuple], weight: np.ndarray, space: np.ndarray):
        rows = [(i, t, tokens(t)) for i, t in rows]
        rows = [r for r in rows if len(r[2])]
        self.ids = [r[0] for r in rows]
        self.sizes = [len(r[2]) for r in rows]
        self.places = []
        for _, _, own in rows:
            held: dict[int, int] = {}
            for i, w in enumerate(own.tolist()):
                held[w] = held.get(w, 0) | (1 << i)
            self.places.append(held)
        self.answers = [set(_answer(t).tolist()) for _, t, _ in rows]
        every = np.unique(np.concatenate([own for _, _, own in rows])) if rows else np.zeros(0, np.uint64)
        self.words = every
        self.names = [np.unique(np.searchsorted(every, own)) for _, _, own in rows]
        vectors = [space[_bucket(own)].astype(np.float32).sum(0) for _, _, own in rows]
        vectors = np.array(vectors, np.float32).reshape(len(rows), space.shape[1])
        self.vectors = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
        #: Window length, item numbers and known words of each class.
        self.classes = []
        windows = np.array([window_of(n) for n in self.sizes], np.int64)
        for window in np.unique(windows):
            members = np.flatnonzero(windows == window)
            known = np.zeros(len(every) + 1, bool)
            for j in members:
                known[self.names[j]] = True
            self.classes.append((int(window), members, known))
        # word pairs, ascending, with the item and the place in it; an item of one word is told by the word
        found = [(_pairs(own)[at], j, at) for j, (_, _, own) in enumerate(rows) if len(own) > 1 for at in [_telling(own, weight)]]
        single = [(own, j, np.zeros(1, np.int64)) for j, (_, _, own) in enumerate(rows) if len(own) == 1]
        self.grams = [(width, *self._index(part)) for width, part in ((2, found), (1, single)) if part]

    @staticmethod
    def _index(part: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        key = np.concatenate([k for k, _, _ in part])
        order = np.argsort(key, kind="stable")
        sieve = np.zeros(1 << _SIEVE, bool)
        sieve[(key >> np.uint64(64 - _SIEVE)).astype(np.int64)] = True
        return sieve, key[order], np.repeat([j for _, j, _ in part], [len(k) for k, _, _ in part])[order], np.concatenate([at for _, _, at in part])[order]

    def recurrences(self, own: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Row, item number and where the item would begin, for recurring words and pairs; beginnings near each other once."""
        sizes = np.array(self.sizes, np.int64)
        for width, sieve, key, item, offset in self.grams:
            if len(own) < width:
                continue
            hashes = own if width == 1 else _pairs(own)
            at = np.flatnonzero(sieve[(hashes >> np.uint64(64 - _SIEVE)).astype(np.int64)])
            low, high = np.searchsorted(key, hashes[at], "left"), np.searchsorted(key, hashes[at], "right")
            row = np.searchsorted(bounds, at, "right") - 1
            whole = (high > low) & (at + width <= bounds[row + 1])
            at, low, many, row = at[whole], low[whole], (high - low)[whole], row[whole]
            if not len(at):
                continue
            which = np.repeat(low, many) + np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
            j = item[which]
            step = np.maximum(1, sizes[j] // 2)
            start = np.repeat(at, many) - offset[which]
            held = np.unique(np.stack([np.repeat(row, many), j, start // step]), axis=1)
            yield held[0], held[1], held[2] * np.maximum(1, sizes[held[1]] // 2)


def _matches(items: Items, space: np.ndarray, weight: np.ndarray, own: np.ndarray, bounds: np.ndarray) -> Iterator[tuple]:
    """Row, item number, LCS, cosine, answer share and start of the verified matches in a slice of documents."""
    if not len(own) or not len(items.words):
        return
    at = np.minimum(np.searchsorted(items.words, own), len(items.words) - 1)
    name = np.where(items.words[at] == own, at, len(items.words))
    found: dict[tuple[int, int], tuple] = {}

    def verify(r: int, j: int, first: int, last: int, cosine: float, begin: int) -> None:
        size, names = items.sizes[j], items.names[j]
        here = name[first:last]
        held = names[np.minimum(np.searchsorted(names, here), len(names) - 1)] == here
        if held.sum() < LCS_ANSWER * size:
            return
        shared = lcs_length(items.places[j], size, own[first:last][held].tolist())
        if shared < LCS_ANSWER * size:
            return
        answer = items.answers[j]
        share = len(answer.intersection(own[first:last].tolist())) / len(answer) if answer else 0.0
        if shared >= LCS * size or share >= ANSWER:
            if cosine is None:
                vector = space[_bucket(own[begin : begin + size])].sum(0)
                cosine = float(vector @ items.vectors[j] / max(np.linalg.norm(vector), 1e-9))
            best = found.get((r, j), (0, -1.0, 0.0, 0))
            found[r, j] = (max(shared, best[0]), *((cosine, max(share, best[2]), begin - int(bounds[r])) if cosine > best[1] else (best[1], max(share, best[2]), best[3])))

    for rows, numbers, starts in items.recurrences(own, bounds):
        size = np.array(items.sizes)[numbers]
        firsts = np.maximum(starts - size // 2, bounds[rows])
        lasts = np.minimum(starts + np.maximum(1, size // 2) + size + size // 2, bounds[rows + 1])
        begins = np.maximum(starts, bounds[rows])
        for r, j, first, last, begin in zip(rows.tolist(), numbers.tolist(), firsts.tolist(), lasts.tolist(), begins.tolist(), strict=True):
            if last - first >= LCS_ANSWER * items.sizes[j] and ((r, j) not in found or found[r, j][0] < items.sizes[j]):
                verify(r, j, first, last, None, begin)
    for window, members, known in items.classes:
        for r, j, cosine, first, last, begin in _near(items, space, weight, own, bounds, name, window, members, known):
            if (r, j) not in found or found[r, j][1] < cosine:
                verify(r, j, first, last, cosine, begin)
    for (r, j), rest in found.items():
        yield r, j, *rest


def _near(
    items: Items, space: np.ndarray, weight: np.ndarray, own: np.ndarray, bounds: np.ndarray, name: np.ndarray, window: int, members: np.ndarray, known: np.ndarray
) -> Iterator[tuple]:
    """Row, item number, cosine, surroundings and start of the windows near an item of a length class."""
    stride = window // 2
    heavy = weight[_bucket(own)]
    mass = heavy.astype(np.float64) ** 2
    total = np.concatenate([[0], np.cumsum(mass)])
    sums = np.concatenate([[0], np.cumsum(mass * known[name])])
    # a window is one or two halves, each of which is in two windows but projected once
    halves = -(-np.diff(bounds) // stride)
    row = np.repeat(np.arange(len(halves)), halves)
    cut = bounds[row] + stride * (np.arange(len(row)) - np.repeat(np.cumsum(halves) - halves, halves))
    stop = np.minimum(cut + stride, bounds[row + 1])
    more = np.append(row[1:] == row[:-1], False)
    end = np.where(more, np.append(stop[1:], 0), stop)
    here = sums[end] - sums[cut]
    first = np.append(True, ~more[:-1])
    chosen = np.flatnonzero((here > 0) & (here >= KNOWN * (total[end] - total[cut])) & (more | first))
    directions = items.vectors[members].T
    for lo in range(0, len(chosen), 4096):
        some = chosen[lo : lo + 4096]
        used = np.union1d(some, some[more[some]] + 1)
        size = stop[used] - cut[used]
        place = np.repeat(cut[used], size) + np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        kept = np.flatnonzero(heavy[place] > 0)
        owner = np.repeat(np.arange(len(used)), size)[kept]
        starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.zeros(0, np.int64)
        if not len(starts):
            continue
        parts = np.zeros((len(used), space.shape[1]), np.float32)
        parts[owner[starts]] = np.add.reduceat(space[_bucket(own[place[kept]])], starts, axis=0)
        at = np.searchsorted(used, some)
        vectors = parts[at]
        two = np.flatnonzero(more[some])
        vectors[two] += parts[at[two] + 1]
        norms = np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
        cosine = vectors @ directions
        for i, m in zip(*np.nonzero(cosine >= COSINE * norms), strict=True):
            w, j = int(some[i]), int(members[m])
            r, size = int(row[w]), items.sizes[j]
            yield r, j, float(cosine[i, m] / norms[i, 0]), max(int(cut[w]) - size, int(bounds[r])), min(int(end[w]) + size, int(bounds[r + 1])), int(cut[w])


def _search(items: Items, space: np.ndarray, weight: np.ndarray, kinds: tuple[pa.DataType, pa.DataType]):
    names = ["doc_id", "item_id", "item_words", "lcs_words", "lcs_share", "answer_share", "cosine", "word_at"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide = space.astype(np.float32)
        for batch in batches:
            out = []
            for block in words.word_blocks(batch.column(1), parted=True):
                for lo in range(0, len(block.bounds) - 1, _PIECES):
                    bounds = block.bounds[lo : lo + _PIECES + 1]
                    own = block.words[bounds[0] : bounds[-1]]
                    for r, j, shared, cosine, share, at in _matches(items, wide, weight, own, bounds - bounds[0]):
                        size = items.sizes[j]
                        out.append((batch.column(0)[block.first + lo + r].as_py(), items.ids[j], size, shared, shared / size, share, cosine, at))
            if out:
                columns = list(zip(*out, strict=True))
                types = [*kinds, pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return work


def find(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row for each document and item that it contains, whole or paraphrased."""
    texts = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    weight, _ = _weights(texts)
    asked = benchmark.select(F.col(item).alias("item_id"), F.col(item_text).alias("text")).where("text is not null")
    count = asked.count()
    blocks = max(1, -(-count // BLOCK))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    held: dict[int, list] = {}

    def block(number: int) -> list[tuple]:
        if number not in held:
            held.clear()
            held[number] = [(r["item_id"], r["text"]) for r in asked.where(part == number).collect()]
        return held[number]

    class Texts:
        def __iter__(self) -> Iterator[str]:
            return (t for number in range(blocks) for _, t in block(number))

    space, out = latent_space(texts, Texts(), weight), None
    for number in range(blocks):
        kinds = tuple({"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[d] for d in (dict(rows.dtypes)["doc_id"], dict(asked.dtypes)["item_id"]))
        schema = f"doc_id {dict(rows.dtypes)['doc_id']}, item_id {dict(asked.dtypes)['item_id']}, item_words bigint, lcs_words bigint, lcs_share double, answer_share double, cosine double, word_at bigint"
        found = rows.mapInArrow(_search(Items(block(number), weight, space), space, weight, kinds), schema)
        out = found if out is None else out.union(found)
    return out
