"""Token counts by rank-synchronous merging of numpy arrays.

Pre-tokens of a batch lie in one ragged array of symbol ids.  In each round every sequence finds its lowest-rank adjacent
pair (the leftmost of equals) and all sequences merge theirs at once; sequences without a mergeable pair leave.  What
remains is counted: one token per symbol of the vocabulary, one per UTF-8 byte of a character outside it (byte fallback).
This is the merge order of the library, so counts are the library's.

No piece holds a space after another character, so a text falls apart in front of each run of spaces without changing its
tokens; a line feed is in no merged piece and splits too.  Distinct pre-tokens of a task are merged once and remembered in
a bounded dictionary.  Very long pre-tokens are merged with a heap, which takes the same pairs in the same order.

Defined cases: a null text is an empty text with no tokens; special strings inside a text are ordinary characters.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words

MODEL = "piece_bpe_32k.model"
#: Distinct pre-tokens a task remembers; beyond it the memory starts anew.
MEMORY = 400_000
#: Symbols from which a pre-token is merged with a heap.
LONG = 256
_NEVER = np.int32(np.iinfo(np.int32).max)
_cut = re.compile("▁*[^▁\n]+|▁+|\n")


class Pieces:
    """Symbol ids, ranks of merged pairs and character ids of a SentencePiece BPE model."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        plain = [i for i in range(self.size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        ids = {model.id_to_piece(i): i for i in plain}
        score = {i: model.get_score(i) for i in plain}
        place = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
        inner = sorted({c for p in ids for c in p} - set(ids))
        symbols = ids | {c: self.size + n for n, c in enumerate(inner)}
        self.letters = np.full(0x110000, -1, np.int32)
        for s, i in symbols.items():
            if len(s) == 1:
                self.letters[ord(s)] = i
        self.width = self.size + len(inner)
        pairs = [(symbols[p[:k]] * self.width + symbols[p[k:]], i, place[score[i]]) for p, i in ids.items() for k in range(1, len(p)) if p[:k] in symbols and p[k:] in symbols]
        pairs.sort()
        self.keys = np.array([x[0] for x in pairs] + [np.iinfo(np.int64).max], np.int64)
        self.merged = np.array([x[1] for x in pairs] + [-1], np.int32)
        self.ranks = np.array([x[2] for x in pairs] + [_NEVER], np.int32)
        self.texts = symbols
        self.ids, self.place = ids, {i: place[s] for i, s in score.items()}
        self.byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        self.pieces = {i: p for p, i in ids.items()}

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair; a pair that does not merge has the last rank."""
        key = left.astype(np.int64) * self.width + right
        key[(left < 0) | (right < 0)] = -1
        at = np.searchsorted(self.keys, key)
        found = self.keys[at] == key
        return np.where(found, self.ranks[at], _NEVER), np.where(found, self.merged[at], -1)


_loaded = words.Local()


def pieces(model: str) -> Pieces:
    """Tables of a model, once per worker process.  ``model`` is a path, or a file name of ``public_tokenizers``."""
    if model not in _loaded:
        path = model
        if "/" not in model:
            import public_tokenizers

            path = public_tokenizers.path(model)
        _loaded[model] = Pieces(path)
    return _loaded[model]


def _spread(table: Pieces, symbol: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Tokens of each surviving symbol: 1, or the UTF-8 length of a character outside the vocabulary."""
    unknown = (symbol < 0) | (symbol >= table.size)
    return np.where(unknown, 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000), 1)


def merge_long(table: Pieces, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Surviving symbols of one very long pre-token and their first characters, merged with a heap of (rank, position)."""
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    symbol = table.letters[code].tolist()
    n = len(symbol)
    rank, merged = (x.tolist() for x in table.look_up(np.array(symbol[:-1], np.int64), np.array(symbol[1:], np.int64)))
    heap = [(r, i, symbol[i], symbol[i + 1], i + 1, m) for i, (r, m) in enumerate(zip(rank, merged, strict=True)) if r != _NEVER]
    heapq.heapify(heap)
    after, before, alive = [*range(1, n), -1], [-1, *range(n - 1)], [True] * n
    pairs: dict = {}

    def push(i, j):
        key = (symbol[i], symbol[j])
        if key not in pairs:
            r, m = table.look_up(np.array([key[0]]), np.array([key[1]]))
            pairs[key] = (int(r[0]), int(m[0]))
        r, m = pairs[key]
        if r != _NEVER:
            heapq.heappush(heap, (r, i, *key, j, m))

    while heap:
        _, i, a, b, j, m = heapq.heappop(heap)
        if not alive[i] or not alive[j] or after[i] != j or symbol[i] != a or symbol[j] != b:
            continue
        symbol[i], alive[j] = m, False
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
            push(i, after[i])
        if before[i] >= 0:
            push(before[i], i)
    keep = np.array(alive)
    return np.array(symbol)[keep], code[keep]


def merged_as(table: Pieces, texts: list[str], cut: np.ndarray) -> np.ndarray:
    """Whether each short text merges into exactly two symbols that meet at character ``cut``."""
    code = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    second = np.full(len(texts), -1, np.int64)
    counts = _merge_all(table, table.letters[code], code, size, second)
    return (counts == 2) & (second == cut)


def merge_counts(table: Pieces, texts: list[str]) -> np.ndarray:
    """Number of tokens of each pre-token, a text in which spaces are written as U+2581."""
    totals = np.zeros(len(texts), np.int64)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    for i in np.flatnonzero(lengths > LONG):
        totals[i] = _spread(table, *merge_long(table, texts[i])).sum()
    short = np.flatnonzero((lengths > 0) & (lengths <= LONG))
    for lo in range(0, len(short), 100_000):
        chosen = short[lo : lo + 100_000]
        code = np.frombuffer("".join([texts[i] for i in chosen]).encode("utf-32-le"), np.uint32).astype(np.int64)
        symbol, size = table.letters[code], lengths[chosen]
        totals[chosen] = _merge_all(table, symbol, code, size)
    return totals


def _merge_all(table: Pieces, symbol: np.ndarray, code: np.ndarray, size: np.ndarray, second: np.ndarray | None = None) -> np.ndarray:
    """Tokens of each sequence; ``second`` gets the place of each sequence's second symbol."""
    out = np.zeros(len(size), np.int64)
    place = None if second is None else np.arange(len(symbol)) - np.repeat(np.cumsum(size) - size, size)
    row = np.arange(len(size))  # where each active sequence came from
    ends = np.cumsum(size)
    rank = np.full(len(symbol), _NEVER, np.int32)
    merged = np.full(len(symbol), -1, np.int32)
    if len(symbol) > 1:
        rank[:-1], merged[:-1] = table.look_up(symbol[:-1], symbol[1:])
    rank[ends - 1] = _NEVER  # no pair reaches over the end of a sequence
    while len(size):
        starts = ends - size
        lowest = np.minimum.reduceat(rank, starts)
        going = lowest != _NEVER
        if not going.all():
            spread = np.add.reduceat(_spread(table, symbol, code), starts)
            out[row[~going]] = spread[~going]
            keep = np.repeat(going, size)
            if second is not None:
                two = ~going & (size > 1)
                second[row[two]] = place[starts[two] + 1]
                place = place[keep]
            symbol, code, rank, merged = symbol[keep], code[keep], rank[keep], merged[keep]
            row, size, lowest = row[going], size[going], lowest[going]
            ends = np.cumsum(size)
            starts = ends - size
            if not len(size):
                break
        # the leftmost pair of the lowest rank in every sequence
        hits = np.flatnonzero(rank == np.repeat(lowest, size))
        first = hits[np.searchsorted(hits, starts)]
        symbol[first] = merged[first]
        keep = np.ones(len(symbol), bool)
        keep[first + 1] = False
        moved = first - np.arange(len(first))
        symbol, code, rank, merged = symbol[keep], code[keep], rank[keep], merged[keep]
        if second is not None:
            place = place[keep]
        size = size - 1
        ends = np.cumsum(size)
        starts = ends - size
        # pairs that begin or end at a merged symbol
        last = moved == ends - 1
        right = moved[~last]
        rank[moved[last]] = _NEVER
        rank[right], merged[right] = table.look_up(symbol[right], symbol[right + 1])
        left = moved[moved > starts] - 1
        rank[left], merged[left] = table.look_up(symbol[left], symbol[left + 1])
    return out


def pretokens(text: str) -> list[str]:
    """Pre-tokens whose tokens, in order, are those of the text.  A leading space is part of every text."""
    if not text:
        return []
    words = text.replace("\n", " \n").split(" ")
    if "" in words or "▁" in text:
        marked = "▁" + text.replace(" ", "▁")
        return _cut.findall(marked)
    return [w if w[0] == "\n" else "▁" + w for w in words]


class Counter:
    """Counts tokens of texts; remembers the pre-tokens it has merged."""

    def __init__(self, model: str, memory: int = MEMORY):
        self.table, self.memory, self.known = pieces(model), memory, {}

    def count(self, texts: list[str]) -> list[int]:
        cut = [pretokens(t) for t in texts]
        if len(self.known) > self.memory:
            self.known = {}
        new = list(set().union(*cut).difference(self.known)) if cut else []
        if new:
            self.known.update(zip(new, merge_counts(self.table, new).tolist(), strict=True))
        known = self.known.__getitem__
        return [sum(map(known, c)) for c in cut]


def count_tokens(docs: DataFrame, model: str = MODEL, limit: int = 4096, text: str = "text") -> DataFrame:
    """Append n_bytes, n_tokens and over_limit (more tokens than ``limit``) to every row.

    Columns of those names are replaced; all others are kept.
    """

    @F.pandas_udf("bigint")
    def tokens(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = Counter(model)
        for column in columns:
            texts = column.fillna("").tolist()
            out: list[int] = []
            lo = 0
            while lo < len(texts):
                hi, held = lo, 0
                while hi < len(texts) and (hi == lo or held + len(texts[hi]) < 4_000_000):
                    held += len(texts[hi])
                    hi += 1
                out += counter.count(texts[lo:hi])
                lo = hi
            yield pd.Series(out, dtype="int64")

    counted = docs.withColumn("n_tokens", tokens(F.col(text)))
    return counted.withColumn("n_bytes", F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("bigint")).withColumn("over_limit", F.col("n_tokens") > limit)
