"""SentencePiece encoding and decoding by suffix-array matching.

The new distinct pre-tokens of a batch are concatenated and indexed by a suffix array (prefix doubling up to the longest
piece).  Every piece of the vocabulary is binary-searched for its range of occurrences; the occurrences are edges from
start to end position, sorted by end.  Relaxing them in that order finds, for every position, the last piece of the
encoding of the text up to there: an edge is taken when its piece may follow the last piece at its start, that is, when
the two pieces side by side are encoded as those two.  In byte-pair encoding a sequence of pieces is the encoding of its
text exactly if all neighbours are so, hence one edge at most is taken for each position and the result is the library's.
Which pairs may stand side by side is worked out once per pair and process, in batches.

Characters outside the vocabulary are edges of their own and become byte pieces.  Decoding joins the bytes of the pieces,
turns the space mark into a space and drops the one that encoding put in front.

Defined cases: a null text is an empty text with no ids; the space mark U+2581 in a text decodes to a space, as in the
library; special strings inside a text are ordinary characters; repeated rows each give a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from . import merging

MODEL = merging.MODEL
_END = 0x10FFFE
#: Characters of distinct pre-tokens indexed at once.
INDEX_CHARS = 1_000_000


class Encoder:
    """Encodes texts with one model; keeps what it has learnt about pre-tokens and pairs within bounds."""

    def __init__(self, model: str = MODEL, memory: int = merging.MEMORY):
        self.table = merging.pieces(model)
        self.memory = memory
        self.known: dict[str, bytes] = {}
        t = self.table
        names = sorted(t.ids)
        whole = merging.merge_counts(t, names) == 1
        self.names = [n for n, ok in zip(names, whole, strict=True) if ok]
        self.piece = np.array([t.ids[n] for n in self.names], np.int64)
        self.length = np.array([len(n) for n in self.names], np.int64)
        self.depth = int(self.length.max())
        self.letter = np.full((len(self.names), self.depth), -1, np.int64)
        for i, n in enumerate(self.names):
            self.letter[i, : len(n)] = [ord(c) for c in n]
        self.pairs, self.fits = np.zeros(0, np.int64), np.zeros(0, bool)
        self.bytes = self._piece_bytes()

    def _piece_bytes(self) -> list[bytes]:
        t = self.table
        out = [b""] * t.size
        for i, p in t.pieces.items():
            out[i] = p.replace("▁", " ").encode()
        for b, i in enumerate(t.byte_ids):
            out[int(i)] = bytes([b])
        return out

    # matching

    def _suffixes(self, code: np.ndarray) -> np.ndarray:
        """Start positions in the order of what follows, as far as the longest piece reaches."""
        kinds, letter = np.unique(code, return_inverse=True)
        n, letter = len(code), letter.astype(np.uint64) + np.uint64(1)
        shifted = lambda x, by: np.concatenate([x[by:], np.zeros(min(by, n), x.dtype)])[:n]
        reach, bits = 1, max(1, int(len(kinds) + 1).bit_length())
        key, rank = letter, letter
        while reach < self.depth:
            # as many neighbouring ranks as fit into 64 bits are sorted at once
            many = max(2, min(64 // bits, -(-self.depth // reach)))
            key = rank
            for i in range(1, many):
                key = (key << np.uint64(bits)) | shifted(rank, i * reach)
            reach *= many
            if reach < self.depth:
                rank = np.unique(key, return_inverse=True)[1].astype(np.uint64) + np.uint64(1)
                bits = max(1, int(n + 1).bit_length())
        return np.argsort(key)

    def _ranges(self, code: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each piece, the range of the suffix array that begins with it: narrowed letter by letter."""
        n = len(code)
        lo, hi = np.zeros(len(self.piece), np.int64), np.full(len(self.piece), n, np.int64)
        padded = np.append(code, np.full(self.depth, -1))
        for d in range(self.depth):
            live = np.flatnonzero((self.length > d) & (lo < hi))
            if not len(live):
                break
            wanted = self.letter[live, d]
            edges = []
            for strict in (False, True):
                a, b = lo[live].copy(), hi[live].copy()
                while (a < b).any():
                    middle = (a + b) >> 1
                    seen = padded[order[np.minimum(middle, n - 1)] + d]
                    right = ((seen <= wanted) if strict else (seen < wanted)) & (a < b)
                    b = np.where(right | (a >= b), b, middle)
                    a = np.where(right, middle + 1, a)
                edges.append(a)
            lo[live], hi[live] = edges
        return lo, hi

    def _may_follow(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether two pieces side by side are encoded as those two.  -1, nothing or an unknown character, goes with all."""
        free = (left < 0) | (right < 0)
        key = left * self.table.width + right
        key[free] = -1
        distinct, back = np.unique(key, return_inverse=True)
        at = np.minimum(np.searchsorted(self.pairs, distinct), max(0, len(self.pairs) - 1))
        new = distinct[(self.pairs[at] != distinct) if len(self.pairs) else np.ones(len(distinct), bool)]
        new = new[new >= 0]
        if len(new):
            name = self.table.pieces
            a, b = (new // self.table.width).tolist(), (new % self.table.width).tolist()
            texts = [name[x] + name[y] for x, y in zip(a, b, strict=True)]
            fits = merging.merged_as(self.table, texts, np.array([len(name[x]) for x in a]))
            if len(self.pairs) > 4_000_000:
                self.pairs, self.fits = np.zeros(0, np.int64), np.zeros(0, bool)
                return self._may_follow(left, right)
            place = np.searchsorted(self.pairs, new)
            self.pairs, self.fits = np.insert(self.pairs, place, new), np.insert(self.fits, place, fits)
        out = np.ones(len(distinct), bool)
        real = distinct >= 0
        if real.any():
            out[real] = self.fits[np.searchsorted(self.pairs, distinct[real])]
        return out[back]

    def _encode_new(self, texts: list[str]) -> list[bytes]:
        """Ids, as bytes of 32-bit numbers, of distinct pre-tokens."""
        t = self.table
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        joined = chr(_END).join(texts) + chr(_END)
        code = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        ends = starts + sizes
        order = self._suffixes(code)
        lo, hi = self._ranges(code, order)
        counts = hi - lo
        inside = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
        begin = order[np.repeat(lo, counts) + inside]
        finish = begin + np.repeat(self.length, counts)
        piece = np.repeat(self.piece, counts)
        # characters outside the vocabulary
        alone = np.flatnonzero((t.letters[np.minimum(code, 0x10FFFF)] < 0) | (t.letters[np.minimum(code, 0x10FFFF)] >= t.size))
        alone = alone[code[alone] != _END]
        begin, finish, piece = np.concatenate([begin, alone]), np.concatenate([finish, alone + 1]), np.concatenate([piece, np.full(len(alone), -1)])
        # edges by end within their pre-token: all pre-tokens are relaxed together
        step = finish - np.repeat(starts, sizes + 1)[begin]
        by = np.argsort(step.astype(np.uint16), kind="stable")
        begin, finish, piece, step = begin[by], finish[by], piece[by], step[by]
        edges = np.searchsorted(step, np.arange(1, int(sizes.max(initial=0)) + 2))
        # last piece and its start for each position; -3: not reached, -2: nothing yet
        last, source = np.full(len(code) + 1, -3, np.int64), np.zeros(len(code) + 1, np.int64)
        last[starts] = -2
        for k in range(len(edges) - 1):
            a, b = edges[k], edges[k + 1]
            if a == b:
                continue
            s, e, p = begin[a:b], finish[a:b], piece[a:b]
            live = last[s] != -3
            s, e, p = s[live], e[live], p[live]
            ok = self._may_follow(last[s], p)
            last[e[ok]], source[e[ok]] = p[ok], s[ok]
        # walk back from the ends
        found_word, found_place, found_piece = [], [], []
        at, who = ends.copy(), np.arange(len(texts))
        while len(at):
            going = at > starts[who]
            at, who = at[going], who[going]
            if not len(at):
                break
            found_word.append(who)
            found_place.append(source[at])
            found_piece.append(last[at])
            at = source[at]
        if not found_word:
            return [b""] * len(texts)
        word, place, piece = (np.concatenate(x) for x in (found_word, found_place, found_piece))
        by = np.argsort(place, kind="stable")
        word, place, piece = word[by], place[by], piece[by]
        edges = np.searchsorted(word, np.arange(len(texts) + 1))
        flat = piece.astype(np.int32)
        odd = set(np.unique(word[piece < 0]).tolist())
        raw, out = flat.tobytes(), []
        for i in range(len(texts)):
            a, b = int(edges[i]), int(edges[i + 1])
            out.append(raw[4 * a : 4 * b] if i not in odd else self._with_bytes(piece[a:b], code[place[a:b]]))
        return out

    def _with_bytes(self, piece: np.ndarray, code: np.ndarray) -> bytes:
        ids: list[int] = []
        for p, c in zip(piece.tolist(), code.tolist(), strict=True):
            if 0 <= p < self.table.size:
                ids.append(p)
            else:
                ids += self.table.byte_ids[list(chr(c).encode())].tolist()
        return np.array(ids, np.int32).tobytes()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        cut = [merging.pretokens(t) for t in texts]
        if len(self.known) > self.memory:
            self.known = {}
        new = list(set().union(*cut).difference(self.known)) if cut else []
        long = [w for w in new if len(w) > merging.LONG]
        for w in long:
            self.known[w] = self._with_bytes(*merging.merge_long(self.table, w))
        group, held = [], 0
        for w in new:
            if len(w) > merging.LONG:
                continue
            group.append(w)
            held += len(w) + 1
            if held > INDEX_CHARS:
                self.known.update(zip(group, self._encode_new(group), strict=True))
                group, held = [], 0
        if group:
            self.known.update(zip(group, self._encode_new(group), strict=True))
        known = self.known.__getitem__
        return [np.frombuffer(b"".join(map(known, c)), np.int32) for c in cut]

    def decode(self, ids: np.ndarray) -> str:
        """The text of a sequence of ids."""
        raw = b"".join(map(self.bytes.__getitem__, ids.tolist()))
        text = raw.decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def encode_decode(docs: DataFrame, model: str = MODEL, text: str = "text") -> DataFrame:
    """Append n_bytes, n_tokens, ids, the decoded text and whether it is the text again (with the space mark as a space).

    Columns of those names are replaced; all others are kept.
    """
    added = {"n_bytes": "bigint", "n_tokens": "bigint", "ids": "array<int>", "decoded": "string", "round_trip": "boolean"}
    kept = [c for c in docs.columns if c not in added]
    place = kept.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(place)), 0).to_pylist()
            lo = 0
            while lo < batch.num_rows:
                hi, held = lo, 0
                while hi < batch.num_rows and (hi == lo or held + sizes[hi] < 4_000_000):
                    held += sizes[hi]
                    hi += 1
                part = batch.slice(lo, hi - lo)
                texts = [x or "" for x in part.column(place).to_pylist()]
                ids = encoder.encode(texts)
                decoded = [encoder.decode(x) for x in ids]
                counts = np.array([len(x) for x in ids], np.int64)
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                new = [
                    pa.array(sizes[lo:hi], pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32), pa.int32())),
                    pa.array(decoded, pa.string()),
                    pa.array([d == t.replace("▁", " ") for d, t in zip(decoded, texts, strict=True)], pa.bool_()),
                ]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], [*kept, *added])
                lo = hi

    rows = docs.select(*kept)
    schema = rows.schema
    for name, kind in added.items():
        schema = StructType([*schema.fields, *StructType.fromDDL(f"`{name}` {kind}").fields])
    return rows.mapInArrow(work, schema)
