"""SentencePiece encoding and decoding with a unigram model.

The pieces are in a double-array trie; the best segmentation is the Viterbi path
of greatest total log score.  Characters without a piece fall back to byte
pieces, and the whitespace marker takes the place of spaces.  Of files of another
model type only the vocabulary can be used: their scores are no log probabilities,
so ``unigram_model`` estimates those from the documents by EM.
"""

from __future__ import annotations

import math
import struct
import sys
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import row_pieces, stored, utf8

MARKER = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6   # piece types of the model format
UNIGRAM = 1                  # model type; a file that names none is of this one
UNKNOWN_PENALTY = 10.0
ROUNDS = 4                   # EM rounds from equal scores
PART = 1 << 20               # expected counts are summed as whole numbers of these parts, so in any order
LONG_WORD = 48               # longer words are segmented one by one
LONG_BLOCK = 1 << 14         # characters of a long word whose pieces are looked up together
BATCH_CHARS = 1 << 21        # text whose distinct words are segmented once
BATCH_WORDS = 1 << 14        # words segmented together
COUNTED = 1 << 20            # counts that a task holds before it adds up those of a word
SHIFT = 3.0                  # about what a character costs: keeps products of probabilities in range
LEAST = 1e-280               # products below are too close to the least number; logarithms take their place


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of a protocol-buffer message."""
    def varint(i: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            b = data[i]
            value |= (b & 0x7F) << shift
            i, shift = i + 1, shift + 7
            if b < 0x80:
                return value, i
    i = 0
    while i < len(data):
        key, i = varint(i)
        kind = key & 7
        if kind == 0:
            value, i = varint(i)
        elif kind == 2:
            n, i = varint(i)
            value, i = data[i:i + n], i + n
        else:
            n = 4 if kind == 5 else 8
            value, i = struct.unpack("<f" if n == 4 else "<d", data[i:i + n])[0], i + n
        yield key >> 3, value


def read_pieces(model: bytes) -> list[tuple[str, float, int]]:
    """(piece, log score, type) of a model file, by id."""
    out = []
    for field, value in _fields(model):
        if field == 1:
            piece = dict(_fields(value))
            out.append((piece.get(1, b"").decode("utf-8"), float(piece.get(2, 0.0)), int(piece.get(3, NORMAL))))
    return out


def model_type(model: bytes) -> int:
    """The model type that the trainer settings of a model file name."""
    return next((int(dict(_fields(v)).get(3, UNIGRAM)) for field, v in _fields(model) if field == 2), UNIGRAM)


def write_model(pieces: list[tuple[str, float, int]]) -> bytes:
    """A unigram model file of (piece, log score, type)."""
    def varint(n: int) -> bytes:
        out = bytearray()
        while n > 0x7F:
            out.append(n & 0x7F | 0x80)
            n >>= 7
        return bytes([*out, n])
    out = []
    for piece, score, kind in pieces:
        raw = piece.encode("utf-8")
        body = b"\x0a" + varint(len(raw)) + raw + b"\x15" + struct.pack("<f", score) + b"\x18" + varint(kind)
        out.append(b"\x0a" + varint(len(body)) + body)
    return b"".join(out) + b"\x12\x02\x18" + varint(UNIGRAM)


class Trie:
    """Double-array trie over code points: a child of state ``s`` by symbol ``c``
    is ``base[s] + c`` if ``check`` there is ``s``.  Symbols are dense numbers of
    the characters that occur in pieces, from 1."""

    def __init__(self, pieces: list[tuple[str, int]]):
        symbols = sorted({ch for p, _ in pieces for ch in p})
        self.symbol = np.zeros(sys.maxunicode + 2, np.int32)
        self.symbol[[ord(c) for c in symbols]] = np.arange(1, len(symbols) + 1)
        number = {c: i + 1 for i, c in enumerate(symbols)}
        tree: list[dict[int, int]] = [{}]
        value = [-1]
        for text, ident in pieces:
            node = 0
            for ch in text:
                c = number[ch]
                if c not in tree[node]:
                    tree[node][c] = len(tree)
                    tree.append({})
                    value.append(-1)
                node = tree[node][c]
            value[node] = ident
        # Bases are chosen for the nodes of most children first; each takes the
        # first place where all its children are free.
        width = len(symbols) + 1
        free = np.ones(2 * len(tree) + 2 * width, bool)
        free[0] = False
        first = np.zeros(len(tree), np.int64)
        lowest, kids_before = 1, -1
        for node in sorted((n for n in range(len(tree)) if tree[n]), key=lambda n: (-len(tree[n]), n)):
            codes = np.sort(np.fromiter(tree[node], np.int64))
            if len(codes) != kids_before:
                kids_before, begin = len(codes), lowest
            while True:
                while begin + 4096 + width >= len(free):
                    free = np.concatenate([free, np.ones(len(free), bool)])
                spots = begin + np.flatnonzero(free[begin:begin + 4096]) - codes[0]
                spots = spots[spots > 0]
                fits = free[spots[:, None] + codes].all(axis=1)
                if fits.any():
                    first[node] = spots[fits.argmax()]
                    break
                begin += 4096
            free[first[node] + codes] = False
            while not free[lowest]:
                lowest += 1
            begin = max(begin, lowest)
        base, check, out = np.zeros(len(free), np.int32), np.full(len(free), -1, np.int32), np.full(len(free), -1, np.int32)
        place = np.zeros(len(tree), np.int64)
        for node, kids in enumerate(tree):       # a node has a lower number than its children
            s = place[node]
            base[s], out[s] = first[node], value[node]
            for c, child in kids.items():
                place[child] = first[node] + c
                check[place[child]] = s
        # A place to look at is within the arrays, whatever the state and the symbol.
        self.base, self.value = base, out
        self.check = np.concatenate([check, np.full(width, -1, np.int32)])

    def matches(self, symbols: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For length 1, 2, ...: the positions where a piece of that length starts, and its
        id.  The symbol 0 is in no piece; it must be the last one."""
        at, state = np.flatnonzero(symbols), 0
        found, length = [], 0
        while len(at):
            nxt = self.base[state] + symbols[at + length]
            ok = np.flatnonzero(self.check[nxt] == state)
            at, state = at[ok], nxt[ok]
            length += 1
            ids = self.value[state]
            end = np.flatnonzero(ids >= 0)
            found.append((at[end], ids[end]))
        return found


def _unmarked(text: str, split: bool) -> list[str]:
    """The words of ``Model.words`` without the marker that each begins with."""
    if not text:
        return []
    if not split:
        return [text.replace(" ", MARKER)]
    parts = text.replace(MARKER, " ").split(" ")
    if "" not in parts:
        return parts
    out, run = [], 0
    for p in parts:          # an empty part is a marker that belongs to the next word
        if p:
            out.append(MARKER * run + p)
            run = 0
        else:
            run += 1
    if run:
        out.append(MARKER * (run - 1))
    return out


def _strings(texts) -> pa.Array:
    """Texts, or an Arrow column of them, as an Arrow column; null is empty."""
    if isinstance(texts, pa.Array):
        return pc.fill_null(texts.cast(pa.large_string()), "")
    return pa.array([t.encode("utf-8", "replace") for t in texts], pa.large_binary()).cast(pa.large_string())


def _joined(before: str, words: pa.Array, after: str = "") -> pa.Array:
    """Each word with what goes before and after it."""
    return pc.binary_join_element_wise(pa.scalar(before, pa.large_string()), words, pa.scalar(after, pa.large_string()), pa.scalar("", pa.large_string()))


def _cut(column: pa.Array, split: bool) -> tuple[pa.Array, np.ndarray | None, np.ndarray]:
    """(words without the marker that each begins with, their order if it is not that of
    the texts, words of each text).  Texts without markers in a row are cut together."""
    odd = pc.or_(pc.or_(pc.match_substring(column, "  "), pc.match_substring(column, MARKER)),
                 pc.or_(pc.starts_with(column, " "), pc.equal(column, "")))
    plain = ~odd.to_numpy(zero_copy_only=False) & split
    cut = pc.split_pattern(column.filter(pa.array(plain)), " ")
    counts = np.zeros(len(column), np.int64)
    counts[plain] = pc.list_value_length(cut).to_numpy()
    if plain.all():
        return cut.flatten(), None, counts
    rest = [_unmarked(t, split) for t in column.filter(pa.array(~plain)).to_pylist()]
    counts[~plain] = list(map(len, rest))
    words = pa.concat_arrays([cut.flatten(), pa.array(chain.from_iterable(rest), pa.large_string())])
    whose = np.repeat(plain, counts)
    return words, np.where(whose, np.cumsum(whose), int(whose.sum()) + np.cumsum(~whose)) - 1, counts


class Model:
    """A unigram model read from a model file's bytes.

    ``split`` says that no piece has a marker after another character, so words
    (a run of markers and what follows) can be segmented apart.  A file of another
    model type is a ValueError.
    """

    def __init__(self, model: bytes, trie: Trie | None = None):
        if model_type(model) != UNIGRAM:
            raise ValueError(f"no unigram model: model type {model_type(model)}")
        pieces = read_pieces(model)
        self.pieces = [p for p, _, _ in pieces]
        usable = [(p, i) for i, (p, _, kind) in enumerate(pieces) if kind in (NORMAL, USER) and p]
        self.score = np.array([s for _, s, _ in pieces], np.float64)
        scores = [pieces[i][1] for _, i in usable]
        self.unknown_score = (min(scores) if scores else 0.0) - UNKNOWN_PENALTY
        self.unknown = next((i for i, (_, _, kind) in enumerate(pieces) if kind == UNKNOWN), 0)
        self.byte_ids = {}
        self.text = []
        for i, (p, _, kind) in enumerate(pieces):
            if kind == BYTE:
                self.byte_ids[int(p[3:5], 16)] = i
                self.text.append(bytes([int(p[3:5], 16)]))
            elif kind in (NORMAL, USER):
                self.text.append(p.encode("utf-8").replace(MARKER.encode(), b" "))
            elif kind == UNKNOWN:
                self.text.append(" ⁇ ".encode())
            else:
                self.text.append(b"")
        self._text_size = np.fromiter(map(len, self.text), np.int64, len(self.text))
        self._text_first = np.cumsum(self._text_size) - self._text_size
        self._text_bytes = np.frombuffer(b"".join(self.text), np.uint8)
        self.byte_fallback = len(self.byte_ids) == 256
        self.usable = np.array([i for _, i in usable], np.int64)
        self.trie = trie or _trie(usable)
        self.longest = max((len(p) for p, _ in usable), default=1)
        self.split = not any(MARKER in p.lstrip(MARKER) for p, _ in usable)
        self.is_byte = np.zeros(len(pieces), bool)
        self.is_byte[list(self.byte_ids.values())] = True
        self._weight = np.append(self.score, self.unknown_score)      # piece -1 is none
        self._size = np.append(np.fromiter(map(len, self.pieces), np.int64, len(pieces)), 1)

    # -- encoding ----------------------------------------------------------

    def _fallback(self, ch: str) -> list[int]:
        return [self.byte_ids[b] for b in ch.encode("utf-8", "replace")] if self.byte_fallback else [self.unknown]

    def words(self, text: str) -> list[str]:
        """The marked text, cut before every marker that follows another character."""
        return [MARKER + w for w in _unmarked(text, self.split)]

    def segment(self, words: list[str]) -> list[list[int]]:
        """Viterbi segmentation of every word; equal scores go to the path whose
        last piece starts first."""
        flat, size = self._segmented(_strings(words))
        ids, end = flat.tolist(), np.cumsum(size).tolist()
        return [ids[i:j] for i, j in zip([0, *end[:-1]], end)]

    def _segmented(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, ids of each word)."""
        length = pc.utf8_length(words).to_numpy()
        long = length > LONG_WORD
        if long.any():
            flat, size = self._segmented(words.filter(pa.array(~long)))
            ones = list(map(self._segment_one, words.filter(pa.array(long)).to_pylist()))
            sizes = np.zeros(len(words), np.int64)
            sizes[~long], sizes[long] = size, list(map(len, ones))
            out, whose = np.zeros(int(sizes.sum()), np.int32), np.repeat(long, sizes)
            out[~whose], out[whose] = flat, list(chain.from_iterable(ones))
            return out, sizes
        parts = [self._segment_many(words.slice(i, BATCH_WORDS)) for i in range(0, len(words), BATCH_WORDS)]
        return (np.concatenate([np.zeros(0, np.int32), *[ids for ids, _ in parts]]),
                np.concatenate([np.zeros(0, np.int64), *[n for _, n in parts]]))

    def _lattice(self, words: pa.Array):
        """(text, length, start, edges, groups): the places of all words' pieces.

        The text is that of all words, each with a space after it; a place in it is a
        node, the space being a word's last one.  Edges are (from, to, piece or -1); each
        group of them, given by its bounds, has distinct starts and distinct ends, and
        they are in the order of their ends within the words."""
        length = pc.utf8_length(words).to_numpy().astype(np.int64)
        data, _ = utf8(_joined("", words, " "))
        text = data.tobytes().decode("utf-8")
        symbols = self.trie.symbol[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        start = np.cumsum(length + 1) - (length + 1)
        symbols[start + length] = 0
        found = self.trie.matches(symbols)
        # Characters without a piece of their own have a fallback edge.
        alone = np.ones(len(text), bool)
        alone[start + length] = False
        if found:
            alone[found[0][0]] = False
        lone = np.flatnonzero(alone)
        src = np.concatenate([*[at for at, _ in found], lone])
        ids = np.concatenate([*[i for _, i in found], np.full(len(lone), -1, np.int32)])
        size = np.repeat([*range(1, len(found) + 1), 1], [*[len(at) for at, _ in found], len(lone)])
        # Edges by their end, and longest first among those of one end, so that
        # each group has distinct targets.
        offset = np.arange(len(text), dtype=np.int16) - np.repeat(start, length + 1).astype(np.int16)
        key = (offset[src] + size.astype(np.int16)) * np.int16(64) - size.astype(np.int16)
        order = np.argsort(key, kind="stable")
        src, ids, key = src[order], ids[order], key[order]
        cut = np.flatnonzero(key[1:] != key[:-1]) + 1
        groups = [(i, j) for i, j in zip([0, *cut.tolist()], [*cut.tolist(), len(src)]) if i < j]
        return text, length, start, (src, src + size[order], ids), groups

    def _segment_many(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        text, length, start, (src, dst, ids), groups = self._lattice(words)
        weight, number = self._weight[ids], np.arange(len(src))
        best = np.full(len(text), -np.inf)
        edge = np.zeros(len(text), np.int64)
        best[start] = 0.0
        for i, j in groups:
            b = dst[i:j]
            total = best[src[i:j]] + weight[i:j]
            better = total > best[b]
            b = b[better]
            best[b], edge[b] = total[better], number[i:j][better]
        # Back pointers of all words at once, last pieces first.
        at = start + length
        which = np.flatnonzero(length > 0)
        steps = []
        while len(which):
            e = edge[at[which]]
            steps.append((which, e))
            at[which] = src[e]
            which = which[at[which] > start[which]]
        if not steps:
            return np.zeros(0, np.int32), np.zeros(len(words), np.int64)
        rows = np.concatenate([w for w, _ in reversed(steps)])
        order = np.argsort(rows.astype(np.int16), kind="stable")       # fewer than 2**15 words
        rows, e = rows[order], np.concatenate([e for _, e in reversed(steps)])[order]
        path = ids[e]
        size = np.bincount(rows, minlength=len(words))
        lone = np.flatnonzero(path < 0)
        if len(lone):            # characters without a piece
            fallback = [self._fallback(text[k]) for k in src[e[lone]].tolist()]
            times = np.ones(len(path), np.int64)
            times[lone] = list(map(len, fallback))
            size = np.bincount(rows, times, len(words)).astype(np.int64)
            path = np.repeat(path, times)
            path[path < 0] = list(chain.from_iterable(fallback))
        return path, size

    def _ends(self, word: str, first: int, last: int) -> list[tuple[int, list[tuple[int, int, float]]]]:
        """(end, (start, piece or -1, score) of the pieces that end there), by end, for the
        ends from ``first`` to ``last``."""
        begin = max(0, first - self.longest)
        codes = np.frombuffer(word[begin:last].encode("utf-32-le", "surrogatepass"), np.uint32)
        n = len(codes)
        found = self.trie.matches(np.append(self.trie.symbol[codes], np.int32(0)))
        ending: list[list[tuple[int, int, float]]] = [[] for _ in range(n + 1)]
        single = np.zeros(n, bool)
        for k in range(len(found) - 1, -1, -1):
            at, ids = found[k]
            if k == 0:
                single[at] = True
            for a, p, s in zip(at.tolist(), ids.tolist(), self.score[ids].tolist()):
                ending[a + k + 1].append((begin + a, p, s))
        for a in np.flatnonzero(~single).tolist():
            ending[a + 1].append((begin + a, -1, self.unknown_score))
        return [(end, ending[end - begin]) for end in range(first, last + 1)]

    def _blocks(self, n: int) -> list[tuple[int, int]]:
        return [(i + 1, min(n, i + LONG_BLOCK)) for i in range(0, n, LONG_BLOCK)]

    def _segment_one(self, word: str) -> list[int]:
        """The same for one long word, block by block: time and memory in proportion to
        its length, three numbers a character."""
        n = len(word)
        best, start, piece = array("d", [-math.inf]) * (n + 1), array("i", [0]) * (n + 1), array("i", [-1]) * (n + 1)
        best[0] = 0.0
        for first, last in self._blocks(n):
            for end, edges in self._ends(word, first, last):
                for a, p, score in edges:
                    s = best[a] + score
                    if s > best[end]:
                        best[end], start[end], piece[end] = s, a, p
        out = array("i")
        end = n
        while end:
            a, p = start[end], piece[end]
            out.extend([p] if p >= 0 else reversed(self._fallback(word[a])))
            end = a
        out.reverse()
        return out.tolist()

    def expected(self, words, counts) -> np.ndarray:
        """For every piece, how often it is expected in the words, each ``counts``
        times, over all their segmentations by probability; in parts of ``PART``."""
        out = np.zeros(len(self.pieces), np.int64)
        words, counts = _strings(words), np.asarray(counts, np.int64)
        length = pc.utf8_length(words).to_numpy()
        for i in np.flatnonzero(length > LONG_WORD).tolist():
            self._expect_one(words[i].as_py(), int(counts[i]), out)
        short = (length > 0) & (length <= LONG_WORD)
        words, counts = words.filter(pa.array(short)), counts[short]
        # Products of probabilities, each times e**SHIFT a character: the shares are quotients.
        prob_of = np.exp(self._weight + SHIFT * self._size)
        for i in range(0, len(words), BATCH_WORDS):
            self._expect_many(words.slice(i, BATCH_WORDS), counts[i:i + BATCH_WORDS], prob_of, out)
        return out

    def _expect_many(self, words: pa.Array, times: np.ndarray, prob_of: np.ndarray, out: np.ndarray) -> None:
        """The same for many short words, added to ``out``."""
        text, length, start, (src, dst, ids), groups = self._lattice(words)
        prob = prob_of[ids]
        ahead = np.zeros(len(text))
        behind = ahead.copy()
        ahead[start] = behind[start + length] = 1.0
        for i, j in groups:
            ahead[dst[i:j]] += ahead[src[i:j]] * prob[i:j]
        for i, j in reversed(groups):
            behind[src[i:j]] += behind[dst[i:j]] * prob[i:j]
        total = behind[start]
        lost = ~((total > LEAST) & (total < 1 / LEAST))
        whose = np.repeat(np.arange(len(words)), length + 1)
        word = whose[src]
        real = np.flatnonzero((ids >= 0) & ~lost[word])
        a, b, word, ids = src[real], dst[real], word[real], ids[real]
        share = ahead[a] * prob[real] * (behind[b] / total[word])
        np.add.at(out, ids, np.rint(share * PART).astype(np.int64) * times[word])
        for i in np.flatnonzero(lost).tolist():
            self._expect_one(words[i].as_py(), int(times[i]), out)

    def _expect_one(self, word: str, count: int, out: np.ndarray) -> None:
        """The same for one word, by logarithms, added to ``out``; block by block, time and
        memory in proportion to its length."""
        n = len(word)
        ahead, behind = array("d", [-math.inf]) * (n + 1), array("d", [-math.inf]) * (n + 1)
        ahead[0] = behind[n] = 0.0
        for first, last in self._blocks(n):
            for end, edges in self._ends(word, first, last):
                totals = [ahead[a] + s for a, _, s in edges]
                top = max(totals, default=-math.inf)
                if top > -math.inf:
                    ahead[end] = top + math.log(sum(math.exp(t - top) for t in totals))
        for first, last in reversed(self._blocks(n)):
            pieces, share = [], []
            for end, edges in reversed(self._ends(word, first, last)):
                rest = behind[end]
                if rest == -math.inf:
                    continue
                for a, p, s in edges:
                    t, old = rest + s, behind[a]
                    behind[a] = max(t, old) + math.log1p(math.exp(-abs(t - old)))
                    if p >= 0:
                        pieces.append(p)
                        share.append(math.exp(ahead[a] + t - ahead[n]))
            np.add.at(out, np.array(pieces, np.int64), np.rint(np.array(share, np.float64) * PART).astype(np.int64) * count)

    def encode_all(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of the texts).  Each of their distinct words is
        segmented once."""
        words, order, counts = _cut(_strings(texts), self.split)
        words = words.dictionary_encode()
        flat, size = self._segmented(_joined(MARKER, words.dictionary))
        use = words.indices.to_numpy()
        if order is not None:
            use = use[order]
        n = size[use]
        word_end = np.concatenate([[0], np.cumsum(n)])
        shift = (np.cumsum(size) - size)[use] - word_end[:-1]
        at = np.repeat(shift, n)
        at += np.arange(len(at))
        ids = flat[at]
        return ids, word_end[np.concatenate([[0], np.cumsum(counts)])]

    # -- decoding ----------------------------------------------------------

    def decode(self, ids) -> str:
        """Text of the pieces: markers become spaces, byte pieces bytes, and the
        space that encoding put in front goes.  Bytes that are no UTF-8 become
        replacement characters; ids out of range raise IndexError."""
        return self._unpadded(b"".join(map(self.text.__getitem__, ids))).decode("utf-8", "replace")

    @staticmethod
    def _unpadded(text: bytes) -> bytes:
        return text[1:] if text[:1] == b" " else text

    def decode_all(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """The bytes that ``decode`` reads as UTF-8, of each range of the ids."""
        size = self._text_size[ids]
        end = np.concatenate([[0], np.cumsum(size)])
        where = np.repeat(self._text_first[ids] - end[:-1], size)
        where += np.arange(len(where))
        raw = self._text_bytes[where].tobytes()
        at = end[bounds].tolist()
        return [self._unpadded(raw[a:b]) for a, b in zip(at[:-1], at[1:])]

    def same(self, ids: np.ndarray, bounds: np.ndarray, column: pa.Array) -> list[bool]:
        """Whether each range of the ids decodes to its text."""
        data, offsets = utf8(column)
        data, at = data.tobytes(), offsets.tolist()
        return [back == data[a:b] or back.decode("utf-8", "replace") == data[a:b].decode("utf-8")
                for back, a, b in zip(self.decode_all(ids, bounds), at[:-1], at[1:])]


def unigram_model(spark: SparkSession, docs: DataFrame, model_file: str, text_col: str = "text", rounds: int = ROUNDS) -> bytes:
    """The file's model if it is a unigram one.  Otherwise a unigram model of its
    vocabulary (pieces, types and ids are kept), whose log scores ``rounds`` rounds
    of EM give to ``docs``: every distinct word of all texts counts as often as it
    occurs, with all its segmentations by probability.

    The first round's scores are equal.  Each piece counts half an occurrence more
    than expected, so that those that ``docs`` do not hold can still be used.  The
    words are counted and their pieces summed in Spark; the driver gets one number
    for each piece.  The scores do not depend on the partitioning.
    """
    with open(model_file, "rb") as f:
        data = f.read()
    if model_type(data) == UNIGRAM:
        return data
    pieces = [(p, 0.0, kind) for p, _, kind in read_pieces(data)]
    data = write_model(pieces)
    words = stored(spark, word_counts(docs.select(F.col(text_col).cast("string").alias("t")), _model(data).split), "words")
    usable = [i for i, (p, _, kind) in enumerate(pieces) if kind in (NORMAL, USER) and p]
    for _ in range(rounds):
        rows = words.mapInArrow(_expecting(_shared(spark, data)), "piece int, n long").groupBy("piece").agg(F.sum("n").alias("n")).collect()
        seen = {r["piece"]: r["n"] for r in rows}
        total = sum(seen.values()) + len(usable) * PART // 2
        for i in usable:
            pieces[i] = (pieces[i][0], math.log((seen.get(i, 0) + PART // 2) / total), pieces[i][2])
        data = write_model(pieces)
    return data


def word_counts(texts: DataFrame, split: bool) -> DataFrame:
    """``texts(t)`` -> ``word, n``: how often each word of ``Model.words`` occurs.  Null and
    empty texts have none; words are counted before they are shuffled."""
    texts = texts.where("t <> ''").select("t")
    if split:
        words = texts.mapInArrow(_counted, "word string, n long")
    else:
        words = texts.select(F.concat(F.lit(MARKER), F.translate("t", " ", MARKER)).alias("word"), F.lit(1).alias("n"))
    return words.groupBy("word").agg(F.sum("n").alias("n"))


def _counted(batches):
    """Each word of the texts of the batches with how often it occurs; a word may come
    several times where there are nearly ``COUNTED`` distinct ones."""
    words, counts, rows = [], [], 0

    def added():
        coded = pa.concat_arrays(words).dictionary_encode()
        total = np.bincount(coded.indices.to_numpy(), np.concatenate(counts), len(coded.dictionary)).astype(np.int64)
        return coded.dictionary, total

    def handed(word, n):
        return pa.RecordBatch.from_arrays([_joined(MARKER, word).cast(pa.string()), pa.array(n, pa.int64())], ["word", "n"])

    for batch in batches:
        for piece in _pieces(batch, 0):
            found, _, _ = _cut(_strings(piece.column(0)), True)
            word, n = pc.value_counts(found).flatten()
            words.append(word)
            counts.append(n.to_numpy())
            rows += len(word)
            if rows > COUNTED:
                word, n = added()
                if len(word) > COUNTED * 3 // 4:
                    yield handed(word, n)
                    words, counts, rows = [], [], 0
                else:
                    words, counts, rows = [word], [n], len(word)
    if words:
        yield handed(*added())


def _expecting(shared):
    def run(batches):
        model = _model(*shared.value)
        total = np.zeros(len(model.pieces), np.int64)
        for batch in batches:
            total += model.expected(batch.column(0), batch.column(1).to_numpy())
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held], pa.int64())], ["piece", "n"])
    return run


def _bytes(model: str | bytes) -> bytes:
    """A model's bytes, or those of the file of that path."""
    if isinstance(model, bytes):
        return model
    with open(model, "rb") as f:
        return f.read()


def encode(spark: SparkSession, docs: DataFrame, model: str | bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, tokens array<int>``, one row per input row, white space and all
    other characters kept as they are (no normalisation; a marker in the text is
    read as a space).

    Null or empty text: no tokens.  The driver reads ``model``, if it is a path, and
    broadcasts it: its size is that of the vocabulary.  Repeated rows each give a row; an
    empty table gives no rows; other columns are ignored.
    """
    shared = _shared(spark, _bytes(model))

    def run(batches):
        model = _model(*shared.value)
        for batch in batches:
            for piece in _pieces(batch):
                ids, bounds = model.encode_all(piece.column(1))
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))], ["id", "tokens"])

    return (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
            .mapInArrow(run, "id long, tokens array<int>").withColumnRenamed("id", id_col))


def decode(spark: SparkSession, tokens: DataFrame, model: str | bytes, id_col: str = "doc_id", tokens_col: str = "tokens") -> DataFrame:
    """``id_col, text`` for ``tokens_col array<int>``; null tokens give an empty text."""
    shared = _shared(spark, _bytes(model))

    def run(batches):
        model = _model(*shared.value)
        for batch in batches:
            texts = [model.decode(t or ()) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["id", "t"])

    return (tokens.select(F.col(id_col).cast("long").alias("id"), F.col(tokens_col).cast("array<int>").alias("t"))
            .mapInArrow(run, "id long, t string").select(F.col("id").alias(id_col), F.col("t").alias("text")))


def roundtrip(spark: SparkSession, docs: DataFrame, model: str | bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode each text in one pass: ``id_col, tokens, n_bytes`` (byte
    pieces among the tokens) and ``same``: the decoded text is the text."""
    shared = _shared(spark, _bytes(model))

    def run(batches):
        model = _model(*shared.value)
        for batch in batches:
            for piece in _pieces(batch):
                ids, bounds = model.encode_all(piece.column(1))
                same = model.same(ids, bounds, piece.column(1))
                count = np.concatenate([[0], np.cumsum(model.is_byte[ids])])
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32())),
                     pa.array(count[bounds[1:]] - count[bounds[:-1]], pa.int64()), pa.array(same, pa.bool_())],
                    ["id", "tokens", "n_bytes", "same"])

    return (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
            .mapInArrow(run, "id long, tokens array<int>, n_bytes long, same boolean").withColumnRenamed("id", id_col))


_MODELS: dict[int, Model] = {}
_TRIES: dict[int, Trie] = {}


def _trie(pieces: list[tuple[str, int]]) -> Trie:
    """One trie per worker process; models that differ in their scores share it."""
    key = hash(tuple(pieces))
    if key not in _TRIES:
        _TRIES.clear()
        _TRIES[key] = Trie(pieces)
    return _TRIES[key]


def _model(data: bytes, trie: Trie | None = None) -> Model:
    """One model per worker process."""
    key = hash(data)
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = Model(data, trie)
    return _MODELS[key]


def _shared(spark: SparkSession, data: bytes):
    """A model's bytes and its trie for the workers: it is built once, by the driver, and
    its size is that of the vocabulary."""
    return spark.sparkContext.broadcast((data, _model(data).trie))


def _pieces(batch, column: int = 1):
    """Row ranges of a batch with about ``BATCH_CHARS`` of text."""
    _, offsets = utf8(batch.column(column))
    for i, j in row_pieces(np.diff(offsets), BATCH_CHARS):
        yield batch.slice(i, j - i)
