"""SentencePiece encoding and decoding by a weighted finite-state transducer.

A model file compiles into a normaliser (rewrite rules, dummy prefix, spaces to U+2581), a
trie of pieces whose final states emit an id, and byte-fallback arcs for characters that no
piece is.  A text is composed with it position by position, and the path of least weight in
the tropical semiring (sums along a path, minimum over paths) is the encoding.

Piece weights are minus the model's scores in a unigram model.  In a BPE model they are 0,
and the weight lies on the joins of two pieces: 0 if merging their joined text by the
model's ranks gives the two back, infinite otherwise.  One path alone has a finite weight,
and it is the BPE encoding: merges never cross the ends of its pieces.  Join weights are
found when first needed, and as all finite weights are 0, the search goes depth first, long
pieces first, and ends with the first path to the end.

Paths of all pieces pass through a single state before a word (a space that follows another
character), as no piece holds such a space; so words are encoded by themselves, each distinct
word of many texts once.

In a BPE model many words are composed together, all at one position at a time: a position is
reached by the one piece whose join with the piece before it weighs 0.  The join weights not yet
known are found together too, by merging the joined texts in step, and remembered in a table of
bounded size.  Very long words, and any word with a position that several pieces reach, are
searched alone.

Defined results: NULL and empty texts have no ids and decode to an empty text; U+2581 in a
text decodes to a space, so such a text makes no round trip; repeated rows and NULL in other
columns have no effect; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from math import inf

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobfacts.llm.common import by_value

by_value(__name__)

SPACE = "▁"
#: joins that a worker remembers
REMEMBERED = 400_000
#: characters of a word that is composed with others
SHORT = 64
#: characters of the texts encoded together, and of the words composed together
TEXTS, WORDS = 4_000_000, 100_000
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6
_UNIGRAM, _BPE = 1, 2


def default_model() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


def _message(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            value: int | bytes = varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            value = data[at:at + size]
            at += size
        yield tag >> 3, value


def _characters(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``count`` whole numbers from each ``first`` on, one after another."""
    ends = np.cumsum(count, dtype=first.dtype)
    out = np.repeat(first - ends + count, count)
    out += np.arange(len(out), dtype=out.dtype)
    return out


class _Table:
    """A hash table from whole numbers under 2^39 to ones under 2^24, read and filled by arrays."""

    def __init__(self):
        self.clear()

    def clear(self, bits: int = 12) -> None:
        self.shift, self.used = np.uint64(64 - bits), 0
        self.held = np.full(1 << bits, -1, dtype=np.int64)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).view(np.int64)

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Keys that are distinct and not yet held."""
        rows = keys << 24 | values
        if 3 * (self.used + len(rows)) > len(self.held):
            rows = np.append(rows, self.held[self.held >= 0])
            self.clear((6 * len(rows) - 1).bit_length())
        self.used += len(rows)
        slots, end = self._slots(rows >> 24), len(self.held) - 1
        while len(rows):
            free = self.held[slots] < 0
            self.held[slots[free]] = rows[free]
            left = self.held[slots] != rows  # of several rows for one slot, the last one stays
            rows, slots = rows[left], (slots[left] + 1) & end

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values, -1 for keys that aren't held."""
        slots, end = self._slots(keys), len(self.held) - 1
        found = self.held[slots]
        at = np.flatnonzero((found >> 24 != keys) & (found >= 0))
        slots = slots[at]
        while len(at):
            slots = (slots + 1) & end
            found[at] = own = self.held[slots]
            more = (own >> 24 != keys[at]) & (own >= 0)
            at, slots = at[more], slots[more]
        return np.where(found >= 0, found & 0xFFFFFF, -1)


class Pieces:
    """A compiled model: ``encode`` and ``decode`` of texts."""

    def __init__(self, model: bytes, rules: dict[str, str] | None = None):
        self.pieces: list[str] = []
        self.scores: list[float] = []
        kinds: list[int] = []
        self.kind, self.fallback, self.prefix, self.squeeze = _UNIGRAM, False, True, True
        for field, value in _message(model):
            if field == 1:
                own = dict(_message(value))
                self.pieces.append(own[1].decode())
                self.scores.append(struct.unpack("<f", own[2])[0] if 2 in own else 0.0)
                kinds.append(own.get(3, _NORMAL))
            elif field == 2:
                own = dict(_message(value))
                self.kind, self.fallback = own.get(3, _UNIGRAM), bool(own.get(35, 0))
            elif field == 3:
                own = dict(_message(value))
                self.prefix, self.squeeze = bool(own.get(3, 1)), bool(own.get(4, 1))
                if own.get(2) and rules is None:
                    raise ValueError("give this model's normalisation as rules: its compiled table isn't read")
        if self.kind not in (_UNIGRAM, _BPE):
            raise ValueError("unigram and BPE models only")
        self.rules = rules or {}
        self.rule = re.compile("|".join(map(re.escape, sorted(self.rules, key=len, reverse=True)))) if self.rules else None
        self.unknown = kinds.index(_UNKNOWN)
        self.bytes_ids = {int(p[1:-1], 16): i for i, (p, k) in enumerate(zip(self.pieces, kinds)) if k == _BYTE}
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, kinds)) if k in (_NORMAL, _USER)}
        self.surface = [bytes([int(p[1:-1], 16)]) if k == _BYTE else b" \xe2\x81\x87 " if k == _UNKNOWN
                        else b"" if k == _CONTROL else p.replace(SPACE, " ").encode() for p, k in zip(self.pieces, kinds)]
        self.arcs: list[dict[str, int]] = [{}]
        self.final = [-1]
        for piece, number in self.ids.items():
            node = 0
            for c in piece:
                if c not in self.arcs[node]:
                    self.arcs[node][c] = len(self.arcs)
                    self.arcs.append({})
                    self.final.append(-1)
                node = self.arcs[node][c]
            self.final[node] = number
        held = {c for p in self.ids if len(p) > 1 for c in p}
        whole = any(SPACE in p.lstrip(SPACE) for p in self.ids)
        # cut before a space that follows another character, and around line ends if no piece holds one
        self.cuts = [] if whole else [SPACE] if "\n" in held else [SPACE, "\n"]
        self.least = min(self.scores, default=0.0) - 10.0
        self.joins: dict[int, float] = {}
        self.lattice: _Lattice | None = None

    def normalise(self, text: str) -> str:
        if self.rule:
            text = self.rule.sub(lambda m: self.rules[m.group()], text)
        if self.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        if text and self.prefix:
            text = " " + text
        return text.replace(" ", SPACE)

    def merged(self, text: str) -> list[str]:
        """``text`` after all merges, best score first, leftmost first among equals."""
        parts = list(text)
        while len(parts) > 1:
            found = [(-self.scores[i], at) for at in range(len(parts) - 1)
                     if (i := self.ids.get(parts[at] + parts[at + 1])) is not None]
            if not found:
                break
            at = min(found)[1]
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def join(self, left: int, right: int) -> float:
        """Weight of ``right`` after ``left`` (-1: at the start or after a fallback arc)."""
        key = (left + 1) << 32 | right
        weight = self.joins.get(key)
        if weight is None:
            if len(self.joins) >= REMEMBERED:
                self.joins.clear()
            own = [self.pieces[i] for i in (left, right) if i >= 0]
            both = "".join(own)
            fits = (left < 0 or both not in self.ids) and self.merged(both) == own
            weight = self.joins[key] = 0.0 if fits else inf
        return weight

    def _arcs_from(self, word: str, i: int) -> list[tuple[int, int]]:
        """(end, piece) of the arcs that leave position i, by length; piece -1 falls back."""
        arcs, final, node, found = self.arcs, self.final, 0, []
        for j in range(i, len(word)):
            node = arcs[node].get(word[j], 0)
            if not node:
                break
            if final[node] >= 0:
                found.append((j + 1, final[node]))
        return found if word[i] in self.ids else [(i + 1, -1), *found]

    def _joined_path(self, word: str) -> list[tuple[int, int, int]]:
        """The path whose joins all weigh 0, as (start, end, piece)."""
        n, path, dead, at, last = len(word), [], set(), 0, -1
        left = [self._arcs_from(word, 0)] if n else []
        while at < n:
            while left[-1]:
                end, piece = left[-1].pop()
                if end not in dead and (piece < 0 or self.join(last, piece) == 0.0):
                    path.append((at, end, piece))
                    at, last = end, piece
                    left.append(self._arcs_from(word, at) if at < n else [])
                    break
            else:
                dead.add(at)  # a position is reached by one piece alone
                left.pop()
                at = path.pop()[0]
                last = path[-1][2] if path else -1
        return path

    def _weighted_path(self, word: str) -> list[tuple[int, int, int]]:
        n = len(word)
        weight = [0.0] + [inf] * n
        back: list[tuple[int, int, int]] = [(0, 0, -1)] * (n + 1)
        for i in range(n):
            for end, piece in self._arcs_from(word, i):
                w = weight[i] - (self.scores[piece] if piece >= 0 else self.least)
                if w < weight[end]:
                    weight[end], back[end] = w, (i, end, piece)
        path, at = [], n
        while at:
            path.append(back[at])
            at = back[at][0]
        return path[::-1]

    def _ids(self, word: str, path: list[tuple[int, int, int]]) -> list[int]:
        out: list[int] = []
        fell = False
        for start, end, piece in path:
            if piece >= 0:
                out.append(piece)
            elif self.fallback:
                out.extend(self.bytes_ids[b] for b in word[start:end].encode("utf-8", "surrogatepass"))
            elif not fell:  # characters without a piece in a row are one unknown
                out.append(self.unknown)
            fell = piece < 0
        return out

    def shortest(self, word: str) -> list[int]:
        """Ids on the path of least weight through the composition with ``word``."""
        return self._ids(word, self._joined_path(word) if self.kind == _BPE else self._weighted_path(word))

    def _word_starts(self, chars: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Places where the words of texts begin."""
        on = np.zeros(len(chars) + 1, dtype=bool)
        on[0] = on[ends] = True
        for c in self.cuts:
            same = chars == ord(c)
            on[1:-1] |= same[1:] > same[:-1]
            if c == "\n":
                on[1:-1] |= same[1:] < same[:-1]
        return np.flatnonzero(on[:-1])

    def _encode_words(self, chars: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of words that aren't empty, and the place and number of each word's."""
        starts = np.cumsum(lengths) - lengths
        kind = np.int32 if len(chars) < 1 << 28 else np.int64
        first, count, found, held = np.zeros(len(lengths), dtype=kind), np.zeros(len(lengths), dtype=kind), [], 0
        alone = [np.arange(len(lengths))]
        if self.kind == _BPE:
            if self.lattice is None:
                self.lattice = _Lattice(self)
            alone = [np.flatnonzero(lengths > SHORT)]
            short = np.flatnonzero(lengths <= SHORT)
            short = short[np.argsort(lengths[short].astype(np.int8), kind="stable")]
            sizes = np.cumsum(lengths[short])
            cuts = np.searchsorted(sizes, np.arange(WORDS, sizes[-1] if len(sizes) else 0, WORDS))
            for some in np.split(short, cuts):
                if len(some):
                    ids, n, odd = self.lattice.encode(chars[_ranges(starts[some], lengths[some])], lengths[some])
                    first[some], count[some] = held + np.cumsum(n) - n, n
                    alone.append(some[odd])
                    found.append(ids)
                    held += len(ids)
        for i in np.concatenate(alone).tolist():
            word = chars[starts[i]:starts[i] + lengths[i]].tobytes().decode("utf-32-le", "surrogatepass")
            ids = np.array(self.shortest(word), dtype=np.int32)
            first[i], count[i] = held, len(ids)
            found.append(ids)
            held += len(ids)
        return np.concatenate([*found, np.zeros(0, dtype=np.int32)]), first, count

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts, one after another, and where each text's begin and the last ones end."""
        normal = [self.normalise(t) for t in texts]
        chars, ends = _characters(normal), np.cumsum([0, *map(len, normal)])
        if not len(chars):
            return np.zeros(0, dtype=np.int32), ends
        starts = self._word_starts(chars, ends)
        narrow = chars.astype(np.uint16) if chars.max() < 1 << 16 else chars
        places = np.append(starts, len(chars)) * narrow.itemsize
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(narrow)]).dictionary_encode()
        own = words.dictionary
        bounds = np.frombuffer(own.buffers()[1], dtype=np.int64)[own.offset:own.offset + len(own) + 1] // narrow.itemsize
        distinct = np.frombuffer(own.buffers()[2], dtype=narrow.dtype)[bounds[0]:bounds[-1]].astype("<u4")
        at, before = words.indices.to_numpy(), np.searchsorted(starts, ends)
        bounds = bounds - bounds[0]
        del normal, chars, starts, places, narrow, words, own
        ids, first, count = self._encode_words(distinct, np.diff(bounds))
        counts = count[at]
        return ids[_ranges(first[at], counts)], np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])[before]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def decode(self, ids) -> str:
        surface = self.surface
        data = b"".join(map(surface.__getitem__, ids))
        if self.prefix and data.startswith(b" ") and len(ids) and self.pieces[ids[0]].startswith(SPACE):
            data = data[1:]
        return data.decode("utf-8", "replace")


class _Lattice:
    """The composition of many words with a BPE model's pieces at once."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        chars = {c: i for i, c in enumerate(dict.fromkeys(c for p in pieces.ids for c in p), 1)}
        self.size = len(chars) + 1
        self.codes = np.zeros(0x110000, dtype=np.int32)  # 0: in no piece
        self.codes[[ord(c) for c in chars]] = list(chars.values())
        self.arcs, arcs = _Table(), [(node * self.size + chars[c], to) for node, own in enumerate(pieces.arcs) for c, to in own.items()]
        self.arcs.add(*(np.array(x, dtype=np.int64) for x in (zip(*arcs) if arcs else ((), ()))))
        self.final = np.array(pieces.final, dtype=np.int64)
        # symbols: pieces by id, then characters
        n = len(pieces.pieces)
        self.symbols = n + self.size
        self.symbol = np.arange(self.size, dtype=np.int64) + n
        self.single = np.zeros(self.size, dtype=bool)
        for c, i in chars.items():
            if c in pieces.ids:
                self.symbol[i], self.single[i] = pieces.ids[c], True
        symbol = {c: n + i for c, i in chars.items()} | pieces.ids
        pairs = [(symbol[p[:k]] * self.symbols + symbol[p[k:]], i) for p, i in pieces.ids.items() for k in range(1, len(p))
                 if p[:k] in symbol and p[k:] in symbol]
        self.pairs = _Table()
        self.pairs.add(*(np.array(x, dtype=np.int64) for x in (zip(*pairs) if pairs else ((), ()))))
        self.rank = np.unique(-np.array(pieces.scores), return_inverse=True)[1].astype(np.int64)
        self.joins = _Table()
        # a piece that its own merges don't give has no join that fits
        held = np.array(sorted(pieces.ids.values()), dtype=np.int64)
        self.lengths = np.array([len(p) for p in pieces.pieces], dtype=np.int64)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.text = self.symbol[self.codes[_characters(pieces.pieces)]]
        good = self._fit(np.full(len(held), -1, dtype=np.int64), held)
        whole = np.zeros(n + 1, dtype=bool)
        whole[held[good]] = True
        self.final[~whole[self.final]] = -1

    def _merged(self, symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of texts (``owner``, from 0 upwards) after all merges, best score first, leftmost
        first among equals, and their texts."""
        never = 1 << 62

        def order(at: np.ndarray) -> np.ndarray:
            """When the pairs at these places merge, if they do."""
            to = self.pairs.get(symbols[at] * self.symbols + symbols[at + 1])
            return np.where((to >= 0) & (owner[at] == owner[at + 1]), self.rank[to], never)

        done: list[tuple[np.ndarray, np.ndarray]] = []
        when = np.append(order(np.arange(len(symbols) - 1)), never)
        while len(symbols):
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            best = np.minimum.reduceat(when, starts)
            over = np.repeat(best == never, np.diff(np.append(starts, len(owner))))
            if over.any():
                done.append((symbols[over], owner[over]))
                symbols, owner, when = symbols[~over], owner[~over], when[~over]
                if not len(symbols):
                    break
                best = best[best != never]
                starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            lengths = np.diff(np.append(starts, len(owner)))
            hits = np.flatnonzero(when == np.repeat(best, lengths))
            hits = hits[np.append(True, owner[hits[1:]] != owner[hits[:-1]])]  # the leftmost of each text
            symbols[hits] = self.pairs.get(symbols[hits] * self.symbols + symbols[hits + 1])
            keep = np.ones(len(symbols), dtype=bool)
            keep[hits + 1] = False
            symbols, owner, when = symbols[keep], owner[keep], when[keep]
            hits -= np.arange(len(hits))
            changed = np.concatenate([hits, hits[1:] - 1, hits[:1][hits[:1] > 0] - 1])
            when[changed[changed == len(symbols) - 1]] = never
            changed = changed[changed < len(symbols) - 1]
            when[changed] = order(changed)
        if not done:
            return symbols, owner
        symbols, owner = (np.concatenate(x) for x in zip(*done))
        by = np.argsort(owner, kind="stable")
        return symbols[by], owner[by]

    def _fit(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the merges of the joined texts give the two pieces back (left -1: the one)."""
        if not len(left):
            return np.zeros(0, dtype=bool)
        sides = np.stack([left, right], axis=1).ravel()
        lengths = np.where(sides >= 0, self.lengths[sides], 0)
        symbols, owner = self._merged(self.text[_ranges(self.offsets[sides], lengths)], np.repeat(np.arange(len(sides)) >> 1, lengths))
        firsts = np.searchsorted(owner, np.arange(len(left)))
        count = np.diff(np.append(firsts, len(owner)))
        two = left >= 0
        return np.where(two, (count == 2) & (symbols[firsts] == left), count == 1) & (symbols[firsts + count - 1] == right)

    def _joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the join of the pieces weighs 0; left -1: at the start or after a fallback arc."""
        n = len(self.lengths)
        keys = (left + 1) * n + right
        known = self.joins.get(keys)
        at = np.flatnonzero(known < 0)
        if len(at):
            new, back = np.unique(keys[at], return_inverse=True)
            fits = self._fit(new // n - 1, new % n)
            known[at] = fits[back]
            if self.joins.used + len(new) > REMEMBERED:
                self.joins.clear()
            if len(new) <= REMEMBERED:
                self.joins.add(new, fits.astype(np.int64))
        return known > 0

    def encode(self, chars: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of words that aren't empty, the number of each word's, and the words that must be searched alone."""
        codes = self.codes[chars].astype(np.int64)
        words, ends = len(lengths), np.cumsum(lengths)
        starts = ends - lengths
        end, start = np.repeat(ends, lengths), np.repeat(starts, lengths)

        # arcs: from a place to a later one, with a piece
        place = np.arange(len(codes))
        node = np.where(codes > 0, self.arcs.get(codes), -1).astype(np.int64)
        fall = np.flatnonzero(~self.single[codes])
        begins, stops, labels = [fall], [fall + 1], [np.full(len(fall), -1, dtype=np.int64)]
        depth = 1
        while True:
            on = node > 0
            place, node = place[on], node[on]
            if not len(place):
                break
            piece = self.final[node]
            hit = piece >= 0
            begins.append(place[hit])
            stops.append(place[hit] + depth)
            labels.append(piece[hit])
            on = place + depth < end[place]
            place, node = place[on], node[on]
            code = codes[place + depth]
            node = np.where(code > 0, self.arcs.get(node * self.size + code), -1).astype(np.int64)
            depth += 1
        begin, stop, label = (np.concatenate(x) for x in (begins, stops, labels))

        # states lie between characters: a word's are its places and one more
        word = np.repeat(np.arange(words), lengths)
        step = (stop - start[begin]).astype(np.int8)
        by = np.argsort(step, kind="stable")
        own = word[begin[by]]
        begin, stop, label = begin[by] + own, stop[by] + own, label[by]
        bounds = np.append(starts, len(codes)) + np.arange(words + 1)
        last = np.full(len(codes) + words, -2, dtype=np.int64)
        last[bounds[:-1]] = -1
        back, mark = np.zeros(len(last), dtype=np.int64), np.zeros(len(last), dtype=np.int64)
        odd = np.zeros(words, dtype=bool)
        high = 0
        for count in np.bincount(step).tolist():
            low, high = high, high + count
            before, piece = last[begin[low:high]], label[low:high]
            good = before > -2
            real = np.flatnonzero(good & (piece >= 0))
            good[real] = self._joined(before[real], piece[real])
            good = np.flatnonzero(good)
            to = stop[low:high][good]
            last[to], back[to], mark[to] = piece[good], begin[low:high][good], good
            odd[own[low:high][good[mark[to] != good]]] = True
        odd |= last[bounds[1:] - 1] < -1

        on = np.zeros(len(last), dtype=bool)
        at, floor = (bounds[1:] - 1)[~odd], bounds[:-1][~odd]
        while len(at):
            on[at] = True
            at = back[at]
            more = at > floor
            at, floor = at[more], floor[more]
        path = np.flatnonzero(on)
        ids, owner = last[path].astype(np.int32), np.searchsorted(bounds, path, side="right") - 1
        fell = np.flatnonzero(ids < 0)
        if len(fell):
            ids, owner = self._fallen(ids, owner, fell, chars[path[fell] - owner[fell] - 1])
        return ids, np.bincount(owner, minlength=words), np.flatnonzero(odd)

    def _fallen(self, ids: np.ndarray, owner: np.ndarray, fell: np.ndarray, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their words with the characters at ``fell`` written as bytes, or a run of them as one unknown."""
        model = self.pieces
        if not model.fallback:
            ids[fell] = model.unknown
            keep = np.ones(len(ids), dtype=bool)
            keep[fell[1:][(np.diff(fell) == 1) & (owner[fell[1:]] == owner[fell[:-1]])]] = False
            return ids[keep], owner[keep]
        kinds, at = np.unique(chars, return_inverse=True)
        own = [[model.bytes_ids[b] for b in chr(c).encode("utf-8", "surrogatepass")] for c in kinds.tolist()]
        size = np.array([len(x) for x in own])
        count = np.ones(len(ids), dtype=np.int64)
        count[fell] = size[at]
        ids, owner = np.repeat(ids, count), np.repeat(owner, count)
        places = (np.cumsum(count) - count)[fell]
        ids[_ranges(places, size[at])] = np.concatenate(own)[_ranges((np.cumsum(size) - size)[at], size[at])]
        return ids, owner


def load(model_path: str, rules: dict[str, str] | None = None) -> Pieces:
    with open(model_path, "rb") as f:
        return Pieces(f.read(), rules)


def _shared(docs: DataFrame, pieces: Pieces):
    """A function that gives the workers ``pieces``, built once a worker: a broadcast variable
    outlives the tasks, and with it the words remembered."""
    sent = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(pieces))

    def get() -> Pieces:
        if not hasattr(sent, "built"):
            sent.built = cloudpickle.loads(sent.value)
        return sent.built

    return get


def encode(docs: DataFrame, pieces: Pieces, text: str = "text") -> DataFrame:
    """The input columns in a struct ``doc``, with ``ids`` and ``same`` (whether they decode to the text)."""
    get = _shared(docs, pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = get()
        for batch in batches:
            texts, held, first = [], 0, 0
            for i, value in enumerate(batch.column("t"), 1):
                texts.append(value.as_py() or "")
                held += len(texts[-1])
                if held >= TEXTS or i == batch.num_rows:
                    ids, ends = own.encode_all(texts)
                    same = [own.decode(ids[a:b].tolist()) == t for a, b, t in zip(ends, ends[1:], texts)]
                    yield pa.record_batch([batch.column("doc").slice(first, len(texts)), pa.ListArray.from_arrays(ends.astype(np.int32), ids),
                                           pa.array(same, pa.bool_())], ["doc", "ids", "same"])
                    texts, held, first = [], 0, i

    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]) if len(docs.columns) > 1 else F.struct(F.lit(0).alias("_"))
    rows = docs.select(whole.alias("doc"), F.col(f"`{text}`").alias("t"))
    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc {kind}, ids array<int>, same boolean")


def decode(rows: DataFrame, pieces: Pieces, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``rows`` with the text of their ids; NULL ids give an empty text."""
    get = _shared(rows, pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = get()
        for batch in batches:
            texts = pa.array([own.decode(x.as_py() or []) for x in batch.column(ids)], pa.string())
            yield pa.record_batch([*batch.columns, texts], [*batch.schema.names, out])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{schema}, `{out}` string")


def sentencepiece_query(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    return encode(docs.select("doc_id", "text"), load(model_path or default_model())).select(
        "doc.doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.col("same").alias("round_trip"))
