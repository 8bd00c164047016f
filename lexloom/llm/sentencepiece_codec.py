"""SentencePiece encoding and decoding over an Aho-Corasick automaton of the pieces.

The automaton reads a text once; at each position its output links name every piece that ends there,
and each of them relaxes the position from the one where it starts.  For unigram models the position
keeps the best sum of scores (Viterbi).  A BPE model's scores are merge ranks, whose best sum is not
what the model means; there a position keeps the piece that may follow the piece kept at its start:
the one for which the model, given only these two pieces' characters, returns these two pieces.  A
sequence whose neighbours all agree is the model's own encoding, and there is exactly one, so the same
single pass gives the library's result.

Models are read from their own file; nothing of the library is used here.
"""

from __future__ import annotations

import heapq
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm.runtime import bounded_batches, session_of

SPACE = "▁"
# Fixed values of the model file: model types and piece types.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNKNOWN_PENALTY = 10.0
MEMO_WORDS = 300_000
MEMO_CHARS = 64
MEMO_PAIRS = 1_000_000
PAIR_SLOTS = 1 << 20
#: Words encoded together.
BATCH_WORDS = 20_000
#: Stands for a character that no piece has.
GAP = -3


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        shift = value = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        elif kind == 2:
            size = varint()
            yield tag >> 3, data[at : at + size]
            at += size
        else:
            size = {1: 8, 5: 4}[kind]
            yield tag >> 3, data[at : at + size]
            at += size


class BatchAutomaton:
    """The pieces' automaton as arrays, which reads many words at once, a character of each in a step."""

    def __init__(self, ids: dict[str, int]):
        #: Number of each character; the last entry, -1, stands for all characters without a piece.
        self.letters = np.full(max((ord(c) for p in ids for c in p), default=0) + 2, -1, np.int64)
        alphabet = sorted({c for p in ids for c in p})
        for k, c in enumerate(alphabet):
            self.letters[ord(c)] = k
        self.width = max(len(alphabet), 1)
        edges: dict[int, int] = {}
        piece, depth, parent = [-1], [0], [(0, 0)]
        for text, i in ids.items():
            state = 0
            for c in text:
                key = state * self.width + int(self.letters[ord(c)])
                state = edges.get(key, 0)
                if not state:
                    state = edges[key] = len(piece)
                    piece.append(-1)
                    depth.append(depth[key // self.width] + 1)
                    parent.append(divmod(key, self.width))
            piece[state] = i
        fail, out = [0] * len(piece), [0] * len(piece)
        for state in sorted(range(1, len(piece)), key=depth.__getitem__):
            above, letter = parent[state]
            if above:
                back = fail[above]
                while (back * self.width + letter) not in edges and back:
                    back = fail[back]
                fail[state] = edges.get(back * self.width + letter, 0)
            out[state] = fail[state] if piece[fail[state]] >= 0 else out[fail[state]]
        self.keys = np.array(sorted(edges), np.int64)
        self.targets = np.array([edges[k] for k in self.keys.tolist()], np.int64)
        self.piece, self.depth, self.fail, self.out = (np.array(x, np.int64) for x in (piece, depth, fail, out))

    def step(self, state: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """States after one more character; failure links are followed where a state has no such edge."""
        to = np.zeros(len(state), np.int64)
        left = np.arange(len(state))
        at = state
        while len(left):
            key = at * self.width + letter[left]
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = (self.keys[place] == key) & (letter[left] >= 0)
            to[left[hit]] = self.targets[place[hit]]
            go = ~hit & (at > 0)
            left, at = left[go], self.fail[at[go]]
        return to


class CharacterMap:
    """A model's normalisation rules: a double-array trie over UTF-8 whose values are offsets of the replacements.

    At each position the longest source that the trie holds gives way to its replacement; a character
    where none begins stays.  ``kept`` strings are never changed.
    """

    def __init__(self, blob: bytes, kept: list[str] | None = None):
        size = int.from_bytes(blob[:4], "little")
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
        self.strings = blob[4 + size :]
        self.kept = regex.compile("|".join(regex.escape(k) for k in sorted(kept, key=len, reverse=True))) if kept else None
        #: For characters met so far: whether a source begins with them.
        self.begins: dict[str, bool] = {}

    @staticmethod
    def _offset(unit: int) -> int:
        return unit >> 10 << ((unit & 1 << 9) >> 6)

    def longest(self, data: bytes, at: int) -> tuple[int, int | None, int]:
        """(bytes, replacement's offset) of the longest source at ``at``, and how many bytes have an edge."""
        node = self._offset(self.units[0])
        found, size = None, 0
        for k in range(at, len(data)):
            node ^= data[k]
            unit = self.units[node] if node < len(self.units) else 0
            if unit & (1 << 31 | 255) != data[k]:
                return size, found, k - at
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                found, size = self.units[node] & (1 << 31) - 1, k - at + 1
        return size, found, len(data) - at

    def replaced(self, text: str) -> str:
        for c in set(text) - self.begins.keys():
            data = c.encode()
            self.begins[c] = self.longest(data, 0)[2] == len(data)
        if not any(map(self.begins.__getitem__, set(text))):
            return text
        data, out, at, plain = text.encode(), [], 0, 0
        while at < len(data):
            size, value, _ = self.longest(data, at)
            if value is None:
                at += 1
                while at < len(data) and data[at] & 0xC0 == 0x80:
                    at += 1
                continue
            out += [data[plain:at], self.strings[value : self.strings.index(b"\0", value)]]
            plain = at = at + size
        return b"".join([*out, data[plain:]]).decode()

    def normalised(self, text: str) -> str:
        if not self.kept:
            return self.replaced(text)
        out, at = [], 0
        for m in self.kept.finditer(text):
            out += [self.replaced(text[at : m.start()]), m.group()]
            at = m.end()
        return "".join([*out, self.replaced(text[at:])])


@dataclass
class Model:
    """Pieces with scores and types, and the switches of the normaliser."""

    pieces: list[tuple[str, float, int]]
    kind: int = UNIGRAM
    byte_fallback: bool = False
    dummy_prefix: bool = True
    squeeze_spaces: bool = True
    charsmap: bytes = b""
    memo: dict[str, bytes] = field(default_factory=dict, repr=False)

    @staticmethod
    def read(path: str) -> Model:
        with open(path, "rb") as f:
            top = list(_fields(f.read()))
        pieces = []
        for number, value in top:
            if number == 1:
                own = dict(_fields(value))
                pieces.append((own.get(1, b"").decode(), struct.unpack("<f", own[2])[0] if 2 in own else 0.0, own.get(3, NORMAL)))
        trainer = dict(next((_fields(v) for n, v in top if n == 2), iter(())))
        norm = dict(next((_fields(v) for n, v in top if n == 3), iter(())))
        return Model(pieces, trainer.get(3, UNIGRAM), bool(trainer.get(35, 0)), bool(norm.get(3, 1)), bool(norm.get(4, 1)), norm.get(2, b""))

    def __post_init__(self) -> None:
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are supported")
        self.map = CharacterMap(self.charsmap, [p for p, _, kind in self.pieces if kind == USER]) if self.charsmap else None
        self.ids = {p: i for i, (p, _, kind) in enumerate(self.pieces) if kind in (NORMAL, USER)}
        self.scores = [s for _, s, _ in self.pieces]
        self.score_array = np.array(self.scores)
        #: What each piece shows on its own, and the pieces that show nothing on their own: bytes of longer characters.
        self.shown = [chr(int(p[3:5], 16)) if kind == BYTE and p < "<0x8" else " ⁇ " if kind == UNKNOWN else "" if kind == CONTROL else p.replace(SPACE, " ") for p, _, kind in self.pieces]
        self.uncommon = frozenset(i for i, (p, _, kind) in enumerate(self.pieces) if kind == BYTE and p >= "<0x8")
        self.unknown = next((i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN), 0)
        self.bytes = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(self.pieces) if kind == BYTE}
        usable = [s for _, s, kind in self.pieces if kind == NORMAL]
        self.unknown_score = min(usable, default=0.0) - UNKNOWN_PENALTY
        #: No piece goes on past a space, so stretches that start with spaces are encoded one by one.
        self.by_word = not any(SPACE in p.lstrip(SPACE) for p in self.ids) and not any(kind == USER for _, _, kind in self.pieces)
        self.singles = frozenset(p for p in self.ids if len(p) == 1)
        self.agree: dict[int, bool] = {}
        self.known_pair = np.full(PAIR_SLOTS, -1, np.int64)
        self.pair_agrees = np.zeros(PAIR_SLOTS, bool)

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        out = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            out.add_word(piece, (len(piece), i))
        if self.ids:
            out.make_automaton()
        return out

    @cached_property
    def batch(self) -> BatchAutomaton | None:
        return BatchAutomaton(self.ids) if self.ids else None

    # --- encoding ---------------------------------------------------------------------------------

    def normalised(self, text: str) -> str:
        if self.map:
            text = self.map.normalised(text)
        if self.squeeze_spaces:
            text = " ".join(x for x in text.split(" ") if x)
        if not text:
            return ""
        return ((SPACE if self.dummy_prefix else "") + text).replace(" ", SPACE)

    def encode(self, text: str | None) -> list[int]:
        """Ids of ``text``; null and empty texts have none."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str | None]) -> list[list[int]]:
        """Ids of each text."""
        return [np.frombuffer(x, np.int32).tolist() for x in self.encode_packed(texts)]

    def encode_packed(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as 32-bit numbers.  Words not met lately are encoded together."""
        whole = [self.normalised(t or "") for t in texts]
        if not self.by_word:
            return [packed(self.encode_stretch(t)) if t else b"" for t in whole]
        stretches = [self.stretches(t) for t in whole]
        memo = self.memo
        fresh = list(set().union(*stretches) - memo.keys())
        for at in range(0, len(fresh), BATCH_WORDS):
            some = fresh[at : at + BATCH_WORDS]
            memo.update(zip(some, self.encode_words(some), strict=True))
        out = [b"".join(map(memo.__getitem__, part)) for part in stretches]
        for w in fresh:
            if len(w) > MEMO_CHARS:
                del memo[w]
        if len(memo) > MEMO_WORDS:
            self.memo = {w: memo[w] for w in set().union(*stretches) & memo.keys()} if len(fresh) < MEMO_WORDS else {}
        return out

    @staticmethod
    def stretches(text: str) -> list[str]:
        """``text`` cut before each run of spaces."""
        if not text:
            return []
        first, *words = text.split(SPACE)
        if SPACE + SPACE not in text and words and words[-1]:
            out = [SPACE + w for w in words]
            return [first, *out] if first else out
        out, lead = [first] if first else [], ""
        for word in words:
            lead += SPACE
            if word:
                out.append(lead + word)
                lead = ""
        return [*out, lead] if lead else out

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word, all read by the automaton in step; odd ones go one by one."""
        out = [b""] * len(words)
        plain = [k for k, w in enumerate(words) if len(w) <= MEMO_CHARS] if self.batch else []
        for k in set(range(len(words))).difference(plain):
            out[k] = packed(self.encode_stretch(words[k]))
        if not plain:
            return out
        plain.sort(key=lambda k: -len(words[k]))
        sizes = np.array([len(words[k]) for k in plain])
        longest, n, auto = int(sizes[0]), len(plain), self.batch
        points = np.frombuffer("".join(words[k] for k in plain).encode("utf-32-le"), np.uint32)
        flat = auto.letters[np.minimum(points, len(auto.letters) - 1)]
        begins = np.cumsum(sizes) - sizes
        kept = np.full((longest + 1, n), -1, np.int64)
        length = np.zeros((longest + 1, n), np.int64)
        best = np.full((longest + 1, n), -np.inf)
        kept[0], best[0] = -2, 0
        state = np.zeros(n, np.int64)
        for t in range(1, longest + 1):
            m = int(np.searchsorted(-sizes, -t, side="right"))
            letter = flat[begins[:m] + t - 1]
            state = auto.step(state[:m], letter)
            link = np.where(auto.piece[state] >= 0, state, auto.out[state])
            wait = np.flatnonzero(link)
            link = link[wait]
            while len(wait):
                piece, size = auto.piece[link], auto.depth[link]
                left = kept[t - size, wait]
                if self.kind == UNIGRAM:
                    score = np.where(left == -1, -np.inf, best[t - size, wait] + self.score_array[piece])
                    take = score > best[t, wait]
                    best[t, wait[take]] = score[take]
                    go = np.ones(len(wait), bool)
                else:
                    take = left != -1
                    take[take] = self.follow_all(left[take], piece[take])
                    go = ~take
                kept[t, wait[take]], length[t, wait[take]] = piece[take], size[take]
                wait, link = wait[go], auto.out[link[go]]
                wait, link = wait[link > 0], link[link > 0]
            alone = np.flatnonzero((letter < 0) & (kept[t - 1, :m] != -1))
            kept[t, alone], length[t, alone], best[t, alone] = GAP, 1, best[t - 1, alone] + self.unknown_score
        at, row, parts = sizes.copy(), np.arange(n), []
        bad = np.zeros(n, bool)
        while len(row):
            got = kept[at[row], row]
            bad[row[got == -1]] = True
            row, got = row[got != -1], got[got != -1]
            parts.append((row, got))
            at[row] -= length[at[row], row]
            row = row[at[row] > 0]
        rows, ids = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
        order = np.lexsort((-np.arange(len(rows)), rows))
        data, ends = ids[order].astype(np.int32).tobytes(), (np.cumsum(np.bincount(rows, minlength=n)) * 4).tolist()
        begin = 0
        for k, end in zip(plain, ends, strict=True):
            out[k] = data[begin:end]
            begin = end
        for k in np.flatnonzero(bad).tolist():
            out[plain[k]] = packed(self.encode_stretch(words[plain[k]]))
        for k in np.unique(rows[np.concatenate([p[1] for p in parts]) == GAP]).tolist():
            if not bad[k]:
                word, parts_, place = words[plain[k]], [], 0
                for i in np.frombuffer(out[plain[k]], np.int32).tolist():
                    parts_.append((place, max(i, -1)))
                    place += 1 if i == GAP else len(self.pieces[i][0])
                out[plain[k]] = packed(self.resolve(word, parts_))
        return out

    def follow_all(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``follows`` of many pairs, through a table of fixed size that keeps the latest pair of each slot."""
        key = (left + 3) * len(self.pieces) + right
        slot = (key * 0x9E3779B1 >> 7) & (PAIR_SLOTS - 1)
        miss = np.flatnonzero(self.known_pair[slot] != key)
        if not len(miss):
            return self.pair_agrees[slot]
        out = self.pair_agrees[slot]
        own, first, back = np.unique(key[miss], return_index=True, return_inverse=True)
        answers = np.array([self.apart(a, b) for a, b in zip(left[miss[first]].tolist(), right[miss[first]].tolist(), strict=True)])
        out[miss] = answers[back]
        self.known_pair[slot[miss[first]]] = own
        self.pair_agrees[slot[miss[first]]] = answers
        return out

    def encode_stretch(self, text: str) -> list[int]:
        return self.resolve(text, self.viterbi(text) if self.kind == UNIGRAM else self.chain(text))

    def ends(self, text: str) -> Iterator[tuple[int, list[tuple[int, int]]]]:
        """(position, pieces that end there as (characters, id), longest first), one pass over ``text``."""
        at, found = 1, []
        for end, match in self.automaton.iter(text) if self.ids else ():
            while end + 1 > at:
                yield at, found
                at, found = at + 1, []
            found.append(match)
        while at <= len(text):
            yield at, found
            at, found = at + 1, []

    def viterbi(self, text: str) -> list[tuple[int, int]]:
        """(start, id) of the pieces with the best sum of scores; a character without a piece has id -1."""
        best = [0.0] + [float("-inf")] * len(text)
        kept: list[tuple[int, int]] = [(0, -1)] * (len(text) + 1)
        for at, found in self.ends(text):
            single = False
            for size, i in found:
                single |= size == 1
                score = best[at - size] + self.scores[i]
                if score > best[at]:
                    best[at], kept[at] = score, (at - size, i)
            if not single and best[at - 1] + self.unknown_score > best[at]:
                best[at], kept[at] = best[at - 1] + self.unknown_score, (at - 1, -1)
        return self.walk(kept, len(text))

    def chain(self, text: str) -> list[tuple[int, int]]:
        """The same for BPE: at each position the piece that agrees with the one kept at its start.

        A character that no piece has stands alone and ends what may merge.
        """
        kept: list[tuple[int, int] | None] = [(0, -2)] + [None] * len(text)
        for at, found in self.ends(text):
            for size, i in found:
                before = kept[at - size]
                if before and self.follows(before[1], i):
                    kept[at] = (at - size, i)
                    break
            if kept[at] is None and text[at - 1] not in self.ids:
                kept[at] = (at - 1, -1)
        if any(k is None for k in kept):
            return self.merge(text)
        return self.walk(kept, len(text))

    @staticmethod
    def walk(kept: list, at: int) -> list[tuple[int, int]]:
        out = []
        while at:
            start, i = kept[at]
            out.append((start, i))
            at = start
        return out[::-1]

    def follows(self, left: int, right: int) -> bool:
        """``apart`` with a memory."""
        key = left * len(self.pieces) + right
        found = self.agree.get(key)
        if found is None:
            if len(self.agree) >= MEMO_PAIRS:
                self.agree.clear()
            found = self.agree[key] = self.apart(left, right)
        return found

    def apart(self, left: int, right: int) -> bool:
        """Whether the model leaves these two pieces apart, and each whole; left below 0: nothing to merge with."""
        a, b = self.pieces[left][0] if left >= 0 else "", self.pieces[right][0]
        return [i for _, i in self.merge(a + b)] == ([left, right] if left >= 0 else [right])

    def merge(self, text: str) -> list[tuple[int, int]]:
        """BPE by its definition: the best-scored neighbours first, from the left among equals."""
        start = list(range(len(text)))
        size = [1] * len(text)
        after = [*range(1, len(text)), -1]
        before = [-1, *range(len(text) - 1)]
        heap: list[tuple[float, int, int, int]] = []

        def offer(a: int) -> None:
            b = after[a]
            if b >= 0 and (i := self.ids.get(text[a : a + size[a] + size[b]])) is not None:
                heapq.heappush(heap, (-self.scores[i], a, size[a], size[b]))

        for a in start:
            offer(a)
        while heap:
            _, a, x, y = heapq.heappop(heap)
            b = after[a]
            if size[a] != x or b < 0 or size[b] != y:
                continue
            size[a] += size[b]
            size[b] = 0
            after[a] = after[b]
            if after[b] >= 0:
                before[after[b]] = a
            offer(a)
            if before[a] >= 0:
                offer(before[a])
        return [(a, self.ids.get(text[a : a + size[a]], -1)) for a in start if size[a]]

    def resolve(self, text: str, parts: list[tuple[int, int]]) -> list[int]:
        """Ids; a character without a piece becomes its bytes, or the unknown id once for a run of them."""
        out: list[int] = []
        for start, i in parts:
            if i >= 0:
                out.append(i)
            elif self.byte_fallback:
                out += [self.bytes[b] for b in text[start].encode()]
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return out

    # --- decoding ---------------------------------------------------------------------------------

    def decode(self, ids: list[int] | None) -> str:
        """The text of ``ids``; bytes that form no character become U+FFFD, control pieces nothing."""
        if not self.uncommon.isdisjoint(ids or ()):
            text = self.decode_bytes(ids)
        else:
            text = "".join(map(self.shown.__getitem__, ids or ()))
        if not self.dummy_prefix or not text.startswith(" "):
            return text
        first = next(self.pieces[i] for i in ids if self.pieces[i][2] != CONTROL)
        return text[1:] if first[0].startswith(SPACE) else text

    def decode_bytes(self, ids: list[int]) -> str:
        """Pieces in a row, bytes put together to characters."""
        out, run = [], bytearray()

        def flush() -> None:
            # One replacement for each byte that belongs to no character.
            data = bytes(run)
            while data:
                try:
                    out.append(data.decode())
                    break
                except UnicodeDecodeError as e:
                    out.append(data[: e.start].decode() + "�")
                    data = data[e.start + 1 :]
            run.clear()

        for i in ids:
            piece, _, kind = self.pieces[i]
            if kind == BYTE:
                run.append(int(piece[3:5], 16))
                continue
            flush()
            if kind == UNKNOWN:
                out.append(" ⁇ ")
            elif kind != CONTROL:
                out.append(piece.replace(SPACE, " "))
        flush()
        return "".join(out)


def packed(ids: list[int]) -> bytes:
    return np.array(ids, np.int32).tobytes()


_models: dict[str, Model] = {}


def model(path: str) -> Model:
    if path not in _models:
        _models[path] = Model.read(path)
    return _models[path]


def encode(df: DataFrame, model_path: str, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """``df`` with ``out_col`` (array<int>); null and empty texts give an empty array, equal texts equal ones.

    An empty table stays empty, an existing ``out_col`` is replaced.  No shuffle.
    """
    bounded_batches(session_of(df))

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = model(model_path)
        for batch in batches:
            rows = m.encode_packed(batch.to_pylist())
            offsets = np.r_[0, np.cumsum([len(x) for x in rows])] // 4
            yield pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(np.frombuffer(b"".join(rows), np.int32)))

    return df.withColumn(out_col, ids(F.col(text_col)))


def encode_and_decode(df: DataFrame, model_path: str, text_col: str = "text", out_col: str = "coded") -> DataFrame:
    """``df`` with ``out_col``, struct(ids, decoded): ``encode`` and ``decode`` in one worker."""
    bounded_batches(session_of(df))

    @F.arrow_udf("ids array<int>, decoded string")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = model(model_path)
        for batch in batches:
            rows = m.encode_packed(batch.to_pylist())
            offsets = np.r_[0, np.cumsum([len(x) for x in rows])] // 4
            ids = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(np.frombuffer(b"".join(rows), np.int32)))
            texts = pa.array([m.decode(np.frombuffer(x, np.int32).tolist()) for x in rows], pa.string())
            yield pa.StructArray.from_arrays([ids, texts], names=["ids", "decoded"])

    return df.withColumn(out_col, both(F.col(text_col)))


def decode(df: DataFrame, model_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with ``out_col`` (string); null ids give an empty text.  No shuffle."""
    bounded_batches(session_of(df))

    @F.arrow_udf("string")
    def texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = model(model_path)
        for batch in batches:
            yield pa.array([m.decode(row.values.to_numpy(zero_copy_only=False).tolist() if row.is_valid else None) for row in batch], pa.string())

    return df.withColumn(out_col, texts(F.col(ids_col)))
