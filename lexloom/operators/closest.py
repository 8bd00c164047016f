"""The keys of a sorted list that are closest to names by difflib's ratio, found without comparing all with all."""

from __future__ import annotations

import difflib
from functools import cached_property

import numpy as np

#: A common subsequence is counted in one word of bits, so for names of this length at most.
WORD_BITS = 64
#: From this length on difflib leaves out frequent characters, so such strings are given to it.
JUNK_LENGTH = 200
#: Names searched for at a time, pairs compared at a time, nodes of trees visited at a time.
BATCH, PAIRS, MOST = 2048, 8192, 1 << 20
#: As many keys are scanned in the time of a visit of a node; a name's walks together visit what a scan would cost.
VISIT = 10
#: Times that a walk lowers its bound at most, and what a level of a walk and a scan cost, in keys that are scanned.
STEPS, LEVEL, SCAN = 8, 2000, 10_000
#: Shares of the keys before those that a walk visits first, next and last.
SHARES = (0.97, 0.8, 0)
#: Letters of a gram, at 7 bits each.
GRAM = 9
ONES = ~np.uint64(0)
#: Words whose lowest i bits are set.
LOW = np.array([(1 << i) - 1 for i in range(WORD_BITS + 1)], np.uint64)


class Texts:
    """ASCII strings one after another, with where each begins and ends."""

    def __init__(self, strings: list[str]) -> None:
        self.strings = strings
        self.text = np.frombuffer("".join(strings).encode("ascii"), np.uint8)
        self.lengths = np.fromiter(map(len, strings), np.int64, len(strings))
        self.end = np.cumsum(self.lengths)
        self.begin = self.end - self.lengths

    def __len__(self) -> int:
        return len(self.strings)

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """(code, number of the string) of each GRAM characters in a row; equal codes are equal characters."""
        count = np.maximum(self.lengths - GRAM + 1, 0)
        owner = np.repeat(np.arange(len(self)), count)
        at = ramps(self.begin, count)
        code = np.zeros(len(at), np.uint64)
        for i in range(GRAM):
            code = code << np.uint64(7) | self.text[at + i]
        return code, owner


def ramps(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, ``count`` numbers of it."""
    return np.arange(count.sum()) + np.repeat(start - np.cumsum(count) + count, count)


def matched(left: np.ndarray, a0: np.ndarray, a1: np.ndarray, right: np.ndarray, b0: np.ndarray, b1: np.ndarray) -> np.ndarray:
    """Characters in the matching blocks of difflib's SequenceMatcher for many pairs left[a0:a1], right[b0:b1].

    The longest block, the first of several in the left string, then in the right one, parts a pair into one before it
    and one after it.  Both strings of a pair are shorter than JUNK_LENGTH.
    """
    out = np.zeros(len(a0), np.int64)
    items = np.stack([np.arange(len(a0)), a0, a1, b0, b1])
    while True:
        items = items[:, (items[2] > items[1]) & (items[4] > items[3])]
        if not items.shape[1]:
            return out
        size = np.maximum(items[2] - items[1], items[4] - items[3])
        order = np.argsort(size, kind="stable")
        items, size = items[:, order], size[order]
        parts, at = [], 0
        while at < items.shape[1]:
            widest = int(size[min(at + PAIRS, len(size)) - 1])
            some = items[:, at : at + max(1, min(PAIRS, (1 << 23) // widest**2))]
            at += some.shape[1]
            pair, a0, a1, b0, b1 = some
            i, j, k = longest(left, a0, a1, right, b0, b1)
            np.add.at(out, pair, k)
            parts += [x[:, k > 0] for x in (np.stack([pair, a0, i, b0, j]), np.stack([pair, i + k, a1, j + k, b1]))]
        items = np.concatenate(parts, axis=1)


def longest(left: np.ndarray, a0: np.ndarray, a1: np.ndarray, right: np.ndarray, b0: np.ndarray, b1: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(where in left, where in right, length) of each pair's longest block, pairs side by side in the last axis."""
    n, wide, high = len(a0), int((a1 - a0).max()), int((b1 - b0).max())
    at, to = a0 + np.arange(wide)[:, None], b0 + np.arange(high)[:, None]
    a = np.where(at < a1, left[np.minimum(at, len(left) - 1)], 0).astype(np.uint8)
    b = np.where(to < b1, right[np.minimum(to, len(right) - 1)], 255).astype(np.uint8)
    # runs[i, j]: length of the block that ends before the i-th character of a and the j-th of b.
    runs, best = np.zeros((wide + 1, high + 1, n), np.uint8), np.empty((wide, n), np.uint8)
    for i in range(wide):
        np.add(runs[i, :-1], 1, out=runs[i + 1, 1:])
        runs[i + 1, 1:] *= (b == a[i]).view(np.uint8)
        runs[i + 1].max(axis=0, out=best[i])
    i = best.argmax(axis=0)
    k = best[i, np.arange(n)]
    j = (runs[i + 1, :, np.arange(n)] == k[:, None]).argmax(axis=1)
    k = k.astype(np.int64)
    return a0 + i + 1 - k, b0 + j - k, k


class Tree:
    """Keys of one length by their characters.

    For each depth: where a node's children begin, which characters these have (bits, by place in ``letters``), the
    character of each, and its first key.
    """

    def __init__(self, numbers: np.ndarray, text: np.ndarray, letters: np.ndarray) -> None:
        self.numbers = numbers
        since = np.concatenate([[0], (text[1:] != text[:-1]).argmax(axis=1)])
        self.levels, held = [], np.zeros(1, np.int64)
        for depth in range(text.shape[1]):
            begins = np.flatnonzero(since <= depth)
            first, letter = np.append(np.searchsorted(begins, held), len(begins)), text[begins, depth]
            bits = np.uint64(1) << np.searchsorted(letters, letter).astype(np.uint64)
            self.levels.append((first, np.bitwise_or.reduceat(bits, first[:-1]), letter, begins))
            held = begins


class Asked:
    """Names of at most WORD_BITS characters as a walk needs them: for each, where its characters are."""

    def __init__(self, names: Texts, letters: np.ndarray) -> None:
        n, self.size = len(names), names.lengths
        owner = np.repeat(np.arange(n), self.size)
        place = np.arange(len(names.text)) - names.begin[owner]
        #: Places of each character, as bits.
        self.masks = np.zeros((n, 128), np.uint64)
        np.bitwise_or.at(self.masks, (owner, names.text), np.uint64(1) << place.astype(np.uint64))
        own = np.zeros(128, np.uint64)
        own[letters] = np.uint64(1) << np.arange(len(letters), dtype=np.uint64)
        wide = int(self.size.max(initial=1))
        #: At each place, the character as a bit, none for one that no key has, and where it comes next.
        self.bits, self.next = np.zeros((n, wide), np.uint64), np.full((n, wide), WORD_BITS + 1)
        self.bits[owner, place] = own[names.text]
        after = (self.masks[owner, names.text] >> place.astype(np.uint64)) >> np.uint64(1)
        lowest = np.bitwise_count((after & (~after + np.uint64(1))) - np.uint64(1)).astype(np.int64)
        self.next[owner, place] = np.where(after > 0, place + 1 + lowest, WORD_BITS + 1)

    def __getitem__(self, rows: np.ndarray) -> Asked:
        out = object.__new__(Asked)
        out.size, out.masks, out.bits, out.next = self.size[rows], self.masks[rows], self.bits[rows], self.next[rows]
        return out


def highest(words: np.ndarray) -> np.ndarray:
    """Place after the highest bit that is set, 0 if none is."""
    out = np.frexp(words.astype(np.float64))[1].astype(np.int64)  # one too high where a word was rounded up
    return out - ((out > 0) & (words >> np.maximum(out - 1, 0).astype(np.uint64) == 0))


class Shelf:
    """Distinct keys in order (of `t.match_name`, so ASCII), held so that the closest to a name are found.

    The blocks that a ratio counts are a common subsequence, and that is a common multiset of characters: twice the size
    of either over both lengths is never below the ratio.  Keys are walked as trees, and a branch is left as soon as its
    longest common subsequence can't reach a bound; the bound falls until the best keys found reach it.  A name for
    which that visits too many nodes is held against all keys, first by its multiset.
    """

    def __init__(self, keys: list[str]) -> None:
        self.keys, self.own = keys, Texts(keys)
        self.lengths, self.letters = self.own.lengths, np.unique(self.own.text)
        self.limit = (SCAN + len(keys)) // VISIT

    @cached_property
    def trees(self) -> dict[int, Tree]:
        out = {}
        for length in np.unique(self.lengths).tolist():
            numbers = np.flatnonzero(self.lengths == length)
            out[length] = Tree(numbers, self.own.text[self.own.begin[numbers][:, None] + np.arange(length)], self.letters)
        return out

    @cached_property
    def counts(self) -> dict[int, np.ndarray]:
        """How often each character occurs in each key."""
        owner = np.repeat(np.arange(len(self.keys)), self.lengths)
        return {int(c): np.bincount(owner[self.own.text == c], minlength=len(self.keys)).astype(np.int32) for c in np.unique(self.own.text)}

    @cached_property
    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        code, owner = self.own.grams()
        order = np.argsort(code, kind="stable")
        return code[order], owner[order]

    @cached_property
    def places(self) -> dict[str, int]:
        return {k: i for i, k in enumerate(self.keys)}

    def common(self, name: np.ndarray) -> np.ndarray:
        """Characters that each key shares with the name, in any order."""
        out = np.zeros(len(self.keys), np.int64)
        for c, n in zip(*np.unique(name, return_counts=True), strict=True):
            if int(c) in self.counts:
                out += np.minimum(self.counts[int(c)], n)
        return out

    def in_order(self, name: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Length of the longest common subsequence of the name, no longer than a word of bits, and each key of ``at``."""
        masks = np.zeros(129, np.uint64)
        np.bitwise_or.at(masks, name, np.uint64(1) << np.arange(len(name), dtype=np.uint64))
        open_, begin, end = np.full(len(at), ONES), self.own.begin[at], self.own.end[at]
        for i in range(int(self.lengths[at].max(initial=0))):
            met = masks[np.where(begin + i < end, self.own.text[np.minimum(begin + i, len(self.own.text) - 1)], 128)]
            open_ = (open_ + (open_ & met)) | (open_ & ~met)
        return np.bitwise_count(~open_ & LOW[len(name)]).astype(np.int64)

    def scan(self, name: np.ndarray, cutoff: float) -> tuple[np.ndarray, np.ndarray]:
        """(key, bound) of all keys whose bound reaches the cutoff, each held against the name."""
        common, both = self.common(name), self.lengths + len(name)
        left = np.flatnonzero(2.0 * common / both >= cutoff)
        bound = self.in_order(name, left) if len(name) <= WORD_BITS else common[left]
        bound = 2.0 * bound / both[left]
        return left[bound >= cutoff], bound[bound >= cutoff]

    def walk(self, asked: Asked, reach: np.ndarray, below: np.ndarray, limit: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(name, key, bound) of the keys from ``low`` to before ``high`` whose bound is ``reach`` or more but not ``below``, and each name's visits; above ``limit`` it has no keys."""
        size, n = asked.size, len(asked.size)
        seen, over, out = np.zeros(n, np.int64), np.zeros(n, bool), [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for length, tree in self.trees.items():
            need = np.ceil(reach * (size + length) / 2 - 1e-9).astype(np.int64)
            row = np.flatnonzero((need <= np.minimum(size, length)) & ~over)
            node, state = np.zeros(len(row), np.int64), np.full(len(row), ONES)
            begins, ends = np.searchsorted(tree.numbers, (low, high))
            if begins == ends:
                continue
            for depth, (first, present, letter, keys) in enumerate(tree.levels):
                least, most = np.searchsorted(keys, begins, "right") - 1, np.searchsorted(keys, ends)
                # The rest of the key after this character meets at most the end of the name that is as long, from `far` on.
                rest = length - depth - 1
                far = np.maximum(size - rest, 0)
                met = ~state & LOW[far][row]
                # Either any character will do, or only one that the name has between the last one met and `far`.
                free = np.bitwise_count(met) >= (need - np.minimum(rest, size))[row]
                begin = np.where(free, np.maximum(first[node], least), highest(met))
                count = np.where(free, np.minimum(first[node + 1], most), far[row]) - begin
                seen += np.bincount(row, weights=count, minlength=n).astype(np.int64)
                if (seen > limit).any():
                    over = seen > limit
                    count[over[row]] = 0
                if count.sum() > MOST and n > 1:
                    halves = [(h, self.walk(asked[h], reach[h], below[h], limit[h], low, high)) for h in np.array_split(np.arange(n), 2)]
                    return (*(np.concatenate(x) for x in zip(*((h[w[0]], w[1], w[2]) for h, w in halves), strict=True)), np.concatenate([w[3] for _, w in halves]))
                at, child = np.repeat(np.arange(len(row)), count), ramps(begin, count)
                tied = np.flatnonzero(~free[at])
                who, place = at[tied], child[tied]
                bit, held = asked.bits[row[who], place], present[node[who]]
                stay = np.ones(len(at), bool)
                stay[tied] = ((held & bit) > 0) & (asked.next[row[who], place] >= far[row[who]])
                child[tied] = first[node[who]] + np.bitwise_count(held & (bit - np.uint64(1)))
                stay[tied] &= (child[tied] >= least) & (child[tied] < most)
                at, node = at[stay], child[stay]
                row, state = row[at], state[at]
                met = asked.masks[row, letter[node]]
                state = (state + (state & met)) | (state & ~met)
            met = np.bitwise_count(~state & LOW[size][row])
            fresh = met < np.ceil(below * (size + length) / 2 - 1e-9)[row]
            row, node, met = row[fresh], node[fresh], met[fresh]
            out.append((row, tree.numbers[node], 2.0 * met / (size[row] + length)))
        row, key, bound = (np.concatenate(x) for x in zip(*out, strict=True))
        told = ~over[row]
        return row[told], key[told], bound[told], seen

    def ratios(self, names: Texts, row: np.ndarray, key: np.ndarray, *, back: bool = False) -> np.ndarray:
        """SequenceMatcher's ratio from the name of each row to its key, or back from the key to the name."""
        sides = [(self.own, key), (names, row)] if back else [(names, row), (self.own, key)]
        (left, i), (right, j) = sides
        both = left.lengths[i] + right.lengths[j]
        plain = np.flatnonzero(np.maximum(left.lengths[i], right.lengths[j]) < JUNK_LENGTH)
        out, i_, j_ = np.zeros(len(row)), i[plain], j[plain]
        out[plain] = 2.0 * matched(left.text, left.begin[i_], left.end[i_], right.text, right.begin[j_], right.end[j_]) / both[plain]
        for x in np.setdiff1d(np.arange(len(row)), plain):
            out[x] = difflib.SequenceMatcher(None, left.strings[i[x]], right.strings[j[x]]).ratio()
        return out

    def best(self, names: Texts, row: np.ndarray, key: np.ndarray, bound: np.ndarray, cutoff: float, held: np.ndarray, score: np.ndarray) -> None:
        """Put into ``held`` and ``score`` each name's best keys among the keys given by row, best first; a tie goes to the later key."""
        n = held.shape[1]
        values, last = np.unique(bound), max(0, len(self.keys) - 1)
        # By name, falling bound, falling key: each number says all three.
        span = max(1, len(values)) * (last + 1)
        sort = np.sort(row * span + (len(values) - 1 - np.searchsorted(values, bound)) * (last + 1) + last - key)
        bound_of, key_of = lambda x: values[len(values) - 1 - x % span // (last + 1)], lambda x: last - x % (last + 1)
        at, end = np.searchsorted(sort, np.arange(len(names)) * span), np.searchsorted(sort, np.arange(1, len(names) + 1) * span)
        live, most_at_once = np.arange(len(names)), n
        while True:
            # What follows has the next bound at most, and at that bound the next key at most.
            live = live[at[live] < end[live]]
            if not len(live):
                return
            most, after = bound_of(sort[at[live]]), key_of(sort[at[live]])
            live = live[(score[live, n - 1] < most) | ((score[live, n - 1] == most) & (held[live, n - 1] < after))]
            count = np.minimum(end[live] - at[live], most_at_once)
            line, some = np.repeat(np.arange(len(live)), count), ramps(at[live], count)
            key = key_of(sort[some])
            ratio = self.ratios(names, live[line], key, back=True)
            wide = int(count.max(initial=0))
            new_score, new_key, slot = np.full((len(live), wide), -1.0), np.full((len(live), wide), -1), some - at[live][line]
            new_score[line, slot], new_key[line, slot] = np.where(ratio >= cutoff, ratio, -1), np.where(ratio >= cutoff, key, -1)
            new_score, new_key = np.hstack([score[live], new_score]), np.hstack([held[live], new_key])
            order = np.lexsort((new_key, new_score), axis=1)[:, : -n - 1 : -1]
            score[live], held[live] = np.take_along_axis(new_score, order, 1), np.take_along_axis(new_key, order, 1)
            at[live] += count
            most_at_once = min(2 * most_at_once, BATCH)

    def closest(self, strings: list[str], n: int, cutoff: float) -> tuple[np.ndarray, np.ndarray]:
        """(key, ratio) of each name's ``n`` keys of the best ratio of at least ``cutoff``, best first, -1 where there are fewer."""
        held, score = np.full((len(strings), n), -1), np.full((len(strings), n), -1.0)
        if not self.keys:
            return held, score
        spread = np.unique(self.lengths)
        most = WORD_BITS if len(self.letters) <= WORD_BITS else 0  # a node's children are bits of a word, too
        scanned = [i for i, x in enumerate(strings) if len(x) > most]
        # Names of similar length side by side, since they fall through the same bounds.
        walked = sorted((i for i, x in enumerate(strings) if len(x) <= most), key=lambda i: len(strings[i]))
        for begin in range(0, len(walked), BATCH):
            rows, step = np.array(walked[begin : begin + BATCH]), 0
            limit = np.full(len(rows), self.limit)
            # A walk costs its levels, however few its names, and a scan its name, so few names in deep trees are scanned.
            while step < STEPS and len(rows) * (SCAN + len(self.keys)) > int(spread.sum()) * LEVEL * (step + 1):
                size = np.array([len(strings[i]) for i in rows])
                both = size[:, None] + spread
                tops = 2.0 * np.minimum(size[:, None], spread) / both
                fit = tops.argmax(axis=1)
                bound_at = lambda k: np.maximum(cutoff, tops.max(axis=1) - k * 2.0 / (size + spread[fit]))  # noqa: B023, E731
                reach = bound_at(step)
                # The best ratio that a key may have which the steps before did not see.
                below = bound_at(step - 1) if step else np.full(len(rows), np.inf)
                unseen = (2.0 * np.minimum(np.ceil(below[:, None] * both / 2 - 1e-9) - 1, np.minimum(size[:, None], spread)) / both).max(axis=1)
                left, over = np.arange(len(rows)), np.zeros(len(rows), bool)
                found, ratio = held[rows], score[rows]
                # The last keys first: where many keys are equally close they are the best, and the others need no visit.
                high = len(self.keys)
                for share in SHARES if step else (0,):
                    low = int(len(self.keys) * share)
                    names = Texts([strings[i] for i in rows[left]])
                    row, key, bound, seen = self.walk(Asked(names, self.letters), reach[left], below[left], limit[left], low, high)
                    limit[left] -= seen
                    many = limit[left] < 0
                    own, own_ratio = found[left], ratio[left]
                    self.best(names, row, key, bound, cutoff, own, own_ratio)
                    found[left], ratio[left], over[left] = own, own_ratio, many
                    least, last = own_ratio[:, n - 1], own[:, n - 1]
                    left, high = left[~many & ((least < unseen[left]) | ((least == unseen[left]) & (last < low)))], low
                    if not len(left):
                        break
                scanned += rows[over].tolist()
                held[rows], score[rows] = found, ratio
                open_ = (ratio[:, n - 1] < reach) & (reach > cutoff) & ~over
                rows, limit, step = rows[open_], limit[open_], step + 1
                if not len(rows):
                    break
            scanned += rows.tolist()
        held[scanned], score[scanned] = -1, -1.0
        for i in scanned:
            key, bound = self.scan(np.frombuffer(strings[i].encode("ascii"), np.uint8), cutoff)
            self.best(Texts([strings[i]]), np.zeros(len(key), np.int64), key, bound, cutoff, held[i : i + 1], score[i : i + 1])
        return held, score

    def inside(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(name, key) of all pairs where the key holds the name or lies in it."""
        rows, keys = [], []
        spread = np.unique(self.lengths).tolist()
        for row, name in enumerate(strings):
            for length in spread:
                if length > len(name):
                    break
                for x in {name[i : i + length] for i in range(len(name) - length + 1)}:
                    if x in self.places:
                        rows.append(row)
                        keys.append(self.places[x])
            if len(name) < GRAM:  # no gram to look for
                longer = [i for i, k in enumerate(self.keys) if len(k) > len(name) and name in k]
                rows += [row] * len(longer)
                keys += longer
        code, owner = self.grams
        asked, whose = Texts(strings).grams()
        if len(code) and len(asked):
            begin = np.searchsorted(code, asked)
            count = np.searchsorted(code, asked, "right") - begin
            # Of a name's grams the rarest leads to the keys that may hold it.
            order = np.lexsort((count, whose))
            rarest = order[np.unique(whose[order], return_index=True)[1]]
            rarest = rarest[count[rarest] > 0]
            for row, key in sorted(set(zip(np.repeat(whose[rarest], count[rarest]).tolist(), owner[ramps(begin[rarest], count[rarest])].tolist(), strict=True))):
                if len(self.keys[key]) > len(strings[row]) and strings[row] in self.keys[key]:
                    rows.append(row)
                    keys.append(key)
        return np.array(rows, np.int64), np.array(keys, np.int64)

    def close(self, key: str, n: int, cutoff: float) -> tuple[dict[str, float], list[str]]:
        """The ``n`` keys of the best ratio of at least ``cutoff``, a tie to the later key, and all keys that hold the name or lie in it."""
        held, score = self.closest([key], n, cutoff)
        return {self.keys[k]: s for k, s in zip(held[0].tolist(), score[0].tolist(), strict=True) if k >= 0}, [self.keys[k] for k in np.sort(self.inside([key])[1])]
