"""Token counts by rank-synchronous merging over ragged numpy arrays.

A batch of texts is cut into pre-tokens.  The distinct ones are laid end to end as one array of
symbol ids with segment numbers.  Every round finds each segment's lowest-ranked adjacent pair and
merges all of its occurrences in all segments at once; finished segments leave the arrays.  What
survives is the number of tokens; no token ids are built per text.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm.runtime import bounded_batches, session_of

#: Fixed value: the byte-level pre-token pattern, as published with the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
NO_RANK = np.int64(1 << 40)
MEMO_ENTRIES = 400_000
MEMO_CHARS = 64


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of every byte in byte-level vocabularies: printable Latin-1 stays, the rest follows from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def pattern_of(spec: dict) -> str:
    """The pre-token pattern of a tokenizers file; ValueError for files that say more than this counter does.

    Read are byte-level BPE models whose pre-tokenizer is ByteLevel with its own pattern, or a Split by a
    pattern of the file's before a ByteLevel without one.  Normalizers, prefix spaces, dropout, prefixes
    and suffixes of words, and added tokens with conditions are refused, since ignoring them would miscount.
    """
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges") if model.get(k)]
    odd += [k for k in ("normalizer", "truncation", "padding") if spec.get(k)]
    odd += [f"added token {t['content']}" for t in spec.get("added_tokens", []) if any(t.get(k) for k in ("single_word", "lstrip", "rstrip"))]
    if model.get("type", "BPE") != "BPE":
        odd.append(f"model {model['type']}")
    steps = pre["pretokenizers"] if pre.get("type") == "Sequence" else [pre]
    byte_level = steps[-1].get("type") == "ByteLevel" and not steps[-1].get("add_prefix_space")
    pattern = None
    if byte_level and len(steps) == 1 and steps[0].get("use_regex", True):
        pattern = PATTERN
    elif byte_level and len(steps) == 2 and steps[0].get("type") == "Split" and not steps[1].get("use_regex", True):
        own = steps[0]
        if "Regex" in own["pattern"] and (own["behavior"], own.get("invert", False)) == ("Isolated", False):
            pattern = own["pattern"]["Regex"]
    if pattern is None:
        odd.append("pre_tokenizer")
    if odd:
        raise ValueError(f"not supported in a tokenizer file: {', '.join(odd)}")
    return pattern


class RankMerger:
    """Counts BPE tokens of pre-tokens; ``path`` is a tokenizers .json file with a byte-level BPE model."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.pattern = regex.compile(pattern_of(spec))
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.symbol = np.zeros(256, np.int64)
        for char, byte in byte_alphabet().items():
            self.symbol[byte] = vocab[char]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        key = left << 32 | right
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks, self.made = key[order], order.astype(np.int64), made
        self.specials = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)
        self.special_split = regex.compile("|".join(map(regex.escape, self.specials))) if self.specials else None
        self.memo: dict[str, int] = {}

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK)

    def survivors(self, pieces: list[bytes]) -> np.ndarray:
        """Symbols left in each piece when no pair can be merged any more."""
        counts = np.fromiter(map(len, pieces), np.int64, len(pieces))
        sym = self.symbol[np.frombuffer(b"".join(pieces), np.uint8)]
        seg = np.repeat(np.arange(len(pieces)), counts)
        rank = np.full(len(sym), NO_RANK)
        inner = np.flatnonzero(seg[1:] == seg[:-1])
        rank[inner] = self.rank(sym[inner], sym[inner + 1])
        while len(sym):
            starts = np.flatnonzero(np.r_[True, seg[1:] != seg[:-1]])
            lowest = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.r_[starts, len(seg)]))
            live = lowest < NO_RANK
            hit = np.flatnonzero(live & (rank == lowest))
            if not len(hit):
                break
            # Neighbouring hits occur only for a pair of equal symbols: the run is merged from its left end.
            fresh = np.r_[True, np.diff(hit) > 1]
            offset = hit - np.maximum.accumulate(np.where(fresh, hit, 0))
            hit = hit[offset % 2 == 0]
            sym[hit] = self.made[rank[hit]]
            np.subtract.at(counts, seg[hit], 1)
            keep = live.copy()
            keep[hit + 1] = False
            place = np.cumsum(keep) - 1
            sym, seg, rank, hit = sym[keep], seg[keep], rank[keep], place[hit]
            stale = np.unique(np.r_[hit, hit[hit > 0] - 1])
            stale_next = np.minimum(stale + 1, len(sym) - 1)
            joined = (stale + 1 < len(sym)) & (seg[stale] == seg[stale_next])
            rank[stale] = np.where(joined, self.rank(sym[stale], sym[stale_next]), NO_RANK)
        return counts

    def pieces(self, part: str) -> list[str]:
        """What the pattern matches in ``part``, and what lies between matches."""
        if self.pattern.pattern == PATTERN:  # which matches everything
            return self.pattern.findall(part)
        out, at = [], 0
        for m in self.pattern.finditer(part):
            out += [part[at : m.start()], m.group()]
            at = m.end()
        return [x for x in (*out, part[at:]) if x]

    def count(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text, special strings inside it counted as one token each."""
        bags: list[tuple[Counter, int]] = []
        fresh: dict[str, int] = {}
        for text in texts:
            parts = self.special_split.split(text) if text and self.special_split else [text or ""]
            bag: Counter = Counter()
            for part in parts:
                bag.update(self.pieces(part))
            bags.append((bag, len(parts) - 1))
            for piece in bag:
                if piece not in self.memo:
                    fresh[piece] = 0
        for piece, n in zip(fresh, self.survivors([p.encode() for p in fresh]).tolist(), strict=True):
            fresh[piece] = n
        known = self.memo
        out = [specials + sum(n * (known.get(p) or fresh[p]) for p, n in bag.items()) for bag, specials in bags]
        if len(self.memo) + len(fresh) > MEMO_ENTRIES:
            self.memo = {}
        self.memo.update((p, n) for p, n in fresh.items() if len(p) <= MEMO_CHARS)
        return out


_mergers: dict[str, RankMerger] = {}


def merger(path: str) -> RankMerger:
    if path not in _mergers:
        _mergers[path] = RankMerger(path)
    return _mergers[path]


def token_counts(df: DataFrame, tokenizer_path: str, text_col: str = "text", out_col: str = "n_tokens") -> DataFrame:
    """``df``'s rows with ``out_col`` (long), the number of tokens of ``text_col``.

    A null or empty text has 0 tokens, equal texts have equal counts, an empty table stays empty.  Other columns pass through; an existing ``out_col`` is
    replaced.  Rows stay where they are: no shuffle.  A worker holds one Arrow batch and a memo of at
    most MEMO_ENTRIES short pre-tokens.
    """
    bounded_batches(session_of(df))

    @F.arrow_udf("long")
    def n_tokens(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = merger(tokenizer_path)
        for batch in texts:
            yield pa.array(m.count(batch.to_pylist()), pa.int64())

    return df.withColumn(out_col, n_tokens(F.col(text_col)))
