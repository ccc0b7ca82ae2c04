"""Byte-level BPE of many texts through a cache of encoded units.

The pattern of this tokenizer family never joins a word with what follows it, so a
text falls into units that encode alike wherever they stand: a run of non-space bytes
with the one space before it, and the white space between (all of it but the last
character is one unit, the last one another). Units are found and compared as 64-bit
hashes by whole-array operations; only units not met before go through the tokenizer.
Texts with other Unicode white space or with a special token are encoded whole.

New units below U+0800 go through ``tiktoken``, several times as fast, if it provably merges
alike (see merges_agree), all others through ``tokenizers``.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np

from ebbtide.llm.words import SEGMENT, U, Runs, byte_codes, segment

_ODD = re.compile(r"[^\S\x20\x09-\x0D]|\x85")
_LEAD = np.zeros(256, bool)  # first bytes of the white space that _ODD finds
_LEAD[[0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3]] = True
CACHE_UNITS = 600_000  # units of a generation of the cache; a segment of SEGMENT bytes holds fewer
CACHE_IDS = 8 << 20  # a generation ends beyond this many ids as well
_AT_ONCE = 2000  # units handed to the tokenizer at a time: its results take about a kilobyte each
_OPEN: dict[str, UnitEncoder] = {}


# --- fixed values: the split pattern of this tokenizer family, and its printable stand-ins for bytes ------
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]


def _stand_ins() -> dict[str, int]:
    """Byte by stand-in: printable ones stand for themselves, the others take the characters from 256 on."""
    hidden = [b for b in range(256) if b not in PRINTABLE]
    return {chr(b): b for b in PRINTABLE} | {chr(256 + k): b for k, b in enumerate(hidden)}


@lru_cache(4)
def merges_agree(path: str) -> bool:
    """Whether merging any two neighbours whose union is a token, smallest id first, gives this tokenizer's ids.

    ``tokenizers`` merges listed pairs only, in listed order. Both agree on every text if
    ids follow that order and every token's own bytes encode to that token: merges below a
    token's id then leave exactly its listed pair of those bytes wherever they stand, so no
    other pair of parts with that union ever comes up.
    """
    from tokenizers import Tokenizer

    try:
        import tiktoken  # noqa: F401
    except ImportError:
        return False
    tok = Tokenizer.from_file(path)
    spec = json.loads(tok.to_str())
    model, split = spec["model"], spec["pre_tokenizer"] or {}
    plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges", "unk_token"))
    if not plain or spec["normalizer"] or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
        return False
    stand_ins, vocab = _stand_ins(), model["vocab"]
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    ids = [vocab[a + b] for a, b in pairs]
    if any(a >= b for a, b in zip(ids, ids[1:])) or any(c not in vocab for c in stand_ins):
        return False
    own = [t for t in vocab if all(c in stand_ins for c in t)]
    return all([x.id for x in tok.model.tokenize(t)] == [vocab[t]] for t in own)


def encoder(path: str, fast: bool = False) -> UnitEncoder:
    """The encoder of this worker process: tokenizer and cache serve all tasks that run in it.

    The cache is two generations of CACHE_UNITS, about 50 MB: units of the older one that
    are met again move to the younger, so those in use stay. Only one encoder is kept.
    """
    if path not in _OPEN:
        _OPEN.clear()
        _OPEN[path] = UnitEncoder(path, fast)
    return _OPEN[path]


class UnitEncoder:
    def __init__(self, path: str, fast: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs one task per core
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.kind = np.uint16 if self.tok.get_vocab_size() <= 1 << 16 else np.uint32
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.codes = byte_codes(False)
        self.quick, self.feed = None, self._whole("\n").tolist()
        if fast and len(self.feed) == 1:
            import tiktoken

            stand_ins, special = _stand_ins(), set(self.special)
            ranks = {bytes(stand_ins[c] for c in t): i for t, i in self.tok.get_vocab().items() if t not in special}
            self.quick = tiktoken.Encoding("units", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.young, self.old = Generation(self.kind), Generation(self.kind)
        self.gaps: dict[bytes, int] = {}

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4")

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids of every text."""
        out: list[np.ndarray | None] = [None] * len(texts)
        group: list[tuple[int, bytes]] = []
        held = 0
        for i, text in enumerate(texts):
            blob = text.encode()
            if (_LEAD[np.frombuffer(blob, np.uint8)].any() and _ODD.search(text)) or any(s in text for s in self.special):
                out[i] = self._whole(text)
                continue
            if len(blob) > SEGMENT:
                pieces = list(_cut(blob))
                out[i] = np.concatenate([self._group([p])[0] for p in pieces])
                continue
            group.append((i, blob))
            held += len(blob)
            if held > SEGMENT:
                self._into(out, group)
                group, held = [], 0
        self._into(out, group)
        return out  # type: ignore[return-value]

    def _gap(self, gap: bytes) -> int:
        if gap not in self.gaps:
            self.gaps[gap] = hash_gap(gap)
        return self.gaps[gap]

    def _into(self, out, group) -> None:
        if group:
            for (i, _), ids in zip(group, self._group([b for _, b in group]), strict=True):
                out[i] = ids

    def _group(self, blobs: list[bytes]) -> list[np.ndarray]:
        data = b"\n".join(blobs)
        keys, start, end = segment(data, self.codes)
        ends = np.cumsum([len(b) + 1 for b in blobs]) - 1  # of each text within data
        begins = np.concatenate([[0], ends[:-1] + 1])
        doc = np.searchsorted(ends, start, side="right")
        last = np.ones(len(start), bool)  # first word of its text
        last[1:] = doc[1:] != doc[:-1]
        before = np.where(last, begins[doc] if len(doc) else 0, np.concatenate([[0], end[:-1]]) if len(end) else 0)
        raw = np.frombuffer(data, np.uint8)
        gap = start - before
        spaced = (gap > 0) & (raw[np.maximum(start - 1, 0)] == 32)
        keys = keys ^ (spaced.astype(U) * U(0xA24BAED4963EE407))
        start = start - spaced
        rest = gap - spaced
        where, a, b = [], [], []
        for i in np.flatnonzero(rest).tolist():
            lo, hi = int(before[i]), int(before[i] + rest[i])
            if not spaced[i] and hi - lo > 1:
                where += [i, i]
                a += [lo, hi - 1]
                b += [hi - 1, hi]
            else:
                where.append(i)
                a.append(lo)
                b.append(hi)
        words = np.searchsorted(doc, np.arange(len(blobs) + 1))  # word range of each text
        for d, (lo, hi) in enumerate(zip(words[:-1].tolist(), words[1:].tolist(), strict=True)):
            tail = int(end[hi - 1]) if hi > lo else int(begins[d])
            if tail < ends[d]:
                where.append(hi)
                a.append(tail)
                b.append(int(ends[d]))
        if where:
            # A text's tail and the next text's leading gap share a position; by offset they are in order.
            order = np.lexsort((np.array(a), np.array(where)))
            where, a, b = np.array(where)[order], np.array(a)[order], np.array(b)[order]
            white = np.array([self._gap(data[x:y]) for x, y in zip(a.tolist(), b.tolist(), strict=True)], U)
            keys, start, end = np.insert(keys, where, white), np.insert(start, where, a), np.insert(end, where, b)
        units = np.searchsorted(start, np.concatenate([begins, [len(data) + 1]]))
        return self._gather(data, keys, start, end, units)

    def _learn(self, keys: np.ndarray, units: list[bytes]) -> None:
        """Put the ids of new units into the cache."""
        if self.quick is not None:
            # One text, a line feed after each unit: a unit and an id of its own, which tells where units end.
            low = [i for i, u in enumerate(units) if not u.isspace() and max(u) < 0xE0]
            flat = np.array(self.quick.encode_ordinary("".join([units[i].decode() + "\n" for i in low])), np.uint32)
            cut = np.flatnonzero(flat == self.feed[0])
            if len(cut) == len(low):
                size = np.diff(cut, prepend=-1) - 1
                self.young.add(keys[low], np.delete(flat, cut).astype(self.kind), size)
                rest = np.delete(np.arange(len(units)), low)
                keys, units = keys[rest], [units[i] for i in rest.tolist()]
        ids = [enc.ids for enc in self.tok.encode_batch_fast([u.decode() for u in units], add_special_tokens=False)]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        self.young.add(keys, np.fromiter(chain.from_iterable(ids), self.kind, int(size.sum())), size)

    def _gather(self, data: bytes, keys, start, end, units) -> list[np.ndarray]:
        if not len(keys):
            return [np.zeros(0, "<u4") for _ in units[1:]]
        at = self.young.table.find(keys)
        missing = np.flatnonzero(at < 0)
        if len(missing):
            new, first = np.unique(keys[missing], return_index=True)
            first = missing[first]
            if self.young.table.used and (self.young.table.used + len(new) > CACHE_UNITS or self.young.filled > CACHE_IDS):
                self.young, self.old, self.gaps = Generation(self.kind), self.young, {}
                return self._gather(data, keys, start, end, units)
            before = self.old.table.find(new)
            known, unknown = np.flatnonzero(before >= 0), np.flatnonzero(before < 0)
            self.young.add(new[known], *self.old.ids(before[known]))
            for k in range(0, len(unknown), _AT_ONCE):
                pick = unknown[k : k + _AT_ONCE]
                self._learn(new[pick], [data[x:y] for x, y in zip(start[first[pick]].tolist(), end[first[pick]].tolist(), strict=True)])
            at = self.young.table.find(keys)
        flat, count = self.young.ids(at)
        cuts = np.append(0, np.cumsum(count))[units]
        flat = flat.astype("<u4")
        return [flat[x:y] for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


class Generation:
    """Ids of units by the order of their arrival, in one growing pool."""

    def __init__(self, kind):
        self.table, self.kind = KeyTable(20), kind
        self.pool, self.filled = np.zeros(1 << 16, kind), 0
        self.begin, self.size = np.zeros(CACHE_UNITS, np.int32), np.zeros(CACHE_UNITS, np.int32)

    def add(self, keys: np.ndarray, ids: np.ndarray, size: np.ndarray) -> None:
        """New units; ``ids`` of one after the other."""
        end = self.filled + len(ids)
        if end > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.filled], np.zeros(max(end, 2 * len(self.pool)) - self.filled, self.kind)])
        self.pool[self.filled : end] = ids
        own = slice(self.table.used, self.table.used + len(keys))
        self.begin[own], self.size[own] = self.filled + np.cumsum(size) - size, size
        self.filled = end
        self.table.add(keys)

    def ids(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units in a row, and how many each has."""
        count = self.size[at].astype(np.int64)
        stop = np.cumsum(count)
        total = int(stop[-1]) if len(stop) else 0
        return self.pool[np.arange(total) + np.repeat(self.begin[at] - (stop - count), count)], count


class KeyTable:
    """Open-addressing table from 64-bit keys to the order of their arrival, probed array-wise."""

    def __init__(self, slots_log: int):
        self.shift, self.mask = U(64 - slots_log), (1 << slots_log) - 1
        self.key, self.place = np.zeros(1 << slots_log, U), np.full(1 << slots_log, -1, np.int32)
        self.used = 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        slot = (keys >> self.shift).astype(np.int64)
        todo = np.arange(len(keys))
        while len(todo):
            place = self.place[slot]
            hit = (place >= 0) & (self.key[slot] == keys[todo])
            out[todo[hit]] = place[hit]
            on = (place >= 0) & ~hit
            todo, slot = todo[on], (slot[on] + 1) & self.mask
        return out

    def add(self, keys: np.ndarray) -> None:
        """Insert different keys that are not in the table, in order."""
        slot = (keys >> self.shift).astype(np.int64)
        todo = np.arange(len(keys))
        while len(todo):
            free = self.place[slot] < 0
            _, one = np.unique(slot[free], return_index=True)  # one key for each free slot
            won = np.flatnonzero(free)[one]
            self.key[slot[won]], self.place[slot[won]] = keys[todo[won]], (self.used + todo[won]).astype(np.int32)
            on = np.ones(len(todo), bool)
            on[won] = False
            todo, slot = todo[on], slot[on]
            taken = self.place[slot] >= 0
            slot = np.where(taken, (slot + 1) & self.mask, slot)
        self.used += len(keys)


def hash_gap(gap: bytes) -> int:
    """Key of a run of white space: its bytes in base 256, mixed by Runs' finaliser."""
    codes = np.frombuffer(gap, np.uint8).astype(U) + U(1)
    return int(Runs(codes).hash(np.zeros(1, np.int64), len(codes))[0]) if len(gap) > 1 else int(codes[0]) * 0x5851F42D4C957F2D % (1 << 64)


def _cut(blob: bytes):
    """Parts of about SEGMENT bytes, each starting with a space before a word."""
    at = 0
    while at < len(blob):
        m = re.compile(rb"(?<=[^\x20\x09-\x0D])(?=\x20[^\x20\x09-\x0D])").search(blob, at + SEGMENT) if len(blob) - at > SEGMENT else None
        end = m.start() if m else len(blob)
        yield blob[at:end]
        at = end
