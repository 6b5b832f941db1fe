"""Byte-level BPE by pieces: what the tokenizer operators share.

A text is cut where byte-level pre-tokenization always has a boundary, so each
piece is tokenized once and then looked up.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections.abc import Callable
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: A task's table with more pieces is emptied before the next batch.
ENTRIES = 1_000_000
#: Longer pieces, in bytes, are not kept.
KEPT = 64
#: Latin letters, then ASCII punctuation, and the same once more after a line end: pre-tokens that need no library.
_LETTERS, _MARKS = r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+", r"[!-/:-@\[-`{-~]*"
SIMPLE = re.compile(rf"({_LETTERS})({_MARKS})(?:(\n)({_LETTERS})({_MARKS}))?")
MARKS = re.compile(r"[!-/:-@\[-`{-~]+")


def letters() -> dict[str, int]:
    """Byte-level letters: printable bytes stand for themselves, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


_LETTER_OF = {b: c for c, b in letters().items()}
_SPACE = _LETTER_OF[32]


def spelled(text: str) -> str:
    """A text in byte-level letters."""
    if text.isascii() and text.isprintable():
        return text.replace(" ", _SPACE)
    return text.encode().decode("latin-1").translate(_LETTER_OF)


def default_tokenizer() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


class Bpe:
    """The merges of a byte-level BPE file. ``merge`` takes a pre-token in the file's own letters."""

    def __init__(self, path: str):
        model = json.load(open(path, encoding="utf-8"))["model"]
        self.vocab: dict[str, int] = model["vocab"]
        pairs = [p.split(" ", 1) if isinstance(p, str) else p for p in model["merges"]]
        self.rank = {(self.vocab[a], self.vocab[b]): k for k, (a, b) in enumerate(pairs)}
        self.made = [self.vocab[a + b] for a, b in pairs]

    def merge(self, word: str) -> list[int]:
        ids = [self.vocab[c] for c in word]
        if len(ids) > 100:
            return self._merge_long(ids)
        get, none = self.rank.get, len(self.made)
        ranks = [get(p, none) for p in zip(ids, ids[1:])]  # noqa: B905
        while ranks and (best := min(ranks)) != none:
            at = ranks.index(best)
            ids[at] = one = self.made[best]
            del ids[at + 1], ranks[at]
            if at:
                ranks[at - 1] = get((ids[at - 1], one), none)
            if at < len(ranks):
                ranks[at] = get((one, ids[at + 1]), none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same result by a heap over a linked list: a long word costs n log n."""
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(ids, ids[1:], strict=False)) if (r := self.rank.get((a, b))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = self.made[r], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (x := self.rank.get((ids[i], ids[k]))) is not None:
                    heapq.heappush(heap, (x, i, ids[i], ids[k]))
            if (h := before[i]) >= 0 and (x := self.rank.get((ids[h], ids[i]))) is not None:
                heapq.heappush(heap, (x, h, ids[h], ids[i]))
        return [x for x in ids if x >= 0]


class Merger:
    """The same merges for many words at once, in numpy: each step merges the first best pair of every word still in work."""

    def __init__(self, bpe: Bpe, code: str):
        self.bpe, self.code, self.none = bpe, code, len(bpe.made)
        self.made = np.array(bpe.made, np.int64)
        spelled_by = {ord(c): bpe.vocab[c] for c in letters() if c in bpe.vocab}
        self.of_letter = np.full(max(spelled_by) + 1, -1, np.int64)
        self.of_letter[list(spelled_by)] = list(spelled_by.values())
        # Open addressing: pairs by a hash, at most half of the slots taken.
        self.mask = (1 << max(4, (4 * len(bpe.rank)).bit_length())) - 1
        self.keys = np.full(self.mask + 1, -1, np.int64)
        self.ranks = np.full(self.mask + 1, self.none, np.int64)
        pairs = np.array([(a << 32) | b for a, b in bpe.rank], np.int64)
        value = np.fromiter(bpe.rank.values(), np.int64, len(pairs))
        slot = self._slot(pairs)
        while len(pairs):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = pairs[free]
            held = self.keys[slot] == pairs
            self.ranks[slot[held]] = value[held]
            pairs, value, slot = pairs[~held], value[~held], (slot[~held] + 1) & self.mask

    def _slot(self, pairs: np.ndarray) -> np.ndarray:
        return ((pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)).astype(np.int64) & self.mask

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        pairs = (a << 32) | b
        slot = self._slot(pairs)
        out = np.where(self.keys[slot] == pairs, self.ranks[slot], self.none)
        left = np.flatnonzero((self.keys[slot] != pairs) & (self.keys[slot] >= 0))
        while len(left):
            slot[left] = (slot[left] + 1) & self.mask
            key = self.keys[slot[left]]
            same = key == pairs[left]
            out[left[same]] = self.ranks[slot[left[same]]]
            left = left[~same & (key >= 0)]
        return out

    def __call__(self, words: list[str]) -> list[bytes]:
        """Packed ids of each word, spelled in byte-level letters."""
        out: list[bytes] = [b""] * len(words)
        pack = np.dtype("<u2" if self.code == "H" else "<u4")
        short = []
        for k, w in enumerate(words):
            if len(w) > 200:
                out[k] = np.array(self.bpe.merge(w), pack).tobytes()
            elif w:
                short.append(k)
        live = np.array(short, np.int64)
        lens = np.fromiter((len(words[k]) for k in short), np.int64, len(short))
        t = self.of_letter[np.frombuffer("".join([words[k] for k in short]).encode("utf-32-le"), "<u4")]
        r = np.full(len(t), self.none, np.int64)
        if len(t) > 1:
            r[:-1] = self.rank(t[:-1], t[1:])
        if len(lens):
            r[np.cumsum(lens) - 1] = self.none
        while len(live):
            best = np.minimum.reduceat(r, np.cumsum(lens) - lens)
            done = best == self.none
            if done.any():
                gone = np.repeat(done, lens)
                data, n = t[gone].astype(pack).tobytes(), lens[done] * pack.itemsize
                ends = np.cumsum(n).tolist()
                for k, a, b in zip(live[done].tolist(), [0, *ends], ends):  # noqa: B905
                    out[k] = data[a:b]
                t, r, live, lens, best = t[~gone], r[~gone], live[~done], lens[~done], best[~done]
                if not len(live):
                    break
            word = np.repeat(np.arange(len(lens)), lens)
            hit = np.flatnonzero(r == best[word])
            at = hit[np.concatenate([[True], np.diff(word[hit]) > 0])]
            t[at] = self.made[best]
            keep = np.ones(len(t), bool)
            keep[at + 1] = False
            t, r, at, lens = t[keep], r[keep], at - np.arange(len(at)), lens - 1
            ends = np.cumsum(lens)
            inner = at < ends - 1
            r[at] = self.none
            i = at[inner]
            r[i] = self.rank(t[i], t[i + 1])
            i = at[at > ends - lens]
            r[i - 1] = self.rank(t[i - 1], t[i])
        return out


#: Classes of bytes: 1 letters, 2 punctuation, 3 digits (all ASCII), 4 parts of other characters, 0 white space and control.
_CLASS = np.zeros(256, np.uint8)
_CLASS[0x21:0x7F] = 2
_CLASS[[*range(0x30, 0x3A)]] = 3
_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
_CLASS[0x80:] = 4
#: Last bytes and first bytes of the other characters that may be white space.
_TAIL, _LEAD3 = np.zeros(256, bool), np.zeros(256, bool)
_TAIL[[*range(0x80, 0x8C), 0x8E, 0x9F, 0xA0, 0xA8, 0xA9, 0xAF, 0xBF]] = True
_LEAD3[[0xE1, 0xE2, 0xE3, 0xEF]] = True
#: Bytes before and after the texts, so that places next to a text can be read.
_PAD = 8
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(8)] + [(1 << 64) - 1], np.uint64)
_MIX, _TIMES = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


class Rows:
    """A numpy array that grows at its end."""

    def __init__(self, kind, size: int = 1024):
        self.data, self.n = np.zeros(size, kind), 0

    def add(self, more: np.ndarray) -> None:
        end = self.n + len(more)
        if end > len(self.data):
            wide = np.zeros(max(end, 2 * len(self.data)), self.data.dtype)
            wide[: self.n] = self.data[: self.n]
            self.data = wide
        self.data[self.n : end] = more
        self.n = end


class Pieces:
    """Values of whole texts from the values of their pieces, a batch of texts at a time in numpy.

    A value is the packed ids of a piece, or with ``counts`` their number.
    ``of_words`` gives the values of pre-tokens; ``known`` may give those of
    space-led pieces at once, None for those it has not. Pieces that occurred
    are found by a hash in a table and compared in full with what it holds.
    """

    def __init__(self, path: str, of_words: Callable[[list[str]], list], counts: bool = False, known: Callable | None = None):
        tok = Tokenizer.from_file(path)
        spec = json.load(open(path, encoding="utf-8"))
        if spec["model"]["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["normalizer"] or spec["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("a byte-level BPE file without normalizer and prefix space is needed")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that take in their surroundings are not supported")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.pre, self.of_words, self.counts, self.known = tok.pre_tokenizer.pre_tokenize_str, of_words, counts, known
        self.entries = ENTRIES
        self.kind = np.dtype("<u2" if tok.get_vocab_size() <= 1 << 16 else "<u4")
        self.clear()

    def clear(self) -> None:
        self.slots = np.full(1 << 16, -1, np.int32)
        #: Of each piece: its hash, bytes, where its text is in ``text`` (8 bytes a row), where its ids are and how many.
        self.hash, self.size, self.text_at, self.text = Rows(np.uint64), Rows(np.int32), Rows(np.int64), Rows(np.uint64)
        self.at, self.n, self.ids = Rows(np.int64), Rows(np.int64), Rows(self.kind)

    def _words(self, text: str) -> list[str]:
        """Pre-tokens of a piece in byte-level letters."""
        lead = text[0] == " "
        if MARKS.fullmatch(text, lead):
            return [spelled(text)]
        if m := SIMPLE.fullmatch(text, lead):
            one, marks, line, two, more = m.groups()
            out = [spelled(text[: lead + len(one)])]
            if marks:
                out.append(marks)
            if line:
                out += [_LETTER_OF[10], spelled(two)]
                if more:
                    out.append(more)
            return out
        return [w for w, _ in self.pre(text)]

    def _values(self, pieces: list[bytes]) -> list:
        """Values of distinct pieces."""
        out: list = self.known([p if p[:1] == b" " else b"" for p in pieces]) if self.known else [None] * len(pieces)
        left = [k for k, v in enumerate(out) if v is None]
        cut = [self._words(pieces[k].decode()) for k in left]
        wanted = list(dict.fromkeys(chain.from_iterable(cut)))
        value = dict(zip(wanted, self.of_words(wanted), strict=True)).__getitem__
        join = sum if self.counts else b"".join
        for k, ws in zip(left, cut):  # noqa: B905
            out[k] = value(ws[0]) if len(ws) == 1 else join(map(value, ws))
        return out

    def _add_values(self, values: list) -> None:
        if self.counts:
            self.at.add(np.zeros(len(values), np.int64))
            self.n.add(np.array(values, np.int64))
            return
        n = np.fromiter(map(len, values), np.int64, len(values)) // self.kind.itemsize
        self.at.add(self.ids.n + np.cumsum(n) - n)
        self.n.add(n)
        self.ids.add(np.frombuffer(b"".join(values), self.kind))

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Entries with these hashes, -1 where there is none."""
        mask = np.uint64(len(self.slots) - 1)
        slot = (h & mask).astype(np.int64)
        out = self.slots[slot]
        left = np.flatnonzero((out >= 0) & (self.hash.data[out] != h))
        while len(left):
            slot[left] = (slot[left] + 1) & int(mask)
            entry = self.slots[slot[left]]
            out[left] = entry
            left = left[(entry >= 0) & (self.hash.data[entry] != h[left])]
        return out

    def _place(self, first: int) -> None:
        """Puts entries from ``first`` on into the slots, which are at most a quarter full."""
        if 4 * self.hash.n > len(self.slots):
            self.slots = np.full(1 << (8 * self.hash.n).bit_length(), -1, np.int32)
            first = 0
        mask = len(self.slots) - 1
        entry = np.arange(first, self.hash.n, dtype=np.int32)
        slot = (self.hash.data[first : self.hash.n] & np.uint64(mask)).astype(np.int64)
        while len(entry):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = entry[free]
            out = self.slots[slot] != entry
            entry, slot = entry[out], (slot[out] + 1) & mask

    def _cuts(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Starts of pieces: of texts, at spaces between two characters that are not white space, at punctuation after a letter.

        A pre-token begins at all of these, so pieces can be tokenized apart.
        """
        kind = _CLASS[buf]
        starts = np.zeros(len(buf), bool)
        marks = np.flatnonzero(kind[_PAD:-_PAD] == 2) + _PAD
        starts[marks[kind[marks - 1] == 1]] = True
        space = np.flatnonzero(buf[_PAD:-_PAD] == 32) + _PAD
        before, after = kind[space - 1], kind[space + 1]
        ok = (before > 0) & (after > 0)
        for at in (np.flatnonzero(ok & (before == 4)),):
            p = space[at] - 1
            ok[at[_TAIL[buf[p]] & ((buf[p - 1] == 0xC2) | _LEAD3[buf[p - 2]])]] = False
        for at in (np.flatnonzero(ok & (after == 4)),):
            p = space[at] + 1
            ok[at[(_TAIL[buf[p + 1]] & (buf[p] == 0xC2)) | (_TAIL[buf[p + 2]] & _LEAD3[buf[p]])]] = False
        starts[space[ok]] = True
        ends = offsets[1:] - 1 + _PAD  # a space that ends a text is white space before nothing
        last = ends[buf[ends] == 32]
        starts[last] = False
        starts[offsets[:-1][np.diff(offsets) > 0] + _PAD] = True
        return np.flatnonzero(starts)

    def _entries(self, buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Entries of pieces of at most KEPT bytes; what is new is added. -1 where a hash stands for another piece."""
        view = np.ndarray(len(buf) - 7, "<u8", buf.data, strides=(1,))
        h = (size.astype(np.uint64) + np.uint64(1)) * _TIMES
        words, live, k = [], slice(None), 0
        while k == 0 or len(live):
            w = view[start[live] + 8 * k] & _MASKS[np.minimum(size[live] - 8 * k, 8)]
            x = (h[live] ^ w) * _MIX
            h[live] = x ^ (x >> np.uint64(32))
            words.append((live, w))
            k += 1
            live = np.flatnonzero(size > 8) if k == 1 else live[size[live] > 8 * k]
        entry = self._find(h)
        lack = np.flatnonzero(entry < 0)
        if len(lack):
            _, at = np.unique(h[lack], return_index=True)
            at = np.sort(lack[at])
            ends = start[at] + size[at]
            raw = buf.tobytes()
            self._add_values(self._values([raw[a:b] for a, b in zip(start[at].tolist(), ends.tolist())]))  # noqa: B905
            rows = -(-size[at] // 8)
            row_at = np.cumsum(rows) - rows
            held = np.zeros(int(rows.sum()), np.uint64)
            for k, (live, w) in enumerate(words):
                full = np.zeros(len(size), np.uint64)
                full[live] = w
                long = rows > k
                held[row_at[long] + k] = full[at[long]]
            first = self.hash.n
            self.hash.add(h[at])
            self.size.add(size[at])
            self.text_at.add(self.text.n + row_at)
            self.text.add(held)
            self._place(first)
            entry[lack] = self._find(h[lack])
        same = self.size.data[entry] == size
        text_at = self.text_at.data[entry]
        for k, (live, w) in enumerate(words):
            same[live] &= self.text.data[np.minimum(text_at[live] + k, self.text.n - 1)] == w
        entry[~same] = -1
        return entry

    def values(self, texts: pa.Array | list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row (nothing with ``counts``), and how many each text has; nulls are empty."""
        col = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        odd = np.zeros(len(col), bool)
        for s in self.special:
            odd |= pc.match_substring(col, s).to_numpy(zero_copy_only=False)
        if odd.any():
            return self._with_special(col, odd)
        if self.hash.n > self.entries:
            self.clear()
        _, where, data = col.buffers()
        offsets = np.frombuffer(where, np.int64 if pa.types.is_large_string(col.type) else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
        offsets, whole = offsets - offsets[0] if len(offsets) else np.zeros(1, np.int64), offsets
        buf = np.zeros(int(offsets[-1]) + 2 * _PAD, np.uint8)
        if offsets[-1]:
            buf[_PAD:-_PAD] = np.frombuffer(data, np.uint8)[whole[0] : whole[-1]]
        else:
            return np.zeros(0, self.kind), np.zeros(len(col), np.int64)
        start = self._cuts(buf, offsets)
        size = np.diff(start, append=len(buf) - _PAD)
        entry = np.full(len(start), -1, np.int64)
        short = np.flatnonzero(size <= KEPT)
        entry[short] = self._entries(buf, start[short], size[short].astype(np.int32))
        kept = self.at.n, self.n.n, self.ids.n
        rest = np.flatnonzero(entry < 0)
        if len(rest):  # long pieces, and those whose hash another piece has, are not kept
            entry[rest] = np.arange(self.n.n, self.n.n + len(rest))
            pieces = [buf[a : a + n].tobytes() for a, n in zip(start[rest].tolist(), size[rest].tolist(), strict=True)]
            distinct = list(dict.fromkeys(pieces))
            value = dict(zip(distinct, self._values(distinct), strict=True))
            self._add_values([value[p] for p in pieces])
        n = self.n.data[entry]
        ends = np.concatenate([[0], np.cumsum(n)])
        total = np.diff(ends[np.searchsorted(start - _PAD, offsets)])
        if self.counts:
            ids = np.zeros(0, self.kind)
        else:
            ids = self.ids.data[np.repeat(self.at.data[entry] - ends[:-1], n) + np.arange(ends[-1])]
        self.at.n, self.n.n, self.ids.n = kept
        return ids, total

    def _with_special(self, col: pa.Array, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same where texts hold special tokens: these are cut out, and the parts are texts of their own."""
        parts, owner, special = [], [], []
        for k, t in enumerate(col.to_pylist()):
            for x in self.cut.split(t) if odd[k] else [t]:
                special.append(self.special.get(x, -1) if odd[k] else -1)
                parts.append("" if special[-1] >= 0 else x)
                owner.append(k)
        ids, n = self.values(parts)
        mark = np.array(special, np.int64)
        at = np.cumsum(n)[mark >= 0]
        if not self.counts:
            ids = np.insert(ids, at, mark[mark >= 0].astype(self.kind))
        return ids, np.bincount(owner, n + (mark >= 0), len(col)).astype(np.int64)


def packer(path: str) -> tuple[str, Callable[[list[int]], bytes]]:
    """The array code of the narrowest unsigned integers for the file's ids, and what packs a list of them."""
    size = Tokenizer.from_file(path).get_vocab_size()
    code = "H" if size <= 1 << 16 else "I"
    return code, lambda ids: array(code, ids).tobytes()
