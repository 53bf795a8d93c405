"""Token ids of whole texts: each distinct fragment is encoded once, then ids are gathered.

A text is cut at white space and between a letter and an ASCII mark other than the
apostrophe. The tokenizer's own pattern always breaks there, drops white space and lower-
cases, so the ids of the fragments in order are the ids of the text. A text that spells
one of the tokenizer's special tokens is encoded whole.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa

from shiftledger.llm import textbytes as tb

END_ID = 1
_OTHER, _LETTER, _MARK, _SPACE = 0, 1, 2, 3
_KEEP = 1_200_000  # fragments remembered between batches of a worker

_CLASS = np.zeros(256, np.uint8)
_CLASS[33:48] = _MARK
_CLASS[58:65] = _MARK
_CLASS[91:97] = _MARK
_CLASS[123:127] = _MARK
_CLASS[39] = _OTHER
_CLASS[65:91] = _LETTER
_CLASS[97:123] = _LETTER
_CLASS[tb.SPACE] = _SPACE


def _classes(data: np.ndarray) -> np.ndarray:
    """Byte classes; U+00C0 to U+00FF but the two arithmetic signs are letters too."""
    kind = _CLASS[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    second = data[lead + 1]
    lead = lead[(second != 0x97) & (second != 0xB7) & (second >= 0x80)]
    kind[lead] = _LETTER
    kind[lead + 1] = _LETTER
    return kind


class FragmentEncoder:
    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # The pattern never breaks a fragment of letters, so many of them go through the
        # same model in one call, told apart by the mark that ends a word's last token.
        self.letters = Tokenizer.from_file(path)
        self.letters.normalizer = normalizers.Sequence(
            [normalizers.NFC(), normalizers.Lowercase()]
        )
        self.letters.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.WhitespaceSplit(),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        names = self.tokenizer.get_vocab()
        self.last = np.zeros(max(names.values()) + 1, bool)
        self.last[[i for name, i in names.items() if name.endswith("</w>")]] = True
        self.special = [
            t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()
        ]
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.start = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _letters(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids = []
        for at in range(0, len(texts), 8192):
            joined = b" ".join(texts[at : at + 8192]).decode("utf-8")
            (e,) = self.letters.encode_batch_fast([joined], add_special_tokens=False)
            ids.append(np.array(e.ids, np.uint32))
        flat = np.concatenate(ids)
        return flat, np.diff(np.flatnonzero(self.last[flat]), prepend=-1)

    def _others(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = []
        for at in range(0, len(texts), 4096):
            batch = [t.decode("utf-8") for t in texts[at : at + 4096]]
            found += [e.ids for e in self.tokenizer.encode_batch_fast(batch, add_special_tokens=False)]
        return (
            np.array([t for ids in found for t in ids], np.uint32),
            np.array([len(ids) for ids in found], np.int64),
        )

    def _learn(self, keys: np.ndarray, texts: list[bytes], letters: np.ndarray) -> None:
        """Encode new fragments; keys are sorted and not known yet."""
        count = np.zeros(len(keys), np.int64)
        start = np.zeros(len(keys), np.int64)
        for which, encode in ((np.flatnonzero(letters), self._letters), (np.flatnonzero(~letters), self._others)):
            if len(which):
                flat, n = encode([texts[i] for i in which])
                count[which] = n
                start[which] = np.cumsum(n) - n + len(self.ids)
                self.ids = np.concatenate([self.ids, flat])
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.start = np.insert(self.start, at, start)
        self.count = np.insert(self.count, at, count)

    def _piece(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = len(bounds) - 1
        if len(data) == 0:
            return np.full(rows, END_ID, np.uint32), np.ones(rows, np.int64)
        if len(self.keys) > _KEEP:
            self.clear()
        kind = _classes(data)
        data = tb.LOWER[data]
        cut = np.zeros(len(data), bool)
        cut[1:] = (kind[1:] ^ kind[:-1]) == (_LETTER ^ _MARK)
        cut[1:] |= (kind[1:] == _SPACE) != (kind[:-1] == _SPACE)
        cut[bounds[:-1][bounds[:-1] < len(data)]] = True
        start = np.flatnonzero(cut | (np.arange(len(data)) == 0))
        end = np.append(start[1:], len(data))
        keep = kind[start] != _SPACE
        start, end = start[keep], end[keep]
        hashes = tb.substring_hash(tb.prefix_sums(data), start, end)
        hashes ^= (end - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == distinct[inside]
        if not known.all():
            raw = data.tobytes()
            new = first[~known]
            a, b = start[new], end[new]
            letter = np.append(0, np.cumsum(kind == _LETTER))
            self._learn(
                distinct[~known],
                [raw[x:y] for x, y in zip(a.tolist(), b.tolist())],
                letter[b] - letter[a] == b - a,
            )
            at = np.searchsorted(self.keys, distinct)
        begin, count = self.start[at][which], self.count[at][which]
        # one end id after each row: a gap of one in the output
        row_of = np.searchsorted(bounds, start, "right") - 1
        sizes = np.bincount(row_of, weights=count, minlength=rows).astype(np.int64) + 1
        out = np.empty(int(sizes.sum()), np.uint32)
        stops = np.cumsum(sizes) - 1
        body = np.ones(len(out), bool)
        body[stops] = False
        total = int(count.sum())
        source = np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(total)
        out[body] = self.ids[source]
        out[stops] = END_ID
        return out, sizes

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a column, one end id after each row, and each row's number of ids."""
        data, bounds = tb.bytes_of(column)
        ids, sizes = [], []
        for _, _, part, at in tb.pieces(data, bounds, 1 << 20):
            raw = part.tobytes()
            if any(s in raw for s in self.special):
                for a, b in zip(at[:-1], at[1:]):
                    one = raw[a:b]
                    if any(s in one for s in self.special):
                        e = self.tokenizer.encode(one.decode("utf-8"), add_special_tokens=False)
                        ids.append(np.array([*e.ids, END_ID], np.uint32))
                        sizes.append(np.array([len(e.ids) + 1], np.int64))
                    else:
                        x, n = self._piece(part[a:b], np.array([0, b - a]))
                        ids.append(x)
                        sizes.append(n)
            else:
                x, n = self._piece(part, at)
                ids.append(x)
                sizes.append(n)
        if not ids:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        return np.concatenate(ids), np.concatenate(sizes)


_held: dict[str, FragmentEncoder] = {}


def encoder(path: str) -> FragmentEncoder:
    """The worker's encoder; its memory of fragments serves later batches and tasks."""
    if path not in _held:
        _held[path] = FragmentEncoder(path)
    return _held[path]


def crc32_of(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
