"""Token ids of many texts at once, for the lower-case word vocabulary.

Its pre-tokeniser never joins across ASCII white space, nor letters with signs
or digits. So texts are cut into runs of letters, runs of signs and single
digits by numpy; each distinct run is given to the tokenizer once per worker
(many in one call, with a separator between them) and remembered by its 64-bit
hash. Words with anything beyond ASCII and Latin-1 letters, with apostrophes,
control characters or a possible special token go to the tokenizer whole.
"""

from __future__ import annotations

import os

import numpy as np

from lakecraft.llm.words import SPACES, U64, Words, worker_state

#: Distinct runs that a worker remembers (about 40 bytes each).
MEMO = 3_000_000
SEPARATOR = "\x01"

_SPACE, _LETTER, _SIGN, _DIGIT, _OTHER = range(5)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[33:127] = _SIGN
_CLASS[39] = _OTHER
_CLASS[48:58] = _DIGIT
_CLASS[65:91] = _CLASS[97:123] = _LETTER
_CLASS[SPACES] = _SPACE


class TokenIds:
    """``slice_ids`` gives the ids of a slice of texts as one array with per-text counts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.encode = Tokenizer.from_file(path).encode_batch
        found = self._ids([SEPARATOR])[0]
        self.separator = int(found[0]) if len(found) == 1 else None
        self.words: dict[bytes, np.ndarray] = {}
        self._clear()

    @classmethod
    def of_worker(cls, path: str) -> TokenIds:
        state = worker_state()
        if f"ids {path}" not in state:
            state[f"ids {path}"] = cls(path)
        return state[f"ids {path}"]

    def _clear(self) -> None:
        self.key = np.zeros(0, U64)
        self.at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int32)
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.encode(texts, add_special_tokens=False)]

    def _encode_runs(self, runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all runs in a row, and how many each run has."""
        flat, size = [], []
        for k in range(0, len(runs), 4096):
            part = [x.decode() for x in runs[k:k + 4096]]
            if self.separator is None:
                each = self._ids(part)
                flat += each
                size.append(np.array([len(x) for x in each], np.int32))
            else:
                ids = self._ids([f" {SEPARATOR} ".join(part)])[0]
                cut = np.flatnonzero(ids == self.separator)
                flat.append(np.delete(ids, cut))
                size.append((np.diff(np.concatenate([[-1], cut, [len(ids)]])) - 1).astype(np.int32))
        size = np.concatenate(size)
        assert len(size) == len(runs)
        return np.concatenate(flat), size

    def _store(self, ids: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Pool places of the runs."""
        total = len(ids)
        if self.used + total > len(self.pool):
            grown = np.zeros(max(2 * len(self.pool), self.used + total), np.uint32)
            grown[:self.used] = self.pool[:self.used]
            self.pool = grown
        self.pool[self.used:self.used + total] = ids
        at = self.used + np.cumsum(size, dtype=np.int64) - size
        self.used += total
        return at

    def _runs(self, hashes: np.ndarray, start: np.ndarray, end: np.ndarray, data: np.ndarray):
        """Pool place and size of each run's ids."""
        key, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.key) + len(key) > MEMO:
            self._clear()
            self.words.clear()
        at = np.searchsorted(self.key, key)
        known = np.zeros(len(key), bool)
        inside = at < len(self.key)
        known[inside] = self.key[at[inside]] == key[inside]
        new = np.flatnonzero(~known)
        if len(new):
            raw = data.tobytes()
            ids, sizes = self._encode_runs([raw[i:j] for i, j in zip(start[first[new]].tolist(), end[first[new]].tolist())])
            places = self._store(ids, sizes)
            where = at[new]
            self.key = np.insert(self.key, where, key[new])
            self.at = np.insert(self.at, where, places)
            self.size = np.insert(self.size, where, sizes)
            at = np.searchsorted(self.key, key)
        return self.at[at][back], self.size[at][back]

    def _whole(self, words: list[bytes]):
        """Pool place and size of the ids of words given to the tokenizer as they are."""
        new = list({w for w in words if w not in self.words})
        if new:
            ids = self._ids([w.decode("utf-8", "replace") for w in new])
            size = np.array([len(x) for x in ids], np.int32)
            at = self._store(np.concatenate(ids), size)
            self.words.update(zip(new, zip(at.tolist(), size.tolist())))
        found = np.array([self.words[w] for w in words], np.int64).reshape(-1, 2)
        return found[:, 0], found[:, 1].astype(np.int32)

    def slice_ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each text has."""
        n = len(data)
        kind = _CLASS[data]
        low = data.copy()
        low[(data >= 65) & (data <= 90)] += 32
        lead = np.flatnonzero(data[:-1] == 0xC3) if n else np.zeros(0, np.int64)
        after = data[lead + 1]
        letter = (after >= 0x80) & (after <= 0xBF) & (after != 0x97) & (after != 0xB7)
        lead, after = lead[letter], after[letter]
        kind[lead] = kind[lead + 1] = _LETTER
        upper = lead[(after <= 0x9E)] + 1
        low[upper] += 32
        special = np.flatnonzero((data[:-1] == ord("<")) & (data[1:] == ord("|"))) if n else np.zeros(0, np.int64)
        kind[special] = _OTHER
        words = Words(low, offsets)
        other = np.zeros(n + 1, np.int64)
        np.cumsum(kind == _OTHER, out=other[1:])
        odd = other[words.end] > other[words.start]
        # run starts: word starts, changes of class, digits
        start = np.zeros(n, bool)
        start[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        start &= words.inside
        start[words.start] = True
        stop = np.zeros(n + 1, bool)
        stop[1:n] = start[1:] | ~words.inside[1:]
        stop[words.end] = True
        first = np.flatnonzero(start)
        last = np.flatnonzero(stop[1:] & words.inside) + 1
        if odd.any():
            mark = np.zeros(n + 1, np.int64)
            np.add.at(mark, words.start[odd], 1)
            np.add.at(mark, words.end[odd], -1)
            plain = np.cumsum(mark)[first] == 0
            first, last = first[plain], last[plain]
        at, size = self._runs(words.spans_hash(first, last), first, last, low)
        if odd.any():
            raw = data.tobytes()
            a, s = self._whole([raw[i:j] for i, j in zip(words.start[odd].tolist(), words.end[odd].tolist())])
            first = np.concatenate([first, words.start[odd]])
            order = np.argsort(first, kind="stable")
            first, at, size = first[order], np.concatenate([at, a])[order], np.concatenate([size, s])[order]
        row = np.searchsorted(offsets, first, side="right") - 1
        counts = np.bincount(row, weights=size, minlength=len(offsets) - 1).astype(np.int64)
        before = np.cumsum(size, dtype=np.int64) - size
        take = np.arange(int(size.sum())) + np.repeat(at - before, size)
        return self.pool[take], counts
