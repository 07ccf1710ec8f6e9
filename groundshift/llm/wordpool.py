"""Words of a batch of texts as places in a pool of what was learned of each word."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Octets of text handled at once, or one text.
SLICE_BYTES = 8 << 20


def slices(batch: pa.RecordBatch, text: int, octets: int | None = None) -> Iterator[pa.RecordBatch]:
    """The batch in parts of at most ``octets`` (``SLICE_BYTES``) of text, or of one row."""
    octets = octets or SLICE_BYTES
    upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + octets, "right")))
        yield batch.slice(at, stop - at)
        at = stop


def coded(texts: pa.Array, simple: np.ndarray, split: Callable[[str], list[str]], first: bool = False) -> tuple[list, np.ndarray, np.ndarray]:
    """``keys, codes, counts``: the words of all texts as numbers of keys, and the words of each text.

    ``simple`` texts are cut at every space in Arrow, the others by ``split``.
    With ``first``, the first word of a text is a key of its own, a tuple.
    """
    parts = pc.split_pattern(texts.filter(pa.array(simple)), " ")
    words = parts.flatten().dictionary_encode()
    keys, slow = words.dictionary.to_pylist(), [split(t) for t in texts.filter(pa.array(~simple)).to_pylist()]
    counts = np.empty(len(texts), np.int64)
    counts[simple] = pc.list_value_length(parts).to_numpy(zero_copy_only=False)
    counts[~simple] = [len(s) for s in slow]
    codes, plain = np.empty(int(counts.sum()), np.int64), np.repeat(simple, counts)
    codes[plain] = words.indices.to_numpy(zero_copy_only=False)
    rest = [w for s in slow for w in s]
    codes[~plain] = np.arange(len(keys), len(keys) + len(rest))
    keys += rest
    if first:
        at = (np.cumsum(counts) - counts)[counts > 0]
        heads = [(keys[c],) for c in codes[at].tolist()]
        codes[at] = np.arange(len(keys), len(keys) + len(heads))
        keys += heads
    return keys, codes, counts


class Pool:
    """Ids and numbers of keys, learned when they are first met and held in arrays.

    ``learn(keys)`` gives the keys in an order of its own, their ids one after the
    other, how many each has, and any further numbers of each. Before more than
    ``limit`` keys are held those asked for once only go, so places are good until the
    next call.
    """

    def __init__(self, learn: Callable[[list], tuple[np.ndarray, ...]], limit: int):
        self.learn, self.limit = learn, limit
        self._clear()

    def _clear(self) -> None:
        self.at: dict = {}
        self.ids, self.numbers, self.asked = np.zeros(0, np.uint32), None, np.zeros(0, np.int64)

    def _evict(self) -> None:
        """Keep the keys that several calls have asked for, the most asked for if these are many."""
        keep = np.flatnonzero(self.asked > 1)
        if len(keep) > self.limit // 2:
            keep = np.sort(np.argsort(-self.asked, kind="stable")[: self.limit // 2])
        if not len(keep):
            self._clear()
            return
        names = list(self.at)
        self.ids, _ = self.gathered(keep)
        self.numbers, self.asked = [x[keep] for x in self.numbers], (self.asked[keep] + 1) // 2
        self.starts = np.cumsum(self.numbers[0]) - self.numbers[0]
        self.at = {names[i]: k for k, i in enumerate(keep.tolist())}

    def places(self, keys: list) -> np.ndarray:
        found = self._found(keys)
        if (missing := np.flatnonzero(found < 0)).size:
            new = list(dict.fromkeys([keys[i] for i in missing.tolist()]))
            if self.at and len(self.at) + len(new) > self.limit:
                self._evict()
                found = self._found(keys)
                missing = np.flatnonzero(found < 0)
                new = list(dict.fromkeys([keys[i] for i in missing.tolist()]))
            new, ids, sizes, *more = self.learn(new)
            numbers = [np.asarray(x) for x in (sizes, *more)]
            self.numbers = numbers if self.numbers is None else [np.concatenate(x) for x in zip(self.numbers, numbers)]
            self.ids = np.concatenate([self.ids, ids])
            self.starts = np.cumsum(self.numbers[0]) - self.numbers[0]
            self.at.update(zip(new, range(len(self.at), len(self.at) + len(new))))
            self.asked = np.concatenate([self.asked, np.zeros(len(new), np.int64)])
            found[missing] = [self.at[keys[i]] for i in missing.tolist()]
        self.asked[found] += 1
        return found

    def _found(self, keys: list) -> np.ndarray:
        return np.fromiter(map(self.at.get, keys, repeat(-1)), np.int64, len(keys))

    def gathered(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the keys at ``places`` one after the other, and the number of each."""
        sizes = self.numbers[0][places]
        ends = np.cumsum(sizes)
        shift = np.repeat(self.starts[places] - (ends - sizes), sizes)
        return self.ids[shift + np.arange(len(shift))], sizes
