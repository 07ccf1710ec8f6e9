"""SentencePiece encoding and decoding with the N best segmentations.

The model file gives the pieces and their order; pieces are scored by the
logarithm of a Zipf law of their rank, since its own scores are ranks. The
pieces found in a text are the arcs of a lattice. Forward Viterbi gives the best
score of every prefix, which is the exact rest cost of a search from the end of
the text, so best-first search (A*) backwards meets the N best segmentations in
order and expands nothing in vain.

No piece holds a space after another character, so a text is a chain of words
that share no arc: each word is segmented by itself (and kept for the next
time), and the search runs again over the chain, in which only the words with
the N - 1 smallest losses of a second choice can differ from the best.

Text is kept whole: a space becomes U+2581, one more is put in front, characters
without a piece become their UTF-8 bytes. Decoding gives the same text, but for
U+2581 itself, which comes back as a space. Null and empty texts have no pieces
and score 0. Equal scores come in a fixed order. Rows are handled one by one:
repeated rows give repeated results, an empty table an empty one; a null id is
carried along. Columns other than id and text are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import insort
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from groundshift.llm.memo import Memo
from groundshift.llm.wordpool import Pool, coded, slices

SPACE = "▁"
MODEL = "piece_bpe_32k.model"
_CHUNK = re.compile(" ( *[^ ]*)")

#: Words kept by a worker; words segmented side by side, and the length from which they are not.
WORDS, TOGETHER, LONG = 300_000, 2048, 24
#: Octets of text handled at once, or one text: what is held beside the words grows with them.
SLICE = 1 << 20
#: Base of the polynomial hashes by which pieces are found in words.
BASE = np.uint64(0x9E3779B97F4A7C15)

Path = tuple[bytes, float]
Arc = tuple[int, bytes, float]
NEVER = -math.inf


def _hash(piece: str) -> int:
    value = 0
    for sign in piece:
        value = (value * int(BASE) + ord(sign) + 1) % (1 << 64)
    return value


def forward(arcs: list[list[Arc]]) -> list[float]:
    """The best score of a path from node 0 to every node."""
    ahead = [0.0]
    for into in arcs[1:]:
        ahead.append(max([ahead[i] + score for i, _, score in into], default=NEVER))
    return ahead


def best_paths(arcs: list[list[Arc]], n: int, ahead: list[float] | None = None) -> list[Path]:
    """The ``n`` best paths from node 0 to the last node, best first.

    ``arcs[j]`` holds ``(i, label, score)`` for every arc from ``i`` to ``j``, ``i < j``;
    ``ahead`` is ``forward(arcs)``. As the rest costs are exact, every open path
    will end with its estimate, so no more of them are kept open than paths are
    still missing, and the best arc is followed at once.
    """
    ahead = ahead or forward(arcs)
    found: list[Path] = []
    agenda = [(ahead[-1], 0, len(arcs) - 1, 0.0, ())]  # the best comes last
    serial = 0
    while agenda and len(found) < n:
        _, _, node, done, path = agenda.pop()
        missing = n - len(found) - 1  # open paths that may still be needed beside this one
        del agenda[: max(0, len(agenda) - missing)]
        while node:
            into = arcs[node]
            if len(into) == 1:
                node, label, score = into[0]
            else:
                ranked = [done + arc[2] + ahead[arc[0]] for arc in into]
                best = max(ranked)
                at = ranked.index(best)
                if missing:
                    for k, estimate in enumerate(ranked):
                        if k != at and (len(agenda) < missing or estimate > agenda[0][0]):
                            arc, serial = into[k], serial - 1
                            insort(agenda, (estimate, serial, arc[0], done + arc[2], (arc[1], path)))
                            if len(agenda) > missing:
                                del agenda[0]
                node, label, score = into[at]
            done += score
            path = (label, path)
        labels = []
        while path:
            labels.append(path[0])
            path = path[1]
        found.append((b"".join(labels), done))
    return found


class Pieces:
    """A SentencePiece vocabulary; ids are little-endian unsigned 32-bit integers."""

    def __init__(self, model_file: str, nbest: int = 3):
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size, self.nbest = model.get_piece_size(), nbest
        norm = math.log(sum(1 / (r + 1) for r in range(size)))
        self.arcs: dict[str, tuple] = {}  # empty for what only begins a piece
        self.bytes: list[tuple[bytes, float]] = [(b"", 0.0)] * 256
        self.text: list[bytes] = [b""] * size
        for i in range(size):
            piece, label, score = model.id_to_piece(i), i.to_bytes(4, "little"), -math.log(i + 1) - norm
            if model.is_byte(i):
                self.bytes[int(piece[3:-1], 16)] = (label, -math.log(size + 1) - norm)
                self.text[i] = bytes([int(piece[3:-1], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                if SPACE in piece.lstrip(SPACE):
                    raise ValueError(f"piece {i} holds a space after another character, so words share arcs")
                self.arcs[piece] = (label, score)
                self.text[i] = piece.replace(SPACE, " ").encode()
                for k in range(1, len(piece)):
                    self.arcs.setdefault(piece[:k], ())
        self.pool = Pool(self._learn, WORDS)
        self.choices = Memo(lambda word: self.paths(word, self.nbest), 50_000)
        by_size: dict[int, list[tuple[int, int, float]]] = {}
        for piece, arc in self.arcs.items():
            if arc:
                by_size.setdefault(len(piece), []).append((_hash(piece), int.from_bytes(arc[0], "little"), arc[1]))
        #: Of each length the pieces' hashes in order, their ids and scores.
        self.tables = {n: [np.array(c, k) for c, k in zip(zip(*sorted(rows)), (np.uint64, np.int32, np.float64))] for n, rows in by_size.items()}

    def lattice(self, word: str) -> tuple[list[list[Arc]], list[float]]:
        """Arcs into every position of ``word``, in which spaces are U+2581 already, and its forward scores."""
        end, get = len(word), self.arcs.get
        into: list[list[Arc]] = [[] for _ in range(end + 1)]
        ahead = [0.0] + [NEVER] * end
        for i in range(end):
            j, base = i + 1, ahead[i]
            if arc := get(word[i]):
                label, score = arc
            else:
                octets = [self.bytes[b] for b in word[i].encode()]
                label, score = b"".join([b for b, _ in octets]), sum([s for _, s in octets])
            into[j].append((i, label, score))
            if base + score > ahead[j]:
                ahead[j] = base + score
            if arc is None:
                continue
            while j < end:
                j += 1
                if (arc := get(word[i:j])) is None:
                    break
                if arc:
                    label, score = arc
                    into[j].append((i, label, score))
                    if base + score > ahead[j]:
                        ahead[j] = base + score
        return into, ahead

    def paths(self, word: str, n: int) -> list[Path]:
        """The ``n`` best segmentations of a word behind its space."""
        arcs, ahead = self.lattice(SPACE + word.replace(" ", SPACE))
        return best_paths(arcs, n, ahead)

    def _word(self, word: str) -> tuple[bytes, float, float]:
        """The best segmentation's ids and score, and what a second choice loses."""
        found = self.paths(word, min(2, self.nbest))
        return (*found[0], found[0][1] - found[1][1] if len(found) > 1 else math.inf)

    def viterbi(self, words: list[str]) -> tuple[np.ndarray, ...]:
        """For words of one length: which have a piece for every character, and of these the
        ids of the best segmentations, how many each has, their scores and losses.

        Forward and backward scores of all words are computed side by side. The
        second choice takes an arc that the best one does not, so its score is the
        best sum of such an arc and the scores before and behind it.
        """
        size = len(words[0]) + 1
        signs = np.frombuffer("".join([SPACE + w.replace(" ", SPACE) for w in words]).encode("utf-32-le"), "<u4").reshape(-1, size)
        longest = min(size, max(self.tables, default=1))
        scores = np.full((longest + 1, len(words), size), NEVER)
        ids, hashes = np.zeros(scores.shape, np.int32), np.zeros(signs.shape, np.uint64)
        for n in range(1, longest + 1):
            hashes = hashes[:, : size - n + 1] * BASE + signs[:, n - 1 :] + np.uint64(1)
            if n in self.tables:
                known, label, score = self.tables[n]
                at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                hit = known[at] == hashes
                scores[n, :, : size - n + 1] = np.where(hit, score[at], NEVER)
                ids[n, :, : size - n + 1] = label[at]
        whole = np.isfinite(scores[1]).all(axis=1)
        scores, ids = scores[:, whole], ids[:, whole]
        count = scores.shape[1]
        ahead, behind, came = np.full((size + 1, count), NEVER), np.full((size + 1, count), NEVER), np.zeros((size + 1, count), np.int64)
        ahead[0], behind[size] = 0.0, 0.0
        for j in range(1, size + 1):
            reach = range(min(longest, j), 0, -1)  # of equal scores the longest last piece counts
            paths = np.stack([ahead[j - n] + scores[n, :, j - n] for n in reach])
            pick = paths.argmax(axis=0)
            ahead[j], came[j] = paths[pick, np.arange(count)], reach[0] - pick
        for i in range(size - 1, -1, -1):
            behind[i] = np.max([scores[n, :, i] + behind[i + n] for n in range(1, min(longest, size - i) + 1)], axis=0)
        place, rows, steps = np.full(count, size), np.arange(count), []
        for n in range(1, longest + 1):
            scores[n, :, : size - n + 1] += (ahead[: size - n + 1] + behind[n:]).T
        while (place > 0).any():
            n = came[place, rows]
            start = place - n
            on = place > 0
            steps.append(np.where(on, ids[n, rows, start], -1))
            scores[n[on], rows[on], start[on]] = NEVER
            place = start
        others = scores[1:].max(axis=(0, 2), initial=NEVER)
        best, taken = ahead[size], np.array(steps[::-1]).reshape(len(steps), count).T
        losses = np.where(np.isfinite(others), np.maximum(best - np.where(np.isfinite(others), others, 0.0), 0.0), np.inf)
        return whole, taken[taken >= 0].astype(np.uint32), (taken >= 0).sum(axis=1), best, losses

    def _learn(self, words: list[str]) -> tuple[list[str], np.ndarray, ...]:
        by_size: dict[int, list[str]] = {}
        for word in words:
            by_size.setdefault(len(word), []).append(word)
        keys, parts, alone = [], [], []
        for size, group in by_size.items():
            if size >= LONG:
                alone += group
                continue
            for at in range(0, len(group), TOGETHER):
                some = group[at : at + TOGETHER]
                whole, *found = self.viterbi(some)
                keys += [w for w, k in zip(some, whole.tolist()) if k]
                alone += [w for w, k in zip(some, whole.tolist()) if not k]
                parts.append(found)
        found = [self._word(w) for w in alone]
        labels = [np.frombuffer(f[0], "<u4") for f in found]
        parts.append([np.concatenate([np.zeros(0, np.uint32), *labels]), np.array(list(map(len, labels)), np.int64), *(np.array([f[k] for f in found], np.float64) for k in (1, 2))])
        return keys + alone, *(np.concatenate(c) for c in zip(*parts))

    def texts(self, texts: pa.Array) -> Iterator[list[Path]]:
        """The N best segmentations of each text: ids and score, best first."""
        texts = pc.fill_null(texts, "")
        simple = ~pc.match_substring_regex(texts, "(?s)^$|^ |  |" + SPACE).to_numpy(zero_copy_only=False)
        keys, codes, counts = coded(texts, simple, lambda t: _CHUNK.findall(" " + t.replace(SPACE, " ")) if t else [])
        at = self.pool.places(keys)[codes] if keys else np.zeros(0, np.int64)
        ids, sizes = self.pool.gathered(at) if keys else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
        octets, upto = ids.astype("<u4", copy=False).tobytes(), np.concatenate([[0], np.cumsum(sizes)]) * 4
        ends = np.cumsum(counts)
        for a, b in zip((ends - counts).tolist(), ends.tolist()):
            if a == b:
                yield [(b"", 0.0)]
                continue
            best, score = octets[upto[a] : upto[b]], math.fsum(self.pool.numbers[1][at[a:b]].tolist())
            if self.nbest == 1:
                yield [(best, score)]
                continue
            losses = self.pool.numbers[2][at[a:b]]
            few = min(self.nbest - 1, b - a)
            cut = np.partition(losses, few - 1)[few - 1]
            free = np.sort(np.concatenate([np.flatnonzero(losses < cut), np.flatnonzero(losses == cut)])[:few])
            free = [int(i) for i in free if losses[i] < math.inf]
            choices = [self.choices[keys[codes[a + i]]] for i in free]
            chain: list[list[Arc]] = [[]]
            for paths in choices:
                chain.append([(len(chain) - 1, bytes([nth]), path[1] - paths[0][1]) for nth, path in enumerate(paths)])
            out = []
            for choice, loss in best_paths(chain, self.nbest):
                pieces, done = [], upto[a]
                for i, paths, nth in zip(free, choices, choice, strict=True):
                    if nth:
                        pieces += [octets[done : upto[a + i]], paths[nth][0]]
                        done = upto[a + i + 1]
                out.append((b"".join([*pieces, octets[done : upto[b]]]), score + loss))
            yield out

    def segmentations(self, text: str) -> list[Path]:
        return next(self.texts(pa.array([text], pa.string())))

    def decode(self, ids: bytes) -> str:
        out = b"".join(map(self.text.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode()
        return out[1:]


@cache
def load(model_file: str, nbest: int) -> Pieces:
    """The vocabulary, loaded once in each worker."""
    return Pieces(model_file, nbest)


SCHEMA = "doc_id long, n_pieces long, ids_crc32 long, score double, scores array<double>, crcs array<long>, decoded string"
KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.float64()), pa.list_(pa.int64()), pa.string(), pa.list_(pa.int32())]


def encoded(batches: Iterable[pa.RecordBatch], pieces: Pieces, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Ids and texts as the columns ``names``, a slice at a time; the ids of the best segmentation if there are eight."""

    def row(doc_id: int | None, found: list[Path]) -> tuple:
        best, score = found[0]
        crcs = [zlib.crc32(b) for b, _ in found]
        out = (doc_id, len(best) // 4, crcs[0], score, [s for _, s in found], crcs, pieces.decode(best))
        return (*out, np.frombuffer(best, "<u4").astype(np.int32)) if len(names) == len(KINDS) else out

    for batch in batches:
        for part in slices(batch, 1, SLICE):
            rows = [row(d, found) for d, found in zip(part.column(0).to_pylist(), pieces.texts(part.column(1)), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), KINDS)], names)


def encode(docs: DataFrame, model_file: str, nbest: int = 3, ids: bool = False) -> DataFrame:
    """``doc_id``, the best segmentation's length, crc32 and score, all N scores and crc32s, and the decoded text.

    With ``ids``, also the ids of the best segmentation as an array.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from encoded(batches, load(model_file, nbest), [c.split()[0] for c in schema.split(", ")])

    schema = SCHEMA + (", ids array<int>" if ids else "")
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
