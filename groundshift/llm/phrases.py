"""Phrase collocations, counted by Rabin-Karp fingerprints.

Texts (ASCII letters lowered) are cut into pieces at ``.,;:!?`` and line ends, and
pieces into words at spaces and tabs. A phrase is a run of words inside a piece.
All counts are by language; a null language is ``und``.

1. Words become numbers in blocks, each of one language with its own word list;
   the blocks are a table, so texts are parsed once.
2. Prefix sums of ``hash(word j) * B^j`` (modulo 2^64) give the fingerprint of every
   run of words by one subtraction and one multiplication. A block hands on each
   fingerprint once, with its count and a pointer to one occurrence; occurrences
   whose words differ from the pointer's are entries of their own.
3. The shuffle adds the counts by fingerprint. Where the sum reaches ``least``, the
   pointers go back to their blocks, which read the words and hand on phrases and
   counts, packed by bucket; the final counts are by text, so fingerprints that
   collide do no harm. Only phrases found frequent then become rows.
4. Phrases of three and four words are counted where all their pairs of words have
   frequent fingerprints, which every frequent phrase fulfils.

The score of a cut of a phrase into two parts is ``floor(2000000 * a / (l + r))``,
computed on decimals; ``a, l, r`` are the counts of the phrase and its parts.

Null and empty texts have no words; repeated rows count each; an empty table, or one
without a frequent phrase, gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import gc
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from groundshift.llm.scratch import stored
from groundshift.llm.spread import spread_join

#: Words of a block, and words of the table for each bucket of fingerprints.
BLOCK_WORDS, BUCKET_WORDS = 2_000_000, 2_000_000
LONGEST = 4
#: Parts of a language that are ranked by themselves first.
PARTS = 64
BREAKS = b".,;:!?\n\x0b\x0c\r"
#: Breaks become line ends, tabs become spaces, capitals become small letters.
MARKED = bytes(10 if b in BREAKS else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_NO_BREAK = re.compile(rb"\n+")
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse
INVERSE = pow(BASE, -1, 1 << 64)
MIXERS = (np.random.default_rng(11).integers(0, 1 << 63, LONGEST + 1, np.uint64) * np.uint64(2) + np.uint64(1)).tolist()
BREAK, NOTHING = -1, -2


class Numbers(dict):
    """Numbers words in the order in which they first come."""

    def __init__(self):
        super().__init__({b"\n": BREAK, b"": NOTHING})

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self) - 2
        return number


def numbered(text: str | None, numbers: Numbers) -> np.ndarray:
    """Word numbers of a text, ``BREAK`` between pieces and at the end."""
    marked = _NO_BREAK.sub(b" \n ", (text or "").encode("utf-8", "replace").translate(MARKED)) + b" \n"
    words = marked.split(b" ")
    ids = np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))
    return ids[ids != NOTHING]


BLOCK = "block long, lang string, n long, words binary, ids binary"


def blocks(docs: DataFrame) -> DataFrame:
    """Texts as word numbers: rows of at most about ``BLOCK_WORDS`` words of one language, or of one text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # words and numbers hold no cycles
        first, serial, held, total = TaskContext.get().partitionId() << 32, 0, {}, 0

        def written() -> Iterator[pa.RecordBatch]:
            nonlocal serial
            for lang, (numbers, parts) in held.items():
                ids = np.concatenate(parts)
                if n := int((ids != BREAK).sum()):
                    words = b"\n".join(list(numbers)[2:])
                    row = [[first + serial], [lang], [n], [words], [ids.tobytes()]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(row, (pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.binary()))], names)
                    serial += 1

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                numbers, parts = held.setdefault(lang, (Numbers(), []))
                parts.append(numbered(text.as_py(), numbers))
                total += len(parts[-1])
                if total >= BLOCK_WORDS:
                    yield from written()
                    held, total = {}, 0
        yield from written()

    names = [c.split()[0] for c in BLOCK.split(", ")]
    return stored(docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").mapInArrow(run, BLOCK), "word-blocks")


class Block:
    """Word numbers of a block and its prefix polynomials."""

    def __init__(self, lang: str, words: bytes, ids: bytes):
        self.words, self.ids = words.split(b"\n"), np.frombuffer(ids, np.int32)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, self.words), np.uint64, len(self.words))
        values = np.where(self.ids >= 0, hashes[self.ids], np.uint64(0))
        size = len(self.ids)
        self.prefix, self.back = np.zeros(size + 1, np.uint64), np.ones(size, np.uint64)
        powers = np.cumprod(np.full(size, BASE, np.uint64))
        np.cumsum(values * powers, out=self.prefix[1:])
        self.back[:] = np.cumprod(np.full(size, INVERSE, np.uint64))
        self.breaks = np.concatenate([[0], np.cumsum(self.ids < 0)])
        self.seed = np.uint64(xxhash.xxh64_intdigest(lang))

    def starts(self, n: int) -> np.ndarray:
        """Places of runs of ``n`` words inside a piece."""
        return np.flatnonzero(self.breaks[n:] == self.breaks[:-n]) if n <= len(self.ids) else np.zeros(0, np.int64)

    def fingerprints(self, n: int, starts: np.ndarray) -> np.ndarray:
        plain = (self.prefix[starts + n] - self.prefix[starts]) * self.back[starts]
        return (plain + self.seed) * np.uint64(MIXERS[n])

    def entries(self, n: int, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``fingerprint, count, place``; one entry for all occurrences of the same words."""
        while len(starts):
            found = self.fingerprints(n, starts)
            order = np.argsort(found, kind="stable")
            found, starts = found[order], starts[order]
            new = np.concatenate([[True], found[1:] != found[:-1]])
            first = np.flatnonzero(new)
            pointer = starts[first][np.cumsum(new) - 1]
            same = np.ones(len(starts), bool)
            for k in range(n):
                same &= self.ids[starts + k] == self.ids[pointer + k]
            yield found[first], np.add.reduceat(same.astype(np.int64), first), starts[first]
            starts = starts[~same]

    def text(self, n: int, places: np.ndarray) -> list[bytes]:
        runs = self.ids[places[:, None] + np.arange(n)].tolist()
        return [b" ".join([self.words[i] for i in run]) for run in runs]


def bucket_of(fingerprints: np.ndarray, buckets: int) -> np.ndarray:
    return ((fingerprints >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


SENT = "bucket long, block long, words int, fingerprints binary, counts binary, places binary"


def sent(block: int, data: Block, runs: list[tuple[int, np.ndarray]], buckets: int) -> pa.Table:
    """Entries of runs of words (length, places), one row for each length and bucket."""
    rows = []
    for n, starts in runs:
        for found, count, place in data.entries(n, starts):
            bucket = bucket_of(found, buckets)  # found is sorted
            for some in np.split(np.arange(len(found)), np.flatnonzero(np.diff(bucket)) + 1):
                rows.append((int(bucket[some[0]]), block, n, found[some].tobytes(), count[some].astype(np.int32).tobytes(), place[some].astype(np.int32).tobytes()))
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 6, kinds)], [c.split()[0] for c in SENT.split(", ")])


BACK = "block long, words int, places binary, counts binary"


def frequent(entries: DataFrame, least: int) -> DataFrame:
    """Pointers and counts of the fingerprints that reach ``least``, for each block."""

    def run(table: pa.Table) -> pa.Table:
        block, words = table.column("block").to_numpy(), table.column("words").to_numpy()
        parts = [[np.frombuffer(x, k) for x in table.column(c).to_pylist()] for c, k in (("fingerprints", np.uint64), ("counts", np.int32), ("places", np.int32))]
        owner = np.repeat(np.arange(len(block)), [len(p) for p in parts[0]])
        found, count, place = (np.concatenate(p) for p in parts)
        order = np.argsort(found, kind="stable")
        found = found[order]
        first = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
        sums = np.add.reduceat(count[order].astype(np.int64), first)
        kept = np.sort(order[np.repeat(sums, np.diff(np.concatenate([first, [len(found)]]))) >= least])
        rows = []
        for some in np.split(kept, np.flatnonzero(np.diff(owner[kept])) + 1) if len(kept) else []:
            row = owner[some[0]]
            rows.append((int(block[row]), int(words[row]), place[some].tobytes(), count[some].tobytes()))
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary()]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 4, kinds)], [c.split()[0] for c in BACK.split(", ")])

    return entries.groupBy("bucket").applyInArrow(run, BACK)


def replies(back: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for n, places, counts in zip(*(back.column(c).to_pylist() for c in ("words", "places", "counts"))):
        yield n, np.frombuffer(places, np.int32), np.frombuffer(counts, np.int32)


def opened(table: pa.Table) -> tuple[int, str, Block]:
    row = table.to_pylist()[0]
    return row["block"], row["lang"], Block(row["lang"], row["words"], row["ids"])


def counts(held: DataFrame, least: int) -> DataFrame:
    """``lang, phrase, words, f``: every run of one to four words found ``least`` times or more."""
    total = held.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_WORDS))

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block, _, data = opened(pa.Table.from_batches([batch.slice(i, 1)]))
                yield from sent(block, data, [(n, data.starts(n)) for n in (1, 2)], buckets).to_batches()

    def long(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return sent(0, None, [], buckets)
        block, _, data = opened(left)
        pairs = np.concatenate([np.zeros(0, np.int64)] + [places for n, places, _ in replies(right) if n == 2]).astype(np.int64)
        starts = data.starts(2)
        good = np.zeros(len(data.ids), bool)
        good[starts] = np.isin(data.fingerprints(2, starts), data.fingerprints(2, pairs))
        runs = []
        for n in range(3, LONGEST + 1):
            starts = data.starts(n)
            for k in range(n - 1):
                starts = starts[good[starts + k]]
            runs.append((n, starts))
        return sent(block, data, runs, buckets)

    def written(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        if left.num_rows:
            _, lang, data = opened(left)
            for n, places, count in replies(right):
                found = data.fingerprints(n, places.astype(np.int64))
                order = np.argsort(found)
                places, count, bucket = places[order], count[order], bucket_of(found[order], buckets)
                for some in np.split(np.arange(len(found)), np.flatnonzero(np.diff(bucket)) + 1):
                    rows.append((int(bucket[some[0]]), lang, n, b"\n".join(data.text(n, places[some])), count[some].tobytes()))
        kinds = [pa.int64(), pa.string(), pa.int32(), pa.binary(), pa.binary()]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 5, kinds)], ["bucket", "lang", "words", "phrases", "counts"])

    def added(table: pa.Table) -> pa.Table:
        sums: dict[tuple, Counter] = {}
        for _, lang, n, text, found in zip(*(c.to_pylist() for c in table.columns)):
            held = sums.setdefault((lang, n), Counter())
            for phrase, count in zip(text.split(b"\n"), np.frombuffer(found, np.int32).tolist(), strict=True):
                held[phrase] += count
        rows = [(lang, phrase, n, f) for (lang, n), held in sums.items() for phrase, f in held.items() if f >= least]
        lang, phrase, n, f = zip(*rows) if rows else [[]] * 4
        return pa.table({"lang": pa.array(lang, pa.string()), "phrase": pa.array(phrase, pa.binary()).cast(pa.string()), "words": pa.array(n, pa.int32()), "f": pa.array(f, pa.int64())})

    one = stored(frequent(held.mapInArrow(short, SENT), least), "short-phrases")
    two = frequent(held.groupBy("block").cogroup(one.where("words = 2").groupBy("block")).applyInArrow(long, SENT), least)
    both = stored(one.unionByName(two), "frequent-runs")
    text = held.groupBy("block").cogroup(both.groupBy("block")).applyInArrow(written, "bucket long, lang string, words int, phrases binary, counts binary")
    return stored(text.groupBy("bucket").applyInArrow(added, "lang string, phrase string, words int, f long"), "phrase-counts")


def scored(grams: DataFrame) -> DataFrame:
    """``lang, phrase, words, a, l, r, score`` of every phrase of two words or more, by its lowest-scoring cut."""
    keyed = grams.withColumn("key", F.xxhash64("lang", "phrase"))
    parts = grams.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    cuts = parts.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    for name, part in (("l", F.slice("w", F.lit(1), F.col("k"))), ("r", F.slice("w", F.col("k") + 1, F.col("words") - F.col("k")))):
        cuts = cuts.withColumn("part", F.array_join(part, " ")).withColumn("key", F.xxhash64("lang", "part"))
        side = keyed.select("key", F.col("lang").alias("_lang"), F.col("phrase").alias("_phrase"), F.col("f").alias(name))
        cuts = spread_join(cuts, side, "key", "phrase").where("_lang = lang and _phrase = part").drop("key", "part", "_lang", "_phrase")
    value = F.expr("(cast(2000000 as decimal(18, 0)) * cast(a as decimal(19, 0))) div (cast(l as decimal(19, 0)) + cast(r as decimal(19, 0)))")
    best = cuts.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct(value.alias("score"), "k", "l", "r")).alias("cut"))
    return best.select("lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score")


def without_parts(found: DataFrame, share: int) -> DataFrame:
    """Phrases that lie in no longer one with ``share`` percent of their count or more."""
    longer = found.where("words > 2").select("lang", "words", "a", F.split("phrase", " ").alias("w"))
    longer = longer.withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
    longer = longer.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
    longer = longer.select("lang", F.array_join(F.slice("w", F.col("at"), F.col("size")), " ").alias("phrase"), "a")
    most = longer.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    kept = F.coalesce(F.col("most").cast("decimal(19, 0)") * 100 < F.col("a").cast("decimal(19, 0)") * share, F.lit(True))
    return found.join(most, ["lang", "phrase"], "left").where(kept).drop("most")


def collocations(docs: DataFrame, least: int = 30, share: int = 80, top: int = 2000) -> DataFrame:
    """The ``top`` phrases of two to four words of each language: ``lang, rank, phrase, a, l, r, n, score``."""
    held = blocks(docs)
    totals = held.groupBy("lang").agg(F.sum("n").alias("n"))
    found = without_parts(stored(scored(counts(held, least)), "scored-phrases"), share)
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the first of parts of a language come before the first of all, so that its task gets PARTS * top rows at most
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang", part).orderBy(*best))).where(F.col("rank") <= top)
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= top)
    return found.join(totals, "lang").select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
