"""Periodic runs of words: extensions from cover-sampled suffixes, and runs enumerated on harmonic grids."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from haulbook.llm.common import text_or_empty, word_codes

FACTOR = 4      # a run is at least this many periods long,
SHORTEST = 6    # and at least so many words
BATCH_WORDS = 200_000   # texts are laid end to end up to about so many words; a longer text is alone
GRID_PAIRS = 1 << 20    # grid points compared at once

# A perfect difference set, every difference modulo 31 arises once.
MODULUS = 31
COVER = (1, 5, 11, 24, 25, 27)

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_RUN_SQL = "struct<start:bigint,length:bigint,period:bigint>"


def cover_shifts() -> np.ndarray:
    """For residues (a, b) the least d with a + d and b + d both in the cover."""
    inside = np.isin(np.arange(MODULUS), COVER)
    out = np.full((MODULUS, MODULUS), -1)
    for d in range(MODULUS - 1, -1, -1):
        hit = np.roll(inside, -d)
        out[np.ix_(hit, hit)] = d
    return out


_SHIFTS = cover_shifts()


class Extensions:
    """Lengths of the common prefixes of any two suffixes of an array of codes.

    Only suffixes at places whose residue is in the cover are sorted: first by blocks of ``MODULUS`` codes, then by
    doubling. Two places meet the cover after at most ``MODULUS`` - 1 codes, which are compared one by one; from
    there the answer is a range minimum over the common prefixes of neighbours in that order. Codes are 0 or more.
    """

    def __init__(self, codes: np.ndarray):
        last = int(codes.max(initial=-1)) + 1
        # Codes of its own end the array, so that no two suffixes agree to the end.
        self.codes = np.concatenate([codes.astype(np.int64), last + np.arange(3 * MODULUS)])
        size = len(codes) + MODULUS
        places = np.add.outer(np.arange(0, size, MODULUS), np.array(COVER)).ravel()
        self.places = places[places < size]
        self.nth = np.full(MODULUS, -1)
        self.nth[list(COVER)] = np.arange(len(COVER))
        levels = self._ranks()
        self.rank = levels[-1]
        order = np.argsort(self.rank)
        self.table = [self._neighbours(levels, order[:-1], order[1:])]
        while 2 << (len(self.table) - 1) <= len(self.table[0]):
            half, low = 1 << (len(self.table) - 1), self.table[-1]
            self.table.append(np.minimum(low[:-half], low[half:]))

    def _ranks(self) -> list[np.ndarray]:
        """Ranks of the samples by their first ``MODULUS``, twice, four times … as many codes, until all differ."""
        base = int(self.codes[-1]) + 1
        width = max(1, 62 // base.bit_length())
        keys = []
        for first in range(0, MODULUS, width):
            key = np.zeros(len(self.places), dtype=np.int64)
            for c in range(first, min(first + width, MODULUS)):
                key = key * base + self.codes[self.places + c]
            keys.append(key)
        order = np.lexsort(keys[::-1])
        steps = np.zeros(len(order), dtype=bool)
        for key in keys:
            steps[1:] |= np.diff(key[order]) != 0
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.cumsum(steps)
        levels, ahead, count = [rank], len(COVER), len(rank)
        while levels[-1].max(initial=-1) < count - 1:
            later = np.zeros(count, dtype=np.int64)
            later[:max(count - ahead, 0)] = levels[-1][ahead:] + 1
            levels.append(np.unique(levels[-1] * (count + 1) + later, return_inverse=True)[1].ravel())
            ahead *= 2
        return levels

    def _neighbours(self, levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common prefixes of samples a and b: whole blocks by their ranks, then the codes of the last block."""
        a, b, out, count = a.copy(), b.copy(), np.zeros(len(a), dtype=np.int64), len(self.places)
        for k in range(len(levels) - 1, -1, -1):
            ahead = len(COVER) << k
            inside = np.flatnonzero(np.maximum(a, b) < count)
            same = inside[levels[k][a[inside]] == levels[k][b[inside]]]
            out[same] += MODULUS << k
            a[same] += ahead
            b[same] += ahead
        live = np.flatnonzero(np.maximum(a, b) < count)
        x, y = self.places[a[live]], self.places[b[live]]
        for c in range(MODULUS):
            same = self.codes[x + c] == self.codes[y + c]
            live, x, y = live[same], x[same], y[same]
            out[live] += 1
        return out

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common prefix of the suffixes at i and at j, pair by pair; i differs from j."""
        out = np.zeros(len(i), dtype=np.int64)
        shift = _SHIFTS[i % MODULUS, j % MODULUS]
        live = np.arange(len(i))
        met = []
        for c in range(MODULUS):
            there = shift[live] == c
            met.append(live[there])
            live = live[~there]
            if not len(live):
                break
            live = live[self.codes[i[live] + c] == self.codes[j[live] + c]]
            out[live] += 1
        met = np.concatenate(met)
        x, y = (self.rank[p // MODULUS * len(COVER) + self.nth[p % MODULUS]] for p in (i[met] + shift[met], j[met] + shift[met]))
        low, high = np.minimum(x, y), np.maximum(x, y)
        span = np.frexp(high - low)[1] - 1
        for k in np.unique(span):
            at, level = span == k, self.table[k]
            out[met[at]] += np.minimum(level[low[at]], level[high[at] - (1 << k)])
        return out


def find_runs(codes: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and smallest period of all runs with a period up to ``longest``, by start, then period.

    Codes p apart agree along at least (``FACTOR`` - 1) * p places of a run of period p, so these hold a point of the grid
    of that step, and neighbouring multiples of p that agree as well. From each such point the extensions to both
    sides give the whole run. Sum of n / p over the periods: n log n points.
    """
    n, step = len(codes), FACTOR - 1
    longest = min(longest, n // FACTOR)
    forward = backward = None
    found = []
    low = 1
    while low <= longest:
        counts = (n - 1 - np.arange(low, longest + 1)) // (step * np.arange(low, longest + 1)) + 1
        high = low + max(1, int(np.searchsorted(np.cumsum(counts), GRID_PAIRS)))
        counts = counts[:high - low]
        periods = np.repeat(np.arange(low, low + len(counts)), counts)
        i = step * periods * (np.arange(len(periods)) - np.repeat(np.cumsum(counts) - counts, counts))
        low += len(counts)
        alike = codes[i] == codes[i + periods]
        i, p = i[alike], periods[alike]
        # Agreeing multiples of p in a row around the point.
        before, after = np.zeros(len(i), dtype=np.int64), np.zeros(len(i), dtype=np.int64)
        for way, total in ((-1, before), (1, after)):
            live = np.arange(len(i))
            for k in range(1, step):
                x = i[live] + way * k * p[live]
                live, x = (v[(x >= 0) & (x + p[live] < n)] for v in (live, x))
                live = live[codes[x] == codes[x + p[live]]]
                total[live] += 1
        enough = before + after + 1 >= step
        i, p = i[enough], p[enough]
        if not len(i):
            continue
        if forward is None:
            forward, backward = Extensions(codes), Extensions(codes[::-1])
        right, left = forward(i, i + p), backward(n - i, n - i - p)
        start, length = i - left, left + right + p
        long = length >= np.maximum(SHORTEST, FACTOR * p)
        found.append(np.unique(np.stack([start[long], length[long], p[long]]), axis=1))
    if not found:
        return (np.zeros(0, dtype=np.int64),) * 3
    # A multiple of a run's smallest period yields the same stretch: the smallest stays.
    start, length, period = np.unique(np.concatenate(found, axis=1), axis=1)
    new = np.ones(len(start), dtype=bool)
    new[1:] = (np.diff(start) != 0) | (np.diff(length) != 0)
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort([period, start])
    return start[order], length[order], period[order]


def _best(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest exact length by period; ties go to the smallest start, then period, which come first."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _batches(texts: list[str]) -> Iterator[tuple[int, list[list[bytes]]]]:
    first, held, total = 0, [], 0
    for k, text in enumerate(texts):
        words = text.encode().split()
        if held and total + len(words) > BATCH_WORDS:
            yield first, held
            first, held, total = k, [], 0
        held.append(words)
        total += len(words)
    if held:
        yield first, held


def _scan(texts: list[str], seeds: list[int], places: Callable[[int, int], np.ndarray | None] | None) -> tuple:
    """Word counts, offsets and columns of the runs, best runs, and texts without the repeats."""
    words, offsets, columns, best, collapsed = [], [0], [], [], []
    for first, docs in _batches(texts):
        sizes = np.array([len(d) for d in docs])
        codes, kinds = word_codes([w for d in docs for w in d])
        codes = codes.astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        if places:
            for k, (at, size) in enumerate(zip(starts, sizes)):
                order = places(seeds[first + k], int(size)) if size else None
                if order is not None:
                    codes[at:at + size] = codes[at + order]
        # A code of its own stands after each text: no run reaches over it.
        laid = np.full(len(codes) + len(docs), -1)
        inside = np.ones(len(laid), dtype=bool)
        ends = starts + sizes + np.arange(len(docs))
        inside[ends] = False
        laid[inside] = codes
        laid[ends] = len(kinds) + np.arange(len(docs))
        start, length, period = find_runs(laid, int(sizes.max()) // FACTOR)
        owner = np.searchsorted(ends, start)
        fall = np.zeros(len(laid) + 1, dtype=np.int64)
        np.add.at(fall, start + period, 1)
        np.add.at(fall, start + length, -1)
        kept = (np.cumsum(fall)[:-1] == 0)[inside]
        start = start - (starts + np.arange(len(docs)))[owner]
        cuts = np.searchsorted(owner, np.arange(len(docs) + 1))
        for k, (at, size) in enumerate(zip(starts, sizes)):
            own = slice(cuts[k], cuts[k + 1])
            best.append(_best(list(zip(start[own].tolist(), length[own].tolist(), period[own].tolist()))))
            collapsed.append(b" ".join(kinds[codes[at:at + size][kept[at:at + size]]]).decode())
        columns.append(np.stack([start, length, period]))
        offsets.extend((offsets[-1] + cuts[1:]).tolist())
        words.extend(sizes.tolist())
    return words, offsets, np.concatenate(columns, axis=1) if columns else np.zeros((3, 0), dtype=np.int64), best, collapsed


def word_runs(docs: DataFrame, places: Callable[[int, int], np.ndarray | None] | None = None) -> DataFrame:
    """The periodic runs of words of each whole text: doc_id, n_words, runs, best and collapsed, one row per document.

    A run is a stretch of words with smallest period q, at least max(``SHORTEST``, ``FACTOR`` * q) long, that no word beside
    it extends. ``runs`` holds (start, length, period) by start, then period; ``best`` is the one of greatest length by
    period, null without a run; ``collapsed`` is the text without the words that lie in a run after its first period,
    joined by one space. ``places(crc, n)`` may put other words of the text into its n places before the search: it is
    given crc32 of the id (a null id counts as the empty text) and returns word numbers, or None for no change.

    A null or empty text has no words and no runs; repeated rows and ids each come out; an empty table gives an empty one;
    other columns of ``docs`` are not read. A text is searched by one task, in memory proportional to its words.
    """
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    wanted = docs.select("doc_id", text_or_empty().alias("text"), crc.alias("crc"))
    kind = wanted.schema["doc_id"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, offsets, columns, best, collapsed = _scan(batch["text"].to_pylist(), batch["crc"].to_pylist(), places)
            runs = pa.StructArray.from_arrays([pa.array(c) for c in columns], fields=list(_RUN))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(words, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), runs),
                 pa.array([b and dict(zip(("start", "length", "period"), b)) for b in best], _RUN), pa.array(collapsed, pa.string())],
                ["doc_id", "n_words", "runs", "best", "collapsed"])

    return wanted.mapInArrow(task, f"doc_id {kind}, n_words bigint, runs array<{_RUN_SQL}>, best {_RUN_SQL}, collapsed string")


def planted_places(crc: int, n: int) -> np.ndarray | None:
    """One text in ten repeats a stretch of its words from a place on: word a + (i - a) mod p stands at i."""
    if crc % 10 or not n:
        return None
    g = crc // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


def run_report(docs: DataFrame) -> DataFrame:
    """Digest columns of ``word_runs`` with planted repeats; without a run the four of the best run are null."""
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    return word_runs(docs, planted_places).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
