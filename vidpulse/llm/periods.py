"""Runs of repeated word sequences by Kruskal's algorithm over suffixes, longest common prefix first.

A run is a stretch of words with smallest period q, at least ``max(MIN_WORDS, MIN_TURNS * q)``
words long, that no neighbouring word extends. Its first word's suffix and the suffix one
period later agree for exactly ``length - q`` words.

* Neighbours in suffix order are edges that weigh their longest common prefix. From the
  longest down, union-find unites the classes at both ends, the smaller into the larger.
* A class keeps its positions in order. Positions that become neighbours there at
  distance ``d`` agree for exactly the present weight ``l``; with ``l >= (MIN_TURNS - 1) * d``
  they seed a run of period ``d`` and length ``d + l``, if the words before both differ.
  A period smaller than ``d`` would have put a position between them before.

Every four words in a run occur in it again, one period on or back, so only stretches of
words whose fours recur within the stretch are sorted; this narrowing is repeated until
nothing changes and loses no run.

Defined results: a null text has no words; rows are judged each by itself, repeated ones
and null ids too; texts are whole, and a very long one is bounded by its own words'
arrays; equal exponents go to the smallest start, then period; an empty table gives an
empty result. Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from vidpulse.llm.common import coded, ragged_take, slices, split_words, texts_of

MIN_WORDS = 6
MIN_TURNS = 4
#: Consecutive words that recur one period away wherever they lie in a run (see the head).
GRAM = 4
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def recurring_stretches(codes: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(start, length)`` of the stretches of ``codes`` in which every gram recurs; ``group`` parts texts."""
    starts, lengths = _groups(group)
    while len(starts):
        at = ragged_take(starts, lengths)
        own = np.repeat(np.arange(len(starts)), lengths)
        grams = _gram_keys(codes, at, own)
        inner = np.ones(len(at), bool)
        ends = np.cumsum(lengths)
        for k in range(1, GRAM):
            inner[ends[lengths >= k] - k] = False
        inner[np.repeat(lengths < GRAM, lengths)] = False
        keys = grams[inner]
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        again = np.zeros(len(keys), bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        recurs = np.zeros(len(at), bool)
        recurs[np.flatnonzero(inner)[again]] = True
        first = np.flatnonzero(recurs & ~(np.append(False, recurs[:-1]) & np.append(False, own[1:] == own[:-1])))
        if not len(first):
            return starts[:0], lengths[:0]
        last = np.flatnonzero(recurs & ~(np.append(recurs[1:], False) & np.append(own[1:] == own[:-1], False)))
        found, sizes = at[first], last - first + GRAM
        long = sizes >= MIN_WORDS
        found, sizes = found[long], sizes[long]
        if len(found) == len(starts) and (sizes == lengths).all():
            return found, sizes
        starts, lengths = found, sizes
    return starts, lengths


def _groups(group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(group)]])
    sizes = np.diff(cuts)
    return cuts[:-1][sizes >= MIN_WORDS], sizes[sizes >= MIN_WORDS]


def _gram_keys(codes: np.ndarray, at: np.ndarray, own: np.ndarray) -> np.ndarray:
    """A hash of the words from each position on and of the stretch it lies in; equal ones may clash."""
    keys = own.astype(np.uint64)
    last = len(codes) - 1
    for k in range(GRAM):
        keys = (keys ^ codes[np.minimum(at + k, last)].astype(np.uint64)) * MULTIPLIER
        keys ^= keys >> np.uint64(29)
    return keys


def suffix_order(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(order, common)``: suffixes in order and the common prefix of each with the one before.

    By doubling: ranks of the first 1, 2, 4, ... symbols, until all differ. The last
    symbol is unique.
    """
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    levels, step = [rank.astype(np.int32)], 1
    while True:
        after = np.zeros(n, np.int64)
        after[:-step] = rank[step:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        if rank[order[-1]] == n - 1:
            break
        levels.append(rank.astype(np.int32))
        step *= 2
    left, right = order[:-1].copy(), order[1:].copy()
    common = np.zeros(n - 1, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        fits = np.flatnonzero((left < n) & (right < n))
        same = fits[levels[k][left[fits]] == levels[k][right[fits]]]
        common[same] += 1 << k
        left[same] += 1 << k
        right[same] += 1 << k
    return order, np.concatenate([[0], common])


def seeds(order: np.ndarray, common: np.ndarray) -> list[tuple[int, int, int]]:
    """``(position, distance, common prefix)`` of positions that become neighbours in a class.

    Kept are those that agree for ``MIN_TURNS - 1`` times their distance.
    """
    least = min(max(MIN_WORDS - d, (MIN_TURNS - 1) * d) for d in range(1, MIN_WORDS))
    edges = np.flatnonzero(common >= least)
    edges = edges[np.argsort(-common[edges], kind="stable")]
    root = list(range(len(order)))
    held: dict[int, list[int]] = {}
    found = []
    turns = MIN_TURNS - 1

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    pairs = zip(order[edges - 1].tolist(), order[edges].tolist(), common[edges].tolist())
    for a, b, weight in pairs:
        a, b = top(a), top(b)
        large, small = held.get(a) or [a], held.get(b) or [b]
        if len(large) < len(small):
            a, b, large, small = b, a, small, large
        root[b] = a
        held.pop(b, None)
        held[a] = large
        widest = weight // turns
        places = [bisect_left(large, x) for x in small]
        for k, (x, place) in enumerate(zip(small, places)):
            if place and (not k or places[k - 1] != place) and x - large[place - 1] <= widest:
                found.append((large[place - 1], x - large[place - 1], weight))
            if place < len(large) and (k + 1 == len(small) or places[k + 1] != place) and large[place] - x <= widest:
                found.append((x, large[place] - x, weight))
        if len(small) > len(large) // 16:
            large += small
            large.sort()
        else:
            for x, place in zip(reversed(small), reversed(places)):
                large.insert(place, x)
    return found


def find_runs(codes: np.ndarray, group: np.ndarray) -> np.ndarray:
    """``start, length, period`` of every run, a row each, by start, then period.

    ``codes`` numbers the words of texts that lie one after the other; ``group`` is the
    text of each word.
    """
    starts, lengths = recurring_stretches(codes, group)
    if not len(starts):
        return np.empty((0, 3), np.int64)
    # A symbol of its own ends every stretch, so nothing agrees across.
    words = ragged_take(starts, lengths)
    places = np.arange(len(words)) + np.repeat(np.arange(len(starts)), lengths)
    symbols = np.empty(len(words) + len(starts), np.int64)
    origin = np.full(len(symbols), -1, np.int64)
    symbols[places], origin[places] = codes[words], words
    ends = np.cumsum(lengths + 1) - 1
    symbols[ends] = int(codes.max()) + 1 + np.arange(len(starts))
    seeded = np.array(seeds(*suffix_order(symbols)), np.int64).reshape(-1, 3)
    at, period, agree = seeded.T
    before = np.maximum(at - 1, 0)
    leftmost = (at == 0) | (symbols[before] != symbols[before + period])
    long = agree + period >= MIN_WORDS
    seeded = seeded[leftmost & long]
    runs = np.stack([origin[seeded[:, 0]], seeded[:, 1] + seeded[:, 2], seeded[:, 1]], 1)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _slice_runs(texts: pa.Array):
    """``(offsets of texts in words, words, runs)`` of some texts; runs hold word numbers over all."""
    offsets, words = split_words(texts)
    codes, _ = coded(words) if len(words) else (np.empty(0, np.int64), None)
    group = np.repeat(np.arange(len(texts)), np.diff(offsets))
    return offsets, words, find_runs(codes, group) if len(words) else np.empty((0, 3), np.int64)


def _collapsed(offsets: np.ndarray, words: pa.Array, runs: np.ndarray) -> pa.Array:
    """Each text's words joined by a space, without those after the first period of a run."""
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(change[:-1]) == 0
    cuts = np.concatenate([[0], np.cumsum(kept)])[offsets].astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(cuts), words.filter(pa.array(kept)))
    return pc.binary_join(lists, " ")


def periodic_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, runs, collapsed``: all runs of each text, and the text with one turn of each.

    ``runs`` is an array of (start, length, period) in words, by start, then period;
    ``collapsed`` holds the words that no run contains after its first period.
    """

    def run(batches):
        kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        for batch in batches:
            for part in slices(batch, text):
                offsets, words, runs = _slice_runs(texts_of(part, text))
                owner = np.searchsorted(offsets, runs[:, 0], "right") - 1
                cuts = np.searchsorted(owner, np.arange(part.num_rows + 1)).astype(np.int32)
                fields = [pa.array(runs[:, 0] - offsets[owner]), pa.array(runs[:, 1]), pa.array(runs[:, 2])]
                structs = pa.StructArray.from_arrays(fields, fields=list(kind))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.ListArray.from_arrays(pa.array(cuts), structs),
                        _collapsed(offsets, words, runs),
                    ],
                    ["doc_id", "runs", "collapsed"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    return docs.select("doc_id", text).mapInArrow(run, schema)
