"""Exact ids of a word-level BPE vocabulary, for many texts at a time.

The vocabulary file is one of the ``tokenizers`` library: NFC, white space and
lower-casing, a split into words, then merges within each word that end in a suffix.
Words never depend on their neighbours, so the distinct words of a slice of texts are
encoded once, in numpy, all words one merge further per step. The library itself does
what is rare: characters beyond U+024F or whose lower-case form is none of the same
width below that, very long words, and a check of one text per task against its own result.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from vidpulse.llm.common import coded, ragged_take, raw_bytes, split_words, string_array

FAST_END = 0x250
LONGEST = 250
NONE = np.int32(2**31 - 1)


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(rest)) for b in range(256)]


class PairTable:
    """Rank of a pair of symbols, by open addressing in numpy arrays."""

    BITS = 18

    def __init__(self, left: np.ndarray, right: np.ndarray):
        keys = self.key(left, right)
        size = 1 << self.BITS
        self.keys = np.full(size, -1, np.int64)
        self.ranks = np.full(size, NONE, np.int32)
        at = self.slot(keys)
        for rank, (key, i) in enumerate(zip(keys.tolist(), at.tolist())):
            while self.keys[i] >= 0:
                i = (i + 1) & (size - 1)
            self.keys[i], self.ranks[i] = key, rank

    @staticmethod
    def key(left, right):
        return (left.astype(np.int64) << 20) | right

    def slot(self, keys):
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.BITS)).astype(np.int64)

    def find(self, left, right):
        keys = self.key(left, right)
        at = self.slot(keys)
        held = self.keys[at]
        found = np.where(held == keys, self.ranks[at], NONE)
        open_ = np.flatnonzero((held != keys) & (held >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.BITS) - 1)
            held = self.keys[at[open_]]
            hit = held == keys[open_]
            found[open_[hit]] = self.ranks[at[open_[hit]]]
            open_ = open_[~hit & (held >= 0)]
        return found


class WordEncoder:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        self.specials = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.size = self.tokenizer.get_vocab_size()
        alphabet = byte_alphabet()
        self.inner = np.array([vocab[c] for c in alphabet], np.int32)
        self.final = np.array([vocab[c + suffix] for c in alphabet], np.int32)
        self.byte_of = {c: b for b, c in enumerate(alphabet)}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int32)
        right = np.array([vocab[b] for _, b in pairs], np.int32)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.pairs = PairTable(left, right)
        self._probe_classes()
        names = "|".join(re.escape(x) for x in self.specials)
        self.special = re.compile(f"({names})") if names else None
        alone = "".join(map(re.escape, self.lonely))
        self.exotic = re.compile(f"[^\\x00-{chr(FAST_END - 1)}]|[{alone}]")

    def _probe_classes(self) -> None:
        """Ask the library what each character below ``FAST_END`` is, and write its split for ``re``."""
        normal, split = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        letters, numbers, spaces = [], [], []
        for c in map(chr, range(FAST_END)):
            n = normal.normalize_str(c)
            if not split.pre_tokenize_str(n):
                spaces.append(c)
            elif len(split.pre_tokenize_str("a" + c + "b")) == 1:
                letters.append(c)
            elif len(split.pre_tokenize_str(c + c)) == 2:
                numbers.append(c)
        a, b, s = ("".join(map(re.escape, x)) for x in (letters, numbers, spaces))
        self.split = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{a}]+|[{b}]|[^{s}{a}{b}]+").findall
        self.kind = np.full(FAST_END, 3, np.uint8)
        for kind, chars in ((0, spaces), (1, letters), (2, numbers)):
            self.kind[list(map(ord, chars))] = kind
        # Lower-case forms are looked up by place in ``kind`` and by width in bytes.
        self.lonely = [c for c in map(chr, range(FAST_END)) if not self._fits(c, normal)]
        odd = {*self.lonely, *(c for c in spaces if c not in " \t\n\v\f\r")}
        odd = "".join(f"\\x{{{ord(c):x}}}" for c in sorted(odd))
        self.slow = f"[^\\x00-\\x{{{FAST_END - 1:x}}}]|['{odd}]|<\\|"

    @staticmethod
    def _fits(c: str, normal) -> bool:
        """Whether lower-casing keeps ``c`` one character of its width below ``FAST_END``, as the library has it."""
        low = c.lower()
        if len(low) != 1 or ord(low) >= FAST_END or len(low.encode()) != len(c.encode()):
            return False
        return c.isspace() or ord(c) < 32 or normal.normalize_str(f"a{c}a") == f"a{low}a"

    def words(self, text: str) -> list[str]:
        """The words of a text as the library would split them; special tokens stand alone."""
        if self.special and "<|" in text and self.special.search(text):
            found: list[str] = []
            for part in self.special.split(text):
                found += [part] if part in self.specials else self.words(part)
            return found
        if text.isascii() or not self.exotic.search(text):
            return self.split(text.lower())
        found = self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(text))
        return [bytes(map(self.byte_of.__getitem__, word)).decode() for word, _ in found]

    def split_runs(self, runs: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """Words of each run without ASCII white space: ``(words per run, all words)``.

        Where every character is known and stands for itself, words end where the class
        of the character changes and after each number; the rest goes through ``words``.
        """
        slow = pc.match_substring_regex(runs, self.slow).to_numpy(zero_copy_only=False)
        counts = np.zeros(len(runs), np.int64)
        plain = runs.filter(pa.array(~slow)) if slow.any() else runs
        bounds, data = raw_bytes(plain)
        text = data.tobytes().decode().lower()
        chars = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        widths = (chars > 0x7F).astype(np.int64) + 1
        begins = np.concatenate([[0], np.cumsum(widths)])
        run_starts = np.searchsorted(begins, bounds[:-1])
        kind = self.kind[chars]
        first = np.ones(len(chars), bool)
        first[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        first[run_starts] = True
        starts = np.flatnonzero(first)
        counts[~slow] = np.diff(np.searchsorted(starts, np.append(run_starts, len(chars))))
        words = string_array(np.diff(np.append(begins[starts], begins[-1])), np.frombuffer(text.encode(), np.uint8))
        if not slow.any():
            return counts, words
        rest = [self.words(run) for run in runs.filter(pa.array(slow)).to_pylist()]
        counts[slow] = [len(x) for x in rest]
        both = pa.concat_arrays([words, pa.array([w for x in rest for w in x], pa.string())])
        order = np.empty(len(runs), np.int64)
        order[~slow], order[slow] = 0, len(words)
        for part in (~slow, slow):
            order[part] += np.cumsum(counts[part]) - counts[part]
        return counts, both.take(pa.array(ragged_take(order, counts)))

    def merge(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(ids, start, length)``: the ids of each distinct word are one run of ``ids``."""
        bounds, data = raw_bytes(words)
        lengths = np.diff(bounds)
        alone = lengths > LONGEST
        if self.specials:
            alone |= pc.is_in(words, pa.array(list(self.specials))).to_numpy(zero_copy_only=False)
        counts, order, pools = np.zeros(len(words), np.int64), [], []
        for i in np.flatnonzero(alone).tolist():
            ids = self._alone(words[i].as_py())
            counts[i] = len(ids)
            order.append(np.array([i]))
            pools.append(np.array(ids, np.int32))
        rest = np.flatnonzero(~alone)
        rest = rest[np.argsort(lengths[rest], kind="stable")]
        ordered, at = lengths[rest], 0
        while at < len(rest):
            width = max(6, int(ordered[at]) * 5 // 4)
            to = min(int(np.searchsorted(ordered, width, "right")), at + 32768)
            rows = rest[at:to]
            flat = data[ragged_take(bounds[rows], lengths[rows])]
            ids, counts[rows] = self._merge_rows(flat, lengths[rows])
            order.append(rows)
            pools.append(ids)
            at = to
        if not order:
            return np.empty(0, np.int32), np.empty(0, np.int64), counts
        order = np.concatenate(order)
        starts = np.empty(len(words), np.int64)
        starts[order] = np.cumsum(counts[order]) - counts[order]
        return np.concatenate(pools), starts, counts

    def _alone(self, word: str) -> list[int]:
        if word in self.specials:
            return [self.specials[word]]
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def _merge_rows(self, flat: np.ndarray, lengths: np.ndarray):
        """Merge words of similar length together; a column holds a word, ``key`` ranks its pairs.

        Symbols keep their place: a pair's right half is marked as gone, and ``after``
        and ``before`` skip it. The smallest key is the word's next merge, leftmost first.
        """
        n, width = len(lengths), int(lengths.max())
        place = np.arange(width, dtype=np.int32)[:, None]
        rows = np.full((n, width), -1, np.int32)
        rows[place.T < lengths[:, None]] = self.inner[flat]
        rows[np.arange(n), lengths - 1] = self.final[flat[np.cumsum(lengths) - 1]]
        symbols = np.ascontiguousarray(rows.T).reshape(-1)
        key = np.full(width * n, NONE, np.int32)
        pair = np.flatnonzero((place < lengths - 1).reshape(-1))
        key[pair] = self._key(symbols[pair], symbols[pair + n], pair // n)
        after = np.repeat(place + 1, n, 1).astype(np.int16).reshape(-1)
        before = np.repeat(place - 1, n, 1).astype(np.int16).reshape(-1)
        grid = key.reshape(width, n)
        while True:
            best = grid.min(0)
            live = np.flatnonzero(best < NONE)
            if not len(live):
                break
            rank, at = best[live] >> 8, (best[live] & 255).astype(np.int64)
            left = at * n + live
            gone = after[left].astype(np.int64) * n + live
            joined = self.merged[rank]
            symbols[left], symbols[gone] = joined, -1
            key[left] = key[gone] = NONE
            follows = after[gone].astype(np.int64)
            after[left] = follows
            on = np.flatnonzero(follows < lengths[live])
            right = follows[on] * n + live[on]
            before[right] = at[on]
            key[left[on]] = self._key(joined[on], symbols[right], at[on])
            precedes = before[left].astype(np.int64)
            on = np.flatnonzero(precedes >= 0)
            back = precedes[on] * n + live[on]
            key[back] = self._key(symbols[back], joined[on], precedes[on])
        ordered = symbols.reshape(width, n).T
        kept = ordered >= 0
        return ordered[kept], kept.sum(1)

    def _key(self, left, right, place):
        rank = self.pairs.find(left, right)
        return np.where(rank < NONE, (rank << 8) | place.astype(np.int32), NONE)

    def encode(self, texts: pa.Array, lookup=None) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts``, one after the other, and the number of ids of each.

        Texts fall into runs without ASCII white space, which merges and characters'
        composition never cross; each distinct run is split into words once.
        ``lookup(distinct words)`` may replace ``merge`` as the source of words' ids.
        """
        offsets, runs = split_words(texts)
        codes, runs = coded(runs)
        per_run, words = self.split_runs(runs)
        of_word, distinct = coded(words)
        pool, starts, lengths = (lookup or self.merge)(distinct)
        pool = pool[ragged_take(starts[of_word], lengths[of_word])]
        ends = np.concatenate([[0], np.cumsum(lengths[of_word])])
        last = np.cumsum(per_run)
        starts, lengths = ends[last - per_run], ends[last] - ends[last - per_run]
        sizes = lengths[codes]
        ids = pool[ragged_take(starts[codes], sizes)]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return ids, np.diff(ends[offsets])

    def check(self, text: str, ids) -> None:
        """Raise unless the library gives ``text`` the same ids."""
        own = self.tokenizer.encode(text, add_special_tokens=False).ids
        if own != [int(i) for i in ids]:
            raise ValueError("ids differ from the tokenizers library's")


class MetWords:
    """Ids of the distinct words that a task has met, at most ``most`` of them; others are merged each time."""

    def __init__(self, merge, most: int = 65_536):
        self.merge, self.most = merge, most
        self.words = pa.array([], pa.string())
        self.pool, self.starts, self.lengths = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(ids, start, length)`` as of ``merge``."""
        place = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy(zero_copy_only=False)
        new = place < 0
        rest = words.filter(pa.array(new))
        merged, at, n = self.merge(rest)
        starts, lengths = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        starts[~new], lengths[~new] = self.starts[place[~new]], self.lengths[place[~new]]
        at = at + len(self.pool)
        starts[new], lengths[new] = at, n
        pool = np.concatenate([self.pool, merged])
        if len(self.words) + len(rest) <= self.most:
            self.words = pa.concat_arrays([self.words, rest])
            self.pool = pool
            self.starts, self.lengths = np.concatenate([self.starts, at]), np.concatenate([self.lengths, n])
        return pool, starts, lengths


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder for each Python worker."""
    return WordEncoder(path)
