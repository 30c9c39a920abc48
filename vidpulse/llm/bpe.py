"""BPE encoding and decoding through a minimal acyclic transducer of frequent words.

Words that occur often in the corpus are compiled into an automaton in which equal
suffixes are shared. Every arc carries a number; the numbers along a word's path add
up to the word's rank, under which its ids are stored. The automaton is one file of
32-bit integers that Spark copies to the executors and tasks map into memory. Words it
does not hold are merged exactly (``wordbpe``), so any lexicon gives the same ids.

Defined results: a null text counts as empty; an empty text has no ids and decodes to
the empty text; rows are kept one by one, repeated and null ``doc_id`` included; an
empty table gives an empty result. Only ``doc_id`` and the text column are read, so
other columns may have any name.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vidpulse.llm.common import coded, put_file, ragged_take, raw_bytes, slices, split_words, texts_of
from vidpulse.llm.wordbpe import encoder
from vidpulse.session import stage

#: Words the lexicon holds at most, and the count from which a word is frequent.
LEXICON_WORDS = 32_768
MIN_COUNT = 8
#: Each task compares one text of this many with the tokenizers library.
CHECK_EVERY = 4096

DEAD, ROOT = 0, 1


def compile_lexicon(words: list[bytes], ids: list[list[int]]) -> np.ndarray:
    """The transducer of distinct ``words`` with the ids of each, as one array of int32."""
    order = sorted(range(len(words)), key=words.__getitem__)
    arcs: list[dict[int, int]] = [{}, {}]
    accepts = [False, False]
    register: dict[tuple, int] = {}
    path: list[tuple[int, int]] = []  # (state, byte of its last arc) of the word before
    before = b""

    def close(keep: int) -> None:
        while len(path) > keep:
            state, byte = path.pop()
            child = arcs[state][byte]
            same = (accepts[child], tuple(arcs[child].items()))
            arcs[state][byte] = register.setdefault(same, child)

    for k in order:
        word = words[k]
        common = 0
        while common < min(len(word), len(before)) and word[common] == before[common]:
            common += 1
        close(common)
        state = arcs[path[-1][0]][path[-1][1]] if path else ROOT
        for byte in word[common:]:
            arcs.append({})
            accepts.append(False)
            arcs[state][byte] = len(arcs) - 1
            path.append((state, byte))
            state = len(arcs) - 1
        accepts[state] = True
        before = word
    close(0)

    number, todo = {ROOT: ROOT}, [ROOT]
    for state in todo:
        for child in arcs[state].values():
            if child not in number:
                number[child] = len(number) + 1
                todo.append(child)
    below: dict[int, int] = {}

    def count(top: int) -> None:
        stack = [top]
        while stack:
            state = stack[-1]
            open_ = [c for c in arcs[state].values() if c not in below]
            if open_:
                stack += open_
            else:
                below[stack.pop()] = accepts[state] + sum(below[c] for c in arcs[state].values())

    count(ROOT)
    used = sorted({b for s in todo for b in arcs[s]})
    classes = np.zeros(256, np.int32)
    classes[used] = np.arange(1, len(used) + 1)
    states, width = len(number) + 1, len(used) + 1
    target = np.zeros((states, width), np.int32)
    output = np.zeros((states, width), np.int32)
    final = np.zeros(states, np.int32)
    for state in todo:
        at, passed = number[state], int(accepts[state])
        final[at] = passed
        for byte in sorted(arcs[state]):
            child = arcs[state][byte]
            target[at, classes[byte]] = number[child]
            output[at, classes[byte]] = passed
            passed += below[child]
    sizes = np.array([len(ids[k]) for k in order], np.int32)
    starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    pool = np.array([i for k in order for i in ids[k]], np.int32)
    head = np.array([states, width, len(order), len(pool)], np.int32)
    return np.concatenate([head, classes, final, target.ravel(), output.ravel(), starts, pool])


class Lexicon:
    """A compiled lexicon, mapped from its file."""

    def __init__(self, source, merge):
        whole = np.memmap(source, np.int32, "r") if isinstance(source, str) else source
        states, width, words, pool = whole[:4].tolist()
        cuts = np.cumsum([4, 256, states, states * width, states * width, words + 1, pool])
        parts = [whole[a:b] for a, b in zip(cuts, cuts[1:])]
        self.classes, self.final, self.target, self.output, self.starts, self.pool = parts
        self.width, self.merge, self.states, self.size = width, merge, states, words

    def ranks(self, words: pa.Array) -> np.ndarray:
        """The rank of each word, -1 for words the lexicon does not hold."""
        bounds, data = raw_bytes(words)
        lengths = np.diff(bounds)
        order = np.argsort(-lengths, kind="stable")
        live, state = order, np.full(len(order), ROOT, np.int64)
        rank, found = np.zeros(len(order), np.int64), np.full(len(order), -1, np.int64)
        step, left = 0, lengths[order]
        while len(live):
            ended = int(np.searchsorted(-left, -step, "left"))
            at = state[ended:]
            found[live[ended:]] = np.where(self.final[at] > 0, rank[ended:], -1)
            live, left, state, rank = live[:ended], left[:ended], state[:ended], rank[:ended]
            arc = state * self.width + self.classes[data[bounds[live] + step]]
            rank = rank + self.output[arc]
            state = self.target[arc].astype(np.int64)
            on = state != DEAD
            live, left, state, rank = live[on], left[on], state[on], rank[on]
            step += 1
        return found

    def ids(self, words: pa.Array):
        """``(ids, start, length)`` of each word: from the lexicon, or merged."""
        rank = self.ranks(words)
        held = rank >= 0
        starts, lengths = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        starts[held] = self.starts[rank[held]]
        lengths[held] = self.starts[rank[held] + 1] - starts[held]
        known = self.pool[ragged_take(starts[held], lengths[held])]
        starts[held] = np.cumsum(lengths[held]) - lengths[held]
        rest, at, n = self.merge(words.filter(pa.array(~held)))
        starts[~held], lengths[~held] = at + len(known), n
        return np.concatenate([known, rest]), starts, lengths


@lru_cache(maxsize=2)
def mapped(name: str, path: str) -> Lexicon:
    return Lexicon(SparkFiles.get(name), encoder(path).merge)


def count_words(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``word, n``: how often each word occurs in all texts."""

    def run(batches):
        own = encoder(path)
        for batch in batches:
            for part in slices(batch, text):
                codes, runs = coded(split_words(texts_of(part, text))[1])
                per_run, words = own.split_runs(runs)
                weights = np.repeat(np.bincount(codes, minlength=len(runs)), per_run)
                codes, words = coded(words)
                n = np.bincount(codes, weights, len(words)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([words, pa.array(n)], ["word", "n"])

    counted = docs.select(text).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(docs: DataFrame, path: str, most: int, min_count: int, text: str = "text") -> list[str]:
    """The words of at least ``min_count`` and of the smallest count that leaves at most ``most``."""
    frequent = stage(count_words(docs, path, text).filter(F.col("n") >= min_count), "words")
    least, total = None, 0
    for n, words in sorted(frequent.groupBy("n").count().collect(), reverse=True):
        total += words
        if total > most:
            break
        least = n
    if least is None:
        return []
    return sorted(r[0] for r in frequent.filter(F.col("n") >= least).select("word").collect())


def build_lexicon(
    docs: DataFrame,
    path: str,
    most: int = LEXICON_WORDS,
    min_count: int = MIN_COUNT,
    text: str = "text",
) -> str:
    """Count, compile, write and share the lexicon; returns its name for ``SparkFiles``.

    At most ``most`` words pass through the driver.
    """
    words = frequent_words(docs, path, most, min_count, text)
    pool, starts, lengths = encoder(path).merge(pa.array(words, pa.string()))
    ids = [pool[s : s + n].tolist() for s, n in zip(starts.tolist(), lengths.tolist())]
    return put_file(docs.sparkSession, compile_lexicon([w.encode() for w in words], ids).tobytes(), "lexicon")


def encode_slices(batches, name: str, path: str, text: str):
    """``(rows, ids of all their texts, ids per text)`` of each slice."""
    own, lexicon, seen = encoder(path), mapped(name, path), 0
    for batch in batches:
        for part in slices(batch, text):
            texts = texts_of(part, text)
            ids, counts = own.encode(texts, lexicon.ids)
            if seen // CHECK_EVERY != (seen + len(texts)) // CHECK_EVERY or not seen:
                own.check(texts[0].as_py(), ids[: counts[0]])
            seen += len(texts)
            yield part, ids, counts


def encode(docs: DataFrame, path: str, lexicon: str | None = None, text: str = "text") -> DataFrame:
    """``doc_id, ids array<int>`` of every row."""
    name = lexicon or build_lexicon(docs, path, text=text)

    def run(batches):
        for part, ids, counts in encode_slices(batches, name, path, text):
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], ["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text).mapInArrow(run, f"doc_id {kind}, ids array<int>")


@lru_cache(maxsize=2)
def token_names(path: str) -> list[str]:
    own = encoder(path)
    return [own.tokenizer.id_to_token(i) or "" for i in range(own.size)]


def decode_ids(ids: list[int], names: list[str]) -> str:
    """The tokens of ``ids`` joined by a space, as a vocabulary without a decoder defines it."""
    return " ".join(map(names.__getitem__, ids))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; null ids decode to null, and unknown ids fail."""

    def run(batches):
        names = token_names(path)
        for batch in batches:
            texts = [None if x is None else decode_ids(x, names) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def round_trip(docs: DataFrame, path: str, lexicon: str | None = None, text: str = "text") -> DataFrame:
    """Encode every text, decode the ids, and return a digest of both per row.

    The same as ``encode`` and ``decode`` with the ids staying in the task.
    """
    name = lexicon or build_lexicon(docs, path, text=text)

    def run(batches):
        names, decimals = token_names(path), [str(i) for i in range(encoder(path).size)]
        for part, ids, counts in encode_slices(batches, name, path, text):
            flat, at, of_ids, of_text = ids.tolist(), 0, [], []
            for n in counts.tolist():
                own = flat[at : at + n]
                at += n
                of_ids.append(hashlib.sha256(decode_ids(own, decimals).encode()).hexdigest())
                of_text.append(hashlib.sha256(decode_ids(own, names).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(counts), pa.array(of_ids), pa.array(of_text)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", text).mapInArrow(run, schema)
