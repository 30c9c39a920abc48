"""Files of token ids under an adaptive context-mixing range coder.

A file is a run of segments and an index of its documents. A segment ranks its ids by
frequency, stores the tables that its blocks start from and cuts its ids into blocks. Every
block is reset to those tables, has its own checksums and can be read alone; because blocks
are independent, all blocks of a segment are coded side by side in numpy, one id of each
per step.

Model of a block: the mixture ``gate * [id = guess] + (1 - gate) * class(id | before) * share(id)``.
Order 2 guesses the id that followed the same two ids last time in this block; its gate
adapts to how often guesses of its confidence were right, before and just now. Order 1 is
the distribution of the id's class after the id before, and order 0 the id's share of its
class, both counted over the segment; classes are ranges of ranks of about equal mass. An
id that is the guess has the sum of both parts. The mixture drives a carry-less range coder
of 64 bits, and all arithmetic is on integers.

Defined results: a null text counts as empty, so its document is the end id alone; null
``doc_id`` come first and stay null, and rows of one id are in the order of their texts, which
also parts them among tasks; repeated rows are written one after the other; a very long text may
span segments, not files; an empty table writes no file and gives no rows. Only ``doc_id``
and the text are read.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vidpulse.llm.common import file_system, new_folder, slices, texts_of
from vidpulse.llm.wordbpe import MetWords, encoder
from vidpulse.session import stage

END_ID = 1
MAGIC, SEGMENT, INDEX = b"CMID0002", b"SEGM", b"INDX"
#: Ids of a segment and of a block; short segments have shorter blocks.
SEGMENT_IDS = 6 << 20
MAX_BLOCK, MIN_BLOCK, LANES = 1024, 512, 3072
#: Ids from which a file is closed and the next one begun, and text bytes of a task.
FILE_IDS = 48 << 20
TASK_BYTES = 256 << 20
#: Text bytes that are encoded at once: distinct words are merged once in each slice.
SLICE_BYTES = 12 << 20
#: Each task compares one text of this many with the tokenizers library.
CHECK_EVERY = 4096

#: Classes of ids, ids that are contexts of their own, and ids of a segment for each of these.
CLASSES, CONTEXTS, CONTEXT_IDS = 32, 1024, 2048
#: Bits of a gate and of a class's probability; ids share a class in ``share_bits``.
GATE_BITS, CLASS_BITS = 10, 11
SLOTS = 512
#: Adaptive rate, and what a gate tends to when its guess is wrong or right.
RATE, WRONG, RIGHT = 4, 4, 1000
STEPS, WORDS_A_STEP = 64, 8
#: Words by which rows miss a power of two, so that lanes don't share lines of a cache.
ROW_GAP = 32
TOP, BOTTOM = np.uint64(1 << 48), np.uint64(1 << 40)
WORD = np.uint64(16)


def block_size(n: int) -> int:
    return min(MAX_BLOCK, max(MIN_BLOCK, n // LANES))


def scaled(counts: np.ndarray, bits: int) -> np.ndarray:
    """Each row of ``counts`` as whole numbers of at least 1 that add up to ``1 << bits``."""
    total = np.maximum(counts.sum(1, keepdims=True), 1)
    room = (1 << bits) - counts.shape[1]
    parts = counts * room // total + 1
    parts[np.arange(len(parts)), counts.argmax(1)] += (1 << bits) - parts.sum(1)
    return parts


class Tables:
    """What a segment's blocks start from: classes, shares of ids, classes after an id.

    ``kinds`` ids in ``classes`` ranges that begin at ``firsts``; ``shares`` of each id add up
    to ``1 << bits`` in a class; ``after`` has a row for each context, of ``1 << CLASS_BITS``.
    """

    def __init__(self, firsts: np.ndarray, shares: np.ndarray, after: np.ndarray, bits: int):
        kinds = len(shares)
        self.bits, self.total = bits, CLASS_BITS + bits
        self.class_of = np.repeat(np.arange(len(firsts)), np.diff(np.append(firsts, kinds)))
        self.shares, self.after, self.firsts = shares, after, firsts
        before = np.cumsum(shares) - shares
        self.before = before - (self.class_of << bits)
        self.contexts, self.classes = after.shape
        self.width = np.ascontiguousarray(after.reshape(-1))
        self.edge = (np.cumsum(after, 1) - after).reshape(-1) << bits

    @classmethod
    def of(cls, ranks: np.ndarray, counts: np.ndarray) -> Tables:
        """From a segment's ranks and how often each occurs, most frequent first."""
        n, kinds = len(ranks), len(counts)
        middle = np.cumsum(counts) - counts / 2
        bands = np.minimum(middle * CLASSES // n, CLASSES - 1).astype(np.int64)
        firsts = np.flatnonzero(np.diff(bands, prepend=-1))
        sizes = np.diff(np.append(firsts, kinds))
        bits = max(12, int(sizes.max() - 1).bit_length() + 1)
        class_of = np.repeat(np.arange(len(firsts)), sizes)
        shares = np.concatenate([scaled(counts[None, a : a + k], bits)[0] for a, k in zip(firsts, sizes)])
        own = min(CONTEXTS, kinds, n // CONTEXT_IDS)
        pairs = np.minimum(ranks[:-1], own).astype(np.int64) * len(firsts) + class_of[ranks[1:]]
        seen = np.bincount(pairs, minlength=(own + 1) * len(firsts)).reshape(own + 1, len(firsts))
        return cls(firsts, shares, scaled(seen, CLASS_BITS), bits)

    def pack(self) -> bytes:
        head = struct.pack("<IIII", len(self.shares), self.classes, self.contexts, self.bits)
        return head + b"".join(x.astype("<u4").tobytes() for x in (self.firsts, self.shares, self.after))

    @classmethod
    def unpack(cls, data: bytes) -> Tables:
        kinds, classes, contexts, bits = struct.unpack_from("<IIII", data)
        values = np.frombuffer(data, "<u4", offset=16).astype(np.int64)
        firsts, shares, after = np.split(values, [classes, classes + kinds])
        return cls(firsts, shares, after.reshape(contexts, classes), bits)

    def context(self, before: np.ndarray) -> np.ndarray:
        """The first place of the row of ``after`` that follows each id."""
        return np.minimum(before, self.contexts - 1) * self.classes

    def interval(self, ids: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(start, size)`` of ids of ``1 << total``, by orders 1 and 0."""
        at = context + self.class_of.take(ids)
        width = self.width.take(at)
        start = self.before.take(ids)
        start *= width
        start += self.edge.take(at)
        width *= self.shares.take(ids)
        return start, width

    def prepare(self) -> None:
        """Tables from a place to the class and the id there, for decoding."""
        self.class_at = np.repeat(np.tile(np.arange(self.classes, dtype=np.uint8), self.contexts), self.width)
        self.id_at = np.repeat(np.arange(len(self.shares), dtype=np.uint16), self.shares)

    def locate(self, place: np.ndarray, context: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, ...]:
        """The id whose interval holds ``place``, and that interval as ``(id, start, size)``.

        ``row`` is the context's number times ``1 << CLASS_BITS``.
        """
        kind = self.class_at.take(row + (place >> self.bits)).astype(np.int64)
        at = context + kind
        start, width = self.edge.take(at), self.width.take(at)
        # Both are below 1 << 53, so the quotient of doubles has the right whole part.
        share = ((place - start) / width).astype(np.int64)
        kind <<= self.bits
        kind += share
        ids = self.id_at.take(kind).astype(np.int64)
        start += self.before.take(ids) * width
        width *= self.shares.take(ids)
        return ids, start, width

    def find(self, place: np.ndarray, context: np.ndarray, row: np.ndarray) -> np.ndarray:
        return self.locate(place, context, row)[0]


def guess_slots(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    return (one * 40503 + two * 30011 >> 5) & (SLOTS - 1)


def _moves() -> tuple[np.ndarray, np.ndarray]:
    """By ``hit``, then gate, the gate after it; by ``hit``, then trust, the change of an entry."""
    gate = np.arange(1 << GATE_BITS)
    gates = [gate + ((target - gate) >> RATE) for target in (WRONG, RIGHT)]
    return np.concatenate(gates), np.array([0, -1, -1, -1, 1, 1, 1, 0], np.int32)


class Guess:
    """Order 2 of many blocks, one per lane: the guessed ids and the gates of their confidence."""

    def __init__(self, lanes: int):
        self.entries = np.zeros(lanes * SLOTS, np.int32)
        self.gates = np.full(lanes * 8, 1 << (GATE_BITS - 5), np.int64)
        self.lane = np.arange(lanes, dtype=np.int64)
        self.first, self.row = self.lane * SLOTS, self.lane * 8
        self.hit = np.zeros(lanes, np.int64)
        self.gate_after, self.entry_moves = _moves()

    def predict(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(guessed ids, gates)``."""
        self.slot = self.first + slots
        self.entry = self.entries.take(self.slot)
        self.trust = self.entry & 3
        self.at = self.row + self.hit
        self.at += self.trust
        self.gate = self.gates.take(self.at)
        return (self.entry >> 2).astype(np.int64), self.gate

    def learn(self, ids: np.ndarray, hit: np.ndarray) -> None:
        """Gates move; trust grows to 3 while right, falls when wrong, and then the guess changes."""
        self.gates[self.at] = self.gate_after.take(self.gate + (hit << GATE_BITS))
        self.hit = hit << 2
        state = self.hit + self.trust
        self.entry += self.entry_moves.take(state)
        np.copyto(self.entry, ids << 2, where=state == 0, casting="same_kind")
        self.entries[self.slot] = self.entry


def _due(low: np.ndarray, span: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(lanes whose first word is due, whether it is settled)``; else the range is too short to go on."""
    settled = (low ^ (low + span)) < TOP
    on = np.flatnonzero(settled | (span < BOTTOM))
    return on, settled.take(on)


def _cut(low: np.ndarray, span: np.ndarray, settled: np.ndarray) -> None:
    """Short ranges end where the first word would change."""
    if not settled.all():
        short = np.flatnonzero(~settled)
        span[short] = (~low[short] + np.uint64(1)) & (BOTTOM - np.uint64(1))


class RangeEncoder:
    def __init__(self, lanes: int):
        self.low = np.zeros(lanes, np.uint64)
        self.range = np.full(lanes, 2**64 - 1, np.uint64)
        self._lay(np.empty((lanes, 2 * STEPS * WORDS_A_STEP + ROW_GAP), np.uint16), np.zeros(lanes, np.int64))

    def _lay(self, words: np.ndarray, used: np.ndarray) -> None:
        self.rows, self.words = words, words.reshape(-1)
        self.first = np.arange(len(words)) * words.shape[1]
        self.end = self.first + used

    def make_room(self) -> None:
        """Due every ``STEPS`` steps, each gives at most ``WORDS_A_STEP`` words."""
        used, width = self.end - self.first, self.rows.shape[1]
        if used.max() + (STEPS + 1) * WORDS_A_STEP > width:
            wider = np.empty((len(used), 2 * width + ROW_GAP), np.uint16)
            wider[:, :width] = self.rows
            self._lay(wider, used)

    def put(self, start: np.ndarray, size: np.ndarray, bits: int) -> None:
        """Narrow each lane to ``start`` and ``size`` of ``1 << bits``."""
        self.range >>= np.uint64(bits)
        self.low += self.range * start.view(np.uint64)
        self.range *= size.view(np.uint64)
        low, span = self.low, self.range
        live, settled = _due(low, span)
        on = live
        while len(on):
            low, span = low.take(on), span.take(on)
            _cut(low, span, settled)
            at = self.end.take(live)
            self.words[at] = low >> np.uint64(48)
            self.end[live] = at + 1
            low <<= WORD
            span <<= WORD
            self.low[live], self.range[live] = low, span
            on, settled = _due(low, span)
            live = live.take(on)

    def payloads(self) -> list[bytes]:
        for _ in range(4):
            self.words[self.end] = self.low >> np.uint64(48)
            self.end += 1
            self.low <<= WORD
        return [row[:n].astype("<u2").tobytes() for row, n in zip(self.rows, (self.end - self.first).tolist())]


class RangeDecoder:
    def __init__(self, payloads: list[bytes]):
        sizes = [len(p) // 2 for p in payloads]
        words = np.zeros((len(payloads), (max(sizes) + 8 | ROW_GAP - 1) + 2), np.uint16)
        for row, p, n in zip(words, payloads, sizes):
            row[:n] = np.frombuffer(p, "<u2")
        self.low = np.zeros(len(payloads), np.uint64)
        self.range = np.full(len(payloads), 2**64 - 1, np.uint64)
        self.code = np.zeros(len(payloads), np.uint64)
        for k in range(4):
            self.code = (self.code << WORD) | words[:, k]
        self.words = words.reshape(-1)
        first = np.arange(len(payloads)) * words.shape[1]
        self.next, self.last = first + 4, first + words.shape[1] - 1

    def point(self, bits: int) -> np.ndarray:
        """Where in ``1 << bits`` each lane's code lies."""
        self.range >>= np.uint64(bits)
        return np.minimum((self.code - self.low) // self.range, np.uint64((1 << bits) - 1)).view(np.int64)

    def take(self, start: np.ndarray, size: np.ndarray) -> None:
        self.low += self.range * start.view(np.uint64)
        self.range *= size.view(np.uint64)
        low, span = self.low, self.range
        live, settled = _due(low, span)
        on = live
        while len(on):
            low, span = low.take(on), span.take(on)
            _cut(low, span, settled)
            at = self.next.take(live)
            code = self.code.take(live) << WORD
            code |= self.words.take(np.minimum(at, self.last.take(live)))
            self.next[live] = at + 1
            low <<= WORD
            span <<= WORD
            self.low[live], self.range[live], self.code[live] = low, span, code
            on, settled = _due(low, span)
            live = live.take(on)


def code_blocks(ranks: np.ndarray, tables: Tables) -> list[bytes]:
    """The payload of each row of ``ranks``; what depends on no state is worked out for many steps at once."""
    lanes, steps = ranks.shape
    guess, coder, bits = Guess(lanes), RangeEncoder(lanes), GATE_BITS + tables.total
    one = two = np.zeros(lanes, np.int64)
    for first in range(0, steps, STEPS):
        some = np.ascontiguousarray(ranks[:, first : first + STEPS].T).astype(np.int64)
        before = np.concatenate([two[None], one[None], some])
        starts, sizes = tables.interval(some, tables.context(before[1:-1]))
        slots = guess_slots(before[1:-1], before[:-2])
        for own, start, size, slot in zip(some, starts, sizes, slots):
            guessed, gate = guess.predict(slot)
            hit, rest = (guessed == own).astype(np.int64), (1 << GATE_BITS) - gate
            gate = gate << tables.total
            start *= rest
            start += (guessed < own) * gate
            size *= rest
            size += hit * gate
            coder.put(start, size, bits)
            guess.learn(own, hit)
        two, one = before[-2], before[-1]
        coder.make_room()
    return coder.payloads()


def decode_blocks(payloads: list[bytes], steps: int, tables: Tables) -> np.ndarray:
    lanes = len(payloads)
    tables.prepare()
    guess, coder, bits = Guess(lanes), RangeDecoder(payloads), GATE_BITS + tables.total
    out = np.empty((steps, lanes), np.int32)
    one = two = np.zeros(lanes, np.int64)
    for k in range(steps):
        context = tables.context(one)
        guessed, gate = guess.predict(guess_slots(one, two))
        if guessed.max() >= len(tables.shares):
            raise ValueError("a block decodes to an id that its segment does not have")
        point, rest = coder.point(bits), (1 << GATE_BITS) - gate
        gate = gate << tables.total
        start, size = tables.interval(guessed, context)
        start *= rest
        size *= rest
        size += gate
        after = point >= start + size
        hit = (point >= start) & ~after
        # Both are below 1 << 53, so the quotient of doubles has the right whole part.
        gate *= after
        place = ((point - gate) / rest).astype(np.int64)
        row = np.minimum(one, tables.contexts - 1) << CLASS_BITS
        np.minimum(place, (1 << tables.total) - 1, out=place)
        own, other, width = tables.locate(place, context, row)
        other *= rest
        other += gate
        width *= rest
        for mine, of_guess in ((own, guessed), (other, start), (width, size)):
            np.copyto(mine, of_guess, where=hit)
        start, size = other, width
        coder.take(start, size)
        guess.learn(own, hit.astype(np.int64))
        two, one = one, own
        out[k] = own
    return out.T


def write_segment(out, ids: np.ndarray) -> None:
    """Rank table, model tables, block table and blocks of one run of ids (below 65,537 distinct ones)."""
    counts = np.bincount(ids)
    kinds = np.flatnonzero(counts)
    kinds = kinds[np.argsort(-counts[kinds], kind="stable")]
    place = np.zeros(len(counts), np.int32)
    place[kinds] = np.arange(len(kinds))
    ranks = place[ids]
    size = min(block_size(len(ids)), len(ids))
    blocks = -(-len(ids) // size)
    padded = np.zeros(blocks * size, np.int32)
    padded[: len(ids)] = ranks
    tables = Tables.of(ranks, counts[kinds])
    payloads = code_blocks(padded.reshape(blocks, size), tables)
    raw = ids.astype("<u4")
    table = zlib.compress(kinds.astype("<u4").tobytes() + tables.pack(), 6)
    head = struct.pack("<QIIII", len(ids), size, blocks, len(kinds), len(table))
    rows = b"".join(
        struct.pack("<III", len(p), zlib.crc32(p), zlib.crc32(raw[k * size : (k + 1) * size])) for k, p in enumerate(payloads)
    )
    out.write(SEGMENT + head + struct.pack("<I", zlib.crc32(head + table + rows)) + table + rows)
    for p in payloads:
        out.write(p)


def _exactly(source, n: int) -> bytes:
    data = source.read(n)
    if len(data) != n:
        raise ValueError("the file ends early")
    return data


def read_segment(source) -> np.ndarray:
    """The ids of the segment that starts here; raises on a wrong checksum."""
    head = _exactly(source, 24)
    n, size, blocks, kinds, packed = struct.unpack("<QIIII", head)
    (check,) = struct.unpack("<I", _exactly(source, 4))
    table, rows = _exactly(source, packed), _exactly(source, 12 * blocks)
    if zlib.crc32(head + table + rows) != check:
        raise ValueError("a segment's head is damaged")
    payloads, wanted = [], []
    for length, of_payload, of_ids in struct.iter_unpack("<III", rows):
        payloads.append(_exactly(source, length))
        wanted.append(of_ids)
        if zlib.crc32(payloads[-1]) != of_payload:
            raise ValueError("a block is damaged")
    table = zlib.decompress(table)
    ranks = decode_blocks(payloads, size, Tables.unpack(table[4 * kinds :])).reshape(-1)[:n]
    ids = np.frombuffer(table, "<u4", kinds)[ranks]
    for k, check in enumerate(wanted):
        if zlib.crc32(ids[k * size : (k + 1) * size]) != check:
            raise ValueError("a block decodes to other ids")
    return ids


def write_index(out, doc_ids: list, counts: list[int]) -> None:
    known = np.array([x is not None for x in doc_ids], np.uint8)
    values = np.array([x if x is not None else 0 for x in doc_ids], "<i8")
    data = zlib.compress(known.tobytes() + values.tobytes() + np.array(counts, "<i8").tobytes(), 1)
    out.write(INDEX + struct.pack("<QQI", len(doc_ids), len(data), zlib.crc32(data)) + data)


def read_index(source) -> tuple[list, np.ndarray]:
    n, size, check = struct.unpack("<QQI", _exactly(source, 20))
    data = _exactly(source, size)
    if zlib.crc32(data) != check:
        raise ValueError("the index is damaged")
    data = zlib.decompress(data)
    known, values = np.frombuffer(data, np.uint8, n), np.frombuffer(data, "<i8", n, n)
    return [v if k else None for k, v in zip(known.tolist(), values.tolist())], np.frombuffer(data, "<i8", n, 9 * n)


class FileWriter:
    """One file of ids: documents are added, segments go out as they fill."""

    def __init__(self, name: str):
        fs, local = file_system(name)
        self.name, self.out = name, fs.open_output_stream(local)
        self.out.write(MAGIC)
        self.doc_ids, self.counts, self.held, self.waiting, self.total = [], [], [], 0, 0

    def add(self, doc_ids: list, counts: np.ndarray, ids: np.ndarray) -> None:
        self.doc_ids += doc_ids
        self.counts += counts.tolist()
        self.held.append(ids)
        self.waiting += len(ids)
        self.total += len(ids)
        while self.waiting >= SEGMENT_IDS:
            whole = np.concatenate(self.held)
            write_segment(self.out, whole[:SEGMENT_IDS])
            self.held, self.waiting = [whole[SEGMENT_IDS:]], self.waiting - SEGMENT_IDS

    def close(self) -> dict:
        if self.waiting:
            write_segment(self.out, np.concatenate(self.held))
        write_index(self.out, self.doc_ids, self.counts)
        length = self.out.tell()
        self.out.close()
        return {"path": self.name, "documents": len(self.doc_ids), "ids": self.total, "bytes": length}


def write_files(
    docs: DataFrame, path: str, end_id: int = END_ID, text: str = "text", file_ids: int = FILE_IDS
) -> DataFrame:
    """Write all documents in ascending ``doc_id``, files of at most ``file_ids`` ids and one slice more.

    Returns the files: ``path, part, number, documents, ids, bytes``, in the order of
    part and number. The number of tasks follows from the texts' bytes. A task that is run
    again writes other files, and only files of this table count.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "ids")

    def run(batches):
        own, part, number, seen, out = encoder(path), TaskContext.get().partitionId(), 0, 0, None
        met = MetWords(own.merge)

        def closed():
            row = {**out.close(), "part": part, "number": number}
            return pa.RecordBatch.from_pylist([row]).select(["path", "part", "number", "documents", "ids", "bytes"])

        for batch in batches:
            for rows in slices(batch, text, SLICE_BYTES):
                out = out or FileWriter(f"{folder}/part-{part:06d}-{number:04d}-{uuid.uuid4().hex}.ids")
                texts = texts_of(rows, text)
                ids, n = own.encode(texts, met.ids)
                if seen // CHECK_EVERY != (seen + len(texts)) // CHECK_EVERY or not seen:
                    own.check(texts[0].as_py(), ids[: n[0]])
                seen += len(texts)
                kind = np.uint16 if own.size <= 1 << 16 else np.uint32
                out.add(rows.column("doc_id").to_pylist(), n + 1, np.insert(ids, np.cumsum(n), end_id).astype(kind))
                if out.total >= file_ids:
                    yield closed()
                    out, number = None, number + 1
        if out:
            yield closed()

    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // TASK_BYTES))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text)
    # The beginning of the text parts rows of one id, such as null, in the order of their texts.
    ordered = keyed.repartitionByRange(tasks, "doc_id", F.substring(text, 1, 64)).sortWithinPartitions("doc_id", text)
    schema = "path string, part long, number long, documents long, ids long, bytes long"
    return stage(ordered.mapInArrow(run, schema), "files")


def segments_of(path: str):
    """``(runs of ids)`` of a file's segments, then its index ``(doc_ids, counts)``."""
    fs, local = file_system(path)
    with fs.open_input_stream(local) as source:
        if source.read(8) != MAGIC:
            raise ValueError("not a file of ids")
        while (kind := _exactly(source, 4)) == SEGMENT:
            yield read_segment(source)
        if kind != INDEX:
            raise ValueError("a segment is damaged")
        yield read_index(source)


def index_of(path: str) -> tuple[list, np.ndarray]:
    """The index alone, by passing over the segments."""
    fs, local = file_system(path)
    with fs.open_input_file(local) as source:
        source.seek(8)
        while _exactly(source, 4) == SEGMENT:
            _, _, blocks, _, packed = struct.unpack("<QIIII", _exactly(source, 24))
            _exactly(source, 4 + packed)
            lengths = [x for x, _, _ in struct.iter_unpack("<III", _exactly(source, 12 * blocks))]
            source.seek(source.tell() + sum(lengths))
        return read_index(source)


def read_documents(path: str):
    """``(doc_id, ids)`` of each document of a file, a segment in memory at a time."""
    doc_ids, counts = index_of(path)
    runs = segments_of(path)
    held = np.empty(0, np.uint32)
    for doc_id, n in zip(doc_ids, counts.tolist()):
        if len(held) < n:
            parts, size = [held], len(held)
            while size < n:
                run = next(runs)
                if not isinstance(run, np.ndarray):
                    raise ValueError("the index counts more ids than the file has")
                parts.append(run)
                size += len(run)
            held = np.concatenate(parts)
        yield doc_id, held[:n]
        held = held[n:]
    if len(held) or isinstance(next(runs), np.ndarray):
        raise ValueError("the file has more ids than the index counts")


def read_files(spark: SparkSession, files: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` from the files; ``start`` counts the ids of all documents before."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                found, at = [], row["base"]
                for doc_id, ids in read_documents(row["path"]):
                    found.append((doc_id, at, len(ids), zlib.crc32(np.ascontiguousarray(ids, "<u4"))))
                    at += len(ids)
                columns = [pa.array(x, pa.int64()) for x in zip(*found)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    # One row per file, which bounds the window; each file is then one task's.
    before = F.sum("ids").over(Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1))
    based = files.select("path", "part", "number", F.coalesce(before, F.lit(0)).alias("base"))
    dealt = based.repartitionByRange(max(1, files.count()), "part", "number")
    return dealt.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
