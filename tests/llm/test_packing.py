import zlib

import numpy as np

from vidpulse.llm import packing
from vidpulse.llm.queries import QUERIES


def check(pieces, ids_of, window):
    """Every id in one piece, pieces gapless in their sequence, only the last one short."""
    sequences, seen = {}, {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
        seen.setdefault((p.doc_id, p.doc_tokens), []).append((p.start, p.length))
        assert any(
            p.doc_tokens == len(ids) and zlib.crc32(ids[p.start : p.start + p.length].tobytes()) == p.ids_crc32
            for ids in ids_of[p.doc_id]
        )
    for k, parts in sequences.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at == window or (k == max(sequences) and at < window)
    assert sorted(sequences) == list(range(len(sequences)))
    total = sum(len(ids) for all_ in ids_of.values() for ids in all_)
    assert sum(p.length for p in pieces) == total


def ids_by_doc(docs, library):
    found = {}
    for r in docs.collect():
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, packing.END_ID]
        found.setdefault(r.doc_id, []).append(np.array(ids, "<u4"))
    return found


def test_odd_rows(odd_docs, path, library):
    pieces = packing.piece_table(packing.pack(odd_docs, path, window=64)).collect()
    check(pieces, ids_by_doc(odd_docs, library), 64)


def test_query(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    check(QUERIES["op6_packing"](spark, sf_dir).collect(), ids_by_doc(docs, library), packing.WINDOW)


def test_sequences_hold_their_pieces_and_pad_the_last(odd_docs, path):
    pieces = packing.pack(odd_docs, path, window=64)
    rows = {r.sequence_id: r for r in packing.sequences(pieces, 64).collect()}
    last = max(rows)
    for k, r in rows.items():
        parts = sorted((p.offset, bytes(p.piece_ids)) for p in pieces.filter(f"sequence_id = {k}").collect()) if k in (0, last) else None
        if parts:
            raw = b"".join(x for _, x in parts)
            assert bytes(r.ids)[: len(raw)] == raw and r.length * 4 == len(raw)
        short = k == last and r.length & (r.length - 1) == 0
        assert len(r.ids) == 4 * (r.length if short else 64)


def test_empty_table(no_docs, path):
    assert packing.pack(no_docs, path).count() == 0
