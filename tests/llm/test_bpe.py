"""Ids against the tokenizers library, the transducer, and the round trip."""

import hashlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from vidpulse.llm import bpe
from vidpulse.llm.common import tokenizer_path
from vidpulse.llm.queries import QUERIES
from vidpulse.llm.wordbpe import FAST_END, encoder


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="abcdest'lrvm .,\n\t09éÉİßΣσ中́ !<|>\x1c\xa0", max_size=40))
def test_any_text_has_the_library_s_ids(text):
    own = encoder(tokenizer_path())
    ids, counts = own.encode(pa.array([text, text + " x"]))
    assert ids[: counts[0]].tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids


def test_every_character_of_the_fast_path(path, library):
    texts = [t for c in map(chr, range(FAST_END + 64)) for t in (c, c + c, f"ab{c}cd", f"Ab{c} {c}X", f"a1 {c}'s")]
    ids, counts = encoder(path).encode(pa.array(texts))
    ends = np.cumsum(counts)
    for text, a, b in zip(texts, ends - counts, ends):
        assert ids[a:b].tolist() == library.encode(text, add_special_tokens=False).ids, ascii(text)
        assert encoder(path).words(text) == bpe_words(library, text), ascii(text)


def bpe_words(library, text):
    """The library's split, its byte characters read back."""
    own = encoder(tokenizer_path())
    found = library.pre_tokenizer.pre_tokenize_str(library.normalizer.normalize_str(text))
    return [bytes(own.byte_of[c] for c in word).decode() for word, _ in found]


def test_lexicon_holds_each_word_under_its_ids_and_shares_suffixes(path):
    words = sorted({a + b for a in ("walk", "talk", "", "x", "é") for b in ("ing", "ed", "s", "ings")})
    ids = [[i, i + 1] for i in range(len(words))]
    compiled = bpe.compile_lexicon([w.encode() for w in words], ids)
    lexicon = bpe.Lexicon(compiled, encoder(path).merge)
    assert lexicon.ranks(pa.array(words)).tolist() == list(range(len(words)))
    assert (lexicon.ranks(pa.array(["", "walk", "walkingx", "zzz", "ÿ", "tal"])) == -1).all()
    # Five stems share one set of endings.
    assert lexicon.states < 25
    pool, starts, lengths = lexicon.ids(pa.array(["walked", "unseen"]))
    assert pool[starts[0] : starts[0] + lengths[0]].tolist() == ids[words.index("walked")]
    merged = pool[starts[1] : starts[1] + lengths[1]].tolist()
    assert merged == encoder(path).tokenizer.encode("unseen", add_special_tokens=False).ids


def test_empty_lexicon(path):
    lexicon = bpe.Lexicon(bpe.compile_lexicon([], []), encoder(path).merge)
    assert (lexicon.ranks(pa.array(["a", ""])) == -1).all()


def test_words_are_counted_over_all_texts(spark, odd_docs, path):
    counts = {r.word: r.n for r in bpe.count_words(odd_docs, path).collect()}
    assert counts["word"] == 20_000 and counts["one"] == 5


def test_encode_decode(spark, odd_docs, path, library):
    encoded = bpe.encode(odd_docs, path)
    texts = sorted((r.text or "") for r in odd_docs.collect())
    want = sorted(tuple(library.encode(t, add_special_tokens=False).ids) for t in texts)
    assert sorted(tuple(r.ids) for r in encoded.collect()) == want
    decoded = sorted(r.text for r in bpe.decode(encoded, path).collect())
    assert decoded == sorted(library.decode(list(i), skip_special_tokens=False) for i in want)


def test_empty_table(no_docs, path):
    assert bpe.round_trip(no_docs, path).count() == 0
    assert bpe.encode(no_docs, path).count() == 0


def test_query(spark, sf_dir, library):
    found = {r.doc_id: r for r in QUERIES["op1_bpe"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(found) == len(docs)
    for r in docs:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        row = found[r.doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_pairs_are_found_by_open_addressing(path):
    own = encoder(path)
    left = np.arange(1000, dtype=np.int32)
    ranks = own.pairs.find(left, left[::-1].copy())
    known = {(int(k) >> 20, int(k) & 0xFFFFF): int(r) for k, r in zip(own.pairs.keys, own.pairs.ranks) if k >= 0}
    assert [known.get((a, b), 2**31 - 1) for a, b in zip(left.tolist(), left[::-1].tolist())] == ranks.tolist()
