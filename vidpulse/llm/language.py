"""Language by compression: the dictionary that makes a text smallest names its language.

For every language a raw-content zstandard dictionary is filled from a bounded sample of
labelled texts, each up to ``DICTIONARY_BYTES`` of its own: a language with little text has
a short dictionary and leaves the others as they are. A text is cut into pieces, each compressed against every dictionary in a
frame of its own, so that a long text keeps leaning on the dictionary instead of on
itself; the sizes of all pieces add up. The margin is the share by which the smallest
total undercuts the next; texts with a narrow margin are rejected.

Defined results: ``und`` with score 0 for a null text and one without a letter; ties go
to the language with more labelled texts; with one language its score is 1; without any labelled
row everything is ``und``. A language without a letter in its texts is not learned. Rows are judged one by one, so repeated rows agree.
"""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vidpulse.llm.common import slices

UNKNOWN = "und"
#: Bytes of each language's dictionary; texts drawn per language at most, and their length.
DICTIONARY_BYTES = 32 << 10
SAMPLE_TEXTS = 256
SAMPLE_CHARS = 8000
#: Bytes of a text that are compressed as one piece.
PIECE = 2048
LEVEL = 6
#: Contents below the full size that differ by less than this share count as equally long.
NEAR = 0.1
#: A text is rejected when the margin is below this.
MIN_MARGIN = 0.002

#: Candidates for letters; numerals and superscripts among them are no letters (Unicode category L).
WORDY = re.compile(r"[^\W\d_]")
#: ASCII characters other than letters become spaces.
PLAIN = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in range(256))


def has_letter(text: str) -> bool:
    """Whether a character is of category L, which the sample's ``\\p{L}`` means too."""
    return any(unicodedata.category(m[0])[0] == "L" for m in WORDY.finditer(text))


def letters(text: str) -> bytes:
    """The lower-cased text with single spaces for all that is no letter in ASCII."""
    return b" ".join(text.lower().encode().translate(PLAIN).split())


def held_out(doc_id: Column) -> Column:
    """One third of the documents, by a checksum of the id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def sample(labelled: DataFrame, texts: int = SAMPLE_TEXTS) -> dict[str, list[str]]:
    """About ``texts`` different texts of each language, chosen by the texts' hashes.

    Equal texts share a hash and are drawn once. Of a longer text a piece of ``SAMPLE_CHARS``
    is drawn, at a place given by the hash, and where that has no letter, from the text's
    first letter on. What reaches the driver is bounded by languages x 2 x ``texts`` x
    ``SAMPLE_CHARS``.
    """
    rows = labelled.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rows = rows.select("lang", "text", F.xxhash64("text").alias("mark"))
    counts = rows.groupBy("lang").agg(F.approx_count_distinct("mark").alias("n")).collect()
    if not counts:
        return {}
    span = 2**64
    cuts = {r["lang"]: -(2**63) + min(span - 1, int(span * 1.25 * texts / max(1, r["n"]))) for r in counts}
    cut = F.create_map(*(F.lit(x) for pair in cuts.items() for x in pair))
    drawn = rows.filter(F.col("mark") <= cut[F.col("lang")])
    start = F.pmod("mark", F.greatest(F.length("text") - SAMPLE_CHARS + 1, F.lit(1))).cast("int") + 1
    piece = F.substring("text", start, SAMPLE_CHARS)
    later = F.substring(F.regexp_extract("text", r"(?s)\p{L}.*", 0), 1, SAMPLE_CHARS)
    drawn = drawn.select("lang", "mark", F.when(piece.rlike(r"\p{L}"), piece).otherwise(later).alias("text"))
    drawn = drawn.groupBy("lang", "mark").agg(F.first("text").alias("text"))
    counts.sort(key=lambda r: (-r["n"], r["lang"]))
    found: dict[str, list[str]] = {r["lang"]: [] for r in counts}
    for r in drawn.orderBy("lang", "mark").limit(2 * texts * len(cuts)).collect():
        found[r["lang"]].append(r["text"])
    return found


def dictionaries(texts: dict[str, list[str]], size: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """The raw content of each language's dictionary, of the language's own size up to ``size``.

    Contents that nearly agree in length get the same one, so that none wins by a few bytes;
    full ones stay whole, and none loses more than the share ``NEAR``.
    """
    whole = {lang: letters(" ".join(own))[:size] for lang, own in texts.items() if any(map(has_letter, own))}
    lengths = [len(x) for x in whole.values()]
    even = {n: n if n == size else min(m for m in lengths if m >= n * (1 - NEAR)) for n in lengths}
    return {lang: own[: even[len(own)]] for lang, own in whole.items()}


def learn(labelled: DataFrame, texts: int = SAMPLE_TEXTS) -> dict[str, bytes]:
    return dictionaries(sample(labelled, texts))


class Classifier:
    def __init__(self, content: dict[str, bytes]):
        self.languages = list(content)
        self.compress = []
        for own in content.values():
            held = zstandard.ZstdCompressionDict(own, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(level=LEVEL)
            made = zstandard.ZstdCompressor(
                level=LEVEL, dict_data=held, write_checksum=False, write_content_size=False, write_dict_id=False
            )
            self.compress.append(made.compress)

    def judge(self, text: str | None) -> tuple[str, float]:
        """``(language, margin)``."""
        if text is None or not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        raw = letters(text)
        pieces = [raw[i : i + PIECE] for i in range(0, len(raw), PIECE)]
        totals = [sum(map(len, map(compress, pieces))) for compress in self.compress]
        best = min(range(len(totals)), key=totals.__getitem__)
        rest = [n for k, n in enumerate(totals) if k != best]
        margin = 1 - totals[best] / max(1, min(rest)) if rest else 1.0
        return self.languages[best], margin


def predict(docs: DataFrame, content: dict[str, bytes], min_margin: float = MIN_MARGIN, text: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` of every row; the score is the margin."""

    def run(batches):
        judge = Classifier(content).judge
        for batch in batches:
            found = [judge(x) for part in slices(batch, text) for x in part.column(text).to_pylist()]
            names, scores = [x[0] for x in found], [x[1] for x in found]
            rejected = [name == UNKNOWN or score < min_margin for name, score in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                ["doc_id", "lang_pred", "score", "rejected"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text).mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, rejected boolean")


def identified(docs: DataFrame, content: dict[str, bytes], min_margin: float = MIN_MARGIN, text: str = "text") -> DataFrame:
    """The rows whose language is found, all their columns as they are."""

    def run(batches):
        judge = Classifier(content).judge
        for batch in batches:
            for part in slices(batch, text):
                found = [judge(x) for x in part.column(text).to_pylist()]
                yield part.filter(pa.array([n != UNKNOWN and s >= min_margin for n, s in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
