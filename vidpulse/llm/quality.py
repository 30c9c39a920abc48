"""Line-first quality rules: bad lines go, then documents that lost too much.

Each line is judged by itself: marks and punctuation, navigation bars, boilerplate
phrases with few other words. Lines that fail are removed; a document is rejected when removed lines held
more than ``max_lost`` of the characters in its words, or when it fails the base rules
(fewer than 20 words, or over 30 % of them in repeated windows of eight words).

Words are runs without ASCII white space. Defined results: a null text has no words and
is rejected, and stays null where texts are returned; lines without a word are neither
judged nor removed; repeated rows are judged each by itself; an empty table gives an
empty result. Only the named columns are read, and ``clean`` passes all others through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from vidpulse.llm.common import coded, raw_bytes, slices, split_words, string_array, texts_of

MIN_WORDS = 20
REPEAT_WINDOW = 8
MAX_REPEAT_PERCENT = 30
#: Share of the characters in words that removed lines may hold.
MAX_LOST = 0.5
#: A line fails with more than this many symbols per character of its words,
MAX_SYMBOLS = 0.1
#: bars per word,
MAX_BARS = 0.2
#: or exclamation marks per word.
MAX_SHOUTS = 0.5
#: Boilerplate phrases count in lines with at most so many words for each phrase found.
PHRASE_WORDS = 20
#: Lines of fewer words need an end mark.
FRAGMENT_WORDS = 4

SYMBOLS = b"#*$%&|<>"
BARS = b"|>"
END_MARKS = ".!?:;\"')]»”’…。！？"
BOILERPLATE = (
    r"(?i)(all rights reserved|terms of (use|service)|privacy policy|cookie (policy|settings|consent)"
    r"|use(s)? cookies|enable javascript|javascript is (disabled|required)|sign (in|up) (to|for|with)"
    r"|subscribe to (our|the)|newsletter|click here|read more|skip to (main )?content|lorem ipsum"
    r"|follow us on|share (this )?on|page not found|powered by"
    # French
    r"|tous droits réservés|politique de confidentialité|conditions (générales )?d['’]utilisation|mentions légales"
    r"|(utilise|accepter) (tous )?(des |les )?cookies|active[rz] javascript|abonnez-vous|lire la suite|cliquez ici"
    r"|connectez-vous|suivez-nous|aller au contenu|page introuvable|propulsé par"
    # German
    r"|alle rechte vorbehalten|datenschutzerklärung|nutzungsbedingungen|cookie-(einstellungen|richtlinie)"
    r"|(verwendet|verwenden|akzeptieren) cookies|cookies akzeptieren|javascript aktivieren|jetzt abonnieren|weiterlesen"
    r"|hier klicken|klicken sie hier|folgen sie uns|zum inhalt springen|seite nicht gefunden"
    # Spanish
    r"|todos los derechos reservados|política de (privacidad|cookies)|términos (de uso|del servicio|y condiciones)"
    r"|aviso legal|(utiliza|utilizamos|aceptar) (las )?cookies|activ[ae]r? javascript|suscríbete|leer más|(haz|haga) clic aquí"
    r"|inicia sesión|síguenos|saltar al contenido|página no encontrada)"
)


def byte_class(chars: bytes) -> np.ndarray:
    held = np.zeros(256, np.int64)
    held[list(chars)] = 1
    return held


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The sum of each run ``bounds[i]:bounds[i + 1]``, empty runs included."""
    return np.diff(np.concatenate([[0], np.cumsum(values)])[bounds])


def split_lines(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """``(offsets, lines)``: text ``i`` has the lines ``offsets[i]:offsets[i + 1]``, one at least."""
    bounds, data = raw_bytes(texts)
    breaks = np.flatnonzero(data == 0x0A)
    counts = np.diff(np.searchsorted(breaks, bounds)) + 1
    text_of = np.repeat(np.arange(len(counts)), counts)
    offsets = np.concatenate([[0], np.cumsum(counts)])
    ends = np.empty(len(text_of), np.int64)
    ends[offsets[1:] - 1] = bounds[1:]
    inner = np.ones(len(text_of), bool)
    inner[offsets[1:] - 1] = False
    ends[inner] = breaks
    starts = np.empty(len(text_of), np.int64)
    starts[offsets[:-1]] = bounds[:-1]
    later = np.ones(len(text_of), bool)
    later[offsets[:-1]] = False
    starts[later] = breaks + 1
    return offsets, string_array(ends - starts, data[data != 0x0A])


def line_features(lines: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(words, characters in words, fails)`` of each line."""
    bounds, data = raw_bytes(lines)
    at, words = split_words(lines)
    n_words = np.diff(at)
    chars = sums(pc.utf8_length(words).to_numpy().astype(np.int64), at)
    symbols = sums(byte_class(SYMBOLS)[data], bounds)
    bars = sums(byte_class(BARS)[data], bounds)
    shouts = sums(byte_class(b"!")[data], bounds)
    marked = pc.match_substring_regex(pc.ascii_trim_whitespace(lines), f"[{_escaped(END_MARKS)}]$")
    ended = marked.to_numpy(zero_copy_only=False)
    phrases = pc.count_substring_regex(lines, BOILERPLATE).to_numpy()
    boiler = (phrases > 0) & (n_words <= PHRASE_WORDS * phrases)
    fails = (
        (symbols > MAX_SYMBOLS * chars)
        | ((bars >= 2) & (bars > MAX_BARS * n_words))
        | ((shouts >= 3) & (shouts > MAX_SHOUTS * n_words))
        | (~ended & (n_words < FRAGMENT_WORDS))
        | boiler
    )
    return n_words, chars, fails & (n_words > 0)


def _escaped(chars: str) -> str:
    return "".join("\\" + c if c in "[]\\^-" else c for c in chars)


def repeated_words(codes: np.ndarray, offsets: np.ndarray, window: int = REPEAT_WINDOW) -> np.ndarray:
    """Per text, the words that lie in a window of words found at least twice in the text.

    Windows are compared by a hash first, of which equal windows have equal ones; texts
    with an equal pair are then compared word by word.
    """
    counts = np.diff(offsets)
    out = np.zeros(len(counts), np.int64)
    n = len(codes) - window + 1
    if n <= 0:
        return out
    text_of = np.repeat(np.arange(len(counts)), counts)
    mixed = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    rolled = text_of[:n].astype(np.uint64)
    for k in range(window):
        rolled = (rolled * np.uint64(0xBF58476D1CE4E5B9)) ^ mixed[k : k + n]
        rolled ^= rolled >> np.uint64(31)
    inside = text_of[:n] == text_of[window - 1 :]
    start = np.flatnonzero(inside)
    ordered = np.sort(rolled[start])
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return out
    suspects = np.unique(text_of[start[np.isin(rolled[start], twice)]])
    for i in suspects.tolist():
        own = codes[offsets[i] : offsets[i + 1]]
        rows = np.lib.stride_tricks.sliding_window_view(own, window)
        _, inverse, found = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
        hit = np.flatnonzero(found[inverse.ravel()] > 1)
        edge = np.zeros(len(own) + 1, np.int64)
        np.add.at(edge, hit, 1)
        np.add.at(edge, hit + window, -1)
        out[i] = int((np.cumsum(edge)[:-1] > 0).sum())
    return out


def judge(texts: pa.Array, max_lost: float = MAX_LOST) -> tuple[dict[str, np.ndarray], pa.Array]:
    """``(columns, cleaned texts)`` of texts without nulls."""
    offsets, words = split_words(texts)
    codes, distinct = coded(words)
    n_words = np.diff(offsets)
    chars = pc.utf8_length(distinct).to_numpy().astype(np.int64)
    word_chars = sums(chars[codes], offsets)
    bounds, data = raw_bytes(texts)
    n_symbols = sums(byte_class(SYMBOLS)[data], bounds)

    line_at, lines = split_lines(texts)
    line_code, line_kinds = coded(lines)
    kind_words, kind_chars, kind_fails = line_features(line_kinds)
    text_of = np.repeat(np.arange(len(n_words)), np.diff(line_at))
    worded = kind_words[line_code] > 0
    keys = text_of[worded] * len(line_kinds) + line_code[worded]
    distinct_lines = np.bincount(np.unique(keys) // max(1, len(line_kinds)), minlength=len(n_words))
    n_dup_lines = np.bincount(text_of[worded], minlength=len(n_words)) - distinct_lines

    fails = kind_fails[line_code]
    lost = sums(np.where(fails, kind_chars[line_code], 0), line_at)
    n_repeat = repeated_words(codes, offsets)
    base_failed = (n_words < MIN_WORDS) | (100 * n_repeat > MAX_REPEAT_PERCENT * n_words)
    kept = ~base_failed & (lost <= max_lost * word_chars)

    stays = np.flatnonzero(~fails)
    left = np.concatenate([[0], np.cumsum(sums((~fails).astype(np.int64), line_at))]).astype(np.int32)
    runs = pa.ListArray.from_arrays(pa.array(left), line_kinds.take(pa.array(line_code[stays])))
    cleaned = pc.binary_join(runs, "\n")
    columns = {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": n_symbols,
        "n_dup_lines": n_dup_lines,
        "n_repeat_words": n_repeat,
        "base_failed": base_failed,
        "kept": kept,
        "n_removed_lines": sums(fails.astype(np.int64), line_at),
        "lost_chars": lost,
    }
    return columns, cleaned


SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_removed_lines long, lost_chars long"
)


def quality_rules(docs: DataFrame, max_lost: float = MAX_LOST, text: str = "text", texts: bool = False) -> DataFrame:
    """``doc_id``, the counts and the verdict of every row, and with ``texts`` the cleaned text."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, text):
                columns, cleaned = judge(texts_of(part, text), max_lost)
                arrays = [part.column("doc_id"), *map(pa.array, columns.values())]
                names = ["doc_id", *columns]
                if texts:
                    arrays.append(pc.if_else(pc.is_valid(part.column(text)), cleaned, None))
                    names.append("cleaned")
                yield pa.RecordBatch.from_arrays(arrays, names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {SCHEMA}" + (", cleaned string" if texts else "")
    return docs.select("doc_id", text).mapInArrow(run, schema)


def clean(docs: DataFrame, max_lost: float = MAX_LOST, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """The rows that stay, all their columns, the text without its failed lines.

    ``length`` names a column that counts the text's characters, set anew if there is one.
    """

    def run(batches):
        for batch in batches:
            for part in slices(batch, text):
                columns, cleaned = judge(texts_of(part, text), max_lost)
                part = part.set_column(part.schema.get_field_index(text), text, cleaned)
                if length in part.schema.names:
                    at = part.schema.get_field_index(length)
                    counted = pc.utf8_length(cleaned).cast(part.schema.field(at).type)
                    part = part.set_column(at, length, counted)
                yield part.filter(pa.array(columns["kept"]))

    return docs.mapInArrow(run, docs.schema)
