"""Spelling variants by asymmetric q-chunks: which words are one edit apart, and which is the common form.

Of two words one edit apart the longer (or later) one gives two disjoint chunks, its
halves, of which the edit leaves at least one whole; the other gives its positional
grams. A chunk meets only grams within shift one of its own place, and the lengths of
both words tell which shift it is, so the chunk's place and text are one join key and
grams at other places are never made. What meets is verified by edit distance.

A half that many words share is not joined: its words' other halves have to be one edit
apart as well, so they are halved again, and the key is the old chunk with the half that
stays. After log2(length) steps all words of a key differ in one place only; their number
is bounded by the alphabet. No key pairs more than ``MOST_PAIRS`` words before that, and
no pair is lost.

Defined results: a null text has no runs; a null ``doc_id`` counts as the empty text
where ids enter a hash; a run is one row's however long the text is; repeated rows count
each; ties of counts go to the word that comes first by code points; an empty table gives
an empty result. Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vidpulse.session import stage

#: Characters of a run: ASCII letters and U+00C0 to U+00FF.
LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LENGTH = 6
MIN_COUNT = 5
#: A form occurs at least so many times as often as its variant.
FORM_RATIO = 5
#: Words of one key that are compared, chunks times grams; keys with more are halved again.
MOST_PAIRS = 4096


def letter_runs(docs: DataFrame, text: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """``doc_id, run``: every run of letters of at least ``min_length``, with A-Z in lower case."""
    runs = docs.select("doc_id", F.explode(F.split(F.col(text), f"[^{LETTERS}]+")).alias("run"))
    run = F.col("run")
    lower = F.when(F.octet_length(run) == F.length(run), F.lower(run)).otherwise(F.translate(run, UPPER, LOWER))
    return runs.filter(F.length(run) >= min_length).select("doc_id", lower.alias("run"))


def without_letter(run: Column, at: Column) -> Column:
    """The run without its code point ``at``, counted from 0."""
    at = at.cast("int")
    return F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))


def count_words(
    words: DataFrame, word: str = "word", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT
) -> DataFrame:
    """``word, n``: words long and frequent enough, from one row for each occurrence."""
    counted = words.filter(F.length(word) >= min_length).groupBy(F.col(word).alias("word"))
    return counted.agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows ``word, n, size, before, after, is_chunk`` with the key of what stays around the edit.

    The word's first ``before`` and last ``after`` code points stay; ``size`` is the
    length of the word whose chunks they are.
    """
    word, after = F.col("word"), F.col("after")
    ends = F.substring(word, F.length(word) - after + 1, after)
    key = F.xxhash64("size", "before", "after", F.substring(word, F.lit(1), F.col("before")), ends)
    return rows.withColumn("key", key)


def _halved(rows: DataFrame) -> DataFrame:
    """Two rows for each: the edit is in the second or in the first half of what is open."""
    size, before, after = F.col("size"), F.col("before"), F.col("after")
    half = F.floor((size - before - after) / 2).cast("int")
    stays = F.array(
        F.struct((before + half).alias("before"), after.alias("after")),
        F.struct(before.alias("before"), (size - before - half).alias("after")),
    )
    halves = rows.select("word", "n", "size", "is_chunk", F.explode(stays).alias("stays"))
    return halves.select("word", "n", "size", "stays.before", "stays.after", "is_chunk")


def _first_halves(words: DataFrame) -> DataFrame:
    """Both chunks of each word, and its grams for chunks of words as long or one longer."""
    length = F.length("word")
    roles = F.array(
        F.struct(length.alias("size"), F.lit(True).alias("is_chunk")),
        F.struct(length.alias("size"), F.lit(False).alias("is_chunk")),
        F.struct((length + 1).alias("size"), F.lit(False).alias("is_chunk")),
    )
    rows = words.select("word", "n", F.explode(roles).alias("role")).select(
        "word", "n", "role.size", F.lit(0).alias("before"), F.lit(0).alias("after"), "role.is_chunk"
    )
    return _halved(rows)


def near_pairs(words: DataFrame, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """``left, left_n, right, right_n``: each two words exactly one edit apart, once.

    ``words`` holds distinct ``word, n``. An edit inserts, deletes or replaces one code point.
    """
    rows, found = _first_halves(words), None
    while True:
        rows = stage(_keyed(rows), "chunks")
        chunks, grams = F.count_if("is_chunk"), F.count_if(~F.col("is_chunk"))
        meet = (
            rows.groupBy("key", (F.col("size") - F.col("before") - F.col("after")).alias("open"))
            .agg(chunks.alias("chunks"), grams.alias("grams"))
            .filter((F.col("chunks") > 0) & (F.col("grams") > 0))
        )
        hot = stage(meet.filter((F.col("chunks") * F.col("grams") > most_pairs) & (F.col("open") > 1)), "hot-chunks")
        any_hot = not hot.isEmpty()
        cold = rows.join(hot.select("key"), "key", "left_anti") if any_hot else rows
        a, b = cold.filter("is_chunk").alias("a"), cold.filter(~F.col("is_chunk")).alias("b")
        left, right = F.col("a.word"), F.col("b.word")
        pairs = (
            a.join(b, F.col("a.key") == F.col("b.key"))
            .filter((F.length(left) > F.length(right)) | (left > right))
            .filter(F.levenshtein(left, right, 1) == 1)
            .select(left.alias("left"), F.col("a.n").alias("left_n"), right.alias("right"), F.col("b.n").alias("right_n"))
        )
        found = pairs if found is None else found.unionByName(pairs)
        if not any_hot:
            return found.distinct()
        rows = _halved(rows.join(hot.select("key"), "key", "left_semi"))


def follow_forms(forms: DataFrame) -> DataFrame:
    """``word, root`` of every ``word, form``: forms followed to the last, twice as far in each round.

    A form is commoner than its variant, so there is no circle.
    """
    links = stage(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = stage(
            links.join(on, "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            ),
            "roots",
        )
        if links.filter("moved").isEmpty():
            return links.select("word", "root")
        links = links.select("word", "root")


def group_variants(words: DataFrame, ratio: int = FORM_RATIO, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every distinct ``word, n``.

    The form is the most frequent word one edit away, where it is at least ``ratio``
    times as frequent; the root is the last form that forms lead to.
    """
    words = stage(words.select("word", "n"), "words")
    pairs = stage(near_pairs(words, most_pairs), "near-words")
    both = pairs.select(
        F.explode(
            F.array(
                F.struct(F.col("left").alias("word"), F.col("right").alias("near"), F.col("right_n").alias("near_n")),
                F.struct(F.col("right").alias("word"), F.col("left").alias("near"), F.col("left_n").alias("near_n")),
            )
        ).alias("p")
    ).select("p.*")
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best"),
    )
    form_n = -F.col("best.less")
    is_form = form_n >= F.lit(ratio) * F.col("n")
    judged = stage(
        words.join(best, "word", "left").select(
            "word",
            "n",
            F.when(is_form, F.col("best.near")).alias("form"),
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(is_form, form_n).alias("form_n"),
        ),
        "judged-words",
    )
    roots = follow_forms(judged.filter(F.col("form").isNotNull()))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
