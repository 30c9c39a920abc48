"""Named queries of the operators: name -> (spark, sf_dir) -> DataFrame, and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vidpulse.llm import (
    bpe,
    jaccard,
    language,
    licences,
    neighbours,
    packing,
    periods,
    pii,
    quality,
    sharding,
    spelling,
    tokenfile,
    warc,
)
from vidpulse.llm.common import ship, table, tokenizer_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(build: Query) -> Query:
    @wraps(build)
    def run(spark: SparkSession, d: str) -> DataFrame:
        ship(spark)
        return build(spark, d)

    QUERIES[build.__name__] = run
    return run


@query
def op1_bpe(spark, d):
    return bpe.round_trip(table(spark, d, "documents"), tokenizer_path())


@query
def op4_language(spark, d):
    docs = table(spark, d, "documents")
    learned = language.learn(docs.filter(~language.held_out(F.col("doc_id"))))
    found = language.predict(docs, learned)
    return found.select(
        "doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected"
    )


@query
def op6_packing(spark, d):
    return packing.piece_table(packing.pack(table(spark, d, "documents"), tokenizer_path()))


@query
def op7_quality(spark, d):
    return quality.quality_rules(table(spark, d, "documents"))


@query
def op9_pii(spark, d):
    return pii.pseudonymise(table(spark, d, "documents"), pii.secret_of(spark, pii.TRIAL_KEY))


@query
def op10_jaccard(spark, d):
    return jaccard.jaccard_components(table(spark, d, "documents"))


@query
def op8_tokenfile(spark, d):
    files = tokenfile.write_files(table(spark, d, "documents"), tokenizer_path())
    return tokenfile.read_files(spark, files)


@query
def op3_neighbours(spark, d):
    return neighbours.nearest(table(spark, d, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op5_warc(spark, d):
    archives = warc.write_archives(table(spark, d, "pages"))
    return warc.read_archives(spark, archives, payloads=False)


@query
def op2_licences(spark, d):
    """The table has no paths, so a document lies in the folder of its source and language."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("source", "lang", "doc_id")]
    files = table(spark, d, "documents").select("doc_id", F.concat_ws("/", *parts).alias("path"), "text")
    found = licences.scan(files)
    return found.withColumn("doc_id", F.element_at(F.split("path", "/"), -1).try_cast("long"))


@query
def op11_spelling(spark, d):
    """Runs are thinned by the contract's rule (a letter of one run in 199 goes), then counted and grouped."""
    runs = spelling.letter_runs(table(spark, d, "documents"))
    run, doc_id = F.col("run"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    h = F.crc32(F.concat(doc_id, F.lit(":"), run))
    word = F.when(h % 199 == 0, spelling.without_letter(run, h % F.length(run))).otherwise(run)
    return spelling.group_variants(spelling.count_words(runs.select(word.alias("word"))))


@query
def op12_sharding(spark, d):
    """Eight shards, written and read back."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    records = sharding.write_shards(docs, 8)
    return sharding.read_shards(spark, records, docs).select(
        "doc_id",
        sharding.size_of("text").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        F.col("place").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        "map_version",
    )


def with_repeated_tail(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: the texts that the contract of op 13 gives a periodic end have it."""
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"))
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    planted = docs.select(
        "doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("words")
    ).withColumn("n", F.size("words"))
    start = F.col("g") % F.col("n")
    period = 1 + F.floor((F.col("n") - start) / (3 + F.col("g") % 8))

    def word(i):
        place = F.when(i < start, i).otherwise(start + (i - start) % period)
        return F.element_at("words", (place + 1).cast("int"))

    numbers = F.sequence(F.lit(0).cast("long"), F.col("n").cast("long") - 1)
    repeated = F.array_join(F.transform(numbers, word), " ")
    return planted.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))


@query
def op13_periods(spark, d):
    found = periods.periodic_runs(with_repeated_tail(table(spark, d, "documents")))
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    strongest = F.aggregate(
        "runs",
        none,
        lambda best, x: F.when(
            best.isNull() | (x["length"] * best["period"] > best["length"] * x["period"]), x
        ).otherwise(best),
    )
    lines = F.transform("runs", lambda x: F.concat_ws(",", x["start"], x["length"], x["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("best", strongest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


ORACLE_SQL["op2_licences"] = licences.oracle()
