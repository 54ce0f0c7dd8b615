"""One query for each operator, over its whole table; ``sql`` holds the SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ridgepole.llm import counts, forest, jaccard, langid, mixing, near, packing, phrases, quotes, repeats, shards, sql, transducer, turns
from ridgepole.llm.common import stored
from ridgepole.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 largest inner products that the forest finds for every twentieth vector."""
    return forest.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard of 16, its slot there, and its shard if there were 17."""
    text = F.col("text").cast("binary")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.coalesce(F.length(text) + 1, F.lit(1)).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    nodes = shards.tree(16)
    placed = shards.place(rows, F.col("doc_id"), nodes)
    placed = shards.place(placed, F.col("doc_id"), shards.grow(nodes), out="grown_shard")
    numbered = shards.with_slots(placed, F.col("doc_id"), ["doc_id", "size", "text_crc32"])
    return numbered.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query
def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of cosine 0.9 and more between all vectors, and one kept vector of each component."""
    found = near.dedup(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "n_links", "component_id", "kept")


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of two ways to count: loaded as two batches, each replayed, after a revision.

    The ids of the byte-level BPE are first booked without, then revised to include, the
    separator that packing adds to each document.
    """
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    words = docs.select("source", "lang", mixing.word_count(F.col("text")).alias("n_tokens"))
    ids = stored(counts.count_tokens(docs.select("source", "lang", "text"), public_tokenizers.path("byte_bpe_50k.json")), "token-counts")
    store = counts.Totals(spark, scratch_dir(spark, "totals"))
    n = F.col("n_tokens")
    for _ in range(2):
        store.commit("load words", counts.inserted(words, "words"))
        store.commit("load byte_bpe_50k", counts.inserted(ids, "byte_bpe_50k"))
        store.commit("separators", counts.revised(ids, "byte_bpe_50k", old=n, new=n + 1))
    return store.totals()


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the folds that are not held out."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    model = langid.fit(docs.where(~held_out))
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    return langid.predict(rows, model, F.col("text")).select("doc_id", "held_out", "lang_pred", "score", "lang_mix")


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids in sequences of at most 1024, by the 50k byte-level BPE."""
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose five-word shingles are 0.8 similar or more."""
    return jaccard.join(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the 200-byte strings that occur twice."""
    found = repeats.remove(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of every document so that sources meet weights 5, 2, 1 in turn."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mixing.mix(docs, F.col("doc_id"), F.col("source"), mixing.word_count(F.col("text")))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "taken")


@query
def op10_chat_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as mail: each reply quotes the turn before it, which quotes the one before.

    Spark writes the quotes from the whole table; the operator has to find the parents,
    strip the quotes and put the replies in order.
    """
    talk = table(spark, sf_dir, "conversations")
    order = Window.partitionBy("conv_id").orderBy("turn")
    quoted = lambda text, marks: F.regexp_replace(text, "(?m)^", marks)
    mail = talk.select(
        "conv_id", "turn", "role",
        F.concat_ws(
            "\n",
            quoted(F.lag("text", 1).over(order), "> "),
            quoted(F.lag("text", 2).over(order), "> > "),
            F.col("text"),
        ).alias("text"),
    )
    return quotes.conversations(mail).select("conv_id", "turn", "role", "text", "parent_turn", "root_turn", "depth", "position")


def damaged(talk: DataFrame) -> DataFrame:
    """Conversations with rows dropped, emptied, cut, repeated or given another role, by their key's CRC."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(key.cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    rows = talk.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        kind.alias("kind"),
    )
    return rows.where("kind <> 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1)))).drop("kind", "copy")


@query
def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations, their faults and their cheapest repair."""
    talk = table(spark, sf_dir, "conversations")
    found = turns.report(damaged(talk)).withColumnRenamed("conv_id", "_found")
    joined = talk.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("_found")), "left")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return joined.select(
        "conv_id",
        *[F.coalesce(n, F.lit(0)).cast("bigint").alias(n) for n in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2000 phrases of two and three words."""
    return phrases.Collocations(table(spark, sf_dir, "documents"), least=10).top(2000)


@query
def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded by the multilingual ranks and decoded again."""
    import public_tokenizers

    path, docs = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = transducer.round_trip(docs, path, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


ORACLE: dict[str, str] = dict(sql.ORACLE)
