"""One query per operator over whole tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from beatmetrics.llm.oracles import clusters_sql, top_k_sql, trie_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _query(build):
    QUERIES[build.__name__] = build
    return build


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@_query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from beatmetrics.llm.packing import pack

    return pack(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


@_query
def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from beatmetrics.llm.sentencepiece_bpe import round_trip

    return round_trip(_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def remainder(modulus: int):
    """crc32 of the id as text, modulo; -1 without an id."""
    from pyspark.sql import functions as F

    text = F.col("doc_id").cast("string")
    return F.coalesce(F.crc32(text.cast("binary")) % modulus, F.lit(-1))


@_query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from beatmetrics.llm import langid

    documents = _table(spark, sf_dir, "documents")
    model = langid.fit(documents.where(remainder(5) != 0))
    return langid.predict(documents, model).withColumn("held_out", remainder(5) == 0)


@_query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from beatmetrics.llm import toxicity

    documents = _table(spark, sf_dir, "documents")
    labels = _table(spark, sf_dir, "labels").where(remainder(4) != 2)
    network = toxicity.fit(documents, labels)
    return toxicity.score(documents, network).select(
        "doc_id",
        (remainder(4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.DEFAULT_THRESHOLD).cast("int").alias("predicted"),
    )


@_query
def op3_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    from beatmetrics.llm.fingerprint import edited_likeness

    return edited_likeness(_table(spark, sf_dir, "documents"))


@_query
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from beatmetrics.llm import pii

    documents = _table(spark, sf_dir, "documents")
    return pii.find(documents, pii.fit(documents))


@_query
def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from beatmetrics.llm.jaccard_join import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"))


@_query
def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from beatmetrics.llm.embedding_dedup import near_vectors

    return near_vectors(_table(spark, sf_dir, "embeddings"))


TOOL_SCHEMAS = {
    "compute": {"a": ("integer", True), "b": ("number", True), "exact": ("boolean", False)},
    "fetch": {"options": ("object", False), "url": ("string", True)},
    "search": {"limit": ("integer", False), "query": ("string", True)},
}


def tool_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls of all assistant turns and results of all user turns.

    The table has no tool calls, so turns stand for them: an assistant's turn
    calls a tool with arguments made of its text, some of them wrong; the
    user's turn behind it is the result.  From the fourth of eight turns on, a
    call builds on the one two turns before.
    """
    from pyspark.sql import functions as F

    text = F.coalesce(F.col("text"), F.lit(""))
    n, digest = F.char_length(text), F.md5(text)
    name = F.get(
        F.array(*[F.lit(t) for t in ("search", "fetch", "compute", "browse")]),
        F.when(n % 13 == 0, 3).otherwise((n % 3).cast("int")),
    )
    call_id = F.concat(F.lit("c"), F.col("conv_id"), F.lit("-"), F.col("turn"))
    arguments = (
        F.when(n % 17 == 0, F.lit('{"a": '))
        .when(
            F.col("name") == "search",
            F.format_string('{ "query" : "%s", "limit": %d }', digest, n),
        )
        .when(
            F.col("name") == "fetch",
            F.format_string(
                '{"url":"https://example.com/%s", "options":{"z":%d,"b":[1, 2]}}', digest, n
            ),
        )
        .when(n % 5 == 0, F.format_string('{"b": "%s"}', digest))
        .otherwise(F.format_string('{"exact": true, "b": %d.5, "a": %d}', n, n))
    )
    before = F.concat(F.lit("c"), F.col("conv_id"), F.lit("-"), F.col("turn") - 2)
    calls = (
        conversations.where("role = 'assistant'")
        .withColumn("name", name)
        .select(
            "conv_id",
            call_id.alias("call_id"),
            "turn",
            "name",
            arguments.alias("arguments"),
            F.when(F.col("turn") % 8 >= 3, F.array(before))
            .otherwise(F.array().cast("array<string>"))
            .alias("after"),
        )
    )
    results = conversations.where("role = 'user'").select(
        "conv_id",
        F.concat(F.lit("c"), F.col("conv_id"), F.lit("-"), F.col("turn") - 1).alias("call_id"),
        "turn",
        F.col("text").alias("content"),
    )
    return calls, results


def other_turns(conversations: DataFrame) -> DataFrame:
    """The turns that are neither, such as a system's."""
    others = conversations.where("role IS NULL OR role NOT IN ('assistant', 'user')")
    return others.select("conv_id", "turn")


@_query
def op8_chat_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    from beatmetrics.llm.chat_tools import link

    conversations = _table(spark, sf_dir, "conversations")
    return link(*tool_calls(conversations), TOOL_SCHEMAS, other_turns(conversations))


@_query
def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from beatmetrics.llm.licenses import scan

    return scan(_table(spark, sf_dir, "documents"))


@_query
def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from beatmetrics.llm.centroids import cluster

    return cluster(_table(spark, sf_dir, "embeddings"))


ORACLES["op11_centroids"] = clusters_sql()


@_query
def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from beatmetrics.llm.trie import conversation_trie

    return conversation_trie(_table(spark, sf_dir, "conversations"))


ORACLES["op12_conversation_trie"] = trie_sql()


@_query
def op13_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from beatmetrics.llm.topk import top_k

    return top_k(_table(spark, sf_dir, "embeddings"))


ORACLES["op13_topk"] = top_k_sql()


@_query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
