"""The registered queries of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.llm.common import ship, table
from hirelens.session import new_run_dir


def op1_site_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hirelens.llm.site_lines import drop_boilerplate

    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return drop_boilerplate(docs, host="source", text="text")


def op2_pfor_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hirelens.llm.pfor import read_token_files, write_token_files

    to = new_run_dir(spark, "llm_token_files")
    write_token_files(table(spark, sf_dir, "documents"), to)
    return read_token_files(spark, to).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from hirelens.llm.mph_bpe import decode_bpe, encode_bpe

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = encode_bpe(docs, path, public_tokenizers.PATTERN).select("doc_id", "ids")
    return decode_bpe(ids, path).select("doc_id", F.expr("length(ids) div 4").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hirelens.llm.bayes_minhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op5_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hirelens.llm.nnls_pack import pack

    pieces = pack(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op6_fertility_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hirelens.llm.fertility import fertility_filter

    return fertility_filter(table(spark, sf_dir, "documents"), only=["doc_id"])


def op7_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hirelens.llm.url_templates import judge_urls

    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


def op8_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hirelens.llm.secrets import listed, secret_spans, train_markov

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    spans = secret_spans(docs, train_markov(docs)).select("doc_id", F.col("secret_spans").alias("s"))
    count = lambda kind: F.size(F.filter("s", lambda x: x["kind"] == kind)).cast("long")
    return spans.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(listed(F.filter("s", lambda x: x["kind"] < 3)), 256).alias("base_sha256"),
        listed(F.col("s")).alias("spans"),
    )


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hirelens.llm.chat_columns import format_and_read

    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "<|im_end|><|im_start|>assistant ok"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return format_and_read(turns.union(more))


def op10_va_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hirelens.llm.va_topk import top_k

    return top_k(table(spark, sf_dir, "embeddings"))


def op11_hilbert_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hirelens.llm.hilbert_negatives import hard_negatives

    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", moved))


def op12_piece_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hirelens.llm.common import vocabulary_path
    from hirelens.llm.piece_spans import decode_pieces, encode_pieces

    path = vocabulary_path("piece_bpe_32k.model")
    pieces = encode_pieces(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    # the spans of a text's pieces follow one another, so their lengths add up to its bytes
    covered = F.aggregate(F.zip_with("ends", "begins", lambda e, b: e - b), F.lit(0).cast("long"), lambda n, x: n + x)
    decoded = decode_pieces(pieces.select("doc_id", "ids", covered.alias("span_bytes")), path)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), "span_bytes")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hirelens.llm.divergence import divergence

    return divergence(table(spark, sf_dir, "documents").select("text", "lang", "source"))


_ALL = (
    op1_site_line_dedup,
    op2_pfor_files,
    op3_byte_bpe,
    op4_near_duplicates,
    op5_nnls_packing,
    op6_fertility_rules,
    op7_url_templates,
    op8_markov_secrets,
    op9_chat_format,
    op10_va_top_k,
    op11_hilbert_negatives,
    op12_piece_spans,
    op13_source_divergence,
)


def _shipped(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: _shipped(f) for f in _ALL}
