"""One registered query for each text operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardloom.llm import alignment, chat, collision, htmltext, jaccard, lexical, linededup, mixing, outliers, packing, topk, toxicity, urlfilter
from wardloom.llm.common import written

Query = Callable[[SparkSession, str], DataFrame]

# fixed values: the rules of the URL filter, and words in host names that put a host on the list
URL_RULES = (
    urlfilter.Rule("allow", "org", "/"),
    urlfilter.Rule("block", "example.org", "/es/"),
    urlfilter.Rule("block", "example.org", "/en/1"),
    urlfilter.Rule("allow", "com", "/fr/"),
    urlfilter.Rule("block", "com", "/de/"),
)
LISTED_WORDS = ("ads", "adult", "bets", "casino", "pills", "poker", "porn", "spam", "track", "xxx")


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def op1_counterfactual_toxicity(spark: SparkSession, d: str) -> DataFrame:
    """Toxicity of every document; labels of the held-out fold are not learned from."""
    docs, fit = table(spark, d, "documents"), toxicity.Fit()
    scored = toxicity.score_texts(docs, toxicity.train(docs, table(spark, d, "labels"), fit))
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("row.doc_id", toxicity.held_out(F.col("row.doc_id"), fit.folds).alias("held_out"), "score", predicted)


def op2_robust_outliers(spark: SparkSession, d: str) -> DataFrame:
    """Quality rules: base statistics and the verdict of the robust distance, for every document."""
    judged = outliers.judge(table(spark, d, "documents"))
    return judged.select("row.doc_id", *outliers.STATS, "base_failed", "distance", "kept")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """The tokenizer file of the registered queries; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_best_fit_packing(spark: SparkSession, d: str) -> DataFrame:
    """Where every piece of every document goes; ids as their CRC-32."""
    packed = packing.pack(table(spark, d, "documents"), tokenizer_path())
    digests = packed.pieces.select("row.doc_id", "piece", "start", "length", "task", "place", F.crc32("ids").alias("ids_crc32"))
    return packed.place(digests)


def op4_size_aware_jaccard(spark: SparkSession, d: str) -> DataFrame:
    """Component of every document under links of at least 85 % similar sets of four-word shingles."""
    return jaccard.similar_components(table(spark, d, "documents"))


def op5_pivotal_mixing(spark: SparkSession, d: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mixed_rows(mixing.copies(table(spark, d, "documents")))


def op6_budgeted_windows(spark: SparkSession, d: str) -> DataFrame:
    """Digests of every conversation, and of one that speaks the template's language, read back from the formatted windows."""
    says = F.lit("</s>[INST] ok [/INST]")
    own = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), says.alias("text")
    )
    turns = table(spark, d, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    return chat.digests(chat.format_windows(turns.unionByName(own)))


def op7_bloom_cascade(spark: SparkSession, d: str) -> DataFrame:
    """Host, path, rule and verdict of every page; hosts with a listed word in their name are the block list."""
    pages = table(spark, d, "pages")
    host = urlfilter.url_parts(F.col("url"))[0]
    listed = pages.select(host.alias("key")).where(F.arrays_overlap(F.split("key", "[.-]"), F.array(*[F.lit(w) for w in LISTED_WORDS])))
    found = urlfilter.filter_urls(pages, URL_RULES, listed)
    return found.select("row.page_id", "host", "path", "rule", "verdict")


def op8_line_suffix_array(spark: SparkSession, d: str) -> DataFrame:
    """Every document without later copies of line runs, and what was deleted."""
    found = linededup.dedup_lines(table(spark, d, "documents"))
    gone = F.aggregate("copies", F.lit(0), lambda s, r: s + r["last"] - r["first"] + 1).cast("long")
    return found.select("row.doc_id", "text", gone.alias("n_deleted"), F.size("copies").cast("long").alias("n_runs"), "emptied")


def op9_pivot_topk(spark: SparkSession, d: str) -> DataFrame:
    """The five best rows for every fiftieth vector."""
    return topk.top_k(table(spark, d, "embeddings"))


def op10_template_removal(spark: SparkSession, d: str) -> DataFrame:
    """Main text of every page."""
    found = htmltext.extract(table(spark, d, "pages"))
    return found.select("row.page_id", "row.url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op11_token_alignment(spark: SparkSession, d: str) -> DataFrame:
    """How the tokens of a byte-level and of a piece tokenizer lie over each other in every document."""
    pieces = tokenizer_path("piece_bpe_32k.model")
    with open(pieces, "rb") as file:
        size = len(alignment.piece_bytes(file.read()))
    aligned = alignment.align(table(spark, d, "documents"), tokenizer_path(), pieces)
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    kept = written(aligned.select("row", "key", *alignment.COUNTS, digest, "pairs", "times"), "aligned", compression="zstd")
    found = alignment.with_link_counts(kept, alignment.pair_counts(kept, size))
    return found.select("row.doc_id", *alignment.COUNTS, "n_best", "count_sum", "groups_sha256")


def op12_ranked_lexical(spark: SparkSession, d: str) -> DataFrame:
    """The twenty best documents for every item of the benchmark."""
    return lexical.rank(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op13_collision_neighbours(spark: SparkSession, d: str) -> DataFrame:
    """Ten near rows for every hundredth vector."""
    return collision.nearest_neighbours(table(spark, d, "embeddings"))


def registered() -> dict[str, Query]:
    return {
        "op1_counterfactual_toxicity": op1_counterfactual_toxicity,
        "op2_robust_outliers": op2_robust_outliers,
        "op3_best_fit_packing": op3_best_fit_packing,
        "op4_size_aware_jaccard": op4_size_aware_jaccard,
        "op5_pivotal_mixing": op5_pivotal_mixing,
        "op6_budgeted_windows": op6_budgeted_windows,
        "op7_bloom_cascade": op7_bloom_cascade,
        "op8_line_suffix_array": op8_line_suffix_array,
        "op9_pivot_topk": op9_pivot_topk,
        "op10_template_removal": op10_template_removal,
        "op11_token_alignment": op11_token_alignment,
        "op12_ranked_lexical": op12_ranked_lexical,
        "op13_collision_neighbours": op13_collision_neighbours,
    }
