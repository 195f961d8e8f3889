"""The registered queries of the corpus operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import ann, centroids, decontaminate, jaccard, negatives, quality, sharding, simhash, tokens, toxicity, urls, warc
from riskframe.llm.mixture import Mixture
from riskframe.llm.common import ORACLES, QUERIES, query, table  # noqa: F401


@query("op1_decontaminate")
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a test item, with the item and the alignment score."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op2_quality")
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learnt from two thirds of the labels."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learnt from four fifths of the labels."""
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op4_sharding")
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of a hash tree, and where they go with one more."""
    documents = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + 16).alias("size"),
        F.coalesce(F.crc32("text"), F.lit(0)).cast("bigint").alias("text_crc32"),
    )
    tree = sharding.Tree.uniform(40)
    found = sharding.sharded(documents, tree, tree.with_shard(40), order=("text_crc32", "size"))
    return found.withColumn("law", F.lit("key")).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "region", "rack"
    )


#: Fixed rules of the query: verdict, then host and path.
URL_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


URL_FILTER = urls.Filter(URL_RULES)


@query("op5_url_filter", urls.equivalent_sql(URL_FILTER))
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all pages by four rules, else by propagated trust and distrust of hosts."""
    return URL_FILTER.judge(table(spark, sf_dir, "pages"))


@query("op6_mixture")
def op6_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed by source: weights 5, 2, 1 in turn, at most three times each."""
    return Mixture().report(table(spark, sf_dir, "documents"))


@query("op7_learned_partitions")
def op7_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest of every vector whose id is divisible by 50, among all others."""
    return ann.Search().nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op8_warc_captures")
def op8_warc_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records, read back, with their position in the merged capture history."""
    found = warc.archive_pages(spark, table(spark, sf_dir, "pages"), F.lit(1704067200) + F.pmod(F.col("page_id"), F.lit(10**8)))
    return found.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured_at", "position"
    )


@query("op9_token_files")
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written to token files and read back."""
    import public_tokenizers

    read = tokens.encode_documents(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return read.select("doc_id", "start", "n_tokens", tokens.checksum(F.col("ids")).alias("ids_crc32"))


@query("op10_simhash_dedup")
def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components of all documents: 4-word shingles, at most 4 differing bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), F.col("component").alias("component_id")
    )


JACCARD_JOIN = jaccard.JaccardJoin()


@query("op11_jaccard_join", jaccard.equivalent_sql(JACCARD_JOIN))
def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents whose 4-word shingles share 85 % of their union."""
    return JACCARD_JOIN.components(table(spark, sf_dir, "documents"))


HARD_NEGATIVES = negatives.HardNegatives()


@query(
    "op12_hard_negatives",
    negatives.equivalent_sql(HARD_NEGATIVES, "vec_id % 100 = 0", "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"),
)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positives and hard negatives of every vector whose id is divisible by 100."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return HARD_NEGATIVES.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


CLUSTERING = centroids.HeapClustering()


@query("op13_heap_clustering", centroids.equivalent_sql(CLUSTERING))
def op13_heap_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors of 64 components in 40 clusters, after five rounds."""
    return CLUSTERING.cluster(table(spark, sf_dir, "embeddings"))
