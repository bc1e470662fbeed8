"""A training corpus from raw documents.

Languages are predicted and texts in none of them go; of documents that are alike one stays; personal
data are masked; sources are mixed to their target weights; texts are encoded. Every stage works on all
that the one before kept, and all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold.llm import bpe, langid, mixing, ngram_join, pii
from ledgerfold.llm.common import checkpointed, word_count
from ledgerfold.session import small_side

#: A text stays if its language has at least this chance.
LEAST_CHANCE = 0.4
#: Texts go to Python in batches of so many, for a batch of whole texts is held by the JVM and by Python, in each task.
BATCH = 500
#: Documents are alike if the runs of so many words that they share are at least so many in a hundred of all theirs.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def short_batches(spark: SparkSession) -> None:
    """The session's Arrow batches from here on; a stage's plan takes the setting when it is run, which is after its function."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter and those that no language explains; fills in missing languages."""
    short_batches(spark)
    net = langid.fit(docs.filter(~langid.held_out(F.col("doc_id"))))
    judged = langid.predict(docs, net, lang_pred="__lang_pred", score="__score")
    if net is None:  # nothing to learn from, so nothing is known against a text
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    stays = judged.filter((F.col("__lang_pred") != langid.UNKNOWN) & (F.col("__score") >= LEAST_CHANCE))
    return stays.withColumn("lang", F.coalesce("lang", "__lang_pred")).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of smallest id of those that links connect, and all that have no words."""
    short_batches(spark)
    heads = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    found = checkpointed(ngram_join.link_documents(docs, NEAR_WORDS, NEAR_PERCENT).withColumn("stays", heads | (F.col("n_shingles") == 0)))
    ids = found.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("stays").alias("some"), F.count("*").alias("n"))
    gone = ids.filter("NOT some").select("doc_id")
    repeated = checkpointed(ids.filter("some AND n > 1").select("doc_id"))
    kept = docs.join(small_side(gone), "doc_id", "left_anti").select(*docs.columns)
    if repeated.isEmpty():
        return kept
    # one id on several rows: each text is judged by its own set, and of equal sets one row stays
    several = ngram_join.with_set_id(kept.join(small_side(repeated), "doc_id", "left_semi"), NEAR_WORDS, out="__set")
    judged = found.filter("stays AND set_id IS NOT NULL").select("doc_id", F.col("set_id").alias("__set")).distinct()
    once = several.join(judged, ["doc_id", "__set"], "left_semi").dropDuplicates(["doc_id", "__set"])
    empty = several.filter("__set IS NULL")
    rest = kept.join(small_side(repeated), "doc_id", "left_anti").select(*docs.columns)
    return rest.unionByName(once.select(*docs.columns)).unionByName(empty.select(*docs.columns))


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by their kind."""
    out = pii.mask(pii.find_pii(docs, spans="__pii"), spans="__pii")
    changed = F.when(F.size("__pii") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", changed).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix begins them, so their words come to the sources' targets."""
    mix, placed = mixing.schedule(docs)
    # rows of equal id and length can't be told apart here: they share what the mix takes of them
    takes = mixing.taken(mix, placed).groupBy(F.col("doc_id").alias("__id"), F.col("size").alias("__size")).agg(
        F.ceil(F.sum("copies") / F.count("*")).cast("int").alias("__copies")
    ).filter("__copies > 0")
    sized = docs.withColumn("__words", word_count(F.col("text")))
    joined = sized.join(takes, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__words") == F.col("__size")))
    return joined.withColumn("__turn", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, with the digests that tell whether ids and decoded texts are right."""
    short_batches(spark)
    import public_tokenizers

    out = bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.json"), ids="ids")
    return out.select("doc_id", "source", "lang", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("language ID", known_language),
    ("n-gram Jaccard join", one_of_each_group),
    ("PII", masked),
    ("mixing sources to target weights", mixed),
    ("BPE encoding and decoding", encoded),
]

#: Languages are predicted by a trained network, which SQL cannot state.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is stored before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = checkpointed(docs)
    return docs
