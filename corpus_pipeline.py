"""From raw documents to shards: each stage works on all that its predecessor kept."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.pinning import pin
from ledgerline.llm import decontamination, mixing, sharding, simhash, toxicity
from ledgerline.llm.common import documents, whole

# Documents with at least this score are toxic.
TOXIC = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under TOXIC; the model learns from labels outside its fold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels.where(~toxicity.held_out()))
    packed = docs.select(F.struct(*docs.columns).alias("doc"), "text")
    return model.score(packed).where(F.col("toxicity") < TOXIC).select("doc.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest doc_id."""
    kept = simhash.near_duplicates(docs).where("keep").select("doc_id", "text_hash").distinct()
    rows = _semi_join(docs, kept, "left_semi")
    # Rows that repeat doc_id and text are copies too.
    return rows.dropDuplicates(["doc_id", "text"])


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = pin(decontamination.contaminated(docs, benchmark).select("doc_id", "text_hash").distinct())
    return _semi_join(docs, found.side, "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    sized = docs.select(
        F.struct(*docs.columns).alias("doc"),
        "doc_id",
        "source",
        mixing.word_count(F.col("text")).alias("words"),
    )
    taken = mixing.mix(sized, "words").where("copies > 0")
    copies = F.sequence(F.lit(1), F.col("copies").cast("int"))
    return taken.select("doc", F.explode(copies)).select("doc.*")


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row."""
    return sharding.interleave(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near copies", drop_near_copies),
    ("benchmark leaks", drop_leaks),
    ("mixing", mix_sources),
    ("sharding", shard),
]

# Similarity and learned scores are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows after the last stage; each stage is stored before the next."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = pin(stage(spark, docs, sf_dir)).df
    return docs


def _semi_join(docs: DataFrame, keys: DataFrame, kind: str) -> DataFrame:
    """`docs` whose doc_id and hash of the text are, or are not, among `keys`."""
    keys = keys.select(F.col("doc_id").alias("in_doc"), F.col("text_hash").alias("in_text"))
    # The columns of the documents are packed, so that none is taken for another.
    rows = docs.select(
        F.struct(*docs.columns).alias("doc"),
        "doc_id",
        F.xxhash64(whole(F.col("text"))).alias("text_hash"),
    )
    same = (F.col("text_hash") == F.col("in_text")) & F.col("doc_id").eqNullSafe(F.col("in_doc"))
    return rows.join(keys, same, kind).select("doc.*")
