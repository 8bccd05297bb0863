"""Lines that many documents share, dropped."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.pinning import pin
from ledgerline.llm.common import BLANKS, ascii_lower, documents, whole


def line_key(line: Column) -> Column:
    """A line without blanks at its ends and with A-Z in lower case."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def drop_shared_lines(
    docs: DataFrame, min_chars: int = 40, min_docs: int = 5
) -> DataFrame:
    """Documents without the lines that at least `min_docs` documents share.

    A line counts by its key; keys under `min_chars` code points never go. A
    shared line stays in the document with the largest doc_id that holds it, and
    within it as often as it stands there. Returns doc_id, n_lines (before),
    n_dropped and kept, the remaining lines joined by newlines.

    A null text is empty; an empty text is one empty line. Rows with one doc_id
    are one document where documents are counted, and each gives a row. Null is a
    doc_id below all others. Other columns are not looked at. No row is lost.

    Keys are compared by 128 bits of hash. Only positions and hashes are exploded
    and shuffled; texts move once, to meet the positions their document loses.
    """
    rows = docs.select("doc_id", whole(F.col("text")).alias("text")).withColumn(
        "text_hash", F.xxhash64("text")
    )
    lines = F.split("text", "\n", -1)
    exploded = (
        rows.select("doc_id", "text_hash", F.posexplode(lines).alias("position", "line"))
        .select("doc_id", "text_hash", "position", line_key(F.col("line")).alias("key"))
        .where(F.char_length("key") >= min_chars)
        .select(
            "doc_id",
            "text_hash",
            "position",
            F.xxhash64("key").alias("key_hash"),
            F.xxhash64(F.lit("second"), "key").alias("key_hash2"),
        )
    )
    # struct() lets a null doc_id count as a document.
    shared = (
        exploded.groupBy("key_hash", "key_hash2")
        .agg(
            F.count_distinct(F.struct("doc_id")).alias("n"),
            F.max("doc_id").alias("keeper"),
        )
        .where(F.col("n") >= min_docs)
        .select("key_hash", "key_hash2", "keeper")
    )
    dropped = (
        exploded.join(pin(shared).side, ["key_hash", "key_hash2"])
        .where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set("position").alias("dropped"))
        .select(
            F.col("doc_id").alias("in_doc"), F.col("text_hash").alias("in_text"), "dropped"
        )
    )
    same = (F.col("text_hash") == F.col("in_text")) & F.col("doc_id").eqNullSafe(
        F.col("in_doc")
    )
    # A column of its own, which is split once; positions are a set difference.
    joined = rows.join(dropped, same, "left").withColumn("lines", lines)
    places = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "dropped")
    kept = F.concat_ws("\n", F.transform(places, lambda place: F.get(F.col("lines"), place)))
    return joined.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("dropped").isNull(), F.col("text")).otherwise(kept).alias("kept"),
    )


def query(spark, sf_dir) -> DataFrame:
    return drop_shared_lines(documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256")
    )


SQL = """
    WITH lines AS (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
          FROM documents),
    keyed AS (
        SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
          FROM lines),
    shared AS (
        SELECT key, max(doc_id) AS keeper FROM keyed
         WHERE length(key) >= 40
         GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
    marked AS (
        SELECT k.*, s.keeper IS NOT NULL AND s.keeper <> k.doc_id AS gone
          FROM keyed k LEFT JOIN shared s USING (key))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), ''))
               AS kept_sha256
      FROM marked GROUP BY doc_id"""
