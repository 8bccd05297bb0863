"""I-Match fingerprints: hashes of a document's terms of middling rarity."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.pinning import Pinned, pin
from ledgerline.llm.common import documents, whole

# Shares of all documents that a term of the lexicon is in: the band of inverse
# document frequency, from log(1/HIGH) to log(1/LOW).
LOW, HIGH = 1 / 1000, 1 / 4
# Subsets of the lexicon: each level keeps half the terms of the one before.
FAMILIES, LEVELS = 3, 10

# Terms of a text in a subset beyond which the subset does not tell texts apart.
MOST_TERMS = 4
# Equal rows that are put out by one task.
_PIECE = 10_000

# What tells documents apart: doc_id, null or not, and a hash of the text.
KEY = ["no_id", "id", "text_hash"]
_NONE, _MANY = "-" * 8, "+" * 8

_BETWEEN_TERMS = r"""[\x20\x09-\x0D.,;:!?"()\[\]]+"""
# Slots of the lexicon's table. A row carries a copy of it through one projection.
_TABLE = 1 << 12


def term_hashes(text: Column) -> Column:
    """Hashes of the distinct terms of a text, in lower case, without punctuation."""
    terms = F.array_distinct(F.split(F.lower(text), _BETWEEN_TERMS))
    return F.transform(F.array_remove(terms, ""), lambda term: F.xxhash64(term))


def lexicon(texts: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """Column `term`: hashes of terms within the band of document frequencies.

    `texts` has one column, text, without nulls. A term of the band is in at least
    `low` of all documents, so there are at most 1/low times the mean number of
    distinct terms of a document, however many documents there are.
    """
    number = texts.count()
    counts = texts.select(F.explode(term_hashes(F.col("text"))).alias("term")).groupBy("term")
    return counts.count().where(F.col("count").between(low * number, high * number)).select("term")


def lookup_table(terms: DataFrame) -> Column:
    """The lexicon as one value: arrays of hashes, by hash modulo their number."""
    slots = terms.sparkSession.range(_TABLE).withColumnRenamed("id", "slot")
    filled = terms.groupBy(F.pmod("term", F.lit(_TABLE)).alias("slot")).agg(
        F.collect_list("term").alias("terms")
    )
    empty = F.array().cast("array<bigint>")
    rows = slots.join(filled, "slot", "left").select(
        F.struct("slot", F.coalesce("terms", empty).alias("terms")).alias("row")
    )
    ordered = F.sort_array(F.collect_list("row"))
    return rows.select(F.transform(ordered, lambda row: row["terms"])).scalar()


def _kept(terms: Column | str, family: int, level: int) -> Column:
    """Of terms kept on the level before, those that this level keeps."""
    bit = F.lit(1 << (level - 1))
    return F.filter(
        terms, lambda term: F.xxhash64(term, F.lit(family)).bitwiseAND(bit) == 0
    )


def with_fingerprint(rows: DataFrame, text: str, lexicon: Column, name: str) -> DataFrame:
    """Add column `name`, the fingerprint of column `text`, which must not be null.

    `lexicon` is a value as `lookup_table` gives it.

    Distinct terms of the lexicon are sorted and hashed, whole and in each subset of
    the lexicon: 8 hex digits each, dashes where the subset has no term of the text, and
    plus signs where it has more than MOST_TERMS. So a text is told by the subsets in
    which it has a few terms, whatever its length. A text that has no term of the lexicon
    uses all its terms.
    """
    known = F.filter(
        "all_terms",
        lambda term: F.array_contains(
            F.get(F.col("lexicon"), F.pmod(term, F.lit(_TABLE)).cast("int")), term
        ),
    )
    used = F.when(F.size("known") > 0, F.col("known")).otherwise(F.col("all_terms"))
    rows = rows.withColumns({"all_terms": term_hashes(F.col(text)), "lexicon": lexicon})
    rows = rows.withColumn("known", known).drop("lexicon").withColumn("f0l0", F.sort_array(used))
    rows = rows.drop("all_terms", "known")
    names = ["f0l0"]
    # One projection per level, so that each works on what the one before has kept.
    for level in range(1, LEVELS + 1):
        step = {}
        for family in range(1, FAMILIES + 1):
            before = "f0l0" if level == 1 else f"f{family}l{level - 1}"
            step[f"f{family}l{level}"] = _kept(before, family, level)
        rows = rows.withColumns(step)
        names += step
    parts = []
    for part in names:
        digest = F.lpad(F.substring(F.lower(F.hex(F.xxhash64(part))), -8, 8), 8, "0")
        many = (F.size(part) > MOST_TERMS) if part != "f0l0" else F.lit(False)
        parts.append(F.when(F.size(part) == 0, F.lit(_NONE)).when(many, F.lit(_MANY)).otherwise(digest))
    return rows.withColumn(name, F.concat(*parts)).drop(*names)


def likeness(a: Column | str, b: Column | str) -> Column:
    """Share of equal hashes among the subsets in which either text has a few terms.

    Equal fingerprints have likeness 1, also those without any term.
    """
    places = range(9, 8 * (1 + FAMILIES * LEVELS), 8)
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    pairs = [(a.substr(at, 8), b.substr(at, 8)) for at in places]

    def few(part: Column) -> Column:
        return (part != F.lit(_NONE)) & (part != F.lit(_MANY))

    in_either = sum(((few(x) | few(y)).cast("int") for x, y in pairs), F.lit(0))
    equal = sum((((x == y) & few(x)).cast("int") for x, y in pairs), F.lit(0))
    return F.when(a == b, F.lit(1.0)).when(in_either > 0, equal / in_either).otherwise(F.lit(0.0))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every row, over the lexicon of all of `docs`.

    A null text is empty; a text without terms has a fingerprint of dashes. Equal
    texts have equal fingerprints. Other columns are not looked at. No row is lost,
    an empty table gives none. Texts are not shuffled.
    """
    rows = docs.select("doc_id", whole(F.col("text")).alias("text"))
    table = lookup_table(pin(lexicon(rows.select("text"))).df)
    marked = with_fingerprint(rows, "text", table, "fingerprint")
    return marked.select("doc_id", "fingerprint")


def in_order(rows: DataFrame) -> Pinned:
    """The distinct documents in order: doc_id, KEY, n_chars, copies and place, from 0.

    `rows` has doc_id, text and KEY. Documents are ordered by doc_id (null first), then
    by the hash of the text. They are sorted in ranges that Spark draws from a sample,
    without their texts; numbers of rows, one per range, give the places.
    """
    counted = rows.groupBy(*KEY).agg(
        F.first("doc_id").alias("doc_id"),
        F.max(F.char_length("text")).cast("long").alias("n_chars"),
        F.count(F.lit(1)).alias("copies"),
    )
    order = [F.col("doc_id").asc_nulls_first(), F.col("text_hash")]
    numbered = (
        counted.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("number", F.monotonically_increasing_id())
    )
    # The upper bits are the number of the range.
    stored = pin(numbered.withColumn("range", F.shiftright("number", 33))).df
    parts = stored.groupBy("range").agg(F.min("number").alias("first"), F.count(F.lit(1)).alias("size"))
    # A row per partition of a shuffle.
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("size").over(earlier), F.lit(0))
    shifts = parts.select("range", (before - F.col("first")).alias("shift"))
    placed = stored.join(F.broadcast(shifts), "range").withColumn("place", F.col("number") + F.col("shift"))
    return pin(placed.drop("number", "range", "shift"))


def with_edited(docs: DataFrame) -> DataFrame:
    """Distinct documents, each with `text` and `edited`: KEY, doc_id, n_chars, place.

    The last quarter of a text, rounded down, is replaced by the first as many characters
    (or all) of the next document's, see `in_order`; after the last comes the first. Of
    `times` rows with equal doc_id and text, all but the last are followed by their own
    text: that makes a second row, with `own` true.

    Any doc_id with an order will do. A null text is empty. No task holds a range of
    documents or the copies of one: each text goes to its key once, and the part that it
    lends to the key that borrows it.
    """
    text, doc_id = whole(F.col("text")), F.col("doc_id")
    rows = docs.select(
        "doc_id",
        text.alias("text"),
        doc_id.isNull().alias("no_id"),
        F.coalesce(doc_id.cast("string"), F.lit("")).alias("id"),
        F.xxhash64(text).alias("text_hash"),
    )
    order = in_order(rows)
    taken = F.expr("n_chars div 4").cast("int")
    following = F.pmod(F.col("place") + 1, F.lit(max(order.rows, 1)))
    borrowers = order.df.select(following.alias("place"), taken.alias("taken"), *(F.col(k).alias(f"to_{k}") for k in KEY))
    lenders = order.df.select("place", *KEY).join(borrowers, "place").drop("place")
    texts = rows.select(*KEY, "text").dropDuplicates(KEY)
    lent = texts.join(lenders, KEY).select(
        *(F.col(f"to_{k}").alias(k) for k in KEY), F.substring("text", F.lit(1), F.col("taken")).alias("lent")
    )
    found = texts.join(order.df, KEY).join(lent, KEY).withColumn("taken", taken)

    def variant(own: bool, times: Column) -> Column:
        return F.struct(F.lit(own).alias("own"), times.alias("times"))

    last = variant(False, F.lit(1).cast("long"))
    variants = F.when(F.col("copies") > 1, F.array(last, variant(True, F.col("copies") - 1))).otherwise(F.array(last))
    kept = F.substring("text", F.lit(1), (F.col("n_chars") - F.col("taken")).cast("int"))
    more = F.when(F.col("v.own"), F.substring("text", F.lit(1), F.col("taken"))).otherwise(F.col("lent"))
    return found.withColumn("v", F.explode(variants)).select(
        *KEY, "doc_id", "n_chars", "place", "v.own", "v.times", "text", F.concat(kept, more).alias("edited")
    )


def edit_likeness(docs: DataFrame) -> DataFrame:
    """Fingerprints of every row and of its edited text, and how like they are.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited
    and near_next. See `with_edited` and `fingerprints` for nulls, ties and repeated
    rows. Every row gives a row, an empty table none.
    """
    table = lookup_table(pin(lexicon(docs.select(whole(F.col("text")).alias("text")))).df)
    rows = with_fingerprint(with_edited(docs), "text", table, "fingerprint").drop("text")
    rows = rows.withColumn("edited_sha256", F.sha2("edited", 256))
    rows = pin(with_fingerprint(rows, "edited", table, "edited_fingerprint").drop("edited")).df
    number = rows.where(~F.col("own")).count()
    before = F.pmod(F.col("place") - 1, F.lit(max(number, 1)))
    following = rows.where(~F.col("own")).select(before.alias("place"), F.col("fingerprint").alias("next"))
    marked = rows.join(following, "place").withColumn(
        "next", F.when(F.col("own"), F.col("fingerprint")).otherwise(F.col("next"))
    )
    return _repeated(marked).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        likeness("fingerprint", "next").alias("near_next"),
    )


def _repeated(rows: DataFrame) -> DataFrame:
    """Every row `times` times; many of one row are put out by several tasks."""
    starts = F.sequence(F.lit(0).cast("long"), F.col("times") - 1, F.lit(_PIECE).cast("long"))
    pieces = rows.withColumn("start", F.explode(starts))
    size = F.least(F.col("times") - F.col("start"), F.lit(_PIECE).cast("long"))
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pieces.withColumn("size", size).repartition(partitions, "place", "own", "start")
    return dealt.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("size"))))


def query(spark, sf_dir) -> DataFrame:
    return edit_likeness(documents(spark, sf_dir).select("doc_id", "text"))
