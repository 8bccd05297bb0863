"""Batch periods recomputed from balances that are microfinance of the entity."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.filters import RAW, like, of_keys, within
from ledgerline.functions.joins import apart
from ledgerline.functions.lookups import source_code
from ledgerline.functions.pinning import Pinned, fits_broadcast, pin


# Rows that a repeated pair is expanded to in one piece.
_PIECE = 10_000
# Entities that may share a batch id before its balances are not repeated for each.
_MOST_SHARING = 16


def newest_covered_periods(
    batches: DataFrame, balances: DataFrame, microfinance: DataFrame
) -> DataFrame:
    """Newest period of each (batch, entity) pair of `batches`.

    Only balances of the batch count that also belong to a microfinance record of
    the batch's own entity. A pair with no such balance has no row.
    """
    return _newest(_covered_balances(_pairs(batches), balances, microfinance))


def batch_periods(
    batches: DataFrame,
    balances: DataFrame,
    microfinance: DataFrame,
    codes: DataFrame,
    source_name: str,
) -> DataFrame:
    """One row per batch of the source: its recomputed period, NULL if none.

    Cancelled batches are included. Batches are joined as distinct pairs of batch and
    entity with their number, so a pair or a NULL that is repeated very often is one
    row in the join. Rows are repeated at the end, in pieces that are dealt out.
    """
    own = _pairs(_of_source(batches, codes, source_name))
    return _repeated(_periods(own, balances, microfinance), own)


def batch_periods_sql(
    batches: DataFrame,
    balances: DataFrame,
    microfinance: DataFrame,
    codes: DataFrame,
    source_name: str,
) -> DataFrame:
    """`batch_periods` with the period as a correlated subquery in Spark SQL.

    The subquery is evaluated once per distinct pair of batch and entity.
    """
    own = _pairs(_of_source(batches, codes, source_name))
    found = own.df.sparkSession.sql(
        """
        SELECT b.batch_id, b.entity_id, b.number,
               (SELECT max(c.period_date) FROM {covered} c
                 WHERE c.batch_id = b.batch_id AND c.entity_id = b.entity_id
               ) AS period_date
          FROM {own} b
        """,
        own=own.df,
        covered=_covered_balances(own, balances, microfinance),
    )
    return _repeated(found, own)


def refresh_batch_periods(
    batches: DataFrame,
    balances: DataFrame,
    microfinance: DataFrame,
    codes: DataFrame,
    source_name: str,
) -> DataFrame:
    """The whole batch table with the periods of matched batches replaced.

    Every row whose batch id is among the source's batches takes the recomputed
    period, also when that is NULL and also when the row is of another source
    type. Other rows and columns stay. Fails when the source has a batch id twice.
    """
    source, rows = _new_periods(batches, balances, microfinance, codes, source_name)
    return _with_periods(batches, source, rows)


def changed_periods(
    batches: DataFrame,
    balances: DataFrame,
    microfinance: DataFrame,
    codes: DataFrame,
    source_name: str,
) -> Pinned:
    """Batch ids with their new period, where `refresh_batch_periods` changes a row.

    Stored, with the bounds of batch_id. Columns batch_id and new_period.
    """
    source, rows = _new_periods(batches, balances, microfinance, codes, source_name)
    if fits_broadcast(source, rows):
        source = F.broadcast(source)
    differ = ~F.col("period_date").eqNullSafe(F.col("new_period"))
    changed = batches.select("batch_id", "period_date").join(source, "batch_id").where(differ)
    return pin(changed.select("batch_id", "new_period").distinct(), bounds="batch_id")


def with_periods(batches: DataFrame, changed: Pinned) -> DataFrame:
    """`batches` with the periods of `changed`, which `changed_periods` made."""
    return _with_periods(batches, changed.df, changed.rows)


def merge_batch_periods(source: DataFrame, table: str) -> None:
    """Update the periods of a catalogue table in place from `batch_periods`.

    For tables whose catalogue supports row-level operations; Parquet tables do
    not. Spark itself rejects a target row that several source rows match.
    """
    target = F.col(f"{table}.batch_id")
    (
        source.alias("source")
        .mergeInto(table, F.col("source.batch_id") == target)
        .whenMatched()
        .update({"period_date": F.col("source.period_date")})
        .merge()
    )


def _new_periods(
    batches: DataFrame,
    balances: DataFrame,
    microfinance: DataFrame,
    codes: DataFrame,
    source_name: str,
) -> tuple[DataFrame, int]:
    """The batches of the source with their new period, and how many they are at most."""
    _require_one_period_type(batches, balances)
    own = _pairs(_of_source(batches, codes, source_name))
    _refuse_repeated(own)
    periods = _periods(own, balances, microfinance, crowded=False)
    source = periods.where(F.col("batch_id").isNotNull()).select(
        "batch_id", F.col("period_date").alias("new_period")
    )
    return source, own.rows


def _with_periods(batches: DataFrame, source: DataFrame, rows: int) -> DataFrame:
    source = source.withColumn("matched", F.lit(True))
    if fits_broadcast(source, rows):
        source = F.broadcast(source)
    period = F.when(F.col("matched"), F.col("new_period")).otherwise(
        F.col("period_date")
    )
    return (
        batches.join(source, "batch_id", "left")
        .withColumn("period_date", period)
        .select([c for c in batches.columns if not c.startswith(RAW)])
    )


def _of_source(batches: DataFrame, codes: DataFrame, source_name: str) -> DataFrame:
    wanted = source_code(codes, source_name)
    return batches.where(F.col("source_type") == wanted).select(
        "batch_id", "entity_id"
    )


def _require_one_period_type(batches: DataFrame, balances: DataFrame) -> None:
    kinds = {df.schema["period_date"].dataType for df in (batches, balances)}
    if len(kinds) > 1:
        names = sorted(kind.simpleString() for kind in kinds)
        raise ValueError(f"periods of two types: {' and '.join(names)}")


def _pairs(batches: DataFrame) -> Pinned:
    """The distinct pairs of batch and entity with their number of rows, stored."""
    counted = batches.groupBy("batch_id", "entity_id").agg(F.count(F.lit(1)).alias("number"))
    return pin(counted, bounds="batch_id")


def _refuse_repeated(own: Pinned) -> None:
    """Raise when a batch id occurs more than once.

    Done before the big join, so that a merge that cannot succeed costs little. NULL
    never matches a target row, so it may be repeated.
    """
    per_batch = own.df.groupBy("batch_id").agg(F.sum("number").alias("rows"))
    found = per_batch.where("rows > 1 AND batch_id IS NOT NULL").agg(F.max("batch_id")).first()
    if found[0] is not None:
        raise ValueError(f"several source rows for batch {found[0]}")


def _periods(
    own: Pinned, balances: DataFrame, microfinance: DataFrame, crowded: bool = True
) -> DataFrame:
    """Each pair with its number and its period."""
    newest = pin(_newest(_covered_balances(own, balances, microfinance, crowded)))
    return own.df.join(newest.side, ["batch_id", "entity_id"], "left").select(
        "batch_id", "entity_id", "period_date", "number"
    )


def _repeated(pairs: DataFrame, own: Pinned) -> DataFrame:
    """Batch and period of every pair, as often as its `number` in `own` says.

    A number is cut into pieces, which are dealt out, before anything is repeated.
    """
    if own.df.where("number > 1").isEmpty():
        return pairs.select("batch_id", "period_date")
    starts = F.sequence(F.lit(0), F.col("number") - 1, F.lit(_PIECE))
    pieces = pairs.withColumn("start", F.explode(starts))
    # With a number of its own Spark keeps these partitions, small as they are yet.
    partitions = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pieces.repartition(partitions, "batch_id", "entity_id", "start")
    size = F.least(F.col("number") - F.col("start"), F.lit(_PIECE))
    return dealt.select(
        "batch_id", "period_date", F.explode(F.sequence(F.lit(1), size)).alias("copy")
    ).drop("copy")


def _newest(covered: DataFrame) -> DataFrame:
    return covered.groupBy("batch_id", "entity_id").agg(
        F.max("period_date").alias("period_date")
    )


def _covered_balances(
    batches: Pinned, balances: DataFrame, microfinance: DataFrame, crowded: bool = True
) -> DataFrame:
    """Balances of pairs of batch and entity that are microfinance of the entity.

    The batch's entity is attached first. Microfinance then only has to confirm
    (person, balance, entity), a semi-join that adds no row, where a join on
    (person, balance) alone would pair every batch of that key with every entity.

    A balance is repeated for each entity that shares its batch id, up to a few. The
    balances of batches that more entities share (none of them, when `crowded` is false)
    go the other way: see `_covered_crowded`. `batches` holds each pair once.
    """
    shared = _crowded(batches) if crowded else None
    owned = _owned(batches, shared, balances)
    microfinance = _of_entities(microfinance, batches)
    if fits_broadcast(batches.df, batches.rows):
        # A small source: reading its balances twice costs less than shuffling all records.
        mine = owned if shared is None else within(balances, batches, "batch_id")
        microfinance = like(microfinance, mine, ["person_id", "balance_id"])
    record = ["person_id", "balance_id", "entity_id"]
    confirmed = microfinance.select(*apart(*record)).distinct().select(record)
    covered = owned.join(confirmed, record, "left_semi").select(
        "batch_id", "entity_id", "period_date"
    )
    if shared is None:
        return covered
    return covered.union(_covered_crowded(batches, shared, balances, confirmed))


def _owned(batches: Pinned, shared: Pinned | None, balances: DataFrame) -> DataFrame:
    """Balances with the entities of their batch, but for the batches in `shared`."""
    keys = batches.df.select("batch_id", "entity_id")
    if shared is not None:
        keys = keys.join(shared.side, "batch_id", "left_anti")
    if fits_broadcast(keys, batches.rows):
        return within(balances, batches, "batch_id").join(F.broadcast(keys), "batch_id")
    return of_keys(balances, batches, "batch_id").join(keys, "batch_id")


def _crowded(batches: Pinned) -> Pinned | None:
    """The batch ids that more than a few entities share, if there are any."""
    sharing = batches.df.where("batch_id IS NOT NULL").groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"))
    many = sharing.where(F.col("n") > _MOST_SHARING).select("batch_id")
    return None if many.isEmpty() else pin(many, bounds="batch_id")


def _covered_crowded(
    batches: Pinned, shared: Pinned, balances: DataFrame, confirmed: DataFrame
) -> DataFrame:
    """What is covered of batches that many entities share.

    A batch's distinct records look up the entities they are microfinance of, and only
    then are those of the batch kept: as many rows as its records have entities, where
    its balances times its entities would be their product.
    """
    records = (
        of_keys(balances, shared, "batch_id")
        .groupBy(*apart("batch_id", "person_id", "balance_id"))
        .agg(F.max("period_date").alias("period_date"))
        .drop("group_hash")
    )
    found = _newest(records.join(confirmed, ["person_id", "balance_id"]))
    keys = batches.df.select("batch_id", "entity_id")
    return found.join(keys, ["batch_id", "entity_id"], "left_semi").select(
        "batch_id", "entity_id", "period_date"
    )


def _of_entities(microfinance: DataFrame, batches: Pinned) -> DataFrame:
    """`microfinance` without most of the records of entities that have no batch."""
    entities = batches.df.select("entity_id")
    if fits_broadcast(entities, batches.rows):
        return microfinance.join(F.broadcast(entities), "entity_id", "left_semi")
    return like(microfinance, entities, ["entity_id"])
