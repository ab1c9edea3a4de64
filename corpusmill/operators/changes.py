"""Applying a feed of inserts, updates and deletes.

The state after all changes is found by column-wise last-writer-wins in two aggregations over narrow rows (key, file,
ordinal, arrival and which fields a change sets), each combined before its shuffle, so that one key with a third of all
changes costs one small partial row per task:

1. of the copies of a change (same file and ordinal) the one that arrived last counts;
2. for each key and each field, the change with the highest sequence that sets the field, which counts only if it
   isn't older than the key's latest delete or replacement.

Values are read again for the changes that won, and only they are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.session import checkpointed

#: Rows up to which the changes that won are broadcast (some sixty bytes each).
_BROADCAST_ROWS = 300_000

#: The operations by their first letter.
PUT_OPS = ("i", "u")
DELETE_OP = "d"


def op_kind(op: Column) -> Column:
    """'i', 'u' or 'd' of an operation in any spelling, else null."""
    kind = F.lower(F.substring(F.regexp_replace(op, r"^[\s\x1c-\x1f\x85\p{Z}]+", ""), 1, 1))
    return F.when(kind.isin(*PUT_OPS, DELETE_OP), kind)


def file_sequence(basename: Column) -> Column:
    """Order of files: the number before "n", the number after it, then the name. Names without numbers come first."""
    part = lambda k: F.coalesce(F.regexp_extract(basename, r"(\d+)n(\d+)", k).try_cast("bigint"), F.lit(-1))
    return F.struct(part(1).alias("major"), part(2).alias("minor"), F.coalesce(basename, F.lit("")).alias("name"))


def _rows(changes: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """The changes that count, with _id, which is the same for equal copies of a change and for no other of the key."""
    named = changes.select(
        F.col(key).alias("_key"), op_kind(F.col("op")).alias("_kind"), F.col("basename").alias("_file"), F.col("ordinal").alias("_ordinal"), F.col("arrived_at").alias("_arrived"),
        *[F.col(f).alias(f"_f{i}") for i, f in enumerate(fields)],
    ).filter(F.col("_key").isNotNull() & F.col("_kind").isNotNull())
    content = [F.coalesce(F.col(f"_f{i}").isNull(), F.lit(False)) for i in range(len(fields))] + [F.col(f"_f{i}") for i in range(len(fields))]
    return named.withColumn("_id", F.xxhash64("_file", "_ordinal", "_arrived", "_kind", *content))


def distinct_changes(rows: DataFrame, fields: Sequence[str]) -> DataFrame:
    """One narrow row per change: key, kind, sequence, id and the numbers of the fields that aren't null.

    Copies with equal arrival are told apart by their content.
    """
    given = F.filter(F.array(*[F.when(F.col(f"_f{i}").isNotNull(), F.lit(i)) for i in range(len(fields))]).cast("array<int>"), lambda x: x.isNotNull())
    more = ["_id", given.alias("_given")] if fields else [F.lit(None).cast("bigint").alias("_id"), F.lit(None).cast("array<int>").alias("_given")]
    last = rows.select("_file", "_ordinal", F.struct("_arrived", "_kind", "_key", *more).alias("_c")).groupBy("_file", "_ordinal").agg(F.max("_c").alias("_c"))
    kind = F.col("_c._kind")
    seq = F.struct(
        file_sequence(F.col("_file")).alias("file"), (kind == DELETE_OP).cast("int").alias("phase"),
        F.coalesce(F.col("_ordinal"), F.lit(-1)).alias("ordinal"),
    )
    return last.select(F.col("_c._key").alias("_key"), kind.alias("_kind"), seq.alias("_seq"), "_file", "_ordinal", F.col("_c._id").alias("_id"), F.col("_c._given").alias("_given"))


def apply_changes(changes: DataFrame, key: str, fields: Sequence[str], *, update: str = "replace", trace: bool = True) -> DataFrame:
    """The records that exist after all changes: the key, its fields and, with trace, the file and ordinal of the last change.

    changes has key, op, basename, ordinal, arrived_at and the fields; other columns are ignored. It is read once without
    and, if there are fields, once with their values. update="replace": an insert or an update sets every field, nulls
    included. update="patch": an update sets its non-null fields only; it makes the record if there is none. Within a
    file deletes come last. Changes without a key or with an unknown operation don't count; a null file or ordinal sorts
    first. No changes give no rows.
    """
    if update not in ("replace", "patch"):
        raise ValueError("update is 'replace' or 'patch'")
    rows = _rows(changes, key, fields)
    c = distinct_changes(rows, fields)
    put = F.col("_kind") != DELETE_OP
    resets = F.lit(True) if update == "replace" else (F.col("_kind") != "u")
    won = F.struct(F.col("_seq").alias("s"), F.col("_id").alias("id"), F.col("_file").alias("file"), F.col("_ordinal").alias("ordinal"))
    aggs = [F.max(F.when(put, won)).alias("_put"), F.max(F.when(~put, F.col("_seq"))).alias("_del"), F.max(F.when(resets, F.col("_seq"))).alias("_reset")]
    # where every change sets every field, all of them have the same winner
    own = [] if update == "replace" else list(range(len(fields)))
    for i in own:
        aggs.append(F.max(F.when(put & (resets | F.array_contains("_given", i)), F.struct(F.col("_seq").alias("s"), F.col("_id").alias("id")))).alias(f"_w{i}"))
    state = c.groupBy("_key").agg(*aggs).filter(F.col("_put").isNotNull() & (F.col("_del").isNull() | (F.col("_put.s") > F.col("_del"))))
    last = [F.col("_put.file").alias("basename"), F.col("_put.ordinal").alias("ordinal")] if trace else []
    if not fields:
        return state.select(F.col("_key").alias(key), *last)
    live = [F.when(F.col("_reset").isNull() | (F.col(f"_w{i}.s") >= F.col("_reset")), F.col(f"_w{i}.id")) if i in own else F.col("_put.id") for i in range(len(fields))]
    state = state.select("_key", F.col("_put.id").alias("_last"), F.col("_put.file").alias("_file"), F.col("_put.ordinal").alias("_ordinal"), F.array(*live).alias("_ids"))
    # a row per change that won at least one field, and one for the last change
    wanted = state.select("_key", "_file", "_ordinal", "_ids", F.explode(F.array_distinct(F.filter(F.concat(F.array("_last"), "_ids"), lambda x: x.isNotNull()))).alias("_id"))
    wanted = checkpointed(wanted)
    values = rows.select("_key", "_id", *[f"_f{i}" for i in range(len(fields))])
    met = values.join(F.broadcast(wanted) if wanted.count() <= _BROADCAST_ROWS else wanted, ["_key", "_id"])
    # equal copies of a change are one
    found = met.groupBy("_key").agg(
        F.first("_file").alias("_file"), F.first("_ordinal").alias("_ordinal"), *[F.first(F.when(F.get("_ids", F.lit(i)) == F.col("_id"), F.col(f"_f{i}")), ignorenulls=True).alias(f"_v{i}") for i in range(len(fields))]
    )
    return found.select(F.col("_key").alias(key), *[F.col(f"_v{i}").alias(f) for i, f in enumerate(fields)], *([F.col("_file").alias("basename"), F.col("_ordinal").alias("ordinal")] if trace else []))
