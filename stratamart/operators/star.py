"""From natural keys to surrogate keys, and what gets lost on the way."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.sources.shared_folder import delete_folder, fresh_folder
from stratamart.sources.warehouse import CODEC, plan_size
from stratamart.specs import DimLookup, FactSpec

# Rows of one key that a task may get; a key with more is spread over as many tasks as that takes.
HOT_KEY_ROWS = 1_000_000
# Fewer keys than this can each have more than 1 / _MOST_HOT_KEYS of the rows. Where a table has more
# rows than HOT_KEY_ROWS times this number, its tasks get larger instead of the list of keys.
_MOST_HOT_KEYS = 16_384
# The sketch of n rows errs by 3.5 n / m at most, m being the power of two of its size, and lists every item
# that it is sure has more than that. With m = 8 * _MOST_HOT_KEYS a key above 1 / _MOST_HOT_KEYS has more than
# twice the error, so it is listed; sketches fill three quarters of m. Of listed items fewer than twice
# _MOST_HOT_KEYS can have an estimate as high as such a key.
_TRACKED = 6 * _MOST_HOT_KEYS
_LISTED = 2 * _MOST_HOT_KEYS


def _will_be_broadcast(df: DataFrame, max_bytes: int | None) -> bool:
    """Whether Spark, by its own size check, broadcasts this side."""
    if max_bytes is None:
        conf = df.sparkSession._jsparkSession.sessionState().conf()
        max_bytes = conf.autoBroadcastJoinThreshold()
    return plan_size(df) <= max_bytes


def _dimension_side(dim: DataFrame, lookup: DimLookup) -> DataFrame:
    return dim.select(
        *[F.col(key).alias(f"__key_{i}") for i, (_, key) in enumerate(lookup.on)],
        F.col(lookup.surrogate).alias(lookup.output),
        *[F.col(c) for c in lookup.carry],
    )


def _match(lookup: DimLookup) -> Column:
    return reduce(and_, [F.col(c) == F.col(f"__key_{i}") for i, (c, _) in enumerate(lookup.on)])


def _key_hash(keys: Sequence[Column]) -> Column:
    """One number for the values of a key; NULL if one of them is."""
    present = reduce(and_, [k.isNotNull() for k in keys])
    return F.when(present, F.xxhash64(*keys))


def _frequent_keys(facts: DataFrame, keys: Mapping[int, Sequence[str]], hot_rows: int) -> DataFrame:
    """(lookup, hash, salts): keys of which a task's share of rows is not enough, and the tasks each needs.

    ``keys`` has the columns of each lookup, by its number. One pass over the facts makes a sketch of the
    frequent keys of every lookup; sketches are merged like any partial aggregate. By the size of the
    sketch none with more than a share is left out, and counts are at most too high, so a key may get a
    task more than it needs.
    """
    found, entries = [], []
    for i, columns in keys.items():
        hashed = _key_hash([F.col(c) for c in columns])
        top = F.call_function("approx_top_k", hashed, F.lit(_LISTED), F.lit(_TRACKED))
        found += [F.count(hashed).alias(f"n{i}"), top.alias(f"top{i}")]
        entries.append(F.struct(F.lit(i).alias("lookup"), F.col(f"n{i}").alias("n"), F.col(f"top{i}").alias("top")))
    lookups = facts.agg(*found).select(F.inline(F.array(*entries)))
    share = F.greatest(F.lit(hot_rows), F.ceil(F.col("n") / _MOST_HOT_KEYS))
    listed = lookups.select("lookup", share.alias("share"), F.inline("top"))
    return listed.where(F.col("item").isNotNull() & (F.col("count") > F.col("share"))).select(
        "lookup", F.col("item").alias("hash"), F.ceil(F.col("count") / F.col("share")).cast("int").alias("salts")
    )


def _hot_keys(facts: DataFrame, keys: Mapping[int, Sequence[str]], hot_rows: int) -> DataFrame:
    """The bounded list of ``_frequent_keys``, stored once so that every lookup reads the same."""
    hot = _frequent_keys(facts, keys, hot_rows)
    folder = fresh_folder(facts.sparkSession, "hot-keys")
    hot.write.parquet(folder)
    return facts.sparkSession.read.schema(hot.schema).parquet(folder)


def _salted(
    facts: DataFrame,
    side: DataFrame,
    lookup: DimLookup,
    known: Sequence[str],
    hot: DataFrame | None,
    row_id: str,
) -> DataFrame:
    """Shuffled lookup that spreads the rows of hot and of NULL keys over several tasks.

    Their salt is made from the row's own id, so a recomputed task salts alike. A hot key has as many
    salts as it needs tasks, and its dimension row is repeated as often. A NULL key meets no dimension
    row, so its rows are spread over all tasks. All other rows have salt 0. Both sides tell a hot key by
    its hash, so two keys with one hash would only both be spread.
    """
    row_hash = F.xxhash64(row_id)
    missing = reduce(or_, [F.col(c).isNull() for c, _ in lookup.on])
    left, right = facts, side.withColumn("__side_salt", F.lit(0).cast("bigint"))
    salt = F.lit(0).cast("bigint")
    if hot is not None:
        types = dict(facts.dtypes)
        names = [(c, f"__key_{i}") for i, (c, _) in enumerate(lookup.on) if c in known]
        # Equal values of other types would hash differently; one that the fact's type cannot hold is no match.
        of_side = _key_hash([F.col(name).try_cast(types[c]) for c, name in names])
        marked = F.broadcast(hot.select(F.col("hash").alias("__hash"), F.col("salts").alias("__salts")))  # see _hot_keys
        left = facts.join(marked, _key_hash([F.col(c) for c, _ in names]) == F.col("__hash"), "left")
        salt = F.when(F.col("__salts").isNotNull(), F.pmod(row_hash, F.col("__salts"))).otherwise(salt)
        salts = F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col("__salts"), F.lit(1)) - F.lit(1).cast("bigint"))
        right = side.join(marked, of_side == F.col("__hash"), "left").withColumn("__side_salt", F.explode(salts))
        right = right.select(*side.columns, "__side_salt")
    left = left.select(*facts.columns, F.when(missing, row_hash).otherwise(salt).alias("__salt"))
    matched = left.join(
        right.hint("merge"), _match(lookup) & (F.col("__salt") == F.col("__side_salt")), lookup.how
    )
    return matched.drop("__salt", "__side_salt")


def _set_down(rows: DataFrame, before: str | None) -> tuple[DataFrame, str]:
    """Rows written to a fresh folder and read from there, and the folder; that of the rows they are made from goes."""
    folder = fresh_folder(rows.sparkSession, "looked-up")
    rows.write.option("compression", CODEC).parquet(folder)
    if before is not None:
        delete_folder(rows.sparkSession, before)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder), folder


def lookup_keys(
    facts: DataFrame,
    dims: Mapping[str, DataFrame],
    lookups: Sequence[DimLookup],
    row_id: str,
    hot_rows: int = HOT_KEY_ROWS,
    max_broadcast: int | None = None,
    in_turn: bool = False,
) -> DataFrame:
    """Add the surrogate key of every lookup, in order. A dimension may be used in several roles.

    Inner lookups drop rows without a match, left ones keep them. No side is forced to be broadcast:
    Spark does so for dimensions below its own size limit (or ``max_broadcast`` bytes), and then the
    facts are not shuffled at all. Larger dimensions are joined by a shuffle with hot keys spread. Those of
    all lookups are found in one pass over the incoming rows, so no lookup is computed again for it. A
    bucketed dimension sets the number of tasks of its lookup: read it without its buckets.

    Every shuffled lookup moves all facts, and one query holds its shuffles until it ends. With ``in_turn`` each of
    these lookups but the last is made at once, and its rows are set down in the shared folder: the disks then hold
    the facts a few times over, however many lookups there are. The caller is to let go of the shuffles of
    each write (``passing_shuffles``) and, in the end, of the rows set down last (``passing_folders``).
    """
    sides = [_dimension_side(dims[lookup.dimension], lookup) for lookup in lookups]
    shuffled = [i for i, side in enumerate(sides) if not _will_be_broadcast(side, max_broadcast)]
    known = {i: [c for c, _ in lookups[i].on if c in facts.columns] for i in shuffled}
    known = {i: columns for i, columns in known.items() if columns}
    hot, spread = None, set()
    if known:
        hot = _hot_keys(facts, known, hot_rows)
        spread = {r["lookup"] for r in hot.select("lookup").distinct().collect()}  # a number for each lookup
    keyed, folder = facts, None
    for i, (lookup, side) in enumerate(zip(lookups, sides, strict=True)):
        if i not in shuffled:
            joined = keyed.join(side, _match(lookup), lookup.how)
        elif i not in spread and lookup.how == "inner":
            joined = keyed.join(side.hint("merge"), _match(lookup), lookup.how)
        else:
            of_lookup = hot.where(F.col("lookup") == i) if i in spread else None
            joined = _salted(keyed, side, lookup, known.get(i, ()), of_lookup, row_id)
        keyed = joined.drop(*[f"__key_{j}" for j in range(len(lookup.on))])
        if in_turn and i in shuffled[:-1]:
            keyed, folder = _set_down(keyed, folder)
    return keyed


def shuffles_facts(
    dims: Mapping[str, DataFrame], lookups: Sequence[DimLookup], max_broadcast: int | None = None
) -> bool:
    """Whether some dimension is too large to be broadcast, so that its lookup moves the facts."""
    sides = [_dimension_side(dims[lookup.dimension], lookup) for lookup in lookups]
    return not all(_will_be_broadcast(side, max_broadcast) for side in sides)


def fact_rows(
    staged: DataFrame,
    dims: Mapping[str, DataFrame],
    spec: FactSpec,
    max_broadcast: int | None = None,
    in_turn: bool = False,
) -> DataFrame:
    """The rows a fact merge takes as its source: key, surrogate keys and measures. ``in_turn``: see ``lookup_keys``."""
    measures = [F.expr(sql).cast(spec.types[m]).alias(m) for m, sql in spec.measures.items()]
    needed = list(dict.fromkeys([spec.key, *[c for lk in spec.lookups for c, _ in lk.on]]))
    carried = {c for lk in spec.lookups for c in lk.carry}
    narrow = staged.select(*[c for c in needed if c not in carried], *measures)
    keyed = lookup_keys(narrow, dims, spec.lookups, spec.key, max_broadcast=max_broadcast, in_turn=in_turn)
    return keyed.select(spec.key, *[lk.output for lk in spec.lookups], *spec.measures)


def unmatched_report(
    facts: DataFrame,
    dims: Mapping[str, DataFrame],
    lookups: Sequence[DimLookup],
    row_id: str,
    max_broadcast: int | None = None,
) -> DataFrame:
    """(dimension, role, null_keys, unknown_keys): fact rows each lookup cannot resolve.

    One pass over the facts: every lookup is made as a left one, and what it found is counted. A lookup
    through an attribute of another dimension, which an inner lookup has to find first, only counts rows
    for which that was found.
    """
    needed = {c for lk in lookups for c, _ in lk.on} - {c for lk in lookups for c in lk.carry}
    narrow = facts.select(*dict.fromkeys([row_id, *[c for c in facts.columns if c in needed]]))
    kept = [replace(lookup, how="left") for lookup in lookups]
    keyed = lookup_keys(narrow, dims, kept, row_id, max_broadcast=max_broadcast)
    counts, entries = [], []
    for i, lookup in enumerate(lookups):
        columns = [c for c, _ in lookup.on]
        missing = reduce(or_, [F.col(c).isNull() for c in columns])
        unknown = ~missing & F.col(lookup.output).isNull()
        through = [lk for lk in lookups if lk.how == "inner" and set(lk.carry) & set(columns)]
        reached = reduce(and_, [F.col(lk.output).isNotNull() for lk in through], F.lit(True))
        counts += [F.count_if(reached & missing).alias(f"n{i}"), F.count_if(reached & unknown).alias(f"u{i}")]
        entries.append(
            F.struct(
                F.lit(lookup.dimension).alias("dimension"),
                F.lit(lookup.output).alias("role"),
                F.col(f"n{i}").alias("null_keys"),
                F.col(f"u{i}").alias("unknown_keys"),
            )
        )
    return keyed.agg(*counts).select(F.inline(F.array(*entries)))


def orphaned_keys(facts: DataFrame, column: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Referential check on a stored fact: surrogate keys without a dimension row, with row counts."""
    used = facts.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    return used.join(dim.select(F.col(dim_key).alias(column)), on=column, how="left_anti")
