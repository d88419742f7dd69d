"""Applying a complete source to a target snapshot.

Spark's built-in tables have no MERGE, so each merge is a DataFrame that computes the next snapshot
from a full outer equi-join. Both sides are unique on the key (see ``checks.assert_unique``), so the
join has no hot keys. It shuffles each side once, or only the source if the target snapshot is
bucketed by the key, or neither if both are.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.operators.keys import assign_surrogate_keys
from stratamart.session import timestamp_literal
from stratamart.specs import AUDIT_CREATED, AUDIT_DELETED, AUDIT_DELETED_AT, AUDIT_UPDATED

WAS_ACTIVE = "__was_active"
_IN_SOURCE, _IN_TARGET, _OLD = "__in_source", "__in_target", "__old_"


def _outer_join(
    target: DataFrame, source: DataFrame, keys: Sequence[str], cols: Sequence[str], kept: Sequence[str]
) -> DataFrame:
    """Rows of either side: keys, ``cols`` of the source, ``cols`` and ``kept`` of the target."""
    old = target.select(
        *keys,
        *[F.col(c).alias(_OLD + c) for c in [*cols, *kept]],
        F.lit(True).alias(_IN_TARGET),
    )
    new = source.withColumn(_IN_SOURCE, F.lit(True))
    return new.join(old, on=list(keys), how="full_outer")


def _old(name: str) -> Column:
    return F.col(_OLD + name)


def merge_soft_delete(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    run_ts: dt.datetime,
    mark: bool = False,
) -> DataFrame:
    """Insert, update (which revives), and soft-delete what the source no longer has.

    With ``mark`` a column ``WAS_ACTIVE`` tells whether the row was active in the target (NULL if it was
    not there), for ``change_measures`` to count what the run changes.

    ===========  ============  ==========  ==========  ==========  ==========
    row in       columns from  created_at  updated_at  is_deleted  deleted_at
    ===========  ============  ==========  ==========  ==========  ==========
    source only  source        run         run         false       null
    both         source        target      run         false       null
    target, active   target    target      run         true        run
    target, deleted  target    target      target      true        target
    ===========  ============  ==========  ==========  ==========  ==========
    """
    audit = [AUDIT_CREATED, AUDIT_UPDATED, AUDIT_DELETED, AUDIT_DELETED_AT]
    rows = _outer_join(target, source.select(*keys, *cols), keys, cols, audit)
    run = timestamp_literal(run_ts)
    in_source = F.col(_IN_SOURCE).isNotNull()
    removed_now = ~in_source & ~_old(AUDIT_DELETED)
    return rows.select(
        *keys,
        *[F.when(in_source, F.col(c)).otherwise(_old(c)).alias(c) for c in cols],
        F.coalesce(_old(AUDIT_CREATED), run).alias(AUDIT_CREATED),
        F.when(in_source | removed_now, run).otherwise(_old(AUDIT_UPDATED)).alias(AUDIT_UPDATED),
        (~in_source).alias(AUDIT_DELETED),
        F.when(removed_now, run).when(~in_source, _old(AUDIT_DELETED_AT)).alias(AUDIT_DELETED_AT),
        *([(~_old(AUDIT_DELETED)).alias(WAS_ACTIVE)] if mark else []),
    )


def change_measures() -> dict[str, Column]:
    """Aggregates over a marked merge: active rows before it, those it deletes and those it revives."""
    was_active, deleted = F.col(WAS_ACTIVE), F.col(AUDIT_DELETED)
    return {
        "active before": F.count_if(was_active),
        "deleted now": F.count_if(was_active & deleted),
        "revived now": F.count_if(~was_active & ~deleted),
    }


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    run_ts: dt.datetime,
    sk: str,
    newest: int | None = None,
) -> DataFrame:
    """Overwrite matched rows, add new ones with the next surrogate keys, keep all others as is.

    Only the keys that are new are numbered, so a repeat run moves no more than those. ``newest`` is
    the highest surrogate key of the target if known; otherwise the target is scanned for it.
    """
    source = source.select(*keys, *cols)
    if newest is None:
        newest = target.agg(F.coalesce(F.max(sk), F.lit(0))).first()[0]
    new_keys = source.select(*keys).join(target.select(*keys), on=list(keys), how="left_anti")
    numbered = assign_surrogate_keys(new_keys, keys, newest, sk)
    rows = _outer_join(
        target,
        source.join(numbered, on=list(keys), how="left"),
        keys,
        cols,
        [sk, AUDIT_CREATED, AUDIT_UPDATED],
    )
    run = timestamp_literal(run_ts)
    in_source = F.col(_IN_SOURCE).isNotNull()
    return rows.select(
        F.coalesce(_old(sk), F.col(sk)).alias(sk),
        *keys,
        *[F.when(in_source, F.col(c)).otherwise(_old(c)).alias(c) for c in cols],
        F.coalesce(_old(AUDIT_CREATED), run).alias(AUDIT_CREATED),
        F.when(in_source, run).otherwise(_old(AUDIT_UPDATED)).alias(AUDIT_UPDATED),
    )


def insert_absent(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows as they are, plus source rows whose key the target lacks."""
    return target.unionByName(source.join(target.select(*keys), on=list(keys), how="left_anti"))


def latest_per_key(rows: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key, the greatest by ``order_by`` and then by the remaining columns.

    An opt-in for sources that repeat keys. It is an aggregate, not a window: partial results are
    combined before the shuffle, so a key with very many copies does not end up in one task.
    """
    rest = [c for c in rows.columns if c not in keys]
    order = [*order_by, *[c for c in rest if c not in order_by]]
    winner = F.max_by(F.struct(*rest), F.struct(*order)).alias("__winner")
    return rows.groupBy(*keys).agg(winner).select(*keys, "__winner.*").select(*rows.columns)
