"""New registry state from classified versions or corrections.

The registry is never updated in place: these operators return the next
registry snapshot, which ``sinks.registry`` writes as a new version (or a
MERGE-capable table consumes). Untouched rows pass through a left join;
AQE picks a broadcast of the change side when its runtime size is small
and splits skewed registry partitions otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.codes import sql_surrogate_id
from ledgerline.operators.diff import DEFAULT_KEYS, INSERT, UPDATE, last_per_key
from ledgerline.schemas import COUNTRY_COL, KEY, REGISTRY_COLUMNS, UPDATED


def _ts(run_ts) -> Column:
    return run_ts if isinstance(run_ts, Column) else F.lit(run_ts).cast("timestamp")


def upsert(registry: DataFrame, classified: DataFrame, order_col: str = "batch_no",
           key_cols=DEFAULT_KEYS, updated=UPDATED, columns=REGISTRY_COLUMNS) -> DataFrame:
    """K1 + K2 + W3: registry after all classified versions are applied.

    Registry rows whose key changed get the UPDATED columns of the key's
    last changed version (every row with that key, duplicates included);
    ``id``, ``logo`` and the country are never updated. Inserted keys get a
    deterministic id (D8), their insert version's other columns and the
    UPDATED columns of their last changed version.
    """
    key_cols = list(key_cols)
    changes = key_changes(classified, order_col, key_cols, updated, columns)
    # Registry keys: every stored row of a changed key takes those values.
    kept = (registry.join(changes.filter("_ins IS NULL").select(*key_cols, "_last"), key_cols, "left")
            .selectExpr(*[(f"CASE WHEN _last IS NOT NULL THEN _last.`{c}` ELSE `{c}` END AS `{c}`"
                           if c in updated else f"`{c}`") for c in columns]))
    return kept.unionByName(_inserted(changes, key_cols, updated, columns))


def change_set(registry: DataFrame, classified: DataFrame, order_col: str = "batch_no",
               key_cols=DEFAULT_KEYS, updated=UPDATED, columns=REGISTRY_COLUMNS) -> DataFrame:
    """K1 + K2 as changes only: the rows to write, ``op`` INSERT or UPDATE, in the registry's columns.

    An update gives one row per stored row of the key (its ``id`` names it); no
    row of an untouched key leaves the join. These rows are the input of a
    MERGE on ``id`` and of ``sinks.store.commit_changes``' rewrite.
    """
    key_cols = list(key_cols)
    changes = key_changes(classified, order_col, key_cols, updated, columns)
    hit = registry.join(changes.filter("_ins IS NULL").select(*key_cols, "_last"), key_cols)
    rows = hit.selectExpr(f"'{UPDATE}' AS op", *[f"_last.`{c}` AS `{c}`" if c in updated else f"`{c}`" for c in columns])
    return rows.unionByName(_inserted(changes, key_cols, updated, columns).withColumn("op", F.lit(INSERT)))


def key_changes(classified: DataFrame, order_col: str, key_cols, updated=UPDATED, columns=REGISTRY_COLUMNS) -> DataFrame:
    """W3 in one aggregate per changed key: ``_last``, the UPDATED columns of the last changed version, and for a
    new key ``_ins``, the insert-only columns of its INSERT version (the first one).

    Versions without a key are left out here, and both readers look at ``_ins``: so they ask for the same shuffled
    aggregate, which Spark computes once.
    """
    upd = ", ".join(f"`{c}`" for c in updated)
    insert_only = [c for c in columns if c not in updated and c not in key_cols and c != "id"]
    ins_cols = ", ".join(f"`{c}`" for c in insert_only) or "1 AS _none"
    changed = classified.filter(f"change_type IN ('{INSERT}', '{UPDATE}')").filter(" AND ".join(f"`{k}` IS NOT NULL" for k in key_cols))
    return (changed.groupBy(*key_cols)
            .agg(F.expr(f"max_by(struct({upd}), `{order_col}`)").alias("_last"),
                 F.expr(f"min_by(struct({ins_cols}), CASE WHEN change_type = '{INSERT}' "
                        f"THEN `{order_col}` END)").alias("_ins")))


def _inserted(changes: DataFrame, key_cols, updated, columns) -> DataFrame:
    new_cols = []
    for c in columns:
        if c == "id":
            new_cols.append(f"{sql_surrogate_id(*[f'`{k}`' for k in key_cols])} AS id")
        elif c in key_cols:
            new_cols.append(f"`{c}`")
        elif c in updated:
            new_cols.append(f"_last.`{c}` AS `{c}`")
        else:
            new_cols.append(f"_ins.`{c}` AS `{c}`")
    return changes.filter("_ins IS NOT NULL").selectExpr(*new_cols)


def apply_status(registry: DataFrame, corrections: DataFrame, run_ts, order_col: str = "pos",
                 key: str = KEY, country: str | None = "COLOMBIA", columns=REGISTRY_COLUMNS) -> DataFrame:
    """K3 + W5: set ``status`` and ``updated_at`` from the last correction per key.

    ``corrections`` has (request_number, status, ``order_col``); rows with a
    blank status are ignored. With ``country`` set, only that country's rows
    are touched (D4); ``None`` touches every row with the key.
    """
    valid = corrections.filter(F.coalesce(F.col("status"), F.lit("")) != "")
    last = last_per_key(valid.select(key, "status", order_col), [key], order_col)
    last = last.select(key, F.col("status").alias("_new_status"))
    if country is not None:
        last = last.withColumn(COUNTRY_COL, F.lit(country))
        cur = registry.join(last, [COUNTRY_COL, key], "left")
    else:
        cur = registry.join(last, [key], "left")
    hit = F.col("_new_status").isNotNull()
    return cur.select(*[
        (F.when(hit, F.col("_new_status")).otherwise(F.col("status")) if c == "status"
         else F.when(hit, _ts(run_ts)).otherwise(F.col("updated_at")) if c == "updated_at"
         else F.col(c)).alias(c)
        for c in columns])
