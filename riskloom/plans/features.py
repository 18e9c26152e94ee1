"""From raw transactions and identities to the feature table."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.behaviour import ALL_PARTS, DEVICE, PLACE, FeatureSpec, amount_ratio, behaviour
from riskloom.operators.columns import USER_KEYS, hyphens_to_underscores, user_keys
from riskloom.operators.joins import join_identity
from riskloom.session import written

# Tables with more columns than this are not carried through the windows.
CARRIED_COLUMNS = 40


def build_features(transactions: DataFrame, identity: DataFrame | None = None, keys: Sequence[str] = ("uid1",),
                   spec: FeatureSpec = FeatureSpec(), parts: Iterable[str] = ALL_PARTS,
                   carried: int = CARRIED_COLUMNS) -> DataFrame:
    """The feature table of one dataset; train and test are built separately.

    A small table travels through the windows: one shuffle by user. A wide one
    does not: the windows run on the few columns they need, and their results,
    the raw columns and the identities meet on the id, so that the wide rows are
    shuffled and sorted once (not at all when stored bucketed by id). If ids are
    missing or repeat, which is counted first, the wide rows are written once
    with a row number to meet on instead.

    Every path keeps every row: rows without an id or with a repeated one are
    rows like others, rows without a time have NULL features and are part of no
    history, and an identity that repeats gives a row for each.
    """
    parts = tuple(parts)
    side = hyphens_to_underscores(identity) if identity is not None else None
    names = [*transactions.columns, *([c for c in side.columns if c != spec.id] if side is not None else [])]
    derived = [c for c in spec.feature_names(parts) if c != "geo_change_dt"]
    if f"std_amt_per_{spec.key}" in derived:
        derived.insert(derived.index(f"std_amt_per_{spec.key}") + 1, "amt_vs_avg_ratio")
    head = [spec.id, spec.time, spec.amount, *spec.device, *keys]
    rest = [c for c in names if c not in head]

    needed = {spec.id, spec.time, spec.amount, *(c for k in keys for c in USER_KEYS[k]),
              *(spec.device if DEVICE in parts else ()), *([spec.place] if PLACE in parts else [])}
    wide = len(names) > carried
    chosen = needed if wide else set(names)
    meet = spec.id
    if wide and not (_unique(transactions, spec.id) and (side is None or _unique(side, spec.id))):
        raw = transactions if side is None else join_identity(transactions, side, spec.id)
        transactions, side, meet = written(raw.withColumn("_meet", F.monotonically_increasing_id()), "wide_rows"), None, "_meet"
        chosen = {*needed, "_meet"}
    rows = transactions.select(*[c for c in transactions.columns if c in chosen])
    if side is not None:
        from_side = [c for c in side.columns if c in chosen and c != spec.id]
        rows = join_identity(rows, side.select(spec.id, *from_side), spec.id) if from_side else rows
    rows = user_keys(rows, keys)

    # Users are counted before the join when their key does not depend on it.
    own_key = set(USER_KEYS[spec.key]) <= set(transactions.columns)
    counted = user_keys(transactions, [spec.key]).select(spec.key) if own_key else None
    full = behaviour(rows, spec, parts, counted)
    if "amt_vs_avg_ratio" in derived:
        full = amount_ratio(full, spec)
    if not wide:
        return full.select(*head, *derived, *rest)
    raw = transactions if side is None else join_identity(transactions, side, spec.id)
    return raw.join(full.select(meet, *keys, *derived), meet).select(*head, *derived, *rest)


def _unique(df: DataFrame, name: str) -> bool:
    """Whether the column has no NULL and no value twice; one shuffle of that column."""
    return df.groupBy(name).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | F.col(name).isNull()).isEmpty()
