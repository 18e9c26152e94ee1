"""Schemas of the transaction, identity, feature and request records."""

from __future__ import annotations

from pyspark.sql import types as T

LONG, DOUBLE, TEXT = T.LongType(), T.DoubleType(), T.StringType()

# Identity columns that hold text; the other id_NN hold doubles.
TEXT_IDENTITY = ("id_12", "id_15", "id_16", "id_23", "id_27", "id_28", "id_29", "id_30", "id_31",
                 "id_33", "id_34", "id_35", "id_36", "id_37", "id_38")
# How many columns each family of doubles or texts has.
COUNTERS, DELAYS, MATCHES, VENDOR, IDENTITY = 14, 15, 9, 339, 38


def _struct(pairs: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in pairs])


def _raw_columns() -> list[tuple[str, T.DataType]]:
    # Names and types of the raw columns after id, label, time and amount.
    leading = [("ProductCD", TEXT), ("card1", LONG), ("card2", DOUBLE), ("card3", DOUBLE), ("card4", TEXT),
               ("card5", DOUBLE), ("card6", TEXT), ("addr1", DOUBLE), ("addr2", DOUBLE), ("dist1", DOUBLE),
               ("dist2", DOUBLE), ("P_emaildomain", TEXT), ("R_emaildomain", TEXT)]
    families = [("C", COUNTERS, DOUBLE), ("D", DELAYS, DOUBLE), ("M", MATCHES, TEXT), ("V", VENDOR, DOUBLE)]
    return leading + [(f"{letter}{i}", kind) for letter, count, kind in families for i in range(1, count + 1)]


def _identity_columns() -> list[tuple[str, T.DataType]]:
    names = [f"id_{i:02d}" for i in range(1, IDENTITY + 1)]
    return [(n, TEXT if n in TEXT_IDENTITY else DOUBLE) for n in names]


def transaction_schema(labelled: bool = True) -> T.StructType:
    head = [("TransactionID", LONG)] + ([("isFraud", LONG)] if labelled else [])
    return _struct(head + [("TransactionDT", LONG), ("TransactionAmt", DOUBLE)] + _raw_columns())


def identity_schema(hyphens: bool = False) -> T.StructType:
    columns = [(n.replace("_", "-") if hyphens else n, kind) for n, kind in _identity_columns()]
    return _struct([("TransactionID", LONG), *columns, ("DeviceType", TEXT), ("DeviceInfo", TEXT)])


def feature_schema(labelled: bool = True, keys: tuple[str, ...] = ("uid1",)) -> T.StructType:
    """The feature table: keys, behaviour, then the raw columns."""
    head = [("TransactionID", LONG), ("TransactionDT", LONG), ("TransactionAmt", DOUBLE), ("DeviceInfo", TEXT),
            ("DeviceType", TEXT), *[(k, TEXT) for k in keys]]
    # Names and types of the behaviour columns.
    derived = [("cnt_5m", LONG), ("cnt_1h", LONG), ("cnt_24h", LONG), ("cnt_7d", LONG), ("time_since_last_tx", LONG),
               ("amt_1h", DOUBLE), ("cnt_per_uid1", LONG), ("avg_amt_per_uid1", DOUBLE), ("std_amt_per_uid1", DOUBLE),
               ("amt_vs_avg_ratio", DOUBLE), ("time_since_last_geo_change", LONG), ("is_new_device_uid1", LONG)]
    label = [("isFraud", LONG)] if labelled else []
    return _struct(head + derived + label + _raw_columns() + _identity_columns())


def request_schema() -> T.StructType:
    """One scoring request: the feature table with every user key, all fields optional."""
    return feature_schema(True, ("uid1", "uid2", "uid3", "uid4"))
