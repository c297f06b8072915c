"""Bronze -> silver: one survivor per id, typed id, defaults, label, row hash.

Dedup is an aggregation, not a window: ``max(struct(order..., payload...))``
per id combines map-side, so an id that repeats in a third of all rows
still leaves at most one row per map task for the shuffle.  The struct
orders by arrival time, amount, card1 (all descending) and then by the
carried fields, so the survivor is deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskhouse import schemas as S
from riskhouse.functions import columns as C

SURVIVOR_ORDER = [S.EVENT_TIME, S.AMOUNT, "card1"]


def deduplicate(
    bronze: DataFrame, columns: list[str] | None = None, with_copies: bool = False
) -> DataFrame:
    """One row per TransactionID; ``copies`` counts the input rows.

    The survivor is the greatest (arrival time, amount, card1), then the
    greatest of the carried fields in declared order (exact ties of the first
    three are redeliveries of one message in practice).  ``columns`` limits
    what the scan reads and the shuffle carries: Catalyst cannot prune fields
    inside an aggregate's struct, so the caller names them.
    """
    payload = [c for c in bronze.columns if c != S.ID]
    keep = payload if columns is None else [c for c in payload if c in columns]
    fields = SURVIVOR_ORDER + [c for c in keep if c not in SURVIVOR_ORDER]
    aggs = [F.max(F.struct(*[F.col(c).alias(c) for c in fields])).alias("_s")]
    if with_copies:
        aggs.append(F.count(F.lit(1)).alias("copies"))
    out = bronze.groupBy(S.ID).agg(*aggs)
    cols = [S.ID] + [F.col(f"_s.{c}").alias(c) for c in keep]
    if with_copies:
        cols.append("copies")
    return out.select(*cols)


def typed_id(df: DataFrame) -> DataFrame:
    """Id as INT; values that are not whole ints in range become null."""
    return df.withColumn(S.ID, F.col(S.ID).try_cast("int"))


def fill_defaults(df: DataFrame) -> DataFrame:
    """Text defaults for the three categories, then 0 for every numeric null/NaN."""
    present = {k: v for k, v in S.STRING_DEFAULTS.items() if k in df.columns}
    return df.fillna(present).fillna(0.0)


#: Columns that follow from the others: left out of shuffles and made again where rows are written or read.
DERIVED = ["risk_label", "row_hash"]


def with_label_and_hash(df: DataFrame) -> DataFrame:
    return df.withColumns({"risk_label": C.risk_label(), "row_hash": C.row_hash(*HASHED)})


def split_quarantine(deduped: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with a usable id, rows whose id is missing or out of INT range)."""
    typed = deduped.withColumn("_id", F.col(S.ID).try_cast("int"))
    good = typed.filter(F.col("_id").isNotNull()).withColumn(S.ID, F.col("_id")).drop("_id")
    bad = typed.filter(F.col("_id").isNull()).drop("_id")
    return good, bad


def clean(deduped: DataFrame) -> DataFrame:
    """Deduplicated bronze -> silver columns without label and hash."""
    good, _ = split_quarantine(deduped)
    cols = [c for c in S.SILVER_COLUMNS if c not in ("risk_label", "row_hash") and c in deduped.columns]
    return fill_defaults(good).select(*cols)


HASHED = [S.ID, S.AMOUNT, "TransactionDT"]


_PAYLOAD = [f for f in S.BRONZE_SCHEMA.fields if f.name != S.ID]


def survivors_of(deduped: DataFrame) -> DataFrame:
    """Silver rows with what their fills hide: the id as delivered, and bits for
    the fields that were null (even) or NaN (odd), so later copies can be compared."""
    bits = F.lit(0).cast("long")
    for k, f in enumerate(_PAYLOAD):
        bits = bits + F.when(F.col(f.name).isNull(), F.lit(1 << 2 * k)).otherwise(0)
        if f.dataType == S.D:
            bits = bits + F.when(F.isnan(f.name), F.lit(2 << 2 * k)).otherwise(0)
    good, _ = split_quarantine(deduped.withColumns({"raw_id": F.col(S.ID), "nulls": bits}))
    return with_label_and_hash(fill_defaults(good)).select(*S.SILVER_COLUMNS, "raw_id", "nulls")


#: What ``raw_order`` reads.
ORDERED_BY = [*[f.name for f in _PAYLOAD], "nulls"]


def raw_order(prefix: str = ""):
    """The order of ``deduplicate`` over a survivor's fields (columns of that prefix) as they were delivered."""
    raw = {}
    for k, f in enumerate(_PAYLOAD):
        was = F.col(prefix + "nulls").bitwiseAND(F.lit(3 << 2 * k))
        kept = F.when(was == 0, F.col(prefix + f.name))
        raw[f.name] = kept.when(was == 2 << 2 * k, F.lit(float("nan"))) if f.dataType == S.D else kept
    fields = SURVIVOR_ORDER + [f.name for f in _PAYLOAD if f.name not in SURVIVOR_ORDER]
    return F.struct(*[raw[c].alias(c) for c in fields])


def to_silver(bronze: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The whole bronze -> silver transformation, in declared column order.

    ``columns``: the silver columns a consumer needs (default: all); the
    dedup then carries only their inputs through its shuffle.
    """
    if columns is None:
        want = list(S.SILVER_COLUMNS)
    else:
        want = [c for c in S.SILVER_COLUMNS if c in columns or c == S.ID]
    need = set(want) - {"risk_label", "row_hash"}
    if "risk_label" in want:
        need.add(S.LABEL)
    if "row_hash" in want:
        need.update(HASHED)
    c = clean(deduplicate(bronze, sorted(need)))
    extra = {}
    if "risk_label" in want:
        extra["risk_label"] = C.risk_label()
    if "row_hash" in want:
        extra["row_hash"] = C.row_hash(*HASHED)
    return c.withColumns(extra).select(*want) if extra else c.select(*want)


def quarantine(bronze: DataFrame) -> DataFrame:
    """Every row that cannot enter silver (no usable id), before any dedup."""
    _, bad = split_quarantine(bronze)
    return bad


def quality_counts(bronze: DataFrame) -> DataFrame:
    """bronze_rows, silver_rows, fraud_rows, legit_rows, quarantined_rows (messages) in one pass."""
    d = deduplicate(bronze, [S.LABEL], with_copies=True).withColumn("_id", F.col(S.ID).try_cast("int"))
    ok = F.col("_id").isNotNull()
    return d.agg(
        F.sum("copies").cast("long").alias("bronze_rows"),
        F.count_if(ok).alias("silver_rows"),
        F.count_if(ok & C.is_fraud()).alias("fraud_rows"),
        F.count_if(ok & ~F.coalesce(C.is_fraud(), F.lit(False))).alias("legit_rows"),
        F.coalesce(F.sum(F.when(~ok, F.col("copies"))), F.lit(0)).cast("long").alias("quarantined_rows"),
    )
