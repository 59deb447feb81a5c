"""Exchange kline payloads -> typed bars -> 19-column raw records.

A payload is the exchange's JSON reply: an array of positional arrays whose
numbers arrive as strings (``[open_time, "open", "high", ...]``). Parsing is
``from_json`` + ``explode`` + ``try_cast`` per position -- JVM-side, no UDF.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.functions import from_epoch_ms, lit_ts
from candlewick.schema import KLINE_ARRAY_FIELDS, KLINE_MIN_FIELDS, RAW_COLUMNS


def parse_klines(
    df: DataFrame, payload_col: str = "payload", keep: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Explode payload strings into typed kline rows.

    Returns ``(rows, rejects)``. A row with fewer than 11 elements, or with an
    element that does not convert, is rejected with a reason; elements past
    the 11th are ignored. A payload that is not a JSON array of arrays gives
    one reject row. ``keep`` columns (default: all but the payload) are
    carried to every row.
    """
    keep = [c for c in df.columns if c != payload_col] if keep is None else keep
    parsed = df.select(
        *keep, F.from_json(F.col(payload_col), "array<array<string>>").alias("_rows"), F.col(payload_col)
    )
    bad_payload = parsed.filter(F.col("_rows").isNull()).select(
        *keep,
        F.lit(None).cast("long").alias("row_index"),
        F.lit("payload is not a JSON array of arrays").alias("reason"),
    )
    exploded = parsed.filter(F.col("_rows").isNotNull()).select(
        *keep, F.posexplode("_rows").alias("row_index", "_r")
    ).withColumn("row_index", F.col("row_index").cast("long"))
    typed = exploded.select(
        *keep,
        "row_index",
        F.size("_r").alias("_n"),
        # numbers arrive as strings or JSON numbers (read as their text);
        # try_cast gives NULL for anything that does not convert
        *[F.get(F.col("_r"), i).try_cast(t).alias(name) for i, (name, t) in enumerate(KLINE_ARRAY_FIELDS)],
    )
    missing = F.array_compact(
        F.array(
            F.when(F.col("_n") < KLINE_MIN_FIELDS, F.concat(F.lit("row has "), F.col("_n").cast("string"), F.lit(" fields, 11 are needed"))),
            *[
                F.when((F.col("_n") >= KLINE_MIN_FIELDS) & F.col(name).isNull(), F.lit(f"{name} is not a number"))
                for name, _ in KLINE_ARRAY_FIELDS
            ],
        )
    )
    typed = typed.withColumn("_why", missing)
    rows = typed.filter(F.size("_why") == 0).drop("_n", "_why")
    rejects = typed.filter(F.size("_why") > 0).select(*keep, "row_index", F.col("_why")[0].alias("reason"))
    return rows, rejects.unionByName(bad_payload)


def enrich_raw(
    rows: DataFrame,
    source: str | None = None,
    dataset: str | None = None,
    symbol: str | None = None,
    interval: str | None = None,
    loaded_at: dt.datetime | None = None,
    batch_id: str | None = None,
) -> DataFrame:
    """Typed kline rows -> 19-column raw records.

    ``source``/``dataset``/``symbol``/``interval`` given as arguments override
    columns of the same name (which landed payloads carry from their path).
    ``loaded_at`` defaults to now (UTC) and ``batch_id`` to one uuid drawn on
    the driver, so every row of one write shares them.
    """
    loaded = lit_ts(loaded_at) if loaded_at is not None else F.current_timestamp()
    batch = batch_id or str(uuid.uuid4())
    consts = {"source": source, "dataset": dataset, "symbol": symbol, "interval": interval}
    out = rows.withColumns({k: F.lit(v) for k, v in consts.items() if v is not None})
    return out.withColumns(
        {
            "open_time_utc": from_epoch_ms("open_time_ms"),
            "close_time_utc": from_epoch_ms("close_time_ms"),
            "loaded_at": loaded,
            "batch_id": F.lit(batch),
        }
    ).select(*RAW_COLUMNS)
