"""Command line: the runs an hourly schedule triggers.

    python -m candlewick ingest  LANDING_DIR DATASET RAW_ROOT [lines] [quarantine]
    python -m candlewick build   RAW_ROOT OUT_DIR
    python -m candlewick refresh RAW_ROOT OUT_DIR SINCE
    python -m candlewick check   OUT_DIR SYMBOL [SYMBOL ...]

``ingest`` appends new landed records (first write wins) through a
``availableNow`` stream, from files of one JSON array each, or of JSON lines
with ``lines``; a bad record fails the run, or with ``quarantine`` goes to a
table beside the raw one; ``build`` writes every model layer; ``refresh``
replaces the days from SINCE's on in every table that has days, and merges the
symbol tables from partials (SINCE: the day of the earliest record that came
since the last run); ``check`` runs the 28 column tests on the written tables and prints the failing ones.
The Spark master and settings come from ``spark-submit`` / the environment.
"""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from candlewick.operators import ingest, quality
from candlewick.plans import incremental, materialize, publish
from candlewick.plans.models import Raw
from candlewick.session import pin_conf
from candlewick.streaming.ingest import start_landing_ingest


def _raw(spark: SparkSession, root: str) -> Raw:
    return Raw(
        klines=ingest.read_raw_table(spark, root, "klines"),
        trades=ingest.read_raw_table(spark, root, "trades"),
        tickers=ingest.read_raw_table(spark, root, "tickers"),
    )


def main(argv: list[str]) -> int:
    if not argv or argv[0] not in ("ingest", "build", "refresh", "check"):
        print(__doc__)
        return 2
    spark = pin_conf(SparkSession.builder.appName("candlewick").getOrCreate())
    cmd, args = argv[0], argv[1:]
    if cmd == "ingest":
        landing, dataset, root, *said = args
        on_bad = "quarantine" if "quarantine" in said else "fail"
        start_landing_ingest(spark, landing, dataset, root, multiline="lines" not in said, on_bad=on_bad).awaitTermination()
    elif cmd == "build":
        root, out = args
        for name, path in materialize.build(spark, _raw(spark, root), out).items():
            print(f"{name}\t{path}")
    elif cmd == "refresh":
        root, out, since = args
        fresh = (*incremental.CANDLE_TABLES, *incremental.TRADE_TABLES)
        paths = {n: f"{out.rstrip('/')}/{n}" for n in fresh}
        publish.recover(spark, out)
        incremental.refresh(spark, root, paths, since)
        incremental.refresh_trades(spark, root, paths, since)
        materialize.build(spark, _raw(spark, root), out, skip=fresh)
    else:
        out, symbols = args[0], args[1:]
        names = ("stg_klines", "stg_trades", "stg_tickers", "price_metrics", "symbol_volume",
                 "fct_candles", "fct_trades", "dim_symbols", "daily_summary")
        models = {n: spark.read.parquet(f"{out.rstrip('/')}/{n}") for n in names}
        failing = quality.declared_suite(models, symbols).where("failures > 0").collect()
        for r in failing:
            print(f"FAIL {r.model}.{r.column_name} {r.test}: {r.failures}")
        return 1 if failing else 0
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
