"""Scans and sinks: bar files, broker-style bars, instrument configs, ledgers."""

from sessionbars.sources.bars import (
    assemble_ts, bars_from_epoch, last_n_bars, normalise_bars, read_bars_csv, read_bars_parquet,
    resample_bars, write_bars_csv, write_bars_parquet,
)
from sessionbars.sources.instruments import DEFAULT_CONFIG, load_instruments, write_instruments
from sessionbars.sources.sinks import read_ledger, write_ledger

__all__ = [
    "assemble_ts", "bars_from_epoch", "last_n_bars", "normalise_bars", "read_bars_csv",
    "resample_bars", "write_bars_csv", "read_bars_parquet", "write_bars_parquet", "DEFAULT_CONFIG", "load_instruments", "write_instruments",
    "read_ledger", "write_ledger",
]
