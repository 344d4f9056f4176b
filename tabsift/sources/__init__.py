"""Sources and sinks: delimited text, fitted models, driver tables and derived fixtures."""

from tabsift.operators.model import load_model, save_model
from tabsift.sources.delimited import read_delimited, verify_roundtrip, write_delimited
from tabsift.sources.fixtures import load_table

__all__ = ["load_model", "load_table", "read_delimited", "save_model", "verify_roundtrip", "write_delimited"]
