"""Sources and sinks: parquet tables, labeled CSV, ``label<TAB>text`` lines,
attribute CSV lines, and CSV result sinks."""

from tallybayes.sources.files import (
    read_attribute_csv,
    read_label_tab_text,
    read_labeled_csv,
    write_results,
)
from tallybayes.sources.tables import read_table, spread

__all__ = ["read_attribute_csv", "read_label_tab_text", "read_labeled_csv", "read_table",
           "spread", "write_results"]
