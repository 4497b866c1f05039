"""Scans and sinks."""

from txrisk.sources.events import (  # noqa: F401
    events_to_transactions,
    load_transactions,
    type_source_predicate,
)
from txrisk.sources.files import (  # noqa: F401
    load_model,
    read_csv,
    read_table,
    read_tx,
    save_model,
    write_predictions,
    write_table,
    write_tx,
)
