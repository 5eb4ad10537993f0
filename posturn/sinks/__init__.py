"""Writers: shared-storage tables, quarantine, envelopes and broker sinks."""

from .tables import materialize, read_output, write_table

__all__ = ["materialize", "read_output", "write_table"]
