"""Readers: warehouse tables, raw message feeds, lookups and broker sources."""

from .tables import read_table
from .fixtures import noisy_transaction_feed, sales_events, transaction_feed

__all__ = ["read_table", "sales_events", "transaction_feed", "noisy_transaction_feed"]
