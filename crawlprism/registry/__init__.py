"""All registered queries."""

from crawlprism.registry import (  # noqa: F401  (imported for registration)
    archive_queries,
    catalog_queries,
    language_queries,
    load_queries,
    model_queries,
    signal_queries,
    text_queries,
)
from crawlprism.registry.base import registry

__all__ = ["registry"]
