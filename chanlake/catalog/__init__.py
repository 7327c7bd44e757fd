"""Named queries over the given tables, with the SQL each must equal."""

from __future__ import annotations

from chanlake.catalog import channels, graph, identities, messages, observations, tables, texts
from chanlake.catalog.base import Entry

ENTRIES: dict[str, Entry] = {
    **messages.ENTRIES,
    **identities.ENTRIES,
    **channels.ENTRIES,
    **graph.ENTRIES,
    **texts.ENTRIES,
    **tables.ENTRIES,
    **observations.ENTRIES,
}
