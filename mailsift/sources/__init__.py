"""Sources: message tables, files and archives (S1), latest-N (S2), driver-table stand-ins."""

from mailsift.sources.archives import read_archive, stream_archive, write_archive
from mailsift.sources.messages import latest_n, read_messages
from mailsift.sources.tables import load_table

__all__ = ["latest_n", "load_table", "read_archive", "read_messages", "stream_archive",
           "write_archive"]
