from pagemill.sinks.archive import archive, read_archive
from pagemill.sinks.index import compact_index, replaced_folders, upsert_index
from pagemill.sinks.removal import remove_sources
from pagemill.sinks.texts import write_part_files, write_text_files, write_texts

__all__ = [
    "archive",
    "compact_index",
    "read_archive",
    "remove_sources",
    "replaced_folders",
    "upsert_index",
    "write_part_files",
    "write_text_files",
    "write_texts",
]
