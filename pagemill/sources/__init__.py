from pagemill.sources.documents import (
    deal_out,
    decode_documents,
    scan_document_stream,
    scan_documents,
    union_sources,
)
from pagemill.sources.index import batch_records, latest_records, read_index, search_index

__all__ = [
    "batch_records",
    "deal_out",
    "decode_documents",
    "latest_records",
    "read_index",
    "scan_document_stream",
    "scan_documents",
    "search_index",
    "union_sources",
]
