"""pagemill: documents to searchable tables on Spark DataFrames."""

from pagemill.operators.classify import (
    attach_classification,
    classify_parts,
    classify_rules,
    classify_udf,
    pipe_classify,
    pipe_classify_lines,
)
from pagemill.operators.extract import (
    complete_documents,
    document_page_counts,
    extract_pages,
    failed_pages,
    recognize_rasters,
    recognize_words,
    render_rasters,
    segment_regions,
)
from pagemill.operators.filters import (
    contains_text,
    document_count,
    drop_blank,
    filter_extension,
    first_documents,
    indexed_only,
)
from pagemill.operators.layout import extract_regions, extract_words, words_in_rect
from pagemill.operators.pages import (
    assemble_document,
    assemble_paged,
    assemble_parts,
    concat_pages,
    count_pages,
    extract_html_pages,
    extract_text_pages,
    number_pages,
    page_footer,
    plan_page_batches,
    render_hocr,
    sort_pages,
)
from pagemill.operators.raster import (
    apply_mask,
    binarize_inv,
    bounding_box,
    clean_image,
    clean_mask,
    crop,
    dilate,
    dilate_mask,
    erode,
    erode_mask,
    half_size,
    nonzero,
    sparse_images,
    to_gray,
    to_lines,
    to_pixels,
)
from pagemill.operators.records import flatten_text, index_record, output_name, preview, strip_scheme
from pagemill.operators.shapes import deskew, raster_regions, skew, turn
from pagemill.plans.ingest import IngestResult, index_texts, ingest, ingest_pages
from pagemill.sinks import (
    archive,
    compact_index,
    read_archive,
    remove_sources,
    replaced_folders,
    upsert_index,
    write_part_files,
    write_text_files,
    write_texts,
)
from pagemill.sources import (
    batch_records,
    decode_documents,
    latest_records,
    read_index,
    scan_document_stream,
    scan_documents,
    search_index,
    union_sources,
)
from pagemill.streaming.ingest import failed_documents, ingest_stream, remove_ingested

__all__ = [name for name in dir() if not name.startswith("_")]
