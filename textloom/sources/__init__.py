from textloom.sources.epub import epub_item_texts, epub_items
from textloom.sources.expand import epub_rows, expand_rows, page_node_rows, table_function
from textloom.sources.readers import (
    BOOK_SCHEMA,
    list_files,
    read_metadata_json,
    read_sentences,
    read_split,
    read_table,
    rename_text,
)
from textloom.sources.stored import file_rows, range_scan_stored, with_stored_index, write_in_order, zip_stored
from textloom.sources.versions import Version, publish_version, published_versions, read_version
from textloom.sources.writers import (
    book_texts,
    publish,
    split_off,
    write_book_texts,
    write_metadata,
    write_table,
)
