from textloom.functions.arrays import (
    attention_mask,
    clm_labels,
    label_of,
    pad_right,
    softmax,
    top1,
    truncate,
)
from textloom.functions.text import (
    collapse_newlines,
    decode_all_entities,
    decode_entities,
    hrefs,
    html_to_text,
    record_filename,
    remove_label,
    replace_extension,
    safe_title,
    sanitize_filename,
    snippet,
    strip_ws,
    url_host,
    url_join,
    url_slug,
    url_without_tail,
    word_count,
    words,
)
