"""String expressions.  All of them stay inside the JVM except where noted."""

from __future__ import annotations

import html
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

# The characters on which an argument-less split breaks a string.  The
# spelling of ``WS`` is valid for Java and for RE2 alike.
WS_LOW = r"\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x20\x85\xa0"
WS_HIGH = r"\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WS_CHARS = WS_LOW + WS_HIGH
WS = f"[{WS_CHARS}]"
# The same for Java only, and twice as fast: one range test rules out most letters.
_SPACE = rf"[{WS_LOW}[\x{{1680}}-\x{{3000}}&&[{WS_HIGH}]]]"

# Fixed value: characters a file name must not hold.
UNSAFE_IN_FILE_NAMES = r'[\\/*?:"<>|]'

# Named character references decoded inside the JVM.  "&amp;" has to
# be decoded last, so that "&amp;lt;" becomes "&lt;" and not "<".
ENTITIES = {
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&apos;": "'",
    "&#39;": "'",
    "&nbsp;": " ",
    "&copy;": "©",
    "&middot;": "·",
    "&hellip;": "…",
    "&ndash;": "–",
    "&mdash;": "—",
    "&amp;": "&",
}

# A quote counts only where it begins an attribute's value.
_IN_TAG = r"(?>=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])"
_TAG = rf"</?[A-Za-z]{_IN_TAG}*+>|<[!?/][^>]*+>"
_HIDDEN = (
    r"(?is)<!--(?:-?>|.*?(?:--!?>|\z))|<(script|style)(?=[\s/>]).*?(?:</\1(?=[\s/>])[^>]*+>|\z)"
)
_HREF = rf"(?i)<a(?=[\s/]){_IN_TAG}*?(?<=[\s\"'/])href\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)"
_CUT = "\u0001"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def words(c: Column | str) -> Column:
    """Words between runs of Unicode white space; never an empty word."""
    return F.array_remove(F.split(_col(c), _SPACE + "+"), "")


def word_count(c: Column | str) -> Column:
    return F.array_size(words(c))


def collapse_newlines(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), "\n+", " ")


def strip_ws(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), f"^{_SPACE}+|{_SPACE}+$", "")


def remove_label(c: Column | str, label: str) -> Column:
    """Take a label such as ``Author:`` out of a text and trim the rest."""
    return strip_ws(F.replace(_col(c), F.lit(label), F.lit("")))


def sanitize_filename(c: Column | str) -> Column:
    return strip_ws(F.regexp_replace(_col(c), UNSAFE_IN_FILE_NAMES, "_"))


def safe_title(c: Column | str) -> Column:
    """Letters, digits, blanks, ``_`` and ``-`` only; blanks become ``_``."""
    kept = F.regexp_replace(_col(c), r"[^\p{L}\p{N} _\-]", "")
    return F.replace(F.rtrim(kept), F.lit(" "), F.lit("_"))


def replace_extension(c: Column | str, extension: str) -> Column:
    """Swap the last extension; names that only start with dots have none."""
    stem = F.regexp_replace(_col(c), r"(?s)^(.*[^./][^/]*)\.[^./]*$", "$1")
    return F.concat(stem, F.lit(extension))


def record_filename(title: Column | str, fmt: Column | str) -> Column:
    """``<sanitised title>.<fmt>``; null when the title is null or empty."""
    t = F.nullif(_col(title), F.lit(""))
    return F.concat(sanitize_filename(t), F.lit("."), F.lit(fmt) if isinstance(fmt, str) else fmt)


def snippet(c: Column | str, width: int = 500) -> Column:
    c = _col(c)
    return F.when(F.char_length(c) > width, F.concat(F.left(c, F.lit(width)), F.lit("..."))).otherwise(c)


# --- URLs -----------------------------------------------------------------------


def url_slug(c: Column | str) -> Column:
    """The last but one part between slashes; null where there is none."""
    return F.try_element_at(F.split(_col(c), "/"), F.lit(-2))


def url_without_tail(c: Column | str) -> Column:
    """A URL up to its query or fragment: the form under which pages are joined."""
    return F.regexp_replace(_col(c), r"(?s)[?#].*$", "")


def url_host(c: Column | str) -> Column:
    return F.regexp_extract(_col(c), r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)


def _without_dot_segments(path: Column) -> Column:
    parts = F.split(F.regexp_replace(path, "^/", ""), "/")
    ends_open = F.element_at(parts, -1).isin(".", "..")

    def step(acc: Column, part: Column) -> Column:
        shorter = F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))
        return (
            F.when(part == "..", shorter)
            .when(part == ".", acc)
            .otherwise(F.concat(acc, F.array(part)))
        )

    kept = F.aggregate(parts, F.array().cast("array<string>"), step)
    return F.concat(F.lit("/"), F.array_join(kept, "/"), F.when(ends_open & (F.size(kept) > 0), F.lit("/")).otherwise(""))


def url_join(base: Column | str, href: Column | str) -> Column:
    """Resolve ``href`` against ``base`` (RFC 3986 reference resolution)."""
    base, href = _col(base), _col(href)
    root = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*:)", 1)
    plain = url_without_tail(base)
    base_path = F.substr(plain, F.char_length(root) + 1)
    folder = F.regexp_replace(base_path, "[^/]*$", "")
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    path = url_without_tail(href)
    tail = F.substr(href, F.char_length(path) + 1)
    merged = F.when(path.startswith("/"), path).otherwise(
        F.regexp_replace(F.concat(folder, path), "/{2,}", "/")
    )
    clean = F.when(merged.rlike(r"(^|/)\.\.?(/|$)"), _without_dot_segments(merged)).otherwise(merged)
    return (
        F.when(href == "", base)
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("?"), F.concat(plain, href))
        .when(href.startswith("#"), F.concat(F.regexp_replace(base, "(?s)#.*$", ""), href))
        .otherwise(F.concat(root, clean, tail))
    )


# --- markup ---------------------------------------------------------------------


def decode_entities(c: Column | str) -> Column:
    out = _col(c)
    for name, char in ENTITIES.items():
        out = F.replace(out, F.lit(name), F.lit(char))
    return out


def _unescape(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Texts without a reference pass through as they are, a batch without any in one step."""
    for texts in parts:
        some = pc.fill_null(pc.match_substring(texts, "&"), False)
        if pc.any(some).as_py():
            decoded = pa.array([html.unescape(t) for t in texts.filter(some).to_pylist()], texts.type)
            texts = pc.replace_with_mask(texts, some, decoded)
        yield texts


def decode_all_entities(c: Column | str) -> Column:
    """Every named and numeric reference, with or without a semicolon, decoded in one Arrow
    function: one node, whatever references there are."""
    return F.arrow_udf(_unescape, "string")(_col(c))


def markup_to_nodes(c: Column | str) -> Column:
    """Markup with every tag, comment, script and style replaced by a cut mark."""
    bare = F.regexp_replace(_col(c), _HIDDEN, _CUT)
    return F.regexp_replace(bare, _TAG, _CUT)


def html_to_text(c: Column | str) -> Column:
    """Visible text: text nodes trimmed, empty ones dropped, joined by one blank.  All
    character references are decoded."""
    nodes = decode_all_entities(markup_to_nodes(c))
    gap = f"(?:{_SPACE}|{_CUT})*"
    return strip_ws(F.regexp_replace(nodes, f"{_SPACE}*{_CUT}{gap}", " "))


def hrefs(c: Column | str) -> Column:
    """All ``href`` values of ``<a>`` tags in document order, quoted or not, references decoded."""
    live = F.regexp_replace(_col(c), _HIDDEN, "")
    found = F.regexp_extract_all(live, F.lit(_HREF), F.lit(1))
    bare = F.transform(found, lambda x: F.regexp_replace(x, "^[\"']|[\"']$", ""))
    decoded = F.split(decode_all_entities(F.array_join(bare, _CUT)), _CUT)
    return F.when(F.size(bare) > 0, decoded).otherwise(bare)
