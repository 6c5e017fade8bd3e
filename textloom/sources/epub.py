"""E-book files to rows.  One task reads one file at a time."""

from __future__ import annotations

import codecs
import io
import posixpath
import re
import zipfile
from collections.abc import Iterator
from urllib.parse import unquote
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from textloom.functions.text import html_to_text

ITEMS = "path string, item_idx int, html string, error string"


def epub_documents(blob: bytes) -> list[str]:
    """HTML members in the order of the package manifest."""
    with zipfile.ZipFile(io.BytesIO(blob)) as z:
        box = ElementTree.fromstring(z.read("META-INF/container.xml"))
        package = next(e.attrib["full-path"] for e in box.iter() if e.tag.endswith("rootfile"))
        folder = posixpath.dirname(package)
        listed = [
            posixpath.normpath(posixpath.join(folder, unquote(e.attrib["href"])))
            for e in ElementTree.fromstring(z.read(package)).iter()
            if e.tag.endswith("}item") and "html" in e.attrib.get("media-type", "")
        ]
        return [re.sub(r"^\s*<\?xml.*?\?>", "", _decoded(z.read(n))) for n in listed]  # a missing member is an error


def _decoded(raw: bytes) -> str:
    """By byte-order mark, else by the declared encoding, else UTF-8; never guessed."""
    for mark, name in ((codecs.BOM_UTF8, "utf-8-sig"), (codecs.BOM_UTF16_LE, "utf-16"), (codecs.BOM_UTF16_BE, "utf-16")):
        if raw.startswith(mark):
            return raw.decode(name)
    declared = re.match(rb"""\s*<\?xml[^>]*?encoding\s*=\s*["']([A-Za-z0-9._-]+)["']""", raw)
    return raw.decode(declared[1].decode("ascii") if declared else "utf-8")


def _unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, blob in zip(batch["path"], batch["content"]):
            try:
                items = [(path, i, h, None) for i, h in enumerate(epub_documents(blob))]
            except Exception as e:  # a bad file becomes a row, it never stops the job
                items = [(path, None, None, f"{type(e).__name__}: {e}")]
            yield pd.DataFrame(items, columns=["path", "item_idx", "html", "error"]).astype({"item_idx": "Int32"})


def epub_items(spark: SparkSession, path: str) -> DataFrame:
    """``(path, item_idx, html, error)``: a file's HTML items, or one error row."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.epub").load(path)
        .select("path", "content")
    )
    return files.mapInPandas(_unpack, ITEMS)


def epub_item_texts(items: DataFrame) -> DataFrame:
    """Items with their visible text."""
    return items.withColumn("text", html_to_text("html"))
