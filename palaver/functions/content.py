"""Message content that is either plain text or a list of typed parts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

PART_TYPE = ("struct<type:string,text:string,"
             "file:struct<url:string,mime_type:string>,image_url:struct<url:string>>")
MESSAGE_TYPE = "struct<role:string,content:string>"


def is_json(text: Column) -> Column:
    """True for one whole JSON value; NULL counts as none.

    The text is put into a list before a 0.  The length function reads the whole
    list, so the list has two entries only if the text is just one value.
    """
    listed = F.json_array_length(F.concat(F.lit("["), text, F.lit(",0]")))
    return F.coalesce(listed == 2, F.lit(False))


def json_list_length(text: Column) -> Column:
    """Entries of a JSON list; NULL for anything else."""
    return F.when(is_json(text), F.json_array_length(text))


def parse_messages(json: Column) -> Column:
    """JSON text of a message list; part lists stay JSON text in ``content``.

    NULL when the text is not a JSON list.
    """
    return F.when(json_list_length(json).isNotNull(),
                  F.from_json(json, f"array<{MESSAGE_TYPE}>"))


def content_parts(content: Column) -> Column:
    """Typed parts when the content is a part list, else NULL.

    Content counts as a part list only if it begins with ``[``, is valid JSON
    and its first element has a known part type, so plain text that merely
    starts with a bracket survives.
    """
    looks = F.rlike(content, F.lit(r"^\s*\[")) & json_list_length(content).isNotNull()
    parts = F.from_json(F.when(looks, content), f"array<{PART_TYPE}>")
    first = F.try_element_at(parts, F.lit(1))
    return F.when(first.getField("type").isin("text", "file", "image_url"), parts)


def text_parts(parts: Column) -> Column:
    return F.transform(F.filter(parts, lambda p: p["type"] == "text"),
                       lambda p: F.coalesce(p["text"], F.lit("")))


def part_chars(content: Column) -> Column:
    """Characters of the text in a message, media references not counted."""
    parts = content_parts(content)
    return F.when(parts.isNotNull(),
                  F.aggregate(text_parts(parts), F.lit(0).cast("bigint"),
                              lambda total, t: total + F.length(t))
                  ).otherwise(F.length(content).cast("bigint"))


def flatten_content(content: Column) -> Column:
    """One text per message: text parts, then the first file and image marker."""
    parts = content_parts(content)
    return F.when(parts.isNotNull(), flatten_parts(parts)).otherwise(content)


def flatten_parts(parts: Column) -> Column:
    body = F.array_join(text_parts(parts), " ")

    def marker(kind: str, field: str, label: str) -> Column:
        urls = F.filter(parts, lambda p: p["type"] == kind)
        url = F.try_element_at(urls, F.lit(1))[field]["url"]
        return F.when(F.size(urls) > 0,
                      F.concat(F.lit(f"\n\n[{label}: "), url, F.lit("]"))).otherwise(F.lit(""))

    return F.concat(body, marker("file", "file", "PDF"),
                    marker("image_url", "image_url", "Image"))


def inline_content(content: Column) -> Column:
    """Mixture form: markers stay where they occur, the result is trimmed."""
    parts = content_parts(content)
    return F.when(parts.isNotNull(), inline_parts(parts)).otherwise(content)


def inline_parts(parts: Column) -> Column:
    def marker(label: str, url: Column) -> Column:
        return F.concat(F.lit(f"[{label}: "), F.coalesce(url, F.lit("unknown")), F.lit("] "))

    pieces = F.transform(parts, lambda p: F.when(
        p["type"] == "text", F.coalesce(p["text"], F.lit("")))
        .when(p["type"] == "file", marker("FILE", p["file"]["url"]))
        .when(p["type"] == "image_url", marker("IMAGE", p["image_url"]["url"]))
        .otherwise(F.lit("")))
    return F.regexp_replace(F.array_join(pieces, ""), r"^\s+|\s+$", "")


def media_content(text: Column, kind: str, url: Column,
                  mime_type: str = "application/pdf") -> Column:
    """JSON part list of a first user message with one file or image."""
    if kind == "file":
        media = F.struct(F.lit("file").alias("type"),
                         F.struct(url.alias("url"), F.lit(mime_type).alias("mime_type"))
                         .alias("file"))
    elif kind == "image_url":
        media = F.struct(F.lit("image_url").alias("type"),
                         F.struct(url.alias("url")).alias("image_url"))
    else:
        raise ValueError(f"unknown media kind {kind!r}")
    body = F.to_json(F.struct(F.lit("text").alias("type"), text.alias("text")))
    return F.concat(F.lit("["), body, F.lit(","), F.to_json(media), F.lit("]"))
