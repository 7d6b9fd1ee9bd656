"""Text expressions: trimming, description parsing, name and location helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vaultlens.constants import JS_WHITESPACE, JS_WHITESPACE_CHARS, JSON_FORM, M_FORM, METADATA_FORM, UNDEFINED_PREFIX


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def js_trim(c) -> Column:
    """Trim every kind of whitespace (Spark's ``trim`` removes spaces only)."""
    return F.btrim(_c(c), F.lit(JS_WHITESPACE_CHARS))


def has_text(c) -> Column:
    """Non-null and not blank."""
    return F.coalesce(_c(c).rlike(f"[^{JS_WHITESPACE}]"), F.lit(False))


# Rule for 7-bit decoding: every byte with the high bit set maps to the byte minus 128.
_HIGH = "".join(chr(c) for c in range(128, 256))
_LOW = "".join(chr(c - 128) for c in range(128, 256))


# The parse in steps. Each step uses the one before more than once, or inside conditions, where
# common subexpressions are not shared: `naming.resolve_names` makes every step a column.

def base64_kept(tag_text) -> Column:
    """The characters of a payload that count: those of the base64 alphabet, standard or URL-safe."""
    return F.regexp_replace(F.translate(_c(tag_text), "-_", "+/"), "[^A-Za-z0-9+/]", "")


def base64_text(kept, ascii7: bool = False) -> Column:
    """Decode what :func:`base64_kept` kept to text.

    Total: padding is not needed, a lone last character is dropped, and bytes that are not
    UTF-8 become replacement characters. ``ascii7`` reproduces the migrated code's decoding
    (high bit of every byte cleared, then read as Latin-1), which mangles non-ASCII names; on
    ASCII payloads both agree.
    """
    kept = _c(kept)
    size = F.length(kept) - F.when(F.length(kept) % 4 == 1, 1).otherwise(0)
    raw = F.unbase64(F.rpad(F.left(kept, size), F.ceil(size / 4).cast("int") * 4, F.lit("=")))
    if ascii7:
        return F.translate(F.decode(raw, "ISO-8859-1"), _HIGH, _LOW)
    return F.make_valid_utf8(raw.cast("string"))


def _tag_value(d: Column, tag: str) -> Column:
    # The XML parser trims the text of the tag; the first occurrence wins.
    return F.regexp_extract(d, f"<{tag}>[{JS_WHITESPACE}]*(.*?)[{JS_WHITESPACE}]*</{tag}>", 1)


def xml_payload(desc) -> Column:
    """The base64 payload of an XML description: ``<p>`` within ``<m>..</m>``, else ``<Path>`` within
    ``<ArchiveMetadata>..</ArchiveMetadata>``; NULL for other texts."""
    d = _c(desc)
    return F.when(d.rlike(M_FORM), _tag_value(d, "p")).when(d.rlike(METADATA_FORM), _tag_value(d, "Path"))


def json_documents(desc) -> Column:
    """The documents of a JSON description (possibly JSON-encoded twice), else NULL: a strict parse of
    the whole text (no single quotes; the last duplicate key wins)."""
    d = _c(desc)
    doc = F.when(d.startswith('"'), F.get_json_object(d, "$")).otherwise(d)
    # As the only element of an array, a document must end where the text ends.
    return F.when(d.rlike(JSON_FORM) & doc.rlike("^\\s*\\{[\\s\\S]*\\}\\s*$"),
                  F.from_json(F.concat(F.lit("["), doc, F.lit("]")), "array<struct<Path:string>>", {"allowSingleQuotes": "false"}))


def json_path(documents) -> Column:
    """``Path`` of the one document; several, or a missing or null ``Path``, give NULL, so the caller
    keeps the raw text."""
    return F.when(F.size(_c(documents)) == 1, F.get(_c(documents), 0).getField("Path"))


def parsed_name(desc, payload, decoded, path) -> Column:
    """What a description says: its XML payload, decoded, else its JSON path, else the text itself."""
    return F.when(_c(payload).isNotNull(), _c(decoded)).when(_c(path).isNotNull(), _c(path)).otherwise(_c(desc))


def parse_description(desc, ascii7: bool = False) -> Column:
    """Name recorded in an archive description, or the description itself, as one expression.

    Detection order: XML (:func:`xml_payload`), then a JSON document that has a ``Path`` key.
    Anything that does not parse falls back to the text unchanged.
    """
    payload = xml_payload(desc)
    return parsed_name(desc, payload, base64_text(base64_kept(payload), ascii7), json_path(json_documents(desc)))


def normalise_name(archive_id, desc, ascii7: bool = False) -> Column:
    """trim -> parse -> trim -> empty becomes ``00undefined/<id>`` -> ``\\`` becomes ``/``."""
    parsed = js_trim(F.coalesce(parse_description(js_trim(F.coalesce(_c(desc), F.lit(""))), ascii7), F.lit("")))
    named = F.when(parsed == "", F.concat(F.lit(UNDEFINED_PREFIX), _c(archive_id))).otherwise(parsed)
    return F.translate(named, "\\", "/")


def suffix_name(name, creationdate) -> Column:
    return F.concat(_c(name), F.lit("-"), _c(creationdate))


def split_location(loc) -> dict:
    """``bucket/key...`` -> bucket, key and the file name (part after the last ``/``).

    A location without ``/`` has no bucket (null) and is all key.
    """
    s = _c(loc)
    has_slash = F.instr(s, "/") > 0
    bucket = F.when(has_slash, F.substring_index(s, "/", 1))
    key = F.when(has_slash, F.substr(s, F.instr(s, "/") + 1)).otherwise(s)
    file_name = F.regexp_replace(s, "^.*/", "")
    return {"bucket": bucket, "key": key, "file_name": file_name}


def uri_encode(c) -> Column:
    """Percent-encode like JavaScript ``encodeURIComponent``."""
    e = F.url_encode(_c(c))
    # --- fixed values: characters encodeURIComponent leaves alone or encodes differently
    for a, b in [("+", "%20"), ("%21", "!"), ("%27", "'"), ("%28", "("), ("%29", ")"), ("%7E", "~")]:
        e = F.replace(e, F.lit(a), F.lit(b))
    return e
