"""Names, stems and normalised keys as Column expressions."""

from __future__ import annotations

import html
import mimetypes
import re
import unicodedata
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

# Media extensions that may be nested in a stem, and families.
MEDIA_EXTENSIONS = ("tif", "tiff", "jp2", "jpg", "jpeg", "png")
ALL_MEDIA_EXTENSIONS = ("tif", "tiff", "jp2", "jpg", "jpeg", "png", "pdf", "wav", "flac", "mp3", "mov", "mp4", "wmv")
FAMILIES = {
    "image": (".tif", ".tiff", ".jp2", ".png", ".jpg", ".jpeg"),
    "audio": (".wav", ".flac", ".mp3"),
    "video": (".mov", ".mp4", ".wmv"),
    "pdf": (".pdf",),
}
AUDIO_VARIANT = r"(?i)_(\d+kHz\d+B|TI)$"
AUDIO_VARIANT_ORDER = ("96kHz24B", "44kHz24B", "TI")
#: Extension without its dot to media type, as Python's own table has them; the types of a collection's masters come first.
MIME_TYPES = {"tif": "image/tiff", "jp2": "image/jp2", "jpg": "image/jpeg", "wav": "audio/x-wav", "flac": "audio/flac", "wmv": "video/x-ms-wmv", "xml": "application/xml"} | {
    k.lstrip("."): v for k, v in sorted(mimetypes.MimeTypes().types_map[True].items()) if k not in (".wav", ".jp2", ".flac", ".wmv", ".xml")
}
JUNK_ENDINGS = (".db", "lnk")


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def dirname(path: Column) -> Column:
    """All before the last slash, without trailing slashes (unless it is all slashes)."""
    head = F.left(path, F.length(path) - F.length(basename(path)))
    bare = F.rtrim(head, F.lit("/"))
    return F.when(bare == "", head).otherwise(bare)


def stem(name: Column) -> Column:
    """Name without its extension; leading dots are no extension."""
    before = F.left(name, F.length(name) - F.instr(F.reverse(name), "."))
    dotted = F.contains(name, F.lit(".")) & (F.ltrim(before, F.lit(".")) != "")
    return F.when(dotted, before).otherwise(name)


def splitext_extension(name: Column) -> Column:
    return F.substring(name, F.length(stem(name)) + 1, F.lit(1 << 20))


def last_extension(name: Column) -> Column:
    """From the last dot on, whatever stands before; null without a dot."""
    return F.nullif(F.regexp_extract(name, r".*(\..*)$", 1), F.lit(""))


def mime_type(name: Column) -> Column:
    """By the last extension; a compression suffix is peeled off first.  Null if unknown."""
    inner = F.regexp_replace(name, r"(?i)\.(gz|bz2|xz|br)$", "")
    ext = F.lower(F.regexp_extract(inner, r"\.([^./]*)$", 1))
    table = F.create_map(*(F.lit(x) for kv in MIME_TYPES.items() for x in kv))
    return F.try_element_at(table, ext)


def extension_of_mime(mime: Column) -> Column:
    """The first extension listed for a type."""
    first: dict[str, str] = {}
    for ext, kind in MIME_TYPES.items():
        first.setdefault(kind, "." + ext)
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in first.items() for x in kv)), mime)


def file_type(mime: Column, extension: Column) -> Column:
    """Class of a file; what no rule names is ``autre``.

    Sequential overwriting, where each rule reads what the last one left, comes to this:
    the three extensions exclude each other and beat every type.
    """
    return (
        F.when(extension == ".MTS", "video")
        .when(extension == ".alto", "ocr xml")
        .when(extension == ".jp2", "jpeg2000")
        .when(mime == "image/jpeg", "jpeg")
        .when(mime == "image/tiff", "tiff")
        .when(mime == "text/plain", "ocr txt")
        .when(mime == "application/pdf", "pdf")
        .when(mime == "application/xml", "ocr xml")
        .when(F.left(mime, F.lit(4)) == "vide", "video")
        .when(F.left(mime, F.lit(4)) == "audi", "audio")
        .otherwise("autre")
    )


def strip_media(name_stem: Column, extensions: Sequence[str] = MEDIA_EXTENSIONS, repeated: bool = False) -> Column:
    """Without one media extension, or all of them from the end."""
    any_of = "|".join(extensions)
    return F.regexp_replace(name_stem, rf"(?i)(\.({any_of}))+$" if repeated else rf"(?i)\.({any_of})$", "")


def normalise(key: Column) -> Column:
    return F.translate(F.lower(key), "-", "_")


def unpad(key: Column) -> Column:
    """Without the leading zeros of each number."""
    return F.regexp_replace(key, r"(^|[^0-9])0+([0-9])", "$1$2")


def radical(name: Column) -> Column:
    return normalise(strip_media(stem(name), repeated=True))


def renamed(key: Column, before: str, after: str) -> Column:
    """A collection's prefix as it was renamed on transfer; plus signs became underscores."""
    return F.replace(F.replace(key, F.lit(before), F.lit(after)), F.lit("+"), F.lit("_"))


def strip_audio_variant(key: Column) -> Column:
    return F.regexp_replace(key, AUDIO_VARIANT, "")


def exact_keys(href: Column, before: str, after: str) -> Column:
    """Keys a link may be known by: its stem, renamed, each without the audio variant."""
    s = stem(basename(href))
    r = renamed(s, before, after)
    return F.array_distinct(F.array(s, r, strip_audio_variant(s), strip_audio_variant(r)))


def shelfmark(x: Column) -> Column:
    return F.trim(F.regexp_replace(F.replace(x, F.lit("_"), F.lit(" ")), r"\s+", " "))


def shelfmark_of_source(source: Column) -> Column:
    return F.regexp_replace(source, r".*,\s", "")


def record_id(identifier: Column, prefix: str, replacement: str) -> Column:
    return F.replace(identifier, F.lit(prefix), F.lit(replacement))


def media_family(extension: Column) -> Column:
    low = F.lower(extension)
    return F.coalesce(*(F.when(low.isin(list(e)), F.lit(k)) for k, e in FAMILIES.items()))


def role_family(role: Column) -> Column:
    return F.get(F.split(role, ":"), F.lit(1))


def collection_root(href: Column, prefix: str = "", corrections: dict[str, str] | None = None, unknown: str = "INCONNU") -> Column:
    """First two parts of a file name, after an optional prefix; the first correction whose key it contains replaces it."""
    base = stem(basename(href))
    part = r"([a-zA-Z0-9]+_[a-zA-Z0-9]+)_[a-zA-Z0-9]+"
    tries = [F.nullif(F.regexp_extract(base, f"^{p}{part}", 1), F.lit("")) for p in ([prefix] if prefix else []) + [""]]
    root = F.coalesce(*tries, F.lit(unknown))
    out = F.lit(None).cast("string")
    for key, value in (corrections or {}).items():
        out = F.coalesce(out, F.when(F.contains(root, F.lit(key)), F.lit(value)))
    return F.coalesce(out, root)


def page_number(name: Column) -> Column:
    return F.coalesce(F.regexp_extract(name, r"_(\d+)\.\w+$", 1).try_cast("int"), F.lit(0))


def first_number(x: Column) -> Column:
    return F.coalesce(F.regexp_extract(x, r"(\d+)", 1).try_cast("int"), F.lit(0))


def date_parts(unitid: Column) -> Column:
    """Struct year, month, day from a trailing _YYYYMMDD; null without."""
    pattern = r"_(\d{4})(\d{2})(\d{2})$"
    return F.when(
        unitid.rlike(pattern),
        F.struct(*(F.regexp_extract(unitid, pattern, i + 1).try_cast("int").alias(n) for i, n in enumerate(("year", "month", "day")))),
    )


def year_span(path: Column) -> Column:
    """Struct first, last from "(1900-1905)" or "(1900)"."""
    first = F.nullif(F.regexp_extract(path, r"\((\d{4})(?:-(\d{4}))?\)", 1), F.lit(""))
    last = F.nullif(F.regexp_extract(path, r"\((\d{4})(?:-(\d{4}))?\)", 2), F.lit(""))
    return F.when(first.isNotNull(), F.struct(first.alias("first"), F.coalesce(last, first).alias("last")))


MONTHS = ("janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août", "septembre", "octobre", "novembre", "décembre")


def long_date(year: Column, month: Column, day: Column) -> Column:
    names = F.array(*map(F.lit, MONTHS))
    return F.concat_ws(" ", day.cast("string"), F.get(names, month - 1), year.cast("string"))


def preferred_href(s3_key: Column, path: Column, name: Column) -> Column:
    return F.coalesce(s3_key, F.concat(path, F.lit("/"), name))


def manifest_stem(path: Column) -> Column:
    return F.regexp_replace(basename(path), r"(\.csv)?(\.gz)?$", "")


def forward_slashes(path: Column) -> Column:
    return F.replace(path, F.lit("\\"), F.lit("/"))


def parameter_signature(name: Column) -> Column:
    """``fmt_qNN`` with optional ``_fNN_rminNNNN`` from a converted file's stem."""
    return F.nullif(F.regexp_extract(stem(name), r"([a-z0-9]+_q\d+(?:_f\d+_rmin\d+)?)$", 1), F.lit(""))


def corpus_of_path(path: Column) -> Column:
    return F.nullif(F.regexp_extract(path, r"corpus_(.+?)_\d{8}_\d+", 1), F.lit(""))


def corpus_after(path: Column, marker: str) -> Column:
    parts = F.split(path, "/")
    at = F.array_position(parts, marker)
    return F.when(at > 0, F.get(parts, at.cast("int")))


def transfer_tags(uuid: Column, checksum: Column) -> Column:
    return F.concat_ws("&", F.concat(F.lit("uuid="), uuid), F.concat(F.lit("checksum_md5="), checksum))


def is_junk(name: Column) -> Column:
    """System files by their last three characters; a null name isn't one."""
    return F.coalesce(F.right(name, F.lit(3)).isin(list(JUNK_ENDINGS)), F.lit(False))


def flag(x: Column) -> Column:
    """True for a true boolean or the text "true" in any case; null is false."""
    return F.coalesce(F.lower(F.trim(x.cast("string"))) == "true", F.lit(False))


def contains_any(x: Column, needles: Sequence[str]) -> Column:
    out = F.lit(False)
    for n in needles:
        out = out | F.coalesce(F.contains(x, F.lit(n)), F.lit(False))
    return out


def split_path(path: Column, n: int) -> list[Column]:
    """``n`` + 1 columns path0..pathn; the last holds the rest, missing parts are null."""
    parts = F.split(path, "/", n + 1)
    return [F.get(parts, F.lit(i)).alias(f"path{i}") for i in range(n + 1)]


def without_prefix(path: Column, prefix: str) -> Column:
    """All occurrences of the prefix text go, as in the source inventory."""
    return F.replace(path, F.lit(prefix), F.lit(""))


def suffix_between(identifier: Column, low: int, high: int) -> Column:
    return F.coalesce(F.right(identifier, F.lit(8)).try_cast("int").between(low, high), F.lit(False))


@F.pandas_udf(StringType())
def unescape_html(x: pd.Series) -> pd.Series:
    """Character references decoded."""
    return x.map(html.unescape, na_action="ignore")


def _slug(t: str) -> str:
    plain = "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))
    return re.sub(r"[^a-z0-9_]", "", plain.replace(" ", "_").replace("-", "_").lower())


@F.pandas_udf(StringType())
def uri_slug(x: pd.Series) -> pd.Series:
    """NFKD without combining marks, blanks and hyphens to underscores, lower case, letters, digits and underscores only."""
    return x.map(_slug, na_action="ignore")


def sent_or_exempt(uploaded: Column, corpus: Column, source: Column, exempt: Sequence[tuple[str, str]]) -> Column:
    """Whether a file was uploaded (truth value or text), or is of a (corpus, source) that never is; never null."""
    test = flag(uploaded)
    for code, origin in exempt:
        test = test | F.coalesce((corpus == code) & (source == origin), F.lit(False))
    return test


def mentions(text: Column, mark: str, regex: bool = False) -> Column:
    """Whether a text holds a mark; a null text doesn't."""
    known = F.coalesce(text, F.lit(""))
    return known.rlike(mark) if regex else F.contains(known, F.lit(mark))
