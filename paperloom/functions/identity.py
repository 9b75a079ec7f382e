"""Identity of papers and entries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperloom.functions.text import c


def fingerprint(x: Column | str) -> Column:
    """I-1: the first 96 bits of SHA-256, in hexadecimal digits; of a text its UTF-8 bytes."""
    return F.substring(F.sha2(c(x).cast("binary"), 256), 1, 24)


def doc_id(fp: Column | str) -> Column:
    """I-2: the identity of a paper from the fingerprint of its bytes; an invalid fingerprint is an error."""
    fp = F.trim(c(fp))
    return F.when(fp.rlike("^[0-9a-f]{24}$"), F.concat(F.lit("doc_"), fp)).otherwise(F.raise_error(F.concat(F.lit("not a 96-bit fingerprint: "), F.coalesce(fp, F.lit("null")))))


def doc_id_or_null(fp: Column | str) -> Column:
    """I-2 for checks over whole columns: null where the fingerprint is invalid."""
    fp = F.trim(c(fp))
    return F.when(fp.rlike("^[0-9a-f]{24}$"), F.concat(F.lit("doc_"), fp))


def source_key(x: Column | str) -> Column:
    """P-2: the normal form of a relative path of a PDF, null where it is absolute, empty or climbs."""
    k = F.regexp_replace(F.translate(c(x), "\\", "/"), r"^(?:\./)+", "")
    bad = (k == "") | k.startswith("/") | k.rlike(r"(?:^|/)\.\.(?:/|$)")
    k = F.when(F.lower(k).endswith(".pdf"), F.concat(F.substring(k, F.lit(1), F.length(k) - 4), F.lit(".pdf"))).otherwise(F.concat(k, F.lit(".pdf")))
    return F.when(~bad, F.regexp_replace(F.regexp_replace(k, r"/(?:\./)+|/{2,}", "/"), r"/$", ""))


def artifact_path(key: Column | str, suffix: str) -> Column:
    """P-3: the path of a paper's artifact."""
    return F.regexp_replace(c(key), r"\.pdf$", suffix)


def archive_path(x: Column | str) -> Column:
    """S-2: the relative path of an archive with its suffix, null where it is absolute, empty or climbs."""
    k = F.translate(c(x), "\\", "/")
    bad = (k == "") | k.startswith("/") | k.rlike(r"(?:^|/)\.\.(?:/|$)")
    return F.when(~bad, F.when(F.lower(k).endswith(".zip"), k).otherwise(F.concat(k, F.lit(".zip"))))
