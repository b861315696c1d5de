"""Identifiers. The stable forms depend on the key only, so replays give the same id."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: canonical UUID text.
UUID_PATTERN = "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"


def random_uuid() -> Column:
    return F.uuid()


def stable_uuid(kind: str, key: Column) -> Column:
    """UUID text made from a digest of ``kind:key``."""
    digest = F.md5(F.concat(F.lit(f"{kind}:"), key.cast("string")))
    # A list of one is bound to ``d``, so the digest is made once for its five parts.
    return F.transform(
        F.array(digest),
        lambda d: F.concat(
            F.substring(d, 1, 8), F.lit("-"), F.substring(d, 9, 4), F.lit("-"),
            F.substring(d, 13, 4), F.lit("-"), F.substring(d, 17, 4), F.lit("-"),
            F.substring(d, 21, 12),
        ),
    )[0]


def parse_uuid(text: Column) -> Column:
    """Lower-case canonical text, or null when it is not a UUID."""
    return F.when(text.rlike(UUID_PATTERN), F.lower(text))


def short_code(key: Column, length: int = 10) -> Column:
    """Url-safe code of ``length`` characters made from a digest of the key."""
    digest = F.base64(F.unhex(F.sha2(key.cast("string"), 256)))
    return F.translate(F.substring(digest, 1, length), "+/", "-_")
