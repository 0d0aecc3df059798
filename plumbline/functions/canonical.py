"""Canonical JSON, hashes and signed receipts."""

from __future__ import annotations

import base64
import hashlib
import hmac
import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fields of a catalogue product, sorted.
PRODUCT_FIELDS = ["brand_code", "created_at", "family_code", "product_id", "product_name", "unit_of_measure", "updated_at"]


def utc_text(ts: Column | str) -> Column:
    """Fixed-width UTC text, so that text order is time order. The session's zone must be UTC."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def canonical_json(fields: dict[str, Column]) -> Column:
    """Sorted keys, no spaces, nulls kept, control characters escaped in lower case."""
    text = F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"})
    lowered = text
    for c in "ABCDEF":
        lowered = F.regexp_replace(lowered, rf"(?<!\\)((?:\\\\)*\\u00[01]){c}", f"$1{c.lower()}")
    return F.when(text.contains("\\u00"), lowered).otherwise(text)


def product_json() -> Column:
    times = {"created_at", "updated_at"}
    return canonical_json({f: utc_text(f) if f in times else F.col(f) for f in PRODUCT_FIELDS})


def source_hash() -> Column:
    return F.sha2(product_json(), 256)


# Version prefix and domain of a receipt's signed message.
RECEIPT_VERSION = "v1"
RECEIPT_DOMAIN = b"evidence-receipt"


def sign(key: bytes, url: str, content: str, domain: bytes = RECEIPT_DOMAIN) -> str:
    """Receipt of a page: HMAC-SHA256 over a JSON list of domain, version, url and content hash."""
    body = hashlib.sha256(content.encode("utf-8", "surrogatepass")).hexdigest()
    message = json.dumps([domain.decode(), RECEIPT_VERSION, url, body], separators=(",", ":"))
    code = hmac.digest(key, message.encode(), "sha256")
    return f"{RECEIPT_VERSION}.{base64.urlsafe_b64encode(code).decode().rstrip('=')}"


def receipt_state(receipt: Column | str) -> Column:
    """missing, malformed or well_formed; needs no key."""
    c = F.col(receipt) if isinstance(receipt, str) else receipt
    return F.when(c.isNull(), "missing").when(c.rlike(rf"^{RECEIPT_VERSION}\.[A-Za-z0-9_-]{{42}}[AEIMQUYcgkosw048]$"), "well_formed").otherwise("malformed")


def verify_udf(key: bytes):
    """(url, content, receipt) -> whether the receipt is the page's; the key travels with the function, never in a column."""

    @F.pandas_udf("boolean")
    def valid(url: pd.Series, content: pd.Series, receipt: pd.Series) -> pd.Series:
        ok = [u is not None and c is not None and r is not None and hmac.compare_digest(sign(key, u, c).encode(), r.encode()) for u, c, r in zip(url, content, receipt)]
        return pd.Series(ok, dtype=bool)

    return valid
