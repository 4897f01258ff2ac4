"""Deterministic surrogate keys: name-based UUID version 5 (RFC 4122).

The warehouse keys every dimension and mart row by ``uuid5(DNS namespace,
text)``. Built from ``sha1`` and string functions only, so it runs inside
codegen on every executor and equals Python's ``uuid.uuid5``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (RFC 4122): the DNS namespace UUID, as hex without dashes.
NAMESPACE_DNS_HEX = "6ba7b8109dad11d180b400c04fd430c8"


def uuid5(name: Column) -> Column:
    """UUID v5 of ``name`` (cast to string, UTF-8) in the DNS namespace.

    Null in, null out, like the reference's key function.
    """
    raw = F.concat(F.unhex(F.lit(NAMESPACE_DNS_HEX)), name.cast("string").cast("binary"))
    h = F.sha1(raw)
    # version nibble -> 5; variant bits of byte 8 -> 10xx
    variant = F.translate(F.substring(h, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(
        F.substring(h, 1, 8), F.lit("-"),
        F.substring(h, 9, 4), F.lit("-5"),
        F.substring(h, 14, 3), F.lit("-"),
        variant, F.substring(h, 18, 3), F.lit("-"),
        F.substring(h, 21, 12),
    )
