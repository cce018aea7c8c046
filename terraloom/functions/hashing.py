"""SHA-256 bucket encoding as a plain column expression."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

HEX_DIGITS_PER_LONG = 15  # 60 bits always fit a signed 64-bit integer


def hash_bucket(value: Column, n_buckets: int = 2**32, prefix_bytes: int = 18) -> Column:
    """Bucket in ``[0, n_buckets)`` of the big-endian integer made of the first
    ``prefix_bytes`` of SHA-256(value).  NULL stays NULL.

    The integer is up to 256 bits wide, so it is reduced without ever being
    formed: a power of two only needs the trailing bits, any other modulus is
    folded over hex chunks that are short enough for 64-bit arithmetic.
    """
    if not 1 <= prefix_bytes <= 32:
        raise ValueError("prefix_bytes must lie in 1..32")
    if not 1 <= n_buckets < 2**59:
        raise ValueError("n_buckets must lie in 1..2^59-1")
    digits = 2 * prefix_bytes
    digest = F.sha2(value.cast("string"), 256)

    def chunk(first: int, length: int) -> Column:
        return F.conv(F.substring(digest, first, length), 16, 10).cast("bigint")

    if n_buckets & (n_buckets - 1) == 0:
        length = min(HEX_DIGITS_PER_LONG, digits)
        return chunk(digits - length + 1, length).bitwiseAND(F.lit(n_buckets - 1).cast("bigint"))

    step = (63 - n_buckets.bit_length()) // 4
    acc = F.lit(0).cast("bigint")
    first = 1
    while first <= digits:
        length = min(step, digits - first + 1)
        acc = (acc * F.lit(16**length).cast("bigint") + chunk(first, length)) % F.lit(n_buckets)
        first += length
    return F.when(value.isNotNull(), acc.cast("bigint"))
