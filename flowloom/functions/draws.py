"""Repeatable draws: a whole number computed from a row's key instead of from a random generator.

The same key and salt give the same value on every run, in every partitioning and after a
lost executor, and two columns with different salts are independent. No row has to be moved or
numbered to get its values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A generated label has 5 to 10 characters out of the 36 letters and digits.
LABEL_SHORTEST, LABEL_LONGEST = 5, 10
LABEL_ALPHABET_SIZE = 36


def whole_div(value: Column | str, by: Column | str | int) -> Column:
    """Whole-number quotient in long arithmetic; `/` would go through doubles."""
    return F.call_function("div", value, F.lit(by) if isinstance(by, int) else by)


def draw(n: int, salt: str, *keys: Column | str) -> Column:
    """Whole number in [0, n), uniform over keys.

    The 53 bits kept from the hash leave a bias below n / 2**53.
    """
    hashed = F.xxhash64(F.lit(salt), *keys)
    # `%` counts as nullable; coalesce keeps joins on a draw from testing it for NULL, which hashes twice.
    return F.coalesce(F.shiftrightunsigned(hashed, 11) % F.lit(n).cast("long"), F.lit(0).cast("long"))


def label(salt: str, *keys: Column | str) -> Column:
    """Text of 5 to 10 letters and digits: the low base-36 digits of a 63-bit hash."""
    hashed = F.shiftrightunsigned(F.xxhash64(F.lit(salt), *keys), 1)
    digits = F.lower(F.conv(hashed.cast("string"), 10, LABEL_ALPHABET_SIZE))
    low = F.right(F.lpad(digits, LABEL_LONGEST + 3, "0"), F.lit(LABEL_LONGEST))
    length = draw(LABEL_LONGEST - LABEL_SHORTEST + 1, salt + " length", *keys)
    return F.left(low, (length + LABEL_SHORTEST).cast("int"))
