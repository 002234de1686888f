"""Keyed pseudo-random values: each is a function of its key, so partitioning never changes it.

Every function takes the parts of a key last; the parts are joined with ':' and hashed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Alphabets and name syllables of the data set.
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
SYLLABLES = ["BAR", "OUGHT", "ABLE", "PRI", "PRES", "ESE", "ANTI", "CALLY", "ATION", "EING"]
MARK = "ORIGINAL"


def _col(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def key_of(*parts) -> Column:
    """The text that is hashed."""
    return F.concat_ws(":", *[_col(p).cast("string") for p in parts])


def uniform(lo, hi, *key) -> Column:
    """Whole number drawn evenly from [lo, hi]."""
    draw = F.conv(F.substring(F.md5(key_of(*key)), 1, 8), 16, 10).cast("bigint")
    return draw % (_col(hi) - _col(lo) + 1).cast("bigint") + _col(lo)


def _stream(longest: int, *key) -> Column:
    """At least `longest` letters and digits: base64 of hashes, less its two other symbols."""
    blocks = -(-(longest + 16 + longest // 16) // 42)
    digest = F.concat(*[F.sha2(key_of(*key, b), 256) for b in range(blocks)])
    text = F.base64(F.unhex(digest))
    # Long base64 comes in lines.
    for other in ("+", "/", "=", "\r\n"):
        text = F.replace(text, F.lit(other), F.lit(""))
    return text


def _text(length: Column, longest: int, key) -> Column:
    first = F.substr(F.lit(LETTERS), uniform(1, len(LETTERS), *key, "first").cast("int"), F.lit(1))
    return F.rpad(F.concat(first, _stream(longest, *key)), length.cast("int"), F.lit("a"))


def a_string_of(length, longest: int, *key) -> Column:
    """Letters and digits, a letter first, of a given length; empty where the length is 0."""
    length = _col(length)
    return F.when(length > 0, _text(length, longest, key)).otherwise(F.lit(""))


def a_string(shortest: int, longest: int, *key) -> Column:
    """Letters and digits, a letter first, of a length drawn from [shortest, longest]."""
    if longest <= 0:
        return F.lit("")
    if shortest == longest:
        return _text(F.lit(longest), longest, key)
    drawn = uniform(shortest, longest, *key, "len")
    return _text(drawn if shortest > 0 else F.greatest(drawn, F.lit(1)), longest, key)


def n_string(shortest: int, longest: int, *key) -> Column:
    """Digits, of a length drawn from [shortest, longest]."""
    if longest <= 0:
        return F.lit("")
    runs = [
        F.lpad(uniform(0, 9999, *key, b).cast("string"), 4, "0") for b in range(-(-longest // 4))
    ]
    digits = F.concat(*runs)
    if shortest == longest:
        return F.substring(digits, 1, longest)
    drawn = F.greatest(uniform(shortest, longest, *key, "len"), F.lit(1))
    return F.substr(digits, F.lit(1), drawn.cast("int"))


def state_code(*key) -> Column:
    """Two capital letters."""
    return F.concat(
        F.chr(uniform(65, 90, *key, "a")), F.chr(uniform(65, 90, *key, "b"))
    )


def zip_code(*key) -> Column:
    return F.concat(n_string(4, 4, *key), F.lit("11111"))


def _skewed(mask: int, lo: int, hi: int, c, span: int, key) -> Column:
    wide = uniform(0, mask, *key, "mask").bitwiseOR(uniform(lo, hi, *key, "base"))
    return (wide + _col(c)) % span


def nurand_item(c, *key) -> Column:
    """Unevenly drawn item id in 1..100000."""
    return _skewed(8191, 1, 100000, c, 100000, key) + 1


def nurand_customer(c, *key) -> Column:
    """Unevenly drawn customer id in 1..3000."""
    return _skewed(1023, 1, 3000, c, 3000, key) + 1


def c_last(number) -> Column:
    """Last name of a number in 0..999, a syllable for each decimal digit."""
    number = _col(number).cast("int")
    names = F.array(*[F.lit(s) for s in SYLLABLES])
    digits = [F.floor(number / 100), F.floor(number / 10), number]
    return F.concat(*[F.element_at(names, (d % 10 + 1).cast("int")) for d in digits])


def nurand_last(c, *key) -> Column:
    """Unevenly drawn last name."""
    return c_last(_skewed(255, 0, 999, c, 1000, key))


def check_last_name_constants(load: int, run: int) -> None:
    """The constant used in a run must differ from the load's by 65..119, but not by 96 or 112."""
    gap = abs(load - run)
    if not 65 <= gap <= 119 or gap in (96, 112):
        raise ValueError(f"last-name constants {load} (load) and {run} (run) are {gap} apart")


def data_string(*key) -> Column:
    """26 to 50 letters and digits; in a tenth of the rows the mark stands somewhere in it."""
    length = uniform(26, 50, *key, "mlen")
    offset = uniform(F.lit(0), length - len(MARK), *key, "off")
    marked = F.concat(
        a_string_of(offset, 42, *key, "head"),
        F.lit(MARK),
        a_string_of(length - offset - len(MARK), 42, *key, "tail"),
    )
    return F.when(uniform(1, 100, *key, "mark") <= 10, marked).otherwise(a_string(26, 50, *key))
