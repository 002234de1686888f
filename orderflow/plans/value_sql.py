"""DuckDB SQL of the keyed pseudo-random values, for the generator oracles."""

from __future__ import annotations

# Alphabets and name syllables of the data set.
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
SYLLABLES = "['BAR','OUGHT','ABLE','PRI','PRES','ESE','ANTI','CALLY','ATION','EING']"


def key(*parts) -> str:
    return "concat_ws(':', " + ", ".join(str(p) for p in parts) + ")"


def q(text: str) -> str:
    return f"'{text}'"


def uniform(lo, hi, *k) -> str:
    draw = f"cast(concat('0x', substr(md5({key(*k)}), 1, 8)) as bigint)"
    return f"({draw} % (({hi}) - ({lo}) + 1) + ({lo}))"


def a_string_of(length, longest: int, *k) -> str:
    blocks = -(-(longest + 16 + longest // 16) // 42)
    digest = " || ".join(f"sha256({key(*k, b)})" for b in range(blocks))
    first = f"substr('{LETTERS}', {uniform(1, 52, *k, q('first'))}, 1)"
    stream = f"translate(to_base64(from_hex({digest})), '+/=', '')"
    return f"case when {length} > 0 then rpad({first} || {stream}, cast({length} as int), 'a') else '' end"


def a_string(lo: int, hi: int, *k) -> str:
    if lo == hi:
        return a_string_of(lo, hi, *k)
    return a_string_of(f"greatest({uniform(lo, hi, *k, q('len'))}, 1)", hi, *k)


def n_string(n: int, *k) -> str:
    runs = " || ".join(
        f"lpad(cast({uniform(0, 9999, *k, b)} as varchar), 4, '0')" for b in range(-(-n // 4))
    )
    return f"substr({runs}, 1, {n})"


def state_code(*k) -> str:
    return f"chr(cast({uniform(65, 90, *k, q('a'))} as int)) || chr(cast({uniform(65, 90, *k, q('b'))} as int))"


def skewed(mask: int, lo: int, hi: int, c: int, span: int, *k) -> str:
    return f"((({uniform(0, mask, *k, q('mask'))} | {uniform(lo, hi, *k, q('base'))}) + {c}) % {span})"


def nurand_item(c: int, *k) -> str:
    return f"({skewed(8191, 1, 100000, c, 100000, *k)} + 1)"


def nurand_customer(c: int, *k) -> str:
    return f"({skewed(1023, 1, 3000, c, 3000, *k)} + 1)"


def c_last(n: str) -> str:
    return " || ".join(f"{SYLLABLES}[({n}) // {d} % 10 + 1]" for d in (100, 10, 1))


def nurand_last(c: int, *k) -> str:
    return c_last(skewed(255, 0, 999, c, 1000, *k))


def data_string(*k) -> str:
    length = uniform(26, 50, *k, q("mlen"))
    offset = uniform(0, f"{length} - 8", *k, q("off"))
    head = a_string_of(offset, 42, *k, q("head"))
    tail = a_string_of(f"({length} - {offset} - 8)", 42, *k, q("tail"))
    return (
        f"case when {uniform(1, 100, *k, q('mark'))} <= 10 then ({head}) || 'ORIGINAL' || ({tail}) "
        f"else {a_string(26, 50, *k)} end"
    )


def address(prefix: str, *k) -> str:
    return ", ".join(
        [
            *[
                f"{a_string(10, 20, *k, q(p))} as {prefix}_{p}"
                for p in ("street_1", "street_2", "city")
            ],
            f"{state_code(*k, q('state'))} as {prefix}_state",
            f"{n_string(4, *k, q('zip'))} || '11111' as {prefix}_zip",
        ]
    )
