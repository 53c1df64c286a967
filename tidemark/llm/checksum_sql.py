"""CRC-32 in DuckDB SQL, which has no function for it."""

from __future__ import annotations

# Remainders of the 16 values of four bits, of the polynomial 0xEDB88320.
NIBBLES = [
    0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948,
    3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108,
]


def crc32_sql(text: str) -> str:
    """The CRC-32 of an expression that gives ASCII text, four bits at a time, low ones first."""
    digits = f"string_split(reverse(hex(encode(reverse({text})))), '')"
    values = f"list_transform({digits}, lambda h: instr('123456789ABCDEF', h)::BIGINT)"
    return (
        f"CASE WHEN ({text}) = '' THEN 0 ELSE xor(4294967295::BIGINT, list_reduce("
        f"list_prepend(4294967295::BIGINT, {values}), lambda a, h: "
        f"xor(({NIBBLES})[(xor(a, h) & 15) + 1]::BIGINT, a >> 4))) END"
    )
