"""Decoding of imploded data, as in compressed DBC files.

Bits come lowest first. A set bit begins a copy: a length code with extra bits, then a distance code with low bits, two
for copies of two bytes and else as many as the window's size tells. A clear bit begins a literal, eight bits or coded.
Length 519 ends the data. Codes are canonical and stand with their bits inverted.
"""

from __future__ import annotations

import functools

# fixed values of the format: code lengths as (length in the low four bits, repeats less one in the high ones)
_LITERALS = bytes([
    11, 124, 8, 7, 28, 7, 188, 13, 76, 4, 10, 8, 12, 10, 12, 10, 8, 23, 8, 9, 7, 6, 7, 8, 7, 6, 55, 8, 23, 24, 12, 11, 7, 9, 11, 12, 6, 7, 22, 5, 7, 24, 6, 11, 9, 6, 7, 22, 7, 11, 38, 7, 9, 8, 25, 11, 8, 11, 9, 12,
    8, 12, 5, 38, 5, 38, 5, 11, 7, 5, 6, 21, 6, 10, 53, 8, 7, 24, 10, 27, 44, 253, 253, 253, 252, 252, 252, 13, 12, 45, 12, 45, 12, 61, 12, 45, 44, 173,
])
_LENGTHS = bytes([2, 35, 36, 53, 38, 23])
_DISTANCES = bytes([2, 20, 53, 230, 247, 151, 248])
_BASE = (3, 2, 4, 5, 6, 7, 8, 9, 10, 12, 16, 24, 40, 72, 136, 264)
_EXTRA = (0, 0, 0, 0, 0, 0, 0, 0, 1, 2, 3, 4, 5, 6, 7, 8)
_END = 519


def lengths(packed: bytes) -> list[int]:
    """The code length of each symbol."""
    return [x & 15 for x in packed for _ in range((x >> 4) + 1)]


def codes(packed: bytes) -> dict[int, tuple[int, int]]:
    """Each symbol's code as it stands in the data (first bit lowest) and its length."""
    sizes, out, code = lengths(packed), {}, 0
    for size in range(1, max(sizes) + 1):
        for symbol in (s for s, n in enumerate(sizes) if n == size):
            bits = ~code & ((1 << size) - 1)
            out[symbol] = int(f"{bits:0{size}b}"[::-1], 2), size
            code += 1
        code <<= 1
    return out


@functools.cache
def _table(packed: bytes) -> tuple[int, list]:
    """What any next bits, as many as the longest code has, begin with: symbol and length."""
    found = codes(packed)
    width = max(n for _, n in found.values())
    out: list = [None] * (1 << width)
    for symbol, (code, size) in found.items():
        for high in range(1 << (width - size)):
            out[high << size | code] = symbol, size
    return width, out


def explode(data: bytes) -> bytes:
    """The decoded bytes; ValueError if the data ends early or is not of this format."""
    if len(data) < 2 or data[0] > 1 or data[1] not in (4, 5, 6):
        raise ValueError("not imploded data")
    coded, window = data[0] == 1, data[1]
    out, at, held, have = bytearray(), 2, 0, 0

    def need(n: int) -> None:
        """At least n bits, zeros beyond the data's end."""
        nonlocal at, held, have
        while have < n:
            part = data[at : at + 8]
            if not part and at > len(data) + 8:
                raise ValueError("imploded data ends early")
            held |= int.from_bytes(part, "little") << have
            at, have = at + 8, have + 64

    def take(n: int) -> int:
        nonlocal held, have
        need(n)
        x = held & ((1 << n) - 1)
        held, have = held >> n, have - n
        return x

    def symbol(table: tuple[int, list]) -> int:
        width, entries = table
        need(width)
        found = entries[held & ((1 << width) - 1)]
        if found is None:
            raise ValueError("no such code")
        take(found[1])
        return found[0]

    literal, length, distance = map(_table, (_LITERALS, _LENGTHS, _DISTANCES))
    while True:
        if not take(1):
            out.append(symbol(literal) if coded else take(8))
            continue
        which = symbol(length)
        size = _BASE[which] + take(_EXTRA[which])
        if size == _END:
            return bytes(out)
        low = 2 if size == 2 else window
        back = (symbol(distance) << low) + take(low) + 1
        if back > len(out):
            raise ValueError("a copy from before the data")
        if back >= size:
            out += out[len(out) - back : len(out) - back + size]
        else:
            piece = bytes(out[-back:])
            out += (piece * (size // back + 1))[:size]


def dbf_of_dbc(data: bytes) -> bytes:
    """A DBC file is a DBF header, a checksum of four bytes and the imploded rows."""
    size = int.from_bytes(data[8:10], "little")
    return data[: size - 1] + b"\r" + explode(data[size + 4 :])
