"""Words of a text as bytes; the helpers that several operators share inside their tasks."""

from __future__ import annotations

UPPER = bytes(range(0x41, 0x5B))
#: A-Z in lower case; every other byte stays.
LOWER = bytes.maketrans(UPPER, UPPER.lower())
#: As LOWER; bytes below 0x80 that are neither letters nor digits become blanks.
ALNUM = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).translate(LOWER)


def encoded(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def blank_separated(text: str | None) -> list[bytes]:
    """Runs of `[^\\x20\\x09-\\x0D]`: bytes.split() parts at just these six bytes."""
    return encoded(text).split()


def lower_words(text: str | None) -> list[bytes]:
    """As blank_separated, with A-Z in lower case."""
    return encoded(text).translate(LOWER).split()


def lower_alnum(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and all characters beyond ASCII, with A-Z in lower case."""
    return encoded(text).translate(ALNUM).split()
