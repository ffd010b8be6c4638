"""Brute-force helpers that read the contracts word for word."""

from __future__ import annotations

import re

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def spaced_words(text: str | None, lower: bool = False) -> list[str]:
    text = text or ""
    return SPACED.findall(text.translate(LOWER) if lower else text)


def alnum_words(text: str | None) -> list[str]:
    return ALNUM.findall((text or "").translate(LOWER))
