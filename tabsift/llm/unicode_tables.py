"""Code-point tables (letter, lower case, script) for vectorised text scans; built once per worker."""

from __future__ import annotations

from functools import cache

import numpy as np

TOP = 0x110000

# First code point, last code point, script.
SCRIPT_RANGES = [
    (0x0041, 0x024F, "Latin"),
    (0x0250, 0x02AF, "Latin"),
    (0x0370, 0x03FF, "Greek"),
    (0x0400, 0x052F, "Cyrillic"),
    (0x0530, 0x058F, "Armenian"),
    (0x0590, 0x05FF, "Hebrew"),
    (0x0600, 0x077F, "Arabic"),
    (0x0900, 0x097F, "Devanagari"),
    (0x0980, 0x09FF, "Bengali"),
    (0x0B80, 0x0BFF, "Tamil"),
    (0x0C00, 0x0C7F, "Telugu"),
    (0x0E00, 0x0E7F, "Thai"),
    (0x10A0, 0x10FF, "Georgian"),
    (0x1100, 0x11FF, "Hangul"),
    (0x1E00, 0x1EFF, "Latin"),
    (0x1F00, 0x1FFF, "Greek"),
    (0x3040, 0x30FF, "Kana"),
    (0x3400, 0x4DBF, "Han"),
    (0x4E00, 0x9FFF, "Han"),
    (0xAC00, 0xD7AF, "Hangul"),
    (0x20000, 0x3FFFF, "Han"),
]

SCRIPTS = ["other", *dict.fromkeys(r[2] for r in SCRIPT_RANGES)]


@cache
def letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(TOP)])


@cache
def lower() -> np.ndarray:
    return np.array([ord(x) if len(x := chr(i).lower()) == 1 else i for i in range(TOP)], np.uint32)


@cache
def scripts() -> np.ndarray:
    table = np.zeros(TOP, np.uint8)
    for first, last, name in SCRIPT_RANGES:
        table[first : last + 1] = SCRIPTS.index(name)
    return table


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts, each followed by a line feed, and where each text starts (one more than texts)."""
    joined = "\n".join([*texts, ""])
    starts = np.cumsum([0] + [len(t) + 1 for t in texts])
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4"), starts
