"""Names of columns."""

from __future__ import annotations

# Fixed value: the characters of a name that become an underscore.
SEPARATORS = " -"
_TO_UNDERSCORE = str.maketrans(dict.fromkeys(SEPARATORS, "_"))


def normalize_name(name: str) -> str:
    """Without blanks around it, in capitals, with an underscore for each separator."""
    return name.strip().translate(_TO_UNDERSCORE).upper()


def flag_name(value: str, prefix: str = "FLAG_") -> str:
    """Column name of the flag for ``value``, e.g. ``FLAG_AUTO_LOAN``."""
    return prefix + normalize_name(value)
