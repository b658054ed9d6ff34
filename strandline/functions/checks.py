"""Checks of parameters as they come from a settings file, as text or numbers."""

from __future__ import annotations

import re

NUMBER = re.compile(r"(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?")


def number(name: str, value, least: float = 0.0, open_end: bool = False, most: float | None = None) -> float:
    """A number of at least ``least`` (above it with open_end) and at most ``most``."""
    if not NUMBER.fullmatch(str(value)):
        raise ValueError(f"{name} must be a number: {value}")
    out = float(value)
    if out < least or (open_end and out == least) or (most is not None and out > most):
        raise ValueError(f"{name} is out of range: {value}")
    return out


def fraction(name: str, value) -> float:
    return number(name, value, open_end=True, most=1.0)


def integer(name: str, value, least: int | None = None) -> int:
    if not re.fullmatch(r"-?\d+", str(value)) or (least is not None and int(value) < least):
        raise ValueError(f"{name} must be a whole number" + (f" of at least {least}" if least is not None else "") + f": {value}")
    return int(value)


def flag(name: str, value) -> bool:
    text = str(value).strip().lower()
    if text not in ("1", "0", "yes", "no", "true", "false", "on", "off"):
        raise ValueError(f"{name} must be yes or no: {value}")
    return text in ("1", "yes", "true", "on")


def baseline(name: str, value) -> str | float:
    """``auto`` or a positive number."""
    return value if value == "auto" else number(name, value, open_end=True)


#: The change detector's parameters and their checks.
CUSUM = {
    "baseline": baseline, "bin_size": lambda n, v: integer(n, v, 1), "k": number, "h": lambda n, v: number(n, v, open_end=True), "del_ratio": fraction,
    "min_bins": lambda n, v: integer(n, v, 1), "min_len": lambda n, v: integer(n, v, 1), "edge": fraction, "recover": fraction, "recover_bins": lambda n, v: integer(n, v, 1),
}


def cusum_settings(values: dict) -> dict:
    """The given parameters, checked and converted; unknown names are an error."""
    if unknown := sorted(set(values) - set(CUSUM)):
        raise ValueError(f"unknown parameters: {', '.join(unknown)}")
    return {n: CUSUM[n](n, v) for n, v in values.items()}
