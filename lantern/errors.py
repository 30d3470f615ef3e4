"""Coded errors: one exception class, stable codes and messages."""

from __future__ import annotations

# Codes and messages that callers match on.
MESSAGES = {
    "E1": "Invalid connection URI",
    "E2": "Unsupported SQL construct",
    "E3": "Unsafe operation without WHERE",
    "E4": "Parameter count mismatch",
    "E5": "Failed to parse SQL",
    "E6": "Transactions not supported on this server",
    "E7": "Connection failed",
    "E8": "Authentication failed",
}


class LanternError(Exception):
    """code: E1 to E8. detail, if any, follows the code's message."""

    def __init__(self, code: str, detail: str | None = None, cause: BaseException | None = None):
        self.code = code
        self.message = MESSAGES[code] + (f": {detail}" if detail else "")
        super().__init__(f"[ltn][{code}] {self.message}")
        self.__cause__ = cause
